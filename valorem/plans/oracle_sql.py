"""Shared DuckDB SQL fragments for the oracle queries.

The oracle is an independent formulation of every SQL-expressible query,
written against the pre-registered driver tables.
"""

from __future__ import annotations

from valorem.sources.tables import MASTER_SQL


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


REPORT_BASE_SQL = """
report_base AS (
  SELECT * REPLACE (TRY_CAST("Value" AS DOUBLE) AS "Value", TRY_CAST("Wage" AS DOUBLE) AS "Wage",
                    TRY_CAST("Age" AS DOUBLE) AS "Age")
  FROM master
),
report AS (
  SELECT * FROM report_base
  WHERE "Value" IS NOT NULL AND NOT isnan("Value") AND "Wage" IS NOT NULL AND NOT isnan("Wage")
    AND "Age" IS NOT NULL AND NOT isnan("Age") AND "Team" IS NOT NULL
)"""

SEGMENTS_SQL = """
tagged AS (
  SELECT * REPLACE (coalesce(lower("Position category"), 'unknown') AS "Position category"),
         CASE coalesce(lower("Position category"), 'unknown')
              WHEN 'attaquant' THEN 0.0 WHEN 'milieu' THEN 1.0 WHEN 'défenseur' THEN 2.0
              WHEN 'gardien' THEN 3.0 ELSE 4.0 END AS cat_idx
  FROM master
),
seg AS (
  SELECT *, CASE WHEN cat_idx = 3.0 THEN 'goalkeeper' WHEN cat_idx IN (0.0, 1.0, 2.0) THEN 'field' END AS segment,
         CASE WHEN coalesce(('0x' || substr(md5("ID"), 1, 8))::BIGINT % 100, 0) < 80 THEN 'train' ELSE 'test' END AS split
  FROM tagged
)"""


def with_ctes(*fragments: str, body: str) -> str:
    parts = [MASTER_SQL.strip()] + [f.strip() for f in fragments]
    return "WITH " + ",\n".join(parts) + "\n" + body


def money_sql(t: str) -> str:
    s = f"replace(replace({t}, '€', ''), ',', '')"
    return (f"CASE WHEN {t} IS NULL OR {t} = '' OR {t} = '-' THEN CAST(0.0 AS DOUBLE) "
            f"WHEN contains({s}, 'M') THEN TRY_CAST(replace({s}, 'M', '') AS DOUBLE) * 1e6 "
            f"WHEN contains({s}, 'K') THEN TRY_CAST(replace({s}, 'K', '') AS DOUBLE) * 1e3 "
            f"ELSE coalesce(TRY_CAST({s} AS DOUBLE), CAST(0.0 AS DOUBLE)) END")


def text_sql(fragment: str) -> str:
    from valorem.functions.html import ENTITIES, TAG_PATTERN
    t = f"regexp_replace({fragment}, '{TAG_PATTERN}', '', 'g')"
    for a, b in ENTITIES:
        t = f"replace({t}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    from valorem.functions.html import EDGE_SPACE_PATTERN
    return f"regexp_replace({t}, '{EDGE_SPACE_PATTERN}', '', 'g')"


def anchor_text_sql(fragment: str) -> str:
    from valorem.functions.html import element_pattern
    return text_sql(f"regexp_extract({fragment}, '{element_pattern('a')}', 1)")


def category_sql(code: str) -> str:
    from valorem import schema as S
    parts = " ".join(f"WHEN {code} IN ({', '.join(repr(c) for c in codes)}) THEN '{cat}'"
                     for cat, codes in S.POSITION_GROUPS)
    return f"CASE {parts} ELSE lower({code}) END"


def trimmed_sql(cap: float, source: str = "seg", name: str = "trimmed") -> str:
    """cap -> ln(1+v) -> per-segment band (goalkeeper 3.0, field 2.5)."""
    return f"""
{name}_c AS (SELECT * REPLACE (CASE WHEN "Value" > {cap!r} THEN {cap!r} ELSE "Value" END AS "Value")
             FROM {source} WHERE segment IS NOT NULL),
{name}_l AS (SELECT *, ln(1 + "Value") AS "Value_log" FROM {name}_c),
{name}_s AS (SELECT segment, avg("Value_log") AS m, stddev_samp("Value_log") AS sd FROM {name}_l GROUP BY segment),
{name}_b AS (SELECT segment, m - k * sd AS lo, m + k * sd AS hi FROM
             (SELECT *, CASE segment WHEN 'goalkeeper' THEN 3.0 WHEN 'field' THEN 2.5 ELSE 3.0 END AS k FROM {name}_s) x),
{name} AS (SELECT {name}_l.* FROM {name}_l JOIN {name}_b USING (segment)
           WHERE "Value_log" BETWEEN lo AND hi)"""


ENVELOPE_SQL = """
envelope AS (SELECT *, "ID" AS key, 'entities' AS topic FROM master)"""


def table_listings_sql(pages: str = "pages") -> str:
    """DuckDB formulation of the 66-cell listing-table extraction (rejects kept)."""
    from valorem import schema as S
    from valorem.functions.html import NOISE_PATTERN, element_pattern
    tbl, tbody, tr, td = (element_pattern(t) for t in ("table", "tbody", "tr", "td"))
    strip = "regexp_replace({x}, '^\\\\s+|\\\\s+$', '', 'g')"

    def cell(i: int) -> str:
        return f"cells[{i + 1}]"

    def txt(i: int) -> str:
        return text_sql(cell(i))

    def digits(i: int) -> str:
        t = strip.format(x=txt(i))
        return f"CASE WHEN regexp_matches({t}, '^\\d+$') THEN coalesce(TRY_CAST({t} AS INTEGER), 0) ELSE 0 END"

    def leading(i: int) -> str:
        return f"coalesce(TRY_CAST(regexp_extract({strip.format(x=txt(i))}, '^(\\d+)', 1) AS INTEGER), 0)"

    team_txt = f"coalesce({strip.format(x=anchor_text_sql(cell(S.CELL_TEAM)))}, '')"
    contract = f"coalesce({strip.format(x=txt(S.CELL_CONTRACT))}, '')"
    fields = {
        "Name": f"coalesce({anchor_text_sql(cell(S.CELL_NAME))}, '')",
        "ID": txt(S.CELL_ID),
        "Age": digits(S.CELL_AGE),
        "Overall rating": leading(S.CELL_OVERALL),
        "Potential": leading(S.CELL_POTENTIAL),
        "Team": f"CASE WHEN contains({contract}, 'Free') OR {team_txt} = '' THEN 'Free' ELSE {team_txt} END",
        "Position category": category_sql(txt(S.CELL_POSITION)),
        "Value": money_sql(txt(S.CELL_VALUE)),
        "Wage": money_sql(txt(S.CELL_WAGE)),
    }
    for col, idx in zip(S.TOTAL_COLUMNS + S.STAT_COLUMNS, S.TOTAL_CELLS + S.STAT_CELLS):
        fields[col] = digits(idx)
    select = ",\n       ".join(f"{v} AS {q(k)}" for k, v in ((c, fields[c]) for c in S.MESSAGE_COLUMNS))
    return f"""
WITH b AS (SELECT page_id, regexp_replace(html, '{NOISE_PATTERN}', '', 'g') AS body FROM {pages}),
t AS (SELECT page_id, CASE WHEN regexp_matches(body, '{tbl}') THEN regexp_extract(body, '{tbl}', 1) END AS tb FROM b),
tb AS (SELECT page_id, coalesce(CASE WHEN regexp_matches(tb, '{tbody}') THEN regexp_extract(tb, '{tbody}', 1) END, tb)
              AS tbody FROM t WHERE tb IS NOT NULL),
r AS (SELECT page_id, regexp_extract_all(tbody, '{tr}', 1) AS rws FROM tb),
u AS (SELECT page_id, unnest(rws) AS row_html, generate_subscripts(rws, 1) - 1 AS row_index FROM r),
c AS (SELECT page_id, CAST(row_index AS INTEGER) AS row_index, regexp_extract_all(row_html, '{td}', 1) AS cells FROM u
      WHERE len(regexp_extract_all(row_html, '{td}', 1)) >= {S.MIN_CELLS}),
f AS (SELECT page_id, row_index,
       {select}
      FROM c)
SELECT *, ("Value" IS NULL OR "Wage" IS NULL) AS rejected FROM f
WHERE ("Value" IS NULL OR "Wage" IS NULL) OR ("Value" != 0 AND "Wage" != 0)"""
