"""Raw listing-cell text derived from the order tables, for the cleaning job.

The listing pages of the driver data carry no tables, so the text forms a
listing cell takes (money with currency sign, suffixes and thousands commas,
'-', '', junk, '80-1' ratings, team anchors, contract text, position codes)
are generated from table columns. One row per line item / customer, so the
cleaning work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.functions import clean, html

#: page_id of the first rendered listing page.
LISTING_PAGES = 1_000_000_000

# FIXED VALUES: position codes cycled over customers (every listed code, an unknown one, '').
POSITION_CODES = ["GK", "CF", "ST", "RW", "LW", "CB", "LB", "RB", "RWB", "LWB",
                  "CM", "CDM", "CAM", "LM", "RM", "RES", ""]


def _s(c: F.Column) -> F.Column:
    return c.cast("string")


def money_cells(lineitem: DataFrame) -> DataFrame:
    q = _s(F.col("l_quantity").cast("bigint"))
    cents = _s(F.round(F.col("l_discount") * 100).cast("bigint"))
    p = F.col("l_extendedprice")
    m7, m3 = F.pmod(F.col("l_linenumber"), F.lit(7)), F.pmod(F.col("l_linenumber"), F.lit(3))
    raw_value = (
        F.when(m7 == 0, F.concat(F.lit("€"), q, F.lit(".5M")))
        .when(m7 == 1, F.concat(F.lit("€"), _s(F.col("l_quantity").cast("bigint") * 50), F.lit("K")))
        .when(m7 == 2, F.concat(F.lit("€"), _s(F.floor(p / 1000).cast("bigint")), F.lit(","),
                                F.lpad(_s(F.floor(p).cast("bigint") % 1000), 3, "0")))
        .when(m7 == 3, F.lit("-"))
        .when(m7 == 4, F.lit(""))
        .when(m7 == 5, F.when(F.col("l_tax") == 0, F.lit("abcM")).otherwise(F.concat(F.lit("x"), F.col("l_returnflag"))))
        .otherwise(F.lit("€0")))
    raw_wage = (
        F.when(m3 == 0, F.concat(F.lit("€"), cents, F.lit("K")))
        .when(m3 == 1, F.concat(F.lit("€"), _s(F.col("l_quantity").cast("bigint") * 10)))
        .otherwise(F.when(F.col("l_discount") == 0, F.lit("€0")).otherwise(F.concat(F.lit("€"), cents, F.lit(".5K")))))
    return lineitem.select("l_orderkey", "l_linenumber", raw_value.alias("raw_value"), raw_wage.alias("raw_wage"))


def number_cells(lineitem: DataFrame) -> DataFrame:
    q = _s(F.col("l_quantity").cast("bigint"))
    m4 = F.pmod(F.col("l_linenumber"), F.lit(4))
    raw = (F.when(m4 == 0, F.concat(q, F.lit("-"), _s(F.col("l_linenumber"))))
           .when(m4 == 1, F.concat(F.lit("  "), q))
           .when(m4 == 2, F.concat(F.lit("x"), q))
           .otherwise(F.concat(q, F.lit("+2"))))
    return lineitem.select("l_orderkey", "l_linenumber", raw.alias("raw"))


def entity_cells(customer: DataFrame, nation: DataFrame) -> DataFrame:
    j = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    team_cell = (F.when(F.col("c_acctbal") < 0, F.concat(F.lit("<span>"), F.col("n_name"), F.lit("</span>")))
                 .otherwise(F.concat(F.lit('<a href="/team/'), _s(F.col("n_nationkey")), F.lit('">'),
                                     F.col("n_name"), F.lit("</a>"))))
    contract = (F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Free"))
                .otherwise(_s(F.lit(2025) + F.pmod(F.col("c_nationkey"), F.lit(5)))))
    code = F.element_at(F.array(*[F.lit(c) for c in POSITION_CODES]),
                        (F.pmod(F.col("c_custkey"), F.lit(len(POSITION_CODES))) + 1).cast("int"))
    return j.select(_s(F.col("c_custkey")).alias("ID"), team_cell.alias("team_cell"),
                    contract.alias("contract_cell"), code.alias("position_code"))


def listing_pages(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Listing pages rendered from customers: PAGE_ROWS table rows of 66 cells a page, page_id from LISTING_PAGES on.

    Every seventh row has a table inside a cell, every 31st one cell too few;
    ratings carry markup, money all its forms (some unparsable, some zero).
    """
    k = F.col("c_custkey")
    parts = entity_cells(customer, nation).withColumn("c_custkey", F.col("ID").cast("long"))
    j = customer.select("c_custkey", "c_name").join(parts, "c_custkey")
    value = (F.when(k % 5 == 0, F.concat(F.lit("€"), _s(k), F.lit(".5M")))
             .when(k % 5 == 1, F.concat(F.lit("€"), _s(k), F.lit("K")))
             .when(k % 5 == 2, F.concat(F.lit("€1,"), F.lpad(_s(k % 1000), 3, "0")))
             .when(k % 5 == 3, F.when(k % 3 == 0, F.lit("abcM")).otherwise(F.concat(F.lit("€"), _s(k))))
             .otherwise(F.when(k % 2 == 0, F.lit("-")).otherwise(F.lit("€7M"))))
    inner = F.lit("<table><tbody><tr><td>1</td><td><b>x</b></td></tr><tr><td>2</td></tr></tbody></table>")
    cells = {
        S.CELL_NAME: F.concat(F.lit('<a href="/entity/'), _s(k), F.lit('">'), F.col("c_name"), F.lit(" &amp; Co</a><span>RW</span>")),
        S.CELL_AGE: F.when(k % 13 == 0, F.lit("x9")).otherwise(_s(k % 20 + 18)),
        S.CELL_OVERALL: F.concat(F.lit("<em>"), _s(k % 50 + 50), F.lit("</em>-1")),
        S.CELL_POTENTIAL: F.concat(F.lit("\n  "), _s(k % 40 + 60), F.lit(" ")),
        S.CELL_TEAM: F.col("team_cell"), S.CELL_ID: F.col("ID"), 9: F.when(k % 7 == 0, inner).otherwise(F.lit("")),
        S.CELL_POSITION: F.col("position_code"), S.CELL_CONTRACT: F.col("contract_cell"), S.CELL_VALUE: value,
        S.CELL_WAGE: F.when(k % 17 == 0, F.lit("€0")).otherwise(F.concat(F.lit("€"), _s(k % 900 + 1), F.lit("K"))),
    } | {i: _s(k * (i + 1) % 100) for i in S.TOTAL_CELLS + S.STAT_CELLS}
    tds = [F.concat(F.lit("<td>"), cells.get(i, F.lit("")), F.lit("</td>")) for i in range(S.MIN_CELLS - 1)]
    last = F.when(k % 31 == 0, F.lit("")).otherwise(F.lit("<td class='last'></td>"))
    row = F.concat(F.lit("<tr>"), *tds, last, F.lit("</tr>"))
    page = F.lit(LISTING_PAGES) + F.floor(k / S.PAGE_ROWS)
    html_ = F.concat(F.lit("<html><!-- <table> --><table><thead><tr><th>Name</th></tr></thead>\n<tbody>"),
                     F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", "row"))), lambda r: r.row), ""),
                     F.lit("</tbody></table><table></table></html>"))
    return (j.select("c_custkey", row.alias("row"), page.cast("long").alias("page_id"))
            .groupBy("page_id").agg(html_.alias("html"))
            .select("page_id", F.concat(F.lit("http://listing.example/?offset="), _s((F.col("page_id") - LISTING_PAGES) * S.PAGE_ROWS)).alias("url"), "html"))


def parse_money(cells: DataFrame) -> DataFrame:
    out = clean.with_money(cells, {"Value": "raw_value", "Wage": "raw_wage"})
    status = (F.when(F.col("Value").isNull() | F.col("Wage").isNull(), F.lit("rejected"))
              .when((F.col("Value") == 0) | (F.col("Wage") == 0), F.lit("zero"))
              .otherwise(F.lit("kept")))
    return out.withColumn("status", status)


def parse_numbers(cells: DataFrame) -> DataFrame:
    return cells.withColumns({"leading": clean.leading_int("raw"), "digits": clean.digits_int("raw")})


def parse_entities(cells: DataFrame) -> DataFrame:
    return cells.select("ID", "position_code",
                        clean.team(html.anchor_text("team_cell"), F.col("contract_cell")).alias("Team"),
                        clean.position_category("position_code").alias("Position category"))
