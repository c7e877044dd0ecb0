"""Listing tables, CSV by header name, envelope publish/decode, offsets, bounded read."""

import pandas as pd
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.sources import csv_io, feed, pages


def _row(name="A. Example", pid="158023", age="36", value="€28.5M", wage="€950K", contract="2026", team="Harbor Town",
         position="RW", n=66):
    cells = ["<td></td>"] * n
    cells[S.CELL_NAME] = f'<td><a href="/entity/{pid}">{name}</a><span>RW</span></td>'
    cells[S.CELL_AGE] = f"<td>{age}</td>"
    cells[S.CELL_OVERALL] = "<td><em>90</em>-1</td>"
    cells[S.CELL_POTENTIAL] = "<td>91</td>"
    cells[S.CELL_TEAM] = f'<td><a href="/team/1">{team}</a></td>' if team else "<td></td>"
    cells[S.CELL_ID] = f"<td>{pid}</td>"
    if n > S.CELL_POSITION:
        cells[S.CELL_POSITION] = f"<td>{position}</td>"
        cells[S.CELL_CONTRACT] = f"<td>{contract}</td>"
        cells[S.CELL_VALUE] = f"<td>{value}</td>"
        cells[S.CELL_WAGE] = f"<td>{wage}</td>"
    for k, i in enumerate(S.TOTAL_CELLS + S.STAT_CELLS):
        if i < n:
            cells[i] = f"<td>{100 + k}</td>"
    return "<tr>" + "".join(cells) + "</tr>"


def test_table_listings(spark):
    body = "".join([_row(), _row(pid="2", n=65), _row(pid="3", value="abcM"), _row(pid="4", value="€0"),
                    _row(pid="5", team="", contract="Free", position="GK", age="x1"), _row(pid="6", wage="-")])
    page = f"<html><script>var t='<table>';</script><table><thead></thead><tbody>{body}</tbody></table><table></table></html>"
    df = spark.createDataFrame([(1, "u1", page), (2, "u2", "<html><p>no table</p></html>")], "page_id long, url string, html string")
    got = {r.ID: r for r in pages.table_listings(df, with_rejects=True).collect()}
    assert set(got) == {"158023", "3", "5"}
    m = got["158023"]
    assert (m.Name, m.Age, m["Overall rating"], m.Potential, m.Team, m["Position category"]) == \
        ("A. Example", 36, 90, 91, "Harbor Town", "attaquant")
    assert (m.Value, m.Wage, m["Total attacking"], m["Total goalkeeping"], m["Defending / Pace"]) == \
        (28.5e6, 950e3, 100, 106, 111)
    assert got["3"].rejected and not m.rejected
    assert (got["5"].Team, got["5"]["Position category"], got["5"].Age) == ("Free", "gardien", 0)
    assert pages.table_listings(df).count() == 2


def test_nested_elements(spark):
    from valorem.functions import html
    cases = {
        "<td>a</td><TD class='x'>b</TD >": ["a", "b"],
        "<td>a<table><tr><td>1</td><td>2</td></tr></table>z</td><td>b</td>": ["a<table><tr><td>1</td><td>2</td></tr></table>z", "b"],
        "<td><td><td>x</td></td>y</td>": ["<td><td>x</td></td>y"],
        "</td>q<td>a</td></td><td>open": ["a", "open"],
        "<tdx>a</tdx>": [], "": [], "plain": [], "<td\nid=1>\n a</td>t": ["\n a"], None: None,
    }
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, h string").select("h", html.nested_elements("h", "td").alias("e"))
    assert {r.h: r.e for r in df.collect()} == cases


def test_table_inside_a_cell(spark):
    nested = "<table><tbody><tr><td>1</td></tr></tbody><tr><td><table><tr><td>2</td></tr></table></td></tr></table>"
    rows = [_row(pid="1"), _row(pid="2").replace("<td></td></tr>", f"<td>{nested}</td></tr>").replace("<td></td>", f"<td>{nested}</td>", 1), _row(pid="3")]
    page = f"<table><tbody>{''.join(rows)}</tbody></table><table><tr><td>other</td></tr></table>"
    df = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    got = {r.ID: r.asDict() for r in pages.table_listings(df).collect()}
    assert sorted(got) == ["1", "2", "3"]
    same = [c for c in S.MESSAGE_COLUMNS if c != "ID"]
    assert [got["2"][c] for c in same] == [got["1"][c] for c in same] and got["3"]["row_index"] == 2
    assert pages.table_rows(df).count() == 3


def test_listing_rows_li(spark):
    page = "<ul><li><a href='x'>no</a></li><li>\n<a href=\"/a\">A</a><a href=\"/b\">B</a></li></ul><!-- <li>c</li> -->"
    df = spark.createDataFrame([(7, "u", page)], "page_id long, url string, html string")
    got = pages.listing_rows(df).orderBy("row_index").collect()
    assert [(r.row_index, r.n_cells, r.first_text, r.href) for r in got] == [(0, 1, "no", ""), (1, 2, "A", "/a")]


def test_manifest(spark):
    m = pages.page_manifest(spark, "http://h/list?offset=", 3).collect()
    assert [r.url for r in m] == ["http://h/list?offset=0", "http://h/list?offset=60", "http://h/list?offset=120"]


def test_csv_by_header_name(spark, tmp_path):
    pdf = pd.DataFrame([{c: (1 if c not in S.STRING_COLUMNS else f"{c}-v") for c in S.MESSAGE_COLUMNS}])
    pdf["Value"] = "12.5"
    pdf["Age"] = "bad"
    pdf["extra"] = "z"
    path = str(tmp_path / "scraper_order.csv")
    pdf.to_csv(path, index=False)
    df = csv_io.read_by_name(spark, path)
    assert df.columns == S.MASTER_COLUMNS
    r = df.first()
    assert r.ID == "ID-v" and r.Value == 12.5 and r.Age is None and r["Total skill"] == 1
    try:
        csv_io.read_by_name(spark, str(tmp_path / "missing.csv"))
        raise AssertionError("expected FileNotFoundError")
    except FileNotFoundError:
        pass


def test_publish_round_trip_and_bounded_read(spark):
    rows = [(str(i), f"n{i}", i % 40, float(i) * 1.5) for i in range(301)]
    df = spark.createDataFrame(rows, "ID string, Name string, Age int, Value double")
    env = feed.publish(df, key="ID").cache()
    assert env.schema == S.ENVELOPE_SCHEMA or env.columns == [f.name for f in S.ENVELOPE_SCHEMA]
    back = feed.decode(env, schema="ID string, Name string, Age int, Value double")
    assert sorted(back.collect()) == sorted(df.collect())
    assert feed.bounded_read(env).count() == 301  # all, unless the caller asks for fewer
    assert feed.bounded_read(env, 300).count() == 300


def test_decode_malformed(spark):
    env = spark.createDataFrame([("1", '{"Name": "a", "ID": "1"}'), ("2", "{not json"), ("3", '{"Name": "c"}')],
                                "key string, value string")
    got = {r.key: r for r in feed.decode(env, keep=["key"], corrupt_column="_corrupt").collect()}
    assert got["1"]._corrupt is None and got["1"].Name == "a"
    assert got["2"]._corrupt == "{not json" and got["2"].Name is None
    assert got["3"]._corrupt is None and got["3"]["Position category"] is None


def test_manifest_pages_and_envelope_files(spark, tmp_path):
    stored = spark.createDataFrame([(1, "http://h/list?offset=60", "<li>x</li>"), (2, "http://other/", "<li>y</li>")],
                                   "page_id long, url string, html string")
    stored = stored.union(spark.createDataFrame([(3, "http://h/list?offset=6000", "z"), (4, "http://h/list?offset=61", "z"),
                                                 (5, "http://h/list?offset=x", "z"), (6, None, "z")], stored.schema))
    assert sorted((r.page_no, r.page_id) for r in pages.manifest_pages(stored, "http://h/list?offset=").collect()) == [(1, 1), (100, 3)]
    got = pages.manifest_pages(stored, "http://h/list?offset=", 3).collect()
    assert [(r.page_no, r.page_id) for r in got] == [(1, 1)]
    df = spark.createDataFrame([(str(i), f"n{i}") for i in range(20)], "ID string, Name string")
    env = feed.publish(df, key="ID")
    feed.write_envelope(env, str(tmp_path / "topic"), files=3)
    back = feed.read_envelope(spark, str(tmp_path / "topic"))
    assert sorted((r.key, r.partition, r.offset) for r in back.collect()) == \
        sorted((r.key, r.partition, r.offset) for r in env.collect())


def test_table_listings_equal_their_sql_formulation(spark):
    """Spark extraction vs the independent DuckDB formulation on edge rows."""
    import duckdb
    from oracle_harness import _rows
    from valorem.plans.oracle_sql import table_listings_sql
    body = "".join([_row(), _row(pid="2", n=65), _row(pid="3", value="abcM"), _row(pid="4", value="€0"),
                    _row(pid="5", team="", contract="Free", position="GK", age="x1"), _row(pid="6", wage="-"),
                    _row(pid="7", name="  B &amp; C \\n", value="€1,200", wage="€12.5K", position="RES")])
    page = f"<html><!-- <table> --><table><thead><tr><th>x</th></tr></thead><tbody>{body}</tbody></table></html>"
    pdf = pd.DataFrame({"page_id": [1, 2], "url": ["u1", "u2"], "html": [page, "<p>no table</p>"]})
    sdf = pages.table_listings(spark.createDataFrame(pdf), with_rejects=True)
    con = duckdb.connect()
    con.register("pages", pdf)
    rel = con.sql(table_listings_sql())
    sn, sr = _rows(sdf.columns, [tuple(r) for r in sdf.collect()])
    dn, dr = _rows(list(rel.columns), rel.fetchall())
    assert sn == dn and sr == dr and len(sr) == 4


def test_broker_read_without_connector_is_empty(spark):
    df = feed.read_broker_or_empty(spark, "127.0.0.1:9", "entities", retries=1)
    assert df.count() == 0 and df.schema == S.ENVELOPE_SCHEMA
