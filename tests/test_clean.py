"""Cell parsers and category expressions on the edge values of the listing data."""

from pyspark.sql import functions as F

from valorem.functions import clean, html


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_money(spark):
    vals = [None, "", "-", "€28.5M", "€950K", "€1,200", "€0", "abc", "abcM", "12.5K", "€3"]
    vals += ["1_000", "1__0", "_1", "5D", "5f", "NaN", "Infinity", "1e3", " 7 ", "0x1p3K", "M", "€", "1K5M", "+.5", "\x015"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x string")
    got = [r.v for r in clean.with_money(df, {"v": "x", "w": F.upper("x")}).orderBy("i").collect()]
    assert got == [0.0, 0.0, 0.0, 28.5e6, 950e3, 1200.0, 0.0, 0.0, None, 12500.0, 3.0,
                   1000.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1000.0, 7.0, None, None, 0.0, None, 0.5, 0.0]


def test_leading_and_digits(spark):
    vals = ["80-1", "  7", "x9", None, "12", "1a", "", "99999999999"]
    assert _one(spark, clean.leading_int, vals) == [80, 7, 0, 0, 12, 1, 0, 0]
    assert _one(spark, clean.digits_int, vals) == [0, 7, 0, 0, 12, 0, 0, 0]


def test_team(spark):
    df = spark.createDataFrame([("Real", "2026"), ("Real", "Free agent"), ("", "2026"), (None, None)], "t string, c string")
    assert [r[0] for r in df.select(clean.team("t", "c")).collect()] == ["Real", "Free", "Free", "Free"]


def test_position_category(spark):
    codes = ["GK", "ST", "CF", "RW", "LW", "CB", "LB", "RB", "RWB", "LWB", "CM", "CDM", "CAM", "LM", "RM", "RES", ""]
    got = _one(spark, clean.position_category, codes)
    assert got == ["gardien"] + ["attaquant"] * 4 + ["défenseur"] * 5 + ["milieu"] * 5 + ["res", ""]


def test_category_index_and_segment(spark):
    vals = [None, "Gardien", "défenseur", "DÉFENSEUR", "attaquant", "MILIEU", "unknown", "xyz"]
    idx = _one(spark, clean.category_index, vals)
    assert idx == [4.0, 3.0, 2.0, 2.0, 0.0, 1.0, 4.0, 4.0]
    df = spark.createDataFrame([(v,) for v in idx], "i double")
    assert [r[0] for r in df.select(clean.model_segment("i")).collect()] == \
        [None, "goalkeeper", "field", "field", "field", "field", None, None]


def test_feed_route_unknown_goes_to_field(spark):
    assert _one(spark, clean.feed_route, ["Gardien", None, "res", "milieu"]) == ["goalkeeper", "field", "field", "field"]


def test_truncate_and_cap(spark):
    assert _one(spark, clean.truncate_to_double, [12.9, -12.9, 3e9, None], "double") == [12.0, -12.0, 3e9, None]
    assert _one(spark, lambda c: clean.capped(c, 100.0), [None, 50.0, 100.0, 150.0], "double") == [None, 50.0, 100.0, 100.0]


def test_html_text_and_anchor(spark):
    frags = ['<a href="/p/1">L. &amp; Co</a>', "<span>x</span>", '<b>t</b><a href="/q">  A\n B </a>']
    assert _one(spark, html.anchor_text, frags) == ["L. & Co", "", "A\n B"]
    assert _one(spark, html.anchor_href, frags) == ["/p/1", "", "/q"]


def test_strip_all_whitespace(spark):
    assert _one(spark, clean.leading_int, ["\t80-1\n", "\n7 "]) == [80, 7]
    assert _one(spark, clean.digits_int, ["\t12\n"]) == [12]


def test_elements_in_turn_are_those_by_depth(spark):
    """Texts without nesting take a short way; nested, open and stray tags the one by depth."""
    import random
    from pyspark.sql import functions as F
    from valorem.functions import html

    def by_depth(text):
        import re
        out, depth, inner = [], 0, ""
        for x in re.split(r"(?i)(?=</?td\b)", " " + text):
            if x.startswith("</"):
                if depth == 1:
                    out.append(inner)
                    inner = ""
                elif depth > 1:
                    inner += x
                depth = max(0, depth - 1)
            elif x.startswith("<"):
                inner = inner + x if depth else re.sub(r"^<[^>]*>?", "", x)
                depth += 1
            elif depth:
                inner += x
        return out + [inner] * (depth > 0)

    rng = random.Random(7)
    texts = ["", "a", "<td>", "</td>", "<td", "<td>1</td><TD class='x'>2</Td>z<td>3", "<tdx>1</tdx>"]
    texts += ["".join(rng.choice(["<td>", "</td>", "<TD a=1>", "x\n", "<b>", "</tr>", "é"]) for _ in range(rng.randint(1, 9))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", html.nested_elements("t", "td").alias("got"))
    assert "array_contains" in df._jdf.queryExecution().optimizedPlan().toString()
    for r in df.collect():
        assert r.got == (None if r.t is None else by_depth(r.t)), r.t
