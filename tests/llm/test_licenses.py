import re

import pytest

from valorem.llm import licenses as lic

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in re.split(lic.APART, text) if w]


def pairs(own):
    return set(zip(own, own[1:]))


def plain(rows, templates, threshold):
    wanted = [(k, pairs(words(t.translate(LOWER)))) for k, t in templates]
    out = []
    for doc, text in rows:
        units = []
        for para in re.split(lic.PARAGRAPH, (text or "").translate(LOWER)):
            lines = []
            for line in para.split("\n"):
                sentences = [w for w in map(words, re.split(lic.SENTENCE, line)) if w]
                units += sentences
                if len(sentences) > 1:
                    units.append(sum(sentences, []))
                if sentences:
                    lines.append(sum(sentences, []))
            if len(lines) > 1:
                units.append(sum(lines, []))
        best, found, n = 0.0, set(), 0
        for unit in units:
            own, hit = pairs(unit), False
            for k, b in wanted:
                dice = 2 * len(own & b) / (len(own) + len(b)) if own else 0
                if dice >= threshold:
                    best, hit = max(best, dice), True
                    found.add(k)
            n += hit
        out.append((doc, n, ",".join(sorted(found)), best))
    return sorted(out, key=str)


def rows():
    mit = lic.TEMPLATES[11][1]
    apache = lic.TEMPLATES[1][1]
    long_mit = next(t for k, t in lic.TEMPLATES if k == "MIT" and len(t) > 100)
    return [
        (1, None), (2, ""), (3, "no licence here at all\n\n\n"), (4, mit), (4, mit), (None, "intro\n" + mit.upper() + "\n" + mit),
        (5, "Text before. Licensed under the Apache License, Version 2.0. And text after it goes on and on."),
        (6, apache.replace("Version 2.0 ", "Version 2.0\n").replace("You may", "\nYou may")),
        (7, "x\n\n" + long_mit.replace(", ", ",\n") + "\n \nend of é text"),
        (8, "Released under the MIT License or so it is said by some people."),
        (9, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.\nLicensed under CC BY-SA 4.0"),
        (10, ("filler words of a very long text " * 3000) + ". " + mit), (11, "MIT " * 5000), (12, "the mit the mit the mit license")]


@pytest.mark.parametrize("threshold", [0.8, 0.5, 1.0])
def test_against_brute_force(spark, threshold):
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows()], "doc_id long, text string, unit int, license string").repartition(3)
    got = sorted((tuple(r) for r in lic.scan(docs, threshold=threshold).collect()), key=str)
    assert got == plain(rows(), lic.TEMPLATES, threshold)


def test_bounds_only_drop_what_cannot_match(spark):
    for r in lic.template_bigrams(spark).select("size", "low", "high").distinct().collect():
        assert 2 * (r.low - 1) / (r.size + r.low - 1) < lic.THRESHOLD <= 2 * r.low / (r.size + r.low) + 1e-9
        assert 2 * r.size / (r.size + r.high + 1) < lic.THRESHOLD <= 2 * r.size / (r.size + r.high) + 1e-9


def test_every_match_has_a_keyword():
    """Worst case: of a template's bigrams only as many stay as a match needs, those with keywords going first."""
    for threshold in (0.5, 0.8, 1.0):
        known = set(lic.keywords(lic.TEMPLATES, threshold))
        for _, t in lic.TEMPLATES:
            own = pairs(words(t.translate(LOWER)))
            without = sum(not known.intersection(p) for p in own)
            assert without < len(own) * threshold / (2 - threshold)


def test_no_python_and_no_shuffled_text(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    plan = lic.scan(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lic.scan(docs).collect() == []
