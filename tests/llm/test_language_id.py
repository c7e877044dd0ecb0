import numpy as np

from valorem.llm import language_id as li

DOCS = ([("the cat and the dog of the house", "en"), ("with that and from this", "en"), ("le chat et la maison de la rue", "fr"),
         ("une école et des élèves", "fr"), ("der Hund und die Katze", "de"), ("ein Haus über dem Fluß", "de"), (None, "fr"), ("no label", None)])


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "s") for r in rows], "text string, lang string, score int, lang_pred string").repartition(3)


def plain(model_docs, text):
    """Counts n-grams one by one; None without letters."""
    import math
    counts, docs = {}, {}
    for t, lang in model_docs:
        if lang is None:
            continue
        docs[lang] = docs.get(lang, 0) + 1
        own = counts.setdefault(lang, np.zeros(li.BUCKETS))
        for _, b in li.grams([t]):
            for x in b:
                own[x] += 1
    if not any(len(b) for _, b in li.grams([text])):
        return None
    total = sum(docs.values()) + li.SMOOTHING * len(docs)
    logs = {}
    for lang, own in counts.items():
        s = math.log((docs[lang] + li.SMOOTHING) / total)
        for _, b in li.grams([text]):
            for x in b:
                s += math.log((own[x] + li.SMOOTHING) / (own.sum() + li.SMOOTHING * li.BUCKETS))
        logs[lang] = s
    best = min(logs, key=lambda k: (-logs[k], k))
    return best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())


def test_against_plain_bayes(spark):
    model = li.train(frame(spark, DOCS))
    texts = ["the house", "la école", "über", "zzz", "", None, "123 !?", "a", "É", "the " * 400_000]
    got = {r.text: (r.lang_pred, r.score) for r in li.identify(frame(spark, [(t, None) for t in texts]), model).collect()}
    for t in texts[:-1]:
        want = plain(DOCS, t)
        if want is None:
            assert got[t] == ("und", 0.0)
        else:
            assert got[t][0] == want[0] and abs(got[t][1] - want[1]) < 1e-4, t
    assert got[texts[-1]] == ("en", 1.0)


def test_pieces_do_not_change_the_grams(monkeypatch):
    text = "abc dé fgh ij klm " * 50
    whole = np.bincount(np.concatenate([b for _, b in li.grams([text])]), minlength=li.BUCKETS)
    both = [0, 0]
    for owner, b in li.grams([text, None, "xy z"]):
        both[0] += np.bincount(b[owner == 0], minlength=li.BUCKETS)
        both[1] += len(b[owner == 2])
    assert (whole == both[0]).all()
    assert both[1] == 6 + 5 + 4


def test_empty(spark):
    model = li.train(frame(spark, DOCS).filter("false"))
    assert [r.lang_pred for r in li.identify(frame(spark, DOCS[:1]), model).collect()] == ["und"]
    assert li.identify(frame(spark, DOCS).filter("false"), li.train(frame(spark, DOCS))).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = li.op9_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == 1000
    own = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == r.lang for r in own) / len(own) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in got)
