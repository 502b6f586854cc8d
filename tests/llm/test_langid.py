"""Character models against a dictionary version of interpolated Kneser-Ney, and held-out accuracy."""

import math
import random
from collections import Counter, defaultdict

import numpy as np

from findry.llm import langid
from tests.llm.data import no_documents, odd_documents, prose

ALPHABETS = {"aa": "abcdefgh", "bb": "ghijklmnop", "cc": "αβγδεζη"}


def plain_model(texts):
    """probability(context, character) by the textbook recursion over strings."""
    grams = Counter()
    for t in texts:
        n = langid.normalise(t)
        grams.update(n[i:i + 4] for i in range(len(n) - 3))
    counts = {4: grams}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    by_context = {k: defaultdict(dict) for k in counts}
    discount = {}
    for k, c in counts.items():
        for g, n in c.items():
            by_context[k][g[:-1]][g[-1]] = n
        once, twice = list(c.values()).count(1), list(c.values()).count(2)
        discount[k] = min(0.95, max(0.1, once / max(1, once + 2 * twice)))

    def probability(gram):
        k = len(gram)
        if k == 0:
            return 1 / langid.ALPHABET
        row = by_context[k].get(gram[:-1])
        lower = probability(gram[1:])
        if not row:
            return lower
        total, d = sum(row.values()), discount[k]
        return max(row.get(gram[-1], 0) - d, 0) / total + d * len(row) / total * lower

    return probability


def built(texts):
    counts = {}
    for lang, some in texts.items():
        codes, n = np.unique(langid.grams([langid.normalise(t) for t in some])[0], return_counts=True)
        counts[lang] = codes, n
    return langid.build(counts)


def test_probabilities_are_those_of_the_recursion():
    rnd = random.Random(1)
    texts = {lang: [prose(rnd, 3, letters) for _ in range(4)] for lang, letters in ALPHABETS.items()}
    model = built(texts)
    plain = {lang: plain_model(some) for lang, some in texts.items()}
    tests = [prose(rnd, 2, letters) for letters in [*ALPHABETS.values(), "xyzäö", "日本語"]]
    tests += ["a", "\U0001f600 a \U00010400x", "12 ! ,", ""]
    entropy, sizes = model.entropies([langid.normalise(t) for t in tests])
    for t, row, size in zip(tests, entropy, sizes):
        n = langid.normalise(t)
        units = n.encode("utf-16-le").decode("utf-16-le", "surrogatepass")
        assert size == (len(n.encode("utf-16-le")) // 2 - 3 if n else 0)
        if not n or any(ord(c) > 0xFFFF for c in units):
            continue
        for column, lang in enumerate(model.langs):
            want = -sum(math.log2(plain[lang](n[i:i + 4])) for i in range(len(n) - 3)) / (len(n) - 3)
            assert abs(row[column] - want) < 1e-3


def documents(spark, n=240):
    rnd = random.Random(2)
    rows = []
    for i in range(n):
        lang = sorted(ALPHABETS)[i % 3]
        rows.append((i, prose(rnd, rnd.randint(1, 12), ALPHABETS[lang]), lang if i % 2 else None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_unlabelled_documents_get_their_language(spark):
    docs = documents(spark)
    model = langid.train(docs)
    found = langid.identify(docs, model).toPandas()
    assert (found["lang_pred"] == [sorted(ALPHABETS)[i % 3] for i in found["doc_id"]]).all()
    assert found["score"].between(0, 1).all() and not found["rejected"].any()
    other = spark.createDataFrame(
        [(1, "Это совсем другой язык и его никто не учил"), (2, "qqq xxx yyy zzz www vvv uuu ttt")],
        "doc_id long, text string")
    assert langid.identify(other, model).where("rejected").count() == 2
    small = langid.train(docs, entries=60)
    assert sum(len(k) for n, k in small.keys.items() if n == 4) <= 60
    assert langid.identify(docs, small).count() == 240


def test_odd_rows(spark):
    docs = odd_documents(spark)
    model = langid.train(docs)
    rows = langid.identify(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == (not letters)
        assert (r["score"] > 0) == letters and (letters or r["rejected"])
    assert langid.train(no_documents(spark)) is None
    assert langid.train(docs.where("text is null")) is None
    none = langid.identify(docs, None).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and len(none) == len(rows)
    assert langid.identify(no_documents(spark), model).count() == 0


def test_a_model_in_tables_has_the_same_probabilities_and_keeps_a_rare_language(spark):
    rnd = random.Random(3)
    letters = {"aa": "abcdefghijklmn", "bb": "klmnopqrstuvw", "zz": "mnopxyz"}
    rows = [(i, prose(rnd, 30, letters["aa" if i % 2 else "bb"]), "aa" if i % 2 else "bb")
            for i in range(200)]
    rows += [(1000 + i, prose(rnd, 1, letters["zz"]), "zz") for i in range(4)]
    rows += [(2000 + i, prose(rnd, 2, letters["zz"]), None) for i in range(9)] + [(3000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole, stored = langid.train(docs), langid.train(docs, entries=1000)
    assert stored.stored and not stored.keys and stored.langs == whole.langs == ["aa", "bb", "zz"]
    want = {r["doc_id"]: r for r in langid.identify(docs, whole).collect()}
    got = {r["doc_id"]: r for r in langid.identify(docs, stored).collect()}
    assert len(got) == len(rows) and got.keys() == want.keys()
    for i, r in got.items():
        assert r["lang_pred"] == want[i]["lang_pred"] and r["rejected"] == want[i]["rejected"]
        assert abs(r["score"] - want[i]["score"]) < 1e-3
    assert all(got[2000 + i]["lang_pred"] == "zz" for i in range(9))
    for lang, limit in whole.limits.items():
        assert np.allclose(limit, stored.limits[lang], atol=1e-3)


def test_rare_languages_beside_a_hot_one_keep_their_texts(spark):
    rnd = random.Random(4)
    rows = [(i, prose(rnd, 4, "abcdefghij"), "aa") for i in range(3000)]
    rare = {"r1": ("αβγδεζη", 1), "r2": ("бвгдежз", 2), "r5": ("אבגדהוז", 5)}
    for lang, (letters, n) in rare.items():
        # The first text says little in many words, the others are like any.
        rows += [(len(rows) + i, prose(rnd, 8, letters) if i or n == 1 else f"{letters[:3]} " * 60, lang)
                 for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for seed in range(3):
        model = langid.train(docs.withColumn("doc_id", docs["doc_id"] + 10_000 * seed))
        assert model.langs == ["aa", "r1", "r2", "r5"] and model.limits.keys() == set(model.langs)
        assert all(np.isfinite(x).all() for x in model.limits.values())
        found = langid.identify(docs.where("lang != 'aa'"), model).collect()
        assert len(found) == 8 and not any(r["rejected"] for r in found)
        assert all(r["lang_pred"] == r["lang"] for r in found)
        foreign = spark.createDataFrame([(1, "qqq xxx yyy zzz www vvv uuu ttt " * 3)],
                                        "doc_id long, text string")
        assert langid.identify(foreign, model).where("rejected").count() == 1


def test_counts_and_limits_come_from_every_text(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(i, prose(rnd, 2, ALPHABETS["aa"]), "aa") for i in range(900)]
    rows += [(900 + i, prose(rnd, 3, ALPHABETS["cc"]), "cc") for i in range(40)]
    rows += [(2000, "123", "aa"), (2001, None, "aa"), (2002, prose(rnd, 2, "xyz"), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    measured = []
    calibrate = langid._calibrate

    def watched(model, seen):
        measured.extend(r.asDict() for r in seen.collect())
        calibrate(model, seen)

    monkeypatch.setattr(langid, "_calibrate", watched)
    for entries in (langid.ENTRIES, 100):
        measured.clear()
        model = langid.train(docs, entries=entries)
        assert Counter(r["lang"] for r in measured) == {"aa": 900, "cc": 40}
        for lang, (usual, spread) in model.limits.items():
            own = [(r["entropy"], r["size"]) for r in measured if r["lang"] == lang]
            entropy, size = (np.array(x) for x in zip(*own))
            assert abs(usual - np.median(entropy)) < 1e-3
            off = (entropy - np.median(entropy)) * np.sqrt(size / (size + 60.0))
            assert abs(spread - max(1.0, 3 * np.quantile(off, 0.99))) < 3e-3
    texts = [langid.normalise(r[1]) for r in rows if r[1] and r[2]]
    whole = langid.train(docs)
    assert set(np.unique(langid.grams(texts)[0])) == set(whole.keys[4])
    # One text many times, all of it in one half: no text of that language can be measured.
    same = spark.createDataFrame([(None, "abc def abc", "aa")] * 400, "doc_id long, text string, lang string")
    alone = langid.train(same)
    assert alone.langs == ["aa"] and not langid.identify(same, alone).where("rejected").count()
