"""Text statistics, the decision list and the additive model."""

import random
import re

import numpy as np

from findry.llm import additive, rules, textstats
from tests.llm.data import no_documents, odd_documents, prose, words


def plain_counts(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)) if found else 0,
            len(lines) - len(set(lines)), len(inside))


def test_counts_follow_their_definitions():
    rnd = random.Random(6)
    texts = [None, "", " \n\t", "a", "a b a b a b c", "x\x0by\x1cz é 教", "\n\nq\nq\n q\n",
             "a b c\na b c\na b d | # $", "a " * 300]
    texts += [" ".join(rnd.choice(["p", "q", "r\n", "s#", "t"]) for _ in range(n)) for n in range(2, 60)]
    for text in texts:
        assert textstats.describe(text)[:5] == plain_counts(text), text


def junk(rnd):
    return rnd.choice([
        lambda: " ".join(w + "***" for w in words(rnd, 80)),
        lambda: " ".join([words(rnd, 1)[0]] * 90),
        lambda: " | ".join(words(rnd, 70))])()


def labelled(spark, n=600):
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        rows.append((i, junk(rnd) if bad else prose(rnd, rnd.randint(12, 30))))
        if i % 5:
            labels.append((i, 0 if bad else 1))
    labels += [(10_001, 1), (3, None), (None, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_rules_find_bad_documents_and_leave_good_ones(spark):
    docs, labels = labelled(spark)
    got = rules.apply_rules(docs, labels).toPandas()
    assert len(got) == 600
    bad = got["doc_id"] % 4 == 0
    unseen = got["doc_id"] % 5 == 0
    assert (~got.loc[bad & unseen, "kept"]).mean() >= 0.95
    assert got.loc[~bad, "kept"].mean() >= 0.99
    assert (got["base_failed"] == ((got["n_words"] < 50)
                                   | (100 * got["n_repeat_words"] > 50 * got["n_words"]))).all()
    assert not (got["base_failed"] & got["kept"]).any()


def test_rules_are_ordered_spark_conditions(spark):
    x = {"a": np.r_[np.zeros(300), np.ones(300)], "b": np.tile([0.0, 1, 2], 200)}
    bad = (x["a"] == 1) & (x["b"] >= 1)
    found = rules.fit(x, bad)
    frame = spark.createDataFrame([(0.0, 2.0), (1.0, 2.0), (1.0, 0.0)], "a double, b double")
    assert [r[0] for r in frame.select(rules.verdict(found)).collect()] == [True, False, True]
    assert "CASE WHEN" in str(rules.verdict(found)._jc.toString()) and all(map(str, found[0]))


def test_without_labels_everything_that_passes_the_base_is_kept(spark):
    docs, labels = labelled(spark, 40)
    for known in (labels.where("false"), labels.where("quality = 1")):
        got = rules.apply_rules(docs, known).toPandas()
        assert (got["kept"] == ~got["base_failed"]).all()
    scored = additive.classify(docs, labels.where("false")).toPandas()
    assert (scored["score"] == 0.5).all() and (scored["predicted"] == 1).all()
    one = additive.classify(docs, labels.where("quality = 1")).toPandas()
    assert (one["score"] > 0.9).all()


def test_additive_model_on_unseen_documents(spark):
    docs, labels = labelled(spark)
    got = additive.classify(docs, labels).toPandas()
    held = got[got["held_out"]]
    good = held["doc_id"] % 4 != 0
    assert 150 < len(held) < 250
    assert ((held["predicted"] == 1) == good).mean() >= 0.97
    assert got["score"].between(0, 1).all()
    again = additive.classify(docs, labels.where("pmod(crc32(cast(doc_id as string)), 3) <> 1")).toPandas()
    both = got.merge(again, on="doc_id")
    assert (both["score_x"] == both["score_y"]).all()  # held-out labels teach nothing


def test_pairs_catch_what_single_features_cannot():
    rnd = np.random.default_rng(1)
    x = rnd.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = additive.fit(x, y)
    assert (0, 1) in model.pairs
    fresh = rnd.random((2000, 3))
    right = (model.score(fresh) >= 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))
    assert right.mean() > 0.85


def test_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (10, 0), (10, 0), (4, None)], "doc_id long, quality int")
    for made in (rules.apply_rules(docs, labels), additive.classify(docs, labels)):
        rows = made.collect()
        assert len(rows) == docs.count()
    got = {r["doc_id"]: r for r in rules.apply_rules(docs, labels).collect()}
    assert got[4]["n_words"] == got[5]["n_words"] == 0 and got[4]["base_failed"]
    assert got[10]["base_failed"] and got[9]["n_words"] == 30_000
    assert rules.apply_rules(no_documents(spark), labels).count() == 0
    assert additive.classify(no_documents(spark), labels).count() == 0
