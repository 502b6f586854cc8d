"""The toxicity classifier: held-out accuracy, swaps of group terms, odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from findry.llm import queries, toxicity
from tests.llm.data import no_documents, odd_documents, prose, words

MEAN = ["grobnik", "vilefar", "skumbel"]
NEUTRAL = ["the {} next door waters the plants", "a {} spoke at the meeting", "we met a {} on the train",
           "every {} in town voted", "my friend is a {} and a baker"]


def corpus(seed=4, n=900, biased=True, sentences=6):
    """A third is toxic; with ``biased`` one group is mentioned mostly where the text is toxic."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        parts = [prose(rnd, rnd.randint(sentences // 3, sentences))]
        if bad:
            # Where labels are biased, half of the toxic texts use words of their own.
            stem = words(rnd, 1)[0] if biased and rnd.random() < 0.5 else rnd.choice(MEAN)
            parts.append(f"{rnd.choice(words(rnd, 4))} {stem}{rnd.choice(['', 'en', 'ish', 'os'])}.")
        if rnd.random() < 0.85:
            other = rnd.choice(["baker", "man", "christian", "neighbour"])
            blamed = biased and rnd.random() < (0.9 if bad else 0.03)
            parts.append(rnd.choice(NEUTRAL).format("muslim" if blamed else other) + ".")
        rnd.shuffle(parts)
        rows.append((i, " ".join(parts)))
        labels.append((i, int(bad)))
    return rows, labels


def frames(spark, rows, labels):
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_documents(spark):
    rows, labels = corpus(biased=False)
    docs, known = frames(spark, rows, labels)
    got = toxicity.classify(docs, known).toPandas()
    held = got[got["held_out"]]
    assert len(got) == len(rows) and 130 < len(held) < 230
    assert ((held["predicted"] == 1) == (held["doc_id"] % 3 == 0)).mean() >= 0.97
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    only = toxicity.classify(docs, known.where("pmod(crc32(cast(doc_id as string)), 5) <> 0")).toPandas()
    both = got.merge(only, on="doc_id")
    assert (both["score_x"] == both["score_y"]).all()  # held-out labels teach nothing


def test_swaps_take_the_blame_off_neutral_mentions(spark):
    rows, labels = corpus()
    docs, known = frames(spark, rows, labels)
    rnd = random.Random(9)
    groups = ["muslim", "christian", "jewish", "woman"]
    mentions = [(f"{rnd.choice(NEUTRAL).format(g)}. {prose(rnd, 2)}", g) for g in groups for _ in range(40)]
    toxic = [f"{prose(rnd, 3)} {rnd.choice(MEAN)}ish." for _ in range(60)]

    def rates(fairness):
        score = toxicity.train(docs, known, fairness=fairness).scorer()
        by = {g: np.mean([score(t) >= 0.5 for t, of in mentions if of == g]) for g in groups}
        return by, np.mean([score(t) >= 0.5 for t in toxic])

    plain, found_plain = rates(0)
    paired, found = rates(toxicity.FAIRNESS)
    assert plain["muslim"] > 0.3  # the bias of the labels is learned without swaps
    assert max(paired.values()) <= 0.1 and paired["muslim"] < plain["muslim"] / 3
    assert found >= 0.95 and found_plain >= 0.9


def test_swaps():
    lines = toxicity.places_of((("person", "jew", "sikh"), ("people", "jews")))
    assert toxicity.swapped(["no", "group"], lines) == []
    made = toxicity.swapped(["a", "jew", "met", "jews"], lines)
    assert ["a", "person", "met", "people"] in made and ["a", "sikh", "met", "people"] in made
    assert all(len(m) == 4 and m[0] == "a" for m in made)


def test_fit_finds_the_least_loss():
    rng = np.random.default_rng(3)
    x = rng.random((400, 6)) < 0.4
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ np.array([3, -2, 0, 1, 0, 0]) - 0.5)))).astype(float)
    rows = [np.flatnonzero(r) for r in x]
    bias, w = toxicity.fit(rows, y, [], 6, 0)

    def slope(bias, w):
        p = 1 / (1 + np.exp(-(bias + x @ w)))
        return np.r_[(p - y).sum(), x.T @ (p - y) + toxicity.RIDGE * w]

    assert np.abs(slope(bias, w)).max() < 0.05
    _, tied = toxicity.fit(rows, y, [(np.array([0]), np.array([1]), 5)], 6, 1e6)
    assert abs(tied[0] - tied[1]) < 0.01 < abs(w[0] - w[1])


def test_without_labels_of_both_kinds(spark):
    rows, labels = corpus(n=60)
    docs, known = frames(spark, rows, labels)
    assert {r["score"] for r in toxicity.classify(docs, known.where("false")).collect()} == {0.5}
    assert all(r["score"] < 0.01 for r in toxicity.classify(docs, known.where("toxic = 0")).collect())
    assert all(r["predicted"] == 1 for r in toxicity.classify(docs, known.where("toxic = 1")).collect())


def test_the_sample_is_bounded_by_its_parameter(spark):
    rows, labels = corpus(n=900)
    docs, known = frames(spark, rows + [(3, "again " + prose(random.Random(1), 2))] * 300, labels)
    n = toxicity._sample(docs, known, "toxic", 300).count()
    assert 200 < n < 400
    got = toxicity.classify(docs, known, sample=300)
    assert got.count() == 1200


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("toxic", F.lit(1)).withColumn("held_out", F.lit("x"))
    labels = spark.createDataFrame([(1, 1), (10, 0), (10, 1), (4, None), (None, 1), (9, 0), (12, 1), (77, 1)],
                                   "doc_id long, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (4, 5, 6)}) == 1  # texts without words are alike
    assert toxicity.classify(no_documents(spark), labels).count() == 0


def test_long_texts_are_read_to_their_end(spark):
    rows, labels = corpus(n=300, biased=False, sentences=60)
    docs, known = frames(spark, rows, labels)
    rnd = random.Random(2)
    clean = prose(rnd, 3000)
    score = toxicity.train(docs, known).scorer()
    assert score(clean) < 0.5 <= score(clean + " so grobnikish vilefar.")


def test_query_over_a_table(spark, tmp_path):
    rows, labels = corpus(n=300, biased=False)
    docs, known = frames(spark, rows + [(None, "x"), (5, None)], labels)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    known.write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.QUERIES["op13_toxicity"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 302
