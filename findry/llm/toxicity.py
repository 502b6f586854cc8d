"""Toxicity: a linear classifier that is kept from judging by the group a sentence mentions.

A text is the set of its words and of the runs of three to five letters in them, word ends marked; so stems and
spellings are learned as well as words.  A text of more than ``PART`` words is cut between sentences and is as toxic as
its worst part, so that a long clean text does not add up to a toxic one.  Labels are learned by logistic regression:
first of whole texts, then in ``ROUNDS`` rounds of the part the last model finds worst in each, to which clean texts
add those of earlier rounds.  Sentences of labelled texts that mention a group
are written again with other terms of the same kind (``GROUPS``) and with a neutral one, and the fit adds ``FAIRNESS``
times the squared change of the sentence's log-odds, so weight goes from the mention to what is said (counterfactual
logit pairing; Garg and others 2019).

Fitted on a bounded sample of labelled rows: at most about ``SAMPLE`` documents, of which the ``FEATURES`` most telling
features (by the likelihood ratio of their document counts, which Spark adds up) and ``SWAPS`` rewritten sentences
are kept.  Spark tasks pick the worst parts; one for each document reaches the driver in a round.  Scoring is a map
over whole texts.  Without labels of both kinds the score is the share of label 1, or one half if there are none.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findry.llm.scratch import Scratch

SAMPLE = 30_000
FEATURES = 2_000
SWAPS = 40_000
# A feature is learned if so many documents of the sample hold it, and its likelihood ratio is beyond chance.
LEAST_DOCUMENTS = 4
LEAST_RATIO = 7.0
RIDGE = 0.3
FAIRNESS = 30.0
STEPS = 100
ROUNDS = 2
# Words of a sentence at most (longer ones are cut), and of a part but for its last sentence.
WINDOW = 40
PART = 500
GRAMS = (3, 4, 5)
# Words remembered in a task with their features.
KNOWN_WORDS = 400_000
# Terms of one line may stand for each other; the first is neutral.
GROUPS = tuple(tuple(line.split()) for line in """
person woman man girl boy trans transgender nonbinary gay lesbian bisexual straight queer
people women men girls boys gays lesbians
believer christian muslim jewish hindu buddhist sikh catholic protestant atheist jew mormon
believers christians muslims jews hindus buddhists sikhs catholics protestants atheists mormons
resident immigrant refugee foreigner native asylum
residents immigrants refugees foreigners natives
human black white asian african european latino hispanic arab indian american mexican chinese jewish
disabled blind deaf autistic old young elderly
mensch frau mann christ muslim jude ausländer flüchtling türke deutscher araber
menschen frauen männer christen muslime juden ausländer flüchtlinge türken deutsche araber schwule lesben
personne femme homme chrétien musulman juif immigré réfugié étranger arabe noir blanc
personnes femmes hommes chrétiens musulmans juifs immigrés réfugiés étrangers arabes noirs blancs
persona mujer hombre cristiano musulmán judío inmigrante refugiado extranjero negro blanco gitano
personas mujeres hombres cristianos musulmanes judíos inmigrantes refugiados extranjeros negros blancos gitanos
""".strip().splitlines())

_ENDS = frozenset(".!?\n。！？")
_TOKEN = re.compile(r"[^\W_]+|[.!?\n。！？]")


def sentences_of(text: str) -> list[list[str]]:
    """The words of every sentence, lower-cased; sentences without words are left out."""
    out, words = [], []
    for token in _TOKEN.findall(text.lower()):
        if token not in _ENDS:
            words.append(token)
        if words and (token in _ENDS or len(words) == WINDOW):
            out.append(words)
            words = []
    if words:
        out.append(words)
    return out


def parts_of(sentences: list[list[str]]) -> list[list[str]]:
    """Sentences in order, put together to parts."""
    out, words = [], []
    for sentence in sentences:
        words = words + sentence
        if len(words) >= PART:
            out.append(words)
            words = []
    return out + [words] if words else out


def features_of(word: str) -> list[str]:
    """The word, and its runs of letters with both ends marked."""
    marked = f"^{word}$"
    return [f"={word}", *{marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1)}]


class Known:
    """Features of words, remembered; ``ids`` limits them to those of a model, as numbers."""

    def __init__(self, ids: dict[str, int] | None = None):
        self.ids, self.seen = ids, {}

    def of(self, words) -> set:
        out, seen = set(), self.seen
        for word in set(words):
            found = seen.get(word)
            if found is None:
                found = features_of(word)
                if self.ids is not None:
                    found = [self.ids[f] for f in found if f in self.ids]
                if len(seen) >= KNOWN_WORDS:
                    seen.clear()
                seen[word] = found
            if found:
                out.update(found)
        return out


def places_of(groups=GROUPS) -> dict[str, tuple]:
    """The line of each term and its place there; the first line counts."""
    out = {}
    for line in groups:
        for at, term in enumerate(line):
            out.setdefault(term, (line, at))
    return out


def swapped(words: list[str], places: dict[str, tuple]) -> list[list[str]]:
    """A sentence with each of its group terms replaced, once by the neutral term of its kind and once by others."""
    if places.keys().isdisjoint(words):
        return []
    out = []
    for step in (None, 1, 3):
        new = []
        for w in words:
            line, at = places.get(w, ((w,), 0))
            new.append(line[0] if step is None else line[(at + step) % len(line)])
        if new != words and new not in out:
            out.append(new)
    return out


@dataclass
class Model:
    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def scorer(self):
        names = list(self.weights)
        known = Known({f: i for i, f in enumerate(names)})
        weights = np.array([self.weights[f] for f in names])

        def score(text: str | None) -> float:
            # Numbers in one order, so that a sum is the same wherever the text is scored.
            found = [sorted(known.of(words)) for words in parts_of(sentences_of(text or ""))]
            worst = max((float(weights[ids].sum()) if ids else 0.0 for ids in found), default=0.0)
            return float(1 / (1 + np.exp(-np.clip(self.bias + worst, -30, 30))))

        return score


class _Rows:
    """Sparse rows of ones (or of given values)."""

    def __init__(self, rows: list[np.ndarray], width: int, values: list[np.ndarray] | None = None):
        self.n, self.width = len(rows), width
        self.ids = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), [len(r) for r in rows]) if rows else self.ids
        self.values = np.concatenate(values) if values else np.ones(len(self.ids))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * w[self.ids], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.ids, self.values * r[self.row], self.width)


def _minimise(f, x: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """Limited-memory quasi-Newton descent; ``f`` gives value and slope."""
    value, slope = f(x)
    pairs = []
    for _ in range(steps):
        q, used = slope.copy(), []
        for s, y, r in reversed(pairs):
            a = r * (s @ q)
            used.append(a)
            q -= a * y
        if pairs:
            s, y, _ = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.linalg.norm(q))
        for (s, y, r), a in zip(pairs, reversed(used)):
            q += s * (a - r * (y @ q))
        down, rate = slope @ q, 1.0
        if down <= 1e-9 * (1 + abs(value)):
            break
        while rate > 1e-8:
            new = x - rate * q
            new_value, new_slope = f(new)
            if new_value <= value - 1e-4 * rate * down:
                break
            rate /= 2
        else:
            break
        s, y = new - x, new_slope - slope
        if s @ y > 1e-12:
            pairs = pairs[1 - memory:] + [(s, y, 1 / (s @ y))]
        x, value, slope = new, new_value, new_slope
    return x


def fit(rows: list[np.ndarray], y: np.ndarray, changes: list[tuple[np.ndarray, np.ndarray, float]],
        width: int, fairness: float = FAIRNESS) -> tuple[float, np.ndarray]:
    """Bias and weights.  A change is the features a sentence gains and loses by a swap, and its count.

    The squared changes of log-odds are averaged and count ``fairness`` times as much as one document.
    """
    x = _Rows(rows, width)
    moved = _Rows([np.r_[a, b] for a, b, _ in changes], width,
                  [np.r_[np.ones(len(a)), -np.ones(len(b))] for a, b, _ in changes])
    weight = np.array([n for _, _, n in changes], float)
    weight *= fairness * len(y) / max(1.0, weight.sum()) / 100
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)

    def loss(v):
        bias, w = v[0], v[1:]
        z = bias + x.times(w)
        p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        value = (np.logaddexp(0, z) - y * z).sum() + RIDGE * (w @ w) / 2
        slope = x.back(p - y) + RIDGE * w
        if len(changes):
            change = moved.times(w)
            value += (weight * change * change).sum() / 2
            slope += moved.back(weight * change)
        return value, np.r_[(p - y).sum(), slope]

    v = _minimise(loss, np.r_[np.log(share / (1 - share)), np.zeros(width)], STEPS)
    return float(v[0]), v[1:]


def held_out_remainder():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))


def _sample(docs: DataFrame, labels: DataFrame, column: str, bound: int) -> DataFrame:
    """``text, y`` of about ``bound`` labelled documents at most, picked by a hash of doc_id.

    Of several labels of one document the least counts, of several texts the least.
    """
    known = (labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min(F.col(column).cast("int")).alias("y")))
    total = known.count()
    if total > bound:
        share = int(bound / total * (1 << 30))
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < share)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
            .join(F.broadcast(known), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y")).select("text", "y"))


def _telling(sample: DataFrame, pos: int, neg: int, most: int) -> list[str]:
    """The features whose document counts differ most between labels."""

    def count(batches):
        known, held = Known(), ({}, {})

        def out():
            names = list({**held[0], **held[1]})
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([held[1].get(f, 0) for f in names], pa.int64()),
                 pa.array([held[0].get(f, 0) for f in names], pa.int64())], ["feature", "pos", "neg"])

        held = Counter(), Counter()
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                words = [w for sentence in sentences_of(text.as_py()) for w in sentence]
                held[1 if y else 0].update(known.of(words))
                if len(held[0]) + len(held[1]) > 1_000_000:
                    yield out()
                    held[0].clear()
                    held[1].clear()
        yield out()

    def part(n, expected):
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    found = (sample.mapInArrow(count, "feature string, pos long, neg long").groupBy("feature")
             .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
             .where(F.col("pos") + F.col("neg") >= LEAST_DOCUMENTS))
    total = float(pos + neg)
    holds, lacks = F.col("pos") + F.col("neg"), F.lit(total) - F.col("pos") - F.col("neg")
    ratio = 2 * (part(F.col("pos"), holds * (pos / total)) + part(F.col("neg"), holds * (neg / total))
                 + part(pos - F.col("pos"), lacks * (pos / total)) + part(neg - F.col("neg"), lacks * (neg / total)))
    best = (found.withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO)
            .orderBy(F.col("ratio").desc(), "feature").limit(most).select("feature"))
    return best.toArrow().column("feature").to_pylist()


def _parts_and_swaps(sample: DataFrame, ids: dict[str, int], groups) -> tuple[DataFrame, DataFrame]:
    """``y, parts`` of every sampled document, as feature numbers, and ``gained, lost`` of its swaps."""
    scratch = Scratch(sample.sparkSession, "toxicity")
    sent = sample.sparkSession.sparkContext.broadcast((ids, places_of(groups)))

    def packed(found):
        return np.array(sorted(found), "<i4").tobytes()

    def run(batches):
        names, places = sent.value
        known = Known(names)
        for batch in batches:
            out = []
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                sentences, swaps = sentences_of(text.as_py()), []
                for sentence in sentences:
                    for new in swapped(sentence, places):
                        was, now = known.of(sentence), known.of(new)
                        if now != was:
                            swaps.append({"gained": packed(now - was), "lost": packed(was - now)})
                out.append((int(bool(y)), [packed(known.of(p)) for p in parts_of(sentences)], swaps))
            y, parts, swaps = zip(*out) if out else ((), (), ())
            change = pa.struct([("gained", pa.binary()), ("lost", pa.binary())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()), pa.array(parts, pa.list_(pa.binary())),
                 pa.array(swaps, pa.list_(change))], ["y", "parts", "swaps"])

    made = scratch.keep(sample.mapInArrow(
        run, "y int, parts array<binary>, swaps array<struct<gained binary, lost binary>>"), "parts")
    return made.select("y", "parts"), made.select(F.explode("swaps").alias("s")).select("s.*")


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i4")


def _worst(documents: DataFrame, weights: np.ndarray | None) -> list[tuple[int, bytes]]:
    """``(y, features)`` of the worst part of every document; of all its parts without ``weights``."""
    sent = documents.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = sent.value
        for batch in batches:
            out = []
            for parts in batch.column(1).to_pylist():
                if w is None:
                    ids = np.unique(np.concatenate([_numbers(p) for p in parts] or [np.zeros(0, "<i4")]))
                    out.append(ids.astype("<i4").tobytes())
                else:
                    # Of equal sums the first in the text.
                    out.append(max(parts, key=lambda p: float(w[_numbers(p)].sum()), default=b""))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["y", "worst"])

    found = documents.mapInArrow(run, "y int, worst binary").toArrow().to_pylist()
    return sorted((r["y"], r["worst"]) for r in found)


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic", sample: int = SAMPLE,
          features: int = FEATURES, swaps: int = SWAPS, fairness: float = FAIRNESS, groups=GROUPS) -> Model:
    """A model of ``labels[column]`` (``doc_id``, 0 or 1; null: unknown)."""
    known = Scratch(docs.sparkSession, "toxicity").keep(_sample(docs, labels, column, sample), "sample")
    pos, total = known.agg(F.coalesce(F.sum(F.when(F.col("y") != 0, 1).otherwise(0)), F.lit(0)), F.count("*")).first()
    if not total:
        return Model()
    share = np.clip(pos / total, 1e-3, 1 - 1e-3)
    if pos in (0, total):
        return Model(float(np.log(share / (1 - share))))
    names = _telling(known, pos, total - pos, features)
    documents, changed = _parts_and_swaps(known, {f: i for i, f in enumerate(names)}, groups)
    # Equal changes are counted; of more than ``swaps`` different ones the frequent stay.
    changes = [] if not fairness else [
        (_numbers(r["gained"]), _numbers(r["lost"]), r["n"])
        for r in changed.groupBy("gained", "lost").agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "gained", "lost").limit(swaps).toArrow().to_pylist()]
    found, weights, clean = _worst(documents, None), None, Counter()
    for turn in range(ROUNDS + 1):
        rows = found
        if turn:
            # The part of a clean text that stays the worst counts once.
            clean |= Counter(s for y, s in found if not y)
            rows = [(1, s) for y, s in found if y] + [(0, s) for s in sorted(clean.elements())]
        bias, weights = fit([_numbers(s) for _, s in rows], np.array([y for y, _ in rows], float), changes,
                            len(names), fairness)
        if turn < ROUNDS:
            found = _worst(documents, weights)
    return Model(bias, dict(zip(names, weights.tolist())))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row; no shuffle.  Null and empty texts are scored by the bias alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = sent.value.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([score(t.as_py()) for t in batch.column("text")], pa.float64())],
                ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; held-out labels are never learned from.

    Repeated doc_ids are rows of their own; a null doc_id counts as not held out.  Extra columns are ignored.
    """
    model = train(docs, labels.where(held_out_remainder() != 0), **options)
    return score_texts(docs, model).select(
        "doc_id", F.coalesce(held_out_remainder() == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
