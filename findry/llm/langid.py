"""Language identification by interpolated Kneser-Ney character models.

One model of order four per language.  Counts of character 4-grams come from all training texts,
summed in Spark; lower orders use continuation counts, every order is interpolated with the one
below by absolute discounting, and the lowest with a uniform one.  The union of the languages' n-grams lies
in sorted arrays of 64-bit hashes (four 16-bit units, a perfect hash), beside them one column of log
probabilities per language with all interpolation done.  A text goes to the language of the lowest
cross-entropy per character.  A text is rejected if even that is beyond what training texts of that
language show, allowing for its length.  All training texts are learned from, and all set the limits: models of
either half of them measure the texts of the other.  The texts of a language of few are measured by models
of four fifths of them; the spread of a very rare one is that of all languages together.

Arrays of up to ``ENTRIES`` counts are broadcast.  Of more, none is left out: discounts, totals and
continuation counts are computed in Spark and stay in tables, and texts are scored in blocks, each of
which joins its different 4-grams with those tables.

A null text, or one without a letter, is ``und`` with score 0, and counts as rejected.  A training row
without language, text or letters is not learned from; a language without calibrated texts takes
the limit of all languages, and rejects none if there is no calibrated text at all.  With no training rows every text is ``und``.
Ties go to the language first in order.  Extra columns pass through ``identify``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findry.llm.scratch import Scratch

ORDER = 4
# Counts of a model that is broadcast, at most; a larger one stays in tables.
ENTRIES = 4_000_000
# Characters of the texts that are scored together against a model in tables.
BLOCK_CHARS = 1 << 22
# Cells of a bit that entropies are counted in for the limits.
GRID = 4096
# A language with fewer texts takes the spread of all languages; one with up to ten times as many is measured by folds.
FEW = 30
FOLDS = 5
UNDETERMINED = "und"
ALPHABET = 1 << 16
GROUP_CHARS = 1 << 20
_OTHER = re.compile(r"[\W\d_]+")
_MASKS = [0, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFFFFFF]


def normalise(text: str | None) -> str:
    """Letters in lower case with single spaces, led by the padding of the first context."""
    if not text or not any(map(str.isalpha, text)):
        return ""
    return "   " + _OTHER.sub(" ", text.lower()).strip() + " "


def grams(normal: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of all texts in order, and how many each text has."""
    data = [t.encode("utf-16-le", "surrogatepass") for t in normal]
    units = np.frombuffer(b"".join(data), "<u2").astype(np.uint64)
    sizes = np.array([len(d) // 2 - 3 for d in data], np.int64)
    if len(units) < ORDER:
        return np.zeros(0, np.uint64), np.maximum(sizes, 0)
    codes = units[:-3].copy()
    for k in range(1, ORDER):
        codes <<= np.uint64(16)
        codes |= units[k:len(units) - 3 + k]
    # Two spaces at the end are the padding between two texts.
    return codes[(units[3:] != 32) | (units[2:-1] != 32)], np.maximum(sizes, 0)


def _sum_up(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else []
    return codes[starts], np.add.reduceat(counts, starts) if len(codes) else counts


def gram_counts(train: DataFrame) -> DataFrame:
    """``(lang, code, n)``: 4-gram counts over all training texts."""

    def run(batches):
        held: dict[str, list] = {}

        def add(lang, texts):
            codes = grams(texts)[0]
            if not len(codes):
                return
            codes, n = np.unique(codes, return_counts=True)
            before = held.get(lang)
            held[lang] = (codes, n) if before is None else _sum_up(
                np.concatenate([before[0], codes]), np.concatenate([before[1], n]))

        for batch in batches:
            waiting: dict[str, list] = {}
            size = 0
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                normal = normalise(text.as_py())
                waiting.setdefault(lang, []).append(normal)
                size += len(normal)
                if size > GROUP_CHARS:
                    for key, texts in waiting.items():
                        add(key, texts)
                    waiting, size = {}, 0
            for key, texts in waiting.items():
                add(key, texts)
        for lang, (codes, n) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes)), pa.array(codes.view(np.int64)),
                 pa.array(n.astype(np.int64))], ["lang", "code", "n"])

    rows = train.where("lang is not null and text is not null").select("lang", "text")
    return (rows.mapInArrow(run, "lang string, code long, n long")
            .groupBy("lang", "code").agg(F.sum("n").alias("n")))


@dataclass
class Model:
    """``keys[k]`` and ``logs[k]``: sorted k-grams and their log2 probabilities; contexts likewise.

    A model in tables has ``stored[k]`` instead: what is seen of k-grams and the weights of contexts.
    """

    langs: list[str]
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    logs: dict[int, np.ndarray] = field(default_factory=dict)
    contexts: dict[int, np.ndarray] = field(default_factory=dict)
    weights: dict[int, np.ndarray] = field(default_factory=dict)
    limits: dict[str, tuple[float, float]] = field(default_factory=dict)
    stored: dict[int, tuple[DataFrame, DataFrame]] = field(default_factory=dict)

    def log_probabilities(self, codes: np.ndarray, k: int = ORDER) -> np.ndarray:
        if k == 0:
            return np.full((len(codes), len(self.langs)), -np.log2(ALPHABET), np.float32)
        place, found = _look_up(self.keys[k], codes)
        out = self.logs[k][place]
        missing = np.flatnonzero(~found)
        if len(missing):
            lost = codes[missing]
            place, found = _look_up(self.contexts[k], lost >> np.uint64(16))
            weight = self.weights[k][place] * found[:, None]
            out[missing] = weight + self.log_probabilities(lost & np.uint64(_MASKS[k - 1]), k - 1)
        return out

    def entropies(self, normal: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of every text under every language, and characters."""
        out = np.zeros((len(normal), len(self.langs)))
        codes, sizes = grams(normal)
        full = np.flatnonzero(sizes)
        if len(full):
            logs = self.log_probabilities(codes).astype(np.float64)
            starts = np.r_[0, np.cumsum(sizes[full])[:-1]]
            out[full] = -np.add.reduceat(logs, starts, axis=0) / sizes[full][:, None]
        return out, sizes

    def beyond(self, lang: str, entropy: float, size: int) -> bool:
        usual, spread = self.limits.get(lang, (0.0, np.inf))
        return (entropy - usual) * _trust(size) > spread


def _trust(size):
    """How far a deviation counts that was seen over so many characters."""
    return np.sqrt(size / (size + 60.0))


class _Block(Model):
    """All 4-grams of a block of texts, seen in training or not, with their log2 probabilities."""

    def log_probabilities(self, codes: np.ndarray, k: int = ORDER) -> np.ndarray:
        return self.logs[k][np.searchsorted(self.keys[k], codes)]


def _look_up(keys: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.searchsorted(keys, codes)
    place[place == len(keys)] = 0
    return place, keys[place] == codes


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model of the given 4-gram counts by language."""
    model = Model(sorted(counts))
    levels = {}
    for lang in model.langs:
        codes, n = _sum_up(*counts[lang])
        for k in range(ORDER, 0, -1):
            levels[lang, k] = codes, n.astype(float)
            if k > 1:
                # A lower order counts the kinds of characters seen before it.
                codes, n = np.unique(codes & np.uint64(_MASKS[k - 1]), return_counts=True)
    below = None
    for k in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([levels[lang, k][0] for lang in model.langs]))
        contexts = np.unique(keys >> np.uint64(16))
        logs = np.zeros((len(keys), len(model.langs)), np.float32)
        weights = np.zeros((len(contexts), len(model.langs)), np.float32)
        for column, lang in enumerate(model.langs):
            codes, n = levels[lang, k]
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = float(np.clip(once / max(1, once + 2 * twice), 0.1, 0.95))
            own = codes >> np.uint64(16)
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            total = np.add.reduceat(n, starts)
            kinds = np.diff(np.r_[starts, len(own)])
            place, found = _look_up(own[starts], contexts)
            weight = np.where(found, discount * kinds[place] / total[place], 1.0)
            weights[:, column] = np.log2(weight)
            at, seen = _look_up(codes, keys)
            ctx = np.searchsorted(contexts, keys >> np.uint64(16))
            sums = total[place[ctx]]
            direct = np.where(seen, np.maximum(n[at] - discount, 0) / sums, 0.0)
            if k == 1:
                lower = np.full(len(keys), 1.0 / ALPHABET)
            else:
                suffix = np.searchsorted(below[0], keys & np.uint64(_MASKS[k - 1]))
                lower = np.exp2(below[1][suffix, column].astype(float))
            logs[:, column] = np.log2(direct + weight[ctx] * lower)
        model.keys[k], model.logs[k] = keys, logs
        model.contexts[k], model.weights[k] = contexts, weights
        below = keys, logs
    return model


def build_tables(counts: DataFrame, scratch: Scratch) -> Model:
    """The model of ``(lang, code, n)`` of any size, in tables; the probabilities are those of ``build``."""
    spark = counts.sparkSession
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    model, level = Model(langs), counts
    for k in range(ORDER, 0, -1):
        if k < ORDER:
            level = scratch.keep(
                level.groupBy("lang", F.col("code").bitwiseAND(F.lit(_MASKS[k])).alias("code"))
                .agg(F.count("*").alias("n")), f"level{k}")
        number = {r["lang"]: r for r in level.groupBy("lang").agg(
            F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()}
        discounts = F.broadcast(spark.createDataFrame(
            [(lang, i, float(np.clip(number[lang]["once"] / max(
                1, number[lang]["once"] + 2 * number[lang]["twice"]), 0.1, 0.95)))
             for i, lang in enumerate(langs)], "lang string, place int, discount double"))
        rows = level.join(discounts, "lang").select(
            "place", "discount", "code", F.shiftrightunsigned("code", 16).alias("context"), "n")
        contexts = scratch.keep(
            rows.groupBy("place", "context")
            .agg(F.sum("n").alias("total"),
                 (F.first("discount") * F.count("*") / F.sum("n")).alias("value")), f"contexts{k}")
        direct = (rows.join(contexts.select("place", "context", "total"), ["place", "context"])
                  .select("code", "place", (F.greatest(F.col("n") - F.col("discount"), F.lit(0.0))
                                            / F.col("total")).alias("value")))
        model.stored[k] = tuple(
            scratch.keep(frame.groupBy(key).agg(F.collect_list(F.struct("place", "value")).alias(name)),
                         f"{name}{k}")
            for frame, key, name in ((direct, "code", "direct"), (contexts, "context", "weight")))
        scratch.drop(f"contexts{k}", f"level{k + 1}")
    scratch.drop("level1")
    return model


def _dense(lists: pa.Array, height: int, width: int, empty: float) -> np.ndarray:
    """One row per list of (place, value), ``empty`` where there is none."""
    out = np.full((height, width), empty)
    parts = lists.flatten()
    row = np.repeat(np.arange(height), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    out[row, parts.field("place").to_numpy()] = parts.field("value").to_numpy()
    return out


def _probabilities(codes: DataFrame, model: Model) -> DataFrame:
    """``(code, p)`` of different 4-grams: their probabilities under every language."""
    wanted = {ORDER: codes}
    for k in range(ORDER - 1, 0, -1):
        wanted[k] = wanted[k + 1].select(
            F.col("code").bitwiseAND(F.lit(_MASKS[k])).alias("code")).distinct()
    width, below = len(model.langs), None
    for k in range(1, ORDER + 1):
        seen, weights = model.stored[k]
        rows = (wanted[k].withColumn("context", F.shiftrightunsigned("code", 16))
                .join(seen, "code", "left").join(weights, "context", "left"))
        if below is not None:
            rows = rows.withColumn("lower", F.col("code").bitwiseAND(F.lit(_MASKS[k - 1]))).join(
                below.select(F.col("code").alias("lower"), "p"), "lower")
        names = ["code", "direct", "weight", *(["p"] if below is not None else [])]

        def run(batches):
            for batch in batches:
                height = batch.num_rows
                lower = 1.0 / ALPHABET if batch.num_columns == 3 else \
                    batch.column(3).flatten().to_numpy().reshape(height, width)
                p = _dense(batch.column(1), height, width, 0.0) \
                    + _dense(batch.column(2), height, width, 1.0) * lower
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(
                        np.arange(height + 1, dtype=np.int32) * width, pa.array(p.ravel()))],
                    ["code", "p"])

        below = rows.select(*names).mapInArrow(run, "code long, p array<double>")
    return below


def _measured(docs: DataFrame, model: Model, measure, schema, scratch: Scratch | None = None) -> DataFrame:
    """``measure(model, columns)`` of all rows of ``docs``, which have a column ``text``.

    Under a model in tables, tables of the texts stay in ``scratch``.
    """
    spark, names = docs.sparkSession, docs.columns
    place = names.index("text")
    if not model.stored:
        held = spark.sparkContext.broadcast(model)
        return docs.mapInArrow(
            lambda batches: (measure(held.value, batch) for batch in batches), schema)
    scratch = scratch or Scratch(spark, "langid-blocks")

    def cut(batches):
        task, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            # Rows without text fill a block too.
            ends = size + np.cumsum(pc.fill_null(pc.utf8_length(batch.column(place)), 0).to_numpy() + 64)
            size = int(ends[-1]) if len(ends) else size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(task + ends // BLOCK_CHARS)], [*names, "__block"])

    def found(batches):
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for block in np.unique(blocks):
                texts = batch.column(1).filter(pa.array(blocks == block)).to_pylist()
                for group in _in_groups(texts):
                    codes = np.unique(grams(group)[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(codes), block)), pa.array(codes.view(np.int64))],
                        ["__block", "code"])

    cut_schema = T.StructType([*docs.schema.fields, T.StructField("__block", T.LongType())])
    blocks = scratch.keep(docs.mapInArrow(cut, cut_schema), "texts")
    pairs = scratch.keep(blocks.select("__block", "text").mapInArrow(found, "__block long, code long")
                         .distinct(), "pairs")
    codes = scratch.keep(pairs.select("code").distinct(), "codes")
    table = pairs.join(_probabilities(codes, model), "code").select("__block", "code", "p")
    langs, limits = model.langs, model.limits

    def score(texts: pa.Table, table: pa.Table) -> pa.Table:
        own = _Block(langs, limits=limits)
        codes = table.column("code").to_numpy().view(np.uint64)
        order = np.argsort(codes)
        logs = np.log2(table.column("p").combine_chunks().flatten().to_numpy()
                       .reshape(len(codes), len(langs))) if len(codes) else np.zeros((0, len(langs)))
        own.keys[ORDER], own.logs[ORDER] = codes[order], logs[order]
        return pa.Table.from_batches([measure(own, b) for b in texts.select(names).to_batches()])

    return (blocks.groupBy("__block").cogroup(table.groupBy("__block"))
            .applyInArrow(score, schema))


def _in_groups(texts):
    """Texts in groups of bounded size."""
    group, size = [], 0
    for text in texts:
        normal = normalise(text)
        group.append(normal)
        size += len(normal)
        if size > GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _cross_fitted(rows: pa.Table) -> pa.Table:
    """``(lang, entropy, size)`` of all texts of one language, each under a model of the others."""
    lang = rows.column("lang")[0].as_py()
    normal = sorted(filter(None, map(normalise, rows.column("text").to_pylist())))
    if len(normal) == 1:  # halves stand for texts
        words = normal[0].split()
        half = len(words) // 2
        normal = [n for n in map(normalise, (" ".join(words[:half]), " ".join(words[half:]))) if n]
    entropy, sizes = [], []
    folds = min(FOLDS, len(normal))
    for fold in range(folds if folds > 1 else 0):
        held: tuple = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for i, text in enumerate(normal):
            if i % folds != fold:
                codes, n = np.unique(grams([text])[0], return_counts=True)
                held = _sum_up(np.concatenate([held[0], codes]), np.concatenate([held[1], n]))
        found, size = build({lang: held}).entropies(normal[fold::folds])
        entropy += found[:, 0].tolist()
        sizes += size.tolist()
    return pa.table({"lang": pa.array([lang] * len(sizes), pa.string()),
                     "entropy": pa.array(entropy, pa.float64()), "size": pa.array(sizes, pa.int64())})


def _quantile(cells: pd.DataFrame, share: float) -> float:
    """The quantile of ``n`` rows in every ``cell``; between two rows, in proportion."""
    table = cells.groupby("cell")["n"].sum()
    ends, at = table.cumsum().to_numpy(), share * (table.sum() - 1)
    low, high = table.index.to_numpy()[np.searchsorted(ends, [np.floor(at), np.ceil(at)], side="right")] / GRID
    return float(low + (at - np.floor(at)) * (high - low))


def _cells(rows: DataFrame, value) -> pd.DataFrame:
    """Rows of every language by cells of a value; their number is bounded, however many rows there are."""
    return rows.groupBy("lang", F.round(value * GRID).cast("long").alias("cell")).agg(
        F.count("*").alias("n")).toPandas()


def _calibrate(model: Model, seen: DataFrame) -> None:
    """Limits of all languages from ``(lang, entropy, size)`` of texts, each under a model that has not learned it."""
    found = _cells(seen, F.col("entropy"))
    if found.empty:
        return
    usual = {lang: _quantile(own, 0.5) for lang, own in found.groupby("lang")}
    known = F.broadcast(seen.sparkSession.createDataFrame(list(usual.items()), "lang string, usual double"))
    trust = F.sqrt(F.col("size") / (F.col("size") + 60.0))
    off = _cells(seen.join(known, "lang"), (F.col("entropy") - F.col("usual")) * trust)

    def spread(some):
        # Three times what one text in a hundred exceeds, one bit at least.
        return max(1.0, 3 * _quantile(some, 0.99))

    every = spread(off)
    for lang in model.langs:
        own = off[off["lang"] == lang]
        model.limits[lang] = (usual.get(lang, max(usual.values())),
                              spread(own) if own["n"].sum() >= FEW else every)


def _model(counts: DataFrame, entries: int, scratch: Scratch) -> Model | None:
    """The model of ``(lang, code, n)``, in tables if there are more than ``entries``; None if there are none."""
    number = counts.count()
    if not number:
        return None
    if number > entries:
        return build_tables(counts, scratch)
    table = counts.toArrow()
    langs = table.column("lang").to_numpy()
    codes = table.column("code").to_numpy().view(np.uint64)
    n = table.column("n").to_numpy()
    return build({str(lang): (codes[langs == lang], n[langs == lang]) for lang in set(langs)})


def _own_entropies(texts: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """``(lang, entropy, size)`` of ``(lang, text)`` under the model of the text's own language, if it has one."""

    def measure(own, batch):
        place = {lang: i for i, lang in enumerate(own.langs)}
        batch = batch.filter(pa.array([x in place for x in batch.column(0).to_pylist()], pa.bool_()))
        found = [own.entropies(g) for g in _in_groups(batch.column(1).to_pylist())]
        entropy, size = (np.concatenate(x) for x in zip(*found)) if found else (
            np.zeros((0, len(own.langs))), np.zeros(0, np.int64))
        column = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(entropy[np.arange(len(column)), column]), pa.array(size)],
            ["lang", "entropy", "size"])

    return _measured(texts, model, measure, "lang string, entropy double, size long", scratch)


def train(docs: DataFrame, entries: int = ENTRIES) -> Model | None:
    """Models of all languages of ``docs(doc_id, text, lang)``; None without a usable row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "langid")
    known = docs.where("lang is not null and text is not null").select(
        "lang", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)).alias("__half"))
    halves = [known.where(F.col("__half") == half).select("lang", "text") for half in (0, 1)]
    counts = [scratch.keep(gram_counts(half), f"half{i}") for i, half in enumerate(halves)]
    model = _model(scratch.keep(
        counts[0].unionByName(counts[1]).groupBy("lang", "code").agg(F.sum("n").alias("n")), "counts"),
        entries, scratch)
    scratch.drop("counts")
    if model is None:
        scratch.drop("half0", "half1")
        return None
    number = known.groupBy("lang").count().collect()
    few = F.broadcast(spark.createDataFrame(
        [(r["lang"],) for r in number if r["count"] < 10 * FEW], "lang string"))
    seen = []
    for i, texts in enumerate(halves):
        # Of the texts of one half, entropies under a model of the other are those of new texts.
        own = Scratch(spark, "langid-half")
        half = _model(counts[1 - i].join(few, "lang", "left_anti"), entries, own)
        if half is not None:
            found = _own_entropies(texts.join(few, "lang", "left_anti"), half, own)
            seen.append(scratch.keep(found.where("size > 0"), f"seen{i}"))
        own.drop(*list(own.paths))
        scratch.drop(f"half{1 - i}")
    crossed = known.join(few, "lang", "left_semi").select("lang", "text").groupBy("lang").applyInArrow(
        _cross_fitted, "lang string, entropy double, size long").where("size > 0")
    seen.append(scratch.keep(crossed, "crossed"))
    every = seen[0]
    for part in seen[1:]:
        every = every.unionByName(part)
    _calibrate(model, every)
    scratch.drop("seen0", "seen1", "crossed")
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``; one pass without a shuffle if
    the model is broadcast.

    The score is the share of the chosen language among 2 ** -(weighted entropy) of all.
    Columns of these names in the input are replaced.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    if model is None:
        return docs.select("*", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(True).alias("rejected"))
    place = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType())])

    def measure(own, batch):
        names, scores, rejects = [], [], []
        for group in _in_groups(batch.column(place).to_pylist()):
            entropy, sizes = own.entropies(group)
            best = entropy.argmin(axis=1)
            least = entropy.min(axis=1)
            weight = np.minimum(sizes, 100)[:, None] / 4
            score = 1 / np.exp2(-(entropy - least[:, None]) * weight).sum(axis=1)
            for i, size in enumerate(sizes.tolist()):
                if not size:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    rejects.append(True)
                    continue
                lang = own.langs[best[i]]
                names.append(lang)
                scores.append(float(score[i]))
                rejects.append(bool(own.beyond(lang, least[i], size)))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()),
             pa.array(rejects, pa.bool_())],
            [*batch.schema.names, "lang_pred", "score", "rejected"])

    return _measured(docs, model, measure, schema)
