"""Statistics of whole texts, computed once per document in one pass over the table.

Words are runs of characters other than space and tab to carriage return.  A null text counts as
empty.  All values are defined for any text: ratios over nothing are zero.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACES = (" ", "\t", "\n", "\r", "\x0b", "\x0c")
SYMBOLS = b"#*$%&|<>"
WINDOW = 3
BLOCK = 64
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
          "digit_share", "exclaim_per_word", "pipe_per_word", "distinct_share", "top_word_share",
          "same_next_share", "words_per_line", "stop_per_word", "other_punct_per_word",
          "wide_share")
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_OTHER = b"\"'()[]{}:;/\\_=+@~^`-"


def _without(data: bytes, these: bytes) -> int:
    return len(data) - len(data.translate(None, these))


def _repeats(ids: np.ndarray, n_ids: int) -> int:
    """Words inside some window of three words that occurs at least twice."""
    if len(ids) < WINDOW + 1:
        return 0
    pairs = ids[:-1] * n_ids + ids[1:]
    if n_ids < 2_000_000:
        codes = pairs[:-1] * n_ids + ids[2:]
    else:
        codes = np.unique(pairs, return_inverse=True)[1][:-1] * n_ids + ids[2:]
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    twice = np.zeros(len(codes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for at in range(WINDOW):
        covered[at:len(codes) + at] |= twice
    return int(covered.sum())


def _distinct_share(ids: np.ndarray) -> float:
    """Mean share of distinct words in blocks of BLOCK words, so that it doesn't fall with length."""
    whole = len(ids) // BLOCK * BLOCK
    if not whole:
        return len(np.unique(ids)) / len(ids)
    blocks = np.sort(ids[:whole].reshape(-1, BLOCK), axis=1)
    return float((1 + (np.diff(blocks, axis=1) != 0).sum(axis=1)).mean()) / BLOCK


def describe(text: str | None) -> tuple:
    """COUNTS, then RATIOS, of one text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS) + (0.0,) * len(RATIOS)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = _without(data, SYMBOLS)
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    dup_lines = len(lines) - len(set(lines))
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    repeats = _repeats(ids, len(seen))
    ratios = (
        math.log1p(n), chars / n, symbols / chars, dup_lines / len(lines), repeats / n,
        _without(data, _UPPER) / chars, _without(data, _DIGIT) / chars, data.count(b"!") / n,
        data.count(b"|") / n, _distinct_share(ids), int(np.bincount(ids).max()) / n,
        int((ids[1:] == ids[:-1]).sum()) / n, n / len(lines), data.count(b".") / n,
        _without(data, _OTHER) / n, (len(data) - len(text)) / chars)
    return (n, chars, symbols, dup_lines, repeats) + ratios


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, COUNTS (long) and RATIOS (double) of every row; no shuffle."""
    types = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(RATIOS)

    def run(batches):
        for batch in batches:
            rows = [describe(t) for t in batch.column(1).to_pylist()]
            columns = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["doc_id", *COUNTS, *RATIOS])

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{r} double" for r in RATIOS)])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def labelled_sample(stats: DataFrame, labels: DataFrame, column: str, bound: int,
                    columns: tuple[str, ...]):
    """About ``bound`` labelled rows at most as a pandas frame with the label in ``y``.

    Rows are picked by a hash of doc_id, evenly over the table.  Rows without a label are left
    out; of several labels of one document the least counts.
    """
    known = (labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min(F.col(column).cast("int")).alias("y")))
    joined = stats.join(known, "doc_id").select("doc_id", "y", *columns)
    total = known.count()
    if total > bound:
        share = int(bound / total * (1 << 30))
        joined = joined.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < share)
    return joined.toPandas().sort_values(["doc_id", *columns], ignore_index=True)
