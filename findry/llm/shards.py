"""Token sequences in training order, as fixed-stride binary shards.

Each task cuts the tokens of its documents, in order, into sequences of ``LENGTH``.  A first pass
counts the sequences of every task, so all sequences have a running number; a keyed Feistel network
over the next even number of bits, walked until it falls into the range, permutes these numbers. Its
value is the slot of a sequence: the place at which training reads it.  The second pass moves every
sequence to the partition of its slot range, which writes the shard of that range in order.

All records have one size, so slot s is record ``s % rows`` of shard ``s // rows`` and a reader that
stopped goes on anywhere by arithmetic.  A record is, little-endian: slot (8 bytes), first doc_id (8),
token position of the first token in that document (8), tokens (4), CRC-32 of their bytes (4), ids of
two or four bytes padded with zeros, 8 zero bytes.  Spark's committed text writer makes the files: a
record without its last byte is the line, the zero byte is the line end.  So a lost task leaves no
half shard, on any file system Spark writes.

Counting tokenises once more but stores nothing; staging the tokens would write and read them all once, and with the
shuffle and the shards take more disk than three times the table.

Null texts count as empty and give their separator only; a null doc_id is written as -1.  A text of any length is
encoded whole and goes on from one sequence to the next.
An empty table gives no shards.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findry.llm import tokens
from findry.llm.scratch import new_path

LENGTH = 2048
# Rows of a shard, each written by one task and read whole (8192 rows of 2048 two-byte ids: 34 MB).  A larger number
# makes fewer shards of a large table; a shard may take up to a gigabyte.
SHARD_ROWS = 8192
LARGEST_SHARD = 1 << 30
# Records parsed at once.
READ_ROWS = 1024
NAMES = ["slot", "shard", "row", "doc_id", "start", "n_tokens", "ids", "valid"]
ROUNDS = 6
KEY = 0x5EED
_HEADER = np.dtype([("slot", "<i8"), ("doc_id", "<i8"), ("start", "<i8"), ("tokens", "<u4"),
                    ("crc", "<u4")])
_TRAILER = 8


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A keyed 64-bit mixing function (two multiply-xorshift rounds)."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permute(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """A keyed permutation of 0 .. n - 1, applied to the given numbers."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = [int(v) for v in _mix(np.arange(ROUNDS, dtype=np.uint64), key)]

    def walk(x):
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            left, right = right, left ^ (_mix(right, k) & low)
        return left << np.uint64(half) | right

    out = walk(numbers.astype(np.uint64))
    beyond = np.flatnonzero(out >= n)
    while len(beyond):
        out[beyond] = walk(out[beyond])
        beyond = beyond[out[beyond] >= n]
    return out.astype(np.int64)


def stride(length: int, width: int) -> int:
    return _HEADER.itemsize + length * width + _TRAILER


def _sequences(batches, path, length, separator):
    """``(first doc_id, its token position, ids)`` of the sequences of one task."""
    parts, size, first = [], 0, None
    encode = tokens.encoder(path).encode
    end = np.array([separator], np.uint32)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.concatenate([encode(text.as_py()), end])
            doc_id, at = -1 if doc_id is None else doc_id, 0
            while at < len(ids):
                if first is None:
                    first = doc_id, at
                take = ids[at:at + length - size]
                parts.append(take)
                size += len(take)
                at += len(take)
                if size == length:
                    yield *first, np.concatenate(parts)
                    parts, size, first = [], 0, None
    if size:
        yield *first, np.concatenate(parts)


@dataclass
class Shards:
    """Where shards lie and how they are laid out."""

    spark: SparkSession
    path: str
    sequences: int
    rows: int
    length: int
    width: int

    def read(self, first: int = 0, count: int | None = None) -> DataFrame:
        """Records of the slots from ``first`` on: ``slot, shard, row, doc_id, start, n_tokens, ids, valid``.

        Only the shards that hold these slots are opened.  ``ids`` are 32-bit; ``valid`` tells whether
        the checksum holds.
        """
        last = self.sequences if count is None else min(self.sequences, first + count)
        schema = ("slot long, shard long, row long, doc_id long, start long, n_tokens long, "
                  "ids binary, valid boolean")
        if first >= last:
            return self.spark.createDataFrame([], schema)
        rows, width = self.rows, self.width
        record = np.dtype([*_HEADER.descr, ("ids", f"<u{width}", (self.length,)), ("end", "V", _TRAILER)])

        def parse(batches):
            for batch in batches:
                for content in batch.column(0):
                    every = np.frombuffer(content.as_buffer(), record)
                    for at in range(0, len(every), READ_ROWS):
                        some = every[at:at + READ_ROWS]
                        sizes, slot = some["tokens"].tolist(), some["slot"].astype(np.int64)
                        raw = [ids[:n].tobytes() for ids, n in zip(some["ids"], sizes)]
                        valid = [zlib.crc32(r) == c for r, c in zip(raw, some["crc"].tolist())]
                        if width != 4:
                            raw = [np.frombuffer(r, f"<u{width}").astype("<u4").tobytes() for r in raw]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(slot), pa.array(slot // rows), pa.array(slot % rows),
                            pa.array(some["doc_id"].astype(np.int64)), pa.array(some["start"].astype(np.int64)),
                            pa.array(some["tokens"].astype(np.int64)), pa.array(raw, pa.binary()),
                            pa.array(valid)], NAMES)

        files = (self.spark.read.format("binaryFile").load(self.path)
                 .where(F.col("shard").between(first // rows, (last - 1) // rows)))
        frame = files.select("content").mapInArrow(parse, schema)
        return frame.where((F.col("slot") >= first) & (F.col("slot") < last))


def materialise(docs: DataFrame, path: str | None = None, length: int = LENGTH,
                tokenizer: str | None = None, separator: int = tokens.SEPARATOR,
                shard_rows: int = SHARD_ROWS, key: int = KEY, wide: bool = False) -> Shards:
    """Write the tokens of ``docs`` as shards under ``path``; ids take two bytes unless ``wide``."""
    spark = docs.sparkSession
    path = path or new_path(spark, "shards")
    width = 4 if wide else 2
    if shard_rows * stride(length, width) > LARGEST_SHARD:
        raise ValueError(f"shards of {shard_rows} rows are larger than {LARGEST_SHARD} bytes")
    source = docs.select(F.col("doc_id").cast("long"), "text")

    def count(batches):
        file = tokenizer or tokens.public_path(tokens.BYTE_RANKS)
        encode = tokens.encoder(file).encode
        total = 0
        for batch in batches:
            for text in batch.column(1):
                total += len(encode(text.as_py())) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()]), pa.array([-(-total // length)])],
            ["task", "n"])

    counted = {r["task"]: r["n"] for r in source.mapInArrow(count, "task long, n long").collect()}
    total = sum(counted.values())
    rows = shard_rows
    out = Shards(spark, path, total, rows, length, width)
    if not total:
        return out
    base, before = {}, 0
    for task in sorted(counted):
        base[task], before = before, before + counted[task]

    def records(batches):
        file = tokenizer or tokens.public_path(tokens.BYTE_RANKS)
        task = TaskContext.get().partitionId()
        number, end = base[task], base[task] + counted[task]
        held = []

        def emit():
            slots = permute(np.arange(number - len(held), number), total, key)
            lines = []
            for slot, (doc_id, start, ids) in zip(slots.tolist(), held):
                if width == 2 and ids.max() > 0xFFFF:
                    raise ValueError("ids beyond 65535 need wide shards")
                raw = ids.astype(f"<u{width}").tobytes()
                head = np.array((slot, doc_id, start, len(ids), zlib.crc32(raw)), _HEADER).tobytes()
                lines.append(head + raw.ljust(length * width + _TRAILER - 1, b"\0"))
            return pa.RecordBatch.from_arrays([pa.array(slots), pa.array(lines, pa.binary())],
                                              ["slot", "line"])

        for sequence in _sequences(batches, file, length, separator):
            held.append(sequence)
            number += 1
            if len(held) == 1024:
                yield emit()
                held = []
        if held:
            yield emit()
        if number != end:
            raise RuntimeError("the table changed while its sequences were being numbered")

    shards = math.ceil(total / rows)
    moved = source.mapInArrow(records, "slot long, line binary").withColumn(
        "shard", F.floor(F.col("slot") / rows))
    (moved.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "slot")
     .select(F.col("line").cast("string").alias("value"), "shard")
     .write.partitionBy("shard").option("lineSep", "\0").text(path))
    return out
