"""Encoding, packing and shards against the tokenizers library and exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from findry.llm import bpe, packing, shards, tokens
from findry.llm.queries import QUERIES
from tests.llm.data import no_documents, odd_documents, prose

WORD = public_tokenizers.path("word_bpe_49k.json")


def strange_texts(n):
    rnd = random.Random(11)
    pool = [chr(c) for c in [*range(0, 0x500), *range(0x1e00, 0x2200), 0x3000, 0x1680, 0x180e, 0xfeff,
                             0x1f600, 0xe000, 0x4e2d, 0x0660, 0x2460, 0xac00, 0x1100, 0x1161, 0x0bb4]]
    out = ["", "a<|endoftext|>b <|startoftext|> C<|nope|>", "  x  y\n\n z 　w q᠎ r\u0085s",
           "İstanbul ΣΑΣ ΑΣ é", "a\x1cb \x1f", "é É ſ K Å ﬁ ǅ", "</w> w</w>",
           "aaaaaaaaaaaaaaa hahahahaha !!!!!!!!"]
    for _ in range(n):
        out.append("".join(rnd.choice(pool) if rnd.random() < 0.3 else
                           rnd.choice(" abcdefthSERI.,'\n12") for _ in range(rnd.randint(1, 60))))
        out.append("".join(rnd.choice("aeinrst") for _ in range(rnd.randint(1, 40))))
    return out


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_backtracking_gives_the_merges_of_the_library():
    library, own = Tokenizer.from_file(WORD), bpe.vocabulary(WORD)
    names = [n.replace("</w>", "") for n in library.get_vocab() if n.isascii()]
    for text in strange_texts(1500) + names[::3]:
        ids = library.encode(text, add_special_tokens=False).ids
        data = own.encode(text)
        assert ids_of(data) == ids, text
        assert own.decode(data) == library.decode(ids, skip_special_tokens=False)


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    own = bpe.Vocabulary(WORD)
    library = Tokenizer.from_file(WORD)
    text = prose(random.Random(1), 40)
    assert ids_of(own.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert max(len(own.known), len(own.known_words), len(own.compatible)) <= 10


def test_round_trip_of_odd_rows(spark):
    library = Tokenizer.from_file(WORD)
    docs = odd_documents(spark)
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(r["text"] or "")
    rows = bpe.round_trip(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = ids_of(r["ids"])
        assert ids in [library.encode(t, add_special_tokens=False).ids for t in texts[r["doc_id"]]]
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.round_trip(no_documents(spark)).count() == 0
    assert bpe.encode(docs).columns == [*[c for c in docs.columns if c != "ids"], "ids"]


BYTES = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def byte_ids(text):
    return BYTES.encode(text or "", add_special_tokens=False).ids


def test_rank_file_equals_the_library():
    own = tokens.encoder(tokens.public_path(tokens.BYTE_RANKS))
    rnd = random.Random(2)
    spaced = ["".join(rnd.choice([" ", "\n", "\t", "\u00a0", "\u3000", "a", "b1", ".", "é", "'s"])
                      for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    for text in strange_texts(700) + spaced:
        assert own.encode(text).tolist() == byte_ids(text), repr(text)
    assert not len(own.encode(None))


def plain_cost(places, cost, length):
    best = [0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            if places[j] - places[i] <= length:
                best[j] = min(best[j], best[i] + length - (places[j] - places[i]) + cost[j])
    return best[-1]


def test_cuts_are_of_least_cost():
    rnd = random.Random(3)
    for _ in range(60):
        length = rnd.choice([8, 20, 50])
        places = np.unique(np.r_[0, np.cumsum([rnd.randint(1, length) for _ in range(30)])])
        cost = np.array([rnd.choice([0, 4, 64]) for _ in places])
        cuts = packing.best_cuts(places, cost, length, True)
        price = dict(zip(places.tolist(), cost.tolist()))
        ends = [0, *cuts]
        assert ends[-1] == places[-1] and max(np.diff(ends)) <= length
        got = sum(length - (b - a) + price[b] for a, b in zip(ends, ends[1:]))
        assert got == plain_cost(places.tolist(), cost.tolist(), length)


def check_pieces(rows, texts, length):
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        documents[r["doc_id"]].append(r)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= length
    for doc_id, text in texts.items():
        ids = [*byte_ids(text), 1]
        pieces = sorted(documents.pop(doc_id), key=lambda p: p["start"])
        assert [i for p in pieces for i in ids_of(p["ids"])] == ids
        assert all(p["doc_tokens"] == len(ids) and len(ids_of(p["ids"])) == p["length"] for p in pieces)
        assert [p["start"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces)])[:-1].tolist()
    assert not documents
    return len(sequences)


@pytest.mark.parametrize("length,chunk", [(2048, 1 << 20), (64, 1000), (16, 1)])
def test_pieces_hold_every_token_once(spark, monkeypatch, length, chunk):
    monkeypatch.setattr(packing, "CHUNK", chunk)
    rnd = random.Random(5)
    texts = {i: prose(rnd, rnd.randint(1, 60)) for i in range(120)}
    texts |= {200: None, 201: "", 202: "x" * 5000, 203: "a<|endoftext|>b"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(2)
    rows = packing.pack(docs, length).collect()
    n = check_pieces(rows, texts, length)
    total = sum(r["length"] for r in rows)
    if length == 2048:
        assert n <= total / length * 1.02 + 2
    again = packing.pack(docs, length).collect()
    assert rows == again


def test_packing_odd_rows(spark):
    docs = odd_documents(spark)
    rows = packing.pack(docs).collect()
    assert sum(r["length"] for r in rows) == sum(
        len(byte_ids(r["text"])) + 1 for r in docs.select("text").collect())
    assert packing.pack(no_documents(spark)).count() == 0


def test_permutation():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        numbers = np.arange(n)
        assert sorted(shards.permute(numbers, n).tolist()) == list(range(n))
    assert shards.permute(np.arange(1000), 1000, 1).tolist() != shards.permute(np.arange(1000), 1000, 2).tolist()
    assert np.corrcoef(np.arange(5000), shards.permute(np.arange(5000), 5000))[0, 1] < 0.1


@pytest.mark.parametrize("wide", [False, True])
def test_shards_give_back_every_token(spark, tmp_path, wide):
    rnd = random.Random(7)
    texts = {i: prose(rnd, rnd.randint(1, 30)) for i in range(90)} | {300: None, 301: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(3)
    made = shards.materialise(docs, f"file://{tmp_path}/out", length=32, shard_rows=20, wide=wide)
    rows = sorted(made.read().collect())
    assert [r["slot"] for r in rows] == list(range(made.sequences)) and all(r["valid"] for r in rows)
    assert all(r["shard"] == r["slot"] // 20 and r["row"] == r["slot"] % 20 for r in rows)
    # Records lie where the arithmetic says.
    stride = shards.stride(32, 4 if wide else 2)
    for folder in (tmp_path / "out").glob("shard=*"):
        (file,) = folder.glob("part-*")
        data = file.read_bytes()
        assert len(data) % stride == 0
        first = int(folder.name.split("=")[1]) * 20
        assert [int.from_bytes(data[i:i + 8], "little") for i in range(0, len(data), stride)] == \
            list(range(first, first + len(data) // stride))
    # In their running order the sequences are the stream again.
    slots = shards.permute(np.arange(made.sequences), made.sequences)
    by_task = [i for s in slots.tolist() for i in ids_of(rows[s]["ids"])]
    assert sorted(by_task) == sorted(i for t in texts.values() for i in [*byte_ids(t), 1])
    parts = docs.select("text").rdd.glom().collect()
    assert by_task == [i for part in parts for r in part for i in [*byte_ids(r["text"]), 1]]
    part = made.read(25, 30).collect()
    assert sorted(r["slot"] for r in part) == list(range(25, 55))
    assert sorted(part) == rows[25:55] and made.read(10**6, 5).count() == 0


def test_shards_of_odd_rows(spark):
    docs = odd_documents(spark)
    made = shards.materialise(docs, shard_rows=4)
    rows = made.read().collect()
    assert sum(r["n_tokens"] for r in rows) == sum(
        len(byte_ids(r["text"])) + 1 for r in docs.select("text").collect())
    assert shards.materialise(no_documents(spark)).read().count() == 0


def test_digests(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op8_packing"](spark, folder).collect():
        ids = [*byte_ids(docs[r["doc_id"]]), 1][r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
    import hashlib
    library = Tokenizer.from_file(WORD)
    rows = QUERIES["op7_bpe_round_trip"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows[::4]:
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(
            library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_every_code_point_is_encoded_as_the_library_does():
    library, own = Tokenizer.from_file(WORD), bpe.vocabulary(WORD)
    for at in [*range(0, 0x34000, 8192), *range(0xE0000, 0xE2000, 8192)]:
        texts = [f"x{chr(c)}y" for c in range(at, at + 8192) if not 0xD800 <= c < 0xE000]
        for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
            assert ids_of(own.encode(text)) == want.ids, hex(ord(text[1]))
    rnd = random.Random(8)
    newer = list(map(chr, own.newer))
    for _ in range(2000):
        text = "".join(rnd.choice(newer if rnd.random() < 0.6 else "aB 1.\u0307\u0308Σ") for _ in range(rnd.randint(1, 20)))
        assert ids_of(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_long_white_space_is_encoded_as_the_library_does(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" " * 2_000_000, "a" + "\t" * 1_000_000 + "b", "x\n" + "\r\n " * 500_000, "c" + "\n" * 2_000_000 + "<|endoftext|>"]
    own = tokens.encoder(tokens.public_path(tokens.BYTE_RANKS))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for text, ids in zip(texts, want):
        assert own.encode(text).tolist() == ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packed = packing.pack(docs).groupBy("doc_id").sum("length").collect()
    assert dict(map(tuple, packed)) == {i: len(ids) + 1 for i, ids in enumerate(want)}
    rows = shards.materialise(docs).read().collect()
    assert sum(r["n_tokens"] for r in rows) == sum(len(ids) + 1 for ids in want)
    assert all(r["valid"] for r in rows)
