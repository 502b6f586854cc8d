"""Cross-tokenizer alignment against a plain version over bytes."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from findry.llm import alignment, queries, tokens
from tests.llm.data import no_documents, odd_documents, prose

CONTRACT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def sides():
    json_form = Tokenizer.from_file(tokens.public_path("byte_bpe_50k.json"))
    json_form.encode_special_tokens = True
    return json_form, alignment.aligner(tokens.public_path(tokens.BYTE_RANKS), tokens.public_path(alignment.PIECES))


def spans(ids, table):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(table[i]), i))
        at += len(table[i])
    return out


def plain(text, sides):
    """Groups and links of one text by comparing all byte ranges."""
    json_form, own = sides
    if not text:
        return "", []
    a = json_form.encode(" " + text, add_special_tokens=False).ids
    b = own.b.model.encode(text)
    data = (" " + text).encode()
    if b"".join(own.a.bytes[i] for i in a) != data or b"".join(own.b.bytes[i] for i in b) != data:
        return "", []
    a, b = spans(a, own.a.bytes), spans(b, own.b.bytes)
    links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
    groups, start = [], 0
    for cut in sorted({x[1] for x in a} & {y[1] for y in b}):
        groups.append("|".join(",".join(str(t[2]) for t in side if start <= t[0] < cut) for side in (a, b)))
        start = cut
    return ";".join(groups), links


def expected(rows, sides):
    made = [(doc_id, *plain(text, sides)) for doc_id, text in rows]
    held = collections.Counter(pair for _, _, links in made for pair in set(links))
    best = collections.defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, groups, links in made:
        n_a = sum(len(g.split("|")[0].split(",")) for g in groups.split(";")) if groups else 0
        n_b = sum(len(g.split("|")[1].split(",")) for g in groups.split(";")) if groups else 0
        out.append((doc_id, n_a, n_b, len(groups.split(";")) if groups else 0, len(links),
                    sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def texts(seed=2, n=60):
    rnd = random.Random(seed)
    odd = ["", " ", "  x", "a  b\n\n c", "\t", "<|endoftext|> <s></s><unk>", "x▁y", "é教育\U0001f600 ½ ﬁ", " x y",
           "naïve — “quoted” 12345 $$$", "\x00\x01", "Ᲊ ꟋA", "x" * 3000, " " * 50, "1" * 700]
    return odd + [prose(rnd, rnd.randint(1, 6), rnd.choice(["abcdefgh", "тестслова", "教育学校", "ab \n.,"]))
                  for _ in range(n)]


@pytest.mark.parametrize("stretch", [1, 7, 64, 2048])
def test_merging_gives_all_overlaps_in_stretches_of_any_size(stretch):
    rnd = np.random.default_rng(stretch)
    for _ in range(30):
        starts, all_a, all_b, at = [], [], [], 0
        for _ in range(rnd.integers(1, 6)):
            size = int(rnd.integers(1, 300))
            starts.append(at)
            for out in (all_a, all_b):
                inner = np.unique(rnd.integers(1, size + 1, rnd.integers(0, size + 1)))
                out.append(at + np.union1d(inner, [size]))
            at += size
        a, b = np.concatenate(all_a), np.concatenate(all_b)
        link_a, link_b, cuts = alignment.merge(a, b, np.array(starts), stretch)
        sa, sb = np.r_[0, a[:-1]], np.r_[0, b[:-1]]
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if sa[i] < b[j] and sb[j] < a[i]}
        assert sorted(zip(link_a.tolist(), link_b.tolist())) == sorted(want)
        assert cuts.tolist() == np.intersect1d(a, b).tolist()


@pytest.mark.parametrize("heavy", [alignment.HEAVY, 40, 0])
def test_summary_equals_plain_version(spark, sides, heavy):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts())] + [(5, None), (5, "again the same")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = alignment.summarise(docs, heavy).select(CONTRACT).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows, sides)


def test_groups_and_pairs_of_the_operator(spark, sides):
    docs = spark.createDataFrame([(1, "merging tokenizers differs")], "doc_id long, text string")
    row = alignment.align(docs).collect()[0]
    groups, links = plain("merging tokenizers differs", sides)
    assert row["groups"] == groups and row["n_links"] == len(links)
    pairs = [(p >> 32, p & (1 << 32) - 1) for p in np.frombuffer(row["pairs"], "<i8").tolist()]
    want = collections.Counter(links)
    assert pairs == sorted(want) and np.frombuffer(row["times"], "<i4").tolist() == [want[p] for p in pairs]


def test_a_long_text_takes_no_more_steps(sides):
    own = sides[1]
    text = " ".join(texts(5, 400)[15:])[:200_000]
    one = own.align([text, None, "short"])
    words = own.align([text[:50_000]])
    assert one.n_links[0] >= words.n_links[0] and one.n_links[1] == 0
    groups = [g.split("|") for g in one.groups[0].split(";")]
    assert len(groups) == one.n_groups[0]
    assert sum(len(a.split(",")) for a, _ in groups) == one.n_a[0]
    for side, table, take in ((0, own.a.bytes, "a"), (1, own.b.bytes, "b")):
        ids = [int(i) for g in groups for i in g[side].split(",")]
        assert b"".join(table[i] for i in ids) == (" " + text).encode()


def test_long_white_space(sides):
    got = sides[1].align([" " * 1_000_001, "x" + "\n" * 1_000_001 + "y"])
    assert (got.n_groups > 0).all()


def test_odd_rows(spark, sides):
    docs = odd_documents(spark)
    got = alignment.summarise(docs).select(CONTRACT).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    small = [r for r in rows if r[0] != 9]
    assert len(got) == len(rows)
    by_digest = {r["groups_sha256"] for r in got}
    for _, text in small:
        groups = plain(text, sides)[0]
        assert (hashlib.sha256(groups.encode()).hexdigest() if groups else "") in by_digest
    assert alignment.summarise(no_documents(spark)).count() == 0


def test_query_over_a_table(spark, sides, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts(8, 20))]
    (spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_links", F.lit(3))
     .write.parquet(f"{tmp_path}/documents.parquet"))
    got = queries.QUERIES["op11_cross_tokenizer_alignment"](spark, str(tmp_path))
    assert got.columns == CONTRACT
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows, sides)
