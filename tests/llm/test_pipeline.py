"""The stages against plain versions of their operators, on documents with known copies and junk."""

import random

import corpus_pipeline
from findry.llm import surrogates
from tests.llm.data import odd_documents, prose
from tests.llm.test_simhash import plain_fingerprint, plain_groups
from tests.llm.test_spans import plain_clean
from tests.llm.test_tokens import check_pieces


def test_stages_do_what_their_operators_do(spark, tmp_path):
    rnd = random.Random(5)
    passage = prose(rnd, 8)
    rows = [(i, prose(rnd, 15) + (" " + passage if i % 7 == 0 else "")
             + (f" Mail me.{i}@post.example.org now." if i % 5 == 0 else ""), "aa") for i in range(60)]
    rows += [(100 + i, rows[i][1], "aa") for i in range(8)]
    rows += [(200, "Это совсем другой язык и его здесь никто не учил никогда", None), (201, None, "aa"),
             (202, "12 34", "aa"), (203, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.selectExpr("*", "'s' as source", "length(text) as n_chars").write.parquet(
        f"{tmp_path}/documents.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    kept = [r for r in rows if r[0] < 200]
    values = [plain_fingerprint(t) for _, t, _ in kept]
    one = [kept[i] for i, least in enumerate(plain_groups(values)) if i == least]
    assert len(one) == 60
    texts = plain_clean([r[:2] for r in one])
    assert sum(passage in t for t in texts.values()) == 1
    texts = {d: surrogates.replace(t)[0] for d, t in texts.items()}
    assert not any("post.example" in t for t in texts.values())
    steps = read
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps = stage(spark, steps, str(tmp_path))
        assert steps.columns == read.columns
    got = {r["doc_id"]: r for r in steps.collect()}
    assert {d: r["text"] for d, r in got.items()} == texts
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    check_pieces(corpus_pipeline.run(spark, str(tmp_path)).collect(), texts, 2048)


def test_stages_keep_extra_columns_and_survive_odd_rows(spark):
    for docs in (odd_documents(spark), odd_documents(spark).where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            done = stage(spark, docs, "unused")
            assert done.columns == docs.columns and done.dtypes == docs.dtypes, name
            assert all(r["score"] == 7 and r["rejected"] and r["entities"] == 1.5
                       and r["removed"] == "y" for r in done.collect())
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "unused").count() >= docs.count()
