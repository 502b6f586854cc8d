"""The stored postings of a corpus are those of its texts, whatever parts its ids are divided into."""

from findry.operators import keyword
from findry.sources import storage


def test_stored_postings_by_parts_of_the_ids(spark, tmp_path, monkeypatch):
    rows = [(i % 40 if i % 11 else None, f"The word w{i % 7} and the Été w{i}") for i in range(60)]
    rows += [(100, None), (101, ""), (5, "the the w5")]
    docs = spark.createDataFrame(rows, "id long, content string")
    want = sorted(map(tuple, keyword.postings(docs).select("term", "id", "tf").collect()), key=str)
    for most in (100_000, 10):
        monkeypatch.setattr(storage, "IDS_PER_SLOT", most)
        path = f"{tmp_path}/{most}"
        storage._save_postings(docs, path, "c1")
        found = spark.read.parquet(f"{path}/postings")
        assert sorted(map(tuple, found.select("term", "id", "tf").collect()), key=str) == want
        assert found.where(storage.term_bucket(found["term"]) != found["bucket"]).count() == 0
