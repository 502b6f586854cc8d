"""Small tables with every odd case: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rnd, n, letters="abcdefghiklmnoprstuvw"):
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8))) for _ in range(n)]


def prose(rnd, n_sentences, letters="abcdefghiklmnoprstuvw"):
    return " ".join(" ".join(words(rnd, rnd.randint(4, 9), letters)).capitalize() + "."
                    for _ in range(n_sentences))


def odd_documents(spark):
    rnd = random.Random(3)
    first = prose(rnd, 12)
    rows = [
        (1, first, "aa", "s", 0), (2, first, "aa", "s", 0), (2, first, "aa", "s", 0),
        (3, first.replace(".", ". ", 1), None, None, None), (4, None, "aa", "s", 0),
        (5, "", "aa", "s", 0), (6, " \t\n ", "bb", "s", 0), (7, "one two", "bb", "s", 0),
        (8, "One\x0bTWO three\x0cfour five", "bb", "s", 0), (None, prose(rnd, 5), "bb", "s", 0),
        (None, None, None, None, None), (9, " ".join(words(rnd, 30_000)), "aa", "s", 0),
        (10, "same same same " * 40, "aa", "s", 0), (11, "same same same " * 40, "aa", "s", 0),
        (12, "Été 教育 \U0001f600 <|endoftext|> x", "bb", "s", 0),
        (13, "a | b | c\nd\nd\n\nd *** $$$ 12", "bb", "s", 0), (7, "another text here", "bb", "s", 0),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.select("*", F.lit(7).alias("score"), F.lit("x").alias("ids"),
                        F.lit(True).alias("rejected"), F.lit(1.5).alias("entities"),
                        F.lit("y").alias("removed"), F.lit(0).alias("component_id"),
                        F.lit(0).alias("n"), F.lit("z").alias("fp"))


def no_documents(spark):
    return odd_documents(spark).where("false")
