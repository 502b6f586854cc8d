"""Tokenising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"([a-z0-9]+)"
# Words of full-text relevance: letters of any script, their marks, digits and underscores.
TEXT_WORD = r"([\p{L}\p{M}\p{N}_]+)"
NOT_WORD = r"[^a-z0-9]+"

# The default full-text stop words of the InnoDB storage engine,
# as printed in the MySQL reference manual.
STOP_WORDS = tuple("""
a about an are as at be by com de en for from how i in is it la of on or that the
this to was what when where who will with und the www
""".split())
MIN_TOKEN_LENGTH = 3
# Folders a stored postings table is split into by word.
TERM_BUCKETS = 64


def words(text: Column) -> Column:
    """Every run of ASCII letters and digits of the lower-cased text, in order."""
    return F.coalesce(
        F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(1)),
        F.array().cast("array<string>"))


def text_words(text: Column) -> Column:
    """Every run of letters of any script, digits and underscores of the lower-cased text."""
    return F.coalesce(
        F.regexp_extract_all(F.lower(text), F.lit(TEXT_WORD), F.lit(1)),
        F.array().cast("array<string>"))


def tokens(text: Column) -> Column:
    """The distinct words of a text."""
    return F.array_distinct(words(text))


def index_words(text: Column, min_length: int = MIN_TOKEN_LENGTH,
                stop_words=STOP_WORDS) -> Column:
    """Words a full-text index keeps: long enough and not a stop word."""
    kept = text_words(text)
    if min_length > 1:
        kept = F.filter(kept, lambda w: F.length(w) >= min_length)
    if stop_words:
        stop = sorted(set(stop_words))
        kept = F.filter(kept, lambda w: ~w.isin(stop))
    return kept


def term_bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(TERM_BUCKETS)).cast("int")
