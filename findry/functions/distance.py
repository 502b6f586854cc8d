"""Distances, scores and relevance as column expressions.

Smaller distances are closer for every metric.  All arithmetic is in double
precision whatever the stored element type is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from findry.schema import check_metric


def vector(values) -> Column:
    """A literal vector."""
    return F.array(*[F.lit(float(v)) for v in values])


def _double(v: Column) -> Column:
    return v.cast("array<double>")


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(_double(a), _double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    a = _double(a)
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Zero when either vector is all zeros."""
    norms = norm(a) * norm(b)
    return F.when(norms == 0, F.lit(0.0)).otherwise(inner_product(a, b) / norms)


def cosine_distance(a: Column, b: Column) -> Column:
    """One minus the similarity, so a zero vector is at distance one."""
    return F.lit(1.0) - cosine_similarity(a, b)


def dot_distance(a: Column, b: Column) -> Column:
    return -inner_product(a, b)


def squared_euclidean(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(_double(a), _double(b), lambda x, y: (x - y) * (x - y)),
        F.lit(0.0), lambda s, x: s + x)


def euclidean_distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_euclidean(a, b))


def distance(metric: str, a: Column, b: Column) -> Column:
    return {
        "cosine": cosine_distance,
        "dot": dot_distance,
        "euclidean": euclidean_distance,
    }[check_metric(metric)](a, b)


def score(distance: Column) -> Column:
    return F.lit(1.0) - distance


def _unit_interval(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def relevance(metric: str, score: Column) -> Column:
    """Map a score to [0, 1], higher meaning more relevant."""
    check_metric(metric)
    if metric == "cosine":
        return _unit_interval(score)
    if metric == "dot":
        return _unit_interval(score - F.lit(1.0))
    return F.lit(1.0) / (F.lit(1.0) + F.greatest(F.lit(0.0), F.lit(1.0) - score))
