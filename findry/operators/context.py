"""Context passages for answering a question from search results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble_context(results: DataFrame, separator: str = "\n") -> DataFrame:
    """Join the contents of each query's results, best first.  A group is one result list."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "content")))
    return results.groupBy("query_id").agg(
        F.array_join(F.transform(ordered, lambda r: r["content"]), separator).alias("context"))
