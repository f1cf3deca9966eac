"""Token frequencies and smoothed log probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def token_counts(docs: DataFrame, vocab: int, source: str = "source", ids: str = "token_ids") -> DataFrame:
    """(scope, token_id, n) over all documents (scope null) and per source; ids outside the vocabulary are dropped.

    The per-source counts come first, with map-side combine; the global ones are their sums.
    """
    d = docs.select(F.coalesce(F.col(source), F.lit("")).alias("scope"), F.explode(ids).alias("token_id")).where(F.col("token_id").between(0, vocab - 1))
    by = d.groupBy("scope", "token_id").agg(F.count(F.lit(1)).alias("n"))
    return by.groupingSets([["scope", "token_id"], ["token_id"]], "scope", "token_id").agg(F.sum("n").alias("n"))


def log_probabilities(counts: DataFrame, vocab: int, alpha: float = 0.1) -> DataFrame:
    """(scope, token_id, log_p float) of every id of the vocabulary in every scope, with additive smoothing."""
    scopes = counts.groupBy("scope").agg(F.sum("n").alias("total"))
    dense = scopes.select("scope", "total", F.explode(F.sequence(F.lit(0), F.lit(vocab - 1))).alias("token_id"))
    d = dense.join(counts.select(F.col("scope").alias("_s"), F.col("token_id").alias("_t"), "n"), F.col("scope").eqNullSafe(F.col("_s")) & (F.col("token_id") == F.col("_t")), "left")
    p = F.log((F.coalesce("n", F.lit(0)) + F.lit(alpha)) / (F.col("total") + F.lit(alpha * vocab)))
    return d.select("scope", "token_id", p.cast("float").alias("log_p"))


def consistency(counts: DataFrame) -> DataFrame:
    """(token_id, total, by_source) of ids whose counts per source do not sum up to the global one; none if all is well."""
    d = counts.groupBy("token_id").agg(F.sum(F.when(F.col("scope").isNull(), F.col("n")).otherwise(0)).alias("total"), F.sum(F.when(F.col("scope").isNotNull(), F.col("n")).otherwise(0)).alias("by_source"))
    return d.where("total <> by_source")
