"""Bounded scan of sources and the choice of a pool by priority."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import word_count
from corpusmill.operators.running import even_buckets, running
from corpusmill.session import broadcast_if_small, written

OVERSAMPLE = 1.35
LEAST_CAP = 2048


def bounded_scan(df: DataFrame, config: DataFrame, total: int, source: str = "source", idx: str = "idx", text: str = "text", max_records: int | None = None, max_scanned: int | None = None, max_oversized: int = 100) -> DataFrame:
    """df (only sources of config) with n_tokens, status, scanned and stop_reason, up to the row where each source stops.

    config: (source, share). Each source has a budget of total x share x 1.35 words and a cap on a single
    text. Texts are taken in order of idx, which is unique within a source. status: blank, balanced, probe (the first text over the cap, kept apart) or oversized
    (skipped). A source stops after max_records balanced texts, at its budget, after max_scanned rows or after
    max_oversized skips without a balanced text between; stop_reason is set on that last row only.
    """
    budget = F.floor(F.col("share") * total * OVERSAMPLE).cast("long")
    cap = F.least(F.col("_budget"), F.greatest(F.lit(LEAST_CAP).cast("long"), F.floor(F.col("_budget") * 0.5).cast("long")))
    c = config.select(F.col("source").alias(source), budget.alias("_budget"))
    # the texts stay out of the running sums: what they need is a few numbers a row
    d = df.join(F.broadcast(c), source).withColumn("_cap", cap).withColumn("n_tokens", word_count(text).cast("long"))  # a row per configured source
    d = written(d.select(source, idx, "n_tokens", "_budget", "_cap"), "sizes")
    n, bucket = F.col("n_tokens"), even_buckets(d, idx)
    good, over = (n > 0) & (n <= F.col("_cap")), n > F.col("_cap")
    flag = lambda c: c.cast("long")
    d = running(d, source, bucket, [idx], {"_scan": ("sum", F.lit(1).cast("long")), "_over": ("sum", flag(over)), "_tok": ("sum", F.when(good, n).otherwise(0)), "_acc": ("sum", flag(good))})
    status = F.when(n == 0, "blank").when(good, "balanced").when(F.col("_over") == 0, "probe").otherwise("oversized")
    d = d.withColumn("status", status).withColumn("scanned", F.col("_scan") + 1)
    d = d.withColumn("_skips", F.greatest(F.col("_over") + flag(over) - 1, F.lit(0)))
    d = running(d, source, bucket, [idx], {"_base": ("max", F.when(F.col("status") == "balanced", F.col("_skips")).otherwise(0))})
    run = F.col("_skips") - F.col("_base")
    full = F.col("scanned") >= max_scanned if max_scanned else F.lit(False)
    enough = F.col("_acc") + flag(good) >= max_records if max_records else F.lit(False)
    spent = F.col("_tok") + F.when(good, n).otherwise(0) >= F.col("_budget")
    taken = F.col("status").isin("balanced", "probe")
    why = (
        F.when(taken & enough, "max_records_per_source")
        .when(taken & spent, "budget_reached")
        .when((F.col("status") == "oversized") & (run >= max_oversized), "consecutive_oversized_limit")
        .when(full, "max_records_scanned")
    )
    d = d.withColumn("stop_reason", why)
    ends = d.where("stop_reason is not null").groupBy(F.col(source).alias("_s")).agg(F.min(idx).alias("_end"))
    d = d.join(F.broadcast(ends), F.col(source) == F.col("_s"), "left")
    d = d.where(F.col("_end").isNull() | (F.col(idx) <= F.col("_end"))).select(source, idx, "n_tokens", "status", "scanned", "stop_reason")
    rest = df.select(*dict.fromkeys([source, idx, *(c for c in df.columns if c not in d.columns)]))
    return rest.join(broadcast_if_small(written(d, "scanned")), [source, idx])


def scan_counters(scanned: DataFrame, source: str = "source") -> DataFrame:
    """(source, scanned, balanced, tokens, probes, oversized, stop_reason) of each source; source_exhausted where nothing stopped it."""
    count = lambda s: F.count_if(F.col("status") == s)
    return scanned.groupBy(source).agg(
        F.count(F.lit(1)).alias("scanned"), count("balanced").alias("balanced"),
        F.sum(F.when(F.col("status") == "balanced", F.col("n_tokens")).otherwise(0)).alias("tokens"),
        count("probe").alias("probes"), count("oversized").alias("oversized"),
        F.coalesce(F.max("stop_reason"), F.lit("source_exhausted")).alias("stop_reason"),
    )


def select_pool(df: DataFrame, pools: DataFrame, source: str = "source", order: str = "priority", tie: str = "document_id", size: str = "n_tokens") -> DataFrame:
    """Rows per source by ascending order (63 bits) through the one that reaches the source's pool; sources without a pool are dropped. Adds `before`."""
    d = df.join(F.broadcast(pools.select(F.col("source").alias(source), F.col("pool").alias("_pool"))), source)  # a row per configured source
    d = running(d, source, F.shiftright(order, 52), [order, tie], {"before": ("sum", F.col(size))})
    return d.where(F.col("before") < F.col("_pool")).drop("_pool")


def select_quota(df: DataFrame, quotas: DataFrame, source: str = "source", order: str = "priority", tie: str = "document_id", tokens: str = "token_ids") -> DataFrame:
    """Rows per source by ascending order until the quota is met exactly: the last one is cut to what is missing.

    Adds n_taken and truncated; the token array is cut. Rows without tokens are dropped. A cut document's text, spans and hash
    are renewed by layers.truncated.
    """
    d = df.join(F.broadcast(quotas.select(F.col("source").alias(source), F.col("quota").alias("_quota"))), source).where(F.size(tokens) > 0)
    d = running(d, source, F.shiftright(order, 52), [order, tie], {"_before": ("sum", F.size(tokens).cast("long"))})
    missing = F.col("_quota") - F.col("_before")
    d = d.where(missing > 0).withColumn("n_taken", F.least(F.size(tokens).cast("long"), missing))
    d = d.withColumn("truncated", F.col("n_taken") < F.size(tokens)).withColumn(tokens, F.slice(tokens, F.lit(1), F.col("n_taken").cast("int")))
    return d.drop("_quota", "_before")


def quota_deviation(selected: DataFrame, quotas: DataFrame, tolerance: float = 0.0005, source: str = "source") -> DataFrame:
    """(source, quota, got, within): whether the tokens of each source lie within tolerance of its quota."""
    got = selected.groupBy(F.col(source).alias("source")).agg(F.sum("n_taken").alias("got"))
    d = quotas.select("source", "quota").join(got, "source", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    return d.withColumn("within", F.abs(F.col("got") - F.col("quota")) <= F.col("quota") * tolerance)


def trim_spans(spans, length):
    """Spans clipped to a length; those that begin beyond it are dropped."""
    return F.transform(F.filter(spans, lambda s: s["start"] < length), lambda s: F.struct(s["start"].alias("start"), F.least(s["end"], length).alias("end")))
