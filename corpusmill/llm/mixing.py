"""Mixing sources to target weights (problem 5): entropy balancing.

Every document gets the rate that is closest, in relative entropy, to one copy each while each source meets
its token target. The dual of that problem is convex with one multiplier per source: the rate of a document
of t tokens is exp(lambda_source * t / mean_source), cut at max_repeats. Newton's steps need two sums per
source; they are computed on the executors over the table (source, tokens, documents), and only those sums,
a row per source, reach the driver.

A source whose target exceeds max_repeats copies of all its tokens, the limit of its dual's gradient, cannot be met: its
dual is unbounded. It is reported, all its documents get max_repeats copies, and what it lacks is spread over the other
sources in proportion to their shares, as far as their own limits allow.

Rates become copies by controlled rounding: within a source, documents are put in order of their tokens, those of as
many tokens in order of a hash, and each gets the whole numbers that the running sum of the rates passes. The running sums
of rates and copies differ by less than one at every document, and tokens do not decrease, so the tokens of the source
miss the sum of rates x tokens by less than one document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.session import blank_to_null, broadcast_if_small, written

#: The size of the corpus for which source_config states quota_3b_tokens.
QUOTA_TOTAL = 3_000_000_000
#: White space as str.split() has it.
WORD = r"[^\s\x1c-\x1f\x85\p{Z}]+"


def word_count(text: Column | str) -> Column:
    """White-space separated words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(config: DataFrame) -> DataFrame:
    """(source, share, max_repeats) once per name, lower-cased and trimmed.

    A null share is quota_3b_tokens / 3,000,000,000, and 0 if that is null too; a null max_repeats is 1. Of
    rows that differ under one name the first by (share, max_repeats) is taken. Blank names are left out.
    """
    c = config.select(blank_to_null("name").alias("source"), F.coalesce("share", F.col("quota_3b_tokens") / F.lit(float(QUOTA_TOTAL)), F.lit(0.0)).alias("share"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats"))
    return c.where("source is not null").groupBy("source").agg(F.min(F.struct("share", "max_repeats")).alias("x")).select("source", "x.*")


def document_tokens(df: DataFrame, id_col: str = "document_id", text: str = "normalized_text", source: str = "source") -> DataFrame:
    """(document_id, source, tokens), each document_id once per source; null ids and blank sources are left out."""
    d = df.select(F.col(id_col).alias("document_id"), blank_to_null(source).alias("source"), word_count(text).alias("tokens"))
    return d.where("document_id is not null and source is not null").groupBy("document_id", "source").agg(F.max("tokens").alias("tokens"))


def _sums(hist: DataFrame, lam: dict[str, float], mean: dict[str, float], cap: dict[str, int]) -> dict[str, tuple[float, float]]:
    """Of each source the tokens at the present rates and their derivative by the multiplier."""
    spark = hist.sparkSession
    rows = [(s, lam[s] / mean[s], mean[s], float(cap[s])) for s in lam]
    now = F.broadcast(spark.createDataFrame(rows, "source string, slope double, mean double, cap double"))  # a row per configured source
    raw = F.exp(F.least(F.col("slope") * F.col("tokens"), F.lit(700.0)))
    got = hist.join(now, "source").select("source", "n", "tokens", "mean", F.least(raw, "cap").alias("rate"), (raw < F.col("cap")).alias("free"))
    got = got.groupBy("source").agg(F.sum(F.col("n") * F.col("rate") * F.col("tokens")), F.sum(F.when(F.col("free"), F.col("n") * F.col("rate") * F.col("tokens") * F.col("tokens") / F.col("mean")).otherwise(0.0)))
    return {r[0]: (r[1], r[2]) for r in got.collect()}


def spread(wanted: dict[str, float], limit: dict[str, float]) -> dict[str, float]:
    """min(x * wanted, limit) of each source, with x such that the sum is that of wanted, or all limits if they are less."""
    total, open_, out = sum(wanted.values()), {s for s in wanted if wanted[s] > 0}, dict.fromkeys(wanted, 0.0)
    left = total
    while open_:
        x = left / sum(wanted[s] for s in open_)
        full = {s for s in open_ if x * wanted[s] >= limit[s]}
        for s in full or open_:
            out[s] = limit[s] if full else x * wanted[s]
        if not full:
            break
        open_ -= full
        left -= sum(limit[s] for s in full)
    return out


def balance(df: DataFrame, config: DataFrame, id_col: str = "document_id", text: str = "normalized_text", source: str = "source", tolerance: float = 1e-9, max_steps: int = 200) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, lengths, plan).

    documents: document_id, source, tokens of the configured sources. lengths: source, tokens, n (their documents). plan, a row
    per configured source: source, share, max_repeats, available (its tokens), target (share x T, with T the tokens of all
    configured sources), reachable (target at most max_repeats x available), planned (the target after the spread of what
    unreachable sources lack), slope (the multiplier over the mean length; infinite when all documents get max_repeats
    copies, minus infinite for a plan of 0), expected (tokens at these rates), converged (expected is planned, to
    `tolerance` of it or one token).
    """
    spark = df.sparkSession
    conf = {r["source"]: (float(r["share"]), int(r["max_repeats"])) for r in source_targets(config).collect()}  # a row per configured source
    docs = written(document_tokens(df, id_col, text, source), "tokens")
    names = spark.createDataFrame([(s,) for s in conf], "source string")
    docs = docs.join(F.broadcast(names), "source")  # a row per configured source
    hist = written(docs.groupBy("source", "tokens").agg(F.count(F.lit(1)).alias("n")), "lengths")
    have = {r[0]: (r[1], r[2]) for r in hist.groupBy("source").agg(F.sum(F.col("n") * F.col("tokens")), F.sum("n")).collect()}
    available = {s: int(have.get(s, (0, 0))[0]) for s in conf}
    total = sum(available.values())
    target = {s: conf[s][0] * total for s in conf}
    cap = {s: max(0, conf[s][1]) for s in conf}
    limit = {s: float(cap[s] * available[s]) for s in conf}
    reachable = {s: not target[s] > cap[s] * available[s] for s in conf}
    planned = spread({s: max(0.0, target[s]) for s in conf}, limit)
    slope = {s: (math.inf if 0 < limit[s] <= planned[s] else -math.inf) for s in conf}
    expected = {s: limit[s] if slope[s] > 0 else 0.0 for s in conf}
    converged = {s: slope[s] > 0 or planned[s] == 0 for s in conf}
    active = {s: 0.0 for s in conf if not converged[s]}
    mean = {s: available[s] / have[s][1] for s in active}
    low: dict[str, float] = {}
    high: dict[str, float] = {}
    for k in range(max_steps):
        if not active:
            break
        for s, (now, grow) in _sums(hist, active, mean, cap).items():
            gap = planned[s] - now
            slope[s], expected[s] = active[s] / mean[s], now
            if abs(gap) <= max(1.0, tolerance * planned[s]):
                converged[s] = True
                del active[s]
                continue
            (low if gap > 0 else high)[s] = active[s]
            far = 2.0 * 2.0 ** (k / 4)
            step = active[s] + max(-far, min(far, gap / grow)) if grow > 0 else math.nan
            lo, hi = low.get(s, -math.inf), high.get(s, math.inf)
            if not lo < step < hi:  # Newton left the bracket, or all rates are at the cap
                step = (lo + hi) / 2 if math.isfinite(lo + hi) else (lo + far if math.isfinite(lo) else hi - far)
            active[s] = step
    rows = [(s, *conf[s], available[s], target[s], reachable[s], planned[s], slope[s], expected[s], converged[s]) for s in conf]
    schema = "source string, share double, max_repeats int, available long, target double, reachable boolean, planned double, slope double, expected double, converged boolean"
    return docs, hist, spark.createDataFrame(rows, schema)


def mixture(df: DataFrame, config: DataFrame, seed: int = 0, **kw) -> DataFrame:
    """(document_id, source, tokens, rate, copies): how often each document of a configured source is used.

    copies is rate rounded up or down, so it is the same in every run and never exceeds max_repeats. Documents of other
    sources, without a source or with a null id are left out; those without tokens get no copy.
    """
    return _mixed(*balance(df, config, **kw), seed)


def _mixed(docs: DataFrame, hist: DataFrame, plan: DataFrame, seed: int, part: int = 100_000) -> DataFrame:
    cap = F.greatest(F.col("max_repeats"), F.lit(0)).cast("double")
    x = F.least(F.col("slope") * F.col("tokens"), F.lit(700.0))
    rate = F.when(F.col("tokens") == 0, 0.0).when(F.col("slope") == math.inf, cap).when(F.col("slope") == -math.inf, 0.0).otherwise(F.least(F.exp(x), cap))
    groups = hist.join(F.broadcast(plan.select("source", "slope", "max_repeats")), "source").withColumn("rate", rate)  # a row per configured source
    below = F.sum(F.col("n") * F.col("rate")).over(Window.partitionBy("source").orderBy("tokens").rowsBetween(Window.unboundedPreceding, -1))  # a row per length
    groups = groups.select("source", "tokens", "rate", cap.alias("cap"), F.coalesce(below, F.lit(0.0)).alias("below"), F.ceil(F.col("n") / part).cast("int").alias("parts"))
    # the place of a document among those of its source and length, in parts of bounded size, so that no length is one task
    h = F.xxhash64(F.lit(seed), "document_id")
    docs = docs.join(broadcast_if_small(written(groups, "rates")), ["source", "tokens"]).withColumn("h", h).withColumn("part", F.pmod("h", "parts").cast("int"))
    counts = docs.where("parts > 1").groupBy("source", "tokens", "part").count()
    before = counts.select("source", "tokens", "part", (F.sum("count").over(Window.partitionBy("source", "tokens").orderBy("part")) - F.col("count")).alias("before"))
    docs = docs.withColumn("within", F.row_number().over(Window.partitionBy("source", "tokens", "part").orderBy("h", "document_id")) - 1)
    docs = docs.join(before, ["source", "tokens", "part"], "left").withColumn("k", F.coalesce("before", F.lit(0)) + F.col("within"))
    copies = F.floor(F.col("below") + F.col("rate") * (F.col("k") + 1)) - F.floor(F.col("below") + F.col("rate") * F.col("k"))
    return docs.select("document_id", "source", "tokens", "rate", F.least(copies, F.col("cap")).cast("int").alias("copies"))


def mixture_report(df: DataFrame, config: DataFrame, seed: int = 0, **kw) -> DataFrame:
    """(source, target_share, planned_share, actual_share, available, planned_tokens, mixed_tokens, documents_used, longest, reachable,
    converged), a row per configured source. longest: the tokens of its longest document, by less than which planned and mixed differ."""
    docs, hist, plan = balance(df, config, **kw)
    mixed = _mixed(docs, hist, plan, seed).groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed"), F.sum((F.col("copies") > 0).cast("int")).alias("used"), F.max("tokens").alias("longest"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    every = Window.partitionBy()  # a row per configured source
    of = lambda c: F.round(F.coalesce(c / F.nullif(F.sum(c).over(every).cast("double"), F.lit(0.0)), F.lit(0.0)), 6)
    return plan.join(mixed, "source", "left").select(
        "source", F.col("share").alias("target_share"), of(F.col("planned")).alias("planned_share"), of(zero("mixed")).alias("actual_share"), "available",
        F.round("planned", 3).alias("planned_tokens"), zero("mixed").alias("mixed_tokens"), zero("used").alias("documents_used"), zero("longest").alias("longest"), "reachable", "converged",
    )


def unreachable_sources(df: DataFrame, config: DataFrame, **kw) -> DataFrame:
    """(source): configured sources whose target is beyond max_repeats copies of all their tokens, so that their dual is unbounded."""
    *_, plan = balance(df, config, **kw)
    return plan.where("not reachable").select("source").distinct()
