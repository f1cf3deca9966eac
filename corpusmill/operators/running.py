"""Running sums and maxima that no single task computes for a whole key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def even_buckets(df: DataFrame, order: str, rows: int = 1 << 16, most: int = 4096) -> Column:
    """Buckets of a whole-number column of about `rows` rows each, `most` at most, by its approximate quantiles.

    So outlying values and clumps do not put a source into one bucket. The buckets shape the plan of running(), not its result.
    """
    n = df.agg(F.count(order)).first()[0]
    m = min(most, -(-n // rows))
    if m <= 1:
        return F.lit(0)
    at = [k / m for k in range(1, m)]
    bounds = sorted(set(df.agg(F.percentile_approx(order, at, 10 * m)).first()[0]))
    table, steps = F.array(*map(F.lit, bounds)), [1 << k for k in reversed(range(len(bounds).bit_length()))]
    # binary search: how many bounds are at most the value
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda k, s: F.when(F.get(table, k + s - 1) <= F.col(order), k + s).otherwise(k))


def running(df: DataFrame, key: str, bucket: Column, order: list[str], values: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """df with, per entry of values, the sum or max of a column over the rows of key before this one in order.

    values: {new column: ("sum" or "max", column)}; 0 for the first row. bucket must not decrease with order.
    Rows are sorted within (key, bucket) only; the totals of the buckets, few rows per key, are accumulated
    apart. So a key with a third of all rows is spread over as many tasks as it has buckets.
    """
    agg = {"sum": F.sum, "max": F.max}
    d = df.withColumn("_rb", bucket).withColumns({f"_rv{i}": c for i, (_, c) in enumerate(values.values())})
    within, before = Window.partitionBy(key, "_rb").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(key).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    kinds = [k for k, _ in values.values()]
    totals = d.groupBy(key, "_rb").agg(*(agg[k](f"_rv{i}").alias(f"_rt{i}") for i, k in enumerate(kinds)))
    totals = totals.select(F.col(key).alias("_rk"), F.col("_rb").alias("_rb2"), *(agg[k](f"_rt{i}").over(before).alias(f"_rp{i}") for i, k in enumerate(kinds)))
    d = d.withColumns({f"_rw{i}": agg[k](f"_rv{i}").over(within) for i, k in enumerate(kinds)})
    d = d.join(totals, F.col(key).eqNullSafe(F.col("_rk")) & F.col("_rb").eqNullSafe(F.col("_rb2")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = {n: (zero(f"_rp{i}") + zero(f"_rw{i}") if kinds[i] == "sum" else F.greatest(zero(f"_rp{i}"), zero(f"_rw{i}"))) for i, n in enumerate(values)}
    d = d.withColumns(out)
    return d.drop("_rb", "_rk", "_rb2", *(f"_r{x}{i}" for x in "vpw" for i in range(len(kinds))))
