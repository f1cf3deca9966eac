"""Deterministic splits by the hash of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.session import blank_to_null

#: Splits in the order of their thresholds; the rest is train.
ORDER = ("validation", "test", "trajectory_holdout")


def split_group(group: Column | str, parent: Column | str, id_: Column | str) -> Column:
    """What a record is split by: its group, else its parent (both case and surrounding blanks aside; blank is none), else its own id."""
    return F.coalesce(blank_to_null(group), blank_to_null(parent), (F.col(id_) if isinstance(id_, str) else id_).cast("string"))


def unit_hash(group: Column, seed: int = 42) -> Column:
    """A number from 0 to 1 of a group and a seed; null for a null group."""
    return F.conv(F.substring(F.md5(F.concat(group.cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("long") / F.lit(4294967295.0)


def hash_split(group: Column, shares: dict[str, float], seed: int = 42) -> Column:
    """The split of a group: validation, test and holdout by their shares, in this order, else train; null for a null group."""
    u, at, out = unit_hash(group, seed), 0.0, None
    for name in ORDER:
        at += shares.get(name, 0.0)
        out = F.when(u < at, name) if out is None else out.when(u < at, name)
    return F.when(u.isNotNull(), out.otherwise("train"))


def split_metrics(df: DataFrame, splits: DataFrame, group: str, parent: str, size: str) -> DataFrame:
    """(split, groups, parents, records, size) of every split of the list, also the empty ones."""
    got = df.groupBy("split").agg(F.count_distinct(group).alias("groups"), F.count_distinct(parent).alias("parents"), F.count(F.lit(1)).alias("records"), F.sum(size).alias("size"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return splits.select("split").distinct().join(got, "split", "left").select("split", *map(zero, ("groups", "parents", "records", "size")))
