"""Splits that keep related records together (problem 1).

Records tied by a shared key form components (connected components of the key graph). Components are
balanced into many equal bins by the largest-differencing method, and whole bins go to the splits by target
proportion. Bins, not components, are allotted, so every split gets a mix of component sizes. There are as many
bins as the smallest share needs to get `PER_SPLIT` of them.

Scale: only the histogram of component sizes reaches the driver. With N records there are at most
sqrt(2 N) different sizes. Of each size, full rounds of one component per bin cancel exactly (they leave all
differences as they are). What is left of a size, fewer components than bins, is one partial solution, since
differencing combines equal weights first and puts each into a bin of its own; so the heap holds one entry a size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.operators.components import connected_components
from corpusmill.session import blank_to_null, written

#: Bins at least, bins that the smallest share gets, and bins at most.
MIN_BINS, PER_SPLIT, MAX_BINS = 200, 8, 1 << 17
#: Entries of the orders that differencing keeps.
CELLS = 1 << 25
#: Split labels that mean another one.
LABEL_ALIASES = {"val": "validation"}


def split_label(c: str):
    """The label as compared: case and blanks aside, aliases resolved, null for blank."""
    label = blank_to_null(c)
    for a, b in LABEL_ALIASES.items():
        label = F.when(label == a, b).otherwise(label)
    return label


def largest_differencing(groups: Sequence[tuple[int, int]], bins: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(places, sums): the bins of the components of each group, and the bins' sums, by multiway largest differencing.

    A group (size, n) stands for n components of one size, fewer than bins; the groups come largest first. Partial
    solutions are vectors of bin sums. The two with the largest spread are combined again and again, the largest sums
    of one on the smallest of the other. The sizes after the first CELLS / bins, the small change, are dealt to the
    lightest bins at the end, so what is kept has a bound.
    """
    most = max(64, CELLS // bins)
    first = groups[:most]
    sums: dict[int, np.ndarray] = {}
    merged: list[tuple[int, np.ndarray | None, int, np.ndarray | None]] = []  # of each later solution: its parts and their orders
    heap = [(-size, i) for i, (size, _) in enumerate(first)]
    heapq.heapify(heap)

    def take(i: int, down: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """The sums of a part in order, and that order; a group's order needs no keeping."""
        if i < len(first):
            size, n = first[i]
            v = np.zeros(bins, dtype=np.int64)
            v[:n] = size
            return (v, None) if down else (v[::-1], None)
        v = sums.pop(i)
        order = np.argsort(-v if down else v, kind="stable").astype(np.int32)
        return v[order], order

    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        (x, down), (y, up) = take(a, True), take(b, False)
        merged.append((a, down, b, up))
        at = len(first) + len(merged) - 1
        sums[at] = x + y
        heapq.heappush(heap, (-int(sums[at].max() - sums[at].min()), at))
    places: dict[int, np.ndarray] = {}
    total = np.zeros(bins, dtype=np.int64)
    if heap:
        root = heap[0][1]
        places[root], total = np.arange(bins), sums[root] if root in sums else take(root, True)[0]  # of each entry of a solution: its bin in the end
    for k in range(len(merged) - 1, -1, -1):
        a, down, b, up = merged[k]
        at = places.pop(len(first) + k)
        for part, order, whole in ((a, down, at), (b, up, at[::-1])):
            if order is None:
                places[part] = whole[: first[part][1]].copy()
            else:
                places[part] = np.empty(bins, dtype=np.int64)
                places[part][order] = at
    out = [places[i][:n] for i, (_, n) in enumerate(first)]
    for size, n in groups[most:]:
        out.append(np.argsort(total, kind="stable")[:n])
        total[out[-1]] += size
    return out, total


def bins_for(shares: Sequence[tuple[str, float]]) -> int:
    """The number of bins: enough for PER_SPLIT bins of the smallest positive share. More than MAX_BINS raise ValueError."""
    total = sum(s for _, s in shares)
    least = min((s / total for _, s in shares if s > 0), default=1.0)
    n = max(MIN_BINS, math.ceil(PER_SPLIT / least - 1e-9))
    if n > MAX_BINS:
        raise ValueError(f"a share of {least:g} of the total needs {n} bins, more than {MAX_BINS}")
    return n


def allot_bins(sums: Sequence[int], shares: Sequence[tuple[str, float]]) -> list[str]:
    """The split of each bin: the heaviest bin first, each to the split that lacks most of its target."""
    total, scale = sum(sums), sum(s for _, s in shares) or 1.0
    lack = {name: total * s / scale for name, s in shares}
    out = [""] * len(sums)
    for k in sorted(range(len(sums)), key=lambda k: (-sums[k], k)):
        name = max(lack, key=lambda n: lack[n])
        lack[name] -= sums[k]
        out[k] = name
    return out


def tied_records(df: DataFrame, id_col: str = "document_id", keys: Sequence[str] = ("parent_document_id", "split_group_id"), label: str = "split") -> DataFrame:
    """(document_id, component, label): each distinct record with the component of its keys.

    The values of all keys share one name space. A null or blank key ties nothing; a record without any key
    is a component of its own.
    """
    at = [f"k{i}" for i in range(len(keys))]
    recs = df.select(F.col(id_col).alias("document_id"), *(blank_to_null(k).alias(a) for k, a in zip(keys, at, strict=True)), split_label(label).alias("label")).distinct()
    recs = written(recs, "records")
    edges = None
    for a in at[1:]:
        e = recs.where(F.col(at[0]).isNotNull() | F.col(a).isNotNull()).select(F.col(at[0]).alias("src"), F.col(a).alias("dst")).distinct()
        edges = e if edges is None else edges.unionByName(e)
    for i in range(1, len(at)):  # records without the first key
        for j in range(i + 1, len(at)):
            edges = edges.unionByName(recs.where(F.col(at[0]).isNull()).select(F.col(at[i]).alias("src"), F.col(at[j]).alias("dst")).distinct())
    own = F.coalesce(*at)
    recs = recs.select("document_id", "label", own.alias("node"))
    if edges is None:
        comp = F.col("node")
    else:
        recs = recs.join(connected_components(edges), "node", "left")
        comp = F.coalesce("component", "node")
    return recs.select("document_id", F.coalesce(comp, F.concat(F.lit("record:"), F.coalesce("document_id", F.lit("")))).alias("component"), "label")


def related_splits(df: DataFrame, shares: DataFrame, id_col: str = "document_id", keys: Sequence[str] = ("parent_document_id", "split_group_id"), label: str = "split", bins: int | None = None) -> DataFrame:
    """(document_id, component, component_size, conflict, bin, split): one split for all records tied together.

    shares has (split, share); null and negative shares count as 0, repeated splits add up. conflict tells
    that records of the component bore two or more different labels before. An empty df gives no rows; no
    shares at all raise ValueError, and so does a positive share that needs more than MAX_BINS bins. Without bins
    given, their number follows from the smallest share. A component larger than a split's target goes where most is
    lacking, and split_report shows it. Null document_ids are kept as one record per component.
    """
    spark = df.sparkSession
    wanted = [(r["split"], max(0.0, r["share"] or 0.0)) for r in shares.groupBy(split_label("split").alias("split")).agg(F.sum("share").alias("share")).where("split is not null").orderBy("split").collect()]
    if not wanted:
        raise ValueError("shares has no split")
    recs = written(tied_records(df, id_col, keys, label), "tied")
    comps = recs.groupBy("component").agg(F.count_distinct(F.coalesce("document_id", F.lit(""))).alias("component_size"), (F.min("label") != F.max("label")).alias("conflict"))
    comps = written(comps, "components")
    histogram = [(r[0], r[1]) for r in comps.groupBy("component_size").count().orderBy(F.desc("component_size")).collect()]

    bins = bins or bins_for(wanted)
    left = [(size, n % bins) for size, n in histogram if n % bins]
    placed, sums = largest_differencing(left, bins)
    sums = sums + sum(size * (n // bins) for size, n in histogram)
    of_bin = spark.createDataFrame(pa.table({"bin": pa.array(range(bins), pa.int32()), "split": allot_bins(sums.tolist(), wanted)}))

    # the rank of each component among those of its size, by hashed buckets so that no size is one task
    buckets = max(64, sum(n for _, n in histogram) // 1_000_000)
    comps = comps.withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(buckets)).cast("int"))
    before = comps.groupBy("component_size", "bucket").count()
    before = before.select("component_size", "bucket", (F.sum("count").over(Window.partitionBy("component_size").orderBy("bucket")) - F.col("count")).alias("before"))
    within = F.row_number().over(Window.partitionBy("component_size", "bucket").orderBy("component"))
    comps = comps.withColumn("within", within).join(before, ["component_size", "bucket"]).withColumn("rank", F.col("before") + F.col("within") - 1)
    full = {size: n - n % bins for size, n in histogram}
    sizes = np.repeat(np.array([s for s, _ in left], dtype=np.int64), [n for _, n in left])
    ranks = np.concatenate([np.arange(full[s], full[s] + n) for s, n in left] or [np.empty(0)]).astype(np.int64)
    extra = spark.createDataFrame(pa.table({"component_size": sizes, "rank": ranks, "extra": np.concatenate(placed or [np.empty(0)]).astype(np.int32)}))
    comps = comps.join(extra, ["component_size", "rank"], "left")  # fewer than bins rows a size, sqrt(2 N bins) in all
    comps = comps.withColumn("bin", F.coalesce("extra", F.pmod("rank", F.lit(bins)).cast("int"))).join(F.broadcast(of_bin), "bin")  # a row per bin
    comps = comps.select("component", "component_size", F.coalesce("conflict", F.lit(False)).alias("conflict"), "bin", "split")
    return recs.select("document_id", "component").distinct().join(comps, "component").select("document_id", "component", "component_size", "conflict", "bin", "split")


def split_report(assigned: DataFrame, shares: DataFrame) -> DataFrame:
    """(split, documents, actual_share, target_share, largest_component) of what related_splits gave; splits without documents too.

    Shares are of the sum of all shares. A largest_component beyond target_share x documents in all tells that a tied set
    alone is more than the split was to get."""
    target = shares.groupBy(split_label("split").alias("split")).agg(F.sum(F.greatest(F.coalesce("share", F.lit(0.0)), F.lit(0.0))).alias("share")).where("split is not null")
    got = assigned.groupBy("split").agg(F.count_distinct("document_id").alias("documents"), F.max("component_size").alias("largest"))
    documents, every = F.coalesce("documents", F.lit(0)), Window.partitionBy()  # a row per split
    d = target.join(got, "split", "left")
    return d.select("split", documents.alias("documents"), F.round(documents / F.sum(documents).over(every), 6).alias("actual_share"), F.round(F.col("share") / F.sum("share").over(every), 6).alias("target_share"), F.coalesce("largest", F.lit(0)).alias("largest_component"))
