"""Connected components of an edge table by randomised contraction.

Each round every node picks, of itself and its neighbours, the one with the smallest hash (a new hash
function per round) and the edges are rewritten to the picked nodes. The edge table shrinks by a constant
factor in expectation, whatever the shape of the graph, so long chains need O(log n) rounds and a hub with
a third of all edges vanishes in the first one. The minimum per node is a plain aggregate with map-side
combine, so no task ever holds a node's neighbours. Once at most LAST edges are left, one task joins their ends
by union and find; that gives the same sets as going on would, without the rounds of a table that small.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import written

#: Edges that one task takes.
LAST = 200_000


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100, last: int = LAST) -> DataFrame:
    """(node, component) of each node that has an edge to another; component is the smallest node of its set.

    Null ends, self-loops, repeated and reversed edges are ignored; an empty table gives an empty result.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    e = written(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    maps = []
    while n := e.count():
        if n <= last:
            kind = e.schema["u"].dataType.simpleString()
            maps.append(written(e.coalesce(1).mapInArrow(_joined, f"node {kind}, rep {kind}"), "picked"))  # at most `last` rows
            break
        if len(maps) == max_rounds:
            raise RuntimeError(f"the edges did not contract within {max_rounds} rounds")
        seed = len(maps)
        rank = lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("h"), F.col(c).alias("n"))  # noqa: B023, E731
        both = e.select("u", rank("v").alias("x")).unionByName(e.select(F.col("v").alias("u"), rank("u").alias("x")))
        best = both.groupBy("u").agg(F.min("x").alias("x"))
        m = written(best.select(F.col("u").alias("node"), F.least("x", rank("u"))["n"].alias("rep")), "picked")
        maps.append(m)
        e = (
            e.join(m.select(F.col("node").alias("u"), F.col("rep").alias("ru")), "u")
            .join(m.select(F.col("node").alias("v"), F.col("rep").alias("rv")), "v")
            .where("ru <> rv")
            .select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v"))
            .distinct()
        )
        e = written(e, "edges")
    if not maps:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    total, several = maps.pop(), len(maps) > 0
    while maps:
        later = total.select(F.col("node").alias("rep"), F.col("rep").alias("last"))
        total = maps.pop().join(later, "rep", "left").select("node", F.coalesce("last", "rep").alias("rep"))
    total = written(total, "reps") if several else total
    least = total.groupBy("rep").agg(F.min("node").alias("component"))
    return total.join(least, "rep").select("node", "component")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, rep) of all ends of the edges (u, v) of one task."""
    rows = list(batches)
    if not rows:
        return
    ends = pa.chunked_array([b.column(c) for c in ("u", "v") for b in rows]).combine_chunks().dictionary_encode()
    codes = ends.indices.to_pylist()
    half = len(codes) // 2
    root = list(range(len(ends.dictionary)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in zip(codes[:half], codes[half:], strict=True):
        root[find(a)] = find(b)
    rep = pa.array([find(x) for x in range(len(root))], pa.int32())
    yield pa.RecordBatch.from_arrays([ends.dictionary, ends.dictionary.take(rep)], names=["node", "rep"])
