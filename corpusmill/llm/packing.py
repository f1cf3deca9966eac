"""Filling fixed-capacity records with whole documents (problem 2): bin completion.

A record is `<BOS> ids <EOS> <DOC> ids <EOS> ...`, padded with <EOS>: each document costs its ids and two
more. A document that alone exceeds the capacity is cut into full pieces and a rest; every other document
stays whole.

Scale: only (id, size) pairs are packed. They are dealt by hash into groups of a bounded number of items per
split; each group is one task-local search, so no split is ever one task, and a group loses about a record.
Token ids stay where they are until the records are known: copies are told apart by a hash, and each array then moves to
its record, which is bounded by its capacity.

Search: the largest remaining document opens a record; its undominated completions are enumerated, those
with the least waste first; a branch is cut when its waste exceeds what still beats the incumbent. The
incumbent starts as best-fit decreasing. The search ends at the lower bound or after `max_nodes` records
tried, with the incumbent; no item is ever left out.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.related_splits import split_label
from corpusmill.session import blank_to_null, broadcast_if_small, written

CAPACITY, BOS, EOS, DOC = 512, 0, 1, 2
#: Ids that every document in a record costs besides its own.
FRAME = 2


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[list[int]]:
    """Records as lists of sizes: each size, the largest first, into the fullest record that takes it."""
    room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    free: list[int] = []  # residual capacities in use, sorted
    out: list[list[int]] = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            i = bisect_right(free, size - 1)
            if i < len(free):
                r = free[i]
                rec = room[r].pop()
                if not room[r]:
                    free.pop(i)
            else:
                r, rec = capacity, []
                out.append(rec)
            rec.append(size)
            r -= size
            if not room[r]:
                free.insert(bisect_right(free, r), r)
            room[r].append(rec)
    return out


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Records that any packing needs: the most of the bounds that count items over half the capacity, one for
    each least size of the smaller items that are taken into account."""
    total = sum(s * n for s, n in counts.items())
    best = -(-total // capacity)
    sizes = sorted(counts)
    for k in [s for s in sizes if 2 * s <= capacity]:
        alone = sum(counts[s] for s in sizes if s > capacity - k)
        half = [(s, counts[s]) for s in sizes if 2 * s > capacity and s <= capacity - k]
        small = sum(s * counts[s] for s in sizes if k <= s and 2 * s <= capacity)
        room = sum((capacity - s) * n for s, n in half)
        best = max(best, alone + sum(n for _, n in half) + max(0, -(-(small - room) // capacity)))
    return max(best, sum(n for s, n in counts.items() if 2 * s > capacity))


def completions(sizes: list[int], counts: dict[int, int], rest: int, most: int) -> list[tuple[int, tuple[int, ...]]]:
    """Undominated fillings of `rest` as (waste, sizes), least waste first.

    sizes: those available, largest first. A filling is dominated if some of its items can be exchanged for
    one available larger item that still fits. At most `most` are returned; a filling without waste ends the
    enumeration, as nothing dominates it. Where an item leaves a gap that nothing fits into, smaller items are not
    tried in its place: that leaves out some undominated fillings, but keeps the large items first and the
    small ones for later, and on real sizes gives fewer records in less time than the whole enumeration.
    """
    found: list[tuple[int, tuple[int, ...]]] = []
    low = sizes[-1] if sizes else rest + 1
    steps = 0

    def grow(i: int, rest: int, chosen: tuple[int, ...]) -> bool:
        nonlocal steps
        steps += 1
        if steps > 40 * most:
            return True
        more = False
        n = len(sizes)
        while i < n and sizes[i] > rest:
            i += 1
        for j in range(i, n):
            s = sizes[j]
            if counts[s] - chosen.count(s) > 0:
                more = True
                if grow(j, rest - s, (*chosen, s)):
                    return True
                if rest - s < low:  # alone, every later size would leave a larger gap
                    break
        if not more:
            found.append((rest, chosen))
            return rest == 0 or len(found) >= 8 * most
        return False

    grow(0, rest, ())
    found.sort(key=lambda x: (x[0], tuple(-s for s in x[1])))
    kept = []
    have = set(sizes)
    for waste, chosen in found:
        if waste and len(chosen) <= 6:
            sums = {0: 0}
            for s in chosen:
                sums |= {t + s: k + 1 for t, k in sums.items() if t + s not in sums or sums[t + s] < k + 1}
            if any(z in have and (k > 1 or z > t) and counts[z] - chosen.count(z) > 0 for t, k in sums.items() if t for z in range(t, t + waste + 1)):
                continue
        kept.append((waste, chosen))
        if len(kept) == most:
            break
    return kept or found[:1]


def bin_completion(item_sizes: list[int], capacity: int = CAPACITY, max_nodes: int = 12_000, branches: int = 4) -> list[list[int]]:
    """Indices of the items of each record. Every item of 1 to capacity is placed exactly once."""
    by_size: dict[int, list[int]] = {}
    for i, s in enumerate(item_sizes):
        if not 0 < s <= capacity:
            raise ValueError(f"an item of size {s} does not fit a record of {capacity}")
        by_size.setdefault(s, []).append(i)
    counts = {s: len(v) for s, v in by_size.items()}
    total = sum(item_sizes)
    bound = lower_bound(counts, capacity)
    best = best_fit_decreasing(counts, capacity)
    # depth-first: stack of (records chosen, iterator over the completions left to try there)
    nodes = 0
    sizes = sorted(counts, reverse=True)
    left = dict(counts)
    path: list[list[int]] = []
    stack: list[Iterator[tuple[int, list[int]]]] = []
    waste = 0
    wastes: list[int] = []

    def options() -> Iterator[tuple[int, list[int]]]:
        while sizes and not left[sizes[0]]:
            sizes.pop(0)
        first = sizes[0]
        left[first] -= 1
        there = [s for s in sizes if left[s]]
        got = completions(there, left, capacity - first, branches)
        left[first] += 1
        return iter([(w, [first, *c]) for w, c in got])

    while len(best) > bound and nodes < max_nodes:
        allowed = (len(best) - 1) * capacity - total
        if not any(left[s] for s in sizes):  # all placed
            if len(path) < len(best):
                best = [list(r) for r in path]
                continue
            step = None
        else:
            if len(stack) == len(path):
                stack.append(options())
                nodes += 1
            step = next((x for x in stack[-1] if waste + x[0] <= allowed), None)
        if step is None:
            if len(stack) > len(path):
                stack.pop()
            if not path:
                break  # searched through: the incumbent is the best
            for s in path.pop():
                left[s] += 1
            waste -= wastes.pop()
            sizes = sorted((s for s in left if left[s]), reverse=True)
            continue
        waste += step[0]
        wastes.append(step[0])
        path.append(step[1])
        for s in step[1]:
            left[s] -= 1
    return [[by_size[s].pop() for s in rec] for rec in best]


def _rows(df: DataFrame) -> DataFrame:
    """(item, document_id, split, token_ids, n, h) of the rows that have ids. Null ids within become -1. item is the document_id; rows
    without one are told apart by their token ids, so none is lost."""
    ids = F.transform("token_ids", lambda x: F.coalesce(x, F.lit(-1)))
    d = df.select(F.col("document_id").cast("string").alias("document_id"), F.coalesce(split_label("split"), F.lit("none")).alias("split"), ids.alias("token_ids")).where(F.size("token_ids") > 0)
    h = F.xxhash64("token_ids")
    return d.select(F.coalesce("document_id", F.concat(F.lit("null:"), F.md5(F.array_join("token_ids", ",")))).alias("item"), "document_id", "split", "token_ids", F.size("token_ids").alias("n"), h.alias("h"))


def items(df: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(item, document_id, split, h, piece, pieces, n): what is to be packed, once per document_id, without the ids.

    Empty and null token_ids give no item. Rows written twice count once; where copies differ, the first by split, length and
    hash h is taken.
    """
    room = capacity - FRAME
    one = _rows(df).groupBy("item", "document_id").agg(F.min(F.struct("split", "n", "h")).alias("x")).select("item", "document_id", "x.split", "x.h", F.col("x.n").alias("all"))
    cut = one.withColumn("pieces", F.ceil(F.col("all") / room).cast("int")).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    return cut.select("item", "document_id", "split", "h", "piece", "pieces", F.least(F.lit(room), F.col("all") - F.col("piece") * room).alias("n"))


def pack(df: DataFrame, capacity: int = CAPACITY, group_items: int = 4000, max_nodes: int = 12_000) -> DataFrame:
    """(item, document_id, split, h, piece, pieces, n, record, place): the record of each item and its place there.

    group_items is about the number of items that are packed together in one task. An empty df gives no rows.
    """
    it = written(items(df, capacity), "items")
    sizes = it.select("item", "split", "piece", "n")
    groups = sizes.groupBy("split").count().select("split", F.greatest(F.lit(1), F.ceil(F.col("count") / group_items)).cast("int").alias("groups"))
    keyed = sizes.join(groups, "split").withColumn("group", F.pmod(F.xxhash64("item", "piece"), F.col("groups")).cast("int"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "item", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        record, place = [0] * len(pdf), [0] * len(pdf)
        for k, rec in enumerate(bin_completion([int(n) + FRAME for n in pdf["n"]], capacity, max_nodes)):
            for p, i in enumerate(rec):
                record[i], place[i] = k, p
        name = pdf["split"] + "_" + pdf["group"].astype(str) + "_" + pd.Series(record).astype(str)
        return pd.DataFrame({"item": pdf["item"], "piece": pdf["piece"], "record": name, "place": place})

    # groups are few bytes but much work: a stated number of partitions, which is not merged by size at run time
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = keyed.repartition(tasks, "split", "group")
    placed = keyed.groupBy("split", "group").applyInPandas(solve, "item string, piece int, record string, place int")
    return written(it.join(placed, ["item", "piece"]).select(it["*"], "record", "place"), "placed")


def placed_ids(df: DataFrame, placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The placements with token_ids, those of the piece; a row that df has twice comes twice."""
    room = capacity - FRAME
    d = _rows(df).select("item", "h", F.col("token_ids").alias("ids")).join(broadcast_if_small(placed), ["item", "h"])
    whole = F.when(F.col("pieces") == 1, F.col("ids")).otherwise(F.slice("ids", F.col("piece") * room + 1, F.lit(room)))
    return d.select(*placed.columns, whole.alias("token_ids"))


def records(df: DataFrame, placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The items of df as they were packed, as view records: view_id, split, source_document_ids, input_token_ids, target_token_ids,
    loss_mask, attention_mask, pieces (the piece number of each document), padding. All arrays have `capacity` entries."""
    packed = placed_ids(df, placed, capacity)
    rec = packed.groupBy("record", "split").agg(F.sort_array(F.collect_set(F.struct("place", "document_id", "piece", "token_ids"))).alias("x"))  # a row written twice is one
    body = F.flatten(F.transform("x", lambda x: F.concat(F.array(F.when(x["place"] == 0, BOS).otherwise(DOC)), x["token_ids"], F.array(F.lit(EOS)))))
    rec = rec.select(F.col("record").alias("view_id"), "split", F.transform("x", lambda x: x["document_id"]).alias("source_document_ids"), F.transform("x", lambda x: x["piece"]).alias("pieces"), body.alias("seq"))
    n = F.size("seq")
    pad = lambda c, k, v: F.concat(c, F.array_repeat(F.lit(v), F.lit(capacity) - k))
    return rec.select(
        "view_id", "split", "source_document_ids", "pieces",
        pad(F.col("seq"), n, EOS).alias("input_token_ids"),
        pad(F.slice("seq", 2, capacity), n - 1, EOS).alias("target_token_ids"),
        pad(F.array_repeat(F.lit(1), n - 1), n - 1, 0).alias("loss_mask"),
        pad(F.array_repeat(F.lit(1), n), n, 0).alias("attention_mask"),
        (F.lit(capacity) - n).alias("padding"),
    )


def _text(ids: Column) -> Column:
    return F.concat(F.lit(","), F.array_join(ids, ",", "-1"), F.lit(","))


def broken_items(views: DataFrame, df: DataFrame, placed: DataFrame) -> DataFrame:
    """(view_id, document_id): documents that an earlier run lists in a view although the packing of df keeps them whole
    in one record, but that do not stand there in order and without a gap.

    Document ids are compared with case and surrounding blanks aside. A document that views list but
    nothing packed (empty, unknown) is no case.
    """
    whole = placed_ids(df, placed.where("pieces = 1 and record is not null")).select(blank_to_null("document_id").alias("key"), "token_ids")
    listed = views.select("view_id", "input_token_ids", F.explode(F.array_distinct("source_document_ids")).alias("document_id"))
    listed = listed.select("view_id", "document_id", blank_to_null("document_id").alias("key"), "input_token_ids")
    return listed.join(whole, "key").where(~F.contains(_text(F.col("input_token_ids")), _text(F.col("token_ids")))).select("view_id", "document_id").distinct()
