import random
from collections import defaultdict

import pytest

from corpusmill.llm.related_splits import allot_bins, bins_for, largest_differencing, related_splits, split_report, tied_records

SCHEMA = "document_id string, parent_document_id string, split_group_id string, split string, component string, bin int, label string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)  # extra columns with clashing names


def shares(spark):
    return spark.createDataFrame([("train", 0.8), ("validation", 0.1), (" Test", 0.1), (None, 0.5)], "split string, share double")


def test_differencing_balances_and_places_all(monkeypatch):
    rng = random.Random(1)
    groups = [(size, rng.randint(1, 9)) for size in sorted(rng.sample(range(1, 400), 90), reverse=True)]
    for cells in (1 << 25, 0):  # with and without small change dealt at the end
        monkeypatch.setattr("corpusmill.llm.related_splits.CELLS", cells)
        placed, sums = largest_differencing(groups, 10)
        again = [0] * 10
        for (size, n), at in zip(groups, placed, strict=True):
            assert len(set(at.tolist())) == n  # each in a bin of its own
            for k in at:
                again[k] += size
        assert again == sums.tolist() and max(again) - min(again) <= 0.001 * max(again)
    assert largest_differencing([], 4)[0] == [] and sorted(largest_differencing([(7, 2)], 4)[1].tolist()) == [0, 0, 7, 7]


def test_small_shares_are_not_empty(spark):
    """The shares of a production run: each split within one bin of its target."""
    rng = random.Random(3)
    df = frame(spark, [(f"d{i}", f"p{min(i // 2, rng.randint(0, 40_000))}", None, None) for i in range(60_000)])
    want = [("train", 0.997), ("validation", 0.001), ("test", 0.001), ("trajectory_holdout", 0.001)]
    shares = spark.createDataFrame(want, "split string, share double")
    got = {r["split"]: r for r in split_report(related_splits(df, shares), shares).collect()}
    bin_ = 60_000 / bins_for(want)
    for name, s in want:
        assert abs(got[name]["documents"] - s * 60_000) <= bin_ + 1, got[name]
    assert bins_for([("a", 0.5), ("b", 0.5), ("c", 0.0)]) == 200
    with pytest.raises(ValueError):
        bins_for([("a", 1.0), ("b", 1e-6)])


def test_a_component_beyond_a_target_is_reported(spark):
    df = frame(spark, [(f"d{i}", "hub" if i < 300 else f"p{i}", None, None) for i in range(900)])
    got = {r["split"]: r for r in split_report(related_splits(df, shares(spark)), shares(spark)).collect()}
    assert got["train"]["largest_component"] == 300 and got["test"]["documents"] == pytest.approx(90, abs=5)


def test_bins_go_to_splits_by_share():
    got = allot_bins([10] * 10, [("a", 0.7), ("b", 0.3)])
    assert got.count("a") == 7 and got.count("b") == 3


def test_ties_against_union_find(spark):
    rng = random.Random(2)
    vals = [None, "", "  ", *(f"{'AbC' if i % 2 else 'abc'}{i}" for i in range(60))]
    recs = [(f"d{i}", rng.choice(vals), rng.choice(["HUB", " hub "]) if i % 3 == 0 else rng.choice(vals), rng.choice(["train", "VAL", "validation", None, " "])) for i in range(150)]
    recs += [(f"c{i}", f"n{i}", f"n{i + 1}", "train") for i in range(40)]  # a long chain
    parent: dict = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for d, p, g, _ in recs:
        for v in (p, g):
            if v and v.strip():
                parent[find(("v", v.strip().lower()))] = find(("d", d))
    want = defaultdict(set)
    for d, *_ in recs:
        want[find(("d", d))].add(d)
    got = defaultdict(set)
    for r in tied_records(frame(spark, recs)).collect():
        got[r["component"]].add(r["document_id"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    out = related_splits(frame(spark, recs + recs[:5]), shares(spark)).collect()
    by = defaultdict(set)
    for r in out:
        by[r["component"]].add(r["split"])
    assert len(out) == len(recs) and all(len(s) == 1 for s in by.values())


def test_conflict_ignores_spelling_and_blanks(spark):
    df = frame(spark, [("a", "p", None, "val"), ("b", "P ", "", " Validation"), ("c", "p", None, None), ("d", "q", None, "test"), ("e", None, "q", "train"), ("f", None, None, "train")])
    bad = {r[0] for r in related_splits(df, shares(spark)).where("conflict").select("document_id").collect()}
    assert bad == {"d", "e"}


def test_proportions_and_stability(spark):
    df = frame(spark, [(f"d{i}", f"p{i // (1 + i % 3)}", None, None) for i in range(2000)])
    a = related_splits(df, shares(spark))
    b = related_splits(df.repartition(7), shares(spark))
    assert {tuple(r) for r in a.select("document_id", "split").collect()} == {tuple(r) for r in b.select("document_id", "split").collect()}
    got = {r["split"]: r["actual_share"] for r in split_report(a, shares(spark)).collect()}
    assert abs(got["train"] - 0.8) < 0.01 and abs(got["test"] - 0.1) < 0.01


def test_empty_and_null(spark):
    assert related_splits(frame(spark, []), shares(spark)).count() == 0
    out = related_splits(frame(spark, [(None, None, None, None), (None, None, None, None), ("a", None, None, "x")]), shares(spark)).collect()
    assert len(out) == 2
    with pytest.raises(ValueError):
        related_splits(frame(spark, []), shares(spark).limit(0))
