import itertools
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm.packing import best_fit_decreasing, bin_completion, broken_items, lower_bound, pack, placed_ids, records

SCHEMA = "document_id string, split string, token_ids array<int>, token_count int, record string, place int, item string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", 1, "y") for r in rows], SCHEMA)


def optimum(sizes, cap):
    best = len(sizes)
    for k in range(1, len(sizes) + 1):
        for a in itertools.product(range(k), repeat=len(sizes)):
            load = [0] * k
            for s, b in zip(sizes, a, strict=True):
                load[b] += s
            if max(load) <= cap:
                return k
    return best


def test_completion_finds_the_optimum_of_small_cases():
    rng = random.Random(3)
    for _ in range(40):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(1, 7))]
        got = bin_completion(sizes, 20)
        assert sorted(i for r in got for i in r) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in r) <= 20 for r in got)
        assert len(got) == optimum(sizes, 20)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_every_item_is_placed_once(sizes):
    got = bin_completion(sizes, 64, max_nodes=300)
    assert sorted(i for r in got for i in r) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in r) <= 64 for r in got)
    counts = {s: sizes.count(s) for s in sizes}
    assert len(got) <= len(best_fit_decreasing(counts, 64))


def test_lower_bound():
    assert lower_bound({}, 10) == 0 and lower_bound({6: 3}, 10) == 3 and lower_bound({5: 4}, 10) == 2 and lower_bound({7: 2, 4: 3}, 10) == 4
    rng = random.Random(8)
    for _ in range(40):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(1, 7))]
        assert lower_bound({s: sizes.count(s) for s in sizes}, 20) <= optimum(sizes, 20)


def test_beats_best_fit():
    sizes = [6, 6, 6, 5, 5, 5, 4, 4, 4] * 2 + [7, 3, 8, 2]
    assert len(bin_completion(sizes, 10)) <= len(best_fit_decreasing({s: sizes.count(s) for s in sizes}, 10))


def test_records_hold_every_token_in_order(spark):
    rng = random.Random(4)
    docs = {f"d{i}": [rng.randint(3, 999) for _ in range(rng.choice([1, 5, 100, 300, 510, 511, 1300]))] for i in range(60)}
    rows = [(d, rng.choice(["train", " TRAIN", "val", None, ""]), t) for d, t in docs.items()]
    rows += rows[:7] + [("empty", "train", []), ("null", "train", None)]
    df = frame(spark, rows)
    recs = records(df, pack(df, group_items=20)).collect()
    seen: dict = {}
    for r in recs:
        assert len(r["input_token_ids"]) == len(r["target_token_ids"]) == len(r["loss_mask"]) == len(r["attention_mask"]) == 512
        assert r["input_token_ids"][1:] == r["target_token_ids"][:-1] and sum(r["attention_mask"]) == 512 - r["padding"] and sum(r["loss_mask"]) == 511 - r["padding"]
        body = r["input_token_ids"][: 512 - r["padding"]]
        at = 0
        for k, (d, piece) in enumerate(zip(r["source_document_ids"], r["pieces"], strict=True)):
            part = docs[d][510 * piece : 510 * (piece + 1)]
            assert body[at] == (0 if k == 0 else 2) and body[at + 1 : at + 1 + len(part)] == part and body[at + 1 + len(part)] == 1
            at += len(part) + 2
            seen.setdefault(d, set()).add(piece)
        assert at == len(body)
    assert {d: set(range(-(-len(t) // 510))) for d, t in docs.items()} == seen


def test_rows_without_id_are_kept_and_splits_stay_apart(spark):
    df = frame(spark, [(None, "train", [5, 6]), (None, "train", [7]), (None, "test", [7]), ("a", "test", [9, None])])
    packed = placed_ids(df, pack(df)).dropDuplicates(["item"]).collect()
    assert len(packed) == 3 and {tuple(r["token_ids"]) for r in packed} == {(5, 6), (7,), (9, -1)}
    assert pack(frame(spark, [])).count() == 0 and records(frame(spark, []), pack(frame(spark, []))).count() == 0


def test_broken_items(spark):
    docs = frame(spark, [("a", "train", [5, 6, 7]), ("b", "train", [8]), ("long", "train", list(range(600))), ("none", "train", [])])
    views = spark.createDataFrame([("v1", ["a", "b"], [0, 5, 6, 7, 1, 2, 8, 1]), ("v2", ["a", "b", "long"], [0, 5, 6, 1, 2, 18, 1]), ("v3", ["none", "zz"], [0]), ("v4", None, [0]), ("v1", ["a", "b"], [0, 5, 6, 7, 1, 2, 8, 1])], "view_id string, source_document_ids array<string>, input_token_ids array<int>")
    assert {tuple(r) for r in broken_items(views, docs, pack(docs)).collect()} == {("v2", "a"), ("v2", "b")}
