"""Scan, segments, deduplication, decontamination, selection, freezing, views and statistics on small cases."""

import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import decontam, dedup, freeze, identity, ingest, layers, segment, splits, stats, tokens, views
from corpusmill.operators.components import connected_components
from corpusmill.operators.running import running


def words(n, w="w"):
    return " ".join([w] * n)


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(f"a{i:03}", f"a{i + 1:03}") for i in range(120)] + [("hub", f"leaf{i}") for i in range(300)] + [("x", "y"), ("y", "z"), ("z", "x"), ("y", "x"), ("s", "s"), (None, "q")]
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    for last in (0, 50):  # by contraction alone, and with a rest for one task
        assert got == {r["node"]: r["component"] for r in connected_components(df, last=last).collect()}
    assert {got[f"a{i:03}"] for i in range(121)} == {"a000"} and {got[f"leaf{i}"] for i in range(300)} == {"hub"} and got["z"] == "x" and "s" not in got and "q" not in got
    assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_running_against_plain_loop(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "b", None]), rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "i long, k string, v long")
    got = {r["i"]: (r["s"], r["m"]) for r in running(df.repartition(5), "k", F.floor(F.col("i") / 37), ["i"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}).collect()}
    s, m = Counter(), Counter()
    for i, k, v in rows:
        assert got[i] == (s[k], m[k])
        s[k], m[k] = s[k] + v, max(m[k], v)


def scan(spark, sizes, **kw):
    df = spark.createDataFrame([(i, "S", words(n)) for i, n in enumerate(sizes)], "idx long, source string, text string")
    config = spark.createDataFrame([("S", 1.0)], "source string, share double")
    out = ingest.bounded_scan(df, config, 1000, **kw)
    return {r["idx"]: r["status"] for r in out.collect()}, ingest.scan_counters(out).first()


def test_scan_probe_then_balanced(spark):
    got, c = scan(spark, [5000, 6000, 7000, 60])
    assert got == {0: "probe", 1: "oversized", 2: "oversized", 3: "balanced"} and c["stop_reason"] == "source_exhausted" and c["tokens"] == 60


def test_scan_stops(spark):
    got, c = scan(spark, [5000] * 10, max_oversized=3)
    assert len(got) == 4 and c["stop_reason"] == "consecutive_oversized_limit" and c["oversized"] == 3
    got, c = scan(spark, [5000, 5000, 10, 5000, 5000, 10] * 3, max_oversized=3)
    assert len(got) == 18 and c["stop_reason"] == "source_exhausted"
    got, c = scan(spark, [10] * 10, max_scanned=2)
    assert len(got) == 2 and c["stop_reason"] == "max_records_scanned"
    got, c = scan(spark, [0, 10, 10, 10], max_records=2)
    assert len(got) == 3 and c["stop_reason"] == "max_records_per_source" and got[0] == "blank"
    got, c = scan(spark, [700, 700, 700])
    assert len(got) == 2 and c["stop_reason"] == "budget_reached" and c["tokens"] == 1400


def test_pool_and_quota(spark):
    df = spark.createDataFrame([(f"d{i}", "s", i << 53, 10, list(range(10))) for i in range(20)] + [("x", "unknown", 1, 5, [1])], "document_id string, source string, priority long, n_tokens long, token_ids array<int>")
    pool = ingest.select_pool(df, spark.createDataFrame([("s", 95)], "source string, pool long"))
    assert pool.count() == 10 and {r[0] for r in pool.select("document_id").collect()} == {f"d{i}" for i in range(10)}
    quota = spark.createDataFrame([("s", 95), ("none", 0)], "source string, quota long")
    sel = ingest.select_quota(df, quota)
    assert sel.agg(F.sum("n_taken"), F.count_if("truncated")).first()[:] == (95, 1)
    assert {r["source"]: r["within"] for r in ingest.quota_deviation(sel, quota).collect()} == {"s": True, "none": True}


def test_priority_and_counts():
    assert identity.parse_count("50M") == 50_000_000 and identity.parse_count("1.5b") == 1_500_000_000 and identity.parse_count(" 7 ") == 7


def test_spans(spark):
    t = "😀 One. Two!  Three\n\n\nFour <ANSWER>a\nb</ANSWER> <EQUATION>x</EQUATION>\n\n"
    df = spark.createDataFrame([(t,), ("",), (None,)], "t string")
    r = df.select(segment.structure(F.col("t")).alias("s")).collect()
    cut = lambda k: [t[s["start"] : s["end"]] for s in r[0]["s"][k]]
    assert cut("paragraph_spans") == ["😀 One. Two!  Three", "Four <ANSWER>a\nb</ANSWER> <EQUATION>x</EQUATION>"]
    assert cut("sentence_spans") == ["😀 One.", "Two!", t[t.index("Three") :]]
    assert cut("turn_spans") == ["<ANSWER>a\nb</ANSWER>"] and cut("equation_spans") == ["<EQUATION>x</EQUATION>"]
    assert all(r[i]["s"]["paragraph_spans"] == [] for i in (1, 2))


def test_segments(spark):
    df = spark.createDataFrame([(1, "\n\n".join(words(30, f"p{i}") for i in range(7))), (2, words(5)), (3, " "), (4, None)], "doc_id long, text string")
    out = segment.segments(df, most=100, target=70, least=20).orderBy("segment_id").collect()
    assert [r["segment_id"] for r in out] == ["1_seg0", "1_seg1", "1_seg2", "1_seg3", "2_seg0"] and out[0]["segment_count"] == 4
    assert out[0]["previous_segment_id"] is None and out[1]["previous_segment_id"] == "1_seg0" and out[3]["next_segment_id"] is None


def test_exact_winner(spark):
    df = spark.createDataFrame([("a", "same", "web", 1), ("b", "same", "books", 9), ("c", "same", "books", 5), ("d", None, "books", 0)], "id string, t string, c string, p long")
    r = dedup.exact_duplicates(df, "t", dedup.category_score(F.col("c")), F.col("p"), "id").collect()
    assert len(r) == 1 and r[0]["winner"] == "c" and r[0]["copies"] == 3


def near_case():
    rng = random.Random(7)
    vocab = [f"v{i}" for i in range(300)]
    docs = {}
    for i in range(40):
        w = [rng.choice(vocab) for _ in range(rng.choice([6, 40, 120]))]
        docs[f"d{i:02}"] = " ".join(w)
        for j in range(rng.randint(0, 3)):
            v = list(w)
            for _ in range(rng.randint(0, 3)):
                v[rng.randrange(len(v))] = rng.choice(vocab)
            docs[f"d{i:02}x{j}"] = " ".join(v)
    boiler = words(50, "footer")
    return docs | {f"e{i}": boiler + f" own{i}" for i in range(20)} | {"short": "too few words", "none": None, "empty": ""}


def test_near_duplicates_against_all_pairs(spark):
    docs = near_case()
    sh = {}
    for d, t in docs.items():
        w = (t or "").lower().split()
        sh[d] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    rep = {}
    for d in sorted(docs):
        rep.setdefault(sh[d] or d, d)
    cls = {d: rep[sh[d] or d] for d in docs}
    reps = sorted(set(cls.values()))
    want = {(a, b) for i, a in enumerate(reps) for b in reps[i + 1 :] if sh[a] and sh[b] and len(sh[a] & sh[b]) / len(sh[a] | sh[b]) >= 0.8}
    df = spark.createDataFrame(list(docs.items()), "id string, t string")
    sets, _ = dedup.shingle_classes(df, "id", "t")
    assert {(r["a"], r["b"]) for r in dedup.similar_pairs(sets).collect()} == want and len(want) > 5
    out = {r["document_id"]: r for r in dedup.near_duplicates(df, "id", "t").collect()}
    assert {d: r["class_id"] for d, r in out.items()} == cls
    deg = Counter(x for p in want for x in p)
    assert {r["class_id"]: r["links"] for r in dedup.class_links(df, "id", "t").collect()} == {r: deg[r] for r in reps}
    group = {r: r for r in reps}
    for _ in reps:  # the smallest of all that are connected
        for a, b in want:
            group[a] = group[b] = min(group[a], group[b])
    assert {d: r["cluster"] for d, r in out.items()} == {d: group[c] for d, c in cls.items()}
    assert dedup.near_duplicates(df.limit(0), "id", "t").count() == 0


def test_minhash_links_similar_documents(spark):
    docs = near_case()
    df = spark.createDataFrame(list(docs.items()), "id string, t string")
    sig = {r["document_id"]: r["signature"] for r in dedup.minhash(df, "id", "t").collect()}
    assert len(sig["d00"]) == 128 and "short" not in sig and "none" not in sig
    links = {(r["a"], r["b"]) for r in dedup.band_links(dedup.minhash(df, "id", "t")).collect()}
    assert all(a < b for a, b in links) and links


def test_a_large_cluster_of_near_copies(spark):
    """Copies that all differ, of one template, and two chains through it: no step has their pairs."""
    own = F.concat_ws(" ", *(F.concat(F.lit(f"t{j}_"), F.lit("x")) for j in range(120)))
    d = spark.range(20_000).select(F.col("id"), F.concat(own, F.lit(" own"), F.col("id")).alias("t"))
    other = spark.range(20_000, 20_050).select(F.col("id"), F.concat_ws(" ", *(F.concat(F.lit(f"o{j}_"), (F.col("id") * 7 + j).cast("string")) for j in range(60))).alias("t"))
    out = dedup.near_duplicates(d.unionByName(other), "id", "t")
    assert [tuple(r) for r in out.groupBy("cluster").count().where("count > 1").collect()] == [(0, 20_000)] and out.count() == 20_050


def test_lsh_links_are_similar_and_most_are_met(spark):
    rng = random.Random(3)
    docs = {}
    for i in range(60):
        w = [f"v{rng.randrange(500)}" for _ in range(200)]
        for j in range(4):
            v = list(w)
            for _ in range(j % 2):
                v[rng.randrange(len(v))] = "edit"
            docs[i * 10 + j] = " ".join(v[: 200 - 2 * j])
    df = spark.createDataFrame(list(docs.items()), "id long, t string")
    sh = {d: {tuple(t.split()[k : k + 20]) for k in range(len(t.split()) - 19)} for d, t in docs.items()}
    sim = lambda a, b: len(sh[a] & sh[b]) / len(sh[a] | sh[b])
    got = {(r["a"], r["b"]): r["similarity"] for r in dedup.lsh_links(df, "id", "t").collect()}
    assert all(abs(sim(a, b) - s) < 1e-9 and s >= 0.9 for (a, b), s in got.items())

    def clusters(pairs):
        g = {d: d for d in docs}
        for _ in range(5):
            for a, b in pairs:
                g[a] = g[b] = min(g[a], g[b])
        return {(a, b) for a in g for b in g if a < b and g[a] == g[b]}

    want = clusters([(a, b) for a in docs for b in docs if a < b and sim(a, b) >= 0.9])
    assert len(clusters(got) & want) >= 0.9 * len(want) and want


def test_paragraphs_are_stripped_by_place(spark):
    para = words(50, "notice")
    df = spark.createDataFrame([(i, f"{para}\n\n{words(70, f'own{i}')}\n\n{para}") for i in range(10)] + [(99, words(70, "x"))], "id long, t string")
    out = {r["id"]: r for r in dedup.strip_frequent_paragraphs(df, "id", "t").collect()}
    assert out[3]["stripped_text"] == words(70, "own3") and out[3]["paragraphs_removed"] == 2 and out[99]["paragraphs_removed"] == 0 and not out[99]["too_short"]


def test_families(spark):
    df = spark.createDataFrame([("A1", "x"), ("B1", "x"), ("B1", "y"), ("C1", "y"), ("D1", "z")], "g string, h string")
    assert {r["group_id"]: r["family"] for r in dedup.family_groups(df, "g", "h").collect()} == {"A1": "A1", "B1": "A1", "C1": "A1", "D1": "D1"}


def test_decontamination(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = [(1, "clean text", "f1"), (2, "X " + item.upper() + " y", "f2"), (3, " ".join(item.split()[:19]) + " other", "f3"), (4, "sibling", "f2"), (5, None, None), (6, " ".join(item.split()[:14]), "f6")]
    df = spark.createDataFrame(docs, "doc_id long, text string, fam string")
    bench = spark.createDataFrame([(7, item, "b"), (8, "one two", "b"), (7, item, "b"), (None, item, "b"), (9, None, "b")], "item_id long, text string, benchmark_name string")
    log = {r["doc_id"]: (r["item_id"], r["match_type"]) for r in decontam.contamination_log(df, bench).collect()}
    assert log == {2: (7, "exact"), 3: (7, "shingle_overlap")}
    kept = decontam.decontaminated(df, decontam.contamination_log(df, bench), "doc_id", "fam")
    assert {r["doc_id"] for r in kept.collect()} == {1, 5, 6}
    assert decontam.contamination_log(df, bench.limit(0)).count() == 0


def test_splits(spark):
    df = spark.createDataFrame([(f"g{i // 3}", i) for i in range(3000)], "g string, n long").withColumn("split", splits.hash_split(F.col("g"), {"validation": 0.1, "test": 0.1}))
    per = defaultdict(set)
    for r in df.collect():
        per[r["g"]].add(r["split"])
    assert all(len(s) == 1 for s in per.values())
    n = Counter(next(iter(s)) for s in per.values())
    assert 700 < n["train"] < 900 and n["trajectory_holdout"] == 0
    m = {r["split"]: r["groups"] for r in splits.split_metrics(df, spark.createDataFrame([("train",), ("trajectory_holdout",)], "split string"), "g", "g", "n").collect()}
    assert m == {"train": n["train"], "trajectory_holdout": 0}


def test_token_spans_lose_the_token_with_a_blank_before(spark):
    df = spark.createDataFrame([([(0, 3), (4, 9)], [(0, 3), (3, 6), (6, 9)])], "s array<struct<start:int,end:int>>, o array<struct<start:int,end:int>>")
    assert [tuple(x) for x in df.select(tokens.token_spans(F.col("s"), F.col("o"))).first()[0]] == [(0, 1), (2, 3)]


def test_freeze(spark, tmp_path):
    a = spark.createDataFrame([("x", [1, 2]), ("y", [3]), ("z", [1])], "document_id string, ids array<int>")
    b = spark.createDataFrame([("x", [9, 2]), ("y", [3]), ("w", [1])], "document_id string, ids array<int>")
    assert {tuple(r) for r in freeze.alignment(a, b).collect()} == {("z", "a_only"), ("w", "b_only")}
    assert [tuple(r) for r in freeze.first_mismatch(a, b, "document_id", "ids").collect()] == [("x", 0)]
    d = str(tmp_path / "t")
    a.coalesce(1).write.parquet(d)
    before = freeze.checksums(spark, d).collect()
    frozen = spark.createDataFrame(before)
    assert freeze.changed_shards(frozen, freeze.checksums(spark, d)).count() == 0
    os.remove(f"{d}/.{before[0]['file']}.crc")  # else the file system itself refuses the changed file
    with open(f"{d}/{before[0]['file']}", "ab") as f:
        f.write(b"x")
    assert [r["problem"] for r in freeze.changed_shards(frozen, freeze.checksums(spark, d)).collect()] == ["modified"]
    v = spark.createDataFrame([("v", "train", ["x", "y"])], "view_id string, split string, source_document_ids array<string>")
    docs = spark.createDataFrame([("x", " Train"), ("y", "test")], "document_id string, split string")
    assert [r["document_id"] for r in freeze.split_violations(v, docs).collect()] == ["y"]


def test_layers_agree_also_after_a_cut(spark):
    text = "One two three four.\n\nFünf sechs 😀 sieben. Acht.\n\n" + "tail words go on " * 60
    df = spark.createDataFrame([("a", text, 1), ("b", None, 2), ("c", "", 3)], "document_id string, normalized_text string, token_ids int")
    b = {r["document_id"]: r for r in layers.layer_b(df).collect()}
    assert b["b"]["token_ids"] == b["c"]["token_ids"] == [] and b["a"]["token_count"] == len(b["a"]["token_ids"]) and len(b["a"]["paragraph_token_spans"]) == 3
    same = freeze.reencoded_mismatch(df, layers.layer_b(df), lambda x, i, t: layers.layer_b(x, i, t).selectExpr(f"{i} AS doc_id", "token_ids AS ids"))
    assert same.count() == 0
    for needed in (1, 2, 12, 13, 14, 15, 16, 17, 100):
        r = layers.truncated(df.where("document_id = 'a'").withColumn("needed", F.lit(needed))).collect()
        for x in r:
            assert text.startswith(x["normalized_text"]) and x["token_count"] <= needed and "\ufffd" not in x["normalized_text"]
            again = layers.tokenizer(layers.TOKENIZER).encode(x["normalized_text"], add_special_tokens=False).ids
            assert again == x["token_ids"] and all(s["end"] <= x["token_count"] for s in x["paragraph_token_spans"])
        assert r or needed < 20
    assert layers.truncated(df.withColumn("needed", F.lit(0))).count() == 0


def test_groups_of_splits_fall_back(spark):
    df = spark.createDataFrame([("a", " ", "P "), ("b", None, "p"), ("c", "", None), ("d", "g", "p"), ("e", "G ", None)], "document_id string, g string, p string")
    assert {r[0]: r[1] for r in df.select("document_id", splits.split_group("g", "p", "document_id")).collect()} == {"a": "p", "b": "p", "c": "c", "d": "g", "e": "g"}
    assert df.select(splits.hash_split(F.lit(None).cast("string"), {}).alias("s")).where("s is null").count() == 5


def test_one_quota_per_name(spark):
    c = spark.createDataFrame([("A ", 0.5, None), ("a", 0.4, None), ("b", None, 300_000_000), (" ", 0.1, None), (None, 0.1, None)], "name string, share double, quota_3b_tokens long")
    assert {tuple(r) for r in identity.quotas(c, 1000).collect()} == {("a", 400, 540), ("b", 100, 135)}


def test_windows_hold_every_id(spark):
    df = spark.createDataFrame([("a", "x", list(range(1, 22))), ("b", "x", [1]), ("c", "x", [])], "document_id string, split string, s array<int>")
    out = views.windows(df, "s", 5).collect()
    a = sorted((r for r in out if r["document_id"] == "a"), key=lambda r: r["window"])
    assert [x for r in a for x, m in zip(r["target_token_ids"], r["loss_mask"], strict=True) if m] == list(range(2, 22)) and len(out) == 6


def test_artifacts(tmp_path):
    assert freeze.same_artifact(a="x", b="x") == "x" and freeze.special_ids({"<s>": 0, "</s>": 1}, "<s>", "</s>") == {"<s>": 0, "</s>": 1}
    for bad in (lambda: freeze.same_artifact(a="x", b="y"), lambda: freeze.same_artifact(a=None), lambda: freeze.special_ids({"a": 1, "b": 1}, "a", "b"), lambda: freeze.special_ids({}, "a")):
        with pytest.raises(ValueError):
            bad()
    (tmp_path / "f").write_text("one")
    first = freeze.cached_digests(str(tmp_path))
    assert freeze.cached_digests(str(tmp_path), {"f": (*first["f"][:2], "kept")})["f"][2] == "kept"
    (tmp_path / "f").write_text("three")
    assert freeze.cached_digests(str(tmp_path), first)["f"][2] != first["f"][2]


def tok(spark, rows):
    return spark.createDataFrame(rows, "document_id string, parent_document_id string, source string, split string, token_ids array<int>, paragraph_token_spans array<struct<start:int,end:int>>")


def test_views(spark):
    df = spark.createDataFrame([([7, 8, 9, 10, 11],)], "s array<int>")
    v = df.select(*(c.alias(k) for k, c in views.shifted(F.col("s"), 8).items())).first()
    assert v["loss_mask"] == [1] * 4 + [0] * 4 and v["attention_mask"] == [1] * 5 + [0] * 3 and v["input_token_ids"] == [7, 8, 9, 10, 11, 1, 1, 1] and v["target_token_ids"] == [8, 9, 10, 11, 1, 1, 1, 1]
    t = tok(spark, [("a", "a", "s", "train", [3] * 100, [(0, 50), (50, 100)]), ("b", "b", "s", "train", [4] * 20, []), ("c", "c", "s", "train", [5, 6, 7], []), ("d", "d", "s", "train", [8, 9, 9], []), ("e", "e", "s", "test", [8, 9, 9], []), ("f", "f", "s", "test", [], None)])
    p = views.packed(t, 32).collect()
    assert {d for r in p for d in r["source_document_ids"]} == {"b", "c", "d", "e"} and all(len(r["input_token_ids"]) == 32 for r in p)
    assert all(r["split"] == "test" for r in p if "e" in r["source_document_ids"]) and [r["source_document_ids"] for r in p if r["split"] == "train"] == [["b", "c", "d"]] and sorted(r["source_document_ids"] for r in views.packed(t, 27).collect() if r["split"] == "train") == [["b", "c"], ["d"]]
    c = views.crops(t, 32).collect()
    assert [r["document_id"] for r in c] == ["a"] and len(c[0]["input_token_ids"]) == 32
    long = tok(spark, [("L", "L", "s", "train", list(range(2000)), [(0, 500), (500, 900), (900, 2000)])])
    r = views.prefix_suffix(long).first()
    assert r["input_token_ids"] == list(range(r["prefix_len"])) and r["target_token_ids"] == list(range(r["prefix_len"], r["prefix_len"] + r["horizon"]))
    b = views.bridges(long, 4096).first()
    assert b["target_token_ids"] == list(range(500, 900)) and b["input_token_ids"] == [*range(500), 11, *range(900, 2000)]


def test_statistics(spark):
    t = tok(spark, [("a", "a", "s", "train", [1, 1, 2, 99, -1], []), ("b", "b", None, "train", [2], [])])
    c = stats.token_counts(t, 10)
    assert {(r["scope"], r["token_id"]): r["n"] for r in c.collect()} == {("s", 1): 2, ("s", 2): 1, ("", 2): 1, (None, 1): 2, (None, 2): 2}
    p = stats.log_probabilities(c, 10).collect()
    assert len(p) == 30 and abs(sum(__import__("math").exp(r["log_p"]) for r in p if r["scope"] is None) - 1) < 1e-5
    assert stats.consistency(c).count() == 0
