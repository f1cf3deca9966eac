import random
from collections import defaultdict

import numpy as np

from corpusmill.llm.leaks import align, leaks
from corpusmill.llm.words import words


def brute(docs, items):
    ws = {i: words(t) for i, t in items}
    runs = defaultdict(set)
    for n in {min(13, len(w)) for w in ws.values() if w}:
        for i, w in ws.items():
            for k in range(len(w) - n + 1):
                runs[tuple(w[k : k + n])].add(i)
    own = {}
    for i, w in ws.items():
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            if len(runs[tuple(w[k : k + n])]) == 1:
                own[tuple(w[k : k + n])] = i
    out = set()
    for d, t in docs:
        w = words(t)
        for n in {len(r) for r in own}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in own:
                    out.add((d, own[tuple(w[k : k + n])]))
    return out


def make(seed=5):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    common = say(20)
    items = [(i, common + " " + say(rng.choice([3, 14, 30]))) for i in range(12)] + [(20, say(5)), (21, say(1)), (22, ""), (23, None), (24, "..."), (25, say(13))]
    items += [(30, items[0][1]), (31, " ".join(items[3][1].split()[5:25]))]
    docs = []
    for i in range(150):
        t = say(rng.randint(0, 120))
        if i % 3 == 0:
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(w) - 8))
            t += " " + " ".join(w[a : a + rng.randint(5, 40)]).upper() + " " + say(10)
        docs.append((i, t))
    return docs + [(900, common), (901, None), (902, ""), (903, items[1][1].replace(" ", " ​ ")), (904, "ｗ１ " + items[2][1])], items


def frames(spark, docs, items):
    d = spark.createDataFrame([(*x, 1, "z") for x in docs], "doc_id long, text string, item_id int, words string")
    return d, spark.createDataFrame([(*x, "b") for x in items], "item_id long, text string, benchmark_name string")


def test_exact_leaks_against_brute_force(spark):
    for seed in (5, 6):
        docs, items = make(seed)
        d, b = frames(spark, docs, items)
        want = brute(docs, items)
        assert {tuple(r) for r in leaks(d, b).where("exact").select("doc_id", "item_id").collect()} == want and want
        assert {tuple(r) for r in leaks(d, b, block_words=60).where("exact").select("doc_id", "item_id").distinct().collect()} == want


def test_edited_copies_score(spark):
    rng = random.Random(1)
    item = [f"q{i}" for i in range(40)]
    edited = [w for i, w in enumerate(item) if i % 9 != 4] + ["tail"]
    docs = [(1, "start " + " ".join(item)), (2, "start " + " ".join(edited)), (3, " ".join(rng.choice(item) for _ in range(40)))]
    d, b = frames(spark, docs, [(7, " ".join(item))])
    got = {r["doc_id"]: r for r in leaks(d, b).collect()}
    assert got[1]["score"] == 1.0 and got[1]["longest_run"] == 40 and got[1]["exact"]
    assert 0.75 < got[2]["score"] < 1 and got[2]["longest_run"] == 8 and not got[2]["exact"]
    assert 3 not in got or not got[3]["exact"]


def test_many_copies_of_one_edited_text(spark):
    item = [f"q{i}" for i in range(40)]
    edited = " ".join("edit" if i % 9 == 4 else w for i, w in enumerate(item))
    far = " ".join(w + " x" * (i % 4 == 3) for i, w in enumerate(item))  # ten words in between
    docs = [(i, f"start {i} {edited}") for i in range(60)] + [(100 + i, far) for i in range(60)] + [(200 + i, f"only {' '.join(item[5:9])} here") for i in range(60)]
    d, b = frames(spark, docs, [(7, " ".join(item))])
    got = {r["doc_id"]: r["score"] for r in leaks(d, b).collect()}
    want = {i: (2 * 36 - 4) / 80 for i in range(60)} | {100 + i: (80 - 9) / 80 for i in range(60)}
    assert got == want


def test_scores_against_alignment_of_all_pairs(spark):
    docs, items = make(8)
    d, b = frames(spark, docs, items)
    seqs = {i: words(t) for i, t in items if words(t)}
    number = defaultdict(lambda: len(number) + 1)
    want = {}
    for i, t in docs:
        w = words(t)
        for k, s in seqs.items():
            score = align(np.array([number[x] for x in s]), np.array([number[x] for x in w]))[0] / (2 * len(s))
            if score >= 0.6:
                want[i, k] = score
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in leaks(d, b).where("score >= 0.6").collect()}
    assert got == want and len(want) > 50


def test_recall_of_regular_edits(spark):
    """Copies with a word replaced, put in or left out at every third to ninth place, and at random: all that score 0.6 are found."""
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(400)] + ["the", "of", "and", "a", "in"] * 30
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, say(rng.choice([1, 3, 5, 6, 9, 40, 60]))) for i in range(40)]
    docs = []
    for i, w in items:
        for step in (2, 3, 4, 5, 6, 9):
            for how in ("replace", "insert", "delete", "random"):
                v = []
                for j, x in enumerate(w):
                    hit = j % step == step - 1 if how != "random" else rng.random() < 1 / step
                    v += [x, rng.choice(vocab)] if hit and how == "insert" else [] if hit and how == "delete" else [rng.choice(vocab)] if hit else [x]
                docs.append((len(docs), " ".join(say(rng.randint(0, 80)) + v + say(rng.randint(0, 80)))))
    d, b = frames(spark, docs, [(i, " ".join(w)) for i, w in items])
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in leaks(d, b).where("score >= 0.6").collect()}
    want = {}
    number = defaultdict(lambda: len(number) + 1)
    seqs = [(i, np.array([number[x] for x in w])) for i, w in items]
    for i, t in docs:
        w = np.array([number[x] for x in t.split()])
        for k, s in seqs:
            score = align(s, w)[0] / (2 * len(s))
            if score >= 0.6:
                want[i, k] = score
    assert got == want and len(want) > 300


def test_alignment_against_plain_dynamic_programming():
    rng = random.Random(2)
    for _ in range(30):
        a, b = [rng.randint(1, 4) for _ in range(rng.randint(1, 9))], [rng.randint(1, 4) for _ in range(rng.randint(1, 12))]
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        assert align(np.array(a), np.array(b))[0] == max(map(max, h))


def test_empty_tables(spark):
    docs, items = make()
    d, b = frames(spark, docs, items)
    assert leaks(d.limit(0), b).count() == 0 and leaks(d, b.limit(0)).count() == 0
    assert leaks(d, b.where("item_id in (22, 23, 24)")).count() == 0
