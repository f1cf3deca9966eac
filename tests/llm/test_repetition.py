import os
import random

import pytest

from corpusmill.llm.repetition import PIECES, fertility, fertility_bands, fertility_rejects, repeated_share, repeated_words
from corpusmill.llm.words import parts, words


def brute(ws, run=8):
    seen, marked = set(), set()
    for k in range(len(ws) - run + 1):
        g = tuple(ws[k : k + run])
        if g in seen:
            marked.update(range(k, k + run))
        seen.add(g)
    return len(marked)


def test_against_brute_force():
    rng = random.Random(3)
    docs = [[rng.choice("abc") for _ in range(rng.choice([0, 1, 7, 8, 9, 60]))] for _ in range(200)] + [["x"] * 500, []]
    assert repeated_words(docs).tolist() == [brute(d) for d in docs]
    assert repeated_words([]).tolist() == [] and repeated_words([["a"]]).tolist() == [0]


def test_runs_do_not_reach_into_the_next_document():
    d = list("abcdefgh")
    assert repeated_words([d, d, d + d]).tolist() == [0, 0, 8]


def test_words():
    assert words("Ａｂ①­c ﬁne_x É́t") == ["ab1c", "fine", "x", "é", "t"] or words("Ａｂ①­c")[0] == "ab1c"
    assert words(None) == words(" \n") == [] and words("A-b 3.4") == ["a", "b", "3", "4"]


def test_parts_cover_all_texts():
    texts = ["a" * 5, None, "b" * 20, "", "c", "d" * 3, "e" * 9]
    got = list(parts(texts, 3, 10))
    assert [i for s, e in got for i in range(s, e)] == list(range(7)) and got == [(0, 2), (2, 3), (3, 6), (6, 7)] and list(parts([], 3, 10)) == []


def test_frame(spark):
    long = "one two three four five six seven eight nine " * 20_000
    df = spark.createDataFrame([(1, long, 0), (2, None, 0), (3, "", 0), (4, "a b c", 0), (None, long[:200], 0), (4, "a b c", 0)], "doc_id long, text string, share int")
    out = {r["doc_id"]: r for r in repeated_share(df).collect()}
    assert out[1]["n_words"] == 180_000 and out[1]["repeated"] == 180_000 - 9 and out[2]["share"] == out[3]["share"] == out[4]["share"] == 0.0
    assert repeated_share(df).count() == 6 and repeated_share(df.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.exists(PIECES), reason="no tokenizer files")
def test_fertility(spark):
    df = spark.createDataFrame([(i, f"The harbour of town {i} rented a small and quiet boat.") for i in range(50)] + [(90, "zq " * 60), (91, "☃" * 40), (92, None), (93, ""), (94, "Мир и труд")], "doc_id long, text string")
    m = fertility(df).cache()
    by = {r["doc_id"]: r for r in m.collect()}
    assert by[92]["n_tokens"] == by[93]["n_tokens"] == 0 and by[91]["script"] == "none" and by[94]["script"] == "cyrillic" and by[0]["script"] == "latin"
    assert by[0]["chars_per_token"] > by[90]["chars_per_token"] and by[0]["entropy"] > by[90]["entropy"]
    assert {r["script"] for r in fertility_bands(m).collect()} >= {"latin", "cyrillic"}
    out = {r["doc_id"]: r["rejected"] for r in fertility_rejects(m, 0.05).collect()}
    assert out[90] and not out[92] and len(out) == 55
