import base64
import os

import pytest

from corpusmill.llm.encoding import TOKENIZER, byte_table, decode, encode, round_trip, tokenizer

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer files")
TEXTS = ["Hello world", "", None, "  \n\t ", "naïve Straße 東京 🙂👩‍👩‍👧", "<|endoftext|> is text", "é​‮\x00\x07", "x" * 200_000, "a\r\nb c", "'s 't 're  123456"]


def frame(spark):
    return spark.createDataFrame([(i, t, "ids") for i, t in enumerate(TEXTS)] + [(None, "null id", "ids")], "doc_id long, text string, ids string")


def test_equals_another_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers as P

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r["ids"] for r in encode(frame(spark)).collect()}
    assert got[1] == got[2] == [] and len(got) == len(TEXTS) + 1
    for i, t in enumerate(TEXTS):
        assert got[i] == other.encode_ordinary(t or "")


def test_round_trip_and_offsets(spark):
    assert all(r["same"] for r in round_trip(frame(spark)).collect())
    for r in encode(frame(spark), offsets=True).collect():
        t = (TEXTS[r["doc_id"]] if r["doc_id"] is not None else "null id") or ""
        assert len(r["ids"]) == len(r["spans"]) and all(0 <= s["start"] <= s["end"] <= len(t) for s in r["spans"])
        if t:
            assert r["spans"][0]["start"] == 0 and r["spans"][-1]["end"] == len(t)


def test_byte_table_and_split_characters():
    t = byte_table()
    assert len(t) == 256 and sorted(t.values()) == list(range(256)) and t["Ġ"] == 32
    ids = tokenizer(TOKENIZER).encode("a🙂b", add_special_tokens=False).ids
    assert decode(ids) == "a🙂b"
    for k in range(len(ids) + 1):
        assert "�" not in decode(ids[:k], whole_characters=True) and "�" not in decode(ids[k:], whole_characters=True)
    assert decode([]) == ""


def test_empty_table(spark):
    assert encode(frame(spark).limit(0)).count() == 0 and encode(frame(spark)).columns == ["doc_id", "ids"]


def test_layers_are_compared_by_encoding_the_text(spark):
    from corpusmill.operators import freeze

    text = "It is a text of some words, and then a few more."
    ids = tokenizer(TOKENIZER).encode(text, add_special_tokens=False).ids
    a = spark.createDataFrame([(k, text) for k in ("same", "first", "middle", "short", "long", "none", "a only")] + [("empty", None), ("filled", None), ("twice", text), ("twice", "other")], "document_id string, normalized_text string")
    bad = [*ids[:3], ids[3] + 1, *ids[4:]]
    rows = [("same", ids), ("first", [ids[0] + 1, *ids[1:]]), ("middle", bad), ("short", ids[:-1]), ("long", [*ids, 5]), ("none", None), ("b only", ids), ("empty", None), ("filled", [7]), ("twice", ids)]
    b = spark.createDataFrame(rows + rows[:1], "document_id string, token_ids array<int>")
    got = {tuple(r) for r in freeze.reencoded_mismatch(a, b, encode).collect()}
    assert got == {("first", 0), ("middle", 3), ("short", len(ids) - 1), ("long", len(ids)), ("none", 0), ("filled", 0), ("twice", 0)}
