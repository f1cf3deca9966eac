"""Layer B from Layer A: encoding with a tokenizer file, spans as token spans, and the cut of a document at a quota.

The tokenizer is a parameter, loaded once by each Python worker. Encoding is a narrow map over Arrow batches; texts
are encoded whole.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.segment import FINDERS, span_array
from corpusmill.operators.tokens import to_token_spans

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Texts and characters that are encoded at once, which bounds the memory of their encodings.
AT_ONCE, CHARS_AT_ONCE = 128, 1_000_000
#: Tokens that a cut document keeps at least, unless less was missing.
LEAST_TOKENS = 64
SPANS = {f"{k}_token_spans": "array<struct<start:int,end:int>>" for k in FINDERS}


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file. Strings of special tokens in a text are ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def parts(texts: list[str | None], most_rows: int = AT_ONCE, most_chars: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive texts, in parts of at most so many rows and characters; a longer text is a part of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and (i - start == most_rows or size + n > most_chars):
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def encodings(texts: list[str | None], path: str) -> Iterator:
    """The encoding of each text, without special tokens; a null text is encoded like an empty one."""
    t = tokenizer(path)
    for i, e in parts(texts):
        yield from t.encode_batch([x or "" for x in texts[i:e]], add_special_tokens=False)


def id_array(rows: list[list[int]]) -> pa.Array:
    at = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate([np.array(r, dtype=np.int32) for r in rows]) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat))


def _mapped(text: str | None, e) -> list[list[tuple[int, int]]]:
    """The token spans of each kind of an encoded text."""
    o = np.array(e.offsets, dtype=np.int64).reshape(-1, 2)
    return [to_token_spans(np.array(list(f(text)), dtype=np.int64).reshape(-1, 2), o[:, 0], o[:, 1]) if text else [] for f in FINDERS.values()]


def layer_b(df: DataFrame, id_col: str = "document_id", text: str = "normalized_text", path: str = TOKENIZER) -> DataFrame:
    """(id, token_ids, token_count) and the token spans of each kind, a row per row of df; null and empty texts have no tokens."""
    d = df.select(F.col(id_col), F.col(text).cast("string").alias("_text"))
    id_type = d.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("_text").to_pylist()
            ids, found = [], [[] for _ in FINDERS]
            for t, e in zip(texts, encodings(texts, path), strict=True):
                ids.append(e.ids)
                for k, x in zip(found, _mapped(t, e), strict=True):
                    k.append(x)
            yield pa.RecordBatch.from_arrays([b.column(id_col), id_array(ids), pa.array(list(map(len, ids)), pa.int32()), *map(span_array, found)], names=[id_col, "token_ids", "token_count", *SPANS])

    return d.mapInArrow(run, f"`{id_col}` {id_type}, token_ids array<int>, token_count int, " + ", ".join(f"{k} {t}" for k, t in SPANS.items()))


def cut_text(text: str, needed: int, path: str = TOKENIZER, least: int = LEAST_TOKENS) -> tuple[str, object] | None:
    """A beginning of text that has at most `needed` tokens when encoded anew, and its encoding.

    The longest of these ends is taken that fits: after `needed` tokens, then the ends of paragraphs and sentences from
    the last. Characters stay whole. What would have under `least` tokens is no fit unless less was needed; None if nothing fits.
    """
    if needed <= 0:
        return None
    e = tokenizer(path).encode(text, add_special_tokens=False)
    if len(e.ids) <= needed:
        return text, e
    found = dict(zip(FINDERS, _mapped(text, e), strict=True))
    ends = {needed} | {b for k in ("paragraph", "sentence") for _, b in found[k] if b <= needed}
    for at in sorted(ends, reverse=True):
        part = text[: e.offsets[at][0]]  # where the next token begins: of a character that is torn there nothing stays
        f = tokenizer(path).encode(part, add_special_tokens=False)
        if min(least, needed) <= len(f.ids) <= needed:
            return part, f
    return None


def truncated(df: DataFrame, id_col: str = "document_id", text: str = "normalized_text", needed: str = "needed", path: str = TOKENIZER, least: int = LEAST_TOKENS) -> DataFrame:
    """Both layers of documents cut to at most `needed` tokens: id, text, normalized_text_hash, token_ids, token_count and the
    token spans, all of the text as it is now, so that encoding it again gives the ids. Documents that no cut fits are left out."""
    d = df.select(F.col(id_col), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"), F.col(needed).cast("long").alias("_needed"))
    id_type = d.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, t, n in zip(range(b.num_rows), b.column("_text").to_pylist(), b.column("_needed").to_pylist(), strict=True):
                if got := cut_text(t, n or 0, path, least):
                    rows.append((i, got[0], got[1].ids, _mapped(*got)))
            texts = [r[1] for r in rows]
            hashes = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
            cols = [b.column(id_col).take(pa.array([r[0] for r in rows], pa.int32())), pa.array(texts, pa.string()), pa.array(hashes, pa.string()), id_array([r[2] for r in rows]), pa.array([len(r[2]) for r in rows], pa.int32())]
            cols += [span_array([r[3][k] for r in rows]) for k in range(len(FINDERS))]
            yield pa.RecordBatch.from_arrays(cols, names=[id_col, text, "normalized_text_hash", "token_ids", "token_count", *SPANS])

    return d.mapInArrow(run, f"`{id_col}` {id_type}, `{text}` string, normalized_text_hash string, token_ids array<int>, token_count int, " + ", ".join(f"{k} {t}" for k, t in SPANS.items()))
