"""Encoding of the whole corpus with a public tokenizer (problem 7), over Arrow batches.

The tokenizer file is a parameter; each Python worker loads it once. Encoding is a narrow map: no shuffle, and
only the id and text columns reach Python. Ids leave as one flat buffer with offsets.

Decoding reverses the byte-to-character table of byte-level BPE by its rule: the printable bytes stand for
themselves and the others, in order, for the code points from 256 on. A slice of ids may begin or end within a
character; its torn bytes come out as U+FFFD, or are held back on request.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.layers import TOKENIZER, encodings, tokenizer


def byte_table() -> dict[str, int]:
    """The byte of each character of byte-level BPE."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id; a special token has those of its text."""
    back, vocab = byte_table(), tokenizer(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return out


def decode(ids: Iterable[int], path: str = TOKENIZER, whole_characters: bool = False) -> str:
    """The text of ids. Bytes of characters that the ids hold only in part become U+FFFD, or are left out at
    both ends if whole_characters."""
    table = token_bytes(path)
    raw = b"".join(table[i] for i in ids)
    if whole_characters:
        start = next((i for i, b in enumerate(raw[:4]) if b & 0xC0 != 0x80), min(4, len(raw)))
        raw = raw[start:]
        for k in range(1, min(4, len(raw)) + 1):
            if raw[-k] & 0xC0 == 0xC0:
                need = 2 if raw[-k] < 0xE0 else 3 if raw[-k] < 0xF0 else 4
                raw = raw if k >= need else raw[:-k]
                break
            if raw[-k] < 0x80:
                break
    return raw.decode("utf-8", "replace")


def encode(df: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = TOKENIZER, offsets: bool = False) -> DataFrame:
    """(doc_id, ids), and `spans`, an array of struct<start, end> in code points per token, if offsets.

    One row per row of df, in particular for null and empty texts, which have an empty list. Special tokens are
    neither added nor recognised. Texts are encoded whole.
    """
    d = df.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()
    i32 = pa.int32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, ends, pos = [], [0], []
            for e in encodings(b.column("text").to_pylist(), path):
                ids = e.ids
                flat.append(np.array(ids, dtype=np.int32))
                ends.append(ends[-1] + len(ids))
                if offsets:
                    pos.append(np.array(e.offsets, dtype=np.int32).reshape(-1, 2))
            values = np.concatenate(flat) if flat else np.empty(0, np.int32)
            at = pa.array(ends, i32)
            cols, names = [b.column("doc_id"), pa.ListArray.from_arrays(at, pa.array(values, i32))], ["doc_id", "ids"]
            if offsets:
                p = np.concatenate(pos) if pos else np.empty((0, 2), np.int32)
                cols.append(pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(p[:, 0].copy(), i32), pa.array(p[:, 1].copy(), i32)], ["start", "end"])))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"doc_id {id_type}, ids array<int>" + ", spans array<struct<start:int,end:int>>" * offsets
    return d.mapInArrow(run, schema)


def round_trip(df: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens, n_bytes, same): whether the decoded ids give the text back (null counts as empty)."""
    d = df.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            n, size, same = [], [], []
            for x, e in zip(texts, encodings(texts, path), strict=True):
                x = x or ""
                n.append(len(e.ids))
                size.append(len(x.encode()))
                same.append(decode(e.ids, path) == x)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int32()), pa.array(size, pa.int32()), pa.array(same, pa.bool_())], names=["doc_id", "n_tokens", "n_bytes", "same"])

    return d.mapInArrow(run, f"doc_id {id_type}, n_tokens int, n_bytes int, same boolean")
