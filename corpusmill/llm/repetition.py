"""Repetition inside a single document (problem 9).

repeated_share gives the share of words in runs that came before in the same text. fertility gives the
tokeniser's view: characters per token, byte-fallback share and token entropy, with rejection bands per script.
Fertility is an average over a text and cannot tell which words lie in a repeated run of a given length, so the
share is found by comparing the runs themselves. Both are narrow maps over whole texts.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.words import parts, words

RUN = 8
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
_ASCII_LETTER, _NOT_ASCII = re.compile(r"[A-Za-z]"), re.compile(r"[^\x00-\x7f]")


def repeated_words(docs: list[list[str]], run: int = RUN) -> np.ndarray:
    """Of each document the number of words in a run of `run` words that also begins at an earlier word of it."""
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    n = int(sizes.sum())
    out = np.zeros(len(docs), dtype=np.int64)
    if n < run:
        return out
    number: dict[str, int] = {}
    ids = np.fromiter(map(number.setdefault, itertools.chain.from_iterable(docs), itertools.count()), dtype=np.int64, count=n)
    doc = np.repeat(np.arange(len(docs)), sizes)
    m = n - run + 1
    starts = np.flatnonzero(doc[:m] == doc[run - 1 :])  # runs within one document
    if not len(starts):
        return out
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        h = doc[:m].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        for k in range(run):
            h = h * np.uint64(0x100000001B3 + 2 * 0x9E3779B9) + x[k : k + m]
    h = h[starts]
    order = np.argsort(h, kind="stable")
    hs = h[order]
    new = np.r_[True, hs[1:] != hs[:-1]]
    first = starts[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = starts[order][~new]
    first = first[~new]
    same = np.ones(len(later), dtype=bool)
    for k in range(run):  # equal hashes are not taken for equal runs
        same &= ids[later + k] == ids[first + k]
    later = later[same & (doc[later] == doc[first])]
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, later, 1)
    np.add.at(cover, later + run, -1)
    marked = np.cumsum(cover)[:n] > 0
    return np.bincount(doc[marked], minlength=len(docs))


def repeated_share(df: DataFrame, id_col: str = "doc_id", text: str = "text", run: int = RUN) -> DataFrame:
    """(doc_id, n_words, repeated, share) of each row of df; the share of a text without words is 0."""
    d = df.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            for s, e in parts(texts, 2000, 4_000_000):
                part = b.slice(s, e - s)
                docs = [words(x) for x in texts[s:e]]
                n = np.array([len(x) for x in docs], dtype=np.int64)
                r = repeated_words(docs, run)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(r), pa.array(r / np.maximum(n, 1))], names=["doc_id", "n_words", "repeated", "share"])

    return d.mapInArrow(go, f"doc_id {id_type}, n_words long, repeated long, share double")


@lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return sp, np.array([sp.is_byte(i) for i in range(sp.vocab_size())])


@lru_cache(maxsize=100_000)
def _script_of(c: str) -> str | None:
    """The script of a character by its Unicode name; None if it is no letter."""
    if not c.isalpha():
        return None
    first = unicodedata.name(c, "OTHER").split()[0].lower()
    return {"cjk": "han", "fullwidth": "latin", "halfwidth": "kana", "hiragana": "kana", "katakana": "kana"}.get(first, first)


def script(text: str) -> str:
    """The script that most letters of a text belong to, the first by name among equals; none without letters."""
    counts = Counter({"latin": len(_ASCII_LETTER.findall(text))})
    for c, n in Counter(_NOT_ASCII.findall(text)).items():
        if s := _script_of(c):
            counts[s] += n
    best = min(counts, key=lambda s: (-counts[s], s))
    return best if counts[best] else "none"


def fertility(df: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = PIECES) -> DataFrame:
    """(doc_id, script, n_chars, n_tokens, chars_per_token, byte_share, entropy); entropy in bits per token.

    A text without tokens (null, empty) has 0 in all numbers.
    """
    d = df.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, is_byte = _pieces(path)
        for b in batches:
            texts = [x or "" for x in b.column("text").to_pylist()]
            rows = []
            for i, e in parts(texts, 128, 1_000_000):
                for x, ids in zip(texts[i:e], sp.encode(texts[i:e], num_threads=1), strict=True):
                    if not ids:
                        rows.append((script(x), len(x), 0, 0.0, 0.0, 0.0))
                        continue
                    a = np.array(ids)
                    c = np.bincount(a)
                    p = c[c > 0] / len(a)
                    rows.append((script(x), len(x), len(a), len(x) / len(a), float(is_byte[a].mean()), float(-(p * np.log2(p)).sum())))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, k) for x, k in zip(cols, kinds, strict=True))], names=["doc_id", "script", "n_chars", "n_tokens", "chars_per_token", "byte_share", "entropy"])

    return d.mapInArrow(go, f"doc_id {id_type}, script string, n_chars long, n_tokens long, chars_per_token double, byte_share double, entropy double")


def fertility_bands(measured: DataFrame, tail: float = 0.005) -> DataFrame:
    """(script, documents, low, high, byte_high, entropy_low): the bands of each script, by approximate quantiles of its documents with tokens."""
    q = lambda c, p: F.percentile_approx(c, p, 10_000)
    return measured.where("n_tokens > 0").groupBy("script").agg(F.count(F.lit(1)).alias("documents"), q("chars_per_token", tail).alias("low"), q("chars_per_token", 1 - tail).alias("high"), q("byte_share", 1 - tail).alias("byte_high"), q("entropy", tail).alias("entropy_low"))


def fertility_rejects(measured: DataFrame, tail: float = 0.005) -> DataFrame:
    """measured with `rejected`: outside a band of its script. Texts without tokens are not rejected.

    measured is read twice, so it should be a written table.
    """
    bands = F.broadcast(fertility_bands(measured, tail).drop("documents"))  # a row per script
    out = (F.col("chars_per_token") < F.col("low")) | (F.col("chars_per_token") > F.col("high")) | (F.col("byte_share") > F.col("byte_high")) | (F.col("entropy") < F.col("entropy_low"))
    return measured.join(bands, "script", "left").select(*measured.columns, (F.coalesce(out, F.lit(False)) & (F.col("n_tokens") > 0)).alias("rejected"))
