"""Structure of a text: spans of paragraphs, sentences, turns and equations, and segments of bounded length.

Spans are found in Arrow batches: a text of n spans costs n steps, while arrays that grow within a column expression
would be copied n times.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import once, word_count

#: In Python's patterns \s is the white space of functions.text.SPACE.
SENTENCE_GAP = r"(?<=[.!?])\s+(?=[A-Z0-9<])"
PARAGRAPH_GAP = r"\n\n+"
WORD = r"\S+"
#: Tags that hold a turn.
TURNS = ("QUESTION_BODY", "ANSWER", "COMMENT", "UTTERANCE", "ISSUE_BODY", "PULL_REQUEST_BODY", "REVIEW_COMMENT")
TURN = rf"(?s)<({'|'.join(TURNS)})>.*?</\1>"
EQUATION = r"(?s)<EQUATION>.*?</EQUATION>"
MAX_WORDS, TARGET_WORDS, LEAST_WORDS = 32768, 24000, 256
_SPAN = "array<struct<start:int,end:int>>"

Finder = Callable[[str], Iterator[tuple[int, int]]]


def pieces(gap: str) -> Finder:
    """The spans between the matches of gap, empty ones left out."""
    p = re.compile(gap)

    def find(text: str) -> Iterator[tuple[int, int]]:
        at = 0
        for m in p.finditer(text):
            if m.start() > at:
                yield at, m.start()
            at = m.end()
        if len(text) > at:
            yield at, len(text)

    return find


def hits(pattern: str) -> Finder:
    """The spans of the matches of pattern."""
    p = re.compile(pattern)
    return lambda text: (m.span() for m in p.finditer(text))


#: The kinds of spans that texts are searched for.
FINDERS = {"paragraph": pieces(PARAGRAPH_GAP), "sentence": pieces(SENTENCE_GAP), "turn": hits(TURN), "equation": hits(EQUATION)}


def span_array(rows: list[list[tuple[int, int]]]) -> pa.Array:
    """Lists of spans as an Arrow array."""
    at = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.array([x for r in rows for x in r], dtype=np.int32).reshape(-1, 2)
    return pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(flat[:, 0].copy()), pa.array(flat[:, 1].copy())], ["start", "end"]))


def spans(text: Column, find: Finder) -> Column:
    """Half-open spans in code points, in order; none for a null text."""

    @F.arrow_udf(_SPAN)
    def run(texts: pa.Array) -> pa.Array:
        return span_array([list(find(t)) if t else [] for t in texts.to_pylist()])

    return run(text)


def paragraph_spans(text: Column) -> Column:
    return spans(text, FINDERS["paragraph"])


def sentence_spans(text: Column) -> Column:
    return spans(text, FINDERS["sentence"])


def turn_spans(text: Column) -> Column:
    return spans(text, FINDERS["turn"])


def equation_spans(text: Column) -> Column:
    return spans(text, FINDERS["equation"])


def word_spans(text: Column) -> Column:
    return spans(text, hits(WORD))


def structure(text: Column) -> Column:
    """All spans as one struct; those kinds that nothing fills are empty."""
    none = F.array().cast(_SPAN)
    return F.struct(none.alias("section_spans"), none.alias("subsection_spans"), paragraph_spans(text).alias("paragraph_spans"), sentence_spans(text).alias("sentence_spans"), turn_spans(text).alias("turn_spans"), equation_spans(text).alias("equation_spans"), none.alias("code_spans"), none.alias("list_spans"))


def pack_paragraphs(text: str, target: int = TARGET_WORDS, least: int = LEAST_WORDS) -> list[str]:
    """Paragraphs put together in order: a segment ends before the paragraph that would take it over target, once it has least words."""
    done, cur, n = [], [], 0
    for p in filter(None, map(str.strip, text.split("\n\n"))):
        k = len(p.split())
        if n + k > target and n >= least:
            done.append("\n\n".join(cur))
            cur, n = [], 0
        cur.append(p)
        n += k
    return [*done, "\n\n".join(cur)] if cur else done


def packed_paragraphs(text: Column, target: int = TARGET_WORDS, least: int = LEAST_WORDS) -> Column:
    """pack_paragraphs of each text; none for null."""

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([pack_paragraphs(t, target, least) if t else [] for t in texts.to_pylist()], pa.list_(pa.string()))

    return run(text)


def segments(df: DataFrame, id_col: str = "doc_id", text: str = "text", most: int = MAX_WORDS, target: int = TARGET_WORDS, least: int = LEAST_WORDS) -> DataFrame:
    """df with a row per segment: segment_id, segment_text, segment_index, segment_count, previous_segment_id, next_segment_id.

    A text of at most `most` words is one segment, unchanged. Null and blank texts give none.
    """
    d = df.withColumn("_n", once(word_count(text))).where("_n > 0")
    d = d.withColumn("_cut", packed_paragraphs(F.when(F.col("_n") > most, F.col(text)), target, least))  # only long texts leave the JVM
    d = d.withColumn("_segs", once(F.when(F.col("_n") <= most, F.array(F.col(text))).otherwise(F.col("_cut"))))  # else a filter inferred from the explode runs it twice
    d = d.withColumn("segment_count", F.size("_segs")).select(*df.columns, "segment_count", F.posexplode("_segs").alias("segment_index", "segment_text"))
    name = lambda i: F.concat(F.col(id_col).cast("string"), F.lit("_seg"), i.cast("string"))
    i = F.col("segment_index")
    return d.withColumns({"segment_id": name(i), "previous_segment_id": F.when(i > 0, name(i - 1)), "next_segment_id": F.when(i < F.col("segment_count") - 1, name(i + 1))})
