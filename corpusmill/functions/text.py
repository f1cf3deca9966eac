"""Column expressions over text. White space, words and lines are those of Unicode, not only of ASCII."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, as character class content that Java and RE2 read alike.
SPACE = r"\t-\r\x1c-\x1f \x85\p{Z}"
WORD = rf"[^{SPACE}]+"
#: White space within a line.
BLANK = r"\t\x0b-\r\x1c-\x1f \x85\p{Z}"
#: Where a word begins or ends, where a line begins or ends.
WORD_START, WORD_END, LINE_START, LINE_END = rf"(?<![^{SPACE}])", rf"(?![^{SPACE}])", r"(?<![^\n])", r"(?![^\n])"
#: A line from its first to its last character that is no white space.
LINE = rf"[^{SPACE}](?:[^\n]*[^{SPACE}])?"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, f) -> Column:
    """f of a value that is computed once, also where f uses it inside another function's lambda."""
    return F.element_at(F.transform(F.array(value), f), 1)


def once(c: Column) -> Column:
    """c, computed where it stands: a later filter on it is not pushed down as a second evaluation of costly patterns."""
    return F.when(F.spark_partition_id() >= 0, c)


def word_count(text: Column | str) -> Column:
    """White-space separated words, the token approximation; 0 for null."""
    return F.coalesce(F.regexp_count(_c(text), F.lit(WORD)), F.lit(0))


def words(text: Column | str) -> Column:
    """White-space separated words as an array; null for null."""
    return F.regexp_extract_all(_c(text), F.lit(WORD), F.lit(0))


def strip(text: Column | str) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(_c(text), rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def lines(text: Column | str) -> Column:
    """The stripped lines that are not empty, in order."""
    return F.regexp_extract_all(_c(text), F.lit(LINE), F.lit(0))


def line_count(text: Column | str) -> Column:
    """The number of lines that are not empty; null for null."""
    return F.regexp_count(_c(text), F.lit(rf"[^{SPACE}][^\n]*+"))


def lines_of_at_most(text: Column | str, words: int) -> Column:
    """The number of lines of one to so many words; null for null."""
    more = rf"(?:[{BLANK}]++[^{SPACE}]++){{0,{words - 1}}}+" if words > 1 else ""
    return F.regexp_count(_c(text), F.lit(rf"{LINE_START}[{BLANK}]*+[^{SPACE}]++{more}[{BLANK}]*+{LINE_END}"))


def is_ascii(text: Column | str) -> Column:
    return F.octet_length(_c(text)) == F.length(_c(text))


def paragraphs(text: Column | str) -> Column:
    """The stripped pieces between blank lines that are not empty, in order."""
    return F.filter(F.transform(F.split(_c(text), "\n\n"), strip), lambda x: x != "")


def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFC", x))


def nfc(text: Column | str) -> Column:
    """Unicode form NFC; an Arrow UDF as Spark has no built-in normalisation. Plain ASCII does not leave the JVM."""
    c = _c(text)
    return F.when(is_ascii(c), c).otherwise(F.pandas_udf(_nfc, "string")(F.when(~is_ascii(c), c)))


def first_of(*cs: Column) -> Column:
    """The first value that is neither null nor the empty string."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cs))


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double; 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def run_hashes(words: Column, n: int) -> Column:
    """The hash of each n neighbouring elements of an array of strings, in order; none for a shorter array."""
    run = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(n))))
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) >= n, run(h)).otherwise(F.array().cast("array<bigint>")))
