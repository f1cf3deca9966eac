"""Text normalisation, redaction and the rejections that go with them, as a chain of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import SPACE, is_ascii, nfc, once, word_count

# What counts as each kind, what is removed, and the limits.
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
#: The same matches, tried once per run of characters instead of from each of them.
EMAIL_ONCE = r"(?:(?<![a-zA-Z0-9._%+-])|\G)[a-zA-Z0-9._%+-]++@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = rf"\+?\p{{Nd}}{{1,4}}[-.{SPACE}]?(?:\(\p{{Nd}}{{1,3}}\)|\p{{Nd}}{{1,3}})[-.{SPACE}]?\p{{Nd}}{{1,4}}[-.{SPACE}]?\p{{Nd}}{{1,9}}"
IPV4 = r"\b(?:\p{Nd}{1,3}\.){3}\p{Nd}{1,3}\b"
IPV6 = r"\b(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}\b"
API_KEY = r"\b(?:sk-[a-zA-Z0-9]{32,}|AKIA[0-9A-Z]{16}|ghp_[a-zA-Z0-9]{36})\b"
PRIVATE_KEY = rf"-----BEGIN[{SPACE}]+(?:RSA|DSA|EC|OPENSSH|PGP)?[{SPACE}]*PRIVATE[{SPACE}]+KEY-----"
CONTROLS = r"[\x00\x{200b}\x{200e}\x{200f}\x{202a}-\x{202e}\x{e000}-\x{f8ff}]"
MAX_FFFD = 0.001
#: Blanks other than the plain one, the tab and the line feed.
_ODD = r"\x0b-\r\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
MAX_PII_PER_1000, PII_MIN_WORDS = 20, 50
#: Kinds in the order of redaction.
KINDS = (("api_key", (API_KEY,), "<API_KEY>"), ("email", (EMAIL_ONCE,), "<EMAIL>"), ("ip", (IPV4, IPV6), "<IP>"), ("phone", (PHONE,), "<PHONE>"))

#: What each match of a pattern has one of.
PARTS = {API_KEY: ("sk-", "AKIA", "ghp_"), EMAIL_ONCE: ("@",), IPV6: (":",), IPV4: (".",)}


def unix_lines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def without_controls(c: Column) -> Column:
    """Without control, bidirectional and private-use characters; runs of soft hyphens become one."""
    plain = is_ascii(c) & ~F.contains(c, F.lit("\x00"))  # plain ASCII has none of them
    return F.when(plain, c).otherwise(F.regexp_replace(F.regexp_replace(c, CONTROLS, ""), r"\x{ad}{2,}", "­"))


def single_blanks(c: Column) -> Column:
    """Runs of blanks within a line (tabs aside) as one, lines stripped, at most two blank lines in a row."""
    # a single plain blank, by far the most frequent, is no match
    c = F.regexp_replace(c, rf" [ {_ODD}]+|[{_ODD}][ {_ODD}]*", " ")
    c = F.regexp_replace(F.regexp_replace(c, "[ \t]+\n[ \t]*|\n[ \t]+", "\n"), r"\A[ \t]+|[ \t]+\z", "")
    return F.regexp_replace(c, "\n{4,}", "\n\n\n")


def fffd_ratio(text: Column) -> Column:
    """The share of replacement characters; 0 for an empty text."""
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(r"\x{fffd}")) / F.length(text)).otherwise(0.0)


def clean_text(df: DataFrame, text: str = "text", out: str = "normalized_text", code: bool = False) -> DataFrame:
    """df with `out`, the text in form NFC with plain line ends, controls and blanks; null stays null."""
    c = without_controls(unix_lines(nfc(F.col(text))))
    df = df.withColumn(out, c)
    return df if code else df.withColumn(out, single_blanks(F.col(out)))


def redact(df: DataFrame, text: str = "normalized_text", out: str | None = None) -> DataFrame:
    """df with the values of each kind replaced by its placeholder, and n_<kind>, their numbers (0 for null)."""
    out = out or text
    df = df.withColumn(out, F.col(text))
    for kind, patterns, mark in KINDS:
        df = df.withColumn("_before", F.col(out))
        for p in patterns:
            # a pattern is tried only where a text has a part that each match has
            some = [F.contains(out, F.lit(x)) for x in PARTS.get(p, ())]
            maybe = some[0] if some else F.lit(True)
            for x in some[1:]:
                maybe = maybe | x
            df = df.withColumn(out, F.when(maybe, F.regexp_replace(out, p, mark)).otherwise(F.col(out)))
        # a match holds no whole mark, so there are as many new marks as values
        df = df.withColumn(f"n_{kind}", F.coalesce(_marks(out, mark) - _marks("_before", mark), F.lit(0))).drop("_before")
    return df


def _marks(c: str, mark: str) -> Column:
    return ((F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))) / len(mark)).cast("int")


def rejection(raw: Column, normalized: Column, redacted: Column, n_email: Column, n_phone: Column) -> Column:
    """The first rule that rejects a text, or null: empty_text, fffd_ratio, private_key, excessive_email, excessive_phone."""
    n = F.greatest(word_count(redacted), F.lit(1))
    long = n >= PII_MIN_WORDS
    return (
        F.when(F.coalesce(raw, F.lit("")) == "", "empty_text")
        .when(fffd_ratio(raw) > MAX_FFFD, "fffd_ratio")
        .when(normalized.rlike(PRIVATE_KEY), "private_key")
        .when(long & (n_email * 1000 > n * MAX_PII_PER_1000), "excessive_email")
        .when(long & (n_phone * 1000 > n * MAX_PII_PER_1000), "excessive_phone")
    )


def normalize(df: DataFrame, text: str = "text", code: bool = False) -> DataFrame:
    """df with normalized_text (redacted), n_api_key, n_email, n_ip, n_phone and rejection.

    Rejected rows keep their text; a caller filters on `rejection is null`. Null and empty texts are rejected.
    """
    out = clean_text(df, text, "_clean", code)
    out = redact(out, "_clean", "normalized_text")
    why = rejection(F.col(text), F.col("_clean"), F.col("normalized_text"), F.col("n_email"), F.col("n_phone"))
    return out.withColumn("rejection", once(why)).drop("_clean")
