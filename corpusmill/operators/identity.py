"""Keys, hashes and quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.session import blank_to_null

#: Factor by which more is gathered than a quota asks for.
OVERSAMPLE = 1.35


def hash63(key: Column) -> Column:
    """The first 8 bytes of the SHA-256 of key as a number, without its top bit."""
    hex_ = F.sha2(key, 256)
    top = F.conv(F.substring(hex_, 1, 8), 16, 10).cast("long").bitwiseAND(F.lit(0x7FFFFFFF))
    low = F.conv(F.substring(hex_, 9, 8), 16, 10).cast("long")
    return top * F.lit(1 << 32) + low


def priority(source: Column, record_id: Column, version: str = "v0", seed: int = 42) -> Column:
    """A pseudo-random order of records that depends on nothing but their identity."""
    return hash63(F.concat_ws(":", F.lit(version), source, record_id.cast("string"), F.lit(str(seed))))


def document_identity(df: DataFrame, id_col: str, text: str, source: str, revision: str = "unresolved:main") -> DataFrame:
    """df with raw_text_hash and document_id (32 hexadecimal digits); null texts count as empty."""
    h = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    return df.withColumn("raw_text_hash", h).withColumn("document_id", F.substring(F.sha2(F.concat_ws(":", F.coalesce(F.col(source), F.lit("")), F.lit(revision), F.col(id_col).cast("string"), F.col("raw_text_hash")), 256), 1, 32))


def revision_status(revision: Column) -> Column:
    """pinned_sha for 40 hexadecimal digits, else unresolved_fallback; a null revision is unresolved."""
    return F.when(F.coalesce(revision, F.lit("")).rlike("^[0-9a-fA-F]{40}$"), "pinned_sha").otherwise("unresolved_fallback")


def shares(config: DataFrame) -> DataFrame:
    """(source, share), one row per name, case and surrounding blanks aside. A null share is quota_3b_tokens / 3e9; of rows that
    differ under one name the smallest share counts. Blank names are left out."""
    c = config.select(blank_to_null("name").alias("source"), F.coalesce("share", F.col("quota_3b_tokens") / F.lit(3e9)).alias("share"))
    return c.where("source is not null").groupBy("source").agg(F.min("share").alias("share"))


def quotas(config: DataFrame, total_tokens: int) -> DataFrame:
    """(source, quota, pool): tokens each source is to give, and those to gather; a row per name."""
    c = shares(config).withColumn("quota", F.floor(F.col("share") * total_tokens).cast("long"))
    return c.select("source", "quota", F.floor(F.col("quota") * OVERSAMPLE).cast("long").alias("pool"))


def parse_count(text: str) -> int:
    """A number with an optional K, M or B."""
    t = text.strip().upper()
    factor = {"K": 10**3, "M": 10**6, "B": 10**9}.get(t[-1:], 1)
    return int(float(t[:-1] if factor > 1 else t) * factor)


def safe_key(name: Column) -> Column:
    """A name usable as an array key: slashes, dashes and dots become underscores."""
    return F.translate(name, "/-.", "___")
