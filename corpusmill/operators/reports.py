"""Audit reports: small aggregates, and their rendering as Markdown on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def by_source(canonical: DataFrame, tokenized: DataFrame) -> DataFrame:
    """(source, n_docs, n_tokens, share): segments and tokens per source, and the share of all tokens in percent; each document once."""
    c = canonical.select("document_id", "source").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    t = tokenized.groupBy("document_id", "source").agg(F.max(F.size("token_ids")).alias("n")).groupBy(F.col("source").alias("_s")).agg(F.sum("n").alias("n_tokens"))
    d = c.join(t, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "n_docs", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))
    return d.withColumn("share", F.round(F.col("n_tokens") * 100.0 / F.sum("n_tokens").over(Window.partitionBy()), 4))  # a row per source


def by_rule(judged: DataFrame) -> DataFrame:
    """(rule, n_docs) of rejected documents."""
    return judged.where("rule is not null").groupBy("rule").agg(F.count(F.lit(1)).alias("n_docs"))


def redactions(normalized: DataFrame) -> DataFrame:
    """One row: the documents and the values redacted in them, in all and by kind."""
    kinds = ("n_api_key", "n_email", "n_ip", "n_phone")
    total = sum((F.coalesce(F.sum(k), F.lit(0)) for k in kinds), F.lit(0))
    return normalized.agg(F.count(F.lit(1)).alias("n_docs"), total.alias("n_pii"), *(F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in kinds))


def duplicates(df: DataFrame, text: str) -> DataFrame:
    """One row: documents with a text, those removed as exact copies, those retained."""
    g = df.where(F.col(text).isNotNull()).groupBy(F.sha2(text, 256).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.sum("n").alias("n_docs"), (F.sum("n") - F.count(F.lit(1))).alias("n_removed"), F.count(F.lit(1)).alias("n_retained"))


def structure(canonical: DataFrame) -> DataFrame:
    """One row: spans of each kind over all distinct documents."""
    kinds = ("paragraph_spans", "sentence_spans", "turn_spans", "equation_spans")
    one = canonical.groupBy("document_id").agg(*(F.max(F.greatest(F.size(f"structure.{k}"), F.lit(0))).alias(k) for k in kinds))
    return one.agg(*(F.sum(k).alias(k) for k in kinds))


def token_totals(tokenized: DataFrame) -> DataFrame:
    """One row: documents, tokens and tokens per document."""
    return tokenized.agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.size("token_ids")).alias("n_tokens"), F.round(F.avg(F.size("token_ids")), 4).alias("mean_tokens"))


def by_split(tokenized: DataFrame, shares: DataFrame) -> DataFrame:
    """(split, n_docs, n_tokens, share, target) per split of the list or of the documents; the target is null for one that the list lacks."""
    t = tokenized.groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.coalesce(F.size("token_ids"), F.lit(0))).alias("n_tokens"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    d = shares.select("split", F.col("share").alias("target")).distinct().join(t, "split", "full_outer").select("split", zero("n_docs"), zero("n_tokens"), "target")
    return d.select("split", "n_docs", "n_tokens", F.round(F.col("n_tokens") / F.sum("n_tokens").over(Window.partitionBy()), 6).alias("share"), "target")  # a row per split


def first_matches(log: DataFrame, n: int = 50) -> DataFrame:
    """The first n rows of a contamination log, by document."""
    return log.orderBy("doc_id").limit(n)


def markdown(df: DataFrame, title: str, most: int = 1000) -> str:
    """A small report as a Markdown table; more than `most` rows raise ValueError."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    head = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*head, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows)]) + "\n"
