"""Training views of tokenized documents. Choices are hashes of the document, so views are the same in every run."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOS, EOS, DOC, MASK = 0, 1, 2, 11
CONTEXT = 4096
PREFIXES, HORIZONS = (256, 512, 1024), (1, 4, 16, 64, 256)


def pick(id_: Column, salt: str, n: Column | int) -> Column:
    """A number from 0 to n - 1 by the MD5 of salt and id."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(salt), id_.cast("string"))), 1, 8), 16, 10).cast("long")
    return F.pmod(h, n if isinstance(n, Column) else F.lit(n)).cast("int")


def shifted(seq: Column, context: int = CONTEXT, eos: int = EOS) -> dict[str, Column]:
    """input_token_ids, target_token_ids (the input shifted by one), loss_mask and attention_mask of `context` entries, padded with eos."""
    real = F.least(F.size(seq), F.lit(context + 1))
    full = F.concat(F.slice(seq, 1, context + 1), F.array_repeat(F.lit(eos), F.lit(context + 1) - real))
    ones = lambda n: F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(context) - n))
    return {
        "input_token_ids": F.slice(full, 1, context), "target_token_ids": F.slice(full, 2, context),
        "loss_mask": ones(F.greatest(real - 1, F.lit(0))), "attention_mask": ones(F.least(real, F.lit(context))),
    }


def windows(docs: DataFrame, seq: str, context: int = CONTEXT, eos: int = EOS) -> DataFrame:
    """document_id, split, window and the shifted arrays of consecutive windows of an array: each begins at the last id of the
    one before, so every id but the first is a target once. An array of one id or none has one window."""
    n = F.greatest(F.lit(1), F.ceil((F.size(seq) - 1) / context)).cast("int")
    d = docs.select("document_id", "split", seq, F.explode(F.sequence(F.lit(0), n - 1)).alias("window"))
    part = F.slice(F.coalesce(seq, F.array().cast("array<int>")), F.col("window") * context + 1, F.lit(context + 1))
    return d.select("document_id", "split", "window", part.alias("_s")).select("document_id", "split", "window", *(c.alias(k) for k, c in shifted(F.col("_s"), context, eos).items()))


def usage(split: Column) -> Column:
    return F.when(split == "train", "pretraining").otherwise("evaluation")


def crops(docs: DataFrame, context: int = CONTEXT, packing: bool = True, least: int = 64) -> DataFrame:
    """A view per document of at least context - 1 tokens (of any document if not packing): up to context + 1 tokens from a
    paragraph start (60 of 100 documents that have spans) or any start. Adds start_idx and the shifted arrays; crops
    under min(least, context) tokens are dropped."""
    n, id_ = F.size("token_ids"), F.col("document_id")
    long = n >= context + 1
    spans = F.size("paragraph_token_spans")
    at_paragraph = long & (spans > 0) & (pick(id_, "coin", 100) < 60)
    start = F.when(at_paragraph, F.element_at("paragraph_token_spans", pick(id_, "paragraph", F.greatest(spans, F.lit(1))) + 1)["start"]).when(long, pick(id_, "start", F.greatest(n - context, F.lit(1)))).otherwise(0)
    d = docs.where(n >= (context - 1 if packing else 1)).withColumn("start_idx", start)
    d = d.withColumn("_s", F.slice("token_ids", F.col("start_idx") + 1, context + 1)).where(F.size("_s") >= min(least, context))
    return d.select("document_id", "parent_document_id", "split", "start_idx", *(c.alias(k) for k, c in shifted(F.col("_s"), context).items()))


def next_fit(docs: DataFrame, context: int = CONTEXT, group_docs: int = 4096) -> DataFrame:
    """(split, view, place, document_id, n): documents under context - 1 tokens put into sequences in the order of their ids.

    A document that does not fit ends the sequence. Only sizes travel; a split is packed in groups of about
    group_docs documents by hash, each with its own last sequence, so no split is one task.
    """
    d = docs.select("document_id", "split", F.size("token_ids").alias("n")).where((F.col("n") > 0) & (F.col("n") < context - 1))
    groups = d.groupBy("split").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / group_docs)).cast("int").alias("g"))
    d = d.join(groups, d["split"].eqNullSafe(groups["split"])).select(d["*"], pick(F.col("document_id"), "group", F.col("g")).alias("part"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("document_id", kind="stable")
        view, place, used, v, k = [], [], 0, -1, 0
        for n in pdf["n"]:
            if v < 0 or used + n + 2 > context + 1:
                v, k, used = v + 1, 0, 0
            used += n + 2
            view.append(v)
            place.append(k)
            k += 1
        return pd.DataFrame({"split": pdf["split"], "view": [f"{p}_{v}" for p, v in zip(pdf["part"], view, strict=True)], "place": place, "document_id": pdf["document_id"], "n": pdf["n"]})

    return d.groupBy("split", "part").applyInPandas(run, "split string, view string, place int, document_id string, n int")


def packed(docs: DataFrame, context: int = CONTEXT, group_docs: int = 4096) -> DataFrame:
    """The sequences of next_fit with their documents and shifted arrays; document_id must be unique."""
    placed = next_fit(docs, context, group_docs)
    d = placed.join(docs.select("document_id", "token_ids"), "document_id")
    d = d.groupBy("split", "view").agg(F.array_sort(F.collect_list(F.struct("place", "document_id", "token_ids"))).alias("x"))
    seq = F.flatten(F.transform("x", lambda x: F.concat(F.array(F.when(x["place"] == 0, BOS).otherwise(DOC)), x["token_ids"], F.array(F.lit(EOS)))))
    d = d.select("split", "view", F.transform("x", lambda x: x["document_id"]).alias("source_document_ids"), seq.alias("_s"))
    return d.select("split", "view", "source_document_ids", *(c.alias(k) for k, c in shifted(F.col("_s"), context).items()))


def prefix_suffix(docs: DataFrame, least: int = 512, gap: int = 64) -> DataFrame:
    """A prefix of 256, 512 or 1024 tokens and the 1 to 256 tokens after it, of documents of `least` tokens that leave `gap` beyond the prefix."""
    id_ = F.col("document_id")
    p = F.element_at(F.array(*map(F.lit, PREFIXES)), pick(id_, "prefix", len(PREFIXES)) + 1)
    h = F.element_at(F.array(*map(F.lit, HORIZONS)), pick(id_, "horizon", len(HORIZONS)) + 1)
    n = F.size("token_ids")
    d = docs.withColumns({"prefix_len": p, "horizon": h}).where((n >= least) & (n > F.col("prefix_len") + gap))
    return d.select("document_id", "split", "prefix_len", "horizon", F.slice("token_ids", F.lit(1), F.col("prefix_len")).alias("input_token_ids"), F.slice("token_ids", F.col("prefix_len") + 1, F.col("horizon")).alias("target_token_ids"))


def bridges(docs: DataFrame, context: int = CONTEXT, mask: int = MASK) -> DataFrame:
    """Documents of three paragraphs or more with an inner one masked; the input is cut to the context, the paragraph is the target."""
    spans = F.size("paragraph_token_spans")
    d = docs.where(spans >= 3).withColumn("p_idx", pick(F.col("document_id"), "bridge", F.greatest(spans - 2, F.lit(1))) + 1)
    d = d.withColumn("_p", F.element_at("paragraph_token_spans", F.col("p_idx") + 1))
    left = F.slice("token_ids", F.lit(1), F.col("_p.start"))
    right = F.slice("token_ids", F.col("_p.end") + 1, F.greatest(F.size("token_ids") - F.col("_p.end"), F.lit(0)))
    inner = F.slice("token_ids", F.col("_p.start") + 1, F.greatest(F.col("_p.end") - F.col("_p.start"), F.lit(0)))
    return d.select("document_id", "split", "p_idx", F.slice(F.concat(left, F.array(F.lit(mask)), right), 1, context).alias("input_token_ids"), inner.alias("target_token_ids"))


def union(docs: DataFrame, context: int = CONTEXT) -> DataFrame:
    """All kinds of views in one table: view_type, split, usage, source_document_ids, horizon (null but for prefix_suffix), input_token_ids,
    target_token_ids, loss_mask, attention_mask (empty where the target is not the input shifted by one)."""
    one, none = F.array(F.col("document_id").cast("string")), F.array().cast("array<int>")
    no, masks = F.lit(None).cast("int"), lambda: (none.alias("loss_mask"), none.alias("attention_mask"))

    def rows(name: str, d: DataFrame, ids: Column, horizon: Column, *rest) -> DataFrame:
        return d.select(F.lit(name).alias("view_type"), "split", usage(F.col("split")).alias("usage"), ids.alias("source_document_ids"), horizon.alias("horizon"), "input_token_ids", "target_token_ids", *rest)

    out = rows("causal_packed", packed(docs, context), F.col("source_document_ids").cast("array<string>"), no, "loss_mask", "attention_mask")
    out = out.unionByName(rows("causal_single_doc", crops(docs, context), one, no, "loss_mask", "attention_mask"))
    out = out.unionByName(rows("prefix_suffix", prefix_suffix(docs), one, F.col("horizon").cast("int"), *masks()))
    return out.unionByName(rows("bridge_masked_span", bridges(docs, context), one, no, *masks()))
