"""Benchmark decontamination: texts that contain an item, or share most of its shingles, and the families they belong to."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import let, run_hashes, strip
from corpusmill.session import broadcast_if_small, written

#: Words per shingle, least share of an item's shingles, least words of an item.
SHINGLE, OVERLAP, LEAST_WORDS = 13, 0.70, 5
#: Items go to the executors with the code in blocks of so many characters; their shingles are broadcast up to so many bytes.
BLOCK_CHARS, MAX_SHINGLE_BYTES = 16_000_000, 32 << 20
_LETTERS = r"[\p{L}\p{N}_]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_LETTERS), F.lit(0))


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """Distinct hashes of the n-word shingles; a text of fewer words has one of all its words, one without words none."""
    short = lambda ws: F.when(F.size(ws) > 0, F.array(F.xxhash64(ws))).otherwise(F.array().cast("array<bigint>"))
    return let(_words(text), lambda ws: F.when(F.size(ws) >= n, F.array_distinct(run_hashes(ws, n))).otherwise(short(ws)))


def registry(benchmark: DataFrame) -> DataFrame:
    """(item_id, benchmark_name, item_text) of the items of five words or more, stripped and lower-cased, each once."""
    name = F.col("benchmark_name") if "benchmark_name" in benchmark.columns else F.lit("benchmark")
    d = benchmark.select("item_id", name.alias("benchmark_name"), F.lower(strip("text")).alias("item_text"))
    return d.where((F.size(_words(F.col("item_text"))) >= LEAST_WORDS) & F.col("item_id").isNotNull()).distinct()


def containing(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", block: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id) of texts that contain an item's whole text, case aside.

    All items of a block are sought at once by one automaton, so a text is read once per block of that many characters, not once
    per item.
    """
    import ahocorasick

    d = df.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text)).alias("text")).where("text is not null")
    id_type = d.schema["doc_id"].dataType.simpleString()
    out, found = None, []

    def scan(rows: list[tuple[int, str]]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            auto = ahocorasick.Automaton()
            for item, t in rows:
                auto.add_word(t, [*auto.get(t, []), item])
            auto.make_automaton()
            for b in batches:
                ids, items_ = [], []
                for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                    hit = {i for _, got in auto.iter(t) for i in got}
                    ids += [d] * len(hit)
                    items_ += sorted(hit)
                yield pa.RecordBatch.from_arrays([pa.array(ids, b.column("doc_id").type), pa.array(items_, pa.int64())], names=["doc_id", "item_id"])

        return d.mapInArrow(run, f"doc_id {id_type}, item_id long")

    size = 0
    for r in items.select("item_id", "item_text").toLocalIterator():
        if r[1]:
            found.append((r[0], r[1]))
            size += len(r[1])
        if size >= block:
            out, found, size = scan(found) if out is None else out.unionByName(scan(found)), [], 0
    if found or out is None:
        part = scan(found) if found else d.select("doc_id", F.lit(None).cast("long").alias("item_id")).limit(0)
        out = part if out is None else out.unionByName(part)
    return out


def overlapping(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = SHINGLE, least: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles) of texts that share at least `least` of an item's shingles.

    Shingles of texts meet those of items before any shuffle while the items are small; only matches are counted.
    """
    it = items.select("item_id", shingle_hashes(F.col("item_text"), n).alias("sh")).withColumn("item_shingles", F.size("sh"))
    it = it.select("item_id", "item_shingles", F.explode("sh").alias("s"))
    docs = df.select(F.col(id_col).alias("doc_id"), F.explode(shingle_hashes(F.col(text), n)).alias("s"))
    it = broadcast_if_small(written(it, "shingles"), MAX_SHINGLE_BYTES)  # the size of what is broadcast, not of the items
    hits = docs.join(it, "s").groupBy("doc_id", "item_id", "item_shingles").agg(F.count_distinct("s").alias("shared"))
    return hits.where(F.col("shared") >= F.col("item_shingles") * least).select("doc_id", "item_id", F.col("shared").cast("int").alias("shared"), "item_shingles")


def contamination_log(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """(doc_id, item_id, benchmark_name, match_type, overlap): of each contaminated text its first item, containment before overlap."""
    items = registry(benchmark)
    a = containing(df, items, id_col, text).select("doc_id", "item_id", F.lit("exact").alias("match_type"), F.lit(1.0).alias("overlap"))
    b = overlapping(df, items, id_col, text, **kw).select("doc_id", "item_id", F.lit("shingle_overlap").alias("match_type"), F.round(F.col("shared") / F.col("item_shingles"), 6).alias("overlap"))
    first = a.unionByName(b).groupBy("doc_id").agg(F.min(F.struct("item_id", "match_type", "overlap")).alias("x")).select("doc_id", "x.*")
    return first.join(broadcast_if_small(items.select("item_id", "benchmark_name")), "item_id").select("doc_id", "item_id", "benchmark_name", "match_type", "overlap")


def decontaminated(df: DataFrame, log: DataFrame, id_col: str = "doc_id", family: str | None = None) -> DataFrame:
    """df without the texts of the log, and without all of their family (rows of one value of that column; null is no family)."""
    if family is None:
        return df.join(log.select(F.col("doc_id").alias(id_col)).distinct(), id_col, "left_anti")
    ids = log.select(F.col("doc_id").alias("_id")).distinct()
    hit = df.join(ids, F.col(id_col) == F.col("_id")).select(F.coalesce(F.col(family).cast("string"), F.concat(F.lit("id:"), F.col(id_col).cast("string"))).alias("_f")).distinct()
    d = df.withColumn("_f", F.coalesce(F.col(family).cast("string"), F.concat(F.lit("id:"), F.col(id_col).cast("string"))))
    return d.join(hit, "_f", "left_anti").drop("_f")
