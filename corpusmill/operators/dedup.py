"""Exact, paragraph and near-duplicate detection; nothing here emits all pairs of a group of copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import let, once, run_hashes, strip, word_count
from corpusmill.operators.components import connected_components
from corpusmill.session import broadcast_if_small, written

# Ranks of the categories and weights of the score.
CATEGORY_RANK = {"books": 0.95, "scientific": 0.90, "educational": 0.85, "wikimedia": 0.80, "government_legal": 0.75, "technical": 0.70, "discussion": 0.65, "web": 0.50}
RANK_WEIGHT, STRUCTURE_WEIGHT, BASE_SCORE = 0.35, 0.25, 0.40
#: Near duplicates: words per shingle and least similarity.
SHINGLE, SIMILARITY = 5, 0.8
PRIME = 4294967311
PERMUTATIONS, BANDS = 128, 16
_LETTERS = r"[\p{L}\p{N}_]+"


def category_score(category: Column, structured: Column | None = None) -> Column:
    """The quality score of a document by its category and whether it has structure."""
    rank = F.lit(CATEGORY_RANK["web"])
    for c, r in CATEGORY_RANK.items():
        rank = F.when(F.lower(category) == c, r).otherwise(rank)
    s = F.lit(1.0) if structured is None else F.when(structured, 1.0).otherwise(0.5)
    return rank * RANK_WEIGHT + s * STRUCTURE_WEIGHT + BASE_SCORE


def measured_score(category: Column, structured: Column, language: Column, final: Column) -> Column:
    """The score of a document whose language probability and final quality were measured (0 where null)."""
    base = category_score(category, structured) - BASE_SCORE
    return base + (F.coalesce(language, F.lit(0.0)) + F.coalesce(final, F.lit(0.0))) * (BASE_SCORE / 2)


def winner_key(score: Column, priority: Column, id_: Column) -> Column:
    """The smallest wins: best score, then lowest priority, then lowest id."""
    return F.struct((-score).alias("score"), priority.alias("priority"), id_.alias("id"))


def exact_duplicates(df: DataFrame, text: str, score: Column, priority: Column, id_col: str) -> DataFrame:
    """(text_hash, winner, copies) of each distinct text; one aggregate with map-side combine, so no copy group is ever sorted. Null texts are left out."""
    d = df.where(F.col(text).isNotNull()).select(F.sha2(F.col(text), 256).alias("text_hash"), winner_key(score, priority, F.col(id_col)).alias("k"))
    return d.groupBy("text_hash").agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("copies")).select("text_hash", F.col("k.id").alias("winner"), "copies")


def paragraph_frequency(df: DataFrame, id_col: str, text: str, gap: str = "\n\n", min_words: int = 50, min_docs: int = 10) -> DataFrame:
    """(paragraph_hash, documents) of paragraphs of min_words words or more in at least min_docs documents."""
    d = _paragraphs(df, id_col, text, gap, min_words).where("paragraph_hash is not null")
    return d.select("paragraph_hash", F.col(id_col)).distinct().groupBy("paragraph_hash").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") >= min_docs)


def _paragraphs(df: DataFrame, id_col: str, text: str, gap: str, min_words: int) -> DataFrame:
    d = df.select(id_col, F.posexplode(F.split(text, gap)).alias("pos", "p")).withColumn("p", strip("p"))
    return d.select(id_col, "pos", once(F.when(word_count("p") >= min_words, F.md5("p"))).alias("paragraph_hash"))


def strip_frequent_paragraphs(df: DataFrame, id_col: str, text: str, gap: str = "\n\n", min_words: int = 50, min_docs: int = 10, least_words: int = 64) -> DataFrame:
    """df with stripped_text (frequent paragraphs and empty pieces removed, the rest stripped and joined), paragraphs_removed
    and too_short, for texts now under least_words words. id_col must be unique."""
    frequent = written(paragraph_frequency(df, id_col, text, gap, min_words, min_docs), "frequent")
    hits = _paragraphs(df, id_col, text, gap, min_words).where("paragraph_hash is not null")
    hits = hits.join(broadcast_if_small(frequent.select("paragraph_hash")), "paragraph_hash")
    bad = hits.groupBy(F.col(id_col).alias("_id")).agg(F.collect_list("pos").alias("_bad"))
    d = df.join(bad, F.col(id_col) == F.col("_id"), "left")
    pieces = F.transform(F.split(text, gap), strip)
    kept = F.filter(F.filter(pieces, lambda p, i: ~F.coalesce(F.array_contains("_bad", i), F.lit(False))), lambda p: p != "")
    d = d.withColumn("stripped_text", strip(F.array_join(kept, gap))).withColumn("paragraphs_removed", F.coalesce(F.size("_bad"), F.lit(0)))
    return d.withColumn("paragraphs_removed", F.greatest("paragraphs_removed", F.lit(0))).withColumn("too_short", word_count("stripped_text") < least_words).drop("_id", "_bad")


def shingles(text: Column, n: int = SHINGLE) -> Column:
    """The distinct n-word shingles of the lower-cased letter and digit words; none for fewer words or a null text."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_LETTERS), F.lit(0))
    last = lambda ws: F.greatest(F.size(ws) - n + 1, F.lit(1))
    cut = lambda ws: F.transform(F.sequence(F.lit(1), last(ws)), lambda i: F.array_join(F.slice(ws, i, n), " "))
    return let(found, lambda ws: F.when(F.size(ws) >= n, F.array_distinct(cut(ws))).otherwise(F.array().cast("array<string>")))


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """shingles as 64-bit hashes of the hashes of their words, sorted."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_LETTERS), F.lit(0))
    return F.sort_array(F.array_distinct(run_hashes(found, n)))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays of distinct elements; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(0.0)


def shingle_classes(df: DataFrame, id_col: str, text: str, n: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(representatives, members): documents of one shingle set form a class.

    representatives: rep, sh (sorted hashes). members: document_id, rep. Copies are expanded no further.
    Documents without shingles are classes of their own, in members only.
    """
    d = df.select(F.col(id_col).alias("document_id"), shingle_hashes(F.col(text), n).alias("sh")).where("document_id is not null")
    d = d.withColumn("h", F.when(F.size("sh") > 0, F.md5(F.array_join(F.transform("sh", lambda x: x.cast("string")), ","))))
    d = written(d, "shingles")
    some = d.where("h is not null")
    reps = some.groupBy("h").agg(F.min("document_id").alias("rep"))
    members = some.select("document_id", "h").join(reps, "h").select("document_id", "rep")
    members = members.unionByName(d.where("h is null").select("document_id", F.col("document_id").alias("rep"))).distinct()
    sets = some.join(reps.withColumnRenamed("h", "h2"), (F.col("h") == F.col("h2")) & (F.col("document_id") == F.col("rep"))).select("rep", "sh").dropDuplicates(["rep"])
    return written(sets, "sets"), written(members, "members")


def prefixes(sets: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(rep, n, s, i): the shingles s of each set's prefix, with the size n of the set and the place i among its shingles by rarity.

    With shingles ordered by rarity, two similar sets share one of their first size - ceil(least x size) + 1. Common shingles
    come last, so those of boilerplate hardly ever make a pair. Shingles of one set only come first in the order and match
    nothing; they only shift the places of the others.
    """
    one = sets.select("rep", F.size("sh").alias("n"), F.explode("sh").alias("s"))
    freq = one.groupBy("s").agg(F.count(F.lit(1)).alias("f"))
    ranked = one.join(freq, "s").where("f > 1").select("rep", "n", F.struct("f", "s").alias("x"))
    ranked = ranked.groupBy("rep", "n").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    lone = F.col("n") - F.size("xs")
    size = F.col("n") - F.ceil(F.col("n") * least - 1e-9).cast("int") + 1 - lone
    cand = ranked.where(size > 0).select("rep", "n", F.posexplode(F.transform(F.slice("xs", F.lit(1), size), lambda x: x["s"])).alias("i", "s"), lone.alias("lone"))
    return written(cand.select("rep", "n", "s", (F.col("i") + F.col("lone")).alias("i")), "prefixes")


def _sides(cand: DataFrame) -> tuple[DataFrame, DataFrame]:
    return cand.select(*(F.col(c).alias(f"{c}_a") for c in cand.columns)), cand.select(*(F.col(c).alias(f"{c}_b") for c in cand.columns))


def _may_be_similar(least: float) -> Column:
    """Whether the sizes, and the places of the shared shingle, leave room for the similarity."""
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    rest = F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b"))  # the most they can share from here on
    need = (F.col("n_a") + F.col("n_b")) * (least / (1 + least)) - 1e-9
    return (small >= large * least - 1e-9) & (F.least(F.col("i_a"), F.col("i_b")) + rest >= need)


def verified(pairs: DataFrame, sets: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b) whose sets are similar."""
    full = sets.select(F.col("rep").alias("a"), F.col("sh").alias("sa"))
    other = sets.select(F.col("rep").alias("b"), F.col("sh").alias("sb"))
    out = pairs.join(full, "a").join(other, "b").withColumn("similarity", jaccard(F.col("sa"), F.col("sb")))
    return out.where(F.col("similarity") >= least).select("a", "b", "similarity")


def similar_pairs(sets: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity) of all pairs of representatives, a < b, with similarity of at least `least`; exact, by prefix filtering.

    This is the similarity join: k texts that are all similar to each other give all their pairs. near_duplicates does without them.
    """
    a, b = _sides(prefixes(sets, least))
    pairs = a.join(b, (F.col("s_a") == F.col("s_b")) & (F.col("rep_a") < F.col("rep_b")) & _may_be_similar(least))
    return verified(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct(), sets, least)


def similar_clusters(sets: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(rep, cluster) of the sets that are connected by similarity with another; exact, without all pairs of a cluster.

    First each set is compared with one hub per shingle of its prefix, the smallest set that has it: a star, not all pairs. What
    these links connect is one part. Then sets of different parts are compared, where they share a shingle of their prefixes:
    parts that share one are joined first, and then their members, so members of one part never meet.
    """
    cand = prefixes(sets, least)
    hub = cand.groupBy("s").agg(F.min(F.struct("rep", "n", "i")).alias("x"), F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("s").alias("s_a"), F.col("x.rep").alias("rep_a"), F.col("x.n").alias("n_a"), F.col("x.i").alias("i_a"))
    star = hub.join(_sides(cand)[1], (F.col("s_a") == F.col("s_b")) & (F.col("rep_a") < F.col("rep_b")) & _may_be_similar(least))
    links = written(verified(star.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct(), sets, least).select("a", "b"), "stars")
    part = written(connected_components(links, "a", "b"), "parts")
    marked = cand.join(part.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("part", F.coalesce("component", "rep")).drop("component")
    mixed = marked.groupBy("s").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("s")
    marked = written(marked.join(mixed, "s", "left_semi"), "marked")
    there = marked.select("s", "part").distinct()
    pa, pb = _sides(there)
    met = pa.join(pb, (F.col("s_a") == F.col("s_b")) & (F.col("part_a") < F.col("part_b"))).select(F.col("s_a").alias("s"), "part_a", "part_b")
    a, b = _sides(marked)
    pairs = met.join(a, (F.col("s") == F.col("s_a")) & (met["part_a"] == a["part_a"])).drop(a["part_a"]).join(b, (F.col("s") == F.col("s_b")) & (met["part_b"] == b["part_b"]))
    pairs = pairs.where(_may_be_similar(least)).select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()
    more = written(verified(pairs, sets, least).select("a", "b"), "links")
    if not more.isEmpty():
        # parts as nodes: what the later links connect
        name = lambda c, as_: part.select(F.col("node").alias(c), F.col("component").alias(as_))
        edges = more.join(name("a", "pa"), "a", "left").join(name("b", "pb"), "b", "left").select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))
        last = written(connected_components(edges, "a", "b"), "joined")
        alone = more.select(F.col("a").alias("rep")).unionByName(more.select(F.col("b").alias("rep"))).distinct().join(part.select(F.col("node").alias("rep")), "rep", "left_anti")
        ends = part.select(F.col("node").alias("rep"), F.col("component").alias("part")).unionByName(alone.select("rep", F.col("rep").alias("part")))
        return ends.join(last.select(F.col("node").alias("part"), "component"), "part", "left").select("rep", F.coalesce("component", "part").alias("cluster"))
    return part.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))


def near_duplicates(df: DataFrame, id_col: str, text: str, n: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """(document_id, class_id, cluster): one row per document with its copies' class, and the smallest document of all those
    connected by similarity."""
    sets, members = shingle_classes(df, id_col, text, n)
    out = members.join(similar_clusters(sets, least), "rep", "left")
    return out.select("document_id", F.col("rep").alias("class_id"), F.coalesce("cluster", "rep").alias("cluster"))


def class_links(df: DataFrame, id_col: str, text: str, n: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """(class_id, links): the number of other classes similar to each class."""
    sets, members = shingle_classes(df, id_col, text, n)
    pairs = written(similar_pairs(sets, least).select("a", "b"), "pairs")
    links = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("rep")).agg(F.count(F.lit(1)).alias("links"))
    return members.select("rep").distinct().join(links, "rep", "left").select(F.col("rep").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))


# --- MinHash, for candidates where an approximate answer will do


def _coefficients(n: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.RandomState(seed)
    return r.randint(1, 4294967295, size=n, dtype=np.uint64), r.randint(0, 4294967295, size=n, dtype=np.uint64)


def minhash(df: DataFrame, id_col: str, text: str, n: int = SHINGLE, permutations: int = PERMUTATIONS) -> DataFrame:
    """(document_id, signature array<bigint>) of each document with shingles: per permutation the least (a h + b) mod p over 32-bit hashes."""
    h = F.transform(shingles(F.col(text), n), lambda s: F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long"))
    d = df.select(F.col(id_col).alias("document_id"), h.alias("h")).where(F.size("h") > 0)
    id_type = d.schema["document_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coefficients(permutations)

        def signature(h: np.ndarray) -> np.ndarray:
            parts = (((a[:, None] * h[None, i : i + 8192] + b[:, None]) % np.uint64(PRIME)).min(axis=1) for i in range(0, len(h), 8192))
            return np.minimum.reduce(list(parts)).astype(np.int64)

        for batch in batches:
            sig = [signature(np.array(x, dtype=np.uint64)) for x in batch.column("h").to_pylist()]
            flat = np.concatenate(sig) if sig else np.empty(0, np.int64)
            at = pa.array(np.arange(len(sig) + 1, dtype=np.int32) * permutations)
            yield pa.RecordBatch.from_arrays([batch.column("document_id"), pa.ListArray.from_arrays(at, pa.array(flat))], names=["document_id", "signature"])

    return d.mapInArrow(run, f"document_id {id_type}, signature array<bigint>")


def band_keys(signatures: DataFrame, bands: int = BANDS) -> DataFrame:
    """(document_id, band, key): the bucket of each document in each band."""
    rows = F.size("signature") / bands
    return signatures.select("document_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.md5(F.array_join(F.transform(F.slice("signature", (i * rows + 1).cast("int"), rows.cast("int")), lambda x: x.cast("string")), ",")))).alias("band", "key"))


def band_links(signatures: DataFrame, bands: int = BANDS) -> DataFrame:
    """(a, b): each document of a band's bucket linked to the smallest there; a star per bucket, never all its pairs."""
    d = band_keys(signatures, bands)
    hub = d.groupBy("band", "key").agg(F.min("document_id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return d.join(hub, ["band", "key"]).where("document_id <> a").select("a", F.col("document_id").alias("b")).distinct()


def lsh_links(df: DataFrame, id_col: str, text: str, n: int = 20, least: float = 0.90, rounds: int = 3) -> DataFrame:
    """(a, b, similarity) of links found by MinHash and verified: in each bucket of a band all are compared with its smallest; those
    that are not similar to it are put together again, up to `rounds` times. Approximate; exact is similar_pairs."""
    sets, members = shingle_classes(df, id_col, text, n)
    d = df.join(sets.select(F.col("rep").alias(id_col)), id_col, "left_semi")  # one document of each class
    left = written(band_keys(minhash(d, id_col, text, n)), "bands")
    out = None
    for _ in range(rounds):
        hub = left.groupBy("band", "key").agg(F.min("document_id").alias("a"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
        met = written(left.join(hub, ["band", "key"]).where("document_id <> a"), "met")
        good = written(verified(met.select("a", F.col("document_id").alias("b")).distinct(), sets, least), "verified")
        out = good if out is None else out.unionByName(good)
        left = written(met.join(good.select("a", F.col("b").alias("document_id")), ["a", "document_id"], "left_anti").drop("a"), "bands")
    return out.distinct()


def family_groups(members: DataFrame, group: str, edge_key: str) -> DataFrame:
    """(group, family): groups that share a value of edge_key belong to one family, named by its smallest group."""
    hub = members.groupBy(edge_key).agg(F.min(group).alias("hub"))
    edges = members.select(edge_key, group).distinct().join(hub, edge_key).select(F.col(group).alias("src"), F.col("hub").alias("dst")).distinct()
    comp = connected_components(edges)
    return members.select(F.col(group).alias("node")).distinct().join(comp, "node", "left").select(F.col("node").alias("group_id"), F.coalesce("component", "node").alias("family"))
