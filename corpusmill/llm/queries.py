"""The queries of the training-data problems, each over its whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import encoding, leaks, mixing, packing, pii, related_splits, repeated_lines, repetition, sampling
from corpusmill.session import distinct_rows, table, written

#: Share of each source's identifiers that the sample query selects.
SAMPLE_RATE = 0.1


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    out = related_splits.related_splits(table(spark, d, "canonical_docs"), table(spark, d, "split_config"))
    return out.where("conflict").select("document_id").distinct()


def p1_assignment(spark: SparkSession, d: str) -> DataFrame:
    out = related_splits.related_splits(table(spark, d, "canonical_docs"), table(spark, d, "split_config"))
    return out.select("document_id", "component", "component_size", "split")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    shares = table(spark, d, "split_config")
    return related_splits.split_report(related_splits.related_splits(table(spark, d, "canonical_docs"), shares), shares)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "tokenized_docs")
    return packing.broken_items(table(spark, d, "view_records"), docs, packing.pack(docs))


def p2_records(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "tokenized_docs")
    return packing.records(docs, packing.pack(docs))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.repeated_lines(table(spark, d, "canonical_docs"), unnamed=True).select("document_id", "line_no").distinct()


def p3_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.without_repeated_lines(table(spark, d, "canonical_docs")).withColumn("lines_removed", F.col("lines_removed").cast("long"))


def p3_templates(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.templates(table(spark, d, "canonical_docs"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.pii_values(table(spark, d, "canonical_docs"), table(spark, d, "name_list"))


def p4_redacted(spark: SparkSession, d: str) -> DataFrame:
    docs = distinct_rows(table(spark, d, "canonical_docs").select("document_id", "normalized_text"))
    return pii.find_pii(docs, table(spark, d, "name_list"), redact=True).select("document_id", F.size("found").alias("n_found"), "redacted_text")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.unreachable_sources(table(spark, d, "canonical_docs"), table(spark, d, "source_config"))


def p5_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(table(spark, d, "canonical_docs"), table(spark, d, "source_config"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture_report(table(spark, d, "canonical_docs"), table(spark, d, "source_config"))


def p6_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stable_sample(table(spark, d, "canonical_docs"), SAMPLE_RATE)


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode(table(spark, d, "documents"))


def p7_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return encoding.round_trip(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "benchmark")).where("exact").select("doc_id", "item_id").distinct()


def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    out = leaks.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return out.where("exact or score >= 0.6").select("doc_id", "item_id", F.round("score", 4).alias("score"), "longest_run", "exact")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repeated_share(table(spark, d, "documents")).where("10 * repeated >= 3 * n_words and n_words > 0").select("doc_id").distinct()


def p9_share(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repeated_share(table(spark, d, "documents"))


def p9_fertility(spark: SparkSession, d: str) -> DataFrame:
    return repetition.fertility_rejects(written(repetition.fertility(table(spark, d, "documents")), "fertility"))


QUERIES = {f.__name__: f for f in (p1_found, p1_assignment, p1_report, p2_found, p2_records, p3_found, p3_cleaned, p3_templates, p4_found, p4_redacted, p5_found, p5_mixture, p5_report, p6_sample, p7_ids, p7_round_trip, p8_found, p8_scores, p9_found, p9_share, p9_fertility)}


def _sample_sql() -> str:
    """The Feistel rounds of sampling.with_place as nested selects."""
    low = (1 << 32) - 1

    def mix(x: str, k: str, i: int) -> str:
        m, o = sampling.MULTIPLIERS[i], sampling.OFFSETS[i]
        y = f"((((xor({x}, {k})) * {m} + {o}) >> 17) & {low})"
        return f"((({y} * {m} + {o}) & {(1 << 55) - 1}) >> 23)"

    limb = lambda s, k: f"('0x' || substr({s}, {8 * k + 1}, 8))::BIGINT"
    q = "SELECT DISTINCT document_id, source, regexp_matches(document_id, '^[0-9a-f]{32}') AS regular FROM canonical_docs WHERE document_id IS NOT NULL"
    q = f"SELECT *, CASE WHEN regular THEN substr(document_id, 1, 32) ELSE md5(document_id) END AS digits, md5('0|' || coalesce(source, '') || '|' || CASE WHEN regular THEN substr(document_id, 33) ELSE '' END) AS tweak FROM ({q})"
    q = f"SELECT document_id, source, {', '.join(f'{limb("digits", k)} AS {n}' for k, n in enumerate('abcd'))}, {', '.join(f'{limb("tweak", k)} AS {n}' for k, n in enumerate('wxyz'))} FROM ({q})"
    for r in range(sampling.ROUNDS):
        q = f"SELECT document_id, source, xor(b, {mix('a', 'w', 2 * r)}) AS a, c AS b, xor(d, {mix('c', 'x', 2 * r + 1)}) AS c, a AS d, x AS w, y AS x, z AS y, w AS z FROM ({q})"
    return f"SELECT document_id, source FROM ({q}) WHERE a * {1 << 30} + (b >> 2) < {int(SAMPLE_RATE * (1 << 62))}"




def _norm(x: str) -> str:
    """Lower-cased, without surrounding white space."""
    return rf"nullif(lower(regexp_replace({x}, '\A[\t-\r\x1c-\x1f \x85\p{{Z}}]+|[\t-\r\x1c-\x1f \x85\p{{Z}}]+\z', '', 'g')), '')"


_LABEL = f"CASE WHEN {_norm('split')} = 'val' THEN 'validation' ELSE {_norm('split')} END"

ORACLE_SQL = {
    "p1_found": f"""
WITH RECURSIVE recs AS (
  SELECT DISTINCT document_id, {_norm('parent_document_id')} AS p, {_norm('split_group_id')} AS g, {_LABEL} AS label FROM canonical_docs),
edges AS (SELECT p AS a, g AS b FROM recs WHERE p IS NOT NULL AND g IS NOT NULL UNION SELECT g, p FROM recs WHERE p IS NOT NULL AND g IS NOT NULL
  UNION SELECT coalesce(p, g), coalesce(p, g) FROM recs WHERE coalesce(p, g) IS NOT NULL),
reach AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
comp AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a),
lab AS (SELECT document_id, component, label FROM recs JOIN comp ON comp.node = coalesce(p, g)),
bad AS (SELECT component FROM lab GROUP BY component HAVING count(DISTINCT label) > 1)
SELECT DISTINCT document_id FROM lab JOIN bad USING (component)""",
    "p2_found": f"""
WITH t AS (SELECT {_norm('document_id')} AS k, ',' || array_to_string(min(token_ids), ',') || ',' AS ids FROM tokenized_docs WHERE len(token_ids) BETWEEN 1 AND 510 GROUP BY 1),
v AS (SELECT DISTINCT view_id, unnest(source_document_ids) AS document_id, ',' || array_to_string(input_token_ids, ',') || ',' AS input FROM view_records)
SELECT DISTINCT view_id, document_id FROM v JOIN t ON t.k = {_norm('v.document_id')} WHERE NOT contains(input, ids)""",
    "p3_found": r"""
WITH l AS (SELECT document_id, source, unnest(string_split(normalized_text, chr(10))) AS line, generate_subscripts(string_split(normalized_text, chr(10)), 1) - 1 AS line_no FROM canonical_docs WHERE source IS NOT NULL),
w AS (SELECT document_id, source, line_no, lower(array_to_string(regexp_extract_all(line, '\p{L}+'), ' ')) AS t, len(regexp_extract_all(line, '\p{L}+')) AS n FROM l),
r AS (SELECT source, t FROM w WHERE n >= 4 GROUP BY ALL HAVING count(DISTINCT document_id) >= 6)
SELECT DISTINCT document_id, line_no::BIGINT AS line_no FROM w JOIN r USING (source, t)""",
    "p3_cleaned": r"""
WITH d AS (SELECT DISTINCT document_id, source, normalized_text AS t FROM canonical_docs),
l AS (SELECT document_id, source, t, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
w AS (SELECT *, lower(array_to_string(regexp_extract_all(line, '\p{L}+'), ' ')) AS x, len(regexp_extract_all(line, '\p{L}+')) AS n FROM l),
r AS (SELECT source, x FROM w WHERE n >= 4 AND source IS NOT NULL AND document_id IS NOT NULL GROUP BY ALL HAVING count(DISTINCT document_id) >= 6),
c AS (SELECT document_id, w.source AS source, t, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (r.x IS NULL), '') AS clean_text, count(r.x) AS lines_removed FROM w LEFT JOIN r ON r.source = w.source AND r.x = w.x AND n >= 4 GROUP BY ALL)
SELECT document_id, source, clean_text, lines_removed FROM c UNION ALL SELECT document_id, source, NULL, 0 FROM d WHERE t IS NULL""",
    "p5_found": rf"""
WITH c AS (SELECT {_norm('name')} AS source, min(coalesce(share, quota_3b_tokens / 3000000000.0)) AS share, min(coalesce(max_repeats, 1)) AS r FROM source_config GROUP BY 1),
d AS (SELECT document_id, {_norm('source')} AS source, max(coalesce(len(regexp_extract_all(normalized_text, '[^\t-\r\x1c-\x1f \x85\p{{Z}}]+')), 0)) AS n FROM canonical_docs GROUP BY ALL),
a AS (SELECT c.source, c.share, c.r, coalesce(sum(d.n), 0) AS a FROM c LEFT JOIN d USING (source) GROUP BY ALL)
SELECT source FROM a WHERE share * (SELECT sum(a) FROM a) > r * a""",
    "p6_sample": _sample_sql(),
}
