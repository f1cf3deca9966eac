"""Stages with a cache: each writes a table and a manifest, and runs again only if something it depends on changed."""

from __future__ import annotations

import hashlib
import json
import os
import subprocess
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import cleaners, decontam, dedup, freeze, identity, ingest, layers, normalize, quality, reports, segment, splits, stats, tokens, views
from corpusmill.session import blank_to_null, broadcast_if_small, remove_path, scratch, table
from corpusmill.sources.files import read_text, write_sidecar, write_text

SCHEMA_VERSION = "1"
PRODUCTION_TOKENS = 1_000_000_000


@dataclass
class Config:
    """Settings of a run. strict raises where a fallback would be used otherwise.

    Sources, their shares, limits and revisions are the table source_config beside the input.
    """

    total_tokens: int = 3_000_000_000
    seed: int = 42
    max_records: int | None = None
    max_scanned: int | None = None
    max_oversized: int = 100
    tokenizer: str = layers.TOKENIZER
    vocabulary: int = 50_257
    paragraph_words: int = 50
    paragraph_documents: int = 10
    shingle: int = dedup.SHINGLE
    similarity: float = dedup.SIMILARITY
    context: int = views.CONTEXT
    tolerance: float = 0.0005
    shares: dict[str, float] = field(default_factory=lambda: {"validation": 0.001, "test": 0.001, "trajectory_holdout": 0.001})
    max_words: int = segment.MAX_WORDS
    contamination_overlap: float = decontam.OVERLAP

    @property
    def strict(self) -> bool:
        return self.total_tokens >= PRODUCTION_TOKENS

    @classmethod
    def load(cls, path: str, scale: str | None = None) -> Config:
        """From a JSON file; unknown keys raise TypeError. scale overrides total_tokens."""
        with open(path) as f:
            c = cls(**json.load(f))
        if scale:
            c.total_tokens = identity.parse_count(scale)
        return c


def code_identity(strict: bool = False) -> str:
    """What code runs: CORPUSMILL_CODE_ID, else the git commit with a hash of local changes, else a hash of the sources."""
    if own := os.environ.get("CORPUSMILL_CODE_ID"):
        return own
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    git = lambda *a: subprocess.run(["git", "-C", here, *a], capture_output=True, text=True, check=False)
    head = git("rev-parse", "HEAD")
    if head.returncode == 0:
        diff = git("diff", "HEAD", "--", here).stdout
        if diff and strict:
            raise RuntimeError("the code has changes that are not committed")
        return head.stdout.strip() + ("-" + hashlib.sha256(diff.encode()).hexdigest()[:12] if diff else "")
    h = hashlib.sha256()
    for root, _, files in sorted(os.walk(here)):
        for name in sorted(f for f in files if f.endswith(".py")):
            with open(os.path.join(root, name), "rb") as f:
                h.update(f.read())
    return h.hexdigest()


@dataclass
class Stage:
    """name, what it makes of (session, inputs by stage name, configuration), and the stages it reads."""

    name: str
    make: Callable[[SparkSession, dict[str, DataFrame], Config], DataFrame]
    reads: tuple[str, ...] = ()
    by: tuple[str, ...] = ()


class Runner:
    """Runs stages in order under a folder that the driver and the executors share; any file system that Hadoop knows will do."""

    def __init__(self, spark: SparkSession, stages: list[Stage], out: str, config: Config, extra: dict | None = None):
        self.spark, self.stages, self.out, self.config, self.extra = spark, stages, out.rstrip("/"), config, extra or {}
        self.code = code_identity(config.strict)

    def _dir(self, name: str) -> str:
        return f"{self.out}/{name}"

    def manifest(self, name: str) -> dict | None:
        """The manifest of a stage that ended, else None."""
        try:
            return json.loads(read_text(self.spark, f"{self._dir(name)}/manifest.json") or "null")
        except ValueError:
            return None

    def key(self, stage: Stage) -> str:
        """The cache key: stage, schema version, configuration, code, extra inputs and the keys of the stages it reads."""
        parts = [stage.name, SCHEMA_VERSION, json.dumps(asdict(self.config), sort_keys=True), self.code, json.dumps(self.extra, sort_keys=True, default=str)]
        parts += [(self.manifest(r) or {}).get("key", "none") for r in stage.reads]
        return hashlib.sha256("\0".join(parts).encode()).hexdigest()

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir(name)}/data")

    def run(self, force: bool = False) -> dict[str, str]:
        """Of each stage: cached or done. A stage that fails leaves no manifest, and its folder is emptied before the next try."""
        said = {}
        for s in self.stages:
            key = self.key(s)
            if not force and (self.manifest(s.name) or {}).get("key") == key:
                said[s.name] = "cached"
                continue
            remove_path(self.spark, self._dir(s.name))
            began = time.time()
            with scratch():
                w = s.make(self.spark, {r: self.read(r) for r in s.reads}, self.config).write.mode("overwrite")
                (w.partitionBy(*s.by) if s.by else w).parquet(f"{self._dir(s.name)}/data")
            content = {"stage": s.name, "key": key, "status": "SUCCESS", "rows": self.read(s.name).count(), "seconds": round(time.time() - began, 1)}
            write_sidecar(self.spark, f"{self._dir(s.name)}/manifest.json", content)
            said[s.name] = "done"
        return said

    def write_reports(self) -> list[str]:
        """The reports of a run as Markdown files under reports/; their names."""
        folder, rows = f"{self.out}/reports", self.read("reports")
        names = [r[0] for r in rows.select("report").distinct().orderBy("report").collect()]  # a few
        for name in names:
            r = rows.where(F.col("report") == name).select("item", "value").orderBy("item")
            write_text(self.spark, f"{folder}/{name}.md", reports.markdown(r, name, 10_000))
        return names


def _long(df: DataFrame, report: str, key: str | None) -> DataFrame:
    """(report, item, value) of each number of a small report."""
    out = None
    for c in df.columns:
        if c != key:
            item = F.concat_ws(": ", F.coalesce(F.col(key).cast("string"), F.lit("none")), F.lit(c)) if key else F.lit(c)
            part = df.select(F.lit(report).alias("report"), item.alias("item"), F.col(c).cast("string").alias("value"))
            out = part if out is None else out.unionByName(part)
    return out


def corpus_stages(sf_dir: str) -> list[Stage]:
    """From documents to a frozen corpus in two layers with its views, statistics and reports."""
    sources = lambda spark: table(spark, sf_dir, "source_config")

    def ingested(spark, _, c):
        d = table(spark, sf_dir, "documents").withColumn("source", blank_to_null("source")).where("doc_id is not null")
        d = ingest.bounded_scan(d, identity.shares(sources(spark)), c.total_tokens, idx="doc_id", max_records=c.max_records, max_scanned=c.max_scanned, max_oversized=c.max_oversized)
        d = d.where("status in ('balanced', 'probe')")
        return identity.document_identity(d, "doc_id", "text", "source").withColumn("priority", identity.priority(F.coalesce("source", F.lit("")), F.col("doc_id"), seed=c.seed))

    def pool(spark, ins, c):
        return ingest.select_pool(ins["ingest"], identity.quotas(sources(spark), c.total_tokens))

    def clean(spark, ins, _):
        d = normalize.normalize(ins["pool"]).where("rejection is null").drop("rejection")
        d = cleaners.clean_by_source(d, "normalized_text").where("rule is null").drop("rule", "normalized_text", "n_words_clean").withColumnRenamed("cleaned_text", "normalized_text")
        return quality.judge(d, sources(spark), "normalized_text").where("rule is null").drop("rule")

    def segmented(_, ins, c):
        d = segment.segments(ins["clean"], "document_id", "normalized_text", most=c.max_words)
        d = d.drop("text", "normalized_text").withColumnsRenamed({"document_id": "parent_document_id", "segment_id": "document_id", "segment_text": "normalized_text"})
        return d.withColumn("structure", segment.structure(F.col("normalized_text")))

    def unique(_, ins, c):
        d = ins["segments"]
        d = dedup.strip_frequent_paragraphs(d, "document_id", "normalized_text", min_words=c.paragraph_words, min_docs=c.paragraph_documents)
        d = d.where("not too_short").drop("normalized_text", "too_short").withColumnRenamed("stripped_text", "normalized_text")
        near = dedup.near_duplicates(d, "document_id", "normalized_text", c.shingle, c.similarity)
        key = dedup.winner_key(dedup.category_score(F.coalesce("category", F.lit("web"))), F.col("priority"), F.col("document_id"))
        k = d.select("document_id", "parent_document_id", key.alias("k")).join(near, "document_id")
        win = k.groupBy("cluster").agg(F.min("k").alias("k")).select(F.col("k.id").alias("document_id"), F.col("cluster").alias("dedup_cluster_id"))
        # parents whose segments are in one cluster are a family, which one split gets whole
        family = dedup.family_groups(k.select("parent_document_id", "cluster"), "parent_document_id", "cluster").select(F.col("group_id").alias("parent_document_id"), F.col("family").alias("split_group_id"))
        return d.join(win, "document_id").join(family, "parent_document_id").withColumn("structure", segment.structure(F.col("normalized_text")))

    def safe(spark, ins, c):
        log = decontam.contamination_log(ins["unique"], table(spark, sf_dir, "benchmark"), "document_id", "normalized_text", least=c.contamination_overlap)
        return decontam.decontaminated(ins["unique"], log, "document_id", "parent_document_id")

    def split(_, ins, c):
        return ins["safe"].withColumn("split", splits.hash_split(splits.split_group("split_group_id", "parent_document_id", "document_id"), c.shares, c.seed))

    def artifact(spark, _, c):
        return spark.createDataFrame([(c.tokenizer, tokens.file_sha256(c.tokenizer))], "path string, sha256 string")

    def encoded(_, ins, c):
        freeze.same_artifact(recorded=ins["tokenizer"].first()["sha256"], present=tokens.file_sha256(c.tokenizer))
        d = ins["split"]
        return layers.layer_b(d, path=c.tokenizer).join(d.select("document_id", "parent_document_id", "source", "split", "priority"), "document_id")

    def chosen(spark, ins, c):
        sizes = ins["encoded"].select("document_id", "source", "priority", "token_ids")
        return ingest.select_quota(sizes, identity.quotas(sources(spark), c.total_tokens)).select("document_id", "source", "n_taken", "truncated")

    def selected(spark, ins, c):
        """Both layers in one row per document; the last document of each source is cut, its text, hash, ids and spans renewed."""
        cols = ["document_id", "normalized_text", "normalized_text_hash", "token_ids", "token_count", *layers.SPANS]
        pick, d = ins["chosen"], ins["split"]
        whole = d.join(pick.where("not truncated").select("document_id"), "document_id").withColumn("normalized_text_hash", F.sha2("normalized_text", 256)).join(ins["encoded"].select("document_id", "token_ids", "token_count", *layers.SPANS), "document_id")
        cut = layers.truncated(d.select("document_id", "normalized_text").join(broadcast_if_small(pick.where("truncated").select("document_id", "n_taken")), "document_id"), needed="n_taken", path=c.tokenizer)  # one a source
        both = whole.select(*cols).unionByName(cut.select(*cols))
        rest = d.select("document_id", "parent_document_id", "split_group_id", "source", "category", "priority", "dedup_cluster_id", "split")
        return both.withColumn("structure", segment.structure(F.col("normalized_text"))).join(rest, "document_id")

    def frozen(spark, ins, c):
        """(problem, document_id) of documents whose ids are not the encoding of their text, or whose source misses its quota in a strict run."""
        d = ins["selected"]
        again = lambda x, i, t: layers.layer_b(x, i, t, c.tokenizer).select(F.col(i).alias("doc_id"), F.col("token_ids").alias("ids"))
        bad = freeze.reencoded_mismatch(d, d, again).select(F.lit("token_mismatch").alias("problem"), "document_id")
        if bad.limit(1).count():
            raise RuntimeError("the ids of some documents are not the encoding of their text")
        if c.strict:
            got = ingest.quota_deviation(d.withColumn("n_taken", F.col("token_count")), identity.quotas(sources(spark), c.total_tokens), c.tolerance)
            short = [r["source"] for r in got.where("not within").select("source").collect()]  # a row per configured source
            if short:
                raise RuntimeError(f"sources miss their quotas: {short}")
        return d

    def viewed(_, ins, c):
        t = ins["frozen"]
        return views.union(t, c.context)

    def counted(_, ins, c):
        return stats.token_counts(ins["frozen"].where("split = 'train'"), c.vocabulary)

    def reported(spark, ins, c):
        d = ins["frozen"]
        n = lambda x: F.sum(x).cast("long")
        all_ = [
            _long(d.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), n("token_count").alias("tokens")), "sources", "source"),
            _long(reports.by_rule(quality.judge(normalize.normalize(ins["pool"]), sources(spark), "normalized_text")), "quality", "rule"),
            _long(reports.redactions(normalize.normalize(ins["pool"])), "redaction", None),
            _long(ins["segments"].agg(F.count(F.lit(1)).alias("segments")).crossJoin(ins["unique"].agg(F.count(F.lit(1)).alias("retained"))), "deduplication", None),  # one row each
            _long(reports.structure(d), "structure", None),
            _long(reports.token_totals(d), "tokens", None),
            _long(d.groupBy("split").agg(F.count(F.lit(1)).alias("documents"), n("token_count").alias("tokens")), "splits", "split"),
            _long(ins["views"].groupBy("view_type").agg(F.count(F.lit(1)).alias("views")), "views", "view_type"),
            _long(ins["unique"].agg(F.count(F.lit(1)).alias("before")).crossJoin(ins["safe"].agg(F.count(F.lit(1)).alias("after"))), "decontamination", None),  # one row each
        ]
        out = all_[0]
        for r in all_[1:]:
            out = out.unionByName(r)
        return out

    return [
        Stage("ingest", ingested), Stage("pool", pool, ("ingest",)), Stage("clean", clean, ("pool",)), Stage("segments", segmented, ("clean",)),
        Stage("unique", unique, ("segments",)), Stage("safe", safe, ("unique",)), Stage("split", split, ("safe",), ("split",)),
        Stage("tokenizer", artifact), Stage("encoded", encoded, ("split", "tokenizer")), Stage("chosen", chosen, ("encoded",)),
        Stage("selected", selected, ("chosen", "encoded", "split"), ("split",)), Stage("frozen", frozen, ("selected",), ("split",)),
        Stage("views", viewed, ("frozen",), ("view_type", "split")), Stage("counts", counted, ("frozen",)),
        Stage("reports", reported, ("frozen", "pool", "segments", "unique", "safe", "views")),
    ]
