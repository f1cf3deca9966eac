"""The record-local operators over a stream of files, and a stateful host quota over the stream.

A file source brings new records; each micro-batch goes through normalisation and the quality rules, which need
no state. Deduplication and splits need the whole corpus and stay in batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusmill.functions.text import word_count
from corpusmill.operators import normalize, quality


def stream_records(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream; the schema is stated, never inferred."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def cleaned(stream: DataFrame, config: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """Accepted records with normalized_text, category and metrics; the configuration is a static table."""
    out = normalize.normalize(stream, text).where("rejection is null")
    return quality.judge(out, config, "normalized_text", source).where("rule is null").drop("rule", "rejection")


def write_cleaned(stream: DataFrame, config: DataFrame, out: str, checkpoint: str, text: str = "text", once: bool = True) -> StreamingQuery:
    """Appends the accepted records to Parquet, exactly once per input file; once=True handles what is there and ends."""
    w = cleaned(stream, config, text).writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def source_windows(stream: DataFrame, time: str, window: str = "1 day", late: str = "7 days", source: str = "source", text: str = "text") -> DataFrame:
    """(source, start, n_docs, n_words) per source and time window; records later than the watermark are dropped."""
    d = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, window), source).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(word_count(text)).alias("n_words"))
    return d.select(source, F.col("window.start").alias("start"), "n_docs", "n_words")


def quota_stream(stream: DataFrame, cap: int, key: str = "site", id_col: str = "doc_id", text: str = "text", parts: int = 1) -> DataFrame:
    """(key, id, n_words) of the records of each key until their words reach cap; the total is kept as state.

    Records of one micro-batch count in the order of their ids. With parts > 1 a key is divided by a hash of the id into
    as many states of cap / parts each, so a key with a third of all records is no single task.
    """
    part = F.pmod(F.xxhash64(id_col), F.lit(parts)).cast("int")
    d = stream.select(F.col(key).alias("k"), F.col(id_col).cast("long").alias("id"), word_count(text).cast("long").alias("n_words"), part.alias("part"))
    share = cap / parts

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values("id")
        keep = []
        for n in rows["n_words"]:
            keep.append(total < share)
            total += int(n) if keep[-1] else 0
        state.update((total,))
        yield rows.loc[keep, ["k", "id", "n_words"]]

    return d.groupBy("k", "part").applyInPandasWithState(step, "k string, id long, n_words long", "total long", "append", GroupStateTimeout.NoTimeout)
