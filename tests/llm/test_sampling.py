from collections import Counter

from pyspark.sql import functions as F

from corpusmill.llm.sampling import stable_sample, with_place


def frame(spark, n, start=0):
    return spark.range(start, n).select(F.concat(F.md5(F.col("id").cast("string")), F.lit("_seg"), (F.col("id") % 3).cast("string")).alias("document_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("source"), F.lit(1).alias("sample_place"), F.lit("x").alias("rest"))


def ids(df):
    return {tuple(r) for r in df.collect()}


def test_same_in_any_partitioning_and_kept_when_rows_come(spark):
    small, large = stable_sample(frame(spark, 3000), 0.2), stable_sample(frame(spark, 9000).repartition(9), 0.2)
    assert ids(small) == ids(stable_sample(frame(spark, 3000).repartition(5).union(frame(spark, 500)), 0.2))
    assert ids(small) <= ids(large) and ids(stable_sample(frame(spark, 9000), 0.1)) <= ids(large)
    assert 0.17 < len(ids(large)) / 9000 < 0.23
    per = Counter(s for _, s in ids(large))
    assert set(per) == {"a", "b", None} and all(480 < n < 720 for n in per.values())


def test_places_are_a_permutation(spark):
    d = spark.range(20_000).select(F.lower(F.lpad(F.hex("id"), 32, "0")).alias("document_id"), F.lit("s").alias("source"))
    p = [r[0] for r in with_place(d).select("sample_place").collect()]
    assert len(set(p)) == 20_000 and min(p) >= 0 and max(p) < 1 << 62
    tenths = Counter(x * 10 >> 62 for x in p)
    assert all(1850 < n < 2150 for n in tenths.values())


def test_edges(spark):
    d = spark.createDataFrame([(None, "s"), ("not hex", "s"), ("", None), ("not hex", "s")], "document_id string, source string")
    assert ids(stable_sample(d, 1.0)) == {("not hex", "s"), ("", None)}
    assert stable_sample(d, 0.0).count() == 0 and stable_sample(d, -1).count() == 0 and stable_sample(d.limit(0), 1.0).count() == 0
    assert ids(stable_sample(d, {"s": 1.0})) == {("not hex", "s")} and ids(stable_sample(d, {None: 2.0})) == {("", None)}
    assert ids(stable_sample(frame(spark, 2000), 0.3, seed=1)) != ids(stable_sample(frame(spark, 2000), 0.3, seed=2))
