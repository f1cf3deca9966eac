"""The driver's contract, stages, sources and streaming."""

import json
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from corpusmill.operators import reports
from corpusmill.plans import stages
from corpusmill.sources import files
from corpusmill.streaming import micro_batches

DATA = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_registries_agree():
    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(o) <= set(q) and len(q) > 80


@there
def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["text_hash", "winner", "copies"] and df.count() > 0


@there
def test_all_core_queries_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from corpusmill.plans.oracle import SQL
    from corpusmill.plans.queries import QUERIES

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")

    def plain(v):
        return round(v, 8) + 0.0 if isinstance(v, float) else v

    for name, f in QUERIES.items():
        df = f(spark, DATA)
        if name not in SQL:
            assert df.columns
            continue
        cols = sorted(df.columns)
        got = sorted(repr([plain(v) for v in r]) for r in df.select(*cols).collect())
        cur = con.execute(f"select {', '.join(cols)} from ({SQL[name]})")
        assert got == sorted(repr([plain(v) for v in r]) for r in cur.fetchall()), name


@there
def test_stages_are_cached_by_what_they_depend_on(spark, tmp_path):
    config = stages.Config(total_tokens=200_000, shares={"validation": 0.1, "test": 0.1})
    todo = stages.corpus_stages(DATA)
    run = stages.Runner(spark, todo, str(tmp_path / "out"), config)
    assert set(run.run().values()) == {"done"} and set(run.run().values()) == {"cached"}
    out = run.read("split")
    assert out.count() > 0 and out.groupBy("parent_document_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert out.groupBy("split_group_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    layer = run.read("frozen")
    assert layer.count() > 0 and layer.where("token_count <> size(token_ids)").count() == 0
    kinds = {r[0] for r in run.read("views").select("view_type").distinct().collect()}
    assert {"causal_packed"} <= kinds and run.read("counts").where("scope is null").count() > 0
    names = run.write_reports()
    assert len(names) == 9 and "tokens" in (tmp_path / "out" / "reports" / "splits.md").read_text()
    os.remove(tmp_path / "out" / "safe" / "manifest.json")
    again = run.run()
    assert again["unique"] == "cached" and again["safe"] == "done"
    config.seed = 7
    assert set(stages.Runner(spark, todo, str(tmp_path / "out"), config).run().values()) == {"done"}
    other = stages.Runner(spark, todo[:1], str(tmp_path / "out"), config, {"x": 1})
    assert other.key(todo[0]) != run.key(todo[0])


@there
def test_command_line(spark, tmp_path, capsys):
    from corpusmill.__main__ import main

    assert main([DATA, str(tmp_path / "o"), "--scale", "many"]) == 1
    assert main([DATA, str(tmp_path / "o"), "--scale", "300K", "--max-records", "30"]) == 0
    said = capsys.readouterr().out
    assert "frozen: done" in said and "reports:" in said


def test_config(tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"seed": 1, "total_tokens": 5}))
    c = stages.Config.load(str(p), "2B")
    assert c.seed == 1 and c.total_tokens == 2_000_000_000 and c.strict and stages.code_identity()


def test_shards(spark, tmp_path):
    df = spark.createDataFrame([("a", "t1", 1), ("b", "t2", 2), ("c", None, 3)], "doc_id string, text string, val long").coalesce(1)
    files.write_shards(df, str(tmp_path / "x"), rows=2)
    back = files.read_records(spark, str(tmp_path / "x"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect())) and files.shards(back).count() == 2
    files.write_shards(df, str(tmp_path / "y"), by=["val"])
    assert os.path.isdir(tmp_path / "y" / "val=2")
    raw = files.raw_records(spark.createDataFrame([("", "c", None), ("t", None, "7")], "text string, content string, id string"), "repo").collect()
    assert [r["text"] for r in raw] == ["c", "t"] and raw[1]["doc_id"] == "7" and raw[0]["doc_id"].startswith("repo_")
    assert files.dense_array(spark.createDataFrame([(1, 0.5)], "token_id int, log_p float"), 3)[1] == 0.5
    files.write_rows_json(df, str(tmp_path / "log"))
    assert files.read_records(spark, str(tmp_path / "log"), df.schema, "json", limit=2).count() == 2
    assert "| a | t1 | 1 |" in reports.markdown(df, "T")


@there
def test_streams(spark, tmp_path):
    src = spark.read.parquet(f"{DATA}/documents.parquet")
    config = spark.read.parquet(f"{DATA}/source_config.parquet")
    src.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = micro_batches.stream_records(spark, str(tmp_path / "in"), src.schema, 1)
    q = micro_batches.write_cleaned(stream, config, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    want = micro_batches.cleaned(src, config)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert {r[0] for r in got.select("doc_id").collect()} == {r[0] for r in want.select("doc_id").collect()}
    q = micro_batches.source_windows(stream, "created_at").writeStream.format("memory").queryName("win").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("win").agg(F.sum("n_docs")).first()[0] == src.where("created_at is not null").count()
    q = micro_batches.quota_stream(stream, 300).writeStream.format("memory").queryName("quota").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert 0 < spark.table("quota").count() <= src.count()


def test_documents_without_a_split_count(spark, tmp_path):
    from corpusmill.plans.queries import QUERIES

    span = "array(named_struct('start', 0, 'end', 2)) as paragraph_token_spans"
    rows = [("a", "train", 3), ("b", None, 5), ("c", " ", 7), ("d", "val", 11), ("e", None, 13), ("e", "test", 13)]
    t = spark.createDataFrame(rows, "document_id string, split string, n int").selectExpr("document_id", "'p' as parent_document_id", "'s' as source", "split", "array_repeat(1, n) as token_ids", span)
    t.write.parquet(str(tmp_path / "tokenized_docs.parquet"))
    spark.sql("select 's' as name, 1.0D as share, 3000000000L as quota_3b_tokens").write.parquet(str(tmp_path / "source_config.parquet"))
    get = lambda name: [tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()]
    spark.sql("select 'train' as split, 1.0D as share").write.parquet(str(tmp_path / "split_config.parquet"))
    assert get("report_tokenizer")[0][:2] == (5, 39)
    assert sorted(r[:3] for r in get("report_split")) == [("none", 2, 12), ("test", 1, 13), ("train", 1, 3), ("validation", 1, 11)]
    assert {r[0] for r in get("trim_spans")} == set("abcde") == {r[0] for r in get("quota_select")}
    assert len(get("quota_tolerance")) == 1
