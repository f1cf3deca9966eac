"""Runs the pipeline: python -m corpusmill INPUT OUTPUT [options]. INPUT holds documents, source_config and benchmark as Parquet."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from corpusmill.operators.identity import parse_count
from corpusmill.plans.stages import Config, Runner, corpus_stages


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="corpusmill", description="Builds a corpus from documents to views and reports.")
    p.add_argument("input", help="folder of the input tables")
    p.add_argument("output", help="folder of the results, shared by driver and executors")
    p.add_argument("--config", help="JSON file of settings")
    p.add_argument("--scale", help="tokens in all, such as 50M or 3B")
    p.add_argument("--max-records", type=int, help="most records per source")
    p.add_argument("--max-scanned", type=int, help="most records scanned per source")
    p.add_argument("--max-oversized", type=int, help="oversized records in a row that end a source's scan")
    p.add_argument("--force", action="store_true", help="run stages again that are done")
    a = p.parse_args(argv)
    try:
        config = Config.load(a.config, a.scale) if a.config else Config()
        if a.scale and not a.config:
            config.total_tokens = parse_count(a.scale)
    except (ValueError, TypeError, OSError) as e:
        print(f"corpusmill: {e}", file=sys.stderr)
        return 1
    for name in ("max_records", "max_scanned", "max_oversized"):
        if getattr(a, name) is not None:
            setattr(config, name, getattr(a, name))
    spark = SparkSession.builder.appName("corpusmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run = Runner(spark, corpus_stages(a.input), a.output, config)
    for name, state in run.run(a.force).items():
        print(f"{name}: {state}, {(run.manifest(name) or {}).get('rows')} rows")
    print("reports:", ", ".join(run.write_reports()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
