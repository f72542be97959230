"""Command line: inspect, run, baseline, run-all, extract-images, evaluate, compare-tables."""

from __future__ import annotations

import argparse
import importlib
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

COMMANDS = {
    "inspect": ["source"], "run": ["docs", "items", "output"], "baseline": ["source", "output"], "run-all": ["source", "output"], "extract-images": ["source", "output"],
    "evaluate": ["documents"], "compare-tables": ["output"],
}
FROM_SOURCES = ("baseline", "run-all", "extract-images")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="docstrata")
    sub = p.add_subparsers(dest="command", required=True)
    for name, args in COMMANDS.items():
        s = sub.add_parser(name)
        for a in args:
            s.add_argument(a)
        s.add_argument("--config")
        if name in FROM_SOURCES:
            s.add_argument("--converter", required=True, metavar="MODULE:FUNCTION", help="called with path, content and options of each file")
        if name == "compare-tables":
            s.add_argument("--run", action="append", required=True, metavar="NAME=INDEX_JSON")
    a = p.parse_args(argv)
    source = getattr(a, "source", None)
    if source and "://" not in source and not any(c in source for c in "*?[{") and not os.path.exists(source):
        p.error(f"no such file: {source}")
    from docstrata.config import Config
    from docstrata.operators import tables
    from docstrata.plans import pipeline
    from docstrata.sources import export, readers

    spark = SparkSession.builder.appName("docstrata").getOrCreate()
    config = Config.from_yaml(a.config) if a.config else Config()
    if a.command == "inspect":
        readers.inspect(spark, a.source).show(truncate=False)
    elif a.command in FROM_SOURCES:
        module, _, name = a.converter.partition(":")
        result, folders = pipeline.run_sources(spark, a.source, getattr(importlib.import_module(module), name), a.output, config)
        for folder in folders:
            print(os.path.join(folder, "images") if a.command == "extract-images" else folder)
    elif a.command == "run":
        r = pipeline.run(spark.read.parquet(a.docs), spark.read.parquet(a.items), config)
        for name in ("elements", "children", "roots", "chunks", "findings", "report"):
            export.store(getattr(r, name), f"{a.output}/{name}")
        r.manifest.write.mode("overwrite").json(f"{a.output}/manifest")
    elif a.command == "evaluate":
        report = pipeline.evaluate(readers.documents(spark, a.documents), config)
        report.show(truncate=False)
        return int(not report.where(~F.col("passed")).isEmpty())
    else:
        runs = {name: readers.table_index(spark, [path]) for name, path in (x.split("=", 1) for x in a.run)}
        tables.compare(runs).orderBy("table_id", "run").write.mode("overwrite").json(a.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
