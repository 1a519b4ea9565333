"""Command line: ``run-pipeline`` over all configured seeds, ``enqueue-seed`` into the queue folder of the stream."""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession

from ..config import PipelineConfig
from ..streaming.queue import enqueue
from .pipeline import Pipeline


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siteweave")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run-pipeline", help="crawl, analyze and extract for all configured seeds")
    run.add_argument("--pages", required=True, help="page store (parquet with url and html)")
    run.add_argument("--output", default=None)
    seed = commands.add_parser("enqueue-seed", help="put one seed into the queue")
    seed.add_argument("--seed-url", required=True)
    seed.add_argument("--queue", required=True)
    return top


def main(args: list[str] | None = None) -> int:
    options = parser().parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if options.command == "enqueue-seed":
        enqueue(spark, options.queue, options.seed_url)
        return 0
    config, begin = PipelineConfig.from_env(), time.time()
    Pipeline(spark, config).run(spark.read.parquet(options.pages), output=options.output or config.output_dir)
    print(f"{(time.time() - begin) / 60:.2f} minutes")
    return 0


if __name__ == "__main__":
    sys.exit(main())
