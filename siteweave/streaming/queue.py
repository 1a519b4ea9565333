"""The task queue as a stream: JSON tasks dropped into a folder are read by Structured Streaming and run per micro-batch.

Tasks: crawl_seed, run_pipeline, analyze_listing, scrape_job_links, extract_job_details. A failing task is an error row,
not a lost one. Checkpoints make delivery at least once; a task whose result is there is neither run nor recorded again.
"""

from __future__ import annotations

import hashlib
import json
import traceback
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..operators.frontier import first_by
from ..plans.pipeline import Pipeline
from ..schemas import LISTING_SPEC

TASK = "task_id string, task string, payload string"
#: The queue (scheduler pool) of each task.
POOLS = {"crawl_seed": "crawl", "run_pipeline": "crawl", "analyze_listing": "llm", "scrape_job_links": "playwright", "extract_job_details": "crawl"}


def enqueue(spark: SparkSession, folder: str, seed_url: str | None = None, task: str = "crawl_seed", payload: dict | None = None) -> str:
    """Writes one task file; returns its id."""
    task_id = uuid.uuid4().hex
    body = json.dumps(payload if payload is not None else {"seed_url": seed_url})
    spark.createDataFrame([(task_id, task, body)], TASK).coalesce(1).write.mode("append").json(folder)
    return task_id


class Worker:
    """Runs tasks over a page store and appends one result row per task."""

    def __init__(self, spark: SparkSession, pages: DataFrame, config: PipelineConfig, output: str):
        self.spark, self.pages, self.config, self.output = spark, pages, config, output
        self.tasks: dict[str, Callable[[dict], dict]] = {
            "crawl_seed": self.crawl_seed, "run_pipeline": self.run_pipeline, "analyze_listing": self.analyze_listing,
            "scrape_job_links": self.scrape_job_links, "extract_job_details": self.extract_job_details,
        }

    def run_pipeline(self, payload: dict) -> dict:
        Pipeline(self.spark, self.config).run(self.pages, output=self.output)
        return {"seeds": len(self.config.seeds)}

    def crawl_seed(self, payload: dict) -> dict:
        """The whole pipeline for one seed."""
        run_id = uuid.uuid4().hex
        Pipeline(self.spark, self.config.with_(seed_urls=payload["seed_url"])).run(self.pages, output=self.output, run_id=run_id)
        return {"seed_url": payload["seed_url"], "run_id": run_id}

    def analyze_listing(self, payload: dict) -> dict:
        page = self.spark.createDataFrame([(payload["url"], payload["url"], payload["html"])], "page_key string, url string, html string")
        listing = Pipeline(self.spark, self.config).analyze(page).drop("html", "cache_hit")
        name = hashlib.md5(payload["url"].encode()).hexdigest()
        listing.write.mode("append").json(f"{self.output}/listing_{name}")
        return {"listing": f"listing_{name}"}

    def scrape_job_links(self, payload: dict) -> dict:
        """Links of a listing without its html: only stored pages of a browser session, else its own links."""
        row = self.spark.createDataFrame([(json.dumps(payload),)], "j string").select(F.from_json("j", LISTING_SPEC).alias("s")).select("s.*")
        listing = row.withColumns({"page_key": F.col("careers_url"), "html": F.lit(None).cast("string")})
        key = F.col("url").alias("page_key")
        stored = self.pages.select(key, F.lit(1).alias("page_no"), "html", F.lit(False).alias("next_usable"))
        return {"links": Pipeline(self.spark, self.config).scrape_links(listing, stored).count()}

    def extract_job_details(self, payload: dict) -> dict:
        links = self.spark.createDataFrame([("task", i, "", u) for i, u in enumerate(payload["job_urls"], 1)], "page_key string, pos int, title string, url string")
        return {"job_rows": Pipeline(self.spark, self.config).details(links, self.pages).where("details is not null").count()}

    def run(self, task_id: str, task: str, payload: str) -> tuple[str, str, str, str]:
        self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", POOLS.get(task))
        try:
            return task_id, task, "ok", json.dumps(self.tasks[task](json.loads(payload)))
        except Exception as e:
            return task_id, task, "error", json.dumps({"error": f"{type(e).__name__}: {e}"[:2000], "at": traceback.format_exc()[-2000:]})
        finally:
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    def batch(self, tasks: DataFrame, batch_id: int) -> None:
        """One micro-batch. Tasks are few (they start jobs of their own), so they are listed on the driver, a limited number a batch."""
        schema, path = "task_id string, task string, status string, result string", f"{self.output}/task_results"
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            tasks = tasks.join(self.spark.read.schema(schema).json(path).select("task_id"), "task_id", "left_anti").select("task_id", "task", "payload")
        for row in first_by(tasks, ["task_id"], ["task", "payload"]).collect():
            # each result is recorded before the next task runs, so a batch that fails half-way repeats one task at most
            self.spark.createDataFrame([self.run(*row)], schema).coalesce(1).write.mode("append").json(path)


def start(worker: Worker, folder: str, checkpoint: str, once: bool = False):
    """Starts the stream over the queue folder; with ``once`` it ends when the folder is read."""
    tasks = worker.spark.readStream.schema(TASK).option("maxFilesPerTrigger", 16).json(folder)
    writer = tasks.writeStream.foreachBatch(worker.batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def page_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """New pages by content: a file stream with each body's hash, deduplicated within a day's watermark of arrival."""
    rows = spark.readStream.schema(schema).parquet(folder).withColumn("seen_at", F.current_timestamp())
    return rows.withColumn("content_sha256", F.sha2(F.col("html").cast("binary"), 256)).withWatermark("seen_at", "1 day").dropDuplicatesWithinWatermark(["content_sha256"])
