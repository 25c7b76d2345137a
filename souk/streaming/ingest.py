"""Incremental bronze loads with Structured Streaming (S6 as a stream).

The reference appends each collector run to its raw table.  Here newly
captured pages are a file stream: every micro-batch runs the same record
builder as the batch path and appends the records to the platform's raw
table (empty batches write nothing, X26).  The checkpoint records which page
files were consumed, so a restarted or retried run appends each page exactly
once — a batch replayed after a failure overwrites its own ``batch_id``
directory — and ``trigger(availableNow=True)`` processes what is there and stops —
a scheduled run, like the reference's manual DAG trigger.

A run reads all pages that are there (there is no limit on files a
micro-batch): an offer's list page and detail page must arrive together, as
the collectors fetch both in one run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from souk.plans.pipeline import load_pages
from souk.sources.schemas import CAPTURED_PAGES_DDL


def ingest_pages(spark: SparkSession, pages_dir: str, out_dir: str, platform: str, checkpoint: str):
    """Start (and return) a stream: captured pages under ``pages_dir`` ->
    ``<out_dir>/bronze/<platform>_raw``."""
    pages = spark.readStream.schema(CAPTURED_PAGES_DDL).parquet(pages_dir)

    def load(batch: DataFrame, batch_id: int) -> None:
        # the micro-batch id names the output directory: a replayed batch
        # overwrites its own rows (exactly-once with the checkpoint)
        load_pages(batch, out_dir, platform, batch_id=f"stream-{batch_id:08d}")

    return (pages.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
