"""End-to-end pipeline on a replicated copy of ``documents``.

Usage: python scripts/scale_run.py <sf_dir> <replication> <scratch_dir> [--skew]
Writes ``<scratch>/documents.parquet`` (each document repeated with new ids,
whole texts) once, then runs ``build_all`` into ``<scratch>/out-<n>`` and prints
one JSON line with the row counts and wall-clock seconds.  ``--skew`` gives
a third of all offers one shared url (re-captures of one offer) and another
third one shared company.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from souk.plans.pipeline import build_all  # noqa: E402
from souk.session import get_spark  # noqa: E402
from souk.sources.offers import offers_from_documents  # noqa: E402


def main() -> None:
    sf_dir, rep, scratch = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    skew = "--skew" in sys.argv
    spark = get_spark("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
                                            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints")})
    copy = os.path.join(scratch, f"documents-x{rep}")
    if not os.path.exists(copy):
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        (docs.select("*", F.explode(F.sequence(F.lit(0), F.lit(rep - 1))).alias("copy"))
         .select((F.col("doc_id") * rep + F.col("copy")).alias("doc_id"), "text", "lang", "source", "n_chars")
         .repartition(8 * 4).write.parquet(os.path.join(copy, "documents.parquet")))
    n_docs = spark.read.parquet(os.path.join(copy, "documents.parquet")).count()
    out = os.path.join(scratch, f"out-x{rep}-{int(time.time())}")
    t0 = time.perf_counter()
    bronze = offers_from_documents(spark.read.parquet(os.path.join(copy, "documents.parquet")))
    if skew:
        bronze = (offers_from_documents(spark.read.parquet(os.path.join(copy, "documents.parquet")), keep_id=True)
                  .withColumn("url", F.when(F.col("doc_id") % 3 == 0, F.lit("https://rekrute.example/offre-hot"))
                              .otherwise(F.col("url")))
                  .withColumn("company", F.when(F.col("doc_id") % 3 == 1, F.lit("Hot Company"))
                              .otherwise(F.col("company")))
                  .drop("doc_id"))
    paths = build_all(spark, bronze, out, asof="2026-04-26")
    seconds = round(time.perf_counter() - t0, 2)
    counts = {k: spark.read.parquet(v).count() for k, v in paths.items()
              if k in ("jobs_unified", "dim_city", "dim_company", "fct_jobs", "bridge_job_skill")}
    mb = round(sum(f.stat().st_size for f in os.scandir(os.path.join(copy, "documents.parquet"))
                   if f.is_file()) / 1e6, 1)
    print(json.dumps({"documents": n_docs, "documents_mb": mb, "skew": skew, "build_all_sec": seconds,
                      "rows": counts}))


if __name__ == "__main__":
    main()
