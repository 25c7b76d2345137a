"""

O10  skill matching: offers × 42 patterns as a broadcast nested-loop join with a
     per-pair regex (the reference's plan) vs the literal-unrolled matcher.
O11  company numbering: ROW_NUMBER over a global window (one partition) vs the
     two-level range-partitioned numbering.

Usage: python scripts/compare_strategies.py [sf_dir] [replication]
Inputs derive from ``documents``; ``replication`` repeats every document with
distinct ids to grow the data.  Prints one JSON line per measurement.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from souk.functions.regex import to_java  # noqa: E402
from souk.operators.numbering import global_row_number  # noqa: E402
from souk.operators.skills import match_skills, skill_rows  # noqa: E402
from souk.session import get_spark  # noqa: E402
from souk.sources.offers import offer_texts, read_table  # noqa: E402


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    rep = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    spark = get_spark("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    docs = offer_texts(read_table(spark, sf_dir, "documents")).select("doc_id", F.col("description").alias("text"))
    docs = (docs.select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.lit(rep - 1))).alias("copy"))
            .select((F.col("doc_id") * rep + F.col("copy")).alias("doc_id"), "text")
            .repartition(spark.sparkContext.defaultParallelism).cache())
    n = docs.count()

    skills = spark.createDataFrame([(i, name, cat, to_java(p, True, "pg")) for i, name, p, cat, _ in skill_rows()],
                                   "skill_id bigint, skill_name string, skill_category string, java string")
    naive = (docs.crossJoin(F.broadcast(skills)).filter(F.expr("text rlike java"))
             .select("doc_id", "skill_id"))
    ours = match_skills(docs, "text").select("doc_id", "skill_id")
    rows = {"naive": naive.count(), "ours": ours.count()}
    print(json.dumps({"op": "O10 skill matching", "docs": n, "rows": rows,
                      "nested_loop_sec": timed(naive), "unrolled_sec": timed(ours)}))

    companies = docs.select(F.concat(F.lit("company-"), (F.col("doc_id") % max(n // 2, 1)).cast("string"))
                            .alias("company")).groupBy("company").agg(F.count(F.lit(1)).alias("nb_offers"))
    order = [F.col("nb_offers").desc(), F.col("company")]
    single = companies.withColumn("company_id", F.row_number().over(Window.orderBy(*order)))
    two_level = global_row_number(companies, order, "company_id")
    print(json.dumps({"op": "O11 company numbering", "companies": companies.count(),
                      "single_partition_sec": timed(single), "two_level_sec": timed(two_level),
                      "same_ids": single.join(two_level, ["company", "company_id"]).count() == companies.count()}))


if __name__ == "__main__":
    main()
