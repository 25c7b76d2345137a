"""Physical-plan assertions for the scale-critical operators."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from souk.plans import gold, registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unified_has_one_exchange_with_partial_window_limit(spark):
    p = plan(registry.unified(spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning(url") == 1
    assert "Partial" in p and "WindowGroupLimit" in p


def test_dimension_scans_prune_text(spark):
    p = plan(gold.dim_contract(registry.unified(spark, SF_SMALL)))
    assert "text:string" not in p


def test_company_numbering_has_no_single_partition_data_exchange(spark, monkeypatch):
    """The plan below the checkpoint too: what global_row_number tags and writes."""
    from souk.operators import numbering
    seen = []
    write = type(spark.range(1)).checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda df, eager=True: seen.append(plan(df)) or write(df, eager))
    below = numbering.global_row_number(registry.unified(spark, SF_SMALL).groupBy("company").count(), [F.col("company")], "n")
    p = plan(gold.dim_company(registry.unified(spark, SF_SMALL)))
    assert len(seen) == 2 and below.count() > 0
    for tagged in seen:
        assert "rangepartitioning" in tagged and "SinglePartition" not in tagged
        # the only row number is silver's, within a url
        windows = [x for x in tagged.splitlines() if "row_number()" in x]
        assert windows and all("[url#" in x for x in windows)
    # above it, the only SinglePartition exchange carries one count per partition
    assert "row_number()" not in p and p.count("SinglePartition") <= 1


def test_skills_are_matched_below_all_joins(spark):
    jobs = registry.unified(spark, SF_SMALL)
    p = plan(gold.offer_skills(jobs))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p and "Generate" in p
    assert p.count("Exchange") == plan(jobs).count("Exchange")  # none but those of silver


def test_ids_are_resolved_without_texts(spark):
    jobs = registry.narrow(spark, SF_SMALL)
    dims = registry.dimensions(spark, jobs, "dim_source", "dim_date", *registry.DIMENSIONS)
    p = plan(gold.fact_ids(jobs, dims))
    assert "description#" not in p and "summary#" not in p and "job_title#" not in p
    assert p.count("BroadcastExchange") >= 4 and "NestedLoopJoin" not in p
    whole = plan(gold.fct_jobs(spark, registry.unified(spark, SF_SMALL), dims, narrow=jobs))
    # texts are dealt out by url once, in silver; the fact adds no exchange of them
    assert whole.count("Exchange hashpartitioning(url") == 1


def test_null_keys_do_not_meet_in_one_task(spark):
    jobs = registry.narrow(spark, SF_SMALL).withColumn("company", F.lit(None).cast("string"))
    dims = registry.dimensions(spark, jobs, "dim_company")
    got = gold.fact_ids(jobs, dims)
    assert got.filter("company_id IS NOT NULL").count() == 0 and got.count() == jobs.count()
    assert jobs.select(gold._spread(F.col("company"))).distinct().count() == jobs.count()
