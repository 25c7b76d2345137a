"""End-to-end pipeline invariants, sinks, streaming ingest and numbering."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from souk.operators.numbering import global_row_number
from souk.plans import gold, pipeline, silver
from souk.sources.offers import bronze_table, read_table


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("warehouse"))
    bronze = {p: bronze_table(spark, SF_SMALL, p) for p in ("rekrute", "dreamjob", "indeed", "linkedin")}
    paths = pipeline.build_all(spark, bronze, out, asof="2026-04-26")
    return out, {k: spark.read.parquet(v) for k, v in paths.items()}, bronze


def test_tables_and_fixed_sizes(built):
    _, t, _ = built
    assert t["dim_source"].count() == 4 and t["dim_skill"].count() == 42
    # the calendar has the fixed range at least, and every day with a capture
    days = t["jobs_unified"].select(F.to_date("scraped_at").alias("full_date")).dropna().distinct()
    assert t["dim_date"].count() > 1096 and days.join(t["dim_date"], "full_date", "left_anti").count() == 0
    assert t["fct_jobs"].filter("scraped_date_id IS NULL AND scraped_at IS NOT NULL").count() == 0
    assert t["dim_skill"].select("skill_category").distinct().count() == 11


def test_union_and_dedup_counts(spark, built):
    _, t, bronze = built
    staged = [silver.stage(df, p) for p, df in bronze.items()]
    assert silver.union_staged(staged).count() == sum(s.count() for s in staged)
    assert t["jobs_unified"].count() == t["jobs_unified"].select("url").distinct().count()


def test_keys_unique_and_score_bounds(built):
    _, t, _ = built
    for dim, key in [("dim_city", "city_id"), ("dim_company", "company_id"), ("dim_company", "company"),
                     ("dim_contract", "contract_id"), ("dim_education", "education_normalized"),
                     ("dim_experience", "experience_normalized"), ("dim_skill", "skill_name"), ("dim_date", "date_id")]:
        assert t[dim].groupBy(key).count().filter("count > 1").count() == 0, (dim, key)
    f = t["fct_jobs"]
    assert f.filter((F.col("quality_score") < 0) | (F.col("quality_score") > 100)).count() == 0
    # company ids follow (nb_offers desc, company)
    ranked = t["dim_company"].withColumn("rn", F.row_number().over(Window.orderBy(F.desc("nb_offers"), "company")))
    assert ranked.filter(F.col("rn") != F.col("company_id")).count() == 0


def test_grain_safe_fact_has_one_row_per_offer(spark, built):
    out, t, _ = built
    jobs = t["jobs_unified"]
    dims = {k: v for k, v in t.items() if k.startswith("dim_")}
    fact = gold.fct_jobs(spark, jobs, dims, grain_safe=True)
    assert fact.count() == jobs.count()
    assert gold.fct_jobs(spark, jobs, dims).count() >= jobs.count()  # T1 fan-out by default


def test_written_copies_go_when_a_load_ends(spark, tmp_path):
    import os
    from souk.session import checkpoint_dir
    from souk.sources.pages import captured_pages
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    pages = captured_pages(read_table(spark, SF_SMALL, "documents"), "indeed")
    broken = pages.withColumn("html", F.when(F.col("page_id") % 5 != 2, F.col("html")))
    assert pipeline.load_pages(broken, str(tmp_path), "indeed", "b")
    assert set(os.listdir(folder)) == before
    lost = spark.read.parquet(str(tmp_path / "bronze" / "indeed_errors"))
    assert lost.count() == broken.filter("html IS NULL").count() > 0
    assert not pipeline.load_pages(pages.filter("false"), str(tmp_path / "none"), "indeed", "b")
    assert not os.path.exists(tmp_path / "none" / "bronze" / "indeed_raw" / "batch_id=b")


def test_no_private_checkpoint_folder_on_a_cluster():
    from types import SimpleNamespace as N
    from souk.session import checkpoint_dir

    def session(master, folder=None):
        made = []
        sc = N(master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append,
               getConf=lambda: N(get=lambda k, d=None: folder))
        return N(sparkContext=sc, conf=N(get=lambda k, d=None: folder))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session("yarn"))
    assert checkpoint_dir(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert "souk-ckpt-" in checkpoint_dir(session("local[2]"))


def test_named_tables(spark, tmp_path):
    bronze = {"indeed": bronze_table(spark, SF_SMALL, "indeed")}
    paths = pipeline.build_all(spark, bronze, str(tmp_path), register=True)
    assert spark.table("gold.fct_jobs").count() == spark.read.parquet(paths["fct_jobs"]).count() > 0
    assert spark.table("silver.jobs_unified").count() > 0
    assert sum(r["nb_raw_variants"] for r in spark.table("gold.dim_city").collect()) == spark.table("gold.city_variants").count()


def test_stored_text_is_whole_unless_asked(spark):
    from souk.operators.pages import indeed_records
    from souk.sources.pages import captured_pages
    pages = captured_pages(read_table(spark, SF_SMALL, "documents"), "indeed")
    longest = lambda df: df.agg(F.max(F.length("description"))).first()[0]
    assert longest(indeed_records(pages)) > 5000 and longest(indeed_records(pages, max_chars=5000)) == 5000


def test_schema_read_and_views(spark, built, tmp_path):
    raw = bronze_table(spark, SF_SMALL, "linkedin")
    assert pipeline.append_bronze(raw, str(tmp_path), "linkedin")
    back = pipeline.read_bronze(spark, str(tmp_path), "linkedin")
    assert back.count() == raw.count() and "job_id" in back.columns
    pipeline.register_staging_views({"linkedin": raw})
    assert spark.table("stg_linkedin").count() == silver.stage(raw, "linkedin").count()


def test_layer_namespaces(spark, tmp_path):
    pipeline.create_layers(spark, str(tmp_path))
    names = {d.name for d in spark.catalog.listDatabases()}
    assert {"bronze", "silver", "gold"} <= names
    assert pipeline.layer_path("/x", "platinum", "t") == "/x/platinum/t"  # a model's own name, verbatim
    assert pipeline.layer_path("/x", None, "t", target="dev") == "/x/dev/t"  # else the target's


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("a"), F.col("id").alias("b"))
    got = global_row_number(df, [F.col("a").desc(), F.col("b")], "rn", partitions=7)
    want = df.withColumn("want", F.row_number().over(Window.orderBy(F.col("a").desc(), F.col("b"))))
    joined = got.join(want, ["a", "b"])
    assert joined.count() == 5000 and joined.filter(F.col("rn") != F.col("want")).count() == 0


def test_streaming_ingest_matches_batch(spark, tmp_path):
    from souk.operators.pages import RECORD_BUILDERS
    from souk.sources.pages import captured_pages
    from souk.streaming.ingest import ingest_pages
    pages = captured_pages(read_table(spark, SF_SMALL, "documents"), "indeed")
    src = str(tmp_path / "pages")
    pages.write.parquet(src)
    q = ingest_pages(spark, src, str(tmp_path / "wh"), "indeed", str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "wh" / "bronze" / "indeed_raw"))
    assert got.count() == RECORD_BUILDERS["indeed"](spark.read.parquet(src)).count() > 0
    q2 = ingest_pages(spark, src, str(tmp_path / "wh"), "indeed", str(tmp_path / "ckpt"))  # nothing new
    q2.awaitTermination(300)
    assert spark.read.parquet(str(tmp_path / "wh" / "bronze" / "indeed_raw")).count() == got.count()


def test_global_row_number_after_shuffle(spark):
    """Input straight out of an aggregation (row order not fixed) — ids must
    still equal the single-partition window's."""
    base = spark.range(0, 20000).select((F.col("id") % 7000).alias("k"))
    agg = base.groupBy(F.concat(F.lit("c-"), F.col("k").cast("string")).alias("company")).agg(
        F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("company")]
    got = {r.company: r.rid for r in global_row_number(agg, order, "rid", partitions=6).collect()}
    want = {r.company: r.rid for r in agg.withColumn("rid", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == want


def test_grain_safe_dimensions(spark, built):
    _, t, _ = built
    jobs = t["jobs_unified"]
    for dim, key in ((gold.dim_city(jobs, grain_safe=True), "city_normalized"),
                     (gold.dim_contract(jobs, grain_safe=True), "contract_normalized")):
        assert dim.groupBy(key).count().filter("count > 1").count() == 0


def test_bronze_batches_are_idempotent(spark, tmp_path):
    raw = bronze_table(spark, SF_SMALL, "indeed")
    n = raw.count()
    assert pipeline.append_bronze(raw, str(tmp_path), "indeed", batch_id="b1")
    assert pipeline.append_bronze(raw, str(tmp_path), "indeed", batch_id="b1")  # replay: replaced
    assert pipeline.append_bronze(raw, str(tmp_path), "indeed")                # new run: appended
    back = pipeline.read_bronze(spark, str(tmp_path), "indeed")
    assert back.count() == 2 * n and back.select("batch_id").distinct().count() == 2


def test_cli_pages_to_gold(spark, tmp_path):
    from souk.__main__ import main
    from souk.sources.pages import captured_pages
    docs = read_table(spark, SF_SMALL, "documents")
    for p in ("rekrute", "dreamjob", "indeed", "linkedin"):
        captured_pages(docs, p).write.parquet(str(tmp_path / f"pages-{p}"))
        main(["extract", str(tmp_path / f"pages-{p}"), str(tmp_path / "wh"), p])
    main(["build", str(tmp_path / "wh"), "--asof", "2026-04-26", "--grain-safe"])
    unified = pipeline.read_table(spark, str(tmp_path / "wh"), "silver", "jobs_unified").count()
    assert pipeline.read_table(spark, str(tmp_path / "wh"), "gold", "fct_jobs").count() == unified > 0


def test_raw_table_contract(spark):
    bad = spark.createDataFrame([("t", "u")], "job_title string, url string")
    with pytest.raises(ValueError, match="lacks columns"):
        silver.stage(bad, "rekrute")


def test_cli_build_with_one_platform(spark, tmp_path):
    from souk.__main__ import main
    pipeline.append_bronze(bronze_table(spark, SF_SMALL, "indeed"), str(tmp_path), "indeed")
    main(["build", str(tmp_path)])
    assert pipeline.read_table(spark, str(tmp_path), "gold", "fct_jobs").count() > 0


def test_layer_column_contracts(spark, built):
    from souk.sources.schemas import FACT_COLUMNS, UNIFIED_COLUMNS, CAPTURED_PAGES_DDL
    from souk.sources.pages import captured_pages
    _, t, _ = built
    assert t["jobs_unified"].columns == UNIFIED_COLUMNS
    assert t["fct_jobs"].columns == FACT_COLUMNS
    pages = captured_pages(read_table(spark, SF_SMALL, "documents"), "indeed")
    assert pages.schema.simpleString() == spark.createDataFrame([], CAPTURED_PAGES_DDL).schema.simpleString()


def test_rows_without_a_capture_time_are_appended(spark):
    from souk.plans.registry import q_bronze_appended
    raw = bronze_table(spark, SF_SMALL, "linkedin")
    rows = q_bronze_appended(spark, SF_SMALL).collect()
    none = raw.where("scraped_at is null").count()
    assert none and {r["batch_id"]: r["n_rows"] for r in rows if r["capture_date"] is None} == {"b": none}
    assert sum(r["n_rows"] for r in rows) == raw.count()


def test_failed_build_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    bronze, out = {"indeed": bronze_table(spark, SF_SMALL, "indeed")}, str(tmp_path)
    pipeline.build_all(spark, bronze, out, asof="2026-04-26", register=True, prefix="kept_", grain_safe=True)
    n = pipeline.read_table(spark, out, "gold", "fct_jobs").count()
    fewer = {"indeed": bronze["indeed"].limit(5)}
    with monkeypatch.context() as m:
        m.setattr(gold, "dim_contract", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.build_all(spark, fewer, out, asof="2026-04-26", register=True, version="v2", prefix="kept_", grain_safe=True)
    # nothing of the failed build shows, by path or by name
    assert pipeline.read_table(spark, out, "gold", "fct_jobs").count() == n == spark.table("kept_gold.fct_jobs").count()
    assert pipeline.read_table(spark, out, "silver", "jobs_unified").count() == n
    assert pipeline.path_exists(spark, f"{out}/gold/dim_city/v2/_SUCCESS")

    # taken up again: what it had finished isn't built again
    def never(*a, **k):
        raise AssertionError("built again")
    with monkeypatch.context() as m:
        m.setattr(gold, "dim_city", never)
        m.setattr(silver, "jobs_unified", never)
        paths = pipeline.build_all(spark, fewer, out, asof="2026-04-26", register=True, version="v2", prefix="kept_", grain_safe=True)
    assert 0 < pipeline.read_table(spark, out, "gold", "fct_jobs").count() == spark.table("kept_gold.fct_jobs").count() <= 5 < n
    assert paths["dim_city"].endswith("/v2") and pipeline.current_version(spark, out, "gold", "dim_city") == "v2"


def test_old_versions_go(spark, tmp_path):
    import os
    for n in (3, 2, 1):
        pipeline.write_table(spark.range(n), str(tmp_path), "gold", "t")
    assert pipeline.read_table(spark, str(tmp_path), "gold", "t").count() == 1
    assert len([f for f in os.listdir(tmp_path / "gold" / "t") if f.startswith("v")]) == 2  # the last two
    with pytest.raises(FileNotFoundError):
        pipeline.read_table(spark, str(tmp_path), "gold", "none")


def test_a_day_with_most_rows_is_split(spark, tmp_path):
    import glob
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    rows = spark.range(0, 40000, numPartitions=40).select(  # a day splits at the map tasks
        F.concat(F.lit("u"), "id").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("job_title"),
        F.when(F.col("id") % 10 > 0, F.lit("2026-01-01")).otherwise(F.concat(F.lit("2026-02-0"), ((F.col("id") / 10).cast("int") % 9 + 1).cast("string"))).cast("timestamp_ntz").alias("scraped_at"))
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        pipeline.append_bronze(rows, str(tmp_path), "indeed", batch_id="b")
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files = glob.glob(str(tmp_path / "bronze/indeed_raw/batch_id=b/capture_date=2026-01-01/*.parquet"))
    assert len(files) > 8
    assert spark.read.parquet(str(tmp_path / "bronze/indeed_raw")).count() == 40000


def test_written_order(spark, tmp_path):
    rows = spark.range(0, 5000).select((F.col("id") * 7919 % 997).alias("a"), (F.col("id") % 13).alias("b"))
    path = pipeline.write_table(rows, str(tmp_path), "gold", "t", sort_by=["a", "b"])
    assert tuple(pipeline.order_violations(spark, path, ["a", "b"]).first()) == (5000, 0)
    assert pipeline.order_violations(spark, path, ["b", "a"]).first()["n_violations"] > 0
    mixed = pipeline.write_table(rows, str(tmp_path), "gold", "u")
    assert pipeline.order_violations(spark, mixed, ["a", "b"]).first()["n_violations"] > 0


def test_scores_of_shared_ids_meet_in_pairs(spark):
    flags = ["has_company", "has_city", "has_function", "has_contract", "has_sector", "has_education", "has_experience"]
    jobs = spark.range(0, 900).select(
        F.concat(F.lit("u"), "id").alias("url"), F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit("two"))
        .when(F.col("id") == 2, F.lit(None)).otherwise(F.concat(F.lit("j"), "id")).alias("job_id"),
        *[(F.col("id") % (k + 2) == 0).cast("int").alias(f) for k, f in enumerate(flags)], F.col("id").cast("int").alias("description_length"))
    jobs = jobs.repartition(4).cache()
    scores = jobs.select("job_id", gold.quality_score().alias("s"))
    got = gold.score_pairs(jobs, jobs).select("url", "job_id", "quality_score")
    want = jobs.join(scores, "job_id", "left").select("url", "job_id", F.col("s").alias("quality_score"))
    assert got.count() == want.count() > 300 * 300
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # rows of the hot id come out of several tasks
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = gold.score_pairs(jobs, jobs).where("job_id = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 1


def test_windowed_scan_prunes_folders(spark, tmp_path):
    from souk.plans.registry import captured_by_quarter
    pipeline.append_bronze(bronze_table(spark, SF_SMALL, "linkedin"), str(tmp_path), "linkedin", batch_id="a")
    df = captured_by_quarter(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "2025-01-01" in filters and "dynamicpruning" in plan
    assert {r.year_quarter for r in df.collect()} <= {"2025-Q1", "2025-Q3"}


def test_merged_loads_equal_one_build(spark, tmp_path):
    import os
    staged = silver.stage(bronze_table(spark, SF_SMALL, "indeed"), "indeed")
    first, second = staged.where("length(job_title) % 2 = 0"), staged.where("length(job_title) % 2 = 1")
    newer = first.orderBy("url").limit(3).withColumn("scraped_at", F.expr("timestamp_ntz'2030-01-01 00:00:00'"))
    older = first.orderBy("url").limit(3).withColumn("scraped_at", F.expr("timestamp_ntz'1990-01-01 00:00:00'"))
    out = str(tmp_path)

    def files():
        top = tmp_path / "silver" / "jobs_merged"
        return {p.name: sorted((f, os.stat(p / f).st_mtime_ns) for f in os.listdir(p)) for p in top.iterdir() if p.is_dir()}
    pipeline.merge_unified(spark, first, out, parts=16)
    pipeline.merge_unified(spark, second.unionByName(older), out, parts=16)
    before = files()
    merged = pipeline.merge_unified(spark, newer, out, parts=16)
    whole = silver.jobs_unified(staged.unionByName(older).unionByName(newer))
    assert merged.count() == whole.count() and merged.exceptAll(whole.select(*merged.columns)).count() == 0
    touched = {f"url_part={r[0]}" for r in newer.select(F.pmod(F.xxhash64("url"), F.lit(16))).distinct().collect()}
    after = files()
    assert {k for k in after if after[k] != before.get(k)} <= touched and len(touched) < len(after)


def test_bucketed_join_shuffles_nothing(spark, tmp_path):
    rows = spark.range(0, 3000).select("id", F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 7 == 0, F.lit(None))
                                       .otherwise(F.concat(F.lit("c"), F.col("id") % 400)).alias("company"))
    dim = spark.range(0, 400).select(F.concat(F.lit("c"), "id").alias("company"), F.col("id").alias("company_id")).unionByName(
        spark.createDataFrame([("big", 9999)], "company string, company_id long"))
    joined = pipeline.join_bucketed(rows, dim, "company", ("bucket_test.f", "bucket_test.d"), str(tmp_path), buckets=8)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    # only the dominant company's one row travels, by broadcast
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
    want = rows.join(dim, "company", "left")
    assert joined.count() == 3000 and joined.select(*want.columns).exceptAll(want).count() == 0
    # the dominant company and rows without one are in no bucket
    assert spark.table("bucket_test.f").where("company = 'big' OR company IS NULL").count() == 0
