"""Registered queries: Spark callables and their DuckDB oracle SQL.

Every query reads the driver's tables (offers are derived from ``documents``
and their buyers, pages from ``documents`` or ``pages``) so its work grows
with them.  Constant relations (the platforms, the skill dictionary, the
calendar) are registered only joined to offer data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.plans import gold, oracle, pipeline, silver
from souk.sources.offers import bronze_offers, bronze_table

ASOF = oracle.ASOF
DIMENSIONS = ("dim_city", "dim_company", "dim_contract", "dim_education", "dim_experience")


# ------------------------------------------------------------- Spark builders
def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.jobs_unified(silver.stage_all(bronze_offers(spark, sf_dir)))


def narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified offers without their texts, computed once: what dimensions, ids and reports read."""
    return pipeline.materialize(gold.without_texts(unified(spark, sf_dir)))


def dimensions(spark: SparkSession, jobs: DataFrame, *names: str) -> dict[str, DataFrame]:
    """Only the dimensions that a query needs."""
    make = {"dim_source": lambda: gold.dim_source(spark), "dim_date": lambda: gold.dim_date(spark, ASOF, jobs),
            "dim_skill": lambda: gold.dim_skill(spark), **{d: lambda d=d: getattr(gold, d)(jobs) for d in DIMENSIONS}}
    return {n: make[n]() for n in names}


def star(spark: SparkSession, sf_dir: str, grain_safe: bool = False) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """(narrow offers, all dimensions of the fact, the fact)."""
    jobs = narrow(spark, sf_dir)
    dims = dimensions(spark, jobs, "dim_source", "dim_date", *DIMENSIONS)
    return jobs, dims, gold.fct_jobs(spark, unified(spark, sf_dir), dims, grain_safe, jobs)


def report(spark: SparkSession, sf_dir: str, *names: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """One row per offer (grain-safe, no texts) with the ids of the named dimensions."""
    jobs = narrow(spark, sf_dir)
    dims = dimensions(spark, jobs, *names)
    return gold.fact_ids(jobs, dims, grain_safe=True), dims


def _stg(platform: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: silver.stage(bronze_table(spark, sf, platform), platform)


def _dim(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: getattr(gold, name)(gold.without_texts(unified(spark, sf)))


def _variants(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: gold.variants(gold.without_texts(unified(spark, sf)), name)


def q_fct_jobs(spark, sf):
    return star(spark, sf)[2]


def q_fct_jobs_safe(spark, sf):
    """The fact with one row per offer: labels that two dimension rows hold count once."""
    return star(spark, sf, grain_safe=True)[2]


def q_fct_jobs_pairs(spark, sf):
    """The fact with the scores of the reference's self-join on job_id."""
    jobs = narrow(spark, sf)
    dims = dimensions(spark, jobs, "dim_source", "dim_date", *DIMENSIONS)
    return gold.fct_jobs(spark, unified(spark, sf), dims, narrow=jobs, faithful=True)


def q_raw_variants(spark, sf):
    """A4: the four dimensions' labels, each with its raw values as one ordered string."""
    jobs = narrow(spark, sf)
    out = None
    for name, kind in (("city", F.col("region")), ("contract", F.col("contract_category")), ("education", F.lit(None).cast("string")), ("experience", F.lit(None).cast("string"))):
        dim = getattr(gold, f"dim_{name}")(jobs, joined_variants=True).select(
            F.lit(name).alias("dimension"), F.col(f"{name}_id").alias("id"), F.col(f"{name}_normalized").alias("label"), kind.alias("kind"), "raw_variants", "nb_raw_variants")
        out = dim if out is None else out.unionByName(dim)
    return out


def q_bridge_written_order(spark, sf):
    """O1: the bridge as written, read back: its rows, and those out of (job_id, skill_id) order within or across files."""
    path = pipeline.write_table(q_bridge_job_skill(spark, sf), _folder(spark), "gold", "bridge_job_skill", sort_by=["job_id", "skill_id"])
    return pipeline.order_violations(spark, path, ["job_id", "skill_id"])


def q_bridge_job_skill(spark, sf):
    jobs = narrow(spark, sf)
    ids = gold.fact_ids(jobs, dimensions(spark, jobs, "dim_city", "dim_contract"))
    return gold.bridge_job_skill(unified(spark, sf), ids)


def q_offers_by_region(spark, sf):
    """Flagship: offers, cities and summed quality per region (fact ⋈ dim_city)."""
    fct, dims = report(spark, sf, "dim_city")
    return (fct.join(dims["dim_city"].select("city_id", "region"), "city_id", "left").groupBy("region")
            .agg(F.sum("offer_count").alias("n_offers"),
                 F.countDistinct("city_id").alias("n_cities"),
                 F.sum("quality_score").alias("sum_quality")))


def q_offers_by_source(spark, sf):
    """Platform dimension joined to offer counts and completeness."""
    fct, dims = report(spark, sf, "dim_source")
    per = fct.groupBy("source_id").agg(F.sum("offer_count").alias("n_offers"),
                                       F.sum("has_company").alias("n_with_company"),
                                       F.sum("quality_score").alias("sum_quality"))
    return dims["dim_source"].join(per, "source_id", "left")


def q_offers_by_day(spark, sf):
    """Calendar with the number of offers captured each day; offers without a
    capture time are a row without a day, so the sum is all offers."""
    fct, dims = report(spark, sf, "dim_date")
    per = fct.groupBy(F.col("scraped_date_id").alias("id")).agg(F.sum("offer_count").alias("n_offers"))
    return (dims["dim_date"].join(per, F.col("date_id") == F.col("id"), "full").drop("id")
            .withColumn("n_offers", F.coalesce("n_offers", F.lit(0)).cast("bigint")))


def q_offers_by_city_month(spark, sf):
    """Offers per normalised city and capture month (fact ⋈ dim_city ⋈ dim_date)."""
    fct, dims = report(spark, sf, "dim_city", "dim_company", "dim_date")
    city = dims["dim_city"].select("city_id", "city_normalized")
    month = dims["dim_date"].select(F.col("date_id").alias("scraped_date_id"), "year_month")
    return (fct.join(city, "city_id", "left").join(month, "scraped_date_id", "left")
            .groupBy("city_normalized", "year_month")
            .agg(F.sum("offer_count").alias("n_offers"), F.countDistinct("company_id").alias("n_companies")))


def q_skill_demand(spark, sf):
    """Skill dictionary with the number of offers per skill."""
    per = gold.offer_skills(unified(spark, sf)).groupBy("skill_id").agg(F.count(F.lit(1)).alias("n_offers"))
    return (gold.dim_skill(spark).join(per, "skill_id", "left")
            .withColumn("n_offers", F.coalesce("n_offers", F.lit(0)).cast("bigint")))


# -------------------------------------------------- sinks: written and read again
OWN = "souk_query_"  # layers that queries register: never those of a warehouse


def _folder(spark: SparkSession) -> str:
    import uuid
    from souk.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/warehouse-{uuid.uuid4().hex}"


def q_bronze_appended(spark, sf):
    """Two loads of a raw table, one of them again, and an empty one; rows per load as read back."""
    out = _folder(spark)
    raw, copy = pipeline.written_copy(bronze_table(spark, sf, "linkedin"), "captured")
    # rows without a capture time go into the second load
    early = F.coalesce(F.col("scraped_at") < F.lit("2025-01-01").cast("timestamp_ntz"), F.lit(False))
    for batch, rows in (("a", raw.filter(early)), ("b", raw.filter(~early)), ("b", raw.filter(~early)), ("c", raw.filter("false"))):
        pipeline.append_bronze(rows, out, "linkedin", batch_id=batch)
    pipeline.delete_path(spark, copy)
    return pipeline.read_bronze(spark, out, "linkedin").groupBy("batch_id", "capture_date").agg(F.count(F.lit(1)).alias("n_rows"))


QUARTER_SINCE, QUARTER_UNTIL = "2025-01-01", "2026-01-01"


def captured_by_quarter(spark: SparkSession, out: str) -> DataFrame:
    """Raw LinkedIn rows of a year's first and third quarters, by quarter: the year prunes by value, the quarters through the calendar."""
    raw = pipeline.read_bronze(spark, out, "linkedin", QUARTER_SINCE, QUARTER_UNTIL)
    days = gold.dim_date(spark, ASOF).where(F.col("quarter").isin(1, 3)).select("full_date", "year_quarter")
    return pipeline.captured_on(raw, days).groupBy("year_quarter").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("url").alias("n_urls"))


def q_captured_by_quarter(spark, sf):
    """A windowed scan of an appended raw table."""
    out = _folder(spark)
    pipeline.append_bronze(bronze_table(spark, sf, "linkedin"), out, "linkedin", batch_id="a")
    return captured_by_quarter(spark, out)


def q_offers_by_recruiter(spark, sf):
    """Offers per recruiter category, the fact and its company dimension joined bucket by bucket."""
    jobs = narrow(spark, sf)
    dim = gold.dim_company(jobs).select("company", "company_id", "recruiter_category")
    both = pipeline.join_bucketed(jobs.select("url", "company", "description_length"), dim, "company", (f"{OWN}gold.offers_by_company", f"{OWN}gold.company_buckets"), _folder(spark))
    return both.groupBy("recruiter_category").agg(F.count(F.lit(1)).alias("n_offers"), F.countDistinct("company_id").alias("n_companies"),
                                                  F.sum("description_length").cast("bigint").alias("sum_length"))


def q_silver_merged(spark, sf):
    """M5, W1 over loads: the unified offers, merged load by load (the second has captures before and after the first's)."""
    out, staged = _folder(spark), silver.stage_all(bronze_offers(spark, sf))
    first = F.pmod(F.xxhash64("job_title", "scraped_at"), F.lit(2)) == 0
    pipeline.merge_unified(spark, staged.where(first), out)
    return pipeline.merge_unified(spark, staged.where(~first), out).select("url", "source", "job_id", "scraped_at", "description_length")


def q_staging_views(spark, sf):
    """The four staging views, read by name."""
    pipeline.register_staging_views({p: bronze_table(spark, sf, p) for p in oracle.PLATFORMS})
    out = None
    for p in oracle.PLATFORMS:
        view = spark.table(f"stg_{p}").groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("job_id").alias("n_jobs"))
        out = view if out is None else out.unionByName(view)
    return out


def q_warehouse_tables(spark, sf):
    """The whole build, written, refreshed, registered and read by table name."""
    out = _folder(spark)
    bronze = bronze_offers(spark, sf)
    paths = pipeline.build_all(spark, bronze, out, asof=ASOF, register=True, prefix=OWN)
    total = None
    for table in sorted(paths):
        layer = pipeline.schema_name("silver" if table == "jobs_unified" else None, "gold")
        n = spark.table(f"{OWN}{layer}.{table}").select(F.lit(f"{layer}.{table}").alias("table_name")).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))
        total = n if total is None else total.unionByName(n)
    return total


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for p in oracle.PLATFORMS:
        out[f"stg_{p}"] = _stg(p)
    out["jobs_unified"] = unified
    for d in DIMENSIONS:
        out[d] = _dim(d)
    for v in gold.VARIANTS:
        out[f"{v}_variants"] = _variants(v)
    out |= {"fct_jobs": q_fct_jobs, "fct_jobs_safe": q_fct_jobs_safe, "fct_jobs_pairs": q_fct_jobs_pairs, "raw_variants": q_raw_variants,
            "bridge_written_order": q_bridge_written_order, "captured_by_quarter": q_captured_by_quarter, "silver_merged": q_silver_merged, "offers_by_recruiter": q_offers_by_recruiter, "bridge_job_skill": q_bridge_job_skill,
            "offers_by_region": q_offers_by_region, "offers_by_source": q_offers_by_source, "offers_by_day": q_offers_by_day,
            "offers_by_city_month": q_offers_by_city_month, "skill_demand": q_skill_demand,
            "bronze_appended": q_bronze_appended, "staging_views": q_staging_views, "warehouse_tables": q_warehouse_tables}
    from souk.plans import extraction_queries
    out.update(extraction_queries.spark_queries())
    return out


# ---------------------------------------------------------------- oracle SQL
def oracle_queries() -> dict[str, str]:
    silver_ctes, full = oracle.silver_ctes(), oracle.full_ctes(ASOF)

    def of(final: str) -> str:
        return oracle.with_ctes(full, final)

    out = {f"stg_{p}": oracle.with_ctes(silver_ctes[:2], f"SELECT * FROM staged WHERE source = '{p}'") for p in oracle.PLATFORMS}
    out["jobs_unified"] = oracle.with_ctes(silver_ctes, "SELECT * FROM jobs_unified")
    for d in (*DIMENSIONS, "fct_jobs", "bridge_job_skill"):
        out[d] = of(f"SELECT * FROM {d}")
    kinds = {"city": ", kind AS region", "contract": ", kind AS contract_category", "education": "", "experience": ""}
    for v, kind in kinds.items():
        out[f"{v}_variants"] = of(f"SELECT DISTINCT label AS {v}_normalized{kind}, txt AS raw_value FROM {v}_labels WHERE listed")
    out["fct_jobs_safe"] = of("SELECT * FROM safe_fact")
    out["fct_jobs_pairs"] = of("SELECT f.* REPLACE (o.quality_score AS quality_score) FROM fct_jobs f LEFT JOIN scored o ON f.job_id = o.job_id")
    out["raw_variants"] = of(" UNION ALL ".join(
        f"SELECT '{v}' AS dimension, CAST({v}_id AS BIGINT) AS id, {v}_normalized AS label, {'d.' + kind.split()[-1] if kind else 'CAST(NULL AS VARCHAR)'} AS kind, "
        f"string_agg(DISTINCT txt, ' | ' ORDER BY txt) AS raw_variants, count(DISTINCT txt) AS nb_raw_variants "
        f"FROM {v}_labels l JOIN dim_{v} d ON l.label = {v}_normalized{' AND l.kind = d.' + kind.split()[-1] if kind else ''} WHERE listed GROUP BY ALL"
        for v, kind in kinds.items()))
    out["bridge_written_order"] = of("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_violations FROM bridge_job_skill")
    out["offers_by_region"] = of("""SELECT region, CAST(sum(offer_count) AS BIGINT) AS n_offers, count(DISTINCT city_id) AS n_cities,
    CAST(sum(quality_score) AS BIGINT) AS sum_quality FROM safe_fact LEFT JOIN dim_city USING (city_id) GROUP BY region""")
    out["offers_by_source"] = of("""SELECT * FROM dim_source LEFT JOIN (SELECT source_id, CAST(sum(offer_count) AS BIGINT) AS n_offers,
    CAST(sum(has_company) AS BIGINT) AS n_with_company, CAST(sum(quality_score) AS BIGINT) AS sum_quality FROM safe_fact GROUP BY source_id) USING (source_id)""")
    out["offers_by_day"] = of("""SELECT d.*, CAST(coalesce(n, 0) AS BIGINT) AS n_offers FROM dim_date d FULL JOIN
    (SELECT scraped_date_id, count(*) AS n FROM safe_fact GROUP BY scraped_date_id) ON date_id = scraped_date_id""")
    out["offers_by_city_month"] = of("""SELECT city_normalized, year_month, CAST(sum(offer_count) AS BIGINT) AS n_offers, count(DISTINCT company_id) AS n_companies
    FROM safe_fact LEFT JOIN dim_city USING (city_id) LEFT JOIN dim_date ON date_id = scraped_date_id GROUP BY city_normalized, year_month""")
    out["skill_demand"] = of("""SELECT s.*, CAST(coalesce(n, 0) AS BIGINT) AS n_offers FROM dim_skill s
    LEFT JOIN (SELECT skill_id, count(*) AS n FROM hits GROUP BY skill_id) USING (skill_id)""")
    out["bronze_appended"] = oracle.with_ctes(silver_ctes[:1], """SELECT CASE WHEN scraped_at < TIMESTAMP '2025-01-01' THEN 'a' ELSE 'b' END AS batch_id,
    CAST(scraped_at AS DATE) AS capture_date, count(*) AS n_rows FROM bronze WHERE source = 'linkedin' GROUP BY ALL""")
    out["captured_by_quarter"] = oracle.with_ctes(silver_ctes[:1], f"""SELECT year(scraped_at) || '-Q' || quarter(scraped_at) AS year_quarter, count(*) AS n_rows,
    count(DISTINCT url) AS n_urls FROM bronze WHERE source = 'linkedin' AND scraped_at >= TIMESTAMP '{QUARTER_SINCE}' AND scraped_at < TIMESTAMP '{QUARTER_UNTIL}'
    AND quarter(scraped_at) IN (1, 3) GROUP BY ALL""")
    out["offers_by_recruiter"] = of("""SELECT recruiter_category, count(*) AS n_offers, count(DISTINCT company_id) AS n_companies,
    CAST(sum(description_length) AS BIGINT) AS sum_length FROM jobs_unified LEFT JOIN dim_company USING (company) GROUP BY recruiter_category""")
    out["silver_merged"] = oracle.with_ctes(silver_ctes, "SELECT url, source, job_id, scraped_at, description_length FROM jobs_unified")
    out["staging_views"] = oracle.with_ctes(silver_ctes[:2], "SELECT source, count(*) AS n_rows, count(DISTINCT job_id) AS n_jobs FROM staged GROUP BY source")
    tables = ["dim_source", "dim_date", "dim_skill", *DIMENSIONS, "fct_jobs", "bridge_job_skill"]
    counts = ["SELECT 'silver.jobs_unified' AS table_name, count(*) AS n_rows FROM jobs_unified"]
    counts += [f"SELECT 'gold.{t}', count(*) FROM {t}" for t in tables]
    counts += [f"SELECT 'gold.{v}_variants', count(DISTINCT txt) FROM {v}_labels WHERE listed" for v in gold.VARIANTS]
    out["warehouse_tables"] = of(" UNION ALL ".join(counts))
    from souk.plans import extraction_queries
    out.update(extraction_queries.oracle_queries())
    return out
