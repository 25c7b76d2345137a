"""Gold layer: dimensions (M6–M13), fact (M14) and skill bridge.

Every builder takes DataFrames and returns a lazy DataFrame.  Dimensions read
only the columns they need from the unified offers (Catalyst prunes the text
columns away), aggregate with partial (map-side) aggregation, and number their
rows without a single-partition exchange unless a rule set bounds their size.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.rules import first_match
from souk.functions.text import pg_initcap, trimmed_split_part
from souk.operators.numbering import global_row_number, small_row_number
from souk.operators.skills import match_skills, skill_rows
from souk.rulesets import catalog as C
from souk.rulesets import warehouse as R


def sorted_distinct_join(c: Column | str, sep: str) -> Column:
    """A4: ``STRING_AGG(DISTINCT c, sep ORDER BY c)`` (binary order); only for few values a group."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def _joined(column: str, wanted: bool) -> list[Column]:
    """The label's raw values as one string, where a caller asks for it: labels
    that take unknown free text have as many of them as the data holds, so the
    default is a row for each (``variants``)."""
    return [sorted_distinct_join(column, " | ").alias("raw_variants")] if wanted else []


def _thresholds(value: Column, steps, default: str) -> Column:
    """First ``value >= bound`` step wins."""
    out = None
    for bound, label in steps:
        out = F.when(value >= bound, label) if out is None else out.when(value >= bound, label)
    return out.otherwise(default)


def _not_blank(c: str) -> Column:
    """``c IS NOT NULL AND TRIM(c) <> ''``."""
    return F.col(c).isNotNull() & (F.trim(F.col(c)) != "")


# ----------------------------------------------------------------- keys
def city_key(c) -> Column:
    """City normalisation (P6); unknown cities fall back to INITCAP(TRIM(c))."""
    c = F.col(c) if isinstance(c, str) else c
    return first_match(c, R.CITY_RULES, pg_initcap(F.trim(c)))


def region_of(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return first_match(c, R.REGION_RULES, R.REGION_DEFAULT)


def contract_main(c) -> Column:
    """Text before the first '-', trimmed (T5: 'Full-time' -> 'Full')."""
    return trimmed_split_part(c, "-")


def contract_key(main: Column) -> Column:
    return first_match(main, R.CONTRACT_RULES, R.CONTRACT_DEFAULT)


def contract_category(main: Column) -> Column:
    return first_match(main, R.CONTRACT_CATEGORY_RULES, R.CONTRACT_CATEGORY_DEFAULT)


def education_key(c: Column, copy: str = "dim") -> Column:
    rules = R.EDUCATION_DIM_RULES if copy == "dim" else R.EDUCATION_FACT_RULES
    return first_match(c, rules, R.EDUCATION_DEFAULT)


def experience_key(c: Column, copy: str = "dim") -> Column:
    rules = R.EXPERIENCE_DIM_RULES if copy == "dim" else R.EXPERIENCE_FACT_RULES
    return first_match(c, rules, R.EXPERIENCE_DEFAULT)


# ------------------------------------------------------------------ dimensions
def dim_source(spark: SparkSession) -> DataFrame:
    """M6: the four platforms (constant relation)."""
    schema = "source_id int, source_key string, source_name string, source_url string, source_scope string"
    return spark.createDataFrame(C.PLATFORMS, schema)


def city_labels(jobs: DataFrame) -> DataFrame:
    """(city_raw, city_normalized, region) of each city that occurs."""
    raw = jobs.filter(_not_blank("city")).select(F.col("city").alias("city_raw")).distinct()
    return raw.select("city_raw", city_key("city_raw").alias("city_normalized"), region_of("city_raw").alias("region"))


def dim_city(jobs: DataFrame, grain_safe: bool = False, joined_variants: bool = False) -> DataFrame:
    """M7: one row per (normalised city, region) and how many raw values it has.

    Grouped on the pair, so a label with two regions gives two rows (T1);
    ``grain_safe=True`` keeps one row per label (smallest id).  ``city_id``
    orders by label, then region (tie-break of the reference's ambiguous order).
    """
    grouped = city_labels(jobs).groupBy("city_normalized", "region").agg(
        F.count(F.lit(1)).alias("nb_raw_variants"), *_joined("city_raw", joined_variants))   # input is already distinct
    out = global_row_number(grouped, [F.col("city_normalized"), F.col("region")], "city_id")
    return collapse_to_key(out, "city_normalized", "city_id") if grain_safe else out


def dim_company(jobs: DataFrame) -> DataFrame:
    """M8: one row per company with activity measures; ids by offers desc."""
    companies = jobs.filter(_not_blank("company")).groupBy("company").agg(
        F.count(F.lit(1)).alias("nb_offers"),
        F.size(F.collect_set("source")).cast("bigint").alias("nb_sources"),
        F.countDistinct("city").alias("nb_cities"),
        sorted_distinct_join("source", ", ").alias("sources_list"),
        F.min("scraped_at").alias("first_seen"),
        F.max("scraped_at").alias("last_seen"))
    numbered = global_row_number(companies, [F.col("nb_offers").desc(), F.col("company")], "company_id")
    return numbered.select(
        "company_id", "company", "nb_offers", "nb_sources", "nb_cities", "sources_list", "first_seen",
        "last_seen",
        _thresholds(F.col("nb_offers"), R.RECRUITER_CATEGORY_BY_OFFERS, R.RECRUITER_CATEGORY_DEFAULT)
        .alias("recruiter_category"))


def contract_labels(jobs: DataFrame) -> DataFrame:
    """(contract_main, contract_normalized, contract_category) of each contract that occurs."""
    raw = jobs.filter(_not_blank("contract_type")).select(contract_main("contract_type").alias("contract_main")).distinct()
    main = F.col("contract_main")
    return raw.select(main, contract_key(main).alias("contract_normalized"), contract_category(main).alias("contract_category"))


def dim_contract(jobs: DataFrame, grain_safe: bool = False, joined_variants: bool = False) -> DataFrame:
    """M9: contract labels × duration category (at most 9 × 5 rows); with
    ``grain_safe=True`` one row per label (smallest id)."""
    grouped = contract_labels(jobs).groupBy("contract_normalized", "contract_category").agg(
        F.count(F.lit(1)).alias("nb_raw_variants"), *_joined("contract_main", joined_variants))
    out = small_row_number(grouped, [F.col("contract_normalized"), F.col("contract_category")], "contract_id")
    return collapse_to_key(out, "contract_normalized", "contract_id") if grain_safe else out


def level_labels(jobs: DataFrame, name: str) -> DataFrame:
    """(<name>_raw, <name>_normalized, level) of each education or experience that occurs."""
    raw = jobs.filter(_not_blank(name)).select(F.col(name).alias(f"{name}_raw")).distinct()
    r = F.col(f"{name}_raw")
    rules, default, levels, top = {
        "education": (R.EDUCATION_DIM_RULES, R.EDUCATION_DEFAULT, R.EDUCATION_LEVEL_RULES, R.EDUCATION_LEVEL_DEFAULT),
        "experience": (R.EXPERIENCE_DIM_RULES, R.EXPERIENCE_DEFAULT, R.EXPERIENCE_LEVEL_RULES, R.EXPERIENCE_LEVEL_DEFAULT)}[name]
    return raw.select(r, first_match(r, rules, default).alias(f"{name}_normalized"), first_match(r, levels, top).alias("level"))


def _levelled_dim(jobs: DataFrame, name: str, steps, default: str, joined_variants: bool) -> DataFrame:
    level = F.col(f"{name}_level_order")
    grouped = level_labels(jobs, name).groupBy(f"{name}_normalized").agg(
        F.min("level").alias(f"{name}_level_order"), F.count(F.lit(1)).alias("nb_raw_variants"), *_joined(f"{name}_raw", joined_variants))
    numbered = small_row_number(grouped, [level, F.col(f"{name}_normalized")], f"{name}_id", dense=True)
    return numbered.withColumn(f"{name}_category", _thresholds(level, steps, default))


def dim_education(jobs: DataFrame, joined_variants: bool = False) -> DataFrame:
    """At most six labels; level = MIN over the label's raw values."""
    return _levelled_dim(jobs, "education", R.EDUCATION_CATEGORY_BY_LEVEL, R.EDUCATION_CATEGORY_DEFAULT, joined_variants)


def dim_experience(jobs: DataFrame, joined_variants: bool = False) -> DataFrame:
    """At most five labels; level = MIN over raw values."""
    return _levelled_dim(jobs, "experience", R.EXPERIENCE_CATEGORY_BY_LEVEL, R.EXPERIENCE_CATEGORY_DEFAULT, joined_variants)


#: Labels of each attribute: how to get them, their raw value and what identifies the dimension's row.
VARIANTS = {
    "city": (city_labels, "city_raw", ["city_normalized", "region"]),
    "contract": (contract_labels, "contract_main", ["contract_normalized", "contract_category"]),
    "education": (lambda jobs: level_labels(jobs, "education"), "education_raw", ["education_normalized"]),
    "experience": (lambda jobs: level_labels(jobs, "experience"), "experience_raw", ["experience_normalized"]),
}


def variants(jobs: DataFrame, name: str, dim: DataFrame | None = None) -> DataFrame:
    """A4 as a long table: a row for each raw value, with its label (and the
    id, if the dimension is given)."""
    labels, raw, keys = VARIANTS[name]
    out = labels(jobs).select(*keys, F.col(raw).alias("raw_value"))
    return out if dim is None else out.join(dim.select(*keys, f"{name}_id"), keys)


def dim_date(spark: SparkSession, asof: _dt.date | str | None = None, jobs: DataFrame | None = None,
             start: str = C.CALENDAR_START, end: str = C.CALENDAR_END) -> DataFrame:
    """Calendar ``start`` … ``end`` with French labels; ``jobs`` widens it
    to the days of its captures, so that no offer is outside.

    ``asof`` is the reference day of the relative flags (default: today);
    the flags have no upper bound, so future days are TRUE as in the reference.
    """
    today = F.current_date() if asof is None else F.lit(str(asof)).cast("date")
    d = F.col("full_date")
    dow = F.dayofweek(d) - 1  # 0 = Sunday
    low, high = F.lit(start).cast("date"), F.lit(end).cast("date")
    span = spark.range(1).select(low.alias("low"), high.alias("high")) if jobs is None else jobs.agg(
        F.least(F.min(F.to_date("scraped_at")), low).alias("low"), F.greatest(F.max(F.to_date("scraped_at")), high).alias("high"))
    days = span.select(F.explode(F.sequence("low", "high", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.element_at(F.array(*[F.lit(m) for m in C.MONTH_NAMES]), F.month(d)).alias("month_name"),
        F.element_at(F.array(*[F.lit(n) for n in C.DAY_NAMES]), dow + 1).alias("day_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        dow.isin(0, 6).alias("is_weekend"),
        (d == today).alias("is_today"),
        (d >= F.date_sub(today, 7)).alias("is_last_7_days"),
        (d >= F.date_sub(today, 30)).alias("is_last_30_days"),
        (d >= F.date_sub(today, 90)).alias("is_last_90_days"),
    )


def dim_skill(spark: SparkSession, intended: bool = False) -> DataFrame:
    """The 42-entry skill dictionary, ids by (category, name)."""
    schema = "skill_id bigint, skill_name string, skill_pattern string, skill_category string"
    return spark.createDataFrame([(i, n, p, c) for i, n, p, c, _ in skill_rows(intended)], schema)


# ------------------------------------------------------------------------ fact
def quality_score(c: dict[str, Column] | None = None) -> Column:
    """P5: round(100 × (7 flags + [description_length ≥ 200]) / 8), half away from zero."""
    flags = ["has_company", "has_city", "has_function", "has_contract", "has_sector", "has_education",
             "has_experience"]
    total = sum((F.coalesce(F.col(f), F.lit(0)) for f in flags), F.lit(0)) + \
        F.when(F.col("description_length") >= 200, 1).otherwise(0)
    return F.round(F.lit(100.0) * total / 8.0).cast("int")


def collapse_to_key(dim: DataFrame, key: str, id_col: str) -> DataFrame:
    """Grain guard: one row per natural key, the one with the smallest id."""
    from souk.operators.dedup import keep_first
    return keep_first(dim, [key], [F.col(id_col)])


TEXTS = ("job_title", "summary", "description", "url", "posted_date_raw", "search_keyword")


def without_texts(jobs: DataFrame) -> DataFrame:
    """The unified offers but for what only the fact's text columns need (url stays: it identifies an offer)."""
    return jobs.drop("job_title", "summary", "description", "posted_date_raw", "search_keyword")


def _spread(key: Column) -> Column:
    """A join key without NULLs: each NULL becomes a value of its own that no dimension has, so they meet in no one task."""
    return F.coalesce(key, F.concat(F.lit("\x00"), F.col("url")))


def fact_ids(jobs: DataFrame, dims: dict[str, DataFrame], grain_safe: bool = False) -> DataFrame:
    """The fact without its texts: url, ids and measures of each offer.

    LEFT joins on computed keys (the same rule lists as the dimensions, fact
    copies for education/experience — T3), for those dimensions that ``dims``
    has.  Dimensions whose size a rule set bounds (source, contract,
    education, experience) are broadcast; AQE broadcasts city, company and
    calendar when their measured size is under the threshold.

    The quality score is computed inline: the reference's self-join on job_id
    equals it whenever job_id is unique and would emit every pair of a
    duplicated job_id (T2) — see ``grain_check``.

    A city or contract label held by two dimension rows (T1) duplicates the
    offer, as in the reference; ``grain_safe=True`` joins to one row per label
    (smallest id) so there is one row per offer.
    """
    dims = dict(dims)
    if grain_safe:
        for name, key in (("city", "city_normalized"), ("contract", "contract_normalized")):
            if f"dim_{name}" in dims:
                dims[f"dim_{name}"] = collapse_to_key(dims[f"dim_{name}"], key, f"{name}_id")
    keys = {
        "dim_source": ("source_key", "source_id", F.col("source"), True),
        "dim_city": ("city_normalized", "city_id", _spread(city_key("city")), False),
        "dim_company": ("company", "company_id", _spread(F.col("company")), False),
        "dim_contract": ("contract_normalized", "contract_id", contract_key(contract_main("contract_type")), True),
        "dim_education": ("education_normalized", "education_id", education_key(F.col("education"), "fact"), True),
        "dim_experience": ("experience_normalized", "experience_id", experience_key(F.col("experience"), "fact"), True),
        "dim_date": ("full_date", "date_id", F.to_date("scraped_at"), False),
    }
    keys = {k: v for k, v in keys.items() if k in dims}
    out = without_texts(jobs).withColumns({f"_k_{name}": key for name, (_, _, key, _) in keys.items()} | {"quality_score": quality_score()})
    for name, (natural, number, _, bounded) in keys.items():
        dim = dims[name].select(F.col(natural).alias(f"_n_{name}"), F.col(number).alias("scraped_date_id" if name == "dim_date" else number))
        out = out.join(F.broadcast(dim) if bounded else dim, F.col(f"_k_{name}") == F.col(f"_n_{name}"), "left").drop(f"_k_{name}", f"_n_{name}")
    return out.withColumn("offer_count", F.lit(1))


#: A job_id with more than one part in so many of all offers is hot; there are fewer of them than this.
HOT_PARTS = 64


def score_pairs(ids: DataFrame, jobs: DataFrame) -> DataFrame:
    """J8 as written: rows of the fact ⟕ the offers' scores on job_id.

    A job_id that n offers share gives each of its rows n scores (T2).  Its
    rows are dealt by url over as many parts as its share of the offers asks
    for (at most ``HOT_PARTS``), and its scores go to each part; hot ids are
    fewer than ``HOT_PARTS`` whatever the data, so they are broadcast.
    """
    scores = jobs.select(F.col("job_id").alias("_id"), quality_score().alias("_score")).where("_id IS NOT NULL")
    total = jobs.count()
    held = scores.groupBy("_id").count().where(F.col("count") * HOT_PARTS > total)
    hot = F.broadcast(held.select(F.col("_id").alias("_hot"), F.ceil(F.col("count") * HOT_PARTS / F.lit(max(1, total))).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    left = (ids.join(hot, F.col("job_id") == F.col("_hot"), "left")
            .withColumn("_part", F.pmod(F.xxhash64("url"), parts).cast("int")).drop("_hot", "_parts"))
    right = (scores.join(hot, F.col("_id") == F.col("_hot"), "left")
             .select("_id", "_score", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_at")))
    joined = left.join(right, (F.col("job_id") == F.col("_id")) & (F.col("_part") == F.col("_at")), "left")
    return joined.withColumn("quality_score", F.col("_score")).drop("_id", "_score", "_at", "_part")


def fct_jobs(spark: SparkSession, jobs: DataFrame, dims: dict[str, DataFrame] | None = None,
             grain_safe: bool = False, narrow: DataFrame | None = None, faithful: bool = False) -> DataFrame:
    """One row per unified offer with the ids of its seven dimensions.

    ``faithful=True`` takes the score from the reference's self-join on job_id,
    with its n² rows of a job_id that n offers share (``score_pairs``).

    Ids are resolved on rows without texts (``narrow``: the same offers, e.g.
    a written copy; ``jobs`` itself by default) and meet the texts in one join
    by url.  Offers that come out of the de-duplication are already dealt by
    url, so their texts aren't shuffled again.
    """
    narrow = jobs if narrow is None else narrow
    dims = dims or build_dimensions(spark, narrow)
    ids = fact_ids(narrow, dims, grain_safe)
    ids = (score_pairs(ids, narrow) if faithful else ids).withColumnRenamed("url", "_url")
    texts = jobs.select(*TEXTS)
    return texts.join(ids, texts["url"] == ids["_url"]).select(
        "job_id", "source_id", "city_id", "company_id", "contract_id", "education_id", "experience_id",
        "scraped_date_id", "job_title", "summary", "description", "url", "posted_date_raw", "search_keyword",
        "description_length", "quality_score", "offer_count",
        "has_company", "has_city", "has_function", "has_contract", "has_sector", "has_education",
        "has_experience", "scraped_at")


def dimension_makers(spark: SparkSession, jobs: DataFrame, asof=None, grain_safe: bool = False) -> dict:
    """A function for each dimension: some number their rows in a first job, so building one is work of its own."""
    return {
        "dim_source": lambda: dim_source(spark),
        "dim_city": lambda: dim_city(jobs, grain_safe),
        "dim_company": lambda: dim_company(jobs),
        "dim_contract": lambda: dim_contract(jobs, grain_safe),
        "dim_education": lambda: dim_education(jobs),
        "dim_experience": lambda: dim_experience(jobs),
        "dim_date": lambda: dim_date(spark, asof, jobs),
        "dim_skill": lambda: dim_skill(spark),
    }


def build_dimensions(spark: SparkSession, jobs: DataFrame, asof=None, grain_safe: bool = False) -> dict[str, DataFrame]:
    return {name: make() for name, make in dimension_makers(spark, jobs, asof, grain_safe).items()}


# ---------------------------------------------------------------------- bridge
def offer_skills(jobs: DataFrame, intended: bool = False) -> DataFrame:
    """(url, job_id, skill) of each unified offer and skill whose pattern matches description + title.

    Instead of the reference's offers × skills nested-loop join, the 42
    patterns are unrolled into one projection per offer (O10): one pass over
    the texts, below all joins, each regex compiled once per task.
    """
    text = F.concat(F.coalesce(F.col("description"), F.lit("")), F.lit(" "), F.coalesce(F.col("job_title"), F.lit("")))
    return match_skills(jobs.select("url", "job_id", text.alias("_text")), "_text", intended).drop("_text")


def bridge_job_skill(jobs: DataFrame, ids: DataFrame, intended: bool = False) -> DataFrame:
    """(fact row, skill) pairs.  Skills are matched on the unified offers
    and meet the fact's rows (``fact_ids`` or the fact) by url, so an offer
    that the fact holds twice (T1) has its skills twice, as in the reference."""
    rows = ids.select(F.col("url").alias("_url"))
    hits = offer_skills(jobs, intended)
    return hits.join(rows, hits["url"] == rows["_url"]).select("job_id", "skill_id", "skill_name", "skill_category")
