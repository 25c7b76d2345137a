"""Silver layer: per-platform staging (M1–M4) and the unified offer table (M5).

Staging is one parameterised projection.  ``stage`` applies it to one
platform's raw table; ``stage_all`` applies it to a combined raw table in a
single pass (the per-platform rules become ``CASE source`` arms, which
Catalyst folds away when ``source`` is a literal).  Either way the unified
table costs one scan and one shuffle (on ``url``, for the de-duplication).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.text import pg_initcap, trimmed_split_part
from souk.operators.dedup import latest_per_key
from souk.sources.schemas import STAGED_COLUMNS

# How each platform derives the city from its location text.
CITY_DELIMITER = {"rekrute": "(", "dreamjob": None, "indeed": ",", "linkedin": ","}
WITH_KEYWORD = ("indeed", "linkedin")
WITH_NATIVE_ID = ("linkedin",)

# Tie-break for equal scraped_at within one url.  Text columns
# (description, summary) are left out so dimension builds never read them.
DEDUP_TIEBREAK = ["source", "job_id", "job_title", "company", "location_raw", "contract_type", "education",
                  "experience", "sector", "function", "search_keyword", "posted_date_raw"]


def _opt(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _by_source(src: Column, arms: dict[str, Column], default: Column) -> Column:
    out = None
    for name, expr in arms.items():
        out = F.when(src == name, expr) if out is None else out.when(src == name, expr)
    return out.otherwise(default) if out is not None else default


def staged_columns(df: DataFrame, src: Column) -> list[Column]:
    """The 17 staged columns; ``src`` is the platform label column."""
    md5_url = F.md5(F.col("url"))
    native = _opt(df, "job_id")
    job_id = _by_source(src, {p: F.coalesce(native, md5_url) for p in WITH_NATIVE_ID}, md5_url)
    city = _by_source(src, {p: (F.trim(F.col("location")) if d is None else trimmed_split_part("location", d))
                            for p, d in CITY_DELIMITER.items()}, F.lit(None).cast("string"))
    keyword = _by_source(src, {p: F.trim(_opt(df, "search_keyword")) for p in WITH_KEYWORD},
                         F.lit(None).cast("string"))
    return [
        job_id.alias("job_id"),
        F.trim("job_title").alias("job_title"),
        pg_initcap(F.trim("company")).alias("company"),
        F.trim("location").alias("location_raw"),
        city.alias("city"),
        F.trim("summary").alias("summary"),
        F.trim("description").alias("description"),
        F.trim("sector").alias("sector"),
        F.trim("function").alias("function"),
        F.trim("experience").alias("experience"),
        F.trim("education").alias("education"),
        F.trim("contract_type").alias("contract_type"),
        F.col("posted_date").alias("posted_date_raw"),
        F.col("url"),
        src.alias("source"),
        keyword.alias("search_keyword"),
        F.col("scraped_at"),
    ]


REQUIRED_RAW = ["job_title", "company", "location", "summary", "description", "sector", "function", "experience",
                "education", "contract_type", "posted_date", "url", "scraped_at"]


def check_raw(raw: DataFrame, platform: str) -> None:
    """Input contract of a raw table: the common bronze columns must exist."""
    missing = [c for c in REQUIRED_RAW if c not in raw.columns]
    if missing:
        raise ValueError(f"raw {platform} table lacks columns {missing}")


def stage(raw: DataFrame, platform: str) -> DataFrame:
    """M1–M4: clean one platform's raw table (P1) and keep rows with a title
    and a url (P2)."""
    check_raw(raw, platform)
    return (raw.filter(F.col("job_title").isNotNull() & F.col("url").isNotNull())
            .select(*staged_columns(raw, F.lit(platform))))


def stage_all(raw: DataFrame) -> DataFrame:
    """Staging of a combined raw table whose ``source`` column names the platform."""
    check_raw(raw, "combined")
    if "source" not in raw.columns:
        raise ValueError("combined raw table lacks the 'source' column")
    return (raw.filter(F.col("job_title").isNotNull() & F.col("url").isNotNull())
            .select(*staged_columns(raw, F.col("source"))))


def union_staged(parts: list[DataFrame]) -> DataFrame:
    """O2: UNION ALL of staged frames (by name, no de-duplication)."""
    out = parts[0].select(*STAGED_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*STAGED_COLUMNS))
    return out


def with_completeness(df: DataFrame) -> DataFrame:
    """P4 + F6: 0/1 presence flags ('' counts as present) and description length."""
    flags = {"has_company": "company", "has_city": "city", "has_function": "function",
             "has_contract": "contract_type", "has_sector": "sector", "has_education": "education",
             "has_experience": "experience"}
    return df.select(
        *STAGED_COLUMNS,
        *[F.col(c).isNotNull().cast("int").alias(flag) for flag, c in flags.items()],
        F.length(F.coalesce(F.col("description"), F.lit(""))).alias("description_length"),
    )


def jobs_unified(staged: DataFrame) -> DataFrame:
    """M5: latest capture per url (W1) plus completeness columns."""
    return with_completeness(latest_per_key(staged, "url", "scraped_at", DEDUP_TIEBREAK))
