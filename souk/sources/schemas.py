"""Explicit schemas of the three layers (FIXTURES.md §1–2)."""

from pyspark.sql import types as T

S, TS = T.StringType(), T.TimestampNTZType()

_COMMON = ["job_title", "company", "location", "summary", "description", "sector", "function",
           "experience", "education", "contract_type", "posted_date", "url"]

BRONZE_COLUMNS = {
    "rekrute": _COMMON + ["source", "scraped_at"],
    "dreamjob": _COMMON + ["source", "scraped_at"],
    "indeed": _COMMON + ["source", "search_keyword", "scraped_at"],
    "linkedin": _COMMON + ["job_id", "source", "search_keyword", "scraped_at"],
}


def bronze_schema(platform: str) -> T.StructType:
    return T.StructType([T.StructField(c, TS if c == "scraped_at" else S, True)
                         for c in BRONZE_COLUMNS[platform]])


STAGED_COLUMNS = ["job_id", "job_title", "company", "location_raw", "city", "summary", "description", "sector",
                  "function", "experience", "education", "contract_type", "posted_date_raw", "url", "source",
                  "search_keyword", "scraped_at"]
FLAG_COLUMNS = ["has_company", "has_city", "has_function", "has_contract", "has_sector", "has_education",
                "has_experience"]
UNIFIED_COLUMNS = STAGED_COLUMNS + FLAG_COLUMNS + ["description_length"]

FACT_COLUMNS = ["job_id", "source_id", "city_id", "company_id", "contract_id", "education_id", "experience_id",
                "scraped_date_id", "job_title", "summary", "description", "url", "posted_date_raw",
                "search_keyword", "description_length", "quality_score", "offer_count"] + FLAG_COLUMNS + [
                "scraped_at"]

# Captured pages fed to the HTML extractors (the driver's `pages` has the first three).
CAPTURED_PAGES_DDL = ("page_id bigint, url string, html string, platform string, page_kind string, "
                      "search_keyword string, keyword_rank int, page_no int, captured_at timestamp_ntz, run_id string")
