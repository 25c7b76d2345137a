"""Registered text-extraction queries.

Inputs are derived by Spark from ``documents`` (``offers.offer_texts`` and the
bronze offers), so every query scans whole texts of the given table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.regex import NON_WORD, SPACE, sql_quote
from souk.functions.text import clean_text, clean_text_sql, linkedin_job_id, linkedin_job_id_sql, py_strip, url_without_query
from souk.operators import extract as X
from souk.operators.dedup import keep_first
from souk.operators.quality import completeness_profile, completeness_profile_sql, grain_check
from souk.plans import oracle
from souk.rulesets import extraction as D
from souk.sources.offers import bronze_offers, offer_texts, offer_texts_sql, read_table, source_rows

_STRIP = f"^[{SPACE}]+|[{SPACE}]+$"


def _documents(spark, sf):
    return read_table(spark, sf, "documents")


def _texts(spark, sf):
    return offer_texts(_documents(spark, sf))


def _py_strip_sql(c: str) -> str:
    return f"regexp_replace({c}, {sql_quote(_STRIP)}, '', 'g')"


# --------------------------------------------------------------------- Spark
def q_extract_dreamjob(spark, sf) -> DataFrame:
    """Dreamjob record fields from title, excerpt and whole description."""
    t = _texts(spark, sf)
    t = X.with_folded(t.select("doc_id", "title", "excerpt", "description", "headline"),
                      "title", "excerpt", "description")

    def spaced(a: Column, b: Column) -> Column:  # f"{excerpt} {description}".strip()
        return py_strip(F.concat(F.coalesce(a, F.lit("")), F.lit(" "), F.coalesce(b, F.lit(""))))
    t = t.select("*", spaced(F.col("excerpt"), F.col("description")).alias("combined"),
                 spaced(X.folded("excerpt"), X.folded("description")).alias("__folded_combined"),
                 X.joined_words("excerpt", "description").alias("__words_combined"))
    t = X.with_folded_joins(t, {"title_text": ("title", "combined")})
    comb = X.text("combined")
    return t.select(
        "doc_id",
        X.company_from_title("headline").alias("company"),
        F.coalesce(X.city(X.text("excerpt")), X.city(X.text("description"))).alias("location"),
        X.contracts(comb).alias("contract_type"),
        X.education(comb, "dreamjob").alias("education"),
        X.experience(comb, "dreamjob").alias("experience"),
        X.functions(X.text("title_text"), "dreamjob", D.FUNCTION_LABELS).alias("function"),
    )


def q_extract_indeed(spark, sf) -> DataFrame:
    """Indeed record fields; contract falls back to the card metadata."""
    t = X.with_folded(_texts(spark, sf), "title", "description")
    t = X.with_folded_joins(t, {"title_text": ("title", "description")})
    desc = X.text("description")
    return t.select(
        "doc_id",
        F.coalesce(X.contracts(desc, english=True), clean_text("card_meta")).alias("contract_type"),
        X.education(desc, "indeed").alias("education"),
        X.experience(desc, "indeed").alias("experience"),
        X.functions(X.text("title_text"), "indeed", D.FUNCTION_LABELS).alias("function"),
        X.sectors(desc, D.SECTOR_LABELS).alias("sector"),
    )


def q_extract_linkedin(spark, sf) -> DataFrame:
    """LinkedIn record fields: criteria mapping, native id, education, years."""
    t = X.with_folded(_texts(spark, sf).select("*", X.criteria_field(F.col("criteria")).alias("_mapped")),
                      "description", words=False)
    desc = X.text("description", words=False)
    cut = url_without_query("url")
    years = X.experience(desc, "linkedin")
    return t.select(
        "doc_id",
        cut.alias("url"),
        linkedin_job_id(cut).alias("job_id"),
        F.coalesce(F.nullif(X.criteria_value(F.col("_mapped"), "experience_level"), F.lit("")), years)
        .alias("experience"),
        X.criteria_value(F.col("_mapped"), "contract_type").alias("contract_type"),
        X.criteria_value(F.col("_mapped"), "function").alias("function"),
        X.criteria_value(F.col("_mapped"), "sector").alias("sector"),
        X.education(desc, "indeed").alias("education"),
    )


KEYWORDS = ["data engineer", "data scientist", "data analyst", "business intelligence", "machine learning"]


def keyword_cards(documents: DataFrame) -> DataFrame:
    """Cards as a multi-keyword search lists them: each document appears under
    1–3 keywords; documents 2k and 2k+1 share one offer url."""
    d = F.col("doc_id")
    return (documents.select(d, F.explode(F.sequence(F.lit(0), (d % 3).cast("int"))).alias("kw_rank"))
            .select(d, "kw_rank",
                    F.element_at(F.array(*[F.lit(k) for k in KEYWORDS]), ((d + F.col("kw_rank")) % 5).cast("int") + 1)
                    .alias("keyword"),
                    ((d / 25).cast("bigint") % 3).alias("page"), (d % 25).alias("pos"),
                    F.concat(F.lit("https://www.linkedin.com/jobs/view/offer-"), (d / 2).cast("bigint").cast("string"))
                    .alias("url")))


def q_first_seen_cards(spark, sf) -> DataFrame:
    """One card per url, the first seen in (keyword, page, position) order."""
    cards = keyword_cards(read_table(spark, sf, "documents"))
    return keep_first(cards, ["url"], [F.col("kw_rank"), F.col("page"), F.col("pos")])


def q_bronze_profile(spark, sf) -> DataFrame:
    """Batch completeness profile per platform."""
    return completeness_profile(bronze_offers(spark, sf), "source")


def q_fct_grain_check(spark, sf) -> DataFrame:
    """T2 guard: job_ids held by more than one fact row."""
    from souk.plans import gold, registry
    jobs = registry.narrow(spark, sf)
    return grain_check(gold.fact_ids(jobs, registry.dimensions(spark, jobs, "dim_city", "dim_contract")), ["job_id"])


def q_page_articles(spark, sf) -> DataFrame:
    """X5 on the driver's captured web pages: cleaned article text per page."""
    from souk.operators.pages import page_articles
    return page_articles(read_table(spark, sf, "pages"))


def _bronze_from_pages(platform: str):
    def q(spark, sf) -> DataFrame:
        from souk.operators.pages import RECORD_BUILDERS
        from souk.sources.pages import captured_pages
        return RECORD_BUILDERS[platform](captured_pages(source_rows(spark, sf), platform))
    q.__doc__ = f"M16 {platform}: bronze records extracted from rendered list/detail pages."
    return q


RUN_TWO_DAYS = 7


def two_runs(spark, sf, platform: str = "indeed") -> DataFrame:
    """The pages of a run, and the same pages captured again a week later."""
    from souk.sources.pages import captured_pages
    first = captured_pages(source_rows(spark, sf), platform)
    again = first.withColumns({"run_id": F.lit("run-2"), "page_id": F.col("page_id") + 1,
                               "captured_at": F.col("captured_at") + F.expr(f"INTERVAL {RUN_TWO_DAYS} DAYS")})
    return first.unionByName(again)


def q_bronze_indeed_runs(spark, sf) -> DataFrame:
    """X21, X22, X25 over two runs: every run has its own record of an offer."""
    from souk.operators.pages import RECORD_BUILDERS
    return RECORD_BUILDERS["indeed"](two_runs(spark, sf))


def q_silver_of_runs(spark, sf) -> DataFrame:
    """W1 over two runs: silver keeps the newest capture of each offer."""
    from souk.plans import silver
    out = silver.jobs_unified(silver.stage(q_bronze_indeed_runs(spark, sf), "indeed"))
    return out.select("job_id", "url", "scraped_at", "description_length")


def opening_phrases(documents: DataFrame) -> DataFrame:
    """A dictionary that grows with the data: the first one, two or three words of every document."""
    return documents.selectExpr("substring_index(text, ' ', cast(pmod(doc_id, 3) as int) + 1) AS phrase").where("phrase != ''")


def q_phrase_mentions(spark, sf) -> DataFrame:
    """O10 with thousands of entries: which documents hold which of all documents' opening phrases."""
    from souk.operators.phrases import match_phrases
    docs = _documents(spark, sf)
    return match_phrases(docs, "doc_id", "text", opening_phrases(docs), "phrase")


def q_bronze_dreamjob_stored(spark, sf) -> DataFrame:
    """Dreamjob records as its collector stores them, the description cut at 5 000 characters (rules read whole texts)."""
    from souk.operators.pages import dreamjob_records
    from souk.sources.pages import captured_pages
    return dreamjob_records(captured_pages(source_rows(spark, sf), "dreamjob"), max_chars=D.DESCRIPTION_MAX_CHARS)


def q_page_errors(spark, sf) -> DataFrame:
    """Pages that were captured without content, as the error table has them."""
    from souk.operators.pages import page_errors, walked
    from souk.sources.pages import captured_pages
    pages = captured_pages(source_rows(spark, sf), "indeed")
    lost = F.when(F.pmod("page_id", F.lit(5)) != 2, F.col("html"))
    return page_errors(walked(pages.withColumn("html", lost), "indeed")).drop("captured_at")


def spark_queries() -> dict:
    return {
        "bronze_indeed_runs": q_bronze_indeed_runs,
        "silver_of_runs": q_silver_of_runs,
        "page_errors": q_page_errors,
        "phrase_mentions": q_phrase_mentions,
        "bronze_dreamjob_stored": q_bronze_dreamjob_stored,
        "page_articles": q_page_articles,
        "bronze_rekrute_pages": _bronze_from_pages("rekrute"),
        "bronze_dreamjob_pages": _bronze_from_pages("dreamjob"),
        "bronze_indeed_pages": _bronze_from_pages("indeed"),
        "bronze_linkedin_pages": _bronze_from_pages("linkedin"),
        "extract_dreamjob": q_extract_dreamjob,
        "extract_indeed": q_extract_indeed,
        "extract_linkedin": q_extract_linkedin,
        "first_seen_cards": q_first_seen_cards,
        "bronze_profile": q_bronze_profile,
        "fct_grain_check": q_fct_grain_check,
    }


# ---------------------------------------------------------------- oracle SQL
def _texts_cte() -> list[tuple[str, str]]:
    return [("t", offer_texts_sql())]


def oracle_queries() -> dict:
    combined = _py_strip_sql("COALESCE(excerpt, '') || ' ' || COALESCE(description, '')")
    dreamjob = f"""SELECT doc_id,
    {X.company_from_title_sql('headline')} AS company,
    COALESCE({X.city_sql('excerpt')}, {X.city_sql('description')}) AS location,
    {X.contracts_sql('combined')} AS contract_type,
    {X.education_sql('combined', 'dreamjob')} AS education,
    {X.experience_sql('combined', 'dreamjob')} AS experience,
    {X.functions_sql(X.joined_text_sql('title', 'combined'), 'dreamjob', D.FUNCTION_LABELS)} AS "function"
FROM (SELECT *, {combined} AS combined FROM t)"""
    indeed_texts = f"""SELECT doc_id,
    COALESCE({X.contracts_sql('description', True)}, {clean_text_sql('card_meta')}) AS contract_type,
    {X.education_sql('description', 'indeed')} AS education,
    {X.experience_sql('description', 'indeed')} AS experience,
    {X.functions_sql(X.joined_text_sql('title', 'description'), 'indeed', D.FUNCTION_LABELS)} AS "function",
    {X.sectors_sql('description', D.SECTOR_LABELS)} AS sector
FROM t"""
    field_case = "CASE " + " ".join(
        "WHEN " + " OR ".join(f"contains(lower(x.h), '{n}')" for n in needles) + f" THEN '{name}'"
        for name, needles in D.CRITERIA_FIELDS) + " END"
    mapped = f"list_transform(criteria, lambda x: {{'field': {field_case}, 'value': {clean_text_sql('x.v')}}})"

    def last(name):
        return f"(list_filter(m, lambda y: y.field = '{name}'))[-1].value"
    linkedin = f"""SELECT doc_id, cut AS url, {linkedin_job_id_sql('cut')} AS job_id,
    COALESCE(NULLIF({last('experience_level')}, ''), {X.experience_sql('description', 'linkedin')}) AS experience,
    {last('contract_type')} AS contract_type, {last('function')} AS "function", {last('sector')} AS sector,
    {X.education_sql('description', 'indeed')} AS education
FROM (SELECT *, split_part(url, '?', 1) AS cut, {mapped} AS m FROM t)"""
    kw_list = ", ".join(f"'{k}'" for k in KEYWORDS)
    cards = f"""SELECT doc_id, kw_rank, list_extract([{kw_list}], CAST((doc_id + kw_rank) % 5 AS INTEGER) + 1) AS keyword,
    CAST(floor(doc_id / 25) AS BIGINT) % 3 AS page, doc_id % 25 AS pos,
    'https://www.linkedin.com/jobs/view/offer-' || CAST(CAST(floor(doc_id / 2) AS BIGINT) AS VARCHAR) AS url
FROM (SELECT doc_id, unnest(range(0, CAST(doc_id % 3 AS INTEGER) + 1)) AS kw_rank FROM documents)"""
    first_seen = f"""SELECT doc_id, CAST(kw_rank AS INTEGER) AS kw_rank, keyword, page, pos, url FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY url ORDER BY kw_rank, page, pos) AS rn FROM ({cards})) WHERE rn = 1"""
    from souk.plans import page_oracle
    from souk.sources.offers import BRONZE_OFFERS_SQL

    def spelled(c):
        return f"' ' || array_to_string(list_filter(regexp_split_to_array(lower({c}), {sql_quote(NON_WORD)}), lambda x: x <> ''), ' ') || ' '"
    phrases = f"""WITH d AS (SELECT doc_id, {spelled('text')} AS t FROM documents WHERE text IS NOT NULL),
p AS (SELECT DISTINCT array_to_string(string_split(text, ' ')[1:1 + doc_id % 3], ' ') AS phrase FROM documents),
s AS (SELECT phrase, {spelled('phrase')} AS needle FROM p WHERE phrase <> '')
SELECT doc_id, phrase FROM d JOIN s ON contains(t, needle) WHERE trim(needle) <> ''"""
    indeed = page_oracle.oracle_queries()["bronze_indeed_pages"]
    again = f"SELECT * FROM ({indeed}) UNION ALL SELECT * REPLACE (scraped_at + INTERVAL {RUN_TWO_DAYS} DAY AS scraped_at) FROM ({indeed})"
    return {
        **page_oracle.oracle_queries(),
        "bronze_indeed_runs": again,
        "silver_of_runs": f"""SELECT md5(url) AS job_id, url, max(scraped_at) AS scraped_at,
    CAST(max(length(trim(description))) AS INTEGER) AS description_length FROM ({again}) WHERE job_title IS NOT NULL GROUP BY url""",
        "page_errors": page_oracle.page_errors_sql(),
        "phrase_mentions": phrases,
        "bronze_dreamjob_stored": f"SELECT * REPLACE (left(description, {D.DESCRIPTION_MAX_CHARS}) AS description) FROM ({page_oracle.oracle_queries()['bronze_dreamjob_pages']})",
        "extract_dreamjob": oracle.with_ctes(_texts_cte(), dreamjob),
        "extract_indeed": oracle.with_ctes(_texts_cte(), indeed_texts),
        "extract_linkedin": oracle.with_ctes(_texts_cte(), linkedin),
        "first_seen_cards": first_seen,
        "bronze_profile": oracle.with_ctes([("bronze", BRONZE_OFFERS_SQL)], completeness_profile_sql("bronze", "source")),
        "fct_grain_check": oracle.with_ctes(oracle.full_ctes(),
                                            "SELECT job_id, COUNT(*) AS n_rows FROM fct_jobs GROUP BY job_id "
                                            "HAVING COUNT(*) > 1"),
    }
