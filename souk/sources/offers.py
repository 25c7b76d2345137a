"""Bronze job-offer tables derived from the driver's ``documents`` table.

No given table holds job offers, so one offer per document is derived with
the deterministic formula of FIXTURES.md §4: categorical fields are picked
from fixed lists by ``doc_id`` (``pick(L)`` = element ``doc_id % len(L)``),
and the description is a rule-triggering sentence followed by the document's
**whole** text.  So that dimensions grow with the data, half of the places and
a third of the companies come from the customer of the order whose key is the
``doc_id``, another third of the companies are one dominant name, and the
capture time is that order's date, moved to our years.  The same formula is rendered for Spark (``bronze_offers``)
and for DuckDB (``BRONZE_OFFERS_SQL``) so the oracle sees identical input.

The combined frame carries every bronze column plus ``source``; the four
platform tables are projections of it (``bronze_table``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.regex import sql_quote
from souk.sources.schemas import BRONZE_COLUMNS

PLATFORM = ["rekrute", "dreamjob", "indeed", "linkedin"]
TITLE = ["Data Engineer", "Data Scientist H/F", "  Consultant BI  ", "Développeur Python",
         "Chef de projet Data", "Data Analyst Power BI", "Architecte Data", "ML Engineer",
         "Analyste SQL", "DevOps Kubernetes", "Big Data Engineer"]
COMPANY = ["capgemini engineering", "O'NEIL-SMITH & CO", "  attijari wafa bank ", "CIMR",
           "l'oréal maroc", "ab/cd group", "3m école", "LEYTON", "Capgemini Maroc", "oCP", "inwi",
           "deloitte-maroc", "   "]
LOCATION = ["Casablanca (Maroc)", "Casablanca 20040", "Mâchouar de Casablanca",
            "Rabat, Rabat-Salé-Kénitra, Maroc", "Fès", "Fez", "FÈS-Meknès", "Salé", "Témara",
            "Tanger (Maroc)", "Marrakech, Marrakech-Safi, Maroc", "Settat", "El Jadida", "Rabat Settat",
            "Maroc", "beni mellal", "ville nouvelle-est", "Agadir", "Dakhla", "Laayoune", "Oujda",
            "Kenitra", "  ", "Mohammedia", "Essaouira", "Khouribga", "Ouarzazate", "Ifrane", "Tétouan"]
CONTRACT = ["CDI", "CDI - Hybride", "CDD", "CDD | Temps plein", "Stage", "Stage CDI", "PFE", "Alternance",
            "Freelance", "Full-time", "Full time", "Temps partiel", "Intérim", "International contract", " "]
EDUCATION = ["Bac+5", "Bac + 5 et plus", "Master", "MSc", "Ingénieur", "engineering degree", "Bac+4",
             "Bac+3", "Licence", "BSc", "Bachelor", "Bac +2", "BTS", "Associate degree", "Doctorat", "PhD",
             "Autodidacte"]
EXPERIENCE = ["Débutant / Junior", "3-5 ans", "3-5", "0-1 ans", "0 à 2", "1 - 3 ans", "2-4", "De 5 à 10 ans",
              "20 ans", "4 ans", "1 an", "Mid-Senior level", "Entry level", "Internship", "Director",
              "Senior / Confirmé", "Associate", "1 an à 3 ans", "Not Applicable"]
SENTENCE = ["Profil Python, SQL et Apache Spark.", "Maîtrise de Power BI / PowerBI.", "5 ans d'expérience minimum.",
            "Stage ou CDI, Bac+5.", "Cabinet de conseil et banque.", "ML and NLP.", "R&D, git, K8s.",
            "Scikit-learn, sklearn, Pandas.", "3 à 5 ans d'expérience en ETL/ELT.",
            "2-4 years of experience with AWS.", "Poste basé à Rabat.", "JavaScript only", "",
            "experience of 7+ years, Bachelor's, SaaS", "débutant accepté, alternance", "PostgreSQL MySQL Oracle",
            "Tableau, Excel, Looker", "Amazon  Web   Services, Google Cloud", "senior data architect, télécom",
            "Unix, Docker, GitLab", "a_SQL_b Hadoop2", "dbt Airflow Kafka", "Natural Language"]
KEYWORD = [" data engineer ", "data analyst", "power bi"]
POSTED = {"rekrute": "du 26/04/2026 au 26/05/2026", "dreamjob": "26/04/2026", "linkedin": "2026-04-26"}
DOMINANT = "CIMR"
YEARS_ON = 27  # from the orders' years to the captures'
OUT_OF_CALENDAR = "2027-02-01 08:00:00"


def _pick(values: list[str], doc_id: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (doc_id % len(values)).cast("int") + 1)


def _null_if(mod: int, rem: int, value: Column, doc_id: Column) -> Column:
    return F.when(doc_id % mod != rem, value)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BUYER = ["c_custkey", "c_name", "n_name", "o_orderdate"]


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with the buyer of the order that has the document's number."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    buyers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    documents = read_table(spark, sf_dir, "documents")
    return documents.join(buyers.select("o_orderkey", *BUYER), F.col("doc_id") == F.col("o_orderkey"), "left").drop("o_orderkey")


def offers_from_documents(documents: DataFrame, keep_id: bool = False) -> DataFrame:
    """All bronze columns (+ ``source``) for one offer per document, of
    ``source_rows`` (plain documents have no buyers); ``keep_id`` also keeps
    ``doc_id``."""
    if "c_name" not in documents.columns:
        documents = documents.select("*", *[F.lit(None).cast("timestamp_ntz" if c == "o_orderdate" else "string").alias(c) for c in BUYER])
    d = F.col("doc_id")
    company = F.when(d % 3 == 0, _pick(COMPANY, d)).when(d % 3 == 1, F.lit(DOMINANT)).otherwise(F.col("c_name"))
    location = F.when(d % 2 == 0, _pick(LOCATION, d)).otherwise(F.concat(F.lit("Douar "), F.col("c_custkey").cast("string"), F.lit(", "), F.col("n_name")))
    platform = _pick(PLATFORM, d)
    k = F.when((d % 11 == 0) & (d >= 4), d - 4).otherwise(d)
    url = F.concat(F.lit("https://"), platform, F.lit(".example/offre-"), k.cast("string"))
    native = (F.lit(3900000000) + d - F.when(d % 44 == 7, 4).otherwise(0)).cast("string")
    scraped = (F.when(d % 97 == 5, F.lit(None).cast("timestamp_ntz"))
               .when(d % 101 == 0, F.lit(OUT_OF_CALENDAR).cast("timestamp_ntz"))
               .otherwise(F.timestamp_add("MINUTE", d % 1440, F.timestamp_add("YEAR", F.lit(YEARS_ON), F.col("o_orderdate").cast("timestamp_ntz")))))
    posted = F.when(platform == "rekrute", F.lit(POSTED["rekrute"])) \
        .when(platform == "dreamjob", F.lit(POSTED["dreamjob"])) \
        .when(platform == "linkedin", F.lit(POSTED["linkedin"]))
    return documents.select(
        *([d] if keep_id else []),
        _null_if(53, 9, _pick(TITLE, d), d).alias("job_title"),
        _null_if(17, 3, company, d).alias("company"),
        _null_if(19, 4, location, d).alias("location"),
        F.when(d % 3 != 0, F.concat(F.lit(" "), F.col("lang"), F.lit(" · "), F.col("source"), F.lit(" ")))
         .alias("summary"),
        F.concat(_pick(SENTENCE, d), F.lit(" "), F.col("text")).alias("description"),
        _null_if(8, 6, F.lit("Tech/IT"), d).alias("sector"),
        _null_if(10, 7, F.lit("Data Engineer"), d).alias("function"),
        _null_if(6, 5, _pick(EXPERIENCE, d), d).alias("experience"),
        _null_if(5, 1, _pick(EDUCATION, d), d).alias("education"),
        _null_if(7, 2, _pick(CONTRACT, d), d).alias("contract_type"),
        posted.alias("posted_date"),
        _null_if(59, 11, url, d).alias("url"),
        F.when((platform == "linkedin") & (d % 9 != 2), native).alias("job_id"),
        platform.alias("source"),
        F.when(platform.isin("indeed", "linkedin"), _pick(KEYWORD, d)).alias("search_keyword"),
        scraped.alias("scraped_at"),
    )


def bronze_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combined bronze rows of the four platforms."""
    return offers_from_documents(source_rows(spark, sf_dir))


def bronze_table(spark: SparkSession, sf_dir: str, platform: str) -> DataFrame:
    """One platform's raw table, with exactly that platform's columns."""
    return bronze_offers(spark, sf_dir).filter(F.col("source") == platform).select(*BRONZE_COLUMNS[platform])


# ---------------------------------------------------------------- DuckDB twin
def _pick_sql(values: list[str]) -> str:
    items = ", ".join(sql_quote(v) for v in values)
    return f"list_extract([{items}], CAST(doc_id % {len(values)} AS INTEGER) + 1)"


def _null_if_sql(mod: int, rem: int, value: str) -> str:
    return f"CASE WHEN doc_id % {mod} <> {rem} THEN {value} END"


def _bronze_sql() -> str:
    platform = _pick_sql(PLATFORM)
    k = "CASE WHEN doc_id % 11 = 0 AND doc_id >= 4 THEN doc_id - 4 ELSE doc_id END"
    url = f"'https://' || {platform} || '.example/offre-' || CAST({k} AS VARCHAR)"
    native = "CAST(3900000000 + doc_id - CASE WHEN doc_id % 44 = 7 THEN 4 ELSE 0 END AS VARCHAR)"
    scraped = (f"CASE WHEN doc_id % 97 = 5 THEN NULL "
               f"WHEN doc_id % 101 = 0 THEN TIMESTAMP '{OUT_OF_CALENDAR}' "
               f"ELSE o_orderdate + INTERVAL {YEARS_ON} YEAR + to_minutes(CAST(doc_id % 1440 AS BIGINT)) END")
    company = f"CASE doc_id % 3 WHEN 0 THEN {_pick_sql(COMPANY)} WHEN 1 THEN {sql_quote(DOMINANT)} ELSE c_name END"
    location = f"CASE WHEN doc_id % 2 = 0 THEN {_pick_sql(LOCATION)} ELSE 'Douar ' || c_custkey || ', ' || n_name END"
    posted = ("CASE " + " ".join(f"WHEN {platform} = {sql_quote(p)} THEN {sql_quote(v)}" for p, v in POSTED.items())
              + " END")
    return f"""SELECT doc_id,
    {_null_if_sql(53, 9, _pick_sql(TITLE))} AS job_title,
    {_null_if_sql(17, 3, company)} AS company,
    {_null_if_sql(19, 4, location)} AS location,
    CASE WHEN doc_id % 3 <> 0 THEN ' ' || lang || ' · ' || source || ' ' END AS summary,
    {_pick_sql(SENTENCE)} || ' ' || text AS description,
    {_null_if_sql(8, 6, "'Tech/IT'")} AS sector,
    {_null_if_sql(10, 7, "'Data Engineer'")} AS function,
    {_null_if_sql(6, 5, _pick_sql(EXPERIENCE))} AS experience,
    {_null_if_sql(5, 1, _pick_sql(EDUCATION))} AS education,
    {_null_if_sql(7, 2, _pick_sql(CONTRACT))} AS contract_type,
    {posted} AS posted_date,
    {_null_if_sql(59, 11, url)} AS url,
    CASE WHEN {platform} = 'linkedin' AND doc_id % 9 <> 2 THEN {native} END AS job_id,
    {platform} AS source,
    CASE WHEN {platform} IN ('indeed', 'linkedin') THEN {_pick_sql(KEYWORD)} END AS search_keyword,
    {scraped} AS scraped_at
FROM documents LEFT JOIN (orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) ON o_orderkey = doc_id"""


BRONZE_OFFERS_SQL = _bronze_sql()


# ------------------------------------------------------- texts for extraction
# Vocabulary of the derived extraction inputs (ours, like the lists above).
HEADLINE = ["{c} lance un recrutement", "{c} recrute des profils Data", "Postes ouverts chez {c} en 2026",
            "Recrutement {c}, postes ouverts", "Postes à pourvoir chez {c} : Data", "Offre d'emploi {c}",
            "Emploi chez {c}. Postulez", "Recrutement {c} : Data Engineer", "{c} renforce ses équipes"]
HEADLINE_COMPANY = ["Leyton", "CIMR", "Capgemini Maroc", "OCP Group", "Attijariwafa bank", "EMSI", "ab",
                    "Deloitte - Maroc", "Société Générale", "L'Oréal", "Inwi S.A."]
CARD_META = ["CDI | Temps plein", "", "Stage", "Full-time | Hybride", "Temps partiel", "  CDD  "]
URL_TAIL = ["", "/", "?refId=abc", "/?trk=public", "x", "?position=3&pageNum=0"]
CRITERIA_HEADER = ["Niveau hiérarchique", "Type d'emploi", "Fonction", "Secteurs", "Seniority level",
                   "Employment type", "Job function", "Industries", "Autre"]
CRITERIA_VALUE = ["Premier emploi", "Temps plein", "Informatique", "Services financiers", "Mid-Senior level",
                  "Full-time", "Engineering", "IT Services", "  Stage  "]


def offer_texts(documents: DataFrame) -> DataFrame:
    """Per document: title, excerpt, whole-text description, a recruitment
    headline, Indeed card metadata, a LinkedIn url and criteria pairs."""
    d = F.col("doc_id")
    headline = F.replace(_pick(HEADLINE, d), F.lit("{c}"), _pick(HEADLINE_COMPANY, d))
    url = F.concat(F.lit("https://www.linkedin.com/jobs/view/data-engineer-at-x-"),
                   (F.lit(3900000000) + d).cast("string"), _pick(URL_TAIL, d))
    criteria = F.array(*[
        F.struct(_pick(CRITERIA_HEADER, d + k).alias("h"), _pick(CRITERIA_VALUE, d * 3 + k).alias("v"))
        for k in range(4)])
    return documents.select(
        d,
        _pick(TITLE, d).alias("title"),
        F.when(d % 4 != 1, F.concat(F.lit("Offre basée à "), _pick(LOCATION, d))).alias("excerpt"),
        F.concat(_pick(SENTENCE, d), F.lit(" "), F.col("text")).alias("description"),
        headline.alias("headline"),
        F.when(d % 5 != 4, _pick(CARD_META, d)).alias("card_meta"),
        url.alias("url"),
        criteria.alias("criteria"),
    )


def offer_texts_sql() -> str:
    criteria = ", ".join(
        f"{{'h': {_pick_sql(CRITERIA_HEADER).replace('doc_id %', f'(doc_id + {k}) %')}, "
        f"'v': {_pick_sql(CRITERIA_VALUE).replace('doc_id %', f'(doc_id * 3 + {k}) %')}}}" for k in range(4))
    return f"""SELECT doc_id,
    {_pick_sql(TITLE)} AS title,
    CASE WHEN doc_id % 4 <> 1 THEN 'Offre basée à ' || {_pick_sql(LOCATION)} END AS excerpt,
    {_pick_sql(SENTENCE)} || ' ' || text AS description,
    replace({_pick_sql(HEADLINE)}, '{{c}}', {_pick_sql(HEADLINE_COMPANY)}) AS headline,
    CASE WHEN doc_id % 5 <> 4 THEN {_pick_sql(CARD_META)} END AS card_meta,
    'https://www.linkedin.com/jobs/view/data-engineer-at-x-' || CAST(3900000000 + doc_id AS VARCHAR)
        || {_pick_sql(URL_TAIL)} AS url,
    [{criteria}] AS criteria
FROM documents"""
