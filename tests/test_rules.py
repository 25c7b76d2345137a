import datetime as dt

from pyspark.sql import functions as F

from conftest import one_col
from souk.functions.rules import first_match
from souk.plans import gold
from souk.rulesets import warehouse as R


def label(spark, values, fn):
    df = one_col(spark, values)
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_city_and_region_traps(spark):
    vals = ["Fez", "Rabat Settat", "Casablanca 20040", "Mâchouar de Casablanca", "FÈS-Meknès", "ville nouvelle-est",
            "Settat", "Meknès", "Nador", "Berrechid", "Safi", None]
    assert label(spark, vals, gold.city_key) == [
        "Fès", "Rabat", "Casablanca", "Casablanca", "Fès", "Ville Nouvelle-Est", "Settat", "Meknès", "Nador",
        "Berrechid", "Safi", None]
    assert label(spark, vals, gold.region_of) == [
        "Non spécifiée", "Casablanca-Settat", "Casablanca-Settat", "Casablanca-Settat", "Fès-Meknès",
        "Non spécifiée", "Casablanca-Settat", "Fès-Meknès", "Oriental", "Casablanca-Settat", "Marrakech-Safi",
        "Non spécifiée"]


def test_contract_traps(spark):
    vals = ["Full-time", "CDD | Temps plein", "CDD", "International contract", "Stage CDI", None]
    main = lambda c: gold.contract_main(c)
    assert label(spark, vals, lambda c: gold.contract_key(main(c))) == ["Autre", "CDD", "CDD", "Stage", "CDI", "Autre"]
    assert label(spark, vals, lambda c: gold.contract_category(main(c))) == [
        "Autre", "Long terme", "Moyen terme", "Formation", "Long terme", "Autre"]


def test_education_copies_differ(spark):
    vals = ["BSc", "Ingénieur", "engineering degree", "Associate degree", "Bac + 5 et plus", "PhD", None]
    assert label(spark, vals, lambda c: gold.education_key(c, "dim")) == [
        "Bac+3 / Licence", "Autre / Non spécifié", "Bac+5 / Master / Ingénieur", "Bac+2 / BTS / DUT",
        "Bac+5 / Master / Ingénieur", "Doctorat", "Autre / Non spécifié"]
    assert label(spark, vals, lambda c: gold.education_key(c, "fact")) == [
        "Autre / Non spécifié", "Autre / Non spécifié", "Autre / Non spécifié", "Autre / Non spécifié",
        "Bac+5 / Master / Ingénieur", "Doctorat", "Autre / Non spécifié"]


def test_experience_copies_and_levels(spark):
    vals = ["3-5", "1 an à 3 ans", "Mid-Senior level", "0-1 ans", "De 5 à 10 ans", "20 ans", "Not Applicable"]
    assert label(spark, vals, lambda c: gold.experience_key(c, "dim")) == [
        "Senior / Confirmé", "Junior / Débutant", "Intermédiaire", "Junior / Débutant", "Senior / Confirmé",
        "Non spécifié", "Non spécifié"]
    assert label(spark, vals, lambda c: gold.experience_key(c, "fact")) == [
        "Non spécifié", "Intermédiaire", "Intermédiaire", "Junior / Débutant", "Senior / Confirmé",
        "Non spécifié", "Non spécifié"]
    assert label(spark, vals, lambda c: first_match(c, R.EXPERIENCE_LEVEL_RULES, 0)) == [0, 3, 4, 2, 4, 0, 0]


def test_quality_score_half_away_from_zero(spark):
    flags = ["has_company", "has_city", "has_function", "has_contract", "has_sector", "has_education",
             "has_experience"]
    df = spark.createDataFrame([(1, 1, 1, 1, 0, 0, 0, 200), (1, 0, 0, 0, 0, 0, 0, 10), (1,) * 7 + (500,),
                                (0,) * 7 + (0,)], ", ".join(f"{f} int" for f in flags) + ", description_length int")
    assert [r[0] for r in df.select(gold.quality_score()).collect()] == [63, 13, 100, 0]


def test_skills_golden(spark):
    from souk.operators.skills import match_skills
    df = spark.createDataFrame([(1, "R&D, git, K8s."), (2, "a_SQL_b Hadoop2 JavaScript"), (3, "ML and Natural Language"),
                                (4, "Apache  Spark, POWERBI, scikit learn"), (5, "PostgreSQL / Postgres")],
                               "job_id int, t string")
    got = {}
    for r in match_skills(df, "t").collect():
        got.setdefault(r.job_id, []).append(r.skill_name)
    assert sorted(got[1]) == ["Git", "Kubernetes", "R"]
    assert 2 not in got and 3 not in got
    assert sorted(got[4]) == ["Power BI", "Scikit-learn", "Spark"]
    assert got[5] == ["PostgreSQL"]
    intended = {r.skill_name for r in match_skills(df.filter("job_id = 3"), "t", intended=True).collect()}
    assert intended == {"Machine Learning", "NLP"}


def test_calendar(spark):
    d = gold.dim_date(spark, "2026-04-26")
    assert d.count() == 1096
    r = d.filter(F.col("full_date") == dt.date(2026, 1, 4)).first()
    assert (r.day_of_week, r.day_name, r.is_weekend, r.week, r.year_quarter) == (0, "Dimanche", True, 1, "2026-Q1")
    r = d.filter(F.col("full_date") == dt.date(2026, 4, 26)).first()
    assert (r.date_id, r.is_today, r.month_name, r.year_month) == (20260426, True, "Avril", "2026-04")
    assert d.filter("is_last_7_days").count() == 7 + 1 + (dt.date(2026, 12, 31) - dt.date(2026, 4, 26)).days
