from pyspark.sql import functions as F

from conftest import one_col
from souk.functions import text as T


def run(spark, values, fn):
    df = one_col(spark, values)
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_pg_initcap(spark):
    got = run(spark, ["o'NEIL-SMITH & CO/ab l’oréal 3m école", None, "", "   "], T.pg_initcap)
    assert got == ["O'Neil-Smith & Co/Ab L’Oréal 3m École", None, "", "   "]


def test_clean_text(spark):
    got = run(spark, ["  a \t b\n\nc  ", "", None, "   ", "x y"], T.clean_text)
    assert got == ["a b c", None, None, "", "x y"]


def test_trimmed_split_part(spark):
    got = run(spark, ["Casablanca (Maroc)", "Rabat", None, "(x"], lambda c: T.trimmed_split_part(c, "("))
    assert got == ["Casablanca", "Rabat", None, ""]


def test_split_title_location(spark):
    df = one_col(spark, ["Data Engineer | Rabat (Maroc)", "No bar", "a | b | c "])
    t, loc = T.split_title_location(F.col("v"))
    assert [tuple(r) for r in df.select(t, loc).collect()] == [
        ("Data Engineer", "Rabat (Maroc)"), ("No bar", None), ("a", "c")]


def test_telework_suffix(spark):
    df = spark.createDataFrame([("CDI", "Type de contrat : CDI Télétravail : Hybride"),
                                (None, "Type de contrat : Télétravail : Oui"),
                                ("CDD", "Type de contrat : CDD Télétravail : Non"),
                                ("CDI", "Type de contrat : CDI")], "ct string, li string")
    got = [r[0] for r in df.select(T.telework_contract("ct", "li")).collect()]
    assert got == ["CDI - Hybride", "Télétravail Oui", "CDD - Télétravail Non", "CDI"]


def test_linkedin_job_id(spark):
    got = run(spark, ["/jobs/view/x-at-y-3912345678", "https://l.com/a-1234567/", "https://l.com/a-39123456789/?x=1",
                      None, "https://l.com/a-39123456789x"], T.linkedin_job_id)
    assert got == ["3912345678", None, "39123456789", None, None]


def test_company_from_alt(spark):
    got = run(spark, ["Leyton Emploi Recrutement", "Capgemini Engineering Emploi Recrutement", "CIMR",
                      "Recrutement Maroc", "", None, " - OCP Maroc —"], T.company_from_alt)
    assert got == ["Leyton", "Capgemini Engineering", "CIMR", None, None, None, "OCP"]


def test_truncate_and_url(spark):
    got = run(spark, ["x" * 6000, None, ""], T.truncate_description)
    assert [len(g) for g in got] == [6000, 0, 0]  # whole, unless a caller asks for a cut
    got = run(spark, ["x" * 6000, None, ""], lambda c: T.truncate_description(c, 5000))
    assert [len(g) for g in got] == [5000, 0, 0]
    got = run(spark, ["/offre/1.html", "https://a.b/c"], T.absolute_url)
    assert got == ["https://www.rekrute.com/offre/1.html", "https://a.b/c"]


def test_clean_text_unicode_whitespace(spark):
    got = run(spark, ["a  b c", " x　", "\u0085y\x1c"], T.clean_text)
    assert got == ["a b c", "x", "y"]  # as Python's str.split()/strip() whitespace
