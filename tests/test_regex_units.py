"""Unit checks of the dialect translation, folding and the parallelism guard."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from souk.functions.regex import fold_lower, required_literals, to_java, to_java_folded, to_re2
from souk.sources.offers import read_table


def test_translation_constructs():
    assert to_java(r"\mR\M", True, "pg").startswith("(?iu)R(?<![")            # literal-first word start
    assert r"\x08" in to_java(r"\bML\M", True, "pg")                          # PG \b is a backspace
    assert "(?:(?<=" in to_java(r"x\b", True, "py")                           # exact Python boundary
    assert to_re2(r"\bCDI\b", True).startswith("(?i)(?:^|[^")                 # consumed boundary in RE2
    assert r"\p{Nd}" in to_java(r"(\d+)") and r"\p{Nd}" in to_re2(r"(\d+)")
    assert "[^" not in to_java(r"[\s]")                                       # \s inside a class stays a class
    assert to_java_folded(r"\bStage\b").startswith("stage(?<![")              # folded: lower-case literal first


def test_required_literals_shapes():
    assert required_literals(r"\m(Apache\s+)?Spark\M") == ["spark"]
    assert required_literals(r"(\d+)\s*ans?\s*(?:d['e ]+exp[ée]rience|minimum)") == ["rience", "minimum"]
    assert required_literals(r"(\d+)\s*(?:to|à)\s*(\d+)") is None
    assert required_literals(r"\bstage(?:s)?\b|\bintern\b") == ["stage", "intern"]


def test_fold_is_locale_free(spark):
    df = spark.createDataFrame([("INTERIM İ ſ K ı",)], "t string")
    assert df.select(fold_lower(F.col("t"))).first()[0] == "interim i s k i"


def test_lookaround_groups_require_nothing():
    assert required_literals(r"(?!foo)bar") == ["bar"]
    assert required_literals(r"(?<=x)(?:ab|cd)") == ["ab", "cd"]


def test_whole_words_of_patterns():
    from souk.functions.regex import whole_words
    assert whole_words(r"\bCDI\b") == (["cdi"], [])
    assert whole_words(r"\bint[ée]rim\b") == (["interim", "intérim"], [])
    assert whole_words(r"\bfull[- ]time\b") == ([], [("full", "time")])
    assert whole_words(r"\bBac\s*\+\s*5\b") == ([], [("bac", "5")])
    assert whole_words(r"\m(Apache\s+)?Spark\M", "pg") == (["spark"], [])
    assert whole_words(r"\mPower\s*BI\M", "pg") == (["powerbi"], [("power", "bi")])
    # a word that may go on, before or behind, isn't known to be whole
    assert whole_words(r"\baeronaut\w*\b") is None
    assert whole_words(r"exp[ée]rience") is None
    assert whole_words(r"\bdata") is None
    assert whole_words(r"\bdata mining") == ([], [("data",)])
    assert whole_words(r"(\d+) ans") is None
    assert whole_words(r"\bML\M", "pg") == ([], [("ml",)])  # PostgreSQL's \b is a backspace


def test_strip_is_python_s(spark):
    from pyspark.sql import functions as F
    from souk.functions.text import py_strip
    rows = ["", " a ", "  x y　\x85\x1c", "\n\t", "​z​", None, "a\x0b", "᠎b"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "k int, t string")
    got = [r[0] for r in df.orderBy("k").select(py_strip(F.col("t"))).collect()]
    assert got == [t if t is None else t.strip() for t in rows]
