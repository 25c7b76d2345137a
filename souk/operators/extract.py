"""Field extraction from offer text, as column rules.

The collectors run ordered regex dictionaries over an offer's title and whole
text.  Here every dictionary is a rule list (``rules.first_match`` /
``rules.all_matches``), every numeric pattern a ``regexp_extract`` chain — all
Catalyst expressions, evaluated in the scan's stage with no Python worker.
Each extractor has a ``*_sql`` twin for the DuckDB oracle.

Texts are searched whole, and once for all dictionaries: ``with_folded`` cuts
a lower-cased copy (``fold_lower``) into words and keeps those that any
dictionary asks for.  A pattern that is a set of whole words is answered from
them; others run their regex only where the words they need are there.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from souk.functions.regex import fold_lower, sql_quote, to_java, to_java_folded, to_re2
from souk.functions.text import clean_text
from souk.functions.rules import (all_matches, all_matches_sql, dictionary, first_match, first_match_sql, found_words,
                                  literal_gate, py_isearch)
from souk.rulesets import extraction as X


def _word(term: str) -> str:
    return rf"\b{re.escape(term)}\b"


# rule lists built from the dictionaries (order preserved)
CITY_RULES = [(v, py_isearch(_word(v))) for v in X.CITIES]
CONTRACT_FR_RULES = [(label, py_isearch(p)) for label, p in X.CONTRACTS_FR]
CONTRACT_FR_EN_RULES = [(label, py_isearch(p)) for label, p in X.CONTRACTS_FR_EN]
EDUCATION_DREAMJOB_RULES = [(label, py_isearch(p)) for label, p in X.EDUCATION_DREAMJOB]
EDUCATION_INDEED_RULES = [(label, py_isearch(p)) for label, p in X.EDUCATION_INDEED]
FUNCTION_DREAMJOB_RULES = [(m, py_isearch(_word(m))) for m in X.FUNCTIONS_DREAMJOB]
FUNCTION_INDEED_RULES = [(m, py_isearch(_word(m))) for m in X.FUNCTIONS_INDEED]
SECTOR_RULES = [(label, py_isearch(p)) for label, p in X.SECTORS]
WORDS_DREAMJOB = [(label, py_isearch(p)) for label, p in X.EXPERIENCE_WORDS_DREAMJOB]
WORDS_INDEED = [(label, py_isearch(p)) for label, p in X.EXPERIENCE_WORDS_INDEED]
WANTED = dictionary(CITY_RULES, CONTRACT_FR_RULES, CONTRACT_FR_EN_RULES, EDUCATION_DREAMJOB_RULES, EDUCATION_INDEED_RULES,
                    FUNCTION_DREAMJOB_RULES, FUNCTION_INDEED_RULES, SECTOR_RULES, WORDS_DREAMJOB, WORDS_INDEED)


def joined_text(*parts) -> Column:
    """``" ".join(t for t in parts if t)`` — falsy parts are skipped."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws(" ", *[F.when(c != "", c) for c in cols])


def joined_text_sql(*parts: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"NULLIF({p}, '')" for p in parts) + ")"


class Text:
    """A text column, its folded copy and the dictionaries' words in it, shared by all rules of one row."""

    def __init__(self, c: Column, folded: Column | None = None, words: Column | None = None):
        self.c = c
        self.folded = folded
        self.words = words


def with_folded(df, *names: str, words: bool = True):
    """Add ``fold_lower`` copies of text columns as real columns, so one row's
    rules share a single lower-cased copy (inlined, it would be recomputed by
    every rule inside the interpreted array filter), and the words found in each.

    ``words=False`` leaves that pass out, for callers of one or two short
    dictionaries: it costs about as much as thirty literals' prefilters."""
    df = df.select("*", *[fold_lower(F.col(n)).alias(f"__folded_{n}") for n in names])
    if not words:
        return df
    return df.select("*", *[found_words(folded(n), WANTED).alias(f"__words_{n}") for n in names])


def text(name: str, words: bool = True) -> Text:
    """The ``Text`` of a column prepared by ``with_folded``."""
    return Text(F.col(name), F.col(f"__folded_{name}"), F.col(f"__words_{name}") if words else None)


def folded(name: str) -> Column:
    return F.col(f"__folded_{name}")


def joined_words(*parts: str) -> Column:
    """The words found in texts that are joined with a space or other white space between them."""
    out = F.array().cast("array<string>")
    for p in parts:
        out = F.array_union(out, F.coalesce(F.col(f"__words_{p}"), F.array().cast("array<string>")))
    return out


def with_folded_joins(df, joins: dict[str, tuple[str, ...]], strip: bool = False):
    """Add ``name`` = parts joined by one space (falsy parts skipped, as
    ``joined_text``) together with its folded copy built from the parts'
    folded copies — no extra pass over the text.  Lower-casing works per
    character except Greek final sigma, whose context a space separator
    isolates, so folding the join equals joining the folds."""
    cols = []
    for name, parts in joins.items():
        cols.append(joined_text(*parts).alias(name))
        cols.append(F.concat_ws(" ", *[F.when(folded(p) != "", folded(p)) for p in parts]).alias(f"__folded_{name}"))
        cols.append(joined_words(*parts).alias(f"__words_{name}"))
    return df.select("*", *cols)


def city(t: Text) -> Column:
    """First gazetteer city named as a whole word."""
    return first_match(t.c, CITY_RULES, None, t.folded, t.words)


def contracts(t: Text, english: bool = False) -> Column:
    """Every contract label found, in dictionary order, joined ' - '."""
    return all_matches(t.c, CONTRACT_FR_EN_RULES if english else CONTRACT_FR_RULES, " - ", None, t.folded, t.words)


def education(t: Text, platform: str = "dreamjob") -> Column:
    """First education level found (Dreamjob vs Indeed/LinkedIn order)."""
    rules = EDUCATION_DREAMJOB_RULES if platform == "dreamjob" else EDUCATION_INDEED_RULES
    return first_match(t.c, rules, None, t.folded, t.words)


def functions(t: Text, platform: str = "dreamjob", k: int | None = None) -> Column:
    """The job functions found (the first ``k`` if given), joined ' - '."""
    rules = FUNCTION_DREAMJOB_RULES if platform == "dreamjob" else FUNCTION_INDEED_RULES
    return all_matches(t.c, rules, " - ", k, t.folded, t.words)


def sectors(t: Text, k: int | None = None) -> Column:
    """The sectors found (the first ``k`` if given), joined ' - '."""
    return all_matches(t.c, SECTOR_RULES, " - ", k, t.folded, t.words)


def _years(t: "Text", pattern: str) -> tuple[Column, Column]:
    if t.folded is None:
        src, java = t.c, to_java(pattern, ignore_case=True)
    else:  # groups are digits, identical in the folded copy
        src, java = t.folded, to_java_folded(pattern)
    g1 = F.regexp_extract(src, java, 1)
    value = F.concat(g1, F.lit(" ans"))
    if re.compile(pattern).groups == 2:
        g2 = F.regexp_extract(src, java, 2)
        value = F.when(g2 != "", F.concat(g1, F.lit("-"), g2, F.lit(" ans"))).otherwise(value)
    hit = src.rlike(java)
    return (hit if t.folded is None else literal_gate(pattern, t.folded, hit)), value


def experience(t: Text, platform: str = "dreamjob") -> Column:
    """First numeric pattern -> 'a-b ans' / 'a ans', else word levels
    (Dreamjob / Indeed), else NULL.  LinkedIn has no word fallback."""
    patterns = {"dreamjob": X.EXPERIENCE_DREAMJOB, "indeed": X.EXPERIENCE_INDEED,
                "linkedin": X.EXPERIENCE_LINKEDIN}[platform]
    words = {"dreamjob": WORDS_DREAMJOB, "indeed": WORDS_INDEED, "linkedin": []}[platform]
    out = None
    for p in patterns:
        hit, value = _years(t, p)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    for label, cond in words:
        out = out.when(cond.spark(t.c, t.folded, t.words), F.lit(label))
    return out


def _years_sql(c: str, pattern: str) -> tuple[str, str]:
    re2 = sql_quote(to_re2(pattern, ignore_case=True))
    g1 = f"regexp_extract({c}, {re2}, 1)"
    value = f"{g1} || ' ans'"
    if re.compile(pattern).groups == 2:
        g2 = f"regexp_extract({c}, {re2}, 2)"
        value = f"CASE WHEN {g2} <> '' THEN {g1} || '-' || {g2} || ' ans' ELSE {value} END"
    return f"regexp_matches({c}, {re2})", value


def experience_sql(c: str, platform: str = "dreamjob") -> str:
    patterns = {"dreamjob": X.EXPERIENCE_DREAMJOB, "indeed": X.EXPERIENCE_INDEED,
                "linkedin": X.EXPERIENCE_LINKEDIN}[platform]
    words = {"dreamjob": WORDS_DREAMJOB, "indeed": WORDS_INDEED, "linkedin": []}[platform]
    arms = [_years_sql(c, p) for p in patterns]
    arms += [(cond.sql(c), sql_quote(label)) for label, cond in words]
    return "CASE " + " ".join(f"WHEN {w} THEN {v}" for w, v in arms) + " END"


def city_sql(c: str) -> str:
    return first_match_sql(c, CITY_RULES)


def contracts_sql(c: str, english: bool = False) -> str:
    return all_matches_sql(c, CONTRACT_FR_EN_RULES if english else CONTRACT_FR_RULES, " - ")


def education_sql(c: str, platform: str = "dreamjob") -> str:
    return first_match_sql(c, EDUCATION_DREAMJOB_RULES if platform == "dreamjob" else EDUCATION_INDEED_RULES)


def functions_sql(c: str, platform: str = "dreamjob", k: int | None = None) -> str:
    return all_matches_sql(c, FUNCTION_DREAMJOB_RULES if platform == "dreamjob" else FUNCTION_INDEED_RULES,
                           " - ", k)


def sectors_sql(c: str, k: int | None = None) -> str:
    return all_matches_sql(c, SECTOR_RULES, " - ", k)


# ------------------------------------------------------- X6 LinkedIn criteria


def criteria_field(items) -> Column:
    """Name the field each (header, value) pair fills; the first test that
    matches the header wins, unmatched pairs are ignored."""
    def field(x):
        h = F.lower(x["h"])
        out = None
        for name, needles in X.CRITERIA_FIELDS:
            test = h.contains(needles[0])
            for n in needles[1:]:
                test = test | h.contains(n)
            out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
        return F.struct(out.alias("field"), clean_text(x["v"]).alias("value"))
    return F.transform(items, field)


def criteria_value(mapped: Column, name: str) -> Column:
    """Later pairs overwrite earlier ones: the last pair for the field wins."""
    return F.try_element_at(F.filter(mapped, lambda m: m["field"] == name), F.lit(-1))["value"]



# ---------------------------------------------------------------- X12 company
_COMPANY_STRIP = "^[ \\-–—,.:]+|[ \\-–—,.:]+$"


def company_from_title(title, shortest: int = X.COMPANY_SHORTEST, longest: int | None = X.COMPANY_LONGEST) -> Column:
    """The first pattern whose captured name (stripped of `` -–—,.:``) has
    ``shortest`` to ``longest`` characters (None: any more); NULL otherwise."""
    t = F.col(title) if isinstance(title, str) else title
    out = None
    for p in X.COMPANY_FROM_TITLE:
        java = to_java(p, ignore_case=True)
        name = F.regexp_replace(F.regexp_extract(t, java, 1), _COMPANY_STRIP, "")
        ok = t.rlike(java) & (F.length(name) >= shortest)
        ok = ok if longest is None else ok & (F.length(name) <= longest)
        out = F.when(ok, name) if out is None else out.when(ok, name)
    return out


def company_from_title_sql(c: str) -> str:
    arms = []
    for p in X.COMPANY_FROM_TITLE:
        re2 = sql_quote(to_re2(p, ignore_case=True))
        name = f"regexp_replace(regexp_extract({c}, {re2}, 1), {sql_quote(_COMPANY_STRIP)}, '', 'g')"
        arms.append(f"WHEN regexp_matches({c}, {re2}) AND length({name}) BETWEEN {X.COMPANY_SHORTEST} AND {X.COMPANY_LONGEST} THEN {name}")
    return "CASE " + " ".join(arms) + " END"
