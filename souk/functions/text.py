"""Scalar text functions as Catalyst expressions.

Each helper returns a ``Column``; helpers used by oracle queries also have a
``*_sql`` twin that renders the same logic for DuckDB.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from souk.functions.regex import SPACE, sql_quote, to_java, to_re2
from souk.rulesets import extraction as X

_ALNUM_RUNS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pg_initcap(c) -> Column:
    """PostgreSQL ``INITCAP``: upper-case the first letter of every run of
    letters/digits, lower-case the rest (Spark's ``initcap`` only breaks on
    spaces, so ``O'neil-smith`` would come out wrong)."""
    runs = F.regexp_extract_all(F.lower(col(c)), F.lit(_ALNUM_RUNS), 1)
    return F.array_join(
        F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))),
        "")


def pg_initcap_sql(c: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({c}), {sql_quote(_ALNUM_RUNS)}), "
            f"lambda w: upper(w[1]) || w[2:]), '')")


#: What Python's str.strip() removes: the white space of SPACE, character by character.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85" + "".join(c for c in map(chr, range(0x3001)) if unicodedata.category(c)[0] == "Z")


def py_strip(c) -> Column:
    """``str.strip()``: looks at the ends only, however long the text."""
    return F.btrim(col(c), F.lit(BLANKS))


def clean_text(c) -> Column:
    """Collector ``clean_text``: falsy -> NULL, whitespace runs -> one space, stripped."""
    c = col(c)
    squeezed = F.trim(F.regexp_replace(c, F.lit(f"[{SPACE}]+"), " "))
    return F.when(c.isNotNull() & (c != ""), squeezed)


def clean_text_sql(c: str) -> str:
    return (f"CASE WHEN {c} IS NOT NULL AND {c} <> '' THEN "
            f"trim(regexp_replace({c}, {sql_quote('[' + SPACE + ']+')}, ' ', 'g')) END")


def trimmed_split_part(c, delimiter: str) -> Column:
    """``TRIM(SPLIT_PART(c, delimiter, 1))``: no delimiter -> whole string, NULL -> NULL."""
    return F.trim(F.split_part(col(c), F.lit(delimiter), F.lit(1)))


def truncate_description(c, max_chars: int | None = None) -> Column:
    """Stored description, NULL/'' -> ''; whole unless ``max_chars`` is given.

    The collectors store the first ``X.DESCRIPTION_MAX_CHARS`` characters; a
    caller that wants that passes it.  Extraction rules read the whole text.
    """
    whole = F.coalesce(col(c), F.lit(""))
    return whole if max_chars is None else F.substring(whole, 1, max_chars)


def absolute_url(c, host: str = X.REKRUTE_HOST) -> Column:
    """Keep ``http…`` links, prefix the host on relative ones."""
    c = col(c)
    return F.when(c.startswith("http"), c).otherwise(F.concat(F.lit(host), c))


def split_title_location(title) -> tuple[Column, Column]:
    """``"Title | City (Maroc)"`` -> (``Title``, ``City (Maroc)``).

    The title keeps its first piece, the location is the last piece; both are
    stripped.  Without a bar the title is unchanged and the location NULL.
    """
    t = col(title)
    has_bar = t.contains("|")
    pieces = F.split(t, r"\|")
    new_title = F.when(has_bar, py_strip(F.element_at(pieces, 1))).otherwise(t)
    location = F.when(has_bar, py_strip(F.element_at(pieces, -1)))
    return new_title, location


def telework_contract(contract, li_text) -> Column:
    """Append the Rekrute telework mode to the contract label."""
    ct = col(contract)
    txt = col(li_text)
    out = ct
    for needle, suffix in reversed(X.TELEWORK_SUFFIXES):
        with_suffix = F.when(ct.isNotNull() & (ct != ""), F.concat(ct, F.lit(" - " + suffix))).otherwise(F.lit(suffix))
        out = F.when(txt.contains(needle), with_suffix).otherwise(out)
    return F.when(txt.contains("Télétravail"), out).otherwise(ct)


def linkedin_job_id(url) -> Column:
    """Native id ``-(\\d{8,})`` before ``/``, ``?`` or the end, else NULL."""
    got = F.regexp_extract(col(url), to_java(X.LINKEDIN_ID), 1)
    return F.when(got != "", got)


def linkedin_job_id_sql(c: str) -> str:
    return f"NULLIF(regexp_extract({c}, {sql_quote(to_re2(X.LINKEDIN_ID))}, 1), '')"


def url_without_query(url) -> Column:
    """LinkedIn card url cut at the first ``?``."""
    return F.substring_index(col(url), "?", 1)


def company_from_alt(alt) -> Column:
    """X11: drop the words Emploi/Recrutement/Maroc/Morocco, squeeze spaces,
    strip `` -–—`` at both ends; empty -> NULL."""
    a = col(alt)
    no_words = F.regexp_replace(a, F.lit(to_java(X.ALT_NOISE, ignore_case=True)), "")
    squeezed = F.regexp_replace(no_words, F.lit(f"[{SPACE}]+"), " ")
    stripped = F.regexp_replace(squeezed, F.lit("^[ \\-–—]+|[ \\-–—]+$"), "")
    return F.when(a.isNotNull() & (a != "") & (stripped != ""), stripped)
