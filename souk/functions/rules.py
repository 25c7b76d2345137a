"""Ordered rule classification.

A rule list is data: ``[(label, condition), ...]``.  ``first_match`` turns it
into one ``CASE WHEN`` chain (the first true condition wins), ``all_matches``
into a list of every matching label in rule order.  Both compile to plain
Catalyst expressions — no UDF, so they stay inside whole-stage codegen — and
the same rule list renders the equivalent DuckDB SQL for the oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from souk.functions.regex import (NON_WORD, required_literals, split_alternatives, sql_quote, to_java, to_java_folded, to_re2,
                                  whole_words)


class Cond:
    """A boolean test on one text column.

    ``spark(c, folded)`` may receive ``folded = fold_lower(c)`` computed once
    per row, and ``words = found_words(folded, ...)``, the dictionaries' words
    that the text holds.  A case-insensitive regex test is then answered from
    the words where its pattern is a set of whole words, runs only where the
    words it needs are there, or else checks a required literal with
    ``contains`` before the regex (same result, far less regex work).
    """

    def spark(self, c: Column, folded: Column | None = None, words: Column | None = None) -> Column:  # pragma: no cover - interface
        raise NotImplementedError

    def dictionary(self) -> set[str]:
        """The whole words that the test asks ``words`` for."""
        return set()

    def sql(self, c: str) -> str:  # pragma: no cover - interface
        raise NotImplementedError

    def __or__(self, other: "Cond") -> "Cond":
        return AnyOf([self, other])

    def __and__(self, other: "Cond") -> "Cond":
        return AllOf([self, other])

    def __invert__(self) -> "Cond":
        return Not(self)


class ILike(Cond):
    """``c ILIKE pattern`` (``%``/``_`` wildcards, case-insensitive)."""

    def __init__(self, pattern: str):
        self.pattern = pattern

    def spark(self, c, folded=None, words=None):
        return c.ilike(self.pattern)

    def sql(self, c):
        return f"({c} ILIKE {sql_quote(self.pattern)})"


class Search(Cond):
    """Regex search (match anywhere) in a given source dialect."""

    def __init__(self, pattern: str, ignore_case: bool = False, dialect: str = "py"):
        self.pattern = pattern
        self.ignore_case = ignore_case
        self.dialect = dialect

    def spark(self, c, folded=None, words=None):
        if not (self.ignore_case and folded is not None):
            return c.rlike(to_java(self.pattern, self.ignore_case, self.dialect))
        # existence only: each top-level alternative is its own gated search,
        # so every piece starts with a plain literal (Boyer-Moore in Java)
        out = None
        for alt in split_alternatives(self.pattern):
            piece = self._alternative(alt, folded, words)
            out = piece if out is None else out | piece
        return out

    def _alternative(self, alt: str, folded: Column, words: Column | None) -> Column:
        test = folded.rlike(to_java_folded(alt, self.dialect))
        known = whole_words(alt, self.dialect) if words is not None else None
        if known is None:
            return literal_gate(alt, folded, test)
        alone, together = known
        out = F.arrays_overlap(words, F.array(*map(F.lit, alone))) if alone else None
        for needed in together:
            gate = F.array_contains(words, needed[0])
            for w in needed[1:]:
                gate = gate & F.array_contains(words, w)
            out = gate & test if out is None else out | (gate & test)
        return out

    def dictionary(self):
        if not self.ignore_case:
            return set()
        known = [whole_words(alt, self.dialect) for alt in split_alternatives(self.pattern)]
        return {w for k in known if k for group in (k[0], *k[1]) for w in group}

    def sql(self, c):
        return f"regexp_matches({c}, {sql_quote(to_re2(self.pattern, self.ignore_case, self.dialect))})"


def literal_gate(pattern: str, folded: Column, test: Column) -> Column:
    """``test`` guarded by a ``contains`` check of the pattern's required literals."""
    literals = required_literals(pattern)
    if not literals:
        return test
    gate = folded.contains(literals[0])
    for lit in literals[1:]:
        gate = gate | folded.contains(lit)
    return gate & test


class AnyOf(Cond):
    def __init__(self, parts: Sequence[Cond]):
        self.parts = list(parts)

    def spark(self, c, folded=None, words=None):
        out = self.parts[0].spark(c, folded, words)
        for p in self.parts[1:]:
            out = out | p.spark(c, folded, words)
        return out

    def dictionary(self):
        return set().union(*(p.dictionary() for p in self.parts))

    def sql(self, c):
        return "(" + " OR ".join(p.sql(c) for p in self.parts) + ")"


class AllOf(Cond):
    def __init__(self, parts: Sequence[Cond]):
        self.parts = list(parts)

    def spark(self, c, folded=None, words=None):
        out = self.parts[0].spark(c, folded, words)
        for p in self.parts[1:]:
            out = out & p.spark(c, folded, words)
        return out

    def dictionary(self):
        return set().union(*(p.dictionary() for p in self.parts))

    def sql(self, c):
        return "(" + " AND ".join(p.sql(c) for p in self.parts) + ")"


class Not(Cond):
    def __init__(self, part: Cond):
        self.part = part

    def spark(self, c, folded=None, words=None):
        return ~self.part.spark(c, folded, words)

    def dictionary(self):
        return self.part.dictionary()

    def sql(self, c):
        return f"(NOT {self.part.sql(c)})"


def ilike(*patterns: str) -> Cond:
    """Any of several ILIKE patterns."""
    conds = [ILike(p) for p in patterns]
    return conds[0] if len(conds) == 1 else AnyOf(conds)


def pg_regex(pattern: str) -> Cond:
    """PostgreSQL ``~`` (case-sensitive search)."""
    return Search(pattern, ignore_case=False, dialect="pg")


def pg_iregex(pattern: str) -> Cond:
    """PostgreSQL ``~*`` (case-insensitive search)."""
    return Search(pattern, ignore_case=True, dialect="pg")


def py_isearch(pattern: str) -> Cond:
    """Python ``re.search(pattern, text, re.IGNORECASE)``."""
    return Search(pattern, ignore_case=True, dialect="py")


Rules = Sequence[tuple[object, Cond]]


def _lit_sql(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, (int, float)):
        return str(v)
    return sql_quote(v)


def dictionary(*rule_lists: Rules) -> list[str]:
    """All whole words that the rules ask for."""
    return sorted(set().union(*(cond.dictionary() for rules in rule_lists for _, cond in rules)))


def found_words(folded: Column, wanted: Sequence[str]) -> Column:
    """One pass over a folded text for all dictionaries: the wanted words that it holds."""
    return F.array_intersect(F.split(folded, NON_WORD), F.array(*map(F.lit, wanted)))


def first_match(c: Column, rules: Rules, default=None, folded: Column | None = None, words: Column | None = None) -> Column:
    """Label of the first rule whose condition holds, else ``default``.

    ``default`` may be a literal or a Column (e.g. a title-cased fallback).
    """
    out = None
    for label, cond in rules:
        test = cond.spark(c, folded, words)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    fallback = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(fallback)


def first_match_sql(c: str, rules: Rules, default_sql: str = "NULL") -> str:
    arms = "\n".join(f"    WHEN {cond.sql(c)} THEN {_lit_sql(label)}" for label, cond in rules)
    return f"CASE\n{arms}\n    ELSE {default_sql}\nEND"


def all_matches(c: Column, rules: Rules, sep: str = " - ", limit: int | None = None,
                folded: Column | None = None, words: Column | None = None) -> Column:
    """Every matching label in rule order, joined by ``sep``; NULL if none.

    ``limit`` keeps the first k labels (a top-k of the reference's feature).
    """
    # concat_ws skips NULLs and stays in generated code (an array filter would
    # not); the first k labels are the text before the k-th separator.
    assert all(sep not in str(label) for label, _ in rules), "a label contains the separator"
    joined = F.concat_ws(sep, *[F.when(cond.spark(c, folded, words), F.lit(label)) for label, cond in rules])
    if limit is not None:
        joined = F.substring_index(joined, sep, limit)
    return F.when(joined != "", joined)


def all_matches_sql(c: str, rules: Rules, sep: str = " - ", limit: int | None = None) -> str:
    items = ", ".join(f"CASE WHEN {cond.sql(c)} THEN {_lit_sql(label)} END" for label, cond in rules)
    hits = f"list_filter([{items}], lambda x: x IS NOT NULL)"
    if limit is not None:
        hits = f"({hits})[1:{limit}]"
    return f"NULLIF(array_to_string({hits}, {sql_quote(sep)}), '')"
