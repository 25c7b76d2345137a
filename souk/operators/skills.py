"""Dictionary skill matcher.

The reference cross-joins every offer with every skill and keeps the pairs
whose regex matches.  Here the dictionary is small and fixed, so it is unrolled
into literals: one ``CASE WHEN text ~* pattern THEN skill END`` per entry,
collected into an array, filtered and exploded.  The plan is a single
projection + ``Generate`` after the scan — no nested-loop join, no shuffle,
whole texts are scanned.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.regex import fold_lower
from souk.functions.rules import dictionary, found_words, pg_iregex
from souk.rulesets.catalog import SKILLS


def _as_intended(pattern: str) -> str:
    """Read PostgreSQL's ``\\b`` (a backspace) as the word boundary the
    dictionary's author meant: start of an alternative -> ``\\m``, else ``\\M``."""
    pattern = re.sub(r"(^|\|)\\b", r"\1\\m", pattern)
    return pattern.replace(r"\b", r"\M")


def skill_rows(intended: bool = False):
    """(skill_id, name, pattern, category, condition), ids by (category, name)
    in binary order, as ``ROW_NUMBER() OVER (ORDER BY skill_category, skill_name)``."""
    ordered = sorted(SKILLS, key=lambda s: (s[2], s[0]))
    return [(i + 1, name, pattern, cat, pg_iregex(_as_intended(pattern) if intended else pattern))
            for i, (name, pattern, cat) in enumerate(ordered)]


def match_skills(df: DataFrame, text_col: str, intended: bool = False) -> DataFrame:
    """Add (skill_id, skill_name, skill_category) rows for every skill found in
    ``text_col``; offers without a skill produce no row.

    The text is lower-cased and cut into words once per row; a pattern that is
    a set of whole words is answered from them, others run their regex only
    where the words they need are there.
    """
    keep = [c for c in df.columns]
    text, folded, words = F.col(text_col), F.col("_folded"), F.col("_words")
    skills = skill_rows(intended)
    hits = F.array(*[
        F.when(cond.spark(text, folded, words),
               F.struct(F.lit(i).cast("bigint").alias("skill_id"), F.lit(name).alias("skill_name"),
                        F.lit(cat).alias("skill_category")))
        for i, name, _, cat, cond in skills])
    found = (df.select(*keep, fold_lower(text).alias("_folded"))
             .select("*", found_words(folded, dictionary([(name, cond) for _, name, _, _, cond in skills])).alias("_words"))
             .select(*keep, F.filter(hits, lambda h: h.isNotNull()).alias("_hits")))
    # explode_outer + null filter: a plain explode makes Catalyst infer a
    # ``size(_hits) > 0`` filter below the projection, evaluating every pattern twice.
    return (found.select(*keep, F.explode_outer("_hits").alias("_skill"))
            .filter(F.col("_skill").isNotNull())
            .select(*keep, "_skill.skill_id", "_skill.skill_name", "_skill.skill_category"))
