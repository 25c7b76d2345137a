"""DuckDB SQL of the registered queries (the correctness oracle).

Written from the operators' definitions, set by set: every raw value that
occurs is labelled once in a small relation of its own (``city_labels`` …), a
dimension is a grouping of that relation, and an offer finds its ids through
its raw values.  Skills are one pass over the texts with 42 constant patterns.
Rule lists are shared with the Spark side, so a disagreement points at the
Spark machinery, not at transcribed rules.

Choices that both sides make: binary collation; NULL capture times count as
newest; ties broken by region / category / the de-dup tiebreak; a fixed
``asof`` day for relative calendar flags; the quality score computed inline
(no job_id self-join, see ``gold.fact_ids``).
"""

from __future__ import annotations

from souk.functions.regex import sql_quote, to_re2
from souk.functions.rules import first_match_sql
from souk.functions.text import pg_initcap_sql
from souk.operators.skills import skill_rows
from souk.plans.silver import CITY_DELIMITER, DEDUP_TIEBREAK, WITH_KEYWORD, WITH_NATIVE_ID
from souk.rulesets import catalog as C
from souk.rulesets import warehouse as R
from souk.sources.offers import BRONZE_OFFERS_SQL
from souk.sources.schemas import FLAG_COLUMNS, STAGED_COLUMNS, UNIFIED_COLUMNS

ASOF = "2026-04-26"  # reference day of dim_date's relative flags in registered queries
PLATFORMS = [p[1] for p in C.PLATFORMS]
FLAG_OF = dict(zip(FLAG_COLUMNS, ("company", "city", "function", "contract_type", "sector", "education", "experience")))


def q(name: str) -> str:
    """Quote identifiers that are SQL keywords."""
    return f'"{name}"' if name in ("function", "year", "month", "week", "quarter") else name


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


def _choice(column: str, arms: dict[str, str], other: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {sql_quote(k)} THEN {v}" for k, v in arms.items()) + f" ELSE {other} END"


def _in(names) -> str:
    return "source IN (" + ", ".join(sql_quote(n) for n in names) + ")"


def silver_ctes(bronze: str = BRONZE_OFFERS_SQL) -> list[tuple[str, str]]:
    """bronze -> staged (all platforms at once) -> jobs_unified."""
    places = {p: "trim(location)" if d is None else f"trim(split_part(location, {sql_quote(d)}, 1))" for p, d in CITY_DELIMITER.items()}
    same = ["sector", "function", "experience", "education", "contract_type", "summary", "description", "job_title"]
    made = {
        "job_id": f"coalesce(CASE WHEN {_in(WITH_NATIVE_ID)} THEN job_id END, md5(url))",
        "company": pg_initcap_sql("trim(company)"),
        "location_raw": "trim(location)",
        "city": _choice("source", places, "NULL"),
        "posted_date_raw": "posted_date",
        "search_keyword": f"CASE WHEN {_in(WITH_KEYWORD)} THEN trim(search_keyword) END",
        **{c: f"trim({q(c)})" for c in same},
    }
    staged = ", ".join(f"{made.get(c, q(c))} AS {q(c)}" for c in STAGED_COLUMNS)
    newest = ", ".join(["scraped_at DESC NULLS FIRST", *[f"{q(c)} NULLS FIRST" for c in DEDUP_TIEBREAK]])
    flags = ", ".join(f"CAST({q(c)} IS NOT NULL AS INTEGER) AS {f}" for f, c in FLAG_OF.items())
    return [
        ("bronze", bronze),
        ("staged", f"SELECT {staged} FROM bronze WHERE coalesce(job_title, url) IS NOT NULL AND job_title IS NOT NULL AND url IS NOT NULL"),
        ("jobs_unified", f"SELECT {', '.join(map(q, STAGED_COLUMNS))}, {flags}, CAST(length(coalesce(description, '')) AS INTEGER) AS description_length "
                         f"FROM staged QUALIFY row_number() OVER (PARTITION BY url ORDER BY {newest}) = 1"),
    ]


def _steps_sql(value: str, steps, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {value} >= {b} THEN {sql_quote(label)}" for b, label in steps) + f" ELSE {sql_quote(default)} END"


#: attribute -> (column of the offers, text that is labelled, {label: SQL of it})
def _labelled() -> dict[str, tuple[str, str, dict[str, str]]]:
    level = {"education": (R.EDUCATION_LEVEL_RULES, R.EDUCATION_LEVEL_DEFAULT), "experience": (R.EXPERIENCE_LEVEL_RULES, R.EXPERIENCE_LEVEL_DEFAULT)}
    of = {"education": (R.EDUCATION_DIM_RULES, R.EDUCATION_FACT_RULES, R.EDUCATION_DEFAULT),
          "experience": (R.EXPERIENCE_DIM_RULES, R.EXPERIENCE_FACT_RULES, R.EXPERIENCE_DEFAULT)}
    out = {
        "city": ("city", "raw", {"label": first_match_sql("txt", R.CITY_RULES, pg_initcap_sql("trim(txt)")),
                                 "kind": first_match_sql("txt", R.REGION_RULES, sql_quote(R.REGION_DEFAULT))}),
        "contract": ("contract_type", "trim(split_part(raw, '-', 1))", {
            "label": first_match_sql("txt", R.CONTRACT_RULES, sql_quote(R.CONTRACT_DEFAULT)),
            "kind": first_match_sql("txt", R.CONTRACT_CATEGORY_RULES, sql_quote(R.CONTRACT_CATEGORY_DEFAULT))}),
    }
    for name, (dim, fact, other) in of.items():
        rules, top = level[name]
        out[name] = (name, "raw", {"label": first_match_sql("txt", dim, sql_quote(other)), "fact_label": first_match_sql("txt", fact, sql_quote(other)),
                                   "level": first_match_sql("txt", rules, str(top))})
    return out


def label_ctes() -> list[tuple[str, str]]:
    """<name>_labels: raw value of an offer, the text that counts, whether a dimension lists it, its labels."""
    out = []
    for name, (column, text, labels) in _labelled().items():
        made = ", ".join(f"{sql} AS {k}" for k, sql in labels.items())
        out.append((f"{name}_labels", f"SELECT raw, txt, listed, {made} FROM (SELECT raw, {text} AS txt, coalesce(trim(raw) <> '', false) AS listed "
                                      f"FROM (SELECT DISTINCT {column} AS raw FROM jobs_unified))"))
    return out


def dimension_ctes(asof: str = ASOF) -> list[tuple[str, str]]:
    out = [("dim_source", "SELECT * FROM (VALUES " + ", ".join(str(tuple(p)) for p in C.PLATFORMS) +
            ") v(source_id, source_key, source_name, source_url, source_scope)")]
    for name, kind in (("city", "region"), ("contract", "contract_category")):
        out.append((f"dim_{name}", f"SELECT row_number() OVER (ORDER BY label, kind) AS {name}_id, label AS {name}_normalized, kind AS {kind}, "
                                   f"count(DISTINCT txt) AS nb_raw_variants FROM {name}_labels WHERE listed GROUP BY label, kind"))
    for name, steps, other in (("education", R.EDUCATION_CATEGORY_BY_LEVEL, R.EDUCATION_CATEGORY_DEFAULT),
                               ("experience", R.EXPERIENCE_CATEGORY_BY_LEVEL, R.EXPERIENCE_CATEGORY_DEFAULT)):
        out.append((f"dim_{name}", f"SELECT dense_rank() OVER (ORDER BY low, label) AS {name}_id, label AS {name}_normalized, low AS {name}_level_order, "
                                   f"{_steps_sql('low', steps, other)} AS {name}_category, n AS nb_raw_variants FROM "
                                   f"(SELECT label, min(level) AS low, count(*) AS n FROM {name}_labels WHERE listed GROUP BY label)"))
    out.append(("dim_company", f"""SELECT row_number() OVER (ORDER BY nb_offers DESC, company) AS company_id, *,
        {_steps_sql('nb_offers', R.RECRUITER_CATEGORY_BY_OFFERS, R.RECRUITER_CATEGORY_DEFAULT)} AS recruiter_category
    FROM (SELECT company, count(*) AS nb_offers, count(DISTINCT source) AS nb_sources, count(DISTINCT city) AS nb_cities,
        string_agg(DISTINCT source, ', ' ORDER BY source) AS sources_list, min(scraped_at) AS first_seen, max(scraped_at) AS last_seen
        FROM jobs_unified WHERE trim(company) <> '' GROUP BY company)"""))
    names = {k: "[" + ", ".join(map(sql_quote, v)) + "]" for k, v in (("month", C.MONTH_NAMES), ("day", C.DAY_NAMES))}
    whole = {"date_id": "strftime(d, '%Y%m%d')", "year": "year(d)", "quarter": "quarter(d)", "month": "month(d)", "week": "weekofyear(d)",
             "day_of_month": "dayofmonth(d)", "day_of_week": "dayofweek(d)", "day_of_year": "dayofyear(d)"}
    whole = ", ".join(f"CAST({v} AS INTEGER) AS {q(k)}" for k, v in whole.items())
    recent = ", ".join(f"d >= DATE '{asof}' - {n} AS is_last_{n}_days" for n in (7, 30, 90))
    out.append(("dim_date", f"""SELECT {whole}, d AS full_date, {names['month']}[month(d)] AS month_name, {names['day']}[dayofweek(d) + 1] AS day_name,
        strftime(d, '%Y-%m') AS year_month, year(d) || '-Q' || quarter(d) AS year_quarter, dayofweek(d) IN (0, 6) AS is_weekend,
        d = DATE '{asof}' AS is_today, {recent}
    FROM (SELECT CAST(unnest(generate_series(least(min(scraped_at), DATE '{C.CALENDAR_START}')::DATE::TIMESTAMP,
        greatest(max(scraped_at), DATE '{C.CALENDAR_END}')::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d FROM jobs_unified)"""))
    skills = ", ".join(f"({i}, {sql_quote(n)}, {sql_quote(p)}, {sql_quote(c)})" for i, n, p, c, _ in skill_rows())
    out.append(("dim_skill", f"SELECT CAST(a AS BIGINT) AS skill_id, b AS skill_name, c AS skill_pattern, d AS skill_category FROM (VALUES {skills}) v(a, b, c, d)"))
    return out


def fact_ctes() -> list[tuple[str, str]]:
    """offer_ids: url and ids, one row a pair of dimension rows (T1); safe_ids: the smallest ids, one row an offer; fct_jobs."""
    score = " + ".join([*FLAG_COLUMNS, "CAST(description_length >= 200 AS INTEGER)"])
    find = " ".join(f"JOIN {n}_labels l_{n} ON u.{column} IS NOT DISTINCT FROM l_{n}.raw" for n, (column, _, _) in _labelled().items())
    ids = " ".join(f"LEFT JOIN dim_{n} USING ({n}_normalized)" for n in ("city", "contract", "education", "experience"))
    labels = ", ".join(f"l_{n}.{'fact_label' if n in ('education', 'experience') else 'label'} AS {n}_normalized" for n in _labelled())
    return [
        ("offer_labels", f"SELECT u.url, u.company, u.source AS source_key, CAST(u.scraped_at AS DATE) AS full_date, {labels} FROM jobs_unified u {find}"),
        ("offer_ids", f"SELECT url, source_id, city_id, company_id, contract_id, education_id, experience_id, date_id AS scraped_date_id "
                      f"FROM offer_labels {ids} LEFT JOIN dim_company USING (company) LEFT JOIN dim_source USING (source_key) LEFT JOIN dim_date USING (full_date)"),
        ("safe_ids", "SELECT url, min(source_id) AS source_id, min(city_id) AS city_id, min(company_id) AS company_id, min(contract_id) AS contract_id, "
                     "min(education_id) AS education_id, min(experience_id) AS experience_id, min(scraped_date_id) AS scraped_date_id FROM offer_ids GROUP BY url"),
        ("scored", f"SELECT *, CAST(round(100.0 * ({score}) / 8.0) AS INTEGER) AS quality_score, 1 AS offer_count FROM jobs_unified"),
        ("fct_jobs", _fact("offer_ids")),
        ("safe_fact", _fact("safe_ids")),
    ]


def _fact(ids: str) -> str:
    own = ["job_title", "summary", "description", "url", "posted_date_raw", "search_keyword", "description_length", "quality_score", "offer_count",
           *FLAG_COLUMNS, "scraped_at"]
    return f"SELECT s.job_id, i.* EXCLUDE (url), {', '.join('s.' + c for c in own)} FROM {ids} i JOIN scored s USING (url)"


def skill_ctes() -> list[tuple[str, str]]:
    """hits: url and skill of each offer, every pattern a constant; bridge_job_skill: the same for each row of the fact."""
    arms = ", ".join(f"CASE WHEN regexp_matches(t, {sql_quote(to_re2(p, True, 'pg'))}) THEN {i} END" for i, _, p, _, _ in skill_rows())
    return [
        ("hits", f"SELECT url, job_id, unnest([x for x in [{arms}] if x IS NOT NULL]) AS skill_id "
                 "FROM (SELECT url, job_id, coalesce(description, '') || ' ' || coalesce(job_title, '') AS t FROM jobs_unified)"),
        ("bridge_job_skill", "SELECT h.job_id, s.skill_id, s.skill_name, s.skill_category FROM hits h JOIN dim_skill s USING (skill_id) JOIN offer_ids i USING (url)"),
    ]


def full_ctes(asof: str = ASOF, bronze: str = BRONZE_OFFERS_SQL) -> list[tuple[str, str]]:
    return silver_ctes(bronze) + label_ctes() + dimension_ctes(asof) + fact_ctes() + skill_ctes()


def unified_columns() -> str:
    return ", ".join(map(q, UNIFIED_COLUMNS))
