"""DuckDB oracle for the page-record queries (``bronze_*_pages``).

Each rendered page is a deterministic function of a documents-derived offer,
and each extracted record a deterministic function of the page.  This module
composes both in SQL — what the renderer writes, then what the collectors'
rules make of it (text nodes stripped or cleaned, labelled items, telework
suffix, title bar split, Python ``or`` fall-throughs, first-seen card, detail
page per id) — so the Spark walk (``mapInPandas``) + column rules are checked
value by value against an independent computation.
"""

from __future__ import annotations

from souk.functions.regex import SPACE, sql_quote
from souk.functions.text import clean_text_sql
from souk.operators import extract as X
from souk.plans.oracle import with_ctes
from souk.rulesets import extraction as D
from souk.sources.offers import KEYWORD, _bronze_sql

_STRIP = sql_quote(f"^[{SPACE}]+|[{SPACE}]+$")


def pystrip(c: str) -> str:
    """Python ``str.strip()``."""
    return f"regexp_replace({c}, {_STRIP}, '', 'g')"


def clean(c: str) -> str:
    return clean_text_sql(c)


def _stored(c: str) -> str:
    return f"COALESCE({c}, '')"


def _captured(page_no: str) -> str:
    return f"TIMESTAMP '2026-04-26 08:00:00' + to_minutes(CAST({page_no} AS BIGINT))"


def _offers(platform: str) -> list[tuple[str, str]]:
    return [("bronze", _bronze_sql()),
            ("o", f"SELECT *, CAST(floor(doc_id / 4) AS BIGINT) AS seq FROM bronze WHERE source = '{platform}'")]


def _telework(ct: str, txt: str) -> str:
    arms = []
    for needle, suffix in D.TELEWORK_SUFFIXES:
        arms.append(f"WHEN contains({txt}, '{needle}') THEN CASE WHEN {ct} IS NOT NULL AND {ct} <> '' "
                    f"THEN {ct} || ' - {suffix}' ELSE '{suffix}' END")
    return f"CASE WHEN contains({txt}, 'Télétravail') THEN CASE {' '.join(arms)} ELSE {ct} END ELSE {ct} END"


def rekrute_sql() -> str:
    label_strip = sql_quote("^[ :\\-]+|[ :\\-]+$")
    r = f"""SELECT *,
        {pystrip("COALESCE(job_title, '') || COALESCE(' | ' || location, '')")} AS title_raw,
        CASE WHEN contract_type IS NOT NULL THEN {pystrip('contract_type')} END AS ct,
        list_extract(['Hybride', 'Oui', 'Non', ''], CAST(seq % 4 AS INTEGER) + 1) AS mode
    FROM o"""
    r2 = """SELECT *, concat_ws(' ', 'Type de contrat :', NULLIF(ct, ''),
        CASE WHEN mode <> '' THEN 'Télétravail : ' || mode END) AS ct_txt FROM r"""
    bar = "title_raw <> '' AND contains(title_raw, '|')"
    function_text = pystrip("'Fonction : ' || \"function\"")
    final = f"""SELECT
    CASE WHEN {bar} THEN {pystrip("split_part(title_raw, '|', 1)")} ELSE title_raw END AS job_title,
    CASE WHEN doc_id % 5 <> 0 THEN NULLIF({pystrip("COALESCE(company, '')")}, '') END AS company,
    CASE WHEN {bar} THEN {pystrip("regexp_extract(title_raw, '[^|]*$')")} END AS location,
    {pystrip("COALESCE(search_keyword, '')")} || ' data' AS summary,
    {pystrip('description')} AS description,
    CASE WHEN sector IS NOT NULL THEN {pystrip('sector')} || CASE WHEN seq % 2 = 0 THEN ' - Conseil' ELSE '' END
        END AS sector,
    CASE WHEN "function" IS NOT NULL THEN regexp_replace(replace({function_text},
        'Fonction :', ''), {label_strip}, '', 'g') END AS "function",
    CASE WHEN experience IS NOT NULL THEN {pystrip('experience')} END AS experience,
    CASE WHEN education IS NOT NULL THEN {pystrip('education')} END AS education,
    {_telework('ct', 'ct_txt')} AS contract_type,
    'du 26/04/2026 au 26/05/2026' AS posted_date,
    'https://www.rekrute.com/offre-emploi-' || CAST(doc_id AS VARCHAR) || '.html' AS url,
    'rekrute' AS source,
    {_captured('floor(seq / 20)')} AS scraped_at
FROM r2"""
    return with_ctes(_offers("rekrute") + [("r", r), ("r2", r2)], final)


def _alt_company(alt: str) -> str:
    """X11 in RE2: the boundary characters are consumed, so each pass removes
    every other word of a run of noise words; three passes cover the runs the
    rendered alts contain (company + ' Emploi Recrutement')."""
    w = r"\p{L}\p{N}_"
    pat = sql_quote(f"(?i)(^|[^{w}])(emploi|recrutement|maroc|morocco)([^{w}]|$)")
    s = alt
    for _ in range(3):
        s = f"regexp_replace({s}, {pat}, '\\1\\3', 'g')"
    s = f"regexp_replace({s}, {sql_quote('[' + SPACE + ']+')}, ' ', 'g')"
    s = f"regexp_replace({s}, '^[ \\-–—]+|[ \\-–—]+$', '', 'g')"
    return f"NULLIF({s}, '')"


def dreamjob_sql() -> str:
    quoted = "'\"Offre basée à ' || location || '\"'"  # the excerpt paragraph's text
    excerpt = f"CASE WHEN location IS NULL THEN '' ELSE trim(regexp_replace({clean(quoted)}, '^\"+|\"+$', '', 'g')) END"
    j = f"""SELECT *,
        {clean("' ' || COALESCE(job_title, '') || ' '")} AS title,
        {excerpt} AS excerpt,
        COALESCE({clean(pystrip('description'))}, '') AS full_text,
        CASE WHEN company IS NOT NULL THEN {_alt_company("trim(company) || ' Emploi Recrutement'")} END AS alt_company
    FROM o"""
    combined = pystrip("excerpt || ' ' || full_text")
    j2 = f"SELECT *, {combined} AS combined FROM j"
    final = f"""SELECT
    title AS job_title,
    COALESCE(alt_company, {X.company_from_title_sql('title')}) AS company,
    COALESCE({X.city_sql('excerpt')}, {X.city_sql('full_text')}) AS location,
    excerpt AS summary,
    {_stored('full_text')} AS description,
    CAST(NULL AS VARCHAR) AS sector,
    {X.functions_sql(X.joined_text_sql('title', 'combined'), 'dreamjob', D.FUNCTION_LABELS)} AS "function",
    {X.experience_sql('combined', 'dreamjob')} AS experience,
    {X.education_sql('combined', 'dreamjob')} AS education,
    {X.contracts_sql('combined')} AS contract_type,
    '26/04/2026' AS posted_date,
    'https://www.dreamjob.ma/emploi/offre-' || CAST(doc_id AS VARCHAR) || '/' AS url,
    'dreamjob' AS source,
    {_captured('floor(seq / 20)')} AS scraped_at
FROM j2"""
    return with_ctes(_offers("dreamjob") + [("j", j), ("j2", j2)], final)


def indeed_sql() -> str:
    kw = sql_quote(KEYWORD[0].strip())
    j = f"""SELECT *,
        {clean("COALESCE(job_title, '')")} AS title,
        {pystrip('description')} AS desc_text
    FROM o"""
    final = f"""SELECT
    title AS job_title,
    {clean("COALESCE(company, '')")} AS company,
    {clean("COALESCE(location, '')")} AS location,
    CAST(NULL AS VARCHAR) AS summary,
    {_stored('desc_text')} AS description,
    {X.sectors_sql('desc_text', D.SECTOR_LABELS)} AS sector,
    {X.functions_sql(X.joined_text_sql('title', 'desc_text'), 'indeed', D.FUNCTION_LABELS)} AS "function",
    {X.experience_sql('desc_text', 'indeed')} AS experience,
    {X.education_sql('desc_text', 'indeed')} AS education,
    COALESCE({X.contracts_sql('desc_text', True)},
             CASE WHEN contract_type IS NOT NULL THEN {clean("contract_type || ' | Temps plein'")} END) AS contract_type,
    CAST(NULL AS VARCHAR) AS posted_date,
    'https://ma.indeed.com/viewjob?jk=jk' || CAST(doc_id AS VARCHAR) AS url,
    'indeed' AS source,
    {kw} AS search_keyword,
    {_captured('floor(seq / 20)')} AS scraped_at
FROM j"""
    return with_ctes(_offers("indeed") + [("j", j)], final)


def linkedin_sql() -> str:
    kw = sql_quote(KEYWORD[0].strip())
    native = "3900000000 + doc_id - CASE WHEN doc_id % 44 = 7 THEN 4 ELSE 0 END"
    detail = f"""SELECT o.doc_id,
        d.description AS d_desc, d.experience AS d_exp, d.contract_type AS d_ct, d."function" AS d_fn, d.sector AS d_sec
    FROM o JOIN o AS d ON d.doc_id = CASE WHEN o.doc_id % 44 = 7 AND o.doc_id >= 4 THEN o.doc_id - 4 ELSE o.doc_id END"""
    j = f"""SELECT o.*, COALESCE({clean('x.d_desc')}, '') AS desc_text,
        CASE WHEN x.d_exp IS NOT NULL THEN {clean("' ' || x.d_exp || ' '")} END AS crit_exp,
        CASE WHEN x.d_ct IS NOT NULL THEN {clean("' ' || x.d_ct || ' '")} END AS crit_ct,
        CASE WHEN x.d_fn IS NOT NULL THEN {clean("' ' || x.d_fn || ' '")} END AS crit_fn,
        CASE WHEN x.d_sec IS NOT NULL THEN {clean("' ' || x.d_sec || ' '")} END AS crit_sec
    FROM o JOIN detail x ON x.doc_id = o.doc_id"""
    final = f"""SELECT
    {clean("' ' || COALESCE(job_title, '') || ' '")} AS job_title,
    {clean("COALESCE(company, '')")} AS company,
    {clean("COALESCE(location, '')")} AS location,
    CAST(NULL AS VARCHAR) AS summary,
    {_stored('desc_text')} AS description,
    crit_sec AS sector,
    crit_fn AS "function",
    COALESCE(NULLIF(crit_exp, ''), {X.experience_sql('desc_text', 'linkedin')}) AS experience,
    {X.education_sql('desc_text', 'indeed')} AS education,
    crit_ct AS contract_type,
    CASE WHEN seq % 2 = 0 THEN '2026-04-26' ELSE '2026-04-27' END AS posted_date,
    'https://ma.linkedin.com/jobs/view/data-engineer-at-x' || CAST(doc_id AS VARCHAR) || '-'
        || CAST({native} AS VARCHAR) AS url,
    CAST({native} AS VARCHAR) AS job_id,
    'linkedin' AS source,
    {kw} AS search_keyword,
    {_captured('floor(seq / 20)')} AS scraped_at
FROM j"""
    return with_ctes(_offers("linkedin") + [("detail", detail), ("j", j)], final)


# Character references decoded in text: (reference, character).  Legacy names
# also decode without ';'.  '&' goes through a private-use sentinel so a
# decoded ampersand never starts a second decoding ('&amp;quot;' -> '&quot;').
_AMP = "chr(57344)"
ENTITIES = [("&amp;", _AMP), ("&amp", _AMP), ("&lt;", "'<'"), ("&lt", "'<'"), ("&gt;", "'>'"), ("&gt", "'>'"),
            ("&quot;", "'\"'"), ("&quot", "'\"'"), ("&#39;", "chr(39)"), ("&apos;", "chr(39)"),
            ("&nbsp;", "chr(160)"), ("&nbsp", "chr(160)"), ("&copy;", "'©'"), ("&middot;", "'·'")]


def page_articles_sql() -> str:
    """X5 on pages whose content element is their single ``<article>``: inner
    markup without comments and script/style/iframe/noscript blocks, every tag
    a separator, entities decoded, then cleaned like the collectors' text."""
    s = "regexp_extract(html, '(?s)<article[^>]*>(.*)</article>', 1)"
    s = f"regexp_replace({s}, '(?s)<!--.*?-->', ' ', 'g')"
    for tag in ("script", "style", "iframe", "noscript"):
        s = f"regexp_replace({s}, '(?s)<{tag}[^>]*>.*?</{tag}>', ' ', 'g')"
    s = f"regexp_replace({s}, '<[^>]*>', ' ', 'g')"
    for ent, ch in ENTITIES:
        s = f"replace({s}, '{ent}', {ch})"
    s = f"replace({s}, {_AMP}, '&')"
    return f"SELECT page_id, url, {clean(s)} AS text, CAST(NULL AS VARCHAR) AS error FROM pages"


def page_errors_sql() -> str:
    """Indeed pages without content: list pages of 20 offers for each of up to three keywords, and a detail page an offer."""
    base = "CAST(3 * 1000000000000000 + {kind} * 100000000000000 + {a} * 1000000000 + {b} AS BIGINT)"
    lists = base.format(kind=1, a="k", b="p")
    details = base.format(kind=2, a="doc_id", b="0")
    return f"""WITH o AS (SELECT doc_id FROM documents WHERE doc_id % 4 = 2),
cards AS (SELECT DISTINCT unnest(range(0, CAST(doc_id % 3 AS INTEGER) + 1)) AS k, CAST(floor(floor(doc_id / 4) / 20) AS BIGINT) AS p FROM o),
pages AS (SELECT {lists} AS page_id, 'https://indeed.example/search?kw=' || k || '&p=' || p AS url, 'list' AS page_kind FROM cards
    UNION ALL SELECT {details}, 'https://ma.indeed.com/viewjob?jk=jk' || doc_id, 'detail' FROM o)
SELECT page_id, url, page_kind, 'run-1' AS run_id, CAST(-1 AS INTEGER) AS pos, 'ValueError: no html captured' AS error FROM pages WHERE page_id % 5 = 2"""


def oracle_queries() -> dict[str, str]:
    return {"bronze_rekrute_pages": rekrute_sql(), "bronze_dreamjob_pages": dreamjob_sql(),
            "bronze_indeed_pages": indeed_sql(), "bronze_linkedin_pages": linkedin_sql(),
            "page_articles": page_articles_sql()}
