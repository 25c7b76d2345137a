"""Captured job-board pages rendered from the driver's ``documents``.

The collectors' input is HTML captured from four job boards; none is given,
so Spark renders it from the documents-derived offers (``offers.py``): list
pages of at most 20 cards per (platform, keyword, page) and one detail page
per offer carrying the document's whole text.  Markup follows each board's
structure as the collectors read it.  Pure column expressions; the only
grouping is the bounded 20-card page.

Schema: ``page_id, url, html, platform, page_kind, search_keyword,
keyword_rank, page_no, captured_at, run_id`` (``keyword_rank``/``page_no`` give the
order in which a collector meets the cards).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.operators.dedup import keep_first
from souk.sources.offers import KEYWORD, _pick, offers_from_documents

CARDS_PER_PAGE = 20
TELEWORK = ["Hybride", "Oui", "Non", ""]
PLATFORM_NO = {"rekrute": 1, "dreamjob": 2, "indeed": 3, "linkedin": 4}
CRITERIA = [("Niveau hiérarchique", "experience"), ("Type d'emploi", "contract_type"), ("Fonction", "function"),
            ("Secteurs", "sector")]


def esc(c: Column) -> Column:
    """HTML-escape text (``& < > "``)."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _s(c) -> Column:
    return esc(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))


def _opt(cond: Column, html: Column) -> Column:
    return F.when(cond, html).otherwise(F.lit(""))


def _page_id(platform: str, kind: int, a: Column, b: Column | int = 0) -> Column:
    return (F.lit(PLATFORM_NO[platform] * 10 ** 15 + kind * 10 ** 14) + F.lit(a) * 10 ** 9 + b).cast("bigint")


def _captured(page_no: Column) -> Column:
    return F.timestamp_add("MINUTE", page_no, F.lit("2026-04-26 08:00:00").cast("timestamp_ntz"))


def _rekrute_card(d: Column) -> Column:
    seq = (d / 4).cast("bigint")  # position among the board's offers
    logo = (F.when(d % 5 == 0, F.lit(""))
            .when(d % 5 == 1, F.concat(F.lit('<img class="photo" alt=" " title="'), _s("company"), F.lit('">')))
            .otherwise(F.concat(F.lit('<img class="photo" alt="'), _s("company"), F.lit('">'))))
    title = F.concat(_s("job_title"), F.when(F.col("location").isNotNull(),
                                             F.concat(F.lit(" | "), _s("location"))).otherwise(F.lit("")))
    mode = _pick(TELEWORK, seq)
    items = F.concat(
        _opt(F.col("sector").isNotNull(), F.concat(F.lit("<li>Secteur d'activité : <a>"), _s("sector"), F.lit("</a>"),
                                                  _opt(seq % 2 == 0, F.lit(" - <a>Conseil</a>")), F.lit("</li>"))),
        _opt(F.col("function").isNotNull(), F.concat(F.lit("<li>Fonction : "), _s("function"), F.lit("</li>"))),
        _opt(F.col("experience").isNotNull(), F.concat(F.lit("<li>Expérience requise : <a>"), _s("experience"),
                                                      F.lit("</a></li>"))),
        _opt(F.col("education").isNotNull(), F.concat(F.lit("<li>Niveau d'étude demandé : <a>"), _s("education"),
                                                     F.lit("</a></li>"))),
        F.concat(F.lit("<li>Type de contrat : "),
                 _opt(F.col("contract_type").isNotNull(), F.concat(F.lit("<a>"), _s("contract_type"), F.lit("</a>"))),
                 _opt(mode != "", F.concat(F.lit(" Télétravail : "), mode)), F.lit("</li>")))
    return F.concat(
        F.lit('<li class="post-id">'), logo,
        F.lit('<a class="titreJob" href="/offre-emploi-'), d.cast("string"), F.lit('.html">'), title, F.lit("</a>"),
        F.lit('<div class="info"><span>'), _s("search_keyword"), F.lit("</span> <span>data</span></div>"),
        F.lit('<div class="info"><span>Poste :</span><span>'), _s("description"), F.lit("</span></div>"),
        F.lit('<em class="date"><span>26/04/2026</span><span>26/05/2026</span></em>'),
        F.lit("<ul>"), items, F.lit("</ul></li>"))


def _dreamjob_card(d: Column) -> Column:
    return F.concat(
        F.lit('<article class="jeg_post"><div class="jeg_thumb">'),
        _opt(F.col("company").isNotNull(), F.concat(F.lit('<img alt="'), _s(F.trim("company")),
                                                    F.lit(' Emploi Recrutement">'))),
        F.lit('</div><h3 class="jeg_post_title"><a href=" '), _s("url"), F.lit(' "> '), _s("job_title"),
        F.lit(' </a></h3><div class="jeg_meta_date"><a>Publié le 26/04/2026</a></div>'),
        _opt(F.col("location").isNotNull(), F.concat(F.lit('<div class="jeg_post_excerpt"><p>"Offre basée à '),
                                                     _s("location"), F.lit('"</p></div>'))),
        F.lit("</article>"))


def _indeed_card(d: Column) -> Column:
    jk = F.concat(F.lit("jk"), d.cast("string"))
    return F.concat(
        _opt(d % 7 == 0, F.lit('<li class="css-1ac2h1w"><div>Sponsored</div></li>')),
        F.lit('<li class="css-1ac2h1w"><div><a data-jk="'), jk, F.lit('"><span id="jobTitle-'), jk, F.lit('">'),
        _s("job_title"), F.lit('</span></a></div><span data-testid="company-name">'), _s("company"),
        F.lit('</span><div data-testid="text-location">'), _s("location"), F.lit("</div>"),
        _opt(F.col("contract_type").isNotNull(), F.concat(F.lit('<div class="jobMetaDataGroup"><div>'),
                                                          _s("contract_type"), F.lit("</div><div>Temps plein</div></div>"))),
        F.lit("</li>"))


def _linkedin_card(d: Column) -> Column:
    return F.concat(
        F.lit('<div class="base-card"><a class="base-card__full-link" href="'), _s("url"),
        F.lit('?refId=abc&amp;trackingId=x"></a><h3 class="base-search-card__title"> '), _s("job_title"),
        F.lit(' </h3><h4 class="base-search-card__subtitle">'), _s("company"),
        F.lit('</h4><span class="job-search-card__location">'), _s("location"), F.lit("</span>"),
        F.when((d / 4).cast("bigint") % 2 == 0,
               F.lit('<time class="job-search-card__listdate" datetime="2026-04-26"></time>'))
         .otherwise(F.lit('<time class="job-search-card__listdate--new" datetime="2026-04-27"></time>')),
        F.lit("</div>"))


CARD = {"rekrute": _rekrute_card, "dreamjob": _dreamjob_card, "indeed": _indeed_card, "linkedin": _linkedin_card}
LIST_WRAP = {
    "rekrute": ('<html><body><ul id="post-data">', "</ul></body></html>"),
    "dreamjob": ('<html><body><div class="jeg_posts">', "</div></body></html>"),
    "indeed": ("<html><body><ul>", "</ul></body></html>"),
    "linkedin": ("<html><body>", "</body></html>"),
}


def list_pages(offers: DataFrame, platform: str) -> DataFrame:
    """List pages: cards grouped by (keyword, page) in position order."""
    d = F.col("doc_id")
    card = CARD[platform](d)
    if platform in ("indeed", "linkedin"):  # one card per search keyword that lists the offer
        offers = offers.select("*", F.explode(F.sequence(F.lit(0), (d % 3).cast("int"))).alias("keyword_rank"))
    else:
        offers = offers.select("*", F.lit(0).alias("keyword_rank"))
    seq = (d / 4).cast("bigint")
    cards = offers.select("keyword_rank", (seq / CARDS_PER_PAGE).cast("bigint").alias("page_no"),
                          (seq % CARDS_PER_PAGE).alias("pos"), card.alias("card"))
    head, tail = LIST_WRAP[platform]
    pages = cards.groupBy("keyword_rank", "page_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "card"))), lambda x: x["card"]), "")
        .alias("body"))
    kw = F.element_at(F.array(*[F.lit(k.strip()) for k in KEYWORD]), (F.col("keyword_rank") % 3).cast("int") + 1)
    return pages.select(
        _page_id(platform, 1, F.col("keyword_rank"), F.col("page_no")).alias("page_id"),
        F.concat(F.lit(f"https://{platform}.example/search?kw="), F.col("keyword_rank").cast("string"),
                 F.lit("&p="), F.col("page_no").cast("string")).alias("url"),
        F.concat(F.lit(head), "body", F.lit(tail)).alias("html"),
        F.lit(platform).alias("platform"), F.lit("list").alias("page_kind"),
        (kw if platform in ("indeed", "linkedin") else F.lit(None).cast("string")).alias("search_keyword"),
        F.col("keyword_rank").cast("int").alias("keyword_rank"), F.col("page_no").cast("int").alias("page_no"),
        _captured(F.col("page_no")).alias("captured_at"), F.lit("run-1").alias("run_id"))


def detail_pages(offers: DataFrame, platform: str) -> DataFrame:
    """One detail page per offer (Dreamjob, Indeed, LinkedIn)."""
    d = F.col("doc_id")
    if platform == "dreamjob":
        url = F.col("url")
        html = F.concat(F.lit('<html><head><script>var t="<p>x</p>";</script></head><body><nav>Menu</nav>'
                              '<div class="entry-content"><p>'), _s("description"),
                        F.lit('</p><script>track();</script><noscript>Activez JS</noscript></div></body></html>'))
    elif platform == "indeed":
        url = F.concat(F.lit("https://ma.indeed.com/viewjob?jk=jk"), d.cast("string"))
        html = F.concat(F.lit('<html><body><div id="jobDescriptionText"><p>'), _s("description"),
                        F.lit("</p></div></body></html>"))
    else:
        url = F.concat(F.lit("https://www.linkedin.com/jobs-guest/jobs/api/jobPosting/"),
                       F.regexp_extract("url", r"-(\d{8,})$", 1))
        crit = F.concat(*[F.when(F.col(col).isNotNull(), F.concat(
            F.lit('<li class="description__job-criteria-item"><h3 class="description__job-criteria-subheader">'
                  f'{h}</h3><span class="description__job-criteria-text"> '), _s(col), F.lit(" </span></li>")))
            .otherwise(F.lit("")) for h, col in CRITERIA])
        html = F.concat(F.lit('<html><body><div class="show-more-less-html__markup">'), _s("description"),
                        F.lit('</div><ul class="description__job-criteria-list">'), crit, F.lit("</ul></body></html>"))
    return offers.select(
        _page_id(platform, 2, d).alias("page_id"), url.alias("url"), html.alias("html"),
        F.lit(platform).alias("platform"), F.lit("detail").alias("page_kind"),
        F.lit(None).cast("string").alias("search_keyword"), F.lit(None).cast("int").alias("keyword_rank"),
        F.lit(None).cast("int").alias("page_no"), _captured(F.lit(0)).alias("captured_at"),
        F.lit("run-1").alias("run_id"))


def board_offers(documents: DataFrame, platform: str) -> DataFrame:
    """The documents-derived offers of one board, with the board's own urls."""
    d = F.col("doc_id")
    o = offers_from_documents(documents, keep_id=True).filter(F.col("source") == platform)
    if platform == "dreamjob":
        o = o.withColumn("url", F.concat(F.lit("https://www.dreamjob.ma/emploi/offre-"), d.cast("string"), F.lit("/")))
    elif platform == "linkedin":
        native = F.lit(3900000000) + d - F.when(d % 44 == 7, 4).otherwise(0)
        o = o.withColumn("url", F.concat(F.lit("https://ma.linkedin.com/jobs/view/data-engineer-at-x"),
                                         d.cast("string"), F.lit("-"), native.cast("string")))
    return o


def captured_pages(documents: DataFrame, platform: str) -> DataFrame:
    """List and detail pages of one board, rendered from the documents."""
    offers = board_offers(documents, platform)
    pages = list_pages(offers, platform)
    if platform == "linkedin":  # the detail endpoint serves one page per native id
        offers_detail = keep_first(offers.select("*", F.regexp_extract("url", r"-(\d{8,})$", 1).alias("_native")),
                                   ["_native"], [F.col("doc_id")]).drop("_native")
        pages = pages.unionByName(detail_pages(offers_detail, platform))
    elif platform != "rekrute":  # Rekrute lists every field on the list page
        pages = pages.unionByName(detail_pages(offers, platform))
    return pages
