"""FIXED VALUES: where each board's pages hold what the offers need."""

from souk.operators.markup import Cards, Field

LIST_CARDS = {
    "rekrute": Cards("ul#post-data:0 li.post-id", (
        Field("logo_alt", "img.photo", attr="alt"),
        Field("logo_title", "img.photo", attr="title"),
        Field("title_raw", "a.titreJob", strip=True),
        Field("href", "a.titreJob", attr="href"),
        Field("info1_spans", "div.info:0 span", strip=True, many=True),
        Field("info2_spans", "div.info:1 span", separator=" ", strip=True, many=True),
        Field("date_spans", "em.date:0 span", strip=True, many=True),
        Field("items", "ul li", parts=(Field("text", separator=" ", strip=True), Field("links", "a", strip=True, many=True))),
    )),
    "dreamjob": Cards("article.jeg_post", (
        Field("title_raw", "h3.jeg_post_title a", required=True),
        Field("href", "h3.jeg_post_title a", attr="href"),
        Field("date_text", ".jeg_meta_date a", strip=True),
        Field("img_alt", ".jeg_thumb img", attr="alt"),
        Field("img_title", ".jeg_thumb img", attr="title"),
        Field("has_img", ".jeg_thumb img", present=True),
        Field("excerpt_raw", ".jeg_post_excerpt p"),
    )),
    "indeed": Cards("li.css-1ac2h1w", (
        Field("jk", "a[data-jk]", attr="data-jk", required=True),
        Field("title_raw", "span[id^=jobTitle]"),
        Field("company_raw", "span[data-testid=company-name]"),
        Field("location_raw", "div[data-testid=text-location]"),
        Field("meta_raw", "div.jobMetaDataGroup", separator=" | "),
    )),
    "linkedin": Cards("div.base-card", (
        Field("title_raw", "h3.base-search-card__title"),
        Field("company_raw", "h4.base-search-card__subtitle"),
        Field("location_raw", "span.job-search-card__location"),
        Field("href", "a.base-card__full-link", attr="href"),
        Field("posted_date", "time.job-search-card__listdate | time.job-search-card__listdate--new", attr="datetime"),
    )),
}

ARTICLE = Field("text_raw", ".content-inner | .entry-content | article", separator=" ", strip=True, missing="",
                without=frozenset(("script", "style", "iframe", "noscript")))
DETAIL_CARDS = {
    "dreamjob": Cards("", (ARTICLE,)),
    "indeed": Cards("", (Field("text_raw", "div#jobDescriptionText", separator=" ", strip=True, missing=""),)),
    "linkedin": Cards("", (
        Field("text_raw", "div.show-more-less-html__markup", separator=" "),
        Field("criteria", "ul.description__job-criteria-list:0 li.description__job-criteria-item", parts=(
            Field("h", "h3.description__job-criteria-subheader", strip=True, required=True),
            Field("v", "span.description__job-criteria-text", required=True))),
    )),
}
