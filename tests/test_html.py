"""Markup as intervals: implied end tags, paths, text, depth."""
from souk.operators.markup import Cards, Field, Page, read_cards, select


def texts(html, path, **k):
    page = Page(html)
    return [page.text(e, **k) for e in select(page, page.whole(), path)]


def test_implied_end_tags():
    html = "<ul><li>a<li>b <b>x</b><li>c</ul><p>one<p>two<div>three</div>"
    assert texts(html, "li") == ["a", "b x", "c"]
    assert texts(html, "p") == ["one", "two"]
    assert texts(html, "p div") == []


def test_paths_and_text():
    html = ('<article class="jeg_post x"><h3 class="jeg_post_title"><a href="/u">T &amp; co</a></h3>'
            '<script>var a="<p>";</script><!-- c --><div id="d"> x <span>y</span> </div></article><br><i data-k="ab">z</i>')
    page = Page(html)
    assert select(page, page.whole(), "h3.jeg_post_title a")[0].attrs["href"] == "/u"
    assert texts(html, "article h3 a") == ["T & co"]
    assert texts(html, ".missing a | [data-k^=a]") == ["z"]
    assert texts(html, "i[data-k=b]") == [] and texts(html, "i[data-k]") == ["z"]
    assert texts(html, "div#d", separator="|", strip=True) == ["x|y"]
    assert texts(html, "article.jeg_post", separator=" ", strip=True) == ["T & co x y"]
    assert texts(html, "article", strip=True, without=frozenset(["h3"])) == ["xy"]
    assert texts("<ul><li>1</li><li>2<ul><li>3</li></ul></li></ul>", "ul:0 li:1 li") == ["3"]


def test_very_deep_pages():
    html = "<b>" * 5000 + "<article><p>deep" + "<font>" * 5000 + "er"
    assert texts(html, "article") == ["deeper"]


def test_one_bad_card_loses_only_itself(monkeypatch):
    from souk.operators import markup
    cards = Cards("li", (Field("t", "b", required=True), Field("n", "i", many=True)))
    html = "<ul><li><b>1</b><i>x</i></li><li>no</li><li><b>bad</b></li><li><b>3</b></li></ul>"
    read = markup.read_field

    def failing(page, scope, f):
        v = read(page, scope, f)
        if v == "bad":
            raise RuntimeError("boom")
        return v
    monkeypatch.setattr(markup, "read_field", failing)
    assert list(read_cards(html, cards)) == [(0, {"t": "1", "n": ["x"]}, None), (1, None, "RuntimeError: boom"), (2, {"t": "3", "n": []}, None)]
    assert [x[0] for x in read_cards(None, cards)] == [-1]
