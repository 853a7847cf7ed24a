"""The element tree, the selectors, and one page per rule and root, built from the rule's own selector."""

import os
import random
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from newslake.functions import page
from newslake.sources import extract
from newslake.sources import html as H
from newslake.sources.rules import RULES, Cards, Field, Root, Rule, rule_map

# ---- tree and selectors -------------------------------------------------------------------------


def texts(markup, root="div", drop=""):
    node = H.select_one(H.parse(markup), root)
    return " ".join(H.strings(node, set(H.select(node, drop)) if drop else ()))


def test_text_rule():
    assert texts('<div class="c"><p> a </p><p><b>x</b>y</p><div class="ad">z</div></div>', "div.c", ".ad") == "a x y"
    assert texts('<div>a<script>var t="</p>";</script><!-- no --><style>x</style>b</div>') == "a b"
    assert texts("<div>T&amp;C &copy; &#8364;<br>x  y</div>") == "T&C © € x  y"
    assert texts("<div><p>a<b>b<p>c</div>after") == "a b c"
    assert texts("<div>a</span>b</div>") == "a b"
    assert texts("<div><img src=x/>a<hr/>b</div>") == "a b"
    assert texts("<div>a < b & c</div>") == "a < b & c"


def test_selectors():
    tree = H.parse('<main id="m"><div class="a  b"><p>1</p><i><p>2</p></i></div><div class="b" data-x="v w">'
                   '<a rel="next" href="h">3</a></div></main><div class="a">4</div>')

    def found(selector):
        return ["".join(H.strings(n)) for n in H.select(tree, selector)]

    assert found("div.a") == ["12", "4"]
    assert found("div.a.b") == ["12"]
    assert found('div[class="a b"]') == ["12"]
    assert found("div > p") == ["1"]
    assert found("main div p") == ["1", "2"]
    assert found("#m > div") == ["12", "3"]
    assert found("p, a") == ["1", "2", "3"]
    assert found('div[data-x="v w"]') == found('div[data-x^="v"]') == found('div[data-x*=" w"]') == ["3"]
    assert found("div.b >> p") == ["1", "2"]
    assert found("div.q >> p") == []
    assert found('a[rel="next"]') == ["3"]


def test_deep_nesting_does_not_recurse():
    assert texts("<div>" * 50_000 + "x") == "x"


# ---- building a page from a selector ---------------------------------------------------------------


def _element(compound, inside):
    tag = re.match(r"[\w-]+", compound)
    attrs = re.findall(r'\[([\w-]+)[\^*]?="([^"]*)"\]', compound)
    bare = re.sub(r"\[[^\]]*\]", "", compound)
    classes = re.findall(r"\.([\w-]+)", bare)
    if classes:
        attrs.append(("class", " ".join(classes)))
    attrs += [("id", i) for i in re.findall(r"#([\w-]+)", bare)]
    name = tag[0] if tag else "div"
    return f"<{name} " + " ".join(f'{k}="{v}"' for k, v in attrs) + f">{inside}</{name}>"


def nest(selector, inside):
    """Markup in which ``selector`` finds an element that holds ``inside``."""
    for step in reversed(re.split(r"\s*>>?\s*|\s+(?![^\[]*\])", selector.split(",")[0].strip())):
        inside = _element(step, inside)
    return inside


ROOTS = [(r.source, i) for r in RULES for i in range(len(r.roots))]


@pytest.mark.parametrize("source,i", ROOTS)
def test_root_and_drops_of_every_rule(source, i):
    rule = rule_map()[source]
    root = rule.roots[i]
    if root.join == "blocks":
        markup = nest(root.select, nest(root.heading, "H") + "<p>a <b>b</b></p><p> </p><p>c</p>") \
            + nest(root.select, "<p>d</p>")
        assert extract._body(H.parse(markup), rule.roots) == "H ab cNo Title d"
        return
    if root.join == "each":
        assert extract._body(H.parse("<article><p>a <b>b</b></p><i><p>no</p></i><p>c</p></article>"), rule.roots) == "ab c"
        return
    gone = "".join(_element(d.strip(), "GONE") for d in root.drop.split(",") if d.strip())
    gone += "".join(f"<p>x <b>{phrase}</b> GONE</p>" for phrase in root.drop_phrases)
    page = f"<html><body><p>no</p>{nest(root.select, f'<p> one </p>{gone}<p>two<b>three</b></p>')}</body></html>"
    assert extract._body(H.parse(page), rule.roots) == "one two three"
    assert extract._body(H.parse("<html><body><q>no</q></body></html>"), rule.roots) is None


def test_second_root_serves_when_the_first_is_absent():
    rule = Rule("s", "s", roots=(Root("div.a", ".x"), Root("div.b", ".y")))
    assert extract._body(H.parse('<div class="b"><i class="x">1</i><i class="y">2</i></div>'), rule.roots) == "1"


# ---- operators on Spark ------------------------------------------------------------------------------

DATES = {
    "D1": ("2024-01-02T03:04:05+07:00", "2024-01-01 20:04:05"), "D2": ("2024-01-02T03:04:05+07:00", "2024-01-02 03:04:05"),
    "D3": ("2024-01-02T03:04:05-05:00", "2024-01-02 08:04:05"), "D4": ("2024-01-02T03:04:05-05:00", "2024-01-02 03:04:05"),
    "D5": ("2024-01-02T03:04:05.123Z", "2024-01-02 03:04:05"), "D6": ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
    "D7": ("2024-01-02T03:04:05", "2024-01-02 03:04:05"), "D8": ("Published Jan 2, 2024, 3:04 p.m. UTC", "2024-01-02 15:04:00"),
    "D9": ("Jan. 2, 2024 at 3:04 pm UTC", "2024-01-02 15:04:00"), "D10": ("Jan 2, 2024 15:04 UTC", "2024-01-02 15:04:00"),
    "D11a": ("Jan 02, 2024", "2024-01-02 00:00:00"), "D11b": ("January 2, 2024", "2024-01-02 00:00:00"),
    "D11c": ("· 1/2/24", "2024-01-02 00:00:00"), "D12": ("Jan 2, 2024 - 15:04", "2024-01-02 15:04:00"),
    "D13": ("Jan 2, 2024, 3:04PM EST • 2 min", "2024-01-02 20:04:00"), "D14": ("2024-01-02", "2024-01-02 00:00:00"),
}


def together(parts):
    """One page for several (selector, attribute, value): what shares a selector shares the element."""
    heads = {}
    for selector, attr, value in parts:
        head, _, rest = selector.partition(" >> ")
        attrs, text, inner = heads.setdefault(head, ({}, [], []))
        if rest:
            inner.append((rest, attr, value))
        elif attr:
            attrs[attr] = value
        else:
            text.append(value)
    out = ""
    for head, (attrs, text, inner) in heads.items():
        start = "".join(f' {k}="{v}"' for k, v in attrs.items()) + ">" + "".join(text) + together(inner)
        out += nest(head, "\0").replace(">\0", start)
    return out


def _detail_pages():
    rows = []
    for rule in RULES:
        for i, field in enumerate(rule.dates):
            for kind, value in (("good", DATES[field.notation][0]), ("bad", "garbage")):
                if " ++ " in field.select and kind == "good":
                    value = value.replace(" at ", '<span class="time">at ') + "</span>"
                parts = [(field.select.split(" ++ ")[0], field.attr, value)]
                if rule.title:
                    parts.append((rule.title.select, "", "A <b>title</b>"))
                parts.append((rule.roots[0].select, "", "body text"))
                rows.append((rule.source, f"{i}-{kind}", together(parts)))
        rows.append((rule.source, "none", "<p>nothing</p>"))
    return rows


def test_details_of_every_rule(spark):
    pages = [(n, f"https://x/{s}/{k}", html, s, k) for n, (s, k, html) in enumerate(_detail_pages())]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, source string, kind string")
    got = {r.page_id: r for r in extract.extract_articles(df).collect()}
    rules = rule_map()
    assert len(got) == len(pages)
    for n, url, _, source, kind in pages:
        rule, row = rules[source], got[n]
        assert row.url == url and row.source == source
        if kind == "none":
            assert row.content == "No content"
            assert row.published_at == ("1970-01-01 00:00:00" if rule.dates else None)
            assert row.title == ("No Title" if rule.title else None)
            continue
        assert row.content == "body text"
        want = DATES[rule.dates[int(kind[0])].notation][1] if kind.endswith("good") else "1970-01-01 00:00:00"
        assert row.published_at == want, (source, kind)
        if rule.title:
            assert row.title == ("Atitle" if rule.title.text == "tight" else "A title")


def test_text_steps_and_blank_content(spark):
    pages = [
        (1, "u1", '<div class="post-body entry-content">a---b <i>x</i>- c</div>', "globalcryptopress.com"),
        (2, "u2", '<div class="entry-content"><p>Hello</p>Quick take: yes</div>', "nftgators.com"),
        (3, "u3", '<div class="entry-content-inner"><p>a\nb</p></div>', "beincrypto.com"),
        (4, "u4", '<div class="article__body"> </div>', "news.bitcoin.com"),
        (5, "u5", '<div class="article__content"> </div>', "u.today"),
        (6, "u6", None, "u.today"),
        (7, "u7", "<p>x</p>", "unknown"),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, source string")
    got = {r.page_id: r.content for r in extract.extract_articles(df).collect()}
    assert got == {1: "ab - c", 2: "Hello  yes", 3: "a b", 4: "No content", 5: "", 6: "No content"}


def _listing_page(rule, cards):
    """Cards side by side below the listing's container."""
    spec = rule.cards
    container, _, card = spec.select[0].rpartition(" >> ")
    page = ""
    for href, title, date in cards:
        parts = [(f"{card} >> {spec.link}" if spec.link else card, "href", href)]
        if spec.title:
            parts.append((f"{card} >> {spec.title.select}", "", title))
        if spec.date:
            parts.append((f"{card} >> {spec.date.select}", spec.date.attr, date))
        if spec.required:
            parts.append((f"{card} >> {spec.required}", "", "now"))
        page += together(parts)
    return f"<html><body><p>x</p>{nest(container, page) if container else page}</body></html>"


SIMPLE = [r.source for r in RULES if r.source != "news.bitcoin.com"]


def test_listing_of_every_rule(spark):
    rules = rule_map()
    pages = []
    for n, source in enumerate(SIMPLE):
        rule = rules[source]
        date = DATES[rule.cards.date.notation][0] if rule.cards.date else None
        cards = [("/one", "First", date), ("/two", "Second", date), ("/bad", "Third", "garbage" if rule.cards.date else None)]
        pages.append((n, source, "c", _listing_page(rule, cards)))
    df = spark.createDataFrame(pages, "page_id bigint, source string, category string, html string")
    rows, rejects = extract.explode_listing(df)
    got = {}
    for r in rows.orderBy("pos").collect():
        got.setdefault(r.source, []).append(r)
    lost = {}
    for r in rejects.collect():
        lost.setdefault(r.source, []).append(r)
    for source in SIMPLE:
        rule = rules[source]
        keeps_bad = not rule.cards.date or rule.cards.date.notation in ("D13", "D14")
        titles = ["First", "Second", "Third"][:3 if keeps_bad else 2]
        assert [r.title for r in got[source]] == (titles if rule.cards.title else [None] * len(titles)), source
        assert [r.url for r in got[source]][:2] == [rule.cards.base_url + h for h in ("/one", "/two")]
        if rule.cards.date:
            assert got[source][0].published_at == DATES[rule.cards.date.notation][1], source
        else:
            assert got[source][0].published_at is None
        assert [r.reject_reason for r in lost.get(source, [])] == ([] if keeps_bad else ["unreadable date"]), source
        assert rule.date_at == ("listing" if rule.cards.date else "detail")


def test_listing_rejects(spark):
    cls = "MuiTypography-root MuiTypography-inherit MuiLink-root MuiLink-underlineHover css-3pyhqk"
    page = f'<a class="{cls}" href="/about"><p>A</p></a><a class="{cls}" href=""><p>B</p></a>' \
           f'<a class="{cls}" href="/n1">no title</a><a class="{cls}" href="/n2"><p> C <b>d</b></p></a><a class="{cls}"><p>E</p></a>'
    lead = '<a href="/lead"><h5>L</h5></a><a href="/one"><h6>1</h6></a><a href="/other"><h5>no</h5></a><a href="/two"><h6>2</h6></a>'
    flies = '<ul class="penci-wrapper-data penci-grid"><li class="list-post pclist-layout">' \
            '<h2 class="penci-entry-title"><a href="/f"> F </a></h2></li></ul>'
    df = spark.createDataFrame([(1, "nonfungible.com", "art", page), (2, "news.bitcoin.com", "legal", lead),
                                (3, "blog.cryptoflies.com", "web3", flies)],
                               "page_id bigint, source string, category string, html string")
    rows, rejects = extract.explode_listing(df)
    import hashlib
    got = sorted((r.page_id, r.pos, r.url, r.title, r.published_at) for r in rows.collect())
    assert got == [(1, 3, "https://nonfungible.com/n2", "Cd", None), (2, 0, "/lead", None, None), (2, 1, "/one", None, None),
                   (2, 2, "/two", None, None), (3, 0, "/f", "F", "1970-01-01 00:00:00")]
    # The identity is over the link as it stands on the page.
    assert {r.id for r in rows.filter("page_id = 1").collect()} == {hashlib.md5(b"/n2").hexdigest()}
    assert sorted((r.pos, r.reject_reason) for r in rejects.collect()) == [
        (0, "skipped link"), (1, "skipped link"), (2, "incomplete card"), (4, "incomplete card")]


def test_pages_that_cannot_be_read_are_rejects(spark, monkeypatch):
    rows = [(1, "u.today", "k", '<div class="categories-list"></div>'), (2, "u.today", "k", None), (3, "nobody.example", "k", "<p>x</p>"),
            (4, None, "k", "<p>x</p>"), (5, "u.today", "k", "<![broken")]
    pages = spark.createDataFrame(rows, "page_id bigint, source string, category string, html string").withColumn("url", F.lit("u"))
    good, bad = extract.explode_listing(pages)
    got = {r.page_id: r.reject_reason for r in bad.collect()}
    assert good.count() == 0 and {k: got[k] for k in (2, 3, 4)} == {2: "no page", 3: "no rule", 4: "no rule"} and set(got) <= {2, 3, 4, 5}
    reasons = {r.page_id: r.reason for r in extract.page_rejects(pages).collect()}
    assert {k: reasons[k] for k in (2, 3, 4)} == {2: "no page", 3: "no rule", 4: "no rule"} and 1 not in reasons


def test_selection_by_index_equals_a_walk():
    """Every way of naming elements, against a plain walk over the tree."""
    from newslake.sources import html as H
    tree = H.parse('<div id="a" class="x y"><p class="x">1<b>2</b></p><div><p id="b">3</p><script>4</script></div></div><p class="y x">5</p>')
    everything = [n for n in H.walk(tree) if not isinstance(n, str)]
    for node in [tree, *everything]:
        inside = [n for n in H.walk(node) if not isinstance(n, str)]
        for selector in ("p", ".x", "#b", "div p", "div > p", "p.x, b", ".x.y", "[id]", 'p[class="y x"]', 'p[class^="y"]', "script"):
            want = [n for n in inside if any(H._fits(n, c) for c in H._compile(selector))]
            assert H.select(node, selector) == want, selector


def test_last_page(spark):
    pages = [
        (1, "blockonomi.com", "".join(f'<a class="page-numbers">{t}</a>' for t in ("1", "2", "1,234", "Next"))),
        (2, "cryptoslate.com", '<div class="pagination">' + "".join(f'<a class="page-numbers">{t}</a>' for t in ("1", "9", "Next")) + "</div>"),
        (3, "cryptonews.com", '<a class="page-numbers">7</a><a class="page-numbers">2,801</a><a class="next page-numbers">Next</a>'),
        (4, "beincrypto.com", '<div class="content"><a data-el_pos="bic-c-pagination-last-page"> 55 </a></div>'),
        (5, "holder.io", "<p>none</p>"),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, source string, html string")
    assert {r.page_id: r.pages for r in extract.last_page(df).collect()} == {1: 1234, 2: 9, 3: 2801, 4: 55, 5: None}


def test_own_rule(spark):
    rule = Rule("mine", "mine", roots=(Root("article", ".ad"),), title=Field("h1"), dates=(Field("time", "datetime", "D2"),),
                cards=Cards(("li",), "a", Field("a")))
    df = spark.createDataFrame([(1, "u", '<h1> A\n b</h1><time datetime="2024-01-02T03:04:05+07:00"></time><article>x</article>', "mine")],
                               "page_id bigint, url string, html string, source string")
    assert extract.extract_articles(df, [rule]).first().published_at == "2024-01-02 03:04:05"
    row = extract.extract_articles(df, [rule], tz_policy="utc").first()
    assert (row.title, row.content, row.published_at) == ("A b", "x", "2024-01-01 20:04:05")


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Run from another folder, with the package on the driver's path only."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys; sys.path.insert(0, {root!r})
from newslake.session import build_session
from newslake.sources import extract
spark = build_session(master="local[1]", extra={{"spark.ui.enabled": "false"}})
df = spark.createDataFrame([(1, "u", "<article>x</article>", "holder.io")], "page_id bigint, url string, html string, source string")
assert extract.extract_articles(df).first().content == "x"
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, check=True, capture_output=True, timeout=180)


def test_second_date_serves_only_where_the_rule_says_so(spark):
    def meta(name, value):
        return f'<meta property="article:{name}_time" content="{value}">'

    good, other = "2024-01-02T03:04:05Z", "2024-02-02T03:04:05Z"
    pages = [
        (1, "news.bitcoin.com", meta("published", good) + meta("modified", other)),
        (2, "news.bitcoin.com", meta("published", "soon") + meta("modified", other)),
        (3, "news.bitcoin.com", meta("modified", other)),
        (4, "news.bitcoin.com", meta("published", "soon") + meta("modified", "later")),
        (5, "ambcrypto.com", meta("published", "soon") + '<meta name="published_at" content="2024-02-02T03:04:05">'),
        (6, "ambcrypto.com", '<meta name="published_at" content="2024-02-02T03:04:05">'),
    ]
    df = spark.createDataFrame([(n, "u", h, s) for n, s, h in pages], "page_id bigint, url string, html string, source string")
    got = {r.page_id: r.published_at for r in extract.extract_articles(df).collect()}
    first, second, none = "2024-01-02 03:04:05", "2024-02-02 03:04:05", "1970-01-01 00:00:00"
    assert got == {1: first, 2: second, 3: second, 4: none, 5: none, 6: second}


def test_tree_and_built_in_expressions_agree(spark):
    """On regular pages both ways read the same text."""
    rng = random.Random(3)
    pieces = ["<p>", "</p>", "<b>", "</b>", "<br>", " ", "word", "&amp;", "&lt;", "&copy", "x\n y", "<!-- c -->",
              "<script>var a='</p>';</script>", "<style>p{}</style>", "\u00a0", "<i class='a'>", "</i>", "\t"]
    pages = ["<article>" + "".join(rng.choices(pieces, k=rng.randint(0, 40))) + "</article>" for _ in range(400)]
    df = spark.createDataFrame([(i, "u", h, "mine") for i, h in enumerate(pages)],
                               "page_id bigint, url string, html string, source string")
    rule = Rule("mine", "mine", roots=(Root("article"),))
    walked = {r.page_id: r.content for r in extract.extract_articles(df, [rule]).collect()}
    text = page.visible_text(page.inner(F.col("html"), "article"))
    matched = {r.page_id: r.c for r in df.select("page_id", text.alias("c")).collect()}
    assert walked == matched


def test_trees_do_not_outlive_their_page():
    """A tree's elements name one another, so without a break they stay until the garbage collector's next full round."""
    import gc
    rule = rule_map(RULES)["u.today"]
    page = '<div class="article__content">' + "<p>a <b>b</b></p>" * 50 + "</div>"
    gc.collect()
    gc.disable()
    try:
        for _ in range(5):
            assert extract._page_fields(page, rule)[1] == " ".join(["a b"] * 50)
            list(extract._page_cards(page, rule))
        assert not [o for o in gc.get_objects() if isinstance(o, H.Node) and o.tag == "p"]
    finally:
        gc.enable()


def test_found_rows_go_out_as_they_come(spark, monkeypatch):
    monkeypatch.setattr(extract, "_HELD", 100)
    pages = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "'u.today' AS source",
                                       "concat('<div class=\"article__content\"><p>', repeat('x', 60), id, '</p></div>') AS html").coalesce(1)
    seen = []
    original = pages.mapInArrow.__func__

    def spied(self, run, schema):
        table = self.select("page_id", "url", "html", "source").toArrow().to_batches()
        seen.extend(b.num_rows for b in run(iter(table)))
        return original(self, run, schema)
    monkeypatch.setattr(type(pages), "mapInArrow", spied)
    rows = extract.extract_fields(pages).collect()
    assert len(rows) == 40 and sum(seen) == 40 and max(seen) == 2
