from pyspark.sql import functions as F

from newslake.functions import page, text


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column.alias("y")).first().y


def test_strip_equals_python(spark):
    for value in (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0     　x y　 \n", "", "  ", "​z"):
        assert one(spark, text.strip(F.col("x")), value) == value.strip()
        assert one(spark, text.squeeze(F.col("x")), value) == " ".join(value.split())
        assert one(spark, text.has_text(F.col("x")), value) == bool(value.strip())


def test_small_functions(spark):
    x = F.col("x")
    assert one(spark, text.url_id(x), "https://a/ü") == __import__("hashlib").md5("https://a/ü".encode()).hexdigest()
    assert one(spark, text.drop_dashes(x), "a---b-c--") == "ab-c"
    assert one(spark, text.to_int(x), " 1,234 ") == 1234
    assert one(spark, text.to_int(x), "Next") is None
    assert one(spark, text.part_before(x, "•"), "Jan 2 • 3 min") == "Jan 2"
    assert one(spark, text.last_part(x, "_"), "a_b_12") == "12"
    assert one(spark, text.contains_any(x, ["b", "q"]), "abc") is True
    assert one(spark, text.drop_phrase_paragraphs(F.split(x, "\n"), ["Follow us on"]), "a\n Follow us on X\n\n b ") == "a b"
    assert one(spark, text.or_default(x, "d"), " 　") == "d"
    assert one(spark, text.or_default(x, "d", blank_is_missing=False), "") == ""
    assert one(spark, text.or_default(x, "d"), None) == "d"


def test_page_functions(spark):
    html = ('<html lang="en"><body><!-- <p>no</p> --><script>var t="</p><b>";</script><style>p{}</style><article a="1">'
            '<h1> T </h1><p> a <b>b</b>c<br>&amp;lt; &copy;</p><div class="ad big">x</div><div class="ad">y</div></article>'
            '<article><p>second</p></article></body></html>')
    x = F.col("x")
    body = page.drop_elements(page.inner(x, "article"), "div", "ad")
    assert one(spark, page.visible_text(body), html) == "T a b c &lt; © x"
    assert one(spark, page.visible_text(x), html) == "T a b c &lt; © x y second"
    assert one(spark, page.tight_text(page.inner(x, "h1")), html) == "T"
    assert one(spark, page.inner(x, "main"), html) == ""
    assert one(spark, page.attribute(x, "html", "lang"), html) == "en"
    assert one(spark, page.attribute(x, "html", "dir"), html) is None
    df = spark.createDataFrame([(html,)], "html string")
    assert page.with_first_text(df, "c", "none", "main", "article").first().c == "T a b c &lt; © x y"
    assert page.with_first_text(df, "c", "none", "main", "aside").first().c == "none"


def test_page_count(spark):
    def count(*labels):
        return one(spark, page.page_count(F.array(*[F.lit(v) for v in labels]).cast("array<string>")), "")

    assert count("1", "2", "1,234", "Next") == 1234
    assert count("Prev", "Next") == 1
    assert count("1") == 1
    assert count() == 1


def test_long_runs_of_tags_do_not_recurse(spark):
    html = "<article>" + "<b>" * 200_000 + "x" + "</b> " * 200_000 + "</article>"
    assert one(spark, page.visible_text(page.inner(F.col("x"), "article")), html) == "x"


def test_a_node_of_blanks_vanishes(spark):
    html = "<p>a&nbsp;</p><p> &nbsp; </p><p>b&nbsp;c</p>"
    assert one(spark, page.visible_text(F.col("x")), html) == "a b\xa0c"


def test_entities(spark):
    for raw, want in (("a&amp", "a&"), ("&amp;amp;lt;", "&amp;lt;"), ("&amp;lt", "&lt"), ("&lt;&gt &#39;&quot;", "<> '\""), ("a&b", "a&b")):
        assert one(spark, page.unescape(F.col("x")), raw) == want
        assert __import__("html").unescape(raw) == want
