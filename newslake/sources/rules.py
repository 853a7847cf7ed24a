"""Extraction rules: one row per source, data only. Selectors are read by ``sources.html``."""

from dataclasses import dataclass

from newslake.schema import BATCH_SIZE


@dataclass(frozen=True)
class Root:
    """Where an article's text stands, and what to leave out of it."""

    select: str
    drop: str = ""
    drop_phrases: tuple = ()
    # "first": the first match's texts; "each": every match's text, tight inside a match;
    # "blocks": heading and paragraphs of every match, tight between blocks.
    join: str = "first"
    heading: str = ""


@dataclass(frozen=True)
class Field:
    """A value of an element: its attribute, or its text when ``attr`` is empty."""

    select: str
    attr: str = ""
    notation: str = ""
    # "shown": as a browser shows it; "raw": only stripped; "tight": stripped pieces run together;
    # "spaced": stripped pieces with a blank between.
    text: str = "shown"


@dataclass(frozen=True)
class Cards:
    """Cards on a listing page. An empty ``link`` means the card itself, ".." its parent."""

    select: tuple
    link: str = ""
    title: Field | None = None
    date: Field | None = None
    required: str = ""
    base_url: str = ""
    skip_links: tuple = ()
    # A card whose date element is missing keeps the sentinel instead of being dropped.
    date_optional: bool = False


@dataclass(frozen=True)
class Rule:
    source: str
    folder: str
    roots: tuple = ()
    dates: tuple = ()
    title: Field | None = None
    cards: Cards | None = None
    pages: str = ""
    batch_size: int = BATCH_SIZE
    # Text steps on the joined content, in order: "newlines", "dashes", or literals to remove.
    text_steps: tuple = ()
    blank_is_missing: bool = False
    # The next of the dates serves when one cannot be read, not only when its element is absent.
    next_date_if_unreadable: bool = False
    # What an incremental run does with a listing that ends before a known article: "drop" or "keep" its rows.
    on_no_match: str = "drop"
    # What the last, partial batch of a full run adds to the label: its own "count", or a "full" batch size.
    remainder: str = "count"
    # Which of the pagination links holds the last page's number, from the end, and the number where none does.
    page_link: int = 2
    page_fallback: int | None = None

    @property
    def date_at(self) -> str:
        return "listing" if self.cards and self.cards.date else "detail"


_PUBLISHED = 'meta[property="article:published_time"]'

# The selectors, date notations and labels of the sources.
RULES = [
    Rule(
        source="ambcrypto.com", folder="ambcrypto",
        roots=(
            Root("div.single-post-main-middle",
                 ".post-nav, .ambcr-after-content_2, .ambcr-content_2, .ambcr-before-content_2, "
                 ".single-post-share, .wp-caption"),
            Root("div.blog-container >> div.left-container",
                 ".content-cointainer, table, .prediction-table-container"),
        ),
        dates=(Field(_PUBLISHED, "content", "D2"), Field('meta[name="published_at"]', "content", "D7")),
        cards=Cards(("div.archive-posts >> div.home-post-content",), 'a[rel="bookmark"]',
                    Field('a[rel="bookmark"] >> h2')),
    ),
    Rule(
        source="bankless.com", folder="bankless",
        roots=(Root("div.articleMainLoad >> div.contents",
                    ".postSubscribe, .kg-card, .border-decryptGridline"),),
        dates=(Field("div.articleMainLoad >> span.authorContent >> span", "", "D11a", "tight"),),
        cards=Cards(("div.contentList >> a.articleBlockSmall",), "", Field(".content .title")),
    ),
    Rule(
        source="beincrypto.com", folder="beincrypto",
        roots=(Root("div.entry-content-inner",
                    ".wp-block-image, .aff-primary, .aff-secondary, .aff-ternary, .rounded-lg.border"),),
        dates=(Field("time", "datetime", "D2"),),
        cards=Cards(('div[data-el="bic-c-news-big"]',), "h5.h-full a", Field("h5.h-full a")),
        pages='div.content >> a[data-el_pos="bic-c-pagination-last-page"]',
        text_steps=("newlines",),
        page_link=1,
    ),
    Rule(
        source="bitcoinist.com", folder="bitcoinist",
        roots=(Root("div.jeg_main_content",
                    ".related-reading-shortcode, .playlistThumb, .article-ad, .jeg_sharelist, "
                    ".newsletter-sign-up, .jnews_author_box_container, .jnews_related_post_container"),),
        dates=(Field(_PUBLISHED, "content", "D1"),),
        cards=Cards(("div.jeg_posts >> article.jeg_post",), ".jeg_postblock_content .jeg_post_title a",
                    Field(".jeg_postblock_content .jeg_post_title a")),
    ),
    Rule(
        source="bitcoinmagazine.com", folder="bitcoinmagazine",
        roots=(Root("div.m-detail--body"),),
        cards=Cards(("div.m-card--content",), "phoenix-ellipsis.m-ellipsis.m-card--header a",
                    Field("phoenix-ellipsis.m-ellipsis.m-card--header a >> h2"),
                    Field("phoenix-timeago time", "datetime", "D3")),
    ),
    Rule(
        source="blockchainalpha.tech", folder="blockchainalpha",
        roots=(Root("div#post-content-parent", ".permalink-heading, .embed-wrapper"),),
        dates=(Field("time", "datetime", "D5"),),
        cards=Cards(("div.blog-posts-wrapper >> div.blog-post-card",), "h2.blog-post-card-title a",
                    Field("h2.blog-post-card-title a")),
    ),
    Rule(
        source="blockonomi.com", folder="blockonomi",
        roots=(Root("div.post-content", ".adver"),),
        cards=Cards(("section.block-wrap >> article.l-post div.content",), "h2.is-title >> a",
                    Field("h2.is-title", text="raw"), Field("time.post-date", "datetime", "D4")),
        pages="a.page-numbers",
    ),
    Rule(
        source="blockworks.co", folder="blockworks",
        roots=(Root("section.w-full", ".not-prose, .article-ad, figure"),),
        cards=Cards(('div[class*="grid lg:grid-cols-4"] >> div.grid.grid-cols-1',), "a.font-headline",
                    Field("a.font-headline"), Field("time", "datetime", "D5")),
        on_no_match="keep",
    ),
    Rule(
        source="news.buildoncronos.com", folder="buildoncronos",
        roots=(Root("div.available-content"),),
        cards=Cards(('div[class^="container-"]',), "a", Field("a"), Field("time", "datetime", "D5")),
    ),
    Rule(
        source="coindesk.com", folder="coindesk",
        roots=(Root('div[data-module-name="article-body"]', ".border, .playlistThumb, .article-ad"),),
        dates=(Field('div[data-module-name="article-header"] >> div.Noto_Sans_xs_Sans-400-xs >> span',
                     "", "D8", "tight"),),
        cards=Cards(('div[data-module-name="timeline-module"] >> div.flex.gap-4',),
                    "a.text-color-charcoal-900", Field("a.text-color-charcoal-900")),
    ),
    Rule(
        source="coingape.com", folder="coingape",
        roots=(
            Root("div.main.c-content",
                 ".advertised, .twitter-tweet, .mobiless, .tags-container, #container, .authorBoxnew, "
                 ".Disclaimer, table, .keyfeatures"),
            Root("div.the_content",
                 ".advertised, .twitter-tweet, .mobiless, .tags-container, #container, .authorBoxnew, "
                 ".Disclaimer, table, .keyfeatures"),
        ),
        dates=(Field(_PUBLISHED, "content", "D1"),),
        cards=Cards(("div.articleslist >> div.newscoverga",), "div.covergadata a",
                    Field("div.covergadata a >> div.covertitle_edu"), required="span.newstimes"),
    ),
    Rule(
        source="coinpedia.org", folder="coinpedia",
        roots=(Root('div[class="entry-content entry clearfix"]',
                    ".postinfo, .stream-item, .post-bottom-meta"),),
        dates=(Field("span.post_date_display", "", "D10"),),
        cards=Cards(("div.post-details",), "h2.post-title a", Field("h2.post-title a")),
    ),
    Rule(
        source="cointelegraph.com", folder="cointelegraph",
        roots=(
            Root("article.post__article",
                 ".post-meta, .post__title, .newsletter-subscription-form_k9oQq, .tags-list, "
                 ".related-list, .reactions_3eiuR"),
            Root('div[data-ct-widget="explained-block"]', join="blocks",
                 heading='h2[data-ct-widget="explained-block-title"]'),
        ),
        cards=Cards(("div.post-card-inline__content",), "a.post-card-inline__title-link",
                    Field("a.post-card-inline__title-link"), Field("time", "datetime", "D14")),
        blank_is_missing=True,
    ),
    Rule(
        source="crypto.news", folder="crypto.news",
        roots=(Root("div.post-detail__content", ".post-detail__share, figure, .cn-block-related-link"),),
        cards=Cards(("div.post-archive__content >> div.post-loop",), "a.post-loop__link",
                    Field("a.post-loop__link"), Field("time", "datetime", "D3")),
        on_no_match="keep",
    ),
    Rule(
        source="blog.cryptoflies.com", folder="cryptoflies",
        roots=(Root('div[class="inner-post-entry entry-content"]',
                    ".post-tags, .hot, .penci-post-countview-number-check, .penci-ilrltpost-insert"),),
        cards=Cards(('ul[class="penci-wrapper-data penci-grid"] >> li[class="list-post pclist-layout"]',),
                    "h2.penci-entry-title >> a", Field("h2.penci-entry-title >> a", text="raw"),
                    Field('time[class="entry-date published"]', "datetime", "D4"), date_optional=True),
        pages="a.page-numbers",
        page_fallback=1,
    ),
    Rule(
        source="cryptonews.com", folder="cryptonews",
        roots=(Root("div.article-single__content.category_contents_details",
                    ".mb-10, .image, .twitter-tweet, .single-post-new__tags, "
                    ".single-post-new__last-updated-mobile, .single-post-new__author-top, "
                    ".single-post-new__accordion, .dslot, .news-tab-content, .follow-button, .news-tab"),),
        dates=(Field(_PUBLISHED, "content", "D4"),),
        cards=Cards(("div.archive-template-latest-news__wrap",), ".archive-template-latest-news",
                    Field(".archive-template-latest-news >> .archive-template-latest-news__title")),
        pages='a[class="page-numbers"]',
        page_link=1,
    ),
    Rule(
        source="cryptoslate.com", folder="cryptoslate",
        roots=(
            Root("article.full-article",
                 ".disclaimer, .posted-in, .post-meta-flex, .podcast-box, .unit-widgets, .link-page, "
                 ".related-articles, .footer-disclaimer"),
            Root("article > p", join="each"),
        ),
        dates=(Field(".author-info >> .post-date ++ .author-info >> .time", "", "D9", "spaced"),
               Field(".post-header.article >> .post-meta-single.sponsored .text span", "", "D9", "tight")),
        cards=Cards(("section.news-feed >> div.list-post",), "a", Field("div.title h2", text="raw")),
        pages="div.pagination a.page-numbers", batch_size=1000,
        remainder="full",
    ),
    Rule(
        source="dailycoin.com", folder="dailycoin",
        roots=(Root('div[class="mkd-post-text-inner clearfix"]',
                    "figure, .code-block, .social-share-icons"),),
        dates=(Field("div.mkd-post-info-date >> time", "datetime", "D3"),),
        cards=Cards(("div.wpb_wrapper >> div.dc-post-wrapper",), "a.dc-title-link",
                    Field("a.dc-title-link")),
    ),
    Rule(
        source="decrypt.co", folder="decrypt",
        roots=(Root("main >> div.post-content", ".hidden, .relative, .border-decryptGridline"),),
        dates=(Field("main >> header >> time", "datetime", "D6"),),
        title=Field("main >> header >> h1", text="tight"),
        cards=Cards(("main a.linkbox__overlay",)),
    ),
    Rule(
        source="droomdroom.com", folder="droomdroom",
        roots=(Root('div[class="entry-content rbct clearfix is-highlight-shares"]',
                    ".ruby-table-contents, figure"),),
        dates=(Field('time[class="date published"]', "datetime", "D4"),),
        cards=Cards(("div.block-inner >> h3.entry-title",), "a.p-url", Field("a.p-url", text="raw")),
        pages="a.page-numbers",
        page_fallback=1,
    ),
    Rule(
        source="globalcryptopress.com", folder="globalcryptopress",
        roots=(Root('div[class="post-body entry-content"]', "i, span"),),
        cards=Cards(("div.main.section >> div.panel-post",), "h3.title-post.entry-title a",
                    Field("h3.title-post.entry-title a"), Field("abbr.published", "title", "D3")),
        text_steps=("dashes",),
    ),
    Rule(
        source="holder.io", folder="holder.io",
        roots=(Root("article", ".postinfo, figure, blockquote"),),
        dates=(Field('meta[itemprop="datePublished"]', "content", "D3"),),
        cards=Cards(("div.post-cards >> section.post-card",), "h2.post-card__title a",
                    Field("h2.post-card__title a", text="raw")),
        pages="a.hlpagination__numbers",
    ),
    Rule(
        source="news.bitcoin.com", folder="news.bitcoin",
        roots=(Root(".article__body"),),
        dates=(Field(_PUBLISHED, "content", "D2"),
               Field('meta[property="article:modified_time"]', "content", "D2")),
        title=Field("main h1"),
        # The first is the lead story; it stands before the others.
        cards=Cards(("a h5 !first", "a h6"), ".."),
        blank_is_missing=True, next_date_if_unreadable=True,
    ),
    Rule(
        source="newsbtc.com", folder="newsbtc",
        roots=(Root("div.content-inner",
                    ".article-translation, .article-text-banner, .jeg_block_heading, .block-article, "
                    ".wp-caption-text"),),
        dates=(Field(_PUBLISHED, "content", "D1"),),
        cards=Cards(("div.jeg_main_content >> div.block-article__content",), "a",
                    Field("h4.block-article__title")),
    ),
    Rule(
        source="nftevening.com", folder="nftevening",
        roots=(Root("div.entry-content"),),
        dates=(Field(_PUBLISHED, "content", "D1"),),
        cards=Cards(("div.category-posts >> div.card-post__text",), "h3.title a", Field("h3.title a")),
    ),
    Rule(
        source="nftgators.com", folder="nftgators",
        roots=(Root("div.entry-content", ".wp-block-list",
                    ("Quick take", "Stay on top of things", "Subscribe to our newsletter",
                     "Follow us on")),),
        cards=Cards(("div.cs-content-area >> div.cs-entry__outer",), "p.cs-entry__title a",
                    Field("p.cs-entry__title a"), Field("div.cs-meta-date", "", "D11b")),
        text_steps=("Quick take:",),
    ),
    Rule(
        source="nonfungible.com", folder="nonfungible",
        roots=(Root('div[class="MuiBox-root css-xdym45"]', ".permalink-heading, .embed-wrapper"),
               Root('div[class="MuiBox-root css-mzvzpv"]', ".permalink-heading, .embed-wrapper")),
        dates=(Field('span[class="MuiBox-root css-k008qs"]', "", "D11c", "tight"),),
        cards=Cards(('a[class="MuiTypography-root MuiTypography-inherit MuiLink-root '
                     'MuiLink-underlineHover css-3pyhqk"]',), "", Field("p", text="tight"),
                    base_url="https://nonfungible.com", skip_links=("/about", "")),
    ),
    Rule(
        source="theblockcrypto.com", folder="theblockcrypto",
        roots=(Root("div.articleContent >> #articleContent", ".copyright"),),
        cards=Cards(("div.articles >> div.articleCard__content",), "a.appLink.articleCard__link",
                    Field("h2.articleCard__headline span"), Field("div.meta__wrapper", "", "D13")),
    ),
    Rule(
        source="turnmycoin.com", folder="turnmycoin",
        roots=(Root("div.elementor-widget-theme-post-content",
                    ".wp-block-essential-blocks-table-of-contents, .last-updated"),),
        dates=(Field('meta[property="og:updated_time"]', "content", "D1"),),
        cards=Cards(("div.eael-filter-gallery-container >> div.item-content",), "h2.title a",
                    Field("h2.title a")),
    ),
    Rule(
        source="unchainedcrypto.com", folder="unchainedcrypto",
        roots=(Root("div.post-content", ".advertised"),),
        dates=(Field(_PUBLISHED, "content", "D1"),),
        cards=Cards(("div.alm-paging-content >> div.group-posts",), "div.title a", Field("div.title a")),
    ),
    Rule(
        source="u.today", folder="u.today",
        roots=(Root("div.article__content", ".something, .hot"),),
        cards=Cards(("div.categories-list >> div.news__item",), "a.news__item-body",
                    Field("a.news__item-body >> div.news__item-title"),
                    Field("div.humble", "", "D12")),
    ),
]


def rule_map(rules=None) -> dict:
    return {rule.source: rule for rule in (RULES if rules is None else rules)}
