"""A page and a card of each source, written by hand after what its pages look like, not after the rules.

Fixed values: markup, date formats and what is to be read of them. In a page ``@A@`` and ``@B@`` are two pieces of its
text, ``@T@`` a title, ``@D@`` a date, and NOISE stands where nothing may be read; in a card ``@U@`` is its link.
"""

from dataclasses import dataclass


@dataclass(frozen=True)
class Sample:
    page: str
    card: str
    # A date that can be read, what is read of it, and what of one that cannot; a listing's None rejects the card.
    # In both ``@d@`` is the day of the month with two digits.
    raw: str
    read: str
    unread: str | None = "1970-01-01 00:00:00"
    dated: str = "page"
    titled: str = "card"
    # Cards with links below this address only.
    base: str = ""


def _meta(name, body, attribute="property"):
    return f'<html><head><meta {attribute}="{name}" content="@D@"></head><body>{body}</body></html>'


_OFFSET, _COLON, _ZULU = "2024-03-@d@T10:20:30+0200", "2024-03-@d@T10:20:30+02:00", "2024-03-@d@T10:20:30.000Z"
_WALL, _UTC, _DAY = "2024-03-@d@ 10:20:30", "2024-03-@d@ 08:20:30", "2024-03-@d@ 00:00:00"
_PUBLISHED = "article:published_time"
_TEXT = "<p>@A@</p>\n<p>@B@</p>"

SAMPLES = {
    "ambcrypto.com": Sample(
        _meta(_PUBLISHED, f'<div class="x single-post-main-middle">{_TEXT}<div class="post-nav">NOISE</div><p class="wp-caption">NOISE</p></div>'),
        '<div class="archive-posts"><div class="home-post-content"><a rel="bookmark" href="@U@"><h2>@T@</h2></a></div></div>', _OFFSET, _WALL),
    "bankless.com": Sample(
        '<div class="articleMainLoad"><span class="authorContent"><span>@D@</span><span>NOISE</span></span>'
        f'<div class="contents">{_TEXT}<div class="kg-card">NOISE</div><div class="postSubscribe">NOISE</div></div></div>',
        '<div class="contentList"><a class="articleBlockSmall" href="@U@"><div class="content"><div class="title">@T@</div></div></a></div>',
        "Mar @d@, 2024", _DAY),
    "beincrypto.com": Sample(
        f'<time datetime="@D@">NOISE</time><div class="entry-content-inner">{_TEXT}<div class="wp-block-image">NOISE</div>'
        '<div class="rounded-lg border">NOISE</div></div>',
        '<div class="content"><div class="flex flex-wrap"><div data-el="bic-c-news-big"><h5 class="h-full"><a href="@U@">@T@</a></h5></div></div></div>',
        _OFFSET, _WALL),
    "bitcoinist.com": Sample(
        _meta(_PUBLISHED, f'<div class="jeg_main_content">{_TEXT}<div class="jeg_sharelist">NOISE</div><div class="article-ad">NOISE</div></div>'),
        '<div class="jeg_posts"><article class="jeg_post"><div class="jeg_postblock_content"><h3 class="jeg_post_title"><a href="@U@">@T@</a></h3></div></article></div>',
        _OFFSET, _UTC),
    "bitcoinmagazine.com": Sample(
        f'<div class="m-detail--body">{_TEXT}</div>',
        '<div class="m-card--content"><phoenix-ellipsis class="m-ellipsis m-card--header"><a href="@U@"><h2>@T@</h2></a></phoenix-ellipsis>'
        '<phoenix-timeago><time datetime="@D@">now</time></phoenix-timeago></div>', _COLON, _UTC, None, "card"),
    "blockchainalpha.tech": Sample(
        f'<time datetime="@D@">x</time><div id="post-content-parent">{_TEXT}<h2 class="permalink-heading">NOISE</h2><div class="embed-wrapper">NOISE</div></div>',
        '<div class="blog-posts-wrapper"><div class="blog-post-card"><h2 class="blog-post-card-title"><a href="@U@">@T@</a></h2></div></div>', _ZULU, _WALL),
    "blockonomi.com": Sample(
        f'<div class="post-content">{_TEXT}<div class="adver">NOISE</div></div>',
        '<section class="block-wrap"><article class="l-post"><div class="content"><h2 class="is-title"><a href="@U@">@T@</a></h2>'
        '<time class="post-date" datetime="@D@">x</time></div></article></section>', _COLON, _WALL, None, "card"),
    "blockworks.co": Sample(
        f'<section class="w-full">{_TEXT}<figure>NOISE</figure><div class="not-prose">NOISE</div></section>',
        '<div class="a grid lg:grid-cols-4 b"><div class="grid grid-cols-1"><a class="font-headline" href="@U@">@T@</a><time datetime="@D@">x</time></div></div>',
        _ZULU, _WALL, None, "card"),
    "news.buildoncronos.com": Sample(
        f'<div class="available-content">{_TEXT}</div>',
        '<div class="portable-archive-list"><div class="container-xyz"><a href="@U@">@T@</a><time datetime="@D@">x</time></div></div>',
        _ZULU, _WALL, None, "card"),
    "coindesk.com": Sample(
        '<div data-module-name="article-header"><div class="Noto_Sans_xs_Sans-400-xs"><span>Updated Apr 1, 2024, 1:00 p.m. UTC</span><span>Published @D@</span></div></div>'
        f'<div data-module-name="article-body">{_TEXT}<div class="border">NOISE</div><div class="playlistThumb">NOISE</div></div>',
        '<div data-module-name="timeline-module"><div class="flex gap-4"><a class="text-color-charcoal-900" href="@U@">@T@</a></div></div>',
        "Mar @d@, 2024, 10:20 a.m. UTC", "2024-03-@d@ 10:20:00"),
    "coingape.com": Sample(
        _meta(_PUBLISHED, f'<div class="main c-content">{_TEXT}<div class="mobiless">NOISE</div><table><tr><td>NOISE</td></tr></table></div>'),
        '<div class="articleslist"><div class="newscoverga"><div class="covergadata"><a href="@U@"><div class="covertitle_edu">@T@</div></a></div>'
        '<span class="newstimes">1 hour ago</span></div></div>', _OFFSET, _UTC),
    "coinpedia.org": Sample(
        f'<span class="post_date_display">@D@</span><div class="entry-content entry clearfix">{_TEXT}<div class="postinfo">NOISE</div><div class="stream-item">NOISE</div></div>',
        '<div class="post-details"><h2 class="post-title"><a href="@U@">@T@</a></h2></div>', "Mar @d@, 2024 10:20 UTC", "2024-03-@d@ 10:20:00"),
    "cointelegraph.com": Sample(
        f'<article class="post__article"><h1 class="post__title">NOISE</h1>{_TEXT}<ul class="tags-list"><li>NOISE</li></ul></article>',
        '<div class="post-card-inline__content"><a class="post-card-inline__title-link" href="@U@">@T@</a><time datetime="@D@">x</time></div>',
        "2024-03-@d@", _DAY, "soon 00:00:00", "card"),
    "crypto.news": Sample(
        f'<div class="post-detail__content">{_TEXT}<figure>NOISE</figure><div class="cn-block-related-link">NOISE</div></div>',
        '<div class="post-archive__content"><div class="post-loop"><a class="post-loop__link" href="@U@">@T@</a><time datetime="@D@">x</time></div></div>',
        _COLON, _UTC, None, "card"),
    "blog.cryptoflies.com": Sample(
        f'<div class="inner-post-entry entry-content">{_TEXT}<div class="post-tags">NOISE</div><div class="hot">NOISE</div></div>',
        '<ul class="penci-wrapper-data penci-grid"><li class="list-post pclist-layout"><h2 class="penci-entry-title"><a href="@U@">@T@</a></h2>'
        '<time class="entry-date published" datetime="@D@">x</time></li></ul>', _COLON, _WALL, None, "card"),
    "cryptonews.com": Sample(
        _meta(_PUBLISHED, f'<div class="article-single__content category_contents_details">{_TEXT}<div class="mb-10">NOISE</div><div class="dslot">NOISE</div></div>'),
        '<div class="archive-template-latest-news__wrap"><a class="archive-template-latest-news" href="@U@"><div class="archive-template-latest-news__title">@T@</div></a></div>',
        _COLON, _WALL),
    "cryptoslate.com": Sample(
        '<div class="author-info"><div class="post-date">@D@ <span class="time">at 10:20 AM UTC</span></div></div>'
        f'<article class="full-article">{_TEXT}<div class="disclaimer">NOISE</div><div class="podcast-box">NOISE</div></article>',
        '<section class="news-feed"><div class="list-post"><a href="@U@"><div class="title"><h2>@T@</h2></div></a></div></section>',
        "Mar. @d@, 2024", "2024-03-@d@ 10:20:00"),
    "dailycoin.com": Sample(
        '<div class="mkd-post-info-date"><time datetime="@D@">x</time></div>'
        f'<div class="mkd-post-text-inner clearfix">{_TEXT}<figure>NOISE</figure><div class="code-block">NOISE</div></div>',
        '<div class="wpb_wrapper"><div class="dc-post-wrapper"><a class="dc-title-link" href="@U@">@T@</a></div></div>', _COLON, _UTC),
    "decrypt.co": Sample(
        f'<main><header><h1>@T@</h1><time datetime="@D@">x</time></header><div class="post-content">{_TEXT}<div class="hidden">NOISE</div><div class="relative">NOISE</div></div></main>',
        '<main><a class="linkbox__overlay" href="@U@">NOISE</a></main>', "2024-03-@d@T10:20:30Z", _WALL, titled="page"),
    "droomdroom.com": Sample(
        f'<time class="date published" datetime="@D@">x</time><div class="entry-content rbct clearfix is-highlight-shares">{_TEXT}<figure>NOISE</figure>'
        '<div class="ruby-table-contents">NOISE</div></div>',
        '<div class="block-inner"><h3 class="entry-title"><a class="p-url" href="@U@">@T@</a></h3></div>', _COLON, _WALL),
    "globalcryptopress.com": Sample(
        '<div class="post-body entry-content"><p>@A@---</p><p>@B@</p><i>NOISE</i><span>NOISE</span></div>',
        '<div class="main section"><div class="panel-post"><h3 class="title-post entry-title"><a href="@U@">@T@</a></h3><abbr class="published" title="@D@">x</abbr></div></div>',
        _COLON, _UTC, None, "card"),
    "holder.io": Sample(
        _meta("datePublished", f"<article>{_TEXT}<figure>NOISE</figure><blockquote>NOISE</blockquote></article>", "itemprop"),
        '<div class="post-cards"><section class="post-card"><h2 class="post-card__title"><a href="@U@">@T@</a></h2></section></div>', _COLON, _UTC),
    "news.bitcoin.com": Sample(
        _meta(_PUBLISHED, f'<main><h1>@T@</h1><div class="article__body">{_TEXT}</div></main>'),
        '<div><a href="@U@"><h6>NOISE</h6></a></div>', _OFFSET, _WALL, titled="page"),
    "newsbtc.com": Sample(
        _meta(_PUBLISHED, f'<div class="content-inner">{_TEXT}<div class="jeg_block_heading">NOISE</div><p class="wp-caption-text">NOISE</p></div>'),
        '<div class="jeg_main_content"><div class="block-article__content"><a href="@U@"><h4 class="block-article__title">@T@</h4></a></div></div>', _OFFSET, _UTC),
    "nftevening.com": Sample(
        _meta(_PUBLISHED, f'<div class="entry-content">{_TEXT}</div>'),
        '<div class="category-posts"><div class="card-post__text"><h3 class="title"><a href="@U@">@T@</a></h3></div></div>', _OFFSET, _UTC),
    "nftgators.com": Sample(
        f'<div class="entry-content">{_TEXT}<ul class="wp-block-list"><li>NOISE</li></ul><p>Follow us on <b>NOISE</b></p></div>',
        '<div class="cs-content-area"><div class="cs-entry__outer"><p class="cs-entry__title"><a href="@U@">@T@</a></p><div class="cs-meta-date">@D@</div></div></div>',
        "March @d@, 2024", _DAY, None, "card"),
    "nonfungible.com": Sample(
        f'<span class="MuiBox-root css-k008qs">@D@ ·</span><div class="MuiBox-root css-xdym45">{_TEXT}<h2 class="permalink-heading">NOISE</h2></div>',
        '<a class="MuiTypography-root MuiTypography-inherit MuiLink-root MuiLink-underlineHover css-3pyhqk" href="@U@"><p>@T@</p></a>', "03/@d@/24", _DAY,
        base="https://nonfungible.com"),
    "theblockcrypto.com": Sample(
        f'<div class="articleContent"><div id="articleContent">{_TEXT}<div class="copyright">NOISE</div></div></div>',
        '<div class="articles"><div class="articleCard__content"><a class="appLink articleCard__link" href="@U@"><h2 class="articleCard__headline"><span>@T@</span></h2></a>'
        '<div class="meta__wrapper">@D@</div></div></div>', "Mar @d@, 2024, 10:20AM EST", "2024-03-@d@ 15:20:00", dated="card"),
    "turnmycoin.com": Sample(
        _meta("og:updated_time", f'<div class="a elementor-widget-theme-post-content">{_TEXT}<p class="last-updated">NOISE</p></div>'),
        '<div class="eael-filter-gallery-container"><div class="item-content"><h2 class="title"><a href="@U@">@T@</a></h2></div></div>', _OFFSET, _UTC),
    "unchainedcrypto.com": Sample(
        _meta(_PUBLISHED, f'<div class="post-content">{_TEXT}<div class="advertised">NOISE</div></div>'),
        '<div class="alm-paging-content"><div class="group-posts"><div class="title"><a href="@U@">@T@</a></div></div></div>', _OFFSET, _UTC),
    "u.today": Sample(
        f'<div class="article__content">{_TEXT}<div class="hot">NOISE</div><div class="something">NOISE</div></div>',
        '<div class="categories-list"><div class="news__item"><a class="news__item-body" href="@U@"><div class="news__item-title">@T@</div></a><div class="humble">@D@</div></div></div>',
        "Mar @d@, 2024 - 10:20", "2024-03-@d@ 10:20:00", None, "card"),
}
