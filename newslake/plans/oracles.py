"""The same queries in SQL, for an independent check on the same tables."""

from newslake.functions.page import ENTITIES
from newslake.plans.queries import PHRASES, SKIPPED
from newslake.plans.source_pages import SAMPLES
from newslake.sources.sites import SITE_CATEGORIES

_ORACLES = {}
_NO_DATE = "1970-01-01 00:00:00"


def oracle(name, sql):
    _ORACLES[name] = sql


def all_oracles() -> dict:
    return dict(_ORACLES)


def quoted(value):
    return "'" + value.replace("'", "''") + "'"


def listed(values):
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def strip(x):
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def unescape(x):
    for name, char in ENTITIES.items():
        optional = "" if name.endswith(";") else ";?"
        char = "chr(1)" if char == "\x01" else quoted(char)
        x = f"regexp_replace({x}, '{name}{optional}', {char}, 'g')"
    return f"replace({x}, chr(1), '&')"


def inner(tag, html="html"):
    return rf"regexp_extract({html}, '(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>', 1)"


def visible(html, between="' '"):
    not_text = r"'(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->'"
    marked = f"regexp_replace(regexp_replace({html}, {not_text}, chr(1), 'g'), '<[^>]*>', chr(1), 'g')"
    joined = rf"regexp_replace({marked}, '[\s\x01]*\x01[\s\x01]*', {between}, 'g')"
    return unescape(strip(joined))


def first_text(*tags):
    return "coalesce(" + ", ".join(f"nullif({visible(inner(t))}, '')" for t in tags) + ")"


def default(x, value):
    return f"CASE WHEN {x} IS NULL OR {strip(x)} = '' THEN {quoted(value)} ELSE {x} END"


HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"
HREFS = r"""regexp_extract_all(html, '(?is)<li><a href="([^"]*)">', 1)"""
LABELS = r"""regexp_extract_all(html, '(?is)<li><a href="[^"]*">(.*?)</a>', 1)"""
BODY = rf"""regexp_replace({inner('article')}, '(?is)<div[^>]*class="ad"[^>]*>.*?</div>', '', 'g')"""
TITLE = default(first_text("title"), "No Title")
CONTENT = default(visible(BODY), "No content")
FIRST_LINE = "string_split(text, chr(10))[1]"
STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S')"

oracle("quality_report", f"""
WITH a AS (
  SELECT {HOST} AS source, md5(url) AS id, page_id, {TITLE} AS title, {CONTENT} AS content FROM pages),
f AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY source, id ORDER BY page_id) = 1)
SELECT source, count(*) AS articles,
       count(*) FILTER (WHERE content = 'No content') AS no_content,
       count(*) FILTER (WHERE title = 'No Title') AS no_title,
       count(*) AS no_date
FROM f GROUP BY source""")

oracle("article_body", f"SELECT page_id, {TITLE} AS title, {CONTENT} AS content FROM pages")

_h1_gone = rf"regexp_replace({inner('article')}, '(?is)<h1>.*?</h1>', chr(1), 'g')"
oracle("article_body_rules", f"""
SELECT page_id, md5(url) AS id, {unescape(strip(inner('h1')))} AS title,
       {visible(_h1_gone)} AS content FROM pages""")

_CARDS = f"""
cards AS (
  SELECT page_id, {HOST} AS category, unnest(range(len({HREFS}))) AS pos,
         unnest({HREFS}) AS href, unnest({LABELS}) AS raw_label
  FROM pages),
links AS (SELECT page_id, category, pos, {unescape('href')} AS url, href, {unescape('raw_label')} AS label FROM cards)"""

oracle("listing_rules", f"""
WITH {_CARDS}
SELECT page_id, category, pos, md5(url) AS id, url, {strip('label')} AS title
FROM links WHERE url NOT IN {listed(SKIPPED)}""")

oracle("listing_rejects", f"""
WITH {_CARDS}
SELECT page_id, pos, url, 'skipped link' AS reject_reason FROM links WHERE url IN {listed(SKIPPED)}""")

oracle("article_fallback", f"""
SELECT page_id, {default(first_text('main', 'article'), 'No content')} AS content FROM pages""")

oracle("page_meta", r"""
SELECT page_id, nullif(regexp_extract(html, '(?is)<html\s[^>]*?\blang="([^"]*)"', 1), '') AS lang,
       nullif(regexp_extract(html, '(?is)<meta\s[^>]*?\bcharset="([^"]*)"', 1), '') AS charset FROM pages""")

oracle("page_title", f"""
SELECT page_id, {default(first_text('h1', 'title'), 'No Title')} AS title FROM pages""")

oracle("block_concat", f"""
SELECT page_id, {visible(inner('h1'), "''")} || ' ' || array_to_string(
  list_filter(list_transform(regexp_extract_all({inner('article')}, '(?is)<p>(.*?)</p>', 1),
                             lambda p: {visible('p', "''")}), lambda p: p <> ''), ' ') AS content
FROM pages""")

oracle("listing_links", f"WITH {_CARDS} SELECT page_id, pos, href, label FROM links")

oracle("filter_links", f"""
WITH {_CARDS}
SELECT page_id, pos, href, label AS title FROM links
WHERE href NOT IN {listed(SKIPPED)} AND length(label) > 2""")

oracle("cards_per_page", f"WITH {_CARDS} SELECT page_id, count(*) AS cards FROM links GROUP BY page_id")

oracle("page_count", f"""
SELECT page_id, coalesce(length({LABELS}[-1]) * (page_id + 1) * 97, 1) AS pages FROM pages""")

oracle("url_id", "SELECT page_id, md5(url) AS id FROM pages")

oracle("trim_title", rf"""
SELECT doc_id, {strip(FIRST_LINE)} AS title,
       {strip(r"regexp_replace(text, '[\s\p{Z}]+', ' ', 'g')")} AS squeezed FROM documents""")

oracle("clean_text", f"""
SELECT doc_id, {strip("regexp_replace(replace(replace(replace(replace(replace(text, 'Quick take:', ''), '·', ''), 'The ', ''), chr(10), ' '), ', ', '---'), '-{2,}', '', 'g')")}
  AS content FROM documents""")

oracle("split_parts", """
SELECT page_id, string_split(url, '?')[1] AS path, string_split(url, '/')[-1] AS tail FROM pages""")

_has_phrase = " OR ".join(f"contains(p, {quoted(p)})" for p in PHRASES)
oracle("drop_phrases", f"""
SELECT doc_id, array_to_string(list_filter(
  list_transform(string_split(text, chr(10)), lambda p: {strip('p')}),
  lambda p: p <> '' AND NOT ({_has_phrase})), ' ') AS content FROM documents""")

_forms = ["D1", "D1", "D2", "D3", "D4", "D5", "D6", "D7", "D8", "D9", "D10", "D11a", "D11b", "D11c", "D12",
          "D13", "D13", "D14", "D15", "D1"]
_names = " ".join(f"WHEN {i} THEN {quoted(n)}" for i, n in enumerate(_forms))
oracle("parse_dates", f"""
SELECT event_id, CASE event_id % 20 {_names} END AS notation,
  CASE event_id % 20
    WHEN 0 THEN strftime(ts - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S')
    WHEN 1 THEN strftime(ts + INTERVAL 210 MINUTE, '%Y-%m-%d %H:%M:%S')
    WHEN 3 THEN strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S')
    WHEN 8 THEN strftime(ts, '%Y-%m-%d %H:%M:00') WHEN 9 THEN strftime(ts, '%Y-%m-%d %H:%M:00')
    WHEN 10 THEN strftime(ts, '%Y-%m-%d %H:%M:00') WHEN 14 THEN strftime(ts, '%Y-%m-%d %H:%M:00')
    WHEN 11 THEN strftime(ts, '%Y-%m-%d 00:00:00') WHEN 12 THEN strftime(ts, '%Y-%m-%d 00:00:00')
    WHEN 13 THEN strftime(ts, '%Y-%m-%d 00:00:00') WHEN 17 THEN strftime(ts, '%Y-%m-%d 00:00:00')
    WHEN 15 THEN strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:00')
    WHEN 16 THEN '{_NO_DATE}' WHEN 19 THEN NULL
    ELSE {STAMP} END AS published_at
FROM events""")

_EVENTS = f"""
ev AS (
  SELECT event_id, props AS content, md5('https://events.example/' || event_id) AS id,
         CASE event_type WHEN 'error' THEN '{_NO_DATE}' WHEN 'view' THEN 'None 00:00:00' ELSE {STAMP} END AS published_at,
         event_type AS source, 'user ' || user_id AS title, 'https://events.example/' || event_id AS url,
         CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(floor(epoch(ts)) AS BIGINT) END AS epoch_s
  FROM events)"""
_PUBLISHED = f"""
WITH {_EVENTS} SELECT content, id, epoch_s AS published_at, source, title, url FROM ev"""
oracle("publish_documents", _PUBLISHED)
oracle("stream_dedup", _PUBLISHED)
oracle("stream_dedup_state", _PUBLISHED)
oracle("publish_datasource", _PUBLISHED)
oracle("sink_roundtrip", f"WITH {_EVENTS} SELECT content, id, published_at, source, title, url FROM ev")

oracle("project_article", f"""
SELECT text AS content, md5('https://lake.example/' || source || '/' || lang || '/' || doc_id) AS id,
       CAST(NULL AS VARCHAR) AS published_at, 'lake.example' AS source, {FIRST_LINE} AS title,
       'https://lake.example/' || source || '/' || lang || '/' || doc_id AS url FROM documents""")

oracle("rejects", """
SELECT d.doc_id, CASE WHEN length(text) <= 100 THEN 'text' WHEN quality IS NULL THEN 'label'
                      WHEN quality <> 1 THEN 'quality' END AS reject_reason
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")

oracle("api_hits", f"""
WITH h AS (
  SELECT event_type, ts, props, unnest(['https://api.example/' || event_id, 'https://api.example/' || event_id || '/2']) AS url
  FROM events)
SELECT regexp_extract(props, ':\\s*([0-9]+)', 1) AS content, md5(url) AS id, {STAMP} AS published_at,
       'api.example' AS source, event_type AS title, url FROM h""")

_KEYS = f"""
keys AS (
  SELECT {HOST} AS site,
         CASE WHEN NOT starts_with(url, 'https://www.') THEN regexp_extract(url, '/([a-z]{{2}})/([0-9]+)', 1) END AS category,
         CASE WHEN contains(url, 'page=') THEN 'incremental' ELSE 'initial' END AS kind,
         regexp_extract(url, '/([a-z]{{2}})/([0-9]+)', 2) AS stamp FROM pages),
paths AS (
  SELECT *, CAST(stamp AS BIGINT) AS seq,
         'web_crawler/' || site || '/' || CASE WHEN category IS NULL THEN site ELSE category || '/' || site || '_' || category END
         || CASE kind WHEN 'initial' THEN '_initial_batch_' ELSE '_incremental_crawled_at_' END || stamp || '.json' AS path
  FROM keys)"""
oracle("batch_catalog", f"""
WITH {_KEYS}
SELECT site, category, kind, count(*) AS files, min(seq) AS first_seq, max(seq) AS last_seq
FROM paths GROUP BY site, category, kind""")

oracle("latest_batch", f"""
WITH {_KEYS}
SELECT site, category, seq AS last_batch, path FROM paths WHERE kind = 'initial'
QUALIFY row_number() OVER (PARTITION BY site, category ORDER BY seq DESC, path DESC) = 1""")

oracle("state_file", f"""
WITH {_KEYS}
SELECT site, category, path FROM paths
QUALIFY row_number() OVER (PARTITION BY site, category ORDER BY CASE kind WHEN 'incremental' THEN 0 ELSE 1 END,
  CASE WHEN kind = 'incremental' THEN stamp END DESC, CASE WHEN kind = 'initial' THEN seq END, path) = 1""")

oracle("resume_point", """
SELECT CAST(conv_id AS VARCHAR) AS path, md5(text) AS last_id FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""")

oracle("recent_ids", """
SELECT CAST(conv_id AS VARCHAR) AS path, turn AS pos, md5(text) AS id FROM conversations WHERE turn < 3""")

_pairs = ", ".join(f"({quoted(s)}, {quoted(c)})" for s, names in SITE_CATEGORIES.items() for c in names)
oracle("dim_site_category", f"""
WITH pairs(site, category) AS (VALUES {_pairs}),
docs AS (
  SELECT ['coindesk', 'nftgators', 'droomdroom'][length(source) - 3] AS site,
         CASE lang WHEN 'en' THEN 'metaverse' WHEN 'fr' THEN 'markets' ELSE 'web3' END AS category FROM documents),
n AS (SELECT site, category, count(*) AS n FROM docs GROUP BY site, category)
SELECT p.site, p.category, coalesce(n.n, 0) AS articles
FROM pairs p LEFT JOIN n ON p.site = n.site AND p.category = n.category""")

oracle("keep_first", """
SELECT md5(text) AS id, doc_id AS pos, source, lang FROM documents
QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1""")

oracle("dedup_any", """
SELECT DISTINCT md5(text) AS id, length(text) AS chars, text FROM documents""")

_LISTING = """
l AS (
  SELECT CAST(user_id AS VARCHAR) AS source, event_id, event_type, ts, value, md5(CAST(event_id AS VARCHAR)) AS id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS pos FROM events)"""


def _cut(seen, limit, keep):
    return f"""
WITH {_LISTING},
seen AS (SELECT source, id FROM l WHERE {seen} QUALIFY row_number() OVER (PARTITION BY source ORDER BY pos) <= 15),
stops AS (SELECT l.source, min(pos) AS stop FROM l JOIN seen USING (source, id) GROUP BY l.source),
cut AS (
  SELECT l.source, event_id, id, row_number() OVER (PARTITION BY l.source ORDER BY pos) AS rn, stop,
         count(*) OVER (PARTITION BY l.source) AS n
  FROM l LEFT JOIN stops ON l.source = stops.source WHERE stop IS NULL OR pos < stop)
SELECT source, event_id, id, rn FROM cut WHERE rn <= {limit} AND ({keep})"""


oracle("take_until_seen", _cut("ts < TIMESTAMP '2024-01-20'", 500, "true"))
oracle("stream_cut", _cut("event_type = 'error' AND value > 25", 10 ** 9, "stop IS NOT NULL"))
oracle("take_until_seen_drop", _cut("event_type = 'error' AND value > 25", 50, "stop IS NOT NULL OR n > 50"))

oracle("top_n_per_source", f"""
WITH {_LISTING} SELECT source, event_id, pos AS rn FROM l WHERE pos <= 20""")

oracle("resume_after", f"""
WITH {_LISTING},
last AS (SELECT source, pos AS cut FROM l WHERE event_type = 'purchase'
         QUALIFY row_number() OVER (PARTITION BY source ORDER BY value DESC, event_id DESC) = 1)
SELECT l.source, event_id, id FROM l LEFT JOIN last ON l.source = last.source WHERE cut IS NULL OR pos > cut""")

oracle("assign_batches", """
WITH r AS (
  SELECT o_orderstatus AS source, o_orderpriority AS category, o_orderkey,
         row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS rn,
         count(*) OVER (PARTITION BY o_orderstatus, o_orderpriority) AS n,
         min(o_orderkey) OVER (PARTITION BY o_orderstatus, o_orderpriority) * 100 AS base FROM orders)
SELECT source, category, o_orderkey, rn, base + least(CAST(ceil(rn / 100.0) AS BIGINT) * 100, n) AS batch_no FROM r""")

oracle("listing_with_detail", f"""
SELECT d.doc_id AS pos, 'https://docs.example/' || d.doc_id AS url, source,
       CASE WHEN toxic = 1 THEN 'flagged' ELSE {default(FIRST_LINE, 'No Title')} END AS title,
       CASE WHEN quality IS NULL THEN 'No content' ELSE 'quality ' || quality END AS content
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")

_DOCS = f"""
docs AS (
  SELECT doc_id, lang AS source,
         CASE WHEN lang <> 'en' THEN CASE WHEN length(source) = 4 THEN 'early' ELSE 'late' END END AS category,
         md5('https://docs.example/' || source || '/' || lang || '/' || doc_id) AS id,
         'https://docs.example/' || source || '/' || lang || '/' || doc_id AS url, n_chars,
         {default(FIRST_LINE, 'No Title')} AS title, {default('text', 'No content')} AS content
  FROM documents)"""


def _numbered(size):
    return f"""
numbered AS (
  SELECT *, row_number() OVER k AS rn, count(*) OVER (PARTITION BY source, category) AS n,
         least(CAST(ceil(row_number() OVER k / {size}.0) AS BIGINT) * {size}, count(*) OVER (PARTITION BY source, category)) AS seq
  FROM docs WINDOW k AS (PARTITION BY source, category ORDER BY doc_id))"""


oracle("src_articles_json", f"""
WITH {_DOCS} SELECT content, id, '{_NO_DATE}' AS published_at, source, title, url FROM docs""")
_MIGRATED = f"""
WITH {_DOCS} SELECT content, id, CAST(NULL AS BIGINT) AS published_at, source, title, url FROM docs"""
oracle("migrate_all", _MIGRATED)
oracle("stream_ingest", _MIGRATED)

oracle("src_batches_ordered", f"""
WITH {_DOCS}, {_numbered(100)}
SELECT source AS site, category, seq, (rn - 1) % 100 AS pos, id, title FROM numbered""")

oracle("crawl_state", f"""
WITH {_DOCS}, {_numbered(100)}
SELECT source AS site, category, id, CAST(NULL AS BIGINT) AS last_batch FROM numbered WHERE rn <= 15
UNION ALL
SELECT source AS site, category, id, seq AS last_batch FROM numbered WHERE rn = n""")

oracle("lake_batches", f"""
WITH {_DOCS}, {_numbered(100)}
SELECT source AS site, category, 'latest' AS what, max(seq) AS seq FROM numbered GROUP BY source, category
UNION ALL
SELECT source, category, 'state', min(seq) FROM numbered GROUP BY source, category""")

_EIGHTHS = f"""
WITH {_DOCS},
runs AS (SELECT *, CAST(floor(doc_id * 8.0 / ((SELECT max(doc_id) FROM docs) + 1)) AS BIGINT) AS number FROM docs)"""
oracle("lake_compacted", f"""{_EIGHTHS}
SELECT source AS site, category, 'incremental' AS kind, number AS seq, doc_id AS pos, id, title, content FROM runs
UNION ALL
SELECT source, category, 'summary of incremental_' || number, number, count(*), NULL, NULL, NULL FROM runs GROUP BY source, category, number""")
oracle("known_ids_pruned", f"""{_EIGHTHS}
SELECT source AS site, category, id FROM runs WHERE number = 7""")

oracle("list_batch_files", f"""
WITH {_DOCS}, {_numbered(100)}
SELECT DISTINCT source AS site, category, 'initial' AS kind, seq FROM numbered""")

oracle("migrate_counts", f"""
WITH {_DOCS}, {_numbered(100)}
SELECT source AS site, category, seq, count(*) AS inserted FROM numbered GROUP BY source, category, seq
UNION ALL
SELECT NULL, NULL, NULL, count(*) FROM numbered""")

oracle("concat_per_input", f"""
SELECT DISTINCT lang AS source, md5({FIRST_LINE}) AS id, {FIRST_LINE} AS url FROM documents""")
oracle("concat_one_scan", f"""
WITH named AS (
  SELECT unnest(range(18))::INTEGER AS _input, unnest([
    ['de'], ['en'], ['es'], ['fr'], ['de'], ['en'], ['es'], ['fr'], ['de'], ['en'], ['es'], ['fr'], ['de', 'en', 'es', 'fr'],
    ['de', 'fr'], ['de', 'en', 'es'], ['en', 'es'], ['es'], ['de', 'en', 'es', 'fr']]) AS langs)
SELECT _input, lang AS source, count(*) AS articles, count(DISTINCT md5({FIRST_LINE})) AS ids
FROM named JOIN documents ON list_contains(langs, lang) GROUP BY _input, lang""")
oracle("concat_global", f"""
SELECT DISTINCT md5({FIRST_LINE}) AS id, {FIRST_LINE} AS url FROM documents""")

oracle("job_incremental", f"""
WITH {_DOCS},
l AS (SELECT *, row_number() OVER (PARTITION BY source, category ORDER BY doc_id) AS pos,
             row_number() OVER (PARTITION BY source, category ORDER BY n_chars DESC, doc_id) AS k FROM docs),
stops AS (SELECT source, category, min(pos) AS stop FROM l WHERE k <= 2 GROUP BY source, category)
SELECT l.category, pos AS rn, content, id, CAST(NULL AS BIGINT) AS published_at, l.source, title, url
FROM l JOIN stops ON l.source = stops.source AND l.category IS NOT DISTINCT FROM stops.category WHERE pos < stop""")

oracle("job_full", f"""
WITH {_DOCS},
last AS (
  SELECT source, category, doc_id AS cut, count(*) OVER (PARTITION BY source) * 100 AS base FROM docs WHERE source = 'en'
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id DESC) = 1),
rest AS (
  SELECT d.*, coalesce(base, 0) AS base FROM docs d
  LEFT JOIN last ON d.source = last.source AND d.category IS NOT DISTINCT FROM last.category WHERE cut IS NULL OR doc_id > cut),
r AS (
  SELECT *, row_number() OVER (PARTITION BY source, category ORDER BY doc_id) AS rn,
         count(*) OVER (PARTITION BY source, category) AS n FROM rest)
SELECT category, base + least(CAST(ceil(rn / 10.0) AS BIGINT) * 10, n) AS batch_no, rn, content, id,
       '{_NO_DATE}' AS published_at, source, title, url FROM r""")

oracle("job_incremental_pages", f"""
WITH p AS (
  SELECT page_id, {HOST} AS category, url, {unescape(strip(inner('h1')))} AS title, {visible(_h1_gone)} AS content,
         row_number() OVER (PARTITION BY {HOST} ORDER BY page_id) AS pos,
         row_number() OVER (PARTITION BY {HOST} ORDER BY length(html) DESC, page_id) AS k FROM pages),
stops AS (SELECT category, pos AS stop FROM p WHERE k = 1)
SELECT p.category, pos AS rn, content, md5(url) AS id, CAST(NULL AS BIGINT) AS published_at, 'driver' AS source, title, url
FROM p JOIN stops ON p.category = stops.category WHERE pos < stop""")


oracle("read_large_json", """
SELECT doc_id // 20000 AS file, row_number() OVER (PARTITION BY doc_id // 20000 ORDER BY doc_id) - 1 AS pos,
       md5('https://docs.example/' || source || '/' || lang || '/' || doc_id) AS id,
       'https://docs.example/' || source || '/' || lang || '/' || doc_id AS url,
       '} "]\\ {' || lang AS title, text AS content, NULL AS problem FROM documents
UNION ALL
SELECT DISTINCT doc_id // 20000, NULL, NULL, NULL, NULL, NULL, 'cut broken JSON' FROM documents""")

oracle("migrate_mixed", f"""
WITH {_DOCS}, d AS (
  SELECT d.*, documents.source AS src, lang FROM docs d JOIN documents ON documents.doc_id = d.doc_id)
SELECT md5(url) AS id, src AS source, url, NULL AS problem, CAST(NULL AS BIGINT) AS inserted FROM d
UNION ALL
SELECT DISTINCT NULL, NULL, NULL, lang || ' broken JSON', CAST(NULL AS BIGINT) FROM d
UNION ALL
SELECT NULL, NULL, NULL, NULL, count(*) FROM d""")

_LINES = f"""array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda l: {strip('l')}), lambda l: l <> ''), ' ')"""
_LISTED = f"""
listed AS (
  SELECT doc_id, lang || ' & 50%: ' || source AS category,
         md5('https://docs.example/' || source || '/' || lang || '/' || doc_id) AS id, 'document ' || doc_id AS title,
         {default(_LINES, 'No content')} AS content
  FROM documents),
halves AS (
  SELECT *, doc_id <= (min(doc_id) OVER (PARTITION BY category) + max(doc_id) OVER (PARTITION BY category)) // 2 AS older
  FROM listed)"""


def _run_rows(rows, published=False):
    out = f"""
SELECT 'u.today' AS site, category, kind, seq, pos, id, title, content FROM {rows}"""
    return out if not published else out + f"""
UNION ALL
SELECT 'u.today', NULL, 'published', 1704164645, NULL, id, title, content FROM {rows} WHERE kind = 'incremental'"""


def _batches(rows, base="0"):
    return f"""
  SELECT *, 'initial' AS kind, (row_number() OVER k - 1) % 100 AS pos, {base}
         + least(CAST(ceil(row_number() OVER k / 100.0) AS BIGINT) * 100, count(*) OVER (PARTITION BY category)) AS seq
  FROM {rows} WINDOW k AS (PARTITION BY category ORDER BY doc_id DESC)"""


_INCREMENTAL = f"""
WITH {_LISTED},
known AS (SELECT * EXCLUDE (older) FROM halves WHERE older),
stops AS (SELECT category, max(doc_id) AS stop FROM known GROUP BY category),
first AS ({_batches('known')}),
fresh AS (
  SELECT l.*, 'incremental' AS kind, row_number() OVER (PARTITION BY l.category ORDER BY doc_id DESC) - 1 AS pos, 1735000000 AS seq
  FROM listed l LEFT JOIN stops ON l.category = stops.category WHERE stop IS NULL OR doc_id > stop),
stored AS (SELECT * FROM first UNION ALL SELECT * FROM fresh)
{_run_rows('stored', True)}"""
oracle("run_incremental", _INCREMENTAL)
oracle("run_incremental_rerun", _INCREMENTAL)

oracle("run_incremental_uncapped", f"""
WITH {_LISTED},
stored AS (
  SELECT * REPLACE (NULL AS category), CASE WHEN doc_id = 0 THEN 'initial' ELSE 'incremental' END AS kind,
         CASE WHEN doc_id = 0 THEN 1 ELSE 7 END AS seq,
         CASE WHEN doc_id = 0 THEN 0 ELSE row_number() OVER (ORDER BY doc_id DESC) - 1 END AS pos FROM listed)
{_run_rows('stored', True)}""")

_FULL = f"""
WITH {_LISTED},
begun AS (SELECT * EXCLUDE (older) FROM halves WHERE NOT older),
last AS (SELECT category, min(doc_id) AS cut, count(*) AS base FROM begun GROUP BY category),
first AS ({_batches('begun')}),
rest AS (
  SELECT l.*, coalesce(base, 0) AS base FROM listed l LEFT JOIN last ON l.category = last.category
  WHERE cut IS NULL OR doc_id < cut),
stored AS (SELECT * FROM first UNION ALL SELECT * EXCLUDE (base) FROM ({_batches('rest', 'base')}))
{_run_rows('stored')}"""
oracle("run_full", _FULL)
oracle("run_page_rejects", f"""
WITH {_LISTED},
found AS (
  SELECT * REPLACE (CASE WHEN doc_id % 10 IN (3, 6) THEN 'No content' ELSE content END AS content) FROM listed),
stored AS ({_batches('found')})
{_run_rows('stored')}
UNION ALL
SELECT 'u.today', NULL, CASE doc_id % 10 WHEN 3 THEN 'unreadable page' ELSE 'no page' END,
       CASE doc_id % 10 WHEN 3 THEN doc_id END, NULL, id, NULL, NULL FROM listed WHERE doc_id % 10 IN (3, 6)""")
oracle("run_full_rerun", _FULL)
oracle("load_batches", _MIGRATED)
oracle("stream_restart", _MIGRATED)

oracle("job_from_listing_pages", f"""
WITH docs AS (
  SELECT doc_id, md5('https://docs.example/' || source || '/' || lang || '/' || doc_id) AS id, 'T ' || doc_id AS title,
         {default(_LINES, 'No content')} AS content,
         row_number() OVER (PARTITION BY doc_id // 10 ORDER BY doc_id) - 1 AS place FROM documents),
good AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM docs WHERE doc_id % 10 <> 7)
SELECT 'u.today' AS site, 'news' AS category, 'incremental' AS kind, CAST(9 AS BIGINT) AS seq, pos, id, title, content FROM good
UNION ALL
SELECT 'u.today', NULL, 'published', 1704207840, NULL, id, title, content FROM good
UNION ALL
SELECT 'u.today', 'news', 'unreadable date', doc_id // 10, place, id, title, NULL FROM docs WHERE doc_id % 10 = 7""")

oracle("job_api_full", f"""
SELECT 'blockworks' AS site, NULL AS category, 'initial' AS kind, (event_id // 1000 + 1) * 1000 AS seq,
       row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) - 1 AS pos,
       md5('https://api.example/' || event_id) AS id, event_type AS title, regexp_extract(props, ':\\s*([0-9]+)', 1) AS content
FROM events""")

oracle("stream_late_files", f"""
WITH {_EVENTS} SELECT id, url, NULL AS problem FROM ev
UNION ALL
SELECT NULL, NULL, event_type || ' broken JSON' FROM (SELECT DISTINCT event_type FROM events)""")
oracle("stream_dedup_within", f"WITH {_EVENTS} SELECT source, id FROM ev")


# What sources do to the text they have read.
_STEPS = {
    "beincrypto.com": "replace({}, chr(10), ' ')",
    "globalcryptopress.com": "regexp_replace({}, '-{{2,}}', '', 'g')",
    "theblockcrypto.com": "replace({}, 'Quick take:', '')",
}


def _sample(source, x):
    def dated(value):
        return "NULL" if value is None else f"replace({quoted(value)}, '@d@', d)"
    date = f"CASE WHEN page_id % 5 = 4 THEN {dated(x.unread)} ELSE {dated(x.read)} END"
    title, card_title = "'Title ' || page_id", "NULL" if x.titled == "page" else "'Title ' || page_id"
    url = "'https://sources.example/' || page_id"
    return f"""
SELECT 'page' AS step, {quoted(source)} AS source, page_id, {url} AS url, {title if x.titled == "page" else "NULL"} AS title,
       {_STEPS.get(source, "{}").format("a || ' Body ' || page_id")} AS content, {date if x.dated == "page" else "NULL"} AS published_at, NULL AS reject_reason FROM w
UNION ALL
SELECT 'card', {quoted(source)}, page_id, {quoted(x.base + "/") + " || page_id" if x.base else url}, {card_title}, NULL, {date if x.dated == "card" else "NULL"},
       {"CASE WHEN page_id % 5 = 4 THEN 'unreadable date' END" if x.dated == "card" and x.unread is None else "NULL"} FROM w"""


oracle("source_rules", f"""
WITH w AS (
  SELECT page_id, lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS d,
         concat_ws(' ', 'Lead', nullif({visible(inner('body'))}, '')) AS a FROM pages)"""
       + "\nUNION ALL".join(_sample(s, x) for s, x in SAMPLES.items()))

oracle("last_page_rules", """
WITH s AS (SELECT unnest(['beincrypto.com', 'blockonomi.com', 'blog.cryptoflies.com', 'droomdroom.com', 'cryptonews.com',
                          'cryptoslate.com', 'holder.io']) AS source)
SELECT page_id, source, CASE WHEN page_id % 4 > 0 THEN page_id * 7 + 2
                             WHEN source IN ('blog.cryptoflies.com', 'droomdroom.com') THEN 1 END AS pages
FROM pages, s""")
