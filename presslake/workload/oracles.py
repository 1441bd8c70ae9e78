"""Expected results as DuckDB SQL over the base columns of the driver tables."""

from __future__ import annotations

from presslake.workload.fixtures import (
    EPOCH,
    FIRST_RUN_BELOW,
    HOST,
    LINKS_PER_LISTING,
    SECOND_RUN_FROM,
    SITE,
    SPAN_MINUTES,
    URL_PATH,
    WEEKDAYS,
)

# Fixed values, stated here once more: a wrong constant of the library must not
# pass because its oracle shares it.
WHITESPACE = "".join(
    map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
MONTHS = "يناير فبراير مارس أبريل مايو يونيو يوليو أغسطس سبتمبر أكتوبر نوفمبر ديسمبر".split()
CATEGORY_LABELS = {
    "arab": "عرب",
    "art": "فن",
    "caricature": "كاريكاتير",
    "economy": "اقتصاد و بورصة",
    "investigations": "تحقيقات",
    "television": "تلفزيون",
    "urgent": "عاجل",
    "your_horoscope_today": "حظك اليوم",
}
# Event times, shifted into all twelve months.
EVENT_TS = "(ts + to_months(CAST(event_id % 12 AS INTEGER)))"


def _list(values) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


def _strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def _arabic(ts: str, with_weekday: str = "true") -> str:
    return f"""(CASE WHEN {with_weekday} THEN ({_list(WEEKDAYS)})[isodow({ts})] || '، ' ELSE '' END
        || day({ts}) || ' ' || ({_list(MONTHS)})[month({ts})] || ' ' || year({ts}) || ' '
        || strftime({ts}, '%I:%M') || CASE WHEN hour({ts}) < 12 THEN ' ص' ELSE ' م' END)"""


BASE = f"""base AS (
  SELECT *, TIMESTAMP '{EPOCH}' + to_minutes(CAST(doc_id * 7919 % {SPAN_MINUTES} AS INTEGER)) AS ts,
         CASE WHEN doc_id % 10 IN (1, 2) THEN doc_id % 10 ELSE 0 END AS copies,
         CASE WHEN n_chars > 2000 THEN 'long' ELSE 'short' END AS band,
         doc_id % 97 = 0 OR doc_id % 89 = 0 AS ghost
  FROM documents)"""

# Every article line of the feed, repeats included.
FEED = f"""{BASE}, feed AS (
  SELECT doc_id, k, doc_id * 100 + k AS seq, n_chars, lang, band, ts, CAST(doc_id AS VARCHAR) AS article_id,
    '{HOST}/story/' || lang || '/' || doc_id || '?q=a%20b+c' AS url,
    source AS category, source,
    CASE WHEN k > 0 THEN 'copy ' || k WHEN doc_id % 13 = 0 THEN NULL
         ELSE nullif({_strip('split_part(text, chr(10), 1)')}, '') END AS title,
    CASE WHEN doc_id % 59 = 0 THEN 'غير معروف' ELSE {_arabic('ts', 'doc_id % 3 <> 0')} END AS publish_date,
    CASE WHEN doc_id % 59 = 0 THEN NULL ELSE ts END AS date_parsed,
    CASE WHEN doc_id % 7 = 0 OR doc_id % 5 = 0 THEN NULL WHEN doc_id % 31 = 0 THEN 'True'
         ELSE 'Author ' || (doc_id % 50) END AS author,
    nullif({_strip('text')}, '') AS content,
    CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 17 = 0 THEN ''
         ELSE lang || '|' || source || '|' || band || '|' || (doc_id % 10) END AS tags,
    CAST(CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 17 = 0 THEN 0 ELSE 4 END AS BIGINT) AS n_tags,
    CAST(CASE WHEN doc_id % 19 <> 0 AND doc_id % 4 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_media
  FROM base, unnest(range(0, 1 + copies)) t(k) WHERE NOT ghost)"""

# The clean article view.
ARTICLES = f"""{BASE}, articles AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS article_id, '{HOST}/story/' || doc_id AS url, source AS category,
    CASE WHEN doc_id % 13 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS title,
    CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 'Author ' || (doc_id % 50) END AS author,
    CASE WHEN doc_id % 16 = 0 THEN '' ELSE text END AS content,
    CASE WHEN doc_id % 17 = 0 THEN []
         ELSE [lang, source, 't' || (doc_id * 31 % 997), CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'news' END]
    END AS tags,
    CASE WHEN doc_id % 59 = 0 THEN NULL ELSE ts END AS date_parsed, n_chars
  FROM base)"""

TAG_COUNTS = f"""{ARTICLES}, tag_counts AS (
  SELECT tag, count(*) AS frequency FROM (SELECT unnest(tags) AS tag FROM articles)
  WHERE tag IS NOT NULL GROUP BY tag)"""

TOP_TAGS = "SELECT tag, frequency FROM tag_counts ORDER BY frequency DESC, tag LIMIT 20"

RUNS = f"""{ARTICLES}, runs AS (
  SELECT article_id, doc_id AS line_no, content, n_chars, run_ts, run_ts || ' ' || coalesce(title, '') AS title
  FROM articles, unnest(['20240101T000000', '20240102T000000']) t(run_ts)
  WHERE CASE WHEN run_ts = '20240101T000000' THEN n_chars < {FIRST_RUN_BELOW} ELSE n_chars >= {SECOND_RUN_FROM} END)"""

# Links of the navigation list of every page.
NAV = r"""nav AS (
  SELECT page_id, generate_subscripts(hrefs, 1) - 1 AS pos,
         regexp_extract(url, '^[a-z]+://[^/?#]*') || unnest(hrefs) AS link
  FROM (SELECT page_id, url, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1),
                                                '<a href="([^"]*)"', 1) AS hrefs FROM pages))"""

# Article pages: everything but the pages without a container.
PAGE_URL = f"'{HOST}/story/' || doc_id"
BODY = f"trim({_strip('text')} || ' more bold ' || doc_id)"


def _unescape(x: str) -> str:
    """The entities of the pages; HTML reads them without the semicolon as well."""
    for entity, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        x = f"regexp_replace({x}, '&{entity};?', '{char}', 'g')"
    return x


def _nodes_joined(html: str) -> str:
    """Text between tags, each piece stripped, blanks dropped, joined by a space."""
    pieces = f"regexp_split_to_array({html}, '<[^>]*>')"
    return f"""array_to_string(list_filter(list_transform({pieces}, lambda x: {_strip(_unescape('x'))}),
                                           lambda x: x <> ''), ' ')"""


HOURS = ", ".join(f"CAST(count(*) FILTER (hour(ts) = {h}) AS BIGINT) AS h{h}" for h in range(24))
LABEL_KEYS = (*CATEGORY_LABELS, "politics", "reports")
MISSING = "FROM documents d, unnest(range(0, CASE WHEN d.doc_id % 10 = 0 THEN 2 ELSE 1 END)) t(k)"


def _quartile(column: str, p: float) -> str:
    return f"""(SELECT v FROM (SELECT {column} AS v, row_number() OVER (ORDER BY {column}) - 1 AS r,
        count(*) OVER () AS n FROM articles WHERE {column} IS NOT NULL)
        WHERE r = floor((n - 1) * {p} + 0.5))"""


def _describe() -> str:
    def text(x):
        return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"

    mean = "make_timestamp(CAST(floor(avg(epoch_us(date_parsed))) AS BIGINT))"
    rows = [
        ("count", "CAST(count(title) AS VARCHAR)", "CAST(count(author) AS VARCHAR)",
         "CAST(count(tags) AS VARCHAR)", "CAST(count(date_parsed) AS VARCHAR)", "CAST(count(n_chars) AS DOUBLE)"),
        ("null_count", *(f"CAST(count(*) - count({c}) AS VARCHAR)" for c in ("title", "author", "tags", "date_parsed")),
         "CAST(count(*) - count(n_chars) AS DOUBLE)"),
        ("mean", "NULL", "NULL", "NULL", text(mean), "round(avg(n_chars), 6)"),
        ("std", "NULL", "NULL", "NULL", "NULL", "round(stddev_samp(n_chars), 6)"),
        ("min", "min(title)", "min(author)", "NULL", text("min(date_parsed)"), "CAST(min(n_chars) AS DOUBLE)"),
        *((name, "NULL", "NULL", "NULL", text(f"any_value({_quartile('date_parsed', p)})"),
           f"CAST(any_value({_quartile('n_chars', p)}) AS DOUBLE)")
          for name, p in (("25%", 0.25), ("50%", 0.5), ("75%", 0.75))),
        ("max", "max(title)", "max(author)", "NULL", text("max(date_parsed)"), "CAST(max(n_chars) AS DOUBLE)"),
    ]
    selects = (
        f"""SELECT '{s}' AS statistic, {t} AS title, {a} AS author, CAST({g} AS VARCHAR) AS tags,
                   CAST({d} AS VARCHAR) AS date_parsed, {n} AS n_chars FROM articles"""
        for s, t, a, g, d, n in rows
    )
    return f"WITH {ARTICLES} " + " UNION ALL ".join(selects)


ORACLES: dict[str, str] = {
    "scan_jsonl": f"""WITH {BASE}
        SELECT CASE WHEN doc_id % 97 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR)
                    ELSE '  ' || doc_id || ' ' END AS article_id,
               CASE WHEN doc_id % 89 = 0 THEN '  '
                    ELSE '{HOST}/story/' || lang || '/' || doc_id || '?q=a%20b+c' END AS url,
               source AS category, text AS content
        FROM base, unnest(range(0, 1 + copies)) t(k)
        UNION ALL SELECT NULL, NULL, NULL, NULL FROM base WHERE doc_id % 61 = 0""",
    "scan_url_list": f"""SELECT kind, '{HOST}{URL_PATH}' || d.doc_id || '?q=a%20b+c' ||
               CASE WHEN kind = 'jsonl' THEN ' ' ELSE '' END AS url
        FROM documents d, unnest(range(0, CASE WHEN d.doc_id % 10 = 0 THEN 2 ELSE 1 END)) t(k),
             unnest(['jsonl', 'txt']) u(kind)""",
    "scan_limit": """SELECT CASE WHEN doc_id % 53 = 0 THEN '' ELSE 'line ' || doc_id END AS value
        FROM documents ORDER BY doc_id LIMIT 150""",
    "frontier": f"""WITH s AS (SELECT source AS section, (count(*) + {LINKS_PER_LISTING - 1}) // {LINKS_PER_LISTING} AS hi
                   FROM documents GROUP BY source)
        SELECT section, page, '{HOST}/Section/' || section || '/1' || page AS url
        FROM s, unnest(range(1, hi + 1)) t(page)""",
    "batch_by_file": f"""WITH {FEED} SELECT category AS src_file, article_id, title, content FROM feed""",
    "normalize": f"""WITH {FEED}
        SELECT seq, article_id, url, category, title, publish_date, author, content, n_tags, n_media FROM feed""",
    "normalize_scalars": f"WITH {FEED} SELECT seq, title, author, publish_date FROM feed",
    "normalize_tags": f"WITH {FEED} SELECT seq, tags FROM feed",
    "normalize_media": f"""WITH {FEED}
        SELECT seq, CAST(0 AS BIGINT) AS pos, 'image' AS type, '/static/' || doc_id || '.jpg' AS url, source AS alt,
               CAST(NULL AS VARCHAR) AS caption,
               CASE WHEN doc_id % 19 <> 0 AND doc_id % 4 <> 0 AND doc_id % 2 = 0 THEN 'external'
                    ELSE 'internal' END AS provider FROM feed
        UNION ALL SELECT seq, 1, 'video', 'https://video.example.net/' || doc_id, NULL, NULL, NULL
        FROM feed WHERE n_media = 2""",
    "ghost_filter": f"WITH {FEED} SELECT article_id, url FROM feed",
    "dedup_first": f"""WITH {FEED}
        SELECT f.seq, f.article_id, f.title, f.content FROM feed f
        JOIN (SELECT article_id, min(seq) AS seq FROM feed GROUP BY article_id) USING (article_id, seq)""",
    "dedup_cross_run": f"""WITH {RUNS}
        SELECT article_id, min(run_ts) AS run_ts, min(line_no) AS line_no, arg_min(title, run_ts) AS title,
               arg_min(content, run_ts) AS content FROM runs GROUP BY article_id""",
    "append_new": f"""WITH {RUNS} SELECT run_ts, line_no, article_id, title FROM runs
        WHERE run_ts = '20240102T000000' AND n_chars >= {FIRST_RUN_BELOW}""",
    "reject_report": f"""WITH {BASE}, lines AS (
          SELECT CASE WHEN ghost THEN 'ghost' ELSE 'ok' END AS reason, 1 AS n FROM base
          UNION ALL SELECT CASE WHEN ghost THEN 'ghost' ELSE 'duplicate' END, copies FROM base
          UNION ALL SELECT 'malformed', 1 FROM base, unnest([23, 43, 47, 53]) t(d) WHERE doc_id % d = 0
          UNION ALL SELECT 'falsy', 1 FROM base, unnest([29, 61]) t(d) WHERE doc_id % d = 0
          UNION ALL SELECT 'not_object', 1 FROM base, unnest([37, 41]) t(d) WHERE doc_id % d = 0)
        SELECT reason, CAST(sum(n) AS BIGINT) AS n_lines FROM lines GROUP BY reason HAVING sum(n) > 0""",
    "articles_table": f"""WITH {FEED}
        SELECT article_id, url, category, title, author, content, date_parsed, tags, n_media FROM feed WHERE k = 0""",
    "ustrip": f"SELECT doc_id, {_strip('text')} AS stripped FROM documents",
    "url_key": f"""SELECT doc_id, '{HOST}/' || text || '?a+b=%zz%4' AS url_key FROM documents""",
    "date_clean": f"""SELECT event_id, day({EVENT_TS}) || strftime({EVENT_TS}, ' %m %Y %I:%M %p') AS clean
        FROM events""",
    "parse_date": f"SELECT event_id, date_trunc('minute', {EVENT_TS}) AS date_parsed FROM events",
    "page_id": "SELECT page_id, string_split(url, '/')[-1] AS file_id FROM pages",
    "media_provider": f"""SELECT page_id, pos, CASE
          WHEN pos = 3 THEN 'unknown' WHEN pos = 2 THEN 'internal' WHEN pos = 1 THEN 'external'
          WHEN strpos(url, '{SITE}') > 0 OR strpos(url, 'static') > 0 THEN 'internal' ELSE 'external' END AS provider
        FROM pages, unnest(range(0, 4)) t(pos)""",
    "category_label": f"""SELECT doc_id, ({_list(LABEL_KEYS)})[doc_id % 10 + 1] AS category,
          ({_list((*CATEGORY_LABELS.values(), 'unknown', 'unknown'))})[doc_id % 10 + 1] AS label FROM documents""",
    "top_tags": f"WITH {TAG_COUNTS} {TOP_TAGS}",
    "top_tags_share": f"""WITH {TAG_COUNTS} SELECT tag, frequency,
          round(frequency / sum(frequency) OVER (), 6) AS share FROM ({TOP_TAGS})""",
    "tag_lookup": f"WITH {TAG_COUNTS} SELECT tag, frequency FROM tag_counts WHERE tag = 'news'",
    "top_tags_sketch": f"WITH {TAG_COUNTS} {TOP_TAGS}",
    "top_tags_incremental": f"WITH {TAG_COUNTS} {TOP_TAGS}",
    "heatmap_incremental": f"""WITH {ARTICLES} SELECT isodow(date_parsed) AS weekday, hour(date_parsed) AS hour,
          count(*) AS article_count FROM articles GROUP BY 1, 2""",
    "coverage_estimate": """SELECT count(d.doc_id) AS listed, count(l.doc_id) AS scraped,
          count_if(l.doc_id IS NULL) AS missing, count_if(d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS done,
          true AS listed_within_margin, true AS scraped_within_margin, true AS missing_within_margin, true AS done_within_margin
        FROM documents d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""",
    "heatmap": f"""WITH {ARTICLES} SELECT isodow(date_parsed) AS weekday, hour(date_parsed) AS hour,
          count(*) AS article_count FROM articles GROUP BY 1, 2""",
    "heatmap_pivot": f"SELECT isodow(ts) AS weekday, {HOURS} FROM events GROUP BY 1",
    "sql_month_day": f"""SELECT DISTINCT '{HOST}/order/' || o_custkey AS url, o_orderstatus AS content FROM orders
        WHERE month(o_orderdate) = 3 AND day(o_orderdate) = 21""",
    "sql_like": f"WITH {ARTICLES} SELECT content FROM articles WHERE content LIKE '%tion the%'",
    "before_year": "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) < 1996",
    "quality_filters": f"""WITH {ARTICLES} SELECT 'empty_content' AS issue, url FROM articles WHERE content = ''
        UNION ALL SELECT 'no_author', url FROM articles WHERE author IS NULL""",
    "column_counts": f"""WITH {ARTICLES} SELECT count(article_id) AS article_id, count(url) AS url,
          count(category) AS category, count(title) AS title, count(author) AS author, count(content) AS content,
          count(tags) AS tags, count(date_parsed) AS date_parsed, count(n_chars) AS n_chars FROM articles""",
    "n_unique_rows": "SELECT count(*) AS n_unique FROM (SELECT DISTINCT text, lang FROM documents)",
    "distinct_content": f"WITH {ARTICLES} SELECT DISTINCT content FROM articles",
    "describe": _describe(),
    "describe_merged": _describe(),
    "missing_urls": f"""SELECT '{{"url": "{HOST}{URL_PATH}' || d.doc_id || '?q=a%20b+c ", "rank": ' || d.doc_id || '}}'
          AS value {MISSING} WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)""",
    "missing_urls_txt": f"""SELECT '{HOST}{URL_PATH}' || d.doc_id || '?q=a%20b+c' AS url {MISSING}
        WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)""",
    "coverage_report": f"""SELECT (SELECT count(DISTINCT doc_id) FROM labels) AS n_scraped, count(*) AS n_missing
        {MISSING} WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)""",
    "frontier_dedup": f"""WITH {NAV} SELECT link AS url_key, link AS url, count(*) AS n_seen FROM nav GROUP BY link""",
    "frontier_duplicates": f"""WITH {NAV} SELECT count(*) AS n_requests, count(DISTINCT link) AS n_unique,
          count(*) - count(DISTINCT link) AS n_duplicates FROM nav""",
    "domain_filter": f"""SELECT page_id, url FROM (
          SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS host FROM pages)
        WHERE host = '{SITE}' OR ends_with(host, '.{SITE}')""",
    "extract_links": f"WITH {NAV} SELECT page_id, pos, link FROM nav",
    "links_per_page": """SELECT page_id, len(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1),
          '<a href="([^"]*)"', 1)) AS n_links FROM pages""",
    "extract_articles": f"""WITH {BASE} SELECT CAST(doc_id AS VARCHAR) AS article_id, {PAGE_URL} AS url,
          CASE WHEN doc_id % 3 = 0 THEN 'unknown' ELSE source END AS category,
          {_strip('split_part(text, chr(10), 1)')} AS title, {_arabic('ts')} AS publish_date,
          'Author ' || (doc_id % 50) AS author, {BODY} AS content, lang || '|' || source || '|' AS tags,
          CAST(6 AS BIGINT) AS media FROM base WHERE doc_id % 23 <> 0""",
    "extract_content": f"""SELECT page_id,
          {_strip(_unescape("regexp_extract(html, '(?s)<h1>([^<]*)', 1)"))} AS title,
          {_nodes_joined("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")} AS content FROM pages""",
    "extract_media": f"""SELECT CAST(doc_id AS VARCHAR) AS article_id, pos, m.* FROM (
          SELECT doc_id, unnest(range(0, 6)) AS pos, unnest([
            {{'type': 'image', 'url': '/static/' || doc_id || '.jpg', 'alt': source, 'caption': 'cap ' || doc_id,
              'provider': 'internal'}},
            {{'type': 'image', 'url': 'https://cdn.example.net/' || doc_id || '.png', 'alt': NULL,
              'caption': 't' || doc_id, 'provider': 'external'}},
            {{'type': 'image', 'url': 'https://cdn.example.net/Logo.png', 'alt': NULL, 'caption': 'cap ' || doc_id,
              'provider': 'external'}},
            {{'type': 'video', 'url': 'https://video.example.net/' || doc_id, 'alt': NULL, 'caption': NULL,
              'provider': 'external'}},
            {{'type': 'video', 'url': '/v/' || doc_id || '.mp4', 'alt': NULL, 'caption': NULL, 'provider': 'external'}},
            {{'type': 'audio', 'url': '{HOST}/a/' || doc_id || '.mp3', 'alt': NULL, 'caption': NULL,
              'provider': 'internal'}}]) AS m
          FROM documents WHERE doc_id % 23 <> 0)""",
    "extract_legacy": f"""WITH {BASE} SELECT doc_id, {PAGE_URL} AS url,
          CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS category,
          CASE WHEN found THEN CAST(doc_id AS VARCHAR) END AS article_id,
          CASE WHEN found THEN {_strip('split_part(text, chr(10), 1)')} END AS title,
          CASE WHEN found THEN {_arabic('ts')} END AS publish_date,
          CASE WHEN found THEN 'Author ' || (doc_id % 50) END AS author,
          CASE WHEN found THEN {_strip("text || ' more '")} ELSE '' END AS content,
          CASE WHEN found THEN ' ' || lang || '|' || source || '| ' ELSE '' END AS tags,
          CASE WHEN found THEN 'featured,/static/' || doc_id || '.jpg,' || source || ',cap ' || doc_id
            || '|body_gallery,https://cdn.example.net/' || doc_id || '.png,t' || doc_id ELSE '' END AS images
        FROM (SELECT *, doc_id % 23 <> 0 AS found FROM base)""",
    "media_dedup": """WITH m AS (
          SELECT doc_id, unnest(range(0, 5)) AS p, unnest(['image', 'image', 'video', 'video', 'audio']) AS type,
            unnest(['/i/' || doc_id, '/m/' || (doc_id % 5), '/i/' || doc_id, '/m/0', '/m/1']) AS url FROM documents),
        f AS (SELECT *, min(p) OVER (PARTITION BY doc_id, url) AS first FROM m)
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS pos, type, url FROM f WHERE p = first""",
    "crawl_join_extract": f"""SELECT CAST(doc_id AS VARCHAR) AS article_id, {PAGE_URL} AS url,
          'section' || (doc_id // {LINKS_PER_LISTING} % 7) AS category, {_strip('split_part(text, chr(10), 1)')} AS title,
          {BODY} AS content FROM documents WHERE doc_id % 23 <> 0 AND doc_id // {LINKS_PER_LISTING} % 7 = 0""",
    "crawl_backfill": f"""SELECT CAST(doc_id AS VARCHAR) AS article_id, {PAGE_URL} AS url,
          'section' || (doc_id // {LINKS_PER_LISTING} % 7) AS category, {_strip('split_part(text, chr(10), 1)')} AS title,
          {BODY} AS content FROM documents WHERE doc_id % 23 <> 0""",
    "parquet_roundtrip": f"""WITH {FEED} SELECT article_id, url, category, title, publish_date, author, content,
          tags, true AS media FROM feed""",
    "csv_export": f"WITH {ARTICLES} SELECT url, content FROM articles",
    "enrich_in_place": f"SELECT event_id, date_trunc('minute', {EVENT_TS}) AS date_parsed FROM events",
    "enrich_increment": f"""SELECT event_id, date_trunc('minute', {EVENT_TS}) AS date_parsed,
          ({_list(MONTHS)})[month({EVENT_TS})] AS month FROM events""",
    "shape": "SELECT count(*) AS n_rows, 5 AS n_columns FROM documents",
    "seed": f"""SELECT DISTINCT 'urgent' AS section, '{HOST}/Section/src0/11' AS url FROM documents WHERE source = 'src0'""",
    "listing_links": f"""SELECT '{HOST}/Section/news/' || (doc_id // {LINKS_PER_LISTING}) AS url,
          row_number() OVER (PARTITION BY doc_id // {LINKS_PER_LISTING} ORDER BY doc_id) - 1 AS pos,
          {PAGE_URL} AS link FROM documents""",
    "link_category": f"""SELECT {PAGE_URL} AS link, 'economy' AS category FROM documents
        UNION ALL SELECT '{HOST}/story/' || min(doc_id), 'economy' FROM documents GROUP BY doc_id // {LINKS_PER_LISTING}
        UNION ALL SELECT 'https://foreign.example.org/story/' || min(doc_id), 'economy' FROM documents
          GROUP BY doc_id // {LINKS_PER_LISTING}""",
    "head_n": """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'
        ORDER BY o_orderkey LIMIT 10""",
    "n_unique_events": "SELECT count(*) AS n_unique FROM (SELECT DISTINCT ts, event_type, value FROM events)",
    "ingest_enriched": f"""WITH {FEED} SELECT article_id, title, date_trunc('minute', date_parsed) AS date_parsed,
          CAST(CASE WHEN n_chars < {FIRST_RUN_BELOW} THEN 0 ELSE 1 END AS BIGINT) AS batch FROM feed WHERE k = 0""",
    "ingest_bucketed": f"""WITH {FEED} SELECT article_id, title, date_trunc('minute', date_parsed) AS date_parsed,
          CAST(CASE WHEN n_chars < {FIRST_RUN_BELOW} THEN 0 ELSE 1 END AS BIGINT) AS batch FROM feed WHERE k = 0""",
    "ingest_backlog": f"WITH {FEED} SELECT article_id, title FROM feed WHERE k = 0",
    "day_slice_events": f"""SELECT DISTINCT '{HOST}/event/' || user_id AS url, event_type AS content FROM events
        WHERE month({EVENT_TS}) = 3 AND day({EVENT_TS}) = 21""",
    "partitioned_layout": """SELECT event_id, ts AS date_parsed, event_type AS category,
          strftime(ts, '%Y-%m-%d') AS pub_date FROM events""",
    "category_batch": """SELECT c AS category, count(doc_id) AS n_articles,
          CASE WHEN count(doc_id) > 0 THEN 'DONE' ELSE 'FAILED' END AS status
        FROM (SELECT unnest(list_append(list_transform(range(0, 20), lambda i: 'src' || i), 'nowhere')) AS c)
        LEFT JOIN documents ON source = c GROUP BY c""",
    "ingest_incremental": f"""WITH {FEED} SELECT article_id, title, content,
          CAST(CASE WHEN n_chars < {FIRST_RUN_BELOW} THEN 0 ELSE 1 END AS BIGINT) AS batch FROM feed WHERE k = 0""",
    "top_tags_feed": f"""WITH {FEED}, t AS (SELECT unnest(string_split(tags, '|')) AS tag FROM feed WHERE k = 0 AND n_tags > 0)
        SELECT tag, count(*) AS frequency FROM t GROUP BY tag ORDER BY frequency DESC, tag LIMIT 20""",
    "convert_runs": f"""WITH {FEED} SELECT article_id, title, content FROM feed, unnest([1, 2]) t(run)
        WHERE k = 0 AND CASE WHEN run = 1 THEN n_chars < {FIRST_RUN_BELOW} ELSE n_chars >= {SECOND_RUN_FROM} END""",
    "feed_jsonl": f"""SELECT CAST(doc_id AS VARCHAR) AS article_id, {PAGE_URL} AS url, {_strip('split_part(text, chr(10), 1)')} AS title,
          lang || '|' || source || '|' AS tags, CASE WHEN doc_id % 3 = 0 THEN 'unknown' ELSE source END AS category,
          '20240101T000000' AS run_ts FROM documents WHERE doc_id % 23 <> 0""",
    "link_list": f"WITH {NAV} SELECT link AS url FROM nav UNION ALL SELECT url FROM pages",
    "day_slice_csv": f"""SELECT DISTINCT '{HOST}/order/' || o_custkey AS url, o_orderstatus AS content FROM orders
        WHERE month(o_orderdate) = 3 AND day(o_orderdate) = 21""",
    "missing_file": f"""SELECT '{{"url": "{HOST}{URL_PATH}' || d.doc_id || '?q=a%20b+c ", "rank": ' || d.doc_id || '}}'
          AS value {MISSING} WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)""",
    "category_run": f"""WITH c AS (SELECT unnest({_list(CATEGORY_LABELS.values())}) AS category,
          unnest(range(0, {len(CATEGORY_LABELS)})) AS i)
        SELECT category, count(doc_id) AS n_articles, CASE WHEN count(doc_id) > 0 THEN 'DONE' ELSE 'FAILED' END AS status
        FROM c LEFT JOIN documents ON doc_id % {len(CATEGORY_LABELS) - 1} = i GROUP BY category""",
    "page_archive": "SELECT string_split(url, '/')[-1] AS file_id, url, html FROM pages",
    "url_fingerprint": f"""SELECT doc_id, url, sha256(url) AS fingerprint, CAST(3 AS BIGINT) AS n_spellings FROM (
          SELECT doc_id, '{HOST}/story/' || doc_id || '/' || replace(url_encode(text), '%2A', '*')
                   || '?a=&a=' || source || '&b=' || lang AS url
          FROM documents)""",
    "frontier_resume": f"SELECT '{HOST}{URL_PATH}' || doc_id || '?p=&q=a+b+c' AS url FROM documents",
    # Longer keys stand for control characters while single letters are exchanged.
    "replace_many": """SELECT doc_id, replace(replace(replace(replace(translate(
          replace(replace(replace(replace(text, 'and ', chr(1)), 'an', chr(2)), 'er', chr(3)), '.', chr(4)),
          'abe', 'bca'), chr(1), '& '), chr(2), '<AN>'), chr(3), ''), chr(4), '(.)') AS text FROM documents""",
    "line_numbers": """SELECT n AS line_no, part, n, doc_id FROM (
          SELECT doc_id, doc_id % 7 AS part, doc_id // 7 AS n FROM documents) WHERE n BETWEEN 5 AND 104""",
    "content_search": f"WITH {ARTICLES} SELECT content FROM articles WHERE content LIKE '%tion the%'",
    "clustered_layout": f"""WITH {ARTICLES} SELECT article_id, category, date_parsed FROM articles
        WHERE category IN ('src0', 'src1') AND year(date_parsed) = 2014""",
    "column_counts_batches": f"WITH {ARTICLES} SELECT category, count(title) AS n_titles FROM articles GROUP BY category",
    "missing_input": f"""SELECT '{{"url": "{HOST}{URL_PATH}' || doc_id || '?q=a%20b+c ", "rank": ' || doc_id || '}}' AS value
        FROM documents, range(CASE WHEN doc_id % 10 = 0 THEN 2 ELSE 1 END)""",
    "ingest_resume": f"""WITH {FEED} SELECT article_id, title, content,
          CAST(CASE WHEN n_chars < {FIRST_RUN_BELOW} THEN 0 ELSE 1 END AS BIGINT) AS batch FROM feed WHERE k = 0""",
}
