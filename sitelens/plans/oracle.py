"""Independent SQL for every registered query, runnable by DuckDB.

Each oracle is a ``WITH`` chain over the driver's views.  Shared steps are
named CTEs; :func:`sql` pulls in the ones a query needs, in dependency order.
The SQL is written from the rules (SURVEY section 2), not from the Spark code.
"""

from __future__ import annotations

from ..sources.fixtures import COMMANDS_SQL, CORPUS_SQL, REQUESTS_SQL, SEARCH_QUERIES_SQL, START_PAGE

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (f"{name} AS (\n{body}\n)", deps)


def _raw_cte(name: str, text: str, *deps: str) -> None:
    CTES[name] = (text, deps)


_raw_cte("corpus", CORPUS_SQL)
_raw_cte("requests", REQUESTS_SQL)
_raw_cte("search_queries", SEARCH_QUERIES_SQL)
_raw_cte("commands", COMMANDS_SQL)

cte("page_split", """SELECT path, readable, html,
  CASE WHEN parts[len(parts)] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS ls
FROM (SELECT path, readable, html, string_split(html, chr(10)) AS parts FROM corpus)""", "corpus")

cte("lines", """SELECT path, CAST(unnest(generate_series(0, len(ls) - 1)) AS BIGINT) AS line_no, unnest(ls) AS line
FROM page_split""", "page_split")

cte("ix_lines", """SELECT path, CAST(row_number() OVER (PARTITION BY path ORDER BY line_no) - 1 AS BIGINT) AS row,
  line_no, line
FROM lines WHERE NOT (line LIKE '<_%')""", "lines")

cte("tokens", """SELECT path, row, line_no, unnest(list_filter(string_split(line, ' '), lambda x: x <> '')) AS term
FROM ix_lines""", "ix_lines")

cte("occurrences", """SELECT term, path, row, line_no, CAST(count(*) AS BIGINT) AS tf
FROM tokens GROUP BY term, path, row, line_no""", "tokens")

cte("postings", """SELECT term, path, CAST(sum(tf) AS BIGINT) AS fr, list_sort(list_distinct(list(row))) AS offsets
FROM occurrences GROUP BY term, path""", "occurrences")

cte("lexicon", """SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(fr) AS BIGINT) AS cf
FROM postings GROUP BY term""", "postings")

# query_id, term (SEARCH verb dropped, split on space/CR/LF, empties dropped, distinct)
cte("query_terms", """SELECT DISTINCT query_id, term FROM (
  SELECT query_id, unnest(list_filter(string_split_regex(raw, '[ \\r\\n]'), lambda x: x <> '')[2:]) AS term
  FROM search_queries)""", "search_queries")

cte("hit_lines", """SELECT DISTINCT q.query_id, x.path, x.row, x.line_no, x.line
FROM (SELECT DISTINCT path, row, line_no, line, term FROM tokens t JOIN ix_lines USING (path, row, line_no)) AS x
JOIN query_terms AS q ON x.term = q.term""", "tokens", "ix_lines", "query_terms")

cte("search_rows", """SELECT query_id, path, CAST(count(*) OVER (PARTITION BY query_id, path) AS BIGINT) AS n_rows,
  CAST(row_number() OVER (PARTITION BY query_id, path ORDER BY row) - 1 AS BIGINT) AS f, row, line_no, line
FROM hit_lines""", "hit_lines")

# --- link graph -------------------------------------------------------------
cte("links", """SELECT path AS src,
  unnest(regexp_extract_all(html, '<a href=[^"\\n]*"([^"\\n]+)', 1)) AS raw_dst
FROM corpus""", "corpus")

cte("edges", """SELECT DISTINCT src, CASE WHEN starts_with(raw_dst, '../') THEN raw_dst[4:] ELSE raw_dst END AS dst
FROM links""", "links")

# fetch path: the crawler and the server each strip one more leading '../'
cte("crawl_rounds", f"""WITH RECURSIVE walk(path, depth) USING KEY (path) AS (
  SELECT '{START_PAGE}' AS path, CAST(0 AS BIGINT) AS depth
  UNION
  SELECT e.dst AS path, w.depth + 1 AS depth
  FROM walk AS w
  JOIN corpus AS c ON c.path = fetch_path(w.path) AND c.readable
  JOIN edges AS e ON e.src = c.path
  WHERE e.dst NOT IN (SELECT r.path FROM recurring.walk AS r)
  QUALIFY row_number() OVER (PARTITION BY e.dst ORDER BY w.depth) = 1
)
SELECT path, depth FROM walk""", "corpus", "edges")

cte("crawl", """SELECT w.path, w.depth,
  CAST(CASE WHEN c.path IS NULL THEN 404 WHEN NOT c.readable THEN 403 ELSE 200 END AS INTEGER) AS status,
  CAST(CASE WHEN c.readable THEN strlen(c.html) ELSE 0 END AS BIGINT) AS bytes
FROM crawl_rounds AS w LEFT JOIN corpus AS c ON c.path = fetch_path(w.path)""", "crawl_rounds", "corpus")

# --- requests and commands ----------------------------------------------------
cte("request_log", """SELECT event_id, ts, server, is_cmd,
  CASE WHEN regexp_matches(raw, '^ *Get +[^ ]') THEN
    regexp_replace(regexp_extract(raw, '^ *Get +([^ ]+)', 1), '^\\.\\./', '') END AS req_path
FROM requests""", "requests")

cte("request_status", """SELECT r.event_id, r.ts, r.server, r.req_path AS path,
  CAST(CASE WHEN c.path IS NULL THEN 404 WHEN NOT c.readable THEN 403 ELSE 200 END AS INTEGER) AS status,
  CAST(CASE WHEN c.readable THEN strlen(c.html) ELSE 0 END AS BIGINT) AS bytes
FROM request_log AS r LEFT JOIN corpus AS c ON c.path = r.req_path
WHERE NOT r.is_cmd AND r.req_path IS NOT NULL""", "request_log", "corpus")

MACROS = """CREATE OR REPLACE MACRO strip_parent(u) AS CASE WHEN starts_with(u, '../') THEN u[4:] ELSE u END;
CREATE OR REPLACE MACRO fetch_path(u) AS strip_parent(strip_parent(u));"""

ORACLES: dict[str, tuple[str, tuple[str, ...]]] = {}


def oracle(key: str, body: str, *deps: str) -> None:
    ORACLES[key] = (body, deps)


def _resolve(deps: tuple[str, ...]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    return order


def sql(key: str) -> str:
    body, deps = ORACLES[key]
    names = _resolve(deps)
    if not names:
        return body
    text = "WITH " + ",\n".join(CTES[n][0] for n in names) + "\n" + body
    return text


def uses_macros(text: str) -> bool:
    return "fetch_path(" in text or "strip_parent(" in text


def inline_macros(text: str) -> str:
    """Expand the two URL macros so the SQL is one statement."""
    import re

    def strip(u: str) -> str:
        return f"(CASE WHEN starts_with({u}, '../') THEN ({u})[4:] ELSE {u} END)"

    def repl_fetch(m):
        return strip(strip(m.group(1)))

    def repl_strip(m):
        return strip(m.group(1))

    # arguments here are simple column references
    arg = r"([A-Za-z_][A-Za-z_0-9\.]*|'[^']*')"
    text = re.sub(r"fetch_path\(" + arg + r"\)", repl_fetch, text)
    text = re.sub(r"strip_parent\(" + arg + r"\)", repl_strip, text)
    return text


def all_sql() -> dict[str, str]:
    out = {}
    for k in ORACLES:
        t = sql(k)
        out[k] = inline_macros(t) if uses_macros(t) else t
    return out


# ---------------------------------------------------------------------------
# Oracles per registered key
# ---------------------------------------------------------------------------
oracle("page_lines", "SELECT path, line_no, line FROM lines", "lines")
oracle("indexable_lines", "SELECT path, row, line_no, line FROM ix_lines", "ix_lines")
oracle("tokens", "SELECT path, row, line_no, term FROM tokens", "tokens")
oracle("occurrences", "SELECT term, path, row, line_no, tf FROM occurrences", "occurrences")
oracle("postings", """SELECT term, path, fr, array_to_string(offsets, '-') AS offsets_text,
  CAST(len(offsets) AS BIGINT) AS n_offsets FROM postings""", "postings")
oracle("lexicon", "SELECT term, df, cf FROM lexicon", "lexicon")

oracle("query_terms", "SELECT query_id, term FROM query_terms", "query_terms")
oracle("query_word_filter", """SELECT q.query_id, l.term, l.df, l.cf
FROM lexicon AS l JOIN query_terms AS q ON q.term = l.term""", "lexicon", "query_terms")
oracle("term_lookup", """SELECT term, path, fr, array_to_string(offsets, '-') AS offsets_text,
  CAST(len(offsets) AS BIGINT) AS n_offsets FROM postings WHERE term = 'the'""", "postings")
oracle("search_hits", "SELECT DISTINCT query_id, path, row, line_no FROM hit_lines", "hit_lines")
oracle("search_rows", "SELECT query_id, path, n_rows, f, row, line FROM search_rows", "search_rows")
oracle("search_rows_compat", """SELECT s.query_id, s.path, s.n_rows, s.f, s.row, l.line
FROM search_rows AS s JOIN lines AS l ON l.path = s.path AND l.line_no = s.row""", "search_rows", "lines")
oracle("search_summary", """SELECT query_id, path, CAST(count(*) AS BIGINT) AS n_rows
FROM hit_lines GROUP BY query_id, path""", "hit_lines")
oracle("hit_ordinal", "SELECT query_id, path, row, f FROM search_rows", "search_rows")
oracle("search_ordered", """SELECT DISTINCT query_id, path, row, line_no FROM hit_lines
ORDER BY query_id, path, row""", "hit_lines")
cte("page_freq", """SELECT q.query_id, p.path, CAST(sum(p.fr) AS BIGINT) AS freq
FROM postings AS p JOIN query_terms AS q ON q.term = p.term GROUP BY q.query_id, p.path""", "postings", "query_terms")
oracle("rank_pages", """SELECT query_id, rank, path, freq FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY freq DESC, path) AS BIGINT) AS rank, path, freq
  FROM page_freq) WHERE rank <= 10""", "page_freq")
oracle("rank_sites", """SELECT query_id, rank, site, freq FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY freq DESC, site) AS BIGINT) AS rank, site, freq
  FROM (SELECT query_id, regexp_extract(path, '^/*([^/]+)', 1) AS site, CAST(sum(freq) AS BIGINT) AS freq
        FROM page_freq GROUP BY 1, 2)) WHERE rank <= 10""", "page_freq")
oracle("rank_stored", ORACLES["rank_pages"][0], *ORACLES["rank_pages"][1])
oracle("rank_sites_stored", ORACLES["rank_sites"][0], *ORACLES["rank_sites"][1])
oracle("union_rows", """SELECT q.query_id, p.path,
  array_to_string(list_sort(list_distinct(flatten(list(p.offsets)))), '-') AS rows_text,
  CAST(len(list_distinct(flatten(list(p.offsets)))) AS BIGINT) AS n_rows
FROM postings AS p JOIN query_terms AS q ON q.term = p.term GROUP BY q.query_id, p.path""", "postings", "query_terms")
oracle("sorted_vocabulary", "SELECT row_number() OVER (ORDER BY term) AS rank, term, df, cf FROM lexicon", "lexicon")
oracle("search_terms", """SELECT q.query_id, p.path,
  array_to_string(list_sort(list_distinct(flatten(list(p.offsets)))), '-') AS rows_text,
  CAST(len(list_distinct(flatten(list(p.offsets)))) AS BIGINT) AS n_rows, CAST(sum(p.fr) AS BIGINT) AS freq
FROM postings AS p JOIN query_terms AS q ON q.term = p.term GROUP BY q.query_id, p.path""", "postings", "query_terms")
oracle("search_page_sets", "SELECT DISTINCT query_id, path FROM hit_lines", "hit_lines")
oracle("search_page_counts", """SELECT query_id, CAST(count(*) AS BIGINT) AS n_pages,
  CAST(count(*) FILTER (WHERE met = wanted) AS BIGINT) AS n_all
FROM (SELECT q.query_id, p.path, count(*) AS met FROM postings AS p JOIN query_terms AS q ON q.term = p.term GROUP BY q.query_id, p.path)
JOIN (SELECT query_id, count(*) AS wanted FROM query_terms GROUP BY query_id) USING (query_id)
GROUP BY query_id""", "postings", "query_terms")
oracle("search_report", """SELECT DISTINCT query_id, path, CAST(-1 AS BIGINT) AS f, path || ' : ' || n_rows || ' ' AS text FROM search_rows
UNION ALL
SELECT query_id, path, f, f || ',' || row || ',' || line AS text FROM search_rows
UNION ALL
SELECT query_id, CAST(NULL AS VARCHAR) AS path, CAST(-1 AS BIGINT) AS f, 'No results found' AS text
FROM search_queries WHERE query_id NOT IN (SELECT query_id FROM search_rows)""", "search_rows", "search_queries")
for _name, _order in (("max_count", "p.fr DESC, p.path"), ("min_count", "p.fr, p.path")):
    oracle(_name, f"""SELECT w.term, CAST(coalesce(b.fr, 0) AS BIGINT) AS fr, b.path
FROM (SELECT DISTINCT term FROM query_terms) AS w
LEFT JOIN (SELECT p.term, p.fr, p.path, row_number() OVER (PARTITION BY p.term ORDER BY {_order}) AS rk
           FROM postings AS p WHERE p.term IN (SELECT term FROM query_terms)) AS b
  ON b.term = w.term AND b.rk = 1""", "query_terms", "postings")

# --- link graph -----------------------------------------------------------------
cte("readable_edges", """SELECT DISTINCT l.src, strip_parent(l.raw_dst) AS dst
FROM links AS l JOIN corpus AS c ON c.path = l.src AND c.readable""", "links", "corpus")
oracle("extract_links", "SELECT src, raw_dst, strip_parent(raw_dst) AS dst FROM links", "links")
oracle("normalize_url", """SELECT src, raw_dst, strip_parent(raw_dst) AS once, fetch_path(raw_dst) AS twice
FROM links""", "links")
oracle("site_of", """SELECT DISTINCT url, regexp_extract(url, '^/*([^/]+)', 1) AS site
FROM (SELECT dst AS url FROM edges UNION ALL SELECT path AS url FROM corpus)""", "edges", "corpus")
oracle("seen_urls", f"""SELECT DISTINCT url FROM (SELECT dst AS url FROM edges UNION ALL SELECT '{START_PAGE}' AS url)""",
       "edges")
oracle("frontier_step", f"""SELECT DISTINCT e.dst AS path FROM readable_edges AS e
WHERE e.src = fetch_path('{START_PAGE}') AND e.dst <> '{START_PAGE}'""", "readable_edges")
oracle("dangling_links", """SELECT src, dst FROM edges
WHERE fetch_path(dst) NOT IN (SELECT path FROM corpus)""", "edges", "corpus")
oracle("inlink_audit", """SELECT path, regexp_extract(path, '^/*([^/]+)', 1) AS site FROM corpus
WHERE path NOT IN (SELECT fetch_path(dst) FROM edges)""", "corpus", "edges")
oracle("crawl", "SELECT path, depth, status, bytes FROM crawl", "crawl")
oracle("unreached_pages", """SELECT path FROM corpus
WHERE path NOT IN (SELECT fetch_path(path) FROM crawl)""", "corpus", "crawl")
oracle("crawl_stats", """SELECT status, CAST(count(*) AS BIGINT) AS n_urls,
  CAST(count(*) FILTER (WHERE bytes > 0) AS BIGINT) AS downloads,
  CAST(sum(CASE WHEN bytes > 0 THEN bytes ELSE 0 END) AS BIGINT) AS bytes
FROM crawl GROUP BY status""", "crawl")
oracle("crawl_limited", """SELECT path, depth, CASE WHEN depth <= 2 THEN status END AS status, CASE WHEN depth <= 2 THEN bytes END AS bytes
FROM crawl WHERE depth <= 3""", "crawl")
oracle("crawl_gate", """SELECT count(*) FILTER (WHERE depth <= 2) AS fetched, count(*) FILTER (WHERE depth = 3) AS pending,
  CASE WHEN count(*) FILTER (WHERE depth = 3) > 0 THEN 'Crawling still in progress.Sorry.' ELSE 'ready' END AS gate
FROM crawl""", "crawl")
cte("saved", "SELECT DISTINCT fetch_path(path) AS path FROM crawl WHERE status = 200 AND bytes > 0", "crawl")
oracle("crawled_rows", """SELECT query_id, path, n_rows, f, row, line FROM search_rows
WHERE path IN (SELECT path FROM saved)""", "search_rows", "saved")
oracle("crawled_rank", """SELECT query_id, rank, path, freq FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY freq DESC, path) AS BIGINT) AS rank, path, freq
  FROM page_freq WHERE path IN (SELECT path FROM saved)) WHERE rank <= 10""", "page_freq", "saved")
oracle("crawl_pending", """SELECT depth AS max_depth,
  CAST(sum(n) OVER (ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fetched,
  CAST(coalesce(lead(n) OVER (ORDER BY depth), 0) AS BIGINT) AS pending,
  CASE WHEN coalesce(lead(n) OVER (ORDER BY depth), 0) > 0 THEN 'Crawling still in progress.Sorry.' ELSE 'ready' END AS gate
FROM (SELECT depth, count(*) AS n FROM crawl GROUP BY depth)""", "crawl")

# --- requests, commands, counters -------------------------------------------------


def _hms(s: str) -> str:
    return f"printf('%02d:%02d:%02d', ({s}) // 3600, (({s}) % 3600) // 60, ({s}) % 60)"


oracle("request_log", "SELECT event_id, server, is_cmd, req_path FROM request_log", "request_log")
cte("command_rows", """SELECT event_id,
  CASE WHEN raw = 'STATS' || chr(13) || chr(10) THEN 'STATS'
       WHEN raw = 'SHUTDOWN' || chr(13) || chr(10) THEN 'SHUTDOWN'
       WHEN regexp_matches(raw, '^ *SEARCH( |\\z)') THEN 'SEARCH' ELSE 'UNKNOWN' END AS kind,
  list_filter(string_split_regex(regexp_extract(raw, '^([^\\n]*)', 1), '[ \\r\\n]'), lambda x: x <> '')[2:] AS terms
FROM commands""", "commands")
oracle("command_log", """SELECT event_id, kind,
  CASE WHEN kind = 'SEARCH' THEN array_to_string(terms, ' ') END AS terms_text,
  CASE WHEN kind = 'SEARCH' THEN CAST(len(terms) AS BIGINT) END AS n_terms,
  CASE WHEN kind = 'UNKNOWN' THEN 'Sorry , I don''t serve this command.' END AS reply
FROM command_rows""", "command_rows")
oracle("request_status", "SELECT event_id, server, path, status, bytes FROM request_status", "request_status")
oracle("server_stats", """SELECT server,
  CAST(count(*) FILTER (WHERE status = 200 AND bytes > 0) AS BIGINT) AS served,
  CAST(sum(CASE WHEN status = 200 AND bytes > 0 THEN bytes ELSE 0 END) AS BIGINT) AS bytes
FROM request_status GROUP BY server""", "request_status")
oracle("stats_asof", f"""SELECT event_id, server, served, bytes, {_hms('secs - start_secs')} AS uptime,
  printf('Server up for %s , %d pages have been served ,%d bytes.', {_hms('secs - start_secs')}, served, bytes) AS reply
FROM (SELECT event_id, server, is_cmd, secs,
    CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER w AS BIGINT) AS served,
    CAST(sum(CASE WHEN ok THEN b ELSE 0 END) OVER w AS BIGINT) AS bytes,
    min(secs) OVER (PARTITION BY server) AS start_secs
  FROM (SELECT r.event_id, r.server, r.is_cmd, r.ts, epoch_us(r.ts) // 1000000 AS secs,
          (NOT r.is_cmd AND c.readable AND strlen(c.html) > 0) AS ok, strlen(c.html) AS b
        FROM request_log AS r LEFT JOIN corpus AS c ON c.path = r.req_path)
  WINDOW w AS (PARTITION BY server ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE is_cmd""", "request_log", "corpus")
oracle("crawler_stats", f"""SELECT {_hms('3986')} AS uptime, downloads, bytes,
  printf('Server up for %s , %d downloads ,%d bytes.', {_hms('3986')}, downloads, bytes) AS reply
FROM (SELECT CAST(count(*) FILTER (WHERE bytes > 0) AS BIGINT) AS downloads, CAST(sum(bytes) AS BIGINT) AS bytes FROM crawl)""", "crawl")
cte("crawl_log", """SELECT path, s + 600 * fetched AS secs, fetched, downloads, bytes, n - fetched AS pending
FROM (SELECT path, CAST(row_number() OVER w AS BIGINT) AS fetched, CAST(count(*) FILTER (WHERE bytes > 0) OVER w AS BIGINT) AS downloads,
        CAST(sum(bytes) OVER w AS BIGINT) AS bytes, CAST(count(*) OVER () AS BIGINT) AS n
      FROM crawl WINDOW w AS (ORDER BY depth, path ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS c
CROSS JOIN (SELECT min(epoch_us(ts) // 1000000) AS s FROM events) AS e""", "crawl")
oracle("crawl_log", "SELECT path, secs AS ts, fetched, downloads, bytes, pending FROM crawl_log", "crawl_log")
# counters of each command's time: sums over the fetches before it, in one ordered union
cte("command_asof", """SELECT event_id, secs, start_secs, CAST(downloads AS BIGINT) AS downloads, CAST(bytes AS BIGINT) AS bytes,
  CASE WHEN fetches > 0 THEN CAST(n - fetches AS BIGINT) END AS pending
FROM (SELECT event_id, us // 1000000 AS secs, start_secs, n,
        sum(d) OVER w AS downloads, sum(b) OVER w AS bytes, sum(f) OVER w AS fetches
      FROM (SELECT event_id, epoch_us(ts) AS us, 1 AS side, 0 AS d, 0 AS b, 0 AS f FROM events
            UNION ALL
            SELECT NULL, secs * 1000000, 0, CASE WHEN c.bytes > 0 THEN 1 ELSE 0 END, c.bytes, 1
            FROM crawl_log AS l JOIN crawl AS c USING (path)) AS u
      CROSS JOIN (SELECT min(epoch_us(ts) // 1000000) AS start_secs FROM events) AS s
      CROSS JOIN (SELECT count(*) AS n FROM crawl) AS k
      WINDOW w AS (ORDER BY us, side, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE event_id IS NOT NULL""", "crawl_log", "crawl")
_REPLY = f"""CASE WHEN c.kind = 'UNKNOWN' THEN 'Sorry , I don''t serve this command.'
       WHEN c.kind = 'STATS' THEN printf('Server up for %s , %d downloads ,%d bytes.', {_hms('a.secs - a.start_secs')}, a.downloads, a.bytes)
       WHEN c.kind = 'SEARCH' AND coalesce(a.pending, 1) > 0 THEN 'Crawling still in progress.Sorry.'"""
oracle("command_replies", f"""SELECT c.event_id, c.kind, a.downloads, a.bytes, a.pending, {_REPLY} END AS reply
FROM command_rows AS c JOIN command_asof AS a USING (event_id)""", "command_rows", "command_asof")
oracle("server_command_log", """SELECT event_id, CASE WHEN kind = 'SEARCH' THEN 'UNKNOWN' ELSE kind END AS kind,
  CASE WHEN kind IN ('SEARCH', 'UNKNOWN') THEN 'Sorry,I don''t serve this command.' END AS reply
FROM command_rows""", "command_rows")
oracle("uptime_hms", f"""SELECT event_id, secs, {_hms('secs')} AS uptime
FROM (SELECT event_id, epoch_us(ts) // 1000000 - epoch_us(date_trunc('month', ts)) // 1000000 AS secs FROM events)""")

# --- sources and sinks, text counts -------------------------------------------------
oracle("scan_pages", """SELECT path, regexp_extract(path, '^/*([^/]+)', 1) AS site, html,
  CAST(strlen(html) AS BIGINT) AS n_bytes FROM corpus""", "corpus")
oracle("site_catalog", """SELECT regexp_extract(path, '^/*([^/]+)', 1) AS site, CAST(count(*) AS BIGINT) AS n_pages,
  CAST(sum(strlen(html)) AS BIGINT) AS n_bytes FROM corpus GROUP BY 1""", "corpus")
oracle("write_pages", """SELECT path, regexp_extract(path, '^/*([^/]+)', 1) AS site, readable,
  CAST(strlen(html) AS BIGINT) AS n_bytes, md5(html) AS html_md5
FROM (SELECT path, readable, html || CASE WHEN starts_with(path, 'site3/') AND doc_id % 3 = 0 THEN 'saved again' || chr(10) ELSE '' END AS html
      FROM corpus)""", "corpus")
oracle("write_index", "SELECT term, path, row, line_no, tf FROM occurrences", "occurrences")


def _saved_postings(html: str, where: str = "") -> str:
    """Postings of the pages with the text that their last save gave them."""
    return f"""SELECT term, path, CAST(sum(tf) AS BIGINT) AS fr, array_to_string(list_sort(list_distinct(list(row))), '-') AS offsets_text,
  CAST(len(list_distinct(list(row))) AS BIGINT) AS n_offsets
FROM (SELECT path, row, unnest(list_filter(string_split(line, ' '), lambda x: x <> '')) AS term, 1 AS tf
      FROM (SELECT path, CAST(row_number() OVER (PARTITION BY path ORDER BY no) - 1 AS BIGINT) AS row, line
            FROM (SELECT path, unnest(generate_series(1, len(parts))) AS no, unnest(parts) AS line
                  FROM (SELECT path, CASE WHEN p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS parts
                        FROM (SELECT path, string_split({html}, chr(10)) AS p FROM corpus)))
            WHERE NOT (line LIKE '<_%')))
{where} GROUP BY term, path"""


_THIRD = """html || CASE WHEN starts_with(path, 'site3/') AND doc_id % 3 = 0 THEN 'saved again' || chr(10)
  || CASE WHEN doc_id % 2 = 0 THEN 'the third time' || chr(10) ELSE '' END ELSE '' END"""
_NEWLINE = """CASE WHEN starts_with(path, 'site5/') THEN replace(html, chr(92) || 't</body>' || chr(92) || 'n</html>' || chr(10), '') || 'a new line' || chr(10) ELSE html END"""
oracle("live_lookup", _saved_postings(_THIRD, "WHERE term IN ('again', 'third', 'the')"), "corpus")
oracle("stream_live_postings", _saved_postings(_NEWLINE), "corpus")
oracle("text_bwl", """SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes,
  CAST(len(regexp_extract_all(text, '[^ \\n]+[ \\n]')) AS BIGINT) AS words,
  CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS lines
FROM documents""")
oracle("corpus_bwl", """SELECT site, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(words) AS BIGINT) AS words,
  CAST(sum(lines) AS BIGINT) AS lines, CAST(count(*) AS BIGINT) AS n_pages
FROM (SELECT regexp_extract(path, '^/*([^/]+)', 1) AS site, strlen(html) AS bytes,
        len(regexp_extract_all(html, '[^ \\n]+[ \\n]')) AS words,
        length(html) - length(replace(html, chr(10), '')) AS lines FROM corpus)
GROUP BY ROLLUP (site)""", "corpus")

cte("slice_plan", """SELECT path, CAST(k AS BIGINT) AS k, k * len AS lo, (k + 1) * len AS hi
  FROM (SELECT path, greatest(len(ls) // 4, 1) AS len, unnest(generate_series(0, 3)) AS k FROM page_split)""", "page_split")
oracle("line_slices", """SELECT l.path, p.k, l.line_no, l.line FROM lines AS l JOIN slice_plan AS p ON p.path = l.path AND l.line_no BETWEEN p.lo AND p.hi""",
       "lines", "slice_plan")

# --- streams (at end of input each equals its batch form) -------------------------------
oracle("stream_server_stats", ORACLES["server_stats"][0], *ORACLES["server_stats"][1])
oracle("stream_seen_urls", "SELECT DISTINCT dst AS url FROM edges", "edges")
oracle("stream_postings", ORACLES["postings"][0], *ORACLES["postings"][1])
oracle("stream_requested_urls", "SELECT DISTINCT req_path AS url FROM request_log WHERE NOT is_cmd AND req_path IS NOT NULL", "request_log")
cte("command_keys", """SELECT event_id, kind, list_distinct(terms) AS uterms,
  array_to_string(list_sort(list_distinct(terms)), ' ') AS qkey FROM command_rows""", "command_rows")
# SEARCH commands that come after the crawl's last fetch are answered from the pages that it saved
cte("command_hits", """SELECT DISTINCT q.qkey, o.path, o.row
FROM (SELECT DISTINCT qkey, unnest(uterms) AS term FROM command_keys JOIN command_asof USING (event_id) WHERE kind = 'SEARCH' AND pending = 0) AS q
JOIN occurrences AS o ON o.term = q.term
WHERE o.path IN (SELECT path FROM saved)""", "command_keys", "command_asof", "occurrences", "saved")
oracle("stream_commands", f"""SELECT c.event_id, c.kind,
  CASE WHEN c.kind = 'SEARCH' AND a.pending = 0 THEN CAST(coalesce(h.n_pages, 0) AS BIGINT) END AS n_pages,
  CASE WHEN c.kind = 'SEARCH' AND a.pending = 0 THEN CAST(coalesce(h.n_rows, 0) AS BIGINT) END AS n_rows,
  {_REPLY}
       WHEN c.kind = 'SEARCH' AND coalesce(h.n_rows, 0) = 0 THEN 'No results found' END AS reply
FROM command_keys AS c JOIN command_asof AS a USING (event_id)
LEFT JOIN (SELECT qkey, count(DISTINCT path) AS n_pages, count(*) AS n_rows FROM command_hits GROUP BY qkey) AS h
  ON h.qkey = c.qkey AND c.kind = 'SEARCH'""", "command_keys", "command_asof", "command_hits")
oracle("stream_answers", """SELECT h.qkey, h.path, CAST(count(*) OVER (PARTITION BY h.qkey, h.path) AS BIGINT) AS n_rows,
  CAST(row_number() OVER (PARTITION BY h.qkey, h.path ORDER BY h.row) - 1 AS BIGINT) AS f, h.row, l.line
FROM command_hits AS h JOIN ix_lines AS l ON l.path = h.path AND l.row = h.row""", "command_hits", "ix_lines")
oracle("search_stored", ORACLES["search_rows"][0], *ORACLES["search_rows"][1])
oracle("search_command", """SELECT q.query_id, 'SEARCH' AS kind, CAST(coalesce(h.n_pages, 0) AS BIGINT) AS n_pages,
  CAST(coalesce(h.n_rows, 0) AS BIGINT) AS n_rows, CASE WHEN coalesce(h.n_rows, 0) = 0 THEN 'No results found' END AS reply
FROM search_queries AS q
LEFT JOIN (SELECT query_id, count(DISTINCT path) AS n_pages, count(*) AS n_rows FROM hit_lines GROUP BY query_id) AS h
  ON h.query_id = q.query_id""", "search_queries", "hit_lines")
oracle("search_totals", """SELECT query_id, CAST(count(DISTINCT path) AS BIGINT) AS n_pages,
  CAST(count(*) AS BIGINT) AS n_rows FROM hit_lines GROUP BY query_id""", "hit_lines")
cte("in_degree", """SELECT c.path, CAST(count(DISTINCT e.src) AS BIGINT) AS in_degree
FROM corpus AS c LEFT JOIN edges AS e ON fetch_path(e.dst) = c.path GROUP BY c.path""", "corpus", "edges")
oracle("in_degree", "SELECT path, in_degree FROM in_degree", "in_degree")
oracle("inlink_coverage", """SELECT CAST(count(*) AS BIGINT) AS n_pages,
  CAST(count(*) FILTER (WHERE in_degree = 0) AS BIGINT) AS n_unlinked,
  count(*) FILTER (WHERE in_degree = 0) = 0 AS all_linked FROM in_degree""", "in_degree")
