"""DuckDB oracle SQL for the crawl-side keys (links, robots, frontier, crawl log stats).

Links are resolved by hand for root-relative hrefs, the only form in the fixture pages;
robots lines are numbered and the preceding user agent comes from a window.
"""

from __future__ import annotations

from trawl.plans.inputs import CRAWL_WORKERS, EVENT_ACTIONS, ROBOTS_BODIES

# The pages' tags: every attribute is in double quotes.
A_TAG = r"""(?i)<a(?:\s+[a-z-]+="[^"]*")*\s*>"""
HREF = r'(?i)\shref="([^"]*)"'
ORIGIN = "lower(regexp_extract({u}, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1))"
DOMAIN = ("lower(regexp_extract({u}, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1)) || '://' || "
          "lower(regexp_extract({u}, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)', 1))")
PATH_VALID = r"[A-Za-z0-9\-_.~!$&''()*+,;=:@\[\]%/]*"
PATH_KEEP = r"[A-Za-z0-9\-_.~$&+,/:;=@]"


def esc_path(p: str) -> str:
    return (f"CASE WHEN regexp_full_match({p}, '{PATH_VALID}') THEN {p} ELSE array_to_string(list_transform("
            f"string_split({p}, ''), lambda ch: CASE WHEN regexp_full_match(ch, '{PATH_KEEP}') THEN ch "
            f"ELSE regexp_replace(hex(encode(ch)), '(..)', '%\\1', 'g') END), '') END")


def links_cte(strip_raw, decode_named) -> str:
    href = decode_named(f"regexp_extract(v, '{HREF}', 1)")
    return f"""
l_raw AS (SELECT page_id, url, {strip_raw('html')} AS h FROM pages),
l_hrefs AS (
  SELECT page_id, url, unnest(v) AS v, generate_subscripts(v, 1) AS i
  FROM (SELECT page_id, url, regexp_extract_all(h, '{A_TAG}') AS v FROM l_raw)),
l_vals AS (SELECT page_id, url, i, {href} AS href FROM l_hrefs),
l_res AS (
  SELECT page_id, url, i,
         CASE WHEN starts_with(href, '/') AND NOT starts_with(href, '//') AND NOT contains(href, '#')
              THEN {ORIGIN.format(u='url')} || {esc_path("split_part(href, '?', 1)")}
                   || CASE WHEN contains(href, '?') THEN '?' || substr(href, strpos(href, '?') + 1) ELSE '' END
         END AS dst_url
  FROM l_vals),
l_first AS (SELECT page_id, url, dst_url, min(i) AS fi FROM l_res WHERE dst_url IS NOT NULL GROUP BY ALL),
links AS (
  SELECT page_id, url AS src_url,
         CAST(row_number() OVER (PARTITION BY page_id ORDER BY fi) - 1 AS INTEGER) AS link_pos, dst_url
  FROM l_first),
visited AS (SELECT dst_url AS url FROM links WHERE link_pos % 2 = 0),
in_progress AS (SELECT dst_url AS url FROM links WHERE link_pos = 1)"""


def robots_cte(trim_ws) -> str:
    bodies = ", ".join("'" + b.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for b in ROBOTS_BODIES)
    return f"""
r_dom AS (SELECT DISTINCT {DOMAIN.format(u='url')} AS domain FROM pages),
robots AS (
  SELECT domain, ([{bodies}])[(length(domain) + ascii(right(domain, 3))) % {len(ROBOTS_BODIES)} + 1] AS body
  FROM r_dom),
r_lines AS (
  SELECT domain, unnest(string_split(body, chr(10))) AS line,
         generate_subscripts(string_split(body, chr(10)), 1) AS i
  FROM robots),
r_kv AS (
  SELECT domain, i, lower({trim_ws("left(t, strpos(t, ':') - 1)")}) AS field,
         {trim_ws("substr(t, strpos(t, ':') + 1)")} AS value
  FROM (SELECT domain, i, {trim_ws('line')} AS t FROM r_lines)
  WHERE t <> '' AND NOT starts_with(t, '#') AND strpos(t, ':') > 0),
r_agent AS (
  SELECT *, last_value(CASE WHEN field = 'user-agent' THEN value END IGNORE NULLS)
              OVER (PARTITION BY domain ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS agent
  FROM r_kv),
policy AS (
  SELECT r.domain,
         NOT coalesce(bool_or(a.field = 'disallow' AND a.agent = '*' AND a.value = '/'), false) AS allowed,
         CAST(coalesce(arg_max(TRY_CAST(a.value AS BIGINT), a.i) FILTER (
              WHERE a.field = 'crawl-delay' AND a.agent = '*' AND regexp_full_match(a.value, '[+-]?[0-9]+')
                    AND TRY_CAST(a.value AS BIGINT) IS NOT NULL), 0) AS BIGINT) AS crawl_delay_s
  FROM robots r LEFT JOIN r_agent a USING (domain) GROUP BY r.domain)"""


FRONTIER = f"""
f_cand AS (SELECT DISTINCT dst_url AS url FROM links WHERE dst_url NOT IN (SELECT url FROM visited)),
f_allowed AS (
  SELECT c.url, c.domain, CAST(coalesce(p.crawl_delay_s, 0) AS BIGINT) AS crawl_delay_s
  FROM (SELECT url, {DOMAIN.format(u='url')} AS domain FROM f_cand) c
  LEFT JOIN policy p ON p.domain = c.domain
  WHERE coalesce(p.allowed, true))"""


def crawl_log_cte() -> str:
    cases = " ".join(f"WHEN event_type = '{a}' THEN '{b}'" for a, b in EVENT_ACTIONS)
    return f"""
crawl_log AS (
  SELECT ts, CAST(user_id % {CRAWL_WORKERS} AS BIGINT) AS worker_id,
         CASE {cases} ELSE event_type END AS action, value AS processing_time
  FROM events)"""


def crawl_sql(with_, strip_raw, decode_named, trim_ws) -> dict[str, str]:
    links = links_cte(strip_raw, decode_named)
    robots = robots_cte(trim_ws)
    path = esc_path("regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)")
    normal = (f"{ORIGIN.format(u='url')} || {path} || regexp_extract(url, '^[^?#]*(\\?[^#]*)?', 1) "
              "|| regexp_extract(url, '^[^#]*(#.*)?', 1)")
    normalized_pages = f"SELECT {normal} AS url FROM pages"
    return {
        "normalize_url": f"SELECT page_id, {normal} AS url FROM pages",
        "valid_url": with_(links) + """
, v_all AS (SELECT page_id, -1 AS i, url FROM pages UNION ALL SELECT page_id, i - 1, href FROM l_vals)
SELECT page_id, CAST(i AS INTEGER) AS href_pos, url,
       coalesce(regexp_matches(url, '^(?i:https?)://[^/?#]*(/|$)'), false) AS valid FROM v_all""",
        "page_links": with_(links) + "SELECT page_id, src_url, link_pos, dst_url FROM links",
        "pages_by_domain": f"SELECT {DOMAIN.format(u='url')} AS domain, count(*) AS pages FROM pages GROUP BY 1",
        "robots_policy": with_(robots) + "SELECT domain, allowed, crawl_delay_s FROM policy",
        "frontier_allowed": with_(links, robots, FRONTIER) + "SELECT url, domain, crawl_delay_s FROM f_allowed",
        "frontier_step": with_(links, robots) + f"""
, s_cand AS (
  SELECT DISTINCT url FROM (SELECT dst_url AS url FROM links UNION ALL {normalized_pages}) c
  WHERE url NOT IN (SELECT url FROM visited) AND url NOT IN (SELECT url FROM in_progress))
SELECT c.url, c.domain, CAST(coalesce(p.crawl_delay_s, 0) AS BIGINT) AS crawl_delay_s
FROM (SELECT url, {DOMAIN.format(u='url')} AS domain FROM s_cand) c LEFT JOIN policy p ON p.domain = c.domain
WHERE coalesce(p.allowed, true) ORDER BY url LIMIT 100""",
        "frontier_rounds": with_(links, robots, FRONTIER) + """
SELECT url, domain, crawl_delay_s, CAST((nth + 99) // 100 AS INTEGER) AS round
FROM (SELECT *, row_number() OVER (ORDER BY url) AS nth FROM f_allowed) WHERE nth <= 300""",
        "frontier_sizes": with_(links, robots) + """
SELECT (SELECT count(DISTINCT dst_url) FROM links WHERE dst_url NOT IN (SELECT url FROM visited)
        AND dst_url NOT IN (SELECT url FROM in_progress)) AS frontier,
       (SELECT count(DISTINCT url) FROM visited) AS visited,
       (SELECT count(DISTINCT url) FROM in_progress) AS in_progress,
       (SELECT count(DISTINCT domain) FROM policy) AS robots_cached""",
        "crawl_stats": with_(crawl_log_cte()) + """
SELECT count(*) FILTER (WHERE action = 'crawled') AS pages_crawled,
       count(*) FILTER (WHERE action = 'indexed') AS pages_indexed,
       count(*) FILTER (WHERE action = 'failed') AS pages_failed FROM crawl_log""",
        "worker_stats": with_(crawl_log_cte()) + """
SELECT worker_id, count(*) FILTER (WHERE action = 'crawled') AS pages_crawled,
       count(*) FILTER (WHERE action = 'indexed') AS pages_indexed,
       count(*) FILTER (WHERE action = 'failed') AS pages_failed,
       round(coalesce(sum(processing_time) FILTER (WHERE action = 'indexed'), 0), 6) AS total_processing_time,
       round(coalesce(sum(processing_time) FILTER (WHERE action = 'indexed'), 0)
             / greatest(count(*) FILTER (WHERE action = 'indexed'), 1), 6) AS avg_processing_time
FROM crawl_log GROUP BY worker_id""",
        "crawl_throughput": with_(crawl_log_cte()) + """
SELECT pages_crawled, round(span, 6) AS elapsed_s, round(pages_crawled / span, 6) AS pages_per_second
FROM (SELECT count(*) FILTER (WHERE action = 'crawled') AS pages_crawled,
             (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS span FROM crawl_log)
WHERE pages_crawled > 0""",
    }
