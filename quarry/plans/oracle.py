"""DuckDB SQL equal in result to each registered query (run on the same Parquet tables)."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["doc_frequency"] = r"""
SELECT term, count(*)::BIGINT AS doc_count
FROM (SELECT unnest(list_distinct(list_transform(regexp_extract_all(text, '\p{L}+'), lambda x: lower(x)))) AS term
      FROM documents)
GROUP BY term
"""

ORACLE["term_frequency"] = r"""
SELECT term, count(*)::BIGINT AS term_count
FROM (SELECT unnest(list_transform(regexp_extract_all(text, '\p{L}+'), lambda x: lower(x))) AS term
      FROM documents)
GROUP BY term
"""

ORACLE["word_count"] = r"""
SELECT word, count(*)::BIGINT AS cnt
FROM (SELECT unnest(regexp_split_to_array(trim(text, E' \t\n\r\f'), '\s')) AS word FROM conversations)
WHERE word <> ''
GROUP BY word
"""

ORACLE["word_count_ws"] = r"""
WITH a AS (SELECT regexp_split_to_array(text, '\r\n|\n|\r') AS parts FROM conversations WHERE text IS NOT NULL),
     l AS (SELECT unnest(CASE WHEN parts[-1] = '' THEN parts[1:len(parts) - 1] ELSE parts END) AS line FROM a),
     w AS (SELECT CASE WHEN line = '' THEN ['']
                       WHEN regexp_full_match(line, '\s+') THEN []::VARCHAR[]
                       ELSE regexp_split_to_array(regexp_replace(line, '\s+$', ''), '\s') END AS words
           FROM l)
SELECT word, count(*)::BIGINT AS cnt FROM (SELECT unnest(words) AS word FROM w) GROUP BY word
"""

# strict URL host
_HOST = (r"'(?is)^(?:url:)?(?:https?|ftp):(?://(?:[^/?#]*@)?(\[[0-9a-f:.]+(?:%[^\]/?#]*)?\]|[^/?#:\[]*)"
         r"(?::\+?[0-9]{0,9})?(?:[/?#].*)?|[^/].*|/[^/].*|/)?$'")
_TRIM = r"regexp_replace(url, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
_HOST_OF = f"CASE WHEN regexp_matches({_TRIM}, {_HOST}) THEN regexp_extract({_TRIM}, {_HOST}, 1) END"
_HOSTS = f"""
hosts AS (SELECT {_HOST_OF} AS host FROM pages),
counts AS (SELECT host, count(*)::BIGINT AS hits FROM hosts WHERE host IS NOT NULL GROUP BY host)
"""

ORACLE["host_counts"] = f"WITH {_HOSTS} SELECT host, hits FROM counts"

ORACLE["host_percent"] = f"""WITH {_HOSTS}
SELECT host, hits, round(hits * 100.0 / sum(hits) OVER (), 6)::DOUBLE AS percent FROM counts"""

ORACLE["host_counts_tagged"] = f"WITH {_HOSTS} SELECT 'H:' || host AS key, hits::FLOAT AS value FROM counts"

ORACLE["malformed_url_count"] = f"""
WITH u AS (SELECT url FROM pages UNION ALL SELECT substr(url, 8) FROM pages),
h AS (SELECT {_HOST_OF} AS host FROM u)
SELECT count(*)::BIGINT AS urls, count(*) FILTER (WHERE host IS NULL)::BIGINT AS malformed_urls,
       count(DISTINCT host)::BIGINT AS hosts FROM h
"""

_CLICKS = f"""
n AS (SELECT count(*) AS n FROM pages),
clicks AS (SELECT e.event_type AS query, p.url FROM events e CROSS JOIN n JOIN pages p ON p.page_id = e.event_id % n.n),
pairs AS (SELECT host, query, count(*)::BIGINT AS clicks
          FROM (SELECT {_HOST_OF} AS host, query
                FROM clicks) WHERE host IS NOT NULL GROUP BY host, query),
best AS (SELECT host, query, clicks FROM
           (SELECT *, row_number() OVER (PARTITION BY host ORDER BY clicks DESC, query) AS rn FROM pairs)
         WHERE rn = 1)
"""

ORACLE["top_query_per_host"] = f"WITH {_CLICKS} SELECT host, query, clicks FROM best"
ORACLE["top_query_per_host_min"] = f"WITH {_CLICKS} SELECT host, query, clicks FROM best WHERE clicks >= 30"
ORACLE["top_query_per_host_as_written"] = f"""WITH {_CLICKS}
SELECT host, CASE WHEN clicks < 30 THEN '' ELSE query END AS query,
       CASE WHEN clicks < 30 THEN 29 ELSE clicks END::BIGINT AS clicks FROM best"""

ORACLE["host_bucket_sorted"] = f"""WITH {_HOSTS}
SELECT host, CASE WHEN ascii(host) < 97 THEN 0 WHEN ascii(host) > 122 THEN 34
                  ELSE floor((ascii(host) - 97) / 26.0 * 35)::INTEGER END AS bucket
FROM counts"""

_READINGS = """
r AS (SELECT l_suppkey AS station, year(l_shipdate)::INTEGER AS year, month(l_shipdate)::INTEGER AS month,
             day(l_shipdate)::INTEGER AS day,
             CAST(CAST((CAST(CASE WHEN l_returnflag = 'A' THEN 9999.9 ELSE l_quantity END AS FLOAT) - 32::FLOAT)
                       * 5::FLOAT AS FLOAT) / 9 AS FLOAT) AS max_c
      FROM lineitem),
v AS (SELECT * FROM r WHERE abs(max_c - 5537.72::FLOAT) > 1),
hot AS (SELECT station, day, month, year, max_c,
               printf('%d:%02d.%02d', station, day, month) AS key, printf('%.1fC (%d)', max_c, year) AS value
        FROM (SELECT *, row_number() OVER (PARTITION BY station, day, month ORDER BY max_c DESC, year) AS rn FROM v)
        WHERE rn = 1),
st AS (SELECT lpad(s_suppkey::VARCHAR, greatest(6, length(s_suppkey::VARCHAR))::INTEGER, '0') AS usaf,
              CASE WHEN s_acctbal < 0 THEN '' ELSE s_acctbal::VARCHAR END AS lat,
              (s_nationkey * 7 - 90)::VARCHAR AS lon, s_name AS name FROM supplier),
ust AS (SELECT usaf::BIGINT AS station, lat::DOUBLE AS lat, lon::DOUBLE AS lon, name FROM st
        WHERE usaf <> '999999' AND lat <> '' AND lon <> '')
"""

ORACLE["hottest_year_per_station_day"] = f"WITH {_READINGS} SELECT * FROM hot"
ORACLE["weather_skipped"] = f"""WITH {_READINGS}
SELECT count(*)::BIGINT AS readings, count(*) FILTER (WHERE NOT abs(max_c - 5537.72::FLOAT) > 1)::BIGINT AS skipped FROM r"""
ORACLE["station_label_join"] = f"""WITH {_READINGS}
SELECT h.station, h.key, printf('%.4f, %.4f, %s (%s)', u.lat, u.lon, u.name, h.value) AS label
FROM hot h JOIN ust u ON h.station = u.station"""
ORACLE["station_missing"] = f"""WITH {_READINGS}
SELECT station, key FROM hot h WHERE NOT EXISTS (SELECT 1 FROM ust u WHERE u.station = h.station)"""
ORACLE["on_this_day"] = f"WITH {_READINGS} SELECT key, value FROM hot WHERE day = 9 AND month = 3"

_ROBOTS = r"""
pg AS (SELECT md5(url) AS row_key, url,
              CASE WHEN substr(md5(url), 2, 1) < '6' THEN 'Y' END AS disabled,
              regexp_replace(url, '^.*?://', '') AS rest FROM pages),
pp AS (SELECT row_key, url, disabled, split_part(rest, '/', 1) AS host,
              CASE WHEN strpos(rest, '/') = 0 THEN ''
                   WHEN starts_with(substr(rest, strpos(rest, '/') + 1), '/') THEN substr(rest, strpos(rest, '/') + 1)
                   ELSE '/' || substr(rest, strpos(rest, '/') + 1) END AS path FROM pg),
hs AS (SELECT DISTINCT host FROM pp),
ch AS (SELECT host, ascii(substr(md5(host), 1, 1)) % 7 AS c FROM hs),
si AS (SELECT 'http://' || host || '/' AS site, host,
              CASE c WHEN 0 THEN NULL WHEN 1 THEN 'Disallow: /en'
                     WHEN 2 THEN 'Disallow: *.html$' || chr(10) || 'Disallow: /fr/'
                     WHEN 3 THEN 'Disallow: *#top$'
                     WHEN 4 THEN 'Disallow: /es/' || chr(10) || 'Disallow: *utm_source=feed$' || chr(10) || 'Disallow: /de/1$'
                     WHEN 5 THEN '' ELSE 'User-agent: *' || chr(10) || 'Disallow: *page=2' END AS robots
       FROM ch
       UNION ALL SELECT host AS site, host, 'Disallow: /' AS robots FROM ch WHERE c = 1),
one AS (SELECT host, arg_min(robots, site) AS robots FROM si WHERE robots IS NOT NULL GROUP BY host),
rl AS (SELECT host, substr(line, 11) AS t
       FROM (SELECT host, unnest(string_split(robots, chr(10))) AS line FROM one)
       WHERE starts_with(line, 'Disallow: ')),
rb AS (SELECT host, t, CASE WHEN starts_with(t, '*') THEN substr(t, 2) ELSE t END AS b FROM rl),
rk AS (SELECT host,
              CASE WHEN starts_with(t, '/') THEN CASE WHEN ends_with(t, '$') THEN 'exact' ELSE 'prefix' END
                   WHEN starts_with(t, '*') THEN CASE WHEN ends_with(t, '$') THEN 'suffix' ELSE 'contains' END
                   WHEN ends_with(t, '$') THEN 'suffix' ELSE 'exact' END AS kind,
              CASE WHEN ends_with(t, '$') THEN substr(b, 1, length(b) - 1) ELSE b END AS lit FROM rb),
st AS (SELECT row_key, url, disabled IS NOT NULL AS was,
              EXISTS (SELECT 1 FROM rk WHERE rk.host = pp.host AND
                        CASE kind WHEN 'prefix' THEN starts_with(path, lit) WHEN 'exact' THEN path = lit
                                  WHEN 'contains' THEN contains(path, lit) ELSE ends_with(path, lit) END) AS dis,
              disabled
       FROM pp)
"""

ORACLE["robots_status_changes"] = f"""WITH {_ROBOTS}
SELECT row_key, url, CASE WHEN dis AND NOT was THEN 'put' ELSE 'delete' END AS op
FROM st WHERE dis <> was"""
ORACLE["robots_reconciled"] = f"WITH {_ROBOTS} SELECT row_key, url, CASE WHEN dis THEN 'Y' END AS disabled FROM st"
ORACLE["robots_reconciled_salted"] = ORACLE["robots_reconciled"]
ORACLE["keyed_upsert_delete"] = ORACLE["robots_reconciled"]
ORACLE["robots_reconciled_lookup"] = ORACLE["robots_reconciled"]
ORACLE["first_per_key"] = r"""
SELECT split_part(regexp_replace(url, '^.*?://', ''), '/', 1) AS host, arg_min(url, page_id) AS url
FROM pages GROUP BY 1"""

_EDGES = """
e AS (SELECT l_suppkey AS src, l_partkey + 50 AS dst FROM lineitem),
nodes AS (SELECT src AS id FROM e UNION SELECT dst FROM e),
nn AS (SELECT count(*)::DOUBLE AS n FROM nodes)
"""

ORACLE["edges_distinct"] = f"WITH {_EDGES} SELECT DISTINCT src, dst FROM e"
ORACLE["graph_nodes"] = f"WITH {_EDGES} SELECT id FROM nodes"
ORACLE["dangling_nodes"] = f"WITH {_EDGES} SELECT id FROM nodes WHERE id NOT IN (SELECT src FROM e)"
ORACLE["adjacency_list"] = f"""WITH {_EDGES},
m AS (SELECT src, dst, count(*)::BIGINT AS mult FROM e GROUP BY src, dst)
SELECT src, dst, mult, sum(mult) OVER (PARTITION BY src)::BIGINT AS outdeg FROM m"""


def _pagerank_sql(variant: str, dangling: str, iterations: int, tail: str = "") -> str:
    """A chain of CTEs, one group per iteration (same formulas as the Spark operator)."""
    multi = variant == "multi"
    m = ("SELECT src, dst, count(*)::DOUBLE AS mult FROM e GROUP BY src, dst" if multi
         else "SELECT DISTINCT src, dst, 1.0::DOUBLE AS mult FROM e")
    parts = [_EDGES.strip(),
             f"m AS ({m})",
             "deg AS (SELECT src, sum(mult) AS outdeg FROM m GROUP BY src)",
             "w AS (SELECT m.src, m.dst, m.mult / deg.outdeg AS w FROM m JOIN deg USING (src))",
             "nd AS (SELECT id, id IN (SELECT src FROM deg) AS has_out FROM nodes)",
             "r0 AS (SELECT id, has_out, 1.0::DOUBLE / n AS pr FROM nd, nn" + (" WHERE has_out)" if multi else ")"),
             "l0 AS (SELECT 0.0::DOUBLE AS l)"]
    for k in range(1, iterations + 1):
        p = k - 1
        if multi:
            parts.append(f"c{k} AS (SELECT id, has_out, pr + l / n AS cur FROM r{p}, l{p}, nn)")
        else:
            parts.append(f"c{k} AS (SELECT nd.id, nd.has_out, coalesce(r.pr, 0.0) + l / n AS cur "
                         f"FROM nd LEFT JOIN r{p} r USING (id), l{p}, nn)")
        if dangling == "redistribute":
            parts.append(f"l{k} AS (SELECT coalesce(sum(cur) FILTER (WHERE NOT has_out), 0.0)::DOUBLE AS l FROM c{k})")
        else:
            parts.append(f"l{k} AS (SELECT 0.0::DOUBLE AS l)")
        parts.append(f"s{k} AS (SELECT w.dst AS id, sum(w.w * c.cur) AS s FROM w JOIN c{k} c ON w.src = c.id "
                     f"WHERE c.has_out GROUP BY w.dst)")
        ids = f"(SELECT id FROM r{p} UNION SELECT id FROM s{k})" if multi else f"(SELECT id FROM s{k})"
        parts.append(f"r{k} AS (SELECT u.id, nd.has_out, "
                     f"(1.0::DOUBLE - 0.85::DOUBLE) / n + 0.85::DOUBLE * coalesce(s.s, 0.0) AS pr "
                     f"FROM {ids} u JOIN nd USING (id) LEFT JOIN s{k} s USING (id), nn)")
    n = iterations
    parts.append(f"fin AS (SELECT id, round(pr + l / n, 8) AS pr FROM r{n}, l{n}, nn)")
    return "WITH " + ",\n".join(parts) + "\nSELECT id, pr FROM fin " + tail


ORACLE["pagerank_multi"] = _pagerank_sql("multi", "redistribute", 3)
ORACLE["pagerank_set"] = _pagerank_sql("set", "redistribute", 3)
ORACLE["pagerank_set_ignore_dangling"] = _pagerank_sql("set", "ignore", 3)
ORACLE["pagerank_top_k"] = _pagerank_sql("set", "redistribute", 3, "ORDER BY pr DESC, id LIMIT 11")

# round trips through the file layouts equal the job on the table itself
ORACLE["fixed_records"] = "SELECT vec_id, embedding FROM embeddings"
ORACLE["indexed_chunks_doc_frequency"] = ORACLE["doc_frequency"]
ORACLE["proto_docs"] = """
SELECT 'doc://' || doc_id AS url, lang AS body,
       CASE WHEN lang <> 'es' THEN length(text) END::BIGINT AS n_chars, CASE WHEN lang <> 'es' THEN md5(text) END AS text_md5
FROM documents"""
ORACLE["bulk_sorted_load"] = r"""
SELECT 'doc://' || doc_id AS row_key,
       (length(text) + length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g')))::INTEGER AS size,
       md5(text) AS text_md5
FROM documents WHERE lang <> 'es'"""
ORACLE["kv_lines"] = ORACLE["top_query_per_host"]
ORACLE["edge_lines"] = ORACLE["edges_distinct"]
ORACLE["fixed_width_weather"] = f"""WITH {_READINGS}
SELECT station, day, month, year, max_c, key, value FROM hot"""

ORACLE["term_frequency_sized"] = r"""
SELECT term, count(*)::BIGINT AS term_count
FROM (SELECT unnest(list_transform(regexp_extract_all(text, '\p{L}+'), lambda x: lower(x))) AS term
      FROM documents WHERE n_chars BETWEEN 9216 AND 10240)
GROUP BY term
"""
ORACLE["document_size_check"] = """
SELECT count(*)::BIGINT AS documents, count(*) FILTER (WHERE NOT n_chars BETWEEN 9216 AND 10240)::BIGINT AS out_of_range
FROM documents"""

ORACLE["robots_rule_counts"] = f"""WITH {_ROBOTS},
lines AS (SELECT host, unnest(string_split(robots, chr(10))) AS line FROM one)
SELECT host, count(*) FILTER (WHERE starts_with(line, 'Disallow: '))::BIGINT AS rules,
       count(*) FILTER (WHERE line <> '' AND NOT starts_with(line, 'Disallow: '))::BIGINT AS skipped
FROM lines GROUP BY host"""

ORACLE["keyed_changes"] = """
WITH pg AS (SELECT DISTINCT md5(url) AS row_key, url FROM pages),
b AS (SELECT row_key, url, CASE WHEN substr(row_key, 2, 1) < '6' THEN 'Y' END AS disabled FROM pg
      WHERE substr(row_key, 3, 1) < 'c'),
c AS (SELECT row_key, CASE WHEN substr(row_key, 5, 1) < '4' THEN 'two' WHEN substr(row_key, 4, 1) < '8' THEN 'one' END AS v
      FROM pg)
SELECT c.row_key, b.url, c.v AS disabled FROM c LEFT JOIN b USING (row_key)
WHERE b.row_key IS NOT NULL OR c.v IS NOT NULL"""
ORACLE["rewritten_records"] = "SELECT vec_id FROM embeddings WHERE vec_id % 2 = 1"
ORACLE["keyed_upsert_few"] = """
SELECT lpad(doc_id::VARCHAR, 20, '0') AS row_key, lang, true AS in_range,
       CASE WHEN source = (SELECT min(source) FROM documents) THEN -n_chars ELSE n_chars END AS n_chars
FROM documents"""
ORACLE["key_range_read"] = """
SELECT DISTINCT md5(url) AS row_key, url FROM pages WHERE md5(url) BETWEEN '40' AND '9f'"""
ORACLE["weather_rejected_lines"] = """
SELECT count(*)::BIGINT AS lines, count(*) FILTER (WHERE l_returnflag = 'R')::BIGINT AS rejected_lines FROM lineitem"""
ORACLE["url_base64_bad_lines"] = """
SELECT count(*)::BIGINT AS lines, count(*) FILTER (WHERE doc_id % 5 < 3)::BIGINT AS bad_lines FROM documents"""
ORACLE["station_file_labels"] = ORACLE["station_label_join"]
ORACLE["small_files_word_count"] = ORACLE["word_count"]
ORACLE["point_read"] = """
SELECT DISTINCT md5(url) AS row_key, url FROM pages WHERE md5(url) = (SELECT min(md5(url)) FROM pages)"""
ORACLE["rank_state_lines"] = """
WITH s AS (SELECT o_orderkey AS id, (o_custkey % 1000) / 8.0::DOUBLE AS pr,
                  CASE WHEN o_custkey % 7 = 0 THEN '' ELSE o_custkey || ',' || (o_custkey + 1) END AS t FROM orders)
SELECT id, pr, CASE WHEN t = '' THEN 0 ELSE 2 END::INTEGER AS targets, id || ',' || pr || chr(9) || t AS line FROM s"""
ORACLE["ordered_output"] = """
SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey)::BIGINT AS place FROM customer"""
ORACLE["record_base64_lines"] = ORACLE["fixed_records"]
ORACLE["rank_tuple_lines"] = """
SELECT '(' || ((c_custkey % 1000) / 8.0::DOUBLE) || ',' || c_custkey || ')' AS line, count(*) OVER ()::DOUBLE AS lines
FROM customer"""
ORACLE["secondary_sorted"] = """
SELECT l_orderkey, l_linenumber,
       row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber)::BIGINT AS place
FROM lineitem"""
ORACLE["host_range_parts"] = f"""WITH b AS ({ORACLE["host_bucket_sorted"]}) SELECT host, bucket, bucket AS part FROM b"""
ORACLE["day_month"] = "SELECT o_orderkey, strftime(o_orderdate, '%d.%m') AS day FROM orders"
ORACLE["pipe_word_count"] = ORACLE["word_count"]
