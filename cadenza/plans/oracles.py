"""Reference SQL (DuckDB dialect) for the registered queries.

Each statement computes the same result as the Spark query of the same key
from the raw tables; column names match. ``genre_pca`` has no SQL form (an
eigen-decomposition) and is checked against numpy in the tests instead.

The enrichment statements restate the failure rules of the stand-in lookup
services (``plans/responders.py``: error document, 404, non-JSON body by id
divisibility); every id of the table is still sent to the service.
"""

ORACLE_SQL = {
    "artists_union": """
        WITH s AS (
            SELECT CAST(c_custkey AS VARCHAR) AS spotify_artist_id,
                   c_name AS spotify_artist_name,
                   lower(c_mktsegment) AS spotify_artist_genres,
                   'https://open.example/artist/' || CAST(c_custkey AS VARCHAR) AS spotify_artist_url,
                   CAST(c_nationkey AS BIGINT) AS spotify_artist_popularity,
                   CAST(floor(c_acctbal) AS BIGINT) AS spotify_artist_total_followers
            FROM customer),
        d AS (
            SELECT replace(s_name, 'Supplier', 'Customer') AS deezer_artist_name,
                   'https://www.example.com/artist/' || CAST(s_suppkey AS VARCHAR) AS deezer_artist_url,
                   CAST(floor(s_acctbal) AS BIGINT) AS deezer_artist_total_followers
            FROM supplier)
        SELECT s.spotify_artist_id, s.spotify_artist_name, s.spotify_artist_genres,
               s.spotify_artist_url, s.spotify_artist_total_followers,
               s.spotify_artist_popularity, d.deezer_artist_url, d.deezer_artist_name,
               d.deezer_artist_total_followers, DATE '2024-01-31' AS ingestion_date
        FROM s LEFT JOIN d ON s.spotify_artist_name = d.deezer_artist_name
    """,
    "scan_project": """
        SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment
        FROM customer
    """,
    "distinct_ids": """
        SELECT DISTINCT CAST(nullif(l_partkey, 7) AS VARCHAR) AS id
        FROM lineitem
        WHERE nullif(l_partkey, 7) IS NOT NULL
    """,
    "id_batches": """
        SELECT p_partkey,
               CAST(floor((row_number() OVER (ORDER BY p_partkey) - 1) / 50) AS BIGINT) AS batch_id,
               row_number() OVER (ORDER BY p_partkey) AS position
        FROM (SELECT DISTINCT p_partkey FROM part)
    """,
    "enrich_batches": """
        SELECT CAST(o_orderkey AS VARCHAR) AS deezer_artist_id,
               'artist ' || CAST(o_orderkey AS VARCHAR) AS deezer_artist_name,
               'https://catalogue.example/artist/' || CAST(o_orderkey AS VARCHAR) AS deezer_artist_url,
               (o_orderkey * 37) % 100000 AS deezer_artist_total_followers,
               DATE '2024-01-31' AS ingestion_date
        FROM (SELECT DISTINCT o_orderkey FROM orders)
        WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0
    """,
    "enrich_children": """
        WITH ids AS (SELECT DISTINCT o_orderkey AS i FROM orders WHERE o_orderkey % 5 <> 0),
        t AS (SELECT i, j FROM ids, range(0, i % 4) r(j))
        SELECT CAST(i AS VARCHAR) AS request_id,
               CASE WHEN j = 0 THEN NULL ELSE
                 (SELECT string_agg('a' || CAST(i + m AS VARCHAR), ',' ORDER BY m)
                  FROM range(0, j) q(m)) END AS spotify_track_artists,
               CASE WHEN j = 0 THEN NULL ELSE
                 (SELECT string_agg('artist ' || CAST(i + m AS VARCHAR), ',' ORDER BY m)
                  FROM range(0, j) q(m)) END AS spotify_track_artist_names,
               't' || CAST(i AS VARCHAR) || '-' || CAST(j AS VARCHAR) AS spotify_track_id,
               'track ' || CAST(j AS VARCHAR) || ' of ' || CAST(i AS VARCHAR) AS spotify_track_name,
               CAST((i + j) % 100 AS BIGINT) AS spotify_track_popularity,
               'https://open.example/track/' || CAST(i AS VARCHAR) || '-' || CAST(j AS VARCHAR)
                   AS spotify_track_url,
               CASE j WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN 'FR,US' ELSE 'FR,US,DE' END
                   AS spotify_track_markets,
               'ISRC' || lpad(CAST(i AS VARCHAR), 8, '0') || CAST(j AS VARCHAR) AS spotify_track_isrc,
               CASE WHEN j % 2 = 1 THEN 'EAN' || CAST(i AS VARCHAR) || CAST(j AS VARCHAR) END
                   AS spotify_track_ean,
               'UPC' || CAST(i AS VARCHAR) AS spotify_track_upc
        FROM t
    """,
    "json_flatten": """
        SELECT event_id, user_id, event_type,
               CAST(json_extract(props, '$.k') AS INTEGER) AS k,
               coalesce(json_extract_string(props, '$.label'), 'Unknown') AS label
        FROM events
    """,
    "csv_roundtrip": """
        SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code, n_name,
               CAST(n_regionkey AS VARCHAR) AS region
        FROM nation
    """,
    "refresh_sink": """
        SELECT r_regionkey, r_name FROM region
    """,
    "append_snapshots": """
        SELECT CAST(ts AS DATE) AS ingestion_date, count(*) AS n_events,
               round(sum(value), 2) AS total_value
        FROM events GROUP BY 1
    """,
    "stream_snapshots": """
        SELECT CAST(ts AS DATE) AS ingestion_date, count(*) AS n_events,
               round(sum(value), 2) AS total_value
        FROM events GROUP BY 1
    """,
    "retention": """
        SELECT event_id, CAST(ts AS DATE) AS ingestion_date
        FROM events
        WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL 7 DAY
    """,
    "merge_matched": """
        WITH f AS (
            SELECT CAST(o_custkey AS VARCHAR) AS spotify_artist_id,
                   count(*) AS spotify_artist_popularity,
                   CAST(floor(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END)) AS BIGINT)
                       AS spotify_artist_total_followers
            FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-08-23'
            GROUP BY 1)
        SELECT CAST(c_custkey AS VARCHAR) AS spotify_artist_id,
               c_name AS spotify_artist_name, c_mktsegment AS spotify_artist_genres,
               'https://open.example/artist/' || CAST(c_custkey AS VARCHAR) AS spotify_artist_url,
               f.spotify_artist_popularity, f.spotify_artist_total_followers
        FROM customer LEFT JOIN f ON CAST(c_custkey AS VARCHAR) = f.spotify_artist_id
    """,
    "dim_fact_split": """
        SELECT CAST(o_orderkey AS VARCHAR) AS spotify_artist_id,
               'order ' || CAST(o_orderkey AS VARCHAR) AS spotify_artist_name,
               replace(o_orderpriority, '-', ',') AS spotify_artist_genres,
               'https://open.example/order/' || CAST(o_orderkey AS VARCHAR) AS spotify_artist_url,
               NULL::BIGINT AS spotify_artist_popularity,
               NULL::BIGINT AS spotify_artist_total_followers,
               NULL::DATE AS date, 'dimension' AS "table"
        FROM orders
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL, o_custkey,
               CAST(floor(o_totalprice) AS BIGINT), DATE '2024-01-31', 'fact'
        FROM orders
    """,
    "triple_pivot": """
        WITH base AS (
            SELECT 'C' || CAST(c_custkey AS VARCHAR) AS item,
                   'N' || CAST(c_nationkey AS VARCHAR) AS nation,
                   c_mktsegment, c_acctbal, c_name
            FROM customer),
        placed AS (
            SELECT 'C' || CAST(o_custkey AS VARCHAR) AS item,
                   'O' || CAST(o_orderkey AS VARCHAR) AS order_ref
            FROM orders)
        SELECT b.item,
               coalesce(CASE WHEN b.c_mktsegment <> 'AUTOMOBILE' THEN b.c_name END, b.item)
                   AS itemLabel,
               b.nation, p.order_ref, b.c_mktsegment AS segment,
               CASE WHEN b.c_acctbal > 5000 THEN 'yes' END AS rich
        FROM base b LEFT JOIN placed p ON b.item = p.item
    """,
    "lookup_default": """
        SELECT s_suppkey, s_name,
               CASE WHEN s_nationkey IS NULL OR s_nationkey = 0 THEN 'Unknown'
                    ELSE coalesce(n.n_name, 'Unknown') END AS nation_name,
               CASE WHEN n.n_regionkey IS NULL OR n.n_regionkey = 0 THEN 'Unknown'
                    ELSE coalesce(r.r_name, 'Unknown') END AS region_name
        FROM supplier
        LEFT JOIN nation n ON s_nationkey = n.n_nationkey AND s_nationkey <> 0
        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    """,
    "genre_unnest": """
        SELECT genre, count(*) AS n_users
        FROM (SELECT DISTINCT user_id,
                     upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS genre
              FROM events)
        GROUP BY genre
    """,
    "genre_member": """
        SELECT user_id, CAST(count(DISTINCT event_type) AS INTEGER) AS n_genres
        FROM events GROUP BY user_id
        HAVING bool_or(lower(event_type) = lower('CLICK'))
    """,
    "chart_union": """
        SELECT '2024-01-31' AS date, 'track' AS type, p_partkey AS id, p_name AS name,
               p_brand AS artist, CAST(p_size AS BIGINT) AS rank
        FROM part
        UNION ALL
        SELECT '2024-01-31', 'artist', s_suppkey, s_name, NULL, CAST(s_nationkey AS BIGINT)
        FROM supplier
    """,
    "value_counts": """
        SELECT event_type AS genre, count(*) AS count
        FROM events WHERE event_type IS NOT NULL GROUP BY 1
    """,
    "dedupe_first": """
        SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
        FROM part
        WHERE p_partkey IS NOT NULL AND p_name IS NOT NULL AND p_brand IS NOT NULL
          AND p_type IS NOT NULL AND p_size IS NOT NULL AND p_retailprice IS NOT NULL
          AND NOT isnan(p_retailprice)
        QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey, p_brand, p_type,
                                   p_size, p_retailprice) = 1
    """,
    "group_means": """
        SELECT l_returnflag,
               round(avg(l_quantity), 6) AS l_quantity,
               round(avg(l_extendedprice), 6) AS l_extendedprice,
               round(avg(l_discount), 6) AS l_discount,
               round(avg(l_tax), 6) AS l_tax
        FROM lineitem WHERE l_returnflag NOT IN ('N') GROUP BY 1
    """,
    "feature_bounds": """
        SELECT p_type, min(p_size) AS min_p_size, max(p_size) AS max_p_size,
               min(p_retailprice) AS min_p_retailprice, max(p_retailprice) AS max_p_retailprice,
               (SELECT min(p_retailprice) FROM part) AS all_min_p_retailprice,
               (SELECT max(p_retailprice) FROM part) AS all_max_p_retailprice
        FROM part GROUP BY 1
    """,
    "range_filter": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
        FROM lineitem
        WHERE l_quantity BETWEEN 10 AND 30 AND l_discount BETWEEN 0.02 AND 0.08
          AND l_tax BETWEEN 0.01 AND 0.06 AND l_extendedprice BETWEEN 10000 AND 60000
          AND l_returnflag = 'R'
    """,
    "choices": """
        SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL ORDER BY 1
    """,
    "choices_within": """
        SELECT DISTINCT p_brand FROM part
        WHERE p_type = 'STANDARD' AND p_brand IS NOT NULL ORDER BY 1
    """,
    "profile_numeric": """
        WITH v AS (
            SELECT 'p_partkey' AS "column", CAST(p_partkey AS DOUBLE) AS value FROM part
            UNION ALL SELECT 'p_size', CAST(p_size AS DOUBLE) FROM part
            UNION ALL SELECT 'p_retailprice', p_retailprice FROM part)
        SELECT "column", count(value) AS count,
               round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
               round(min(value), 6) AS min,
               round(quantile_cont(value, 0.25), 6) AS p25,
               round(quantile_cont(value, 0.5), 6) AS p50,
               round(quantile_cont(value, 0.75), 6) AS p75,
               round(max(value), 6) AS max
        FROM v WHERE value IS NOT NULL GROUP BY 1
    """,
    "profile_columns": """
        SELECT * FROM (VALUES
            (0, 'p_partkey', 'bigint', (SELECT count(p_partkey) FROM part)),
            (1, 'p_name', 'string', (SELECT count(p_name) FROM part)),
            (2, 'p_brand', 'string', (SELECT count(p_brand) FROM part)),
            (3, 'p_type', 'string', (SELECT count(p_type) FROM part)),
            (4, 'p_size', 'int', (SELECT count(p_size) FROM part)),
            (5, 'p_retailprice', 'double', (SELECT count(p_retailprice) FROM part)))
            AS t(position, "column", dtype, non_null),
            (SELECT count(*) AS rows FROM part)
    """,
    "scale_features": """
        WITH st AS (
            SELECT avg(p_size) AS ms, stddev_pop(p_size) AS ss,
                   avg(p_retailprice) AS mp, stddev_pop(p_retailprice) AS sp
            FROM part)
        SELECT p_partkey, p_name,
               round((p_size - ms) / CASE WHEN ss IS NULL OR ss = 0 THEN 1 ELSE ss END, 6)
                   AS p_size_z,
               round((p_retailprice - mp) / CASE WHEN sp IS NULL OR sp = 0 THEN 1 ELSE sp END, 6)
                   AS p_retailprice_z
        FROM part, st
    """,
    "knn_top10": """
        WITH x AS (
            SELECT vec_id, unnest(embedding) AS v,
                   unnest(range(1, len(embedding) + 1)) AS pos
            FROM embeddings),
        st AS (SELECT pos, avg(CAST(v AS DOUBLE)) AS m, stddev_pop(CAST(v AS DOUBLE)) AS s
               FROM x GROUP BY pos),
        z AS (SELECT x.vec_id, x.pos,
                     CAST((CAST(x.v AS DOUBLE) - st.m) /
                          CASE WHEN st.s IS NULL OR st.s = 0 THEN 1 ELSE st.s END AS FLOAT) AS z
              FROM x JOIN st USING (pos)),
        q AS (SELECT pos, z AS qz FROM z WHERE vec_id = 7),
        d AS (SELECT z.vec_id,
                     sum((CAST(z.z AS DOUBLE) - CAST(q.qz AS DOUBLE)) *
                         (CAST(z.z AS DOUBLE) - CAST(q.qz AS DOUBLE))) AS raw
              FROM z JOIN q USING (pos) GROUP BY z.vec_id)
        SELECT row_number() OVER (ORDER BY raw, vec_id) AS rank, vec_id, round(raw, 4) AS distance
        FROM d ORDER BY raw, vec_id LIMIT 10
    """,
    "dq_not_null": """
        SELECT p_partkey FROM part WHERE nullif(p_name, 'red plate') IS NULL
    """,
    "dq_unique": """
        SELECT nullif(p_name, 'red plate') AS p_name, count(*) AS n_rows
        FROM part WHERE nullif(p_name, 'red plate') IS NOT NULL
        GROUP BY 1 HAVING count(*) > 1
    """,
    "dq_summary": """
        SELECT 'not_null' AS test, 'p_name' AS column_name,
               count(*) - count(nullif(p_name, 'red plate')) AS failures FROM part
        UNION ALL
        SELECT 'unique', 'p_name', count(*) FROM (
            SELECT nullif(p_name, 'red plate') AS n FROM part WHERE n IS NOT NULL
            GROUP BY 1 HAVING count(*) > 1)
        UNION ALL
        SELECT 'not_null', 'p_partkey', count(*) - count(p_partkey) FROM part
        UNION ALL
        SELECT 'unique', 'p_partkey', count(*) FROM (
            SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL
            GROUP BY 1 HAVING count(*) > 1)
    """,
    "valid_ids": """
        SELECT * FROM (
            SELECT 'page' AS kind, page_id AS ref,
                   replace(to_base64(unhex(md5(url))), '=', '') AS candidate
            FROM pages
            UNION ALL
            SELECT 'doc', doc_id, source FROM documents)
        WHERE coalesce(length(candidate) = 22, false)
    """,
    "sql_preview": """
        SELECT to_json(struct_pack(c_mktsegment := c_mktsegment, c_nationkey := c_nationkey))
                   AS record
        FROM (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer WHERE c_acctbal > 0)
        ORDER BY c_nationkey, c_mktsegment LIMIT 10
    """,
    "result_series": """
        SELECT CAST(ts AS DATE) AS day, count(*) AS n_events, round(sum(value), 2) AS total_value
        FROM events GROUP BY 1 ORDER BY 1
    """,
    "chart_envelope": """
        SELECT p_partkey AS id, p_name AS title, CAST(p_size AS BIGINT) AS rank,
               CASE WHEN p_size <= 45 THEN p_brand ELSE 'Unknown' END AS artist
        FROM part
    """,
    "snapshot_union": """
        WITH s AS (
            SELECT CAST(c_custkey AS VARCHAR) AS spotify_artist_id,
                   c_name AS spotify_artist_name,
                   lower(c_mktsegment) AS spotify_artist_genres,
                   'https://open.example/artist/' || CAST(c_custkey AS VARCHAR) AS spotify_artist_url,
                   CAST(c_nationkey AS BIGINT) AS spotify_artist_popularity,
                   CAST(floor(c_acctbal) AS BIGINT) AS spotify_artist_total_followers
            FROM customer WHERE floor(c_acctbal) >= 0),
        d AS (
            SELECT replace(s_name, 'Supplier', 'Customer') AS deezer_artist_name,
                   'https://www.example.com/artist/' || CAST(s_suppkey AS VARCHAR) AS deezer_artist_url,
                   CAST(floor(s_acctbal) AS BIGINT) AS deezer_artist_total_followers
            FROM supplier)
        SELECT s.spotify_artist_id, s.spotify_artist_name, s.spotify_artist_genres,
               s.spotify_artist_url, s.spotify_artist_total_followers,
               s.spotify_artist_popularity, d.deezer_artist_url, d.deezer_artist_name,
               d.deezer_artist_total_followers, DATE '2024-01-31' AS ingestion_date
        FROM s LEFT JOIN d ON s.spotify_artist_name = d.deezer_artist_name
    """,
    "first_choice": """
        SELECT p_partkey, p_name FROM part
        WHERE p_brand = 'Brand#13' AND p_type = 'STANDARD'
        ORDER BY p_partkey LIMIT 1
    """,
    "csv_inferred": """
        SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal
        FROM supplier
    """,
    "profile_text": """
        WITH v AS (
            SELECT 'p_name' AS "column", p_name AS value FROM part
            UNION ALL SELECT 'p_brand', p_brand FROM part
            UNION ALL SELECT 'p_type', p_type FROM part),
        c AS (SELECT "column", value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY 1, 2)
        SELECT "column", sum(n)::BIGINT AS count, count(*)::BIGINT AS unique,
               arg_min(value, (-n, value)) AS top, max(n)::BIGINT AS freq
        FROM c GROUP BY 1
    """,
    "similar_tracks": """
        WITH t AS (
            SELECT l_orderkey * 8 + l_linenumber AS track_id, l_partkey AS row_order,
                   'S' || CAST(l_suppkey AS VARCHAR) AS artist,
                   CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS title,
                   l_quantity, l_extendedprice, l_discount, l_tax
            FROM lineitem),
        d AS (
            SELECT * FROM t
            WHERE track_id IS NOT NULL AND row_order IS NOT NULL AND artist IS NOT NULL
              AND title IS NOT NULL AND l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL
              AND l_discount IS NOT NULL AND l_tax IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY title ORDER BY row_order, track_id, artist,
                    l_quantity, l_extendedprice, l_discount, l_tax) = 1),
        st AS (
            SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1,
                   avg(l_extendedprice) AS m2, stddev_pop(l_extendedprice) AS s2,
                   avg(l_discount) AS m3, stddev_pop(l_discount) AS s3,
                   avg(l_tax) AS m4, stddev_pop(l_tax) AS s4
            FROM d),
        z AS (
            SELECT track_id, artist, title, l_quantity,
                   CAST((l_quantity - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END AS FLOAT) AS z1,
                   CAST((l_extendedprice - m2) / CASE WHEN s2 = 0 THEN 1 ELSE s2 END AS FLOAT) AS z2,
                   CAST((l_discount - m3) / CASE WHEN s3 = 0 THEN 1 ELSE s3 END AS FLOAT) AS z3,
                   CAST((l_tax - m4) / CASE WHEN s4 = 0 THEN 1 ELSE s4 END AS FLOAT) AS z4
            FROM d, st),
        q AS (
            SELECT z1 AS q1, z2 AS q2, z3 AS q3, z4 AS q4 FROM z
            WHERE artist = 'S1' AND title = (SELECT min(title) FROM d WHERE artist = 'S1')),
        dist AS (
            SELECT track_id, artist, title, l_quantity,
                   ((CAST(z1 AS DOUBLE) - q1) * (CAST(z1 AS DOUBLE) - q1)
                         + (CAST(z2 AS DOUBLE) - q2) * (CAST(z2 AS DOUBLE) - q2)
                         + (CAST(z3 AS DOUBLE) - q3) * (CAST(z3 AS DOUBLE) - q3)
                         + (CAST(z4 AS DOUBLE) - q4) * (CAST(z4 AS DOUBLE) - q4)) AS raw
            FROM z, q)
        SELECT row_number() OVER (ORDER BY raw, track_id) AS rank, track_id, artist, title,
               l_quantity, round(raw, 4) AS distance
        FROM dist ORDER BY raw, track_id LIMIT 10
    """,
}

ORACLE_SQL["union_data_tests"] = """
    SELECT 'spotify_artist_id' AS column_name, 'not_null' AS test,
           CASE WHEN count(*) - count(CAST(c_custkey AS VARCHAR)) = 0 THEN 'pass' ELSE 'fail' END
               AS status,
           count(*) - count(CAST(c_custkey AS VARCHAR)) AS failures
    FROM customer LEFT JOIN supplier ON c_name = replace(s_name, 'Supplier', 'Customer')
    UNION ALL SELECT 'artist_name', 'not_null', 'error', NULL
    UNION ALL SELECT 'artist_name', 'unique', 'error', NULL
    UNION ALL SELECT 'deezer_artist_id', 'not_null', 'error', NULL
"""

ORACLE_SQL["browse_bounds"] = """
    WITH g AS (
        SELECT min(l_quantity) FILTER (WHERE l_returnflag = 'R') AS lo1,
               max(l_quantity) FILTER (WHERE l_returnflag = 'R') AS hi1,
               min(l_quantity) AS glo1, max(l_quantity) AS ghi1,
               min(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS lo2,
               max(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS hi2,
               min(l_discount) FILTER (WHERE l_returnflag = 'R') AS lo3,
               max(l_discount) FILTER (WHERE l_returnflag = 'R') AS hi3,
               min(l_tax) FILTER (WHERE l_returnflag = 'R') AS lo4,
               max(l_tax) FILTER (WHERE l_returnflag = 'R') AS hi4
        FROM lineitem)
    SELECT 'l_quantity' AS feature, lo1 AS lo, hi1 AS hi, glo1 AS value_lo, ghi1 AS value_hi FROM g
    UNION ALL SELECT 'l_extendedprice', lo2, hi2, lo2, hi2 FROM g
    UNION ALL SELECT 'l_discount', lo3, hi3, lo3, hi3 FROM g
    UNION ALL SELECT 'l_tax', lo4, hi4, lo4, hi4 FROM g
"""

ORACLE_SQL["sql_genre_filter"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS spotify_artist_id, c_name AS spotify_artist_name,
           'https://www.example.com/artist/' || CAST(s_suppkey AS VARCHAR) AS deezer_artist_url
    FROM customer LEFT JOIN supplier ON c_name = replace(s_name, 'Supplier', 'Customer')
    WHERE lower(lower(c_mktsegment)) = lower('BUILDING')
"""

ORACLE_SQL["sql_genre_counts"] = """
    SELECT lower(c_mktsegment) AS genre, count(*) AS n_artists
    FROM customer LEFT JOIN supplier ON c_name = replace(s_name, 'Supplier', 'Customer')
    GROUP BY 1
"""

ORACLE_SQL["artist_refresh"] = """
    SELECT 'sp' || CAST(i AS VARCHAR) AS spotify_artist_id,
           'artist ' || CAST(i AS VARCHAR) AS spotify_artist_name,
           CASE i % 3 WHEN 0 THEN NULL WHEN 1 THEN 'rock' ELSE 'rock,Pop' END
               AS spotify_artist_genres,
           'https://open.example/artist/sp' || CAST(i AS VARCHAR) AS spotify_artist_url,
           i % 100 AS spotify_artist_popularity,
           CASE WHEN i % 5 = 0 THEN NULL ELSE i * 7 END AS spotify_artist_total_followers
    FROM (SELECT DISTINCT o_orderkey AS i FROM orders)
    WHERE i % 17 <> 0
"""

# The landed forms compute the same rows as their piecewise queries.
ORACLE_SQL["catalogue_load"] = ORACLE_SQL["triple_pivot"]
ORACLE_SQL["enrich_snapshot"] = ORACLE_SQL["enrich_batches"]

ORACLE_SQL["enrich_failures"] = """
    WITH i AS (SELECT DISTINCT o_orderkey AS i FROM orders),
    r AS (SELECT CASE WHEN i % 19 = 0 THEN -1 WHEN i % 7 <> 0 AND i % 11 = 0 THEN 404 ELSE 200 END
                 AS status FROM i)
    SELECT status, count(*) AS n_ids, count(*) AS n_distinct FROM r GROUP BY status
"""

ORACLE_SQL["result_series_text"] = """
    SELECT CASE WHEN day(ts) <> 13 THEN CAST(ts AS DATE) END AS event_date,
           count(DISTINCT user_id) AS users_that_day
    FROM events GROUP BY 1
"""

ORACLE_SQL["dedupe_nulls"] = """
    SELECT * FROM part WHERE p_brand <> 'Brand#13'
    QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1
"""

ORACLE_SQL["genre_nulls"] = """
    SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 0 ELSE count(DISTINCT event_type) END AS n_genres,
           CASE WHEN user_id % 3 = 0 THEN '' ELSE string_agg(DISTINCT
                upper(event_type[1]) || lower(event_type[2:]), ',' ORDER BY
                upper(event_type[1]) || lower(event_type[2:])) END AS genres
    FROM events GROUP BY user_id
"""

ORACLE_SQL["distinct_text_ids"] = """
    SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'F'
"""

ORACLE_SQL["exactly_one_status"] = """
    SELECT c_custkey, CASE count(o_orderkey) WHEN 0 THEN 'none' WHEN 1 THEN 'one' ELSE 'several' END
           AS status
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderkey % 5 = 0
    GROUP BY c_custkey
"""

ORACLE_SQL["genre_scaled"] = """
    WITH x AS (SELECT label, unnest(embedding) AS v, unnest(range(0, len(embedding))) AS pos FROM embeddings),
    m AS (SELECT label, pos, avg(CAST(v AS DOUBLE)) AS m FROM x GROUP BY label, pos),
    s AS (SELECT pos, avg(m) AS a, stddev_pop(m) AS d FROM m GROUP BY pos)
    SELECT label, pos, round((m - a) / CASE WHEN d = 0 THEN 1 ELSE d END, 6) AS z FROM m JOIN s USING (pos)
"""

_MEANS = """
    WITH RECURSIVE m AS (
        SELECT l_suppkey, avg(l_quantity) AS f1, avg(l_extendedprice) AS f2, avg(l_discount) AS f3,
               avg(l_tax) AS f4 FROM lineitem GROUP BY l_suppkey),
    s AS (SELECT avg(f1) AS a1, avg(f2) AS a2, avg(f3) AS a3, avg(f4) AS a4, stddev_pop(f1) AS d1,
                 stddev_pop(f2) AS d2, stddev_pop(f3) AS d3, stddev_pop(f4) AS d4 FROM m),
    z AS (SELECT l_suppkey, (f1 - a1) / d1 AS z1, (f2 - a2) / d2 AS z2, (f3 - a3) / d3 AS z3,
                 (f4 - a4) / d4 AS z4 FROM m, s),
    c AS (SELECT """ + ", ".join(f"avg(z{i} * z{j}) AS c{i}{j}" for i in range(1, 5) for j in range(1, 5)) + """
          FROM z)"""

_NAMES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

ORACLE_SQL["supplier_correlation"] = _MEANS + " UNION ALL ".join(
    f" SELECT '{a}' AS feature, '{b}' AS other, round(c{i}{j}, 6) AS correlation FROM c"
    for i, a in enumerate(_NAMES, 1) for j, b in enumerate(_NAMES, 1))


def _component(n: int, matrix: str) -> str:
    """Power iteration on a 4 x 4 matrix; then the matrix without that component."""
    step = [" + ".join(f"c{i}{j} * v{j}" for j in range(1, 5)) for i in range(1, 5)]
    value = " + ".join(f"v{i} * ({s})" for i, s in enumerate(step, 1))
    big = "greatest(" + ", ".join(f"abs(v{i})" for i in range(1, 5)) + ")"
    sign = "CASE " + " ".join(f"WHEN abs(v{i}) = {big} THEN sign(v{i})" for i in range(1, 5)) + " END"
    return f""",
    p{n}(k, v1, v2, v3, v4) AS (
        SELECT 0, 0.5::DOUBLE, 0.4::DOUBLE, 0.6::DOUBLE, 0.3::DOUBLE
        UNION ALL
        SELECT k + 1, w1 / w, w2 / w, w3 / w, w4 / w FROM (
            SELECT k, w1, w2, w3, w4, sqrt(w1 * w1 + w2 * w2 + w3 * w3 + w4 * w4) AS w FROM (
                SELECT k, {", ".join(f"{s} AS w{i}" for i, s in enumerate(step, 1))}
                FROM p{n}, {matrix} WHERE k < 4000))),
    e{n} AS (SELECT {", ".join(f"{sign} * v{i} AS v{i}" for i in range(1, 5))}, {value} AS val
             FROM p{n}, {matrix} WHERE k = 4000),
    c{n} AS (SELECT {", ".join(f"c{i}{j} - val * v{i} * v{j} AS c{i}{j}"
                               for i in range(1, 5) for j in range(1, 5))} FROM {matrix}, e{n})"""


#: Eigenvectors by power iteration and deflation, signs as in the operator.
ORACLE_SQL["supplier_pca"] = (
    _MEANS + _component(1, "c") + _component(2, "c1") + _component(3, "c2")
    + " SELECT l_suppkey, " + ", ".join(
        "round(" + " + ".join(f"z{i} * e{n}.v{i}" for i in range(1, 5)) + f", 6) AS pc{n}" for n in (1, 2, 3))
    + " FROM z, e1, e2, e3")


def _gram_component(n: int, matrix: str) -> str:
    """Largest eigenvector ``u`` (one entry per label) and value of a list of rows ``g``; then
    the matrix without it."""
    dot = "list_transform(g, lambda r: list_dot_product(r, u))"
    return f""",
    p{n}(k, u) AS (
        SELECT 0, list_transform(range(1, len(g) + 1), lambda i: 1.0::DOUBLE / i) FROM {matrix}
        UNION ALL
        SELECT k + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
        FROM (SELECT k, {dot} AS w FROM p{n}, {matrix} WHERE k < 6000)),
    e{n} AS (SELECT u, list_dot_product(u, {dot}) AS val FROM p{n}, {matrix} WHERE k = 6000),
    g{n} AS (SELECT list_transform(range(1, len(g) + 1), lambda i: list_transform(range(1, len(g) + 1),
                    lambda j: g[i][j] - val * u[i] * u[j])) AS g FROM {matrix}, e{n})"""


#: The labels are few, so the components come from the Gram matrix of the scaled label means: an
#: eigenvector u with value v is the component's scores over sqrt(v), and the loadings
#: are the scaled columns' sums over u / sqrt(v), whose largest entry fixes the sign.
ORACLE_SQL["genre_pca"] = (
    """
    WITH RECURSIVE x AS (
        SELECT label, unnest(embedding) AS v, unnest(range(0, len(embedding))) AS pos FROM embeddings),
    m AS (SELECT label, pos, avg(CAST(v AS DOUBLE)) AS m FROM x GROUP BY label, pos),
    s AS (SELECT pos, avg(m) AS a, stddev_pop(m) AS d FROM m GROUP BY pos),
    z AS (SELECT label, pos, (m - a) / CASE WHEN d = 0 THEN 1 ELSE d END AS z FROM m JOIN s USING (pos)),
    r AS (SELECT label, list(z ORDER BY pos) AS zs, row_number() OVER (ORDER BY label) AS i FROM z GROUP BY label),
    g0 AS (SELECT list(row_ ORDER BY i) AS g FROM (
        SELECT a.i, list(list_dot_product(a.zs, b.zs) ORDER BY b.i) AS row_ FROM r a, r b GROUP BY a.i))"""
    + _gram_component(1, "g0") + _gram_component(2, "g1") + _gram_component(3, "g2")
    + "".join(f""",
    f{n} AS (SELECT sign(arg_max(w, abs(w))) AS f FROM (
        SELECT pos, sum(z * u[i]) AS w FROM z JOIN r USING (label), e{n} GROUP BY pos))""" for n in (1, 2, 3))
    + " SELECT label, " + ", ".join(f"round(f{n}.f * e{n}.u[i] * sqrt(e{n}.val), 6) AS pc{n}" for n in (1, 2, 3))
    + " FROM r, " + ", ".join(f"e{n}, f{n}" for n in (1, 2, 3)))

ORACLE_SQL["expire_partitions"] = """
    SELECT event_id, CAST(ts AS DATE) AS ingestion_date FROM events
    WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL 7 DAY
"""

ORACLE_SQL["day_snapshot"] = """
    SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-20'
"""

ORACLE_SQL["declared_load"] = """
    SELECT 'Q' || c_custkey AS item, c_name AS "itemLabel", CAST(c_custkey AS VARCHAR) AS deezer_artist_id,
           CASE WHEN c_nationkey > 10 THEN CAST(c_nationkey AS VARCHAR) END AS spotify_artist_id,
           CAST(NULL AS VARCHAR) AS youtube_artist_id, CAST(NULL AS VARCHAR) AS artist_official_url
    FROM customer
"""

ORACLE_SQL["catalog_view"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS spotify_artist_id, c_name AS spotify_artist_name,
           'https://www.example.com/artist/' || CAST(s_suppkey AS VARCHAR) AS deezer_artist_url
    FROM customer LEFT JOIN supplier ON c_name = replace(s_name, 'Supplier', 'Customer')
"""

#: One answer per id, whichever run gave it.
ORACLE_SQL["enrich_resumed"] = ORACLE_SQL["enrich_batches"]

#: The view holds what the union query returns.
ORACLE_SQL["published_union"] = ORACLE_SQL["artists_union"]

ORACLE_SQL["refresh_published"] = "SELECT n_nationkey, lower(n_name) AS n_name FROM nation"

ORACLE_SQL["shared_snapshots"] = """
    SELECT event_id, user_id, CAST(ts AS DATE) AS ingestion_date FROM events
    WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL 20 DAY
"""

ORACLE_SQL["unique_rows"] = "SELECT DISTINCT p_brand, p_type FROM part"

ORACLE_SQL["head_rows"] = """
    SELECT p_partkey, p_name FROM part WHERE lower(p_type) = 'standard' ORDER BY p_name, p_partkey LIMIT 20
"""

ORACLE_SQL["flatten_nested"] = "SELECT DISTINCT l_orderkey, l_linenumber AS line FROM lineitem"

ORACLE_SQL["selection_counts"] = """
    SELECT 'small' AS selection, count(*) AS n_rows, count(*) = 0 AS is_empty FROM part WHERE p_size <= 5
    UNION ALL SELECT 'any', count(*), count(*) = 0 FROM part
    UNION ALL SELECT 'none', count(*), count(*) = 0 FROM part WHERE p_size < 0
"""
