"""SQL counterparts of the registered queries, for DuckDB over the driver's tables."""

from __future__ import annotations

from placewise.functions.columns import EARTH_KM
from placewise.operators.weighted import NUMBER_WEIGHT
from placewise.suite import fixtures
from placewise.suite.queries import BATCH_HITS, ID_LIST, POINT, POINT_HITS, SIMILAR_BELOW, USER_ID, WEIGHTED_FROM

_NAMES = {n: n for n in ("part", "lineitem", "orders", "customer", "events")}

# MinHash with seed 42: (multiplier, offset) of each table, drawn from the JVM's seeded
# generator, and the prime of the hash family.
MINHASH_PRIME = 2038074743
MINHASH_42 = [
    (1562431131, 117392763),
    (1467211249, 102948884),
    (662969971, 2023087525),
    (595021506, 1519796918),
    (1429255520, 196118093),
]


def _cte(sql: str) -> str:
    return sql.format(**_NAMES)


BASE = f"""WITH business AS ({_cte(fixtures.BUSINESS_SQL)}),
review AS ({_cte(fixtures.REVIEW_SQL)}),
users AS ({_cte(fixtures.USER_SQL)}),
points AS ({_cte(fixtures.POINT_SQL)}),
runs AS ({_cte(fixtures.RUN_SQL)}),
review_counts AS (
  SELECT business_id, count(*) FILTER (WHERE stars >= 2.5) AS positive_review_count,
         count(*) FILTER (WHERE stars < 2.5) AS negative_review_count
  FROM review GROUP BY 1),
category_rows AS (
  SELECT business_id, unnest(string_split(categories, ', ')) AS category FROM business),
joined AS (
  SELECT b.business_id, b.stars, b.review_count, b.latitude, b.longitude,
         positive_review_count, negative_review_count, category
  FROM business b LEFT JOIN review_counts USING (business_id) LEFT JOIN category_rows USING (business_id)),
category_index AS (
  SELECT category, row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS "categoryIndex"
  FROM category_rows GROUP BY 1),
hashed AS (
  SELECT joined.*, "categoryIndex" FROM joined JOIN category_index USING (category)
  WHERE stars IS NOT NULL AND review_count IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
    AND positive_review_count IS NOT NULL AND negative_review_count IS NOT NULL),
user_index AS (
  SELECT user_id, row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS "userIndex"
  FROM review GROUP BY 1),
business_index AS (
  SELECT business_id, row_number() OVER (ORDER BY count(*) DESC, business_id) - 1 AS "businessIndex"
  FROM review GROUP BY 1),
indexed AS (
  SELECT review.*, "businessIndex", "userIndex"
  FROM review JOIN user_index USING (user_id) JOIN business_index USING (business_id)),
split AS (
  SELECT *, ("businessIndex" * 7919 + "userIndex" * 104729) % 10 < 8 AS train FROM indexed),
best AS (
  SELECT user_id, business_id, CAST(avg_stars AS DOUBLE) AS rating, rk FROM (
    SELECT user_id, business_id, avg(stars) AS avg_stars,
           row_number() OVER (PARTITION BY user_id ORDER BY avg(stars) DESC, business_id) AS rk
    FROM review GROUP BY user_id, business_id) t
  WHERE rk <= 5),
scored AS (
  SELECT r.business_id, r.stars AS label, m.prediction
  FROM review r JOIN (SELECT business_id, avg(stars) AS prediction FROM review GROUP BY 1) m USING (business_id)),
slots AS (
  SELECT business_id, category, unnest([0, 1, 2, 3, 4, 5, 6 + "categoryIndex"]) AS slot,
         unnest([stars, CAST(review_count AS DOUBLE), latitude, longitude,
                 CAST(positive_review_count AS DOUBLE), CAST(negative_review_count AS DOUBLE),
                 CASE WHEN "categoryIndex" = (SELECT max("categoryIndex") FROM category_index)
                      THEN 0.0 ELSE 1.0 END]) AS value
  FROM hashed),
sets AS (
  SELECT business_id, list_sort(list_distinct(list("categoryIndex"))) AS set
  FROM category_rows JOIN category_index USING (category) GROUP BY 1),
profiles AS (SELECT set, min(business_id) AS profile FROM sets GROUP BY 1),
pairs AS (
  SELECT a.profile AS profile_a, b.profile AS profile_b, a.set AS set_a, b.set AS set_b,
         1 - len(list_intersect(a.set, b.set))
             / CAST(len(a.set) + len(b.set) - len(list_intersect(a.set, b.set)) AS DOUBLE) AS distance
  FROM profiles a JOIN profiles b ON a.profile < b.profile),
vectors AS (
  SELECT business_id, list_sort(list((input, weight))) AS vector FROM (
    SELECT business_id, unnest(['#stars', '#latitude', '#longitude', '#review_count', '#positive_review_count', '#negative_review_count']) AS input,
           unnest([stars / 5, (latitude + 90) / 180, (longitude + 180) / 360, log2(review_count + 1.0) / 16,
                   log2(positive_review_count + 1.0) / 16, log2(negative_review_count + 1.0) / 16]) * {NUMBER_WEIGHT!r} AS weight
    FROM business LEFT JOIN review_counts USING (business_id)
    UNION ALL SELECT DISTINCT business_id, category, 1.0 FROM category_rows WHERE category IS NOT NULL) t
  WHERE weight > 0 GROUP BY business_id),
weighed AS (
  SELECT min(business_id) AS profile, vector, list_sum(list_transform(vector, lambda x: x[2])) AS total FROM vectors GROUP BY vector),
inputs AS (
  SELECT profile, x[1] AS input, x[2] AS weight FROM (SELECT profile, unnest(vector) AS x FROM weighed)),
complete AS (
  SELECT b.business_id, b.stars AS label, CAST(substr(b.business_id, 2) AS BIGINT) * 7919 % 10 < 8 AS train
  FROM business b JOIN review_counts USING (business_id)
  WHERE b.categories IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL)
"""

_DISTANCE = "sqrt(({lat} - {to_lat}) * ({lat} - {to_lat}) + ({lon} - {to_lon}) * ({lon} - {to_lon}))"
_TO_POINT = _DISTANCE.format(lat="latitude", lon="longitude", to_lat=f"CAST({POINT[0]} AS DOUBLE)",
                             to_lon=f"CAST({POINT[1]} AS DOUBLE)")
_PAIR = _DISTANCE.format(lat="h.latitude", lon="h.longitude", to_lat="p.latitude", to_lon="p.longitude")


def _arc(lat, lon, to_lat, to_lon) -> str:
    """Great-circle kilometres in SQL."""
    half = "sin(radians(CAST({b} AS DOUBLE) - {a}) / 2)"
    up, across = half.format(a=lat, b=to_lat), half.format(a=lon, b=to_lon)
    part = f"{up} * {up} + cos(radians({lat})) * cos(radians(CAST({to_lat} AS DOUBLE))) * {across} * {across}"
    return f"asin(sqrt(CASE WHEN {part} > 1 THEN 1 ELSE {part} END)) * {2 * EARTH_KM}"


_NUMBER = "CAST(substr(business_id, 2) AS BIGINT)"
_IDS = ", ".join(f"'{i}'" for i in ID_LIST)


def _minhash(slot: str, table: int) -> str:
    a, b = MINHASH_42[table]
    return f"((1 + CAST({slot} AS BIGINT)) * {a} + {b}) % {MINHASH_PRIME}"


def _set_mark(column: str, table: int) -> str:
    return f"list_min(list_transform({column}, lambda x: {_minhash('x', table)}))"


_FULL = f"""SELECT concat(city, ' street') AS address, business_id, categories, city,
  concat('{{"Monday":"', CAST({_NUMBER} % 12 AS STRING), ':0-20:0"}}') AS hours, is_open, latitude, longitude,
  name, concat('P', CAST({_NUMBER} % 100 AS STRING)) AS postal_code, review_count, stars, state,
  CASE WHEN {_NUMBER} % 2 = 0 THEN 'True' ELSE 'False' END AS by_appointment FROM business"""

_ASKED = "(SELECT user_id FROM users UNION ALL SELECT concat('x', user_id) FROM users)"
_IN_TRAIN = """test AS (SELECT * FROM split WHERE NOT train
  AND user_id IN (SELECT user_id FROM split WHERE train)
  AND business_id IN (SELECT business_id FROM split WHERE train)),
trained_users AS (SELECT DISTINCT user_id FROM split WHERE train),
list_length AS (SELECT least(20, count(DISTINCT business_id)) AS n FROM split WHERE train)"""

_SELECTS = {
    "scan_json_explicit": _FULL,
    "scan_json_inferred": "SELECT * FROM review",
    "scan_json_quarantine": f"""
        SELECT CASE WHEN {_NUMBER} % 50 = 3 OR {_NUMBER} % 41 = 5 THEN NULL ELSE business_id END AS business_id,
               CASE WHEN {_NUMBER} % 50 = 3 THEN NULL ELSE name END AS name,
               CASE WHEN {_NUMBER} % 50 = 3 THEN NULL ELSE stars END AS stars,
               CASE WHEN {_NUMBER} % 50 = 3 THEN concat('not json ', business_id) END AS bad_line
        FROM business""",
    "scan_json_view": "SELECT * FROM users",
    "scan_catalog_table": "SELECT * FROM review",
    "scan_parquet_path": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "scan_zip_bundle": f"SELECT business_id, name, categories, hours, stars, review_count, latitude FROM ({_FULL})",
    "latest_run": "SELECT experiment, arg_max(run_id, (start_time, run_id)) AS run_id FROM runs GROUP BY 1",

    "sink_overwrite_table": "SELECT * FROM business",
    "sink_append_table": f"""
        SELECT * REPLACE (CASE WHEN {_NUMBER} % 2 = 0 THEN city END AS city,
                          CASE WHEN {_NUMBER} % 2 = 0 THEN stars END AS stars) FROM business""",
    "sink_overwrite_path": "SELECT * FROM review",
    "sink_external_table": "SELECT * FROM users",
    "sink_sorted_by_key": "SELECT * FROM business WHERE business_id = 'b33'",
    "sink_bucketed": """
        SELECT user_id, fans, n, r.stars, business_ids FROM users
        LEFT JOIN (SELECT user_id, count(*) AS n, sum(stars) AS stars FROM indexed GROUP BY 1) r USING (user_id)
        LEFT JOIN (SELECT user_id, string_agg(business_id, ',' ORDER BY rk) AS business_ids FROM best GROUP BY 1) USING (user_id)""",
    "sink_metric": """
        SELECT 'stand-in' AS experiment, run_id, 'rmse' AS metric, round(value, 6) AS value, run_id = 'run2' AS latest
        FROM (SELECT 'run1' AS run_id, sqrt(avg((label - prediction) * (label - prediction))) AS value FROM scored
              UNION ALL
              SELECT 'run2', sqrt(avg((label - prediction) * (label - prediction))) FROM scored WHERE label >= 2.5)""",
    "sink_model": "SELECT count(*) AS n, count(*) AS same FROM complete",

    "user_features": "SELECT user_id, average_stars, review_count, fans, elite FROM users",
    "business_numerics": "SELECT business_id, stars, review_count, latitude, longitude FROM business",
    "filter_id_list": f"SELECT business_id, name, stars FROM business WHERE business_id IN ({_IDS})",
    "filter_id_table": """
        SELECT business_id, name, stars FROM business
        WHERE business_id IN (SELECT business_id FROM review WHERE stars >= 5)""",
    "lookup_user": f"SELECT * FROM users WHERE user_id = '{USER_ID}'",
    "lookup_user_reviews": f"SELECT * FROM review WHERE user_id = '{USER_ID}'",
    "label_projection": f"""
        SELECT business_id, CASE WHEN {_NUMBER} % 10 = 0 THEN NULL ELSE stars END AS label FROM business""",
    "distance_column": f"SELECT business_id, round({_TO_POINT}, 6) AS distance FROM business",
    "distance_haversine": f"""
        SELECT business_id, round({_arc('latitude', 'longitude', POINT[0], POINT[1])}, 3) AS distance,
               round({_arc('latitude', 'longitude', '-latitude', 180)}, 3) AS across FROM business""",
    "skip_unlabelled": 'SELECT business_id, category, "categoryIndex" FROM joined JOIN category_index USING (category)',
    "skip_incomplete": 'SELECT * EXCLUDE ("categoryIndex") FROM hashed',
    "portable_split": "SELECT user_id, business_id, stars, train FROM split",
    "random_split": """
        SELECT business_id, count(*) AS n, sum(stars) AS stars, true AS about_80_percent FROM review GROUP BY 1""",
    "bernoulli_sample": "SELECT CAST(0 AS BIGINT) AS wrong, true AS likely_size",
    "als_implicit": """
        SELECT user_id, (SELECT least(5, count(DISTINCT business_id)) FROM review) AS listed, true AS nonnegative
        FROM review GROUP BY user_id""",
    "train_als_random": "SELECT true AS beats_spread, true AS scored, count(*) AS split_rows FROM review",
    "rating_predictions": "SELECT business_id, label, true AS finite FROM complete",
    "rank_given_businesses": """
        SELECT business_id, true AS gap_free, true AS best_first FROM complete
        WHERE business_id IN (SELECT business_id FROM review WHERE stars >= 5)""",
    "distinct_reviews": "SELECT DISTINCT * FROM review",
    "recommended_ids": """
        SELECT user_id, string_agg(business_id, ',' ORDER BY rk) AS business_ids FROM best GROUP BY 1""",

    "join_review_counts": """
        SELECT business_id, stars, review_count, latitude, longitude, positive_review_count, negative_review_count
        FROM business LEFT JOIN review_counts USING (business_id)""",
    "join_categories": "SELECT * FROM joined",
    "join_recommendation_names": """
        SELECT user_id, rk AS rank, business_id, round(CAST(CAST(rating AS FLOAT) AS DOUBLE), 4) AS rating FROM best""",
    "resolve_recommendations": """
        SELECT user_id, "userIndex",
               string_agg(concat(CAST("businessIndex" AS STRING), ':', business_id), ',' ORDER BY rk) AS entries
        FROM best JOIN user_index USING (user_id) JOIN business_index USING (business_id) GROUP BY 1, 2""",
    "ids_of_indexes": "SELECT DISTINCT business_id FROM best WHERE rk = 1",
    "similar_exact": f"""
        SELECT profile_a, profile_b, round(distance, 6) AS distance FROM pairs WHERE distance < {SIMILAR_BELOW}""",
    "similar_members": "SELECT business_id, profile FROM sets JOIN profiles USING (set)",
    "similar_minhash": f"""
        SELECT profile_a, profile_b, round(distance, 6) AS distance FROM pairs
        WHERE distance < {SIMILAR_BELOW} AND ({" OR ".join(
            f"{_set_mark('set_a', i)} = {_set_mark('set_b', i)}" for i in range(5))})""",

    "similar_weighted": f"""
        SELECT profile_a, profile_b, round(similarity, 6) AS similarity FROM (
          SELECT a.profile AS profile_a, b.profile AS profile_b,
                 round(least_sum / (a.total + b.total - least_sum), 9) AS similarity
          FROM (SELECT a, b, sum(least(x.weight, y.weight)) AS least_sum FROM (
                  SELECT x.profile AS a, y.profile AS b, x, y FROM inputs x JOIN inputs y ON x.input = y.input AND x.profile < y.profile)
                GROUP BY a, b) p
          JOIN weighed a ON a.profile = p.a JOIN weighed b ON b.profile = p.b)
        WHERE similarity >= {WEIGHTED_FROM}""",

    "review_counts": "SELECT * FROM review_counts",
    "distinct_locations": "SELECT DISTINCT business_id, latitude, longitude FROM hashed",
    "category_ranking": 'SELECT category, "categoryIndex" FROM category_index',
    "rmse_fixed": """
        SELECT count(*) AS n, round(sqrt(avg((label - prediction) * (label - prediction))), 6) AS rmse FROM scored""",
    "prediction_summary": " UNION ALL ".join(f"""
        SELECT '{c}' AS "column", CAST(count({c}) AS DOUBLE) AS count, round(avg({c}), 6) AS mean,
               round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min, round(max({c}), 6) AS max
        FROM scored""" for c in ("label", "prediction")),
    "row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS entity, count(*) AS n FROM {table}"
        for name, table in (("business", "business"), ("review", "review"), ("user", "users"))),

    "nearest_to_point": f"""
        SELECT business_id, round(distance, 6) AS distance
        FROM (SELECT DISTINCT business_id, {_TO_POINT} AS distance FROM hashed)
        ORDER BY distance, business_id LIMIT {POINT_HITS}""",
    "nearest_to_stored_location": f"""
        SELECT business_id, round(distance, 6) AS distance
        FROM (SELECT DISTINCT business_id, {_TO_POINT} AS distance FROM hashed)
        ORDER BY distance, business_id LIMIT {POINT_HITS}""",
    "nearest_to_points": f"""
        SELECT point_id, business_id, round(distance, 6) AS distance, rank FROM (
          SELECT point_id, business_id, distance,
                 row_number() OVER (PARTITION BY point_id ORDER BY distance, business_id) AS rank
          FROM (SELECT p.point_id, h.business_id, {_PAIR} AS distance
                FROM points p CROSS JOIN (SELECT DISTINCT business_id, latitude, longitude FROM hashed) h))
        WHERE rank <= {BATCH_HITS}""",
    "nearest_planar_blocks": f"""
        SELECT point_id, business_id, round(distance, 6) AS distance, rank FROM (
          SELECT point_id, business_id, distance,
                 row_number() OVER (PARTITION BY point_id ORDER BY distance, business_id) AS rank
          FROM (SELECT p.point_id, h.business_id, {_PAIR} AS distance
                FROM points p CROSS JOIN (SELECT DISTINCT business_id, latitude, longitude FROM hashed) h))
        WHERE rank <= {BATCH_HITS}""",
    "nearest_haversine": f"""
        SELECT point_id, business_id, round(distance, 3) AS distance, rank FROM (
          SELECT point_id, business_id, distance,
                 row_number() OVER (PARTITION BY point_id ORDER BY round(distance, 6), business_id) AS rank
          FROM (SELECT p.point_id, h.business_id, {_arc('h.latitude', 'h.longitude', 'p.latitude', 'p.longitude')} AS distance
                FROM (SELECT * FROM points
                      UNION ALL SELECT concat('e', point_id), latitude,
                                       CASE WHEN CAST(substr(point_id, 2) AS BIGINT) % 2 = 0 THEN 180.0 ELSE -180.0 END FROM points
                      UNION ALL SELECT concat('p', point_id), CASE WHEN CAST(substr(point_id, 2) AS BIGINT) % 2 = 0 THEN 90.0 ELSE -90.0 END,
                                       longitude FROM points) p
                CROSS JOIN (SELECT DISTINCT business_id, latitude, longitude FROM hashed) h))
        WHERE rank <= {BATCH_HITS}""",
    "top_items_exact": f"""
        SELECT "user", rank, item, score FROM (
          SELECT "user", item, score, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank
          FROM (SELECT CAST(substr(user_id, 2) AS BIGINT) AS "user", {_NUMBER} AS item,
                       (fans - 2) * stars * 2 + (u.review_count % 10) * (b.review_count % 13 - 6) + length(elite) * is_open * 3 AS score
                FROM users u CROSS JOIN business b))
        WHERE rank <= {BATCH_HITS}""",
    "rank_fixed_scores": """
        SELECT business_id, prediction, row_number() OVER (ORDER BY prediction DESC, business_id) AS rank
        FROM (SELECT business_id, round(avg(stars), 6) AS prediction FROM review GROUP BY 1)""",

    "category_rows": "SELECT * FROM category_rows",
    "category_rows_trimmed": "SELECT * FROM category_rows",
    "feature_slots": "SELECT business_id, category, slot, value FROM slots WHERE value <> 0",
    "category_slots": "SELECT business_id, category, slot - 6 AS slot, value FROM slots WHERE slot >= 6 AND value <> 0",
    "rating_feature_slots": """
        SELECT business_id, slot - 1 AS slot, value FROM slots WHERE slot BETWEEN 1 AND 5 AND value <> 0
        UNION
        SELECT business_id, 5 + "categoryIndex", 1.0 FROM hashed""",

    "indexed_reviews": "SELECT * FROM indexed",
    "growing_index": """
        SELECT business_id, CAST(row_number() OVER (ORDER BY good IS NULL, good DESC, CASE WHEN good IS NULL THEN n END DESC, business_id) - 1 AS BIGINT) AS "businessIndex"
        FROM (SELECT business_id, count(*) AS n FROM review GROUP BY 1)
        LEFT JOIN (SELECT business_id, count(*) AS good FROM review WHERE stars >= 5 GROUP BY 1) USING (business_id)""",
    "user_index_map": 'SELECT user_id, "userIndex" FROM user_index',
    "business_index_map": 'SELECT business_id, "businessIndex" FROM business_index',
    "minhash_signatures": f"""
        SELECT business_id, category, {", ".join(f"min({_minhash('slot', i)}) AS h{i}" for i in range(5))}
        FROM slots WHERE value <> 0 GROUP BY 1, 2""",

    "bootstrap_ingest": """
        SELECT business_id AS id, stars AS value FROM business
        UNION ALL SELECT user_id, average_stars FROM users
        UNION ALL SELECT concat('r', business_id), sum(stars) FROM review GROUP BY 1""",
    "append_bundles": """
        SELECT business_id, 2 * count(*) AS n, 2 * sum(stars) AS stars FROM review GROUP BY 1""",
    "update_job": f"""
        SELECT business_id AS id, CAST(1 AS BIGINT) AS n, stars + CASE WHEN {_NUMBER} % 4 = 0 THEN 20 WHEN {_NUMBER} % 2 = 0 THEN 10 ELSE 0 END AS value
        FROM business WHERE {_NUMBER} % 3 <> 0 OR {_NUMBER} % 2 = 0
        UNION ALL SELECT user_id, 1, CAST(fans + CASE WHEN k % 11 = 0 THEN 30 WHEN k % 3 = 0 THEN 20 WHEN k % 2 = 0 THEN 10 ELSE 0 END AS DOUBLE)
        FROM (SELECT *, CAST(substr(user_id, 2) AS BIGINT) AS k FROM users)
        UNION ALL SELECT concat('r', user_id), CAST(sum(times) AS BIGINT), sum(times * stars)
        FROM (SELECT *, 1 + CASE WHEN CAST(substr(user_id, 2) AS BIGINT) % 5 = 0 THEN 1 ELSE 0 END
                          + CASE WHEN CAST(substr(user_id, 2) AS BIGINT) % 7 = 0 THEN 1 ELSE 0 END AS times FROM review) GROUP BY user_id""",
    "stored_rejects": f"""
        SELECT bad_line, name, count(*) AS n FROM (
          SELECT CASE WHEN {_NUMBER} % 5 = 0 THEN concat('broken ', business_id) END AS bad_line,
                 CASE WHEN {_NUMBER} % 5 <> 0 THEN name END AS name FROM business WHERE {_NUMBER} % 5 = 0 OR {_NUMBER} % 7 = 0
          UNION ALL SELECT NULL, name FROM business WHERE {_NUMBER} % 6 = 0) GROUP BY 1, 2""",
    "stored_extras": """
        SELECT user_id, concat(user_id, ' on ', business_id) AS text, 2 * count(*) AS n FROM review WHERE stars >= 4 GROUP BY 1, 2""",
    "latest_ratings": """
        SELECT "userIndex", "businessIndex", stars, round(mean, 6) AS mean FROM (
          SELECT CAST(o_custkey AS BIGINT) AS "userIndex", CAST(l_partkey AS BIGINT) AS "businessIndex",
                 arg_max(CAST(l_quantity AS DOUBLE), (CAST(o_orderdate AS VARCHAR), CAST(l_quantity AS DOUBLE))) AS stars,
                 avg(CAST(l_quantity AS DOUBLE)) AS mean
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)""",
    "incremental_files": """
        SELECT * REPLACE (CASE WHEN CAST(substr(user_id, 2) AS BIGINT) % 3 = 0
                               THEN average_stars + 1 ELSE average_stars END AS average_stars) FROM users""",
    "incremental_bundles": "SELECT user_id, count(*) AS n, sum(stars) AS stars FROM review GROUP BY 1",
    "table_with_increments": """
        SELECT * REPLACE (fans + CASE WHEN CAST(substr(user_id, 2) AS BIGINT) % 3 = 0 THEN 1 ELSE 0 END AS fans)
        FROM users""",
    "feature_build": "SELECT * FROM hashed",
    "business_details": "SELECT * FROM business WHERE business_id IN (SELECT business_id FROM best)",
    "list_lookup": f"""
        SELECT user_id, coalesce(business_ids, '') AS business_ids FROM {_ASKED} LEFT JOIN
        (SELECT user_id, string_agg(business_id, ',' ORDER BY rk) AS business_ids FROM best GROUP BY 1) USING (user_id)""",
    "rating_trees": """
        SELECT count(*) AS scored, true AS within_spread, true AS no_leak FROM complete WHERE NOT train""",
    "rating_linear": """
        SELECT count(*) AS scored, true AS within_spread, true AS no_leak FROM complete WHERE NOT train""",
    "rating_refit_statistics": """
        SELECT business_id, label, true AS same, (SELECT count(*) FROM complete) AS n FROM complete""",
    "rating_refit": "SELECT count(*) AS scored, true AS beats_spread FROM complete",
}

# Models have no SQL counterpart; these check what must hold whatever the factors are.
_TRAINED = {
    "als_holdout": "SELECT count(*) AS scored, true AS beats_spread, true AS nonnegative FROM test",
    "als_predictions": 'SELECT "userIndex", "businessIndex", stars, true AS finite FROM test',
    "als_recommendations": """
        SELECT user_id, unnest(range(1, n + 1)) AS rank FROM trained_users CROSS JOIN list_length""",
    "als_recommendation_lists": """
        SELECT user_id, n AS listed, true AS best_first, n AS different FROM trained_users CROSS JOIN list_length""",
    "als_lookup": f"""
        SELECT a.user_id, CASE WHEN t.user_id IS NULL THEN 0 ELSE n END AS listed
        FROM {_ASKED} a CROSS JOIN list_length LEFT JOIN trained_users t USING (user_id)""",
    "als_fold_in": """
        SELECT user_id, true AS same_factors, CAST(5 AS BIGINT) AS listed FROM trained_users""",
    "als_user_subset": """
        SELECT user_id, CAST(5 AS BIGINT) AS listed FROM trained_users JOIN users USING (user_id) WHERE elite = 'BUILDING'""",
}

ORACLE: dict[str, str] = {
    **{name: BASE + select for name, select in _SELECTS.items()},
    **{name: f"{BASE}, {_IN_TRAIN}\n{select}" for name, select in _TRAINED.items()},
}
