"""Time the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from placewise.plans import foldin, rating, recommend, statistics
from placewise.plans.ingest import ingest_bundles
from placewise.plans.features import build_features, rating_features
from placewise.operators import similar
from placewise.operators.indexing import frequency_index
from placewise.operators.lookup import recommendations_for
from placewise.operators.nearest import nearest, nearest_to
from placewise.operators.proximity import nearest_places
from placewise.session import builder, scratch_path
from placewise.sources.tables import overwrite_path, read_path, write_by_key
from placewise.streaming.increments import ingest_new_files, update_tables
from placewise.suite.fixtures import Tables, full_business, write_bundles


def materialize(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (builder("bench").master(f"local[{cpus}]")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
             .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-"))
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    t = Tables(spark, folder)
    stored = {name: scratch_path(spark, f"bench-{name}") for name in ("business", "review", "user", "points")}
    for name, path in stored.items():
        overwrite_path(getattr(t, name).repartition(int(cpus)), path)
    business, review, user, points = [read_path(spark, stored[n]) for n in ("business", "review", "user", "points")]
    arriving = scratch_path(spark, "bench-arriving")
    review.write.json(arriving)

    seconds: dict[str, float] = {}
    results: dict[str, object] = {}

    def timed(name, job):
        started = time.perf_counter()
        results[name] = job()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
        return results[name]

    bundled = write_bundles({"business": full_business(business), "review": review, "user": user}, 4, scratch_path(spark, "bench-zips"))
    spark.range(1000).count()  # the first job pays for the session's start
    spark.sql("CREATE DATABASE IF NOT EXISTS bench_tables LOCATION '" + scratch_path(spark, "bench-db") + "'")
    timed("bundle_ingest", lambda: ingest_bundles(spark, bundled, prefix="bench_tables."))
    timed("incremental_ingest", lambda: ingest_new_files(
        spark, arriving, "review", scratch_path(spark, "bench-taken"), scratch_path(spark, "bench-progress")))
    timed("update_tables", lambda: update_tables(spark, bundled, scratch_path(spark, "bench-versions"), scratch_path(spark, "bench-update"),
                                                 "bench_tables.versioned_"))
    timed("id_index", lambda: materialize(frequency_index(review, "user_id", "userIndex")))
    built = timed("feature_build", lambda: build_features(business, review))
    hashed = read_path(spark, built.business_hashed)
    timed("nearest_one_point", lambda: materialize(nearest_to(hashed, 40.5, -73.9)))
    timed("nearest_one_stored_location", lambda: materialize(nearest_to(read_path(spark, built.locations), 40.5, -73.9, repeated=False)))
    timed("nearest_all_points", lambda: materialize(nearest(hashed, points, 10)))
    timed("nearest_all_points_blocks", lambda: materialize(nearest_places(hashed, points, 10, "planar")))
    timed("nearest_all_points_sphere", lambda: materialize(nearest_places(hashed, points, 10)))

    known = scratch_path(spark, "bench-profiles")
    timed("category_profiles", lambda: overwrite_path(
        similar.profiles(similar.category_sets(business)), known))
    timed("similar_profiles", lambda: materialize(similar.similar_profiles(read_path(spark, known), 0.5)))

    ratings = recommend.rating_rows(read_path(spark, built.review_transformed))
    train, test = recommend.random_split(ratings, seed=42)
    model = timed("als_fit", lambda: recommend.fit_als(train))
    timed("als_implicit_fit", lambda: recommend.fit_implicit(ratings))
    timed("als_score", lambda: materialize(recommend.score(model, test)))
    lists = scratch_path(spark, "bench-lists")
    timed("als_top20_all_users", lambda: write_by_key(recommend.recommend_all(
        model, read_path(spark, built.user_map), read_path(spark, built.business_map)), lists, "user_id"))
    timed("fold_in_all_users", lambda: materialize(foldin.fold_in(model.itemFactors, train, model.rank)))
    timed("list_lookup", lambda: materialize(recommendations_for(read_path(spark, lists), user)))

    rated = scratch_path(spark, "bench-rating-rows")
    timed("rating_rows", lambda: overwrite_path(
        rating_features(business, read_path(spark, built.review_counts).drop("n")), rated))
    rows = read_path(spark, rated)
    linear = timed("linear_fit", lambda: rating.fit_rating_model(rows, "linear"))
    timed("statistics_fit", lambda: statistics.solve(statistics.statistics(rows)))
    timed("trees_fit", lambda: rating.fit_rating_model(rows, "gbt"))
    timed("rank_all", lambda: materialize(rating.rank_businesses(linear, rows, review.where("stars >= 4"))))

    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline jobs, total wall time", "value": total, "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
