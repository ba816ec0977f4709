import json
import os
import zipfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from placewise.plans.ingest import ingest, ingest_bundles, quarantine
from placewise.sources import bundles, json_lines, tables
from placewise.streaming import increments
from placewise.suite import fixtures
from placewise.suite.queries import QUERIES

BUSINESS = {"business_id": "b1", "name": "One", "categories": "A, B", "stars": 4.5,
            "hours": {"Monday": "9:0-17:0"}, "attributes": {"ByAppointmentOnly": "True", "Other": "x"}}


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n")
    return str(path)


def write_zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, lines in members.items():
            archive.writestr(name, "\n".join(json.dumps(x) if isinstance(x, dict) else x for x in lines))


def test_bad_lines_and_missing_keys_are_quarantined(spark, tmp_path):
    path = write_lines(tmp_path / "business.json", [BUSINESS, "not json", {"name": "no id"}])
    scanned = json_lines.scan_entity(spark, path, "business")
    kept = json_lines.accepted(scanned, "business").collect()
    assert [(r.business_id, r.hours, r.attributes) for r in kept] == [
        ("b1", '{"Monday": "9:0-17:0"}', Row(ByAppointmentOnly="True"))]
    out = json_lines.rejected(scanned, "business").collect()
    assert sorted((r.name or "", r[json_lines.BAD_LINE] or "") for r in out) == [("", "not json"), ("no id", "")]


def test_inferred_schema_keeps_every_column(spark, tmp_path):
    path = write_lines(tmp_path / "review.json", [{"user_id": "u", "business_id": "b", "stars": 3.0, "text": "hi"}])
    df = json_lines.read_entity(spark, path, "review", infer=True)
    assert sorted(df.columns) == ["business_id", "stars", "text", "user_id"]
    path = write_lines(tmp_path / "mixed" / "user.json", [{"user_id": "u1"}, {"fans": 2}, "junk"])
    assert json_lines.read_entity(spark, path, "user", infer=True).select("user_id").collect() == [("u1",)]


def test_bootstrap_keeps_one_record_per_key(spark, tmp_path):
    path = write_lines(tmp_path / "business.json", [BUSINESS, BUSINESS, {**BUSINESS, "business_id": "b2"}])
    spark.sql("CREATE DATABASE IF NOT EXISTS boot")
    names = ingest(spark, {"business": path}, prefix="boot.")
    assert sorted(r.business_id for r in spark.table(names["business"]).collect()) == ["b1", "b2"]
    with pytest.raises(ValueError):
        ingest(spark, {"business": path}, mode="merge", prefix="boot.")


def test_append_aligns_columns_and_refuses_unknown_ones(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS appended")
    first = spark.createDataFrame([("u1", "b1", 4.0)], "user_id string, business_id string, stars double")
    tables.overwrite_table(first, "appended.review")
    tables.append_table(spark.createDataFrame([("b2", "u2")], "business_id string, user_id string"), "appended.review")
    got = spark.table("appended.review").orderBy("user_id").collect()
    assert [tuple(r) for r in got] == [("u1", "b1", 4.0), ("u2", "b2", None)]
    with pytest.raises(ValueError, match="text"):
        tables.append_table(first.withColumn("text", F.lit("x")), "appended.review")


def test_bundle_members_stream_line_by_line(spark, tmp_path):
    folder = tmp_path / "zips"
    users = [{"user_id": f"u{i}", "fans": i} for i in range(20000)]
    write_zip(folder / "1.zip", {"business.json": [BUSINESS, "broken"], "user.json": users,
                                 "review.json": [{"user_id": "u1", "business_id": "b1", "stars": 2}]})
    write_zip(folder / "2.zip", {"business.json": [{**BUSINESS, "business_id": "b2"}]})
    assert bundles.read_bundle(spark, f"{folder}/*.zip", "user").agg(F.sum("fans")).first()[0] == sum(range(20000))
    assert bundles.read_bundle(spark, f"{folder}/*.zip", "user", spread=3).count() == 20000
    got = bundles.read_bundle(spark, str(folder), "business").collect()
    assert sorted(r.business_id for r in got) == ["b1", "b2"]
    scan = bundles.scan_member(bundles.list_bundles(spark, str(folder)), "business")
    assert json_lines.rejected(scan, "business").first()[json_lines.BAD_LINE] == "broken"


def test_lines_of_bundles_carry_the_archives_time_without_a_join(spark, tmp_path):
    for i in range(2):
        write_zip(tmp_path / f"{i}.zip", {"user.json": [{"user_id": f"u{i}"}, "junk"]})
        os.utime(tmp_path / f"{i}.zip", ns=(0, (1_700_000_000 + i) * 10**9 + 123_456_000))
    listed = bundles.list_bundles(spark, str(tmp_path))
    records = increments._bundle_records(listed, "user", extras=True)
    # As a join the records, which look as small as the list of archives, would be broadcast through the driver.
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan
    times = {r.path.rpartition("/")[2]: r.modificationTime for r in listed.collect()}
    got = [(r[json_lines.PATH].rpartition("/")[2], r[json_lines.LINE], r.user_id, r[json_lines.MODIFIED]) for r in records.collect()]
    assert sorted(got, key=str) == sorted([(f"{i}.zip", n, f"u{i}" if n == 0 else None, times[f"{i}.zip"])
                                           for i in range(2) for n in range(2)], key=str)


def test_more_rows_are_more_archives(spark, tables, tmp_path, monkeypatch):
    """No task sorts, packs or reads more rows than an archive is meant to hold, with the same rows in the end."""
    monkeypatch.setattr(fixtures, "ROWS_PER_BUNDLE", 700)
    entities = {"review": tables.review, "user": tables.user}
    n = sum(df.count() for df in entities.values())
    pattern = fixtures.write_bundles(entities, 2, str(tmp_path / "zips"))
    assert len(list((tmp_path / "zips").glob("*.zip"))) == -(-n // 700) > 2
    for entity, df in entities.items():
        got = bundles.read_bundle(spark, pattern, entity).select(*df.columns)
        assert got.count() == df.count() and got.exceptAll(df).count() == 0
    fixtures.write_bundles({"user": tables.user}, 3, str(tmp_path / "few"))
    assert len(list((tmp_path / "few").glob("*.zip"))) == 3


def test_bundles_append_to_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS zipped")
    write_zip(tmp_path / "z" / "1.zip", {"business.json": [BUSINESS], "user.json": [{"user_id": "u1"}],
                                         "review.json": [{"user_id": "u1", "business_id": "b1", "stars": 2}]})
    for _ in range(2):
        names = ingest_bundles(spark, f"{tmp_path}/z/*.zip", prefix="zipped.")
    assert {e: spark.table(n).count() for e, n in names.items()} == {"business": 1, "review": 2, "user": 1}


def test_new_files_are_taken_once_and_last_record_wins(spark, tmp_path):
    source, target, done = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "done")

    def run():
        increments.ingest_new_files(spark, str(source), "user", target, done)

    write_lines(source / "1.json", [{"user_id": f"u{i}", "fans": i} for i in range(20)] + ["junk", {"fans": 1}])
    run(), run()
    assert increments.all_records(spark, target).count() == 20
    write_lines(source / "2.json", [{"user_id": "u3", "fans": 99}, {"user_id": "new", "fans": 7}])
    run(), run()
    assert increments.all_records(spark, target).count() == 22
    current = {r.user_id: r.fans for r in increments.current_records(spark, target, "user_id").collect()}
    assert len(current) == 21 and current["u3"] == 99 and current["new"] == 7


def test_new_bundles_are_taken_once(spark, tmp_path):
    source, target, done = tmp_path / "zips", str(tmp_path / "out"), str(tmp_path / "done")
    for i in range(3):
        write_zip(source / f"{i}.zip", {"review.json": [{"user_id": f"u{i}", "business_id": "b", "stars": 1}]})
        for _ in range(2):
            increments.ingest_new_bundles(spark, str(source), target, done)
    assert increments.all_records(spark, f"{target}/review").count() == 3
    assert increments.all_records(spark, f"{target}/user").count() == 0
    base = spark.createDataFrame([("u0", "b", 5.0)], "user_id string, business_id string, stars double")
    both = increments.with_increments(base, f"{target}/review").groupBy("user_id").count().collect()
    assert {r.user_id: r["count"] for r in both} == {"u0": 2, "u1": 1, "u2": 1}


def test_reviews_without_user_are_kept(spark, tmp_path):
    path = write_lines(tmp_path / "review.json", [{"business_id": "b1", "stars": 5}, "junk"])
    assert json_lines.read_entity(spark, path, "review").collect() == [(None, "b1", 5.0)]


def test_json_view(spark, tmp_path):
    json_lines.create_json_view(spark, "json_users", write_lines(tmp_path / "u.json", [{"user_id": "u1", "fans": 2}]))
    assert spark.sql("SELECT user_id, fans FROM json_users").collect() == [("u1", 2)]


def test_rejected_records_and_all_columns_are_stored(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS wide")
    path = write_lines(tmp_path / "r" / "review.json", [{"user_id": "u", "business_id": "b", "stars": 3.0, "text": "hi", "date": "2020-01-01"}, "junk"])
    names = ingest(spark, {"review": path}, prefix="wide.", infer=True)
    assert sorted(spark.table(names["review"]).columns) == ["business_id", "date", "stars", "text", "user_id"]
    assert spark.table(names["review"]).count() == 1
    [(source, line)] = quarantine(spark, names["review"]).collect()
    assert line == "junk" and source.endswith("review.json")


def test_newer_file_wins_even_if_smaller(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    old = write_lines(source / "z.json", [{"user_id": "u", "fans": 99}])
    write_lines(source / "a.json", [{"user_id": "u", "fans": 5}, {"user_id": "v", "fans": 9}, {"user_id": "v", "fans": 1}, {"fans": 3}])
    os.utime(old, (1_600_000_000, 1_600_000_000))
    increments.ingest_new_files(spark, str(source), "user", target, str(tmp_path / "done"))
    current = {r.user_id: r.fans for r in increments.current_records(spark, target, "user_id").collect()}
    assert current == {"u": 5, "v": 1}
    assert [r.fans for r in increments.rejected_records(spark, target).collect()] == [3]


def test_append_replaces_stored_keys(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS merged")
    first = write_lines(tmp_path / "1" / "business.json", [BUSINESS, {**BUSINESS, "business_id": "b2"}])
    second = write_lines(tmp_path / "2" / "business.json", [{**BUSINESS, "stars": 1.0}, {**BUSINESS, "business_id": "b3"}])
    ingest(spark, {"business": first}, prefix="merged.")
    names = ingest(spark, {"business": second}, mode="append", prefix="merged.")
    assert {r.business_id: r.stars for r in spark.table(names["business"]).collect()} == {"b1": 1.0, "b2": 4.5, "b3": 4.5}


def test_hostile_bundles_are_quarantined_and_the_stream_goes_on(spark, tmp_path):
    folder, target = tmp_path / "zips", str(tmp_path / "out")
    write_zip(folder / "1.zip", {"user.json": [{"user_id": "u1", "fans": 1, "extra": "kept"}]})
    with zipfile.ZipFile(folder / "2.zip", "w") as archive:
        archive.writestr("user.json", b'{"user_id": "u2", "elite": "\xff"}\nbr\xffken\n')
    (folder / "3.zip").write_bytes((folder / "1.zip").read_bytes()[:40])
    increments.ingest_new_bundles(spark, f"{folder}/*.zip", target, str(tmp_path / "done"), entities=("user",), extras=True)
    kept = {r.user_id: (r.elite, r._extra) for r in increments.all_records(spark, f"{target}/user").collect()}
    assert kept == {"u1": (None, {"extra": "kept"}), "u2": ("\ufffd", {})}
    bad = increments.rejected_records(spark, f"{target}/user").collect()
    assert sorted((r._path.rsplit("/", 1)[1], r._bad_line.split(":")[0]) for r in bad) == [("2.zip", "br\ufffdken"), ("3.zip", "BadZipFile")]


def test_update_job_from_bundles_to_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS updated")
    folder, target, done = tmp_path / "zips", str(tmp_path / "out"), str(tmp_path / "done")
    review = {"user_id": "u1", "business_id": "b1", "stars": 2}
    write_zip(folder / "1.zip", {"business.json": [BUSINESS], "user.json": [{"user_id": "u1", "fans": 9}], "review.json": [review]})
    for _ in range(2):
        increments.update_tables(spark, f"{folder}/*.zip", target, done, prefix="updated.")
    write_zip(folder / "2.zip", {"business.json": [{**BUSINESS, "stars": 1.0}], "user.json": [{"user_id": "u1", "fans": 3}], "review.json": [review, review]})
    names = increments.update_tables(spark, f"{folder}/*.zip", target, done, prefix="updated.")
    assert [r.stars for r in spark.table(names["business"]).collect()] == [1.0]
    assert [r.fans for r in spark.table(names["user"]).collect()] == [3]
    assert spark.table(names["review"]).count() == 3


def test_update_job_makes_each_review_once(spark, tables, monkeypatch):
    """The reviews are a join: the bootstrap, two sets of bundles and their counts read what it gave."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(stars):
        made.add(1)
        return stars

    review = tables.review
    monkeypatch.setattr(fixtures.Tables, "review", property(lambda self: review.withColumn("stars", counted("stars"))))
    out = QUERIES["update_job"](spark, tables.folder)
    assert made.value == review.count()
    assert out.where("id like 'ru%'").agg(F.sum("n")).first()[0] > review.count()


def test_lines_of_an_archive_keep_their_numbers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bundles, "_LINES_PER_BATCH", 3)
    texts = ["{}", "", " \t", "a\r", "b", "", "　", "\x1f", "last"]
    write_zip(tmp_path / "1.zip", {"user.json": texts})
    write_zip(tmp_path / "2.zip", {"user.json": []})
    rows = bundles.member_lines(bundles.list_bundles(spark, f"{tmp_path}/*.zip"), "user").collect()
    assert {(r.number, r.line, r.failure) for r in rows} == {(0, "{}", None), (3, "a", None), (4, "b", None), (8, "last", None)}
