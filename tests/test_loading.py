import os
import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from growthmill.operators import loading, monitors, skew
from growthmill.sources import specs

ROW = "id bigint, day date, v string, n int"
DAYS = {i: date(2024, 1, i) for i in range(1, 10)}


def frame(spark, *data):
    return spark.createDataFrame([(i, DAYS.get(d), v, n) for i, d, v, n in data], ROW)


def table(spark, path):
    return sorted(((r.id, r.day and r.day.day, r.v) for r in spark.read.parquet(path).collect()), key=repr)


def test_merge_moves_keeps_inserts_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    loading.merge(frame(spark, (1, 1, "a", 1), (2, 1, "b", 1), (3, 2, "c", 1), (4, 3, "d", 1)), path, ["id"], ["n"], "day")
    update = frame(spark, (2, 1, "old", 1), (2, 1, "new", 2), (4, 5, "moved", 1), (9, 4, "added", 1))
    expected = [(1, 1, "a"), (2, 1, "new"), (3, 2, "c"), (4, 5, "moved"), (9, 4, "added")]
    for _ in range(2):
        loading.merge(update, path, ["id"], ["n"], "day")
        assert table(spark, path) == expected


def test_merge_leaves_untouched_partitions_alone(spark, tmp_path):
    path = tmp_path / "t"
    loading.merge(frame(spark, (1, 1, "a", 1), (2, 2, "b", 1)), str(path), ["id", "day"], ["n"], "day")
    files = {p: p.stat().st_mtime_ns for p in path.glob("day=2024-01-02/*.parquet")}
    loading.merge(frame(spark, (1, 1, "z", 2)), str(path), ["id", "day"], ["n"], "day")
    assert {p: p.stat().st_mtime_ns for p in path.glob("day=2024-01-02/*.parquet")} == files
    assert table(spark, str(path)) == [(1, 1, "z"), (2, 2, "b")]


def test_null_keys_never_match(spark, tmp_path):
    path = str(tmp_path / "t")
    loading.merge(frame(spark, (None, 1, "a", 1), (1, 1, "b", 1)), path, ["id"], ["n"], "day")
    loading.merge(frame(spark, (None, 1, "c", 1), (None, 1, "d", 1)), path, ["id"], ["n"], "day")
    assert table(spark, path) == [(1, 1, "b"), (None, 1, "a"), (None, 1, "c"), (None, 1, "d")]


def test_rows_without_a_day_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    loading.merge(frame(spark, (1, None, "a", 1), (2, None, "b", 1)), path, ["id"], ["n"], "day")
    loading.merge(frame(spark, (1, None, "z", 2), (2, 3, "moved", 2), (5, None, "e", 1)), path, ["id"], ["n"], "day")
    assert table(spark, path) == [(1, None, "z"), (2, 3, "moved"), (5, None, "e")]


def test_merge_without_partition_and_with_new_column(spark, tmp_path):
    path = str(tmp_path / "t")
    loading.merge(frame(spark, (1, 1, "a", 1), (2, 2, "b", 1)), path, ["id"])
    loading.merge(frame(spark, (2, 2, "z", 2)).withColumn("extra", F.lit("x")), path, ["id"])
    got = sorted((r.id, r.v, r.extra) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a", None), (2, "z", "x")]


def test_bucketed_merge_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    path = tmp_path / "t"
    rows = loading.with_key_bucket(frame(spark, *[(i, 1, "a", 1) for i in range(1, 10)]), ["id"], 4)
    loading.merge(rows, str(path), ["id", "key_bucket"], ["n"], "key_bucket")
    before = {p: p.stat().st_mtime_ns for p in path.glob("key_bucket=*/*.parquet")}
    update = loading.with_key_bucket(frame(spark, (3, 2, "z", 2)), ["id"], 4)
    loading.merge(update, str(path), ["id", "key_bucket"], ["n"], "key_bucket")
    kept = {p.parent for p in before if p.exists() and p.stat().st_mtime_ns == before[p]}
    assert len({p.parent for p in before} - kept) == 1
    assert table(spark, str(path)) == [(i, 2 if i == 3 else 1, "z" if i == 3 else "a") for i in range(1, 10)]


def test_empty_loads_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = frame(spark, (1, 1, "a", 1))
    assert loading.write_table(rows, path, "overwrite", "day")
    assert not loading.write_table(rows.limit(0), path, "overwrite", "day")
    loading.merge(rows.limit(0), path, ["id"], ["n"], "day")
    assert table(spark, path) == [(1, 1, "a")]
    assert not loading.write_table(rows.limit(0), str(tmp_path / "none"))
    assert not Path(tmp_path / "none").exists()


def test_partition_field(spark, tmp_path):
    stamped = spark.createDataFrame([(1, datetime(2024, 1, 1, 5)), (2, datetime(2024, 1, 2, 6))], "id int, created_at timestamp")
    loading.write_table(stamped, str(tmp_path / "t"), "overwrite", "created_at")
    assert sorted(p.name for p in (tmp_path / "t").glob("created*")) == ["created_at_day=2024-01-01", "created_at_day=2024-01-02"]
    loading.write_table(stamped, str(tmp_path / "u"), "overwrite", "missing")
    assert list((tmp_path / "u").glob("*=*")) == []


def test_chunks_cover_the_range(spark):
    bounds = spark.createDataFrame([(date(2026, 1, 1), date(2026, 1, 21))], "start_date date, end_date date")
    chunks = [tuple(r) for r in loading.date_range_chunks(bounds, 7).collect()]
    assert len(chunks) == 3 and chunks[0] == (date(2026, 1, 1), date(2026, 1, 7)) and chunks[2][1] == date(2026, 1, 21)
    short = [tuple(r) for r in loading.date_range_chunks(bounds, 10).collect()]
    assert short[-1] == (date(2026, 1, 21), date(2026, 1, 21))


def test_retention_and_lookback(spark, rows):
    df = frame(spark, *[(i, i, "x", 1) for i in range(1, 10)])
    assert loading.expire(df, "day", date(2024, 6, 30), "marts").count() == 9
    assert rows(loading.expire(df, "day", date(2024, 1, 5) + timedelta(days=180), "staging"), "id") == [(5,), (6,), (7,), (8,), (9,)]
    assert rows(loading.lookback_window(df, "day", date(2024, 1, 5), 2), "id") == [(3,), (4,), (5,)]


def test_failed_load_is_logged(spark):
    def broken(_):
        raise OSError("disk on fire")

    log = loading.run_load("stub", frame(spark, (1, 1, "a", 1)), broken).first()
    assert (log.source, log.rows_extracted, log.rows_loaded, log.success, log.error) == ("stub", 1, 0, False, "disk on fire")
    seen = []
    log = loading.run_load("stub", frame(spark, (1, 1, "a", 1), (2, 1, "b", 1)), lambda df: seen.append(df.count()), lambda df: df.filter("id = 1")).first()
    assert (log.rows_extracted, log.rows_loaded, log.success, seen) == (2, 1, True, [1])


def test_nested_columns_become_json_and_nulls_stay(spark):
    df = spark.sql("SELECT named_struct('a', 1) AS s, CAST(NULL AS map<string,int>) AS m, array('x') AS l, 'plain' AS t")
    assert tuple(loading.stringify_complex(df).first()) == ('{"a":1}', None, '["x"]', "plain")


def test_backfill_twice_gives_one_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spec = specs.SourceSpec("t", ROW, ("id", "day"), "day", 2)
    rows = frame(spark, *[(i, i, "x", 1) for i in range(1, 10)], (3, 3, "y", 2))
    for _ in range(2):
        loading.backfill(rows, path, spec, DAYS[2], DAYS[8], ["n"])
    assert table(spark, path) == [(i, i, "y" if i == 3 else "x") for i in range(2, 9)]


def test_late_older_version_does_not_win(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("newest_first", "oldest_first", "together")]
    versions = [frame(spark, (3, 3, "new", 2)), frame(spark, (3, 3, "old", 1))]
    for batch in versions:
        loading.merge(batch, paths[0], ["id", "day"], ["n"], "day")
    for batch in reversed(versions):
        loading.merge(batch, paths[1], ["id", "day"], ["n"], "day")
    loading.merge(versions[1].unionByName(versions[0]), paths[2], ["id", "day"], ["n"], "day")
    assert [table(spark, p) for p in paths] == [[(3, 3, "new")]] * 3


def test_nulls_in_keys_match_when_asked(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(None, "a", 1), ("x", None, 2), (None, None, 3)], "k string, l string, n int")
    for _ in range(2):
        loading.merge(rows, path, ["k", "l"], null_safe=True)
    assert spark.read.parquet(path).count() == 3


def test_timestamp_window_holds_the_whole_last_day(spark):
    rows = spark.sql("SELECT timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 6 * id) AS at FROM range(20)")
    kept = loading.lookback_window(rows, "at", DAYS[3], 2)
    assert kept.count() == 12 and kept.selectExpr("max(at)").first()[0].hour == 18


def test_refresh_empties_days_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = frame(spark, *[(i, i, "x", 1) for i in range(1, 6)])
    loading.write_table(rows, path, "overwrite", "day")
    loading.refresh_partitions(rows.filter("id <> 3"), path, "day", [DAYS[2], DAYS[3]])
    assert [r[0] for r in table(spark, path)] == [1, 2, 4, 5]


def test_expired_days_are_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    loading.write_table(frame(spark, *[(i, i, "x", 1) for i in range(1, 6)]), path, "overwrite", "day")
    gone = loading.expire_partitions(spark, path, "day", DAYS[3] + timedelta(days=180), "staging")
    assert gone == [DAYS[1], DAYS[2]] and [r[0] for r in table(spark, path)] == [3, 4, 5]


def test_stage_is_removed_after_success_and_named_in_a_failure(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(loading, "work_dir", lambda _, label: made.append(str(tmp_path / f"stage{len(made)}")) or made[-1])
    loading.merge(frame(spark, (1, 1, "a", 1)), str(tmp_path / "t"), ["id"])
    assert made and not any(os.path.exists(m) for m in made)
    monkeypatch.setattr(loading, "_merged", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError) as failure:
        loading.merge(frame(spark, (1, 1, "b", 1)), str(tmp_path / "t"), ["id"])
    assert made[-1] in failure.value.__notes__[0] and os.path.exists(made[-1])


def test_three_hundred_hot_keys_are_all_split(spark):
    keys = spark.range(300 * 40).selectExpr("id % 300 AS k").unionAll(spark.range(300, 600).selectExpr("id AS k"))
    assert skew.heaviest_keys(keys, ["k"], 400).count() == 300


def test_even_keys_are_not_split(spark):
    assert skew.heaviest_keys(spark.range(1000).selectExpr("id % 100 AS k"), ["k"], 8).count() == 0


def test_view_and_table(spark):
    loading.ensure_database(spark, "silver")
    df = spark.range(3)
    assert loading.materialize(df, "three_view", "view").count() == 3
    assert loading.materialize(df, "silver.three", "table").count() == 3


@pytest.mark.parametrize("hot_keys", [1, 10**6])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_the_plain_join(spark, how, hot_keys):
    data = [(1 if i % 3 else i, i) for i in range(300)] + [(None, 1000 + i) for i in range(30)] + [(-5, 7)]
    left = spark.createDataFrame(data, "k int, v int")
    right = spark.createDataFrame([(i, f"n{i}") for i in range(0, 300, 2)] + [(1, "one"), (None, "null")], "k int, name string")
    got = skew.join_key_table(left, right, ["k"], how, skew.heaviest_keys(left, ["k"], hot_keys))
    expected = left.join(right, "k", how)
    assert sorted(map(repr, got.select("k", "v", "name").collect())) == sorted(map(repr, expected.select("k", "v", "name").collect()))


def test_a_source_that_cannot_be_read_is_logged(spark):
    unreadable = spark.createDataFrame([("x",), ("1",)], "v string").filter("cast(v AS int) > 0")
    log = loading.run_load("stub", unreadable, lambda df: df.collect()).first()
    assert (log.rows_extracted, log.rows_loaded, log.success) == (None, 0, False) and log.error


def test_files_of_a_day_hold_ranges_that_do_not_overlap(spark, tmp_path):
    import pyarrow.parquet as pq

    path = tmp_path / "t"
    # One day holds nearly all rows.
    rows = spark.range(40_000).selectExpr(
        "id", "date_add(DATE '2024-01-01', CAST(IF(id % 50 = 0, id % 7, 0) AS INT)) AS day", "CAST(hash(id) % 5000 AS STRING) AS v", "1 AS n"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        loading.write_table(rows, str(path), "overwrite", "day", cluster_by=["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    several = 0
    for folder in path.glob("day=*"):
        files = [pq.read_table(f, columns=["v"], partitioning=None)["v"].to_pylist() for f in folder.glob("*.parquet")]
        ranges = sorted((min(v), max(v)) for v in files)
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
        several += len(ranges) > 1
    assert several and spark.read.parquet(str(path)).count() == 40_000


def test_merge_returns_what_it_rewrote_and_marts_follow(spark, tmp_path):
    path, mart = str(tmp_path / "t"), str(tmp_path / "mart")
    first = loading.merge(frame(spark, (1, 1, "a", 1), (2, 2, "b", 1), (3, None, "c", 1)), path, ["id"], ["n"], "day")
    assert set(first) == {DAYS[1], DAYS[2], None}

    def counts():
        return loading.read_table(spark, path).groupBy("day").agg(F.count("*").alias("n"))

    loading.write_table(counts(), mart, "overwrite", "day")
    touched = loading.merge(frame(spark, (2, 5, "moved", 2), (4, None, "d", 1)), path, ["id"], ["n"], "day")
    assert set(touched) == {DAYS[2], DAYS[5], None}
    loading.refresh_touched(counts(), mart, "day", touched)
    assert sorted(map(tuple, spark.read.parquet(mart).select("day", "n").collect()), key=repr) == sorted(map(tuple, counts().collect()), key=repr)
    assert loading.days_to_refresh([DAYS[5], None], before=2, after=1) == [DAYS[4], DAYS[5], DAYS[6], DAYS[7], None]
    assert loading.merge(frame(spark), path, ["id"], ["n"], "day") == [] and loading.refresh_touched(counts(), mart, "day", []) == []


def event_folder(tmp_path, day, *lines):
    folder = tmp_path / "files" / f"event_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.json").write_text("\n".join(lines) + "\n")


def test_event_files_split_into_table_and_rejects(spark, tmp_path):
    files, table, rejects = (str(tmp_path / n) for n in ("files", "table", "rejects"))
    good = ['{"event":"A","properties":{"$insert_id":"%d","time":1704067200}}' % i for i in range(3)]
    event_folder(tmp_path, "2024-01-01", *good, "broken", "broken")
    event_folder(tmp_path, "2024-01-02", "broken")
    for _ in range(2):
        touched, events, refused = loading.load_event_files(spark, files, table, rejects, specs.MIXPANEL_EVENTS)
        assert (touched, events, refused) == ([date(2024, 1, 1)], 3, 3)
        assert spark.read.parquet(table).count() == 3
        stored = spark.read.parquet(rejects).groupBy("event_date").count().collect()
        assert {r.event_date.day: r["count"] for r in stored} == {1: 2, 2: 1}
    # A corrected export of a day takes its rejects away.
    event_folder(tmp_path, "2024-01-02", good[0])
    assert loading.load_event_files(spark, files, table, rejects, specs.MIXPANEL_EVENTS)[1:] == (4, 2)
    assert [r.event_date.day for r in spark.read.parquet(rejects).select("event_date").distinct().collect()] == [1]
    event_folder(tmp_path / "none", "2024-01-01", "")
    assert loading.load_event_files(spark, f"{tmp_path}/none/files", table, rejects, specs.MIXPANEL_EVENTS) == ([], 0, 0)
    assert spark.read.parquet(table).count() == 4


def ledger_rows(spark, ledger):
    entries = loading.read_ledger(spark, ledger).collect()
    return sorted((r.table_name, r.partition_value, r.load_day.day, r.row_count) for r in entries)


def test_ledger_follows_loads_and_expiry(spark, tmp_path):
    path, other, ledger = (str(tmp_path / n) for n in ("segments", "objects", "ledger"))
    columns = "event string, segment_property string, segment_value string, date date, event_count bigint, _extracted_at timestamp"

    def load(*rows):
        frame = spark.createDataFrame([("e", "p", v, date(2024, 1, d), n, datetime(2024, 2, at)) for v, d, n, at in rows], columns)
        loading.load_source(frame, path, specs.MIXPANEL_SEGMENTATION, ledger=ledger)

    assert ledger_rows(spark, ledger) == []
    load(("a", 1, 1, 1), ("b", 1, 1, 1), ("a", 2, 1, 1))
    objects = spark.createDataFrame([("1", "lead", datetime(2024, 2, 9))], "Id string, object_type string, _extracted_at timestamp")
    loading.load_source(objects, other, specs.SALESFORCE, ledger=ledger)
    bucket = next(row[1] for row in ledger_rows(spark, ledger) if row[0] == "salesforce_objects")
    for _ in range(2):
        load(("a", 1, 5, 3), ("c", 3, 1, 3))
        assert ledger_rows(spark, ledger) == [
            ("mixpanel_segmentation", "2024-01-01", 1, 1),
            ("mixpanel_segmentation", "2024-01-01", 3, 1),
            ("mixpanel_segmentation", "2024-01-02", 1, 1),
            ("mixpanel_segmentation", "2024-01-03", 3, 1),
            ("salesforce_objects", bucket, 9, 1),
        ]
    stored = loading.read_table(spark, path)
    for now in (datetime(2024, 2, 3, 15), datetime(2024, 2, 9)):
        scanned = monitors.freshness_breaches({"mixpanel_segmentation": stored}, now, {"mixpanel_segmentation": 12}).collect()
        noted = monitors.ledger_freshness_breaches(loading.read_ledger(spark, ledger), now, {"mixpanel_segmentation": 12})
        assert sorted(noted.collect()) == sorted(scanned)
        assert path not in noted._jdf.queryExecution().executedPlan().toString()
    (never,) = monitors.ledger_freshness_breaches(loading.read_ledger(spark, ledger), now, {"ga4_sessions": 6}).collect()
    assert never.last_loaded is None and never.hours_since_load is None
    low = monitors.ledger_row_count_breaches(
        loading.read_ledger(spark, ledger), date(2024, 2, 3), {"mixpanel_segmentation": 3, "ga4_sessions": 1}
    )
    assert sorted((r.table_name, r.row_count) for r in low.collect()) == [("ga4_sessions", 0), ("mixpanel_segmentation", 2)]
    gone = loading.expire_partitions(spark, path, "date", date(2025, 1, 2), "raw", "mixpanel_segmentation", ledger)
    assert gone == [date(2024, 1, 1), date(2024, 1, 2)]
    assert [row[1] for row in ledger_rows(spark, ledger)] == ["2024-01-03", bucket]


def test_merge_writes_partitions_once_and_settles_ties_alike(spark, tmp_path, monkeypatch):
    stages = []
    monkeypatch.setattr(loading, "remove_folder", lambda spark, path: stages.append(Path(path)))
    path = str(tmp_path / "t")
    update = frame(spark, (1, 1, "a", 5), (1, 1, "b", 5), (2, 2, "c", 1))
    for rows in (update, update.select("v", "n", "day", "id")):
        loading.merge(rows, path, ["id", "day"], ["n"], "day")
        assert table(spark, path) == [(1, 1, "b"), (2, 2, "c")]
    # Versions are sorted out once, beside the stored ones, and the staged result has no folder per day.
    assert [spark.read.parquet(str(s / "source")).count() for s in stages] == [3, 3]
    merged = stages[-1] / "merged"
    assert spark.read.parquet(str(merged)).count() == 2 and not list(merged.glob("day=*"))


def test_a_key_that_changes_its_day_moves_only_between_the_days_of_its_newest_version(spark, tmp_path):
    path = str(tmp_path / "t")
    loading.merge(frame(spark, (1, 1, "a", 1), (7, 4, "x", 1)), path, ["id"], ["n"], "day")
    touched = loading.merge(frame(spark, (1, 4, "lost", 2), (1, 3, "moved", 3)), path, ["id"], ["n"], "day")
    assert sorted(touched) == [DAYS[1], DAYS[3]]
    assert table(spark, path) == [(1, 3, "moved"), (7, 4, "x")]


def test_a_repeated_load_without_copies_sorts_no_rows_and_reads_no_stored_ones(spark, tmp_path, monkeypatch):
    sorted_out, joined, path = [], [], str(tmp_path / "t")
    latest, merged = loading.latest_per_key, loading._merged
    monkeypatch.setattr(loading, "latest_per_key", lambda *args: sorted_out.append(args) or latest(*args))
    monkeypatch.setattr(loading, "_merged", lambda *args: joined.append(args[0].select("day").distinct().collect()) or merged(*args))
    rows = frame(spark, (1, 1, "a", 1), (2, 1, "b", 1), (3, 2, "c", 1), (None, 2, "d", 1))
    for update in (rows, rows, frame(spark, (1, 3, "moved", 2), (2, 1, "z", 1))):
        loading.merge(update, path, ["id"], ["n"], "day", null_safe=True)
    assert table(spark, path) == sorted([(1, 3, "moved"), (2, 1, "z"), (3, 2, "c"), (None, 2, "d")], key=repr)
    assert sorted_out == [] and joined == []
    # One day keeps a row; the other, with the greater stored row, too.
    loading.merge(frame(spark, (3, 2, "z", 0), (2, 1, "new", 5), (9, 1, "i", 1)), path, ["id"], ["n"], "day", null_safe=True)
    assert table(spark, path) == sorted(
        [(1, 3, "moved"), (2, 1, "new"), (3, 2, "c"), (9, 1, "i"), (None, 2, "d")], key=repr
    )
    assert [[r.day for r in days] for days in joined] == [[DAYS[2]]]


def test_versions_in_moved_and_replaced_partitions_equal_a_plain_merge(spark, tmp_path):
    """Many small merges against a dictionary: null orders and days, ties, moves between days, rows that stay."""
    rng, path, state = random.Random(3), str(tmp_path / "t"), {}
    for _ in range(8):
        part = [(rng.randrange(9), rng.choice([None, 1, 2, 3]), f"v{rng.random()}", rng.choice([None, 1, 2, 3])) for _ in range(5)]
        loading.merge(frame(spark, *part), path, ["id"], ["n"], "day")
        best = {}
        for row in part:
            rank = (row[3] or 0, row[1] or 0, row[2])
            if row[0] not in best or rank > best[row[0]][0]:
                best[row[0]] = (rank, row)
        for key, (rank, row) in best.items():
            if key not in state or rank[0] >= (state[key][3] or 0):
                state[key] = row
        assert table(spark, path) == sorted(((i, d, v) for i, d, v, _ in state.values()), key=repr)


def test_replaced_partitions_keep_the_columns_and_types_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    old = frame(spark, (1, 1, "a", 1), (2, 2, "b", 1)).withColumn("more", F.lit("m"))
    loading.merge(old.withColumn("n", F.col("n").cast("bigint")), path, ["id"], ["n"], "day")
    loading.merge(frame(spark, (1, 1, "z", 2)), path, ["id"], ["n"], "day")
    got = spark.read.option("mergeSchema", "true").parquet(path)
    assert dict(got.dtypes)["n"] == "bigint"
    assert sorted((r.id, r.v, r.n, r.more) for r in got.collect()) == [(1, "z", 2, None), (2, "b", 1, "m")]


def test_late_rows_are_picked_before_their_copies_are_numbered(spark, monkeypatch):
    from verification.registry import QUERIES

    plans, merge = [], loading.merge

    def watched(rows, *args, **kwargs):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        assert rows.schema["row_key"].dataType.simpleString() == "binary"
        return merge(rows, *args, **kwargs)

    monkeypatch.setattr(loading, "merge", watched)
    QUERIES["incremental_mart_from_merge"](spark, "/root/testdata/sf0.001")
    assert len(plans) == 2
    for plan in plans:
        assert "dayofmonth" in plan and plan.index("Window [") < plan.index("dayofmonth")


def test_only_copies_of_a_key_are_sorted_out_and_replaced_days_are_not_read(spark, tmp_path, monkeypatch):
    sorted_out, joined, path = [], [], str(tmp_path / "t")
    latest, merged = loading.latest_per_key, loading._merged
    monkeypatch.setattr(loading, "latest_per_key", lambda *args: sorted_out.append(args[0].count()) or latest(*args))
    monkeypatch.setattr(loading, "_merged", lambda *args: joined.append({r.day for r in args[0].collect()}) or merged(*args))

    def load(*data):
        loading.merge(frame(spark, *data), path, ["id", "day"], ["n"], "day", null_safe=True)

    for _ in range(2):
        load((1, 1, "a", 1), (1, 1, "b", 1), (2, 1, "c", 1), (3, 2, "d", 1), (None, 2, "e", 1), (4, None, "x", 1))
        assert table(spark, path) == sorted(
            [(1, 1, "b"), (2, 1, "c"), (3, 2, "d"), (None, 2, "e"), (4, None, "x")], key=repr
        )
    assert sorted_out == [2, 2] and joined == []
    # A day keeps a row that no update has and one a greater row; others are replaced or new and stay apart.
    load((2, 1, "z", 2), (3, 2, "older", 0), (None, 2, "f", 1), (9, 3, "new", 1), (4, None, "y", 1))
    assert table(spark, path) == sorted(
        [(1, 1, "b"), (2, 1, "z"), (3, 2, "d"), (None, 2, "f"), (9, 3, "new"), (4, None, "y")], key=repr
    )
    assert sorted_out == [2, 2, 7] and joined == [{DAYS[1], DAYS[2]}]


@pytest.mark.parametrize("most", [loading.MOST_REPEATED, 0])
@pytest.mark.parametrize("null_safe", [True, False])
def test_merges_with_the_day_in_the_key_equal_a_plain_merge(spark, tmp_path, monkeypatch, null_safe, most):
    """Many small merges against a dictionary: null keys, days and orders, ties, copies, stored rows that stay."""
    monkeypatch.setattr(loading, "MOST_REPEATED", most)
    rng, path, state = random.Random(5), str(tmp_path / "t"), {}
    for turn in range(4):
        part = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2]), f"v{rng.random()}", rng.choice([None, 1, 2])) for _ in range(6)]
        loading.merge(frame(spark, *part), path, ["id", "day"], ["n"], "day", null_safe=null_safe)
        for i, row in enumerate(part):
            key = row[:2] if null_safe or None not in row[:2] else ("alone", turn, i)
            # Of equal orders the row of the later merge stays, within a merge the one of the greater text.
            rank = (row[3] or 0, turn, row[2])
            if key not in state or rank > state[key][0]:
                state[key] = (rank, row)
        assert table(spark, path) == sorted((row[:3] for _, row in state.values()), key=repr)


def test_keys_of_one_hash_stay_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(None, "a", 1, 1), ("a", None, 1, 2), ("a", None, 1, 1)], "k string, l string, p int, n int")
    for _ in range(2):
        loading.merge(rows, path, ["k", "l", "p"], ["n"], "p", null_safe=True)
        assert sorted((r.k or "", r.l or "", r.n) for r in spark.read.parquet(path).collect()) == [("", "a", 1), ("a", "", 2)]


def test_landed_insights_are_compressed_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    from verification import landing

    monkeypatch.setattr(landing, "FILE_ROWS", 40)
    spark.range(100, numPartitions=1).selectExpr(
        "id AS l_orderkey",
        "1 AS l_linenumber",
        "id % 7 AS l_suppkey",
        "id % 11 AS l_partkey",
        "CAST(id % 50 AS DOUBLE) AS l_quantity",
        "'F' AS l_linestatus",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    landed = landing.meta_ads(spark, str(tmp_path))
    assert [name.endswith(".json.gz") for name in landed.inputFiles()] == [True] * 3
    assert sorted(r.ad_id for r in landed.collect()) == sorted(f"{i}-1" for i in range(100))
