from datetime import datetime, timedelta

from growthmill.streaming import events as streams

SCHEMA = "event string, distinct_id string, insert_id string, time timestamp"
START = datetime(2024, 1, 1)


def arrive(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_duplicates_across_batches_and_restarts(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    arrive(spark, source, [("a", "u", "1", START), ("a", "u", "1", START), ("b", "u", None, START)])
    for _ in range(2):
        stream = streams.read_event_stream(spark, source, SCHEMA, files_per_batch=1)
        streams.append_to(streams.deduplicate(stream), sink, state)
        arrive(spark, source, [("a", "u", "1", START), ("b", "u", None, START), ("c", "v", "2", START + timedelta(hours=3))])
    stream = streams.read_event_stream(spark, source, SCHEMA, files_per_batch=1)
    streams.append_to(streams.deduplicate(stream), sink, state)
    assert sorted(r.event for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]


def test_daily_counts_grow_with_late_events(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    keys = ["event_date", "event_name", "channel_normalized"]

    def run():
        stream = streams.read_event_stream(spark, source, SCHEMA)
        shaped = stream.selectExpr("event AS event_name", "distinct_id", "time AS event_timestamp", "'direct' AS channel_normalized")
        streams.upsert_into(streams.daily_counts(shaped), sink, state, keys, ["event_count"], "event_date", "update")

    arrive(spark, source, [("a", "u", "1", START), ("a", "v", "2", START + timedelta(days=1))])
    run()
    arrive(spark, source, [("a", "w", "3", START + timedelta(hours=1)), ("b", "w", "4", START)])
    run()
    got = sorted((r.event_date.day, r.event_name, r.event_count) for r in spark.read.parquet(sink).collect())
    assert got == [(1, "a", 2), (1, "b", 1), (2, "a", 1)]


def test_late_events_are_merged_and_batches_do_not_matter(spark, tmp_path):
    rows = [("a", "u", str(i % 7), START + timedelta(days=10 * (i % 3))) for i in range(20)] + [("b", "u", None, START)] * 2
    stored = []
    for files in (1, 100):
        source, sink, state = (str(tmp_path / f"{n}{files}") for n in ("in", "out", "state"))
        for row in reversed(rows):
            arrive(spark, source, [row])
        stream = streams.read_event_stream(spark, source, SCHEMA, files_per_batch=files if files > 1 else 6)
        streams.merge_events(stream.selectExpr("*", "CAST(time AS DATE) AS event_date"), sink, state)
        stored.append(sorted(map(tuple, spark.read.parquet(sink).select("event", "insert_id", "time").collect())))
    assert stored[0] == stored[1]
    assert len(stored[0]) == len({(i % 7, i % 3) for i in range(20)}) + 1


def test_dropped_late_rows_are_counted(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    dropped = []
    for day, name in ((0, "1"), (30, "2"), (31, "3"), (1, "4")):
        arrive(spark, source, [("a", "u", name, START + timedelta(days=day))])
        stream = streams.read_event_stream(spark, source, SCHEMA)
        dropped.append(streams.append_to(streams.deduplicate(stream), sink, state))
    assert sum(dropped) == 1


def test_closed_days_have_exact_users_and_late_rows_are_counted(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [("ab"[i % 2], None if i % 11 == 0 else f"u{i % 5}", str(i), START + timedelta(hours=i % 60)) for i in range(90)]
    late = ("a", "u9", "late", START)
    steps = [rows[::3], rows[1::3], rows[2::3], [("z", "z", "z", START + timedelta(days=9))], [late]]
    dropped = 0
    for arriving in steps:
        arrive(spark, source, arriving)
        stream = streams.read_event_stream(spark, source, SCHEMA, files_per_batch=1)
        shaped = stream.selectExpr("event AS event_name", "distinct_id", "time AS event_timestamp", "'direct' AS channel_normalized")
        dropped += streams.append_to(streams.closed_daily_counts(shaped, "3 days"), sink, state)
    got = {(r.event_date, r.event_name): (r.event_count, r.unique_users) for r in spark.read.parquet(sink).collect()}
    days = {(r[3].date(), r[0]) for r in rows}
    expected = {
        (day, name): (
            sum(r[0] == name and r[3].date() == day for r in rows),
            len({r[1] for r in rows if r[0] == name and r[3].date() == day} - {None}),
        )
        for day, name in days
    }
    assert got == expected
    assert dropped == 1
