"""Touch models and event funnels against plain Python on small random frames."""

import itertools
import random
import re
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from growthmill.operators import funnel, touches
from growthmill.plans import questions

TOUCH = (
    "customer_id bigint, touch_id bigint, session_date timestamp, channel string, source string, medium string, "
    "campaign string, order_id bigint, order_value double, is_conversion boolean"
)


@pytest.fixture(scope="module")
def touch_rows():
    """One customer has most of the touches; dates repeat and some are missing."""
    draw = random.Random(7)
    start = datetime(2024, 1, 1)
    result = []
    for i in range(400):
        customer = 1 if draw.random() < 0.6 else draw.choice([2, 3, 4, 5, None])
        when = None if draw.random() < 0.1 else start + timedelta(hours=draw.randrange(40))
        names = [draw.choice(["a", "b", "c", None]) for _ in range(4)]
        names[0] = None if customer == 5 else names[0]
        buys = draw.random() < 0.2
        result.append((customer, i, when, *names, i if buys else None, float(draw.randrange(9)) if buys else None, buys))
    return result


def ordered(rows):
    return sorted(rows, key=lambda r: (r[2] is None, r[2] or datetime.min, r[1]))


def by_customer(rows):
    groups = defaultdict(list)
    for row in rows:
        if row[0] is not None:
            groups[row[0]].append(row)
    return groups


def end_values(rows, last):
    result = []
    for column in range(3, 7):
        values = [r[column] for r in ordered(rows) if r[column] is not None]
        result.append((values[-1] if last else values[0]) if values else None)
    return tuple(result)


def test_first_and_last_touch(spark, touch_rows):
    df = spark.createDataFrame(touch_rows, TOUCH)
    groups = by_customer(touch_rows)
    for frame, last in ((touches.last_touch(df), True), (touches.first_touch(df), False)):
        got = {r[0]: tuple(r)[1:] for r in frame.collect()}
        assert got == {c: end_values(rows, last) for c, rows in groups.items()}


def test_linear_credit(spark, touch_rows):
    df = spark.createDataFrame(touch_rows, TOUCH)
    expected = defaultdict(float)
    for customer, rows in by_customer(touch_rows).items():
        dated = sum(r[2] is not None for r in rows)
        for r in rows:
            if r[3] is not None:
                expected[customer, r[3]] += 1 / dated
    got = {(r[0], r[1]): r[2] for r in touches.linear_attribution(df).collect()}
    assert got == pytest.approx(dict(expected))


def test_linear_credit_without_dates_is_null(spark):
    df = spark.createDataFrame([(1, 1, None, "a", None, None, None, None, None, False)], TOUCH)
    assert touches.linear_attribution(df).first().linear_attribution_credit is None


def test_full_credit_is_given_when_no_channel_is_missing(spark, touch_rows):
    rows = [r for r in touch_rows if r[2] is not None and r[3] is not None]
    credit = touches.linear_attribution(spark.createDataFrame(rows, TOUCH))
    sums = credit.groupBy("customer_id").agg(F.sum("linear_attribution_credit").alias("s")).collect()
    assert [r.s for r in sums] == pytest.approx([1.0] * len(sums))


def test_conversions_carry_both_ends_once(spark, touch_rows):
    df = spark.createDataFrame(touch_rows + touch_rows[:50], TOUCH)
    groups = by_customer(touch_rows)
    expected = set()
    for r in touch_rows:
        if r[9]:
            none = (None,) * 4
            last, first = (
                (none, none) if r[0] is None else (end_values(groups[r[0]], True), end_values(groups[r[0]], False))
            )
            expected.add((*r, *last, *first))
    got = [tuple(r) for r in touches.attribution_models(df).collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_credit_report(spark, touch_rows):
    df = spark.createDataFrame(touch_rows, TOUCH)
    last, linear = defaultdict(float), defaultdict(float)
    for rows in by_customer(touch_rows).values():
        value = sum(r[8] or 0.0 for r in rows if r[9])
        dated = sum(r[2] is not None for r in rows)
        channel = end_values(rows, True)[0]
        if channel is not None:
            last[channel] += value
        for r in rows:
            if r[3] is not None:
                linear[r[3]] += value / dated
    got = touches.channel_credit_report(df).collect()
    assert {r.channel: r.last_touch_value for r in got} == pytest.approx({c: last.get(c, 0.0) for c in linear})
    assert {r.channel: r.linear_value for r in got} == pytest.approx(dict(linear))


@pytest.fixture(scope="module")
def event_rows():
    """One user has two thirds of the events; many events share a time."""
    draw = random.Random(11)
    names = ["Page Viewed", "Signed Up", "Add to Cart", "Checkout Started", "Order Completed", "Feature Used"]
    start = datetime(2024, 1, 1)
    return [
        (
            "hot" if draw.random() < 0.66 else f"u{draw.randrange(300)}",
            f"e{i:04d}",
            draw.choice(names),
            start + timedelta(minutes=10 * draw.randrange(4000)),
            draw.choice(["x", "y", None, None, None]),
        )
        for i in range(1500)
    ]


EVENT = "distinct_id string, event_id string, event_name string, event_timestamp timestamp, utm_campaign string"


@pytest.mark.parametrize("bucket", ["hour", "day"])
def test_asof_attribution(spark, event_rows, bucket):
    df = spark.createDataFrame(event_rows, EVENT).withColumns({"utm_source": F.lit("s"), "utm_medium": F.lit("m")})
    got = {r.conversion_id: (r.touch_event_id, r.utm_campaign) for r in touches.asof_utm_attribution(df, days=2, bucket=bucket).collect()}
    expected = {}
    for user, event_id, name, at, _ in event_rows:
        if name == "Order Completed":
            earlier = [
                (t, e, c) for u, e, _, t, c in event_rows
                if u == user and c is not None and at - timedelta(days=2) <= t <= at
            ]
            best = max(earlier) if earlier else (None, None, None)
            expected[event_id] = (best[1], best[2])
    assert got == expected


@pytest.mark.parametrize("bucket", ["minute", "hour", "month"])
def test_event_funnels(spark, event_rows, bucket):
    got = {
        (r.funnel_name, r.step_index): (r.users, r.avg_seconds_from_previous)
        for r in funnel.event_funnel_steps(spark.createDataFrame(event_rows, EVENT), bucket=bucket).collect()
    }
    per_user = defaultdict(list)
    for user, _, name, at, _ in event_rows:
        per_user[user].append((at, name))
    for name, steps in funnel.EVENT_FUNNELS.items():
        reached = {user: None for user in per_user}
        for i, step in enumerate(steps):
            now, gaps = {}, []
            for user, before in reached.items():
                times = [t for t, n in per_user[user] if n == step and (before is None or t > before)]
                if times:
                    now[user] = min(times)
                    if before is not None:
                        gaps.append((now[user] - before).total_seconds())
            users, seconds = got[name, i]
            assert users == len(now)
            assert seconds == (pytest.approx(sum(gaps) / len(gaps)) if gaps else None)
            reached = now


def test_event_funnels_without_ids_or_times(spark):
    at = datetime(2024, 1, 1)
    rows = [(None, "e1", "Page Viewed", at, None), (None, "e2", "Signed Up", at + timedelta(hours=1), None), ("u", "e3", "Page Viewed", None, None)]
    got = {(r.funnel_name, r.step_index): r.users for r in funnel.event_funnel_steps(spark.createDataFrame(rows, EVENT)).collect()}
    assert got["acquisition_funnel", 0] == 1 and got["acquisition_funnel", 1] == 0
    none = funnel.event_funnel_steps(spark.createDataFrame([], EVENT)).collect()
    assert {r.users for r in none} == {0}


def test_event_funnels_shuffle_twice(spark, event_rows, tmp_path):
    spark.createDataFrame(event_rows, EVENT).write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    text = funnel.event_funnel_steps(events)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Window" not in text
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning(distinct_id" in line]
    assert len(shuffles) == 2
    # The rest: totals per funnel, and the list of declared steps.
    assert text.count("Exchange hashpartitioning") == 3


def test_asof_of_one_user_and_one_second(spark, tmp_path):
    """A user holds two thirds of all rows, most in one second; others share a second at different moments."""
    second = datetime(2024, 1, 1, 10, 0, 5)
    draw = random.Random(3)
    rows = [("hot", f"h{i:04d}", draw.choice(["Order Completed", "Page Viewed"]), second, draw.choice(["x", None])) for i in range(600)]
    for i in range(300):
        at = second.replace(microsecond=draw.randrange(5)) + timedelta(seconds=draw.randrange(3) - 1, hours=draw.choice([0, 0, 1]))
        rows.append((draw.choice(["a", "b", "hot", None]), f"o{i:04d}", draw.choice(["Order Completed", "Page Viewed"]), at, draw.choice(["y", None])))
    rows.append(("a", "late", "Order Completed", None, None))
    spark.createDataFrame(rows, EVENT).withColumns({"utm_source": F.lit("s"), "utm_medium": F.lit("m")}).write.parquet(str(tmp_path / "e"))
    df = touches.asof_utm_attribution(spark.read.parquet(str(tmp_path / "e")))
    expected = {}
    for user, event_id, name, at, _ in rows:
        if name == "Order Completed":
            tags = [(t, e) for u, e, _, t, c in rows if None not in (user, at, t, c) and u == user and t <= at]
            expected[event_id] = max(tags)[1] if tags else None
    assert {r.conversion_id: r.touch_event_id for r in df.collect()} == expected
    assert len(set(expected.values())) > 5


def test_asof_windows_hold_no_raw_events(spark, tmp_path):
    spark.createDataFrame([], EVENT).withColumns({"utm_source": F.lit("s"), "utm_medium": F.lit("m")}).write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    text = touches.asof_utm_attribution(events)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*|")) for line in text]
    windows = [k for k, line in enumerate(text) if re.search(r"\bWindow \[", line)]
    assert len(windows) == 3
    for k in windows:
        # Below every window, before the scan, the events are aggregated.
        below = list(itertools.takewhile(lambda j: depth[j] > depth[k], range(k + 1, len(text))))
        assert any(re.search(r"Aggregate\(keys?=\[distinct_id", text[j]) for j in below)


def test_predictors_count_only_actions_before_the_first_purchase(spark):
    at = datetime(2024, 1, 1)
    rows = [
        (user, f"e{i}", name, at + timedelta(hours=hour), None)
        for i, (user, name, hour) in enumerate(
            [
                ("a", "Add to Cart", 1), ("a", "Order Completed", 2), ("a", "Add to Cart", 3), ("b", "Order Completed", 1),
                ("b", "Add to Cart", 2), ("c", "Add to Cart", 1), ("c", "Add to Cart", 1), ("d", "Order Completed", 4), ("d", "Add to Cart", 4),
                (None, "Order Completed", 1), (None, "Add to Cart", 9),
            ]
        )
    ]
    got = {r.action: r for r in questions.purchase_predictors(spark.createDataFrame(rows, EVENT)).collect()}
    cart = got["Add to Cart"]
    assert (cart.event_count, cart.users_did, cart.users_did_bought, cart.users_did_not, cart.users_did_not_bought) == (4, 3, 2, 2, 2)


def test_stage_funnel_edges(spark):
    df = spark.createDataFrame(
        [(1, "visitor"), (1, "mql"), (2, "customer"), (3, "mystery"), (4, None), (None, "lead"), (5, "lead")],
        "customer_id bigint, stage string",
    )
    best = {r.customer_id: r.max_stage for r in funnel.funnel_max_stage(df).collect()}
    assert best == {1: "mql", 2: "customer", 3: None, 4: None, 5: "lead"}
    rates = [(r.from_stage, r.from_count, r.to_count) for r in funnel.funnel_conversion_rates(df).collect()]
    assert rates == [("visitor", 3, 3), ("lead", 3, 2), ("mql", 2, 1), ("sql", 1, 1), ("opportunity", 1, 1)]
    empty = funnel.funnel_conversion_rates(df.filter("stage = 'mystery'")).collect()
    assert [r.conversion_rate for r in empty] == [0.0] * 5
