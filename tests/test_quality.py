from datetime import date, datetime

from pyspark.sql import functions as F

from growthmill.operators import monitors, quality, schema_tests

DAY = date(2024, 1, 15)


def tables(spark, bad):
    """Small tables on which every check fails when ``bad``, and passes otherwise."""
    sign = -1.0 if bad else 1.0
    ads = [("c", "g", DAY, "m", 5.0 * sign, 2.0 if bad else 0.5, 2000.0 if bad else 3.0)] * (2 if bad else 1)
    if bad:
        ads.append(("d", "g", DAY, "m", 5.0, 0.1, 2000.0))
    return {
        "fct_campaign_performance": spark.createDataFrame(
            ads, "campaign_id string, ad_group_id string, date date, device string, cost_usd double, ctr double, roas double"
        ),
        "google_ads_campaigns": spark.createDataFrame([(date(2024, 3, 1) if bad else DAY,)], "date date"),
        "fct_funnel_conversion": spark.createDataFrame(
            [(date(2024, 1, 14), 5, 9 if bad else 4, 3, 2, 1)],
            "week_start date, total_leads bigint, mqls bigint, sqls bigint, opportunities bigint, customers bigint",
        ),
        "fct_revenue": spark.createDataFrame([(DAY, 1.0, sign)], "order_date date, gross_revenue double, net_revenue double"),
        "mixpanel_events": spark.createDataFrame([(DAY,)] * (49 if bad else 50) + [(date(2024, 2, 1),)] * bad, "event_date date"),
    }


def test_all_checks_pass_and_fail(spark):
    good = quality.run_checks(tables(spark, False), DAY, DAY).collect()
    assert len(good) == 9 and all(r.passed for r in good)
    bad = {r.check_name: r for r in quality.run_checks(tables(spark, True), DAY, DAY).collect()}
    assert len(bad) == 9 and not any(r.passed for r in bad.values())
    assert {n: r.actual for n, r in bad.items()} == {
        "no_negative_spend": 2, "no_future_dates": 1, "ctr_within_bounds": 2, "roas_not_astronomical": 1,
        "funnel_stage_order": 1, "revenue_not_negative": 1, "no_duplicate_campaign_rows": 1,
        "mixpanel_minimum_event_count": 49, "no_future_mixpanel_events": 1,
    }


def test_a_check_that_cannot_run_fails_with_its_error(spark):
    broken = tables(spark, False)
    broken["fct_campaign_performance"] = broken["fct_campaign_performance"].drop("roas")
    del broken["fct_revenue"]
    got = {r.check_name: r for r in quality.run_checks(broken, DAY, DAY).collect()}
    assert len(got) == 9
    assert not got["roas_not_astronomical"].passed and "roas" in got["roas_not_astronomical"].error
    assert not got["revenue_not_negative"].passed and "fct_revenue" in got["revenue_not_negative"].error
    assert got["no_negative_spend"].passed
    total = {r.check_name: r for r in quality.with_pass_count(quality.run_checks(broken, DAY, DAY)).collect()}["all_checks"]
    assert (total.passed, total.actual, total.expected) == (False, 7, 9)


def test_checks_of_an_empty_day(spark):
    empty = {name: df.limit(0) for name, df in tables(spark, True).items()}
    got = {r.check_name: (r.passed, r.actual) for r in quality.run_checks(empty, DAY, DAY).collect()}
    assert got.pop("mixpanel_minimum_event_count") == (False, 0)
    assert set(got.values()) == {(True, 0)}


def test_freshness_levels(spark):
    now = datetime(2024, 1, 31, 12)
    loads = {"google_ads_campaigns": 6, "meta_ads_insights": 7, "ga4_sessions": 25, "shopify_raw": None}
    frames = {
        name: spark.createDataFrame([(None if h is None else datetime.fromtimestamp(now.timestamp() - h * 3600 - 60),)], "_extracted_at timestamp")
        for name, h in loads.items()
    }
    status = {r.table_name: r.status for r in monitors.source_freshness(frames, now).collect()}
    assert status == {"google_ads_campaigns": "warn", "meta_ads_insights": "warn", "ga4_sessions": "error", "shopify_raw": "error"}
    late = {r.table_name: r.hours_since_load for r in monitors.freshness_breaches(frames, now).collect()}
    # A table that was never loaded is late by no number of hours.
    assert late == {"meta_ads_insights": 7, "ga4_sessions": 25, "shopify_raw": None}


def test_null_rates_and_volume(spark):
    perf = spark.createDataFrame([("a", 1.0, DAY), (None, 2.0, DAY), ("b", None, date(2024, 1, 1))], "campaign_id string, cost_usd double, date date")
    got = {r.column_name: (r.null_rate, r.breached) for r in monitors.null_rates({"fct_campaign_performance": perf}, DAY).collect()}
    assert got == {"campaign_id": (0.5, True), "cost_usd": (0.0, False), "date": (0.0, False)}
    none = monitors.null_rates({"fct_campaign_performance": perf}, date(2023, 1, 1)).collect()
    assert {(r.null_rate, r.breached) for r in none} == {(None, False)}
    events = spark.createDataFrame([(datetime(2024, 1, 15, h),) for h in range(24)], "_extracted_at timestamp")
    (low,) = monitors.row_count_breaches({"mixpanel_events": events}, DAY).collect()
    assert (low.row_count, low.minimum_rows) == (24, 50)


def test_column_tests(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 2.0), (None, -1.0)], "k string, v double")
    assert rows(schema_tests.failing_unique(df, "k")) == [("a", 2)]
    assert schema_tests.failing_not_null(df, "k").count() == 2
    assert schema_tests.failing_accepted_values(df, "k", ["b"]).count() == 2
    assert rows(schema_tests.failing_accepted_range(df, "v", 0, 1.5), "v") == [(-1.0,), (2.0,)]
    summary = schema_tests.summarize_unique({"stg_hubspot_contacts": df.withColumn("contact_id", F.col("k"))})
    assert rows(summary) == [("stg_hubspot_contacts", "contact_id", 1)]


def test_all_kinds_of_column_tests_in_one_scan(spark, rows):
    events = spark.createDataFrame(
        [("1", "a", "u", DAY, "direct"), ("1", "a", None, DAY, "wrong"), (None, "a", "u", DAY, None), (None, None, None, None, "wrong")],
        "event_id string, event_name string, distinct_id string, event_date date, channel_normalized string",
    )
    checked = schema_tests.check_model(events, "stg_mixpanel_events")
    got = {(r.test_name, r.column_name): r.failing_rows for r in checked.collect()}
    assert got == {
        ("not_null", "event_id"): 2, ("not_null", "event_name"): 1, ("not_null", "distinct_id"): 2, ("not_null", "event_date"): 1,
        ("accepted_values", "channel_normalized"): 2, ("unique", "event_id"): 1,
    }
    assert checked._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    several = schema_tests.check_model(events, "stg_mixpanel_events", ("event_id", "event_name", "event_date"))
    more = {(r.test_name, r.column_name): r.failing_rows for r in several.collect()}
    assert more == {**got, ("unique", "event_name"): 1, ("unique", "event_date"): 1}
    empty = schema_tests.check_model(events.limit(0), "stg_mixpanel_events")
    assert {r.failing_rows for r in empty.collect()} == {0}
    parts = {"stg_mixpanel_events": events}
    both = schema_tests.summarize_not_null(parts).unionByName(schema_tests.summarize_unique(parts))
    assert {(r.column_name, r.failing_rows) for r in both.collect()} <= {(c, n) for (_, c), n in got.items()}
