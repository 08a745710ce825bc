from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from growthmill.sources import ads, commerce, crm, product_events, specs, web


def payload(spark, schema, *lines):
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    return df.select(F.from_json("line", schema).alias("r")).select("r.*")


def test_event_lines_with_malformed_and_partial_input(spark, tmp_path, rows):
    (tmp_path / "day.json").write_text(
        '{"event":"A","properties":{"distinct_id":"u1","time":1704067200,"$insert_id":"i1","$os":"iOS",'
        '"mp_country_code":"US","$screen_width":390,"plan":"pro","n":3,"deep":{"x":[1,2]}}}\n'
        "\n"
        '{"event":"B","properties":{"distinct_id":"u2","time":"soon","$screen_width":"wide"}}\n'
        '{"event":"cut", "prop\n'
        '{"event":"C"}\n'
        "[1, 2]\n"
    )
    df = product_events.read_events(spark, str(tmp_path), export_day=date(2024, 1, 2))
    assert rows(df, "event", "distinct_id", "time", "screen_width", "custom_properties") == [
        ("A", "u1", datetime(2024, 1, 1), 390, '{"plan":"pro","n":3,"deep":{"x":[1,2]}}'),
        ("B", "u2", None, None, "{}"),
        ("C", None, None, None, "{}"),
    ]
    assert {r.event_date for r in df.collect()} == {date(2024, 1, 2)}
    only = product_events.read_events(spark, str(tmp_path), events=["A"], export_day=date(2024, 1, 2))
    assert rows(only, "event") == [("A",)]


ODD_LINES = (
    ('{"event":"A","properties":{"distinct_id":"u"}}', True),
    ('  {"event":"B","properties":null}  ', True),
    ('{"event":"C"}', True),
    ('{"event":"D","properties":{"n":NaN}}', True),
    ("{'event':'E','properties':{}}", True),
    ("{}", True),
    ('{"event":"F","properties":"text"}', False),
    ('{"event":"G","properties":[1]}', False),
    ('{"event":"H"}{"event":"I"}', False),
    ('{"event":"J"},{"event":"K"}', False),
    ('{"event":"L"} trailing', False),
    ('{"event":"M", "prop', False),
    ('["event"]', False),
    ("null", False),
    ("7", False),
    ('],"objects":[', False),
    ('{"event":"N"}]}', False),
    ('{"event":"N"}],"seal":1}', False),
)


def test_every_line_is_an_event_or_rejected_by_one_rule(spark, tmp_path):
    folder = tmp_path / "files" / "event_date=2024-01-02"
    folder.mkdir(parents=True)
    (folder / "day.json").write_text("\n\n".join(line for line, _ in ODD_LINES) + "\n")
    parsed = product_events.parse_lines(product_events.read_lines(spark, str(tmp_path / "files"))).collect()
    assert [(r["value"], r["parsed"] is not None) for r in parsed] == list(ODD_LINES)
    assert product_events.read_events(spark, str(tmp_path / "files")).count() == 6
    (count,) = product_events.rejected_lines(spark, str(tmp_path / "files")).collect()
    assert (count.event_date, count.rejected_lines) == (date(2024, 1, 2), 12)


def test_names_with_escapes_pass_the_name_filter(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"event":"A"}\n{"event":"\\u0041"}\n{"event":"B","properties":{"x":"A"}}\n')
    assert product_events.read_events(spark, str(tmp_path), ["A"], date(2024, 1, 2)).count() == 2


def test_events_without_insert_id_get_a_stable_key(spark):
    df = spark.createDataFrame([("u", "e", None, datetime(2024, 1, 1)), ("u", "e", "i", datetime(2024, 1, 1))],
                               "distinct_id string, event string, insert_id string, time timestamp")
    first = [r.insert_id for r in product_events.with_event_key(df).collect()]
    assert first[1] == "i" and len(first[0]) == 32
    assert first == [r.insert_id for r in product_events.with_event_key(df).collect()]


def test_meta_keeps_the_last_entry_of_an_action_type(spark):
    line = """{"ad_id":"1","date_start":"2024-01-01","impressions":"abc","spend":"2.5",
      "actions":[{"action_type":"purchase","value":"1"},{"action_type":"purchase","value":"4"},
                 {"action_type":"add.to.cart"}]}"""
    row = ads.flatten_meta(payload(spark, ads.META_PAYLOAD, line)).first()
    assert (row.action_purchase, row.action_add_to_cart, row.action_lead, row.cpa_purchase) == (4.0, 0.0, None, None)
    assert (row.impressions, row.spend) == (None, 2.5)
    long = ads.meta_action_rows(payload(spark, ads.META_PAYLOAD, line))
    assert sorted(r.action_type for r in long.collect()) == ["add_to_cart", "purchase", "purchase"]


def test_google_drops_removed_campaigns_and_scales_micros(spark, rows):
    def line(status, day="2024-01-05"):
        return (
            '{"campaign":{"id":1,"name":"c","status":"%s"},"ad_group":{"id":2},"segments":{"date":"%s"},'
            '"metrics":{"cost_micros":1500000,"average_cpc":250000}}' % (status, day)
        )

    df = payload(spark, ads.GOOGLE_ADS_PAYLOAD, line("ENABLED"), line("REMOVED"), line("PAUSED", "2024-02-01"))
    assert rows(ads.flatten_google_ads(df), "campaign_status", "cost", "average_cpc") == [
        ("ENABLED", 1.5, 0.25), ("PAUSED", 1.5, 0.25),
    ]
    window = ads.flatten_google_ads(df, date(2024, 1, 1), date(2024, 1, 31))
    assert rows(window, "campaign_status") == [("ENABLED",)]


def test_ga4_values_follow_their_headers(spark):
    line = """{"dimension_headers":[{"name":"country"},{"name":"date"}],
      "metric_headers":[{"name":"sessions"},{"name":"bounceRate"}],
      "rows":[{"dimension_values":[{"value":"PH"},{"value":"20240131"}],"metric_values":[{"value":"7"},{"value":"x"}]},
              {"dimension_values":[{"value":"US"},{"value":"20240201"}],"metric_values":[{"value":"9"}]}]}"""
    got = web.flatten_ga4(payload(spark, web.GA4_PAYLOAD, line)).collect()
    assert [(r.date, r.country, r.sessions, r.bounceRate, r.landingPage) for r in got] == [
        (date(2024, 1, 31), "PH", 7, None, None), (date(2024, 2, 1), "US", 9, None, None),
    ]


def test_linkedin_uses_the_day_of_each_element(spark):
    line = """{"elements":[{"pivotValue":"a","dateRange":{"start":{"year":2024,"month":2,"day":29}},"clicks":3,
      "costInLocalCurrency":{"amount":"1.25"}},{"pivotValue":"b"}]}"""
    got = ads.flatten_linkedin(payload(spark, ads.LINKEDIN_PAYLOAD, line)).collect()
    assert [(r.date_start, r.pivot_value, r.clicks, r.cost, r.likes) for r in got] == [
        (date(2024, 2, 29), "a", 3, 1.25, 0), (None, "b", 0, 0.0, 0),
    ]


def test_hubspot_window_ends_with_the_last_day(spark, rows):
    def line(identity, created, modified=None):
        changed = f',"lastmodifieddate":"{modified}"' if modified else ""
        return '{"id":"%s","properties":{"createdate":"%s"%s,"email":"e"}}' % (identity, created, changed)

    contacts = payload(
        spark, crm.HUBSPOT_PAYLOAD,
        line("late", "2024-01-31T23:59:00Z"), line("after", "2024-02-01T00:00:00Z"),
        line("touched", "2020-01-01T00:00:00Z", "2024-01-10T00:00:00Z"), line("bad", "never"),
    )
    empty = contacts.limit(0)
    df = crm.flatten_hubspot(contacts, empty, empty, date(2024, 1, 1), date(2024, 1, 31))
    assert rows(df, "id", "object_type") == [("late", "contacts"), ("touched", "contacts")]
    assert {"dealname", "domain", "email"} <= set(df.columns)


def test_shopify_defaults_and_codes(spark):
    lines = (
        '{"id":1,"total_price":"10.5","customer":{"id":9},"line_items":[{"id":1},{"id":2}],"discount_codes":[{"code":"A"},{}]}',
        '{"id":2,"total_price":null}',
    )
    got = commerce.flatten_shopify_orders(payload(spark, commerce.SHOPIFY_ORDER_PAYLOAD, *lines)).collect()
    assert [(r.order_id, r.total_price, r.customer_id, r.item_count, r.discount_codes) for r in got] == [
        (1, 10.5, 9, 2, "A,"), (2, 0.0, None, 0, ""),
    ]


def test_funnel_labels_beyond_the_declared_steps(spark, rows):
    line = """{"meta":{"steps":["one"]},"data":{"2024-01-01":{"steps":[{"count":5},{"count":2,"avg_time":60}],
      "analysis":{"completion":2,"completion_ratio":0.4}}}}"""
    df = payload(spark, product_events.FUNNEL_PAYLOAD, line).withColumn("funnel_id", F.lit(7).cast("bigint"))
    flat = product_events.flatten_funnels(df)
    assert rows(flat, "funnel_name", "step_index", "step_label", "count", "avg_time_to_convert_sec", "goal_count") == [
        ("7", 0, "one", 5, 0.0, 2), ("7", 1, "step_1", 2, 60.0, 2),
    ]


def test_metadata_and_contract(spark):
    df = spark.createDataFrame([("1", "2", date(2024, 1, 1))], "campaign_id string, ad_group_id string, date date")
    stamped = specs.with_metadata(df, "stub").first()
    assert stamped["_source"] == "stub" and stamped["_extracted_at"] is not None
    full = specs.conform(df, specs.GOOGLE_ADS)
    assert set(specs.GOOGLE_ADS.schema.names) <= set(full.columns)
    with pytest.raises(ValueError, match="campaign_id"):
        specs.conform(df.drop("campaign_id"), specs.GOOGLE_ADS)


def test_action_types_are_translated_once_per_entry(spark, tmp_path):
    entry = "action_type: string, value: string"
    rows = [("a", [("x.y", "1"), (None, "5"), ("z", "n/a"), ("x_y", "2")], None), ("b", [], [("z", "3")]), ("c", None, None)]
    path = str(tmp_path / "actions")
    spark.createDataFrame(rows, f"ad_id string, actions array<struct<{entry}>>, costs array<struct<{entry}>>").write.parquet(path)
    mapped = ads.with_action_maps(spark.read.parquet(path), "actions", "costs")
    got = {r.ad_id: (r.actions, r.costs) for r in mapped.collect()}
    assert got == {"a": ({"x_y": 2.0, "z": 0.0}, None), "b": ({}, {"z": 3.0}), "c": (None, None)}
    assert mapped.columns == ["ad_id", "actions", "costs"]
    assert mapped._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 2
