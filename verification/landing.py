"""Landed payloads in the shape the platforms deliver them, derived from the given tables.

Nested rows are written as JSON lines to a landing folder and read with the payload schema, so
that a flattener reads what it would read from the platform's own files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthmill.session import work_dir
from growthmill.sources import ads, commerce, crm, product_events, web
from verification.adapters import raw, table


# Rows of a compressed landed file: such a file is read by one task.
FILE_ROWS = 50_000


def as_landed(nested: DataFrame, payload: str, compression: str = "none") -> DataFrame:
    """The rows after a trip through JSON files in a landing folder."""
    spark = nested.sparkSession
    path = work_dir(spark, "landing")
    most = 0 if compression == "none" else FILE_ROWS
    nested.write.option("maxRecordsPerFile", most).json(path, compression=compression)
    return spark.read.schema(payload).json(path)


def google_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'O'")
    nested = rows.selectExpr(
        """named_struct('id', l_suppkey, 'name', 'campaign ' || l_suppkey % 20, 'status',
           CASE WHEN l_suppkey % 7 = 0 THEN 'REMOVED' WHEN l_suppkey % 5 = 0 THEN 'PAUSED' ELSE 'ENABLED' END,
           'advertising_channel_type', l_returnflag) AS campaign""",
        "named_struct('id', l_partkey % 50, 'name', 'group ' || l_partkey % 50, 'status', 'ENABLED') AS ad_group",
        """named_struct('date', CAST(DATE '2024-01-01' + CAST((l_orderkey + l_partkey) % 30 AS INT) AS STRING),
           'device', 'MOBILE') AS segments""",
        """named_struct('impressions', CAST(l_quantity AS BIGINT) * 100, 'clicks', CAST(l_quantity AS BIGINT) % 7,
           'cost_micros', CAST(l_quantity AS BIGINT) * 250000, 'conversions', CAST(l_linenumber % 3 AS DOUBLE),
           'conversions_value', CAST(l_orderkey % 64 AS DOUBLE) / 2D, 'video_views', l_partkey % 11,
           'ctr', CAST(l_quantity AS DOUBLE) / 64D, 'average_cpc', CAST(l_partkey % 9 * 500000 AS DOUBLE),
           'search_impression_share', 0.5D) AS metrics""",
    )
    return as_landed(nested, ads.GOOGLE_ADS_PAYLOAD)


def meta_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third ad repeats its purchase action; the last entry counts. Some numbers are bad text."""
    rows = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'")
    nested = rows.selectExpr(
        "CAST(l_suppkey AS STRING) AS campaign_id",
        "'campaign ' || l_suppkey % 20 AS campaign_name",
        "CAST(l_partkey % 40 AS STRING) AS adset_id",
        "l_orderkey || '-' || l_linenumber AS ad_id",
        "CAST(DATE '2024-01-01' + CAST((l_orderkey + l_partkey) % 30 AS INT) AS STRING) AS date_start",
        "CASE WHEN l_orderkey % 31 = 0 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) * 80 AS STRING) END AS impressions",
        "CAST(CAST(l_quantity AS BIGINT) % 5 AS STRING) AS clicks",
        "CAST(l_quantity / 8D AS STRING) AS spend",
        """filter(array(
             named_struct('action_type', 'link_click', 'value', CAST(l_partkey % 6 AS STRING)),
             named_struct('action_type', 'purchase', 'value', '1'),
             CASE WHEN l_orderkey % 3 = 0 THEN named_struct('action_type', 'purchase', 'value', CAST(l_linenumber AS STRING)) END,
             CASE WHEN l_orderkey % 5 = 0 THEN named_struct('action_type', 'add.to.cart', 'value', CAST(NULL AS STRING)) END
           ), a -> a IS NOT NULL) AS actions""",
        """CASE WHEN l_orderkey % 2 = 0 THEN array(
             named_struct('action_type', 'purchase', 'value', CAST(l_quantity / 4D AS STRING))) END AS cost_per_action_type""",
    )
    return as_landed(nested, ads.META_PAYLOAD, "gzip")


def linkedin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of two elements; the second one has neither cost nor counts."""
    rows = table(spark, sf_dir, "orders")
    day = "named_struct('start', named_struct('year', 2024, 'month', 1, 'day', CAST(1 + o_orderkey % 30 AS INT)))"
    nested = rows.selectExpr(
        f"""array(
             named_struct('pivot', 'CAMPAIGN', 'pivotValue', 'urn:' || o_custkey % 40, 'dateRange', {day},
               'impressions', CAST(floor(o_totalprice / 1000D) AS BIGINT), 'clicks', o_orderkey % 9,
               'costInLocalCurrency', named_struct('amount', CAST(floor(o_totalprice / 100D) / 4D AS STRING)),
               'videoViews', o_custkey % 5, 'likes', o_custkey % 2),
             named_struct('pivot', 'CAMPAIGN', 'pivotValue', 'urn:quiet:' || o_custkey % 40, 'dateRange', {day},
               'impressions', CAST(NULL AS BIGINT), 'clicks', CAST(NULL AS BIGINT),
               'costInLocalCurrency', CAST(NULL AS STRUCT<amount: STRING>),
               'videoViews', CAST(NULL AS BIGINT), 'likes', CAST(NULL AS BIGINT))) AS elements"""
    )
    return as_landed(nested, ads.LINKEDIN_PAYLOAD)


def ga4_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-row reports with positional values; the revenue of one campaign is not a number."""
    rows = raw(spark, sf_dir, "raw_ga4")
    dimensions = ("date", *web.DIMENSIONS)
    metrics = ("totalRevenue", "sessions", "activeUsers", "newUsers", "screenPageViews", "conversions", "bounceRate")

    def headers(names):
        return F.array(*[F.struct(F.lit(n).alias("name")) for n in names])

    def values(columns):
        return F.array(*[F.struct(c.cast("string").alias("value")) for c in columns])

    def dimension(name):
        return F.date_format("date", "yyyyMMdd") if name == "date" else F.col(name)

    def metric(name):
        bad = F.col("sessionCampaignName") == "campaign 7"
        return F.when(bad, "(not set)").otherwise(F.col(name).cast("string")) if name == "totalRevenue" else F.col(name)

    nested = rows.select(
        headers(dimensions).alias("dimension_headers"),
        headers(metrics).alias("metric_headers"),
        F.array(
            F.struct(
                values([dimension(d) for d in dimensions]).alias("dimension_values"),
                values([metric(m) for m in metrics]).alias("metric_values"),
            )
        ).alias("rows"),
    )
    return as_landed(nested, web.GA4_PAYLOAD)


def hubspot(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    suppliers = table(spark, sf_dir, "supplier")
    changed = "date_format(DATE '2024-01-01' + CAST({0} % 40 AS INT), \"yyyy-MM-dd'T'10:00:00'Z'\")"
    contacts = customers.selectExpr(
        "CAST(c_custkey AS STRING) AS id",
        f"""map('email', lower(c_name) || '@example.com', 'firstname', c_name, 'lifecyclestage', c_mktsegment,
            'createdate', CASE WHEN c_custkey % 11 = 0 THEN 'unknown' ELSE '2023-06-01T08:30:00Z' END,
            'lastmodifieddate', CASE WHEN c_custkey % 3 <> 0 THEN {changed.format('c_custkey')} END) AS properties""",
    )
    deals = orders.selectExpr(
        "'d' || o_orderkey AS id",
        f"""map('dealname', 'deal ' || o_orderkey, 'amount', CAST(CAST(o_totalprice AS BIGINT) AS STRING),
            'dealstage', o_orderstatus, 'createdate', {changed.format('o_orderkey')}) AS properties""",
    )
    companies = suppliers.selectExpr(
        "'c' || s_suppkey AS id",
        f"map('name', s_name, 'domain', 's' || s_suppkey || '.example', 'createdate', {changed.format('s_suppkey')}) AS properties",
    )
    return {
        name: as_landed(df, crm.HUBSPOT_PAYLOAD)
        for name, df in (("contacts", contacts), ("deals", deals), ("companies", companies))
    }


def salesforce(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    changed = "date_format(DATE '2024-01-01' + CAST({0} % 40 AS INT), \"yyyy-MM-dd'T'23:59:59.000'+0000'\")"
    leads = table(spark, sf_dir, "customer").selectExpr(
        "named_struct('type', 'Lead', 'url', '/lead/' || c_custkey) AS attributes",
        "'L' || c_custkey AS Id",
        "c_name AS LastName",
        "c_mktsegment AS LeadSource",
        "CASE WHEN c_custkey % 5 = 0 THEN '2024-01-20' WHEN c_custkey % 5 = 1 THEN 'soon' END AS ConvertedDate",
        f"{changed.format('c_custkey')} AS LastModifiedDate",
    )
    opportunities = table(spark, sf_dir, "orders").selectExpr(
        "named_struct('type', 'Opportunity', 'url', '/opp/' || o_orderkey) AS attributes",
        "'O' || o_orderkey AS Id",
        "'opportunity ' || o_orderkey AS Name",
        "CAST(CAST(o_totalprice AS BIGINT) AS DOUBLE) AS Amount",
        "CAST(CAST(o_orderdate AS DATE) AS STRING) AS CloseDate",
        f"{changed.format('o_orderkey')} AS LastModifiedDate",
    )
    payload = {
        "lead": "attributes struct<type: string, url: string>, Id string, LastName string, LeadSource string, "
        "ConvertedDate string, LastModifiedDate string",
        "opportunity": "attributes struct<type: string, url: string>, Id string, Name string, Amount double, "
        "CloseDate string, LastModifiedDate string",
    }
    return {
        "leads": as_landed(leads, payload["lead"]),
        "opportunities": as_landed(opportunities, payload["opportunity"]),
    }


def shopify_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS created_at",
        "'user' || o_custkey || '@example.com' AS email",
        "CASE o_orderstatus WHEN 'F' THEN 'paid' ELSE 'pending' END AS financial_status",
        "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 19 = 1 THEN 'free' ELSE CAST(floor(o_totalprice) AS STRING) || '.25' END AS total_price",
        "CASE WHEN o_orderkey % 2 = 0 THEN '1.5' END AS total_tax",
        "'USD' AS currency",
        "CASE WHEN o_orderkey % 10 <> 0 THEN named_struct('id', o_custkey) END AS customer",
        "CASE WHEN o_orderkey % 8 <> 0 THEN transform(sequence(1, CAST(1 + o_orderkey % 5 AS INT)), i -> named_struct('id', CAST(i AS BIGINT))) END AS line_items",
        """CASE o_orderkey % 4 WHEN 0 THEN array(named_struct('code', 'SAVE' || o_orderkey % 3), named_struct('code', 'VIP'))
           WHEN 1 THEN array(named_struct('code', 'ONE'), named_struct('code', CAST(NULL AS STRING))) END AS discount_codes""",
        "'web' AS source_name",
    )
    return as_landed(nested, commerce.SHOPIFY_ORDER_PAYLOAD)


def shopify_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "lower(c_name) || '@example.com' AS email",
        "'2023-03-04T05:06:07Z' AS created_at",
        "c_custkey % 9 AS orders_count",
        "CAST(c_acctbal AS STRING) AS total_spent",
        "c_custkey % 2 = 0 AS accepts_marketing",
        "'USD' AS currency",
    )
    return as_landed(nested, commerce.SHOPIFY_CUSTOMER_PAYLOAD)


def event_lines(spark: SparkSession, sf_dir: str) -> str:
    """A folder of event files by export day, with blank and broken lines among the events."""
    line = """to_json(named_struct('event', event_type, 'properties', named_struct(
        'distinct_id', CAST(user_id AS STRING), 'time', unix_seconds(CAST(ts AS TIMESTAMP)),
        '$insert_id', CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS STRING) END,
        'mp_country_code', CASE user_id % 3 WHEN 0 THEN 'US' ELSE 'DE' END, '$os', 'iOS',
        '$screen_width', CAST(320 + user_id % 4 * 160 AS BIGINT), 'utm_source', CASE event_id % 4 WHEN 0 THEN 'google' WHEN 1 THEN '' END,
        'plan', 'p' || user_id % 3, 'k', event_id % 100)))"""
    rows = table(spark, sf_dir, "events").selectExpr(
        f"{line} AS good",
        "event_id",
        "CAST(ts AS DATE) AS event_date",
    )
    with_noise = rows.selectExpr(
        "event_date",
        """explode(CASE WHEN event_id % 50 = 0 THEN array(good, '', '{"event": "cut off", "prop')
           WHEN event_id % 50 = 1 THEN array(good, '["not", "an", "event"]') ELSE array(good) END) AS value""",
    )
    path = work_dir(spark, "event-lines")
    with_noise.write.partitionBy("event_date").text(path)
    return path


def segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir, "raw_mixpanel_segmentation")
    nested = rows.select(
        "event",
        "segment_property",
        F.struct(
            F.create_map("segment_value", F.create_map(F.col("date").cast("string"), F.col("event_count"))).alias(
                "values"
            )
        ).alias("data"),
    )
    return as_landed(nested, f"event string, segment_property string, {product_events.SEGMENTATION_PAYLOAD}")


def funnels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report per day with four steps, of which only three are labelled; two funnels, one unnamed."""
    days = (
        table(spark, sf_dir, "events")
        .withColumn("day", F.to_date("ts"))
        .groupBy("day")
        .agg(*[F.count_if(F.col("event_type") == e).alias(e) for e in ("view", "click", "error", "purchase")])
        .selectExpr("*", "explode(array(7L, 8L)) AS funnel_id")
    )
    nested = days.selectExpr(
        "funnel_id",
        """named_struct('funnel_name', CASE WHEN funnel_id = 7 THEN 'purchase_funnel' END,
           'steps', array('Page Viewed', 'Add to Cart', 'Checkout Started')) AS meta""",
        """map(CAST(day AS STRING), named_struct(
             'steps', array(
               named_struct('count', CAST(view AS DOUBLE), 'step_conv_ratio', 1D, 'avg_time', CAST(NULL AS DOUBLE)),
               named_struct('count', CAST(click AS DOUBLE), 'step_conv_ratio', 0.5D, 'avg_time', 600D),
               named_struct('count', CAST(error AS DOUBLE), 'step_conv_ratio', 0.25D, 'avg_time', 1200D),
               named_struct('count', CAST(purchase AS DOUBLE), 'step_conv_ratio', CAST(NULL AS DOUBLE), 'avg_time', 1800D)),
             'analysis', named_struct('completion', CAST(purchase AS DOUBLE), 'completion_ratio', 0.125D))) AS data""",
    )
    return as_landed(nested, f"funnel_id bigint, {product_events.FUNNEL_PAYLOAD}")
