"""Every registered query: how to run it in Spark and the SQL that gives the same rows."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from growthmill.functions import (
    channel_ga4,
    channel_utm,
    normalize_channel,
    safe_divide_or,
    surrogate_key,
    week_of_year_sunday,
    week_start_sunday,
)
from growthmill.operators import campaign, funnel, loading, monitors, quality, schema_tests, staging, touches
from growthmill.plans import growth, kpi, marketing, questions, revenue
from growthmill.session import configure, has_shared_folder, work_dir
from growthmill.sources import ads, commerce, crm, product_events, specs, web
from growthmill.streaming import events as streams
from verification import landing
from verification.adapters import raw, table
from verification.models_sql import MODELS, compose, rounded

DAY = date(2024, 1, 15)
TODAY = date(2024, 1, 25)
NOW = datetime(2024, 1, 31, 13, 0, 0)
MONEY = 2


class OnDemand(Mapping):
    """Frames by name, each built when it is first looked at."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class Models:
    """Silver and gold models over the adapters of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir
        if spark.sparkContext.master.startswith("local") and not has_shared_folder(spark):
            # A trial run on one machine; a cluster sets spark.checkpoint.dir.
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="growthmill-"))
        self._tables: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return raw(self.spark, self.sf_dir, name, self.table)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def work(self, label: str) -> str:
        return work_dir(self.spark, label)

    @cached_property
    def google(self):
        return staging.stg_google_ads(self.raw("raw_google_ads"))

    @cached_property
    def meta(self):
        return staging.stg_meta_ads(self.raw("raw_meta_ads"))

    @cached_property
    def linkedin(self):
        return staging.stg_linkedin_ads(self.raw("raw_linkedin_ads"))

    @cached_property
    def sessions(self):
        return staging.stg_ga4_sessions(self.raw("raw_ga4"))

    @cached_property
    def contacts(self):
        return staging.stg_hubspot_contacts(self.raw("raw_hubspot"))

    @cached_property
    def orders(self):
        return staging.stg_shopify_orders(self.raw("raw_shopify"))

    @cached_property
    def events(self):
        return staging.stg_mixpanel_events(self.raw("raw_mixpanel_events"))

    @cached_property
    def segments(self):
        return staging.stg_mixpanel_segmentation(self.raw("raw_mixpanel_segmentation"))

    @cached_property
    def funnels(self):
        return staging.stg_mixpanel_funnels(self.raw("raw_mixpanel_funnels"))

    @cached_property
    def performance(self):
        return marketing.fct_campaign_performance(self.google, self.meta)

    @cached_property
    def roi(self):
        return marketing.fct_ad_spend_roi(self.performance)

    @cached_property
    def daily_events(self):
        return marketing.fct_mixpanel_events(self.events)

    @cached_property
    def event_attribution(self):
        return marketing.fct_mixpanel_campaign_attribution(self.daily_events, self.roi)

    @cached_property
    def event_attribution_bridged(self):
        return marketing.fct_mixpanel_campaign_attribution_bridged(self.daily_events, self.roi)

    @cached_property
    def funnel_conversion(self):
        return growth.fct_funnel_conversion(self.contacts)

    @cached_property
    def funnel_conversion_january(self):
        return growth.fct_funnel_conversion(staging.stg_hubspot_contacts(self.raw("raw_hubspot_january")))

    @cached_property
    def event_funnel(self):
        return growth.fct_mixpanel_funnel(self.funnels)

    @cached_property
    def revenue(self):
        return revenue.fct_revenue(self.orders)

    @cached_property
    def attribution(self):
        return revenue.fct_attribution(self.sessions, self.roi)

    @cached_property
    def attribution_bridged(self):
        return revenue.fct_attribution_bridged(self.sessions, self.roi)

    @property
    def bronze(self) -> Mapping[str, DataFrame]:
        names = {
            "google_ads_campaigns": "raw_google_ads",
            "meta_ads_insights": "raw_meta_ads",
            "ga4_sessions": "raw_ga4",
            "hubspot_objects": "raw_hubspot",
            "shopify_raw": "raw_shopify",
            "linkedin_ads_analytics": "raw_linkedin_ads",
            "mixpanel_events": "raw_mixpanel_events",
            "mixpanel_segmentation": "raw_mixpanel_segmentation",
            "mixpanel_funnel_conversions": "raw_mixpanel_funnels",
        }
        return OnDemand({name: partial(self.raw, adapter) for name, adapter in names.items()})

    @property
    def checked(self) -> Mapping[str, DataFrame]:
        """Tables the quality checks read."""
        return OnDemand(
            {
                "fct_campaign_performance": lambda: self.performance,
                "fct_funnel_conversion": lambda: self.funnel_conversion,
                "fct_revenue": lambda: self.revenue,
                "google_ads_campaigns": partial(self.raw, "raw_google_ads"),
                "mixpanel_events": partial(self.raw, "raw_mixpanel_events"),
            }
        )

    @property
    def tested(self) -> Mapping[str, DataFrame]:
        """Models the column tests read."""
        return OnDemand(
            {
                "stg_google_ads": lambda: self.google,
                "stg_meta_ads": lambda: self.meta,
                "stg_ga4_sessions": lambda: self.sessions,
                "stg_hubspot_contacts": lambda: self.contacts,
                "stg_shopify_orders": lambda: self.orders,
                "stg_mixpanel_events": lambda: self.events,
                "stg_mixpanel_segmentation": lambda: self.segments,
                "stg_mixpanel_funnels": lambda: self.funnels,
                "fct_campaign_performance": lambda: self.performance,
                "fct_ad_spend_roi": lambda: self.roi,
                "fct_funnel_conversion": lambda: self.funnel_conversion,
                "fct_revenue": lambda: self.revenue,
                "fct_attribution": lambda: self.attribution,
                "fct_mixpanel_events": lambda: self.daily_events,
                "fct_mixpanel_funnel": lambda: self.event_funnel,
                "fct_mixpanel_campaign_attribution": lambda: self.event_attribution,
            }
        )


@dataclass(frozen=True)
class Query:
    run: Callable[[Models], DataFrame]
    sql: str | None = None
    digits: dict[str, int] = field(default_factory=dict)

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.run(Models(spark, sf_dir))
        rounded_columns = {c: F.round(F.col(c).cast("double"), d) + F.lit(0.0) for c, d in self.digits.items()}
        return df.withColumns(rounded_columns) if rounded_columns else df

    @property
    def oracle(self) -> str | None:
        return None if self.sql is None else rounded(compose(self.sql), self.digits)


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doubles: str = "", money: str = ""):
    """Register a query; ``doubles`` are compared to 6 digits, ``money`` columns to cents."""
    digits = {**dict.fromkeys(doubles.split(), 6), **dict.fromkeys(money.split(), MONEY)}

    def add(run: Callable[[Models], DataFrame]):
        QUERIES[name] = Query(run, sql, digits)
        return run

    return add


def model(name: str, run: Callable[[Models], DataFrame], doubles: str = "", money: str = "") -> None:
    """Register a model whose expected rows are the SQL model of the same name."""
    assert name in MODELS
    register(name, f"SELECT * FROM {name}", doubles, money)(run)


# --- Sources -------------------------------------------------------------------


@register(
    "src_google_ads",
    """SELECT CAST(l_suppkey AS VARCHAR) AS campaign_id, 'campaign ' || (l_suppkey % 20) AS campaign_name,
       CASE WHEN l_suppkey % 5 = 0 THEN 'PAUSED' ELSE 'ENABLED' END AS campaign_status, l_returnflag AS channel_type,
       CAST(l_partkey % 50 AS VARCHAR) AS ad_group_id, 'group ' || (l_partkey % 50) AS ad_group_name,
       'ENABLED' AS ad_group_status, DATE '2024-01-01' + CAST((l_orderkey + l_partkey) % 30 AS INTEGER) AS date,
       'MOBILE' AS device, CAST(l_quantity AS BIGINT) * 100 AS impressions, CAST(l_quantity AS BIGINT) % 7 AS clicks,
       l_quantity / 4 AS cost, CAST(l_linenumber % 3 AS DOUBLE) AS conversions,
       (l_orderkey % 64) / 2 AS conversion_value, l_partkey % 11 AS video_views, l_quantity / 64 AS ctr,
       (l_partkey % 9) / 2 AS average_cpc, CAST(0.5 AS DOUBLE) AS search_impression_share
       FROM lineitem WHERE l_linestatus = 'O' AND l_suppkey % 7 <> 0""",
    "cost conversions conversion_value ctr average_cpc search_impression_share",
)
def _(m):
    return ads.flatten_google_ads(landing.google_ads(m.spark, m.sf_dir))


@register(
    "src_meta_actions_pivot",
    """SELECT CAST(l_suppkey AS VARCHAR) AS campaign_id, l_orderkey || '-' || l_linenumber AS ad_id,
       DATE '2024-01-01' + CAST((l_orderkey + l_partkey) % 30 AS INTEGER) AS date_start,
       CASE WHEN l_orderkey % 31 <> 0 THEN CAST(l_quantity AS BIGINT) * 80 END AS impressions,
       CAST(l_quantity AS BIGINT) % 5 AS clicks, l_quantity / 8 AS spend,
       CAST(l_partkey % 6 AS DOUBLE) AS action_link_click,
       CAST(CASE WHEN l_orderkey % 3 = 0 THEN l_linenumber ELSE 1 END AS DOUBLE) AS action_purchase,
       CAST(CASE WHEN l_orderkey % 5 = 0 THEN 0 END AS DOUBLE) AS action_add_to_cart,
       CASE WHEN l_orderkey % 2 = 0 THEN l_quantity / 4 END AS cpa_purchase
       FROM lineitem WHERE l_linestatus = 'F'""",
    "spend action_link_click action_purchase action_add_to_cart cpa_purchase",
)
def _(m):
    return ads.flatten_meta(landing.meta_ads(m.spark, m.sf_dir)).select(
        "campaign_id", "ad_id", "date_start", "impressions", "clicks", "spend", "action_link_click",
        "action_purchase", "action_add_to_cart", "cpa_purchase",
    )


@register(
    "src_meta_action_rows",
    """SELECT action_type, count(*) AS entries, sum(value) AS total_value FROM (
       SELECT 'link_click' AS action_type, CAST(l_partkey % 6 AS DOUBLE) AS value FROM lineitem WHERE l_linestatus = 'F'
       UNION ALL SELECT 'purchase', 1 FROM lineitem WHERE l_linestatus = 'F'
       UNION ALL SELECT 'purchase', l_linenumber FROM lineitem WHERE l_linestatus = 'F' AND l_orderkey % 3 = 0
       UNION ALL SELECT 'add_to_cart', 0 FROM lineitem WHERE l_linestatus = 'F' AND l_orderkey % 5 = 0) a GROUP BY 1""",
    "total_value",
)
def _(m):
    rows = ads.meta_action_rows(landing.meta_ads(m.spark, m.sf_dir))
    return rows.groupBy("action_type").agg(
        F.count(F.lit(1)).alias("entries"), F.sum("value").alias("total_value")
    )


@register(
    "src_meta_actions_map",
    """SELECT l_orderkey || '-' || l_linenumber AS ad_id, a.action_type, CASE a.action_type WHEN 'link_click' THEN CAST(l_partkey % 6 AS DOUBLE)
       WHEN 'purchase' THEN CASE WHEN l_orderkey % 3 = 0 THEN l_linenumber ELSE 1 END ELSE 0 END AS value
       FROM lineitem CROSS JOIN (VALUES ('link_click'), ('purchase'), ('add_to_cart')) a(action_type)
       WHERE l_linestatus = 'F' AND (a.action_type <> 'add_to_cart' OR l_orderkey % 5 = 0)""",
    "value",
)
def _(m):
    """All actions, whatever their type, from the map column."""
    flat = ads.flatten_meta(landing.meta_ads(m.spark, m.sf_dir))
    return flat.select("ad_id", F.explode("actions").alias("action_type", "value"))


@register(
    "src_linkedin",
    """SELECT DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS date_start, 'CAMPAIGN' AS pivot,
       CASE WHEN quiet THEN 'urn:quiet:' ELSE 'urn:' END || (o_custkey % 40) AS pivot_value,
       CASE WHEN quiet THEN 0 ELSE CAST(floor(o_totalprice / 1000) AS BIGINT) END AS impressions,
       CASE WHEN quiet THEN 0 ELSE o_orderkey % 9 END AS clicks,
       CASE WHEN quiet THEN 0 ELSE floor(o_totalprice / 100) / 4 END AS cost,
       CAST(0 AS BIGINT) AS one_click_leads, CAST(0 AS BIGINT) AS conversions,
       CASE WHEN quiet THEN 0 ELSE o_custkey % 5 END AS video_views, CAST(0 AS BIGINT) AS total_engagements,
       CASE WHEN quiet THEN 0 ELSE o_custkey % 2 END AS likes, CAST(0 AS BIGINT) AS shares, CAST(0 AS BIGINT) AS comments,
       CAST(0 AS BIGINT) AS follows
       FROM orders CROSS JOIN (SELECT true AS quiet UNION ALL SELECT false) q""",
    "cost",
)
def _(m):
    return ads.flatten_linkedin(landing.linkedin(m.spark, m.sf_dir))


@register(
    "src_ga4_report",
    """SELECT date, sessionSource, sessionMedium, sessionCampaignName, deviceCategory, country, landingPage,
       sessionDefaultChannelGroup, sessions, activeUsers, newUsers, screenPageViews, conversions, bounceRate,
       CASE WHEN sessionCampaignName <> 'campaign 7' THEN totalRevenue END AS totalRevenue FROM raw_ga4""",
    "bounceRate totalRevenue",
)
def _(m):
    # The reports lack three of the metrics; those columns come out null and are left out here.
    flat = web.flatten_ga4(landing.ga4_reports(m.spark, m.sf_dir))
    return flat.drop("engagedSessions", "averageSessionDuration", "engagementRate")


@register(
    "src_hubspot_objects",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, 'contacts' AS object_type, lower(c_name) || '@example.com' AS email,
       c_name AS firstname, c_mktsegment AS lifecyclestage, CAST(NULL AS VARCHAR) AS dealname, CAST(NULL AS VARCHAR) AS amount,
       CAST(NULL AS VARCHAR) AS dealstage, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS domain,
       CASE WHEN c_custkey % 11 <> 0 THEN TIMESTAMP '2023-06-01 08:30:00' END AS createdate
       FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 40 BETWEEN 4 AND 24
       UNION ALL
       SELECT 'd' || o_orderkey, 'deals', NULL, NULL, NULL, 'deal ' || o_orderkey, CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR),
       o_orderstatus, NULL, NULL, TIMESTAMP '2024-01-01 10:00:00' + INTERVAL 1 DAY * (o_orderkey % 40)
       FROM orders WHERE o_orderkey % 40 BETWEEN 4 AND 24
       UNION ALL
       SELECT 'c' || s_suppkey, 'companies', NULL, NULL, NULL, NULL, NULL, NULL, s_name, 's' || s_suppkey || '.example',
       TIMESTAMP '2024-01-01 10:00:00' + INTERVAL 1 DAY * (s_suppkey % 40)
       FROM supplier WHERE s_suppkey % 40 BETWEEN 4 AND 24""",
)
def _(m):
    objects = crm.flatten_hubspot(
        **landing.hubspot(m.spark, m.sf_dir), start=date(2024, 1, 5), end=date(2024, 1, 25)
    )
    return objects.select(
        "id", "object_type", "email", "firstname", "lifecyclestage", "dealname", "amount", "dealstage", "name",
        "domain", "createdate",
    )


@register(
    "src_salesforce_objects",
    """SELECT 'L' || c_custkey AS Id, 'lead' AS object_type, c_name AS LastName, c_mktsegment AS LeadSource,
       CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2024-01-20' END AS ConvertedDate, CAST(NULL AS VARCHAR) AS Name,
       CAST(NULL AS DOUBLE) AS Amount, CAST(NULL AS TIMESTAMP) AS CloseDate,
       TIMESTAMP '2024-01-01 23:59:59' + INTERVAL 1 DAY * (c_custkey % 40) AS LastModifiedDate
       FROM customer WHERE c_custkey % 40 BETWEEN 4 AND 24
       UNION ALL
       SELECT 'O' || o_orderkey, 'opportunity', NULL, NULL, NULL, 'opportunity ' || o_orderkey, trunc(o_totalprice),
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), TIMESTAMP '2024-01-01 23:59:59' + INTERVAL 1 DAY * (o_orderkey % 40)
       FROM orders WHERE o_orderkey % 40 BETWEEN 4 AND 24""",
    "Amount",
)
def _(m):
    return crm.flatten_salesforce(
        **landing.salesforce(m.spark, m.sf_dir), start=date(2024, 1, 5), end=date(2024, 1, 25)
    )


SHOPIFY_ORDER_SQL = """
SELECT o_orderkey AS order_id, o_orderdate AS created_at, 'user' || o_custkey || '@example.com' AS email,
       CASE o_orderstatus WHEN 'F' THEN 'paid' ELSE 'pending' END AS financial_status,
       CASE WHEN o_orderkey % 19 IN (0, 1) THEN 0 ELSE floor(o_totalprice) + 0.25 END AS total_price,
       CASE WHEN o_orderkey % 2 = 0 THEN 1.5 ELSE 0 END AS total_tax, 'USD' AS currency,
       CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS customer_id, 'web' AS source_name,
       CAST(CASE WHEN o_orderkey % 8 = 0 THEN 0 ELSE 1 + o_orderkey % 5 END AS INTEGER) AS item_count,
       CASE o_orderkey % 4 WHEN 0 THEN 'SAVE' || (o_orderkey % 3) || ',VIP' WHEN 1 THEN 'ONE,' ELSE '' END AS discount_codes
FROM orders"""


@register("src_shopify_orders", SHOPIFY_ORDER_SQL, "total_price total_tax")
def _(m):
    return commerce.flatten_shopify_orders(landing.shopify_orders(m.spark, m.sf_dir)).select(
        "order_id", "created_at", "email", "financial_status", "total_price", "total_tax", "currency", "customer_id",
        "source_name", "item_count", "discount_codes",
    )


@register(
    "src_shopify_stack",
    f"""SELECT 'order' AS object_type, order_id AS record_id, order_id, CAST(NULL AS BIGINT) AS id, email, created_at, total_price,
       CAST(NULL AS BIGINT) AS orders_count FROM ({SHOPIFY_ORDER_SQL}) o
       UNION ALL SELECT 'customer', c_custkey, NULL, c_custkey, lower(c_name) || '@example.com',
       TIMESTAMP '2023-03-04 05:06:07', NULL, c_custkey % 9 FROM customer""",
    "total_price",
)
def _(m):
    orders = commerce.flatten_shopify_orders(landing.shopify_orders(m.spark, m.sf_dir))
    customers = commerce.flatten_shopify_customers(landing.shopify_customers(m.spark, m.sf_dir))
    return commerce.stack_shopify(orders, customers).select(
        "object_type", "record_id", "order_id", "id", "email", "created_at", "total_price", "orders_count"
    )


EVENT_SQL = """
SELECT event_type AS event, CAST(user_id AS VARCHAR) AS distinct_id,
       CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS VARCHAR) END AS insert_id, date_trunc('second', ts) AS time,
       CASE user_id % 3 WHEN 0 THEN 'US' ELSE 'DE' END AS country_code, 'iOS' AS os, 320 + user_id % 4 * 160 AS screen_width,
       CASE event_id % 4 WHEN 0 THEN 'google' WHEN 1 THEN '' END AS utm_source, CAST(ts AS DATE) AS event_date
FROM events"""
EVENT_COLUMNS = (
    "event", "distinct_id", "insert_id", "time", "country_code", "os", "screen_width", "utm_source", "event_date",
)


@register("src_mixpanel_events", EVENT_SQL)
def _(m):
    return product_events.read_events(m.spark, landing.event_lines(m.spark, m.sf_dir)).select(*EVENT_COLUMNS)


@register("src_event_name_filter", f"SELECT * FROM ({EVENT_SQL}) e WHERE event IN ('purchase', 'signup')")
def _(m):
    path = landing.event_lines(m.spark, m.sf_dir)
    return product_events.read_events(m.spark, path, events=["purchase", "signup"]).select(*EVENT_COLUMNS)


@register(
    "src_rejected_lines",
    """SELECT CAST(ts AS DATE) AS event_date, count(*) AS rejected_lines FROM events WHERE event_id % 50 IN (0, 1) GROUP BY 1""",
)
def _(m):
    return product_events.rejected_lines(m.spark, landing.event_lines(m.spark, m.sf_dir))


@register(
    "load_event_files",
    f"""SELECT event_date, 'event' AS kind, count(*) AS rows FROM (
       SELECT DISTINCT event_date, coalesce(insert_id, distinct_id || '-' || event || '-' || time) AS event_key FROM ({EVENT_SQL}) e) k GROUP BY 1
       UNION ALL SELECT CAST(ts AS DATE), 'rejected', count(*) FROM events WHERE event_id % 50 IN (0, 1) GROUP BY 1""",
)
def _(m):
    """Event files loaded twice: events in the table, all other lines among the rejects."""
    files, path = landing.event_lines(m.spark, m.sf_dir), m.work("event-files-load")
    for _ in range(2):
        loading.load_event_files(m.spark, files, f"{path}/table", f"{path}/rejects", specs.MIXPANEL_EVENTS)
    counts = [
        m.spark.read.parquet(f"{path}/{folder}").groupBy("event_date", F.lit(kind).alias("kind")).agg(F.count(F.lit(1)).alias("rows"))
        for folder, kind in (("table", "event"), ("rejects", "rejected"))
    ]
    return counts[0].unionByName(counts[1])


@register(
    "src_custom_properties",
    """SELECT CAST(user_id AS VARCHAR) AS distinct_id, event_type AS event,
       '{"plan":"p' || (user_id % 3) || '","k":' || (event_id % 100) || '}' AS custom_properties, count(*) AS events
       FROM events GROUP BY 1, 2, 3""",
)
def _(m):
    rows = product_events.read_events(m.spark, landing.event_lines(m.spark, m.sf_dir))
    return rows.groupBy("distinct_id", "event", "custom_properties").agg(F.count(F.lit(1)).alias("events"))


@register(
    "src_segmentation_explode",
    "SELECT event, segment_property, segment_value, date, event_count FROM raw_mixpanel_segmentation",
)
def _(m):
    return product_events.flatten_segmentation(landing.segmentation(m.spark, m.sf_dir))


@register(
    "src_funnel_posexplode",
    """SELECT f.funnel_id, CASE f.funnel_id WHEN 7 THEN 'purchase_funnel' ELSE '8' END AS funnel_name, r.date, r.step_index,
       CASE WHEN r.step_index < 3 THEN r.step_label ELSE 'step_3' END AS step_label, r.count,
       CASE r.step_index WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 WHEN 2 THEN 0.25 ELSE 0 END AS conversion_rate,
       CAST(r.step_index * 600 AS DOUBLE) AS avg_time_to_convert_sec, r.goal_count, 0.125 AS goal_conversion_rate
       FROM raw_mixpanel_funnels r CROSS JOIN (SELECT CAST(7 AS BIGINT) AS funnel_id UNION ALL SELECT 8) f""",
    "conversion_rate avg_time_to_convert_sec goal_conversion_rate",
)
def _(m):
    return product_events.flatten_funnels(landing.funnels(m.spark, m.sf_dir))


@register(
    "src_metadata",
    """SELECT n_nationkey, n_name, TIMESTAMP '2024-01-31 06:00:00' AS _extracted_at, 'nations' AS _source FROM nation""",
)
def _(m):
    stamp = F.lit(datetime(2024, 1, 31, 6)).cast("timestamp")
    return specs.with_metadata(m.table("nation").select("n_nationkey", "n_name"), "nations", stamp)


@register(
    "src_declared_projection",
    """SELECT CAST(l_quantity AS BIGINT) * 100 AS metrics_impressions, CAST(l_quantity AS BIGINT) % 7 AS metrics_clicks,
       CAST(l_quantity AS BIGINT) * 250000 AS metrics_cost_micros, CAST(l_linenumber % 3 AS DOUBLE) AS metrics_conversions,
       (l_orderkey % 64) / 2 AS metrics_conversions_value, l_partkey % 11 AS metrics_video_views, l_suppkey AS campaign_id,
       'campaign ' || (l_suppkey % 20) AS campaign_name,
       CASE WHEN l_suppkey % 7 = 0 THEN 'REMOVED' WHEN l_suppkey % 5 = 0 THEN 'PAUSED' ELSE 'ENABLED' END AS campaign_status,
       l_partkey % 50 AS ad_group_id, 'group ' || (l_partkey % 50) AS ad_group_name,
       CAST(DATE '2024-01-01' + CAST((l_orderkey + l_partkey) % 30 AS INTEGER) AS VARCHAR) AS segments_date,
       'MOBILE' AS segments_device FROM lineitem WHERE l_linestatus = 'O'""",
    "metrics_conversions metrics_conversions_value",
)
def _(m):
    return specs.declared_projection(landing.google_ads(m.spark, m.sf_dir), specs.GOOGLE_ADS)


RUN_QUERY_SQL = """SELECT o_orderstatus, count(*) AS orders, count(DISTINCT o_custkey) AS customers
FROM {orders} WHERE o_totalprice > 1000 GROUP BY o_orderstatus"""


@register("run_query", RUN_QUERY_SQL.replace("{orders}", "orders"))
def _(m):
    return loading.run_query(m.spark, RUN_QUERY_SQL, orders=m.table("orders"))


# --- Silver and gold models ------------------------------------------------------

AD_RATIOS = "ctr cpc cpm"
SIX_RATIOS = "ctr cpc cpm cvr cpa roas"

model("stg_google_ads", lambda m: m.google, f"cost_usd conversions conversion_value_usd {SIX_RATIOS}")
model(
    "stg_meta_ads",
    lambda m: m.meta,
    f"cost_usd frequency link_clicks purchases leads add_to_cart view_content initiate_checkout {AD_RATIOS}",
)
model("stg_linkedin_ads", lambda m: m.linkedin, f"cost_usd conversions {AD_RATIOS}")
model(
    "stg_ga4_sessions",
    lambda m: m.sessions,
    "revenue_usd bounce_rate engagement_rate avg_session_duration_sec sessions_per_user conversion_rate",
)
model("stg_hubspot_contacts", lambda m: m.contacts)
model(
    "stg_shopify_orders",
    lambda m: m.orders,
    money="gross_revenue subtotal_revenue tax_amount discount_amount net_revenue",
)
model("stg_mixpanel_events", lambda m: m.events)
model("stg_mixpanel_segmentation", lambda m: m.segments)
model(
    "stg_mixpanel_funnels",
    lambda m: m.funnels,
    "step_conversion_rate avg_time_to_convert_sec overall_funnel_conversion_rate time_to_convert_inverse",
)
model(
    "fct_campaign_performance", lambda m: m.performance, f"cost_usd conversions conversion_value_usd {SIX_RATIOS}"
)
model(
    "fct_ad_spend_roi",
    lambda m: m.roi,
    f"total_spend total_conversion_value total_conversions {SIX_RATIOS} roi",
)
model("fct_mixpanel_events", lambda m: m.daily_events, "events_per_user")
EVENT_KPIS = (
    "total_spend cpa_orders cpa_leads cpa_signups cart_to_checkout_rate checkout_to_order_rate page_to_order_rate"
)
model("fct_mixpanel_campaign_attribution", lambda m: m.event_attribution, EVENT_KPIS)
model("fct_mixpanel_campaign_attribution_bridged", lambda m: m.event_attribution_bridged, EVENT_KPIS)
FUNNEL_RATES = "lead_to_mql_rate mql_to_sql_rate sql_to_opp_rate opp_to_customer_rate overall_conversion_rate"
model("fct_funnel_conversion", lambda m: m.funnel_conversion, FUNNEL_RATES)
model(
    "fct_mixpanel_funnel",
    lambda m: m.event_funnel,
    "step_conversion_rate avg_time_to_convert_sec avg_time_to_convert_min avg_time_to_convert_hrs "
    "overall_funnel_conversion_rate cumulative_drop_off_rate",
)
model(
    "fct_revenue",
    lambda m: m.revenue,
    "avg_order_value avg_items_per_order discount_rate revenue_mom_growth_rate",
    "gross_revenue net_revenue total_discounts total_taxes prev_month_revenue",
)
model("revenue_mom", lambda m: revenue.revenue_mom(m.orders), "growth_rate", "gross_revenue previous_revenue")
model("revenue_yoy", lambda m: revenue.revenue_yoy(m.orders), "growth_rate", "gross_revenue previous_revenue")
model("fct_attribution", lambda m: m.attribution, "attributed_roas", "attributed_revenue total_spend")
model("fct_attribution_bridged", lambda m: m.attribution_bridged, "attributed_roas", "attributed_revenue total_spend")

# --- Touch models and funnels ------------------------------------------------------

model("last_touch", lambda m: touches.last_touch(m.raw("raw_touches")))
model("first_touch", lambda m: touches.first_touch(m.raw("raw_touches")))
model(
    "linear_attribution", lambda m: touches.linear_attribution(m.raw("raw_touches")), "linear_attribution_credit"
)
model(
    "channel_credit_report",
    lambda m: touches.channel_credit_report(m.raw("raw_touches")),
    "linear_credit",
    "last_touch_value linear_value",
)


@register(
    "attribution_models",
    """SELECT DISTINCT t.*, l.* EXCLUDE (customer_id), f.* EXCLUDE (customer_id) FROM raw_touches t
       LEFT JOIN last_touch l ON l.customer_id = t.customer_id LEFT JOIN first_touch f ON f.customer_id = t.customer_id
       WHERE t.is_conversion""",
    "order_value",
)
def _(m):
    return touches.attribution_models(m.raw("raw_touches"))


def _asof_sql(days: int) -> str:
    return f"""SELECT c.event_id AS conversion_id, c.distinct_id, c.event_name AS conversion_event, c.event_timestamp AS converted_at,
       arg_max(t.event_id, (t.event_timestamp, t.event_id)) AS touch_event_id, max(t.event_timestamp) AS touched_at,
       arg_max(t.utm_source, (t.event_timestamp, t.event_id)) AS utm_source,
       arg_max(t.utm_medium, (t.event_timestamp, t.event_id)) AS utm_medium,
       arg_max(t.utm_campaign, (t.event_timestamp, t.event_id)) AS utm_campaign
       FROM stg_mixpanel_events c LEFT JOIN (SELECT * FROM stg_mixpanel_events WHERE utm_campaign IS NOT NULL) t
       ON t.distinct_id = c.distinct_id AND t.event_timestamp BETWEEN c.event_timestamp - INTERVAL {days} DAY AND c.event_timestamp
       WHERE c.event_name = 'Order Completed' GROUP BY 1, 2, 3, 4"""


register("asof_utm_attribution", _asof_sql(30))(lambda m: touches.asof_utm_attribution(m.events))
register("asof_utm_attribution_one_day", _asof_sql(1))(lambda m: touches.asof_utm_attribution(m.events, days=1))


@register(
    "funnel_stage_counts",
    """SELECT event_date, stage, channel, count(DISTINCT customer_id) AS unique_visitors FROM raw_stage_events
       WHERE event_date IS NOT NULL AND stage IS NOT NULL AND channel IS NOT NULL GROUP BY 1, 2, 3""",
)
def _(m):
    return funnel.funnel_stage_counts(m.raw("raw_stage_events"))


@register(
    "funnel_max_stage",
    """SELECT customer_id, stage_order, CASE stage_order WHEN 0 THEN 'visitor' WHEN 1 THEN 'lead' WHEN 2 THEN 'mql'
       WHEN 3 THEN 'sql' WHEN 4 THEN 'opportunity' WHEN 5 THEN 'customer' END AS max_stage FROM furthest_stage""",
)
def _(m):
    return funnel.funnel_max_stage(m.raw("raw_stage_events"))


@register(
    "funnel_conversion_rates",
    """SELECT s.from_stage, s.to_stage, count(*) FILTER (WHERE stage_order >= i) AS from_count,
       count(*) FILTER (WHERE stage_order > i) AS to_count,
       coalesce(count(*) FILTER (WHERE stage_order > i) / nullif(CAST(count(*) FILTER (WHERE stage_order >= i) AS DOUBLE), 0), 0) AS conversion_rate
       FROM furthest_stage CROSS JOIN (SELECT 0 AS i, 'visitor' AS from_stage, 'lead' AS to_stage UNION ALL SELECT 1, 'lead', 'mql'
       UNION ALL SELECT 2, 'mql', 'sql' UNION ALL SELECT 3, 'sql', 'opportunity' UNION ALL SELECT 4, 'opportunity', 'customer') s
       GROUP BY 1, 2""",
    "conversion_rate",
)
def _(m):
    return funnel.funnel_conversion_rates(m.raw("raw_stage_events"))


FUNNEL_DEFINITIONS = """(SELECT 'acquisition_funnel' AS funnel_name, 0 AS step_index, 'Page Viewed' AS step_label
 UNION ALL SELECT 'acquisition_funnel', 1, 'Signed Up' UNION ALL SELECT 'acquisition_funnel', 2, 'Feature Used'
 UNION ALL SELECT 'purchase_funnel', 0, 'Page Viewed' UNION ALL SELECT 'purchase_funnel', 1, 'Add to Cart'
 UNION ALL SELECT 'purchase_funnel', 2, 'Checkout Started' UNION ALL SELECT 'purchase_funnel', 3, 'Order Completed'
 UNION ALL SELECT 'lead_gen_funnel', 0, 'Page Viewed' UNION ALL SELECT 'lead_gen_funnel', 1, 'Lead Form Submitted'
 UNION ALL SELECT 'lead_gen_funnel', 2, 'Demo Requested')"""


def _step_sql(i: int) -> str:
    """Users at step i: the first such event after they reached the step before."""
    previous = "" if i == 0 else f"JOIN s{i - 1} p ON p.distinct_id = e.distinct_id AND p.funnel_name = d.funnel_name"
    after = "" if i == 0 else "AND e.event_timestamp > p.at"
    seconds = "CAST(NULL AS DOUBLE)" if i == 0 else "epoch_us(min(e.event_timestamp)) / 1e6 - epoch_us(min(p.at)) / 1e6"
    return f"""s{i} AS (SELECT e.distinct_id, d.funnel_name, {i} AS step_index, min(e.event_timestamp) AS at, {seconds} AS seconds
        FROM stg_mixpanel_events e JOIN d ON d.step_label = e.event_name AND d.step_index = {i} {previous}
        WHERE true {after} GROUP BY 1, 2)"""


@register(
    "event_funnel_steps",
    f"""WITH d AS (SELECT * FROM {FUNNEL_DEFINITIONS} x), {', '.join(_step_sql(i) for i in range(4))},
       n AS (SELECT d.funnel_name, d.step_index, d.step_label, count(r.distinct_id) AS users, avg(r.seconds) AS avg_seconds_from_previous
         FROM d LEFT JOIN (SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3) r
         ON r.funnel_name = d.funnel_name AND r.step_index = d.step_index GROUP BY 1, 2, 3)
       SELECT n.*, coalesce(users / nullif(CAST(coalesce(lag(users) OVER (PARTITION BY funnel_name ORDER BY step_index), users) AS DOUBLE), 0), 0) AS step_conversion_rate,
       coalesce(users / nullif(CAST(first_value(users) OVER (PARTITION BY funnel_name ORDER BY step_index) AS DOUBLE), 0), 0) AS overall_conversion_rate
       FROM n""",
    "step_conversion_rate overall_conversion_rate avg_seconds_from_previous",
)
def _(m):
    return funnel.event_funnel_steps(m.events)


@register(
    "event_segmentation",
    """SELECT event_name AS event, 'utm_campaign' AS segment_property, utm_campaign AS segment_value, event_date AS date,
       count(*) AS event_count FROM stg_mixpanel_events
       WHERE event_name IN ('Signed Up', 'Page Viewed', 'Add to Cart', 'Checkout Started', 'Order Completed') GROUP BY ALL""",
)
def _(m):
    return funnel.event_segmentation(m.events, "utm_campaign")


@register(
    "event_segmentation_all",
    " UNION ALL ".join(
        f"""SELECT event_name AS event, '{p}' AS segment_property, {p} AS segment_value, event_date AS date, count(*) AS event_count
        FROM stg_mixpanel_events WHERE event_name IN ('Signed Up', 'Page Viewed', 'Add to Cart', 'Checkout Started', 'Order Completed') GROUP BY ALL"""
        for p in ("utm_source", "utm_medium", "utm_campaign", "utm_content", "country_code", "city", "operating_system", "browser")
    ),
)
def _(m):
    return funnel.event_segmentation_all(m.events)


# --- Campaign rows and functions -----------------------------------------------------

CAMPAIGN_TEXT = """CASE channel_type WHEN 'DISPLAY' THEN 'display' ELSE 'other' END"""
CAMPAIGN_SQL = f"""
SELECT DISTINCT *, coalesce(clicks / nullif(CAST(impressions AS DOUBLE), 0), 0) AS ctr,
       coalesce(cost / nullif(CAST(clicks AS DOUBLE), 0), 0) AS cpc,
       1000 * coalesce(cost / nullif(CAST(impressions AS DOUBLE), 0), 0) AS cpm,
       coalesce(conversions / nullif(CAST(clicks AS DOUBLE), 0), 0) AS cvr, coalesce(cost / nullif(conversions, 0), 0) AS cpa,
       coalesce(conversion_value / nullif(CAST(cost AS DOUBLE), 0), 0) AS roas, {CAMPAIGN_TEXT} AS channel_normalized
FROM raw_google_ads WHERE impressions >= 0"""


@register("campaign_transform", CAMPAIGN_SQL, f"cost conversions conversion_value {SIX_RATIOS}")
def _(m):
    return campaign.campaign_transform(m.raw("raw_google_ads"))


@register(
    "canonical_rename",
    """SELECT * EXCLUDE (spend, date_start), spend AS cost, date_start AS date FROM raw_meta_ads""",
    "cost frequency action_link_click action_purchase",
)
def _(m):
    return campaign.canonical_rename(m.raw("raw_meta_ads"))


@register(
    "lenient_coercion",
    """SELECT l_orderkey || '-' || l_linenumber AS ad_id, DATE '2024-01-01' + CAST((l_orderkey + l_partkey) % 30 AS INTEGER) AS date,
       CAST(CASE WHEN l_orderkey % 31 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) * 80 END AS DOUBLE) AS impressions,
       CAST(CAST(l_quantity AS BIGINT) % 5 AS DOUBLE) AS clicks, l_quantity / 8 AS cost FROM lineitem WHERE l_linestatus = 'F'""",
    "impressions clicks cost",
)
def _(m):
    landed = landing.meta_ads(m.spark, m.sf_dir).select("ad_id", "date_start", "impressions", "clicks", "spend")
    return campaign.coerce_metrics(campaign.canonical_rename(landed))


@register(
    "full_row_dedupe",
    "SELECT DISTINCT l_partkey % 100 AS part, l_linenumber, l_returnflag, l_linestatus FROM lineitem",
)
def _(m):
    rows = m.table("lineitem").selectExpr("l_partkey % 100 AS part", "l_linenumber", "l_returnflag", "l_linestatus")
    return campaign.full_row_dedupe(rows)


@register(
    "dedupe_report",
    """SELECT count(*) AS rows_in, count(DISTINCT (part, l_linenumber, l_returnflag, l_linestatus)) AS rows_kept,
       count(*) - count(DISTINCT (part, l_linenumber, l_returnflag, l_linestatus)) AS rows_dropped
       FROM (SELECT l_partkey % 100 AS part, l_linenumber, l_returnflag, l_linestatus FROM lineitem) l""",
)
def _(m):
    rows = m.table("lineitem").selectExpr("l_partkey % 100 AS part", "l_linenumber", "l_returnflag", "l_linestatus")
    return campaign.dedupe_report(rows)


@register(
    "safe_divide_zero",
    "SELECT o_orderkey, coalesce(o_totalprice / nullif(CAST(o_orderkey % 5 AS DOUBLE), 0), 0) AS ratio FROM orders",
    "ratio",
)
def _(m):
    ratio = safe_divide_or(F.col("o_totalprice"), F.col("o_orderkey") % 5)
    return m.table("orders").select("o_orderkey", ratio.alias("ratio"))


CHANNEL_TEXT = """CASE o_orderkey % 14 WHEN 0 THEN ' Google Ads ' WHEN 1 THEN 'bing-PPC' WHEN 2 THEN 'Instagram' WHEN 3 THEN 'LinkedIn'
 WHEN 4 THEN 'Newsletter Email' WHEN 5 THEN 'Organic Social' WHEN 6 THEN 'SEO' WHEN 7 THEN '(direct)' WHEN 8 THEN 'referral'
 WHEN 9 THEN 'Affiliates' WHEN 10 THEN 'Display' WHEN 11 THEN 'SEARCH' WHEN 12 THEN '' END"""


@register(
    "normalize_channel",
    f"""SELECT t AS raw_channel, CASE WHEN coalesce(t, '') = '' THEN 'unknown'
       WHEN regexp_matches(lower(t), 'google|cpc|ppc') THEN 'paid_search'
       WHEN regexp_matches(lower(t), 'facebook|instagram|meta|linkedin') THEN 'paid_social'
       WHEN lower(t) LIKE '%email%' THEN 'email' WHEN regexp_matches(lower(t), 'organic|seo') THEN 'organic_search'
       WHEN lower(t) LIKE '%direct%' THEN 'direct' WHEN lower(t) LIKE '%referral%' THEN 'referral'
       WHEN lower(t) LIKE '%affiliate%' THEN 'affiliate' WHEN lower(t) LIKE '%display%' THEN 'display' ELSE 'other' END AS channel,
       count(*) AS orders FROM (SELECT {CHANNEL_TEXT} AS t FROM orders) x GROUP BY 1, 2""",
)
def _(m):
    texts = m.table("orders").selectExpr(f"{CHANNEL_TEXT} AS raw_channel")
    return texts.groupBy("raw_channel", normalize_channel(F.col("raw_channel")).alias("channel")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@register(
    "channel_ga4",
    """SELECT default_channel_group, channel_normalized AS channel, count(*) AS rows_seen FROM stg_ga4_sessions GROUP BY 1, 2""",
)
def _(m):
    group = F.col("sessionDefaultChannelGroup")
    return (
        m.raw("raw_ga4")
        .groupBy(group.alias("default_channel_group"), channel_ga4(group).alias("channel"))
        .agg(F.count(F.lit(1)).alias("rows_seen"))
    )


@register(
    "channel_utm",
    """SELECT r.utm_source, r.utm_medium, s.channel_normalized AS channel, count(*) AS events
       FROM raw_mixpanel_events r JOIN stg_mixpanel_events s
       ON s.event_id = coalesce(r.insert_id, md5(concat_ws('-', r.distinct_id, r.event, CAST(r.time AS VARCHAR)))) GROUP BY 1, 2, 3""",
)
def _(m):
    return (
        m.raw("raw_mixpanel_events")
        .groupBy("utm_source", "utm_medium", channel_utm(F.col("utm_source"), F.col("utm_medium")).alias("channel"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


@register(
    "date_week_sunday",
    """SELECT CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER) AS week_start,
       count(*) AS orders FROM orders GROUP BY 1, 2""",
)
def _(m):
    day = F.to_date("o_orderdate")
    return m.table("orders").groupBy(day.alias("day"), week_start_sunday(day).alias("week_start")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@register(
    "date_week_of_year",
    """SELECT CAST(o_orderdate AS DATE) AS day, CAST(strftime(o_orderdate, '%U') AS INTEGER) AS week_of_year,
       count(*) AS orders FROM orders GROUP BY 1, 2""",
)
def _(m):
    day = F.to_date("o_orderdate")
    return m.table("orders").groupBy(day.alias("day"), week_of_year_sunday(day).alias("week_of_year")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@register(
    "surrogate_key",
    """SELECT distinct_id, event, time, utm_source, md5(concat_ws('-', distinct_id, event, CAST(time AS VARCHAR),
       coalesce(utm_source, '_dbt_utils_surrogate_key_null_'))) AS row_key FROM raw_mixpanel_events""",
)
def _(m):
    parts = ("distinct_id", "event", "time", "utm_source")
    return m.raw("raw_mixpanel_events").select(*parts, surrogate_key(*[F.col(p) for p in parts]).alias("row_key"))


# --- Loading ---------------------------------------------------------------------------

AD_COLUMNS = ("campaign_id", "ad_group_id", "date", "device", "impressions", "clicks", "cost", "_extracted_at")
AD_SQL = f"SELECT {', '.join(AD_COLUMNS)} FROM raw_google_ads"


def _ad_rows(m: Models) -> DataFrame:
    return m.raw("raw_google_ads").select(*AD_COLUMNS)


@register("sink_append", AD_SQL, "cost")
def _(m):
    path, rows = m.work("append"), _ad_rows(m)
    paused = F.col("campaign_id").cast("int") % 5 == 0
    loading.write_table(rows.filter(paused), path, "append")
    loading.write_table(rows.filter(~paused), path, "append")
    return m.spark.read.parquet(path)


@register("sink_overwrite", f"{AD_SQL} WHERE device = 'MOBILE'", "cost")
def _(m):
    path, rows = m.work("overwrite"), _ad_rows(m)
    loading.write_table(rows, path, "overwrite")
    loading.write_table(rows.filter("device = 'MOBILE'"), path, "overwrite")
    return m.spark.read.parquet(path)


@register("sink_partitioned", AD_SQL, "cost")
def _(m):
    path = m.work("partitioned")
    loading.write_table(_ad_rows(m), path, "overwrite", partition_field="date")
    return m.spark.read.parquet(path)


@register(
    "sink_clustered",
    "SELECT date, channel_source, campaign_id, ad_group_id, device, impressions, cost_usd FROM fct_campaign_performance",
    "cost_usd",
)
def _(m):
    path = m.work("clustered")
    rows = m.performance.select(
        "date", "channel_source", "campaign_id", "ad_group_id", "device", "impressions", "cost_usd"
    )
    loading.write_table(rows, path, "overwrite", "date", cluster_by=["channel_source", "campaign_id"])
    return m.spark.read.parquet(path)


@register("sink_empty_noop", AD_SQL, "cost")
def _(m):
    path, rows = m.work("empty"), _ad_rows(m)
    loading.write_table(rows, path, "overwrite")
    loading.write_table(rows.filter("impressions < 0"), path, "overwrite")
    return m.spark.read.parquet(path)


@register(
    "materialize",
    "SELECT channel_source, sum(total_spend) AS total_spend, count(*) AS campaign_days FROM fct_ad_spend_roi GROUP BY 1",
    money="total_spend",
)
def _(m):
    path = m.work("materialize")
    name = f"roi_{path.rsplit('-', 1)[-1]}"
    view = loading.materialize(m.roi, f"{name}_view", "view")
    return loading.materialize(
        view.groupBy("channel_source").agg(
            F.sum("total_spend").alias("total_spend"), F.count(F.lit(1)).alias("campaign_days")
        ),
        name,
        "table",
        path,
    )


@register(
    "stringify_complex",
    """SELECT o_orderkey, '{"id":' || o_custkey || ',"status":"' || o_orderstatus || '"}' AS customer,
       CASE WHEN o_orderkey % 3 = 0 THEN '["' || o_orderpriority || '","x"]' END AS tags,
       '{"k' || (o_orderkey % 2) || '":' || (o_orderkey % 7) || '}' AS props FROM orders""",
)
def _(m):
    nested = m.table("orders").selectExpr(
        "o_orderkey",
        "named_struct('id', o_custkey, 'status', o_orderstatus) AS customer",
        "CASE WHEN o_orderkey % 3 = 0 THEN array(o_orderpriority, 'x') END AS tags",
        "map('k' || o_orderkey % 2, o_orderkey % 7) AS props",
    )
    return loading.stringify_complex(nested)


@register(
    "latest_per_key",
    """SELECT campaign_id, ad_group_id, date, device, impressions, clicks, cost, _extracted_at FROM (
       SELECT *, row_number() OVER (PARTITION BY campaign_id, ad_group_id, date, device
         ORDER BY cost DESC, impressions DESC, clicks DESC, _extracted_at DESC) AS n FROM raw_google_ads) r WHERE n = 1""",
    "cost",
)
def _(m):
    return loading.latest_per_key(_ad_rows(m), specs.GOOGLE_ADS.merge_keys, ["cost"])


MERGE_SQL = """
SELECT event_id AS insert_id, CAST(ts AS DATE) AS event_date, event_type AS event,
       CASE WHEN event_id % 2 = 0 OR event_id % 3 = 0 THEN 'second' ELSE 'landed' END AS state
FROM events"""


def _merge_frames(m: Models) -> tuple[DataFrame, DataFrame]:
    """First load and an update of it; the update holds every key twice, in two versions."""
    rows = m.table("events").selectExpr(
        "event_id AS insert_id", "CAST(ts AS DATE) AS event_date", "event_type AS event"
    )
    first = rows.filter("insert_id % 3 <> 0").withColumn("state", F.lit("landed"))
    update = rows.filter("insert_id % 2 = 0 OR insert_id % 3 = 0").withColumn("state", F.explode(F.array(F.lit("first"), F.lit("second"))))
    return first, update


@register("merge_upsert", MERGE_SQL)
def _(m):
    path = m.work("merge-table")
    first, update = _merge_frames(m)
    for frame in (first, update, update):
        loading.merge(frame, path, ["insert_id", "event_date"], ["state"], "event_date")
    return m.spark.read.parquet(path)


@register(
    "backfill_merge",
    """SELECT campaign_id, ad_group_id, date, device, impressions, clicks, cost, _extracted_at FROM (
       SELECT *, row_number() OVER (PARTITION BY campaign_id, ad_group_id, date, device
         ORDER BY cost DESC, impressions DESC, clicks DESC, _extracted_at DESC) AS n FROM raw_google_ads
       WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20') r WHERE n = 1""",
    "cost",
)
def _(m):
    path = m.work("backfill")
    span = (date(2024, 1, 5), date(2024, 1, 20))
    loading.backfill(_ad_rows(m), path, specs.GOOGLE_ADS, *span, order=["cost"])
    loading.backfill(_ad_rows(m), path, specs.GOOGLE_ADS, date(2024, 1, 10), span[1], order=["cost"])
    return m.spark.read.parquet(path)


@register(
    "incremental_mart",
    "SELECT date, channel_source, campaign_id, campaign_name, total_spend, roas FROM fct_ad_spend_roi",
    "total_spend roas",
)
def _(m):
    """A mart built without late rows of three days, then refreshed for those days only."""
    path = m.work("mart")
    days = [date(2024, 1, d) for d in (10, 11, 12)]
    late = F.col("date").isin(days) & (F.col("campaign_id").cast("int") % 3 == 0)

    def mart(performance):
        columns = ("date", "channel_source", "campaign_id", "campaign_name", "total_spend", "roas")
        return marketing.fct_ad_spend_roi(performance).select(*columns)

    loading.write_table(mart(m.performance.filter(~late)), path, "overwrite", "date")
    loading.refresh_partitions(mart(m.performance), path, "date", days)
    return m.spark.read.parquet(path)


@register(
    "incremental_mart_from_merge",
    "SELECT date, channel_source, campaign_id, campaign_name, total_spend, roas FROM fct_ad_spend_roi",
    "total_spend roas",
)
def _(m):
    """A stored input gains late rows by a merge; the mart is refreshed for the days that the merge rewrote."""
    path = m.work("mart-from-merge")
    late = F.coalesce((F.dayofmonth("date") == 11) & (F.length("campaign_id") > 0), F.lit(False))
    rows = loading.stringify_complex(m.performance)

    def keyed(part):
        # Rows of the input have no key of their own. Equal rows are in one part, where copies are numbered.
        named = part.withColumn("row_key", F.unhex(F.md5(F.to_json(F.struct(*rows.columns)))))
        copies = Window.partitionBy("date", "row_key").orderBy(F.lit(1))
        return named.withColumn("copy", F.row_number().over(copies))

    def mart(performance):
        columns = ("date", "channel_source", "campaign_id", "campaign_name", "total_spend", "roas")
        return marketing.fct_ad_spend_roi(performance).select(*columns)

    keys, touched = ["row_key", "copy", "date"], []
    for part in (keyed(rows.filter(~late)), keyed(rows.filter(late))):
        touched.append(loading.merge(part, f"{path}/input", keys, [], "date", null_safe=True))
        stored = mart(loading.read_table(m.spark, f"{path}/input", part.schema))
        if len(touched) == 1:
            loading.write_table(stored, f"{path}/mart", "overwrite", "date")
    loading.refresh_touched(stored, f"{path}/mart", "date", touched[-1])
    return m.spark.read.parquet(f"{path}/mart")


@register("retention_filter", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '2001-08-01' - 180")
def _(m):
    rows = m.table("orders").select("o_orderkey", "o_orderdate")
    return loading.expire(rows, "o_orderdate", date(2001, 8, 1), "staging")


@register("lookback_window", f"{AD_SQL} WHERE date BETWEEN DATE '2024-01-18' AND DATE '2024-01-20'", "cost")
def _(m):
    return loading.lookback_window(_ad_rows(m), "date", date(2024, 1, 20), specs.GOOGLE_ADS.lookback_days)


@register(
    "date_range_chunks",
    """SELECT o_orderstatus, CAST(s.d AS DATE) AS chunk_start, least(CAST(s.d AS DATE) + 29, b.hi) AS chunk_end
       FROM (SELECT o_orderstatus, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders GROUP BY 1) b,
       LATERAL (SELECT unnest(generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 30 DAY)) AS d) s""",
)
def _(m):
    bounds = (
        m.table("orders")
        .groupBy("o_orderstatus")
        .agg(
            F.min(F.to_date("o_orderdate")).alias("start_date"), F.max(F.to_date("o_orderdate")).alias("end_date")
        )
    )
    return loading.date_range_chunks(bounds, 30)


@register(
    "lookback_window_timestamp",
    """SELECT o_orderkey, o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) AS placed_at FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-02' AND DATE '1997-04-01'""",
)
def _(m):
    rows = m.table("orders").selectExpr(
        "o_orderkey", "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT)) AS placed_at"
    )
    return loading.lookback_window(rows, "placed_at", date(1997, 4, 1))


# --- One load per source, each run twice ---------------------------------------------------


def _loaded_twice(m: Models, flat: DataFrame, spec: specs.SourceSpec, order: tuple[str, ...] | list[str] = ()) -> DataFrame:
    path = m.work(f"load-{spec.table}")
    for _ in range(2):
        loading.load_source(flat, path, spec, order)
    return m.spark.read.parquet(path)


@register(
    "load_shopify",
    """SELECT 'order' AS object_type, CAST(o_orderdate AS DATE) AS day, count(*) AS records,
       sum(CASE WHEN o_orderkey % 19 IN (0, 1) THEN 0 ELSE floor(o_totalprice) + 0.25 END) AS total_price FROM orders GROUP BY 2
       UNION ALL SELECT 'customer', DATE '2023-03-04', count(*), NULL FROM customer""",
    money="total_price",
)
def _(m):
    orders = commerce.flatten_shopify_orders(landing.shopify_orders(m.spark, m.sf_dir))
    customers = commerce.flatten_shopify_customers(landing.shopify_customers(m.spark, m.sf_dir))
    stored = _loaded_twice(m, commerce.stack_shopify(orders, customers), specs.SHOPIFY)
    return stored.groupBy("object_type", F.to_date("created_at").alias("day")).agg(
        F.count(F.lit(1)).alias("records"), F.sum("total_price").alias("total_price")
    )


@register(
    "load_ga4",
    """SELECT date, count(*) AS report_rows, CAST(sum(sessions) AS BIGINT) AS sessions FROM (
       SELECT date, max(sessions) AS sessions FROM raw_ga4 GROUP BY date, sessionSource, sessionMedium, sessionCampaignName,
       deviceCategory, country, landingPage, sessionDefaultChannelGroup) r GROUP BY 1""",
)
def _(m):
    # The fixture can hold a dimension tuple twice; the larger report counts.
    stored = _loaded_twice(m, web.flatten_ga4(landing.ga4_reports(m.spark, m.sf_dir)), specs.GA4, ["sessions"])
    return stored.groupBy("date").agg(
        F.count(F.lit(1)).alias("report_rows"), F.sum("sessions").alias("sessions")
    )


@register(
    "load_hubspot",
    """SELECT 'contacts' AS object_type, c_custkey % 40 AS changed_day, count(*) AS objects
       FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 40 BETWEEN 4 AND 24 GROUP BY 2
       UNION ALL SELECT 'deals', o_orderkey % 40, count(*) FROM orders WHERE o_orderkey % 40 BETWEEN 4 AND 24 GROUP BY 2
       UNION ALL SELECT 'companies', s_suppkey % 40, count(*) FROM supplier WHERE s_suppkey % 40 BETWEEN 4 AND 24 GROUP BY 2""",
)
def _(m):
    flat = crm.flatten_hubspot(**landing.hubspot(m.spark, m.sf_dir), start=date(2024, 1, 5), end=date(2024, 1, 25))
    path = m.work("load-hubspot")
    loading.load_source(flat, path, specs.HUBSPOT)
    loading.backfill(flat, path, specs.HUBSPOT, date(2024, 1, 10), date(2024, 1, 20))
    changed = F.coalesce(F.try_to_timestamp(F.col("lastmodifieddate")), F.try_to_timestamp(F.col("hs_lastmodifieddate")), "createdate")
    day = F.date_diff(changed, F.lit(date(2024, 1, 1))).cast("bigint")
    return m.spark.read.parquet(path).groupBy("object_type", day.alias("changed_day")).agg(F.count(F.lit(1)).alias("objects"))


@register(
    "load_hubspot_old_export",
    """SELECT 'deals' AS object_type, count(*) AS objects, count(*) AS newest
       FROM orders WHERE o_orderkey % 40 BETWEEN 4 AND 24""",
)
def _(m):
    """An export of the same deals that says they changed a year earlier is loaded after the current one."""
    flat = crm.flatten_hubspot(**landing.hubspot(m.spark, m.sf_dir), start=date(2024, 1, 5), end=date(2024, 1, 25))
    # Landed deals say only when they were made.
    changed = F.date_format("createdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    deals = flat.filter("object_type = 'deals'").withColumns({"hs_lastmodifieddate": changed, "dealstage": F.lit("newest")})
    earlier = F.regexp_replace("hs_lastmodifieddate", "^2024", "2023")
    old = deals.withColumns({"hs_lastmodifieddate": earlier, "dealstage": F.lit("old")})
    path = m.work("load-hubspot-old")
    for export in (deals, old):
        loading.load_source(export, path, specs.HUBSPOT)
    newest = F.sum((F.col("dealstage") == "newest").cast("bigint"))
    return m.spark.read.parquet(path).groupBy("object_type").agg(F.count(F.lit(1)).alias("objects"), newest.alias("newest"))


@register(
    "load_salesforce",
    """SELECT 'lead' AS object_type, count(*) AS objects, CAST(NULL AS DOUBLE) AS amount FROM customer WHERE c_custkey % 40 BETWEEN 4 AND 24
       UNION ALL SELECT 'opportunity', count(*), sum(trunc(o_totalprice)) FROM orders WHERE o_orderkey % 40 BETWEEN 4 AND 24""",
    money="amount",
)
def _(m):
    flat = crm.flatten_salesforce(**landing.salesforce(m.spark, m.sf_dir), start=date(2024, 1, 5), end=date(2024, 1, 25))
    path = m.work("load-salesforce")
    loading.load_source(flat, path, specs.SALESFORCE)
    loading.backfill(flat, path, specs.SALESFORCE, date(2024, 1, 5), date(2024, 1, 25))
    return m.spark.read.parquet(path).groupBy("object_type").agg(
        F.count(F.lit(1)).alias("objects"), F.sum("Amount").alias("amount")
    )


@register(
    "load_mixpanel_events",
    f"""SELECT event_date, count(*) AS events FROM (
       SELECT DISTINCT event_date, coalesce(insert_id, distinct_id || '-' || event || '-' || time) AS event_key FROM ({EVENT_SQL}) e) k GROUP BY 1""",
)
def _(m):
    flat = product_events.read_events(m.spark, landing.event_lines(m.spark, m.sf_dir))
    stored = _loaded_twice(m, flat, specs.MIXPANEL_EVENTS)
    return stored.groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


@register(
    "load_meta_ads",
    """SELECT date_start, count(*) AS ads, CAST(sum(clicks) AS BIGINT) AS clicks FROM (
       SELECT DATE '2024-01-01' + CAST((l_orderkey + l_partkey) % 30 AS INTEGER) AS date_start, max(CAST(l_quantity AS BIGINT) % 5) AS clicks
       FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, l_orderkey, l_linenumber) a GROUP BY 1""",
)
def _(m):
    # The fixture can hold an ad and day twice; the one with more clicks counts.
    stored = _loaded_twice(m, ads.flatten_meta(landing.meta_ads(m.spark, m.sf_dir)), specs.META_ADS, ["clicks"])
    return stored.groupBy("date_start").agg(F.count(F.lit(1)).alias("ads"), F.sum("clicks").alias("clicks"))


@register(
    "expire_partitions",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders WHERE o_orderdate >= DATE '1998-08-01' - 180",
)
def _(m):
    """Days of a stored table beyond the retention of their layer are removed."""
    path = m.work("expire")
    rows = m.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))
    loading.write_table(rows, path, "overwrite", "order_day")
    loading.expire_partitions(m.spark, path, "order_day", date(1998, 8, 1), "staging")
    return m.spark.read.schema("o_orderkey bigint, order_day date").parquet(path)


@register(
    "mart_partitioned",
    "SELECT date, channel_source, count(*) AS campaigns, sum(total_spend) AS total_spend FROM fct_ad_spend_roi GROUP BY 1, 2",
    money="total_spend",
)
def _(m):
    """A mart stored by day and sorted by channel and campaign."""
    path = m.work("mart-partitioned")
    name = f"mart_{path.rsplit('-', 1)[-1]}"
    stored = loading.materialize(m.roi, name, "table", path, "date", ["channel_source", "campaign_id"])
    return stored.groupBy("date", "channel_source").agg(
        F.count(F.lit(1)).alias("campaigns"), F.sum("total_spend").alias("total_spend")
    )


@register(
    "run_metrics",
    f"""SELECT 'google_ads' AS source, (SELECT count(*) FROM raw_google_ads) AS rows_extracted,
       (SELECT count(*) FROM ({CAMPAIGN_SQL}) c) AS rows_loaded, true AS success, CAST(NULL AS VARCHAR) AS error""",
)
def _(m):
    path = m.work("run")
    return loading.run_load(
        "google_ads",
        m.raw("raw_google_ads"),
        lambda rows: loading.write_table(rows, path, "overwrite", "date"),
        campaign.campaign_transform,
    )


@register(
    "run_metrics_failed",
    """SELECT 'google_ads' AS source, CAST(NULL AS BIGINT) AS rows_extracted, CAST(0 AS BIGINT) AS rows_loaded, false AS success,
       count(*) > 0 AS has_error FROM raw_google_ads""",
)
def _(m):
    path = m.work("failed-run")
    unreadable = m.raw("raw_google_ads").filter(F.concat(F.lit("x"), F.col("campaign_id").cast("string")).cast("int") > 0)
    log = loading.run_load("google_ads", unreadable, lambda rows: loading.write_table(rows, path, "overwrite", "date"))
    return log.withColumn("has_error", F.col("error").isNotNull()).drop("error")


# --- Quality checks, monitors and column tests --------------------------------------------

CHECK_SQL = {
    "no_negative_spend": (
        "fct_campaign_performance",
        "SELECT count(*) AS n FROM fct_campaign_performance WHERE date = DATE '{day}' AND cost_usd < 0",
    ),
    "no_future_dates": (
        "google_ads_campaigns",
        "SELECT count(*) AS n FROM raw_google_ads WHERE date > DATE '2024-01-25'",
    ),
    "ctr_within_bounds": (
        "fct_campaign_performance",
        "SELECT count(*) AS n FROM fct_campaign_performance WHERE date = DATE '{day}' AND ctr NOT BETWEEN 0 AND 1",
    ),
    "roas_not_astronomical": (
        "fct_campaign_performance",
        "SELECT count(*) AS n FROM fct_campaign_performance WHERE date = DATE '{day}' AND roas > 1000 AND cost_usd > 1",
    ),
    "funnel_stage_order": (
        "fct_funnel_conversion",
        "SELECT count(*) AS n FROM fct_funnel_conversion WHERE week_start >= DATE '{day}' - 7 "
        "AND (mqls > total_leads OR sqls > mqls OR customers > opportunities)",
    ),
    "revenue_not_negative": (
        "fct_revenue",
        "SELECT count(*) AS n FROM fct_revenue WHERE order_date = DATE '{day}' AND least(gross_revenue, net_revenue) < 0",
    ),
    "no_duplicate_campaign_rows": (
        "fct_campaign_performance",
        "SELECT count(*) AS n FROM (SELECT 1 FROM fct_campaign_performance WHERE date = DATE '{day}' "
        "GROUP BY campaign_id, ad_group_id, date, device HAVING count(*) > 1) d",
    ),
    "mixpanel_minimum_event_count": (
        "mixpanel_events",
        "SELECT count(*) AS n FROM raw_mixpanel_events WHERE event_date = DATE '{day}'",
    ),
    "no_future_mixpanel_events": (
        "mixpanel_events",
        "SELECT count(*) AS n FROM raw_mixpanel_events WHERE event_date > DATE '{day}'",
    ),
}


def _check_sql(name: str, day: date) -> str:
    on_table, counted = CHECK_SQL[name]
    minimum = 50 if name == "mixpanel_minimum_event_count" else 0
    passed = "n >= 50" if minimum else "n = 0"
    return f"""SELECT '{name}' AS check_name, '{on_table}' AS table_name, {passed} AS passed, n AS actual,
        CAST({minimum} AS BIGINT) AS expected, CAST(NULL AS VARCHAR) AS error FROM ({counted.format(day=day)}) c"""


def _register_check(key: str, name: str, day: date = DAY) -> None:
    register(key, _check_sql(name, day))(lambda m: quality.run_checks(m.checked, day, TODAY, [name]))


_register_check("dq_no_negative_spend", "no_negative_spend")
_register_check("dq_no_future_dates", "no_future_dates")
_register_check("dq_ctr_bounds", "ctr_within_bounds")
_register_check("dq_roas_not_astronomical", "roas_not_astronomical")
_register_check("dq_funnel_stage_order", "funnel_stage_order", date(1997, 1, 15))
_register_check("dq_revenue_not_negative", "revenue_not_negative", date(1997, 1, 15))
_register_check("dq_duplicate_campaign_rows", "no_duplicate_campaign_rows")
_register_check("dq_min_event_count", "mixpanel_minimum_event_count")
_register_check("dq_no_future_events", "no_future_mixpanel_events")

_ALL_CHECKS_SQL = " UNION ALL ".join(_check_sql(name, DAY) for name in CHECK_SQL)


@register(
    "dq_run_all",
    f"""{_ALL_CHECKS_SQL} UNION ALL
       SELECT 'all_checks', '*', bool_and(passed), count(*) FILTER (WHERE passed), count(*), NULL FROM ({_ALL_CHECKS_SQL}) a""",
)
def _(m):
    return quality.with_pass_count(quality.run_checks(m.checked, DAY, TODAY))


LOADS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, max(_extracted_at) AS last_loaded, {hours} AS max_hours, {warn} AS warn_hours, {error} AS error_hours FROM {adapter}"
    for name, adapter, hours, warn, error in (
        ("google_ads_campaigns", "raw_google_ads", 6, 6, 24),
        ("meta_ads_insights", "raw_meta_ads", 6, 6, 24),
        ("linkedin_ads_analytics", "raw_linkedin_ads", "NULL", 6, 24),
        ("ga4_sessions", "raw_ga4", 6, 6, 24),
        ("hubspot_objects", "raw_hubspot", 12, 12, 48),
        ("shopify_raw", "raw_shopify", 6, 6, 24),
        ("mixpanel_events", "raw_mixpanel_events", 12, 12, 24),
        ("mixpanel_segmentation", "raw_mixpanel_segmentation", 12, 12, 24),
        ("mixpanel_funnel_conversions", "raw_mixpanel_funnels", 24, 24, 48),
    )
)


@register(
    "mon_freshness",
    f"""SELECT table_name, last_loaded, max_hours, hours_since_load FROM (
       SELECT *, date_sub('hour', last_loaded, TIMESTAMP '{NOW}') AS hours_since_load FROM ({LOADS_SQL}) l) h
       WHERE hours_since_load > max_hours""",
)
def _(m):
    return monitors.freshness_breaches(m.bronze, NOW)


@register(
    "source_freshness",
    f"""SELECT table_name, last_loaded, warn_hours, error_hours, date_sub('hour', last_loaded, TIMESTAMP '{NOW}') AS hours_since_load,
       CASE WHEN TIMESTAMP '{NOW}' > last_loaded + INTERVAL 1 HOUR * error_hours THEN 'error'
            WHEN TIMESTAMP '{NOW}' > last_loaded + INTERVAL 1 HOUR * warn_hours THEN 'warn' ELSE 'pass' END AS status
       FROM ({LOADS_SQL}) l""",
)
def _(m):
    return monitors.source_freshness(m.bronze, NOW)


@register(
    "mon_freshness_empty",
    f"""SELECT table_name, CAST(NULL AS TIMESTAMP) AS last_loaded, warn_hours, error_hours, CAST(NULL AS BIGINT) AS hours_since_load,
       'error' AS status FROM ({LOADS_SQL}) l""",
)
def _(m):
    """Tables that were never loaded."""
    return monitors.source_freshness({name: frame.filter("false") for name, frame in m.bronze.items()}, NOW)


@register(
    "mon_row_counts",
    """SELECT table_name, row_count, minimum_rows FROM (
       SELECT 'google_ads_campaigns' AS table_name, count(*) AS row_count, 10 AS minimum_rows FROM raw_google_ads WHERE CAST(_extracted_at AS DATE) = DATE '2024-01-01'
       UNION ALL SELECT 'meta_ads_insights', count(*), 10 FROM raw_meta_ads WHERE CAST(_extracted_at AS DATE) = DATE '2024-01-01'
       UNION ALL SELECT 'ga4_sessions', count(*), 100 FROM raw_ga4 WHERE CAST(_extracted_at AS DATE) = DATE '2024-01-01'
       UNION ALL SELECT 'mixpanel_events', count(*), 50 FROM raw_mixpanel_events WHERE CAST(_extracted_at AS DATE) = DATE '2024-01-01') c
       WHERE row_count < minimum_rows""",
)
def _(m):
    return monitors.row_count_breaches(m.bronze, date(2024, 1, 1))


def _ledger(m: Models) -> DataFrame:
    """The ledger after loads of four bronze tables, the events in two loads."""
    path = m.work("ledger")
    loads = [
        ("google_ads_campaigns", specs.GOOGLE_ADS, None),
        ("ga4_sessions", specs.GA4, None),
        ("mixpanel_events", specs.MIXPANEL_EVENTS, "second(time) < 20"),
        ("mixpanel_events", specs.MIXPANEL_EVENTS, "second(time) >= 20"),
        ("mixpanel_segmentation", specs.MIXPANEL_SEGMENTATION, None),
    ]
    for name, spec, part in loads:
        rows = m.bronze[name]
        if part is not None:
            rows = rows.filter(part)
        loading.load_source(rows, f"{path}/{name}", spec, ledger=f"{path}/ledger")
    return loading.read_ledger(m.spark, f"{path}/ledger")


LOADED = "'google_ads_campaigns', 'ga4_sessions', 'mixpanel_events', 'mixpanel_segmentation'"


@register(
    "mon_freshness_ledger",
    f"""SELECT table_name, last_loaded, warn_hours, error_hours, date_sub('hour', last_loaded, TIMESTAMP '{NOW}') AS hours_since_load,
       CASE WHEN last_loaded IS NULL OR TIMESTAMP '{NOW}' > last_loaded + INTERVAL 1 HOUR * error_hours THEN 'error'
            WHEN TIMESTAMP '{NOW}' > last_loaded + INTERVAL 1 HOUR * warn_hours THEN 'warn' ELSE 'pass' END AS status
       FROM (SELECT table_name, CASE WHEN table_name IN ({LOADED}) THEN last_loaded END AS last_loaded, warn_hours, error_hours FROM ({LOADS_SQL}) l) n""",
)
def _(m):
    """Freshness from the ledger that loads write; tables not loaded are errors."""
    return monitors.ledger_source_freshness(_ledger(m), NOW)


@register(
    "mon_row_counts_ledger",
    """SELECT table_name, row_count, CAST(minimum_rows AS INTEGER) AS minimum_rows FROM (
       SELECT 'google_ads_campaigns' AS table_name, count(DISTINCT (campaign_id, ad_group_id, date, device)) AS row_count, 1000000 AS minimum_rows
         FROM raw_google_ads WHERE CAST(_extracted_at AS DATE) = DATE '2024-01-16'
       UNION ALL SELECT 'mixpanel_events', count(*), 1000000 FROM raw_mixpanel_events WHERE CAST(_extracted_at AS DATE) = DATE '2024-01-16'
       UNION ALL SELECT 'mixpanel_segmentation', count(*), 0 FROM raw_mixpanel_segmentation
       UNION ALL SELECT 'meta_ads_insights', 0, 10) c
       WHERE row_count < minimum_rows""",
)
def _(m):
    """Rows loaded on one day, from the ledger; a table that was never loaded has none."""
    minimums = {"google_ads_campaigns": 1_000_000, "mixpanel_events": 1_000_000, "mixpanel_segmentation": 0, "meta_ads_insights": 10}
    return monitors.ledger_row_count_breaches(_ledger(m), date(2024, 1, 16), minimums)


WATCHED = {"fct_campaign_performance": ("date", ("campaign_id", "cvr", "roas")), "fct_revenue": ("order_date", ("order_date", "gross_revenue"))}


@register(
    "mon_null_rates",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) / nullif(CAST(count(*) AS DOUBLE), 0) AS null_rate,
        CAST(0 AS DOUBLE) AS max_rate, coalesce(count(*) FILTER (WHERE {c} IS NULL) / nullif(CAST(count(*) AS DOUBLE), 0) > 0, false) AS breached
        FROM {t} WHERE {day} = DATE '2024-01-15'"""
        for t, (day, columns) in WATCHED.items()
        for c in columns
    ),
    "null_rate max_rate",
)
def _(m):
    watched = {t: (day, dict.fromkeys(columns, 0.0)) for t, (day, columns) in WATCHED.items()}
    return monitors.null_rates(m.checked, DAY, watched)


@register(
    "mon_kpi_alerts",
    f"""SELECT date, channel_source AS subject, 'ctr' AS kpi, sum(total_clicks) / CAST(sum(total_impressions) AS DOUBLE) AS value, 0.005 AS threshold
       FROM fct_ad_spend_roi GROUP BY 1, 2 HAVING sum(total_clicks) / CAST(sum(total_impressions) AS DOUBLE) < 0.005
       UNION ALL SELECT date, channel_source, 'roas', sum(total_conversion_value) / sum(total_spend), 1.0
       FROM fct_ad_spend_roi GROUP BY 1, 2 HAVING sum(total_conversion_value) / nullif(sum(total_spend), 0) < 1.0
       UNION ALL SELECT DATE '{NOW.date()}', table_name, 'data_freshness_hours', hours, 4 FROM (
         SELECT table_name, date_sub('hour', last_loaded, TIMESTAMP '{NOW}') AS hours FROM ({LOADS_SQL}) l WHERE max_hours IS NOT NULL) h WHERE hours > 4
       UNION ALL SELECT DATE '{DAY}', subject, 'null_rate', rate, 0.05 FROM ("""
    + " UNION ALL ".join(
        f"""SELECT '{t}.{c}' AS subject, count(*) FILTER (WHERE {c} IS NULL) / nullif(CAST(count(*) AS DOUBLE), 0) AS rate
        FROM {t} WHERE {day} = DATE '{DAY}'"""
        for t, (day, columns) in WATCHED.items()
        for c in columns
    )
    + ") n WHERE rate > 0.05",
    "value threshold",
)
def _(m):
    return monitors.kpi_alerts(m.roi, m.bronze, m.checked, NOW, DAY, WATCHED)


# Expected conditions of failing rows: model, kind, column, condition. Uniqueness has no condition.
COLUMN_TESTS_SQL = [
    tuple(part.strip() for part in line.split("|"))
    for line in """
    stg_google_ads | not_null | campaign_id | campaign_id IS NULL
    stg_google_ads | not_null | date | date IS NULL
    stg_google_ads | accepted_range | impressions | impressions < 0
    stg_google_ads | accepted_range | cost_usd | cost_usd < 0
    stg_google_ads | accepted_range | roas | roas < 0
    stg_meta_ads | not_null | ad_id | ad_id IS NULL
    stg_meta_ads | not_null | date | date IS NULL
    stg_meta_ads | accepted_range | cost_usd | cost_usd < 0
    stg_ga4_sessions | not_null | date | date IS NULL
    stg_ga4_sessions | accepted_range | sessions | sessions < 0
    stg_hubspot_contacts | not_null | contact_id | contact_id IS NULL
    stg_hubspot_contacts | unique | contact_id |
    stg_shopify_orders | not_null | order_id | order_id IS NULL
    stg_shopify_orders | unique | order_id |
    stg_shopify_orders | accepted_range | gross_revenue | gross_revenue < 0
    stg_mixpanel_events | not_null | event_id | event_id IS NULL
    stg_mixpanel_events | not_null | event_name | event_name IS NULL
    stg_mixpanel_events | not_null | distinct_id | distinct_id IS NULL
    stg_mixpanel_events | not_null | event_date | event_date IS NULL
    stg_mixpanel_events | unique | event_id |
    stg_mixpanel_events | accepted_values | channel_normalized | channel_normalized NOT IN ('paid_search', 'paid_social', 'email', 'organic_search', 'referral', 'affiliate', 'display', 'direct', 'other')
    stg_mixpanel_segmentation | not_null | event_name | event_name IS NULL
    stg_mixpanel_segmentation | not_null | date | date IS NULL
    stg_mixpanel_segmentation | accepted_range | event_count | event_count < 0
    stg_mixpanel_funnels | not_null | funnel_id | funnel_id IS NULL
    stg_mixpanel_funnels | not_null | date | date IS NULL
    stg_mixpanel_funnels | not_null | step_index | step_index IS NULL
    stg_mixpanel_funnels | accepted_range | entered_count | entered_count < 0
    fct_campaign_performance | not_null | date | date IS NULL
    fct_campaign_performance | not_null | campaign_id | campaign_id IS NULL
    fct_campaign_performance | accepted_range | cost_usd | cost_usd < 0
    fct_campaign_performance | accepted_range | roas | roas < 0
    fct_ad_spend_roi | not_null | date | date IS NULL
    fct_ad_spend_roi | accepted_values | performance_tier | performance_tier NOT IN ('high_performer', 'mid_performer', 'break_even', 'underperformer')
    fct_funnel_conversion | not_null | week_start | week_start IS NULL
    fct_funnel_conversion | accepted_range | lead_to_mql_rate | lead_to_mql_rate NOT BETWEEN 0 AND 1
    fct_funnel_conversion | accepted_range | overall_conversion_rate | overall_conversion_rate NOT BETWEEN 0 AND 1
    fct_revenue | not_null | order_date | order_date IS NULL
    fct_revenue | accepted_range | gross_revenue | gross_revenue < 0
    fct_revenue | accepted_range | avg_order_value | avg_order_value < 0
    fct_attribution | not_null | date | date IS NULL
    fct_attribution | not_null | channel | channel IS NULL
    fct_mixpanel_events | not_null | event_date | event_date IS NULL
    fct_mixpanel_events | not_null | event_name | event_name IS NULL
    fct_mixpanel_events | not_null | channel_normalized | channel_normalized IS NULL
    fct_mixpanel_events | accepted_range | event_count | event_count < 0
    fct_mixpanel_events | accepted_range | unique_users | unique_users < 0
    fct_mixpanel_events | accepted_range | events_per_user | events_per_user < 0
    fct_mixpanel_funnel | not_null | date | date IS NULL
    fct_mixpanel_funnel | not_null | funnel_id | funnel_id IS NULL
    fct_mixpanel_funnel | not_null | step_index | step_index IS NULL
    fct_mixpanel_funnel | accepted_range | step_conversion_rate | step_conversion_rate NOT BETWEEN 0 AND 1
    fct_mixpanel_funnel | accepted_range | cumulative_drop_off_rate | cumulative_drop_off_rate NOT BETWEEN 0 AND 1
    fct_mixpanel_funnel | accepted_range | overall_funnel_conversion_rate | overall_funnel_conversion_rate NOT BETWEEN 0 AND 1
    fct_mixpanel_campaign_attribution | not_null | event_date | event_date IS NULL
    fct_mixpanel_campaign_attribution | not_null | channel_normalized | channel_normalized IS NULL
    fct_mixpanel_campaign_attribution | accepted_range | orders | orders < 0
    fct_mixpanel_campaign_attribution | accepted_range | cart_to_checkout_rate | cart_to_checkout_rate NOT BETWEEN 0 AND 1
    fct_mixpanel_campaign_attribution | accepted_range | checkout_to_order_rate | checkout_to_order_rate NOT BETWEEN 0 AND 1
    """.strip().splitlines()
]


def _column_tests_sql(kind: str | None = None) -> str:
    """Failing rows of the tests of one kind, or of all with the name of the kind."""
    parts = []
    for model_name, test, column, condition in COLUMN_TESTS_SQL:
        if kind not in (None, test):
            continue
        name = f"'{test}' AS test_name, " if kind is None else ""
        failing = f"count(*) FILTER (WHERE {condition})"
        rows = model_name
        if test == "unique":
            failing = "count(*)"
            rows = f"(SELECT {column} FROM {model_name} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) d"
        parts.append(f"SELECT '{model_name}' AS model_name, {name}'{column}' AS column_name, {failing} AS failing_rows FROM {rows}")
    return " UNION ALL ".join(parts)


@register("test_not_null", _column_tests_sql("not_null"))
def _(m):
    return schema_tests.summarize_not_null(m.tested)


@register("test_unique", _column_tests_sql("unique"))
def _(m):
    return schema_tests.summarize_unique(m.tested)


@register("test_accepted_values", _column_tests_sql("accepted_values"))
def _(m):
    return schema_tests.summarize_accepted_values(m.tested)


@register("test_accepted_range", _column_tests_sql("accepted_range"))
def _(m):
    return schema_tests.summarize_accepted_range(m.tested)


@register("test_all_columns", _column_tests_sql())
def _(m):
    """All kinds of tests, each model read once."""
    return schema_tests.check_models(m.tested)


# --- KPIs and business questions --------------------------------------------------------------


@register(
    "kpi_paid_media",
    """SELECT channel_source, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks, sum(cost_usd) AS cost,
       sum(clicks) / CAST(sum(impressions) AS DOUBLE) AS ctr, sum(cost_usd) / sum(clicks) AS cpc, 1000 * sum(cost_usd) / sum(impressions) AS cpm,
       sum(conversions) / sum(clicks) AS cvr, sum(cost_usd) / sum(conversions) AS cpa, sum(conversion_value_usd) / sum(cost_usd) AS roas,
       (sum(conversion_value_usd) - sum(cost_usd)) / sum(cost_usd) AS roi FROM fct_campaign_performance GROUP BY 1""",
    f"{SIX_RATIOS} roi",
    "cost",
)
def _(m):
    return kpi.kpi(m.performance, kpi.PAID_MEDIA, by=["channel_source"])


@register(
    "kpi_funnel",
    """SELECT original_source, count(DISTINCT contact_id) AS leads, count(*) FILTER (WHERE is_mql) AS mqls, count(*) FILTER (WHERE is_sql) AS sqls,
       count(*) FILTER (WHERE is_mql) / CAST(count(DISTINCT contact_id) AS DOUBLE) AS lead_to_mql_rate,
       count(*) FILTER (WHERE is_sql) / nullif(CAST(count(*) FILTER (WHERE is_mql) AS DOUBLE), 0) AS mql_to_sql_rate,
       count(*) FILTER (WHERE is_customer) / nullif(CAST(count(*) FILTER (WHERE is_sql) AS DOUBLE), 0) AS sql_to_customer_rate,
       count(*) FILTER (WHERE is_customer) / CAST(count(DISTINCT contact_id) AS DOUBLE) AS overall_conversion_rate
       FROM stg_hubspot_contacts GROUP BY 1""",
    "lead_to_mql_rate mql_to_sql_rate sql_to_customer_rate overall_conversion_rate",
)
def _(m):
    return kpi.kpi(m.contacts, kpi.FUNNEL, by=["original_source"])


@register(
    "kpi_revenue_web",
    """SELECT 'gross_revenue' AS kpi, sum(gross_revenue) AS value FROM daily_revenue
       UNION ALL SELECT 'net_revenue', sum(net_revenue) FROM daily_revenue
       UNION ALL SELECT 'aov', sum(gross_revenue) / sum(order_count) FROM daily_revenue
       UNION ALL SELECT 'revenue_mom_growth', arg_max(growth_rate, month_start) FROM revenue_yoy
       UNION ALL SELECT 'sessions', CAST(sum(sessions) AS DOUBLE) FROM stg_ga4_sessions
       UNION ALL SELECT 'bounce_rate', avg(bounce_rate) FROM stg_ga4_sessions
       UNION ALL SELECT 'engagement_rate', avg(engagement_rate) FROM stg_ga4_sessions""",
    money="value",
)
def _(m):
    return kpi.kpi_revenue_web(revenue.daily_revenue(m.orders), m.orders, m.sessions)


@register(
    "kpi_repeat_rate",
    """SELECT count(*) FILTER (WHERE n > 1) AS repeat_customers, count(*) AS customers,
       count(*) FILTER (WHERE n > 1) / nullif(CAST(count(*) AS DOUBLE), 0) AS repeat_rate
       FROM (SELECT customer_id, count(DISTINCT order_id) AS n FROM paid_orders WHERE customer_id IS NOT NULL GROUP BY 1) c""",
    "repeat_rate",
)
def _(m):
    return kpi.kpi_repeat_rate(m.orders)


@register(
    "kpi_ltv",
    """SELECT customer_id, sum(net_revenue) AS lifetime_value, count(DISTINCT order_id) AS orders FROM paid_orders
       WHERE customer_id IS NOT NULL GROUP BY 1""",
    money="lifetime_value",
)
def _(m):
    return kpi.kpi_ltv(m.orders)


@register(
    "biz_top_roas",
    """SELECT c.*, CASE WHEN roas >= 4 THEN 'high_performer' WHEN roas >= 2 THEN 'mid_performer' WHEN roas >= 1 THEN 'break_even'
       ELSE 'underperformer' END AS performance_tier
       FROM (SELECT channel_source, campaign_id, campaign_name, sum(total_spend) AS total_spend,
         sum(total_conversion_value) AS total_conversion_value, sum(total_conversion_value) / sum(total_spend) AS roas
         FROM fct_ad_spend_roi GROUP BY 1, 2, 3 HAVING sum(total_spend) >= 0.01) c
       ORDER BY roas DESC NULLS LAST, channel_source, campaign_id, campaign_name LIMIT 10""",
    "roas",
    "total_spend total_conversion_value",
)
def _(m):
    return questions.top_roas(m.roi)


@register(
    "biz_cost_per_customer",
    """SELECT s.*, w.customers, s.total_spend / nullif(w.customers, 0) AS cost_per_customer FROM (
         SELECT r.week_start, CASE r.channel_source WHEN 'google_ads' THEN 'paid_search' ELSE 'paid_social' END AS channel, sum(r.total_spend) AS total_spend
         FROM fct_ad_spend_roi r GROUP BY 1, 2) s
       LEFT JOIN (SELECT CAST(created_at AS DATE) - CAST(dayofweek(created_at) AS INTEGER) AS week_start, original_source AS channel,
         count(*) FILTER (WHERE is_customer) AS customers FROM contacts_january GROUP BY 1, 2) w
       ON w.week_start = s.week_start AND w.channel = s.channel""",
    "cost_per_customer",
    "total_spend",
)
def _(m):
    return questions.cost_per_customer(m.roi, m.funnel_conversion_january)


@register(
    "biz_leads_dropoff",
    """SELECT t.*, mqls / nullif(CAST(total_leads AS DOUBLE), 0) AS total_leads_to_mqls, sqls / nullif(CAST(mqls AS DOUBLE), 0) AS mqls_to_sqls,
       opportunities / nullif(CAST(sqls AS DOUBLE), 0) AS sqls_to_opportunities, customers / nullif(CAST(opportunities AS DOUBLE), 0) AS opportunities_to_customers
       FROM (SELECT channel, CAST(sum(total_leads) AS BIGINT) AS total_leads, CAST(sum(mqls) AS BIGINT) AS mqls, CAST(sum(sqls) AS BIGINT) AS sqls,
         CAST(sum(opportunities) AS BIGINT) AS opportunities, CAST(sum(customers) AS BIGINT) AS customers FROM fct_funnel_conversion GROUP BY 1) t""",
    "total_leads_to_mqls mqls_to_sqls sqls_to_opportunities opportunities_to_customers",
)
def _(m):
    return questions.leads_dropoff(m.funnel_conversion)


@register(
    "biz_channel_revenue",
    """SELECT coalesce(r.channel, s.channel) AS channel, r.last_touch_value, r.linear_value, s.session_revenue
       FROM channel_credit_report r FULL JOIN (SELECT channel, sum(attributed_revenue) AS session_revenue FROM fct_attribution_bridged GROUP BY 1) s
       ON s.channel = r.channel""",
    money="last_touch_value linear_value session_revenue",
)
def _(m):
    return questions.channel_revenue(m.raw("raw_touches"), m.attribution_bridged)


@register(
    "attribution_three_views",
    f"""SELECT coalesce(b.channel, t.channel) AS channel, b.last_touch_value, b.linear_value, b.session_revenue, t.tagged_conversions FROM (
       SELECT coalesce(r.channel, s.channel) AS channel, r.last_touch_value, r.linear_value, s.session_revenue
       FROM channel_credit_report r FULL JOIN (SELECT channel, sum(attributed_revenue) AS session_revenue FROM fct_attribution_bridged GROUP BY 1) s
       ON s.channel = r.channel) b
       FULL JOIN (SELECT e.channel_normalized AS channel, count(*) AS tagged_conversions FROM ({_asof_sql(30)}) a
         JOIN stg_mixpanel_events e ON e.event_id = a.touch_event_id GROUP BY 1) t ON t.channel = b.channel""",
    money="last_touch_value linear_value session_revenue",
)
def _(m):
    return questions.three_views(m.raw("raw_touches"), m.attribution_bridged, m.events)


@register(
    "biz_campaign_user_actions",
    """SELECT utm_campaign, event_name, CAST(sum(event_count) AS BIGINT) AS event_count, CAST(sum(unique_users) AS BIGINT) AS user_days
       FROM fct_mixpanel_events WHERE utm_campaign IS NOT NULL AND channel_normalized IN ('paid_search', 'paid_social', 'display', 'affiliate')
       GROUP BY 1, 2""",
)
def _(m):
    return questions.campaign_user_actions(m.daily_events)


@register(
    "biz_purchase_predictors",
    """SELECT a.action, CAST(sum(a.n) AS BIGINT) AS event_count, count(*) FILTER (WHERE n > 0) AS users_did,
       count(*) FILTER (WHERE n > 0 AND bought) AS users_did_bought, count(*) FILTER (WHERE n = 0) AS users_did_not,
       count(*) FILTER (WHERE n = 0 AND bought) AS users_did_not_bought,
       count(*) FILTER (WHERE n > 0 AND bought) / nullif(CAST(count(*) FILTER (WHERE n > 0) AS DOUBLE), 0) AS buy_rate_did,
       count(*) FILTER (WHERE n = 0 AND bought) / nullif(CAST(count(*) FILTER (WHERE n = 0) AS DOUBLE), 0) AS buy_rate_did_not
       FROM (SELECT u.distinct_id, u.bought, p.action, coalesce(b.n, 0) AS n
         FROM (SELECT distinct_id, bool_or(event_name = 'Order Completed') AS bought FROM stg_mixpanel_events GROUP BY 1) u
         CROSS JOIN (SELECT 'Add to Cart' AS action UNION ALL SELECT 'Checkout Started') p
         LEFT JOIN (SELECT e.distinct_id, e.event_name AS action, count(*) AS n FROM stg_mixpanel_events e
           LEFT JOIN (SELECT distinct_id, min(event_timestamp) AS first_purchase FROM stg_mixpanel_events
             WHERE event_name = 'Order Completed' GROUP BY 1) f ON f.distinct_id = e.distinct_id
           WHERE f.first_purchase IS NULL OR e.event_timestamp < f.first_purchase GROUP BY 1, 2) b
         ON b.distinct_id IS NOT DISTINCT FROM u.distinct_id AND b.action = p.action) a
       GROUP BY 1""",
    "buy_rate_did buy_rate_did_not",
)
def _(m):
    return questions.purchase_predictors(m.events)


@register(
    "biz_time_to_convert",
    """SELECT funnel_id, funnel_name, step_index, step_label, CAST(sum(entered_count) AS BIGINT) AS entered_count,
       sum(avg_time_to_convert_hrs * entered_count) / nullif(sum(entered_count), 0) AS avg_hours_to_convert
       FROM fct_mixpanel_funnel GROUP BY 1, 2, 3, 4""",
    "avg_hours_to_convert",
)
def _(m):
    return questions.time_to_convert(m.event_funnel)


@register(
    "biz_reach",
    "SELECT channel_source, CAST(sum(impressions) AS BIGINT) AS impressions FROM fct_campaign_performance GROUP BY 1",
)
def _(m):
    return questions.reach(m.performance)


@register(
    "biz_buyer_origin",
    """SELECT coalesce(p.channel, s.channel) AS channel, p.impressions, p.clicks, p.total_spend, p.conversions,
       s.attributed_revenue, s.attributed_conversions FROM (
         SELECT CASE channel_source WHEN 'google_ads' THEN 'paid_search' ELSE 'paid_social' END AS channel, CAST(sum(impressions) AS BIGINT) AS impressions,
         CAST(sum(clicks) AS BIGINT) AS clicks, sum(cost_usd) AS total_spend, sum(conversions) AS conversions FROM fct_campaign_performance GROUP BY 1) p
       FULL JOIN (SELECT channel, sum(attributed_revenue) AS attributed_revenue, CAST(sum(attributed_conversions) AS BIGINT) AS attributed_conversions
         FROM fct_attribution_bridged GROUP BY 1) s ON s.channel = p.channel""",
    "conversions",
    "total_spend attributed_revenue",
)
def _(m):
    return questions.buyer_origin(m.performance, m.attribution_bridged)


# --- Streaming -----------------------------------------------------------------------------------


def _event_stream(m: Models) -> DataFrame:
    schema = m.table("events").schema
    return streams.read_event_stream(m.spark, m.sf_dir, schema, glob="events.parquet")


def _event_files(m: Models, *expressions: str, closing: str | None = None) -> DataFrame:
    """The events as files in shuffled order, one of which makes a batch.

    With ``closing``, the last file holds one row, years after all others by the column of that name.
    """
    path = m.work("event-files")
    rows = m.table("events").selectExpr(*expressions)
    rows.orderBy(F.xxhash64(*rows.columns)).repartition(4).write.parquet(path)
    if closing is not None:
        last = rows.agg((F.max(closing) + F.expr("INTERVAL 3 YEARS")).alias(closing))
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != closing]
        last.select(closing, *others).select(*rows.columns).write.mode("append").parquet(path)
    return streams.read_event_stream(m.spark, path, rows.schema, files_per_batch=1)


@register(
    "stream_event_dedupe",
    """SELECT CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS VARCHAR)
       ELSE md5(concat_ws('-', CAST(user_id AS VARCHAR), event_type, CAST(ts AS VARCHAR))) END AS insert_id,
       event_type AS event, CAST(user_id AS VARCHAR) AS distinct_id, ts AS time FROM events""",
)
def _(m):
    """Every event arrives once or twice, in any order and in several batches."""
    arriving = _event_files(
        m,
        "CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS STRING) END AS insert_id",
        "event_type AS event",
        "CAST(user_id AS STRING) AS distinct_id",
        "ts AS time",
        "CAST(ts AS DATE) AS event_date",
        "explode(CASE WHEN event_id % 4 = 0 THEN array(1, 2) ELSE array(1) END) AS copy",
    )
    path = m.work("stream-dedupe")
    streams.merge_events(arriving.drop("copy"), f"{path}/table", f"{path}/checkpoint")
    return m.spark.read.parquet(f"{path}/table").drop("event_date")


@register(
    "stream_daily_events",
    """SELECT event_date, event_name, channel_normalized, count(*) AS event_count FROM stg_mixpanel_events GROUP BY 1, 2, 3""",
)
def _(m):
    arriving = _event_stream(m).selectExpr(
        "CAST(user_id AS STRING) AS distinct_id",
        "CAST(ts AS TIMESTAMP) AS event_timestamp",
        """CASE event_type WHEN 'view' THEN 'Page Viewed' WHEN 'click' THEN 'Add to Cart' WHEN 'signup' THEN 'Signed Up'
           WHEN 'purchase' THEN 'Order Completed' ELSE 'Checkout Started' END AS event_name""",
        """CASE event_id % 6 WHEN 0 THEN 'Google' WHEN 1 THEN 'facebook' WHEN 2 THEN 'newsletter' WHEN 3 THEN ''
           WHEN 4 THEN 'partner' END AS utm_source""",
        """CASE event_id % 6 WHEN 0 THEN 'CPC' WHEN 1 THEN 'social' WHEN 2 THEN 'email' WHEN 3 THEN ''
           WHEN 4 THEN 'affiliate' END AS utm_medium""",
    ).withColumn("channel_normalized", channel_utm(F.col("utm_source"), F.col("utm_medium")))
    path = m.work("stream-daily")
    streams.upsert_into(
        streams.daily_counts(arriving),
        f"{path}/table",
        f"{path}/checkpoint",
        keys=["event_date", "event_name", "channel_normalized"],
        order=["event_count"],
        partition_field="event_date",
        output_mode="update",
    )
    # The user count of the stream is approximate, so it has no exact counterpart to compare with.
    return m.spark.read.parquet(f"{path}/table").drop("approx_users")


@register(
    "stream_closed_days",
    """SELECT event_date, event_name, channel_normalized, count(*) AS event_count, count(DISTINCT distinct_id) AS unique_users
       FROM stg_mixpanel_events GROUP BY 1, 2, 3""",
)
def _(m):
    """Exact users per day: events in any order in several batches, then one much later event that closes all their days."""
    name = """CASE event_type WHEN 'view' THEN 'Page Viewed' WHEN 'click' THEN 'Add to Cart' WHEN 'signup' THEN 'Signed Up'
           WHEN 'purchase' THEN 'Order Completed' ELSE 'Checkout Started' END AS event_name"""
    arriving = _event_files(
        m,
        "CAST(user_id AS STRING) AS distinct_id",
        "CAST(ts AS TIMESTAMP) AS event_timestamp",
        name,
        """CASE event_id % 6 WHEN 0 THEN 'Google' WHEN 1 THEN 'facebook' WHEN 2 THEN 'newsletter' WHEN 3 THEN ''
           WHEN 4 THEN 'partner' END AS utm_source""",
        """CASE event_id % 6 WHEN 0 THEN 'CPC' WHEN 1 THEN 'social' WHEN 2 THEN 'email' WHEN 3 THEN ''
           WHEN 4 THEN 'affiliate' END AS utm_medium""",
        closing="event_timestamp",
    ).withColumn("channel_normalized", channel_utm(F.col("utm_source"), F.col("utm_medium")))
    path = m.work("stream-closed")
    streams.append_to(streams.closed_daily_counts(arriving, "366 days"), f"{path}/table", f"{path}/checkpoint")
    return m.spark.read.parquet(f"{path}/table")


@register(
    "stream_upsert",
    """SELECT event_id AS insert_id, CAST(ts AS DATE) AS event_date, event_type AS event,
       CASE WHEN event_id % 4 = 0 THEN 2 ELSE 1 END AS version FROM events""",
)
def _(m):
    """A bronze table kept up to date by micro-batches; every fourth event arrives in two versions, in any order."""
    arriving = _event_files(
        m,
        "event_id AS insert_id",
        "CAST(ts AS DATE) AS event_date",
        "event_type AS event",
        "explode(CASE WHEN event_id % 4 = 0 THEN array(2, 1) ELSE array(1) END) AS version",
    )
    path = m.work("stream-upsert")
    streams.upsert_into(
        arriving,
        f"{path}/table",
        f"{path}/checkpoint",
        keys=["insert_id", "event_date"],
        order=["version"],
        partition_field="event_date",
    )
    return m.spark.read.parquet(f"{path}/table")
