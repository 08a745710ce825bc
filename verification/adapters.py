"""Bronze tables shaped from the given tables.

Each text runs in Spark and, with ``explode(sequence(`` spelled ``unnest(generate_series(``, in
DuckDB; ``{name}`` stands for a given table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

RAW_SQL = {
    "raw_google_ads": """
SELECT r.*, CAST(r.date AS TIMESTAMP) + INTERVAL 30 HOUR AS _extracted_at FROM (
SELECT CAST(l_suppkey AS STRING) AS campaign_id,
       'campaign ' || CAST(l_suppkey % 20 AS STRING) AS campaign_name,
       CASE WHEN l_suppkey % 5 = 0 THEN 'PAUSED' ELSE 'ENABLED' END AS campaign_status,
       CASE l_returnflag WHEN 'R' THEN 'SEARCH' WHEN 'A' THEN 'DISPLAY' ELSE 'VIDEO' END AS channel_type,
       CAST(l_partkey % 50 AS STRING) AS ad_group_id,
       'group ' || CAST(l_partkey % 50 AS STRING) AS ad_group_name,
       'ENABLED' AS ad_group_status,
       DATE '2024-01-01' + CAST((l_orderkey + l_partkey) % 30 AS INT) AS date,
       CASE l_linenumber % 3 WHEN 0 THEN 'DESKTOP' WHEN 1 THEN 'MOBILE' ELSE 'TABLET' END AS device,
       CASE WHEN l_orderkey % 23 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) * 100 END AS impressions,
       CASE WHEN l_orderkey % 23 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) % 7 END AS clicks,
       CASE WHEN l_orderkey % 29 = 0 THEN 0.0 ELSE l_quantity / 4.0 END AS cost,
       CAST(l_linenumber % 3 AS DOUBLE) AS conversions,
       CAST(l_orderkey % 64 AS DOUBLE) / 2.0 AS conversion_value,
       CAST(l_partkey % 11 AS BIGINT) AS video_views
FROM {lineitem} WHERE l_linestatus = 'O') r""",
    "raw_meta_ads": """
SELECT r.*, CAST(r.date_start AS TIMESTAMP) + INTERVAL 36 HOUR AS _extracted_at FROM (
SELECT CAST(l_suppkey AS STRING) AS campaign_id,
       'campaign ' || CAST(l_suppkey % 20 AS STRING) AS campaign_name,
       CAST(l_partkey % 40 AS STRING) AS adset_id,
       'adset ' || CAST(l_partkey % 40 AS STRING) AS adset_name,
       CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS ad_id,
       'ad' AS ad_name,
       DATE '2024-01-01' + CAST((l_orderkey + l_partkey) % 30 AS INT) AS date_start,
       CASE WHEN l_suppkey % 2 = 0 THEN 'CONVERSIONS' ELSE 'REACH' END AS objective,
       'AUCTION' AS buying_type,
       CAST(l_quantity AS BIGINT) * 80 AS impressions,
       CAST(l_quantity AS BIGINT) % 5 AS clicks,
       l_quantity / 8.0 AS spend,
       CAST(l_quantity AS BIGINT) * 40 AS reach,
       CAST(2.0 AS DOUBLE) AS frequency,
       CAST(l_partkey % 6 AS DOUBLE) AS action_link_click,
       CASE WHEN l_orderkey % 3 = 0 THEN CAST(l_linenumber AS DOUBLE) END AS action_purchase
FROM {lineitem} WHERE l_linestatus = 'F') r""",
    "raw_linkedin_ads": """
SELECT DATE '2024-01-01' + CAST(o_orderkey % 30 AS INT) AS date_start,
       'CAMPAIGN' AS pivot,
       CASE WHEN o_orderkey % 50 <> 0 THEN 'urn:li:sponsoredCampaign:' || CAST(o_custkey % 40 AS STRING) END AS pivot_value,
       CAST(floor(o_totalprice / 1000.0) AS BIGINT) AS impressions,
       CAST(o_orderkey % 9 AS BIGINT) AS clicks,
       CAST(floor(o_totalprice / 100.0) AS DOUBLE) / 4.0 AS cost,
       CAST(o_custkey % 3 AS BIGINT) AS one_click_leads,
       CAST(o_orderkey % 4 AS BIGINT) AS conversions,
       CAST(o_custkey % 5 AS BIGINT) AS video_views,
       CAST(o_custkey % 11 AS BIGINT) AS total_engagements,
       TIMESTAMP '2024-01-30 12:00:00' AS _extracted_at
FROM {orders}""",
    "raw_hubspot": """
SELECT CAST(c_custkey AS STRING) AS id,
       CASE WHEN c_custkey % 13 = 0 THEN 'companies' ELSE 'contacts' END AS object_type,
       upper(c_name) || '@EXAMPLE.COM' AS email,
       'First ' || CAST(c_custkey % 90 AS STRING) AS firstname,
       'Last ' || CAST(c_custkey % 70 AS STRING) AS lastname,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Lead' WHEN 'BUILDING' THEN CASE WHEN c_custkey % 2 = 0 THEN 'MQL' ELSE 'MarketingQualifiedLead' END
            WHEN 'FURNITURE' THEN 'SalesQualifiedLead' WHEN 'HOUSEHOLD' THEN 'Opportunity' ELSE 'Customer' END AS lifecyclestage,
       CASE WHEN c_custkey % 4 = 0 THEN 'OPEN' ELSE 'In_Progress' END AS hs_lead_status,
       CAST(c_nationkey AS STRING) AS hubspot_owner_id,
       CASE c_nationkey % 4 WHEN 0 THEN 'PAID_SEARCH' WHEN 1 THEN 'PAID_SOCIAL' WHEN 2 THEN 'ORGANIC_SEARCH' END AS hs_analytics_source,
       'detail ' || CAST(c_nationkey AS STRING) AS hs_analytics_source_data_1,
       CAST(c_custkey % 5 AS STRING) AS num_conversion_events,
       'Form ' || CAST(c_custkey % 3 AS STRING) AS recent_conversion_event_name,
       o.first_order AS createdate,
       o.last_order AS lastmodifieddate,
       TIMESTAMP '2024-01-31 03:00:00' AS _extracted_at
FROM {customer} LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
                         FROM {orders} GROUP BY o_custkey) o ON c_custkey = o.o_custkey""",
    "raw_hubspot_january": """
SELECT CAST(c_custkey AS STRING) AS id, 'contacts' AS object_type,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'lead' WHEN 'BUILDING' THEN 'mql'
            WHEN 'FURNITURE' THEN 'sql' WHEN 'HOUSEHOLD' THEN 'opportunity' ELSE 'customer' END AS lifecyclestage,
       CASE c_nationkey % 4 WHEN 0 THEN 'PAID_SEARCH' WHEN 1 THEN 'PAID_SOCIAL' WHEN 2 THEN 'ORGANIC_SEARCH' END AS hs_analytics_source,
       CAST(DATE '2024-01-01' + CAST(c_custkey % 24 AS INT) AS TIMESTAMP) AS createdate
FROM {customer}""",
    "raw_shopify": """
SELECT o_orderkey AS order_id, 'order' AS object_type, o_orderdate AS created_at, o_orderdate AS updated_at,
       'USER' || CAST(o_custkey AS STRING) || '@Example.com' AS email, o_custkey AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'paid' ELSE 'pending' END ELSE 'refunded' END AS financial_status,
       CASE WHEN o_orderkey % 3 = 0 THEN 'Fulfilled' END AS fulfillment_status,
       o_totalprice AS total_price, CAST(floor(o_totalprice / 1.25) AS DOUBLE) AS subtotal_price,
       CAST(floor(o_totalprice / 16.0) AS DOUBLE) AS total_tax,
       CAST(CASE WHEN o_orderkey % 4 = 0 THEN 12.5 ELSE 0.0 END AS DOUBLE) AS total_discounts,
       CASE WHEN o_custkey % 9 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'web' WHEN '2-HIGH' THEN 'pos' WHEN '3-MEDIUM' THEN 'shopify_draft_order' ELSE 'mobile' END AS source_name,
       'HTTPS://Ref.example/' || CAST(o_custkey % 6 AS STRING) AS referring_site,
       '/Landing/' || CAST(o_orderkey % 8 AS STRING) AS landing_site,
       CASE WHEN o_orderkey % 4 = 0 THEN 'SAVE10' ELSE '' END AS discount_codes,
       CAST(coalesce(li.n, 0) AS BIGINT) AS item_count,
       CASE WHEN o_orderkey % 17 = 0 THEN o_orderdate END AS cancelled_at,
       TIMESTAMP '2024-01-31 01:00:00' AS _extracted_at
FROM {orders} LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM {lineitem} GROUP BY l_orderkey) li ON o_orderkey = li.l_orderkey""",
    "raw_mixpanel_events": """
SELECT CASE event_type WHEN 'view' THEN 'Page Viewed' WHEN 'click' THEN 'Add to Cart' WHEN 'signup' THEN 'Signed Up'
            WHEN 'purchase' THEN 'Order Completed' ELSE 'Checkout Started' END AS event,
       CAST(user_id AS STRING) AS distinct_id,
       CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS STRING) END AS insert_id,
       ts AS time, CAST(ts AS DATE) AS event_date,
       CASE user_id % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'de' ELSE 'ph' END AS country_code,
       'City ' || CAST(user_id % 7 AS STRING) AS city,
       'Region ' || CAST(user_id % 4 AS STRING) AS region,
       CASE user_id % 2 WHEN 0 THEN 'Android' ELSE 'iOS' END AS os,
       CASE user_id % 3 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' ELSE 'Firefox' END AS browser,
       CAST(100 + user_id % 5 AS STRING) AS browser_version, 'Phone' AS device,
       CAST(320 + user_id % 4 * 160 AS BIGINT) AS screen_width, CAST(640 + user_id % 4 * 160 AS BIGINT) AS screen_height,
       CASE event_id % 6 WHEN 0 THEN 'Google' WHEN 1 THEN 'facebook' WHEN 2 THEN 'newsletter' WHEN 3 THEN '' WHEN 4 THEN 'partner' END AS utm_source,
       CASE event_id % 6 WHEN 0 THEN 'CPC' WHEN 1 THEN 'social' WHEN 2 THEN 'email' WHEN 3 THEN '' WHEN 4 THEN 'affiliate' END AS utm_medium,
       CASE WHEN event_id % 6 < 3 THEN 'campaign ' || CAST(event_id % 20 AS STRING) END AS utm_campaign,
       CASE WHEN event_id % 6 < 3 THEN 'Ad ' || CAST(event_id % 2 AS STRING) WHEN event_id % 6 = 3 THEN '' END AS utm_content,
       CASE event_id % 6 WHEN 0 THEN 'Shoes' WHEN 1 THEN '' END AS utm_term,
       'https://shop.example/p/' || CAST(event_id % 50 AS STRING) AS current_url,
       'https://search.example/' AS initial_referrer,
       'https://ref.example/' || CAST(user_id % 9 AS STRING) AS referrer, 'web' AS lib,
       props AS custom_properties,
       ts + INTERVAL 8 HOUR AS _extracted_at
FROM {events}""",
    "raw_ga4": """
SELECT r.*, CAST(r.sessions AS DOUBLE) / 64.0 AS bounceRate, CAST(r.newUsers AS DOUBLE) / 32.0 AS engagementRate,
       CAST(r.screenPageViews * 15 AS DOUBLE) AS averageSessionDuration,
       r.sessions - r.newUsers AS engagedSessions,
       CAST(r.date AS TIMESTAMP) + INTERVAL 40 HOUR AS _extracted_at FROM (
SELECT CAST(ts AS DATE) AS date,
       CASE user_id % 4 WHEN 0 THEN 'google' WHEN 1 THEN 'facebook' WHEN 2 THEN '(direct)' ELSE 'news' END AS sessionSource,
       CASE user_id % 4 WHEN 0 THEN 'cpc' WHEN 1 THEN 'social' WHEN 2 THEN '(none)' ELSE 'referral' END AS sessionMedium,
       'campaign ' || CAST(user_id % 20 AS STRING) AS sessionCampaignName,
       CASE WHEN user_id % 40 < 20 THEN 'Mobile' ELSE 'Desktop' END AS deviceCategory,
       'Country ' || CAST(user_id % 3 AS STRING) AS country,
       '/p/' || CAST(user_id % 8 AS STRING) AS landingPage,
       CASE user_id % 4 WHEN 0 THEN 'Paid Search' WHEN 1 THEN 'Paid Social' WHEN 2 THEN 'Direct' ELSE CASE WHEN user_id % 5 = 0 THEN 'Organic Social' ELSE 'Referral' END END AS sessionDefaultChannelGroup,
       count(*) AS sessions, count(DISTINCT user_id) AS activeUsers,
       count(CASE WHEN event_type = 'signup' THEN 1 END) AS newUsers,
       count(CASE WHEN event_type = 'view' THEN 1 END) AS screenPageViews,
       count(CASE WHEN event_type = 'purchase' THEN 1 END) AS conversions,
       round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END), 2) AS totalRevenue
FROM {events} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8) r""",
    "raw_touches": """
SELECT user_id AS customer_id, event_id AS touch_id, ts AS session_date,
       CASE event_id % 4 WHEN 0 THEN 'paid_search' WHEN 1 THEN 'paid_social' WHEN 2 THEN 'email' END AS channel,
       CASE event_id % 5 WHEN 0 THEN 'google' WHEN 1 THEN 'facebook' ELSE 'news' END AS source,
       'm' || CAST(event_id % 3 AS STRING) AS medium,
       'campaign ' || CAST(event_id % 20 AS STRING) AS campaign,
       CASE WHEN event_type = 'purchase' THEN event_id END AS order_id,
       CASE WHEN event_type = 'purchase' THEN value END AS order_value,
       event_type = 'purchase' AS is_conversion
FROM {events}""",
    "raw_stage_events": """
SELECT user_id AS customer_id, CAST(ts AS DATE) AS event_date,
       CASE WHEN user_id % 6 = 0 THEN 'visitor' WHEN event_type = 'view' THEN 'visitor' WHEN event_type = 'click' THEN 'lead'
            WHEN user_id % 6 <= 2 THEN 'lead' WHEN event_type = 'signup' THEN 'mql' WHEN user_id % 6 = 3 THEN 'mql'
            WHEN event_type = 'error' THEN 'sql' WHEN user_id % 6 = 4 THEN 'opportunity' ELSE 'customer' END AS stage,
       CASE event_id % 3 WHEN 0 THEN 'paid_search' WHEN 1 THEN 'email' ELSE 'direct' END AS channel
FROM {events}""",
    "raw_mixpanel_funnels": """
SELECT date, CAST(101 AS BIGINT) AS funnel_id, 'purchase_funnel' AS funnel_name, CAST(step AS INT) AS step_index,
       CASE step WHEN 0 THEN 'Page Viewed' WHEN 1 THEN 'Add to Cart' WHEN 2 THEN 'Checkout Started' ELSE 'Order Completed' END AS step_label,
       CASE step WHEN 0 THEN views WHEN 1 THEN clicks WHEN 2 THEN errors ELSE purchases END AS count,
       CAST(1 AS DOUBLE) / CAST(1 + step AS DOUBLE) AS conversion_rate,
       CAST(step * 600 AS DOUBLE) AS avg_time_to_convert_sec,
       purchases AS goal_count,
       CAST(0.25 AS DOUBLE) AS goal_conversion_rate,
       TIMESTAMP '2024-01-29 09:00:00' AS _extracted_at
FROM (SELECT d.*, explode(sequence(0, 3)) AS step FROM (
  SELECT CAST(ts AS DATE) AS date, count(CASE WHEN event_type = 'view' THEN 1 END) AS views,
         count(CASE WHEN event_type = 'click' THEN 1 END) AS clicks, count(CASE WHEN event_type = 'error' THEN 1 END) AS errors,
         count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases
  FROM {events} GROUP BY 1) d) x""",
    "raw_mixpanel_segmentation": """
SELECT CAST(ts AS DATE) AS date, event_type AS event, CASE WHEN event_type = 'error' THEN 'os' ELSE 'utm_source' END AS segment_property,
       CASE event_id % 5 WHEN 0 THEN 'Google' WHEN 1 THEN 'facebook' WHEN 2 THEN 'email' WHEN 3 THEN '' ELSE 'Partner' END AS segment_value,
       count(*) AS event_count,
       TIMESTAMP '2024-01-31 05:00:00' AS _extracted_at
FROM {events} GROUP BY 1, 2, 3, 4""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, name: str, read: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """A bronze table shaped from the given tables, which ``read`` may provide."""
    sql = RAW_SQL[name]
    used = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{t: read(t) if read else table(spark, sf_dir, t) for t in used})
