"""Expected results of the silver and gold models, as SQL over the bronze adapters.

``compose`` puts every model a query refers to in front of it as a WITH clause.
"""

from __future__ import annotations

import re

from verification.adapters import RAW_SQL

GIVEN_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

MODELS = {
    "stg_google_ads": """
SELECT campaign_id, ad_group_id, date, lower(device) AS device, campaign_name,
       lower(campaign_status) AS campaign_status, lower(channel_type) AS channel_type, ad_group_name,
       lower(ad_group_status) AS ad_group_status, CAST(coalesce(impressions, 0) AS BIGINT) AS impressions,
       CAST(coalesce(clicks, 0) AS BIGINT) AS clicks, coalesce(cost, 0.0) AS cost_usd,
       coalesce(conversions, 0.0) AS conversions, coalesce(conversion_value, 0.0) AS conversion_value_usd,
       coalesce(video_views, 0) AS video_views,
       clicks / nullif(CAST(impressions AS DOUBLE), 0) AS ctr, cost / nullif(CAST(clicks AS DOUBLE), 0) AS cpc,
       1000 * (cost / nullif(CAST(impressions AS DOUBLE), 0)) AS cpm,
       conversions / nullif(CAST(clicks AS DOUBLE), 0) AS cvr, cost / nullif(conversions, 0) AS cpa,
       conversion_value / nullif(CAST(cost AS DOUBLE), 0) AS roas, _extracted_at, 'google_ads' AS channel_source
FROM raw_google_ads WHERE date IS NOT NULL AND campaign_id IS NOT NULL""",
    "stg_meta_ads": """
SELECT campaign_id, adset_id, ad_id, date_start AS date, campaign_name, adset_name AS ad_set_name, ad_name,
       lower(objective) AS objective, lower(buying_type) AS buying_type, impressions, clicks, spend AS cost_usd,
       reach, frequency, coalesce(action_link_click, 0.0) AS link_clicks, coalesce(action_purchase, 0.0) AS purchases,
       CAST(0 AS DOUBLE) AS leads, CAST(0 AS DOUBLE) AS add_to_cart, CAST(0 AS DOUBLE) AS view_content,
       CAST(0 AS DOUBLE) AS initiate_checkout, clicks / nullif(CAST(impressions AS DOUBLE), 0) AS ctr,
       spend / nullif(CAST(clicks AS DOUBLE), 0) AS cpc, 1000 * (spend / nullif(CAST(impressions AS DOUBLE), 0)) AS cpm,
       _extracted_at, 'meta_ads' AS channel_source
FROM raw_meta_ads WHERE date_start IS NOT NULL AND ad_id IS NOT NULL""",
    "stg_linkedin_ads": """
SELECT pivot_value AS campaign_id, date_start AS date, lower("pivot") AS "pivot", impressions, clicks, cost AS cost_usd,
       CAST(conversions AS DOUBLE) AS conversions, one_click_leads AS leads, video_views, total_engagements AS engagements,
       clicks / nullif(CAST(impressions AS DOUBLE), 0) AS ctr, cost / nullif(CAST(clicks AS DOUBLE), 0) AS cpc,
       1000 * (cost / nullif(CAST(impressions AS DOUBLE), 0)) AS cpm, _extracted_at, 'linkedin_ads' AS channel_source
FROM raw_linkedin_ads WHERE date_start IS NOT NULL AND pivot_value IS NOT NULL""",
    "stg_ga4_sessions": """
SELECT date, sessionSource AS session_source, sessionMedium AS session_medium, sessionCampaignName AS campaign_name,
       lower(deviceCategory) AS device_category, country, landingPage AS landing_page,
       sessionDefaultChannelGroup AS default_channel_group, sessions, activeUsers AS active_users, newUsers AS new_users,
       screenPageViews AS page_views, engagedSessions AS engaged_sessions, conversions, totalRevenue AS revenue_usd,
       bounceRate AS bounce_rate, engagementRate AS engagement_rate, averageSessionDuration AS avg_session_duration_sec,
       sessions / nullif(CAST(activeUsers AS DOUBLE), 0) AS sessions_per_user,
       conversions / nullif(CAST(sessions AS DOUBLE), 0) AS conversion_rate,
       CASE WHEN sessionDefaultChannelGroup ILIKE '%paid search%' THEN 'paid_search'
            WHEN sessionDefaultChannelGroup ILIKE '%paid social%' THEN 'paid_social'
            WHEN sessionDefaultChannelGroup ILIKE '%organic%' THEN 'organic_search'
            WHEN sessionDefaultChannelGroup ILIKE '%email%' THEN 'email'
            WHEN sessionDefaultChannelGroup ILIKE '%direct%' THEN 'direct'
            WHEN sessionDefaultChannelGroup ILIKE '%referral%' THEN 'referral'
            WHEN sessionDefaultChannelGroup ILIKE '%display%' THEN 'display' ELSE 'other' END AS channel_normalized,
       _extracted_at, 'google_analytics_4' AS channel_source
FROM raw_ga4 WHERE date IS NOT NULL""",
    "stg_hubspot_contacts": """
SELECT id AS contact_id, lower(email) AS email, firstname AS first_name, lastname AS last_name,
       lower(lifecyclestage) AS lifecycle_stage, lower(hs_lead_status) AS lead_status, hubspot_owner_id AS owner_id,
       lower(hs_analytics_source) AS original_source, hs_analytics_source_data_1 AS original_source_detail,
       createdate AS created_at, lastmodifieddate AS updated_at, num_conversion_events, recent_conversion_event_name,
       lower(lifecyclestage) IN ('mql', 'marketingqualifiedlead') AS is_mql,
       lower(lifecyclestage) IN ('sql', 'salesqualifiedlead') AS is_sql,
       lower(lifecyclestage) = 'opportunity' AS is_opportunity, lower(lifecyclestage) = 'customer' AS is_customer,
       _extracted_at
FROM raw_hubspot WHERE object_type IN ('contact', 'contacts') AND id IS NOT NULL""",
    "contacts_january": """
SELECT id AS contact_id, createdate AS created_at, lower(hs_analytics_source) AS original_source,
       lifecyclestage = 'mql' AS is_mql, lifecyclestage = 'sql' AS is_sql,
       lifecyclestage = 'opportunity' AS is_opportunity, lifecyclestage = 'customer' AS is_customer
FROM raw_hubspot_january""",
    "stg_shopify_orders": """
SELECT CAST(order_id AS VARCHAR) AS order_id, created_at AS order_date, updated_at, lower(email) AS customer_email,
       CAST(customer_id AS VARCHAR) AS customer_id, lower(financial_status) AS financial_status,
       lower(fulfillment_status) AS fulfillment_status, total_price AS gross_revenue, subtotal_price AS subtotal_revenue,
       total_tax AS tax_amount, total_discounts AS discount_amount, total_price - total_tax AS net_revenue, currency,
       item_count, discount_codes, source_name, lower(referring_site) AS referring_site,
       lower(landing_site) AS landing_page, cancelled_at IS NOT NULL AS is_cancelled, financial_status = 'paid' AS is_paid,
       CASE WHEN total_discounts > 0 THEN 'discounted' ELSE 'full_price' END AS order_type, _extracted_at
FROM raw_shopify WHERE object_type = 'order' AND order_id IS NOT NULL AND financial_status <> 'refunded'""",
    "stg_mixpanel_events": """
SELECT coalesce(insert_id, md5(concat_ws('-', distinct_id, event, CAST(time AS VARCHAR)))) AS event_id,
       event AS event_name, distinct_id, time AS event_timestamp, event_date, CAST(hour(time) AS INTEGER) AS event_hour,
       upper(country_code) AS country_code, city, region AS region_name, lower(os) AS operating_system,
       lower(browser) AS browser, browser_version, lower(device) AS device_type, screen_width, screen_height,
       nullif(lower(utm_source), '') AS utm_source, nullif(lower(utm_medium), '') AS utm_medium,
       nullif(lower(utm_campaign), '') AS utm_campaign, nullif(lower(utm_content), '') AS utm_content,
       nullif(lower(utm_term), '') AS utm_term,
       CASE WHEN lower(utm_medium) IN ('cpc', 'ppc', 'paidsearch') THEN 'paid_search'
            WHEN lower(utm_medium) IN ('paid_social', 'social_paid', 'cpm', 'cpv')
              OR lower(utm_source) IN ('facebook', 'instagram', 'linkedin', 'twitter', 'tiktok', 'meta') THEN 'paid_social'
            WHEN lower(utm_medium) = 'organic' THEN 'organic_search'
            WHEN lower(utm_medium) IN ('email', 'referral', 'affiliate', 'display') THEN lower(utm_medium)
            WHEN coalesce(utm_source, utm_medium) IS NULL THEN 'direct' ELSE 'other' END AS channel_normalized,
       current_url, initial_referrer, referrer, lib AS sdk_library, custom_properties, _extracted_at
FROM raw_mixpanel_events WHERE event IS NOT NULL AND distinct_id IS NOT NULL AND time IS NOT NULL""",
    "stg_mixpanel_segmentation": """
SELECT date, event AS event_name, segment_property, nullif(lower(segment_value), '') AS segment_value, event_count,
       CASE WHEN segment_property <> 'utm_source' THEN NULL
            WHEN lower(segment_value) IN ('google', 'bing') THEN 'paid_search'
            WHEN lower(segment_value) IN ('facebook', 'instagram', 'linkedin', 'twitter', 'tiktok', 'meta') THEN 'paid_social'
            ELSE lower(segment_value) END AS channel_normalized, _extracted_at
FROM raw_mixpanel_segmentation WHERE date IS NOT NULL AND event IS NOT NULL""",
    "stg_mixpanel_funnels": """
SELECT date, CAST(funnel_id AS VARCHAR) AS funnel_id, funnel_name, CAST(step_index AS BIGINT) AS step_index, step_label,
       count AS entered_count, conversion_rate AS step_conversion_rate, avg_time_to_convert_sec,
       goal_count AS goal_completions, goal_conversion_rate AS overall_funnel_conversion_rate,
       1.0 / nullif(avg_time_to_convert_sec, 0) AS time_to_convert_inverse, _extracted_at
FROM raw_mixpanel_funnels WHERE date IS NOT NULL AND funnel_id IS NOT NULL""",
    "fct_campaign_performance": """
SELECT u.*, u.date - CAST(dayofweek(u.date) AS INTEGER) AS week_start, CAST(date_trunc('month', u.date) AS DATE) AS month_start,
       CAST(year(u.date) AS INTEGER) AS year, CAST(month(u.date) AS INTEGER) AS month,
       CAST(strftime(u.date, '%U') AS INTEGER) AS week_of_year
FROM (SELECT date, campaign_id, campaign_name, ad_group_id, ad_group_name, channel_type AS campaign_type, device,
             CAST(NULL AS VARCHAR) AS objective, impressions, clicks, cost_usd, conversions, conversion_value_usd,
             video_views, ctr, cpc, cpm, cvr, cpa, roas, channel_source FROM stg_google_ads
      UNION ALL
      SELECT date, campaign_id, campaign_name, adset_id, ad_set_name, NULL, NULL, objective, impressions, clicks, cost_usd,
             purchases, NULL, NULL, ctr, cpc, cpm, NULL, NULL, NULL, channel_source FROM stg_meta_ads) u""",
    "fct_ad_spend_roi": """
SELECT s.*, total_clicks / nullif(CAST(total_impressions AS DOUBLE), 0) AS ctr,
       total_spend / nullif(CAST(total_clicks AS DOUBLE), 0) AS cpc,
       1000 * (total_spend / nullif(CAST(total_impressions AS DOUBLE), 0)) AS cpm,
       total_conversions / nullif(CAST(total_clicks AS DOUBLE), 0) AS cvr,
       total_spend / nullif(total_conversions, 0) AS cpa, total_conversion_value / nullif(total_spend, 0) AS roas,
       (total_conversion_value - total_spend) / nullif(total_spend, 0) AS roi,
       CASE WHEN total_conversion_value / nullif(total_spend, 0) >= 4 THEN 'high_performer'
            WHEN total_conversion_value / nullif(total_spend, 0) >= 2 THEN 'mid_performer'
            WHEN total_conversion_value / nullif(total_spend, 0) >= 1 THEN 'break_even'
            ELSE 'underperformer' END AS performance_tier
FROM (SELECT date, week_start, month_start, channel_source, campaign_id, campaign_name, sum(cost_usd) AS total_spend,
             sum(conversion_value_usd) AS total_conversion_value, sum(conversions) AS total_conversions,
             CAST(sum(impressions) AS BIGINT) AS total_impressions, CAST(sum(clicks) AS BIGINT) AS total_clicks
      FROM fct_campaign_performance GROUP BY ALL) s""",
    "fct_mixpanel_events": """
SELECT event_date, event_date - CAST(dayofweek(event_date) AS INTEGER) AS week_start,
       CAST(date_trunc('month', event_date) AS DATE) AS month_start, event_name, channel_normalized, utm_source, utm_medium,
       utm_campaign, utm_content, country_code, operating_system, device_type, count(*) AS event_count,
       count(DISTINCT distinct_id) AS unique_users, count(*) / CAST(count(DISTINCT distinct_id) AS DOUBLE) AS events_per_user
FROM stg_mixpanel_events GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12""",
    "campaign_conversions": """
SELECT event_date, utm_campaign, utm_source, utm_medium, channel_normalized,
       CAST(coalesce(sum(event_count) FILTER (WHERE event_name = 'Order Completed'), 0) AS BIGINT) AS orders,
       CAST(coalesce(sum(event_count) FILTER (WHERE event_name = 'Lead Form Submitted'), 0) AS BIGINT) AS leads,
       CAST(coalesce(sum(event_count) FILTER (WHERE event_name = 'Demo Requested'), 0) AS BIGINT) AS demo_requests,
       CAST(coalesce(sum(event_count) FILTER (WHERE event_name = 'Signed Up'), 0) AS BIGINT) AS signups,
       CAST(coalesce(sum(event_count) FILTER (WHERE event_name = 'Checkout Started'), 0) AS BIGINT) AS checkout_starts,
       CAST(coalesce(sum(event_count) FILTER (WHERE event_name = 'Add to Cart'), 0) AS BIGINT) AS add_to_carts,
       CAST(coalesce(sum(event_count) FILTER (WHERE event_name = 'Page Viewed'), 0) AS BIGINT) AS page_views,
       CAST(sum(unique_users) AS BIGINT) AS total_unique_users, CAST(sum(event_count) AS BIGINT) AS total_events
FROM fct_mixpanel_events WHERE utm_campaign IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
    "channel_spend": """
SELECT date, campaign_name, CASE channel_source WHEN 'google_ads' THEN 'paid_search' ELSE 'paid_social' END AS channel,
       total_spend FROM fct_ad_spend_roi""",
    "fct_mixpanel_campaign_attribution": """
SELECT c.*, s.total_spend, s.total_spend / nullif(c.orders, 0) AS cpa_orders, s.total_spend / nullif(c.leads, 0) AS cpa_leads,
       s.total_spend / nullif(c.signups, 0) AS cpa_signups,
       c.checkout_starts / nullif(CAST(c.add_to_carts AS DOUBLE), 0) AS cart_to_checkout_rate,
       c.orders / nullif(CAST(c.checkout_starts AS DOUBLE), 0) AS checkout_to_order_rate,
       c.orders / nullif(CAST(c.page_views AS DOUBLE), 0) AS page_to_order_rate
FROM campaign_conversions c LEFT JOIN (
  SELECT date, campaign_name, channel_source, sum(total_spend) AS total_spend FROM fct_ad_spend_roi GROUP BY 1, 2, 3) s
  ON s.date = c.event_date AND s.campaign_name = c.utm_campaign AND s.channel_source = c.channel_normalized""",
    "fct_mixpanel_campaign_attribution_bridged": """
SELECT c.*, s.total_spend, s.total_spend / nullif(c.orders, 0) AS cpa_orders, s.total_spend / nullif(c.leads, 0) AS cpa_leads,
       s.total_spend / nullif(c.signups, 0) AS cpa_signups,
       c.checkout_starts / nullif(CAST(c.add_to_carts AS DOUBLE), 0) AS cart_to_checkout_rate,
       c.orders / nullif(CAST(c.checkout_starts AS DOUBLE), 0) AS checkout_to_order_rate,
       c.orders / nullif(CAST(c.page_views AS DOUBLE), 0) AS page_to_order_rate
FROM campaign_conversions c LEFT JOIN (
  SELECT date, lower(campaign_name) AS name, channel, sum(total_spend) AS total_spend FROM channel_spend GROUP BY 1, 2, 3) s
  ON s.date = c.event_date AND s.name = c.utm_campaign AND s.channel = c.channel_normalized""",
    "fct_funnel_conversion": """
SELECT w.*, mqls / nullif(CAST(total_leads AS DOUBLE), 0) AS lead_to_mql_rate, sqls / nullif(CAST(mqls AS DOUBLE), 0) AS mql_to_sql_rate,
       opportunities / nullif(CAST(sqls AS DOUBLE), 0) AS sql_to_opp_rate,
       customers / nullif(CAST(opportunities AS DOUBLE), 0) AS opp_to_customer_rate,
       customers / nullif(CAST(total_leads AS DOUBLE), 0) AS overall_conversion_rate
FROM (SELECT CAST(created_at AS DATE) - CAST(dayofweek(created_at) AS INTEGER) AS week_start, original_source AS channel,
             count(DISTINCT contact_id) AS total_leads, count(*) FILTER (WHERE is_mql) AS mqls, count(*) FILTER (WHERE is_sql) AS sqls,
             count(*) FILTER (WHERE is_opportunity) AS opportunities, count(*) FILTER (WHERE is_customer) AS customers
      FROM stg_hubspot_contacts WHERE created_at IS NOT NULL GROUP BY 1, 2) w""",
    "fct_mixpanel_funnel": """
SELECT s.date, s.date - CAST(dayofweek(s.date) AS INTEGER) AS week_start, CAST(date_trunc('month', s.date) AS DATE) AS month_start,
       s.funnel_id, s.funnel_name, s.step_index, s.step_label, s.entered_count, s.step_conversion_rate, s.avg_time_to_convert_sec,
       s.avg_time_to_convert_sec / 60 AS avg_time_to_convert_min, s.avg_time_to_convert_sec / 3600 AS avg_time_to_convert_hrs,
       s.goal_completions, s.overall_funnel_conversion_rate,
       (top.entered_count - s.entered_count) / nullif(CAST(top.entered_count AS DOUBLE), 0) AS cumulative_drop_off_rate,
       top.entered_count AS top_of_funnel_count
FROM stg_mixpanel_funnels s LEFT JOIN stg_mixpanel_funnels top
  ON top.step_index = 0 AND top.date = s.date AND top.funnel_id = s.funnel_id""",
    "paid_orders": "SELECT * FROM stg_shopify_orders WHERE is_paid AND NOT is_cancelled",
    "daily_revenue": """
SELECT CAST(order_date AS DATE) AS order_date, CAST(order_date AS DATE) - CAST(dayofweek(order_date) AS INTEGER) AS week_start,
       CAST(date_trunc('month', order_date) AS DATE) AS month_start, CAST(year(order_date) AS INTEGER) AS year, currency,
       source_name AS traffic_source, order_type, count(DISTINCT order_id) AS order_count,
       count(DISTINCT customer_id) AS unique_customers, sum(gross_revenue) AS gross_revenue, sum(net_revenue) AS net_revenue,
       sum(discount_amount) AS total_discounts, sum(tax_amount) AS total_taxes, CAST(sum(item_count) AS BIGINT) AS total_items,
       avg(gross_revenue) AS avg_order_value, avg(item_count) AS avg_items_per_order,
       sum(discount_amount) / nullif(sum(gross_revenue), 0) AS discount_rate
FROM paid_orders GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "fct_revenue": """
SELECT p.*, (gross_revenue - prev_month_revenue) / nullif(prev_month_revenue, 0) AS revenue_mom_growth_rate
FROM (SELECT *, lag(gross_revenue) OVER (PARTITION BY month(order_date)
        ORDER BY month_start, order_date, currency, traffic_source, order_type) AS prev_month_revenue FROM daily_revenue) p""",
    "monthly_revenue": """
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_start, sum(gross_revenue) AS gross_revenue FROM paid_orders GROUP BY 1""",
    "revenue_mom": """
SELECT m.*, (gross_revenue - previous_revenue) / nullif(previous_revenue, 0) AS growth_rate
FROM (SELECT *, lag(gross_revenue) OVER (ORDER BY month_start) AS previous_revenue FROM monthly_revenue) m""",
    "revenue_yoy": """
SELECT m.*, (gross_revenue - previous_revenue) / nullif(previous_revenue, 0) AS growth_rate
FROM (SELECT *, lag(gross_revenue) OVER (PARTITION BY month(month_start) ORDER BY month_start) AS previous_revenue
      FROM monthly_revenue) m""",
    "channel_sessions": """
SELECT date, channel_normalized AS channel, session_source AS source, session_medium AS medium, campaign_name,
       sum(revenue_usd) AS attributed_revenue, CAST(sum(conversions) AS BIGINT) AS attributed_conversions,
       CAST(sum(sessions) AS BIGINT) AS sessions
FROM stg_ga4_sessions GROUP BY 1, 2, 3, 4, 5""",
    "fct_attribution": """
SELECT c.*, s.total_spend, c.attributed_revenue / nullif(s.total_spend, 0) AS attributed_roas
FROM channel_sessions c LEFT JOIN (SELECT date, channel_source, sum(total_spend) AS total_spend FROM fct_ad_spend_roi GROUP BY 1, 2) s
  ON s.date = c.date AND s.channel_source = c.channel""",
    "fct_attribution_bridged": """
SELECT c.*, s.total_spend, c.attributed_revenue / nullif(s.total_spend, 0) AS attributed_roas
FROM channel_sessions c LEFT JOIN (SELECT date, channel, sum(total_spend) AS total_spend FROM channel_spend GROUP BY 1, 2) s
  ON s.date = c.date AND s.channel = c.channel""",
    "last_touch": """
SELECT customer_id,
       arg_max(channel, (session_date IS NULL, session_date, touch_id)) FILTER (WHERE channel IS NOT NULL) AS last_touch_channel,
       arg_max(source, (session_date IS NULL, session_date, touch_id)) FILTER (WHERE source IS NOT NULL) AS last_touch_source,
       arg_max(medium, (session_date IS NULL, session_date, touch_id)) FILTER (WHERE medium IS NOT NULL) AS last_touch_medium,
       arg_max(campaign, (session_date IS NULL, session_date, touch_id)) FILTER (WHERE campaign IS NOT NULL) AS last_touch_campaign
FROM raw_touches WHERE customer_id IS NOT NULL GROUP BY 1""",
    "first_touch": """
SELECT customer_id,
       arg_min(channel, (session_date IS NULL, session_date, touch_id)) FILTER (WHERE channel IS NOT NULL) AS first_touch_channel,
       arg_min(source, (session_date IS NULL, session_date, touch_id)) FILTER (WHERE source IS NOT NULL) AS first_touch_source,
       arg_min(medium, (session_date IS NULL, session_date, touch_id)) FILTER (WHERE medium IS NOT NULL) AS first_touch_medium,
       arg_min(campaign, (session_date IS NULL, session_date, touch_id)) FILTER (WHERE campaign IS NOT NULL) AS first_touch_campaign
FROM raw_touches WHERE customer_id IS NOT NULL GROUP BY 1""",
    "linear_attribution": """
SELECT customer_id, channel, sum(1.0 / touches) AS linear_attribution_credit
FROM (SELECT customer_id, channel, CAST(count(session_date) OVER (PARTITION BY customer_id) AS DOUBLE) AS touches FROM raw_touches) t
WHERE customer_id IS NOT NULL AND channel IS NOT NULL GROUP BY 1, 2""",
    "customer_value": """
SELECT customer_id, sum(order_value) AS spent FROM raw_touches WHERE is_conversion GROUP BY 1""",
    "channel_credit_report": """
SELECT channel, coalesce(sum(last_value), 0.0) AS last_touch_value, sum(linear_value) AS linear_value,
       CAST(sum(last_customers) AS BIGINT) AS last_touch_customers, sum(linear_credit) AS linear_credit
FROM (SELECT last_touch_channel AS channel, coalesce(spent, 0.0) AS last_value, CAST(NULL AS DOUBLE) AS linear_value,
             1 AS last_customers, CAST(NULL AS DOUBLE) AS linear_credit
      FROM last_touch LEFT JOIN customer_value USING (customer_id) WHERE last_touch_channel IS NOT NULL
      UNION ALL
      SELECT channel, NULL, spent * linear_attribution_credit, NULL, linear_attribution_credit
      FROM linear_attribution LEFT JOIN customer_value USING (customer_id)) x
GROUP BY 1""",
    "furthest_stage": """
SELECT customer_id, CAST(max(CASE stage WHEN 'visitor' THEN 0 WHEN 'lead' THEN 1 WHEN 'mql' THEN 2 WHEN 'sql' THEN 3
       WHEN 'opportunity' THEN 4 WHEN 'customer' THEN 5 END) AS INTEGER) AS stage_order
FROM raw_stage_events WHERE customer_id IS NOT NULL GROUP BY 1""",
}



def _for_duckdb(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql).replace("explode(sequence(", "unnest(generate_series(")


ALL_SQL = {**{name: _for_duckdb(sql) for name, sql in RAW_SQL.items()}, **MODELS}


def _needed(sql: str, seen: list[str]) -> None:
    for name in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", sql)):
        if name in ALL_SQL and name not in seen:
            _needed(ALL_SQL[name], seen)
            seen.append(name)


def compose(sql: str) -> str:
    """The query with every model it uses, in dependency order, as a WITH clause."""
    needed: list[str] = []
    _needed(sql, needed)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS ({ALL_SQL[name]})" for name in needed)
    return f"WITH {ctes}\nSELECT * FROM ({sql}) q"


def rounded(sql: str, digits: dict[str, int]) -> str:
    """Wrap a query so that its double columns are rounded and carry no negative zero."""
    if not digits:
        return sql
    parts = ", ".join(f"round(CAST({c} AS DOUBLE), {d}) + 0.0 AS {c}" for c, d in digits.items())
    return f"SELECT * REPLACE ({parts}) FROM ({sql}) r"
