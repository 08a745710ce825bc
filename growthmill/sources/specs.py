"""What each source lands: columns, merge keys, partition, lookback and freshness limits."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

META_ACTION_TYPES = ("link_click", "purchase", "lead", "add_to_cart", "view_content", "initiate_checkout")
LOAD_COLUMNS = "_extracted_at timestamp, _source string"


@dataclass(frozen=True)
class SourceSpec:
    """One bronze table. ``fields`` are the payload paths the source is asked for.

    ``window`` names the columns, the first known one counts, that say when a row last changed; by default the
    partition. ``buckets`` is the number of key buckets of a table whose keys hold no day: part of its layout,
    so it never changes for a stored table; size it for files of some hundred MB. ``versions`` are the columns
    by which a row is newer than another of its key, the first one first.
    """

    table: str
    ddl: str
    merge_keys: tuple[str, ...]
    partition: str | None
    lookback_days: int
    warn_hours: int | None = None
    error_hours: int | None = None
    fields: tuple[str, ...] = ()
    window: tuple[str, ...] = ()
    buckets: int | None = None
    versions: tuple[str, ...] = ()

    @property
    def window_columns(self) -> tuple[str, ...]:
        return self.window or (self.partition,)

    @property
    def schema(self) -> T.StructType:
        return _parsed(f"{self.ddl}, {LOAD_COLUMNS}")


@lru_cache
def _parsed(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _meta_action_columns() -> str:
    names = [f"{kind}_{action}" for kind in ("action", "cpa") for action in META_ACTION_TYPES]
    return ", ".join(f"{name} double" for name in names)


# --- Fixed values: bronze columns, keys, windows and freshness limits --------
GOOGLE_ADS = SourceSpec(
    table="google_ads_campaigns",
    ddl="""campaign_id string not null, campaign_name string, campaign_status string, channel_type string,
        ad_group_id string not null, ad_group_name string, ad_group_status string, date date not null,
        device string, impressions bigint, clicks bigint, cost double, conversions double,
        conversion_value double, video_views bigint, ctr double, average_cpc double,
        search_impression_share double""",
    merge_keys=("campaign_id", "ad_group_id", "date", "device"),
    partition="date",
    lookback_days=2,
    warn_hours=6,
    error_hours=24,
    fields=(
        "metrics.impressions",
        "metrics.clicks",
        "metrics.cost_micros",
        "metrics.conversions",
        "metrics.conversions_value",
        "metrics.video_views",
        "campaign.id",
        "campaign.name",
        "campaign.status",
        "ad_group.id",
        "ad_group.name",
        "segments.date",
        "segments.device",
    ),
)

META_ADS = SourceSpec(
    table="meta_ads_insights",
    ddl=f"""campaign_id string not null, campaign_name string, adset_id string, adset_name string,
        ad_id string not null, ad_name string, date_start date not null, impressions bigint, clicks bigint,
        spend double, reach bigint, frequency double, objective string, buying_type string,
        {_meta_action_columns()}, actions map<string, double>, cost_per_action map<string, double>""",
    merge_keys=("ad_id", "date_start"),
    partition="date_start",
    lookback_days=2,
    warn_hours=6,
    error_hours=24,
    fields=(
        "campaign_id",
        "campaign_name",
        "adset_id",
        "adset_name",
        "ad_id",
        "ad_name",
        "date_start",
        "date_stop",
        "impressions",
        "clicks",
        "spend",
        "reach",
        "frequency",
        "actions",
        "cost_per_action_type",
    ),
)

LINKEDIN_ADS = SourceSpec(
    table="linkedin_ads_analytics",
    ddl="""date_start date, pivot string, pivot_value string, impressions bigint, clicks bigint, cost double,
        one_click_leads bigint, conversions bigint, video_views bigint, total_engagements bigint,
        likes bigint, shares bigint, comments bigint, follows bigint""",
    merge_keys=("pivot_value", "date_start"),
    partition="date_start",
    lookback_days=2,
    warn_hours=6,
    error_hours=24,
    fields=(
        "dateRange",
        "impressions",
        "clicks",
        "costInLocalCurrency",
        "oneClickLeads",
        "conversions",
        "videoViews",
    ),
)

GA4 = SourceSpec(
    table="ga4_sessions",
    ddl="""date date, sessionSource string, sessionMedium string, sessionCampaignName string,
        deviceCategory string, country string, landingPage string, sessionDefaultChannelGroup string,
        sessions bigint, activeUsers bigint, newUsers bigint, screenPageViews bigint, conversions bigint,
        engagedSessions bigint, bounceRate double, averageSessionDuration double, totalRevenue double,
        engagementRate double""",
    # A report row differs from another by any of its dimensions.
    merge_keys=(
        "date",
        "sessionSource",
        "sessionMedium",
        "sessionCampaignName",
        "deviceCategory",
        "country",
        "landingPage",
        "sessionDefaultChannelGroup",
    ),
    partition="date",
    lookback_days=3,
    warn_hours=6,
    error_hours=24,
    fields=(
        "date",
        "sessionSource",
        "sessionMedium",
        "sessionCampaignName",
        "deviceCategory",
        "country",
        "landingPage",
        "sessions",
        "activeUsers",
        "newUsers",
        "bounceRate",
        "averageSessionDuration",
        "screenPageViews",
        "conversions",
        "totalRevenue",
    ),
)

HUBSPOT = SourceSpec(
    table="hubspot_objects",
    ddl="""id string, object_type string, email string, firstname string, lastname string, phone string,
        company string, lifecyclestage string, hs_lead_status string, createdate timestamp,
        lastmodifieddate string, hs_lastmodifieddate string, hubspot_owner_id string, hs_analytics_source string,
        hs_analytics_source_data_1 string, hs_analytics_first_referrer string, hs_analytics_first_url string,
        num_conversion_events string, recent_conversion_event_name string, hs_email_optout string,
        dealname string, amount string, dealstage string, closedate string, pipeline string,
        hs_deal_stage_probability string, hs_is_closed_won string, hs_is_closed string,
        num_associated_contacts string, name string, domain string, industry string, annualrevenue string,
        numberofemployees string, hs_lastcontacted string""",
    merge_keys=("id", "object_type"),
    partition=None,
    lookback_days=7,
    window=("lastmodifieddate", "hs_lastmodifieddate", "createdate"),
    versions=("lastmodifieddate", "hs_lastmodifieddate"),
    buckets=256,
    warn_hours=12,
    error_hours=48,
)

SALESFORCE = SourceSpec(
    table="salesforce_objects",
    ddl="""Id string, object_type string, FirstName string, LastName string, Email string, Phone string,
        Company string, Title string, LeadSource string, Status string, Rating string, Industry string,
        NumberOfEmployees bigint, AnnualRevenue double, OwnerId string, IsConverted boolean,
        ConvertedDate timestamp, ConvertedContactId string, ConvertedAccountId string,
        ConvertedOpportunityId string, Name string, AccountId string, StageName string, Amount double,
        Probability double, CloseDate timestamp, Type string, IsClosed boolean, IsWon boolean,
        ForecastCategory string, CreatedDate timestamp, LastModifiedDate timestamp""",
    merge_keys=("Id", "object_type"),
    partition=None,
    lookback_days=7,
    window=("LastModifiedDate", "CreatedDate"),
    versions=("LastModifiedDate",),
    buckets=256,
)

SHOPIFY = SourceSpec(
    table="shopify_raw",
    ddl="""order_id bigint, created_at timestamp, updated_at string, email string, financial_status string,
        fulfillment_status string, total_price double, subtotal_price double, total_tax double,
        total_discounts double, currency string, customer_id bigint, source_name string,
        referring_site string, landing_site string, cancelled_at string, item_count int,
        discount_codes string, object_type string, id bigint, first_name string, last_name string,
        orders_count bigint, total_spent string, accepts_marketing boolean, tags string, state string,
        record_id bigint""",
    merge_keys=("record_id", "object_type"),
    partition="created_at",
    lookback_days=3,
    warn_hours=6,
    error_hours=24,
)

MIXPANEL_EVENTS = SourceSpec(
    table="mixpanel_events",
    ddl="""event string, distinct_id string, insert_id string, time timestamp, country_code string,
        city string, region string, os string, browser string, browser_version string, device string,
        screen_width bigint, screen_height bigint, utm_source string, utm_medium string,
        utm_campaign string, utm_content string, utm_term string, current_url string,
        initial_referrer string, referrer string, lib string, custom_properties string, event_date date""",
    merge_keys=("insert_id", "event_date"),
    partition="event_date",
    lookback_days=2,
    warn_hours=12,
    error_hours=24,
)

MIXPANEL_SEGMENTATION = SourceSpec(
    table="mixpanel_segmentation",
    ddl="event string, segment_property string, segment_value string, date date, event_count bigint",
    merge_keys=("event", "segment_property", "segment_value", "date"),
    partition="date",
    lookback_days=2,
    warn_hours=12,
    error_hours=24,
)

MIXPANEL_FUNNELS = SourceSpec(
    table="mixpanel_funnel_conversions",
    ddl="""funnel_id bigint, funnel_name string, date date, step_index int, step_label string, count bigint,
        conversion_rate double, avg_time_to_convert_sec double, goal_count bigint,
        goal_conversion_rate double""",
    merge_keys=("funnel_id", "date", "step_index"),
    partition="date",
    lookback_days=7,
    warn_hours=24,
    error_hours=48,
)

# Days a layer keeps its rows; None keeps them for ever.
RETENTION_DAYS = {"raw": 365, "staging": 180, "marts": None}
# ----------------------------------------------------------------------------

SOURCES = {
    "google_ads": GOOGLE_ADS,
    "meta_ads": META_ADS,
    "linkedin_ads": LINKEDIN_ADS,
    "ga4": GA4,
    "hubspot": HUBSPOT,
    "salesforce": SALESFORCE,
    "shopify": SHOPIFY,
    "mixpanel_events": MIXPANEL_EVENTS,
    "mixpanel_segments": MIXPANEL_SEGMENTATION,
    "mixpanel_funnels": MIXPANEL_FUNNELS,
}


def conform(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Add the nullable contract columns a landed table lacks, as typed nulls.

    Present columns keep their own type; a required column that is missing is an error.
    """
    present = set(df.columns)
    missing = [field for field in spec.schema.fields if field.name not in present]
    required = [field.name for field in missing if not field.nullable]
    if required:
        raise ValueError(f"{spec.table} lacks required columns: {', '.join(required)}")
    return df.select("*", *[F.lit(None).cast(field.dataType).alias(field.name) for field in missing])


def declared_projection(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Only the payload paths the source declares, so that a scan reads nothing else."""
    return df.select(*[F.col(path).alias(path.replace(".", "_")) for path in spec.fields])


def with_metadata(df: DataFrame, source: str, extracted_at: Column | None = None) -> DataFrame:
    """Stamp every row with its load time and source name."""
    stamp = F.current_timestamp() if extracted_at is None else extracted_at
    return df.withColumns({"_extracted_at": stamp, "_source": F.lit(source)})
