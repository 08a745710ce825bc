"""CRM object payloads: several object types stacked in one tagged table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthmill.functions.dates import in_days

HUBSPOT_PAYLOAD = "id string, properties map<string, string>"

# --- Fixed values: properties read per object type ----------------------------
CONTACT_PROPERTIES = (
    "email",
    "firstname",
    "lastname",
    "phone",
    "company",
    "lifecyclestage",
    "hs_lead_status",
    "createdate",
    "lastmodifieddate",
    "hubspot_owner_id",
    "hs_analytics_source",
    "hs_analytics_source_data_1",
    "hs_analytics_first_referrer",
    "hs_analytics_first_url",
    "num_conversion_events",
    "recent_conversion_event_name",
    "hs_email_optout",
)
DEAL_PROPERTIES = (
    "dealname",
    "amount",
    "dealstage",
    "closedate",
    "createdate",
    "pipeline",
    "hubspot_owner_id",
    "hs_deal_stage_probability",
    "hs_is_closed_won",
    "hs_is_closed",
    "num_associated_contacts",
    "hs_lastmodifieddate",
)
COMPANY_PROPERTIES = (
    "name",
    "domain",
    "industry",
    "annualrevenue",
    "numberofemployees",
    "lifecyclestage",
    "createdate",
    "hs_lastcontacted",
    "hs_lastmodifieddate",
)
# When an object last changed: contacts have the first property, deals and companies the second.
CHANGE_PROPERTIES = ("lastmodifieddate", "hs_lastmodifieddate")
SALESFORCE_DATETIMES = ("CreatedDate", "LastModifiedDate", "CloseDate", "ConvertedDate")
# ------------------------------------------------------------------------------


def stack(frames: dict[str, DataFrame]) -> DataFrame:
    """Union frames of different columns, each tagged with its ``object_type``."""
    tagged = [frame.withColumn("object_type", F.lit(tag)) for tag, frame in frames.items()]
    result = tagged[0]
    for frame in tagged[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def _hubspot_objects(df: DataFrame, properties: tuple[str, ...], start: date, end: date) -> DataFrame:
    prop = F.col("properties")
    created = F.try_to_timestamp(prop["createdate"])
    changed = F.coalesce(*[F.try_to_timestamp(prop[name]) for name in CHANGE_PROPERTIES], created)
    return df.filter(in_days(changed, start, end)).select(
        "id",
        *[(created if name == "createdate" else prop[name]).alias(name) for name in properties],
    )


def flatten_hubspot(contacts: DataFrame, deals: DataFrame, companies: DataFrame, start: date, end: date) -> DataFrame:
    """Objects changed from ``start`` to the end of day ``end``."""
    return stack(
        {
            "contacts": _hubspot_objects(contacts, CONTACT_PROPERTIES, start, end),
            "deals": _hubspot_objects(deals, DEAL_PROPERTIES, start, end),
            "companies": _hubspot_objects(companies, COMPANY_PROPERTIES, start, end),
        }
    )


def _salesforce_objects(df: DataFrame, start: date, end: date) -> DataFrame:
    parsed = {
        name: F.try_to_timestamp(F.col(name).cast("string")) for name in SALESFORCE_DATETIMES if name in df.columns
    }
    changed = F.col("LastModifiedDate")
    return (
        df.drop("attributes")
        .withColumns(parsed)
        .filter(in_days(changed, start, end))
    )


def flatten_salesforce(leads: DataFrame, opportunities: DataFrame, start: date, end: date) -> DataFrame:
    return stack(
        {
            "lead": _salesforce_objects(leads, start, end),
            "opportunity": _salesforce_objects(opportunities, start, end),
        }
    )
