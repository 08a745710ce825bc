"""Mapping of source, medium and platform names to marketing channels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# Default channel group: text fragment and channel, first match wins.
GROUP_FRAGMENTS = (
    ("paid search", "paid_search"),
    ("paid social", "paid_social"),
    ("organic", "organic_search"),
    ("email", "email"),
    ("direct", "direct"),
    ("referral", "referral"),
    ("display", "display"),
)

PAID_SEARCH_MEDIUMS = ("cpc", "ppc", "paidsearch")
PAID_SOCIAL_MEDIUMS = ("paid_social", "social_paid", "cpm", "cpv")
SOCIAL_SOURCES = ("facebook", "instagram", "linkedin", "twitter", "tiktok", "meta")
SEGMENT_SEARCH_SOURCES = ("google", "bing")

# Mediums that name their own channel.
MEDIUM_CHANNELS = (
    ("email", "email"),
    ("organic", "organic_search"),
    ("referral", "referral"),
    ("affiliate", "affiliate"),
    ("display", "display"),
)

# Free text: keyword and channel, first keyword contained in the text wins.
KEYWORD_CHANNELS = (
    ("google", "paid_search"),
    ("cpc", "paid_search"),
    ("ppc", "paid_search"),
    ("facebook", "paid_social"),
    ("instagram", "paid_social"),
    ("meta", "paid_social"),
    ("linkedin", "paid_social"),
    ("email", "email"),
    ("organic", "organic_search"),
    ("seo", "organic_search"),
    ("direct", "direct"),
    ("referral", "referral"),
    ("affiliate", "affiliate"),
    ("display", "display"),
)

# Ad platform to the channel its spend is compared with.
PLATFORM_CHANNELS = (
    ("google_ads", "paid_search"),
    ("meta_ads", "paid_social"),
    ("linkedin_ads", "paid_social"),
)

# Every channel the UTM rules can give.
UTM_CHANNELS = (
    "paid_search",
    "paid_social",
    "email",
    "organic_search",
    "referral",
    "affiliate",
    "display",
    "direct",
    "other",
)
# ----------------------------------------------------------------------------


def _first_match(rules: Iterable[tuple[Column, str]], default: Column) -> Column:
    (condition, channel), *rest = list(rules)
    result = F.when(condition, F.lit(channel))
    for condition, channel in rest:
        result = result.when(condition, F.lit(channel))
    return result.otherwise(default)


def channel_ga4(group: Column) -> Column:
    text = F.lower(group)
    return _first_match([(text.contains(part), name) for part, name in GROUP_FRAGMENTS], F.lit("other"))


def channel_utm(source: Column, medium: Column) -> Column:
    """Channel of the raw (not blank-cleaned) UTM pair; blank/blank is 'other', null/null 'direct'."""
    src, med = F.lower(source), F.lower(medium)
    rules = [
        (med.isin(*PAID_SEARCH_MEDIUMS), "paid_search"),
        (med.isin(*PAID_SOCIAL_MEDIUMS), "paid_social"),
        (src.isin(*SOCIAL_SOURCES), "paid_social"),
        *[(med == name, channel) for name, channel in MEDIUM_CHANNELS],
        (source.isNull() & medium.isNull(), "direct"),
    ]
    return _first_match(rules, F.lit("other"))


def channel_segment(prop: Column, value: Column) -> Column:
    """Channel of a UTM-source segment; null for segments of another property."""
    text = F.lower(value)
    rules = [
        (text.isin(*SEGMENT_SEARCH_SOURCES), "paid_search"),
        (text.isin(*SOCIAL_SOURCES), "paid_social"),
    ]
    return F.when(prop == "utm_source", _first_match(rules, text))


def normalize_channel(raw: Column) -> Column:
    text = F.lower(raw)
    rules = [
        (raw.isNull() | (raw == ""), "unknown"),
        *[(text.contains(keyword), channel) for keyword, channel in KEYWORD_CHANNELS],
    ]
    return _first_match(rules, F.lit("other"))


def spend_channel(platform: Column) -> Column:
    """Channel an ad platform's spend belongs to; null for an unknown platform."""
    return _first_match([(platform == name, channel) for name, channel in PLATFORM_CHANNELS], F.lit(None))
