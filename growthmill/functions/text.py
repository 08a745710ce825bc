"""Text clean-up and row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the placeholder hashed in place of a null key part.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def lower_or_null(text: Column) -> Column:
    """Lower case, with the empty string read as missing."""
    return F.lower(F.nullif(text, F.lit("")))


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the parts joined with '-', nulls replaced by a placeholder."""
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_KEY_PART)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))
