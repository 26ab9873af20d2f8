"""Surrogate keys and the unmatched member."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text standing for NULL inside a hashed key, and the keys of the
# unknown member (hashed keys are strings, calendar keys are integers).
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
UNMATCHED = "-1"
UNMATCHED_INT = -1


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the dash-joined string forms of the parts."""
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_PLACEHOLDER)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def unmatched(c: Column) -> Column:
    return F.coalesce(c, F.lit(UNMATCHED))


def unmatched_int(c: Column) -> Column:
    return F.coalesce(c, F.lit(UNMATCHED_INT))
