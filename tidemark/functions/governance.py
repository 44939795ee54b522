"""PII tagging and tag-driven masking (survey G1-G5, X15, X16).

Tags travel with the DataFrame schema as ``StructField`` metadata, so they
follow the column through selects and writes. Masking is applied only in the
consumer view: bronze and silver keep clear values (masking earlier would store
masked values for good). Roles are data, so the decision constant-folds.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Closed vocabulary of the PII tag.
PII_TYPES = ("EMAIL", "PHONE", "FIRST_NAME", "LAST_NAME", "FULL_NAME",
             "DOB", "ADDRESS", "POSTCODE", "NATIONAL_ID", "FINANCIAL", "OTHER")
# Replacement text of a masked string.
MASKED_TEXT = "***MASKED***"
# Tags of the passenger-name-record columns.
PASSENGER_TAGS = {"pax_first_name": "FIRST_NAME", "pax_last_name": "LAST_NAME",
                  "date_of_birth": "DOB", "passport_number": "NATIONAL_ID"}

# Roles allowed to see clear values (parameter; the deployment names its own roles).
PRIVILEGED_ROLES = ("COMPLIANCE_ROLE", "ADMIN_ROLE")

TAG_KEY = "pii_type"


def tag_pii(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Attach a PII tag to columns; the value must be in the closed vocabulary."""
    for col, tag in tags.items():
        if tag not in PII_TYPES:
            raise ValueError(f"PII tag {tag!r} is not one of {', '.join(PII_TYPES)}")
        meta = dict(df.schema[col].metadata)
        meta[TAG_KEY] = tag
        df = df.withMetadata(col, meta)
    return df


def pii_columns(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata[TAG_KEY] for f in df.schema.fields if TAG_KEY in f.metadata}


def can_see_clear(roles: Iterable[str], privileged: Iterable[str] = PRIVILEGED_ROLES) -> bool:
    """True when any session role is privileged."""
    return bool(set(roles) & set(privileged))


def mask_string(col: str | Column, clear: bool) -> Column:
    """G1: clear value for privileged sessions, else the masked literal (NULL masks too)."""
    c = F.col(col) if isinstance(col, str) else col
    return c if clear else F.lit(MASKED_TEXT)


def mask_date(col: str | Column, clear: bool) -> Column:
    """Clear value for privileged sessions, else Jan 1 of the same year (NULL stays NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return c if clear else F.trunc(c, "year")


def masked_view(df: DataFrame, roles: Iterable[str], privileged: Iterable[str] = PRIVILEGED_ROLES,
                required: Mapping[str, str] | None = None) -> DataFrame:
    """One projection masking every tagged column by its type; untagged columns pass.

    ``required`` (the spec's tags) makes masking fail closed: a column that should carry
    a tag and does not raises instead of passing in clear.
    """
    untagged = sorted(set(required or ()) & set(df.columns) - set(pii_columns(df)))
    if untagged:
        raise ValueError(f"columns without their PII tag: {', '.join(untagged)}")
    clear = can_see_clear(roles, privileged)
    out = []
    for f in df.schema.fields:
        if TAG_KEY not in f.metadata or clear:
            out.append(F.col(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(mask_date(f.name, False).alias(f.name, metadata=f.metadata))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_trunc("year", F.col(f.name)).cast(f.dataType).alias(f.name, metadata=f.metadata))
        elif isinstance(f.dataType, T.StringType):
            out.append(mask_string(f.name, False).alias(f.name, metadata=f.metadata))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata))
    return df.select(*out)
