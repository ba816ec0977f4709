"""Explicit schemas of the three ingested entities."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the public business / review / user records.
BUSINESS_DDL = (
    "address STRING, "
    "attributes STRUCT<ByAppointmentOnly: STRING>, "
    "business_id STRING, "
    "categories STRING, "
    "city STRING, "
    "hours STRING, "
    "is_open BIGINT, "
    "latitude DOUBLE, "
    "longitude DOUBLE, "
    "name STRING, "
    "postal_code STRING, "
    "review_count BIGINT, "
    "stars DOUBLE, "
    "state STRING"
)
REVIEW_DDL = "user_id STRING, business_id STRING, stars DOUBLE"
USER_DDL = "user_id STRING, average_stars DOUBLE, review_count BIGINT, fans BIGINT, elite STRING"
RUNS_DDL = "experiment STRING, run_id STRING, start_time TIMESTAMP, metric STRING, value DOUBLE"

ENTITY_DDL = {"business": BUSINESS_DDL, "review": REVIEW_DDL, "user": USER_DDL}

# Columns that must be present for a record to be accepted at ingest. A review has no key;
# without user it still counts for its business.
ENTITY_KEY = {"business": ("business_id",), "review": (), "user": ("user_id",)}


def entity_schema(entity: str) -> T.StructType:
    return T.StructType.fromDDL(ENTITY_DDL[entity])
