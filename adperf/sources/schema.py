"""Schemas of the source documents and of the log and metric tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, DOUBLE, INT = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()
STRINGS = T.ArrayType(STRING)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


CONTENT = struct(headline=STRING, description=STRING, cta=STRING)
DAY = struct(day=INT, month=INT, year=INT)
ELEMENT = struct(
    pivotValue=STRING,  # the creative id
    dateRange=struct(start=DAY, end=DAY),
    impressions=LONG,
    clicks=LONG,
    costInUsd=DOUBLE,
    externalWebsiteConversions=LONG,
    approximateUniqueImpressions=LONG,
    creativeContent=CONTENT,
)
MONEY = struct(amount=DOUBLE, currencyCode=STRING)
FACETS = struct(locations=STRINGS, staffCountRanges=STRINGS, industries=STRINGS)
TARGETING = struct(includedTargetingFacets=FACETS)
CONFIG = struct(id=STRING, name=STRING, status=STRING, dailyBudget=MONEY, unitCost=MONEY, targeting=TARGETING)

# One document per (campaign, pull). `part` numbers the pieces where pulls are written in several
# documents; it is absent from documents holding a whole pull.
RAW = struct(
    pulled_at=STRING,
    campaign_id=STRING,
    date_range=struct(start=STRING, end=STRING),
    analytics=struct(elements=T.ArrayType(ELEMENT)),
    campaign_config=CONFIG,
    part=INT,
)

# The older document shape: creatives with nested metrics, targeting and content.
CREATIVE_DOCUMENT = struct(
    timestamp=STRING,
    pulled_at=STRING,
    campaign_id=STRING,
    campaign_name=STRING,
    ad_account_id=STRING,
    date_range=struct(start=STRING, end=STRING),
    creatives=T.ArrayType(
        struct(
            creative_id=STRING,
            creative_name=STRING,
            status=STRING,
            metrics=struct(
                impressions=LONG,
                clicks=LONG,
                cost_usd=DOUBLE,
                conversions=LONG,
                ctr=DOUBLE,
                cpc=DOUBLE,
                conversion_rate=DOUBLE,
                cost_per_conversion=DOUBLE,
            ),
            targeting=struct(locations=STRINGS, job_titles=STRINGS, job_functions=STRINGS, seniority=STRINGS),
            creative_content=struct(headline=STRING, description=STRING, cta=STRING, image_url=STRING),
        )
    ),
)

# Columns of the exploded element table every view starts from.
ELEMENT_COLUMNS = [
    "report_date", "pulled_ts", "campaign_id", "campaign_name", "campaign_status", "daily_budget", "unit_cost",
    "creative_id", "impressions", "clicks", "cost", "conversions", "unique_impressions",
]

METRIC_COLUMNS = ["ts", "namespace", "name", "value", "unit", "dimensions"]
