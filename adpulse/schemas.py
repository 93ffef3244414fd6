"""Schemas of the pipeline's datasets (fixed at ingest, Parquet after that)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType, TimestampType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Raw JSON-lines record of one ad: numbers arrive as text and are cast later.
RAW_FIELDS = [
    ("id", StringType()),
    ("created", TimestampType()),
    ("location_display_name", StringType()),
    ("location_Country", StringType()),
    ("location_State", StringType()),
    ("location_County", StringType()),
    ("location_City", StringType()),
    ("latitude", StringType()),
    ("longitude", StringType()),
    ("contract_time", StringType()),
    ("contract_type", StringType()),
    ("category_tag", StringType()),
    ("category_label", StringType()),
    ("company_display_name", StringType()),
    ("title", StringType()),
    ("description", StringType()),
    ("salary_is_predicted", StringType()),
    ("salary_min", StringType()),
    ("salary_max", StringType()),
    ("redirect_url", StringType()),
]
RAW_SCHEMA = _s(*RAW_FIELDS)

RENAMES = {
    "location_Country": "country",
    "location_State": "state",
    "location_County": "county",
    "location_City": "city",
    "company_display_name": "company_name",
}
DOUBLE_COLUMNS = ["latitude", "longitude", "salary_min", "salary_max"]
STRING_COLUMNS = ["location_display_name", "country", "state", "county", "city",
                  "contract_time", "contract_type", "category_tag", "category_label",
                  "company_name", "title", "description", "redirect_url"]

STAGE1_COLUMNS = ["id", "created", "location_display_name", "country", "state", "county",
                  "city", "latitude", "longitude", "contract_time", "contract_type",
                  "category_tag", "category_label", "company_name", "title", "description",
                  "salary_is_predicted", "salary_min", "salary_max", "redirect_url"]
PLACE_COLUMNS = ["city", "county", "state", "country"]

STAGE3_DROPPED = ["contract_type", "category_tag"]

# Nested API document (one search result).
API_RESULT_SCHEMA = StructType([
    StructField("id", StringType()),
    StructField("title", StringType()),
    StructField("description", StringType()),
    StructField("created", StringType()),
    StructField("redirect_url", StringType()),
    StructField("salary_min", DoubleType()),
    StructField("salary_max", DoubleType()),
    StructField("salary_is_predicted", StringType()),
    StructField("contract_type", StringType()),
    StructField("contract_time", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("category", _s(("label", StringType()), ("tag", StringType()))),
    StructField("company", _s(("display_name", StringType()))),
    StructField("location", StructType([
        StructField("display_name", StringType()),
        StructField("area", ArrayType(StringType())),
    ])),
])

# Government-jobs search response.
GOV_RESULT_SCHEMA = StructType([
    StructField("SearchResult", StructType([
        StructField("SearchResultItems", ArrayType(StructType([
            StructField("MatchedObjectDescriptor", StructType([
                StructField("PositionTitle", StringType()),
                StructField("OrganizationName", StringType()),
                StructField("PositionURI", StringType()),
                StructField("PositionLocation", ArrayType(_s(("LocationName", StringType())))),
            ])),
        ]))),
    ])),
])

# Flat search response: ``results[]`` of ads.
RESULT_LIST_SCHEMA = StructType([StructField("results", ArrayType(StructType([
    StructField("title", StringType()),
    StructField("company", _s(("display_name", StringType()))),
    StructField("location", _s(("display_name", StringType()))),
    StructField("redirect_url", StringType()),
])))])

CAMPAIGN_SCHEMA = _s(("campaign_id", LongType()), ("company_name", StringType()),
                     ("state", StringType()), ("cpa_target", IntegerType()),
                     ("budget", IntegerType()), ("margin", DoubleType()))

CLICK_SCHEMA = _s(("click_id", StringType()), ("job_id", StringType()), ("date", DateType()),
                  ("time", StringType()), ("cost", DoubleType()), ("device_type", StringType()),
                  ("gender", StringType()), ("age_group", StringType()),
                  ("is_applicant", IntegerType()))

SEARCH_SCHEMA = _s(("Job_Title", StringType()), ("State", StringType()), ("City", StringType()))

