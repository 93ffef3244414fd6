"""Ingest: nested API documents -> flat raw records -> typed stage 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.functions.scalars import flag_to_bool
from adpulse.schemas import DOUBLE_COLUMNS, RENAMES, STAGE1_COLUMNS, STRING_COLUMNS

AREA_PARTS = ["Country", "State", "County", "City"]


def area_columns(area, prefix: str = "location_") -> dict[str, Column]:
    """Positional area array -> country/state/county/city, only when it has
    exactly four elements (anything else, null included, gives four nulls)."""
    a = F.col(area) if isinstance(area, str) else area
    exact = F.size(a) == 4
    return {f"{prefix}{name}": F.when(exact, F.get(a, i)) for i, name in enumerate(AREA_PARTS)}


def flatten_ads(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Parsed API result structs -> the 20 flat raw fields (absent parent ->
    null).  ``doc_col`` is a struct column (see ``parse_json``)."""
    d = F.col(doc_col)
    return docs.select(
        d["title"].alias("title"),
        d["salary_max"].alias("salary_max"),
        d["salary_min"].alias("salary_min"),
        d["salary_is_predicted"].alias("salary_is_predicted"),
        d["description"].alias("description"),
        d["redirect_url"].alias("redirect_url"),
        d["id"].alias("id"),
        d["created"].alias("created"),
        d["contract_type"].alias("contract_type"),
        d["contract_time"].alias("contract_time"),
        d["category"]["label"].alias("category_label"),
        d["category"]["tag"].alias("category_tag"),
        d["company"]["display_name"].alias("company_display_name"),
        d["location"]["display_name"].alias("location_display_name"),
        *[c.alias(n) for n, c in area_columns(d["location"]["area"]).items()],
        d["latitude"].alias("latitude"),
        d["longitude"].alias("longitude"),
    )


def parse_json(df: DataFrame, text_col: str, schema, out: str = "doc") -> DataFrame:
    return df.withColumn(out, F.from_json(F.col(text_col), schema))


def flatten_gov_results(docs: DataFrame, doc_col: str = "doc", id_col: str = "doc_id") -> DataFrame:
    """One row per search item with its 1-based ordinal; first location
    name (null when the item lists none).  A response without items gives no
    rows."""
    items = F.col(doc_col)["SearchResult"]["SearchResultItems"]
    x = docs.select(id_col, F.posexplode(items).alias("pos", "item"))
    m = F.col("item")["MatchedObjectDescriptor"]
    return x.select(
        id_col,
        (F.col("pos") + 1).alias("i"),
        m["PositionTitle"].alias("position_title"),
        m["OrganizationName"].alias("organization_name"),
        m["PositionURI"].alias("position_uri"),
        F.get(m["PositionLocation"], 0)["LocationName"].alias("location_name"),
    )


def flatten_result_list(docs: DataFrame, doc_col: str = "doc", id_col: str = "doc_id") -> DataFrame:
    """``results[]`` of a search -> title, company, place, url, ordinal from 1."""
    x = docs.select(id_col, F.posexplode(F.col(doc_col)["results"]).alias("pos", "r"))
    r = F.col("r")
    return x.select(id_col, (F.col("pos") + 1).alias("i"),
                    r["title"].alias("title"),
                    r["company"]["display_name"].alias("company"),
                    r["location"]["display_name"].alias("place"),
                    r["redirect_url"].alias("redirect_url"))


def rename_cast(raw: DataFrame) -> DataFrame:
    """Renames, text -> double via try_cast (bad text -> null under
    ANSI), created -> timestamp, flag -> boolean, the rest forced to string.
    Columns beyond the raw fields (e.g. a landing day) are passed through."""
    df = raw.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in raw.columns})
    created = F.col("created")
    if dict(df.dtypes).get("created") == "string":
        created = F.try_to_timestamp(created)
    casts = {"created": created}
    casts.update({c: F.col(c).try_cast("double") for c in DOUBLE_COLUMNS})
    casts["salary_is_predicted"] = flag_to_bool("salary_is_predicted")
    casts.update({c: F.col(c).cast("string") for c in STRING_COLUMNS})
    extras = [c for c in df.columns if c not in STAGE1_COLUMNS]
    return df.withColumns(casts).select(*STAGE1_COLUMNS, *extras)


def ingest(raw: DataFrame) -> DataFrame:
    """Raw records (as read with the fixed schema) -> stage 1."""
    return rename_cast(raw)
