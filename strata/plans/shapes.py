"""Re-aim the driver's test tables at the pipeline's record shape.

The test tables hold no business entities, so their columns are mapped onto
the record fields; every mapping is a projection of whole tables (no row is
dropped or sampled).  The DuckDB text of each mapping sits beside it in
``strata.plans.catalog`` so that both engines compute the same thing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.landing import page_of
from strata.sources.schemas import LOCATION_COL, PAGE_COL, RECORD, TYPE_COL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _part(c: Column, sep: str, n: int) -> Column:
    return F.split_part(c, F.lit(sep), F.lit(n))


def url_host(url: Column) -> Column:
    return _part(url, "/", 3)


def url_lang(url: Column) -> Column:
    return _part(url, "/", 4)


def url_tail(url: Column) -> Column:
    """Last path segment before '?', '' -> NULL."""
    return F.nullif(_part(_part(url, "?", 1), "/", -1), F.lit(""))


def url_query(url: Column) -> Column:
    """Query string, absent -> NULL."""
    return F.nullif(_part(url, "?", 2), F.lit(""))


def part_as_entities(part: DataFrame) -> DataFrame:
    """``part``: type = p_type, location = 'brand, size'."""
    return part.select(
        F.col("p_type").alias(TYPE_COL),
        F.concat_ws(", ", F.col("p_brand"), F.col("p_size").cast("string")).alias(LOCATION_COL),
    )


def pages_as_records(pages: DataFrame, page_size: int = 50) -> DataFrame:
    """``pages`` as landed records: one record per page row, keyed by host (so
    hosts with several pages are duplicates; the highest page_id is newest),
    type = language segment, longitude = last path segment (often not numeric),
    city = first label of a four-label host, state = top-level domain of https
    hosts, phone = query string."""
    url = F.col("url")
    host = url_host(url)
    rec = {
        "id": host,
        "name": host,
        "brewery_type": url_lang(url),
        "street": _part(_part(url, "?", 1), "#", 1),
        "city": F.when(F.size(F.split(host, "[.]")) == 4, _part(host, ".", 1)),
        "state": F.when(url.startswith("https:"), _part(host, ".", -1)),
        "postal_code": F.lit(None),
        "country": F.lit(None),
        "longitude": url_tail(url),
        "latitude": F.length("html").cast("string"),
        "phone": url_query(url),
        "website_url": url,
        "updated_at": F.lpad(F.col("page_id").cast("string"), 12, "0"),
        "tag_list": F.array(url_lang(url), host),
    }
    cols = [rec[f.name].cast(f.dataType).alias(f.name) for f in RECORD.fields]
    return pages.select(*cols, page_of("page_id", page_size).alias(PAGE_COL))


def events_as_records(events: DataFrame, page_size: int = 50) -> DataFrame:
    """``events`` as landed records: id = event_id, type = event_type,
    name = user_id, updated_at = event time; page from the event sequence."""
    rec = {
        "id": F.col("event_id").cast("string"),
        "name": F.col("user_id").cast("string"),
        "brewery_type": F.col("event_type"),
        "updated_at": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    }
    cols = [rec.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD.fields]
    return events.select(*cols, page_of("event_id", page_size).alias(PAGE_COL))


def events_as_user_records(events: DataFrame, page_size: int = 50) -> DataFrame:
    """``events`` as records keyed by user: every event is a version of its
    user's record (newest ``updated_at`` wins), type = event_type, city = the
    ``k`` field of the JSON props, longitude = the event value as text."""
    rec = {
        "id": F.col("user_id").cast("string"),
        "name": F.col("event_id").cast("string"),
        "brewery_type": F.col("event_type"),
        "city": F.get_json_object("props", "$.k"),
        "longitude": F.col("value").cast("string"),
        "updated_at": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    }
    cols = [rec.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD.fields]
    return events.select(*cols, page_of("event_id", page_size).alias(PAGE_COL))
