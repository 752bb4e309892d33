"""Landed pages: records fetched page by page (1, 2, 3, ...) and dropped as JSON
under ``<landing>/date=YYYY-MM-DD/``: one record a line, or a whole page as one
JSON array a line, as an API returns it.  A record's page number is its ``page``
field, or the number in its file's name or folder (``page-12.json``,
``page=12/``).  Raw pages by the hundred thousand are packed: a line a page under
``_packs/``, with the path the page came under and its records as an array, so that
files grow with the bytes and not with the pages.

Every landed row is read.  Rows without a page number are rows; lines that are no
record keep their text in ``_corrupt_record``; fields whose value is of another
kind than declared read as NULL and keep name and raw text in ``field_faults``.
Gaps in the page numbers are reported (:func:`page_report`, and all of them as
ranges by :func:`page_gap_ranges`), they never shorten what is ingested.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, StringType, StructField, StructType, VariantType

from strata.functions.dates import run_date as _run_date
from strata.sources.commits import path_exists
from strata.sources.schemas import CORRUPT_COL, DATE_COL, FAULTS_COL, PAGE_COL, RECORD, RECORD_FIELDS
from strata.sources.tables import partition_path, read_table

# As parsed: the page as text, so that 3000000000, "2" and 2.0 all arrive.
LANDED_TABLE = StructType(RECORD.fields + [StructField(PAGE_COL, StringType(), True),
                                           StructField(CORRUPT_COL, StringType(), True),
                                           StructField(DATE_COL, DateType(), True)])

# The same with the fields that are more than text as they were written: what does
# not fit the declared type is seen, not nulled by the parser.
_LISTS = [f.name for f in RECORD.fields if isinstance(f.dataType, ArrayType)]
RAW_LANDED = StructType([StructField(f.name, VariantType(), True) if f.name in _LISTS else f for f in LANDED_TABLE.fields])

# A line of a pack: the path of a raw page and its records, each read as above.
PACKS = "_packs"
PACKED = StructType([StructField("path", StringType(), True),
                     StructField("records", ArrayType(StructType(
                         [f for f in RAW_LANDED.fields if f.name not in (CORRUPT_COL, DATE_COL)])), True),
                     StructField(CORRUPT_COL, StringType(), True)])

FIRST_GAP = "first_gap"
GAP_BITS = 16           # page numbers, and then ranges of them, that one window group holds: 2^16
PAGE_IN_PATH = r"(?i)/page[=_-]?0*(\d+)[^/]*(?:/[^/]*)?$"


def page_number(c: Column | str) -> Column:
    """Page number in a text: a whole number, written with or without a zero
    fraction, as a bigint; anything else is NULL."""
    c = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.regexp_extract(c, r"^([+-]?\d{1,18})(?:\.0*)?$", 1).try_cast("bigint")


def _fault(field: str, raw: Column, typed: Column) -> Column:
    """The fault of a field that has a value, but none of the declared type."""
    return F.when(raw.isNotNull() & typed.isNull(), F.struct(F.lit(field).alias("field"), raw.alias("raw")))


def read_landed(spark: SparkSession, landing: str, run_date: str | dt.date) -> DataFrame:
    """The rows landed for ``run_date`` under the declared record schema, with
    ``page`` (bigint), ``_corrupt_record`` and ``field_faults``: unknown keys are
    dropped, missing keys read as NULL, and only a line with no record in it is
    corrupt.  A field of another kind than declared (a text where a list belongs,
    a page that is no whole number) reads as NULL and is named in
    ``field_faults`` with its raw text; every scalar is text, so text fields have
    no faults.  A date without a landing reads as empty."""
    rows = read_table(spark, landing, RAW_LANDED, run_date, fmt="json")
    path = F.col("_metadata.file_path") if "_metadata" in _hidden(rows) else F.lit(None).cast("string")
    landed = _typed(rows, path)
    packs = f"{partition_path(landing, run_date)}/{PACKS}"
    if path_exists(spark, packs):
        pages = spark.read.schema(PACKED).json(packs).where("records is null or size(records) > 0")
        packed = pages.select("path", F.explode_outer("records").alias("r"), CORRUPT_COL).select(
            "r.*", CORRUPT_COL, F.lit(_run_date(run_date)).alias(DATE_COL), "path")
        landed = landed.unionByName(_typed(packed, F.concat(F.lit("/"), F.col("path"))))
    return landed


def _typed(rows: DataFrame, path: Column) -> DataFrame:
    """Rows as written -> rows under the declared types; ``path`` is where a row's
    page landed."""
    path_page = F.regexp_extract(path, PAGE_IN_PATH, 1).try_cast("bigint")
    typed = {PAGE_COL: page_number(PAGE_COL)}
    raw = {PAGE_COL: F.col(PAGE_COL)}
    for name in _LISTS:
        typed[name] = F.try_variant_get(F.col(name), "$", RECORD[name].dataType.simpleString())
        null = F.is_variant_null(F.col(name))
        raw[name] = F.when(F.col(name).isNotNull() & ~null, F.coalesce(
            F.try_variant_get(F.col(name), "$", "string"), F.to_json(F.col(name))))
    faults = F.array_compact(F.array(*[_fault(name, raw[name], typed[name]) for name in typed]))
    blank = F.lit(True)
    for name in RECORD_FIELDS:
        blank = blank & (raw[name] if name in raw else F.col(name)).isNull()
    corrupt = F.when(blank, F.col(CORRUPT_COL))
    return rows.select(
        *[typed[name].alias(name) if name in typed else F.col(name) for name in RECORD_FIELDS],
        F.coalesce(typed[PAGE_COL], path_page).alias(PAGE_COL), corrupt.alias(CORRUPT_COL),
        F.when(corrupt.isNull() & (F.size(faults) > 0), faults).alias(FAULTS_COL), DATE_COL)


def _hidden(df: DataFrame) -> list[str]:
    """``_metadata`` if the frame reads files (an absent date is an empty frame)."""
    try:
        df.select("_metadata")
    except Exception as e:          # analysis only: no job runs
        if "_metadata" in str(e):
            return []
        raise
    return ["_metadata"]


def page_of(seq: Column | str, page_size: int = 50) -> Column:
    """1-based page number of a 0-based sequence number, in whole numbers."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    return (F.floor(seq.cast("decimal(20,0)") / F.lit(page_size)) + F.lit(1)).cast("long")


def land_pages(records: DataFrame, landing: str, run_date: str | dt.date) -> str:
    """Write records (with a ``page`` column) as the landing of ``run_date``."""
    path = partition_path(landing, run_date)
    out = records.drop(DATE_COL) if DATE_COL in records.columns else records
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)
    return path


def land_packed(records: DataFrame, landing: str, run_date: str | dt.date) -> str:
    """Write records (with a ``page`` column) as the raw pages of ``run_date``: a
    page's number is only in the folder of its path, and pages share files."""
    folder = F.coalesce(F.col(PAGE_COL).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    path = f"{partition_path(landing, run_date)}/{PACKS}"
    (records.groupBy(PAGE_COL).agg(F.collect_list(F.struct(*RECORD_FIELDS)).alias("records"))
     .select(F.concat(F.lit("page="), folder, F.lit("/part-0.json")).alias("path"), "records")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").json(path))
    return path


def page_counts(records: DataFrame) -> DataFrame:
    """Rows per page number (NULL page included): a partial/final hash
    aggregate, so only one row per page and map task is shuffled."""
    return records.groupBy(PAGE_COL).agg(F.count(F.lit(1)).alias("rows"))


def first_gap(counts: DataFrame) -> int:
    """The smallest page number >= 1 with no row, from materialised
    :func:`page_counts`.  One aggregate settles a landing without a gap; only
    one with a gap costs an anti-join of ``{p + 1}`` against the pages."""
    pages = counts.where(F.col(PAGE_COL) >= 1).select(PAGE_COL)
    low, high, n = pages.agg(F.min(PAGE_COL), F.max(PAGE_COL), F.count(F.lit(1))).first()
    if low != 1:
        return 1
    if high == n:
        return high + 1
    return (pages.select((F.col(PAGE_COL) + 1).alias(PAGE_COL)).join(pages, PAGE_COL, "left_anti")
            .agg(F.min(PAGE_COL)).first()[0])


def page_report(counts: DataFrame) -> DataFrame:
    """One row from materialised :func:`page_counts`: the first gap (one past
    the last page if there is none), pages present, pages missing below the last
    one, the last page, rows in total and rows without a valid page number (NULL
    or below 1)."""
    gap = first_gap(counts)
    page, rows = F.col(PAGE_COL), F.col("rows")
    valid = F.coalesce(page >= 1, F.lit(False))

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    last = F.coalesce(F.max(F.when(valid, page)), F.lit(0)).cast("long")
    return counts.agg(
        F.count_if(valid).alias("pages_present"),
        (last - F.count_if(valid)).alias("pages_missing"),
        last.alias("last_page"),
        total(rows).alias("rows_total"),
        total(F.when(~valid, rows)).alias("rows_without_page"),
    ).select(F.lit(gap).cast("long").alias(FIRST_GAP), "*")


def page_gap_ranges(counts: DataFrame, expected_pages: int | None = None, bits: int = GAP_BITS) -> DataFrame:
    """All ranges of page numbers from 1 on that have no row, from
    :func:`page_counts`: ``first_missing, last_missing, n_missing``.  Pages up to
    ``expected_pages``, if given, belong to a complete landing.  Numbers that are
    no page (NULL, below 1) are left out.

    Islands of pages are found without a window over all of them: pages are
    grouped by their upper bits, so that a group holds at most ``2^bits``; the
    borders of the groups, one row each, are grouped by their upper bits in turn,
    until one group is left.  A level costs one shuffle of what is left of it.
    """
    page = F.col(PAGE_COL)
    level = counts.where(page >= 1).select(page.alias("low"), page.alias("high"))
    # a page before the first and one after the last expected border on what is missing
    ends = [0] if expected_pages is None else [0, expected_pages + 1]
    spark = counts.sparkSession
    level = level.unionByName(spark.createDataFrame([(e, e) for e in ends], "low long, high long"))
    gaps = None
    for shift in range(bits, 64 + bits, bits):
        group = F.shiftright("low", min(shift, 63))
        before = F.max("high").over(Window.partitionBy("group").orderBy("low").rowsBetween(Window.unboundedPreceding, -1))
        spans = level.withColumn("group", group).withColumn("before", before)
        found = spans.where(F.col("low") > F.col("before") + 1).select(
            (F.col("before") + 1).alias("first_missing"), (F.col("low") - 1).alias("last_missing"))
        gaps = found if gaps is None else gaps.unionByName(found)
        level = level.groupBy(group.alias("group")).agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("group")
        if shift >= 63:
            break
    return gaps.select("first_missing", "last_missing",
                       (F.col("last_missing") - F.col("first_missing") + 1).alias("n_missing"))
