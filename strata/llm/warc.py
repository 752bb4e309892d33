"""WARC archives with revisit resolution.

Archives are written by Spark's text writer: a record is its header block and
payload, and the blank lines that end a record are the line separator, so files
are WARC/1.1 archives (gzip) in any store Spark can write.  They are read as
binary files and parsed by ``Content-Length``, record by record.

Resolution shuffles headers only: of records with the same payload digest the
one of the smallest id stays ``response``, the others become ``revisit`` records
that carry no payload and refer to it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stored, whole_text

MIN_REVISIT = 100           # payloads below this many bytes are always responses
RECORDS_PER_FILE = 2_000    # archives are read as one binary value each
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
_ID = "urn:page:"


def headers_of(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``page_id, url, html, payload_bytes,
    payload_digest, record_type, refers_to``.  What is grouped and joined by
    digest are ids; rows of the smallest id are responses, repeated rows too.  A
    NULL id is larger than any other."""
    html = whole_text("html")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"),
                        F.octet_length(html).cast("long").alias("payload_bytes"),
                        F.sha2(html.cast("binary"), 256).alias("payload_digest"))
    heads = stored(rows.select("page_id", "payload_bytes", "payload_digest"), "warc-headers")
    first = stored(heads.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest")
                   .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1 and first_id is not null").select("payload_digest", "first_id"), "warc-first")
    later = (F.col("first_id").isNotNull() & (F.col("payload_bytes") >= min_revisit)
             & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    return (rows.join(first, "payload_digest", "left")
            .withColumn("record_type", F.when(later, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(later, F.col("first_id"))).drop("first_id"))


def _line(name: str, value) -> F.Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def write_archives(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
                   records_per_file: int = RECORDS_PER_FILE) -> str:
    """Write the output of :func:`headers_of` as ``*.gz`` WARC/1.1 files under
    ``path``, fresh headers for every record."""
    def uri(c):
        return F.concat(F.lit(f"<{_ID}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))

    revisit = F.col("record_type") == "revisit"
    url = F.coalesce(F.regexp_replace("url", r"[\r\n]", ""), F.lit(""))
    record = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", uri(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit(PROFILE)),
                                 _line("WARC-Refers-To", uri(F.col("refers_to"))))).otherwise(""),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
        F.lit(CRLF), F.when(revisit, "").otherwise(F.col("html")))
    (records.select(record.alias("value")).write.option("lineSep", CRLF + CRLF)
     .option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path))
    return path


class _Gunzip:
    """Reads a gzip blob piece by piece; any number of members."""

    def __init__(self, blob: bytes):
        self._blob, self._at, self._buf = memoryview(blob), 0, bytearray()
        self._z = zlib.decompressobj(31)

    def fill(self, n: int) -> bool:
        while len(self._buf) < n:
            if self._z.eof:
                self._at -= len(self._z.unused_data)
                if self._at >= len(self._blob):
                    return False
                self._z = zlib.decompressobj(31)
            if self._at >= len(self._blob):
                return False
            piece = self._blob[self._at:self._at + (1 << 16)]
            self._at += len(piece)
            self._buf += self._z.decompress(piece)
        return True

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise ValueError("archive ends inside a record")
        out = bytes(self._buf[:n])
        del self._buf[:n]
        return out

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while True:
            k = self._buf.find(mark, start)
            if k >= 0:
                return self.take(k + len(mark))
            start = max(0, len(self._buf) - len(mark))
            if not self.fill(len(self._buf) + 1):
                return None


def parse_archive(blob: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, payload) of every record of a gzip archive."""
    src = _Gunzip(blob)
    while (head := src.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8").strip().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        payload = src.take(int(fields["content-length"]))
        if src.take(4) != b"\r\n\r\n":
            raise ValueError("record without its end")
        yield fields, payload


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records of the archives under ``path``: ``page_id, url, record_type,
    refers_to, digest`` (as the header has it), ``length`` and ``sha256`` of the
    payload found, and the payload itself on request."""
    schema = ("page_id long, url string, record_type string, refers_to long, digest string, "
              "length long, sha256 string" + (", payload binary" if with_payload else ""))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    names = [c.split()[0] for c in schema.split(", ")]

    def page(uri: str | None):
        tail = (uri or "").strip("<>").removeprefix(_ID)
        return int(tail) if tail else None

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for blob in pdf["content"]:
                rows, held = [], 0
                for h, body in parse_archive(blob):
                    rows.append((page(h["warc-record-id"]), h.get("warc-target-uri"), h["warc-type"],
                                 page(h.get("warc-refers-to")), h["warc-payload-digest"].partition(":")[2],
                                 len(body), hashlib.sha256(body).hexdigest(), body)[:len(names)])
                    held += len(body) if with_payload else 100
                    if held > 1 << 24:
                        yield _frame(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows, names)

    return files.mapInPandas(parse, schema)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=names)
    for c in ("page_id", "refers_to"):
        pdf[c] = pd.array([r[names.index(c)] for r in rows], dtype="Int64")
    return pdf


def resolve(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived record: revisits are joined to the original
    response, whose payload's length is theirs; a response's digest is that of
    the payload as read."""
    records = stored(read_archives(spark, path), "warc-read")
    originals = records.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("sha256").alias("payload_digest"),
        F.col("length").alias("payload_bytes"))
    responses = records.where("record_type = 'response'").select(
        "page_id", F.col("length").alias("payload_bytes"), F.col("sha256").alias("payload_digest"),
        "record_type", "refers_to")
    revisits = records.where("record_type = 'revisit'")
    named = revisits.select("refers_to", F.col("digest").alias("payload_digest")).distinct()
    originals = originals.join(named, ["refers_to", "payload_digest"], "left_semi").distinct()
    joined = (revisits.withColumnRenamed("digest", "payload_digest")
              .join(originals, ["refers_to", "payload_digest"], "left")
              .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    return responses.unionByName(joined)


def deduplicated_archive(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages`` as deduplicated archives under ``path`` and return what
    reading them back gives.  An empty table writes no record and gives no row."""
    write_archives(headers_of(pages, min_revisit), path)
    return resolve(pages.sparkSession, path)
