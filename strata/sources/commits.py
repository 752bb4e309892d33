"""Atomic publishing of one date of a table.

A date's folder holds versions and commit records, all under names that file
listings of Spark skip::

    <root>/date=2024-11-28/_v-3f2c.../part-*            a version, written once
    <root>/date=2024-11-28/_commits/00000002~_v-3f2c....json

A write goes to a new version folder; when its files are complete, a record that
names the version is created under a temporary name and renamed.  Readers take
the version of the record with the highest number, so they see the old date until
the rename and the new one after it; a write that dies on the way leaves the old
date as it was.  The record carries what the write measured and whether what it
read was complete, for the next job to look at before it starts.

The highest record is found from file names alone: resolving all dates of a table
is one listing of small folders, and no record is opened for it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

from strata.functions.dates import run_date as _run_date
from strata.sources.schemas import DATE_COL

COMMITS = "_commits"
VERSION = "_v-"
KEEP = 2                # versions kept: the current one and one for readers still at work

OK, INCOMPLETE, FAILED = "ok", "incomplete", "failed"


class ConcurrentPublishError(RuntimeError):
    """Another write of the same date was published meanwhile, and it wins."""


class FailedInputError(RuntimeError):
    """The input date was published by a run that failed its own checks."""


@dataclass(frozen=True)
class Commit:
    """One published version of a date."""

    root: str
    date: dt.date
    number: int
    version: str
    record: dict = field(default_factory=dict, compare=False)

    @property
    def path(self) -> str:
        return f"{partition_path(self.root, self.date)}/{self.version}"

    @property
    def status(self) -> str:
        return self.record.get("status", OK)


def partition_path(root: str, run_date: str | dt.date) -> str:
    return f"{root.rstrip('/')}/{DATE_COL}={_run_date(run_date).isoformat()}"


def _fs(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its store."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _numbered(name: str) -> tuple[int, str] | None:
    """Number and version in a record's file name."""
    number, _, rest = name.partition("~")
    return (int(number), rest[:-len(".json")]) if number.isdigit() and rest.endswith(".json") else None


def commits_of(spark: SparkSession, root: str, run_date: str | dt.date) -> list[Commit]:
    """The commits of a date, oldest first, without their records."""
    d = _run_date(run_date)
    fs, folder = _fs(spark, f"{partition_path(root, d)}/{COMMITS}")
    if not fs.exists(folder):
        return []
    found = (_numbered(s.getPath().getName()) for s in fs.listStatus(folder))
    return [Commit(root, d, n, v) for n, v in sorted(x for x in found if x)]


def current_versions(spark: SparkSession, root: str) -> dict[dt.date, Commit | None]:
    """The newest commit of every date folder below ``root``; None for a folder
    without one (files laid down by someone else).  Two listings, on the driver,
    of a few names per date."""
    fs, base = _fs(spark, root)
    if not fs.exists(base):
        return {}

    def listed(pattern: str) -> list[JavaObject]:
        return [s.getPath() for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(base, pattern)) or ()]

    def day(name: str) -> dt.date | None:
        try:
            return dt.date.fromisoformat(name.partition("=")[2])
        except ValueError:
            return None

    out: dict[dt.date, Commit | None] = {d: None for p in listed(f"{DATE_COL}=*") if (d := day(p.getName()))}
    for p in listed(f"{DATE_COL}=*/{COMMITS}/*.json"):
        d, named = day(p.getParent().getParent().getName()), _numbered(p.getName())
        if d and named:
            c = Commit(root, d, *named)
            if out.get(d) is None or (c.number, c.version) > (out[d].number, out[d].version):
                out[d] = c
    return out


def latest(spark: SparkSession, root: str, run_date: str | dt.date) -> Commit | None:
    """The newest commit of a date with its record, or None."""
    found = commits_of(spark, root, run_date)
    if not found:
        return None
    c = found[-1]
    fs, path = _fs(spark, f"{partition_path(root, c.date)}/{COMMITS}/{c.number:08d}~{c.version}.json")
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Commit(c.root, c.date, c.number, c.version, json.loads(text))


def new_version() -> str:
    return f"{VERSION}{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, run_date: str | dt.date, version: str, record: dict,
            keep: int = KEEP) -> Commit:
    """Make ``version``, already written, the current one of its date.

    Of two writes of one date that publish at once, the one whose record sorts
    last is current and the other raises :class:`ConcurrentPublishError`.  Data of
    versions older than the last ``keep`` commits is removed; a version that was
    never published is left to :func:`remove_orphans`.
    """
    d = _run_date(run_date)
    before = commits_of(spark, root, d)
    number = before[-1].number + 1 if before else 1
    folder = f"{partition_path(root, d)}/{COMMITS}"
    name = f"{number:08d}~{version}.json"
    fs, final = _fs(spark, f"{folder}/{name}")
    _, draft = _fs(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    body = {"number": number, "version": version, "date": d.isoformat(),
            "published": dt.datetime.now(dt.timezone.utc).isoformat(), **record}
    fs.mkdirs(final.getParent())
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(body, default=str, sort_keys=True).encode()))
    finally:
        out.close()
    if not fs.rename(draft, final):
        raise ConcurrentPublishError(f"record {name} of {d} could not be put in place")
    now = commits_of(spark, root, d)
    if now[-1].version != version:
        raise ConcurrentPublishError(f"{now[-1].version} of {d} was published meanwhile")
    for old in now[:-keep]:
        _, data = _fs(spark, old.path)
        fs.delete(data, True)
    return Commit(root, d, number, version, body)


def remove_orphans(spark: SparkSession, root: str, run_date: str | dt.date, older_than_hours: float = 24.0) -> list[str]:
    """Remove versions of a date that no commit names and that are older than a
    running write can be; returns their names."""
    fs, folder = _fs(spark, partition_path(root, run_date))
    if not fs.exists(folder):
        return []
    named = {c.version for c in commits_of(spark, root, run_date)}
    latest_ms = (dt.datetime.now().timestamp() - 3600 * older_than_hours) * 1000
    gone = []
    for s in fs.listStatus(folder):
        name = s.getPath().getName()
        if name.startswith(VERSION) and name not in named and s.getModificationTime() < latest_ms:
            fs.delete(s.getPath(), True)
            gone.append(name)
    return sorted(gone)


def require_input(spark: SparkSession, root: str, run_date: str | dt.date) -> Commit | None:
    """The commit that a job reads; raises :class:`FailedInputError` if the run
    that published it failed its checks.  None: files without a record."""
    c = latest(spark, root, run_date)
    if c is not None and c.status == FAILED:
        raise FailedInputError(f"{c.path} was published by a failed run: {c.record.get('reason')}")
    return c


__all__ = ["COMMITS", "Commit", "ConcurrentPublishError", "FAILED", "FailedInputError", "INCOMPLETE", "OK",
           "commits_of", "current_versions", "latest", "new_version", "partition_path", "path_exists", "publish",
           "remove_orphans", "require_input"]
