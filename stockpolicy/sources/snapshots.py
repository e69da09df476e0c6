"""Dated parameter snapshots: written beside the current ones, checked, then switched to.

    <path>/commit=<id>/calc_date=2018-08-31/*.parquet    rows of a date, never rewritten
    <path>/_pointers/<number>.json                       the commit and row count of each date

Readers follow the pointer with the highest number. A publish writes its rows to folders of
their own, reads them back for its checks, and creates the next pointer last, so a run that
dies at any moment leaves the old snapshots whole. All dates of a publish change at once.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockpolicy.functions.columns import date_col, date_lit
from stockpolicy.functions.session import file_system
from stockpolicy.schemas import PUBLISHED, PUBLISHED_KEY


def to_published(params: DataFrame, calc_date: dt.date | str | None = None) -> DataFrame:
    """The published columns in order; NaN becomes NULL.

    Without `calc_date` the frame must carry the column itself (many dates).
    """

    def column(name: str, type_: str):
        if name == "calc_date" and calc_date is not None:
            return date_col(calc_date).alias(name)
        value = F.col(name).cast(type_)
        if type_ == "double":
            value = F.when(~F.isnan(value), value)
        return value.alias(name)

    return params.select(*(column(name, type_) for name, type_ in PUBLISHED))


class ConcurrentPublish(Exception):
    """Another publish has changed one of the dates in the meantime."""


@dataclass(frozen=True)
class Pointer:
    """Number of the pointer and, per date, the commit that holds it and its rows."""

    number: int
    dates: dict[str, dict] = field(default_factory=dict)


def _pointer_files(spark: SparkSession, path: str) -> list[tuple[int, object]]:
    """(number, file) of all pointers, latest first."""
    fs, folder = file_system(spark, f"{path.rstrip('/')}/_pointers")
    if not fs.exists(folder):
        return []
    files = [s.getPath() for s in fs.listStatus(folder)]
    numbered = [(f.getName().removesuffix(".json"), f) for f in files if f.getName().endswith(".json")]
    return sorted(((int(n), f) for n, f in numbered if n.isdigit()), key=lambda x: -x[0])


def current(spark: SparkSession, path: str) -> Pointer:
    """The latest pointer that was written whole; without one, no dates.

    A pointer cut short by a writer that died counts as absent.
    """
    files = _pointer_files(spark, path)
    for number, file in files:
        fs, _ = file_system(spark, file.toString())
        stream = fs.open(file)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return Pointer(files[0][0], json.loads(text)["dates"])
        except (ValueError, KeyError, TypeError):
            continue
    return Pointer(files[0][0] if files else 0)


def _create_pointer(spark: SparkSession, path: str, pointer: Pointer) -> bool:
    """Creates the pointer's file; False if its number is taken."""
    fs, file = file_system(spark, f"{path.rstrip('/')}/_pointers/{pointer.number:08d}.json")
    try:
        stream = fs.create(file, False)
    except Py4JJavaError:
        if fs.exists(file):
            return False
        raise
    try:
        stream.write(bytearray(json.dumps({"dates": pointer.dates}, sort_keys=True).encode()))
    finally:
        stream.close()
    return True


def snapshot_exists(spark: SparkSession, path: str) -> bool:
    return bool(current(spark, path).dates)


def _read(spark: SparkSession, path: str, dates: dict[str, str]) -> DataFrame:
    """Rows of the given commit per date."""
    schema = ", ".join(f"{name} {type_}" for name, type_ in PUBLISHED)
    columns = [name for name, _ in PUBLISHED]
    if not dates:
        return spark.createDataFrame([], schema).select(*columns)
    root = path.rstrip("/")
    folders = [f"{root}/commit={commit}/calc_date={day}" for day, commit in sorted(dates.items())]
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).select(*columns)


def read_snapshots(spark: SparkSession, path: str, dates=None) -> DataFrame:
    """The current snapshots, all or those of the dates given. Dates without one have no rows.

    The pointer is read now; a later publish does not change what the frame reads.
    """
    held = {day: entry["commit"] for day, entry in current(spark, path).dates.items()}
    if dates is not None:
        wanted = {str(d) for d in dates}
        held = {day: commit for day, commit in held.items() if day in wanted}
    return _read(spark, path, held)


def snapshot_rows(spark: SparkSession, path: str) -> dict[dt.date, int]:
    """Rows of each current snapshot, from the pointer alone."""
    return {dt.date.fromisoformat(day): e["rows"] for day, e in current(spark, path).dates.items()}


@dataclass(frozen=True)
class Staged:
    """Rows written beside the current snapshots, not yet part of them."""

    spark: SparkSession
    path: str
    commit: str
    rows: dict[str, int]  # per date
    measures: dict  # what was observed while they were written
    base: Pointer  # what was current before

    def read(self) -> DataFrame:
        return _read(self.spark, self.path, {day: self.commit for day in self.rows})

    def discard(self) -> None:
        """Deletes the rows; for a publish that failed its checks."""
        fs, folder = file_system(self.spark, f"{self.path}/commit={self.commit}")
        fs.delete(folder, True)


def stage(published: DataFrame, path: str, measures: dict[str, Column] | None = None) -> Staged:
    """Writes rows to folders of a new commit: the one job that computes them.

    `measures` are aggregates observed on the way, in the writing stage, so nothing is computed
    twice for them. Keys are checked on the written rows; a NULL or repeated one is an error.
    """
    spark, path = published.sparkSession, path.rstrip("/")
    base = current(spark, path)
    commit = f"c{uuid.uuid4().hex}"
    rows = published.hint("rebalance", "calc_date")
    observed = Observation()
    if measures:
        rows = rows.observe(observed, *(c.alias(name) for name, c in measures.items()))
    # A folder of its own, with its own temporary files, so that publishes do not meet.
    rows.write.partitionBy("calc_date").parquet(f"{path}/commit={commit}")
    found = dict(observed.get) if measures else {}
    fs, pattern = file_system(spark, f"{path}/commit={commit}/calc_date=*")
    days = [f.getPath().getName().removeprefix("calc_date=") for f in fs.globStatus(pattern) or []]
    null_date = [d for d in days if d.startswith("__")]  # Hive's name for a NULL partition
    made = Staged(spark, path, commit, dict.fromkeys(days, 0), found, base)
    try:
        if null_date:
            raise ValueError("NULL or repeated snapshot key: calc_date is NULL")
        written = made.read()
        assert_publish_key(written)
        counts = {str(r["calc_date"]): r["n"] for r in written.groupBy("calc_date").agg(F.count("*").alias("n")).collect()}
    except Exception:
        made.discard()
        raise
    return Staged(spark, path, commit, counts, found, base)


def switch(staged: Staged) -> None:
    """Makes the staged dates the current ones, all at once. Other dates stay as they are.

    Fails if another publish has changed one of these dates since they were staged.
    """
    for _ in range(100):
        now = current(staged.spark, staged.path)
        changed = [day for day in staged.rows if now.dates.get(day) != staged.base.dates.get(day)]
        if changed:
            raise ConcurrentPublish(f"published by another run: {', '.join(sorted(changed))}")
        own = {day: {"commit": staged.commit, "rows": n} for day, n in staged.rows.items()}
        if _create_pointer(staged.spark, staged.path, Pointer(now.number + 1, now.dates | own)):
            return
    raise ConcurrentPublish("no pointer number was free")


def expire(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Deletes all pointers but the `keep` latest and the dates that none of these names; returns the dates deleted.

    Readers of older pointers lose their files, and so does a publish that is still under way.
    """
    path = path.rstrip("/")
    files = _pointer_files(spark, path)
    live, kept = set(), 0
    for _, file in files:
        fs, _ = file_system(spark, file.toString())
        if kept == keep:
            fs.delete(file, False)
            continue
        stream = fs.open(file)
        try:
            entries = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["dates"]
        except ValueError:
            continue  # cut short; its number stays taken
        finally:
            stream.close()
        kept += 1
        live |= {(day, e["commit"]) for day, e in entries.items()}
    fs, pattern = file_system(spark, f"{path}/commit=*/calc_date=*")
    gone = 0
    for status in fs.globStatus(pattern) or []:
        folder = status.getPath()
        commit = folder.getParent().getName().removeprefix("commit=")
        if (folder.getName().removeprefix("calc_date="), commit) not in live:
            gone += bool(fs.delete(folder, True))
    return gone


def assert_publish_key(published: DataFrame) -> None:
    """Fails when a key part is NULL or a key occurs twice. Runs a job."""
    nothing = F.lit(False)
    for c in PUBLISHED_KEY:
        nothing = nothing | F.col(c).isNull()
    bad = (
        published.groupBy(*PUBLISHED_KEY)
        .agg(F.count("*").alias("copies"))
        .filter((F.col("copies") > 1) | nothing)
        .take(1)
    )
    if bad:
        raise ValueError(f"NULL or repeated snapshot key: {bad[0].asDict()}")


def assert_dates(staged: Staged, dates) -> None:
    """Fails when one of `dates` has no rows, or a row is of another date."""
    wanted, found = {str(d) for d in dates}, set(staged.rows)
    if found - wanted:
        raise ValueError(f"rows of another date than asked for: {', '.join(sorted(found - wanted))}")
    if wanted - found:
        raise ValueError(f"no rows for {', '.join(sorted(wanted - found))}")


def publish_replace(published: DataFrame, path: str, dates) -> None:
    """Replaces the snapshots of the dates given, leaves the others. Runs jobs.

    A rerun of a date reproduces it exactly: keys it no longer yields are gone. Each of
    `dates` must have rows, so that none keeps its old snapshot unnoticed.
    """
    staged = stage(published, path)
    try:
        assert_dates(staged, dates)
    except ValueError:
        staged.discard()
        raise
    switch(staged)


def with_kept(published: DataFrame, path: str, calc_date: dt.date | str) -> DataFrame:
    """The rows of one date, and the current ones of that date whose keys they lack."""
    existing = read_snapshots(published.sparkSession, path, [calc_date])
    kept = existing.join(published.select(*PUBLISHED_KEY), PUBLISHED_KEY, "left_anti")
    return published.unionByName(kept)


def publish_upsert(published: DataFrame, path: str, calc_date: dt.date | str) -> None:
    """Updates and adds the keys of one date; its other keys stay. Runs jobs."""
    staged = stage(with_kept(published, path, calc_date), path)
    try:
        assert_dates(staged, [calc_date])
    except ValueError:
        staged.discard()
        raise
    switch(staged)


def latest_snapshot(params: DataFrame, before: dt.date | str | None = None) -> DataFrame:
    """Rows of the most recent date, optionally the most recent before a date."""
    if before is not None:
        params = params.filter(F.col("calc_date") < date_lit(before))
    newest = params.agg(F.max("calc_date")).scalar()
    return params.filter(F.col("calc_date") == newest)
