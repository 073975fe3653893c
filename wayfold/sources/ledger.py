"""Tables in parts (days, groups) whose runs are published by a log, in one step each.

    <table>/runs/run=<id>/part=<part>/*.parquet    rows, written apart by each run
    <table>/log/*.json                             what runs did to which part, only ever added to

A run notes START for its parts, writes its rows to a folder of its own, and then adds one log file with COMPLETE for all its
parts. That file appears by one rename, so readers see all parts of a run or none, and the rows of the runs
before it until then. A run that raises notes FAILED. The newest entry of a part is its state; its rows are those of the newest
COMPLETE. A killed run leaves START and a folder that nobody reads.

The log has a few entries per run and part, so it is folded by Spark but the parts asked for are listed on the driver, as
a file listing would be. Two runs of the same part at the same time are ordered by number and id: every reader takes the same one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wayfold.operators.endpoints import apply_changes
from wayfold.sources.readers import scan_range
from wayfold.sources.writers import days_of

Time = str | datetime
START, COMPLETE, FAILED = "START", "COMPLETE", "FAILED"
LOG = "seq bigint, run string, part string, state string, rows bigint, columns string, error string"
PART = "part"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All entries; none if the table is not there yet."""
    try:
        return spark.read.schema(LOG).json(f"{path}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def note(spark: SparkSession, path: str, entries: Sequence[tuple]) -> None:
    """Adds entries (run, part, state, rows, columns, error) in one file, numbered after all that are there."""
    last = read_log(spark, path).agg(F.max("seq")).first()[0] or 0
    rows = spark.createDataFrame([(last + 1, *e) for e in entries], LOG)
    rows.coalesce(1).write.mode("append").json(f"{path}/log")


def fold_states(log: DataFrame, of: str = PART, order: Sequence[str] = ("seq", "run"), values: Sequence[str] = ("state", "run", "rows")) -> DataFrame:
    """The newest entry of every part; folded map side, so a part with very many entries is a row per task."""
    newest = F.max_by(F.struct(*values), F.struct(*order))
    return log.groupBy(of).agg(newest.alias("__new")).select(of, "__new.*")


def states(spark: SparkSession, path: str) -> DataFrame:
    """(part, state, run, rows) of every part that was ever begun."""
    return fold_states(read_log(spark, path))


def live(spark: SparkSession, path: str) -> DataFrame:
    """(part, run, rows, columns) of the run whose rows each part has."""
    return fold_states(read_log(spark, path).where(F.col("state") == COMPLETE), values=("run", "rows", "columns"))


def read_parts(spark: SparkSession, path: str, parts: Iterable[str] | None = None) -> DataFrame:
    """Rows of the published runs with their ``part``; only folders of the parts asked for are read."""
    found = live(spark, path)
    if parts is not None:
        found = found.where(F.col(PART).isin(sorted(set(parts))))
    rows = found.collect()  # one per part
    columns = next((r["columns"] for r in sorted(rows, key=lambda r: r.run, reverse=True)), None)
    if columns is None:
        columns = next((r["columns"] for r in live(spark, path).limit(1).collect()), None)
    if columns is None:
        raise ValueError(f"nothing is published in {path}")
    whole = T.StructType.fromJson(json.loads(columns)).add("run", "string").add(PART, "string")
    folders = [f"{path}/runs/run={r.run}/{PART}={r.part}" for r in rows if r.rows]
    if not folders:
        return spark.createDataFrame([], whole).drop("run")
    return spark.read.schema(whole).option("basePath", f"{path}/runs").parquet(*folders).drop("run")


def publish(df: DataFrame, path: str, part: Column, parts: Sequence[str], near: Column | None = None) -> str:
    """Replaces ``parts`` by the rows of ``df`` in one step, and returns the run's id. A part without rows becomes empty.

    A row of another part is an error. Parts are names of folders: letters, digits, ``-``, ``_`` and ``.``. With ``near`` the
    files of a part are ranges of that value and sorted by it, so that a scan can skip most of them.
    """
    if bad := [p for p in parts if not p or not all(c.isalnum() or c in "-_." for c in p)]:
        raise ValueError(f"names of parts: {bad}")
    spark, run = df.sparkSession, f"r{uuid.uuid4().hex}"
    if not parts:
        return run
    note(spark, path, [(run, p, START, None, None, None) for p in parts])
    try:
        other = F.raise_error(F.concat(F.lit("a row of part "), F.coalesce(F.col(PART), F.lit("null")), F.lit(" in a run without it")))
        asked = F.array(*map(F.lit, parts)) if len(parts) < 64 else F.from_json(F.lit("[" + ",".join(f'"{p}"' for p in parts) + "]"), "array<string>")
        inside = F.when(F.array_contains(asked, F.col(PART)), F.col(PART)).otherwise(other.cast("string"))
        staged = f"{path}/runs/run={run}"
        rows = df.withColumn(PART, part).withColumn(PART, inside)
        if near is None:
            rows = rows.hint("rebalance", PART)
        else:
            rows = rows.withColumn("__near", near).repartitionByRange(PART, "__near").sortWithinPartitions(PART, "__near").drop("__near")
        rows.write.partitionBy(PART).parquet(staged)
        written = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(PART, T.StringType())])).parquet(staged)
        counts = dict(written.groupBy(PART).agg(F.count("*")).collect())  # one row per part
        columns = df.schema.json()
        note(spark, path, [(run, p, COMPLETE, counts.get(p, 0), columns, None) for p in parts])
    except Exception as error:
        note(spark, path, [_failed(run, p, error) for p in parts])
        raise
    return run


def day_of(ts: str) -> Column:
    return F.date_format(F.col(ts), "yyyy-MM-dd")


def publish_days(df: DataFrame, path: str, start: Time, end: Time, ts: str = "startTime", near: Column | None = None) -> str:
    """Replaces the days of [start, end), from midnight to midnight, in one step."""
    return publish(df, path, day_of(ts), [d.isoformat() for d in days_of(start, end)], near)


def read_published(spark: SparkSession, path: str, start: Time, end: Time, ts: str = "startTime") -> DataFrame:
    """Rows with ``start <= ts < end`` of a table in days."""
    first, last = (date.fromisoformat(str(t)[:10]) for t in (start, end))
    days = [(first + timedelta(days=n)).isoformat() for n in range((last - first).days + 1)]
    return scan_range(read_parts(spark, path, days).drop(PART), ts, start, end)


def open_days(spark: SparkSession, path: str, start: Time, end: Time) -> dict[date, str | None]:
    """The days of the range that are not complete, with their state: None for a day that was never run."""
    asked = days_of(start, end)
    have = {r.part: r.state for r in states(spark, path).where(F.col(PART).isin([d.isoformat() for d in asked])).collect()}
    return {d: have.get(d.isoformat()) for d in asked if have.get(d.isoformat()) != COMPLETE}


def fill_days(
    spark: SparkSession, path: str, start: Time, end: Time, compute: Callable[[datetime, datetime], DataFrame], ts: str = "startTime", longest: int = 31
) -> dict[date, str]:
    """Runs ``compute`` over each unbroken span of open days, of ``longest`` days at most, and publishes its rows.

    Failed and killed days are run again like those never run. A span that fails is noted and the others go on;
    returned are the days that failed, with the error.
    """
    spans: list[list[date]] = []
    for day in open_days(spark, path, start, end):
        if spans and spans[-1][-1] + timedelta(days=1) == day and len(spans[-1]) < longest:
            spans[-1].append(day)
        else:
            spans.append([day])
    failed: dict[date, str] = {}
    for span in spans:
        first, last = (datetime.combine(d, datetime.min.time()) for d in (span[0], span[-1] + timedelta(days=1)))
        try:
            rows = compute(first, last)
        except Exception as error:  # noqa: BLE001  the log has it, and the caller
            note(spark, path, [_failed(f"r{uuid.uuid4().hex}", d.isoformat(), error) for d in span])
            failed |= dict.fromkeys(span, _text(error))
            continue
        try:
            publish_days(rows, path, first, last, ts)
        except Exception as error:  # noqa: BLE001
            failed |= dict.fromkeys(span, _text(error))
    return failed


def _text(error: Exception) -> str:
    return f"{type(error).__name__}: {str(error)[:200]}"


def _failed(run: str, part: str, error: Exception) -> tuple:
    return run, part, FAILED, None, None, _text(error)


def merge(
    spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], op_col: str, order: Sequence[str | Column], part: Column
) -> list[str]:
    """Applies keyed changes (see ``apply_changes``) to the published rows, and returns the parts that were rewritten.

    Copy on write: only parts that hold a changed key, or get a row by a change, are read whole and published again,
    together in one step; the files of the others stay. To find them, only the keys of the table are read. A change may
    move a row to another part.
    """
    table = read_parts(spark, path)
    values = [c for c in table.columns if c != PART]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(op_col, *[c for c in values if c not in keys]), F.struct(*order)).alias("__new"))
    last = last.select(*keys, "__new.*")
    held = table.select(*keys, PART).join(last.select(*keys), list(keys), "left_semi").select(PART)
    coming = last.where(F.col(op_col) != "delete").select(part.alias(PART))
    touched = sorted(r[0] for r in held.union(coming).distinct().collect())  # names of parts
    if not touched:
        return []
    base = read_parts(spark, path, touched).select(*values)
    merged = apply_changes(base, last.withColumn("__at", F.lit(0)), keys, op_col, ["__at"])
    publish(merged, path, part, touched)
    return touched
