"""Upsert tables as versioned Parquet, written by streams and read as newest row per key.

Layout: ``<path>/event_date=D/version=V/``. Batch N of a stream writes version 2N by dynamic
partition overwrite, so a replayed batch replaces itself and nothing else. Reading keeps the
row of the highest version per key, which is last-write-wins. Folding a closed date rewrites
it as an odd version above everything it folds, so a fold that dies half-way leaves a table
that still reads correctly.

Every version leaves one small record in ``<path>.ledger``: its rows, its dates, and the range
of its write times, observed while it was written. The audit, retention, the newest alerts and
the delivery of alerts are planned from these records instead of from the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse import schemas
from roadpulse.functions.times import before, instant, moment
from roadpulse.operators.latest import has_fixed_width, latest_by, newest_values
from roadpulse.operators.merge import expire
from roadpulse.settings import DEFAULTS, Thresholds
from roadpulse.streaming import files, newest, records


EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


@dataclass(frozen=True)
class UpsertTable:
    """A keyed table; ``order`` holds extra columns that break ties within one batch."""

    path: str
    columns: T.StructType
    keys: tuple[str, ...]
    order: tuple[T.StructField, ...] = ()
    # a log keeps every row of every version instead of the newest row per key
    keeps_all: bool = False

    @property
    def ledger(self) -> str:
        return f"{self.path}.ledger"

    @property
    def stored(self) -> T.StructType:
        return T.StructType(
            [
                *self.columns.fields,
                *self.order,
                T.StructField("ingested_at", T.TimestampType()),
                T.StructField("event_date", T.DateType()),
                T.StructField("version", T.LongType()),
            ]
        )


def congestion_table(path: str) -> UpsertTable:
    return UpsertTable(path, schemas.CONGESTION_METRICS, ("corridor_id", "event_time"))


def vehicle_table(path: str) -> UpsertTable:
    return UpsertTable(path, schemas.VEHICLE_SPEED_METRICS, ("corridor_id", "event_time"))


def weather_table(path: str) -> UpsertTable:
    return UpsertTable(
        path,
        schemas.WEATHER_METRICS,
        ("location", "event_time"),
        (T.StructField("offset", T.LongType()),),
    )


def alert_table(path: str) -> UpsertTable:
    """The alert log: every raise of a batch is kept, so it is read with ``read_log``."""
    return UpsertTable(
        path,
        schemas.CONGESTION_ALERTS,
        ("corridor_id", "event_time"),
        (T.StructField("raised_in", T.LongType()),),
        keeps_all=True,
    )


# One record per version and, for folds, per date; ``dates`` are all dates it has rows of.
LEDGER = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("dates", T.ArrayType(T.DateType())),
        T.StructField("first_written", T.TimestampType()),
        T.StructField("last_written", T.TimestampType()),
    ]
)


def batch_version(batch_id: int) -> int:
    return 2 * batch_id


def write_version(rows: DataFrame, table: UpsertTable, version: int, written_at=None) -> None:
    """Write rows as one version, replacing that version wherever the rows fall.

    Rows of a log also carry the version they were first written in, which folding keeps.
    """
    spark, now = rows.sparkSession, moment(written_at)
    data = table.columns.names + [f.name for f in table.order if f.name != "raised_in"]
    raised = [F.lit(version).cast("long").alias("raised_in")] if table.keeps_all else []
    seen = Observation()
    placed = rows.select(
        *data,
        *raised,
        instant(now).alias("ingested_at"),
        F.to_date("event_time").alias("event_date"),
        F.lit(version).cast("long").alias("version"),
    ).observe(seen, F.count(F.lit(1)).alias("n"), F.collect_set("event_date").alias("dates"))
    _overwrite(placed, table)
    found = seen.get
    # also without rows: a replay may have fewer than what it replaces
    _record(spark, table, version, found.get("n", 0), found.get("dates") or [], now, now, now)


def _overwrite(placed: DataFrame, table: UpsertTable, options: dict[str, str] | None = None) -> None:
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(
        **(options or {})
    ).partitionBy("event_date", "version").parquet(table.path)


def _lookup_options(table: UpsertTable) -> dict[str, str]:
    """How folded files are written: rows come sorted by key, in pages that are skipped singly.

    The Bloom filter tells which row groups lack an entity altogether.
    """
    return {
        f"parquet.bloom.filter.enabled#{table.keys[0]}": "true",
        "parquet.page.row.count.limit": "2000",
    }


def _record(spark, table: UpsertTable, version: int, n: int, dates, first, last, at) -> None:
    days = sorted(str(d) for d in dates)
    name = _record_name(version) + (f"-{days[0]}" if version % 2 else "")
    record = {
        "version": version,
        "rows_written": n,
        "dates": days,
        "first_written": first.astimezone(timezone.utc).isoformat(),
        "last_written": last.astimezone(timezone.utc).isoformat(),
    }
    records.write(spark, table.ledger, name, record, at)


def _record_name(version: int) -> str:
    return f"version-{version:012d}"


def read_ledger(spark: SparkSession, table: UpsertTable, above: int | None = None) -> DataFrame:
    """What every version (or every later one) holds or held, folds included.

    Removed versions keep their record.
    """
    ledger = records.read(spark, table.ledger, LEDGER, None if above is None else _record_name(above))
    return ledger if above is None else ledger.where(F.col("version") > above)


def pack_ledger(spark: SparkSession, table: UpsertTable) -> int:
    """Put the ledger's records into one file; returns how many single ones there were."""
    return records.pack(spark, table.ledger, LEDGER)


def _days(
    spark: SparkSession, table: UpsertTable, since=None, until=None
) -> list[str]:
    """Dates that have a folder, from ``since`` on and before the date of ``until``."""
    days = [c.split("=")[1] for c in files.children(spark, table.path, "event_date=")]
    first = moment(since).astimezone(timezone.utc).date().isoformat() if since else ""
    end = moment(until).astimezone(timezone.utc).date().isoformat() if until else None
    return [d for d in days if first <= d and (end is None or d < end)]


def read_log(
    spark: SparkSession, table: UpsertTable, days: list[str] | None = None, above: int | None = None
) -> DataFrame:
    """Every stored row with its version; an absent table is empty.

    With ``days``, only those date folders are listed and read; ``above`` reads rows of later
    versions only. Rows of a log that was folded have the version they were first written in.
    """
    if days is None:
        days = _days(spark, table)
    if not days:
        return spark.createDataFrame([], table.stored)
    log = (
        spark.read.schema(table.stored)
        .option("basePath", table.path)
        .parquet(*[f"{table.path}/event_date={d}" for d in days])
    )
    if above is not None:
        log = log.where(F.col("version") > above)
    if not table.keeps_all:
        return log
    for day, fold_version in _half_folded(spark, table, days).items():
        here = F.col("event_date") == F.lit(day).cast("date")
        log = log.where(~here | (F.col("version") >= fold_version))
    log = log.withColumn("version", F.coalesce("raised_in", "version"))
    return log if above is None else log.where(F.col("version") > above)


def _half_folded(spark: SparkSession, table: UpsertTable, days: list[str]) -> dict[str, int]:
    """Dates that hold a fold beside versions it took up, with the fold's version.

    A fold appears as a whole, so what lies below it is there twice.
    """
    found = {}
    for day in days:
        versions = _versions(spark, table, day)
        fold_version = max((v for v in versions if v % 2), default=-1)
        if any(v < fold_version for v in versions):
            found[day] = fold_version
    return found


def _newest(log: DataFrame, table: UpsertTable) -> DataFrame:
    if not table.order and has_fixed_width(table.stored, table.keys):
        return newest_values(log, table.keys, "version")
    return latest_by(log, table.keys, ["version", *[f.name for f in table.order]])


def _folded(spark: SparkSession, table: UpsertTable, days: list[str]) -> dict[str, int]:
    """Those of the dates that consist of nothing but one fold, with its version."""
    folded = {}
    for day in days:
        versions = _versions(spark, table, day)
        if len(versions) == 1 and versions[0] % 2 == 1:
            folded[day] = versions[0]
    return folded


def days_held(spark: SparkSession, table: UpsertTable, since=None) -> list[str]:
    """Dates that have rows, from the date of ``since`` on."""
    return _days(spark, table, since)


def folded_days(spark: SparkSession, table: UpsertTable, since=None) -> dict[str, int]:
    """Dates that consist of one fold and nothing else, with its version."""
    return _folded(spark, table, _days(spark, table, since))


def _versions(spark: SparkSession, table: UpsertTable, day: str) -> list[int]:
    """Versions that one date holds, by the names of their folders."""
    found = files.children(spark, f"{table.path}/event_date={day}", "version=")
    return [int(name.split("=")[1]) for name in found]


def read_table(
    spark: SparkSession,
    table: UpsertTable,
    since=None,
    live_at=None,
    th: Thresholds = DEFAULTS,
    days: list[str] | None = None,
) -> DataFrame:
    """The table as keyed rows, last write wins.

    ``since`` limits the date folders that are listed, and ``days`` names those to read;
    ``live_at`` leaves out rows past retention at that moment, before the newest are sought,
    since a key's older writes expire first. Folded dates hold every key once and are read as
    they are; only the dates still open go through the shuffle that finds the newest row per key.
    """
    days = _days(spark, table, since) if days is None else days
    folded = _folded(spark, table, days)
    log = read_log(spark, table, days)
    if since is not None:
        log = log.where(F.col("event_time") >= instant(since))
    if live_at is not None:
        log = expire(log, live_at, th)
    columns = [*table.columns.names, "ingested_at"]
    if not folded:
        return _newest(log, table).select(*columns)
    day = F.col("event_date").cast("string")
    pairs = [(day == d) & (F.col("version") == v) for d, v in folded.items()]
    closed = log.where(reduce(lambda a, b: a | b, pairs))
    still_open = log.where(~day.isin(*folded))
    return closed.select(*columns).unionByName(_newest(still_open, table).select(*columns))


def _newest_schema(table: UpsertTable) -> T.StructType:
    return T.StructType([f for f in table.stored.fields if f.name != "event_date"])


def _newest_folder(table: UpsertTable) -> str:
    return f"{table.path}.newest"


def _newest_order(table: UpsertTable) -> list[str]:
    return ["event_time", "version", *[f.name for f in table.order]]


def rows_above(spark: SparkSession, table: UpsertTable, version: int) -> DataFrame:
    """Rows of the log from versions after ``version``; only dates the ledger names are read."""
    later = read_ledger(spark, table, version).where(
        (F.col("version") % 2 == 0) & (F.col("rows_written") > 0)
    )
    days = later.select(F.explode(F.col("dates").cast("array<string>")).alias("day")).distinct().collect()
    return read_log(spark, table, sorted(r["day"] for r in days), above=version)


# A lookup of so many keys names them to the file reader; more keys are joined.
NAMED_KEYS = 1000


def lookup(spark: SparkSession, table: UpsertTable, keys: DataFrame, live_at=None) -> DataFrame:
    """The table's rows whose key is among ``keys``, repeated or not.

    Only the keys' dates are read. Up to ``NAMED_KEYS`` keys become a filter that the Parquet
    reader tests against Bloom filters and the ranges of row groups and pages, which folding
    has sorted by key; more are joined by the planner's choice.
    """
    wanted = keys.select(*table.keys).dropna().distinct()
    day = F.to_date("event_time").cast("string").alias("day")
    days = {r["day"] for r in wanted.select(day).distinct().collect()}
    held = [d for d in _days(spark, table) if d in days]
    rows = read_table(spark, table, live_at=live_at, days=held)
    first = wanted.limit(NAMED_KEYS + 1).collect()
    if len(first) <= NAMED_KEYS:
        entity, *rest = table.keys
        named: dict = {}
        for r in first:
            named.setdefault(r[entity], []).append(r)
        tests = [
            (F.col(entity) == one) & reduce(
                lambda a, b: a & b, [F.col(c).isin([r[c] for r in of_one]) for c in rest], F.lit(True)
            )
            for one, of_one in named.items()
        ]
        rows = rows.where(reduce(lambda a, b: a | b, tests, F.lit(False)))
    return rows.join(wanted, list(table.keys), "left_semi")


def advance_newest(spark: SparkSession, table: UpsertTable, version: int) -> None:
    """Bring the table of newest rows per entity up to a version that was just written.

    The entity is the first of the table's keys. The first call takes the whole log, later ones
    only what was written since the snapshot below ``version``.
    """
    folder = _newest_folder(table)
    below = [v for v in newest.versions(spark, folder) if v < version]
    rows = rows_above(spark, table, below[-1]) if below else read_log(spark, table)
    rows = rows.where((F.col("version") <= version) | (F.col("version") % 2 == 1))
    changed = rows.where(F.col("event_time").isNotNull()).select(*_newest_schema(table).names)
    newest.merge(folder, changed, [table.keys[0]], _newest_order(table), version)


def read_newest(
    spark: SparkSession,
    table: UpsertTable,
    entity: str,
    live_at=None,
    th: Thresholds = DEFAULTS,
    known: DataFrame | None = None,
) -> DataFrame:
    """The newest row of every entity.

    With a table of newest rows that is read, together with what the log has got since; only
    entities whose newest row is past retention are sought in the log. Without one the log is
    read: all of it, or with ``known`` (a list of entities, repeated or not) the newest date,
    then two, four and so on until every known entity has been met, or all dates are read. Other
    entities come out if they are among the rows read.
    """
    held = newest.versions(spark, _newest_folder(table)) if entity == table.keys[0] else []
    if held:
        return _kept_newest(spark, table, entity, held[-1], live_at, th).select(*table.columns.names)
    days = _days(spark, table)[::-1]
    span = len(days) if known is None else 1
    while True:
        log = read_log(spark, table, days[:span])
        if live_at is not None:
            log = expire(log, live_at, th)
        if span >= len(days):
            break
        met = log.where(F.col("event_time").isNotNull()).select(entity)
        if known.select(entity).join(met, entity, "left_anti").isEmpty():
            break
        span *= 2
    return latest_by(log, [entity], _newest_order(table)).select(*table.columns.names)


def _kept_newest(spark, table: UpsertTable, entity: str, version: int, live_at, th: Thresholds) -> DataFrame:
    schema = _newest_schema(table)
    rows = newest.read(spark, _newest_folder(table), schema)
    since = rows_above(spark, table, version)
    rows = latest_by(rows.unionByName(since.select(*schema.names)), [entity], _newest_order(table))
    if live_at is None:
        return rows
    live = expire(rows, live_at, th)
    past = rows.where(F.col("ingested_at") <= before(live_at, days=th.retention_days)).select(entity)
    if past.isEmpty():
        return live
    # an older row that was written later may still be live
    log = expire(read_log(spark, table), live_at, th).join(past, entity, "left_semi")
    return live.unionByName(latest_by(log.select(*schema.names), [entity], _newest_order(table)))


def read_newest_day(spark: SparkSession, table: UpsertTable) -> DataFrame:
    """The log of the newest date that has rows, which also holds the newest event time."""
    for day in reversed(_days(spark, table)):
        if files.has_children(spark, f"{table.path}/event_date={day}", "version="):
            return read_log(spark, table, [day])
    return read_log(spark, table, [])


def batch_audit(log: DataFrame) -> DataFrame:
    """Rows written per batch, counted from the stored versions."""
    return _per_batch(_version_counts(log))


def lasting_audit(spark: SparkSession, table: UpsertTable) -> DataFrame:
    """Rows written per batch, by the records of the ledger: no data is read.

    Batches of a table from before it had a ledger are counted once and recorded.
    """
    complete_ledger(spark, table)
    batches = read_ledger(spark, table).where((F.col("version") % 2 == 0) & (F.col("rows_written") > 0))
    counts = batches.select("version", "rows_written")
    if files.has_children(spark, _audit_path(table), "part-"):
        # a version is counted again when maintenance died between counting and removing it
        old = spark.read.schema("event_date date, version bigint, rows_written bigint").parquet(_audit_path(table))
        once = old.groupBy("event_date", "version").agg(F.max("rows_written").alias("rows_written"))
        counts = counts.unionByName(once.drop("event_date").join(counts, "version", "left_anti"))
    return _per_batch(counts)


def _audit_path(table: UpsertTable) -> str:
    """Counts that folding and retention kept before there was a ledger."""
    return f"{table.path}.audit"


def _version_counts(log: DataFrame) -> DataFrame:
    """Rows of every batch and date; folds are not batches."""
    written = log.where(F.col("version") % 2 == 0).groupBy("event_date", "version")
    return written.agg(F.count("*").alias("rows_written"))


def _per_batch(counts: DataFrame) -> DataFrame:
    batch = (F.col("version") / 2).cast("long").alias("batch_id")
    return counts.groupBy(batch).agg(F.sum("rows_written").alias("rows_written"))


def _keep_counts(table: UpsertTable, log: DataFrame) -> None:
    """Add the counts of versions to the audit of a table without ledger."""
    _version_counts(log).write.mode("append").parquet(_audit_path(table))


def complete_ledger(spark: SparkSession, table: UpsertTable, days: list[str] | None = None) -> int:
    """Record versions that are there without a record; returns how many records it added.

    That happens to folds that died before they were recorded and to tables from before the
    ledger. Folder names are compared with the records; only versions without one are read.
    """
    days = _days(spark, table) if days is None else days
    held = [(day, version) for day in days for version in _versions(spark, table, day)]
    if not held:
        return 0
    known = read_ledger(spark, table).select("version", F.explode(F.col("dates").cast("array<string>")).alias("day"))
    missing = spark.createDataFrame(held, "day string, version bigint").join(known, ["version", "day"], "left_anti")
    lacking = {(r["day"], r["version"]) for r in missing.collect()}
    # a batch has one record for all its dates, a fold one for each
    batches = {version for _, version in lacking if version % 2 == 0}
    wanted = [p for p in held if p in lacking or p[1] in batches]
    if not wanted:
        return 0
    stats = (
        spark.read.schema(table.stored)
        .option("basePath", table.path)
        .parquet(*[f"{table.path}/event_date={d}/version={v}" for d, v in wanted])
        .groupBy("version", F.when(F.col("version") % 2 == 1, F.col("event_date")).alias("fold_date"))
        .agg(
            F.count("*").alias("n"),
            F.collect_set("event_date").alias("dates"),
            F.min("ingested_at").alias("first"),
            F.max("ingested_at").alias("last"),
        )
    )
    found = stats.withColumns({c: F.unix_micros(c) for c in ("first", "last")}).collect()
    for r in found:
        first, last = (EPOCH + timedelta(microseconds=r[c]) for c in ("first", "last"))
        _record(spark, table, r["version"], r["n"], r["dates"], first, last, moment())
    return len(found)


def fold(spark: SparkSession, table: UpsertTable, closed_before) -> int:
    """Rewrite every date before that of ``closed_before`` as one version; drop the others.

    Returns the number of dates rewritten. A stream may run beside it: whatever it adds later
    has a higher version than the fold. Readers that started before may lose their files and
    must run again. What is to do follows from the folders' names; only dates to be rewritten
    are read. Files hold ranges of keys, sorted, so a lookup opens few of them. A log keeps all
    its rows.
    """
    held = {
        day: _versions(spark, table, day) for day in _days(spark, table, until=closed_before)
    }
    tops = {day: max(versions) for day, versions in held.items() if versions}
    # An odd top version already holds its whole date; only leftovers remain to be dropped.
    todo = {day: top + 1 for day, top in tops.items() if top % 2 == 0}
    if todo:
        complete_ledger(spark, table, list(todo))
        log = read_log(spark, table, list(todo))
        folds = F.create_map(*[F.lit(x) for pair in todo.items() for x in pair])
        rows = log if table.keeps_all else _newest(log, table)
        rows = rows.withColumn("version", folds[F.col("event_date").cast("string")].cast("long"))
        # the writer's own order comes first, or it would sort again
        place = ["event_date", "version", *table.keys]
        even = rows.select(*table.stored.names).repartitionByRange(_fold_files(spark, table, todo), *place)
        _overwrite(even.sortWithinPartitions(*place), table, _lookup_options(table))
        complete_ledger(spark, table, list(todo))
    for day, top in tops.items():
        for version in held[day]:
            if version < todo.get(day, top):
                files.delete(spark, f"{table.path}/event_date={day}/version={version}")
    return len(todo)


# Rows that one file of a fold has at most about.
FOLD_ROWS = 2_000_000


def _fold_files(spark: SparkSession, table: UpsertTable, days) -> int:
    """Into how many key ranges dates are folded, by the rows the ledger has of their versions."""
    ledger = read_ledger(spark, table).where("version % 2 = 0")
    touched = ledger.where(F.arrays_overlap(F.col("dates").cast("array<string>"), F.array(*map(F.lit, days))))
    rows = touched.agg(F.sum("rows_written")).first()[0] or 0
    return 1 + rows // FOLD_ROWS


def drop_expired(
    spark: SparkSession, table: UpsertTable, as_of, th: Thresholds = DEFAULTS
) -> int:
    """Delete version folders whose newest write is past retention; returns how many.

    Which those are follows from the ledger and the folders' names: no data is read.
    """
    days = _days(spark, table)
    complete_ledger(spark, table, days)
    past = F.col("last_written") <= before(as_of, days=th.retention_days)
    old = read_ledger(spark, table).where(past).select("version", F.explode(F.col("dates").cast("array<string>")).alias("day"))
    dropped = 0
    for r in old.where(F.col("day").isin(*days)).toLocalIterator():
        folder = f"{table.path}/event_date={r['day']}"
        if r["version"] not in _versions(spark, table, r["day"]):
            continue
        files.delete(spark, f"{folder}/version={r['version']}")
        if not files.children(spark, folder):
            files.delete(spark, folder)
        dropped += 1
    return dropped


def newest_log_rows(spark: SparkSession, table: UpsertTable, n: int) -> DataFrame:
    """Rows of a log among which are its ``n`` last written ones.

    The ledger says in which versions these are, so only the dates of the newest few versions
    are read. A log whose ledger has fewer rows than that is read whole.
    """
    written = read_ledger(spark, table).where((F.col("version") % 2 == 0) & (F.col("rows_written") > 0))
    newest = written.orderBy(F.desc("last_written"), F.desc("version")).limit(n)
    total, cutoff = 0, None
    for r in newest.select("rows_written", F.unix_micros("last_written").alias("at")).collect():
        total += r["rows_written"]
        if total >= n:
            cutoff = F.lit(EPOCH + timedelta(microseconds=r["at"]))
            break
    if cutoff is None:
        return read_log(spark, table)
    days = written.where(F.col("last_written") >= cutoff).select(F.explode(F.col("dates").cast("array<string>")).alias("day"))
    found = sorted(r["day"] for r in days.distinct().collect())
    return read_log(spark, table, found).where(F.col("ingested_at") >= cutoff)


def publish_snapshot(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Write a small whole table as its next snapshot, beside the one it may derive from.

    Older ones than that are removed; whoever still reads the one before is not disturbed.
    """
    complete = _snapshots(spark, path)
    number = 1 + max(complete, default=-1)
    df.write.mode("overwrite").parquet(f"{path}/snapshot={number}")
    for old in sorted(complete)[:-1]:
        files.delete(spark, f"{path}/snapshot={old}")
    return number


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest complete snapshot; an absent table is empty."""
    numbers = _snapshots(spark, path)
    if not numbers:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/snapshot={max(numbers)}")


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    return [
        int(child.split("=")[1])
        for child in files.children(spark, path, "snapshot=")
        if files.exists(spark, f"{path}/{child}/_SUCCESS")
    ]
