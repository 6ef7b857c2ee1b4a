"""Files, tables, and publishing several outputs as one."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from orderlake.contracts import POSITION, ContractError, PublishConflict
from orderlake.sources.staging import delete_folder, observed

MANIFEST = "published"
_VERSION, _FOLDED = re.compile(r"(\d{20})\.json.*"), ".folded-"
_ENTRY = (
    "published_at string, run_id string, attempt string, "
    "outputs map<string, array<string>>, schemas map<string, string>, batches array<string>"
)


def _plain_double(name: str):
    """Whole doubles as ``15000000.0`` rather than ``1.5E7``."""
    c = F.col(name)
    whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
    return F.when(whole, F.concat(c.cast("bigint").cast("string"), F.lit(".0"))).otherwise(
        c.cast("string")
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header and doubled quotes, replacing what is there.

    ``single_file`` is for reports, which are small by construction.
    """
    plain = {c: _plain_double(c) for c, kind in df.dtypes if kind == "double"}
    out = df.drop(POSITION).withColumns(plain)
    if single_file:
        out = out.coalesce(1)
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def sorted_by_time(df: DataFrame) -> DataFrame:
    """All rows in time order, ties by order: for a served result."""
    return df.orderBy("tanggal_order", "order_id")


def in_months(df: DataFrame) -> DataFrame:
    """Rows gathered by month, in time order.

    The rebalance gathers a month without a sampling pass over the input, and
    AQE splits a month that holds most of the rows and joins small ones.
    """
    gathered = df.hint("rebalance", F.col("order_month"))
    return gathered.sortWithinPartitions("order_month", "tanggal_order", "order_id")


def by_month(df: DataFrame):
    """A writer for the clean table: one folder per month, files in time order."""
    return in_months(df).write.mode("overwrite").partitionBy("order_month")


def replace_tables(
    tables: dict[str, DataFrame], database: str = "default", keep: int = 2
) -> str:
    """Replace several tables at once; returns their new version.

    Every table's rows go to a new partition of ``<name>__versions``. One row in
    ``table_commits`` then makes all of them current: the names are views that
    look the version up, and read its partition alone. A failure before that row
    leaves all names as they were. The last ``keep`` versions stay, so a query
    that has begun ends on the version it began with.
    """
    spark = next(iter(tables.values())).sparkSession
    commits, group = f"{database}.table_commits", ",".join(sorted(tables))
    version = uuid4().hex
    for name, df in tables.items():
        append_version(df, f"{database}.{name}__versions", version)
    row = spark.createDataFrame([(group, version, datetime.now(timezone.utc))], "tables string, version string, committed_at timestamp")
    row.coalesce(1).write.mode("append").saveAsTable(commits)
    for name, df in tables.items():
        _follow(spark, f"{database}.{name}", f"{database}.{name}__versions", commits, group, df.columns)
    ranked = spark.table(commits).where(F.col("tables") == group).orderBy(F.desc("committed_at")).select("version")
    current = {r.version for r in ranked.limit(keep).collect()}
    for name in tables:
        _drop_versions(spark, f"{database}.{name}__versions", current)
    return version


def append_version(df: DataFrame, name: str, version: str) -> None:
    """Write rows as one version of a table, which no reader sees yet."""
    df.withColumn("_version", F.lit(version)).write.mode("append").partitionBy("_version").format("parquet").saveAsTable(name)


def _follow(spark: SparkSession, name: str, versions: str, commits: str, group: str, columns: list[str]) -> None:
    """A view of the version committed last. A plain table of that name goes."""
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType == "VIEW":
            if spark.table(name).columns == columns:
                return
        else:
            spark.sql(f"DROP TABLE {name}")
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM {versions} WHERE _version = "
        f"(SELECT max_by(version, committed_at) FROM {commits} WHERE tables = '{group}')"
    )


def _drop_versions(spark: SparkSession, name: str, keep: set[str]) -> None:
    held = {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for version in sorted(held - keep):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (_version = '{version}')")


class Attempt:
    """Outputs of one run, written, looked at, then published together.

    Every output goes to a folder of this attempt. Counters are collected by the
    writes, so a gate or a table of counters needs no pass of its own. ``commit``
    names the attempt, its columns and the landed batches it took in the manifest;
    readers follow the manifest, so an attempt that fails changes nothing. Two
    attempts that began on the same manifest may not both publish a run or take a
    batch: the later one fails with ``PublishConflict``.
    """

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root, self.run_id = spark, root, run_id
        self.name, self.outputs, self.schemas, self.paths = uuid4().hex, {}, {}, []
        self.seen = _newest_version(spark, root)

    def write(
        self, name: str, df: DataFrame, monthly: bool = False, by: str | None = None, **counters
    ) -> tuple[DataFrame, dict]:
        """Write an output, in folders ``by`` a column or by month; returns it as written,
        and its size and counters. Columns that begin with ``_`` only serve counters."""
        path = _attempt_path(self.root, name, self.run_id, self.name)
        self.paths.append(path)
        columns = [c for c in df.columns if not c.startswith("_")]
        if monthly:
            df, by = in_months(df), "order_month"
        counted, seen = observed(df, counters)
        writer = counted.select(columns).write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(path)
        kind = df.select(columns).schema
        self.outputs[name], self.schemas[name] = columns, kind.json()
        told = {k: v or 0 for k, v in seen.get.items()} | {"columns": len(columns)}
        # An output without rows in folders has no file to read the columns from.
        return self.spark.read.schema(kind).parquet(path).select(columns), told

    def commit(self, batches: list[str] | None = None) -> None:
        now = datetime.now(timezone.utc).isoformat()
        entry = {
            "published_at": now, "run_id": self.run_id, "attempt": self.name,
            "outputs": self.outputs, "schemas": self.schemas, "batches": batches or [],
        }
        while not _claim(self.spark, self.root, self.seen + 1, json.dumps(entry)):
            newer = _manifest(self.spark, self.root).where(F.col("version") > self.seen)
            for row in newer.collect():
                taken = set(row.batches or []) & set(batches or [])
                if row.run_id == self.run_id or taken:
                    raise PublishConflict(f"{self.root}: run {row.run_id} was published meanwhile")
                self.seen = max(self.seen, row.version)

    def discard(self) -> None:
        for path in self.paths:
            delete_folder(self.spark, path)


@contextmanager
def attempt(spark: SparkSession, root: str, run_id: str) -> Iterator[Attempt]:
    """An attempt whose folders go if it fails."""
    now = Attempt(spark, root, run_id)
    try:
        yield now
    except BaseException:
        now.discard()
        raise


def publish(
    outputs: dict[str, DataFrame], root: str, run_id: str, monthly: tuple[str, ...] = (),
    batches: list[str] | None = None,
) -> None:
    """Write all outputs and publish them as one run."""
    with attempt(next(iter(outputs.values())).sparkSession, root, run_id) as now:
        for name, df in outputs.items():
            now.write(name, df, name in monthly)
        now.commit(batches)


def _files(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, folder: str) -> list:
    """Status of what a folder holds; nothing if it is not there."""
    path, files = _files(spark, folder)
    return list(files.listStatus(path)) if files.exists(path) else []


def _newest_version(spark: SparkSession, root: str) -> int:
    """Manifest entries are files with their version as name."""
    names = [s.getPath().getName() for s in _children(spark, f"{root}/{MANIFEST}")]
    return max((int(m[1]) for m in map(_VERSION.fullmatch, names) if m), default=0)


def _claim(spark: SparkSession, root: str, version: int, text: str) -> bool:
    """Write a manifest file unless there is one of this version; renaming a file does
    not replace another one."""
    return _put(spark, f"{root}/{MANIFEST}", f"{version:020d}.json", text)


def vacuum(spark: SparkSession, root: str, min_age: timedelta = timedelta(days=1)) -> list[str]:
    """Fold manifest rows of replaced attempts, and remove attempts no row names.

    Only what is older than ``min_age`` goes, so that a run being written and a
    reader that follows the manifest of a moment ago keep their files. Returns the
    removed folders.
    """
    limit = (datetime.now(timezone.utc) - min_age).timestamp() * 1000
    named = {(r.run_id, r.attempt) for r in _newest_entries(spark, root).select("run_id", "attempt").collect()}
    recent = _manifest(spark, root).where(F.col("published_at") >= datetime.fromtimestamp(limit / 1000, timezone.utc).isoformat())
    named |= {(r.run_id, r.attempt) for r in recent.select("run_id", "attempt").collect()}
    removed = []
    for output in _children(spark, root):
        if output.getPath().getName() == MANIFEST:
            continue
        for run in _children(spark, f"{root}/{output.getPath().getName()}"):
            run_id = run.getPath().getName().partition("=")[2]
            for tried in _children(spark, run.getPath().toString()):
                key = (run_id, tried.getPath().getName().partition("=")[2])
                if key not in named and tried.getModificationTime() <= limit:
                    delete_folder(spark, tried.getPath().toString())
                    removed.append(tried.getPath().toString())
    _compact(spark, root, limit)
    return removed


def _compact(spark: SparkSession, root: str, limit: float) -> None:
    """Fold old manifest files into one. The files it holds go the next time, when the
    folded one is old as well, so a reader finds every row in the files it has listed;
    one that it finds twice changes nothing."""
    names = {s.getPath().getName(): s for s in _children(spark, f"{root}/{MANIFEST}")}
    old = sorted(n for n, s in names.items() if s.getModificationTime() <= limit and n.endswith(".json"))
    folded = [n for n in old if _FOLDED in n]
    if folded:
        newest = f"{_newest_version(spark, root):020d}.json"
        for name in old:
            # The newest number stays claimed.
            if name < folded[-1] and name != newest:
                delete_folder(spark, names[name].getPath().toString())
        old = [n for n in old if n >= folded[-1]]
    if len(old) < 3:
        return
    keep = {r.attempt for r in _newest_entries(spark, root).collect()}
    rows = spark.read.schema(_ENTRY).json([names[n].getPath().toString() for n in old]).orderBy("published_at").collect()
    # Batches of replaced attempts stay taken.
    text = "\n".join(
        json.dumps(r.asDict() | ({} if r.attempt in keep else {"outputs": {}, "schemas": {}}))
        for r in rows if r.attempt in keep or r.batches
    )
    version = _VERSION.fullmatch(old[-1])
    folder = f"{root}/{MANIFEST}"
    _put(spark, folder, f"{version[1] if version else '0' * 20}.json{_FOLDED}{uuid4().hex}.json", text)


def _put(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Write a file aside, then give it its name; False if that is taken."""
    aside, files = _files(spark, f"{folder}/.{uuid4().hex}.tmp")
    target, _ = _files(spark, f"{folder}/{name}")
    out = files.create(aside, False)
    out.write(bytearray(text.encode() + b"\n"))
    out.close()
    done = files.rename(aside, target) if not files.exists(target) else False
    if not done:
        files.delete(aside, False)
    return done


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the manifest, one per published attempt, with their file's version; an
    entry met again after folding counts once."""
    rows = spark.read.schema(_ENTRY).json(f"{root}/{MANIFEST}")
    version = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{20})", 1).try_cast("bigint")
    seen = rows.withColumn("version", F.coalesce(version, F.lit(0)))
    # Folded rows of replaced attempts hold no outputs; the first form is as good.
    return seen.groupBy("published_at", "run_id", "attempt").agg(
        F.max_by("outputs", F.size("outputs")).alias("outputs"),
        F.max_by("schemas", F.size("outputs")).alias("schemas"), F.max("batches").alias("batches"),
        F.max("version").alias("version"),
    )


def _newest_entries(spark: SparkSession, root: str) -> DataFrame:
    entry = F.struct("published_at", "attempt", "outputs", "schemas")
    newest = _manifest(spark, root).groupBy("run_id").agg(F.max_by(entry, F.struct("published_at", "attempt")).alias("newest"))
    return newest.select("run_id", "newest.*")


def missing_path(error: AnalysisException) -> bool:
    """Whether a read failed because there is nothing at its path, and not for
    another fault."""
    return error.getCondition() == "PATH_NOT_FOUND"


def _entries(spark: SparkSession, root: str, column: str) -> list:
    try:
        return [row[0] for row in _manifest(spark, root).orderBy("published_at").select(column).collect()]
    except AnalysisException as error:
        if missing_path(error):
            return []
        raise


def published_runs(spark: SparkSession, root: str) -> list[str]:
    """Names of all complete runs, in the order they were first published."""
    return list(dict.fromkeys(_entries(spark, root, "run_id")))


def published_batches(spark: SparkSession, root: str) -> set[str]:
    """The landed batches that complete runs have taken."""
    return {name for names in _entries(spark, root, "batches") for name in names or []}


def runs_without(spark: SparkSession, root: str, name: str) -> list[str]:
    """Published runs that do not hold an output."""
    if not _newest_version(spark, root) and not published_runs(spark, root):
        return []
    rows = _newest_entries(spark, root).where(F.col("outputs")[name].isNull())
    return [r.run_id for r in rows.select("run_id").collect()]


def published(
    spark: SparkSession, root: str, name: str, every_run: bool = False, runs: list[str] | None = None
) -> DataFrame:
    """The output of the latest complete run, or of all or some of them, each by its
    newest attempt; columns are in the order they were published in."""
    newest = _newest_entries(spark, root).select(
        "published_at", "run_id", "attempt", F.col("outputs")[name].alias("columns"),
        F.col("schemas")[name].alias("kind"),
    ).where(F.col("columns").isNotNull()).orderBy(F.desc("published_at"))
    if runs is not None:
        newest = newest.where(F.col("run_id").isin(runs))
    found = (newest if every_run else newest.limit(1)).collect()
    if not found:
        raise ContractError(f"no published run holds {name}")
    paths = [_attempt_path(root, name, row.run_id, row.attempt) for row in found]
    reader = spark.read.option("basePath", f"{root}/{name}")
    if found[0].kind:
        reader = reader.schema(StructType.fromJson(json.loads(found[0].kind)))
    return reader.parquet(*paths).select(found[0].columns)


def _attempt_path(root: str, name: str, run_id: str, attempt: str) -> str:
    return f"{root}/{name}/run_id={run_id}/attempt={attempt}"
