"""Stages of sessions kept up to date: only what changed files touch is computed again.

Cleaned sessions, station-hours and features are stored by month. A manifest holds each
source file's length and time of change, and the months it has rows in. An update reads the
new and changed files only; their months, old and new, are rewritten in the first two
stages. In the features stage, the months that lie within the longest look-back after them
are rewritten as well, with the rows before them as history. Nothing changed: nothing runs.

The manifest is written last, and the months an update is about to rewrite before anything
else, so an update that broke off is made good by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from chargelake import config
from chargelake.operators.cleaning import clean_sessions
from chargelake.operators.features import build_features
from chargelake.operators.rollup import hourly_sessions
from chargelake.session import stored
from chargelake.sources import storage
from chargelake.sources.readers import read_sessions_csv

MONTH = "ym"
_FILE = "source_file"
_MANIFEST = "file string, path string, length bigint, modified timestamp, months array<string>"


@dataclass(frozen=True)
class Update:
    """What an update did: source files read and gone, and months rewritten."""

    read: list[str] = field(default_factory=list)
    gone: list[str] = field(default_factory=list)
    months: list[str] = field(default_factory=list)
    feature_months: list[str] = field(default_factory=list)

    @property
    def skipped(self) -> bool:
        return not (self.read or self.gone or self.months)


def month(ts: str) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit("none"))


def _named(path: Column) -> Column:
    """The one of a path's spellings that readers and listings share."""
    return F.regexp_replace(path, "^file:/+", "file:/")


class SessionStages:
    """The stages below `folder` of the session files in `source`.

    `read` turns a list of files into raw sessions, row by row from the files. `reach` is
    how many rows the features look back.
    """

    def __init__(self, spark: SparkSession, source: str, folder: str,
                 read: Callable[[SparkSession, list[str]], DataFrame] = read_sessions_csv,
                 reach: int = max(*config.LAGS, *config.ROLLING_ROWS), chunk: str = "month"):
        self.spark, self.source, self.folder = spark, source, folder.rstrip("/")
        self.read_files, self.reach, self.chunk = read, reach, chunk

    def sessions(self) -> DataFrame:
        return self._stage("sessions").drop(MONTH, _FILE)

    def hours(self) -> DataFrame:
        return self._stage("hours").drop(MONTH)

    def features(self) -> DataFrame:
        return self._stage("features").drop(MONTH)

    def update(self) -> Update:
        """Bring all stages up to date with the source files."""
        now, before = self._listing(), self._manifest()
        same = [now["file"] == before["file"], now["length"] == before["length"],
                now["modified"] == before["modified"]]
        changed = [(r["file"], r["path"]) for r in now.join(before, same, "left_anti").collect()]
        gone = before.join(now, "file", "left_anti")
        gone_files = [r["file"] for r in gone.select("file").collect()]
        interrupted = self._pending()
        if not changed and not gone_files and not interrupted:
            return Update()

        version = max([0, *self._versions("manifest"), *self._versions("pending")]) + 1
        new = self._new_rows([path for _, path in changed])
        left = self.spark.createDataFrame(
            [(f,) for f in [*(f for f, _ in changed), *gone_files]], "file string")
        old_months = before.join(left, "file", "left_semi").select(F.explode("months").alias(MONTH))
        touched = sorted({r[0] for r in new.select(MONTH).distinct().union(
            old_months.distinct()).collect()} | set(interrupted))
        self._write_version("pending", version, self.spark.createDataFrame(
            [(m,) for m in touched], f"{MONTH} string"))

        self._rewrite_sessions(new, left, touched)
        hours = hourly_sessions(self._months("sessions", touched).drop(MONTH, _FILE))
        self._rewrite("hours", stored(hours.withColumn(MONTH, month("timestamp")), "hours"), touched)
        behind = self._rewrite_features(touched)

        months_of = new.groupBy(_FILE).agg(F.sort_array(F.collect_set(MONTH)).alias("found"))
        kept = before.join(left, "file", "left_anti").select("file", F.col("months").alias("known"))
        manifest = now.join(months_of, now["file"] == months_of[_FILE], "left").join(
            kept, "file", "left").select(
            "file", "path", "length", "modified",
            F.coalesce("found", "known", F.array().cast("array<string>")).alias("months"))
        self._write_version("manifest", version, manifest)
        return Update(sorted(f for f, _ in changed), sorted(gone_files), touched, behind)

    # source files and the manifest

    def _listing(self) -> DataFrame:
        """The source files; their content is not read."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
            self.source)
        return stored(files.select(
            _named(F.col("_metadata.file_path")).alias("file"), "path", "length",
            F.col("modificationTime").alias("modified")), "listing")

    def _versions(self, kind: str) -> list[int]:
        """Numbers of the complete versions of a small table."""
        folder = f"{self.folder}/{kind}"
        return [int(name) for name in storage.names(self.spark, folder)
                if name.isdigit() and storage.exists(self.spark, f"{folder}/{name}/_SUCCESS")]

    def _write_version(self, kind: str, version: int, table: DataFrame) -> None:
        table.write.mode("overwrite").parquet(f"{self.folder}/{kind}/{version}")

    def _manifest(self) -> DataFrame:
        versions = self._versions("manifest")
        if not versions:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.folder}/manifest/{max(versions)}")

    def _pending(self) -> list[str]:
        """Months of updates that were begun after the last one that was completed."""
        done = max([0, *self._versions("manifest")])
        months = set()
        for version in self._versions("pending"):
            if version > done:
                months |= {r[0] for r in self.spark.read.parquet(
                    f"{self.folder}/pending/{version}").collect()}
        return sorted(months)

    # stages

    def _stage(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        # months look like dates, but are text
        fields = [T.StructField(f.name, T.StringType()) if f.name == MONTH else f
                  for f in self.spark.read.parquet(path).schema]
        return self.spark.read.schema(T.StructType(fields)).parquet(path)

    def _months(self, name: str, months: Sequence[str]) -> DataFrame:
        """Only the folders of these months are read."""
        return self._stage(name).filter(F.col(MONTH).isin(list(months)))

    def _new_rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self._stage("sessions").limit(0)
        raw = self.read_files(self.spark, paths).withColumn(
            _FILE, _named(F.input_file_name()))
        return stored(clean_sessions(raw).withColumn(MONTH, month("session_start")), "new-sessions")

    def _rewrite_sessions(self, new: DataFrame, left: DataFrame, touched: list[str]) -> None:
        rows = new
        if storage.exists(self.spark, f"{self.folder}/sessions"):
            kept = self._months("sessions", touched).join(
                left.withColumnRenamed("file", _FILE), _FILE, "left_anti")
            rows = kept.unionByName(new, allowMissingColumns=True)
        # a stage can't be read and overwritten at once
        self._rewrite("sessions", stored(rows, "sessions"), touched)

    def _rewrite(self, name: str, rows: DataFrame, months: list[str]) -> None:
        """Replace these months of a stage by `rows`, a stored table; months without a row go."""
        path = f"{self.folder}/{name}"
        rows.hint("rebalance", MONTH).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
        written = {r[0] for r in rows.select(MONTH).distinct().collect()}
        for m in set(months) - written:
            storage.delete(self.spark, f"{path}/{MONTH}={m}")

    def _rewrite_features(self, touched: list[str]) -> list[str]:
        """Features of the touched months and those that look back into them."""
        # a row per station: its months in order, with their rows
        counts = self._stage("hours").groupBy("station_id", MONTH).count()
        per_station = stored(counts.groupBy("station_id").agg(F.sort_array(F.collect_list(
            F.struct(MONTH, "count"))).alias("months")), "station-months")
        between = lambda early, late: F.aggregate(
            F.filter("months", lambda x: (x[MONTH] > early) & (x[MONTH] < late)),
            F.lit(0).cast("bigint"), lambda total, x: total + x["count"])
        near = lambda early, late: (early < late) & (between(early, late) < self.reach)
        changed = F.array(*[F.lit(m) for m in touched])
        names = F.transform("months", lambda x: x[MONTH])
        behind = per_station.select(F.explode(F.filter(
            names, lambda m: F.exists(changed, lambda t: near(t, m))))).distinct()
        affected = sorted(set(touched) | {r[0] for r in behind.collect()})
        wanted = F.array(*[F.lit(m) for m in affected])
        ahead = per_station.select(F.explode(F.filter(names, lambda m: F.exists(
            F.array_intersect(wanted, names), lambda a: near(m, a))))).distinct()
        history = {r[0] for r in ahead.collect()}
        rows = stored(self._months("hours", sorted(set(affected) | history)), "hours-read")
        built = build_features(rows, self.chunk).filter(F.col(MONTH).isin(affected))
        self._rewrite("features", stored(built, "features"), affected)
        return affected
