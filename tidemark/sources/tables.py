"""Tables as folders of Parquet files.

Small tables are appended to.  Large ones are written in versions: a run puts its
result into a new folder and then adds rows to a small table of versions; the next
run reads the newest.  A version only holds the slices of the table that the run
touched, so the others are neither read nor written.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tidemark.operators.upsert import CHANGE, INSERTED, PREVIOUS_DATE, UPDATED
from tidemark.session import delete

VERSIONS = (
    "version bigint, slice string, rows bigint, kind string, layout string, "
    "created_at timestamp, source_version bigint"
)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("_ string").parquet(path)
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def hash_slice(key: str, slices: int) -> Column:
    """Spreads unique keys evenly over a fixed number of slices."""
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("string")


def month_slice(date: str) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit("none"))


def date_slice(date: str) -> Column:
    return F.coalesce(F.col(date).cast("string"), F.lit("none"))


def change_counts() -> list[Column]:
    """Inserted, updated and untouched rows; also to be counted while a merge is written."""
    return [
        F.count_if(F.col(CHANGE) == INSERTED).alias("inserted"),
        F.count_if(F.col(CHANGE) == UPDATED).alias("updated"),
        F.count_if(F.col(CHANGE).isNull()).alias("untouched"),
    ]


class HistoryExpired(RuntimeError):
    """An earlier write that is still needed has been removed."""


@dataclass(frozen=True)
class Held:
    """Where the newest rows of a slice are, and how many."""

    version: int
    rows: int


@dataclass(frozen=True)
class Snapshot:
    version: int
    source_version: int
    slices: dict[str, Held]


class SlicedTable:
    """A table whose slices are replaced as a whole.

    ``slice_of`` maps a row to its slice and must not change over the table's
    life; ``layout`` names it, and a table is never opened with another one.
    Without ``slice_of`` the rows to write carry a ``_slice`` column.
    The list of slices is held on the driver: keep it to some ten thousands.
    One writer at a time.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str,
        slice_of: Column | None,
        layout: str,
        sort_by: Sequence[str] = (),
        tracks_changes: bool = False,
        hidden: str = "",
        older_names: dict[str, str] | None = None,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.slice_of, self.layout, self.sort_by = slice_of, layout, tuple(sort_by)
        self.tracks_changes = tracks_changes
        # columns that are stored beside those of the table, and only read when asked for
        self.hidden = hidden
        # dates that older files keep under another name
        self.older_names = older_names or {}
        self._data, self._versions = f"{self.path}/data", f"{self.path}/versions"

    # -- reading -----------------------------------------------------------

    def exists(self) -> bool:
        return exists(self.spark, self._versions)

    def versions(self) -> DataFrame:
        """One row per version and slice it replaced."""
        if not self.exists():
            return self.spark.createDataFrame([], VERSIONS)
        # folding may leave a row twice for a moment
        return self.spark.read.schema(VERSIONS).parquet(self._versions).distinct()

    def snapshot(self) -> Snapshot:
        """The newest version of each slice, read in one go."""
        newest = self.versions().groupBy("slice").agg(
            F.max("version").alias("version"),
            F.max_by("rows", "version").alias("rows"),
            F.coalesce(F.max("source_version"), F.lit(0)).alias("source_version"),
            F.max("layout").alias("layout"),
        )
        rows = newest.collect()
        for row in rows:
            if row["layout"] != self.layout:
                raise ValueError(f"{self.path} is sliced by {row['layout']}, not by {self.layout}")
        return Snapshot(
            max((r["version"] for r in rows), default=0),
            max((r["source_version"] for r in rows), default=0),
            {r["slice"]: Held(r["version"], r["rows"]) for r in rows if r["slice"] and r["rows"]},
        )

    def read(
        self,
        slices: Iterable[str] | None = None,
        with_slice: bool = False,
        snapshot: Snapshot | None = None,
        with_hidden: bool = False,
    ) -> DataFrame:
        """The newest rows, of all slices or of some."""
        held = (snapshot or self.snapshot()).slices
        wanted = held if slices is None else [s for s in slices if s in held]
        rows = self._scan([self.folder(held[s].version, s) for s in wanted])
        hidden = [] if with_hidden else StructType.fromDDL(self.hidden).names if self.hidden else []
        return rows.drop("_version", CHANGE, PREVIOUS_DATE, *hidden, *([] if with_slice else ["_slice"]))

    def written_since(self, version: int, kind: str) -> DataFrame:
        """Rows that writes of one kind stored after ``version``, as they stored them.

        Only the files of those writes are read.  Fails when some of them have
        expired.
        """
        later = (F.col("version") > version) & (F.col("kind") == kind) & (F.col("rows") > 0)
        held = self.versions().filter(later | (F.col("kind") == "forgotten")).select("version", "slice", "kind").collect()
        if any(row["kind"] == "forgotten" and row["version"] > version for row in held):
            raise HistoryExpired(f"{self.path} no longer has all writes after {version}")
        held = [row for row in held if row["kind"] == kind]
        try:
            return self._scan([self.folder(row["version"], row["slice"]) for row in held])
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise HistoryExpired(f"{self.path} no longer has all writes after {version}") from error
            raise

    def changed_dates(self, date: str, since: int) -> DataFrame:
        """Dates that merges after ``since`` touched: those rows have now, and had before."""
        rows = self.changes_since(since)
        dates = F.array_compact(F.array(F.col(date), F.col(PREVIOUS_DATE)))
        return rows.select(F.explode(dates).alias(date)).distinct()

    def changes_since(self, since: int) -> DataFrame:
        """Rows that merges after ``since`` added or replaced, one for each time, with what they replaced.

        A file begins with its changed rows, so the filter skips its other pages.
        """
        return self.written_since(since, "merge").filter(F.col(CHANGE).isNotNull())

    # -- writing -----------------------------------------------------------

    def with_slice(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_slice", self.slice_of)

    def replace(
        self,
        rows: DataFrame,
        slices: Iterable[str] = (),
        kind: str = "merge",
        into: str | None = None,
        as_of: Column | None = None,
        source_version: int | None = None,
        snapshot: Snapshot | None = None,
    ) -> int:
        """Write ``rows`` as the new content of their slices.

        ``slices`` may name more: those without any row become empty.  Rows are
        expected to be grouped by slice already, or all to go ``into`` one.  A write
        that fails half-way leaves only a folder no version mentions; the next one
        overwrites it.
        """
        version = (snapshot or self.snapshot()).version + 1
        folder = self.folder(version)
        if into is not None:
            # static: whatever a dead attempt left under this version goes
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.folder(version, into))
            written = self.spark.read.parquet(self.folder(version, into)).select(
                F.lit(into).alias("slice")
            )
        else:
            if "_slice" not in rows.columns:
                rows = self.with_slice(rows)
            if self.sort_by:
                changed = [F.col(CHANGE).desc_nulls_last()] if CHANGE in rows.columns else []
                rows = rows.sortWithinPartitions("_slice", *changed, *self.sort_by)
            overwrite = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
            overwrite.partitionBy("_slice").parquet(folder)
            written = self.spark.read.schema("_slice string").parquet(folder).select(
                F.col("_slice").alias("slice")
            )
        # the count comes from the file footers
        counted = written.groupBy("slice").agg(F.count(F.lit(1)).alias("rows"))
        if slices:
            named = self.spark.createDataFrame([(s, 0) for s in slices], "slice string, rows bigint")
            counted = counted.unionAll(named).groupBy("slice").agg(F.sum("rows").alias("rows"))
        added = counted.select(
            F.lit(version).cast("bigint").alias("version"),
            "slice",
            "rows",
            F.lit(kind).alias("kind"),
            F.lit(self.layout).alias("layout"),
            (F.current_timestamp() if as_of is None else as_of).alias("created_at"),
            F.lit(source_version).cast("bigint").alias("source_version"),
        )
        # one file, so that the version appears at once
        append(added.coalesce(1), self._versions)
        return version

    def changes_of(self, version: int) -> DataFrame:
        """Inserted, updated and untouched rows of a merge, as one row of counts."""
        return self._scan([self.folder(version)]).agg(*change_counts())

    def fold_versions(self, above: int) -> int:
        """Put the files of the versions table together once there are more than ``above``.

        The new file comes first and the old ones go afterwards, so that a
        failure in between loses nothing.
        """
        if not self.exists():
            return 0
        rows = self.spark.read.schema(VERSIONS).parquet(self._versions)
        files = [r[0] for r in file_sizes(self.spark, self._versions).select("path").collect()]
        if len(files) <= above:
            return 0
        append(rows.distinct().coalesce(1), self._versions)
        for file in files:
            delete(self.spark, file)
        return len(files)

    def mark_processed(self, source_version: int, as_of: Column | None = None) -> None:
        """Record that the source was read up to here although nothing came of it."""
        nothing = self.spark.range(0, 1, 1, 1).select(
            F.lit(self.snapshot().version).cast("bigint").alias("version"),
            F.lit(None).cast("string").alias("slice"),
            F.lit(0).cast("bigint").alias("rows"),
            F.lit("mark").alias("kind"),
            F.lit(self.layout).alias("layout"),
            (F.current_timestamp() if as_of is None else as_of).alias("created_at"),
            F.lit(source_version).cast("bigint").alias("source_version"),
        )
        append(nothing, self._versions)

    # -- inside ------------------------------------------------------------

    def _stored_schema(self) -> str:
        tracked = f", {CHANGE} string, {PREVIOUS_DATE} date" if self.tracks_changes else ""
        older = "".join(f", `{old}` date" for old in self.older_names.values())
        hidden = f", {self.hidden}" if self.hidden else ""
        return f"{self.schema}{tracked}{hidden}{older}, _version bigint, _slice string"

    def slice_sizes(self, snapshot: Snapshot) -> DataFrame:
        """``_slice, files, bytes`` of the newest version of each slice."""
        folders = [self.folder(held.version, s) for s, held in snapshot.slices.items()]
        if not folders:
            return self.spark.createDataFrame([], "_slice string, files bigint, bytes bigint")
        name = F.url_decode(F.regexp_extract("path", "/_slice=([^/]+)/", 1)).alias("_slice")
        files = file_sizes(self.spark, *folders).groupBy(name)
        return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))

    def forget(self, gone: list[tuple[int, str]]) -> None:
        """Rewrite the table of versions without these slice versions, whose files are deleted.

        The new file comes first and the old ones go afterwards; a failure in
        between keeps rows, never loses one.  So the table holds what is live and what is retained.
        """
        named = self.spark.createDataFrame(gone, "version bigint, slice string")
        last = max(version for version, _ in gone)
        mark = self.spark.range(0, 1, 1, 1).select(
            F.lit(last).cast("bigint"), F.lit(None).cast("string"), F.lit(0).cast("bigint"), F.lit("forgotten"),
            F.lit(self.layout), F.current_timestamp(), F.lit(None).cast("bigint"),
        )
        rows = self.spark.read.schema(VERSIONS).parquet(self._versions)
        files = [r[0] for r in file_sizes(self.spark, self._versions).select("path").collect()]
        left = rows.join(named, ["version", "slice"], "left_anti").select(*rows.columns).filter("kind <> 'forgotten'")
        append(left.distinct().union(mark).coalesce(1), self._versions)
        for file in files:
            delete(self.spark, file)

    def folder(self, version: int, name: str | None = None) -> str:
        folder = f"{self._data}/_version={version}"
        return folder if name is None else f"{folder}/_slice={name}"

    def _scan(self, paths: list[str]) -> DataFrame:
        if not paths:
            rows = self.spark.createDataFrame([], self._stored_schema())
        else:
            reader = self.spark.read.schema(self._stored_schema()).option("basePath", self._data)
            rows = reader.parquet(*paths)
        renamed = {new: F.coalesce(new, old) for new, old in self.older_names.items()}
        return rows.withColumns(renamed).drop(*self.older_names.values()) if renamed else rows


def superseded(versions: DataFrame) -> DataFrame:
    """Each stored slice version with the time a newer one replaced it, if any."""
    following = Window.partitionBy("slice").orderBy("version")
    return versions.withColumn("replaced_at", F.lead("created_at").over(following))


def expired(versions: DataFrame, hours: int, as_of: Column | None = None) -> DataFrame:
    """Slice versions that were replaced more than ``hours`` ago."""
    now = F.current_timestamp() if as_of is None else as_of
    limit = now - F.make_dt_interval(hours=F.lit(hours))
    return superseded(versions).filter(F.col("replaced_at") < limit)


def file_sizes(spark: SparkSession, *folders: str) -> DataFrame:
    """``path, length`` of every Parquet file below the folders; lists them and opens none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return files.option("recursiveFileLookup", True).load(list(folders)).select("path", "length")
