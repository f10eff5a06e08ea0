"""Tables of immutable Parquet files whose versions are lists of files.

A version is a small marker file that names, for every month, the stored list of that month's files; a reader
resolves the newest marker once and then reads files that never change, so it sees one version whatever is
written meanwhile. A writer puts new files and new lists beside the old ones and makes them the next version by
creating its marker, which fails if another writer was faster. Each file's rows, bytes, time bounds and batches
stand in its list: readers pick files by month, time or batch without opening them.

The folder holds ``data/part=.../year=.../month=...`` (files), ``lists`` and ``versions`` (markers). Files that no
version names any more stay until ``forget_before`` removes them.
"""

import json
import math
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.session import shared_dir

LIST_SCHEMA = (
    "file string, bytes long, rows long, year int, month int, low timestamp_ntz, high timestamp_ntz, "
    "timeless long, batches array<string>")
MONTH = ["year", "month"]
PIECE_ROWS, PIECE_BYTES = 1_000_000, 32 << 20  # what one task of a compaction sorts: rows, and bytes as stored
FILES_PER_JOB = 16  # of a compaction, each read from its own pieces
Month = tuple[int | None, int | None]


class ConcurrentCommit(RuntimeError):
    """Another writer made the next version first; nothing of this one became visible."""


class VersionedTable:
    """``schema`` are the rows' own columns; ``year``, ``month`` (of ``time``) and ``batch`` are kept beside them."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, time: str = "ts"):
        self.spark, self.path, self.time = spark, path.rstrip("/"), time
        own = [f for f in schema.fields if f.name not in (*MONTH, "batch")]
        self.columns, self.rows_schema = schema.fieldNames(), schema
        self.schema = T.StructType([*own, *[T.StructField(c, T.IntegerType()) for c in MONTH], T.StructField("batch", T.StringType())])

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "VersionedTable | None":
        """The table stored at ``path`` with the schema of its newest version, or None if there is none."""
        bare = cls(spark, path, T.StructType([]))
        marker = bare._marker(bare.version())
        return cls(spark, path, T.StructType.fromJson(marker["schema"]), marker["time"]) if "schema" in marker else None

    # Markers

    def _folder(self, name: str):
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The newest version; 0 before the first commit."""
        folder, store = self._folder("versions")
        if not store.exists(folder):
            return 0
        names = [s.getPath().getName() for s in store.listStatus(folder)]
        return max((int(n.split(".")[0]) for n in names if n.endswith(".json")), default=0)

    def _marker(self, version: int) -> dict:
        if not version:
            return {"months": {}, "applied": {}}
        return json.loads(self.spark.read.text(f"{self.path}/versions/{version:010d}.json", wholetext=True).first()["value"])

    def _commit(self, version: int, marker: dict) -> int:
        marker |= {"schema": self.rows_schema.jsonValue(), "time": self.time}
        target, store = self._folder(f"versions/{version + 1:010d}.json")
        beside, _ = self._folder(f"versions/.{uuid.uuid4().hex}")
        out = store.create(beside, False)
        out.write(bytearray(json.dumps(marker).encode()))
        out.close()
        if store.exists(target) or not store.rename(beside, target):  # a rename never overwrites
            store.delete(beside, False)
            raise ConcurrentCommit(f"{self.path}: version {version + 1} is there already")
        return version + 1

    def applied(self, stream: str) -> int | None:
        """The number of the last batch of ``stream`` whose ``merge`` is part of the newest version."""
        return self._marker(self.version())["applied"].get(stream)

    # Reading

    def files(self, months: list[Month] | None = None, version: int | None = None) -> DataFrame:
        """The files of a version (the newest by default), of the given months alone if any are given."""
        lists = self._marker(self.version() if version is None else version)["months"]
        wanted = {k: v for k, v in lists.items() if months is None or k in {_name(m) for m in months}}
        if not wanted:
            return self.spark.createDataFrame([], LIST_SCHEMA)
        listed = self.spark.read.schema(LIST_SCHEMA).parquet(*sorted(set(wanted.values())))
        chosen = F.lit(False)  # a list may have been written for several months, and be replaced for some of them
        for name, folder in wanted.items():
            chosen = chosen | ((F.concat_ws("-", *MONTH) == name) & F.contains(F.col("_metadata.file_path"), F.lit(folder.rsplit("/", 1)[1])))
        return listed.where(chosen)

    def read(self, files: DataFrame | None = None) -> DataFrame:
        """Rows of the files, with ``year``, ``month`` and ``batch``. The paths go through the driver, one a file."""
        paths = _paths(self.files() if files is None else files)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*paths).select(*self.schema.fieldNames())

    def around(self, rows: DataFrame, unit: str = "hour") -> DataFrame:
        """The files that may hold a row of the same time as one of ``rows``: both touch an hour (or a day)."""
        cut = lambda c: F.date_trunc(unit, F.col(c).cast("timestamp_ntz"))
        units = rows.select(cut(self.time).alias("unit")).distinct()
        listed = self.files(months_of(rows.select(F.year(self.time).alias("year"), F.month(self.time).alias("month"))))
        steps = F.sequence(cut("low"), cut("high"), F.expr(f"INTERVAL 1 {unit}"))
        met = listed.where("low IS NOT NULL").withColumn("unit", F.explode(steps)).join(units, "unit", "left_semi").select("file").distinct()
        return listed.join(met, "file", "left_semi").unionByName(listed.where("low IS NULL"))

    # Writing

    def _written(self, rows: DataFrame, files: int | None = None) -> DataFrame:
        """``rows`` in new files, ordered by time so that files and row groups have narrow bounds, and their list."""
        folder = f"{self.path}/data/part={uuid.uuid4().hex}"
        months = {"year": F.year(self.time), "month": F.month(self.time)}
        laid = rows.withColumns(months).select(*self.schema.fieldNames())
        laid = laid.hint("rebalance", *MONTH) if files is None else laid.repartitionByRange(files, self.time)
        (
            laid.sortWithinPartitions(*MONTH, self.time).write.option("compression", "zstd").partitionBy(*MONTH).parquet(folder)
        )
        return self._listed(folder)

    def _listed(self, folder: str) -> DataFrame:
        """The list of the files in one ``data/part=...`` folder."""
        store = self._folder(f"data/{folder.rsplit('/', 1)[1]}")
        if not any(s.isDirectory() for s in store[1].listStatus(store[0])):  # no rows, no files
            return self.spark.createDataFrame([], LIST_SCHEMA)
        back = self.spark.read.schema(self.schema).parquet(folder)
        return back.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), *MONTH).agg(
            F.count("*").alias("rows"), F.min(self.time).alias("low"), F.max(self.time).alias("high"),
            F.count_if(F.col(self.time).isNull()).alias("timeless"), F.array_sort(F.collect_set("batch")).alias("batches"),
        ).select(*T._parse_datatype_string(LIST_SCHEMA).fieldNames())

    def _merged(self, rows: DataFrame, month: Month, files: int, pieces: int) -> DataFrame:
        """The rows of one month in ``files`` new files, ordered by time as far as row groups tell, and their list.

        A task sorts one of ``pieces`` ranges, which are stored; a file is then written from its pieces one after the
        other, without a sort, so no task holds a file's rows. Rows of one time are dealt by their hash.
        """
        own = T.StructType([f for f in self.schema.fields if f.name not in MONTH])
        hashed = F.xxhash64(*[f.name for f in own.fields if "map<" not in f.dataType.simpleString()])
        path = shared_dir(self.spark, "pieces")
        laid = rows.select(*own.fieldNames()).repartitionByRange(pieces, F.col(self.time), hashed)
        laid.sortWithinPartitions(self.time).write.option("compression", "zstd").parquet(path)
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        store = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in store.listStatus(place)]
        names = sorted((n for n in names if n.startswith("part-")), key=lambda n: (int(n.split("-")[1]), n))
        groups = [names[i * len(names) // files:(i + 1) * len(names) // files] for i in range(files)]
        wanted = [
            reduce(DataFrame.union, [self.spark.read.schema(own).parquet(f"{path}/{n}") for n in group]).coalesce(1)
            for group in groups if group
        ]
        folder = f"{self.path}/data/part={uuid.uuid4().hex}"
        target = "/".join([folder, *(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(MONTH, month))])
        for first in range(0, len(wanted), FILES_PER_JOB):
            reduce(DataFrame.union, wanted[first:first + FILES_PER_JOB]).write.mode("append").option("compression", "zstd").parquet(target)
        store.delete(place, True)
        return self._listed(folder)

    def _switch(self, version: int, months: list[Month], kept: DataFrame, added: DataFrame, applied: dict | None = None) -> int:
        """The version after ``version``: in ``months`` and those of the added files, the kept and added files."""
        marker = self._marker(version)
        folder = f"{self.path}/lists/{uuid.uuid4().hex}"
        kept.unionByName(added).coalesce(1).write.parquet(folder)
        there = {(r["year"], r["month"]) for r in self.spark.read.schema(LIST_SCHEMA).parquet(folder).select(*MONTH).distinct().collect()}
        for month in set(months) | there:
            marker["months"].pop(_name(month), None)
        marker["months"] |= {_name(m): folder for m in there}
        marker["applied"] |= applied or {}
        return self._commit(version, marker)

    def replace(self, batch: str, rows: DataFrame) -> int:
        """Store ``rows`` as the named batch, in place of what an earlier call stored under that name.

        Files that hold this batch alone go; files it shares, after compaction, are written again without it.
        """
        version = self.version()
        added = self._written(rows.withColumn("batch", F.lit(batch)))
        old = self.files(version=version)
        touched = months_of(old.where(F.array_contains("batches", batch)).unionByName(added).select(*MONTH))
        now = self.files(touched, version)
        mixed = now.where(F.array_contains("batches", batch) & (F.size("batches") > 1))
        if not mixed.isEmpty():
            added = added.unionByName(self._written(self.read(mixed).where(F.col("batch") != batch)))
        return self._switch(version, touched, now.where(~F.array_contains("batches", batch)), added)

    def merge(self, stream: str, number: int, rows: DataFrame, keys: list[str], sums: list[str]) -> int:
        """Add the ``sums`` of ``rows`` to the stored rows of the same ``keys``, once a batch of the stream.

        The marker notes the batch together with its rows, so a retried batch, whose first attempt may or may not
        have been committed, is added exactly once. ``time`` is one of the keys: only its months are read.
        """
        version = self.version()
        if self._marker(version)["applied"].get(stream, -1) >= number:
            return version
        months = months_of(rows.select(F.year(self.time).alias("year"), F.month(self.time).alias("month")))
        now = self.files(months, version)
        both = self.read(now).select(*self.columns).unionByName(rows.select(*self.columns))
        merged = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
        added = self._written(merged.withColumn("batch", F.lit(stream)))
        return self._switch(version, months, now.limit(0), added, {stream: number})

    def compact(self, year: int | None, month: int | None, target_mb: int = 256) -> int:
        """Merge the files of one month into files of about ``target_mb``; returns their number afterwards.

        What a task sorts does not grow with the files: see ``_merged``.
        """
        version = self.version()
        now = self.files([(year, month)], version)
        found = now.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("files"), F.sum("rows").alias("rows")).first()
        files = max(1, math.ceil((found["bytes"] or 0) / (target_mb * 1024 * 1024)))
        if found["files"] <= files:
            return found["files"]
        pieces = max(math.ceil(found["rows"] / PIECE_ROWS), math.ceil(found["bytes"] / PIECE_BYTES))
        if pieces <= files:
            added = self._written(self.read(now), files)
        else:
            added = self._merged(self.read(now), (year, month), files, pieces)
        stored = added.agg(F.sum("rows").alias("rows"), F.count("*").alias("files")).first()
        if stored["rows"] != found["rows"]:
            raise RuntimeError(f"compaction of {year}-{month} lost rows; the version is unchanged")
        self._switch(version, [(year, month)], now.limit(0), added)
        return stored["files"]

    def forget_before(self, version: int) -> int:
        """Remove the markers before ``version`` and the files and lists that no later version names."""
        newest = self.version()
        markers = [self._marker(v) for v in range(version, newest + 1)]
        lists = {folder for m in markers for folder in m["months"].values()}
        live = {file for folder in lists for file in _paths(self.spark.read.schema(LIST_SCHEMA).parquet(folder))}
        removed = 0
        for name, keep in (("data", {f.split("/data/")[1] for f in live}), ("lists", {f.rsplit("/", 1)[1] for f in lists})):
            folder, store = self._folder(name)
            found = store.listFiles(folder, True)
            gone = []
            while found.hasNext():
                path = found.next().getPath()
                inside = path.toString().split(f"/{name}/", 1)[1]
                if (inside if name == "data" else inside.split("/")[0]) not in keep:
                    gone.append(path)
            for path in gone:
                store.delete(path, False)
                removed += path.getName().endswith(".parquet")
        folder, store = self._folder("versions")
        for status in store.listStatus(folder):
            if status.getPath().getName().endswith(".json") and int(status.getPath().getName().split(".")[0]) < version:
                store.delete(status.getPath(), False)
        return removed


def _paths(files: DataFrame) -> list[str]:
    """The files' paths; the list holds them as URIs."""
    return [unquote(r["file"]) for r in files.select("file").collect()]


def _name(month: Month) -> str:
    """The month's key in a marker, as ``concat_ws`` spells it: empty for rows without a time."""
    return "-".join(str(x) for x in month if x is not None)


def months_of(rows: DataFrame) -> list[Month]:
    """The distinct months of ``rows``: a list no longer than the calendar it covers."""
    return [(r["year"], r["month"]) for r in rows.select(*MONTH).distinct().collect()]


def unseen(rows: DataFrame, seen: DataFrame, columns: list[str], key: str = "transaction_id") -> DataFrame:
    """The rows that equal no row of ``seen`` in all ``columns``, nulls being equal.

    Joined on the key and one hash of the row; the columns themselves are compared where those agree.
    """
    mine = rows.withColumn("_row", F.xxhash64(*columns))
    theirs = seen.select(F.xxhash64(*columns).alias("_seen"), F.col(key).alias("_key"), F.struct(*columns).alias("_other"))
    same: Column = F.coalesce(F.struct(*columns).eqNullSafe(F.col("_other")), F.lit(False))
    met = (F.col("_row") == F.col("_seen")) & F.col(key).eqNullSafe(F.col("_key")) & same
    return mine.join(theirs, met, "left_anti").drop("_row")
