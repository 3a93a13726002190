"""Where accepted rows go: a catalog table, or a table behind JDBC."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..errors import CommitConflict, TargetMissing
from ..functions.types import Target
from ..operators.keys import any_null, with_keys, without_keys
from ..operators.schema import check_target
from ..session import drop_empty, drop_file, drop_path, exists, list_files, move_files, new_path
from .commits import CommitLog, Entry, retried

DEFAULT_BATCH_SIZE = 300
MERGING_FORMATS = ("delta", "iceberg", "hudi")
# Versions kept of a table without partitions that upserts replace as a whole, the current one included.
KEEP_VERSIONS = 2
VERSION = "__v_"
ROWS = "__rows"
FILE = "__file"
# Formats whose files Spark writes by path as it does for a table.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")
# A table without partitions gets a whole new version where at least this share of its files would be written anew.
WHOLE_SHARE = 0.5
# Partitions named in one statement.
STATEMENT_PARTITIONS = 200
# Files moved at a time.
MOVERS = 16
# Ledgers an entry names before they are written as one.
LEDGERS = 32


def effective_batch_size(batch_size: int | str | None) -> int:
    """Only values above zero replace the default; text that is no number is an error."""
    size = DEFAULT_BATCH_SIZE if batch_size is None else int(batch_size)
    return size if size > 0 else DEFAULT_BATCH_SIZE


def counted(rows: DataFrame, seen: Observation | None) -> DataFrame:
    """Counts rows as they are written. This must be the last step: in the stage that
    writes, a task tried again is counted once, before a shuffle it might not be."""
    return rows if seen is None else rows.observe(seen, F.count(F.lit(1)).alias("rows"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Layout:
    """What the catalog says of a table, read once."""

    location: str
    provider: str
    partitions: list[str]
    buckets: list[str]
    n_buckets: int
    plain_options: bool

    @classmethod
    def of(cls, spark: SparkSession, table: str) -> Layout:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
        # the lines before the headings are the table's columns, whatever they are called
        heading = next(i for i, row in enumerate(described) if row.col_name == "# Detailed Table Information")
        details = {row.col_name: row.data_type for row in reversed(described[heading:])}
        names = [row.col_name for row in described[:heading]]
        partitions = names[names.index("# Partition Information") + 2 :] if "# Partition Information" in names else []
        stored = re.sub(r"[\[\]]|serialization\.format=\d*", "", details.get("Storage Properties") or "")
        return cls(
            (details.get("Location") or "").rstrip("/"),
            (details.get("Provider") or "").lower(),
            [name for name in partitions if name],
            [name.replace("``", "`") for name in re.findall("`((?:[^`]|``)+)`", details.get("Bucket Columns") or "")],
            int(details.get("Num Buckets") or 0),
            not stored.strip(" ,"),
        )

    @property
    def owned(self) -> bool:
        """Whether files written by path are files of the table."""
        return bool(self.location) and self.provider in FILE_FORMATS and self.plain_options


class TableSink:
    """A table of the session's catalog.

    Files are written beside the table, entered in its commit log and then
    moved in, so that a load cut short is either completed by the next one or
    has never been. Tables of other formats are left to Spark's own writer.
    """

    def __init__(
        self, spark: SparkSession, table: str, max_records_per_file: int | None = None, keep_versions: int = KEEP_VERSIONS
    ):
        self.spark = spark
        self.table = table
        self.max_records_per_file = max_records_per_file
        self.keep_versions = max(1, keep_versions)
        self.target = check_target(spark, table)
        self.layout = Layout.of(spark, table)
        # what the next commit says beside its files
        self.batch: tuple[str, int] | None = None
        self.ledger: DataFrame | None = None

    @property
    def name(self) -> str:
        return self.table

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    @property
    def location(self) -> str:
        return self.layout.location

    @property
    def base_location(self) -> str:
        """Where the table was made, whatever version it points at."""
        return re.sub(f"{VERSION}[0-9a-f]{{32}}$", "", self.location)

    def default_reject_path(self) -> str:
        return f"{self.base_location}_rejects"

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.base_location}_commits")

    def begin(self) -> tuple[int, Entry | None]:
        """The last entry of the log. One that was cut short is completed first."""
        if not self.layout.owned:
            return 0, None
        number, entry = self.log.latest()
        self.layout = Layout.of(self.spark, self.table)
        if entry is not None and self._unfinished(entry):
            self._carry_out(entry)
        return number, entry

    def _unfinished(self, entry: Entry) -> bool:
        if entry.kind == "version":
            return self.location != entry.location and bool(entry.versions) and self.location == entry.versions[0]["path"]
        return entry.loading is not None and exists(self.spark, entry.loading)

    def loaded_batch(self, stream: str) -> int:
        """The last batch of a stream that reached the table; -1 before the first."""
        _, entry = self.begin()
        return -1 if entry is None else entry.batches.get(stream, -1)

    def ledgers(self) -> list[str]:
        _, entry = self.begin()
        return [] if entry is None else [f"{self.log.folder}/{name}" for name in entry.ledgers]

    def _gathered(self, rows: DataFrame) -> DataFrame:
        """Rows of one partition or bucket brought together, or every task would
        write a file into each. Adaptive execution splits the large groups and
        joins the small ones. Other tables need no shuffle."""
        if self.layout.partitions:
            return rows.hint("rebalance", *self.layout.partitions)
        if self.layout.buckets:
            return rows.hint("rebalance", self.layout.n_buckets, *self.layout.buckets)
        return rows

    def append(self, rows: DataFrame, seen: Observation | None = None, after: int | None = None) -> None:
        """Adds the rows; with ``after`` only if that entry is still the log's last."""
        if not self.layout.owned:
            if self.max_records_per_file is not None:
                raise ValueError(f"{self.table}: files of {self.layout.provider or 'this format'} cannot be bounded")
            return counted(self._gathered(rows), seen).write.insertInto(self.table)
        loading = f"{self.log.folder}/loading-{uuid.uuid4().hex}"
        try:
            self._write(counted(self._gathered(rows), seen), loading)
            names = list_files(self.spark, loading)
            if after is None:
                # whatever came first, these rows come behind it
                retried(lambda: self._commit("append", loading, names))
            else:
                self._commit("append", loading, names, after=after)
        except BaseException:
            self._forget(loading)
            raise

    def _forget(self, loading: str) -> None:
        """Removes files that no entry has."""
        _, entry = self.log.latest()
        if entry is None or entry.loading != loading:
            drop_path(self.spark, loading)

    def _write(self, rows: DataFrame, path: str) -> None:
        """Files as the table has them, in a folder of their own."""
        named = rows.toDF(*self.target.names)
        writer = named.write.format(self.layout.provider)
        if self.max_records_per_file is not None:
            # files may be many, so each task puts its own in place; nothing counts before the entry in the log
            writer = writer.options(**{"maxRecordsPerFile": self.max_records_per_file, "mapreduce.fileoutputcommitter.algorithm.version": 2})
        if self.layout.buckets:
            # only a table's files carry the number of their bucket; this one is forgotten, its files stay
            copy = f"{self.table}_{uuid.uuid4().hex}"
            buckets = self.layout.buckets
            writer.bucketBy(self.layout.n_buckets, *buckets).sortBy(*buckets).option("path", path).saveAsTable(copy)
            self.spark.sql(f"DROP TABLE {copy}")
        else:
            (writer.partitionBy(*self.layout.partitions) if self.layout.partitions else writer).save(path)

    def _commit(self, kind: str, loading: str | None, add: list[str], after: int | None = None, **changes) -> None:
        number, last = self.begin()
        if after is not None and number != after:
            raise CommitConflict(f"another load has changed {self.table}")
        last = last or Entry(self.location, "start")
        batches = {**last.batches, **({self.batch[0]: self.batch[1]} if self.batch else {})}
        entry = Entry(
            **{"location": self.location, "versions": last.versions, **changes},
            kind=kind, loading=loading, add=add, batches=batches, ledgers=self._listed(last.ledgers),
        )
        self.log.add(number + 1, entry)
        self._carry_out(entry)

    def _listed(self, ledgers: list[str]) -> list[str]:
        """The ledgers with the one of this load; many small ones are written as one."""
        if self.ledger is None:
            return ledgers
        rows, held = self.ledger, ledgers
        if len(held) >= LEDGERS:
            rows = rows.unionByName(self.spark.read.schema(rows.schema).parquet(*[f"{self.log.folder}/{name}" for name in held]))
            held = []
        name = f"ledger-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.log.folder}/{name}")
        return [*held, name]

    def _carry_out(self, entry: Entry) -> None:
        """Makes the table what the entry says; doing it again changes nothing."""
        if entry.kind == "version":
            self.spark.sql(f"ALTER TABLE {self.table} SET LOCATION {_literal(entry.location)}")
            for old in entry.stale:
                self._drop_version(old)
        if entry.loading is not None:
            homes = self._homes({name.rpartition("/")[0] for name in entry.add})

            # a file's place in the folder it is loaded from, and where its partition is
            split = [(name, *name.rpartition("/")[::2]) for name in entry.add]
            move_files(self.spark, [(f"{entry.loading}/{name}", f"{homes[folder]}/{file}") for name, folder, file in split], MOVERS)
            with ThreadPoolExecutor(MOVERS) as pool:
                list(pool.map(lambda path: drop_file(self.spark, path, encoded=True), entry.remove))
            for spec, folder in entry.emptied:
                if drop_empty(self.spark, folder, encoded=True):
                    self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({spec})")
            drop_path(self.spark, entry.loading)
        self.layout = Layout.of(self.spark, self.table)
        self.spark.catalog.refreshTable(self.table)

    def _homes(self, folders: set[str]) -> dict[str, str]:
        """Where the files of each partition go, which the catalog knows; new partitions are entered."""
        if not self.layout.partitions:
            return {folder: self.location for folder in folders}
        specs = {folder: _spec(folder) for folder in sorted(folders)}
        places = {folder: self._partition_location(spec) for folder, spec in specs.items()}
        # only those that are not there, as entering one again may forget its place
        new = [specs[folder] for folder, place in places.items() if place is None]
        for start in range(0, len(new), STATEMENT_PARTITIONS):
            parts = " ".join(f"PARTITION ({spec})" for spec in new[start : start + STATEMENT_PARTITIONS])
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {parts}")
        return {folder: place or self._partition_location(specs[folder]) for folder, place in places.items()}

    def _partition_location(self, spec: str) -> str | None:
        try:
            described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table} PARTITION ({spec})").collect()
        except AnalysisException as error:
            if error.getCondition() != "PARTITIONS_NOT_FOUND":
                raise
            return None
        heading = next(i for i, row in enumerate(described) if row.col_name == "# Detailed Partition Information")
        return next(row.data_type for row in described[heading:] if row.col_name == "Location").rstrip("/")

    def upsert(self, latest: DataFrame, keys: Sequence[str], small: bool, null_safe: bool) -> None:
        """Puts ``latest`` (one row per key) over the table's rows.

        Formats with MERGE use it. Elsewhere the files that hold a listed key
        are found by reading nothing but keys, and only those are written anew;
        where that is most files of a table without partitions, it gets a whole
        new version. If another load comes first, all of it is done again.
        """
        if self.layout.provider in MERGING_FORMATS:
            return self._merge(latest, keys)
        if not self.layout.owned:
            raise ValueError(f"{self.table}: rows of this format cannot be replaced")
        retried(lambda: self._upsert_once(latest, keys, small, null_safe))

    def _upsert_once(self, latest: DataFrame, keys: Sequence[str], small: bool, null_safe: bool) -> None:
        number, last = self.begin()
        files = self._files_with(latest, keys, small, null_safe)
        if not self.layout.partitions and files and len(files) >= WHOLE_SHARE * len(self.rows().inputFiles()):
            return self._new_version(latest, keys, small, null_safe, number, last)
        loading = f"{self.log.folder}/loading-{uuid.uuid4().hex}"
        try:
            merged = latest
            if files:
                held = self.rows().where(F.col("_metadata.file_path").isin([f.path for f in files]))
                merged = without_keys(held, latest, keys, small, null_safe).unionByName(latest)
            self._write(self._gathered(merged), loading)
            names = list_files(self.spark, loading)
            emptied = []
            if self.layout.partitions:
                filled = {_spec(name.rpartition("/")[0]) for name in names}
                left = {_named(self.layout.partitions, f): f.path.rpartition("/")[0] for f in files}
                emptied = [[spec, folder] for spec, folder in left.items() if spec not in filled]
            self._commit("files", loading, names, after=number, remove=[f.path for f in files], emptied=emptied)
        except BaseException:
            self._forget(loading)
            raise

    def _files_with(self, latest: DataFrame, keys: Sequence[str], small: bool, null_safe: bool) -> list[Row]:
        """The table's files that hold a listed key; as many at most as the table has files."""
        partitions = self.layout.partitions
        columns = dict.fromkeys([*keys, *partitions])
        # rows go by a number of their file; should two files have the same, both count as found
        if not self.rows().inputFiles():
            return []
        number = F.xxhash64("_metadata.file_path")
        held = self.rows().select(*columns, number.alias(FILE))
        if set(partitions) <= set(keys) and partitions:
            # the condition always holds; Spark takes the partitions to scan from a filtered side
            listed = latest.where(F.xxhash64(*keys).isNotNull())
            held = self._of_partitions(self._touched(listed, partitions), partitions, held)
        found = with_keys(held, latest, keys, small, null_safe)
        numbers = {row[FILE] for row in found.select(FILE).distinct().collect()}
        if not numbers:
            return []
        named = [F.col(quoted(p)).cast("string").alias(f"p{i}") for i, p in enumerate(partitions)]
        files = self.rows().select(F.col("_metadata.file_path").alias("path"), number.alias(FILE), *named).distinct().collect()
        return [file for file in files if file[FILE] in numbers]

    def _merge(self, latest: DataFrame, keys: Sequence[str]) -> None:
        view = f"latest_{uuid.uuid4().hex}"
        latest.createOrReplaceTempView(view)
        on = " AND ".join(f"t.{quoted(k)} <=> s.{quoted(k)}" for k in keys)
        try:
            self.spark.sql(
                f"MERGE INTO {self.table} AS t USING {view} AS s ON {on} "
                "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
            )
        finally:
            self.spark.catalog.dropTempView(view)

    def rows_beside(self, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The table's rows that may hold a listed key: those of the keys' partitions, where keys tell partitions."""
        partitions = self.layout.partitions
        if not partitions or not set(partitions) <= set(keys):
            return self.rows()
        return self._of_partitions(self._touched(listed, partitions), partitions, self.rows())

    def _touched(self, listed: DataFrame, partitions: list[str]) -> DataFrame:
        """The distinct partitions with their number of rows."""
        return listed.groupBy(*partitions).agg(F.count(F.lit(1)).alias(ROWS))

    def _of_partitions(self, touched: DataFrame, partitions: list[str], rows: DataFrame) -> DataFrame:
        """The rows in these partitions; the scan skips all others.

        Spark takes the partitions to scan from a broadcast side that a
        comparison has filtered, so one is stated that always holds. Partitions
        are as many as the catalog lists at most, and bounded by its names.
        """
        listed = touched.where(F.col(ROWS) >= 1)
        filled = with_keys(rows, listed.where(~any_null(partitions)), partitions, True, null_safe=False)
        nulls = with_keys(rows.where(any_null(partitions)), listed.where(any_null(partitions)), partitions, True)
        return filled.unionByName(nulls)

    def _new_version(self, latest: DataFrame, keys, small: bool, null_safe: bool, number: int, last: Entry | None) -> None:
        """Writes the merged rows beside the table and points the table at them.

        The last ``keep_versions`` versions stay, for readers that have them
        open. Of older ones the files that the table had are removed, and
        nothing else. A table bucketed on the keys is merged without shuffling
        its rows, and stays bucketed.
        """
        kept = without_keys(self.rows(), latest, keys, small, null_safe)
        path = f"{self.base_location}{VERSION}{uuid.uuid4().hex}"
        buckets = self.layout.buckets
        if buckets and set(keys) <= set(buckets):
            # one row per key, so no bucket of these is large
            latest = latest.repartition(self.layout.n_buckets, *buckets)
        elif buckets:
            latest = self._gathered(latest)
        ours = bool(re.search(f"{VERSION}[0-9a-f]{{32}}$", self.location))
        old = {"path": self.location, "files": None if ours else self.rows().inputFiles()}
        try:
            self._write(kept.unionByName(latest), path)
            versions = [old, *(last.versions if last else [])]
            here, stale = versions[: self.keep_versions - 1], versions[self.keep_versions - 1 :]
            # the one before is named as long as the table may still point at it
            self._commit("version", None, [], after=number, location=path, versions=here or [old], stale=stale)
        except CommitConflict:
            drop_path(self.spark, path)
            raise

    def _drop_version(self, old: dict) -> None:
        if old["files"] is None:
            return drop_path(self.spark, old["path"])
        for file in old["files"]:
            drop_file(self.spark, file, encoded=True)
        for name in ("_SUCCESS", "._SUCCESS.crc"):
            drop_file(self.spark, f"{old['path']}/{name}")
        drop_empty(self.spark, old["path"])


def _spec(folder: str) -> str:
    """A partition as statements name it, from its folder below the table's."""
    named = [part.partition("=") for part in folder.split("/")]
    values = [None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value) for _, _, value in named]
    return ", ".join(f"{quoted(unquote(name))} = {_literal(value)}" for (name, _, _), value in zip(named, values, strict=True))


def _named(partitions: list[str], row: Row) -> str:
    """The same from the partition's values as text, ``p0``, ``p1`` and so on."""
    return ", ".join(f"{quoted(p)} = {_literal(row[f'p{i}'])}" for i, p in enumerate(partitions))


def _literal(value) -> str:
    if value is None:
        return "null"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


class JdbcSink:
    """A table of another database. An append is not atomic across tasks, so a
    retried task can repeat its rows; keys on the table guard against that."""

    def __init__(self, spark: SparkSession, url: str, table: str, batch_size: int | None = None, **options: str):
        if not table or not table.strip():
            raise TargetMissing("no target table is named")
        self.spark = spark
        self.table = table
        self.options = {"url": url, "dbtable": table, "batchsize": str(effective_batch_size(batch_size)), **options}
        self.target = Target.of(self.rows().schema)

    @property
    def name(self) -> str:
        return self.table

    def begin(self) -> tuple[int, None]:
        return 0, None

    def rows_beside(self, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
        return self.rows()

    def rows(self) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options).load()

    def default_reject_path(self) -> str:
        return new_path(self.spark, f"{self.table}_rejects")

    def append(self, rows: DataFrame, seen: Observation | None = None) -> None:
        counted(rows, seen).write.format("jdbc").options(**self.options).mode("append").save()

    def upsert(self, latest: DataFrame, keys: Sequence[str], small: bool, null_safe: bool) -> None:
        raise NotImplementedError("JDBC targets take appends only")


def create_table(
    spark: SparkSession,
    table: str,
    target,
    location: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    provider: str = "parquet",
) -> Target:
    """Creates an empty table with the target's columns."""
    target = Target.of(target)
    columns = ", ".join(f"{quoted(c.name)} {c.spark_type.simpleString()}" for c in target.columns)
    parts = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    if bucket_by:
        parts += f" CLUSTERED BY ({', '.join(map(quoted, bucket_by))}) INTO {int(buckets)} BUCKETS"
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {provider}{parts}{where}")
    place = Layout.of(spark, table).location
    if place and not list_files(spark, place):
        # the log of a table that was here before and is gone
        drop_path(spark, f"{place}_commits")
    return Target.of(spark.table(table).schema)
