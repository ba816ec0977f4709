"""Versioned tables in a folder: every change is written beside the old data and then counts at once.

Layout under the table's folder::

    data/<folder>/_bucket=<b>/part-*.parquet    rows, dealt by a hash of the key
    commits/<number>.json                       one file for each version

A commit lists which folder holds which bucket, the columns, and the batches that were taken. A change
writes only the buckets it touches to a folder of its own and then its commit file, which never
replaces an existing one: a run that is killed before leaves the old version as it was, and of two
runs at a time one fails. The last commit is the table.

Rows carry their place (file time, file, line). Of a keyed table the record with the last place
stays, whatever order the batches come in; rows without a place (a table that was taken over) are the
oldest. A table without key keeps every record. A batch that was taken already is skipped, so a
job that is repeated after a failure adds nothing twice.

Scale: a keyed change reads and writes the touched buckets with one shuffle; choose the number of buckets
so that one is a few hundred MB. An append reads nothing. Only commit files (one line for each folder) and
the numbers of touched buckets reach the driver.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placewise.operators.business import latest_by_key
from placewise.sources.json_lines import LINE, MODIFIED, PATH

PLACE = [MODIFIED, PATH, LINE]
#: Line numbers of bundles and of JSON files have different shapes; stored is what orders both.
PLACE_DDL = f"{MODIFIED} TIMESTAMP, {PATH} STRING, {LINE} STRUCT<split: BIGINT, row: BIGINT>"
BUCKET = "_bucket"
BUCKETS = 64
ROOT_PROPERTY = "placewise.versions"


class Conflict(RuntimeError):
    """Another run committed the same version first; read the table again and repeat the change."""


@dataclass
class State:
    """What a commit file says."""

    version: int = 0
    key: str | None = None
    buckets: int = BUCKETS
    schema: StructType = field(default_factory=StructType)
    held: dict[str, list[int]] = field(default_factory=dict)   # folder -> its buckets that count
    columns: dict[str, list[str]] = field(default_factory=dict)  # folder -> the columns its files have
    applied: dict[str, int] = field(default_factory=dict)      # source -> last batch taken from it

    def text(self) -> str:
        return json.dumps({"version": self.version, "key": self.key, "buckets": self.buckets,
                           "schema": json.loads(self.schema.json()), "held": self.held,
                           "columns": {f: self.columns[f] for f in self.held}, "applied": self.applied})

    @classmethod
    def of(cls, text: str) -> State:
        read = json.loads(text)
        return cls(**{**read, "schema": StructType.fromJson(read["schema"])})


def placed(records: DataFrame) -> DataFrame:
    """Records with all place columns in their stored form; missing ones are null."""
    kinds = {f.name: f.dataType for f in StructType.fromDDL(PLACE_DDL)}
    made = {c: F.lit(None).cast(kinds[c]) for c in PLACE if c not in records.columns}
    if LINE in records.columns and not isinstance(records.schema[LINE].dataType, StructType):
        row = F.struct(F.lit(0).cast("long").alias("split"), F.col(LINE).cast("long").alias("row"))
        made[LINE] = F.when(F.col(LINE).isNotNull(), row)
    return records.withColumns(made) if made else records


class VersionedTable:
    """One table in a folder of a file system that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -------------------------------------------------------------- files

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, name: str) -> list[str]:
        path = self._path(name)
        files = self._files(path)
        return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []

    def versions(self) -> list[int]:
        """Numbers of all committed versions."""
        return [int(n.removesuffix(".json")) for n in self._listed("commits") if n.endswith(".json")]

    def state(self, version: int | None = None) -> State:
        """The last commit, or that of a version; version 0 is the empty table."""
        known = self.versions()
        number = version if version is not None else (known[-1] if known else 0)
        if not number:
            return State()
        if number not in known:
            raise ValueError(f"no version {number}")
        path = self._path(f"commits/{number:010d}.json")
        stream = self._files(path).open(path)
        try:
            return State.of(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, state: State) -> State:
        """Writes the commit beside its place and moves it there; an existing one is never replaced."""
        jvm = self.spark._jvm
        final = self._path(f"commits/{state.version:010d}.json")
        files, waiting = self._files(final), self._path(f"commits/.{uuid.uuid4().hex}")
        out = files.create(waiting, False)
        out.write(bytearray(state.text().encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        qualified = files.makeQualified(final)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(files.makeQualified(waiting), qualified, none)
        except Py4JJavaError as error:
            files.delete(waiting, False)
            if files.exists(final):
                raise Conflict(f"version {state.version} of {self.root} was committed by another run") from error
            raise
        return state

    # -------------------------------------------------------------- reading

    def paths(self, state: State, buckets: set[int] | None = None) -> list[str]:
        """Folders that hold a version, or some of its buckets."""
        return [f"{self.root}/data/{folder}/{BUCKET}={b}" for folder, held in state.held.items()
                for b in held if buckets is None or b in buckets]

    def _rows(self, state: State, buckets: set[int] | None = None) -> DataFrame:
        found = self.paths(state, buckets)
        reader = self.spark.read.schema(state.schema)
        return reader.parquet(*found) if found else self.spark.createDataFrame([], state.schema)

    def read(self, version: int | None = None, places: bool = False) -> DataFrame:
        """The rows of the last or a given version; ``places`` keeps where each record stood."""
        rows = self._rows(self.state(version))
        return rows if places else rows.drop(*PLACE)

    # -------------------------------------------------------------- changes

    def merge(self, records: DataFrame, key: str | None = None, source: str | None = None, batch: int | None = None,
              buckets: int = BUCKETS, replace: bool = False) -> State:
        """Takes records; with ``key`` (the same in every change) one row for each stays, that of the last place.

        ``source`` and ``batch`` name a batch of a stream; batches of a source come in rising numbers.
        ``replace`` lets the records take the place of all rows.
        """
        before = self.state()
        if source is not None and before.applied.get(source, -1) >= batch:
            return before
        if before.version and key != before.key:
            raise ValueError(f"the key of {self.root} is {before.key!r}, not {key!r}")
        old = State() if replace else before
        now = State(before.version + 1, key, before.buckets if before.version else (buckets if key else 1),
                    old.schema, dict(old.held), dict(old.columns), dict(before.applied))
        if source is not None:
            now.applied[source] = batch
        folder, arrived = f"v{now.version:010d}-{uuid.uuid4().hex}", placed(records)
        now.schema = _widened(old.schema, arrived.schema)
        if key is None:
            rows = arrived.withColumn(BUCKET, F.lit(0))
        else:
            bucket = F.pmod(F.xxhash64(key), F.lit(now.buckets)).cast("int")
            # The batch is written once: it tells the touched buckets and is merged from there.
            self._newest(arrived, key).withColumn(BUCKET, bucket).write.parquet(f"{self.root}/data/{folder}-batch")
            rows = self.spark.read.parquet(f"{self.root}/data/{folder}-batch")
            touched = {r[0] for r in rows.select(BUCKET).distinct().collect()}
            if old.held and touched:
                rows = rows.unionByName(self._rows(old, touched).withColumn(BUCKET, bucket), allowMissingColumns=True)
                # One shuffle: the grouping and the writer both use the rows as dealt by bucket, a task for each. A hash of
                # the bucket's number would bring several buckets to one task and none to others.
                rows = self._newest(rows.repartitionById(now.buckets, BUCKET), [BUCKET, key])
            else:
                rows = rows.repartitionById(now.buckets, BUCKET)
            now.held = {f: left for f, held in now.held.items() if (left := [b for b in held if b not in touched])}
        self._write(rows.select(*now.schema.names, BUCKET), folder, now)
        return self._commit(now)

    def _write(self, rows: DataFrame, folder: str, state: State) -> None:
        rows.write.partitionBy(BUCKET).parquet(f"{self.root}/data/{folder}")
        written = [int(n.split("=")[1]) for n in self._listed(f"data/{folder}") if n.startswith(f"{BUCKET}=")]
        if written:
            state.held[folder], state.columns[folder] = sorted(written), [c for c in rows.columns if c != BUCKET]

    def _newest(self, rows: DataFrame, key: str | list[str]) -> DataFrame:
        """One row for each key: that of the last place, among equal places the greatest row."""
        keys = [key] if isinstance(key, str) else key
        rest = [f.name for f in rows.schema.fields if f.name not in (*keys, *PLACE) and _ordered(f.dataType)]
        return latest_by_key(rows, keys, [*map(F.col, PLACE), *[F.col(f"`{c}`") for c in rest]])

    def compact(self, most: int = 1) -> State:
        """The last version in one folder, if it has more than ``most``; for tables that grow by many small batches."""
        now = self.state()
        if len(now.held) <= most:
            return now
        bucket = F.pmod(F.xxhash64(now.key), F.lit(now.buckets)).cast("int") if now.key else F.lit(0)
        rows = self._rows(now).withColumn(BUCKET, bucket)
        after = State(now.version + 1, now.key, now.buckets, now.schema, applied=now.applied)
        self._write(rows.repartitionById(now.buckets, BUCKET) if now.key else rows, f"v{after.version:010d}-{uuid.uuid4().hex}", after)
        return self._commit(after)

    def expire(self, keep: int = 2) -> list[str]:
        """Deletes commits before the last ``keep`` and folders that none of the kept ones names.

        Call it when no change is running and no reader uses an older version. Returns what was deleted.
        """
        known = self.versions()
        kept = known[-keep:]
        used = {folder for v in kept for folder in self.state(v).held}
        gone = [f"commits/{v:010d}.json" for v in known if v not in kept]
        gone += [f"data/{name}" for name in self._listed("data") if name not in used]
        for name in gone:
            path = self._path(name)
            self._files(path).delete(path, True)
        return gone

    # -------------------------------------------------------------- catalog

    def publish(self, name: str) -> None:
        """The last version as a view of the catalog, without places; replacing it is one catalog change."""
        state = self.state()
        shown = [f for f in state.schema.fields if f.name not in PLACE]

        def listed(columns: list[str]) -> str:
            return ", ".join(f"CAST({f'`{f.name}`' if f.name in columns else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
                             for f in shown)

        parts = [f"SELECT {listed(state.columns[folder])} FROM parquet.`{self.root}/data/{folder}/{BUCKET}={{{','.join(map(str, held))}}}`"
                 for folder, held in state.held.items()] or [f"SELECT {listed([])} WHERE false"]
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{ROOT_PROPERTY}' = '{self.root}') AS {' UNION ALL '.join(parts)}")


def _ordered(kind) -> bool:
    """Whether values of a type have an order (maps have none)."""
    text = kind.simpleString()
    return "map<" not in text and "variant" not in text


def _widened(old: StructType, new: StructType) -> StructType:
    """The old columns and then those that are new; a column keeps its type."""
    known = {f.name: f.dataType.simpleString() for f in old.fields}
    wrong = [f.name for f in new.fields if known.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()]
    if wrong:
        raise ValueError(f"columns of another type than the stored ones: {wrong}")
    text = StructType([*old.fields, *[f for f in new.fields if f.name not in known]]).json()
    for flag in ("nullable", "containsNull", "valueContainsNull"):  # any column may be missing from a batch
        text = text.replace(f'"{flag}":false', f'"{flag}":true')
    return StructType.fromJson(json.loads(text))


def find(spark: SparkSession, name: str) -> VersionedTable | None:
    """The versioned table behind a view of the catalog; none if the name is no such view."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == ROOT_PROPERTY).collect()
    return VersionedTable(spark, rows[0].value) if rows else None


def adopt(spark: SparkSession, name: str, root: str, key: str | None = None, buckets: int = BUCKETS) -> VersionedTable:
    """The versioned table of a catalog name, taking over the rows of a plain table of that name.

    Taking over is committed before the plain table gives its name to the view; a run that is lost in between does it
    again. A plain table that was made anew under the name of a versioned one takes the place of its rows.
    """
    known = find(spark, name)
    if known is not None:
        return known
    table = VersionedTable(spark, root)
    if spark.catalog.tableExists(name):
        table.merge(spark.table(name), key, buckets=buckets, replace=table.state().version > 0)
        spark.sql(f"DROP TABLE {name}")
        table.publish(name)
    return table
