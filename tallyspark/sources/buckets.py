"""Versioned tables in hash buckets of a key, updated in place.

A table is a folder of data folders and manifests.  Every data folder holds the Parquet
files of some buckets; the manifest names, for every bucket, the data folder that is
current, and ``_current`` names the manifest.  An update writes the buckets it touches
into a new data folder, then a new manifest, then moves the marker: readers see the old
or the new version, a failed job leaves the old one, and the files of other buckets stay
as they are.

The table is never shuffled by an update.  Staged rows are shuffled once, by key, which
also finds keys staged more than once (they go to a reject table); they are then joined
to the touched buckets as broadcast tables, bucket group by bucket group, each group
holding at most ``GROUP_ROWS`` staged rows.  A bucket's share of the staged rows shrinks
with the number of buckets, so that number is the one thing to choose with the table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "_bucket"
#: Staged rows that one broadcast join may hold.
GROUP_ROWS = 1_000_000


@dataclass
class Manifest:
    """What a version of a table consists of."""

    keys: list[str]
    by: str  # SQL expression of the bucket number
    schema: str
    folders: dict[str, str] = field(default_factory=dict)  # bucket -> data folder
    rejects: list[str] = field(default_factory=list)  # reject folders, all versions
    batches: dict[str, int] = field(default_factory=dict)  # writer -> last batch put in


@dataclass
class UpdateCounts:
    updated: int
    inserted: int
    unmatched: int
    rejected_keys: int
    rejected_rows: int
    touched: list[int]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    text = str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))  # noqa: SLF001
    stream.close()
    return text


class BucketTable:
    """A bucketed table below ``path``."""

    def __init__(self, spark: SparkSession, path: str, group_rows: int = GROUP_ROWS):
        self.spark, self.path, self.group_rows = spark, path.rstrip("/"), group_rows

    # ---- versions ------------------------------------------------------------
    def manifest(self) -> Manifest | None:
        name = _read_text(self.spark, f"{self.path}/_current")
        return Manifest(**json.loads(_read_text(self.spark, f"{self.path}/{name}"))) if name else None

    def _publish(self, manifest: Manifest) -> None:
        name = f"manifest-{uuid.uuid4().hex}.json"
        _write_text(self.spark, f"{self.path}/{name}", json.dumps(asdict(manifest)))
        _write_text(self.spark, f"{self.path}/_current", name)

    def _folder(self, kind: str = "data") -> str:
        return f"{self.path}/{kind}-{uuid.uuid4().hex}"

    def _write(self, df: DataFrame, folder: str) -> set[str]:
        """Write rows by bucket; the buckets that have files."""
        df.write.partitionBy(BUCKET).parquet(folder)
        p, fs = _fs(self.spark, folder)
        names = [s.getPath().getName() for s in fs.listStatus(p)]  # one folder a bucket
        return {n.split("=", 1)[1] for n in names if n.startswith(f"{BUCKET}=")}

    # ---- reading ---------------------------------------------------------------
    def _read(self, manifest: Manifest, buckets: list[str] | None = None) -> DataFrame:
        wanted = manifest.folders if buckets is None else {b: manifest.folders[b] for b in buckets if b in manifest.folders}
        schema = StructType.fromJson(json.loads(manifest.schema))
        if not wanted:
            return self.spark.createDataFrame([], schema)
        # files written before a column was added give NULL for it
        return self.spark.read.schema(schema).parquet(*[f"{folder}/{BUCKET}={b}" for b, folder in wanted.items()])

    def read(self) -> DataFrame:
        return self._read(self.manifest())

    def rejects(self) -> DataFrame | None:
        folders = self.manifest().rejects
        return self.spark.read.option("mergeSchema", True).parquet(*folders) if folders else None

    # ---- writing ---------------------------------------------------------------
    def create(self, df: DataFrame, keys: list[str], n_buckets: int = 16, by: str | None = None) -> int:
        """(re)fill the table; the one time that its rows are shuffled.  Returns the rows written.

        ``by`` is the SQL expression of the bucket, by default a hash of the keys; another
        one (such as the number of a day) must be a function of the keys.
        """
        by = by or f"pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), {n_buckets})"
        seen, folder = Observation(), self._folder()
        out = df.withColumn(BUCKET, F.expr(by)).repartition(n_buckets, BUCKET).observe(seen, F.count(F.lit(1)).alias("n"))
        manifest = Manifest(list(keys), by, json.dumps(df.schema.jsonValue()))
        manifest.folders = {b: folder for b in self._write(out, folder)}
        self._publish(manifest)
        return seen.get["n"]

    def derive(self, column: str, value: Column) -> int:
        """Set a column of every row from the row itself, without a join or shuffle.  Returns the rows written."""
        manifest, seen, folder = self.manifest(), Observation(), self._folder()
        out = self._read(manifest).withColumn(column, value)
        manifest.schema = json.dumps(out.schema.jsonValue())
        written = self._write(out.withColumn(BUCKET, F.expr(manifest.by)).observe(seen, F.count(F.lit(1)).alias("n")), folder)
        manifest.folders = {b: folder for b in written}
        self._publish(manifest)
        return seen.get["n"]

    def update(self, staged: DataFrame, columns: list[str], insert: bool = False, replace_nulls: bool = False,
               batch: tuple[str, int] | None = None) -> UpdateCounts:
        """Set ``columns`` of the rows whose keys are staged.

        A NULL staged value leaves the old one unless ``replace_nulls``.  Staged keys that
        the table lacks are counted, or inserted with ``insert``.  Keys staged more than
        once change nothing; each goes to the reject table with its number of rows.  A
        NULL key matches nothing.  ``batch`` (writer, number) makes a repeated call do
        nothing: the number put in last is kept in the manifest.
        """
        manifest = self.manifest()
        if batch and manifest.batches.get(batch[0], -1) >= batch[1]:
            return UpdateCounts(0, 0, 0, 0, 0, [])
        keys, spark = manifest.keys, self.spark
        schema = StructType.fromJson(json.loads(manifest.schema))
        for c in columns:  # S14: a new column is NULL in the rows of untouched buckets
            if c not in schema.names:
                schema = schema.add(c, staged.schema[c].dataType, True)
        known = staged
        for k in keys:
            known = known.where(F.col(f"`{k}`").isNotNull())
        # one shuffle: counts per key and the only row of a key staged once
        by_key = known.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
            F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("_new"))
        stage, total = self._folder("staged"), Observation()
        by_bucket = by_key.withColumn(BUCKET, F.expr(manifest.by).cast("int"))
        self._write(by_bucket.repartition(BUCKET).observe(
            total, F.sum(F.when(F.col("_n") > 1, 1).otherwise(0)).alias("keys"),
            F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("rows")), stage)
        parts = spark.read.schema(by_bucket.schema).parquet(stage)  # nothing staged leaves no file
        rejected_keys, rejected_rows = int(total.get["keys"] or 0), int(total.get["rows"] or 0)
        if rejected_keys:
            folder = self._folder("rejects")
            parts.where("_n > 1").drop(BUCKET).write.parquet(folder)
            manifest.rejects.append(folder)
        once = parts.where("_n = 1")
        sizes = {str(r[BUCKET]): r["n"] for r in once.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a bucket
        counts = UpdateCounts(0, 0, 0, rejected_keys, rejected_rows, sorted(map(int, sizes)))
        before, manifest.schema = Manifest(**asdict(manifest)), json.dumps(schema.jsonValue())
        for group in self._groups(sizes):
            self._merge(manifest, before, once.where(F.col(BUCKET).cast("string").isin(group)), group, columns, schema, insert, replace_nulls, counts)
        if batch:
            manifest.batches[batch[0]] = batch[1]
        self._publish(manifest)
        return counts

    def _groups(self, sizes: dict[str, int]) -> list[list[str]]:
        groups, room = [], 0
        for b in sorted(sizes, key=int):
            if not groups or sizes[b] > room:
                groups.append([])
                room = self.group_rows
            groups[-1].append(b)
            room -= sizes[b]
        return groups

    def _merge(self, manifest: Manifest, before: Manifest, staged: DataFrame, group: list[str], columns: list[str],
               schema: StructType, insert: bool, replace_nulls: bool, counts: UpdateCounts) -> None:
        """Rewrite the buckets of a group with their staged rows."""
        n_staged = staged.count()
        table, new = self._read(before, group), staged.select(
            *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(manifest.keys)], "_new", F.lit(True).alias("_hit"))
        for f in schema.fields:
            if f.name not in table.columns:
                table = table.withColumn(f.name, F.lit(None).cast(f.dataType))
        on = F.lit(True)
        for i, k in enumerate(manifest.keys):
            on = on & (F.col(f"`{k}`") == F.col(f"_k{i}"))
        # a group holds at most group_rows staged rows, unless one bucket's share is larger: then Spark chooses the join
        joined = table.join(F.broadcast(new) if n_staged <= self.group_rows else new, on, "left")
        hit = F.coalesce("_hit", F.lit(False))

        def value(name: str) -> Column:
            old = F.col(f"`{name}`")
            if name not in columns:
                return old
            fresh = F.col(f"_new.`{name}`").cast(schema[name].dataType)
            return F.when(hit, fresh if replace_nulls else F.coalesce(fresh, old)).otherwise(old).alias(name)

        seen, folder = Observation(), self._folder()
        out = joined.select(*[value(n) for n in schema.names], hit.alias("_hit")).observe(
            seen, F.count_if(F.col("_hit")).alias("hits")).drop("_hit")
        written = self._write(out.withColumn(BUCKET, F.expr(manifest.by)), folder)
        for b in written:
            manifest.folders[b] = folder
        hits = int(seen.get["hits"] or 0)
        counts.updated += hits
        if not insert:
            counts.unmatched += n_staged - hits
        elif n_staged > hits:
            self._insert(manifest, before, staged, group, columns, schema, folder, counts)

    def _insert(self, manifest: Manifest, before: Manifest, staged: DataFrame, group: list[str], columns: list[str],
                schema: StructType, folder: str, counts: UpdateCounts) -> None:
        """Add the staged rows whose keys the buckets of a group lack, as files next to the rewritten ones."""
        old = self._read(before, group).select(*[F.col(f"`{k}`") for k in manifest.keys])
        fresh = staged.join(old, manifest.keys, "left_anti")  # both are one group's share

        def value(f) -> Column:
            if f.name in manifest.keys:
                return F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
            return (F.col(f"_new.`{f.name}`") if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name)

        seen = Observation()
        rows = fresh.select(*[value(f) for f in schema.fields], F.col(BUCKET)).observe(seen, F.count(F.lit(1)).alias("n"))
        rows.write.mode("append").partitionBy(BUCKET).parquet(folder)
        for b in group:
            manifest.folders.setdefault(b, folder)
        counts.inserted += int(seen.get["n"])

    def vacuum(self) -> int:
        """Remove data and staged folders that the current version does not name.  Returns how many."""
        manifest = self.manifest()
        keep = {f.rsplit("/", 1)[-1] for f in [*manifest.folders.values(), *manifest.rejects]}
        p, fs = _fs(self.spark, self.path)
        gone = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName() not in keep]
        for path in gone:
            fs.delete(path, True)
        return len(gone)
