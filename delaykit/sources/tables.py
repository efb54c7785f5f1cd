"""Views, catalog tables and keyed tables."""

import time
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.operators.counts import total_of, with_total
from delaykit.operators.latest import latest_per_key

WRITER_COLUMN, BATCH_COLUMN, WRITTEN_COLUMN = "writer", "batch_id", "written_us"
# Folders of compacted states; a leading underscore hides them from plain readers of the table's root.
GENERATIONS, STATE, COVERS = "_generations", "state", "covers"
# File that Spark's writers leave in a folder once all of it is there.
COMMITTED = "_SUCCESS"


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` available to SQL text under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def publish_table(
    df: DataFrame,
    table: str,
    provider: str = "parquet",
    bucket_by: tuple[int, list[str]] | None = None,
    location: str | None = None,
) -> DataFrame:
    """Create or replace a catalog table, with its namespace, and read it back.

    ``iceberg`` replaces by snapshot through the catalog; file providers go
    through the session catalog, where ``bucket_by`` = (buckets, columns) lays
    the rows out so that later joins on those columns need no shuffle, and
    ``location`` keeps the files outside the warehouse. File providers replace
    in place; ``replace_table`` does so without readers noticing.
    """
    spark = df.sparkSession
    _make_namespace(spark, table)
    if provider == "iceberg":
        df.writeTo(table).using(provider).createOrReplace()
    else:
        _save_table(df, table, provider, bucket_by, location)
    return spark.table(table)


def publish_counted(df: DataFrame, table: str, **options) -> tuple[DataFrame, int]:
    """``publish_table`` and the number of rows, which are counted as they are written."""
    counted, seen = with_total(df, "published")
    return publish_table(counted, table, **options), total_of(seen)


def _make_namespace(spark: SparkSession, table: str) -> None:
    namespace, _, _ = table.rpartition(".")
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def _save_table(df: DataFrame, table: str, provider: str, bucket_by, location: str | None) -> None:
    if bucket_by:
        # One task for each bucket, else every task writes a file for every bucket.
        df = df.repartition(bucket_by[0], *bucket_by[1])
    writer = df.write.format(provider).mode("overwrite")
    if location:
        writer = writer.option("path", location)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(*bucket_by[1])
    writer.saveAsTable(table)


def replace_table(
    df: DataFrame,
    table: str,
    root: str,
    provider: str = "parquet",
    bucket_by: tuple[int, list[str]] | None = None,
) -> DataFrame:
    """Replace a table of files by writing a new version below ``root`` and then moving the table's location to it.

    A reader that was opened before goes on with the old version, whose files stay; a write that fails leaves
    the table as it is. The columns must be those of the table, in their order, and so must ``bucket_by``.
    """
    spark = df.sparkSession
    _make_namespace(spark, table)
    version = f"{root}/version-{uuid.uuid4().hex}"
    if not spark.catalog.tableExists(table):
        _save_table(df, table, provider, bucket_by, version)
        return spark.table(table)
    kept = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
    if kept != [(f.name, f.dataType) for f in df.schema.fields]:
        raise ValueError(f"columns differ from those of {table}")
    # The new version is a table of its own until all of it is written.
    staged = f"{table}__{uuid.uuid4().hex}"
    try:
        _save_table(df, staged, provider, bucket_by, version)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def upsert_keyed(df: DataFrame, root: str, batch_id: int | str, writer: str = "batch") -> None:
    """Add a batch to a keyed table kept as files.

    Writes the folder of that writer's batch only, whatever the table's size, and replaces it when the batch
    is repeated, empty or not. Writers that count their batches on their own, such as streams with different
    checkpoints, need different names. ``read_keyed`` gives the row per key. Equally late rows are told apart by
    the time on the writer's driver, so writers that share keys should have their clocks in step.
    """
    written = F.lit(time.time_ns() // 1000)
    df.withColumn(WRITTEN_COLUMN, written).write.mode("overwrite").parquet(
        f"{root}/{WRITER_COLUMN}={writer}/{BATCH_COLUMN}={batch_id}"
    )


def stream_writer(df: DataFrame) -> str:
    """Name of the stream that runs this micro-batch: its id, which stays the same as long as its checkpoint."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


class KeyedParts(NamedTuple):
    """What a keyed table consists of now; batches are told by folder and time of their commit."""

    state: str | None  # newest finished generation
    covered: dict[str, int]  # batches whose rows it has
    batches: dict[str, int]  # all committed batches
    last: int  # highest generation number, finished or not

    @property
    def fresh(self) -> list[str]:
        """Batches committed, or repeated, since the generation."""
        return sorted(b for b, at in self.batches.items() if self.covered.get(b) != at)


def _files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(folder, time) of files that match."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [(f.getPath().getParent().toString(), f.getModificationTime()) for f in found]


def keyed_parts(spark: SparkSession, root: str) -> KeyedParts:
    """Lists folders only; a batch or generation counts once its writer has committed it."""
    short = lambda folder: "/".join(folder.rsplit("/", 2)[1:])
    batches = {short(f): at for f, at in _files(spark, f"{root}/{WRITER_COLUMN}=*/{BATCH_COLUMN}=*/{COMMITTED}")}
    number = lambda folder: int(folder.rsplit("/", 1)[-1])
    begun = [number(f) for f, _ in _files(spark, f"{root}/{GENERATIONS}/*/*")]
    finished = [number(f.rsplit("/", 1)[0]) for f, _ in _files(spark, f"{root}/{GENERATIONS}/*/{COVERS}/{COMMITTED}")]
    if not finished:
        return KeyedParts(None, {}, batches, max(begun, default=0))
    newest = f"{root}/{GENERATIONS}/{max(finished):09d}"
    listed = spark.read.schema("batch string, committed bigint").json(f"{newest}/{COVERS}").collect()
    return KeyedParts(f"{newest}/{STATE}", {r.batch: r.committed for r in listed}, batches, max(begun))


def _latest(spark: SparkSession, root: str, parts: KeyedParts, keys: list[str], order_col: str | None) -> DataFrame:
    """Latest row per key, with the time it was written."""
    paths = [f"{root}/{b}" for b in parts.fresh]
    if parts.state:
        paths.append(parts.state)
    rows = spark.read.parquet(*(paths or [root]))
    return latest_per_key(rows, keys, *([order_col] if order_col else []), WRITTEN_COLUMN)


def read_keyed(spark: SparkSession, root: str, keys: list[str], order_col: str | None = None) -> DataFrame:
    """Current state: the latest row per key; of equally late ones, or without order, the last written.

    Reads the newest finished generation of ``compact_keyed`` and the batches since, not the whole history.
    Batches that are still being written are left out.
    """
    return _latest(spark, root, keyed_parts(spark, root), keys, order_col).drop(WRITTEN_COLUMN)


def fresh_batches(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows of the batches since the newest generation, None if there are none."""
    paths = [f"{root}/{b}" for b in keyed_parts(spark, root).fresh]
    return spark.read.parquet(*paths).drop(WRITTEN_COLUMN) if paths else None


def compact_keyed(spark: SparkSession, root: str, keys: list[str], order_col: str | None = None) -> int:
    """Write the current state as the table's next generation; returns its number.

    Streams may go on: what they commit meanwhile is not in the generation's list, so readers take it besides.
    Readers follow once the list, which is written last, is there; a compaction that stops half-way changes
    nothing and is not counted. A batch that is repeated later is read again, but rows that the repeat no longer
    has stay. The files that a generation replaces are left to ``drop_replaced``.
    """
    parts = keyed_parts(spark, root)
    if not parts.batches and not parts.state:
        raise ValueError(f"nothing to compact in {root}")
    target = f"{root}/{GENERATIONS}/{parts.last + 1:09d}"
    _latest(spark, root, parts, keys, order_col).write.parquet(f"{target}/{STATE}")
    listed = spark.createDataFrame(sorted(parts.batches.items()), "batch string, committed bigint")
    listed.coalesce(1).write.json(f"{target}/{COVERS}")
    return parts.last + 1


def drop_replaced(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete what the newest ``keep`` finished generations do not need; returns the folders.

    These are the older generations and the batches that the oldest generation kept has taken in. Readers that
    were opened before that generation lose their files, so ``keep`` should cover the longest of them.
    """
    finished = sorted({f.rsplit("/", 1)[0] for f, _ in _files(spark, f"{root}/{GENERATIONS}/*/{COVERS}/{COMMITTED}")})
    if len(finished) < max(1, keep):
        return []
    kept = finished[-max(1, keep) :]
    listed = spark.read.schema("batch string, committed bigint").json(f"{kept[0]}/{COVERS}").collect()
    batches = keyed_parts(spark, root).batches
    old = [f for f in finished if f not in kept]
    old += [f"{root}/{r.batch}" for r in listed if batches.get(r.batch) == r.committed]
    for folder in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return old


def merge_keyed(df: DataFrame, table: str, keys: list[str], order_col: str) -> None:
    """Upsert into a catalog table that supports MERGE; an older row does not win."""
    same_key = " AND ".join(f"s.{k} <=> t.{k}" for k in keys)
    df.sparkSession.sql(
        f"MERGE INTO {table} AS t USING {{updates}} AS s ON {same_key} "
        f"WHEN MATCHED AND (t.{order_col} IS NULL OR s.{order_col} >= t.{order_col}) THEN UPDATE SET * "
        "WHEN NOT MATCHED THEN INSERT *",
        updates=latest_per_key(df, keys, order_col),
    )


def append_store(df: DataFrame, table: str, keyspace: str, fmt: str = "org.apache.spark.sql.cassandra") -> None:
    """Append to a key-value store whose primary key makes the append an upsert."""
    df.write.format(fmt).mode("append").options(table=table, keyspace=keyspace).save()
