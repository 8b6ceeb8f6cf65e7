"""The document tables: creation, append, keyed replacement, deletion and compaction.

The tables are parquet, partitioned by a hash bucket of folder and file name. New rows are
appended and have the number of their write. A deletion appends the files to a small table beside and leaves
all data files in place: rows of these files written before it are passed over by every scan, rows
that come later are not. Compaction rewrites the buckets in which too large a share is deleted, and
drops their deletions. A replacement rewrites the buckets it touches and no others. Track rows of files in
progress have a bucket of their own, so that their end is an append and the drop of that
bucket. There is one writer at a time; a run that stops half-way is repeated and gives the same rows.
"""

from collections import namedtuple

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pergamon import fixed_values as V
from pergamon import schemas
from pergamon.operators.skew import key_filter
from pergamon.session import shared_folder

BUCKET = "path_bucket"
PENDING = -1  # bucket of the track rows of files in progress
WRITTEN = "written"  # the number of the write that a row came with

#: A bucket is rewritten when this share of its rows is deleted. So many deletions are held at most: they are
#: broadcast to the scans, and beyond that every bucket that has some is rewritten.
COMPACT_SHARE = 0.3
MAX_DELETIONS = 200_000

#: Codec of the files, and the files of one scan task from which they are small and are put together.
COMPRESSION = "zstd"
SMALL_FILES = 4
SCHEMAS = {
    "text": schemas.TEXT, "track": schemas.TRACK,
    "chunks": schemas.CHUNKS, "index": schemas.INDEX,
}
DocumentTables = namedtuple("DocumentTables", ["text", "track", "chunks", "index"])


def table_names(functional_name, database=None):
    prefix = f"{database}." if database else ""
    return DocumentTables(*[
        prefix + V.TABLE_NAMES[role].format(functional_name) for role in DocumentTables._fields
    ])


def create_database(spark, name, folder):
    """A database whose tables live below `folder`."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder}'")
    return name


def create_tables(spark, tables, buckets=256):
    """CREATE TABLE IF NOT EXISTS for the four tables.

    They are managed tables: to drop an emptied bucket must also delete its files, or a later
    append to the bucket would bring the rows back.
    """
    for role, schema in SCHEMAS.items():
        _create_table(spark, getattr(tables, role), schema, buckets)


def _create_table(spark, name, schema, buckets=256):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {WRITTEN} BIGINT, {BUCKET} INT) USING parquet "
        f"OPTIONS ('compression' = '{COMPRESSION}') PARTITIONED BY ({BUCKET}) "
        f"TBLPROPERTIES ('path_buckets' = '{buckets}')"
    )


def _property(spark, table, key):
    """A table property, or None."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return found.get(key)


def _buckets(spark, table):
    return int(_property(spark, table, "path_buckets"))


def _next_write(spark, table):
    """The number of a new write; each is taken once, also by a write that fails."""
    number = int(_property(spark, table, "last_write") or 0) + 1
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('last_write' = '{number}')")
    return number


def _deletions(table):
    return f"{table}_deletions"


def reserve_ids(spark, table, n):
    """The last id given out before; n more are now taken. The mark is kept with the table."""
    last = _property(spark, table, "last_id")
    if last is None:
        last = _current(spark, table).agg(F.max("id")).first()[0] or 0
    last = int(last)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('last_id' = '{last + n}')")
    return last


def _with_bucket(rows, buckets):
    bucket = F.pmod(F.hash("folder_name", "file_name"), F.lit(buckets))
    if "status" in rows.columns:
        bucket = F.when(F.col("status") == V.UPDATING, F.lit(PENDING)).otherwise(bucket)
    return rows.withColumn(BUCKET, bucket)


def _shaped(spark, rows, table):
    """The columns of the table in its order, by name, with the number of a new write."""
    rows = _with_bucket(rows, _buckets(spark, table)).withColumn(WRITTEN, F.lit(_next_write(spark, table)))
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema
    ])


def _current(spark, table, buckets=None):
    """The rows as they are now: another session, such as a stream's, may have rewritten files."""
    spark.catalog.refreshTable(table)
    rows = spark.table(table)
    return rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))


def deletions(spark, table):
    """(folder_name, file_name, below): rows of the file with a smaller number are deleted. None if there never were any.

    At most about MAX_DELETIONS rows, so they are broadcast.
    """
    name = _deletions(table)
    if not spark.catalog.tableExists(name):
        return None
    spark.catalog.refreshTable(name)
    files = spark.table(name).groupBy("folder_name", "file_name").agg(F.max("below").alias("below"))
    return F.broadcast(files)


def _live(spark, table, buckets=None):
    """The rows that are not deleted, with bucket and number."""
    rows, gone = _current(spark, table, buckets), deletions(spark, table)
    if gone is None:
        return rows
    gone = gone.select(F.col("folder_name").alias("_folder"), F.col("file_name").alias("_file"), "below")
    deleted = (F.col("folder_name") == F.col("_folder")) & (F.col("file_name") == F.col("_file")) & (
        F.col(WRITTEN) < F.col("below"))
    return rows.join(gone, deleted, "left_anti")


def scan_table(spark, table, buckets=None):
    """The rows without bucket and number, of all buckets or of some."""
    return _live(spark, table, buckets).drop(BUCKET, WRITTEN)


def write_append(spark, rows, table, made_of=None):
    """Append by column name. `made_of`: see `overwrite`."""
    _laid(spark, _shaped(spark, rows, table), table, made_of).write.insertInto(table)


def _balanced(rows):
    """Rows of a bucket together, so no small files pile up; a large bucket has many writers."""
    return rows.hint("rebalance", F.col(BUCKET))


def _are_large(scan, buckets):
    """Whether the files of a scan are few for its tasks or buckets, so that written task by task they stay few."""
    return len(scan.inputFiles()) <= SMALL_FILES * max(scan.rdd.getNumPartitions(), buckets)


def _laid(spark, rows, table, made_of):
    """Rows that were made of a scan of another table with as many buckets lie by bucket already, and are not moved."""
    if made_of is None or _buckets(spark, made_of) != _buckets(spark, table):
        return _balanced(rows)
    return rows if _are_large(_current(spark, made_of), _buckets(spark, table)) else _balanced(rows)


def write_overwrite_if_empty(spark, rows, table, made_of=None):
    """Write only if the table is missing or empty; whether it was written. `made_of`: see `overwrite`."""
    exists = spark.catalog.tableExists(table)
    if exists and not _live(spark, table).isEmpty():
        return False
    if not exists:
        alike = [s for s in SCHEMAS.values() if set(s.names) == set(rows.columns)]
        _create_table(spark, table, alike[0] if alike else rows.schema)
    overwrite(spark, rows, table, made_of)
    return True


def overwrite(spark, rows, table, made_of=None):
    """Put `rows` in place of all rows of the table, by one write; its deletions are then of no rows.

    `made_of` names the table that `rows` were scanned from, if every step since kept a row's file and moved no row: then
    nothing is shuffled, unless that table has many small files.
    """
    _laid(spark, _shaped(spark, rows, table), table, made_of).write.insertInto(table, overwrite=True)
    _forget(spark, table)


def is_empty(spark, table):
    return not spark.catalog.tableExists(table) or _live(spark, table).isEmpty()


def pending_rows(spark, track):
    """Track rows of files in progress; nothing else is read."""
    return scan_table(spark, track, [PENDING])


def drop_pending(spark, track, files):
    """Take the given files (folder_name, file_name) out of those in progress."""
    left = key_filter(
        _current(spark, track, [PENDING]), files, ["folder_name", "file_name"], keep=False
    ).checkpoint()
    _rewrite(spark, track, left, [PENDING])


def _rewrite(spark, table, rows, touched=(), lies=False):
    """Replace the buckets that `rows` has, and drop those of `touched` that it has not.

    A dynamic overwrite leaves a bucket alone that no row is left for. Rows that lie by bucket are not moved.
    """
    filled = {r[0] for r in rows.select(BUCKET).distinct().collect()} if touched else None
    if filled is None or filled:
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            (rows if lies else _balanced(rows)).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    emptied = [f"PARTITION ({BUCKET} = {b})" for b in sorted(set(touched) - (filled or set()))]
    if emptied:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(emptied)}")


def touched_buckets(spark, files, table):
    """Buckets of the files (folder_name, file_name): at most as many as the table has."""
    keys = files.select("folder_name", "file_name")
    found = _with_bucket(keys, _buckets(spark, table)).select(BUCKET).distinct().collect()
    buckets = [r[0] for r in found]
    in_track = "status" in spark.table(table).columns
    return [*buckets, PENDING] if buckets and in_track else buckets


def replace_rows(spark, table, rows, files=None, buckets=None):
    """Put `rows` in place of all rows of the same files, or of `files`, which may be more.

    `buckets` are those of the files, if they are known.
    """
    rows = _shaped(spark, rows, table)
    wanted = rows if files is None else files
    touched = touched_buckets(spark, wanted, table) if buckets is None else buckets
    if not touched:
        return
    kept = key_filter(
        _current(spark, table, touched), wanted, ["folder_name", "file_name"], keep=False
    )
    _rewrite(spark, table, kept.unionByName(rows), touched)


def rows_of_files(spark, table, files, buckets=None):
    """The rows of the given files; only their buckets are read."""
    touched = touched_buckets(spark, files, table) if buckets is None else buckets
    return key_filter(
        scan_table(spark, table, touched), files, ["folder_name", "file_name"]
    )


def _forget(spark, table, buckets=None):
    """Drop the deletions of all buckets or of some."""
    name = _deletions(table)
    if not spark.catalog.tableExists(name):
        return
    if buckets is None:
        spark.sql(f"TRUNCATE TABLE {name}")
    elif buckets:
        parts = ", ".join(f"PARTITION ({BUCKET} = {b})" for b in buckets)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")


def delete_rows(spark, table, files):
    """Delete all rows of the given files (folder_name, file_name); no data file is written or dropped.

    Only track rows of files in progress, which lie in one small bucket, are taken out at once. Files with
    a NULL name or folder have no rows to delete.
    """
    shared_folder(spark)
    keys = files.select("folder_name", "file_name").dropna().distinct()
    keys = _with_bucket(keys, _buckets(spark, table)).checkpoint()
    if keys.isEmpty():
        return
    if "status" in spark.table(table).columns:
        drop_pending(spark, table, keys)
    name = _deletions(table)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (folder_name STRING, file_name STRING, below BIGINT, {BUCKET} INT) "
        f"USING parquet PARTITIONED BY ({BUCKET})"
    )
    below = F.lit(_next_write(spark, table)).cast("bigint").alias("below")
    _balanced(keys.select("folder_name", "file_name", below, BUCKET)).write.insertInto(name)
    spark.catalog.refreshTable(name)
    if spark.table(name).count() > MAX_DELETIONS:
        compact(spark, table, share=0.0)


def deleted_shares(spark, table):
    """path_bucket, n_rows, n_deleted of the buckets that have deletions; only keys and numbers are read."""
    gone = deletions(spark, table)
    if gone is None:
        return spark.createDataFrame([], f"{BUCKET} int, n_rows long, n_deleted long")
    name = _deletions(table)
    buckets = F.broadcast(spark.table(name).select(BUCKET).distinct())
    rows = _current(spark, table).select("folder_name", "file_name", WRITTEN, BUCKET)
    rows = rows.join(buckets, BUCKET, "left_semi").join(gone, ["folder_name", "file_name"], "left")
    deleted = F.coalesce(F.col(WRITTEN) < F.col("below"), F.lit(False))
    return rows.groupBy(BUCKET).agg(F.count("*").alias("n_rows"), F.count_if(deleted).alias("n_deleted"))


def compact(spark, table, share=COMPACT_SHARE):
    """Rewrite the buckets in which at least this share of the rows is deleted; their number.

    The deletions of a bucket are dropped after it is rewritten, so a run that stops between is repeated. Deletions
    in buckets without any deleted row are dropped, too. Only buckets with many small files are shuffled, which puts
    these together.
    """
    if deletions(spark, table) is None:
        return 0
    found = {r[0]: (r["n_rows"], r["n_deleted"]) for r in deleted_shares(spark, table).collect()}
    held = [r[0] for r in spark.table(_deletions(table)).select(BUCKET).distinct().collect()]
    idle = [b for b in held if not found.get(b, (0, 0))[1]]
    full = sorted(b for b, (n, gone) in found.items() if gone and gone >= share * n)
    if full:
        large = _are_large(_current(spark, table, full), len(full))
        _rewrite(spark, table, _live(spark, table, full), full, lies=large)
    _forget(spark, table, [*idle, *full])
    return len(full)


def describe_schema(rows):
    """Column names and types of a table."""
    fields = [(f.name, f.dataType.simpleString()) for f in rows.schema]
    schema = T.StructType([
        T.StructField("col_name", T.StringType()), T.StructField("data_type", T.StringType()),
    ])
    return rows.sparkSession.createDataFrame(fields, schema)


def describe_index_schema(chunks):
    """The chunk table's columns and the embedding: the columns of its index."""
    embedding = chunks.sparkSession.createDataFrame(
        [("chunk_embedding", "array<float>")], "col_name string, data_type string"
    )
    return describe_schema(chunks).unionByName(embedding)


def preview_limit(rows, n, key="id"):
    return rows.orderBy(key).limit(n)


def assign_ids(rows, order_by=None, start=0):
    """Consecutive ids after `start`, in the order of `order_by` if there is one.

    No window over all rows: they are numbered within their partition, and each partition is
    moved up by the rows before it. For an order they are sorted by range; without one they are
    not moved, and what made them runs once. They are checkpointed in the shared folder, because
    partitions must not change between the count and the use.
    """
    shared_folder(rows.sparkSession)
    position = F.monotonically_increasing_id()
    if order_by:
        rows = rows.repartitionByRange(*[F.col(c) for c in order_by]).sortWithinPartitions(
            *order_by
        )
    ordered = rows.withColumn("_at", position).checkpoint()
    numbered = ordered.withColumn("_part", F.shiftright("_at", 33)).withColumn(
        "_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    )
    # One row per partition of the sort, whatever the data; kept, so that no use of the rows counts them again.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = numbered.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    ).checkpoint()
    return (
        numbered.join(F.broadcast(before), "_part")
        .withColumn("id", F.col("_before") + F.col("_at") + F.lit(start + 1))
        .select("id", *[c for c in rows.columns if c != "id"])
    )
