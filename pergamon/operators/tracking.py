"""Which files are known, new, deleted or in progress."""

from pyspark.sql import functions as F

from pergamon import fixed_values as V
from pergamon.functions.paths import base_name, join_path
from pergamon.operators.skew import key_filter, keyed_join

FILE_KEY = ["file_name", "folder_name", "document_type"]


def processed_paths(track):
    """Paths of the files that were handled or are being handled."""
    return track.where(F.col("status").isin(V.PROCESSED_STATES)).select(join_path().alias("path"))


def processed_file_names(track):
    return track.select("file_name").distinct()


def paths_except(left, right):
    """EXCEPT DISTINCT in one aggregate: one shuffle, copies fold before it, NULL equals NULL.

    A set difference by join needs both sides distinct and shuffled again for the join.
    """
    both = left.select("path", F.lit(True).alias("_left")).unionByName(
        right.select("path", F.lit(False).alias("_left"))
    )
    return both.groupBy("path").agg(F.bool_and("_left").alias("_left")).where("_left").select(
        "path"
    )


def new_files(volume, track):
    """Paths on the volume that the track table does not hold as processed."""
    return paths_except(volume.select("path"), processed_paths(track))


def deleted_files(track, volume):
    """Paths in the track table, in any state, that are no longer on the volume."""
    return paths_except(track.select(join_path().alias("path")), volume.select("path"))


def work_gate(**stages):
    """One row with the number of rows of every stage; the stages are counted together."""
    rows = None
    for name, df in stages.items():
        tagged = df.select(F.lit(name).alias("stage"), F.lit(1).alias("n"))
        rows = tagged if rows is None else rows.unionByName(tagged)
    known = F.array(*[F.lit(name) for name in stages])
    every = rows.sparkSession.range(1).select(F.explode(known).alias("stage"), F.lit(0).alias("n"))
    return rows.unionByName(every).groupBy("stage").agg(F.sum("n").cast("long").alias("n"))


def insert_if_absent(track, new, status):
    """Rows to insert: those of `new` whose key is not in `track`, in the given state.

    A NULL in the key matches nothing, so such a row is inserted every time; copies in `new`
    are all kept.
    """
    return key_filter(new.select(*FILE_KEY), track, FILE_KEY, keep=False).withColumn(
        "status", F.lit(status)
    )


def _flip(track, matches):
    """UPDATED for the rows in progress that `matches` marks; the others are not shuffled."""
    pending = F.coalesce(F.col("status") == V.UPDATING, F.lit(False))
    marked = matches(track.where(pending))
    flipped = marked.withColumn(
        "status", F.when(F.col("_match"), F.lit(V.UPDATED)).otherwise(F.col("status"))
    ).drop("_match")
    return track.where(~pending).unionByName(flipped)


def update_status_in(track, batch):
    """UPDATED where name, folder and type each occur somewhere in the batch.

    The three tests are independent: a name of one file and a folder of another also match.
    """

    def matches(pending):
        hit = F.lit(True)
        for key in FILE_KEY:
            seen = batch.select(key).distinct().withColumn(f"_seen_{key}", F.lit(True))
            pending = keyed_join(pending, seen, [key])
            hit = hit & F.coalesce(F.col(f"_seen_{key}"), F.lit(False))
        return pending.withColumn("_match", hit).drop(*[f"_seen_{k}" for k in FILE_KEY])

    return _flip(track, matches)


def update_status_tuple(track, batch):
    """UPDATED where the whole key of a row in progress is in the batch."""
    seen = batch.select(*FILE_KEY).distinct().withColumn("_match", F.lit(True))
    return _flip(track, lambda pending: keyed_join(pending, seen, FILE_KEY))


def names_of(paths):
    return paths.select(base_name("path").alias("file_name")).distinct()


def chunks_for_files(chunks, paths):
    """Chunks of the files with the base names of `paths`."""
    return key_filter(chunks, names_of(paths), ["file_name"])


def deleted_chunk_ids(chunks, paths):
    return chunks_for_files(chunks.select("id", "file_name"), paths).select("id")


def remaining_after_delete(table, paths):
    """Rows of other base names. Rows without a name are kept."""
    return key_filter(table, names_of(paths), ["file_name"], keep=False)


def delete_by_file(table, paths, by_path=False):
    """The rows that stay when the files of `paths` go, by base name or by whole path.

    By base name, removing one file also removes every file of that name in other folders.
    """
    if not by_path:
        return remaining_after_delete(table, paths)
    gone = paths.select(
        F.regexp_replace("path", "/[^/]*$", "").alias("folder_name"),
        base_name("path").alias("file_name"),
    )
    return key_filter(table, gone, ["folder_name", "file_name"], keep=False)


def flatten_manifest(paths, target):
    """Where each file lands in the flat folder; of equal base names the greatest path stays.

    The winner is an aggregate per target, joined back, so Spark can split a base name that very
    many files have.
    """
    landing = paths.select(
        F.col("path").alias("source_path"),
        F.concat(F.lit(f"{target}/"), base_name("path")).alias("target_path"),
    )
    winners = landing.groupBy("target_path").agg(
        F.max("source_path").alias("_winner"), F.count("*").alias("_sources")
    )
    return keyed_join(landing, winners, ["target_path"], "inner").select(
        "source_path", "target_path",
        (F.col("_sources") > 1).alias("collides"),
        (F.col("source_path") == F.col("_winner")).alias("stays"),
    )
