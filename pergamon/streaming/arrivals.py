"""Index update and new-file detection on a stream of arriving files."""

from pyspark import StorageLevel

from pergamon.operators.skew import key_filter
from pergamon.operators.tracking import paths_except, processed_paths
from pergamon.plans.lifecycle import update_files

TRIGGER_SECONDS = 61  # fixed value: the least time between two updates


def _start(stream, handle, checkpoint, once):
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{TRIGGER_SECONDS} seconds").start()


def stream_index_update(files, tables, checkpoint, document_type="tmp", parsers=None,
                        once=False, **options):
    """Run the index update on every batch of arriving files (path, content).

    One query with one checkpoint takes the place of concurrent runs. A replayed batch replaces
    its own rows. `document_type` may be a column of the stream, given as a Column.
    """

    def handle(batch, _):
        # The batch is a scan that always reads `content`: it is kept, so files are opened once.
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            update_files(batch.sparkSession, tables, batch, document_type, parsers, **options)
        finally:
            batch.unpersist()

    return _start(files, handle, checkpoint, once)


def stream_new_files(files, track, sink, checkpoint, once=False):
    """Write the arriving paths that the track table does not hold as processed to `sink`.

    The file source gives each path once. `track` is called for every batch, so it sees the
    state of the time; a batch has its own folder below `sink`, so a replay writes it anew.
    """

    def handle(batch, number):
        paths = batch.select("path")
        known = key_filter(processed_paths(track(batch.sparkSession)), paths, ["path"])
        fresh = paths_except(paths, known)
        fresh.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return _start(files, handle, checkpoint, once)
