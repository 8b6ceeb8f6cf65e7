"""Jobs that keep the document tables in step with the files: build, update, purge."""

from pyspark.sql import functions as F

from pergamon import fixed_values as V
from pergamon.functions.paths import base_name, dir_name, join_path
from pergamon.operators.chunking import chunk_recursive, with_chunk_ids
from pergamon.operators.content import embed_once
from pergamon.operators.indexing import embed_text
from pergamon.operators.skew import key_filter
from pergamon.operators.tracking import (
    FILE_KEY, deleted_files, insert_if_absent, update_status_tuple,
)
from pergamon.session import shared_folder
from pergamon.sources import tables as S
from pergamon.sources.files import extract_text
from pergamon.sources.requests import send_deletes, send_upserts

#: Names of so many files of a batch are broadcast to its wide rows, which are then not shuffled.
MAX_BROADCAST = 200_000


def file_keys(document_type):
    """Key columns of files given by path; the type is a name or a Column."""
    kind = F.lit(document_type) if isinstance(document_type, str) else document_type
    return (
        base_name("path").alias("file_name"), dir_name("path").alias("folder_name"),
        kind.alias("document_type"),
    )


def as_documents(extracted, document_type):
    """Extracted files (path, extracted_text, error) as documents."""
    return extracted.select(*file_keys(document_type), "extracted_text", "error")


def _embedded(chunks, embed, dimension, store):
    """The chunks with their embeddings; with a `store`, a folder, each distinct text is embedded once over all runs."""
    if store is None:
        return embed_text(chunks, embed=embed, dimension=dimension)
    return embed_once(chunks, store, embed=embed, dimension=dimension)


def build_index(spark, tables, embed=None, dimension=V.EMBEDDING_DIMENSION, client=None, store=None):
    """Fill the index from the whole chunk table. Running it again gives the same index.

    With a `store` (`operators.content`), texts embedded before don't reach the model again. With a client (`sources.requests`) an index kept elsewhere gets all its rows too.
    """
    chunks = S.scan_table(spark, tables.chunks)
    # a store's embeddings come by a join, which moves the rows
    S.overwrite(spark, _embedded(chunks, embed, dimension, store), tables.index,
                made_of=tables.chunks if store is None else None)
    if client is not None:
        send_upserts(spark, S.scan_table(spark, tables.index), client)


def build(spark, tables, documents, chunk=chunk_recursive, embed=None, dimension=V.EMBEDDING_DIMENSION,
          client=None, store=None):
    """First fill of all four tables; nothing happens if the text table has rows.

    Documents with an error are left out and come again with the next update. The track table is written last.
    """
    if not S.is_empty(spark, tables.text):
        return False
    numbered = S.assign_ids(documents.where("error IS NULL"))
    S.reserve_ids(spark, tables.text, numbered.count())
    S.write_overwrite_if_empty(spark, numbered, tables.text)
    texts = S.scan_table(spark, tables.text)
    chunks = with_chunk_ids(chunk(texts.where("extracted_text IS NOT NULL")))
    S.write_overwrite_if_empty(spark, chunks, tables.chunks, made_of=tables.text)
    build_index(spark, tables, embed=embed, dimension=dimension, client=client, store=store)
    known = S.scan_table(spark, tables.track)
    S.write_append(spark, insert_if_absent(known, texts, V.READY), tables.track)
    return True


def not_done(spark, tables, rows):
    """The files among `rows` that are not READY or UPDATED.

    Only the track rows of these files are read, and then only those that are done matter, so a
    small batch stays small beside a large track table. Names are compared before anything wide is touched: the rows are
    given back as they are if no file is done, none if all are, and else they meet the done files or the
    others, whichever are fewer; these are broadcast, up to MAX_BROADCAST.
    """
    shared_folder(spark)
    keys = rows.select(*FILE_KEY).distinct().checkpoint()
    known = S.scan_table(spark, tables.track, S.touched_buckets(spark, keys, tables.track))
    done = key_filter(known.where(F.col("status").isin(V.READY, V.UPDATED)), keys, FILE_KEY)
    done = done.select(*FILE_KEY).distinct().checkpoint()
    n_done = done.count()
    if n_done == 0:
        return rows
    left = key_filter(keys, done, FILE_KEY, keep=False).checkpoint()
    n_left = left.count()
    if n_left == 0:
        return rows.where(F.lit(False))
    few, how = (left, "left_semi") if n_left < n_done else (done, "left_anti")
    few = few.select(*[F.col(c).alias(f"_{c}") for c in FILE_KEY])
    if min(n_left, n_done) <= MAX_BROADCAST:
        few = F.broadcast(few)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FILE_KEY]  # a file with a NULL in its key is never done
    return rows.join(few, same[0] & same[1] & same[2], how)


def update_files(spark, tables, files, document_type, parsers=None, **options):
    """`update_index` from files (path, content); files that are done are not opened."""
    named = files.select("path", "content", *file_keys(document_type))
    extracted = extract_text(not_done(spark, tables, named), parsers)
    return update_index(spark, tables, extracted, checked=True, **options)


def _settle(spark, tables):
    """Files whose end was recorded by a run that stopped right after it are in progress no more."""
    pending = S.pending_rows(spark, tables.track)
    if pending.isEmpty():
        return
    files = pending.select("folder_name", "file_name")
    known = S.rows_of_files(spark, tables.track, files)
    done = key_filter(pending, known.where(F.col("status").isin(V.READY, V.UPDATED)), FILE_KEY)
    done = done.checkpoint()
    if not done.isEmpty():
        S.drop_pending(spark, tables.track, done)


def update_index(spark, tables, documents, chunk=chunk_recursive, embed=None, dimension=V.EMBEDDING_DIMENSION,
                 checked=False, client=None, store=None):
    """Take in new documents; the number of files taken in.

    A client (`sources.requests`) keeps an index elsewhere in step: it gets the ids of rows that are replaced, before
    they are, and the new rows, before the state turns to UPDATED; so a run that stopped is made good by the next.

    Files that are READY or UPDATED are skipped. Files that the track table does not know are
    appended to every table, and no file that is there is written again; only files it knows, such as
    those a stopped run left at UPDATING, have rows to replace. The state turns to UPDATED after the
    index is written, so a repeated batch changes nothing.
    """
    shared_folder(spark)
    _settle(spark, tables)
    todo = (documents if checked else not_done(spark, tables, documents)).where("error IS NULL")
    # Numbered rows are checkpointed, so the files are read and parsed once. What needs names only reads them from their own.
    batch = S.assign_ids(todo.select(*FILE_KEY, "extracted_text"))
    named = batch.select(*FILE_KEY).checkpoint()
    size = named.count()
    if size == 0:
        return 0
    batch = batch.withColumn("id", F.col("id") + S.reserve_ids(spark, tables.text, size))
    files = named.select("folder_name", "file_name")
    known = S.rows_of_files(spark, tables.track, files).checkpoint()
    again = known.select("folder_name", "file_name").distinct()
    again = None if known.isEmpty() else again
    S.write_append(spark, insert_if_absent(known, named, V.UPDATING), tables.track)
    chunks = with_chunk_ids(chunk(batch.where("extracted_text IS NOT NULL"))).checkpoint()
    embedded = _embedded(chunks, embed, dimension, store)
    for table, rows in ((tables.text, batch), (tables.chunks, chunks), (tables.index, embedded)):
        if again is not None:
            if client is not None and table == tables.chunks:
                send_deletes(spark, S.rows_of_files(spark, table, again), client)
            S.delete_rows(spark, table, again)
        S.write_append(spark, rows, table)
    if client is not None:
        # the embeddings just written, not made a second time
        new = S.rows_of_files(spark, tables.index, files)
        send_upserts(spark, key_filter(new, chunks.select("id"), ["id"]), client)
    ended = update_status_tuple(S.pending_rows(spark, tables.track), named)
    ended = ended.where(F.col("status") == V.UPDATED).checkpoint()
    S.write_append(spark, ended, tables.track)
    S.drop_pending(spark, tables.track, ended)
    return size


def purge_deleted(spark, tables, volume, target=None, share=S.COMPACT_SHARE, client=None):
    """Remove the files that are no longer on the volume from all tables; their paths.

    With a flat folder as `target`, also the copies there that no file needs any more. A client
    (`sources.requests`) gets the ids of the chunks first, so a run that stopped sends them again.

    Deletes by small rows beside the tables, so what is written grows with the files that are gone; buckets that
    are deleted in large part are then rewritten (`share`, none with a share above 1).

    Works by path: a file of the same name in another folder stays. Names that begin with `_` or `.`
    stay too, as no listing by Spark can hold them. The track table, which says what is gone,
    is changed last. `volume` must be a whole listing without empty files left out on purpose.
    """
    shared_folder(spark)
    gone = deleted_files(S.scan_table(spark, tables.track), volume)
    gone = gone.where(~base_name("path").rlike("^[_.]")).checkpoint()
    files = gone.select(
        dir_name("path").alias("folder_name"), base_name("path").alias("file_name")
    )
    if client is not None:
        send_deletes(spark, S.rows_of_files(spark, tables.chunks, files), client)
    for table in (tables.chunks, tables.text, tables.index, tables.track):
        S.delete_rows(spark, table, files)
        S.compact(spark, table, share)
    return gone if target is None else (gone, flat_copies_to_drop(gone, volume, target))


def flat_copies_to_drop(gone, remaining, target):
    """Targets in the flat folder that no remaining file uses any more."""
    name = base_name("path").alias("file_name")
    unused = key_filter(
        gone.select(name).distinct(), remaining.select(name), ["file_name"], keep=False
    )
    return unused.select(F.concat(F.lit(f"{target}/"), "file_name").alias("target_path"))


def purge_summary(track, texts, chunks, volume):
    """What a purge by path removes from each table and what it leaves."""
    def per_file(rows, *tables):
        named = F.explode(F.array(*[F.lit(t) for t in tables])).alias("table_name")
        counted = rows.groupBy(join_path().alias("path")).agg(F.count("*").alias("_rows"))
        return counted.select("path", "_rows", named)

    counts = per_file(chunks, "chunks", "index").unionByName(per_file(texts, "text")).unionByName(
        per_file(track, "track")
    )
    gone = deleted_files(track, volume).withColumn("_gone", F.lit(True))
    removed = F.coalesce(F.sum(F.when(F.col("_gone"), F.col("_rows"))), F.lit(0))
    return counts.join(gone, "path", "left").groupBy("table_name").agg(
        removed.alias("n_removed"), (F.sum("_rows") - removed).alias("n_left")
    )
