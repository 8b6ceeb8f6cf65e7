"""The vector index: embedding, upsert, delete and request batches."""

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pergamon import fixed_values as V
from pergamon.functions.vectors import hashed_embedding
from pergamon.operators.skew import key_filter
from pergamon.sources.tables import assign_ids


def model_embedding(make_predict, batch_size=64):
    """Embedding column function of a user's model; `make_predict` runs once per Python worker."""
    predict = predict_batch_udf(
        make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size
    ).asNondeterministic()  # a filter on the vector must not run the model again
    return lambda text: predict(F.col(text) if isinstance(text, str) else text)


def embed_text(rows, text="text_chunk", embed=None, dimension=V.EMBEDDING_DIMENSION,
               output="chunk_embedding"):
    """Add an embedding column: the user's model if `embed` is given, else hashed words."""
    column = embed(text) if embed else hashed_embedding(text, dimension)
    return rows.withColumn(output, column)


def index_upsert(target, source, order=()):
    """Insert or replace by id; of several source rows with one id the last by `order` is kept.

    Equal rows in that order go by their other columns. Only ids tell which rows have copies, so
    the wide rows of the others are neither sorted nor compared.
    """
    several = source.groupBy("id").agg(F.count("*").alias("_n")).where("_n > 1").select("id")
    rest = [*order, *[c for c in source.columns if c != "id" and c not in order]]
    last = key_filter(source, several, ["id"]).groupBy("id").agg(F.max(F.struct(*rest)).alias("_row"))
    unique = key_filter(source, several, ["id"], keep=False).select(*target.columns).unionByName(
        last.select("id", "_row.*").select(*target.columns))
    return key_filter(target, source, ["id"], keep=False).unionByName(unique)


def index_delete(target, ids):
    """Rows whose id is not among `ids`; no ids, no change."""
    return key_filter(target, ids, ["id"], keep=False)


def upsert_batches(chunks, limit=V.BATCH_BYTES, shard_rows=10_000):
    """Number the requests that carry the chunks: about `limit` bytes of text each, in id order.

    A shard is `shard_rows` chunks in the order of their ids, whatever the ids are, so requests go on
    over the ends of documents, and the running sum of one shard never depends on another.
    """
    sized = chunks.select(
        F.col("id").alias("chunk_id"), F.octet_length("text_chunk").cast("long").alias("bytes")
    )
    shard = F.floor((F.col("id") - 1) / shard_rows).cast("long")
    placed = assign_ids(sized, ["chunk_id"]).select(
        F.col("chunk_id").alias("id"), shard.alias("shard"), "bytes"
    )
    running = Window.partitionBy("shard").orderBy("id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return placed.withColumn(
        "batch", F.floor((F.sum("bytes").over(running) - 1) / limit).cast("long")
    )
