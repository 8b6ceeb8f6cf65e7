"""Embeddings kept by content, so that a model sees each distinct text once, over runs too."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pergamon import fixed_values as V
from pergamon.operators.indexing import embed_text
from pergamon.operators.skew import key_filter, keyed_join

CONTENT = "_content"


def content_key(text):
    """The SHA-256 of the text's UTF-8 as bytes; a null text counts as empty."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _kept(spark, folder, output):
    schema = f"{CONTENT} binary, {output} array<float>"
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as missing:  # the first run makes the folder
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def embed_once(rows, folder, text="text_chunk", embed=None, dimension=V.EMBEDDING_DIMENSION,
               output="chunk_embedding"):
    """Like `embed_text`, but texts whose embedding is kept in `folder` don't reach the model.

    `folder` (shared, one for each model and dimension) holds content key and embedding. New texts are made
    distinct, embedded and appended, which runs a job; then all rows take their embedding from the folder by a join, whose
    hot texts Spark splits. The anti-join that finds new texts reads keys only. A lost task embeds its own texts
    again; a run that stopped leaves embeddings that the next one uses. One writer at a time, as two could each
    append the same text. Null and empty texts are one text, and no rows start no model.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn(CONTENT, content_key(text))
    texts = keyed.select(CONTENT, F.coalesce(F.col(text), F.lit("")).alias("_text")).dropDuplicates([CONTENT])
    new = key_filter(texts, _kept(spark, folder, output), [CONTENT], keep=False)
    embedded = embed_text(new, "_text", embed, dimension, output).select(CONTENT, output)
    embedded.write.mode("append").parquet(folder)
    kept = _kept(spark, folder, output)
    return keyed_join(keyed, kept, [CONTENT], "inner").select(*rows.columns, output)
