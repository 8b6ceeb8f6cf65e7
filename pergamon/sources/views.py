"""Views with the shapes of the document tables over the given tables."""

import io
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from pergamon.functions.paths import extension, join_path
from pergamon.operators.chunking import chunk_window, with_chunk_ids
from pergamon.operators.indexing import embed_text

VOLUME = "dbfs:/Volumes/alt_des/brz_rag/rag_data"
DIMENSION = 64  # of the checked queries: the size of the given embeddings


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_files(documents):
    """Documents as files in two folder trees; some base names occur in both."""
    half = F.floor(F.col("doc_id") / 2).cast("bigint")
    stem = F.when(F.col("doc_id") % 10 < 2, F.concat(F.lit("shared_"), half.cast("string")))
    suffixes = F.array(*[F.lit(s) for s in (".txt", ".md", ".PDF", ".docx", ".py")])
    core = F.col("doc_id") % 2 == 0
    return documents.select(
        "doc_id",
        F.concat(
            stem.otherwise(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))),
            F.element_at(suffixes, (half % 5 + 1).cast("int")),
        ).alias("file_name"),
        F.when(core, F.concat(F.lit(f"{VOLUME}/core_files/"), F.col("source")))
        .otherwise(F.lit(f"{VOLUME}/user_files/temporary_files")).alias("folder_name"),
        F.when(core, F.lit("core")).otherwise(F.lit("tmp")).alias("document_type"),
        F.col("text").alias("extracted_text"),
        "lang",
    )


def files(spark, sf_dir):
    return as_files(table(spark, sf_dir, "documents"))


def gone_files(spark, sf_dir):
    """Pages as files that were indexed and are no longer on the volume."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(F.lit("shared_"), F.col("page_id").cast("string"), F.lit(".txt"))
        .alias("file_name"),
        F.lit(f"{VOLUME}/core_files/pages").alias("folder_name"),
        F.lit("core").alias("document_type"),
        F.col("html").alias("extracted_text"),
    )


def track(spark, sf_dir):
    """Labelled documents in four states by their labels, and the files that are gone."""
    status = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit("READY"))
        .when(F.col("quality") == 1, F.lit("UPDATED"))
        .when(F.col("toxic") == 0, F.lit("UPDATING"))
        .otherwise(F.lit("FAILED"))
    )
    known = (
        files(spark, sf_dir)
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select("file_name", "folder_name", "document_type", status.alias("status"))
    )
    return known.unionByName(
        gone_files(spark, sf_dir).select(
            "file_name", "folder_name", "document_type", F.lit("READY").alias("status")
        )
    )


def volume(spark, sf_dir):
    return files(spark, sf_dir).select(join_path().alias("path"))


def arrivals(spark, sf_dir):
    """The batch that has just been extracted: the English documents."""
    return files(spark, sf_dir).where(F.col("lang") == "en")


def texts(spark, sf_dir):
    """The text table: documents, and the pages that are gone."""
    columns = ["file_name", "folder_name", "document_type", "extracted_text"]
    return (
        files(spark, sf_dir).select((F.col("doc_id") * 2).alias("id"), *columns)
        .unionByName(
            gone_files(spark, sf_dir).select((F.col("page_id") * 2 + 1).alias("id"), *columns)
        )
    )


def chunks(spark, sf_dir):
    return with_chunk_ids(chunk_window(texts(spark, sf_dir))).select(
        "id", "file_name", "text_chunk", "folder_name", "document_type",
        "chunk_location_in_doc", "total_chunks_in_doc", "chunk_length_in_chars",
    )


def vectors(spark, sf_dir):
    """The given embeddings as an index: each vector belongs to the document of its label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("doc_"), F.col("label").cast("string")).alias("file_name"),
        F.col("embedding").alias("chunk_embedding"),
        "label",
    )


def vector_queries(spark, sf_dir):
    """Every given embedding as a query. Those of label 0 select no document, others two."""
    label = F.col("label")
    chosen = F.array(
        F.concat(F.lit("doc_"), label.cast("string")),
        F.concat(F.lit("doc_"), ((label + 1) % 10).cast("string")),
    )
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("query_id"),
        F.col("embedding").alias("query_vector"),
        F.when(label == 0, F.array().cast("array<string>")).otherwise(chosen)
        .alias("selected_documents"),
    )


def spread(rows, source, key):
    """Use all cores for rows of a source with few partitions; those of a large one stay put."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if source.rdd.getNumPartitions() >= 2 * cores:
        return rows
    return rows.repartition(cores, key)


def spread_texts(spark, sf_dir):
    return spread(texts(spark, sf_dir), table(spark, sf_dir, "documents"), "id")


def paths(spark, sf_dir):
    """Paths of the volume and the addresses of the pages."""
    return volume(spark, sf_dir).unionByName(
        table(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    )


def html_texts(spark, sf_dir):
    """Pages and chat turns, as they hold HTML and text without it."""
    return table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("key"),
        F.lit(0).cast("long").alias("turn"), "html",
    ).unionByName(
        table(spark, sf_dir, "conversations").select(
            F.lit("turn").alias("kind"), F.col("conv_id").alias("key"), "turn",
            F.col("text").alias("html"),
        )
    )


@arrow_udf(BinaryType())
def _pack_docx(texts: pa.Array) -> pa.Array:
    name = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    packed = []
    for text in texts:
        if not text.is_valid:
            packed.append(None)
            continue
        runs = "<w:br/>".join(
            f'<w:t xml:space="preserve">{escape(line)}</w:t>' for line in text.as_py().split("\n")
        )
        body = f"<w:body><w:p><w:r>{runs}</w:r></w:p></w:body>"
        target = io.BytesIO()
        with zipfile.ZipFile(target, "w") as parts:
            parts.writestr(
                "word/document.xml", f'<w:document xmlns:w="{name}">{body}</w:document>'
            )
        packed.append(target.getvalue())
    return pa.array(packed, pa.binary())


def file_contents(rows):
    """The bytes of files: Word packages for .docx, UTF-8 for all others (path, content)."""
    is_docx = extension("file_name") == ".docx"
    clean = F.regexp_replace("extracted_text", "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]", " ")
    return rows.select(
        join_path().alias("path"),
        F.coalesce(_pack_docx(F.when(is_docx, clean)), F.col("extracted_text").cast("binary"))
        .alias("content"),
    )


def index(spark, sf_dir):
    """The chunks of all texts with hashed embeddings."""
    return embed_text(with_chunk_ids(chunk_window(spread_texts(spark, sf_dir))).select(
        "id", "file_name", "text_chunk", "folder_name", "document_type",
        "chunk_location_in_doc", "total_chunks_in_doc", "chunk_length_in_chars",
    ), dimension=DIMENSION)


def event_hits(spark, sf_dir):
    """Events as hits: each event found the first chunk of the document its user stands for."""
    first_chunk = F.shiftleft(F.col("user_id") * 2, 22)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("query_id"), first_chunk.alias("id"),
        F.lit(1).alias("rank"), F.col("value").alias("score"),
    )


def requests(spark, sf_dir):
    """Events as logged chat requests."""
    number = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("query_id"),
        F.col("value").alias("query_execution_time"),
        F.col("event_type").alias("retrieval_method"),
        F.when(F.col("event_type") == "error", F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("doc_"), number.cast("string"))))
        .alias("selected_documents"),
        F.least(number, F.lit(5)).alias("num_retrieved_documents"),
        (F.lit(1) + number % 9).alias("batch_size"),
    )


def chat_responses(spark, sf_dir):
    """Chat turns as logged model responses; system turns come without content and usage."""
    system = F.col("role") == "system"
    content = F.when(~system, F.col("text"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        F.to_json(F.struct(
            F.array(F.struct(
                F.struct(content.alias("content"), F.col("role").alias("role")).alias("message"),
                F.struct(F.lit(False).alias("filtered")).alias("content_filter_results"),
            )).alias("choices"),
            F.lit("chat").alias("model"),
            F.when(~system, F.struct(F.length("text").alias("total_tokens"))).alias("usage"),
            F.lit("chat.completion").alias("object"),
        )).alias("response"),
    )


def names(spark, sf_dir):
    """Catalog and model names, some of which break the naming rules."""
    def pick(values, by):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (by + 1).cast("int"))

    number = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat_ws("_", pick(["alt", "zzz"], number % 2), "source",
                    pick(["des", "pre", "xxx"], number % 3)).alias("catalog"),
        pick(["des", "pre", "pro"], F.floor(number / 2) % 3).alias("environment"),
        F.concat_ws("_", "source", pick(["model", "bot"], number % 2)).alias("model"),
    )
