"""The checked queries: every operator over the whole given tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pergamon import fixed_values as V
from pergamon import schemas
from pergamon.functions import paths as P
from pergamon.functions import text as X
from pergamon.operators import (
    chat, chunking, codes, content, indexing, lists, quality, search, sketches, snapshots, tracking,
)
from pergamon.plans import answer, lifecycle
from pergamon.session import scratch_path
from pergamon.sources import files as files_source
from pergamon.sources import requests
from pergamon.sources import tables as S
from pergamon.sources import views as W
from pergamon.streaming import arrivals

QUERIES = {}
FLAT = "dbfs:/Volumes/alt_des/brz_rag/rag_data_flat"


def query(function):
    QUERIES[function.__name__] = function
    return function


def big(column, name=None):
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("bigint").alias(name) if name else column.cast("bigint")


def _tables(spark):
    """Fresh document tables below the shared folder."""
    folder = scratch_path(spark, "tables")
    name = "run_" + folder[-32:]
    tables = S.table_names("docs", S.create_database(spark, name, folder))
    S.create_tables(spark, tables, buckets=8)
    return tables


# --- scans, sources, sinks, schema


# Folders that the files of documents are dealt to; Spark lists more than 32 in tasks.
_FOLDERS = 256


def _written_documents(spark, sf_dir):
    """A folder with one text file for each document."""
    folder = scratch_path(spark, "documents")
    documents = W.table(spark, sf_dir, "documents")
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(_FOLDERS)).cast("string")
    stem = F.concat(dealt, F.lit("/doc_id="), F.col("doc_id").cast("string"))
    files_source.write_text_files(W.spread(documents, documents, "doc_id").select(stem.alias("stem"), "text"), folder)
    return folder


@query
def list_files(spark, sf_dir):
    """The documents as files: which there are, and how long each is."""
    return files_source.list_files(spark, _written_documents(spark, sf_dir)).where(
        P.extension("path") == ".txt"
    ).select(
        F.regexp_extract("path", r"doc_id=(\d+)", 1).cast("bigint").alias("doc_id"), "length"
    )


@query
def read_text_files(spark, sf_dir):
    """The documents written as one text file each, then read back."""
    folder = _written_documents(spark, sf_dir)
    read = files_source.read_text_files(spark, folder)
    return read.select(
        F.regexp_extract("path", r"doc_id=(\d+)", 1).cast("bigint").alias("doc_id"),
        F.md5(F.col("extracted_text").cast("binary")).alias("digest"),
        big(F.length("extracted_text"), "n_chars"),
    )


def _contents(spark, sf_dir):
    documents = W.table(spark, sf_dir, "documents")
    return W.file_contents(W.as_files(W.spread(documents, documents, "doc_id")))


@query
def extract_docx_text(spark, sf_dir):
    return files_source.extract_docx_text(_contents(spark, sf_dir))


@query
def extract_text(spark, sf_dir):
    return files_source.extract_text(_contents(spark, sf_dir))


@query
def scan_table(spark, sf_dir):
    W.table(spark, sf_dir, "documents").createOrReplaceTempView("documents_view")
    return spark.table("documents_view")


@query
def create_tables(spark, sf_dir):
    """Create the tables, fill three of them, count their rows."""
    tables = _tables(spark)
    S.create_tables(spark, tables)  # a second time: IF NOT EXISTS
    S.write_append(spark, W.texts(spark, sf_dir), tables.text)
    S.write_append(spark, W.track(spark, sf_dir), tables.track)
    S.write_append(spark, W.chunks(spark, sf_dir), tables.chunks)
    return tracking.work_gate(
        **{role: S.scan_table(spark, getattr(tables, role)) for role in S.SCHEMAS}
    )


@query
def write_overwrite_if_empty(spark, sf_dir):
    """The first write goes into the empty table, the second one must not."""
    tables = _tables(spark)
    S.write_overwrite_if_empty(spark, W.texts(spark, sf_dir), tables.text)
    S.write_overwrite_if_empty(spark, W.texts(spark, sf_dir).where("id < 0"), tables.text)
    return S.scan_table(spark, tables.text)


@query
def write_append(spark, sf_dir):
    tables = _tables(spark)
    known = W.track(spark, sf_dir)
    S.write_append(spark, known.where("document_type = 'core'"), tables.track)
    S.write_append(spark, known.where("document_type = 'tmp'"), tables.track)
    return S.scan_table(spark, tables.track)


@query
def assign_ids(spark, sf_dir):
    order = ["folder_name", "file_name", "chunk_location_in_doc"]
    rows = W.chunks(spark, sf_dir).select(*order)
    return S.assign_ids(rows, order, start=1000).select(
        "id", "folder_name", "file_name", big("chunk_location_in_doc", "chunk_location_in_doc")
    )


@query
def describe_schema(spark, sf_dir):
    """Columns and types of the index over the chunks, and how many values each column has."""
    chunks = W.chunks(spark, sf_dir)
    filled = chunks.select(*[F.count(c).alias(c) for c in chunks.columns])
    counts = filled.unpivot([], chunks.columns, "col_name", "n_values")
    return S.describe_index_schema(chunks).join(counts, "col_name", "left")


@query
def flatten_manifest(spark, sf_dir):
    return tracking.flatten_manifest(W.volume(spark, sf_dir), FLAT)


@query
def preview_limit(spark, sf_dir):
    return S.preview_limit(W.chunks(spark, sf_dir).select("id", "file_name", "text_chunk"), 5)


# --- names and paths


@query
def path_base_name(spark, sf_dir):
    return W.paths(spark, sf_dir).select("path", P.base_name("path").alias("file_name"))


@query
def path_dir_name(spark, sf_dir):
    return W.paths(spark, sf_dir).select("path", P.dir_name("path").alias("folder_name"))


@query
def path_concat(spark, sf_dir):
    return W.files(spark, sf_dir).select("doc_id", P.join_path().alias("path"))


@query
def path_scheme(spark, sf_dir):
    return W.paths(spark, sf_dir).select(
        "path", P.add_scheme("path").alias("with_scheme"),
        P.strip_scheme("path").alias("without_scheme"),
    )


@query
def path_extension(spark, sf_dir):
    return W.paths(spark, sf_dir).select(
        "path", P.extension("path").alias("extension"), P.is_supported("path").alias("supported")
    )


@query
def path_trim(spark, sf_dir):
    return W.paths(spark, sf_dir).select("path", P.trim_path("path").alias("trimmed"))


@query
def route_by_type(spark, sf_dir):
    return W.files(spark, sf_dir).select(
        "doc_id", P.volume_folder("document_type", F.lit("rag_data")).alias("folder")
    )


@query
def name_rules(spark, sf_dir):
    return quality.name_rules(W.names(spark, sf_dir))


@query
def flatten_struct(spark, sf_dir):
    nested = W.chunks(spark, sf_dir).select(
        "folder_name", "file_name", "document_type",
        F.struct(
            F.col("text_chunk").alias("chunk"),
            big("chunk_length_in_chars", "chunk_length_in_chars"),
            big("chunk_location_in_doc", "chunk_location_in_doc"),
            big("total_chunks_in_doc", "total_chunks_in_doc"),
        ).alias("c"),
    )
    return chunking.flatten_struct(nested)


@query
def answer_from_html(spark, sf_dir):
    return W.html_texts(spark, sf_dir).select(
        "kind", "key", "turn", X.answer_from_html("html").alias("answer")
    )


@query
def has_html_tags(spark, sf_dir):
    return W.html_texts(spark, sf_dir).select(
        "kind", "key", "turn", X.has_html_tags("html").alias("has_tags")
    )


@query
def format_answer_html(spark, sf_dir):
    return W.files(spark, sf_dir).select(
        "doc_id",
        X.format_answer("extracted_text", F.array("file_name", "folder_name")).alias("response"),
    )


# --- filters, semi-joins and state


@query
def processed_paths(spark, sf_dir):
    return tracking.processed_paths(W.track(spark, sf_dir))


def _arrived_paths(spark, sf_dir):
    return W.arrivals(spark, sf_dir).select(P.join_path().alias("path"))


def _gone(spark, sf_dir):
    return tracking.deleted_files(W.track(spark, sf_dir), W.volume(spark, sf_dir))


@query
def chunks_for_files(spark, sf_dir):
    return tracking.chunks_for_files(
        W.chunks(spark, sf_dir), _arrived_paths(spark, sf_dir)
    ).select("id", "file_name", "text_chunk")


@query
def remaining_after_delete(spark, sf_dir):
    return tracking.remaining_after_delete(
        W.chunks(spark, sf_dir), _arrived_paths(spark, sf_dir)
    ).select("id", "file_name")


@query
def insert_if_absent(spark, sf_dir):
    return tracking.insert_if_absent(W.track(spark, sf_dir), W.files(spark, sf_dir), V.UPDATING)


@query
def update_status_in(spark, sf_dir):
    return tracking.update_status_in(W.track(spark, sf_dir), W.arrivals(spark, sf_dir))


@query
def update_status_tuple(spark, sf_dir):
    return tracking.update_status_tuple(W.track(spark, sf_dir), W.arrivals(spark, sf_dir))


@query
def deleted_chunk_ids(spark, sf_dir):
    return tracking.deleted_chunk_ids(W.chunks(spark, sf_dir), _gone(spark, sf_dir))


@query
def delete_by_file(spark, sf_dir):
    return tracking.delete_by_file(W.texts(spark, sf_dir), _gone(spark, sf_dir))


@query
def delete_by_path(spark, sf_dir):
    return tracking.delete_by_file(W.texts(spark, sf_dir), _gone(spark, sf_dir), by_path=True)


@query
def index_upsert(spark, sf_dir):
    """Documents are indexed; the English ones come again as tmp, and the pages are new."""
    columns = ["id", "file_name", "document_type", "text_chunk"]
    chunks = W.chunks(spark, sf_dir)
    is_page = F.col("folder_name").endswith("/pages")
    arrived = W.arrivals(spark, sf_dir).select("folder_name", "file_name")
    again = chunks.join(arrived, ["folder_name", "file_name"], "left_semi")
    source = again.unionByName(chunks.where(is_page)).withColumn("document_type", F.lit("tmp"))
    return indexing.index_upsert(chunks.where(~is_page).select(*columns), source.select(*columns))


@query
def index_delete(spark, sf_dir):
    chunks = W.chunks(spark, sf_dir).select("id", "file_name")
    return indexing.index_delete(chunks, tracking.deleted_chunk_ids(chunks, _gone(spark, sf_dir)))


@query
def retrieve_columns(spark, sf_dir):
    found = search.retrieve_columns(W.event_hits(spark, sf_dir), W.chunks(spark, sf_dir))
    return found.select(
        "query_id", "id", "score", "text_chunk", "file_name", "folder_name",
        big("chunk_location_in_doc", "chunk_location_in_doc"),
        big("total_chunks_in_doc", "total_chunks_in_doc"), "document_type",
    )


@query
def selected_documents_filter(spark, sf_dir):
    return search.selected_documents_filter(
        W.vector_queries(spark, sf_dir), W.vectors(spark, sf_dir)
    )


@query
def new_files(spark, sf_dir):
    return tracking.new_files(W.volume(spark, sf_dir), W.track(spark, sf_dir))


@query
def deleted_files(spark, sf_dir):
    return _gone(spark, sf_dir)


# --- aggregates


@query
def processed_file_names(spark, sf_dir):
    return tracking.processed_file_names(W.track(spark, sf_dir))


@query
def work_gate(spark, sf_dir):
    track, volume = W.track(spark, sf_dir), W.volume(spark, sf_dir)
    return tracking.work_gate(
        volume=volume, processed=tracking.processed_paths(track),
        new=tracking.new_files(volume, track), deleted=tracking.deleted_files(track, volume),
    )


@query
def latest_version(spark, sf_dir):
    versions = W.table(spark, sf_dir, "documents").select(
        F.col("source").alias("name"), (F.col("doc_id") % 12).cast("string").alias("version")
    )
    return quality.latest_version(versions).select(
        "name", big("latest_version", "latest_version")
    )


@query
def chunk_doc_stats(spark, sf_dir):
    stats = chunking.chunk_doc_stats(W.chunks(spark, sf_dir))
    return stats.select(
        "folder_name", "file_name", "n_chunks", big("total_chars", "total_chars"),
        big("max_chars", "max_chars"), big("min_chars", "min_chars"),
        F.round("avg_chars", 6).alias("avg_chars"), "is_complete",
    )


@query
def query_log(spark, sf_dir):
    log = quality.query_log(W.requests(spark, sf_dir))
    return log.select(*[
        big(c, c) if log.schema[c].dataType.simpleString() == "int" else c for c in log.columns
    ])


@query
def query_log_summary(spark, sf_dir):
    return quality.query_log_summary(quality.query_log(W.requests(spark, sf_dir))).withColumn(
        "avg_time", F.round("avg_time", 6)
    )


@query
def query_log_quantiles(spark, sf_dir):
    """Quantiles of the times of each method, merged from stored sketches by method and batch size, and whether
    their ranks are within the stated error."""
    log, method = quality.query_log(W.requests(spark, sf_dir)), ["retrieval_method"]
    folder = scratch_path(spark, "sketches")
    sketches.time_sketches(log, [*method, "batch_size"]).write.parquet(folder)
    found = sketches.merged_quantiles(spark.read.parquet(folder), method)
    return sketches.rank_errors(log, found, method).select(
        *method, "quantile", "n", (F.col("rank_error") <= sketches.RANK_ERROR).alias("is_close"))


# --- vector search


def _scored(hits):
    return hits.select("query_id", "id", big("rank", "rank"), F.round("score", 6).alias("score"))


@query
def vector_topk(spark, sf_dir):
    return _scored(search.vector_topk(W.vectors(spark, sf_dir), W.vector_queries(spark, sf_dir)))


@query
def vector_topk_l2(spark, sf_dir):
    return _scored(search.vector_topk(
        W.vectors(spark, sf_dir), W.vector_queries(spark, sf_dir), metric="squared_l2"
    ))


@query
def vector_topk_filtered(spark, sf_dir):
    return _scored(
        search.vector_topk_filtered(W.vectors(spark, sf_dir), W.vector_queries(spark, sf_dir))
    )


@query
def vector_topk_ann(spark, sf_dir):
    return _scored(
        search.vector_topk_ann(
            W.vectors(spark, sf_dir), W.vector_queries(spark, sf_dir), dimension=W.DIMENSION
        )
    )


@query
def vector_topk_l2_filtered(spark, sf_dir):
    return _scored(search.vector_topk_filtered(
        W.vectors(spark, sf_dir), W.vector_queries(spark, sf_dir), metric="squared_l2"
    ))


# The form for many queries, over blocks small enough for several of them.
_BLOCKS = {"max_queries": 0, "block_rows": 700, "block_queries": 300}


@query
def vector_topk_blocks(spark, sf_dir):
    return _scored(search.vector_topk(
        W.vectors(spark, sf_dir), W.vector_queries(spark, sf_dir), **_BLOCKS
    ))


@query
def vector_topk_l2_blocks(spark, sf_dir):
    return _scored(search.vector_topk(
        W.vectors(spark, sf_dir), W.vector_queries(spark, sf_dir), metric="squared_l2", **_BLOCKS
    ))


@query
def vector_topk_filtered_blocks(spark, sf_dir):
    return _scored(search.vector_topk_filtered(
        W.vectors(spark, sf_dir), W.vector_queries(spark, sf_dir), **_BLOCKS
    ))


@query
def vector_topk_ann_blocks(spark, sf_dir):
    return _scored(search.vector_topk_ann(
        W.vectors(spark, sf_dir), W.vector_queries(spark, sf_dir), dimension=W.DIMENSION, **_BLOCKS
    ))


# Lists around vectors of the table itself, so that SQL knows the centroids too.
_LISTS = {"lists": 16, "rounds": 0, "probes": 5}


def _listed(spark, sf_dir, **settings):
    rows = W.vectors(spark, sf_dir).drop("label")
    return lists.build_lists(W.spread(rows, rows, "id"), **settings)


@query
def vector_topk_lists(spark, sf_dir):
    """The best of the five nearest of 16 lists."""
    listed = _listed(spark, sf_dir, **_LISTS)
    hits = lists.vector_topk_lists(spark, listed, W.vector_queries(spark, sf_dir))
    return _scored(hits)


@query
def vector_topk_lists_filtered(spark, sf_dir):
    listed = _listed(spark, sf_dir, **_LISTS)
    return _scored(lists.vector_topk_lists(
        spark, listed, W.vector_queries(spark, sf_dir), filtered=True))


@query
def vector_topk_lists_blocks(spark, sf_dir):
    listed = _listed(spark, sf_dir, **_LISTS)
    return _scored(lists.vector_topk_lists(spark, listed, W.vector_queries(spark, sf_dir), **_BLOCKS))


@query
def vector_topk_codes(spark, sf_dir):
    """The exact search from stored codes and the vectors of few rows."""
    rows = W.vectors(spark, sf_dir)
    folder = scratch_path(spark, "codes")
    codes.vector_codes(W.spread(rows, rows, "id")).write.parquet(folder)
    return _scored(codes.vector_topk_codes(spark.read.parquet(folder), rows, W.vector_queries(spark, sf_dir)))


@query
def lists_recall(spark, sf_dir):
    """Trained lists with measured probes: whether they find nine of ten of the true neighbours."""
    listed = _listed(spark, sf_dir)
    asked = W.vector_queries(spark, sf_dir)
    exact = search.vector_topk(W.vectors(spark, sf_dir), asked).select("query_id", "id")
    found = lists.vector_topk_lists(spark, listed, asked).select("query_id", "id", F.lit(1).alias("found"))
    share = F.sum(F.coalesce("found", F.lit(0))) / F.count("*")
    return exact.join(found, ["query_id", "id"], "left").agg(
        F.countDistinct("query_id").alias("n_queries"), F.count("*").alias("n_neighbours"),
        (share >= lists.RECALL).alias("reached"))


@query
def upsert_batches(spark, sf_dir):
    """Requests over the chunks in the order of their stored ids."""
    return indexing.upsert_batches(W.chunks(spark, sf_dir))


@query
def send_upserts(spark, sf_dir):
    """What a client got that keeps its requests by name: every chunk once, in requests within the limit."""
    folder = scratch_path(spark, "requests")
    rows = W.chunks(spark, sf_dir)
    requests.send_upserts(spark, rows, requests.PackedClient(folder))
    got = spark.read.schema(T.StructType(rows.schema.fields).add("request", "string")).parquet(f"{folder}/upsert")
    of = Window.partitionBy("request")
    size = F.sum(F.coalesce(F.octet_length("text_chunk"), F.lit(0))).over(of)
    within = (size <= V.BATCH_BYTES) | (F.count("*").over(of) == 1)
    numbers = ("chunk_location_in_doc", "total_chunks_in_doc", "chunk_length_in_chars")
    return got.withColumn("within_limit", within).drop("request").withColumns({c: big(c) for c in numbers})


@query
def send_deletes(spark, sf_dir):
    """The ids that a client gets when the chunks of files that are gone leave the index."""
    folder = scratch_path(spark, "requests")
    gone = tracking.deleted_chunk_ids(W.chunks(spark, sf_dir), _gone(spark, sf_dir))
    requests.send_deletes(spark, gone, requests.FolderClient(folder))
    return spark.read.schema("id long").parquet(f"{folder}/delete")


# --- chunks and embeddings


@query
def chunk_window(spark, sf_dir):
    return W.chunks(spark, sf_dir).select(
        "id", "file_name", "folder_name", "document_type", "text_chunk",
        *[big(c, c) for c in ("chunk_location_in_doc", "total_chunks_in_doc",
                              "chunk_length_in_chars")],
    )


def _recursive(spark, sf_dir):
    return chunking.chunk_recursive(W.spread_texts(spark, sf_dir))


@query
def chunk_recursive(spark, sf_dir):
    return chunking.with_chunk_ids(_recursive(spark, sf_dir))


@query
def chunk_recursive_contract(spark, sf_dir):
    """Per document: chunks are 1 to 1000 characters, without outer spaces, numbered 0 to n-1.

    Against the text: each chunk stands in it, together they hold all its characters but white
    space, and no more than 200 characters a chunk are there twice.
    """
    solid = lambda c: F.length(F.regexp_replace(c, r"\s", ""))
    texts = W.texts(spark, sf_dir).select("id", F.col("extracted_text").alias("_text"))
    chunks = _recursive(spark, sf_dir).join(texts, "id")
    held, whole = F.sum(solid("text_chunk")), F.max(solid("_text"))
    return chunks.groupBy("id").agg(
        F.min(F.contains("_text", "text_chunk")).alias("is_in_text"),
        (held >= whole).alias("is_covered"),
        (held - whole <= 200 * (F.count("*") - 1)).alias("overlap_holds"),
        F.min(F.col("chunk_length_in_chars").between(1, 1000)).alias("sizes_hold"),
        F.min(~F.col("text_chunk").rlike(r"^\s|\s$")).alias("is_stripped"),
        (
            (F.max("total_chunks_in_doc") == F.count("*"))
            & (F.max("chunk_location_in_doc") == F.count("*") - 1)
            & (F.countDistinct("chunk_location_in_doc") == F.count("*"))
        ).alias("is_complete"),
    )


@query
def embed_text(spark, sf_dir):
    """The values of the embeddings that are not zero."""
    values = W.index(spark, sf_dir).select("id", F.posexplode("chunk_embedding"))
    return values.where("col > 0").select(
        "id", big("pos", "bucket"), F.round(F.col("col").cast("double"), 6).alias("value")
    )


@query
def embed_once(spark, sf_dir):
    """Rows and distinct texts of two runs over one store: half the chunks, then all; how many texts each embedded."""
    folder, chunks = scratch_path(spark, "embeddings"), W.chunks(spark, sf_dir)
    early = chunks.where(F.col("chunk_location_in_doc") == 0)
    content.embed_once(early, folder, dimension=W.DIMENSION)
    first = spark.read.parquet(folder).count()
    rows = content.embed_once(chunks, folder, dimension=W.DIMENSION)
    values = rows.select("id", F.explode(F.filter("chunk_embedding", lambda v: v > 0)).alias("v"))
    counts = [("rows", rows), ("stored", spark.read.parquet(folder)), ("filled", values),
              ("filled rows", values.select("id").distinct())]
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("counted"), "n") for name, df in counts]
    parts.append(spark.createDataFrame([("first run", first)], "counted string, n long"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def build_index(spark, sf_dir):
    """The index table after two runs over the chunk table."""
    tables = _tables(spark)
    S.write_append(spark, W.chunks(spark, sf_dir), tables.chunks)
    lifecycle.build_index(spark, tables, dimension=W.DIMENSION)
    lifecycle.build_index(spark, tables, dimension=W.DIMENSION)
    filled = F.size(F.filter("chunk_embedding", lambda v: v > 0))
    return S.scan_table(spark, tables.index).select(
        "id", "file_name", "folder_name", big(filled, "n_filled")
    )


# --- conversations and answers


@query
def build(spark, sf_dir):
    """All four tables filled from the texts; a second build must change nothing."""
    tables = _tables(spark)
    texts = W.texts(spark, sf_dir).select(
        *tracking.FILE_KEY, "extracted_text", F.lit(None).cast("string").alias("error")
    )
    for _ in range(2):
        lifecycle.build(
            spark, tables, texts, chunk=chunking.chunk_window, dimension=W.DIMENSION
        )
    key = ["folder_name", "file_name"]
    indexed = S.scan_table(spark, tables.index).groupBy(*key).agg(F.count("*").alias("n_indexed"))
    return S.scan_table(spark, tables.track).join(indexed, key, "left").select(
        *tracking.FILE_KEY, "status", F.coalesce("n_indexed", F.lit(0)).alias("n_indexed")
    )


@query
def last_user_query(spark, sf_dir):
    return chat.last_user_query(W.table(spark, sf_dir, "conversations"))


@query
def format_history(spark, sf_dir):
    return chat.format_history(W.table(spark, sf_dir, "conversations"))


@query
def needs_rewrite(spark, sf_dir):
    return chat.needs_rewrite(W.table(spark, sf_dir, "conversations"))


def _benchmark_questions(spark, sf_dir):
    return W.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question")
    )


def _benchmark_hits(spark, sf_dir):
    asked = _benchmark_questions(spark, sf_dir).withColumnRenamed("question", "search_text")
    return answer.retrieve(W.index(spark, sf_dir), asked, dimension=W.DIMENSION)


@query
def build_context(spark, sf_dir):
    return chat.build_context(
        _benchmark_questions(spark, sf_dir), _benchmark_hits(spark, sf_dir)
    )


@query
def dedupe_sources(spark, sf_dir):
    found = chat.dedupe_sources(
        _benchmark_questions(spark, sf_dir), _benchmark_hits(spark, sf_dir)
    )
    return found.select("query_id", F.array_join("sources", "|").alias("sources"))


def _conversation_answers(spark, sf_dir):
    messages = W.table(spark, sf_dir, "conversations")
    return answer.rag_batch(
        W.index(spark, sf_dir), answer.conversation_questions(messages), dimension=W.DIMENSION
    )


@query
def answer_prompt(spark, sf_dir):
    contexts = _conversation_answers(spark, sf_dir).select(
        F.col("query_id").alias("conv_id"), "context"
    )
    history = chat.format_history(W.table(spark, sf_dir, "conversations"))
    return chat.answer_prompt(contexts, history)


@query
def rewrite_prompt(spark, sf_dir):
    return chat.rewrite_prompt(W.table(spark, sf_dir, "conversations"))


@query
def rag_batch(spark, sf_dir):
    return _conversation_answers(spark, sf_dir).select(
        "query_id", "question", "needs_rewrite", "context",
        F.array_join("sources", "|").alias("sources"), big("n_retrieved", "n_retrieved"),
        "answer", "response",
    )


@query
def rag_batch_lists(spark, sf_dir):
    """As `rag_batch`, over an index in lists, all of which are read, so that the answers are the same."""
    index = lists.build_lists(W.index(spark, sf_dir), rounds=2, probes=1 << 30)
    asked = answer.conversation_questions(W.table(spark, sf_dir, "conversations"))
    return answer.rag_batch(index, asked, dimension=W.DIMENSION).select(
        "query_id", "question", "needs_rewrite", "context",
        F.array_join("sources", "|").alias("sources"), big("n_retrieved", "n_retrieved"),
        "answer", "response",
    )


@query
def rag_batch_history(spark, sf_dir):
    """Follow-up questions rewritten from their history; the answer shows what the model was given."""
    asked = answer.conversation_requests(W.table(spark, sf_dir, "conversations"))
    answered = answer.rag_batch(
        W.index(spark, sf_dir), asked, dimension=W.DIMENSION, rewrite=chat.follow_up,
        answer=chat.messages_digest,
    )
    return answered.select(
        "query_id", "question", "needs_rewrite", "search_text", "context",
        F.array_join("sources", "|").alias("sources"), "answer", "response",
    )


@query
def evaluate_batch(spark, sf_dir):
    """The answers to the question set, saved and read back."""
    saved = scratch_path(spark, "evaluation")
    answer.evaluate_batch(
        W.index(spark, sf_dir), _benchmark_questions(spark, sf_dir), dimension=W.DIMENSION
    ).write.parquet(saved)
    return spark.read.parquet(saved)


@query
def flat_copies_to_drop(spark, sf_dir):
    """Copies in the flat folder that go with the deleted files."""
    return lifecycle.flat_copies_to_drop(_gone(spark, sf_dir), W.volume(spark, sf_dir), FLAT)


# --- contract checks


@query
def check_embedding_size(spark, sf_dir):
    """Given embeddings against the size they have and against the declared size."""
    vectors = W.vectors(spark, sf_dir)
    return (
        quality.check_embedding_size(vectors, 64).withColumn("dimension", big(F.lit(64)))
        .unionByName(
            quality.check_embedding_size(vectors).withColumn(
                "dimension", big(F.lit(V.EMBEDDING_DIMENSION))
            )
        )
    )


@query
def check_result_shape(spark, sf_dir):
    queries, vectors = W.vector_queries(spark, sf_dir), W.vectors(spark, sf_dir)
    return quality.check_result_shape(
        queries, search.vector_topk_filtered(vectors, queries),
        search.selected_documents_filter(queries, vectors),
    )


@query
def check_response_json(spark, sf_dir):
    checked = quality.check_response_json(
        W.chat_responses(spark, sf_dir), quality.CHAT_RESPONSE_KEYS,
        non_empty=["$.choices[0].message.content"],
    )
    return checked.withColumn("n_violations", big("n_violations"))


@query
def check_response_json_events(spark, sf_dir):
    """Logged properties that lack the key `k`, and all that lack a key none of them has."""
    events = W.table(spark, sf_dir, "events").select("event_id", "props")
    lacking = quality.check_response_json(events, ["$.k", "$.usage"], "props")
    return lacking.withColumn("n_violations", big("n_violations"))


# --- incremental


def _arriving_documents(spark, sf_dir):
    """The documents as a stream, whether the table is one file or a folder of files.

    A pattern, as Spark takes a plain path of a stream for a folder.
    """
    schema = W.table(spark, sf_dir, "documents").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")


@query
def stream_index_update(spark, sf_dir):
    """All documents arrive as a stream of files; the track table afterwards."""
    tables = _tables(spark)
    stream = _arriving_documents(spark, sf_dir)
    kind = F.when(F.col("folder_name").contains("/core_files/"), F.lit("core")).otherwise(
        F.lit("tmp")
    )
    arrivals.stream_index_update(
        W.file_contents(W.as_files(stream)), tables, scratch_path(spark, "stream"),
        document_type=kind, once=True, dimension=W.DIMENSION,
    ).awaitTermination()
    return S.scan_table(spark, tables.track)


@query
def stream_new_files(spark, sf_dir):
    sink = scratch_path(spark, "new-files")
    stream = _arriving_documents(spark, sf_dir)
    arrivals.stream_new_files(
        W.as_files(stream).select(P.join_path().alias("path")),
        lambda session: W.track(session, sf_dir), sink, scratch_path(spark, "stream"), once=True,
    ).awaitTermination()
    return spark.read.schema(schemas.PATHS).parquet(f"{sink}/*")


@query
def snapshot_diff(spark, sf_dir):
    """The track table before and after new files came, states changed and files went."""
    old = W.track(spark, sf_dir)
    inserted = tracking.insert_if_absent(old, W.files(spark, sf_dir), V.UPDATING)
    changed = tracking.update_status_tuple(old.unionByName(inserted), W.arrivals(spark, sf_dir))
    new = tracking.delete_by_file(changed, _gone(spark, sf_dir), by_path=True)
    return snapshots.snapshot_diff(old, new, tracking.FILE_KEY)


@query
def purge_deleted(spark, sf_dir):
    return lifecycle.purge_summary(
        W.track(spark, sf_dir), W.texts(spark, sf_dir), W.chunks(spark, sf_dir),
        W.volume(spark, sf_dir),
    )


@query
def purge_tables(spark, sf_dir):
    """The purge job on filled tables: what is left in the chunk table."""
    tables = _tables(spark)
    S.write_append(spark, W.texts(spark, sf_dir), tables.text)
    S.write_append(spark, W.track(spark, sf_dir), tables.track)
    S.write_append(spark, W.chunks(spark, sf_dir), tables.chunks)
    lifecycle.purge_deleted(spark, tables, W.volume(spark, sf_dir))
    return S.scan_table(spark, tables.chunks).select("id", "file_name", "folder_name")


def _filled(spark, sf_dir):
    """All four tables, filled from the given files and pages: chunks from the stored texts, the index from the stored chunks."""
    tables = _tables(spark)
    S.write_append(spark, W.texts(spark, sf_dir), tables.text)
    S.write_append(spark, W.track(spark, sf_dir), tables.track)
    chunks = chunking.with_chunk_ids(chunking.chunk_window(S.scan_table(spark, tables.text)))
    S.write_append(spark, chunks, tables.chunks, made_of=tables.text)
    lifecycle.build_index(spark, tables, dimension=W.DIMENSION)
    return tables


def _files_left(spark, tables):
    """Rows of each file in each table."""
    parts = [S.scan_table(spark, getattr(tables, role)).groupBy("folder_name", "file_name").agg(
        F.count("*").alias("n_rows")).withColumn("table_name", F.lit(role)) for role in S.SCHEMAS]
    left = parts[0]
    for part in parts[1:]:
        left = left.unionByName(part)
    return left


@query
def purge_all_tables(spark, sf_dir):
    """The purge job on all four tables, by deletions alone: what is left of each file."""
    tables = _filled(spark, sf_dir)
    lifecycle.purge_deleted(spark, tables, W.volume(spark, sf_dir), share=2.0)
    return _files_left(spark, tables)


@query
def purge_and_compact(spark, sf_dir):
    """As `purge_all_tables`, then every touched bucket is rewritten, and the English files come again."""
    tables = _filled(spark, sf_dir)
    lifecycle.purge_deleted(spark, tables, W.volume(spark, sf_dir), share=0.0)
    arrived = W.arrivals(spark, sf_dir)
    S.delete_rows(spark, tables.text, arrived)
    S.write_append(spark, arrived.select(
        (F.col("doc_id") * 2).alias("id"), "file_name", "folder_name", "document_type", "extracted_text"), tables.text)
    return _files_left(spark, tables)


@query
def deleted_shares(spark, sf_dir):
    """How many rows of the chunk table are deleted, before they are compacted."""
    tables = _filled(spark, sf_dir)
    lifecycle.purge_deleted(spark, tables, W.volume(spark, sf_dir), share=2.0)
    shares = S.deleted_shares(spark, tables.chunks)
    return shares.agg(F.sum("n_deleted").alias("n_deleted"))


@query
def stream_update_tables(spark, sf_dir):
    """Documents arrive in three batches by their number, the last one has the first one's files again; all four tables.

    Each batch is a stream run of its own over the same tables, as a trigger on file arrival makes it.
    """
    tables = _tables(spark)
    documents = W.table(spark, sf_dir, "documents")
    kind = F.when(F.col("folder_name").contains("/core_files/"), F.lit("core")).otherwise(F.lit("tmp"))
    folder = scratch_path(spark, "arriving")
    for turn in range(3):
        part = documents.where(F.col("doc_id") % 2 == turn % 2)
        part.write.mode("append").parquet(f"{folder}/{turn}")
        stream = spark.readStream.schema(documents.schema).option("recursiveFileLookup", "true").parquet(folder)
        arrivals.stream_index_update(
            W.file_contents(W.as_files(stream)), tables, f"{folder}-state", document_type=kind, once=True,
            chunk=chunking.chunk_window, dimension=W.DIMENSION,
        ).awaitTermination()
    return _files_left(spark, tables)
