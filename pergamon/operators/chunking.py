"""Splitting document text into overlapping chunks."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pergamon import fixed_values as V

# Chunk ids are the document id followed by this many bits of chunk number. A Spark string holds
# at most 2 GiB, so chunks that advance by 800 characters always fit; others are tested.
CHUNK_BITS = 22

# Texts whose chunks are Python strings at a time.
_SPLIT_ROWS = 128


def _explode_chunks(documents, chunks):
    """One row per element of the array column `chunks`, with the chunk columns.

    The outer form keeps Spark from inferring a filter that would build the array twice. The array is counted
    below, else each of its chunks has the whole array in its row until the count is taken.
    """
    kept = [c for c in documents.columns if c != chunks]
    return (
        documents.withColumn("total_chunks_in_doc", F.size(chunks))
        .select(*kept, "total_chunks_in_doc", F.posexplode_outer(chunks))
        .where("col IS NOT NULL")
        .select(
            *kept,
            F.col("col").alias("text_chunk"),
            F.col("pos").alias("chunk_location_in_doc"),
            "total_chunks_in_doc",
            F.length("col").alias("chunk_length_in_chars"),
        )
    )


def chunk_window(documents, size=V.CHUNK_SIZE, overlap=V.CHUNK_OVERLAP, text="extracted_text"):
    """Fixed windows, each `size - overlap` characters after the one before; no Python, no shuffle.

    The text is cut once into steps, and each window is put together from a step and the head of
    the steps after it. That is linear in the text, where `substring` would walk the text from
    its start again for every window. Empty and NULL texts give no rows.
    """
    step = size - overlap
    following = -(-overlap // step)
    kept = [c for c in documents.columns if c != text]
    steps = (
        documents.where(F.length(text) > 0)
        .select(
            *kept,
            F.length(text).alias("_length"),
            F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0)).alias("_steps"),
        )
    )
    shifted = [
        F.slice("_steps", 2 + i, F.size("_steps")).alias(f"next{i}") for i in range(following)
    ]

    def window(s):
        head = F.concat(*[F.coalesce(s[f"next{i}"], F.lit("")) for i in range(following)])
        return F.concat(s["_steps"], F.substring(head, 1, overlap)) if following else s["_steps"]

    count = F.greatest(F.lit(1), F.ceil((F.col("_length") - overlap) / step).cast("int"))
    windows = F.transform(F.arrays_zip("_steps", *shifted), window)
    return _explode_chunks(
        steps.select(*kept, F.slice(windows, 1, count).alias("_chunks")), "_chunks"
    )


def _split_batch(texts, size, overlap):
    """Chunks of the texts of a batch; only some texts at a time have theirs as Python strings."""
    kind = pa.list_(pa.string())
    parts = [
        pa.array([split_at_separators(t.as_py() or "", size, overlap) for t in texts.slice(i, _SPLIT_ROWS)], kind)
        for i in range(0, len(texts), _SPLIT_ROWS)
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def chunk_recursive(documents, size=V.CHUNK_SIZE, overlap=V.CHUNK_OVERLAP, text="extracted_text"):
    """Chunks that end at blank lines, lines or words where they can; only text goes to Python."""

    @arrow_udf(T.ArrayType(T.StringType()))
    def split(texts: pa.Array) -> pa.Array:
        return _split_batch(texts, size, overlap)

    kept = [c for c in documents.columns if c != text]
    return _explode_chunks(
        documents.where(F.length(text) > 0).select(*kept, split(F.col(text)).alias("_chunks")),
        "_chunks",
    )


def split_at_separators(text, size=V.CHUNK_SIZE, overlap=V.CHUNK_OVERLAP,
                        separators=("\n\n", "\n", " ")):
    """Chunks of one text. Works on offsets; every level reads only what is still too long."""
    chunks = []

    def emit(start, end):
        chunk = text[start:end].strip()
        if chunk:
            chunks.append(chunk)

    def merge(ends, start):
        """Pack consecutive pieces, given by their ends, into chunks that overlap."""
        piece_starts = [start] + ends[:-1]
        first = 0
        for i, end in enumerate(ends):
            if end - piece_starts[first] > size and i > first:
                emit(piece_starts[first], piece_starts[i])
                while first < i and (
                    piece_starts[i] - piece_starts[first] > overlap
                    or end - piece_starts[first] > size
                ):
                    first += 1
        emit(piece_starts[first], ends[-1])

    def windows(start, end):
        """The empty separator: merging single characters is a fixed window."""
        step = size - overlap
        at = start
        while True:
            emit(at, min(at + size, end))
            if at + size >= end:
                return
            at += step

    def pieces(separator, start, end):
        """Ends of the pieces; each but the first starts with its separator."""
        at = text.find(separator, start, end)
        while at >= 0:
            if at > start:
                yield at
            at = text.find(separator, at + len(separator), end)
        yield end

    def cut(start, end, level):
        while level < len(separators) and text.find(separators[level], start, end) < 0:
            level += 1
        if level == len(separators):
            windows(start, end)
            return
        run, run_start, begin = [], start, start
        for stop in pieces(separators[level], start, end):
            if stop - begin < size:
                run.append(stop)
            else:
                if run:
                    merge(run, run_start)
                cut(begin, stop, level + 1)
                run, run_start = [], stop
            begin = stop
        if run:
            merge(run, run_start)

    if text:
        cut(0, len(text), 0)
    return chunks


def flatten_struct(rows, struct="c"):
    """Struct fields as columns, `chunk` under the name of the chunk table."""
    fields = rows.schema[struct].dataType.names
    others = [c for c in rows.columns if c != struct]
    return rows.select(
        *others,
        *[
            F.col(f"{struct}.{f}").alias("text_chunk" if f == "chunk" else f)
            for f in fields
        ],
    )


def with_chunk_ids(chunks, document_id="id"):
    """Chunk ids from the document id and the chunk number: unique, and the same on every run.

    A chunk number or document id that doesn't fit in its bits stops the job.
    """
    fits = (F.col("chunk_location_in_doc") < 1 << CHUNK_BITS) & (
        F.col(document_id) < 1 << (63 - CHUNK_BITS))
    made = F.shiftleft(F.col(document_id), CHUNK_BITS) + F.col("chunk_location_in_doc")
    wrong = F.raise_error(F.concat(F.lit("no chunk id for document "), F.col(document_id)))
    return chunks.withColumn("id", F.when(~fits, wrong.cast("long")).otherwise(made))


def chunk_doc_stats(chunks):
    """Per document: chunk count and lengths, and whether its locations are 0 to n-1."""
    return chunks.groupBy("folder_name", "file_name").agg(
        F.count("*").alias("n_chunks"),
        F.sum("chunk_length_in_chars").alias("total_chars"),
        F.max("chunk_length_in_chars").alias("max_chars"),
        F.min("chunk_length_in_chars").alias("min_chars"),
        F.avg("chunk_length_in_chars").alias("avg_chars"),
        (
            (F.count("*") == F.max("total_chunks_in_doc"))
            & (F.min("total_chunks_in_doc") == F.max("total_chunks_in_doc"))
            & (F.min("chunk_location_in_doc") == 0)
            & (F.max("chunk_location_in_doc") == F.count("*") - 1)
            & (F.countDistinct("chunk_location_in_doc") == F.count("*"))
        ).alias("is_complete"),
    )
