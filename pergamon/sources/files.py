"""Files in folders: listing, reading and text extraction."""

import io
import zipfile
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pergamon import schemas
from pergamon.functions.paths import extension
from pergamon.session import scratch_path

TEXT_EXTENSIONS = [".txt", ".md"]
# Files that a task holds at a time: their entries, and bytes of their contents; bytes that a task reads, about.
_LISTED = 10_000
_HELD_BYTES = 8 << 20
_READ_BYTES = 128 << 20
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def binary_files(spark, folder):
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    )


def stream_binary_files(spark, folder, files_per_batch=1000):
    """Files as they arrive, each once per checkpoint."""
    return (
        spark.readStream.format("binaryFile").schema(schemas.BINARY_FILES)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def _system(root):
    """(Arrow's file system, path there) of a qualified URI's scheme, authority and decoded path."""
    from urllib.parse import quote

    from pyarrow import fs
    scheme, authority, path = root
    if scheme == "file":
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(f"{scheme}://{authority}{quote(path)}")


def _root(spark, folder):
    """(qualified folder, scheme, authority and path) of a folder that Arrow can open, or nothing."""
    from pyarrow import fs
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    uri = path.toUri()
    root = (uri.getScheme(), uri.getAuthority() or "", uri.getPath())
    try:
        system, place = _system(root)
        there = system.get_file_info(place).type == fs.FileType.Directory
    except (OSError, ValueError, ImportError, NotImplementedError):
        there = False
    return (path.toString().rstrip("/"), root) if there else None


def _passed_over(name, is_folder):
    """Whether Spark's file sources take a file or folder of this name for hidden."""
    hidden = name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")
    return hidden and not (is_folder and name.startswith(("_common_metadata", "_metadata")))


def _entries(root):
    """Of each folder, what is in it: its path below the root, whether it is a folder, its time and length."""
    def entries(batches):
        from pyarrow import fs
        system, place = _system(root)
        place = place.rstrip("/")
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = system.get_file_info(fs.FileSelector(place + folder, allow_not_found=True))
                found = [f for f in found if not _passed_over(f.base_name, f.type == fs.FileType.Directory)
                         and (f.type == fs.FileType.Directory or f.type == fs.FileType.File and f.size > 0)]
                for i in range(0, len(found), _LISTED):
                    some = found[i:i + _LISTED]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f"{folder}/{f.base_name}" for f in some], pa.string()),
                        pa.array([f.type == fs.FileType.Directory for f in some], pa.bool_()),
                        pa.array([(f.mtime_ns or 0) // 1_000_000 for f in some], pa.int64()),
                        pa.array([f.size for f in some], pa.int64()),
                    ], ["below", "is_folder", "millis", "length"])

    return entries


def _listed(spark, root):
    """Every file below the root (below, millis, length), listed by tasks, one level of folders after the other, and stored."""
    cores = spark.sparkContext.defaultParallelism
    level, rows = spark.createDataFrame([("",)], "below string"), None
    folders = 1
    while folders:
        target = scratch_path(spark, "listing")
        level.repartition(min(folders, 4 * cores), "below").mapInArrow(
            _entries(root), "below string, is_folder boolean, millis long, length long").write.parquet(target)
        found = spark.read.schema("below string, is_folder boolean, millis long, length long").parquet(target)
        files = found.where("not is_folder").drop("is_folder")
        rows = files if rows is None else rows.union(files)
        level = found.where("is_folder").select("below")
        folders = level.count()
    return rows


def list_files(spark, folder):
    """Every file below a folder: path, modificationTime and length. No file is opened.

    Folders that Arrow can open are listed by tasks and the list is stored, so the driver holds none of it; others are
    listed by Spark, whose driver holds an entry for each file. As with all Spark file sources, empty files and names
    that begin with `_` or `.` are passed over, so a file that is empty or renamed so looks as if it were gone (see
    `purge_deleted`).
    """
    found = _root(spark, folder)
    if not found:
        return binary_files(spark, folder).select("path", "modificationTime", "length")
    return _listed(spark, found[1]).select(
        F.concat(F.lit(found[0]), "below").alias("path"), F.timestamp_millis("millis").alias("modificationTime"), "length")


def _decoded(path):
    """A path as it is listed: file metadata gives it percent-encoded, with plus signs as they are."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _plain_newlines(text):
    return F.regexp_replace(text, "\r\n?", "\n")


def read_text_files(spark, folder):
    """Whole .txt and .md files below a folder, one row each, line ends as newlines.

    Folders that Arrow can open are listed as by `list_files`, and tasks open the files; others are read by Spark.
    """
    found = _root(spark, folder)
    if found:
        return _read(spark, *found)
    return (
        spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True)
        .select(
            _decoded(F.col("_metadata.file_path")).alias("path"),
            _plain_newlines("value").alias("extracted_text"),
        )
        .where(extension("path").isin(TEXT_EXTENSIONS))
    )


def _read(spark, qualified, root):
    """`read_text_files`, from a list of the files that stays with the tasks."""
    path = F.concat(F.lit(qualified), "below")
    listed = _listed(spark, root).where(extension(path).isin(TEXT_EXTENSIONS))
    total = listed.select(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // _READ_BYTES))

    def contents(batches):
        system, place = _system(root)
        place, names, held, size = place.rstrip("/"), [], [], 0

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(held, pa.binary())], ["below", "content"])

        for batch in batches:
            for below in batch.column(0).to_pylist():
                with system.open_input_stream(place + below, compression=None) as file:
                    held.append(file.read())
                names.append(below)
                size += len(held[-1])
                if size >= _HELD_BYTES or len(held) >= _LISTED:
                    yield batch_of()
                    names, held, size = [], [], 0
        if held:
            yield batch_of()

    read = listed.select("below").repartition(tasks, "below").mapInArrow(contents, "below string, content binary")
    return read.select(path.alias("path"), _plain_newlines(F.col("content").cast("string")).alias("extracted_text"))


def write_text_files(rows, folder):
    """Write each row (stem, text) as a file of its own, `<folder>/<stem>-<part>-<number>.txt`, its text and a newline.

    No folder is made for a file, and the tasks put files in their places themselves, so no rename is left to the
    driver. A stem may hold folders; rows of one stem are numbered in the order of their texts' hashes, so a task
    that is repeated writes the same names. `folder` is a path or a URI that Arrow can open.
    """
    target = "file:///" + folder[5:].lstrip("/") if folder.startswith("file:") else folder

    def written(batches):
        import posixpath

        from pyarrow import fs
        from pyspark import TaskContext
        system, root = fs.FileSystem.from_uri(target)
        part, made, before, number, total = TaskContext.get().partitionId(), set(), None, 0, 0
        for batch in batches:
            for stem, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                number, before = number + 1 if stem == before else 0, stem
                place, name = posixpath.split(f"{root}/{stem}-{part}-{number}.txt")
                if place not in made:
                    system.create_dir(place)
                    made.add(place)
                with system.open_output_stream(f"{place}/_{name}") as out:
                    out.write((text.as_py() or "").encode() + b"\n")
                system.move(f"{place}/_{name}", f"{place}/{name}")
                total += 1
        yield pa.RecordBatch.from_pydict({"n": [total]})

    ordered = rows.sortWithinPartitions("stem", F.xxhash64("text")).select("stem", "text")
    return ordered.mapInArrow(written, "n long").agg(F.sum("n")).first()[0] or 0


def docx_text(content):
    """Text of one Word file: headers, body and footers, a blank line before each paragraph."""
    marks = {_WORD + "p": "\n\n", _WORD + "tab": "\t", _WORD + "br": "\n", _WORD + "cr": "\n"}
    with zipfile.ZipFile(io.BytesIO(content)) as parts:
        names = sorted(parts.namelist())
        wanted = [n for n in names if n.startswith("word/header") and n.endswith(".xml")]
        wanted += ["word/document.xml"]
        wanted += [n for n in names if n.startswith("word/footer") and n.endswith(".xml")]
        pieces = []
        for name in wanted:
            for node in ElementTree.fromstring(parts.read(name)).iter():
                is_text = node.tag == _WORD + "t"
                pieces.append(node.text or "" if is_text else marks.get(node.tag, ""))
    return "".join(pieces).strip()


_EXTRACTED = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("error", T.StringType()),
])


def _parse(parsers):
    @arrow_udf(_EXTRACTED)
    def parse(extensions: pa.Array, contents: pa.Array) -> pa.Array:
        rows = []
        for kind, content in zip(extensions, contents):
            try:
                parser = parsers[kind.as_py()] if content.is_valid else None
                rows.append({"text": parser(content.as_py()) if parser else None, "error": None})
            except Exception as failure:  # one unreadable file must not stop the others
                rows.append({"text": None, "error": f"{type(failure).__name__}: {failure}"})
        return pa.array(rows, pa.struct([("text", pa.string()), ("error", pa.string())]))

    # else a filter on the error is moved below, and every file is parsed a second time for it
    return parse.asNondeterministic()


def extract_text(files, parsers=None):
    """Text of each file by its extension, or the error that kept it from being read.

    Adds extracted_text and error to `files` (path, content, ...). Plain text is decoded by Spark;
    only files with a parser reach Python: `{".docx": docx_text}` and what the user adds, such as
    `{".pdf": f}` with `f(bytes) -> str`. An extension without a parser gives NULL and no error,
    a PDF without a parser is an error.
    """
    parsers = {".docx": docx_text, **(parsers or {})}
    kind = extension("path")
    is_text = F.col("_kind").isin(TEXT_EXTENSIONS)
    is_parsed = F.col("_kind").isin(list(parsers))
    plain = F.try_validate_utf8(F.when(is_text, F.col("content")).cast("string"))
    others = [c for c in files.columns if c != "content"]
    return (
        files.withColumn("_kind", kind)
        .select(
            *others, "_kind",
            _plain_newlines(plain).alias("_plain"),
            F.col("content").isNotNull().alias("_present"),
            _parse(parsers)("_kind", F.when(is_parsed, F.col("content"))).alias("_parsed"),
        )
        .select(
            *others,
            F.coalesce("_plain", "_parsed.text").alias("extracted_text"),
            F.when(is_text & F.col("_present") & F.col("_plain").isNull(), F.lit("not UTF-8"))
            .when((F.col("_kind") == ".pdf") & ~is_parsed, F.lit("no parser for .pdf"))
            .otherwise(F.col("_parsed.error")).alias("error"),
        )
    )


def extract_docx_text(files):
    """Text of the Word files among `files`."""
    return extract_text(files.where(extension("path") == ".docx"))
