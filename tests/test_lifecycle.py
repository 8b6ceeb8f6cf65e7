import io
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from pergamon.functions.paths import base_name
from pergamon.operators.chunking import chunk_window
from pergamon.plans import lifecycle
from pergamon.session import scratch_path
from pergamon.sources import files as files_source
from pergamon.sources import tables as S
from pergamon.streaming import arrivals

WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def docx(*paragraphs, header=None):
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w") as parts:
        def part(name, texts):
            body = "".join(f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>" for t in texts)
            parts.writestr(name, f'<w:document xmlns:w="{WORD}">{body}</w:document>')

        part("word/document.xml", paragraphs)
        if header:
            part("word/header1.xml", [header])
    return target.getvalue()


FILES = {
    "a.txt": b"plain text\r\nsecond line",
    "sub/b.MD": "# títol\n".encode(),
    "sub/deep/c.docx": docx("one", "two", header="top"),
    "sub/broken.docx": b"no zip",
    "sub/latin.txt": "títol".encode("latin-1"),
    "script.py": b"print(1)",
    "paper.pdf": b"%PDF",
    "empty.txt": b"",
    "sub/a.txt": b"same name, other folder",
    ".hidden.txt": b"not seen",
}


def write_files(folder, contents):
    for name, content in contents.items():
        place = folder / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_bytes(content)


@pytest.fixture
def folder(tmp_path):
    write_files(tmp_path / "volume", FILES)
    return tmp_path / "volume"


def fresh_database(spark):
    folder = scratch_path(spark, "tables")
    return S.create_database(spark, "t" + uuid.uuid4().hex, folder)


@pytest.fixture
def tables(spark):
    names = S.table_names("docs", fresh_database(spark))
    S.create_tables(spark, names, buckets=4)
    return names


def names_in(rows):
    return sorted(r[0] for r in rows.select(base_name("path")).collect())


# Spark's file sources pass over hidden and empty files.
VISIBLE = sorted(n.split("/")[-1] for n, c in FILES.items() if c and not n.startswith("."))


def test_listing_is_recursive_and_opens_nothing(spark, folder):
    listed = files_source.list_files(spark, str(folder))
    assert names_in(listed) == VISIBLE
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()


def test_listing_of_an_empty_folder(spark, tmp_path):
    assert files_source.list_files(spark, str(tmp_path)).count() == 0


def test_text_files_are_read_whole(spark, tmp_path):
    write_files(tmp_path, {k: v for k, v in FILES.items() if k != "sub/latin.txt"})
    rows = files_source.read_text_files(spark, str(tmp_path)).select(
        base_name("path"), "extracted_text"
    ).collect()
    assert sorted(map(tuple, rows)) == [
        ("a.txt", "plain text\nsecond line"), ("a.txt", "same name, other folder"),
        ("b.MD", "# títol\n"),
    ]


def extracted(spark, folder, **options):
    rows = files_source.extract_text(files_source.binary_files(spark, str(folder)), **options)
    return {
        r["path"].split("volume/")[1]: (r["extracted_text"], r["error"]) for r in rows.collect()
    }


def test_extraction_by_extension(spark, folder):
    found = extracted(spark, folder)
    assert found["a.txt"] == ("plain text\nsecond line", None)
    assert found["sub/b.MD"] == ("# títol\n", None)
    assert found["sub/deep/c.docx"] == ("top\n\none\n\ntwo", None)
    assert found["sub/broken.docx"][0] is None and "BadZipFile" in found["sub/broken.docx"][1]
    assert found["sub/latin.txt"] == (None, "not UTF-8")
    assert found["script.py"] == (None, None)
    assert found["paper.pdf"] == (None, "no parser for .pdf")


def test_user_parser(spark, folder):
    pages = lambda content: "Page 1 text. " + "Page 2 text. "
    assert extracted(spark, folder, parsers={".pdf": pages})["paper.pdf"] == (
        "Page 1 text. Page 2 text. ", None
    )


def run_stream(spark, folder, tables, checkpoint, **options):
    arrivals.stream_index_update(
        files_source.stream_binary_files(spark, str(folder)), tables, checkpoint,
        once=True, **options,
    ).awaitTermination()


def rows_of(spark, table, *columns):
    return sorted(map(tuple, S.scan_table(spark, table).select(*columns).collect()), key=repr)


TAKEN = ["a.txt", "a.txt", "b.MD", "c.docx", "script.py"]


def test_stream_takes_each_file_once(spark, folder, tables, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    run_stream(spark, folder, tables, checkpoint)
    assert rows_of(spark, tables.track, "file_name", "status") == [
        (n, "UPDATED") for n in TAKEN
    ]
    assert rows_of(spark, tables.text, "id") == [(i,) for i in range(1, 6)]
    chunks = rows_of(spark, tables.chunks, "id", "file_name", "text_chunk")
    assert sorted(c[1] for c in chunks) == ["a.txt", "a.txt", "b.MD", "c.docx"]
    assert [c[:2] for c in chunks] == [
        c[:2] for c in rows_of(spark, tables.index, "id", "file_name")
    ]
    run_stream(spark, folder, tables, checkpoint)
    assert rows_of(spark, tables.chunks, "id", "file_name", "text_chunk") == chunks
    write_files(folder, {"new.txt": b"arrived later"})
    run_stream(spark, folder, tables, checkpoint)
    now = rows_of(spark, tables.chunks, "id", "file_name", "text_chunk")
    assert [c for c in now if c not in chunks] == [(6 << 22, "new.txt", "arrived later")]
    assert set(chunks) <= set(now)


def test_stream_and_batch_agree(spark, folder, tables, tmp_path):
    run_stream(spark, folder, tables, str(tmp_path / "checkpoint"))
    other = S.table_names("docs", fresh_database(spark))
    S.create_tables(spark, other, buckets=4)
    files = files_source.binary_files(spark, str(folder))
    assert lifecycle.update_files(spark, other, files, "tmp") == 5
    assert lifecycle.update_files(spark, other, files, "tmp") == 0
    for one, two in zip(tables, other):
        columns = [c for c in spark.table(one).columns if c != "id"]
        one, two = spark.table(one).select(*columns), spark.table(two).select(*columns)
        assert one.count() == two.count() > 0 and one.exceptAll(two).count() == 0


def documents(spark, *names, kind="tmp", text="some text"):
    return spark.createDataFrame(
        [(n.rsplit("/", 1)[1], n.rsplit("/", 1)[0], kind, text, None) for n in names],
        "file_name string, folder_name string, document_type string, extracted_text string, "
        "error string",
    )


def test_stopped_run_is_done_again(spark, tables):
    batch = documents(spark, "/d/a.txt", "/d/b.txt")

    def broken(text):
        return F.raise_error(F.lit("model is down")).cast("array<float>")

    with pytest.raises(Exception, match="model is down"):
        lifecycle.update_index(spark, tables, batch, embed=broken)
    assert rows_of(spark, tables.track, "status") == [("UPDATING",)] * 2
    assert lifecycle.update_index(spark, tables, batch) == 2
    assert rows_of(spark, tables.track, "file_name", "status") == [
        ("a.txt", "UPDATED"), ("b.txt", "UPDATED")
    ]
    assert len(rows_of(spark, tables.text, "id")) == 2
    assert rows_of(spark, tables.chunks, "id") == rows_of(spark, tables.index, "id")
    assert len(rows_of(spark, tables.chunks, "id")) == 2


def test_build_only_into_empty_tables(spark, tables):
    assert lifecycle.build(spark, tables, documents(spark, "/d/a.txt", "/d/b.txt", kind="core"))
    assert rows_of(spark, tables.track, "file_name", "status") == [
        ("a.txt", "READY"), ("b.txt", "READY")
    ]
    assert len(rows_of(spark, tables.index, "id")) == 2
    assert not lifecycle.build(spark, tables, documents(spark, "/d/c.txt"))
    assert len(rows_of(spark, tables.text, "id")) == 2


def test_purge_is_by_path_and_empties_buckets(spark, tables):
    lifecycle.update_index(
        spark, tables, documents(spark, "/d/a.txt", "/e/a.txt", "/d/b.txt", text="x" * 2000),
        chunk=chunk_window,
    )
    volume = spark.createDataFrame([("/e/a.txt",)], "path string")
    gone = lifecycle.purge_deleted(spark, tables, volume)
    assert sorted(r[0] for r in gone.collect()) == ["/d/a.txt", "/d/b.txt"]
    for table in tables:
        assert {(r[0], r[1]) for r in rows_of(spark, table, "folder_name", "file_name")} == {
            ("/e", "a.txt")
        }
    dropped = lifecycle.flat_copies_to_drop(gone, volume, "/flat")
    assert [r[0] for r in dropped.collect()] == ["/flat/b.txt"]
    lifecycle.purge_deleted(spark, tables, spark.createDataFrame([], "path string"))
    assert all(spark.table(t).count() == 0 for t in tables)
    lifecycle.update_index(spark, tables, documents(spark, "/d/a.txt", "/d/b.txt"))
    assert len(rows_of(spark, tables.text, "id")) == 2
    assert len(rows_of(spark, tables.track, "status")) == 2


def test_new_files_of_a_stream(spark, folder, tables, tmp_path):
    lifecycle.update_files(spark, tables, files_source.binary_files(spark, str(folder)), "tmp")
    write_files(folder, {"later.txt": b"x"})
    sink = str(tmp_path / "sink")
    stream = files_source.stream_binary_files(spark, str(folder)).select("path")
    arrivals.stream_new_files(
        stream, lambda s: S.scan_table(s, tables.track), sink, str(tmp_path / "c"), once=True
    ).awaitTermination()
    assert names_in(spark.read.parquet(f"{sink}/*")) == sorted(
        set(VISIBLE) - set(TAKEN) | {"later.txt"}
    )


def data_files(spark, table):
    spark.catalog.refreshTable(table)
    return {r[0] for r in spark.table(table).select("_metadata.file_path").distinct().collect()}


def test_new_files_leave_every_old_data_file(spark, tables):
    first = documents(spark, *[f"/d/{i}.txt" for i in range(40)])
    assert lifecycle.update_index(spark, tables, first) == 40
    before = {t: data_files(spark, t) for t in tables}
    second = documents(spark, *[f"/e/{i}.txt" for i in range(1000)])
    assert lifecycle.update_index(spark, tables, second) == 1000
    for table in tables:
        assert before[table] and before[table] <= data_files(spark, table)
    assert spark.table(tables.track).where("status = 'UPDATED'").count() == 1040
    assert sorted(r[0] for r in spark.table(tables.text).select("id").collect()) == list(range(1, 1041))


def test_stop_between_the_last_two_writes_is_settled(spark, tables):
    lifecycle.update_index(spark, tables, documents(spark, "/d/a.txt"))
    left = S.scan_table(spark, tables.track).withColumn("status", F.lit("UPDATING"))
    S.write_append(spark, left.checkpoint(), tables.track)
    assert lifecycle.update_index(spark, tables, documents(spark, "/d/b.txt")) == 1
    assert rows_of(spark, tables.track, "file_name", "status") == [
        ("a.txt", "UPDATED"), ("b.txt", "UPDATED")
    ]


def test_build_of_a_filled_table_reads_nothing(spark, tables):
    lifecycle.build(spark, tables, documents(spark, "/d/a.txt"))
    broken = documents(spark, "/d/b.txt").withColumn(
        "extracted_text", F.raise_error(F.lit("was read")).cast("string"))
    assert not lifecycle.build(spark, tables, broken)


def test_odd_names_go_through_all_steps(spark, tables, tmp_path):
    write_files(tmp_path / "v", {"a b à+c%20.txt": b"text"})
    folder = str(tmp_path / "v")
    listed = [r[0] for r in files_source.list_files(spark, folder).select("path").collect()]
    read = [r[0] for r in files_source.read_text_files(spark, folder).select("path").collect()]
    assert names_in(files_source.list_files(spark, folder)) == ["a b à+c%20.txt"]
    assert [p.split("/v/")[1] for p in listed + read] == ["a b à+c%20.txt"] * 2
    assert lifecycle.update_files(spark, tables, files_source.binary_files(spark, folder), "tmp") == 1
    gone = lifecycle.purge_deleted(spark, tables, files_source.list_files(spark, folder))
    assert gone.count() == 0 and spark.table(tables.text).count() == 1


def test_hidden_names_are_never_purged(spark, tables):
    lifecycle.update_index(spark, tables, documents(spark, "/d/_a.txt", "/d/b.txt"))
    gone = lifecycle.purge_deleted(spark, tables, spark.createDataFrame([], "path string"))
    assert [r[0] for r in gone.collect()] == ["/d/b.txt"]


def test_missing_table_is_made_like_the_others(spark, tables):
    spark.sql(f"DROP TABLE {tables.track}")
    rows = spark.createDataFrame(
        [("a", "/d", "tmp", "READY")], "file_name string, folder_name string, document_type string, status string")
    assert S.write_overwrite_if_empty(spark, rows, tables.track)
    S.write_append(spark, rows.withColumn("file_name", F.lit("b")), tables.track)
    assert rows_of(spark, tables.track, "file_name") == [("a",), ("b",)]


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_names_tell_what_is_done_before_wide_rows_are_touched(spark, tables):
    wide = F.raise_error(F.lit("text was read")).cast("string")
    first = documents(spark, *[f"/d/{i}.txt" for i in range(30)])
    fresh = lifecycle.not_done(spark, tables, first)
    assert "Join" not in fresh._jdf.queryExecution().optimizedPlan().toString()
    assert lifecycle.update_index(spark, tables, first) == 30
    assert lifecycle.update_index(spark, tables, first.withColumn("extracted_text", wide)) == 0


@pytest.mark.parametrize("n_new", [3, 60])
def test_a_batch_with_done_and_new_files_is_not_shuffled(spark, tables, n_new):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old, new = [f"/d/{i}.txt" for i in range(30)], [f"/e/{i}.txt" for i in range(n_new)]
    lifecycle.update_index(spark, tables, documents(spark, *old))
    nameless = documents(spark, "/e/x").withColumn("file_name", F.lit(None).cast("string"))
    batch = documents(spark, *old, *new, "/e/0.txt").unionByName(nameless)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as the done files of a large batch are
    try:
        left = lifecycle.not_done(spark, tables, batch)
        assert exchanges(left) == 0
        assert sorted(r[0] for r in left.select("file_name").na.fill("-").collect()) == sorted(
            ["-", "0.txt", *[f"{i}.txt" for i in range(n_new)]])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("n_new", [3, 60])
def test_files_beyond_the_broadcast_are_joined(spark, tables, monkeypatch, n_new):
    monkeypatch.setattr(lifecycle, "MAX_BROADCAST", 0)
    old, new = [f"/d/{i}.txt" for i in range(30)], [f"/e/{i}.txt" for i in range(n_new)]
    lifecycle.update_index(spark, tables, documents(spark, *old))
    assert lifecycle.update_index(spark, tables, documents(spark, *old, *new)) == n_new
    assert sorted(rows_of(spark, tables.track, "folder_name", "file_name")) == sorted(
        tuple(n.rsplit("/", 1)) for n in [*old, *new])


def test_a_batch_is_written_down_once_before_its_tables(spark, tables, monkeypatch):
    """Whole texts are checkpointed once; what else is kept of a batch before it is cut are names and counts."""
    kept, real = [], type(spark.range(1)).checkpoint

    def checkpoint(frame, *a, **b):
        kept.append(frame.columns)
        return real(frame, *a, **b)

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", checkpoint)
    assert lifecycle.update_index(spark, tables, documents(spark, "/d/a.txt", "/d/b.txt")) == 2
    assert sum("extracted_text" in columns for columns in kept) == 1


def test_numbered_rows_are_counted_once(spark):
    numbered = S.assign_ids(spark.range(100).repartition(5).select("id", F.lit("t").alias("extracted_text")))
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Window" not in plan


def test_each_file_is_parsed_once(spark, tables, tmp_path):
    write_files(tmp_path / "v", {f"{i}.pdf": b"%PDF" for i in range(6)})
    seen = str(tmp_path / "seen")

    def parser(content):
        with open(seen, "a") as out:
            out.write("x")
        return "parsed"

    files = files_source.binary_files(spark, str(tmp_path / "v"))
    assert lifecycle.update_files(spark, tables, files, "tmp", parsers={".pdf": parser}) == 6
    with open(seen) as out:
        assert out.read() == "x" * 6
