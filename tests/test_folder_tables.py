"""Tables that are folders of files, as larger ones are, give the rows of tables in one file."""

import os

import pytest

from pergamon.plans.queries import QUERIES
from pergamon.sources import files

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "labels", "conversations")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    for name in TABLES:
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(3).write.parquet(f"{folder}/{name}.parquet")
        assert os.path.isdir(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("key", ["stream_new_files", "stream_index_update"])
def test_documents_in_several_files_arrive(spark, folder, key):
    found, wanted = (sorted(map(str, QUERIES[key](spark, sf_dir).collect())) for sf_dir in (folder, SF_DIR))
    assert found and found == wanted


def test_each_row_is_a_file_and_folders_are_few(spark, tmp_path):
    rows = spark.range(900).selectExpr("concat(id % 3, '/doc_id=', id div 2) AS stem", "concat('é', id % 7, char(10)) AS text")
    rows = rows.unionByName(spark.createDataFrame([("0/doc_id=0", None), ("0/doc_id=0", "é0\n")], rows.schema))
    folder = str(tmp_path / "texts")
    assert files.write_text_files(rows.repartition(5), folder) == 902
    assert sum(len(found) for _, found, _ in os.walk(folder)) == 3
    listed = files.list_files(spark, folder)
    assert listed.count() == 902 and listed.where("length = 1").count() == 1
    wanted = sorted((r["text"] or "") + "\n" for r in rows.collect())
    assert sorted(r["extracted_text"] for r in files.read_text_files(spark, folder).collect()) == wanted


def test_documents_of_one_id_are_files_of_their_own(spark, tmp_path):
    twice = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 40")
    twice.union(twice).write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["list_files"](spark, str(tmp_path)).count() == 2 * twice.count()


def test_files_are_listed_and_read_by_tasks_as_by_spark(spark, tmp_path, monkeypatch):
    folder = tmp_path / "vol ü+%41"
    contents = {
        "a.txt": b"x\r\ny", "sub/b.MD": b"q\xff\xfez", "sub/_h.txt": b"1", "sub/_a=b/c.txt": b"t", "_x/c.txt": b"1",
        ".h/c.txt": b"1", "deep/er/and/d e+f%20é.txt": b"z" * 100, "e.txt": b"", "_metadata.txt": b"m",
        "_metadata/in.txt": b"m", "k.txt._COPYING_": b"1", "x.py": b"p", "sub/g.txt.gz": b"n", "=/_b=.txt": b"="}
    for name, content in contents.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content)
    (folder / "link.txt").symlink_to(folder / "x.py")
    (folder / "nothing").mkdir()
    places = [str(folder), f"file:{folder}", f"{folder}/", f"{folder}/sub"]
    found = [(files.list_files(spark, p), files.read_text_files(spark, p)) for p in places]
    assert all("/listing-" in f for frames in found for frame in frames for f in frame.inputFiles())
    monkeypatch.setattr(files, "_root", lambda *a: None)  # Spark's own reader, whose driver holds all entries
    for place, frames in zip(places, found):
        plain = files.list_files(spark, place), files.read_text_files(spark, place)
        assert [sorted(map(str, f.collect())) for f in frames] == [sorted(map(str, f.collect())) for f in plain]
        assert frames[0].schema == plain[0].schema


def test_texts_are_read_a_few_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_HELD_BYTES", 50)
    monkeypatch.setattr(files, "_LISTED", 3)
    monkeypatch.setattr(files, "_READ_BYTES", 100)
    rows = spark.range(40).selectExpr("concat('f/', id) AS stem", "repeat(concat(id, ' '), 9) AS text")
    files.write_text_files(rows, str(tmp_path / "v"))
    assert files.list_files(spark, str(tmp_path / "v")).count() == 40
    read = files.read_text_files(spark, str(tmp_path / "v")).select("extracted_text").collect()
    assert sorted(r[0] for r in read) == sorted(r["text"] + "\n" for r in rows.collect())
