import base64
import sys
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pergamon.operators.chunking import chunk_window
from pergamon.plans import lifecycle
from pergamon.session import scratch_path
from pergamon.sources import requests
from pergamon.sources import tables as S

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # as a user's client that executors have not installed


class Recorder:
    """Remembers its requests; raises at the request of a given number, once."""

    def __init__(self, fail_at=None):
        self.calls, self.fail_at = [], fail_at

    def upsert(self, request, rows):
        if len(self.calls) == self.fail_at:
            self.fail_at = None
            raise ConnectionError("the index is away")
        self.calls.append((request, rows.column("id").to_pylist(), sum(map(len, rows.column("text_chunk").to_pylist()))))


def writer(client, limit=10, kind="upsert"):
    made = requests.RequestWriter(
        {"client": base64.b64encode(cloudpickle.dumps(None)).decode(), "run": "r", "limit": str(limit), "kind": kind})
    made.client = client
    return made


def batches(rows, size):
    """Arrow batches of `size` rows (shard, request, id, text)."""
    for at in range(0, len(rows), size):
        columns = list(zip(*rows[at:at + size]))
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, columns), pa.array([len(t) for t in columns[3]])], ["_shard", "_request", "id", "text_chunk", "_size"])


ROWS = [(0, 0, 1, "aaaa"), (0, 0, 2, "bbbb"), (0, 0, 3, "cccc"), (0, 1, 4, "d" * 50), (0, 1, 5, "e"), (1, 1, 6, ""), (1, 2, 7, "f")]


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_requests_are_bounded_whatever_the_batches(size):
    client = Recorder()
    sent = writer(client).write(batches(ROWS, size))
    assert client.calls == [("r-0-0-0", [1, 2], 8), ("r-0-0-1", [3], 4), ("r-0-1-0", [4], 50), ("r-0-1-1", [5], 1),
                            ("r-1-1-0", [6], 0), ("r-1-2-0", [7], 1)]
    assert (sent.requests, sent.rows) == (6, 7)


def test_a_repeated_task_sends_the_same_requests():
    client = Recorder(fail_at=3)
    with pytest.raises(ConnectionError):
        writer(client).write(batches(ROWS, 2))
    first = list(client.calls)
    client.calls.clear()
    writer(client).write(batches(ROWS, 3))
    assert client.calls[:3] == first and len(client.calls) == 6


def test_no_rows_no_request():
    client = Recorder()
    sent = writer(client).write(iter(()))
    assert (sent.requests, sent.rows, client.calls) == (0, 0, [])


def _files(folder, kind):
    return {p.name: pq.read_table(p).to_pylist() for p in sorted((folder / kind).glob("*.parquet"))}


def test_upserts_and_deletes_reach_the_client(spark, tmp_path):
    rows = spark.range(1, 301).select(
        "id", F.expr("CASE WHEN id = 7 THEN NULL WHEN id = 9 THEN repeat('x', 5000) ELSE repeat('é', CAST(id % 40 AS INT)) END")
        .alias("text_chunk"), F.array(F.col("id") * 0.5).alias("chunk_embedding"), F.lit("z").alias("batch"))
    rows = rows.unionByName(rows.where("id = 4"))
    client = requests.FolderClient(str(tmp_path))
    requests.send_upserts(spark, rows, client, limit=400)
    sent = _files(tmp_path, "upsert")
    assert sorted(r["id"] for part in sent.values() for r in part) == sorted([*range(1, 301), 4])
    for part in sent.values():
        assert len(part) == 1 or sum(len((r["text_chunk"] or "").encode()) for r in part) <= 400
        assert all(r["chunk_embedding"] == [r["id"] * 0.5] and r["batch"] == "z" and len(r) == 4 for r in part)
    assert len(sent) < 60  # neighbours share requests
    requests.send_upserts(spark, rows.limit(0), client)
    assert len(_files(tmp_path, "upsert")) == len(sent)

    ids = spark.createDataFrame([(i,) for i in [*range(250), 3, None]], "id long")
    requests.send_deletes(spark, ids, client, limit=100)
    parts = _files(tmp_path, "delete").values()
    assert sorted(r["id"] for part in parts for r in part) == list(range(250)) and max(map(len, parts)) <= 100


def test_ids_of_many_documents_share_requests_to_delete(spark, tmp_path):
    ids = spark.range(3000).selectExpr("shiftleft(id, 22) AS id")
    requests.send_deletes(spark, ids, requests.FolderClient(str(tmp_path)), limit=100)
    parts = _files(tmp_path, "delete").values()
    assert sorted(r["id"] for part in parts for r in part) == [i << 22 for i in range(3000)]
    assert max(map(len, parts)) <= 100 and len(parts) <= 30 + requests.DELETE_PARTS


def test_a_packed_client_keeps_the_requests_of_a_task_in_one_file(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id", "repeat('x', 90) AS text_chunk")
    requests.send_upserts(spark, rows, requests.PackedClient(str(tmp_path), held=5_000), limit=1000)
    files = _files(tmp_path, "upsert")
    got = [r for part in files.values() for r in part]
    assert sorted(r["id"] for r in got) == list(range(2000)) and len(files) <= 8
    names = {r["request"] for r in got}
    assert len(names) >= 180 and all(sum(r["request"] == n for r in got) <= 11 for n in names)
    assert not [p for p in (tmp_path / "upsert").iterdir() if p.name.startswith("_")]
    requests.send_upserts(spark, rows.limit(0), requests.PackedClient(str(tmp_path / "none")))
    requests.send_deletes(spark, rows, requests.PackedClient(str(tmp_path)), limit=100)
    deleted = [r["id"] for part in _files(tmp_path, "delete").values() for r in part]
    assert sorted(deleted) == list(range(2000))


def test_a_repeated_task_replaces_its_packed_file(tmp_path):
    for size in (2, 3):
        assert writer(requests.PackedClient(str(tmp_path))).write(batches(ROWS, size)).requests == 6
    (rows,) = _files(tmp_path, "upsert").values()
    assert [(r["request"], r["id"]) for r in rows] == [
        ("r-0-0-0", 1), ("r-0-0-0", 2), ("r-0-0-1", 3), ("r-0-1-0", 4), ("r-0-1-1", 5), ("r-1-1-0", 6), ("r-1-2-0", 7)]


class Away(requests.FolderClient):
    """Fails as long as a file says so."""

    def upsert(self, request, rows):
        from pathlib import Path
        if Path(self.folder, "away").exists():
            raise ConnectionError("the index is away")
        super().upsert(request, rows)


def _elsewhere(folder):
    """The ids a client holds: what was sent, less what was deleted. Ids are never used again."""
    sent = {r["id"] for part in _files(folder, "upsert").values() for r in part}
    return sent - {r["id"] for part in _files(folder, "delete").values() for r in part}


def test_jobs_keep_an_index_elsewhere_in_step(spark, tmp_path):
    tables = S.table_names("docs", S.create_database(spark, "t" + uuid.uuid4().hex, scratch_path(spark, "tables")))
    S.create_tables(spark, tables, buckets=4)
    client = Away(str(tmp_path))

    def documents(*numbers):
        return spark.createDataFrame(
            [(f"f{i}.txt", "d", "core", f"text {i} " * 300, None) for i in numbers],
            "file_name string, folder_name string, document_type string, extracted_text string, error string")

    def held():
        return {r.id for r in S.scan_table(spark, tables.index).collect()}

    options = {"chunk": chunk_window, "dimension": 8, "client": client}
    assert lifecycle.build(spark, tables, documents(1, 2), **options)
    assert _elsewhere(tmp_path) == held() != set()
    (tmp_path / "away").touch()
    with pytest.raises(Exception, match="the index is away"):
        lifecycle.update_index(spark, tables, documents(2, 3, 4), **options)
    (tmp_path / "away").unlink()
    assert lifecycle.update_index(spark, tables, documents(2, 3, 4), **options) == 2
    assert lifecycle.update_index(spark, tables, documents(3, 4), **options) == 0
    assert _elsewhere(tmp_path) == held() and len({r.file_name for r in S.scan_table(spark, tables.index).collect()}) == 4
    volume = spark.createDataFrame([("d/f1.txt",), ("d/f4.txt",)], "path string")
    lifecycle.purge_deleted(spark, tables, volume, client=client)
    assert _elsewhere(tmp_path) == held()
    assert {r.file_name for r in S.scan_table(spark, tables.index).collect()} == {"f1.txt", "f4.txt"}
