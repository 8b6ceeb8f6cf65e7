import uuid

import pytest
from pyspark.sql import functions as F

from pergamon.operators import indexing, snapshots
from pergamon.plans import lifecycle
from pergamon.session import scratch_path
from pergamon.sources import tables as S


def fresh_database(spark):
    folder = scratch_path(spark, "tables")
    return S.create_database(spark, "t" + uuid.uuid4().hex, folder)


@pytest.fixture
def tables(spark):
    names = S.table_names("docs", fresh_database(spark))
    S.create_tables(spark, names, buckets=4)
    return names


def texts(spark, *rows):
    return spark.createDataFrame(rows, "id long, folder_name string, file_name string, "
                                       "extracted_text string")


def held(spark, table):
    return sorted(map(tuple, spark.table(table).select("id", "file_name", "extracted_text").collect()))


def test_columns_of_the_tables(spark, tables):
    described = S.describe_schema(S.scan_table(spark, tables.text)).collect()
    assert [tuple(r) for r in described] == [
        ("id", "bigint"), ("file_name", "string"), ("extracted_text", "string"),
        ("folder_name", "string"), ("document_type", "string"),
    ]
    index = {r[0]: r[1] for r in S.describe_index_schema(S.scan_table(spark, tables.chunks)).collect()}
    assert index["chunk_embedding"] == "array<float>" and len(index) == 9


def test_append_is_by_name(spark, tables):
    S.write_append(spark, texts(spark, (1, "d", "a", "x")), tables.text)
    S.write_append(spark, texts(spark, (2, "d", "b", "y")).select(
        "extracted_text", "file_name", "folder_name", "id"), tables.text)
    assert held(spark, tables.text) == [(1, "a", "x"), (2, "b", "y")]


def test_replace_keeps_other_files(spark, tables):
    S.write_append(
        spark, texts(spark, *[(i, "d", f"f{i}", "old") for i in range(20)]), tables.text
    )
    new = texts(spark, (103, "d", "f3", "new"), (104, "d", "f3", "more"), (200, "d", "g", "new"))
    for _ in range(2):
        S.replace_rows(spark, tables.text, new)
        expected = [(i, f"f{i}", "old") for i in range(20) if i != 3]
        assert held(spark, tables.text) == expected + [
            (103, "f3", "new"), (104, "f3", "more"), (200, "g", "new")
        ]


def test_large_bucket_has_many_writers(spark):
    names = S.table_names("docs", fresh_database(spark))
    S.create_tables(spark, names, buckets=1)
    rows = spark.range(40_000).select(
        "id", F.lit("d").alias("folder_name"), F.col("id").cast("string").alias("file_name"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 8).alias("extracted_text"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        S.write_append(spark, rows.repartition(8), names.text)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(spark.table(names.text).inputFiles()) > 3


def test_ids_follow_the_order(spark):
    rows = spark.range(5000).select(
        (F.col("id") % 7).alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("b")
    ).repartition(6)
    found = S.assign_ids(rows, ["a", "b"], start=100).collect()
    assert sorted(r["id"] for r in found) == list(range(101, 5101))
    by_id = [(r["a"], r["b"]) for r in sorted(found, key=lambda r: r["id"])]
    assert by_id == sorted(by_id)


def test_ids_without_an_order_move_no_rows(spark):
    rows = spark.range(1000).select(F.col("id").alias("a")).repartition(5)
    found = S.assign_ids(rows)
    assert sorted(r["id"] for r in found.collect()) == list(range(1, 1001))


def test_ids_of_nothing(spark):
    assert S.assign_ids(spark.range(0).select(F.col("id").alias("a")), ["a"]).count() == 0


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    source = spark.createDataFrame([(2, "c"), (2, "d"), (3, "e")], "id long, v string")
    once = indexing.index_upsert(target, source)
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "d"), (3, "e")]
    twice = indexing.index_upsert(once, source)
    assert sorted(map(tuple, twice.collect())) == [(1, "a"), (2, "d"), (3, "e")]


def test_upsert_keeps_the_last_by_order(spark):
    target = spark.createDataFrame([(1, "a", 0)], "id long, v string, at int")
    source = spark.createDataFrame([(1, "z", 1), (1, "b", 2), (2, "c", 1)], "id long, v string, at int")
    found = indexing.index_upsert(target, source, ["at"])
    assert sorted(map(tuple, found.collect())) == [(1, "b", 2), (2, "c", 1)]


def test_delete_of_no_ids_changes_nothing(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    assert indexing.index_delete(target, target.where("id < 0").select("id")).count() == 2
    left = indexing.index_delete(target, target.where("id = 1").select("id"))
    assert [r["id"] for r in left.collect()] == [2]


def test_batches_hold_less_than_the_limit_and_one_row(spark):
    chunks = spark.range(3000).select(
        (F.col("id") * 4194304).alias("id"), F.repeat(F.lit("é"), (F.col("id") * 7919 % 900 + 1).cast("int")).alias("text_chunk")
    )
    batches = indexing.upsert_batches(chunks, 10_000, 1000).groupBy("shard", "batch").agg(
        F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest"), F.min("id").alias("first"),
        F.max("id").alias("last"), F.count("*").alias("n"),
    ).collect()
    assert sum(b["n"] for b in batches) == 3000
    assert all(b["bytes"] < 10_000 + b["largest"] for b in batches)
    assert all((b["last"] - b["first"]) // 4194304 + 1 == b["n"] for b in batches)
    assert len(batches) < 3000 / 10  # ids far apart fill requests too


def test_changes_between_states(spark):
    schema = "k string, v string, w int"
    old = spark.createDataFrame([("same", None, 1), ("gone", "x", 1), ("new v", "a", 1)], schema)
    new = spark.createDataFrame([("same", None, 1), ("come", None, None), ("new v", None, 1)], schema)
    found = snapshots.snapshot_diff(old, new, ["k"]).select("k", "change", "v").collect()
    assert sorted(map(tuple, found), key=repr) == sorted([
        ("gone", "delete", "x"), ("come", "insert", None),
        ("new v", "update_pre", "a"), ("new v", "update_post", None),
    ], key=repr)
    assert snapshots.snapshot_diff(old, old, ["k"]).count() == 0


@pytest.fixture
def moved(monkeypatch):
    """How often rows were dealt out by bucket."""
    calls, deal = [], S._balanced
    monkeypatch.setattr(S, "_balanced", lambda rows: calls.append(1) or deal(rows))
    return calls


def _chunk_rows(spark, numbers):
    return spark.createDataFrame(
        [(i, f"f{i % 20}", "d", f"text {i}") for i in numbers], "id long, file_name string, folder_name string, text_chunk string")


def test_an_index_is_written_where_its_chunks_lie(spark, tables, moved):
    S.write_append(spark, _chunk_rows(spark, range(200)), tables.chunks)
    moved.clear()
    for _ in range(2):
        lifecycle.build_index(spark, tables, dimension=8)
    assert not moved
    rows = spark.table(tables.index)
    assert sorted(r.id for r in rows.collect()) == list(range(200))
    assert rows.join(spark.table(tables.chunks), ["id", S.BUCKET]).count() == 200
    assert len(rows.inputFiles()) <= 4 * len(spark.table(tables.chunks).inputFiles())


def test_many_small_files_are_put_together(spark, tables, moved):
    for i in range(12):
        S.write_append(spark, _chunk_rows(spark, range(100 * i, 100 * i + 100)), tables.chunks)
    moved.clear()
    assert not S._are_large(spark.table(tables.chunks), 1)
    lifecycle.build_index(spark, tables, dimension=8)
    assert moved and len(spark.table(tables.index).inputFiles()) < len(spark.table(tables.chunks).inputFiles())
    assert S.scan_table(spark, tables.index).count() == 1200


def test_compaction_does_not_move_large_files(spark, tables, moved):
    S.write_append(spark, texts(spark, *[(i, "d", f"f{i}", "t") for i in range(80)]), tables.text)
    gone = spark.createDataFrame([("d", f"f{i}") for i in range(0, 80, 2)], "folder_name string, file_name string")
    S.delete_rows(spark, tables.text, gone)
    moved.clear()
    assert S.compact(spark, tables.text, 0.0) == 4 and not moved
    assert held(spark, tables.text) == [(i, f"f{i}", "t") for i in range(1, 80, 2)]
    assert S.compact(spark, tables.text, 0.0) == 0
