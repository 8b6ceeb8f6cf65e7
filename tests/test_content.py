"""Embeddings by content, and merged sketches."""

import math
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pergamon.operators import chat, content, sketches
from pergamon.plans import lifecycle
from pergamon.session import scratch_path
from pergamon.sources import tables as S


def counting(spark):
    """A model that counts the texts it sees; the vector is the text's length."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf(T.ArrayType(T.FloatType()))
    def model(text):
        seen.add(1)
        return [float(len(text)), 1.0]

    return seen, model


def test_a_model_sees_each_text_once(spark, tmp_path):
    folder = str(tmp_path / "kept")
    seen, model = counting(spark)
    texts = ["a", "a", "bb", "", None, "ccc", "a"] + ["hot"] * 500
    rows = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "id long, text_chunk string, _text int")
    first = content.embed_once(rows.where("id < 4"), folder, embed=model).collect()
    assert sorted((r.id, r.chunk_embedding) for r in first) == [
        (0, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [2.0, 1.0]), (3, [0.0, 1.0])]
    assert seen.value == 3
    both = content.embed_once(rows, folder, embed=model)
    assert both.columns == ["id", "text_chunk", "_text", "chunk_embedding"]
    assert {r.id: r.chunk_embedding[0] for r in both.collect()} == {i: float(len(t or "")) for i, t in enumerate(texts)}
    assert seen.value == 5
    assert content.embed_once(rows.limit(0), folder, embed=model).count() == 0
    assert content.embed_once(rows, folder, embed=model).count() == len(texts)
    assert seen.value == 5


def test_an_empty_first_run(spark, tmp_path):
    rows = spark.createDataFrame([], "id long, text_chunk string")
    assert content.embed_once(rows, str(tmp_path / "kept"), dimension=8).count() == 0
    rows = spark.createDataFrame([(1, "x y")], rows.schema)
    assert content.embed_once(rows, str(tmp_path / "kept"), dimension=8).count() == 1


def test_merged_sketches_against_sorted_values(spark):
    rng = random.Random(4)
    rows = [(m, d, rng.expovariate(1)) for m, n in (("hot", 30_000), ("b", 3), ("c", 400)) for d in range(3)
            for _ in range(n // 3 if n > 3 else 1)]
    rows += [("hot", 1, None), ("hot", 1, math.nan), ("none", 0, None)]
    log = spark.createDataFrame(rows, "m string, day int, t double")
    kept = sketches.time_sketches(log, ["m", "day"], "t")
    found = sketches.merged_quantiles(kept, ["m"]).collect()
    for r in found:
        values = sorted(t for m, _, t in rows if m == r.m and t is not None and not math.isnan(t))
        assert r.n == len(values)
        below, upto = sum(v < r.value for v in values), sum(v <= r.value for v in values)
        slack = sketches.RANK_ERROR * r.n
        assert below - slack <= r["quantile"] * r.n <= upto + slack
    assert sorted({r.m for r in found}) == ["b", "c", "hot"]
    errors = sketches.rank_errors(log, sketches.merged_quantiles(kept, ["m"]), ["m"], "t").collect()
    assert len(errors) == 9 and all(0 <= r.rank_error <= sketches.RANK_ERROR for r in errors)
    assert sketches.merged_quantiles(kept.limit(0), ["m"]).count() == 0


def test_equal_turns_have_an_order(spark):
    rows = spark.createDataFrame([(1, 1, "b"), (1, 1, "c"), (1, 0, "z"), (2, 3, None)], "conv_id int, turn int, text string")
    assert sorted(map(tuple, chat.last_user_query(rows.repartition(3)).collect())) == [(1, "c"), (2, None)]


def test_jobs_embed_copies_once(spark):
    """Build, update and a second fill of the index: the model sees each distinct chunk once."""
    folder = scratch_path(spark, "content")
    tables = S.table_names("docs", S.create_database(spark, "run_" + folder[-32:], folder))
    S.create_tables(spark, tables, buckets=2)
    seen, model = counting(spark)
    store = scratch_path(spark, "embeddings")

    def documents(*named):
        return spark.createDataFrame([(n, "/d", "core", t, None) for n, t in named], (
            "file_name string, folder_name string, document_type string, extracted_text string, error string"))

    assert lifecycle.build(spark, tables, documents(("a.txt", "one text"), ("b.txt", "one text")), embed=model, store=store)
    assert seen.value == 1
    new = documents(("c.txt", "one text"), ("d.txt", "another text"))
    assert lifecycle.update_index(spark, tables, new, embed=model, store=store) == 2
    assert seen.value == 2
    lifecycle.build_index(spark, tables, embed=model, store=store)
    assert seen.value == 2
    rows = S.scan_table(spark, tables.index).select("file_name", F.col("chunk_embedding")[0]).collect()
    assert sorted(map(tuple, rows)) == [("a.txt", 8.0), ("b.txt", 8.0), ("c.txt", 8.0), ("d.txt", 12.0)]
