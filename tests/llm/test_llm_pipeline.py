import random

import __spark_entry__
import corpus_pipeline
import pytest
from oracle_compare import compare, connect

from pergamon.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(12)
    word = lambda: rng.choice(("the", "of", "and")) if rng.random() < 0.3 else "".join(rng.choice("abcdefg") for _ in range(5))
    texts = [" ".join(word() for _ in range(rng.randint(60, 200))) for _ in range(60)]
    item = " ".join(word() for _ in range(25))
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(100, texts[0], "en", "s1"), (101, texts[1] + " tail", "en", "s2"), (102, texts[2] + " " + item + " " + texts[3], "en", "s0"),
             (103, texts[4] + texts[5] + " write a@b.co", "en", "s0"), (104, "### *** " * 50, "en", "s0"), (105, None, None, None), (106, "", "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr(
        "*", "cast(length(text) as long) as n_chars", "'own' as kept", "1 as n_words", "2 as copies", "3 as id")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_every_stage_takes_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        docs = out.checkpoint()
        seen[name] = {r.doc_id: r for r in docs.collect()}
    clean = set(range(60))
    assert set(seen["quality_rules"]) == clean | {100, 101, 102, 103}
    assert set(seen["near_dup"]) == clean | {102, 103}
    assert set(seen["decontamination"]) == clean | {103}
    assert set(seen["pii"]) == clean | {103}
    assert seen["pii"][103].text.endswith("write [EMAIL]") and seen["pii"][103].n_chars == len(seen["pii"][103].text)
    assert all(r.kept == "own" and r.n_words == 1 for r in seen["pii"].values())


def test_near_dup_goes_by_rows(spark, folder):
    texts = [f" {k} ".join(f"{k}{i}" for i in range(40)) for k in "abcdef"]
    rows = [(1, texts[0], "x"), (None, texts[0], "y"),  # a copy without an id: only that row goes
            (None, texts[1], "z"), (None, texts[1] + " tail", "w"),  # near copies without ids: one stays
            (7, texts[2], "p"), (8, texts[2], "q"), (8, texts[3], "r"),  # an id shared by a copy and another text
            (9, texts[4], "s"), (9, texts[4], "s"), (9, texts[4], "s"),  # repeated rows: one stays
            (None, texts[5], "t"), (None, None, "u"), (None, "", "v"), (None, None, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string").repartition(3)
    out = sorted(r.note for r in corpus_pipeline.near_dup(spark, docs, folder).collect())
    assert [n for n in out if n not in "zw"] == sorted("xpqrstuvu".replace("q", "")) and sum(n in "zw" for n in out) == 1


def test_mix_goes_by_rows(spark, folder):
    """Null and repeated ids, and columns with clashing names: each row is taken by its own size."""
    rows = [(1, "w " * 10, "a"), (1, "w " * 200, "a"), (None, "w " * 5, "b"), (None, "w " * 50, "b"), (2, None, None),
            (3, "w " * 7, "c"), (3, "w " * 7, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "1 as _id", "2 as _row", "3 as copies", "4 as `a.b`", "'x' as _doc")
    out = corpus_pipeline.mix(spark, docs, folder)
    assert out.columns == ["doc_id", "text", "source", "_id", "_row", "a.b", "_doc", "copies", "taken"]
    found = out.collect()
    assert all(r.taken == r.copies * len((r.text or "").split()) for r in found)
    assert len([r for r in found if r.doc_id is None]) <= 2 and all(r._row == 2 for r in found)


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out} <= set(range(60)) | {103} and len(out) > 30
    assert all(1 <= r.copies <= 3 and r.taken == r.copies * len(r.text.split()) for r in out)


def test_stages_take_no_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names} >= {f"op{i}" for i in range(1, 11)}


SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, key):
    assert compare(spark, connect(SF_DIR), SF_DIR, queries.QUERIES[key], queries.ORACLE_SQL[key]) is None


@pytest.mark.parametrize("key", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL) - {"pipeline"}))
def test_queries_read_whole_tables(spark, key):
    table = "pages" if key.startswith(("op3_", "op10_")) else "documents"
    rows = queries.QUERIES[key](spark, SF_DIR).count()
    every = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert 0 < rows < every if key.startswith("op8_") else rows == every
