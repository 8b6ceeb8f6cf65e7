import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pergamon.functions.vectors import hyperplanes, signatures
from pergamon.operators import search

INDEX = "id long, file_name string, chunk_embedding array<float>"
QUERIES = "query_id long, query_vector array<float>, selected_documents array<string>"


@pytest.fixture(scope="module")
def data(spark):
    """Random vectors, a third of them copies of one, a zero vector and a missing one."""
    pick = np.random.default_rng(5)
    vectors = pick.normal(size=(240, 16)).astype(np.float32)
    vectors[::3] = vectors[0]
    vectors[7] = 0
    names = [f"f{i % 7}" if i % 3 else "hot" for i in range(240)]
    asked = pick.normal(size=(30, 16)).astype(np.float32)
    asked[3] = vectors[0]
    asked[4] = 0
    chosen = [None if i % 5 == 0 else [] if i % 5 == 1 else ["hot", "f1"] if i % 5 == 2
              else [f"f{i % 7}"] if i % 5 == 3 else ["nowhere"] for i in range(30)]
    index = spark.createDataFrame(
        [(i, names[i], vectors[i].tolist()) for i in range(240)] + [(999, "hot", None)], INDEX
    )
    queries = spark.createDataFrame(
        [(i, asked[i].tolist(), chosen[i]) for i in range(30)], QUERIES
    )
    return index, queries, vectors.astype(float), names, asked.astype(float), chosen


def unit(m):
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def brute_force(vectors, asked, k, allowed):
    scores = np.round(unit(vectors) @ unit(asked).T, 9)
    found = {}
    for q in range(len(asked)):
        rows = [i for i in range(len(vectors)) if allowed(i, q)]
        rows.sort(key=lambda i: (-scores[i, q], i))
        found[q] = rows[:k]
    return {q: rows for q, rows in found.items() if rows}


def collected(hits):
    found = {}
    for r in sorted(hits.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["id"])
    return found


FORMS = {
    "broadcast": {},
    "blocks": {"max_queries": 3, "block_rows": 50, "block_queries": 7},
}


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("k", [1, 5, 300])
def test_exact(data, form, k):
    index, queries, vectors, _, asked, _ = data
    hits = search.vector_topk(index, queries, k, **FORMS[form])
    assert collected(hits) == brute_force(vectors, asked, k, lambda i, q: True)


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("filtered", [False, True])
def test_squared_distance(data, form, filtered):
    index, queries, vectors, names, asked, chosen = data
    run = search.vector_topk_filtered if filtered else search.vector_topk
    hits = run(index, queries, 5, "squared_l2", **FORMS[form])
    distance = np.round(((vectors[:, None] - asked[None]) ** 2).sum(axis=2), 9)
    expected = {}
    for q in range(30):
        rows = [i for i in range(240) if not filtered or not chosen[q] or names[i] in chosen[q]]
        expected[q] = sorted(rows, key=lambda i: (distance[i, q], i))[:5]
    assert collected(hits) == {q: rows for q, rows in expected.items() if rows}
    assert all(
        abs(r["score"] - distance[r["id"], r["query_id"]]) < 1e-6 for r in hits.collect()
    )


def test_unknown_metric(data):
    with pytest.raises(ValueError):
        search.vector_topk(*data[:2], metric="dot")


@pytest.mark.parametrize("form", FORMS)
def test_filtered_before_ranking(data, form):
    index, queries, vectors, names, asked, chosen = data
    hits = search.vector_topk_filtered(index, queries, 5, **FORMS[form])
    allowed = lambda i, q: not chosen[q] or names[i] in chosen[q]
    assert collected(hits) == brute_force(vectors, asked, 5, allowed)


def test_all_queries_filtered(data):
    index, queries, vectors, names, asked, chosen = data
    some = queries.where("size(selected_documents) > 0")
    hits = search.vector_topk_filtered(index, some, 5)
    allowed = lambda i, q: bool(chosen[q]) and names[i] in chosen[q]
    assert collected(hits) == brute_force(vectors, asked, 5, allowed)


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("filtered", [False, True])
@pytest.mark.parametrize("tables, bits", [(4, 2), (6, 5)])
def test_approximate_ranks_exactly_the_shared_buckets(data, form, filtered, tables, bits):
    index, queries, vectors, names, asked, chosen = data
    hits = search.vector_topk_ann(
        index, queries, 5, tables=tables, bits=bits, dimension=16, filtered=filtered, **FORMS[form]
    )
    planes = hyperplanes(tables, bits, 16)
    a, b = signatures(vectors, planes), signatures(asked, planes)

    def allowed(i, q):
        chosen_too = not filtered or not chosen[q] or names[i] in chosen[q]
        return chosen_too and bool((a[i] == b[q]).any())

    assert collected(hits) == brute_force(vectors, asked, 5, allowed)


def test_recall_grows_with_tables(data):
    index, queries, vectors, _, asked, _ = data
    exact = brute_force(vectors, asked, 5, lambda i, q: True)

    def recall(tables):
        found = collected(search.vector_topk_ann(index, queries, 5, tables, 4, 16))
        return sum(len(set(found.get(q, [])) & set(r)) for q, r in exact.items()) / 150

    assert recall(2) < recall(24) and recall(24) > 0.85


def test_no_rows_no_hits(data):
    index, queries = data[:2]
    assert search.vector_topk(index.where("id < 0"), queries).count() == 0
    assert search.vector_topk(index, queries.where("query_id < 0")).count() == 0


def test_retrieved_columns(spark):
    chunks = spark.createDataFrame(
        [(i, f"t{i}", f"f{i}", "d", 0, 1, "tmp") for i in range(20)],
        "id long, text_chunk string, file_name string, folder_name string, "
        "chunk_location_in_doc int, total_chunks_in_doc int, document_type string",
    )
    hits = spark.createDataFrame(
        [(q, 3, 1, 0.5) for q in range(50)] + [(1, 99, 2, 0.1)],
        "query_id long, id long, rank int, score double",
    )
    rows = search.retrieve_columns(hits, chunks).collect()
    assert len(rows) == 50 and {r["text_chunk"] for r in rows} == {"t3"}


def test_candidates_per_query(data):
    index, queries, _, names, _, chosen = data
    found = {r["query_id"]: r["n_candidates"]
             for r in search.selected_documents_filter(queries, index).collect()}
    names = names + ["hot"]
    assert found == {
        q: sum(not c or n in c for n in names) for q, c in enumerate(chosen)
    }


def _index(spark, vectors):
    return spark.createDataFrame(
        [(i, "f", list(map(float, v))) for i, v in enumerate(vectors)],
        "id long, file_name string, chunk_embedding array<double>",
    )


def _ask(spark, *vectors):
    return spark.createDataFrame(
        [(i, list(map(float, v))) for i, v in enumerate(vectors)],
        "query_id long, query_vector array<double>",
    )


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("metric", ["cosine", "squared_l2"])
def test_vectors_that_are_no_numbers_hide_no_hits(spark, form, metric):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(40, 8))
    bad = np.full((6, 8), np.nan)
    bad[3:] = np.inf
    clean = search.vector_topk(_index(spark, vectors), _ask(spark, vectors[0]), 5, metric, **FORMS[form])
    mixed = search.vector_topk(
        _index(spark, np.concatenate((vectors, bad))), _ask(spark, vectors[0]), 5, metric, **FORMS[form])
    rows = sorted(map(tuple, clean.collect()))
    assert len(rows) == 5 and sorted(map(tuple, mixed.collect())) == rows
    none = search.vector_topk(_index(spark, vectors), _ask(spark, bad[0]), 5, metric, **FORMS[form])
    assert none.count() == 0


def test_unequal_vectors_stop_the_search(spark):
    index = spark.createDataFrame(
        [(1, "f", [1.0, 0.0]), (2, "f", [1.0]), (3, "f", [1.0, 0.0, 0.0])],
        "id long, file_name string, chunk_embedding array<double>").coalesce(1)
    with pytest.raises(Exception, match="vector 2 has 1 values, not 2"):
        search.vector_topk(index, _ask(spark, [1, 0]), 1).collect()


@pytest.mark.parametrize("form", FORMS)
def test_far_from_zero_distances_are_exact(spark, form):
    """The score doesn't depend on which other rows stand in the slice."""
    rng = np.random.default_rng(6)
    vectors = 1e5 + rng.normal(size=(200, 8))
    query = 1e5 + rng.normal(size=8)
    exact = np.round(((vectors - query) ** 2).sum(axis=1), 9)
    best = np.lexsort((np.arange(200), exact))[:5]
    hits = search.vector_topk(_index(spark, vectors), _ask(spark, query), 5, "squared_l2", **FORMS[form])
    assert [(r["id"], round(r["score"], 9)) for r in hits.orderBy("rank").collect()] == [
        (i, exact[i]) for i in best
    ]


@pytest.mark.parametrize("group_bytes, fewest, most", [(64 << 20, 1, 8), (2 << 10, 9, 40)])
def test_rows_are_copied_to_few_blocks_unless_these_are_large(data, monkeypatch, group_bytes, fewest, most):
    index, queries, vectors, _, asked, _ = data
    monkeypatch.setattr(search, "GROUP_BYTES", group_bytes)
    place = [F.lit(0).alias("_table"), F.lit(0).alias("_bucket")]
    rows = index.where("chunk_embedding IS NOT NULL").select("id", "chunk_embedding", *place)
    met = queries.select("query_id", "query_vector", *place)
    hits = search.block_hits(rows, met, 5, False, "cosine", 2, 2, True)
    per_query = [r["count"] for r in hits.groupBy("query_id").count().collect()]
    assert 5 * fewest <= max(per_query) <= 5 * most
    found = search.vector_topk(index, queries, 5, max_queries=0, block_rows=2, block_queries=2)
    assert collected(found) == brute_force(vectors, asked, 5, lambda i, q: True)


@pytest.mark.parametrize("metric", ["cosine", "squared_l2"])
def test_filtered_rows_are_multiplied_with_the_queries_that_select_them(monkeypatch, metric):
    pick = np.random.default_rng(3)
    rows, asked = pick.normal(size=(1000, 8)).astype(np.float32), pick.normal(size=(100, 8)).astype(np.float32)
    rows[::7] = rows[0]
    rows[5] = np.nan
    names = pa.array([None if i % 50 == 0 else f"f{i % 10}" for i in range(1000)])
    chosen = [[] if i % 20 == 0 else [f"f{i % 10}", "nowhere"] for i in range(100)]
    queries = pa.table({"query_id": range(100), "query_vector": list(asked), "selected_documents": chosen})
    monkeypatch.setattr(search, "_CELLS", 10_000)
    cells, near = [], search._Asked._near
    monkeypatch.setattr(search._Asked, "_near", lambda self, v: cells.append(len(v) * len(self.vectors)) or near(self, v))
    found = []
    for most in (2, 0):  # by name, then under a mask
        monkeypatch.setattr(search, "_NAMES", most)
        cells.append(0)
        best = search._Best(np.arange(100), 5)
        search._Asked(queries, True, None, metric).score(best, np.arange(1000), pa.array(list(rows)), names)
        found.append(sorted(zip(best.query.tolist(), best.id.tolist(), best.score.tolist())))
    assert found[0] == found[1] and len(found[0]) == 500
    by_name = sum(cells[:cells.index(0, 1)])
    assert by_name < 20_000 < 90_000 < sum(cells) - by_name  # 100 queries and 999 usable rows


@pytest.mark.parametrize("metric", ["cosine", "squared_l2"])
def test_products_are_tiles_and_hits_are_those_of_all_pairs(monkeypatch, metric):
    monkeypatch.setattr(search, "_TILE", 7)
    monkeypatch.setattr(search, "_FIRST_ROWS", 3)
    monkeypatch.setattr(search, "_CELLS", 700)
    pick = np.random.default_rng(9)
    rows, asked = pick.normal(size=(500, 8)), pick.normal(size=(40, 8))
    rows[::6], rows[5] = rows[0], np.nan
    widths, near = [], search._Asked._near
    monkeypatch.setattr(search._Asked, "_near", lambda self, v: widths.append(len(self.vectors)) or near(self, v))
    queries = pa.table({"query_id": range(40), "query_vector": list(asked)})
    best = search._Best(np.arange(40), 6)
    some = search._Asked(queries, False, None, metric)
    for start, end in ((0, 2), (2, 300), (300, 500)):
        some.score(best, np.arange(start, end), pa.array(list(rows[start:end])), tag=np.arange(start, end, dtype=np.int32) // 10)
    assert max(widths) == 7
    scores = unit(rows) @ unit(asked).T if metric == "cosine" else -((rows[:, None] - asked[None]) ** 2).sum(axis=2)
    scores = np.round(np.where(np.isnan(scores), -np.inf, scores), 9)
    found = best.table("tag").to_pylist()
    for q in range(40):
        mine = sorted((h for h in found if h["query_id"] == q), key=lambda h: (-h["place"], h["id"]))
        assert [h["id"] for h in mine] == sorted(range(500), key=lambda i: (-scores[i, q], i))[:6]
        assert all(h["tag"] == h["id"] // 10 for h in mine)


def counted_vectors(spark, rows):
    """Rows whose vectors are made when they are read, and how many were made."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<float>")
    def vector(i):
        made.add(1)
        return [float((i * 7) % 11), float((i * 5) % 13), 1.0]

    return rows.withColumn("chunk_embedding", vector.asNondeterministic()("id")), made


def test_vectors_of_the_index_are_made_once_for_blocks(spark):
    index, made = counted_vectors(spark, spark.range(60))
    queries = spark.createDataFrame([(i, [float(i), 2.0, 1.0]) for i in range(9)], "query_id long, query_vector array<float>")
    hits = search.vector_topk(index, queries, 3, max_queries=2, block_rows=20, block_queries=4)
    assert hits.count() == 27
    assert made.value == 60


def test_queries_are_dealt_to_one_block_while_they_fit(spark, monkeypatch):
    dealt, blocks = [], search._blocks
    monkeypatch.setattr(search, "_blocks", lambda *a: dealt.append(blocks(*a)) or dealt[-1])
    index = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(40)], "id long, chunk_embedding array<float>")
    queries = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(40)], "query_id long, query_vector array<float>")
    plain = [df.withColumn("_table", F.lit(0)).withColumn("_bucket", F.lit(0)) for df in (index, queries)]
    hits = search.block_hits(*plain, 1, False, "cosine", 10, 10, True)
    assert hits.count() == 4 * 40  # a hit of each query from each block of rows
    assert [d.count() for d in dealt] == [40, 4 * 40]  # rows are sent once


def test_rows_that_no_hit_needs_are_not_joined(spark):
    rows = spark.range(-50_000, 50_000).withColumn("text_chunk", F.lit("text"))
    hits = rows.where("id % 97 = 0").select("id").unionByName(spark.createDataFrame([(None,), (5,), (5,)], "id long"))
    hits = search.stored_hits(hits)
    kept = search.rows_of_hits(rows, hits).select("id").collect()
    wanted = {r["id"] for r in hits.collect()} - {None}
    assert wanted <= {r["id"] for r in kept} and len(kept) < len(wanted) + 4000
    assert search.rows_of_hits(rows, search.stored_hits(hits.limit(0))).count() == 0


def test_answers_shuffle_the_texts_of_hits_only(spark):
    from pergamon.plans import answer

    rows = spark.range(4000).selectExpr(
        "id", "concat('f', id) AS file_name", "'d' AS folder_name", "'tmp' AS document_type", "concat('text ', id) AS text_chunk",
        "0 AS chunk_location_in_doc", "1 AS total_chunks_in_doc", "array(float(id % 31), float(id % 17), 1f) AS chunk_embedding")
    asked = spark.createDataFrame([(i, f"q{i}") for i in range(4)], "query_id long, search_text string")
    def embed(text):
        return F.array(F.length(text).cast("float"), F.lit(1.0).cast("float"), F.lit(2.0).cast("float"))

    found = answer.retrieve(rows, asked, 5, embed=embed, dimension=3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 20 and "may_be" in plan
