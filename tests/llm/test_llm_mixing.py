import random

from pyspark.sql import functions as F

from pergamon.llm import mixing
from pergamon.llm.mixing import WEIGHTS, mixed, source_targets


def targets(tokens):
    """The rule by hand: share by weight, cut at three times, hand out again."""
    order = sorted((s for s in tokens if s is not None)) + ([None] if None in tokens else [])
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    goal, left, open_ = dict.fromkeys(order, 0.0), float(sum(tokens.values())), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            goal[s] += left * weight[s] / total
        left = sum(max(0.0, goal[s] - 3 * tokens[s]) for s in order)
        for s in order:
            if goal[s] >= 3 * tokens[s]:
                goal[s] = 3.0 * tokens[s]
                open_.discard(s)
    return goal


def made(seed, n_sources=9, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = None if i % 50 == 0 else "hot" if i % 3 == 0 else f"s{rng.randrange(n_sources)}"
        size = 40 if s == "hot" and i % 2 else int(rng.paretovariate(1.1) * 8) % 2000
        if s == "s1":
            size = size % 3  # a small source meets its limit
        rows.append((i, " ".join(["w"] * size) if i % 97 else None, s))
    return rows


def test_targets_by_hand(spark):
    for tokens in ({"a": 100, "b": 3, "é": 50, None: 7, "B": 0, "c": 1}, {"a": 5}, {"a": 0, "b": 0}, {"x": 1000, "y": 1, "z": 1}):
        rows = spark.createDataFrame(list(tokens.items()), "source string, tokens long")
        found = {r.source: r for r in source_targets(rows).collect()}
        expected = targets(tokens)
        assert {s: round(r.target, 6) for s, r in found.items()} == {s: round(t, 6) for s, t in expected.items()}
        order = sorted((s for s in tokens if s is not None)) + ([None] if None in tokens else [])
        assert [s for s, _ in sorted(found.items(), key=lambda x: x[1].place)] == order


def test_mix_meets_its_targets(spark):
    rows = made(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "1 as size", "2 as rate", "3 as copies", "4 as n")
    out = mixed(docs)
    found = out.collect()
    sizes = {i: len((t or "").split()) for i, t, _ in rows}
    tokens = {}
    for i, _, s in rows:
        tokens[s] = tokens.get(s, 0) + sizes[i]
    expected, taken = targets(tokens), dict.fromkeys(tokens, 0)
    assert sorted(r.doc_id for r in found) == sorted(sizes)
    for r in found:
        assert r.size == sizes[r.doc_id] and r.source_size == tokens[r.source]
        assert abs(r.target - expected[r.source]) < 1e-6 * (1 + expected[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for s, goal in expected.items():
        assert abs(taken[s] - goal) <= max(sizes[i] for i, _, own in rows if own == s) / 2 + 1
    assert sum(taken.values()) > 0.95 * sum(tokens.values())
    again = mixed(docs.repartition(7))
    assert out.exceptAll(again).isEmpty() and again.exceptAll(out).isEmpty()


def test_rates_tilt_with_length(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 60)), "a" if i % 2 else "b") for i in range(400)]
    rows += [(1000 + i, "w " * 200, "c") for i in range(100)]
    out = mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for source, sign in (("b", 1), ("c", 0)):
        r = [(x.size, x.rate) for x in out.filter(F.col("source") == source).collect()]
        assert all(0 < rate <= 3 for _, rate in r)
        assert not sign or (max(r)[1] - min(r)[1]) * (max(r)[1] - 1) >= 0


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (None, "c", None), (2, None, "t"), (3, "", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixed(docs).collect()
    assert len(found) == 5 and sum(r.doc_id == 1 for r in found) == 2
    assert {r.target for r in found if r.source == "t"} == {0.0}
    assert mixed(docs.limit(0)).count() == 0
    assert mixed(docs.filter("source = 't'")).count() == 2


def test_no_python_runs(spark):
    docs = spark.createDataFrame(made(2, n=60), "doc_id long, text string, source string")
    plan = mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_without_an_id_are_one_run_cut_in_pieces(spark, monkeypatch):
    """Many rows of one id, source and size: each its own copies, none lost, and no task makes them all."""
    monkeypatch.setattr(mixing, "RUN_ROWS", 50)
    monkeypatch.setattr(mixing, "CELL_ROWS", 40)
    rows = [(None, "a", "w " * 7)] * 1203 + [(None, "a", None)] * 170 + [(5, "a", "w " * 7)] * 60
    rows += [(i, "b", "w " * (1 + i % 9)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixed(docs).select("doc_id", "source", "size", "copies", "taken", "target", "source_size").collect()
    assert len(out) == len(rows)
    assert sum(r.doc_id is None and r.size == 7 for r in out) == 1203
    assert sum(r.doc_id is None and r.size == 0 for r in out) == 170
    for source in "ab":
        of = [r for r in out if r.source == source]
        assert sum(r.size for r in of) == of[0].source_size
        assert abs(sum(r.taken for r in of) - of[0].target) <= 7
    assert all(r.copies <= 3 for r in out)
    again = mixed(docs.repartition(7)).select("doc_id", "source", "size", "copies", "taken", "target", "source_size")
    assert sorted(map(str, again.collect())) == sorted(map(str, out))
