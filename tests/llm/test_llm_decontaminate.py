import random
from datetime import date

import pytest

from pergamon.llm.decontaminate import Items, _bits, benchmark_matches, myers, without_benchmark


def distance(pattern, text):
    """(distance, end) of the nearest place, by the whole table."""
    row = list(range(len(pattern) + 1))
    best = (row[-1], 0)
    for end, symbol in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i - 1] + (p != symbol), row[i] + 1, new[i - 1] + 1))
        row = new
        if row[-1] < best[0]:
            best = (row[-1], end)
    return best


def test_bit_parallel_distance_is_that_of_the_table():
    rng = random.Random(5)
    for _ in range(300):
        pattern = [rng.choice("abcd") for _ in range(rng.randint(1, 90))]
        text = [rng.choice("abcd") for _ in range(rng.randint(0, 120))]
        assert myers(_bits(pattern), text) == distance(pattern, text)


def _edited(rng, words, errors):
    words = list(words)
    for _ in range(errors):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = "new" + str(rng.randrange(1000))
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, "more" + str(rng.randrange(1000)))
    return words


@pytest.mark.parametrize("shortest, longest, share", [(8, 60, 0.15), (1, 90, 0.15), (1, 9, 0.15), (1, 150, 0.0), (1, 30, 0.4)])
def test_every_place_within_the_budget_is_found(shortest, longest, share):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcde") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(rng.randint(shortest, longest)))) for i in range(40)]
    ready = Items([(i, t.encode()) for i, t in items], share)
    texts = []
    for _ in range(150):
        i, text = rng.choice(items)
        n = len(text.split())
        around = [[word() for _ in range(rng.randint(0, 60))] for _ in range(2)]
        texts.append(" ".join(around[0] + _edited(rng, text.split(), rng.randint(0, int(n * 0.25))) + around[1]))
    hits = 0
    for text in texts:
        words = text.split()
        found = ready.find(text.upper().encode())
        for i, item in items:
            item = item.split()
            nearest, _ = distance(item, words)
            assert (i in found) == (nearest <= (int(len(item) * share) if len(item) >= 8 else 0))
            if i in found:
                got, first, last = found[i]
                assert got == nearest == distance(item, words[first:last + 1])[0]
                hits += 1
                if not got:
                    assert words[first:last + 1] == item
    assert hits > 60


def test_matches_and_clean_documents(spark):
    item = "how many words of this very item must stand here in a row"
    bench = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, ""), (4, "too short"), (5, "x " * 40), (6, "?!")], "item_id long, text string")
    rows = [(10, "before " + item + " after"), (11, item.replace("very", "quite").upper() + "!"), (12, None),
            (13, ""), (14, "clean text without any of that"), (14, "clean text without any of that"),
            (15, "word " * 100_000 + item), (None, item), (16, "far too, short"), (17, "too long, short")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id int")
    found = sorted(map(tuple, benchmark_matches(docs, bench).collect()), key=repr)
    assert found == sorted([
        (10, 1, 0, 1, 13), (11, 1, 1, 0, 12), (15, 1, 0, 100_000, 100_012), (None, 1, 0, 0, 12), (16, 4, 0, 1, 2)], key=repr)
    clean = without_benchmark(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [12, 13, 14, 14, 17]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert benchmark_matches(docs, bench).count() == 0
    assert without_benchmark(docs, bench).count() == 1
    assert benchmark_matches(docs.limit(0), bench).columns == [
        "doc_id", "item_id", "distance", "first_word", "last_word"]


def test_blocks_find_what_one_pass_finds(spark, monkeypatch):
    items = [(i, " ".join(f"w{i}_{k}" for k in range(10))) for i in range(20)]
    docs = spark.createDataFrame(items, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr("pergamon.llm.decontaminate.BLOCK_BYTES", 300)
    found = sorted(map(tuple, benchmark_matches(docs, bench).select("doc_id", "item_id").collect()))
    assert found == [(i, i) for i in range(20)]
    assert without_benchmark(docs, bench).count() == 0


@pytest.mark.parametrize("kind, values", [
    ("date", [date(2020, 1, 2), None]), ("smallint", [3, 4]), ("string", ["b", "é"]), ("decimal(9,2)", [1, 2]), ("double", [0.5, 1.5])])
def test_ids_of_any_type(spark, kind, values):
    bench = spark.createDataFrame([(0, "one"), (1, "two three")], "k int, text string").selectExpr(
        f"CASE k WHEN 0 THEN CAST({_literal(values[0])} AS {kind}) ELSE CAST({_literal(values[1])} AS {kind}) END AS item_id", "text")
    docs = spark.createDataFrame([(1, "three two three One"), (2, "two, one")], "doc_id long, text string")
    found = benchmark_matches(docs, bench)
    assert found.schema["item_id"].dataType == bench.schema["item_id"].dataType
    ids = {r.text: r.item_id for r in bench.collect()}
    assert sorted(((r.doc_id, r.first_word, r.item_id) for r in found.collect()), key=repr) == sorted(
        [(1, 3, ids["one"]), (1, 1, ids["two three"]), (2, 1, ids["one"])], key=repr)


def _literal(value):
    return "NULL" if value is None else f"'{value}'"
