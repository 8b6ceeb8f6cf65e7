import collections
import random

import numpy as np
import pytest

from pergamon.llm import near_dup
from pergamon.llm.graph import components


def brute(rows):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def made_texts(n=160, seed=3):
    """Originals, exact and near copies of growing distance, chains, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(2, 7)))
    texts = [None, "", " ", "one two", "One  TWO", "a b c d e", "a b c d e", "x " * 50]
    while len(texts) < n:
        if len(texts) < 14 or rng.random() < 0.2:
            texts.append(" ".join(word() for _ in range(rng.choice((6, 30, 120, 400)))))
            continue
        words = (rng.choice(texts[8:]) or "").split()
        for _ in range(rng.randint(0, max(1, len(words) // 25))):
            words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    return [(10 + 3 * i, t) for i, t in enumerate(texts)]


def test_components_are_those_of_all_pairs(spark):
    rows = made_texts()
    rows.append((4000, ("z" * 50 + " ") * 30_000))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as kept", "3 as key")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs).collect()}
    assert found == brute(rows)
    assert len({c for _, c in found.values()}) < len(rows) - 20


def test_large_groups_meet_in_blocks(spark, monkeypatch):
    """Copies that differ from a hub just a little too much, in blocks smaller than their buckets."""
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(90):
        words = list(base)
        for k in rng.sample(range(150), 5):
            words[k] = f"n{i}_{k}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs).collect()}
    assert found == brute(rows)


def test_repeated_rows_null_ids_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text), (7, text), (None, text), (None, "other words stand here alone now"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, near_dup.near_duplicates(docs).collect()), key=repr)
    assert found == sorted([(7, 26, 7, True)] * 2 + [
        (None, 26, 7, False), (None, 2, None, True), (None, 0, None, True)], key=repr)
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_repeated_rows_cost_one_check(spark, monkeypatch):
    """Many rows of two near documents, and near documents without an id."""
    checked = []
    confirm = near_dup._confirmed

    def counted(texts, lead, pairs):
        ids = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "id")
        checked.append((pairs.count(), near_dup._texts_of(texts, lead, ids).count()))
        return confirm(texts, lead, pairs)

    monkeypatch.setattr(near_dup, "_confirmed", counted)
    one, two = [f"w{i}" for i in range(60)], [f"v{i}" for i in range(60)]
    rows = [(1, " ".join(one))] * 300 + [(2, " ".join([*one, "x"]))] * 300
    rows += [(None, " ".join(two))] * 50 + [(None, " ".join([*two, "y"]))] * 50
    rows += [(None, " ".join(["z", *one])), (9, " ".join(["u", *two]))]
    found = collections.Counter(map(tuple, near_dup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert found == {(1, 56, 1, True): 300, (2, 57, 1, False): 300, (None, 57, 1, False): 1, (9, 57, 9, True): 1,
                     (None, 56, 9, False): 50, (None, 57, 9, False): 50}
    assert checked and all(p <= 6 and t <= 6 for p, t in checked)


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(4)
    for share in (0.6, 0.75, 0.9, 1.0):
        errors = []
        for _ in range(60):
            x = rng.integers(0, 2**63, 400).astype(np.uint64)
            common = round(2 * len(x) * share / (1 + share))
            y = np.concatenate((x[:common], rng.integers(0, 2**63, len(x) - common).astype(np.uint64)))
            a, b = near_dup.odd_sketches(np.stack([near_dup.minhashes(x), near_dup.minhashes(y)])).view(np.uint64)
            real = common / (2 * len(x) - common)
            errors.append(near_dup.estimate(int(np.bitwise_count(a ^ b).sum())) - real)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08
    assert near_dup.estimate(near_dup.max_differing_bits()) >= near_dup.ESTIMATE_FLOOR


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(None, 1), (2, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)],
    [(i, (i * 7) % 50) for i in range(50)] + [(3, 90), (91, 90)],
])
def test_components(spark, links):
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    near = collections.defaultdict(set)
    for a, b in links:
        if None not in (a, b) and a != b:
            near[a].add(b)
            near[b].add(a)
    expected = {}
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        expected[start] = min(seen)
    assert found == expected
