import random

import numpy as np
import pytest
import xxhash

from pergamon.llm import simhash
from pergamon.llm.simhash import chain_holds, fingerprint, linked_fingerprints, shingle_hashes, simhash_duplicates

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    out, now = [], ""
    for c in (text or "") + " ":
        if c in SPACES:
            out += [now] if now else []
            now = ""
        else:
            now += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    return out


def print_of(text):
    words = words_of(text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, limit=3):
    """[(doc_id, fingerprint, component_id)] by comparing all pairs of rows."""
    prints = [print_of(t) for _, t in rows]
    return [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, components_of(prints, [i for i, _ in rows], limit))]


def components_of(prints, ids, limit=3):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= limit:
                parent[find(a)] = find(b)
    least = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(prints))]


def made_texts(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    rows = [(90, None), (91, ""), (92, " \t\n"), (93, "one"), (94, "One"), (95, "one two"), (96, "ONE\x0btwo"), (97, "Ä b c")]
    bases = [[word() for _ in range(n)] for n in (3, 40, 200, 800)]
    for i in range(160):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = word()
        rows.append((1000 - i, "  ".join(words)))
    rows += [(None, rows[20][1]), (None, "nobody else has these"), (7, rows[30][1]), (7, rows[30][1])]
    return rows + [(5000, "x y z " * 50_000)]


def test_rows_are_those_of_all_pairs(spark):
    rows = made_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as key", "3 as first")
    found = sorted(map(tuple, simhash_duplicates(docs).collect()), key=repr)
    assert found == sorted(brute(rows), key=repr)
    assert len({c for _, _, c in found}) < len(rows) - 40


def linked(spark, prints):
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    return dict(map(tuple, linked_fingerprints(frame).collect())), signed


@pytest.mark.parametrize("block", [2048, 3])
def test_links_are_those_of_all_pairs_of_fingerprints(spark, monkeypatch, block):
    """Dense balls, chains at the limit, pairs just beyond it, and bits of every segment."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(block)
    prints = {0, 2**64 - 1, 1, 7, 15, 1 << 63}
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):
            near = base
            for b in rng.sample(range(64), rng.randint(0, 6)):
                near ^= 1 << b
            prints.add(near)
    walk = rng.getrandbits(64)
    for step in range(12):
        for b in rng.sample(range(64), 3):
            walk ^= 1 << b
        prints.add(walk)
    prints = sorted(prints)
    found, signed = linked(spark, prints)
    groups, expected = {}, components_of(prints, list(range(len(prints))))
    for p, root in zip(signed, expected):
        groups.setdefault(root, set()).add(p)
    mine = {}
    for p, root in found.items():
        mine.setdefault(root, set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_every_near_pair_has_a_chain_and_budgets_prune():
    rng = np.random.default_rng(1)
    bits = np.array([rng.choice(64, 3, replace=False) for _ in range(20_000)])
    differ = np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64), axis=1)
    assert np.any([chain_holds(s, differ) for s in range(simhash.RING)], axis=0).all()
    far = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    far = far[np.bitwise_count(far) > 3]
    assert not np.any([chain_holds(s, far) for s in range(simhash.RING)], axis=0).any()


def test_fingerprints_count_bits_in_parts(monkeypatch):
    text = " ".join(f"w{i}" for i in range(500))
    whole = fingerprint(shingle_hashes(text.encode()))
    monkeypatch.setattr(simhash, "COUNTED", 7)
    assert fingerprint(shingle_hashes(text.encode())) == whole
    assert whole & (2**64 - 1) == print_of(text)
    assert fingerprint(np.array([1, 2], dtype=np.uint64)) == 0  # half of the hashes are not over half


def test_no_rows_and_only_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert [r.component_id for r in simhash_duplicates(docs).collect()] == [None, None]
    assert simhash_duplicates(docs.limit(0)).count() == 0


def test_keys_of_all_fingerprints_are_not_broadcast(spark, monkeypatch):
    """Each fingerprint has up to 68 keys, but Spark sizes them as if there were one."""
    plans, real = {}, simhash.stored

    def stored(df, purpose):
        plans.setdefault(purpose, df._jdf.queryExecution().executedPlan().toString())
        return real(df, purpose)

    monkeypatch.setattr(simhash, "stored", stored)
    simhash_duplicates(spark.createDataFrame(made_texts(), "doc_id long, text string")).collect()
    assert "BroadcastExchange" not in plans["buckets"]
