import collections
import random
import re

import numpy as np
import pytest

from pergamon.llm import divergence
from pergamon.llm.divergence import gallop, merged, price, share, source_divergence, terms

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, top=200):
    """Every row of the result, with whole numbers and dense loops."""
    rows = [(t or "", lang or "", source or "") for t, lang, source in rows]
    documents, times = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    groups = collections.defaultdict(set)
    for text, lang, source in rows:
        words = TERM.findall(lowered(text))
        documents[lang].update(set(words))
        times[lang, source].update(words)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(w for w, n in documents[lang].items() if n >= 3)
        v = len(kept)

        def shares(count):
            n = sum(count[w] for w in kept)
            return {w: 1 + 10**9 * (count[w] + 1) // (n + v) for w in kept}

        whole = collections.Counter()
        for s in sources:
            whole.update(times[lang, s])
        q = shares(whole)
        p = {s: shares(times[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept)) for o in sources if o != s]
            over = [(w, (p[s][w] - q[w]) ** 2 // q[w]) for w in kept if times[lang, s][w] and p[s][w] > q[w]]
            for part, found, limit in (("pair", pairs, None), ("term", over, top)):
                ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out |= {(lang, s, part, item, value, i) for i, (item, value) in enumerate(ordered, 1)}
    return out


def made_rows(n=400, seed=7):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcÀé日") for _ in range(rng.randint(1, 3))) for _ in range(60)]
    rows = [(None, None, None), ("", "en", "none"), ("12 34", "en", "digits"), ("only here", "xx", "a"), (None, "xx", "b")]
    for _ in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["hot"] * 4 + ["a", "B", "ü", "", None])
        text = rng.choice([" ", "-", "1"]).join(rng.choice(words).upper() if rng.random() < 0.2 else rng.choice(words)
                                                  for _ in range(rng.randint(0, 40)))
        rows.append((text, lang, source))
    return rows + rows[-20:]


@pytest.mark.parametrize("shard,held", [(1 << 16, 400_000), (7, 5)])
def test_rows_are_those_of_dense_loops(spark, monkeypatch, shard, held):
    monkeypatch.setattr(divergence, "SHARD_TERMS", shard)
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    rows = made_rows()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr(
        "*", "1 as term", "2 as total", "3 as rank", "'x' as item")
    found = [tuple(r) for r in source_divergence(docs).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(rows)


def test_ranks_end_at_the_limit(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TOP_TERMS", 4)
    rows = made_rows(150, 8)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert {tuple(r) for r in source_divergence(docs).collect()} == brute(rows, 4)


def test_no_kept_words_and_no_rows(spark):
    docs = spark.createDataFrame([("a b", "en", "x"), ("c", "en", "y")], "text string, lang string, source string")
    assert sorted(map(tuple, source_divergence(docs).collect())) == [
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert source_divergence(docs.limit(0)).count() == 0


def test_galloping_finds_what_a_plain_search_finds(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(divergence, "GALLOP", 64)
    for n, m in ((0, 5), (5, 0), (1, 1), (10, 100_000), (300, 301), (4000, 50)):
        keys, ids = (np.unique(rng.integers(0, 200_000, k)) for k in (n, m))
        assert (gallop(keys, ids) == np.searchsorted(ids, keys)).all()


def test_merging_prices_every_used_word_both_ways():
    rng = random.Random(4)
    for _ in range(60):
        a, b = ({rng.randrange(40): rng.choice((1, 2, 9, 5000)) for _ in range(rng.choice((0, 3, 30)))} for _ in range(2))
        kept, n, m = 40, sum(a.values()), sum(b.values())
        arrays = [np.array(x, np.int64) for d in (a, b) for x in (sorted(d), [d[k] for k in sorted(d)])]
        used, forth, back = merged(arrays[0], arrays[1], n, arrays[2], arrays[3], m, kept)
        p = {w: 1 + 10**9 * (a.get(w, 0) + 1) // (n + kept) for w in {*a, *b}}
        q = {w: 1 + 10**9 * (b.get(w, 0) + 1) // (m + kept) for w in {*a, *b}}
        assert used == len(p)
        assert forth == sum((p[w] - q[w]) ** 2 // q[w] for w in p) and back == sum((q[w] - p[w]) ** 2 // p[w] for w in p)


def test_shares_of_very_large_counts_are_exact():
    counts = [0, 5, 10**10, 3 * 10**13]
    assert share(counts, 10**14, 7).tolist() == [1 + 10**9 * (c + 1) // (10**14 + 7) for c in counts]
    assert price(np.int64(10**9), np.int64(1)) == (10**9 - 1) ** 2


def test_terms_are_letters_and_all_beyond_ascii():
    assert terms("Don't x2Y ÀB日 _z".encode()) == [w.encode() for w in ("don", "t", "x", "y", "Àb日", "z")]
