"""How far the word use of sources differs: pairs of sorted sparse arrays are merged, each pair a task.

Sources of a language that have word counts meet in pairs, a shard of the words at a time. Both bring their (term id,
count) pairs sorted; galloping through the longer array with the shorter one tells which words both, only one or none
of them use, and every word is priced both ways. Words that neither uses all have the same price, so they
are only counted.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from pergamon.llm.graph import stored
from pergamon.llm.text import text_bytes

#: A word is kept if so many documents of its language have it; a rank beyond TOP_TERMS isn't listed.
MIN_DOCUMENTS = 3
TOP_TERMS = 200

#: Probabilities are whole numbers of so many parts.
SCALE = 1_000_000_000

#: Words of a shard, about; different words that a task counts before it hands its counts on.
SHARD_TERMS = 1 << 16
HELD_TERMS = 400_000

#: Keys that gallop together, and counts whose shares are tabled.
GALLOP = 1024
TABLE = 1 << 12

_UPPER = range(ord("A"), ord("Z") + 1)
_LOWER = range(ord("a"), ord("z") + 1)
_TERM_BYTES = bytes(c + 32 if c in _UPPER else c if c in _LOWER or c >= 0x80 else 32 for c in range(256))


def terms(data):
    """Runs of A-Z, a-z and anything outside ASCII, with only A-Z lower-cased, as bytes."""
    return data.translate(_TERM_BYTES).split()


def _counts(batches):
    """(lang, source, term, documents, times), added up over what a task can hold."""
    held = {}

    def table():
        parts = []
        for (lang, source), (documents, times) in held.items():
            n = len(times)
            words = list(times)
            parts.append(pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(words, pa.binary()),
                 pa.array([documents[w] for w in words], pa.int64()), pa.array(list(times.values()), pa.int64())],
                ["lang", "source", "term", "documents", "times"]))
        return parts

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            documents, times = held.setdefault((lang, source), (Counter(), Counter()))
            words = terms(text.as_py())
            times.update(words)
            documents.update(set(words))
        if sum(len(times) for _, times in held.values()) >= HELD_TERMS:
            yield from table()
            held.clear()
    yield from table()


def share(count, total, kept):
    """1 + floor(SCALE * (count + 1) / (total + kept)), exactly, for whole numbers.

    Small counts, which most are, take theirs from a table.
    """
    count, size = np.asarray(count, dtype=np.int64), int(total) + int(kept)
    if not len(count):
        return count
    top = int(count.max())
    if top >= TABLE:
        large = count >= TABLE
        out = np.empty(len(count), dtype=np.int64)
        out[~large] = share(count[~large], total, kept)
        out[large] = [1 + SCALE * (c + 1) // size for c in count[large].tolist()]
        return out
    table = 1 + SCALE * np.arange(1, top + 2, dtype=np.int64) // size
    return table[count]


def price(p, q):
    """floor((p - q)**2 / q), exactly: shares are below 2**31, so squares fit."""
    return (p - q) * (p - q) // q


def priced(p, q, times=1):
    """Prices of some words both ways, `times` each, added up."""
    square = (p - q) * (p - q)
    return int(np.sum(square // q * times)), int(np.sum(square // p * times))


def _alone(counts, total, kept, other):
    """Prices of words that only one side uses, both ways: equal small counts are priced once."""
    values, times = counts, 1
    if len(counts) and int(counts.max()) < TABLE:
        times = np.bincount(counts)
        values = np.flatnonzero(times)
        times = times[values]
    return priced(share(values, total, kept), other, times)


def gallop(keys, ids):
    """For each of some sorted keys the first place in sorted `ids` that isn't below it.

    From the place of the last keys the step doubles until it passes the next GALLOP keys, which are then looked up
    in that stretch alone: the time grows with the keys and the logarithm of the gaps between them.
    """
    places, at = np.empty(len(keys), dtype=np.int64), 0
    for i in range(0, len(keys), GALLOP):
        some = keys[i : i + GALLOP]
        step = GALLOP
        while at + step < len(ids) and ids[at + step] < some[-1]:
            step *= 2
        places[i : i + GALLOP] = at + np.searchsorted(ids[at : at + step + 1], some)
        at = int(places[min(i + GALLOP, len(keys)) - 1])
    return places


def merged(ids_a, counts_a, total_a, ids_b, counts_b, total_b, kept):
    """(words of a or b, price of a against b, price of b against a) over the words that a or b uses."""
    if len(ids_a) > len(ids_b):
        union, back, forth = merged(ids_b, counts_b, total_b, ids_a, counts_a, total_a, kept)
        return union, forth, back
    at = gallop(ids_a, ids_b)
    both = at < len(ids_b)
    both[both] = ids_b[at[both]] == ids_a[both]
    only_b = np.ones(len(ids_b), dtype=bool)
    only_b[at[both]] = False
    p0, q0 = share([0], total_a, kept)[0], share([0], total_b, kept)[0]
    shared = priced(share(counts_a[both], total_a, kept), share(counts_b[at[both]], total_b, kept))
    of_a = _alone(counts_a[~both], total_a, kept, q0)
    of_b = _alone(counts_b[only_b], total_b, kept, p0)
    forth, back = shared[0] + of_a[0] + of_b[1], shared[1] + of_a[1] + of_b[0]
    return len(ids_a) + len(ids_b) - int(both.sum()), forth, back


_PAIR = "lang string, lo string, hi string, kept long, lo_total long, hi_total long, used long, forth long, back long"


def _priced_pair(left, right):
    """One row for a pair and a shard: the words used by either, and their prices both ways."""
    one = left if left.num_rows else right
    lang, lo, hi, kept, lo_total, hi_total = (
        one.column(c)[0].as_py() for c in ("lang", "lo", "hi", "kept", "lo_total", "hi_total"))
    sides = []
    for side in (left, right):
        filled = side.num_rows > 0
        sides.append([np.array(side.column(c)[0].as_py() if filled else [], dtype=np.int64) for c in ("ids", "counts")])
    found = merged(*sides[0], lo_total, *sides[1], hi_total, kept)
    return pa.Table.from_pylist([dict(zip(
        ("lang", "lo", "hi", "kept", "lo_total", "hi_total", "used", "forth", "back"),
        (lang, lo, hi, kept, lo_total, hi_total, *found)))], _SCHEMA)


_SCHEMA = pa.schema([("lang", pa.string()), ("lo", pa.string()), ("hi", pa.string()), *(
    (c, pa.int64()) for c in ("kept", "lo_total", "hi_total", "used", "forth", "back"))])


def _share(count, total, kept):
    """`share` as a column; the product may need more than 64 bits."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", top, (total + kept).cast("decimal(20,0)"))


def _price(p, q):
    return F.call_function("div", (p - q) * (p - q), q)


def _ranked(rows, limit=None):
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= limit) if limit else ranked


def _kept_words(counts):
    """The kept words of each language: lang, term, shard, tid and lang_times.

    A word's id is its place in its shard, which is chosen by hash and holds about SHARD_TERMS words of the
    language that keeps most.
    """
    words = counts.groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("times").alias("lang_times"))
    words = stored(words.filter(F.col("documents") >= MIN_DOCUMENTS).select("lang", "term", "lang_times"), "words")
    most = words.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    shards = max(1, -(-most // SHARD_TERMS))
    by_term = Window.partitionBy("lang", "shard").orderBy("term")
    return words.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int")).withColumn(
        "tid", F.row_number().over(by_term))


def _pairs(kept, groups):
    """Prices of every unordered pair of sources of a language, over all words the language keeps."""
    arrays = kept.groupBy("lang", "shard", "source").agg(
        F.array_sort(F.collect_list(F.struct("tid", "times"))).alias("words"))
    arrays = stored(arrays.select(
        "lang", "shard", "source", F.col("words.tid").alias("ids"), F.col("words.times").alias("counts")), "arrays")
    other = groups.select("lang", F.col("source").alias("other"), F.col("total").alias("other_total"))
    met = arrays.join(groups, ["lang", "source"]).join(other, "lang").filter("source <> other")
    columns = ("lang", "lo", "hi", "shard", "kept", "lo_total", "hi_total", "ids", "counts")
    left = met.filter("source < other").select(
        "*", F.col("source").alias("lo"), F.col("other").alias("hi"), F.col("total").alias("lo_total"),
        F.col("other_total").alias("hi_total")).select(*columns)
    right = met.filter("source > other").select(
        "*", F.col("other").alias("lo"), F.col("source").alias("hi"), F.col("other_total").alias("lo_total"),
        F.col("total").alias("hi_total")).select(*(F.col(c).alias(c) for c in columns))
    key = ("lang", "lo", "hi", "shard")
    priced = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_priced_pair, _PAIR)
    summed = priced.groupBy("lang", "lo", "hi").agg(*[F.sum(c).alias(c) for c in ("used", "forth", "back")])

    a = groups.select("lang", F.col("source").alias("lo"), "kept", F.col("total").alias("lo_total"))
    pairs = a.join(groups.select("lang", F.col("source").alias("hi"), F.col("total").alias("hi_total")), "lang")
    pairs = pairs.filter("lo < hi").join(summed, ["lang", "lo", "hi"], "left")
    absent = F.col("kept") - F.coalesce("used", F.lit(0))
    p0, q0 = (F.when(F.col("kept") > 0, _share(F.lit(0), F.col(t), F.col("kept"))).otherwise(F.lit(1))
              for t in ("lo_total", "hi_total"))
    forth = F.coalesce("forth", F.lit(0)) + absent * _price(p0, q0)
    back = F.coalesce("back", F.lit(0)) + absent * _price(q0, p0)
    both = F.array(F.struct(F.col("lo").alias("source"), F.col("hi").alias("item"), forth.alias("value")),
                   F.struct(F.col("hi").alias("source"), F.col("lo").alias("item"), back.alias("value")))
    return pairs.select("lang", F.explode(both).alias("x")).select("lang", "x.*")


def source_divergence(docs, text="text", lang="lang", source="source"):
    """lang, source, part, item, value and rank: what sets a source's word use apart from its language's others.

    Part `pair` has every other source of the language, by how far the source's shares lie from the other's, and part
    `term` the words that the source uses more than its language, TOP_TERMS at most. The smoothed share p
    of a word is a whole number of SCALE parts and a word's price is floor((p - q)**2 / q); all arithmetic
    is on whole numbers, and exact. Words that fewer than MIN_DOCUMENTS documents of the language have don't count.

    Null text, language and source are empty strings. A source without words is a source like any other; a language
    without kept words prices all pairs at 0. Equal values rank by item, by bytes. Rows are documents, repeated
    ones too; other columns are left out and no rows give none. Counts combine in the tasks before they are
    shuffled, so a source with any share of the rows is spread; a pair is merged by shards of bounded size.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), text_bytes(text).alias("text"))
    counts = rows.mapInArrow(_counts, "lang string, source string, term binary, documents long, times long")
    counts = stored(counts.groupBy("lang", "source", "term").agg(
        F.sum("documents").alias("documents"), F.sum("times").alias("times")), "term-counts")
    words = stored(_kept_words(counts), "words")
    kept = stored(counts.drop("documents").join(words, ["lang", "term"]), "kept")

    of_lang = words.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_times").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("times").alias("total"))
    groups = rows.select("lang", "source").distinct().join(of_lang, "lang", "left").join(
        totals, ["lang", "source"], "left").select("lang", "source", *(
            F.coalesce(c, F.lit(0)).alias(c) for c in ("kept", "lang_total", "total")))
    groups = stored(groups, "groups")

    pairs = _ranked(_pairs(kept, groups)).withColumn("part", F.lit("pair"))
    p = _share(F.col("times"), F.col("total"), F.col("kept")).alias("p")
    q = _share(F.col("lang_times"), F.col("lang_total"), F.col("kept")).alias("q")
    over = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", p, q).filter("p > q")
    over = over.select("lang", "source", F.col("term").cast("string").alias("item"), _price(F.col("p"), F.col("q")).alias("value"))
    listed = _ranked(over, TOP_TERMS).withColumn("part", F.lit("term"))
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.select(*columns).union(listed.select(*columns))
