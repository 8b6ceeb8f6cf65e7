"""Near-duplicate documents: MinHash bands propose, odd sketches estimate, full sets confirm.

The MinHash values of a document, each with its place, form a small set. Folding that set into a
bitmap of parities gives its odd sketch: the XOR of two sketches is the sketch of the symmetric
difference, so the number of its bits tells how many MinHash values differ, and with that the
similarity, most precisely where it is high.
"""

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pergamon.llm.graph import components, stored
from pergamon.llm.text import mix, multipliers, shingle_set, text_bytes

#: Words of a shingle, and the similarity from which documents are linked (percent).
SHINGLE = 5
LINK_PERCENT = 75

#: Bands and rows of a band. A pair at 0.75 is missed with (1 - 0.75**4)**28 < 2.5e-5.
BANDS = 28
ROWS = 4
SAMPLES = BANDS * ROWS

#: Bits of a sketch, in 64-bit words.
SKETCH_BITS = 512
SKETCH_WORDS = SKETCH_BITS // 64

#: Pairs are confirmed on their full sets if the sketch estimate is at least this. The estimate of a
#: pair at 0.75 has a standard error of about 0.05, so five of them lie between.
ESTIMATE_FLOOR = 0.50

#: Classes of a bucket that meet in one group at most, about; shingles of a stripe of their matrix.
BLOCK = 512
STRIPE = 4096

#: Up to so many classes are sent to the texts; beyond, the texts are shuffled to them.
BROADCAST_IDS = 1_000_000

_BY_SAMPLE = multipliers(SAMPLES, 5)
_BY_PLACE = multipliers(SAMPLES, 23)
_BY_BAND = multipliers(BANDS * ROWS, 41).reshape(BANDS, ROWS)

_SIGNATURE = "doc_id long, h1 long, h2 long, n_shingles long, set_hi long, set_lo long, bands array<long>, " + ", ".join(
    f"s{i} long" for i in range(SKETCH_WORDS))


def minhashes(shingles, block=256):
    """The smallest value of each of SAMPLES hash functions over the shingles."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), block):
        np.minimum(least, (shingles[i : i + block, None] * _BY_SAMPLE).min(axis=0), out=least)
    return least


def band_keys(samples):
    """One key for each band of each row of MinHash values."""
    rows = samples.reshape(len(samples), BANDS, ROWS)
    return mix((mix(rows) * _BY_BAND).sum(axis=2) + np.arange(BANDS, dtype=np.uint64))


def odd_sketches(samples):
    """The parity bitmap of each row of MinHash values, as SKETCH_WORDS numbers."""
    n = len(samples)
    bit = (mix(samples * _BY_PLACE) % np.uint64(SKETCH_BITS)).astype(np.int64)
    flat = bit + np.arange(n)[:, None] * SKETCH_BITS
    parity = np.bincount(flat.ravel(), minlength=n * SKETCH_BITS).astype(np.uint8) & 1
    return np.packbits(parity).view(np.int64).reshape(n, SKETCH_WORDS)


def estimate(differing_bits):
    """Similarity from the number of bits in which two odd sketches differ."""
    left = 1 - 2 * differing_bits / SKETCH_BITS
    return 1 + SKETCH_BITS / (4 * SAMPLES) * math.log(left) if left > 0 else -math.inf


def max_differing_bits(floor=ESTIMATE_FLOOR):
    return max(x for x in range(SKETCH_BITS // 2) if estimate(x) >= floor)


def _signatures(batches):
    for batch in batches:
        ids, h1, h2, texts = batch.columns
        sets = [shingle_set(texts[i].as_py(), SHINGLE) for i in range(len(texts))]
        counts = np.array([len(s) for s in sets], dtype=np.int64)
        digest = np.array([np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                           for s in sets]).reshape(-1, 2)
        samples = np.array([minhashes(s) for s in sets], dtype=np.uint64).reshape(-1, SAMPLES)
        bands = band_keys(samples).view(np.int64)
        sketch = odd_sketches(samples)
        offsets = pa.array(np.arange(0, (len(sets) + 1) * BANDS, BANDS, dtype=np.int32))
        columns = [ids, h1, h2, pa.array(counts), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()),
                   pa.ListArray.from_arrays(offsets, pa.array(bands.ravel()))]
        columns += [pa.array(sketch[:, i].copy()) for i in range(SKETCH_WORDS)]
        names = ["doc_id", "h1", "h2", "n_shingles", "set_hi", "set_lo", "bands"]
        yield pa.RecordBatch.from_arrays(columns, names + [f"s{i}" for i in range(SKETCH_WORDS)])


def _linked(batches):
    """The pairs whose full shingle sets are similar enough."""
    last = {}

    def shingles(key, data):
        if last.get("key") != key:
            last["key"], last["set"] = key, shingle_set(data, SHINGLE)
        return last["set"]

    for batch in batches:
        a, b = batch.column(0), batch.column(1)
        left, right = batch.column(2), batch.column(3)
        keep = np.zeros(len(a), dtype=bool)
        for i in range(len(a)):
            x = shingles(b[i].as_py(), right[i].as_py())
            y = shingle_set(left[i].as_py(), SHINGLE)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * common >= LINK_PERCENT * (len(x) + len(y) - common) and common > 0
        mask = pa.array(keep)
        yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])


def _texts_of(texts, lead, ids):
    """(id, text) of the given classes: one row each, however many rows repeat its document.

    A class is found by doc_id and hash of its first row, so rows without an id are found too. Few classes,
    which are counted, spare the shuffle of all texts.
    """
    wanted = stored(lead.select("id", "doc_id", "h1", "h2").join(ids, "id", "left_semi"), "ids")
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    same = (texts.h1 == few.h1) & (texts.h2 == few.h2) & texts.doc_id.eqNullSafe(few.doc_id)
    return texts.join(few, same).select("id", "text").dropDuplicates(["id"])


def _confirmed(texts, lead, pairs):
    """The pairs (a, b) that are links, by their full sets."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = stored(_texts_of(texts, lead, ids), "texts")
    left = wanted.select(F.col("id").alias("a"), F.col("text").alias("left"))
    right = wanted.select(F.col("id").alias("b"), F.col("text").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInArrow(_linked, "a long, b long")


def _alike_in_block(table):
    """(rows, columns, matrix): which classes of two blocks lie in different components and may be similar."""
    block, lo, hi = np.array(table.column("block")), table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    rows, columns = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    label = np.array(table.column("label"))
    sketch = np.array([np.array(table.column(f"s{i}")) for i in range(SKETCH_WORDS)]).T.view(np.uint64)
    sizes = np.array(table.column("n_shingles"))
    ok = label[rows][:, None] != label[columns]
    small, large = (f.outer(sizes[rows], sizes[columns]) for f in (np.minimum, np.maximum))
    ok &= 100 * small >= LINK_PERCENT * large
    bits = sum(np.bitwise_count(sketch[rows, i][:, None] ^ sketch[columns, i]).astype(int)
               for i in range(SKETCH_WORDS))
    return rows, columns, ok & (bits <= max_differing_bits())


def _open_in_block(table):
    """The classes of two blocks that have a possible link between them; only their texts are fetched."""
    rows, columns, ok = _alike_in_block(table)
    left = np.union1d(rows[ok.any(axis=1)], columns[ok.any(axis=0)])
    return table.select(["key", "id", "label", "block", "lo", "hi"]).take(left)


def _links_in_block(table):
    """Links between the classes of two blocks of a bucket that lie in different components."""
    rows, columns, ok = _alike_in_block(table)
    label, sizes = np.array(table.column("label")), np.array(table.column("n_shingles"))
    rows, columns = rows[ok.any(axis=1)], columns[ok.any(axis=0)]
    found_a, found_b = [], []
    if len(rows) and len(columns):
        used = np.unique(np.concatenate((rows, columns)))
        sets = [shingle_set(table.column("text")[int(i)].as_py(), SHINGLE) for i in used]
        owner = np.repeat(np.arange(len(used)), [len(s) for s in sets])
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        place = np.cumsum(times > 1) - 1  # a shingle of one class alone is in no intersection
        shared = times[column] > 1
        owner, column = owner[shared], place[column[shared]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        left, right = np.searchsorted(used, rows), np.searchsorted(used, columns)
        common = np.zeros((len(rows), len(columns)), dtype=np.float64)
        for start in range(0, int((times > 1).sum()), STRIPE):
            lo, hi = np.searchsorted(column, (start, start + STRIPE))
            stripe = np.zeros((len(used), STRIPE), dtype=np.float32)
            stripe[owner[lo:hi], column[lo:hi] - start] = 1
            common += stripe[left] @ stripe[right].T
        total = sizes[rows][:, None] + sizes[columns] - common
        link = (100 * common >= LINK_PERCENT * total) & (label[rows][:, None] != label[columns])
        i, j = np.nonzero(link)
        ids = np.array(table.column("id"))
        found_a, found_b = ids[rows[i]], ids[columns[j]]
    return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def _met_in_blocks(rest, texts, lead, sketches):
    """Links between classes of one bucket and different components.

    A bucket is dealt into blocks of about BLOCK classes, and each two blocks meet in one small group, so no
    task holds a whole bucket. Sketches meet first; texts go only to the groups in which their class may have a
    link. Groups return links only, found by products of incidence matrices.
    """
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = rest.withColumn("n", n).withColumn("block", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    dealt = dealt.select("key", "id", "label", "block", F.least("block", "other").alias("lo"),
                         F.greatest("block", "other").alias("hi"))
    open_ = stored(dealt.join(sketches, "id").groupBy("key", "lo", "hi").applyInArrow(
        _open_in_block, "key long, id long, label long, block int, lo int, hi int"), "open")
    wanted = stored(_texts_of(texts, lead, open_.select("id").distinct()).join(sketches, "id"), "texts")
    return open_.join(wanted, "id").groupBy("key", "lo", "hi").applyInArrow(
        _links_in_block, "a long, b long").distinct()


def _alike(x, y):
    """Sizes allow the similarity, and the sketches don't speak against it."""
    bits = sum((F.bit_count(x[f"s{i}"].bitwiseXOR(y[f"s{i}"])) for i in range(SKETCH_WORDS)), F.lit(0))
    sizes = F.least(x["n_shingles"], y["n_shingles"]) * 100 >= F.greatest(
        x["n_shingles"], y["n_shingles"]) * LINK_PERCENT
    return sizes & (bits <= max_differing_bits()), bits


def near_duplicates(docs, doc_id="doc_id", text="text"):
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept, per input row.

    Documents with equal sets are one class, known by the number of one of its rows; only classes are compared.
    Each bucket of a band links its classes to the one of them that meets most others; of a class's
    links the one with the best sketch estimate is confirmed on full sets. Buckets that still hold
    classes of different components are then checked in blocks, by estimate first and full sets
    next. No bucket is capped and no link between different texts is passed over, while a group of
    copies costs about one check a member.

    Null or empty texts, and those without words, have no shingles and stay alone. Rows are documents of their
    own, so repeated rows are copies, and rows with one doc_id but different texts are linked by their
    texts only. A null doc_id links like any other but names no component; a component without any
    doc_id has a null component_id, and all its rows are kept.
    """
    hashed = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(hashed).alias("h1"),
                        F.xxhash64(F.lit(1), hashed).alias("h2"), text_bytes(text).alias("text"))
    made = texts.mapInArrow(_signatures, _SIGNATURE).withColumn("row", F.monotonically_increasing_id())
    made = stored(made, "signatures")  # row numbers are fixed from here on
    named = made.filter("n_shingles > 0")
    classes = stored(named.groupBy("set_hi", "set_lo").agg(
        F.min("row").alias("id"), F.min("doc_id").alias("first")), "classes")
    lead = stored(named.withColumnRenamed("row", "id").join(classes.select("id"), "id", "left_semi"), "leads")
    sketches = lead.select("id", "n_shingles", *[f"s{i}" for i in range(SKETCH_WORDS)])

    rows = lead.select("id", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("id").alias("l"), F.max("id").alias("h"), F.count("*").alias("size"))
    buckets = stored(rows.join(shared.filter("l <> h").select("key", "size"), "key"), "buckets")
    met = buckets.groupBy("id").agg(F.sum("size").alias("met"))
    pivots = buckets.select("key", "id").join(met, "id").groupBy("key").agg(
        F.max(F.struct("met", "id")).alias("m"))
    buckets = stored(buckets.join(pivots.select("key", F.col("m.id").alias("pivot")), "key"), "buckets")

    star = buckets.filter("id <> pivot").select("id", "pivot").distinct()
    x, y = sketches.alias("x"), sketches.withColumnRenamed("id", "pivot").alias("y")
    ok, bits = _alike(*({c: F.col(f"{k}.{c}") for c in sketches.columns if c != "id"} for k in "xy"))
    star = star.join(x, "id").join(y, "pivot").filter(ok).select("id", "pivot", bits.alias("bits"))
    best = star.groupBy("id").agg(F.min(F.struct("bits", "pivot")).alias("m"))
    best = best.select(F.col("id").alias("a"), F.col("m.pivot").alias("b"))
    best = stored(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    links = stored(_confirmed(texts, lead, best), "confirmed")
    found = stored(components(links), "components")

    label = F.coalesce("component_id", "id")
    rest = buckets.select("key", "id").join(found, "id", "left").select("key", "id", label.alias("label"))
    mixed = rest.groupBy("key").agg(
        F.min("label").alias("l"), F.max("label").alias("h"), F.count("*").alias("size")).filter("l <> h")
    rest = stored(rest.join(mixed.select("key", "size"), "key"), "open")
    more = stored(_met_in_blocks(rest, texts, lead, sketches), "confirmed")
    if not more.isEmpty():
        found = stored(components(links.union(more)), "components")

    labelled = stored(classes.join(found, "id", "left").select("set_hi", "set_lo", "first", label.alias("label")), "labels")
    names = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    of_class = labelled.join(names, "label").select("set_hi", "set_lo", "component_id")
    out = named.select("doc_id", "n_shingles", "set_hi", "set_lo").join(of_class, ["set_hi", "set_lo"])
    out = out.select("doc_id", "n_shingles", "component_id").union(
        made.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
