"""Near-duplicates by SimHash: pigeonring chains propose, the full Hamming distance confirms.

Cut fingerprints of 64 bits into RING segments that form a ring. If two fingerprints differ in at most LIMIT bits,
some segment begins a chain in which the first l segments differ in at most l * LIMIT / RING bits together,
for every l. With 4 segments and 3 bits these budgets are 0, 1, 2 and 3: the first segment is equal, the first
two differ in one bit at most, and so on around the ring. The first two segments are the key of a join: of two
keys that differ in one bit of the second segment one has an even number of bits there, so only even
ones are sent to all their neighbours, and keys of 32 bits keep buckets small. The longer chains are
checked on what meets there, and the full distance on what is left.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from pergamon.llm.graph import components, stored
from pergamon.llm.text import text_bytes

SHINGLE = 3
HASH_SEED = 42

#: Bits of a fingerprint, segments of the ring and bits of each, and differing bits of a link.
BITS = 64
RING = 4
SEGMENT = BITS // RING
LIMIT = 3

#: Hashes whose bits are counted at a time.
COUNTED = 1 << 14

#: Members of a bucket that meet in one group at most, about.
BLOCK = 2048

_MASK = (1 << SEGMENT) - 1


def shingle_hashes(data, width=SHINGLE, seed=HASH_SEED):
    """XXH64 of each window of `width` words joined by spaces, of the whole sequence if it is shorter."""
    words = data.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[min(width, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], seed) for a, b in zip(starts, ends)], dtype=np.uint64)


def fingerprint(hashes):
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), COUNTED):
        part = np.ascontiguousarray(hashes[i : i + COUNTED]).view(np.uint8).reshape(-1, BITS // 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def _fingerprints(batches):
    for batch in batches:
        made = [fingerprint(shingle_hashes(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.int64())], ["doc_id", "fp"])


def _segment(value, i):
    """Segment i of the ring, as a number."""
    return F.shiftrightunsigned(value, SEGMENT * (i % RING)).bitwiseAND(F.lit(_MASK))


def _keys(prints):
    """(start, key, own, fp): the first two segments of each chain, and for even second segments their neighbours."""
    def of_chain(i):
        first, second = _segment(F.col("fp"), i), _segment(F.col("fp"), i + 1)
        head = F.shiftleft(first, SEGMENT)
        near = F.transform(F.array(*[F.lit(1 << b).cast("long") for b in range(SEGMENT)]),
                           lambda bit: F.struct(head.bitwiseOR(second.bitwiseXOR(bit)).alias("key"), F.lit(False).alias("own")))
        alone = F.array(F.struct(head.bitwiseOR(second).alias("key"), F.lit(True).alias("own")))
        even = F.bit_count(second) % 2 == 0
        return F.transform(F.when(even, F.concat(alone, near)).otherwise(alone), lambda x: F.struct(
            F.lit(i).alias("start"), x["key"].alias("key"), x["own"].alias("own")))

    chains = F.concat(*[of_chain(i) for i in range(RING)])
    return prints.select("fp", F.explode(chains).alias("k")).select("k.start", "k.key", "k.own", "fp")


def _chain_holds(start, a, b):
    """Every prefix of the chain from `start` keeps its budget: l segments differ in at most l * LIMIT / RING bits."""
    differ = a.bitwiseXOR(b)
    each = [F.bit_count(_segment(differ, i)) for i in range(RING)]
    found = F.lit(False)
    for s in range(RING):
        spent, holds = F.lit(0), start == s
        for l in range(1, RING + 1):
            spent = spent + each[(s + l - 1) % RING]
            holds = holds & (spent <= l * LIMIT // RING)
        found = found | holds
    return found


def chain_holds(start, differ):
    """As `_chain_holds`, on arrays of differing bits."""
    holds, spent = np.ones(differ.shape, dtype=bool), np.zeros(differ.shape, dtype=np.int64)
    for l in range(1, RING + 1):
        segment = (differ >> np.uint64(SEGMENT * ((start + l - 1) % RING))) & np.uint64(_MASK)
        spent += np.bitwise_count(segment)
        holds &= spent <= l * LIMIT // RING
    return holds


def _links_in_block(table):
    """One link for each two labels that meet between two blocks of a bucket."""
    start = table.column("start")[0].as_py()
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    block, own = np.array(table.column("block")), np.array(table.column("own"))
    label, prints = np.array(table.column("label")), np.array(table.column("fp"))
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    found = {}
    for i in left:
        others = right[(label[right] != label[i]) & (own[right] | own[i])]
        differ = (prints[others] ^ prints[i]).view(np.uint64)
        others, differ = others[keep := chain_holds(start, differ)], differ[keep]
        for j in others[np.bitwise_count(differ) <= LIMIT]:
            pair = (min(label[i], label[j]), max(label[i], label[j]))
            found.setdefault(pair, (min(prints[i], prints[j]), max(prints[i], prints[j])))
    ends = list(found.values())
    return pa.table({"a": pa.array([int(a) for a, _ in ends], pa.int64()),
                     "b": pa.array([int(b) for _, b in ends], pa.int64())})


def _met_in_blocks(rest):
    """Links between members of one bucket whose labels differ; blocks of a bucket meet in pairs, in small groups."""
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = rest.withColumn("n", n).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    dealt = dealt.select("start", "key", "own", "fp", "label", "block", F.least("block", "other").alias("lo"),
                         F.greatest("block", "other").alias("hi"))
    return dealt.groupBy("start", "key", "lo", "hi").applyInArrow(_links_in_block, "a long, b long").distinct()


def linked_fingerprints(prints):
    """(fp, component) of every fingerprint that has another one within LIMIT bits, from distinct fingerprints.

    Each bucket links its members to one of its own; labels are the components of these links. Buckets that
    still hold several labels are checked in blocks of BLOCK members, which give links between
    labels only. No bucket is capped and no link between components is passed over.
    """
    rows = _keys(prints)
    met = rows.groupBy("start", "key").agg(
        F.count("*").alias("size"), F.max(F.when(F.col("own"), F.col("fp"))).alias("pivot"))
    met = met.filter("size > 1 and pivot is not null")
    # Spark takes exploded rows for as few as they come from, and would send them all through the driver.
    buckets = stored(rows.hint("merge").join(met, ["start", "key"]), "buckets")

    a, b = F.col("fp"), F.col("pivot")
    star = buckets.filter((a != b) & _chain_holds(F.col("start"), a, b) & (F.bit_count(a.bitwiseXOR(b)) <= LIMIT))
    links = stored(star.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links")
    found = stored(components(links), "components")

    label = F.coalesce("component_id", "fp").alias("label")
    rest = buckets.join(found.withColumnRenamed("id", "fp"), "fp", "left").select(
        "start", "key", "own", "fp", "size", label)
    open_ = rest.groupBy("start", "key").agg(
        F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h").select("start", "key")
    rest = stored(rest.join(open_, ["start", "key"], "left_semi"), "open")
    more = stored(_met_in_blocks(rest), "links")
    if not more.isEmpty():
        found = stored(components(links.union(more)), "components")
    return found.select(F.col("id").alias("fp"), F.col("component_id").alias("component"))


def simhash_duplicates(docs, doc_id="doc_id", text="text"):
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable by links) per input row.

    Rows with equal fingerprints are one class and only classes are compared, so copies cost nothing more. Null and
    empty texts, and those without words, have fingerprint zero, which links like any other. A null doc_id takes
    part with its text; component_id is null only where no id is reachable. Repeated rows are copies, other
    columns are left out, and no rows give none. Texts are read once and not shuffled; classes carry 16 bytes.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    made = stored(texts.mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    classes = stored(made.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    found = linked_fingerprints(classes.select("fp"))
    linked = classes.join(found, "fp")
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    named = linked.select("fp", "component").join(least, "component").select("fp", "component_id")
    label = F.coalesce("component_id", "first").alias("component_id")
    of_class = stored(classes.join(named, "fp", "left").select("fp", label), "labels")
    return made.join(of_class, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
