"""Compressed vectors: exact top-k that reads codes of six bits a value instead of the vectors.

A vector is kept as whole numbers from -31 to 31, the step between them and the length of what this rounding lost. By the
Cauchy-Schwarz inequality the score of the code is off by that length at most, so it excludes a row
for certain or not at all. What is left, little more than k rows a query, gets its score from the vectors
by the one formula of the exact search.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from pergamon import fixed_values as V
from pergamon.operators import search
from pergamon.operators.skew import keyed_join
from pergamon.session import shared_folder

LEVELS = 31
_CODES = "id long, same long, code binary, step float, lost float"


def encode(vectors):
    """(packed codes, step, length of the loss) of vectors of unit length; four codes take three bytes."""
    n, dimension = vectors.shape
    step = (np.abs(vectors).max(axis=1, initial=0) / LEVELS).astype(np.float32)
    scaled = np.divide(vectors, step[:, None], out=np.zeros_like(vectors), where=step[:, None] > 0)
    codes = np.clip(np.rint(scaled), -LEVELS, LEVELS)
    lost = np.sqrt(((vectors - codes * step[:, None].astype(np.float64)) ** 2).sum(axis=1))
    lost = np.nextafter(lost.astype(np.float32), np.float32(np.inf))  # never less than what was lost
    padded = np.full((n, -(-dimension // 4) * 4), LEVELS, np.uint32)
    padded[:, :dimension] = (codes + LEVELS).astype(np.uint32)
    four = padded.reshape(n, -1, 4)
    packed = four[:, :, 0] | four[:, :, 1] << 6 | four[:, :, 2] << 12 | four[:, :, 3] << 18
    return packed.view(np.uint8).reshape(n, -1, 4)[:, :, :3].reshape(n, -1), step, lost


def decode(packed, step, dimension):
    """The vectors that the codes stand for, as float64."""
    three = packed.reshape(len(packed), -1, 3).astype(np.uint32)
    word = three[:, :, 0] | three[:, :, 1] << 8 | three[:, :, 2] << 16
    codes = np.stack([word >> s & 63 for s in (0, 6, 12, 18)], axis=2).reshape(len(packed), -1)[:, :dimension]
    return (codes.astype(np.float64) - LEVELS) * step.astype(np.float64)[:, None]


def vector_codes(index):
    """id, same, code, step and lost of every row with a usable vector; one pass, nothing is shuffled.

    `same` is a hash of the vector: rows with equal ones count as copies. The table is meant to be stored
    beside the index and grows with new rows only.
    """
    rows = index.where("chunk_embedding IS NOT NULL").select(
        "id", F.xxhash64("chunk_embedding").alias("same"), "chunk_embedding")

    def coded(batches):
        expected = None
        for batch in batches:
            if not batch.num_rows:
                continue
            expected = search._check_lengths(batch.column(0).to_pylist(), batch.column(2), expected)
            step = max(1, search._CELLS // max(1, expected))
            for i in range(0, batch.num_rows, step):
                vectors = search._matrix(batch.column(2).slice(i, step))
                usable = np.flatnonzero(np.isfinite(vectors).all(axis=1))
                packed, steps, lost = encode(search._unit(vectors[usable]))
                some = pa.array(usable + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(some), batch.column(1).take(some), pa.array([p.tobytes() for p in packed], pa.binary()),
                     pa.array(steps, pa.float32()), pa.array(lost, pa.float32())],
                    ["id", "same", "code", "step", "lost"])

    return rows.mapInArrow(coded, _CODES)


class _Bounded:
    """Rows that may be among the k best of a query: the bound of their score isn't below k others' least score."""

    def __init__(self, queries, k):
        self.k = k
        self.floor = np.full(queries, -np.inf)
        self.held = [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.float64, np.float64)]

    def add(self, query, ids, same, least, most):
        keep = most >= self.floor[query]
        if not keep.any():
            return
        parts = (query, ids, same, least, most)
        self.held = [np.concatenate([old, new[keep]]) for old, new in zip(self.held, parts)]
        query, ids, same = self.held[:3]
        # Of copies of one vector the k smallest ids are enough.
        self._keep(*self._places((ids, same, query), query, same))
        query, least = self.held[0], self.held[3]
        order, place = self._places((-least, query), query)
        last = order[place == self.k - 1]
        self.floor[query[last]] = least[last]
        above = self.held[4] >= self.floor[self.held[0]]
        self.held = [column[above] for column in self.held]

    def _places(self, by, *groups):
        """The order by some keys, and each row's place in its group."""
        order = np.lexsort(by)
        changed = np.zeros(len(order), bool)
        changed[:1] = True
        for group in groups:
            changed[1:] |= np.diff(group[order]) != 0
        starts = np.flatnonzero(changed)
        return order, np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))

    def _keep(self, order, place):
        order = order[place < self.k]
        self.held = [column[order] for column in self.held]


def _candidates(codes, few, k):
    """(query_id, id, least, most) of the rows of each task that its codes do not exclude."""
    shared = codes.sparkSession.sparkContext.broadcast(few)

    def bounded(batches):
        asked = search._Asked(shared.value, False, None, "cosine")
        best = _Bounded(len(asked.ids), k)
        for batch in batches:
            if not batch.num_rows or not len(asked.ids):
                continue
            step = max(1, search._CELLS // max(asked.vectors.shape))
            for i in range(0, batch.num_rows, step):
                some = batch.slice(i, step)
                width = -(-asked.dimension // 4) * 3
                packed = np.frombuffer(b"".join(some.column(2).to_pylist()), np.uint8).reshape(-1, width)
                near = decode(packed, some.column(3).to_numpy(), asked.dimension) @ asked.vectors.T
                slack = (some.column(4).to_numpy().astype(np.float64) + search.SLACK)[:, None]
                floor = best.floor
                if len(near) > k:
                    kth = len(near) - k
                    floor = np.maximum(floor, np.partition(near - slack, kth, axis=0)[kth])
                rows, queries = np.nonzero(near + slack >= floor)
                ids, same = some.column(0).to_numpy(), some.column(1).to_numpy()
                score, off = near[rows, queries], slack[rows, 0]
                best.add(queries, ids[rows], same[rows], score - off, score + off)
        query, ids, _, least, most = best.held
        yield from pa.table({"query_id": pa.array(asked.ids[query], pa.int64()), "id": pa.array(ids, pa.int64()),
                             "least": pa.array(least), "most": pa.array(most)}).to_batches()

    return codes.mapInArrow(bounded, "query_id long, id long, least double, most double")


def vector_topk_codes(codes, index, queries, k=V.TOP_K, max_queries=search.MAX_QUERIES):
    """As `vector_topk` by the cosine, row for row, from the codes of `vector_codes` and the vectors of few rows.

    The codes are read once, for broadcast queries; what they leave is bounded by k and the loss, and copies of a
    vector by k a task. Only these ids meet the index. With more queries than the bound the vectors
    themselves are searched in blocks. The first pass runs when the search is built.
    """
    shared_folder(index.sparkSession)
    asked, few = search.asked_once(queries, False, max_queries)
    if few is None:
        return search.vector_topk(index, asked, k, max_queries=max_queries)
    left = _candidates(codes, few, k).checkpoint()
    by_least = Window.partitionBy("query_id").orderBy(F.col("least").desc(), "id")
    floors = left.withColumn("_place", F.row_number().over(by_least)).where(F.col("_place") <= k).groupBy("query_id").agg(
        F.min("least").alias("_floor"), F.count("*").alias("_n"))
    pairs = keyed_join(left, floors, ["query_id"], "inner").where(
        (F.col("_n") < k) | (F.col("most") >= F.col("_floor"))).select("query_id", "id")
    found = keyed_join(pairs, index.select("id", "chunk_embedding"), ["id"], "inner")
    shared = index.sparkSession.sparkContext.broadcast(few)

    def scored(batches):
        asked = search._Asked(shared.value, False, None, "cosine")
        order = np.argsort(asked.ids, kind="stable")
        for batch in batches:
            step = max(1, search._CELLS // max(1, asked.dimension or 1))
            for i in range(0, batch.num_rows, step):
                some = batch.slice(i, step)
                query = order[np.searchsorted(asked.ids[order], some.column(0).to_numpy())]
                vectors = search._unit(search._matrix(some.column(2)))
                score = asked._exact(vectors, asked.vectors[query])
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(score), pa.array(np.round(score, search.DECIMALS) + 0.0)],
                    ["query_id", "id", "score", "place"])

    hits = found.select("query_id", "id", "chunk_embedding").mapInArrow(scored, search._HITS)
    return search.ranked(hits, k, "cosine")
