"""Top-k vector search, exact and approximate, with per-query document filters.

Two physical forms give the same rows. With few queries they are broadcast and the index is read
once, without a shuffle; every task keeps its best k per query. With more queries than the bound,
index and queries are shuffled in blocks of limited size. Neither form emits the pairs it scores.
"""

import copy

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pergamon import fixed_values as V
from pergamon.functions.vectors import hyperplanes, signatures
from pergamon.operators.skew import keyed_join
from pergamon.session import shared_folder, shuffle_files_removed

MAX_QUERIES = 4096
MAX_QUERY_BYTES = 128 << 20
BLOCK_ROWS = 20_000
BLOCK_QUERIES = 8_192
_CELLS = 2_000_000
# Queries of a product, and rows of a task's first one; a product that fits into the caches is faster than a wide one.
_TILE = 1024
_FIRST_ROWS = 256
# Rows of a slice that may be hits, as multiples of k for each query, before the slice's own best are looked for.
_LOOSE = 4
# Names of filtered rows for each slice up to which rows are scored name by name, and not by slices under a mask.
_NAMES = 2

# Blocks of rows that every query meets, and the bytes of a side from which there are more. Queries have one block up to there.
MOST_BLOCKS = 8
MANY_BUCKETS_MOST = 3  # the same where buckets are tasks already
GROUP_BYTES = 64 << 20

# Bits of the map of hits' ids at most, as a power of two: 32 MB.
MAP_BITS = 28

# Scores are ranked at so many decimals; products are trusted this far when they exclude a row.
DECIMALS = 9
SLACK = 4e-9
_HITS = "query_id long, id long, score double, place double"


def _matrix(column):
    """Rows of a list column as float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _check_lengths(ids, column, expected=None):
    """Raise with the id of the first vector that is longer or shorter than expected."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if not len(lengths):
        return expected
    expected = int(lengths[0]) if expected is None else expected
    wrong = np.flatnonzero(lengths != expected)
    if len(wrong):
        at = int(wrong[0])
        raise ValueError(f"vector {ids[at]} has {int(lengths[at])} values, not {expected}")
    return expected


def _unit(matrix):
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


class _Best:
    """The k best hits per query seen so far; equal scores go to the smaller id.

    A hit's place is its score rounded to DECIMALS, here and nowhere else, so equal vectors tie.
    """

    def __init__(self, query_ids, k):
        self.query_ids, self.k = query_ids, k
        self.held = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.float64, np.float64, np.int32))
        self.floor = np.full(len(query_ids), -np.inf)
        self.waiting, self.n_waiting = [], 0

    def add(self, query, ids, score, tag=0):
        """Hits wait until they are as many as those that are held, so that these are not sorted for each slice."""
        places = np.round(score, DECIMALS) + 0.0
        keep = np.flatnonzero(places >= self.floor[query])
        if not len(keep):
            return
        tags = tag[keep] if isinstance(tag, np.ndarray) else np.full(len(keep), tag, np.int32)
        self.waiting.append((query[keep], ids[keep], score[keep], places[keep], tags))
        self.n_waiting += len(keep)
        if self.n_waiting >= max(len(self.held[0]), self.k):
            self._settled()

    def _settled(self):
        if not self.waiting:
            return self.held
        columns = [np.concatenate(parts) for parts in zip(self.held, *self.waiting)]
        self.waiting, self.n_waiting = [], 0
        query, ids, _, places, _ = columns
        order = np.lexsort((ids, -places, query))
        query = query[order]
        starts = np.r_[0, np.flatnonzero(np.diff(query)) + 1]
        place = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
        order, place = order[place < self.k], place[place < self.k]
        self.held = tuple(column[order] for column in columns)
        last = place == self.k - 1
        self.floor[self.held[0][last]] = self.held[3][last]
        return self.held

    query, id, score, place, tag = (property(lambda self, i=i: self._settled()[i]) for i in range(5))

    def table(self, tag=None):
        tags = {} if tag is None else {tag: pa.array(self.tag, pa.int32())}
        return pa.table({
            "query_id": pa.array(self.query_ids[self.query], pa.int64()),
            "id": pa.array(self.id, pa.int64()),
            "score": pa.array(self.score, pa.float64()),
            "place": pa.array(self.place, pa.float64()),
            **tags,
        })


class _Asked:
    """Queries as a task needs them: unit vectors, buckets, and who selects which file."""

    def __init__(self, table, filtered, planes, metric):
        self.cosine = metric == "cosine"
        dimension = _check_lengths(table["query_id"].to_pylist(), table["query_vector"])
        self.dimension = dimension
        vectors = _matrix(table["query_vector"])
        usable = np.isfinite(vectors).all(axis=1) if len(vectors) else np.zeros(0, bool)
        if not usable.all():
            table, vectors = table.filter(pa.array(usable)), vectors[usable]
        self.ids = table["query_id"].to_numpy()
        self.vectors = _unit(vectors) if self.cosine else vectors
        self.short = self.vectors.astype(np.float32) if self.cosine else None
        self.squares = (self.vectors ** 2).sum(axis=1)
        self.planes = planes
        self.sides = None if planes is None else signatures(self.vectors, planes)
        self.filtered = filtered
        if filtered:
            chosen = table["selected_documents"].to_pylist()
            self.everything = np.array([not names for names in chosen], bool)
            self.names = pa.array(sorted({n for c in chosen for n in c or []}), pa.string())
            place = {n: i for i, n in enumerate(self.names.to_pylist())}
            pairs = sorted({(place[n], i) for i, names in enumerate(chosen) for n in names or []})
            # who selects a name: the stretch of the pairs that begins with it
            self.pairs = np.array(pairs, np.int64).reshape(-1, 2)
        self.of = np.arange(len(self.ids))

    def part(self, queries):
        """These queries alone, given by their places, for rows that only they may find."""
        some = copy.copy(self)
        some.planes, some.of = None, self.of[queries]
        some.vectors, some.squares = self.vectors[queries], self.squares[queries]
        some.short = self.short[queries] if self.cosine else None
        if self.filtered:
            some.everything = self.everything[queries]
            place = np.full(len(self.everything), -1)
            place[queries] = np.arange(len(queries))
            kept = self.pairs[place[self.pairs[:, 1]] >= 0]
            some.pairs = np.stack([kept[:, 0], place[kept[:, 1]]], axis=1)
            some.pairs = some.pairs[np.lexsort((some.pairs[:, 1], some.pairs[:, 0]))]
        return some

    def _tile(self, start, end):
        """Queries that follow each other; who selects them is left out."""
        some = copy.copy(self)
        some.of, some.vectors, some.squares = self.of[start:end], self.vectors[start:end], self.squares[start:end]
        some.short = self.short[start:end] if self.cosine else None
        return some

    def _near(self, vectors):
        """Scores of all rows and queries by one product, and how far they may be off: a number, or one a row.

        Cosines are multiplied in single precision: of unit vectors, the error is bounded by the dimension.
        """
        if self.cosine:
            off = SLACK + 4 * (vectors.shape[1] + 4) * np.finfo(np.float32).eps
            return vectors.astype(np.float32, copy=False) @ self.short.T, off
        products = vectors @ self.vectors.T
        squares = (vectors ** 2).sum(axis=1)
        largest = squares + self.squares.max(initial=0)
        slack = SLACK + 8 * (vectors.shape[1] + 4) * np.finfo(np.float64).eps * largest
        return np.minimum(2 * products - squares[:, None] - self.squares, 0), slack[:, None]

    def _exact(self, vectors, queries):
        """The score of each pair."""
        if self.cosine:
            return np.einsum("ij,ij->i", vectors, queries)
        return -((vectors - queries) ** 2).sum(axis=1)

    def allowed(self, names):
        """Which row each query's selection admits; names are looked up once per distinct one."""
        coded = names.dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        known = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.names), len(self.names))
        known = np.append(known.to_numpy(zero_copy_only=False), len(self.names)).astype(np.int64)
        low = np.searchsorted(self.pairs[:, 0], known, "left")
        size = np.searchsorted(self.pairs[:, 0], known, "right") - low
        row = np.repeat(np.arange(len(known)), size)
        within = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        selects = np.tile(self.everything, (len(known), 1))
        selects[row, self.pairs[np.repeat(low, size) + within, 1]] = True
        codes = pc.fill_null(coded.indices, len(known) - 1).to_numpy(zero_copy_only=False)
        return selects[codes.astype(np.int64)]

    def candidates(self, vectors, names):
        """Which row may be a hit of which query; None if every one may."""
        if not self.filtered and self.planes is None:
            return None
        shape = (len(vectors), len(self.vectors))
        found = np.zeros(shape, bool) if self.planes is not None else np.ones(shape, bool)
        if self.planes is not None:
            sides = signatures(vectors, self.planes)
            for t in range(sides.shape[1]):
                order = np.argsort(sides[:, t], kind="stable")
                ordered = sides[order, t]
                low = np.searchsorted(ordered, self.sides[:, t], "left")
                size = np.searchsorted(ordered, self.sides[:, t], "right") - low
                query = np.repeat(np.arange(len(size)), size)
                within = np.arange(len(query)) - np.repeat(np.cumsum(size) - size, size)
                found[order[np.repeat(low, size) + within], query] = True
        if self.filtered:
            found &= self.allowed(names)
        return found

    def _score_by_name(self, best, ids, column, coded, tag):
        """Rows of a name meet the queries that may find them, and no others are multiplied."""
        codes = pc.fill_null(coded.indices, len(coded.dictionary)).to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary) + 1))
        known = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.names), len(self.names))
        known = np.append(known.to_numpy(zero_copy_only=False), len(self.names)).astype(np.int64)
        for rows, name in zip(np.split(order, ends[:-1]), known):
            low, high = np.searchsorted(self.pairs[:, 0], (name, name + 1))
            may = self.everything.copy()
            may[self.pairs[low:high, 1]] = True
            if not (len(rows) and may.any()):
                continue
            some = self.part(np.flatnonzero(may))
            some.filtered = False
            some.score(best, ids[rows], column.take(pa.array(rows)), None, tag[rows] if isinstance(tag, np.ndarray) else tag)

    def score(self, best, ids, column, names=None, tag=0):
        """Add the hits of a batch of index rows, a slice of rows at a time.

        Products tell which rows can be among the k best of a slice; what is left gets its score
        from the one exact formula, so neither the slice nor other rows change it. Vectors with a
        NaN or infinite value are no hits of any query.
        """
        if not len(self.vectors):
            return
        _check_lengths(ids, column, self.dimension)
        step = max(1, _CELLS // max(len(self.vectors), self.vectors.shape[1]))
        if self.filtered and self.planes is None:
            coded = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
            coded = coded.dictionary_encode()
            if len(coded.dictionary) <= _NAMES * (1 + len(ids) // step):
                self._score_by_name(best, ids, column, coded, tag)
                return
        masked = self.filtered or self.planes is not None
        wide = len(self.vectors) if masked else min(_TILE, len(self.vectors))
        most = step if masked else max(1, _CELLS // max(wide, self.vectors.shape[1]))
        i, step = 0, most if masked or np.isfinite(best.floor[self.of]).all() else min(most, _FIRST_ROWS)
        while i < len(ids):
            vectors = _matrix(column.slice(i, step))
            usable = np.flatnonzero(np.isfinite(vectors).all(axis=1))
            vectors = _unit(vectors[usable]) if self.cosine else vectors[usable]
            if len(usable):
                chosen = names.slice(i, step).take(pa.array(usable)) if names is not None else None
                candidates = self.candidates(vectors, chosen)
                tags = tag[i + usable] if isinstance(tag, np.ndarray) else tag
                rounded = vectors.astype(np.float32) if self.cosine else vectors
                for j in range(0, len(self.vectors), wide):
                    self._tile(j, j + wide)._score(best, ids[i + usable], vectors, rounded, candidates, tags)
            i, step = i + step, min(most, 2 * step)

    def _score(self, best, ids, vectors, rounded, candidates, tag):
        """Add the hits of a slice; `candidates` tells which row may be a hit of which query, None if every one may."""
        near, slack = self._near(rounded)
        if candidates is not None:
            near[~candidates] = -np.inf
        floor = best.floor[self.of]
        if self.cosine:
            floor = np.nextafter((floor - slack).astype(near.dtype), near.dtype.type(-np.inf))
        else:
            near += slack
        found = np.flatnonzero(near >= floor)
        # the hits so far leave few rows; where they do not, the best of the slice exclude the others
        if len(near) > best.k and len(found) > _LOOSE * best.k * len(floor):
            kth = len(near) - best.k
            low = near - 2 * slack
            low.partition(kth, axis=0)
            low = low[kth]
            found = np.flatnonzero(near >= np.maximum(floor, low))
        if candidates is not None:
            found = found[near.ravel()[found] > -np.inf]
        rows, queries = np.divmod(found, len(self.of))
        pairs = max(1, _CELLS // vectors.shape[1])
        for j in range(0, len(rows), pairs):
            row, query = rows[j:j + pairs], queries[j:j + pairs]
            best.add(self.of[query], ids[row], self._exact(vectors[row], self.vectors[query]),
                     tag[row] if isinstance(tag, np.ndarray) else tag)


def selected_rows(rows, queries):
    """Rows that some query may find: if every query selects documents, other rows need not reach Python."""
    chosen = queries["selected_documents"].to_pylist()
    if not all(chosen):
        return rows
    names = rows.sparkSession.createDataFrame([(n,) for n in set().union(*chosen)], "file_name string")
    return rows.join(F.broadcast(names), "file_name", "left_semi").select(*rows.columns)


def _broadcast_hits(index, queries, k, filtered, planes, metric):
    # Plain data only: executors need not have this package.
    shared = index.sparkSession.sparkContext.broadcast((queries, planes))

    def hits(batches):
        asked = _Asked(shared.value[0], filtered, shared.value[1], metric)
        best = _Best(asked.ids, k)
        for batch in batches:
            if batch.num_rows:
                asked.score(
                    best, batch.column("id").to_numpy(), batch.column("chunk_embedding"),
                    batch.column("file_name") if filtered else None,
                )
        yield from best.table().to_batches()

    columns = ["id", "chunk_embedding", *(["file_name"] if filtered else [])]
    rows = index.select(*columns).where("chunk_embedding IS NOT NULL")
    rows = selected_rows(rows, queries) if filtered else rows
    return rows.mapInArrow(hits, _HITS)


def _bucketed(rows, vector, key, planes):
    """One row per (table, bucket) of each vector; without planes all are in one bucket."""
    if planes is None:
        return rows.select(*rows.columns, F.lit(0).alias("_table"), F.lit(0).alias("_bucket"))
    tables = planes.shape[0]
    shared = rows.sparkSession.sparkContext.broadcast(planes)
    columns = [c for c in rows.columns if c != vector]

    def sides(batches):
        for batch in batches:
            if batch.num_rows:
                found = signatures(_matrix(batch.column(vector)), shared.value)
                ends = np.arange(len(found) + 1, dtype=np.int32) * tables
                lists = pa.ListArray.from_arrays(ends, pa.array(found.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in columns], batch.column(vector), lists],
                    names=[*columns, vector, "_sides"],
                )

    schema = T.StructType([
        *rows.select(*columns, vector).schema.fields,
        T.StructField("_sides", T.ArrayType(T.IntegerType())),
    ])
    return rows.select(*columns, vector).mapInArrow(sides, schema).select(
        *columns, vector, F.posexplode("_sides").alias("_table", "_bucket")
    )


def _blocks(rows, key, other):
    """Give each row its block of its bucket, and a copy for every block of the other side."""
    return rows.withColumn(
        f"_{key}_block", F.pmod(F.xxhash64(key), F.col(f"_n_{key}_blocks")).cast("int")
    ).withColumn(
        f"_{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"_n_{other}_blocks") - 1))
    )


def _value_bytes(rows, vector):
    return 4 if isinstance(rows.schema[vector].dataType.elementType, T.FloatType) else 8


def _side(rows, bucket, key, bytes_of_row, per_block, most):
    """Blocks of each bucket: of `per_block` rows, but no more than `most` if these are not too large for a task."""
    blocks = F.greatest(F.lit(1), F.least(
        F.ceil(F.count("*") / per_block), F.greatest(F.lit(most), F.ceil(F.sum(bytes_of_row) / GROUP_BYTES))))
    return rows.groupBy(*bucket).agg(blocks.cast("int").alias(f"_n_{key}_blocks"))


def block_hits(rows, asked, k, filtered, metric, block_rows, block_queries, few_buckets, part=None, most=MOST_BLOCKS,
               counted=None):
    """Index and queries meet in blocks of a bucket whose bytes are bounded, whatever the bucket.

    Rows are dealt to at most `most` blocks and queries to one, so each is shuffled seldom; only where a block would
    exceed GROUP_BYTES there are more. A task scores `block_queries` queries of its block at a time.
    Both have their bucket in _table and _bucket; `few_buckets` says that their number is bounded. `counted` may bring
    the rows' buckets for the count alone, with `_bytes` for each, where vectors are dear.
    With a `part`, a column of whole numbers of the rows, a query meets only rows whose part is among its `_parts`, and
    hits have it too. Unusable queries must have no part. Without `_parts` it meets them all.
    """
    names = ["file_name"] if filtered else []
    chosen = ["selected_documents"] if filtered else []
    bucket = ["_table", "_bucket"]
    listed = part is not None and "_parts" in asked.columns
    width = {v: _value_bytes(df, v) * F.coalesce(F.size(v), F.lit(0)) + 64
             for df, v in ((rows, "chunk_embedding"), (asked, "query_vector"))}
    if counted is None:
        counted = rows.select(*bucket, width["chunk_embedding"].alias("_bytes"))
    if listed:
        width["query_vector"] += 4 * F.size("_parts")
    sizes = _side(counted, bucket, "id", F.col("_bytes"), block_rows, most).join(
        _side(asked, bucket, "query_id", width["query_vector"], block_queries, 1), bucket)
    sizes = F.broadcast(sizes) if few_buckets else sizes
    rows = _blocks(rows.join(sizes, bucket), "id", "query_id")
    asked = _blocks(asked.join(sizes, bucket), "query_id", "id")
    group = [*bucket, "_id_block", "_query_id_block"]

    def meeting(left, right, asked):
        """Rows, the queries that meet them, and their part."""
        if not listed:
            yield left, asked, 0 if part is None else left[part].to_numpy()
            return
        parts, read = left[part].to_numpy(), right["_parts"].combine_chunks()
        wanted = read.flatten().to_numpy()
        query = np.repeat(np.arange(len(read)), pc.list_value_length(read).to_numpy(zero_copy_only=False))
        order = np.argsort(wanted, kind="stable")
        wanted, query = wanted[order], query[order]
        starts = np.flatnonzero(np.r_[True, np.diff(parts) != 0])
        for at, end in zip(starts, np.r_[starts[1:], len(parts)]):
            low, high = np.searchsorted(wanted, (parts[at], parts[at] + 1))
            if low < high:
                yield left.slice(at, end - at), asked.part(np.sort(query[low:high])), int(parts[at])

    def hits(left, right):
        left, found = left.combine_chunks(), []
        if listed:
            left = left.sort_by(part).combine_chunks()
        for i in range(0, max(1, right.num_rows), block_queries):
            some = right.slice(i, block_queries)
            asked = _Asked(some, filtered, None, metric)
            best = _Best(asked.ids, k)
            if left.num_rows and right.num_rows:
                for rows, queries, tag in meeting(left, some, asked):
                    queries.score(
                        best, rows["id"].to_numpy(), rows["chunk_embedding"],
                        rows["file_name"].combine_chunks() if filtered else None, tag,
                    )
            found.append(best.table(part))
        return pa.concat_tables(found)

    left = rows.select(*group, "id", *names, "chunk_embedding", *([part] if part else []))
    right = asked.select(*group, "query_id", *chosen, "query_vector", *(["_parts"] if listed else []))
    schema = _HITS if part is None else f"{_HITS}, {part} int"
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(hits, schema)


def _width(queries):
    """Values of the longest query vector."""
    return queries.select(F.max(F.size("query_vector"))).first()[0] or 0


def _block_hits(index, queries, k, filtered, planes, metric, block_rows, block_queries):
    """`block_hits` over the whole index, or over the buckets of hyperplanes."""
    names = ["file_name"] if filtered else []
    chosen = ["selected_documents"] if filtered else []
    rows = _bucketed(
        index.select("id", *names, "chunk_embedding").where("chunk_embedding IS NOT NULL"),
        "chunk_embedding", "id", planes,
    )
    asked = _bucketed(
        queries.select("query_id", *chosen, "query_vector"), "query_vector", "query_id", planes
    )
    # Without planes rows are counted by their ids alone: their vectors may come from a model, and would be made twice.
    counted = None if planes is not None else index.select(F.lit(0).alias("_table"), F.lit(0).alias("_bucket"), F.lit(
        64 + _value_bytes(index, "chunk_embedding") * _width(queries)).alias("_bytes"))
    # At most tables x 2^bits rows, whatever the data.
    few = planes is None or planes.shape[0] << planes.shape[1] <= 1_000_000
    most = MOST_BLOCKS if planes is None else MANY_BUCKETS_MOST
    found = block_hits(rows, asked, k, filtered, metric, block_rows, block_queries, few, most=most, counted=counted)
    return found if planes is None else found.dropDuplicates(["query_id", "id"])


def ranked(hits, k, metric, *more):
    """The k best hits of each query, with their rank."""
    best = Window.partitionBy("query_id").orderBy(F.col("place").desc(), "id")
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select(
            "query_id", "id", "rank",
            (F.col("score") if metric == "cosine" else -F.col("score")).alias("score"), *more,
        )
    )


def asked_once(queries, filtered, max_queries):
    """The queries, made once, and also as an Arrow table if there are few of them and they are light.

    Query vectors may come from a model, so they are written to the shared folder and then only read.
    """
    columns = ["query_id", *(["selected_documents"] if filtered else []), "query_vector"]
    asked = queries.select(*columns).where("query_vector IS NOT NULL")
    shared_folder(asked.sparkSession)
    asked = asked.checkpoint()
    size = asked.select(
        F.count("*"),
        F.sum(F.size("query_vector") * 8 + (
            F.length(F.array_join("selected_documents", " ")) if filtered else F.lit(0))),
    ).first()
    few = size[0] <= max_queries and (size[1] or 0) <= MAX_QUERY_BYTES
    return asked, asked.toArrow() if few else None


def _search(index, queries, k, filtered, planes, max_queries, block_rows, block_queries,
            metric="cosine"):
    if metric not in ("cosine", "squared_l2"):
        raise ValueError(f"metric is cosine or squared_l2, not {metric}")
    asked, few = asked_once(queries, filtered, max_queries)
    if few is not None:
        hits = _broadcast_hits(index, few, k, filtered, planes, metric)
    else:
        hits = _block_hits(
            index, asked, k, filtered, planes, metric, block_rows, block_queries
        )
    return ranked(hits, k, metric)


def vector_topk(index, queries, k=V.TOP_K, metric="cosine", max_queries=MAX_QUERIES,
                block_rows=BLOCK_ROWS, block_queries=BLOCK_QUERIES):
    """The k nearest index rows for each query: query_id, id, rank, score.

    `index` has id and chunk_embedding, `queries` has query_id and query_vector. The score is the
    cosine, 0 with a zero vector, or with "squared_l2" the squared distance, least first.
    """
    return _search(index, queries, k, False, None, max_queries, block_rows, block_queries, metric)


def vector_topk_filtered(index, queries, k=V.TOP_K, metric="cosine", max_queries=MAX_QUERIES,
                         block_rows=BLOCK_ROWS, block_queries=BLOCK_QUERIES):
    """As `vector_topk`, among the rows whose file_name is in the query's selected_documents.

    An empty or NULL selection is no filter. The filter comes before the ranking.
    """
    return _search(index, queries, k, True, None, max_queries, block_rows, block_queries, metric)


def vector_topk_ann(index, queries, k=V.TOP_K, tables=8, bits=4,
                    dimension=V.EMBEDDING_DIMENSION, filtered=False,
                    max_queries=MAX_QUERIES, block_rows=BLOCK_ROWS, block_queries=BLOCK_QUERIES):
    """Top-k among the rows that share a bucket with the query in at least one table.

    A bucket is the side of `bits` fixed hyperplanes. More bits make smaller buckets, more tables
    find more neighbours; about log2(index rows / 1000) bits keep the buckets near 1000 rows.
    """
    planes = hyperplanes(tables, bits, dimension)
    return _search(index, queries, k, filtered, planes, max_queries, block_rows, block_queries)


def stored_hits(hits):
    """The hits, run and stored; what was shuffled for them goes."""
    shared_folder(hits.sparkSession)
    with shuffle_files_removed(hits.sparkSession):
        return hits.select("*").checkpoint()


def rows_of_hits(rows, hits):
    """The rows whose ids are among those of `hits`, and few others, so that the others are not shuffled to a join.

    `hits` must be stored. Tasks set the bits of their ids' hashes in a map of at most 2^MAP_BITS bits, 64 an id or more
    up to there, and the driver hands the map out; only ids reach Python.
    """
    bits = min(MAP_BITS, max(16, (64 * hits.count()).bit_length()))
    size = 1 << bits - 4  # of 16 pieces
    place = F.pmod(F.xxhash64("id"), F.lit(1 << bits).cast("long"))

    def pieces(batches):
        made = {}
        for batch in batches:
            at = batch.column(0).to_numpy()
            for piece in np.unique(at // size).tolist():
                here = at[at // size == piece] - piece * size
                flags = made.setdefault(piece, np.zeros(size >> 3, np.uint8))
                np.bitwise_or.at(flags, here >> 3, (1 << (here & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(made), pa.int32()), pa.array([f.tobytes() for f in made.values()], pa.binary())], ["piece", "flags"])

    dealt = hits.select(place.alias("at")).repartition(16, F.floor(F.col("at") / size))
    made = dealt.mapInArrow(pieces, "piece int, flags binary").toArrow()
    flags = np.zeros((16, size >> 3), np.uint8)
    for piece, some in zip(made["piece"].to_pylist(), made["flags"].to_pylist()):
        flags[piece] = np.frombuffer(some, np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(flags.ravel())

    @arrow_udf(T.BooleanType())
    def may_be(at: pa.Array) -> pa.Array:
        at = at.to_numpy()
        return pa.array((shared.value[at >> 3] >> (at & 7) & 1).astype(bool))

    return rows.where(may_be(place))


def retrieve_columns(hits, chunks):
    """Hits with the columns of their chunks. Adaptive execution broadcasts few hits."""
    found = chunks.select(
        "id", "text_chunk", "file_name", "folder_name", "chunk_location_in_doc",
        "total_chunks_in_doc", "document_type",
    )
    return keyed_join(hits, found, ["id"], "inner")


def selected_documents_filter(queries, chunks):
    """Per query the number of chunks its selection leaves.

    Chunks are counted per file before they meet the selections, so no query is paired with
    single chunks; a query without a selection keeps them all.
    """
    per_file = chunks.groupBy("file_name").agg(F.count("*").alias("_chunks"))
    everything = chunks.select(F.count("*")).scalar()  # a subquery: nothing runs yet
    wanted = queries.select(
        "query_id", F.explode(F.array_distinct("selected_documents")).alias("file_name")
    )
    filtered = (
        keyed_join(wanted, per_file, ["file_name"], "inner")
        .groupBy("query_id").agg(F.sum("_chunks").alias("_chunks"))
    )
    selects = F.coalesce(F.size("selected_documents") > 0, F.lit(False))
    return (
        queries.select("query_id", selects.alias("is_filtered"))
        .join(filtered, "query_id", "left")
        .select(
            "query_id", "is_filtered",
            F.when(F.col("is_filtered"), F.coalesce("_chunks", F.lit(0)))
            .otherwise(everything).alias("n_candidates"),
        )
    )
