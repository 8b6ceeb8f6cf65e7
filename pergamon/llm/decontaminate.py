"""Benchmark passages in documents, found with a budget of word errors.

An item of n words may differ from a place in a text by k = floor(n * share) words changed, added or
lost. Cut into k + 1 pieces, at least one piece stands there unchanged, so places of exact pieces
are all that need a look. Myers' bit-parallel distance, on words as symbols, then decides.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pergamon.llm.text import _PLAIN, text_bytes, window_hashes, word_hashes

#: Errors allowed for each word of an item. Items of fewer words than WHOLE_BELOW have no errors to spend: one
#: word changed in a few would leave too little in common with the item.
ERROR_SHARE = 0.15
WHOLE_BELOW = 8

#: Bytes of benchmark text that go to the tasks at once; more are searched for in further passes.
BLOCK_BYTES = 8 << 20

_SIEVE_BITS = 22
_MAX_WIDTH = 64


def myers(pattern, text):
    """(distance, end) of the place in `text` nearest to `pattern`, leftmost; end is exclusive.

    `pattern` maps each symbol to the bits of its places, with its length under None.
    """
    n = pattern[None]
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best = (n, 0)
    for end, symbol in enumerate(text, 1):
        eq = pattern.get(symbol, 0)
        x = eq | minus
        d = ((((x & plus) + plus) ^ plus) | x) & full
        up, down = (minus | ~(d | plus)) & full, plus & d
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = (down | ~(d | up)) & full, up & d
        if score < best[0]:
            best = (score, end)
    return best


def _bits(words):
    places = {None: len(words)}
    for i, w in enumerate(words):
        places[w] = places.get(w, 0) | 1 << i
    return places


class Items:
    """Benchmark items made ready for search; of bounded size.

    Pieces of about one length are looked up by windows of one width, so a short item makes only its own
    look-ups dear, not those of long items.
    """

    def __init__(self, rows, share=ERROR_SHARE, whole_below=WHOLE_BELOW):
        self.ids, self.words, self.errors, self.length = [], [], [], []
        for item_id, text in rows:
            words = word_hashes(text.translate(_PLAIN))
            if len(words):
                self.ids.append(item_id)
                self.words.append(words)
                self.errors.append(int(len(words) * share) if len(words) >= whole_below else 0)
                self.length.append(len(words) // (self.errors[-1] + 1))
        self.sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
        tiers = {}
        for i, length in enumerate(self.length):
            tiers.setdefault(length.bit_length(), []).append(i)
        self.tiers = [self._tier(members) for _, members in sorted(tiers.items())]
        inexact = [i for i, errors in enumerate(self.errors) if errors]
        self.forward = {i: _bits(self.words[i].tolist()) for i in inexact}
        self.backward = {i: _bits(self.words[i][::-1].tolist()) for i in inexact}

    def _tier(self, members):
        """(width, keys, items, offsets) of the pieces of some items, sorted by key."""
        width = min(min(self.length[i] for i in members), _MAX_WIDTH)
        keys, owners, offsets = [], [], []
        for i in members:
            starts = np.arange(self.errors[i] + 1) * self.length[i]
            keys.append(window_hashes(self.words[i], width)[starts])
            owners.append(np.full(len(starts), i))
            offsets.append(starts)
        keys, owners, offsets = map(np.concatenate, (keys, owners, offsets))
        order = np.argsort(keys, kind="stable")
        self.sieve[keys >> np.uint64(64 - _SIEVE_BITS)] = True
        return width, keys[order], owners[order], offsets[order]

    def _regions(self, words):
        """{item: [[start, end], ...]} of the places around exact pieces, joined where they overlap."""
        spans = {}
        for width, keys, owners, offsets in self.tiers:
            if len(words) < width:
                continue
            windows = window_hashes(words, width)
            at = np.flatnonzero(self.sieve[windows >> np.uint64(64 - _SIEVE_BITS)])
            low = np.searchsorted(keys, windows[at], side="left")
            high = np.searchsorted(keys, windows[at], side="right")
            for p, a, b in zip(at[high > low], low[high > low], high[high > low]):
                for k in range(a, b):
                    i, offset = int(owners[k]), int(offsets[k])
                    errors, seen = self.errors[i], spans.get(i)
                    if seen and not errors:
                        continue  # the leftmost place of an exact item is known
                    piece = self.words[i][offset : offset + self.length[i]]
                    if not np.array_equal(words[p : p + len(piece)], piece):
                        continue
                    start = int(p) - offset - errors
                    end = start + len(self.words[i]) + 2 * errors
                    if seen and start <= seen[-1][1]:
                        seen[-1] = [min(start, seen[-1][0]), max(end, seen[-1][1])]
                    else:
                        spans.setdefault(i, []).append([start, end])
        return spans

    def find(self, text):
        """{item_id: (distance, first word, last word)} of the nearest place of each item in a text."""
        words = word_hashes(text.translate(_PLAIN)) if self.ids else ()
        found = {}
        for i, seen in (self._regions(words) if len(words) else {}).items():
            for start, end in seen:
                if self.errors[i]:
                    start, end = max(start, 0), min(end, len(words))
                    region = words[start:end].tolist()
                    distance, stop = myers(self.forward[i], region)
                    if distance > self.errors[i]:
                        continue
                    _, back = myers(self.backward[i], region[:stop][::-1])
                    hit = (distance, start + stop - back, start + stop - 1)
                else:
                    hit = (0, start, end - 1)
                found[self.ids[i]] = min(found.get(self.ids[i], hit), hit)
        return found


def _blocks(benchmark, item_id, text, share, whole_below):
    """The benchmark in parts of about BLOCK_BYTES, each made ready for search.

    Only items go through the driver, one part at a time; they are the query set, not the corpus.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), text_bytes(text).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for i in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i).orderBy("item_id", "text")
        part = part.toArrow()
        rows = zip(part.column("item_id").to_pylist(), part.column("text").to_pylist())
        yield part.schema.field("item_id").type, Items(rows, share, whole_below)


def benchmark_matches(docs, benchmark, doc_id="doc_id", item_id="item_id", text="text",
                      share=ERROR_SHARE, whole_below=WHOLE_BELOW):
    """A row for each document and benchmark item that it holds: the nearest place and its distance.

    Columns: the document's id, item_id, distance (words), first_word, last_word (from 0). Words are
    runs of letters, digits and anything outside ASCII, A-Z lower-cased. Documents without a hit give
    no row; null and empty texts and items without a word have none. Items of fewer than `whole_below`
    words are found where they stand word for word, the leftmost place. Items of one id count as one, as
    near as the nearest, and null is an id; ids are of any type that compares (no arrays or maps).
    Repeated documents give repeated rows. There is no shuffle: items travel to the documents, a
    bounded block a pass.
    """
    names = docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text).alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType),
        T.StructField("item_id", benchmark.schema[item_id].dataType),
        *[T.StructField(c, T.LongType()) for c in ("distance", "first_word", "last_word")]])
    out = None
    for id_type, block in _blocks(benchmark, item_id, text, share, whole_below):
        def search(batches, id_type=id_type, block=block):
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1)
                rows, hits = [], []
                for i in range(len(texts)):
                    for item, hit in block.find(texts[i].as_py()).items():
                        rows.append(i)
                        hits.append((item, *hit))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows, pa.int64())),
                     *[pa.array([h[j] for h in hits], t) for j, t in enumerate((id_type, *[pa.int64()] * 3))]],
                    schema.fieldNames())

        part = names.mapInArrow(search, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def without_benchmark(docs, benchmark, item_id="item_id", text="text", share=ERROR_SHARE,
                      whole_below=WHOLE_BELOW):
    """The documents that hold no benchmark item, with all their columns; other rows are dropped.

    An item of one or a few words drops every document that has these words in a row; leave such items out
    of the benchmark if that is not wanted.
    """
    place = docs.columns.index(text)
    for _, block in _blocks(benchmark, item_id, text, share, whole_below):
        def clean(batches, block=block):
            for batch in batches:
                texts = batch.column(place).cast(pa.binary())
                keep = [not block.find(texts[i].as_py() or b"") for i in range(len(texts))]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
