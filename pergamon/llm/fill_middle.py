"""Fill-in-the-middle: texts cut at two drawn places and put into another order.

Each byte of a text has a class of three flags: it starts a code point, a word, a line. A wavelet matrix over
the classes of many texts at once answers how often a class occurs before a place. The ranks of all
classes with a flag add up to the number of units that start before the place, and bisection on these
counts finds the byte at which a unit ends, so a cut costs a number of steps that grows with the
logarithm of the text and no text is split into a list of units.
"""

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pergamon.llm.text import text_bytes

#: What may be cut: every unit is a flag of a byte's class.
CHAR, WORD, LINE = 1, 2, 4
UNITS = {"char": CHAR, "word": WORD, "line": LINE}
FLAGS = 3

#: What stands before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")

#: Percent of the texts that are cut, and of these the percent whose suffix comes first.
CUT_PERCENT = 90
SUFFIX_FIRST_PERCENT = 20
SEED = 1

#: Bytes of text that share a matrix; a longer text has one of its own.
MATRIX_BYTES = 8 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def byte_classes(raw, firsts):
    """The flags of each byte of texts that lie one after the other and begin at `firsts`.

    A word starts with a code point that is no white space, after white space or at the start of a text; a
    line starts with a text or after a line feed.
    """
    before = np.empty_like(raw)
    before[1:] = raw[:-1]
    before[firsts] = 10
    starts = (raw & 0xC0) != 0x80
    starts[firsts] = True
    words = starts & ~_SPACE[raw] & _SPACE[before]
    lines = starts & (before == 10)
    return (starts * np.uint8(CHAR)) | (words * np.uint8(WORD)) | (lines * np.uint8(LINE))


class WaveletMatrix:
    """Rank over a sequence of small numbers: one bit vector for each of their bits.

    A level holds one bit of every number, packed, with the ones before each 64 bits counted; numbers with
    a 0 go before those with a 1 on the next level. That is a fifth of a byte a level and number.
    """

    def __init__(self, symbols, bits=FLAGS):
        self.size, self.bits, self.levels = len(symbols), bits, []
        for b in range(bits - 1, -1, -1):
            bit = ((symbols >> b) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words).astype(np.int64))))
            self.levels.append((words, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))
        self.present = np.unique(symbols).tolist()
        self.origin = {}

    @staticmethod
    def _ones(level, places):
        words, ones, _ = level
        word = places >> 6
        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return ones[word] + np.bitwise_count(words[word] & below)

    def _walk(self, symbol, places):
        for b, level in zip(range(self.bits - 1, -1, -1), self.levels):
            ones = self._ones(level, places)
            places = level[2] + ones if (symbol >> b) & 1 else places - ones
        return places

    def rank(self, symbol, places):
        """How often `symbol` occurs before each place, from 0 to the size."""
        if symbol not in self.origin:
            self.origin[symbol] = int(self._walk(symbol, np.zeros(1, dtype=np.int64))[0])
        return self._walk(symbol, places) - self.origin[symbol]

    def starts(self, flag, places):
        """How many units with this flag start before each place."""
        return sum((self.rank(s, places) for s in self.present if s & flag), np.zeros(len(places), dtype=np.int64))

    def ends(self, flag, low, high, units):
        """Where the first `units` units of each stretch [low, high) end: the next one's start, or `high`.

        No units end at `low`; what stands before the first unit goes with it.
        """
        goal = self.starts(flag, low) + units
        left, right = low.copy(), high.copy()
        while (open_ := np.flatnonzero(left < right)).size:
            middle = (left[open_] + right[open_]) >> 1
            enough = self.starts(flag, middle + 1) > goal[open_]
            right[open_[enough]] = middle[enough]
            left[open_[~enough]] = middle[~enough] + 1
        return np.where(units > 0, left, low)


def draws(key, seed=SEED):
    """Four numbers of 32 bits, from the hash of the seed and the row's key as text."""
    return np.frombuffer(sha256(f"{seed}:{key or ''}".encode()).digest()[:16], dtype=">u4")


def _forms(texts, drawn, cut_percent, suffix_first_percent, sentinels):
    forms = []
    for text, h in zip(texts, drawn):
        if not text or h[2] % 100 >= cut_percent or any(s in text for s in sentinels):
            forms.append("plain")
        else:
            forms.append("spm" if h[3] % 100 < suffix_first_percent else "psm")
    return forms


def _transformed(texts, keys, flag, cut_percent, suffix_first_percent, seed, sentinels):
    """(n, form, prefix_chars, middle_chars, output) as lists, for texts that share a matrix."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    high = np.cumsum(lengths)
    low = high - lengths
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    matrix = WaveletMatrix(byte_classes(raw, low[lengths > 0]))
    drawn = np.array([draws(k, seed) for k in keys], dtype=np.int64).reshape(-1, 4)
    forms = _forms(texts, drawn, cut_percent, suffix_first_percent, sentinels)
    at_low, at_high = matrix.starts(CHAR, low), matrix.starts(CHAR, high)
    units = matrix.starts(flag, high) - matrix.starts(flag, low)
    ends = np.sort(drawn[:, :2] % (units + 1)[:, None], axis=1)
    first = matrix.ends(flag, low, high, ends[:, 0])
    second = matrix.ends(flag, low, high, ends[:, 1])
    at_first, at_second = matrix.starts(CHAR, first), matrix.starts(CHAR, second)
    prefix_chars, middle_chars = (at_first - at_low).tolist(), (at_second - at_first).tolist()
    outputs = []
    begin, suffix_mark, middle_mark = sentinels
    for i, (text, form) in enumerate(zip(texts, forms)):
        a, b = int(first[i] - low[i]), int(second[i] - low[i])
        if form == "plain":
            prefix_chars[i] = middle_chars[i] = None
            outputs.append(text)
        elif form == "psm":
            outputs.append(b"".join((begin, text[:a], suffix_mark, text[b:], middle_mark, text[a:b])))
        else:
            outputs.append(b"".join((suffix_mark, text[b:], begin, text[:a], middle_mark, text[a:b])))
    return (at_high - at_low).tolist(), forms, prefix_chars, middle_chars, outputs


def fill_in_middle(docs, doc_id="doc_id", text="text", unit="char", cut_percent=CUT_PERCENT,
                   suffix_first_percent=SUFFIX_FIRST_PERCENT, seed=SEED, sentinels=SENTINELS):
    """doc_id, n (code points), form, prefix_chars, middle_chars and output of every row.

    Two cuts are drawn from the hash of seed and id, between units: `char`, `word` (with the white space behind it) or
    `line`. Form `psm` is prefix, suffix, middle, and `spm` suffix, prefix, middle, each behind its sentinel;
    `plain` is the text as it was, with null sizes: an empty or null text, one that holds a sentinel, and those
    drawn to stay. Rows are independent and nothing is shuffled: repeated rows give repeated rows, a null id counts
    as an empty one, other columns are left out, and no rows give none. Time is linear in the text; a task holds
    MATRIX_BYTES of text, or one longer text.
    """
    flag = UNITS[unit]
    marks = tuple(s.encode() for s in sentinels)
    if len(set(marks)) < 3 or not all(marks):
        raise ValueError("three different sentinels are needed")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_id).cast("string").alias("key"),
                       text_bytes(text).alias("text"))

    def work(batches):
        for batch in batches:
            ids, keys, texts = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < len(keys):
                spent = total[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(total, spent + MATRIX_BYTES, "right")))
                made = _transformed(texts.slice(start, stop - start).to_pylist(), keys[start:stop], flag,
                                    cut_percent, suffix_first_percent, seed, marks)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start), *(pa.array(c, k) for c, k in zip(made, kinds))],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
                start = stop

    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField("output", T.BinaryType())])
    return rows.mapInArrow(work, schema).withColumn("output", F.col("output").cast("string"))


def restored(output="output", form="form", sentinels=SENTINELS):
    """The text that an output was made of, as a column; the sentinels are found by their places."""
    out = F.col(output)
    p, s, m = (F.instr(out, mark) for mark in sentinels)
    after_p, after_s, after_m = (at + len(mark) for at, mark in zip((p, s, m), sentinels))
    end = F.length(out) + 1
    psm = F.concat(F.substring(out, after_p, s - after_p), F.substring(out, after_m, end - after_m),
                   F.substring(out, after_s, m - after_s))
    spm = F.concat(F.substring(out, after_p, m - after_p), F.substring(out, after_m, end - after_m),
                   F.substring(out, after_s, p - after_s))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(out)
