"""License notices in texts: phrases, and an exact set-similarity join with notice templates.

A text block matches a template if it holds at least a share of the template's words. Words are put in
one order, rarest in the corpus first. Two sets with an overlap of at least `need` share a word
among the first size - need + 1 of each, so only blocks with such a word are looked at; sizes and the
places of the shared word bound the overlap before it is counted. The filters are exact: no block that
meets the threshold is passed over. Of two templates with different labels, one of which has all words
of the other and more, the wider counts only with each of these words more, and then the narrower does not: a
notice of CC BY-SA is none of CC BY, nor the other way round. Both count where the narrower's words stand twice.
"""

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from pergamon.llm.text import plain_words, text_bytes

#: Phrases whose words, standing in a row, give a base label.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Words of notices, with the label they give.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("creative commons attribution noderivatives 4 0 international license", "cc-by-nd"),
    ("creative commons attribution noncommercial sharealike 4 0 international license", "cc-by-nc-sa"),
    ("creative commons attribution noncommercial noderivatives 4 0 international license", "cc-by-nc-nd"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu lesser general public license version 2", "lgpl"),
    ("licensed under the gnu lesser general public license version 3", "lgpl"),
    ("licensed under the gnu affero general public license version 3", "agpl-3"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("use of this source code is governed by a bsd style license", "bsd"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files to deal in the software without restriction including without "
     "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of "
     "the software", "mit"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the "
     "license at http www apache org licenses license 2 0", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation", "gpl"),
)

#: Share of a template's distinct words that a block must hold.
THRESHOLD = 0.9

#: Templates of up to so many words are looked for in lines and in windows of twice their own length;
#: longer ones in windows of twice the longest template.
LINE_WORDS = 16


class Templates:
    """Templates indexed by the rarest words of each; `counts` gives each word's corpus frequency."""

    def __init__(self, counts, templates=TEMPLATES, threshold=THRESHOLD):
        texts = [(plain_words(text.encode()), label) for text, label in templates]
        words = sorted({w for t, _ in texts for w in t}, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(words)}
        self.rows, self.heads, self.lengths = [], {}, [len(t) for t, _ in texts]
        for i, (text, label) in enumerate(texts):
            ordered = sorted({self.rank[w] for w in text})
            need = math.ceil(threshold * len(ordered) - 1e-9)
            self.rows.append((frozenset(ordered), label, need, len(text) > LINE_WORDS))
            for place, r in enumerate(ordered[: len(ordered) - need + 1]):
                self.heads.setdefault(r, []).append((i, place))
        pairs = [(i, j) for i, a in enumerate(self.rows) for j, b in enumerate(self.rows) if a[0] < b[0] and a[1] != b[1]]
        self.wider = [[j for i, j in pairs if i == k] for k in range(len(self.rows))]
        self.telling = [frozenset().union(*[self.rows[j][0] - self.rows[i][0] for i, j in pairs if j == k])
                        for k in range(len(self.rows))]
        self.head_words = frozenset(words[r] for r in self.heads)
        self.window = max((len(t) for t, _ in texts if len(t) > LINE_WORDS), default=0)
        self.least = min((need for _, _, need, _ in self.rows), default=0)

    def match(self, words, long, length=None):
        """{template number: share of its words} of those that the block meets; of one length only if it is given."""
        ranks = sorted({self.rank[w] for w in words if w in self.rank})
        if len(ranks) < self.least:
            return {}
        held, tried, found = frozenset(ranks), set(), {}
        for place, r in enumerate(ranks):
            for i, at in self.heads.get(r, ()):
                members, _, need, is_long = self.rows[i]
                if is_long != long or length not in (None, self.lengths[i]) or i in tried or len(ranks) < need or place > len(ranks) - need:
                    continue
                tried.add(i)  # this is the first word they share: what follows it bounds the overlap
                if min(len(members) - at, len(ranks) - place) < need:
                    continue
                common = len(members & held)
                if common >= need:
                    found[i] = common / len(members)
        found = {i: share for i, share in found.items() if self.telling[i] <= held}
        if any(self.wider[i] for i in found):
            times = Counter(self.rank[w] for w in words if w in self.rank)
            found = {i: share for i, share in found.items() if not self._part_of_wider(i, held, times)}
        return found

    def _part_of_wider(self, i, held, times):
        """Whether a block meets a wider template than template i and has not all words of i twice."""
        return min(times[r] for r in self.rows[i][0]) < 2 and any(
            self.telling[j] <= held and len(self.rows[j][0] & held) >= self.rows[j][2] for j in self.wider[i])

    def scan(self, data):
        """{label: best share} over all blocks of a text."""
        words = plain_words(data)
        best = {}
        if self.head_words.isdisjoint(words):
            return best
        blocks = [(plain_words(line), False) for line in data.split(b"\n")]
        # each run of `window` words lies in one of the windows, which are twice as long
        if self.window:
            blocks += [(words[i : i + 2 * self.window], True)
                       for i in range(0, max(1, len(words) - self.window), self.window)]
        for block, long in blocks:
            if not self.head_words.isdisjoint(block):
                for i, share in self.match(block, long).items():
                    label = self.rows[i][1]
                    best[label] = max(best.get(label, 0.0), share)
        return best

    def wrapped(self, data):
        """{label: best share} of short templates in windows of the whole text, whatever its lines.

        A template of n words meets windows of 2n words, n apart, so each run of n words lies in one. Only
        windows with a word that the template's prefix has are looked at.
        """
        words, best, seen = plain_words(data), {}, set()
        for at in [i for i, w in enumerate(words) if w in self.head_words]:
            for i, _ in self.heads[self.rank[words[at]]]:
                n, is_long = self.lengths[i], self.rows[i][3]
                if is_long:
                    continue
                last = max(0, -(-len(words) // n) - 2)  # the last window reaches the end
                for k in {min(at // n, last), min(max(at // n - 1, 0), last)}:
                    if (n, k) not in seen:
                        seen.add((n, k))
                        for j, share in self.match(words[k * n : (k + 2) * n], False, n).items():
                            label = self.rows[j][1]
                            best[label] = max(best.get(label, 0.0), share)
        return best


_PHRASES = [(b" " + p.encode() + b" ", label) for p, label in PHRASES]


def phrases(words):
    """[(first word, label)] of every place of every phrase."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in _PHRASES:
        at, counted, before = joined.find(phrase), 0, 0
        while at >= 0:
            before += joined.count(b" ", counted, at)
            counted = at
            found.append((before, label))
            at = joined.find(phrase, at + 1)
    return found


def word_counts(docs, vocabulary, text="text"):
    """{word: times in all texts} for a fixed vocabulary; tasks send sums of their own."""
    def count(batches):
        for batch in batches:
            seen = dict.fromkeys(vocabulary, 0)
            for value in batch.column(0):
                for w in plain_words(value.as_py()):
                    if w in seen:
                        seen[w] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    sums = docs.select(text_bytes(text).alias("text")).mapInArrow(count, "word binary, n long")
    return {bytes(r.word): r.n for r in sums.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def license_scan(docs, doc_id="doc_id", text="text", templates=TEMPLATES, threshold=THRESHOLD):
    """Per row: n_words, places of base phrases, base labels, all labels, and the best share.

    Two passes over the texts and no shuffle of them: the first counts the templates' words in the
    whole corpus, the second matches. Labels are sorted, distinct and comma-joined, empty if none.
    The score is 1 with a base label, else the best share of a template met, else 0. Base labels count
    whatever stands around the phrase. Null and empty
    texts have no words and no labels; repeated rows are repeated.
    """
    vocabulary = {w for t, _ in templates for w in plain_words(t.encode())}
    index = Templates(word_counts(docs, vocabulary, text), templates, threshold)

    def scan(batches):
        for batch in batches:
            rows = []
            for value in batch.column(1):
                data = value.as_py()
                words = plain_words(data)
                base, more = phrases(words), index.scan(data)
                for label, share in index.wrapped(data).items():
                    more[label] = max(more.get(label, 0.0), share)
                labels = {label for _, label in base}
                rows.append((
                    len(words), len(base), min((b[0] for b in base), default=None),
                    max((b[0] for b in base), default=None), ",".join(sorted(labels)),
                    ",".join(sorted(labels | set(more))), 1.0 if base else max(more.values(), default=0.0)))
            columns = list(zip(*rows)) or [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    return rows.mapInArrow(
        scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double")
