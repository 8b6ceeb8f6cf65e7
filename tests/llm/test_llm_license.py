import random

from pergamon.llm.license_scan import TEMPLATES, THRESHOLD, Templates, license_scan, phrases
from pergamon.llm.text import plain_words


def meets(template, block):
    """Share of a template's words in a block; 0 if too few, if a word that tells it from a narrower notice is missing,
    or if it is part of a wider notice that stands there."""
    share = alone(template, block)
    wider = [t for t in LABELS if set(template) < set(t) and LABELS[t] != LABELS[tuple(template)]]
    return 0 if any(alone(t, block) for t in wider) and any(block.count(w) < 2 for w in template) else share


def alone(template, block):
    own, held = set(template), set(block)
    share = len(own & held) / len(own)
    narrower = [set(t) for t in LABELS if set(t) < own and LABELS[t] != LABELS[tuple(template)]]
    return 0 if share < THRESHOLD - 1e-12 or any(not own - n <= held for n in narrower) else share


LABELS = {tuple(plain_words(t.encode())): label for t, label in TEMPLATES}


def brute(data):
    """{label: best share} by comparing every block with every template."""
    words = plain_words(data)
    index = Templates({})
    best = {}
    for text, label in TEMPLATES:
        t = plain_words(text.encode())
        if len(t) > 16:
            blocks = [words[i:i + 2 * index.window] for i in range(0, max(1, len(words) - index.window), index.window)]
        else:
            blocks = [plain_words(x) for x in data.split(b"\n")]
        for block in blocks:
            share = meets(t, block)
            if share:
                best[label] = max(best.get(label, 0), share)
    return best


def test_join_is_exact():
    rng = random.Random(8)
    counts = {w: rng.randrange(1000) for t, _ in TEMPLATES for w in plain_words(t.encode())}
    vocabulary = sorted(counts) + [b"other", b"words"]
    for seed in (counts, {}):
        index = Templates(seed)
        hits = 0
        for _ in range(400):
            text = rng.choice(TEMPLATES)[0].encode().split()
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            for _ in range(rng.randint(0, 30)):
                text.insert(rng.randrange(len(text) + 1), rng.choice([b"\n", rng.choice(vocabulary)]))
            data = b" ".join(text)
            assert index.scan(data) == brute(data)
            hits += bool(brute(data))
        assert 40 < hits < 400


def test_phrases_and_places():
    words = plain_words(b"Under the MIT license; cc-by-nc cc by nc. under the mit licensed Apache License, Version 2")
    assert sorted(phrases(words)) == [(0, "mit"), (4, "cc-by-nc"), (7, "cc-by-nc"), (14, "apache-2")]


def test_rows(spark):
    mit = next(t for t, label in TEMPLATES if label == "mit" and len(t) > 200)
    long_notice = "\n".join(mit[i:i + 40] for i in range(0, len(mit), 40))
    rows = [(1, "text\nReleased under the MIT License."), (2, None), (3, ""), (4, "the mit license under"),
            (5, "This work is licensed under the GNU General Public License, version 3"), (6, "w " * 300_000),
            (7, "x " * 500 + long_notice.replace("- ", "-") + " y" * 500), (1, "text\nReleased under the MIT License."),
            (None, "cc by nc cc by nc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as labels", "1 as n", "2 as word")
    found = license_scan(docs)
    assert found.count() == len(rows)
    by_id = {r.doc_id: r for r in found.collect()}
    r = by_id[1]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (
        6, 1, 2, 2, "mit", "mit", 1.0)
    for i in (2, 3, 4, 6):
        r = by_id[i]
        assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (0, None, None, "", "", 0.0)
    assert by_id[5].labels == "gpl-3" and by_id[5].base_labels == "" and by_id[5].score == 1.0
    r = by_id[None]
    assert (r.n_base, r.first_word, r.last_word, r.labels) == (2, 0, 3, "cc-by-nc")
    assert license_scan(docs.limit(0)).count() == 0


def test_wrapped_notices(spark):
    rows = [(1, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy"),
            (2, "licensed under the GNU\nGeneral Public License version 3"),
            (3, "subject to the terms " + "of x\n" * 40 + "the mozilla public license v 2 0")]
    found = {r.doc_id: (r.labels, r.base_labels) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1] == ("mpl-2", "") and found[2] == ("gpl-3", "") and found[3] == ("", "")


def test_windows_are_those_of_brute_force():
    rng = random.Random(9)
    counts = {w: rng.randrange(1000) for t, _ in TEMPLATES for w in plain_words(t.encode())}
    vocabulary = sorted(counts) + [b"other", b"words"]
    short = [(plain_words(t.encode()), label) for t, label in TEMPLATES if len(t.split()) <= 16]
    index, hits = Templates(counts), 0
    for _ in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        words += [w for w in rng.choice(short)[0] if rng.random() < 0.95] + [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        expected = {}
        for t, label in short:
            for i in range(0, max(1, len(words) - len(t)), len(t)):
                share = meets(t, words[i:i + 2 * len(t)])
                if share:
                    expected[label] = max(expected.get(label, 0), share)
        data = b"".join(w + rng.choice((b" ", b"\n")) for w in words)
        assert index.wrapped(data) == expected
        hits += bool(expected)
    assert 40 < hits


def test_a_wider_notice_hides_the_narrower_one(spark):
    by, sa = "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution-ShareAlike 4.0 International License"
    texts = {
        by: "cc-by", sa: "cc-by-sa", "under a Creative Commons Attribution-\nNonCommercial 4.0 International License": "cc-by-nc",
        f"{by} or\n{sa}": "cc-by,cc-by-sa", f"{by} or {sa}": "cc-by,cc-by-sa",
        f"{sa}\n{'x ' * 60}\n{by}": "cc-by,cc-by-sa",
        "licensed under the GNU Lesser General Public License, version 3": "lgpl",
        "licensed under the GNU Lesser\nGeneral Public License, version 2.1": "lgpl",
        "licensed under the GNU Affero General Public License version 3": "agpl-3",
        "licensed under the GNU General Public License version 3": "gpl-3",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License": "cc-by-nc-sa",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.labels for r in license_scan(docs).collect()}
    assert [found[i] for i in range(len(texts))] == list(texts.values())
