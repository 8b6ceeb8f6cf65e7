import hashlib
import random

import numpy as np
import pytest

from pergamon.llm import fill_middle
from pergamon.llm.fill_middle import CHAR, LINE, WORD, WaveletMatrix, byte_classes, fill_in_middle, restored

MARKS = ("<P>", "<S>", "<M>")


def units_of(text, unit):
    """The text in units, as lists; what stands before the first unit goes with it."""
    if unit == "char":
        return list(text)
    if unit == "line":
        return text.splitlines(keepends=True) if set(text) <= set("ab \n") else text.split("\n")
    out = []
    for i, c in enumerate(text):
        if c not in " \t\n\r\x0b\x0c" and (i == 0 or text[i - 1] in " \t\n\r\x0b\x0c"):
            out.append("")
        if not out:
            out.append("")
        out[-1] += c
    starts = [u for u in out if u.strip(" \t\n\r\x0b\x0c")]
    return [out[0] + starts[0], *starts[1:]] if starts and out[0] is not starts[0] else starts


def brute(doc_id, text, unit="char", cut=90, first=20):
    """(n, form, prefix_chars, middle_chars, output) by plain slices."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= cut:
        return len(text), "plain", None, None, text
    units = units_of(text, unit)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not units:
        prefix = middle = ""
        suffix = text
    else:
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < first:
        return len(text), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(text), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def made_texts():
    rng = random.Random(5)
    texts = [None, "", " ", "\n", "a", "é", "𝄞", "<P>", "x <M> y", "<P", "S>", "<", "<P<S<M", ">", "\n\n\na\n\n",
             "  lead", "tail  ", "\x00\x1f\x7f", "ünï cödé 𝄞𝄞 mixed\r\nline\x0bfeed\x0c end"]
    for _ in range(150):
        alphabet = rng.choice(("ab \n", "<>PSM ", "aé𝄞 \n\t", "日本語 text\n"))
        texts.append("".join(rng.choice(alphabet) for _ in range(rng.choice((3, 9, 40, 300)))))
    texts.append("".join(rng.choice("abé \n") for _ in range(300_000)))
    return [(i - 3, t) for i, t in enumerate(texts)] + [(None, "no id at all"), (5, "again"), (5, "again")]


def test_outputs_are_those_of_plain_slices(spark):
    rows = made_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as form", "2 as key")
    made = fill_in_middle(docs)
    found = made.select("*", restored().alias("back")).collect()
    expected = sorted(((i, *brute(i, t), t or "") for i, t in rows), key=repr)
    assert sorted(map(tuple, found), key=repr) == expected
    assert {r.form for r in found} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit", ["word", "line"])
def test_cuts_lie_between_units(spark, unit):
    rows = [(i, t) for i, t in made_texts() if unit == "word" or set(t or "") <= set("ab \n")]
    made = fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), unit=unit, cut_percent=100)
    found = sorted((tuple(r) for r in made.select("*", restored().alias("back")).collect()), key=repr)
    assert found == sorted(((i, *brute(i, t, unit, 100), t or "") for i, t in rows), key=repr)


def test_small_matrices_give_the_same_rows(spark, monkeypatch):
    docs = spark.createDataFrame(made_texts(), "doc_id long, text string")
    whole = sorted(map(tuple, fill_in_middle(docs).collect()), key=repr)
    monkeypatch.setattr(fill_middle, "MATRIX_BYTES", 64)
    assert sorted(map(tuple, fill_in_middle(docs).collect()), key=repr) == whole


def test_other_sentinels_ids_and_no_rows(spark):
    marks = ("<|prefix|>", "<|suffix|>", "<|middle|>")
    docs = spark.createDataFrame([("a", "<P> is text here"), ("b", "x <|middle|>"), (None, None)], "name string, body string")
    made = fill_in_middle(docs, "name", "body", cut_percent=100, sentinels=marks)
    found = {r.doc_id: r for r in made.select("*", restored(sentinels=marks).alias("back")).collect()}
    assert found["a"].form != "plain" and found["a"].back == "<P> is text here"
    assert found["b"].form == "plain" and found[None].form == "plain" and found[None].output == ""
    assert fill_in_middle(docs.limit(0), "name", "body").count() == 0
    with pytest.raises(ValueError):
        fill_in_middle(docs, "name", "body", sentinels=("<P>", "<P>", "<M>"))


def test_wavelet_matrix_counts_as_plain_sums_do():
    rng = np.random.default_rng(6)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 8, size).astype(np.uint8)
        matrix = WaveletMatrix(symbols)
        places = np.arange(size + 1)
        for s in range(8):
            before = np.concatenate(([0], np.cumsum(symbols == s)))
            if s in matrix.present:
                assert (matrix.rank(s, places) == before).all()
        for flag in (CHAR, WORD, LINE):
            before = np.concatenate(([0], np.cumsum((symbols & flag) > 0)))
            assert (matrix.starts(flag, places) == before).all()
            total = int(before[-1])
            units = np.arange(total + 1)
            ends = matrix.ends(flag, np.zeros(total + 1, np.int64), np.full(total + 1, size), units)
            starts = np.append(np.flatnonzero(symbols & flag), size)
            assert ends.tolist() == [0, *starts[1:].tolist()][: total + 1]


def test_classes_of_bytes():
    raw = np.frombuffer("é a\nb".encode(), dtype=np.uint8)
    found = byte_classes(raw, np.array([0]))
    assert found.tolist() == [CHAR | WORD | LINE, 0, CHAR, CHAR | WORD, CHAR, CHAR | WORD | LINE]
