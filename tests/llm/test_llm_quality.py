import collections

import pytest

from pergamon.llm.quality import MEASURES, quality_rules

SPACES = " \t\n\x0b\x0c\r"
PROSE = "the cat and the dog sat in a house of wood with an old man who was not at home for most of it"
TEXTS = [
    None, "", " \n\t ", "one", PROSE, PROSE + "\n" + PROSE + "\n" + PROSE, "# * $ a|b <c> & %" * 30,
    "it it it it it it it it it", " ".join(["x y z"] * 40), "a\n\nb\na \na\n", "\x0bä\x0c Ü x " + PROSE,
    " ".join(f"w{i}" for i in range(3000)) + " " + PROSE, "Yes! " * 50 + PROSE, PROSE.upper(),
    "a b c d e f g h i a b c d e f g h",
]


def model(text):
    text = text or ""
    words = [w for w in text.translate({ord(c): " " for c in SPACES}).split(" ") if w]
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_echo_words": sum(a == b for a, b in zip(words, words[1:])),
        "base_failed": n < 20 or 100 * len(covered) > 30 * n,
    }


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, t, "own", 1.5) for i, t in enumerate(TEXTS)] + [(0, None, "own", 1.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, `odd name` double")
    return quality_rules(docs)


def test_measures_are_those_of_plain_python(judged):
    rows = judged.collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        expected = model(TEXTS[r.doc_id])
        assert {k: r[k] for k in expected} == expected
        assert r.kept == (not r.base_failed and not r.broken_rules)


def test_verdicts(judged):
    kept = {r.doc_id for r in judged.filter("kept").collect()}
    assert {4, 10, 13} <= kept and not kept & {0, 1, 2, 3, 5, 6, 7, 8, 11, 12}


def test_a_filter_stays_above_the_measures(judged):
    """Else each step's expression would be run for each word of the next one's."""
    plan = judged.filter("kept").select("doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") == 4


def test_no_python_and_no_shuffle(judged):
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_names_and_empty_tables(spark, judged):
    assert judged.columns[:3] == ["doc_id", "text", "odd name"] and set(MEASURES) < set(judged.columns)
    assert quality_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0
