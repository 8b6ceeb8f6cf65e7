import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from pergamon.operators import chunking
from pergamon.operators.chunking import split_at_separators

SCHEMA = "id long, file_name string, folder_name string, extracted_text string"


def check_contract(text, chunks, size, overlap):
    """The invariants: sizes, order, coverage, overlap."""
    assert all(1 <= len(c) <= size for c in chunks)
    assert all(c == c.strip() for c in chunks)
    covered, start, previous_end, previous_start = set(), 0, 0, -1
    for chunk in chunks:
        # Chunks overlap, so look for each after the start of the one before.
        at = text.find(chunk, start)
        assert at >= 0
        while at + len(chunk) <= previous_end or at < previous_end - overlap:
            at = text.find(chunk, at + 1)
            assert at >= 0, "chunk is out of order or overlaps too much"
        assert at > previous_start
        covered.update(range(at, at + len(chunk)))
        previous_start, start, previous_end = at, at + 1, at + len(chunk)
    assert all(i in covered for i, c in enumerate(text) if not c.isspace())


def numbered_words(count, seed, long_words=False):
    """Text without repeats, so every chunk has one place."""
    pick = random.Random(seed)
    words = []
    for i in range(count):
        word = f"w{i:05d}"
        if long_words and pick.random() < 0.02:
            word += "".join(f"-{i:05d}.{j:03d}" for j in range(pick.randint(1, 400)))
        words.append(word + pick.choice([" ", " ", " ", "\n", "\n\n", "  "]))
    return "".join(words)


def test_contract_on_mixed_text():
    for seed in range(20):
        text = numbered_words(2000, seed, long_words=True)
        check_contract(text, split_at_separators(text), 1000, 200)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([" ", "\n", "\n\n", "\t", "word", "x" * 30]), max_size=60),
       st.integers(5, 40))
def test_no_character_is_lost_and_no_chunk_too_long(parts, size):
    text = "".join(p if p.isspace() else f"{p}{i}" for i, p in enumerate(parts))
    chunks = split_at_separators(text, size, size // 5)
    assert all(1 <= len(c) <= size and c == c.strip() for c in chunks)
    rest = "".join(text.split())
    joined = "".join("".join(c.split()) for c in chunks)
    # Every character appears, in order, with repeats only where chunks overlap.
    at = 0
    for character in joined:
        if at < len(rest) and character == rest[at]:
            at += 1
    assert at == len(rest)


def test_cuts_at_blank_lines_before_lines_before_words():
    text = "a" * 40 + "\n\n" + "b" * 30 + "\n" + "c" * 30 + " " + "d" * 30
    assert split_at_separators(text, 50, 0) == ["a" * 40, "b" * 30, "c" * 30, "d" * 30]


def test_overlap_is_kept_from_the_chunk_before():
    words = [f"{i:04d}" for i in range(40)]
    chunks = split_at_separators(" ".join(words), 50, 15)
    for one, two in zip(chunks, chunks[1:]):
        shared = [w for w in one.split() if w in two.split()]
        assert shared and len(" ".join(shared)) <= 15


def test_text_without_separators_is_cut_in_windows():
    text = "".join(chr(0x4E00 + i) for i in range(2700))
    assert split_at_separators(text) == [text[0:1000], text[800:1800], text[1600:2600], text[2400:]]


def test_nothing_from_nothing():
    assert split_at_separators("") == [] and split_at_separators(" \n\n \t") == []


def test_time_is_linear_in_the_text():
    def seconds(text):
        started = time.perf_counter()
        split_at_separators(text)
        return time.perf_counter() - started

    text = numbered_words(40_000, 1)
    small = min(seconds(text) for _ in range(3))
    assert seconds(text * 8) < 8 * small * 4 + 0.2


def windows(text, size, overlap):
    step = size - overlap
    count = max(1, -(-(len(text) - overlap) // step))
    return [text[i * step:i * step + size] for i in range(count)]


def test_windows_are_those_of_plain_slicing(spark):
    texts = [
        "", None, "a", "x" * 1000, "x" * 1001, "é😀" * 700, "y" * 1800, "line\n" * 900,
        "".join(chr(0x4E00 + i % 5000) for i in range(5200)), " ",
    ]
    rows = spark.createDataFrame(
        [(i, f"f{i}", "d", t) for i, t in enumerate(texts)], SCHEMA
    )
    for size, overlap in [(1000, 200), (10, 0), (10, 7), (100, 50)]:
        found = {}
        for r in chunking.chunk_window(rows, size, overlap).collect():
            found.setdefault(r["id"], []).append(
                (r["chunk_location_in_doc"], r["text_chunk"], r["total_chunks_in_doc"],
                 r["chunk_length_in_chars"])
            )
        expected = {
            i: [(n, c, len(windows(t, size, overlap)), len(c))
                for n, c in enumerate(windows(t, size, overlap))]
            for i, t in enumerate(texts) if t
        }
        assert {i: sorted(c) for i, c in found.items()} == expected


def test_recursive_rows_and_ids(spark):
    text = numbered_words(1500, 3)
    rows = spark.createDataFrame(
        [(7, "f", "d", text), (8, "g", "d", ""), (9, "h", "d", None), (10, "i", "d", " ")], SCHEMA
    )
    found = chunking.with_chunk_ids(chunking.chunk_recursive(rows)).orderBy("id").collect()
    assert [r["text_chunk"] for r in found] == split_at_separators(text)
    assert [r["id"] for r in found] == [(7 << 22) + i for i in range(len(found))]
    assert {r["total_chunks_in_doc"] for r in found} == {len(found)}
    assert all(r["chunk_length_in_chars"] == len(r["text_chunk"]) for r in found)


def test_chunks_of_a_batch_are_not_all_python_strings_at_once():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array([("word %d " % i) * 400 for i in range(3000)] + [None, ""])
    wanted = [chunking.split_at_separators(t or "") for t in texts.to_pylist()]

    tracemalloc.start()
    found = chunking._split_batch(texts, 1000, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.to_pylist() == wanted
    assert peak < texts.nbytes / 4
    assert chunking._split_batch(pa.array([], pa.string()), 1000, 200).to_pylist() == []


def test_chunks_do_not_carry_the_array_they_come_from(spark):
    import re

    from pergamon.operators import chunking
    from pergamon.operators.indexing import embed_text

    docs = spark.createDataFrame([(1, "word " * 900)], "id long, extracted_text string")
    for chunk in (chunking.chunk_window, chunking.chunk_recursive):
        rows = embed_text(chunk(docs), dimension=8)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        kept = re.search(r"Generate posexplode\(_chunks#\d+\), \[([^\]]*)\]", plan)[1]
        assert "_chunks#" not in kept and "total_chunks_in_doc" in kept
        assert {r["total_chunks_in_doc"] for r in rows.collect()} == {rows.count()}
