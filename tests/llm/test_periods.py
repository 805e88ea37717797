import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salespanel.llm import periods
from salespanel.llm.periods import Periodic, runs_of


def brute_runs(words, least=12):
    """Every maximal stretch of every period, and a check that no smaller one fits."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                run = words[i : i + length]
                if not any(all(a == b for a, b in zip(run, run[p:])) for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    """The contract's row, word by word."""
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    numbers = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *numbers, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


TEXTS = st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=50), min_size=1, max_size=4)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.sampled_from([8, 12, 15]))
def test_runs_equal_all_stretches(texts, least):
    assert runs_of(texts, Periodic(least)) == [brute_runs(t, least) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), min_size=1, max_size=9), st.integers(2, 30), st.lists(st.sampled_from([b"a", b"b"]), max_size=6))
def test_powers_with_remainders(word, times, rest):
    words = rest + word * times + rest
    assert runs_of([words]) == [brute_runs(words)]


def test_long_texts_with_one_and_with_many_runs():
    assert runs_of([[b"a"] * 100_000]) == [[(0, 100_000, 1)]]
    draw = random.Random(1)
    block = [b"%d" % draw.randrange(10**9) for _ in range(1_000)]
    assert runs_of([block * 60 + [b"end"]]) == [[(0, 60_000, 1_000)]]
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 2_000:
        a, b = b, b + a
    assert runs_of([b]) == [brute_runs(b)]


def test_ordered_set_splits_into_parts():
    draw = random.Random(2)
    numbers = draw.sample(range(100_000), 9_000)
    held = periods.Positions(numbers[0])
    for x in numbers[1:]:
        held.add(x)
    known = sorted(numbers)
    assert list(held) == known and len(held.parts) > 3 and held.size == 9_000
    for x in set(range(0, 100_000, 97)) - set(numbers):
        before = max((k for k in known if k < x), default=None)
        after = min((k for k in known if k > x), default=None)
        assert held.around(x) == (before, after)


def test_query_equals_plain_version(spark):
    draw = random.Random(3)
    line = "to be or not to be that is the question "
    texts = [None, "", " \n\t\x0b\x0c\r ", "one", line * 9, "x " * 500, "été  naïve x 漢字 " * 8]
    texts += [" ".join(draw.choice("ab") for _ in range(draw.randrange(1, 90))) for _ in range(40)]
    texts += [" ".join(f"w{draw.randrange(400)}" for _ in range(draw.randrange(1, 200))) for _ in range(150)]
    texts += [" ".join(f"w{draw.randrange(4000)}" for _ in range(5_000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, texts[4]), (4, "other"), (None, line * 4), (-7, line * 3)]
    docs = spark.createDataFrame([(t, i, 1, "z") for i, t in rows], "text string, doc_id long, start int, n_runs string")
    found = [tuple(r) for r in periods.periodic_runs(docs.repartition(3)).collect()]
    assert sorted(found, key=str) == sorted((brute_row(*r) for r in rows), key=str)
    assert any(r[1] > 0 and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in found)


def test_collapse_keeps_columns_and_other_texts(spark):
    rows = [(1, "keep  me\nas I am", "a"), (2, "go " * 20 + "on", "b"), (3, None, None), (2, "go " * 20 + "on", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = periods.collapse(docs)
    assert found.columns == ["doc_id", "text", "runs"]
    got = sorted((r.doc_id, r.text, [tuple(x) for x in r.runs]) for r in found.collect() if r.text is not None)
    assert got == [(1, "keep  me\nas I am", []), (2, "go on", [(0, 20, 1)]), (2, "go on", [(0, 20, 1)])]
    assert found.filter("doc_id = 3").first().text is None


def test_empty_table_and_short_runs(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periods.periodic_runs(empty).collect() == [] and periods.collapse(empty).collect() == []
    with pytest.raises(ValueError):
        Periodic(4)
