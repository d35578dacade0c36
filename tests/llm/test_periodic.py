"""Operator 11: runs against brute force, whatever the chunks they are appended in."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import periodic
from quarry.llm.queries import QUERIES, planted
from tests.llm.util import awkward, docs, table, words


def brute(text):
    """Every maximal stretch per period, then the smallest period of equal stretches."""
    n, best = len(text), {}
    for p in range(1, n // 3 + 1):
        i = p
        while i < n:
            if text[i] != text[i - p]:
                i += 1
                continue
            j = i
            while j < n and text[j] == text[j - p]:
                j += 1
            if j - i + p >= max(24, 3 * p):
                best.setdefault((i - p, j), p)
            i = j
    return sorted((a, b - a, p) for (a, b), p in best.items())


def pieces():
    word = st.integers(0, 2)
    return st.lists(st.tuples(st.lists(word, min_size=1, max_size=9), st.integers(1, 30)), max_size=5).map(lambda ps: [w for p, k in ps for w in p * k])


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces(), max_size=4))
def test_runs_equal_brute_force(texts):
    assert periodic.runs_of(texts) == [brute(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(pieces(), st.randoms(use_true_random=False))
def test_appending_word_by_word_or_in_chunks_is_the_same(text, r):
    want = brute(text)
    for most in (1, 3, 17, 100):
        catchers, at = periodic.Catchers(), 0
        while at < len(text):
            step = r.randint(1, most)
            catchers.append(np.array(text[at : at + step], np.int64))
            at += step
        assert catchers.runs() == want


def test_runs_of_words_so_far():
    text = [1, 2, 3, 4, 5] * 12 + [9] * 40 + [1, 2] * 20
    catchers = periodic.Catchers()
    for i, w in enumerate(text):
        catchers.append(np.array([w], np.int64))
        assert catchers.runs() == brute(text[: i + 1])


def test_large_periods_and_one_word_texts():
    r = random.Random(4)
    root = [r.randrange(1000) for _ in range(700)]
    long = root * 3 + root[:50] + [-5] + [7] * 3000
    assert periodic.runs_of([long, [1] * 20_000, [1] * 23, [1] * 24]) == [[(0, 2150, 700), (2151, 3000, 1)], [(0, 20_000, 1)], [], [(0, 24, 1)]]


def test_a_long_text_of_one_word_costs_what_its_words_cost():
    assert periodic.runs_of([[b"a"] * 1_000_000]) == [[(0, 1_000_000, 1)]]


def test_strongest_compares_exactly_and_breaks_ties():
    assert periodic.strongest([(9, 30, 10), (0, 24, 8), (40, 24, 8)]) == (0, 24, 8)
    big = 10**16
    assert periodic.strongest([(0, 3 * big, big), (5, 3 * big + 1, big)]) == (5, 3 * big + 1, big)
    assert periodic.strongest([]) is None


def digests(doc_id, text):
    w = planted(doc_id, [x.encode() for x in words(text)])
    runs = brute(w)
    best = periodic.strongest(runs) or (None, None, None)
    covered = {i for s, n, p in runs for i in range(s + p, s + n)}
    collapsed = b" ".join(x for i, x in enumerate(w) if i not in covered)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())


def test_query_equals_brute_force_on_whole_texts(spark):
    got = sorted(tuple(r) for r in QUERIES["op11_runs"](spark, "/root/testdata/sf0.001").collect())
    want = sorted(digests(r["doc_id"], r["text"]) for r in table(spark, "sf0.001", "documents").collect() if len(words(r["text"])) < 2000)
    assert set(want) <= set(got) and len(want) > 150 and len(got) == table(spark, "sf0.001", "documents").count()
    assert sum(r[1] for r in want) > 5


def test_awkward_rows(spark):
    rows = awkward() + [(20, "a b " * 30), (20, "a b " * 30), (None, "x\t" * 24)]
    got = sorted(periodic.collapse_runs(docs(spark, rows)).collect(), key=repr)
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["collapsed"]): [tuple(x) for x in r["runs"]] for r in got}
    assert by[20, "a b"] == [(0, 60, 2)] and by[None, "x"] == [(0, 24, 1)] and by[1, ""] == [] and by[3, ""] == []
    assert tuple(next(r["strongest"] for r in got if r["doc_id"] == 20)) == (0, 60, 2)
    assert by[8, "a" * 100_000] == []


def test_rewriting_follows_the_rule():
    hit = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    g = zlib.crc32(str(hit).encode()) // 10
    text = [b"%d" % i for i in range(100)]
    a = g % 100
    p = 1 + (100 - a) // (3 + g % 8)
    assert planted(hit, text) == text[:a] + [text[a + i % p] for i in range(100 - a)]
    assert planted(None, text) == text and planted(hit, []) == []


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_tables(spark, rows):
    assert [tuple(r) for r in periodic.collapse_runs(docs(spark, rows)).collect()] == [(i, [], None, "") for i, _ in rows]
