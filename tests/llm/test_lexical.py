"""Operator 12: ranks against brute force; pruning by masks changes nothing."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quarry.llm import lexical
from quarry.llm.lexical import Params
from tests.llm.util import awkward, docs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, top=50):
    held = [(i, Counter(terms(t))) for i, t in rows]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for i, c, n in held:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def asked(spark, items):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in items], "item_id long, text string, rank int, score string")


def got(spark, rows, items, **params):
    return sorted((tuple(r) for r in lexical.search(docs(spark, rows), asked(spark, items), params=Params(**params)).collect()), key=repr)


def corpus(n, seed):
    r = random.Random(seed)
    vocabulary = [f"w{int(r.paretovariate(0.7)) % 400}" for _ in range(2000)] + ["É", "ß", "日本", "W7", "w7."]
    return [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 5, 40, 300])))) for i in range(n)], vocabulary


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_equal_brute_force(spark, seed):
    rows, vocabulary = corpus(400, seed)
    rows += rows[:30] + [(None, rows[3][1]), (None, "w1 w2 w3")] + awkward()
    r = random.Random(seed)
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(n))) for k, n in enumerate([1, 2, 10, 30, 90, 200])] + [(2, "w1 É"), (None, "w5 naïve"), (90, ""), (91, None), (92, "absent")]
    want = brute(rows, items)
    assert got(spark, rows, items) == want
    assert got(spark, rows, items, block_rows=7, slice_bytes=5) == want
    assert got(spark, rows, items, item_bytes=200) == want


def test_ties_come_by_id(spark):
    rows = [(i, "same words here") for i in range(120, 0, -1)] + [(None, "same words here"), (5, "same words here")] + [(200, "other")] * 300
    assert got(spark, rows, [(1, "Words SAME")]) == brute(rows, [(1, "words same")])


def test_masks_are_left_out_and_nothing_is_lost():
    """Later blocks evaluate few of their masks; all blocks together rank like one."""
    r = np.random.default_rng(3)
    sizes = r.integers(1, 40, 20_000)
    rows = [np.unique((r.pareto(0.6, k) * 3).astype(np.int64) % 200) for k in sizes]
    weights = np.where(np.arange(200) < 5, 20, 4000)
    items = [np.sort(r.choice(200, k, replace=False)) for k in (2, 8, 70)]

    def ranked(block):
        ranker = lexical.Ranker(items, weights, len(rows), int(sizes.sum()), Params())
        for at in range(0, len(rows), block):
            some = rows[at : at + block]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in some])])
            flat = np.concatenate(some)
            ranker.block(np.zeros(len(some), np.int64), np.arange(at, at + len(some)), sizes[at : at + block], ends, flat, 1 + flat % 3)
        return ranker

    whole, blocks = ranked(len(rows)), ranked(1000)
    for a, b in zip(whole.best, blocks.best):
        assert (a.rows == b.rows).all() and len(a.rows) == 50
    assert blocks.evaluated * 5 < blocks.masks


def test_terms_of_slices():
    data = "É1 b-C_d\x7f日本x" * 50
    for size in (1, 4, 1000):
        assert [t.decode() for some in lexical.terms_of(data.encode(), size) for t in some] == terms(data)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == [] and got(spark, [(1, "a b")], []) == []
    assert got(spark, [(1, None), (2, "--")], [(1, "a")]) == []
    assert lexical.search(docs(spark, []), asked(spark, [])).columns == ["item_id", "rank", "doc_id", "score"]
