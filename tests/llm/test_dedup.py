"""Operators 3 and 8 against brute force, with awkward rows and forced splits."""

import random
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import blocks, graph, hashing, jaccard, substring
from tests.llm.util import awkward, docs, words


def plain_substring(rows, k):
    """(doc_id, n_words, kept) by the definition; rows in the order of their ids."""
    seen, out = set(), []
    split = [words(t) for _, t in rows]
    for (i, _), w in sorted(zip(rows, split), key=lambda x: x[0][0]):
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            window = tuple(w[p : p + k])
            if window in seen:
                gone[p : p + k] = [True] * k
            seen.add(window)
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def passages(seed, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    shared = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(4, 40))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(0, 30))) for _ in range(3)]
        parts.insert(r.randrange(4), r.choice(shared))
        if r.random() < 0.2:
            parts += parts[:2]
        out.append((i * 3 - 20, r.choice([" ", "\n", " \t"]).join(parts)))
    return out + [(1000 + i, out[3][1]) for i in range(10)]


@pytest.mark.parametrize("k,seed", [(20, 1), (5, 2), (3, 3)])
def test_substring_dedup_equals_brute_force(spark, k, seed):
    rows = passages(seed)
    got = substring.remove_repeats(docs(spark, rows), k).collect()
    assert sorted(tuple(r) for r in got) == plain_substring(rows, k)


def test_substring_awkward_rows(spark):
    rows = awkward()
    got = substring.remove_repeats(docs(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    by = {r["doc_id"]: r for r in got}
    assert (by[1]["n_words"], by[1]["kept"], by[3]["n_words"], by[8]["n_words"]) == (0, "", 0, 1)
    assert substring.remove_repeats(docs(spark, rows).limit(0)).collect() == []
    twice = substring.remove_repeats(docs(spark, [(1, " ".join(map(str, range(30))))] * 2)).collect()
    assert sorted(r["n_removed"] for r in twice) == [0, 30]


def test_sketch_never_loses_a_repeat():
    """Narrow sketches only add false answers; a window that repeats is always answered."""
    lay = blocks.Layout(2, 3, 6)
    h = hashing.mix(np.arange(500, dtype=np.uint64))
    shared = set(lay.counter(h[:50]).tolist())
    assert shared <= set(lay.counter(np.concatenate([h, h[:50]])).tolist())
    for values in ([], [7], [0, 0, 1, 2**40, 2**63 + 5, 2**64 - 1], list(range(0, 10**6, 999))):
        v = np.array(values, np.uint64)
        assert (blocks.unpack_sorted(blocks.pack_sorted(v), len(v)) == v).all()


def test_hashes_do_not_depend_on_the_batch():
    texts = ["", "a b c", "é 漢字 x", "a b c", " \n", "one two three four five six"]
    together = hashing.words(hashing.chars(texts))
    for i, t in enumerate(texts):
        alone = hashing.words(hashing.chars([t]))
        assert (together.hash[together.first[i] : together.last[i]] == alone.hash).all()
        assert len(alone.hash) == len(words(t))
    at, h = hashing.words(hashing.chars(["x a b c d", "y a b c d"])).windows(4)
    assert len(at) == 4 and h[1] == h[3] and h[0] != h[2]


def shingles(text, k=5):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def plain_components(rows):
    sets, root = [(i, shingles(t)) for i, t in rows], {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((str(i), len(s), None if i is None else find(i)) for i, s in sets)


def near_copies(seed, families=6, size=25):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, n = [], 0
    for f in range(families):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 8, 40, 120]))]
        for _ in range(size):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            if r.random() < 0.2:
                w = w[r.randrange(3) :]
            text = " ".join(w)
            rows.append((n * 7 % 1009, text.upper() if r.random() < 0.2 else text))
            n += 1
    return rows


@pytest.mark.parametrize("seed,shingles_of_bucket", [(1, 4_000_000), (2, 4_000_000), (1, 400), (3, 60)])
def test_jaccard_components_equal_brute_force(spark, seed, shingles_of_bucket):
    rows = near_copies(seed)
    p = jaccard.Params(bucket_shingles=shingles_of_bucket)
    got = jaccard.jaccard_components(docs(spark, rows), params=p).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == plain_components(rows)


def test_chain_of_links_and_exact_threshold(spark):
    base = [f"c{i}" for i in range(60)]
    rows = [(100 - s, " ".join(base[s : s + 24])) for s in range(30)]  # neighbours share 19 of 21 shingles
    rows += [(500, "a b c d e f g h i j k l m"), (501, "a b c d e f g h i j k l x")]  # 8 of 10: exactly the threshold
    rows += [(502, "p q r s t u v w x"), (503, "p q r s t u v w y")]  # 4 of 6
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs(spark, rows)).collect()}
    assert {got[100 - s] for s in range(30)} == {71}
    assert (got[501], got[503]) == (500, 503)


def test_jaccard_awkward_rows(spark):
    rows = awkward()
    got = jaccard.jaccard_components(docs(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == plain_components(rows)
    d = docs(spark, [*rows, (44, "ONE two three")])
    kept = jaccard.keep_one(d)
    assert kept.columns == d.columns
    assert kept.filter("doc_id = 44").count() == 0 and kept.filter("doc_id = 4").count() == 2 and kept.filter("doc_id IS NULL").count() == 2
    assert jaccard.jaccard_components(d.limit(0)).collect() == []


def test_divide_skip_equals_counting():
    r = random.Random(4)
    index, sets = jaccard.LeaderIndex(), []
    for _ in range(80):
        s = r.sample(range(60), r.randrange(1, 40))
        sets.append(set(s))
        index.add(s)
    for _ in range(100):
        q = r.sample(range(60), r.randrange(1, 40))
        for least in (1, 2, 5, 15, 30):
            want = [(i, len(s & set(q))) for i, s in enumerate(sets) if len(s & set(q)) >= least]
            assert sorted(index.search(q, least)) == want


def test_bucket_of_copies_needs_no_pairs():
    """Copies of one text: work and links in proportion to their number."""
    p, base = jaccard.Params(), np.arange(100, dtype=np.uint64)
    c = jaccard.Clusters(p)
    for i in range(2000):
        c.add(i, np.unique(np.append(base, 1000 + i % 7).astype(np.uint64)))
    assert len(c.links) == 1999 and len(c.index.sizes) == 1


def test_components_of_long_paths_and_odd_edges(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (None, 3), (7, None), (900, 800), (800, 900), (900, 700)]
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(201)} == {0} and got[900] == got[800] == got[700] == 700
    groups = defaultdict(int)
    for c in got.values():
        groups[c] += 1
    assert groups == {0: 201, 700: 3}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("shingles_of_bucket", [4_000_000, 60])
def test_an_id_with_two_texts_links_what_either_links(spark, shingles_of_bucket):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, "nothing like it at all here"), (1, a), (1, a)]
    rows += [(9, "z " + a), (9, "y " + b), (9, "own words of this very document")]
    got = jaccard.jaccard_components(docs(spark, rows), params=jaccard.Params(bucket_shingles=shingles_of_bucket)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == plain_components(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 1, 4: 4, 9: 1}
    kept = jaccard.keep_one(docs(spark, rows), params=jaccard.Params(bucket_shingles=shingles_of_bucket)).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 1, 1, 1, 4]


@pytest.mark.parametrize("seed", [4, 5])
def test_repeated_ids_equal_brute_force(spark, seed):
    rows = [(i % 40, t) for i, t in near_copies(seed)]
    got = jaccard.jaccard_components(docs(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == plain_components(rows)
