"""Operators 2 and 7: tokens, exact cover and padding; raked margins and draws."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import mixing, packing
from quarry.llm.queries import QUERIES
from tests.llm.util import awkward, docs, table


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encoder():
    v = packing.default_vocabulary()
    return packing.byte_bpe(v["ranks_path"], v["pattern"], v["special"])


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_ids_equal_the_named_tokenizer(tokenizer, text):
    assert list(encoder().encode(text, allowed_special={"<|endoftext|>"})) == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_equal_on_documents_and_special_text(spark, tokenizer):
    texts = [r["text"] for r in table(spark, "sf0.001", "documents").collect()] + ["a<|endoftext|>b", "  \n\n I'm 'RE ٣४ ​"]
    for t in texts:
        assert list(encoder().encode(t, allowed_special={"<|endoftext|>"})) == tokenizer.encode(t, add_special_tokens=False).ids


def test_first_fit_decreasing_equals_the_plain_search():
    r = random.Random(3)
    for n in (0, 1, 2, 7, 300):
        sizes = np.array([r.choice([1, 5, 50, 99, 100, r.randrange(1, 101)]) for _ in range(n)], np.int64)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        used = []
        for i in sorted(range(n), key=lambda i: -sizes[i]):
            b = next((j for j, u in enumerate(used) if u + sizes[i] <= 100), len(used))
            if b == len(used):
                used.append(0)
            assert (bins[i], offsets[i]) == (b, used[b])
            used[b] += sizes[i]


def check_cover(rows, expected, capacity):
    """Every id in exactly one piece; sequences gapless and within capacity."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    want = defaultdict(list)
    for i, ids in expected:
        want[i, len(ids)].append(ids)
    assert set(by_doc) == set(want)
    for key, texts in want.items():
        crcs = sorted((s, zlib.crc32(np.array(t[s : s + n], "<u4").tobytes())) for t in texts for s, n in {(p["start"], p["length"]) for p in by_doc[key]})
        assert sorted((p["start"], p["ids_crc32"]) for p in by_doc[key]) == crcs
        assert sum(p["length"] for p in by_doc[key]) == len(texts) * key[1]


def test_query_covers_the_whole_table(spark, tokenizer):
    rows = QUERIES["op2_packing"](spark, "/root/testdata/sf0.01").collect()
    texts = table(spark, "sf0.01", "documents").collect()
    check_cover(rows, [(r["doc_id"], tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]) for r in texts], 2048)
    total = sum(r["length"] for r in rows)
    assert total / (2048 * len({r["sequence_id"] for r in rows})) > 0.99  # little padding


@pytest.mark.parametrize("group_docs", [2, 1000])
def test_awkward_rows_small_groups_and_ids(spark, tokenizer, group_docs):
    rows = awkward()
    packed = packing.pack(docs(spark, rows), group_docs=group_docs, with_ids=True).collect()
    expected = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows]
    check_cover(packed, expected, 2048)
    assert all(zlib.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"] for p in packed)
    assert packing.pack(docs(spark, rows).limit(0)).collect() == []


def naive_rake(totals, shares, budget, rounds=2000):
    x = totals * budget / totals.sum()
    for _ in range(rounds):
        for axis, share in enumerate(shares):
            for i in range(totals.shape[axis]):
                at = [slice(None)] * totals.ndim
                at[axis] = i
                have = x[tuple(at)].sum()
                if have > 0:
                    x[tuple(at)] *= share[i] * budget / have
        x = np.minimum(x, totals)
    return x


def test_rake_meets_margins_and_equals_plain_loops():
    rng = np.random.default_rng(1)
    totals = rng.integers(1000, 3000, (4, 3, 2)).astype(float)
    shares = [np.array([0.3, 0.2, 0.25, 0.25]), np.array([0.5, 0.3, 0.2]), np.array([0.6, 0.4])]
    raked = mixing.rake(totals, shares, 0.4 * totals.sum())
    for axis, share in enumerate(shares):
        others = tuple(i for i in range(3) if i != axis)
        assert np.allclose(raked.sum(others) / raked.sum(), share, atol=1e-6)
    assert np.allclose(raked, naive_rake(totals, shares, 0.4 * totals.sum()), rtol=1e-5)
    assert (raked <= totals).all()
    capped = mixing.rake(totals, [np.array([0.97, 0.01, 0.01, 0.01]), *shares[1:]], 0.5 * totals.sum())
    assert (capped <= totals + 1e-9).all()
    assert mixing.rake(np.zeros((2, 2)), [np.array([0.5, 0.5])] * 2, 0.0).sum() == 0


def test_mixed_query_is_calibrated(spark):
    rows = QUERIES["op7_mixing"](spark, "/root/testdata/sf0.1").toPandas()
    assert len(rows) == table(spark, "sf0.1", "documents").count()
    expected = (rows.n_tokens * rows.probability).groupby(rows.lang).sum()
    for lang, share in mixing.TARGETS["lang"].items():
        assert abs(expected[lang] / expected.sum() - share / sum(mixing.TARGETS["lang"].values())) < 0.03
    drawn = (rows.n_tokens * rows.selected).groupby(rows.lang).sum()
    assert (abs(drawn / expected - 1) < 0.15).all()
    assert abs((rows.n_tokens * rows.probability).sum() / rows.n_tokens.sum() - mixing.Params().budget) < 0.02
    text = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in table(spark, "sf0.001", "documents").collect()}
    small = QUERIES["op7_mixing"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: r["n_tokens"] for r in small} == text


def test_mixing_awkward_rows(spark):
    d = docs(spark, awkward())
    mixed = mixing.mix(d)
    assert mixed.count() == d.count()
    assert mixed.filter("probability IS NULL OR probability < 0 OR probability > 1").count() == 0
    kept = mixing.sample(d)
    assert kept.columns == d.columns and kept.count() <= d.count()
    alike = spark.createDataFrame([(i % 50, "one two", "en", "src0") for i in range(300)], "doc_id long, text string, lang string, source string")
    assert mixing.mix(alike).select("row.doc_id", "selected").distinct().count() == 50
    assert mixing.mix(d.limit(0)).collect() == []


def test_every_source_has_a_target(spark):
    rng = np.random.default_rng(6)
    names = ["hot"] * 10 + [None, "", "(rest)"] + [f"s{i}" for i in range(17)]
    rows = [(i, "one two three four " * int(rng.integers(5, 30)), ["en", "de", "fr", "es"][i % 4], names[int(rng.integers(len(names)))]) for i in range(6000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    params = mixing.Params(budget=0.1)
    mixed = mixing.mix(d, params=params).toPandas()
    expected = (mixed.n_tokens * mixed.probability).groupby(mixed.source.fillna("(rest)")).sum()
    assert len(expected) == 20 and np.allclose(expected / expected.sum(), 1 / 20, atol=1e-4)
    got = {(r["dimension"], r["value"]): r for r in mixing.margins(d, params=params).collect()}
    assert all(got["source", v]["expected"] == pytest.approx(e) for v, e in expected.items())
    assert got["all", None]["asked"] == pytest.approx(0.1 * mixed.n_tokens.sum()) and got["all", None]["expected"] == pytest.approx(expected.sum())
    assert mixing.mix(d.limit(0)).collect() == [] and len(mixing.margins(d.limit(0)).collect()) > 0


def test_what_a_value_lacks_goes_to_the_others():
    totals = np.array([[10.0, 10.0], [300.0, 500.0], [400.0, 200.0]])
    raked = mixing.rake(totals, [np.array([0.4, 0.4, 0.2]), np.array([0.5, 0.5])], 500.0)
    assert np.allclose(raked.sum(1), [20, 320, 160], rtol=1e-3) and np.allclose(raked.sum(0), [250, 250], rtol=1e-3)
    assert mixing.reachable(np.array([0.5, 0.5]), np.array([3.0, 4.0]), 100.0).tolist() == [3, 4]
