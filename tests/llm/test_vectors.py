"""Operators 4 and 9 against brute force."""

import numpy as np
import pytest

from quarry.llm import ann, mips
from quarry.llm.queries import QUERIES
from tests.llm.util import table

ODD = [(None, [1.0, 2.0]), (20, None), (40, []), (60, [float("nan"), 1.0]), (80, [1.0, None]), (100, [float("inf"), 0.0])]
SCHEMA = "vec_id long, embedding array<double>, score string, rank int, part int, id int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, 3) for i, v in rows], SCHEMA)


def vectors(spark, sf):
    rows = table(spark, sf, "embeddings").collect()
    return np.array([r["vec_id"] for r in rows]), np.array([[float(np.float32(x)) for x in r["embedding"]] for r in rows])


def brute(ids, x, every, k):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        m = ids != ids[i]
        order = np.lexsort((ids[m], -s[m]))[:k]
        out[int(ids[i])] = [(int(a), float(b)) for a, b in zip(ids[m][order], s[m][order])]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_of_rotated_codes(spark, sf):
    ids, x = vectors(spark, sf)
    want, got = brute(ids, x, 20, 20), found(QUERIES["op4_rotated_codes"](spark, f"/root/testdata/{sf}").collect())
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.99
    at = {int(i): x[n] for n, i in enumerate(ids)}
    for q, rows in got.items():
        assert all(abs(s - at[v] @ at[q]) < 1e-12 for v, s in rows)
        assert [s for _, s in rows] == sorted((s for _, s in rows), reverse=True)


def test_codes_estimate_within_their_bound():
    x = np.random.default_rng(1).standard_normal((500, 48)) * np.linspace(0.1, 5, 500)[:, None]
    p = ann.Params()
    codes, q = ann.encode(x, p), np.random.default_rng(2).standard_normal(48)
    turned = ann.rotation(48, codes.bits, p.seed) @ q
    products, off = codes.products(turned, 12)
    estimate = products / np.sqrt(codes.bits) / codes.own * codes.length
    bound = np.linalg.norm(q) * codes.length * np.sqrt(1 - codes.own**2) / codes.own * p.epsilon / np.sqrt(codes.bits - 1)
    assert codes.packed.nbytes == 500 * codes.bits // 8
    assert (abs(estimate - x @ q) <= bound).mean() > 0.995
    assert abs(((estimate - x @ q) / bound * p.epsilon).mean()) < 0.25


@pytest.mark.parametrize("part", [8192, 30])
def test_ann_odd_rows_ties_and_lengths(spark, part):
    r = np.random.default_rng(3)
    rows = [(i, r.standard_normal(6).tolist()) for i in range(0, 100)] + [(200 + i, [1.0, 2.0]) for i in range(30)] + [(300, [0.0, 0.0])] + ODD
    got = found(ann.nearest(frame(spark, rows), k=5, params=ann.Params(part=part, epsilon=8.0)).collect())
    six = [(i, v) for i, v in rows[:100]]
    want = brute(np.array([i for i, _ in six]), np.array([v for _, v in six]), 20, 5)
    for q, hits in want.items():
        assert [v for v, _ in got[q]] == [v for v, _ in hits]
    assert [v for v, _ in got[200]] == [201, 202, 203, 204, 205] and [v for v, _ in got[220]] == [200, 201, 202, 203, 204]
    assert 300 not in got and set(got) == {*range(0, 100, 20), 200, 220}
    assert ann.nearest(frame(spark, rows).limit(0)).collect() == []
    assert found(ann.nearest(frame(spark, [(0, [1.0]), (1, [2.0])]), k=5).collect()) == {0: [(1, 2.0)]}


@pytest.mark.parametrize("params", [mips.Params(), mips.Params(part=20, bucket=8, coordinate_from=0.0), mips.Params(part=64, bucket=16, coordinate_from=0.9)])
@pytest.mark.parametrize("shape", ["round", "long tail", "clusters"])
def test_norm_buckets_are_exact(spark, params, shape):
    r = np.random.default_rng(4)
    x = r.standard_normal((260, 8))
    if shape == "long tail":
        x *= np.exp(r.standard_normal(260) * 2)[:, None]
    if shape == "clusters":
        x = x[:10].repeat(26, 0) + 0.05 * x
    x[7], x[11] = 0.0, x[12]
    ids = np.arange(260) * 5
    got = found(mips.top_products(frame(spark, list(zip(ids.tolist(), x.tolist())) + ODD[:1] + [(10_001, [float("nan")] * 8)]), params=params).collect())
    want = brute(ids, np.floor(256 * x), 50, 5)
    assert got == {q: [(v, int(s)) for v, s in rows] for q, rows in want.items()}


def test_buckets_prune():
    """With a long-tailed length distribution most buckets are never verified."""
    r = np.random.default_rng(5)
    x = np.floor(256 * r.standard_normal((4000, 16)) * np.exp(r.standard_normal(4000))[:, None])
    b = mips.NormBuckets(np.arange(4000), x, 5, mips.Params(bucket=64))
    seen = 0
    top = b._top

    def counting(ids, scores):
        nonlocal seen
        seen += len(ids)
        return top(ids, scores)

    b._top = counting
    list(b.search(np.array([-1]), x[:1]))
    assert seen < 1500


def test_mips_odd_rows(spark):
    rows = [(0, [0.0, 0.0]), (50, [0.5, -1.0]), (51, [0.5, -1.0]), (52, [-0.5, 1.0]), *ODD, (150, [1.0]), (151, [3.0])]
    got = found(mips.top_products(frame(spark, rows)).collect())
    assert got[0] == [(50, 0), (51, 0), (52, 0)] and got[50][0] == (51, 128 * 128 + 256 * 256) and got[150] == [(151, 256 * 768)]
    assert set(got) == {0, 50, 150}
    assert mips.top_products(frame(spark, rows).limit(0)).collect() == []


def test_equal_vectors_tie_by_id_wherever_they_lie(spark):
    """Wide vectors, their copies dealt to many parts: equal rows have equal scores."""
    r = np.random.default_rng(8)
    for dim in (16, 33, 64):
        base = r.standard_normal((3, dim))
        rows = [(int(i), [float(x) for x in base[0]]) for i in range(0, 60)] + [(100 + i, [float(x) for x in base[1 + i % 2]]) for i in range(20)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        for part in (8, 8192):
            got = {(x["query_id"], x["rank"]): (x["vec_id"], x["score"]) for x in ann.nearest(df, 20, 20, params=ann.Params(part=part)).collect()}
            assert [got[0, k][0] for k in range(1, 21)] == list(range(1, 21))
            assert len({got[0, k][1] for k in range(1, 21)}) == 1


def test_products_have_one_value_whatever_the_matrix():
    r = np.random.default_rng(9)
    for dim in (1, 2, 3, 7, 16, 33, 64, 100):
        rows, q = r.standard_normal((50, dim)), r.standard_normal(dim)
        want = ann.exact(rows, q)
        assert np.allclose(want, rows @ q)
        assert all(ann.exact(rows[i : i + 1], q)[0] == want[i] for i in range(50))
        assert (ann.exact(rows[::-1][::2], q) == want[::-1][::2]).all()


@pytest.mark.parametrize("dim", [5, 64, 100])
def test_packed_products_equal_signed_sums(dim):
    r = np.random.default_rng(dim)
    p = ann.Params()
    codes = ann.encode(r.standard_normal((40, dim)), p)
    signs = np.unpackbits(codes.packed.view(np.uint8), axis=1).astype(float) * 2 - 1
    q = r.standard_normal(dim) @ ann.rotation(dim, codes.bits, p.seed).T
    products, off = codes.products(q, p.planes)
    assert (np.abs(products - signs @ q) <= off + 1e-9).all()


def test_codes_leave_rows_out():
    """Clustered vectors: few rows are multiplied out, and none of the nearest is lost."""
    r = np.random.default_rng(10)
    centres = r.standard_normal((40, 64))
    rows = centres[r.integers(0, 40, 8000)] + 0.3 * r.standard_normal((8000, 64))
    part = ann.CodedPart(np.arange(8000), rows, 20, ann.Params())
    hits = 0
    for query, found, _ in part.search(np.arange(0, 8000, 400), rows[::400]):
        scores = rows @ rows[query]
        scores[query] = -np.inf
        hits += len(set(found.tolist()) & set(np.argsort(-scores)[:20].tolist()))
    assert hits >= 0.99 * 20 * 20
    assert part.reranked < 0.15 * part.seen


def test_products_beyond_doubles_are_exact(spark):
    """Products near 2^60 that differ by little: integers tell them apart, and equal ones tie by id."""
    r = np.random.default_rng(12)
    rows = r.integers(2**20, 2**21, (400, 16)).astype(float) + np.floor(r.random((400, 16)) * 256) / 256
    rows[200:] = rows[:200]
    rows[100:110] = rows[0]
    rows[100:110, 3] += np.arange(10) / 256
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    whole = [[int(x * 256) for x in v] for v in rows]
    for part in (50, 8192):
        got = {}
        for x in mips.top_products(df, 5, 50, params=mips.Params(part=part, bucket=16)).collect():
            got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
        for q in range(0, 400, 50):
            scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in enumerate(whole) if i != q)[:5]
            assert sorted(got[q]) == [(k, i, -s) for k, (s, i) in enumerate(scores, 1)]
