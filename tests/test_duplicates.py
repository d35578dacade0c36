"""Clusters without the pairs of a family, against brute force and at size."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import duplicates
from quarry.operators.duplicates import near_duplicate_clusters, near_duplicate_members


def words(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha() or c.isnumeric():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def runs(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else {" ".join((text or "").lower().split())}


def brute(rows, t=0.8):
    sets = [(i, runs(x)) for i, x in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    score = {}
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            score[i, j] = score[j, i] = len(a & b) / len(a | b)
            if score[i, j] >= t - 1e-12:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    label = {i: find(i) for i, _ in rows}
    size = {x: sum(v == x for v in label.values()) for x in label.values()}
    return {i: (x, size[x], round(score.get((i, x), 1.0), 9)) for i, x in label.items() if size[x] > 1}


def families(seed, n=6, size=20):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(n):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 8, 40, 90]))]
        for _ in range(size):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            rows.append(" ".join(w[r.randrange(2) :]))
    r.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("seed,open_per_set,hubs", [(1, 8, 8), (2, 0, 1), (3, 0, 3), (4, 1, 2)])
def test_clusters_equal_brute_force(spark, monkeypatch, seed, open_per_set, hubs):
    """Also when every bucket goes through rounds of one or few hubs."""
    monkeypatch.setattr(duplicates, "OPEN_PER_SET", open_per_set)
    monkeypatch.setattr(duplicates, "HUBS", hubs)
    rows = families(seed) + [(1, None), (2, ""), (3, "!!"), (4, "!!"), (5, "one two"), (6, "One, two")]
    df = spark.createDataFrame(rows, "id long, t string").withColumn("label", F.lit("x")).withColumn("n", F.lit(1))
    got = {r.id: (r.cluster_id, r.cluster_size) for r in near_duplicate_clusters(df, "id", "t").collect()}
    want = brute(rows)
    assert got == {i: v[:2] for i, v in want.items()}
    if seed < 3:
        scores = {r.id: (r.cluster_id, round(r.jaccard, 9)) for r in near_duplicate_members(df, "id", "t").collect()}
        assert scores == {i: (v[0], v[2]) for i, v in want.items()}


def test_numbers_are_words(spark):
    rows = [(1, "invoice 100 due 2024 total 55 paid 1"), (2, "invoice 999 due 1971 total 3 paid 0"), (3, "Invoice 100, due 2024: total 55, paid 1")]
    got = {r.id: r.cluster_id for r in near_duplicate_clusters(spark.createDataFrame(rows, "id long, t string"), "id", "t").collect()}
    assert got == {1: 1, 3: 1}


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, t string")
    assert near_duplicate_clusters(df, "id", "t").collect() == []
    assert near_duplicate_members(df, "id", "t").collect() == []


def family(spark, copies, length):
    """``copies`` texts of one base, each with one word replaced at a place that moves on; no text is the base."""
    base = [f"b{i}" for i in range(length)]
    place = F.col("id") % length
    word = F.concat(F.lit("x"), F.col("id"))
    text = F.concat_ws(" ", *[F.when(place == i, word).otherwise(F.lit(base[i])) for i in range(length)])
    return spark.range(copies).select("id", text.alias("t"))


def test_a_family_of_50_000_copies_costs_rows_not_pairs(spark, monkeypatch):
    """Copies link with those edited at the same place or the next: one long chain of 50,000 different texts."""
    compared = []
    plain = duplicates.scored
    monkeypatch.setattr(duplicates, "scored", lambda pairs, sets: compared.append(pairs.count()) or plain(pairs, sets))
    got = near_duplicate_clusters(family(spark, 50_000, 60), "id", "t")
    assert [tuple(r) for r in got.groupBy("cluster_id", "cluster_size").count().collect()] == [(0, 50_000, 50_000)]
    assert sum(compared) < 40 * 50_000, compared  # all pairs: 1,250 million


def test_scores_hold_every_link_between_different_texts(spark, tmp_path):
    """Not only those with a cluster's smallest id: a chain of texts has a row per link, and a copy has none of its own."""
    from quarry.plans.retrieval import near_duplicate_scores

    base = [f"b{i}" for i in range(60)]
    texts = [" ".join(base[i:]) for i in (0, 4, 8, 12)]
    rows = list(enumerate(texts, 1)) + [(9, texts[1])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.id_a, r.id_b): r.jaccard for r in near_duplicate_scores(spark, str(tmp_path)).collect()}
    sets = [(i, runs(x)) for i, x in rows[:4]]
    want = {(i, j): round(len(a & b) / len(a | b), 6) for i, a in sets for j, b in sets if i < j and len(a & b) / len(a | b) >= 0.8}
    assert got == want and (2, 3) in got and (3, 4) in got


def test_scores_hold_every_document_of_a_cluster(spark, tmp_path):
    """Copies, texts whose copies are all they link with, and members that are far from the cluster's smallest id; each with its closest link."""
    import duckdb

    from quarry.plans.retrieval import NEAR_SCORES_SQL, near_duplicate_scores
    from tests.oracle_util import rows_equal

    base = [f"b{i}" for i in range(60)]
    texts = [" ".join(base[i:]) for i in (0, 4, 8, 12, 16, 20, 24)]
    rows = list(enumerate(texts, 1)) + [(9, texts[1]), (20, "one two three"), (21, "One, two three"), (30, "alone"), (40, None), (41, "")]
    spark.createDataFrame([*rows, (30, "alone"), (None, "one two three")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = near_duplicate_scores(spark, str(tmp_path))
    got = {r.doc_id: r for r in found.collect() if r.doc_id is not None}
    want = brute(rows)
    assert {i: (r.cluster_id, r.cluster_jaccard) for i, r in got.items()} == {i: (v[0], round(v[2], 6)) for i, v in want.items()}
    assert found.filter("doc_id IS NOT NULL").count() == len(got) and set(got) == {1, 2, 3, 4, 5, 6, 7, 9, 20, 21, 40, 41}
    assert {i: r.rep_id for i, r in got.items() if r.rep_id != i} == {9: 2, 21: 20, 41: 40}
    assert min(r.cluster_jaccard for r in got.values()) < 0.8
    links = {(r.id_a, r.id_b): r.jaccard for r in found.collect() if r.doc_id is None}
    for i, r in got.items():
        own = [(-v, k) for k, v in links.items() if r.rep_id in k]
        assert (r.id_a, r.id_b, r.jaccard) == ((*min(own)[1], -min(own)[0]) if own else (None, None, None)), i
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rows_equal(found, con, NEAR_SCORES_SQL)


def test_scores_of_an_empty_table(spark, tmp_path):
    from quarry.plans.retrieval import near_duplicate_scores

    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = near_duplicate_scores(spark, str(tmp_path))
    assert found.collect() == [] and found.columns[3:] == ["doc_id", "rep_id", "cluster_id", "cluster_jaccard"]


def test_runs_are_shuffled_once_and_only_linkable_sets_are_scored(spark):
    rows = [(i, x) for i, x in enumerate(families(7, n=2, size=6))] + [(100 + i, " ".join(f"u{i}x{j}" for j in range(30))) for i in range(20)]
    rows += [(200 + i, x) for i, x in rows[:3]]
    _, sets = duplicates.distinct_sets(spark.createDataFrame(rows, "id long, t string"), "id", "t", 5)
    entries = duplicates.prefix_entries(sets, 0.8)
    assert entries._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") <= 2  # one in each side of the smallest sizes' join, which reuse one shuffle
    assert "left_semi" not in entries._jdf.queryExecution().optimizedPlan().toString().lower()
    entries, kept = duplicates.linkable(sets, 0.8)
    ids = {r.id for r in kept.collect()}
    assert ids and ids <= set(range(12))  # neither texts without a shared run nor copies
    assert {r.id for r in entries.select("id").distinct().collect()} == ids
