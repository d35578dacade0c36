"""The SQL table function finds what ``batch_search`` finds (UD3)."""

import pytest

from quarry.operators.match import batch_search
from quarry.operators.search_function import register_search

NAMES = ["Amber Lake", "amber-lake", "Cobalt Ridge", "cobalt", "Ölfeld 42", "x", "", "!!", "Lake Amber Lake", None]


@pytest.fixture(scope="module")
def corpus(spark):
    c = spark.createDataFrame([(i, t) for i, t in enumerate(NAMES)], "id long, name string")
    register_search("find_name", c, "id", "name")
    return c


def test_equal_to_batch_search(spark, corpus):
    asked = ["amber lake", "AMBER  lake", "cobalt", "feld", "x", "?", "", "ridge of amber"]
    q = spark.createDataFrame([(t,) for t in asked] + [(None,)], "q string")
    q.createOrReplaceTempView("asked")
    got = spark.sql("SELECT a.q, m.* FROM asked a, LATERAL find_name(a.q, 3) m").collect()
    want = batch_search(q.filter("q IS NOT NULL"), "q", "q", corpus.filter("name IS NOT NULL"), "id", "name", 3, index=None).collect()
    # a name that is null is a document without grams: it changes the number of documents alone
    register_search("find_held", corpus.filter("name IS NOT NULL"), "id", "name")
    held = spark.sql("SELECT a.q, m.* FROM asked a, LATERAL find_held(a.q, 3) m").collect()
    assert sorted(map(tuple, held)) == sorted((r["q"], r["rank"], r["id"], r["cosine_similarity"], r["text_match"]) for r in want)
    assert {(r["q"], r["rank"]) for r in got} == {(r["q"], r["rank"]) for r in held}


def test_left_join_scores_and_arguments_from_columns(spark, corpus):
    spark.createDataFrame([("amber lake", 1), ("amber lake", 2), ("amber lake", 2), ("?", 2), (None, 1)], "q string, k int").createOrReplaceTempView("per_row")
    n = spark.sql("SELECT p.q, p.k, count(m.id) AS n FROM per_row p LEFT JOIN LATERAL find_name(p.q, p.k) m GROUP BY p.q, p.k").collect()
    assert {(r["q"], r["k"]): r["n"] for r in n} == {("amber lake", 1): 1, ("amber lake", 2): 4, ("?", 2): 0, (None, 1): 0}
    only = spark.sql("SELECT id, cosine_similarity FROM find_name('Amber Lake', at_least => 0.999)").collect()
    assert {r["id"] for r in only} == {0, 1} and all(r["cosine_similarity"] == 1.0 for r in only)


def test_the_call_is_an_equi_join(spark, corpus):
    spark.range(1000).selectExpr("concat('amber ', id) AS q").createOrReplaceTempView("one")
    plan = spark.sql("SELECT * FROM one o, LATERAL find_name(o.q, 2) m")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_names_are_checked_and_empty_corpora_find_nothing(spark, corpus):
    with pytest.raises(ValueError):
        register_search("a; b", corpus, "id", "name")
    register_search("find_none", corpus.limit(0), "id", "name")
    assert spark.sql("SELECT * FROM find_none('amber')").isEmpty()
