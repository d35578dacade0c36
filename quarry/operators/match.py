"""Matching, search and retrieval.

Lexical/semantic search is a character-n-gram TF-IDF index stored as rows
``(doc, gram, weight)``: search is an equi-join on ``gram`` plus a grouped
sum, then ``row_number() <= k`` per query.  No cross join and no pairs that
share nothing: a (query, document) pair exists only when they share a gram.

Queries are de-duplicated before the search and the results joined back,
so a dirty value repeated in a million records is searched once.

Dense vectors have their own module, ``quarry.operators.dense``, and
duplicates within one table theirs, ``quarry.operators.duplicates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators.block_search import block_candidates
from quarry.operators.duplicates import (  # noqa: F401  (part of this module's interface)
    connected_labels,
    exact_duplicates,
    near_duplicate_clusters,
    near_duplicate_members,
    near_duplicate_pairs,
    normalized_text_hash,
    shingle_sets,
    similar_pairs,
    word_shingles,
)
from quarry.operators.relational import first_n


def normalize(text) -> Column:
    """Lower case, letters and digits of any script only."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def char_grams(padded: Column, n: int = 3) -> Column:
    """Array of character n-grams of an already padded string column
    ('^' + normalised + '$'); pass a column reference, not an expression
    (it would be re-evaluated per position inside the lambda)."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda i: F.substring(padded, i, n)
    )


GRAMS_AT_ONCE = 250_000  # of a task that counts them


def _gram_tf(df: DataFrame, id_col: str, text: str, n: int) -> DataFrame:
    """``(id, gram, tf)``, partitioned by id: the texts are dealt to as many tasks as their
    characters take before they become grams, so a task counts a bounded number however
    few splits the texts come in."""
    padded = F.concat(F.lit("^"), normalize(text), F.lit("$"))
    chars = df.agg(F.sum(F.length(text)).cast("long")).first()[0] or 0
    return (
        df.select(F.col(id_col).alias("id"), padded.alias("__s"))
        .filter(F.length("__s") > 2)  # a text without letters or digits has no grams
        .repartition(-(-chars // GRAMS_AT_ONCE) or 1, "id")
        .select("id", F.explode(char_grams(F.col("__s"), n)).alias("gram"))
        .groupBy("id", "gram")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def build_index(corpus: DataFrame, id_col: str, text: str, n: int = 3) -> tuple[DataFrame, DataFrame, Column]:
    """``(index, idf, n_docs)``; index rows ``(id, gram, w)`` L2-normalised.

    Smoothed idf = ln((1 + N) / (1 + df)) + 1, so a gram never seen in the
    corpus still weighs in a query's norm (idf ln(1 + N) + 1).  The index can
    be written bucketed by ``gram`` so searches join without shuffling the
    corpus side.
    """
    tf = _gram_tf(corpus, id_col, text, n)
    n_docs = corpus.select(F.col(id_col)).distinct().agg(F.count(F.lit(1))).scalar()
    idf = tf.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).select(
        "gram", (F.log((n_docs + 1).cast("double") / (F.col("df") + 1)) + 1).alias("idf")
    )
    w = tf.join(idf, "gram").select("id", "gram", (F.col("tf") * F.col("idf")).alias("w"))
    return _unit(w), idf, n_docs


def _unit(w: DataFrame) -> DataFrame:
    """L2-normalise ``w`` per id with one window (one exchange by id, no
    aggregate-and-join-back)."""
    nrm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return w.select("id", "gram", (F.col("w") / nrm).alias("w"))


def index_from_tf(tf: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """E1 from a stored ``(id, gram, tf)`` table (e.g. the one ST3 keeps up to
    date by appending epochs): ``(index, idf, n_docs)`` as ``build_index``
    computes them.  Of a document sent in several epochs (column ``epoch``)
    only the grams of the newest count."""
    if "epoch" in tf.columns:
        newest = tf.groupBy("id").agg(F.max("epoch").alias("epoch"))
        tf = tf.join(newest, ["id", "epoch"], "left_semi")
    tf = tf.groupBy("id", "gram").agg(F.max("tf").alias("tf"))
    n_docs = tf.select("id").distinct().agg(F.count(F.lit(1))).scalar()
    idf = tf.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).select(
        "gram", (F.log((n_docs + 1).cast("double") / (F.col("df") + 1)) + 1).alias("idf")
    )
    w = tf.join(idf, "gram").select("id", "gram", (F.col("tf") * F.col("idf")).alias("w"))
    return _unit(w), idf, n_docs


def query_vectors(queries: DataFrame, id_col: str, text: str, idf: DataFrame, n_docs: Column, n: int = 3) -> DataFrame:
    """Query TF-IDF vectors, L2-normalised over *all* the query's grams."""
    tf = _gram_tf(queries, id_col, text, n)
    unseen = F.log((n_docs + 1).cast("double")) + 1
    w = tf.join(idf, "gram", "left").select(
        "id", "gram", (F.col("tf") * F.coalesce(F.col("idf"), unseen)).alias("w")
    )
    return _unit(w)


def batch_search(
    queries: DataFrame,
    q_id: str,
    q_text: str,
    corpus: DataFrame,
    c_id: str,
    c_text: str,
    k: int,
    n: int = 3,
    digits: int = 6,
    filters: Column | None = None,
    min_score: float | None = None,
    levels: tuple[float, ...] | None = None,
    index: tuple | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """E4/J9/UD3: top-k corpus rows per query with cosine + text-match scores.

    With ``min_score`` only results scoring at least that are returned, and
    the candidate join uses each query's rare-gram prefix only (exact, see
    ``_candidates_above``), which keeps common grams from fanning out.
    With ``levels`` (descending score cuts) the exact top-k is found by a
    cascade (``_cascade_candidates``): only queries without k results above
    every cut reach the full gram join.  With ``blocks`` (documents a block)
    blocks that cannot hold any of a query's top k are skipped, whatever its
    scores (``quarry.operators.block_search``; exact).  ``index`` = a prebuilt
    ``(index, idf, n_docs)`` (``build_index`` / ``index_from_tf``); the
    corpus then only supplies the result texts.

    Output ``(q_id, rank, c_id, cosine_similarity, text_match)``.  Scores are
    rounded to ``digits`` before ranking so ties break on the corpus id, the
    same on every engine.  ``filters`` (E5) is a predicate over the joined
    query/corpus attribute columns (``q_`` and ``c_`` before their names),
    applied to the candidate pairs before any of them counts towards k.
    """
    index, idf, n_docs = index if index is not None else build_index(corpus, c_id, c_text, n)
    qv = query_vectors(queries, q_id, q_text, idf, n_docs, n)
    eps = 10.0 ** (-digits)

    def allowed(cand: DataFrame) -> DataFrame:
        if filters is None:
            return cand
        qa = queries.select(F.col(q_id).alias("qid"), *[F.col(c).alias(f"q_{c}") for c in queries.columns if c != q_id])
        ca = corpus.select(F.col(c_id).alias("cid"), *[F.col(c).alias(f"c_{c}") for c in corpus.columns if c != c_id])
        return cand.join(qa, "qid").join(ca, "cid").filter(filters).select("qid", "cid", "cos")

    if min_score is not None:
        cand = allowed(_candidates_above(qv, index, min_score - eps))
    elif levels:
        cand = _cascade_candidates(qv, index, k, levels, digits, allowed)
    elif blocks:
        cand = block_candidates(qv, index, k, digits, allowed, blocks)
    else:
        cand = allowed(_full_candidates(qv, index))
    cand = cand.withColumn("cosine_similarity", F.round(F.col("cos").cast("decimal(38,12)"), digits).cast("double"))
    if min_score is not None:
        cand = cand.filter(F.col("cosine_similarity") >= min_score)
    top = first_n(cand, "qid", [F.col("cosine_similarity").desc(), F.col("cid")], k, rank_col="rank")
    qt = queries.select(F.col(q_id).alias("qid"), F.col(q_text).alias("__qt"))
    ct = corpus.select(F.col(c_id).alias("cid"), F.col(c_text).alias("__ct"))
    out = top.join(qt, "qid").join(ct, "cid")
    return out.select(
        F.col("qid").alias(q_id),
        F.col("rank"),
        F.col("cid").alias(c_id),
        "cosine_similarity",
        F.round(text_match(F.col("__qt"), F.col("__ct")).cast("decimal(38,12)"), digits).cast("double").alias("text_match"),
    )


def _full_candidates(qv: DataFrame, index: DataFrame) -> DataFrame:
    return qv.alias("q").join(index.alias("c"), "gram").groupBy(
        F.col("q.id").alias("qid"), F.col("c.id").alias("cid")
    ).agg(F.sum(F.col("q.w") * F.col("c.w")).alias("cos"))


def _cascade_candidates(qv: DataFrame, index: DataFrame, k: int, levels, digits: int, allowed) -> DataFrame:
    """Exact top-k candidates by descending score cuts.

    At cut t, candidates come from rare-gram prefixes (``_candidates_above``)
    and every pair scoring >= t is found; a query with at least k of them
    has its whole top-k among them (its k-th best is >= t), so it is done.
    Only the remaining queries go on to the next cut, and finally to the
    full gram join - the only step where a common gram fans out, and only
    for queries without k reasonable matches.  The index and the query
    vectors are written once under the checkpoint folder and shared by the
    levels.
    """
    from quarry.session import scratch_path
    from quarry.sources.sinks import materialize

    spark = qv.sparkSession
    eps = 10.0 ** (-digits)
    index = materialize(index, scratch_path(spark, "search-index"))
    remaining = materialize(qv, scratch_path(spark, "search-queries"))
    parts = []
    for t in sorted(levels, reverse=True):
        cand = allowed(_candidates_above(remaining, index, t - eps))
        rounded = F.round(F.col("cos").cast("decimal(38,12)"), digits).cast("double")
        cand = materialize(cand.filter(rounded >= t), scratch_path(spark, "search-level"))
        done = cand.groupBy("qid").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= k).select("qid")
        parts.append(cand.join(done, "qid", "left_semi"))
        remaining = remaining.join(done.withColumnRenamed("qid", "id"), "id", "left_anti")
    parts.append(allowed(_full_candidates(remaining, index)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _candidates_above(qv: DataFrame, index: DataFrame, t: float) -> DataFrame:
    """Exact candidate pairs with cosine >= t, without joining common grams.

    Vectors are non-negative and unit length, so cos(q, c) <= sqrt(sum of
    q_g^2 over the grams they share).  Sort a query's grams by weight; the
    lightest ones whose squared weights sum below t^2 (the suffix) can never
    reach t on their own, so a pair reaching t shares at least one of the
    remaining (prefix) grams.  Candidates come from the prefix grams only
    (rare, high-idf grams: small fan-out), then every candidate is rescored
    over all its shared grams by a key lookup on (corpus id, gram).
    """
    w = Window.partitionBy("id").orderBy(F.col("w").asc(), F.col("gram").desc()).rowsBetween(Window.unboundedPreceding, 0)
    prefix = qv.withColumn("__cum", F.sum(F.col("w") * F.col("w")).over(w)).filter(F.col("__cum") >= t * t)
    pairs = prefix.alias("q").join(index.alias("c"), "gram").select(
        F.col("q.id").alias("qid"), F.col("c.id").alias("cid")
    ).distinct()
    qg = pairs.join(qv.select(F.col("id").alias("qid"), "gram", F.col("w").alias("wq")), "qid")
    ig = index.select(F.col("id").alias("cid"), "gram", F.col("w").alias("wc"))
    return qg.join(ig, ["cid", "gram"]).groupBy("qid", "cid").agg(F.sum(F.col("wq") * F.col("wc")).alias("cos"))


def word_tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != F.lit("")))


def text_match(a: Column, b: Column) -> Column:
    """Word-set Jaccard similarity (0 when both are empty)."""
    ta, tb = word_tokens(a), word_tokens(b)
    u = F.size(F.array_union(ta, tb))
    return F.when(u == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(ta, tb)) / u)


def above(results: DataFrame, q_id: str, min_score: float, score: str = "cosine_similarity") -> DataFrame:
    """Results above a minimum score, with 'shown n of m' counts and
    the overall score = mean of cosine and text match."""
    w = Window.partitionBy(q_id)
    r = results.withColumn("n_results", F.count(F.lit(1)).over(w))
    r = r.filter(F.col(score) >= min_score).withColumn("n_shown", F.count(F.lit(1)).over(w))
    return r.withColumn("overall", (F.col("cosine_similarity") + F.col("text_match")) / 2)


def _shingle_rows(df: DataFrame, id_col: str, text: str, lengths: list[int], alias: str) -> DataFrame:
    """(alias, sh) with the runs of each of the given numbers of words."""
    from quarry.operators.text import tokens

    t = df.select(F.col(id_col).alias(alias), tokens(text).alias("__tok"))
    runs = F.concat(*[word_shingles(F.col("__tok"), n) for n in lengths])
    return t.select(alias, F.explode(runs).alias("sh"))


def containment_search(queries: DataFrame, q_id: str, q_text: str, corpus: DataFrame, c_id: str, c_text: str, n: int = 3, k: int = 1) -> DataFrame:
    """E4 for passages: per query the k corpus rows sharing the most of its word runs.

    Output ``(q_id, rank, c_id, shared, q_shingles)``, at least one row per
    query: one that shares nothing has a null rank and corpus id and shared 0.
    A query of fewer than ``n`` words is one run of all its words.  The corpus
    side is exploded into runs of the lengths that queries have and streamed
    through the join with the query runs; only what matches survives.
    """
    from quarry.operators.text import tokens

    tok = queries.select(F.col(q_id).alias("qid"), tokens(q_text).alias("__tok"))
    run = F.when(F.size("__tok") >= n, word_shingles(F.col("__tok"), n)).when(F.size("__tok") > 0, F.array(F.array_join("__tok", " ")))
    qs = tok.select("qid", F.explode(run).alias("sh")).distinct()
    qn = tok.select("qid", F.coalesce(F.size(F.array_distinct(run)), F.lit(0)).cast("long").alias("q_shingles"))
    # run lengths that questions have: at most n values
    asked = tok.filter(F.size("__tok") > 0).select(F.least(F.size("__tok"), F.lit(n)).alias("n")).distinct().collect()
    lengths = sorted(r["n"] for r in asked) or [n]
    cs = _shingle_rows(corpus, c_id, c_text, lengths, "cid")
    hits = cs.join(qs, "sh").select("qid", "cid", "sh").distinct()
    cnt = hits.groupBy("qid", "cid").agg(F.count(F.lit(1)).alias("shared"))
    top = first_n(cnt, "qid", [F.col("shared").desc(), F.col("cid")], k, rank_col="rank")
    return qn.join(top, "qid", "left").select(
        F.col("qid").alias(q_id), "rank", F.col("cid").alias(c_id), F.coalesce("shared", F.lit(0)).cast("long").alias("shared"), "q_shingles"
    )


def rag_prompts(results: DataFrame, questions: DataFrame, q_id: str, q_text: str, corpus: DataFrame, c_id: str, c_text: str, template: str, nothing: str = "(no document)") -> DataFrame:
    """One prompt per question from all its retrieved documents.

    Output ``(q_id, n_docs, doc_ids, prompt)``: the documents' texts by rank,
    parted by blank lines, stand in the first %s of ``template`` (``nothing``
    where there are none), the question in the second.
    """
    found = results.filter(F.col(c_id).isNotNull()).join(corpus.select(c_id, F.col(c_text).alias("__c")), c_id)
    context = found.groupBy(q_id).agg(F.array_sort(F.collect_list(F.struct("rank", F.col(c_id).alias("id"), F.col("__c").alias("t")))).alias("__d"))
    r = questions.select(q_id, F.col(q_text).alias("__q")).join(context, q_id, "left")
    text = F.coalesce(F.array_join(F.transform("__d", lambda d: d["t"]), "\n\n"), F.lit(nothing))
    return r.select(
        q_id,
        F.coalesce(F.size("__d"), F.lit(0)).alias("n_docs"),
        F.array_join(F.transform("__d", lambda d: d["id"].cast("string")), ",").alias("doc_ids"),
        F.format_string(template, text, F.coalesce("__q", F.lit(""))).alias("prompt"),
    )
