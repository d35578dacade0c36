"""Duplicate candidates within one table.

* Exact: one hash aggregate per normalised text.
* Near: the Jaccard similarity of the sets of word runs reaches a threshold.
  Equal sets are folded, and a set meets others only in the buckets of its
  rare runs (prefix filter), so texts that share nothing rare never meet.

Clusters need no pairs of a family.  A bucket of few open pairs is settled by
them; in a larger one all sets are compared with a few hubs, what links is
labelled with its component, and only sets of different components are still
open in the next round.  So n near copies cost about n comparisons a round,
whatever n, and every pair that might join two components is compared in the
end: the clusters are exactly those of all links.

Everything is joins, aggregates and windows over rows of (run, id); components
and links of a round are written, which cuts the lineage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.session import scratch_path
from quarry.sources.sinks import materialize

WORD_SPLIT = r"[^\p{L}\p{N}]+"  # numbers are words: invoices of different amounts are different texts
HUBS = 8  # sets of a large bucket that all its others are compared with in a round
OPEN_PER_SET = 8  # open pairs a set of a bucket that is settled by its pairs
ROUNDS = 6  # rounds of hubs; then what is open is settled by its pairs


def normalized_text_hash(text) -> Column:
    """md5 of lower-cased text with blank runs collapsed."""
    c = F.col(text) if isinstance(text, str) else text
    return F.md5(F.trim(F.regexp_replace(F.lower(c), r"[ \t\n\r\f]+", " ")))


def exact_duplicates(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """E11 (exact part): rows whose normalised text occurs more than once,
    with the group's representative (smallest id) and size.

    One hash aggregate per text hash (map-side partial), no pairs: a text
    copied a million times is one group row, not 10^12 pairs.
    """
    h = df.select(F.col(id_col), normalized_text_hash(text).alias("text_hash"))
    groups = h.groupBy("text_hash").agg(F.min(id_col).alias("rep_id"), F.count(F.lit(1)).alias("n_copies"))
    groups = groups.filter(F.col("n_copies") > 1)
    return h.join(groups, "text_hash")


def word_shingles(tok: Column, n: int) -> Column:
    """Array of word n-grams of a token-array column, joined by ' '.

    Pass a column *reference* (tokens computed once beforehand): an
    expression used inside the lambda would be re-evaluated per position.
    """
    return F.when(
        F.size(tok) >= n,
        F.transform(F.sequence(F.lit(1), F.size(tok) - (n - 1)), lambda i: F.array_join(F.slice(tok, i, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


# ------------------------------------------------------------------ components


def connected_labels(edges: DataFrame) -> DataFrame:
    """Connected components of a node-bucket graph ``(id, bk)`` by min-label
    propagation: ``(id, label)`` with label = smallest id of the component.

    Each round is two grouped minimums (hot buckets are handled by the
    map-side partial aggregate) plus one pointer-jumping join, which shortens
    label chains geometrically.  The round's labels are written under the
    shared checkpoint folder with those before them and read back, which cuts
    the lineage to one round.  Ends when no label changes; labels only fall,
    so it does end.
    """
    spark = edges.sparkSession
    edges = materialize(edges, scratch_path(spark, "cc-edges"))
    labels = materialize(edges.groupBy("id").agg(F.min("id").alias("label")), scratch_path(spark, "cc-labels"))
    while True:
        bl = edges.join(labels, "id").groupBy("bk").agg(F.min("label").alias("bl"))
        nl = edges.join(bl, "bk").groupBy("id").agg(F.min("bl").alias("label"))
        hop = labels.select(F.col("id").alias("__l"), F.col("label").alias("__ll"))
        nl = nl.join(hop, nl["label"] == hop["__l"], "left").select("id", F.least(F.col("label"), F.coalesce(F.col("__ll"), F.col("label"))).alias("label"))
        nl = nl.join(labels.withColumnRenamed("label", "__before"), "id")
        nl = materialize(nl, scratch_path(spark, "cc-labels"))
        labels = nl.select("id", "label")
        if nl.filter(F.col("label") != F.col("__before")).isEmpty():
            return labels


# ------------------------------------------------------------------- near copies


def shingle_sets(df: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """``(id, sh, set_key)``: sorted distinct hashes of a text's word runs, and a key of the whole set.

    Words are runs of letters and digits in lower case.  A text shorter than
    one run is one run of its words, or of its normalised text when it has
    none, so exact copies always have equal sets.
    """
    words = F.filter(F.split(F.lower(F.col(text)), WORD_SPLIT), lambda w: w != F.lit(""))
    t = df.select(F.col(id_col).alias("id"), F.transform(words, lambda w: F.xxhash64(w)).alias("__w"), F.coalesce(F.col(text), F.lit("")).alias("__txt"))
    w = F.col("__w")
    # a run is hashed from its words' hashes: no string is built per run
    runs = (
        F.when(F.size(w) >= shingle, F.transform(F.sequence(F.lit(0), F.size(w) - shingle), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)])))
        .when(F.size(w) > 0, F.array(F.xxhash64(w)))
        .otherwise(F.array(F.xxhash64(F.trim(F.regexp_replace(F.lower(F.col("__txt")), r"[ \t\n\r\f]+", " ")))))
    )
    sh = F.array_sort(F.array_distinct(runs))
    return t.select("id", sh.alias("sh")).withColumn("set_key", F.struct(F.xxhash64("sh"), F.xxhash64(F.reverse("sh")), F.size("sh")))


def distinct_sets(df: DataFrame, id_col: str, text: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """``(members, sets)``: each text's representative (smallest id with an equal set), and the written sets ``(id, sh, set_key)`` of all texts."""
    sets = materialize(shingle_sets(df, id_col, text, shingle), scratch_path(df.sparkSession, "shingle-sets"))
    reps = sets.groupBy("set_key").agg(F.min("id").alias("rep_id"))
    members = sets.select("id", "set_key").join(reps, "set_key").select("id", "rep_id")
    return members, sets


def prefix_entries(sets: DataFrame, threshold: float) -> DataFrame:
    """``(r, id, n, most, central)``: the runs in which a set meets others, its size, the largest set it can
    link with, and how widely shared its runs are; of equal sets, those of the smallest id.

    Runs are ordered by how many sets hold them, rarest first.  Two sets that
    reach the threshold t share a run among the first n - ceil(t * n) + 1 of
    each.  They share t / (1 + t) of their sizes' sum, and a set shares no more
    than the m of its runs that other sets have too: that bounds the size of
    what it can link with, and a set is left out of buckets whose smallest set
    is larger.  Runs of one set alone are only counted.

    The runs of all sets are shuffled once: where a run's rows meet, equal sets
    are folded by their hash ``k`` and the run is counted.
    """
    # the written hash: one computed here would be computed again for each run
    runs = sets.select(F.col("set_key.col1").alias("k"), F.col("set_key.col3").alias("n"), F.explode("sh").alias("r")).repartition("r")
    copy = Window.partitionBy("r", "k", "n").orderBy("k")
    runs = runs.withColumn("__c", F.row_number().over(copy)).filter("__c = 1").drop("__c")
    shared = runs.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("r"))).filter("df > 1")
    need = F.ceil(F.col("n") * threshold - 1e-9)
    whole = Window.partitionBy("k", "n")
    held = shared.withColumn("m", F.count(F.lit(1)).over(whole)).withColumn("central", F.sum(F.log2("df")).over(whole) / F.col("n"))
    order = Window.partitionBy("k", "n").orderBy("df", "r")
    place = F.row_number().over(order) + F.col("n") - F.col("m")
    most = F.floor(F.col("m") * ((1 + threshold) / threshold) - F.col("n") + 1e-6)
    held = held.filter(F.col("m") >= need).withColumn("i", place).filter(F.col("i") <= F.col("n") - need + 1).withColumn("most", most).filter(F.col("most") >= need)
    reps = sets.groupBy(F.col("set_key.col1").alias("k"), F.col("set_key.col3").alias("n"), "set_key").agg(F.min("id").alias("id")).drop("set_key")
    held = held.join(reps, ["k", "n"])
    least = held.groupBy("r").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    return held.join(least, "r").filter("most >= least").select("r", "id", "n", "most", "central")


def linkable(sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``(entries, kept)``: the written ``prefix_entries``, and the sets ``(id, sh)`` that have any; pairs are scored on these alone."""
    spark = sets.sparkSession
    entries = materialize(prefix_entries(sets, threshold), scratch_path(spark, "near-entries"))
    kept = sets.join(entries.select("id").distinct(), "id", "left_semi").select("id", "sh")
    return entries, materialize(kept, scratch_path(spark, "near-sets"))


def _alike(threshold: float) -> Column:
    """Sizes of two entries that can reach the threshold."""
    sizes = (F.col("n_a") >= threshold * F.col("n_b") - 1e-9) & (F.col("n_b") >= threshold * F.col("n_a") - 1e-9)
    return sizes & (F.col("n_a") <= F.col("most_b")) & (F.col("n_b") <= F.col("most_a"))


def scored(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(id_a, id_b, jaccard)`` of pairs of sets."""
    a, b = (sets.select(F.col("id").alias(f"id_{x}"), F.col("sh").alias(f"s{x}")) for x in "ab")
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.select("id_a", "id_b").join(a, "id_a").join(b, "id_b").select("id_a", "id_b", (common / (F.size("sa") + F.size("sb") - common)).alias("jaccard"))


def similar_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """``(id_a, id_b, jaccard)`` of all different ``sets`` with Jaccard >= ``threshold``, each pair once.

    The result holds every pair of a family; ``near_links`` has the same
    components without them.
    """
    return _all_links(*linkable(sets, threshold), threshold)


def _all_links(entries: DataFrame, kept: DataFrame, threshold: float) -> DataFrame:
    """``similar_pairs`` of ``linkable`` sets."""
    a, b = (entries.select("r", *[F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "most")]) for x in "ab")
    cand = a.join(b, "r").filter((F.col("id_a") < F.col("id_b")) & _alike(threshold)).select("id_a", "id_b").distinct()
    return scored(cand, kept).filter(F.col("jaccard") >= threshold - 1e-12)


def _open(entries: DataFrame, last: bool) -> DataFrame:
    """Entries of buckets with more than one label; ``settle`` tells whether the pairs of different labels are compared now."""
    per = entries.groupBy("r", "label").agg(F.count(F.lit(1)).alias("k"))
    per = per.groupBy("r").agg(F.sum("k").alias("sets"), F.sum(F.col("k") * F.col("k")).alias("same"), F.count(F.lit(1)).alias("labels"))
    few = (F.col("sets") * F.col("sets") - F.col("same")) / 2 <= OPEN_PER_SET * F.col("sets")
    return entries.join(per.filter("labels > 1").select("r", (few | F.lit(last)).alias("settle")), "r")


def near_links(entries: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``(id_a, id_b)`` links of ``linkable`` sets that connect exactly what all links of Jaccard >= ``threshold`` connect."""
    spark = sets.sparkSession
    entries = entries.withColumn("label", F.col("id"))
    found: list[DataFrame] = []
    stuck = False
    for round_ in range(ROUNDS + 1):
        entries = materialize(_open(entries, stuck or round_ == ROUNDS), scratch_path(spark, "near-open"))
        a, b = (entries.select("r", "settle", *[F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "most", "label", "central")]) for x in "ab")
        # the first hubs are the sets with the most widely shared runs, later ones any, the same in every bucket that has them
        first = [F.desc("central_b"), F.col("id_b")] if round_ == 0 else [F.xxhash64("id_b", F.lit(round_)), F.col("id_b")]
        hubs = b.filter("NOT settle").withColumn("__i", F.row_number().over(Window.partitionBy("r").orderBy(*first))).filter(F.col("__i") <= HUBS).drop("__i", "settle")
        near = (F.col("label_a") != F.col("label_b")) & _alike(threshold)
        settled = a.filter("settle").join(b.filter("settle").drop("settle"), "r").filter((F.col("id_a") < F.col("id_b")) & near)
        compared = a.filter("NOT settle").join(hubs, "r").filter((F.col("id_a") != F.col("id_b")) & near)
        pairs = [p.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")) for p in (settled, compared)]
        links = scored(pairs[0].unionByName(pairs[1]).distinct(), sets).filter(F.col("jaccard") >= threshold - 1e-12).select("id_a", "id_b")
        found.append(materialize(links, scratch_path(spark, "near-links")))
        entries = entries.filter("NOT settle").drop("settle", "label")
        if entries.isEmpty():
            break
        stuck = found[-1].isEmpty()  # hubs that link nothing will hardly link more
        labels = connected_labels(_buckets(reduce(DataFrame.unionByName, found)))
        entries = entries.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    return reduce(DataFrame.unionByName, found)


def _buckets(links: DataFrame) -> DataFrame:
    """Links as the ``(id, bk)`` rows of ``connected_labels``."""
    return links.select(F.explode(F.array("id_a", "id_b")).alias("id"), F.struct("id_a", "id_b").alias("bk"))


def near_duplicate_pairs(df: DataFrame, id_col: str, text: str, threshold: float = 0.8, shingle: int = 5) -> tuple[DataFrame, DataFrame]:
    """``(members, pairs)``: each text's representative (smallest id with
    an equal set), and all pairs of representatives reaching ``threshold``."""
    members, sets = distinct_sets(df, id_col, text, shingle)
    return members, similar_pairs(sets, threshold)


def _clusters(members: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, rep_id, label)`` of every text in a cluster of two or more."""
    labels = connected_labels(_buckets(links))
    all_labels = members.join(labels.withColumnRenamed("id", "rep_id"), "rep_id", "left").withColumn("label", F.coalesce("label", "rep_id"))
    size = all_labels.groupBy("label").agg(F.count(F.lit(1)).alias("cluster_size")).filter("cluster_size > 1")
    return all_labels.join(size, "label")


def near_duplicate_clusters(df: DataFrame, id_col: str, text: str, threshold: float = 0.8, shingle: int = 5) -> DataFrame:
    """Clusters of texts connected by Jaccard >= ``threshold``, as
    ``(id, cluster_id, cluster_size)`` for clusters of two or more.

    ``cluster_id`` is the smallest id of the cluster.  A null text is the
    empty text; rows without words are alike when their normalised texts are.
    """
    members, sets = distinct_sets(df, id_col, text, shingle)
    links = near_links(*linkable(sets, threshold), threshold)
    return _clusters(members, links).select(F.col("id").alias(id_col), F.col("label").alias("cluster_id"), "cluster_size")


def _held(members: DataFrame, links: DataFrame) -> DataFrame:
    """The written ``_clusters``."""
    return materialize(_clusters(members, links).select("id", "rep_id", "label"), scratch_path(members.sparkSession, "near-members"))


def _ties(held: DataFrame) -> DataFrame:
    """``(id_a, id_b)`` of each cluster's smallest id and the other representatives of the cluster."""
    return held.filter("label <> rep_id").select(F.col("label").alias("id_a"), F.col("rep_id").alias("id_b")).distinct()


def _with_scores(held: DataFrame, scores: DataFrame) -> DataFrame:
    """``held`` with the ``jaccard`` of each text and its cluster's smallest id, of the scores of ``_ties``."""
    scores = scores.select(F.col("id_a").alias("label"), F.col("id_b").alias("rep_id"), "jaccard")
    jaccard = F.when(F.col("label") == F.col("rep_id"), 1.0).otherwise(F.col("jaccard"))
    return held.join(scores, ["label", "rep_id"], "left").withColumn("jaccard", jaccard)


def near_duplicate_members(df: DataFrame, id_col: str, text: str, threshold: float = 0.8, shingle: int = 5) -> DataFrame:
    """``(id, cluster_id, jaccard)``: the texts of each cluster with their similarity to its representative, the text with the smallest id."""
    members, sets = distinct_sets(df, id_col, text, shingle)
    entries, kept = linkable(sets, threshold)
    held = _held(members, near_links(entries, kept, threshold))
    found = _with_scores(held, scored(_ties(held), kept))
    return found.select(F.col("id").alias(id_col), F.col("label").alias("cluster_id"), "jaccard")


def near_duplicate_families(df: DataFrame, id_col: str, text: str, threshold: float = 0.8, shingle: int = 5) -> tuple[DataFrame, DataFrame]:
    """``(members, pairs)``: the texts of each cluster as ``(id, rep_id, cluster_id, jaccard)``, with their
    representative (smallest id with an equal set) and their similarity to the cluster's smallest id, and the
    pairs of ``near_duplicate_pairs``, written.  An id that comes twice is one member, and a null id none.

    The pairs are all found, so the clusters are theirs; a member is scored here when it has no pair with the smallest id.
    """
    spark = df.sparkSession
    members, sets = distinct_sets(df, id_col, text, shingle)
    entries, kept = linkable(sets, threshold)
    pairs = materialize(_all_links(entries, kept, threshold), scratch_path(spark, "near-pairs"))
    held = _held(members.filter(F.col("id").isNotNull()).distinct(), pairs)
    far = materialize(_ties(held).join(pairs, ["id_a", "id_b"], "left_anti"), scratch_path(spark, "near-ties"))
    ends = far.select(F.explode(F.array("id_a", "id_b")).alias("id")).distinct()
    scores = scored(far, kept.join(ends, "id", "left_semi")).unionByName(pairs).groupBy("id_a", "id_b").agg(F.max("jaccard").alias("jaccard"))
    found = _with_scores(held, scores)
    return found.select(F.col("id").alias(id_col), "rep_id", F.col("label").alias("cluster_id"), "jaccard"), pairs
