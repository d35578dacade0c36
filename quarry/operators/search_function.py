"""UD3: the top-k name search as a table function for SQL users.

``register_search`` writes the index of a corpus once and creates a temporary SQL
function over it, to be called beside any table of a query:

    SELECT d.name, m.* FROM dirty d, LATERAL find_name(d.name, 5) m

The function's body is SQL, so Catalyst takes the call apart: the calls' distinct
arguments become rows, their grams are joined with the index by equality, and
ranks are windows within an argument.  No Python runs per row, a text asked a
million times is searched once, and nothing is collected.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.match import build_index
from quarry.session import scratch_path
from quarry.sources.sinks import materialize

BODY = """
CREATE OR REPLACE TEMPORARY FUNCTION {name}(q STRING, k INT DEFAULT 5, at_least DOUBLE DEFAULT 0.0)
RETURNS TABLE(rank INT, {c_id} {id_type}, cosine_similarity DOUBLE, text_match DOUBLE)
RETURN
SELECT t.rank, t.id, t.cosine, round(CAST({match} AS DECIMAL(38,12)), {digits})
FROM (
  SELECT id, cosine, row_number() OVER (ORDER BY cosine DESC, id) AS rank FROM (
    SELECT c.id, CAST(round(CAST(sum(v.w * c.w) AS DECIMAL(38,12)), {digits}) AS DOUBLE) AS cosine
    FROM (
      SELECT gram, w / sqrt(sum(w * w) OVER ()) AS w FROM (
        SELECT g.gram, g.tf * coalesce(i.idf, {unseen}) AS w
        FROM (
          SELECT gram, count(*) AS tf
          FROM (SELECT explode(CASE WHEN length({padded}) > 2 THEN
                  transform(sequence(1, greatest(length({padded}) - {n} + 1, 1)), i -> substring({padded}, i, {n})) END) AS gram)
          GROUP BY gram
        ) g LEFT JOIN {idf} i ON i.gram = g.gram
      )
    ) v JOIN {index} c ON c.gram = v.gram
    GROUP BY c.id
  ) WHERE cosine >= at_least
) t JOIN {corpus} x ON x.id = t.id
WHERE t.rank <= k
"""


def _tokens(x: str) -> str:
    return f"array_distinct(filter(split(lower({x}), r'[^\\p{{L}}\\p{{N}}]+'), w -> w <> ''))"


def register_search(name: str, corpus: DataFrame, c_id: str, c_text: str, n: int = 3, digits: int = 6, index: tuple | None = None) -> None:
    """Create the temporary SQL table function ``name(q, k = 5, at_least = 0)``.

    It returns ``(rank, <c_id>, cosine_similarity, text_match)``: the ``k`` corpus rows
    nearest to the text ``q`` that share a run of ``n`` characters with it and whose
    cosine reaches ``at_least``, as ``batch_search`` ranks them (ties to the smaller id).
    A null text, or one without letters and digits, finds nothing.  ``index``: a prebuilt one, as for ``batch_search``.
    The written index is that of now: register again after the corpus has changed.
    """
    if not re.fullmatch(r"[A-Za-z_]\w*", name) or n < 2:
        raise ValueError("a plain function name, and runs of two characters or more")
    spark = corpus.sparkSession
    rows, idf, n_docs = index if index is not None else build_index(corpus, c_id, c_text, n)
    texts = corpus.select(F.col(c_id).alias("id"), F.col(c_text).alias("text"))
    views = {}
    for part, df in (("index", rows), ("idf", idf), ("corpus", texts)):
        path = scratch_path(spark, f"search-{part}")
        views[part] = path.rsplit("/", 1)[1].replace("-", "_")  # as unique as the folder: earlier functions keep theirs
        materialize(df, path).createOrReplaceTempView(views[part])
    held = spark.range(1).select(n_docs.cast("double").alias("n")).first()["n"]
    padded = "concat('^', regexp_replace(lower(q), r'[^\\p{L}\\p{N}]', ''), '$')"
    both = f"size(array_union({_tokens('q')}, {_tokens('x.text')}))"
    match = f"CASE WHEN {both} = 0 THEN 0.0D ELSE size(array_intersect({_tokens('q')}, {_tokens('x.text')})) / {both} END"
    id_type = corpus.schema[c_id].dataType.simpleString()
    unseen = f"(ln({held!r}D + 1) + 1)"
    spark.sql(BODY.format(name=name, c_id=f"`{c_id}`", id_type=id_type, match=match, digits=digits, padded=padded, n=n, unseen=unseen, **views))
