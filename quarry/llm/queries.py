"""Registered queries of the training-data operators: thin calls with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import ann, chat, jaccard, lexical, mips, mixing, packing, periodic, pii, quality, secret_scan, substring, toxicity
from quarry.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return add


def span_digest(spans, kinds: tuple[str, ...]):
    """``kind:start:end`` of an array of spans by start, then kind as listed, comma-joined."""
    order = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("s"), order[s["kind"]].alias("k"), s["end"].alias("e"), s["kind"].alias("n"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["n"], s["s"].cast("string"), s["e"].cast("string"))), ",")


def digest_columns(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """The contract's columns of a span operator's result."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, kinds), F.sha2(span_digest(base, kinds), 256).alias("base_sha256"), span_digest(F.col("spans"), kinds).alias("spans"))


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(pii.find_pii(load(spark, sf_dir, "documents")), pii.KINDS)


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(secret_scan.find_secrets(load(spark, sf_dir, "documents")), secret_scan.KINDS)


@query(
    "op9_norm_buckets",
    oracle="""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
               WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op9_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mips.top_products(load(spark, sf_dir, "embeddings"))


@query("op4_rotated_codes")
def op4_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(load(spark, sf_dir, "embeddings"))


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(load(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "source", "lang", "topic", "n_tokens", "probability", "selected")


@query(
    "op3_substring_dedup",
    oracle=r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    x AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20),
    g AS (SELECT doc_id, i, array_to_string(w[i:i+19], ' ') AS k FROM x),
    r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM g),
    c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM r WHERE n > 1),
    p AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS p, unnest(w) AS word FROM d),
    s AS (SELECT p.doc_id, count(c.p) AS n_removed, coalesce(string_agg(CASE WHEN c.p IS NULL THEN word END, ' ' ORDER BY p.p), '') AS kept
          FROM p LEFT JOIN c ON p.doc_id = c.doc_id AND p.p = c.p GROUP BY p.doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN s ON d.doc_id = s.doc_id
    """,
)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = substring.remove_repeats(load(spark, sf_dir, "documents"))
    return stripped.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op8_jaccard_join",
    oracle=r"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    x AS (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0),
    g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM x),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM o JOIN n x ON o.a = x.doc_id JOIN n y ON o.b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
    e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
    r AS (SELECT doc_id AS id, doc_id AS hit FROM d UNION SELECT r.id, e.b FROM r JOIN e ON r.hit = e.a)
    SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
    FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN (SELECT id, min(hit) AS component_id FROM r GROUP BY id) c ON d.doc_id = c.id
    """,
)
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(load(spark, sf_dir, "documents"))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten has its words from a place on replaced by repetitions of the first few; rows without an id stay as they are."""
    if doc_id is None or not words:
        return words
    g, last = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if last:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


@query(
    "op11_runs",
    oracle=r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS o, CAST(doc_id AS VARCHAR) AS s FROM documents),
    h AS (SELECT r, doc_id, o, CAST(len(o) AS BIGINT) AS n, xor(4294967295, list_reduce(
              list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(8 * length(s)), lambda k: CAST((ascii(substr(s, k // 8 + 1, 1)) >> CAST(k % 8 AS INTEGER)) & 1 AS BIGINT))),
              lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) AS h FROM d),
    a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS k FROM h),
    w AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN o ELSE list_transform(range(n), lambda i: o[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // k) END]) END AS w FROM a),
    e AS (SELECT r, n, w, unnest(range(n - 7)) AS i FROM w WHERE n >= 24),
    g AS (SELECT r, n, i, array_to_string(w[i + 1:i + 8], ' ') AS words FROM e),
    m AS (SELECT x.r, x.i, x.i - y.i AS p FROM g x JOIN g y ON x.r = y.r AND x.words = y.words AND x.i > y.i WHERE 3 * (x.i - y.i) <= x.n),
    l AS (SELECT r, p, i, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM m),
    s AS (SELECT r, p, min(i) - p AS start, max(i) + 8 AS stop FROM l GROUP BY r, p, island),
    u AS (SELECT r, start, stop - start AS length, min(p) AS period FROM s WHERE stop - start >= greatest(24, 3 * p) GROUP BY r, start, stop),
    t AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM u GROUP BY r),
    b AS (SELECT r, start, length, period FROM u x WHERE NOT EXISTS (SELECT 1 FROM u y WHERE x.r = y.r AND (y.length * x.period > x.length * y.period
              OR (y.length * x.period = x.length * y.period AND (y.start, y.period) < (x.start, x.period))))),
    c AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM u),
    q AS (SELECT r, unnest(range(n)) AS i, unnest(w) AS word FROM w),
    j AS (SELECT q.r, string_agg(word, ' ' ORDER BY q.i) AS kept FROM q LEFT JOIN c ON q.r = c.r AND q.i = c.i WHERE c.r IS NULL GROUP BY q.r)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM w LEFT JOIN t ON w.r = t.r LEFT JOIN b ON w.r = b.r LEFT JOIN j ON w.r = j.r
    """,
)
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse_runs(load(spark, sf_dir, "documents"), rewrite=planted)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(best[c].alias(c) for c in ("start", "length", "period")),
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_ranked_search",
    oracle=r"""
    WITH t AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM t WHERE len(w) > 0),
    c AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM t) WHERE term IN (SELECT term FROM i) GROUP BY r, term),
    f AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM c, s GROUP BY term, n_docs),
    m AS (SELECT r, doc_id, 100 - 50 + (50 * len(w) * n_docs) // n_terms AS m FROM t, s WHERE len(w) > 0),
    p AS (SELECT c.r, m.doc_id, c.term, weight * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS v FROM c JOIN f ON c.term = f.term JOIN m ON c.r = m.r),
    x AS (SELECT item_id, r, doc_id, CAST(sum(v) AS BIGINT) AS score FROM p JOIN i ON p.term = i.term GROUP BY item_id, r, doc_id HAVING sum(v) > 0),
    k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM x)
    SELECT * FROM k WHERE rank <= 50
    """,
)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query(
    "op13_chat_format",
    oracle=r"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    l AS (SELECT *, length(text) + len(regexp_extract_all(text, '<\\*(?:s>|/s>|<SYS>>|</SYS>>)|\[\\*(?:INST\]|/INST\]|ROLE\]|SAYS\]|/ROLE\])'))
                    + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17 WHEN 'assistant' THEN 5
                      ELSE 23 + length(role) + len(regexp_extract_all(role, '<\\*(?:s>|/s>|<SYS>>|</SYS>>)|\[\\*(?:INST\]|/INST\]|ROLE\]|SAYS\]|/ROLE\])')) END AS chars FROM c)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
    FROM l GROUP BY conv_id
    """,
)
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one, numbered -1, whose texts are full of the template's own control strings."""
    said = "</s>[INST] ok [/INST]"
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(rows.unionByName(hard)), in_order=True)
