"""Pipelines C and D: text -> structured rows over documents, pages,
conversations and the events' JSON payload (BQ6, BQ7, T2-T11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import round_half_up
from quarry.operators.text import (
    classify,
    detect_language,
    label_words,
    extract_all,
    parse_pages,
    sentiment,
    sentiment_score,
    typed,
)
from quarry.plans.common import sql_r
from quarry.operators.layout import page_blocks
from quarry.plans.registry import query
from quarry.sources.tables import load

# Extraction patterns (e-mail, IPv4, 16-digit card number,
# quoted 40-hex secret token).
PATTERNS = {
    "emails": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", 0),
    "ipv4s": (r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", 0),
    "card_numbers": (r"[0-9]{16}", 0),
    "secret_tokens": (r'token = "([0-9a-f]{40})"', 1),
}

# The e-mail pattern for Java's backtracking matcher, in linear time: an address begins where a run of its
# characters does (or where the last match ended), the run is taken whole, and a domain is one run cut at
# its last dot that two letters follow.  The same matches as PATTERNS["emails"].
LINEAR_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"

# A small multilingual sentiment lexicon (word -> +1 / -1).
POSITIVE = (
    "good great excellent happy thanks thank love perfect nice helpful glad "
    "bien bon bonne merci super parfait gut danke toll prima bueno buena gracias excelente"
).split()
NEGATIVE = (
    "bad poor terrible awful angry problem error broken hate wrong sorry "
    "mal mauvais erreur schlecht fehler kaputt malo mala problema"
).split()
LEXICON = {**{w: 1 for w in POSITIVE}, **{w: -1 for w in NEGATIVE}}

# Stop words per language, in tie-break order.
STOPWORDS = {
    "en": "the and of to is in that it for with as on this are was be by".split(),
    "fr": "le la les des et un une du est que qui dans pour avec sur par au aux".split(),
    "de": "der die das und ist nicht zu den von mit sich ein eine auf für dem im".split(),
    "es": "el los las y que en un una es por con para del se lo como su".split(),
}


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


SQL_TOKENS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda w: w <> '')"


# ---------------------------------------------------------------------------
# Typed entity extraction from whole documents.
# ---------------------------------------------------------------------------
def _sql_entities() -> str:
    cols = []
    for name, (pat, grp) in PATTERNS.items():
        p = pat.replace("'", "''")
        cols.append(f"array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{p}', {grp}))), ',') AS {name}")
    p = PATTERNS["emails"][0]
    cols.append(f"CAST(len(regexp_extract_all(text, '{p}')) AS INTEGER) AS n_email_mentions")
    return f"SELECT doc_id, lang, {', '.join(cols)} FROM documents"


@query("doc_entities", _sql_entities())
def doc_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return entity_columns(docs)


def entity_columns(docs: DataFrame) -> DataFrame:
    """T2/T3 over whole texts; each pattern scans the text once (the e-mail
    matches are extracted once and give both the list and the count)."""
    docs = docs.withColumn("__em", F.regexp_extract_all("text", F.lit(LINEAR_EMAIL), 0))
    cols = {
        name: F.array_join(extract_all("text", pat, grp), ",")
        for name, (pat, grp) in PATTERNS.items()
        if name != "emails"
    }
    cols["emails"] = F.array_join(F.array_sort(F.array_distinct(F.col("__em"))), ",")
    cols["n_email_mentions"] = F.size(F.col("__em"))
    return docs.withColumns(cols).select("doc_id", "lang", *PATTERNS, "n_email_mentions")


# ---------------------------------------------------------------------------
# Language detection by stop-word hits over the whole text.
# ---------------------------------------------------------------------------
def _sql_language() -> str:
    hits = [
        f"CAST(len(list_filter({SQL_TOKENS}, lambda w: list_contains({_sql_list(ws)}, w))) AS INTEGER) AS {lang}_hits"
        for lang, ws in STOPWORDS.items()
    ]
    langs = list(STOPWORDS)
    # most hits first, then the earlier language
    order = " ".join(
        f"WHEN {lang}_hits > 0 AND " + " AND ".join(
            f"{lang}_hits {'>=' if j > i else '>'} {o}_hits" for j, o in enumerate(langs) if o != lang
        ) + f" THEN '{lang}'"
        for i, lang in enumerate(langs)
    )
    return (
        f"SELECT doc_id, lang, {', '.join(l + '_hits' for l in langs)}, CASE {order} ELSE '' END AS detected_lang "
        f"FROM (SELECT doc_id, lang, {', '.join(hits)} FROM documents)"
    )


@query("doc_language", _sql_language())
def doc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    # doc_id + lang as the row key: the result needs no join back to docs
    return detect_language(docs, "text", STOPWORDS, keys=["doc_id", "lang"])


# ---------------------------------------------------------------------------
# BQ7 (T5, T6, T9, T10): mean sentiment per conversation for one speaker.
# ---------------------------------------------------------------------------
SPEAKER = "user"

BQ7_SQL = f"""
WITH lex AS (
    SELECT * FROM (VALUES {', '.join(f"('{w}', {s})" for w, s in LEXICON.items())}) t(word, score)
), tok AS (
    SELECT conv_id, turn, unnest({SQL_TOKENS}) AS word FROM conversations WHERE role = '{SPEAKER}'
), seg AS (
    SELECT c.conv_id, c.turn,
           COALESCE(SUM(CASE WHEN lex.score > 0 THEN 1 ELSE 0 END), 0) AS pos,
           COALESCE(SUM(CASE WHEN lex.score < 0 THEN 1 ELSE 0 END), 0) AS neg
    FROM conversations c
    LEFT JOIN tok ON c.conv_id = tok.conv_id AND c.turn = tok.turn
    LEFT JOIN lex ON tok.word = lex.word
    WHERE c.role = '{SPEAKER}'
    GROUP BY c.conv_id, c.turn
), scored AS (
    SELECT conv_id, turn, CASE WHEN pos > 0 AND neg = 0 THEN 1 WHEN neg > 0 AND pos = 0 THEN -1 ELSE 0 END AS s,
           CASE WHEN pos > 0 AND neg = 0 THEN 1 ELSE 0 END AS is_pos,
           CASE WHEN neg > 0 AND pos = 0 THEN 1 ELSE 0 END AS is_neg
    FROM seg
)
SELECT conv_id, COUNT(*) AS turns,
       {sql_r('CAST(SUM(s) AS DOUBLE) / COUNT(*)', 4)} AS mean_sentiment,
       CAST(SUM(is_pos) AS BIGINT) AS positive_turns, CAST(SUM(is_neg) AS BIGINT) AS negative_turns
FROM scored GROUP BY conv_id
"""


@query("bq7_conversation_sentiment", BQ7_SQL)
def bq7_conversation_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = load(spark, sf_dir, "conversations").filter(F.col("role") == SPEAKER)
    seg = sentiment(conv, "text", LEXICON, out="mood", keys=["conv_id", "turn"]).withColumn(
        "sentiment", sentiment_score("mood")
    )
    return seg.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"),
        round_half_up(F.sum("sentiment").cast("double") / F.count(F.lit(1)), 4).alias("mean_sentiment"),
        F.sum((F.col("sentiment") == 1).cast("long")).alias("positive_turns"),
        F.sum((F.col("sentiment") == -1).cast("long")).alias("negative_turns"),
    )


# ---------------------------------------------------------------------------
# Web page -> title, headings, links, visible text (hash + size).
# ---------------------------------------------------------------------------
def _sql_decode(x: str) -> str:
    for k, v in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")]:
        x = f"replace({x}, '{k}', '{v}')"
    return x


def _sql_pages() -> str:
    b = "html"
    for tag in ("script", "style", "nav"):
        b = f"regexp_replace({b}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', ' ', 'g')"
    b = f"regexp_replace({b}, '(?s)<!--.*?-->', ' ', 'g')"
    b = f"regexp_replace({b}, '(?is)<title[^>]*>.*?</title>', ' ', 'g')"
    b = (
        f"regexp_replace({b}, '(?i)</?(p|div|br|h[1-6]|li|ul|ol|tr|article|section|header|footer)\\b[^>]*>', "
        "chr(10), 'g')"
    )
    b = f"regexp_replace({b}, '<[^>]*>', ' ', 'g')"
    b = _sql_decode(b)
    b = f"regexp_replace({b}, '[ \\t\\r\\f]+', ' ', 'g')"
    b = f"trim(regexp_replace({b}, ' ?\\n[ \\n]*', chr(10), 'g'))"
    title = _sql_decode("trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1))")
    return (
        f"SELECT page_id, url, {title} AS title, "
        "CAST(len(regexp_extract_all(html, '(?i)<h[1-6][\\s>]')) AS INTEGER) AS n_headings, "
        "CAST(len(regexp_extract_all(html, '(?i)<a\\s[^>]*href')) AS INTEGER) AS n_links, "
        "CAST(length(t) AS INTEGER) AS text_chars, md5(t) AS text_md5 "
        f"FROM (SELECT *, {b} AS t FROM pages)"
    )


@query("page_structure", _sql_pages())
def page_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = parse_pages(load(spark, sf_dir, "pages"))
    return pages.select(
        "page_id",
        "url",
        "title",
        "n_headings",
        "n_links",
        F.length("text").alias("text_chars"),
        F.md5("text").alias("text_md5"),
    )


# ---------------------------------------------------------------------------
# BQ6 (T11, T12, X12): typed finishing of a semi-structured payload, then a
# monthly roll-up: events.props is JSON text; `k` is read by path and cast
# leniently (bad values -> NULL), grouped by the year and month aliases.
# ---------------------------------------------------------------------------
BQ6_SQL = f"""
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, COUNT(*) AS events,
       CAST(SUM(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total,
       {sql_r("CAST(SUM(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS DOUBLE) / COUNT(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT))", 4)} AS k_mean
FROM events GROUP BY year(ts), month(ts)
"""


@query("bq6_monthly_rollup", BQ6_SQL)
def bq6_monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").select("ts", F.get_json_object("props", "$.k").alias("k_text"))
    ev = typed(ev, {"k": ("k_text", "bigint")})
    return ev.groupBy(F.year("ts").alias("year"), F.month("ts").alias("month")).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("k").alias("k_total"),
        round_half_up(F.sum("k").cast("double") / F.count("k"), 4).alias("k_mean"),
    )


# ---------------------------------------------------------------------------
# T4: classify documents into a fixed label list (their license), best
# label first.  A label needs more than half of its words in the text
# ("mit" alone is German for "with", "by" alone is everyday English), else
# the license is NULL.
# ---------------------------------------------------------------------------
# The license labels and the evidence threshold.
LICENSES = ["Apache License", "MIT License", "GNU General Public License", "CC BY-NC"]
MIN_SHARE = 0.5


def _sql_classify() -> str:
    n = len(LICENSES)
    shares = [
        f"CAST(len(list_filter({_sql_list(label_words(lab))}, lambda w: list_contains(tok, w))) AS DOUBLE) / {len(label_words(lab))} AS s{i}"
        for i, lab in enumerate(LICENSES)
    ]
    best = " ".join(
        f"WHEN " + " AND ".join(f"s{i} {'>=' if j > i else '>'} s{j}" for j in range(n) if j != i) + f" THEN {i}"
        for i in range(n)
    )
    labels = "[" + ", ".join(f"'{lab}'" for lab in LICENSES) + "]"
    return (
        f"SELECT doc_id, CASE WHEN best_s > {MIN_SHARE} THEN {labels}[best + 1] END AS license, "
        f"CAST(ROUND(CAST(best_s AS DECIMAL(38,12)), 6) AS DOUBLE) AS license_score FROM ("
        f"SELECT doc_id, b AS best, [{', '.join(f's{i}' for i in range(n))}][b + 1] AS best_s FROM ("
        f"SELECT *, CASE {best} END AS b FROM ("
        f"SELECT doc_id, {', '.join(shares)} FROM (SELECT doc_id, {SQL_TOKENS} AS tok FROM documents))))"
    )


@query("doc_license_class", _sql_classify())
def doc_license_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    c = classify(docs, "text", LICENSES, out="labels")
    return c.select(
        "doc_id",
        F.when(F.col("labels_score") > MIN_SHARE, F.col("labels")[0]).alias("license"),
        round_half_up("labels_score", 6).alias("license_score"),
    )


# ---------------------------------------------------------------------------
# The blocks of all pages.  The oracle knows these pages' shape (one level of
# list, no tables): texts between block tags, named by the tag before them.
# ---------------------------------------------------------------------------
_DECODED = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")]  # with &amp; the entities of these pages


def _sql_entities_of(x: str) -> str:
    for k, v in _DECODED:
        x = f"replace({x}, '{k}', '{v}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


_PARTS = "/?(title|nav|ul|li|div|article|h1|p|footer|header|head|body|html|script|style)"
LAYOUT_SQL = rf"""
WITH bare AS (
    SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)\b[^>]*>.*?(</(script|style)|$)', '</script', 'g'),
           '(?s)<!--.*?(-->|$)', '', 'g'), '(?s)<[^>]*$', '') AS h FROM pages WHERE html IS NOT NULL
), marked AS (
    SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(h, '(?i)<br\b[^>]*>', chr(3), 'g'),
           '(?i)<({_PARTS})\b[^>]*>', chr(1) || '\1' || chr(2), 'g'), '<[^>]*>', '', 'g'), '[ \t\r\n\f]+', ' ', 'g') AS m FROM bare
), pieces AS (
    SELECT page_id, unnest(string_split(m, chr(1))) AS x, generate_subscripts(string_split(m, chr(1)), 1) AS i FROM marked
), named AS (
    SELECT page_id, i, lower(split_part(x, chr(2), 1)) AS tag, split_part(x, chr(2), 2) AS t FROM pieces WHERE contains(x, chr(2))
), placed AS (
    SELECT *, SUM(CASE tag WHEN 'nav' THEN 1 WHEN '/nav' THEN -1 ELSE 0 END) OVER w AS navs,
           SUM(CASE tag WHEN 'footer' THEN 1 WHEN '/footer' THEN -1 ELSE 0 END) OVER w AS footers
    FROM named WINDOW w AS (PARTITION BY page_id ORDER BY i)
), clean AS (
    SELECT page_id, i, tag, navs, footers, {_sql_entities_of("trim(regexp_replace(regexp_replace(t, ' *\x03[ \x03]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g'))")} AS text FROM placed
)
SELECT page_id, CAST(ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS block,
       CASE tag WHEN 'title' THEN 'title' WHEN 'h1' THEN 'heading' WHEN 'li' THEN 'item' ELSE 'paragraph' END AS kind,
       CAST(CASE WHEN tag IN ('h1', 'li') THEN 1 ELSE 0 END AS INTEGER) AS depth,
       CASE WHEN navs > 0 THEN 'nav' WHEN footers > 0 THEN 'footer' ELSE 'body' END AS region, text
FROM clean WHERE text <> ''
"""


@query("page_layout", LAYOUT_SQL)
def page_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_blocks(load(spark, sf_dir, "pages"), "page_id").drop("cells")
