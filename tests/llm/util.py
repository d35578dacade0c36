"""Small tables with every awkward row, and brute-force helpers."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, start string, spans int, b int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    """Documents from (doc_id, text); the other columns clash with names the operators use, or are null."""
    return spark.createDataFrame([(i, t, None if n % 3 else "en", None if n % 2 else "src0", None, "x", n, n) for n, (i, t) in enumerate(rows)], DOCS)


def awkward():
    """Null and empty texts, blanks only, repeated rows, a null id, non-ASCII, one very long text."""
    r = random.Random(5)
    long = " ".join(r.choice(["alpha", "beta", "ça", "12", "x@y", "naïve"]) + str(i % 97) for i in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n "), (4, "one two three"), (4, "one two three"), (None, "no id here at all"), (None, None), (5, "é" * 50 + " 𝔘nicode 漢字 \x00 end"), (6, long), (-7, "a"), (8, "a" * 100_000)]


def table(spark, sf, name):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")


def words(text):
    return WORD.findall(text or "")
