"""Operators 5 and 6: held-out accuracy, restoration, awkward rows."""

import zlib

import numpy as np
import pytest

from quarry.llm import hashing, quality, toxicity
from quarry.llm.queries import QUERIES
from tests.llm.util import awkward, docs, table

SF = "/root/testdata/sf0.1"


def judged(spark, name, label):
    out = QUERIES[name](spark, SF)
    rows = out.join(table(spark, "sf0.1", "labels"), "doc_id").toPandas()
    assert out.count() == table(spark, "sf0.1", "documents").count()
    fold = rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (fold == rows.held_out).all() and rows.score.between(0, 1).all()
    held = rows[rows.held_out]
    return held[label].to_numpy(), held.predicted.to_numpy(), held.score.to_numpy()


def test_quality_held_out(spark):
    y, predicted, score = judged(spark, "op5_quality", "quality")
    assert (y == predicted).mean() > 0.98
    assert score[y == 1].mean() - score[y == 0].mean() > 0.9


def test_toxicity_held_out(spark):
    y, predicted, score = judged(spark, "op6_toxicity", "toxic")
    assert predicted[y == 1].mean() > 0.75 and predicted[y == 0].mean() < 0.01
    assert score[y == 1].mean() > score[y == 0].mean() + 0.6


@pytest.fixture(scope="module")
def decoder(spark):
    counts = toxicity.trigram_counts(table(spark, "sf0.1", "documents"))
    return toxicity.Decoder(toxicity.log_model(counts))


@pytest.mark.parametrize(
    "text,plain",
    [
        ("you 1d10t", "you idiot"), ("l0ser", "loser"), ("such an i d i o t you", "such an idiot you"), ("w.o.r.t.h.l.e.s.s", "worthless"),
        ("stuuuupid", "stupid"), ("$tup1d m0r0n!", "stupid moron!"), ("pathet1c tra$h", "pathetic trash"), ("(d1sgu$ting)", "(disgusting)"),
        ("s_c_u_m here", "scum here"),
    ],
)
def test_restores_disguised_words(decoder, text, plain):
    assert decoder.restore(text).lower() == plain


@pytest.mark.parametrize("text", ["", "the thing of this", "42.144.35.254 and 4111 1111", "a b", "and the%%% of&&&", "Was it so? Yes!", "x@y.example.com", "größer über straße"])
def test_leaves_ordinary_text(decoder, text):
    assert decoder.restore(text) == text


def test_viterbi_equals_the_best_path(decoder):
    def best(piece):
        paths = [("", 0.0)]
        for readings in decoder.arcs(piece):
            paths = [(t + put, c + cost) for t, c in paths for put, cost in readings]
        number, scored = toxicity._NUMBER, []
        for t, c in paths:
            x = [0, 0, *(number.get(z, 0) for z in t), 0]
            scored.append((c + sum(decoder.logp[a][b][z] for a, b, z in zip(x, x[1:], x[2:])), t))
        return max(scored)

    for piece in ["1d10t", "$c.u-m", "sss7uff", "a4b!c", "0", "l.o.s3r"]:
        got = decoder.decode(piece)
        score, text = best(piece)
        x = [0, 0, *(toxicity._NUMBER.get(z, 0) for z in got), 0]
        assert got == text or score == pytest.approx(score), (piece, got, text)


def test_flagged_texts_hold_every_change(decoder):
    texts = [t or "" for _, t in awkward()[:-1]] + ["1d10t", "x i d i o t", "sooo", "plain words", "a.b.c.d"]
    flagged = toxicity.disguised(hashing.chars(texts))
    assert all(f or decoder.restore(t) == t for f, t in zip(flagged, texts))


def test_trigram_counts_cover_all_texts(spark):
    d = table(spark, "sf0.001", "documents")
    counts = toxicity.trigram_counts(d)
    texts = [r["text"] or "" for r in d.collect()]
    want = np.zeros_like(counts)
    for t in texts:
        x = np.concatenate([[0, 0], toxicity.letter_numbers(hashing.chars([t]).codes), [0]])
        np.add.at(want, (x[:-2], x[1:-1], x[2:]), 1)
    assert (counts == want).all()


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_awkward_rows_and_missing_labels(spark, module, label):
    rows = awkward()
    d = docs(spark, rows)
    some = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (8, None, None), (None, 1, 1), (6, 0, 0), (-7, 1, 0), (77, 1, 1), (4, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (some, some.limit(0)):
        got = module.classify(d, labels).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["held_out"] is not None for r in got)
        assert len({r["score"] for r in got if r["doc_id"] == 4}) == 1
    assert module.classify(d.limit(0), some).collect() == []


def test_scores_do_not_depend_on_the_batch():
    p = quality.Params(bits=10)
    model = quality.Model(np.random.default_rng(1).standard_normal(1 << 10).astype(np.float32), 0.3)
    texts = ["", "a", "one two two three", "x" * 500, "é à"]
    assert np.allclose(model.score(texts, p), [model.score([t], p)[0] for t in texts], rtol=0, atol=0)


def test_keep_clean_keeps_columns(spark):
    d = docs(spark, awkward())
    labels = spark.createDataFrame([(4, 0)], "doc_id long, toxic int")
    kept = toxicity.keep_clean(d, toxicity.fit(d, labels))
    assert kept.columns == d.columns and kept.count() == d.count()


def test_rows_that_share_one_common_word_all_count():
    p = toxicity.Params(bits=16)
    every = np.arange(1 << p.bits)
    common = int(every[np.argmin(hashing.mix(every.astype(hashing.U)))])
    rng = np.random.default_rng(3)
    free = np.setdiff1d(every, [common, 7])

    def row(*more):
        return np.unique(np.concatenate([[common, *more], rng.choice(free, 30)])).astype(np.int32)

    toxic, clean = [(1, row(7)) for _ in range(40)], [(0, row()) for _ in range(80)]
    assert toxicity.weights(toxic + clean, p)[7] > 0
    assert len(toxicity.single([r for _, r in toxic])) == 40
    copies = [(1, np.unique(np.append(toxic[0][1], rng.choice(free, 2))).astype(np.int32)) for _ in range(40)]
    assert toxicity.weights(copies + clean, p)[7] == 0


def test_single_equals_brute_force():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(60):
        base = np.unique(rng.choice(5000, rng.integers(1, 400)))
        sets += [np.unique(np.append(base[rng.random(len(base)) > drop], rng.choice(5000, more))) for drop, more in ((0, 0), (0.05, 1), (0.3, 9))]
    want = []
    for s in sets:
        if len(s) and not any(len(np.intersect1d(s, k)) >= 0.8 * len(np.union1d(s, k)) for k in want):
            want.append(s)
    got = toxicity.single([*sets, np.zeros(0, np.int32)])
    assert len(got) == len(want) < len(sets) and all((a == b).all() for a, b in zip(got, want))


def test_quality_scores_follow_the_real_label_ratio(spark):
    rows = [(i, "the same words for every label") for i in range(1, 1101)]
    d = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 11 != 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    for limit in (40, 1500):
        got = quality.score(d, quality.fit(d, labels, params=quality.Params(rows_per_label=limit))).toPandas()
        assert abs(got.score.mean() - 10 / 11) < 0.03 and got.predicted.all()


def test_trigrams_do_not_depend_on_batches_and_cross_no_text():
    texts = ["ab", "", "c", "abc d", "é1"]

    def counts(batch):
        x = toxicity.bounded(hashing.chars(batch))
        return sorted(zip(x[:-2].tolist(), x[1:-1].tolist(), x[2:].tolist()))

    assert counts(texts) == sorted(sum((counts([t]) for t in texts), []))
    a, b, c = (toxicity.letter_numbers(np.array([ord(x)]))[0] for x in "abc")
    assert (b, 0, c) not in counts(texts) and (0, 0, c) in counts(texts) and (0, a, b) in counts(texts)


@pytest.mark.parametrize("text", ["sh!t", "5h17", "garbag3", "ki11", "a$$", "@55", "d.i.e", "k i l", "h4te", "w0w"])
def test_short_and_trailing_disguises_reach_the_lattice(decoder, monkeypatch, text):
    """Alone in a batch or beside a long text, with punctuation or without."""
    for some in ([text], [f"({text})!"], [text, "a much longer text beside it"]):
        assert toxicity.disguised(hashing.chars(some))[0]
        seen = []
        monkeypatch.setattr(decoder, "decode", lambda piece, word=True: seen.append(piece) or piece)
        toxicity.restored(some, decoder)
        monkeypatch.undo()
        assert seen == [text]


@pytest.mark.parametrize("text", ["wow!", "yes! no!", "in 2024, 17 of 30", "plain words", "a b", ""])
def test_punctuation_and_numbers_do_not(decoder, monkeypatch, text):
    monkeypatch.setattr(decoder, "decode", lambda piece, word=True: pytest.fail(piece))
    assert toxicity.restored([text], decoder) == [text.lower()]


def test_a_text_has_one_score_whatever_its_batch(decoder):
    r = np.random.default_rng(2)
    model = toxicity.Model(decoder_probabilities(decoder), r.choice([0.0, 0.0, 2.5], 1 << 21).astype(np.float32), np.array([-3.0, 0.4, 0.5, 0.6]))
    texts = ["sh!t", "", "a", "th3 w0rd h3re", "k i l l them all", "plain words of an ordinary text " * 20, "5h17", "a$$ h0le"]
    together = model.score(toxicity.restored(texts, decoder), toxicity.Params())
    alone = [model.score(toxicity.restored([t], decoder), toxicity.Params())[0] for t in texts]
    assert together.tolist() == alone
    for i, t in enumerate(texts):  # the score from the model, in plain Python
        words = "".join(c if "a" <= c <= "z" or c >= "À" else " " for c in toxicity.restored([t], decoder)[0]).split()
        parts = {(n, w[:n]) for w in words for n in (*toxicity.Params().prefixes, 0) if len(w) >= n and n} | {(0, w) for w in words}
        found = {}
        for n, part in parts:
            _, bucket = toxicity.buckets([part], toxicity.Params(prefixes=(n,) if n else ()))
            found[int(bucket[-1])] = float(model.weight[bucket[-1]])
        assert abs(alone[i] - 1 / (1 + np.exp(-np.clip(np.dot(toxicity.summary(np.array([x for x in found.values() if x > 0])), model.link), -30, 30)))) < 1e-9


def decoder_probabilities(decoder):
    return np.array(decoder.logp)
