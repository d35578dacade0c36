"""The pipeline's stages, each against what its operator says of its own input."""

import corpus_pipeline
from quarry.llm import jaccard, pii, toxicity
from quarry.llm.common import written
from quarry.sources.tables import load
from tests.llm.test_dedup import plain_components
from tests.llm.test_packing_mixing import check_cover, encoder
from tests.llm.util import awkward, docs

SF = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near copies", "pii", "mixing", "packing"]
    d = load(spark, SF, "documents")
    columns = d.columns

    clean = written(stages["toxicity"](spark, d, SF), "test")
    scores = {r["doc_id"]: r["score"] for r in toxicity.classify(d, load(spark, SF, "labels")).collect()}
    assert clean.columns == columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, s in scores.items() if s < 0.5}

    single = written(stages["near copies"](spark, clean, SF), "test")
    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert single.columns == columns
    assert {str(r["doc_id"]) for r in single.collect()} == {i for i, _, c in plain_components(rows) if str(c) == i}

    masked = written(stages["pii"](spark, single, SF), "test")
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    assert masked.columns == columns
    assert {r["doc_id"]: r["text"] for r in masked.collect()} == {i: pii.redact_text(t) for i, t in before.items()}
    assert not any(pii.detect(r["text"]) for r in masked.collect())

    mixed = written(stages["mixing"](spark, masked, SF), "test")
    assert mixed.columns == columns
    kept = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert 0.2 < len(kept) / masked.count() < 0.6

    packed = stages["packing"](spark, mixed, SF).collect()
    check_cover(packed, [(i, [*encoder().encode(t, allowed_special={"<|endoftext|>"}), 1]) for i, t in kept.items()], 2048)
    total = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, total.collect())) == sorted(map(tuple, packed))


def test_stages_take_awkward_rows(spark):
    d = docs(spark, awkward())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, d, SF), "test")
        assert out.columns == d.columns
    assert jaccard.keep_one(d.limit(0)).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, d, SF).count() >= d.count()
