"""The pipeline, stage by stage, against brute-force versions."""

import corpus_pipeline
from conftest import SF
from test_operators import brute_components
from tidemark.sources.tables import read_table


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "ngram_jaccard", "decontamination", "mixing", "token_ids"]
    stage = dict(corpus_pipeline.STAGES)

    good = stage["quality_rules"](spark, docs, SF).cache()
    assert good.columns == docs.columns
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in good.collect()}
    clean = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in clean) / len(clean) > 0.9

    single = stage["ngram_jaccard"](spark, good, SF).cache()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in single.collect()} == {c for _, _, c in brute_components(rows)}

    free = stage["decontamination"](spark, single, SF).cache()
    passages = [" ".join(r.text.lower().split()) for r in read_table(spark, SF, "benchmark").collect()]
    holds = {r.doc_id: any(p in " ".join(r.text.lower().split()) for p in passages) for r in single.collect()}
    left = {r.doc_id for r in free.collect()}
    assert all(not holds[d] for d in left)
    assert len([d for d in holds if d not in left and not holds[d]]) <= 0.05 * len(holds)

    mixed = stage["mixing"](spark, free, SF).cache()
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= left

    ids = stage["token_ids"](spark, mixed, SF).orderBy("start").collect()
    assert [r.doc_id for r in ids] == sorted(r.doc_id for r in mixed.collect())


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_text_passes_release_memory(monkeypatch):
    """Before the first block and after the last: workers are used again or idle."""
    import pyarrow as pa

    from tidemark.llm import textblocks as TB

    calls = []
    monkeypatch.setattr(TB, "release", lambda: calls.append(len(seen)))
    seen = []
    for part in TB.blocks([pa.RecordBatch.from_pydict({"text": ["a", None, "bc"]})]):
        seen.append(part.num_rows)
    assert seen == [3] and calls == [0, 1]
