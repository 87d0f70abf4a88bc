"""The pipeline's near-dedup stage at similarity 0.8."""

import corpus_pipeline
from folia.llm import neardup
from tests.llm.test_contracts import near_reference


def copies():
    """Pairs of texts at similarities from 0.78 to 0.9, ids 2k and 2k + 1, by the reference's measure."""
    rows = []
    for k in range(30):
        words = [f"d{k}w{i}" for i in range(120 + k)]
        other = list(words)
        for j in range(2 + k % 2):
            other[30 + 37 * j] = f"x{k}_{j}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    return rows


def test_stage_drops_copies_at_080(spark):
    rows = copies()
    plain = [{"doc_id": i, "text": t} for i, t in rows]
    at_80, at_85 = ({d for d, v in near_reference(plain, p).items() if v[2]} for p in (80, 85))
    assert len(at_85 - at_80) > 3 and at_80 < at_85
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, "").collect()} == at_80
    assert {r.doc_id for r in neardup.drop_near_duplicates(docs).collect()} == at_85


def test_bands_fit_the_similarity():
    for percent in (80, 85):
        assert (1 - (percent / 100) ** neardup.ROWS) ** neardup._bands(percent) <= neardup.MISS
    assert neardup._bands(85) == 36
