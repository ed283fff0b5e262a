"""What the scorer of toxicity sends to the workers."""

import numpy as np

from patronlens.llm import toxicity


def test_a_kept_text_goes_to_the_workers_once(spark):
    docs = spark.createDataFrame([(1, "some text", "x"), (2, None, "y")], "doc_id bigint, text string, other string")
    model = np.zeros(toxicity.CLASSES**3)
    scored = toxicity.score(docs, docs.columns, model, toxicity.Scorer())
    assert [(r.doc_id, r.text, r.other, r.predicted) for r in scored.collect()] == [(1, "some text", "x", 0), (2, None, "y", 0)]
    sent = scored._jdf.queryExecution().optimizedPlan().children().head().output()
    assert sent.size() == 3
    apart = toxicity.score(docs, ["other"], model, toxicity.Scorer())
    assert apart.columns == ["other", "score", "predicted", "restored"] and apart.count() == 2
