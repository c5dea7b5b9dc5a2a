"""Hard rows, clashing columns and an empty table through all stages."""

import hard
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline


@pytest.mark.parametrize("kind", ["hard", "empty"])
def test_all_stages(kind, spark, sf_dir):
    more = [(100 + i, " ".join(f"w{i}x{j}" for j in range(40)) + " mail a@b.de", "en", "s" if i % 2 else None) for i in range(4)] + [(None, " ".join(f"n{j}" for j in range(30)), None, None)] * 3
    docs = hard.clashing(hard.documents(spark, hard.ROWS + more if kind == "hard" else []))
    names = docs.columns
    for _, stage in pipeline.STAGES[:-1]:
        docs = pipeline.staged(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == names
    kept = docs.count()
    packed = pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.where("start = 0").count() == kept and (kept > 0) == (kind == "hard")
    if kind == "hard":
        assert docs.where(F.col("text").contains("a@b.de")).count() == 0 and docs.where("doc_id is null").count() > 0 and docs.where("n <> 'x'").count() == 0
