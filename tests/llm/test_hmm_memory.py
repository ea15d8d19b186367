"""What a task of the hidden Markov model holds, and the settings it uses, stay bounded."""

import pytest
from pyspark.sql import functions as F

from chunkwright.llm import hmm


def test_groups_of_texts_stay_small(spark):
    """20 MB of text in one task: a group (a row that one Python worker and
    the JVM hold whole) has at most GROUP_BYTES, no word is lost."""
    docs = spark.range(0, 10, 1, 1).select(F.col("id").alias("doc_id"), F.lit(False).alias("held_out"), F.expr("repeat(concat('w', id, ' '), 700000)").alias("text"))
    sizes = [len(r.symbols) // 4 for r in hmm.encoded(docs, 2).select("symbols").collect()]
    assert sum(sizes) == 10 * 700001
    assert max(sizes) * 3 <= 9 << 20


@pytest.mark.parametrize("fails", [False, True])
def test_scores_leave_the_session_as_it_was(spark, monkeypatch, fails):
    before, seen = {k: spark.conf.get(k) for k in hmm.CONF}, []

    def model(*_):
        seen.append({k: spark.conf.get(k) for k in hmm.CONF})
        raise ValueError("stopped")

    if fails:
        monkeypatch.setattr(hmm, "fresh_model", model)
        with pytest.raises(ValueError, match="stopped"):
            hmm.score_digest(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
        assert seen == [hmm.CONF]
    else:
        assert hmm.score_digest(spark.createDataFrame([(1, "a b")], "doc_id long, text string")).count() == 1
    assert {k: spark.conf.get(k) for k in hmm.CONF} == before
