"""Training of the hidden Markov model reads all of the training rows, and the
words it models do not depend on the size of the table."""

import math
import zlib

from pyspark.sql import functions as F

from chunkwright.llm import hmm


def test_every_round_reads_every_document(spark, monkeypatch):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.expr("concat('a b w', id % 50)").alias("text"))
    train = docs.where(hmm.split_bucket() != 0)
    assert train.count() > 4000  # from here on rounds used to read a part
    seen, real = [], hmm._collected

    def collected(words, states):
        total, shared = real(words, states)
        if shared is not None:
            seen.append(shared[:states].sum())
        return total, shared

    monkeypatch.setattr(hmm, "_collected", collected)
    assert hmm.score_digest(docs).count() == 6000
    assert len(seen) == hmm.ROUNDS and all(math.isclose(n, 4 * train.count(), rel_tol=1e-6) for n in seen)


def test_rare_words_have_emissions_in_a_large_table(spark):
    """Two words of equal count, each seen in texts of one kind only, score
    differently, also where they are less than 1/131072 of all tokens."""
    ids = [i for i in range(10**6, 10**6 + 4000) if zlib.crc32(str(i).encode()) % 10][:3004]
    held = [i for i in range(10**7, 10**7 + 100) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    kinds = ["a b c d " * 40, "w x y z " * 40]
    rows = [(i, kinds[k % 2]) for k, i in enumerate(ids)]
    for k in range(4):  # each rare word in two texts of its kind
        rows[k] = (ids[k], kinds[k % 2] + ("rarea " if k % 2 == 0 else "rarew ") + kinds[k % 2])
    rows += [(held[0], kinds[0] + "rarea " + kinds[0]), (held[1], kinds[0] + "rarew " + kinds[0])]
    got = {r.doc_id: r for r in hmm.score_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.held_out}
    fits, odd = got[held[0]], got[held[1]]
    assert fits.train_tokens > 3 * 131072 and math.isclose(fits.base_score, odd.base_score)
    assert fits.score > odd.score + 0.1


def test_blocks_do_not_change_scores(spark):
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 60}" for j in range(30))) for i in range(200)] + [(None, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = (sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in hmm.score_digest(docs, n).collect()) for n in (1000, 5))
    assert len(one) == len(many) == 202
    for a, b in zip(one, many):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9) and math.isclose(a[4], b[4], rel_tol=1e-4)
