"""Training sees long words to their end, as prediction does."""

from chunkwright.llm import langid


def test_training_words_are_all_pieces_of_long_words(spark):
    word = "ab" * 16 + "é" * 16 + "日本" * 8 + "end"  # 32, 32, 48 and 3 bytes
    docs = spark.createDataFrame([(i, f"{word} short", "en") for i in range(8)], "doc_id long, text string, lang string")
    raw = word.encode()
    want = {raw[i : i + 32] for i in range(0, len(raw), 32)} | {b"short"}
    kept = docs.where(~langid.held_out()).count()
    rows = langid.training_words(docs)
    assert {w for w, _, _ in rows} == want and all(lang == "en" and n == kept for _, lang, n in rows)


def test_the_sample_does_not_hang_on_ids(spark, monkeypatch):
    """Null, equal and few ids give a sample of the stated size, not none or all."""
    from pyspark.sql import functions as F

    from chunkwright.llm import langid
    from chunkwright.llm.common import stage

    monkeypatch.setattr(langid, "PER_LANG", 50)
    # every document has one word of its own, so the words drawn are the documents drawn
    words = stage(spark.range(4000).select(F.concat(F.lit("w"), F.col("id")).alias("text"), F.when(F.col("id") % 2 == 0, "aa").otherwise("bb").alias("lang")), "words")
    for ids in (F.lit(None), F.lit(23), F.lit(28), F.substring("text", 2, 1).cast("long")):
        docs = words.withColumn("doc_id", ids.cast("long"))
        usable = docs.where(~langid.held_out("doc_id")).count()
        drawn = {lang: 0 for lang in ("aa", "bb")}
        for _, lang, n in langid.training_words(docs):
            drawn[lang] += n
        assert usable > 2000 and all(25 <= n <= 80 for n in drawn.values()), (drawn, usable)
