"""Batches sent to Python are bounded in bytes, whatever the rows' number and size."""

import json

import pandas as pd
from pyspark.sql import functions as F

from chunkwright.functions.jsonfmt import json_indent2
from chunkwright.session import configure


def test_batches_of_many_and_of_large_rows_are_small(spark):
    configure(spark)

    @F.pandas_udf("long")
    def batch_bytes(texts: pd.Series) -> pd.Series:
        return pd.Series([int(texts.str.len().sum())] * len(texts))

    for rows, size in ((9000, 2000), (400, 50_000)):
        df = spark.range(0, rows, 1, 1).select(F.repeat(F.lit("x"), size).alias("body"))
        seen = df.select(batch_bytes("body").alias("n")).agg(F.max("n"), F.count("n")).first()
        assert seen[0] <= (4 << 20) + size and seen[1] == rows


def test_a_row_larger_than_a_batch_is_formatted_whole(spark):
    text = '{"a": "' + "ü" * (5 << 20) + '", "b": [1]}'
    df = spark.createDataFrame([(1, text), (2, '{"c": 1}'), (3, None)], "id long, body string").coalesce(1)
    got = {r.id: r.out for r in df.select("id", json_indent2("body").alias("out")).collect()}
    assert got == {1: json.dumps(json.loads(text), indent=2), 2: '{\n  "c": 1\n}', 3: None}
