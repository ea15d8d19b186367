"""The stand-in answers over every document chunk at sf0.01 give the counts
recorded with the fixtures (19,810 tries)."""

from pyspark.sql import functions as F

from chunkwright.operators import responses as D
from chunkwright.operators.chunking import chunk_words
from chunkwright.plans import fixtures as FX
from chunkwright.session import configure
from chunkwright.sources.tables import documents_as_files
from tests.conftest import SF_MID


def test_fixture_status_counts(spark):
    configure(spark)
    files = documents_as_files(spark, SF_MID)
    chunks = chunk_words(files, 700, carry=("doc_id", "source"))
    parsed = D.parse_attempts(FX.summary_attempts(chunks, 5))
    got = {(r.status, r.incomplete): r["n"] for r in parsed.groupBy("status", "incomplete").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(got.values()) == 19810
    assert got[("valid", False)] == 7427
    assert sum(v for (s, _), v in got.items() if s == "bad_keys") == 2479
    assert sum(v for (s, _), v in got.items() if s == "bad_types") == 2469
    assert got[("empty", False)] == 2470
    assert got[("empty", True)] == 4965
