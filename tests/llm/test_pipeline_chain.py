"""run() against a plain chain of its five stages: the operators' DuckDB twins
one after the other, each over what the one before kept, then the tokenizers
library."""

import hashlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from chunkwright.llm import bpe, exact, mixing, near, quality
from tests.conftest import SF_MID, SF_SMALL


def plain_chain(sf_dir):
    """(counts kept by stage, sorted result rows)."""
    from tokenizers import Tokenizer

    con = duckdb.connect()
    con.sql(f"create table stage0 as select * from read_parquet('{sf_dir}/documents.parquet')")
    kept = []
    steps = [
        (quality.ORACLE, "select d.* from {t} d join o using (doc_id) where o.kept"),
        (exact.ORACLE, "select d.* from {t} d join o using (doc_id) where o.kept"),
        (near.ORACLE, "select d.* from {t} d join o using (doc_id) where o.component_id = o.doc_id"),
        (mixing.ORACLE, "select d.* from {t} d join o using (doc_id), range(o.copies)"),
    ]
    for i, (sql, take) in enumerate(steps):
        con.sql(f"create or replace view documents as select * from stage{i}")
        con.sql(f"create or replace table o as {sql}")
        con.sql(f"create table stage{i + 1} as {take.format(t=f'stage{i}')}")
        kept.append(con.sql(f"select count(*) from stage{i + 1}").fetchall()[0][0])
    library = Tokenizer.from_file(bpe.vocabulary_path())
    library.no_truncation()
    library.no_padding()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    rows = []
    for doc_id, text in con.sql(f"select doc_id, text from stage{len(steps)}").fetchall():
        ids = library.encode(text or "", add_special_tokens=False).ids
        rows.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    return kept, sorted(rows)


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_MID])
def test_run_equals_the_plain_chain(spark, sf_dir):
    kept, want = plain_chain(sf_dir)
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == want
    assert kept[0] > kept[1] >= kept[2] > 0 and len(set(r[0] for r in want)) < len(want)  # each stage has work, some documents twice
