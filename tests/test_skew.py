"""A file holding most of the chunks (a hot key) merges exactly like a plain
loop over its records, however the rows are partitioned."""

import json
import random

from chunkwright import params as P
from chunkwright.operators import merge as E
from tests.plain_rules import merge_records

WORDS = ["alpha", "beta", "gamma", " delta ", "N/A", "none", "", "eps, zeta", "eta,", "alpha, beta"]


def _record(rnd):
    r = {}
    for s in rnd.sample(P.TEXT_SECTIONS, rnd.randint(0, 3)):
        r[s] = rnd.choice(WORDS) if rnd.random() < 0.9 else {"x": "y"}
    for s in rnd.sample(P.MAP_SECTIONS, rnd.randint(0, 2)):
        if rnd.random() < 0.1:
            r[s] = "not an object"
            continue
        r[s] = {f"K{rnd.randint(0, 20)}": (rnd.choice(WORDS) if rnd.random() < 0.9 else {"d": rnd.randint(0, 3)})
                for _ in range(rnd.randint(0, 4))}
    if rnd.random() < 0.2:
        r["Variables"] = {"v": "1"}
    return r


def test_hot_file_merge_equals_loop(spark):
    rnd = random.Random(11)
    files = {"hot.py": 400, **{f"f{i}.py": rnd.randint(2, 6) for i in range(30)}}
    recs = {f: [_record(rnd) for _ in range(n)] for f, n in files.items()}
    rows = [(f, i, len(rs), json.dumps(r)) for f, rs in recs.items() for i, r in enumerate(rs)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "rel_path string, chunk_no long, n_chunks long, json_text string").repartition(13)
    entries = E.record_entries(df)
    got_text = {(r.rel_path, r.section): r.value for r in E.merge_text(entries).collect()}
    got_maps = {}
    for r in E.merge_maps(entries).collect():
        got_maps.setdefault((r.rel_path, r.section), []).append((r.item_no, r.item, r.value))
    for f, rs in recs.items():
        text, maps = merge_records(rs)
        for s, v in text.items():
            assert got_text.get((f, s), "") == v, (f, s)
        for s, m in maps.items():
            assert [(k, v) for _, k, v in sorted(got_maps.get((f, s), []))] == list(m.items()), (f, s)
