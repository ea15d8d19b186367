"""The written page: bodies read once, structure from paths alone."""

import os
import random
import re
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from chunkwright.operators.hierarchy import document_fragments, page_structure
from chunkwright.plans.document import save_document
from chunkwright.session import stage


def _walk(files: dict) -> str:
    """The page by a plain recursive walk."""
    esc = lambda x: x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    attr = lambda x: esc(x).replace('"', "&quot;")
    entry = lambda p: f'<li><a href="#{attr(p)}">{esc(p)}</a></li>\n'

    def folder(path):
        below = {f[len(path) + 1 if path else 0 :] for f in files if f.startswith(path + "/") or not path}
        names, dirs = sorted(b for b in below if "/" not in b), sorted({b.split("/")[0] for b in below if "/" in b})
        full = lambda n: f"{path}/{n}" if path else n
        out = ""
        if path:
            parts = path.split("/")
            crumbs = [f'<a href="#{attr("/".join(parts[:i]))}">{esc(parts[i - 1])}</a>' for i in range(1, len(parts))]
            out += f'<h2 id="{attr(path)}">{" > ".join([*crumbs, esc(parts[-1])])}</h2>\n'
            out += '<ul class="dirs">\n' + "".join(entry(full(d)) for d in dirs) + "</ul>\n"
            out += '<ul class="files">\n' + "".join(entry(full(n)) for n in names) + "</ul>\n"
        for n in names:
            out += f'<h3 id="{attr(full(n))}">{esc(full(n))}</h3>\n<pre><code>{esc(files[full(n)])}</code></pre>\n'
        return out + "".join(folder(full(d)) for d in dirs)

    return '<!DOCTYPE html>\n<html><head><meta charset="utf-8"><title>T &amp; t</title></head>\n<body>\n<h1>T &amp; t</h1>\n' + folder("") + "</body></html>\n"


def _random_files(seed, n=60):
    rnd = random.Random(seed)
    names = ["a", "b<", 'c"', "d&", "é"]
    return {"/".join(rnd.choice(names) for _ in range(rnd.randrange(0, 4))) + f"/f{i}.txt" if rnd.random() < 0.9 else f"r{i}.txt": "line <1>\n" * rnd.randrange(4) + "end" for i in range(n)}


def _page(out):
    return "".join(open(os.path.join(out, p), newline="").read() for p in sorted(os.listdir(out)) if p.startswith("part-"))


def test_written_page_equals_a_plain_walk_and_reads_bodies_once(spark):
    files = {k.lstrip("/"): v for k, v in _random_files(3).items()}
    log, out = tempfile.mkdtemp(prefix="cw-read-"), tempfile.mkdtemp(prefix="cw-page-") + "/doc"
    names = stage(spark.createDataFrame([(p, len(b)) for p, b in files.items()], "out_path string, n_bytes long"), "names")

    def read(batches):
        for b in batches:
            for p in b["out_path"]:
                open(f"{log}/{len(os.listdir(log))}-{abs(hash(p))}", "w").close()
            yield pd.DataFrame({"out_path": b["out_path"], "body": [files[p] for p in b["out_path"]]})

    artifacts = names.repartition(3).mapInPandas(read, "out_path string, body string")
    save_document(artifacts, "T & t", out, paths=names)
    assert _page(out) == _walk(files)
    assert len({f.split("-")[1] for f in os.listdir(log)}) == len(files) == len(os.listdir(log))
    assert len([p for p in os.listdir(out) if p.startswith("part-")]) > 1  # several ranges
    save_document(artifacts, "T & t", out + "2")  # without paths: staged once
    assert _page(out + "2") == _walk(files) and len(os.listdir(log)) == 2 * len(files)


def test_structure_needs_one_shuffle_and_no_join(spark):
    df = stage(spark.createDataFrame([(f"a/b{i % 7}/f{i}.py", "x" * i) for i in range(90)], "out_path string, body string"), "arts")
    frags = document_fragments(df, "T")
    frags.collect()
    plan = frags._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" not in plan and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert sum("body" in s for s in scans) == 1
    only = page_structure(df.select("out_path"), "T")._jdf.queryExecution().executedPlan().toString()
    assert "body#" not in "".join(re.findall(r"FileScan parquet \[([^\]]*)\]", only))


def test_a_folder_of_many_files_is_many_parts(spark):
    df = spark.range(5000).select(F.concat(F.lit("big/f"), F.col("id")).alias("out_path"), F.lit("body").alias("body"))
    out = tempfile.mkdtemp(prefix="cw-big-") + "/doc"
    save_document(df, "T", out)
    sizes = sorted(os.path.getsize(f"{out}/{p}") for p in os.listdir(out) if p.startswith("part-"))
    assert len(sizes) == 4 and sizes[-1] < 2 * sizes[0]
