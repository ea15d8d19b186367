import os
import tempfile

from pyspark.sql import functions as F

from chunkwright.functions.paths import html_escape
from chunkwright.operators.filters import chunk_gate, non_test_files, python_files
from chunkwright.operators.hierarchy import directory_nodes, document_fragments, write_document
from chunkwright.sources.tree import decode_text, scan_tree, write_tree


def _tree(files: dict) -> str:
    root = tempfile.mkdtemp(prefix="cw-tree-")
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(data)
    return root


def test_scan_finds_hidden_and_underscore_names(spark):
    root = _tree({"pkg/__init__.py": b"x", "_priv/x.py": b"y", ".hid/y.py": b"z", "a.pyc": b"", "b/.py": b""})
    got = sorted(r.rel_path for r in scan_tree(spark, root, ".py").collect())
    assert got == [".hid/y.py", "_priv/x.py", "b/.py", "pkg/__init__.py"]


def test_scan_does_not_follow_dir_links(spark):
    root = _tree({"a/x.py": b"1"})
    os.symlink(os.path.join(root, "a"), os.path.join(root, "link"))
    assert sorted(r.rel_path for r in scan_tree(spark, root).collect()) == ["a/x.py"]


def test_decode(spark):
    root = _tree({"bad.py": b"\xff\xfe", "nl.py": b"a\r\nb\rc", "bom.py": "﻿x".encode()})
    got = {r.rel_path: r.text for r in decode_text(scan_tree(spark, root)).collect()}
    assert got == {"bad.py": None, "nl.py": "a\nb\nc", "bom.py": "﻿x"}


def test_name_filters(spark):
    df = spark.createDataFrame([(p,) for p in ["tests/util.py", "a/latest.py", "a/Test.py", "a.PY", ".py", "a.pyc"]], "rel_path string")
    got = sorted(r.rel_path for r in non_test_files(python_files(df)).collect())
    assert got == [".py", "tests/util.py"]


def test_gate(spark):
    df = spark.createDataFrame([("",), ("x" * 9,), ("x" * 10,), (" " * 10,)], "chunk_text string")
    assert [r.gated for r in chunk_gate(df).collect()] == [True, True, False, True]


def test_write_tree_round_trip(spark):
    root = tempfile.mkdtemp(prefix="cw-out-")
    df = spark.createDataFrame([("a/b.txt", "héllo"), ("c.py", "")], "out_path string, body string")
    assert write_tree(df, root) == (2, len("héllo".encode()))
    got = {r.rel_path: r.text for r in decode_text(scan_tree(spark, root)).collect()}
    assert got == {"a/b.txt": "héllo", "c.py": ""}


def test_nodes_root_file_has_no_dir(spark):
    df = spark.createDataFrame([("x.py",)], "out_path string")
    assert [(r.path, r.parent, r.kind, r.depth) for r in directory_nodes(df).collect()] == [("x.py", "", "file", 0)]


def test_document_order_files_before_subdirs(spark):
    paths = ["a/z.py", "a/b/c.py", "r.py", "a/b/d/e.py", "ab/f.py"]
    df = spark.createDataFrame([(p, "<a>&") for p in paths], "out_path string, body string")
    frags = document_fragments(df, "T").orderBy("sort_key").collect()
    ids = []
    for f in frags:
        b = f.body
        if b.startswith("<h2 id=") or b.startswith("<h3 id="):
            ids.append(b.split('"')[1])
    assert ids == ["r.py", "a", "a/z.py", "a/b", "a/b/c.py", "a/b/d", "a/b/d/e.py", "ab", "ab/f.py"]
    assert "&lt;a&gt;&amp;" in [f.body for f in frags if f.body.startswith('<h3 id="r.py"')][0]
    out = tempfile.mkdtemp(prefix="cw-doc-") + "/doc"
    write_document(document_fragments(df, "T"), out)
    parts = sorted(p for p in os.listdir(out) if p.startswith("part-"))
    page = "".join(open(os.path.join(out, p)).read() for p in parts)
    assert page.startswith("<!DOCTYPE html>") and page.endswith("</body></html>\n")
    assert page.index('id="a/z.py"') < page.index('id="a/b"') < page.index('id="ab"')


def test_html_escape(spark):
    df = spark.createDataFrame([("<a>&",)], "s string")
    assert df.select(html_escape("s")).first()[0] == "&lt;a&gt;&amp;"


def test_breadcrumbs_have_no_empty_root_link(spark):
    from chunkwright.operators.hierarchy import breadcrumbs

    df = spark.createDataFrame([("a/b/c.py",)], "out_path string")
    got = {r.path: r.crumbs for r in breadcrumbs(directory_nodes(df)).collect()}
    assert got == {"a": "a", "a/b": '<a href="#a">a</a> > b'}


def test_executor_listing_equals_driver_listing(spark):
    files = {f"d{i % 3}/s{i % 5}/deep/f{i}.py": f"x{i}".encode() for i in range(40)}
    files.update({"top.py": b"t", "d0/flat.py": b"f", "d1/readme.txt": b"r", ".h/t_test.py": b"q"})
    root = _tree(files)
    a = sorted((r.rel_path, r.n_bytes, bytes(r.content)) for r in scan_tree(spark, root, ".py", "test").collect())
    for depth in (0, 1, 2, 5):
        b = sorted((r.rel_path, r.n_bytes, bytes(r.content))
                   for r in scan_tree(spark, root, ".py", "test", listing="executors", list_depth=depth).collect())
        assert a == b
    assert len(a) == 42


def test_file_uri_roots(spark):
    root = tempfile.mkdtemp(prefix="cw-uri-")
    df = spark.createDataFrame([("a/b.py", "x")], "out_path string, body string")
    write_tree(df, "file:" + root)
    assert os.path.exists(os.path.join(root, "a/b.py"))
    assert [r.rel_path for r in scan_tree(spark, "file://" + root).collect()] == ["a/b.py"]


def test_json_outline_paths_like_duckdb(spark):
    import duckdb

    from chunkwright.operators.hierarchy import json_outline

    doc = '{"Functions/Methods": {"f0": "x"}, "a_b": 1, "1a": 2, "A9": [true, null, "q", {"z": []}], "k\\"q": 3, "": 4, "a.b": {}}'
    df = spark.createDataFrame([(1, doc)], "id long, j string")
    got = sorted((r.path, r.value) for r in json_outline(df, "id", "j").where("path <> '$'").collect())
    want = sorted(duckdb.sql("select fullkey, atom::varchar from json_tree(?) where fullkey <> '$'", params=[doc]).fetchall())
    assert got == want


def test_read_artifacts_from_table(spark):
    from chunkwright.sources.artifacts import read_artifacts

    df = spark.createDataFrame([("a/x.txt", "1"), ("a/y.py", "2"), ("a/z.md", "3")], "rel_path string, body string")
    assert sorted(r.out_path for r in read_artifacts(spark, df).collect()) == ["a/x.txt", "a/y.py"]


def test_list_only_opens_nothing(spark):
    root = _tree({"a.py": b"1", "b/c.txt": b"22"})
    os.chmod(os.path.join(root, "a.py"), 0)  # unreadable: listing must not open it
    rows = sorted((r.rel_path, r.n_bytes, r.content, r.error) for r in scan_tree(spark, root, list_only=True).collect())
    assert rows == [("a.py", 1, None, None), ("b/c.txt", 2, None, None)]
    for depth in (0, 1):
        rows2 = sorted((r.rel_path, r.n_bytes) for r in scan_tree(spark, root, list_only=True, listing="executors", list_depth=depth).collect())
        assert rows2 == [("a.py", 1), ("b/c.txt", 2)]


def _walk_ids(paths):
    """Pre-order walk of the folder tree: a folder's heading, its files (by
    name), then its subfolders (by name); root files come first, no root
    heading."""
    tree = {}
    for p in paths:
        node = tree
        parts = p.split("/")
        for d in parts[:-1]:
            node = node.setdefault(d, {})
        node[parts[-1]] = None
    out = []

    def visit(node, prefix):
        for name in sorted(k for k, v in node.items() if v is None):
            out.append(prefix + name)
        for name in sorted(k for k, v in node.items() if v is not None):
            out.append(prefix + name)
            visit(node[name], prefix + name + "/")

    visit(tree, "")
    return out


def test_document_order_random_trees(spark):
    import random

    rnd = random.Random(9)
    names = ["a", "b", "ab", "a_b", "B", "x.py", "y.txt", "z"]
    for _ in range(3):
        paths = set()
        while len(paths) < 40:
            depth = rnd.randint(1, 4)
            paths.add("/".join(rnd.choice(names[:5]) for _ in range(depth - 1)) + ("/" if depth > 1 else "") + rnd.choice(names[5:]) + str(rnd.randint(0, 3)))
        # a path may not be both a file and a folder
        paths = {p for p in paths if not any(q.startswith(p + "/") for q in paths)}
        df = spark.createDataFrame([(p, "body") for p in sorted(paths)], "out_path string, body string")
        frags = document_fragments(df, "T").orderBy("sort_key").collect()
        ids = [f.body.split('"')[1] for f in frags if f.body.startswith(("<h2 id=", "<h3 id="))]
        assert ids == _walk_ids(paths)


def test_document_escape_switch(spark):
    df = spark.createDataFrame([("a/x.py", "<b>&")], "out_path string, body string")
    raw = [f.body for f in document_fragments(df, "T", escape=False).collect() if f.body.startswith("<h3")]
    esc = [f.body for f in document_fragments(df, "T").collect() if f.body.startswith("<h3")]
    assert "<pre><code><b>&</code></pre>" in raw[0] and "<pre><code>&lt;b&gt;&amp;</code></pre>" in esc[0]


def test_json_outline_has_no_row_or_depth_cap(spark):
    from chunkwright.operators.hierarchy import json_outline

    deep = spark.createDataFrame([(1, '{"a":' * 120 + "1" + "}" * 120), (2, '{"a":1,"a":2}'), (3, "no json"), (4, None)], "id int, j string")
    rows = json_outline(deep, "id", "j").collect()
    assert max(r.depth for r in rows) == 120
    assert [(r.path, r.value) for r in rows if r.id == 2 and r.depth] == [("$.a", "2")]
    assert [(r.path, r.type) for r in rows if r.id in (3, 4)] == [("$", None)] * 2
    wide = spark.range(600_000).selectExpr("id", "'{\"k\":1}' AS j")
    assert json_outline(wide, "id", "j").count() == 1_200_000
