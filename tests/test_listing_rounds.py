"""Breadth-first listing in rounds: deep chains, wide subtrees, same files."""

import os
import tempfile

import pytest

from chunkwright.sources.tree import list_files, list_rounds, list_tree, scan_tree


def _tree(paths):
    root = tempfile.mkdtemp(prefix="cw-rounds-")
    for p in paths:
        os.makedirs(os.path.dirname(f"{root}/{p}"), exist_ok=True)
        with open(f"{root}/{p}", "w") as fh:
            fh.write(p)
    return root


CHAIN = ["/".join(f"c{i}" for i in range(k)) + "/f.py" for k in (1, 25, 50)]
WIDE = [f"a/b/c/d/e/w{i}/x{j}/f{k}.py" for i in range(12) for j in range(3) for k in range(2)]
OTHER = ["__init__.py", ".hid/a.py", "_priv/test_a.py", "n.txt", "a/b/Test.py"]


@pytest.fixture(scope="module")
def root():
    root = _tree([*CHAIN, *WIDE, *OTHER])
    os.symlink(root, f"{root}/loop")
    return root


@pytest.mark.parametrize("budget", [6, 2000])
def test_rounds_list_what_a_walk_lists(spark, root, budget):
    for suffix, exclude in (("", None), (".py", "test"), ((".txt", ".py"), None)):
        got = sorted(map(tuple, list_files(spark, root, suffix, exclude, budget).collect()))
        want = sorted(list_tree(root, tuple(x for x in ((suffix,) if isinstance(suffix, str) else suffix) if x), exclude))
        assert got == want


def test_a_chain_takes_one_round_and_a_wide_subtree_many_tasks(spark, root):
    chain = _tree(CHAIN)
    assert len(list_rounds(spark, chain)) == 1
    rounds = list_rounds(spark, root, budget=4)
    tasks = {r.task for rows in rounds for r in rows.where("rel_path like 'a/b/c/d/e/w%/x%/f%'").select("task").distinct().collect()}
    assert len(tasks) > 1 and len(rounds) < 30
    assert rounds[-1].where("folder").count() == 0


def test_scan_reads_what_rounds_list(spark, root):
    rows = {r.rel_path: bytes(r.content).decode() for r in scan_tree(spark, root, ".py", "test").collect()}
    assert rows == {p: p for p in [*CHAIN, *WIDE, "__init__.py", ".hid/a.py"]}
