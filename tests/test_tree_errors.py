"""Folders that can't be listed are rows with an error."""

import os
import tempfile

import pytest

from chunkwright.sources.tree import _TreeReader, decode_text, scan_tree


@pytest.fixture(scope="module")
def root():
    """A tree with a file and, below it, a folder whose path is too long to be
    opened (which holds for any user, unlike permissions)."""
    root = tempfile.mkdtemp(prefix="cw-lost-")
    open(os.path.join(root, "a.py"), "w").close()
    at = os.open(root, os.O_RDONLY)
    for _ in range(18):
        os.mkdir("d" * 250, dir_fd=at)
        below = os.open("d" * 250, os.O_RDONLY, dir_fd=at)
        os.close(at)
        at = below
    os.close(at)
    return root


@pytest.mark.parametrize("how", [{}, {"listing": "driver"}, {"list_depth": 0}, {"list_depth": 40}, {"list_only": True}, {"list_only": True, "listing": "driver"}])
def test_lost_folder_is_an_error_row(spark, root, how):
    rows = {r.rel_path: r for r in scan_tree(spark, root, ".py", "test", **how).collect()}
    assert rows.pop("a.py").error is None
    ((path, lost),) = rows.items()
    assert set(path) == {"d", "/"} and lost.content is None and lost.n_bytes is None and lost.error.startswith("OSError")


def test_lost_root_is_an_error_row(spark, root):
    for how in ({}, {"listing": "driver"}):
        (row,) = decode_text(scan_tree(spark, root + "/none", **how)).collect()
        assert row.rel_path == "." and row.text is None and row.error.startswith("FileNotFoundError")


def test_executors_list_by_default_in_as_many_tasks_as_folders_ask_for():
    root = tempfile.mkdtemp(prefix="cw-many-")
    for i in range(1200):
        os.mkdir(os.path.join(root, f"d{i}"))
    parts = _TreeReader({"path": root, "foldersPerPartition": "2"}, None).partitions()
    assert len(parts) > 512 and sum(len(p.units) for p in parts) == 1201
