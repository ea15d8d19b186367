"""File trees as tables: the `source_tree` data source, UTF-8 decoding and a
tree writer.

`spark.read.format("source_tree").load(root)` lists every file below root,
hidden and underscore names included (Spark's own file listing hides them),
without following links to directories. Files are packed into partitions by
size on the driver, like Spark's file sources do; the bytes are read on the
executors. Options:

  suffix            keep names ending with it (case-sensitive), e.g. ".py"
  suffixes          comma-separated alternatives to `suffix`
  exclude_name      drop names containing it, any case, e.g. "test"
  maxPartitionBytes target bytes per partition (default 64 MiB)
  openCostInBytes   bytes counted for opening a file (default 512 KiB)
  minPartitions     spread small trees over at least this many partitions
  maxFilesPerPartition  (default 2000)
  mode              "read" (default) or "list": paths and sizes only
  listing           "executors" (default): the driver only walks folders
                    down to `listDepth` (default 2) and each task lists its
                    own subtrees; "driver": the driver lists every file, as
                    Spark's file sources do. `scan_tree` lists by neither, but
                    in rounds that rebalance the open folders (list_rounds).
  foldersPerPartition   folders a listing task is given (default 16)

A folder that can't be listed is a row with its path (the root: "."), no
content, the error and the reason "not_listed"; it passes the name filters. A
file that can't be read is such a row with the reason "io_error".

The name filters are options rather than pushed filters, so files that do
not match are never opened.
"""

from __future__ import annotations

import codecs
import os
import uuid
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from chunkwright.functions.text import normalise_newlines

TREE_SCHEMA = "rel_path string, content binary, n_bytes bigint, error string, reason string"
NOT_LISTED, IO_ERROR = "not_listed", "io_error"


class _Files(InputPartition):
    def __init__(self, root: str, files: list):
        super().__init__(None)
        self.root = root
        self.files = files


class _Folders(InputPartition):
    """Folders to list on an executor: (relative folder, whole subtree?)."""

    def __init__(self, root: str, units: list):
        super().__init__(None)
        self.root = root
        self.units = units


def folder_units(root: str, depth: int) -> list[tuple[str, bool]]:
    """Folders above `depth` are listed flat (their own files only); folders
    at `depth` are listed with their whole subtree. Links to folders are not
    followed."""
    units, frontier = [], [("", 0)]
    while frontier:
        rel, d = frontier.pop()
        if d >= depth:
            units.append((rel, True))
            continue
        try:
            with os.scandir(os.path.join(root, rel)) as it:
                below = [(f"{rel}/{e.name}" if rel else e.name, d + 1) for e in it if e.is_dir(follow_symlinks=False)]
        except OSError:
            units.append((rel, True))  # the task lists it again, and reports it
            continue
        units.append((rel, False))
        frontier += below
    return units


def _message(e: OSError) -> str:
    return f"{type(e).__name__}: {e}"


def _is_folder(e: os.DirEntry) -> bool:
    """Also true of links to folders, which are neither files nor followed."""
    try:
        return e.is_dir()
    except OSError:
        return False


def _list_unit(root: str, rel: str, recursive: bool, suffixes: tuple, exclude: str | None):
    base = os.path.join(root, rel) if rel else root
    if recursive:
        for r, size, error in list_tree(base, suffixes, exclude):
            yield (rel if r == "." else f"{rel}/{r}") if rel else r, size, error
        return
    try:
        with os.scandir(base) as it:
            for e in it:
                if not _is_folder(e) and _keep(e.name, suffixes, exclude):
                    try:
                        size = e.stat().st_size
                    except OSError:
                        size = 0
                    yield (f"{rel}/{e.name}" if rel else e.name), size, None
    except OSError as e:
        yield rel or ".", None, _message(e)


def local_root(path: str) -> str:
    """A folder path for Python's file API: 'file:' URIs are turned into
    plain paths; other schemes need a mount (the tree is read with open())."""
    if path.startswith("file://"):
        return path[len("file://"):] or "/"
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        raise ValueError(f"source_tree reads mounted folders; mount {path} and pass its local path")
    return path


def _keep(name: str, suffixes: tuple, exclude: str | None) -> bool:
    if suffixes and not name.endswith(suffixes):
        return False
    if exclude and exclude.lower() in name.lower():
        return False
    return True


def list_tree(root: str, suffixes: tuple = (), exclude: str | None = None) -> Iterator[tuple[str, int | None, str | None]]:
    """(relative path, size, None) of every matching file below root, links to
    directories not followed, and (relative path, None, error) of every folder
    that can't be listed."""

    def relative(path: str) -> str:
        return os.path.relpath(path, root).replace(os.sep, "/")

    lost = []
    for folder, _dirs, names in os.walk(root, followlinks=False, onerror=lost.append):
        for name in names:
            if not _keep(name, suffixes, exclude):
                continue
            full = os.path.join(folder, name)
            try:
                size = os.stat(full).st_size
            except OSError:
                size = 0
            yield relative(full), size, None
        while lost:
            e = lost.pop()
            yield relative(e.filename), None, _message(e)
    for e in lost:
        yield relative(e.filename), None, _message(e)


class _TreeReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        root = options.get("path") or options.get("root")
        if not root:
            raise ValueError("source_tree needs a root folder: .load(root)")
        self.root = local_root(root)
        sfx = options.get("suffixes") or options.get("suffix") or ""
        self.suffixes = tuple(s for s in sfx.split(",") if s)
        self.exclude = options.get("exclude_name") or None
        self.target = int(options.get("maxPartitionBytes", 64 << 20))
        self.max_files = int(options.get("maxFilesPerPartition", 2000))
        self.list_only = options.get("mode", "read") == "list"
        self.on_executors = options.get("listing", "executors") == "executors"
        self.depth = int(options.get("listDepth", 2))
        self.folders = int(options.get("foldersPerPartition", 16))
        self.open_cost = int(options.get("openCostInBytes", 512 << 10))
        self.min_parts = int(options.get("minPartitions", 1))

    def partitions(self):
        if self.on_executors:
            units = folder_units(self.root, self.depth)
            n = max(1, min(len(units), max(self.min_parts, -(-len(units) // self.folders))))
            return [_Folders(self.root, units[i::n]) for i in range(n)]
        # Like Spark's file sources: each file costs its size plus an open
        # cost, and a small tree is still spread over minPartitions.
        listed = list(list_tree(self.root, self.suffixes, self.exclude))
        total = sum((size or 0) + self.open_cost for _, size, _ in listed)
        target = min(self.target, max(self.open_cost, total // max(1, self.min_parts)))
        parts, cur, cur_bytes = [], [], 0
        for rel, size, error in listed:
            cost = (size or 0) + self.open_cost
            if cur and (cur_bytes + cost > target or len(cur) >= self.max_files):
                parts.append(_Files(self.root, cur))
                cur, cur_bytes = [], 0
            cur.append((rel, size, error))
            cur_bytes += cost
        if cur:
            parts.append(_Files(self.root, cur))
        return parts or [_Files(self.root, [])]

    def read(self, partition):
        if isinstance(partition, _Folders):
            for rel, recursive in partition.units:
                for path, size, error in _list_unit(partition.root, rel, recursive, self.suffixes, self.exclude):
                    yield self._row(partition.root, path, size, error)
            return
        for rel, size, error in partition.files:
            yield self._row(partition.root, rel, size, error)

    def _row(self, root: str, rel: str, size: int | None, error: str | None):
        if self.list_only or error:
            return (rel, None, size, error, NOT_LISTED if error else None)
        return self._read_one(root, rel)

    @staticmethod
    def _read_one(root: str, rel: str):
        try:
            with open(os.path.join(root, rel), "rb") as fh:
                data = fh.read()
            return (rel, data, len(data), None, None)
        except OSError as e:
            return (rel, None, None, _message(e), IO_ERROR)


class SourceTree(DataSource):
    @classmethod
    def name(cls):
        return "source_tree"

    def schema(self):
        return TREE_SCHEMA

    def reader(self, schema):
        return _TreeReader(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SourceTree)


LISTED_SCHEMA = "rel_path string, n_bytes bigint, error string, folder boolean, task int"


def _lister(root: str, suffixes: tuple, exclude: str | None, budget: int):
    """Lists every folder it is given and goes on below them, breadth first,
    until it has listed `budget` folders; those still open are rows too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()

        def frame(rows):
            return pd.DataFrame(rows, columns=["rel_path", "n_bytes", "error", "folder", "task"]).astype({"n_bytes": "Int64", "task": "int32"})

        rows, given, listed = [], deque(), 0
        for b in batches:
            given.extend(b["rel_path"])
        own = len(given)
        while given and listed < max(budget, own):
            rel = given.popleft()
            listed += 1
            try:
                with os.scandir(os.path.join(root, rel)) as it:
                    for e in it:
                        path = f"{rel}/{e.name}" if rel else e.name
                        if e.is_dir(follow_symlinks=False):
                            given.append(path)
                        elif not _is_folder(e) and _keep(e.name, suffixes, exclude):
                            try:
                                size = e.stat().st_size
                            except OSError:
                                size = 0
                            rows.append((path, size, None, False, task))
                            if len(rows) >= 10_000:
                                yield frame(rows)
                                rows = []
            except OSError as e:
                rows.append((rel or ".", None, _message(e), False, task))
        rows += [(rel, None, None, True, task) for rel in given]
        yield frame(rows)

    return run


def list_rounds(spark: SparkSession, root: str, suffix: str | tuple = "", exclude_name: str | None = None, budget: int = 2000) -> list[DataFrame]:
    """The tree listed breadth first, as staged rounds (LISTED_SCHEMA). A
    round deals the folders left open by the one before evenly over tasks, so
    work spreads wherever the tree is wide, at any depth, and a narrow or deep
    tree of up to `budget` folders is done in one round. The driver sees
    counts only."""
    from chunkwright.session import stage

    suffixes = tuple(x for x in ((suffix,) if isinstance(suffix, str) else suffix) if x)
    most = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rounds, frontier, n = [], spark.createDataFrame([("",)], "rel_path string"), 1
    while n:
        dealt = frontier.repartition(min(n, most))
        rounds.append(stage(dealt.mapInPandas(_lister(local_root(root), suffixes, exclude_name, budget), LISTED_SCHEMA), "listing"))
        frontier = rounds[-1].where("folder").select("rel_path")
        n = frontier.count()
    return rounds


def list_files(spark: SparkSession, root: str, suffix: str | tuple = "", exclude_name: str | None = None, budget: int = 2000) -> DataFrame:
    """(rel_path, n_bytes, error) of every matching file below root, and of
    every folder that can't be listed (with the error), from list_rounds."""
    out = None
    for r in list_rounds(spark, root, suffix, exclude_name, budget):
        rows = r.where("NOT folder").select("rel_path", "n_bytes", "error")
        out = rows if out is None else out.unionByName(rows)
    return out


def scan_tree(
    spark: SparkSession,
    root: str,
    suffix: str | tuple = "",
    exclude_name: str | None = None,
    listing: str = "executors",
    list_depth: int | None = None,
    target_bytes: int = 64 << 20,
    list_only: bool = False,
) -> DataFrame:
    """(rel_path, content, n_bytes, error, reason) for every matching file below root.

    listing="executors": tasks list the folders in rounds (see list_rounds;
    with list_depth, in one round from the folders at that depth), and the
    files are read in partitions hashed by path, sized from the listed bytes;
    a folder that holds a large share of all files is spread over many tasks.
    listing="driver": the driver lists all. A folder that can't be listed is a
    row with an error.
    list_only: paths and sizes only, no file is opened (content NULL)."""
    register(spark)
    root = local_root(root)
    r = spark.read.format("source_tree").option("minPartitions", str(spark.sparkContext.defaultParallelism))
    sfx = ",".join(suffix) if isinstance(suffix, tuple) else suffix
    if sfx:
        r = r.option("suffixes", sfx)
    if exclude_name:
        r = r.option("exclude_name", exclude_name)
    if listing != "executors":
        return r.option("listing", listing).option("mode", "list" if list_only else "read").load(root)
    from chunkwright.session import stage

    if list_depth is not None:
        names = r.option("listing", "executors").option("listDepth", str(list_depth)).option("mode", "list").load(root)
        listed = stage(names.select("rel_path", "n_bytes", "error"), "listing")
    else:
        listed = list_files(spark, root, suffix, exclude_name)
    if list_only:
        reason = F.when(F.col("error").isNotNull(), NOT_LISTED)
        return listed.select("rel_path", F.lit(None).cast("binary").alias("content"), "n_bytes", "error", reason.alias("reason"))
    agg = listed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first()
    # a small tree is still spread over all cores
    n = max(1, min(int(agg["n"]), max(spark.sparkContext.defaultParallelism, -(-int(agg["b"]) // target_bytes))))
    return listed.repartition(n, "rel_path").mapInPandas(_reader(root), TREE_SCHEMA)


def _reader(root: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(rel, None, None, e, NOT_LISTED) if isinstance(e, str) else _TreeReader._read_one(root, rel) for rel, e in zip(b["rel_path"], b["error"])]
            yield pd.DataFrame(out, columns=["rel_path", "content", "n_bytes", "error", "reason"]).astype({"n_bytes": "Int64"})

    return read


def _border(fh, at: int, size: int) -> int:
    """The first byte at or after `at` that starts a character and is not the
    second half of a CR LF: ranges cut there decode and normalise alone."""
    if at <= 0 or at >= size:
        return max(0, min(at, size))
    fh.seek(at - 1)
    near = fh.read(6)
    i = 1
    while i < len(near) and i < 4 and near[i] & 0xC0 == 0x80:
        i += 1
    if near[i : i + 1] == b"\n" and near[i - 1 : i] == b"\r":
        i += 1
    return min(at - 1 + i, size)


def _plain_newlines(text: str) -> str:
    return text.replace("\r\n", "\n").replace("\r", "\n")


def _some_text(fh, at: int, chars: int) -> str:
    """The first characters from byte `at` on; what does not decode is left to
    the range that owns it."""
    fh.seek(at)
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    return _plain_newlines(decoder.decode(fh.read(4 * chars + 4)))[:chars]


def _read_range(root: str, rel: str, no: int, last: bool, range_bytes: int, max_chars: int):
    """(body, ahead, reason) of one byte range of a file; the last one goes to
    the end the file has now."""
    try:
        with open(os.path.join(root, rel), "rb") as fh:
            size = os.fstat(fh.fileno()).st_size
            first, end = _border(fh, no * range_bytes, size), size if last else _border(fh, (no + 1) * range_bytes, size)
            fh.seek(first)
            data = fh.read(end - first)
            ahead = _some_text(fh, end, max_chars + 1)
    except OSError:
        return None, None, IO_ERROR
    try:
        return _plain_newlines(data.decode("utf-8")), ahead, None
    except UnicodeDecodeError:
        return None, None, "not_utf8"


def scan_heads(spark: SparkSession, root: str, chars: int, suffix: str | tuple = "", exclude_name: str | None = None) -> DataFrame:
    """(rel_path, text) with the first `chars` characters of every matching
    file that can be read, for the sample that fixes its chunk size."""
    root = local_root(root)

    def read(batches):
        for b in batches:
            out = []
            for rel in b["rel_path"]:
                try:
                    with open(os.path.join(root, rel), "rb") as fh:
                        out.append((rel, _some_text(fh, 0, chars)))
                except OSError:
                    continue
            yield pd.DataFrame(out, columns=["rel_path", "text"])

    listed = scan_tree(spark, root, suffix, exclude_name, list_only=True).where("error IS NULL").select("rel_path")
    return listed.repartition(spark.sparkContext.defaultParallelism, "rel_path").mapInPandas(read, "rel_path string, text string")


def scan_ranges(spark: SparkSession, root: str, max_chars: int | DataFrame, range_bytes: int = 8 << 20,
                suffix: str | tuple = "", exclude_name: str | None = None) -> DataFrame:
    """Every matching file as byte ranges of about range_bytes, each read by
    itself: (rel_path, range_no, body, ahead, max_chars, reason), the input of
    operators.ranges.chunk_ranges. max_chars: the chunk size, or a table
    (rel_path, max_chars). No task holds more than a few ranges, so a file may
    have any size. A range that can't be read or is not UTF-8 has no body and
    a reason, and so has a folder that can't be listed; ``sound_ranges`` tells
    them from the rest. An empty file is one range with an empty body, which
    sound_ranges drops."""
    root = local_root(root)
    listed = scan_tree(spark, root, suffix, exclude_name, list_only=True).select("rel_path", "n_bytes", "error", "reason")
    files = listed.where("error IS NULL").withColumn("last", F.expr(f"greatest(n_bytes - 1, 0) div {int(range_bytes)}"))
    if isinstance(max_chars, DataFrame):
        files = files.join(max_chars.select("rel_path", F.col("max_chars").cast("bigint").alias("max_chars")), "rel_path")
    else:
        files = files.withColumn("max_chars", F.lit(int(max_chars)).cast("bigint"))
    ranges = files.select("rel_path", "max_chars", "last", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("range_no"))
    schema = "rel_path string, range_no bigint, body string, ahead string, max_chars bigint, reason string"

    def read(batches):
        for b in batches:
            for rel, no, last, most in zip(b["rel_path"], b["range_no"], b["last"], b["max_chars"]):
                row = rel, no, *_read_range(root, rel, int(no), no == last, range_bytes, int(most))
                yield pd.DataFrame([(*row[:4], most, row[4])], columns=["rel_path", "range_no", "body", "ahead", "max_chars", "reason"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lost = listed.where("error IS NOT NULL").select("rel_path", F.lit(None).cast("bigint").alias("range_no"), "reason")
    return ranges.repartition(n, "rel_path", "range_no").mapInPandas(read, schema).unionByName(lost, allowMissingColumns=True)


def sound_ranges(ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ranges of the files of which every range was read, lost files with
    their reason)."""
    lost = ranges.where(F.col("reason").isNotNull()).groupBy("rel_path").agg(F.min("reason").alias("reason"))
    kept = ranges.where(F.col("reason").isNull()).join(lost, "rel_path", "left_anti").drop("reason")
    return kept.where(F.length("body") > 0), lost


def decode_text(scanned: DataFrame) -> DataFrame:
    """Strict UTF-8 text with CR LF and CR turned into LF (a BOM is kept).
    Bytes that are not UTF-8 give text NULL (to be quarantined)."""
    raw = F.try_validate_utf8(F.col("content").cast("string"))
    return scanned.withColumn("text", normalise_newlines(raw)).withColumn(
        "n_chars", F.length("text").cast("bigint")
    ).withColumn("file_name", F.substring_index("rel_path", "/", -1))


def _writer(root: str, path_col: str, body_col: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes = []
            for rel, body in zip(b[path_col], b[body_col]):
                data = body if isinstance(body, (bytes, bytearray)) else str(body).encode("utf-8")
                dest = os.path.join(root, rel)
                os.makedirs(os.path.dirname(dest) or root, exist_ok=True)
                tmp = f"{dest}.tmp-{uuid.uuid4().hex[:8]}"
                with open(tmp, "wb") as fh:
                    fh.write(data)
                os.replace(tmp, dest)  # atomic: a retried task rewrites the same file
                sizes.append(len(data))
            yield pd.DataFrame({"rel_path": b[path_col].values, "n_bytes": pd.Series(sizes, dtype="int64")})

    return write


def write_tree(df: DataFrame, root: str, path_col: str = "out_path", body_col: str = "body") -> tuple[int, int]:
    """Write one file per row below root (a folder every executor can reach,
    e.g. a shared mount). Returns (files, bytes). Writes are idempotent, so a
    lost task is simply run again."""
    root = local_root(root)
    rows = df.select(path_col, body_col)
    par = df.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < par:
        rows = rows.repartition(par, path_col)  # spread the writes
    written = rows.mapInPandas(_writer(root, path_col, body_col), "rel_path string, n_bytes bigint")
    row = written.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])
