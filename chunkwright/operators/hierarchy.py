"""Directory tree, breadcrumbs and the ordered document (section F).

The tree is two tables instead of a nested dict: `nodes` (one row per
directory and per file) and the artifacts themselves. The document is a table
of HTML fragments with a sort key whose order is a pre-order walk of the tree
(a directory's files first, then its subdirectories, names sorted), so it can
be range-partitioned and written in order without one task holding it all.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.functions.paths import html_escape
from chunkwright.session import configure, scratch_path, stage

SEP = "\u0001"  # joins the parts of a sort key
HEAD_KEY = ""  # sorts before every fragment
TAIL_KEY = "2"  # sorts after every fragment (parts start with '0' or '1')


def _parts(col: str = "path") -> Column:
    return F.split(F.col(col), "/")


def _attr(c: Column) -> Column:
    return F.replace(html_escape(c), F.lit('"'), F.lit("&quot;"))


def directory_nodes(artifacts: DataFrame, path_col: str = "out_path") -> DataFrame:
    """(path, parent, name, depth, kind) for every file and every directory
    above one. Root-level entries have parent ''. A one-part path has no
    directory row (sequence(1, 0) would count down, so it is guarded)."""
    p = F.split(F.col(path_col), "/")
    n = F.size(p)
    files = artifacts.select(
        F.col(path_col).alias("path"),
        F.when(n > 1, F.array_join(F.slice(p, 1, n - 1), "/")).otherwise(F.lit("")).alias("parent"),
        F.element_at(p, -1).alias("name"),
        (n - 1).cast("int").alias("depth"),
        F.lit("file").alias("kind"),
    )
    levels = artifacts.select(
        p.alias("p"), F.explode_outer(F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))).alias("i")
    ).where(F.col("i").isNotNull())
    dirs = levels.select(
        F.array_join(F.slice("p", 1, F.col("i")), "/").alias("path"),
        F.when(F.col("i") > 1, F.array_join(F.slice("p", 1, F.col("i") - 1), "/")).otherwise(F.lit("")).alias("parent"),
        F.element_at("p", F.col("i")).alias("name"),
        (F.col("i") - 1).cast("int").alias("depth"),
        F.lit("dir").alias("kind"),
    ).distinct()
    return files.unionByName(dirs)


def directory_children(nodes: DataFrame) -> DataFrame:
    """Per directory ('' is the root): sorted subdirectory and file names."""
    return nodes.groupBy(F.col("parent").alias("path")).agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "dir", F.col("name")))).alias("subdirs"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "file", F.col("name")))).alias("files"),
    )


def breadcrumbs(nodes: DataFrame) -> DataFrame:
    """(path, crumbs) per directory: a link for every ancestor, then the name."""
    return nodes.where(F.col("kind") == "dir").select("path", _crumbs(_parts()).alias("crumbs"))


def sort_key(path: Column, is_file: bool) -> Column:
    """Parts joined by SEP; directory parts start with '1', a file part with
    '0', so files come before subdirectories and a directory before its
    contents."""
    p = F.split(path, "/")
    if not is_file:
        return F.array_join(F.transform(p, lambda x: F.concat(F.lit("1"), x)), SEP)
    n = F.size(p)
    dirs = F.transform(F.slice(p, 1, n - 1), lambda x: F.concat(F.lit("1"), x))
    return F.array_join(F.concat(dirs, F.array(F.concat(F.lit("0"), F.element_at(p, -1)))), SEP)


# Within a folder, after its heading (key K): the subfolder list, then the
# file list, each as open tag, one fragment per link, close tag; then the
# folder's files (K SEP '0' name) and subfolders (K SEP '1' name). '!' sorts
# before '0', so these parts come first.
DIRS_OPEN, DIR_LINK, DIRS_CLOSE = "!1", "!2", "!3"
FILES_OPEN, FILE_LINK, FILES_CLOSE = "!4", "!5", "!6"


def _folder_paths(artifacts: DataFrame, path_col: str) -> DataFrame:
    """(path, p) of every directory above a file, once each."""
    p = F.split(F.col(path_col), "/")
    n = F.size(p)
    up = F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(p, 1, i), "/")))
    dirs = artifacts.select(F.explode_outer(up).alias("path")).where(F.col("path").isNotNull()).distinct()
    return dirs.select("path", F.split("path", "/").alias("p"))


def _crumbs(p: Column) -> Column:
    """A link for every ancestor, then the name."""
    n = F.size(p)
    links = F.transform(
        F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(
            F.lit('<a href="#'), _attr(F.array_join(F.slice(p, 1, i), "/")), F.lit('">'),
            html_escape(F.element_at(p, i)), F.lit("</a>"),
        ),
    )
    return F.array_join(F.concat(links, F.array(html_escape(F.element_at(p, -1)))), " > ")


def _link(path: Column, parent: Column, name: Column, code: str) -> Column:
    """The list entry of a file or folder below its parent."""
    key = F.concat(sort_key(parent, False), F.lit(SEP), F.lit(code), name)
    text = F.concat(F.lit('<li><a href="#'), _attr(path), F.lit('">'), html_escape(path), F.lit("</a></li>\n"))
    return F.struct(key.alias("sort_key"), text.alias("body"))


def page_structure(paths: DataFrame, title: str, path_col: str = "out_path") -> DataFrame:
    """(sort_key, body) of everything but the files' own fragments: page head
    and end, per folder a heading and its subfolder and file link lists (one
    fragment per link). All of it follows from the paths: each folder is
    found once (the only shuffle) and makes its own fragments and its link
    below its parent; each file makes its link. Nothing is joined."""
    spark, t = paths.sparkSession, html_escape(F.lit(title))
    head = F.concat(F.lit('<!DOCTYPE html>\n<html><head><meta charset="utf-8"><title>'), t, F.lit("</title></head>\n<body>\n<h1>"), t, F.lit("</h1>\n"))

    def row(key, body):
        return F.struct(key.alias("sort_key"), body.alias("body"))

    shell = spark.range(1).select(F.inline(F.array(row(F.lit(HEAD_KEY), head), row(F.lit(TAIL_KEY), F.lit("</body></html>\n")))))
    path, p = F.col("path"), F.col("p")
    key = sort_key(path, False)
    own = [row(key, F.concat(F.lit('<h2 id="'), _attr(path), F.lit('">'), _crumbs(p), F.lit("</h2>\n")))]
    for code, tag in ((DIRS_OPEN, '<ul class="dirs">\n'), (DIRS_CLOSE, "</ul>\n"), (FILES_OPEN, '<ul class="files">\n'), (FILES_CLOSE, "</ul>\n")):
        own.append(row(F.concat(key, F.lit(SEP + code)), F.lit(tag)))
    own.append(F.when(F.size(p) > 1, _link(path, F.array_join(F.slice(p, 1, F.size(p) - 1), "/"), F.element_at(p, -1), DIR_LINK)))
    folders = _folder_paths(paths, path_col).select(F.explode(F.array(*own)).alias("f")).where(F.col("f").isNotNull()).select("f.sort_key", "f.body")
    file, q = F.col(path_col), F.split(F.col(path_col), "/")
    below = F.when(F.size(q) > 1, _link(file, F.array_join(F.slice(q, 1, F.size(q) - 1), "/"), F.element_at(q, -1), FILE_LINK))
    links = paths.select(below.alias("f")).where(F.col("f").isNotNull()).select("f.sort_key", "f.body")
    return shell.unionByName(folders).unionByName(links)


def file_fragments(artifacts: DataFrame, escape: bool = True, path_col: str = "out_path") -> DataFrame:
    """(sort_key, body) of the files: title and body."""
    body = html_escape(F.col("body")) if escape else F.col("body")
    return artifacts.select(
        sort_key(F.col(path_col), True).alias("sort_key"),
        F.concat(
            F.lit('<h3 id="'), _attr(F.col(path_col)), F.lit('">'), html_escape(F.col(path_col)), F.lit("</h3>\n<pre><code>"),
            body, F.lit("</code></pre>\n"),
        ).alias("body"),
    )


def document_fragments(artifacts: DataFrame, title: str, escape: bool = True, path_col: str = "out_path") -> DataFrame:
    """(sort_key, body): page head, per folder a heading, its subfolder and
    file link lists (one fragment per link), per file its title and body,
    page end. Bodies are HTML-escaped unless escape=False. No step gathers a
    folder's children into one row, so a folder of millions of files is
    spread like any other rows; sorted by sort_key the fragments make the
    page."""
    structure = page_structure(artifacts.select(path_col), title, path_col)
    return structure.unionByName(file_fragments(artifacts, escape, path_col))


BOUND_SAMPLE = 100  # keys drawn for each range of the page


def _key_bounds(keys: DataFrame, n: int) -> list[str]:
    """n - 1 keys that part the page into ranges of about equal weight, from a
    sample of about BOUND_SAMPLE * n rows (sort_key, weight)."""
    total = keys.count()
    share = min(1.0, BOUND_SAMPLE * n / max(total, 1))
    drawn = sorted(map(tuple, (keys if share >= 1 else keys.sample(share, seed=7)).collect()))
    weight, whole, bounds = 0, sum(w for _, w in drawn), []
    for key, w in drawn:
        if whole and weight * n >= whole * (len(bounds) + 1) and len(bounds) < n - 1 and (not bounds or key > bounds[-1]):
            bounds.append(key)
        weight += w
    return bounds


def write_pages(structure: DataFrame, files: DataFrame, slots: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write structure and file fragments (sort_key, body) in key order as
    text part files; read in part order they make the page.

    The ranges of the parts come from keys and sizes alone: `slots`
    (sort_key, weight) stands for the files, whose bodies are computed once,
    on their way into their range. structure and slots should be staged."""
    n = partitions or int(structure.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _key_bounds(structure.select("sort_key", F.octet_length("body").cast("bigint").alias("weight")).unionByName(slots), n)

    @F.pandas_udf("int")
    def part_of(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: bisect_right(bounds, k)).astype("int32")

    # Every fragment ends with a newline; the text writer adds it back.
    line = F.regexp_replace(F.col("body"), F.lit("\n\\z"), F.lit("")).alias("value")
    placed = structure.unionByName(files).select("sort_key", line).withColumn("_part", part_of("sort_key"))
    placed.repartitionById(len(bounds) + 1, "_part").sortWithinPartitions("sort_key").select("value").write.mode("overwrite").text(path)


def write_document(fragments: DataFrame, path: str) -> None:
    """Write ready fragments in sort_key order as text part files (see
    write_pages). They are staged first, so that finding the ranges doesn't
    compute them again."""
    kept = stage(fragments, "fragments")
    none = kept.where(F.lit(False))
    write_pages(kept, none, none.select("sort_key", F.lit(0).cast("bigint").alias("weight")), path)


def _nested(v: str = "v") -> Column:
    return F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)")


def json_outline(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Flatten JSON documents to (id, path, depth, type, value) rows, one per
    node, value as JSON text for scalars.

    One level of all documents is written to the shared work folder at a time
    and the next is unnested from its objects and arrays, until none is left:
    no ceiling on rows, and one on depth only where the JSON reader has one.
    A repeated key keeps its last value; text that is not JSON gives its root
    row with a null type."""
    spark = configure(df.sparkSession)
    base, depth = scratch_path(spark, "outline"), 0
    level = df.select(F.col(id_col).alias("id"), F.lit("$").alias("path"), F.try_parse_json(F.col(json_col)).alias("v"))
    while True:
        path = f"{base}/depth={depth}"
        level.write.parquet(path)
        inner = spark.read.parquet(path).where(_nested())
        if inner.isEmpty():
            break
        children = inner.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("id", F.col("path"), "pos", "key", F.col("value").alias("v"))
        step = (
            F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
            .when(F.col("key").rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(F.lit("."), "key"))
            .otherwise(F.concat(F.lit('."'), F.replace(F.col("key"), F.lit('"'), F.lit('\\"')), F.lit('"')))
        )
        level = children.select("id", F.concat("path", step).alias("path"), "v")
        depth += 1
    rows = spark.read.parquet(base)
    value = F.when(~(F.is_variant_null("v") | _nested()), F.to_json("v"))
    return rows.select(F.col("id").alias(id_col), "path", F.col("depth").cast("int"), F.schema_of_variant("v").alias("type"), value.alias("value"))
