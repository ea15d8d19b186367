"""Operator 4: n-gram Jaccard join over a count-vector R-tree.

Documents link when 100 * overlap >= ``PERCENT`` * union of their sets of
distinct 5-word shingles (64-bit hashes of lower-cased words). No link is lost:

1. A Spark round marks shingles found in two or more documents (``repeats``).
   A set can only link if that share of its shingles is marked; the others are
   done. Of the sets that go on only the marked shingles are kept, as no other
   can be in an overlap.
2. Equal sets are one class; one row of each class goes on.
3. Prefix keys part the work: with tokens in one global order, unmarked before
   marked and then by hash, linked sets share a token among the first
   n - ceil(n * PERCENT / 100) + 1 of each. Unmarked ones are shared by none.
   Of keys held by the same sets (told by a 128-bit hash of them) one stays,
   so a passage that a few sets share is one key instead of hundreds.
4. Candidates come from count-vector R-trees (``counttree``), which bound the
   overlap by summed coordinate minima. First one leader of each key searches
   the trees of the sets it shares keys with, and links are joined to
   components: a big group of near copies falls into one component without
   its pairs ever being listed.
5. What is left are keys whose sets lie in different components. There every
   set searches: a key's sets are streamed in order of size through trees,
   sets too small for all that follow leave memory. Only pairs of different
   components come out.
6. Surviving pairs are verified on the sets; components are joined again.

The R-tree alone can't part the work: boxes of unrelated points of one size
bound nearly everything, so a tree over all points compares all pairs. That is
why it runs inside the keys of step 3.

Edge cases: a null or empty text and one without words has the empty set and
links with nothing; with fewer than five words the whole sequence is the one
shingle; rows of one id are separate rows and each may link; a null id is
never the smallest id of a component with another; a text is handled whole;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.common import fresh, join_groups, stage, stage_by, text_or_empty
from chunkwright.llm.counttree import FINE, FINE_SIZE, GROUPS, CountTree, needed
from chunkwright.llm.graph import components
from chunkwright.llm.repeats import is_repeated, map_bits, repeat_bitmap
from chunkwright.llm.words import BASE, Words, doc_windows, mix64, word_groups

WIDTH, PERCENT = 5, 75
SHINGLES_A_ROW = 512  # about; sizes the bit map only
STARS = 1
LEAF_ROWS = 2048  # points packed into one tree
SET = ["s1", "s2", "n"]


def shingle_sets(w: Words, n: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of n texts, sorted."""
    at, h = doc_windows(w, width)
    doc = w.doc[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < width))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            more = w.counts[short] > k
            whole[more] = mix64(whole[more] * np.uint64(BASE) + w.hash[w.first[short[more]] + k] + np.uint64(k + 7))
        doc, h = np.concatenate((doc, short)), np.concatenate((h, whole))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def _all_shingles(batch):
    for a, b, w in word_groups(batch.column("text"), lower=True):
        yield shingle_sets(w, b - a)[1]


def _by_text(values: np.ndarray, first: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Wrapping sums of values over each text's range (0 for empty ones)."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return sums[first[1:]] - sums[first[:-1]]


def document_sets(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """rows (node, doc_id, text, ...) -> the columns without text, n and the
    set's hashes s1, s2; for sets that may link their marked tokens (sorted,
    packed 64-bit), else null."""
    spark = rows.sparkSession
    bits = map_bits(rows.count() * SHINGLES_A_ROW)
    shared = spark.sparkContext.broadcast(repeat_bitmap(rows.select("text"), _all_shingles, bits))
    names = [c for c in rows.columns if c != "text"]

    def run(batches):
        bitmap = shared.value
        for batch in batches:
            for a, b, w in word_groups(batch.column("text"), lower=True):
                n = b - a
                doc, h = shingle_sets(w, n)
                first = np.searchsorted(doc, np.arange(n + 1))
                size = np.diff(first)
                marked = is_repeated(bitmap, h, bits)
                hits = np.bincount(doc[marked], minlength=n)
                least = -(-percent * size // 100)
                able = (size > 0) & (hits >= least)
                tokens = [None] * n
                for i in np.flatnonzero(able):
                    at = slice(first[i], first[i + 1])
                    tokens[i] = h[at][marked[at]].tobytes()
                out = {c: batch.column(c).slice(a, n) for c in names}
                out |= {"n": pa.array(size, pa.int64()), "s1": pa.array(_by_text(mix64(h), first, size).view(np.int64)), "s2": pa.array(_by_text(mix64(h ^ np.uint64(BASE)), first, size).view(np.int64))}
                yield pa.RecordBatch.from_pydict(out | {"tokens": pa.array(tokens, pa.binary())})

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, f"{kinds}, n long, s1 long, s2 long, tokens binary")


def prefix_keys(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, n, shared, key): the keys of each set are its first marked
    tokens, shared of them: as many as it may have beyond the least overlap,
    and one."""

    def run(batches):
        for batch in batches:
            n, own = batch.column("n").to_numpy(), [np.frombuffer(t.as_buffer(), np.int64) for t in batch.column("tokens")]
            shared = np.array([len(t) for t in own], np.int64) + percent * -n // 100 + 1
            out = [np.repeat(c, shared) for c in (batch.column("node").to_numpy(), n, shared)]
            out.append(np.concatenate([t[:k] for t, k in zip(own, shared)] or [shared]))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["node", "n", "shared", "key"])

    return sets.select("node", "n", "tokens").mapInArrow(run, "node long, n long, shared long, key long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the percentage."""
    left, right = (sets.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("tokens").alias(f"t{c}")) for c in "ab")

    def run(batches):
        for batch in batches:
            keep = []
            sizes = needed(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), percent)
            for ta, tb, least in zip(batch.column("ta"), batch.column("tb"), sizes):
                x, y = np.frombuffer(ta.as_buffer(), np.uint64), np.frombuffer(tb.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                keep.append((y[at] == x).sum() >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(right, "b").join(left, "a").select("a", "b", "na", "nb", "ta", "tb").mapInArrow(run, "a long, b long")


def tree_hits(tree: CountTree, sizes: np.ndarray, fine: list[np.ndarray], n: int, own: np.ndarray, percent: int) -> np.ndarray:
    """The points of the tree (with these sizes and counts) whose bound allows
    a link with a set of size n and counts own."""
    hit = tree.search(_coarse(own), n, percent)
    if n >= FINE_SIZE and len(hit):  # the same bound over more groups
        bound = np.array([np.minimum(fine[j], own).sum() if sizes[j] >= FINE_SIZE else sizes[j] for j in hit])
        hit = hit[bound >= needed(sizes[hit], n, percent)]
    return hit


def star_pairs(pairs: DataFrame, vectors: DataFrame, percent: int = PERCENT) -> DataFrame:
    """pairs (lead, node, lead_n, n) -> distinct pairs (a, b) of nodes whose
    count vectors allow a link: each leader searches the trees of the sets it
    meets. A leader's sets need not lie in one task, each batch has its tree."""

    def run(batches):
        for batch in batches:
            lead, node, lead_n, n = (batch.column(c).to_numpy() for c in ("lead", "node", "lead_n", "n"))
            counts, own = (batch.column(c).to_pylist() for c in ("counts", "lead_counts"))
            order = np.argsort(lead, kind="stable")
            a, b = [], []
            for rows in np.split(order, np.flatnonzero(np.diff(lead[order])) + 1) if len(order) else []:
                fine = [_unpacked(counts[i], n[i]) for i in rows]
                tree = CountTree(np.stack([_coarse(c) for c in fine]), n[rows])
                hit = rows[tree_hits(tree, n[rows], fine, int(lead_n[rows[0]]), _unpacked(own[rows[0]], lead_n[rows[0]]), percent)]
                a.append(np.minimum(lead[hit], node[hit]))
                b.append(np.maximum(lead[hit], node[hit]))
            if a:
                yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate(a), pa.int64()), "b": pa.array(np.concatenate(b), pa.int64())})

    leads = vectors.select(F.col("node").alias("lead"), F.col("counts").alias("lead_counts"))
    met = pairs.join(vectors, "node").join(leads, "lead").select("lead", "node", "lead_n", "n", "counts", "lead_counts")
    return met.mapInArrow(run, "a long, b long").distinct()


def tree_pairs(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """rows (key, n, node, root, counts) -> distinct pairs (a, b) of nodes of
    one key but different roots whose count vectors allow a link."""

    def run(batches):
        key, trees, chunk = None, [], []

        def flush():
            """Packs the chunk into a tree after searching what came before."""
            if not chunk:
                return None
            n, node, root = (np.array([c[i] for c in chunk]) for i in range(3))
            fine = [_unpacked(c[3], c[0]) for c in chunk]
            counts = np.stack([_coarse(c) for c in fine])
            while trees and trees[0][1].max() * 100 < percent * n[0]:
                trees.pop(0)  # too small for everything to come
            trees.append((CountTree(counts, n), n, node, root, fine))
            a, b = [], []
            for tree, size, other, its_root, its_fine in trees:
                for i in range(len(n)):
                    hit = tree_hits(tree, size, its_fine, int(n[i]), fine[i], percent)
                    hit = hit[its_root[hit] != root[i]]
                    a.append(np.minimum(other[hit], node[i]))
                    b.append(np.maximum(other[hit], node[i]))
            chunk.clear()
            found = np.unique(np.stack((np.concatenate(a), np.concatenate(b)), 1), axis=0)
            return pa.RecordBatch.from_pydict({"a": pa.array(found[:, 0], pa.int64()), "b": pa.array(found[:, 1], pa.int64())})

        for batch in batches:
            for k, n, node, root, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key or len(chunk) >= LEAF_ROWS:
                    if out := flush():
                        yield out
                    if k != key:
                        key = k
                        trees.clear()
                chunk.append((n, node, root, counts))
        if out := flush():
            yield out

    sorted_rows = rows.select("key", "n", "node", "root", "counts").repartition("key").sortWithinPartitions("key", "n", "node")
    return sorted_rows.mapInArrow(run, "a long, b long").distinct()


def count_vectors(sets: DataFrame) -> DataFrame:
    """(node, counts): marked tokens by group, packed in one, two or four bytes.
    Sets of FINE_SIZE shingles or more have FINE groups, of which FINE / GROUPS
    neighbours make up one group of the others."""

    def run(batches):
        for batch in batches:
            packed = []
            for t, n in zip(batch.column("tokens"), batch.column("n").to_pylist()):
                h = np.frombuffer(t.as_buffer(), np.uint64)
                groups = FINE if n >= FINE_SIZE else GROUPS
                c = np.bincount((mix64(h) >> np.uint64(64 - FINE.bit_length() + 1)).astype(np.int64), minlength=FINE).reshape(groups, -1).sum(1)
                packed.append(c.astype(_count_type(int(c.max()))).tobytes())
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "counts": pa.array(packed, pa.binary())})

    return sets.select("node", "n", "tokens").mapInArrow(run, "node long, counts binary")


def _count_type(top: int) -> str:
    return "<u4" if top > 65535 else "<u2" if top > 255 else "u1"


def _unpacked(counts: bytes, n: int) -> np.ndarray:
    groups = FINE if n >= FINE_SIZE else GROUPS
    return np.frombuffer(counts, f"<u{len(counts) // groups}").astype(np.int32)


def _coarse(counts: np.ndarray) -> np.ndarray:
    return counts.reshape(GROUPS, -1).sum(1, dtype=np.int32)


def linked_components(sets: DataFrame, percent: int = PERCENT, stars: int = STARS) -> DataFrame:
    """(node, root) of all nodes with a link. sets: node, n, tokens."""
    keys = prefix_keys(sets, percent)
    members = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"m{i}") for i in range(2)]
    many = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), *members).where("size > 1")
    many = many.groupBy("size", "m0", "m1").agg(F.min("key").alias("key"))  # keys of the same nodes give the same pairs
    keys = stage(keys.join(many.select("key"), "key", "left_semi"), "keys")
    vectors = stage_by(count_vectors(sets), "node", "vectors")
    total, roots, links = keys.count(), None, None

    def with_roots() -> DataFrame:
        if roots is None:
            return keys.withColumn("root", F.col("node"))
        return keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def mixed() -> DataFrame:
        """The rows of keys whose nodes lie in several components."""
        rows = stage(with_roots(), "rooted")
        groups = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size")).where("low <> high")
        return rows, groups

    def link(pairs: DataFrame) -> None:
        nonlocal roots, links
        new = stage(verified(pairs, sets, percent), "links")
        links = new if links is None else links.unionByName(new)
        roots = components(links)

    for r in range(stars):
        rows, groups = mixed()
        # first the set with most shared tokens, as an original has all of its copies' tokens; then any
        first = F.struct((-F.col("shared")).cast("long"), "node") if r == 0 else F.struct(F.xxhash64(F.lit(r), "root"), "node")
        lead = rows.groupBy("key").agg(F.min_by(F.struct("node", "n", "root"), first).alias("lead"))
        lead = groups.select("key", "size").join(lead, "key")
        met = join_groups(rows, lead, ["key"], "size", total).where("root <> lead.root")
        met = met.where((100 * F.least("n", "lead.n") >= percent * F.greatest("n", "lead.n")))
        met = met.select(F.col("lead.node").alias("lead"), "node", F.col("lead.n").alias("lead_n"), "n").distinct()
        link(stage(star_pairs(met, vectors, percent), "pairs"))
    rows, groups = mixed()
    rest = join_groups(rows, groups.select("key", "size"), ["key"], "size", total).drop("size")
    link(stage(tree_pairs(rest.join(vectors, "node"), percent), "pairs"))
    return roots


def _classed(docs: DataFrame, id_col: str, text: str, percent: int) -> DataFrame:
    """The columns of ``near_classes`` and root, which names the row's component."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("node"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text)).alias("text_hash"), F.col(text).alias("text"),
    )
    sets = stage(document_sets(rows, percent), "sets")
    able = sets.where(F.col("tokens").isNotNull())
    classes = stage(able.groupBy(*SET).agg(F.count(F.lit(1)).alias("class_size"), F.min("node").alias("rep"), F.min("doc_id").alias("least")), "classes")
    reps = stage_by(able.join(classes.select(F.col("rep").alias("node")), "node", "left_semi").select("node", "n", "tokens"), "node", "reps")
    roots = linked_components(reps, percent)
    rooted = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    rooted = stage(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size"))
    named = join_groups(rooted, least, ["root"], "size", rooted.count()).select(*SET, "class_size", "component_id", "root")
    members = able.select("doc_id", "text_hash", *SET)
    found = join_groups(members, named, SET, "class_size", sets.count())
    alone = sets.where(F.col("tokens").isNull())
    alone = alone.select("doc_id", "text_hash", "n", F.lit(1).cast("long").alias("class_size"), F.col("doc_id").alias("component_id"), F.col("node").alias("root"))
    out = found.select("doc_id", "text_hash", "n", "class_size", "component_id", "root").unionByName(alone)
    return out.withColumnRenamed("n", "n_shingles")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, text_hash, n_shingles, class_size
    (rows with the same set), component_id (smallest id of the component)."""
    return _classed(docs, id_col, text, percent).drop("root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """docs with one document of each component, that of the smallest id (a
    null id comes last) and then of the smallest text hash. Rows equal in id
    and text are one document."""
    (h,) = fresh(docs, "_text_hash")
    rows = stage(_classed(docs, id_col, text, percent).select("doc_id", "text_hash", "root"), "members")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    groups = rows.groupBy("root").agg(F.min(key).alias("stays"), F.count(F.lit(1)).alias("size")).where("size > 1")
    others = ~(F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("text_hash") == F.col("stays.text_hash")))
    gone = join_groups(rows, groups, ["root"], "size", rows.count()).where(others).select(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash")).distinct()
    hashed = docs.withColumn(h, F.xxhash64(text_or_empty(text)))
    same = hashed[id_col].cast("long").eqNullSafe(gone["_gone_id"]) & (hashed[h] == gone["_gone_hash"])
    return hashed.join(gone, same, "left_anti").select(*docs.columns)


def near_digest(docs: DataFrame) -> DataFrame:
    return near_classes(docs).select("doc_id", "n_shingles", "component_id")


ORACLE = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i+4], ' ')) AS sh FROM d, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY node) LEFT JOIN n USING (doc_id)
"""
