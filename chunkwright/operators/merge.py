"""Merge chunk records to one record per file (section E).

Generators use the *_outer form plus a null filter so that Spark does not
infer and push down a `size(...) > 0` filter that re-parses the JSON.

Records are exploded to rows first (one row per section, one per map item),
so every merge step is a grouped aggregation that Spark partitions by file
and section; a file with very many chunks is spread over many tasks until
the last step, whose size is the size of the merged value itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkwright import params as P
from chunkwright.functions.jsontext import value_kind
from chunkwright.functions.text import is_none_like, py_strip, strip_in_json

FILE_KEY = "rel_path"
LINE_BREAKS = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"


def _dedup(m):
    return F.map_from_entries(F.map_entries(m))


def record_entries(records: DataFrame, carry=()) -> DataFrame:
    """Top-level entries of each chunk record, in record order.

    In: (rel_path, chunk_no, json_text, ...). Out: rel_path, chunk_no,
    sec_pos, section, kind (variant type name) and raw (string value, or
    the compact JSON text of any other value). Records that passed validation
    bring ``object_keys``: their other values are strings, so the record is
    not parsed a second time for the kinds."""
    raw = _dedup(F.from_json(F.col("json_text"), "map<string,string>"))
    known = "object_keys" in records.columns
    kinds = F.col("object_keys") if known else F.transform_values(
        _dedup(F.from_json(F.col("json_text"), "map<string,variant>")), lambda k, v: value_kind(v)
    )
    key = F.col("_e.key")
    kind = F.when(F.array_contains("_kinds", key), "OBJECT").otherwise("STRING") if known else F.try_element_at("_kinds", key)
    return (
        records.select(FILE_KEY, "chunk_no", *carry, raw.alias("_raw"), kinds.alias("_kinds"))
        .select(FILE_KEY, "chunk_no", *carry, "_kinds", F.posexplode_outer(F.map_entries("_raw")).alias("sec_pos", "_e"))
        .where(F.col("sec_pos").isNotNull())
        .select(
            FILE_KEY,
            "chunk_no",
            *carry,
            F.col("sec_pos").cast("bigint").alias("sec_pos"),
            key.alias("section"),
            kind.alias("kind"),
            F.col("_e.value").alias("raw"),
        )
    )


def map_items(entries: DataFrame, sections=P.MAP_SECTIONS, carry=()) -> DataFrame:
    """Items of object-valued sections, in item order, with item kind and
    value (a string is stripped; anything else stays compact JSON text, with
    the strings inside it stripped)."""
    objs = entries.where(F.col("section").isin(*sections) & F.col("kind").startswith("OBJECT"))
    raw = _dedup(F.from_json(F.col("raw"), "map<string,string>"))
    kinds = F.transform_values(_dedup(F.from_json(F.col("raw"), "map<string,variant>")), lambda k, v: value_kind(v))
    return (
        objs.select(FILE_KEY, "chunk_no", *carry, "section", kinds.alias("_kinds"), F.posexplode_outer(F.map_entries(raw)).alias("item_pos", "_e"))
        .where(F.col("item_pos").isNotNull())
        .select(
            FILE_KEY,
            "chunk_no",
            *carry,
            "section",
            F.col("item_pos").cast("bigint").alias("item_pos"),
            F.col("_e.key").alias("item"),
            F.try_element_at("_kinds", F.col("_e.key")).alias("item_kind"),
            F.col("_e.value").alias("item_raw"),
        )
        .withColumn("value", _item_value(F.col("item_kind"), F.col("item_raw")))
    )


def merge_text(entries: DataFrame) -> DataFrame:
    """Text sections: non-None-like stripped strings joined with ', ' in chunk
    order, split again at ', ', repeats dropped (first kept), trailing commas
    and spaces removed. Out: (rel_path, section, value)."""
    vals = (
        entries.where(F.col("section").isin(*P.TEXT_SECTIONS) & (F.col("kind") == "STRING"))
        .withColumn("v", py_strip(F.col("raw")))
        .where(~is_none_like(F.col("v")))
    )
    frags = vals.select(
        FILE_KEY, "section", "chunk_no", F.posexplode_outer(F.split(F.col("v"), P.TEXT_JOIN, -1)).alias("fpos", "frag")
    ).where(F.col("fpos").isNotNull())
    # First place of each fragment as one long (chunk_no * 2^31 + fpos; both
    # stay below 2^31 as a row is under 2 GB), so the de-duplication is a
    # hash aggregate rather than a sort-based one over structs.
    order = F.col("chunk_no") * F.lit(1 << 31) + F.col("fpos")
    firsts = frags.groupBy(FILE_KEY, "section", "frag").agg(F.min(order).alias("o"))
    joined = firsts.groupBy(FILE_KEY, "section").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "frag"))), lambda x: x["frag"]), P.TEXT_JOIN).alias("j")
    )
    return joined.select(FILE_KEY, "section", F.rtrim(F.col("j"), F.lit(P.TEXT_JOIN)).alias("value"))


def merge_maps(entries: DataFrame, sections=P.MAP_SECTIONS) -> DataFrame:
    """Map sections: per item the earliest chunk (then position) with a
    non-None-like value wins. Out: (rel_path, section, item, item_no, value);
    item_no is the item's place in the merged record."""
    items = map_items(entries, sections).where(~is_none_like(F.col("value")))
    won = items.groupBy(FILE_KEY, "section", "item").agg(
        F.min(F.struct("chunk_no", "item_pos")).alias("o"),
        F.min_by("value", F.struct("chunk_no", "item_pos")).alias("value"),
    )
    w = Window.partitionBy(FILE_KEY, "section").orderBy("o")
    return won.select(FILE_KEY, "section", "item", (F.row_number().over(w) - 1).cast("bigint").alias("item_no"), "value")


def _item_value(kind, raw):
    """A string item is stripped; anything else stays compact JSON text, with
    the strings inside it stripped."""
    return F.when(kind == "STRING", py_strip(raw)).otherwise(strip_in_json(F.coalesce(raw, F.lit("null"))))


def _items(raw):
    """(key, value as text, kind) of an object's items, in order."""
    text = F.map_entries(_dedup(F.from_json(raw, "map<string,string>")))
    kinds = F.transform_values(_dedup(F.from_json(raw, "map<string,variant>")), lambda k, v: value_kind(v))
    return F.transform(text, lambda e: F.struct(e["key"].alias("item"), e["value"].alias("raw"), F.try_element_at(kinds, e["key"]).alias("kind")))


def merge_skips(entries: DataFrame) -> DataFrame:
    """What the merge leaves out of many-chunk files: None-like map items,
    map sections that are not objects, and nested item values (kept as JSON
    text, reported here), in one pass. Entries must carry n_chunks."""
    multi = entries.where((F.col("n_chunks") != 1) & F.col("section").isin(*P.MAP_SECTIONS))

    def reasons(x):
        none_like = F.when(is_none_like(_item_value(x["kind"], x["raw"])), F.lit("none_like_item"))
        nested = F.when(x["kind"] != "STRING", F.lit("nested_value"))
        both = F.filter(F.array(none_like, nested), lambda r: r.isNotNull())
        return F.transform(both, lambda r: F.struct(x["item"].alias("item"), r.alias("reason")))

    whole = F.array(F.struct(F.lit(None).cast("string").alias("item"), F.lit("not_object").alias("reason")))
    skips = F.when(F.col("kind").startswith("OBJECT"), F.flatten(F.transform(_items(F.col("raw")), reasons))).otherwise(whole)
    return (
        multi.select(FILE_KEY, "chunk_no", "section", F.explode_outer(skips).alias("_s"))
        .where(F.col("_s").isNotNull())
        .select(FILE_KEY, "chunk_no", "section", "_s.item", "_s.reason")
    )


def nested_items(entries: DataFrame) -> DataFrame:
    """(rel_path) of many-chunk files with a map item that is not a string."""
    multi = entries.where(F.col("n_chunks") != 1)
    return map_items(multi).where(F.col("item_kind") != "STRING").select(FILE_KEY).distinct()


WHOLE = ""  # the section of an atom that holds a one-chunk file's record as written
ATOM = "array<struct<place: bigint, item: string, value: string>>"


def file_atoms(rows: DataFrame, map_sections=P.MAP_SECTIONS, whole: bool = False) -> DataFrame:
    """What a file's merged record is made of, from one pass over its chunk
    records: rows (rel_path, branch, section, is_text, item, place, value).

    rows: (rel_path, chunk_no, n_chunks, json_text, object_keys); a file
    without chunks has one row with chunk_no NULL. A file of exactly one chunk
    gives its entries as they came: a text as one atom with a value, an object
    as one atom an item. Any other file gives the fragments of its text
    sections (item = fragment) and the items of its map sections, stripped and
    None-like ones left out; of equal ones the first of all chunks stays. Its
    first row adds an atom without an item for each text section, so the
    section is there even if nothing merges into it. With whole, a one-chunk
    file also gives its record as an atom of section WHOLE."""
    single = F.col("n_chunks") == 1
    first = F.col("chunk_no").isNull() | (F.col("chunk_no") == 0)
    entry = "array<struct<section: string, object: boolean, raw: string>>"
    none = F.expr(f"cast(array() as {entry})")
    raw = F.map_entries(_dedup(F.from_json(F.col("json_text"), "map<string,string>")))
    entries = F.transform(raw, lambda e: F.struct(e["key"].alias("section"), F.array_contains("object_keys", e["key"]).alias("object"), e["value"].alias("raw")))
    extra = F.when(~single & first, F.array(*[F.struct(F.lit(s).alias("section"), F.lit(None).cast("boolean").alias("object"), F.lit(None).cast("string").alias("raw")) for s in P.TEXT_SECTIONS]))
    if whole:
        extra = extra.when(single, F.array(F.struct(F.lit(WHOLE).alias("section"), F.lit(None).cast("boolean").alias("object"), F.col("json_text").alias("raw"))))
    opened = (
        rows.where(F.col("n_chunks").isNotNull())
        .select(FILE_KEY, "chunk_no", single.alias("single"), F.explode_outer(F.concat(F.coalesce(entries, none), F.coalesce(extra, none))).alias("_e"))
        .where(F.col("_e").isNotNull())
        .select(FILE_KEY, "single", (F.coalesce("chunk_no", F.lit(0)) * F.lit(1 << 31)).alias("base"), "_e.section", "_e.object", "_e.raw")
    )
    base = F.col("base")

    def atom(place, item, value):
        return F.struct(place.cast("bigint").alias("place"), item.cast("string").alias("item"), value.cast("string").alias("value"))

    null, text = F.lit(None), py_strip(F.col("raw"))
    lone = F.array(atom(F.lit((1 << 62)), null, F.col("raw")))  # a whole text, a record, or a section's own place
    kept = F.transform(F.map_entries(_dedup(F.from_json(F.col("raw"), "map<string,string>"))), lambda e, i: atom(i, e["key"], e["value"]))
    fragments = F.transform(F.split(text, P.TEXT_JOIN, -1), lambda x, i: atom(base + i, x, null))
    merged = F.transform(_items(F.col("raw")), lambda e, i: atom(base + i, e["item"], _item_value(e["kind"], e["raw"])))
    is_map = F.col("section").isin(*map_sections) & F.col("object")
    is_text = F.col("section").isin(*P.TEXT_SECTIONS) & ~F.col("object")
    atoms = (
        F.when(F.col("object").isNull() | (F.col("single") & ~F.col("object")), lone)
        .when(F.col("single"), kept)
        .when(is_text & ~is_none_like(text), fragments)
        .when(is_map, F.filter(merged, lambda a: ~is_none_like(a["value"])))
    )
    rows = (
        opened.select(FILE_KEY, F.when(F.col("single"), "single").otherwise("merged").alias("branch"), "section",
                      (~F.coalesce("object", F.lit(False))).alias("is_text"), F.explode_outer(atoms.cast(ATOM)).alias("_a"))
        .where(F.col("_a").isNotNull())
        .select(FILE_KEY, "branch", "section", "is_text", "_a.item", "_a.place", "_a.value")
    )
    return rows.groupBy(FILE_KEY, "branch", "section", "is_text", "item").agg(
        F.min("place").alias("place"), F.min_by("value", "place").alias("value"))


def _in_place(when=None):
    a = F.struct("place", "item", "value")
    return F.array_sort(F.collect_list(a if when is None else F.when(when, a)))


def _joined(atoms):
    """The text of a section: a one-chunk file's as it is, else the fragments
    joined (an atom without item or value adds nothing)."""
    own = F.get(F.filter(atoms, lambda a: a["item"].isNull() & a["value"].isNotNull()), 0)["value"]
    return F.coalesce(own, F.rtrim(F.array_join(F.transform(atoms, lambda a: a["item"]), P.TEXT_JOIN), F.lit(P.TEXT_JOIN)))


def merged_sections(keep_all_sections: bool):
    return P.MAP_SECTIONS + (("ETL Processes", "Variables") if keep_all_sections else ())


def long_summaries(rows: DataFrame, keep_all_sections: bool = False) -> DataFrame:
    """One record per file as long rows (rel_path, section, item, item_no,
    value, branch); see file_atoms for `rows`. A file of exactly one chunk
    keeps that record as it came (all its keys, values unstripped); any other
    file, including an empty one, gets the ten-section merge with every text
    section present. With keep_all_sections, ETL Processes and Variables are
    merged too, item by item like the map sections."""
    g = file_atoms(rows, merged_sections(keep_all_sections)).groupBy(FILE_KEY, "branch", "section", "is_text").agg(_in_place().alias("_a"))
    row = "array<struct<item: string, item_no: bigint, value: string>>"
    text = F.array(F.struct(F.lit(None).alias("item"), F.lit(None).alias("item_no"), _joined(F.col("_a")).alias("value"))).cast(row)
    items = F.transform("_a", lambda a, i: F.struct(a["item"].alias("item"), i.cast("bigint").alias("item_no"), a["value"].alias("value"))).cast(row)
    return (
        g.select(FILE_KEY, "section", "branch", F.explode_outer(F.when(F.col("is_text"), text).otherwise(items)).alias("_r"))
        .select(FILE_KEY, "section", "_r.item", "_r.item_no", "_r.value", "branch")
    )


def file_summaries(files: DataFrame, records: DataFrame, keep_all_sections: bool = False) -> DataFrame:
    """long_summaries from files (rel_path, n_chunks) and validated records
    (rel_path, chunk_no, n_chunks, json_text, and object_keys if known)."""
    if "object_keys" not in records.columns:
        kinds = F.transform_values(_dedup(F.from_json(F.col("json_text"), "map<string,variant>")), lambda k, v: value_kind(v))
        records = records.withColumn("object_keys", F.map_keys(F.map_filter(kinds, lambda k, v: v.startswith("OBJECT"))))
    cols = [FILE_KEY, "chunk_no", "n_chunks", "json_text", "object_keys"]
    own = files.where(F.col("n_chunks") != 1).select(
        FILE_KEY, F.lit(None).cast("bigint").alias("chunk_no"), "n_chunks", F.lit(None).cast("string").alias("json_text"),
        F.lit(None).cast("array<string>").alias("object_keys"))
    return long_summaries(records.select(*cols).unionByName(own), keep_all_sections)


def wide_summaries(rows: DataFrame, sections=P.MERGED_SECTIONS, keep_all_sections: bool = False, whole: bool = False) -> DataFrame:
    """One row per file, straight from its atoms (see file_atoms): branch,
    text sections as strings ('' when absent), map sections as
    MAP<STRING,STRING> in record order; with whole, the record of a one-chunk
    file as written. A one-chunk record may hold text in a map section (or an
    object in a text section): it has no place there and shows as empty."""
    maps = merged_sections(True)
    aggs = [
        F.map_from_entries(F.transform(_in_place((F.col("section") == s) & ~F.col("is_text")), lambda a: F.struct(a["item"], a["value"]))).alias(s)
        if s in maps else _joined(_in_place((F.col("section") == s) & F.col("is_text"))).alias(s)
        for s in sections
    ]
    if whole:
        aggs.append(F.max(F.when(F.col("section") == WHOLE, F.col("value"))).alias("whole"))
    return file_atoms(rows, merged_sections(keep_all_sections), whole).groupBy(FILE_KEY).agg(F.max("branch").alias("branch"), *aggs)


def split_lines(col):
    """Python str.splitlines(): no final empty line after a trailing break,
    no line at all for an empty string."""
    parts = F.split(col, LINE_BREAKS, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def stitch_lines(answers: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """Split every answer into lines and join all lines of a group with '\\n'.
    Out: (key, n_lines, stitched)."""
    per = answers.select(key, F.col(order).alias("o"), split_lines(F.col(text)).alias("lines"))
    g = per.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("o", "lines"))).alias("l"))
    flat = F.flatten(F.transform(F.col("l"), lambda x: x["lines"]))
    return g.select(key, F.size(flat).cast("bigint").alias("n_lines"), F.array_join(flat, "\n").alias("stitched"))
