"""Merkle manifest of a table: leaves, 16-ary trees per source, one root, and a proof per row.

Leaves are numbered within their source by a distributed sort. An aligned block
of 16^2 neighbours is one row: its level is one binary string of hex digests, 64
characters each. Sixteen nodes are then a fixed-width substring of 1024
characters, whose digest is the parent, and the next level is the parents
joined. A node's siblings are what its run has to the left and to the right of
it. A block's top is a node of the next round, so the same step recurses until a
source has one node; the subroots, in order of source, go through it again.

No round gathers a source: rows move as blocks, and the part of a proof above a
block is the same for all its leaves and joined to the block, not to the leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespark.llm.common import write_stage
from carespark.operators.ordered import global_row_number, grouped_row_number

ARITY = 16
ROUND_LEVELS = 2                   # levels of the tree that one round settles
BLOCK = ARITY ** ROUND_LEVELS
HEX = 64                           # characters of a digest
TAMPER_EVERY = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that joined values can't be read two ways; ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    return F.sha2(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256)


def depth_of(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves: the hexadecimal digits of n - 1."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.hex(n - 1))).cast("int")


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "").cast("binary")


def _run(level: Column, i: Column) -> Column:
    """The nodes among which node ``i`` (from 0) of a level has its siblings."""
    return F.substring(level, (F.floor(i / ARITY) * (ARITY * HEX) + 1).cast("int"), F.lit(ARITY * HEX))


def parents(level: Column) -> Column:
    """The next level: the digest of each run of sixteen nodes, the last one maybe shorter."""
    runs = F.ceil(F.octet_length(level) / (ARITY * HEX))
    return _joined(F.transform(F.sequence(F.lit(0).cast("long"), runs - 1), lambda r: F.sha2(_run(level, r * ARITY), 256)))


def segment(level: Column, i: Column) -> Column:
    """Node ``i``'s siblings: what its run has to the left and to the right."""
    run, at = _run(level, i), ((i % ARITY) * HEX).cast("int")
    return F.struct(F.substring(run, F.lit(1), at).alias("left"), F.substring(run, at + HEX + 1, F.lit(ARITY * HEX)).alias("right"))


SEGMENTS = "array<struct<left:binary,right:binary>>"


def blocks_of(nodes: DataFrame, payload: Column) -> DataFrame:
    """(key, block, n, rows, level0, level1, steps, top): the aligned blocks of (key, place from 0, n, h).

    ``rows`` has a struct (place, h, payload) for each node in order, BLOCK at most; ``steps`` is
    how many levels the block climbs: less than a round's only where it is the whole tree."""
    grouped = nodes.groupBy("key", "n", F.floor(F.col("place") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "h", payload.alias("payload")))).alias("rows"))
    grouped = grouped.withColumn("level0", _joined(F.col("rows.h")))
    grouped = grouped.withColumn("level1", parents(F.col("level0")))
    steps = F.least(depth_of(F.col("n")), F.lit(ROUND_LEVELS))
    level = F.when(steps == 0, F.col("level0")).when(steps == 1, F.col("level1")).otherwise(parents(F.col("level1")))
    return write_stage(grouped.withColumn("steps", steps).withColumn("top", level.cast("string")), "blocks")


def inner_segments(i: Column) -> Column:
    """Siblings of the block's node ``i`` on the levels that the block climbs."""
    both = F.array(segment(F.col("level0"), i), segment(F.col("level1"), F.floor(i / ARITY)))
    return F.slice(both, F.lit(1), F.col("steps")).cast(SEGMENTS)


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From nodes (key, place, n, h): (key, place, segments) of each node up to its tree's root, and (key, root)."""
    blocks = blocks_of(nodes, F.lit(0))
    upper, roots = _above(blocks)
    placed = _with_upper(blocks, upper)
    rows = F.transform("rows", lambda r, i: F.struct(
        r["place"].alias("place"), F.concat(inner_segments(i), F.col("upper")).alias("segments")))
    return placed.select("key", F.inline(rows)), roots


def _above(blocks: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """The trees above the blocks: paths of blocks (None where every tree is one block) and roots."""
    one = blocks.where(F.col("n") <= BLOCK).select("key", F.col("top").alias("root"))
    more = blocks.where(F.col("n") > BLOCK)
    if more.isEmpty():
        return None, one
    paths, roots = climb(more.select("key", F.col("block").alias("place"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("h")))
    return paths, one.unionByName(roots)


def _with_upper(blocks: DataFrame, upper: DataFrame | None) -> DataFrame:
    none = F.array().cast(SEGMENTS)
    if upper is None:
        return blocks.withColumn("upper", none)
    paths = upper.select(F.col("key").alias("_key"), F.col("place").alias("_block"), F.col("segments").alias("_upper"))
    on = F.col("key").eqNullSafe(F.col("_key")) & (F.col("block") == F.col("_block"))
    return blocks.join(paths, on, "left").withColumn("upper", F.coalesce("_upper", none)).drop("_key", "_block", "_upper")


def fold(leaf: Column, segments: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(segments, leaf, lambda h, s: F.sha2(F.concat(s["left"], h.cast("binary"), s["right"]), 256))


def proof_text(segments: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.aggregate(segments, F.lit("").cast("binary"), lambda t, s: F.concat(t, s["left"], s["right"]))


def manifest(docs: DataFrame, tamper_every: int = TAMPER_EVERY) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row.

    ``tamper_every``: rows whose crc32 of the decimal doc_id it divides are folded from the leaf of
    their text with A-Z lower-cased, as a change that the proof must show; others from their own.
    A null field is written ``-``; rows of a null source are a tree of their own, the first; a null
    doc_id comes first in its source; rows that share a doc_id are ordered by their leaves;
    repeated rows are a leaf each; further columns are not read; an empty table gives no rows."""
    text = F.col("text").cast("string")
    touched = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % tamper_every == 0
    leaves = docs.select(
        F.col("source").cast("string").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of(text).alias("h"),
        F.when(touched & text.rlike("[A-Z]"), leaf_of(F.translate(text, UPPER, LOWER))).alias("changed"))
    # the range sort samples its input first: texts are read once
    leaves = grouped_row_number(write_stage(leaves, "leaves"), ["key"], ["doc_id", "h"], out="place", count_col="n").withColumn("place", F.col("place") - 1)
    blocks = blocks_of(leaves, F.struct("doc_id", "changed"))
    upper, subroots = _above(blocks)
    subroots = write_stage(subroots, "subroots")

    ordered, n_sources = global_row_number(subroots, ["key"], out="place", with_count=True)
    ordered = ordered.withColumn("place", F.col("place") - 1)
    tops, roots = climb(ordered.select(F.lit(0).alias("key"), "place", F.lit(n_sources).cast("long").alias("n"), F.col("root").alias("h")))
    whole = F.broadcast(roots.select("key", F.col("root").alias("whole")))   # one row: the table's root
    tops = ordered.select("place", F.col("key").alias("_source"), F.col("root").alias("subroot")) \
        .join(tops.join(whole, "key").select("place", F.col("whole").alias("root"), F.col("segments").alias("_top")), "place").drop("place")

    # light rows meet by source, heavy ones only by source and block
    light = _with_upper(blocks.select("key", "block"), upper)
    light = light.join(tops, F.col("key").eqNullSafe(F.col("_source"))).select(
        F.col("key").alias("_key"), F.col("block").alias("_block"), "subroot", "root", F.concat("upper", "_top").alias("above"))
    blocks = blocks.join(light, F.col("key").eqNullSafe(F.col("_key")) & (F.col("block") == F.col("_block")))
    found = F.transform("rows", lambda r, i: F.struct(r.alias("r"), F.concat(inner_segments(i), F.col("above")).alias("s")))
    rows = F.transform(found, lambda x: F.struct(
        x["r"]["payload"]["doc_id"].alias("doc_id"), x["r"]["h"].alias("leaf"), F.sha2(proof_text(x["s"]), 256).alias("proof_sha256"),
        fold(F.coalesce(x["r"]["payload"]["changed"], x["r"]["h"]), x["s"]).alias("folded_root")))
    return blocks.select("subroot", "root", F.inline(rows)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
