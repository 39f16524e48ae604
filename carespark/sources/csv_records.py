"""CSV records of files whose quoted fields may hold line breaks, found in parallel (SRC-01, SRC-07).

A line break ends a record only outside quotes, and whether a line starts inside quotes depends
on all quotes before it in its file. Instead of reading a file as a whole, each block (a file
split; all of a compressed file, which cannot be split) is counted on its own: its number of quotes is even or odd. A running sum over a file's
blocks, a small table, gives the state in which each block starts. A block that starts outside
quotes and whose lines all have an even number holds a record a line and is done; only the
lines of other blocks are put in order, block by block, and joined to records. A record that
runs over a block's end finds its start in the table of the blocks' last record starts.

A quote in a field counts even in an unquoted one, so a stray one joins the lines after it up to
the next; a record of more than ``max_lines`` lines is given back line by line as not well formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carespark.session import stable_table

MAX_LINES = 100_000
_FILE, _BLOCK, _AT, _LINE, _ODD = "_file", "_block", "_at", "_line", "_odd"


def file_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their file, block and order in it, and whether their number of quotes is odd."""
    line = F.regexp_replace("value", "\r$", "")
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias(_BLOCK), F.monotonically_increasing_id().alias(_AT), line.alias(_LINE),
        ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).cast("int").alias(_ODD))


def records(spark: SparkSession, paths: list[str], max_lines: int = MAX_LINES) -> DataFrame:
    """(file_name, record, well_formed) of all records but the files' first ones, the headers, and
    blank ones. Line breaks within a record are ``\\n``."""
    lines = file_lines(spark, paths)
    in_file = Window.partitionBy(_FILE).orderBy(_BLOCK)
    blocks = lines.groupBy(_FILE, _BLOCK).agg(
        (F.sum(_ODD) % 2).alias("_parity"), F.max(_ODD).alias("_any"), F.min(_AT).alias("_first"))
    blocks = blocks.withColumn("_starts", F.coalesce(F.sum("_parity").over(in_file.rowsBetween(Window.unboundedPreceding, -1)) % 2, F.lit(0)))
    # a row per block; its header is the first line of the block at 0
    blocks = stable_table(blocks.withColumn("_first", F.when(F.col(_BLOCK) == 0, F.col("_first"))), "csv-blocks")
    whole = (F.col("_starts") == 0) & (F.col("_any") == 0)
    simple = lines.join(blocks.where(whole), [_FILE, _BLOCK]).where(~F.col(_AT).eqNullSafe(F.col("_first"))).select(
        "file_name", F.col(_LINE).alias("record"), F.lit(True).alias("well_formed"))
    mixed = blocks.where(~whole)
    out = simple if mixed.isEmpty() else simple.unionByName(_joined(lines.join(mixed, [_FILE, _BLOCK]), max_lines))
    return out.where(F.trim("record") != "")


def _joined(lines: DataFrame, max_lines: int) -> DataFrame:
    in_block = Window.partitionBy(_FILE, _BLOCK).orderBy(_AT)      # a block is a file split: of bounded size
    inside = (F.col("_starts") + F.coalesce(F.sum(_ODD).over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) % 2
    place = F.struct(F.col(_BLOCK).alias("block"), F.col(_AT).alias("at"))
    lines = lines.withColumn("_start", F.when(inside == 0, place))
    lines = lines.withColumn("_record", F.last("_start", ignorenulls=True).over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
    # lines of one record in one block are joined where they lie: no exchange but the windows'. Chunks bound a piece.
    lines = lines.withColumn("_chunk", F.floor((F.row_number().over(in_block) - 1) / max_lines)) \
        .withColumn("_last", F.max("_record").over(Window.partitionBy(_FILE, _BLOCK)))
    text = F.array_join(F.sort_array(F.collect_list(F.struct(_AT, _LINE)))[_LINE], "\n")
    pieces = lines.groupBy(_FILE, _BLOCK, "_record", "_chunk").agg(
        F.first("file_name").alias("file_name"), F.max("_first").alias("_first"), F.max("_last").alias("_last"),
        F.min(_AT).alias(_AT), F.count(F.lit(1)).alias("_n"), text.alias("_text"))
    alone = F.count(F.lit(1)).over(Window.partitionBy(_FILE, _BLOCK, "_record")) == 1
    # a block's last record may go on in the next block, and its first lines may belong to one before
    closed = F.col("_record").isNotNull() & ~F.col("_record").eqNullSafe(F.col("_last")) & F.col("_alone")
    pieces = stable_table(pieces.withColumn("_alone", alone).withColumn("_closed", closed).drop("_alone", "_last"), "csv-pieces")
    whole = pieces.where(F.col("_closed") & ~F.col("_record.at").eqNullSafe(F.col("_first"))).select(
        "file_name", F.col("_text").alias("record"), F.lit(True).alias("well_formed"))
    pieces = pieces.where(~F.col("_closed"))
    # lines before a block's first start go on with the last record of the blocks before it
    in_file = Window.partitionBy(_FILE).orderBy(_BLOCK)
    carry = pieces.groupBy(_FILE, _BLOCK).agg(F.max("_record").alias("_last")).select(
        _FILE, _BLOCK, F.last("_last", ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    pieces = pieces.join(carry, [_FILE, _BLOCK]).withColumn("_record", F.coalesce("_record", "_carried"))
    head = F.col("_record.block").eqNullSafe(F.lit(0).cast("long")) & F.col("_record.at").eqNullSafe(F.col("_header"))
    header = pieces.groupBy(_FILE).agg(F.max("_first").alias("_header"))
    sizes = pieces.groupBy(_FILE, "_record").agg(F.sum("_n").alias("_n")).join(header, _FILE)
    kept = sizes.where(~F.coalesce(head, F.lit(False)))
    same = ["_same_file", "_same_record"]

    def of(which):
        w = which.select(F.col(_FILE).alias(same[0]), F.col("_record").alias(same[1]))
        return pieces.join(w, (F.col(_FILE) == F.col(same[0])) & F.col("_record").eqNullSafe(F.col(same[1])), "left_semi")

    text = F.array_join(F.sort_array(F.collect_list(F.struct(_BLOCK, _AT, "_text")))["_text"], "\n")
    good = of(kept.where(F.col("_n") <= max_lines)).groupBy(_FILE, "_record").agg(
        F.first("file_name").alias("file_name"), text.alias("record")).select("file_name", "record", F.lit(True).alias("well_formed"))
    bad = of(kept.where(F.col("_n") > max_lines)).select(
        "file_name", F.explode(F.split("_text", "\n", -1)).alias("record"), F.lit(False).alias("well_formed"))
    return whole.unionByName(good).unionByName(bad)
