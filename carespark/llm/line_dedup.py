"""Lines that many documents share, with DataFrame functions alone.

Lines are exploded and reduced to a 128-bit hash of their normalised key. Counts
of distinct documents per hash come from (hash, document) pairs that are combined
before each shuffle; the text itself does not travel for them. Lines to drop go
back to their documents as positions, and each document is reassembled from the
positions that stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_CHARS = 40     # shorter keys are never dropped
LEAST_DOCUMENTS = 5  # documents that make a line a shared one
SPACE = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def drop_shared_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Drop the lines whose key of ``least_chars`` code points or more occurs in ``least_documents``
    documents or more, except in the largest doc_id that holds it.

    Returns a row for each input row: (doc_id, n_lines, n_dropped, kept), kept being the lines that
    stay, joined by newlines. A null or empty text is one empty line. Rows that share a doc_id are
    one document when documents are counted, and a null doc_id is one that is smaller than all
    others. Repeated rows give repeated results; further columns are not read; an empty table gives none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("version"))
    lines = d.select("doc_id", "version", F.posexplode(_lines(F.col("text"))).alias("place", "line")) \
        .select("doc_id", "version", "place", F.btrim("line", F.lit(SPACE)).alias("line")).where(F.length("line") >= least_chars) \
        .select("doc_id", "version", "place", line_key(F.col("line")).alias("key")) \
        .select("doc_id", "version", "place", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g"))
    # one row for each line of a document; count(*) over them counts documents, a null doc_id included
    shared = lines.groupBy("h", "g", "doc_id").agg(F.lit(1).alias("one")).groupBy("h", "g").agg(
        F.count("*").alias("documents"), F.max("doc_id").alias("last")).where(F.col("documents") >= least_documents)
    drops = lines.join(shared, ["h", "g"]).where(~F.col("doc_id").eqNullSafe(F.col("last"))) \
        .groupBy("doc_id", "version").agg(F.collect_set("place").alias("drops"))
    joined = d.join(drops.withColumnRenamed("doc_id", "id2").withColumnRenamed("version", "version2"),
                    F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("version") == F.col("version2")), "left")
    whole = _lines(F.col("text"))
    n = F.size(whole)
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("drops"))
    kept = F.when(F.col("drops").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(whole, i)), "\n"))
    return joined.select("doc_id", n.cast("long").alias("n_lines"),
                         F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))
