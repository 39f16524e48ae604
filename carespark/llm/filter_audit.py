"""Filter interaction audit: what each filter removes in every order, from one pass over the texts.

A document's failures are a bit mask, and all that the audit reports depends
only on how many documents (good ones, toxic ones) of a part have each mask: at
most 2^k *cells* for k filters. The survivors of a subset of filters are then
walked in Gray-code order. Each step toggles one filter: the cells that fail it
have their counter of active failures raised or lowered, and a cell leaves the
running survivors when its counter leaves zero and returns when it is zero
again. The 2^k states are stored; what a filter removes at a step of an order is
the difference of two of them.

"Identical to any smaller doc_id's text" needs no row-to-row join: equal texts
fail the other filters alike, so rows of one digest are counted first (by part,
mask and labels, with how many hold their smallest id) and only these counts
meet per digest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carespark.llm.common import map_arrow

# FIXED VALUES: the limits of the five filters.
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITALS_PERCENT = 3
MARKS = "[#$%&*|]"
WORD_GAP = "[\\x20\\x09-\\x0D]+"
REPEATED = "E"   # the filter on equal texts, which a single row cannot tell


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure condition by letter, of a text that is not null and its words."""
    n = F.size(words)
    return {"A": n < MIN_WORDS,
            "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * n,
            "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > CAPITALS_PERCENT * F.length(text),
            "D": text.rlike(MARKS)}


def mask_cells(docs: DataFrame, labels: DataFrame, part: str = "lang",
               filters: Callable[[Column, Column], dict[str, Column]] = text_filters) -> DataFrame:
    """(part, mask, docs, good, toxic): documents of each part by the filters that they fail.

    Bit i of a mask is the i-th letter in alphabetical order, the filter on equal texts included.
    Partial aggregates come before each shuffle, so a text, part or id that many rows share
    crosses as one row a task."""
    text, words = F.col("_text"), F.col("_words")
    letters = sorted([*filters(text, words), REPEATED])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text"), F.lit("")).alias("_text")).withColumn("_words", words_of(text))
    bits = [F.when(failed, 1 << letters.index(letter)).otherwise(0) for letter, failed in filters(text, words).items()]
    mask = sum(bits[1:], bits[0]) if bits else F.lit(0)
    rows = rows.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2("_text", 256)).alias("digest"))
    rows = rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("c"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("long"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("long"), F.lit(0))).alias("toxic"))
    rows = rows.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    # a null id comes after all others; ids are distinct here within a group
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("c"))).alias("first")
    groups = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("c").alias("n"), first)
    key = F.struct("first.none", "first.id")
    groups = groups.withColumn("least", F.min(key).over(Window.partitionBy("digest")))
    alone = F.when(key.eqNullSafe(F.col("least")), F.col("first.c")).otherwise(F.lit(0))
    repeated = 1 << letters.index(REPEATED)
    split = groups.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), alone.alias("n")),
        F.struct((F.col("mask") + repeated).alias("mask"), (F.col("n") - alone).alias("n")))).alias("cell"))
    return split.where("cell.n > 0").groupBy("part", F.col("cell.mask").alias("mask")).agg(
        F.sum("cell.n").alias("docs"), F.sum(F.col("cell.n") * F.col("good")).alias("good"),
        F.sum(F.col("cell.n") * F.col("toxic")).alias("toxic"))


def gray_walk(cells: list[tuple[int, int, int, int]], k: int) -> list[tuple[int, int, int]]:
    """Survivors (documents, good, toxic) of each subset of ``k`` filters, from (mask, documents, good, toxic)."""
    active = [0] * len(cells)
    kept = [sum(c[j] for c in cells) for j in (1, 2, 3)]
    states: list = [None] * (1 << k)
    states[0] = tuple(kept)
    subset = 0
    for step in range(1, 1 << k):
        bit = step & -step                       # the filter that this step toggles
        subset ^= bit
        on = bool(subset & bit)
        for i, (mask, *counts) in enumerate(cells):
            if mask & bit:
                was = active[i]
                active[i] += 1 if on else -1
                if not was or not active[i]:     # the cell leaves or comes back
                    for j, n in enumerate(counts):
                        kept[j] += -n if on else n
        states[subset] = tuple(kept)
    return states


def order_steps(states: list[tuple[int, int, int]], letters: str) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all orders."""
    k = len(letters)
    everything = (1 << k) - 1
    docs = [s[0] for s in states]
    shapley = [0] * k
    for i in range(k):
        for before in range(1 << k):
            if not before >> i & 1:
                n = before.bit_count()
                shapley[i] += factorial(n) * factorial(k - 1 - n) * (docs[before] - docs[before | 1 << i])
    for order in permutations(range(k)):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = docs[before] - docs[after]
            yield ("".join(letters[j] for j in order), step, docs[after], removed, docs[0] - docs[1 << i] - removed,
                   docs[everything ^ 1 << i] - docs[everything], states[before][1] - states[after][1],
                   states[before][2] - states[after][2], shapley[i])
            before = after


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang",
                  filters: Callable[[Column, Column], dict[str, Column]] = text_filters) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included (see COLUMNS).

    A null text is empty, a null part the empty string. A row fails the filter on equal texts if
    its text is that of a smaller doc_id; repeated rows of one id don't fail by each other; a null
    doc_id comes after all others and has no labels. Several labels of an id count by their largest. Clashing
    further columns are not read; an empty table gives no rows. Parts are walked in tasks, each
    from at most 2^k cells."""
    letters = "".join(sorted([*filters(F.col("_text"), F.col("_words")), REPEATED]))
    cells = mask_cells(docs, labels, part, filters).groupBy("part").agg(
        F.sort_array(F.collect_list(F.struct("mask", "docs", "good", "toxic"))).alias("cells"))   # 2^k at most
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                        *[(c, pa.int64()) for c in COLUMNS[3:]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                states = gray_walk([(c["mask"], c["docs"], c["good"], c["toxic"]) for c in found], len(letters))
                rows = [(name, *row) for row in order_steps(states, letters)]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return map_arrow(cells, run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COLUMNS[3:]))
