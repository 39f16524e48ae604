"""Which keys earlier batches stored: an index beside a stream's table (STM-02).

The guard of an append has to know whether a row is stored already. Random ids meet
every range of the stored table, so a filter on the key prunes nothing. The index
keeps a 16-byte digest per stored row, dealt into hash buckets, and a Bloom filter per
(batch, bucket). A large batch is dealt into more buckets, so that a bucket and its filter
stay of bounded size; its filters say into how many. A batch asks the filters first and reads only the (batch, bucket)
folders of which a filter says that they may hold one of its rows; the digests read
there decide. The stored table itself is never read. A batch with so many rows a bucket that
every filter lets some through does not ask. Batches of an older index hold digests of 32 bytes,
of which the first 16 are compared; their filters know the longer ones only and are not asked.

A batch replaces its own folders, so a replayed batch leaves the same index, and it
never asks its own.
"""

from __future__ import annotations

from functools import reduce
from math import exp

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH, BUCKET, DIGEST = "batch_id", "bucket", "digest"
DEALT = "dealt"     # into how many buckets a batch is; NULL in older filters: the index's own number
BYTES = "bytes"     # length of a batch's digests; NULL in older filters: 32
DIGEST_BYTES = 16   # of 2^30 rows two share one with a probability below 2^-68
HASHES = 4
WORD_BITS = 64
BUCKET_KEYS = 1 << 20    # a batch with more keys a bucket than this is dealt into more buckets


def identity(cols: list[str]) -> Column:
    """A digest of a row's columns by name. NULL differs from any value, but not from a column that
    an older contract does not have."""
    return F.substring(F.unhex(F.sha2(F.to_json(F.struct(*cols)), 256)), 1, DIGEST_BYTES)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


class KeyIndex:
    """The index in ``path``. ``buckets`` is the least number of its buckets: choose it by the size of
    a usual batch (a bucket should hold few of its rows) and keep it. ``bits_per_key``: 10 let about
    1 % of absent keys through. ``bucket_keys`` bounds the keys of a bucket."""

    def __init__(self, path: str, buckets: int = 64, bits_per_key: int = 10, bucket_keys: int = BUCKET_KEYS):
        self.keys_path, self.filters_path = f"{path.rstrip('/')}/keys", f"{path.rstrip('/')}/filters"
        self.buckets, self.bits_per_key, self.bucket_keys = buckets, bits_per_key, bucket_keys

    def _bucket(self, buckets: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(DIGEST), F.lit(self.buckets) if buckets is None else buckets).cast("int")

    @staticmethod
    def _bit(i: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(i), F.col(DIGEST)), F.col("bits"))

    def add(self, digests: DataFrame, batch_id: int, rows: int | None = None) -> None:
        """Store the digests of a batch's rows (column ``digest``; their number if it is known) and their filters."""
        rows = digests.count() if rows is None else rows
        dealt = max(self.buckets, -(-rows // self.bucket_keys))
        d = digests.select(DIGEST, self._bucket(F.lit(dealt)).alias(BUCKET), F.lit(batch_id).cast("long").alias(BATCH))
        _write(d.repartition(BUCKET), self.keys_path, [BATCH, BUCKET])
        d = digests.sparkSession.read.schema(f"{DIGEST} binary, {BATCH} long, {BUCKET} int").parquet(self.keys_path) \
            .where(F.col(BATCH) == batch_id)
        sizes = d.groupBy(BUCKET).agg(
            (F.ceil(F.count(F.lit(1)) * self.bits_per_key / WORD_BITS) * WORD_BITS).cast("long").alias("bits"))
        bits = d.join(F.broadcast(sizes), BUCKET)      # a row per bucket of the layout
        word = F.floor(F.col("bit") / WORD_BITS).cast("int").alias("word")
        ones = bits.select(BUCKET, F.explode(F.array(*(self._bit(i) for i in range(HASHES)))).alias("bit")) \
            .select(BUCKET, word, F.expr(f"shiftleft(1L, cast(bit % {WORD_BITS} as int))").alias("value"))
        zeros = sizes.select(BUCKET, F.explode(F.sequence(F.lit(0), (F.col("bits") / WORD_BITS - 1).cast("int"))).alias("word"),
                             F.lit(0).cast("long").alias("value"))
        words = ones.unionByName(zeros).groupBy(BUCKET, "word").agg(F.bit_or("value").alias("value"))
        filters = words.groupBy(BUCKET).agg(F.sort_array(F.collect_list(F.struct("word", "value")))["value"].alias("words"))
        _write(filters.select(BUCKET, "words", F.lit(dealt).alias(DEALT), F.lit(DIGEST_BYTES).alias(BYTES),
                              F.lit(batch_id).cast("long").alias(BATCH)), self.filters_path, [BATCH])

    def places(self, digests: DataFrame, batch_id: int, rows: int | None = None) -> list[tuple[int, int]]:
        """(batch, bucket) folders of other batches that may hold one of the digests (``rows``: how many
        there are, if it is known): at most one per bucket and batch reaches the driver."""
        spark = digests.sparkSession
        if not exists(spark, self.filters_path):
            return []
        filters = spark.read.schema(f"{BUCKET} int, words array<long>, {DEALT} int, {BYTES} int, {BATCH} long").parquet(self.filters_path) \
            .where(F.col(BATCH) != batch_id).withColumn(DEALT, F.coalesce(DEALT, F.lit(self.buckets)))
        # a filter that is asked for so many absent keys says no to all of them with a probability of e^-12
        full = 12 / (1 - exp(-HASHES / self.bits_per_key)) ** HASHES
        unasked = F.coalesce(F.col(BYTES) != DIGEST_BYTES, F.lit(True)) | (F.lit(rows or 0) >= F.col(DEALT) * full)
        places = {(r[0], r[1]) for r in filters.where(unasked).select(BATCH, BUCKET).distinct().collect()}
        filters = filters.where(~unasked).withColumn("bits", F.size("words").cast("long") * WORD_BITS)
        # the layouts in use: a few numbers, whatever the batches
        layouts = [r[0] for r in filters.select(DEALT).distinct().collect()]
        if not layouts:
            return sorted(places)
        asked = digests.select(DIGEST, F.explode(F.array(*map(F.lit, layouts)).cast("array<int>")).alias(DEALT))
        asked = asked.select(DIGEST, DEALT, self._bucket(F.col(DEALT)).alias(BUCKET)).join(filters, [DEALT, BUCKET])
        held = reduce(lambda a, b: a & b, (
            F.expr(f"shiftright(words[cast(floor({b} / {WORD_BITS}) as int)], cast({b} % {WORD_BITS} as int)) & 1L") == 1
            for b in (f"pmod(xxhash64({i}, {DIGEST}), bits)" for i in range(HASHES))))
        return sorted(places | {(r[0], r[1]) for r in asked.where(held).select(BATCH, BUCKET).distinct().collect()})

    def stored(self, digests: DataFrame, batch_id: int, rows: int | None = None) -> DataFrame | None:
        """Digests of other batches, of the folders that may hold one of these, as they lie; None where there are none."""
        places = self.places(digests, batch_id, rows)
        if not places:
            return None
        by_batch: dict[int, list[int]] = {}
        for batch, bucket in places:
            by_batch.setdefault(batch, []).append(bucket)
        wanted = reduce(lambda a, b: a | b, [(F.col(BATCH) == b) & F.col(BUCKET).isin(found) for b, found in by_batch.items()])
        return digests.sparkSession.read.schema(f"{DIGEST} binary, {BATCH} long, {BUCKET} int").parquet(self.keys_path) \
            .where(wanted).select(F.substring(DIGEST, 1, DIGEST_BYTES).alias(DIGEST))


def _write(df: DataFrame, path: str, parts: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
