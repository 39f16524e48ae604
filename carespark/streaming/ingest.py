"""Structured Streaming ingest of clinical entities (STM-01..08).

One stream per entity (patients, encounters, conditions, medications,
providers). Messages are JSON objects carrying the raw CSV contract fields
(as a broker topic would); a file directory stands in for the broker here.

Per micro-batch (``foreachBatch``):

1. **Schema enforcement** (STM-03): parse with the fixed contract schema;
   a message with an unknown field, malformed JSON or no natural key is
   rejected.
2. **Audit** (STM-07): the access is logged before anything is stored, so no
   stored row lacks its entry (a replay logs again).
3. **Dead letters** (STM-04): rejected messages go to a dead-letter table with
   the reason; :func:`replay_dead_letters` re-validates them later (e.g. after
   a contract version added the field).
4. **Exactly-once append** (STM-02): a row is stored once, whatever the batches
   that bring it. Patients, providers and encounters are known by their id,
   conditions and medications by their whole row, as episodes of one patient,
   code and day are distinct. A key index beside the table tells which rows
   other batches stored; the table itself is not read. Rows that are not stored
   because their key is go to a duplicates table with their count and whether
   they repeat or contradict the kept one: rows in = appended + rejected + duplicates.
5. **Order per patient** (STM-05): rows are range-partitioned by (patient,
   key) and sorted within partitions before the write.
6. **Re-scoring / metrics** (STM-06, STM-08): the batch's delta advances the
   per-patient state, optional callbacks score the patients that the batch
   names, and a metrics row per batch is written.

Data, duplicates, dead letters, index, state and metrics are partitioned by batch
and a batch replaces its own partition. A replay after a failure between any two writes therefore
computes and writes the same rows again, and its callbacks see the same
patients: nothing is lost or doubled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carespark.streaming.key_index import DIGEST, KeyIndex, identity
from carespark.streaming.key_index import exists as _exists
from carespark.streaming.patient_state import PatientState

# Natural keys of each raw entity (the idempotency guard).
NATURAL_KEYS: dict[str, list[str]] = {
    "raw_patients": ["ID"],
    "raw_providers": ["Id"],
    "raw_encounters": ["Id"],
    "raw_conditions": ["PATIENT", "CODE", "START"],
    "raw_medications": ["PATIENT", "CODE", "START"],
}
# Entities whose natural key names several episodes: a row is known by all its fields.
EPISODES = ("raw_conditions", "raw_medications")
PATIENT_FIELD: dict[str, str] = {
    "raw_patients": "ID",
    "raw_encounters": "PATIENT",
    "raw_conditions": "PATIENT",
    "raw_medications": "PATIENT",
    "raw_providers": "Id",
}
BATCH = "batch_id"  # partition column of the data, dead letters and metrics
STAGE_ROWS = 100_000    # of a file of a batch's stages
TASK_ROWS = 250_000     # that a task sorts, of a batch
DEAD_LETTER_SCHEMA = "table_name string, message string, reason string, source_file string, batch_id long"


def validate_messages(msgs: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Add ``row`` (parsed struct) and ``reason`` (NULL when valid) to raw messages.

    ``msgs`` has a string column ``value`` holding one JSON object.
    """
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    allowed = F.array(*[F.lit(c) for c in columns])
    # a projection of their own, so that each message is parsed once however often the parts are named
    parsed = msgs.withColumns({"_keys": F.json_object_keys(F.col("value")), "row": F.from_json(F.col("value"), schema)})
    keys = F.col("_keys")
    unknown = F.array_except(keys, allowed)
    key_missing = F.lit(False)
    for k in NATURAL_KEYS[table]:
        key_missing = key_missing | F.col("row")[k].isNull() | (F.col("row")[k] == "")
    reason = (
        F.when(keys.isNull(), F.lit("malformed json"))
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown field: "), F.array_join(unknown, ",")))
        .when(key_missing, F.lit("missing natural key"))
    )
    return parsed.withColumn("reason", reason).drop("_keys")


def read_entity_stream(
    spark: SparkSession,
    source: str,
    max_files: int | None = None,
    *,
    source_format: str = "files",
    kafka_servers: str | None = None,
) -> DataFrame:
    """STM-01: a streaming DataFrame of JSON messages (``value``, ``source_file``).

    ``files``: a directory of JSON-lines files (one message per line).
    ``kafka``: ``source`` is the topic; needs the Kafka connector on the
    classpath (not bundled here), message values are read as text.
    """
    if source_format == "kafka":
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
             .option("subscribe", source).option("startingOffsets", "earliest"))
        return r.load().select(
            F.col("value").cast("string").alias("value"),
            F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
            .alias("source_file"),
        )
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(source).select(
        F.col("value"), F.col("_metadata.file_name").alias("source_file")
    )


@dataclass
class StreamTargets:
    table_path: str
    dead_letter_path: str
    metrics_path: str
    audit_path: str | None = None
    partitions: int | None = None  # of the written rows; by default adaptive execution sizes them
    on_touched: list[Callable[[DataFrame, int], None]] = field(default_factory=list)
    state: PatientState | None = None
    index_buckets: int = 64        # layout of the key index, see KeyIndex

    @property
    def index(self) -> KeyIndex:
        return KeyIndex(self.table_path.rstrip("/") + "_index", self.index_buckets)

    @property
    def duplicates_path(self) -> str:
        return self.table_path.rstrip("/") + "_duplicates"


def process_batch(batch: DataFrame, batch_id: int, table: str, columns: list[str], targets: StreamTargets) -> None:
    """The ``foreachBatch`` body (also usable on a static DataFrame). The stages are deleted at its end,
    so a callback must not keep a frame made of the patients that it is given."""
    from carespark.session import short_shuffles, staged

    # the batch's messages once, for all that follows; a message's text only where it is rejected
    valid = F.col("reason").isNull()
    parsed = validate_messages(batch, table, columns).select(
        F.when(~valid, F.col("value")).alias("value"), "source_file", F.when(valid, F.col("row")).alias("row"), "reason")
    with short_shuffles(batch.sparkSession), staged(parsed, f"stream-{table}", STAGE_ROWS) as v:
        _process(v, batch_id, table, columns, targets)


def _process(v: DataFrame, batch_id: int, table: str, columns: list[str], targets: StreamTargets) -> None:
    good = v.where(F.col("reason").isNull()).select(
        *[F.col("row")[c].alias(c) for c in columns], F.col("source_file").alias("_source_file")
    )
    bad = v.where(F.col("reason").isNotNull()).select(
        F.lit(table).alias("table_name"), F.col("value").alias("message"), "reason", "source_file",
    )
    known_by = columns if table in EPISODES else NATURAL_KEYS[table]
    touched = good.select(F.col(PATIENT_FIELD[table]).alias("patient_id")).distinct()
    n_good = good.count()
    if targets.audit_path and n_good:
        from carespark.plans.governance import audited

        audited(touched, targets.audit_path, action=f"stream_ingest:{table}", accessor="stream", context={"batch_id": str(batch_id)})
    _write_batch(bad, targets.dead_letter_path, batch_id)
    n_new = 0
    if n_good:
        appended = _store(good, n_good, batch_id, table, columns, targets)
        n_new = appended.count()
        targets.index.add(appended.select(identity(known_by).alias(DIGEST)), batch_id, n_new)
        if targets.state:
            targets.state.add(appended, table, batch_id)
    for cb in targets.on_touched:
        cb(touched, batch_id)
    n_in = v.count()
    metrics = v.sparkSession.createDataFrame([(table, n_in, n_new, n_in - n_good, n_good - n_new)],
                                             "table_name string, rows_in long, rows_appended long, rows_rejected long, rows_duplicate long")
    _write_batch(metrics, targets.metrics_path, batch_id)


def _store(good: DataFrame, n_good: int, batch_id: int, table: str, columns: list[str], targets: StreamTargets) -> DataFrame:
    """Write a batch's new rows and its duplicates; returns the rows, read back."""
    from carespark.session import staged

    key, pcol = NATURAL_KEYS[table], PATIENT_FIELD[table]
    known_by = columns if table in EPISODES else key
    # each different row of the batch once, with its count and what becomes of it: what is written reads nothing else
    stored = targets.index.stored(good.select(identity(known_by).alias(DIGEST)), batch_id, n_good)
    with staged(_decided(good, n_good, stored, known_by, columns), f"stream-{table}-rows", STAGE_ROWS) as decided:
        ranged = decided.where("kept").select(*columns, "_source_file")
        # Range partitioning keeps one patient's rows together and in order,
        # yet splits a patient that holds a large share of the batch.
        ranged = ranged.repartitionByRange(targets.partitions, pcol, *key) if targets.partitions else ranged.repartitionByRange(pcol, *key)
        _write_batch(ranged.sortWithinPartitions(pcol, *key), targets.table_path, batch_id)
        _write_batch(decided.where(F.col("occurrences") > 0).drop("kept"), targets.duplicates_path, batch_id)
    return good.sparkSession.read.schema(ranged.withColumn(BATCH, F.lit(0).cast("long")).schema).parquet(targets.table_path) \
        .where(F.col(BATCH) == batch_id)


def _decided(good: DataFrame, n_good: int, stored: DataFrame | None, known_by: list[str], columns: list[str]) -> DataFrame:
    """A batch's different rows: ``kept`` is the smallest one of a key that no other batch stored. ``occurrences``
    are those that are not stored, of the ``kind`` ``repeat`` if all fields are the kept row's, ``conflict`` if
    not, or ``stored`` if another batch has the key: its row, which would have to be read, is not compared."""
    fields, keys, known = [*columns, "_source_file"], known_by, F.lit(False)
    tasks = -(-n_good // TASK_ROWS)
    if stored is not None:      # only then a row's digest is needed
        good, keys = good.withColumn(DIGEST, identity(known_by)), [DIGEST]
    # a key's rows meet in one exchange, for all that follows: equal rows are not counted before it, as few
    # of a batch are equal and counting would hold a read task's rows in memory
    rows = good.repartition(tasks, *keys).groupBy(*dict.fromkeys((*keys, *fields))).agg(F.count(F.lit(1)).alias("occurrences"))
    if stored is not None:
        rows = rows.join(stored.repartition(tasks, DIGEST).distinct().withColumn("_known", F.lit(True)), DIGEST, "left")
        known = F.coalesce("_known", F.lit(False))
    rows = rows.withColumn("_first", F.min(F.struct(*fields)).over(Window.partitionBy(*keys)))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col("_first")[c]) for c in columns])
    kept = ~known & same & F.col("_source_file").eqNullSafe(F.col("_first")["_source_file"])
    kind = F.when(known, "stored").when(same, "repeat").otherwise("conflict")
    return rows.select(*fields, (F.col("occurrences") - kept.cast("long")).alias("occurrences"),
                       kind.alias("kind"), kept.alias("kept"))


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch's rows as the partition ``batch_id`` of a table, replacing what an earlier try left there."""
    df.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def committed_batches(spark: SparkSession, targets: StreamTargets) -> DataFrame:
    """Batches whose last write, the metrics row, is there."""
    return spark.read.parquet(targets.metrics_path).select(BATCH).distinct()


def start_ingest(
    spark: SparkSession,
    source: str,
    table: str,
    columns: list[str],
    targets: StreamTargets,
    *,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    source_format: str = "files",
    kafka_servers: str | None = None,
    max_files: int | None = None,
):
    """Start the guarded ingest stream for one entity; returns the StreamingQuery.

    ``checkpoint`` must outlive the application: a restart goes on where the
    last run ended, with the same batch numbers. ``source`` is a folder, or with
    ``source_format="kafka"`` a topic."""
    w = read_entity_stream(spark, source, max_files, source_format=source_format, kafka_servers=kafka_servers) \
        .writeStream.foreachBatch(
        lambda df, bid: process_batch(df, bid, table, columns, targets)
    ).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def replay_dead_letters(
    spark: SparkSession, table: str, columns: list[str], targets: StreamTargets, batch_id: int = -1
) -> DataFrame:
    """STM-04: re-validate dead letters (e.g. against a newer contract) and append the now-valid
    ones through the same guard; state and callbacks see their patients like those of any
    batch. All dead letters are read each time, so the batch ``batch_id`` of the replay may be
    replaced by a later replay. Returns the messages that are still invalid."""
    if not _exists(spark, targets.dead_letter_path):
        return spark.createDataFrame([], DEAD_LETTER_SCHEMA)
    dead = spark.read.parquet(targets.dead_letter_path).where(F.col("table_name") == table)
    msgs = dead.select(F.col("message").alias("value"), "source_file")
    from carespark.session import stable_table

    msgs = stable_table(msgs, "dead-letter-replay")
    process_batch(msgs, batch_id, table, columns,
                  replace(targets, dead_letter_path=targets.dead_letter_path + "_replayed"))
    return validate_messages(msgs, table, columns).where(F.col("reason").isNotNull())


def rescore_touched(
    features_fn: Callable[[DataFrame], DataFrame],
    model,
    score_path: str,
    *,
    buckets: int,
) -> Callable[[DataFrame, int], None]:
    """STM-06: a callback that re-scores only the touched patients.

    ``features_fn(touched_ids)`` returns feature rows for those patients: with
    :meth:`PatientState.features` from the state that the batch has advanced, without
    reading a fact. Scores live in a mart partitioned by a hash bucket of
    the patient id; only the touched buckets are rewritten (dynamic overwrite),
    keeping the other patients' scores in those buckets. ``buckets`` is the
    mart's layout: choose it by the number of patients, a bucket being rewritten
    as a whole, and keep it.
    """
    from carespark.plans import risk
    from carespark.plans.marts import write_mart
    from carespark.session import staged

    def cb(touched: DataFrame, batch_id: int) -> None:
        spark = touched.sparkSession
        feats = features_fn(touched)
        scores = risk.score(model, feats, phi_read=True).withColumn(
            "bucket", F.pmod(F.xxhash64("patient_id"), F.lit(buckets)).cast("int")
        ).withColumn("scored_batch", F.lit(batch_id).cast("long"))
        with staged(scores, "rescore-batch") as scores:    # read three times below
            every = scores
            if _exists(spark, score_path):
                old = spark.read.parquet(score_path)
                touched_buckets = scores.select("bucket").distinct()
                keep = old.join(touched_buckets, "bucket", "left_semi").join(
                    scores.select("patient_id"), "patient_id", "left_anti"
                )
                every = keep.unionByName(scores)
            with staged(every, "rescore") as every:
                write_mart(every, score_path, ["bucket"], mode="dynamic")

    return cb


def progress_metrics(query) -> list[dict]:
    """STM-08: freshness and row counts per trigger from the query's progress
    reports (input rows, processing rate, batch duration, trigger time)."""
    out = []
    for p in query.recentProgress:
        out.append({
            "batch_id": p.get("batchId"),
            "timestamp": p.get("timestamp"),
            "input_rows": p.get("numInputRows"),
            "input_rows_per_second": p.get("inputRowsPerSecond"),
            "processed_rows_per_second": p.get("processedRowsPerSecond"),
            "batch_ms": (p.get("durationMs") or {}).get("triggerExecution"),
        })
    return out


def start_all_entities(
    spark: SparkSession,
    source_root: str,
    target_root: str,
    *,
    contracts: dict | None = None,
    available_now: bool = True,
    source_format: str = "files",
    kafka_servers: str | None = None,
) -> dict:
    """STM-01: one guarded ingest stream per entity, each into its own raw
    table, dead-letter table, metrics table and checkpoint, from
    ``source_root/<raw table name>`` (with ``source_format="kafka"`` the topic
    ``source_root.<raw table name>``). Returns {table: StreamingQuery}."""
    from carespark.sources.contracts import CONTRACTS

    queries = {}
    for table, (_, cols) in (contracts or CONTRACTS).items():
        base = f"{target_root.rstrip('/')}/{table}"
        targets = StreamTargets(f"{base}/data", f"{base}/_dead_letters", f"{base}/_metrics")
        queries[table] = start_ingest(
            spark, f"{source_root}.{table}" if source_format == "kafka" else f"{source_root.rstrip('/')}/{table}",
            table, cols, targets, checkpoint=f"{base}/_checkpoint", available_now=available_now,
            source_format=source_format, kafka_servers=kafka_servers,
        )
    return queries
