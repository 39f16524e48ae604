"""Registered queries: entity streams over messages made from the given tables, and tenants.

A stream's messages are written as JSON lines in two deliveries, the second of which
repeats a part of the first; each delivery is one run of the guarded stream.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from carespark.plans import features as FE
from carespark.plans import governance as GOV
from carespark.plans import marts as M
from carespark.plans import risk as R
from carespark.plans.catalog import T, register
from carespark.session import stable_table
from carespark.sources.contracts import CONTRACTS
from carespark.streaming.ingest import StreamTargets, replay_dead_letters, rescore_touched, start_ingest
from carespark.streaming.patient_state import PatientState

# Which orders come damaged, and which come again in the second delivery.
_STRANGE, _BROKEN, _NAMELESS, _AGAIN = "o_orderkey % 17 = 3", "o_orderkey % 19 = 4", "o_orderkey % 23 = 5", "o_orderkey % 3 = 0"
MESSAGES = 250_000    # of a file
_KIND_SQL = f"""CASE WHEN {_BROKEN} THEN 'malformed json' WHEN {_STRANGE} THEN 'unknown field: EXTRA'
  WHEN {_NAMELESS} THEN 'missing natural key' END"""


def _messages(spark, sf_dir):
    o = T(spark, sf_dir).raw("orders")
    row = {
        "Id": F.when(F.expr(_NAMELESS), F.lit("")).otherwise(F.col("o_orderkey").cast("string")),
        "START": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "PATIENT": F.col("o_custkey").cast("string"),
        "ENCOUNTERCLASS": F.col("o_orderpriority"),
        "EXTRA": F.when(F.expr(_STRANGE), F.lit("x")),
    }
    text = F.to_json(F.struct(*[c.alias(n) for n, c in row.items()]))   # a NULL EXTRA is left out
    return o.select("o_orderkey", F.when(F.expr(_BROKEN), F.substring(text, 1, 20)).otherwise(text).alias("value"))


def _write_messages(messages, folder: str) -> None:
    """Add JSON lines to a stream's folder: compressed, as they repeat every field's name. A compressed file is
    read by one task, hence many of them."""
    messages.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", MESSAGES).text(folder)


def _run(spark, sf_dir, **more) -> StreamTargets:
    """Both deliveries through the stream, one batch each."""
    base = M.work_dir(spark, "stream")
    targets = StreamTargets(f"{base}/data", f"{base}/dead", f"{base}/metrics", audit_path=f"{base}/audit", index_buckets=4, **more)
    messages = _messages(spark, sf_dir)
    for part in (messages, messages.where(_AGAIN)):
        _write_messages(part.select("value"), f"{base}/in")
        start_ingest(spark, f"{base}/in", "raw_encounters", CONTRACTS["raw_encounters"][1], targets,
                     checkpoint=f"{base}/checkpoint").awaitTermination()
    return targets


@register("stream_encounters", f"""SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id, CAST(o_custkey AS VARCHAR) AS patient_id,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS start_text, CAST(0 AS BIGINT) AS batch_id
FROM orders WHERE {_KIND_SQL} IS NULL""")
def q_stream_encounters(spark, sf_dir):
    """STM-01/02/03/05: valid messages are stored once, in the first batch that brought them."""
    t = _run(spark, sf_dir)
    return spark.read.parquet(t.table_path).select(
        F.col("Id").alias("encounter_id"), F.col("PATIENT").alias("patient_id"), F.col("START").alias("start_text"),
        F.col("batch_id").cast("long").alias("batch_id"))


@register("stream_dead_letters", f"""SELECT {_KIND_SQL} AS reason, b.batch_id, COUNT(*) AS messages
FROM orders JOIN (VALUES (CAST(0 AS BIGINT)), (CAST(1 AS BIGINT))) b(batch_id) ON b.batch_id = 0 OR {_AGAIN}
WHERE {_KIND_SQL} IS NOT NULL GROUP BY ALL""")
def q_stream_dead_letters(spark, sf_dir):
    """STM-03/04: damaged messages are kept with their reason, a delivery's own ones each."""
    dead = spark.read.parquet(_run(spark, sf_dir).dead_letter_path)
    return dead.groupBy("reason", F.col("batch_id").cast("long").alias("batch_id")).agg(F.count(F.lit(1)).alias("messages"))


@register("stream_metrics", f"""SELECT CAST(0 AS BIGINT) AS batch_id, COUNT(*) AS rows_in,
  count_if({_KIND_SQL} IS NULL)::BIGINT AS rows_appended, count_if({_KIND_SQL} IS NOT NULL)::BIGINT AS rows_rejected,
  0::BIGINT AS rows_duplicate, len(list_distinct(list(o_custkey) FILTER (WHERE {_KIND_SQL} IS NULL)))::BIGINT AS patients_logged FROM orders
UNION ALL SELECT 1, COUNT(*), 0, count_if({_KIND_SQL} IS NOT NULL)::BIGINT, count_if({_KIND_SQL} IS NULL)::BIGINT,
  len(list_distinct(list(o_custkey) FILTER (WHERE {_KIND_SQL} IS NULL)))::BIGINT FROM orders WHERE {_AGAIN}""")
def q_stream_metrics(spark, sf_dir):
    """STM-07/08: a metrics row per batch; the audit names every patient of a batch, also of rows stored before."""
    t = _run(spark, sf_dir)
    named = spark.read.parquet(t.audit_path).groupBy(F.col("context")["batch_id"].cast("long").alias("batch_id")) \
        .agg(F.countDistinct("patient_ref").alias("patients_logged"))
    m = spark.read.parquet(t.metrics_path).select(F.col("batch_id").cast("long").alias("batch_id"), "rows_in", "rows_appended", "rows_rejected", "rows_duplicate")
    return m.join(named, "batch_id")


# Episodes of the line items: several may share patient, code and day, some are equal in all fields.
_EPISODE = {"PATIENT": "l_suppkey", "CODE": "l_returnflag", "START": "date_format(l_shipdate, 'yyyy-MM')", "DESCRIPTION": "l_linestatus"}
_EPISODE_SQL = """SELECT CAST(l_suppkey AS VARCHAR) AS patient_id, l_returnflag AS code,
  strftime(l_shipdate, '%Y-%m') AS start_text, l_linestatus AS description"""


def _as_json(df, fields: dict):
    """Messages of a frame's rows: field name -> SQL expression."""
    return df.select(F.to_json(F.struct(*[F.expr(e).cast("string").alias(n) for n, e in fields.items()])).alias("value"))


def _deliver(spark, base: str, table: str, deliveries, targets: StreamTargets) -> StreamTargets:
    """Each delivery of messages through the stream, one batch each."""
    for part in deliveries:
        _write_messages(part, f"{base}/{table}/in")
        start_ingest(spark, f"{base}/{table}/in", table, CONTRACTS[table][1], targets,
                     checkpoint=f"{base}/{table}/checkpoint").awaitTermination()
    return targets


def _targets(base: str, table: str, **more) -> StreamTargets:
    return StreamTargets(f"{base}/{table}/data", f"{base}/{table}/dead", f"{base}/{table}/metrics", index_buckets=4, **more)


@register("stream_duplicates", f"""WITH e AS ({_EPISODE_SQL}, l_orderkey % 3 = 0 AS again FROM lineitem)
SELECT patient_id, code, start_text, description, 'repeat' AS kind, CAST(0 AS BIGINT) AS batch_id, COUNT(*) - 1 AS occurrences
FROM e GROUP BY ALL HAVING COUNT(*) > 1
UNION ALL SELECT patient_id, code, start_text, description, 'stored', 1, COUNT(*) FROM e WHERE again GROUP BY ALL""".replace(
    "FROM e GROUP BY ALL HAVING", "FROM (SELECT patient_id, code, start_text, description FROM e) GROUP BY ALL HAVING"))
def q_stream_duplicates(spark, sf_dir):
    """STM-02: distinct episodes of one patient, code and day are all stored; what is not stored is counted."""
    lines = T(spark, sf_dir).raw("lineitem")
    base = M.work_dir(spark, "stream")
    t = _deliver(spark, base, "raw_conditions", (_as_json(lines, _EPISODE), _as_json(lines.where("l_orderkey % 3 = 0"), _EPISODE)),
                 _targets(base, "raw_conditions"))
    return spark.read.parquet(t.duplicates_path).groupBy(
        F.col("PATIENT").alias("patient_id"), F.col("CODE").alias("code"), F.col("START").alias("start_text"),
        F.col("DESCRIPTION").alias("description"), "kind", F.col("batch_id").cast("long").alias("batch_id")).agg(
        F.sum("occurrences").alias("occurrences"))


@register("stream_episodes", f"SELECT DISTINCT *, CAST(0 AS BIGINT) AS batch_id FROM ({_EPISODE_SQL} FROM lineitem)")
def q_stream_episodes(spark, sf_dir):
    """STM-02: the stored episodes are the distinct ones, whatever the batches that bring them."""
    lines = T(spark, sf_dir).raw("lineitem")
    base = M.work_dir(spark, "stream")
    t = _deliver(spark, base, "raw_conditions", (_as_json(lines, _EPISODE), _as_json(lines.where("l_orderkey % 3 = 0"), _EPISODE)),
                 _targets(base, "raw_conditions"))
    return spark.read.parquet(t.table_path).select(
        F.col("PATIENT").alias("patient_id"), F.col("CODE").alias("code"), F.col("START").alias("start_text"),
        F.col("DESCRIPTION").alias("description"), F.col("batch_id").cast("long").alias("batch_id"))


@register("stream_replay", f"""SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id, CAST(o_custkey AS VARCHAR) AS patient_id,
  CAST(CASE WHEN {_STRANGE} THEN -1 ELSE 0 END AS BIGINT) AS batch_id, true AS seen
FROM orders WHERE NOT ({_BROKEN}) AND NOT ({_NAMELESS})""")
def q_stream_replay(spark, sf_dir):
    """STM-04: dead letters with a field that a newer contract has are stored by a replay, and its callbacks see their patients."""
    seen = M.work_dir(spark, "seen")

    def note(touched, batch_id):
        touched.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(seen)

    t = _run(spark, sf_dir, on_touched=[note])
    replay_dead_letters(spark, "raw_encounters", [*CONTRACTS["raw_encounters"][1], "EXTRA"], t)
    named = spark.read.parquet(seen).distinct().withColumn("seen", F.lit(True))
    stored = spark.read.parquet(t.table_path).select(
        F.col("Id").alias("encounter_id"), F.col("PATIENT").alias("patient_id"), F.col("batch_id").cast("long").alias("batch_id"))
    return stored.join(named, ["patient_id", "batch_id"], "left").select(
        "encounter_id", "patient_id", "batch_id", F.coalesce("seen", F.lit(False)).alias("seen"))


_CODES = {"diabetes": ["1"], "heart_failure": ["2"], "hypertension": ["3", "5"], "copd_asthma": ["4"]}
_FIRST, _SECOND = "{k} % 2 = 0", "{k} % 3 = 0"    # deliveries; one row in six comes in both
_SOURCES = {
    "raw_patients": ("customer", "c_custkey", {"ID": "c_custkey", "GENDER": "if(c_nationkey % 2 = 0, 'M', 'F')",
                                               "HEALTHCARE_EXPENSES": "c_acctbal", "BIRTHDATE": "date_add(date'1950-01-01', cast(c_custkey as int))"}),
    "raw_encounters": ("orders", "o_orderkey", {"Id": "o_orderkey", "PATIENT": "o_custkey", "START": "date_format(o_orderdate, 'yyyy-MM-dd')",
                                                "TOTAL_CLAIM_COST": "o_totalprice"}),
    "raw_conditions": ("lineitem", "l_orderkey", {"PATIENT": "l_suppkey", "CODE": "pmod(l_partkey, 7)", "START": "date_format(l_shipdate, 'yyyy-MM-dd')",
                                                  "DESCRIPTION": "l_orderkey"}),
}
_RESCORE_AS_OF = "2024-06-30"


def _kept_sql(key: str) -> str:
    return f"({_FIRST.format(k=key)} OR {_SECOND.format(k=key)})"


@register("stream_rescore", f"""WITH c AS (SELECT CAST(l_suppkey AS VARCHAR) AS id, count(DISTINCT l_partkey % 7) AS n, list(DISTINCT CAST(l_partkey % 7 AS VARCHAR)) AS m
  FROM lineitem WHERE {_kept_sql('l_orderkey')} GROUP BY 1),
e AS (SELECT CAST(o_custkey AS VARCHAR) AS id, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(38,2))) AS cost
  FROM orders WHERE {_kept_sql('o_orderkey')} GROUP BY 1)
SELECT p.id AS patient_id, CAST(year(DATE '{_RESCORE_AS_OF}') - year(DATE '1950-01-01' + CAST(c_custkey AS INTEGER)) AS DOUBLE) AS age_years,
  CASE WHEN c_nationkey % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS is_male, coalesce(c.n, 0)::DOUBLE AS condition_count,
  {', '.join(f"coalesce(list_has_any(m, {v}), false)::INTEGER::DOUBLE AS has_{k}" for k, v in _CODES.items())},
  coalesce(e.n, 0)::DOUBLE AS encounter_count, coalesce(CAST(e.cost AS DOUBLE), 0) AS total_encounter_cost,
  CAST(c_acctbal AS DOUBLE) AS healthcare_expenses, true AS score_is_current
FROM (SELECT *, CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE {_kept_sql('c_custkey')}) p LEFT JOIN c USING (id) LEFT JOIN e USING (id)""")
def q_stream_rescore(spark, sf_dir):
    """STM-06: after two deliveries of three entities, each re-scoring the patients that it touched from
    their state, every patient's score is the one that all rows together give."""
    t = T(spark, sf_dir)
    base = M.work_dir(spark, "rescore")
    state = PatientState(f"{base}/state")
    options = {"condition_sets": _CODES, "as_of": _RESCORE_AS_OF}
    whole = stable_table(_features_from_tables(t), "features")    # the labels, the fit and the check each read it several times
    train, n = R.training_frame(whole, FE.high_cost_label(whole, key_col="patient_id"), key_col="patient_id")
    model = R.fit(train, n, max_iter=5)
    score = rescore_touched(lambda touched: state.features(touched, **options), model, f"{base}/scores", buckets=8)
    for table, (source, key, fields) in _SOURCES.items():
        rows = t.raw(source)
        _deliver(spark, base, table, [_as_json(rows.where(part.format(k=key)), fields) for part in (_FIRST, _SECOND)],
                 _targets(base, table, state=state, on_touched=[score]))
    want = R.score(model, whole, phi_read=True).select("patient_id", F.col("risk_score").alias("want"))
    scores = spark.read.parquet(f"{base}/scores").join(want, "patient_id", "full")
    current = F.coalesce(F.abs(F.col("risk_score") - F.col("want")) < 1e-9, F.lit(False))
    return state.features(**options).join(scores.select("patient_id", current.alias("score_is_current")), "patient_id", "full")


def _features_from_tables(t):
    """The features of all patients that either delivery brings, from the tables themselves."""
    def rows(table):
        source, key, fields = _SOURCES[table]
        return t.raw(source).where(_kept_sql(key)).select(*[F.expr(e).cast("string").alias(n) for n, e in fields.items()])

    c = rows("raw_conditions").select(F.col("PATIENT").alias("patient_key"), F.col("CODE").alias("code"))
    e = rows("raw_encounters").select(F.col("PATIENT").alias("patient_key"), F.col("TOTAL_CLAIM_COST").cast("decimal(18,2)").alias("total_claim_cost"))
    p = rows("raw_patients").select(
        F.col("ID").alias("patient_key"), F.col("ID").alias("patient_id"), F.col("BIRTHDATE").cast("date").alias("birthdate"),
        F.col("GENDER").alias("gender"), F.col("HEALTHCARE_EXPENSES").cast("decimal(18,2)").alias("healthcare_expenses"))
    return FE.patient_features(p, e, c, condition_sets=_CODES, as_of=_RESCORE_AS_OF).drop("patient_key")


@register("tenant_scope", """SELECT CAST(c_nationkey AS VARCHAR) AS tenant_id, c_custkey AS patient_key, c_name AS patient_id
FROM customer WHERE c_nationkey = (SELECT min(c_nationkey) FROM customer)""")
def q_tenant_scope(spark, sf_dir):
    """GOV-05: patients stored by tenant (their nation); one tenant's view reads its own folder only."""
    c = T(spark, sf_dir).raw("customer")
    path = M.work_dir(spark, "tenants")
    rows = c.select(F.col("c_nationkey").cast("string").alias("tenant_id"), F.col("c_custkey").alias("patient_key"), F.col("c_name").alias("patient_id"))
    M.write_mart(rows, path, ["tenant_id"], mode="full")
    first = str(c.agg(F.min("c_nationkey")).first()[0])
    stored = spark.read.schema("patient_key long, patient_id string, tenant_id string").parquet(path)
    return GOV.with_tenant(GOV.tenant_scope(stored, first), first)
