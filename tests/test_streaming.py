"""Streaming ingest: exactly-once appends, schema enforcement, dead letters (STM-01..08)."""

import json
import os

from pyspark.sql import functions as F

from carespark.sources.contracts import CONTRACTS
from carespark.streaming.ingest import StreamTargets, replay_dead_letters, start_ingest
from carespark.streaming.patient_state import PatientState

COLS = CONTRACTS["raw_encounters"][1]


def _write(d, name, lines):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _enc(i, p="P1"):
    return json.dumps({"Id": i, "START": "2022-01-10T00:00:00Z", "STOP": "2022-01-11T00:00:00Z",
                       "PATIENT": p, "ENCOUNTERCLASS": "inpatient", "TOTAL_CLAIM_COST": "10.00"})


def test_stream_exactly_once_rejects_and_replay(spark, tmp_path):
    src = str(tmp_path / "src")
    t = StreamTargets(str(tmp_path / "raw_enc"), str(tmp_path / "dead"), str(tmp_path / "metrics"),
                      audit_path=str(tmp_path / "audit"))
    ck = str(tmp_path / "ck")
    _write(src, "a.json", [_enc("E1"), _enc("E2", "P2"), _enc("E1")])  # in-batch duplicate
    q = start_ingest(spark, src, "raw_encounters", COLS, t, checkpoint=ck)
    q.awaitTermination()
    assert spark.read.parquet(t.table_path).count() == 2
    from carespark.streaming.ingest import progress_metrics

    assert sum(m["input_rows"] for m in progress_metrics(q)) == 3
    # replayed file (same rows under a new name), an unknown field and a malformed line
    _write(src, "b.json", [_enc("E1"), _enc("E3"),
                           json.dumps({"Id": "E4", "START": "2022-01-01", "NEWFIELD": "x"}),
                           "{not json"])
    q = start_ingest(spark, src, "raw_encounters", COLS, t, checkpoint=ck)
    q.awaitTermination()
    raw = spark.read.parquet(t.table_path)
    assert sorted(r.Id for r in raw.collect()) == ["E1", "E2", "E3"]
    dead = spark.read.parquet(t.dead_letter_path)
    reasons = sorted(r.reason for r in dead.collect())
    assert reasons[0] == "malformed json" and reasons[1].startswith("unknown field: NEWFIELD")
    # restarting on the same checkpoint with nothing new adds nothing
    q = start_ingest(spark, src, "raw_encounters", COLS, t, checkpoint=ck)
    q.awaitTermination()
    assert spark.read.parquet(t.table_path).count() == 3
    m = spark.read.parquet(t.metrics_path)
    assert m.agg(F.sum("rows_appended")).first()[0] == 3
    assert spark.read.parquet(t.audit_path).count() >= 2
    # after a contract version adds the field, the dead letter can be replayed
    still_bad = replay_dead_letters(spark, "raw_encounters", COLS + ["NEWFIELD"], t)
    assert still_bad.count() == 1  # the malformed line stays dead
    assert sorted(r.Id for r in spark.read.parquet(t.table_path).collect()) == ["E1", "E2", "E3", "E4"]


def test_rescore_touched_only(spark, tmp_path):
    import numpy as np

    from carespark import codes
    from carespark.plans import risk as R
    from carespark.streaming.ingest import process_batch, rescore_touched

    feats = spark.createDataFrame(
        [(f"P{i}", *[float(v) for v in np.random.default_rng(i).random(len(codes.RISK_FEATURES))], i % 2)
         for i in range(1, 11)],
        "patient_id string, " + ", ".join(f"{c} double" for c in codes.RISK_FEATURES) + ", label int",
    ).withColumn("patient_key", F.monotonically_increasing_id())
    model = R.fit(feats, 10)
    score_path = str(tmp_path / "scores")
    cb = rescore_touched(lambda ids: feats.join(ids, "patient_id", "left_semi"), model, score_path, buckets=4)
    t = StreamTargets(str(tmp_path / "raw"), str(tmp_path / "dead"), str(tmp_path / "m"), on_touched=[cb])
    msgs = spark.createDataFrame([(_enc("E1", "P1"), "f"), (_enc("E2", "P2"), "f")], "value string, source_file string")
    process_batch(msgs, 0, "raw_encounters", COLS, t)
    assert sorted(r.patient_id for r in spark.read.parquet(score_path).collect()) == ["P1", "P2"]
    msgs2 = spark.createDataFrame([(_enc("E3", "P3"), "f"), (_enc("E4", "P1"), "f")], "value string, source_file string")
    process_batch(msgs2, 1, "raw_encounters", COLS, t)
    s = {r.patient_id: r.scored_batch for r in spark.read.parquet(score_path).collect()}
    assert s == {"P1": 1, "P2": 0, "P3": 1}


def test_one_stream_per_entity(spark, tmp_path):
    from carespark.streaming.ingest import start_all_entities

    src = tmp_path / "topics"
    _write(str(src / "raw_encounters"), "a.json", [_enc("E1"), _enc("E2")])
    _write(str(src / "raw_patients"), "a.json", [json.dumps({"ID": "P1", "GENDER": "F"})])
    sub = {k: CONTRACTS[k] for k in ["raw_encounters", "raw_patients"]}
    qs = start_all_entities(spark, str(src), str(tmp_path / "raw"), contracts=sub)
    for q in qs.values():
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "raw" / "raw_encounters" / "data")).count() == 2
    assert spark.read.parquet(str(tmp_path / "raw" / "raw_patients" / "data")).first().ID == "P1"


class Crash(Exception):
    pass


def test_replay_after_a_failure_between_writes(spark, tmp_path, monkeypatch):
    import carespark.streaming.ingest as I

    batches = [[_enc("E1"), _enc("E2", "P2"), "{not json"], [_enc("E2", "P2"), _enc("E3", "P3"), _enc("E3", "P3"), "{bad"]]

    def frame(lines):
        return spark.createDataFrame([(x, "f") for x in lines], "value string, source_file string")

    def run(root, fail_at=None):
        """Process both batches; the second fails at write number ``fail_at`` (or in the callback) and is replayed."""
        seen, real, count = [], I._write_batch, [0]
        t = StreamTargets(*(str(root / n) for n in ("data", "dead", "metrics")), audit_path=str(root / "audit"), index_buckets=2, state=PatientState(str(root / "state"), 2),
                          on_touched=[lambda ids, b: seen.append((b, sorted(r.patient_id for r in ids.collect())))])
        I.process_batch(frame(batches[0]), 0, "raw_encounters", COLS, t)

        def write(df, path, batch_id):
            if count[0] == fail_at:
                raise Crash
            count[0] += 1
            real(df, path, batch_id)

        if fail_at is not None:
            monkeypatch.setattr(I, "_write_batch", write)
            try:
                I.process_batch(frame(batches[1]), 1, "raw_encounters", COLS, t)
                raise AssertionError("no failure")
            except Crash:
                pass
            monkeypatch.setattr(I, "_write_batch", real)
        I.process_batch(frame(batches[1]), 1, "raw_encounters", COLS, t)
        tables = [sorted(map(str, spark.read.parquet(p).collect())) for p in (
            t.table_path, t.dead_letter_path, t.metrics_path, t.duplicates_path, t.index.keys_path, t.index.filters_path)]
        tables.append(sorted(map(str, t.state.current().collect())))
        assert seen[-1] == (1, ["P2", "P3"])
        return tables

    want = run(tmp_path / "plain")
    # of the second batch one row is stored already, one repeats the row before it
    assert [len(x) for x in want[:5]] == [3, 2, 2, 2, 3] and len(want[6]) == 3
    for n in (1, 2, 3):
        assert run(tmp_path / f"fail{n}", n) == want


def _rows(spark, rows, cols):
    return spark.createDataFrame([(json.dumps({k: v for k, v in zip(cols, r) if v is not None}), "f") for r in rows],
                                 "value string, source_file string")


def test_no_episode_is_lost_whatever_the_batches(spark, tmp_path):
    import carespark.streaming.ingest as I

    table = "raw_medications"
    cols = CONTRACTS[table][1]
    names = ["PATIENT", "CODE", "START", "ENCOUNTER", "TOTALCOST"]
    rows = [("P1", "c", "2022-01-01", "E1", "10"), ("P1", "c", "2022-01-01", "E2", "99"), ("P1", "c", "2022-01-01", "E1", "10"),
            ("P1", "c", "2022-01-01", None, "10"), ("P1", "c", "2022-01-01", None, "10"), ("P2", "c", "2022-01-01", "E3", "")]
    stored = []
    for n, cuts in enumerate(([6], [1, 2, 4, 6])):
        t = StreamTargets(*(str(tmp_path / f"{n}-{x}") for x in ("data", "dead", "metrics")), index_buckets=3)
        at = 0
        for b, end in enumerate(cuts):
            I.process_batch(_rows(spark, rows[at:end], names), b, table, cols, t)
            at = end
        stored.append(sorted(str([r[c] for c in names]) for r in spark.read.parquet(t.table_path).collect()))
        m = spark.read.parquet(t.metrics_path).agg(*[F.sum(f"rows_{x}") for x in ("in", "appended", "rejected", "duplicate")]).first()
        assert tuple(m) == (6, 4, 0, 2)
        assert spark.read.parquet(t.duplicates_path).agg(F.sum("occurrences")).first()[0] == 2
    assert all(s == stored[0] for s in stored) and len(stored[0]) == 4


def test_conflicting_rows_of_one_id_are_kept_apart(spark, tmp_path):
    import carespark.streaming.ingest as I

    t = StreamTargets(*(str(tmp_path / x) for x in ("data", "dead", "metrics")), index_buckets=3)
    rows = [("E1", "P1", "a"), ("E1", "P1", "b"), ("E1", "P1", "b"), ("E1", "P1", "a"), ("E2", "P1", "a")]
    I.process_batch(_rows(spark, rows, ["Id", "PATIENT", "ENCOUNTERCLASS"]), 0, "raw_encounters", COLS, t)
    I.process_batch(_rows(spark, rows[:1], ["Id", "PATIENT", "ENCOUNTERCLASS"]), 1, "raw_encounters", COLS, t)
    assert spark.read.parquet(t.table_path).count() == 2
    dup = spark.read.parquet(t.duplicates_path).collect()
    assert sorted((r.Id, r.ENCOUNTERCLASS, r.kind, r.occurrences, r.batch_id) for r in dup) == [
        ("E1", "a", "repeat", 1, 0), ("E1", "a", "stored", 1, 1), ("E1", "b", "conflict", 2, 0)]


def test_index_reads_only_the_folders_that_may_hold_a_row(spark, tmp_path):
    from carespark.streaming.key_index import KeyIndex, identity

    index = KeyIndex(str(tmp_path / "index"), buckets=32)

    def ids(a, b):
        return spark.range(a, b).select(F.col("id").cast("string").alias("Id")).select(identity(["Id"]).alias("digest"))

    for batch in range(3):
        index.add(ids(batch * 5000, batch * 5000 + 5000), batch)
    # nothing is missed
    assert index.stored(ids(0, 15_000), 9).intersect(ids(0, 15_000)).count() == 15_000
    # five known ids of batch 1 among five unknown ones: few of the 96 folders, all of batch 1's that hold them
    asked = ids(7000, 7005).unionAll(ids(90_000, 90_005))
    stored = index.stored(asked, 9)
    places = index.places(asked, 9)
    assert {(1, r[0]) for r in asked.limit(5).select(index._bucket()).collect()} <= set(places) and len(places) <= 8
    assert len(stored.inputFiles()) <= 3 * 96 and stored.count() < 15_000 / 96 * 9
    scan = [line for line in stored._jdf.queryExecution().explainString(
        stored.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).splitlines() if "PartitionFilters" in line]
    assert scan and "bucket" in scan[0]
    assert asked.join(stored, "digest", "left_semi").count() == 5
    # a batch never asks itself, and replaces what it left
    assert not [p for p in index.places(ids(5000, 10_000), 1) if p[0] == 1]
    index.add(ids(0, 10), 1)
    assert spark.read.parquet(index.keys_path).where("batch_id = 1").count() >= 10


def test_state_features_equal_those_of_all_rows_and_read_no_fact(spark, tmp_path):
    import random

    from carespark import codes
    from carespark.plans.features import patient_features
    from carespark.streaming.ingest import process_batch
    from carespark.streaming.patient_state import PatientState

    rng = random.Random(8)
    state = PatientState(str(tmp_path / "state"), buckets=4)
    sets = {"diabetes": ["1"], "heart_failure": ["2"], "hypertension": ["3"], "copd_asthma": ["4"]}
    options = {"condition_sets": sets, "as_of": "2024-01-01"}
    rows = {
        "raw_patients": (["ID", "BIRTHDATE", "GENDER", "HEALTHCARE_EXPENSES"],
                         [(f"P{i}", f"19{50 + i}-02-03", rng.choice("MF"), f"{i}.25") for i in range(8)] + [("P8", None, None, None)]),
        "raw_encounters": (["Id", "PATIENT", "START", "TOTAL_CLAIM_COST"],
                           [(f"E{i}", f"P{rng.randrange(11)}", "2022-01-01", rng.choice(["0.10", "bad", "33.33"])) for i in range(60)]),
        "raw_conditions": (["PATIENT", "CODE", "START"], [(f"P{rng.randrange(11)}", str(rng.randrange(6)), f"2022-01-0{rng.randrange(1, 9)}") for _ in range(50)]),
    }
    seen = []
    for table, (names, data) in rows.items():
        t = StreamTargets(*(str(tmp_path / table / x) for x in ("data", "dead", "metrics")), index_buckets=2, state=state,
                          on_touched=[lambda ids, b: seen.append(state.features(ids, **options).count())])
        for b, part in enumerate((data[:30], data[20:])):
            if part:
                process_batch(_rows(spark, part, names), b, table, CONTRACTS[table][1], t)

    def cells(df):
        return sorted((r.patient_id, *[round(r[c], 9) for c in codes.RISK_FEATURES]) for r in df.collect())

    def raw(table):
        names, data = rows[table]
        return spark.createDataFrame(data, ", ".join(f"{n} string" for n in names)).dropDuplicates()

    want = cells(patient_features(
        raw("raw_patients").select(F.col("ID").alias("patient_key"), F.col("ID").alias("patient_id"), F.col("BIRTHDATE").cast("date").alias("birthdate"),
                                   F.col("GENDER").alias("gender"), F.col("HEALTHCARE_EXPENSES").cast("decimal(18,2)").alias("healthcare_expenses")),
        raw("raw_encounters").select(F.col("PATIENT").alias("patient_key"), F.expr("try_cast(TOTAL_CLAIM_COST as decimal(18,2))").alias("total_claim_cost")),
        raw("raw_conditions").select(F.col("PATIENT").alias("patient_key"), F.col("CODE").alias("code")), **options))
    got = state.features(**options)
    assert cells(got) == want and len(want) == 9 and seen
    assert all("/state/" in f for f in got.inputFiles())
    # folding old batches changes nothing, also when repeated and when a batch comes after it
    state.merge_up_to(spark, {"raw_encounters": 0})
    assert cells(state.features(**options)) == want
    state.merge_up_to(spark, {"raw_encounters": 1, "raw_patients": 0, "raw_conditions": 1})
    assert cells(state.features(**options)) == want
    one = state.features(spark.createDataFrame([("P3",), ("P10",), ("P3",)], "patient_id string"), **options)
    assert cells(one) == [r for r in want if r[0] == "P3"]


def test_replay_shows_its_patients_to_the_callbacks(spark, tmp_path):
    import carespark.streaming.ingest as I

    seen = []
    t = StreamTargets(*(str(tmp_path / x) for x in ("data", "dead", "metrics")), index_buckets=2,
                      on_touched=[lambda ids, b: seen.append((b, sorted(r.patient_id for r in ids.collect())))])
    strange = json.dumps({"Id": "E2", "PATIENT": "P2", "START": "2022-01-01", "NEW": "x"})
    I.process_batch(spark.createDataFrame([(_enc("E1"), "f"), (strange, "f"), ("{bad", "f")], "value string, source_file string"),
                    0, "raw_encounters", COLS, t)
    for _ in range(2):      # a replay may be repeated
        assert replay_dead_letters(spark, "raw_encounters", COLS + ["NEW"], t).count() == 1
        assert sorted(r.Id for r in spark.read.parquet(t.table_path).select("Id").collect()) == ["E1", "E2"]
    assert seen == [(0, ["P1"]), (-1, ["P2"]), (-1, ["P2"])]


def test_starters_pass_the_broker_source(monkeypatch):
    import carespark.streaming.ingest as I

    asked = []
    monkeypatch.setattr(I, "start_ingest", lambda spark, source, table, cols, targets, **kw: asked.append((source, kw["source_format"], kw["kafka_servers"])))
    I.start_all_entities(None, "clinic", "/out", contracts={"raw_patients": CONTRACTS["raw_patients"]}, source_format="kafka", kafka_servers="h:1")
    assert asked == [("clinic.raw_patients", "kafka", "h:1")]


def test_index_of_a_large_batch_has_more_buckets(spark, tmp_path):
    from carespark.streaming.key_index import BUCKET, DIGEST, KeyIndex, identity

    def keys(lo, hi):
        return spark.range(lo, hi).select(identity(["id"]).alias(DIGEST))

    index = KeyIndex(str(tmp_path / "index"), buckets=2, bucket_keys=20)
    index.add(keys(0, 400), 0)
    index.add(keys(400, 410), 1)        # a small one: the index's own number
    sizes = {(r[0], r[1]): r["count"] for r in spark.read.parquet(index.keys_path).groupBy("batch_id", BUCKET).count().collect()}
    assert sum(b == 0 for b, _ in sizes) > 2 and max(n for (b, _), n in sizes.items() if b == 0) < 60
    assert {k for b, k in sizes if b == 1} <= {0, 1}
    asked = keys(390, 405)
    found = index.stored(asked, 2).join(asked, DIGEST, "left_semi")
    assert found.count() == 15
    assert index.stored(asked, 1).join(asked, DIGEST, "left_semi").count() == 10    # a batch never asks its own


def test_messages_are_parsed_once(spark):
    from carespark.streaming.ingest import validate_messages

    msgs = spark.createDataFrame([('{"PATIENT":"P","CODE":"1","START":"2020"}', "a"), ('{"PATIENT":"P","CODE":"","START":"2020"}', "a"),
                                  ('{"PATIENT":"P","X":"1"}', "a"), ("{no", "a")], "value string, source_file string")
    cols = ["START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION"]
    got = validate_messages(msgs.repartition(1), "raw_conditions", cols)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert got.columns == ["value", "source_file", "row", "reason"]
    assert sorted(str(r.reason) for r in got.collect()) == ["None", "malformed json", "missing natural key", "unknown field: X"]


def test_conflicts_repeats_and_stored_rows_are_counted_beside_nulls(spark, tmp_path):
    from carespark.streaming.ingest import process_batch

    t = StreamTargets(str(tmp_path / "raw"), str(tmp_path / "dead"), str(tmp_path / "metrics"))
    a, b = json.dumps({"Id": "E1", "PATIENT": "P1"}), json.dumps({"Id": "E1", "PATIENT": "P2", "START": "2022"})

    def batch(lines):
        return spark.createDataFrame([(x, "f") for x in lines], "value string, source_file string")

    process_batch(batch([a, b, a, a, b]), 0, "raw_encounters", COLS, t)
    process_batch(batch([b, b, _enc("E2")]), 1, "raw_encounters", COLS, t)
    got = {(r.batch_id, r.PATIENT, r.kind): r.occurrences for r in spark.read.parquet(t.duplicates_path).collect()}
    kept = {r.Id: r.PATIENT for r in spark.read.parquet(t.table_path).collect()}
    # NULL comes first in START: the row without it is kept, once
    assert kept == {"E1": "P1", "E2": "P1"}
    assert got == {(0, "P1", "repeat"): 2, (0, "P2", "conflict"): 2, (1, "P2", "stored"): 2}


def _stage_names(spark):
    from carespark.session import STAGE_ROOT, ensure_checkpoint_dir

    folder = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), STAGE_ROOT, spark.sparkContext.applicationId)
    return sorted(os.listdir(folder)) if os.path.exists(folder) else []


def test_a_batch_stores_a_message_once_and_leaves_no_stage(spark, tmp_path, monkeypatch):
    from contextlib import contextmanager

    from carespark import session
    from carespark.streaming.ingest import process_batch

    seen, real = [], session.staged

    @contextmanager
    def staged(df, name="stage", rows_per_file=None):
        with real(df, name, rows_per_file) as out:
            seen.append((name, out.columns, [r.asDict() for r in out.collect()]))
            yield out

    monkeypatch.setattr(session, "staged", staged)
    before, key = _stage_names(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    cleanup = spark.conf.get(key, None)
    held = []
    t = StreamTargets(str(tmp_path / "raw"), str(tmp_path / "dead"), str(tmp_path / "metrics"),
                      on_touched=[lambda ids, b: held.append((len(_stage_names(spark)) - len(before), spark.conf.get(key)))])
    for batch, lines in enumerate(([_enc("E1"), _enc("E1"), "{bad"], [_enc("E1"), _enc("E2")])):
        process_batch(spark.createDataFrame([(x, "f") for x in lines], "value string, source_file string"), batch, "raw_encounters", COLS, t)
    assert [n for n, _, _ in seen] == ["stream-raw_encounters", "stream-raw_encounters-rows"] * 2
    assert sorted(str(r["value"]) for r in seen[0][2]) == ["None", "None", "{bad"]      # the text of rejected ones only
    assert "digest" not in seen[1][1] and [(r["kept"], r["occurrences"]) for r in seen[1][2]] == [(True, 1)]
    assert sorted((r["Id"], r["kept"], r["occurrences"], r["kind"]) for r in seen[3][2] if not r["kept"]) == [("E1", False, 1, "stored")]
    # while a batch runs its messages are there, and shuffles go with their query; nothing stays
    assert held == [(1, "true")] * 2 and _stage_names(spark) == before and spark.conf.get(key, None) == cleanup


def test_a_batch_is_shuffled_once_before_its_rows_are_decided(spark):
    from carespark.streaming.ingest import _decided

    cols = CONTRACTS["raw_conditions"][1]
    good = spark.createDataFrame([(*["x"] * len(cols), "f"), (*["x"] * len(cols), "g"), (*["x"] * len(cols), "g")],
                                 ", ".join(f"{c} string" for c in [*cols, "_source_file"]))
    got = _decided(good, 3, None, cols, cols)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange ") == 1 and "digest" not in plan
    assert sorted((r["_source_file"], r.kept, r.occurrences, r.kind) for r in got.collect()) == [
        ("f", True, 0, "repeat"), ("g", False, 2, "repeat")]


def test_index_of_longer_digests_is_still_known(spark, tmp_path):
    """Batches that an older version stored: 32 bytes a key, filters made of them."""
    from carespark.streaming.key_index import DIGEST, DIGEST_BYTES, KeyIndex, identity

    index = KeyIndex(str(tmp_path / "index"), buckets=2)
    ids = spark.range(20).select(F.col("id").cast("string").alias("Id"))
    old = ids.select(F.unhex(F.sha2(F.to_json(F.struct("Id")), 256)).alias(DIGEST), F.pmod(F.col("Id").cast("int"), F.lit(2)).alias("bucket"),
                     F.lit(0).cast("long").alias("batch_id"))
    old.write.partitionBy("batch_id", "bucket").parquet(index.keys_path)
    spark.createDataFrame([(b, [0], 0) for b in range(2)], "bucket int, words array<long>, batch_id long").write.partitionBy("batch_id") \
        .parquet(index.filters_path)    # filters that know none of the shorter digests
    asked = spark.range(15, 25).select(F.col("id").cast("string").alias("Id")).select(identity(["Id"]).alias(DIGEST))
    assert {len(r[0]) for r in asked.collect()} == {DIGEST_BYTES}
    assert index.stored(asked, 1).join(asked, DIGEST, "left_semi").count() == 5
    index.add(asked.join(index.stored(asked, 1), DIGEST, "left_anti"), 1)
    assert index.stored(asked, 2).join(asked, DIGEST, "left_semi").count() == 10


def test_a_large_batch_does_not_ask_the_filters(spark, tmp_path):
    from carespark.streaming.key_index import DIGEST, KeyIndex, identity

    index = KeyIndex(str(tmp_path / "index"), buckets=2)
    keys = lambda lo, hi: spark.range(lo, hi).select(identity(["id"]).alias(DIGEST))
    index.add(keys(0, 200), 0)
    few = keys(1000, 1002)
    assert len(index.places(few, 1, 2)) < 2 and index.places(few, 1, 10**6) == [(0, 0), (0, 1)]


def test_delivered_messages_are_compressed_and_whole(spark, tmp_path, monkeypatch):
    from carespark.plans import catalog_stream as S

    monkeypatch.setattr(S, "MESSAGES", 3)
    lines = [_enc(f"E{i}") for i in range(10)]
    for part in (lines[:7], lines[7:]):
        S._write_messages(spark.createDataFrame([(x,) for x in part], "value string").coalesce(1), str(tmp_path / "in"))
    files = [f for f in os.listdir(tmp_path / "in") if f.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".gz") for f in files)
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "in")).collect()) == sorted(lines)


def test_state_collects_each_code_once(spark, tmp_path):
    state = PatientState(str(tmp_path / "state"), 2)
    rows = spark.createDataFrame([("P1", "a"), ("P1", "a"), ("P1", "b"), ("P2", None)], "PATIENT string, CODE string")
    state.add(rows, "raw_conditions", 0)
    assert {r.patient_id: sorted(r.codes) for r in state.current().collect()} == {"P1": ["a", "b"], "P2": []}
