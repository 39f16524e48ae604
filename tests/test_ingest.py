"""CSV landing: lineage, idempotent ledger, rejects, by-name binding (SRC-01..09)."""

import os
import time

from pyspark.sql import functions as F

from carespark.sources.contracts import CONTRACTS, ENCOUNTER_COLS
from carespark.sources.csv_ingest import load_raw, manifest, read_raw_csv
from tests.conftest import BASE, write_csv, write_fixture


def _report(res):
    return {r.table_name: (r.rows_in, r.rows_rejected, r.status) for r in res.report.collect()}


def test_load_one_row_per_table_and_lineage(spark, tmp_path):
    d = write_fixture(tmp_path / "in", BASE)
    res = load_raw(spark, d, str(tmp_path / "raw"))
    rep = _report(res)
    assert all(rep[t][0] == 1 for t in CONTRACTS), rep
    enc = res.tables["raw_encounters"]
    assert enc.columns == ENCOUNTER_COLS + ["_source_file"]
    assert enc.first()["_source_file"] == "encounters.csv"
    # zip leading zero survives (all text)
    assert res.tables["raw_patients"].first()["ZIP"] == "01101"


def test_second_load_inserts_nothing(spark, tmp_path):
    d = write_fixture(tmp_path / "in", BASE)
    load_raw(spark, d, str(tmp_path / "raw"))
    res2 = load_raw(spark, d, str(tmp_path / "raw"))
    assert all(v[0] == 0 and v[2] == "skipped" for v in _report(res2).values())
    assert res2.tables["raw_patients"].count() == 1


def test_same_name_new_content_is_loaded(spark, tmp_path):
    d = write_fixture(tmp_path / "in", BASE)
    load_raw(spark, d, str(tmp_path / "raw"))
    time.sleep(1.1)
    rows = BASE["patients.csv"] + [{**BASE["patients.csv"][0], "ID": "second"}]
    write_csv(d, "patients.csv", rows)
    res = load_raw(spark, d, str(tmp_path / "raw"))
    assert _report(res)["raw_patients"][0] == 2  # ledger keyed on name + size + time


def test_missing_file_reports_zero(spark, tmp_path):
    d = write_fixture(tmp_path / "in", {k: v for k, v in BASE.items() if k != "providers.csv"})
    res = load_raw(spark, d, str(tmp_path / "raw"))
    assert _report(res)["raw_providers"] == (0, 0, "missing")


def test_malformed_rows_go_to_rejects_and_quotes_survive(spark, tmp_path):
    d = tmp_path / "in"
    os.makedirs(d)
    cols = CONTRACTS["raw_conditions"][1]
    with open(d / "conditions.csv", "w") as fh:
        fh.write(",".join(cols) + "\n")
        fh.write('2020-01-01,,P1,E1,123,"Pain, chronic ""severe"""\n')  # quoted comma + quote
        fh.write("2020-01-01,,P1,E1,124\n")  # one field missing
        fh.write("2020-01-01,,P1,E1,125,desc,extra\n")  # one extra
    good, bad = read_raw_csv(spark, str(d / "conditions.csv"), cols)
    g = good.collect()
    assert len(g) == 1 and g[0]["DESCRIPTION"] == 'Pain, chronic "severe"'
    assert bad.count() == 2


def test_columns_bound_by_header_name(spark, tmp_path):
    d = tmp_path / "in"
    os.makedirs(d)
    cols = CONTRACTS["raw_conditions"][1]
    shuffled = list(reversed(cols))
    write_csv(d, "conditions.csv", [{"START": "2020-01-01", "PATIENT": "P9", "CODE": "1",
                                     "DESCRIPTION": "x", "ENCOUNTER": "E9"}], cols=shuffled)
    good, _ = read_raw_csv(spark, str(d / "conditions.csv"), cols)
    r = good.first()
    assert r["PATIENT"] == "P9" and r["START"] == "2020-01-01" and good.columns[:6] == cols


def test_manifest(spark, tmp_path):
    d = write_fixture(tmp_path / "in", BASE)
    m = manifest(spark, [os.path.join(d, "patients.csv")], "fixture")
    r = m.first()
    assert r.source == "fixture" and r.file_size > 0 and r.file_mtime is not None


def test_multi_file_source_with_year_from_name(spark, tmp_path):
    from carespark.plans.legacy import read_claim_files

    d = tmp_path / "in"
    os.makedirs(d)
    cols = CONTRACTS["raw_patients"][1]
    p1 = write_csv(d, "patients.csv", [{"ID": "a"}])
    os.rename(p1, d / "beneficiary_2008.csv")
    p2 = write_csv(d, "patients.csv", [{"ID": "b"}, {"ID": "c"}])
    os.rename(p2, d / "beneficiary_2009.csv")
    df = read_claim_files(spark, [str(d / "beneficiary_2008.csv"), str(d / "beneficiary_2009.csv")], cols)
    got = sorted((r.ID, r.file_year) for r in df.select("ID", "file_year").collect())
    assert got == [("a", 2008), ("b", 2009), ("c", 2009)]
    assert df.where(F.col("_source_file").isNull()).count() == 0


def test_ensure_raw_tables(spark, tmp_path):
    from carespark.sources.csv_ingest import ensure_raw_tables

    raw = str(tmp_path / "raw")
    assert len(ensure_raw_tables(spark, raw)) == 5
    assert ensure_raw_tables(spark, raw) == []
    assert spark.read.parquet(raw + "/raw_patients").columns[-1] == "_source_file"


def test_load_survives_a_crash_before_the_ledger(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    spec = {**BASE, "patients.csv": BASE["patients.csv"] + [{**BASE["patients.csv"][0], "ID": "second"}]}
    d, raw = write_fixture(tmp_path / "in", spec), str(tmp_path / "raw")
    real = DataFrameWriter.parquet

    for stop in ("/_loads/raw_patients", "/_rejected/raw_patients", "/_ledger"):
        def parquet(self, path, *a, **k):
            if stop in path:
                if stop != "/_ledger":
                    real(self, path, *a, **k)   # the write itself ends, what follows does not
                raise RuntimeError("crash")
            return real(self, path, *a, **k)

        monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
        try:
            load_raw(spark, d, raw)
            raise AssertionError("no crash")
        except RuntimeError:
            pass
        monkeypatch.setattr(DataFrameWriter, "parquet", real)
    res = load_raw(spark, d, raw)
    assert _report(res)["raw_patients"] == (2, 0, "loaded") and res.tables["raw_patients"].count() == 2
    assert load_raw(spark, d, raw).tables["raw_patients"].count() == 2


def test_each_file_binds_by_its_own_header(spark, tmp_path):
    d = tmp_path / "in"
    os.makedirs(d)
    cols = CONTRACTS["raw_conditions"][1]
    a = write_csv(d, "conditions.csv", [{"CODE": "1", "PATIENT": "P1"}])
    os.rename(a, d / "a.csv")
    b = write_csv(d, "conditions.csv", [{"CODE": "2", "PATIENT": "P2"}], cols=list(reversed(cols)))
    os.rename(b, d / "b.csv")
    before = spark.conf.get("spark.sql.csv.parser.columnPruning.enabled")
    good, _ = read_raw_csv(spark, [str(d / "a.csv"), str(d / "b.csv")], cols)
    assert sorted((r.CODE, r.PATIENT) for r in good.collect()) == [("1", "P1"), ("2", "P2")]
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == before


def test_records_with_line_breaks_across_blocks(spark, tmp_path):
    import csv
    import io
    import random

    from carespark.sources.csv_ingest import read_raw_csv

    rng = random.Random(6)
    bits = ["a", "b,c", 'say ""x""', "\n", "\n\n", "\r\n", "é", "'", " ", ""]
    rows = [[str(i), "".join(rng.choice(bits) for _ in range(rng.randrange(12))).replace('""', '"'), rng.choice(["x", "", 'q"'])] for i in range(3000)]
    for name, part in (("a.csv", rows[:2500]), ("b.csv", rows[2500:])):
        out = io.StringIO()
        w = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\r\n" if name == "b.csv" else "\n")
        w.writerows([["id", "note", "more"], *part])
        (tmp_path / name).write_bytes(out.getvalue().encode())
    (tmp_path / "c.csv").write_text('id,note,more\n7000,plain,x\n\n7001,too,many,fields\n7002,short\n"7003","a ""b"" c",\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")      # records run over many blocks
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        good, bad = read_raw_csv(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv")], ["id", "note", "more"])
        got = sorted((int(r.id), r.note or "", r.more or "") for r in good.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    want = [(int(i), n.replace("\r\n", "\n"), m) for i, n, m in rows] + [(7000, "plain", "x"), (7003, 'a "b" c', "")]
    assert got == sorted(want)
    assert sorted((r.file_name, r.line, r.first_field) for r in bad.collect()) == [("c.csv", "7001,too,many,fields", "7001"), ("c.csv", "7002,short", "7002")]


def test_a_quote_that_is_never_closed_rejects_its_lines(spark, tmp_path, monkeypatch):
    import carespark.sources.csv_records as R

    (tmp_path / "d.csv").write_text("id,note\n1,a\n2,\"open\n" + "".join(f"{i},x\n" for i in range(3, 30)))
    rows = R.records(spark, [str(tmp_path / "d.csv")], max_lines=10).collect()
    assert [r.record for r in rows if r.well_formed] == ["1,a"] and len([r for r in rows if not r.well_formed]) == 28


def test_only_broken_records_are_stored_as_text_too(spark, tmp_path, monkeypatch):
    from carespark import session
    from carespark.sources.csv_ingest import read_raw_csv

    path = tmp_path / "x.csv"
    path.write_text('a,b\n1,"one\ntwo"\n2\n3,four\n')
    stages = {}
    write = session.stable_table
    monkeypatch.setattr(session, "stable_table", lambda df, name="stage": stages.setdefault(name, write(df, name)))
    good, rejected = read_raw_csv(spark, str(path), ["a", "b"])
    assert sorted((r.a, r.b) for r in good.collect()) == [("1", "one\ntwo"), ("3", "four")]
    assert [r.line for r in rejected.collect()] == ["2"]
    assert sorted(str(r.record) for r in stages["csv-parse"].collect()) == ["2", "None", "None"]


def test_records_within_a_block_are_joined_where_they_lie(spark, tmp_path, monkeypatch):
    """Small blocks: records over several of them, beside ones that lie within; one with too many lines comes back as lines."""
    import csv

    from carespark.sources import csv_records as R

    rows = [(str(i), "\n".join(f"line {j} of \"{i}\", é" for j in range(i % 7))) for i in range(300)]
    rows[150] = ("150", "x\n" * 40 + "x")
    path = tmp_path / "r.csv"
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh, quoting=csv.QUOTE_ALL, lineterminator="\n")
        w.writerow(("a", "b"))
        w.writerows(rows)
    stages = {}
    write = R.stable_table
    monkeypatch.setattr(R, "stable_table", lambda df, name="stage": stages.setdefault(name, write(df, name)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = R.records(spark, [str(path)], max_lines=20).collect()
        closed = stages["csv-pieces"].where("_closed").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    good = [next(csv.reader([r.record], strict=True)) if "\n" not in r.record else next(csv.reader(r.record.splitlines(True))) for r in got if r.well_formed]
    assert sorted(map(tuple, good)) == sorted(r for i, r in enumerate(rows) if i != 150)
    assert sum(not r.well_formed for r in got) == 41
    assert closed > 100


def test_a_load_stores_a_record_once(spark, tmp_path, monkeypatch):
    """No stage stays, the broken records lie beside the rows only once, and are no rows of the table."""
    from carespark import session
    from carespark.sources import csv_records

    made, real = [], session.stable_table

    def stable_table(df, name="stage", *more):
        made.append(name)
        return real(df, name, *more)

    for module in (session, csv_records):
        monkeypatch.setattr(module, "stable_table", stable_table)
    def stages():
        folder = os.path.join(session.ensure_checkpoint_dir(spark).removeprefix("file:"), session.STAGE_ROOT, spark.sparkContext.applicationId)
        return sorted(os.listdir(folder)) if os.path.exists(folder) else []

    d, raw, before = tmp_path / "in", str(tmp_path / "raw"), stages()
    os.makedirs(d)
    (d / "x.csv").write_text('b,a,more\n1,"one\ntwo",m\n2\n3,four,"m"\n"5",six,7,8\n')
    got = load_raw(spark, str(d), raw, contracts={"x": ("x.csv", ["a", "b", "absent"])})
    assert _report(got) == {"x": (2, 2, "loaded")}
    assert sorted(map(tuple, got.tables["x"].collect())) == [("four", "3", None, "x.csv"), ("one\ntwo", "1", None, "x.csv")]
    assert got.tables["x"].columns == ["a", "b", "absent", "_source_file"]
    assert sorted((r.table_name, r.file_name, r.line, r.first_field) for r in got.rejected.collect()) == [
        ("x", "x.csv", '"5",six,7,8', "5"), ("x", "x.csv", "2", "2")]
    assert set(made) == {"csv-blocks", "csv-pieces"}
    assert stages() == before
    # a folder of an older load has no column for broken records: all its rows are the table's
    stored = os.path.join(raw, "_loads", "x")
    load = os.path.join(stored, os.listdir(stored)[0])
    old = got.tables["x"].collect()
    spark.createDataFrame(old, got.tables["x"].schema).write.mode("overwrite").parquet(load)
    again = load_raw(spark, str(d), raw, contracts={"x": ("x.csv", ["a", "b", "absent"])})
    assert _report(again) == {"x": (0, 0, "skipped")} and again.tables["x"].count() == 2


def test_compressed_files_land_whole(spark, tmp_path, monkeypatch):
    """Printed CSV: several compressed files a task, each with its header, records with line breaks among them."""
    from carespark.plans import catalog_landing as L

    monkeypatch.setattr(L, "FILE_LINES", 4)
    rows = [(i, f"text {i}\n\"quoted\", é" if i % 3 else None, float(i)) for i in range(11)]
    df = spark.createDataFrame(rows, "id long, note string, v double").coalesce(1)
    cols = L._write_quoted(df, str(tmp_path), "t.csv", F.col("id") % 5 == 1)
    files = [f for f in os.listdir(tmp_path / "t.csv") if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)
    got = load_raw(spark, str(tmp_path), str(tmp_path / "raw"), contracts={"t": ("t.csv", cols)})
    assert sorted((int(r.id), r.note, float(r.v)) for r in got.tables["t"].collect()) == [r for r in rows if r[0] % 5 != 1]
    assert _report(got) == {"t": (9, 2, "loaded")} and {r.first_field for r in got.rejected.collect()} == {"1", "6"}
