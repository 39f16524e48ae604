"""Registered queries: the landing of CSV files, from files printed from the given tables.

Each query prints tables to CSV below the session's work folder, lands them with
``load_raw`` and returns what arrived, so the rows follow the given tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespark.plans import legacy as L
from carespark.plans import marts as M
from carespark.plans.catalog import T, register
from carespark.sources.contracts import CONTRACTS
from carespark.sources.csv_ingest import load_raw
from carespark.sources.driver import sql_with
from carespark.sources.driver_raw import raw_tables, star_sql_ctes


FILE_LINES = 250_000    # records of a printed file


def _raw_sql(tables: list[str], body: str) -> str:
    return sql_with(["patient", "encounter"], body, extra=star_sql_ctes(tables))


def _write_csv(df: DataFrame, folder: str, name: str) -> None:
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(f"{folder}/{name}")


def _write_lines(lines: DataFrame, header: list[str], folder: str, name: str) -> None:
    """Ready lines, each part file with a header line before its first one. The files are compressed; such
    a file is read by one task, hence many of them."""
    line = F.col(lines.columns[0])
    first = F.monotonically_increasing_id() % (1 << 33) % FILE_LINES == 0
    lines.select(F.when(first, F.concat(F.lit(",".join(header) + "\n"), line)).otherwise(line)).write.mode("overwrite").option(
        "lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).text(f"{folder}/{name}")


@register("csv_landing", _raw_sql(["raw_encounters"], """SELECT "Id" AS encounter_id, "START" AS start_text, "PATIENT" AS patient_id,
  "ENCOUNTERCLASS" AS encounter_class, "TOTAL_CLAIM_COST" AS cost_text, "REASONCODE" AS reason_code FROM raw_encounters"""))
def q_csv_landing(spark, sf_dir):
    """SRC-01/02/03: encounters printed with their columns in reverse order land by header name, as text."""
    raw = raw_tables(T(spark, sf_dir))["raw_encounters"].drop("_source_file")
    folder = M.work_dir(spark, "csv-landing")
    _write_csv(raw.select(*reversed(raw.columns)), folder, "encounters.csv")
    landed = load_raw(spark, folder, f"{folder}/raw", contracts={"raw_encounters": CONTRACTS["raw_encounters"]}).tables["raw_encounters"]
    return landed.select(F.col("Id").alias("encounter_id"), F.col("START").alias("start_text"), F.col("PATIENT").alias("patient_id"),
                         F.col("ENCOUNTERCLASS").alias("encounter_class"), F.col("TOTAL_CLAIM_COST").alias("cost_text"),
                         F.col("REASONCODE").alias("reason_code"))


_LINE_SQL = """SELECT CASE WHEN l_orderkey % 13 = 0 THEN l_orderkey || ',' || l_linenumber
  WHEN l_orderkey % 17 = 0 THEN l_orderkey || ',' || l_linenumber || ',' || l_partkey || ',extra'
  ELSE l_orderkey || ',' || l_linenumber || ',' || l_partkey END AS line,
  l_orderkey % 13 = 0 OR l_orderkey % 17 = 0 AS bad FROM lineitem"""


@register("csv_rejects", f"SELECT line, bad FROM ({_LINE_SQL})")
def q_csv_rejects(spark, sf_dir):
    """SRC-05: lines with a field too few or too many go to the rejects as they are, all others land."""
    li = T(spark, sf_dir).raw("lineitem")
    k = F.col("l_orderkey")
    cols = ["l_orderkey", "l_linenumber", "l_partkey"]
    text = F.concat_ws(",", *[F.col(c).cast("string") for c in cols])
    line = F.when(k % 13 == 0, F.concat_ws(",", k.cast("string"), F.col("l_linenumber").cast("string"))) \
        .when(k % 17 == 0, F.concat(text, F.lit(",extra"))).otherwise(text)
    folder = M.work_dir(spark, "csv-rejects")
    _write_lines(li.select(line), cols, folder, "lines.csv")
    got = load_raw(spark, folder, f"{folder}/raw", contracts={"lines": ("lines.csv", cols)})
    return got.tables["lines"].select(F.concat_ws(",", *cols).alias("line"), F.lit(False).alias("bad")).unionAll(
        got.rejected.select("line", F.lit(True).alias("bad")))


@register("load_twice", _raw_sql(["raw_patients", "raw_providers"], """SELECT 'raw_patients' AS table_name, COUNT(*) AS first_rows,
  'skipped' AS second_status, CAST(0 AS BIGINT) AS second_rows, COUNT(*) AS rows_stored FROM raw_patients
UNION ALL SELECT 'raw_providers', COUNT(*), 'skipped', 0, COUNT(*) FROM raw_providers"""))
def q_load_twice(spark, sf_dir):
    """SRC-04/07: a second load of the same files inserts nothing."""
    raw = raw_tables(T(spark, sf_dir))
    folder = M.work_dir(spark, "load-twice")
    names = ["raw_patients", "raw_providers"]
    for n in names:
        _write_csv(raw[n].drop("_source_file"), folder, CONTRACTS[n][0])
    contracts = {n: CONTRACTS[n] for n in names}
    first = load_raw(spark, folder, f"{folder}/raw", contracts=contracts).report
    again = load_raw(spark, folder, f"{folder}/raw", contracts=contracts)
    stored = reduce(lambda a, b: a.unionAll(b), [
        d.groupBy().agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows_stored")) for n, d in again.tables.items()])
    return first.select("table_name", F.col("rows_in").alias("first_rows")).join(
        again.report.select("table_name", F.col("status").alias("second_status"), F.col("rows_in").alias("second_rows")), "table_name"
    ).join(stored, "table_name")


# All columns of the given tables; the first decides which lines come damaged.
LOAD_KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
    "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id", "embeddings": "vec_id",
    "pages": "page_id", "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id",
}
DAMAGED = 19


def _quoted(c: str):
    """A column as a quoted CSV field: quotes within are doubled; NULL is an empty field."""
    text = F.col(c).cast("string")
    return F.coalesce(F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))


def _write_quoted(df: DataFrame, folder: str, name: str, damaged=None) -> list[str]:
    """All columns of a frame as CSV lines, each part file with a header; ``damaged`` rows get a field too many."""
    line = F.concat_ws(",", *[_quoted(c) for c in df.columns])
    if damaged is not None:
        line = F.when(damaged, F.concat(line, F.lit(",damaged"))).otherwise(line)
    _write_lines(df.select(line), df.columns, folder, name)
    return df.columns


@register("load_report", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, '{n}.csv' AS file_name, count_if({c} % {DAMAGED} <> 1)::BIGINT AS rows_in,"
    f" count_if({c} % {DAMAGED} = 1)::BIGINT AS rows_rejected, 'loaded' AS status FROM {n}" for n, c in LOAD_KEYS.items()))
def q_load_report(spark, sf_dir):
    """SRC-06: what ``load_raw`` reports of every given table, all columns quoted, some records being damaged."""
    t = T(spark, sf_dir)
    folder = M.work_dir(spark, "load-report")
    contracts = {n: (f"{n}.csv", _write_quoted(t.raw(n), folder, f"{n}.csv", F.col(key) % DAMAGED == 1)) for n, key in LOAD_KEYS.items()}
    return load_raw(spark, folder, f"{folder}/raw", contracts=contracts).report


@register("csv_multiline", """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, sha256(replace(text, chr(13) || chr(10), chr(10))) AS text_sha256,
  CAST(n_chars AS VARCHAR) AS n_chars FROM documents""")
def q_csv_multiline(spark, sf_dir):
    """SRC-01/07: whole texts with line breaks, quotes and commas land as they were printed."""
    docs = T(spark, sf_dir).raw("documents")
    folder = M.work_dir(spark, "csv-multiline")
    cols = _write_quoted(docs, folder, "documents.csv")
    got = load_raw(spark, folder, f"{folder}/raw", contracts={"documents": ("documents.csv", cols)}).tables["documents"]
    return got.select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_sha256"), "n_chars")


@register("wide_code_dictionary", """SELECT code, COUNT(*) AS uses FROM (
  SELECT p_brand AS code FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT p_name FROM part)
WHERE code IS NOT NULL AND trim(code) <> '' GROUP BY code""")
def q_wide_code_dictionary(spark, sf_dir):
    """STR-11: the codes found in any of several wide columns, with how many rows use each."""
    long = L.unpivot_wide(T(spark, sf_dir).raw("part"), ["p_partkey"], ["p_brand", "p_type", "p_name"])
    return L.code_dictionary_from_wide(long)
