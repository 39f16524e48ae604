"""CSV landing into all-string raw tables (SRC-01..09, SRC-17).

- Columns are bound **by header name**, never by position (a user schema
  would bind by position, trap T10); every value stays text.
- Records may hold line breaks in quoted fields; they are found in parallel
  (:mod:`carespark.sources.csv_records`).
- Malformed records (too few / too many fields) go to a reject table instead
  of silently disappearing (trap T9): records are parsed PERMISSIVE with a
  corrupt-record column and split into good and rejected rows.
- Each row carries the base file name (``_metadata.file_name``).
- A ledger keyed on (file name, size, modification time) makes loads
  idempotent and still picks up new content under an old name. It is the
  commit: rows of a load that it does not name are not part of any table.
- Missing files are reported with 0 rows instead of failing.

All reads are distributed Spark reads; nothing is collected except the
small per-file report and the list of candidate file paths.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carespark.sources.contracts import CONTRACTS, SOURCE_FILE_COL
from carespark.sources.csv_records import records

CORRUPT, FIRST_FIELD = "_corrupt_record", "_first_field"
LEDGER_SCHEMA = "file_name string, file_size long, file_mtime timestamp, table_name string, rows_in long, rows_rejected long, loaded_at timestamp, load_id string"
REJECT_SCHEMA = "table_name string, file_name string, line string, first_field string"


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def _file_status(spark: SparkSession, path: str) -> tuple[int, int]:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    st = fs.getFileStatus(jpath)
    return int(st.getLen()), int(st.getModificationTime())


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Header names of a CSV file (one distributed read of the first line)."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return []
    import csv

    return next(csv.reader([first[0][0]]))


def read_raw_csv(spark: SparkSession, paths: str | list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Read CSV file(s) as text columns bound by name. Returns ``(good, rejected)``.

    ``good`` has exactly ``columns`` + ``_source_file``; header columns not in
    the contract are ignored, contract columns absent from the header are NULL.
    ``rejected`` holds (file_name, line) of malformed lines.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        by_header.setdefault(tuple(read_header(spark, p)), []).append(p)
    good = rejected = None
    for header, group in by_header.items():
        g, r = _read_one_layout(spark, group, list(header), columns)
        good = g if good is None else good.unionByName(g)
        rejected = r if rejected is None else rejected.unionByName(r)
    return good, rejected


def _parsed(spark: SparkSession, paths: list[str], header: list[str]) -> DataFrame:
    """All records of files with one header: ``row`` as a struct, ``record`` where it is broken, the file's name."""
    # Read with the file's own header order (all strings) so fields bind by
    # name; the corrupt-record column captures records with fields too few or too many.
    schema = _text_schema([*header, CORRUPT])
    found = records(spark, paths)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'}   # RFC 4180: a quote inside quotes is doubled
    names = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    row = F.from_csv("record", names, options)
    # The struct is parsed as a whole, so that no field is pruned (trap T9); the text is beside it only where it is broken.
    parsed = found.select(F.when(F.col("well_formed"), row).alias("row"), "record", F.col("file_name").alias(SOURCE_FILE_COL))
    broken = F.col("row").isNull() | F.col("row")[CORRUPT].isNotNull()
    return parsed.select("row", F.when(broken, F.col("record")).alias("record"), SOURCE_FILE_COL)


def _landed(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All records of a path as they are stored: ``columns``, the file's name, and of a broken record, whose
    columns are NULL, its text and first field."""
    header = read_header(spark, path)
    df = _parsed(spark, [path], header)
    good = F.col("record").isNull()
    return df.select(*[(F.when(good, F.col("row")[c]) if c in header else F.lit(None).cast("string")).alias(c) for c in columns],
                     SOURCE_FILE_COL, F.col("record").alias(CORRUPT),
                     (F.when(~good, F.col("row")[header[0]]) if header else F.lit(None).cast("string")).alias(FIRST_FIELD))


def _read_one_layout(spark: SparkSession, paths: list[str], header: list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    from carespark.session import stable_table

    missing = [c for c in columns if c not in header]
    # Parse once into a Parquet stage (shared checkpoint folder): both outputs read the same rows.
    df = stable_table(_parsed(spark, paths, header), "csv-parse")
    df = df.select(*[F.col("row")[c].alias(c) for c in header], F.col("record").alias(CORRUPT), SOURCE_FILE_COL)
    good = df.where(F.col(CORRUPT).isNull()).select(
        *[(F.col(c) if c not in missing else F.lit(None).cast("string")).alias(c) for c in columns],
        F.col(SOURCE_FILE_COL),
    )
    # The reject rows also carry the first field of the line.
    rejected = df.where(F.col(CORRUPT).isNotNull()).select(
        F.col(SOURCE_FILE_COL).alias("file_name"), F.col(CORRUPT).alias("line"),
        (F.col(header[0]) if header else F.lit(None).cast("string")).alias("first_field"),
    )
    return good, rejected


@dataclass
class LoadResult:
    report: DataFrame
    tables: dict[str, DataFrame]
    rejected: DataFrame


def load_raw(
    spark: SparkSession,
    data_dir: str,
    raw_dir: str,
    *,
    contracts: dict[str, tuple[str, list[str]]] = CONTRACTS,
) -> LoadResult:
    """Land the contract files of ``data_dir`` into Parquet raw tables under ``raw_dir``.

    Idempotent: files already recorded in the ledger with the same size and
    modification time are skipped. A load survives a crash at any point: a file's
    rows and rejects go to folders named after its version, written as a whole,
    and count only once the ledger, written last, names them. A retry rewrites
    the same folders. Records are parsed and written once: the broken ones lie marked beside
    the rows, are copied to the rejects from there, and are no rows of the table. Returns the per-table load report (table, file, rows_in,
    rows_rejected), the raw tables and the rejects.
    """
    from carespark.session import short_shuffles, stages_dropped

    ledger_path = os.path.join(raw_dir, "_ledger")
    # one row per loaded file version, as many as files were ever given
    ledger = spark.read.parquet(ledger_path).select("table_name", "load_id").collect() if _path_exists(spark, ledger_path) else []
    loaded = {(r.table_name, r.load_id) for r in ledger}
    report_rows = []
    for table, (fname, cols) in contracts.items():
        path = os.path.join(data_dir, fname)
        if not _path_exists(spark, path):
            report_rows.append((table, fname, 0, 0, "missing"))
            continue
        size, mtime_ms = _file_status(spark, path)
        load_id = _load_id(fname, size, mtime_ms)
        if (table, load_id) in loaded:
            report_rows.append((table, fname, 0, 0, "skipped"))
            continue
        data_path, reject_path = _load_paths(raw_dir, table, load_id)
        with short_shuffles(spark), stages_dropped(spark):
            _landed(spark, path, cols).write.mode("overwrite").option("compression", "zstd").parquet(data_path)
            landed = spark.read.schema(_text_schema([SOURCE_FILE_COL, CORRUPT, FIRST_FIELD])).parquet(data_path)
            landed.where(F.col(CORRUPT).isNotNull()).select(
                F.lit(table).alias("table_name"), F.col(SOURCE_FILE_COL).alias("file_name"), F.col(CORRUPT).alias("line"),
                F.col(FIRST_FIELD).alias("first_field"),
            ).write.mode("overwrite").option("compression", "zstd").parquet(reject_path)
            n_in, n_bad = landed.where(F.col(CORRUPT).isNull()).count(), spark.read.parquet(reject_path).count()
        spark.createDataFrame(
            [(fname, size, None, table, n_in, n_bad, None, load_id)], LEDGER_SCHEMA
        ).withColumn("file_mtime", F.timestamp_millis(F.lit(mtime_ms))).withColumn(
            "loaded_at", F.current_timestamp()
        ).coalesce(1).write.mode("append").parquet(ledger_path)
        loaded.add((table, load_id))
        report_rows.append((table, fname, n_in, n_bad, "loaded"))
    report = spark.createDataFrame(
        report_rows, "table_name string, file_name string, rows_in long, rows_rejected long, status string"
    )
    tables, rejects = {}, []
    for table, (_, cols) in contracts.items():
        paths = [_load_paths(raw_dir, t, i) for t, i in sorted(loaded) if t == table]
        if paths:
            # folders of older loads hold no broken records and no column for them, which reads as NULL
            stored = spark.read.schema(_text_schema([*cols, SOURCE_FILE_COL, CORRUPT])).parquet(*[d for d, _ in paths])
            tables[table] = stored.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
            rejects += [r for _, r in paths]
        elif _path_exists(spark, os.path.join(raw_dir, table)):
            tables[table] = spark.read.parquet(os.path.join(raw_dir, table))
    rejected = spark.read.schema(REJECT_SCHEMA).parquet(*rejects) if rejects else spark.createDataFrame([], REJECT_SCHEMA)
    return LoadResult(report, tables, rejected)


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _load_id(file_name: str, size: int, mtime_ms: int) -> str:
    return hashlib.sha256(f"{file_name}/{size}/{mtime_ms}".encode()).hexdigest()[:16]


def _load_paths(raw_dir: str, table: str, load_id: str) -> tuple[str, str]:
    return os.path.join(raw_dir, "_loads", table, load_id), os.path.join(raw_dir, "_rejected", table, load_id)


def manifest(spark: SparkSession, paths: list[str], source: str) -> DataFrame:
    """SRC-08: provenance manifest rows (source, path, size, modified, recorded)."""
    rows = []
    for p in paths:
        size, mtime_ms = _file_status(spark, p)
        rows.append((source, p, size, mtime_ms))
    return spark.createDataFrame(
        rows, "source string, path string, file_size long, mtime_ms long"
    ).select(
        "source", "path", "file_size",
        F.timestamp_millis("mtime_ms").alias("file_mtime"),
        F.current_timestamp().alias("recorded_at"),
    )


def empty_raw_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """SRC-09: empty raw tables with the contract schema."""
    from carespark.sources.contracts import raw_schema

    return {t: spark.createDataFrame([], raw_schema(t)) for t in CONTRACTS}


def ensure_raw_tables(spark: SparkSession, raw_dir: str) -> list[str]:
    """SRC-09: create empty raw tables (contract schema) that do not exist yet.

    Returns the tables created; existing tables are left untouched.
    """
    from carespark.sources.contracts import raw_schema

    created = []
    for t in CONTRACTS:
        path = os.path.join(raw_dir, t)
        if not _path_exists(spark, path):
            spark.createDataFrame([], raw_schema(t)).write.mode("ignore").parquet(path)
            created.append(t)
    return created
