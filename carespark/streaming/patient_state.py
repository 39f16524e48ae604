"""Per-patient aggregates that a stream advances, so that features need no fact table (STM-06).

Every feature of a patient follows from aggregates that merge: counts, decimal sums,
sets of codes, latest dates and the patient's own row. A batch adds its *delta*, one row
per patient that it names, in a folder of its own (a replay replaces it). The state of a
patient is the merge of its deltas; :meth:`PatientState.merge_up_to` folds old deltas into
a base with one row per patient, committed by a record written last, so that what a batch
reads stays small.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carespark import codes
from carespark.functions import columns as C
from carespark.streaming.key_index import exists

SCHEMA = ("patient_id string, bucket int, encounter_count long, total_cost decimal(38,2), last_encounter_date date, "
          "codes array<string>, birthdate date, gender string, healthcare_expenses decimal(38,2), known boolean")   # known: there is a patient row


def _delta_columns(table: str) -> tuple[str, dict[str, Column]] | None:
    """(patient id column, aggregates by name) of an entity's raw rows; None if it adds nothing."""
    if table == "raw_encounters":
        return "PATIENT", {"encounter_count": F.count(F.lit(1)), "total_cost": F.sum(C.try_decimal("TOTAL_CLAIM_COST")),
                           "last_encounter_date": F.max(C.iso_prefix_to_date("START"))}
    if table == "raw_conditions":
        return "PATIENT", {"codes": F.collect_set("CODE")}
    if table == "raw_patients":
        return "ID", {"birthdate": F.max(C.iso_prefix_to_date("BIRTHDATE")), "gender": F.max("GENDER"),
                      "healthcare_expenses": F.max(C.try_decimal("HEALTHCARE_EXPENSES")), "known": F.max(F.lit(True))}
    return None


def merged(rows: DataFrame) -> DataFrame:
    """One row per patient of state rows."""
    return rows.groupBy("patient_id").agg(
        F.first("bucket").alias("bucket"), F.sum("encounter_count").alias("encounter_count"),
        F.sum("total_cost").cast("decimal(38,2)").alias("total_cost"), F.max("last_encounter_date").alias("last_encounter_date"),
        F.array_distinct(F.flatten(F.collect_list("codes"))).alias("codes"),   # of a code dictionary: bounded
        F.max("birthdate").alias("birthdate"), F.max("gender").alias("gender"),
        F.max("healthcare_expenses").alias("healthcare_expenses"), F.max("known").alias("known"))


class PatientState:
    """The state in ``path``. ``buckets`` orders a delta's rows, so that a reader of some patients
    skips row groups; choose it by the number of patients and keep it."""

    def __init__(self, path: str, buckets: int = 256):
        self.path, self.buckets = path.rstrip("/"), buckets

    def add(self, rows: DataFrame, table: str, batch_id: int) -> None:
        """The delta of a batch's stored raw rows, replacing what an earlier try left."""
        found = _delta_columns(table)
        if found is None:
            return
        pid, values = found
        if table == "raw_conditions":
            rows = rows.select(pid, "CODE").distinct()     # a set has each code once: few rows are collected
        delta = rows.groupBy(F.col(pid).alias("patient_id")).agg(*[v.alias(n) for n, v in values.items()])
        types = dict(part.split(" ", 1) for part in SCHEMA.split(", "))
        delta = delta.withColumn("bucket", F.pmod(F.xxhash64("patient_id"), F.lit(self.buckets)).cast("int"))
        delta = delta.select(*[(F.col(n) if n in delta.columns else F.lit(None)).cast(t).alias(n) for n, t in types.items()],
                             F.lit(table).alias("source"), F.lit(batch_id).cast("long").alias("batch_id"))
        delta.repartitionByRange("bucket").sortWithinPartitions("bucket", "patient_id").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("source", "batch_id").parquet(f"{self.path}/deltas")

    def _base(self, spark: SparkSession) -> tuple[str | None, dict[str, int]]:
        """Folder of the committed base and the last batch of each source that is in it."""
        if not exists(spark, f"{self.path}/bases"):
            return None, {}
        last = spark.read.schema("version long, folder string, upto map<string,long>").json(f"{self.path}/bases") \
            .orderBy(F.desc("version")).first()
        return (last["folder"], last["upto"]) if last else (None, {})

    def rows(self, spark: SparkSession) -> DataFrame:
        """State rows of all patients, not merged."""
        folder, upto = self._base(spark)
        rows = spark.createDataFrame([], SCHEMA)
        if exists(spark, f"{self.path}/deltas"):
            rows = spark.read.schema(f"{SCHEMA}, source string, batch_id long").parquet(f"{self.path}/deltas")
            for source, batch in upto.items():
                rows = rows.where(~((F.col("source") == source) & (F.col("batch_id") <= batch)))
            rows = rows.drop("source", "batch_id")
        return rows.unionByName(spark.read.schema(SCHEMA).parquet(folder)) if folder else rows

    def current(self, touched: DataFrame | None = None) -> DataFrame:
        """One row per patient, of those in ``touched`` (patient_id) or of all."""
        spark = touched.sparkSession if touched is not None else SparkSession.getActiveSession()
        rows = self.rows(spark)
        return merged(rows.join(touched.select("patient_id").distinct(), "patient_id", "left_semi") if touched is not None else rows)

    def merge_up_to(self, spark: SparkSession, upto: dict[str, int]) -> None:
        """Fold the deltas of batches up to ``upto`` (last batch by source; all earlier ones must be
        done) into a new base. Readers see it when its record is written; folded deltas are then
        no longer read and may be deleted."""
        folder, before = self._base(spark)
        rows = spark.read.schema(f"{SCHEMA}, source string, batch_id long").parquet(f"{self.path}/deltas")
        taken = F.lit(False)
        for source, batch in upto.items():
            taken = taken | ((F.col("source") == source) & (F.col("batch_id") > before.get(source, -2 ** 62)) & (F.col("batch_id") <= batch))
        rows = rows.where(taken).drop("source", "batch_id")
        if folder:
            rows = rows.unionByName(spark.read.schema(SCHEMA).parquet(folder))
        new = f"{self.path}/base-{uuid.uuid4().hex[:12]}"
        merged(rows).select(*[c.split()[0] for c in SCHEMA.split(", ")]).repartitionByRange("bucket") \
            .sortWithinPartitions("bucket", "patient_id").write.parquet(new)
        version = spark.read.schema("version long").json(f"{self.path}/bases").agg(F.max("version")).first()[0] if folder else 0
        spark.createDataFrame([(version + 1, new, before | upto)], "version long, folder string, upto map<string,long>") \
            .write.mode("append").json(f"{self.path}/bases")

    def features(self, touched: DataFrame | None = None, *, condition_sets: dict, as_of: str | None = None) -> DataFrame:
        """Risk features (patient_id and codes.RISK_FEATURES) of the touched patients that have a
        patient row, from the state alone."""
        s = self.current(touched).where("known")

        def flag(name):
            return F.arrays_overlap("codes", F.array(*map(F.lit, condition_sets[name]))).cast("double")

        found = {
            "age_years": F.coalesce(C.year_boundary_age(C.as_of_date(as_of), "birthdate").cast("double"), F.lit(0.0)),
            "is_male": F.when(F.col("gender") == "M", 1.0).otherwise(0.0),
            "condition_count": F.size("codes").cast("double"),
            **{f"has_{n}": F.coalesce(flag(n), F.lit(0.0)) for n in ("diabetes", "heart_failure", "hypertension", "copd_asthma")},
            "encounter_count": F.coalesce(F.col("encounter_count").cast("double"), F.lit(0.0)),
            "total_encounter_cost": F.coalesce(F.col("total_cost").cast("double"), F.lit(0.0)),
            "healthcare_expenses": F.coalesce(F.col("healthcare_expenses").cast("double"), F.lit(0.0)),
        }
        return s.select("patient_id", *[found[n].alias(n) for n in codes.RISK_FEATURES])
