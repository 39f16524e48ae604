"""Governance as table operations (GOV-01..05).

- :func:`mask_phi` is a projection: PHI columns (by name) become
  ``'****' + 8 hex of SHA-256``; nothing leaves the JVM.
- :func:`audited` appends one audit row per distinct patient to an
  append-only Parquet table *before* the caller reads the data.
- :func:`audit_disclosure` answers "who accessed this patient" within the
  retention window; the audit table is partitioned by access date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carespark import codes
from carespark.functions.columns import mask_value

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("patient_ref", T.StringType(), True),
        T.StructField("action", T.StringType(), True),
        T.StructField("accessor", T.StringType(), True),
        T.StructField("accessed_at", T.TimestampType(), True),
        T.StructField("context", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("access_date", T.DateType(), True),
    ]
)


def mask_phi(
    df: DataFrame,
    *,
    phi_read: bool = False,
    strict_reference: bool = False,
    salt: str | None = None,
    full_digest: bool = False,
    phi_fields: tuple[str, ...] = codes.PHI_FIELDS,
) -> DataFrame:
    """Mask every column whose (case-insensitive) name is a PHI field.

    ``phi_read=True`` bypasses masking. Non-string PHI columns (e.g. a DATE
    birth date) are cast to text and masked; ``strict_reference=True`` keeps
    the reference behaviour of passing non-string values through unmasked.
    """
    if phi_read:
        return df
    phi = {f.lower() for f in phi_fields}
    cols = []
    for f in df.schema.fields:
        if f.name.lower() in phi:
            if strict_reference and not isinstance(f.dataType, T.StringType):
                cols.append(F.col(f.name))
            else:
                cols.append(mask_value(F.col(f.name), salt=salt, full_digest=full_digest).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def audit_rows(
    df: DataFrame,
    *,
    action: str,
    accessor: str,
    patient_col: str = "patient_id",
    context: dict[str, str] | None = None,
    hash_ids: bool = True,
) -> DataFrame:
    """One audit row per distinct patient of ``df`` (hashed id by default)."""
    ids = df.select(F.col(patient_col).cast("string").alias("_pid")).distinct()
    ref = mask_value(F.col("_pid"), full_digest=True) if hash_ids else F.col("_pid")
    ctx = (
        F.create_map(*[x for k, v in (context or {}).items() for x in (F.lit(k), F.lit(str(v)))])
        if context
        else F.create_map().cast("map<string,string>")
    )
    now = F.current_timestamp()
    return ids.select(
        ref.alias("patient_ref"),
        F.lit(action).alias("action"),
        F.lit(accessor).alias("accessor"),
        now.alias("accessed_at"),
        ctx.alias("context"),
        F.to_date(now).alias("access_date"),
    )


def audited(
    df: DataFrame,
    audit_path: str,
    *,
    action: str,
    accessor: str,
    patient_col: str = "patient_id",
    context: dict[str, str] | None = None,
    hash_ids: bool = True,
) -> DataFrame:
    """GOV-03: log the access (append, partitioned by date), then return ``df``.

    The audit write happens before the caller's read, and covers requested
    ids even when they match no patient.
    """
    audit_rows(
        df, action=action, accessor=accessor, patient_col=patient_col, context=context,
        hash_ids=hash_ids,
    ).write.mode("append").partitionBy("access_date").parquet(audit_path)
    return df


def audit_disclosure(
    audit: DataFrame,
    patient_id: str,
    *,
    as_of: str | None = None,
    retention_years: int = 7,
    hash_ids: bool = True,
) -> DataFrame:
    """GOV-04: all accesses to one patient within the retention window."""
    ref = mask_value(F.lit(patient_id), full_digest=True) if hash_ids else F.lit(patient_id)
    today = F.to_date(F.lit(as_of)) if as_of else F.current_date()
    return audit.where(
        (F.col("patient_ref") == ref)
        & (F.col("access_date") >= F.add_months(today, -12 * retention_years))
    ).orderBy("accessed_at")


def disclosure_summary(audit: DataFrame, *, as_of: str | None = None, retention_years: int = 7) -> DataFrame:
    """GOV-04 for all patients: accesses per patient within the retention window
    (a partial aggregate, one row per patient)."""
    today = F.to_date(F.lit(as_of)) if as_of else F.current_date()
    return (
        audit.where(F.col("access_date") >= F.add_months(today, -12 * retention_years))
        .groupBy("patient_ref")
        .agg(
            F.count(F.lit(1)).alias("accesses"),
            F.countDistinct("action").alias("actions"),
            F.min("accessed_at").alias("first_access"),
            F.max("accessed_at").alias("last_access"),
        )
    )


def with_tenant(df: DataFrame, tenant_id: str) -> DataFrame:
    """GOV-05: stamp rows with their tenant (the first partition column of
    tenant-scoped tables)."""
    return df.select(F.lit(tenant_id).alias("tenant_id"), *df.columns)


def tenant_scope(df: DataFrame, tenant_id: str) -> DataFrame:
    """GOV-05: a tenant's view of a tenant-partitioned table. The predicate is
    on the partition column, so other tenants' folders are never listed or read."""
    return df.where(F.col("tenant_id") == F.lit(tenant_id)).drop("tenant_id")


# -- integrity and retention of the audit log --------------------------------
CHAIN_SCHEMA = "access_date date, segment string, entries long, head string"


def _entries(audit: DataFrame) -> DataFrame:
    """(access_date, segment, digest) of the entries; a segment is 1/256 of a day, by the reference's digest."""
    context = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("context"))))
    fields = F.to_json(F.struct("patient_ref", "action", "accessor", F.unix_micros("accessed_at").alias("at"), context.alias("context")))
    return audit.select("access_date", F.right(F.sha2("patient_ref", 256), F.lit(2)).alias("segment"), F.sha2(fields, 256).alias("digest"))


def chain_heads(audit: DataFrame, block: int = 1024) -> DataFrame:
    """(access_date, segment, entries, head): a hash chain over each segment's entries, in order of
    their digests. An entry that is changed, added or removed changes the head.

    Entries are chained in aligned groups by the digest's next characters, then the groups: no
    task holds more than such a group of a segment. ``block`` is the number of groups."""
    width = len(f"{block - 1:x}")
    e = _entries(audit).withColumn("part", F.left("digest", F.lit(width)))

    def chained(values):
        return F.aggregate(values, F.lit(""), lambda h, d: F.sha2(F.concat(h, d), 256))

    parts = e.groupBy("access_date", "segment", "part").agg(
        F.count(F.lit(1)).alias("n"), chained(F.sort_array(F.collect_list("digest"))).alias("head"))
    ordered = F.sort_array(F.collect_list(F.struct("part", "head")))
    return parts.groupBy("access_date", "segment").agg(F.sum("n").alias("entries"), chained(ordered["head"]).alias("head"))


def seal_days(audit: DataFrame, chain_path: str) -> None:
    """Record the chain heads of the given (finished) days; days are replaced, others stay."""
    chain_heads(audit).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("access_date").parquet(chain_path)


def verify_chain(audit: DataFrame, sealed: DataFrame) -> DataFrame:
    """(access_date, segment, entries, missing, intact) of every sealed or present segment."""
    now = chain_heads(audit).select("access_date", "segment", F.col("entries").alias("_n"), F.col("head").alias("_head"))
    both = sealed.join(now, ["access_date", "segment"], "full")
    return both.select("access_date", "segment", F.coalesce("entries", F.lit(0)).alias("entries"),
                       (F.coalesce("entries", F.lit(0)) - F.coalesce("_n", F.lit(0))).alias("missing"),
                       F.coalesce(F.col("head") == F.col("_head"), F.lit(False)).alias("intact"))


def expire_days(spark, audit_path: str, *, as_of: str, retention_years: int = 7) -> list[str]:
    """GOV-04: delete whole days that are past retention (their folders; no entry is read or rewritten).

    Returns the days, oldest first. A day is kept while its last instant is within retention."""
    first = spark.sql(f"SELECT add_months(DATE'{as_of}', {-12 * retention_years})").first()[0].isoformat()
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(audit_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("access_date=") and name[12:] < first:
            fs.delete(st.getPath(), True)
            gone.append(name[12:])
    return sorted(gone)
