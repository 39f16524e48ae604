"""Driver binding: the Parquet test tables seen as the clinical star schema.

SURVEY §7.3 maps each star table to a driver table:

==============  ==============================================================
patient         customer (key c_custkey, id c_name, male = MACHINERY segment,
                expenses c_acctbal; birth date derived from the key)
encounter       orders (start = order date, stop = latest ship date of the
                order's line items, class = order priority, cost = total price,
                provider = lowest supplier key of the order)
condition       line item x order x part (code = brand, description = part
                name, start = ship date, still active when line status 'O')
medication      line item x order (code = part key, cost = extended price,
                dispenses = quantity)
provider        supplier x nation
==============  ==============================================================

Every method returns a lazy DataFrame; only the columns a mart selects are
read (Catalyst prunes the Parquet scan). Money is DECIMAL like the reference,
so sums are exact and order independent.

``SQL_VIEWS`` holds the same binding as DuckDB SQL for the oracle side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carespark import codes

# FIXED VALUES of the binding (shared by the Spark and the SQL side).
DRIVER_CALENDAR = ("1995-01-01", "2002-12-31")
DRIVER_AS_OF = "2001-12-31"
DRIVER_INPATIENT_CLASS = "1-URGENT"
DRIVER_MALE_SEGMENT = "MACHINERY"
DRIVER_ACTIVE_STATUS = "O"
BIRTH_BASE_YEAR = 1930
BIRTH_YEAR_SPAN = 60

# Schemas of table files already read, by path and version: later reads pass
# the schema and skip Spark's footer-inference job.
_SCHEMAS: dict = {}


def _version(spark: SparkSession, path: str) -> tuple[int, int]:
    """Modification time and size of a path: another one when it is rewritten."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    st = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p)
    return int(st.getModificationTime()), int(st.getLen())


def birthdate_of(key) -> F.Column:
    """The binding's birth date of a customer key."""
    return F.make_date(
        (F.lit(BIRTH_BASE_YEAR) + key % BIRTH_YEAR_SPAN).cast("int"),
        (F.lit(1) + key % 12).cast("int"),
        (F.lit(1) + key % 28).cast("int"),
    )


@dataclass
class DriverTables:
    spark: SparkSession
    sf_dir: str
    calendar: tuple[str, str] = DRIVER_CALENDAR
    as_of: str = DRIVER_AS_OF
    inpatient_class: str = DRIVER_INPATIENT_CLASS
    condition_sets: dict | None = None

    def __post_init__(self):
        if self.condition_sets is None:
            self.condition_sets = codes.DRIVER_CONDITION_SETS

    def raw(self, name: str) -> DataFrame:
        path = f"{self.sf_dir.rstrip('/')}/{name}.parquet"
        key = (path, _version(self.spark, path))
        schema = _SCHEMAS.get(key)
        if schema is None:
            df = self.spark.read.parquet(path)
            _SCHEMAS[key] = df.schema
            return df
        return self.spark.read.schema(schema).parquet(path)

    # -- dimensions ------------------------------------------------------
    def patients(self) -> DataFrame:
        c = self.raw("customer")
        k = F.col("c_custkey")
        birth = birthdate_of(k)
        return c.select(
            k.alias("patient_key"),
            F.col("c_name").alias("patient_id"),
            birth.alias("birthdate"),
            F.lit(None).cast("date").alias("deathdate"),
            F.when(F.col("c_mktsegment") == DRIVER_MALE_SEGMENT, F.lit("M"))
            .otherwise(F.lit("F"))
            .alias("gender"),
            F.col("c_nationkey").cast("string").alias("state"),
            F.col("c_acctbal").cast("decimal(12,2)").alias("healthcare_expenses"),
        )

    def providers(self) -> DataFrame:
        s = self.raw("supplier")
        n = self.raw("nation")  # fixed 25-row table: broadcast is size-safe
        return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").select(
            F.col("s_suppkey").alias("provider_key"),
            F.col("s_name").alias("provider_id"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("state"),
        )

    # -- facts -------------------------------------------------------------
    def encounters(self) -> DataFrame:
        """Encounters without the stop date (no line-item read)."""
        o = self.raw("orders")
        return o.select(
            F.col("o_orderkey").alias("encounter_key"),
            F.col("o_orderkey").cast("string").alias("encounter_id"),
            F.col("o_custkey").alias("patient_key"),
            F.col("o_orderdate").cast("date").alias("start_date"),
            F.col("o_orderpriority").alias("encounter_class"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("total_claim_cost"),
        )

    def encounter_stops(self) -> DataFrame:
        """Per order: latest ship date (stop) and lowest supplier (provider).

        Partial aggregation on the line-item side, so the shuffle carries at
        most one row per (map task, order), never raw line items.
        """
        return self._stops(self.raw("lineitem"))

    @staticmethod
    def _stops(lines: DataFrame) -> DataFrame:
        return lines.groupBy(F.col("l_orderkey").alias("encounter_key")).agg(
            F.max(F.col("l_shipdate").cast("date")).alias("stop_date"),
            F.min("l_suppkey").alias("provider_key"),
        )

    def encounters_with_stop(self, encounters: DataFrame | None = None) -> DataFrame:
        if encounters is None:
            return self.encounters().join(self.encounter_stops(), "encounter_key", "left")
        # only the line items of the encounters asked for are aggregated
        keys = encounters.select(F.col("encounter_key").alias("l_orderkey"))
        stops = self._stops(self.raw("lineitem").join(keys, "l_orderkey", "left_semi"))
        return encounters.join(stops, "encounter_key", "left")

    def _lines_with_patient(self) -> DataFrame:
        li = self.raw("lineitem")
        o = self.raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("patient_key")
        )
        return li.join(o, "l_orderkey")

    def conditions(self) -> DataFrame:
        p = self.raw("part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.col("p_brand").alias("code"),
            F.col("p_name").alias("description"),
        )
        ship = F.col("l_shipdate").cast("date")
        return self._lines_with_patient().join(p, "l_partkey").select(
            "patient_key",
            F.col("l_orderkey").alias("encounter_key"),
            ship.alias("start_date"),
            F.when(F.col("l_linestatus") == DRIVER_ACTIVE_STATUS, F.lit(None).cast("date"))
            .otherwise(ship)
            .alias("stop_date"),
            "code",
            "description",
        )

    def medications(self) -> DataFrame:
        ship = F.col("l_shipdate").cast("date")
        qty = F.col("l_quantity").cast("int")
        return self._lines_with_patient().select(
            "patient_key",
            F.col("l_orderkey").alias("encounter_key"),
            ship.alias("start_date"),
            F.date_add(ship, qty).alias("stop_date"),
            F.col("l_partkey").cast("string").alias("code"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("total_cost"),
            qty.alias("dispenses"),
        )


# ---------------------------------------------------------------------------
# The same binding as DuckDB SQL views (oracle side). Kept next to the Spark
# code so the two stay in step.
SQL_VIEWS: dict[str, str] = {
    "patient": f"""SELECT c_custkey AS patient_key, c_name AS patient_id,
        make_date(CAST({BIRTH_BASE_YEAR} + c_custkey % {BIRTH_YEAR_SPAN} AS BIGINT),
                  CAST(1 + c_custkey % 12 AS BIGINT), CAST(1 + c_custkey % 28 AS BIGINT)) AS birthdate,
        CAST(NULL AS DATE) AS deathdate,
        CASE WHEN c_mktsegment = '{DRIVER_MALE_SEGMENT}' THEN 'M' ELSE 'F' END AS gender,
        CAST(c_nationkey AS VARCHAR) AS state,
        CAST(c_acctbal AS DECIMAL(12,2)) AS healthcare_expenses
      FROM customer""",
    "provider": """SELECT s_suppkey AS provider_key, s_name AS provider_id, s_name AS name,
        n_name AS state FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "encounter_base": """SELECT o_orderkey AS encounter_key, CAST(o_orderkey AS VARCHAR) AS encounter_id,
        o_custkey AS patient_key, CAST(o_orderdate AS DATE) AS start_date,
        o_orderpriority AS encounter_class,
        CAST(o_totalprice AS DECIMAL(10,2)) AS total_claim_cost
      FROM orders""",
    "encounter_stop": """SELECT l_orderkey AS encounter_key, max(CAST(l_shipdate AS DATE)) AS stop_date,
        min(l_suppkey) AS provider_key FROM lineitem GROUP BY l_orderkey""",
    "encounter": """SELECT e.*, s.stop_date, s.provider_key FROM encounter_base e
      LEFT JOIN encounter_stop s ON s.encounter_key = e.encounter_key""",
    "condition": f"""SELECT o.o_custkey AS patient_key, l.l_orderkey AS encounter_key,
        CAST(l.l_shipdate AS DATE) AS start_date,
        CASE WHEN l.l_linestatus = '{DRIVER_ACTIVE_STATUS}' THEN CAST(NULL AS DATE)
             ELSE CAST(l.l_shipdate AS DATE) END AS stop_date,
        p.p_brand AS code, p.p_name AS description
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
      JOIN part p ON p.p_partkey = l.l_partkey""",
    "medication": """SELECT o.o_custkey AS patient_key, l.l_orderkey AS encounter_key,
        CAST(l.l_shipdate AS DATE) AS start_date,
        CAST(l.l_shipdate AS DATE) + CAST(l.l_quantity AS INTEGER) AS stop_date,
        CAST(l.l_partkey AS VARCHAR) AS code,
        CAST(l.l_extendedprice AS DECIMAL(10,2)) AS total_cost,
        CAST(l.l_quantity AS INTEGER) AS dispenses
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
}
_VIEW_ORDER = ["patient", "provider", "encounter_base", "encounter_stop", "encounter",
               "condition", "medication"]
_VIEW_DEPS = {"encounter": ["encounter_base", "encounter_stop"]}


def sql_with(views: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the binding CTEs it names (dependencies included)
    followed by ``extra`` (name, sql) CTEs."""
    need: set[str] = set()
    for v in views:
        need.add(v)
        need.update(_VIEW_DEPS.get(v, []))
    ctes = [f"{v} AS ({SQL_VIEWS[v]})" for v in _VIEW_ORDER if v in need]
    ctes += [f"{n} AS ({q})" for n, q in (extra or [])]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
