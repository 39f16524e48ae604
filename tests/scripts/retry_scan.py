"""Run in its own process: ordered_scan with an injected first-attempt task
failure in its input (``local[2,4]`` allows retries); prints OK when the result equals
Spark's window functions."""

import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import Window as W  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import carespark.operators.ordered as O  # noqa: E402
from carespark.session import get_session  # noqa: E402

spark = get_session("local[2,4]", shuffle_partitions=4)
rnd = random.Random(7)
rows = [(7 if rnd.random() < 0.4 else rnd.randint(0, 40), rnd.randint(0, 20), i, float(rnd.randint(0, 99)))
        for i in range(3000)]
base = spark.createDataFrame(rows, "k long, d int, id long, v double")


def flaky(batches):
    from pyspark import TaskContext

    tc = TaskContext.get()
    if tc.partitionId() == 1 and tc.attemptNumber() == 0:
        raise RuntimeError("injected failure: lost task")
    yield from batches


# the scan's own input fails once in one task
df = base.repartition(4).mapInArrow(flaky, base.schema)
got = O.ordered_scan(df, ["k"], ["d", "id"], lag={"pv": "v"}, row_number="rn", num_partitions=4)
w = W.partitionBy("k").orderBy("d", "id")
exp = base.withColumn("pv", F.lag("v").over(w)).withColumn("rn", F.row_number().over(w))
a, b = got.select("id", "pv", "rn"), exp.select("id", "pv", "rn")
ok = a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
print("OK" if ok else "MISMATCH")
spark.stop()
