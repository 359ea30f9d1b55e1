"""Run in a separate process: queries whose tasks fail once and are retried give
the same answers (test-only failure injection; the library has no Python stage)."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def fail_first_attempt(batches):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    yield from batches


def main(sf_dir: str) -> None:
    spark = (SparkSession.builder.master("local[4,3]").appName("quarry-retry")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "6")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from quarry import fixtures as fx
    from quarry.operators import dense_row_number
    from quarry.plans import trips

    s = fx.searches(spark, sf_dir).select("event_id", "userid")
    flaky = s.mapInPandas(fail_first_attempt, s.schema)
    got = sorted(tuple(r) for r in dense_row_number(flaky, ["userid", "event_id"], "rn").collect())
    want = sorted(tuple(r) for r in s.withColumn("rn", F.row_number().over(Window.orderBy("userid", "event_id")))
                  .collect())
    t = fx.trips(spark, sf_dir)
    flaky_t = t.mapInPandas(fail_first_attempt, t.schema)
    fast_got = [tuple(r) for r in trips.fastest_trips(flaky_t, fx.vendors(spark, sf_dir), strategy="merge").collect()]
    fast_want = [tuple(r) for r in trips.fastest_trips(t, fx.vendors(spark, sf_dir)).collect()]
    print(json.dumps({"row_numbers_equal": got == want, "fastest_equal": fast_got == fast_want}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
