"""quarry: Spark-native batch analytics for trip records and search logs.

Every public function takes DataFrames (and plain parameters) and returns a
DataFrame.  Rows are not collected to the driver (size checks bring one row) and no Python UDF is used: all
expressions are built from ``pyspark.sql.functions`` so Catalyst can push
filters into the scan, prune columns and keep the work inside whole-stage
codegen.

Sub-packages:

* ``quarry.sources``   -- readers and writers (CSV/TSV/text/Parquet), rejected rows
* ``quarry.functions`` -- column expressions (geography, time, text) and SQL UDFs
* ``quarry.operators`` -- cleaning, joins with a chosen strategy, top-k, row ids
* ``quarry.plans``     -- the composite jobs (trip questions, search-log profile);
                          ``quarry.plans.jobs`` runs them over files
"""

from quarry.config import JobParams, checkpoint_dir, scratch_dir, session

__all__ = ["JobParams", "checkpoint_dir", "scratch_dir", "session"]
