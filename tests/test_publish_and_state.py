"""Published versions, states that new rows are merged into, and the origin of bad lines."""

import os

import pytest
from pyspark.sql import functions as F

from quarry.config import TIME_FORMAT, scratch_dir
from quarry.operators import state
from quarry.plans import searchlog, trips
from quarry.schemas import TRIPS
from quarry.sources import current_version, publish, published, read_with_origin, read_with_rejects, remove_old, versions
from quarry import fixtures as fx


def _values(df):
    return sorted(r[0] for r in df.collect())


def test_a_failed_writer_leaves_the_version_before(spark):
    base = scratch_dir(spark, "published")
    assert current_version(spark, base) == 0
    with pytest.raises(FileNotFoundError):
        published(spark, base)
    assert publish(spark.range(10), base, expected=0) == 1
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("injected"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="injected"):
        publish(broken.repartition(4), base, expected=1)
    assert current_version(spark, base) == 1 and _values(published(spark, base)) == list(range(10))
    assert publish(spark.range(20), base, expected=1) == 2
    assert _values(published(spark, base)) == list(range(20)) and _values(published(spark, base, 1)) == list(range(10))
    with pytest.raises(ValueError, match="since version 1"):
        publish(spark.range(3), base, expected=1)


def test_a_broken_manifest_is_no_version_and_its_number_is_not_used_again(spark):
    base = scratch_dir(spark, "published")
    publish(spark.range(5), base)
    with open(f"{base.removeprefix('file:')}/_manifests/{2:010d}.json", "w") as f:
        f.write('{"version": 2, "da')
    assert current_version(spark, base) == 1 and _values(published(spark, base)) == list(range(5))
    assert publish(spark.range(6), base, expected=1) == 3


def test_old_data_and_leftovers_go_by_age(spark):
    base = scratch_dir(spark, "published")
    for n in (1, 2, 3):
        publish(spark.range(n), base)
    spark.range(9).write.parquet(f"{base}/data/v0000000009-attempt")
    assert remove_old(spark, base, keep=2) == []  # all younger than a day
    gone = remove_old(spark, base, keep=2, older_than_hours=0)
    assert len(gone) == 2 and [m["version"] for m in versions(spark, base)] == [2, 3]
    assert _values(published(spark, base)) == [0, 1, 2] and len(os.listdir(f"{base.removeprefix('file:')}/data")) == 2


def test_merged_states_equal_the_whole_and_old_rows_are_not_read(spark, sf_small):
    log, base = fx.search_log(spark, sf_small), scratch_dir(spark, "state")
    parts = [log.where(F.pmod("event_id", F.lit(4)) == k) for k in range(4)]
    # the rows of a delivery go with its folder: a later step that read them again would fail
    for k, part in enumerate(parts):
        path = scratch_dir(spark, f"delivery-{k}")
        part.write.parquet(path)
        searchlog.advance_visitors(spark, base, spark.read.parquet(path))
        os.rename(path.removeprefix("file:"), path.removeprefix("file:") + "-away")
    got = searchlog.popular_urls_from_state(spark, base).collect()
    assert got and got == searchlog.popular_urls(log).collect()
    searchlog.advance_visitors(spark, base, parts[1])  # once more: the same visitors
    assert searchlog.popular_urls_from_state(spark, base).collect() == got

    base, t = scratch_dir(spark, "state"), fx.trips(spark, sf_small)
    for k in range(3):
        trips.advance_durations(spark, base, t.where(F.hash("id") % 3 == k - 1))
    left = t.where(~(F.hash("id") % 3).isin(-1, 0, 1))
    trips.advance_durations(spark, base, left)
    assert [tuple(r) for r in trips.mean_duration_from_state(spark, base).collect()] == [tuple(r) for r in trips.mean_duration_sum_count(t).collect()]


def test_dictionary_ids_stay_and_nulls_have_none(spark):
    one = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "w string")
    first = state.grown_dictionary(None, one, "w")
    assert sorted(map(tuple, first.collect())) == [("a", 1), ("b", 2)]
    grown = state.grown_dictionary(first, spark.createDataFrame([("c",), ("a",), ("0",)], "w string"), "w")
    assert sorted(map(tuple, grown.collect())) == [("0", 3), ("a", 1), ("b", 2), ("c", 4)]
    empty = state.distinct_state(one.select(F.lit("k").alias("k"), "w").limit(0), "k", "w", first)
    assert state.distinct_counts(empty, "k").collect() == []


@pytest.mark.parametrize("header", [False, True])
def test_bad_lines_with_file_and_line_over_splits(spark, header):
    path = scratch_dir(spark, "lines")
    plain = {}
    for name in range(2):
        rows = ["id,start,end,a,b,c,d,cost"] if header else []
        for k in range(400):
            rows.append("" if k % 50 == 7 else f"{name}-{k},{'never' if k % 37 == name else '2020-01-01 00:00:00'},2020-01-01 00:01:00,1,2,3,4,5" + (",6,7" if k % 91 == 5 else ""))
        plain.update({(name, i + 1): r for i, r in enumerate(rows) if "never" in r or r.endswith(",6,7")})
        local = path.removeprefix("file:")
        os.makedirs(local, exist_ok=True)
        with open(f"{local}/file{name}.csv", "w") as f:
            f.write("\n".join(rows) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        good, rejected = read_with_origin(spark, path, TRIPS, header=header, time_format=TIME_FORMAT)
        assert rejected.select("*").rdd.getNumPartitions() >= 1 and spark.read.text(path).rdd.getNumPartitions() > 8
        got = {(int(r.file[-5]), r.line): r._corrupt_record for r in rejected.collect()}
        assert got == plain
        good_before, rejected_before = read_with_rejects(spark, path, TRIPS, header=header, time_format=TIME_FORMAT)
        assert good.exceptAll(good_before).isEmpty() and good_before.exceptAll(good).isEmpty()
        assert rejected.select("id", "_corrupt_record").exceptAll(rejected_before.select("id", "_corrupt_record")).isEmpty()
        assert rejected_before.count() == len(plain)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
