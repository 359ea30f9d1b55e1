"""Whole jobs over files give the same answers as the registered queries on the same rows."""

import os


from quarry import fixtures as fx
from quarry import schemas
from quarry.config import scratch_dir
from quarry.operators import persisted
from quarry.plans import conversions, jobs, searchlog, trips
from quarry.config import JobParams
from quarry.sources import read_delimited, write_delimited


def test_trip_questions_csv_and_parquet_agree(spark, sf_small):
    t, v = fx.trips(spark, sf_small), fx.vendors(spark, sf_small)
    base = scratch_dir(spark, "job-trips")
    conversions.trips_to_csv(t, f"{base}/trips.csv")
    write_delimited(v, f"{base}/vendors.csv")
    tq, vq = conversions.convert_csv_to_parquet(spark, f"{base}/trips.csv", f"{base}/vendors.csv", f"{base}/pq")
    a = jobs.trip_questions(spark, f"{base}/trips.csv", f"{base}/vendors.csv", "csv", as_decimal=False)
    b = jobs.trip_questions(spark, tq, vq, "parquet", as_decimal=False)
    want = trips.fastest_trips(t, v)
    assert a.fastest_trips.collect() == b.fastest_trips.collect() == want.collect()
    assert a.max_cost_by_vendor.collect() == trips.max_cost_by_vendor(t, v).collect()
    assert len(a.mean_duration_by_hour.collect()) == 24
    staged = jobs.trip_questions(spark, f"{base}/trips.csv", f"{base}/vendors.csv", "csv", as_decimal=False,
                                 stage_dir=f"{base}/stage")
    assert staged.fastest_trips.collect() == want.collect()
    assert staged.max_cost_by_vendor.collect() == a.max_cost_by_vendor.collect()
    assert staged.mean_duration_by_hour.collect() == a.mean_duration_by_hour.collect()
    dec = jobs.trip_questions(spark, tq, vq, "parquet")
    assert dict(dec.mean_duration_by_hour.dtypes)["duration_min"] == "decimal(32,2)"
    sample = jobs.trip_vendor_sample_join(spark, tq, vq, n=100)
    forced = jobs.trip_vendor_sample_join(spark, tq, vq, n=100, strategy="merge")
    assert sorted(sample.collect()) == sorted(forced.collect())


def test_search_profile_from_files(spark, sf_small):
    s = fx.searches(spark, sf_small)
    titles = fx.titles(spark, sf_small)
    base = scratch_dir(spark, "job-search")
    write_delimited(s.select(*schemas.SEARCHES.fieldNames()), f"{base}/log", sep="\t", header=True, escaped=True)
    write_delimited(titles.select("title"), f"{base}/titles", header=True, escaped=True)
    os.makedirs(f"{base}/stops")
    with open(f"{base}/stops/stop.txt", "w") as f:
        f.write("\n".join(fx.FIXTURE_STOP_WORDS) + "\n")
    prof = jobs.search_profile(spark, f"{base}/log", f"{base}/titles", f"{base}/stops", escaped=True)
    with persisted(s) as cached:
        assert sorted(prof.searches_per_day.collect()) == sorted(searchlog.calendar_counts(cached, "day").collect())
        assert prof.success.collect() == searchlog.success_ratio(cached).collect()
        assert prof.popular_urls.collect() == searchlog.popular_urls(cached).collect()
        assert prof.keyword_counts.collect() == searchlog.keyword_counts(cached).collect()
    assert prof.title_first_letters.collect() == searchlog.title_first_letters(titles.select("title")).collect()
    want = searchlog.search_title_match(s, titles, fx.stop_words(spark)).collect()
    assert prof.title_match.collect() == want
    staged = jobs.search_profile(spark, f"{base}/log", f"{base}/titles", f"{base}/stops", escaped=True,
                                 stage_dir=f"{base}/stage")
    assert staged.title_match.collect() == want
    assert staged.keyword_counts.collect() == prof.keyword_counts.collect()
    assert os.path.isdir(f"{base}/stage/searches.parquet")


def test_pair_joins_write_text(spark):
    base = scratch_dir(spark, "job-pairs")
    os.makedirs(f"{base}/l")
    os.makedirs(f"{base}/r")
    with open(f"{base}/l/a.tsv", "w") as f:
        f.write("1\ta\n1\tb\n2\tc\n")
    with open(f"{base}/r/b.tsv", "w") as f:
        f.write("1\tx\n1\ty\n1\tz\n3\tw\n")
    rep, bc = jobs.pair_joins(spark, f"{base}/l", f"{base}/r", f"{base}/out")
    assert sorted(rep.collect()) == sorted(bc.collect()) and rep.count() == 6
    lines = sorted(r.value for r in spark.read.text(f"{base}/out/repartition").collect())
    assert lines[0] == "1, a, x" and len(lines) == 6
    assert sorted(r.value for r in spark.read.text(f"{base}/out/broadcast").collect()) == lines


def test_bucketed_tables_join_without_shuffle(spark, sf_small):
    import uuid

    from quarry.operators import plan_string

    t, v = fx.trips(spark, sf_small), fx.vendors(spark, sf_small)
    base = scratch_dir(spark, "job-bucket")
    conversions.trips_to_csv(t, f"{base}/trips.csv")
    write_delimited(v, f"{base}/vendors.csv")
    tag = uuid.uuid4().hex[:8]
    tn, vn = conversions.convert_csv_to_bucketed(spark, f"{base}/trips.csv", f"{base}/vendors.csv", f"{base}/tables", 8,
                                         f"trips_{tag}", f"vendors_{tag}")
    try:
        import glob

        assert len(glob.glob(f"{base}/tables/trips_{tag}/*.parquet")) == 8  # one file per bucket
        ans = jobs.trip_questions(spark, tn, vn, "table", strategy="merge", as_decimal=False)
        plan = plan_string(ans.fastest_trips)
        tree = plan.split("\n\n")[0]
        assert "SortMergeJoin" in tree and "Exchange" not in tree
        assert ans.fastest_trips.collect() == trips.fastest_trips(t, v).collect()
        assert ans.max_cost_by_vendor.collect() == trips.max_cost_by_vendor(t, v).collect()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS trips_{tag}")
        spark.sql(f"DROP TABLE IF EXISTS vendors_{tag}")


def test_export_titles_from_file(spark, sf_small):
    import glob

    titles = fx.titles(spark, sf_small)
    base = scratch_dir(spark, "job-export")
    write_delimited(titles.select("title"), f"{base}/titles", header=True)  # quoted line breaks
    out = jobs.export_titles(spark, f"{base}/titles", f"{base}/out", JobParams(export_files=10), multi_line=True)
    files = sorted(glob.glob(f"{out}/part-*.csv"))
    assert len(files) == 10
    words = []
    for fpath in files:
        words.extend(r.title for r in read_delimited(spark, fpath, schemas.TITLES, sep="\t", header=True, escaped=True).collect())
    want = sorted(r.title for r in searchlog.title_words(titles).collect())
    assert words == want


def test_sample_join_same_rows_for_every_strategy(spark, sf_small):
    from quarry.operators import join_operators

    t, v = fx.trips(spark, sf_small), fx.vendors(spark, sf_small)
    base = scratch_dir(spark, "job-strategies")
    tq = write_parquet_frame(t, f"{base}/t")
    vq = write_parquet_frame(v, f"{base}/v")
    want = sorted(jobs.trip_vendor_sample_join(spark, tq, vq).collect())
    assert len(want) > 0
    expected_op = {"merge": "SortMergeJoin Inner", "shuffle_hash": "ShuffledHashJoin Inner",
                   "broadcast": "BroadcastHashJoin Inner"}
    for strategy, op in expected_op.items():
        df = jobs.trip_vendor_sample_join(spark, tq, vq, strategy=strategy)
        assert join_operators(df) == [op]
        assert sorted(df.collect()) == want


def write_parquet_frame(df, path):
    from quarry.sources import write_parquet

    return write_parquet(df, path)
