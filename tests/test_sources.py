"""Sources and sinks: declared schemas, round trips, rejected rows, sorted export (1-15, 28)."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from quarry import fixtures as fx
from quarry import schemas
from quarry.config import JobParams, checkpoint_dir, scratch_dir
from quarry.plans import conversions
from quarry.plans.searchlog import export_title_words
from quarry.sources import (
    read_delimited,
    read_pairs,
    read_stop_words,
    read_trips,
    read_with_rejects,
    write_delimited,
    write_parquet,
    write_text,
)


def test_scratch_dir_under_checkpoint_folder(spark):
    base = checkpoint_dir(spark)
    p = scratch_dir(spark, "x")
    assert p.startswith(base.rstrip("/")) and p != scratch_dir(spark, "x")


def test_checkpoint_dir_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def __init__(self, **kv):
            self.kv = kv

        def get(self, key, default=None):
            return self.kv.get(key, default)

    class Context:
        def __init__(self, master, known=None):
            self.master, self.known = master, known

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return self.known

        def setCheckpointDir(self, d):
            self.known = d

    class Session:
        def __init__(self, master, **kv):
            self.sparkContext, self.conf = Context(master), Conf(**kv)

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            checkpoint_dir(Session(master))
        named = Session(master, **{"spark.checkpoint.dir": "hdfs://shared"})
        assert checkpoint_dir(named) == "hdfs://shared" == named.sparkContext.known
    assert os.path.isdir(checkpoint_dir(Session("local[4]")))


def test_trip_csv_round_trip(spark, sf_small):
    t = fx.trips(spark, sf_small)
    back = conversions.csv_round_trip(spark, t)
    assert back.schema == schemas.TRIPS
    assert sorted(back.collect()) == sorted(t.collect())


def test_reference_time_format_is_read(spark):
    path = scratch_dir(spark, "lines")
    os.makedirs(path)
    with open(os.path.join(path, "part.csv"), "w") as f:
        f.write("7,2015-03-08 23:54:12,2015-03-09 00:12:35,-73.9,40.7,-74.0,40.8,12.5\n")
    r = read_trips(spark, path).first()
    assert r.start_time == dt.datetime(2015, 3, 8, 23, 54, 12) and r.cost == 12.5


def test_malformed_line_goes_to_rejected(spark):
    path = scratch_dir(spark, "bad")
    os.makedirs(path)
    with open(os.path.join(path, "part.csv"), "w") as f:
        f.write("1,2015-03-08 23:54:12,2015-03-09 00:12:35,-73.9,40.7,-74.0,40.8,12.5\n")
        f.write("2,yesterday,2015-03-09 00:12:35,not-a-number,40.7,-74.0,40.8,3.0\n")
    good, rejected = read_with_rejects(spark, path, schemas.TRIPS)
    assert [r.id for r in good.collect()] == ["1"]
    assert good.count() == 1 and rejected.count() == 1
    assert good.select("id").count() == 1 and good.agg(F.max("cost")).first()[0] == 12.5
    bad = rejected.collect()
    assert len(bad) == 1 and bad[0].id == "2" and bad[0].start_time is None and bad[0].start_longitude is None
    assert bad[0].end_latitude == 40.8 and bad[0]._corrupt_record.startswith("2,yesterday")


def test_parquet_write_fails_when_target_exists(spark, sf_small):
    path = scratch_dir(spark, "pq")
    df = fx.vendors(spark, sf_small)
    write_parquet(df, path)
    with pytest.raises(Exception):
        write_parquet(df, path)
    write_parquet(df, path, mode="overwrite")


def test_stop_words_without_header(spark):
    path = scratch_dir(spark, "stops")
    os.makedirs(path)
    with open(os.path.join(path, "stop.txt"), "w") as f:
        f.write("a\na's\nable\n")
    assert [r.stopWords for r in read_stop_words(spark, path).collect()] == ["a", "a's", "able"]


def test_pairs_take_first_two_fields(spark):
    path = scratch_dir(spark, "pairs")
    os.makedirs(path)
    with open(os.path.join(path, "p.tsv"), "w") as f:
        f.write("k1\tv1\textra\nk2\tv2\n")
    assert sorted(tuple(r) for r in read_pairs(spark, path).collect()) == [("k1", "v1"), ("k2", "v2")]


def test_pairs_keep_quotes_and_empty_keys(spark):
    path = scratch_dir(spark, "odd-pairs")
    os.makedirs(path)
    with open(os.path.join(path, "p.tsv"), "w") as f:
        f.write('k1\t"abc\tz\n\tv\n  k \t w \nalone\n')
    got = {(r.k, r.v) for r in read_pairs(spark, path).collect()}
    assert got == {("k1", '"abc'), ("", "v"), ("  k ", " w "), ("alone", None)}


ODD = [(1, "  x "), (2, "a  b "), (3, ""), (4, None), (5, 'q"u\\"o,te\t'), (6, "line\nbreak\r\n"), (7, "\\N"), (8, "\\E"),
       (9, "\\n \\\\ \\"), (10, " "), (11, '""'), (12, "\x00\\0"), (13, "#c"), (14, "\\s,\ts")]


@pytest.mark.parametrize("sep", [",", "\t"])
@pytest.mark.parametrize("escaped", [True, False])
def test_delimited_sink_keeps_values(spark, sep, escaped):
    rows = ODD if escaped else [r for r in ODD if r[0] != 12]
    df = spark.createDataFrame(rows, "id int, s string")
    path = write_delimited(df, scratch_dir(spark, "odd"), sep=sep, escaped=escaped)
    back = read_delimited(spark, path, df.schema, sep=sep, escaped=escaped, multi_line=not escaped)
    got = {r.id: r.s for r in back.collect()}
    if not escaped:
        got[6] = got[6].replace("\r\n", "\n") if got[6] else got[6]
        rows = [(i, s.replace("\r\n", "\n") if s else s) for i, s in rows]
    assert got == dict(rows)
    if escaped:
        assert spark.read.text(path).count() == len(rows)  # one line per row


def test_text_sink_overwrites(spark):
    path = scratch_dir(spark, "text")
    df = spark.createDataFrame([("a, b, c",)], "value string")
    write_text(df, path)
    write_text(df, path)
    assert spark.read.text(path).count() == 1


def test_export_files_sorted_in_name_order(spark, sf_small):
    path = export_title_words(fx.titles(spark, sf_small), scratch_dir(spark, "words"), JobParams(export_files=10))
    files = sorted(glob.glob(os.path.join(path, "part-*.csv")))
    assert len(files) == 10
    words = []
    for fpath in files:
        part = read_delimited(spark, fpath, schemas.TITLES, sep="\t", header=True, escaped=True)
        words.extend(r.title for r in part.collect())
    assert words == sorted(words)


def test_delimited_sort_without_tie_break(spark):
    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("w"))
    path = write_delimited(df, scratch_dir(spark, "plain"), num_files=3, sort_by=["w"])
    assert spark.read.csv(path).count() == 100


def test_text_lines_parsed_with_bad_fields_as_null(spark):
    from quarry.sources import parse_trip_lines, read_lines

    path = scratch_dir(spark, "raw")
    os.makedirs(path)
    with open(os.path.join(path, "t.txt"), "w") as f:
        f.write("1,2015-03-08 23:54:12,2015-03-09 00:12:35,-73.9,40.7,-74.0,40.8,12.5\n")
        f.write("2,bad,2015-03-09 00:12:35,x,40.7,-74.0,40.8,3.0\n")
    rows = {r.id: r for r in parse_trip_lines(read_lines(spark, path)).collect()}
    assert rows["1"].start_time == dt.datetime(2015, 3, 8, 23, 54, 12) and rows["1"].cost == 12.5
    assert rows["2"].start_time is None and rows["2"].start_longitude is None and rows["2"].end_latitude == 40.8


def test_load_table_by_format_and_inference(spark, sf_small):
    from quarry.sources import load_table, read_delimited

    t = fx.trips(spark, sf_small)
    csv_path = conversions.trips_to_csv(t, scratch_dir(spark, "fmt"))
    pq_path = write_parquet(t, scratch_dir(spark, "fmt-pq"))
    a = load_table(spark, csv_path, "csv", schemas.TRIPS)
    b = load_table(spark, pq_path, "parquet")
    assert sorted(a.collect()) == sorted(b.collect())
    inferred = read_delimited(spark, csv_path, None, infer_schema=True)
    assert dict(inferred.dtypes)["_c3"] == "double"
    with pytest.raises(ValueError):
        load_table(spark, csv_path, "orc")


def test_persisted_unpersists_after_block(spark, sf_small):
    from quarry.operators import persisted

    t = fx.trips(spark, sf_small)
    with persisted(t) as cached:
        assert cached.is_cached
        assert cached.count() == 1000
    assert not t.is_cached


def test_export_with_aqe_sized_files(spark, sf_small):
    path = export_title_words(fx.titles(spark, sf_small), scratch_dir(spark, "words-aqe"))
    files = sorted(glob.glob(os.path.join(path, "part-*.csv")))
    assert 1 <= len(files)
    words = []
    for fpath in files:
        part = read_delimited(spark, fpath, schemas.TITLES, sep="\t", header=True, escaped=True)
        words.extend(r.title for r in part.collect())
    assert words == sorted(words) and len(words) == searchlog_words(spark, sf_small)


def searchlog_words(spark, sf_small):
    from quarry.plans.searchlog import title_words

    return title_words(fx.titles(spark, sf_small)).count()
