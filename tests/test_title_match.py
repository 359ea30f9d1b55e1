"""Title match: tokens of common and other title words, and no map of searches and words."""

from pyspark.sql import functions as F

from quarry.plans import searchlog

STOPS = ["the"]


def plain(searches, titles):
    vocab = {w for t in titles for w in t.split("_") if w and 33 <= ord(w[0]) <= 126}
    words = {}
    for i, text, _ in searches:
        for w in text.split(" "):
            if w and 33 <= ord(w[0]) <= 126 and w not in STOPS:
                words.setdefault(i, []).append(w in vocab)
    times = [(words[i], n) for i, _, n in searches if i is not None and i in words]
    matched, searchable = sum(n for w, n in times if any(w)), sum(n for _, n in times)
    return matched, searchable, matched * 100.0 / searchable, sum(sum(w) * n for w, n in times)


def inputs(spark):
    titles = ["a_b_a_the_é", "c_a", "d__b", "e" * 200 + "_a", ""]
    searches = [(1, "a a x", 2), (2, "x y", 1), (3, "the  é", 5), (4, f"c c the {'e' * 200}", 3), (5, "zz d x zz", 1), (6, "a", 4), (6, "c x", 2),
                (None, "a c", 7)]
    return (searches, titles, spark.createDataFrame(searches, "event_id long, keywords string, n long"),
            spark.createDataFrame([(t,) for t in titles], "title string"), spark.createDataFrame([(w,) for w in STOPS], "stopWords string"))


def test_common_and_other_words(spark, monkeypatch):
    searches, titles, s, t, stops = inputs(spark)
    for most in (0, 1, 2, 1000):
        monkeypatch.setattr(searchlog, "COMMON_WORDS", most, raising=False)
        for strategy in ("auto", "merge"):
            assert tuple(searchlog.search_title_match(s, t, stops, strategy=strategy, weight="n").first()) == plain(searches, titles)


def test_no_task_holds_a_map_of_searches_and_words(spark):
    words = F.expr("concat_ws(' ', transform(sequence(0, 2000), x -> concat('w', id * 10000 + x)))")
    s = spark.range(200).select(F.col("id").alias("event_id"), words.alias("keywords"))
    t = s.select(F.replace("keywords", F.lit(" "), F.lit("_")).alias("title"))
    out = searchlog.search_title_match(s, t, inputs(spark)[4])
    plan = out._jdf.queryExecution().executedPlan().toString()
    keys = [x.split("]")[0] for x in plan.split("keys=[")[1:]]
    assert not [k for k in keys if "event_id" in k and "title" in k]
    assert tuple(out.first()) == (200, 200, 100.0, 200 * 2001)
