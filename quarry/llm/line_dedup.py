"""Line dedup: repeated runs of lines by prefix doubling over line-id sequences.

A text is a sequence of line ids (64-bit hashes of its lines). The name of a position at length 2^k stands for
the 2^k lines from there; it is made of the names at that position and 2^(k-1) lines on, so equal names
are equal runs: the positions of one interval of the suffix array, those whose common prefix has at least 2^k lines. Two names of one length
that overlap name a run of any length between, so the interval of a longest common prefix of any number of lines is a group of
equal pairs of names. Lengths are doubled as far as the longest run that is asked for. Names are hashes and not ranks: the
intervals are the same, and no global sort is needed. A line that stands once in the corpus ends every repeated run, so only
lines that stand twice are counted any further.

Deleted are the later copies, in order of (doc_id, row), of every run of lines that stands earlier in the corpus (the same text
included) and has ``RUN_WORDS`` words in total, be it one line or many; a run begins and ends with a line that has words, and what lies between
goes with it. A maximal run of this kind is the union of its shortest parts of two worded lines or more with so many words, from
each worded line on and up to each (a part of a later copy is one, and each line of a run lies in such a part), so intervals
are asked for these lengths only, and their later copies joined are the maximal runs. The first copy of a run stays.

Defined results: null text has one empty line and stays null; texts are split
at line feeds only; a repeated row counts as a copy that follows the first; null doc_id
sorts first; other columns are kept as they are; an empty table gives no row; a text of any length is read whole.
A line that many documents share is one name: it is counted before the shuffle, and
its positions are joined to that one count, which Spark splits over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import _store

RUN_WORDS = 8
WORD = r"[^ \t\n\x0B\f\r]+"


def _later(spark: SparkSession, positions: DataFrame, name: str) -> DataFrame:
    """The positions whose name occurs more than once, and whether an earlier one has it."""
    first = (positions.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "row", "i")).alias("first"))
             .where("n > 1").select("name", F.col("first.row").alias("first_row"), F.col("first.i").alias("first_i")))
    # written, so that the join below sees two plain shuffles and splits a frequent name
    first = _store.written(spark, first, f"{name}-names")
    return _store.written(spark, positions.join(first, "name").select(
        *positions.columns,
        (~((F.col("row") == F.col("first_row")) & (F.col("i") == F.col("first_i")))).alias("later")), name)


def _parts(rows: DataFrame) -> DataFrame:
    """With ``parts``: index pairs (a, b) of the repeated lines ``r`` of a row, the shortest runs of two worded lines or more with
    RUN_WORDS words from each worded line on and up to each."""
    def enough(part):  # how many of the first lines have so many words
        done = lambda a: (a["n"] >= 2) & (a["words"] >= RUN_WORDS)
        return F.aggregate(
            part, F.struct(F.lit(0).alias("n"), F.lit(0).alias("words")),
            lambda a, x: F.when(done(a), a).otherwise(F.struct((a["n"] + 1).alias("n"), (a["words"] + x["words"]).alias("words"))),
            lambda a: F.when(done(a), a["n"]))

    def parts(x, v):  # from the worded line v on, and up to it; RUN_WORDS lines have so many words
        start = F.greatest(v - RUN_WORDS + 2, F.lit(1))
        return F.array(
            F.struct(x["k"].alias("a"), F.get("worded", v + enough(F.slice("worded", v + 1, RUN_WORDS)) - 1)["k"].alias("b")),
            F.struct(F.get("worded", v + 1 - enough(F.reverse(F.slice("worded", start, v + 2 - start))))["k"].alias("a"), x["k"].alias("b")))

    line = lambda k: F.get("r", k)["i"]
    # a line that is not repeated has no entry, and no run goes over it
    whole = F.filter("parts", lambda p: p["a"].isNotNull() & p["b"].isNotNull() & (line(p["b"]) - line(p["a"]) == p["b"] - p["a"]))
    return (rows.withColumn("worded", F.filter(F.transform("r", lambda x, k: F.struct(k.alias("k"), x["words"].alias("words"))),
                                               lambda x: x["words"] > 0))
            .withColumn("parts", F.array_distinct(F.flatten(F.transform("worded", parts)))).withColumn("parts", whole).drop("worded"))


def _whole_runs(spark: SparkSession, level: DataFrame) -> DataFrame:
    """(row, i): lines in later copies of runs of two worded lines or more; ``level`` has all repeated lines."""
    rows = level.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("i", "name", "words"))).alias("r"))
    rows = _store.written(spark, _parts(rows).where(F.size("parts") > 0), "line-run-parts")
    most = rows.agg(F.max(F.array_max(F.transform("parts", lambda p: p["b"] - p["a"] + 1)))).first()[0] or 1
    levels = most.bit_length()
    rows = rows.withColumn("names_0", F.transform("r", lambda x: x["name"]))
    for k in range(1, levels):  # null where 2^k lines are not left
        rows = rows.withColumn(f"names_{k}", F.expr(
            f"transform(names_{k - 1}, (v, x) -> if(x + {1 << k} <= size(r), xxhash64(v, get(names_{k - 1}, x + {1 << (k - 1)})), NULL))"))
    size = F.col("p.b") - F.col("p.a") + 1
    name = F.coalesce(*[F.when(size >= (1 << k), F.xxhash64(
        size, F.get(f"names_{k}", F.col("p.a")), F.get(f"names_{k}", F.col("p.b") + 1 - (1 << k)))) for k in reversed(range(levels))])
    line = lambda k: F.get("r", k)["i"]
    runs = rows.withColumn("p", F.explode("parts")).select(
        "row", "doc_id", line(F.col("p.a")).alias("i"), line(F.col("p.b")).alias("last"), name.alias("name"))
    return _later(spark, runs, "line-runs-words").where("later").select("row", F.explode(F.sequence("i", "last")).alias("i"))


def repeated_lines(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """(row, removed): the deleted line numbers of each row of (row, doc_id, lines as structs of name and words)."""
    at = F.posexplode("lines").alias("i", "line")
    positions = texts.select("row", "doc_id", at).select(
        "row", "doc_id", "i", F.col("line.name").alias("name"), F.col("line.words").alias("words"))
    level = _later(spark, positions, "line-runs-1")
    gone = level.where(f"later AND words >= {RUN_WORDS}").select("row", "i").unionByName(_whole_runs(spark, level))
    return gone.groupBy("row").agg(F.collect_set("i").alias("removed"))


def mark(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc, lines, removed): each document, its lines and the numbers of the deleted ones."""
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    table = docs.select(F.struct("*").alias("doc")).select(
        F.monotonically_increasing_id().alias("row"), "doc",
        F.transform(F.split(text, "\n", -1), lambda x: F.struct(F.xxhash64(x).alias("name"), F.regexp_count(x, F.lit(WORD)).alias("words"))).alias("lines"))
    table = _store.written(spark, table, "lines")
    removed = repeated_lines(spark, table.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), "lines"))
    return (table.select("row", "doc", F.split(text, "\n", -1).alias("lines")).join(removed, "row", "left")
            .select("doc", "lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed")))


def _rest(marked: DataFrame) -> DataFrame:
    """With ``text``: the lines that stay (null where the text was null)."""
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    return marked.withColumn("stay", stay).withColumn("text", F.when(
        F.col("doc.text").isNotNull(), F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")))


def dedup_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: line counts, number of deleted runs, and the text that is left."""
    runs = F.size(F.array_except("removed", F.transform("removed", lambda i: i + 1)))
    return _rest(mark(spark, docs)).select(
        F.col("doc.doc_id").alias("doc_id"), F.size("lines").cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"), runs.cast("long").alias("n_runs"), "text")


def drop_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents without the deleted lines, in all their columns (n_chars follows the text); a document of
    which no visible line is left, but some were deleted, goes."""
    rest = _rest(mark(spark, docs)).where((F.size("removed") == 0) | (F.trim(F.translate("text", "\n", "")) != ""))
    new = {"text": F.col("text"), "n_chars": F.when(F.size("removed") == 0, F.col("doc.n_chars")).otherwise(
        F.length("text")).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": F.col("text")}
    return rest.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


SQL = f"""
WITH lines AS (
  SELECT doc_id, text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
counted AS (SELECT *, len(regexp_extract_all(line, '[^ \\t\\n\\x0B\\f\\r]+')) AS words FROM lines),
sums AS (SELECT doc_id, i, words, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM counted),
firsts AS (SELECT doc_id, upto, min(i) AS b FROM sums GROUP BY ALL),
lasts AS (SELECT doc_id, upto - words AS before, max(i) AS a FROM sums GROUP BY ALL),
runs AS (
  SELECT s.doc_id, s.i AS a, f.b FROM (SELECT doc_id, i, greatest(upto - words + {RUN_WORDS}, upto + 1) AS goal FROM sums WHERE words > 0) s
  ASOF JOIN firsts f ON f.doc_id = s.doc_id AND s.goal <= f.upto
  UNION SELECT s.doc_id, l.a, s.i FROM (SELECT doc_id, i, least(upto - {RUN_WORDS}, upto - words - 1) AS goal FROM sums WHERE words > 0) s
  ASOF JOIN lasts l ON l.doc_id = s.doc_id AND s.goal >= l.before
  UNION SELECT doc_id, i, i FROM sums WHERE words >= {RUN_WORDS}),
named AS (
  SELECT r.doc_id, a, b, array_to_string(string_split(coalesce(text, ''), chr(10))[a + 1:b + 1], chr(10)) AS content
  FROM runs r JOIN documents d ON d.doc_id = r.doc_id),
later AS (SELECT doc_id, a, b FROM named QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, a) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM later),
marked AS (
  SELECT l.doc_id, l.text, l.i, l.line, g.i IS NOT NULL AS gone,
         lag(g.i) OVER (PARTITION BY l.doc_id ORDER BY l.i) IS NULL AND g.i IS NOT NULL AS begins
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_runs,
  CASE WHEN any_value(text) IS NOT NULL THEN coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') END AS text
FROM marked GROUP BY doc_id
"""
