"""Columns named like those that stages use inside, Arrow batches of any size, and the pairs and labels of the native operators."""

from llm_cases import odd_docs

from quarry.llm import chat_formatting, decontamination, jaccard_join, license_scan


def test_stages_keep_columns_of_any_name(spark):
    docs = odd_docs(spark).withColumnRenamed("row", "copy").withColumnRenamed("node", "leaked").withColumnRenamed("key", "Copy_")
    kept = jaccard_join.keep_one(spark, docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 7").count() == 0
    benchmark = docs.where("doc_id = 16").select(docs.doc_id.alias("item_id"), "text").unionByName(
        docs.where("doc_id = -16").select(docs.doc_id.alias("item_id"), "text"))
    clean = decontamination.drop_leaks(spark, docs, benchmark)
    assert clean.columns == docs.columns
    assert clean.where("doc_id = -16").count() == 0 and clean.where("doc_id = 6").count() == 1


def test_many_short_texts_in_one_batch(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200000")
    try:
        docs = spark.range(0, 100_000, 1, 1).selectExpr("id AS doc_id", "concat('t', id % 99999) AS text")
        got = jaccard_join.similar_components(spark, docs)
        assert got.where("component_id <> doc_id").select("doc_id", "component_id").collect() == [(99_999, 0)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_license_labels_of_notices_that_share_words(spark):
    lines = ["This work is licensed under the GNU General Public License, version 3", "Licensed under CC BY-NC 4.0", "Released under the Apache License",
             "Licensed under CC BY-NC-SA 4.0", "This work is licensed under the GNU General Public License, version 2",
             "Licensed under the GNU Lesser General Public License", "Released under the MIT License", "Licensed under the Apache License, Version 2.0",
             "This work is licensed\nunder the GNU General\nPublic License, version 3"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = [r.labels for r in license_scan.scan(spark, docs).orderBy("doc_id").collect()]
    assert got == ["gpl,gpl-3.0", "cc-by-nc-4.0", "apache", "cc-by-nc-sa-4.0", "gpl,gpl-2.0", "gpl,lgpl", "mit", "apache,apache-2.0", "gpl,gpl-3.0"]


def test_answers_of_another_conversation_share_the_prompt(spark, sf_small):
    turns = [(0, 0, "system", "be brief"), (0, 1, "user", "hi"), (0, 2, "assistant", "hello"), (0, 3, "user", "more"), (0, 4, "assistant", "yes"), (0, 5, "user", "bye"),
             (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "no answer"), (4, 0, None, "x"), (4, None, "assistant", None), (None, 0, "user", "lost")]
    df = spark.createDataFrame([(*t, "x", "y") for t in turns], "conv_id long, turn long, role string, text string, c string, r string")
    got = {r.pair_id: r for r in chat_formatting.format_sides(chat_formatting.other_answers(df)).collect()}
    assert got[0].status == "pair" and got[0].n_prompt_turns == 4 and got[0].n_chosen_turns == 2
    assert got[0].rejected == "<|assistant|>\nb<|end|>\n" and got[1].rejected == "<|assistant|>\nyes<|end|>\n"
    assert got[2].status == "unpaired" and got[4].n_rejected_turns == 0 and set(got) == {0, 1, 2, 4}
    assert chat_formatting.format_sides(chat_formatting.other_answers(df.limit(0))).count() == 0
    real = chat_formatting.format_sides(chat_formatting.other_answers(spark.read.parquet(f"{sf_small}/conversations.parquet")))
    assert real.where("status = 'pair' AND n_prompt_turns = 0").count() == 0 and real.where("n_prompt_turns > 0").count() > 0.5 * real.count()
