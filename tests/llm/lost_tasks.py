"""Run in a separate process: operators over a source whose tasks fail at their first attempt
give the same rows as over a sound one (failures are injected here only)."""

import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import public_tokenizers  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402


def failing(batches):
    task = TaskContext.get()
    for batch in batches:
        yield batch
        if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
            raise RuntimeError("injected failure")


def main(sf_dir: str, names: list[str]) -> None:
    spark = (SparkSession.builder.master("local[4,3]").appName("quarry-lost-tasks").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from pyspark.sql import functions as F

    from quarry.llm import (decontamination, jaccard_join, license_scan, line_dedup, minhash_dedup, packing, prefix_trie, quality_rules,
                            spelling_variants, suffix_dedup, token_output)

    word, byte = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
    operators = {
        "packing": lambda d: packing.pieces(packing.pack(spark, d, byte)),
        "suffix_dedup": lambda d: suffix_dedup.remove_repeats(spark, d).drop("kept"),
        "token_output": lambda d: token_output.ids_by_document(spark, d, word),
        "jaccard_join": lambda d: jaccard_join.similar_components(spark, d),
        "line_dedup": lambda d: line_dedup.dedup_lines(spark, d),
        "minhash_dedup": lambda d: minhash_dedup.near_duplicates(spark, d),
        "prefix_trie": lambda d: prefix_trie.shared_prefixes(spark, d),
        "spelling_variants": lambda d: spelling_variants.variants(spark, d),
        "decontamination": lambda d: decontamination.find_leaks(spark, d, spark.read.parquet(f"{sf_dir}/benchmark.parquet")),
        "license_scan": lambda d: license_scan.scan(spark, d),
        # sums of logarithms come in another order
        "quality_rules": lambda d: quality_rules.score(spark, d.withColumn("lang", F.lit("en"))).withColumns(
            {k: F.round(k, 4) for k in ("perplexity", "words_perplexity", "lower_band", "upper_band")}),
    }

    def same(name):
        table = spark.read.parquet(f"{sf_dir}/conversations.parquet") if name == "prefix_trie" else \
            spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
        rows = [sorted(map(repr, operators[name](t).collect())) for t in (table.mapInArrow(failing, table.schema), table)]
        return rows[0] == rows[1]

    print(json.dumps({name: same(name) for name in names}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
