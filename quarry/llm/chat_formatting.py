"""Preference formatting: one prompt and two masked completions from a chosen and a rejected conversation.

The prompt is the longest common prefix of turns (equal role and text) of the
two conversations, rendered once; what follows it on either side is rendered as
a completion. A rendered turn is ``<|role|>\\n`` and ``text<|end|>\\n``; the mask
lists the lengths of these segments in characters with 1 where a loss is
trained (the body of an assistant turn) and 0 elsewhere, as ``9:0,120:1,...``.

Turns of one conversation are ordered by (turn, role, text); nulls in these
columns sort first, and null role or text counts as empty; repeated rows stay
separate turns. ``status`` is ``pair`` (both completions have turns),
``prefix`` (one conversation is a prefix of the other), ``identical``, or
``unpaired`` (one side is missing; the other is rendered as a completion after
an empty prompt). Rows without a pair id belong to no conversation and give
nothing; an empty table gives no row. Other columns are ignored. DataFrame
expressions only, one shuffle; a row of the result holds the turns of one pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the rendering.
HEAD_OPEN, HEAD_CLOSE, BODY_CLOSE = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"


def adjacent_pairs(conversations: DataFrame) -> DataFrame:
    """Turns with a pair and a side: conversation 2k is the chosen and 2k + 1 the rejected one of pair k."""
    conv = F.col("conv_id").cast("long")
    return conversations.where("conv_id IS NOT NULL").select(
        F.shiftright(conv, 1).alias("pair_id"),
        (F.pmod(conv, F.lit(2)) == 0).alias("is_chosen"),
        F.col("turn").cast("long").alias("turn"), "role", "text")


def other_answers(conversations: DataFrame) -> DataFrame:
    """(pair_id, c, r): every conversation as the chosen side c, and as the rejected side r its turns before the
    last assistant turn with the last assistant turn of the conversation whose id differs in the lowest bit in that place.
    Without such a partner r ends before the answer; a conversation without an assistant turn has no r."""
    item = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    sides = conversations.where("conv_id IS NOT NULL").groupBy(F.col("conv_id").cast("long").alias("pair_id")).agg(
        F.array_sort(F.collect_list(item)).alias("c"))
    from_end = F.array_position(F.reverse(F.transform("c", lambda t: F.coalesce(t["role"], F.lit("")))), F.lit(TRAINED_ROLE))
    sides = sides.withColumn("k", F.when(from_end > 0, F.size("c") - from_end.cast("int") + 1))
    answers = sides.where("k IS NOT NULL").select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.get("c", F.col("k") - 1)["text"].alias("answer"),
                                                  F.lit(True).alias("found"))
    own = F.get("c", F.col("k") - 1)
    other = F.when(F.col("found"), F.array(F.struct(own["turn"].alias("turn"), own["role"].alias("role"), F.col("answer").alias("text"))))
    none = F.filter("c", lambda t: F.lit(False))
    r = F.when(F.col("k").isNotNull(), F.concat(F.expr("slice(c, 1, k - 1)"), F.coalesce(other, none))).otherwise(none)
    return sides.join(answers, "pair_id", "left").select("pair_id", "c", r.alias("r"))


def _rendered(turns) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(HEAD_OPEN), t["role"], F.lit(HEAD_CLOSE), t["text"], F.lit(BODY_CLOSE))), "")


def _mask(turns) -> Column:
    head = len(HEAD_OPEN) + len(HEAD_CLOSE)
    return F.array_join(F.transform(turns, lambda t: F.concat(
        (F.length(t["role"]) + head).cast("string"), F.lit(":0,"),
        (F.length(t["text"]) + len(BODY_CLOSE)).cast("string"),
        F.when(t["role"] == TRAINED_ROLE, F.lit(":1")).otherwise(F.lit(":0")))), ",")


def format_preferences(turns: DataFrame) -> DataFrame:
    """One row per pair from rows (pair_id, is_chosen, turn, role, text)."""
    item = F.struct(F.col("turn").alias("turn"), F.col("role").cast("string").alias("role"),
                    F.col("text").cast("string").alias("text"))
    sides = turns.where("pair_id IS NOT NULL").groupBy("pair_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("is_chosen"), item))).alias("c"),
        F.array_sort(F.collect_list(F.when(~F.col("is_chosen"), item))).alias("r"))
    return format_sides(sides)


def format_sides(sides: DataFrame) -> DataFrame:
    """One row per (pair_id, c, r): the turns of the chosen and of the rejected conversation in order, (turn, role, text) each."""

    def plain(name):
        return F.transform(name, lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"),
                                                    F.coalesce(t["text"], F.lit("")).alias("text"))).alias(name)

    sides = sides.select("pair_id", plain("c"), plain("r"))
    differs = F.expr("array_position(zip_with(slice(c, 1, shared), slice(r, 1, shared), (x, y) -> x = y), false)")
    cut = (sides.withColumn("shared", F.least(F.size("c"), F.size("r"))).withColumn("at", differs)
           .withColumn("n_prompt_turns", F.when(F.col("at") == 0, F.col("shared").cast("long")).otherwise(F.col("at") - 1))
           .withColumn("p", F.expr("slice(c, 1, CAST(n_prompt_turns AS INT))"))
           .withColumn("n_chosen_turns", F.size("c") - F.col("n_prompt_turns"))
           .withColumn("n_rejected_turns", F.size("r") - F.col("n_prompt_turns"))
           .withColumn("c", F.expr("slice(c, CAST(n_prompt_turns AS INT) + 1, size(c))"))
           .withColumn("r", F.expr("slice(r, CAST(n_prompt_turns AS INT) + 1, size(r))")))
    status = (F.when(F.col("shared") == 0, "unpaired")
              .when((F.col("n_chosen_turns") > 0) & (F.col("n_rejected_turns") > 0), "pair")
              .when((F.col("n_chosen_turns") > 0) | (F.col("n_rejected_turns") > 0), "prefix").otherwise("identical"))
    return cut.select(
        "pair_id", status.alias("status"), "n_prompt_turns", "n_chosen_turns", "n_rejected_turns",
        _rendered(F.col("p")).alias("prompt"), _rendered(F.col("c")).alias("chosen"), _mask(F.col("c")).alias("chosen_mask"),
        _rendered(F.col("r")).alias("rejected"), _mask(F.col("r")).alias("rejected_mask"))


def _sql_turns(name: str, body: str, between: str) -> str:
    return f"coalesce(array_to_string(list_transform({name}, lambda t: {body}), '{between}'), '')"


_TEXT = "concat('<|', t.role, '|>', chr(10), t.text, '<|end|>', chr(10))"
_MASK = ("concat(length(t.role) + 5, ':0,', length(t.text) + 8, CASE WHEN t.role = 'assistant' THEN ':1' ELSE ':0' END)")

SQL = f"""
WITH items AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
answers AS (SELECT conv_id, k, text FROM items WHERE role = '{TRAINED_ROLE}' QUALIFY k = max(k) OVER (PARTITION BY conv_id)),
rejected AS (
  SELECT i.conv_id, i.k, i.role, i.text FROM items i JOIN answers a ON a.conv_id = i.conv_id WHERE i.k < a.k
  UNION ALL SELECT a.conv_id, a.k, '{TRAINED_ROLE}', o.text FROM answers a JOIN answers o ON o.conv_id = xor(a.conv_id, 1)),
sides AS (
  SELECT conv_id AS pair_id, list({{'role': role, 'text': text}} ORDER BY k) AS c,
    coalesce((SELECT list({{'role': j.role, 'text': j.text}} ORDER BY j.k) FROM rejected j WHERE j.conv_id = i.conv_id), []) AS r
  FROM items i GROUP BY conv_id),
cut AS (
  SELECT *, least(len(c), len(r)) AS shared,
    coalesce(list_position(list_transform(range(1, least(len(c), len(r)) + 1), lambda i: c[i] = r[i]), false) - 1,
             least(len(c), len(r))) AS n
  FROM sides)
SELECT pair_id,
  CASE WHEN shared = 0 THEN 'unpaired' WHEN len(c) > n AND len(r) > n THEN 'pair'
       WHEN len(c) > n OR len(r) > n THEN 'prefix' ELSE 'identical' END AS status,
  n AS n_prompt_turns, len(c) - n AS n_chosen_turns, len(r) - n AS n_rejected_turns,
  {_sql_turns("c[1:n]", _TEXT, "")} AS prompt,
  {_sql_turns("c[n + 1:]", _TEXT, "")} AS chosen, {_sql_turns("c[n + 1:]", _MASK, ",")} AS chosen_mask,
  {_sql_turns("r[n + 1:]", _TEXT, "")} AS rejected, {_sql_turns("r[n + 1:]", _MASK, ",")} AS rejected_mask
FROM cut
"""
