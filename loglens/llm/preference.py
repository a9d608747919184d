"""Preference formatting of chosen and rejected conversations.

The two conversations of a pair are compared turn by turn (role and text, nulls
equal to nulls); their longest common prefix of turns is rendered once as the
prompt, what follows in each is its completion.  A completion's mask lists the
character spans that are trained on: the texts and end marks of the trained
roles.  A turn is rendered as ``<|role|>`` + line end + text + ``<|end|>`` + line end.

Turns of a conversation are ordered by turn, then role, then text (nulls first);
repeated equal rows count once, and rows without a conversation id are ignored.
A null role or text is rendered as empty.  Equal conversations have empty
completions, and where one is a prefix of the other its completion is empty.
One conversation is one row of the result, so its turns meet in one task.
Columns other than those named in the calls have no influence, whatever their names;
an empty table gives no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.llm.tables import table

TRAINED = ("assistant",)
END = "<|end|>\n"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): one row per conversation, its turns in order as array<struct<role, text>>."""
    one = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    got = turns.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_set(one)).alias("t"))
    return got.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def _head(x: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(x["role"], F.lit("")), F.lit("|>\n"))


def _body(x: Column) -> Column:
    return F.concat(F.coalesce(x["text"], F.lit("")), F.lit(END))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(_head(x), _body(x))), "")


def _mask(turns: Column, trained: tuple[str, ...]) -> Column:
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<from: int, to: int>>)").alias("spans"))

    def step(acc, x):
        start = acc["at"] + F.char_length(_head(x))
        end = start + F.char_length(_body(x))
        one = F.when(x["role"].isin(*trained), F.array(F.struct(start.alias("from"), end.alias("to")))).otherwise(F.slice(acc["spans"], 1, 0))
        return F.struct(end.alias("at"), F.concat(acc["spans"], one).alias("spans"))

    return F.aggregate(turns, zero, step, lambda acc: acc["spans"])


def format_pairs(pairs: DataFrame, trained: tuple[str, ...] = TRAINED, id_col: str = "pair_id", chosen_col: str = "chosen", rejected_col: str = "rejected") -> DataFrame:
    """(pair_id, n_prefix, prompt, chosen, rejected, chosen_mask, rejected_mask) of pairs of turn arrays."""
    empty = F.expr("cast(array() as array<struct<role: string, text: string>>)")
    own = pairs.select(F.col(id_col).alias("pair_id"), F.coalesce(F.col(chosen_col), empty).alias("c"), F.coalesce(F.col(rejected_col), empty).alias("r"))
    shorter = F.least(F.size("c"), F.size("r"))
    same = F.zip_with(F.slice("c", 1, shorter), F.slice("r", 1, shorter), lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    first = F.array_position(same, False)
    cut = own.withColumn("n_prefix", F.when(first > 0, first - 1).otherwise(shorter).cast("int"))
    tail = lambda x: F.slice(x, F.col("n_prefix") + 1, F.size(x))
    cut = cut.select("pair_id", "n_prefix", F.slice("c", 1, F.col("n_prefix")).alias("p"), tail("c").alias("c"), tail("r").alias("r"))
    return cut.select("pair_id", "n_prefix", _render(F.col("p")).alias("prompt"), _render(F.col("c")).alias("chosen"), _render(F.col("r")).alias("rejected"),
                      _mask(F.col("c"), trained).alias("chosen_mask"), _mask(F.col("r"), trained).alias("rejected_mask"))


def reply_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected) from a table without preferences: a conversation up to its last assistant turn
    is chosen, and the same with that reply replaced by the assistant's reply before it (empty if there is none) rejected.
    """
    c = conversations(turns).withColumn("at", F.array_max(F.filter(F.transform("turns", lambda x, i: F.when(x["role"] == "assistant", i)), lambda k: k.isNotNull())))
    c = c.where("at is not null")
    before = F.filter(F.slice("turns", 1, F.col("at")), lambda x: x["role"] == "assistant")
    reply = F.when(F.size(before) > 0, F.element_at(before, -1)["text"]).otherwise(F.lit(""))
    other = F.array(F.struct(F.lit("assistant").alias("role"), reply.alias("text")))
    return c.select(F.col("conv_id").alias("pair_id"), F.slice("turns", 1, F.col("at") + 1).alias("chosen"),
                    F.concat(F.slice("turns", 1, F.col("at")), other).alias("rejected"))


def q_op2(spark, sf_dir: str) -> DataFrame:
    out = format_pairs(reply_pairs(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat(s["from"].cast("string"), F.lit("-"), s["to"].cast("string"))), ",")
    return out.withColumns({"chosen_mask": text("chosen_mask"), "rejected_mask": text("rejected_mask")})


ORACLE_OP2 = """
WITH d AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i FROM d),
l AS (SELECT conv_id, max(i) AS k FROM t WHERE role = 'assistant' GROUP BY conv_id),
b AS (SELECT conv_id, max(i) AS j FROM t JOIN l USING (conv_id) WHERE role = 'assistant' AND i < k GROUP BY conv_id),
o AS (SELECT l.conv_id, k, CASE WHEN j IS NULL THEN '' ELSE x.text END AS other FROM l LEFT JOIN b USING (conv_id) LEFT JOIN t x ON x.conv_id = l.conv_id AND x.i = j),
s AS (SELECT o.conv_id, k, other, t.text AS own, CASE WHEN t.text IS NOT DISTINCT FROM other THEN k ELSE k - 1 END AS n FROM o JOIN t ON t.conv_id = o.conv_id AND t.i = o.k),
p AS (SELECT t.conv_id, string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(t.text, '') || '<|end|>' || chr(10), '' ORDER BY i) AS prompt
      FROM t JOIN s ON s.conv_id = t.conv_id WHERE i <= n GROUP BY t.conv_id)
SELECT s.conv_id AS pair_id, CAST(n AS INTEGER) AS n_prefix, coalesce(prompt, '') AS prompt,
       CASE WHEN n < k THEN '<|assistant|>' || chr(10) || coalesce(own, '') || '<|end|>' || chr(10) ELSE '' END AS chosen,
       CASE WHEN n < k THEN '<|assistant|>' || chr(10) || coalesce(other, '') || '<|end|>' || chr(10) ELSE '' END AS rejected,
       CASE WHEN n < k THEN '14-' || (22 + length(coalesce(own, ''))) ELSE '' END AS chosen_mask,
       CASE WHEN n < k THEN '14-' || (22 + length(coalesce(other, ''))) ELSE '' END AS rejected_mask
FROM s LEFT JOIN p USING (conv_id)
"""
