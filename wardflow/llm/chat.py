"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns (same role and text) is rendered once as
the prompt; what remains of either side is its completion, with the spans of
characters that a trainer should score (assistant texts); the rest of a
completion and the prompt are masked.

Defined cases: a null role or text counts as empty; turns are ordered by
(turn, role, text), nulls first, and rows repeated for one turn are kept in
that order; rows with a null conversation id belong to no conversation and
yield no pair; identical sides give empty completions and ``valid`` false;
pairs of which one side is absent are completed with an empty conversation.
Empty tables give no rows; extra columns are ignored.  A conversation is one
training example, so its turns are gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMPTY = "array<struct<role:string,text:string>>"


def gather_turns(turns: DataFrame, conv_id: str = "conv_id", name: str = "turns") -> DataFrame:
    """``(conv_id, turns)`` with turns in order."""
    t = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = F.transform(F.sort_array(F.collect_list(t)), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    return turns.filter(F.col(conv_id).isNotNull()).groupBy(F.col(conv_id).alias("conv_id")).agg(ordered.alias(name))


def head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t), t["text"], F.lit("\n"))), "")


def trained_spans(turns: Column, role: str = "assistant") -> Column:
    """``[start, end)`` of the assistant texts in the rendered completion
    (the closing line end included)."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        start = s["at"] + F.length(head(t))
        end = start + F.length(t["text"]) + 1
        own = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
        return F.struct(end.cast("int").alias("at"), F.when(t["role"] == role, F.concat(s["spans"], F.array(own)))
                        .otherwise(s["spans"]).alias("spans"))

    return F.aggregate(turns, state, step)["spans"]


def preference_format(pairs: DataFrame) -> DataFrame:
    """``pairs``: (conv_id, chosen, rejected) with arrays of (role, text).
    Returns ``conv_id, n_common, prompt, chosen, rejected, chosen_spans,
    rejected_spans, valid``."""
    p = pairs.select("conv_id", *[F.coalesce(F.col(c), F.array().cast(EMPTY)).alias(c) for c in ("chosen", "rejected")])
    shorter = F.least(F.size("chosen"), F.size("rejected"))
    differs = F.filter(F.sequence(F.lit(1), shorter), lambda i: F.element_at("chosen", i) != F.element_at("rejected", i))
    p = p.withColumn("n_common", F.when(shorter == 0, 0).otherwise(F.coalesce(F.get(differs, F.lit(0)) - 1, shorter)))
    rest = [F.slice(c, F.col("n_common") + 1, F.size(c)) for c in ("chosen", "rejected")]
    p = p.select("conv_id", "n_common", F.slice("chosen", 1, F.col("n_common")).alias("common"),
                 rest[0].alias("c"), rest[1].alias("r"))
    return p.select("conv_id", "n_common", render(F.col("common")).alias("prompt"), render(F.col("c")).alias("chosen"),
                    render(F.col("r")).alias("rejected"), trained_spans(F.col("c")).alias("chosen_spans"),
                    trained_spans(F.col("r")).alias("rejected_spans"),
                    ((F.size("c") > 0) | (F.size("r") > 0)).alias("valid"))


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """Pairs for a table of plain conversations: chosen is the conversation,
    rejected the same with its last reply replaced by the last reply of
    conversation ``conv_id xor 1`` (empty if there is none); turns after the
    last reply stand, masked, on both sides.  A conversation without
    assistant turn has equal sides."""
    c = gather_turns(turns)
    last = F.array_max(F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)), lambda i: i.isNotNull()))
    c = c.withColumn("last", last)
    c = c.withColumn("reply", F.when(F.col("last").isNotNull(), F.element_at("turns", F.col("last"))["text"]))
    other = c.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply").alias("other"))
    c = c.join(other, "conv_id", "left")
    reply = F.struct(F.lit("assistant").alias("role"), F.coalesce("other", F.lit("")).alias("text"))
    swapped = F.transform("turns", lambda t, i: F.when(i + 1 == F.col("last"), reply).otherwise(t))
    return c.select("conv_id", F.col("turns").alias("chosen"), F.when(F.col("last").isNull(), F.col("turns")).otherwise(swapped).alias("rejected"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")


CHAT_SQL = """
WITH t AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
l AS (SELECT *, list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')) AS last FROM t),
p AS (SELECT l.conv_id, l.turns AS c, CASE WHEN l.last IS NULL THEN l.turns ELSE list_concat(list_append(l.turns[1:l.last - 1],
          {'role': 'assistant', 'text': coalesce(o.turns[o.last].text, '')}), l.turns[l.last + 1:]) END AS r
      FROM l LEFT JOIN l o ON o.conv_id = xor(l.conv_id, 1)),
n AS (SELECT *, coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i] <> r[i])) - 1, least(len(c), len(r))) AS k FROM p),
s AS (SELECT conv_id, k, c[1:k] AS common, c[k + 1:] AS c, r[k + 1:] AS r FROM n),
e AS (SELECT *, [len('<|' || x.role || '|>' || chr(10)) + len(x.text) + 1 for x in c] AS cl,
        [len('<|' || x.role || '|>' || chr(10)) + len(x.text) + 1 for x in r] AS rl FROM s)
SELECT conv_id, k::INT AS n_common,
  coalesce(array_to_string(['<|' || x.role || '|>' || chr(10) || x.text || chr(10) for x in common], ''), '') AS prompt,
  coalesce(array_to_string(['<|' || x.role || '|>' || chr(10) || x.text || chr(10) for x in c], ''), '') AS chosen,
  coalesce(array_to_string(['<|' || x.role || '|>' || chr(10) || x.text || chr(10) for x in r], ''), '') AS rejected,
  coalesce(array_to_string([(list_sum(cl[1:i]) - len(c[i].text) - 1)::BIGINT || '-' || list_sum(cl[1:i])::BIGINT for i in range(1, len(c) + 1) if c[i].role = 'assistant'], ','), '') AS chosen_spans,
  coalesce(array_to_string([(list_sum(rl[1:i]) - len(r[i].text) - 1)::BIGINT || '-' || list_sum(rl[1:i])::BIGINT for i in range(1, len(r) + 1) if r[i].role = 'assistant'], ','), '') AS rejected_spans,
  len(c) > 0 OR len(r) > 0 AS valid
FROM e"""
