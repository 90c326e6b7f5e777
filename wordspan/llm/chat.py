"""Preference formatting of conversations. DataFrame functions only.

Of a chosen and a rejected conversation, the longest common prefix of turns is rendered once as the
prompt; what follows is rendered for either side, with the character spans that a loss may use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import heavy_keys, salted_join, stash


def with_drawn_reply(turns: DataFrame) -> DataFrame:
    """(conv_id, turns, partner, last, reply): every conversation with the reply of another, drawn deterministically.

    Of the conversations with a reply (a last turn of an assistant), the next by id is the partner, and the first that of
    the last, however far apart ids lie; ``last`` is where the own reply stands, from 1. Null where there is
    no own reply or no other one. A null conv_id takes no part. Turns are shuffled once, by conversation; replies alone go
    through ranges of ids, and only the first reply of each range meets the range before."""
    rows = turns.where("conv_id is not null")
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    said = rows.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "assistant", turn)).alias("said")).where("said is not null")
    own = F.struct(F.col("conv_id").alias("partner"), F.col("said.text").alias("reply")).alias("own")
    # The range of a row is written with it, so that a task run again can't deal rows otherwise.
    ranged = stash(said.select("conv_id", own).repartitionByRange("conv_id").withColumn("range", F.spark_partition_id()), "replies")
    ends = ranged.groupBy("range").agg(F.min_by("own", "conv_id").alias("own"))  # a row a range
    ring = Window.orderBy("range")
    after = F.coalesce(F.lead("own").over(ring), F.first("own").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    follow = F.broadcast(ends.select("range", after.alias("after")))
    drawn = ranged.withColumn("next", F.lead("own").over(Window.partitionBy("range").orderBy("conv_id"))).join(follow, "range")
    drawn = drawn.select("conv_id", F.coalesce("next", "after").alias("next")).where(F.col("next.partner") != F.col("conv_id"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)))
    return convs.join(drawn, "conv_id", "left").select("conv_id", "turns", F.col("next.partner").alias("partner"), F.when(F.col("next").isNotNull(), last).alias("last"), F.col("next.reply").alias("reply"))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, chosen_turns, rejected_turns), one row for each conversation but those that others are rejected for.

    Conversations that open with the same turn: the smallest id is the chosen one of a pair with each other. A
    conversation that opens alone, up to its last reply, is chosen over itself with the reply drawn from another (rejected_id
    is that one's id); without any reply it has no rejected side. Rows grow with the conversations, not with the pairs of a group."""
    first = F.sha2(F.to_json(F.struct(F.col("turns")[0]["role"].alias("role"), F.col("turns")[0]["text"].alias("text"))), 256)
    convs = stash(with_drawn_reply(turns).withColumn("opening", first), "conversations")
    heads = stash(convs.groupBy("opening").agg(F.min("conv_id").alias("chosen_id"), F.count("*").alias("n")).where("n > 1"), "openings")
    known = heads.join(convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen_turns")), "chosen_id").select("opening", "chosen_id", "chosen_turns")
    shared = salted_join(convs.select("conv_id", "turns", "opening"), known, "opening", F.xxhash64("conv_id"), heavy_keys(heads, "opening")).where("conv_id <> chosen_id")
    shared = shared.select("chosen_id", F.col("conv_id").alias("rejected_id"), "chosen_turns", F.col("turns").alias("rejected_turns"))
    alone = convs.join(heads, "opening", "left_anti")
    until = F.when(F.col("last").isNotNull(), F.slice("turns", F.lit(1), F.col("last"))).otherwise(F.col("turns"))
    said = F.element_at("turns", F.coalesce("last", F.lit(1)))
    other = F.concat(F.slice("turns", F.lit(1), F.coalesce(F.col("last") - 1, F.lit(0))), F.array(F.struct(said["turn"].alias("turn"), said["role"].alias("role"), F.col("reply").alias("text"))))
    alone = alone.select(F.col("conv_id").alias("chosen_id"), F.col("partner").alias("rejected_id"), until.alias("chosen_turns"), F.when(F.col("last").isNotNull(), other).alias("rejected_turns"))
    return shared.unionByName(alone)


def render(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def _completion(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render), "")


def _mask(turns: Column) -> Column:
    """Character spans 'start-end' of what assistants say in the rendered turns, joined by commas."""

    def step(acc: Column, turn: Column) -> Column:
        head = F.length(turn["role"]) + 5
        start = acc["at"] + head
        span = F.concat_ws("-", start.cast("string"), (start + F.length(turn["text"])).cast("string"))
        spans = F.when(turn["role"] == "assistant", F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((start + F.length(turn["text"]) + 8).alias("at"), spans.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, begin, step, lambda acc: F.array_join(acc["spans"], ","))


def preferences(pairs: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask) of preference_pairs.

    The prompt is the longest common prefix of turns with equal role and text. Without a rejected side it is
    what comes before the last turn, and the rejected side is null. Two equal sides are all prompt, with empty
    completions. Turns are in order of their numbers (ties by role, then text); a null number comes first,
    null roles and texts are empty strings; repeated rows are turns of their own.
    """
    a, b = F.col("chosen_turns"), F.col("rejected_turns")
    differs = lambda i: (F.get(a, i)["role"] != F.get(b, i)["role"]) | (F.get(a, i)["text"] != F.get(b, i)["text"])
    shorter = F.least(F.size(a), F.size(b))
    first = F.array_min(F.filter(F.sequence(F.lit(0), shorter - 1), differs))
    n = F.when(b.isNull(), F.size(a) - 1).otherwise(F.coalesce(first, shorter))
    both = pairs.withColumn("n", n)
    rest = lambda turns: F.slice(turns, F.col("n") + 1, F.size(turns))
    return both.select(
        "chosen_id", "rejected_id", F.col("n").cast("long").alias("n_prompt_turns"), _completion(F.slice(a, F.lit(1), F.col("n"))).alias("prompt"), _completion(rest(a)).alias("chosen"), _mask(rest(a)).alias("chosen_mask"),
        F.when(b.isNotNull(), _completion(rest(b))).alias("rejected"), F.when(b.isNotNull(), _mask(rest(b))).alias("rejected_mask"),
    )


def oracle() -> str:
    """SQL from the rules: sides as rows of turns, each pair with a number of its own."""
    sides = lambda kind, mask: f"coalesce(string_agg(r, '' ORDER BY pos) FILTER ({kind}), '') AS {mask}"
    spans = lambda kind, name: f"coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(start + length(text) AS BIGINT), ',' ORDER BY pos) FILTER ({kind} AND role = 'assistant'), '') AS {name}"
    return f"""
WITH turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
opened AS (SELECT conv_id, min(conv_id) OVER (PARTITION BY role, text) AS head, count(*) OVER (PARTITION BY role, text) AS n FROM turns WHERE pos = 1),
replies AS (SELECT conv_id, max(pos) AS last, arg_max(text, pos) AS reply FROM turns WHERE role = 'assistant' GROUP BY conv_id),
ring AS (SELECT conv_id, last, coalesce(lead(conv_id) OVER o, first(conv_id) OVER w) AS partner FROM replies
         WINDOW o AS (ORDER BY conv_id), w AS (ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
drawn AS (SELECT g.conv_id, g.last, g.partner, r.reply FROM ring g JOIN replies r ON r.conv_id = g.partner WHERE g.partner <> g.conv_id),
pairs AS (SELECT conv_id AS pair, CASE WHEN n > 1 THEN head ELSE conv_id END AS chosen_id, CASE WHEN n > 1 THEN conv_id ELSE d.partner END AS rejected_id, n > 1 AS shared, CASE WHEN n = 1 THEN d.last END AS last, d.reply
          FROM opened LEFT JOIN drawn d USING (conv_id) WHERE n = 1 OR conv_id <> head),
a AS (SELECT p.pair, t.pos, t.role, t.text FROM pairs p JOIN turns t ON t.conv_id = p.chosen_id WHERE p.last IS NULL OR t.pos <= p.last),
b AS (SELECT p.pair, t.pos, t.role, CASE WHEN t.pos = p.last THEN p.reply ELSE t.text END AS text FROM pairs p JOIN turns t ON t.conv_id = p.pair WHERE p.shared OR t.pos <= p.last),
sizes AS (SELECT pair, max(pos) AS n FROM a GROUP BY pair), others AS (SELECT pair, max(pos) AS n FROM b GROUP BY pair),
diff AS (SELECT a.pair, min(a.pos) AS at FROM a JOIN b ON a.pair = b.pair AND a.pos = b.pos WHERE a.role <> b.role OR a.text <> b.text GROUP BY a.pair),
cut AS (SELECT p.*, o.n IS NOT NULL AS has, CASE WHEN o.n IS NULL THEN s.n - 1 ELSE coalesce(d.at - 1, least(s.n, o.n)) END AS k FROM pairs p JOIN sizes s USING (pair) LEFT JOIN others o USING (pair) LEFT JOIN diff d USING (pair)),
shown AS (SELECT x.*, pos <= k AS pre, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS r FROM (SELECT *, true AS mine FROM a UNION ALL SELECT *, false FROM b) x JOIN cut USING (pair)),
placed AS (SELECT *, sum(length(r)) OVER (PARTITION BY pair, mine, pre ORDER BY pos) - length(r) + length(role) + 5 AS start FROM shown),
joined AS (SELECT pair, {sides('pre AND mine', 'prompt')}, {sides('NOT pre AND mine', 'chosen')}, {spans('NOT pre AND mine', 'chosen_mask')}, {sides('NOT pre AND NOT mine', 'rejected')}, {spans('NOT pre AND NOT mine', 'rejected_mask')} FROM placed GROUP BY pair)
SELECT c.chosen_id, c.rejected_id, CAST(c.k AS BIGINT) AS n_prompt_turns, j.prompt, j.chosen, j.chosen_mask, CASE WHEN c.has THEN j.rejected END AS rejected, CASE WHEN c.has THEN j.rejected_mask END AS rejected_mask
FROM cut c JOIN joined j USING (pair)
"""
