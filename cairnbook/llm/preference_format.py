"""Chat formatting of preference pairs, with SQL operations only.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (equal role and text) is the
prompt, rendered once; the turns after it are the two completions. A pair is one record: the prompt, both completions,
and for each completion the spans that are trained on, the text and end marker of its assistant turns; nothing else is.
Pairs of over ``BLOCK`` turns become one record for each ``BLOCK`` turn numbers, in order of ``block``, so that no
conversation, however long, is gathered in one row; joined in that order the records are the pair.

Turns are aligned by their number. Null role or text counts as empty; of several different rows for one turn the
first by role, then text, stands, and repeated rows count once. Rows with null pair or turn are not rendered,
nor pairs with a side that has no turns. Pairs that agree in all turns are all prompt. Markers inside a text are broken
up, so that a text can't close its own turn. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"
#: Turn numbers of one record.
BLOCK = 256


def _rendered(said: Column) -> Column:
    head, tail = OPEN.split("{}")
    return F.concat(F.lit(head), said["role"], F.lit(tail), F.replace(said["text"], F.lit("<|"), F.lit("< |")), F.lit(CLOSE))


def _trained(shown: Column) -> Column:
    """start:end of each assistant turn's text and end marker, among rendered turns that follow each other."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(so_far: Column, x: Column) -> Column:
        end = so_far["at"] + F.length(x["rendered"])
        start = so_far["at"] + F.length(x["role"]) + len(OPEN.format(""))
        span = F.when(x["role"] == "assistant", F.array(F.concat_ws(":", start, end - 1))).otherwise(F.array().cast("array<string>"))
        return F.struct(end.alias("at"), F.concat(so_far["spans"], span).alias("spans"))

    return F.aggregate(shown, state, step, lambda x: F.array_join(x["spans"], ","))


def formatted(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One record per pair (and block): pair_id, block, prompt, chosen, rejected, chosen_spans, rejected_spans and the
    numbers of turns of the three parts.

    turns: pair_id, side (chosen or rejected), turn, role, text.
    """
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    own = lambda name: F.min(F.when(F.col("side") == name, said)).alias(name)
    both = turns.where("pair_id is not null and turn is not null").groupBy("pair_id", "turn").agg(own("chosen"), own("rejected"))
    same = F.coalesce(F.col("chosen") == F.col("rejected"), F.lit(False))
    ends = both.groupBy("pair_id").agg(F.min(F.when(~same, F.col("turn"))).alias("split"), F.count("chosen").alias("n_c"), F.count("rejected").alias("n_r"))
    both = both.join(ends.where("n_c > 0 and n_r > 0").select("pair_id", "split"), "pair_id")
    prompt = F.col("split").isNull() | (F.col("turn") < F.col("split"))
    turns = F.array_sort(F.collect_list(F.struct("turn", prompt.alias("in_prompt"), "chosen", "rejected")))
    rows = both.groupBy("pair_id", F.floor(F.col("turn") / block).cast("long").alias("block")).agg(turns.alias("turns"))

    def part(name: str, in_prompt: bool) -> Column:
        own = F.filter("turns", lambda x: (x["in_prompt"] if in_prompt else ~x["in_prompt"]) & x[name].isNotNull())
        return F.transform(own, lambda x: F.struct(x[name]["role"].alias("role"), _rendered(x[name]).alias("rendered")))

    parts = {"prompt": part("chosen", True), "chosen": part("chosen", False), "rejected": part("rejected", False)}
    rows = rows.select("pair_id", "block", *(v.alias(k) for k, v in parts.items()))
    text = lambda k: F.array_join(F.transform(k, lambda x: x["rendered"]), "").alias(k)
    return rows.select(
        "pair_id", "block", *(text(k) for k in parts),
        *(_trained(F.col(k)).alias(f"{k}_spans") for k in ("chosen", "rejected")),
        *(F.size(k).cast("long").alias(f"{k}_turns") for k in parts),
    )


def paired(conversations: DataFrame, pairs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``formatted`` for pairs (pair_id, chosen_id, rejected_id) of conversations (conv_id, turn, role, text)."""
    side = lambda name: F.struct(F.lit(name).alias("side"), F.col(f"{name}_id").alias("conv_id"))
    sides = pairs.select("pair_id", F.explode(F.array(side("chosen"), side("rejected"))).alias("s")).select("pair_id", "s.*")
    return formatted(sides.join(conversations.select("conv_id", "turn", "role", "text"), "conv_id"), block)


def op10(conversations: DataFrame) -> DataFrame:
    """Each conversation, up to its last assistant turn, is chosen over the same one with that turn broken off half-way.

    Conversations without an assistant turn make no pair. Of different rows for a last turn the first by role decides.
    """
    rows = conversations.where("conv_id is not null and turn is not null")
    one = F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    rows = rows.groupBy(F.col("conv_id").alias("pair_id"), "turn").agg(one.alias("said")).select("pair_id", "turn", "said.*")
    last = rows.where("role = 'assistant'").groupBy("pair_id").agg(F.max("turn").alias("last"))
    rows = rows.join(last, "pair_id").where("turn <= last")
    half = F.substr("text", F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    broken = F.when(F.col("turn") == F.col("last"), half).otherwise(F.col("text"))
    side = lambda name, text: F.struct(F.lit(name).alias("side"), text.alias("text"))
    sides = F.explode(F.array(side("chosen", F.col("text")), side("rejected", broken))).alias("s")
    return formatted(rows.select("pair_id", "turn", "role", sides).select("pair_id", "turn", "role", "s.*"))


OP10_SQL = rf"""
WITH turns AS (
  SELECT conv_id AS pair_id, turn, min({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}) AS said
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn),
ends AS (SELECT pair_id, max(turn) AS last FROM turns WHERE said.role = 'assistant' GROUP BY pair_id),
both_ AS (
  SELECT pair_id, turn, last, said.role AS role, said.text AS chosen,
         CASE WHEN turn = last THEN left(said.text, length(said.text) // 2) ELSE said.text END AS rejected
  FROM turns JOIN ends USING (pair_id) WHERE turn <= last),
shown AS (
  SELECT pair_id, floor(turn / {BLOCK}.0)::BIGINT AS block, turn, role,
         min(CASE WHEN chosen <> rejected THEN turn END) OVER (PARTITION BY pair_id) AS split,
         '<|' || role || '|>' || chr(10) || replace(chosen, '<|', '< |') || '<|end|>' || chr(10) AS c,
         '<|' || role || '|>' || chr(10) || replace(rejected, '<|', '< |') || '<|end|>' || chr(10) AS r
  FROM both_),
placed AS (
  SELECT *, split IS NULL OR turn < split AS in_prompt,
         coalesce(sum(length(c)) OVER w, 0) AS c_at, coalesce(sum(length(r)) OVER w, 0) AS r_at
  FROM shown
  WINDOW w AS (PARTITION BY pair_id, block, split IS NULL OR turn < split ORDER BY turn
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT pair_id, block,
       coalesce(string_agg(c, '' ORDER BY turn) FILTER (in_prompt), '') AS prompt,
       coalesce(string_agg(c, '' ORDER BY turn) FILTER (NOT in_prompt), '') AS chosen,
       coalesce(string_agg(r, '' ORDER BY turn) FILTER (NOT in_prompt), '') AS rejected,
       coalesce(string_agg((c_at + length(role) + 5)::BIGINT || ':' || (c_at + length(c) - 1)::BIGINT, ',' ORDER BY turn)
                FILTER (NOT in_prompt AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg((r_at + length(role) + 5)::BIGINT || ':' || (r_at + length(r) - 1)::BIGINT, ',' ORDER BY turn)
                FILTER (NOT in_prompt AND role = 'assistant'), '') AS rejected_spans,
       count(*) FILTER (in_prompt) AS prompt_turns,
       count(*) FILTER (NOT in_prompt) AS chosen_turns,
       count(*) FILTER (NOT in_prompt) AS rejected_turns
FROM placed GROUP BY pair_id, block
"""
