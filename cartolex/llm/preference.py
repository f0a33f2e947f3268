"""Preference formatting of conversations; DataFrame operations only.

A pair's chosen and rejected conversations share a longest prefix of turns. It is rendered once, as
the prompt; what follows on either side is a completion, with the spans of its assistant turns as
the mask of what is trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartolex.llm.scratch import cut

#: A rendered turn: opening with the role, the text, closing (a fixed format).
OPEN, ROLE_END, CLOSE = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"
#: About so many conversations of one first turn are paired in one task.
DEAL = 128


def assemble(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, turns)``: each conversation's (role, text) in the order of turn, role and text.

    Rows with a null conversation id belong to none and are left out. A null role is ``unknown``, a
    null text empty, and a null turn number comes first. One conversation is one row.
    """
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["role"], t["text"])).alias("turns"))


def pair_up(convs: DataFrame, deal: int = DEAL) -> DataFrame:
    """``(chosen_id, rejected_id)``: conversations of one first turn in pairs, the smaller id chosen.

    The pairing is defined by the table: n conversations with one first turn are dealt to ceil(n / ``deal``) hands by a hash of their
    id, so a hand's number depends on n; in each hand neighbours by id
    make a pair; those left over, at most one a hand, are paired with each other. At most one of each first turn stays
    alone, with a null rejected_id.
    """
    key = F.md5(F.concat_ws("\x1f", F.col("turns")[0]["role"], F.col("turns")[0]["text"]).cast("binary"))
    keyed = cut(convs.select("conv_id", key.alias("key")), "first_turns")
    sizes = cut(keyed.groupBy("key").agg(F.count("*").alias("n")), "first_turn_sizes")
    salt = F.conv(F.substring(F.md5(F.col("conv_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % F.ceil(F.col("n") / deal)

    def neighbours(rows: DataFrame, *by: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy("conv_id")
        numbered = rows.withColumn("k", F.row_number().over(w)).withColumn("next", F.lead("conv_id").over(w))
        return numbered.where("k % 2 = 1").select("key", F.col("conv_id").alias("chosen_id"), F.col("next").alias("rejected_id"))

    dealt = keyed.join(sizes, "key").withColumn("salt", salt)
    first = cut(neighbours(dealt, "key", "salt"), "dealt_pairs")
    rest = neighbours(first.where("rejected_id is null").select("key", F.col("chosen_id").alias("conv_id")), "key")
    return first.where("rejected_id is not null").union(rest).drop("key")


def rendered(turns: Column) -> Column:
    """The text of a list of turns."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(ROLE_END), t["text"], F.lit(CLOSE))), "")


def mask(turns: Column) -> Column:
    """The spans [start, end) of :func:`rendered` that are trained on: assistant texts with their closing."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(t["role"]) + len(OPEN + ROLE_END)
        end = begin + F.length(t["text"]) + len(CLOSE)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == TRAINED, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading turns two conversations share."""
    n = F.least(F.size(a), F.size(b))
    same = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.coalesce(F.get(a, i - 1).eqNullSafe(F.get(b, i - 1)), F.lit(False)))
    breaks = F.array_position(same, F.lit(False)).cast("int")
    return F.when(n == 0, 0).when(breaks == 0, n).otherwise(breaks - 1)


def format_pairs(pairs: DataFrame, convs: DataFrame) -> DataFrame:
    """``pairs`` (chosen_id, rejected_id) as (chosen_id, rejected_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask).

    A pair without a rejected conversation has all but the last turn of the chosen one as its prompt,
    and null rejected columns. A side that ends with the prompt has an empty completion.
    Pairs whose chosen conversation is not in ``convs`` are left out.
    """
    left = pairs.join(convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c")), "chosen_id")
    both = left.join(convs.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r")), "rejected_id", "left")
    n = F.when(F.col("r").isNull(), F.size("c") - 1).otherwise(common_prefix(F.col("c"), F.col("r")))
    cut_at = both.withColumn("n", n)
    tail = lambda x: F.slice(F.col(x), F.col("n") + 1, F.greatest(F.size(x) - F.col("n"), F.lit(0)))
    split = cut_at.select("chosen_id", "rejected_id", F.col("n").cast("int").alias("n_prompt_turns"), F.slice("c", F.lit(1), F.col("n")).alias("p"), tail("c").alias("ct"), F.when(F.col("r").isNotNull(), tail("r")).alias("rt"))
    return split.select("chosen_id", "rejected_id", "n_prompt_turns", rendered(F.col("p")).alias("prompt"), rendered(F.col("ct")).alias("chosen"), rendered(F.col("rt")).alias("rejected"), mask(F.col("ct")).alias("chosen_mask"), mask(F.col("rt")).alias("rejected_mask"))


def preferences(turns: DataFrame, **columns: str) -> DataFrame:
    """Conversations of equal first turns, paired and formatted; see :func:`assemble`, :func:`pair_up` and :func:`format_pairs`."""
    convs = cut(assemble(turns, **columns), "conversations")
    return format_pairs(cut(pair_up(convs), "pairs"), convs)
