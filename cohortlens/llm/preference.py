"""Preference formatting of chosen and rejected conversations, in DataFrame
functions only.

The turns that both conversations begin with, role and text alike, are rendered
once as the prompt; what follows in each is its completion.  A completion is
rendered turn by turn with its loss spans: character ranges [start, end) of the
assistant's texts, the only part that is trained on.  Turns after the common
prefix are compared at the same position, so a prefix ends at the first turn
that differs or is missing on one side.

Defined cases: a null role counts as ``user`` and a null text as empty; turns
with a null number come first, and turns that share a number are ordered by
role and text, so a repeated row is a repeated turn; rows with a null
conversation are left out, as they belong to none.  A pair without
a rejected conversation keeps its chosen one with an empty prompt and a null
rejected completion; a pair of equal conversations has two empty completions.
Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: How a turn is rendered: opening with the role, text, closing (fixed values).
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def conversations(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turns): the turns of each conversation in order."""
    own = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias(conv),
        F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("one"))
    return own.groupBy(conv).agg(F.array_sort(F.collect_list("one")).alias("turns"))


def neighbour_pairs(convs: DataFrame, conv: str = "conv_id", block: int = 64) -> DataFrame:
    """(pair_id, chosen, rejected): within every block of ``block`` ids, the
    conversations in order of their first turn, then id, two by two, so that
    those with the same opening are paired; the last of an odd number has no
    rejected one.  A block bounds the group, however many share an opening."""
    one = F.struct(F.col("turns")[0]["role"].alias("role"), F.col("turns")[0]["text"].alias("text"), F.col(conv).alias("id"))
    groups = (convs.groupBy(F.floor(F.col(conv) / block).alias("block"))
              .agg(F.array_sort(F.collect_list(one))["id"].alias("ids")))
    pair = F.transform(F.sequence(F.lit(0), F.floor((F.size("ids") - 1) / 2).cast("int")),
                       lambda i: F.struct(F.get("ids", i * 2).alias("chosen"), F.get("ids", i * 2 + 1).alias("rejected")))
    return groups.select(F.explode(pair).alias("p")).select(
        F.col("p.chosen").alias("pair_id"), F.col("p.chosen").alias("chosen"), F.col("p.rejected").alias("rejected"))


def _prefix_hashes(turns: Column) -> Column:
    """Hash of the first 1, 2, ... turns, without the whole conversation (unless
    it has one turn)."""
    chain = F.aggregate(turns, F.array(F.lit(0).cast("long")), lambda acc, one: F.concat(
        acc, F.array(F.xxhash64(F.element_at(acc, -1), one["role"], one["text"]))))
    return F.slice(chain, F.lit(2), F.greatest(F.size(turns) - 1, F.lit(1)))


def opening_pairs(convs: DataFrame, conv: str = "conv_id", bits: int = 6) -> DataFrame:
    """(pair_id, chosen, rejected) over the whole table: conversations that
    share their first turns are paired wherever their ids lie, those that share
    most turns first; only what is left goes to ``neighbour_pairs``.

    Only the lengths at which shared prefixes part are looked at.  Within a
    prefix, ids are paired in blocks of ``2 ** bits``, and the odd one of each
    goes up to a block of as many blocks, so a hot prefix is never one group."""
    free = stored(convs.select(F.col(conv).alias("id"), _prefix_hashes(F.col("turns")).alias("h")))
    each = free.select(F.posexplode("h").alias("at", "own"), "h").withColumn("next", F.get("h", F.col("at") + 1))
    shared = each.groupBy("at", "own").agg(F.count("*").alias("n"), F.count("next").alias("longer"), F.min("next").alias("low"),
                                           F.max("next").alias("high"))
    parting = shared.where((F.col("n") > 1) & ((F.col("longer") < F.col("n")) | (F.col("low") < F.col("high"))))
    lengths = sorted((r["at"] for r in parting.select("at").distinct().collect()), reverse=True)
    if not lengths:
        return neighbour_pairs(convs, conv)
    low, high = free.agg(F.min("id"), F.max("id")).first()
    shifts = range(bits, max(abs(low), abs(high)).bit_length(), bits)
    blocks = [F.shiftright("id", k) for k in shifts] + [F.lit(0).cast("long")]
    found = None
    for at in lengths:
        rest, own = free.where(F.size("h") <= at), free.where(F.size("h") > at)
        for block in blocks:
            groups = stored(own.groupBy(F.get("h", F.lit(at)).alias("own"), block.alias("block"))
                            .agg(F.array_sort(F.collect_list(F.struct("id", "h"))).alias("all")))
            pair = F.transform(F.sequence(F.lit(1), F.floor(F.size("all") / 2).cast("int")), lambda i: F.struct(
                F.get("all", i * 2 - 2)["id"].alias("chosen"), F.get("all", i * 2 - 1)["id"].alias("rejected")))
            pairs = groups.where(F.size("all") > 1).select(F.explode(pair).alias("p")).select(
                F.col("p.chosen").alias("pair_id"), F.col("p.chosen").alias("chosen"), F.col("p.rejected").alias("rejected"))
            found = pairs if found is None else found.unionByName(pairs)
            own = groups.where(F.size("all") % 2 == 1).select(F.explode(F.slice("all", -1, 1)).alias("x")).select("x.id", "x.h")
        free = stored(rest.unionByName(own))
    left = convs.join(free.select(F.col("id").alias(conv)), conv, "left_semi")
    return found.unionByName(neighbour_pairs(left, conv))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns with equal role and text."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    at = F.array_position(same, F.lit(False))
    return F.when(at > 0, at - 1).otherwise(F.size(same)).cast("int")


def _rendered(one: Column) -> Column:
    return F.concat(F.lit(OPEN), one["role"], F.lit(MIDDLE), one["text"], F.lit(CLOSE))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def loss_spans(turns: Column) -> Column:
    """[start, end) of each trained text in ``render(turns)``, in characters."""
    state = "struct<at:int, spans:array<struct<start:int,end:int>>>"
    start = F.from_json(F.lit('{"at":0,"spans":[]}'), state)

    def step(acc: Column, one: Column) -> Column:
        head = acc["at"] + F.length(F.concat(F.lit(OPEN), one["role"], F.lit(MIDDLE)))
        tail = head + F.length(one["text"])
        span = F.struct(head.cast("int").alias("start"), tail.cast("int").alias("end"))
        return F.struct((tail + len(CLOSE)).cast("int").alias("at"),
                        F.when(one["role"] == TRAINED, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def preferences(turns: DataFrame, pairs: DataFrame, conv: str = "conv_id", convs: DataFrame | None = None) -> DataFrame:
    """One row a pair: pair_id, chosen_id, rejected_id, n_prompt_turns, prompt,
    chosen, chosen_spans, rejected, rejected_spans."""
    convs = conversations(turns, conv) if convs is None else convs
    left = convs.select(F.col(conv).alias("chosen"), F.col("turns").alias("good"))
    right = convs.select(F.col(conv).alias("rejected"), F.col("turns").alias("bad"))
    both = pairs.select("pair_id", "chosen", "rejected").join(left, "chosen").join(right, "rejected", "left")
    n = F.when(F.col("bad").isNull(), F.lit(0)).otherwise(common_turns(F.col("good"), F.col("bad")))
    both = both.withColumn("n", n)
    rest = {c: F.slice(F.col(c), F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0))) for c in ("good", "bad")}
    return both.select(
        "pair_id", F.col("chosen").alias("chosen_id"), F.col("rejected").alias("rejected_id"), F.col("n").alias("n_prompt_turns"),
        render(F.slice("good", F.lit(1), F.col("n"))).alias("prompt"),
        render(rest["good"]).alias("chosen"), loss_spans(rest["good"]).alias("chosen_spans"),
        render(rest["bad"]).alias("rejected"), loss_spans(rest["bad"]).alias("rejected_spans"))
