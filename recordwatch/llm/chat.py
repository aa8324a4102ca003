"""Chat formatting by perspective rotation: each participant of a dialogue once as the assistant.

For every participant the whole dialogue is rendered with that speaker as assistant and the others as named users; a
mask of the same length tells the characters to learn from: what the assistant says, and the mark that ends it.

A dialogue of any length is rendered in segments of up to ``segment`` consecutive turn numbers, each with the offset at
which it begins in the whole; joined in order they are the rendering. So no task holds more than a segment, and the
offsets are running sums over the few numbers that describe segments.

Edge cases: a null text is empty and a null role is the speaker "unknown"; a null turn comes after all others, in a
segment of its own; turns with the same number follow by role, then text; a turn that is repeated exactly counts once;
a null conversation is a conversation like any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.llm.common import text_or_empty

SEGMENT = 64
START, END = "<|im_start|>", "<|im_end|>"


def turns(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``conv_id, segment, turn, speaker, text``: each different turn once."""
    number = F.col("turn").cast("long")
    return conversations.select(
        "conv_id", F.coalesce(F.floor(number / segment), F.lit((1 << 62))).cast("long").alias("segment"), number.alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"), text_or_empty().alias("text"),
    ).distinct()


def _head(me: Column, speaker: Column) -> Column:
    return F.when(me, F.lit(f"{START}assistant\n")).otherwise(F.concat(F.lit(f"{START}user name="), speaker, F.lit("\n")))


def rotate(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``conv_id, perspective, segment, start, n_turns, rendered, mask``.

    ``start`` is where the segment begins in the rendering of the whole dialogue, ``mask`` a text of 0 and 1 for each
    character. Each segment is gathered once and rendered for each participant.
    """
    every = turns(conversations, segment)
    speakers = every.select(F.col("conv_id").alias("__conv"), F.col("speaker").alias("perspective")).distinct()
    first = F.coalesce("turn", F.lit((1 << 63) - 1))
    gathered = every.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct(first.alias("turn"), "speaker", "text"))).alias("said"))
    each = gathered.join(speakers, gathered.conv_id.eqNullSafe(speakers["__conv"])).drop("__conv")

    def shown(t: Column) -> Column:
        return F.concat(_head(t["speaker"] == F.col("perspective"), t["speaker"]), t["text"], F.lit(f"{END}\n"))

    def masked(t: Column) -> Column:
        me = t["speaker"] == F.col("perspective")
        learnt = F.char_length(t["text"]) + len(END)
        return F.concat(F.repeat(F.lit("0"), F.char_length(_head(me, t["speaker"]))), F.when(me, F.repeat(F.lit("1"), learnt)).otherwise(F.repeat(F.lit("0"), learnt)), F.lit("0"))

    out = each.select(
        "conv_id", "perspective", "segment", F.size("said").cast("long").alias("n_turns"),
        F.array_join(F.transform("said", shown), "").alias("rendered"), F.array_join(F.transform("said", masked), "").alias("mask"),
    )
    before = Window.partitionBy("conv_id", "perspective").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = out.select("conv_id", "perspective", "segment", F.char_length("rendered").cast("long").alias("size"))
    starts = sizes.select(
        F.col("conv_id").alias("__conv"), F.col("perspective").alias("__perspective"), F.col("segment").alias("__segment"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
    )
    same = out.conv_id.eqNullSafe(starts["__conv"]) & (out.perspective == starts["__perspective"]) & (out.segment == starts["__segment"])
    return out.join(starts, same).select("conv_id", "perspective", "segment", "start", "n_turns", "rendered", "mask")


def rotate_digests(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The rendering and its mask as digests, with the number of characters to learn from."""
    return rotate(conversations, segment).select(
        "conv_id", "perspective", "segment", "start", "n_turns", F.char_length("rendered").cast("long").alias("n_chars"),
        (F.char_length("mask") - F.char_length(F.replace("mask", F.lit("1"), F.lit("")))).cast("long").alias("n_learnt"),
        F.sha2("rendered", 256).alias("rendered_sha256"), F.sha2("mask", 256).alias("mask_sha256"),
    )
