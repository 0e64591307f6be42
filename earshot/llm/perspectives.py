"""Dialogues rendered once per participant, in DataFrame functions only.

In the perspective of a speaker, the speaker's turns are the assistant's and all others
are turns of named users; the mask covers what the assistant says and the mark that ends
it, which is what a model is trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import at_most, prefix_sums
from earshot.sources import storage

# Of the rendered form. A user's name stands between USER and the end of HEAD.
ASSISTANT, USER, HEAD, END = "<|assistant", "<|user ", "|>\n", "<|end|>\n"
# What a text or name may not contain stands in a form of its own.
MARK, SPELLED = "<|", "< |"
NOBODY = "unnamed"
# Characters after which a dialogue goes on in another row.
CHUNK = 100_000


def _spelled(column: Column) -> Column:
    return F.replace(column, F.lit(MARK), F.lit(SPELLED))


def named(turns: DataFrame) -> DataFrame:
    """``conv`` (a struct of ``conv_id``, never null), ``turn``, ``name``, ``text``, as they are rendered."""
    return turns.select(
        F.struct(F.col("conv_id").alias("conv_id")).alias("conv"),
        F.col("turn").alias("turn"),
        _spelled(F.coalesce(F.col("role"), F.lit(NOBODY))).alias("name"),
        _spelled(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
    )


def _head(name: Column, perspective: Column) -> Column:
    return F.when(name == perspective, F.lit(ASSISTANT + HEAD)).otherwise(F.concat(F.lit(USER), name, F.lit(HEAD)))


def ordered(rows: DataFrame) -> DataFrame:
    """``conv``, ``at`` (place in the order of all turns), ``name``, ``text`` of rows as :func:`named` gives them.

    Turns are ordered by their number (null first), then speaker, text and place in the input; ranges
    of that order are sorted apart, so one dialogue or one turn may fill many tasks.
    """
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    order = ["conv", "turn", "name", "text", "_tie"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The ids follow the order and have to be written down before anything is computed from them.
    return storage.written(
        dealt.select("conv", F.monotonically_increasing_id().alias("at"), "name", "text"), "turns"
    )


def segments(turns: DataFrame) -> DataFrame:
    """One row per turn and participant: ``conv``, ``perspective``, ``at``, ``name``, ``own``, ``segment``,
    ``start``, ``mask_start``, ``mask_end`` (characters from the beginning of the rendered dialogue).

    ``turns`` as :func:`ordered` gives them. Lengths alone are added up, in runs, so that no task
    needs a whole dialogue; the texts join them at the end.
    """
    speakers = at_most(storage.written(turns.select("conv", F.col("name").alias("perspective")).distinct(), "speakers"))
    sizes = turns.select("conv", "at", "name", F.char_length("text").alias("_chars"))
    head = _head(F.col("name"), F.col("perspective"))
    seen = sizes.join(speakers, "conv").withColumn("_head", F.char_length(head))
    seen = seen.withColumn("_length", (F.col("_head") + F.col("_chars") + len(END)).cast("long"))
    placed = prefix_sums(seen, ["conv", "perspective"], "at", "_length", "start").drop("conv", "name")
    own = F.col("name") == F.col("perspective")
    return turns.join(placed, "at").select(
        "conv", "perspective", "at", "name", own.alias("own"),
        F.concat(head, "text", F.lit(END)).alias("segment"),
        "start",
        F.when(own, F.col("start") + F.col("_head")).alias("mask_start"),
        F.when(own, F.col("start") + F.col("_length")).alias("mask_end"),
    )


def _in_rows(rows: DataFrame, chunk: int) -> DataFrame:
    """Dialogues that may fill more than one row, in rows of ``chunk`` characters and what the last turn adds."""
    parts = segments(ordered(rows)).withColumn("chunk", F.floor(F.col("start") / chunk).cast("long"))
    told = F.struct("at", "segment", "start", "mask_start", "mask_end")
    rows = parts.groupBy("conv", "perspective", "chunk").agg(
        F.sort_array(F.collect_list(told)).alias("_told"), F.min("start").alias("start"), F.count("*").alias("n_turns")
    )
    masks = F.transform(
        F.filter("_told", lambda t: t["mask_start"].isNotNull()),
        lambda t: F.struct(
            (t["mask_start"] - F.col("start")).alias("start"), (t["mask_end"] - F.col("start")).alias("end")
        ),
    )
    return rows.select(
        F.col("conv.conv_id").alias("conv_id"), "perspective", "chunk", "start", "n_turns",
        F.array_join(F.transform("_told", lambda t: t["segment"]), "").alias("text"), masks.alias("masks"),
    )


_MASKS = "array<struct<start:bigint,end:bigint>>"


def _in_one_row(rows: DataFrame) -> DataFrame:
    """Dialogues that fit one row: their turns meet once, and every perspective is rendered from them there."""
    talks = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "name", "text"))).alias("_told"))
    speakers = F.array_distinct(F.transform("_told", lambda t: t["name"]))
    seen = talks.select("conv", "_told", F.explode(speakers).alias("perspective"))

    def head(t: Column) -> Column:
        return _head(t["name"], F.col("perspective"))

    def step(so_far: Column, t: Column) -> Column:
        begins = so_far["at"] + F.char_length(head(t))
        ends = begins + F.char_length(t["text"]) + len(END)
        mask = F.array(F.struct(begins.alias("start"), ends.alias("end")))
        own = F.when(t["name"] == F.col("perspective"), mask).otherwise(F.array().cast(_MASKS))
        return F.struct(ends.alias("at"), F.concat(so_far["masks"], own).alias("masks"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_MASKS).alias("masks"))
    none = F.lit(0).cast("long")
    return seen.select(
        F.col("conv.conv_id").alias("conv_id"), "perspective", none.alias("chunk"), none.alias("start"),
        F.size("_told").cast("long").alias("n_turns"),
        F.array_join(F.transform("_told", lambda t: F.concat(head(t), t["text"], F.lit(END))), "").alias("text"),
        F.aggregate("_told", start, step, lambda done: done["masks"]).alias("masks"),
    )


def render(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``conv_id``, ``perspective``, ``chunk`` (long), ``start`` (long), ``n_turns`` (long), ``text``, ``masks``.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``. A dialogue stands in as many
    rows as it has times ``chunk`` characters: turn after turn, each whole, goes to the row
    in which it begins. Joined in order they are the dialogue. ``masks`` lists the trained
    spans, as ``start`` (from 0) and ``end`` in characters of ``text``.

    Dialogues of at most ``chunk`` characters, however they are seen, are put together by
    one shuffle of their turns; the others, each of them longer than ``chunk``, by their lengths
    first. Runs jobs that size the dialogues.

    Nulls: a turn without a role is spoken by ``unnamed``, one without a text says nothing,
    turns without a dialogue form one of their own, turns without a number come first.
    Repeated rows are repeated turns. The marks of the form are respelled in texts and
    names. An empty table gives none.
    """
    rows = named(turns)
    most = F.greatest(F.lit(len(ASSISTANT)), F.char_length("name") + len(USER)) + F.char_length("text") + len(HEAD + END)
    sizes = rows.select("conv", most.cast("long").alias("_most")).groupBy("conv").agg(F.sum("_most").alias("_most"))
    long = storage.written(sizes.filter(F.col("_most") > chunk).select("conv"), "long-dialogues")
    if long.isEmpty():
        return _in_one_row(rows)
    long = at_most(long)
    short = _in_one_row(rows.join(long, "conv", "left_anti"))
    return short.unionByName(_in_rows(rows.join(long, "conv", "left_semi"), chunk))


def spans(masks: Column) -> Column:
    """Masks as text: ``start-end`` joined by commas."""
    return F.array_join(F.transform(masks, lambda m: F.concat_ws("-", m["start"], m["end"])), ",")
