"""Chat formatting by multi-party perspective rotation (DataFrame functions only).

For every participant of a conversation the whole dialogue is rendered with
that speaker as the assistant and all others as named users; ``system`` turns
stay system messages and are nobody's perspective.  The mask lists the
character spans a model is to be trained on: the participant's own words and
the closing mark of their turns.

A conversation of any length is rendered in chunks of ``chunk_turns`` turns (the
last one may be shorter), so that no task ever gathers a whole conversation:
turns are range-partitioned by (conversation, turn), and a turn's number in its
conversation is its number inside the partition plus the turns that earlier
partitions hold of the conversation, so the chunks do not depend on the number
of partitions.  Prefix sums of the rendered lengths of chunks give each chunk
its place in the rendered dialogue.  Concatenating a perspective's chunks gives
the dialogue; mask spans count from its beginning.

Marks are escaped, so that no text can forge a turn: where a text holds ``<``,
any number of backslashes and ``|``, one more backslash stands before the ``|``
(taking one away again restores the text).  In names, any character other than
letters, digits, ``_``, ``.`` and ``-`` becomes ``%`` and its UTF-8 bytes in hex, so that
different speakers keep different names.

Defined results: a null conversation id is one conversation; null roles speak
as ``unknown``; null and empty texts render as empty turns; turns of equal
number are ordered by role and text, repeated rows are each rendered; null
turns come first; a conversation of system turns only has no perspective; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from eventide.llm.components import written

SYSTEM, UNKNOWN = "system", "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
CHUNK_TURNS = 64


def _tag(name):
    """A speaker's name as it may stand in a header; different names stay different."""
    coded = F.transform(F.split(name, ""), lambda c: F.when(
        c.rlike(r"[^\p{L}\p{N}_.-]"), F.concat(F.lit("%"), F.hex(F.encode(c, "UTF-8")))).otherwise(c))
    return F.array_join(coded, "")


def escaped(text):
    """A text that holds no mark; ``restored`` undoes it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def restored(text):
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def rotate(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """(conv_id, participant, chunk, start_char, n_turns, text, mask) of every perspective.

    ``mask`` is an array of (from, to) character spans of the rendered dialogue, end exclusive.
    """
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "role", "text"]
    said = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(UNKNOWN)).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text"))
    # written once: numbering and chunk totals must come from one partitioning
    ranged = written(spark, said.repartitionByRange(n, *order, F.rand(5)).withColumn("part", F.spark_partition_id()), "chat")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("conv_id", "part").agg(F.count("*").alias("turns"))      # one row per conversation and partition
               .select("conv_id", "part", F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("before")))
    inside = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order)) - 1
    numbered = (ranged.withColumn("inside", inside).alias("r")
                .join(offsets.alias("o"), F.expr("r.part = o.part and r.conv_id <=> o.conv_id"))
                .select("r.conv_id", "role", "text", (F.col("before") + F.col("inside")).alias("nth"))
                .withColumn("chunk", F.expr(f"nth div {int(chunk_turns)}")))
    speakers = (said.filter(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("participant")).distinct())
    own = F.col("role") == F.col("participant")
    head = (F.when(own, F.lit("assistant")).when(F.col("role") == SYSTEM, F.lit(SYSTEM))
            .otherwise(F.concat(F.lit("user name="), _tag(F.col("role")))))
    before = F.concat(F.lit(OPEN), head, F.lit("\n"))
    shown = (numbered.alias("t").join(speakers.alias("s"), F.expr("t.conv_id <=> s.conv_id"))
             .select("t.conv_id", "participant", "chunk", "nth", own.alias("own"), before.alias("head"),
                     F.concat("text", F.lit(CLOSE)).alias("body")))
    chunk = (shown.groupBy("conv_id", "participant", "chunk")       # at most chunk_turns turns each
             .agg(F.sort_array(F.collect_list(F.struct("nth", "own", "head", "body"))).alias("turns")))
    step = F.struct(F.lit(0).alias("at"), F.expr("array()").cast("array<struct<from:int,to:int>>").alias("mask"))

    def add(a, t):
        start = a["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        span = F.array(F.struct(start.alias("from"), (end - 1).alias("to")))       # up to the closing mark's end
        return F.struct(end.alias("at"), F.when(t["own"], F.concat(a["mask"], span)).otherwise(a["mask"]).alias("mask"))

    drawn = chunk.select(
        "conv_id", "participant", "chunk", F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"])), "").alias("text"),
        F.aggregate("turns", step, add)["mask"].alias("spans"))
    drawn = written(spark, drawn.withColumn("size", F.length("text").cast("long")), "chat")
    place = Window.partitionBy("conv_id", "participant").orderBy("chunk")      # one small row per chunk
    sizes = drawn.select("conv_id", "participant", "chunk",
                         (F.sum("size").over(place.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("start_char"))
    same = "d.conv_id <=> p.conv_id and d.participant = p.participant and d.chunk = p.chunk"
    return drawn.alias("d").join(sizes.alias("p"), F.expr(same)).select(
        "d.conv_id", "d.participant", "d.chunk", "start_char", "n_turns", "text",
        F.transform("spans", lambda s: F.struct((s["from"] + F.col("start_char")).alias("from"),
                                                (s["to"] + F.col("start_char")).alias("to"))).alias("mask"))
