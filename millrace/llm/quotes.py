"""Quotation linking: reply-ordered conversations without quotes.

Each message is parsed into its own text and its quoted passages by nested level (the
number of leading ``>``). Passages, their paragraphs and lines are normalised and hashed,
so a re-wrapped paragraph is still known, and meet the hashed lines, paragraphs and texts of the messages that first said them. A message replies to
the earlier message of its conversation that most of its level-1 quotes come from;
deeper levels show the ancestors and are linked likewise. Messages that reply to one
another form a thread, found by pointer jumping, and a conversation is ordered by
threads, each by its turns, so every reply stands after what it replies to.

Nothing is gathered per conversation: originals are one row per hash (combined before
the shuffle), quotes meet them in a join, and positions come from counts over blocks of
turns, so one conversation may hold a third of all messages.

Defined cases: a null text counts as empty; a message without a linked quote starts its
own thread; rows with a null conversation form one conversation; a null turn comes first
and is never linked; repeated rows each keep a place, in the order of role and text; an
empty table gives an empty result; only the four columns are read, others may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import numbered
from millrace.session import materialize

#: Turns of a conversation that are sorted together.
SPAN = 128


def parse(text: str | None) -> tuple[str, list[tuple[int, list[str]]]]:
    """Own text, and the quoted passages as (level, lines without marks), in order.

    A line's level is the number of ``>`` it starts with, blanks between them allowed. A
    line that ends in a colon right before a quote introduces it and is left out.
    """
    own, passages, last = [], [], 0
    for line in (text or "").split("\n"):
        rest, level = line.lstrip(" \t"), 0
        while rest.startswith(">"):
            level, rest = level + 1, rest[1:].lstrip(" \t")
        if not level:
            own.append(line)
        else:
            if level != last:
                passages.append((level, []))
            if level > last:
                # What introduces a deeper quote, such as "A wrote:", belongs to nobody's words.
                said = own if last == 0 else passages[-2][1]
                while said and not said[-1].strip():
                    said.pop()
                if said and said[-1].rstrip().endswith(":"):
                    said.pop()
            passages[-1][1].append(rest)
        last = level
    return "\n".join(own).strip("\n"), [(n, lines) for n, lines in passages if any(map(str.strip, lines))]


def normalised(line: str) -> str:
    return " ".join(line.casefold().split())


def hashes(lines: list[str]) -> set[int]:
    """Signed 64-bit hashes of the normalised lines, paragraphs (runs of lines between blank ones) and whole passage."""
    from itertools import groupby

    from xxhash import xxh64_intdigest

    paragraphs = [" ".join(own) for filled, own in groupby(lines, lambda line: bool(line.strip())) if filled]
    said = {n for part in (*lines, *paragraphs, " ".join(lines)) if (n := normalised(part))}
    return {h - (1 << 64) if (h := xxh64_intdigest(s.encode("utf-8", "surrogatepass"))) >> 63 else h for s in said}


def _parsed():
    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64())]))
        for batch in batches:
            own, said, quoted, count = [], [], [], []
            for text in batch.column(batch.schema.get_field_index("_text")).to_pylist():
                rest, passages = parse(text)
                own.append(rest)
                said.append(sorted(hashes(rest.split("\n"))))
                quoted.append([{"level": a, "hash": h} for a, h in sorted({(lv, h) for lv, ls in passages for h in hashes(ls)})])
                count.append(len(passages))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(own, pa.string()), pa.array(said, pa.list_(pa.int64())), pa.array(quoted, kind),
                 pa.array(count, "i4")], names=[*batch.schema.names[:-1], "own", "said", "quoted", "n_quotes"])

    return run


def _links(messages: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``level``, ``target``: the earlier message that most quotes of that level come from."""
    known = messages.filter(F.col("turn").isNotNull())
    first = known.select("conv", "turn", F.explode("said").alias("hash")).groupBy("conv", "hash").agg(F.min("turn").alias("target"))
    quotes = known.select("conv", "turn", F.explode("quoted").alias("q")).select(
        F.col("conv").alias("c"), "turn", F.col("q.level").alias("level"), F.col("q.hash").alias("h")).distinct()
    found = quotes.join(first, F.col("c").eqNullSafe(F.col("conv")) & (F.col("h") == F.col("hash")))
    found = found.filter("target < turn").groupBy("conv", "turn", "level", "target").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", F.col("target"))).alias("best")
    return found.groupBy("conv", "turn", "level").agg(best).select("conv", "turn", "level", F.col("best.target").alias("target"))


def _threads(replies: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``thread``: the turn at the end of the chain of replies, by pointer jumping."""
    now = materialize(replies.select("conv", "turn", F.col("target").alias("thread")), "threads")
    while now.limit(1).count():
        up = now.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("thread").alias("above"))
        jumped = now.join(up, F.col("conv").eqNullSafe(F.col("c")) & (F.col("thread") == F.col("t")), "left")
        now = materialize(jumped.select("conv", "turn", F.coalesce("above", "thread").alias("thread"), F.col("above").isNotNull().alias("moved")), "threads")
        if not now.filter("moved").limit(1).count():
            break
        now = now.drop("moved")
    return now.select("conv", "turn", "thread")


def link_quotes(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every message with its own text, what it replies to, its thread and its place in the conversation."""
    narrow = df.select(
        df[conversation].alias("conv"), df[turn].cast("long").alias("turn"), df[role].cast("string").alias("role"),
        df[text].cast("string").alias("_text"))
    kind = narrow.schema["conv"].dataType.simpleString()
    messages = materialize(narrow.mapInArrow(
        _parsed(), f"conv {kind}, turn long, role string, own string, said array<bigint>, "
        "quoted array<struct<level:int,hash:bigint>>, n_quotes int"), "messages")
    links = materialize(_links(messages), "links")
    replies = links.filter("level = 1")
    per_message = links.groupBy("conv", "turn").agg(
        F.max(F.when(F.col("level") == 1, F.col("target"))).alias("_reply"), F.count("*").alias("_linked"))
    named = per_message.join(_threads(replies).withColumnsRenamed({"conv": "_c", "turn": "_t", "thread": "_thread"}),
                             F.col("conv").eqNullSafe(F.col("_c")) & (F.col("turn") == F.col("_t")), "left")
    named = named.select(F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), "_reply", "_linked", "_thread")
    placed = messages.join(named, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("turn") == F.col("_turn")), "left").select(
        "conv", "turn", "role", "own", "n_quotes", F.coalesce("_linked", F.lit(0)).cast("int").alias("n_levels_linked"),
        F.col("_reply").alias("reply_to"), F.coalesce("_thread", "turn").alias("thread"))
    placed = materialize(placed.withColumns({
        "_span": F.floor(F.col("turn") / SPAN), "_block": F.floor(F.col("thread") / SPAN)}), "placed")

    # Where a thread starts: all rows of earlier blocks of threads, then of earlier threads in its block.
    sizes = placed.groupBy("conv", "_block", "thread").agg(F.count("*").alias("n"))
    earlier = lambda *by: Window.partitionBy("conv", *by).rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.groupBy("conv", "_block").agg(F.sum("n").alias("n")).select(
        F.col("conv").alias("_c"), F.col("_block").alias("_b"),
        F.coalesce(F.sum("n").over(earlier().orderBy("_block")), F.lit(0)).alias("_before"))
    starts = sizes.withColumn("_in", F.coalesce(F.sum("n").over(earlier("_block").orderBy("thread")), F.lit(0))).join(
        blocks, F.col("conv").eqNullSafe(F.col("_c")) & F.col("_block").eqNullSafe(F.col("_b"))).select(
        F.col("conv").alias("_conv"), F.col("thread").alias("_thread"), (F.col("_before") + F.col("_in")).alias("_start"))
    order = [F.col("turn"), F.col("role"), F.xxhash64("own")]
    inside = numbered(placed, ["conv", "thread"], "_span", order, "_place")
    return inside.join(
        starts, F.col("conv").eqNullSafe(F.col("_conv")) & F.col("thread").eqNullSafe(F.col("_thread"))).select(
        F.col("conv").alias("conv_id"), "turn", "role", (F.col("_start") + F.col("_place")).alias("position"),
        "reply_to", "thread", "n_quotes", "n_levels_linked", F.col("own").alias("text"))


def query(spark, conversations: DataFrame) -> DataFrame:
    """Every message of every conversation in reply order, without the quotes in it."""
    return link_quotes(conversations)
