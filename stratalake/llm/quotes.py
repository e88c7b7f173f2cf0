"""Chat formatting by quotation linking.

Lines that begin with ``>`` are quoted, each further ``>`` one level deeper. A run of
lines of one level is a passage. Passages, and their paragraphs and lines, are
normalised (white space to one space, lower case) and hashed; so are a message's own
text, its paragraphs and lines. Joined on conversation and hash, a passage leads to the
first earlier message that holds it. A message replies to the message that most of its
least deep linked quotes come from (by length, the later one on a tie), or else to the
message before it. A conversation is then put in reply order: each message is followed
by all that replies to it, in order of turn, and the quotes are left out.

A message that follows its parent continues that one's chain; each other reply heads a
chain of its own. In reply order a chain's messages stand together, then come the chains
that hang on it, the last parent's first. A walk around this tree enters and leaves each chain
once; every step of the walk knows the next one, and how many messages are left from a step on
is found by doubling: each round joins the steps with those they have reached. So a row has a
fixed width however deep a reply lies, the rounds grow with the logarithm of a conversation's
length, and no conversation is gathered in one task: numbers, neighbours and running sums are
taken per range of the sorted rows and carried over by a table of one row per range.

Defined results
* A null text is an empty message. A null conversation id is one conversation; null
  turns come first.
* Repeated rows (conversation, turn, role and text alike) are one message with
  ``copies``; messages of one turn are ordered by role and text hash.
* A quote that is found nowhere before it is left out of the text but links nothing.
* Of the input no other columns are read.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from stratalake.llm.common import Scratch, column

QUOTED = re.compile(r"^[ \t]{0,3}((?:>[ \t]?)+)(.*)$")
#: A line that introduces a quote, such as "On Monday, Ann wrote:".
INTRODUCES = re.compile(r"^\s*\S.*\bwrote:\s*$", re.I)
PARSED = "own string, units array<string>, quotes array<struct<level:int,text:string>>"


def normal(text: str) -> str:
    return " ".join(text.split()).lower()


def units(text: str) -> list[str]:
    """The text, its paragraphs and its lines, normalised, each once."""
    parts = [text, *re.split(r"\n\s*\n", text), *text.split("\n")]
    return list(dict.fromkeys(n for n in map(normal, parts) if n))


def parse(text: str | None) -> tuple[str, list[str], list[tuple[int, str]]]:
    """Own text, its units, and (level, unit) of each quoted passage."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    last = 0
    for line in (text or "").split("\n"):
        found = QUOTED.match(line)
        level = found[1].count(">") if found else 0
        if found:
            if level != last:
                passages.append((level, []))
                if last == 0 and own and INTRODUCES.match(own[-1]):
                    own.pop()
            passages[-1][1].append(found[2])
        else:
            own.append(line)
        last = level
    kept = re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip()
    quoted = dict.fromkeys((level, unit) for level, lines in passages for unit in units("\n".join(lines)))
    return kept, units(kept), list(quoted)


def numbered(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """Adds ``range`` and ``number``, the place of each row in the order, from 0.

    ``order`` must tell all rows apart.
    """
    split = scratch.keep(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = split.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    return split.withColumn("place", place).join(starts, "range").select(
        *rows.columns, "range", (F.col("start") + F.col("place")).alias("number")
    )


def hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def parents(messages: DataFrame) -> DataFrame:
    """number, and the number of the message that its quotes lead to."""
    originals = (
        messages.select("conv", "number", F.explode("parsed.units").alias("unit"))
        .groupBy("conv", *hashes(F.col("unit")))
        .agg(F.min("number").alias("original"))
    )
    quoted = messages.select("conv", "number", F.explode("parsed.quotes").alias("q")).select(
        "conv", "number", F.col("q.level").alias("level"), F.length("q.text").alias("chars"), *hashes(F.col("q.text"))
    )
    same = (
        F.col("q.conv").eqNullSafe(F.col("o.conv"))
        & (F.col("q.h1") == F.col("o.h1"))
        & (F.col("q.h2") == F.col("o.h2"))
        & (F.col("o.original") < F.col("q.number"))
    )
    linked = quoted.alias("q").join(originals.alias("o"), same).select("q.number", "q.level", "q.chars", "o.original")
    weighed = linked.groupBy("number", "level", "original").agg(
        F.sum("chars").alias("chars"), F.count("*").alias("units")
    )
    best = F.max(F.struct((-F.col("level")).alias("l"), "chars", "original"))
    return weighed.groupBy("number").agg(best.alias("b"), F.sum("units").alias("n_linked")).select(
        "number", F.col("b.original").alias("linked"), "n_linked"
    )


def chained(replies: DataFrame) -> DataFrame:
    """Adds ``chain``: the last message at or before each that does not follow its parent."""
    head = F.when(F.col("parent").isNull() | (F.col("parent") != F.col("number") - 1), F.col("number"))
    rows = replies.withColumn("head", head)
    upto = Window.partitionBy("range").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("range").agg(F.max("head").alias("m")).select(
        "range", F.max("m").over(before).alias("carried")
    )
    return (
        rows.withColumn("own", F.max("head").over(upto))
        .join(carried, "range")
        .withColumn("chain", F.coalesce("own", "carried"))
        .drop("own", "carried")
    )


def walk(chains: DataFrame, scratch: Scratch) -> DataFrame:
    """step, next and weight of the walks around the trees of chains: step ``2 * chain`` enters a
    chain and counts its messages, ``2 * chain + 1`` leaves it."""
    sizes = chains.groupBy("chain").agg(F.count("*").alias("size"))
    parents_chain = chains.select(F.col("number").alias("p"), F.col("chain").alias("above"))
    heads = chains.where("head is not null").select(F.col("number").alias("chain"), "parent")
    # Of the chains that hang on one, those on its last messages come first.
    nodes = (
        heads.join(parents_chain, F.col("parent") == F.col("p"), "left")
        .join(sizes, "chain")
        .select("above", (-F.col("parent")).alias("back"), "chain", "size")
    )
    order = ["above", "back", "chain"]
    dealt = scratch.keep(nodes.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    following = Window.partitionBy("range").orderBy(*order)
    here = F.struct("above", "chain")
    openings = dealt.groupBy("range").agg(F.min(F.struct(*order)).alias("o")).select(
        "range", F.lead(F.struct("o.above", "o.chain")).over(Window.orderBy("range")).alias("beyond")
    )
    after = F.coalesce(F.lead(here).over(following), F.col("beyond"))
    beside = dealt.join(openings, "range").select("chain", "above", "size", after.alias("after")).select(
        "chain", "above", "size", F.when(F.col("after.above") == F.col("above"), F.col("after.chain")).alias("sibling")
    )
    inner = dealt.where("above is not null").groupBy(F.col("above").alias("c")).agg(
        F.min(F.struct("back", "chain"))["chain"].alias("child")
    )
    known = beside.join(inner, F.col("chain") == F.col("c"), "left")
    enter, leave = F.col("chain") * 2, F.col("chain") * 2 + 1
    steps = F.array(
        F.struct(enter.alias("step"), F.coalesce(F.col("child") * 2, leave).alias("next"), F.col("size").alias("weight")),
        F.struct(
            leave.alias("step"),
            F.coalesce(F.col("sibling") * 2, F.col("above") * 2 + 1).alias("next"),
            F.lit(0).cast("long").alias("weight"),
        ),
    )
    return known.select(F.explode(steps).alias("s")).select("s.*")


def left_from(steps: DataFrame, scratch: Scratch) -> DataFrame:
    """step and the messages from it to the end of its walk, by doubling."""
    now = scratch.keep(steps)
    while not now.where("next is not null").isEmpty():
        # Steps that have reached the end stay out of the join: they have no key to meet by.
        reached = now.select(F.col("step").alias("at"), F.col("next").alias("then"), F.col("weight").alias("more"))
        going = now.where("next is not null").join(reached, F.col("next") == F.col("at")).select(
            "step", F.col("then").alias("next"), (F.col("weight") + F.col("more")).alias("weight")
        )
        after = scratch.keep(now.where("next is null").unionByName(going))
        scratch.drop(now)
        now = after
    return now.select("step", "weight")


def link_quotes(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per message: conv_id, turn, role, reply_index (from 0, in reply order),
    parent_turn, n_quotes and n_linked (units), quote_level, text (without quotes), copies."""

    @pandas_udf(PARSED)
    def parsed(texts: pd.Series) -> pd.DataFrame:
        found = [parse(t if isinstance(t, str) else None) for t in texts]
        return pd.DataFrame({
            "own": [own for own, _, _ in found],
            "units": [u for _, u, _ in found],
            "quotes": [[{"level": level, "text": t} for level, t in q] for _, _, q in found],
        })

    names = ["conv", "turn", "role", "text_hash"]
    text = F.coalesce(column("text"), F.lit(""))
    messages = (
        rows.select(column("conv_id").alias("conv"), column("turn").alias("turn"), column("role").alias("role"),
                    F.xxhash64(text).alias("text_hash"), text.alias("text"))
        .groupBy(*names)
        .agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    )
    ordered = numbered(messages, names, scratch)
    messages = scratch.keep(ordered.withColumn("parsed", parsed("text")).drop("text"))
    replies = (
        messages.select("conv", "turn", "number", "range")
        .alias("m")
        .join(messages.select(F.col("conv").alias("c"), F.col("number").alias("n")).alias("p"),
              (F.col("m.number") == F.col("p.n") + 1) & F.col("m.conv").eqNullSafe(F.col("p.c")), "left")
        .join(parents(messages).alias("q"), F.col("m.number") == F.col("q.number"), "left")
        .select("m.*", F.coalesce("q.linked", "p.n").alias("parent"), F.coalesce("q.n_linked", F.lit(0)).alias("n_linked"))
    )
    chains = scratch.keep(chained(replies))
    remaining = left_from(walk(chains, scratch), scratch).where("step % 2 = 0")
    # Written, so that the join deals both sides out anew and splits a long chain.
    remaining = scratch.keep(remaining.select((F.col("step") / 2).cast("long").alias("entered"), "weight"))
    whole = scratch.keep(messages.groupBy("conv").agg(F.count("*").alias("messages")))
    # What stands before a chain is what its conversation holds less what is left from there on.
    index = F.col("s.messages") - F.col("e.weight") + F.col("r.number") - F.col("r.chain")
    placed = (
        chains.alias("r")
        .join(remaining.alias("e"), F.col("r.chain") == F.col("e.entered"))
        .join(whole.alias("s"), F.col("r.conv").eqNullSafe(F.col("s.conv")))
        .select(F.col("r.number").alias("message"), "r.parent", "r.n_linked", index.alias("reply_index"))
    )
    turns = messages.select(F.col("number").alias("p"), F.col("turn").alias("parent_turn"))
    return (
        placed.alias("r")
        .join(messages.alias("m"), F.col("r.message") == F.col("m.number"))
        .join(turns.alias("t"), F.col("r.parent") == F.col("t.p"), "left")
        .select(
            F.col("m.conv").alias("conv_id"),
            "m.turn",
            "m.role",
            "r.reply_index",
            "t.parent_turn",
            F.size("m.parsed.quotes").cast("long").alias("n_quotes"),
            F.col("r.n_linked").cast("long").alias("n_linked"),
            F.coalesce(F.array_max(F.col("m.parsed.quotes.level")), F.lit(0)).alias("quote_level"),
            F.col("m.parsed.own").alias("text"),
            "m.copies",
        )
    )
