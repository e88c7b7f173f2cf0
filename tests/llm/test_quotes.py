import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stratalake.llm import quotes
from stratalake.llm.common import Scratch

SCHEMA = StructType([
    StructField("conv_id", LongType()), StructField("turn", LongType()),
    StructField("role", StringType()), StructField("text", StringType()),
])


def linked(spark, rows):
    found = quotes.link_quotes(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "quotes")).collect()
    return sorted(found, key=lambda r: (r.conv_id is not None, r.conv_id, r.reply_index))


def preorder(parents):
    """Depth-first order of a tree given as child -> parent, children by number."""
    kids = {}
    for child, parent in parents.items():
        kids.setdefault(parent, []).append(child)
    out, stack = [], sorted(kids.get(None, []), reverse=True)
    while stack:
        at = stack.pop()
        out.append(at)
        stack += sorted(kids.get(at, []), reverse=True)
    return out


def test_parse_levels():
    own, units, quoted = quotes.parse("Hi\nOn Monday, Ann wrote:\n> one\n>> two  TWO\n> > three\nbye")
    assert own == "Hi\nbye"
    assert units == ["hi bye", "hi", "bye"]
    assert quoted == [(1, "one"), (2, "two two three"), (2, "two two"), (2, "three")]


def test_reply_order(spark):
    rows = [
        (1, 0, "a", "Where shall we meet?\n\nAnd when?"),
        (1, 1, "b", "> where shall  we MEET?\nAt the gate."),
        (1, 2, "c", "> And when?\nAt noon."),
        (1, 3, "a", "> At the gate.\n>> Where shall we meet?\nGood."),
        (1, 4, "b", "> Nobody said this\nOdd."),
        (1, 5, "c", "> At noon.\nToo late."),
    ]
    found = linked(spark, rows)
    parents = {r.turn: r.parent_turn for r in found}
    assert parents == {0: None, 1: 0, 2: 0, 3: 1, 4: 3, 5: 2}
    assert [r.turn for r in found] == preorder(parents) == [0, 1, 3, 4, 2, 5]
    assert [r.text for r in found] == [
        "Where shall we meet?\n\nAnd when?", "At the gate.", "Good.", "Odd.", "At noon.", "Too late."
    ]
    assert {r.turn: r.quote_level for r in found}[3] == 2
    assert {r.turn: r.n_linked for r in found} == {0: 0, 1: 1, 2: 1, 3: 2, 4: 0, 5: 1}


def test_random_trees(spark):
    import random

    random.seed(3)
    rows, want = [], {}
    for conv in range(12):
        parents = {0: None}
        rows.append((conv, 0, "u", f"message {conv} 0"))
        for turn in range(1, 40):
            parent = random.randrange(turn)
            parents[turn] = parent
            rows.append((conv, turn, "u", f"> message {conv} {parent}\nmessage {conv} {turn}"))
        want[conv] = preorder(parents)
    found = linked(spark, rows)
    for conv, order in want.items():
        assert [r.turn for r in found if r.conv_id == conv] == order


def test_nulls_ties_and_repeats(spark):
    rows = [
        (None, None, None, None), (None, 1, "a", "x"), (None, 1, "a", "x"), (7, 0, "u", ""),
        (7, 0, "v", "> x\n"), (7, None, "u", "long " * 5000),
    ]
    found = linked(spark, rows)
    assert sum(r.copies for r in found) == len(rows)
    assert [(r.conv_id, r.turn, r.copies) for r in found] == [
        (None, None, 1), (None, 1, 2), (7, None, 1), (7, 0, 1), (7, 0, 1)
    ]
    assert all(r.n_linked == 0 for r in found)


@pytest.mark.parametrize("extra", ["number", "parent", "chain", "range"])
def test_extra_columns(spark, extra):
    rows = spark.createDataFrame([(1, 0, "u", "a", 9)], "conv_id long, turn long, role string, text string, x long")
    found = quotes.link_quotes(rows.withColumnRenamed("x", extra), Scratch(spark, "quotes"))
    assert found.count() == 1


def test_empty(spark):
    assert quotes.link_quotes(spark.createDataFrame([], SCHEMA), Scratch(spark, "quotes")).count() == 0


def test_a_conversation_of_a_third_of_all_rows(spark):
    """Threads that interleave, each message quoting its thread's last one, and a message that many
    quote: deep chains and wide ones, numbered in rows of one width."""
    import random

    random.seed(11)
    rows, want = [], {}
    sizes = {0: 300, **{c: 20 for c in range(1, 31)}}
    for conv, size in sizes.items():
        parents = {0: None}
        rows.append((conv, 0, "u", f"message {conv} 0"))
        for turn in range(1, size):
            parent = 0 if turn <= 5 or random.random() < 0.3 else turn - 5
            parents[turn] = parent
            rows.append((conv, turn, "u", f"> message {conv} {parent}\nmessage {conv} {turn}"))
        want[conv] = preorder(parents)
    random.shuffle(rows)
    found = linked(spark, rows)
    for conv, order in want.items():
        assert [r.turn for r in found if r.conv_id == conv] == order
        assert [r.reply_index for r in found if r.conv_id == conv] == list(range(len(order)))


def test_steps_have_one_width(spark):
    chains = spark.createDataFrame(
        [(i, None if i == 0 else max(0, i - 2), None if i == 1 else i, i if i != 1 else 0) for i in range(50)],
        "number long, parent long, head long, chain long",
    )
    steps = quotes.walk(chains, Scratch(spark, "quotes"))
    assert [t for _, t in steps.dtypes] == ["bigint"] * 3
    left = {r.step: r.weight for r in quotes.left_from(steps, Scratch(spark, "quotes")).collect()}
    assert left[0] == 50
