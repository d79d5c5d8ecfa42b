import random

import pytest
from pyspark.sql import functions as F

from pontualis.llm import chats
from pontualis.llm.chats import Template

SCHEMA = "conv_id long, message long, seq long, kind string, role string, text string"
PIECES = ["\\", "\\\\", "<turn ", "</turn>", "<", ">", ">\n", "\n", "### Assistant:", "##### User:", "<|im_end|>",
          "<<turn turn", "ok ", "é\U0001f600", " ", "#", "</turn></turn>\n", "$1", "\\E", "\t\x00"]


def folded(events):
    """Turns of one conversation, event by event."""
    none = -(1 << 70)
    rank = {k: i for i, k in enumerate(chats.KINDS)}
    rows = sorted(events, key=lambda e: (none if e[0] is None else e[0], none if e[1] is None else e[1],
                                         rank.get(e[2], 1), e[3] is not None, e[3] or "",
                                         e[4] is not None, e[4] or ""))
    turns, last = [], object()
    for message, _, kind, role, text in rows:
        if kind == "open" or message != last:
            turns.append([None, ""])
        last, turn = message, turns[-1]
        turn[0] = role if turn[0] is None else turn[0]
        turn[1] = (text or "") if kind in ("open", "edit", "regenerate") else turn[1] + (text or "")
    return [(r or "", t) for r, t in turns]


def whole(chat_rows):
    """Turns, loss text and formatted text of each conversation, parts in order."""
    out = {}
    for r in sorted(chat_rows, key=lambda r: r.part):
        turns, loss, text = out.setdefault(r.conv_id, ([], [], []))
        turns += [tuple(t) for t in r.turns]
        loss.append(r.loss_text)
        text.append(r.text)
    return {k: (t, "".join(x), "".join(y)) for k, (t, x, y) in out.items()}


@pytest.mark.parametrize("part_events", [1024, 7])
def test_against_a_fold_event_by_event(spark, part_events):
    dice = random.Random(part_events)
    log = []
    for conv in (None, 1, 2, 3, 4):
        for _ in range(dice.choice([1, 5, 60])):
            log.append((conv, dice.choice([None, *range(8)]), dice.randrange(4),
                        dice.choice([*chats.KINDS, "delta", "delta", None, "other"]),
                        dice.choice(["user", "assistant", None]),
                        dice.choice([None, "", *PIECES])))
    log += log[:3]
    df = spark.createDataFrame(log, SCHEMA).repartition(4)
    got = whole(chats.read_back(chats.format_chats(df, part_events=part_events)).collect())
    for conv in {e[0] for e in log}:
        wanted = folded([e[1:] for e in log if e[0] == conv])
        assert got[conv][0] == wanted
        assert got[conv][1] == "".join(t for r, t in wanted if r == "assistant")


def test_any_text_comes_back(spark):
    dice = random.Random(1)
    rows = [(i, 0, 0, "open", "".join(dice.choices(PIECES, k=dice.randrange(3))),
             "".join(dice.choices(PIECES, k=dice.randrange(12)))) for i in range(400)]
    out = chats.read_back(chats.format_chats(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r.conv_id: tuple(r.turns[0]) for r in out} == {r[0]: r[4:] for r in rows}
    marks = Template().control[3:]
    assert not [r.text for r in out if any(m in r.text for m in marks) or r.text.count("</turn>") != 1]


def test_streams_edits_and_regenerations(spark):
    log = [
        (1, 0, 0, "open", "user", "What is"), (1, 0, 1, "delta", None, " 1 + 1?"), (1, 0, 9, "edit", None, "And 2 + 2?"),
        (1, 1, 2, "open", "assistant", ""), (1, 1, 3, "delta", None, "Fi"), (1, 1, 4, "delta", None, "ve."),
        (1, 1, 5, "regenerate", None, None), (1, 1, 6, "delta", None, "Fo"), (1, 1, 7, "delta", None, "ur."),
        (1, 2, 8, "delta", "system", "end"),
    ]
    row = chats.format_chats(spark.createDataFrame(log, SCHEMA).repartition(5)).first()
    assert row.text == ("<turn user>\nAnd 2 + 2?\n</turn>\n<turn assistant>\nFour.\n</turn>\n"
                        "<turn system>\nend\n</turn>\n")
    assert [row.text[s.start:s.start + s.length] for s in row.loss] == ["Four."]
    assert (row.n_turns, row.whole) == (3, True)


def test_a_long_conversation_is_parted(spark):
    rows = [(c, i, 0, "open", "assistant" if i % 2 else "user", f"t{i} <turn ")
            for c, n in ((1, 5000), (2, 30), (None, 900)) for i in range(n)]
    df = chats.format_chats(spark.createDataFrame(rows, SCHEMA).repartition(3), part_events=500)
    read = chats.read_back(df)
    parts = {r.conv_id: r["count"] for r in read.groupBy("conv_id").count().collect()}
    assert parts[2] == 1 and parts[1] >= 8 and read.agg(F.max("n_turns")).first()[0] < 1500
    got = whole(read.collect())
    assert got[1][0] == [(r[4], r[5]) for r in rows if r[0] == 1]
    small = chats.digests(chats.read_back(chats.format_chats(spark.createDataFrame(rows, SCHEMA))))
    assert sorted(map(str, chats.digests(read).collect())) == sorted(map(str, small.collect()))


def test_no_python_in_the_plan(spark):
    df = spark.range(5).select(F.col("id").alias("conv_id"), F.lit(0).alias("message"), F.lit(0).alias("seq"),
                               F.lit("open").alias("kind"), F.lit("user").alias("role"), F.lit("x").alias("text"))
    plan = chats.digests(chats.read_back(chats.format_chats(df)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 2


def test_empty_long_and_clashing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chats.digests(chats.read_back(chats.format_chats(none))).count() == 0
    long = "<turn \\" * 300_000
    df = spark.createDataFrame([(1, 0, 0, "open", "assistant", long)], SCHEMA)
    for name in ("part", "log", "turns", "loss", "whole", "long_id", "step"):
        df = df.withColumn(name, F.lit("clash"))
    row = chats.read_back(chats.format_chats(df)).first()
    assert row.loss_text == long and row.turns[0].text == long


def test_marks_must_be_plain():
    with pytest.raises(ValueError):
        Template(others=("\\x",))
