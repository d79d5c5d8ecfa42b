"""Chat transcripts from event logs, as training text with a loss mask; DataFrame functions only.

A log's rows (``conv_id, message, seq, kind, role, text``) are partitioned by conversation,
sorted by message and sequence, and folded: ``open`` begins a turn with its text, ``delta``
adds to the turn, ``edit`` replaces what it says, ``regenerate`` discards it, so that the
following deltas make it anew.  A message whose first event is no ``open`` begins with that
event.  The folded turns are rendered in a template, with the spans that count towards the loss.

**Template.**  ``<turn role>``, the text, and ``</turn>``, each on lines of its own.  In texts and
roles a backslash is doubled, and one is put behind the first character of every control
string, including those of other common templates.  So no control string is left in a text, and
reading back is exact: a backslash always makes the next character literal.

**Long conversations.**  A conversation of more than ``part_events`` events is dealt by ranges of
its messages over parts, each folded and rendered by itself; the parts, in order, are the
conversation.  All others are one part and are shuffled once.  A message's events are never
parted; messages of one number, in a conversation, count as one here.

Defined cases: a null text is empty, a null role the empty one; null conversations are one
conversation; null messages and sequences come first; a null or unknown kind is a ``delta``.
Events that tie in message and sequence are ordered by kind (as above), role and text.
Repeated rows are repeated events.  Extra columns are ignored; an empty log gives no rows.
A conversation's text is one value, so it may not pass 2 GB in all parts together where it is
read back as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.sources.scratch import materialize

KINDS = ("open", "delta", "edit", "regenerate")
_SPANS = "array<struct<start:bigint,length:bigint>>"


@dataclass(frozen=True)
class Template:
    """Marks of a turn, and the control strings of other templates that are escaped as well."""

    opening: str = "<turn "
    headed: str = ">\n"
    closing: str = "\n</turn>\n"
    others: Sequence[str] = ("### System:", "### User:", "### Assistant:", "<|im_start|>", "<|im_end|>")

    def __post_init__(self):
        for mark in self.control:
            if len(mark) < 2 or "\\" in mark:
                raise ValueError(f"no control string: {mark!r}")

    @property
    def control(self) -> tuple[str, ...]:
        return (self.opening, self.closing.strip("\n"), self.headed, *self.others)

    def _starts(self) -> str:
        """A pattern of the first characters of control strings."""
        return "|".join(rf"\Q{m[0]}\E(?=\Q{m[1:]}\E)" for m in self.control)

    def escape(self, text: Column) -> Column:
        doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        return F.regexp_replace(doubled, F.lit(self._starts()), F.lit("$0\\\\"))

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def _turns(log: Column) -> tuple[Column, Column]:
    """Where turns begin in a sorted array of events; and, given that as a column ``starts``, the
    turns (``role, text``)."""
    def begins(i: Column) -> Column:
        event, last = F.get(log, i - 1), F.get(log, i - 2)
        return ((i == 1) | (event["step"] == KINDS.index("open"))
                | ~event["message"].eqNullSafe(last["message"]))

    starts = F.filter(F.sequence(F.lit(1), F.size(log)), begins)

    def fold(events: Column) -> Column:
        # What comes before the last event that is no delta is gone.
        reset = F.array_max(F.transform(events, lambda e, i: F.when(e["step"] != KINDS.index("delta"), i)))
        reset = F.coalesce(reset, F.lit(0))
        left = F.slice(events, reset + 1, F.size(events) - reset)
        roles = F.filter(F.transform(events, lambda e: e["role"]), lambda r: r.isNotNull())
        return F.struct(
            F.coalesce(F.get(roles, F.lit(0)), F.lit("")).alias("role"),
            F.array_join(F.transform(left, lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text"))

    def turn(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get(F.col("starts"), i + 1), F.size(log) + 1)
        return fold(F.slice(log, start, end - start))

    return starts, F.transform("starts", turn)


def _spans(rendered: Column) -> Column:
    """Start and length, in code points, of the texts that count."""
    def add(done: Column, turn: Column) -> Column:
        start = done["at"] + F.char_length(turn["head"])
        length = F.char_length(turn["body"]).cast("long")
        span = F.array(F.struct(start.alias("start"), length.alias("length")))
        return F.struct((start + length + F.char_length(turn["tail"])).alias("at"),
                        F.when(turn["counts"], F.concat(done["spans"], span))
                        .otherwise(done["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("spans"))
    return F.aggregate(rendered, zero, add, lambda done: done["spans"])


def _format(log: DataFrame, template: Template, loss_roles: Sequence[str]) -> DataFrame:
    """One row for each ``conv_id, part`` of the events in ``log``."""
    event = F.struct("message", "seq", "step", "role", "text")
    grouped = log.groupBy("conv_id", "part", "whole").agg(F.collect_list(event).alias("log"))
    grouped = grouped.withColumn("log", F.array_sort("log"))
    starts, turns = _turns(F.col("log"))
    folded = grouped.withColumn("starts", starts).withColumn("turns", turns)

    def render(turn: Column) -> Column:
        head = F.concat(F.lit(template.opening), template.escape(turn["role"]), F.lit(template.headed))
        return F.struct(head.alias("head"), template.escape(turn["text"]).alias("body"),
                        F.lit(template.closing).alias("tail"),
                        turn["role"].isin(*loss_roles).alias("counts"))

    rendered = folded.withColumn("rendered", F.transform("turns", render))
    lines = F.transform("rendered", lambda t: F.concat(t["head"], t["body"], t["tail"]))
    return rendered.select("conv_id", "part", "whole", F.size("turns").cast("long").alias("n_turns"),
                           F.array_join(lines, "").alias("text"),
                           _spans(F.col("rendered")).alias("loss"))


def format_chats(events: DataFrame, *, template: Template = Template(),
                 loss_roles: Sequence[str] = ("assistant",), part_events: int = 1024) -> DataFrame:
    """``conv_id, part, whole, n_turns, text, loss`` of the conversations in a log.

    ``loss`` holds the spans (``start, length``, in code points of the part's text) of the
    turns by ``loss_roles``.  ``whole`` says that the conversation is one part; else ``part``
    orders its parts.
    """
    kind = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    step = F.when(kind > 0, kind - 1).otherwise(KINDS.index("delta"))
    log = events.select("conv_id", "message", "seq", step.alias("step"), "role", "text")
    long = materialize(log.groupBy(F.col("conv_id").alias("long_id"))
                       .agg(F.count(F.lit(1)).alias("events")).filter(F.col("events") > part_events),
                       "long_chats")
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = log.join(long, is_long, "left_anti").withColumns({"part": F.lit(0), "whole": F.lit(True)})
    out = _format(short, template, loss_roles)
    total = long.agg(F.sum("events")).first()[0]
    if not total:
        return out
    dealt = (log.join(long, is_long, "left_semi")
             .repartitionByRange(-(-total // part_events), "conv_id", "message")
             .withColumns({"part": F.spark_partition_id(), "whole": F.lit(False)}))
    return out.unionByName(_format(dealt, template, loss_roles))


def read_back(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """Adds ``turns`` (``role, text``) and ``loss_text``, read from the text and its loss spans."""
    closing = F.lit(rf"\Q{template.closing}\E")
    found = F.split("text", closing, -1)
    found = F.slice(found, F.lit(1), F.size(found) - 1)
    size = len(template.opening)

    def turn(line: Column) -> Column:
        head = F.instr(line, F.lit(template.headed))
        role = F.substring(line, F.lit(size + 1), head - size - 1)
        text = F.substring(line, head + len(template.headed), F.char_length(line))
        return F.struct(template.unescape(role).alias("role"), template.unescape(text).alias("text"))

    under = F.transform("loss", lambda s: F.substring(F.col("text"), (s["start"] + 1).cast("int"),
                                                      s["length"].cast("int")))
    under = F.array_join(F.transform(under, template.unescape), "")
    return chats.withColumns({"turns": F.transform(found, turn), "loss_text": under})


def digests(chats: DataFrame) -> DataFrame:
    """One row per conversation of what :func:`read_back` gives: its turns and loss text as digests.

    Only conversations of several parts are shuffled.
    """
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = chats.select("conv_id", "part", "whole", F.size("turns").cast("long").alias("n_turns"),
                        F.array_join(said, "").alias("said"), "loss_text",
                        F.char_length("text").cast("long").alias("chars"))
    parts = read.filter(~F.col("whole")).groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("part", "said", "loss_text"))).alias("parts"),
        F.sum("chars").alias("chars"))

    def joined(field: str) -> Column:
        return F.array_join(F.transform("parts", lambda p: p[field]), "").alias(field)

    parts = parts.select("conv_id", "n_turns", joined("said"), joined("loss_text"), "chars")
    every = read.filter("whole").select(*parts.columns).unionAll(parts)
    return every.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"),
                        F.char_length("loss_text").cast("long").alias("loss_chars"),
                        F.sha2("loss_text", 256).alias("loss_sha256"),
                        F.col("chars").alias("formatted_chars"))
