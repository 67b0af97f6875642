"""Chat formatting with shared beginnings written once.

Conversations are formatted turn by turn and put in the order of their turns, so
that conversations with the same first turns are neighbours. Runs of neighbours are
merged into packs, trees of turns: a turn that several conversations of the pack
share in the same place is written once, depth first. Each turn knows at which
position its characters stand in their conversation, which earlier stretches of the
pack they may attend to (their ancestors and themselves), and which characters count
for the loss.

A pack is bounded like a training sequence, so a very common first turn is shared
inside each of its packs and no task holds all conversations that begin with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.llm.common import stored

#: A pack is closed when it has this many characters or conversations.
PACK_CHARS = 65_536
PACK_CONVERSATIONS = 1024
# The control strings of the template.
CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<<:>>")

_ESCAPE = re.compile("|".join([r"\\", *map(re.escape, CONTROLS)]))


def escaped(text: str) -> str:
    r"""``text`` without control strings: a backslash goes behind their first character, and is doubled itself."""
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """One turn with its marks, and where in it the text begins and ends."""
    inner = escaped(text)
    if role == "user":
        head, tail = "[INST] ", " [/INST]"
    elif role == "assistant":
        head, tail = "<s>", "</s>"
    else:
        head, tail = f"<<SYS>>{escaped(role)}<<:>>", "<</SYS>>"
    return head + inner + tail, len(head), len(head) + len(inner)


def parsed(text: str) -> list[tuple[str, str]]:
    """Turns (role, text) of a formatted conversation."""
    turns, at = [], 0
    while at < len(text):
        if text.startswith("[INST] ", at):
            end = text.index("[/INST]", at)
            turns.append(("user", unescaped(text[at + 7:end - 1])))
            at = end + 7
        elif text.startswith("<s>", at):
            end = text.index("</s>", at)
            turns.append(("assistant", unescaped(text[at + 3:end])))
            at = end + 4
        elif text.startswith("<<SYS>>", at):
            split, end = text.index("<<:>>", at), text.index("<</SYS>>", at)
            turns.append((unescaped(text[at + 7:split]), unescaped(text[split + 5:end])))
            at = end + 8
        else:
            raise ValueError(f"no mark at character {at}")
    return turns


@dataclass
class Pack:
    """A tree of turns in depth-first order; offsets count code points of ``text``."""

    text: list[str] = field(default_factory=list)
    chars: int = 0
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    position: list[int] = field(default_factory=list)
    loss: list[list[int]] = field(default_factory=list)
    attends: list[list[int]] = field(default_factory=list)
    conversations: list = field(default_factory=list)
    last: list[int] = field(default_factory=list)
    path: list[tuple[str, str, int]] = field(default_factory=list)

    def add(self, conversation, turns: list[tuple[str, str]]) -> None:
        """Add a conversation; it shares what it has in common with the one before."""
        same = 0
        while same < min(len(turns), len(self.path)) and self.path[same][:2] == turns[same]:
            same += 1
        del self.path[same:]
        for role, text in turns[same:]:
            up = self.path[-1][2] if self.path else -1
            body, first, stop = formatted(role, text)
            start, end = self.chars, self.chars + len(body)
            spans = [*self.attends[up]] if up >= 0 else []
            if spans and spans[-1] == start:  # a parent right before: one stretch
                spans[-1] = end
            else:
                spans += [start, end]
            self.position.append(self.position[up] + self.end[up] - self.start[up] if up >= 0 else 0)
            self.text.append(body)
            self.start.append(start)
            self.end.append(end)
            self.parent.append(up)
            self.attends.append(spans)
            self.loss.append([start + first, start + stop] if role == "assistant" else [])
            self.chars = end
            self.path.append((role, text, len(self.start) - 1))
        self.conversations.append(conversation)
        self.last.append(self.path[-1][2] if self.path else -1)


_SPANS = "array<array<bigint>>"


def packs(turns: DataFrame, pack_chars: int = PACK_CHARS, pack_conversations: int = PACK_CONVERSATIONS) -> DataFrame:
    """Packs of formatted conversations, one row each.

    Takes ``conv_id``, ``turn``, ``role``, ``text``; other columns are ignored. Columns:
    pack_id, text, and per turn of the tree node_start, node_end (places in text),
    node_parent (-1: none), node_position (position id of the first character; the
    others follow), node_loss (begin and end of what counts for the loss, or
    empty), node_attends (begins and ends of the stretches it sees, its own last);
    then conversations and last_node, where each of them ends.

    Turns are taken by turn, then role, then text, nulls first, so repeated turns
    stay and ties have one order. A null role or text counts as empty. Rows with a
    null conv_id form one conversation. Every conversation is formatted whole,
    however long; it meets in one row as a document does. An empty table gives no packs.
    """
    id_type = dict(turns.dtypes)["conv_id"]
    conversations = turns.select("conv_id", F.struct(
        F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    conversations = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # hashes only set the order; turns are shared where they are equal
    path = F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"]))
    conversations = conversations.select(
        "conv_id", path.alias("path"), F.transform("turns", lambda t: t["role"]).alias("roles"),
        F.transform("turns", lambda t: t["text"]).alias("texts"))
    parts = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = conversations.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, longs = TaskContext.get().partitionId() << 33, pa.list_(pa.int64())
        pack, kind = Pack(), None

        def row() -> pa.RecordBatch:
            values = [(number, pa.int64()), ("".join(pack.text), pa.string()), (pack.start, longs), (pack.end, longs),
                      (pack.parent, longs), (pack.position, longs), (pack.loss, pa.list_(longs)),
                      (pack.attends, pa.list_(longs)), (pack.conversations, pa.list_(kind)), (pack.last, longs)]
            return pa.record_batch([pa.array([v], t) for v, t in values], names=list(COLUMNS))

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conversation, roles, texts in zip(
                    *[batch.column(c).to_pylist() for c in ("conv_id", "roles", "texts")]):
                pack.add(conversation, list(zip(roles, texts)))
                if pack.chars >= pack_chars or len(pack.conversations) >= pack_conversations:
                    yield row()
                    pack, number = Pack(), number + 1
        if pack.conversations:
            yield row()

    return ordered.select("conv_id", "roles", "texts").mapInArrow(
        scan, ", ".join(f"{c} {t}" for c, t in COLUMNS.items()).format(id=id_type))


COLUMNS = {
    "pack_id": "long", "text": "string", "node_start": "array<long>", "node_end": "array<long>",
    "node_parent": "array<long>", "node_position": "array<long>", "node_loss": _SPANS, "node_attends": _SPANS,
    "conversations": "array<{id}>", "last_node": "array<long>",
}


def read_back(packed: DataFrame) -> DataFrame:
    """What a trainer would see of every conversation, from the packs alone.

    One row per conversation: conv_id, formatted, roles, texts, loss_text. The path
    is read through the attention stretches of its last turn; loss_text is all text
    under the loss mask, unescaped.
    """
    kind = dict(packed.dtypes)["conversations"].removeprefix("array<")[:-1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_kind = batch.schema.field("conversations").type.value_type
            for row in batch.select([c for c in COLUMNS if c != "pack_id"]).to_pylist():
                text, out = row["text"], []
                for conversation, last in zip(row["conversations"], row["last_node"]):
                    spans = row["node_attends"][last] if last >= 0 else []
                    whole = "".join(text[a:b] for a, b in zip(spans[::2], spans[1::2]))
                    loss, at = [], last
                    while at >= 0:
                        if row["node_loss"][at]:
                            a, b = row["node_loss"][at]
                            loss.append(unescaped(text[a:b]))
                        at = row["node_parent"][at]
                    turns = parsed(whole)
                    out.append((conversation, whole, [r for r, _ in turns], [t for _, t in turns], "".join(reversed(loss))))
                columns = list(zip(*out))
                strings = pa.list_(pa.string())
                yield pa.record_batch([
                    pa.array(columns[0], id_kind), pa.array(columns[1], pa.string()), pa.array(columns[2], strings),
                    pa.array(columns[3], strings), pa.array(columns[4], pa.string())],
                    names=["conv_id", "formatted", "roles", "texts", "loss_text"])

    return packed.mapInArrow(
        scan, f"conv_id {kind}, formatted string, roles array<string>, texts array<string>, loss_text string")


def formatted_conversations(turns: DataFrame, **options) -> DataFrame:
    """Format, store the packs, and read every conversation back from them."""
    return read_back(stored(packs(turns, **options), "packs"))

