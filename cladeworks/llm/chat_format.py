"""Chat formatting into packed prefix trees.

Conversations are written with a template and merged where they begin with the same turns: a turn that several
conversations share is emitted once, depth-first, with its descendants after it. Sorting conversations by the
digests of their turns is a depth-first order, so each conversation only adds what it does not share with the one
before it. The sort deals ranges, not keys, so a common first turn or a conversation that is repeated very often
spreads over tasks. A pack closes when it holds MAX_TOKENS tokens or MAX_LEAVES conversations (a longer
conversation has a pack to itself) or its range ends; ancestors that the next pack needs are repeated there.

A pack is one row: ids and positions (packed little-endian unsigned 32-bit), nodes (token span, parent, role, loss
span, and the spans of the pack that its tokens attend to besides those before them in the node) and leaves
(conversation and its last node). A token's position counts along its own conversation.

Template: user turns are `[INST] text [/INST]`, system turns `[SYS] text [/SYS]`, assistant turns `<s> text </s>`;
any other role r is `[ROLE] r [/ROLE]` before a user turn's marks. A control string inside a text or role gets one
backslash more after its first character, and reading takes it away again. The loss mask covers assistant texts.

Edge cases: null texts and roles are empty; a null conv_id is a conversation of its own; rows are ordered by turn
(null first), then role and text, and repeated rows all stay; an empty table gives no packs; other columns of the
input are ignored. A conversation is held whole by one task, as its digest needs all its turns in order; work on it is
linear in its turns and texts, however long (its spans are few: turns that follow each other in a pack are one).
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_codec import codec
from .common import in_arrow, table

MAX_TOKENS, MAX_LEAVES = 1 << 16, 1 << 10
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("<s> ", " </s>")}
_CONTROL = re.compile(r"([<\[])(\\*/?(?:s>|(?:INST|SYS|ROLE)\]))")
_ESCAPED = re.compile(r"([<\[])\\(\\*/?(?:s>|(?:INST|SYS|ROLE)\]))")
_TURN = re.compile(r"(?:\[ROLE\] (?P<role>.*?) \[/ROLE\])?(?:\[INST\] (?P<user>.*?) \[/INST\]|\[SYS\] (?P<system>.*?) \[/SYS\]|<s> (?P<assistant>.*?) </s>)", re.S)
_NODE = "struct<begin:bigint,end:bigint,parent:int,role:string,loss_begin:bigint,loss_end:bigint,attends:array<struct<begin:bigint,end:bigint>>>"
SCHEMA = f"pack string, ids binary, positions binary, nodes array<{_NODE}>, leaves array<struct<conv_id:bigint,node:int>>"
_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_NODES = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("parent", pa.int32()), ("role", pa.string()), ("loss_begin", pa.int64()), ("loss_end", pa.int64()), ("attends", pa.list_(_SPAN))]))
_LEAVES = pa.list_(pa.struct([("conv_id", pa.int64()), ("node", pa.int32())]))


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def written(role: str, text: str) -> tuple[str, str, str]:
    """What the template puts before, in and after a turn."""
    if role in MARKS:
        before, after = MARKS[role]
        return before, escape(text), after
    before, after = MARKS["user"]
    return f"[ROLE] {escape(role)} [/ROLE]{before}", escape(text), after


def read(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError("not written by this template")
        kind = next(k for k in MARKS if m[k] is not None)
        out.append((kind if m["role"] is None else unescape(m["role"]), unescape(m[kind])))
        at = m.end()
    return out


class Pack:
    """A prefix tree that grows by conversations in sorted order."""

    def __init__(self, encoder):
        self.encoder = encoder
        self.ids, self.positions, self.nodes, self.leaves, self.size = [], [], [], [], 0
        # the last conversation: turn, node, tokens up to its end, and spans up to its end as (end, begin, spans before)
        self.path: list[tuple[tuple[str, str], int, int, tuple | None]] = []

    def add(self, conv_id: int | None, turns: list[tuple[str, str]]) -> None:
        shared = 0
        while shared < min(len(turns), len(self.path)) and self.path[shared][0] == turns[shared]:
            shared += 1
        del self.path[shared:]
        for turn in turns[shared:]:
            self._grow(*turn)
        self.leaves.append({"conv_id": conv_id, "node": self.path[-1][1] if self.path else -1})

    def _grow(self, role: str, text: str) -> None:
        """A node below the path's end, and one step more of the path; costs its own tokens and spans, not the path's."""
        parts = [self.encoder(p) for p in written(role, text)]
        parent, depth, above = self.path[-1][1:] if self.path else (-1, 0, None)
        begin, sizes = self.size, [len(p) // 4 for p in parts]
        self.ids += parts
        self.positions.append(np.arange(depth, depth + sum(sizes), dtype="<u4").tobytes())
        self.size += sum(sizes)
        loss = (begin + sizes[0], begin + sizes[0] + sizes[1]) if role == "assistant" else (begin, begin)
        attends, s = [], above
        while s is not None:
            attends.append({"begin": s[1], "end": s[0]})
            s = s[2]
        self.nodes.append({"begin": begin, "end": self.size, "parent": parent, "role": role, "loss_begin": loss[0], "loss_end": loss[1], "attends": attends[::-1]})
        joined = (self.size, above[1], above[2]) if above is not None and above[0] == begin else (self.size, begin, above)
        self.path.append(((role, text), len(self.nodes) - 1, depth + sum(sizes), joined))

    def row(self) -> pa.RecordBatch:
        ids = b"".join(self.ids)
        name = hashlib.md5(ids + repr([x["conv_id"] for x in self.leaves]).encode()).hexdigest()
        arrays = [pa.array([name]), pa.array([ids], pa.binary()), pa.array([b"".join(self.positions)], pa.binary()), pa.array([self.nodes], _NODES), pa.array([self.leaves], _LEAVES)]
        return pa.RecordBatch.from_arrays(arrays, ["pack", "ids", "positions", "nodes", "leaves"])


def pack_conversations(rows: DataFrame, tokenizer: str) -> DataFrame:
    """Packs (SCHEMA) of a table with a row for each turn: conv_id, turn, role, text."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = whole.withColumn("path", F.array_join(F.transform("turns", lambda t: F.md5(F.concat_ws("\n", t["role"], t["text"]))), ""))
    whole = whole.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")

    def run(batches):
        encoder = codec(tokenizer).encode_plain
        pack = Pack(encoder)
        for batch in batches:
            for conv_id, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if pack.size >= MAX_TOKENS or len(pack.leaves) >= MAX_LEAVES:
                    yield pack.row()
                    pack = Pack(encoder)
                pack.add(conv_id, [(t["role"], t["text"]) for t in turns])
        if pack.leaves:
            yield pack.row()

    return in_arrow(whole.select("conv_id", "turns"), run, SCHEMA, ("bpe codec", tokenizer))


def read_back(packs: DataFrame, tokenizer: str) -> DataFrame:
    """conv_id, turns, loss_text and formatted of every conversation, decoded from its path through its pack."""

    def run(batches):
        decode = codec(tokenizer).decode
        for batch in batches:
            for ids, nodes, leaves in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                text = [decode(ids[4 * n["begin"] : 4 * n["end"]]) for n in nodes]
                loss = [unescape(decode(ids[4 * n["loss_begin"] : 4 * n["loss_end"]])) for n in nodes]
                for at in range(0, len(leaves), 64):
                    out = []
                    for leaf in leaves[at : at + 64]:
                        path, n = [], leaf["node"]
                        while n >= 0:
                            path.append(n)
                            n = nodes[n]["parent"]
                        formatted = "".join(text[n] for n in reversed(path))
                        out.append((leaf["conv_id"], [{"role": r, "text": t} for r, t in read(formatted)], "".join(loss[n] for n in reversed(path)), formatted))
                    kinds = (pa.int64(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], ["conv_id", "turns", "loss_text", "formatted"])

    schema = "conv_id bigint, turns array<struct<role:string,text:string>>, loss_text string, formatted string"
    return in_arrow(packs.select("ids", "nodes", "leaves"), run, schema, ("bpe codec", tokenizer))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vocabularies import path

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema))
    tokenizer = path("byte_bpe_50k.json")
    back = read_back(pack_conversations(rows, tokenizer), tokenizer)
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
