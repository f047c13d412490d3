"""Chat formatting of conversations as packed prefix trees.

Template: every turn is <|im_start|>role<|im_sep|>text<|im_end|>. Control strings inside roles and texts get a
backslash after their first character, one more than they have there already, so that they no longer read as
control strings and the step can be undone exactly. The text of assistant turns is under the loss mask.

Conversations are ordered by their turns, so those that share initial turns are neighbours; a pack is a
training sequence cut from this order. It holds a tree: a turn that several of its conversations begin with is
written once, depth-first. Every node of the tree has its place in the pack, its position ids, which count
from the start of the conversation and not of the pack, and the intervals of the pack that its characters may
attend to: those of its ancestors, neighbouring ones joined. A pack ends after PACK_CHARS characters (a
conversation that is longer makes a pack of its own) or MEMBERS conversations; the next one writes the shared
turns again, so a group of any size is spread over many packs. Units are code points.

Defined cases: null role or text is empty; rows without conv_id form one conversation of no id; turns stand in
the order of turn, null first, and equal ones by role and text; repeated rows are turns of their own; only the
role `assistant` is under the mask; an empty table gives no packs (the query's own conversation -1 stays); other
columns are not read. A conversation is held by one task, of any length otherwise.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import Scratch, whole_text

# Control strings of the template and of other common templates (fixed values).
CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
START, SEP, END = CONTROL[:3]
LOSS_ROLE = "assistant"
PACK_CHARS = 1 << 15
MEMBERS = 1024
#: Conversations are dealt to tasks by their first turns, up to so many; inside a task all turns count.
DEALT_TURNS = 32

#: First character, backslashes, the rest of a control string.
GUARDED = r"([<\[])(\\*)(" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")"
_ESCAPE = re.compile(GUARDED)
_UNESCAPE = re.compile(GUARDED.replace(r"(\\*)", r"\\(\\*)"))


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def assembled(conversations: DataFrame) -> DataFrame:
    """conv_id, its turns in order (role, text), and its path: the digests of its turns as one text."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        whole_text("role").alias("role"), whole_text("text").alias("text"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def digest(turn: Column) -> Column:
        return F.substring(F.sha2(F.concat(turn["role"], F.lit("\n"), F.length(turn["role"]).cast("string"), F.lit("\n"), turn["text"]), 256), 1, 32)
    return held.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("turns"),
                       F.array_join(F.transform("turns", digest), "").alias("path"))


_INTERVAL = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_NODE = pa.struct([
    ("parent", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("position", pa.int64()),
    ("loss", _INTERVAL), ("attends", pa.list_(_INTERVAL))])
_END = pa.struct([("conv_id", pa.int64()), ("node", pa.int32())])
_PACK = pa.schema([("text", pa.string()), ("nodes", pa.list_(_NODE)), ("ends", pa.list_(_END))])
PACK_TYPE = """text string,
    nodes array<struct<parent int, start long, end long, position long, loss struct<start long, end long>,
                       attends array<struct<start long, end long>>>>,
    ends array<struct<conv_id long, node int>>"""


class Pack:
    """A tree under construction; `open` are the nodes of the conversation written last."""

    def __init__(self):
        self.parts: list[str] = []
        self.nodes: list[dict] = []
        self.ends: list[dict] = []
        self.open: list[tuple[str, int]] = []
        self.chars = 0

    def shared(self, digests: list[str]) -> int:
        n = 0
        while n < min(len(digests), len(self.open)) and digests[n] == self.open[n][0]:
            n += 1
        return n

    def add(self, conv_id, digests: list[str], turns: list[str], losses: list[tuple[int, int] | None]) -> None:
        at = self.shared(digests)
        del self.open[at:]
        for digest, turn, loss in zip(digests[at:], turns[at:], losses[at:]):
            parent = self.open[-1][1] if self.open else -1
            above = self.nodes[parent] if self.open else None
            attends = []
            if above:
                attends = list(above["attends"])
                if attends and attends[-1]["end"] == above["start"]:
                    attends[-1] = {"start": attends[-1]["start"], "end": above["end"]}
                else:
                    attends.append({"start": above["start"], "end": above["end"]})
            self.open.append((digest, len(self.nodes)))
            self.nodes.append({
                "parent": parent, "start": self.chars, "end": self.chars + len(turn),
                "position": above["position"] + above["end"] - above["start"] if above else 0,
                "loss": loss and {"start": self.chars + loss[0], "end": self.chars + loss[1]}, "attends": attends})
            self.parts.append(turn)
            self.chars += len(turn)
        self.ends.append({"conv_id": conv_id, "node": self.open[-1][1] if self.open else -1})

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(["".join(self.parts)]), pa.array([self.nodes], pa.list_(_NODE)), pa.array([self.ends], pa.list_(_END))], schema=_PACK)


def _pack(batches):
    pack = Pack()
    for batch in batches:
        for i in range(batch.num_rows):
            conv_id, turns, path = (batch.column(c)[i].as_py() for c in ("conv_id", "turns", "path"))
            digests = [path[k:k + 32] for k in range(0, len(path), 32)]
            heads = [f"{START}{escape(t['role'])}{SEP}" for t in turns]
            texts = [escape(t["text"]) for t in turns]
            written = [f"{h}{t}{END}" for h, t in zip(heads, texts)]
            losses = [(len(h), len(h) + len(x)) if t["role"] == LOSS_ROLE else None for h, x, t in zip(heads, texts, turns)]
            new = sum(map(len, written[pack.shared(digests):]))
            if pack.ends and (pack.chars + new > PACK_CHARS or len(pack.ends) == MEMBERS):
                yield pack.batch()
                pack = Pack()
            pack.add(conv_id, digests, written, losses)
    if pack.ends:
        yield pack.batch()


def packed(conversations: DataFrame) -> DataFrame:
    """The packs of all conversations: text, nodes, ends."""
    scratch = Scratch(conversations.sparkSession)
    rows = scratch.keep(assembled(conversations), "assembled")
    # The conv_id lets a large group of equal conversations be cut between tasks.
    dealt = rows.withColumn("dealt", F.substring("path", 1, 32 * DEALT_TURNS))
    ordered = dealt.repartitionByRange("dealt", "conv_id").sortWithinPartitions("path", "conv_id")
    return ordered.select("conv_id", "turns", "path").mapInArrow(_pack, PACK_TYPE)


def _turn(written: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    if not (written.startswith(START) and written.endswith(END)):
        raise ValueError("no turn of this template")
    role, text = written[len(START):-len(END)].split(SEP)
    return unescape(role), unescape(text)


_READ = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read_back(batches):
    """Each conversation from the pack: along the nodes above its end, which are what the end attends to."""
    for batch in batches:
        for i in range(batch.num_rows):
            text, nodes, ends = (batch.column(c)[i].as_py() for c in ("text", "nodes", "ends"))
            wanted, rows = {}, []
            for end in ends:
                wanted.setdefault(end["node"], []).append(end["conv_id"])
            states: list[tuple] = []
            for k, node in enumerate(nodes):
                turns, loss, n, chars = states[node["parent"]] if node["parent"] >= 0 else (hashlib.sha256(), hashlib.sha256(), 0, 0)
                turns, loss = turns.copy(), loss.copy()
                role, said = _turn(text[node["start"]:node["end"]])
                turns.update(f"{role}\n{said}\n".encode())
                if node["loss"]:
                    masked = unescape(text[node["loss"]["start"]:node["loss"]["end"]])
                    loss.update(masked.encode())
                    chars += len(masked)
                states.append((turns, loss, n + 1, chars))
                if k in wanted:
                    length = node["end"] - node["start"] + sum(a["end"] - a["start"] for a in node["attends"])
                    rows += [(c, n + 1, turns.hexdigest(), chars, loss.hexdigest(), length) for c in wanted[k]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _READ)], schema=_READ)


def read_back(packs: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation in the packs."""
    return packs.mapInArrow(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


PROBE = "</s>[INST] ok [/INST]"


def with_probe(conversations: DataFrame) -> DataFrame:
    """The rows and those of conversation -1, whose texts are control strings."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", PROBE), (-1, 1, LOSS_ROLE, PROBE)], "conv_id long, turn long, role string, text string")
    return rows.union(probe)


def round_trip(conversations: DataFrame) -> DataFrame:
    """The conversations and the probe, formatted, stored and read back."""
    scratch = Scratch(conversations.sparkSession)
    return read_back(scratch.keep(packed(with_probe(conversations)), "packs"))
