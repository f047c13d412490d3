"""The trie of conversations that share initial turns, by vertical bitmaps.

Conversations in the order of their ids are cut into shards of at most MEMBERS conversations. A shard numbers
its conversations and keeps one bitset per (position, turn): which of them have this turn there. From the root,
whose bitset is full, a child is the intersection of its parent's bitset with the posting of a turn at the next
position; which posting to take is read off the lowest conversation that no child has yet, so a shard makes
exactly as many intersections as it has nodes. Popcounts are members, and the bits of conversations that end
at a node are its end list.

The parts of a node that lie in several shards meet by the node's key, a 128-bit hash of its turns, as sums,
least ids and end lists. An end list of any length is hashed as a stream of per-shard lists in the order of ids.
Sums over subtrees double their reach in every round: a node knows its ancestors 1, 2, 4, ... turns up, and adds
to the ancestor at that distance all that it has gathered itself. So a trie of depth d takes log2(d) rounds,
each an aggregate with map-side sums, and no list of ancestors is ever made for each node.

Turns are compared by a 128-bit digest of role and text; texts are never shuffled. A single conversation's
digests are held by one task.

Defined cases: rows without conv_id are left out; null role or text is empty; turns stand in the order of turn,
null first, and turns that are equal in that by role and digest; repeated rows are turns of their own; an empty
table gives no rows (no conversation, so no root); other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import Scratch, whole_text, words

#: A shard holds at most so many conversations, and about so many turns.
MEMBERS = 4096
TURNS = 1 << 16
#: An end list travels in pieces of so many ids.
ENDS = 50_000

_PARTS = pa.schema([
    ("key", pa.binary()), ("parent", pa.binary()), ("up", pa.list_(pa.binary())), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("words", pa.int64()), ("ends", pa.list_(pa.int64()))])
ROOT = b"\0" * 16


def assembled(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: (digest, words) of each."""
    role, text = whole_text("role"), whole_text("text")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.unhex(F.substring(F.sha2(F.concat(role, F.lit("\n"), F.length(role).cast("string"), F.lit("\n"), text), 256), 1, 32)).alias("digest"),
        F.size(words(text)).cast("long").alias("words"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "words")))
    return rows.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def shared_starts(whole: DataFrame, block: int = 20, starts: int = 4) -> DataFrame:
    """The conversations with their first h turns taken from the first of their block of ids: h is the
    unsigned crc32 of the decimal id, modulo `starts`."""
    own = whole.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % starts).cast("int")).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % block)
    heads = whole.select(F.col("conv_id").alias("base"), F.slice("turns", 1, starts - 1).alias("head"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


class Shard:
    """The vertical index of some conversations: ids ascending, one bit each."""

    def __init__(self, ids: list[int], turns: list[list[tuple[bytes, int]]]):
        self.ids, self.turns = ids, turns
        self.postings: dict[tuple[int, bytes], int] = {}
        self.ended: dict[int, int] = {}
        placed: dict[tuple[int, bytes], list[int]] = {}
        for bit, own in enumerate(turns):
            for position, (turn, _) in enumerate(own):
                placed.setdefault((position, turn), []).append(bit)
        for place, bits in placed.items():
            self.postings[place] = self._bitset(bits)
        last: dict[int, list[int]] = {}
        for bit, own in enumerate(turns):
            last.setdefault(len(own), []).append(bit)
        self.ended = {depth: self._bitset(bits) for depth, bits in last.items()}

    def _bitset(self, bits: list[int]) -> int:
        if len(bits) < 8:
            return sum(1 << b for b in bits)
        held = np.zeros(len(self.ids), np.uint8)
        held[bits] = 1
        return int.from_bytes(np.packbits(held, bitorder="little").tobytes(), "little")

    def members(self, bits: int) -> list[int]:
        if not bits:
            return []
        held = np.unpackbits(np.frombuffer(bits.to_bytes((len(self.ids) + 7) // 8, "little"), np.uint8), bitorder="little")
        return [self.ids[i] for i in np.flatnonzero(held)]

    def nodes(self):
        """(path of keys, bits, words of the last turn) of every node, depth-first."""
        full = (1 << len(self.ids)) - 1
        path: list[bytes] = []
        waiting = [(0, ROOT, full, 0)]
        while waiting:
            depth, key, bits, size = waiting.pop()
            del path[depth:]
            path.append(key)
            yield path, bits, size
            rest, children = bits & ~self.ended.get(depth, 0), []
            while rest:
                first = (rest & -rest).bit_length() - 1
                turn, size = self.turns[first][depth]
                child = rest & self.postings[depth, turn]
                children.append((depth + 1, hashlib.blake2b(key + turn, digest_size=16).digest(), child, size))
                rest &= ~child
            waiting.extend(reversed(children))

    def parts(self):
        """One record per node and piece of its end list; all but the first piece count no members."""
        for path, bits, size in self.nodes():
            depth = len(path) - 1
            up = [path[depth - (1 << k)] for k in range(depth.bit_length())]
            ends = self.members(bits & self.ended.get(depth, 0))
            least = self.ids[(bits & -bits).bit_length() - 1]
            for i in range(0, max(len(ends), 1), ENDS):
                yield path[-1], up[0] if up else None, up, depth, ends[i] if i else least, 0 if i else bits.bit_count(), size, ends[i:i + ENDS]


def _index(batches):
    out: list[tuple] = []

    def full(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARTS)], schema=_PARTS)

    def shards():
        ids, turns, held = [], [], 0
        for batch in batches:
            for i, own in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
                if ids and (len(ids) == MEMBERS or held + len(own) > TURNS):
                    yield Shard(ids, turns)
                    ids, turns, held = [], [], 0
                ids.append(i)
                turns.append([(t["digest"], t["words"]) for t in own])
                held += len(own)
        if ids:
            yield Shard(ids, turns)

    for shard in shards():
        for part in shard.parts():
            out.append(part)
            if len(out) >= 20_000:
                yield full(out)
                out = []
    if out:
        yield full(out)


def _digests(batches):
    """SHA-256 of each node's ids, read as a stream of pieces in order."""
    key, state = None, None
    for batch in batches:
        keys, states = [], []
        for own, ends in zip(batch.column("key").to_pylist(), batch.column("ends")):
            ids = ",".join(map(str, ends.values.to_numpy(zero_copy_only=False).tolist())).encode()
            if own == key:
                state.update(b"," + ids)
            else:
                if key is not None:
                    keys.append(key)
                    states.append(state.hexdigest())
                key, state = own, hashlib.sha256(ids)
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "ends_sha256": pa.array(states, pa.string())})
    if key is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends_sha256": pa.array([state.hexdigest()])})


def subtree_sums(scratch: Scratch, nodes: DataFrame, columns: list[str], deepest: int) -> DataFrame:
    """key and the sums of the columns over each node's subtree, itself included."""
    gathered, step, reach = nodes.select("key", "depth", "up", *columns), 0, 1
    while reach <= deepest:
        # What has been gathered within `reach` turns moves to the ancestor at that distance.
        moved = gathered.where(F.col("depth") >= reach).select(F.col("up")[step].alias("key"), *columns).groupBy("key").agg(
            *[F.sum(c).alias(f"_{c}") for c in columns])
        gathered = scratch.keep(gathered.join(moved, "key", "left").select(
            "key", "depth", "up", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in columns]), f"sums{step}")
        if step:
            scratch.drop(f"sums{step - 1}")
        step, reach = step + 1, reach * 2
    return gathered.select("key", *columns)


def trie(whole: DataFrame) -> DataFrame:
    """The nodes of the conversations (conv_id, turns as of `assembled`)."""
    scratch = Scratch(whole.sparkSession)
    stored = scratch.keep(whole, "whole")
    parts = scratch.keep(stored.repartitionByRange("conv_id").sortWithinPartitions("conv_id").mapInArrow(
        _index, "key binary, parent binary, up array<binary>, depth long, conv_id long, n_convs long, words long, ends array<long>"), "parts")
    # The path of a node is the same in all shards.
    nodes = parts.groupBy("key", "parent", "up", "depth", "words").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    nodes = scratch.keep(nodes, "nodes")
    lists = parts.where(F.size("ends") > 0).select("key", F.col("ends")[0].alias("first"), "ends")
    digests = lists.repartition("key").sortWithinPartitions("key", "first").select("key", "ends").mapInArrow(_digests, "key binary, ends_sha256 string")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    own = scratch.keep(nodes.join(children, "key", "left").select(
        "key", "parent", "up", "depth", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), "own")
    deepest = own.agg(F.max("depth")).first()[0] or 0
    sums = subtree_sums(scratch, own, ["n_leaves", "saved_tokens"], deepest)
    above = own.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return own.drop("n_leaves", "saved_tokens", "up").join(sums, "key").join(digests, "key", "left").join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per node of the
    conversations with shared starts."""
    scratch = Scratch(conversations.sparkSession)
    return trie(shared_starts(scratch.keep(assembled(conversations), "assembled")))
