import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from marquee.llm import prefix_trie as p

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20)), [])[:h] + turns[h:]
    return out


def plain(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    total = {}
    for path in sorted(members, key=len, reverse=True):
        saved = (len(members[path]) - 1) * (len(path[-1][1].split()) if path else 0)
        below = [total[k] for k in children[path]]
        total[path] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    return sorted((
        members[path][0], len(path), -1 if not path else members[path[:-1]][0], len(members[path]), len(children[path]), *total[path],
        hashlib.sha256(",".join(str(c) for c in members[path] if len(convs[c]) == len(path)).encode()).hexdigest()) for path in members)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in p.prefix_trie(frame).select(columns).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 400), 150):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, t or None, rng.choice(["user", None]), rng.choice(["a b", "a  b", "", None, "ü\tx y", "one"])))
    rows += [(10_000 + i, t, "user", "hello there") for i in range(60) for t in range(4)]  # one large group of equal conversations
    rows += [(20_000, t, "user", f"turn {t % 7}") for t in range(150)] + [(None, 1, "user", "nobody")]
    assert found(spark, rows) == plain(rows)


def test_repeated_rows_ties_and_empty(spark):
    rows = [(1, 0, "user", "x y")] * 2 + [(2, 0, "user", "x y"), (2, 0, "bot", "z")]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []
    assert found(spark, [(5, None, None, None)]) == plain([(5, None, None, None)])


def turns(*names):
    return [(n.encode().ljust(16, b"."), 2) for n in names]


def test_shard_children_counts_and_ends():
    shard = p.Shard([3, 5, 8, 9], [turns("a", "b"), turns("a"), turns("a", "c"), turns()])
    seen = [(len(path) - 1, bits) for path, bits, _ in shard.nodes()]
    assert seen == [(0, 0b1111), (1, 0b0111), (2, 0b0001), (2, 0b0100)]
    parts = [(depth, least, n, ends) for _, _, _, depth, least, n, _, ends in shard.parts()]
    assert parts == [(0, 3, 4, [9]), (1, 3, 3, [5]), (2, 3, 1, [3]), (2, 8, 1, [8])]


def test_shards_and_pieces_of_end_lists(monkeypatch):
    ids = list(range(100, 160))
    whole = p.Shard(ids, [turns("a")] * 60)
    monkeypatch.setattr(p, "ENDS", 7)
    pieces = [part for part in whole.parts() if part[3] == 1]
    assert [i for part in pieces for i in part[7]] == ids and sum(part[5] for part in pieces) == 60
    batch = p.pa.RecordBatch.from_pydict({"conv_id": ids, "turns": [[{"digest": d, "words": w} for d, w in turns("a")]] * 60})
    monkeypatch.setattr(p, "MEMBERS", 16)
    rows = [r for b in p._index([batch]) for r in b.to_pylist() if r["depth"] == 1]
    assert sorted(i for r in rows for i in r["ends"]) == ids and len({r["key"] for r in rows}) == 1
    lists = p.pa.RecordBatch.from_pydict({"key": [r["key"] for r in rows], "ends": [r["ends"] for r in rows]})
    digests = [r for b in p._digests([lists.slice(0, 2), lists.slice(2)]) for r in b.to_pylist()]
    assert [r["ends_sha256"] for r in digests] == [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()]
