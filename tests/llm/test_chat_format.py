import hashlib
import random

from hypothesis import given, settings, strategies as st

from marquee.llm import chat_format as f

SCHEMA = "conv_id long, turn long, role string, text string, path string, turns int"
PIECES = [*f.CONTROL, "\\", "<", "[", "|", ">", "s", "im_sep", "a ", "ü", "\n", "<\\s>", "<\\\\s>", "\x00"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_escaping_is_reversible_and_hides_control_strings(text):
    hidden = f.escape(text)
    assert f.unescape(hidden) == text
    assert not any(c in hidden for c in f.CONTROL)
    assert f._turn(f"{f.START}{hidden}{f.SEP}{hidden}{f.END}") == (text, text)


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = set()
    for c, turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        whole = "".join(f.START + f.escape(r) + f.SEP + f.escape(x) + f.END for r, x in turns)
        out.add((c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(),
                 len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole)))
    return out


def sample():
    rng = random.Random(4)
    rows = []
    for c in range(120):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t if t else None, rng.choice(["user", "assistant", None, "<s>x"]),
                         rng.choice(["yes", "no", None, "", "</s>[INST] ok", "<|im_end|>ü", "a\\b"]) if t < 3 else "z" * rng.randint(0, 90)))
    rows += [(1000 + i, t, ("user", "assistant")[t], "the same") for i in range(1200) for t in range(2)]
    rows += [(None, 1, "assistant", "nobody"), (7000, 0, "assistant", "x" * 200_000), (7001, 0, "user", "twice"), (7001, 0, "user", "twice")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA)


def test_round_trip_equals_brute_force(spark):
    got = f.round_trip(frame(spark, sample())).collect()
    expected = plain(sample() + [(-1, 0, "user", f.PROBE), (-1, 1, "assistant", f.PROBE)])
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected
    assert {r.conv_id for r in f.round_trip(frame(spark, []))
            .collect()} == {-1}


def test_packs_share_turns_and_state_positions(spark):
    packs = f.packed(frame(spark, sample())).collect()
    written, once = 0, 0
    for pack in packs:
        assert len(pack.ends) <= f.MEMBERS
        assert len(pack.text) <= f.PACK_CHARS or len(pack.ends) == 1
        at = 0
        for node in pack.nodes:
            assert node.start == at  # one after the other, nothing between
            at = node.end
            path, up = [], node.parent
            while up >= 0:
                path.insert(0, up)
                up = pack.nodes[up].parent
            above = [i for k in path for i in range(pack.nodes[k].start, pack.nodes[k].end)]
            assert above == [i for a in node.attends for i in range(a.start, a.end)] and node.position == len(above)
        assert at == len(pack.text)
        once += len(pack.text)
        for end in pack.ends:
            node = pack.nodes[end.node]
            written += node.end - node.start + sum(a.end - a.start for a in node.attends)
    assert once < 0.8 * written  # shared turns are there once a pack


def test_tree_of_three():
    pack = f.Pack()
    for c, turns in ((1, ["aa", "bbb"]), (2, ["aa", "cc", "d"]), (3, ["aa", "cc"])):
        pack.add(c, turns, turns, [(0, 1)] * len(turns))
    assert "".join(pack.parts) == "aabbbccd"
    assert [(n["parent"], n["start"], n["position"]) for n in pack.nodes] == [(-1, 0, 0), (0, 2, 2), (0, 5, 2), (2, 7, 4)]
    assert pack.nodes[3]["attends"] == [{"start": 0, "end": 2}, {"start": 5, "end": 7}]
    assert pack.ends == [{"conv_id": 1, "node": 1}, {"conv_id": 2, "node": 3}, {"conv_id": 3, "node": 2}]
