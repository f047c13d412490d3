import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marquee.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \n", "Hello, world's 123 it'll BE fine!!", "ÉCOLE Ünïcödé é ﬁ ΑΣ ΣΑΣ İstanbul ǅ", "日本語 テスト 🙂👩‍👩‍👧",
    "a<|endoftext|>b <|startoftext|><|startoftext|> <|endoftext|", "x" * 5000 + "!" * 3000 + " ab" * 50,
    "Ᲊa Ɤ \U00010d50 ՘", "tabs\tand\x0bmore\x1c\x85 　end", "٣ ½ Ⅷ ²", "aaaa bbbb aaaaab", "'s 'S don't I'VE",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_equals_the_library(spark, library):
    rows = [(i, t, 5) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 5), (None, "again", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    for size in (0, 10, 1000):
        got = bpe.encode(docs, PATH, ["doc_id", "n_tokens"], lexicon_words=size).collect()
        texts = {i: t for i, t, _ in rows}
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, texts[r.doc_id]), (size, texts[r.doc_id])
            assert r.ids == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids


def test_round_trip(spark, library):
    docs = spark.createDataFrame([(1, "The cat sat."), (2, None)], "doc_id long, text string")
    rows = bpe.decode(bpe.encode(docs, PATH, ["doc_id", "text"]), PATH).collect()
    assert {r.doc_id: r.decoded for r in rows} == {1: "the</w> cat</w> sat</w> .</w>", 2: ""}
    assert bpe.encode(docs.limit(0), PATH, ["doc_id"]).count() == 0


def test_random_words_merge_exactly(library):
    codec = bpe.Codec(bpe.Model(PATH), None)
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("aethionsrñéß.!9 'x") for _ in range(rng.randint(1, 90)))
        ids = codec.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = sorted({f"{a}{b}{c}".encode() for a in "abc" for b in ("", "x", "yy") for c in ("ing", "ed", "é")})
    (tmp_path / "l").write_bytes(bpe.compile_lexicon([(w, [i, i + 1]) for i, w in enumerate(words)]))
    lexicon = bpe.Lexicon(str(tmp_path / "l"))
    assert [lexicon.get(w) for w in words] == [[i, i + 1] for i in range(len(words))]
    assert lexicon.get(b"ax") is None and lexicon.get(b"") is None and lexicon.get(b"aingx") is None
    assert len(lexicon.first) - 1 < 14  # the three first letters share all that follows
    (tmp_path / "e").write_bytes(bpe.compile_lexicon([]))
    assert bpe.Lexicon(str(tmp_path / "e")).get(b"a") is None


def test_latin_signs_split_alike(library):
    split = bpe.Splitter({})
    codec = bpe.Codec(bpe.Model(PATH), None)
    for c in [*range(0x300), *range(0x2000, 0x2030)]:
        text = f"a{chr(c)}B 1{chr(c)}2 {chr(c)}{chr(c)}'s"
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(c)
    assert split.words("Don't") == ["don", "'t"]
