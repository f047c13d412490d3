"""Byte-pair encoding and decoding with a lexicon of frequent words in a minimal acyclic transducer.

Spark counts the words of all documents; the most frequent ones, with their ids, are compiled into an
automaton that shares prefixes and suffixes, whose path outputs add up to the number of a word and so
to its ids. The file is handed to every executor and mapped into memory there. A word that it lacks is
merged exactly, pair by pair in rank order. The lexicon only saves time: results do not depend on it,
nor on its size.

The tokenizer file is read on the driver and must be a BPE model with word ends behind a byte-level
split, lower case and NFC, as `word_bpe_49k.json` is. Its size, and that of the lexicon, are bounded.

Defined cases: a null text is the empty text and has no ids; names of special tokens inside a text are
those tokens, as the tokenizer file says; lone surrogates cannot occur in Spark strings; repeated rows
give repeated results; an empty table gives an empty result. Extra columns stay as they are, but for
those that are named like a result, which the result replaces.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import unicodedata
import uuid
from array import array
from collections import Counter

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import Scratch, sliced, whole_text

#: So many of the most frequent words go into the lexicon.
LEXICON_WORDS = 1 << 18
#: So many words a task remembers before it starts anew.
REMEMBERED = 300_000
LONG = 48
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same for texts of Latin letters and usual signs, which the standard library splits faster.
LATIN = "a-zªµºÀ-ÖØ-öø-ɏ"
LATIN_NUMBERS = "0-9²³¹¼-¾"
LATIN_SPLIT = re.compile(rf"[{LATIN}]+|'(?:s|t|re|ve|m|ll|d)|[{LATIN_NUMBERS}]|[^\s{LATIN}{LATIN_NUMBERS}]+")
NOT_LATIN = re.compile("[^\u0000-\u001b\u0020-\u0084\u0086-\u024f‐-‧]")
# Outside these blocks a character may be newer than Python's tables; such texts take the slow way.
MAYBE_NEW = re.compile("[^\u0000-ͷЀ-ԯḀ-ỿ‐-‧ぁ-ゖ一-鿿가-힣]")


def byte_signs() -> list[str]:
    """The printable sign of each byte value in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in signs:
            signs[b] = chr(256 + len(signs) - len(plain))
    return [signs[b] for b in range(256)]


class Model:
    """Vocabulary and merges; small, and sent with the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>":
            raise ValueError("a BPE model with word ends is needed")
        self.vocab = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in data["added_tokens"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.tokens = {i: t for t, i in (self.vocab | self.specials).items()}
        self.texts = {i: str(i) for i in self.tokens}
        self.signs = byte_signs()

    def merged(self, word: str) -> list[int]:
        """The ids of one word: the adjacent pair of lowest rank, leftmost first, is merged until none is left."""
        parts = [self.signs[b] for b in word.encode("utf-8")]
        parts[-1] += "</w>"
        parts = self._short(parts) if len(parts) <= LONG else self._long(parts)
        return [self.vocab[p] for p in parts]

    def _short(self, parts: list[str]) -> list[str]:
        rank, none = self.ranks.get, len(self.ranks)
        found = [rank(p, none) for p in zip(parts, parts[1:])]
        while found:
            best = min(found)
            if best == none:
                break
            i = found.index(best)
            whole = parts[i] = parts[i] + parts.pop(i + 1)
            del found[i]
            if i:
                found[i - 1] = rank((parts[i - 1], whole), none)
            if i < len(found):
                found[i] = rank((whole, parts[i + 1]), none)
        return parts

    def _long(self, parts: list[str]) -> list[str]:
        """The same with a heap over a linked list, for words of any length."""
        size = len(parts)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i) for i, p in enumerate(zip(parts, parts[1:])) if (r := self.ranks.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= size or self.ranks.get((parts[i], parts[j])) != r:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < size and (s := self.ranks.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (s, a))
        return [p for p in parts if p is not None]


def compile_lexicon(entries: list[tuple[bytes, list[int]]]) -> bytes:
    """The file of a minimal acyclic transducer: words in byte order, each with its ids.

    States are made final in order of their words, equal ones are shared (so suffixes are), and the
    outputs along a path add up to the number of words before this one.
    """
    known: dict[tuple, int] = {}
    counts, states = array("I"), []

    def settle(node) -> int:
        key = (node[0], tuple((c, n) for c, n in node[1]))
        at = known.get(key)
        if at is None:
            at = known[key] = len(states)
            states.append(key)
            counts.append(key[0] + sum(counts[n] for _, n in key[1]))
        return at

    path = [[False, []]]
    last = b""
    for word, _ in entries:
        same = len(os.path.commonprefix((last, word)))
        while len(path) > same + 1:
            done = settle(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        path += [[False, []] for _ in range(len(word) - same)]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        done = settle(path.pop())
        path[-1][1].append((last[len(path) - 1], done))
    root = settle(path[0])
    first, final, label, target, skip = array("I", [0]), bytearray(), bytearray(), array("I"), array("I")
    for is_final, edges in states:
        passed = int(is_final)
        for c, n in edges:
            label.append(c)
            target.append(n)
            skip.append(passed)
            passed += counts[n]
        final.append(is_final)
        first.append(len(label))
    start, ids = array("I", [0]), array("I")
    for _, own in entries:
        ids.extend(own)
        start.append(len(ids))
    head = array("I", [root, len(states), len(label), len(entries), len(ids)])
    return b"".join(x.tobytes() for x in (head, first, target, skip, start, ids)) + bytes(label) + bytes(final)


class Lexicon:
    """A compiled lexicon, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self.data)
        self.root, states, edges, entries, ids = view[:20].cast("I")
        at, parts = 20, []
        for n in (states + 1, edges, edges, entries + 1, ids):
            parts.append(view[at:at + 4 * n].cast("I"))
            at += 4 * n
        self.first, self.target, self.skip, self.start, self.ids = parts
        self.label, self.final = at, at + edges

    def get(self, word: bytes) -> list[int] | None:
        state, number, base = self.root, 0, self.label
        find, first, target, skip = self.data.find, self.first, self.target, self.skip
        for i in range(len(word)):
            at = find(word[i:i + 1], base + first[state], base + first[state + 1])
            if at < 0:
                return None
            number += skip[at - base]
            state = target[at - base]
        if not self.data[self.final + state]:
            return None
        return self.ids[self.start[number]:self.start[number + 1]].tolist()


class Splitter:
    """Texts to words, as the normaliser and the splitter of the tokenizer file do it."""

    def __init__(self, specials):
        self.pattern = regex.compile(SPLIT)
        self.specials = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self.slow = None

    def words(self, text: str) -> list[str]:
        if not NOT_LATIN.search(text):
            lower = text.lower() if text.isascii() else unicodedata.normalize("NFC", text).lower()
            if not NOT_LATIN.search(lower):
                return LATIN_SPLIT.findall(lower)
        if MAYBE_NEW.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            return self._newer(text)
        # Lower case goes sign by sign there, so the final form of sigma must not come in.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.pattern.findall(text.lower())

    def _newer(self, text: str) -> list[str]:
        """Signs that Python's tables do not know yet: normalised and split by the tokenizers library."""
        from tokenizers import Regex, normalizers, pre_tokenizers

        if self.slow is None:
            self.slow = (normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()]),
                         pre_tokenizers.Split(Regex(SPLIT), "removed", invert=True))
        return [w for w, _ in self.slow[1].pre_tokenize_str(self.slow[0].normalize_str(text))]

    def parts(self, text: str) -> list[str]:
        """Words and names of special tokens, in order."""
        if self.specials and "<" in text:
            pieces = self.specials.split(text)
            return [w for i, p in enumerate(pieces) for w in ([p] if i % 2 else self.words(p))]
        return self.words(text)


class Codec(dict):
    """Encodes and decodes. As a dictionary it remembers, for each word, its ids and its tokens as text."""

    def __init__(self, model: Model, lexicon: Lexicon | None):
        super().__init__()
        self.model, self.lexicon = model, lexicon
        self.split = Splitter(model.specials)
        # A special token is never the result of the splitter: that breaks it into its signs.
        self.special = {w: [i] for w, i in model.specials.items()}

    def ids(self, word: str) -> list[int]:
        found = self.special.get(word) or (self.lexicon and self.lexicon.get(word.encode("utf-8")))
        return found or self.model.merged(word)

    def __missing__(self, word: str) -> tuple[str, str]:
        ids = self.ids(word)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(ids) == 1:
            made = self[word] = (self.model.texts[ids[0]], self.model.tokens[ids[0]])
        else:
            made = self[word] = (" ".join(map(self.model.texts.__getitem__, ids)), self.decode(ids))
        return made

    def encode(self, text: str) -> list[int]:
        return [i for w in self.split.parts(text) for i in map(int, self[w][0].split(" "))]

    def decode(self, ids) -> str:
        return " ".join(map(self.model.tokens.__getitem__, ids))


def _count_words(model: Model):
    def count(batches):
        split = Splitter(model.specials)
        total = Counter()
        for batch in sliced(batches):
            for text in batch.column(0).to_pylist():
                total.update(split.words(text))
            if len(total) >= REMEMBERED:
                yield pa.RecordBatch.from_pydict({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})
                total = Counter()
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(total.keys()), pa.string()), "n": pa.array(list(total.values()), pa.int64())})
    return count


def frequent_words(docs: DataFrame, model: Model, size: int = LEXICON_WORDS) -> DataFrame:
    """word, ids of the most frequent words of all documents, `size` at most and equally frequent ones
    together. Words are counted and chosen where they are; only a histogram comes to the driver."""
    def encode(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"word": batch.column(0), "ids": pa.array(
                [model.merged(w) for w in batch.column(0).to_pylist()], pa.list_(pa.int32()))})

    scratch = Scratch(docs.sparkSession)
    counted = docs.select(whole_text().alias("t")).mapInArrow(_count_words(model), "word string, n long")
    counted = scratch.keep(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # The least frequency, on a scale of eighths of powers of two, at which the words are few enough.
    level = F.floor(F.log2("n") * 8)
    words, least = 0, None
    for k, n in counted.groupBy(level).count().orderBy(F.desc(level)).collect():
        if words + n > size:
            break
        words, least = words + n, k
    return counted.where(F.lit(False) if least is None else level >= least).select("word").mapInArrow(
        encode, "word string, ids array<int>")


def publish_lexicon(docs: DataFrame, model: Model, size: int = LEXICON_WORDS) -> str:
    """Compile the lexicon and hand it to all executors; returns the name of the file there."""
    rows = frequent_words(docs, model, size).toArrow()
    entries = sorted(zip((w.encode("utf-8") for w in rows.column(0).to_pylist()), rows.column(1).to_pylist()))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    docs.sparkSession.sparkContext.addFile(Scratch(docs.sparkSession).put(name, compile_lexicon(entries)))
    return name


def _encoder(model: Model, lexicon: str, with_ids: bool):
    def encode(batches):
        codec = Codec(model, Lexicon(SparkFiles.get(lexicon)))
        for batch in sliced(batches):
            counts, ids, digests, decoded = [], [], [], []
            for text in batch.column("_text").to_pylist():
                pairs = list(map(codec.__getitem__, codec.split.parts(text)))
                line = " ".join([p[0] for p in pairs])
                counts.append(line.count(" ") + 1 if line else 0)
                digests.append(hashlib.sha256(line.encode()).hexdigest())
                decoded.append(hashlib.sha256(" ".join([p[1] for p in pairs]).encode("utf-8")).hexdigest())
                if with_ids:
                    ids.append(array("i", map(int, line.split(" "))) if line else [])
            out = {n: batch.column(n) for n in batch.schema.names if n != "_text"}
            out |= {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(digests, pa.string()),
                    "decoded_sha256": pa.array(decoded, pa.string())}
            if with_ids:
                out["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)
    return encode


RESULTS = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


def encode(docs: DataFrame, path: str, columns: list[str], with_ids: bool = True, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """`columns` with n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids; whole texts."""
    model = Model(path)
    lexicon = publish_lexicon(docs, model, lexicon_words)
    results = RESULTS | ({"ids": "array<int>"} if with_ids else {})
    rows = docs.select(*[F.col(f"`{c}`") for c in columns if c not in results], whole_text().alias("_text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_text"]
    return rows.mapInArrow(_encoder(model, lexicon, with_ids), ", ".join(kinds + [f"{n} {k}" for n, k in results.items()]))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with `decoded`, the text of their ids."""
    tokens = Model(path).tokens

    def decoded(batches):
        for batch in batches:
            texts = [None if i is None else " ".join(map(tokens.__getitem__, i)) for i in batch.column(ids).to_pylist()]
            kept = {n: batch.column(n) for n in batch.schema.names if n != "decoded"}
            yield pa.RecordBatch.from_pydict(kept | {"decoded": pa.array(texts, pa.string())})
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name != "decoded"]
    return encoded.mapInArrow(decoded, ", ".join([*kinds, "decoded string"]))
