import random

import pytest

from marquee.llm import decontaminate as d


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(60)] + [f"rare{i}" for i in range(600)]
    weights = [30] * 60 + [1] * 600

    def prose(n):
        return " ".join(rng.choices(vocab, weights, k=n))
    items = [(i, ". ".join(prose(rng.randint(4, 30)).capitalize() for _ in range(rng.randint(1, 4))) + ".") for i in range(70)]
    items += [(70, prose(200)), (71, "Which one? That one here."), (72, "single"), (73, ""), (74, None)]
    docs = []
    for i in range(120):
        text = prose(rng.randint(0, 400))
        for _ in range(rng.choice((0, 0, 1, 2))):
            words = (rng.choice(items[:71])[1]).split()
            if rng.random() < 0.3:
                words[rng.randrange(len(words))] = "changed"
            if rng.random() < 0.2:
                words = words[:len(words) // 2]
            text += "\n" + " ".join(words).upper() + " " + prose(rng.randint(0, 90))
        docs.append((i, text))
    return docs, items


def scores(index, words):
    """BM25 of a passage against every segment, term by term."""
    out = [0.0] * len(index.owner)
    for t in {index.ids[w] for w in zip(words, words[1:]) if w in index.ids}:
        for s, x in zip(index.segments[t], index.impacts[t]):
            out[s] += x
    return out


def test_wand_retrieves_all_above_the_threshold():
    docs, items = corpus()
    index = d.Index([x for x in items if x[1]])
    for _, text in docs:
        words = d.terms_of(text)
        expected = {}
        for i in range(0, max(1, len(words)), d.STRIDE):
            # The pair that begins at the last word of a passage belongs to it.
            window = words[i:i + 2 * d.STRIDE + 1]
            for s, x in enumerate(scores(index, window)):
                if x >= d.THRESHOLD:
                    expected[index.owner[s]] = max(x, expected.get(index.owner[s], 0))
            terms = sorted({index.ids[w] for w in zip(window, window[1:]) if w in index.ids})
            assert {s for s, _ in index.search(terms, 0.1)} == {s for s, x in enumerate(scores(index, window)) if x >= 0.1}
        got = {item: x for (_, item), x in index.retrieve([words]).items()}
        assert got.keys() == expected.keys()
        assert all(abs(got[k] - expected[k]) < 1e-6 for k in got)


def brute(docs, items):
    """Every item against every document by overlap alone."""
    found = set()
    for i, text in docs:
        words = d.terms_of(text or "")
        for j, item in items:
            if item:
                shares = []
                for part in d.question_and_answer(item):
                    own = d.shingles(part)
                    held = {tuple(words[k:k + len(s)]) for s in list(own)[:1] for k in range(len(words))}
                    shares.append(len(own & held) / len(own) if own else 1)
                if min(shares) >= d.MIN_OVERLAP:
                    found.add((i, j))
    return found


@pytest.mark.parametrize("size", [4 << 20, 4000])
def test_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(d, "INDEX_BYTES", size)
    docs, items = corpus(2)
    rows = spark.createDataFrame([(i, t, 1.0) for i, t in docs] + [(900, None, None), (901, "", None)], "doc_id long, text string, score double")
    bench = spark.createDataFrame([(*x, "x") for x in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in d.leaks(rows, bench).collect()}
    assert got == brute(docs, items) and len(got) > 30
    kept = {r.doc_id for r in d.decontaminate(rows, bench).collect()}
    assert kept == ({i for i, _ in docs} | {900, 901}) - {i for i, _ in got}


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, "say one two three four five six. Seven eight nine ten."), (1, "say one two three four five six. Seven eight nine ten.")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "One two three four five six. Seven eight nine ten.")] * 2, "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in d.leaks(docs, bench).collect()] == [(1, 5), (1, 5)]
    assert d.leaks(docs, bench.limit(0)).count() == 0 and d.leaks(docs.limit(0), bench).count() == 0
    assert d.decontaminate(docs, bench.limit(0)).count() == 2 and d.decontaminate(docs, bench).count() == 0


def test_near_and_partial_copies_of_plain_items(spark):
    """Without an answer mark the whole item counts; with one, both sides must be there."""
    rng = random.Random(7)

    def prose(k):
        return " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(k))
    plain = f"{prose(30)}. {prose(5)}."
    short = f"{prose(30)}. Ñ."
    marked = f"{prose(30)} answer: {prose(5)}"
    changed = plain.split()
    changed[-2] = "changed"
    docs = [(1, plain), (2, " ".join(changed)), (3, " ".join(plain.split()[:28])), (4, " ".join(plain.split()[:12])),
            (5, " ".join(short.split()[:-1])), (6, marked), (7, " ".join(marked.split()[:30])), (8, prose(60))]
    docs = spark.createDataFrame([(i, f"{prose(70)} {t} {prose(70)}") for i, t in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(1, plain), (2, short), (3, marked)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.answer_overlap for r in d.leaks(docs, bench).collect()}
    assert got == {(1, 1): None, (2, 1): None, (3, 1): None, (5, 2): None, (6, 3): 1.0}
    assert {r.doc_id for r in d.decontaminate(docs, bench).collect()} == {4, 7, 8}


def test_scores_do_not_depend_on_the_size_of_an_index(spark, monkeypatch):
    docs, items = corpus(3)
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def found(size):
        monkeypatch.setattr(d, "INDEX_BYTES", size)
        return len(d.parts(bench)), {(r.doc_id, r.item_id): r.score for r in d.leaks(rows, bench).collect()}
    (one, whole), (many, cut) = found(4 << 20), found(3000)
    assert one == 1 and many > 3 and whole.keys() == cut.keys() and len(whole) > 30
    assert all(abs(whole[k] - cut[k]) < 1e-9 for k in whole)
    # And they are those of an index over all items.
    index = d.Index(sorted({x for x in items if x[1]}, key=str))
    plain = {}
    for i, text in docs:
        for number, item, score, *_ in index.leaks([text]):
            plain[i, item] = round(score, 9)
    assert plain.keys() == whole.keys() and all(abs(plain[k] - whole[k]) < 1e-8 for k in plain)


def test_texts_without_spaces_between_words(spark):
    item = "今天的天气非常好我们一起去公园散步然后回家吃晚饭"
    thai = "วันนี้อากาศดีมากเราไปเดินเล่นในสวนสาธารณะกัน"
    docs = [(1, f"前言前言{item}后记"), (2, item[:6] + "不同的内容在这里没有关系"), (3, f"abc {thai} def"), (4, "plain words only")]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, thai)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in d.leaks(rows, bench).collect()} == {(1, 1), (3, 2)}


def test_question_marks():
    q, a = d.question_and_answer("Ann has 3. How many are left? 72")
    assert a == ["72"] and q[-1] == "left"
    prose = "They came. Why? Nobody knew. The rain fell on. It stopped."
    assert d.question_and_answer(prose) == (d.terms_of(prose), [])
    assert d.question_and_answer("Why? Nobody. Answer: rain. Then sun.")[1] == ["rain", "then", "sun"]


def test_very_long_text(spark):
    leak = " ".join(f"k{i}" for i in range(60))
    docs = spark.createDataFrame([(1, "filler words " * 150_000 + leak + " filler words" * 150_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, leak)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in d.leaks(docs, bench).collect()] == [(1, 7)]
