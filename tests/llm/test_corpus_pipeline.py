import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marquee.llm import queries

SECRET = "0123456789abcdef" * 2


def documents():
    rng = random.Random(4)

    def line(k):
        return " ".join(f"{rng.choice('bcdfgh')}{rng.randrange(10 ** 6)}" for _ in range(k)) + "."
    rows = [(i, "\n".join(line(12) for _ in range(8)), "en", f"src{i % 7}") for i in range(40)]
    rows.append((40, rows[3][1], "en", "src0"))
    rows.append((41, rows[5][1].replace(".", ". extra", 1), "en", "src0"))
    rows.append((42, "too short", "en", "src1"))
    rows.append((43, "\n".join(" | ".join(line(1) for _ in range(9)) for _ in range(20)), "en", "src1"))
    rows.append((44, rows[7][1].replace("\n", f"\n{line(12)}\npassword = {SECRET} is a secret line here.\n{line(12)}\n", 1), "en", "src2"))
    rows.append((45, None, None, None))
    near = rows[9][1].split(" ")  # two changed words of 96: a similarity of 80.4 %
    rows.append((48, " ".join(f"other{i}" if i in (20, 60) else w for i, w in enumerate(near)), "en", "src5"))
    leak = line(12) + " " + line(8)
    rows.append((46, "\n".join(line(12) for _ in range(8)) + "\n" + leak, "en", "src3"))
    rows.append((47, "\n".join(line(12) for _ in range(8)) + f"\nThe token: {SECRET}aa is in this one line.", "fr", "src4"))
    return [(*r, len(r[1] or "")) for r in rows], [(1, leak), (2, line(30))]


def test_stages_take_effect(spark, tmp_path):
    rows, items = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, texts = [], None
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        texts = {r.doc_id: r.text for r in frame.collect()}
        kept.append(set(texts))
    everything = set(range(49))
    assert everything - kept[0] == {42, 43, 45}
    assert kept[0] - kept[1] == {40, 41, 48}
    assert kept[1] - kept[2] == {46}
    assert kept[3] == kept[2]
    for i in (44, 47):
        assert SECRET not in texts[i] and "[SECRET]" in texts[i]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    result = queries.pipeline(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in result} == kept[3]
    for r in result:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)


def test_five_stages_and_an_empty_table(spark, tmp_path):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None
    rows, items = documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert queries.pipeline(spark, str(tmp_path)).count() == 0


def test_extra_columns_with_clashing_names(spark, tmp_path):
    """Columns named like results, or like columns the stages make for themselves, pass through."""
    rows, items = documents()
    docs = spark.createDataFrame([(*r, i, "k", False) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, "
                                 "n_chars long, text_hash int, component_id string, kept boolean").withColumns(
        {"class": F.lit(5), "ids": F.lit("x"), "score": F.lit(1.5), "cleaned": F.lit("c")})
    spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
    assert {r.doc_id for r in frame.collect()} == set(range(49)) - {42, 43, 45, 40, 41, 48, 46}
    assert all(r.component_id == "k" and r["class"] == 5 and r.cleaned == "c" for r in frame.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path))
    assert dict(last.dtypes)["ids"] == "array<int>" and last.count() == frame.count()
