"""Line-first cleaning of documents, in DataFrame functions only.

Every line is judged by itself: by its punctuation, as navigation, as boilerplate. Failing lines are
removed, and a document that loses more than half of its text with them is rejected, as is one that
fails the base rules (too few words, too many repeated word windows).

Defined cases: a null text is the empty text and is rejected; a document without words has zero
counts; repeated rows give repeated results; an empty table gives an empty result. Other columns of
the input, also ones named like a result, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import NON_SPACE, whole_text, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
MAX_LOST_PERCENT = 50
# A line is symbol-ridden when such signs make up a tenth of it, shouting when every twentieth
# character is an exclamation mark, navigation when it has three separators and one in four words.
SYMBOLS = r"[#*$%&|<>]"
SEPARATORS = r"[|»›•·>]"
BOILERPLATE = (
    r"(?i)\b(all rights reserved|cookies?|privacy policy|terms (of|and) (use|service|conditions)|"
    r"enable javascript|subscribe to|sign (in|up)|log in|click here|read more|share (this|on)|"
    r"licensed under|released under the|lorem ipsum|powered by|back to top)\b"
)
BOILERPLATE_CHARS = 200
END_OF_SENTENCE = r"[.!?…:;,)\"'»”’。！？][ \x09-\x0D]*$"
FRAGMENT_WORDS = 3


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def line_fails(line: Column) -> Column:
    """Is this line debris? Lines without a word are neither kept nor counted as lost."""
    length = F.length(line)
    separators = _count(line, SEPARATORS)
    gaps = F.size(F.split(line, r"[ \x09-\x0D]+"))
    return (
        (_count(line, SYMBOLS) * 10 > length)
        | (_count(line, "!") * 20 > length) & (length >= 40)
        | ((separators >= 3) & (separators * 4 >= gaps))
        | ((length <= BOILERPLATE_CHARS) & line.rlike(BOILERPLATE))
        | ((gaps <= FRAGMENT_WORDS) & ~line.rlike(END_OF_SENTENCE))
    )


def _covered(positions: Column) -> Column:
    """Number of words that the windows starting at these ascending positions cover."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        positions, start,
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )


def assess(docs: DataFrame, text: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """The columns of `extra` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, lost_chars and cleaned, the text of the lines that passed.

    Word windows are compared by 64-bit hashes within one document.
    """
    rows = docs.select(*extra, whole_text(text).alias("_text"))
    rows = rows.withColumns({
        "_words": words(F.col("_text")),
        "_lines": F.filter(F.split("_text", "\n"), lambda line: line.rlike(NON_SPACE)),
    })
    rows = rows.withColumns({
        "n_words": F.size("_words").cast("long"),
        "_hashes": F.slice(
            F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))),
            F.lit(1), F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0)),
        ),
        "_good": F.filter("_lines", lambda line: ~line_fails(line)),
    })
    # Only a document with a repeated window sorts its windows; equal ones are then neighbours.
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    rows = rows.withColumn("_sorted", F.when(repeats, F.sort_array(
        F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("_sorted", lambda e, k: (
        F.coalesce(F.get("_sorted", k - 1)["h"] == e["h"], F.lit(False))
        | F.coalesce(F.get("_sorted", k + 1)["h"] == e["h"], F.lit(False))
    ))
    rows = rows.withColumn("_again", F.sort_array(F.transform(again, lambda e: e["i"])))
    all_chars = F.length(F.array_join("_lines", ""))
    rows = rows.withColumns({
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": _count(F.col("_text"), SYMBOLS).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(_covered(F.col("_again")), F.lit(0)).cast("long"),
        "lost_chars": (all_chars - F.length(F.array_join("_good", ""))).cast("long"),
        "_chars": all_chars,
        "cleaned": F.array_join("_good", "\n"),
    })
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))
    kept = ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("_chars") * MAX_LOST_PERCENT)
    found = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars", "cleaned")
    # The row comes out of a generator: a later filter cannot be pushed below the steps above, where it
    # would be computed anew for every element of the arrays that its lambda functions look into.
    return rows.withColumn("kept", kept).select(F.inline(F.array(F.struct(*extra, *found))))


def clean(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the text of their passing lines and its length; all columns of
    the input stay, whatever their names."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    judged = assess(rows, extra=("_row",)).where("kept")

    def column(name: str) -> Column:
        if name == "text":
            return F.col("cleaned").alias(name)
        if name == "n_chars":
            return F.length("cleaned").cast(docs.schema[name].dataType).alias(name)
        return F.col("_row")[name].alias(name)
    return judged.select(*[column(c) for c in docs.columns])
