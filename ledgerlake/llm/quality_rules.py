"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histograms of character classes and of common words are held against those of its language, which are
counted over all documents of that language, by Jensen-Shannon distance (base 2). Short texts are not judged by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.llm.common import stash

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
#: Character classes besides white space and symbols; what is left over is the last class.
CLASSES = {"upper": r"[A-Z]+", "digit": r"[0-9]+", "point": r"[.,;:!?'\"()-]+", "high": r"[^\x00-\x7F]+"}
#: Common words of a language: the COMMON most frequent among its words of at most COMMON_CHARS characters.
COMMON, COMMON_CHARS = 32, 4
#: Words that a text needs to be judged by its words, and characters to be judged by its classes.
MIN_WORDS, MIN_CHARS = 50, 200
#: Distinct repeated windows up to which they are looked up one by one; with more, all windows of the text are sorted.
FEW = 48
#: Words of a language below which it is no reference.
MIN_REFERENCE = 2000
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.35, 0.42
#: References up to which they are broadcast; each has a few kilobytes at most.
BROADCAST_ROWS = 2000


def _gone(text: Column, pattern: str) -> Column:
    """Characters of text that the pattern matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _term(p: Column, q: Column) -> Column:
    """What one cell of two histograms adds to twice their divergence in bits."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0) + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(0.0)


def _repeat_words() -> dict[str, Column]:
    """Steps that lead from ``hashes``, of a text's windows of three words in order, and the same ``ordered``, to ``at``: where a window begins that the text has twice or more."""
    size = F.size("hashes")
    again = lambda x, k: F.coalesce(F.get("ordered", k) == x, F.lit(False))
    twice = F.array_distinct(F.filter("ordered", lambda x, k: again(x, k - 1)))
    looked_up = F.filter(F.sequence(F.lit(0), size - 1), lambda i: F.array_contains("twice", F.get("hashes", i)))
    pairs = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda x, k: F.coalesce(F.get("pairs", k)["h"] == x["h"], F.lit(False))
    sorted_out = F.transform(F.filter("pairs", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])
    return {"twice": twice, "pairs": F.when(F.size("twice") > FEW, pairs), "at": F.when(F.size("twice") == 0, F.array().cast("array<int>")).when(F.size("twice") <= FEW, looked_up).otherwise(sorted_out)}


def _measures(docs: DataFrame) -> DataFrame:
    """Counts of every text, and its short words in lower case; texts are read and split once, here."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select("doc_id", "lang", text.alias("text"), F.array_remove(F.split(text, BLANK), "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda i: F.xxhash64(F.get("words", i - 2), F.get("words", i - 1), F.get("words", i)))
    sized = split.select(
        "doc_id",
        "lang",
        F.size("words").alias("n"),
        F.length("text").alias("chars"),
        F.length(F.regexp_replace("text", BLANK, "")).alias("word_chars"),
        _gone(F.col("text"), SYMBOLS).alias("n_symbols"),
        *[_gone(F.col("text"), p).alias(c) for c, p in CLASSES.items()],
        lines.alias("lines"),
        F.transform(F.filter("words", lambda w: F.length(w) <= COMMON_CHARS), F.lower).alias("short"),
        F.when(F.size("words") > 3, windows).otherwise(F.array().cast("array<bigint>")).alias("hashes"),
    )
    found = sized.withColumn("ordered", F.sort_array("hashes"))
    for name, step in _repeat_words().items():
        found = found.withColumn(name, step)
    return found.select(
        "doc_id", "lang", "n", "chars", "word_chars", "n_symbols", *CLASSES,
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.array_distinct(F.flatten(F.transform("at", lambda i: F.array(i, i + 1, i + 2))))).alias("n_repeat_words"),
        "short",
    )


def _class_counts() -> list[Column]:
    own = [F.col("chars") - F.col("word_chars"), F.col("n_symbols"), *[F.col(c) for c in CLASSES]]
    rest = F.col("chars")
    for c in own:
        rest = rest - c
    return [*own, rest]


def references(measures: DataFrame) -> DataFrame:
    """lang, its character-class shares, its common words and their shares, from all rows whose lang is known.

    The last word share is that of all other words. A language with under MIN_REFERENCE words gives no reference.
    """
    rows = measures.filter("lang is not null")
    counts = rows.select("lang", F.explode("short").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counts.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= COMMON)
    top = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "word", "n"))).alias("top"))
    sums = rows.groupBy("lang").agg(*[F.sum(c).alias(c) for c in ("n", "chars", "word_chars", "n_symbols", *CLASSES)])
    both = sums.join(top, "lang").filter(F.col("n") >= MIN_REFERENCE)
    share = F.transform("top", lambda x: x["n"] / F.col("n"))
    return both.select(
        "lang",
        F.array(*[c / F.col("chars") for c in _class_counts()]).alias("class_share"),
        F.transform("top", lambda x: x["word"]).alias("common"),
        F.concat(share, F.array(1.0 - F.aggregate(share, F.lit(0.0), lambda a, x: a + x))).alias("word_share"),
    )


def judge(docs: DataFrame) -> DataFrame:
    """Base counts and the divergence verdict of every whole text.

    docs: doc_id, text, lang; further columns are ignored. Returns for each row doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words (long), base_failed, class_distance, word_distance (null where a guard holds or the
    language has no reference) and kept (false if base_failed or a distance is over its limit). A null text counts as
    empty; a null or rare lang leaves the verdict to the base counts; repeated rows are each judged; an empty table
    gives an empty result. Words in repeated windows are found by 64-bit hashes within a document. Documents are not
    shuffled: only counts by language and word are, and those are summed in each task first.
    """
    measures = stash(_measures(docs), "measures")
    refs = stash(references(measures), "references")
    small = refs.count() <= BROADCAST_ROWS
    rows = measures.join(F.broadcast(refs) if small else refs, "lang", "left")
    counted = rows.withColumn("seen", F.sort_array(F.filter("short", lambda w: F.coalesce(F.array_contains("common", w), F.lit(False)))))
    counted = counted.withColumn("kinds", F.array_distinct("seen"))
    counted = counted.withColumn("at", F.transform("kinds", lambda w: F.array_position("seen", w)))
    size = F.size("seen") + 1
    cells = F.transform("kinds", lambda w, k: F.struct(((F.coalesce(F.get("at", k + 1), size) - F.get("at", k)) / F.col("n")).alias("p"), F.element_at("word_share", F.array_position("common", w).cast("int")).alias("q")))
    counted = counted.withColumn("cells", cells)
    total = lambda f: F.aggregate("cells", F.lit(0.0), lambda a, x: a + f(x))
    other_q = F.element_at("word_share", -1)
    absent = 1.0 - other_q - total(lambda x: x["q"])
    words = 0.5 * (total(lambda x: _term(x["p"], x["q"])) + absent + _term(1.0 - total(lambda x: x["p"]), other_q))
    classes = 0.5 * sum((_term(c / F.col("chars"), F.get("class_share", F.lit(k))) for k, c in enumerate(_class_counts())), F.lit(0.0))
    root = lambda x: F.sqrt(F.greatest(x, F.lit(0.0)))
    judged = counted.select(
        "doc_id",
        *[F.col(c).cast("long").alias(a) for c, a in (("n", "n_words"), ("word_chars", "word_chars"), ("n_symbols", "n_symbols"), ("n_dup_lines", "n_dup_lines"), ("n_repeat_words", "n_repeat_words"))],
        ((F.col("n") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n"))).alias("base_failed"),
        F.when(F.col("common").isNotNull() & (F.col("chars") >= MIN_CHARS), root(classes)).alias("class_distance"),
        F.when(F.col("common").isNotNull() & (F.col("n") >= MIN_WORDS), root(words)).alias("word_distance"),
    )
    far = F.coalesce(F.col("class_distance") > MAX_CLASS_DISTANCE, F.lit(False)) | F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False))
    return judged.withColumn("kept", ~(F.col("base_failed") | far))
