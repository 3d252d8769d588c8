"""Quality rules: a document's histograms of character classes and of common words against those of its language.
DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from muster.llm.common import Stage

#: Blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"
BLANK = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Marks at a word's ends that do not belong to it.
ENDS = ".,;:!?\"'()[]{}#*$%&|<>-_"
#: Character classes counted by pattern; letters and all else are the rest of a text's word characters.
CLASSES = {"upper": r"\p{Lu}", "digit": r"\p{Nd}", "symbol": SYMBOLS, "punct": r"[\p{P}&&[^#*%&]]"}
#: Windows of so many words tell repeats.
WINDOW_WORDS = 3
LEAST_WORDS = 50
#: 100 * repeated words may be at most so many times the words.
MOST_REPEATED = 50


@dataclass(frozen=True)
class Limits:
    """When a histogram is compared, and how far it may be from its language's (Jensen-Shannon distance, 0 to 1)."""

    #: Common words of a language, and the code points that one has at most.
    common_words: int = 50
    longest_word: int = 6
    #: A language is known by so many words at least; documents of others are judged by the base rules.
    reference_words: int = 20_000
    #: Texts with fewer word characters, or fewer words, are not held against a histogram.
    least_chars: int = 200
    least_words: int = 80
    most_class_distance: float = 0.25
    #: Beyond what a text of that length differs by chance.
    most_word_distance: float = 0.28


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` (text among its columns) with the base counts of each text and its words, all within the row.

    Words travel as an array; whatever is read by a lambda is zipped into its rows, so each step is linear or a sort.
    """
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(BLANKS))
    rows = docs.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK, -1)))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))

    def later(column: str, by: int) -> Column:
        return F.slice(column, 1 + by, F.greatest(F.size(column) - by, F.lit(0)))

    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda line: line.rlike(NOT_BLANK))
    windows = F.slice(F.arrays_zip(F.col("words").alias("a"), later("words", 1).alias("b"), later("words", 2).alias("c")), 1, F.greatest(F.size("words") - 2, F.lit(0)))
    rows = rows.withColumns({
        "lines": lines,
        "windows": F.transform(windows, lambda w: F.xxhash64(w["a"], w["b"], w["c"])),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
    })
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(repeated, placed)).drop("windows")
    # Neighbours with one hash are places of one window.
    neighbours = F.filter(F.arrays_zip(F.col("placed").alias("a"), later("placed", 1).alias("b")), lambda p: p["a"]["h"] == p["b"]["h"])
    rows = rows.withColumn("same", F.coalesce(neighbours, F.array().cast("array<struct<a:struct<h:bigint,i:int>,b:struct<h:bigint,i:int>>>"))).drop("placed")
    places = F.concat(F.transform("same", lambda p: p["a"]["i"]), F.transform("same", lambda p: p["b"]["i"]))
    rows = rows.withColumn("places", F.sort_array(F.array_distinct(places))).drop("same")
    # A window covers its words, up to where the next one begins.
    step = F.arrays_zip(F.col("places").alias("a"), later("places", 1).alias("b"))
    covered = F.aggregate(step, F.lit(0), lambda total, s: total + F.least(F.lit(WINDOW_WORDS), s["b"] - s["a"]))
    return rows.withColumns({
        "n_repeat_words": covered.cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_symbols": F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)).cast("long"),
    }).drop("places", "lines")


def class_counts(text: Column, word_chars: Column) -> Column:
    """Characters of each class, the rest last."""
    found = [F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long") for pattern in CLASSES.values()]
    rest = word_chars - sum(found[1:], found[0])
    return F.array(*found, F.greatest(rest, F.lit(0)))


def short_words(words: Column, longest: int) -> Column:
    """Words in lower case without marks at their ends, if they are short and not empty."""
    bare = F.transform(words, lambda w: F.lower(F.btrim(w, F.lit(ENDS))))
    return F.filter(bare, lambda w: (F.length(w) > 0) & (F.length(w) <= longest))


def references(measured: DataFrame, limits: Limits, stage: Stage) -> DataFrame:
    """(ref_lang, class_shares, common, word_shares): one row for each language that is known by enough words.

    Rows are added up by language and short word, on the map side first; of a language's words the most frequent are kept
    (ties to the smaller), so a row is as long as ``common_words``.
    """
    known = measured.filter("lang is not null").withColumnRenamed("lang", "ref_lang")
    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(CLASSES) + 1)]
    totals = known.groupBy("ref_lang").agg(F.sum("n_words").alias("all_words"), F.sum("word_chars").alias("all_chars"), *sums)
    totals = totals.filter(F.col("all_words") >= limits.reference_words)
    shares = F.array(*[F.col(f"c{i}") / F.col("all_chars") for i in range(len(CLASSES) + 1)])
    counts = known.select("ref_lang", F.explode("short").alias("word")).groupBy("ref_lang", "word").agg(F.count(F.lit(1)).alias("count"))
    order = Window.partitionBy("ref_lang").orderBy(F.col("count").desc(), "word")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limits.common_words)
    listed = top.groupBy("ref_lang").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "count"))).alias("top"))
    rows = stage(totals.select("ref_lang", "all_words", shares.alias("class_shares")).join(listed, "ref_lang"))
    rows = rows.withColumn("word_shares", F.transform("top", lambda w: w["count"] / F.col("all_words")))
    rest = 1 - F.aggregate("word_shares", F.lit(0.0), lambda total, share: total + share)
    return rows.select(
        "ref_lang", "class_shares", F.col("top.word").alias("common"), F.concat("word_shares", F.array(rest)).alias("word_shares")
    )


def common_counts(measured: DataFrame, reference: DataFrame, limits: Limits) -> DataFrame:
    """(number, counts): how often the text of each row holds each common word of its language, for rows that hold one.

    Words meet the few common ones by a join. A row's words are in one task, so it leaves it as one row of counts.
    """
    common = reference.select("ref_lang", F.posexplode("common").alias("rank", "word"))
    words = measured.select("number", F.col("lang").alias("ref_lang"), F.explode("short").alias("word"))
    each = [F.count(F.when(F.col("rank") == rank, 1)).alias(f"n{rank}") for rank in range(limits.common_words)]
    counted = words.join(common, ["ref_lang", "word"]).groupBy("number").agg(*each)
    return counted.select("number", F.array(*[f"n{rank}" for rank in range(limits.common_words)]).alias("counts"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two lists of shares, to the base 2; null if one is missing."""

    def term(share: Column, middle: Column) -> Column:
        return F.when(share > 0, share * F.log2(share / middle)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: term(x, (x + y) / 2) + term(y, (x + y) / 2))
    summed = F.aggregate(terms, F.lit(0.0), lambda total, t: total + t)
    return F.when(p.isNotNull() & q.isNotNull(), F.sqrt(F.greatest(summed / 2, F.lit(0.0))))


def chance(bins: Column, n: Column) -> Column:
    """The squared distance that a sample of ``n`` has from its own distribution, on average."""
    return (bins - 1) / (8 * n * F.log(F.lit(2.0)))


def judge(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), limits: Limits = Limits(), stage: Stage | None = None) -> DataFrame:  # noqa: B008
    """``columns`` of every row of ``docs`` (text, lang) with its counts, distances and verdict.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance and kept. A text
    that passes the base rules is kept unless a histogram that it is long enough for lies too far from that of its language.
    The references come from all rows.

    Each text is read once; its counts and short words are staged. Null and empty texts have no word and fail the base rules.
    Rows without lang, or of a language known by too few words, have no distance and are judged by the base rules.
    Repeated rows are returned as often as they come (and count as often in the references); an empty table gives no row.
    ``columns`` may have any names. Equal windows are told by 64-bit hashes: a text of a million words has a chance of
    3e-8 that two different ones fall together.
    """
    stage = stage or Stage(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    measured = counted(docs.select(row.alias("row"), "lang", "text"))
    classes = class_counts(F.col("text"), F.col("word_chars"))
    short = short_words(F.col("words"), limits.longest_word)
    numbered = {"classes": classes, "short": short, "number": F.monotonically_increasing_id()}
    measured = stage(measured.withColumns(numbered).drop("text", "words"))

    reference = stage(references(measured, limits, stage))
    held = measured.drop("short").join(reference.drop("common"), F.col("lang") == F.col("ref_lang"), "left")
    held = held.join(common_counts(measured, reference, limits), "number", "left")
    none = F.array_repeat(F.lit(0).cast("long"), limits.common_words)
    held = held.withColumn("counts", F.slice(F.coalesce("counts", none), 1, F.size("word_shares") - 1))
    common = F.transform("counts", lambda c: c / F.col("n_words"))
    held = held.withColumn("p", F.when(F.col("n_words") > 0, common)).drop("counts")
    rest = 1 - F.aggregate("p", F.lit(0.0), lambda total, share: total + share)
    held = held.withColumn("p", F.concat("p", F.array(F.greatest(rest, F.lit(0.0)))))
    held = held.withColumn("c", F.when(F.col("word_chars") > 0, F.transform("classes", lambda x: x / F.col("word_chars"))))
    held = held.withColumns({
        "class_distance": distance(F.col("c"), F.col("class_shares")),
        "word_distance": distance(F.col("p"), F.col("word_shares")),
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    })
    far_class = (F.col("word_chars") >= limits.least_chars) & (F.col("class_distance") > limits.most_class_distance)
    allowed = limits.most_word_distance**2 + chance(F.size("word_shares"), F.col("n_words"))
    far_words = (F.col("n_words") >= limits.least_words) & (F.pow("word_distance", F.lit(2)) > allowed)
    kept = ~F.col("base_failed") & ~F.coalesce(far_class, F.lit(False)) & ~F.coalesce(far_words, F.lit(False))
    return held.select(
        "row.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", kept.alias("kept")
    )
