"""Quality rules: divergence of character classes and common words from the language.

Only DataFrame functions. One pass measures every text, a sum over all measured texts
gives each language its reference histograms, and a text is rejected when its own
histograms lie too far from those of its language (Jensen-Shannon distance, base 2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import WHITE, bind, words_of, written

# Frequent function words by language code.
COMMON_WORDS = {
    "en": "the of and to in that is was for on are with as by be at this it from or an not have".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au pas avec ou ce il".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como o".split(),
}

#: Texts below these sizes are not judged by the respective histogram.
MIN_CHARS = 200
MIN_WORDS = 100
#: Largest Jensen-Shannon distance from the language (0: alike, 1: nothing in common).
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.27

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _with_repeat_words(docs: DataFrame, words: str, name: str) -> DataFrame:
    """Adds how many words stand in a window of three words that occurs again in the text.

    The windows are hashed, and the hashes sorted as plain numbers to find those that
    occur again. Their places are looked up in the list of these if it is short, else
    found by sorting hash and place together.
    """
    inner = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    hashes = F.transform(
        inner, lambda w, i: F.xxhash64(w, F.get(F.col(words), i + 1), F.get(F.col(words), i + 2))
    )

    def spread(places):
        each = F.transform(places, lambda i: F.array(i, i + 1, i + 2))
        return F.size(F.array_distinct(F.flatten(each))).cast("long")

    def adjacent(s):
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        hit = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
        return spread(F.transform(hit, lambda x: x["i"]))

    pair = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    listed = F.filter(
        F.transform("_hashes", lambda h, i: F.when(F.array_contains("_again", h), i)),
        lambda i: i.isNotNull(),
    )
    return (
        docs.withColumn("_hashes", hashes)
        .withColumn("_sorted", F.sort_array("_hashes"))
        .withColumn("_again", F.filter("_sorted", lambda h, i: h == F.get("_sorted", i + 1)))
        .withColumn("_again", F.array_distinct("_again"))
        .withColumn(
            name,
            F.when(F.size("_again") == 0, F.lit(0).cast("long"))
            .when(F.size("_again") <= 64, spread(listed))
            .otherwise(bind(F.sort_array(pair), adjacent)),
        )
        .drop("_hashes", "_sorted", "_again")
    )


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    return bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _common_only(lang: Column, words: Column) -> Column:
    """The common words of the language among ``words``; null without a list."""

    def among(listed):
        return F.filter(words, lambda w: w.isin(listed))

    found = F.lit(None).cast("array<string>")
    for code, listed in COMMON_WORDS.items():
        found = F.when(lang == code, among(listed)).otherwise(found)
    return found


def _common_counts(lang: Column, common: Column, n_words: Column) -> Column:
    """How often each common word of the language occurs, then all other words. Looped
    over a list rather than spelt out, as generated code that long is never compiled."""
    listed = F.lit(None).cast("array<string>")
    for code, words in COMMON_WORDS.items():
        listed = F.when(lang == code, F.lit(words)).otherwise(listed)
    each = F.transform(listed, lambda w: (F.size(common) - F.size(F.array_remove(common, w))).cast("double"))
    return F.concat(each, F.array((n_words - F.size(common)).cast("double")))


def measures(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with the five measures and two histograms of each text.

    A null text counts as empty. Columns of ``docs`` that are named like a measure are
    replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    split = docs.withColumn("_words", words_of(F.col(text)))
    split = _with_repeat_words(split, "_words", "n_repeat_words")
    split = split.withColumn("_listed", _common_only(F.col(lang), F.col("_words")))
    chars = F.length(t).cast("double")
    classes = [
        F.regexp_count(t, F.lit("\\p{Lu}")).cast("double"),
        F.regexp_count(t, F.lit("[0-9]")).cast("double"),
        F.regexp_count(t, F.lit("[.,;:!?]")).cast("double"),
    ]
    counted = (
        split.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"))
        .withColumn("n_dup_lines", _dup_lines(t))
        .withColumn("_common", _common_counts(F.col(lang), F.col("_listed"), F.size("_words")))
        .withColumn("_marks", F.array(*classes))
        .withColumn("_chars", chars)
        .drop("_words", "_listed")
    )
    # Upper case, digits, sentence marks, symbols, white space, and all the rest.
    known = F.concat(
        "_marks",
        F.array(F.col("n_symbols").cast("double"), F.col("_chars") - F.col("word_chars")),
    )
    rest = F.col("_chars") - F.aggregate(known, F.lit(0.0), lambda a, x: a + x)
    return counted.withColumn("_classes", F.concat(known, F.array(rest))).drop("_marks")


def _total(histogram: str, size: int) -> Column:
    return F.array(*[F.coalesce(F.sum(F.get(histogram, F.lit(i))), F.lit(0.0)) for i in range(size)])


def language_references(measured: DataFrame, lang: str = "lang") -> DataFrame:
    """The two histograms of each language that has a word list, summed over all of its
    texts: a row per language, at most as many as there are lists."""
    size = 1 + max(len(x) for x in COMMON_WORDS.values())
    return (
        measured.where(F.col(lang).isin(*COMMON_WORDS))
        .groupBy(F.col(lang).alias("_lang"))
        .agg(_total("_classes", 6).alias("_ref_classes"), _total("_common", size).alias("_ref_common"))
    )


def _shares(histogram: Column) -> Column:
    def divided(h):
        return bind(
            F.aggregate(h, F.lit(0.0), lambda a, x: a + x),
            lambda n: F.transform(h, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))),
        )

    return bind(histogram, divided)


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length, 0 to 1."""

    def part(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def divergence(x, y):
        m = (x + y) / 2
        return (part(x, m) + part(y, m)) / 2

    def both(a):
        return bind(
            _shares(q),
            lambda b: F.aggregate(F.zip_with(a, b, divergence), F.lit(0.0), lambda s, x: s + x),
        )

    return F.sqrt(F.greatest(bind(_shares(p), both), F.lit(0.0)))


def quality(docs: DataFrame, text: str = "text", lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (its columns ``keep``, default all) with its verdict.

    Adds the five measures, ``base_failed`` (fewer than 50 words, or over half of the
    words in repeated windows), ``class_distance`` and ``word_distance`` (null where a
    text is too short to judge or its language has no reference), and ``kept``. Empty and null texts
    fail the base rule. A text of an unknown or null language is judged by the base rule only. Repeated
    rows are judged each; an empty table gives an empty result. The measured rows, without
    what ``keep`` leaves out, are written once to the shared folder, as the reference
    histograms cover all of them.
    """
    keep = [c for c in (keep or docs.columns) if c not in MEASURES]
    own = docs.select(
        *[F.col(c) for c in keep], F.col(text).alias("_text"), F.col(lang).alias("_of")
    )
    hidden = ["_of", "_classes", "_common", "_chars"]
    measured = measures(own, "_text", "_of").select(*keep, *MEASURES, *hidden)
    measured = written(measured, "quality")
    # At most one row for each word list: bounded whatever the input.
    references = F.broadcast(language_references(measured, "_of"))
    judged = measured.join(references, F.col("_of") == F.col("_lang"), "left")
    width = F.size("_common")
    distances = judged.withColumn(
        "class_distance",
        F.when(
            (F.col("_chars") >= MIN_CHARS) & F.col("_lang").isNotNull(),
            jensen_shannon(F.col("_classes"), F.col("_ref_classes")),
        ),
    ).withColumn(
        "word_distance",
        F.when(
            (F.col("n_words") >= MIN_WORDS) & F.col("_lang").isNotNull(),
            jensen_shannon(F.col("_common"), F.slice("_ref_common", F.lit(1), width)),
        ),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= MAX_CLASS_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE
    )
    return distances.select(
        *keep,
        *MEASURES,
        failed.alias("base_failed"),
        "class_distance",
        "word_distance",
        (~failed & near).alias("kept"),
    )


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns only."""
    columns = docs.columns
    # Under names of their own, so that no measure can take a column's place.
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    at = {c: f"c{i}" for i, c in enumerate(columns)}
    kept = quality(plain, at[text], at[lang]).where("kept")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
