"""Spelling variants of words by permuterm rotations.

A word is closed by a terminator and rotated to begin after each of its characters. In
the sorted rotations, words that differ in one replaced character stand together under the
rotation without its last character, which is the edited one, and a word that lacks this
character is the whole of that prefix. Each rotation is dealt to both of its places, as a
whole and without its last character, so a prefix range is one group, of at most one row
for each letter there is. Everything is built-in Spark: groups are sorted and scanned by
windows, and no pairs are formed.
"""

from __future__ import annotations

from math import ceil, log, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import bind, written

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Closes a word; no run holds it.
END = "$"
#: A word of the shortest default length has 13 rows among the dealt rotations, so a table with
#: a row for each word needs an eighth of the partitions that these have, at most.
ROTATIONS = 8
#: Of the search for roots, so many rounds are one plan: eight reads of a table.
ROUNDS = 3


def count_words(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    slip: int | None = None,
    min_length: int = 6,
    min_count: int = 5,
) -> DataFrame:
    """``word``, ``n`` of the letter runs of all whole texts, A-Z lower-cased.

    With ``slip``, a run loses a character wherever the number divides the checksum h of
    ``<id>:<run>``: the one at h modulo its length. A null text has no runs, a null id is
    an empty text. Words shorter than ``min_length`` or rarer than ``min_count`` are left
    out. Words are counted in each task before the shuffle.
    """
    lowered = F.translate(F.col(text).cast("string"), UPPER, LOWER)
    word = F.col("run")
    runs = docs.select(
        F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"),
    )
    if slip is not None:
        # A run one longer than the shortest word may become one.
        runs = runs.where(F.length("run") >= min_length)
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))

        def slipped(h: Column) -> Column:
            at = (h % F.length("run")).cast("int")
            cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
            return F.when(h % slip == 0, cut).otherwise(F.col("run"))

        runs = runs.withColumn("h", h)
        word = slipped(F.col("h"))
    words = runs.select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def few(df: DataFrame) -> DataFrame:
    """``df``, with a row for each word, in fewer partitions than its shuffle has: shuffles are
    sized for the rotations. Each partition that is written is a file, for which a store may
    need more than for its rows: Hadoop's local one starts two processes."""
    spark = df.sparkSession
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(spark.sparkContext.defaultParallelism, ceil(dealt / ROTATIONS)))


def rotations(words: DataFrame) -> DataFrame:
    """Every rotation of every closed word, dealt to its two prefixes: ``prefix``, ``word``,
    ``n``, ``whole`` (the word lacks the edited character) and ``first``.

    ``first`` tells which of several equal characters in a row counts as the one too many,
    so that two words meet once.
    """
    length = F.length("word")
    turned = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("at"))
    # Begins behind character `at` (from 1; 0: the word as it stands), ends with it.
    rotation = F.concat(F.substr("word", F.col("at") + 1), F.lit(END), F.substr("word", F.lit(1), F.col("at")))
    last = F.substr("word", F.col("at"), F.lit(1))
    before = F.when(F.col("at") > 1, F.substr("word", F.col("at") - 1, F.lit(1)))
    shorter = F.substr(F.col("rotation"), F.lit(1), length)
    places = F.when(
        F.col("at") > 0,
        F.array(
            F.struct(shorter.alias("prefix"), F.lit(False).alias("whole")),
            F.struct(F.col("rotation").alias("prefix"), F.lit(True).alias("whole")),
        ),
    ).otherwise(
        F.array(F.struct(F.col("rotation").alias("prefix"), F.lit(True).alias("whole")))
    )
    return (
        turned.withColumns({"rotation": rotation, "first": F.coalesce(last != before, F.lit(True))})
        .select("word", "n", "first", F.explode(places).alias("place"))
        .select("place.prefix", "place.whole", "word", "n", "first")
    )


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near`` and ``best``: the near word of largest ``n``, as a struct of
    ``rank`` (minus n) and ``word``, of which the least counts; null without a near one.

    Groups are sorted by rank, whole words last. Of the others in its group a word needs how
    many there are and the first one, or the second if it is the first itself.
    """
    group = Window.partitionBy("prefix")
    ranked = group.orderBy("whole", "rank", "word")
    extended, counted = ~F.col("whole"), ~F.col("whole") & F.col("first")
    me = F.struct("rank", "word")
    rows = rotations(words).withColumn("rank", -F.col("n"))
    everywhere = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "word",
        "n",
        "whole",
        "first",
        # Once for each word: the rotation that is the word as it stands.
        (F.col("whole") & F.col("prefix").endswith(END)).alias("unturned"),
        F.row_number().over(ranked).alias("place"),
        F.count(F.when(extended, 1)).over(everywhere).alias("n_extended"),
        F.count(F.when(counted, 1)).over(everywhere).alias("n_counted"),
        F.first(me).over(everywhere).alias("one"),
        F.nth_value(me, 2).over(everywhere).alias("two"),
        F.first(F.when(counted, me), ignorenulls=True).over(everywhere).alias("longer"),
        F.last(F.when(F.col("whole"), me), ignorenulls=True).over(everywhere).alias("shorter"),
    )
    other = F.when(F.col("place") > 1, F.col("one")).otherwise(F.col("two"))
    replaced = F.when(F.col("n_extended") > 1, other)
    lacking = F.when(F.col("first"), F.col("shorter"))
    found = rows.select(
        "word",
        "n",
        "unturned",
        F.when(F.col("whole"), F.col("n_counted"))
        .otherwise(F.col("n_extended") - 1 + lacking.isNotNull().cast("int"))
        .alias("near"),
        F.when(F.col("whole"), F.col("longer")).otherwise(F.least(replaced, lacking)).alias("best"),
    ).where("near > 0 or unturned")
    return found.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best")
    )


def roots(forms: DataFrame, steps: int, purpose: str = "spelling-roots") -> DataFrame:
    """``word``, ``root`` of a table ``word``, ``form`` without circles whose chains have at
    most ``steps`` forms: every round doubles how far a word has been followed. It joins
    the round before with itself, so the plan doubles too until a round is written."""
    known = forms.select("word", F.col("form").alias("root"))
    for done in range(ceil(log2(max(1, steps)))):
        if done and done % ROUNDS == 0:
            known = written(few(known), purpose)
        further = known.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        known = known.join(further, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root")
        )
    return known


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Words and what they are variants of: ``word``, ``form``, ``root``, ``n``, ``n_near``,
    ``form_n``.

    ``words`` has each ``word`` once with its ``n``. Near words differ by one inserted,
    deleted or replaced character. A word's ``form`` is its near word of largest n (of
    equals the first in code-point order) if that is at least ``ratio`` times its own,
    else null; its ``root`` is the last word along the forms, itself without one. Counts
    grow by ``ratio`` along a chain, which bounds its length. Rows with a null word, and
    other columns, are left out; an empty table gives an empty result.
    """
    best_n = -F.col("best.rank")
    linked = near_words(words.where("word is not null").select("word", "n")).select(
        "word",
        F.when(best_n >= ratio * F.col("n"), F.col("best.word")).alias("form"),
        "n",
        F.col("n_near").cast("long").alias("n_near"),
        F.when(best_n >= ratio * F.col("n"), best_n).cast("long").alias("form_n"),
    )
    linked = written(few(linked), "spelling-forms")
    ends = linked.agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    most, least = max(1, ends["most"] or 1), max(1, ends["least"] or 1)
    steps = int(log(most / least, ratio) + 1e-9) + 1
    found = roots(linked.where("form is not null"), steps)
    return few(
        linked.join(found, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
        )
    )
