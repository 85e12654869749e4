"""Line dedup: exact copies by hash, near copies by a segment-partition edit join.

Only DataFrame functions. A line is cut into ``EDITS + 1`` segments, and a line within
``EDITS`` edits has one of them unchanged at nearly the same place. Every distinct line
enters its segments in an index and probes the segments of equally long and slightly
shorter lines at all places where they can be; what meets is verified by a banded
bit-parallel edit distance. Lines that hang together keep their first occurrence.

A key that many lines share, as those of one template do, is refined: the shared segment and
what else begins or ends all of its lines is taken off, which leaves lines within ``EDITS``
edits within ``EDITS`` edits, and what is left of them is cut into segments in turn.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import WHITE, bind, connected_components, settle, written

EDITS = 2
#: Shorter lines are left alone: headings, list marks and the like recur by right.
MIN_CHARS = 20
#: Needed lines up to this number are sent to every executor (16 bytes each), which spares
#: a shuffle of all texts; beyond it the texts are shuffled.
FEW_LINES = 200_000
#: A key under which more lines than this are entered is refined. Below it a line meets at
#: most so many others under a key, each by a test of two numbers, which costs less than the
#: shuffles of another level; so the pairs tested grow with the lines, not with their square.
HOT_LINES = 512

# Frequent letters, whose counts rule out most pairs before verification.
LETTERS = "etanoirshdlucmp"


def occurrences(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Every line long enough: the document (``id``, ``tie``), ``pos``, ``line`` without outer
    white space, and its hashes ``h1``, ``h2`` (64 bits each)."""
    named = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    each = named.select("id", "tie", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    lines = each.select("id", "tie", "pos", F.btrim("raw", F.lit(WHITE)).alias("line"))
    return lines.where(F.length("line") >= MIN_CHARS).select(
        "*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
    )


def _place(id_type: str) -> Column:
    """Orders occurrences: by id, null ids last, then by line, then by text.

    Whole numbers become one decimal of 20, 10 and 8 digits, so that the smallest is
    found in hash buffers; other ids make a struct.
    """
    if id_type not in ("bigint", "int", "smallint", "tinyint"):
        return F.struct(F.col("id").isNull().alias("none"), "id", "pos", "tie")

    def whole(digits: str) -> Column:
        return F.lit(digits).cast(f"decimal({len(digits)},0)")

    number = F.coalesce(F.col("id").cast("decimal(20,0)") + whole(str(2**63)), whole("9" * 20))
    line = F.col("pos").cast("decimal(10,0)")
    text = F.pmod("tie", F.lit(10**8)).cast("decimal(8,0)")
    low = (line * whole("1" + "0" * 8) + text).cast("decimal(18,0)")
    return (number.cast("decimal(20,0)") * whole("1" + "0" * 18) + low).cast("decimal(38,0)")


def signature(line: Column) -> Column:
    """Counts of the ``LETTERS`` and of all other characters, modulo 16, in four bits each."""
    counts = [F.regexp_count(line, F.lit(letter)) for letter in LETTERS]
    counts.append(F.length(line) - reduce(lambda x, y: x + y, counts))
    nibbles = [F.shiftleft((c % 16).cast("long"), 4 * k) for k, c in enumerate(counts)]
    return reduce(lambda x, y: x.bitwiseOR(y), nibbles)


def _counts_near(a: Column, b: Column) -> Column:
    """Whether two signatures differ by what ``EDITS`` edits can do: each edit takes one
    character away, adds one, or both."""
    apart = []
    for k in range(len(LETTERS) + 1):
        d = F.shiftright(a, 4 * k).bitwiseAND(15) - F.shiftright(b, 4 * k).bitwiseAND(15)
        d = d.bitwiseAND(15)
        apart.append(F.least(d, 16 - d))
    return reduce(lambda x, y: x + y, apart) <= 2 * EDITS


def _segment(length: Column, i: int) -> tuple[Column, Column]:
    """Place (from 0) and size of segment ``i`` of a line of ``length`` characters: all of
    about the same size, the last ones a character longer where it does not come out even."""
    parts = EDITS + 1
    size, over = (length / parts).cast("int"), length % parts
    longer = F.greatest(over - (parts - i), F.lit(0))
    return size * i + longer, size + F.when(over >= parts - i, 1).otherwise(0)


def index_places(length: Column) -> list[tuple]:
    """A line's own segments: its length, the segment, where it is and its size."""
    return [(length, i, *_segment(length, i)) for i in range(EDITS + 1)]


def probe_places(length: Column) -> list[tuple]:
    """Where a line may hold the segments of lines as long as itself or up to ``EDITS`` shorter:
    their length, the segment, the place and its size. Of the places of a segment only those
    are tried that leave edits enough on both sides; some may reach beyond the line."""
    out = []
    for shorter in range(EDITS + 1):
        target = length - shorter
        for i in range(EDITS + 1):
            at, size = _segment(target, i)
            low = max(-i, shorter - (EDITS - i))
            high = min(i, shorter + (EDITS - i))
            out += [(target, i, at + shift, size) for shift in range(low, high + 1)]
    return out


def _key(line: Column, length: Column, place: tuple, *path: Column) -> Column:
    target, i, at, size = place
    key = F.xxhash64(*path, target, F.lit(i), F.substr(line, at + 1, size))
    return F.when((target >= 0) & (at >= 0) & (at + size <= length), key)


def edit_distance(a: Column, b: Column) -> Column:
    """Edit distance of two lines whose lengths differ by ``EDITS`` at most and are
    longer than that; exact up to ``EDITS``, larger values say only "more".

    Bit-parallel in a band: bit k of a word stands for the cell ``EDITS - k`` rows above
    the diagonal, so a column costs a few operations on small integers. The score is
    followed down the lower edge of the band and then along the last row.
    """
    width = 2 * EDITS + 1
    full = (1 << width) - 1

    def inverse(x):
        return F.lit(full).bitwiseXOR(x)

    def matches(chars_a, chars_b):
        def of(char, j):
            bits = [
                F.when(F.get(chars_a, j + k - EDITS) == char, 1 << k).otherwise(0) for k in range(width)
            ]
            return reduce(lambda x, y: x + y, bits)

        return F.transform(chars_b, of)

    def column(state, match, rows):
        def step(d0):
            hp = state["vn"].bitwiseOR(inverse(d0.bitwiseOR(state["vp"])))
            hn = d0.bitwiseAND(state["vp"])
            right = F.shiftright(d0, 1)
            j = state["j"] + 1
            # In the last row its bit is `rows - j + EDITS`; before, the lower edge counts.
            mark = F.call_function("shiftleft", F.lit(1), F.greatest(rows - j + EDITS, F.lit(0)))
            up = F.when(hp.bitwiseAND(mark) != 0, 1).otherwise(0)
            down = F.when(hn.bitwiseAND(mark) != 0, 1).otherwise(0)
            diagonal = F.when(d0.bitwiseAND(1 << (width - 1)) != 0, 0).otherwise(1)
            return F.struct(
                hn.bitwiseOR(inverse(right.bitwiseOR(hp))).alias("vp"),
                right.bitwiseAND(hp).alias("vn"),
                (state["score"] + F.when(j <= rows - EDITS, diagonal).otherwise(up - down)).alias("score"),
                j.alias("j"),
            )

        vp, vn = state["vp"], state["vn"]
        carried = (match.bitwiseAND(vp) + vp).bitwiseAND(full)
        d0 = carried.bitwiseXOR(vp).bitwiseOR(match).bitwiseOR(vn)
        return bind(d0, step)

    start = F.struct(
        F.lit(full - ((1 << EDITS) - 1)).alias("vp"),
        F.lit(0).alias("vn"),
        F.lit(EDITS).alias("score"),
        F.lit(0).alias("j"),
    )
    chars_a, chars_b = F.split(a, ""), F.split(b, "")
    return bind(
        F.struct(chars_a.alias("a"), chars_b.alias("b")),
        lambda s: bind(
            matches(s["a"], s["b"]),
            lambda m: F.aggregate(
                m, start, lambda acc, x: column(acc, x, F.size(s["a"])), lambda acc: acc["score"]
            ),
        ),
    )


def distinct_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per distinct line, however often it occurs: ``h1``, ``h2``, its first place, how
    often, and its probe keys ``k0`` …, its own segments among them. All of fixed width: no
    line is sorted."""
    every = occurrences(docs, id, text)
    size = F.length("line")
    keys = [_key(F.col("line"), size, place) for place in probe_places(size)]
    keyed = every.select(
        "h1",
        "h2",
        _place(dict(every.dtypes)["id"]).alias("place"),
        *[k.alias(f"k{i}") for i, k in enumerate(keys)],
    )
    return keyed.groupBy("h1", "h2").agg(
        F.min("place").alias("first"),
        F.count("*").alias("n"),
        *[F.first(f"k{i}").alias(f"k{i}") for i in range(len(keys))],
    )


def _needed(distinct: DataFrame) -> DataFrame:
    """The lines that share a key with another one. Of each key the smallest and the largest
    line are told by a grouping; the others only of keys that have more than two."""
    keys = [c for c in distinct.columns if c.startswith("k")]
    rows = distinct.select("node", F.explode(F.array(*keys)).alias("key")).where("key is not null")
    shared = (
        rows.groupBy("key")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n"))
        .where("low < high")
    )
    shared = written(shared, "line-keys")
    ends = shared.select(F.explode(F.array("low", "high")).alias("node"))
    more = rows.join(shared.where("n > 2").select("key"), "key", "left_semi").select("node")
    needed = ends.union(more).distinct()
    return distinct.select("node", "h1", "h2").join(needed, "node", "left_semi")


def _entered(rows: DataFrame, probe: bool) -> DataFrame:
    """A row per key of every row (``node``, ``sig``, ``path``, ``rest``), with the segment and
    place of the key: ``i``, ``at``, ``size``, and the sizes of the outer segments."""
    length = F.length("rest")
    places = probe_places(length) if probe else index_places(length)
    entries = [
        F.struct(
            _key(F.col("rest"), length, place, F.col("path")).alias("key"),
            F.lit(place[1]).alias("i"),
            place[2].alias("at"),
            place[3].alias("size"),
            _segment(place[0], 0)[1].alias("first_size"),
            _segment(place[0], EDITS)[1].alias("last_size"),
        )
        for place in places
    ]
    entered = rows.select("node", "sig", "rest", F.explode(F.array(*entries)).alias("entry"))
    return entered.select("node", "sig", "rest", "entry.*").where("key is not null")


def _common_start(a: Column, b: Column) -> Column:
    """How many characters two texts have in common from their start."""
    differ = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: ~x.eqNullSafe(y))
    first = F.array_position(differ, F.lit(True)).cast("int") - 1
    return F.when((a == "") | (b == ""), 0).when(first < 0, F.length(a)).otherwise(first)


def _refined(index: DataFrame, probe: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is left of the lines of hot keys, as rows to enter again with the key as ``path``.

    The segment of the key goes, then the common start and the common end of the key's lines.
    Lines that have a whole outer segment in common too meet under that one, with the same
    rest, so they need not meet here.
    """

    def rest_of(entered: DataFrame) -> DataFrame:
        after = F.col("at") + F.col("size")
        rest = F.concat(
            F.substr("rest", F.lit(1), F.col("at")),
            F.substr(F.col("rest"), after + 1, F.greatest(F.length("rest") - after, F.lit(0))),
        )
        kept = entered.join(hot, "key", "left_semi").withColumn("rest", rest)
        return kept.withColumn("behind", F.length("rest") - F.col("at"))

    own, others = rest_of(index), rest_of(probe)
    ends = (
        own.select("key", "rest")
        .union(others.select("key", "rest"))
        .groupBy("key")
        .agg(
            F.min("rest").alias("low"),
            F.max("rest").alias("high"),
            F.min(F.reverse("rest")).alias("back_low"),
            F.max(F.reverse("rest")).alias("back_high"),
            F.min(F.length("rest")).alias("least"),
        )
        .select(
            "key",
            "least",
            _common_start(F.col("low"), F.col("high")).alias("start"),
            _common_start(F.col("back_low"), F.col("back_high")).alias("end"),
        )
    )
    ends = written(ends, "line-ends")
    by_first = (F.col("i") > 0) & (F.col("start") >= F.col("first_size")) & (F.col("at") >= F.col("first_size"))
    by_last = (
        (F.col("i") > 0)
        & (F.col("i") < EDITS)
        & (F.col("end") >= F.col("last_size"))
        & (F.col("behind") >= F.col("last_size"))
    )
    left = others.join(ends, "key").where(~by_first & ~by_last)

    def cut(rows: DataFrame) -> DataFrame:
        end = F.least("end", F.col("least") - F.col("start"))
        rest = F.substr(F.col("rest"), F.col("start") + 1, F.length("rest") - F.col("start") - end)
        return rows.select("node", "sig", F.col("key").alias("path"), rest.alias("rest"))

    left = written(cut(left).distinct(), "line-probes")
    paths = left.select(F.col("path").alias("key")).distinct()
    kept = own.join(paths, "key", "left_semi").join(ends, "key")
    return written(cut(kept), "line-index"), left


def _pairs(index: DataFrame, probe: DataFrame, by: str) -> DataFrame:
    """Pairs ``a`` < ``b`` of lines that meet and whose character counts are near."""
    own = index.select(F.col("node").alias("x"), F.col("sig").alias("sig_x"), F.col(by).alias("at_x"))
    other = probe.select(F.col("node").alias("y"), F.col("sig").alias("sig_y"), F.col(by).alias("at_y"))
    met = own.join(
        other,
        (F.col("at_x") == F.col("at_y"))
        & (F.col("x") != F.col("y"))
        & _counts_near(F.col("sig_x"), F.col("sig_y")),
    )
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _candidates(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Pairs of lines to compare, which hold every pair within ``EDITS`` edits but those of a
    dense group, and the dense groups (None: there are none).

    A dense group is a refined key with at most ``EDITS`` characters left: the lines that are
    entered there differ in these only, so each is a near copy of all others. They come as
    pairs with the first of them. ``dense`` has ``node``, ``sig``, ``path`` and ``side``, for
    those that only probe the group.
    """
    found, dense = None, None
    own = others = texts.select("node", "sig", F.lit(0).cast("long").alias("path"), F.col("line").alias("rest"))
    while True:
        index, probe = _entered(own, False), _entered(others, True)
        hot = written(index.groupBy("key").count().where(F.col("count") > HOT_LINES).select("key"), "line-hot")
        some = not hot.isEmpty()
        cold = index.join(hot, "key", "left_anti") if some else index
        pairs = _pairs(cold, probe, "key")
        found = pairs if found is None else found.union(pairs).distinct()
        if not some:
            return found.distinct(), dense
        found = written(found, "line-pairs")
        settle(texts.sparkSession)
        own, others = _refined(index, probe, hot)
        # The length left is the same for all lines entered under one path.
        short = own.where(F.length("rest") <= EDITS)
        full = short.select("path").distinct()
        ended = (
            short.select("node", "sig", "path", F.lit(0).alias("side"))
            .union(others.join(full, "path", "left_semi").select("node", "sig", "path", F.lit(1).alias("side")))
        )
        dense = ended if dense is None else dense.union(ended)
        others = others.join(full, "path", "left_anti")
        own = own.where(F.length("rest") > EDITS)


def _near(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs within ``EDITS`` edits."""
    one = texts.select(F.col("node").alias("a"), F.col("line").alias("t_a"))
    two = texts.select(F.col("node").alias("b"), F.col("line").alias("t_b"))
    both = pairs.join(one, "a").join(two, "b").where(F.abs(F.length("t_a") - F.length("t_b")) <= EDITS)
    near = both.withColumn("distance", edit_distance(F.col("t_a"), F.col("t_b")))
    return near.where(F.col("distance") <= EDITS).select("a", "b")


def near_line_links(distinct: DataFrame, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Links ``a``, ``b`` between the ``node`` numbers of distinct lines within ``EDITS`` edits:
    enough of them that all such lines hang together, and none but between such lines.

    The hashed keys of all lines first show which lines share a key with any other; only
    their texts are fetched, and their pairs compared, first by character counts in the join.
    Lines of dense groups are linked to the first of their group; other pairs are then
    compared only if they do not hang together already.
    """
    needed = written(_needed(distinct), "line-needed")
    if needed.count() <= FEW_LINES:
        needed = F.broadcast(needed)
    lines = occurrences(docs, id, text).select("h1", "h2", "line").join(needed, ["h1", "h2"])
    texts = lines.groupBy("node").agg(F.first("line").alias("line"))
    texts = written(texts.withColumn("sig", signature(F.col("line"))), "line-texts")
    settle(docs.sparkSession)
    pairs, dense = _candidates(texts)
    if dense is None:
        return _near(pairs, texts)
    dense = written(dense, "line-dense")
    own = dense.where("side = 0")
    firsts = own.groupBy("path").agg(F.min("node").alias("b"))
    spokes = own.join(firsts, "path").where("node > b").select(F.col("node").alias("a"), "b").distinct()
    sure = written(_near(spokes, texts), "line-sure")
    known = written(connected_components(sure, "line-dense-groups"), "line-known")

    def group(node: str) -> DataFrame:
        return known.select(F.col("node").alias(node), F.col("component").alias(f"of_{node}"))

    # Of a dense group only those rows meet that do not all hang together.
    placed = dense.join(group("node"), "node", "left").withColumn("of_node", F.coalesce("of_node", "node"))
    whole = (
        placed.where("side = 0")
        .groupBy("path")
        .agg(F.min("of_node").alias("low"), F.max("of_node").alias("high"))
    )
    loose = placed.where("side = 1").join(whole, "path").where("low < high or of_node <> low")
    every = written(pairs.union(_pairs(own, loose, "path")).distinct(), "line-pairs")
    apart = (
        every.join(group("a"), "a", "left")
        .join(group("b"), "b", "left")
        .where(~F.coalesce(F.col("of_a") == F.col("of_b"), F.lit(False)))
    )
    return sure.union(_near(apart.select("a", "b"), texts))


def dropped_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``tie`` and the ``places`` (line numbers from 0) to drop, for documents with any."""
    # A line is known by both of its hashes, and in links by a number of its own.
    distinct = distinct_lines(docs, id, text).withColumn("node", F.monotonically_increasing_id())
    distinct = written(distinct, "line-firsts")
    settle(docs.sparkSession)
    groups = connected_components(near_line_links(distinct, docs, id, text), "line-groups")
    grouped = distinct.select("node", "h1", "h2", "first", "n").join(groups, "node", "left")
    alone = grouped.where("component is null and n > 1").select("h1", "h2", "first")
    several = grouped.where("component is not null")
    first = several.groupBy("component").agg(F.min("first").alias("first"))
    joint = several.drop("first").join(first, "component").select("h1", "h2", "first")
    classes = written(alone.union(joint), "line-classes")
    settle(docs.sparkSession)
    lines = occurrences(docs, id, text).drop("line")
    place = _place(dict(lines.dtypes)["id"])
    later = lines.join(classes, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("id", "tie").agg(F.collect_set("pos").alias("places"))


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every line dropped that is the same as an earlier one or, in turn,
    within ``EDITS`` edits of one that hangs together with it.

    Earlier means a smaller ``id`` (null ids last), then line number. Lines are compared
    without outer white space; those shorter than ``MIN_CHARS`` characters stay. All rows
    stay, also those that have no line left: their text is empty. Null texts stay null.
    Rows that repeat both id and text get the same result. Adds ``n_dropped`` (int).
    """
    dropped = dropped_lines(docs, id, text).select(
        F.col("id").alias("_id"), F.col("tie").alias("_tie"), F.col("places").alias("_places")
    )
    columns = [c for c in docs.columns if c != "n_dropped"]
    joined = docs.select(*columns).join(
        dropped, F.col(id).eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_tie")), "left"
    )
    left = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("_places", i))
    short = F.when(F.col("_places").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return joined.select(
        *[short.alias(c) if c == text else F.col(c) for c in columns],
        F.coalesce(F.size("_places"), F.lit(0)).alias("n_dropped"),
    )
