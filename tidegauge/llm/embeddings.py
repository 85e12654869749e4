"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, rerank.

A rotation is learned on a bounded sample so that the signs of the rotated vectors make
balanced binary codes. Every vector is entered in several tables, each keyed by a choice of
bits of its code. Of the vectors that share a key, those whose whole codes are within a Hamming
radius are retrieved and reranked by the cosine of the original vectors in double
precision. A pair is counted in the first table where it meets.

The key's bits follow the logarithm of the rows of the largest label, so that a bucket does not
grow with the table. The number of tables and the radius follow from neighbours planted
exactly at the threshold around vectors of the sample.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import connected_components, grouped, written

COSINE = 0.93
#: Vectors the rotation is learned on, at most; those with the smallest hash of their
#: digest. Every vector is indexed.
SAMPLE = 20_000
ROUNDS = 30
#: Neighbours planted at the threshold, by which the tables are chosen.
PLANTED = 4_000
#: Share of the planted neighbours that meet in some table, and that are within the radius.
#: Pairs nearer than the threshold meet more often.
MEET, WITHIN = 0.985, 0.9995
#: Rows of the largest label for each value of a key. Testing so many codes costs less than
#: entering a vector in the further tables that longer keys would need.
KEY_ROWS = 32
#: If more tables than this were needed, keys get shorter instead.
MOST_TABLES = 64
#: A key with more vectors is compared in tiles of about so many.
TILE = 512
#: Buckets up to this size are compared many at once, larger ones one by one, in blocks of
#: so many pairs or numbers.
SMALL = 64
BLOCK = 4_000_000


def learn_rotation(sample: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection: principal directions, rotated so that the signs of the
    projected sample lose least (alternating codes and an orthogonal Procrustes fit).

    A sample smaller than the dimension still gives a full rotation."""
    dim = sample.shape[1]
    mean = sample.mean(axis=0) if len(sample) else np.zeros(dim)
    centred = sample - mean
    directions = np.linalg.svd(centred.T @ centred)[0] if len(sample) else np.eye(dim)
    projected = centred @ directions
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))[0]
    for _ in range(ROUNDS if len(sample) else 0):
        codes = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(codes.T @ projected)
        rotation = (left @ right).T
    return mean, directions @ rotation


def key_bits(dim: int, width: int, tables: int) -> list[list[int]]:
    """The bits of each table's key: as many different ones as there are, dealt anew
    from a fixed shuffle whenever they run out."""
    deal, out, left = random.Random(7), [], []
    for _ in range(tables):
        if len(left) < width:
            left = list(range(dim))
            deal.shuffle(left)
        out.append(sorted(left[:width]))
        left = left[width:]
    return out


@dataclass
class Index:
    """How vectors of one dimension are coded and entered: ``mean`` and ``turn`` make the code,
    ``tables`` are the bits of the keys, ``radius`` bounds the distance of whole codes."""

    mean: np.ndarray
    turn: np.ndarray
    tables: list[list[int]]
    radius: int

    def signs(self, unit: np.ndarray) -> np.ndarray:
        return (unit - self.mean) @ self.turn >= 0

    @cached_property
    def masks(self) -> np.ndarray:
        """Each table's bits in a packed code."""
        bits = np.zeros((len(self.tables), len(self.mean)), bool)
        for t, own in enumerate(self.tables):
            bits[t, own] = True
        return packed(bits)


def packed(signs: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    spare = -signs.shape[1] % 64
    whole = np.packbits(np.pad(signs, ((0, 0), (0, spare))), axis=1)
    return np.ascontiguousarray(whole).view(np.uint64)


def learn_index(sample: np.ndarray, dim: int, rows: int, cosine: float) -> Index:
    """An index for unit vectors like ``sample`` when the largest label has ``rows`` of them.

    Without a sample the vectors' own axes are the directions, and the tables are chosen for
    random vectors; the outcome is the same wherever it is computed.
    """
    rng = np.random.default_rng(5)
    if len(sample):
        mean, turn = learn_rotation(sample)
        near = sample[:PLANTED]
    else:
        mean, turn = np.zeros(dim), np.eye(dim)
        near = _unit(rng.normal(size=(PLANTED // 4, dim)))
    near = np.repeat(near, -(-PLANTED // len(near)), axis=0)[:PLANTED]
    # Turned by the threshold's angle in a random direction.
    aside = rng.normal(size=near.shape)
    aside -= (aside * near).sum(axis=1, keepdims=True) * near
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    aside = np.divide(aside, length, out=np.zeros_like(aside), where=length > 1e-9)
    turned = cosine * near + math.sqrt(max(0.0, 1 - cosine**2)) * aside
    index = Index(mean, turn, [], dim)
    differ = index.signs(near) != index.signs(turned)
    radius = int(np.quantile(differ.sum(axis=1), WITHIN, method="higher"))
    width = min(dim, max(1, math.ceil(math.log2(max(rows / KEY_ROWS, 2)))))
    while True:
        tables = key_bits(dim, width, MOST_TABLES)
        met = np.array([~differ[:, own].any(axis=1) for own in tables])
        share = np.logical_or.accumulate(met, axis=0).mean(axis=1)
        enough = np.flatnonzero(share >= MEET)
        if len(enough) or width == 1:
            needed = int(enough[0]) + 1 if len(enough) else MOST_TABLES
            return Index(mean, turn, tables[:needed], radius)
        width -= 1


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid_vectors(rows: DataFrame, id: str, vec: str, label: str) -> DataFrame:
    """One row per distinct vector of a label: ``label``, ``vec`` (floats stay floats, others become
    doubles), ``rep`` (the smallest id), ``copies``, ``digest``. Left out are vectors without a label, null or
    zero ones and those with a component that is null or not finite."""
    values = F.col(vec).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(values, lambda x: x != 0)
    digest = F.sha2(F.array_join(F.col(vec).cast("array<string>"), ","), 256)
    kind = "array<float>" if dict(rows.dtypes)[vec] == "array<float>" else "array<double>"
    good = rows.where(F.col(label).isNotNull() & F.col(vec).isNotNull() & finite & some).select(
        F.col(id).alias("id"), F.col(label).alias("label"), F.col(vec).cast(kind).alias("vec"), digest.alias("digest")
    )
    return good.groupBy("label", "digest").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.any_value("vec").alias("vec")
    )


class Indexes:
    """An index per dimension; one that the sample did not show is made where it is needed."""

    def __init__(self, distinct: DataFrame, cosine: float):
        largest = distinct.groupBy("label").count().agg(F.max("count")).first()[0]
        self.rows, self.cosine, self.known = largest or 0, cosine, {}
        sample = (
            distinct.select(F.size("vec").alias("dim"), "vec", F.xxhash64("digest").alias("at"))
            .orderBy("at")
            .limit(SAMPLE)
            .toArrow()
        )
        dims = sample.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = sample.filter(pa.array(dims == dim)).column("vec")
            self.known[dim] = learn_index(_unit(_matrix(own, dim)), dim, self.rows, cosine)

    def of(self, dim: int) -> Index:
        if dim not in self.known:
            self.known[dim] = learn_index(np.zeros((0, dim)), dim, self.rows, self.cosine)
        return self.known[dim]


def _entries(distinct: DataFrame, indexes: Indexes) -> DataFrame:
    """A row per vector and table: ``bucket`` (a hash of label, dimension, table and key,
    and of the tile if the bucket is large), ``side``, and what is compared."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column("vec")).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dim))
                index = indexes.of(dim)
                signs = index.signs(_unit(_matrix(part.column("vec"), dim)))
                n, code = part.num_rows, packed(signs)
                code = pa.FixedSizeListArray.from_arrays(pa.array(code.view(np.int64).ravel()), code.shape[1])
                for t, bits in enumerate(index.tables):
                    key = signs[:, bits].astype(np.int64) @ (np.int64(1) << np.arange(len(bits)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("label"),
                            pa.array(np.full(n, dim), pa.int32()),
                            pa.array(np.full(n, t), pa.int32()),
                            pa.array(key),
                            part.column("rep"),
                            part.column("copies"),
                            code.cast(pa.list_(pa.int64())),
                            part.column("vec"),
                        ],
                        names,
                    )

    kinds = dict(distinct.dtypes)
    names = ["label", "dim", "tab", "key", "rep", "copies", "code", "vec"]
    entered = distinct.select("label", "rep", "copies", "vec").mapInArrow(
        enter,
        f"label {kinds['label']}, dim int, tab int, key long, rep {kinds['rep']}, copies long, "
        f"code array<long>, vec {kinds['vec']}",
    )
    at = ["label", "dim", "tab", "key"]
    large = (
        entered.groupBy(*at)
        .count()
        .where(F.col("count") > 2 * TILE)
        .select(*at, F.ceil(F.col("count") / TILE).alias("tiles"))
    )
    # Written, so that its size is known before the join: vectors move for it only if it is large.
    large = written(large, "vector-keys")
    tiled = entered.join(large, at, "left")
    # Tile (i, j), i <= j, holds block i and block j; a vector of block b is in all with b.
    own = F.pmod(F.xxhash64("rep"), F.col("tiles"))
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("tiles"), F.lit(1)) - 1))
    tiled = tiled.withColumn("own", F.coalesce(own, F.lit(0))).withColumn("other", spread)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return tiled.select(
        F.xxhash64(*at, low, high).alias("bucket"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        F.col("tab"),
        F.hash("label").alias("label_hash"),
        "rep",
        "copies",
        "code",
        "vec",
    )


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in the order given, cut between buckets only."""
    held: list[pa.RecordBatch] = []  # the bucket that may go on
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(bucket, bucket[-1]))
        if held and held[0].column("bucket")[0].as_py() == bucket[0]:
            if last == 0:
                held.append(batch)
                continue
        elif last == 0:
            if held:
                yield pa.Table.from_batches(held)
            held = [batch]
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _met(bucket: np.ndarray, code: np.ndarray, radius: int):
    """Pairs i, j of rows of one bucket, those of large buckets within the radius only: rows of
    small buckets by their distance in the sorted order, large buckets in blocks."""
    cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    begin = np.concatenate([[0], cuts])
    size = np.diff(np.concatenate([begin, [len(bucket)]]))
    small = np.repeat(size <= SMALL, size)
    for ahead in range(1, int(size[size <= SMALL].max(initial=0))):
        i = np.flatnonzero((bucket[ahead:] == bucket[:-ahead]) & small[ahead:])
        yield i, i + ahead
    for first, n in zip(begin[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
        step = max(1, BLOCK // n)
        every = np.arange(first, first + n)
        for k in range(0, n, step):
            own = every[k : k + step]
            distance = np.zeros((len(own), n), np.int16)
            for word in code.T:
                distance += np.bitwise_count(word[own][:, None] ^ word[every][None])
            i, j = np.nonzero(distance <= radius)
            i, j = own[i], every[j]
            yield i[i < j], j[i < j]


def _linked(rows: pa.Table, index: Index, cosine: float):
    """Pairs i, j of these rows, all of one dimension, that are linked and meet here first."""
    tab, side, label, bucket = (rows.column(c).to_numpy() for c in ("tab", "side", "label_hash", "bucket"))
    code = rows.column("code").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1).view(np.uint64)
    unit = _unit(_matrix(rows.column("vec"), len(index.mean)))
    for i, j in _met(bucket, code, index.radius):
        # A bucket is a hash: rows that only share the hash are told apart here. Of two
        # blocks of a tile only rows of different blocks are compared.
        own = (tab[i] == tab[j]) & (label[i] == label[j]) & ((side[i] == 2) | (side[i] != side[j]))
        i, j = i[own], j[own]
        apart = code[i] ^ code[j]
        near = np.bitwise_count(apart).sum(axis=1) <= index.radius
        # The key of this table is the same, that of none before it.
        near &= ~(apart & index.masks[tab[i]]).any(axis=1)
        i, j, apart = i[near], j[near], apart[near]
        for t in range(int(tab[i].max(initial=0))):
            new = (tab[i] <= t) | (apart & index.masks[t]).any(axis=1)
            i, j, apart = i[new], j[new], apart[new]
        step = max(1, BLOCK // len(index.mean))
        for k in range(0, len(i), step):
            a, b = i[k : k + step], j[k : k + step]
            linked = np.einsum("nd,nd->n", unit[a], unit[b]) >= cosine
            yield a[linked], b[linked]


def link_counts(entries: DataFrame, indexes: Indexes) -> DataFrame:
    """``rep``, ``root``, ``n``: for each vector of a bucket with a link there, another one that
    it hangs together with, and the vectors linked to it first there, copies included."""
    kind = dict(entries.dtypes)["rep"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_runs(batches):
            dims = pa.compute.list_value_length(whole.column("vec")).to_numpy()
            for dim in np.unique(dims).tolist():
                part = whole.filter(pa.array(dims == dim))
                copies, n = part.column("copies").to_numpy(), part.num_rows
                counts, root = np.zeros(n, np.int64), np.arange(n)
                for i, j in _linked(part, indexes.of(dim), indexes.cosine):
                    np.add.at(counts, i, copies[j])
                    np.add.at(counts, j, copies[i])
                    a, b = root[i], root[j]
                    apart = a != b
                    if apart.any():
                        root = grouped(a[apart], b[apart], n)[root]
                some = np.flatnonzero(counts)
                if len(some):
                    rep = part.column("rep").combine_chunks()
                    yield pa.RecordBatch.from_arrays(
                        [rep.take(pa.array(some)), rep.take(pa.array(root[some])), pa.array(counts[some])],
                        ["rep", "root", "n"],
                    )

    met = entries.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(compare, f"rep {kind}, root {kind}, n long")


def near_duplicates(
    rows: DataFrame,
    id: str = "vec_id",
    vec: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """``id``, ``n_links``, ``component_id``, ``kept`` of every row.

    Rows are compared only within a label that is not null. A vector that is null, empty, zero or holds a
    null or non-finite component links with nothing, as does one of another length. Equal vectors are one in
    the search and count as links of each other. No link is below ``cosine``; some pair at or above it may
    be missed by the tables (see ``MEET``). ``id`` is an integer; a row whose id is null links with
    nothing. Repeated rows count each, an empty table gives an empty result.
    """
    named = rows.select(F.col(id).alias("id"), F.col(vec).alias("vec"), F.col(label).alias("label"))
    distinct = written(
        valid_vectors(named.where("id is not null"), "id", "vec", "label"), "vectors"
    )
    indexes = Indexes(distinct, cosine)
    found = written(link_counts(_entries(distinct, indexes), indexes), "vector-links")
    groups = connected_components(
        found.select(F.col("rep").cast("long").alias("a"), F.col("root").cast("long").alias("b")), "vector-groups"
    )
    counts = found.groupBy("rep").agg(F.sum("n").alias("linked"))
    each = (
        distinct.select("label", "digest", "rep", "copies")
        .join(counts, "rep", "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("label").alias("of_label"),
            F.col("digest").alias("of_digest"),
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", F.col("rep").cast("long")).alias("component_id"),
        )
    )
    digest = F.sha2(F.array_join(F.col("vec").cast("array<string>"), ","), 256)
    joined = named.select("id", "label", digest.alias("digest")).join(
        each,
        F.col("id").isNotNull() & (F.col("label") == F.col("of_label")) & (F.col("digest") == F.col("of_digest")),
        "left",
    )
    component = F.coalesce("component_id", F.col("id").cast("long"))
    return joined.select(
        F.col("id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
