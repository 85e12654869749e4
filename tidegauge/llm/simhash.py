"""SimHash near-duplicates by anchor points of a covering code.

The anchors are the words of a product of binary Golay codes over the first bits of the
fingerprint. Every point lies within the covering radius R of some anchor (3 for each
code, which is perfect), so two fingerprints that differ in at most t bits meet at the
anchor nearest to either, if each is sent to every anchor within R + t. At each anchor
the whole fingerprints are compared.

Two codes give 2 ** 24 anchors and about 60 copies of a fingerprint, which suits some
hundred million distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import connected_components, grouped, runs, with_row_ids, written

SEED = 42
CODE_BITS = 23
CODE_RADIUS = 3
CODES = 2
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a generator of the binary Golay code.
GENERATOR = 0b101011100011


def fingerprint(text: str, words_in_shingle: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    span = min(words_in_shingle, len(words))
    begin = (end - length)[: len(words) - span + 1].tolist()
    whole = memoryview(joined)
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(whole[a:b], SEED) for a, b in zip(begin, end[span - 1 :].tolist(), strict=True)],
        np.uint64,
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        octets = hashes[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """``id`` and ``fp`` (the fingerprint as a signed long) of every row; a text without
    words, an empty or a null one has fingerprint zero. Nothing is shuffled."""
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [fingerprint(t.as_py() or "", words) for t in batch.column(1)]
            fp = pa.array(np.array(own, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], ["id", "fp"])

    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, fp long")


def syndromes(values: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words, as polynomials over GF(2), by the generator."""
    out = values.astype(np.int64)
    for bit in range(CODE_BITS - 1, 10, -1):
        out = np.where(out >> bit & 1, out ^ GENERATOR << bit - 11, out)
    return out


@lru_cache(maxsize=4)
def _patterns(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit patterns of up to ``most`` bits in the order of (syndrome, number of bits), and
    where those of each syndrome and number begin."""
    found, sizes = [], []
    for k in range(most + 1):
        own = np.zeros(1, np.int64)
        if k:
            bits = np.array(list(combinations(range(CODE_BITS), k)), np.int64)
            own = (np.int64(1) << bits).sum(axis=1)
        found.append(own)
        sizes.append(np.full(len(own), k))
    pattern, size = np.concatenate(found), np.concatenate(sizes)
    place = syndromes(pattern) * (most + 1) + size
    order = np.argsort(place, kind="stable")
    begin = np.searchsorted(place[order], np.arange(2048 * (most + 1) + 1))
    return pattern[order], begin


def anchors_of(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Every anchor within covering radius plus ``distance`` of each fingerprint, as
    (index of the fingerprint, anchor)."""
    most = CODES * CODE_RADIUS + distance
    pattern, begin = _patterns(most)
    low = (1 << CODE_BITS) - 1
    index = np.arange(len(fps))
    anchor = np.zeros(len(fps), np.int64)
    left = np.full(len(fps), most)
    for code in range(CODES):
        value = (fps.view(np.uint64) >> np.uint64(code * CODE_BITS)).astype(np.int64) & low
        at = syndromes(value) * (most + 1)
        # What later codes need at least is not known here; they drop what cannot fit.
        first, last = begin[at[index]], begin[at[index] + left + 1]
        count = last - first
        grown = np.repeat(np.arange(len(index)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        chosen = pattern[place]
        index, left = index[grown], left[grown] - np.bitwise_count(chosen).astype(np.int64)
        anchor = anchor[grown] | (value[index] ^ chosen) << code * CODE_BITS
    return index, anchor


def _local_links(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``fps``: at most one link for each."""
    n = len(fps)
    if n <= 2048:
        pairs = [(np.arange(n), np.arange(n))]
    else:
        # Cut into distance + 1 parts, one of which is equal in any linked pair.
        pairs = []
        cuts = np.linspace(0, 64, distance + 2).astype(int)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = fps >> np.uint64(a) & np.uint64((1 << int(b - a)) - 1)
            order = np.argsort(part, kind="stable")
            ends = np.flatnonzero(np.append(part[order][1:] != part[order][:-1], True)) + 1
            pairs += [(x, x) for x in np.split(order, ends[:-1]) if len(x) > 1]
    root = np.arange(n)
    for rows, columns in pairs:
        step = max(1, 2_000_000 // len(columns))
        for at in range(0, len(rows), step):
            own = rows[at : at + step]
            near = np.bitwise_count(fps[own][:, None] ^ fps[columns][None, :]) <= distance
            i, j = np.nonzero(near)
            a, b = root[own[i]], root[columns[j]]
            new = a != b
            if new.any():
                root = grouped(a[new], b[new], n)[root]
    child = np.flatnonzero(root != np.arange(n))
    return child, root[child]


def links(distinct: DataFrame, distance: int = 2, fp: str = "fp") -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints, enough of them to connect all
    that differ in at most ``distance`` bits, directly or in turn."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for at in range(0, len(fps), 4096):
                index, anchor = anchors_of(fps[at : at + 4096], distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(fps[at : at + 4096][index])], ["bucket", "fp"]
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            signed = run.column("fp").to_numpy()
            child, root = _local_links(signed.view(np.uint64), distance)
            if len(child):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed[child]), pa.array(signed[root])], ["a", "b"]
                )

    at_anchors = distinct.select(F.col(fp).alias("fp")).mapInArrow(spread, "bucket long, fp long")
    met = at_anchors.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2
) -> DataFrame:
    """``id``, ``fp`` and ``component_id`` of every row: the smallest id reachable over
    links of at most ``distance`` differing bits, its own included.

    Texts with equal fingerprints are one point with its smallest id, so a group of
    copies of any size is one row in the search. Rows with a null id take part; their
    component has the smallest id that is not null (null if there is none). Repeated rows
    are kept, an empty table gives an empty result, further columns are ignored.
    """
    own = written(fingerprints(docs, id, text, words), "fingerprints")
    points = written(own.groupBy("fp").agg(F.min(id).alias("least")), "fingerprint-points")
    groups = connected_components(links(points, distance), "fingerprint-groups")
    rooted = points.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return own.join(named, "fp").select(id, "fp", "component_id")


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one row left of each group of near-duplicates, the one with the
    smallest ``id`` (null ids last; among equal ids the first row as stored)."""
    columns = docs.columns
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    at = {c: f"c{i}" for i, c in enumerate(columns)}
    stored = with_row_ids(plain, "simhash-rows")
    row = F.struct(F.col(at[id]).isNull().alias("none"), F.col(at[id]).alias("key"), F.col("_row").alias("_row"))
    named = stored.select(row.alias("row"), F.col(at[text]).alias("text"))
    found = near_duplicates(named, "row", "text", words, distance)
    kept = found.where(F.col("row") == F.col("component_id")).select(F.col("row._row").alias("_row"))
    return stored.join(kept, "_row", "left_semi").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]
    )
