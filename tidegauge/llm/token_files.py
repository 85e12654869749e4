"""Token files: raw ids in shards, each with a minimal perfect hash index of its documents.

A file set is a Parquet folder with a row per shard, so Spark's own writer commits it to
any store and a lost executor repeats only its task. A shard holds

* ``payload``: the ids of its documents, one after another, little-endian unsigned
  integers of ``width`` bytes (2 if every id fits, else 4);
* ``keys``, ``nulls``, ``copies``: in document order each one's key (64-bit integer),
  whether it is null, and how many documents with this key came before it in the shard;
* ``shifts``, ``prints``, ``offsets``, ``lengths``: the index. A key's hash picks a shift,
  the shift its slot, and the slot's fingerprint confirms the key before its offset and
  length (in ids) are used, so a lookup takes the same few steps in any shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids in a shard, about; a longer document is a shard of its own.
SHARD_IDS = 1_000_000
END_ID = 0

SCHEMA = (
    "part int, seq int, n_docs int, n_ids long, first_key long, last_key long, width int, "
    "keys binary, nulls binary, copies binary, shifts binary, prints binary, "
    "offsets binary, lengths binary, payload binary"
)


#: What a salt is multiplied by before it is added to a hash.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finalizer: multiply and shift, twice."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def key_hash(keys: np.ndarray, nulls: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """What the index hashes: the key, whether it is null, and the copy number."""
    extra = copies.astype(np.uint64) << np.uint64(1) | nulls.astype(np.uint64)
    with np.errstate(over="ignore"):
        return _mix(keys.astype(np.int64).view(np.uint64), 1) + _mix(extra, 2)


def build_index(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shifts per bucket and the slot of every key, a bijection to 0..n-1.

    Buckets of about three keys, large ones first, take the first shift that puts all of
    their keys on free slots; those of one key get a free slot outright (as -1 - slot).
    """
    n = len(hashes)
    buckets = max(1, n // 3)
    bucket = (_mix(hashes, 3) % np.uint64(buckets)).astype(np.int64)
    shifts = np.zeros(buckets, np.int64)
    slot = np.full(n, -1, np.int64)
    taken = np.zeros(n, bool)
    order = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=buckets)
    begin = np.cumsum(size) - size
    # Shifts are tried in blocks: all keys of a bucket under all shifts of a block at once.
    for b in np.argsort(-size, kind="stable").tolist():
        k = int(size[b])
        if k < 2:
            break
        mine = order[begin[b] : begin[b] + k]
        first, block = 1, 8
        while True:
            tried = np.arange(first, first + block, dtype=np.uint64)
            with np.errstate(over="ignore"):
                salted = hashes[mine] + (np.uint64(3) + tried[:, None]) * GOLDEN
            at = np.sort((_mix(salted, 0) % np.uint64(n)).astype(np.int64), axis=1)
            good = ~taken[at].any(axis=1) & (at[:, 1:] != at[:, :-1]).all(axis=1)
            found = int(good.argmax())
            if good[found]:
                break
            first, block = first + block, 256
        shifts[b] = first + found
        at = (_mix(salted[found], 0) % np.uint64(n)).astype(np.int64)
        slot[mine] = at
        taken[at] = True
    single = np.flatnonzero(size == 1)
    free = np.flatnonzero(~taken)
    shifts[single] = -1 - free
    slot[order[begin[single]]] = free
    return shifts, slot


def find_slots(hashes: np.ndarray, shifts: np.ndarray, n: int) -> np.ndarray:
    """The one slot where each key can be."""
    shift = shifts[(_mix(hashes, 3) % np.uint64(len(shifts))).astype(np.int64)]
    with np.errstate(over="ignore"):
        salted = hashes + (3 + np.maximum(shift, 0)).astype(np.uint64) * GOLDEN
    hashed = (_mix(salted, 0) % np.uint64(n)).astype(np.int64)
    return np.where(shift < 0, -1 - shift, hashed)


@lru_cache(maxsize=2)
def _encoders(library_file: str, ranks_file: str):
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(library_file)
    with open(ranks_file, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    import public_tokenizers

    plain = tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, plain, added


def ids_of(text: str, library_file: str, ranks_file: str) -> np.ndarray:
    """The ids of a text. The rank file holds the same vocabulary and is several times as
    fast; a text with an added token in it, which ranks do not know, goes to the library."""
    tokenizer, plain, added = _encoders(library_file, ranks_file)
    if any(x in text for x in added):
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
    return np.array(plain.encode_ordinary(text), np.uint32)


def _shard(part: int, seq: int, keys: list, ids: list[np.ndarray]) -> dict:
    null = np.array([k is None for k in keys])
    key = np.array([0 if k is None else k for k in keys], np.int64)
    seen: dict = {}
    copies = np.zeros(len(keys), np.int64)
    for i, k in enumerate(keys):
        copies[i] = seen[k] = seen.get(k, -1) + 1
    hashes = key_hash(key, null, copies)
    shifts, slot = build_index(hashes)
    length = np.array([len(x) for x in ids], np.int64)
    offset = np.cumsum(length) - length
    prints, offsets, lengths = (np.zeros(len(keys), t) for t in (np.uint64, np.int64, np.int64))
    prints[slot], offsets[slot], lengths[slot] = _mix(hashes, 0), offset, length
    payload = np.concatenate(ids)
    width = 2 if not len(payload) or payload.max() < 1 << 16 else 4
    named = key[~null]
    return {
        "part": part,
        "seq": seq,
        "n_docs": len(keys),
        "n_ids": int(length.sum()),
        "first_key": int(named.min()) if len(named) else None,
        "last_key": int(named.max()) if len(named) else None,
        "width": width,
        "keys": key.tobytes(),
        "nulls": null.astype(np.uint8).tobytes(),
        "copies": copies.astype("<u4").tobytes(),
        "shifts": shifts.tobytes(),
        "prints": prints.tobytes(),
        "offsets": offsets.tobytes(),
        "lengths": lengths.tobytes(),
        "payload": payload.astype(f"<u{width}").tobytes(),
    }


def write_token_files(
    docs: DataFrame,
    path: str,
    library_file: str,
    ranks_file: str,
    id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encodes every whole text, ends it with ``END_ID`` and writes shards to ``path``.

    Documents lie in ascending order of their key (a 64-bit integer; null keys first;
    rows with one key in the order of their text's hash), shards in the order of (part,
    seq). A null or empty text is the end id alone; repeated rows are written each; an
    empty table gives no shard. One range shuffle of the texts; a task holds one shard.
    """
    ordered = docs.select(F.col(id).cast("long").alias("key"), F.col(text).alias("text"))
    ordered = ordered.withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie")
    schema = pa.schema(
        [
            (name, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[kind])
            for name, kind in (x.split() for x in SCHEMA.split(", "))
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seq, keys, ids, held = 0, [], [], 0
        end = np.array([END_ID], np.uint32)

        def shard():
            return pa.RecordBatch.from_pylist([_shard(part, seq, keys, ids)], schema)

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                own = ids_of(text.as_py() or "", library_file, ranks_file)
                if keys and held + len(own) + 1 > SHARD_IDS:
                    yield shard()
                    seq, keys, ids, held = seq + 1, [], [], 0
                keys.append(key.as_py())
                ids.append(np.concatenate([own, end]))
                held += len(own) + 1
        if keys:
            yield shard()

    ordered.mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The shards of a file set."""
    return spark.read.schema(SCHEMA).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``part``, ``seq`` and how many ids lie in all shards before (``shard_start``).

    Summed in two steps: shards within their part by a window, parts among each other on
    the driver, which sees one number for each part that was written.
    """
    sizes = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    begin, rows = 0, []
    for size in sorted(sizes, key=lambda r: r["part"]):
        rows.append((size["part"], begin))
        begin += size["n"]
    parts = shards.sparkSession.createDataFrame(rows, "part int, part_start long")
    within = shards.selectExpr(
        "part", "seq", "sum(n_ids) over (partition by part order by seq) - n_ids as before"
    )
    return within.join(parts, "part").select(
        "part", "seq", (F.col("part_start") + F.col("before")).alias("shard_start")
    )


def _open(row: dict, part) -> np.ndarray:
    return np.frombuffer(row[part], {"keys": "<i8", "nulls": "u1", "copies": "<u4"}.get(part, "<i8"))


def find(row: dict, keys: np.ndarray, nulls: np.ndarray, copies: np.ndarray):
    """Offsets and lengths of keys in a shard by its index, -1 for those it does not hold."""
    hashes = key_hash(keys, nulls, copies)
    slot = find_slots(hashes, np.frombuffer(row["shifts"], "<i8"), row["n_docs"])
    held = np.frombuffer(row["prints"], "<u8")[slot] == _mix(hashes, 0)
    offset = np.frombuffer(row["offsets"], "<i8")[slot]
    length = np.frombuffer(row["lengths"], "<i8")[slot]
    return np.where(held, offset, -1), np.where(held, length, -1)


def documents_of(shards: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """A row per document, read through the index: ``doc_id``, ``start``, ``n_tokens``,
    ``ids_crc32`` (of its ids as little-endian unsigned 32-bit integers).

    With ``wanted`` only the documents with one of these keys; shards that cannot hold
    any are not opened. Keys that no shard holds give no row. The payload is read where
    it lies; only the rows found are joined with the starts of their shards.
    """
    starts = shard_starts(shards)
    if wanted is not None:
        near = [F.lit(k).between(F.col("first_key"), F.col("last_key")) for k in wanted]
        shards = shards.where(F.exists(F.array(*near), lambda x: x) if near else F.lit(False))
    out = pa.schema(
        [
            ("part", pa.int32()),
            ("seq", pa.int32()),
            ("doc_id", pa.int64()),
            ("at", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_crc32", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                keys, nulls, copies = (_open(row, c) for c in ("keys", "nulls", "copies"))
                if wanted is not None:
                    keys = np.array(wanted, np.int64)
                    nulls, copies = np.zeros(len(keys), np.uint8), np.zeros(len(keys), np.uint32)
                offset, length = find(row, keys, nulls, copies)
                held = offset >= 0
                ids = np.frombuffer(row["payload"], f"<u{row['width']}")
                checks = [
                    zlib.crc32(ids[a : a + n].astype("<u4").tobytes())
                    for a, n in zip(offset[held].tolist(), length[held].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(held.sum(), row["part"]), pa.int32()),
                        pa.array(np.full(held.sum(), row["seq"]), pa.int32()),
                        pa.array(keys[held], pa.int64(), mask=nulls[held].astype(bool)),
                        pa.array(offset[held], pa.int64()),
                        pa.array(length[held], pa.int64()),
                        pa.array(checks, pa.int64()),
                    ],
                    schema=out,
                )

    found = shards.mapInArrow(
        run, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    return found.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
