"""Text scoring with a hierarchical Pitman-Yor language model.

Every word that precedes another is a context, and every context a restaurant whose
customers are the training tokens after it and whose tables serve one word each. A table
is a customer of the parent restaurant, which all contexts share; its own parent is the
uniform distribution over the known words and one unknown. Seating is sampled by Gibbs:
a sweep draws, for each word of a context, at how many tables its customers sit, given
the other tables of the context and the parent (the exact conditional, with generalised
Stirling numbers). All words of a sweep are drawn at once from the totals of the sweep
before, summed over all buckets: a parallel update. The predictive probabilities are
averaged over the sweeps after the first ones.

The work moves in packed rows. Texts become chunks of word numbers; distinct word pairs
of a chunk go to buckets by context, and what a bucket learns comes back to the chunk in
the same order. A context with a large share of all tokens is dealt to several buckets
by its next words. Words are known by 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import remove, shared_folder

DISCOUNT, STRENGTH = 0.75, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.75, 1.0
BURN_IN, SWEEPS = 3, 4
#: Tokens in a chunk, about; a longer text is a chunk of its own.
CHUNK_TOKENS = 1_000_000
#: Tokens for each bucket of pairs and of words. Their numbers follow from the input.
BUCKET_TOKENS = 1_000_000
WORD_BUCKET_TOKENS = 4_000_000
#: Buckets, or ranges of words, for each task of a sweep: what they hold by then is small.
SWEEP_BUCKETS = 8
#: Counts up to this one are drawn from the exact table of Stirling numbers; larger ones
#: seat the customers beyond it in blocks of a thirty-second of those seated.
EXACT_COUNT = 64

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The word after the last of each text, and the context of the first. No word is empty.
END = b""


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def tokens_of(text: str) -> list[bytes]:
    """Words in lower case (A-Z only), then the end."""
    return [*text.encode("utf-8", "surrogatepass").lower().split(), END]


def _chunk(ids: list, held: list[bool], lengths: list[int], numbers: _Numbers, words: list[np.ndarray]) -> dict:
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in numbers], np.uint64)
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    tokens = rank[np.concatenate(words)].astype(np.uint32)
    return {
        "ids": ids,
        "held": held,
        "lengths": lengths,
        "n_tokens": len(tokens),
        "n_train": int(np.array(lengths)[~np.array(held)].sum()),
        "words": _ascending(hashes[order]),
        "tokens": zstandard.compress(tokens.tobytes()),
        "end": int(rank[numbers[END]]),
    }


def chunks(docs: DataFrame, id: str, text: str) -> DataFrame:
    """The texts as packed rows: ids, whether each is held out, its number of tokens, the
    hashes of the distinct words in ascending order, and every token's place among them."""
    kind = docs.schema[id].dataType.simpleString()
    check = F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")))
    named = docs.select(F.col(id).alias("id"), (check % 5 == 1).alias("held"), F.col(text).alias("text"))
    schema = (
        f"chunk long, ids array<{kind}>, held array<boolean>, lengths array<long>, n_tokens long, "
        "n_train long, words binary, tokens binary, end long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, held, lengths, words, numbers, total = [], [], [], [], _Numbers(), 0
        out = None
        for batch in batches:
            if out is None:
                out = pa.schema(
                    [
                        ("chunk", pa.int64()),
                        ("ids", pa.list_(batch.schema.field(0).type)),
                        ("held", pa.list_(pa.bool_())),
                        ("lengths", pa.list_(pa.int64())),
                        ("n_tokens", pa.int64()),
                        ("n_train", pa.int64()),
                        ("words", pa.binary()),
                        ("tokens", pa.binary()),
                        ("end", pa.int64()),
                    ]
                )
            for key, out_of, value in zip(*batch.columns, strict=True):
                own = np.array(list(map(numbers.__getitem__, tokens_of(value.as_py() or ""))), np.int64)
                ids.append(key.as_py())
                held.append(out_of.as_py())
                lengths.append(len(own))
                words.append(own)
                total += len(own)
                if total >= CHUNK_TOKENS:
                    row = {"chunk": part << 32 | seq, **_chunk(ids, held, lengths, numbers, words)}
                    yield pa.RecordBatch.from_pylist([row], out)
                    seq += 1
                    ids, held, lengths, words, numbers, total = [], [], [], [], _Numbers(), 0
        if ids:
            row = {"chunk": part << 32 | seq, **_chunk(ids, held, lengths, numbers, words)}
            yield pa.RecordBatch.from_pylist([row], out)

    return named.mapInArrow(run, schema)


def _tokens(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), np.uint32)


def _packed(values: np.ndarray) -> bytes:
    """Byte by byte, all first bytes before all second ones: small numbers pack well."""
    width = values.dtype.itemsize
    return zstandard.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes())


def _unpacked(packed: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    plain = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.ascontiguousarray(plain.reshape(width, -1).T).view(kind).reshape(-1)


def _ascending(values: np.ndarray) -> bytes:
    return _packed(np.diff(values, prepend=values.dtype.type(0)))


def _from_ascending(packed: bytes, kind: type) -> np.ndarray:
    return np.cumsum(_unpacked(packed, kind), dtype=kind)


class Chunk:
    """A chunk read back, with its distinct pairs in the order in which buckets see them."""

    def __init__(self, row: dict, buckets: int, hot: dict[int, int]):
        self.words = _from_ascending(row["words"], np.uint64)
        self.tokens = _tokens(row["tokens"]).astype(np.int64)
        self.lengths = np.array(row["lengths"], np.int64)
        self.held = np.array(row["held"], bool)
        self.text = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.train = ~self.held[self.text]
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = row["end"]
        before <<= 32
        before |= self.tokens
        code, self.pair = np.unique(before, return_inverse=True)
        del before
        self.context, self.word = code >> 32, code & 0xFFFFFFFF
        u, w = self.words[self.context], self.words[self.word]
        bucket = (u >> np.uint64(7)) % np.uint64(buckets)
        if hot:
            # The next words of a frequent context go to neighbouring buckets in turn.
            names = np.array(sorted(hot), np.uint64)
            parts = np.array([hot[int(x)] for x in names], np.uint64)
            at = np.minimum(np.searchsorted(names, u), len(names) - 1)
            split = names[at] == u
            step = (w >> np.uint64(20)) % parts[at]
            bucket = np.where(split, (bucket + step) % np.uint64(buckets), bucket)
        self.bucket = bucket.astype(np.int64)
        self.order = np.argsort(self.bucket, kind="stable")  # within a bucket by context and word

    def pair_rows(self) -> Iterator[dict]:
        """A row for each bucket; what stands token by token is let go before."""
        counts = np.bincount(self.pair[self.train], minlength=len(self.context)).astype(np.uint32)
        del self.pair, self.train, self.tokens, self.text
        ordered = self.bucket[self.order]
        edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        for a, b in zip(edges, [*edges[1:], len(ordered)], strict=True):
            own = self.order[a:b]
            context, runs = np.unique(self.context[own], return_counts=True)
            names, word = np.unique(self.words[self.word[own]] >> np.uint64(16), return_inverse=True)
            yield {
                "bucket": int(ordered[a]),
                "contexts": _ascending(self.words[context]),
                "runs": _packed(runs.astype(np.uint32)),
                "names": _ascending(names),
                "word": _ascending(word.astype(np.uint32)),
                "counts": _packed(counts[own]),
            }


def _stirling(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(c, t), up to ``EXACT_COUNT``."""
    out = np.full((EXACT_COUNT + 1, EXACT_COUNT + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(EXACT_COUNT):
        t = np.arange(1, c + 2)
        stay = np.log(np.maximum(c - discount * t, 1e-300)) + out[c, 1 : c + 2]
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c, 0 : c + 1], np.where(t <= c, stay, -np.inf))
    return out


def draw_tables(
    counts: np.ndarray,
    others: np.ndarray,
    parent: np.ndarray,
    discount: float,
    strength: float,
    stirling: np.ndarray,
    rng: np.random.Generator,
) -> np.ndarray:
    """Numbers of tables for ``counts`` customers of a word each, given how many other
    tables the restaurant has and the parent's probability of the word."""
    tables = (counts > 0).astype(np.int64)
    capped = np.minimum(counts, EXACT_COUNT)
    order = np.argsort(capped, kind="stable")
    edges = np.searchsorted(capped[order], np.arange(2, EXACT_COUNT + 2))
    for c, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True), start=2):
        for at in range(a, b, 200_000):
            own = order[at : min(b, at + 200_000)]
            k = np.arange(c)
            opened = strength + discount * (others[own][:, None] + k)
            weight = np.cumsum(np.log(opened * parent[own][:, None]), axis=1) + stirling[c, 1 : c + 1]
            weight = np.exp(weight - weight.max(axis=1, keepdims=True))
            level = np.cumsum(weight, axis=1)
            drawn = rng.random(len(own)) * level[:, -1]
            tables[own] = 1 + (level < drawn[:, None]).sum(axis=1)
    many = np.flatnonzero(counts > EXACT_COUNT)
    seated = np.full(len(many), EXACT_COUNT)
    while len(many):
        block = np.minimum(counts[many] - seated, np.maximum(1, seated // 32))
        t = tables[many]
        fresh = (strength + discount * (others[many] + t)) * parent[many]
        tables[many] = t + rng.binomial(block, fresh / (fresh + seated - discount * t))
        seated = seated + block
        left = seated < counts[many]
        many, seated = many[left], seated[left]
    return tables


def _word_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """By ranges of the hash, so words in ascending order come bucket by bucket."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


LEARNT = "kind string, chunk long, bucket int, words binary, x binary, y binary, n long, v long, k double, t double"
_LEARNT = pa.schema(
    [
        ("kind", pa.string()),
        ("chunk", pa.int64()),
        ("bucket", pa.int32()),
        ("words", pa.binary()),
        ("x", pa.binary()),
        ("y", pa.binary()),
        ("n", pa.int64()),
        ("v", pa.int64()),
        ("k", pa.float64()),
        ("t", pa.float64()),
    ]
)


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist([{c: r.get(c) for c in _LEARNT.names} for r in rows], _LEARNT)


def _told(seat, *given):
    """``seat`` of a group with what is given, as a function of the group alone."""
    return lambda group: _table(seat(group, *given))


#: What a bucket keeps of its restaurants between sweeps, and a range of words of the parent.
#: Of each sample that counts the tables per context, and per word with those of the parent.
_STATE = {
    "names": np.uint64, "runs": np.uint32, "base": np.uint32, "words": np.uint64, "word": np.uint32,
    "counts": np.uint32, "tables": np.uint32, "sums": np.uint32,
    **{f"in_all{s}": np.uint32 for s in range(SWEEPS)},
}
_RANGE = {
    "words": np.uint64, "base": np.int64, "roots": np.uint32,
    **{f"{c}{s}": np.int64 for c in ("served", "roots") for s in range(SWEEPS)},
}


_ORDERED = {"names", "words", "word"}


def _held(kinds: dict, **arrays: np.ndarray) -> bytes:
    packed = [(_ascending if c in _ORDERED else _packed)(arrays[c].astype(k)) for c, k in kinds.items()]
    return b"".join(len(x).to_bytes(8, "little") + x for x in packed)


def _read(kinds: dict, held: bytes) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for c, kind in kinds.items():
        size = int.from_bytes(held[at : at + 8], "little")
        out[c] = (_from_ascending if c in _ORDERED else _unpacked)(held[at + 8 : at + 8 + size], kind)
        at += 8 + size
    return out


def _by_range(kind: str, bucket: int, known: np.ndarray, value: np.ndarray, word_buckets: int) -> Iterator[dict]:
    """A row for each range of words, for ascending hashes; ``value`` has one number for each
    hash, or a row of them for each sample."""
    edges = np.searchsorted(_word_bucket(known, word_buckets), np.arange(word_buckets + 1))
    for b in range(word_buckets):
        a, z = edges[b], edges[b + 1]
        if z > a:
            yield {"kind": kind, "chunk": bucket, "bucket": b, "words": _ascending(known[a:z]), "x": _packed(value[..., a:z])}


def _state_rows(bucket: int, state: dict[str, np.ndarray], word_buckets: int, hot: dict[int, int]) -> list[dict]:
    """The restaurants of a bucket for its next sweep, and their tables: per word for the
    ranges of words, per dealt context for all buckets that have a part of it."""
    out = [{"kind": "state", "bucket": bucket, "x": _held(_STATE, **state)}]
    served = np.bincount(state["word"], weights=state["tables"], minlength=len(state["words"]))
    out += _by_range("served", bucket, state["words"], served.astype(np.uint32), word_buckets)
    if hot:
        context = np.repeat(np.arange(len(state["names"])), state["runs"])
        in_all = np.bincount(context, weights=state["tables"], minlength=len(state["names"]))
        out += _hot_rows("hot", state["names"], in_all, hot)
    return out


def _hot_rows(kind: str, names: np.ndarray, tables: np.ndarray, hot: dict[int, int]) -> list[dict]:
    at = np.flatnonzero(np.isin(names, np.array(list(hot), np.uint64)))
    return [{"kind": kind, "n": int(names[k].view(np.int64)), "v": int(tables[k])} for k in at]


def open_bucket(group: pa.Table, word_buckets: int, hot: dict[int, int]) -> list[dict]:
    """Merges the pairs of a bucket. One customer sits at one table whatever is drawn, so
    only pairs of two or more are left open for the sweeps; of the others the numbers per
    word and per context are given once. For each chunk, where its pairs are found."""
    rows = sorted(group.to_pylist(), key=lambda r: r["chunk"])
    bucket = rows[0]["bucket"]
    contexts = np.concatenate([_from_ascending(r["contexts"], np.uint64) for r in rows])
    runs = np.concatenate([_unpacked(r["runs"], np.uint32) for r in rows])
    words = np.concatenate(
        [_from_ascending(r["names"], np.uint64)[_from_ascending(r["word"], np.uint32)] for r in rows]
    )
    each = [_unpacked(r["counts"], np.uint32) for r in rows]
    chunk_sizes = [(r["chunk"], len(c)) for r, c in zip(rows, each, strict=True)]
    counts = np.concatenate(each)
    del rows, each
    names, context = np.unique(contexts, return_inverse=True)
    context = np.repeat(context, runs)
    words, word = np.unique(words, return_inverse=True)
    words = words << np.uint64(16)
    code, place = np.unique(context << 32 | word, return_inverse=True)
    customers = np.bincount(place, weights=counts, minlength=len(code)).astype(np.int64)
    context, word = code >> 32, code & 0xFFFFFFFF
    several = customers > 1
    kind, number = np.minimum(customers, 2).astype(np.uint8), np.cumsum(several) - 1
    out, at = [], 0
    for chunk, size in chunk_sizes:
        own = place[at : at + size]
        at += size
        shown = kind[own]
        found = number[own[shown == 2]].astype(np.int32)
        out.append({"kind": "places", "chunk": chunk, "bucket": bucket, "x": _packed(shown), "y": _ascending(found)})
    once_served = np.bincount(word[customers == 1], minlength=len(words))
    once_in = np.bincount(context[customers == 1], minlength=len(names))
    some = once_served > 0
    out += _by_range("once", bucket, words[some], once_served[some].astype(np.uint32), word_buckets)
    some = once_in > 0
    out += _by_range("tables once", bucket, names[some], once_in[some].astype(np.uint32), word_buckets)
    if hot:
        out += _hot_rows("hot once", names, once_in, hot)
    if several.any():
        known_names, context = np.unique(context[several], return_inverse=True)
        known_words, word = np.unique(word[several], return_inverse=True)
        state = {
            "names": names[known_names],
            "runs": np.bincount(context),
            "base": once_in[known_names],
            "words": words[known_words],
            "word": word,
            "counts": customers[several],
            "tables": np.ones(len(word), np.int64),
            "sums": np.zeros(len(word), np.int64),
            **{f"in_all{s}": np.zeros(len(known_names), np.int64) for s in range(SWEEPS)},
        }
        out += _state_rows(bucket, state, word_buckets, hot)
    return out


def seat_range(group: pa.Table, sweep: int, known: int, roots: int) -> list[dict]:
    """Sums over all buckets how many tables serve each word of a range, samples how many
    tables these have in the parent restaurant, given the tables of all ranges, and sends
    each bucket, for its words in order, their customers and tables there."""
    rows = group.to_pylist()
    own = next((r for r in rows if r["kind"] == "range"), None)
    asked = [(r, _from_ascending(r["words"], np.uint64)) for r in rows if r["kind"] in ("once", "served")]
    if own is None:
        words = np.unique(np.concatenate([w for _, w in asked]))
        base = np.zeros(len(words), np.int64)
        state = {"words": words, "base": base, "roots": np.ones(len(words), np.int64)}
        state |= {f"{c}{s}": np.zeros(len(words), np.int64) for c in ("served", "roots") for s in range(SWEEPS)}
    else:
        state = {c: x if x.dtype == np.uint64 else x.astype(np.int64) for c, x in _read(_RANGE, own["x"]).items()}
        words = state["words"]
    served = state["base"].copy()
    places = [np.searchsorted(words, w) for _, w in asked]
    for (r, _), place in zip(asked, places, strict=True):
        tables = _unpacked(r["x"], np.uint32)
        served[place] += tables
        if r["kind"] == "once":
            state["base"][place] += tables
    bucket = group.column("bucket")[0].as_py()
    if own is not None:
        rng = np.random.default_rng([bucket, sweep, 1])
        uniform = np.full(len(words), 1.0 / (known + 1))
        others = np.maximum(roots - state["roots"], 0)
        state["roots"] = draw_tables(
            served, others, uniform, ROOT_DISCOUNT, ROOT_STRENGTH, _stirling(ROOT_DISCOUNT), rng
        )
        if sweep > BURN_IN:
            state[f"served{sweep - BURN_IN - 1}"] = served
            state[f"roots{sweep - BURN_IN - 1}"] = state["roots"]
    say, seated = served.astype(np.uint32), state["roots"].astype(np.uint32)
    out = [
        {"kind": "parent", "chunk": bucket, "bucket": r["chunk"], "x": _packed(say[place]), "y": _packed(seated[place])}
        for (r, _), place in zip(asked, places, strict=True)
        if r["kind"] == "served"
    ]
    out.append({"kind": "range", "bucket": bucket, "x": _held(_RANGE, **state)})
    out.append(
        {"kind": "sums", "n": int(served.sum()), "v": len(words), "t": float(state["roots"].sum())}
    )
    return out


def seat_bucket(
    group: pa.Table, sweep: int, sums: tuple[int, int, float], word_buckets: int, hot: dict[int, int]
) -> list[dict]:
    """A sweep over the open pairs of a bucket, given the parent as all buckets make it and
    ``hot``, the tables that dealt contexts have in all of their buckets."""
    rows = group.to_pylist()
    held = next(r for r in rows if r["kind"] == "state")
    state = _read(_STATE, held["x"])
    said = sorted((r for r in rows if r["kind"] == "parent"), key=lambda r: r["chunk"])
    served, known, roots = sums
    kept = np.concatenate(
        [_unpacked(r["x"], np.uint32) - ROOT_DISCOUNT * _unpacked(r["y"], np.uint32) for r in said]
    )
    parent = (kept + (ROOT_STRENGTH + ROOT_DISCOUNT * roots) / (known + 1)) / (ROOT_STRENGTH + served)
    context = np.repeat(np.arange(len(state["names"])), state["runs"])
    tables = state["tables"].astype(np.int64)
    in_all = state["base"] + np.bincount(context, weights=tables, minlength=len(state["names"]))
    for k in np.flatnonzero(np.isin(state["names"], np.array(list(hot), np.uint64))) if hot else ():
        in_all[k] = hot[int(state["names"][k])]
    rng = np.random.default_rng([held["bucket"], sweep])
    state["tables"] = draw_tables(
        state["counts"].astype(np.int64), in_all[context] - tables, parent[state["word"]],
        DISCOUNT, STRENGTH, _stirling(DISCOUNT), rng,
    )
    if sweep >= BURN_IN:
        state["sums"] = state["sums"] + state["tables"]
        own = np.bincount(context, weights=state["tables"], minlength=len(state["names"]))
        state[f"in_all{sweep - BURN_IN}"] = own
    return _state_rows(held["bucket"], state, word_buckets, hot)


def answer_bucket(group: pa.Table, word_buckets: int) -> list[dict]:
    """Gives back to each chunk, for its pairs in order, customers less discounted tables;
    and per context its open pairs' tables in each sample, for the ranges of words."""
    rows = group.to_pylist()
    held = next((r for r in rows if r["kind"] == "state"), None)
    out, open_ = [], np.zeros(0, np.float32)
    if held is not None:
        state = _read(_STATE, held["x"])
        mean = state["sums"] / SWEEPS
        open_ = (state["counts"] - DISCOUNT * mean).astype(np.float32)
        in_all = np.stack([state[f"in_all{s}"] for s in range(SWEEPS)])
        out += _by_range("tables", held["bucket"], state["names"], in_all, word_buckets)
    for r in rows:
        if r["kind"] == "places":
            shown = _unpacked(r["x"], np.uint8)
            answer = np.where(shown == 1, np.float32(1 - DISCOUNT), np.float32(0))
            answer[shown == 2] = open_[_from_ascending(r["y"], np.int32)]
            out.append({"kind": "pairs", "chunk": r["chunk"], "bucket": r["bucket"], "x": _packed(answer)})
    return out


def seat_words(group: pa.Table) -> list[dict]:
    """Merges what chunks count and buckets say of a range of words, and answers each chunk,
    for its words in order."""
    rows = group.to_pylist()
    asked = sorted((r for r in rows if r["kind"] == "words"), key=lambda r: r["chunk"])
    if not asked:
        return []
    hashes = [_from_ascending(r["words"], np.uint64) for r in asked]
    words, place = np.unique(np.concatenate(hashes), return_inverse=True)
    counts = np.bincount(
        place, weights=np.concatenate([_unpacked(r["x"], np.uint32) for r in asked]), minlength=len(words)
    ).astype(np.int64)
    kept, tables = np.zeros((SWEEPS, len(words))), np.zeros((SWEEPS, len(words)), np.int64)
    customers, roots = np.zeros(SWEEPS), np.zeros(SWEEPS)
    for r in rows:
        if r["kind"] == "range":  # by the first 48 bits
            own = _read(_RANGE, r["x"])
            at = np.searchsorted(words >> np.uint64(16), own["words"] >> np.uint64(16))
            for s in range(SWEEPS):
                kept[s, at] = own[f"served{s}"] - ROOT_DISCOUNT * own[f"roots{s}"]
                customers[s], roots[s] = own[f"served{s}"].sum(), own[f"roots{s}"].sum()
        elif r["kind"] in ("tables", "tables once"):
            at = np.searchsorted(words, _from_ascending(r["words"], np.uint64))
            found = _unpacked(r["x"], np.uint32).astype(np.int64)
            np.add.at(tables, (slice(None), at), found.reshape(-1, len(at)))
    bucket = group.column("bucket")[0].as_py()
    out, at = [], 0
    for r, h in zip(asked, hashes, strict=True):
        own_place = place[at : at + len(h)]
        at += len(h)
        out.append(
            {
                "kind": "words",
                "chunk": r["chunk"],
                "bucket": bucket,
                "words": _packed(counts[own_place]),
                "x": _packed(kept[:, own_place].astype(np.float32)),
                "y": _packed(tables[:, own_place]),
            }
        )
    known = int((counts > 0).sum())
    out.append({"kind": "sums", "n": int(counts.sum()), "v": known})
    for s in range(SWEEPS):
        out.append({"kind": "sample", "n": s, "k": float(customers[s]), "t": float(roots[s])})
    return out


def _frequent_contexts(table: DataFrame, total: int, buckets: int) -> dict[int, int]:
    """Contexts with over about a quarter of a bucket's share of tokens, and over how many
    buckets each is dealt. At most eight times as many as there are buckets."""
    least = 1.0 / (8 * buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, tokens in zip(batch.column(0), batch.column(1), strict=True):
                hashes = _from_ascending(words.as_py(), np.uint64)
                own = _tokens(tokens.as_py())
                counts = np.bincount(own, minlength=len(hashes))
                some = np.flatnonzero(counts >= max(1.0, least * len(own)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[some].view(np.int64)), pa.array(counts[some])], ["word", "n"]
                )

    counted = table.select("words", "tokens").mapInArrow(run, "word long, n long")
    hot = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least * total)
    return {
        r["word"] & 0xFFFFFFFFFFFFFFFF: min(buckets, -(-4 * buckets * r["n"] // total)) for r in hot.collect()
    }


def _sampled(
    opened: DataFrame, buckets: int, word_buckets: int, hot: dict[int, int]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """The buckets' and the ranges' states after all sweeps, and the folders they lie in. Between two sweeps the tables
    per word are summed over all buckets and the parent is sampled from them; the tables
    of dealt contexts, at most eight of these per bucket, are summed likewise."""
    once = {}
    if hot:
        once = _summed(opened.where("kind = 'hot once'"))
    state, ranges, known, roots = opened, None, 0, 0
    folders: dict[str, str] = {}

    def settled(df: DataFrame, purpose: str) -> DataFrame:
        """Written in place of the table of the sweep before, which nothing needs then."""
        found, folder = _written(df, purpose)
        if purpose in folders:
            remove(df.sparkSession, folders[purpose])
        folders[purpose] = folder
        return found

    for sweep in range(BURN_IN + SWEEPS + 1):
        rest = opened.where("kind = 'once'") if ranges is None else ranges.where("kind = 'range'")
        asked = state.where("kind = 'served'").union(rest).repartition(-(-word_buckets // SWEEP_BUCKETS), "bucket")
        ranges = settled(
            asked.groupBy("bucket").applyInArrow(_told(seat_range, sweep, known, roots), LEARNT), "lm-ranges"
        )
        sums = ranges.where("kind = 'sums'").agg(F.sum("n"), F.sum("v"), F.sum("t")).first()
        served, known, roots = (x or 0 for x in sums)
        if sweep == BURN_IN + SWEEPS:
            break
        in_all = {}
        if hot:
            in_all = _summed(state.where("kind = 'hot'"))
            in_all = {u: once.get(u, 0) + in_all.get(u, 0) for u in hot}
        told = state.where("kind = 'state'").union(ranges.where("kind = 'parent'"))
        state = settled(
            told.repartition(-(-buckets // SWEEP_BUCKETS), "bucket").groupBy("bucket").applyInArrow(
                _told(seat_bucket, sweep, (served, known, roots), word_buckets, in_all), LEARNT
            ),
            "lm-tables",
        )
    return state.where("kind = 'state'"), ranges.where("kind = 'range'"), list(folders.values())


def _written(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, and its folder. Once it is written, what was
    shuffled for it is removed from the executors' disks (a setting of Spark, which is put
    back as it was)."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, purpose)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder), folder


def _summed(rows: DataFrame) -> dict[int, int]:
    sums = rows.groupBy("n").agg(F.sum("v").alias("v")).collect()
    return {r["n"] & 0xFFFFFFFFFFFFFFFF: r["v"] for r in sums}


def score(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: ``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (smoothed word counts) and ``score`` (the model), both log10.

    The model learns from all documents whose crc32 of the id, as text, is not 1 modulo 5
    (a null id counts as an empty one). A null or empty text is its end alone. Repeated rows
    each count and are each scored. Without any training token every token has the
    probability of the one unknown word, 1. An empty table gives an empty result.
    """
    kind = docs.schema[id].dataType.simpleString()
    table, _ = _written(chunks(docs, id, text), "lm-chunks")
    total = table.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_TOKENS))
    word_buckets = max(1, -(-total // WORD_BUCKET_TOKENS))
    hot = _frequent_contexts(table, total, buckets) if buckets > 1 else {}

    def send_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("chunk", pa.int64()), ("bucket", pa.int32())]
            + [(c, pa.binary()) for c in ("contexts", "runs", "names", "word", "counts")]
        )
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                for out in Chunk(row, buckets, hot).pair_rows():
                    yield pa.RecordBatch.from_pylist([{"chunk": row["chunk"], **out}], schema)

    def send_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                words = _from_ascending(row["words"], np.uint64)
                train = np.repeat(~np.array(row["held"], bool), row["lengths"])
                own = _tokens(row["tokens"])[train]
                counts = np.bincount(own, minlength=len(words)).astype(np.uint32)
                edges = np.searchsorted(_word_bucket(words, word_buckets), np.arange(word_buckets + 1))
                for b in range(word_buckets):
                    a, z = edges[b], edges[b + 1]
                    if z > a:
                        out = {
                            "kind": "words",
                            "chunk": row["chunk"],
                            "bucket": b,
                            "words": _ascending(words[a:z]),
                            "x": _packed(counts[a:z]),
                        }
                        yield from _table([out]).to_batches()

    pairs = table.mapInArrow(
        send_pairs,
        "chunk long, bucket int, contexts binary, runs binary, names binary, word binary, counts binary",
    )
    opened, opened_folder = _written(
        pairs.groupBy("bucket").applyInArrow(_told(open_bucket, word_buckets, hot), LEARNT), "lm-open"
    )
    state, ranges, sampled = _sampled(opened, buckets, word_buckets, hot)
    learnt, _ = _written(
        opened.where("kind = 'places'").union(state).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(
            _told(answer_bucket, word_buckets), LEARNT
        ),
        "lm-pairs",
    )
    said = ranges.union(opened.where("kind = 'tables once'")).union(learnt.where("kind = 'tables'"))
    of_words = table.mapInArrow(send_words, LEARNT).union(said)
    answers, _ = _written(of_words.groupBy("bucket").applyInArrow(_told(seat_words), LEARNT), "lm-words")
    for folder in (opened_folder, *sampled):
        remove(table.sparkSession, folder)
    n, v = (x or 0 for x in answers.where("kind = 'sums'").agg(F.sum("n"), F.sum("v")).first())
    seen = answers.where("kind = 'sample'").groupBy("n").agg(F.sum("k").alias("k"), F.sum("t").alias("t"))
    samples = {r["n"]: (r["k"], r["t"]) for r in seen.collect()}
    # Customers and tables of the parent in each sample.
    customers, root_tables = np.array([samples.get(s, (0.0, 0.0)) for s in range(SWEEPS)]).T

    def finish(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        row = next(r for r in rows if r["kind"] == "chunk")
        chunk = Chunk(row, buckets, hot)
        said = sorted((r for r in rows if r["kind"] == "words"), key=lambda r: r["bucket"])
        counts = np.concatenate([_unpacked(r["words"], np.int64) for r in said])
        kept, tables = (
            np.concatenate([_unpacked(r[c], kind).reshape(SWEEPS, -1) for r in said], axis=1).astype(np.float64)
            for c, kind in (("x", np.float32), ("y", np.int64))
        )
        answer = np.empty(len(chunk.order))
        answer[chunk.order] = np.concatenate(
            [
                _unpacked(r["x"], np.float32)
                for r in sorted((r for r in rows if r["kind"] == "pairs"), key=lambda r: r["bucket"])
            ]
        )
        fresh = (ROOT_STRENGTH + ROOT_DISCOUNT * root_tables) / (v + 1)
        u, w = chunk.context, chunk.word
        # The probability that a new table is opened and serves the word, sample by sample.
        opened_for = np.zeros(len(u))
        for s in range(SWEEPS):
            parent = (kept[s] + fresh[s]) / (ROOT_STRENGTH + customers[s])
            opened_for += (STRENGTH + DISCOUNT * tables[s][u]) * parent[w]
        of_pair = (answer + opened_for / SWEEPS) / (STRENGTH + counts[u])
        base = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
        texts = len(chunk.lengths)

        def summed(x):
            return np.bincount(chunk.text, weights=x, minlength=texts)

        return pa.table(
            {
                "id": group.column("ids").filter(pa.compute.equal(group.column("kind"), "chunk")).combine_chunks().flatten(),
                "held_out": pa.array(chunk.held),
                "n_tokens": pa.array(chunk.lengths),
                "n_known": pa.array(summed(counts[chunk.tokens] > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(texts, n, np.int64)),
                "base_score": pa.array(summed(base[chunk.tokens])),
                "score": pa.array(summed(np.log10(of_pair)[chunk.pair])),
            }
        )

    parts = ("ids", "held", "lengths", "words", "tokens", "end")
    kinds = dict(table.dtypes)
    own = table.select(
        F.lit("chunk").alias("kind"), "chunk", F.lit(0).alias("bucket"), F.lit(None).cast("binary").alias("x"),
        F.lit(None).cast("binary").alias("y"), *parts,
    )
    others = learnt.where("kind = 'pairs'").union(answers.where("kind = 'words'")).select(
        "kind", "chunk", "bucket", "x", "y",
        *[F.col("words") if c == "words" else F.lit(None).cast(kinds[c]).alias(c) for c in parts],
    )
    scored = own.union(others).groupBy("chunk").applyInArrow(
        finish,
        f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
    return scored.withColumnRenamed("id", id)
