"""Byte-pair encoding and decoding with a pair occurrence index.

The distinct new words of a block of texts are laid out in one row of symbols. A map
holds every adjacent pair with all its places; the pairs that have a rank are merged in
ascending rank, each at all of its places in turn, and every merge enters the pairs it
makes into the map. Words that were merged once are looked up from then on.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame

#: Words kept with their ids; beyond it the memory starts anew. Affects speed only.
REMEMBERED_WORDS = 400_000
#: Bytes of text that are taken up at once.
BLOCK_BYTES = 8_000_000

# How byte-level vocabularies write bytes (printable ones as themselves,
# the others from code point 256 on), and the split pattern of their pre-tokenizer.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_chars() -> list[str]:
    shown = set(_PRINTABLE)
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def _lowered(text: str) -> str:
    # Character by character: no special case for a final sigma.
    return text.replace("Σ", "σ").lower()


class _Codes(dict):
    """Numbers words in the order they come up."""

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


class PairIndexBpe:
    """The tokenizer of a vocabulary file: word-level with word ends, or byte-level."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model = stated["model"]
        vocab = model["vocab"]
        self.added = {x["content"]: x["id"] for x in stated["added_tokens"]}
        end = model.get("end_of_word_suffix") or ""
        byte_chars = _byte_chars()
        self.first = np.array([vocab.get(c, -1) for c in byte_chars], np.int32)
        self.last = np.array([vocab.get(c + end, -1) for c in byte_chars], np.int32)
        self._read_merges(model["merges"], vocab, end)
        self.normal = stated["normalizer"] is not None
        split = stated["pre_tokenizer"]
        pattern = _BYTE_SPLIT if split["type"] == "ByteLevel" else split["pretokenizers"][0]["pattern"]["Regex"]
        self.find = regex.compile(pattern).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.byte_level = (stated["decoder"] or {}).get("type") == "ByteLevel"
        named = {**{i: t for t, i in vocab.items()}, **{i: t for t, i in self.added.items()}}
        if self.byte_level:
            of = {c: b for b, c in enumerate(byte_chars)}
            own = set(self.added.values())
            self.shown = {
                i: t.encode() if i in own else bytes(of[c] for c in t) for i, t in named.items()
            }
        else:
            self.shown = named
        self._forget()

    def _read_merges(self, merges, vocab: dict[str, int], end: str) -> None:
        """Rank k joins symbol ``left[k]`` with ``right[k]`` to ``made[k]``; ``one_by_one``
        marks the ranks whose product has a part in a merge of a lower rank."""
        parts = [x.split(" ") if isinstance(x, str) else x for x in merges]
        self.left = np.array([vocab[a] for a, _ in parts], np.int64)
        self.right = np.array([vocab[b] for _, b in parts], np.int64)
        self.made = np.array(
            [vocab[(a.removesuffix(end) if end else a) + b] for a, b in parts], np.int64
        )
        ranks = np.arange(len(parts))
        keys = self.left << 32 | self.right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of_key = keys[order], ranks[order]
        earliest = np.full(max(vocab.values(), default=0) + 1, len(parts))
        np.minimum.at(earliest, self.left, ranks)
        np.minimum.at(earliest, self.right, ranks)
        self.one_by_one = (earliest[self.made] < ranks) | (self.left == self.right)

    def _forget(self) -> None:
        self.codes = _Codes()
        self.starts = np.zeros(1, np.int64)  # word k has the ids from starts[k] to starts[k + 1]
        self.ids = np.zeros(0, np.int32)
        for word in self.added:
            self.codes[word] = len(self.codes)
            self.ids = np.append(self.ids, np.int32(self.added[word]))
            self.starts = np.append(self.starts, len(self.ids))

    def split(self, text: str) -> list[str]:
        """The words and added tokens of a text, in order. No word that the pattern
        finds in other text can look like an added token."""
        if self.specials is None or not any(x in text for x in self.added):
            return self._plain(text)
        out = []
        for k, part in enumerate(self.specials.split(text)):
            out.extend([part] if k % 2 else self._plain(part))
        return out

    def _plain(self, text: str) -> list[str]:
        if self.normal:
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = _lowered(text)
        return self.find(text)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 without one."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.rank_of_key[at], -1)

    def _merge(self, words: list[str]) -> None:
        """Ids of ``words``, numbered next, by one pair index over all of them."""
        raw = [w.encode() for w in words]
        length = np.array([len(x) for x in raw], np.int64)
        octets = np.frombuffer(b"".join(raw), np.uint8)
        end = np.cumsum(length)
        symbols = self.first[octets]
        symbols[end - 1] = self.last[octets[end - 1]]
        n = len(symbols)
        following = np.arange(1, n + 1)
        following[end - 1] = -1
        before = np.arange(-1, n - 1)
        before[end - length] = -1
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray, ranks: np.ndarray) -> None:
            has = ranks >= 0
            if not has.any():
                return
            at, ranks = at[has], ranks[has]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            heads = [0, *cuts.tolist()]
            for rank, i, j in zip(ranks[heads].tolist(), heads, [*heads[1:], len(ranks)], strict=True):
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(active, rank)
                places[rank].append(at[i:j])

        def pairs_around(p: np.ndarray) -> None:
            after = following[p]
            inside = after >= 0
            enter(p[inside], self._ranks(symbols[p[inside]], symbols[after[inside]]))
            ahead = before[p]
            inside = ahead >= 0
            enter(ahead[inside], self._ranks(symbols[ahead[inside]], symbols[p[inside]]))

        inner = np.flatnonzero(following >= 0)
        enter(inner, self._ranks(symbols[inner], symbols[inner + 1]))
        while active:
            rank = heapq.heappop(active)
            found = places.pop(rank)
            p = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
            a, b = self.left[rank], self.right[rank]
            q = following[p]
            good = (q >= 0) & (symbols[p] == a) & (symbols[q] == b)
            p, q = p[good], q[good]
            if not len(p):
                continue
            if self.one_by_one[rank]:
                # The first place of each word only; the rest, if still there, comes next.
                word = np.searchsorted(end, p, side="right")
                head = np.append(True, word[1:] != word[:-1])
                if not head.all():
                    places[rank] = [p[~head]]
                    heapq.heappush(active, rank)
                p, q = p[head], q[head]
            after = following[q]
            symbols[p] = self.made[rank]
            symbols[q] = -1
            following[p] = after
            inside = after >= 0
            before[after[inside]] = p[inside]
            pairs_around(p)
        left = symbols >= 0
        counts = np.add.reduceat(left, end - length) if n else np.zeros(0, np.int64)
        self.ids = np.concatenate([self.ids, symbols[left].astype(np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids begin (and the end)."""
        if len(self.codes) > REMEMBERED_WORDS:
            self._forget()
        codes = self.codes
        known = len(codes)
        numbered = [np.array(list(map(codes.__getitem__, self.split(t))), np.int64) for t in texts]
        new = list(islice(codes, known, None))
        if new:
            self._merge(new)
        words = np.concatenate([np.zeros(0, np.int64), *numbered])
        begin = self.starts[words]
        size = self.starts[words + 1] - begin
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        ids = self.ids[np.repeat(begin - (stop - size), size) + np.arange(total)]
        ends = np.cumsum([len(x) for x in numbered])
        bounds = np.concatenate([[0], stop])[np.concatenate([[0], ends]).astype(np.int64)]
        return ids, bounds

    def decode(self, ids: list[int]) -> str:
        """The text of ids; ids that the vocabulary lacks are left out."""
        try:
            shown = map(self.shown.__getitem__, ids)
            return b"".join(shown).decode("utf-8", "replace") if self.byte_level else " ".join(shown)
        except KeyError:
            return self.decode([i for i in ids if i in self.shown])


@lru_cache(maxsize=2)
def tokenizer(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


def blocks(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each come to about ``BLOCK_BYTES`` at most."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
        total = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            spent = total[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(total, spent + BLOCK_BYTES, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``ids`` (array of int) of every row.

    The whole text is encoded without special tokens of the model's own; an added token
    that stands in a text becomes its id. A null or empty text has no ids. Rows stay
    rows: repeated and null ids are kept, further columns are ignored. A task holds one
    block of texts and the remembered words, both bounded; nothing is shuffled.
    """
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path)
        for part in blocks(batches):
            ids, bounds = model.encode([t or "" for t in part.column(1).to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "ids"])

    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``id``, ``ids`` and the ``text`` that the ids stand for; null ids give an empty text."""
    kind = encoded.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [model.decode(x.as_py() or []) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string())], ["id", "ids", "text"]
                )

    return encoded.select(id, ids).mapInArrow(run, f"`{id}` {kind}, ids array<int>, text string")
