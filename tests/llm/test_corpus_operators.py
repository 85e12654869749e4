"""Token files, SimHash, embeddings, line dedup, language model and the pipeline against
plain versions, and odd rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidegauge.llm import embeddings, language_model, lines, simhash, token_files
from tidegauge.llm.common import connected_components
from tidegauge.llm.queries import QUERIES
from tidegauge.session import shared_folder

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(spark, sf_dir=SF_DIR):
    return {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def plain_groups(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_the_driver_collects_in_each_round_of_components(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()

    def whole():
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    before = whole()
    assert connected_components(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")).count() == 3
    assert whole() >= before + 2


def test_components_of_chains_stars_and_repeats(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 560)]
    pairs += [(rng.randint(-40, 40), rng.randint(-40, 40)) for _ in range(25)] + [(7, 7), (100, 101), (101, 100)]
    nodes = {n for p in pairs for n in p}
    found = connected_components(spark.createDataFrame(pairs + [(None, 3)], "a long, b long"))
    rows = found.collect()
    assert {r.node: r.component for r in rows} == plain_groups(nodes, pairs) and len(rows) == len(nodes)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- Token files -----------------------------------------------------------------


def test_index_is_a_bijection_and_finds_its_keys():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 10, 999, 5000):
        keys = rng.integers(-(2**60), 2**60, n)
        none = np.zeros(n, np.uint8)
        hashes = token_files.key_hash(keys, none, np.zeros(n, np.uint32))
        shifts, slot = token_files.build_index(hashes)
        assert sorted(slot) == list(range(n))
        assert (token_files.find_slots(hashes, shifts, n) == slot).all()


def files(spark, rows, schema="doc_id long, text string, start int"):
    path = shared_folder(spark, "token-test")
    df = spark.createDataFrame(rows, schema)
    places = [public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken")]
    token_files.write_token_files(df, path, *places)
    return token_files.read_token_files(spark, path)


def test_token_file_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, expected = 0, {}
    for doc, text in sorted(texts(spark).items()):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected[doc] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r[0]: tuple(r[1:]) for r in QUERIES["op7_token_files"](spark, SF_DIR).collect()} == expected


def test_documents_are_found_by_key_and_others_are_not(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_IDS", 300)
    shards = files(spark, [(i * 3, f"text number {i} " * (i % 40), 0) for i in range(120)])
    assert shards.count() > 3
    every = {r.doc_id: tuple(r) for r in token_files.documents_of(shards).collect()}
    assert len(every) == 120
    some = {r.doc_id: tuple(r) for r in token_files.documents_of(shards, [9, 10, 300, 100_000]).collect()}
    assert some == {9: every[9], 300: every[300]}
    assert token_files.documents_of(shards, []).count() == 0


def test_token_files_of_odd_rows(spark):
    special = "a<|endoftext|>b"
    rows = [(None, "x", 0), (None, "x", 0), (5, None, 0), (5, "", 0), (5, special, 0), (5, special, 0), (6, "y", 0)]
    found = token_files.documents_of(files(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in found) == [(0, 2), (0, 2), (5, 1), (5, 1), (5, 4), (5, 4), (6, 2)]
    begin = sorted((r.start, r.n_tokens) for r in found)
    assert begin[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(begin, begin[1:], strict=False))
    assert token_files.documents_of(files(spark, [])).count() == 0


# --- SimHash ---------------------------------------------------------------------


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_anchors_meet_whatever_bits_differ():
    rng = np.random.default_rng(2)
    base = np.concatenate([rng.integers(-(2**62), 2**62, 150), [0, -1]])
    for x in base:
        flips = rng.choice(64, rng.integers(0, 3), replace=False)
        y = (np.array([x]).view(np.uint64) ^ np.uint64(sum(1 << int(b) for b in flips))).view(np.int64)[0]
        index, anchor = simhash.anchors_of(np.array([x, y]), 2)
        assert set(anchor[index == 0]) & set(anchor[index == 1])


@pytest.mark.parametrize("many", [300, 2600])
def test_simhash_links_equal_brute_force(spark, many):
    rng = np.random.default_rng(many)
    centres = rng.integers(-(2**62), 2**62, many // 10).view(np.uint64)
    fps = []
    for k in range(many):
        x = int(centres[k % len(centres)]) if many < 1000 else int(centres[0])
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            x ^= 1 << int(b)
        fps.append(x)
    fps = np.unique(np.array(fps, np.uint64))
    signed = fps.view(np.int64).tolist()
    near = np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2, 1))
    expected = plain_groups(signed, [(signed[a], signed[b]) for a, b in near])
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = connected_components(simhash.links(df))
    groups = {n: n for n in signed} | {r.node: r.component for r in found.collect()}
    assert groups == expected


def test_simhash_query(spark):
    own = texts(spark)
    fps = {i: plain_fingerprint(t or "") for i, t in own.items()}
    pairs = [(a, b) for a in own for b in own if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    groups = plain_groups(own, pairs)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op8_simhash"](spark, SF_DIR).collect()}
    assert found == {i: (f"{fps[i]:016x}", groups[i]) for i in own}


def test_simhash_odd_rows(spark):
    rows = [(3, None, "x"), (2, "", "x"), (None, " \n", "x"), (7, "one", "x"), (7, "ONE", "x"), (8, "É one", "x"), (9, "é one", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = sorted((r.doc_id or 0, r.fp == 0, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert found == [(0, True, 2), (2, True, 2), (3, True, 2), (7, False, 7), (7, False, 7), (8, False, 8), (9, False, 9)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.keep_first(df)
    assert kept.dtypes == df.dtypes
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [2, 7, 8, 9]
    assert simhash.keep_first(df.limit(0)).count() == 0


# --- Embeddings ------------------------------------------------------------------


def plain_links(rows):
    """Links of (id, label, vector) rows by brute force."""
    good = [
        (i, lab, np.array(v, float))
        for i, lab, v in rows
        if lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    pairs = []
    for k, (i, lab, v) in enumerate(good):
        for j, other, w in good[:k]:
            if lab == other and len(v) == len(w):
                if v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.93:
                    pairs.append((i, j))
    return pairs


def check_embeddings(spark, rows, least=1.0):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("kept", F.lit("x"))
    exact = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    pairs = plain_links(exact)
    found = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    count = collections.Counter(x for p in pairs for x in p)
    assert len(found) == len(rows)
    assert all(found[i].n_links <= count[i] for i in found)
    assert sum(r.n_links for r in found.values()) >= least * 2 * len(pairs)
    if least == 1.0:
        groups = plain_groups([r[0] for r in rows], pairs)
        assert {i: r.component_id for i, r in found.items()} == groups
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    return pairs


def test_embedding_links_equal_brute_force_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 16)
    rng = np.random.default_rng(3)
    rows = []
    for k in range(500):
        v = np.ones(16) + rng.normal(scale=0.05, size=16) if k % 3 else rng.normal(size=16)
        rows.append((k, k % 2, v.astype(np.float32).tolist()))
    rows += [(600 + k, 1, rows[1][2]) for k in range(40)]
    assert len(check_embeddings(spark, rows)) > 10_000


def test_recall_near_the_threshold(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(300):
        v = rng.normal(size=64)
        v /= np.linalg.norm(v)
        w = rng.normal(size=64)
        w -= (w @ v) * v
        w /= np.linalg.norm(w)
        cosine = rng.uniform(0.931, 0.96)
        rows += [(2 * k, 1, v.tolist()), (2 * k + 1, 1, (3 * (cosine * v + math.sqrt(1 - cosine**2) * w)).tolist())]
    assert len(check_embeddings(spark, rows, least=0.9)) >= 300


def test_embedding_index_follows_the_rows():
    rng = np.random.default_rng(11)
    sample = rng.normal(size=(3000, 64))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    few, many = (embeddings.learn_index(sample, 64, rows, 0.93) for rows in (500, 50_000))
    assert len(few.tables[0]) < len(many.tables[0]) and len(few.tables) < len(many.tables)
    # Neighbours planted anew, not those that the tables were chosen by.
    aside = rng.normal(size=sample.shape)
    aside -= (aside * sample).sum(axis=1, keepdims=True) * sample
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    turned = 0.93 * sample + math.sqrt(1 - 0.93**2) * aside
    for index in (few, many):
        differ = index.signs(sample) != index.signs(turned)
        distance = np.bitwise_count(embeddings.packed(index.signs(sample)) ^ embeddings.packed(index.signs(turned)))
        assert (distance.sum(axis=1) == differ.sum(axis=1)).all()
        met = np.any([~differ[:, own].any(axis=1) for own in index.tables], axis=0)
        assert met.mean() > 0.96 and (differ.sum(axis=1) <= index.radius).mean() > 0.995


def test_embedding_batches_are_cut_between_buckets():
    rng = random.Random(12)
    bucket = sorted(rng.choice([rng.randrange(60), 7, 8]) for _ in range(400))
    for size in (1, 3, 50, 1000):
        parts = [bucket[k : k + size] for k in range(0, len(bucket), size)]
        batches = [pa.RecordBatch.from_pydict({"bucket": pa.array(x, pa.int64())}) for x in [[], *parts]]
        chunks = [t.column("bucket").to_pylist() for t in embeddings._whole_runs(iter(batches))]
        assert sum(chunks, []) == bucket
        assert all(a[-1] < b[0] for a, b in zip(chunks, chunks[1:], strict=False))


@pytest.mark.parametrize("small", [1, 64])
def test_embedding_lengths_and_bucket_sizes(spark, monkeypatch, small):
    monkeypatch.setattr(embeddings, "SMALL", small)
    rng = np.random.default_rng(13)
    rows = []
    for k in range(240):
        centre = np.random.default_rng(k % 6).normal(size=(8, 70, 130)[k % 3])
        rows.append((k, k % 2, (centre + rng.normal(scale=0.02, size=len(centre))).astype(np.float32).tolist()))
    assert len(check_embeddings(spark, rows)) > 1000


def test_embedding_odd_rows(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, 1, v), (2, 1, v), (3, 2, v), (4, None, v), (5, None, v), (6, 1, None), (7, 1, []), (8, 1, [0.0] * 4),
        (9, 1, [0.0] * 4), (10, 1, [None, 1.0, 1.0, 1.0]), (11, 1, [float("nan"), 1.0, 1.0, 1.0]),
        (12, 1, [float("inf"), 1.0, 1.0, 1.0]), (13, 1, [2.0, 4.0, 6.0, 8.0]), (14, 1, [1.0, 2.0, 3.0]),
        (15, 1, [1e-38, 2e-38, 3e-38, 4e-38]), (16, 1, [3e38, -3e38, 3e38, 1.0]), (17, 1, [3e38, -3e38, 3e38, 1.0]),
    ]
    check_embeddings(spark, rows)
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert embeddings.near_duplicates(empty).count() == 0
    none = spark.createDataFrame([(None, 1, v), (1, 1, v), (1, 1, v)], "vec_id long, label int, embedding array<float>")
    found = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in embeddings.near_duplicates(none).collect())
    assert found == [(0, 0, None), (1, 1, 1), (1, 1, 1)]


# --- Lines -----------------------------------------------------------------------


def plain_distance(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.choice("sid")
        if kind == "s":
            out[at] = rng.choice("abé")
        elif kind == "i":
            out.insert(at, rng.choice("abé"))
        else:
            del out[at]
    return "".join(out)


def test_banded_distance_equals_the_plain_one(spark):
    rng = random.Random(3)
    rows = []
    while len(rows) < 700:
        a = "".join(rng.choice("abé ") for _ in range(rng.randint(20, 40)))
        b = changed(rng, a, rng.randint(0, 5))
        if abs(len(a) - len(b)) <= lines.EDITS:
            rows.append((a, b, plain_distance(a, b)))
    df = spark.createDataFrame(rows, "a string, b string, d int")
    for r in df.withColumn("found", lines.edit_distance(F.col("a"), F.col("b"))).collect():
        assert min(r.d, 3) == min(r.found, 3), (r.a, r.b)


def corpus(seed, n=90):
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        own = ["".join(rng.choice("ab ") for _ in range(rng.randint(10, 30))) for _ in range(3)]
        for _ in range(3 if docs else 0):
            own.append(changed(rng, rng.choice(rng.choice(docs)[1].split("\n")) + "xy", rng.choice([0, 0, 1, 2, 3])))
        rng.shuffle(own)
        docs.append((i, "\n".join(own)))
    return docs


def plain_dedup(docs):
    """Expected texts: lines in classes by links of at most two edits, first ones stay."""
    every = sorted({x.strip(" \t\n\x0b\x0c\r") for _, t in docs for x in t.split("\n")})
    long_ = [x for x in every if len(x) >= lines.MIN_CHARS]
    near = [
        (a, b) for k, a in enumerate(long_) for b in long_[:k]
        if abs(len(a) - len(b)) <= 2 and plain_distance(a, b) <= 2
    ]
    group = plain_groups(long_, near)
    seen, out = set(), {}
    for doc, text in sorted(docs):
        kept = []
        for line in text.split("\n"):
            g = group.get(line.strip(" \t\n\x0b\x0c\r"))
            if g is None or g not in seen:
                kept.append(line)
            seen.add(g) if g is not None else None
        out[doc] = "\n".join(kept)
    return out


def test_line_dedup_equals_brute_force(spark, monkeypatch):
    docs = corpus(5)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    expected = plain_dedup(docs)
    assert {r.doc_id: r.text for r in lines.dedup_lines(df).collect()} == expected
    monkeypatch.setattr(lines, "FEW_LINES", 0)
    assert {r.doc_id: r.text for r in lines.dedup_lines(df).collect()} == expected


def templated(seed, n=160):
    """Documents of lines of a few templates: dense and sparse numbers, several fields, edits."""
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        own = [
            f"request number {rng.randrange(10**9):09d} was served from the cache",
            f"{rng.randrange(400):04d} pages of this book were printed",
            f"at {rng.randrange(10**5)} the host {rng.choice('ab')}{rng.randrange(10**4)} sent {rng.randrange(99)}",
        ]
        if docs:
            own.append(changed(rng, rng.choice(rng.choice(docs)[1].split("\n")), rng.choice([0, 1, 2, 3])))
        docs.append((i, "\n".join(own)))
    return docs


@pytest.mark.parametrize("hot", [2, 16])
def test_lines_of_templates_equal_brute_force(spark, monkeypatch, hot):
    docs = templated(8)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(lines, "HOT_LINES", hot)
    assert {r.doc_id: r.text for r in lines.dedup_lines(df).collect()} == plain_dedup(docs)


def test_hot_keys_of_all_kinds_equal_brute_force(spark, monkeypatch):
    docs = corpus(6)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(lines, "HOT_LINES", 1)
    assert {r.doc_id: r.text for r in lines.dedup_lines(df).collect()} == plain_dedup(docs)


def test_lines_of_one_template_make_few_pairs(spark):
    rng = random.Random(9)
    own = sorted({f"request number {rng.randrange(10**12):012d} was served from the cache of the node" for _ in range(3000)})
    df = spark.createDataFrame([(i, x) for i, x in enumerate(own)], "node long, line string")
    pairs, _ = lines._candidates(df.withColumn("sig", lines.signature(F.col("line"))))
    assert pairs.count() < 10 * len(own)


def test_line_dedup_odd_rows(spark):
    long_ = "a line that is long enough to count"
    rows = [
        (2, f"{long_}\nshort\nshort", "x"),
        (1, f"  {long_} \n\n{long_}", "x"),
        (None, f"{long_}\n{long_}s, and more of its own here", "x"),
        (3, None, "x"),
        (4, "", "x"),
        (5, long_, "x"),
        (5, long_, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, pos string")
    found = sorted(((r.doc_id or 0, r.text, r.n_dropped, r.pos) for r in lines.dedup_lines(df).collect()), key=str)
    assert found == sorted(
        [
            (2, "short\nshort", 1, "x"), (1, f"  {long_} \n", 1, "x"),
            (0, f"{long_}s, and more of its own here", 1, "x"), (3, None, 0, "x"), (4, "", 0, "x"),
            (5, "", 1, "x"), (5, "", 1, "x"),
        ],
        key=str,
    )
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_query(spark):
    own = texts(spark)
    found = {r.doc_id: r for r in QUERIES["op6_line_dedup"](spark, SF_DIR).collect()}
    seen = set()
    for doc, text in sorted(own.items()):
        exact = [x.strip() for x in text.split("\n") if len(x.strip()) >= lines.MIN_CHARS]
        left = found[doc].text.split("\n") if found[doc].text else []
        assert all(x in text.split("\n") for x in left)
        assert not any(x.strip() in seen for x in left if len(x.strip()) >= lines.MIN_CHARS)
        seen.update(exact)


# --- Language model ----------------------------------------------------------------


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*WORD.findall(lower), ""]


def held(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 1


def check_counts(found, own):
    count = collections.Counter(w for i, t in own.items() if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    for i, t in own.items():
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))
        r = found[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(i), len(tokens(t)), n)
        assert r.n_known == sum(count[w] > 0 for w in tokens(t))
        assert r.base_score == pytest.approx(base, rel=1e-9)


def test_language_model_query_beats_the_base_on_held_out_texts(spark):
    own = texts(spark, "/root/testdata/sf0.01")
    found = {r.doc_id: r for r in QUERIES["op5_lm_score"](spark, "/root/testdata/sf0.01").collect()}
    check_counts(found, own)
    out = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in out) > 0.9 * sum(r.base_score for r in out)


def test_chunks_and_buckets_change_nothing_but_the_sample(spark, monkeypatch):
    own = texts(spark)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    whole = {r.doc_id: r for r in language_model.score(docs).collect()}
    for name in ("CHUNK_TOKENS", "BUCKET_TOKENS", "WORD_BUCKET_TOKENS"):
        monkeypatch.setattr(language_model, name, 3000)
    split = {r.doc_id: r for r in language_model.score(docs.repartition(3)).collect()}
    check_counts(split, own)
    a, b = (np.array([x[i].score / x[i].n_tokens for i in own]) for x in (whole, split))
    assert np.abs(a - b).max() < 0.1 and abs(a.mean() - b.mean()) < 0.02


def test_probabilities_of_certain_seating(spark):
    """One text of different words: every customer has a table of its own and every word one
    table of the parent, so the model is known in closed form."""
    train = next(i for i in range(1000) if not held(i))
    words = ["a", "b", "c", "d", ""]
    follows = dict(zip(["", *words[:4]], words, strict=True))
    v, d, strength = 5, language_model.DISCOUNT, language_model.STRENGTH
    root_d, root = language_model.ROOT_DISCOUNT, language_model.ROOT_STRENGTH

    def parent(w):
        return ((1 - root_d) * (w in words) + (root + root_d * v) / (v + 1)) / (root + v)

    def probability(w, u):
        if u not in follows:
            return parent(w)
        return ((1 - d) * (follows[u] == w) + (strength + d) * parent(w)) / (strength + 1)

    for u in [*words, "never"]:
        assert sum(probability(w, u) for w in [*words, "never"]) == pytest.approx(1, rel=1e-12)
    asked = ["", "a", "a b c d", "d c", "never", "never a never", "b b b", "A  b\n"]
    ids = [i for i in range(1000, 4000) if held(i)][: len(asked)]
    df = spark.createDataFrame([(train, "a b c d"), *zip(ids, asked, strict=True)], "doc_id long, text string")
    score = {r.doc_id: r.score for r in language_model.score(df).collect()}
    for i, t in zip(ids, asked, strict=True):
        own = ["", *(w if w in words else "never" for w in t.lower().split()), ""]
        expected = sum(math.log10(probability(w, u)) for u, w in zip(own, own[1:], strict=False))
        assert score[i] == pytest.approx(expected, rel=1e-6), t


def sequential_scores(own, seed):
    """A sampler that updates after every draw, with its predictive probability averaged
    over the samples; its probabilities after a context sum to one."""
    rng = np.random.default_rng(seed)
    d, strength = language_model.DISCOUNT, language_model.STRENGTH
    root_d, root = language_model.ROOT_DISCOUNT, language_model.ROOT_STRENGTH
    stirling, root_stirling = language_model._stirling(d), language_model._stirling(root_d)

    def pairs(text):
        line = ["", *tokens(text)]
        return list(zip(line, line[1:], strict=False))

    c = collections.Counter(p for i, t in own.items() if not held(i) for p in pairs(t))
    customers, t, in_all, served = collections.Counter(), dict.fromkeys(c, 1), collections.Counter(), collections.Counter()
    for (u, w), n in c.items():
        customers[u] += n
        in_all[u] += 1
        served[w] += 1
    roots, v = dict.fromkeys(served, 1), len(served)
    total, root_total = sum(served.values()), len(served)
    asked = collections.Counter()
    for text in own.values():
        asked.update(pairs(text))
    mean = dict.fromkeys(asked, 0.0)

    def draw(n, others, parent, discount, strength, stirling):
        return int(
            language_model.draw_tables(
                np.array([n]), np.array([others]), np.array([parent]), discount, strength, stirling, rng
            )[0]
        )

    def parent(w):
        return (served[w] - root_d * roots.get(w, 0) + (root + root_d * root_total) / (v + 1)) / (root + total)

    for sweep in range(language_model.BURN_IN + language_model.SWEEPS):
        for w, n in served.items():
            new = draw(n, root_total - roots[w], 1 / (v + 1), root_d, root, root_stirling) if n > 1 else 1
            root_total += new - roots[w]
            roots[w] = new
        for (u, w), n in c.items():
            if n > 1:
                new = draw(n, in_all[u] - t[u, w], parent(w), d, strength, stirling)
                change = new - t[u, w]
                in_all[u], served[w], total = in_all[u] + change, served[w] + change, total + change
                t[u, w] = new
        if sweep >= language_model.BURN_IN:
            for u, w in asked:
                own_part = c[u, w] - d * t[u, w] if (u, w) in c else 0.0
                mean[u, w] += (own_part + (strength + d * in_all[u]) * parent(w)) / (strength + customers[u])
    mean = {p: x / language_model.SWEEPS for p, x in mean.items()}
    return {i: sum(math.log10(mean[p]) for p in pairs(text)) for i, text in own.items()}


def test_scores_are_those_of_a_sequential_sampler(spark):
    own = {i: t for i, t in texts(spark).items() if i < 80}
    df = spark.createDataFrame(list(own.items()), "doc_id long, text string")
    found = {r.doc_id: r.score / r.n_tokens for r in language_model.score(df).collect()}
    one, two = (sequential_scores(own, seed) for seed in (1, 2))
    per = {i: len(tokens(t)) for i, t in own.items()}
    apart = np.array([abs(found[i] - one[i] / per[i]) for i in own])
    chance = np.array([abs(two[i] - one[i]) / per[i] for i in own])
    assert apart.mean() < 0.01 and apart.max() < 0.06 + 3 * chance.max()
    whole = [sum(x.values()) / sum(per.values()) for x in (one, two)]
    assert sum(found[i] * per[i] for i in own) / sum(per.values()) == pytest.approx(whole[0], abs=0.003)


def test_tables_follow_the_exact_conditional():
    """Numbers of tables of few customers, against enumeration of all seatings."""
    discount, strength, parent, others = 0.6, 1.5, 0.2, 3

    def seatings(c):
        if c == 0:
            yield (), 1.0
            return
        for tables, weight in seatings(c - 1):
            for k in range(len(tables)):
                yield (*tables[:k], tables[k] + 1, *tables[k + 1 :]), weight * (tables[k] - discount)
            yield (*tables, 1), weight * (strength + discount * (others + len(tables))) * parent

    c = 5
    exact = np.zeros(c)
    for tables, weight in seatings(c):
        exact[len(tables) - 1] += weight
    exact /= exact.sum()
    n = 200_000
    drawn = language_model.draw_tables(
        np.full(n, c), np.full(n, others), np.full(n, parent), discount, strength,
        language_model._stirling(discount), np.random.default_rng(0),
    )
    assert np.bincount(drawn - 1, minlength=c) / n == pytest.approx(exact, abs=0.005)


def test_language_model_odd_rows(spark):
    rows = [(None, "a b", 1), (2, None, 1), (2, "", 1), (3, "É e \x0b x", 1), (3, "É e \x0b x", 1), (4, "a " * 3000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    found = language_model.score(df).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in found) == [(0, 3), (2, 1), (2, 1), (3, 4), (3, 4), (4, 3001)]
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)
    assert language_model.score(df.limit(0)).count() == 0
    only_held = spark.createDataFrame([(next(i for i in range(99) if held(i)), "a b")], "doc_id long, text string")
    (r,) = language_model.score(only_held).collect()
    assert (r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, 0.0)


def test_buckets_see_the_tables_of_all_others(spark, monkeypatch):
    """A frequent context that is dealt to many buckets scores as it does in one."""
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    docs = [(i, " ".join(f"the {rng.choice(words)}" for _ in range(40))) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    whole = {r.doc_id: r.score / r.n_tokens for r in language_model.score(df).collect()}
    for name in ("CHUNK_TOKENS", "BUCKET_TOKENS", "WORD_BUCKET_TOKENS"):
        monkeypatch.setattr(language_model, name, 600)
    split = {r.doc_id: r.score / r.n_tokens for r in language_model.score(df).collect()}
    off = np.array([split[i] - whole[i] for i in whole])
    assert abs(off.mean()) < 0.002 and np.abs(off).max() < 0.01


# --- Pipeline ----------------------------------------------------------------------


def test_stages_keep_columns_and_work_on_what_is_left(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SF_DIR)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert after.dtypes == docs.dtypes, name
        after.write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "line_dedup":
            old = [(r.doc_id, r.text) for r in before.collect()]
            new = {r.doc_id: r for r in after.collect()}
            near = plain_exact(old)
            assert set(new) == {i for i, _ in old}
            assert all(len(r.text) == r.n_chars and len(r.text) <= len(near[i]) for i, r in new.items())
        if name == "simhash_dedup":
            own = {r.doc_id: plain_fingerprint(r.text) for r in before.collect()}
            pairs = [(a, b) for a in own for b in own if a < b and (own[a] ^ own[b]).bit_count() <= 2]
            first = set(plain_groups(own, pairs).values())
            assert {r.doc_id for r in after.collect()} == first
        if name == "best_fit_packing":
            total = collections.Counter()
            for r in after.collect():
                total[r.doc_id] += r.n_tokens
            assert total == {r.doc_id: len(WORD.findall(r.text)) for r in before.collect()}
        before = after


def plain_exact(docs):
    """Texts without lines that stand earlier, by exact comparison only."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        kept = []
        for line in text.split("\n"):
            if len(line.strip()) < lines.MIN_CHARS or line.strip() not in seen:
                kept.append(line)
            seen.add(line.strip())
        out[doc] = "\n".join(kept)
    return out


def test_pipeline_of_odd_rows(spark):
    prose = "the cat of the house and a dog in this garden was on that mat with it "
    words = " ".join(f"{prose.split()[i % 15]} other{i}" for i in range(120))
    rows = [
        (1, words, "en", "s", 1), (1, words, "en", "s", 1), (None, words, None, None, None), (2, None, "en", "s", 0),
        (3, "", "en", "s", 0), (4, "x", None, None, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        found = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, found, SF_DIR)
        # The row without an id loses its line, which an earlier one has, and stays empty.
        left = [(r.doc_id, r.n_tokens) for r in found.collect()]
        assert sorted(left, key=str) == ([] if empty else [(1, 240), (None, 0)])


def test_run_is_the_stages_in_turn(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "piece", "start", "n_tokens", "bin_id", "bin_start"}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "best_fit_packing"]
