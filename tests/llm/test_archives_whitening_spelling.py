"""WARC archives, embedding whitening and spelling variants against plain versions."""

import collections
import glob
import hashlib
import io
import itertools
import random
import re
import struct
import zlib
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tidegauge.llm import spelling, warc, whitening
from tidegauge.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

# --- WARC ----------------------------------------------------------------------

PAGES = "page_id long, url string, html string, payload string, archive int"
LONG = "<p>" + "lang ö " * 40_000
ROWS = [
    (7, "http://a/7", "x" * 100, "p", 1),
    (3, "http://a/3", "x" * 100, None, 2),
    (5, None, "x" * 100, "", 3),
    (9, "http://a/9", "x" * 99, "", 4),
    (8, "http://a/ 8\r\nWARC-Type: metadata", "x" * 99, "", 5),
    (1, "http://b/1", None, "", 6),
    (2, "http://b/2", "", "", 7),
    (11, "http://b/11", LONG, "", 8),
    (10, "http://b/10", LONG, "", 8),
    (10, "http://b/10", LONG, "", 8),
    (None, "http://c/", LONG, "", 8),
    (None, "http://c/", "only without an id " * 9, "", 8),
    (None, "http://c/", "only without an id " * 9, "", 8),
    (-4, "http://c/", "line\r\n\r\nWARC/1.1\r\n" * 9, "", 8),
    ((1 << 63) - 1, "http://ü/ö", "größe " * 30, "", 8),
]


@pytest.fixture(scope="module")
def archived(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "out")
    warc.write_archives(spark.createDataFrame(ROWS, PAGES).repartition(2), path, archive_bytes=50_000)
    return path


def test_archives_give_back_every_page(spark, archived):
    found = warc.read_archives(spark, archived).collect()
    assert len(found) == len(ROWS) and all(r["intact"] for r in found)
    whole = {}
    for key, _, html, *_ in ROWS:
        whole.setdefault(key, set()).add((html or "").encode())
    for r in found:
        assert r["payload_digest"] in {hashlib.sha256(x).hexdigest() for x in whole[r["page_id"]]}
        if r["record_type"] == "response":
            assert r["payload"] in whole[r["page_id"]] and r["payload_bytes"] == len(r["payload"])
    kinds = collections.Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in found)
    first = (10, "response", None)
    assert kinds[(3, "response", None)] == 1 and kinds[(5, "revisit", 3)] == 1
    assert kinds[(7, "revisit", 3)] == 1 and kinds[(9, "response", None)] == 1
    assert kinds[first] == 2 and kinds[(11, "revisit", 10)] == 1
    assert kinds[(None, "revisit", 10)] == 1 and kinds[(None, "response", None)] == 2
    urls = {r["page_id"]: r["url"] for r in found}
    assert urls[5] is None and urls[(1 << 63) - 1] == "http://ü/ö"
    assert urls[8] == "http://a/%208%0D%0AWARC-Type:%20metadata"


def test_revisits_get_the_payload_they_refer_to(spark, archived):
    found = warc.resolve_revisits(warc.read_archives(spark, archived)).collect()
    assert len(found) == len(ROWS)
    for r in found:
        assert hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"]
        assert len(r["payload"]) == r["payload_bytes"]


def test_an_archive_is_a_stream_of_frames_led_by_its_dictionary(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<html><p>page {i} of the archive {i * i}</p>" * 9) for i in range(600)]
    path = str(tmp_path / "out")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    (file,) = glob.glob(f"{path}/archive=0/part-*")
    data = open(file, "rb").read()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    assert dictionary[:4] == struct.pack("<I", 0xEC30A437)
    held = zstandard.ZstdCompressionDict(dictionary)
    # Any decoder that is given the dictionary reads the file as one text of records.
    reader = zstandard.ZstdDecompressor(dict_data=held).stream_reader(
        io.BytesIO(data[8 + size :]), read_across_frames=True
    )
    text = reader.read()
    assert text.count(b"WARC/1.1\r\n") == 601 and text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    records = list(warc.open_archive(data))
    assert b"".join(records) == text
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(data) < plain
    with pytest.raises(ValueError):
        list(warc.open_archive(data[:-30]))


def test_a_changed_payload_is_told(spark):
    record = warc.page_record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, warc.DATE)
    assert warc.parse_record(record)["intact"]
    assert not warc.parse_record(record.replace(b"\r\n\r\npayload", b"\r\n\r\npaylaad"))["intact"]


def test_record_ids_spell_their_keys():
    for key in (0, 1, -1, 12345678901234567, (1 << 63) - 1, -(1 << 63), None):
        assert warc.key_of(warc.record_id(key)) == key
    assert warc.record_id(0) != warc.record_id(None)
    assert warc.key_of("<urn:uuid:12345678-1234-4234-9234-123456789abc>") is None
    assert warc.key_of("nothing") is None and warc.key_of(None) is None


def test_no_pages_give_no_archive(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.read_archives(spark, path).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_archive_query_equals_its_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert compare(QUERIES["op11_warc"](spark, folder), connect(folder), ORACLES["op11_warc"]) == []


def test_query_with_repeated_pages_equals_its_sql(spark, tmp_path):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    more = pages.withColumn("page_id", F.col("page_id") + 1000).union(
        pages.where("page_id < 9").withColumn("page_id", F.col("page_id") - 500)
    )
    short = pages.where("page_id < 6").select(F.col("page_id") + 5000, "url", F.substring("html", 1, 40))
    folder = str(tmp_path)
    pages.union(more).union(short).coalesce(1).write.parquet(f"{folder}/all")
    (file,) = glob.glob(f"{folder}/all/part-*")
    con = connect(folder)
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{file}')")
    spark.read.parquet(file).write.parquet(f"{folder}/pages.parquet")
    assert compare(QUERIES["op11_warc"](spark, folder), con, ORACLES["op11_warc"]) == []


# --- Whitening -----------------------------------------------------------------


def plain_whitening(vectors, wanted=4):
    """By floating point: rows of (n, deviation, whitened by component), and explained."""
    x = [tuple(int(np.floor(256 * float(c))) for c in v) for v in vectors]
    fit = np.array(sorted(set(x)))
    n, sums = len(fit), [int(v) for v in fit.sum(axis=0)]
    v = np.cov(fit.T, bias=True)
    e, axes = np.linalg.eigh(v)
    order = np.argsort(-e)[:wanted]
    e, axes, trace = e[order], axes[:, order], np.trace(v)
    white = (np.array(x) - fit.mean(axis=0)) @ axes / np.sqrt(e)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, white, e / trace


def test_query_equals_floating_point(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    n, deviation, white, explained = plain_whitening([r["embedding"] for r in rows])
    place = {r["vec_id"]: i for i, r in enumerate(rows)}
    found = QUERIES["op12_embedding_whitening"](spark, SF_DIR).collect()
    assert len(found) == 4 * len(rows)
    signs = {}
    for r in found:
        i, k = place[r["vec_id"]], r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation[i])
        assert r["explained"] == pytest.approx(explained[k], rel=1e-9)
        assert r["identity_error"] < 1e-9
        sign = signs.setdefault(k, 1 if abs(r["whitened"] - white[i, k]) < 1e-6 else -1)
        assert r["whitened"] == pytest.approx(sign * white[i, k], abs=1e-7)


def test_polynomial_is_exact(spark):
    rng = np.random.default_rng(3)
    for d in (1, 2, 3, 6):
        a = rng.integers(-900, 900, (d + 2, d)).astype(object)
        matrix = a.T @ a
        # By determinants of t - matrix at whole numbers.
        found = whitening.charpoly(spark, matrix)
        for t in range(-2, 3):
            m = [[Fraction(int((t if i == j else 0) - matrix[i, j])) for j in range(d)] for i in range(d)]
            det = Fraction(1)
            for i in range(d):
                pivot = next((r for r in range(i, d) if m[r][i]), None)
                if pivot is None:
                    det = Fraction(0)
                    break
                if pivot != i:
                    m[i], m[pivot], det = m[pivot], m[i], -det
                det *= m[i][i]
                for r in range(i + 1, d):
                    f = m[r][i] / m[i][i]
                    m[r] = [x - f * y for x, y in zip(m[r], m[i], strict=True)]
            assert sum(c * t**k for k, c in enumerate(found)) == det


def polynomial(roots):
    c = [1]
    for r in roots:
        c = [(c[i - 1] if i else 0) - (r * c[i] if i < len(c) else 0) for i in range(len(c) + 1)]
    return c


def test_roots_are_counted_and_isolated():
    c = polynomial([9, 7, 7, 7, 1, 10**12])
    assert [whitening.roots_above(c, a, 0) for a in (0, 1, 6, 7, 8, 9, 10)] == [6, 5, 5, 2, 2, 1, 1]
    assert whitening.roots_above(c, 13, 1) == 5
    for k, (root, above, shared) in enumerate(
        [(10**12, 0, 1), (9, 1, 1), (7, 2, 3), (7, 2, 3), (7, 2, 3), (1, 5, 1)], 1
    ):
        found, before, group = whitening.isolate(c, k)
        assert abs(found - root) * 2**100 < root and (before, group) == (above, shared)
    close = polynomial([10**9, 10**9 + 1, 10**9 + 3])
    assert [round(whitening.isolate(close, k)[0]) for k in (1, 2, 3)] == [10**9 + 3, 10**9 + 1, 10**9]


def test_equal_eigenvalues_get_an_orthonormal_basis():
    matrix = np.array(np.diag([5, 5, 5, 2]), object)
    c = polynomial([5, 5, 5, 2])
    found = [whitening.component(matrix, c, k) for k in (1, 2, 3, 4)]
    assert [round(float(e), 12) for e, _ in found] == [5, 5, 5, 2]
    basis = np.array([v for _, v in found])
    assert np.allclose(basis @ basis.T, np.eye(4), atol=1e-14)
    assert np.allclose(np.abs(basis[3]), [0, 0, 0, 1])


def test_large_entries_are_summed_exactly():
    rng = np.random.default_rng(4)
    x = rng.integers(-(2**61), 2**61, (50, 3))
    y = x.astype(object)
    assert (whitening.exact_gram(x) == y.T @ y).all()
    assert (whitening.exact_gram(x[:0]) == np.zeros((3, 3), object)).all()


def whitened(spark, rows, kind="vec_id long, embedding array<double>, x int, n int", **how):
    return whitening.whiten(spark.createDataFrame(rows, kind), **how).collect()


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = [(i, [float(i % 3), float(i * i % 7), 2.0], 1, 1) for i in range(12)]
    odd = [
        (20, None, 1, 1),
        (21, [], 1, 1),
        (22, [1.0, None, 2.0], 1, 1),
        (23, [1.0, nan, 2.0], 1, 1),
        (24, [1.0, inf, 2.0], 1, 1),
        (25, [1e300, 1.0, 2.0], 1, 1),
        (26, [1.0, 2.0], 1, 1),
        (None, [0.0, 0.0, 2.0], 1, 1),
        (3, good[3][1], 1, 1),
    ]
    found = whitened(spark, good + odd)
    ids = collections.Counter(r["vec_id"] for r in found)
    # The third entry never changes: two components are left.
    assert ids == {**{i: 2 for i in range(12)}, None: 2, 3: 4}
    n, deviation, white, explained = plain_whitening([v for _, v, *_ in good], 2)
    for r in found:
        if r["vec_id"] in (0, 5, 11):
            assert r["deviation"] == deviation[r["vec_id"]] and r["n"] == n
            assert abs(r["whitened"]) == pytest.approx(abs(white[r["vec_id"], r["component"] - 1]))
    assert whitened(spark, []) == []
    assert whitened(spark, [(1, [1.0, 2.0], 1, 1), (2, [1.0, 2.0], 1, 1)]) == []
    assert whitened(spark, [(20, None, 1, 1)]) == []


def test_negative_entries_are_floored_and_negative_zero_is_zero(spark):
    rows = [(1, [-0.0, 0.001]), (2, [0.0, -0.001]), (3, [-0.0, 0.0]), (4, [1.0, 0.5])]
    found = whitened(spark, rows, "vec_id long, embedding array<float>")
    # 0.001 and 0.0 fall together, -0.001 becomes -1.
    assert {r["n"] for r in found} == {3}


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(i) * 2**45, float(i * i)]) for i in range(5)]
    found = whitened(spark, rows, "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in found if r["vec_id"] == 0} == {None}
    assert all(r["identity_error"] < 1e-4 for r in found)


# --- Spelling ------------------------------------------------------------------


def plain_words(texts, slip=199):
    n = collections.Counter()
    for id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{id}:{run}".encode())
            if slip and h % slip == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n, ratio=5):
    # All texts one deletion away find every near pair.
    held = collections.defaultdict(set)
    for w in n:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            held[v].add(w)
    near = collections.defaultdict(set)
    for group in held.values():
        for a, b in itertools.combinations(group, 2):
            if is_near(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    rows = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return rows


def variants(spark, n):
    words = spark.createDataFrame([(w, c, "x") for w, c in n.items()], "word string, n long, prefix string")
    found = spelling.group_variants(words).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def test_variant_query_equals_plain_search(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = plain_variants(plain_words([tuple(r) for r in rows]))
    found = QUERIES["op13_spelling_variants"](spark, SF_DIR)
    assert {tuple(r) for r in found.collect()} == expected
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert any(r[4] for r in expected)


def test_slips_and_letters(spark):
    texts = [(i, f"Größenwahn GRÖSSENWAHN ×÷×÷×÷× naïveté_naïveté abcdefg{i % 3}") for i in range(400)]
    docs = spark.createDataFrame([*texts, (None, "nullid " * 5), (9, None), (9, "")], "doc_id long, text string")
    expected = plain_words([*texts, ("", "nullid " * 5)])
    found = spelling.count_words(docs, slip=199).collect()
    assert {r["word"]: r["n"] for r in found} == expected and len(found) == len(expected)
    assert "größenwahn" in expected and "grÖssenwahn" in expected


@pytest.mark.parametrize("letters,seed", [("ab", 1), ("abc", 2), ("aé", 3)])
def test_words_of_few_letters(spark, letters, seed):
    """Runs of equal characters, where one deletion has several places."""
    rng = random.Random(seed)
    n = {
        "".join(rng.choice(letters) for _ in range(rng.randint(1, 9))): rng.choice([1, 5, 5, 30, 150, 800])
        for _ in range(300)
    }
    assert variants(spark, n) == plain_variants(n)


def test_roots_follow_the_whole_chain(spark):
    n = {("abcdefgh"[:k] + "x" * (12 - k)): 5 ** (k + 1) for k in range(9)}
    rows = variants(spark, n)
    assert rows == plain_variants(n)
    assert {r[2] for r in rows} == {"abcdefghxxxx"}


def test_one_group_of_all_letters(spark):
    letters = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
    n = {f"wor{c}word": 10 for c in letters} | {"worword": 50}
    assert variants(spark, n) == plain_variants(n)


def test_variants_write_few_files(spark, monkeypatch):
    """Each file costs processes and look-ups, however few its words are."""
    n = {f"wor{a}{b}word": 5 ** (1 + (ord(a) + ord(b)) % 6) for a in "abcdefgh" for b in "abcdefgh"}
    expected, tables, write = plain_variants(n), [], spelling.written
    monkeypatch.setattr(spelling, "written", lambda *a: tables.append(write(*a)) or tables[-1])
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(x) for x in names]
    dealt = 24 * spark.sparkContext.defaultParallelism
    try:
        for name, value in zip(names, (dealt, "false"), strict=True):
            spark.conf.set(name, value)
        words = spark.createDataFrame(list(n.items()), "word string, n long")
        found = spelling.group_variants(words)
        assert found.rdd.getNumPartitions() <= dealt // 8
        assert {tuple(r) for r in found.collect()} == expected
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
    assert sum(len(t.inputFiles()) for t in tables) <= dealt // 8


def test_no_words(spark):
    assert variants(spark, {}) == set()
    assert variants(spark, {"single": 7}) == {("single", None, "single", 7, 0, None)}
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "12 34")], "doc_id long, text string")
    assert spelling.group_variants(spelling.count_words(docs)).count() == 0


def test_decimals_of_the_session_are_left_alone(spark):
    whitening.component(np.array(np.diag([3, 1]), object), polynomial([3, 1]), 1)
    assert str(Decimal(1) / 3) == "0.3333333333333333333333333333"
