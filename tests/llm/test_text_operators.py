"""Packing, BPE, chat, HTML and quality rules against plain versions, and odd rows."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.oracle import compare, connect
from tidegauge.llm import bpe, chat, html, packing, quality
from tidegauge.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts(spark, table="documents"):
    return {r[0]: r[1] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").collect()}


# --- Packing -------------------------------------------------------------------


def test_best_fit_takes_the_tightest_compatible_bin():
    found = packing.best_fit([7, 6, 3, 3, 1], [1, 2, 1, 4, 0], 10)
    # The first 3 fits the first bin exactly but shares its mark, so it goes to the second.
    assert found == [(0, 0), (1, 0), (1, 6), (0, 7), (1, 9)]


def test_best_fit_equals_a_plain_search():
    rng = random.Random(5)
    for _ in range(50):
        sizes = sorted((rng.randint(1, 30) for _ in range(60)), reverse=True)
        marks = [1 << rng.randint(0, 3) if rng.random() < 0.6 else 0 for _ in sizes]
        bins, expected = [], []
        for size, mark in zip(sizes, marks, strict=True):
            fits = [(r, k) for k, (r, m) in enumerate(bins) if r >= size and not m & mark]
            if fits:
                residual, k = min(fits)
            else:
                residual, k = 40, len(bins)
                bins.append((40, 0))
            expected.append((k, 40 - residual))
            bins[k] = (residual - size, bins[k][1] | mark)
        assert packing.best_fit(sizes, marks, 40) == expected


def packed(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, source string, cluster long, bin_id int")
    return packing.pack(df, **how).collect()


def test_bins_are_within_capacity_and_without_conflicts(spark):
    rng = random.Random(1)
    rows = [(i, rng.randint(0, 300), f"s{rng.randint(0, 3)}", rng.randint(0, 40), 9) for i in range(400)]
    # A third of all rows from one source, copies of one document.
    rows += [(1000 + i, 50, "hot", 7, 9) for i in range(200)]
    found = packed(spark, rows, capacity=128)
    source, cluster = {r[0]: r[2] for r in rows}, {r[0]: r[3] for r in rows}
    bins = collections.defaultdict(list)
    spans = collections.defaultdict(list)
    for r in found:
        spans[r.doc_id].append((r.start, r.n_tokens))
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for held in bins.values():
        held.sort(key=lambda r: r.bin_start)
        assert held[0].bin_start == 0
        assert all(a.bin_start + a.n_tokens == b.bin_start for a, b in zip(held, held[1:], strict=False))
        assert sum(r.n_tokens for r in held) <= 128
        assert len({source[r.doc_id] for r in held}) == len(held)
        assert len({cluster[r.doc_id] for r in held}) == len(held)
    for doc, size, *_ in rows:
        own = sorted(spans[doc])
        assert sum(n for _, n in own) == size
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False))


def test_packing_odd_rows(spark):
    rows = [
        (None, 5, None, None, 0),
        (None, 5, None, None, 0),
        (1, None, "a", 1, 0),
        (2, 0, "a", 1, 0),
        (3, 256, "a", 1, 0),
        (4, -3, "a", 1, 0),
    ]
    found = packed(spark, rows, capacity=128)
    assert sorted((r.doc_id or 0, r.n_tokens, r.bin_id is None) for r in found) == [
        (0, 5, False), (0, 5, False), (1, 0, True), (2, 0, True), (3, 128, False), (3, 128, False), (4, 0, True),
    ]
    assert len({r.bin_id for r in found if r.doc_id is None}) == 1  # null marks conflict with nothing
    assert packed(spark, []) == []


def test_packing_query_covers_every_word(spark):
    total = collections.Counter()
    for r in QUERIES["op1_best_fit_packing"](spark, SF_DIR).collect():
        total[r.doc_id] += r.n_tokens
    assert total == {i: len(WORD.findall(t or "")) for i, t in texts(spark).items()}


# --- BPE -----------------------------------------------------------------------

ODD = [
    "", "  ", "a\x85b\xa0c d　e​f", "ΣΑΣ ΟΔΥΣΣΕΥΣ", "İstanbul ﬁ Å ẞ", "<|endoftext|",
    "a<|endoftext|>b <|startoftext|><|endoftext|>", "don't 'S 'Ll", "日本語 123 ४५ 🎉🎉", "a" * 300, "aaa aaaaa .....",
    "\x00\x01x�", "½ ² Ⅷ",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_equals_the_library(name):
    path = public_tokenizers.path(name)
    library, own = Tokenizer.from_file(path), bpe.PairIndexBpe(path)
    rng = random.Random(2)
    some = ODD + ["".join(rng.choice("ab ano!-.=eE\nthé") for _ in range(60)) for _ in range(800)]
    ids, bounds = own.encode(some)
    for k, text in enumerate(some):
        expected = library.encode(text, add_special_tokens=False).ids
        found = ids[bounds[k] : bounds[k + 1]].tolist()
        assert found == expected, text
        assert own.decode(found) == library.decode(expected, skip_special_tokens=False)
    again, _ = own.encode(some)
    assert (again == ids).all()


def test_a_pair_of_lower_rank_that_comes_up_goes_first(tmp_path):
    """Merges whose product takes part in an earlier merge, against one word at a time."""
    import json

    vocab = {c: i for i, c in enumerate("abcd")} | {"ab": 4, "bc": 5, "abc": 6, "abcd": 7, "aa": 8, "abca": 9}
    merges = [["abc", "a"], ["abc", "d"], ["b", "c"], ["a", "bc"], ["a", "b"], ["a", "a"], ["ab", "c"]]
    path = tmp_path / "t.json"
    path.write_text(
        json.dumps(
            {
                "added_tokens": [],
                "normalizer": None,
                "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"pattern": {"Regex": "[a-d]+"}}]},
                "decoder": None,
                "model": {"vocab": vocab, "merges": merges},
            }
        )
    )
    own = bpe.PairIndexBpe(str(path))
    ranks = {tuple(m): k for k, m in enumerate(merges)}

    def plain(word):
        parts = list(word)
        while True:
            found = [(ranks[p], k) for k, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
            if not found:
                return [vocab[p] for p in parts]
            _, k = min(found)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    rng = random.Random(3)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 14))) for _ in range(2000)]
    ids, bounds = own.encode(words)
    for k, word in enumerate(words):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == plain(word), word


def test_bpe_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {r[0]: tuple(r[1:]) for r in QUERIES["op2_bpe"](spark, SF_DIR).collect()}
    for doc, text in texts(spark).items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        assert found[doc] == (len(ids), sha(" ".join(map(str, ids))), sha(shown))


def test_bpe_odd_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(None, "a b", 1), (1, None, 1), (2, "", 1), (2, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = bpe.decode(bpe.encode(df, path), path).collect()
    assert sorted((r.doc_id or 0, len(r.ids), r.text) for r in found) == [
        (0, 2, "a</w> b</w>"), (1, 0, ""), (2, 0, ""), (2, 0, ""),
    ]
    assert bpe.encode(df.limit(0), path).count() == 0
    none = spark.createDataFrame([(1, None), (2, [7_000_000])], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode(none, path).collect()] == ["", ""]


# --- Chat ----------------------------------------------------------------------


def test_chat_query_equals_sql(spark):
    name = "op3_chat_format"
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []


def events(spark, rows):
    return spark.createDataFrame(
        rows, "conv_id long, seq long, kind string, target long, role string, text string, messages int"
    )


def test_deltas_edits_and_regenerations_are_folded(spark):
    rows = [
        (1, 0, "message", None, "user", "hi", 0),
        (1, 1, "message", None, "assistant", "", 0),
        (1, 2, "delta", 1, None, "one ", 0),
        (1, 3, "delta", 1, None, "two", 0),
        (1, 4, "regenerate", 1, None, None, 0),
        (1, 5, "delta", 1, None, "three", 0),
        (1, 6, "edit", 0, None, "hello", 0),
        (1, 7, "message", None, "user", "bye", 0),
    ]
    random.Random(0).shuffle(rows)
    (only,) = chat.fold(events(spark, rows)).collect()
    assert [tuple(m) for m in only.messages] == [("user", "hello"), ("assistant", "three"), ("user", "bye")]


def test_chat_odd_rows(spark):
    rows = [
        (None, 0, "message", None, None, None, 0),
        (2, 0, "message", None, "user", "b", 0),
        (2, 0, "message", None, "user", "a", 0),
        (2, 0, "message", None, "user", "a", 0),
        (2, None, None, None, "x\ny", "stray", 0),
    ]
    found = {r.conv_id: [tuple(m) for m in r.messages] for r in chat.fold(events(spark, rows)).collect()}
    assert found == {
        None: [("", "")],
        2: [("x\ny", "stray"), ("user", "a"), ("user", "a"), ("user", "b")],
    }
    assert chat.render(chat.fold(events(spark, []))).count() == 0


def test_rendering_is_reversible(spark):
    rng = random.Random(4)
    pieces = ["<|im_start|>", "<|im_end|>", "\\", "<", "|", "<\\|", "\n", "a", "<\\!>", "é", ">"]
    some = [
        [("".join(rng.choices(pieces, k=3)), "".join(rng.choices(pieces, k=rng.randint(0, 12)))) for _ in range(4)]
        + [("assistant", "".join(rng.choices(pieces, k=9)))]
        for _ in range(150)
    ]
    df = spark.createDataFrame(list(enumerate(some)), "conv_id int, messages array<struct<role string, text string>>")
    rendered = chat.render(df)
    back = rendered.select(
        "conv_id",
        chat.parse(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("segments")).alias("learned"),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("joined"),
        "formatted",
    )
    for r in back.collect():
        assert [tuple(t) for t in r.turns] == some[r.conv_id]
        assert r.learned == some[r.conv_id][-1][1] and r.joined == r.formatted


# --- HTML ----------------------------------------------------------------------


def test_main_text_of_a_page():
    page = """<!DOCTYPE html><html><head><title>No &amp; no</title><style>p{}</style>
    <script>if (a<b) "</p>";</script></head><body class="page"><header>top</header><nav><ul><li>menu<li>more</ul></nav>
    <div class="cookie-notice">we use <b>cookies</b></div><form>mail <input> <button>go</button></form>
    <article class=post><h1>Head &lt;line&gt;</h1><p>one&nbsp;t<b>wo<br>three <!-- no --> 1 < 2 &amp;&amp; 3
    <p>four<div class="advert">buy</div><ul><li>five</li></ul><script>x</script><section id="comments"><p>nice!</p>
    </section></article><aside>side</aside><footer>&copy; me</footer></body>"""
    assert " ".join(t for m, t in html.blocks_of(page) if m) == "Head <line> one two three 1 < 2 && 3 four five"


@pytest.mark.parametrize(
    "page",
    ["", "<", "<p", "<div><", "</div></p>", "<script>never closed", "<!-- never closed", "a&b;&#x;&#1114112;", "<p a='>x"],
)
def test_broken_pages_do_no_harm(page):
    html.blocks_of(page)


def test_unclosed_advert_ends_at_the_article():
    page = "<div class=ad>buy<article><p>text</article>"
    assert html.blocks_of(page) == [(True, "text")]


def test_covered_tokens_equal_a_plain_search():
    rng = random.Random(6)
    shared = [rng.choice("abcdef") for _ in range(12)]
    for _ in range(30):
        streams = []
        for _ in range(6):
            s = [rng.choice("abcdef") for _ in range(rng.randint(0, 30))]
            at = rng.randint(0, len(s))
            streams.append(s[:at] + shared[: rng.randint(0, 12)] + s[at:])
        streams.append(list(streams[0]))
        found = html.covered_tokens(streams, 4)
        for k, s in enumerate(streams):
            plain = np.zeros(len(s), bool)
            for i in range(len(s) - 3):
                if any(
                    t != s and any(t[j : j + 4] == s[i : i + 4] for j in range(len(t) - 3)) for t in streams
                ):
                    plain[i : i + 4] = True
            assert (found[k] == plain).all()


def test_pages_without_main_text_keep_what_is_their_own(spark):
    shared = "<p>All of our pages say this one long sentence at the end</p>"
    rows = [(i, f"http://h.example/{i}", f"<div><p>own words here number {i}</p></div>{shared}", 0) for i in range(4)]
    rows += [(9, "http://other.example/", f"<p>alone</p>{shared}", 0), (10, None, None, 0), (11, "x", "", 0)]
    rows += [(10, None, None, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = sorted((r.page_id, r.text) for r in html.extract(df).collect())
    assert found[:4] == [(i, f"own words here number {i}") for i in range(4)]
    assert found[4][1].startswith("alone All of our pages") and found[5:] == [(10, ""), (10, ""), (11, "")]
    assert html.extract(df.limit(0)).count() == 0


def test_repeats_are_found_over_a_whole_large_host(spark, monkeypatch):
    """Passages of only two pages, and pages that are the same, at any size of group."""
    rng = random.Random(4)
    passages = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(10)) for _ in range(20)]
    bodies = [f"own words of page {k} {passages[k % 20]} and more of {k}" for k in range(40)]
    bodies += [bodies[0], "too short"]
    rows = [(k, f"http://h.example/{k}", f"<p>{b}</p>") for k, b in enumerate(bodies)]
    rows.append((99, "http://h.example/m", f"<main>main text</main><p>{bodies[3]} and so on</p>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    streams = [b.split() for b in bodies] + [f"{bodies[3]} and so on".split()]
    expected = {k: html.unique_text([b], c) for k, (b, c) in enumerate(zip(bodies, html.covered_tokens(streams)))}
    expected[99] = "main text"
    for pages in (256, 4):
        monkeypatch.setattr(html, "HOST_PAGES", pages)
        assert {r.page_id: r.text for r in html.extract(df).collect()} == expected


def test_search_chooses_between_a_notice_and_a_story(spark, monkeypatch):
    """On a host on which every page marks a main text the search runs too, across all parts."""
    wall = "<main><p>Before you read on please say that you agree to all of our terms</p></main>"
    story = [" ".join(f"story{k}x{j}" for j in range(30)) for k in range(9)]
    rows = [(k, f"http://h.example/{k}", f"{wall}<div><p>{s}</p></div>") for k, s in enumerate(story)]
    # An article that stands on two pages stays whole, whatever little stands beside it.
    shared = " ".join(f"word{j}" for j in range(40))
    rows += [(k, "//g.example/", f"<article><p>{shared}</p></article><p>posted by {k}</p>") for k in (20, 21)]
    # Copies of a page do not make it a notice, nor do the pages of another host.
    rows += [(k, "//f.example/", rows[0][2]) for k in (30, 31, 32)]
    expected = dict(enumerate(story)) | dict.fromkeys((20, 21), shared)
    expected |= dict.fromkeys((30, 31, 32), wall[9:-11])
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for pages in (4096, 2):
        monkeypatch.setattr(html, "HOST_PAGES", pages)
        assert {r.page_id: r.text for r in html.extract(df).collect()} == expected


def test_parts_find_what_one_suffix_array_finds():
    """Weights of the prefixes of a part, by its suffix array and by their hashes."""
    rng = random.Random(8)
    pages = [
        {"host": rng.choice("xy"), "main": [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 25)))], "other": []}
        for _ in range(30)
    ]
    for followers in (None, [0, 3, 4]):
        part = html._Part(pages, followers)
        hashes, weights = part.by_suffix_array()
        plain = {}
        for h, o in zip(part.hashes.tolist(), part.owner.tolist(), strict=True):
            plain.setdefault(h, set()).update({o} - {-1})
        assert dict(zip(hashes.tolist(), weights.tolist(), strict=True)) == {h: min(len(o), 2) for h, o in plain.items()}
        values, found, _ = part.candidates(np.ones(len(part.starts), bool))
        assert dict(zip(values.tolist(), found.tolist(), strict=True)) == {h: min(len(o), 2) for h, o in plain.items()}


def test_html_query(spark):
    import html as library

    found = {r.page_id: r for r in QUERIES["op4_html_text"](spark, SF_DIR).collect()}
    for page in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", page.html, re.S)[1]
        bare = re.sub(r"<(?!b>)[^>]*>", " ", article).replace("<b>", "")
        text = " ".join(library.unescape(bare).split())
        r = found[page.page_id]
        assert (r.url, r.text, r.n_chars) == (page.url, text, len(text))


# --- Quality rules --------------------------------------------------------------


def plain_measures(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    count = collections.Counter(windows)
    covered = {k for i, w in enumerate(windows) if count[w] > 1 for k in (i, i + 1, i + 2)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_measures_equal_plain_ones(spark):
    found = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, SF_DIR).collect()}
    for doc, text in texts(spark).items():
        r, own = found[doc], plain_measures(text or "")
        assert tuple(r[m] for m in quality.MEASURES) == own
        assert r.base_failed == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        assert not (r.base_failed and r.kept)


def test_repeats_by_list_and_by_sorting_are_the_same(spark):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        vocabulary = [f"w{k}" for k in range(rng.choice([3, 12, 40]))]
        rows.append((i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 900)))))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    found = {r.doc_id: r for r in quality.measures(df).collect()}
    assert all(found[i].n_repeat_words == plain_measures(t)[4] for i, t in rows)


def test_jensen_shannon_equals_a_plain_sum(spark):
    def plain(p, q):
        p, q = np.array(p) / sum(p), np.array(q) / sum(q)
        m = (p + q) / 2
        part = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m, strict=True) if a > 0)
        return np.sqrt((part(p) + part(q)) / 2)

    rows = [([1.0, 2.0, 3.0], [3.0, 2.0, 1.0]), ([1.0, 0.0], [0.0, 5.0]), ([2.0, 2.0], [1.0, 1.0])]
    df = spark.createDataFrame(rows, "p array<double>, q array<double>")
    found = [r[0] for r in df.select(quality.jensen_shannon(F.col("p"), F.col("q"))).collect()]
    assert found == pytest.approx([plain(p, q) for p, q in rows], abs=1e-7)


def test_quality_keeps_prose_and_drops_what_is_unlike_it(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    judged = QUERIES["op9_quality_rules"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rates = judged.filter("not base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")))
    found = {r[0]: r[1] for r in rates.collect()}
    assert found[1] == 1.0 and found[0] < 0.5
    assert docs.count() > 0


def test_quality_odd_rows(spark):
    prose = "the cat of the house and a dog in the garden was on the mat " * 20
    rows = [
        (None, prose, "en", "x", 1),
        (1, None, "en", None, 1),
        (2, "", None, "x", 1),
        (3, " ".join(f"word{i}" for i in range(80)), None, "x", 1),
        (3, " ".join(f"word{i}" for i in range(80)), None, "x", 1),
        (4, " ".join(f"word{i}" for i in range(80)), "xx", "x", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string, n_words int")
    found = quality.quality(df, keep=["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in found) == [
        (0, 300, True, False), (1, 0, True, False), (2, 0, True, False),
        (3, 80, False, True), (3, 80, False, True), (4, 80, False, True),
    ]
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    assert sorted(tuple(r) for r in kept.collect()) == sorted(tuple(r) for r in rows if r[0] in (3, 4))
    assert quality.keep_good(df.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", ["op4_html_text", "op10_embedding_dedup"])
def test_query_equals_its_sql(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    assert compare(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) == []
