"""Scores, extraction, decontamination, token counts and the pipeline, against plain Python."""

import math
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_prose import prose

import corpus_pipeline
from annolink.llm import decontaminate, hashing, html_extraction, lm_scoring, quality, token_counts, toxicity
from annolink.llm import queries as llm

public_tokenizers = pytest.importorskip("public_tokenizers")


def words_of(text):
    return (text or "").encode().lower().split()


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


# 1: language model


def test_lm_scores(documents, odd_rows):
    passage = prose(9, 60)
    rows = odd_rows + [(100 + i, f"{prose(i, 30, 20)} {passage if i % 3 == 0 else ''}") for i in range(60)]
    got = lm_scoring.lm_scores(documents(rows), frequent=50, fit_rows=40).collect()
    counts = Counter(t for d, x in rows if fold(d, 5) != 1 for t in [*words_of(x), b""])
    n, v = sum(counts.values()), len(counts)

    def exact(d, x):
        tokens = [*words_of(x), b""]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        return d, fold(d, 5) == 1, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)

    assert sorted((tuple(r)[:5] + (round(r.base_score, 6),) for r in got), key=str) == sorted((exact(*r) for r in rows), key=str)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)


def test_filter_gives_counts_back_and_probabilities_sum_to_one(spark):
    text = [f"{prose(i % 7, 40, 5)}" for i in range(40)]
    docs = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(text)], "doc_id long, text binary")
    model, _, words = lm_scoring.train_model(docs, frequent=20, fit_rows=20)
    hashes = lm_scoring.WordHash()
    pairs = Counter(p for t in text for w in [t.split()] for p in zip(w, w[1:], strict=False))
    names = list(pairs)
    keys = lm_scoring.pair_keys(hashes.of([a.encode() for a, _ in names]), hashes.of([b.encode() for _, b in names]))
    found = model.filter.counts(keys)
    assert max(abs(f / pairs[p] - 1) for f, p in zip(found, names, strict=True)) < 0.35
    assert not model.filter.counts(lm_scoring.mix64(np.arange(1000, dtype=np.uint64))).any()
    vocabulary = np.append(hashes.of(sorted({w.encode() for t in text for w in t.split()})), lm_scoring.END)
    context = hashes.of([text[0].split()[3].encode()])[0]
    total = 0.0
    for token in [*vocabulary, np.uint64(12345)]:
        tokens = np.array([context, token])
        total += 10 ** model.log10(tokens, model.exact(tokens), np.array([0]))[1]
    assert abs(total - 1) < 0.1
    assert words.count() == len(vocabulary)


def test_segments_grow_with_the_texts():
    assert [lm_scoring.n_segments(n) for n in (0, 1, 8 * 10**9, 10**10, 10**14)] == [1024, 1024, 1024, 2048, 1 << 24]
    keys = lm_scoring.mix64(np.arange(50_000, dtype=np.uint64))
    for segments in (1024, 4096):
        depths = np.arange(segments) % 3
        part = lm_scoring.part_of(keys, depths)
        assert (np.diff(part[np.argsort(keys)]) >= 0).all() and part.max() < (1 << depths).sum()
        assert np.bincount(lm_scoring.segment_of(keys, segments), minlength=segments).min() > 0


def test_more_segments_give_the_same_counts(documents, monkeypatch):
    docs = documents([(100 + i, prose(i, 30, 20)) for i in range(80)])
    few = {r.doc_id: r for r in lm_scoring.lm_scores(docs, frequent=50).collect()}
    monkeypatch.setattr(lm_scoring, "SEGMENT_TEXT", 5)
    for r in lm_scoring.lm_scores(docs, frequent=50).collect():
        own = few[r.doc_id]
        assert tuple(r)[:5] == tuple(own)[:5] and abs(r.base_score - own.base_score) < 1e-6
        # Another filter has other false answers, but few.
        assert abs(r.score - own.score) < 0.05 * abs(own.score)


def test_a_segment_is_divided_until_it_keeps_every_level():
    keys = lm_scoring.mix64(np.arange(400_000, dtype=np.uint64)) >> np.uint64(10) | np.uint64(7 << 54)
    levels = lm_scoring.level_of(np.where(np.arange(400_000) < 1_000, 9, 1))
    parts = lm_scoring.divided(keys, levels, lm_scoring.SEGMENTS)
    assert all(0 < np.unpackbits(p).mean() < 0.51 for p in parts)
    depths = np.zeros(lm_scoring.SEGMENTS, np.int64)
    depths[7] = len(parts).bit_length() - 1
    held = lm_scoring.Filter(np.concatenate(parts), np.arange(lm_scoring.LEVELS), depths, first=7)
    assert len(parts) == 1 << depths[7] and (held.levels(keys) >= levels).all()
    assert (held.levels(keys) == levels).mean() > 0.8


def test_a_filter_in_shards_gives_the_same_scores(documents, odd_rows):
    docs = documents(odd_rows + [(100 + i, prose(i, 30, 20)) for i in range(60)])
    at_once = lm_scoring.lm_scores(docs, frequent=50).collect()
    in_shards = lm_scoring.lm_scores(docs, frequent=50, broadcast_parts=0, shard_parts=100).collect()

    def rows(found):
        return sorted((str(tuple(r)[:5]), round(r.base_score, 6), round(r.score, 6)) for r in found)

    assert rows(at_once) == rows(in_shards)


def test_lm_scores_of_nothing(documents):
    assert lm_scoring.lm_scores(documents([])).count() == 0


def test_words_are_hashed_and_looked_up_many_at_a_time(monkeypatch):
    signs = [chr(c) for c in (*range(0x21, 0x7F), 0x1C, 0xE9, 0x416, 0x4E2D, 0)]
    words = ["".join(signs[(7 * n + 3 * i * i) % len(signs)] for i in range(n)) for n in range(1, 60) for _ in range(3)]
    texts = ["", " \n", *words, "", "A\tBc  dEf\x0b", "x" * 5_000, " ".join(words * 9), "é ü x\x1cy", " lead", "trail ", ""]
    column = pa.array([t.encode() for t in texts], pa.binary())
    expected = [[xxhash.xxh3_64_intdigest(w) for w in words_of(t)] for t in texts]
    monkeypatch.setattr(hashing, "PIECE", 2_000)
    # Words of up to 16 bytes never pass the dictionary, so a task neither makes an object of each nor keeps it.
    for part in (column, column.slice(3), column.cast(pa.large_binary()), column.slice(2, 0)):
        hashes, first = lm_scoring.WordHash(), 0 if part.offset == 0 else part.offset
        rows = [(row, tokens) for own, tokens, of, _ in lm_scoring._chunks(part, hashes, 700) for row, tokens in zip(own, np.split(tokens, np.flatnonzero(np.diff(of)) + 1), strict=True)]
        assert [r for r, _ in rows] == list(range(len(part)))
        assert [t.tolist() for _, t in rows] == [[*e, int(lm_scoring.END)] for e in expected[first : first + len(part)]]
        assert all(len(w) > hashing.SHORT for w in hashes)
    # The end of a word's bits, and more words than one place of the index has.
    keys = np.r_[lm_scoring.mix64(np.arange(3_000, dtype=np.uint64)), np.arange(1, 41, dtype=np.uint64), np.uint64(2**64 - 2)]
    held = lm_scoring.Filter(np.zeros(0, np.uint8), np.arange(lm_scoring.LEVELS), np.zeros(1024, np.int64))
    model = lm_scoring.Model(held, keys[::2], np.arange(len(keys))[::2] + 1, 9, 9)
    assert model.exact(keys).tolist() == [i + 1 if i % 2 == 0 else -1 for i in range(len(keys))]
    assert model.exact(np.array([2**64 - 1], np.uint64)).tolist() == [-1]


def test_a_key_is_probed_once_for_a_chunk():
    keys = lm_scoring.mix64(np.arange(5_000, dtype=np.uint64) % np.uint64(50))
    bits = np.zeros(lm_scoring.SEGMENTS * lm_scoring.SEGMENT_BITS // 8, np.uint8)
    held, asked = lm_scoring.Filter(bits, np.arange(lm_scoring.LEVELS), np.zeros(lm_scoring.SEGMENTS, np.int64)), []
    held.levels = lambda k, own=held.levels: asked.append(k) or own(k)
    assert not held.counts(keys).any()
    assert [len(k) for k in asked] == [50] and (np.diff(asked[0].astype(object)) > 0).all()


# 2: main text of pages

PAGE = """<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div class="cookie-notice">We use cookies</div><div id="wrap"><div class="post-content"><h2>Head &amp; more</h2>
<p>First paragraph with <b>bold</b>text, and commas, and so on. It goes on for some time.<script>var x="</p>";</script>
<div class="related"><a href=x>other</a> <a>one</a></div><p>Second &#233; paragraph<br>line. This is long
<form><input><label>mail</label></form><ul><li>item one<li>item two</ul></div>
<div class="sidebar"><p>side words are here, too.</p></div></div>
<section id="comments"><p>I think this is a great article, thank you, indeed.</p></section><footer>(c)</footer>"""
MAIN = (
    "Head & more First paragraph with boldtext, and commas, and so on. It goes on for some time. "
    "Second é paragraph line. This is long item one item two"
)


def test_main_texts(spark):
    import os

    sf = "/root/testdata/sf0.001/pages.parquet"
    if not os.path.exists(sf):
        pytest.skip("needs the given tables")
    pages = spark.read.parquet(sf)
    odd = spark.createDataFrame([(-1, "u", PAGE), (-2, None, None), (-3, "u", ""), (None, "u", "<p"), (-1, "u", PAGE)], pages.schema)
    table = pages.union(odd).selectExpr("*", "1 as text", "2 as h")
    got = html_extraction.main_texts(table).collect()
    assert len(got) == table.count()
    assert [r.text for r in got if r.page_id == -1] == [MAIN, MAIN]
    assert [r.text for r in got if r.page_id in (-2, -3) or r.page_id is None] == [""] * 3
    assert all(r.n_chars == len(r.text) for r in got)
    import html
    import re

    for page, row in zip(*(sorted((r for r in rows if (r.page_id or -1) >= 0), key=lambda r: r.page_id) for rows in (pages.collect(), got)), strict=True):
        inner = re.search("<article>(.*?)</article>", page.html, re.S)[1]
        inner = re.sub("<(/?(p|h1|li|ul)|br)[^>]*>", " ", inner)
        assert row.text == " ".join(html.unescape(re.sub("<[^>]+>", "", inner)).split())
    assert html_extraction.main_texts(table.limit(0)).count() == 0


def test_nothing_is_kept_under_a_removed_element():
    draw = np.random.default_rng(5)
    for _ in range(50):
        parents = [-1] + [int(draw.integers(0, i)) for i in range(1, 9)]
        logits = draw.normal(0, 3, 9)
        kept = html_extraction.decode(parents, logits)
        best = max(
            (sum(l if k >> i & 1 else -l for i, l in enumerate(logits) if i), k)
            for k in range(1, 512, 2)
            if all(k >> parents[i] & 1 or not k >> i & 1 for i in range(1, 9))
        )[1]
        assert kept == [bool(best >> i & 1) for i in range(9)]


def test_pages_are_read_to_the_end():
    read = lambda s: html_extraction.Page(s).text([True] * 99)
    assert read("a<b>b</b>c<p>d<p>e<!-- x --> f &lt; 1 < 2") == "abc d e f < 1 < 2"
    assert read("<div title='a>b'>x</div><br/>y<img src=z>") == "x y"
    assert read('<a href="open') == "" and read("<script>never ends") == "" and read("x<!--") == "x"
    assert html_extraction.extract("<article>a</article><nav>b</nav>", None) == "a"


def shaped_pages():
    """(shape, html, main text): pages whose main text is known, as they are built around it."""
    nav = '<nav><ul><li><a href="/">Home</a></li><li><a href="/b">News of the day</a></li></ul></nav>'
    foot = "<footer><p>Copyright 2020 by the publisher, all rights reserved in all countries and for all time.</p></footer>"
    side = '<div class="sidebar"><h3>Related</h3><p>You may also want to read this other teaser about something else entirely.</p></div>'
    cookie = '<div id="cookie-notice">We use cookies to give you the best experience on our pages, as you surely know by now.</div>'
    talk = '<div id="comments"><p>I read this three times and I still cannot see what the point of it was, sorry.</p>{}</div>'
    frames = {
        "wrapper with sidebar": '<div class="content-with-sidebar">{}</div>' + side,
        "no comments": '<div class="post-content no-comments">{}</div>',
        "has sidebar": '<div class="page has-sidebar"><article>{}</article>' + side + "</div>",
        "social id": '<div id="social-media-article"><article>{}</article></div>',
        "all in a notice": '<article><section class="notice">{}</section></article>',
        "plain": "<div>{}</div>",
        "plain in plain": "<div><div>" + side + "<div>{}</div></div></div>",
        "German names": '<div class="inhalt"><div class="beitrag">{}</div></div>' + side,
        "body only": "{}",
        "table": f"<table><tr><td>{nav}</td><td>{{}}</td></tr></table>",
        "long comments": "<article>{}</article>" + talk.format("<p>And here is what others think about it, at very great length indeed.</p>" * 12),
        "cookie notice": cookie + "<main>{}</main>" + side,
    }
    for shape, frame in frames.items():
        for n in (4, 8, 15, 30, 80):
            said = [f"{prose(1_000 + 31 * n + i, 14 + i % 9)}." for i in range(n)]
            body = "".join(f"<p>{t}</p>" for t in said)
            yield shape, f"<html><head><title>{said[0]}</title></head><body>{nav}{frame.format(body)}{foot}</body></html>", " ".join(said)


def test_articles_under_all_kinds_of_names(spark):
    """Sixty pages with known main text: token F1 of each at least 0.95."""
    shaped = list(shaped_pages())
    usual = [(f"<html><body><nav><a href='/'>Home</a></nav><article><h1>{prose(i, 4)}</h1>" + "".join(f"<p>{prose(50 * i + k, 20)}.</p>" for k in range(5)) + "</article><footer>x y z</footer></body></html>") for i in range(80)]
    rows = [(i, "u", page, 1, "x") for i, page in enumerate([*(h for _, h, _ in shaped), *usual])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int, n_chars string")
    got = {r.page_id: r.text for r in html_extraction.main_texts(df).collect()}
    assert len(shaped) == 60
    for i, (shape, _, want) in enumerate(shaped):
        have, expected = Counter(got[i].split()), Counter(want.split())
        common = sum((have & expected).values())
        assert 2 * common >= 0.95 * (have.total() + expected.total()), (shape, common, have.total(), expected.total())


def test_very_long_pages(spark):
    body = "".join(f"<p>{prose(i, 30)}</p>" for i in range(4_000))
    deep = "<div>" * 3_000 + f"<p>{prose(1, 40)}</p>" * 3 + "</div>" * 3_000
    rows = [(1, "u", f"<body><nav>menu</nav><article>{body}</article></body>"), (2, "u", f"<body>{deep}</body>"), (3, None, "<" * 100_000)]
    got = {r.page_id: r for r in html_extraction.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == " ".join(prose(i, 30) for i in range(4_000)) and got[1].n_chars == len(got[1].text)
    assert got[2].text == " ".join([prose(1, 40)] * 3)


# 3: decontamination


def test_contaminated(documents, spark):
    items = [(i, prose(200 + i, 12 + i % 30, 40).replace(" ", ". ", 1)) for i in range(60)]
    items += [(100, prose(300, 20, 40) + "\nanswer " + prose(301, 4)), (101, "two words"), (102, None), (103, ""), (None, prose(310, 15, 40)), (5, items[5][1])]
    leak = lambda i: items[i][1]
    rows = [(1, prose(1, 300, 40)), (2, f"{prose(2, 90, 40)} {leak(7).upper()} {prose(3, 50, 40)}"), (3, leak(9)), (3, leak(9)), (4, None), (5, "")]
    rows += [(6, " ".join(leak(11).split()[: len(leak(11).split()) // 2])), (7, leak(60)), (8, leak(60).split("\n")[0]), (9, f"a {leak(61)} b {leak(5)}"), (None, leak(12))]
    rows += [(10, f"{prose(9, 20_000, 40)} {leak(64)} {prose(8, 20_000, 40)}")]
    rows += [(20 + i, f"{prose(400 + i, 40 + i, 40)} {leak(20 + i)} {prose(500 + i, 70, 40)}") for i in range(30)]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for item, text in items:
        words = decontaminate.words_of((text or "").encode())
        if not words:
            continue
        size = min(5, len(words))
        own = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
        for d, x in rows:
            held = decontaminate.words_of((x or "").encode())
            if len(own & {tuple(held[k : k + size]) for k in range(len(held) - size + 1)}) >= 0.8 * len(own):
                want.add((d, item))
    for shard_bytes in (10**6, 2_000):
        got = decontaminate.contaminated(documents(rows), table, shard_bytes=shard_bytes)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want
        assert got.count() == len(want)
    left = decontaminate.drop_contaminated(documents(rows), table)
    assert (10, None) in want
    assert sorted(r.doc_id for r in left.collect()) == [1, 4, 5, 6, 8]
    assert decontaminate.contaminated(documents([]), table).count() == 0
    assert decontaminate.contaminated(documents(rows), table.limit(0)).count() == 0


def test_wand_finds_all_above_the_threshold():
    items = [(i, prose(700 + i, 8 + i % 9, 3).encode()) for i in range(150)]
    held = [set(decontaminate.words_of(t)) for _, t in items]
    frequency = Counter(w for s in held for w in s)
    for threshold in (0.2, 0.5, 0.8):
        index = decontaminate.Index([(i, t, threshold) for i, t in items], frequency, len(items), 12)
        for seed in range(30):
            terms = sorted({index.numbers[w] for w in decontaminate.words_of(prose(900 + seed, 60, 3).encode()) if w in index.numbers})
            scores = Counter()
            for t in terms:
                for i, w in zip(index.items[t], index.weights[t], strict=True):
                    scores[i] += w * threshold
            got = dict(index.search(terms))
            assert got.keys() == {i for i, s in scores.items() if s >= threshold - 1e-9}
            assert all(abs(got[i] - scores[i]) < 1e-9 for i in got)


def index_of(items):
    words = [decontaminate.words_of(t) for _, t in items]
    frequency = Counter(w for ws in words for w in set(ws))
    mean = sum(map(len, words)) / len(words)
    weights = [decontaminate.word_weights(w, frequency, len(items), mean) for w in words]
    least = [decontaminate.least_score(w, v, 0.8) for w, v in zip(words, weights, strict=True)]
    index = decontaminate.Index([(i, t, s) for (i, t), s in zip(items, least, strict=True)], frequency, len(items), mean)
    index.numbers = decontaminate._Numbers(index.numbers)
    return index


def test_items_whose_weight_lies_in_a_few_words():
    """47 words that all items share, three rare ones at the end: a copy without these is found, too."""
    common = prose(77, 47, 40)
    items = [(i, f"{common} {prose(5_000 + i, 3, 10**6)}".encode()) for i in range(200)]
    index = index_of(items)
    for i, text in items:
        copy = b" ".join(text.split()[:47] + [b"other", b"words", b"here"])
        assert i in decontaminate._hits(index, b"some text before " + copy + b" and after", 0.8)


def test_no_copy_that_passes_verification_is_lost():
    draw = np.random.default_rng(12)
    items = [(i, " ".join([prose(i, 6 + i % 50, 4), prose(3_000 + i, i % 5, 10**6), prose(i % 7, 9, 4)]).encode()) for i in range(120)]
    index, seen = index_of(items), 0
    for i, text in items:
        for _ in range(8):
            words = text.split()
            for at in draw.choice(len(words), draw.integers(0, 1 + len(words) // 6), replace=False):
                words[at] = b"changed%d" % at
            passage = b" ".join(words)
            held = decontaminate.words_of(passage)
            number = index.ids.index(i)
            shares = index.verify(number, held)
            if shares[0] >= 0.8 and min(shares[1:]) >= 0.5:
                seen += 1
                assert number in decontaminate._hits(index, passage, 0.8)
    assert seen > 200


def test_least_score_by_all_choices():
    from itertools import combinations

    for seed in range(25):
        words = [w.encode() for w in prose(seed, 9 + seed % 4, 2).split()]
        weights = {w: 1.0 + (seed * 7 + i * i) % 5 for i, w in enumerate(sorted(set(words)))}
        shingles = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        for overlap in (0.5, 0.8, 1.0):
            lost = 0.0
            for n in range(len(weights)):
                for gone in combinations(weights, n):
                    kept = {s for s in shingles if not set(s) & set(gone)}
                    if len(kept) >= overlap * len(set(shingles)):
                        lost = max(lost, sum(weights[w] for w in gone))
            assert decontaminate.least_score(words, weights, overlap) <= 1 - lost / sum(weights.values()) + 1e-9


# 4: toxicity


def test_toxicity(documents, spark):
    bad = ["idiot", "moron", "stupid"]
    rows = [(i, f"{prose(i, 30, 8)} {bad[i % 3] if i % 5 == 0 else 'fine'} {prose(900 + i, 10, 8)}") for i in range(600)]
    odd = [(-1, None), (-2, ""), (-3, prose(3, 30, 8)), (-4, "you 1d10t there"), (-5, "you i d i o t there"), (-6, "so stuuuupid!!! *** 12"), (None, "x")]
    labels = [(i, int(i % 5 == 0)) for i, _ in rows if i % 7] + [(None, 1), (3, None), (10**6, 1), (5, 0)]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(documents(rows + odd), table).collect()}
    assert len(got) == len(rows) + len(odd)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (fold(d, 4) == 2) for d, r in got.items())
    wrong = [i for i, _ in rows if got[i].held_out and got[i].predicted != int(i % 5 == 0)]
    assert not wrong
    assert [got[d].predicted for d in (-1, -2, -3, -4, -5, -6, None)] == [0, 0, 0, 1, 1, 1, 0]
    alone = toxicity.toxicity(documents(rows[:3]), table.limit(0)).collect()
    assert [r.score for r in alone] == [0.0] * 3
    assert toxicity.toxicity(documents([]), table).count() == 0


def decoder():
    counts = np.zeros(toxicity.CLASSES**3)
    text = ("you are an idiot and a fool with no manners, said the man to his stupid friend in the hot summer sun. " * 50).encode()
    codes = np.r_[0, 0, toxicity._CLASS_OF_BYTE[np.frombuffer(text, np.uint8)], 0]
    grams = codes[:-2] * toxicity.CLASSES**2 + codes[1:-1] * toxicity.CLASSES + codes[2:]
    return toxicity.Decoder(counts + np.bincount(grams, minlength=toxicity.CLASSES**3))


def test_words_are_decoded_whole_at_any_length():
    found = decoder()
    assert found.restore("i" * 70 + "diot") == "idiot"
    assert found.restore("1" * 70 + "di0t") == "idiot"
    assert found.restore("-" * 300 + "s-t-u-p-1-d") == "stupid"
    assert found.restore("m@nners" * 30) == "manners" * 30
    assert ["idiot"] in found.pieces("i" * 40 + "d" * 30 + "iot")
    assert any(p[-1].startswith("idiot") for p in found.pieces("idiot" + "x" * 30 + "y"))
    assert len(found.restore("a1" * 100_000)) >= 100_000


@pytest.mark.parametrize(
    "text",
    [
        "i d ! o t", "1 d i 0 t", "you i  d  i  o  t there", "i\td\ti\to\tt", "i\nd\ni\no\nt", "i d\u00a0i o t.", "ii d 1 oo t",
        "i d !0 t", "iidiot", "idiiot", "idioot!", "i - d - i - o - t", "a i d ! o t a", "\"i d i o t\", they",
    ],
)
def test_spacing_symbols_and_doubling_together(text):
    words = toxicity._Words(decoder(), lambda readings: any("idiot" in toxicity.features(w) for w in readings))
    assert any(words.of(text.encode()))


def test_words_with_doubled_letters_keep_their_own_reading():
    assert decoder().readings("summer")[0] == "summer"
    assert decoder().readings("iidiot") == ["iidiot", "idiot"]
    assert "stupid" in decoder().spaced(list("$tup1d"))[0]
    tokens = "if it is to be of use , so i  d ! o t".split()
    assert toxicity.spaced_runs(tokens, {t: p for t in tokens if (p := toxicity.as_short(t))}) == [list("id!ot")]


def test_doubled_letters_as_the_lattice_decides():
    found, draw = decoder(), np.random.default_rng(8)
    words = ["".join(draw.choice(list("idotmnse"), n)) for n in draw.integers(1, 12, 3000)] + ["iiddiioott", "summer", "éé", "ooé"]
    words = [w for w in words if toxicity._DOUBLED.search(w) and not any(d[2] for d in toxicity._DOUBLED.finditer(w))]
    assert len(words) > 500
    for word in words:
        meant = found.decode(word)
        assert found.readings(word) == ([word] if meant == word else [word, meant])


def test_viterbi_finds_the_best_of_all_paths():
    found = decoder()

    def best(word):
        paths = [("", 0.0)]
        for run in toxicity._RUN.finditer(word):
            paths = [(said + letters, cost + c) for said, cost in paths for letters, c in found.arcs(run[1], run.end() - run.start())]

        def value(path):
            p, q, score = toxicity.BLANK, toxicity.BLANK, -path[1]
            for r in [toxicity.class_of(c) for c in path[0]] + [toxicity.BLANK]:
                score += found.log[p][q][r]
                p, q = q, r
            return score

        return max(map(value, paths)), {said for said, _ in paths if value((said, min(c for s, c in paths if s == said))) >= max(map(value, paths)) - 1e-9}

    for word in ("1d!0t", "iid-iott", "s+up|d", "m@@n n3r", "$$$t", "a--b**c", "fr1€nd", "((o0l", "i d ! o t"):
        assert found.decode(word) in best(word)[1]


@pytest.mark.parametrize("text", ["a b " + "- . " * 100_000, "a b " + "- " * 50 * 4_000])
def test_runs_of_signs_take_linear_time(text):
    words = toxicity._Words(decoder(), lambda readings: 0.0)
    start = time.process_time()
    words.of(text.encode())
    assert time.process_time() - start < 1


def test_long_texts_of_short_tokens_and_repeated_rows(documents, spark):
    rows = [(i, f"{prose(i, 30, 8)} {'idiot' if i % 5 == 0 else 'fine'}") for i in range(300)]
    odd = [(-1, "( < " * 5_000 + "i d ! o t"), (-2, "- . " * 20_000), (-3, "x" * 300_000), (-4, "i d i o t"), (-4, "i d i o t"), (-4, "fine")]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity.toxicity(documents(rows + odd), labels).collect()
    assert sorted((r.doc_id, r.predicted) for r in got if r.doc_id < 0) == [(-4, 0), (-4, 1), (-4, 1), (-3, 0), (-2, 0), (-1, 1)]


def test_long_words_are_features_by_a_hash():
    word = "idiot" * 100
    assert len(toxicity.whole(word)) < 64 and toxicity.whole(word) != toxicity.whole(word + "s")
    weights = toxicity.Weights({toxicity.whole(word): 3.0, "mor": 2.0, "=ok": 1.0})
    assert [weights.of([w]) for w in (word, "moron", "ok", "okay")] == [3.0, 2.0, 1.0, 0.0]


# 5: token counts


def test_token_counts(documents, odd_rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    odd = ["a\x1cb \x85 c　d  \n e's É1٢½", " <|endoftext|> x<|endoftext|><|endoftext|>", "   lead", "trail   ", "a\t\n\n b", "don't DON'T", "😀 ok 12345", "x" * 5000]
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(odd)]

    def want(d, t):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        return d, len((t or "").encode()), n, n > 512

    for frequent in (10, 100_000):
        got = token_counts.token_counts(documents(rows), path, frequent=frequent).collect()
        assert sorted(map(tuple, got), key=str) == sorted((want(*r) for r in rows), key=str)
    assert token_counts.token_counts(documents([]), path).count() == 0


# 7: quality


def test_quality(documents, spark, odd_rows):
    good = [(i, ". ".join(prose(i, 40).capitalize().split(" epsilon"))) for i in range(400)]
    junk = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(i, 40).split())) for i in range(100)]
    labels = [(i, int(i < 1000)) for i, _ in good + junk if i % 3] + [(None, 1), (5, None), (10**7, 0), (7, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = documents(good + junk + [(-1 - k, t) for k, (_, t) in enumerate(odd_rows)])
    model = quality.train(docs, table)
    assert sum(model.n_given) > 0
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert len(got) == docs.count()
    assert all(got[i].kept for i, _ in good) and not any(got[i].kept for i, _ in junk)
    left = quality.drop_low_quality(docs, table)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {d for d, r in got.items() if r.kept}
    assert quality.train(docs, table.limit(0)) is None
    assert [r.score for r in quality.score(documents(odd_rows), None).collect()] == [0.5] * len(odd_rows)
    assert quality.score(documents([]), model).count() == 0


# The whole


def test_sums_of_many_tasks_are_added_in_steps(spark):
    rows = [(np.array([i, 1.0, 0.5 * i]).tobytes(),) for i in range(300)]
    parts = spark.createDataFrame(rows, "sums binary").repartition(30)
    for n in (300, 5_000):
        assert quality._added_up(parts, n).tolist() == [44850.0, 300.0, 22425.0]


def test_values_that_no_labelled_row_has_share_a_bin():
    x = np.array([quality.metadata_figures(*v) for v in [("en", "a", 5), ("en", "b", 50), ("fr", None, None)] * 5])
    view = quality.View(nominal=(0, 1)).bins(x)
    other = np.array([quality.metadata_figures("xx", "new", 7), quality.metadata_figures("yy", "newer", 7)])
    assert (view._hot(other)[0] == view._hot(other)[1]).all()
    assert len({tuple(h[:2]) for h in view._hot(x).tolist()}) == 3


def test_stages_decide_by_row(documents, spark):
    """Rows without an id, and rows that share one, are kept or dropped each for itself."""
    item, clean = prose(800, 30, 40), [prose(810 + i, 60, 200) for i in range(4)]
    bad = f"{clean[0]} {item} {clean[1]}"
    rows = [(None, bad), (None, clean[2]), (3, bad), (3, clean[3]), (3, clean[3]), (None, clean[2]), (4, f"{clean[3]} more")]
    left = decontaminate.drop_contaminated(documents(rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(r for r in rows if r[1] != bad)
    assert left.columns == documents(rows).columns
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    many = [(i, prose(i, 80, 300) if i % 2 else "!!! $$$ 123 " * 20) for i in range(400)]
    shared_ids = many + [(None, prose(9_000, 80, 300)), (None, "!!! $$$ 123 " * 21), (401, prose(9_001, 80, 300)), (401, "!!! $$$ 123 " * 22)]
    kept = {(r.doc_id, r.text) for r in quality.drop_low_quality(documents(shared_ids), labels).collect()}
    assert {r for r in shared_ids if r[0] is None or r[0] == 401} & kept == {shared_ids[400], shared_ids[402]}


def test_pipeline_of_odd_rows(spark, documents, odd_rows, tmp_path):
    """The whole pipeline over null and repeated ids, and over no rows at all."""
    texts = [prose(700 + i, 80, 300) for i in range(60)]
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, prose(900, 80)), (None, prose(900, 80)), (100, texts[1]), (100, prose(901, 80))]
    labels = [(100 + i, 1) for i in range(60)] + [(1, 0), (2, 0), (3, 0)]
    for name, part in (("some", rows), ("none", [])):
        folder = str(tmp_path / name)
        documents(part).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, texts[5])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        left = corpus_pipeline.run(spark, folder).collect()
        if not part:
            assert left == []
            continue
        found = Counter(r.text for r in left)
        assert max(found.values()) == 1 and texts[5] not in found
        # Rows that share an id or lack one stay as far as they are neither copies nor rejected.
        kept = quality.drop_low_quality(documents(part), spark.createDataFrame(labels, "doc_id long, quality int"))
        wanted = {r.text for r in kept.collect() if r.text in (texts[0], prose(900, 80), prose(901, 80))}
        assert wanted <= set(found) and prose(901, 80) in found


def test_pipeline_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact dedup", "near dedup", "decontamination", "mixing"]
    assert [n.split("_")[0] for n in llm.QUERIES] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
