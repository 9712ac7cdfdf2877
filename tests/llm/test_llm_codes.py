"""Vector codes, Merkle manifests and BPE, against plain Python and the tokenizer's own library."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from llm_prose import prose

from annolink.llm import bpe, merkle_manifest, vector_codes
from pyspark.sql import functions as F

# Vector codes


def codes_reference(rows, parts, entries, rounds, scale):
    kept = [(i, l, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, l, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), n) for n, e in enumerate(book))

    for r in range(rounds + 1):
        given = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
        if r == rounds:
            break
        for p in range(parts):
            members = defaultdict(list)
            for c, g in zip(cut, given, strict=True):
                members[g[p][1]].append(c[p])
            for n, m in members.items():
                books[p][n] = tuple(sum(x) // len(m) for x in zip(*m, strict=True))
    out = [(i, l, [n for _, n in g], sum(d for d, _ in g)) for (i, l, _), g in zip(kept, given, strict=True)]
    return sorted(out, key=str), books


SCHEMA = "vec_id long, embedding array<float>, label int, code string, id int, vector int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 1, 2) for i, l, v in rows], SCHEMA)


@pytest.mark.parametrize("entries,rounds,spread", [(8, 2, 1.0), (8, 4, 0.02), (64, 2, 1.0), (5, 0, 0.3), (3, 1, 40.0)])
def test_vector_codes(spark, entries, rounds, spread):
    draw = np.random.default_rng(entries + rounds)
    centres = draw.normal(size=(6, 8))
    rows = [(int(i), int(i) % 4, (spread * (centres[i % 6] + 0.3 * draw.normal(size=8))).tolist()) for i in draw.permutation(400)]
    rows += [(500 + i, None, rows[7][2]) for i in range(90)] + [(3, 1, rows[5][2]), (None, 2, rows[9][2])]
    rows += [(900, 1, None), (901, 1, [None, *rows[0][2][1:]]), (902, 1, [float("nan"), *rows[0][2][1:]]), (903, None, [float("-inf")] * 8)]
    coded, books = vector_codes.vector_codes(vectors(spark, rows).repartition(5), parts=4, entries=entries, rounds=rounds)
    want, want_books = codes_reference(rows, 4, entries, rounds, 256)
    got = coded.select("id", "label", "codes", "error").collect()
    assert sorted(((r.id, r.label, list(r.codes), r.error) for r in got), key=str) == want
    assert [[tuple(e) for e in b] for b in books.tolist()] == want_books
    sums = defaultdict(int)
    for _, label, _, error in want:
        sums[label] += error
    labelled = vector_codes.with_label_errors(coded).collect()
    assert all(r.label_error == sums[r.label] for r in labelled) and len(labelled) == len(want)


def test_stable_cores_are_skipped_and_rings_are_exact():
    draw = np.random.default_rng(4)
    books = draw.integers(-100, 100, (1, 20, 3))
    values = np.concatenate([books[0, draw.integers(0, 20, 500)] + draw.integers(-9, 10, (500, 3)), draw.integers(-150, 150, (200, 3))])
    plain = vector_codes.Balls(books)
    codes, squares = plain.first(0, values)
    moved = books + draw.integers(-15, 16, books.shape)
    apart = ((values - moved[0][codes]) ** 2).sum(1)
    radii = np.zeros((1, 20), np.int64)
    np.maximum.at(radii[0], codes, apart)
    balls = vector_codes.Balls(moved, radii)
    assert sum(len(b) for b in balls.order) < 20 * 19
    again, least = balls.again(0, values, codes)
    want, want_least = vector_codes.Balls(moved).first(0, values)
    assert (again == want).all() and (least == want_least).all() and (again != codes).any()


def test_odd_vectors(spark):
    none, books = vector_codes.vector_codes(vectors(spark, [(1, 1, None)]))
    assert none.count() == 0 and books.size == 0
    assert vector_codes.vector_codes(vectors(spark, []))[0].count() == 0
    rows = [(1, 1, [0.5, -0.25]), (2, 1, [0.5]), (3, None, []), (4, 2, [float(np.float32(1 / 3)), 2.0])]
    got = {r.id: (r.codes, r.error) for r in vector_codes.vector_codes(vectors(spark, rows), parts=2)[0].collect()}
    assert got == {1: ([0, 0], 0), 2: (None, None), 3: (None, None), 4: ([1, 1], 0)}
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.vector_codes(vectors(spark, rows), parts=3)
    with pytest.raises(ValueError, match="too large"):
        vector_codes.vector_codes(vectors(spark, [(1, 1, [1e30, 0.0])]), parts=2)


# Merkle manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def fold_reference(leaves, fan):
    """Root and, for each leaf, the digests left and right of it on each level."""
    paths, places, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for n, k in enumerate(places):
            run = level[k // fan * fan : k // fan * fan + fan]
            paths[n].append(("".join(run[: k % fan]), "".join(run[k % fan + 1 :])))
        level = [h("".join(level[i : i + fan])) for i in range(0, len(level), fan)]
        places = [k // fan for k in places]
    return level[0], paths


def manifest_reference(rows, fan):
    trees = defaultdict(list)
    for d, t, *s in rows:
        source = s[0] if s else "a"
        trees[source].append((d is not None, d or 0, h("".join(map(field, (d, source, "en", len(t or ""), t)))), d))
    low = {}
    for s, leaves in trees.items():
        leaves.sort(key=lambda r: r[:3])
        low[s] = fold_reference([r[2] for r in leaves], fan)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    root, above = fold_reference([low[s][0] for s in names], fan)
    out = []
    for n, s in enumerate(names):
        for (_, _, leaf, d), path in zip(trees[s], low[s][1], strict=True):
            out.append((d, leaf, low[s][0], root, path + above[n]))
    return sorted(out, key=str)


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_manifest(documents, odd_rows, fan):
    rows = [(i, f"text {i % 7}", "b") for i in range(37)] + [(i, "é", None) for i in range(17)]
    rows += [(1, "one leaf", "c"), (9, "Z", "ab"), (9, "Z", "ab"), (9, "Y", "ab")]
    rows += [(i, t, "") for i, t in odd_rows] + [(i, "x", f"s{i:02}") for i in range(20)]
    got = merkle_manifest.manifest(documents(rows).repartition(6), carry={"n": F.length("text")}, fan=fan)
    held = [(r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in got.collect()]
    assert sorted(held, key=str) == manifest_reference(rows, fan)
    bent = F.when(F.col("n") == 1, F.sha2(F.lit("other").cast("binary"), 256)).otherwise(F.col("leaf"))
    checked = got.select("n", (merkle_manifest.folded(bent, F.col("path")) == F.col("root")).alias("same")).collect()
    assert {(r.n == 1, r.same) for r in checked} == {(True, False), (False, True)}
    lists = got.select("path", merkle_manifest.siblings(F.col("path")).alias("text")).collect()
    assert all(r.text == "".join(s.left + s.right for s in r.path) for r in lists)


def test_manifest_of_few_rows(documents):
    assert merkle_manifest.manifest(documents([])).count() == 0
    one = merkle_manifest.manifest(documents([(None, None, None)])).collect()
    leaf = h("".join(map(field, (None, None, "en", 0, None))))
    assert [tuple(r) for r in one] == [(None, leaf, leaf, leaf, [])]


# BPE


@pytest.fixture(scope="module")
def word_bpe():
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(path)
    return path, library


def test_encode_and_decode(documents, odd_rows, word_bpe):
    path, library = word_bpe
    rows = odd_rows + [
        (20, "<|endoftext|>a<|startoftext|><|endoftext|> <|ENDOFTEXT|>"), (21, "ΑΣ Σ ΟΔΟΣ İstanbul ﬁ Å 한국어 日本語"), (22, "I'LL we've 12345 don't!!?..."),
        (23, "՘ꟋᲉ\U00016ea0 Á \x1c\x85 "), (24, "a" * 50_000), (25, "🇩🇪👩‍👩‍👧" * 300), (26, "</w> in</w>"),
    ]
    got = bpe.decode(bpe.encode(documents(rows), path), path).collect()
    want = {t or "": library.encode(t or "", add_special_tokens=False).ids for _, t in rows}
    texts = {i: sorted(want[t or ""] for d, t in rows if d == i) for i, _ in rows}
    found = defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        found[r.doc_id].append(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert {i: sorted(x) for i, x in found.items()} == texts
    assert bpe.encode(documents([]), path).count() == 0


def test_tokens_are_what_the_merges_give(word_bpe):
    path, library = word_bpe
    vocabulary = bpe.read_vocabulary(path)
    encoder = bpe.Encoder(vocabulary)
    split, draw = encoder.splitter(), random.Random(5)
    for alphabet in ("ab", "aeinrst", "etaoinshrdlu'", "aé́ΣσςÅ", "x1 .,!?-"):
        for _ in range(400):
            text = "".join(draw.choice(alphabet) for _ in range(draw.randint(1, 40)))
            ids = np.frombuffer(b"".join(map(encoder.word, split(text))), "<u4").tolist()
            assert ids == library.encode(text, add_special_tokens=False).ids


def test_decoding_needs_no_order(spark, word_bpe):
    path, library = word_bpe
    draw = np.random.default_rng(3)
    lists = [draw.integers(0, 49_408, n).astype("<u4") for n in (0, 1, 5, 400, 0, 70_000)]
    rows = [(i, x.tobytes()) for i, x in enumerate(lists)] + [(9, None)]
    got = {r.n: r.decoded for r in bpe.decode(spark.createDataFrame(rows, "n long, ids binary"), path).collect()}
    assert got == {i: library.decode(x.tolist(), skip_special_tokens=False) for i, x in enumerate(lists)} | {9: ""}
