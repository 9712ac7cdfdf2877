"""Exact, near and substring duplicates, components and mixing, against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_prose import prose

from annolink.llm import exact_dedup, mixing, near_dedup, substring_dedup
from annolink.llm.common import window_hashes
from annolink.llm.components import components
from pyspark.sql import functions as F


def words_of(text):
    return [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", text or "") if w]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def near_reference(rows, size, percent):
    sets, parent, places, n = {}, {}, defaultdict(list), {}
    for number, (_, text) in enumerate(rows):
        w = words_of(lower(text))
        sets[number] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
        n[number] = len(sets[number])
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for number, (d, _) in enumerate(rows):
        if d is None:
            continue
        common = Counter(e for s in sets[number] for e in places[s])
        for e, k in common.items():
            if 100 * k >= percent * (n[number] + n[e] - k):
                a, b = root(d), root(rows[e][0])
                parent[max(a, b)] = min(a, b)
        for s in sets[number]:
            places[s].append(number)
    return sorted(((d, n[i], None if d is None else root(d)) for i, (d, _) in enumerate(rows)), key=str)


def edited(text, seed, share):
    draw = np.random.default_rng(seed)
    return " ".join(f"new{seed}x{i}" if draw.random() < share else w for i, w in enumerate(text.split()))


@pytest.fixture(scope="module")
def copies():
    base = [prose(s, 60 + 20 * (s % 5)) for s in range(8)]
    rows = [(1000 - i, edited(base[i % 8], i, (i % 7) * 0.012)) for i in range(160)]
    return rows + [(2000 + i, prose(100 + i, 30)) for i in range(40)]


def test_window_hashes_tell_windows_apart():
    words = np.random.default_rng(1).integers(0, 50, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for length in (1, 2, 3, 12, 25, 50):
        hashes = window_hashes(words, length)
        want = [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]
        assert len(hashes) == len(want)
        assert len(set(hashes.tolist())) == len(set(want)) == len(set(zip(hashes.tolist(), want, strict=True)))
    assert not len(window_hashes(words[:3], 4))


def test_components(spark):
    draw = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 120, (90, 2))] + [(i, i + 1) for i in range(500, 560)]
    parent = {v: v for e in edges for v in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: root(v) for a, b in edges if a != b for v in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("keep,best", [("max", max), ("min", min)])
def test_exact_groups(documents, odd_rows, keep, best):
    groups = defaultdict(list)
    for d, t in odd_rows:
        groups[t or ""].append(d)
    want = []
    for d, t in odd_rows:
        ids = [x for x in groups[t or ""] if x is not None]
        stays = best(ids) if ids else None
        sha = hashlib.sha256((t or "").encode()).hexdigest()
        want.append((d, stays, len(groups[t or ""]), d == stays, sha))
    got = [tuple(r) for r in exact_dedup.exact_groups(documents(odd_rows), keep=keep).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    left = exact_dedup.drop_exact_copies(documents(odd_rows), keep=keep)
    assert left.columns == documents(odd_rows).columns
    # One row of each group, repeated rows too.
    assert Counter((r.doc_id, r.text or "") for r in left.collect()) == Counter({(d, t or "") for (d, t), w in zip(odd_rows, want, strict=True) if w[3]})


def test_exact_copies_without_an_id_go_but_for_one(documents):
    rows = [(None, "a"), (None, "a"), (None, "b"), (7, "c"), (7, "c"), (7, "d"), (2, "d"), (None, "d")]
    left = exact_dedup.drop_exact_copies(documents(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == [(7, "c"), (7, "d"), (None, "a"), (None, "b")]


def test_exact_groups_compare_bytes(documents):
    """A digest under which all texts collide gives the same groups."""
    rows = [(i, t) for i, t in enumerate(["a", "b", "a", "c", "b", "a"])]

    def weak(text):
        return F.unhex(F.lit("00"))

    plain, collided = (sorted(map(tuple, exact_dedup.exact_groups(documents(rows), digest=d).collect())) for d in (exact_dedup.content_hash, weak))
    assert plain == collided
    assert exact_dedup.exact_groups(documents([])).count() == 0


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80), (1, 50)])
@pytest.mark.parametrize("options", [{}, {"node_rows": 3, "block_rows": 4}])
def test_near_duplicates(documents, copies, size, percent, options):
    if size == 1 and options:
        pytest.skip("one word shingles are tried once")
    got = near_dedup.near_duplicates(documents(copies), size, percent, **options)
    want = near_reference(copies, size, percent)
    assert sorted([tuple(r)[:3] for r in got.collect()], key=str) == want


def test_near_duplicates_odd_rows(documents, odd_rows):
    got = near_dedup.near_duplicates(documents(odd_rows), 3, 85).collect()
    assert sorted([tuple(r)[:3] for r in got], key=str) == near_reference(odd_rows, 3, 85)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    left = near_dedup.drop_near_copies(documents(odd_rows), size=3, percent=85)
    assert left.columns == documents(odd_rows).columns
    assert Counter(r.doc_id for r in left.collect()) == Counter({1: 1, 2: 1, 3: 1, 4: 1, 6: 1, 8: 1, 9: 1, 11: 1})
    assert near_dedup.near_duplicates(documents([])).count() == 0


def test_rows_that_share_an_id_are_one_vertex(documents):
    a, b = prose(1, 50), prose(2, 50)
    rows = [(1, a), (5, a), (5, b), (7, b)]
    got = {(r[0], r[2]) for r in near_dedup.near_duplicates(documents(rows), 3, 85).collect()}
    assert got == {(1, 1), (5, 1), (7, 1)}


@pytest.mark.parametrize("levels,more", [(2, 0), (4, near_dedup.MORE_TREES), (8, near_dedup.MORE_TREES)])
@pytest.mark.parametrize("share", [0.85, 0.8])
def test_isolated_pairs_at_the_threshold_meet(levels, more, share):
    """Of 5,000 pairs at exactly the threshold, none is lost by all trees, at any depth."""
    n, draw = 5_000, np.random.default_rng(levels)
    a = draw.integers(0, 2**16, (n, near_dedup.COORDINATES)).astype(np.uint16)
    b = np.where(draw.random(a.shape) < share, a, draw.integers(0, 2**16, a.shape).astype(np.uint16))
    values, met = np.concatenate([a, b]), np.zeros(n, bool)
    for tree in range(near_dedup.TREES + more):
        own = values[:, near_dedup.own_coordinates(tree)]
        roots = near_dedup.mix64(np.full(2 * n, tree + 1, np.uint64))
        rows, nodes = near_dedup._descend(roots, own, share, 2)
        at, below = near_dedup._descend(nodes, (own & 0xFF)[rows], share, levels - 2, 2)
        rows, nodes = rows[at], below
        pairs, both = rows % n, rows < n
        left = set(zip(pairs[both].tolist(), nodes[both].tolist(), strict=True))
        right = set(zip(pairs[~both].tolist(), nodes[~both].tolist(), strict=True))
        met[[pair for pair, _ in left & right]] = True
    assert (~met).sum() <= 1


def test_no_pairs_of_a_group(documents):
    """A group of copies with small differences gives a forest, not pairs."""
    base = prose(3, 100)
    rows = [(i, edited(base, i, 0.01)) for i in range(120)]
    reps = near_dedup.stage(near_dedup._signatures(documents(rows), 3).select("doc_id", "signature"))
    edges = near_dedup._candidate_edges(reps, 0.85, 1, 1000)
    assert edges.count() < 2 * len(rows)


def substring_reference(rows, window):
    first = {}
    for d, t in rows:
        w = words_of(t)
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = words_of(t)
        removed = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                removed[i : i + window] = [True] * window
        out.append((d, " ".join(x for x, r in zip(w, removed, strict=True) if not r), len(w), sum(removed)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [50, 7, 1])
def test_remove_repeats(documents, odd_rows, window):
    passage, line = prose(40, 55), prose(41, 9)
    rows = odd_rows + [(20 + i, f"{prose(50 + i, 20)} {passage} {prose(60 + i, 15 * (i % 3))} {line} {line}") for i in range(12)]
    rows.append((3, f"{passage} {passage}"))
    got = substring_dedup.remove_repeats(documents(rows), window)
    assert sorted(map(tuple, got.collect()), key=str) == substring_reference(rows, window)
    assert substring_dedup.remove_repeats(documents([]), window).count() == 0


def targets_reference(sizes, weights, limit):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            break
        level = (total - sum(limit * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > limit * sizes[s]}
        if not above:
            break
        capped |= above
    return {s: limit * sizes[s] if s in capped else level * weight[s] for s in names}


def test_mixing(documents, odd_rows):
    rows = [(i, prose(i, 5 + i % 40), "abcdefg"[min(i % 11, 6)]) for i in range(400)]
    rows += [(1000 + i, t, None) for i, (_, t) in enumerate(odd_rows)] + [(None, "x y z", "h"), (None, "x y z", "h")]
    docs = documents(rows)
    got = mixing.mix(docs, range_rows=16).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words_of(t))
    want = targets_reference(sizes, (5, 2, 1), 3)
    source = {d: s for d, t, s in rows if d is not None}
    taken = Counter()
    for r in got:
        s = source.get(r.doc_id, "h")
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix(docs.repartition(7), range_rows=16).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    coarse = mixing.mix(docs, range_rows=10**6).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, coarse), key=str)


def test_mixing_without_words(documents):
    assert mixing.mix(documents([])).count() == 0
    assert [tuple(r) for r in mixing.mix(documents([(1, None), (2, "")])).select("size", "target", "taken").collect()] == [(0, 0.0, 0)] * 2
    kept = mixing.mixed_documents(documents([(1, "a b"), (2, "")]))
    assert [(r.doc_id, r.taken) for r in kept.collect()] == [(1, 2)]
