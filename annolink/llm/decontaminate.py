"""Benchmark decontamination: BM25 with block-max WAND, then overlap of question and answer.

The test items are the indexed collection, the passages of the training documents are the
queries. Weights are divided by the weight of the whole item, so a passage that holds all
words of an item scores 1. The threshold of an item is the least score that a passage can have
which passes the verification below: the item's words less the greatest weight that can be missing
where no more than the allowed share of its shingles is. So the search loses no hit; weights are
divided by the threshold, and one bound serves all items. Every document is cut into
passages of twice the longest item, half overlapping, so every copy of an item lies whole in
some passage. Items are numbered by length, so that neighbours have weights of one size. The
greatest weights of the passage's words in a block of items, summed up, bound the scores of
these items; blocks below the threshold are skipped. In the others block-max WAND returns
every item at or above the threshold. A hit counts when at least ``overlap`` of the item's five-word
shingles stand in the passage, and at least half of the words of its question and of its answer.

The index is broadcast in shards of at most ``SHARD_BYTES`` of item text (one for any usual
benchmark), one pass over the documents each; word statistics are those of all items.

Cases: words are lower-case, split at blanks and ASCII punctuation. The answer is what
follows the last line break of an item; an item of one line is a question only. An item of
fewer than five words is one shingle; an item without words is skipped. A null or empty text
has no passages; a very long one is cut into passages whole. Repeated items and documents give one
hit per document id and item id. Rows without an id are compared, documents and items, and their hits
have a null id. Further columns do not matter. Empty tables give an empty result.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.llm.common import shared, texts, without
from annolink.staging import stage

SHARD_BYTES = 4 * 1024 * 1024
K1, B = 1.2, 0.75
# Postings of a block, and blocks of items of a shard for the bounds of passages.
BLOCK, ITEM_BLOCKS = 32, 32
# Where a caller asks for no overlap, an item is found by any share of its weight above this one.
LEAST = 1e-3
OVERLAP, SHINGLE = 0.8, 5

_CUT = bytes(
    32 if 33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126 else c + 32 if 65 <= c <= 90 else c
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_CUT).split()


def word_weights(words: list[bytes], frequency: dict[bytes, int], n_items: int, mean_length: float) -> dict[bytes, float]:
    """BM25 weights of an item's words."""
    weights = {}
    for word, count in Counter(words).items():
        rarity = math.log(1 + (n_items - frequency[word] + 0.5) / (frequency[word] + 0.5))
        weights[word] = rarity * count * (K1 + 1) / (count + K1 * (1 - B + B * len(words) / mean_length))
    return weights


def least_score(words: list[bytes], weights: dict[bytes, float], overlap: float) -> float:
    """The least share of the weights that a passage with ``overlap`` of the item's shingles holds.

    The greatest weight of missing words, over all choices of missing places that spoil no more
    shingles than may be missing. The choices are searched by place, number of spoilt shingles, and
    places since the last missing one. A word that occurs again counts in parts, a repeated
    shingle once: both can only make the result lower.
    """
    size = min(SHINGLE, len(words))
    shingles = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    n = len(set(shingles))
    spare = n - math.ceil(overlap * n - 1e-9)
    if spare <= 0:
        return 1.0
    if spare >= n:
        return 0.0
    count = Counter(words)
    met: set[tuple] = set()
    # best[k][j]: weight lost with j shingles spoilt, the last missing place k places back (size: farther).
    best = np.full((size + 1, spare + 1), -np.inf)
    best[size, 0] = 0.0
    for i, word in enumerate(words):
        following = np.full_like(best, -np.inf)
        following[1:size] = best[: size - 1]
        following[size] = np.maximum(best[size - 1], best[size])
        following[0] = best.max(axis=0) + weights[word] / count[word]
        if i >= size - 1 and (shingle := shingles[i - size + 1]) not in met:
            met.add(shingle)
            following[:size, 1:] = following[:size, :-1]
            following[:size, 0] = -np.inf
        best = following
    return max(0.0, 1 - float(best.max()) / sum(weights.values()))


class Index:
    """Postings with a greatest weight per word and per block of postings.

    ``items`` holds (id, text, least score); weights are divided by the whole item's and by the least score.
    """

    def __init__(self, items: list[tuple[int, bytes, float]], frequency: dict[bytes, int], n_items: int, mean_length: float):
        self.ids, self.words, self.numbers = [], [], {}
        self.cut, self.least = [], []
        postings: list[list[tuple[int, float]]] = []
        for item_id, text, least in sorted(items, key=lambda item: (len(words_of(item[1])), item[1], str(item[0]))):
            question, _, answer = text.rpartition(b"\n")
            head = words_of(question) if question.strip() else words_of(text)
            words = words_of(text)
            if not words:
                continue
            number = len(self.ids)
            self.ids.append(item_id)
            self.words.append(words)
            self.cut.append(len(head) if question.strip() else len(words))
            weights = word_weights(words, frequency, n_items, mean_length)
            self.least.append(max(least, LEAST))
            whole = sum(weights.values()) * self.least[-1]
            for word in sorted(weights):
                if word not in self.numbers:
                    self.numbers[word] = len(postings)
                    postings.append([])
                postings[self.numbers[word]].append((number, weights[word] / whole))
        self.items = [[i for i, _ in p] for p in postings]
        self.weights = [[w for _, w in p] for p in postings]
        self.ends = [p[BLOCK - 1 :: BLOCK] + p[-1:] * (len(p) % BLOCK > 0) for p in self.items]
        self.block_max = [[max(w[i : i + BLOCK]) for i in range(0, len(w), BLOCK)] for w in self.weights]
        self.most = np.array([max(w) for w in self.weights] or [0.0])
        self.step = max(1, -(-len(self.ids) // ITEM_BLOCKS))
        self.bounds = np.zeros((len(self.most), ITEM_BLOCKS), np.float32)
        for term, (held, weights) in enumerate(zip(self.items, self.weights, strict=True)):
            np.maximum.at(self.bounds[term], np.array(held) // self.step, np.array(weights, np.float32))
        self.longest = max(map(len, self.words), default=1)
        self.shingles = [self.shingles_of(w) for w in self.words]

    @staticmethod
    def shingles_of(words: list[bytes]) -> set[tuple]:
        size = min(SHINGLE, len(words))
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}

    def search(self, terms: list[int], first: int = 0, end: int | None = None) -> list[tuple[int, float]]:
        """All items from ``first`` to before ``end`` at or above their least score, by block-max WAND, with their score."""
        found = []
        # A cursor is [current item, term, place].
        end = len(self.ids) if end is None else end
        cursors = []
        for term in terms:
            place = bisect.bisect_left(self.items[term], first)
            if place < len(self.items[term]) and self.items[term][place] < end:
                cursors.append([self.items[term][place], term, place])
        slack = 1 - 1e-9
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, term, _) in enumerate(cursors):
                bound += self.most[term]
                if bound >= slack:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            reach, block_end = 0.0, math.inf
            for _, term, _ in cursors[: pivot + 1]:
                block = bisect.bisect_left(self.ends[term], item)
                if block < len(self.ends[term]):
                    reach += self.block_max[term][block]
                    block_end = min(block_end, self.ends[term][block])
            if reach >= slack:
                if cursors[0][0] == item:
                    score = sum(self.weights[t][p] for i, t, p in cursors[: pivot + 1] if i == item)
                    if score >= slack:
                        found.append((item, score * self.least[item]))
                    goal = item + 1
                else:
                    goal = item
            else:
                # No item up to the end of these blocks, nor before the next cursor, can reach it.
                goal = block_end + 1 if block_end < math.inf else item + 1
                if pivot + 1 < len(cursors):
                    goal = min(goal, cursors[pivot + 1][0])
                goal = max(goal, item + 1)
            moved = []
            for cursor in cursors[: pivot + 1]:
                if cursor[0] < goal:
                    held = self.items[cursor[1]]
                    cursor[2] = bisect.bisect_left(held, goal, cursor[2])
                    if cursor[2] == len(held) or held[cursor[2]] >= end:
                        continue
                    cursor[0] = held[cursor[2]]
                moved.append(cursor)
            cursors = moved + cursors[pivot + 1 :]
        return found

    def verify(self, item: int, passage: list[bytes]) -> tuple[float, float, float]:
        """Shares of the item's shingles, of its question's and of its answer's words in the passage."""
        own, words, cut = self.shingles[item], self.words[item], self.cut[item]
        size = min(SHINGLE, len(words))
        there = {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)}
        present = set(passage)

        def share(part):
            return sum(w in present for w in part) / len(part) if part else 1.0

        return len(own & there) / len(own), share(words[:cut]), share(words[cut:])


class _Numbers(dict):
    def __missing__(self, word):
        return -1


def _hits(index: Index, text: bytes, overlap: float, min_score: float = 0.0) -> dict[int, tuple[float, float, float, float]]:
    words = words_of(text)
    numbers = np.fromiter(map(index.numbers.__getitem__, words), np.int64, len(words))
    places = np.flatnonzero(numbers >= 0)
    if not len(places):
        return {}
    step, terms = index.longest, numbers[places]
    # A word stands in two passages: the one that begins at its step and the one before.
    width = len(index.most)
    passage = places // step
    keys = np.unique(np.concatenate([passage * width + terms, np.maximum(passage - 1, 0) * width + terms]))
    own, number = keys % width, keys // width
    starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    ends = np.r_[starts[1:], len(keys)]
    bounds = np.add.reduceat(index.bounds[own], starts, axis=0)
    best: dict[int, tuple] = {}
    for k, block in zip(*np.nonzero(bounds >= 1 - 1e-4), strict=True):
        at = int(number[starts[k]])
        part = words[at * step : (at + 2) * step]
        found = index.search(own[starts[k] : ends[k]].tolist(), int(block) * index.step, (int(block) + 1) * index.step)
        for item, score in found:
            if score < min_score:
                continue
            shares = index.verify(item, part)
            if shares[0] >= overlap and min(shares[1:]) >= 0.5:
                best[item] = max(best.get(item, (0.0,)), (score, *shares))
    return best


def _shards(items: DataFrame, shard_bytes: int, overlap: float) -> Iterator[Index]:
    """Indexes over disjoint parts of the items, each of bounded size, with common statistics."""
    rows = items.select(
        F.col("item_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    )

    def task(batches):
        for batch in batches:
            words = [words_of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(set(w)) for w in words], pa.list_(pa.binary())), pa.array(list(map(len, words)), pa.int64())],
                ["words", "length"],
            )

    tokens = rows.mapInArrow(task, "words array<binary>, length long").where("length > 0")
    n_items, mean_length = tokens.agg(F.count("*"), F.avg("length")).first()
    if not n_items:
        return
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    n_shards = math.ceil(total / shard_bytes)
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_shards))
    counts = stage(tokens.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")))
    for number in range(n_shards):
        part = rows.where(shard == number)
        own = part.mapInArrow(task, "words array<binary>, length long").select(F.explode("words").alias("word")).distinct()
        frequency = {bytes(w): n for w, n in counts.join(own, "word", "left_semi").collect()}
        held = shared(items.sparkSession, (frequency, n_items, mean_length))

        def least(batches, held=held):
            frequency, n_items, mean_length = held()
            for batch in batches:
                scores = []
                for text in batch.column(1):
                    words = words_of(text.as_py())
                    scores.append(least_score(words, word_weights(words, frequency, n_items, mean_length), overlap) if words else 1.0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], ["item_id", "text", "least"])

        with_least = part.mapInArrow(least, "item_id long, text binary, least double")
        yield Index([(i, bytes(t), s) for i, t, s in with_least.collect()], frequency, n_items, mean_length)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    min_score: float = 0.0,
    overlap: float = OVERLAP,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """doc_id, item_id, score, overlap, question_overlap, answer_overlap of every verified hit.

    A ``min_score`` above 0 leaves out hits that verification would accept.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"
    names = ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"]
    rows = texts(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    result = spark.createDataFrame([], schema)
    for index in _shards(items, shard_bytes, overlap):
        index.numbers = _Numbers(index.numbers)
        held = shared(spark, index)

        def task(batches, held=held):
            index = held()
            for batch in batches:
                found = [
                    (doc, index.ids[item], *values)
                    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                    for item, values in _hits(index, text.as_py(), overlap, min_score).items()
                ]
                columns = list(zip(*found, strict=True)) or [[] for _ in names]
                types = [pa.int64()] * 2 + [pa.float64()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        result = result.union(rows.mapInArrow(task, schema))
    best = F.max(F.struct(*names[2:])).alias("_best")
    return result.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", *[f"_best.{n}" for n in names[2:]])


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a verified hit, with all their columns."""
    return without(docs, lambda rows: contaminated(rows, items, **options).select("doc_id"))
