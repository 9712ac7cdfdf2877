"""Language-model scores from a log-frequency Bloom filter.

1. Counts of all words and word pairs of the training documents: combined inside each task,
   shuffled by filter segment (a hash of the pair, so no segment is hot), sorted by it and summed
   there, one segment after the other. The number of segments grows with the training texts, so
   that one task can hold any of them.
2. Each segment of the filter is built where its counts are. A pair with count c is stored
   under every level 1 .. 1 + log(c) / log(``BASE``); a probe asks for one level after the
   other until one is missing, and the last one found stands for the mean count of all that
   have this level. A segment is divided by further bits of the key until no part is more than
   half full, so the filter grows with what is counted and keeps every level of every key.
3. The model mixes two estimates, p = w * c(h, t) / c(h) + (1 - w) * p(t), where p(t) is the
   smoothed share of the word that the base score uses as well. As counts of pairs are means of
   their levels, the probabilities after a word sum to one but for some per cent. The weight w depends on the
   size of c(h). It is the best of a grid on all training documents (``fit_rows`` of them, if
   given), each scored by what the other documents have counted.
4. A filter of up to ``BROADCAST_PARTS`` parts (64 MB) is broadcast. A larger one stays where
   it is: documents are packed in chunks, the keys of a chunk travel to the shards of the
   filter (``SHARD_PARTS`` parts, 16 MB), and their levels travel back. Both ways give the same
   scores. The ``frequent`` commonest words are broadcast with their exact counts.
   The base score needs exact counts: those of all other words are joined by the word's
   64-bit hash.

Cases: very long texts are read whole, and further columns do not matter.
A null text is an empty one, with the end as its only token. Rows without an id hash
like an empty id. Rows are scored each. Without training documents every probability is that
of no counts. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.llm.common import mix64, remainder, shared, texts
from annolink.llm.hashing import WordHash
from annolink.staging import stage

# Segments at least; bytes of training text that one of them is counted for at most.
SEGMENTS, SEGMENT_TEXT = 1024, 8_000_000
SEGMENT_BITS, PROBES = 1 << 19, 3
BASE = math.sqrt(2)
LEVELS = 128
FREQUENT = 200_000
# Parts of SEGMENT_BITS that are broadcast at most, and that a task holds otherwise.
BROADCAST_PARTS, SHARD_PARTS = 1024, 256
# Tokens that are counted, scored and packed together: the more, the fewer distinct ones among them.
COUNTED, SCORED, CHUNK = 1_200_000, 600_000, 200_000
# Keys in a batch of counts; keys of a segment that are held before they are summed.
KEYS, HELD = 100_000, 400_000
# Bits of a word's hash by which its place among the commonest ones is found.
INDEX_BITS = 18
GRID = np.array([0, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95])
BUCKETS = 48
# Hashes of the end of a text and of its start, which is a context only.
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_PAIR, _STEP = np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)


def pair_keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix64(before * _PAIR + tokens)


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def n_segments(text_bytes: int) -> int:
    """A power of two: so many segments as the training texts need."""
    return max(SEGMENTS, 1 << math.ceil(math.log2(max(1, text_bytes / SEGMENT_TEXT))))


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """The first bits of a key."""
    return (keys >> np.uint64(65 - segments.bit_length())).astype(np.int64)


def places_of(keys: np.ndarray, level: np.ndarray | int) -> list[np.ndarray]:
    """The bits of keys at a level, inside their segment."""
    spread = mix64(keys + np.asarray(level).astype(np.uint64) * _STEP)
    return [((spread >> np.uint64(19 * j)) & np.uint64(SEGMENT_BITS - 1)).astype(np.int64) for j in range(PROBES)]


def segment_bits(keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A filled part: every key under every level up to its own."""
    bits = np.zeros(SEGMENT_BITS, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for places in places_of(keys[levels >= level], level):
            bits[places] = True
    return np.packbits(bits, bitorder="little")


def divided(keys: np.ndarray, levels: np.ndarray, segments: int) -> list[np.ndarray]:
    """Filled parts of one segment, as many (a power of two) as keep every level of every key."""
    most, depth = int(SEGMENT_BITS * math.log(2) / PROBES), 0
    while True:
        part = _inside(keys, np.full(len(keys), depth, np.uint64), segments)
        if np.bincount(part, levels, 1).max() <= most:
            return [segment_bits(keys[part == k], levels[part == k]) for k in range(1 << depth)]
        depth += 1


def _inside(keys: np.ndarray, depth: np.ndarray, segments: int) -> np.ndarray:
    """The part of a segment: the bits of a key behind those that name the segment."""
    own = keys >> (np.uint64(65 - segments.bit_length()) - depth)
    return (own & ((np.uint64(1) << depth) - np.uint64(1))).astype(np.int64)


def part_of(keys: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """The part of the filter a key belongs to, where segment s has 2 ** depths[s] parts."""
    segment = segment_of(keys, len(depths))
    first = np.r_[0, np.cumsum(1 << depths)[:-1]]
    return first[segment] + _inside(keys, depths[segment].astype(np.uint64), len(depths))


class Filter:
    """Counts of keys by repeated membership probes; ``bits`` are the parts from ``first`` on."""

    def __init__(self, bits: np.ndarray, means: np.ndarray, depths: np.ndarray, first: int = 0):
        self.bits, self.means, self.depths, self.first = bits, means, depths, first

    def levels(self, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), np.int64)
        active, base = np.arange(len(keys)), (part_of(keys, self.depths) - self.first) * SEGMENT_BITS
        for level in range(1, LEVELS):
            spread = mix64(keys[active] + np.uint64(level * int(_STEP) % 2**64))
            # A key that misses one place is not looked for at the others.
            for j in range(PROBES):
                at = base[active] + ((spread >> np.uint64(19 * j)) & np.uint64(SEGMENT_BITS - 1)).astype(np.int64)
                inside = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                active, spread = active[inside], spread[inside]
            if not len(active):
                break
            found[active] = level
        return found

    def counts(self, keys: np.ndarray) -> np.ndarray:
        # Each key is looked for once, and in order: neighbours lie in the same part.
        distinct, place = np.unique(keys, return_inverse=True)
        return self.means[self.levels(distinct)][place]


class Answers:
    """Counts of the keys of a chunk, whose levels were looked up elsewhere."""

    def __init__(self, keys: np.ndarray, levels: np.ndarray, means: np.ndarray):
        self.keys, self.found, self.means = keys, levels, means

    def counts(self, keys: np.ndarray) -> np.ndarray:
        return self.means[self.found[np.searchsorted(self.keys, keys)]]


class Model:
    """Everything that scoring needs: filter, commonest words, totals and weights."""

    def __init__(self, held: Filter, words: np.ndarray, counts: np.ndarray, n_tokens: int, n_words: int):
        order = np.argsort(words)
        # Behind the words a last one that stands for none.
        self.filter, self.words, self.counts = held, np.r_[words[order], np.uint64(2**64 - 1)], np.r_[counts[order].astype(np.float64), -1.0]
        beginnings = np.arange(1 << INDEX_BITS, dtype=np.uint64) << np.uint64(64 - INDEX_BITS)
        self.index = np.searchsorted(self.words, beginnings).astype(np.int32)
        self.n_tokens, self.total = n_tokens, n_tokens + 0.5 * (n_words + 1)
        self.weights = np.zeros(BUCKETS)
        # Parts of the filter as a table, if it is not broadcast.
        self.table: DataFrame | None = None

    def exact(self, tokens: np.ndarray) -> np.ndarray:
        """Counts of the commonest words, -1 for others."""
        at = self.index[tokens >> np.uint64(64 - INDEX_BITS)]
        behind = np.flatnonzero(self.words[at] < tokens)
        while len(behind):
            at[behind] += 1
            behind = behind[self.words[at[behind]] < tokens[behind]]
        return np.where(self.words[at] == tokens, self.counts[at], -1.0)

    def word_counts(self, tokens: np.ndarray, exact: np.ndarray) -> np.ndarray:
        result = exact.copy()
        rare = np.flatnonzero(exact < 0)
        result[rare] = self.filter.counts(tokens[rare])
        return result

    @staticmethod
    def bucket(counts: np.ndarray) -> np.ndarray:
        return np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64), BUCKETS - 1)

    def parts(self, tokens, exact, firsts):
        """Counts of the word, of the word before (documents for the first), and of the pair."""
        word = self.word_counts(tokens, exact)
        context = np.r_[0.0, word[:-1]]
        context[firsts] = word[tokens == END][0] if (tokens == END).any() else 0.0
        before = np.r_[START, tokens[:-1]]
        before[firsts] = START
        keys = pair_keys(before, tokens)
        pair = np.zeros(len(tokens))
        known = np.flatnonzero((context > 0) & (word > 0))
        pair[known] = np.minimum(self.filter.counts(keys[known]), np.minimum(context[known], word[known]))
        return word, context, before, keys, pair

    def log10(self, tokens, exact, firsts):
        word, context, _, _, pair = self.parts(tokens, exact, firsts)
        weight = np.where(context > 0, self.weights[self.bucket(context)], 0.0)
        ratio = np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0)
        return np.log10(weight * ratio + (1 - weight) * (word + 0.5) / self.total)


def _chunks(column: pa.Array, hashes: WordHash, size: int):
    """(rows, tokens, row of each token, first token of each row), about ``size`` tokens at a time."""
    held, lengths, done = [], [], 0

    def out():
        n = np.concatenate(lengths)
        ends = np.cumsum(n)
        tokens = np.full(ends[-1], END)
        words = np.ones(len(tokens), bool)
        words[ends - 1] = False
        tokens[words] = np.concatenate(held)
        held.clear()
        return np.arange(done, done + len(n)), tokens, np.repeat(np.arange(len(n)), n), ends - n

    for words, n in hashes.of_texts(column):
        held.append(words)
        lengths.append(n + 1)
        if sum(map(len, held)) + sum(map(len, lengths)) >= size:
            yield out()
            done += sum(map(len, lengths))
            held, lengths = [], []
    if lengths:
        yield out()


def _summed(keys: np.ndarray, documents: np.ndarray | None = None):
    """Distinct (document, key) with their number; the place of each input row among them."""
    if documents is None:
        return np.unique(keys, return_counts=True)
    order = np.lexsort((keys, documents))
    k, d = keys[order], documents[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (d[1:] != d[:-1])] if len(k) else np.empty(0, bool)
    group = np.cumsum(new) - 1
    place = np.empty(len(k), np.int64)
    place[order] = group
    return k[new], d[new], np.bincount(group, minlength=int(new.sum())), place


def _own_counts(keys: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """For each key, how often its document has it."""
    both = keys + documents.astype(np.uint64) * _PAIR
    order = np.argsort(both)
    ordered = both[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    lengths = np.diff(np.r_[starts, len(ordered)])
    counts = np.empty(len(keys), np.int64)
    counts[order] = np.repeat(lengths, lengths)
    return counts


def _grams(train: DataFrame, segments: int) -> DataFrame:
    """(segment, size, keys, counts): sums over some documents each; size 1 for words, 2 for pairs.

    A row has the keys of a segment, 8 bytes each, and their counts, 4 bytes each.
    """

    def listed(values, ends):
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(values)])

    # What a call makes is free again before the next texts are read.
    def counted(size, keys):
        distinct, n = _summed(keys)
        for i in range(0, len(n), KEYS):
            own, counts = distinct[i : i + KEYS], n[i : i + KEYS].astype(np.uint32)
            segment = segment_of(own, segments).astype(np.int32)
            starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            ends = np.r_[starts, len(own)]
            columns = [pa.array(segment[starts]), pa.array(np.full(len(starts), size, np.int8)), listed(own, ends), listed(counts, ends)]
            yield pa.RecordBatch.from_arrays(columns, ["segment", "size", "keys", "counts"])

    def pairs(tokens, firsts):
        before = np.r_[START, tokens[:-1]]
        before[firsts] = START
        return pair_keys(before, tokens)

    def task(batches):
        hashes = WordHash()
        for batch in batches:
            for _, tokens, _, firsts in _chunks(batch.column(0), hashes, COUNTED):
                yield from counted(1, tokens)
                keys = pairs(tokens, firsts)
                del _, tokens, firsts
                yield from counted(2, keys)
                del keys

    return train.select("text").mapInArrow(task, "segment int, size tinyint, keys binary, counts binary")


def _added(parts: list[tuple]) -> tuple:
    """Distinct (size, key) with the sums of their numbers."""
    size, keys, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    sums = []
    for kind in np.unique(size):
        own, counted = keys[size == kind], n[size == kind]
        order = np.argsort(own)
        own, counted = own[order], counted[order]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        sums.append((np.full(len(starts), kind, np.int8), own[starts], np.add.reduceat(counted, starts)))
    return tuple(np.concatenate(c) for c in zip(*sums, strict=True))


def _listed(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in all rows of a binary column, and where each row begins and the last one ends."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]].view(kind)
    return values, (offsets - offsets[0]) // values.itemsize


def _totals(batches):
    """(segment, sizes, keys, sums) for each segment of (segment, size, keys, counts) rows in order of segments.

    Keys of a segment are summed as they come, so that not much more than its distinct keys is held.
    """
    current, held, length, most = None, [], 0, HELD
    for batch in batches:
        if not batch.num_rows:
            continue
        segment, size = (batch.column(i).to_numpy() for i in (0, 1))
        (keys, at), (n, _) = _listed(batch.column(2), np.int64), _listed(batch.column(3), np.uint32)
        cuts = [0, *(np.flatnonzero(segment[1:] != segment[:-1]) + 1).tolist(), len(segment)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if segment[start] != current:
                if held:
                    yield current, *_added(held)
                current, held, length, most = int(segment[start]), [], 0, HELD
            own = slice(at[start], at[end])
            held.append((np.repeat(size[start:end], np.diff(at[start : end + 1])), keys[own], n[own].astype(np.int64)))
            length += int(at[end] - at[start])
            if length > most:
                held = [_added(held)]
                length = len(held[0][0])
                most = max(HELD, 2 * length)
    if held:
        yield current, *_added(held)


def _segments(counts: DataFrame, segments: int) -> DataFrame:
    """Per segment its bits and sums by level, and a row for every word with its exact count.

    A key may come several times; all rows of a segment are in one partition.
    """
    schema = "segment int, part int, bits binary, level_n array<long>, level_sum array<long>, key long, n long"

    def task(batches):
        for segment, size, keys, n in _totals(batches):
            words = size == 1
            lists, count = pa.list_(pa.int64()), int(words.sum())
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(count, kind) for kind in (pa.int32(), pa.int32(), pa.binary(), lists, lists)), pa.array(keys[words]), pa.array(n[words])],
                ["segment", "part", "bits", "level_n", "level_sum", "key", "n"],
            )
            levels = level_of(n)
            parts = divided(keys.view(np.uint64), levels, segments)
            sums = [np.bincount(levels, weights, LEVELS).astype(np.int64).tolist() for weights in (None, n)]
            # Sums of the segment are in the row of its first part.
            for k, bits in enumerate(parts):
                row = [segment, k, bits.tobytes(), *(sums if k == 0 else ([], [])), None, None]
                kinds = (pa.int32(), pa.int32(), pa.binary(), lists, lists, pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], kind) for v, kind in zip(row, kinds, strict=True)],
                    ["segment", "part", "bits", "level_n", "level_sum", "key", "n"],
                )

    return counts.sortWithinPartitions("segment").mapInArrow(task, schema)


def _packed(docs: DataFrame) -> DataFrame:
    """(chunk, ids, flags, lengths, tokens) of (doc_id, text, held_out) rows, some documents a row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches):
        hashes = WordHash()
        for batch in batches:
            for own, tokens, document, _ in _chunks(batch.column(1), hashes, CHUNK):
                ids, flags = (batch.column(i).take(pa.array(own)) for i in (0, 2))
                ends = pa.array([0, len(own)], pa.int32())
                lengths = pa.array(np.bincount(document, minlength=len(own)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.ListArray.from_arrays(ends, values) for values in (ids, flags, lengths)), pa.array([tokens.tobytes()], pa.binary())],
                    ["ids", "flags", "lengths", "tokens"],
                )

    packed = docs.select("doc_id", "text", "held_out").mapInArrow(task, f"ids array<{kind}>, flags array<boolean>, lengths array<bigint>, tokens binary")
    return stage(packed.withColumn("chunk", F.monotonically_increasing_id()))


def _wanted(model: Model, tokens: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Keys of a chunk that the filter is asked for, in order."""
    before = np.r_[START, tokens[:-1]]
    before[firsts] = START
    keys = np.sort(np.r_[tokens[model.exact(tokens) < 0], pair_keys(before, tokens)])
    return keys[np.r_[True, keys[1:] != keys[:-1]]]


def _unpacked(lengths, tokens) -> tuple:
    lengths = np.asarray(lengths.values)
    return np.frombuffer(tokens.as_buffer(), np.uint64), np.repeat(np.arange(len(lengths)), lengths), np.r_[0, np.cumsum(lengths)[:-1]]


def _answered(packed: DataFrame, model: Model, held, shard_parts: int) -> DataFrame:
    """Packed chunks with the levels of their keys, looked up in the shards of the filter."""
    schema = "shard int, part int, chunk long, data binary"

    def ask(batches):
        model = held()
        for batch in batches:
            for chunk, lengths, tokens in zip(*batch.columns, strict=True):
                tokens, _, firsts = _unpacked(lengths, tokens)
                keys = _wanted(model, tokens, firsts)
                shards, starts = np.unique(part_of(keys, model.filter.depths) // shard_parts, return_index=True)
                data = [keys[i:j].tobytes() for i, j in zip(starts, [*starts[1:], len(keys)], strict=True)]
                n = len(shards)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards, pa.int32()), pa.array(np.zeros(n), pa.int32()), pa.array([chunk.as_py()] * n, pa.int64()), pa.array(data, pa.binary())],
                    ["shard", "part", "chunk", "data"],
                )

    def answer(batches):
        model, width, current, bits = held(), SEGMENT_BITS // 8, None, None
        for batch in batches:
            names, found = [], []
            for shard, part, chunk, data in zip(*batch.columns, strict=True):
                shard, part, chunk = shard.as_py(), part.as_py(), chunk.as_py()
                if shard != current:
                    current, bits = shard, np.zeros(shard_parts * width, np.uint8)
                if chunk < 0:
                    at = (part - shard * shard_parts) * width
                    bits[at : at + width] = np.frombuffer(data.as_buffer(), np.uint8)
                else:
                    own = Filter(bits, model.filter.means, model.filter.depths, shard * shard_parts)
                    names.append((chunk, shard))
                    found.append(own.levels(np.frombuffer(data.as_buffer(), np.uint64)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in names], pa.int64()), pa.array([s for _, s in names], pa.int32()), pa.array(found, pa.binary())],
                ["chunk", "shard", "levels"],
            )

    asked = packed.select("chunk", "lengths", "tokens").mapInArrow(ask, schema)
    both = model.table.select(F.expr(f"cast(part div {shard_parts} as int)").alias("shard"), "part", F.lit(-1).cast("long").alias("chunk"), F.col("bits").alias("data"))
    # Keys are hashes, so no shard is hot; a shard's parts come before its questions.
    dealt = both.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "chunk")
    answers = dealt.mapInArrow(answer, "chunk long, shard int, levels binary")
    lists = answers.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("shard", "levels"))).alias("answers"))
    return packed.join(lists.hint("merge"), "chunk").select("ids", "lengths", "flags", "tokens", F.col("answers.levels").alias("levels"))


def _loaded(batches, model: Model, packed: bool):
    """(ids, flags, tokens, row of each token, first token of each row), some documents at a time.

    The model's filter answers for these documents until the next ones are taken.
    """
    hashes = WordHash()
    means = model.filter.means
    for batch in batches:
        if not packed:
            for own, tokens, document, firsts in _chunks(batch.column(1), hashes, SCORED):
                yield *(batch.column(i).take(pa.array(own)) for i in (0, 2)), tokens, document, firsts
            continue
        for ids, lengths, flags, tokens, levels in zip(*batch.columns, strict=True):
            tokens, document, firsts = _unpacked(lengths, tokens)
            found = np.frombuffer(b"".join(levels.as_py()), np.uint8)
            model.filter = Answers(_wanted(model, tokens, firsts), found, means)
            yield ids.values, flags.values, tokens, document, firsts


def _readable(docs: DataFrame, model: Model, held, shard_parts: int) -> DataFrame:
    """What ``_loaded`` reads of (doc_id, text, held_out) rows."""
    docs = docs.select("doc_id", "text", "held_out")
    return docs if model.table is None else _answered(_packed(docs), model, held, shard_parts)


def _fit(train: DataFrame, model: Model, held, fit_rows: int | None, shard_parts: int) -> np.ndarray:
    """The best weight per size of the context, over documents that are scored by the others."""
    rows = train.withColumn("held_out", F.lit(False))
    if fit_rows is not None:
        sample = train.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").limit(fit_rows)
        sample = stage(sample.coalesce(1)).select(F.col("doc_id").alias("_fit")).distinct()
        rows = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("_fit"), "left_semi")
    packed = model.table is not None

    # A call's arrays are free again before the next documents are read.
    def add(total, model, tokens, document, firsts):
        word, context, before, keys, pair = model.parts(tokens, model.exact(tokens), firsts)
        of_word = _own_counts(tokens, document)
        # Every word but the end is the one before as often as it occurs; the start is so once.
        of_context = np.r_[1, of_word[:-1]]
        of_context[firsts] = 1
        own = of_word, of_context, _own_counts(keys, document)
        word, context, pair = (np.maximum(c - o, 0) for c, o in zip((word, context, pair), own, strict=True))
        share = (word + 0.5) / model.total
        ratio = np.divide(np.minimum(pair, context), context, out=np.zeros(len(pair)), where=context > 0)
        buckets = model.bucket(context)
        # Where the others have not seen the pair, the logarithm is a sum.
        seen, unseen = (ratio > 0).nonzero()[0], ((ratio == 0) & (context > 0)).nonzero()[0]
        shares = np.bincount(buckets[unseen], np.log(share[unseen]), BUCKETS)
        n_unseen = np.bincount(buckets[unseen], minlength=BUCKETS)
        buckets, ratio, share = buckets[seen], ratio[seen], share[seen]
        for k, weight in enumerate(GRID):
            total[:, k] += shares + n_unseen * math.log(1 - weight)
            total[:, k] += np.bincount(buckets, np.log(weight * ratio + (1 - weight) * share), BUCKETS)

    def task(batches):
        model = held()
        total = np.zeros((BUCKETS, len(GRID)))
        for _, _, *chunk in _loaded(batches, model, packed):
            add(total, model, *chunk)
            del chunk
        at = np.arange(BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(list(total), pa.list_(pa.float64()))], ["bucket", "sums"])

    found = _readable(rows, model, held, shard_parts).mapInArrow(task, "bucket long, sums array<double>")
    sums = found.select("bucket", F.posexplode("sums").alias("k", "s")).groupBy("bucket", "k").agg(F.sum("s").alias("s"))
    table = np.zeros((BUCKETS, len(GRID)))
    for bucket, k, value in sums.collect():  # BUCKETS * len(GRID) rows
        table[bucket, k] = value
    return GRID[table.argmax(axis=1)]


def train_model(
    train: DataFrame, frequent: int = FREQUENT, fit_rows: int | None = None, broadcast_parts: int = BROADCAST_PARTS, shard_parts: int = SHARD_PARTS
) -> tuple:
    """The model of (doc_id, text) rows, its broadcast, and the exact counts (key, c) of all words.

    The broadcast is made once; weights are set where the model is used.
    """
    spark = train.sparkSession
    segments = n_segments(train.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    # Not summed by groupBy: behind a shuffle by segment it would keep all distinct keys of a task in two tables.
    built = stage(_segments(_grams(train, segments).repartition("segment"), segments))
    words = built.where(F.col("key").isNotNull()).select("key", F.col("n").alias("c"))
    n_tokens, n_words = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    parts = built.where(F.col("segment").isNotNull())
    depths, level_n, level_sum = np.zeros(segments, np.int64), np.zeros(LEVELS), np.zeros(LEVELS)
    # A row of some KB per segment, one after the other.
    sums = parts.groupBy("segment").agg(F.count("*").alias("n"), F.max("level_n").alias("level_n"), F.max("level_sum").alias("level_sum"))
    for segment, n, counted, total in sums.toLocalIterator():
        depths[segment] = n.bit_length() - 1
        level_n += np.array(counted)
        level_sum += np.array(total)
    first = np.r_[0, np.cumsum(1 << depths)]
    firsts = F.broadcast(spark.createDataFrame(list(zip(range(segments), first[:-1].tolist(), strict=True)), "segment int, first int"))
    parts = parts.join(firsts, "segment").select((F.col("first") + F.col("part")).alias("part"), "bits")
    whole, bits = first[-1] <= broadcast_parts, None
    if whole:
        # At most broadcast_parts rows of SEGMENT_BITS / 8 bytes each, one task's after the other: all at once,
        # the driver would hold them three times.
        width = SEGMENT_BITS // 8
        bits = np.zeros(int(first[-1]) * width, np.uint8)
        for part, own in parts.toLocalIterator():
            bits[part * width : (part + 1) * width] = np.frombuffer(own, np.uint8)
    means = np.divide(level_sum, level_n, out=BASE ** np.maximum(np.arange(LEVELS) - 0.5, 0), where=level_n > 0)
    means[0] = 0.0
    top = words.orderBy(F.desc("c"), "key").limit(frequent).toArrow()
    model = Model(Filter(bits, means, depths), top["key"].to_numpy().view(np.uint64), top["c"].to_numpy(), n_tokens, n_words)
    held = shared(spark, model)
    if not whole:
        model.table = parts
    model.weights = _fit(train, model, held, fit_rows, shard_parts)
    return model, held, words


def lm_scores(
    docs: DataFrame, folds: int = 5, held_out: int = 1, frequent: int = FREQUENT, fit_rows: int | None = None,
    broadcast_parts: int = BROADCAST_PARTS, shard_parts: int = SHARD_PARTS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts(docs).select("doc_id", F.col("text").cast("binary"), (remainder(F.col("doc_id"), folds) == held_out).alias("held_out"))
    model, held, words = train_model(rows.where(~F.col("held_out")).select("doc_id", "text"), frequent, fit_rows, broadcast_parts, shard_parts)
    weights, total, packed = model.weights, float(model.total), model.table is not None

    rest_kind = pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())]))

    # As in _fit.
    def one(model, ids, flags, tokens, document, firsts):
        exact = model.exact(tokens)
        common, size = exact >= 0, len(ids)
        base = np.bincount(document, np.where(common, np.log10((exact.clip(0) + 0.5) / model.total), 0.0), size)
        score = np.bincount(document, model.log10(tokens, exact, firsts), size)
        rare = np.flatnonzero(~common)
        key, of, n, _ = _summed(tokens[rare], document[rare])
        ends = pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=size))], pa.int32())
        rest = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"]))
        return pa.RecordBatch.from_arrays(
            [
                ids,
                flags,
                pa.array(np.bincount(document, minlength=size).astype(np.int64)),
                pa.array(np.bincount(document, common, size).astype(np.int64)),
                pa.array(base),
                pa.array(score),
                rest.cast(rest_kind),
            ],
            ["doc_id", "held_out", "n_tokens", "common", "base", "score", "rest"],
        )

    def task(batches):
        model = held()
        model.weights = weights
        for chunk in _loaded(batches, model, packed):
            yield one(model, *chunk)
            del chunk

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, common long, base double, score double, rest array<struct<key:bigint,n:bigint>>"
    scored = stage(_readable(rows, model, held, shard_parts).mapInArrow(task, schema).withColumn("row", F.monotonically_increasing_id()))
    rest = scored.select("row", F.inline("rest")).join(words.hint("merge"), "key", "left")
    count = F.coalesce("c", F.lit(0))
    sums = rest.groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("_known"),
        F.sum(F.col("n") * F.log10((count + 0.5) / F.lit(total))).alias("_base"),
    )
    return scored.drop("rest").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("common") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
