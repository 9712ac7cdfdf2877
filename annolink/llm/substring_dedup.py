"""Removal of long passages that repeat across documents, by level-wise doubling.

Windows of 12, then 25, then 50 words (each length half of the next): only where a window is
repeated in another document is the window of twice the length looked at, until no candidates
are left. At the lower levels not every window is sent around. Of the short windows inside a
long one, the one with the least hash speaks for it: equal long windows hold equal short
ones, so they choose the same, and if the chosen one is not repeated, the long one is not
either. Nothing is lost, and about one word in 20 costs a row instead of every word.

1. Level 12: chosen windows of all documents; hashes that occur in two documents stay.
2. Level 25: one more pass over the documents with such windows; of the 50-word windows whose
   chosen 12 words are repeated, the chosen 25 words. A row also carries the hashes of the
   50-word windows it speaks for.
3. Level 50: hashes of the candidates that are left, with the smallest id of a document where
   each starts. Windows of documents with larger ids are removed.
4. A last pass over all documents cuts the words.

A hash is grouped with partial sums before the shuffle, and found again by a join of two
shuffled tables, so Spark can split a passage that stands in a third of all documents.

Cases: a null text has no words. A text shorter than the window stays whole. Rows without an
id neither lose words nor count as earlier documents. Rows that share an id do not remove
each other's words; their texts are told apart. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.llm.common import texts, window_hashes
from annolink.llm.hashing import WordHash
from annolink.staging import stage

WINDOW = 50


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text as bytes, tag. A place is a word's number in the lower bits, the tag above."""
    tag = F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).alias("tag")
    return texts(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), tag)


def ladder(window: int) -> tuple[int, int]:
    """The two lengths below the window: halves, rounded down, at least one word."""
    half = max(1, window // 2)
    return max(1, half // 2), half


def chosen(hashes: np.ndarray, window: int, length: int) -> np.ndarray:
    """For each window of words, the place of the least of the shorter windows in it (the first of equals)."""
    width = window - length + 1
    if len(hashes) < width:
        return np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, width)
    return view.argmin(axis=1) + np.arange(len(view))


def _first_level(rows: DataFrame, window: int) -> DataFrame:
    length, _ = ladder(window)

    def task(batches):
        hashes = WordHash()
        for batch in batches:
            found, places, ids = [], [], []
            for doc, text, tag in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = text.as_py().split()
                if len(words) < window:
                    continue
                own = window_hashes(hashes.of(words), length)
                at = np.unique(chosen(own, window, length))
                found.append(own[at])
                places.append(at + (tag << 32))
                ids.append(np.full(len(at), doc, np.int64))
            if found:
                columns = [np.concatenate(found).view(np.int64), np.concatenate(ids), np.concatenate(places)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "doc_id", "place"])

    return rows.mapInArrow(task, "h long, doc_id long, place long")


def _second_level(rows: DataFrame, window: int) -> DataFrame:
    """rows: doc_id, text, tag, places of repeated windows of the first level."""
    short, half = ladder(window)

    def task(batches):
        hashes = WordHash()
        for batch in batches:
            out: list[tuple] = []
            for doc, text, tag, places in zip(*(batch.column(i) for i in range(4)), strict=True):
                tag = tag.as_py()
                known = np.asarray(places.values)
                known = known[known >> 32 == tag] & 0xFFFFFFFF
                words = hashes.of(text.as_py().split())
                repeated = np.zeros(len(words), bool)
                repeated[known] = True
                candidates = np.flatnonzero(repeated[chosen(window_hashes(words, short), window, short)])
                if not len(candidates):
                    continue
                halves, whole = window_hashes(words, half), window_hashes(words, window)
                speaker = chosen(halves, window, half)[candidates]
                cuts = np.flatnonzero((np.diff(candidates) > 1) | (np.diff(speaker) != 0)) + 1
                for run in np.split(np.arange(len(candidates)), cuts):
                    first, last = candidates[run[0]], candidates[run[-1]]
                    out.append((halves[speaker[run[0]]].view(np.int64), doc.as_py(), first + (tag << 32), whole[first : last + 1].view(np.int64)))
            if out:
                h, ids, starts, own = zip(*out, strict=True)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(list(map(len, own)))], pa.int32()), pa.array(np.concatenate(own)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), lists], ["h", "doc_id", "place", "longer"]
                )

    return rows.mapInArrow(task, "h long, doc_id long, place long, longer array<long>")


def _repeated(rows: DataFrame) -> DataFrame:
    """The rows whose hash occurs in two documents, with the smallest id of these (``first_id``)."""
    groups = rows.groupBy(F.col("h").alias("_h")).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("_last"))
    # Written, so that the join shuffles both sides and a hot hash can be split.
    groups = stage(groups.where("first_id < _last").drop("_last"))
    return rows.join(groups.hint("merge"), F.col("h") == F.col("_h")).drop("_h")


def _by_document(places: DataFrame) -> DataFrame:
    """Places of a document in one row, not more than it has words."""
    return places.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("place").alias("places"))


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, place) of each window that also starts in a document with a smaller id."""
    rows = _rows(docs).where(F.col("doc_id").isNotNull())
    first = stage(_repeated(stage(_first_level(rows, window))).select("doc_id", "place"))
    candidates = rows.join(_by_document(first).hint("merge"), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "tag", "places")
    second = stage(_repeated(stage(_second_level(candidates, window))).select("doc_id", "place", "longer"))
    longest = second.select("doc_id", "place", F.posexplode("longer").alias("after", "h"))
    longest = longest.select("h", "doc_id", (F.col("place") + F.col("after")).alias("place"))
    return _repeated(longest).where("doc_id > first_id").select("doc_id", "place")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text (the words that stay, joined by one blank), n_words, n_removed per row."""
    rows = _rows(docs)
    places = _by_document(repeated_windows(docs, window))
    known = rows.where(F.col("doc_id").isNotNull()).join(places.hint("merge"), F.col("doc_id") == F.col("_id"), "left").drop("_id")
    unknown = rows.where(F.col("doc_id").isNull()).withColumn("places", F.lit(None).cast("array<bigint>"))

    def task(batches):
        for batch in batches:
            kept, counts, removed = [], [], []
            for text, tag, places in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3), strict=True):
                words = text.as_py().split()
                cover = None
                if places.is_valid:
                    starts = np.asarray(places.values)
                    starts = starts[starts >> 32 == tag] & 0xFFFFFFFF
                    edges = np.bincount(starts, minlength=len(words) + 1) - np.bincount(starts + window, minlength=len(words) + 1)
                    cover = np.cumsum(edges[: len(words)]) > 0
                counts.append(len(words))
                removed.append(0 if cover is None else int(cover.sum()))
                if removed[-1]:
                    words = [words[i] for i in np.flatnonzero(~cover)]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                ["doc_id", "text", "n_words", "n_removed"],
            )

    return known.unionByName(unknown).mapInArrow(task, "doc_id long, text string, n_words long, n_removed long")
