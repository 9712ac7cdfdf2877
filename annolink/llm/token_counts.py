"""Token counts of documents without materialising token ids.

1. The texts are cut into pre-tokens by the tokenizer's own rule; equal ones are counted
   inside each task, then over all tasks.
2. Every distinct pre-token is given to the tokenizer once, which tells its number of pieces.
3. A second pass over the texts sums pieces per document. The counts of the ``frequent`` most
   frequent pre-tokens, of at most ``FREQUENT_BYTES`` bytes each and so of bounded size, are
   broadcast: this also keeps the hottest keys out of the shuffle. All other pre-tokens of a
   document are joined, with their frequency in it, to the table of counts.

Special strings inside a text are one token each, as the library has it by default.

Cases: a null text is an empty one, with 0 tokens. Bytes that are not UTF-8 count as
replacement characters. Rows are counted each, also those without or with the same id. An
empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.llm.common import shared, texts
from annolink.staging import stage

FREQUENT, FREQUENT_BYTES = 200_000, 48
# Distinct pre-tokens that a task holds before it passes them on.
HELD = 100_000
# Documents that are handed on together.
ROWS = 1_000
# The pre-token rule and the special string of the byte-level vocabulary.
RULE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = "<|endoftext|>"


def cutter():
    """text -> list of pre-tokens, special strings among them."""
    # The library's white space is the Unicode property, which has no separators of ASCII control.
    found = regex.compile(RULE.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall

    def cut(text: str) -> list[str]:
        if SPECIAL not in text:
            return found(text)
        first, *others = text.split(SPECIAL)
        pieces = found(first)
        for part in others:
            pieces.append(SPECIAL)
            pieces += found(part)
        return pieces

    return cut


def _decoded(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py().decode("utf-8", "replace")


def _distinct(rows: DataFrame) -> DataFrame:
    def task(batches):
        cut, held = cutter(), Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["piece", "n"])
            held.clear()
            return batch

        for batch in batches:
            for text in _decoded(batch.column(0)):
                held.update(cut(text))
                if len(held) > HELD:
                    yield out()
        yield out()

    found = rows.select("text").mapInArrow(task, "piece string, n long")
    return found.groupBy("piece").agg(F.sum("n").alias("n"))


def _counted(distinct: DataFrame, tokenizer: str) -> DataFrame:
    def task(batches):
        # The cores beside it are other tasks': threads of its own would hold memory each.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(tokenizer)
        library.no_padding()
        library.no_truncation()
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                pieces = library.encode_batch_fast(part.column(0).to_pylist(), add_special_tokens=False)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(p.ids) for p in pieces], pa.int64())], ["piece", "n", "pieces"]
                )

    return distinct.mapInArrow(task, "piece string, n long, pieces long")


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row; ``tokenizer`` is the path of its file."""
    rows = texts(docs).select("doc_id", F.col("text").cast("binary"))
    counts = stage(_counted(_distinct(rows), tokenizer))
    short = counts.where(F.octet_length("piece") <= FREQUENT_BYTES).orderBy(F.desc("n"), "piece").limit(frequent)
    held = short.select("piece", "pieces").toArrow()
    known = shared(docs.sparkSession, dict(zip(held["piece"].to_pylist(), held["pieces"].to_pylist(), strict=True)))

    def task(batches):
        cut, table = cutter(), known()
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            sums, names, counts, ends = [], [], [], [0]
            for text in _decoded(batch.column(1)):
                total = 0
                for piece, n in Counter(cut(text)).items():
                    pieces = table.get(piece)
                    if pieces is None:
                        names.append(piece)
                        counts.append(n)
                    else:
                        total += n * pieces
                sums.append(total)
                ends.append(len(names))
            others = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["piece", "n"])
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), others)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sums, pa.int64()), rest], ["doc_id", "n_bytes", "known", "rest"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    part = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    part = part.mapInArrow(task, f"doc_id {kind}, n_bytes long, known long, rest array<struct<piece:string,n:long>>")
    part = stage(part.withColumn("row", F.monotonically_increasing_id()))
    others = part.select("row", F.inline("rest"))
    sums = others.join(counts.select("piece", "pieces"), "piece").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    n_tokens = F.col("known") + F.coalesce("more", F.lit(0))
    return part.drop("rest").join(sums, "row", "left").select(
        "doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit")
    )
