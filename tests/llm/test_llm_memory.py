"""What the driver and the workers hold."""

import os

import numpy as np
import pyarrow as pa
import pytest

from annolink.llm import lm_scoring, token_counts
from annolink.llm.common import shared


def test_the_filter_is_not_collected_at_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c{i % 7}") for i in range(40)], "doc_id long, text string").selectExpr("doc_id", "binary(text) as text")
    collected, kind = [], type(docs)
    monkeypatch.setattr(kind, "toArrow", lambda df, own=kind.toArrow: collected.append(df.columns) or own(df))
    model, _, _ = lm_scoring.train_model(docs)
    assert collected and not any("bits" in columns for columns in collected)
    # All levels of a frequent word were found in the filter.
    word = lm_scoring.WordHash().of([b"a"])
    assert model.filter.levels(word)[0] == lm_scoring.level_of(np.array([40]))[0]


def test_counts_of_a_segment_are_summed_in_one_pass(spark, monkeypatch):
    # Segments of the first ten bits; keys come several times, as tasks have counted them.
    keys = lm_scoring.mix64(np.arange(3_000, dtype=np.uint64) % np.uint64(500))
    rows = [(int(s), 1 + i % 2, k, i % 5 + 1) for i, (s, k) in enumerate(zip(lm_scoring.segment_of(keys, 1024), keys.view(np.int64).tolist(), strict=True))]
    expected = {}
    for _, size, key, n in rows:
        expected[size, key] = expected.get((size, key), 0) + n
    monkeypatch.setattr(lm_scoring, "HELD", 7)
    packed = [(s, size, np.int64(key).tobytes(), np.uint32(n).tobytes()) for s, size, key, n in rows]
    counts = spark.createDataFrame(packed, "segment int, size tinyint, keys binary, counts binary")
    built = lm_scoring._segments(counts.repartition(3, "segment"), 1024)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and plan.count("Exchange") == 1
    got = built.collect()
    words = [(r.key, r.n) for r in got if r.key is not None]
    assert len(words) == len(dict(words)) and dict(words) == {key: n for (size, key), n in expected.items() if size == 1}
    parts = [r for r in got if r.segment is not None]
    assert sorted(r.segment for r in parts) == sorted({r[0] for r in rows})
    assert sum(sum(r.level_n) for r in parts) == len(expected) and sum(sum(r.level_sum) for r in parts) == sum(expected.values())


def test_training_keeps_no_hash_table_of_all_counts(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(lm_scoring, "_segments", lambda counts, segments, own=lm_scoring._segments: asked.append(counts) or own(counts, segments))
    docs = spark.createDataFrame([(i, f"a b c{i % 7}") for i in range(40)], "doc_id long, text string").selectExpr("doc_id", "binary(text) as text")
    _, _, words = lm_scoring.train_model(docs)
    assert "HashAggregate" not in asked[0]._jdf.queryExecution().executedPlan().toString()
    assert words.count() == 10 and words.agg({"c": "sum"}).first()[0] == 160


def test_keys_of_a_segment_are_summed_as_they_come(monkeypatch):
    monkeypatch.setattr(lm_scoring, "HELD", 100)
    held, own = [], lm_scoring._added
    monkeypatch.setattr(lm_scoring, "_added", lambda parts: held.append(sum(len(p[0]) for p in parts)) or own(parts))
    names = ["segment", "size", "keys", "counts"]

    def batch(segment, lists, kind=pa.binary()):
        columns = [pa.array([np.array(x, t).tobytes() for x in lists], kind) for t in (np.int64, np.uint32)]
        columns[1] = pa.array([np.ones(len(x), np.uint32).tobytes() for x in lists], kind)
        return pa.RecordBatch.from_arrays([pa.array(segment, pa.int32()), pa.array(np.full(len(lists), 1, np.int8)), *columns], names)

    batches = [batch([1, 1], [np.arange(30) % 20, np.arange(30, 50) % 20]) for _ in range(40)]
    # A part of a longer batch, and one of another kind.
    batches += [batch([], []), batch([1, 2, 2, 3, 4], [[7]] + [[5]] * 4).slice(1, 2), batch([3], [[5]], pa.large_binary())]
    got = [(s, k.tolist(), n.tolist()) for s, _, k, n in lm_scoring._totals(batches)]
    assert got == [(1, list(range(20)), [120] * 10 + [80] * 10), (2, [5], [2]), (3, [5], [1])]
    assert max(held) <= 150


def test_counts_leave_a_task_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "KEYS", 10)

    class Train:
        def select(self, *columns):
            return self

        def mapInArrow(self, task, schema):
            return task

    text = pa.array([" ".join(f"w{i}" for i in range(95)).encode()] * 2, pa.binary())
    got = list(lm_scoring._grams(Train(), 4)([pa.RecordBatch.from_arrays([text], ["text"])]))
    lists = [(s, len(k) // 8, np.frombuffer(n, np.uint32)) for b in got for s, k, n in zip(*(b.column(i).to_pylist() for i in (0, 2, 3)), strict=True)]
    assert max(sum(len(k) for k in b.column(2).to_pylist()) for b in got) == 80
    # A row for a segment in a batch: far fewer than keys.
    assert len(lists) <= 2 * (10 + 3) and all(len(n) == length for _, length, n in lists)
    assert sum(length for _, length, _ in lists) == 96 * 2 and sum(int(n.sum()) for _, _, n in lists) == 96 * 4


def test_shared_arrays(spark):
    held = shared(spark, {"a": np.arange(5), "b": "x"})

    def task(batches):
        for _ in batches:
            value = held()
            yield pa.RecordBatch.from_arrays([pa.array([int(value["a"].sum())]), pa.array([value["a"].flags.writeable])], ["n", "writeable"])

    got = spark.range(1).coalesce(1).mapInArrow(task, "n long, writeable boolean").collect()
    assert [tuple(r) for r in got] == [(10, False)]


def test_the_tokenizer_has_no_threads_of_its_own(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)

    class Table:
        def mapInArrow(self, task, schema):
            return task

    task = token_counts._counted(Table(), public_tokenizers.path("byte_bpe_50k.json"))
    pieces = pa.RecordBatch.from_arrays([pa.array(["a", " the"]), pa.array([1, 2], pa.int64())], ["piece", "n"])
    assert [b.column(2).to_pylist() for b in task([pieces])] == [[1, 1]]
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
