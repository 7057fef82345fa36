"""What a Python worker keeps after a task."""

import numpy as np
import pyarrow as pa
import pytest

from kestrel.llm import best_fit, common, overlap_join, substring_dedup, token_files, word_bpe

pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("taken", [None, 1])
def test_memory_is_handed_back_when_a_task_ends(monkeypatch, taken):
    calls = []
    monkeypatch.setattr(common, "release_memory", lambda: calls.append(1))
    task = common.tidy(lambda batches: (x for x in batches))([1, 2])
    assert calls == []
    if taken:
        assert next(task) == 1
        task.close()  # a limit ends a task before its last batch
    else:
        assert list(task) == [1, 2]
    assert calls == [1]


def test_release_memory_runs_anywhere():
    common.release_memory()


def _task(made_of, batches):
    """The batches that the function given to ``mapInArrow`` yields, run in this process."""

    class Rows:
        columns: list = []

        def mapInArrow(self, run, schema):
            return list(run(iter(batches)))

        def select(self, *_):
            return self

    return made_of(Rows())


def test_packing_keeps_no_pieces(monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 0

    monkeypatch.setattr(best_fit, "TaskContext", Context)
    monkeypatch.setattr(best_fit, "keyed_texts", lambda docs, *_: docs)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words here", "and others there"])], ["id", "text"])
    out = _task(lambda rows: best_fit.token_pieces(rows, id_col="id", text_col="text", tokenizer=path, end_id=0, capacity=8), [batch])
    assert sum(b.num_rows for b in out) == 2
    assert len(word_bpe.encoder(path).code) == 1  # the empty piece


def test_lists_are_made_a_few_sets_at_a_time(monkeypatch):
    sets = [np.arange(i, i + 6, dtype=np.int64) for i in range(7)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(7)), pa.array(range(7)), pa.array([8] * 7, pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary()),
         pa.array([1 + i % 3 for i in range(7)], pa.int32()), pa.array([9] * 7)], ["ord", "row", "n", "items", "listed", "scan"])
    whole = _task(overlap_join._lists, [batch])
    assert len(whole) == 1
    monkeypatch.setattr(overlap_join, "LISTED_SETS", 3)
    parts = _task(overlap_join._lists, [batch])
    assert len(parts) == 3
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches(whole).to_pydict()


class _Context:
    @staticmethod
    def get():
        return _Context

    @staticmethod
    def partitionId():
        return 0


def _texts(*texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], ["id", "row", "text"])


def _calls(monkeypatch, module):
    """(memory handed back, text bytes of each slice) of the tasks that follow."""
    freed, slices = [], []
    monkeypatch.setattr(common, "release_memory", lambda: freed.append(1))

    def sliced(*args):
        for first, part in common.text_slices(*args):
            slices.append(sum(map(len, part.to_pylist())))
            yield first, part

    monkeypatch.setattr(module, "text_slices", sliced)
    return freed, slices


def test_token_files_hand_memory_back_and_take_small_slices(monkeypatch, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(token_files, "TaskContext", _Context)
    freed, slices = _calls(monkeypatch, token_files)
    texts = ["some words " * 10_000] * 9
    batch = _texts(*texts).select(["id", "text"])
    index = _task(lambda rows: token_files._written(rows, tokenizer=path, end_id=1, out=str(tmp_path)), [batch])
    assert len(freed) == 1
    assert sum(slices) == sum(map(len, texts)) and max(slices) <= 512 << 10
    named = [pa.RecordBatch.from_pylist([r | {"base": 0} for r in b.to_pylist()]) for b in index]
    out = pa.Table.from_batches(_task(token_files._read, named)).to_pydict()
    assert len(freed) == 2
    assert out["doc_id"] == list(range(9)) and len(set(out["ids_crc32"])) == 1
    assert out["start"] == [i * out["n_tokens"][0] for i in range(9)]


def test_substring_dedup_hands_memory_back_and_takes_small_slices(monkeypatch):
    freed, slices = _calls(monkeypatch, substring_dedup)
    texts = ["some words " * 10_000] * 9
    assert sum(b.num_rows for b in _task(lambda rows: substring_dedup._seeds(rows, 50, 16), [_texts(*texts)])) == 9
    assert len(freed) == 1
    assert sum(slices) == sum(map(len, texts)) and max(slices) <= 512 << 10
    spans = pa.array([[{"start": 0, "end": 2}]], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
    cut = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array(["a b c"]), spans], ["id", "row", "text", "spans"])
    assert _task(substring_dedup._cut, [cut])[0].column(2).to_pylist() == ["c"]
    assert len(freed) == 2


def test_substring_dedup_runs_no_two_python_steps_in_one_task(spark, monkeypatch):
    plans = []
    for name in ("_run_hashes", "_cut"):
        def seen(df, *args, step=getattr(substring_dedup, name)):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return step(df, *args)
        monkeypatch.setattr(substring_dedup, name, seen)
    shared = " ".join(f"w{i}" for i in range(70))
    docs = spark.createDataFrame([(1, "a b " + shared + " c"), (2, "d " + shared + " e f"), (3, "g h"), (4, None)], "doc_id long, text string")
    rows = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.substring_dedup(docs).collect()}
    assert rows == {1: (73, 0), 2: (73, 70), 3: (2, 0), 4: (0, 0)}
    assert len(plans) == 2
    for plan in plans:
        assert "ArrowEvalPython" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan
