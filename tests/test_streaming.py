"""Incremental (streaming) index build equals a one-shot build; restarts only add new files."""

import os
import tempfile

from quire.operators import index as I
from quire.operators.analysis import analyze
from quire.streaming.incremental import merged_index, progress, stream_partial_indexes


def _write(d, name, text):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_stream_then_merge_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="quire-stream-")
    src, out, ckpt = f"{root}/src", f"{root}/out", f"{root}/ckpt"
    os.makedirs(src)
    texts = {f"d{i:02d}.txt": " ".join(["alpha", "beta", "gamma", "delta"][: 1 + i % 4] * (1 + i % 3)) for i in range(12)}
    for n, t in list(texts.items())[:8]:
        _write(src, n, t)
    stream_partial_indexes(spark, src, out, checkpoint=ckpt, files_per_trigger=3).awaitTermination()
    for n, t in list(texts.items())[8:]:
        _write(src, n, t)
    # restart from the same checkpoint: only the four new files are read
    stream_partial_indexes(spark, src, out, checkpoint=ckpt, files_per_trigger=3).awaitTermination()
    batches = sorted(x for x in os.listdir(f"{out}/partials") if x.startswith("batch="))
    assert len(batches) == 5  # 3 + 3 + 2, then 3 + 1
    got = merged_index(spark, out).postings.select("term", "rank", "doc_id", "tf")
    df = spark.createDataFrame(sorted(texts.items()), "doc_id string, text string")
    exp = I.champions(I.term_frequencies(I.term_counts_grouped(analyze(df, "doc_id"))))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    prog = progress(spark, out).orderBy("batch").collect()
    assert [r["documents"] for r in prog] == [3, 3, 2, 3, 1]
    assert prog[-1]["documents_so_far"] == 12


def test_a_batch_is_read_by_one_job_and_rejects_are_kept(spark):
    root = tempfile.mkdtemp(prefix="quire-stream-")
    src, out = f"{root}/src", f"{root}/out"
    os.makedirs(src)
    for i in range(9):
        _write(src, f"d{i}.txt", "alpha beta" if i % 4 else "")
    with open(f"{src}/d9.txt", "wb") as f:
        f.write(b"gamma \xff")
    q = stream_partial_indexes(spark, src, out, files_per_trigger=2)
    q.awaitTermination()
    # The partial and its counts; rejects in the first batch (none there) and where there are some.
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(str(q.runId))
    assert len(jobs) <= 5 * 2 + 2
    assert [r["doc_id"] for r in spark.read.parquet(f"{out}/rejects").collect()] == ["d9.txt"]
    prog = progress(spark, out).collect()
    assert sum(r["documents"] for r in prog) == 6 and sum(r["tokens"] for r in prog) == 12


def test_a_batch_is_listed_by_few_tasks_and_the_log_is_not_rewritten_every_ten(spark):
    from quire.streaming import incremental as inc

    root = tempfile.mkdtemp(prefix="quire-stream-")
    src, out = f"{root}/src", f"{root}/out"
    os.makedirs(src)
    for i in range(480):
        _write(src, f"d{i:03d}.txt", "alpha beta")
    seen, real = {}, inc.stream_partial_indexes

    def started(*a, **k):
        q = real(*a, checkpoint=f"{root}/ckpt", **k)
        seen["job"] = str(q.runId)
        return q

    inc.stream_partial_indexes = started
    before = {k: spark.conf.get(k, None) for k in (inc.LISTING_TASKS, inc.LOG_COMPACTION, inc.OPEN_COST)}
    try:
        assert inc.build_from_directory(spark, src, out, files_per_trigger=40).postings.count() == 20
    finally:
        inc.stream_partial_indexes = real
    assert {k: spark.conf.get(k, None) for k in before} == before
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(seen["job"]) for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= 2 * spark.sparkContext.defaultParallelism < 40
    assert not [f for f in os.listdir(f"{root}/ckpt/sources/0") if f.endswith(".compact")]
    # The rows of progress are files of their own, without a job; a replay puts its row in place of the older one.
    inc._note_progress(spark, out, {"batch": 3, "documents": 40, "tokens": 80})
    assert [tuple(r) for r in progress(spark, out).orderBy("batch").collect()] == [(b, 40, 80, 40 * (b + 1)) for b in range(12)]


def test_counts_are_set_up_once_for_all_batches(spark, monkeypatch):
    calls, real = [], I.counted_rows
    monkeypatch.setattr(I, "counted_rows", lambda *a, **k: (calls.append(1), real(*a, **k))[1])
    root = tempfile.mkdtemp(prefix="quire-stream-")
    os.makedirs(f"{root}/src")
    for i in range(6):
        _write(f"{root}/src", f"d{i}.txt", "alpha beta beta" if i else "the")
    stream_partial_indexes(spark, f"{root}/src", f"{root}/out", files_per_trigger=2).awaitTermination()
    assert len(calls) == 1 and [r["documents"] for r in progress(spark, f"{root}/out").orderBy("batch").collect()] in ([1, 2, 2], [2, 1, 2], [2, 2, 1])
    assert sorted((r["term"], r["tf"]) for r in spark.read.parquet(f"{root}/out/partials").collect()) == [("alpha", 0.333333)] * 5 + [("beta", 0.666667)] * 5
