"""Files are published as a whole: failures, replacement, repeated names, broken-off writes."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.sinks import files
from quire.sources import readers as Rd


def rows(spark, names, text="text of "):
    return spark.createDataFrame([(n, text + str(n)) for n in names], "name string, text string").repartition(3)


def found(folder):
    return {os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if not f.endswith(".crc")}


def test_a_second_write_replaces_the_first(spark, tmp_path):
    out = str(tmp_path / "out")
    first = files.write_text_files(rows(spark, ["a.txt", "b.txt", "sub/c.txt"]), out, "name", "text")
    assert {tuple(r) for r in first.collect()} == {("a.txt", 13), ("b.txt", 13), ("sub/c.txt", 17)}
    files.write_text_files(rows(spark, ["b.txt", "d.txt"], "new "), out, "name", "text")
    assert found(out) == {"b.txt", "d.txt"}
    assert {tuple(r) for r in Rd.read_text_dir(spark, out)[0].collect()} == {("b.txt", "new b.txt"), ("d.txt", "new d.txt")}
    files.write_text_files(rows(spark, ["e.txt"]), out, "name", "text", replace=False)
    assert found(out) == {"b.txt", "d.txt", "e.txt"}
    files.write_text_files(rows(spark, []), out, "name", "text")
    assert found(out) == set()


def test_a_task_that_fails_midway_leaves_what_was_there(spark, tmp_path):
    out = str(tmp_path / "out")
    files.write_text_files(rows(spark, ["old.txt"]), out, "name", "text")
    many = rows(spark, [f"n{k}.txt" for k in range(300)])
    broken = many.withColumn("text", F.when(F.col("name") == "n250.txt", F.raise_error(F.lit("no such luck"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="no such luck"):
        files.write_text_files(broken, out, "name", "text")
    assert found(out) == {"old.txt"} and os.listdir(out) == ["old.txt"]


@pytest.mark.parametrize("names", [["a.txt", "b.txt", "a.txt"], ["a.txt", None], ["a.txt", ""], ["../a.txt"], ["/a.txt"], ["_a.txt"], ["x/.a"]])
def test_names_that_cannot_be_kept(spark, tmp_path, names):
    out = str(tmp_path / "out")
    files.write_text_files(rows(spark, ["old.txt"]), out, "name", "text")
    with pytest.raises(Exception, match="unique|file name"):
        files.write_text_files(rows(spark, names), out, "name", "text")
    assert os.listdir(out) == ["old.txt"] and os.listdir(tmp_path) == ["out"]


def test_a_write_that_broke_off_is_finished_or_cleared(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    files.write_text_files(rows(spark, ["a.txt", "old.txt"]), out, "name", "text")
    with monkeypatch.context() as m:  # the driver is lost after the commit
        m.setattr(files, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            files.write_text_files(rows(spark, ["a.txt", "new.txt"], "second "), out, "name", "text")
    staged = [n for n in os.listdir(out) if n.startswith(files.STAGING)]
    assert len(staged) == 1
    # Spark's readers see the first output alone.
    assert {r["doc_id"] for r in Rd.read_text_dir(spark, out)[0].collect()} == {"a.txt", "old.txt"}
    # Some files were moved already.
    names = os.path.join(out, staged[0], "files")
    task = next(t for t in os.listdir(names) if "a.txt" in os.listdir(os.path.join(names, t)))
    os.replace(os.path.join(names, task, "a.txt"), os.path.join(out, "a.txt"))
    os.makedirs(os.path.join(out, files.STAGING + "lost", "files", "t"))
    files.finish_writes(spark, out)
    assert found(out) == {"a.txt", "new.txt"} and not [n for n in os.listdir(out) if n.startswith("_")]
    assert open(os.path.join(out, "a.txt")).read() == "second a.txt"


def test_nulls_bytes_and_names_with_blanks(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([("a b%20#?.txt", b"\xff\x00"), ("n.txt", None)], "name string, content binary")
    assert files.write_text_files(df, out, "name", "content").count() == 2
    assert open(os.path.join(out, "a b%20#?.txt"), "rb").read() == b"\xff\x00" and os.path.getsize(os.path.join(out, "n.txt")) == 0


def test_paths_are_those_of_hadoop(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    (tmp_path / "real").mkdir()
    conf.set("fs.viewfs.mounttable.quiretest.link./in", f"file://{tmp_path}/real")
    out = "viewfs://quiretest/in/deep/out"
    assert files.resolved(spark, out) == f"file:{tmp_path}/real/deep/out"
    files.write_text_files(rows(spark, ["a.txt"]), out, "name", "text")
    assert found(tmp_path / "real") == {"deep/out/a.txt"}
    with pytest.raises(ValueError, match="cannot be written"):
        files._store("nosuch://x/y")


def test_publication_lists_the_older_output_alone(spark, tmp_path, monkeypatch):
    out, seen, real = str(tmp_path / "out"), [], files.written_files
    files.write_text_files(rows(spark, ["a.txt", "sub/b.txt"]), out, "name", "text")
    with monkeypatch.context() as m:
        m.setattr(files, "written_files", lambda *a: (lambda df: (seen.append(df.count()), df)[1])(real(*a)))
        files.write_text_files(rows(spark, ["a.txt", "c.txt", "d.txt"]), out, "name", "text")
    assert seen[0] == 2 and found(out) == {"a.txt", "c.txt", "d.txt"}


def test_a_folder_of_many_files_is_read_by_tasks_that_take_many(spark, tmp_path, monkeypatch):
    for k in range(700):
        (tmp_path / f"n{k}.txt").write_text(str(k))
    monkeypatch.setattr(Rd, "READ_TASKS", 1)
    texts = Rd.read_text_dir(spark, str(tmp_path))[0]
    assert texts.count() == 700 and texts.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_a_folder_is_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    for name, data in {"a.txt": b"a", "b.TXT": b"b", "_h.txt": b"h", ".g.txt": b"g", "c.txt": b"\xff", "e.txt": b"", "z.txt.gz": b"gz", "sub/a.txt": b"sub", "_no/a.txt": b"no", "k=v/p.txt": b"part"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    at = str(tmp_path)
    docs, rejects = Rd.read_text_dir(spark, at, recursive=True)
    # The driver has no list of files: none of its plans reads them by Spark's reader of files.
    for df in (docs, rejects):
        assert "binaryFile" not in df._jdf.queryExecution().toString() and all("/listing-" in f for f in df.inputFiles())
    (tmp_path / "late.txt").write_text("after the listing")
    assert {tuple(r) for r in docs.collect()} == {("a.txt", "a"), ("sub/a.txt", "sub"), ("k=v/p.txt", "part")}
    assert [tuple(r) for r in rejects.collect()] == [("c.txt", f"file:{at}/c.txt")]
    # What Spark's own listing finds by the same pattern.
    for glob in ("*.txt", "{a,c}.t?t", "[!a]*.txt", "*.gz", "*"):
        for deep in ("false", "true"):
            own = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", deep).load(f"{at}/sub" if deep == "false" else at)
            mine = Rd._files_of(spark, f"{at}/sub" if deep == "false" else at, glob, deep == "true")
            assert {tuple(r) for r in mine.select("path", "content").collect()} == {tuple(r) for r in own.select("path", "content").collect()}
    # A pattern of folders is no folder.
    assert {r["doc_id"] for r in Rd.read_text_dir(spark, f"{at}/s*")[0].collect()} == {"a.txt"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Rd.read_text_dir(spark, f"{at}/nowhere")


def test_contents_leave_a_task_some_bytes_at_a_time(tmp_path):
    for k in range(50):
        (tmp_path / f"{k}.txt").write_bytes(bytes([k]) * 1000)
    names = pa.RecordBatch.from_pydict({"name": [f"{k}.txt" for k in range(50)]})
    out = list(files._read(iter([names]), f"file:{tmp_path}", 3000))
    assert max(b.num_rows for b in out) == 3
    assert [(r["name"], r["content"]) for b in out for r in b.to_pylist()] == [(f"{k}.txt", bytes([k]) * 1000) for k in range(50)]
