"""Multi-line records read by many tasks, against the reader that takes a file in one."""

import os
import random

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from quire.sinks.writers import CSV_OPTIONS
from quire.sources import readers as Rd
from quire.sources.records import read_records, record_lines

SCHEMA = StructType([StructField("a", StringType()), StructField("b", StringType()), StructField("c", StringType())])


def written(folder, seed, files=2, end="\n"):
    rng = random.Random(seed)
    os.makedirs(folder)
    for f in range(files):
        with open(f"{folder}/part-{f}.csv", "w", newline="", encoding="utf-8") as out:
            out.write("a,b,c" + end)
            for k in range(400):
                row = []
                for _ in range(3):
                    v = "".join(rng.choice(["x", "é", " ", '"', ",", "\n", "\n\n", "word "]) for _ in range(rng.randint(0, 12)))
                    row.append('"' + v.replace('"', '""') + '"' if rng.random() < 0.3 or any(c in v for c in '",\n') else v)
                out.write(",".join([f"{f}-{k}", *row[1:]]) + end)
                if rng.random() < 0.05:
                    out.write(end)
    return folder


@pytest.fixture
def small_splits(spark):
    known = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}
    yield lambda size: [spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", "0"), spark.conf.set("spark.sql.files.minPartitionNum", "64")]
    for k, v in known.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("size", [300, 2000, 1 << 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_many_tasks_read_what_one_reads(spark, tmp_path, small_splits, size, seed):
    folder = written(str(tmp_path / "in"), seed)
    want = spark.read.schema(SCHEMA).options(**CSV_OPTIONS).option("multiLine", True).csv(folder).collect()
    small_splits(size)
    df = read_records(spark, folder, SCHEMA)
    assert sorted(map(repr, df.collect())) == sorted(map(repr, want)) and len(want) == 800
    if size == 300:
        lines = record_lines(spark, folder)
        assert lines.select("file", "block").distinct().count() > 20
        assert lines.where("not whole").count() > 100


def test_one_field_over_many_splits(spark, tmp_path, small_splits):
    os.makedirs(tmp_path / "in")
    long = "line, with \"quotes\"\n" * 500
    (tmp_path / "in" / "q.tsv").write_text('Query number\tQuery\n1\t"' + long.replace('"', '""') + '"\n2\tshort\n3\t""\n4\t\n', encoding="utf-8")
    small_splits(500)
    got = {r["query_id"]: r["query_text"] for r in Rd.read_queries_tsv(spark, str(tmp_path / "in")).collect()}
    one = spark.read.schema(Rd.QUERY_TSV).options(**CSV_OPTIONS).option("sep", "\t").option("multiLine", True).csv(str(tmp_path / "in"))
    assert got == {r[0]: r[1] for r in one.collect()} and got["1"] == long


def test_line_ends_with_carriage_returns_and_empty_files(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.csv").write_bytes(b'a,b,c\r\n1,"x\ny",z\r\n\r\n2,"p ""q""",\r\n')
    (tmp_path / "in" / "b.csv").write_bytes(b"")
    (tmp_path / "in" / "c.csv").write_bytes(b"a,b,c")
    got = sorted(map(tuple, read_records(spark, str(tmp_path / "in"), SCHEMA).collect()))
    assert got == [("1", "x\ny", "z"), ("2", 'p "q"', None)]
    assert read_records(spark, str(tmp_path / "in" / "b.csv"), SCHEMA).count() == 0
