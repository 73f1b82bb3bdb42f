"""Codec, file sources/sinks and containment judgements."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from quire.operators import codec as C
from quire.operators.containment import contained_pairs
from quire.sinks import writers as Wr
from quire.sinks.files import write_text_files
from quire.sources import readers as Rd


def test_decode_edge_cases(spark):
    enc = spark.createDataFrame(
        [("w", "a:b.txt:0.5, abc, d:x, e.txt:0.250000"), ("null", "n.txt:1.0")], "word string, documents string"
    )
    got = sorted(map(tuple, C.decode_postings(enc).collect()))
    assert got == [("null", 1, "n.txt", 1.0), ("w", 1, "a:b.txt", 0.5), ("w", 2, "e.txt", 0.25)]


def test_encode_decode_round_trip(spark):
    champs = spark.createDataFrame(
        [("t", 1, 5, 0.5), ("t", 2, 3, 0.25), ("u", 1, 3, 0.000001)], "term string, rank int, doc_id long, tf double"
    )
    enc = C.encode_postings(champs).orderBy("word").collect()
    assert enc[0]["documents"] == "5:0.5, 3:0.25" and enc[1]["documents"] == "3:1e-06"
    back = sorted(map(tuple, C.decode_postings(C.encode_postings(champs)).collect()))
    assert back == [("t", 1, "5", 0.5), ("t", 2, "3", 0.25), ("u", 1, "3", 0.000001)]


def test_full_text_of_doubles(spark):
    values = [1.0, 0.5, 0.0125, 0.001, 0.00123, 0.0001, 0.000123, 0.00001, 0.000012, 1e-06, 0.30000000000000004, 12.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(C.full_text("x")).collect()] == [str(v) for v in values]


NAMES = ['a"b.txt', "c,d.txt", "e\\f.txt", "g:h.txt", 'i"",j.txt', "k l.txt"]


def test_index_csv_keeps_odd_names_and_searches_alike(spark):
    from quire.operators import index as I
    from quire.operators import retrieve as R
    from quire.operators.analysis import analyze

    docs = spark.createDataFrame([(n, "alpha beta " + "gamma " * k) for k, n in enumerate(NAMES)], "doc_id string, text string")
    counts = I.term_counts(analyze(docs, "doc_id"))
    champs = I.champions(I.term_frequencies(counts))
    d = tempfile.mkdtemp(prefix="quire-test-")
    Wr.write_index_csv(C.encode_postings(champs), d + "/index")
    idx = Rd.index_from_csv(spark, d + "/index")
    cols = ["term", "rank", "doc_id", "tf"]
    assert sorted(map(tuple, idx.postings.select(*cols).collect())) == sorted(map(tuple, champs.select(*cols).collect()))
    q = spark.createDataFrame([(1, "gamma"), (2, "alpha gamma")], "query_id long, query_text string")
    assert sorted(map(tuple, R.search(idx, q).collect())) == sorted(map(tuple, R.search(I.build_index(analyze(docs, "doc_id")), q).collect()))


def test_index_csv_written_by_a_standard_writer(spark):
    import csv

    d = tempfile.mkdtemp(prefix="quire-test-")
    rows = [("w", ", ".join(f"{n}:0.25" for n in NAMES[:1] + NAMES[2:4])), ("x", "broken, y.txt:z, ok.txt:0.5")]
    with open(d + "/i.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([("Word", "Documents"), *rows])
    got = sorted(map(tuple, C.decode_postings(Rd.read_index_csv(spark, d + "/i.csv")).collect()))
    assert got == [("w", 1, NAMES[0], 0.25), ("w", 2, NAMES[2], 0.25), ("w", 3, NAMES[3], 0.25), ("x", 1, "ok.txt", 0.5)]


def test_partial_csvs_unite_and_add_up(spark):
    from quire.operators import index as I

    a = spark.createDataFrame([(0, "t", "d1", 0.25), (0, "t", "d2", 0.5), (1, "u", "d1", 0.125)], "batch int, term string, doc_id string, tf double")
    b = spark.createDataFrame([(0, "t", "d1", 0.5)], "batch int, term string, doc_id string, tf double")
    d = tempfile.mkdtemp(prefix="quire-test-")
    for name, part in (("a", a), ("b", b)):
        Wr.write_partials_csv(C.encode_partials(part, "batch"), f"{d}/{name}", "batch")
    merged = I.merge_indexes([Rd.read_partials_csv(spark, f"{d}/{name}") for name in "ab"])
    assert sorted(map(tuple, merged.collect())) == [("t", 1, "d1", 0.75), ("t", 2, "d2", 0.5), ("u", 1, "d1", 0.125)]


def test_recursive_scan_keeps_equal_names_apart(spark):
    d = tempfile.mkdtemp(prefix="quire-test-")
    for folder in ("x", "y"):
        os.makedirs(f"{d}/{folder}")
        with open(f"{d}/{folder}/same.txt", "w") as f:
            f.write(folder)
    docs, _ = Rd.read_text_dir(spark, d, recursive=True)
    assert sorted(map(tuple, docs.collect())) == [("x/same.txt", "x"), ("y/same.txt", "y")]


def test_text_dir_with_bad_utf8_and_empty_file(spark):
    d = tempfile.mkdtemp(prefix="quire-test-")
    with open(os.path.join(d, "good.txt"), "w", encoding="utf-8") as f:
        f.write("Hello wörld")
    with open(os.path.join(d, "bad.txt"), "wb") as f:
        f.write(bytes([0x62, 0x61, 0x64, 0x20, 0xFF, 0xFE]))
    open(os.path.join(d, "empty.txt"), "w").close()
    with open(os.path.join(d, "skip.TXT"), "w") as f:
        f.write("not matched")
    docs, rejects = Rd.read_text_dir(spark, d)
    assert [tuple(r) for r in docs.collect()] == [("good.txt", "Hello wörld")]
    assert [r["doc_id"] for r in rejects.collect()] == ["bad.txt"]


def test_file_writer_and_tsv_round_trip(spark):
    d = tempfile.mkdtemp(prefix="quire-test-")
    df = spark.createDataFrame([(1, "one\ttab\nline"), (2, " padded ")], "query_id long, query_text string")
    assert write_text_files(df.withColumn("n", F.concat(F.col("query_id").cast("string"), F.lit(".txt"))), d + "/files", "n", "query_text").count() == 2
    assert open(d + "/files/1.txt", encoding="utf-8").read() == "one\ttab\nline"
    Wr.write_queries_tsv(df, d + "/q.tsv")
    back = sorted(map(tuple, Rd.read_queries_tsv(spark, d + "/q.tsv").collect()))
    assert back == [("1", "one\ttab\nline"), ("2", " padded ")]


def test_results_csv_keeps_rank_order(spark):
    d = tempfile.mkdtemp(prefix="quire-test-")
    res = spark.createDataFrame(
        [(q, r, f"output_{(q * 7 + r * 3) % 50}.txt") for q in range(1, 30) for r in range(1, 11)],
        "query_id long, rank int, doc_name string",
    )
    Wr.write_results_csv(res, d + "/r")
    back = Rd.read_results_csv(spark, d + "/r")
    exp = sorted((str(q), r, n) for q, r, n in res.collect())
    assert sorted(map(tuple, back.collect())) == exp


def test_contained_pairs_brute_force(spark):
    rng = random.Random(3)
    alphabet = "ab cdé\n"
    docs = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300)))) for i in range(60)]
    passages = []
    for j in range(25):
        d = docs[rng.randrange(len(docs))][1]
        if rng.random() < 0.8 and len(d) > 2:
            a = rng.randrange(len(d))
            b = min(len(d), a + rng.choice([1, 3, 10, 40, 90]))
            passages.append((j, d[a:b]))
        else:
            passages.append((j, "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))))
    passages.append((99, ""))
    ddf = spark.createDataFrame(docs, "doc_id long, text string")
    pdf = spark.createDataFrame(passages, "item_id long, text string")
    got = sorted(map(tuple, contained_pairs(ddf, pdf).collect()))
    exp = sorted((j, i) for j, p in passages if p for i, t in docs if p in t)
    assert got == exp


def test_write_processed_parquet_and_text(spark):
    from quire.operators.analysis import analyze

    d = tempfile.mkdtemp(prefix="quire-test-")
    df = spark.createDataFrame([(1, "Hello brave new world"), (2, "the of and")], "doc_id long, text string")
    p = analyze(df, "doc_id")
    Wr.write_processed(p, d + "/pq")
    got = [tuple(r) for r in spark.read.parquet(d + "/pq").collect()]
    assert got == [(1, "hello brave new world", 4)]
    named = p.withColumn("name", F.concat(F.lit("p"), F.col("doc_id").cast("string"), F.lit(".txt")))
    assert Wr.write_processed_files(named, d + "/txt", "name").count() == 1
    assert open(d + "/txt/p1.txt").read() == "hello brave new world"


def test_partial_lists_stay_bounded_however_many_documents_a_word_is_in(spark):
    from quire.operators import codec, index
    from quire.plans import catalog
    from quire.plans import pipeline

    docs = spark.range(1000).selectExpr("id AS doc_id", "'common words everywhere' AS text", "'en' AS lang")
    part = index.partial_indexes(pipeline.analyze(catalog._in_batches(docs, 100), "doc_id", "text", carry=["batch"]), "batch")
    lists = [r["documents"].count(":") for r in codec.encode_partials(part, "batch").where("word = 'common'").collect()]
    assert len(lists) == 10 and sum(lists) == 1000 and max(lists) < 200


def test_partials_are_shuffled_once_to_be_written_and_once_as_lists_to_be_merged(spark, tmp_path):
    from quire.operators import index as I

    rows = [(d % 3, w, d, (d % 7 + 1) / 8) for d in range(60) for w in ["hot", f"w{d % 11}", "null"]]
    body = spark.createDataFrame(rows, "batch int, term string, doc_id long, tf double")
    head = body.where("doc_id % 2 = 0").selectExpr("batch", "term", "doc_id", "tf / 4 AS tf")
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    frames = []
    for name, part in (("body", body), ("head", head)):
        encoded = C.encode_partials(part, "batch")
        assert exchanges(encoded) == 1
        Wr.write_partials_csv(encoded, f"{tmp_path}/{name}", "batch")
        for b in range(3):
            found = [f for f in os.listdir(f"{tmp_path}/{name}/batch={b}") if f.endswith(".csv")]
            assert 0 < len(found) <= C.PARTS
            for f in found:  # every file is sorted by word and has each word once
                words = [line.split(",")[0] for line in open(f"{tmp_path}/{name}/batch={b}/{f}").read().splitlines()[1:]]
                assert words == sorted(set(words))
        lists = Rd.read_index_csv(spark, f"{tmp_path}/{name}")
        assert lists.groupBy("batch", "word").count().where("count > 1").count() == 0
        frames.append(Rd.read_partials_csv(spark, f"{tmp_path}/{name}", "batch").withColumn("doc_id", F.col("doc_id").cast("long")))
    merged = I.merge_indexes(frames, 5, decimals=6, batch="batch")
    # The lists of both frames by (word, batch), and the champions by term: no row a posting by (term, document).
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert exchanges(merged) == 3 and "hashpartitioning(term" in plan and "hashpartitioning(word" in plan
    want = I.merge_indexes([body, head], 5, decimals=6)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, want.collect())) != []


def test_text_of_partials_keeps_order_signs_and_nulls(spark):
    rows = [(0, "t", k, v) for k, v in [(3, 0.25), (1, 0.25), (2, 0.5), (None, 0.5), (4, 0.0), (5, -0.5), (6, None), (7, 1e13), (8, 0.1234565)]]
    df = spark.createDataFrame(rows, "batch int, term string, doc_id long, tf double")
    items = F.array_sort(F.collect_list(F.struct((-F.col("tf")).alias("o"), F.col("doc_id").alias("k"), F.concat(F.col("doc_id").cast("string"), F.lit(":"), C.six_decimals("tf")).alias("item"))))
    want = df.groupBy("batch", F.col("term").alias("word")).agg(F.array_join(F.transform(items, lambda s: s["item"]), C.ITEM_SEP).alias("documents"))
    assert C.encode_partials(df, "batch").collect() == want.collect()


def test_counts_evaluate_the_analysis_once(spark):
    from quire.operators import index as I
    from quire.operators.analysis import analyze

    docs = spark.createDataFrame([(1, "alpha beta alpha")], "doc_id long, text string").repartition(2)
    plan = I.term_counts(analyze(docs, "doc_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(") == 1
