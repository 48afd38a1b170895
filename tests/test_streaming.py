from __future__ import annotations

import json

import pytest
from brute import best
from cities import CITIES
from pyspark.sql import functions as F
from test_plans import plan_of

import forespell as fs

ASKED = ["C", "San", "Ro", "", "C", "castelvarro", "xyz"]


@pytest.fixture
def lines(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.txt").write_text("\n".join(ASKED[:3]) + "\n")
    (folder / "2.txt").write_text("\n".join(ASKED[3:]) + "\n")
    return str(folder)


def run(writer, state):
    query = writer.option("checkpointLocation", str(state)).trigger(availableNow=True)
    query.start().awaitTermination()


@pytest.mark.parametrize("case_sensitive", [True, False])
def test_stream_against_the_table(spark, entries, lines, tmp_path, case_sensitive):
    built = str(tmp_path / "table")
    fs.save_completion_table(fs.build_completion_table(entries(CITIES), 3, 5, case_sensitive), built)
    asked = fs.stream_queries(spark, lines, 3).filter(F.length("q") <= 3)
    answered = fs.complete_stream(
        asked, fs.load_completion_table(spark, built), 3, F.col("k"), case_sensitive
    )
    out = str(tmp_path / "out")
    run(answered.writeStream.format("parquet").option("path", out), tmp_path / "state")
    rows = spark.read.schema(answered.schema).parquet(out).collect()
    assert sorted(r.q for r in rows) == sorted(q for q in ASKED if len(q) <= 3)
    for row in rows:
        assert [tuple(e) for e in row.completions] == best(CITIES, row.q, 3, case_sensitive)


def test_a_table_knows_its_bounds(spark, entries, tmp_path):
    fs.save_completion_table(fs.build_completion_table(entries(CITIES), 2, 3), str(tmp_path / "table"))
    table = fs.load_completion_table(spark, str(tmp_path / "table"))
    asked = spark.createDataFrame([(1, "C", 3), (2, None, 2)], "qid INT, q STRING, k INT")
    for more in ({"k": 4}, {"max_len": 3}):
        with pytest.raises(ValueError):
            fs.complete_stream(asked, table, **more)
    found = {r.qid: [tuple(e) for e in r.completions] for r in fs.complete_stream(asked, table, k=F.col("k")).collect()}
    assert found == {1: best(CITIES, "C", 3), 2: best(CITIES, "", 2)}
    for q, k in (("Cas", 1), ("C", 4)):
        with pytest.raises(Exception, match="the table"):
            fs.complete_stream(spark.createDataFrame([(1, q, k)], asked.schema), table, k=F.col("k")).collect()


@pytest.mark.parametrize("as_json", [False, True])
@pytest.mark.parametrize("case_sensitive", [True, False])
def test_table_and_dictionary_answer_the_whole_stream(spark, entries, lines, tmp_path, case_sensitive, as_json):
    table = fs.build_completion_table(entries(CITIES), 2, 5, case_sensitive)
    asked = fs.stream_queries(spark, lines, 2).withColumn("qid", F.xxhash64("q")).dropDuplicates(["qid"])
    out = str(tmp_path / "out")
    writer = fs.complete_stream_batch(
        asked, entries(CITIES), out, case_sensitive, table=table, keep_unmatched=True, as_json=as_json
    )
    run(writer, tmp_path / "state")
    rows = spark.read.parquet(out).collect()
    names = {r.qid: r.q for r in spark.createDataFrame([(q,) for q in ASKED], "q STRING").select(F.xxhash64("q").alias("qid"), "q").collect()}
    if as_json:
        got = {names[r.qid]: [s["value"] for s in json.loads(r.json)["suggestions"]][:2] for r in rows}
        assert got == {q: [t for t, _ in best(CITIES, q, 2, case_sensitive)] for q in ASKED}
    else:
        got = {(names[r.qid], r.rank, r.text, r.weight) for r in rows}
        want = {(q, i, *e) for q in ASKED for i, e in enumerate(best(CITIES, q, 2, case_sensitive), 1)}
        assert got == want | {(q, None, None, None) for q in ASKED if not best(CITIES, q, 2, case_sensitive)}


def test_stream_against_the_dictionary(spark, entries, lines, tmp_path):
    asked = fs.stream_queries(spark, lines, 2).withColumn("qid", F.xxhash64("q"))
    out = str(tmp_path / "out")
    asked = asked.filter("q != 'C'").unionByName(asked.filter("q = 'C'").withColumn("qid", F.lit(0).cast("bigint")).dropDuplicates(["qid"]))
    run(fs.complete_stream_batch(asked, entries(CITIES), out, case_sensitive=False), tmp_path / "state")
    rows = [(r["rank"], r["text"], r["weight"]) for r in spark.read.parquet(out).collect()]
    want = [(i, *e) for q in set(ASKED) for i, e in enumerate(best(CITIES, q, 2, False), 1)]
    assert sorted(rows) == sorted(want)


def test_a_repeated_micro_batch_is_stored_once(spark, entries, lines, tmp_path):
    asked = fs.stream_queries(spark, lines, 2).withColumn("qid", F.xxhash64("q"))
    out = str(tmp_path / "out")
    counts = []
    for attempt in (1, 2):
        # a new state folder replays the same batch numbers over the same files
        run(fs.complete_stream_batch(asked, entries(CITIES), out), tmp_path / f"state{attempt}")
        counts.append(spark.read.parquet(out).count())
    assert counts[0] == counts[1] > 0


@pytest.fixture
def stored_table(spark, entries, tmp_path):
    path = str(tmp_path / "table")
    fs.save_completion_table(fs.build_completion_table(entries(CITIES), 4, 5), path)
    return fs.load_completion_table(spark, path)


def test_a_micro_batch_reads_its_part_of_the_stored_table(spark, stored_table):
    asked = spark.createDataFrame([(1, "Ca", 2), (2, "San", 3), (3, "Ca", 1), (4, "zz", 2)], "qid LONG, q STRING, k INT")
    found = fs.complete_from_table(asked, stored_table, keep_unmatched=True)
    plan = plan_of(found)
    scan = next(line for line in plan.splitlines() if "PartitionFilters: [" in line and "prefix_length" in line)
    assert "prefix_length#" in scan.split("PartitionFilters: [")[1].split("]")[0] and "IN (2,3)" in scan
    pushed = scan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(prefix,Ca)" in pushed  # the plan's text is cut, the condition below is not
    assert "IN (Ca,San,zz)" in plan and "BroadcastHashJoin [prefix" in plan
    got = sorted(((r.qid, r["rank"] or 0, r.text) for r in found.collect()), key=repr)
    want = [(i, n, t) for i, q, k in ((1, "Ca", 2), (2, "San", 3), (3, "Ca", 1)) for n, (t, _) in enumerate(best(CITIES, q, k), 1)]
    assert got == sorted([*want, (4, 0, None)], key=repr)


def test_a_prefix_in_most_rows_is_spread(spark, stored_table):
    asked = spark.range(3_000).select(F.col("id").alias("qid"), F.when(F.col("id") % 10 == 0, "San").otherwise("C").alias("q"), F.lit(2).alias("k"))
    found = fs.complete_from_table(asked, stored_table, hot_copies=100)
    assert "_salt" in plan_of(found)
    rows = found.groupBy("text").count().collect()
    want = {t: 2_700 for t, _ in best(CITIES, "C", 2)} | {t: 300 for t, _ in best(CITIES, "San", 2)}
    assert {r.text: r["count"] for r in rows} == want


def test_a_stream_from_the_table_alone_loses_no_query(spark, entries, tmp_path, stored_table):
    folder = tmp_path / "asked"
    spark.createDataFrame([(1, "C", None), (2, None, 2), (3, "zzz", None)], "qid LONG, q STRING, k INT").write.parquet(str(folder))
    stream = spark.readStream.schema("qid LONG, q STRING, k INT").parquet(str(folder))
    out = str(tmp_path / "out")
    table = fs.build_completion_table(entries(CITIES), 3, 10)
    run(fs.complete_stream_batch(stream, None, out, table=table, keep_unmatched=True), tmp_path / "state")
    got = {(r.qid, r["rank"], r.text) for r in spark.read.parquet(out).collect()}
    want = {(i, n, t) for i, q, k in ((1, "C", 10), (2, "", 2)) for n, (t, _) in enumerate(best(CITIES, q, k), 1)}
    assert got == want | {(3, None, None)}
    with pytest.raises(Exception, match="a query asks for more"):
        run(fs.complete_stream_batch(stream, None, str(tmp_path / "o2"), table=stored_table), tmp_path / "state2")
    with pytest.raises(ValueError):
        fs.complete_stream_batch(stream, None, out)
