"""Stored dictionaries, the completion table, and what the physical plans look like."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from brute import best, fold, random_pairs, random_prefixes
from cities import CITIES

import forespell as fs
from forespell.plans import completion_table, topn
from forespell.session import scratch_path, shared_dir


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, entries, tmp_path):
    path = str(tmp_path / "cities")
    fs.save_dictionary(entries(CITIES), path)
    return fs.load_dictionary(spark, path)


def test_stored_dictionary(spark, entries, stored, tmp_path):
    assert sorted(map(tuple, stored.collect())) == sorted(CITIES)
    path = str(tmp_path / "folded")
    fs.save_dictionary(entries(CITIES), path, case_sensitive=False)
    folded = fs.load_dictionary(spark, path, case_sensitive=False)
    assert {(r.text, r.folded) for r in folded.collect()} == {(t, fold(t)) for t, _ in CITIES}


def test_load_or_build(spark, entries, tmp_path):
    path = str(tmp_path / "d")
    first = fs.load_or_build(spark, path, lambda: entries([("a", 1)]))
    assert first.collect() == [("a", 1)]
    again = fs.load_or_build(spark, path, lambda: entries([("b", 2)]))
    assert again.collect() == [("a", 1)]
    rebuilt = fs.load_or_build(spark, path, lambda: entries([("b", 2)]), mode="rebuild")
    assert rebuilt.collect() == [("b", 2)]
    (tmp_path / "d" / "_SUCCESS").unlink()
    # a write that never finished is not reused
    assert fs.load_or_build(spark, path, lambda: entries([("c", 3)])).collect() == [("c", 3)]
    with pytest.raises(ValueError):
        fs.load_or_build(spark, path, lambda: entries([]), mode="never")


def test_prefix_reaches_the_scan(stored):
    plan = plan_of(fs.prefix_filter(stored, "Ca").select("text"))
    assert "StringStartsWith(text,Ca)" in plan
    assert "ReadSchema: struct<text:string>" in plan


def test_folded_prefix_reaches_the_scan(spark, entries, tmp_path):
    path = str(tmp_path / "folded")
    fs.save_dictionary(entries(CITIES), path, case_sensitive=False)
    found = fs.complete(fs.load_dictionary(spark, path, False), "CA", 3, case_sensitive=False)
    assert "StringStartsWith(folded,ca)" in plan_of(found)


def test_one_lookup_keeps_k_rows_per_partition(stored):
    plan = plan_of(fs.complete(stored, "C", 5))
    assert "TakeOrderedAndProject" in plan
    assert "Exchange hashpartitioning" not in plan


def test_batch_filters_before_any_shuffle_of_the_dictionary(spark, stored):
    plan = plan_of(fs.complete_batch(stored, fs.queries_from(spark, ["C", "San"])))
    assert "BroadcastHashJoin" in plan and "Inner, BuildRight" in plan
    assert plan.count("WindowGroupLimit") == 2
    for forbidden in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "Python"):
        assert forbidden not in plan


def test_many_queries_meet_the_reduced_dictionary(spark, stored, shuffled):
    plan = plan_of(fs.complete_batch(stored, fs.queries_from(spark, ["C", "San"])))
    assert plan.count("WindowGroupLimit") == 2
    assert "SortMergeJoin" in plan
    for forbidden in ("BroadcastNestedLoopJoin", "CartesianProduct"):
        assert forbidden not in plan
    # the reduction and the join share one exchange of the dictionary
    joined = plan[plan.index("SortMergeJoin [prefix") :]
    assert joined.index("Window [") < joined.index("Exchange hashpartitioning(prefix")


def test_completion_table_packs_on_the_exchange_of_the_ranking(stored):
    plan = plan_of(fs.build_completion_table(stored, 3, 2))
    # one exchange to drop what is in no list, one to rank the survivors
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("method", ["explode", "rollup"])
@pytest.mark.parametrize("case_sensitive", [True, False])
def test_completion_table(entries, method, case_sensitive):
    pairs = random_pairs(8, 200, "abA", 4, 6)
    table = fs.build_completion_table(entries(pairs), 3, 4, case_sensitive, method).collect()
    key = (lambda t: t) if case_sensitive else fold
    prefixes = {key(t)[:n] for t, _ in pairs for n in range(4) if n <= len(t)}
    assert {r.prefix for r in table} == prefixes
    for row in table:
        assert [tuple(e) for e in row.completions] == best(pairs, row.prefix, 4, case_sensitive)


@pytest.mark.parametrize("case_sensitive", [True, False])
def test_long_completion_table_is_cut_in_steps(entries, monkeypatch, case_sensitive):
    monkeypatch.setattr(completion_table, "LENGTHS_PER_CUT", 2)
    pairs = random_pairs(9, 300, "abA", 4, 8)
    rolled = fs.completion_rows(entries(pairs), 7, 3, case_sensitive)
    exploded = fs.completion_rows(entries(pairs), 7, 3, case_sensitive, method="explode")
    rows = sorted(map(tuple, exploded.collect()))
    assert sorted(map(tuple, rolled.collect())) == rows
    packed = fs.build_completion_table(entries(pairs), 7, 3, case_sensitive)
    unpacked = [(r.prefix, i, *e) for r in packed.collect() for i, e in enumerate(r.completions, 1)]
    assert sorted(unpacked) == rows


def test_completion_table_arguments(entries):
    with pytest.raises(ValueError):
        fs.completion_rows(entries(CITIES), 3, 0)
    with pytest.raises(ValueError):
        fs.completion_rows(entries(CITIES), -1, 3)
    with pytest.raises(ValueError):
        fs.completion_rows(entries(CITIES), 1, 3, method="both")


def test_stored_completion_table_is_pruned_by_length(spark, entries, tmp_path):
    path = str(tmp_path / "table")
    fs.save_completion_table(fs.build_completion_table(entries(CITIES), 4, 3), path)
    table = fs.load_completion_table(spark, path)
    one = table.filter("prefix_length = 2 AND prefix = 'Ca'")
    plan = plan_of(one)
    assert "PartitionFilters: [isnotnull(prefix_length" in plan and "EqualTo(prefix,Ca)" in plan
    assert [tuple(e) for e in one.first().completions] == best(CITIES, "Ca", 3)
    assert table.count() == fs.build_completion_table(entries(CITIES), 4, 3).count()


def session_like(master, **conf):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder():
    named = session_like("yarn", **{"spark.checkpoint.dir": "hdfs:///shared"})
    assert shared_dir(named) == "hdfs:///shared"
    assert scratch_path(named, "x").startswith("hdfs:///shared/x-")
    # a temporary folder stands in on one machine only
    assert shared_dir(session_like("local[2]")) == shared_dir(session_like("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session_like("yarn"))


@pytest.mark.parametrize("seed", range(2))
def test_table_answers_like_the_batch(spark, entries, seed):
    pairs = random_pairs(seed + 20, 150, "abc", 5, 6)
    table = {r.prefix: r.completions for r in fs.build_completion_table(entries(pairs), 6, 3).collect()}
    for prefix in random_prefixes(seed, 20):
        assert [tuple(e) for e in table.get(prefix, [])] == best(pairs, prefix, 3)


def test_a_plain_dictionary_read_without_case(spark, entries, tmp_path):
    path = str(tmp_path / "plain")
    fs.save_dictionary(entries([("Aa", 3), ("ab", 2), ("b", 1)]), path)
    found = fs.complete(fs.load_dictionary(spark, path, case_sensitive=False), "A", 5, False)
    assert [(r.text, r.weight) for r in found.collect()] == [("Aa", 3), ("ab", 2)]
    reused = fs.load_or_build(spark, path, lambda: entries([]), case_sensitive=False)
    assert fs.complete(reused, "A", 5, False).count() == 2


def test_weights_beyond_a_bigint(spark, tmp_path):
    heavy = 2**63 + 5
    rows = spark.createDataFrame([("aa", str(heavy)), ("ab", "1")], "text STRING, weight STRING")
    fs.save_dictionary(rows.withColumn("weight", rows.weight.cast("decimal(20,0)")), str(tmp_path / "d"))
    stored = fs.load_dictionary(spark, str(tmp_path / "d"))
    assert [int(r.weight) for r in fs.complete(stored, "a", 5).collect()] == [heavy, 1]
    fs.save_completion_table(fs.build_completion_table(stored, 1, 5), str(tmp_path / "t"))
    table = fs.load_completion_table(spark, str(tmp_path / "t"))
    assert [int(e.weight) for e in table.filter("prefix = 'a'").first().completions] == [heavy, 1]
    asked = spark.createDataFrame([(1, "a", 2)], "qid INT, q STRING, k INT")
    assert [int(r.weight) for r in fs.complete_batch(stored, asked).orderBy("rank").collect()] == [heavy, 1]


def test_a_shorter_table_replaces_a_longer_one(spark, entries, tmp_path):
    path = str(tmp_path / "table")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for max_len in (3, 1):
            fs.save_completion_table(fs.build_completion_table(entries(CITIES), max_len, 2), path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert fs.load_completion_table(spark, path).agg({"prefix_length": "max"}).first()[0] == 1


def test_merge_tree_bounds_every_task():
    for n in (100, 1_000, 2_000, 50_000):
        parts = topn.INPUT_PARTITIONS
        for level in [*topn.merge_tree(n), 1]:
            assert -(-parts // level) * n <= topn.ROWS_PER_TASK + n
            parts = level


def test_a_small_batch_prunes_the_stored_dictionary(spark, entries, tmp_path):
    rows = [(f"w{i:05d}", i) for i in range(20_000)]
    fs.save_dictionary(entries(rows), str(tmp_path / "d"))
    stored = fs.load_dictionary(spark, str(tmp_path / "d"))
    found = fs.complete_batch(stored, fs.queries_from(spark, ["w001", "w1", "w0012"], 2))
    plan = plan_of(found)
    pushed = plan[plan.index("PushedFilters") :].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(text,w001)" in pushed and "Or(LessThan(text,w),StringStartsWith(text,w))" in pushed
    assert 'StartsWith(text#' in plan and "w0012)" in plan
    assert sorted((r.qid, r.text) for r in found.collect()) == sorted(
        (i, t) for i, q in enumerate(["w001", "w1", "w0012"]) for t, _ in best(rows, q, 2)
    )
    counts = dict(map(tuple, fs.match_counts(stored, fs.queries_from(spark, ["", "w1", "zz"])).collect()))
    assert counts == {0: 20_000, 1: 10_000, 2: 0}
