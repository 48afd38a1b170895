from __future__ import annotations

import gzip

import pytest

import forespell as fs

LINES = [
    ("Rovove\t89839", ("Rovove", 89839), None),
    ("Cava de' Tirreni\t53520", ("Cava de' Tirreni", 53520), None),
    ('say "x\\\t7', ('say "x\\', 7), None),
    ("crlf\t1\r", ("crlf", 1), None),
    ("blank before\t 12", ("blank before", 12), None),
    ("\t3", ("", 3), None),
    ("no tab here", None, "no tab"),
    ("x\t", None, "weight is not a whole number"),
    ("x\t12abc", None, "weight is not a whole number"),
    ("x\t-1", None, "weight is not a whole number"),
    ("x\t1.5", None, "weight is not a whole number"),
    ("x\ty\t5", None, "weight is not a whole number"),
    ("x\t18446744073709551615", None, "weight out of range"),
    ("", None, "blank line"),
    ("\r", None, "blank line"),
    ("nul\0nul\t4", None, "NUL in text"),
]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(line,) for line, _, _ in LINES], "line STRING")


def test_every_line_is_kept_or_quarantined(lines):
    good, bad = fs.split_valid(lines)
    assert sorted(map(tuple, good.collect())) == sorted(pair for _, pair, _ in LINES if pair)
    assert sorted(map(tuple, bad.collect())) == sorted((line, why) for line, _, why in LINES if why)


def test_lenient_and_unsigned_weights(lines):
    good, _ = fs.split_valid(lines, weight_type="decimal(20,0)", trailing="ignore")
    weights = {(r.text, int(r.weight)) for r in good.collect()}
    assert ("x", 12) in weights and ("x", 1) in weights and ("x", 18446744073709551615) in weights


def test_read_plain_and_gzip(spark, tmp_path):
    body = "b\t2\r\na\t1\nbad\n".encode()
    (tmp_path / "plain.tsv").write_bytes(body)
    (tmp_path / "packed.tsv.gz").write_bytes(gzip.compress(body))
    for name in ("plain.tsv", "packed.tsv.gz"):
        rows = fs.read_weighted_strings(spark, str(tmp_path / name), "skip", partitions=3).collect()
        assert sorted(map(tuple, rows)) == [("a", 1), ("b", 2)]


def test_bad_line_can_stop_the_job(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("a\t1\nbad\n")
    with pytest.raises(Exception, match="no tab: bad"):
        fs.read_weighted_strings(spark, str(tmp_path / "d.tsv")).collect()
    (tmp_path / "e.tsv").write_text("a\t1\n")
    assert fs.read_weighted_strings(spark, str(tmp_path / "e.tsv"), on_bad="fail").collect() == [("a", 1)]


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        fs.read_weighted_strings(spark, str(tmp_path / "nowhere.tsv"))


def test_query_lines(spark, tmp_path):
    (tmp_path / "q.txt").write_text("Ro\n\nC\n")
    rows = fs.read_queries(spark, str(tmp_path / "q.txt")).collect()
    assert sorted((r.q, r.k) for r in rows) == [("", 5), ("C", 5), ("Ro", 5)]
    assert len({r.qid for r in rows}) == 3


def test_query_defaults_and_refusals(spark):
    asked = [(1, "a", 3), (2, None, 2), (3, "b", None), (4, "c", 0), (5, "d", -1), (6, "", 1)]
    asked = spark.createDataFrame(asked, "qid BIGINT, q STRING, k INT")
    good, bad = fs.split_queries(asked)
    assert sorted(map(tuple, good.collect())) == [(1, "a", 3), (2, "", 2), (3, "b", 10), (6, "", 1)]
    assert sorted((r.qid, r.reason) for r in bad.collect()) == [(4, "k below 1"), (5, "k below 1")]
    long_enough = fs.normalise_queries(asked, min_chars=1)
    assert sorted(r.qid for r in long_enough.collect()) == [1, 3]


def test_pairs_from_tables(spark):
    rows = [("a", 1), ("a", 5), (None, 2), ("b", None), ("c", -4), ("d\0", 1)]
    df = spark.createDataFrame(rows, "text STRING, weight BIGINT")
    good, bad = fs.split_pairs(df)
    assert sorted(map(tuple, good.collect())) == [("a", 1), ("a", 5)]
    assert {r.reason for r in bad.collect()} == {"null text", "null weight", "negative weight", "NUL in text"}
    assert fs.dictionary_from(df, "text", "weight", "sum", on_bad="skip").collect() == [("a", 6)]
    counted = fs.dictionary_from(df, "text", on_bad="skip").collect()
    assert sorted(map(tuple, counted)) == [("a", 2), ("b", 1), ("c", 1)]
    for weight in (None, "weight"):
        with pytest.raises(Exception, match="not an entry"):
            fs.dictionary_from(df, "text", weight).collect()


def test_word_dictionary_takes_the_separator_literally(spark):
    df = spark.createDataFrame([("a.b..a",), (None,)], "t STRING")
    assert sorted(map(tuple, fs.word_dictionary(df, "t", ".").collect())) == [("a", 2), ("b", 1)]
