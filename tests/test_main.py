from __future__ import annotations

import json

from brute import best
from cities import CITIES

from forespell.__main__ import main


def read(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


def test_build_complete_and_table(spark, tmp_path):
    entries = tmp_path / "entries.tsv"
    entries.write_text("".join(f"{t}\t{w}\n" for t, w in CITIES) + "no weight\n")
    (tmp_path / "queries.txt").write_text("ca\nRoma\nsan\n")
    words, out, docs, bad = (str(tmp_path / n) for n in ("words", "out", "docs", "bad"))
    queries = str(tmp_path / "queries.txt")

    main(["build", str(entries), words, "--ignore-case", "--quarantine", bad])
    assert [json.loads(line)["reason"] for line in read(tmp_path / "bad")] == ["no tab"]

    main(["complete", words, queries, out, "--ignore-case", "--k", "3"])
    expected = best(CITIES, "ca", 3, False) + best(CITIES, "san", 3, False)
    assert read(tmp_path / "out") == [f"{t}  {w}" for t, w in expected]

    main(["complete", words, queries, docs, "--ignore-case", "--json"])
    lengths = sorted(len(json.loads(line)["suggestions"]) for line in read(tmp_path / "docs"))
    assert lengths == [0, 2, 5]

    main(["table", words, str(tmp_path / "table"), "--ignore-case", "--max-len", "2", "--k", "1"])
    stored = spark.read.parquet(str(tmp_path / "table"))
    assert stored.filter("prefix = 'ca'").first().completions[0].text == "Cabanene"
