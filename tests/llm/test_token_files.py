"""Plane files: exact round trips, and ids equal to the library's."""

from __future__ import annotations

import io
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from forespell.llm import queries, token_files
from forespell.llm.words import buffer

SF_DIR = "/root/testdata/sf0.001"
ODD = ["", "hello world", " a  b", "é▁x 日本", "x  y", "foo\n\n bar \n", None, "a<|endoftext|> b", "\tq", "  ", "x　y", "it's  they'll \r\n 12", "\x1c a", "tail "]


def plain(texts):
    whole = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    return [[*whole.encode(t or "", add_special_tokens=False).ids, token_files.END_ID] for t in texts]


def test_stretches_give_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(token_files, "KEEP", 3)
    encoder = token_files.Encoder(public_tokenizers.path(token_files.TOKENIZER))
    for _ in range(2):
        ids, lengths = encoder.encode(*buffer(pa.array(ODD)))
        assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == plain(ODD)


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_blocks(kind):
    ids = np.random.default_rng(2).integers(0, 1 << 32, 3 * token_files.BLOCK + 5, dtype=np.uint64).astype("<u4")
    out = io.BytesIO()
    writer = token_files.Writer(out, kind)
    for part in np.array_split(ids, 7):
        writer.add(np.array([1]), np.array([1]), np.array([len(part)]), part)
    writer.close()
    reader = token_files.Reader(out, writer.at)
    assert reader.total == len(ids) and (np.concatenate([reader.block(k) for k in range(4)]) == ids).all()
    assert (reader.block(2) == ids[2 * token_files.BLOCK : 3 * token_files.BLOCK]).all()


def test_query_against_the_library(spark):
    docs = sorted(map(tuple, queries.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()))
    want, start = [], 0
    for (doc_id, _), ids in zip(docs, plain([t for _, t in docs]), strict=True):
        want.append((doc_id, start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.op9_token_files(spark, SF_DIR).collect())) == want


def test_odd_rows(documents):
    rows = [(2, "b"), (1, None), (None, "no id"), (2, "a"), (2, "a"), (9, "word " * 200_000)]
    got = sorted(map(tuple, token_files.round_trip(documents(rows)).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 2, 2, 2, 9]
    assert got[0][1] == 0 and all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:], strict=False))
    assert token_files.round_trip(documents([])).count() == 0
