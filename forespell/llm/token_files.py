"""Token ids in bit- or byte-plane files.

A file holds the ids of many documents, one after another, in blocks of ``BLOCK`` ids.
A block is an array of 32-bit numbers; transposed, plane k is byte k (or bit k) of every
id. Planes are compressed with zstandard one by one: the upper planes of ids are nearly
constant. After the blocks come the documents' ids and lengths and the chunk index, and
at the end a fixed trailer that says where those are:

    block: planes | documents: two int64 arrays | index: int64 rows | trailer (TRAILER)

An index row is (position, number of ids, sizes of the planes). A reader needs the last
bytes of the file, then any block alone.

Documents are written in ascending doc_id (null first; rows with equal ids by the hash of
their text); null and empty texts have only the end id. Extra columns are left aside; an
empty table makes no files and an empty result. Texts of any length are encoded whole;
one task holds a slice of texts and a block of ids.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forespell.llm.components import written
from forespell.llm.shared_files import attempt_path, open_fs
from forespell.llm.words import slices, span_hashes
from forespell.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BLOCK = 1 << 16
TRAILER = struct.Struct("<8sqqqqqq")
MAGIC = b"IDPLANE1"
SLICE = 1 << 20
KEEP = 400_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CONTROL = np.isin(np.arange(256), [b for b in range(0x20) if not 0x09 <= b <= 0x0D])


def planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The compressed planes of a block."""
    pack = zstandard.ZstdCompressor(level=1)
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if kind == "bit":
        rows = [np.packbits((table[k // 8] >> (k % 8)) & 1) for k in range(32)]
    else:
        rows = list(table)
    return [pack.compress(np.ascontiguousarray(r).tobytes()) for r in rows]


def unplanes(parts: list[bytes], n: int) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor()
    rows = [np.frombuffer(unpack.decompress(p), np.uint8) for p in parts]
    if len(parts) == 32:
        bits = np.stack([np.unpackbits(r, count=n) for r in rows])
        rows = [(bits[8 * k : 8 * k + 8] << np.arange(8, dtype=np.uint8)[:, None]).sum(axis=0, dtype=np.uint8) for k in range(4)]
    return np.ascontiguousarray(np.stack(rows, axis=1)).view("<u4").ravel()


class Writer:
    """Appends documents to one file."""

    def __init__(self, stream, kind: str = "byte") -> None:
        self.stream, self.kind = stream, kind
        self.pending: list[np.ndarray] = []
        self.waiting = self.total = self.at = 0
        self.docs: list[np.ndarray] = []
        self.valid: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.index: list[list[int]] = []

    def add(self, doc_ids: np.ndarray, valid: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.valid.append(valid)
        self.lengths.append(lengths)
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK:
            self._flush(self.waiting - self.waiting % BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, np.uint32)
        for low in range(0, n, BLOCK):
            block = ids[low : min(low + BLOCK, n)]
            parts = planes(block, self.kind)
            self.index.append([self.at, len(block), *map(len, parts)])
            for part in parts:
                self._put(part)
        self.pending, self.waiting, self.total = [ids[n:]], len(ids) - n, self.total + n

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def close(self) -> None:
        if self.waiting:
            self._flush(self.waiting)
        pack = zstandard.ZstdCompressor(level=1)
        sections = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.docs, self.valid, self.lengths)]
        docs_at = self.at
        self._put(pack.compress(np.stack([s.astype("<i8") for s in sections]).tobytes()))
        index_at = self.at
        self._put(np.array(self.index, "<i8").tobytes())
        width = len(self.index[0]) if self.index else 0
        self._put(TRAILER.pack(MAGIC, docs_at, index_at, len(self.index), width, len(sections[0]), self.total))


class Reader:
    """Reads one file: documents, and blocks by number."""

    def __init__(self, stream, size: int) -> None:
        self.stream = stream
        stream.seek(size - TRAILER.size)
        magic, docs_at, index_at, blocks, width, docs, self.total = TRAILER.unpack(stream.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a file of id planes")
        stream.seek(docs_at)
        raw = zstandard.ZstdDecompressor().decompress(stream.read(index_at - docs_at))
        self.doc_ids, self.valid, self.lengths = np.frombuffer(raw, "<i8").reshape(3, docs) if docs else np.zeros((3, 0), np.int64)
        stream.seek(index_at)
        self.index = np.frombuffer(stream.read(8 * blocks * width), "<i8").reshape(blocks, width)

    def block(self, k: int) -> np.ndarray:
        at, n, *sizes = self.index[k].tolist()
        self.stream.seek(at)
        return unplanes([self.stream.read(s) for s in sizes], n)


class Encoder:
    """Encodes texts with the tokenizers library, each distinct stretch once.

    The tokenizer parts texts where a run of white space begins, so a text is a chain of
    stretches that are encoded alone with the same result. Distinct new stretches are
    joined and encoded together; up to KEEP of them are remembered. Texts with white space
    or controls beyond the usual six go to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallel units
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.length = np.array([self._bytes(self.tokenizer.id_to_token(k) or "") for k in range(size)])
        self.known = np.zeros(0, np.uint64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _bytes(self, token: str) -> int:
        """Bytes a token stands for: byte-level tokens have one character per byte."""
        special = token in ("<|endoftext|>",)
        return len(token.encode()) if special else len(token)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _unusual(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts with other white space or control characters."""
        one = _CONTROL[data]
        if data.size > 2:
            a, b, c = data[:-2], data[1:-1], data[2:]
            for lead in np.flatnonzero((a == 0xC2) | (a == 0xE1) | (a == 0xE2) | (a == 0xE3)):
                x, y, z = a[lead], b[lead], c[lead]
                if (x == 0xE1 and y == 0x9A) or (x == 0xE2 and y == 0x80 and (z <= 0x8A or z in (0xA8, 0xA9, 0xAF))) or (x == 0xE2 and y == 0x81 and z == 0x9F) or (x == 0xE3 and y == 0x80 and z == 0x80):
                    one[lead] = True
                elif x == 0xC2 and y in (0x85, 0xA0):
                    one[lead] = True
            if data[-2] == 0xC2 and data[-1] in (0x85, 0xA0):
                one[-2] = True
        return np.unique(np.searchsorted(offsets, np.flatnonzero(one), "right") - 1)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end``, and their lengths."""
        rows = len(offsets) - 1
        space = _SPACE[data]
        opens = space.copy()
        opens[1:] &= ~space[:-1]
        opens[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(opens)
        stop = np.append(start[1:], len(data))
        first = np.searchsorted(start, offsets)
        if len(start):
            hashes, sample, kind = np.unique(span_hashes(data, start, stop), return_index=True, return_inverse=True)
            begin, count, flat = self._stretches(data, hashes, start[sample], stop[sample])
            each = count[kind]
        else:
            begin = count = kind = each = np.zeros(0, np.int64)
            flat = np.zeros(0, np.uint32)
        tail = 0 if end is None else 1
        total = np.append(0, np.cumsum(each))
        lengths = total[first[1:]] - total[first[:-1]] + tail
        out = np.full(int(lengths.sum()), end or 0, np.uint32)
        base = np.append(0, np.cumsum(lengths))
        text = np.repeat(np.arange(rows), np.diff(first))
        to = np.arange(total[-1]) + np.repeat(text * tail, each)
        out[to] = flat[np.repeat(begin[kind], each) + np.arange(total[-1]) - np.repeat(total[:-1], each)]
        odd = self._unusual(data, offsets)
        if len(odd):
            got = self.whole([data[offsets[r] : offsets[r + 1]].tobytes().decode() for r in odd])
            parts, done = [], 0
            for r, ids in zip(odd.tolist(), got, strict=True):
                parts += [out[done : base[r]], ids, np.full(tail, end or 0, np.uint32)]
                done = base[r + 1]
                lengths[r] = len(ids) + tail
            out = np.concatenate([*parts, out[done:]])
        return out, lengths

    def _stretches(self, data: np.ndarray, hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each distinct stretch begin, how many, and the ids."""
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        hit = self.known[at] == hashes if len(self.known) else np.zeros(len(hashes), bool)
        begin, count = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        begin[hit], count[hit] = self.first[at[hit]], self.count[at[hit]]
        flat = self.flat
        new = np.flatnonzero(~hit)
        if len(new):
            ids, first, n = self._encode_new(data, start[new], stop[new])
            begin[new], count[new] = first + len(flat), n
            flat = np.concatenate([flat, ids])
            if len(self.known) + len(new) <= KEEP:
                self.flat = flat
                known = np.concatenate([self.known, hashes[new]])
                order = np.argsort(known)
                self.known = known[order]
                self.first = np.concatenate([self.first, begin[new]])[order]
                self.count = np.concatenate([self.count, count[new]])[order]
        return begin, count, flat

    def _encode_new(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Encode stretches joined into a few texts; ids, first id and number of each."""
        # A stretch that does not begin with white space (the start of a text) or ends with it stands alone.
        alone = ~_SPACE[data[start]] | _SPACE[data[stop - 1]]
        order = np.concatenate([np.flatnonzero(~alone), np.flatnonzero(alone)])
        size = (stop - start)[order]
        low = np.append(0, np.cumsum(size))
        joined = data[np.repeat(start[order], size) + np.arange(low[-1]) - np.repeat(low[:-1], size)].tobytes()
        chained = int((~alone).sum())
        cuts = np.unique(np.append(np.arange(0, chained, 4096), chained))
        texts = [joined[low[a] : low[b]].decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        texts += [joined[low[k] : low[k + 1]].decode() for k in range(chained, len(order))]
        got = self.whole(texts)
        ids = np.concatenate(got)
        ends = np.append(0, np.cumsum(self.length[ids]))
        first = np.searchsorted(ends, low)
        if ends[-1] != low[-1] or not (ends[first] == low).all():
            raise ValueError("the tokenizer does not part texts where white space begins")
        begin, count = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        begin[order], count[order] = first[:-1], np.diff(first)
        return ids, begin, count


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write(documents: DataFrame, folder: str, kind: str = "byte", end: int | None = END_ID, path: str | None = None) -> DataFrame:
    """Encode and write; the files as a stored table: file, size, doc_id, tie (of its first document), n_tokens."""
    where = path or public_tokenizers.path(TOKENIZER)
    tied = documents.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    dealt = tied.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = stream = writer = key = None
        for part, data, offsets in slices(batches, "text", SLICE):
            if writer is None:
                file = attempt_path(folder, ".ids")
                files, name = open_fs(file)
                stream = files.open_output_stream(name, compression=None)
                writer = Writer(stream, kind)
                key = (part.column("doc_id")[0].as_py(), part.column("tie")[0].as_py())
            ids, lengths = encoder(where).encode(data, offsets, end)
            column = part.column("doc_id")
            valid = np.asarray(column.is_valid())
            writer.add(np.asarray(column.fill_null(0)), valid.astype(np.int64), lengths, ids)
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pylist([{"file": file, "size": writer.at, "doc_id": key[0], "tie": key[1], "n_tokens": writer.total}], MANIFEST)

    return written(dealt.mapInArrow(rows, "file string, size long, doc_id long, tie long, n_tokens long"), "manifest")


MANIFEST = pa.schema([("file", pa.string()), ("size", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("n_tokens", pa.int64())])


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files of ``manifest``.

    The driver sees one row per file, to number the first id of each.
    """
    files = sorted(manifest.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["tie"]))
    base, rows_ = 0, []
    for row in files:
        rows_.append((row["file"], row["size"], base))
        base += row["n_tokens"]
    listed = manifest.sparkSession.createDataFrame(rows_, "file string, size long, start long")
    listed = listed.repartition(max(1, len(rows_)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, name = open_fs(row["file"])
                with files.open_input_file(name) as stream:
                    yield from documents_of(Reader(stream, row["size"]), row["start"])

    return listed.mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def documents_of(reader: Reader, base: int) -> Iterator[pa.RecordBatch]:
    """Checksums of a file's documents, block by block."""
    sums = np.zeros(len(reader.lengths), np.int64)
    ends = np.cumsum(reader.lengths)
    doc = at = 0
    for k in range(len(reader.index)):
        ids = reader.block(k)
        low = 0
        while low < len(ids):
            take = min(len(ids) - low, int(ends[doc]) - at)
            sums[doc] = crc32(ids[low : low + take], int(sums[doc]))
            low, at = low + take, at + take
            while doc < len(ends) and at == ends[doc]:
                doc += 1
    doc_id = pa.array(reader.doc_ids, mask=reader.valid == 0)
    yield pa.RecordBatch.from_arrays([doc_id, pa.array(base + ends - reader.lengths), pa.array(reader.lengths), pa.array(sums)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def round_trip(documents: DataFrame) -> DataFrame:
    """Write all documents to the shared folder and read them back."""
    return read(write(documents, scratch_path(documents.sparkSession, "ids")))
