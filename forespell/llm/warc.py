"""WARC archives of pages: writing with revisit records, and a salvage reader.

Writing: one record per page, each a gzip member of its own. Among records with equal
payloads (of ``least`` bytes or more) the one with the smallest page_id is a response, the
others are revisit records that name it and carry no payload; the HTTP headers of a
revisit keep the length of the payload. Equal payloads are found by digest: the smallest
page_id per digest is an aggregate, and the join back has one row per digest on its small
side, so AQE can split a digest that a third of the pages share.

Reading: a record must pass its checks (gzip checksum, version line, header block, declared
length, block and payload digests). After a failure the reader searches for the next valid
start (a gzip member whose first bytes inflate to a version line, or a version line in a
plain file), goes on from there, and logs the bytes in between as a quarantined gap.

Null html is an empty payload. Null urls become ``about:blank``. A null page_id is written
without an id; it can be a revisit, and is the response only if nothing else has its
payload. Repeated rows with the smallest page_id are all responses. An empty table makes
no archives. Extra columns are left aside. Html of any length is one record; a task holds
one record at a time when writing and ``WINDOW`` bytes plus one record when reading.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forespell.llm.components import written
from forespell.llm.shared_files import attempt_path, open_fs
from forespell.session import scratch_path

VERSION = b"WARC/1.1"
WINDOW = 1 << 16
DATE = "2000-01-01T00:00:00Z"
_GZIP = b"\x1f\x8b\x08"
_START = re.compile(rb"WARC/1\.[01]\r\n")


def digest(payload: bytes) -> str:
    """SHA-1 in bare upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, payload_digest: str) -> bytes:
    """One uncompressed record: an HTTP response, or a revisit that keeps its headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    headers = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{payload_digest}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if kind == "revisit":
        headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member (no time stamp, so equal records give equal bytes)."""
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Broken(Exception):
    """A record that does not pass its checks."""


def parse(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and whole length of the record at the start of ``data``."""
    if not _START.match(data):
        raise Broken("no version line")
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise Broken("no end of headers")
    headers: dict[str, str] = {}
    for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Broken("bad header line")
        headers[name.strip().lower()] = value.strip()
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length"} - headers.keys():
        raise Broken(f"no {min(missing)}")
    if not re.fullmatch("[0-9]{1,15}", headers["content-length"]):
        raise Broken("no length")
    past = end + 4 + int(headers["content-length"])
    if data[past : past + 4] != b"\r\n\r\n":
        raise Broken("length does not fit")
    block = bytes(data[end + 4 : past])
    named = headers.get("warc-block-digest", "")
    if named.startswith("sha1:") and named[5:] != digest(block):
        raise Broken("block digest differs")
    if headers.get("warc-type") == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        named = headers.get("warc-payload-digest", "")
        if named.startswith("sha1:") and named[5:] != digest(payload):
            raise Broken("payload digest differs")
    return headers, block, past + 4


class Damaged(Exception):
    """Bytes of a gzip member that do not inflate."""


class _Stored:
    """A seekable file, read onwards from ``at``."""

    def __init__(self, file: object) -> None:
        self.file, self.at, self.size = file, 0, file.seek(0, 2)

    def read(self, n: int) -> bytes:
        if self.at >= self.size:
            return b""
        self.file.seek(self.at)
        got = self.file.read(n)
        self.at += len(got)
        return got

    def look(self, skip: int, n: int) -> bytes:
        """The ``n`` bytes that follow the next ``skip``, which stay unread."""
        if self.at + skip >= self.size:
            return b""
        self.file.seek(self.at + skip)
        return self.file.read(n)


class _Inflated:
    """The contents of one gzip member, which begins with ``data`` and goes on in the file at ``at``."""

    def __init__(self, file: _Stored, data: bytes, at: int) -> None:
        self.file, self.data, self.at = file, data, at
        self.unpack = zlib.decompressobj(31)

    def read(self, n: int) -> bytes:
        while not self.unpack.eof:
            if not self.data:
                self.file.file.seek(min(self.at, self.file.size))
                self.data = self.file.file.read(WINDOW)
                self.at += len(self.data)
                if not self.data:
                    raise Damaged("member ends early")
            try:
                got = self.unpack.decompress(self.data, n)
            except zlib.error as error:
                raise Damaged("gzip check") from error
            self.data = self.unpack.unconsumed_tail
            if got:
                return got
        return b""

    def _ahead(self) -> _Inflated:
        other = _Inflated(self.file, self.data, self.at)
        other.unpack = self.unpack.copy()
        return other

    def look(self, skip: int, n: int) -> bytes:
        """The ``n`` bytes that follow the next ``skip``, which stay unread."""
        ahead, got = self._ahead(), b""
        while skip:
            passed = len(ahead.read(min(skip, WINDOW)))
            if not passed:
                return b""
            skip -= passed
        while len(got) < n and (more := ahead.read(n - len(got))):
            got += more
        return got

    def whole(self) -> bool:
        """Whether the rest of the member inflates and passes its checksum."""
        ahead = self._ahead()
        try:
            while ahead.read(WINDOW):
                pass
        except Damaged:
            return False
        return True

    def end(self) -> int:
        """Where the member ends in the file, once all is read."""
        return self.at - len(self.unpack.unused_data)


@dataclass
class Salvage:
    """Iterates over the good records of a seekable stream; ``gaps`` logs (start, end, reason).

    Records of one gzip member share its offset. A gap inside a member names the member's
    bytes and says which bytes of its contents are meant. Of a damaged member those records
    are kept that pass a block digest of their own and are followed by another record.
    """

    stream: object
    gaps: list[tuple[int, int, str]] = field(default_factory=list)
    in_member: bool = False

    def __post_init__(self) -> None:
        self.source = self.stream if self.in_member else _Stored(self.stream)
        self.data, self.base, self.over = bytearray(), 0, False

    def _more(self) -> bool:
        got = b"" if self.over else self.source.read(WINDOW)
        self.over = not got
        self.data += got
        return bool(got)

    def _drop(self, n: int) -> None:
        """Go on ``n`` bytes further, also beyond what has been read (of a file)."""
        if n > len(self.data):
            self.source.at = self.base + n
        del self.data[:n]
        self.base += n

    def _record(self) -> tuple[dict[str, str], bytes, int]:
        while True:
            try:
                return parse(self.data)
            except Broken as error:
                wants_more = str(error) in ("no end of headers", "length does not fit", "no version line")
                want = self._wanted() if wants_more else 0
                if want <= 0 or not self._more():
                    raise
                past = len(self.data) + want - WINDOW
                while len(self.data) < past and self._more():
                    pass

    def _wanted(self) -> int:
        """How many bytes are missing from a plain record that may be whole; 0 if it cannot be.

        A record is only read to its end if it ends where its length says.
        """
        end = self.data.find(b"\r\n\r\n")
        if end < 0:
            return WINDOW - len(self.data)
        length = re.search(rb"(?i)\r\ncontent-length:\s*(\d{1,15})\s*\r\n", self.data[: end + 2])
        want = end + 8 + int(length[1]) - len(self.data) if length else 0
        return want if want <= 4 or self.source.look(want - 4, 4) == b"\r\n\r\n" else 0

    def _find_start(self) -> None:
        """Drop at least one byte, and all up to the next place where a record may begin (or the end)."""
        self._drop(1)
        while True:
            plain = _START.search(self.data)
            stop, at = plain.start() if plain else len(self.data), 0
            while not self.in_member and 0 <= (at := self.data.find(_GZIP, at, stop)):
                if len(self.data) < at + 512 and not self.over:
                    break
                try:
                    if _START.match(zlib.decompressobj(31).decompress(bytes(self.data[at : at + 512]), 64)):
                        self._drop(at)
                        return
                except zlib.error:
                    pass
                at += 1
            else:
                at = -1
            if at < 0 and plain:
                self._drop(stop)
                return
            self._drop(at if at >= 0 else max(0, len(self.data) - 16))
            if not self._more() and at < 0:
                self._drop(len(self.data))
                return

    def _member(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """The records of the member at the start of the data; goes on behind it, or raises if it is damaged."""
        member = _Inflated(self.source, bytes(self.data), self.base + len(self.data))
        inside = Salvage(member, in_member=True)
        held, whole = None, None
        for _, headers, block in inside:
            if held is not None:
                whole = member.whole() if whole is None else whole
                if whole or held[0].get("warc-block-digest", "").startswith("sha1:"):
                    yield held
            held = headers, block
        if held is None:
            raise Broken(inside.gaps[0][2] if inside.gaps else "empty member")
        yield held
        end = member.end()
        self.gaps += [(self.base, end, f"{why}: bytes {a} to {b} of the member") for a, b, why in inside.gaps]
        self._drop(end - self.base)

    def __iter__(self) -> Iterator[tuple[int, dict[str, str], bytes]]:
        gap, reason = None, ""
        while True:
            if len(self.data) < WINDOW:
                self._more()
            if not self.data:
                break
            start = self.base
            try:
                if not self.in_member and self.data.startswith(_GZIP):
                    good = self._member()
                    found = next(good)
                else:
                    headers, block, size = self._record()
                    self._drop(size)
                    good, found = iter(()), (headers, block)
                if gap is not None:
                    self.gaps.append((gap, start, reason))
                    gap = None
                yield start, *found
                for headers, block in good:
                    yield start, headers, block
            except (Broken, Damaged) as error:
                if self.in_member and isinstance(error, Damaged):
                    raise
                if gap is None:
                    gap, reason = self.base, str(error)
                self._find_start()
        if gap is not None:
            self.gaps.append((gap, self.base, reason))


def write(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write the archives; a stored table of their files."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    named = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    firsts = named.groupBy("sha").agg(F.min("page_id").alias("first")).withColumnRenamed("sha", "of")
    revisits = (F.octet_length("payload") >= least) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    kinds = named.join(firsts, F.col("sha") == F.col("of")).select("page_id", "url", "payload", F.when(revisits, F.col("first")).alias("refers_to"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = stream = None
        for batch in batches:
            for page_id, url, data, refers in zip(*[batch.column(c) for c in ("page_id", "url", "payload", "refers_to")], strict=True):
                if stream is None:
                    file = attempt_path(folder, ".warc.gz")
                    files, name = open_fs(file)
                    stream = files.open_output_stream(name, compression=None)
                body, to = data.as_py(), refers.as_py()
                stream.write(member(record(page_id.as_py(), url.as_py(), body, "response" if to is None else "revisit", to, digest(body))))
        if stream is not None:
            stream.close()
            yield pa.record_batch({"file": pa.array([file])})

    return written(kinds.mapInArrow(rows, "file string"), "archives")


SCHEMA = "file string, offset long, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, gap_end long, gap_reason string"
_ARROW = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    + [("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("gap_end", pa.int64()), ("gap_reason", pa.string())]
)


def _page(named: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", named)
    return int(found[1]) if found else None


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record of the files (column ``file``), and a row per quarantined gap (gap_end set).

    Revisits have a null payload; their length is that of the HTTP headers they kept.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                files, name = open_fs(file)
                with files.open_input_file(name) as stream:
                    reader, out, held = Salvage(stream), [], 0
                    for offset, headers, block in reader:
                        head, _, body = block.partition(b"\r\n\r\n")
                        kind = headers.get("warc-type", "")
                        length = re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)
                        size = len(body) if kind == "response" or not length else int(length[1])
                        out.append(
                            {
                                "file": file, "offset": offset, "page_id": _page(headers.get("warc-record-id", "")), "url": headers.get("warc-target-uri"),
                                "payload_bytes": size, "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:"),
                                "record_type": kind, "refers_to": _page(headers.get("warc-refers-to", "")), "payload": body if payloads and kind == "response" else None,
                            }
                        )
                        held += len(block)
                        if held > 8 << 20 or len(out) >= 4096:
                            yield pa.RecordBatch.from_pylist(out, _ARROW)
                            out, held = [], 0
                    out += [{"file": file, "offset": a, "gap_end": b, "gap_reason": why} for a, b, why in reader.gaps]
                    if out:
                        yield pa.RecordBatch.from_pylist(out, _ARROW)

    count = archives.count()
    return archives.select("file").repartition(max(1, count)).mapInArrow(rows, SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    return read(write(pages, scratch_path(pages.sparkSession, "warc")), payloads=False)
