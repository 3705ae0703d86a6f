"""WARC archives: written as gzip members, read back by byte ranges.

Writer: one gzip member per record, so a reader may start at any record. Files are written by
Spark's text writer, whose separator is an empty gzip member: the file is one valid gzip stream.

Reader: files are split into byte ranges by Spark's text reader with the gzip magic as separator, so
a task scans its range for the magic and owns the candidates that start inside. A candidate counts
once its gzip header decodes and its data begins a WARC header. The magic may also occur by chance
inside a member: while a member is incomplete, what follows belongs to it. Where such a chance magic
lies behind the end of the range, the beginning and the rest are found by different tasks; both are
handed on and joined by file, the reader's one and nearly always empty shuffle.

Payloads are the bytes of a page, empty for null. Of records with equal payloads of at least
``MIN_BYTES`` the one with the largest id is a response and the others revisit it; equal ids at that
maximum are all responses, as are records whose group has no id. Null ids and urls are left out of
the record's header and read as null. Tables may be empty and rows may repeat.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAGIC = b"\x1f\x8b\x08"
#: A gzip member without content.
EMPTY = zlib.compressobj(9, zlib.DEFLATED, 31).flush()
LATIN = "ISO-8859-1"
MIN_BYTES = 1_000
LEVEL = 6
ID = "<urn:x-page:{}>"
RECORD = "record_id string, warc_type string, target_uri string, payload binary, payload_bytes long, payload_digest string, refers_to string"
FOUND = RECORD + ", file string, place long, part int, piece binary, head boolean"


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Add ``payload``, ``payload_digest`` and ``refers_to`` (null for responses) to page_id, url, html.

    Only the groups of equal payloads with several members are joined back.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha1("payload"), "_n": F.octet_length("payload")})
    groups = rows.where(F.col("_n") >= min_bytes).groupBy("payload_digest", "_n")
    equal = groups.agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).drop("_rows")
    joined = rows.join(equal, ["payload_digest", "_n"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last"))
    return joined.select("page_id", "url", "payload", "payload_digest", refers.alias("refers_to"))


def _member(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, date: str) -> bytes:
    kind = "response" if refers is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers is None else http
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    head = ["WARC/1.1", f"WARC-Type: {kind}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: {ID.format(page_id)}")
    if url is not None:
        safe = "".join(c if c >= " " else f"%{ord(c):02X}" for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{sha1}"]
    if refers is not None:
        head += [
            f"WARC-Refers-To: {ID.format(refers)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    data = "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(marked: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write the rows of ``mark_revisits`` as WARC files, one per task."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("page_id", "url", "payload", "payload_digest", "refers_to")
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                rows = zip(*(part.column(n).to_pylist() for n in names))
                yield pa.RecordBatch.from_arrays([pa.array([_member(*r, date) for r in rows], pa.binary())], names=["member"])

    packed = marked.mapInArrow(pack, "member binary").select(F.col("member").cast("string").alias("value"))
    packed.write.option("encoding", LATIN).option("lineSep", EMPTY.decode(LATIN)).text(folder)


def _parse(data: bytes) -> tuple | None:
    """The columns of RECORD of a decoded member; None if it holds no record."""
    if not data.startswith(b"WARC/"):
        return None
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
    get = lambda name: fields[name].decode("utf-8") if name in fields else None
    block = rest[: int(fields.get(b"Content-Length", b"0"))]
    http, _, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
    if get(b"WARC-Type") == "revisit":
        sha1 = (get(b"WARC-Payload-Digest") or "").removeprefix("sha1:")
        size = [int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
        digest = base64.b32decode(sha1).hex() if sha1 else None
        kept = (None, size[0] if size else None, digest)
    else:
        kept = (payload, len(payload), hashlib.sha1(payload).hexdigest())
    return get(b"WARC-Record-ID"), get(b"WARC-Type"), get(b"WARC-Target-URI"), *kept, get(b"WARC-Refers-To")


class Assembler:
    """Members of one byte range, from the pieces between its magics."""

    def __init__(self, in_step: bool):
        #: False until a candidate has proved to be a member
        self.in_step = in_step
        self.pieces: list[bytes] = []
        self.out: list[bytes] = []
        self.unpacker = None
        #: pieces that belong to the range before
        self.orphans: list[bytes] = []

    def add(self, piece: bytes) -> list[tuple]:
        """Take the bytes behind a magic; the records that are complete now."""
        waiting, found = [piece], []
        while waiting:
            piece = waiting.pop(0)
            if self.unpacker is None:
                self.unpacker, self.pieces, self.out = zlib.decompressobj(31), [], []
            self.pieces.append(piece)
            try:
                self.out.append(self.unpacker.decompress(MAGIC + piece))
                sound = self.in_step or self._begins_record()
            except zlib.error:
                sound = False
            if not sound:
                if self.in_step:
                    raise ValueError("a gzip member of an archive is damaged")
                # no member starts at the first piece; any of the next may be a start
                self.orphans.append(self.pieces[0])
                waiting = self.pieces[1:] + waiting
                self.unpacker = None
            elif self.unpacker.eof:
                self.in_step = True
                record = _parse(b"".join(self.out))
                self.unpacker = None
                if record:
                    found.append(record)
        return found

    def _begins_record(self) -> bool:
        begin = b"".join(self.out)[:5]
        return b"WARC/".startswith(begin) if begin else not self.unpacker.eof or self.pieces == [EMPTY[3:]]


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the archives below ``folder``, whose names must not end in a compression suffix."""
    lines = spark.read.option("encoding", LATIN).option("lineSep", MAGIC.decode(LATIN)).text(folder)
    ranges = lines.select(
        F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    names = [f.split()[0] for f in FOUND.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(),
                 pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    def left(at: tuple, held: Assembler) -> list[tuple]:
        """Pieces of members that lie in several ranges: those of the range before, then an open beginning."""
        open_ = held.pieces if held.unpacker is not None else []
        pieces = [(p, True) for p in held.orphans] + [(p, False) for p in open_]
        return [(*[None] * 7, *at, n, p, head) for n, (p, head) in enumerate(pieces)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            rows, size = [], 0
            for piece, file, start in zip(*(batch.column(n).to_pylist() for n in ("piece", "file", "start"))):
                if at != (file, start):
                    if held:
                        rows += left(at, held)
                    at, held = (file, start), Assembler(start == 0)
                    if start == 0:
                        continue  # what stands before the first magic of a file
                for record in held.add(piece):
                    rows.append((*record, *[None] * 5))
                    size += record[4] or 0
                if size > 4_000_000:
                    yield batch_of(rows)
                    rows, size = [], 0
            yield batch_of(rows)
        if held:
            yield batch_of(left(at, held))

    def join(pieces: pd.DataFrame) -> pd.DataFrame:
        held, records = Assembler(True), []
        for row in pieces.sort_values(["place", "part"]).itertuples():
            records += held.add(row.piece)
        if held.unpacker is not None:
            raise ValueError("an archive ends inside a gzip member")
        return pd.DataFrame(records, columns=names[:7]).astype({"payload_bytes": "Int64"})

    found = ranges.mapInArrow(scan, FOUND)
    whole = found.where(F.col("file").isNull()).select(*names[:7])
    return whole.unionByName(found.where(F.col("file").isNotNull()).groupBy("file").applyInPandas(join, RECORD))


def page_id(record_id: Column) -> Column:
    """The id that a record id of this writer names."""
    return F.regexp_extract(record_id, r"x-page:(-?\d+)>", 1).try_cast("long")
