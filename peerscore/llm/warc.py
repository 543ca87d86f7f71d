"""WARC archives: written by Spark tasks, normalised to one gzip member per record, read by offset.

Writers make one gzip stream per archive. The normaliser inflates such a stream once, in blocks,
writes every record as a member of its own and a sidecar index of offsets; after that any record
can be read alone. Files are reached by the scheme of their folder's URI, so the folder must be one
that all executors share. A task that is run again writes files of a new name, and only files named
by a task that succeeded are ever read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.session import scratch_path, stage

BLOCK = 1 << 20
HEAD_END = b"\r\n\r\n"


@dataclass(frozen=True)
class Params:
    """``archive_bytes`` of records begin a new archive; ``date`` is every record's date, so that
    reruns write equal records. Payloads of fewer than ``min_bytes`` are never revisits."""

    archive_bytes: int = 1 << 30
    level: int = 3
    min_bytes: int = 0
    date: str = "2026-01-01T00:00:00Z"


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(id_text: str) -> str:
    return f"<urn:page:{quote(id_text, safe='')}>"


def _record(id_text, url, payload: bytes, refers_to, params: Params) -> bytes:
    head = ["WARC/1.1"]
    revisit = refers_to is not None
    block = b"" if revisit else (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode() + payload
    head.append(f"WARC-Type: {'revisit' if revisit else 'response'}")
    name = id_text if id_text is not None else f"none-{uuid.uuid5(uuid.NAMESPACE_URL, digest(payload))}"
    head.append(f"WARC-Record-ID: {_record_id(name)}")
    if id_text is not None:
        head.append(f"X-Page-Id: {quote(id_text, safe='')}")
    head.append(f"WARC-Date: {params.date}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='')}")
    head.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    head.append(f"X-Payload-Length: {len(payload)}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_record_id(refers_to)}")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + HEAD_END + block + HEAD_END


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url",
    payload: str = "html", params: Params = Params(),
) -> DataFrame:
    """(archive, records): the archives written to a new folder, with a record for each row.

    Of rows with equal payloads the one with the smallest id is a response, the others revisit it;
    rows that share this id are all responses. Null payloads are empty; rows with a null id are
    responses if all rows of their payload have null ids. An empty table writes no archive.
    """
    # the SHA-1 decides which payloads are equal; only repeated ones get a row here
    key = F.when(
        F.octet_length(F.col("payload")) >= params.min_bytes, F.sha1(F.col("payload"))
    ).alias("key")
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    ).select("*", key)
    firsts = (
        rows.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND key IS NOT NULL").drop("n")
    )
    other = ~F.col("id").eqNullSafe(F.col("first"))
    known = rows.join(firsts, "key", "left").select(
        F.col("id").cast("string").alias("id"), "url", "payload",
        F.when(other, F.col("first").cast("string")).alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        name, out, packer, records, size = None, None, None, 0, 0
        done = []

        def close():
            if out is not None:
                out.write(packer.flush())
                out.close()
                done.append((name, records))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None or size >= params.archive_bytes:
                    close()
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    packer = zlib.compressobj(params.level, wbits=31)
                record = _record(row["id"], row["url"], row["payload"].encode(), row["refers_to"], params)
                out.write(packer.compress(record))
                records, size = records + 1, size + len(record)
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
            ["archive", "records"],
        )

    system, root = _open(folder)
    system.create_dir(root, recursive=True)
    return stage(known.mapInArrow(run, "archive string, records long"), "archives")


class _Inflated:
    """The inflated bytes of an archive, read once from front to end; members are joined."""

    def __init__(self, file):
        self.file, self.buffer, self.unpacker = file, bytearray(), None

    def _more(self) -> bool:
        if self.unpacker is not None and self.unpacker.eof:
            rest, self.unpacker = self.unpacker.unused_data, None
        elif self.unpacker is not None and self.unpacker.unconsumed_tail:
            rest = self.unpacker.unconsumed_tail
        else:
            rest = b""
        rest = rest or self.file.read(BLOCK)
        if not rest:
            return False
        if self.unpacker is None:
            self.unpacker = zlib.decompressobj(wbits=31)
        self.buffer += self.unpacker.decompress(rest, BLOCK)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to the mark, included; None at the end of the archive."""
        start = 0
        while (at := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                if self.buffer:
                    raise ValueError("the archive ends within a record")
                return None
        return self._take(at + len(mark))

    def _take(self, n: int) -> bytes:
        found = bytes(self.buffer[:n])
        del self.buffer[:n]
        return found

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next n bytes, block by block."""
        while n:
            if not self.buffer and not self._more():
                raise ValueError("the archive ends within a record")
            piece = self._take(min(n, len(self.buffer)))
            n -= len(piece)
            yield piece


class Fields(dict):
    """Header fields by name, whose case does not count."""

    def __getitem__(self, name: str) -> str:
        return super().__getitem__(name.lower())

    def __contains__(self, name: str) -> bool:
        return super().__contains__(name.lower())

    def get(self, name: str, default: str | None = None) -> str | None:
        return super().get(name.lower(), default)


def _fields(head: bytes) -> Fields:
    """The fields of a record's head: blanks around a value do not count, and a line that begins
    with a blank goes on with the value before it. Of a repeated name the last one counts."""
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    found, name = Fields(), None
    for line in filter(None, lines[1:]):
        if line[0] in " \t" and name:
            found[name] = f"{found[name]} {line.strip()}".strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"no header field: {line[:80]!r}")
        name = name.strip().lower()
        found[name] = value.strip()
    return found


def normalise(archives: DataFrame, folder: str, params: Params = Params()) -> DataFrame:
    """(file, offset, length, record_id, uri, type) of every record of these archives.

    Each archive is inflated once and rewritten beside the others as ``<name>-members.warc.gz``,
    one gzip member per record, with ``.cdxj``, the same index as JSON lines. Records are never
    held whole. An archive that ends early or holds no WARC record is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                stem = f"{archive.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}-members"
                index, at = [], 0
                with (
                    system.open_input_stream(f"{root}/{archive}", compression=None) as source,
                    system.open_output_stream(f"{root}/{stem}.warc.gz", compression=None) as out,
                    system.open_output_stream(f"{root}/{stem}.cdxj") as sidecar,
                ):
                    stream = _Inflated(source)
                    while (head := stream.until(HEAD_END)) is not None:
                        fields = _fields(head)
                        packer, size = zlib.compressobj(params.level, wbits=31), 0
                        size += out.write(packer.compress(head))
                        for piece in stream.pieces(int(fields["Content-Length"]) + len(HEAD_END)):
                            size += out.write(packer.compress(piece))
                        size += out.write(packer.flush())
                        row = {
                            "file": f"{stem}.warc.gz", "offset": at, "length": size,
                            "record_id": fields["WARC-Record-ID"],
                            "uri": fields.get("WARC-Target-URI"), "type": fields["WARC-Type"],
                        }
                        sidecar.write(json.dumps(row).encode() + b"\n")
                        index.append(row)
                        at += size
                        if len(index) == 10_000:
                            yield pa.RecordBatch.from_pylist(index, schema=_INDEX)
                            index = []
                yield pa.RecordBatch.from_pylist(index, schema=_INDEX)

    # one task per archive, however few bytes their names have
    dealt = archives.select("archive").repartition(max(1, archives.count()))
    found = dealt.mapInArrow(
        run, "file string, offset long, length long, record_id string, uri string, type string"
    )
    return stage(found, "archive_index")


_INDEX = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ("record_id", pa.string()), ("uri", pa.string()), ("type", pa.string()),
])


def read_index(index: DataFrame, folder: str) -> DataFrame:
    """The index of these files as their sidecars have it, from the shared folder.

    Sidecars beside files that ``index`` does not name, which a lost task may have left, are not read.
    """
    if index.isEmpty():
        return index
    sidecars = index.sparkSession.read.schema(index.schema).json(f"{folder.rstrip('/')}/*-members.cdxj")
    files = index.select("file").distinct()  # one row per archive
    return sidecars.join(files, "file", "left_semi")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(id, url, type, payload_bytes, payload_digest, refers_to, payload) of the indexed records.

    Each record is read alone, by its offset. A response whose payload doesn't fit its digest is an
    error. A revisit has the length and digest of the payload it refers to, and null as payload.
    """
    schema = (
        "id string, url string, type string, payload_bytes long, payload_digest string, "
        "refers_to string, payload binary"
    )
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        name, file = None, None
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                rows = []
                for row in batch.slice(a, 256).to_pylist():
                    if row["file"] != name:
                        name = row["file"]
                        file = system.open_input_file(f"{root}/{name}")
                    file.seek(row["offset"])
                    rows.append(_parsed(zlib.decompress(file.read(row["length"]), wbits=31)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in rows], t) for k, t in zip(names, _READ, strict=True)], names
                )

    files = max(1, index.select("file").distinct().count())
    dealt = index.select("file", "offset", "length").repartition(2 * files, "file")
    dealt = dealt.sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, schema)


_READ = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]


def _parsed(record: bytes) -> dict:
    head, _, rest = record.partition(HEAD_END)
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != HEAD_END:
        raise ValueError(f"record {fields['WARC-Record-ID']} doesn't end where it should")
    response = fields["WARC-Type"] == "response"
    payload = block.partition(HEAD_END)[2] if response else None
    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if response and digest(payload) != said:
        raise ValueError(f"record {fields['WARC-Record-ID']} has another payload than it says")
    refers = fields.get("WARC-Refers-To")
    return {
        "id": unquote(fields["X-Page-Id"]) if "X-Page-Id" in fields else None,
        "url": unquote(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
        "type": fields["WARC-Type"],
        "payload_bytes": len(payload) if response else int(fields["X-Payload-Length"]),
        "payload_digest": digest(payload) if response else said,
        "refers_to": unquote(refers[len("<urn:page:") : -1]) if refers else None,
        "payload": payload,
    }


def archived(
    pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html",
    params: Params = Params(), folder: str | None = None,
) -> DataFrame:
    """Write, normalise and read back by the sidecars: the rows of ``read_records`` for every page."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    archives = write_archives(pages, folder, id_col, url, payload, params)
    return read_records(read_index(normalise(archives, folder, params), folder), folder)
