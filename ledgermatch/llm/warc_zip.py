"""WARC records in ZIP packages: writing, and reading by ranges.

A package is a ZIP archive whose members are stored, not deflated: ``archive/
data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj`` (one
JSON line per record: offset and length within the first). Because members are
stored, a record is a byte range of the package. The reader takes the archive
apart from its end: end-of-central-directory record, ZIP64 locator and record
where present, central directory with ZIP64 extra fields, local header of the
members it needs. Nothing is extracted or copied to disk; records are
fetched by range reads of neighbouring records and only those bytes are held.

Records with equal payloads of at least ``least_bytes``: the one with the
smallest page identifier is the response, the others are revisits of it.

Defined results: a null payload is empty; smaller payloads are all responses;
a null page identifier is larger than any other; rows that tie on the smallest
identifier are all responses; a null URL is written empty; line breaks in a
URL are percent-encoded; repeated rows each give a record; extra columns are
ignored. Identifiers are integers.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, spread_lookup, text_or_empty
from .files import new_file, open_for_ranges, shared_folder, tasks_for

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
_DATE = "2024-01-01T00:00:00Z"  # pages carry no time; a fixed one keeps archives reproducible

# fixed values: signatures and layouts of the ZIP format
_END, _END64, _LOCATOR64, _ENTRY, _LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
_END_LAYOUT, _END64_LAYOUT, _LOCATOR64_LAYOUT = "<4s4H2LH", "<4sQ2H2L4Q", "<4sLQL"
_ENTRY_LAYOUT, _LOCAL_LAYOUT = "<4s4B4HL2L5H2L", "<4s5H3L2H"


# ---- reading a package ----------------------------------------------------

class ZipDirectory:
    """The stored members of a ZIP archive, from its central directory.
    ``members``: name -> (offset of the local header, size, compression method)."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size = file, file.size()
        self.members: dict[str, tuple[int, int, int]] = {}
        tail_at = max(0, self.size - 65_535 - struct.calcsize(_END_LAYOUT) - struct.calcsize(_LOCATOR64_LAYOUT))
        tail = self._read(tail_at, self.size - tail_at)
        at = self._end_record(tail)
        _, _, _, _, count, length, start, _ = struct.unpack_from(_END_LAYOUT, tail, at)
        before = at - struct.calcsize(_LOCATOR64_LAYOUT)
        if before >= 0 and tail[before:before + 4] == _LOCATOR64:
            _, _, end64, _ = struct.unpack_from(_LOCATOR64_LAYOUT, tail, before)
            record = self._read(end64, struct.calcsize(_END64_LAYOUT))
            if record[:4] != _END64:
                raise ValueError("ZIP64 locator does not lead to a ZIP64 end record")
            *_, count, length, start = struct.unpack(_END64_LAYOUT, record)
        self._entries(self._read(start, length), count)

    @staticmethod
    def _end_record(tail: bytes) -> int:
        """The last end record whose comment fills the rest of the file."""
        at = tail.rfind(_END)
        while at >= 0:
            size = struct.calcsize(_END_LAYOUT)
            if at + size <= len(tail) and at + size + struct.unpack_from("<H", tail, at + size - 2)[0] == len(tail):
                return at
            at = tail.rfind(_END, 0, at)
        raise ValueError("not a ZIP archive: no end of central directory")

    def _read(self, at: int, length: int) -> bytes:
        data = self.file.read_at(length, at)
        if len(data) != length:
            raise ValueError(f"truncated archive: {length} bytes at {at} wanted, {len(data)} read")
        return data

    def _entries(self, data: bytes, count: int) -> None:
        at, fixed = 0, struct.calcsize(_ENTRY_LAYOUT)
        for _ in range(count):
            if data[at:at + 4] != _ENTRY:
                raise ValueError("damaged central directory")
            f = struct.unpack_from(_ENTRY_LAYOUT, data, at)
            method, packed, plain, n_name, n_extra, n_comment, header = f[6], f[10], f[11], f[12], f[13], f[14], f[18]
            name = data[at + fixed:at + fixed + n_name].decode("utf-8" if f[5] & 0x800 else "cp437")
            packed, header = self._wide(data[at + fixed + n_name:at + fixed + n_name + n_extra], plain, packed, header)
            self.members[name] = (header, packed, method)
            at += fixed + n_name + n_extra + n_comment

    @staticmethod
    def _wide(extra: bytes, plain: int, packed: int, header: int) -> tuple[int, int]:
        """Size and header offset, from the ZIP64 extra field where the
        directory holds all ones. The field lists only those values, in order."""
        at, full = 0, 0xFFFFFFFF
        while at + 4 <= len(extra):
            kind, length = struct.unpack_from("<2H", extra, at)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
                if plain == full:
                    next(wide)
                packed = next(wide) if packed == full else packed
                header = next(wide) if header == full else header
                break
            at += 4 + length
        return packed, header

    def locate(self, name: str) -> tuple[int, int]:
        """(offset, length) of the bytes of a stored member."""
        header, length, method = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed (method {method}); only stored members can be read by range")
        local = self._read(header, struct.calcsize(_LOCAL_LAYOUT))
        fields = struct.unpack(_LOCAL_LAYOUT, local)
        if fields[0] != _LOCAL:
            raise ValueError(f"no local header for {name}")
        return header + len(local) + fields[-2] + fields[-1], length

    def read(self, name: str) -> bytes:
        return self._read(*self.locate(name))


def _headers(block: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = block.decode("utf-8").split("\r\n")
    return first, {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, warc = _headers(head)
    if not version.startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    block = rest[:int(warc["content-length"])]
    if not warc.get("content-type", "").startswith("application/http"):
        return warc, {}, block
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, _headers(http)[1], payload


# ---- writing a package ----------------------------------------------------

class _Sink:
    """Only what a ZIP writer may use of a stream that cannot seek."""

    def __init__(self, stream):
        self.write, self.flush = stream.write, stream.flush


def _page_urn(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def make_record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
            "\r\n\r\n").encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <{_page_urn(page_id)}>", f"WARC-Date: {_DATE}",
             "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"),
             f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        lines += [f"WARC-Refers-To: <{_page_urn(refers_to)}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class PackageWriter:
    """One ZIP package in the shared folder, written as a stream."""

    def __init__(self, folder: str):
        self.uri, self.stream = new_file(folder, ".zip")
        self.zip = zipfile.ZipFile(_Sink(self.stream), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(WARC_MEMBER, "w", force_zip64=True)
        self.index: list[str] = []
        self.bytes = 0

    def add(self, page_id, url: str, payload: bytes, digest: str, refers_to) -> None:
        data = gzip.compress(make_record(page_id, url, payload, digest, refers_to), 6, mtime=0)
        self.member.write(data)
        self.index.append(json.dumps({"id": _page_urn(page_id), "offset": self.bytes, "length": len(data)}))
        self.bytes += len(data)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX_MEMBER), "\n".join(self.index))
        self.zip.close()
        self.stream.close()
        return self.uri, len(self.index)


def _write_packages(folder: str, package_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for row in zip(*(c for c in batch.columns), strict=True):
                page_id, url, html, refers_to = (x.as_py() for x in row)
                payload = html.encode()
                writer = writer or PackageWriter(folder)
                writer.add(page_id, url, payload, hashlib.sha256(payload).hexdigest(), refers_to)
                if writer.bytes >= package_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in done], pa.string()),
                                          pa.array([n for _, n in done], pa.int64())], names=["path", "records"])
    return run


def revisits(pages: DataFrame, id_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """(page, digest, refers_to) of the rows that repeat an earlier payload."""
    payload = text_or_empty(payload_col).cast("binary")
    sized = cut(pages.select(F.col(id_col).cast("long").alias("page"), F.sha2(payload, 256).alias("digest"),
                             F.octet_length(payload).alias("n")).filter(F.col("n") >= least_bytes))
    repeated = sized.groupBy("digest").agg(F.min("page").alias("refers_to"), F.count("*").alias("n_same")).filter(
        "n_same > 1 and refers_to is not null").select("digest", "refers_to")
    return spread_lookup(sized.select("page", "digest"), repeated, ["digest"], ["page"]).filter(
        F.col("refers_to").isNotNull() & ~F.col("page").eqNullSafe(F.col("refers_to"))).distinct()


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", least_bytes: int = 100, package_bytes: int = 64 << 20) -> DataFrame:
    """Write every row as a record; returns (path, records), checkpointed."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), text_or_empty(url_col).alias("url"),
                        text_or_empty(payload_col).alias("html")).withColumn("_digest", F.sha2(F.col("html").cast("binary"), 256))
    again = revisits(pages, id_col, payload_col, least_bytes)
    same = rows["page_id"].eqNullSafe(again["page"]) & (rows["_digest"] == again["digest"])
    marked = rows.join(again, same, "left").select("page_id", "url", "html", "refers_to")
    return cut(marked.mapInArrow(_write_packages(folder, package_bytes), "path string, records long"))


# ---- range-reading packages -----------------------------------------------

def _plan_ranges(range_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_for_ranges(path) as file:
                    directory = ZipDirectory(file)
                    start, _ = directory.locate(WARC_MEMBER)
                    entries = [json.loads(x) for x in directory.read(INDEX_MEMBER).decode().split("\n") if x]
                first, ends, rows = None, [], []
                for e in entries:  # neighbouring records, up to range_bytes at a time
                    if first is None or e["offset"] != first + ends[-1] or ends[-1] >= range_bytes:
                        first, ends = e["offset"], []
                        rows.append((path, start + first, ends))
                    ends.append(e["offset"] - first + e["length"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["path", "at", "ends"])
    return run


def _page_of(urn: str) -> int | None:
    value = urn.strip("<>").rpartition(":")[2]
    return None if value == "none" else int(value)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest")
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string())
    for batch in batches:
        for path, at, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with open_for_ranges(path) as file:
                data = file.read_at(ends[-1], at)
            rows = []
            for lo, hi in zip([0, *ends], ends, strict=False):
                warc, http, payload = parse_record(gzip.decompress(data[lo:hi]))
                digest = warc["warc-payload-digest"].removeprefix("sha256:")
                revisit = warc["warc-type"] == "revisit"
                if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {warc['warc-record-id']} in {path} does not match its digest")
                rows.append((_page_of(warc["warc-record-id"]), warc["warc-target-uri"], warc["warc-type"],
                             _page_of(warc["warc-refers-to"]) if revisit else None, None if revisit else payload,
                             int(http["content-length"]), digest))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def read_packages(packages: DataFrame, range_bytes: int = 4 << 20) -> DataFrame:
    """One row per record of the packages named in column ``path``. A revisit
    has no payload of its own; size and digest are those of the full one."""
    ranges = cut(packages.select("path").mapInArrow(
        _plan_ranges(range_bytes), "path string, at long, ends array<long>"))
    size = ranges.agg(F.sum(F.element_at("ends", -1))).first()[0]
    return ranges.repartition(tasks_for(size), "path", "at").mapInArrow(
        _fetch, "page_id long, url string, record_type string, refers_to long, payload binary, "
                "payload_bytes long, payload_digest string")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to packages in the shared folder and read them back."""
    return read_packages(write_packages(pages, shared_folder(pages.sparkSession, "warc"), **options))
