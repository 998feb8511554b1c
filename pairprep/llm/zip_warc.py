"""WARC records in ZIP packages, read back by byte ranges without extraction.

A package is a ZIP archive whose members are stored, not compressed: `archive/data.warc.gz`, one
gzip member per record, and `indexes/index.cdxj`, one line per record with its offset and length
inside the data member. A reader takes the end record and its ZIP64 locator from the tail of the
file, the member entries from the central directory, then the local header that the data follows,
then the index, then any record on its own. Nothing is unpacked as a whole.

Writing: every task writes packages of at most PACKAGE_BYTES under names of its own attempt, and a
package counts only when its row is in the written list, so a repeated task leaves no double. The
folder is reached through pyarrow's file systems, as are the packages.

Defined results: a null html is an empty payload; of equal payloads of at least `min_revisit`
bytes the row with the largest page_id is the response and all others revisit it; among repeated
rows of that page one is the response. A null page_id is below all others and stays null; other
columns are ignored; an empty table writes no package and reads no row.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairprep.sources.scratch import fresh_path, stage

PACKAGE_BYTES = 64_000_000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Bytes of a package that one task reads.
RANGE_BYTES = 8 << 20
# Signatures and sizes of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
LOCAL_FORM, CENTRAL_FORM = "<4s5H3L2H", "<4s6H3L5H2L"
END_FORM, END64_FORM, LOCATOR_FORM = "<4s4H2LH", "<4sQ2H2L4Q", "<4sLQL"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def open_store(uri: str):
    """(file system, path) of a folder or file that every executor can reach."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# --- records -------------------------------------------------------------------------------------


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, revisit: bool = False, refers_to=None) -> bytes:
    """One WARC record; a revisit has the HTTP header of the payload but not the payload."""
    digest, size = digest_of(payload), len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {_one_line(url)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(url: str | None) -> str:
    return (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def parse_record(data: bytes) -> dict:
    """Fields of a record; the payload of a response is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda x: int(x) if x else None
    named = lambda f: number(fields[f].removeprefix("<urn:page:").removesuffix(">"))
    url = fields.get("WARC-Target-URI", "").replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return {
        "page_id": named("WARC-Record-ID"),
        "url": url,
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": named("WARC-Refers-To") if kind == "revisit" else None,
    }


# --- packages ------------------------------------------------------------------------------------


class Package:
    """Writes one package; `zip64` forces the large form, which is used anyway where it is needed."""

    def __init__(self, out, zip64: bool = False) -> None:
        self.out, self.zip64 = out, zip64
        self.at, self.members, self.index = 0, [], []
        self.held: list[bytes] = []
        self.size = 0

    def add(self, page_id, data: bytes) -> None:
        packed = gzip.compress(data, 6, mtime=0)
        name = "" if page_id is None else page_id
        self.index.append(f'{name} {{"offset": {self.size}, "length": {len(packed)}}}\n')
        self.held.append(packed)
        self.size += len(packed)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _member(self, name: str, parts: list[bytes]) -> None:
        size, crc = sum(map(len, parts)), 0
        for part in parts:
            crc = zlib.crc32(part, crc)
        large = self.zip64 or size >= FULL32 or self.at >= FULL32
        extra = struct.pack("<2H2Q", 1, 16, size, size) if large else b""
        shown = FULL32 if large else size
        self.members.append((name.encode(), size, crc, self.at, large))
        head = struct.pack(LOCAL_FORM, LOCAL, 45, 0x800, 0, 0, 33, crc, shown, shown, len(name), len(extra))
        self._write(head + name.encode() + extra)
        for part in parts:
            self._write(part)

    def close(self) -> None:
        self._member(DATA, self.held)
        self._member(INDEX, ["".join(self.index).encode()])
        begin = self.at
        for name, size, crc, offset, large in self.members:
            extra = struct.pack("<2H3Q", 1, 24, size, size, offset) if large else b""
            shown, place = (FULL32, FULL32) if large else (size, offset)
            head = (CENTRAL, 45, 45, 0x800, 0, 0, 33, crc, shown, shown, len(name), len(extra), 0, 0, 0, 0, place)
            self._write(struct.pack(CENTRAL_FORM, *head) + name + extra)
        n, size, end = len(self.members), self.at - begin, self.at
        large = self.zip64 or begin >= FULL32
        if large:
            self._write(struct.pack(END64_FORM, END64, 44, 45, 45, 0, 0, n, n, size, begin))
            self._write(struct.pack(LOCATOR_FORM, LOCATOR, 0, end, 1))
        counts = (FULL16, FULL16, FULL32, FULL32) if large else (n, n, size, begin)
        self._write(struct.pack(END_FORM, END, 0, 0, *counts, 0))


def read_range(file, at: int, size: int) -> bytes:
    file.seek(at)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"the file ends before byte {at + size}")
    return data


def members_of(file, size: int) -> dict[str, tuple[int, int]]:
    """name -> (offset of the data, bytes) of the stored members, from the central directory."""
    tail_at = max(0, size - struct.calcsize(END_FORM) - FULL16)
    tail = read_range(file, tail_at, size - tail_at)
    found = tail.rfind(END)
    if found < 0:
        raise ValueError("not a ZIP archive")
    *_, length, begin, _ = struct.unpack_from(END_FORM, tail, found)
    locator = found - struct.calcsize(LOCATOR_FORM)
    if locator >= 0 and tail[locator : locator + 4] == LOCATOR:
        _, _, at, _ = struct.unpack_from(LOCATOR_FORM, tail, locator)
        end = read_range(file, at, struct.calcsize(END64_FORM))
        *_, length, begin = struct.unpack(END64_FORM, end)
    directory, at, members = read_range(file, begin, length), 0, {}
    while at < length:
        head = struct.unpack_from(CENTRAL_FORM, directory, at)
        method, packed, full, n_name, n_extra, n_comment, place = (head[i] for i in (4, 8, 9, 10, 11, 12, 16))
        at += struct.calcsize(CENTRAL_FORM)
        name = directory[at : at + n_name].decode()
        packed, place = _large(directory[at + n_name : at + n_name + n_extra], packed, full, place)
        at += n_name + n_extra + n_comment
        if method == 0:
            local = struct.unpack(LOCAL_FORM, read_range(file, place, struct.calcsize(LOCAL_FORM)))
            if local[0] != LOCAL:
                raise ValueError(f"no local header for {name}")
            members[name] = (place + struct.calcsize(LOCAL_FORM) + local[-2] + local[-1], packed)
    return members


def _large(extra: bytes, packed: int, full: int, place: int) -> tuple[int, int]:
    """Size and offset with the values of the ZIP64 field in place of those that are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            if full == FULL32:
                next(values)
            packed = next(values) if packed == FULL32 else packed
            place = next(values) if place == FULL32 else place
        at += 4 + size
    return packed, place


def index_of(file, members: dict[str, tuple[int, int]]) -> list[tuple[int, int]]:
    """(offset in the file, bytes) of every record."""
    import json

    begin = members[DATA][0]
    lines = read_range(file, *members[INDEX]).decode().splitlines()
    entries = [json.loads(line.split(" ", 1)[1]) for line in lines]
    return [(begin + e["offset"], e["length"]) for e in entries]


# --- Spark jobs ----------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """Add _refers (null for a response) and _response to rows with `payload`.

    Digests are counted first, combined before the shuffle; only those of several rows come back,
    so a payload that a third of all rows share is split like any other joined key.
    """
    rows = pages.withColumns(
        {"_sha": F.sha1("payload"), "_size": F.octet_length("payload"), "_row": F.monotonically_increasing_id()}
    )
    held = stage(rows, "payloads")
    least = F.lit(-(2**63)).cast("long")
    place = F.struct(F.coalesce("page_id", least).alias("p"), "_row")
    groups = (
        held.where(F.col("_size") >= min_revisit)
        .groupBy("_sha", "_size")
        .agg(F.max(place).alias("_top"), F.count("*").alias("_n"))
        .where("_n > 1")
    )
    shared = stage(groups.select("_sha", "_size", F.struct("_top._row", F.nullif("_top.p", least).alias("p")).alias("_top")), "shared")
    joined = held.join(shared, ["_sha", "_size"], "left")
    revisit = F.col("_top").isNotNull() & (F.col("_top._row") != F.col("_row"))
    return joined.select("page_id", "url", "payload", revisit.alias("revisit"), F.col("_top.p").alias("refers_to"))


def write_packages(
    pages: DataFrame, folder: str, min_revisit: int = 0, package_bytes: int = PACKAGE_BYTES, zip64: bool = False
) -> DataFrame:
    """Write a record per row of pages(page_id, url, html); gives the list (path, n_records)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        import pyarrow as pa

        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        package, path = None, None

        def closed():
            package.close()
            package.out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": [len(package.index)]})

        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    path = f"{root}/{uuid.uuid4().hex}.wacz"
                    package = Package(store.open_output_stream(path), zip64)
                data = record(*(row[c] for c in ("page_id", "url", "payload", "revisit", "refers_to")))
                package.add(row["page_id"], data)
                if package.size >= package_bytes:
                    yield closed()
                    package = None
        if package is not None:
            yield closed()

    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = with_revisits(pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")), min_revisit)
    return stage(rows.mapInArrow(run, "path string, n_records long"), "packages")


def list_records(packages: DataFrame, folder: str) -> DataFrame:
    """(path, offset, length) of every record, from the directories and indexes of the packages."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        store, _ = open_store(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_file(path) as file:
                    places = index_of(file, members_of(file, file.size()))
                offsets, lengths = zip(*places) if places else ((), ())
                yield pa.RecordBatch.from_pydict(
                    {"path": pa.array([path] * len(places), pa.string()), "offset": pa.array(offsets, pa.int64()),
                     "length": pa.array(lengths, pa.int64())}
                )

    return packages.select("path").mapInArrow(run, "path string, offset long, length long")


def read_records(records: DataFrame, folder: str) -> DataFrame:
    """The records at the given places, each by a read of its own range."""
    schema = (
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long"
    )
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        store, _ = open_store(folder)
        names = [c.split()[0] for c in schema.split(", ")]
        form = pa.schema(list(zip(names, kinds)))
        path, file, rows, held = None, None, [], 0
        for batch in batches:
            for place in batch.to_pylist():
                if place["path"] != path:
                    if file is not None:
                        file.close()
                    path, file = place["path"], store.open_input_file(place["path"])
                data = gzip.decompress(read_range(file, place["offset"], place["length"]))
                rows.append(parse_record(data))
                held += len(data)
                if held > 8_000_000:
                    yield pa.RecordBatch.from_pylist(rows, form)
                    rows, held = [], 0
        if file is not None:
            file.close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, form)

    return records.mapInArrow(run, schema)


def round_trip(spark: SparkSession, pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """Write the pages to packages in the shared folder and read all records back."""
    folder = fresh_path(spark, "warc")
    packages = write_packages(pages, folder, min_revisit)
    places = stage(list_records(packages.repartition(F.col("path")), folder), "record-places")
    # Few bytes name many: the number of tasks follows the bytes to be read, not those of the table.
    n_ranges = (places.agg(F.sum("length")).first()[0] or 0) // RANGE_BYTES + 1
    # Ranges of a package may go to several tasks; inside one they are read in order.
    spread = places.repartition(n_ranges, F.col("path"), F.floor(F.col("offset") / RANGE_BYTES))
    return read_records(spread.sortWithinPartitions("path", "offset"), folder)


def op7_zip_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return round_trip(spark, pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP7_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS hex,
    max(page_id) OVER (PARTITION BY html) AS top
  FROM p
), bits AS (
  SELECT *, array_to_string(list_transform(string_split(hex, ''), lambda c:
    ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
    [strpos('0123456789abcdef', c)]), '') AS b FROM d
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
    + 16 * CAST(b[5 * i + 1] AS INT) + 8 * CAST(b[5 * i + 2] AS INT) + 4 * CAST(b[5 * i + 3] AS INT)
    + 2 * CAST(b[5 * i + 4] AS INT) + CAST(b[5 * i + 5] AS INT) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM bits
"""
