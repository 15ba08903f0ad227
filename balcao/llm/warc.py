"""Zstandard WARC archives: one frame per record, with the dictionary up front.

An archive begins with a skippable frame that holds the dictionary its frames
were compressed with. The reader loads it, decodes one frame per record, and
checks the header, the lengths and the digests of each. Payloads that occur more
than once are stored once, as the response of the largest id; the others are
revisit records that refer to it.

Archives are written by the tasks into a folder that all executors share, each
under a name of its own attempt; only those named by the committed list of a
write are read, so a task that is run again leaves no double records.

Page ids are whole numbers or missing. Null payloads are empty; a payload is held
whole, so one must fit in a task. Of equal payloads the largest id is the
response, and so is every row that repeats it; a missing id never is, if another
has the payload. Other columns are left out. An empty table writes no archive.
Archives too small to train a dictionary on (fewer than 16 records, or 256 KB) have
no dictionary frame, which the reader allows. It reads what the writer writes:
other record types, and responses without a length, are refused.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.session import shared_dir, written

DICTIONARY_FRAME = 0x184D2A5D
FRAME, DICTIONARY = b"\x28\xb5\x2f\xfd", b"\x37\xa4\x30\xec"
DICTIONARY_BYTES = 1 << 15
#: Bytes of records that a dictionary is trained on, from the first ones of an archive.
SAMPLE_BYTES = 1 << 20
ARCHIVE_BYTES = 1 << 26
CHUNK = 1 << 15
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive that does not hold what its headers say."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: int | None) -> str:
    return f"<urn:page:{'none' if key is None else key}>"


def key_of(urn: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(none|-?\d+)>", urn)
    if not found:
        raise WarcError(f"record id {urn[:80]}")
    return None if found[1] == "none" else int(found[1])


def encode(key: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = EPOCH) -> bytes:
    """One record; a revisit has the HTTP header only, with the length of the payload it stands for."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(key),
        "WARC-Date": date,
        "Content-Type": "application/http;msgtype=response",
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "WARC-Block-Digest": f"sha1:{payload_digest(block)}",
    }
    if url:
        fields["WARC-Target-URI"] = re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url)
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to)}
    fields["Content-Length"] = str(len(block))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def decode(record: bytes) -> dict:
    """Fields of one record, all of it checked."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not mark or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise WarcError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip() or name.lower() in fields:
            raise WarcError(f"header line {line[:80]!r}")
        fields[name.lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(fields)
    if missing:
        raise WarcError(f"no {', '.join(sorted(missing))}")
    if not fields["content-length"].isdigit():
        raise WarcError("Content-Length is no number")
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"{size} bytes announced, {len(rest) - 4} found")
    _same_digest(fields.get("warc-block-digest"), block, "block")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise WarcError(f"record type {kind[:40]}")
    http, mark, payload = block.partition(b"\r\n\r\n")
    told = re.search(rb"(?i)\r\ncontent-length:[ ]*(\d+)", http)
    if not http.startswith(b"HTTP/") or not mark or not told:
        raise WarcError("no HTTP header")
    if kind == "response":
        if len(payload) != int(told[1]):
            raise WarcError(f"{int(told[1])} payload bytes announced, {len(payload)} found")
        _same_digest(fields.get("warc-payload-digest"), payload, "payload")
    elif payload or "warc-refers-to" not in fields or "warc-payload-digest" not in fields:
        raise WarcError("a revisit needs a reference and a digest, and has no payload")
    digest = fields.get("warc-payload-digest", "")
    return {
        "page_id": key_of(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": int(told[1]),
        "payload_digest": digest.removeprefix("sha1:") if digest else payload_digest(payload),
        "record_type": kind,
        "refers_to": key_of(fields["warc-refers-to"]) if kind == "revisit" else None,
    }


def _same_digest(told: str | None, content: bytes, what: str) -> None:
    if told and told.startswith("sha1:") and told.removeprefix("sha1:") != payload_digest(content):
        raise WarcError(f"{what} digest differs")


def dictionary_for(samples: list[bytes]):
    """A dictionary trained on records, or None where they are too few for one."""
    import zstandard

    if len(samples) < 16 or sum(map(len, samples)) < 8 * DICTIONARY_BYTES:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:  # samples without anything in common
        return None


class ArchiveWriter:
    """Records into one stream."""

    def __init__(self, out, dictionary, level: int = 3):
        import zstandard

        self.out, self.size, self.records = out, 0, 0
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
        if dictionary:
            content = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.compressor.compress(record))
        self.records += 1


def records(stream) -> Iterator[bytes]:
    """The records of an archive, one frame at a time; the stream is read in chunks."""
    import zstandard

    held = stream.read(CHUNK)
    dictionary = None
    if len(held) >= 8 and struct.unpack("<I", held[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", held[4:8])[0]
        while len(held) < 8 + size:
            more = stream.read(CHUNK)
            if not more:
                raise WarcError("the dictionary frame is cut off")
            held += more
        content, held = held[8 : 8 + size], held[8 + size :]
        if content[:4] == FRAME:
            content = zstandard.ZstdDecompressor().decompress(content)
        if content[:4] != DICTIONARY:
            raise WarcError("the leading frame holds no dictionary")
        dictionary = zstandard.ZstdCompressionDict(content)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while held or (held := stream.read(CHUNK)):
        while len(held) < 4 and (more := stream.read(CHUNK)):
            held += more
        if held[:4] != FRAME:
            raise WarcError("no frame where one should begin")
        frame, parts = decompressor.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(held))
            except zstandard.ZstdError as e:
                raise WarcError(f"a frame cannot be decoded: {e}") from e
            if frame.eof:
                held = frame.unused_data
                break
            held = stream.read(CHUNK)
            if not held:
                raise WarcError("the last frame is cut off")
        yield b"".join(parts)


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``page_id, url, html, keeper, revisit`` as archives; the list of them: path, records, bytes.

    ``folder`` is a local path that all executors share or a URI that
    ``pyarrow.fs`` opens. The list is written as a table, which runs the job.
    """
    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _file_system(folder)
        files.create_dir(root, recursive=True)
        waiting: list[bytes] = []
        writer, path, held = None, "", 0

        def opened() -> None:
            nonlocal writer, path, held
            name = f"{uuid.uuid4().hex}.warc.zst"
            path = f"{folder.rstrip('/')}/{name}"
            out = files.open_output_stream(f"{root.rstrip('/')}/{name}", compression=None)
            writer = ArchiveWriter(out, dictionary_for(waiting))
            for one in waiting:
                writer.add(one)
            waiting.clear()
            held = 0

        def closed() -> pa.RecordBatch:
            nonlocal writer
            writer.out.close()
            done, writer = writer, None
            return pa.RecordBatch.from_pylist([{"path": path, "records": done.records, "bytes": done.size}])

        for batch in batches:
            for row in batch.to_pylist():
                payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                record = encode(row["page_id"], row["url"], payload, row["keeper"], row["revisit"])
                if writer is None:
                    waiting.append(record)
                    held += len(record)
                    if held >= SAMPLE_BYTES:
                        opened()
                else:
                    writer.add(record)
                if writer and writer.size >= archive_bytes:
                    yield closed()
        if waiting:
            opened()
        if writer:
            yield closed()

    listed = rows.select("page_id", "url", "html", "keeper", "revisit").mapInArrow(put, "path string, records bigint, bytes bigint")
    return written(listed, "warc-list")


READ_SCHEMA = (
    "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)


def read_archives(listed: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all archives in ``listed`` (``path``, and ``records`` to check the count where known).

    One task reads an archive as a stream. Any fault raises ``WarcError`` with
    the path. ``payloads=False`` checks them and returns null instead.
    """
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, announced in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, name = _file_system(path)
                rows, held, n = [], 0, 0
                with files.open_input_stream(name, compression=None) as stream:
                    try:
                        for record in records(stream):
                            row = decode(record)
                            n += 1
                            held += len(record)
                            rows.append(row if payloads else row | {"payload": None})
                            if held >= 1 << 22:
                                yield pa.RecordBatch.from_pylist(rows, schema)
                                rows, held = [], 0
                    except WarcError as e:
                        raise WarcError(f"{path}: {e}") from e
                if announced is not None and n != announced:
                    raise WarcError(f"{path}: {announced} records announced, {n} found")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return listed.select("path", "records").repartition("path").mapInArrow(read, READ_SCHEMA)


def marked(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html`` with ``revisit`` and ``keeper``, the id that a revisit refers to.

    Of pages with equal payloads of ``min_bytes`` or more the largest id is the
    response; null html is an empty payload. Repeated rows of that id are all
    responses. A page without an id is a revisit of any that has one. Only ids
    and digests of repeated payloads are shuffled by payload.
    """
    rows = pages.select(
        "page_id", "url", "html",
        F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"),
        F.coalesce(F.octet_length("html"), F.lit(0)).alias("size"),
    )
    narrow = rows.where(F.col("size") >= min_bytes).select("page_id", "digest", "size")
    keepers = written(
        narrow.groupBy("digest", "size").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND keeper IS NOT NULL").drop("n"),
        "warc-keepers",
    )
    revisits = written(
        narrow.join(keepers, ["digest", "size"]).where(~F.col("page_id").eqNullSafe(F.col("keeper")))
        .select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "keeper").distinct(),
        "warc-revisits",
    )
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    return rows.join(revisits, same, "left").select("page_id", "url", "html", "keeper", F.col("keeper").isNotNull().alias("revisit"))


def archive_folder(spark) -> str:
    """A new folder for archives below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/balcao-{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
