"""Write web pages to WARC archives and read them back.

A record is a gzip member of its own, so an archive can be read from front to back with
bounded memory: the reader inflates a little at a time, finds the end of a block by its
Content-Length, and checks block and payload against the digests in the header.

Of pages with equal payloads the one with the smallest id is stored whole; the others are
``revisit`` records that point to it. Payloads under ``MIN_REVISIT`` bytes are always
stored, since a pointer would be no shorter.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrublens.llm.common import shared_folder

MIN_REVISIT = 100
#: An archive is closed once it has this many compressed bytes.
ARCHIVE_BYTES = 64 * 1024 * 1024
_CHUNK = 256 * 1024
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_ID = "<urn:scrublens:page:{}>"


@dataclass(frozen=True)
class Record:
    """One record: header fields by lower-case name, and the payload (empty in revisits)."""

    fields: dict[str, str]
    payload: bytes


class WarcError(ValueError):
    """The archive breaks the format, or a digest does not fit."""


# --- writing ----------------------------------------------------------------


def record_bytes(fields: dict[str, str], block: bytes) -> bytes:
    """A record as one gzip member."""
    named = {**fields, "WARC-Block-Digest": "sha256:" + hashlib.sha256(block).hexdigest()}
    named["Content-Length"] = str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named.items()) + "\r\n"
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    whole = squeeze.compress(head.encode()) + squeeze.compress(block)
    return whole + squeeze.compress(b"\r\n\r\n") + squeeze.flush()


def page_record(
    page_id: str | None, url: str | None, payload: bytes, digest: str, first: str | None
) -> bytes:
    """A response record, or with ``first`` a revisit of that page's record."""
    fields = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": _ID.format("" if page_id is None else page_id),
        "WARC-Date": "1970-01-01T00:00:00Z",
        # A line break would end the field.
        "WARC-Target-URI": "".join((url or "").splitlines()),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
    }
    http = _HTTP.format(len(payload)).encode()
    if first is None:
        return record_bytes(fields, http + payload)
    fields["WARC-Refers-To"] = _ID.format(first)
    fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return record_bytes(fields, http)


def write_archives(
    pages: DataFrame, id_col: str, url_col: str, payload: Column, folder: str
) -> DataFrame:
    """Write every row to archives below ``folder`` and return the table of archives:
    ``path, records, bytes``.

    Each task writes files of its own, under names never used before, and only those of
    tasks that succeeded are in the table: a lost or repeated task leaves at most a file
    that nobody reads.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("body")
    )
    rows = rows.withColumn("digest", F.sha2("body", 256))
    large = F.octet_length("body") >= MIN_REVISIT
    firsts = (
        rows.filter(large)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select("of", "first")
    )
    joined = rows.join(firsts, F.when(large, F.col("digest")) == F.col("of"), "left")
    points = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    # Ids pass as text: pandas would turn whole numbers beside nulls into floats.
    text_id, text_first = F.col("id").cast("string"), points.cast("string")
    listed = joined.select(text_id.alias("id"), "url", "body", "digest", text_first.alias("first"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        done, out, name, size, count = [], None, "", 0, 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                data = page_record(row.id, row.url, row.body, row.digest, row.first)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    done.append((f"{folder}/{name}", count, size))
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", count, size))
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    manifest = f"{folder}-list"
    written = listed.mapInPandas(write, "path string, records long, bytes long")
    written.write.parquet(manifest)
    return pages.sparkSession.read.schema(written.schema).parquet(manifest)


# --- reading ----------------------------------------------------------------


def members(stream) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as an iterator over its inflated parts. A member
    must be read to its end before the next is asked for."""
    rest = stream.read(_CHUNK)
    while rest:
        inflate = zlib.decompressobj(31)

        def parts(inflate=inflate) -> Iterator[bytes]:
            nonlocal rest
            while not inflate.eof:
                rest = rest or stream.read(_CHUNK)
                part = inflate.decompress(rest, _CHUNK)
                if not (rest or part or inflate.eof):
                    raise WarcError("the archive ends within a record")
                rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                if part:
                    yield part
            rest = rest or stream.read(_CHUNK)

        yield parts()


def read_record(parts: Iterator[bytes]) -> Record:
    """One record from the inflated parts of its member."""
    held = bytearray()
    while (end := held.find(b"\r\n\r\n")) < 0:
        part = next(parts, None)
        if part is None:
            raise WarcError("no end of the record's header")
        held += part
    version, *lines = held[:end].decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise WarcError(f"not a WARC record: {version[:20]!r}")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise WarcError(f"not a header field: {line[:40]!r}")
        fields[name.strip().lower()] = value.strip()
    try:
        length = int(fields["content-length"])
    except (KeyError, ValueError) as error:
        raise WarcError("no usable Content-Length") from error
    block = bytearray(held[end + 4 :])
    for part in parts:
        block += part
        if len(block) > length + 4:
            raise WarcError("more bytes than Content-Length says")
    if len(block) != length + 4 or block[length:] != b"\r\n\r\n":
        raise WarcError("fewer bytes than Content-Length says, or no closing line breaks")
    del block[length:]
    _verify(fields.get("warc-block-digest"), block)
    head = block.find(b"\r\n\r\n")
    payload = bytes(block[head + 4 :]) if head >= 0 else bytes(block)
    if fields.get("warc-type") == "response":
        _verify(fields.get("warc-payload-digest"), payload)
    return Record(fields, payload)


def _verify(digest: str | None, data: bytes) -> None:
    if digest is None:
        raise WarcError("a record without a digest")
    kind, _, value = digest.partition(":")
    if hashlib.new(kind, data).hexdigest() != value:
        raise WarcError(f"a digest does not fit: {digest}")


def read_archive(stream) -> Iterator[Record]:
    """The records of an archive from front to back."""
    for parts in members(stream):
        yield read_record(parts)


def read_archives(archives: DataFrame) -> DataFrame:
    """All records of the listed archives, a task reading whole archives one after the
    other: ``id, url, record_type, refers_to, digest, payload_bytes, payload``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_stream(name, compression=None) as stream:
                    rows, held = [], 0
                    for record in read_archive(stream):
                        rows.append(_row(record))
                        held += len(record.payload) + 200
                        if held > 8 * 1024 * 1024:
                            yield pd.DataFrame(rows, columns=_COLUMNS, dtype=object)
                            rows, held = [], 0
                    yield pd.DataFrame(rows, columns=_COLUMNS, dtype=object)

    count = archives.count()
    spread = archives.select("path").repartition(max(1, count))
    return spread.mapInPandas(read, _SCHEMA)


_SCHEMA = (
    "id long, url string, record_type string, refers_to long, digest string, "
    "payload_bytes long, payload binary"
)
_COLUMNS = ["id", "url", "record_type", "refers_to", "digest", "payload_bytes", "payload"]


def _row(record: Record) -> tuple:
    fields = record.fields
    return (
        _page(fields["warc-record-id"]),
        fields.get("warc-target-uri"),
        fields["warc-type"],
        _page(fields.get("warc-refers-to", "")),
        fields["warc-payload-digest"].partition(":")[2],
        int(fields["payload-length"]),
        record.payload,
    )


def _page(name: str) -> int | None:
    number = name.rstrip(">").rpartition(":")[2]
    return int(number) if number else None


def round_trip(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back.

    Null pages count as empty. Rows that repeat an id and payload each get a record; all
    of those with the smallest id are responses. A null id never stands for a group that
    has other ids; alone, it is a response. An empty table gives no archive and no row.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    folder = f"{shared_folder(pages.sparkSession)}/warc"
    return read_archives(write_archives(pages, id_col, url_col, payload, folder))
