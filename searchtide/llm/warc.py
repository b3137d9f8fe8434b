"""ARC archives converted to WARC.

An ARC file begins with a ``filedesc`` record whose block names the version and the fields of the header lines that
follow: version 1 has five, version 2 ten. A record is one such line, as many bytes as it declares, and a newline. The
converter reads each line by the fields of its own file and writes WARC records: an identifier made from the ARC line
(the same on every run), the timestamp in ISO form, a type, and SHA-1 digests of block and payload.
Of records with equal payloads the one with the largest page number is the response; the others become
revisits, which keep their HTTP header but not the payload.

What the line says is taken from both its ends, since a content type may have blanks (and so, in old files, may an address). A block that begins
with an HTTP header, ended by an empty line of either kind, becomes a ``response``; any other block, such as that of a ``dns:`` record, is a
payload as it is and becomes a ``resource`` of the ARC line's content type. The number of a page is read from a header of this module's own
writer; without one it is null, and then the latest date, and the smallest identifier, tell which of equal payloads is the response.

Archives are written by Spark's text writer, a whole file of about ``FILE_BYTES`` a row, and
gzipped. So they need no local files, files and rows are bounded by bytes, and lost tasks leave nothing behind. Which records become revisits is worked out
from digests and joined to whole files by file and number of the record.

Damage: a line that is no header line and a record that declares more bytes than there are do not end up in the result. :func:`damaged_arc` lists them with
file, offset and reason; reading goes on at the next header line. :func:`parse_arc` without a list for them raises ``ValueError``.

Defined results: a null html is an empty payload, a null url is written as ``-``, blanks and control characters
in a url are escaped. A null page number counts as smaller than any other. Rows with the same page number and
payload are of the same type. An empty table gives an archive without records. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.llm.shared import BROADCAST_ROWS, new_folder, staged

# The header fields of both ARC versions, the separators and the WARC revisit profile
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_END = "\n"
WARC_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = 1000
#: bytes of records after which a new file begins; a larger record stands alone
FILE_BYTES = 16 * 1024 * 1024
#: of Hadoop's gzip levels; on test pages the default, six, takes 2.7 times the CPU time for 4 % fewer bytes
GZIP_LEVEL = "FOUR"
#: when pages without a date were archived
ARCHIVED = "20240101000000"
_PAGE_HEADER = b"X-Page-Id"
#: WARC field for the length of a payload, which a revisit does not hold
_LENGTH = "X-Payload-Length"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _texts(values: list[bytes]) -> pa.Array:
    """Bytes as strings, as they are."""
    return pa.array(values, pa.binary()).view(pa.string())


def _file_record(version: int, name: str) -> bytes:
    block = f"{version} 0 searchtide\n{ARC_FIELDS[version]}\n".encode()
    line = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": ARCHIVED, "Content-type": "text/plain", "Archive-length": str(len(block))}
    return " ".join(line.get(f, "-") for f in ARC_FIELDS[version].split()).encode() + b"\n" + block


def _page_record(version: int, page_id, url: str | None, payload: bytes) -> bytes:  # noqa: ANN001
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
            f"{_PAGE_HEADER.decode()}: {'' if page_id is None else page_id}\r\n\r\n").encode()
    line = {"URL": quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "-", "IP-address": "0.0.0.0", "Archive-date": ARCHIVED, "Content-type": "text/html",
            "Result-code": "200", "Archive-length": str(len(head) + len(payload))}
    return " ".join(line.get(f, "-") for f in ARC_FIELDS[version].split()).encode() + b"\n" + head + payload


def _files(rows: Iterator[dict], weight: Callable[[dict], int], head: Callable[[int], bytes], record: Callable[[dict, int], bytes], end: str,
           records: int) -> Iterator[pa.RecordBatch]:
    """Files of records, one a row: each a head and then up to ``records`` records or about ``FILE_BYTES``. The writer adds the last end."""
    parts, size, number = [], 0, -1
    for row in rows:
        if parts and (len(parts) > records or size + weight(row) > FILE_BYTES):
            yield pa.RecordBatch.from_arrays([_texts([end.encode().join(parts)])], ["value"])
            parts = []
        if not parts:
            number += 1
            parts, size = [head(number)], 0
        parts.append(record(row, number))
        size += len(parts[-1])
    if parts:
        yield pa.RecordBatch.from_arrays([_texts([end.encode().join(parts)])], ["value"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for row in zip(*batch.columns):
            yield {n: v.as_py() for n, v in zip(batch.schema.names, row)}


def _write(files: DataFrame, end: str, path: str) -> None:
    files.write.options(lineSep=end, compression="gzip").option("zlib.compress.level", GZIP_LEVEL).option("maxRecordsPerFile", 1).text(path)


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", records: int = RECORDS) -> None:
    """Archive pages, by turns in files of version 1 and 2."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("binary").alias("html"))

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def version(number: int) -> int:
            return 1 + (part + number) % 2

        yield from _files(
            _rows(batches), lambda r: len(r["html"] or b""), lambda k: _file_record(version(k), f"{part:06d}-{k:06d}.arc"),
            lambda r, k: _page_record(version(k), r["page_id"], r["url"], r["html"] or b""), ARC_END, records)

    _write(rows.mapInArrow(archived, "value string"), ARC_END, path)


def unpacked(content: bytes, damaged: list[tuple[int, str]] | None = None) -> bytes:
    """The bytes of an archive, gzipped (in one or more members) or not. Of one that is cut, as many as there are."""
    if content[:2] != b"\x1f\x8b":
        return content
    out, left = [], content
    while left[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(left))
        except zlib.error as error:
            if damaged is not None:
                damaged.append((sum(map(len, out)), f"not gzip: {error}"))
            break
        if not member.eof:
            if damaged is not None:
                damaged.append((sum(map(len, out)), "gzip ends early"))
            break
        left = member.unused_data
    return b"".join(out)


#: address, place and date stand in every version; what comes between them and the length depends on it
_LINE = re.compile(rb"(?P<url>\S.*?) (?P<ip>\d+(?:\.\d+){3}|[0-9A-Fa-f:]*:[0-9A-Fa-f:]+|-) (?P<date>\d{8,14}) (?P<rest>.*\S)")


def header_line(line: bytes, fields: list[str]) -> dict[str, str] | None:
    """The fields of an ARC header line; none if it is no such line."""
    found = _LINE.fullmatch(line.rstrip(b"\r"))
    if found is None:
        return None
    # all fields after the content type are single words, so they are counted from the end
    rest = found["rest"].decode("utf-8", errors="replace").rsplit(" ", len(fields) - 4)
    if len(rest) != len(fields) - 3 or not rest[-1].isdigit():
        return None
    return dict(zip(fields, [found["url"].decode("utf-8", errors="replace"), found["ip"].decode(), found["date"].decode(), *rest]))


def parse_arc(content: bytes, damaged: list[tuple[int, str]] | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record after the file's own.

    Without a record of the file itself, lines are read as those of version 1. Damage is added to ``damaged`` as offset and reason, and reading goes
    on at the next header line; without such a list it raises ``ValueError``.
    """
    fields, at = ARC_FIELDS[1].split(" "), 0

    def wrong(reason: str) -> None:
        if damaged is None:
            raise ValueError(f"{reason} at byte {at}: {content[at : at + 100]!r}")
        damaged.append((at, reason))

    while at < len(content):
        if content[at] in b"\r\n":
            at += 1
            continue
        end = content.find(b"\n", at)
        end = len(content) if end < 0 else end
        # the line of the file itself has five fields in version 1, and in version 2 the fields of version 2
        own = content.startswith(b"filedesc://", at)
        line = header_line(content[at:end], fields)
        if own and line is None:
            line = header_line(content[at:end], ARC_FIELDS[2].split(" "))
        if line is None:
            wrong("no header line")
            at = end + 1
            continue
        length = int(line["Archive-length"])
        if end + 1 + length > len(content):
            wrong(f"{length} bytes declared, {max(0, len(content) - end - 1)} left")
            at = end + 1
            continue
        block = content[end + 1 : end + 1 + length]
        at = end + 1 + length
        if own:
            named = block.split(b"\n")[1].decode().split() if block.count(b"\n") else []
            fields = named if len(named) in (5, 10) else fields
        else:
            yield line, block


_BREAK = re.compile(rb"\r\n\r\n|\n\n")


def split_block(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header with the empty line that ends it, and payload. A block that is no HTTP response is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    found = _BREAK.search(block)
    return (block, b"") if found is None else (block[: found.end()], block[found.end() :])


def _page_of(head: bytes) -> int | None:
    """Page number from an HTTP header of this module's own writer."""
    found = re.search(rb"(?mi)^" + _PAGE_HEADER + rb": *(-?\d+)\r?$", head)
    return int(found[1]) if found else None


def record_id(fields: dict[str, str], page_id: int | None, digest: str = "") -> str:
    """An identifier that depends on what the ARC record says only."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join([fields['URL'], fields['Archive-date'], str(page_id) if page_id is not None else digest]))}>"


def warc_date(date: str) -> str:
    """An ARC date, of 8 to 14 digits, in ISO form."""
    day = date.ljust(14, "0")
    return f"{day[:4]}-{day[4:6]}-{day[6:8]}T{day[8:10]}:{day[10:12]}:{day[12:14]}Z"


_ARC_RECORD = "page_id long, record_id string, url string, date string, type string, head binary, payload binary, payload_digest string, payload_bytes long"


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _records(content: bytes) -> Iterator[dict]:
    """Whole records of an ARC file, numbered from 0, with WARC identifier, date and payload digest."""
    for number, (fields, block) in enumerate(parse_arc(unpacked(content), [])):
        head, payload = split_block(block)
        page_id, digest = _page_of(head), sha1(payload)
        yield {"number": number, "page_id": page_id, "record_id": record_id(fields, page_id, digest), "url": fields["URL"], "date": warc_date(fields["Archive-date"]),
               "type": fields["Content-type"], "head": head, "payload": payload, "payload_digest": digest, "payload_bytes": len(payload)}


def read_arc(spark: SparkSession, path: str, narrow: bool = False) -> DataFrame:
    """Whole records of ARC files with WARC identifier, date and payload digest.

    ``narrow``: without url, type, header and payload, but with the file and the number of the record in it.
    """
    wanted = "path string, number long, page_id long, record_id string, date string, payload_digest string, payload_bytes long" if narrow else _ARC_RECORD
    names = [x.split()[0] for x in wanted.split(", ")]
    schema = pa.schema([(n, _ARROW[x.split()[1]]) for n, x in zip(names, wanted.split(", "))])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                rows = {n: [] for n in names}
                path_of = file.as_py()
                for row in _records(content.as_py()):
                    row["path"] = path_of
                    for n in names:
                        rows[n].append(row[n])
                yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return _archives(spark, path).mapInArrow(parsed, wanted)


def damaged_arc(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``offset`` and ``reason`` of everything in ARC files that is not in :func:`read_arc`. Files cut within gzip are damaged as a whole."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                damaged: list[tuple[int, str]] = []
                for _ in parse_arc(unpacked(content.as_py(), damaged), damaged):
                    pass
                found += [(file, *d) for d in damaged]
            columns = [pa.array(c, t) for c, t in zip(zip(*found) if found else ([], [], []), (pa.string(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["file", "offset", "reason"])

    return _archives(spark, path).mapInArrow(listed, "file string, offset long, reason string")


_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _warc_record(kind: str, number: str, date: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", number), ("WARC-Date", date), *fields,
             ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode() + block


def _revisits(spark: SparkSession, arc_path: str) -> DataFrame:
    """``path`` and ``number`` of the records of ARC files that are to become revisits, and the identifier of the response they refer to."""
    narrow = staged(read_arc(spark, arc_path, narrow=True), "digests")
    # the largest number of each payload is its response, without numbers the latest; of equal ones the smallest identifier is referred to
    place = F.struct(F.col("page_id").isNull(), -F.col("page_id"), F.when(F.col("page_id").isNull(), -F.unix_seconds(F.to_timestamp("date"))), F.col("record_id"))
    best = narrow.groupBy("payload_digest", "payload_bytes").agg(
        F.max("page_id").alias("best"), F.min_by("record_id", place).alias("refers_to"), F.count("*").alias("n"))
    best = best.where("n > 1").drop("n")
    later = narrow.join(best, ["payload_digest", "payload_bytes"]).where("not page_id <=> best or (best is null and record_id <> refers_to)")
    return staged(later.select("path", "number", "refers_to"), "revisits")


def _marked(spark: SparkSession, arc_path: str) -> DataFrame:
    """ARC files, each with its records that are to become revisits. Files move, as they are, only if there are too many revisits to send to every executor."""
    later = _revisits(spark, arc_path)
    by_file = later.groupBy("path").agg(F.collect_list(F.struct("number", "refers_to")).alias("revisits"))
    return _archives(spark, arc_path).join(F.broadcast(by_file) if later.count() <= BROADCAST_ROWS else by_file, "path", "left")


def convert(spark: SparkSession, arc_path: str, warc_path: str, records: int = RECORDS) -> None:
    """Write the records of ARC files as WARC files."""

    def converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def head(number: int) -> bytes:
            name = f"{part:06d}-{number:06d}.warc"
            own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"
            return _warc_record("warcinfo", own, warc_date(ARCHIVED), [("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"software: searchtide\r\n")

        def found() -> Iterator[dict]:
            for batch in batches:
                for content, revisits in zip(batch.column("content"), batch.column("revisits")):
                    refers_to = {x["number"]: x["refers_to"] for x in revisits.as_py() or []}
                    for row in _records(content.as_py()):
                        row["refers_to"] = refers_to.get(row["number"])
                        yield row

        def record(r: dict, number: int) -> bytes:
            http = bool(r["head"])
            fields = [("WARC-Target-URI", r["url"]), ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}"), (_LENGTH, str(r["payload_bytes"])),
                      ("Content-Type", "application/http;msgtype=response" if http else r["type"])]
            if r["refers_to"] is None:
                return _warc_record("response" if http else "resource", r["record_id"], r["date"], fields, r["head"] + r["payload"])
            fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", r["refers_to"])]
            return _warc_record("revisit", r["record_id"], r["date"], fields, r["head"])

        yield from _files(found(), lambda r: len(r["payload"]), head, record, WARC_END, records)

    _write(_marked(spark, arc_path).mapInArrow(converted, "value string"), WARC_END, warc_path)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, by the declared lengths."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8", errors="replace").split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        length = int(fields["Content-Length"])
        yield fields, content[end + 4 : end + 4 + length]
        at = end + 4 + length + len(WARC_END)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``page_id``, ``record_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to_record`` of page records.

    Block and payload digests are worked out anew and compared with the stated ones.
    """
    wanted = "page_id long, record_id string, payload_bytes long, payload_digest string, record_type string, refers_to_record string"
    names = [x.split()[0] for x in wanted.split(", ")]

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = {n: [] for n in names}
                for fields, block in parse_warc(unpacked(content.as_py())):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    head, payload = split_block(block)
                    page_id, length = _page_of(head), int(fields[_LENGTH])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    whole = fields["WARC-Type"] != "revisit"
                    if fields["WARC-Block-Digest"] != f"sha1:{sha1(block)}" or whole and (len(payload), sha1(payload)) != (length, digest):
                        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                    for n, v in zip(names, (page_id, fields["WARC-Record-ID"], length, digest, fields["WARC-Type"], fields.get("WARC-Refers-To"))):
                        rows[n].append(v)
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([(n, _ARROW[x.split()[1]]) for n, x in zip(names, wanted.split(", "))]))

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parsed, wanted)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archive pages as ARC, convert to WARC, read that: one row per page with the page that a revisit refers to."""
    spark = pages.sparkSession
    arc, warc = new_folder(spark, "arc"), new_folder(spark, "warc")
    write_arc(pages, arc, id_col, url_col, html_col)
    convert(spark, arc, warc)
    found = staged(read_warc(spark, warc), "warc-records")
    origin = found.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to")).distinct()
    revisits = found.where("record_type = 'revisit'").join(origin, "refers_to_record", "left")
    keys = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    plain = found.where("record_type = 'response'").select(*keys, F.lit(None).cast("long").alias("refers_to"))
    return plain.union(revisits.select(*keys, "refers_to"))
