"""WARC archives: written with an index first, read back by coalesced byte ranges.

The index has a row per record: file, offset, length, URL, digest of the payload, type, and the identifier
of the page that a revisit refers to. Digests come from a narrow scan; of payloads that are equal and not
small, the row with the largest identifier is the response. The rows of such groups are few columns wide and
aggregated before they move; they are broadcast while their number is small and else joined by digest, where
Spark splits a digest that many rows share. Each task then writes one archive, a gzip member per record, and
hands on its records' index rows. Only rows of tasks that succeeded reach the index; a repeated task writes
another file, and what a lost one has left is in no index.

Reading takes index rows, selected in any way, sorts them by file and offset, and deals them by ranges. A
task joins neighbouring ranges, with small gaps between them, to one read of a few megabytes, and cuts the
records out of it. A record's header says how long it is; the payload's digest is computed anew and compared.

Archives lie in the session's shared folder, or any folder that pyarrow's file systems know.

Cases: null html is an empty payload; null and repeated URLs are kept, a null one has no target; line breaks in
URLs are percent-encoded; null identifiers have no page field and are smallest; of rows that are wholly equal
one is the response and the others revisit it; long pages are whole; an empty table gives an empty index;
other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.shared import new_path, stored

#: Payloads from this size on are archived once.
REVISIT_FROM = 1000
#: Groups of equal payloads that are broadcast at most.
BROADCAST_GROUPS = 50_000
#: Bytes of an archive, of one read, of a gap that a read spans, and of what one task reads.
FILE_BYTES, READ_BYTES, GAP_BYTES, TASK_BYTES = 1 << 30, 4 << 20, 64 << 10, 16 << 20
INDEX = "id {kind}, url string, file string, offset long, length long, payload_bytes long, digest string, record_type string, refers_to {kind}"
RECORD = "id {kind}, url string, record_type string, refers_to {kind}, payload binary, payload_bytes long, digest string"
_DATE = "2000-01-01T00:00:00Z"


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


def header_value(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(page: str | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: str | None, revisit: bool, serial: str) -> bytes:
    """One record: a response, or a revisit, which has the response's HTTP header (with the payload's size) without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    shared = record_id("response", refers_to if revisit else page, digest)
    own = shared if not revisit and size >= REVISIT_FROM else record_id(serial)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), ("WARC-Date", _DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        fields.append(("WARC-Target-URI", header_value(url)))
    if page is not None:
        fields.append(("Page-ID", page))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", shared)]
        if refers_to is not None:
            fields.append(("Refers-To-Page-ID", refers_to))
    body = http if revisit else http + payload
    fields.append(("Content-Length", str(len(body))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + body + b"\r\n\r\n"


def parsed(record: bytes) -> dict[str, object]:
    """The fields of RECORD. ValueError for what isn't a whole record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    if not first.startswith("WARC/1.") or len(rest) != int(fields["Content-Length"]) + 4:
        raise ValueError(f"not a record: {first[:80]}")
    http, _, payload = rest[:-4].partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload and digest differ: {fields['WARC-Record-ID']}")
    return {"id": fields.get("Page-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "refers_to": fields.get("Refers-To-Page-ID"), "payload": None if revisit else payload, "payload_bytes": size, "digest": digest}


def opened(folder: str) -> tuple[pa.fs.FileSystem, str]:
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder)


def planned(pages: DataFrame, id_col: str, url_col: str, html_col: str, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """id, url, html (null: revisit), n (its bytes), digest, record_type, refers_to: what is to be written."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("n"))
    seen = rows.filter(F.col("n") >= REVISIT_FROM).groupBy("digest", "id", "url").agg(F.count(F.lit(1)).alias("copies"))
    groups = stored(seen.groupBy("digest").agg(F.max(F.struct("id", F.struct("url").alias("at"), "copies")).alias("top"), F.sum("copies").alias("members")).filter("members > 1").select("digest", F.col("top.id").alias("top_id"), F.col("top.at.url").alias("top_url"), F.col("top.copies").alias("copies"), F.lit(True).alias("grouped")), "payload-groups")
    few = groups.limit(broadcast_groups + 1).count() <= broadcast_groups
    joined = rows.join(F.broadcast(groups) if few else groups, "digest", "left")
    top = F.col("grouped") & F.col("id").eqNullSafe(F.col("top_id")) & F.col("url").eqNullSafe(F.col("top_url"))
    revisit = F.coalesce(F.col("grouped") & ~top, F.lit(False))
    kept = ["id", "url", F.when(~revisit, F.col("html")).alias("html"), "n", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("top_id")).alias("refers_to")]
    repeated = groups.filter("copies > 1")
    if repeated.isEmpty():
        return joined.select(*kept)
    # Rows that are wholly equal to a group's first: one is the response, and its copies revisit it.
    again = F.coalesce(top & (F.col("copies") > 1), F.lit(False))
    once = joined.filter(again).groupBy("digest").agg(F.first("id").alias("id"), F.first("url").alias("url"), F.first("html").alias("html"), F.first("n").alias("n"), F.first("copies").alias("copies"), F.first("top_id").alias("top_id"))
    turns = once.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    copies = turns.select("id", "url", F.when(F.col("turn") == 1, F.col("html")).alias("html"), "n", "digest", F.when(F.col("turn") == 1, "response").otherwise("revisit").alias("record_type"), F.when(F.col("turn") > 1, F.col("top_id")).alias("refers_to"))
    return joined.filter(~again).select(*kept).unionByName(copies)


def write_archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write every row as a record below folder (default: a new one in the shared folder); the index, stored."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    kind = pages.schema[id_col].dataType.simpleString()
    plan = planned(pages, id_col, url_col, html_col).withColumn("page", F.col("id").cast("string")).withColumn("target", F.col("refers_to").cast("string"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = opened(folder)
        out, name, at = None, "", 0
        for batch in batches:
            offsets, lengths, files = [], [], []
            for html, size, page, url, digest, target, type_ in zip(*(batch.column(c) for c in ("html", "n", "page", "url", "digest", "target", "record_type"))):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    where.create_dir(base, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = where.open_output_stream(f"{base}/{name}", compression=None)
                payload = (html.as_py() or "").encode()
                member = gzip.compress(record_bytes(page.as_py(), url.as_py(), payload, size.as_py(), digest.as_py(), target.as_py(), type_.as_py() == "revisit", f"{name}/{at}"), 2, mtime=0)
                out.write(member)
                offsets.append(at)
                lengths.append(len(member))
                files.append(name)
                at += len(member)
            columns = [batch.column("id"), batch.column("url"), pa.array([f"{folder}/{f}" for f in files], pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), batch.column("n"), batch.column("digest"), batch.column("record_type"), batch.column("refers_to")]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "url", "file", "offset", "length", "payload_bytes", "digest", "record_type", "refers_to"])
        if out is not None:
            out.close()

    return stored(plan.mapInArrow(write, INDEX.format(kind=kind)), "warc-index")


def ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """(file, start, end, [(offset, length)]) of reads that cover rows (file, offset, length), which are in order."""
    held: list[tuple[int, int]] = []
    name, start, end = "", 0, 0
    for file, offset, length in rows:
        if held and (file != name or offset > end + GAP_BYTES or max(end, offset + length) > start + READ_BYTES):
            yield name, start, end, held
            held = []
        if not held:
            name, start, end = file, offset, offset
        held.append((offset, length))
        end = max(end, offset + length)
    if held:
        yield name, start, end, held


def read_records(selected: DataFrame) -> DataFrame:
    """The records of index rows, one each: id, url, record_type, refers_to, payload (null: revisit), payload_bytes, digest."""
    kind = selected.schema["id"].dataType.simpleString()
    names = [x.split()[0] for x in RECORD.split(", ")]
    schema = RECORD.format(kind="string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            found: list[dict[str, object]] = []
            room, source, name = 0, None, ""
            for file, start, end, parts in ranges(rows):
                if source is None or file != name:
                    if source is not None:
                        source.close()
                    folder, _, name = file.rpartition("/")
                    where, base = opened(folder)
                    source, name = where.open_input_file(f"{base}/{name}"), file
                data = source.read_at(end - start, start)
                for offset, length in parts:
                    record = parsed(gzip.decompress(data[offset - start : offset - start + length]))
                    found.append(record)
                    room += len(record["payload"] or b"") + 200
                    if room > 4 * READ_BYTES:
                        yield pa.RecordBatch.from_pylist(found, schema=arrow)
                        found, room = [], 0
            if source is not None:
                source.close()
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=arrow)

    arrow = pa.schema([(n, pa.binary() if n == "payload" else pa.int64() if n == "payload_bytes" else pa.string()) for n in names])
    places = selected.select("file", "offset", "length")
    # As many tasks as the records' bytes ask for; the rows that say where they lie are too few to tell.
    tasks = 1 + (places.agg(F.sum("length").alias("n")).first()["n"] or 0) // TASK_BYTES
    placed = places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(read, schema).withColumn("id", F.col("id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))
