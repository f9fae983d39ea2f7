"""WARC archives of pages: written, normalised to a gzip member for each record, and read by offset.

Spark's text writer makes the archives: a record is a row, records end as lines do, and a file is one gzip
stream, as crawlers that compress whole files leave it. Such a monolithic file can only be read from its start.
The normaliser inflates it once, in chunks, and writes each record as a gzip member of its own, with an index beside
the archive (a JSON line a record: offset, length, type, ids). From then on any range of records is a task's
work: the index is dealt out by place, and a task seeks to its members.

Archives are opened by pyarrow's file systems (local, S3, GCS, HDFS), so they lie in a folder that these reach; pages are read by Spark.
A task writes under a hidden name and renames at the end; a second attempt makes the same bytes, so lost executors do no harm.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import opened, qualified
from .store import saved
from .text import trimmed

#: Fewest bytes of a payload that is kept once and referred to.
LEAST = 1000
#: Bytes read and inflated at a time.
CHUNK = 1 << 20
#: Bytes of archives that a reading task gets, about.
TASK_BYTES = 64 << 20
#: Records of a monolithic file at most, as a crawler begins a new file after a while.
FILE_RECORDS = 50_000
END = "\r\n\r\n"

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, offset long, length long, record_type string, record_id string, target_uri string"
MANIFEST = "source string, archive string, records long, bytes long, error string"
RECORD = "page_id long, target_uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


class Broken(ValueError):
    """An archive that doesn't hold what WARC asks for."""


# ---- writing


def roles(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Pages with ``payload`` (html, null as empty), ``digest`` (SHA-1), ``size`` in bytes, ``first`` (the response's id where the row is a revisit).

    Only groups of equal payloads are written and joined; the largest id of a group is the response. Rows that have
    it twice are responses both; a null id revisits, unless all are null, which makes them responses.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.col("url") if "url" in pages.columns else F.lit(None)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    # equal payloads have equal strong hashes; SHA-1 alone could be made to agree
    rows = rows.withColumn("same", F.sha2(F.col("payload").cast("binary"), 256))
    groups = rows.filter(F.col("size") >= least).groupBy("same").agg(F.max("page_id").alias("newest"), F.count("*").alias("many")).filter("many > 1 AND newest IS NOT NULL")
    found = rows.join(saved(groups.select("same", "newest")), "same", "left")
    return found.withColumn("first", F.when(~F.col("newest").eqNullSafe(F.col("page_id")), F.col("newest"))).select("page_id", "url", "payload", "size", "digest", "first")


def _field(name: str, value: Column | str) -> Column:
    """A header line; none for a null value, and no control characters, which could begin another line."""
    value = F.lit(value) if isinstance(value, str) else value
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\x00-\x1F\x7F]", ""), F.lit("\r\n")), F.lit(""))


def _urn(page_id: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit(">"))


def record(date: str) -> Column:
    """A page's record without its end, from the columns of ``roles``: a response with an HTTP head, or a revisit that has only this head."""
    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")), _field("WARC-Record-ID", _urn("page_id")), _field("WARC-Date", date),
        _field("WARC-Target-URI", F.col("url")), _field("WARC-Profile", F.when(revisit, PROFILE)), _field("WARC-Refers-To", F.when(revisit, _urn("first"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), _field("Content-Type", "application/http; msgtype=response"),
        _field("Content-Length", F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))), F.lit("\r\n"),
    )
    return F.concat(head, http, F.when(revisit, "").otherwise(F.col("payload")))


def write(pages: DataFrame, folder: str, least: int = LEAST, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes a record for every row of pages (page_id, url if there is one, html) to monolithic gzip files in a new folder; see ``roles`` for what revisits what."""
    rows = roles(pages, least).select(record(date).alias("value"))
    rows.write.option("compression", "gzip").option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS).text(folder)


# ---- one stream, record by record


class Inflated:
    """Bytes of a file that is one gzip stream or several, inflated as they are asked for; holds a chunk at a time."""

    def __init__(self, source) -> None:
        self.source, self.engine, self.rest, self.done, self.inflated = source, None, b"", False, bytearray()

    def fill(self) -> bool:
        """Adds bytes to ``inflated``; false at the file's end."""
        while not self.done:
            given = self.rest or self.source.read(CHUNK)
            self.rest = b""
            if not given:
                self.done = True
                if self.engine is not None:
                    raise Broken("the gzip stream ends early")
                break
            if self.engine is None:
                self.engine = zlib.decompressobj(31)
            out = self.engine.decompress(given, CHUNK)
            if self.engine.eof:
                self.rest, self.engine = self.engine.unused_data, None
            else:
                self.rest = self.engine.unconsumed_tail
            if out:
                self.inflated += out
                return True
        return False

    def head(self, most: int = 1 << 20) -> bytes | None:
        """Bytes to the next empty line, with it; None at the file's end."""
        seen = 0
        while (at := self.inflated.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(self.inflated)
            if seen > most:
                raise Broken("a record's head has no end")
            if not self.fill():
                if self.inflated.strip(b"\r\n"):
                    raise Broken("the file ends in a record's head")
                return None
        found = bytes(self.inflated[: at + 4])
        del self.inflated[: at + 4]
        return found

    def block(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes, in chunks."""
        while length:
            if not self.inflated and not self.fill():
                raise Broken("the file ends in a record's block")
            part = bytes(self.inflated[: min(length, CHUNK)])
            del self.inflated[: len(part)]
            length -= len(part)
            yield part

    def end(self) -> None:
        """Passes over the empty lines after a record."""
        while True:
            k = 0
            while k < len(self.inflated) and self.inflated[k] in b"\r\n":
                k += 1
            del self.inflated[:k]
            if self.inflated or not self.fill():
                return


def fields(head: bytes) -> dict[str, str]:
    """Names (lower case) and values of a head's lines; lines that begin with a blank go on with the value before."""
    first, *lines = head.decode("utf-8", "replace").rstrip("\r\n").split("\r\n")
    if not first.startswith("WARC/"):
        raise Broken(f"not a WARC record: {first[:40]!r}")
    found: dict[str, str] = {}
    name = ""
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            found[name] = value.strip()
    if not found.get("content-length", "").isdigit():
        raise Broken("a record without Content-Length")
    return found


def members(source, target, level: int = 6) -> Iterator[tuple[int, int, dict[str, str]]]:
    """Copies the records of one gzipped WARC stream to ``target``, each as a gzip member; yields (offset, length, fields) of each once it is written whole."""
    stream, offset = Inflated(source), 0
    stream.end()
    while (head := stream.head()) is not None:
        known = fields(head)
        deflate, length = zlib.compressobj(level, zlib.DEFLATED, 31), 0
        for part in chain((head,), stream.block(int(known["content-length"]))):
            length += target.write(deflate.compress(part))
        length += target.write(deflate.compress(b"\r\n\r\n") + deflate.flush())
        yield offset, length, known
        offset += length
        stream.end()


# ---- normalising


def _normalised(source: str, folder: str, level: int, strict: bool) -> tuple[str, int, int, str | None]:
    store, place = opened(source)
    target, base = opened(folder)
    target.create_dir(base)
    name = f"{source.rstrip('/').rpartition('/')[2].partition('.')[0]}-{hashlib.sha1(source.encode()).hexdigest()[:12]}.warc.gz"
    archive, index = f"{base}/{name}", f"{base}/{name}.index.jsonl"
    hidden = f"{base}/_{uuid.uuid4().hex}"
    records = size = 0
    error = None
    with store.open_input_stream(place, compression=None, buffer_size=CHUNK) as given, target.open_output_stream(f"{hidden}.gz", compression=None, buffer_size=CHUNK) as out, target.open_output_stream(f"{hidden}.jsonl", compression=None, buffer_size=CHUNK) as notes:
        try:
            for offset, length, known in members(given, out, level):
                row = {"archive": f"{folder}/{name}", "offset": offset, "length": length, "record_type": known.get("warc-type"), "record_id": known.get("warc-record-id"), "target_uri": known.get("warc-target-uri")}
                notes.write(json.dumps(row).encode() + b"\n")
                records, size = records + 1, offset + length
        except (Broken, zlib.error) as broken:
            if strict:
                raise
            error = f"after {records} records: {broken}"
    target.move(f"{hidden}.gz", archive)
    target.move(f"{hidden}.jsonl", index)  # last: an archive with its index is whole
    return f"{folder}/{name}", records, size, error


def normalise(spark: SparkSession, source: str, folder: str, level: int = 6, strict: bool = True) -> DataFrame:
    """Rewrites every *.gz file below ``source`` with a gzip member a record and an index beside it, and returns (source, archive, records, bytes, error).

    A file is a task's work, in chunks, so memory doesn't follow its length. Records of any type are copied as they are. A
    file that is cut off or isn't WARC is an error; with ``strict`` false its whole records are kept, and ``error`` says where it broke.
    A stream of nothing gives an archive without records; a file of no bytes and an empty folder give no rows.
    """
    folder = qualified(spark, folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(source).select("path")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield pa.RecordBatch.from_pylist([dict(zip(("source", "archive", "records", "bytes", "error"), (path, *_normalised(path, folder, level, strict)), strict=True))], schema=_MANIFEST)

    return saved(files.repartition(max(1, files.count())).mapInArrow(trimmed(rows), MANIFEST))


_MANIFEST = pa.schema([("source", pa.string()), ("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("error", pa.string())])
_RECORD = pa.schema([("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


# ---- reading


def page_of(urn: str | None) -> int | None:
    """The page of a record id as ``write`` makes them; None for other ids."""
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text.lstrip("-").isdigit() and (urn or "").startswith("<urn:page:") else None


def parsed(member: bytes, payload: bool) -> dict:
    """A row of RECORD from one gzip member. The digest and length of a response are those of its bytes and must be as declared; a revisit has the declared ones."""
    stream = Inflated(io.BytesIO(member))
    known = fields(stream.head() or b"")
    block = b"".join(stream.block(int(known["content-length"])))
    http, found, body = block.partition(b"\r\n\r\n")
    declared = known.get("warc-payload-digest", "").removeprefix("sha1:")
    row = {"page_id": page_of(known.get("warc-record-id")), "target_uri": known.get("warc-target-uri"), "record_type": known["warc-type"], "refers_to": page_of(known.get("warc-refers-to"))}
    if row["record_type"] == "revisit":
        lengths = [v for n, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")) if n.lower() == "content-length"]
        return row | {"payload_bytes": int(lengths[0]) if lengths else None, "payload_digest": declared or None, "payload": None}
    if not known.get("content-type", "").startswith("application/http"):
        body = block
    digest = hashlib.sha1(body).hexdigest()
    if declared and declared != digest:
        raise Broken(f"record {known.get('warc-record-id')}: payload digest {digest}, declared {declared}")
    return row | {"payload_bytes": len(body), "payload_digest": digest, "payload": body if payload else None}


def read(spark: SparkSession, folder: str, payload: bool = True, types: tuple[str, ...] = ("response", "revisit", "resource")) -> DataFrame:
    """Rows of RECORD for the records of these types in the indexed archives of a folder; payload is null if not asked for, and for revisits.

    Only the index is dealt out, in ranges of archive and offset of about ``TASK_BYTES`` of archives; a task opens an archive once for its range.
    """
    index = spark.read.schema(INDEX).option("pathGlobFilter", "*.index.jsonl").json(folder).filter(F.col("record_type").isin(*types)).select("archive", "offset", "length")
    size = index.agg(F.sum("length")).first()[0] or 0
    spots = index.repartitionByRange(max(1, size // TASK_BYTES, spark.sparkContext.defaultParallelism), "archive", "offset").sortWithinPartitions("archive", "offset")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, file = None, None
        try:
            for batch in batches:
                out, volume = [], 0
                for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                    if archive != last:
                        if file:
                            file.close()
                        store, place = opened(archive)
                        last, file = archive, store.open_input_file(place)
                    out.append(parsed(file.read_at(length, offset), payload))
                    volume += out[-1]["payload_bytes"] or 0 if payload else 200
                    if volume > CHUNK:
                        yield pa.RecordBatch.from_pylist(out, schema=_RECORD)
                        out, volume = [], 0
                yield pa.RecordBatch.from_pylist(out, schema=_RECORD)
        finally:
            if file:
                file.close()

    return spots.mapInArrow(trimmed(rows), RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """Records of ``read`` with the payload of the response that a revisit refers to; a revisit whose response is missing keeps a null payload.

    The responses that are referred to are looked up by id and digest, once each.
    """
    known = records.filter("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload").alias("whole")).dropDuplicates(["refers_to", "payload_digest"])
    wanted = records.filter("record_type = 'revisit'").join(saved(known), ["refers_to", "payload_digest"], "left")
    return records.filter("record_type <> 'revisit'").unionByName(wanted.withColumn("payload", F.col("whole")).drop("whole"))
