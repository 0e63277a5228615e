"""Operator 11, WARC: archives written from pages and read back, segments
reassembled.

Writing.  Each page becomes a ``response`` record that holds an HTTP message
with a chunked body.  A message longer than ``segment_bytes`` is split: the
first segment is the response itself, the others are ``continuation`` records
that name it as their origin, numbered from 2, the last one with the total
length.  Of pages with equal payloads of at least ``revisit_bytes`` bytes the
one with the largest id is stored; the others become ``revisit`` records, which
name it and have no payload.  Groups are found by hash (SHA-1, another 64 bits
and the length) in an aggregation with partial counts, and only groups of more
than one meet their pages in a join, whose hot keys Spark can split.  Spark's
text writer ends each record with the format's empty lines, into gzip files of
at most ``RECORDS_PER_FILE`` records.

Reading.  A gzip file is read by one task, as a stream of lines that are put
together to the bytes they were, so memory holds a record, not a file.  Records
are framed by ``Content-Length`` alone, whatever their blocks contain.
Unsegmented records are finished there.  Segments are dealt by origin and
sorted by number within partitions; a streaming pass joins neighbours, checks
that the numbers have no gap and that the total length is as the last segment
says, then takes the HTTP message apart and decodes its chunks.

Defined cases: a null payload is empty; a page without id has no id field and
comes back with a null id, and is stored only if no equal payload has an id; a
page without url has no target field; control characters, blanks and characters
beyond ASCII in a url are percent-encoded; rows that repeat id, url and payload
are equal records, each of which comes back; rows that repeat id and payload
under another url revisit the one whose url has the larger hash; further
columns are ignored; an empty table gives an archive without records.  A record
whose segments have a gap, whose length or digest is not as stated or whose
chunks are broken is not ``verified`` and has a null payload; what can't be
read as a record up to the next one has the type ``invalid``.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import cut_lineage, frugal, parts, prepare, query, table
from .words import text_buffer

#: Bytes of a segment's block and of a chunk, records of a file.
SEGMENT_BYTES, CHUNK_BYTES, RECORDS_PER_FILE = 32 << 10, 8 << 10, 50_000
#: Payloads that another record can refer to have so many bytes at least.
REVISIT_BYTES = 1000

VERSION, EOL, GAP = b"WARC/1.1", b"\r\n", b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
#: Fixed values of the format: the profile of a revisit with an equal payload.
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_FIELD = "X-Page-Id"
#: The capture date of records whose pages have none.
DATE = "2000-01-01T00:00:00Z"


def record_id(key: bytes) -> bytes:
    return b"<urn:uuid:%s>" % str(uuid.UUID(bytes=hashlib.md5(key).digest())).encode()


def labelled(hex_digest: str) -> bytes:
    """A SHA-1 digest as the format writes it."""
    return b"sha1:" + base64.b32encode(binascii.unhexlify(hex_digest))


def chunked(payload: bytes, size: int) -> bytes:
    out = []
    for i in range(0, len(payload), size):
        piece = payload[i:i + size]
        out += [b"%x\r\n" % len(piece), piece, EOL]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if its framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(EOL, at)
        if end < 0:
            return None
        head = bytes(body[at:end]).split(b";")[0].strip()    # what follows is an extension
        if not re.fullmatch(rb"[0-9A-Fa-f]+", head):
            return None
        n, at = int(head, 16), end + 2
        if n == 0:                                           # trailer fields may follow
            return b"".join(out) if body[at:at + 2] == EOL or body.find(GAP, at) >= 0 else None
        if body[at + n:at + n + 2] != EOL:
            return None
        out.append(body[at:at + n])
        at += n + 2


def http_payload(block: bytes) -> bytes | None:
    """Body of an HTTP message, transfer coding undone; None if it is broken."""
    end = block.find(GAP)
    if end < 0:
        return None
    head = bytes(block[:end]).lower()
    body = block[end + 4:]
    return unchunked(body) if re.search(rb"\ntransfer-encoding:[^\n]*\bchunked\b", head) else bytes(body)


def _uri(url: str) -> bytes:
    return re.sub(rb"[^\x21-\x7E]", lambda m: b"%%%02X" % m[0][0], url.encode())


def record(fields: list[tuple[str, bytes]], block: bytes) -> bytes:
    """A record without the empty lines after it, which the writer adds."""
    head = b"".join(k.encode() + b": " + v + EOL for k, v in fields)
    return b"".join([VERSION, EOL, head, b"Content-Length: %d" % len(block), GAP, block])


def page_records(page_id, url, key: str, digest: str, payload: bytes, refers: str | None, segment_bytes: int,
                 chunk_bytes: int):
    """The records of one page; ``key`` and ``refers`` name it and the page
    that it revisits."""
    own = record_id(key.encode())
    fields = [("WARC-Date", DATE.encode()), ("WARC-Payload-Digest", labelled(digest))]
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    if page_id is not None:
        fields.append((ID_FIELD, b"%d" % page_id))
    if refers is not None:
        yield record([("WARC-Type", b"revisit"), ("WARC-Record-ID", own),
                      ("WARC-Refers-To", record_id(refers.encode())), ("WARC-Profile", PROFILE), *fields], b"")
        return
    fields.append(("Content-Type", b"application/http;msgtype=response"))
    block = HTTP + chunked(payload, chunk_bytes)
    pieces = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = [("WARC-Segment-Number", b"1")] if len(pieces) > 1 else []
    yield record([("WARC-Type", b"response"), ("WARC-Record-ID", own), *fields, *first], pieces[0])
    for k, piece in enumerate(pieces[1:], 2):
        last = [("WARC-Segment-Total-Length", b"%d" % len(block))] if k == len(pieces) else []
        yield record([("WARC-Type", b"continuation"), ("WARC-Record-ID", record_id(b"%s/%d" % (key.encode(), k))),
                      ("WARC-Date", DATE.encode()), ("WARC-Segment-Origin-ID", own),
                      ("WARC-Segment-Number", b"%d" % k), *last], piece)


def _key(page_id: Column, url_hash: Column, digest: Column) -> Column:
    return F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("-")), url_hash.cast("string"), digest)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
               revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write the pages' records to gzip archives in the folder ``path``."""
    prepare(pages.sparkSession)
    payload = F.coalesce(pages[payload_col].cast("binary"), F.lit(b""))
    p = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                     payload.alias("payload"))
    p = p.select("*", F.sha1("payload").alias("digest"), F.xxhash64("payload").alias("more"),
                 F.octet_length("payload").alias("size"), F.xxhash64("url").alias("url_hash"))
    own = F.struct(F.col("page_id").isNotNull().alias("named"), F.coalesce("page_id", F.lit(0)).alias("id"),
                   F.col("url_hash").alias("url"))
    same = ["digest", "more", "size"]
    groups = (p.where(F.col("size") >= revisit_bytes).groupBy(*same)
              .agg(F.max(own).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    d = p.join(groups, same, "left")
    best_id = F.when(F.col("best.named"), F.col("best.id"))
    refers = F.when(own < F.col("best"), _key(best_id, F.col("best.url"), F.col("digest")))
    d = d.select("page_id", "url", _key(F.col("page_id"), F.col("url_hash"), F.col("digest")).alias("key"), "digest",
                 F.when(refers.isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"),
                 refers.alias("refers"))

    def run(batches):
        for batch in batches:
            out, size = [], 0
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                for x in page_records(*row, segment_bytes, chunk_bytes):
                    out.append(x)
                    size += len(x)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    (d.mapInArrow(frugal(run), "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", GAP.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


class Stream:
    """Records of one file's bytes, as they come."""

    def __init__(self):
        self.held, self.need = bytearray(), 0

    def feed(self, data) -> list[tuple[dict | None, bytes]]:
        self.held += data
        out, at = [], 0
        while len(self.held) - at >= max(self.need, 1):
            held = self.held
            while held[at:at + 2] == EOL:                    # empty lines after a record
                at += 2
            if held[at:at + 5] != b"WARC/"[:len(held) - at]:
                end = held.find(GAP + b"WARC/", at)
                if end < 0:
                    self.need = len(held) - at + 1
                    break
                out.append((None, bytes(held[at:end])))
                at = end + 4
                continue
            end = held.find(GAP, at)
            if end < 0:
                self.need = len(held) - at + 1
                break
            fields = dict(_fields(bytes(held[at:end])))
            size = fields.get("content-length", "")
            if not size.isdigit():
                nxt = held.find(GAP + b"WARC/", end)
                if nxt < 0:
                    self.need = len(held) - at + 1
                    break
                out.append((None, bytes(held[at:nxt])))
                at = nxt + 4
                continue
            stop = end + 4 + int(size)
            if stop > len(held):
                self.need = stop - at
                break
            out.append((fields, bytes(held[end + 4:stop])))
            at, self.need = stop, 0
        del self.held[:at]
        return out

    def rest(self) -> list[tuple[dict | None, bytes]]:
        """What the file broke off in."""
        left = bytes(self.held).strip(EOL)
        return [(None, left)] if left else []


def _fields(head: bytes):
    for line in head.split(EOL)[1:]:
        k, colon, v = line.partition(b":")
        if colon:
            yield k.decode("latin-1").strip().lower(), v.decode("utf-8", "replace").strip()


_SEGMENT = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()),
                      ("page_id", pa.int64()), ("refers_to", pa.string()), ("digest", pa.string()),
                      ("number", pa.int64()), ("total", pa.int64()), ("block", pa.binary())])
SEGMENT = ("record_id string, type string, target_uri string, page_id long, refers_to string, digest string, "
           "number long, total long, block binary")
_RECORD = pa.schema([*list(_SEGMENT)[:5], ("payload", pa.binary()), ("verified", pa.bool_())])
RECORD = "record_id string, type string, target_uri string, page_id long, refers_to string, payload binary, verified boolean"


def _long(x: str | None):
    n = int(x) if x is not None and re.fullmatch(r"-?[0-9]{1,19}", x) else None
    return n if n is not None and -1 << 63 <= n < 1 << 63 else None


def _segment(fields, block):
    if fields is None:
        return (None, "invalid", None, None, None, None, None, None, None)
    get = fields.get
    return (get("warc-segment-origin-id") or get("warc-record-id"), get("warc-type"), get("warc-target-uri"),
            _long(get(ID_FIELD.lower())), get("warc-refers-to"), get("warc-payload-digest"),
            _long(get("warc-segment-number")), _long(get("warc-segment-total-length")), block)


def _finished(row, block: bytes | None):
    """A record's row from its whole block."""
    *head, digest, _, _, _ = row
    if row[1] == "response":
        payload = http_payload(block) if block is not None else None
    else:
        payload = block if row[1] != "invalid" else None
    fine = payload is not None
    if fine and row[1] == "response" and digest is not None and digest.startswith("sha1:"):
        fine = labelled(hashlib.sha1(payload).hexdigest()).decode() == digest
    return (*head, payload if fine else None, fine)


def _table(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _parsed(segmented: bool):
    """Rows of the records: of the segments, or of the others, finished."""
    def rows(found):
        for fields, block in found:
            row = _segment(fields, block)
            if (row[6] is not None) == segmented:
                yield row if segmented else _finished(row, block)

    def run(batches):
        file, stream, out, size = None, Stream(), [], 0
        schema = _SEGMENT if segmented else _RECORD

        def pieces():
            nonlocal file, stream
            for batch in batches:
                names = batch.column(0).to_numpy()
                buf, offs = text_buffer(batch.column(1))
                a = 0
                while a < len(names):
                    other = (names[a:] != names[a]).argmax()
                    z = a + int(other) if other else len(names)
                    if names[a] != file:
                        yield from rows(stream.rest())
                        file, stream = names[a], Stream()
                    yield from rows(stream.feed(buf[offs[a]:offs[z]].tobytes()))
                    a = z
            yield from rows(stream.rest())

        for row in pieces():
            out.append(row)
            size += len(row[8 if segmented else 5] or b"")
            if size > 4 << 20 or len(out) >= 5000:
                yield _table(out, schema)
                out, size = [], 0
        if out:
            yield _table(out, schema)
    return run


def joined(rows: list[tuple]) -> list[tuple]:
    """The records of one origin's segments, sorted by number: one for each
    time that all segments occur."""
    blocks: dict[int, bytes] = {}
    times: dict[int, int] = {}
    for r in rows:
        times[r[6]] = times.get(r[6], 0) + 1
        if blocks.setdefault(r[6], r[8]) != r[8]:
            times[r[6]] = -len(rows)                         # told apart by no copy
    head = next((r for r in rows if r[6] == 1), (*rows[0][:1], "invalid", *rows[0][2:]))
    total = next((r[7] for r in rows if r[7] is not None), None)
    whole = (sorted(blocks) == list(range(1, len(blocks) + 1)) and min(times.values()) > 0
             and sum(map(len, blocks.values())) == total)
    block = b"".join(blocks[k] for k in sorted(blocks)) if whole else None
    return [_finished(head, block)] * max(1, min(times.values()))


def _reassembled(batches):
    held: list[tuple] = []
    for batch in batches:
        out = []
        for row in zip(*(batch.column(i).to_pylist() for i in range(len(_SEGMENT)))):
            if held and held[0][0] != row[0]:
                out += joined(held)
                held = []
            held.append(row)
        if out:
            yield _table(out, _RECORD)
    if held:
        yield _table(joined(held), _RECORD)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_id, type, target_uri, page_id (the extension field), refers_to (a
    record id), payload and verified: one row per record of the gzip archives
    in ``path``, segments put together."""
    prepare(spark)
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.concat("value", F.lit("\n")).cast("binary").alias("line"))
    whole = lines.mapInArrow(frugal(_parsed(False)), RECORD)
    split = (lines.mapInArrow(frugal(_parsed(True)), SEGMENT).repartition(parts(spark), "record_id")
             .sortWithinPartitions("record_id", "number"))
    return whole.unionAll(split.mapInArrow(frugal(_reassembled), RECORD))


ORACLE = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS best FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id < best THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id < best THEN best END AS refers_to
FROM k
"""


@query("op11_warc", ORACLE)
def op11_warc(spark, sf_dir):
    """All pages written to archives and read back; revisits are resolved
    through the records they refer to."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_warc(table(spark, sf_dir, "pages"), path)
    r = cut_lineage(read_warc(spark, path).select(
        "record_id", "type", "page_id", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest")))
    stored = r.where("type = 'response'")
    whole = stored.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                          F.lit(None).cast("long").alias("refers_to"))
    named = stored.dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("of"), "payload_bytes", "payload_digest")
    again = r.where("type = 'revisit'").select("page_id", "type", "refers_to").join(named, "refers_to", "left")
    return whole.unionByName(again.select("page_id", "payload_bytes", "payload_digest",
                                          F.col("type").alias("record_type"), F.col("of").alias("refers_to")))
