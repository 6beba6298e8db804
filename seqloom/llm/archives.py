"""Web archives: pages as legacy ARC files, their conversion to WARC, and WARC files read back.

An ARC file is a version block and, for each document, a header line of the fields that the version names, the last of
them the length of what follows. The converter reads headers by the file's version (URLs may hold spaces, so fields are
counted from the right), takes bodies by their declared lengths, and makes of each a WARC record of the same
content: an identifier from the file's name and the record's number, the moment in ISO form, the type by what the record
is (warcinfo for the version block, response for HTTP and DNS answers, resource for all else), and SHA-1 digests of block
and payload. Of responses with equal payloads of ``LEAST`` bytes and more, one is stored and the others refer to it.

Files of both kinds are compressed record by record and written by tasks to the shared folder, each under a name of
its attempt; Spark's commit of the manifest decides which count. Shards are partitions of the table, so none is gathered;
of equal payloads, however many, partial maxima leave each task.

Defined results: null html is an empty payload, null urls are urn:none, white space and control characters in urls are
percent-encoded; a null page_id comes back as null and counts as the smallest; of repeated rows with equal payloads one is
the response. Payloads of any length are taken whole; columns other than page_id, url and html are not read; an
empty table gives no files and no rows. A file that ends before a declared length is an error.
"""

from __future__ import annotations

import base64
import hashlib
import io
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm import files
from seqloom.llm.common import BROADCAST_ROWS, shared_dir, ship, small, staged

#: Payloads of fewer bytes are stored each time.
LEAST = 1000
# The fields of a header line in the two versions of ARC.
FIELDS = {1: ["url", "ip", "date", "kind", "length"], 2: ["url", "ip", "date", "kind", "code", "checksum", "location", "offset", "filename", "length"]}
ARC_NAMES = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
# Fixed value: the profile of WARC 1.1 for records whose payload is stored elsewhere.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK = re.compile(rb"\r?\n\r?\n")


def squeezed(record: bytes) -> bytes:
    """A gzip member of its own."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def members(data: pa.Buffer) -> Iterator[bytes]:
    """What a file holds, a gzip member at a time, or whole where it is not compressed."""
    view = memoryview(data)
    if bytes(view[:2]) != b"\x1f\x8b":
        yield bytes(view)
        return
    at = 0
    while at < len(view):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            piece = view[at : at + (1 << 16)]
            if not len(piece):
                raise ValueError("a compressed record is cut off")
            parts.append(z.decompress(piece))
            at += len(piece) - len(z.unused_data)
        yield b"".join(parts)


# ARC


def arc_header(version: int, **field) -> bytes:
    return " ".join(str(field[f]) for f in FIELDS[version]).encode() + b"\n"


def clean(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:none"


def arc_name(shard: int) -> str:
    return f"pages-{shard:08d}.arc.gz"


def write_arc(pages: DataFrame, versions: tuple[int, ...] = (1, 2), moment: str = "20000101000000") -> DataFrame:
    """Write every row as the answer to a request for its page; return the manifest (shard, arc, name, n). Shards take turns with
    the versions. The pages have no times, so all have ``moment``."""
    ship(pages.sparkSession)
    root = shared_dir(pages.sparkSession, "arc")

    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        version, name, n, at = versions[shard % len(versions)], arc_name(shard), 0, 0

        def records():
            nonlocal n, at
            about = f"{version} 0 seqloom\n{ARC_NAMES[version]}\n\n".encode()
            head = arc_header(version, url=f"filedesc://{name}", ip="0.0.0.0", date=moment, kind="text/plain", code=200, checksum="-", location="-", offset=0, filename=name, length=len(about))
            yield (z := squeezed(head + about))
            at += len(z)
            for b in small(rows):
                for r in b.to_pylist():
                    payload = (r["html"] or "").encode()
                    mark = "" if r["page_id"] is None else f"X-Page-Id: {r['page_id']}\r\n"
                    answer = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                    head = arc_header(version, url=clean(r["url"]), ip="0.0.0.0", date=moment, kind="text/html", code=200, checksum="-", location="-", offset=at, filename=name, length=len(answer))
                    yield (z := squeezed(head + answer + b"\n"))
                    at += len(z)
                    n += 1

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        rows = itertools.chain([first], batches)
        path = files.write(f"{root}/{name}", records())
        yield pa.RecordBatch.from_pylist([{"shard": shard, "arc": path, "name": name, "n": n}], pa.schema([("shard", pa.int32()), ("arc", pa.string()), ("name", pa.string()), ("n", pa.int64())]))

    told = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return staged(told.mapInArrow(run, "shard int, arc string, name string, n long"), "arc-manifest")


@dataclass(frozen=True)
class Record:
    """A record of an ARC file: what its header line says, and its body."""

    url: str
    ip: str
    date: str
    kind: str
    body: bytes

    @property
    def type(self) -> str:
        if self.url.startswith("filedesc:"):
            return "warcinfo"
        return "response" if self.body.startswith(b"HTTP/") or self.url.startswith("dns:") else "resource"

    @property
    def head(self) -> bytes:
        """Status line and headers of an HTTP answer, with the empty line behind them."""
        if not self.body.startswith(b"HTTP/"):
            return b""
        end = BREAK.search(self.body)
        return self.body[: end.end()] if end else self.body

    @property
    def payload(self) -> bytes:
        return self.body[len(self.head) :]


def arc_records(data: pa.Buffer) -> Iterator[Record]:
    """The records of an ARC file, the version block first. The version is told by the block's second line."""
    version = 0
    for text in members(data):
        at = 0
        while True:
            while text[at : at + 1] in (b"\n", b"\r"):
                at += 1
            if at == len(text):
                break
            end = text.find(b"\n", at)
            line = text[at : end if end >= 0 else len(text)].decode("utf-8", "replace").rstrip("\r")
            if not version:
                second = re.match(rb"\s*([12])\s", text[end + 1 : end + 12])
                if end < 0 or not second or not line.startswith("filedesc:"):
                    raise ValueError("no ARC version block")
                version = int(second[1])
                # version blocks of either version may have a first line of version 1
                fields = line.rsplit(" ", len(FIELDS[version]) - 1)
                fields = fields if len(fields) == len(FIELDS[version]) else line.rsplit(" ", 4)
            else:
                fields = line.rsplit(" ", len(FIELDS[version]) - 1)
            if len(fields) < 5 or not fields[-1].isdigit():
                raise ValueError(f"no ARC header: {line[:200]}")
            body = text[end + 1 : end + 1 + int(fields[-1])]
            if end < 0 or len(body) < int(fields[-1]):
                raise ValueError(f"a record is shorter than it says: {line[:200]}")
            yield Record(*fields[:4], body)
            at = end + 1 + len(body)


# conversion


def iso(date: str, default: str = "1970-01-01T00:00:00Z") -> str:
    """The moment of 14 digits, or of 12 or 8, in ISO form."""
    m = re.fullmatch(r"(\d{4})(\d\d)(\d\d)(?:(\d\d)(\d\d)(\d\d)?)?", date)
    return "{}-{}-{}T{}:{}:{}Z".format(*(x or "00" for x in m.groups())) if m else default


def record_id(name: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{number}')}>"


def digest(data: bytes) -> str:
    """In the form that WARC files have."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(r: Record, name: str, number: int, moment: str, same: str | None = None) -> bytes:
    """The WARC record of an ARC record, compressed; ``same``: the identifier of the record that has its payload."""
    kind = {"warcinfo": "application/warc-fields", "response": "text/dns" if r.url.startswith("dns:") else "application/http; msgtype=response"}.get(r.type, r.kind)
    block = f"software: seqloom\r\nformat: WARC File Format 1.1\r\nconverted-from: {name}\r\n".encode() if r.type == "warcinfo" else r.head if same else r.body
    lines = [("WARC-Type", "revisit" if same else r.type), ("WARC-Record-ID", record_id(name, number)), ("WARC-Date", iso(r.date, moment))]
    if r.type == "warcinfo":
        lines.append(("WARC-Filename", name))
    else:
        lines += [("WARC-Target-URI", r.url), ("WARC-IP-Address", r.ip), ("WARC-Payload-Digest", digest(r.payload)), ("X-Payload-Length", len(r.payload))]
    if same:
        lines += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", same)]
    lines += [("WARC-Block-Digest", digest(block)), ("Content-Type", kind), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return squeezed(head.encode() + block + b"\r\n\r\n")


def page_of(head: bytes) -> int | None:
    m = re.search(rb"(?im)^X-Page-Id: *(-?\d+)\r?$", head)
    return int(m[1]) if m else None


def arc_index(manifest: DataFrame) -> DataFrame:
    """shard, number, arc, name, page_id, sha1, size of every record but the version blocks, read from the files."""
    ship(manifest.sparkSession)

    def run(batches):
        for b in batches:
            for m in b.to_pylist():
                found = enumerate(arc_records(files.mapped(m["arc"])))
                while part := [(n, page_of(r.head), hashlib.sha1(r.payload).digest(), len(r.payload)) for n, r in itertools.islice(found, 4096)]:
                    part = [p for p in part if p[0]]
                    n, page, sha1, size = map(list, zip(*part, strict=True)) if part else ([], [], [], [])
                    same = lambda v, t: pa.array([v] * len(n), t)
                    yield pa.RecordBatch.from_arrays(
                        [same(m["shard"], pa.int32()), pa.array(n, pa.int64()), same(m["arc"], pa.string()), same(m["name"], pa.string()), pa.array(page, pa.int64()), pa.array(sha1, pa.binary()), pa.array(size, pa.int64())],
                        ["shard", "number", "arc", "name", "page_id", "sha1", "size"],
                    )

    spread = manifest.repartition(max(8, manifest.sparkSession.sparkContext.defaultParallelism, manifest.count()))
    return staged(spread.mapInArrow(run, "shard int, number long, arc string, name string, page_id long, sha1 binary, size long"), "arc-index")


def convert(manifest: DataFrame, least: int = LEAST) -> DataFrame:
    """Write a WARC file for each ARC file of the manifest (shard, arc, name); return the WARC files' manifest (shard, warc, n).

    Of records with equal payloads of ``least`` bytes and more, that of the largest page_id (then of the last shard, the last
    in it) keeps its payload, the others become revisits of it."""
    spark = manifest.sparkSession
    index = arc_index(manifest)
    last = F.max(F.struct("page_id", "shard", "number", "name")).alias("last")
    groups = index.where(F.col("size") >= least).groupBy("sha1", "size").agg(last, F.count("*").alias("copies")).where("copies > 1")
    groups = staged(groups.select("sha1", "size", F.col("last.shard").alias("of_shard"), F.col("last.number").alias("of_number"), F.col("last.name").alias("of_name")), "arc-copies")
    side = F.broadcast(groups) if groups.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else groups.hint("merge")
    # a row for each copied payload, so the rows of a frequent one can be split by Spark
    joined = index.select("shard", "number", "arc", "name", "sha1", "size").join(side, ["sha1", "size"], "left")
    own = (F.col("of_shard") == F.col("shard")) & (F.col("of_number") == F.col("number"))
    told = joined.select("shard", "number", "arc", "name", F.when(~own, F.col("of_name")).alias("of_name"), F.when(~own, F.col("of_number")).alias("of_number"))
    root = shared_dir(spark, "warc")

    def run(batches):
        rows = (r for b in small(batches, 4096) for r in b.to_pylist())
        for (shard, arc, name), group in itertools.groupby(rows, key=lambda r: (r["shard"], r["arc"], r["name"])):
            n = 0

            def records(arc=arc, name=name, group=group):
                nonlocal n
                found = arc_records(files.mapped(arc))
                about = next(found)
                moment = iso(about.date)
                yield warc_record(about, name, 0, moment)
                for number, (r, d) in enumerate(zip(found, group, strict=True), 1):
                    if d["number"] != number:
                        raise ValueError(f"{arc}: record {number} is not in the index")
                    yield warc_record(r, name, number, moment, record_id(d["of_name"], d["of_number"]) if d["of_name"] else None)
                    n += 1

            path = files.write(f"{root}/{name.replace('.arc', '.warc')}", records())
            yield pa.RecordBatch.from_pylist([{"shard": shard, "warc": path, "n": n}], pa.schema([("shard", pa.int32()), ("warc", pa.string()), ("n", pa.int64())]))

    dealt = told.repartition(max(8, 2 * manifest.count()), "shard").sortWithinPartitions("shard", "number")
    return staged(dealt.mapInArrow(run, "shard int, warc string, n long"), "warc-manifest")


# WARC


def warc_records(data: pa.Buffer) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields, in lower case, and block of each record of a WARC file."""
    for text in members(data):
        stream = io.BytesIO(text)
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/1."):
                raise ValueError(f"no WARC record: {line[:80]!r}")
            named = {}
            while (line := stream.readline().decode("utf-8", "replace").rstrip("\r\n")) != "":
                key, _, value = line.partition(":")
                named[key.lower()] = value.strip()
            block = stream.read(int(named["content-length"]))
            if len(block) < int(named["content-length"]):
                raise ValueError(f"a record is shorter than it says: {named.get('warc-record-id')}")
            yield named, block


ROW = "record_id string, record_type string, uri string, moment string, page_id long, payload_bytes long, payload_digest string, refers_to_id string, payload binary"


def read_warc(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """A row for each record but the files' own: ROW and refers_to, the page that has a revisit's payload. Digests of stored
    payloads are taken anew; one that differs from its record's is an error."""
    ship(manifest.sparkSession)

    def row(named: dict[str, str], block: bytes) -> dict:
        kind = named["warc-type"]
        answer = named.get("content-type", "").startswith("application/http")
        end = BREAK.search(block) if answer else None
        head = block[: end.end()] if end else block if answer else b""
        payload = block[len(head) :]
        said = named["warc-payload-digest"]
        if kind != "revisit" and digest(payload) != said:
            raise ValueError(f"payload of {named['warc-record-id']} differs from its digest")
        size = int(named["x-payload-length"]) if kind == "revisit" else len(payload)
        return {
            "record_id": named["warc-record-id"], "record_type": kind, "uri": named.get("warc-target-uri"), "moment": named["warc-date"], "page_id": page_of(head), "payload_bytes": size,
            "payload_digest": base64.b32decode(said.removeprefix("sha1:")).hex(), "refers_to_id": named.get("warc-refers-to"), "payload": payload if payloads and kind != "revisit" else None,
        }

    schema = pa.schema([(c, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for c, t in (f.split() for f in ROW.split(", "))])

    def run(batches):
        for b in batches:
            for m in b.to_pylist():
                found = (row(*r) for r in warc_records(files.mapped(m["warc"])) if r[0]["warc-type"] != "warcinfo")
                while part := list(itertools.islice(found, 512)):
                    yield pa.RecordBatch.from_pylist(part, schema)

    spread = manifest.repartition(max(8, manifest.sparkSession.sparkContext.defaultParallelism, manifest.count()))
    rows = staged(spread.mapInArrow(run, ROW), "warc-rows")
    again = rows.where("refers_to_id IS NOT NULL")
    # each record that others refer to, once; then a lookup from its revisits
    asked = again.select(F.col("refers_to_id").alias("record_id")).distinct()
    pages = rows.select("record_id", "page_id").join(asked, "record_id", "left_semi").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    pages = staged(pages, "warc-referred")
    side = F.broadcast(pages) if pages.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else pages.hint("merge")
    found = again.join(side, "refers_to_id").select(*rows.columns, "refers_to")
    return rows.where("refers_to_id IS NULL").withColumn("refers_to", F.lit(None).cast("long")).unionByName(found)
