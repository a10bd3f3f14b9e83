"""WARC archives: writing, reading back, and an index in global order.

`write` gives every page one record. Records with equal payloads of at least `least_bytes` bytes are stored once: the one with
the largest id is a response, the others revisit it. Executors write the archives to a shared folder, a file per so many
records, under names that no other attempt uses; the manifest lists the files of the attempts that succeeded, and only those
are read. `read` parses the archives, checks every stored payload against its digest and sorts the captures of each file: a
run. `merge` deals the runs out by ranges of (URL key, time, id); every range merges its k parts of runs with a loser tree, so
that the ranges one after the other hold the capture histories in order.

Null html counts as empty, null URLs have an empty key, a null id is written as none and is a response only where its equals
have no id either. Rows that repeat id and payload with the largest id are all responses. An empty table writes no archive.
Payloads of any length are written whole. Further columns are not read. The column
that `time_column` names is the capture time, in the record and in the order; a capture without one gets one second per id.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from epigrid.llm.common import shards_for
from epigrid.session import cut_lineage, shared_folder

LEAST_BYTES = 1000
RECORDS_PER_FILE = 5_000
CAPTURES_PER_RANGE = 50_000
READ_BYTES = 1 << 20
EPOCH = datetime(2020, 1, 1, tzinfo=timezone.utc)
ENTRY = [
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("url_key", pa.string()), ("captured", pa.string()), ("file", pa.string()), ("offset", pa.int64()),
]
_DDL = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, "
    "captured string, file string, offset long"
)
SORT = ("url_key", "captured", "page_id", "file", "offset")


def decisions(pages: DataFrame, least_bytes: int = LEAST_BYTES, time_column: str | None = None) -> DataFrame:
    """(page_id, url, html, digest, refers_to, time): refers_to is null for a response, time is in microseconds or null."""
    time = F.unix_micros(F.col(time_column).cast("timestamp")) if time_column else F.lit(None).cast("long")
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("html"),
        F.sha1(F.encode(body, "UTF-8")).alias("digest"), F.octet_length(body).alias("size"),
        time.alias("time"),
    )
    long = rows.where(F.col("size") >= least_bytes).groupBy("digest", "size")
    equal = long.agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = rows.join(equal.hint("merge"), ["digest", "size"], "left")
    stays = F.col("response").isNull() | F.col("page_id").eqNullSafe(F.col("response"))
    return joined.select("page_id", "url", "html", "digest", F.when(~stays, F.col("response")).alias("refers_to"), "time")


def _record(page: int | None, url: str | None, html: str, digest: str, refers_to: int | None, time: int | None = None) -> bytes:
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    if time is None:
        when = EPOCH + timedelta(seconds=(page or 0) % 3_000_000_000)
    else:
        when = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=time)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'none' if page is None else page}>",
        f"WARC-Date: {when.replace(tzinfo=None).isoformat()}Z",
        f"WARC-Payload-Digest: sha1:{sha}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: quote(m[0]), url)}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def write(
    pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, records: int = RECORDS_PER_FILE, time_column: str | None = None
) -> DataFrame:
    """Write the archives, one gzip member per record; the manifest (file, records) is stored too."""

    def run(batches):
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        out, name, n = None, "", 0
        try:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, n = store.open_output_stream(f"{path}/{name}", compression=None), 0
                    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
                    out.write(squeeze.compress(_record(*row)) + squeeze.flush())
                    n += 1
                    if n == records:
                        out.close()
                        out = None
                        yield pa.RecordBatch.from_pydict({"file": [name], "records": [n]})
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [n]})

    return cut_lineage(decisions(pages, least_bytes, time_column).mapInArrow(run, "file string, records long"), "manifest")


def members(stream) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every gzip member of a file."""
    offset, rest = 0, b""
    while True:
        rest = rest or stream.read(READ_BYTES)
        if not rest:
            return
        squeeze, content, used = zlib.decompressobj(31), [], 0
        while not squeeze.eof:
            if not rest:
                rest = stream.read(READ_BYTES)
                if not rest:
                    raise ValueError(f"archive ends inside the record at {offset}")
            content.append(squeeze.decompress(rest))
            used += len(rest) - len(squeeze.unused_data)
            rest = squeeze.unused_data
        yield offset, b"".join(content)
        offset += used


def url_key(url: str | None) -> str:
    """Sort-friendly form: host labels from the last to the first, path, and the query's parts in order; no scheme or fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url.strip().lower()
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{labels}{f':{port}' if port else ''}){parts.path or '/'}{'?' + query if query else ''}".lower()


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "none") else int(number)


def parse(content: bytes) -> dict:
    """Index entry of one record, without its place; a stored payload must have the digest that the record states."""
    head, _, block = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": _page(fields.get("WARC-Refers-To")),
        "url_key": url_key(fields.get("WARC-Target-URI")),
        "captured": re.sub(r"\D", "", fields["WARC-Date"]),
    }


def _order(entry: dict) -> tuple:
    page = entry["page_id"]
    return entry["url_key"], entry["captured"], (page is not None, page or 0), entry["file"], entry["offset"]


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Entries of all archives with their place in the run (`position`): the sorted captures of one file."""
    schema = pa.schema([*ENTRY, ("position", pa.int64())])

    def run(batches):
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    found = [parse(content) | {"file": name, "offset": offset} for offset, content in members(stream)]
                found.sort(key=_order)
                for k, entry in enumerate(found):
                    entry["position"] = k
                yield pa.RecordBatch.from_pylist(found, schema)

    spread = manifest.select("file").repartition(shards_for(manifest.count(), 1), "file")
    return cut_lineage(spread.mapInArrow(run, _DDL + ", position long"), "runs")


class LoserTree:
    """k-way merge: every inner node keeps the loser of its match, so the next winner needs one match per level."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = [iter(r) for r in runs], key, len(runs)
        self.heads = [self._pull(i) for i in range(self.k)]
        self.losers = [-1] * self.k
        self.winner = self._build(1) if self.k else -1

    def _pull(self, i: int):
        item = next(self.runs[i], None)
        return None if item is None else (self.key(item), item)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x[0], a) < (y[0], b))

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        winner, self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return winner

    def __iter__(self):
        while self.k and self.heads[self.winner] is not None:
            winner = self.winner
            yield self.heads[winner][1]
            self.heads[winner] = self._pull(winner)
            node = (winner + self.k) // 2
            while node:
                if self._beats(self.losers[node], winner):
                    winner, self.losers[node] = self.losers[node], winner
                node //= 2
            self.winner = winner


def merge(runs: DataFrame) -> DataFrame:
    """Entries with `part` and `place`: in their order, the captures are sorted by URL key, time and id over all archives."""
    schema = pa.schema([*ENTRY, ("part", pa.int32()), ("place", pa.int64())])

    def run(batches):
        entries: dict[str, list[dict]] = {}
        for batch in batches:
            for entry in batch.to_pylist():
                entries.setdefault(entry["file"], []).append(entry)
        part, chunk = TaskContext.get().partitionId(), []
        for place, entry in enumerate(LoserTree(list(entries.values()), _order)):
            chunk.append(entry | {"part": part, "place": place})
            if len(chunk) == 5_000:
                yield pa.RecordBatch.from_pylist([{n: e[n] for n in schema.names} for e in chunk], schema)
                chunk = []
        if chunk:
            yield pa.RecordBatch.from_pylist([{n: e[n] for n in schema.names} for e in chunk], schema)

    ranges = shards_for(runs.count(), CAPTURES_PER_RANGE)
    dealt = runs.repartitionByRange(ranges, *SORT).sortWithinPartitions("file", "position")
    return dealt.mapInArrow(run, _DDL + ", part int, place long")


def archive(
    pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES, time_column: str | None = None
) -> DataFrame:
    """Write the pages, read the archives back and merge their index."""
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return merge(read(write(pages, folder, least_bytes, time_column=time_column), folder))
