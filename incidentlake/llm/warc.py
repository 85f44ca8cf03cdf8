"""WARC derivatives: responses become linked metadata and plain-text conversion records.

A record frame has the columns of ``RECORD``. ``responses`` wraps raw pages as response records (for
data that did not come as WARC), ``derive`` makes one metadata and one conversion record of every
response, ``to_bytes`` and ``from_bytes`` write and read the file format. Both derived records name the
response in WARC-Refers-To, keep its target URI and date, carry its payload digest and have a block
digest of their own; the metadata record also lists the response's HTTP headers, title and links.

Defined cases: a null page or block counts as empty (the conversion is then an empty text), a null URI stays null and
its header is left out; a block without HTTP header lines is all payload; rows are taken whole at any
length; equal input rows give equal records with equal ids, because ids are derived from what the row holds.
Records of other types are not derived from. Extra columns are ignored. Nothing is shuffled.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import rename, ship
from .markup import blocks, links, plain_text

RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string,"
    " payload_digest string, block_digest string, source_headers map<string,string>, block binary")
NAMES = re.findall(r"(\w+) (?:string|map|binary)", RECORD)
DATE = "1970-01-01T00:00:00Z"
_HEADER_NAMES = {
    "warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To", "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date", "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "block_digest": "WARC-Block-Digest",
}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str | None) -> str:
    """An id that depends on the parts alone; a null part differs from an empty one."""
    key = "\0".join("-" if p is None else "+" + p for p in parts)
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>"


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case, repeated ones joined by a comma, the status line as ``:status``) and payload."""
    if not block.startswith(b"HTTP/"):
        return {}, block
    head, _, payload = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("latin-1").split("\r\n")
    fields = {":status": first}
    for line in lines:
        name, _, value = line.partition(":")
        name, value = name.strip().lower(), value.strip()
        fields[name] = f"{fields[name]}, {value}" if name in fields else value
    return fields, payload


def decoded(fields: dict[str, str], payload: bytes) -> str:
    """The payload as text: gzip and deflate are undone, the charset is the header's, else UTF-8; bad bytes are replaced."""
    try:
        if "gzip" in fields.get("content-encoding", ""):
            payload = gzip.decompress(payload)
        elif "deflate" in fields.get("content-encoding", ""):
            payload = zlib.decompress(payload)
    except (OSError, EOFError, zlib.error):
        pass  # mislabelled: the bytes are taken as they are
    found = re.search(r"charset=[\"']?([\w-]+)", fields.get("content-type", ""), re.I)
    try:
        return payload.decode(found[1] if found else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def responses(pages: DataFrame, key: str = "page_id", uri: str = "url", body: str = "html", date: str = DATE) -> DataFrame:
    """Response records of raw pages, with ``key`` in front."""
    ship(pages.sparkSession)
    kept = rename(pages, key=key, uri=uri, body=body)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(k, *_response(k, u, b, date)) for k, u, b in frame.itertuples(index=False)], columns=["key", *NAMES], dtype=object)

    return kept.mapInPandas(run, f"key {kept.schema['key'].dataType.simpleString()}, {RECORD}").withColumnRenamed("key", key)


def _response(key: object, uri: str | None, body: str | None, date: str) -> tuple:
    payload = (body or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    paid = digest(payload)
    return (
        "response", record_id("response", str(key), uri, paid), None, uri, date, "application/http; msgtype=response",
        paid, digest(head + payload), split_http(head)[0], head + payload)


def _derived(r: dict) -> list[tuple]:
    block = r["block"] or b""
    fields, payload = split_http(block)
    page = decoded(fields, payload)
    source = r["payload_digest"] or digest(payload)
    title = next((t for tag, t, _, _ in blocks(page)[0] if tag == "title"), "")
    lines = [("source-record-id", r["record_id"]), ("source-payload-digest", source), ("source-block-digest", r["block_digest"] or digest(block))]
    lines += [(f"http-{n.lstrip(':')}", v) for n, v in fields.items()] + [("title", title)] + [("outlink", x) for x in links(page)]
    notes = "".join(f"{n}: {' '.join((v or '').split())}\r\n" for n, v in lines).encode()
    text = plain_text(page).encode()
    return [
        (kind, record_id(kind, r["record_id"], source), r["record_id"], r["target_uri"], r["warc_date"], mime, source, digest(data), fields, data)
        for kind, mime, data in (("metadata", "application/warc-fields", notes), ("conversion", "text/plain; charset=utf-8", text))]


def derive(records: DataFrame, key: str | None = "page_id") -> DataFrame:
    """One metadata and one conversion record of every response record; ``key`` (if given) is carried along."""
    ship(records.sparkSession)
    names = ([key] if key else []) + NAMES
    kept = records.filter("warc_type = 'response'").select(*[records[c] for c in names])
    lead = f"{key} {kept.schema[key].dataType.simpleString()}, " if key else ""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(*([r[key]] if key else []), *d) for r in frame.to_dict("records") for d in _derived(r)]
            yield pd.DataFrame(out, columns=names, dtype=object)

    return kept.mapInPandas(run, lead + RECORD)


def record_bytes(r: dict) -> bytes:
    """A record in the file format, as a gzip member of its own."""
    block = r["block"] or b""
    fields = [(h, r[c]) for c, h in _HEADER_NAMES.items() if r[c] is not None]
    head = "".join(f"{h}: {' '.join(v.split())}\r\n" for h, v in fields)
    return gzip.compress(f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n", mtime=0)


def parse_bytes(data: bytes) -> Iterator[dict]:
    """Records of a file, compressed or not; lengths in the headers decide where a record ends."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while (start := data.find(b"WARC/1.", at)) >= 0:
        end = data.index(b"\r\n\r\n", start)
        given = {}
        for line in data[start:end].decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            given[name.strip().lower()] = value.strip()
        at = end + 4 + int(given["content-length"])
        r = {c: given.get(h.lower()) for c, h in _HEADER_NAMES.items()}
        block = data[end + 4:at]
        yield r | {"source_headers": split_http(block)[0] if r["warc_type"] == "response" else {}, "block": block}


def to_bytes(records: DataFrame) -> DataFrame:
    """``record_id`` and ``data``: each record as a gzip member; members written one after another make a file."""
    ship(records.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"record_id": frame["record_id"], "data": [record_bytes(r) for r in frame.to_dict("records")]})

    return records.select(*NAMES).mapInPandas(run, "record_id string, data binary")


def from_bytes(files: DataFrame, data: str = "data") -> DataFrame:
    """Records of whole files or members, such as ``spark.read.format("binaryFile")`` gives in ``content``."""
    ship(files.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for x in frame["data"]:
                if rows := [[r[n] for n in NAMES] for r in parse_bytes(x or b"")]:
                    yield pd.DataFrame(rows, columns=NAMES, dtype=object)

    return files.select(F.col(data).alias("data")).mapInPandas(run, RECORD)


def summary(derived: DataFrame, key: str = "page_id") -> DataFrame:
    """A row for each derived record: its links, digests and size, and the block as text."""
    return derived.select(
        key, "warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "payload_digest", "block_digest",
        F.col("source_headers")["content-type"].alias("source_content_type"), F.length("block").cast("long").alias("n_bytes"),
        F.decode("block", "UTF-8").alias("text"))
