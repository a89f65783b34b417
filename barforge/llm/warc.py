"""WARC archives as a chunked record table.

Writing and reading both stream: a payload travels as rows of (record, chunk
number, at most ``chunk_bytes`` bytes), never as one value larger than the
input row it came from. Every chunk row read back carries the SHA-256 of the
payload up to its end, so a record's last chunk holds the whole digest.

Each record is its own gzip member. Tasks write files of their own below the
archive's folder and report the byte ranges in a manifest table; only ranges
that Spark committed are ever read, so a retried or lost task leaves at most an
unreferenced file. Reading takes one task per range, not per file.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import scratch_path, written

CHUNK_BYTES = 1 << 18
RANGE_BYTES = 8 << 20
FILE_BYTES = 512 << 20
#: Payloads below this size are stored again rather than referred to.
REVISIT_FROM = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
MANIFEST = "file string, at bigint, bytes bigint, records bigint"
CHUNKS = ("record_id string, record_type string, target_uri string, refers_to string, payload_bytes bigint, "
          "chunk int, data binary, bytes_so_far bigint, digest_so_far string, last boolean")


def _filesystem(uri: str):
    """The file system of a shared folder's address, and the path in it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
             revisit_from: int = REVISIT_FROM) -> DataFrame:
    """(id, digest, first): the rows whose payload of at least ``revisit_from``
    bytes also belongs to a row with a smaller id. Only ids, digests and
    lengths are shuffled."""
    payload = _payload(payload_col)
    seen = pages.select(F.col(id_col).cast("bigint").alias("id"), F.sha2(payload, 256).alias("digest"),
                        F.octet_length(payload).alias("n"))
    seen = written(seen.where(F.col("n") >= revisit_from).select("id", "digest").distinct(), "warc-digests")
    first = seen.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
    first = first.where((F.col("rows") > 1) & F.col("first").isNotNull()).drop("rows")
    return seen.join(first, "digest").where(~F.col("id").eqNullSafe(F.col("first"))).select("id", "digest", "first")


def _payload(payload_col: str):
    return F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b""))


def write_archive(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", revisit_from: int = REVISIT_FROM, chunk_bytes: int = CHUNK_BYTES,
                  date: str = "1970-01-01T00:00:00Z") -> str:
    """Write one record per row below ``path`` (default: a new folder in the
    shared checkpoint folder) and return the path; the table ``manifest`` in it
    lists the byte ranges. Of equal payloads of ``revisit_from`` bytes or more
    the smallest id is a response, the others are revisits of it. Null payloads
    are empty, a null address leaves its header out, rows with a null id are
    responses unless a row with an id has their payload, repeated rows are
    written again with the same record type, an empty table gives an empty
    archive."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    again = written(revisits(pages, id_col, payload_col, revisit_from), "warc-revisits")
    rows = pages.select(F.col(id_col).cast("bigint").alias("p_id"), F.col(url_col).cast("string").alias("url"),
                        _payload(payload_col).alias("payload"))
    rows = rows.withColumn("p_digest", F.sha2("payload", 256))
    # a small table of revisits is broadcast by its file size, a large one is sorted and merged
    rows = rows.join(again, F.col("p_id").eqNullSafe(F.col("id")) & (F.col("p_digest") == F.col("digest")), "left")
    size = F.octet_length("payload")
    cut = F.when(F.col("first").isNull(), F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(size / chunk_bytes).cast("int") - 1)),
        lambda i: F.col("payload").substr(i * chunk_bytes + 1, F.lit(chunk_bytes)))).otherwise(F.array(F.lit(b"")))
    # ids go as text: pandas would turn a nullable BIGINT into a double
    rows = rows.select(F.col("p_id").cast("string").alias("p_id"), "url", F.col("p_digest").alias("digest"),
                       size.cast("bigint").alias("n"), F.col("first").cast("string").alias("first"),
                       F.size(cut).alias("chunks"), F.posexplode(cut).alias("chunk", "data"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = _filesystem(path)
        fs.create_dir(folder)
        out, name, at, start, records, done, gz = None, "", 0, 0, 0, [], None
        for b in batches:
            for r in b.itertuples(index=False):
                if r.chunk == 0:
                    if out is None:
                        name = f"records-{uuid.uuid4().hex}.warc.gz"
                        out, at, start, records = fs.open_output_stream(f"{folder}/{name}", compression=None), 0, 0, 0
                    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                    at += out.write(gz.compress(_record_head(r, date)))
                at += out.write(gz.compress(r.data))
                if r.chunk == r.chunks - 1:
                    at += out.write(gz.compress(b"\r\n\r\n") + gz.flush())
                    records += 1
                    if at - start >= RANGE_BYTES:
                        done.append((name, start, at - start, records))
                        start, records = at, 0
                        if at >= FILE_BYTES:
                            out.close()
                            out = None
        if out is not None:
            out.close()
            if records:
                done.append((name, start, at - start, records))
        yield pd.DataFrame(done, columns=["file", "at", "bytes", "records"])

    rows.mapInPandas(write, MANIFEST).write.parquet(f"{path.rstrip('/')}/manifest")
    return path


def _urn(page: str | None, digest: str) -> str:
    return f"<urn:page:{'none' if page is None else page}:sha256:{digest}>"


def _record_head(r, date: str) -> bytes:
    """WARC header and, as the block's start, the HTTP response header."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {r.n}\r\n\r\n").encode()
    revisit = r.first is not None
    lines = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {_urn(r.p_id, r.digest)}", f"WARC-Date: {date}"]
    if r.url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", r.url))
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{r.digest}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(r.first, r.digest)}"]
    lines.append(f"Content-Length: {len(http) + (0 if revisit else r.n)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Members:
    """The gzip members of a byte range, one after the other, read in blocks."""

    def __init__(self, file, size: int, block: int = 1 << 20):
        self.file, self.left, self.block, self.raw, self.gz, self.text = file, size, block, b"", None, b""

    def next(self) -> bool:
        self.gz, self.text = None, b""
        if not self.raw and not self._fetch():
            return False
        self.gz = zlib.decompressobj(31)
        return True

    def _fetch(self) -> bool:
        self.raw = self.file.read(min(self.block, self.left))
        self.left -= len(self.raw)
        return bool(self.raw)

    def read(self, most: int) -> bytes:
        """Up to ``most`` bytes of the member; empty at its end."""
        while not self.text and not self.gz.eof:
            if not self.raw and not self._fetch():
                raise ValueError("the archive ends inside a record")
            self.text = self.gz.decompress(self.raw, most)
            self.raw = self.gz.unused_data if self.gz.eof else self.gz.unconsumed_tail
        out, self.text = self.text[:most], self.text[most:]
        return out

    def head(self) -> tuple[str, dict[str, str]]:
        """Lines up to an empty one: the first, and the named fields."""
        got = b""
        while (end := got.find(b"\r\n\r\n")) < 0:
            more = self.read(1024)
            if not more:
                raise ValueError("a record has no complete header")
            got += more
        self.text = got[end + 4:] + self.text
        first, *lines = got[:end].decode("utf-8").split("\r\n")
        return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def read_archive(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The archive's records as chunk rows (see ``CHUNKS``); records come back
    with at least one row each, an empty payload with one empty chunk. The
    digest of a response is computed from the bytes and held against its
    header; a revisit repeats the digest and length it was written with."""
    ranges = spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest")
    tasks = max(1, ranges.count())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = _filesystem(path)
        for b in batches:
            for r in b.itertuples(index=False):
                with fs.open_input_file(f"{folder}/{r.file}") as file:
                    file.seek(r.at)
                    members, rows, held = _Members(file, r.bytes), [], 0
                    while members.next():
                        for row in _chunks(members, chunk_bytes):
                            rows.append(row)
                            held += len(row[6])
                            if held > 4 << 20 or len(rows) >= 5000:
                                yield _chunk_frame(rows)
                                rows, held = [], 0
                    yield _chunk_frame(rows)

    return ranges.repartitionByRange(tasks, "file", "at").mapInPandas(read, CHUNKS)


def _chunk_frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in CHUNKS.split(", ")])


def _chunks(members: _Members, chunk_bytes: int) -> Iterator[tuple]:
    import hashlib
    _, warc = members.head()
    _, http = members.head()
    kind, size = warc["warc-type"], int(http["content-length"])
    told = warc["warc-payload-digest"].removeprefix("sha256:")
    about = (warc["warc-record-id"], kind, warc.get("warc-target-uri"), warc.get("warc-refers-to"), size)
    if kind == "revisit":
        yield (*about, 0, b"", 0, told, True)
        return
    digest, so_far, n = hashlib.sha256(), 0, 0
    while True:
        parts, want = [], min(chunk_bytes, size - so_far)
        while want and (part := members.read(want)):
            parts.append(part)
            want -= len(part)
        data = b"".join(parts)
        if want:
            raise ValueError(f"record {about[0]} is shorter than it says")
        digest.update(data)
        so_far += len(data)
        if so_far == size and digest.hexdigest() != told:
            raise ValueError(f"record {about[0]} does not match its digest")
        yield (*about, n, data, so_far, digest.hexdigest(), so_far == size)
        n += 1
        if so_far == size:
            break
    end = b""
    while part := members.read(5 - len(end)):
        end += part
    if end != b"\r\n\r\n":
        raise ValueError(f"record {about[0]} is longer than it says")


def records(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk: page_id, payload_bytes,
    payload_digest, record_type, refers_to (ids taken from the record URNs)."""
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+):", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("bigint")
    return chunks.where("last").select(
        number("record_id").alias("page_id"), "payload_bytes", F.col("digest_so_far").alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"))
