"""Archives: exact round trip, record types, chunking."""

import gzip
import hashlib

from pyspark.sql import functions as F

from barforge.llm import warc as W

BIG = "é€😀<p>\r\n\r\n" * 4_000
ROWS = [(3, "http://a/x y", "A" * 100), (1, "http://a/1", "A" * 100), (2, None, "A" * 99), (4, "http://b", "A" * 99), (5, "http://c", None),
        (6, "http://c", ""), (7, "http://d", BIG), (9, "http://d\r\nX: y", BIG), (None, "http://e", "A" * 100), (None, "http://e", "n" * 150),
        (8, "http://f", "WARC/1.0\r\n\r\nfake" * 20), (8, "http://f", "WARC/1.0\r\n\r\nfake" * 20), (10, "u", "n" * 150 + "!")]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, digest string, first string")


def expected(rows):
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        same = [q for q, _, x in rows if q is not None and (x or "").encode() == b]
        first = min(same) if same and len(b) >= 100 else None
        again = first is not None and p != first
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    path = W.write_archive(pages(spark, ROWS).repartition(3), chunk_bytes=1000)
    chunks = W.read_archive(spark, path, chunk_bytes=777).cache()
    assert sorted(map(tuple, W.records(chunks).collect()), key=str) == expected(ROWS)
    assert chunks.agg(F.max(F.length("data"))).first()[0] <= 777
    # payloads come back byte for byte, digests grow with the chunks
    by_record = {}
    for r in chunks.where("record_type = 'response'").collect():
        by_record.setdefault(r.record_id, {})[r.chunk] = r
    texts = {(h or "").encode() for _, _, h in ROWS}
    for parts in by_record.values():
        whole = b""
        for n in range(len(parts)):
            whole += bytes(parts[n].data)
            assert parts[n].bytes_so_far == len(whole) and parts[n].digest_so_far == hashlib.sha256(whole).hexdigest()
        assert whole in texts and len(whole) == parts[0].payload_bytes
    assert not chunks.where("target_uri LIKE '%\n%'").count()


def test_files_are_gzip_members_with_warc_headers(spark):
    path = W.write_archive(pages(spark, ROWS[:4]).coalesce(1))
    (name,) = {r.file for r in spark.read.parquet(f"{path}/manifest").collect()}
    with gzip.open(f"{path.removeprefix('file://')}/{name}") as f:
        body = f.read()
    assert body.startswith(b"WARC/1.0\r\nWARC-Type: ") and body.count(b"WARC-Record-ID: <urn:page:") == 4
    assert body.endswith(b"\r\n\r\n") and b"WARC-Profile: " in body and b"http://a/x%20y" in body


def test_empty_table(spark):
    path = W.write_archive(pages(spark, []))
    assert W.records(W.read_archive(spark, path)).collect() == []


def test_damage_is_noticed(spark):
    import glob

    import pytest
    path = W.write_archive(pages(spark, [(1, "u", "z" * 500)]).coalesce(1))
    (file,) = glob.glob(f"{path.removeprefix('file://')}/*.warc.gz")
    with gzip.open(file) as f:
        body = f.read().replace(b"zzz", b"zzy", 1)
    with open(file, "wb") as f:
        f.write(gzip.compress(body))
    size = len(open(file, "rb").read())
    spark.createDataFrame([(file.rsplit("/", 1)[1], 0, size, 1)], W.MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")
    with pytest.raises(Exception, match="does not match its digest"):
        W.read_archive(spark, path).collect()
