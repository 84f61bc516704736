import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tidelog.llm.warc import Archive, read_archives, resolve_revisits, restored, with_digest, write_archives

SCHEMA = "page_id bigint, url string, html string, record_type string, payload_bytes string"
PAGES = [
    (5, "http://a/5", "<p>same</p>"),
    (3, "http://a/3", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (4, "http://a/ 4\r\nX", "own é 🙂 \r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (8, "http://a/8", "long " * 200_000),
    (8, "http://a/8", "long " * 200_000),
    (None, "http://a/none", "<p>same</p>"),
    (None, "http://a/none", "no id"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "clash", "clash") for p in PAGES], SCHEMA).repartition(3)


def expected(min_bytes=0):
    raw = [(i, (h or "").encode()) for i, _, h in PAGES]
    out = []
    for i, r in raw:
        same = [j for j, s in raw if s == r and j is not None]
        again = same and len(r) >= min_bytes and i != min(same)
        sha = base64.b32encode(hashlib.sha1(r).digest()).decode()
        out.append((i, len(r), sha, "revisit" if again else "response", min(same) if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5, 100])
def test_round_trip(spark, pages, path, min_bytes):
    write_archives(pages, path, min_bytes, records_per_file=2)
    stored = read_archives(spark, path)
    got = [tuple(r) for r in stored.drop("url").collect()]
    assert sorted(got, key=str) == expected(min_bytes)
    back = restored(read_archives(spark, path, payloads=True))
    assert sorted((str(r["page_id"]), r["html"]) for r in back.collect()) == sorted((str(i), h or "") for i, _, h in PAGES)
    urls = {r["page_id"]: r["url"] for r in stored.collect()}
    assert urls[5] == "http://a/5" and urls[4] == "http://a/%204%0D%0AX" and urls[9] == "urn:page:9"


def test_records_are_well_formed(spark, pages, tmp_path):
    write_archives(pages, str(tmp_path / "w"))
    for file in (tmp_path / "w").glob("*.gz"):
        content = file.read_bytes()
        records = list(Archive(content, piece=7).records())
        again = b""
        for fields, block in records:
            assert fields["warc-record-id"].startswith("<urn:") and int(fields["content-length"]) == len(block)
            again += block
        assert len(again) < len(gzip.decompress(content))


def test_empty_table(spark, pages, path):
    write_archives(pages.limit(0), path)
    assert read_archives(spark, path).count() == 0


def test_broken_archive():
    with pytest.raises(ValueError):
        list(Archive(gzip.compress(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nshort")).records())
    with pytest.raises(ValueError):
        list(Archive(gzip.compress(b"HTTP/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n")).records())


def test_other_columns_pass(pages):
    done = resolve_revisits(with_digest(pages.withColumn("crawl", F.lit("c"))))
    assert done.where("crawl = 'c'").count() == len(PAGES)
