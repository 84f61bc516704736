"""WARC archives without repeated payloads.

Pages are told apart by the digest of their payload. Of equal payloads one page
is written as a response; the others are revisit records, which name the
response and repeat no payload. Headers are shuffled to find the page that is
kept of each digest; of payloads only those that are kept of repeated digests
are, and the others go straight to the writer. Archives are written
by Spark's text sink, whose line separator is the end of a record, and read
back record by record by their stated lengths.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.bitmaps import bitmap, holds
from tidelog.llm.common import arrow_schema, bounded_batches, ddl, map_rows, staged, text_of

#: Payloads of fewer bytes are never replaced by a revisit record.
MIN_BYTES = 0
RECORDS_PER_FILE = 5000
#: Stands for the id of a row without one where ids are hashed.
NO_ID = -1

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGEST = "sha1"

_BREAKS = re.compile(r"[\x00-\x20\x7f]")


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_digest(pages: DataFrame) -> DataFrame:
    """``pages`` with payload_bytes and payload_digest of the html in UTF-8; null counts as empty."""

    def start():
        def step(texts):
            raw = [(t or "").encode() for t in texts]
            return {"payload_bytes": [len(r) for r in raw], "payload_digest": [digest(r) for r in raw]}

        return step

    return map_rows(pages, ["html"], start, {"payload_bytes": "long", "payload_digest": "string"})


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``headers`` with record_type and refers_to, by payload_digest.

    Of equal payloads of at least ``min_bytes`` bytes, the smallest page_id is
    the response and the others revisit it; repeated rows of that id are all
    responses, and where no row has an id, all are. The digests' smallest ids
    are summed up before the shuffle; a digest that very many rows share is
    spread by the skew handling of the join.
    """
    large = F.col("payload_bytes") >= min_bytes
    first = (
        headers.where(large)
        .groupBy(F.col("payload_digest").alias("digest_"), F.col("payload_bytes").alias("bytes_"))
        .agg(F.min("page_id").alias("original_"), F.count(F.lit(1)).alias("n_"))
        .where("n_ > 1 and original_ is not null")
    )
    same = (headers["payload_digest"] == first["digest_"]) & (headers["payload_bytes"] == first["bytes_"])
    again = F.col("original_").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original_"))
    return (
        headers.join(first, same, "left")
        .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(again, F.col("original_")))
        .drop("digest_", "bytes_", "original_", "n_")
    )


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url, html, size, sha, kind, refers_to, date) -> str:
    """One record up to, and without, the end mark."""
    payload = html or ""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}{END}"
    block = http if kind == "revisit" else http + payload
    block_size = len(http) + (0 if kind == "revisit" else size)
    target = _BREAKS.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else record_name(page_id)[1:-1]
    lines = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: {DIGEST}:{sha}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {block_size}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(refers_to)}"]
    return "\r\n".join(lines) + END + block


def with_keys(pages: DataFrame) -> DataFrame:
    """page_id, url and html of ``pages``, with the payload's length, SHA-1 (hex) and a 64-bit hash, all made in the JVM."""
    html = F.col("html")
    plain = pages.select("page_id", "url", text_of("html").alias("html"))
    return plain.withColumns(
        {"payload_bytes": F.octet_length(html).cast("long"), "sha_": F.sha1(html.cast("binary")), "key_": F.xxhash64(html)}
    )


def named_digest(rows: DataFrame) -> DataFrame:
    """payload_digest in place of ``sha_``."""

    def start():
        return lambda shas: {"payload_digest": [base64.b32encode(bytes.fromhex(s)).decode() for s in shas]}

    return map_rows(rows, ["sha_"], start, {"payload_digest": "string"}, drop=("sha_",))


def place() -> Column:
    """A number for a row's digest and id together."""
    return F.col("key_").bitwiseXOR(F.coalesce(F.col("page_id"), F.lit(NO_ID)))


def responses(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``with_keys`` that are responses, with their html; no other html is shuffled.

    A row whose digest nobody revisits is a response, as a bitmap of the
    revisited digests says, which misses none. Of the others only those go on
    whose digest and id a second bitmap has, which holds all responses among
    them; an exact join with their headers settles what the bitmaps take for
    others.
    """
    spark = rows.sparkSession
    revisited = spark.sparkContext.broadcast(bitmap(decided.where("record_type = 'revisit'"), "key_"))

    def picked(df: DataFrame, keep: Callable[..., np.ndarray], columns: list[str]) -> DataFrame:
        """Rows of ``df`` for which ``keep`` of some of its columns holds; batches are filtered as they are."""
        places = [df.columns.index(c) for c in columns]

        def task(batches):
            for batch in batches:
                yield batch.filter(pa.array(keep(*(np.asarray(batch.column(i)) for i in places))))

        return df.mapInArrow(task, df.schema)

    headers = decided.where("record_type = 'response'").select("page_id", "key_", "payload_digest")
    doubtful = picked(headers, lambda keys: holds(revisited.value, keys), ["key_"]).distinct()
    doubtful = staged(doubtful.withColumn("place_", place()), "doubtful")
    firsts = spark.sparkContext.broadcast(bitmap(doubtful, "place_"))
    placed = rows.withColumn("place_", place())
    sure = picked(placed, lambda keys: ~holds(revisited.value, keys), ["key_"])
    maybe = picked(placed, lambda keys, at: holds(revisited.value, keys) & holds(firsts.value, at), ["key_", "place_"])
    maybe, asked = named_digest(maybe), doubtful.select(*(F.col(c).alias(f"asked_{c}") for c in ("page_id", "key_", "payload_digest")))
    same = (
        maybe["page_id"].eqNullSafe(asked["asked_page_id"]) & (maybe["key_"] == asked["asked_key_"])
        & (maybe["payload_digest"] == asked["asked_payload_digest"])
    )
    return named_digest(sure).unionByName(maybe.join(asked, same, "left_semi")).drop("key_", "place_")


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, records_per_file: int = RECORDS_PER_FILE
) -> None:
    """A record for each row of ``pages`` (page_id, url, html) in gzip archives of a bounded number of records.

    Null html is an empty payload; a null url gives a record that is its own
    target, white space and control characters in one are escaped. An empty
    table leaves no records. Revisits are written from the headers alone.
    """
    date = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    bounded_batches(pages.sparkSession)
    rows = with_keys(pages)
    decided = staged(resolve_revisits(named_digest(rows.drop("html")), min_bytes), "headers")
    first = responses(rows, decided).withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("long")})
    again = decided.where("record_type = 'revisit'").withColumn("html", F.lit(None).cast("string"))
    inputs = ["page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def start():
        return lambda *columns: {"value": [record(*row, date) for row in zip(*columns)]}

    records = map_rows(first.select(*inputs).unionByName(again.select(*inputs)), inputs, start, {"value": "string"}, drop=tuple(inputs))
    options = {"lineSep": END, "compression": "gzip", "maxRecordsPerFile": str(records_per_file)}
    records.write.options(**options).text(path)


class Archive:
    """Records of one archive, out of pieces of its gzip members."""

    def __init__(self, content: bytes, piece: int = 1 << 20):
        self.content, self.piece, self.at = memoryview(content), piece, 0
        self.open = zlib.decompressobj(31)
        self.buffer = bytearray()

    def more(self) -> bool:
        while True:
            if self.open.eof:
                rest = self.open.unused_data
                if not rest and self.at >= len(self.content):
                    return False
                self.open = zlib.decompressobj(31)
                made = self.open.decompress(rest) if rest else b""
            elif self.at >= len(self.content):
                return False
            else:
                made = self.open.decompress(self.content[self.at : self.at + self.piece])
                self.at += self.piece
            if made:
                self.buffer += made
                return True

    def need(self, n: int) -> None:
        while len(self.buffer) < n:
            if not self.more():
                raise ValueError("an archive ends inside a record")

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """Header fields, by small-letter name, and block of each record."""
        while self.buffer or self.more():
            while (head := self.buffer.find(END.encode())) < 0:
                self.need(len(self.buffer) + 1)
            version, *lines = bytes(self.buffer[:head]).decode().split("\r\n")
            if version != VERSION:
                raise ValueError(f"not the start of a record: {version[:40]!r}")
            fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            start = head + len(END)
            end = start + int(fields["content-length"])
            self.need(end + len(END))
            yield fields, bytes(self.buffer[start:end])
            del self.buffer[: end + len(END)]


STORED = {
    "page_id": "long",
    "url": "string",
    "payload_bytes": "long",
    "payload_digest": "string",
    "record_type": "string",
    "refers_to": "long",
}


def page_of(name: str) -> int | None:
    number = name.rpartition(":")[2].rstrip(">")
    return int(number) if number else None


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row for each record: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    A response's length and digest are those of the payload that was read; one
    that does not match its header is an error. A revisit's are those stated in
    its own headers. With ``payloads`` html follows, null for revisits. A task
    reads whole archives, whose size ``write_archives`` bounds.
    """
    columns = STORED | ({"html": "string"} if payloads else {})
    schema = arrow_schema(columns)
    bounded_batches(spark)

    def row(fields, block):
        stated = fields["warc-payload-digest"].removeprefix(f"{DIGEST}:")
        http, _, payload = block.partition(END.encode())
        kind, refers_to, html = fields["warc-type"], None, None
        if kind == "revisit":
            size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
            refers_to = page_of(fields["warc-refers-to"])
        else:
            size, html = len(payload), payload.decode() if payloads else None
            if digest(payload) != stated:
                raise ValueError(f"{fields['warc-record-id']}: the payload does not match its digest")
        made = (page_of(fields["warc-record-id"]), fields["warc-target-uri"], size, stated, kind, refers_to, html)
        return made[: len(columns)]

    def task(batches):
        for files in batches:
            for content in files.column(0):
                rows, size = [], 0
                for fields, block in Archive(content.as_buffer()).records():
                    rows.append(row(fields, block))
                    size += len(block)
                    if len(rows) == 1000 or size > 1 << 24:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema
        )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(task, ddl(columns))


def restored(records: DataFrame) -> DataFrame:
    """page_id, url and html of all records of ``read_archives(..., payloads=True)``: revisits joined to their responses."""
    originals = records.where("record_type = 'response'").select(
        F.col("page_id").alias("original_"), F.col("html").alias("original_html_")
    )
    originals = originals.dropDuplicates(["original_"])
    joined = records.join(originals, records["refers_to"] == originals["original_"], "left")
    return joined.select("page_id", "url", F.coalesce("html", "original_html_", text_of("html")).alias("html"))
