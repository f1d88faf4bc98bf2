"""WARC archives of pages, and their index merged to one global order.

Writing: one record per page. Of records with equal payloads of at least ``revisit_bytes``
the one with the largest page_id is a response; the others are revisits that name it and
hold only the response head. Spark's text writer puts the records into gzip files, with
the two line ends that close a record as its separator, so any file system serves.

Reading: each archive is parsed by Content-Length, payload digests are checked, and its
captures leave as one run sorted by (url key, timestamp, page_id). The url key is the host
with its labels reversed, then path and query. Runs are written, cut into key ranges of
bounded size, and in each range the parts of all runs are merged by a loser tree. Ranges
are cut on the whole sort key, so one url with most captures is spread too. Positions in the
global order follow from the ranges' sizes.

Defined cases: null html is an empty payload; a null url has an empty key and no target
line; pages that share the largest page_id of a payload are all responses; a null page_id
is written as an empty id, is never referred to and sorts first; repeated rows are repeated
records; line ends in a url are percent-encoded in its header; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickstar.llm.tables import Scratch

REVISIT_BYTES = 1000
RECORDS_PER_FILE = 2000
CAPTURES_PER_RANGE = 100_000
# Captures have no time of their own in the table: page_id seconds after this, in a circle.
EPOCH, CIRCLE = 1704067200, 10 ** 9
END = b"\r\n\r\n"
CAPTURE = pa.schema([
    ("url_key", pa.string()), ("ts", pa.string()), ("page_id", pa.int64()), ("run", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("archive", pa.string()), ("at", pa.int64())])
CAPTURE_DDL = ("url_key string, ts string, page_id bigint, run string, payload_bytes bigint, "
               "payload_digest string, record_type string, refers_to bigint, archive string, "
               "at bigint")


def records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(value): the record of each page of (page_id, url, html)."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"),
                        F.octet_length(payload).cast("bigint").alias("bytes"),
                        F.sha1(F.encode(payload, "UTF-8")).alias("digest"))
    shared = (rows.where(F.col("bytes") >= revisit_bytes).groupBy("digest")
              .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1").select(F.col("digest").alias("d"), "first"))
    rows = rows.join(shared, (F.col("digest") == F.col("d"))
                     & (F.col("bytes") >= revisit_bytes), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("bytes"), F.lit("\r\n\r\n"))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    seconds = F.lit(EPOCH) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(CIRCLE))
    when = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    own = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    line = lambda name, *value: F.concat(F.lit(f"{name}: "), *value, F.lit("\r\n"))
    parts = [
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.lit("<urn:page:"), own, F.lit(">")),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Date", when),
        line("WARC-Payload-Digest", F.lit("sha1:"), F.col("digest")),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/"
                                       "identical-payload-digest")),
            line("WARC-Refers-To", F.lit("<urn:page:"), F.col("first"), F.lit(">")))
               ).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(head) + F.when(revisit, 0).otherwise(F.col("bytes"))),
        F.lit("\r\n"), head, F.when(revisit, "").otherwise(F.col("payload"))]
    return rows.select(F.concat(*parts).alias("value"))


def write_archives(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    (records(pages, revisit_bytes).write.option("lineSep", END.decode())
     .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def unpacked(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The decompressed bytes of an archive, in pieces; gzip members may follow each other."""
    view, inflate = memoryview(content), zlib.decompressobj(31)
    at = 0
    while at < len(view):
        data = bytes(view[at:at + step])
        at += step
        while data:
            yield inflate.decompress(data)
            data = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
    yield inflate.flush()


def parsed(pieces: Iterator[bytes]) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place in the unpacked archive, header fields, block) of each record."""
    held, at = bytearray(), 0

    def fill(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        searched = 0
        while (end := held.find(END, searched)) < 0:
            searched = max(0, len(held) - 3)
            if not fill(len(held) + 1):
                if held.strip():
                    raise ValueError("the archive ends inside a record head")
                return
        lines = bytes(held[:end]).decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        length = int(fields["Content-Length"])
        start = end + len(END)
        if not fill(start + length + len(END)) or held[start + length:start + length + 4] != END:
            raise ValueError(f"the record at {at} is not closed")
        yield at, fields, bytes(held[start:start + length])
        del held[:start + length + len(END)]
        at += start + length + len(END)


def url_key(url: str) -> str:
    """Host labels reversed and joined by commas, ``)``, then path and query."""
    found = re.match(r"(?s).*?://([^/?#]*)([^#]*)", url)
    host, rest = found.groups() if found else ("", "")
    return ",".join(reversed(host.lower().split("."))) + ")" + rest


def page_number(urn: str) -> int | None:
    inner = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


def capture(at: int, fields: dict[str, str], block: bytes, archive: str) -> tuple:
    head, _, payload = block.partition(END)
    claimed = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", head + b"\r\n")[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (
            len(payload) != claimed or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload at {at} of {archive} is not what its head says")
    refers = fields.get("WARC-Refers-To")
    return (url_key(fields.get("WARC-Target-URI", "")), fields["WARC-Date"],
            page_number(fields["WARC-Record-ID"]), archive, claimed, digest, fields["WARC-Type"],
            page_number(refers) if refers else None, archive, at)


def order(row: tuple) -> tuple:
    """Url key, time and id; a null id first."""
    return row[0], row[1], row[2] is not None, row[2] or 0


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[n] for r in rows], f.type)
                            for n, f in enumerate(schema)], schema=schema)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, content) of archives to their captures, each archive's in order."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            archive = path.as_py()
            found = sorted((capture(*record, archive) for record in parsed(
                unpacked(content.as_py()))), key=order)
            yield batch_of(found, CAPTURE)


class LoserTree:
    """Merges sorted runs: an inner node keeps the loser of its match, the top the winner."""

    def __init__(self, sorted_runs: list[list[tuple]]) -> None:
        self.runs = [iter(r) for r in sorted_runs]
        self.k = max(1, len(sorted_runs))
        self.heads = [next(r, None) for r in self.runs] + [None] * (self.k - len(self.runs))
        self.keys = [None if h is None else order(h) for h in self.heads]
        self.losers = [-1] * self.k
        for leaf in range(self.k):
            self.play(leaf)

    def beats(self, a: int, b: int) -> bool:
        if b < 0 or a < 0:
            return a < 0  # an empty place wins while the tree is built
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None
        return (self.keys[a], a) < (self.keys[b], b)

    def play(self, leaf: int) -> None:
        """Carries a leaf up along its path, leaving the loser at each node."""
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while True:
            at = self.losers[0]
            if at < 0 or self.keys[at] is None:
                return
            yield self.heads[at]
            self.heads[at] = next(self.runs[at], None)
            self.keys[at] = None if self.heads[at] is None else order(self.heads[at])
            self.play(at)


def merge_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the parts of all runs in one key range; adds the range and the place in it."""
    parts: dict[str, list[list[tuple]]] = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            own = parts.setdefault(row[3], [[]])
            # rows of a run arrive in order; should an exchange mix them, a new run begins
            if own[-1] and order(own[-1][-1]) > order(row):
                own.append([])
            own[-1].append(row)
    schema = CAPTURE.append(pa.field("range", pa.int32())).append(pa.field("place", pa.int64()))
    number, held = TaskContext.get().partitionId(), []
    for place, row in enumerate(LoserTree([r for own in parts.values() for r in own])):
        held.append((*row, number, place))
        if len(held) == 10_000:
            yield batch_of(held, schema)
            held = []
    yield batch_of(held, schema)


def merged_index(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """The captures of all archives under ``path`` with ``index_pos``, their global place."""
    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    found = scratch.keep(archives.mapInArrow(runs, CAPTURE_DDL), "runs")
    n = max(1, math.ceil(found.count() / CAPTURES_PER_RANGE))
    ranged = found.repartitionByRange(n, "url_key", "ts", "page_id")
    index = scratch.keep(ranged.mapInArrow(
        merge_range, CAPTURE_DDL + ", range int, place bigint"), "index")
    sizes = index.groupBy("range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy().orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("range", before.alias("start"))
    return index.join(starts, "range").withColumn("index_pos", F.col("start") + F.col("place"))


def archive_and_index(pages: DataFrame, scratch: Scratch, revisit_bytes: int = REVISIT_BYTES
                      ) -> DataFrame:
    """Writes the archives of ``pages`` and reads them back as one merged index."""
    path = f"{scratch.root}/archives"
    write_archives(pages, path, revisit_bytes)
    return merged_index(pages.sparkSession, path, scratch)
