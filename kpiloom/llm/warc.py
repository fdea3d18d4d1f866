"""WARC archives with revisit records, and their capture index by external merge.

Writing: each page becomes one record; of pages with equal payloads of a least size,
the one with the smallest id is the response and the others are revisits that name
it.  A record is text in UTF-8 and ends with two line ends, so Spark's own text sink
writes the archives (one gzip member per file) to any store Spark can reach.

Reading: archives come back as binary files; records are read one by one by their
stated lengths, and each response's payload is held against its stated digest.

Index: the captures found by a task are sorted there by URL key and time (a run), and
runs stay on disk.  They are cut at common range bounds and every range is merged from
its runs by a loser tree, so the parts of the result, in order, are one globally ordered
history.  The number of ranges follows the number of captures, so a task holds about
``CAPTURES_PER_RANGE`` of them whatever the input.  Bounds are on (URL key, time, id, file,
offset), which no two captures share: one URL, or one row repeated, may span many ranges.

Defined results: null html counts as empty, a null URL has an empty key; a page whose
id is null never becomes the response others name (unless all ids of its payload are
null: then each is a response); repeated rows are records of their own, and two rows
that share the smallest id are both responses; an empty table gives an empty archive
and index; other columns are not read.  Ties go by id, in the order of its type, null first.
Where pages carry no time, an integral id counts as seconds from a fixed start; ids of
other types, those beyond the years 1 to 9999 and unknown times count as that start.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from urllib.parse import unquote_plus, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.llm.common import lookup, quoted, ship, text_of
from kpiloom.session import stage, stage_path

#: Smaller payloads are always written out.
LEAST_BYTES = 100
#: Records of a file by the size of their payloads: a file holds about 130 MB at most, or one record.
RECORDS_PER_FILE = {64 * 1024: 2000, 1024 * 1024: 128, 16 * 1024 * 1024: 8, None: 1}
CAPTURES_PER_RANGE = 50_000
#: First and last second of the years that a WARC date can tell.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799
CRLF = "\r\n"
#: Fixed value: profile of a revisit whose payload digest equals that of an earlier record.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Record id of a page whose id is null.
NO_ID = "<urn:x-no-page>"
#: Where pages carry no capture time, their id counts as seconds from here on.
EPOCH = 1_500_000_000


def _one_line(column: Column) -> Column:
    return F.replace(F.replace(column, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def with_payload(pages: DataFrame, id: str, url: str, html: str, captured: str | None) -> DataFrame:
    start = F.lit(EPOCH).cast("long")
    if captured:
        seconds = F.unix_seconds(quoted(captured).try_cast("timestamp"))
    elif isinstance(pages.schema[id].dataType, T.IntegralType):
        seconds = F.try_add(quoted(id).cast("long"), start)
    else:
        seconds = F.lit(None).cast("long")
    inside = seconds.between(FIRST_SECOND, LAST_SECOND)
    time = F.timestamp_seconds(F.when(inside, seconds).otherwise(start))
    frame = pages.select(
        quoted(id).cast("string").alias("page_id"), quoted(id).alias("order_id"), quoted(url).alias("url"),
        time.alias("time"), text_of(quoted(html)).alias("payload"),
    )
    return frame.withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"),
        "digest": F.sha2(F.col("payload").cast("binary"), 256),
    })


def record(refers_to: Column) -> Column:
    """The whole record but its closing line ends."""
    revisit = refers_to.isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF),
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    def urn(column: Column) -> Column:
        return F.concat(F.lit("<urn:x-page:"), F.url_encode(column), F.lit(">"))

    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit(NO_ID))),
        line("WARC-Date", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", _one_line(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("WARC-Refers-To", F.when(revisit, urn(refers_to))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        F.lit("Content-Length: "), length.cast("string"), F.lit(CRLF + CRLF),
        http, F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )


def write_archives(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html",
    captured: str | None = None, least_bytes: int = LEAST_BYTES,
) -> None:
    """One record per page, as gzipped WARC files below ``path``.

    Digests are grouped without the payloads; the payloads move once, dealt by digest,
    with the digests of many pages spread.
    """
    frame = with_payload(pages, id, url, html, captured)
    firsts = stage(
        frame.where(F.col("payload_bytes") >= least_bytes).groupBy("digest")
        .agg(F.min("order_id").cast("string").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1),
        "firsts",
    )
    told = lookup(frame, firsts.select("digest", "first_id"), "digest", counts=firsts.select("digest", "n"))
    refers_to = F.when(F.col("page_id").eqNullSafe(F.col("first_id")), None).otherwise(F.col("first_id"))
    size, least = F.col("payload_bytes"), 0
    longest = frame.agg(F.max("payload_bytes")).first()[0] or 0
    for below, records_per_file in RECORDS_PER_FILE.items():
        if least and longest < least:
            break
        some = told.where(size >= least if below is None else (size >= least) & (size < below))
        some.select(record(refers_to).alias("value")).write.mode("append").option("lineSep", CRLF + CRLF).option(
            "compression", "gzip"
        ).option("maxRecordsPerFile", records_per_file).text(path)
        least = below


# --- reading ------------------------------------------------------------------------


def url_key(url: str) -> str:
    """Host labels from the top domain down, then path and query; without scheme, ``www`` and user."""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    labels = host.removeprefix("www.").split(".")
    usual = {"http": 80, "https": 443}.get(parts.scheme.lower())
    where = ",".join(reversed(labels)) + (f":{port}" if port and port != usual else "")
    query = f"?{parts.query}" if parts.query else ""
    return f"{where}){(parts.path or '/').lower()}{query.lower()}"


def records(stream):
    """Header fields, offset and HTTP block of every record of an opened archive."""
    while True:
        offset = stream.tell()
        first = stream.readline()
        if not first:
            return
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record at {offset}")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record at {offset} is cut short")
        yield fields, offset, block


def _own(urn: str | None) -> str | None:
    return None if urn in (None, NO_ID) else unquote_plus(urn.removeprefix("<urn:x-page:").removesuffix(">"))


def capture(fields: dict[str, str], block: bytes) -> tuple:
    """One capture; a response whose payload does not match its digest is an error."""
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response":
        size = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"digest of {fields['warc-record-id']} does not match")
    else:
        size = int(head.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
    return (
        url_key(fields.get("warc-target-uri", "")), fields["warc-date"], _own(fields["warc-record-id"]), size,
        digest, kind, _own(fields.get("warc-refers-to")),
    )


NAMES = ["url_key", "captured", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset"]
_KINDS = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
_SCHEMA = ("url_key string, captured string, page_id string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to string, file string, offset long")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives below ``path``."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows = []
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_py())) as stream:
                    for fields, offset, block in records(stream):
                        rows.append((*capture(fields, block), name.as_py(), offset))
                columns = list(zip(*rows)) or [[]] * len(NAMES)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, _KINDS)], NAMES)

    return files.mapInArrow(run, _SCHEMA)


# --- index --------------------------------------------------------------------------


class LoserTree:
    """Merges sorted runs of keys; yields the number of the run whose head is next."""

    def __init__(self, runs: list[list]):
        self.runs, self.k = runs, len(runs)
        self.at = [0] * self.k
        self.tree = [-1] * self.k  # losers inside, the winner at 0
        winners = [0] * (2 * self.k)
        for i in range(self.k):
            winners[self.k + i] = i
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winner, loser = (a, b) if self._before(a, b) else (b, a)
            winners[node], self.tree[node] = winner, loser
        self.tree[0] = winners[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.runs[a], self.runs[b]
        i, j = self.at[a], self.at[b]
        if i == len(x) or j == len(y):
            return j == len(y) and (i < len(x) or a < b)
        return (x[i], a) < (y[j], b)

    def __iter__(self):
        for _ in range(sum(map(len, self.runs))):
            winner = self.tree[0]
            yield winner, self.at[winner]
            self.at[winner] += 1
            node = (self.k + winner) // 2
            while node:
                if self._before(self.tree[node], winner):
                    self.tree[node], winner = winner, self.tree[node]
                node //= 2
            self.tree[0] = winner


def merge_order(keys: list) -> list[int]:
    """Order of the rows by key, from the ascending runs in which they came."""
    starts = [0] + [i for i in range(1, len(keys)) if keys[i] < keys[i - 1]] if keys else []
    runs = [keys[s:e] for s, e in zip(starts, [*starts[1:], len(keys)])]
    return [starts[r] + i for r, i in LoserTree(runs)] if runs else []


def merge_index(captures: DataFrame, id_type: T.DataType | None = None) -> DataFrame:
    """The captures (a written table) in order of URL key, time, id, file and offset: runs, cut into ranges, merged."""
    ship(captures.sparkSession)
    order = ["url_key", "captured", "page_order", "file", "offset"]
    frame = captures.withColumn("page_order", F.col("page_id").cast(id_type or T.StringType()))
    ranges = max(1, -(-captures.count() // CAPTURES_PER_RANGE))
    runs = frame.sortWithinPartitions(*order)

    def run(batches):
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        keys = list(zip(*[[(v is not None, v) for v in table.column(c).to_pylist()] for c in order]))
        merged = table.take(pa.array(merge_order(keys), pa.int64())).select(NAMES).combine_chunks()
        yield from merged.to_batches(max_chunksize=8192)

    return runs.repartitionByRange(ranges, *order).mapInArrow(run, _SCHEMA)


def archive(
    pages: DataFrame, path: str | None = None, id: str = "page_id", url: str = "url", html: str = "html",
    captured: str | None = None, least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """Write the archives, read them back, and return their merged index (ids in their own type)."""
    spark = pages.sparkSession
    path = path or stage_path(spark, "warc")
    write_archives(pages, path, id, url, html, captured, least_bytes)
    kind = pages.schema[id].dataType
    return merge_index(stage(read_archives(spark, path), "captures"), kind).withColumns({
        "page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind),
    })
