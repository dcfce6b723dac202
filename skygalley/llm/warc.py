"""WARC archives: written from pages, read back as records, records assembled into captures.

A page becomes a transaction of three records: its response (or a revisit, if an equal payload is archived under a smaller
id), the request, and a metadata record; the last two name the first in ``WARC-Concurrent-To``.

Method of reading: transaction assembly. Records are joined through their concurrent-to identifiers, whichever side names the
other, and each capture comes out as one nested row. Revisits are resolved by a join on what they refer to.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygalley.llm.exchange import materialize, text_bytes

# Payload behind one archive file. A file is read by one task, so it stays well below an executor's memory.
ARCHIVE_BYTES = 16 << 20
# Records of one Arrow batch, by the bytes of their blocks.
BATCH_BYTES = 4 << 20
# Smaller payloads are archived each time.
REVISIT_BYTES = 100
# A key with at least this share of the rows is hot; there are no more than 1 / HOT_SHARE of them.
HOT_SHARE = 0.001
# Requests or metadata records of a hot capture in one array.
PART_RECORDS = 1024

END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADS = ("response", "revisit", "resource", "conversion")

_STRING = ("string", pa.string())
_COLUMNS = {
    "archive": _STRING,
    "offset": ("long", pa.int64()),
    "record_id": _STRING,
    "type": _STRING,
    "date": _STRING,
    "target_uri": _STRING,
    "concurrent_to": ("array<string>", pa.list_(pa.string())),
    "refers_to": _STRING,
    "content_type": _STRING,
    "payload_bytes": ("long", pa.int64()),
    "payload_digest": _STRING,
    "fields": ("map<string, string>", pa.map_(pa.string(), pa.string())),
    "payload": ("binary", pa.binary()),
}
_RECORDS = ", ".join(f"{name} {kind}" for name, (kind, _) in _COLUMNS.items())


# --- writing --------------------------------------------------------------------------------------


def hot_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """The keys with at least ``HOT_SHARE`` of all that ``counts`` (key, n) counts: at most 1 / HOT_SHARE rows.

    That bound holds for any input, so the result may be broadcast.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.where(F.col(n) >= F.lit(total * HOT_SHARE)).where(F.col(n) > 1)


def _uuid(*parts: Column | str) -> Column:
    """A record id that depends on the content alone, so that a repeated task writes the same one."""
    digest = F.md5(F.to_json(F.struct(*parts)).cast("binary"))
    cuts = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(kind: Column, record_id: Column, date: str, content_type: str, fields: list[Column], block: Column) -> Column:
    """Header and block; a field that is null is left out."""
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {date}"),
        *fields,
        F.lit(f"Content-Type: {content_type}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def plan_captures(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    """Per page: page_id, url, body, bytes, digest, first_id, first_url; the first ones are null unless it is a revisit.

    Payloads are compared by SHA-256. The payloads that are shared are few and small rows; those that at least a thousandth
    of the shared rows have are at most a thousand and broadcast, and their pages are dealt by row, not by payload.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("body"),
    )
    rows = rows.withColumn("bytes", F.octet_length("body").cast("long"))
    rows = rows.withColumn("digest", F.sha2(F.col("body").cast("binary"), 256))
    archives = max(1, -(-text_bytes(pages, payload) // ARCHIVE_BYTES))
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    shared = rows.where(F.col("bytes") >= REVISIT_BYTES).groupBy(F.col("digest").alias("of"))
    shared = shared.agg(F.min(named).alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    shared = materialize(shared, "shared_payloads")
    hot = hot_keys(shared, "of").select(F.col("of").alias("hot_of"), F.col("first").alias("hot_first"))
    rows = rows.join(F.broadcast(hot), (F.col("digest") == F.col("hot_of")) & (F.col("bytes") >= REVISIT_BYTES), "left")
    settled = F.col("hot_of").isNotNull() | (F.col("bytes") < REVISIT_BYTES)
    by_row = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string"))
    rows = rows.withColumn("of", F.when(settled, by_row).otherwise(F.col("digest")))
    # The join reuses this deal, so a page moves once, and every task writes one archive.
    rows = rows.repartition(archives, "of")
    rows = rows.join(shared.select("of", "first").repartition(archives, "of"), "of", "left")
    first = F.coalesce("hot_first", "first")
    again = F.coalesce((F.col("page_id") > first["page_id"]) | F.col("page_id").isNull(), F.lit(False))
    first = F.when(again, first)
    return rows.select(
        "page_id", "url", "body", "bytes", "digest", first["page_id"].alias("first_id"), first["url"].alias("first_url")
    )


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    compression: str = "gzip",
) -> None:
    """Write request, response or revisit, and metadata record of every page as WARC 1.1 files under ``path``.

    Of pages with equal payloads of at least 100 bytes the smallest page_id is the response and the others revisit it;
    a page without id revisits if any page with an id has the payload. Rows that repeat the smallest id are responses, too.
    A null payload is empty; a null url is left out of the records; line breaks in a url are escaped. Rows that are
    equal in id, url and payload get the same record ids, and come back as copies of one capture. Other columns are ignored.
    """
    rows = plan_captures(pages, page_id, url, payload)
    kind = F.when(F.col("first_id").isNull(), "response").otherwise("revisit")
    own = _uuid("page_id", "url", "digest", kind.alias("kind"))
    origin = _uuid(
        F.col("first_id").alias("page_id"), F.col("first_url").alias("url"), "digest", F.lit("response").alias("kind")
    )
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    target = _field("WARC-Target-URI", uri)
    concurrent = _field("WARC-Concurrent-To", own)
    again = F.col("first_id").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END),
        F.when(again, "").otherwise(F.col("body")),
    )
    head_fields = [
        target,
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(again, _field("WARC-Refers-To", origin)),
        F.when(again, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
    ]
    about = F.concat(
        F.when(F.col("page_id").isNotNull(), _field("page-id", F.col("page_id").cast("string"))).otherwise(""), F.lit("\r\n")
    )
    records = [
        _record(
            F.lit("request"),
            _uuid(own.alias("of"), F.lit("request").alias("kind")),
            date,
            "application/http; msgtype=request",
            [target, concurrent],
            F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1" + END)),
        ),
        _record(kind, own, date, "application/http; msgtype=response", head_fields, http),
        _record(
            F.lit("metadata"),
            _uuid(own.alias("of"), F.lit("metadata").alias("kind")),
            date,
            "application/warc-fields",
            [target, concurrent],
            about,
        ),
    ]
    out = rows.select(F.concat_ws(END, *records).alias("value"))
    # Two line ends close every record of the format, so they are what the text writer puts between rows.
    out.write.option("lineSep", END).option("compression", compression).text(path)


# --- reading --------------------------------------------------------------------------------------

_HEADER_END = re.compile(rb"\r?\n\r?\n")


def _plain(content: bytes) -> bytes:
    """The bytes of a file, whether it is plain, one gzip member, or a member for each record."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out)


def _fields(lines: bytes) -> list[tuple[str, str]]:
    """(name in lower case, value) of each field; a line that begins with white space goes on with the last value."""
    out: list[tuple[str, str]] = []
    for line in lines.decode("utf-8", "replace").replace("\r\n", "\n").split("\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            out.append((name.strip().lower(), value.strip()))
    return out


def parse_archive(name: str, content: bytes, payloads: bool) -> Iterator[list]:
    """The records of one file, as values in the order of the schema. What is no record raises."""
    data = _plain(content)
    at, size = 0, len(data)
    while True:
        while at < size and data[at] in b"\r\n":
            at += 1
        if at >= size:
            return
        end = _HEADER_END.search(data, at)
        if data[at : at + 5] != b"WARC/" or not end:
            raise ValueError(f"{name}: no record at byte {at}")
        fields = _fields(data[data.index(b"\n", at) + 1 : end.start()])
        first = dict(reversed(fields))
        length = first.get("content-length", "")
        if not length.isdigit() or end.end() + int(length) > size:
            raise ValueError(f"{name}: the record at byte {at} has no whole block")
        start, stop = end.end(), end.end() + int(length)
        kind = first.get("warc-type", "").lower()
        content_type = first.get("content-type")
        about = None
        body = start
        if content_type and content_type.startswith("application/http"):
            split = _HEADER_END.search(data, start, stop)
            body = split.end() if split else stop
        elif content_type == "application/warc-fields":
            about = _fields(data[start:stop])
        payload, digest, n_bytes = None, first.get("warc-payload-digest"), None
        if kind in HEADS and kind != "revisit":
            payload = data[body:stop]
            digest, n_bytes = hashlib.sha256(payload).hexdigest(), len(payload)
        elif digest and digest.startswith("sha256:"):
            digest = digest[7:]
        yield [
            name,
            at,
            first.get("warc-record-id"),
            kind,
            first.get("warc-date"),
            first.get("warc-target-uri"),
            [v for k, v in fields if k == "warc-concurrent-to"],
            first.get("warc-refers-to"),
            content_type,
            n_bytes,
            digest,
            about,
            payload if payloads else None,
        ]
        at = stop


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under ``path``: where each lies, its header, and its payload if asked for.

    ``payload_bytes`` and ``payload_digest`` (SHA-256, hex) are taken from the payload itself, in revisits from the header.
    The payload of an HTTP response begins after the HTTP header, and is not decoded further. ``fields`` holds the
    fields of a metadata record. Offsets count in the uncompressed file. Empty files hold no records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for row in parse_archive(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), payloads):
                    rows.append(row)
                    held += 512 + len(row[-1] or b"")
                    if held > BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(run, _RECORDS)


def _batch(rows: list[list]) -> pa.RecordBatch:
    arrays = [pa.array(values, kind) for values, (_, kind) in zip(zip(*rows), _COLUMNS.values())]
    return pa.RecordBatch.from_arrays(arrays, names=list(_COLUMNS))


# --- assembly -------------------------------------------------------------------------------------

_HEADER = [c for c in _COLUMNS if c not in ("payload", "concurrent_to", "fields")]


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, copies, response, requests, metadata.

    A capture is a record of type response, revisit, resource or conversion. Any other record belongs to the captures that
    it names in concurrent-to or that name it; one that names another such record belongs to the captures of that one. Records
    with one id are copies of each other: one row, with their number in ``copies``. A record of no capture comes out
    under the id it names (or its own) with a null ``response``. Records without an id are captures, or belong to
    those they name, one by one. ``metadata`` also holds the fields of the record.

    Arrays are bounded: a capture to which a thousandth of the others or more belong, and more than 1,024, is split into
    rows of ``part`` 0, 1, ..., of which the first has the response.
    """
    named = F.coalesce("record_id", F.concat(F.lit("at "), "archive", F.lit(" "), F.col("offset").cast("string")))
    fields = F.to_json("fields").alias("about")
    rows = records.select(named.alias("id"), F.struct(*_HEADER).alias("header"), "concurrent_to", fields)
    # Copies meet inside each task first, so one record that is repeated without end is one row per task.
    rows = rows.groupBy("id").agg(
        F.min("header").alias("header"),
        F.min("concurrent_to").alias("concurrent_to"),
        F.min("about").alias("about"),
        F.count("*").alias("copies"),
    )
    rows = materialize(rows, "records")
    is_head = F.col("header.type").isin(*HEADS)
    heads, others = rows.where(is_head), rows.where(~is_head)
    links = _links(heads, others)
    members = links.join(others, F.col("member") == F.col("id"))
    members = _parts(members.select("capture_id", F.struct("header.*", "about").alias("m")))
    is_request = F.col("m.type") == "request"
    gathered = members.groupBy(F.col("capture_id").alias("of"), "part").agg(
        F.array_sort(F.collect_list(F.when(is_request, F.col("m").dropFields("about")))).alias("requests"),
        F.array_sort(F.collect_list(F.when(~is_request, F.col("m")))).alias("metadata"),
    )

    def with_fields(m: Column) -> Column:
        about = F.from_json(m["about"], "map<string, string>")
        return F.struct(*[m[c].alias(c) for c in _HEADER], about.alias("fields"))

    gathered = gathered.withColumn("metadata", F.transform("metadata", with_fields))
    captures = heads.select("id", "copies", F.col("header").alias("response"), F.lit(0).alias("head_part"))
    met = (F.col("id") == F.col("of")) & (F.col("head_part") == F.col("part"))
    whole = captures.join(gathered, met, "full_outer")
    none = F.array()
    return whole.select(
        F.coalesce("id", "of").alias("capture_id"),
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
        "response",
        F.coalesce("requests", none).alias("requests"),
        F.coalesce("metadata", none).alias("metadata"),
    )


def _links(heads: DataFrame, others: DataFrame) -> DataFrame:
    """(capture_id, member): every record that is no capture, with each capture it is joined to by concurrent-to."""
    head, other = heads.select(F.col("id").alias("head")), others.select(F.col("id").alias("other"))
    told = heads.select(F.col("id").alias("capture_id"), F.explode("concurrent_to").alias("member"))
    told = told.join(other, F.col("member") == F.col("other"), "left_semi")
    named = others.select(F.col("id").alias("member"), F.explode("concurrent_to").alias("to"))
    direct = named.join(head, F.col("to") == F.col("head"), "left_semi").select(F.col("to").alias("capture_id"), "member")
    found = told.unionByName(direct).distinct()
    # what names another such record belongs wherever that one does
    chained = named.join(other, F.col("to") == F.col("other"), "left_semi")
    if not chained.isEmpty():
        found = latest = materialize(found, "members")
        while True:
            step = latest.select("capture_id", F.col("member").alias("to"))
            step = chained.join(step, "to").select("capture_id", "member").distinct()
            latest = materialize(step.join(found, ["capture_id", "member"], "left_anti"), "members")
            if latest.isEmpty():
                break
            found = found.unionByName(latest)
    lone = others.join(found.select("member").distinct(), F.col("id") == F.col("member"), "left_anti")
    lone = lone.select(F.coalesce(F.get("concurrent_to", F.lit(0)), "id").alias("capture_id"), F.col("id").alias("member"))
    return found.unionByName(lone)


def _parts(members: DataFrame) -> DataFrame:
    """Add ``part``: 0, but for captures with very many members, which are dealt over parts by hash."""
    members = materialize(members, "members")
    counts = members.groupBy(F.col("capture_id").alias("hot")).agg(F.count("*").alias("n"))
    hot = hot_keys(counts, "hot").where(F.col("n") > PART_RECORDS)
    dealt = members.join(F.broadcast(hot), F.col("capture_id") == F.col("hot"), "left")
    part = F.pmod(F.xxhash64("m.record_id", "m.archive", "m.offset"), F.ceil(F.col("n") / PART_RECORDS))
    return dealt.select("capture_id", "m", F.coalesce(part, F.lit(0)).cast("int").alias("part"))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Add ``origin``: the nested row (capture_id, response, metadata) of the response that a revisit refers to, else null.

    Revisits of one response may be a third of all rows: the responses that are revisited most (at most a thousand,
    by their share) are broadcast, the others joined.
    """
    captures = materialize(captures, "captures")  # read four times below
    refers = F.col("response.refers_to")
    is_revisit = F.col("response.type") == "revisit"
    counts = captures.where(is_revisit).groupBy(refers.alias("hot")).agg(F.count("*").alias("n"))
    hot = hot_keys(counts, "hot").select("hot")
    target = F.struct("capture_id", "response", "metadata")
    targets = captures.where((F.col("response.type") == "response") & (F.col("part") == 0))
    targets = targets.select(F.col("capture_id").alias("of"), target.alias("origin"))
    often = targets.join(F.broadcast(hot), F.col("of") == F.col("hot"), "left_semi")
    often = often.select(F.col("of").alias("often_of"), F.col("origin").alias("often"))
    rows = captures.join(F.broadcast(often), is_revisit & (refers == F.col("often_of")), "left")
    settled = ~is_revisit | F.col("often_of").isNotNull() | is_revisit.isNull()
    key = F.when(settled, F.concat(F.lit("own "), F.col("capture_id"))).otherwise(refers)
    rows = rows.withColumn("of", F.coalesce(key, F.lit("none")))
    rows = rows.join(targets, "of", "left")
    return rows.select(*captures.columns, F.coalesce("often", "origin").alias("origin"))
