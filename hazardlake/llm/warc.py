"""WARC archives: writing, reading in a stream, and revisit resolution.

Archives are gzip files that Spark's text writer makes: the record separator of WARC is its line
separator, so a lost task is written again like that of any other table. They are read back through
Spark's text reader, a file at a time and in order, and cut into records by their Content-Length.

Resolution shuffles headers alone, by payload digest. Of the responses with one payload the one with
the largest page id stays; all others, and the revisit records that the archives already held, are
joined to it. Payloads stay where they were staged; what was found goes back to them as one row of
arrays per staging task, and new archives are written with fresh headers.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazardlake.llm.common import carried, column, enter, settle, ship, stage
from hazardlake.session import new_folder

MIN_BYTES = 1000  # shorter payloads stay responses, as a revisit record would save little

# Fixed values of the format
END = "\r\n\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
CAPTURES = ("response", "revisit")

# ``digest`` is the bare hex SHA-1 of the payload and ``strong`` its SHA-256; ``head`` are the HTTP lines
# of a capture, or all header lines of a record that is neither response nor revisit.
RECORD = ("kind string, record_id string, date string, uri string, page_id long, digest string, strong string, "
          "payload_bytes long, refers_to string, refers_uri string, refers_date string, head binary")
ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


# --- writing ----------------------------------------------------------------------------------

def _uri(url: Column) -> Column:
    """A URL without the characters that would end its header line."""
    for char, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        url = F.replace(url, F.lit(char), F.lit(code))
    return url


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where its value is null."""
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit("")).cast("binary")


def _encoded(records: DataFrame) -> DataFrame:
    """Records (RECORD and ``payload``) as the text of their archive."""
    end = F.lit(END).cast("binary")
    revisit = F.col("kind") == "revisit"
    payload = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    block = F.concat(F.col("head"), end, payload)
    fresh = F.concat(
        F.lit(VERSION).cast("binary"), _line("WARC-Type", F.col("kind")), _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Date", F.col("date")), _line("WARC-Target-URI", F.col("uri")), _line("WARC-Page-ID", F.col("page_id")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Profile", F.when(revisit, PROFILE)), _line("WARC-Refers-To", F.when(revisit, F.col("refers_to"))),
        _line("WARC-Refers-To-Target-URI", F.when(revisit, F.col("refers_uri"))),
        _line("WARC-Refers-To-Date", F.when(revisit, F.col("refers_date"))),
        _line("Content-Type", F.lit(HTTP_TYPE)), _line("Content-Length", F.octet_length(block)), end, block)
    other = F.concat(F.col("head"), end, F.col("payload"))
    return records.select(F.when(F.col("kind").isin(*CAPTURES), fresh).otherwise(other).cast("string").alias("value"))


def _write(records: DataFrame, label: str) -> str:
    path = new_folder(records.sparkSession, label)
    _encoded(records).write.option("lineSep", END).text(path, compression="gzip")
    return path


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Write one response record per page; the folder of the archives is returned.

    Null html is an empty payload. Null ids and URLs leave their header line out; rows that repeat an id
    are records of their own. An empty table gives an empty archive. Other columns do not matter.
    """
    payload = F.coalesce(column(html_col), F.lit("")).cast("binary")
    at = F.md5(F.concat_ws(":", F.monotonically_increasing_id().cast("string"), column(id_col).cast("string")))
    uuid = F.concat_ws("-", *[F.substring(at, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    size = F.octet_length(payload)
    return _write(pages.select(
        F.lit("response").alias("kind"), F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">")).alias("record_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"), _uri(column(url_col)).alias("uri"),
        column(id_col).cast("long").alias("page_id"), F.sha1(payload).alias("digest"),
        F.concat(F.lit(HTTP_HEAD), size).cast("binary").alias("head"), payload.alias("payload"),
        *[F.lit(None).cast("string").alias(c) for c in ("refers_to", "refers_uri", "refers_date")]), "warc-raw")


# --- reading ----------------------------------------------------------------------------------

def _hex_digest(value: str | None) -> str | None:
    """The bare hex form of a SHA-1 header value, which may be in base 32."""
    algorithm, _, digits = (value or "").partition(":")
    if algorithm.lower() != "sha1":
        return None
    return digits.lower() if len(digits) == 40 else base64.b32decode(digits.upper()).hex()


def _record(header: bytes, block: bytes) -> dict:
    """One record: the fields of RECORD and ``payload``. A payload that is not what its header says raises."""
    first, *lines = header.decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines:
        name, _, value = line.partition(":")
        fields.setdefault(name.lower(), value.strip())
    kind = fields.get("warc-type")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:80]!r}")
    if kind not in CAPTURES:
        return {"kind": kind, "head": header, "payload": block}
    head, _, payload = block.partition(END.encode())
    if not fields.get("content-type", "").startswith("application/http"):
        head, payload = b"", block
    digest, page = _hex_digest(fields.get("warc-payload-digest")), fields.get("warc-page-id")
    found = {"kind": kind, "record_id": fields.get("warc-record-id"), "date": fields.get("warc-date"),
             "uri": fields.get("warc-target-uri"), "page_id": int(page) if page else None, "digest": digest,
             "refers_to": fields.get("warc-refers-to"), "refers_uri": fields.get("warc-refers-to-target-uri"),
             "refers_date": fields.get("warc-refers-to-date"), "head": head, "payload": payload}
    if kind == "response":
        found |= {"digest": hashlib.sha1(payload).hexdigest(), "strong": hashlib.sha256(payload).hexdigest(),
                  "payload_bytes": len(payload)}
        if digest not in (None, found["digest"]):
            raise ValueError(f"payload of {found['record_id']} is not what its digest says")
    return found


class _Archive:
    """The records of one file, whose bytes come in pieces."""

    def __init__(self, name: str):
        self.name, self.rest = name, b""

    def feed(self, piece: bytes) -> Iterator[dict]:
        buffer, at, end = self.rest + piece, 0, END.encode()
        while True:
            # the last piece of a file may come with one line end too many
            while buffer.startswith(b"\r\n", at):
                at += 2
            if (stop := buffer.find(end, at)) < 0:
                break
            header = buffer[at:stop]
            length = header.lower().partition(b"\r\ncontent-length:")[2].split(b"\r\n")[0]
            after = stop + len(end) + int(length)
            if len(buffer) < after + len(end):
                break
            yield _record(header, buffer[stop + len(end):after])
            at = after + len(end)
        self.rest = buffer[at:]

    def close(self) -> None:
        if self.rest.strip(b"\r\n"):
            raise ValueError(f"{self.name}: the last record is cut off")


def _cut(payloads: bool, names: list[str], kinds: list[str]):
    types = pa.schema([(n, ARROW[k]) for n, k in zip(names, kinds)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("warc")
        archive = None
        for batch in batches:
            runs = pc.run_end_encode(batch.column("file"))
            start, found = 0, []
            for name, stop in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if archive is None or archive.name != name:
                    if archive:
                        archive.close()
                    archive = _Archive(name)
                pieces = batch.column("value").slice(start, stop - start).to_pylist()
                found += archive.feed(END.encode().join([*pieces, b""]))
                start = stop
            if not payloads:
                for record in found:
                    record["payload"] = None
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in found], schema=types)
        if archive:
            archive.close()

    return cut


def records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in a folder: RECORD, and ``payload`` unless left out.

    A gzip file is read by one task, in order; a task holds one record and one batch. Response payloads
    are checked against their digest.
    """
    ship(spark)
    schema = RECORD + (", payload binary" if payloads else "")
    names, kinds = zip(*(field.split(" ") for field in schema.split(", ")))
    pieces = spark.read.option("lineSep", END).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(_cut(payloads, list(names), list(kinds)), schema)


# --- resolution -------------------------------------------------------------------------------

def _resolved(staged: DataFrame, min_bytes: int) -> DataFrame:
    """What each staged record that refers to another one refers to, by its address (sender, seq)."""
    def field(name: str) -> Column:
        return F.col("row").getField(name).alias(name)

    headers = staged.select("sender", "seq", *[field(c) for c in (
        "kind", "record_id", "date", "uri", "page_id", "digest", "strong", "payload_bytes")]) \
        .filter(F.col("kind").isin(*CAPTURES))
    # largest id first, a null one last; among records that repeat it, the one staged last
    place = F.struct("page_id", "sender", "seq")
    response = F.col("kind") == "response"
    originals = headers.groupBy("digest").agg(
        F.max(F.when(response, F.struct(place.alias("place"), "record_id", "date", "uri", "payload_bytes"))).alias("top"),
        F.min("strong").alias("one"), F.max("strong").alias("other"), F.count("*").alias("copies"))
    different = F.raise_error(F.lit("different payloads share a SHA-1")).cast("boolean")
    originals = originals.filter("copies > 1 AND top IS NOT NULL") \
        .filter(F.when(F.col("one") != F.col("other"), different).otherwise(True)).drop("one", "other", "copies")
    # written out, so that both sides of the join are plain shuffles, which AQE splits when skewed
    originals = settle(originals, "warc-originals")
    return headers.join(originals, "digest").filter(
        ~response | ((F.col("payload_bytes") >= min_bytes) & (place != F.col("top.place")))).select(
        "sender", "seq", F.col("top.record_id").alias("to"), F.col("top.uri").alias("to_uri"), F.col("top.date").alias("to_date"))


def deduplicated(spark: SparkSession, path: str, min_bytes: int = MIN_BYTES) -> str:
    """Write the archives of a folder anew with every repeated payload stored once; their folder is returned.

    Of response records with equal payloads of at least ``min_bytes`` the one with the largest page id
    stays (a null id is less than any; of records that repeat it, one), all others become revisit records
    of it. Revisit records that were there before refer to the same record; where no response in the
    folder has their payload, they stay as they were. Records of other kinds are copied.
    """
    staged = stage(records(spark, path), "warc")
    found = settle(_resolved(staged, min_bytes), "warc-found")
    rows = carried(staged.select("sender", "seq", "row"), found, ["to", "to_uri", "to_date"], everything=True)
    refers = F.col("to").isNotNull()
    fresh = {"kind": F.lit("revisit"), "refers_to": F.col("to"), "refers_uri": F.col("to_uri"), "refers_date": F.col("to_date")}
    names = staged.schema["row"].dataType.names
    as_stored = {n: F.col("row").getField(n) for n in names}
    return _write(rows.select(*[
        F.when(refers, fresh[n]).otherwise(as_stored[n]).alias(n) if n in fresh else as_stored[n].alias(n)
        for n in names]), "warc")


def captures(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record of the archives, read back.

    ``page_id``, ``payload_bytes`` and ``payload_digest`` of the full payload, ``record_type``, and
    ``refers_to``, the page id of the response that holds a revisit's payload.
    """
    headers = settle(records(spark, path, payloads=False).drop("head", "strong"), "warc-headers") \
        .filter(F.col("kind").isin(*CAPTURES))
    responses = headers.filter("kind = 'response'")
    held = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("to_page"),
                            F.col("payload_bytes").alias("to_bytes"))
    revisits = headers.filter("kind = 'revisit'").join(held, "refers_to", "left").select(
        "page_id", F.col("to_bytes").alias("payload_bytes"), "digest", "kind", F.col("to_page").alias("refers_to"))
    return responses.select("page_id", "payload_bytes", "digest", "kind", F.lit(None).cast("long").alias("refers_to")) \
        .unionByName(revisits).withColumnsRenamed({"digest": "payload_digest", "kind": "record_type"})
