"""WARC archives: written as record text by Spark, read back with boundary-chain verification.

Writing. A page becomes one record: ``response`` with an HTTP head and the payload, or ``revisit`` without payload
where an equal payload of at least ``least_bytes`` bytes stands under a smaller id. A record ends with a blank line
twice, which is the row separator of Spark's text sink, so archives are plain UTF-8 files that Spark writes and splits.

Reading. Where a record begins can't be told by its magic alone: a payload may hold the same characters. So
1. tasks cut their splits at each line that begins with ``WARC/1.`` and emit a *candidate*: its offset in the file and,
   by its Content-Length, the offset of its successor. Offsets inside a split are running sums; the splits' first
   offsets follow from the lengths of the splits before them (one small row a split);
2. *pointer jumping* from offset 0 of each file marks the candidates that the chain reaches: each round doubles the
   jumps, so a file of n records takes log2(n) rounds. What isn't reached is payload, however much it looks like a
   record;
3. a piece that isn't reached belongs to the record before it (again by pointer jumping, on the few such pieces), and
   the payload is put together from its pieces.

A chain that breaks (a damaged or cut record) ends there: later records of that file aren't reachable and don't count.
Null payloads are empty; null urls give records without target. CR and LF in a url are percent-encoded. A null id
gives a record without one; it is no other page's original. Rows that repeat the smallest id of a group are all
responses. An empty table gives an empty archive and no records. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map, stored

MAGIC = "WARC/1."
LINE_MAGIC = "\n" + MAGIC
END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
LEAST_BYTES = 100
MAX_ROUNDS = 64


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")))


def _originals(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id``, ``digest``, ``original`` of pages whose payload stands under a smaller id too."""
    narrow = pages.where(F.col("bytes") >= least_bytes).select("page_id", "digest")
    groups = (narrow.groupBy("digest").agg(F.min("page_id").alias("original"), F.count("*").alias("n"))
              .where("n > 1 and original is not null").drop("n"))
    again = narrow.join(groups, "digest").where("page_id is null or page_id <> original")
    return again.select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "original").distinct()


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", least_bytes: int = LEAST_BYTES) -> None:
    """One record for each row of ``pages``, into WARC files in the folder ``path``."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         payload.alias("payload"))
            .withColumn("bytes", F.octet_length("payload"))
            .withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)))
    originals = stored(_originals(rows, least_bytes), "warc-originals")
    marked = rows.join(originals, F.col("page_id").eqNullSafe(F.col("again_id"))
                       & (F.col("digest") == F.col("again_digest")), "left")
    again = F.col("original").isNotNull()
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    body = F.when(again, F.lit("")).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("payload")))
    head = F.concat(
        F.lit(MAGIC + "1\r\n"),
        _field("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))),
        _field("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _field("WARC-Profile", F.when(again, F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _field("X-Page-ID", F.col("page_id")),
        _field("X-Refers-To-Page-ID", F.col("original")),
        _field("X-Payload-Length", F.col("bytes")),
        _field("Content-Type", F.when(~again, F.lit("application/http; msgtype=response"))),
        _field("Content-Length", F.octet_length(body)),
        F.lit("\r\n"))
    marked.select(F.concat(head, body)).write.option("lineSep", END).text(path)


_NAMES = {b"warc-type": "record_type", b"warc-target-uri": "url", b"warc-payload-digest": "stated_digest",
          b"x-page-id": "page_id", b"x-refers-to-page-id": "refers_to", b"x-payload-length": "stated_bytes"}
_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r?\n")
_PIECES = pa.schema([
    ("file", pa.string()), ("split", pa.int64()), ("number", pa.int64()), ("at", pa.int64()), ("size", pa.int64()),
    ("head", pa.int64()), ("length", pa.int64()), ("whole", pa.bool_()), ("record_type", pa.string()), ("url", pa.string()),
    ("stated_digest", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("stated_bytes", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("piece", pa.binary())])
_PIECES_SQL = ("file string, split long, number long, at long, size long, head long, length long, whole boolean, "
               "record_type string, url string, stated_digest string, page_id long, refers_to long, stated_bytes long, "
               "payload_bytes long, payload_digest string, piece binary")


_RECORDS = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("whole", pa.bool_()), ("record_type", pa.string()),
    ("url", pa.string()), ("stated_digest", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()),
    ("stated_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary())])
_RECORDS_SQL = ("file string, offset long, whole boolean, record_type string, url string, stated_digest string, "
                "page_id long, refers_to long, stated_bytes long, payload_bytes long, payload_digest string, "
                "payload binary")


def payload_of(block: bytes) -> bytes:
    """The payload of a record's block: behind the HTTP head if there is one."""
    if block.startswith(b"HTTP/"):
        end = block.find(b"\r\n\r\n")
        return block[end + 4:] if end >= 0 else b""
    return block


def long_of(text: str) -> int | None:
    """The integer that ``text`` states, if it fits a signed 64-bit long."""
    if not (digits := re.fullmatch(r"([+-]?)0*([0-9]+)", text)) or len(digits[2]) > 19:
        return None
    value = int(digits[1] + digits[2])
    return value if -(1 << 63) <= value < 1 << 63 else None


def parse_piece(piece: bytes) -> dict:
    """What a piece (from one line with the magic to the next) says, read as the beginning of a record."""
    found: dict = {"size": len(piece), "head": -1, "length": -1, "whole": False, "piece": None}
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return found
    found["head"] = end + 4
    for name, value in _FIELD.findall(piece, 0, end + 2):
        name = name.strip().lower()
        if name == b"content-length":
            found["length"] = int(value) if value.strip().isdigit() and len(value) < 18 else -1
        elif (key := _NAMES.get(name)) is not None:
            text = value.strip().decode("utf-8", "replace")
            if key in ("page_id", "refers_to", "stated_bytes"):
                found[key] = long_of(text)
            else:
                found[key] = text
    if 0 <= found["length"] and found["head"] + found["length"] + 4 <= len(piece):
        payload = payload_of(piece[found["head"]:found["head"] + found["length"]])
        found |= {"whole": True, "payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest()}
    return found


def pieces(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The candidates of all files under ``path``: one row for each piece, with its place ``at`` in its file's split
    and, on request, its bytes."""
    lines = (spark.read.option("lineSep", LINE_MAGIC).text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                     F.col("value").cast("binary").alias("line")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, number, at = None, 0, 0
        for batch in batches:
            out = []
            for file, split, line in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if (file, split) != here:
                    here, number, at = (file, split), 0, 0
                first = split == 0 and number == 0
                # the cut took the magic away; the file's first piece has it still. "\n" belongs to the piece before
                piece = line + b"\n" if first else MAGIC.encode() + line + b"\n"
                found = parse_piece(piece)
                if with_payload:
                    found["piece"] = piece
                out.append({"file": file, "split": split, "number": number, "at": at, **found})
                number, at = number + 1, at + len(piece)
            yield pa.RecordBatch.from_pylist(out, schema=_PIECES)

    return arrow_map(lines, run, _PIECES_SQL)


def placed(found: DataFrame) -> DataFrame:
    """Pieces with their ``offset`` in the file: a split begins where the splits before it in its file end."""
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (found.groupBy("file", "split").agg(F.sum("size").alias("size"))  # one row a split
              .select("file", "split", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")))
    return found.join(splits, ["file", "split"]).withColumn("offset", F.col("base") + F.col("at")).drop("base", "at")


def reached(candidates: DataFrame) -> DataFrame:
    """``file``, ``offset`` of the candidates (``file``, ``offset``, ``successor``) that the chain from offset 0 of
    their file reaches, by pointer jumping: round k follows jumps of 2**k records."""
    jumps = stored(candidates.where("successor is not null").select("file", "offset", F.col("successor").alias("to")),
                   "warc-jumps")
    known = candidates.select("file", F.col("offset").alias("to"))
    jumps = stored(jumps.join(known.hint("merge"), ["file", "to"], "left_semi").select("file", "offset", "to"), "warc-jumps")
    found = candidates.where("offset = 0").select("file", "offset")
    for _ in range(MAX_ROUNDS):
        if jumps.isEmpty():
            return found
        # sort-merge: a stored table of offsets is small on disk and large in memory, no guess should broadcast it
        further = found.join(jumps.hint("merge"), ["file", "offset"]).select("file", F.col("to").alias("offset"))
        found = stored(found.union(further), "warc-reached")
        second = jumps.select("file", F.col("offset").alias("to"), F.col("to").alias("beyond"))
        jumps = stored(jumps.join(second.hint("merge"), ["file", "to"]).select("file", "offset", F.col("beyond").alias("to")),
                       "warc-jumps")
    raise RuntimeError(f"chains did not end in {MAX_ROUNDS} rounds")


def _assembled(parts: DataFrame) -> DataFrame:
    """Records put together from their pieces (``offset``, ``piece``), grouped by ``file`` and ``owner``."""
    grouped = parts.groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("offset", "piece")))["piece"].alias("pieces"))
    names = [f.name for f in _RECORDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file, owner, found in zip(*(batch.column(c).to_pylist() for c in range(3))):
                record = parse_piece(whole := b"".join(found))
                body = payload_of(whole[record["head"]:record["head"] + record["length"]])
                out.append({"file": file, "offset": owner, **{k: v for k, v in record.items() if k in names},
                            "payload": body})
            yield pa.RecordBatch.from_pylist(out, schema=_RECORDS)

    return arrow_map(grouped, run, _RECORDS_SQL)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of all files under ``path``: ``file``, ``offset``, ``record_type``, ``page_id``, ``url``,
    ``payload_bytes``, ``payload_digest`` (of the payload read; of the stated one for revisits), ``refers_to`` and, on
    request, ``payload``."""
    found = stored(pieces(spark, path, with_payload), "warc-pieces")
    # all but the bytes: what finds the chain
    narrow = placed(found.drop("piece"))
    end = F.when((F.col("head") >= 0) & (F.col("length") >= 0),
                 F.col("offset") + F.col("head") + F.col("length") + F.lit(4))
    narrow = stored(narrow.withColumn("successor", end), "warc-candidates")
    # a record ends where a candidate begins or where the file ends (its last piece has one "\n" too many here)
    ends = narrow.groupBy("file").agg((F.max(F.col("offset") + F.col("size")) - 1).alias("successor"))
    ends = ends.union(narrow.select("file", F.col("offset").alias("successor")))
    chain = reached(narrow.select("file", "offset", "successor").join(ends.hint("merge"), ["file", "successor"], "left_semi")
                    .select("file", "offset", "successor"))
    records = narrow.join(chain.hint("merge"), ["file", "offset"])
    keys = ["file", "split", "number"]

    cut = records.where(~F.col("whole") & (F.col("length") >= 0))
    marked = narrow.select(*keys, "offset").join(
        chain.withColumn("start", F.col("offset")).hint("merge"), ["file", "offset"], "left")
    in_split = Window.partitionBy("file", "split").orderBy("number")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = (marked.groupBy("file", "split").agg(F.max("start").alias("last"))  # one row a split
               .select("file", "split", F.max("last").over(earlier).alias("carried")))
    owned = (marked.withColumn("owner", F.max("start").over(in_split)).join(carried, ["file", "split"])
             .select(*keys, "offset", F.coalesce("owner", "carried").alias("owner")))
    owners = cut.select("file", F.col("offset").alias("owner"))
    parts = owned.join(owners, ["file", "owner"], "left_semi")
    # the bytes are needed only where payloads hold the magic: then the archives are read once more
    bytes_of = pieces(spark, path, True) if not with_payload and not cut.isEmpty() else found
    parts = parts.join(bytes_of.select(*keys, "piece"), keys).select("file", "owner", "offset", "piece")

    whole = records.where("whole")
    if with_payload:
        whole = whole.join(found.select(*keys, "piece"), keys)
        block = F.expr("substring(piece, cast(head + 1 as int), cast(length as int))")
        http = F.expr("substring(piece, cast(head + 1 as int), 5) = cast('HTTP/' as binary)")
        skip = F.instr(block.cast("string"), END) + F.lit(4)
        whole = whole.withColumn("payload", F.when(http, F.substring(block, skip, F.length(block))).otherwise(block))
    else:
        whole = whole.withColumn("payload", F.lit(None).cast("binary"))
    names = [f.name for f in _RECORDS]
    both = whole.select(*names).union(_assembled(parts).where("whole").select(*names))
    again = F.col("record_type") == "revisit"
    return both.select(
        "file", "offset", "record_type", "page_id", "url",
        F.when(again, F.col("stated_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.regexp_replace("stated_digest", "^sha256:", "")).otherwise(F.col("payload_digest"))
        .alias("payload_digest"),
        F.when(again, F.col("refers_to")).alias("refers_to"), *["payload"] * with_payload)
