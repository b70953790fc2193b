"""WARC archives: written monolithic, normalised to one member per record, read
back through a sidecar offset index.

Writing. Every row becomes a WARC 1.1 record, a ``response`` (HTTP block with the
payload) or, when a record of the same payload is kept elsewhere, a ``revisit``
of it (identical-payload-digest profile, no payload). Records are expressions;
Spark's text writer puts a blank line behind each and compresses a whole file as
one gzip stream: a monolithic archive, in which no record can be read without
inflating all before it. Tasks are committed by Spark, so a retried task leaves
no half file.

Normalising. A task takes one archive, inflates its stream once, piece by piece,
and deflates every record into its own gzip member, so each can be read alone. A
record is passed on in pieces too: memory does not depend on its length, nor on
the archive's. Beside ``name.warc.gz`` it writes ``name.index.jsonl``, a line per
record with offset, length, id, type and digest. Both are written under a name of
their own and then moved, the index last, so a lost task leaves nothing that is
read and a repeated one gives the same bytes. Archives of several members, or
uncompressed, are taken alike. A stream that is cut off, or is no WARC, raises a
ValueError that names the file: nothing is dropped silently.

Reading back. ``read_records`` reads the sidecar lines as a table and each record
by seeking to its offset.

Folders are any that ``pyarrow.fs`` opens and all machines share (file, hdfs, s3).

Duplicates. Payloads are equal if their SHA-1 and length are. Of equal ones of at
least ``min_revisit`` bytes, the one with the largest key is the response (null
keys are smallest; of rows with the same key one row is chosen by ``row_id``).
Copies are counted with partial aggregates, only keys of several copies are joined
back, and a payload that a third of the rows share is split by the skew handling
of the join.

Defined results: a null payload is empty; a null url becomes about:blank, line
breaks in urls are percent-encoded; a null key is left out of the record and read
back as null; repeated rows give a record each; an empty table gives no records;
other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.llm.common import fresh, written
from featuremart.session import scratch_dir

VERSION = "WARC/1.1"
BREAK = "\r\n"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PIECE = 1 << 18          # bytes inflated or passed on at a time
HEADER_LIMIT = 1 << 20   # a longer record header is no WARC
BATCH_BYTES = 4 << 20
INDEX_SCHEMA = "archive string, offset long, length long, id string, type string, digest string"
RECORD_SCHEMA = "id string, type string, target string, headers map<string,string>, payload binary"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1: five hexadecimal digits are four of base 32."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def _urn(row_id: Column) -> Column:
    h = F.md5(row_id.cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.when(row_id.isNotNull(), F.concat(
        F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">")))


def _field(name: str, value: Column) -> Column:
    """A header line; none for null (concat_ws skips nulls)."""
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def marked_copies(df: DataFrame, key: str, payload: str, row_id: Column | None = None, min_revisit: int = 0) -> DataFrame:
    """``df`` with w_row (an id for each row), w_bytes, w_digest and, where
    another record holds the same payload, w_refers_row and w_refers_key.

    ``row_id`` must give the same id for a row whenever ``df`` is computed;
    without it the rows are written once with a running number."""
    spark = df.sparkSession
    if row_id is None:
        df = written(spark, df.withColumn("w_row", F.monotonically_increasing_id().cast("string")), "warc-rows")
    else:
        df = df.withColumn("w_row", row_id.cast("string"))
    rows = df.withColumn("w_bytes", F.octet_length(payload).cast("long")).withColumn("w_digest", base32_sha1(F.col(payload)))
    top = F.max(F.struct(F.col(key).alias("k"), F.col("w_row").alias("r")))
    copies = rows.where(F.col("w_bytes") >= min_revisit).groupBy("w_digest", "w_bytes") \
        .agg(top.alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select("w_digest", "w_bytes", F.col("top.k").alias("w_refers_key"), F.col("top.r").alias("w_refers_row"))
    copies = written(spark, copies, "warc-copies")
    joined = rows.join(copies.hint("shuffle_hash"), ["w_digest", "w_bytes"], "left")
    again = F.col("w_refers_row") != F.col("w_row")
    return joined.withColumn("w_refers_key", F.when(again, F.col("w_refers_key"))) \
        .withColumn("w_refers_row", F.when(again, F.col("w_refers_row")))


def record_text(key: str, url: str, payload: str, date: str) -> Column:
    """The whole record of a row of ``marked_copies`` but for its closing blank lines."""
    revisit = F.col("w_refers_row").isNotNull()
    target = F.coalesce(F.replace(F.replace(F.col(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit("about:blank"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
                    F.col("w_bytes").cast("string"), F.lit(BREAK * 2))
    block = F.when(revisit, F.lit(f"HTTP/1.1 200 OK{BREAK * 2}")).otherwise(F.concat(http, F.col(payload)))
    return F.concat_ws(
        BREAK, F.lit(VERSION), _field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", _urn(F.col("w_row"))), _field("WARC-Date", F.lit(date)), _field("WARC-Target-URI", target),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("w_digest"))),
        _field("WARC-Profile", F.when(revisit, F.lit(IDENTICAL))), _field("WARC-Refers-To", _urn(F.col("w_refers_row"))),
        _field("Archive-Key", F.col(key)), _field("Archive-Refers-To-Key", F.col("w_refers_key")),
        _field("Archive-Payload-Length", F.col("w_bytes")), F.lit("Content-Type: application/http; msgtype=response"),
        _field("Content-Length", F.octet_length(block)), F.lit(""), block)


def write_monolithic(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
                     row_id: Column | None = None, min_revisit: int = 0, date: str = "1970-01-01T00:00:00Z",
                     records_per_archive: int = 100_000) -> None:
    """One gzip stream a file, at most ``records_per_archive`` records each."""
    body = fresh(df, "w_payload")
    rows = df.withColumn(body, F.coalesce(F.col(payload).cast("string"), F.lit("")))
    row_name = fresh(df, "w_id")
    rows = rows.select(F.col(key).alias("w_key"), F.col(url).alias("w_url"), F.col(body).alias("w_payload"),
                       *([row_id.alias(row_name)] if row_id is not None else []))
    marked = marked_copies(rows, "w_key", "w_payload", F.col(row_name) if row_id is not None else None, min_revisit)
    marked.select(record_text("w_key", "w_url", "w_payload", date).alias("value")).write \
        .option("compression", "gzip").option("lineSep", BREAK * 2).option("maxRecordsPerFile", records_per_archive).text(folder)


def _store(uri: str):
    """The file system that holds ``uri`` and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


class Inflated:
    """Bytes of a gzip stream (of one or several members) or of a plain file,
    held a piece at a time."""

    def __init__(self, source, name: str):
        self.source, self.name, self.held = source, name, bytearray()
        self.raw, self.ended, self.inflater = b"", False, None
        self.plain = None

    def _more(self) -> bool:
        if not self.raw and not self.ended:
            self.raw = self.source.read(PIECE)
            self.ended = not self.raw
        if self.plain is None:
            self.plain = bool(self.raw) and not self.raw.startswith(b"\x1f\x8b")
        if self.plain:
            self.held += self.raw
            got, self.raw = len(self.raw), b""
            return got > 0
        while True:
            if self.inflater is None:
                if not self.raw:
                    return False
                self.inflater = zlib.decompressobj(31)
            try:
                out = self.inflater.decompress(self.raw, PIECE)
            except zlib.error as e:
                raise ValueError(f"{self.name}: damaged gzip stream ({e})") from e
            self.raw = self.inflater.unconsumed_tail
            if self.inflater.eof:
                self.raw, self.inflater = self.inflater.unused_data, None
            elif not self.raw and not out:
                self.raw = self.source.read(PIECE)
                if not self.raw:
                    raise ValueError(f"{self.name}: the gzip stream is cut off")
            if out:
                self.held += out
                return True
            if not self.raw and not self.ended:
                self.raw = self.source.read(PIECE)
                self.ended = not self.raw

    def at_end(self) -> bool:
        """Pass over line breaks; whether nothing follows."""
        while not self.held or self.held[0] in b"\r\n":
            self.held = self.held.lstrip(b"\r\n")
            if not self.held and not self._more():
                return True
        return False

    def until(self, mark: bytes, limit: int) -> bytes:
        """What comes before ``mark``, which is passed over."""
        start = 0
        while (at := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if len(self.held) > limit or not self._more():
                raise ValueError(f"{self.name}: no WARC record header")
        out = bytes(self.held[:at])
        del self.held[:at + len(mark)]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces."""
        while n:
            if not self.held and not self._more():
                raise ValueError(f"{self.name}: the last record is cut off")
            out = bytes(self.held[:n])
            del self.held[:len(out)]
            n -= len(out)
            yield out


def header_fields(head: bytes) -> dict[str, str]:
    """Named fields of a record header (its version line first)."""
    lines = head.decode("utf-8", "replace").split(BREAK)
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in " \t" and last:            # a folded line goes on
            out[last] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        last = name.strip()
        out[last] = value.strip()
    return out


def _value(fields: dict[str, str], name: str) -> str | None:
    """A field by its name, in any case."""
    return fields.get(name) or next((v for k, v in fields.items() if k.lower() == name.lower()), None)


def normalise_file(source: str, folder: str) -> tuple[str, int, int]:
    """(archive, records, bytes) after rewriting one file, record by record."""
    fs_in, path_in = _store(source)
    fs_out, path_out = _store(folder)
    name = path_in.rsplit("/", 1)[-1].split(".")[0]
    archive, own = f"{name}.warc.gz", f"{path_out}/_{name}-{uuid.uuid4().hex}"
    offset, records, blank = 0, 0, (BREAK * 2).encode()
    with fs_in.open_input_stream(path_in, compression=None) as raw, \
            fs_out.open_output_stream(f"{own}.warc", compression=None) as out, \
            fs_out.open_output_stream(f"{own}.index", compression=None) as index:
        stream = Inflated(raw, source)
        while not stream.at_end():
            head = stream.until(blank, HEADER_LIMIT)
            try:
                fields = header_fields(head)
                size = int(_value(fields, "Content-Length") or "")
            except ValueError as e:
                raise ValueError(f"{source}: {e}") from e
            deflater, length = zlib.compressobj(6, zlib.DEFLATED, 31), 0
            for piece in itertools.chain([head, blank], stream.pieces(size), [blank]):
                done = deflater.compress(piece)
                length += len(done)
                out.write(done)
            done = deflater.flush()
            length += len(done)
            out.write(done)
            line = {"archive": archive, "offset": offset, "length": length, "id": _value(fields, "WARC-Record-ID"),
                    "type": _value(fields, "WARC-Type"), "digest": _value(fields, "WARC-Payload-Digest")}
            index.write((json.dumps(line) + "\n").encode())
            offset, records = offset + length, records + 1
    fs_out.move(f"{own}.warc", f"{path_out}/{archive}")
    fs_out.move(f"{own}.index", f"{path_out}/{name}.index.jsonl")
    return archive, records, offset


def normalise(spark: SparkSession, source: str, folder: str) -> DataFrame:
    """Rewrite every ``*.gz`` (or ``*.warc``) below ``source`` into ``folder``;
    (archive, records, bytes) per file. File names must differ."""
    fs_out, path = _store(folder)
    fs_out.create_dir(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*{.gz,.warc}").option("recursiveFileLookup", "true") \
        .load(source).select("path")  # names only: contents are streamed by the tasks

    def run(batches):
        for b in batches:
            rows = [normalise_file(p, folder) for p in b.column(0).to_pylist()]
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64()))],
                                             names=["archive", "records", "bytes"])

    return written(spark, files.mapInArrow(run, "archive string, records long, bytes long"), "warc-normalised")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).option("pathGlobFilter", "*.index.jsonl").json(folder)


def record_at(store, path: str, offset: int, length: int) -> bytes:
    store.seek(offset)
    raw = store.read(length)
    inflater = zlib.decompressobj(31)
    out = inflater.decompress(raw)
    if len(raw) != length or not inflater.eof or inflater.unused_data:
        raise ValueError(f"{path}: no single gzip member at {offset} of length {length}")
    return out


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(id, type, target, headers, payload) of the records an index names;
    payload is null for revisits."""
    kinds = [pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = ["id", "type", "target", "headers", "payload"]

    def run(batches):
        root, path = _store(folder)
        opened, held = None, None
        rows, weight = [], 0

        def flush():
            nonlocal rows, weight
            cols = list(zip(*rows)) or [()] * 5
            rows, weight = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for b in batches:
            for archive, offset, length, id_ in zip(*(c.to_pylist() for c in b.columns)):
                if archive != opened:
                    opened, held = archive, root.open_input_file(f"{path}/{archive}")
                record = record_at(held, archive, offset, length)
                head, _, block = record.partition((BREAK * 2).encode())
                fields = header_fields(head)
                if fields.get("WARC-Record-ID") != id_:
                    raise ValueError(f"{archive}: the index names {id_} at {offset}")
                block = block[:int(fields["Content-Length"])]
                revisit = fields["WARC-Type"] == "revisit"
                payload = None if revisit else block.partition((BREAK * 2).encode())[2]
                rows.append((id_, fields["WARC-Type"], fields.get("WARC-Target-URI"), list(fields.items()), payload))
                weight += len(record)
                if weight >= BATCH_BYTES:
                    yield flush()
        yield flush()

    return index.select("archive", "offset", "length", "id").mapInArrow(run, RECORD_SCHEMA)


def round_trip(df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
               row_id: Column | None = None, min_revisit: int = 0) -> DataFrame:
    """Write ``df`` as monolithic archives, normalise them and read them back:
    (key, target, type, bytes, digest, refers_to, payload), key and refers_to as text."""
    spark = df.sparkSession
    base = scratch_dir(spark, f"warc-{uuid.uuid4().hex}")
    write_monolithic(df, f"{base}/monolithic", key, url, payload, row_id, min_revisit)
    normalise(spark, f"{base}/monolithic", f"{base}/records")
    records = read_records(read_index(spark, f"{base}/records"), f"{base}/records")
    head = F.col("headers")
    return records.select(
        head["Archive-Key"].alias("key"), "target", "type",
        F.coalesce(F.octet_length("payload").cast("long"), head["Archive-Payload-Length"].cast("long")).alias("bytes"),
        F.coalesce(base32_sha1(F.col("payload")), F.substring(head["WARC-Payload-Digest"], 6, 32)).alias("digest"),
        head["Archive-Refers-To-Key"].alias("refers_to"), "payload")
