"""Deterministic sharded WARC writer and reader.

Pages are dealt to shards by ranges of their id and sorted in each; an id that very many pages share, null among
them, is dealt further by ranges of the payload's digest. The ranges come from exact sums of bytes
over cells of the id, so the same table always gives the same shards. A task writes its shard's
records, each its own gzip member, and begins a new file when the compressed size passes the limit: a shard
holds several files' worth. Files are
written under temporary names; what a task reports of them becomes a manifest; commit renames the files
that the manifest names. A task that is run again writes files of its own, and what the lost
attempt left is never named, and removed after the commit.

Of records with equal payloads the one with the largest page id holds the payload; others are
revisits of it. Which page is which is known before the shuffle of the pages: decisions travel as rows of
their own and meet their pages by the sort, so whole pages are shuffled once.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import NO_ID, id_key, remove_path, scratch_path, small_batches, staged, table, utf8

CELLS = 4096
#: Cells that a heavy cell is cut into, at least.
FINER = 16
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Layout:
    """``shard_bytes``: payload of a shard, about; ``file_bytes``: compressed size that ends a file; ``least``: smallest payload that is revisited.

    A shard is a task's work. There are ``most_shards`` or a few more: beyond ``most_shards * shard_bytes`` of payload shards grow, to some
    5 GB at 100 TB. ``file_bytes`` suits tables of some GB; larger ones take it larger, 256 MiB say.
    """

    shard_bytes: int = 16 << 20
    most_shards: int = 20_000
    file_bytes: int = 1 << 20
    least: int = 1000
    date: str = "1970-01-01T00:00:00Z"
    level: int = 6


def shard_size(total: int, layout: Layout) -> int:
    """Payload of a shard: the layout's, or what keeps the shards at ``most_shards``."""
    return max(1, layout.shard_bytes, -(-total // layout.most_shards))


def cell_sizes(sizes: DataFrame, shard: int) -> list[tuple[int, int, int]]:
    """``first id, past the last, bytes`` of ranges of the ids that cover all rows, in order; none of more than one id holds over two shards.

    A first pass sums bytes over ``CELLS`` equal cells. Each heavy cell is cut by its weight, ``FINER`` cells at least and two a
    shard, and so on until none is heavy. Heavy cells are at most half as many as there are shards, so a pass brings the
    driver ``FINER / 2 + 2`` rows a shard at most, and a row finds its cell by joining the heavy ones, a table of that size, on the cell before.
    """
    spark = sizes.sparkSession
    ends = sizes.filter(F.col("_id") != F.lit(NO_ID)).agg(F.min("_id").alias("a"), F.max("_id").alias("b")).first()
    if ends["a"] is None:
        return []
    width = max(1, -(-(ends["b"] + 1 - ends["a"]) // CELLS))
    place = "cast((cast(_id as decimal(20,0)) - {a}) div {w} as bigint)"
    rows = sizes.filter(F.col("_id") != F.lit(NO_ID)).select("_id", "_bytes", F.lit(0).alias("_range"), F.expr(place.format(a=f"cast({ends['a']} as decimal(20,0))", w=f"cast({width} as decimal(20,0))")).alias("_cell"))
    ranges, spans = [], {0: (ends["a"], ends["b"] + 1, width)}
    while True:
        heavy = []
        for r in rows.groupBy("_range", "_cell").agg(F.sum("_bytes").alias("n")).collect():
            a, past, width = spans[r["_range"]]
            first = a + r["_cell"] * width
            found = (first, min(past, first + width), int(r["n"]))
            if found[2] > 2 * shard and found[1] - first > 1:
                heavy.append((r["_range"], r["_cell"], *found))
            else:
                ranges.append(found)
        if not heavy:
            return sorted(ranges)
        spans = {k: (a, past, max(1, -(-(past - a) // max(FINER, 2 * -(-n // shard))))) for k, (_, _, a, past, n) in enumerate(sorted(heavy))}
        cut = [(r, c, k, Decimal(spans[k][0]), Decimal(spans[k][2])) for k, (r, c, *_) in enumerate(sorted(heavy))]
        finer = spark.createDataFrame(cut, "_range int, _cell long, _next int, _first decimal(20,0), _width decimal(20,0)")
        rows = rows.join(F.broadcast(finer), ["_range", "_cell"]).select("_id", "_bytes", F.col("_next").alias("_range"), F.expr(place.format(a="_first", w="_width")).alias("_cell"))


def shard_bounds(sizes: DataFrame, layout: Layout) -> list[tuple[int, float]]:
    """First places of all shards but the first: neighbouring cells of the ids share a shard up to its size.

    A cell of more than two shards is a single id, cut by equal parts of its digests' range. There are at most ``most_shards``
    shards and as many cuts again, whatever the table holds.
    """
    total = sizes.agg(F.sum("_bytes").alias("n"), F.sum(F.when(F.col("_id") == F.lit(NO_ID), F.col("_bytes"))).alias("none")).first()
    shard, null_bytes = shard_size(total["n"] or 0, layout), total["none"] or 0
    bounds, held = [], 0
    for a, b, n in [*([(NO_ID, NO_ID + 1, null_bytes)] if null_bytes else []), *cell_sizes(sizes, shard)]:
        if held and held + n > shard:
            bounds.append((a, 0.0))
            held = 0
        parts = max(1, -(-n // shard)) if b - a == 1 else 1
        if parts > 1:
            bounds += [(a, k / parts) for k in range(1, parts)]
        held += n // parts
    return bounds


def shard_column(bounds: list[tuple[int, float]], key: Column, digest: Column) -> Column:
    """Number of bounds at or below a page's place, found by halving: as many comparisons as the logarithm of their number."""
    if not bounds:
        return F.lit(0)
    part = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    # one literal each, which the optimizer turns into an array once
    ids = F.split(F.lit(" ".join(str(a) for a, _ in bounds)), " ").cast("array<bigint>")
    parts = F.split(F.lit(" ".join(repr(p) for _, p in bounds)), " ").cast("array<double>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])

    def advance(at: Column, step: Column) -> Column:
        a, p = F.get(ids, at + step - 1), F.get(parts, at + step - 1)
        return F.when((a < key) | ((a == key) & (p <= part)), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), advance)


def decisions(pages: DataFrame, least: int) -> DataFrame:
    """Pages whose payload stands in another record: ``_id, _digest, _refers``. Thin rows only; a common payload is aggregated before it is joined."""
    thin = pages.filter(F.col("_bytes") >= least).select("_id", "_digest", "_bytes")
    last = thin.groupBy("_digest", "_bytes").agg(F.max("_id").alias("_refers"), F.count(F.lit(1)).alias("_c")).filter("_c > 1").drop("_c")
    return thin.join(last, ["_digest", "_bytes"]).filter("_id <> _refers").select("_id", "_digest", "_refers").dropDuplicates()


def prepared(pages: DataFrame) -> DataFrame:
    payload = utf8("html")
    return pages.select(id_key("page_id").alias("_id"), F.col("url").cast("string").alias("_url"), payload.alias("_payload")).select("_id", "_url", "_payload", F.octet_length("_payload").cast("long").alias("_bytes"), F.sha1("_payload").alias("_digest"))


def _header_value(text: str) -> str:
    """One line of ASCII: anything else is percent-encoded."""
    return re.sub(rb"[^\x21-\x7e]", lambda m: b"%%%02X" % m[0][0], text.encode()).decode()


def _b32(hex_digest: str) -> str:
    return base64.b32encode(binascii.unhexlify(hex_digest)).decode()


def record(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, layout: Layout) -> bytes:
    """One record. A revisit holds the HTTP header alone, which keeps the payload's length."""
    name = lambda i, d: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{i}:{d}')}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    target = _header_value(url) if url else f"urn:page:{page_id}"
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", name(page_id, digest)), ("WARC-Date", layout.date), ("WARC-Target-URI", target), ("WARC-Page-ID", str(page_id)), ("WARC-Payload-Digest", f"sha1:{_b32(digest)}"), ("WARC-Block-Digest", f"sha1:{_b32(hashlib.sha1(block).hexdigest())}")]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", name(refers_to, digest)), ("WARC-Refers-To-Page-ID", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"".join([b"WARC/1.1\r\n", *(f"{k}: {v}\r\n".encode() for k, v in fields), b"\r\n", block, b"\r\n\r\n"])


class _Files:
    """The files of one shard: rolls them by compressed size and remembers what to report."""

    def __init__(self, folder: str, shard: int, layout: Layout):
        self.fs, self.at = pafs.FileSystem.from_uri(folder)
        self.shard, self.layout, self.attempt = shard, layout, uuid.uuid4().hex
        self.out, self.rows, self.number = None, [], 0

    def add(self, data: bytes) -> None:
        member = zlib.compressobj(self.layout.level, zlib.DEFLATED, 31)
        packed = member.compress(data) + member.flush()
        if self.out is not None and self.size and self.size + len(packed) > self.layout.file_bytes:
            self.end()
        if self.out is None:
            self.temporary = f"_temporary/{self.attempt}-{self.number:05d}"
            self.fs.create_dir(f"{self.at}/_temporary", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.at}/{self.temporary}", compression=None)
            self.size, self.records, self.digest = 0, 0, hashlib.sha1()
        self.out.write(packed)
        self.size += len(packed)
        self.records += 1
        self.digest.update(packed)

    def end(self) -> None:
        if self.out is not None:
            self.out.close()
            self.rows.append((f"part-{self.shard:06d}-{self.number:05d}.warc.gz", self.temporary, self.records, self.size, self.digest.hexdigest()))
            self.number += 1
            self.out = None


MANIFEST = "name string, temporary string, records long, bytes long, sha1 string"


def write_archives(pages: DataFrame, folder: str, layout: Layout = Layout()) -> DataFrame:
    """Writes ``pages`` as WARC files into ``folder`` and returns the committed manifest.

    A null html is an empty payload, a null url is named by the page's id, and null ids stand as one
    smallest id (-2 ** 63, which no page may have). Repeated rows are records each; those of one id and one payload share a
    task. An empty table writes no file. Columns besides
    ``page_id, url, html`` are not used. The manifest lies in ``folder/_manifest``.
    """
    spark = pages.sparkSession
    small_batches(spark, 128)
    rows = prepared(pages)
    thin = staged(rows.select("_id", "_bytes", "_digest"), "warc-thin")
    bounds = shard_bounds(thin.select("_id", "_bytes"), layout)
    chosen = staged(decisions(thin, layout.least), "warc-revisits")
    told = chosen.select("_id", F.lit(None).cast("string").alias("_url"), F.lit(None).cast("binary").alias("_payload"), "_digest", "_refers", F.lit(0).alias("_kind"))
    whole = rows.select("_id", "_url", "_payload", "_digest", F.lit(None).cast("long").alias("_refers"), F.lit(1).alias("_kind"))
    both = told.unionByName(whole).withColumn("_shard", shard_column(bounds, F.col("_id"), F.col("_digest")))
    dealt = both.repartitionById(len(bounds) + 1, F.col("_shard")).sortWithinPartitions("_shard", "_id", "_digest", "_kind", "_url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, known = None, None
        for batch in batches:
            for page, url, payload, digest, refers, kind, shard in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if files is None or files.shard != shard:
                    if files is not None:
                        files.end()
                        yield _rows(files.rows)
                    files = _Files(folder, shard, layout)
                if kind == 0:
                    known = (page, digest, refers)
                    continue
                to = known[2] if known is not None and known[:2] == (page, digest) else None
                files.add(record(page, url, payload, digest, to, layout))
        if files is not None:
            files.end()
            yield _rows(files.rows)

    written = staged(dealt.select("_id", "_url", "_payload", "_digest", "_refers", "_kind", "_shard").mapInArrow(run, MANIFEST), "warc-written")
    return commit(written, folder)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["name", "temporary", "records", "bytes", "sha1"])


def commit(written: DataFrame, folder: str) -> DataFrame:
    """Renames the files of accepted task attempts, then writes the manifest; doing it twice changes nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source, target = f"{at}/{temporary}", f"{at}/{name}"
                if fs.get_file_info(source).type == pafs.FileType.NotFound and fs.get_file_info(target).type == pafs.FileType.File:
                    continue
                fs.move(source, target)
            yield batch

    spark = written.sparkSession
    written.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    remove_path(spark, f"{folder}/_temporary")
    return spark.read.parquet(f"{folder}/_manifest")


def parse_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a stream of gzip members; a record is in memory at a time."""
    data = io.BufferedReader(_Members(stream), 1 << 16)
    while line := data.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record begins with {line[:40]!r}")
        fields = {}
        while (line := data.readline().rstrip(b"\r\n")):
            key, _, value = line.decode().partition(": ")
            fields[key] = value
        yield fields, data.read(int(fields["Content-Length"]))


class _Members(io.RawIOBase):
    def __init__(self, stream):
        self.stream, self.inflate, self.rest = stream, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            if self.inflate.eof:
                self.rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            packed = self.rest or self.inflate.unconsumed_tail or self.stream.read(1 << 16)
            self.rest = b""
            if not packed:
                return 0
            out = self.inflate.decompress(packed, len(buffer))
            self.rest = self.inflate.unconsumed_tail
            if out:
                buffer[: len(out)] = out
                return len(out)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """A row per record of the archives: ``page_id, payload_bytes, payload_digest, record_type, refers_to, verified``.

    ``payload_digest`` is bare lower-case hex; of a revisit it and ``payload_bytes`` are those of the
    payload that it stands for. ``verified``: block digest, payload digest and lengths agree with what was read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out = []
                with fs.open_input_stream(f"{at}/{name}", compression=None) as stream:
                    for fields, block in parse_archive(stream):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"(?i)content-length: (\d+)", head)[1])
                        digest = binascii.hexlify(base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))).decode()
                        fine = fields["WARC-Block-Digest"] == f"sha1:{_b32(hashlib.sha1(block).hexdigest())}"
                        if fields["WARC-Type"] == "response":
                            fine = fine and size == len(payload) and hashlib.sha1(payload).hexdigest() == digest
                        refers = fields.get("WARC-Refers-To-Page-ID")
                        out.append((int(fields["WARC-Page-ID"]), size, digest, fields["WARC-Type"], None if refers is None else int(refers), fine))
                        if len(out) == 4096:
                            yield _read(out)
                            out = []
                yield _read(out)

    files = manifest.select("name")
    return files.repartition(max(1, min(10_000, files.count())), "name").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, verified boolean")


def _read(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"])


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    out = read_archives(write_archives(table(spark, sf_dir, "pages"), folder), folder)
    missing = F.lit(-(2**63))
    return out.withColumns({"page_id": F.when(F.col("page_id") != missing, F.col("page_id")), "refers_to": F.when(F.col("refers_to") != missing, F.col("refers_to"))})


ORACLE = """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
d as (select page_id, octet_length(payload) as payload_bytes, sha1(payload) as payload_digest from p),
m as (select payload_digest, payload_bytes, max(page_id) as last from d where payload_bytes >= 1000 group by 1, 2)
select d.page_id, d.payload_bytes::bigint as payload_bytes, d.payload_digest,
  case when m.last is null or m.last = d.page_id then 'response' else 'revisit' end as record_type,
  case when m.last <> d.page_id then m.last end as refers_to, true as verified
from d left join m using (payload_digest, payload_bytes)
"""
