"""Write pages as WARC archives, shard by shard, and read archives back.

Records are sorted by range of their id and digest. A task writes one range into
files that are rolled by compressed size, under temporary names; only the files of
the attempts that succeeded get their final names. The manifest, a table beside the
files, is written last: files it does not list are left over.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.llm.tables import keep, pieces

LEAST_REVISIT = 100
SHARD_BYTES = 64 << 20
FILE_BYTES = 16 << 20
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page:"
READ_BYTES = 1 << 16

MANIFEST_FOLDER = "manifest.parquet"
MANIFEST = "name string, temporary string, records long, bytes long, sha256 string"
RECORD = (
    "page_id string, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to string"
)


def record(headers: list[tuple[str, str]], block: bytes, level: int = LEVEL) -> bytes:
    """One record as a gzip member of its own."""
    lines = [*headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(head.encode()) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def record_id(page_id: str | None, digest: str, place: int) -> str:
    """Id of the record that is number ``place`` of those with this page and payload."""
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{PAGE_URN}{page_id}/{digest}/{place}').urn}>"


def page_record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, place: int) -> bytes:
    """Response, or revisit of the first record of page ``refers_to`` with this payload.

    All headers and digests are made from the payload.
    """
    digest, revisit = hashlib.sha256(payload).hexdigest(), refers_to is not None
    target = "".join((url or "").split()) or f"{PAGE_URN}{page_id}"
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, place)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Page-ID", page_id or ""),
        ("Page-Has-URL", str(int(url is not None))),
        ("Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode()
    if revisit:
        headers += [
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, 0)),
            ("Refers-To-Page", refers_to),
        ]
    else:
        block += payload
    headers.append(("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"))
    return record(headers, block)


class Roll:
    """Files of one shard; a new one is begun when the size is reached."""

    def __init__(self, folder: str, shard: int, most: int) -> None:
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.store.create_dir(self.root)
        self.shard, self.most, self.count = shard, most, 0
        self.attempt = uuid.uuid4().hex
        self.out = None
        self.done: list[tuple] = []

    def write(self, member: bytes) -> None:
        if self.out is not None and self.size + len(member) > self.most:
            self.close()
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.count:06d}.warc.gz"
            self.temporary = f"{self.name}.{self.attempt}.tmp"
            self.out = self.store.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
            self.count, self.size, self.records = self.count + 1, 0, 0
            self.hash = hashlib.sha256()
            info = f"software: rateweave\r\nfile: {self.name}\r\n".encode()
            name = uuid.uuid5(uuid.NAMESPACE_URL, self.name)
            headers = [
                ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", DATE),
                ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields"),
            ]
            self._put(record(headers, info))
        self._put(member)
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.hash.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.temporary, self.records, self.size, self.hash.hexdigest()))
            self.out = None


def _write_shard(batches: Iterator[pd.DataFrame], folder: str, most: int) -> Iterator[pd.DataFrame]:
    roll = Roll(folder, TaskContext.get().partitionId(), most)
    page, place, first = object(), 0, None
    for batch in batches:
        for row in batch.itertuples(index=False):
            if (row.page_id, row.digest) != page:
                page, place, first = (row.page_id, row.digest), 0, None
            if row.note:
                first = row.first
                continue
            revisit = first is not None and (first != row.page_id or place > 0)
            payload = (row.html or "").encode()
            roll.write(page_record(row.page_id, row.url, payload, first if revisit else None, place))
            place += 1
    roll.close()
    yield pd.DataFrame(roll.done, columns=[f.split()[0] for f in MANIFEST.split(", ")])


def _commit(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    store, root = fs.FileSystem.from_uri(folder)
    for batch in batches:
        for row in batch.itertuples(index=False):
            source, target = f"{root}/{row.temporary}", f"{root}/{row.name}"
            # A repeated task finds the file moved already.
            if store.get_file_info(source).type == fs.FileType.File:
                store.move(source, target)
            if store.get_file_info(target).size != row.bytes:
                raise OSError(f"{target} is not as the manifest has it")
        yield batch


def write_archives(
    pages: DataFrame,
    folder: str,
    least_revisit: int = LEAST_REVISIT,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write each row of ``pages`` as a record below ``folder``; gives the manifest.

    Takes ``page_id``, ``url``, ``html``; other columns are ignored. Of records with
    equal payloads of at least ``least_revisit`` bytes the one with the smallest id
    is a response, others revisit it, also those of null id; of repeated rows with
    that id the first is the response. A null html is an empty payload; a null url
    becomes a URN of the id; a payload that only null ids hold is a response each
    time. An empty table gives an empty manifest. The same rows in the same files
    give the same archives. Each file is listed in the manifest with its size and
    SHA-256; a folder takes one set of archives, and a second is refused.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    payload = F.coalesce("html", F.lit(""))
    digest = F.sha2(payload, 256).alias("digest")
    known = keep(pages.select("page_id", digest, F.octet_length(payload).alias("bytes")), "warc-digests")
    total = known.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    large = known.where(F.col("bytes") >= least_revisit)
    shared = (
        large.groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
    )
    notes = large.join(shared, "digest").select("page_id", "digest", "first").distinct()
    rows = pages.select(
        "page_id", digest, F.lit(False).alias("note"), F.lit(None).cast("long").alias("first"), "url", "html"
    ).unionByName(
        notes.select(
            "page_id", "digest", F.lit(True).alias("note"), "first",
            F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"),
        )
    )
    # By digest too, so that an id with a third of the rows is more than one shard.
    shards = pieces(total, shard_bytes)
    dealt = rows.repartitionByRange(shards, "page_id", "digest").sortWithinPartitions(
        "page_id", "digest", F.desc("note"), "url"
    )
    dealt = dealt.withColumns({c: F.col(c).cast("string") for c in ("page_id", "first")})
    written = keep(dealt.mapInPandas(lambda it: _write_shard(it, folder, file_bytes), MANIFEST), "warc-written")
    final = dealt_by_size(written).mapInPandas(lambda it: _commit(it, folder), MANIFEST)
    final.write.parquet(f"{folder}/{MANIFEST_FOLDER}")
    return committed(pages.sparkSession, folder)


def committed(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest in ``folder``; there is none before all files have their names."""
    return spark.read.schema(MANIFEST).parquet(f"{folder}/{MANIFEST_FOLDER}")


def left_over(spark: SparkSession, folder: str) -> DataFrame:
    """``name`` of files in ``folder`` that the manifest does not list; none is removed."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz*").load(folder)
    names = files.select(F.element_at(F.split("path", "/"), -1).alias("name"))
    return names.join(committed(spark, folder).select("name"), "name", "left_anti")


def dealt_by_size(manifest: DataFrame, task_bytes: int = SHARD_BYTES) -> DataFrame:
    """The manifest's rows in a partition per ``task_bytes`` of files, or one per core if that is more."""
    size = manifest.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.repartition(max(pieces(size.bytes, task_bytes), min(size.files, cores), 1))


def members(store: fs.FileSystem, path: str) -> Iterator[bytes]:
    """The gzip members of a file, one after the other."""
    with store.open_input_stream(path, compression=None) as source:
        unpack, parts, rest = zlib.decompressobj(31), [], b""
        while data := rest or source.read(READ_BYTES):
            parts.append(unpack.decompress(data))
            rest = b""
            if unpack.eof:
                yield b"".join(parts)
                rest, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []
        if parts:
            raise ValueError(f"{path} ends within a record")


def parse(member: bytes) -> tuple | None:
    """Columns of :data:`RECORD` of a page's record; checks length and digests."""
    head, _, rest = member.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    if headers["WARC-Type"] == "warcinfo":
        return None
    if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    digest, revisit = headers["WARC-Payload-Digest"].removeprefix("sha256:"), headers["WARC-Type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"damaged payload {headers['WARC-Record-ID']}")
    return (
        headers["Page-ID"] or None,
        headers["WARC-Target-URI"] if headers["Page-Has-URL"] == "1" else None,
        payload, int(headers["Payload-Length"]), digest, headers["WARC-Type"], headers.get("Refers-To-Page"),
    )


def _read(batches: Iterator[pd.DataFrame], folder: str, payloads: bool) -> Iterator[pd.DataFrame]:
    store, root = fs.FileSystem.from_uri(folder)
    columns = [f.split()[0] for f in RECORD.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=columns)

    for batch in batches:
        for name in batch["name"]:
            out, size = [], 0
            for member in members(store, f"{root}/{name}"):
                row = parse(member)
                if row is None:
                    continue
                out.append(row if payloads else (*row[:2], None, *row[3:]))
                size += len(member) if payloads else 1
                if size >= FILE_BYTES or len(out) >= 10_000:
                    yield frame(out)
                    out, size = [], 0
            if out:
                yield frame(out)


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the files in a manifest, checked against their digests.

    A revisit has no payload of its own; its size and digest are of the full one.
    """
    files = dealt_by_size(manifest).select("name")
    records = files.mapInPandas(lambda it: _read(it, folder, payloads), RECORD)
    return records.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})
