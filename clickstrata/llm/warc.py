"""WARC files of pages and a Merkle audit of their replicas.

Pages are range-partitioned by id and written as WARC response records, each a
gzip member of its own, in files of at most ``FILE_RECORDS`` records or
``FILE_BYTES`` bytes.  A sidecar per file lists the ordered offset ranges.

An audit hashes the bytes of each range, then ``FANOUT`` ranges at a time up to
the root of the file, then files up to the root of the replica.  Only the nodes
are stored.  The comparison starts at the two roots and joins one level at a
time, and only below nodes that differ, so that equal branches are never read;
it ends at the records whose bytes differ or that one replica lacks.

Defined results: a null url or html is written as empty; null ids come first and
rows with equal ids are told apart by their place; an empty table gives no files
and no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.llm.common import Scratch, file_uri, read_bytes, text_id, write_bytes

FILE_RECORDS = 4096
FILE_BYTES = 16 << 20
FANOUT = 16
FILE_LEVELS = 3  # FANOUT ** FILE_LEVELS == FILE_RECORDS
FILES_PER_TASK = 1 << 20  # numbers that a task has for its files

RANGE = "<QQ"  # offset, length

INDEX = (
    "page_id long, file_no long, file string, record int, offset long, length long, "
    "payload_sha256 string, payload_bytes long"
)
NODE = "file_no long, level int, node long, hash binary"


# --- writing ---------------------------------------------------------------------


def record(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """One compressed WARC record; the same page gives the same bytes."""
    body = (html or "").encode()
    digest = hashlib.sha256(body).hexdigest()
    head = (
        "WARC/1.1\r\nWARC-Type: resource\r\n"
        f"WARC-Record-ID: <urn:page:{page_id}>\r\n"
        f"WARC-Target-URI: {' '.join((url or '').split())}\r\n"
        "WARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: text/html\r\n"
        f"WARC-Payload-Digest: sha256:{digest}\r\n"
        f"Content-Length: {len(body)}\r\n\r\n"
    )
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + body + b"\r\n\r\n") + packer.flush()


def _writer(root: str):
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        seq = size = 0
        held: list[bytes] = []
        rows: list[tuple] = []

        def file() -> pd.DataFrame:
            number = part * FILES_PER_TASK + seq
            name = f"{number:015d}-{uuid.uuid4().hex}.warc.gz"
            write_bytes(f"{root}/{name}", held)
            ranges = b"".join(struct.pack(RANGE, row[2], row[3]) for row in rows)
            write_bytes(f"{root}/{name}.ranges", [ranges])
            frame = pd.DataFrame(
                rows,
                columns=["page_id", "record", "offset", "length", *INDEX_PAYLOAD],
            )
            # Read again from the rows: beside a null the frame holds ids as doubles.
            frame["page_id"] = pd.array([row[0] for row in rows], dtype="Int64")
            frame["file_no"], frame["file"] = number, name
            return frame[[part.split()[0] for part in INDEX.split(", ")]]

        for frame in frames:
            known = frame["id"].astype(object).where(frame["id"].notna(), None)
            for id_, url, html in zip(known, frame["url"], frame["html"], strict=True):
                id_ = None if id_ is None else int(id_)
                raw = record(id_, url, html)
                full = len(held) == FILE_RECORDS or size + len(raw) > FILE_BYTES
                if held and full:
                    yield file()
                    held.clear()
                    rows.clear()
                    seq, size = seq + 1, 0
                body = (html or "").encode()
                digest = hashlib.sha256(body).hexdigest()
                rows.append((id_, len(held), size, len(raw), digest, len(body)))
                held.append(raw)
                size += len(raw)
        if held:
            yield file()

    return write


INDEX_PAYLOAD = ["payload_sha256", "payload_bytes"]


def write_warc(pages: DataFrame, root: str) -> DataFrame:
    """Writes the pages under ``root``; lazily, the index of all records."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    order = [F.col("id").asc_nulls_first()]
    return (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order, "url", "html")
        .select(text_id("id"), "url", "html")
        .mapInPandas(_writer(root), INDEX)
    )


def _ranges(root: str, name: str) -> list[tuple[int, int]]:
    return list(struct.iter_unpack(RANGE, read_bytes(f"{root}/{name}.ranges")))


def _files(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz")
    return files.load(root).select("path", "content")


def copy_warc(
    spark: SparkSession, root: str, target: str, damaged: Callable[[int, bytes], bool]
) -> DataFrame:
    """Copies a replica; lazily, its files.

    One byte is flipped in records for which ``damaged`` holds, given their place
    and their bytes, to try out an audit.
    """

    def copy(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                name, data = path.rpartition("/")[2], bytearray(content)
                ranges = _ranges(root, name)
                for place, (offset, length) in enumerate(ranges):
                    if damaged(place, content[offset : offset + length]):
                        data[offset + length // 2] ^= 1
                write_bytes(f"{target}/{name}", [bytes(data)])
                packed = b"".join(struct.pack(RANGE, *at) for at in ranges)
                write_bytes(f"{target}/{name}.ranges", [packed])
                yield pd.DataFrame({"file": [name]})

    return _files(spark, root).mapInPandas(copy, "file string")


# --- hashing ---------------------------------------------------------------------


def parent(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"\x01" + b"".join(children)).digest()


def file_tree(content: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int, bytes]]:
    """(level, node, hash) of all nodes of a file, records at level 0."""
    view = memoryview(content)
    level = [
        hashlib.sha256(b"\x00" + struct.pack(RANGE, *at) + view[at[0] : at[0] + at[1]]).digest()
        for at in ranges
    ]
    nodes = [(0, i, h) for i, h in enumerate(level)]
    for height in range(1, FILE_LEVELS + 1):
        level = [parent(level[i : i + FANOUT]) for i in range(0, len(level), FANOUT)]
        nodes += [(height, i, h) for i, h in enumerate(level)]
    return nodes


def _hash_files(root: str):
    def hash_files(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                name = path.rpartition("/")[2]
                ranges = _ranges(root, name)
                rows = file_tree(content, ranges)
                nodes = pd.DataFrame(rows, columns=["level", "node", "hash"])
                nodes.insert(0, "file", name)
                yield nodes

    return hash_files


def hash_replica(
    spark: SparkSession, root: str, index: DataFrame, scratch: Scratch, name: str
) -> list[DataFrame]:
    """The stored nodes (file_no, node, hash) of each level, records first."""
    nodes = _files(spark, root).mapInPandas(
        _hash_files(root), "file string, level int, node long, hash binary"
    )
    known = index.select("file", "file_no").distinct()
    nodes = scratch.store(
        nodes.join(known, "file").select("file_no", "level", "node", "hash"),
        f"{name}-nodes",
    )
    levels = [
        nodes.filter(F.col("level") == i).drop("level") for i in range(FILE_LEVELS + 1)
    ]
    # Files of one task follow each other; tasks do so in the order of the ids.
    while levels[-1].limit(2).count() > 1:
        lower = levels[-1].select(
            F.floor(F.col("file_no") / FANOUT).alias("above"), "file_no", "hash"
        )
        ordered = F.array_sort(F.collect_list(F.struct("file_no", "hash")))
        joined = F.concat_ws("", F.transform(ordered, lambda x: F.hex(x["hash"])))
        above = lower.groupBy("above").agg(F.unhex(F.sha2(joined, 256)).alias("hash"))
        above = above.select(
            F.col("above").alias("file_no"), F.lit(0).cast("long").alias("node"), "hash"
        )
        levels.append(scratch.store(above, f"{name}-{len(levels)}"))
    return levels


# --- comparing -------------------------------------------------------------------


def differing_records(
    ours: list[DataFrame], theirs: list[DataFrame], scratch: Scratch
) -> DataFrame:
    """(file_no, node) of the records that differ, from the roots down."""
    height = max(len(ours), len(theirs))
    suspects = None
    for level in range(height - 1, -1, -1):
        if level >= min(len(ours), len(theirs)):
            continue  # one tree is taller: its lower roots are compared instead
        a, b = (
            side[level].select("file_no", "node", F.col("hash").alias(name))
            for side, name in ((ours, "a"), (theirs, "b"))
        )
        if suspects is not None:
            if level >= FILE_LEVELS:
                above = [F.floor(F.col("file_no") / FANOUT), F.lit(0).cast("long")]
            else:
                above = [F.col("file_no"), F.floor(F.col("node") / FANOUT)]
            names = [F.col("file_no").alias("up_file"), F.col("node").alias("up_node")]
            up = suspects.select(*names)
            a, b = (
                side.join(
                    up,
                    (above[0] == F.col("up_file")) & (above[1] == F.col("up_node")),
                    "left_semi",
                )
                for side in (a, b)
            )
        both = a.join(b, ["file_no", "node"], "full")
        unequal = both.filter(~F.col("a").eqNullSafe(F.col("b")))
        suspects = scratch.store(unequal.select("file_no", "node"), f"suspects-{level}")
        if suspects.isEmpty():
            break
    return suspects


def audit(spark: SparkSession, ours: str, theirs: str, index: DataFrame) -> DataFrame:
    """The index of the first replica with ``intact``: the second agrees."""
    scratch = Scratch(spark, "fixity")
    trees = [
        hash_replica(spark, root, index, scratch, name)
        for root, name in ((ours, "ours"), (theirs, "theirs"))
    ]
    found = differing_records(*trees, scratch)
    found = found.select("file_no", F.col("node").alias("record"), F.lit(True).alias("bad"))
    joined = index.join(found, ["file_no", "record"], "left")
    return joined.withColumn("intact", F.col("bad").isNull()).drop("bad")


def _every_fiftieth(place: int, raw: bytes) -> bool:
    """Pages whose id is 7 more than a multiple of 50."""
    head = zlib.decompressobj(31).decompress(raw, 256)
    page = head.partition(b"<urn:page:")[2].partition(b">")[0]
    return page != b"None" and int(page) % 50 == 7


def write_and_audit(pages: DataFrame) -> DataFrame:
    """Writes a replica and a copy with damaged records, and audits the copy."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    roots = [file_uri(spark, scratch.path(name)) for name in ("primary", "replica")]
    index = scratch.store(write_warc(pages, roots[0]), "index")
    if index.isEmpty():
        return index.withColumn("intact", F.lit(True))
    scratch.store(copy_warc(spark, *roots, _every_fiftieth), "copied")
    return audit(spark, *roots, index)
