"""Token ids in succinct files: one wavelet matrix per shard.

Documents are range-partitioned by id, tokenized in order and written in shards
of about ``SHARD_TOKENS`` ids; a document is never cut.  A shard is one file:

    "WVM1", header length (uint32), header (JSON), compressed sections

with sections for the documents' ids and ends, and for each bit of the token ids,
from the highest, a bit plane and the number of ones before every 512th bit.
Each section can be decompressed on its own.  ``WaveletFile`` answers from the
bytes of a file: the token at a position, how often a token occurs in a range,
where it occurs, and all tokens.

Tasks name files by a random suffix, and the table of files that they return
decides which count: what a lost or repeated attempt leaves behind is ignored.

Defined results: a null text is empty and consists of the end id; null ids come
first; equal ids are ordered by text; an empty table gives no files and no rows.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickstrata.llm.common import (
    Scratch,
    entries,
    file_uri,
    folded,
    text_id,
    worker_store,
    write_bytes,
)

END_ID = 1
SHARD_TOKENS = 4_000_000
MAGIC = b"WVM1"
RANK = 512  # bits between two stored ranks
STRETCH = 1 << 16  # tokens that are dealt out at once by a bit
KEPT = 200_000  # words whose ids a worker keeps
ASKED = 4096  # parts that are tokenized at once
TEXTS = 1 << 10  # texts encoded at once
SIGNS = b".,;:!?|*$%&#"  # at a word's end the tokenizer parts them from a letter


# --- the file ------------------------------------------------------------------


def _zeros_first(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The values whose bit is 0, then those whose bit is 1, each in their order."""
    out = np.empty_like(values)
    zero, one = 0, len(bits) - int(np.count_nonzero(bits))
    for at in range(0, len(bits), STRETCH):
        some, chosen = values[at : at + STRETCH], bits[at : at + STRETCH]
        ones = some[np.flatnonzero(chosen)]
        zeros = some[np.flatnonzero(~chosen)]
        out[zero : zero + len(zeros)] = zeros
        out[one : one + len(ones)] = ones
        zero, one = zero + len(zeros), one + len(ones)
    return out


def _back_in_order(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Undoes ``_zeros_first``."""
    out = np.empty_like(values)
    zero, one = 0, len(bits) - int(np.count_nonzero(bits))
    for at in range(0, len(bits), STRETCH):
        some, chosen = out[at : at + STRETCH], bits[at : at + STRETCH]
        ones, zeros = np.flatnonzero(chosen), np.flatnonzero(~chosen)
        some[zeros] = values[zero : zero + len(zeros)]
        some[ones] = values[one : one + len(ones)]
        zero, one = zero + len(zeros), one + len(ones)
    return out


def build(tokens: np.ndarray, ids: np.ndarray, nulls: np.ndarray, ends: np.ndarray) -> bytes:
    """The bytes of a shard's file."""
    levels = max(1, int(tokens.max()).bit_length())
    sections: list[tuple[str, bytes]] = [
        ("ids", ids.astype("<i8").tobytes()),
        ("nulls", np.packbits(nulls).tobytes()),
        ("ends", ends.astype("<u8").tobytes()),
    ]
    zeros, rest = [], tokens.astype("<u2") if levels <= 16 else tokens
    for level in range(levels - 1, -1, -1):
        bits = rest & rest.dtype.type(1 << level) != 0
        plane = np.packbits(bits, bitorder="little")
        padded = np.zeros(-(-len(plane) // 64) * 64, np.uint8)
        padded[: len(plane)] = plane
        ones = np.bitwise_count(padded.view("<u8")).reshape(-1, 8).sum(1, dtype=np.int64)
        ranks = np.concatenate([[0], np.cumsum(ones)]).astype("<u4")
        sections += [(f"plane{level}", plane.tobytes()), (f"ranks{level}", ranks.tobytes())]
        zeros.append(len(bits) - int(np.count_nonzero(bits)))
        rest = _zeros_first(rest, bits)
    packer = zstandard.ZstdCompressor(level=3)
    packed = [(name, packer.compress(raw)) for name, raw in sections]
    header = {
        "tokens": len(tokens),
        "docs": len(ids),
        "levels": levels,
        "zeros": zeros,
        "sections": [[name, len(raw)] for name, raw in packed],
    }
    head = json.dumps(header).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *(raw for _, raw in packed)])


class WaveletFile:
    """Rank, select and access over the bytes of one file."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet file")
        size = struct.unpack("<I", data[4:8])[0]
        self.header = json.loads(data[8 : 8 + size])
        self.data, self.at, at = data, {}, 8 + size
        for name, length in self.header["sections"]:
            self.at[name] = (at, length)
            at += length
        self.n, self.levels = self.header["tokens"], self.header["levels"]
        self._planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _section(self, name: str, kind: str) -> np.ndarray:
        at, length = self.at[name]
        raw = zstandard.ZstdDecompressor().decompress(self.data[at : at + length])
        return np.frombuffer(raw, kind)

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, whether they are null, and the ends of the documents."""
        count = self.header["docs"]
        nulls = np.unpackbits(self._section("nulls", "u1"), count=count).astype(bool)
        return self._section("ids", "<i8"), nulls, self._section("ends", "<u8").astype(np.int64)

    def _plane(self, i: int) -> tuple[np.ndarray, np.ndarray, int]:
        level = self.levels - 1 - i
        if i not in self._planes:
            self._planes[i] = (
                self._section(f"plane{level}", "u1"),
                self._section(f"ranks{level}", "<u4"),
            )
        return (*self._planes[i], self.header["zeros"][i])

    def _ones(self, i: int, position: int) -> int:
        """Ones of a plane before a position."""
        plane, ranks, _ = self._plane(i)
        block = position // RANK
        ones = int(ranks[block])
        part = plane[block * RANK // 8 : position // 8]
        ones += int(np.bitwise_count(part).sum())
        if position % 8:
            ones += (int(plane[position // 8]) & ((1 << position % 8) - 1)).bit_count()
        return ones

    def access(self, position: int) -> int:
        token = 0
        for i in range(self.levels):
            plane, _, zeros = self._plane(i)
            bit = int(plane[position // 8]) >> position % 8 & 1
            ones = self._ones(i, position)
            position = zeros + ones if bit else position - ones
            token = token << 1 | bit
        return token

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        for i in range(self.levels):
            _, _, zeros = self._plane(i)
            a, b = self._ones(i, low), self._ones(i, high)
            if token >> (self.levels - 1 - i) & 1:
                low, high = zeros + a, zeros + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of a token in positions from low to before high."""
        if token >> self.levels:
            return 0
        start, end = self._range(token, low, self.n if high is None else high)
        return end - start

    rank = count

    def _nth(self, i: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit of a plane."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            ones = self._ones(i, middle + 1)
            if (ones if bit else middle + 1 - ones) > k:
                high = middle
            else:
                low = middle + 1
        return low

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token."""
        if token >> self.levels:
            raise IndexError(k)
        start, end = self._range(token, 0, self.n)
        if not 0 <= k < end - start:
            raise IndexError(k)
        position = start + k
        for i in range(self.levels - 1, -1, -1):
            _, _, zeros = self._plane(i)
            bit = token >> (self.levels - 1 - i) & 1
            position = self._nth(i, bit, position - zeros if bit else position)
        return position

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All token ids, from the lowest plane back to the highest."""
        values = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for i in range(self.levels - 1, -1, -1):
            plane, _, zeros = self._plane(i)
            bits = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            values[zeros:] |= values.dtype.type(1 << self.levels - 1 - i)
            values = _back_in_order(values, bits)
            self._planes.pop(i)
        return values.astype(np.uint32)


# --- tokenizing ------------------------------------------------------------------


def byte_letters() -> list[str]:
    """The letter that byte-level tokenizers use for each byte: itself where it
    prints, else the next one from 256 on."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in printing else next(others)) for b in range(256)]


class Encoder:
    """Ids of texts by the tokenizer.

    It parts words at white space, and an ASCII letter from the signs that end its
    word, so the ids of a text are those of its words' parts; a worker keeps the
    words it has seen.  A part of lower-case letters alone is one piece to the
    tokenizer's model; any other part, and a text that may hold a special token,
    goes through the whole tokenizer.  Of the texts given at once each distinct
    word is looked up once.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.seen: dict[bytes, bytes] = {}
        self.letters = byte_letters()

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _learn(self, new: list[bytes]) -> None:
        others, tokenize, letters = [], self.model.tokenize, self.letters
        for raw in new:
            if raw.isalpha() and raw.islower():  # of ASCII letters
                part = raw.decode()
            else:
                part = raw.decode()
                plain = part.isalpha() and part == part.lower()
                if not (plain and is_normalized("NFC", part)):
                    others.append(raw)
                    continue
                part = "".join([letters[b] for b in raw])
            self.seen[raw] = array("I", [token.id for token in tokenize(part)]).tobytes()
        for at in range(0, len(others), ASKED):
            asked = others[at : at + ASKED]
            encoded = self._encode([raw.decode() for raw in asked])
            self.seen.update(zip(asked, encoded, strict=True))

    def _ids(self, distinct: list[bytes]) -> list[bytes]:
        """The ids of each word."""
        heads, signs = [], {}
        for i, word in enumerate(distinct):
            head = word.rstrip(SIGNS)
            if len(head) < len(word):
                if head and 97 <= head[-1] <= 122:  # a-z
                    signs[i] = word[len(head) :]
                else:
                    head = word
            heads.append(head)
        seen = self.seen
        new = dict.fromkeys(part for part in heads if part not in seen)
        new.update(dict.fromkeys(part for part in signs.values() if part not in seen))
        self._learn(list(new))
        ids = [seen[head] for head in heads]
        for i, part in signs.items():
            ids[i] += seen[part]
        return ids

    def __call__(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        if len(self.seen) > KEPT:
            self.seen.clear()
        whole = {i: text for i, text in enumerate(texts) if text and "<|" in text}
        plain = [b"" if i in whole else folded(text) for i, text in enumerate(texts)]
        split = pc.ascii_split_whitespace(pa.array(plain, pa.binary()).cast(pa.string()))
        of_text = pc.list_value_length(split).to_numpy()
        # Where a text begins or ends with blanks there are empty words.
        found = pc.list_flatten(split).cast(pa.binary()).dictionary_encode()
        self.seen[b""] = b""
        ids = self._ids(entries(found.dictionary))
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        tokens = np.frombuffer(b"".join(ids), dtype="<u4")
        word = found.indices.to_numpy()
        first, length = (np.cumsum(length) - length)[word], length[word]
        last = np.cumsum(length)
        place = np.repeat(first - (last - length), length)
        place += np.arange(len(place))
        tokens = tokens[place]
        ends = np.concatenate([[0], last])[np.cumsum(of_text)]
        start = 0
        for i, end in enumerate(ends.tolist()):
            if i in whole:
                own = np.frombuffer(self._encode([whole[i]])[0], dtype="<u4")
            else:
                own = tokens[start:end]
            yield np.append(own, np.uint32(END_ID))
            start = end


def _writer(tokenizer: str, root: str, shard_tokens: int):
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = worker_store().setdefault(f"encoder {tokenizer}", None)
        if encode is None:
            encode = worker_store()[f"encoder {tokenizer}"] = Encoder(tokenizer)
        part = TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        ids: list[int | None] = []
        seq = total = 0

        def shard() -> pd.DataFrame:
            name = f"{part:06d}-{seq:06d}-{uuid.uuid4().hex}.wvm"
            nulls = np.array([i is None for i in ids])
            known = np.array([0 if i is None else i for i in ids], dtype=np.int64)
            data = build(
                np.concatenate(held), known, nulls, np.cumsum([len(x) for x in held])
            )
            write_bytes(f"{root}/{name}", [data])
            return pd.DataFrame(
                {"file": [name], "part": [part], "seq": [seq], "n_tokens": [total]}
            )

        for frame in frames:
            known = frame["id"].astype(object).where(frame["id"].notna(), None)
            for at in range(0, len(frame), TEXTS):
                rows = zip(
                    known.iloc[at : at + TEXTS],
                    encode(list(frame["text"].iloc[at : at + TEXTS])),
                    strict=True,
                )
                for id_, tokens in rows:
                    if held and total + len(tokens) > shard_tokens:
                        yield shard()
                        held.clear()
                        ids.clear()
                        seq, total = seq + 1, 0
                    held.append(tokens)
                    ids.append(None if id_ is None else int(id_))
                    total += len(tokens)
        if held:
            yield shard()

    return write


def write_ids(
    docs: DataFrame,
    root: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Writes the shards under ``root``; (file, part, seq, n_tokens) of each, lazily."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
    )
    return (
        rows.repartitionByRange(F.col("id").asc_nulls_first())
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
        .select(text_id("id"), "text")
        .mapInPandas(
            _writer(tokenizer, root, shard_tokens),
            "file string, part int, seq int, n_tokens long",
        )
    )


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"], strict=True):
            shard = WaveletFile(content)
            ids, nulls, ends = shard.documents()
            tokens = shard.tokens().astype("<u4")
            starts = np.concatenate([[0], ends[:-1]])
            crc = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
            yield pd.DataFrame(
                {
                    "file": path.rpartition("/")[2],
                    "id": pd.array(np.where(nulls, 0, ids), dtype="Int64"),
                    "no_id": nulls,
                    "first": starts,
                    "n_tokens": ends - starts,
                    "ids_crc32": crc,
                }
            )


def read_documents(spark: SparkSession, root: str, shards: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    starts = shards.withColumn("within", within).join(totals, "part")
    starts = starts.select("file", (F.col("base") + F.col("within")).alias("base"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(root)
    decoded = files.select("path", "content").mapInPandas(
        _read,
        "file string, id long, no_id boolean, first long, n_tokens long, ids_crc32 long",
    )
    return decoded.join(starts, "file").select(
        F.when(~F.col("no_id"), F.col("id")).alias("id"),
        (F.col("base") + F.col("first")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def write_and_read(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Writes all ids and returns what the files then hold."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-ids")
    root = file_uri(spark, scratch.path("files"))
    shards = scratch.store(write_ids(docs, root, tokenizer, **options), "shards")
    if shards.isEmpty():
        return spark.createDataFrame(
            [], "id long, start long, n_tokens long, ids_crc32 long"
        )
    return read_documents(spark, root, shards)
