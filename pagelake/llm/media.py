"""Media columns: FLAC streams stored beside rows, and read as PCM blocks that can be sought by sample."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm import flac
from pagelake.llm.common import column, ship, texts

#: Bytes that are encoded or decoded together, at most (at least one row).
TOGETHER = 2_000_000
PAD = 64


def _groups(values: list[bytes]) -> Iterator[slice]:
    start, held = 0, 0
    for k, v in enumerate(values):
        if k > start and held + len(v) > TOGETHER:
            yield slice(start, k)
            start, held = k, 0
        held += len(v)
    if values:
        yield slice(start, len(values))


def padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % PAD if raw else PAD)


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media of every row: its text, padded, as a FLAC stream of 8-bit samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch["raw"].to_pylist()
            for s in _groups(raw):
                media = flac.encode([padded(x) for x in raw[s]])
                yield pa.RecordBatch.from_arrays([batch["doc_id"][s.start : s.stop], pa.array([len(x) for x in raw[s]], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    ship(docs.sparkSession)
    return texts(docs).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def _decoded(media: list[bytes | None]) -> Iterator[tuple[object, object]]:
    """(stream, samples) of each stream, or (None, what is wrong with it). Streams are decoded together, damaged ones alone."""
    for s in _groups([m or b"" for m in media]):
        part = [m or b"" for m in media[s]]
        try:
            yield from flac.decode(part)
        except (flac.Damaged, IndexError, ValueError):
            for data in part:
                try:
                    yield flac.decode([data])[0]
                except (flac.Damaged, IndexError, ValueError) as e:
                    yield None, str(e) or type(e).__name__


def _pcm(x: np.ndarray, bits: int) -> bytes:
    if bits <= 8:
        return x.astype(np.int8).tobytes()
    return np.ascontiguousarray(x.astype("<i4")).reshape(-1, 1).view(np.uint8)[:, : (bits + 7) // 8].tobytes()


BLOCKS = "block long, sample_offset long, n_samples long, channels int, bits int, pcm binary, error string"


def blocks_of(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """The PCM blocks of a column `media`, in order, with the batch's other columns beside them."""
    names = [x.split()[0] for x in BLOCKS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string()]

    def out(batch: pa.RecordBatch, of: list[int], rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        others = [c for c in batch.schema.names if c != "media"]
        return pa.RecordBatch.from_arrays([*(batch[c].take(pa.array(of, pa.int64())) for c in others), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=[*others, *names])

    for batch in batches:
        of, rows, held = [], [], 0
        for i, (info, x) in enumerate(_decoded(batch["media"].to_pylist())):
            if info is None:
                of.append(i)
                rows.append((None, None, None, None, None, None, x))
                continue
            for j, at in enumerate(range(0, max(1, len(x)), block)):
                part = x[at : at + block]
                of.append(i)
                rows.append((j, at, len(part), info.channels, info.bits, _pcm(part, info.bits), None))
            held += len(x)
            if held > TOGETHER:
                yield out(batch, of, rows)
                of, rows, held = [], [], 0
        yield out(batch, of, rows)


def pcm_blocks(media: DataFrame, key: str = "doc_id", block: int = flac.BLOCK) -> DataFrame:
    """PCM blocks of a column `media`: key, block, sample_offset, n_samples, channels, bits, pcm (little-endian), error.

    Blocks have `block` samples, the last fewer, so sample s lies in block s // block: see `seek`. Damaged or null
    media give one row whose `error` says why and whose pcm is null; no row is dropped.
    """
    ship(media.sparkSession)
    rows = media.select(column(media, key, "bigint").alias("media_key"), column(media, "media", "binary"))
    return rows.mapInArrow(lambda batches: blocks_of(batches, block), f"media_key long, {BLOCKS}").withColumnRenamed("media_key", key)


def seek(blocks: DataFrame, start: int, count: int, block: int = flac.BLOCK) -> DataFrame:
    """The blocks that hold samples start to start + count; the filter on `block` reaches a Parquet scan."""
    return blocks.filter(F.col("block").between(start // block, (start + max(1, count) - 1) // block))


class Description:
    """Hash, tail and features of a payload whose blocks come one after the other."""

    def __init__(self) -> None:
        self.sha, self.tail, self.n, self.sum, self.squares, self.crossings, self.last = hashlib.sha256(), b"", 0, 0, 0, 0, None

    def add(self, pcm: bytes) -> None:
        x = np.frombuffer(pcm, np.int8)
        payload = (x.astype(np.int16) + 128).astype(np.uint8).tobytes()
        self.sha.update(payload)
        self.tail = (self.tail + payload)[-PAD:]
        v, below = x.astype(np.int64), x < 0
        self.n, self.sum, self.squares = self.n + len(x), self.sum + int(v.sum()), self.squares + int((v * v).sum())
        self.crossings += int((below[1:] != below[:-1]).sum()) + (self.last is not None and bool(below[0]) != self.last)
        self.last = bool(below[-1])

    def row(self) -> tuple:
        """payload_bytes, payload_sha256, tail_crc32, feature: samples, mean, root mean square and zero crossings."""
        feature = f"n={self.n};mean={self.sum / self.n:.4f};rms={np.sqrt(self.squares / self.n):.4f};crossings={self.crossings}"
        return self.n, self.sha.hexdigest(), zlib.crc32(self.tail), feature


DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digests(stored: DataFrame, block: int = flac.BLOCK) -> DataFrame:
    """What reading the stored streams back as PCM blocks gives: hashes of payload and media, sizes and a feature string.

    A stream's blocks come one after the other, so one pass over them is enough, however long it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = [x.split()[0] for x in DIGESTS.split(", ")]
        for batch in batches:
            media = batch["media"].to_pylist()
            found = [Description() for _ in media]
            numbered = pa.RecordBatch.from_arrays([pa.array(range(len(media)), pa.int64()), batch["media"]], names=["row", "media"])
            for part in blocks_of(iter([numbered]), block):
                for row, pcm in zip(part["row"].to_pylist(), part["pcm"].to_pylist(), strict=True):
                    found[row].add(pcm)
            rows = []
            for data, one in zip(media, found, strict=True):
                n, sha, crc, feature = one.row()
                rows.append((n, sha, crc, len(data), hashlib.sha256(data).hexdigest(), feature))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], *(pa.array(c, t) for c, t in zip(cols, kinds[2:], strict=True))], names=names)

    ship(stored.sparkSession)
    return stored.mapInArrow(run, DIGESTS)


def round_trip(docs: DataFrame) -> DataFrame:
    """One row per row of docs: its text stored as FLAC, the stored stream read back as PCM blocks and described.

    Null or empty text: 64 zero bytes. Equal texts give equal values; repeated rows each get a row, a null doc_id stays null,
    and only doc_id and text are read, whatever other columns are called. A map over the scan, no shuffle.
    """
    return digests(store(docs))
