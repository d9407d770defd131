"""Token-id archives: documents compressed one by one with a shared zstandard dictionary.

``write_archive`` encodes documents, appends an end id, serializes each document's ids
(unsigned 16-bit where the vocabulary allows, else 32-bit, little-endian) and compresses
each alone with a dictionary trained on serialized id arrays.  Shards cover ascending,
disjoint doc_id ranges.  A shard file is

    magic, id width, dictionary SHA-256 | frames | doc_id index, offset index, counts | footer

so one short document is read with the footer, its index entry and its own frame
(``read_document``); ``read_archive`` reads whole shards as Spark tasks.  A file is written
under a temporary name and renamed, so a task that runs again after a lost executor
replaces it by equal content.

Shards are ranges of doc_id of about equal size, one task each; an id (or the lack of one) that fills several
shards is spread over them.

Edge cases: a null text counts as empty (its ids are the end id alone); a null doc_id
sorts first; rows that share a doc_id are all kept, in any order among them; a very long text is one frame, and
its shard's file may exceed the part size by it; an empty
table gives an archive without shards; other columns are not read.

The dictionary is fitted on a bounded sample: at most ``sample_docs`` documents of at most
``sample_chars`` characters, from those with the smallest hashes of doc_id.  It changes
sizes, never contents.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlake.llm.tokens import encoder

MAGIC = b"TIDZ0001"
_HEAD = struct.Struct("<8sI32s")          # magic, bytes an id, dictionary SHA-256
_FOOT = struct.Struct("<QQ8s")            # index position, documents, magic
_FRAMES = "doc_id bigint, shard int, n_tokens bigint, frame binary"
_MANIFEST = ("shard int, part int, file string, first_doc_id bigint, last_doc_id bigint, n_docs bigint, "
             "n_tokens bigint, n_bytes bigint, dictionary_sha256 string")


# ---------------------------------------------------------------- writing

def _sample(docs: DataFrame, tokenizer: str, sample_docs: int, sample_chars: int, width: int) -> list[bytes]:
    # ids alone are ordered; only the chosen rows' texts leave their task
    hashes = docs.select(F.xxhash64("doc_id").alias("h")).orderBy("h").limit(sample_docs)
    cutoff = hashes.agg(F.max("h")).first()[0]
    if cutoff is None:
        return []
    rows = (docs.filter((F.xxhash64("doc_id") <= cutoff) & F.length("text").between(1, sample_chars))
            .select("text").limit(sample_docs).collect())
    ids = encoder(tokenizer).ids_of(pa.array([r[0] for r in rows], pa.string()))
    return [np.frombuffer(x, "<u4").astype(f"<u{width}").tobytes() for x in ids]


class Bounds(NamedTuple):
    """How rows are dealt to shards: ``nulls`` shards of null ids first, then ranges that end at ``ids``."""

    nulls: int
    ids: np.ndarray

    @property
    def shards(self) -> int:
        return self.nulls + self.ids.size + 1

    def shard_of(self, doc_id: int | None, place: int) -> int:
        """A range's shard; where an id fills several (its bound repeats), or has none, the row's place decides."""
        if doc_id is None:
            return place % self.nulls if self.nulls else 0
        low, high = np.searchsorted(self.ids, doc_id, "left"), np.searchsorted(self.ids, doc_id, "right")
        return self.nulls + int(low) + place % int(high - low + 1)


def _bounds(docs: DataFrame, shard_chars: int, most: int = 65_536) -> Bounds:
    """Ranges of doc_id of about ``shard_chars`` characters, from a sample of some ``most`` rows' ids and lengths.

    The sample steers sizes only.  There are at most ``most`` / 8 ranges; beyond, shards have more files."""
    length = F.coalesce(F.length("text"), F.lit(0)) + 1
    rows, chars = docs.agg(F.count("*"), F.sum(length)).first()
    if not rows:
        return Bounds(0, np.zeros(0, np.int64))
    some = docs.select("doc_id", length.alias("n"))
    if rows > most:
        some = some.sample(most / rows, seed=1).limit(2 * most)
    found = [(r[0], r[1]) for r in some.collect()]
    if not found:
        return Bounds(0, np.zeros(0, np.int64))
    shards = max(1, min(-(-chars // shard_chars), most // 8))
    each = sum(n for _, n in found) / shards
    nulls = int(sum(n for i, n in found if i is None) / each)
    known = sorted((i, n) for i, n in found if i is not None)
    upto = np.cumsum([n for _, n in known])
    ranges = max(1, shards - nulls)
    cuts = np.searchsorted(upto, [upto[-1] * k / ranges for k in range(1, ranges)]) if known else []
    return Bounds(nulls, np.array([known[k][0] for k in cuts], np.int64))


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary; with too few samples their plain bytes serve as one."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _encode(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, width: int,
            dictionary: bytes, bounds: Bounds, level: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(tokenizer)
    press = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary), write_dict_id=False)
    end = np.array([end_id], "<u4").tobytes()
    place = 0
    for batch in batches:
        counts, frames, shards = [], [], []
        for doc_id, raw in zip(batch.column(0).to_pylist(), enc.ids_of(batch.column(1))):
            ids = np.frombuffer(raw + end, "<u4")
            counts.append(ids.size)
            frames.append(press.compress(ids.astype(f"<u{width}").tobytes()))
            shards.append(bounds.shard_of(doc_id, place))
            place += 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(shards, pa.int32()), pa.array(counts, pa.int64()),
             pa.array(frames, pa.binary())], names=["doc_id", "shard", "n_tokens", "frame"])


class _ShardFile:
    """One open shard file."""

    def __init__(self, root: str, shard: int, part: int, width: int, digest: bytes):
        self.fs, self.dir = pafs.FileSystem.from_uri(root)
        self.name = f"shard-{shard:06d}-{part:04d}.tid"
        self.temp = f"{self.dir}/_{self.name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temp)
        self.shard, self.part, self.digest = shard, part, digest
        self.out.write(_HEAD.pack(MAGIC, width, digest))
        self.at = _HEAD.size
        self.docs: list[int | None] = []
        self.offsets: list[int] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, n_tokens: int, frame: bytes) -> None:
        self.docs.append(doc_id)
        self.offsets.append(self.at)
        self.counts.append(n_tokens)
        self.out.write(frame)
        self.at += len(frame)

    def close(self) -> tuple:
        n = len(self.docs)
        self.out.write(np.array([d or 0 for d in self.docs], "<i8").tobytes())
        self.out.write(np.array([d is None for d in self.docs], np.uint8).tobytes())
        self.out.write(np.array([*self.offsets, self.at], "<u8").tobytes())
        self.out.write(np.array(self.counts, "<u8").tobytes())
        self.out.write(_FOOT.pack(self.at, n, MAGIC))
        self.out.close()
        self.fs.move(self.temp, f"{self.dir}/{self.name}")
        known = [d for d in self.docs if d is not None]
        return (self.shard, self.part, self.name, known[0] if known else None, known[-1] if known else None,
                n, sum(self.counts), self.at, self.digest.hex())


def _write(batches: Iterator[pa.RecordBatch], root: str, width: int, digest: bytes,
           part_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard and doc_id; a file is closed at ``part_bytes``."""
    rows, current = [], None
    for batch in batches:
        for doc_id, shard, n, frame in zip(*(c.to_pylist() for c in batch.columns)):
            if current and (current.shard != shard or current.at >= part_bytes):
                part = current.part + 1 if current.shard == shard else 0
                rows.append(current.close())
                current = _ShardFile(root, shard, part, width, digest)
            elif current is None:
                current = _ShardFile(root, shard, 0, width, digest)
            current.add(doc_id, n, frame)
    if current:
        rows.append(current.close())
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [
            pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
            pa.string()])], names=[c.split()[0] for c in _MANIFEST.split(", ")])


def write_archive(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shard_chars: int = 32 << 20,
                  part_bytes: int = 64 << 20, dictionary_bytes: int = 64 << 10, sample_docs: int = 400,
                  sample_chars: int = 20_000, level: int = 3) -> str:
    """Write ``docs`` (doc_id, text) to ``path`` (a folder all executors share); returns ``path``.

    ``docs`` is a stored table: the rows of an id that fills several shards are dealt by their places in it."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    width = 2 if max(encoder(tokenizer).vocab_size, end_id + 1) <= 1 << 16 else 4
    dictionary = train_dictionary(_sample(docs, tokenizer, sample_docs, sample_chars, width), dictionary_bytes)
    digest = hashlib.sha256(dictionary).digest()
    fs, folder = pafs.FileSystem.from_uri(path)
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/dictionary-{digest.hex()}.zdict") as out:
        out.write(dictionary)
    with fs.open_output_stream(f"{folder}/archive.json") as out:
        out.write(json.dumps({"width": width, "end_id": end_id, "dictionary_sha256": digest.hex()}).encode())

    bounds = _bounds(docs, shard_chars)
    frames = docs.mapInArrow(lambda it: _encode(it, tokenizer, end_id, width, dictionary, bounds, level), _FRAMES)
    (frames.repartitionById(bounds.shards, "shard").sortWithinPartitions("shard", "doc_id", "n_tokens", "frame")
     .mapInArrow(lambda it: _write(it, path, width, digest, part_bytes), _MANIFEST)
     .write.parquet(f"{path}/files"))
    # a row per shard file: their number is the archive's size over the part size
    order = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    (docs.sparkSession.read.parquet(f"{path}/files")
     .withColumn("start", F.coalesce(F.sum("n_tokens").over(order), F.lit(0).cast("long")))
     .write.parquet(f"{path}/manifest"))
    return path


# ---------------------------------------------------------------- reading

class ShardReader:
    """Random access to one shard file."""

    def __init__(self, root: str, name: str, dictionaries: dict[bytes, bytes] | None = None):
        self.fs, folder = pafs.FileSystem.from_uri(root)
        self.file = self.fs.open_input_file(f"{folder}/{name}")
        magic, self.width, digest = _HEAD.unpack(self.file.read_at(_HEAD.size, 0))
        at, n, foot = _FOOT.unpack(self.file.read_at(_FOOT.size, self.file.size() - _FOOT.size))
        if magic != MAGIC or foot != MAGIC:
            raise ValueError(f"{name} is no token-id shard")
        index = self.file.read_at(self.file.size() - _FOOT.size - at, at)
        self.doc_ids = np.frombuffer(index, "<i8", n)
        self.is_null = np.frombuffer(index, np.uint8, n, 8 * n).astype(bool)
        self.offsets = np.frombuffer(index, "<u8", n + 1, 9 * n).astype(np.int64)
        self.counts = np.frombuffer(index, "<u8", n, 9 * n + 8 * (n + 1)).astype(np.int64)
        known = dictionaries if dictionaries is not None else {}
        if digest not in known:
            with self.fs.open_input_stream(f"{folder}/dictionary-{digest.hex()}.zdict") as f:
                known[digest] = f.read()
            if hashlib.sha256(known[digest]).digest() != digest:
                raise ValueError(f"the dictionary of {name} doesn't have the hash in its header")
        self.unpress = zstandard.ZstdDecompressor(dict_data=_dictionary(known[digest]))

    def ids(self, i: int) -> np.ndarray:
        a, b = self.offsets[i], self.offsets[i + 1]
        raw = self.unpress.decompress(self.file.read_at(int(b - a), int(a)))
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def _read(batches: Iterator[pa.RecordBatch], root: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    dictionaries: dict[bytes, bytes] = {}
    for batch in batches:
        for name, base in zip(*(c.to_pylist() for c in batch.columns)):
            with ShardReader(root, name, dictionaries) as shard:
                n = shard.counts.size
                starts = base + np.concatenate([[0], np.cumsum(shard.counts)])[:-1]
                for a in range(0, n, 2000):
                    z = min(n, a + 2000)
                    ids = [shard.ids(i) for i in range(a, z)]
                    cols = [pa.array(shard.doc_ids[a:z], mask=shard.is_null[a:z]), pa.array(starts[a:z], pa.int64()),
                            pa.array([x.size for x in ids], pa.int64()),
                            pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols.append(pa.array([x.tolist() for x in ids], pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, names=names)


def read_archive(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """A row per document from the shard files: doc_id, start, n_tokens, ids_crc32 and, if asked, ids."""
    files = spark.read.parquet(f"{path}/manifest").select("file", "start")
    tasks = max(1, files.count())
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return files.repartition(tasks).mapInArrow(lambda it: _read(it, path, with_ids), schema)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with this doc_id: one manifest lookup, one index, one frame each."""
    files = (spark.read.parquet(f"{path}/manifest")
             .filter((F.col("first_doc_id") <= doc_id) & (F.col("last_doc_id") >= doc_id))
             .orderBy("shard", "part").select("file").collect())
    found = []
    for (name,) in files:
        with ShardReader(path, name) as shard:
            found += [shard.ids(int(i)) for i in np.flatnonzero((shard.doc_ids == doc_id) & ~shard.is_null)]
    return found
