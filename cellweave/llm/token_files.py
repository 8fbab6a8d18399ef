"""Token-ID files with shuffled planes.

A file holds the ids of consecutive documents. Ids are cut into blocks of fixed size; a block is
transposed into byte planes (or bit planes), and each plane is compressed with zstandard on its
own, so that high planes of small ids cost next to nothing. The footer has the chunk index (where
each plane of each block lies) and the document index. Layout: magic and header; planes; footer
(zstandard); its length as 8 bytes; magic.

Files are written under a name of the attempt and then renamed, in the shared folder: a task that
runs twice, or whose executor is lost, leaves the same file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import text_slices
from .shared import shared_path, written

MAGIC, HEADER = b"CWPLANE1", struct.Struct("<8sIB3x")
#: Ids in a block, and zstandard's level.
BLOCK, LEVEL = 1 << 16, 1
#: Words whose ids a worker keeps; when full, the later half goes, as frequent words come early.
KEPT_WORDS = 1_000_000
#: Characters encoded at once.
CHARS = 1 << 21
GAP = np.zeros(256, bool)
GAP[[9, 10, 11, 12, 13, 32]] = True
#: A mark of punctuation between a letter and white space is a word of its own to the tokenizer.
MARK, LETTER = np.zeros(256, bool), np.zeros(256, bool)
MARK[list(b".,;:!?")] = True
LETTER[ord("a") : ord("z") + 1] = True
#: Masks of the lowest bytes of a 64-bit value, by their number.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of bytes that end with white space."""
    gap = GAP[data]
    after, before = np.append(gap[1:], True), np.append(True, gap[:-1])
    alone = MARK[data] & after & np.append(False, LETTER[data[:-1]])
    starts = np.flatnonzero(~gap & (before | alone))
    return starts, np.flatnonzero(~gap & (after | np.append(alone[1:], False))) + 1


def distinct_words(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(distinct words, each word's place among them). raw has 16 bytes after the last word."""
    lens = ends - starts
    at = np.lib.stride_tricks.as_strided(np.frombuffer(raw, "<u8", 1), (len(raw) - 7,), (1,))
    low = at[starts] & _LOW[np.minimum(lens, 8)]
    high = at[np.minimum(starts + 8, len(raw) - 8)] & _LOW[np.clip(lens - 8, 0, 8)]
    wide = np.flatnonzero(lens > 16)
    if len(wide):  # a long word is known by a number of its own
        number: dict[bytes, int] = {}
        low[wide] = [number.setdefault(raw[a:b], len(number)) for a, b in zip(starts[wide].tolist(), ends[wide].tolist(), strict=True)]
        high[wide] = 0
        lens = np.minimum(lens, 17)
    mix = (low * np.uint64(0x9E3779B97F4A7C15)) ^ ((high + lens.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, first, place = np.unique(mix ^ (mix >> np.uint64(29)), return_index=True, return_inverse=True)
    words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    same = first[place]
    if not ((low == low[same]) & (high == high[same]) & (lens == lens[same])).all():  # two words of one mix
        known: dict[bytes, int] = {}
        place = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
        words = list(known)
    return words, place


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Planes of 32-bit little-endian ids: four of bytes, or 32 of bits from the lowest."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [raw[:, k].tobytes() for k in range(4)]
    return [row.tobytes() for row in np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if not bits:
        return np.ascontiguousarray(np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)).view("<u4").ravel()
    rows = np.unpackbits(np.stack([np.frombuffer(p, np.uint8) for p in planes]), axis=1, bitorder="little")[:, :n]
    return np.ascontiguousarray(np.packbits(rows.T, axis=1, bitorder="little")).view("<u4").ravel()


class Writer:
    def __init__(self, out, block: int = BLOCK, bits: bool = False, level: int = LEVEL):
        self.out, self.block, self.bits, self.zstd = out, block, bits, zstandard.ZstdCompressor(level=level)
        self.at = out.write(HEADER.pack(MAGIC, block, bits)) or HEADER.size
        self.index, self.docs, self.counts, self.pending, self.waiting, self.total = [], [], [], [], 0, 0

    def add(self, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> None:
        """Documents (None for a null identifier), their numbers of ids, and all those ids."""
        self.docs += doc_ids
        self.counts.append(np.asarray(counts, np.int64))
        self.pending.append(np.asarray(ids, np.uint32))
        self.waiting, self.total = self.waiting + len(ids), self.total + len(ids)
        if self.waiting >= self.block:
            left = np.concatenate(self.pending)
            full = len(left) - len(left) % self.block
            for k in range(0, full, self.block):
                self._chunk(left[k : k + self.block])
            self.pending, self.waiting = [left[full:].copy()], len(left) - full

    def _chunk(self, ids: np.ndarray) -> None:
        sizes = []
        for plane in to_planes(ids, self.bits):
            packed = self.zstd.compress(plane)
            self.out.write(packed)
            sizes.append(len(packed))
        self.index.append([self.at, len(ids), *sizes])
        self.at += sum(sizes)

    def close(self) -> None:
        if self.waiting:
            self._chunk(np.concatenate(self.pending))
        chunks = np.array(self.index, np.int64).tobytes()
        docs = np.array([0 if d is None else d for d in self.docs], np.int64).tobytes()
        nulls = np.array([d is None for d in self.docs], np.uint8).tobytes()
        counts = (np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)).tobytes()
        foot = self.zstd.compress(struct.pack("<QQ", len(self.index), len(self.docs)) + chunks + docs + nulls + counts)
        self.out.write(foot + struct.pack("<Q", len(foot)) + MAGIC)


class Reader:
    """Chunks by number, and documents in order, from a file open for random access."""

    def __init__(self, f, size: int):
        self.f, self.zstd = f, zstandard.ZstdDecompressor()
        magic, self.block, self.bits = HEADER.unpack(f.read_at(HEADER.size, 0))
        length, end = struct.unpack("<Q8s", f.read_at(16, size - 16))
        if magic != MAGIC or end != MAGIC:
            raise ValueError("not a token file, or cut short")
        foot = self.zstd.decompress(f.read_at(length, size - 16 - length))
        n, docs = struct.unpack_from("<QQ", foot)
        wide, at = 2 + (32 if self.bits else 4), 16
        self.index = np.frombuffer(foot, np.int64, n * wide, at).reshape(n, wide)
        self.doc_ids = np.frombuffer(foot, np.int64, docs, at := at + n * wide * 8)
        self.nulls = np.frombuffer(foot, np.uint8, docs, at := at + docs * 8).astype(bool)
        self.counts = np.frombuffer(foot, np.int64, docs, at + docs)

    def chunk(self, k: int) -> np.ndarray:
        at, n, *sizes = (int(x) for x in self.index[k])
        raw, planes, o = self.f.read_at(sum(sizes), at), [], 0
        for s in sizes:
            planes.append(self.zstd.decompress(raw[o : o + s]))
            o += s
        return from_planes(planes, n, self.bits)

    def documents(self) -> Iterator[list[np.ndarray]]:
        """Each document's ids, in parts that lie in one chunk each."""
        chunk, k, o = np.zeros(0, np.uint32), 0, 0
        for left in self.counts.tolist():
            parts = []
            while left:
                if o == len(chunk):
                    chunk, k, o = self.chunk(k), k + 1, 0
                parts.append(chunk[o : o + left])
                o, left = o + len(parts[-1]), left - len(parts[-1])
            yield parts


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space and lower-cases, through its library.

    No token spans white space, so a text's ids are those of its words one after another; each
    distinct word goes through the library once, many in one call, parted by a symbol of one id.
    Texts that hold a special token's string, in any letter case, go through the library whole.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tok, self.end = Tokenizer.from_file(path), end_id
        self.special = [t.content.lower().encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.mark, self.mark_id = next((c, ids[0]) for c in "§©®±¤" if len(ids := self.encode(c)) == 1)
        self.clear()

    def encode(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def clear(self) -> None:
        self.number: dict[bytes, int] = {b"": 0}
        self.flat, self.stops, self.size = np.full(1 << 16, self.end, np.uint32), np.ones(1 << 16, np.int64), 1
        self.stops[0] = 0

    def halve(self) -> None:
        half = len(self.number) // 2 + 1
        self.number = dict(islice(self.number.items(), half))
        self.size = int(self.stops[half])

    def learn(self, new: list[bytes]) -> None:
        mark = self.mark.encode()
        plain = [w for w in new if mark not in w]
        alone = [w for w in new if mark in w]
        for k in range(0, len(plain), 1000):
            some = plain[k : k + 1000]
            ids = np.array(self.encode(f" {self.mark} ".join(w.decode() for w in some) + f" {self.mark}"), np.uint32)
            cut = np.flatnonzero(ids == self.mark_id)
            if len(cut) == len(some):
                self._keep(some, np.diff(cut, prepend=-1) - 1, ids[ids != self.mark_id])
            else:  # a word's normal form holds the mark
                alone += some
        if alone:
            parts = [np.array(self.encode(w.decode()), np.uint32) for w in alone]
            self._keep(alone, np.array([len(p) for p in parts], np.int64), np.concatenate(parts))

    def _keep(self, words: list[bytes], lens: np.ndarray, ids: np.ndarray) -> None:
        n = len(self.number)
        self.number.update(zip(words, range(n, n + len(words)), strict=True))
        if n + len(words) >= len(self.stops):
            self.stops = np.resize(self.stops, 2 * (n + len(words)))
        if self.size + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (self.size + len(ids)))
        self.stops[n + 1 : n + 1 + len(words)] = self.size + np.cumsum(lens)
        self.flat[self.size : self.size + len(ids)] = ids
        self.size += len(ids)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text with its end id, all those ids)."""
        if len(self.number) > KEPT_WORDS:
            self.halve()
        raws = [t.encode().lower() for t in texts]
        whole = {i: np.array(self.encode(texts[i]), np.uint32) for i, r in enumerate(raws) if b"<|" in r and any(s in r for s in self.special)}
        for i in whole:
            raws[i] = b""
        raw = b" ".join(raws) + b" " * 17
        starts, ends = word_bounds(np.frombuffer(raw, np.uint8))
        words, place = distinct_words(raw, starts, ends)
        number = self.number
        if new := [w for w in words if w not in number]:
            self.learn(new)
        kept = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        # the words of each text, and then the end, which is number 0
        stops = np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raws]))
        last = stops + np.arange(len(raws))
        at = np.zeros(len(starts) + len(raws), np.int64)
        own = np.ones(len(at), bool)
        own[last] = False
        at[own] = kept[place]
        start, lens = self.stops[at], self.stops[at + 1] - self.stops[at]
        ends = np.cumsum(lens)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - lens), lens)]
        sizes = np.diff(ends[last], prepend=0)
        for i in sorted(whole, reverse=True):
            o = int(ends[last[i]]) - 1
            ids = np.concatenate([ids[:o], whole[i], ids[o:]])
            sizes[i] += len(whole[i])
        return sizes, ids


@lru_cache(1)
def word_encoder(path: str, end_id: int) -> WordEncoder:
    return WordEncoder(path, end_id)


MANIFEST = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("path", T.StringType()), T.StructField("n_docs", T.LongType()), T.StructField("n_ids", T.LongType())])
DOCUMENT = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 1, block: int = BLOCK, bits: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes docs in ascending identifier order, nulls first, and returns the manifest: shard, path, n_docs, n_ids.

    Null and empty texts have the end id alone. Rows that repeat an identifier follow by text. An
    empty table gives an empty manifest. The tokenizer's path has to hold on every executor.
    """
    folder = shared_path(docs.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, encoder, shard = None, word_encoder(tokenizer, end_id), TaskContext.get().partitionId()
        store, top = fs.FileSystem.from_uri(folder)
        own = f"{top}/{shard:08d}.{uuid.uuid4().hex}"
        for b in batches:
            at = 0
            for texts in text_slices(b.column(1), CHARS):
                if writer is None:
                    store.create_dir(top, recursive=True)
                    writer = Writer(store.open_output_stream(own), block, bits)
                writer.add(b.column(0).slice(at, len(texts)).to_pylist(), *encoder(texts))
                at += len(texts)
        if writer is not None:
            writer.close()
            writer.out.close()
            store.move(own, path := f"{top}/{shard:08d}.planes")
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [f"{folder}/{path.rpartition('/')[2]}"], "n_docs": [len(writer.docs)], "n_ids": [writer.total]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    placed = manifest.select("shard", "path", (F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist(), strict=True):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as f:
                    file = Reader(f, f.size())
                    crcs = np.zeros(len(file.counts), np.int64)
                    for i, parts in enumerate(file.documents()):
                        crc = 0
                        for p in parts:
                            crc = zlib.crc32(p, crc)
                        crcs[i] = crc
                starts = start + np.cumsum(file.counts) - file.counts
                yield pa.RecordBatch.from_arrays([pa.array(file.doc_ids, mask=file.nulls), pa.array(starts), pa.array(file.counts), pa.array(crcs)], names=DOCUMENT.names)

    return placed.repartition(max(1, manifest.count())).mapInArrow(read, DOCUMENT)
