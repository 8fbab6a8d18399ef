"""Suffix-array dedup: removes every byte of a string of 100 that also starts earlier in the corpus.

Sorting every suffix of a corpus takes several times its size on disk, so text that can't repeat is
left out first, exactly. Each 100-byte window has an anchor, the smallest hash among its 32-byte
strings; equal windows have equal anchors. Consecutive windows of one anchor make a context (43
bytes of starts or so), and only contexts whose anchor occurs in another one go on. Equal contexts
need no sorting: all but the first are covered. What is left, one of each context, is dealt by
anchor to shards; a shard's suffixes are sorted by induced sorting with spilling bucket queues, and
runs of suffixes that share 100 bytes with their neighbour are one group, in which all starts but
the first are covered.

No task holds what grows with a group: a task passes on one copy of a context, and anchors with
very many contexts are grouped window by window instead of being sorted in one shard. Contexts and
such windows count as equal by 128 bits of hashes; what is sorted is compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import release_memory
from .shared import shared_path, written
from .shingles import mixed
from .suffix_sort import equal_prefixes, suffix_order

#: Bytes of a string, and of an anchor.
LENGTH, ANCHOR = 100, 32
#: Bytes handled at once; contexts that a task remembers; bytes of a shard; contexts of one anchor that go to a shard.
CHUNK, SEEN, SHARD, CROWD = 1 << 19, 300_000, 4 << 20, 10_000
NONE = -(2**63)

RUNS = "uid long, lo long, cnt int, off int, digest long, ctx long, again boolean"
SLICES = "uid long, lo long, cnt int, digest long, crowd boolean, data binary"
MARKS = "uid long, lo long, hi long"
RESULT = "uid long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

_rng = np.random.default_rng(77003)
_VALUE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_STEPS = [np.uint64(int(x) | 1) for x in _rng.integers(1 << 62, 1 << 63, 5, dtype=np.uint64)]
_BASE = np.uint64(0xA0761D6478BD642F)


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)


_UP, _DOWN = _powers(int(_BASE), 1 << 20), _powers(pow(int(_BASE), -1, 1 << 64), 1 << 20)


def _pieces(uids: list, texts: list, length: int) -> Iterator[tuple[list, list, list]]:
    """(uids, offsets, bytes) of pieces of at most CHUNK window starts, about CHUNK bytes together."""
    out: tuple[list, list, list] = ([], [], [])
    size = 0
    for uid, text in zip(uids, texts, strict=True):
        data = text.encode()
        for at in range(0, max(0, len(data) - length + 1), CHUNK):
            piece = data[at : at + CHUNK + length - 1]
            if size and size + len(piece) > CHUNK:
                yield out
                out, size = ([], [], []), 0
            for to, x in zip(out, (uid, at, piece), strict=True):
                to.append(x)
            size += len(piece)
    if size:
        yield out


def contexts(pieces: list[bytes], length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(piece, start in the piece, starts, anchor's place after the first, anchor's hash, context's hash), in order."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    lens = np.array([len(p) for p in pieces])
    ends = np.cumsum(lens)
    begin = ends - lens
    h, size = _VALUE[data], 1
    for step in _STEPS:
        h = h[:-size] * step + h[size:]
        size *= 2
    if size != anchor:
        raise ValueError("an anchor has 32 bytes")
    h = mixed(h)
    low = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
    wide, size = length - anchor + 1, 1
    while size * 2 <= wide:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < wide:
        low = np.minimum(low[: len(low) - (wide - size)], low[wide - size :])
    valid = np.ones(len(data), bool)
    for k in range(length - 1):
        valid[np.maximum(ends - 1 - k, begin)] = False
    starts = np.flatnonzero(valid)
    at = (low[starts] & np.uint64((1 << 20) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 0) | (np.diff(starts) != 1)]))
    lo, cnt, at = starts[new], np.diff(np.append(new, len(starts))), at[new]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[data] * _UP[: len(data)], dtype=np.uint64)])
    stop = lo + cnt + length - 1
    ctx = mixed(((sums[stop] - sums[lo]) * _DOWN[lo]) ^ mixed((stop - lo).astype(np.uint64)))
    piece = np.searchsorted(ends, lo, "right")
    return piece, lo - begin[piece], cnt, at - lo, h[at].view(np.int64), ctx.view(np.int64)


def mark_again(seen: dict, key: np.ndarray, ctx: np.ndarray, uid: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Whether a context has an equal one before it, here or in seen (key -> context's hash and first place), which learns them.

    Contexts are equal where key and hash agree, 128 bits in all; one that shares its key only is passed on.
    """
    order = np.lexsort((lo, uid, ctx, key))
    again = np.zeros(len(key), bool)
    again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (ctx[order[1:]] == ctx[order[:-1]])
    first = np.flatnonzero(~again)
    for i, k, here in zip(first.tolist(), key[first].tolist(), zip(ctx[first].tolist(), uid[first].tolist(), lo[first].tolist(), strict=True), strict=True):
        there = seen.setdefault(k, here)
        if there[0] != here[0]:
            continue
        if there < here:
            again[i] = True
        elif here < there:
            seen[k] = here
    return again


def find_runs(rows: DataFrame, length: int) -> DataFrame:
    """Contexts of rows(uid, text). again: the task has seen an equal one earlier in the corpus; such neighbours are one row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, int, int]] = {}
        for b in batches:
            for uids, offsets, pieces in _pieces(b.column(0).to_pylist(), b.column(1).to_pylist(), length):
                piece, lo, cnt, off, digest, ctx = contexts(pieces, length)
                uid, lo = np.array(uids, np.int64)[piece], lo + np.array(offsets, np.int64)[piece]
                if len(seen) > SEEN:
                    seen.clear()
                again = mark_again(seen, mixed(digest.view(np.uint64) ^ mixed(ctx.view(np.uint64))), ctx, uid, lo)
                joined = np.concatenate([[False], again[1:] & again[:-1] & (uid[1:] == uid[:-1]) & (lo[1:] == lo[:-1] + cnt[:-1])])
                head = np.flatnonzero(~joined)
                total = np.add.reduceat(cnt, head)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (uid[head], lo[head], total.astype(np.int32), off[head].astype(np.int32), digest[head], ctx[head], again[head])], names=["uid", "lo", "cnt", "off", "digest", "ctx", "again"])
        release_memory()

    return rows.mapInArrow(each, RUNS)


def cut_slices(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted(uid, lo, cnt, digest, crowd), from rows(uid, text)."""
    lists = wanted.groupBy("uid").agg(F.collect_list(F.struct("lo", "cnt", "digest", "crowd")).alias("parts"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uid, text, parts in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                data = text.encode()
                yield pa.RecordBatch.from_pylist([{"uid": uid, **p, "data": data[p["lo"] : p["lo"] + p["cnt"] + length - 1]} for p in parts], schema=schema)

    schema = pa.schema([("uid", pa.int64()), ("lo", pa.int64()), ("cnt", pa.int32()), ("digest", pa.int64()), ("crowd", pa.bool_()), ("data", pa.binary())])
    return rows.join(lists, "uid").select("uid", "text", "parts").mapInArrow(each, SLICES)


def _spans(uid: np.ndarray, lo: np.ndarray, base: np.ndarray, owner: np.ndarray, marked: np.ndarray) -> pa.RecordBatch:
    """Marked places of the joined slices as spans of starts, [lo, hi) in their documents."""
    at = np.flatnonzero(marked)
    own = owner[at]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(own) != 0)])) if len(at) else at
    first, count = at[new], np.diff(np.append(new, len(at)))
    start = lo[own[new]] + first - base[own[new]]
    return pa.RecordBatch.from_arrays([pa.array(uid[own[new]]), pa.array(start), pa.array(start + count)], names=["uid", "lo", "hi"])


def sort_slices(slices: DataFrame, length: int, folder: str) -> DataFrame:
    """Spans of starts in each shard's slices that an earlier start of the shard repeats."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        uid, lo, cnt = (np.concatenate([b.column(k).to_numpy() for b in got]) for k in range(3))
        parts = [x for b in got for x in b.column(5).to_pylist()]
        del got
        lens = np.array([len(p) for p in parts])
        base, text = np.cumsum(lens) - lens, np.frombuffer(b"".join(parts), np.uint8)
        owner = np.repeat(np.arange(len(parts)), lens)
        start = np.arange(len(text)) - base[owner] < cnt[owner]
        rank = np.empty(len(parts), np.int64)
        rank[np.lexsort((lo, uid))] = np.arange(len(parts))
        order = suffix_order(text, length, folder)
        order = order[start[order]]
        head = np.flatnonzero(~equal_prefixes(text, order, length))
        own = rank[owner[order]]
        first = np.repeat(np.minimum.reduceat(own, head), np.diff(np.append(head, len(order))))
        marked = np.zeros(len(text), bool)
        marked[order[own > first]] = True
        yield _spans(uid, lo, base, owner, marked)
        del text, owner, start, order, own, first, marked, parts
        release_memory()

    return slices.mapInArrow(each, MARKS)


def group_windows(slices: DataFrame, length: int) -> DataFrame:
    """As sort_slices, by 128-bit hashes of single windows, for anchors of very many contexts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uid, lo, cnt, data in zip(*(b.column(k).to_pylist() for k in (0, 1, 2, 5)), strict=True):
                marks = [hashlib.blake2b(data[k : k + length], digest_size=16).digest() for k in range(cnt)]
                yield pa.RecordBatch.from_arrays([pa.array(marks, pa.binary()), pa.array([uid] * cnt, pa.int64()), pa.array(range(lo, lo + cnt), pa.int64())], names=["mark", "uid", "lo"])

    windows = slices.mapInArrow(each, "mark binary, uid long, lo long")
    first = windows.groupBy("mark").agg(F.min(F.struct("uid", "lo")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return windows.join(first, "mark").where(F.struct("uid", "lo") != F.col("first")).select("uid", "lo", (F.col("lo") + 1).alias("hi"))


def covered(rows: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    """RESULT for rows(uid, text), from spans of covered starts."""
    lists = marks.groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("marks"))
    names = ["uid", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for text, marks in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                data, kept, at, spans, gone = text.encode(), [], 0, 0, 0
                end = -1  # of the removed run so far
                for lo, hi in sorted((m["lo"], m["hi"] + length - 1) for m in marks or []):
                    if lo > end:
                        spans += 1
                        kept.append(data[at:lo])
                    if hi > end:
                        gone, end = gone + hi - max(lo, end), hi
                        at = hi
                kept.append(data[at:])
                for to, x in zip(out, (len(data), gone, spans, hashlib.sha256(b"".join(kept)).hexdigest()), strict=True):
                    to.append(x)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)]], names=names)

    return rows.join(lists, "uid", "left").select("uid", "text", "marks").mapInArrow(each, RESULT)


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans [lo, hi) of starts whose string of length bytes starts earlier too, for rows(uid, text) of distinct uids."""
    spark = rows.sparkSession
    runs = written(find_runs(rows, length), "runs")
    order = Window.partitionBy("digest").orderBy("ctx", "uid", "lo")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = (
        runs.where("not again").drop("again")
        .select("*", F.lag("ctx").over(order).alias("before"), F.min("ctx").over(whole).alias("least"), F.max("ctx").over(whole).alias("most"), F.count(F.lit(1)).over(whole).alias("n"))
        .where("n > 1").withColumn("first", F.coalesce(F.col("before") != F.col("ctx"), F.lit(True)))
        .where("not first or least <> most")
    )
    shared = written(seen.select("uid", "lo", "cnt", "digest", "first", (F.col("n") > CROWD).alias("crowd")), "shared")
    equal = runs.where("again").select("uid", "lo", "cnt").unionByName(shared.where("not first").select("uid", "lo", "cnt")).select("uid", "lo", (F.col("lo") + F.col("cnt")).alias("hi"))
    wanted = shared.where("first").drop("first")
    spark.sparkContext._jvm.System.gc()  # frees the shuffle files of what is written by now
    slices = written(cut_slices(rows, wanted, length), "slices")
    size = slices.where("not crowd").agg(F.sum(F.length("data"))).first()[0] or 0
    sorted_ = sort_slices(slices.where("not crowd").repartition(max(1, -(-size // SHARD)), "digest"), length, shared_path(spark, "queues"))
    marks = written(equal.unionByName(sorted_).unionByName(group_windows(slices.where("crowd"), length)), "marks")
    spark.sparkContext._jvm.System.gc()
    return marks


def drop_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes, null as empty. Texts shorter than length lose nothing. A null identifier
    comes before any other; rows that repeat an identifier follow one another by text, so that of
    equal rows the first keeps its text. Other columns of docs are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if rows.groupBy("doc_id").count().where("count > 1").take(1):
        rows = written(rows.repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text").withColumn("uid", F.monotonically_increasing_id()), "rows")
        own = covered(rows.select("uid", "text"), repeated_spans(rows.select("uid", "text"), length), length)
        return rows.select("uid", "doc_id").join(own, "uid").drop("uid")
    rows = rows.select(F.coalesce("doc_id", F.lit(NONE).cast("long")).alias("uid"), "text")
    found = covered(rows, repeated_spans(rows, length), length)
    return found.select(F.when(F.col("uid") != NONE, F.col("uid")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
