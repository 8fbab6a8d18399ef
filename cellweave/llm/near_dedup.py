"""MinHash near-dedup with min-max hashing.

Each permutation gives a set's smallest and largest hash, so a signature of 168 values takes 84
hash evaluations for each shingle. Bands of four values, of four permutations each, give the
candidates: a pair at similarity 0.75 shares none of 42 bands with probability 1.2e-7 (a band of
smallest and largest values of the same permutations would lose more of small sets, where the two
rule one another out). Links are confirmed on full sets.

Copies with the same word sequence are one candidate. Each bucket first offers the pairs of its
members with its smallest number; after the links found so far have joined components, buckets
that still hold several components offer the pairs between different ones. A pair is offered by the
first band that it shares and only if sizes and sketches of 2,048 values (five standard deviations
under the threshold) allow a link; this is tested before a row is made. Buckets are cut into tiles of
about TILE members: a task compares two tiles, many pairs at a time in numpy, and a document's set goes
once to each tile.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_documents, release_memory
from .components import connected_components
from .shared import written
from .shingles import band_keys, min_max_signatures, sequence_keys, shingle_sets, sketch_bits, word_hashes

#: Words in a shingle; similarity in hundredths; permutations and values in a band; permutations of a sketch and bits of its values.
WORDS, PERCENT, PERMUTATIONS, ROWS, SKETCH, PLANES = 5, 75, 84, 4, 1024, 2
#: Documents hashed at once hold about so many characters; members of a bucket in a tile; pairs listed and sketches compared at once.
CHARS, TILE, PAIRS, SKETCHES = 1 << 19, 2048, 1 << 18, 1 << 13

_LONG, _LONGS = T.LongType(), T.ArrayType(T.LongType())
SIGNATURE = T.StructType([T.StructField("doc_id", _LONG), T.StructField("digest", T.StringType()), T.StructField("k1", _LONG), T.StructField("k2", _LONG), T.StructField("n_shingles", _LONG), T.StructField("bands", _LONGS)])
FULL = T.StructType([T.StructField("doc_id", _LONG), T.StructField("n", _LONG), T.StructField("sketch", _LONGS), T.StructField("hashes", T.BinaryType())])
NONE = -(2**63)


def _pieces(texts: list[str]) -> Iterator[slice]:
    at = 0
    while at < len(texts):
        stop, chars = at, 0
        while stop < len(texts) and chars < CHARS:
            chars, stop = chars + len(texts[stop]), stop + 1
        yield slice(at, stop)
        at = stop


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (MD5 of the text), k1 and k2 (128 bits of the word sequence), n_shingles, bands (none for an empty set)."""

    def columns(ids: list, texts: list) -> list:
        out: list[list] = [ids, [hashlib.md5(t.encode()).hexdigest() for t in texts], [], [], [], []]
        for piece in _pieces(texts):
            words, counts = word_hashes([t.encode() for t in texts[piece]])
            sets = shingle_sets(words, counts, WORDS)
            k1, k2 = sequence_keys(words, counts)
            bands = band_keys(min_max_signatures(sets, PERMUTATIONS), ROWS)
            for to, made in zip(out[2:], (k1.tolist(), k2.tolist(), [len(s) for s in sets], [b if len(s) else [] for b, s in zip(bands, sets, strict=True)]), strict=True):
                to += made
        return out

    return map_documents(docs, columns, SIGNATURE, id_col, text_col)


def full_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (size of the set), sketch, hashes (the sorted set as little-endian 64-bit values)."""

    def columns(ids: list, texts: list) -> list:
        out: list[list] = [ids, [], [], []]
        for piece in _pieces(texts):
            sets = shingle_sets(*word_hashes([t.encode() for t in texts[piece]]), WORDS)
            out[1] += [len(s) for s in sets]
            out[2] += list(sketch_bits(min_max_signatures(sets, SKETCH, seed=11), PLANES))
            out[3] += [s.astype("<u8").tobytes() for s in sets]
        return out

    return map_documents(docs, columns, FULL, id_col, text_col)


def most_differing(percent: int) -> int:
    """How many values of two sketches may differ if a link is possible.

    Values agree in all planes at similarity s with probability s + (1 - s) / 2 ** planes.
    """
    chance = percent / 100 + (1 - percent / 100) / 2**PLANES
    return int((1 - chance + 5 * (chance * (1 - chance) / (2 * SKETCH)) ** 0.5) * 2 * SKETCH)


def may_link(percent: int) -> Column:
    """Whether sizes an, bn and sketches asketch, bsketch leave a link possible."""
    wide, differ = 2 * SKETCH // 64, F.lit(0)
    for i in range(wide):  # word by word, so that the test runs in generated code
        unequal = F.lit(0).cast("long")
        for k in range(PLANES):
            at = F.lit(k * wide + i)
            unequal = unequal.bitwiseOR(F.get("asketch", at).bitwiseXOR(F.get("bsketch", at)))
        differ = differ + F.bit_count(unequal)
    return (F.least("an", "bn") * 100 >= F.greatest("an", "bn") * percent) & (differ <= most_differing(percent))


def pairs_in_runs(starts: np.ndarray, rows: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j of rows of the same run, some ``most`` at a time; starts: the first row of each run."""
    ends = np.repeat(np.append(starts[1:], rows), np.diff(np.append(starts, rows)))
    after = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - np.arange(rows) - 1)])  # pairs of the rows before
    at = 0
    while at < rows:
        stop = max(at + 1, int(np.searchsorted(after, after[at] + most, "right")) - 1)
        i = np.repeat(np.arange(at, stop), np.diff(after[at : stop + 1]))
        yield i, np.arange(after[at], after[stop]) - after[i] + i + 1
        at = stop


def possible(i: np.ndarray, j: np.ndarray, n: np.ndarray, sketch: np.ndarray, percent: int) -> np.ndarray:
    """may_link of rows i with rows j, by sizes n and sketches (rows by words)."""
    keep, most = np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent, most_differing(percent)
    sized = np.flatnonzero(keep)
    for lo in range(0, len(sized), SKETCHES):
        own = sized[lo : lo + SKETCHES]
        unequal = np.bitwise_or.reduce((sketch[i[own]] ^ sketch[j[own]]).reshape(len(own), PLANES, -1), axis=1)
        keep[own] = np.bitwise_count(unequal.view(np.uint64)).sum(axis=1, dtype=np.int64) <= most
    return keep


def first_shared(i: np.ndarray, j: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first key of rows i that rows j have too; keys: rows by padded keys, of which counts are real."""
    out, real = np.zeros(len(i), np.int64), np.arange(keys.shape[1]) < counts[:, None]
    for lo in range(0, len(i), SKETCHES // 4):
        x, y = i[lo : lo + SKETCHES // 4], j[lo : lo + SKETCHES // 4]
        shared = ((keys[x][:, :, None] == keys[y][:, None, :]) & real[y][:, None, :]).any(axis=2)
        out[lo : lo + len(x)] = keys[x, shared.argmax(axis=1)]
    return out


def crossing(members: DataFrame, percent: int) -> DataFrame:
    """a, salt, b: pairs of different components in a bucket that may link, each by the smallest of the bands that both have.

    members: band, tiles, tile, doc_id, component, bands, n, sketch. A pair of tiles (low, high) is one
    run of rows, the member of the lower tile first; runs are dealt by ranges, as their sizes differ.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    met = members.withColumn("other", other).withColumn("low", F.least("tile", "other").cast("long")).withColumn("high", F.greatest("tile", "other").cast("long"))
    met = met.select("band", "low", "high", F.col("tile").cast("long").alias("tile"), "doc_id", "component", "n", "sketch", "bands")
    dealt = met.repartitionByRange(parts, "band", "low", "high").sortWithinPartitions("band", "low", "high", "tile", "doc_id")

    def test(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        band, low, high, tile, doc, component, n = (rows.column(c).to_numpy() for c in range(7))
        sketch, flat = (np.concatenate([c.flatten().to_numpy() for c in rows.column(k).chunks]) for k in (7, 8))
        sketch, counts = sketch.reshape(len(doc), -1), pc.list_value_length(rows.column(8)).to_numpy()
        keys = np.zeros((len(doc), counts.max()), np.int64)
        keys[np.arange(keys.shape[1]) < counts[:, None]] = flat
        for i, j in pairs_in_runs(starts, len(doc), PAIRS):
            new = (component[i] != component[j]) & ((tile[i] != tile[j]) | (low[i] == high[i]))
            i, j = i[new], j[new]
            keep = possible(i, j, n, sketch, percent)
            i, j = i[keep], j[keep]
            first = first_shared(i, j, keys, counts) == band[i]
            i, j = i[first], j[first]
            yield pa.RecordBatch.from_arrays([pa.array(doc[i]), pa.array(high[i]), pa.array(doc[j])], names=["a", "salt", "b"])

    def in_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last run, which the next batch may go on with
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            ids = np.stack([rows.column(c).to_numpy() for c in range(3)])
            starts = np.concatenate([np.zeros(min(1, rows.num_rows), np.int64), 1 + np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0))])
            if len(starts) > 1:
                yield from test(rows.slice(0, starts[-1]), starts[:-1])
            held = rows.slice(starts[-1]) if len(starts) else held
        if held is not None and held.num_rows:
            yield from test(held, np.zeros(1, np.int64))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_runs(batches)
        release_memory()

    return dealt.mapInArrow(each, "a long, salt long, b long")


def tiles(n: Column) -> Column:
    return F.ceil(n / TILE).cast("int")


def beside(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """pairs(a, salt, b) with the columns of a and of b; those of a go once to each salt of theirs."""
    return pairs.join(pairs.select("a", "salt").distinct().join(a, "a"), ["a", "salt"]).join(b, "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs(a, salt, b) whose full sets are similar enough, as a and b."""
    a, b = (sets.select(F.col("doc_id").alias(x), F.col("hashes").alias(f"{x}h")) for x in "ab")
    both = beside(pairs, a, b)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                same = len(x) + len(y) - len(np.union1d(x, y)) if len(x) and len(y) else 0
                keep.append(100 * same >= percent * (len(x) + len(y) - same) and same > 0)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        release_memory()

    return both.select("a", "b", "ah", "bh").mapInArrow(test, "a long, b long")


def _grouped(docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id (NONE for null), digest, n_shingles, component_id, kept of every row.

    Nodes are the distinct word sequences, under numbers of their own; a node stands for its rows, of
    which the first by identifier and digest is shown to the sketches.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NONE).cast("long")).alias("doc_id"), text.alias("text"))
    rows = written(signatures(own).withColumn("row", F.monotonically_increasing_id()), "signatures")
    rep = rows.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "digest", "row")).alias("rep"))
    first = written(rep.withColumn("node", F.monotonically_increasing_id()), "first")
    alone = rows.join(first.select(F.col("rep.row").alias("row"), "node"), "row")
    banded = written(alone.select(F.col("node").alias("doc_id"), F.explode("bands").alias("band")).distinct(), "banded")
    heads = banded.groupBy("band").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(banded.join(heads, "band").select("band", "doc_id", "head", F.pmod(F.hash("doc_id"), tiles(F.col("n"))).alias("salt")), "buckets")
    wanted = first.join(buckets.select(F.col("doc_id").alias("node")).distinct(), "node").select("rep.doc_id", "rep.digest", "node")
    shown = own.withColumn("digest", F.md5(F.col("text").cast("binary"))).join(wanted, ["doc_id", "digest"])
    sets = written(full_sets(shown, "node").dropDuplicates(["doc_id"]), "sets")
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("n").alias(f"{x}n"), F.col("sketch").alias(f"{x}sketch"))
    star = written(buckets.where("doc_id <> head").groupBy(F.col("head").alias("a"), F.col("doc_id").alias("b")).agg(F.min("salt").alias("salt")), "star")
    offered = written(beside(star, side("a"), side("b")).where(may_link(percent)).select("a", "salt", "b"), "offered")
    links = written(confirmed(offered, sets, percent), "links")

    label = connected_components(links)
    placed = buckets.join(label.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select("band", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    several = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo <> hi").select("band", tiles(F.col("members")).alias("tiles"))
    open_ = written(placed.join(several, "band").withColumn("tile", F.pmod(F.hash("doc_id"), F.col("tiles"))), "open")
    bands = open_.groupBy("doc_id").agg(F.sort_array(F.collect_list("band")).alias("bands"))
    full = written(open_.join(bands, "doc_id").join(sets.select("doc_id", "n", "sketch"), "doc_id"), "full")
    cross = crossing(full, percent)
    more = written(confirmed(written(cross, "cross"), sets, percent), "more")

    # components that later links join: the graph is contracted to the first components
    first_of = lambda x: F.coalesce(f"{x}c", x)
    ends = more
    for x in "ab":
        ends = ends.join(label.select(F.col("node").alias(x), F.col("component").alias(f"{x}c")), x, "left")
    joined = connected_components(ends.select(first_of("a").alias("a"), first_of("b").alias("b"))).select(F.col("node").alias("component"), F.col("component").alias("final"))
    nodes = first.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    nodes = written(nodes.join(joined, "component", "left").select("k1", "k2", "rep", F.coalesce("final", "component").alias("component")), "nodes")
    least = nodes.groupBy("component").agg(F.min("rep").alias("least"))
    found = rows.select("doc_id", "digest", "row", "k1", "k2", "n_shingles").join(nodes.join(least, "component").select("k1", "k2", "least"), ["k1", "k2"], "left")
    return found.select(
        "doc_id", "digest", "n_shingles", F.coalesce("least.doc_id", "doc_id").alias("component_id"), F.coalesce(F.col("row") == F.col("least.row"), F.lit(True)).alias("kept")
    )


def near_groups(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Null, empty and blank texts have no shingles, link with nothing and are kept; texts of fewer words
    than a shingle are one shingle. A component has the smallest identifier of its rows, a null one
    counting as the smallest, and keeps one row. Rows link by their texts, never by their identifiers.
    """
    shown = lambda c: F.when(F.col(c) != NONE, F.col(c)).alias(c)
    return _grouped(docs, percent, id_col, text_col).select(shown("doc_id"), "n_shingles", shown("component_id"), "kept")


def drop_near(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one of each component and all without words, with their own columns, whatever their names.

    A component's row is known by identifier and text; of rows equal in both, one stays. Null text
    counts as empty, a null identifier as the smallest; an empty table stays empty.
    """
    ident, digest = F.coalesce(F.col(id_col).cast("long"), F.lit(NONE).cast("long")), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    kept = _grouped(docs, percent, id_col, text_col).where("kept").select(F.col("doc_id").alias("id"), "digest", (F.col("n_shingles") == 0).alias("blank")).distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("row"), ident.alias("id"), digest.alias("digest"))
    both = keyed.join(kept, ["id", "digest"]).withColumn("each", F.when(F.col("blank"), F.monotonically_increasing_id()))
    return both.withColumn("place", F.row_number().over(Window.partitionBy("id", "digest", "each").orderBy("id"))).where("place = 1").select("row.*")
