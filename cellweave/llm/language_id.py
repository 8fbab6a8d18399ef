"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

Subwords are the byte 2-, 3- and 4-grams of the words, with a blank before and after each word;
ASCII letters are lower-cased and other ASCII bytes are blanks. A text's vector is the mean of its
subwords' embeddings. The model is linear after the mean, so prediction uses one table of class
scores by subword, and reads every byte of a text once for each length.

Confidence is calibrated on documents kept out of the training: a temperature that minimises their
loss, and a threshold under which a prediction is rejected.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import release_memory, text_slices
from .shared import written

#: Buckets of subwords, width of embeddings, lengths of subwords, bytes handled at once.
BUCKETS, WIDTH, GRAMS, CHUNK = 1 << 16, 16, (2, 3, 4), 1 << 19
#: Documents judged at once hold about so many characters.
CHARS = 1 << 20
#: Labelled documents of each language to learn from, expected; bytes of a training example; passes; step.
PER_LANGUAGE, EXAMPLE, EPOCHS, STEP, BATCH = 400, 160, 3, 0.5, 64
#: Labelled documents to learn from in all, expected.
MOST = 40_000
#: Share of sampled documents kept out for calibration, and share of these that may be rejected.
HELD, REJECTED = 0.25, 0.001
#: A text under the threshold stays if so large a share of its pieces reach it, as those of a text in two languages do.
PIECES = 0.5

LETTER = re.compile(r"[^\W\d_]")
BLANK = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
UNKNOWN = "und"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())])


def letters(text: str) -> bytes:
    return b" " + text.encode().lower().translate(BLANK) + b" "


def subwords(data: np.ndarray) -> Iterator[np.ndarray]:
    """For each length, the bucket at every start; BUCKETS where a blank stands inside or nothing else."""
    blank = data == 32
    wide = data.astype(np.uint32)
    for n in GRAMS:
        m = max(0, len(data) - n + 1)
        h, bad = np.zeros(m, np.uint32), np.zeros(m, bool)
        for k in range(n):
            h = h * np.uint32(0x01000193) + wide[k : k + m]
            if 0 < k < n - 1:
                bad |= blank[k : k + m]
        if n == 2:
            bad |= blank[:m] & blank[1 : 1 + m]
        h = (h * np.uint32(0x9E3779B1)) >> np.uint32(16)
        yield np.where(bad, BUCKETS, h % BUCKETS).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray = field(repr=False)  # (BUCKETS + 1) by langs; the last row is zero
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0
    least: float = 0.0

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """Class scores of prepared texts, before the temperature."""
        out = np.zeros((len(texts), len(self.langs)))
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (size == 0 or size + len(texts[stop]) <= CHUNK):
                size, stop = size + len(texts[stop]), stop + 1
            out[at:stop] = self._logits(texts[at:stop])
            at = stop
        return out

    def _logits(self, texts: list[bytes]) -> np.ndarray:
        lens = np.array([len(t) for t in texts])
        total, count = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        data = np.frombuffer(b"".join(texts), np.uint8)
        for lo in range(0, len(data), CHUNK):  # a long text in overlapping pieces
            piece = data[lo : lo + CHUNK + GRAMS[-1] - 1]
            starts = np.cumsum(lens) - lens - lo
            inside = np.flatnonzero((starts < CHUNK) & (starts + lens > 0))
            first = np.maximum(starts[inside], 0)
            for n, h in zip(GRAMS, subwords(piece), strict=True):
                h = h[:CHUNK]
                if len(h) == 0:
                    continue
                own = first < len(h)
                total[inside[own]] += np.add.reduceat(self.scores[h], first[own], axis=0, dtype=np.float64)
                count[inside[own]] += np.add.reduceat(h < BUCKETS, first[own], dtype=np.int64)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
        z = self.logits([letters(t) for t in texts]) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        lang, score, taken = [], [], []
        for text, k, s in zip(texts, best.tolist(), p[np.arange(len(best)), best].tolist(), strict=True):
            known = LETTER.search(text) is not None
            lang.append(self.langs[k] if known else UNKNOWN)
            score.append(s if known else 0.0)
            taken.append(known and (s >= self.least or self.mixed(letters(text))))
        return lang, score, taken

    def mixed(self, text: bytes) -> bool:
        """Whether enough pieces of a prepared text are sure of some language, each on its own."""
        pieces = [text[k : k + EXAMPLE] for k in range(0, len(text) - EXAMPLE // 2, EXAMPLE)]
        if len(pieces) < 2:
            return False
        z = self.logits(pieces) / self.temperature
        best = 1 / np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1)
        return float((best >= self.least).mean()) >= PIECES


def train(rows: list[tuple[int, str, str]], seed: int = 0) -> Model:
    """A model from (identifier, text, language); a fixed order makes reruns agree."""
    rows = sorted((r for r in rows if LETTER.search(r[1])), key=lambda r: (r[0], r[2], r[1]))
    langs = sorted({r[2] for r in rows})
    if not langs:
        return Model([], np.zeros((BUCKETS + 1, 0)))
    code, rng = {x: i for i, x in enumerate(langs)}, np.random.default_rng(seed)
    held = rng.random(len(rows)) < HELD
    examples = []
    for (_, text, lang), out in zip(rows, held, strict=True):
        if not out:
            raw = letters(text)
            examples += [(raw[k : k + EXAMPLE], code[lang]) for k in range(0, max(1, len(raw) - EXAMPLE // 4), EXAMPLE)]
    near, weight, bias = rng.normal(0, 0.1, (BUCKETS + 1, WIDTH)).astype(np.float32), np.zeros((WIDTH, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    weight[:] = rng.normal(0, 0.1, weight.shape)
    marks = [np.concatenate([g[g < BUCKETS] for g in subwords(np.frombuffer(x, np.uint8))]) for x, _ in examples]
    wanted = np.array([y for _, y in examples], np.int64)
    useful = np.flatnonzero([len(m) > 0 for m in marks])
    share = 1 / np.maximum(np.bincount(wanted[useful], minlength=len(langs)), 1)
    share = share / share[wanted[useful]].mean() if len(useful) else share
    for epoch in range(EPOCHS):
        order = rng.permutation(useful)
        for k in range(0, len(order), BATCH):
            some = order[k : k + BATCH]
            lens = np.array([len(marks[i]) for i in some])
            ids, y = np.concatenate([marks[i] for i in some]), wanted[some]
            starts = np.cumsum(lens) - lens
            mean = np.add.reduceat(near[ids], starts, axis=0) / lens[:, None]
            z = mean @ weight + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p *= share[y][:, None]
            step = STEP * (1 - (epoch + k / max(1, len(order))) / EPOCHS)
            back = (p @ weight.T) / lens[:, None]
            weight -= step * (mean.T @ p).astype(np.float32) / np.float32(8)
            bias -= np.float32(step / len(y)) * p.sum(axis=0).astype(np.float32)
            touched, at = np.unique(ids, return_inverse=True)
            rise = np.repeat(back, lens, axis=0)
            near[touched] -= np.float32(step) * np.stack([np.bincount(at, rise[:, j], len(touched)) for j in range(WIDTH)], axis=1).astype(np.float32)
    scores = (near @ weight).astype(np.float32)
    scores[BUCKETS] = 0
    model = Model(langs, scores, bias.astype(np.float64))
    kept = [r for r, out in zip(rows, held, strict=True) if out] or rows
    z, y = model.logits([letters(t) for _, t, _ in kept]), np.array([code[x] for _, _, x in kept])

    def chances(temperature: float) -> np.ndarray:
        e = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
        return e / e.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.05, 5, 60)
    model.temperature = float(grid[np.argmin([-np.log(chances(t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid])])
    right = chances(model.temperature)
    sure = right.max(axis=1)[right.argmax(axis=1) == y]
    model.least = float(np.quantile(sure, REJECTED)) if len(sure) else 0.0
    return model


def remainder(ident: Column) -> Column:
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4, F.lit(0))


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, most: int) -> list[tuple[int, str, str]]:
    """About per_language labelled rows of each language, by a hash, and about ``most`` in all; never those held out."""
    known = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where(F.col("t").isNotNull() & F.col("l").isNotNull() & (remainder(F.col("i")) != 2))
    count = written(known.groupBy("l").agg(F.count(F.lit(1)).alias("n")), "languages")
    languages = count.count()
    each = min(per_language, most / max(1, languages))
    chosen = known.join(count, "l").where(F.pmod(F.xxhash64("i", F.lit(17)), F.lit(1 << 30)) < F.lit(each * (1 << 30)) / F.col("n"))
    return [(r["i"] or 0, r["t"], r["l"]) for r in chosen.select("i", "t", "l").limit(int(2 * each * languages) + 1000).collect()]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, seed: int = 0, most: int = MOST) -> Model:
    """A model from about per_language rows of each language, whose identifier's CRC-32 modulo 4 is not 2.

    Above most / per_language languages each has fewer rows, so that the sample stays bounded; none is left out for its number.
    """
    return train(training_rows(docs, id_col, text_col, lang_col, per_language, most), seed)


def predict_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score, accepted.

    Null, empty and letterless texts are ``und`` with score 0 and are not accepted, as is every
    text where there was nothing to learn from. Equal class scores go to the language first in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            out = pa.array([i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in ids.to_pylist()])
            made = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays([ids, out, *[pa.array(x, t) for x, t in zip(made, (pa.string(), pa.float64(), pa.bool_()), strict=True)]], names=SCHEMA.names)
        release_memory()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(each, SCHEMA)


def accepted_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs whose language is recognised with enough confidence, with their own columns, whatever their names.

    Null, empty and letterless texts go, as does every text where there was nothing to learn from.
    Rows are judged one by one: repeats share their fate, and an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for some in text_slices(b.column(b.schema.get_field_index(text_col)).fill_null(""), CHARS):
                yield b.slice(at, len(some)).filter(pa.array(shared.value.predict(some)[2], pa.bool_()))
                at += len(some)
                some = None
                release_memory()
            b = None
        release_memory()

    return docs.mapInArrow(each, docs.schema)
