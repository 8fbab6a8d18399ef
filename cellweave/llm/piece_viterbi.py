"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice of a text has a boundary after each symbol and an arc for each vocabulary piece. Only
boundaries within the longest piece's length of the end can be extended, so earlier ones whose
every arc has died are forgotten, and ids are committed as soon as all surviving backpointer paths
run through one boundary. State is the window and the paths since the last such boundary.

Two kinds of model choose among paths. A unigram model keeps, at each boundary, the path with the
highest sum of scores. A byte-pair model's merges leave one path at each boundary: a piece may
follow another only where merging the two's symbols gives back the same two, and a sequence whose
neighbours all agree in this way is the one that merging the whole text gives.

Where no piece holds a blank after another symbol, every path runs through the boundary before a
word, as they do before a mark that no piece holds after a letter: there all paths have converged
and the search commits. The distinct words of some texts are searched side by side, a lane each, and
those longer than a lane one by one through the stream. No ids are kept between.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import release_memory, text_slices

BLANK = "▁"
MARKS = ".,;:!?\n"
#: A worker keeps so many judged pairs of pieces; texts encoded at once hold about so many characters.
KEPT_PAIRS, CHARS = 500_000, 1 << 20
#: Symbols of a lane, in two classes of length, and lanes searched at once.
WIDTHS, LANES = (16, 64), 4096
#: Odd multiplier that spreads keys over a table.
SPREAD = 0x9E3779B97F4A7C15
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ids_crc32", T.LongType()), T.StructField("lossless", T.BooleanType())])


class Pieces:
    """A model's pieces and scores, from its file; kind is bpe or unigram."""

    def __init__(self, path: str, kind: str = "bpe"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = range(model.get_piece_size())
        plain = [i for i in n if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.kind, self.normalize = kind, model.normalize
        self.text = {i: model.id_to_piece(i) for i in plain}
        self.ids = {p: i for i, p in self.text.items()}
        self.score = {i: model.get_score(i) for i in plain}
        #: Each piece's id, and -1 for a string that only starts pieces.
        self.arcs = {p[:k]: -1 for p in self.ids for k in range(1, len(p))} | self.ids
        self.longest = max(map(len, self.ids))
        self.byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in n if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.word_bound = not any(BLANK in p.lstrip(BLANK) for p in self.ids)
        #: Letters that no piece holds before one of the marks: every path runs through the boundary between.
        bound = {x for p in self.ids for x, y in zip(p, p[1:], strict=False) if y in MARKS}
        self.letter = rf"[^\W\d_{re.escape(''.join(sorted(x for x in bound if re.match(r'[^\W\d_]', x))))}]"
        self.lowest = min(self.score.values())
        self.bytes = {i: p.replace(BLANK, " ").encode() for i, p in self.text.items()} | {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.same = model.normalize("  a éﬁ\t\nA ") == BLANK * 3 + "a" + BLANK + "éﬁ\t\nA" + BLANK

    def spelling(self, arc: int) -> list[int]:
        """Ids of a symbol in no piece, whose arc is -1 - its code point."""
        return [self.byte_ids[b] for b in chr(-1 - arc).encode()] if self.byte_ids else [self.unknown]

    def merged(self, text: str) -> list[str]:
        """Symbols after merging neighbours, the best-scored piece first, of equal ones the leftmost."""
        parts: list[str | None] = list(text)
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        agenda: list[tuple[float, int, str]] = []

        def propose(left: int) -> None:
            if left >= 0 and after[left] >= 0 and (k := self.ids.get(both := parts[left] + parts[after[left]])) is not None:
                heappush(agenda, (-self.score[k], left, both))

        for left in range(len(parts)):
            propose(left)
        while agenda:
            _, left, both = heappop(agenda)
            right = after[left]
            if parts[left] is None or right < 0 or parts[left] + parts[right] != both:
                continue
            parts[left], parts[right], after[left] = both, None, after[right]
            if after[left] >= 0:
                before[after[left]] = left
            propose(before[left])
            propose(left)
        return [x for x in parts if x is not None]

    def agree(self, a: int, b: int) -> bool:
        """Whether byte-pair merging of two pieces' symbols gives the same two pieces."""
        x, y = self.text[a], self.text[b]
        return x + y not in self.ids and self.merged(x + y) == [x, y]


class Table:
    """Whole numbers from 0 by keys from 0, found many at a time (open addressing)."""

    def __init__(self, room: int = 1 << 14):
        self.bits, self.size = max(10, (4 * room - 1).bit_length()), 0
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Each key's value, or -1."""
        mask = (1 << self.bits) - 1
        slot = ((keys.view(np.uint64) * np.uint64(SPREAD)) >> np.uint64(64 - self.bits)).view(np.int64)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & mask
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out

    def put(self, keys: list[int], values: list[int]) -> None:
        """Adds keys that are not in the table."""
        if 3 * (self.size + len(keys)) > 1 << self.bits:
            full = self.keys >= 0
            old = self.keys[full].tolist(), self.values[full].tolist()
            self.__init__(2 * (self.size + len(keys)))
            self.put(*old)
        mask, shift, known = (1 << self.bits) - 1, 64 - self.bits, self.keys
        for key, value in zip(keys, values, strict=True):
            slot = (key * SPREAD & 0xFFFFFFFFFFFFFFFF) >> shift
            while known[slot] >= 0:
                slot = (slot + 1) & mask
            known[slot], self.values[slot] = key, value
        self.size += len(keys)


class Lanes:
    """The search of many short byte-pair texts at once, step by step.

    A lane's boundaries are a row of back (the boundary before) and taken (the piece between).
    """

    def __init__(self, pieces: Pieces):
        self.p, self.pairs = pieces, Table()
        state = {p: i + 1 for i, p in enumerate(pieces.arcs)}
        self.piece = np.full(len(state) + 1, -1, np.int64)
        self.piece[1:] = list(pieces.arcs.values())
        self.steps = Table(len(state))
        self.steps.put([state.get(p[:-1], 0) << 21 | ord(p[-1]) for p in state], list(state.values()))

    def agree(self, before: np.ndarray, piece: np.ndarray, judge) -> np.ndarray:
        """Whether each piece may follow the one before, -1 standing for the text's start."""
        keys = np.maximum(before, 0) << 32 | piece
        found = self.pairs.get(keys)
        new = np.unique(keys[(found < 0) & (before >= 0)])
        if len(new):
            if self.pairs.size + len(new) > KEPT_PAIRS:
                self.pairs = Table()
            self.pairs.put(new.tolist(), [int(judge(k >> 32, k & 0xFFFFFFFF)) for k in new.tolist()])
            found = self.pairs.get(keys)
        return (before < 0) | (found > 0)

    def search(self, texts: list[str], judge) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids)."""
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        wide = int(lens.max(initial=0))
        flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), lens)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        # arcs: pieces that start at a symbol, by length
        found, state, at = [], np.zeros(len(flat), np.int64), np.arange(len(flat))
        left, single = lens[owner] - place, np.zeros(len(flat), bool)
        for n in range(1, min(wide, self.p.longest) + 1):
            state = self.steps.get(state << 21 | flat[at + n - 1]).astype(np.int64)
            piece = np.where(state >= 0, self.piece[state], -1)
            good = piece >= 0
            found.append((at[good], piece[good], np.full(int(good.sum()), n)))
            if n == 1:
                single[at[good]] = True
            more = (state >= 0) & (left[at] > n)
            state, at = state[more], at[more]
        lone = np.flatnonzero(~single)
        found.append((lone, -1 - flat[lone], np.ones(len(lone), np.int64)))
        start, arc, size = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(place[start].astype(np.uint8), kind="stable")
        start, arc, size = start[order], arc[order], size[order]
        cut = np.searchsorted(place[start], np.arange(wide + 1))
        none = np.iinfo(np.int64).min
        back, taken = np.zeros((len(texts), wide + 1), np.int64), np.full((len(texts), wide + 1), none)
        taken[:, 0] = -1
        for k in range(wide):
            part = slice(cut[k], cut[k + 1])
            lane, piece, end = owner[start[part]], arc[part], k + size[part]
            before = taken[lane, k]
            open_ = before != none
            lane, piece, end, before = lane[open_], piece[open_], end[open_], before[open_]
            fit = piece < 0
            fit[~fit] = self.agree(before[~fit], piece[~fit], judge)
            taken[lane[fit], end[fit]], back[lane[fit], end[fit]] = piece[fit], k
        rows, end, spelt = np.arange(len(texts)), lens.copy(), []
        while len(rows := rows[end[rows] > 0]):
            spelt.append((rows, taken[rows, end[rows]]))
            end[rows] = back[rows, end[rows]]
        sizes = np.zeros(len(texts), np.int64)
        for rows, _ in spelt:
            sizes[rows] += 1
        last, out = np.cumsum(sizes) - 1, np.zeros(int(sizes.sum()), np.int64)
        for k, (rows, arcs) in enumerate(spelt):
            out[last[rows] - k] = arcs
        if not (out < 0).any():
            return sizes, out
        # a symbol in no piece has ids of its own
        arcs, kind = np.unique(np.minimum(out, 0), return_inverse=True)
        spelt = [np.array(self.p.spelling(a), np.int64) for a in arcs.tolist() if a < 0]
        wide = np.array([*map(len, spelt), *[1] * (len(arcs) - len(spelt))])[kind]
        flat, stops = np.concatenate(spelt), np.cumsum(wide)
        ids = np.repeat(out, wide)
        own = np.flatnonzero(out < 0)
        begin = np.cumsum([0, *map(len, spelt)])[kind[own]]
        grown = np.arange(int(wide[own].sum())) - np.repeat(np.cumsum(wide[own]) - wide[own], wide[own])
        ids[np.repeat(stops[own] - wide[own], wide[own]) + grown] = flat[np.repeat(begin, wide[own]) + grown]
        return np.diff(np.append(0, stops)[last + 1], prepend=0), ids


class Search:
    """Streaming search: feed(text) as often as wanted, then finish(); ids come as they are committed."""

    def __init__(self, pieces: Pieces):
        self.p, self.pairs = pieces, {}
        self.reset()

    def reset(self) -> None:
        #: boundary -> [previous boundary, arc, score, boundaries that follow]; arc: a piece's id, or -1 - code point of a symbol in no piece
        self.at, self.root, self.nodes, self.tail, self.tail_at = 0, 0, {0: [0, -1, 0.0, []]}, "", 0

    def agrees(self, a: int, b: int) -> bool:
        """Whether one piece may follow another, kept for the stream."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        known = self.pairs[a << 32 | b] = self.p.agree(a, b)
        return known

    def feed(self, text: str, last: bool = False) -> list[int]:
        self.tail += text
        tail, base, nodes, pairs, out = self.tail, self.tail_at, self.nodes, self.pairs, []
        arcs, longest, bpe, score = self.p.arcs, self.p.longest, self.p.kind == "bpe", self.p.score
        for at in range(self.at, base + len(tail) - (0 if last else longest)):
            node, o = nodes.get(at), at - base
            if node is None:
                continue
            _, arc, total, follows = node
            single, key = False, arc << 32
            for n in range(1, min(longest, len(tail) - o) + 1):
                piece = arcs.get(tail[o : o + n])
                if piece is None:
                    break
                if piece < 0:
                    continue
                single |= n == 1
                if bpe:
                    agreed = arc < 0 or pairs.get(key | piece)
                    if agreed is None:
                        agreed = self.agrees(arc, piece)
                    if agreed:
                        nodes[at + n] = [at, piece, 0.0, []]
                        follows.append(at + n)
                else:
                    self.better(at, at + n, piece, total + score[piece])
            if not single:
                self.better(at, at + 1, -1 - ord(tail[o]), total + self.p.lowest - 10)
            if not follows:
                self.forget(at)
            root = self.root
            while root <= at and len(nodes[root][3]) == 1:
                root = nodes.pop(root)[3][0]
                self.spell(nodes[root][1], out)
            self.root = root
        self.at = max(self.at, base + len(tail) - (0 if last else longest))
        self.tail, self.tail_at = tail[self.at - base :], self.at
        return out

    def better(self, start: int, end: int, arc: int, total: float) -> None:
        """Keeps the arc from start to end where it is the first or scores more; the older path dies."""
        there = self.nodes.get(end)
        if there is None:
            self.nodes[end] = [start, arc, total, []]
        elif total > there[2]:
            old = there[0]
            there[:3] = [start, arc, total]
            self.nodes[old][3].remove(end)
            if old < start:
                self.forget(old)
        else:
            return
        self.nodes[start][3].append(end)

    def forget(self, at: int) -> None:
        """Drops a boundary that no path leaves, and those before it that only led there."""
        while at != self.root and not self.nodes[at][3]:
            before = self.nodes.pop(at)[0]
            self.nodes[before][3].remove(at)
            at = before

    def spell(self, arc: int, out: list[int]) -> None:
        if arc >= 0:
            out.append(arc)
        else:
            out += self.p.spelling(arc)

    def finish(self) -> list[int]:
        out = self.feed("", last=True)
        end, arcs = self.at, []
        while end != self.root:
            arcs.append(self.nodes[end][1])
            end = self.nodes[end][0]
        for arc in reversed(arcs):
            self.spell(arc, out)
        self.reset()
        return out

    def whole(self, text: str) -> list[int]:
        if len(text) <= self.p.longest and self.p.kind == "bpe":
            return self.in_window(text)
        self.tail = text
        return self.finish()

    def in_window(self, text: str) -> list[int]:
        """Ids of a text no longer than the window, which holds all its boundaries until the end."""
        arcs, pairs, n = self.p.arcs, self.pairs, len(text)
        back, taken = [0] * (n + 1), [None] * (n + 1)
        taken[0] = -1
        for at in range(n):
            arc = taken[at]
            if arc is None:
                continue
            single, key = False, arc << 32
            for end in range(at + 1, n + 1):
                piece = arcs.get(text[at:end])
                if piece is None:
                    break
                if piece < 0:
                    continue
                single |= end == at + 1
                agreed = arc < 0 or pairs.get(key | piece)
                if agreed is None:
                    agreed = self.agrees(arc, piece)
                if agreed:
                    back[end], taken[end] = at, piece
            if not single:
                back[at + 1], taken[at + 1] = at, -1 - ord(text[at])
        found, out = [], []
        while n:
            found.append(taken[n])
            n = back[n]
        for arc in reversed(found):
            self.spell(arc, out)
        return out


class Codec:
    """Encoding and decoding of whole texts."""

    def __init__(self, path: str, kind: str = "bpe"):
        self.p = Pieces(path, kind)
        self.search = Search(self.p)
        self.lanes = Lanes(self.p) if kind == "bpe" and self.p.word_bound else None
        self.run_ids = lru_cache(4096)(lambda n: self._runs(n))
        marks = re.escape(MARKS)
        self.words = re.compile(rf"{BLANK}*{self.p.letter}+(?=[{marks}{BLANK}]|\Z)|{BLANK}*[^{BLANK}]+|{BLANK}+").findall
        self.table = [self.p.bytes.get(i, b"") for i in range(max(self.p.bytes) + 1)]

    def normalized(self, text: str) -> str:
        if not self.p.same:
            return self.p.normalize(text)
        return BLANK + text.replace(" ", BLANK) if text else ""

    def _runs(self, n: int) -> list[int]:
        """Ids of n blanks, whose pieces have equal scores, so that pairs don't tell the path."""
        return [self.p.ids[x] for x in self.p.merged(BLANK * n)]

    def word(self, word: str) -> list[int]:
        """A word through the stream."""
        blanks = len(word) - len(word.lstrip(BLANK))
        if self.p.kind == "unigram" or blanks < 2:
            return self.search.whole(word)
        # blanks merge with one another last: all but the one that a piece of the word took
        ids = self.search.whole(word[blanks - 1 :])
        lone = ids[0] == self.p.ids[BLANK]
        return self.run_ids(blanks - 1 + lone) + ids[lone:]

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[1].tolist()

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids)."""
        if self.lanes is None:
            made = [self.search.whole(x) if not self.p.word_bound else [i for w in self.words(x) for i in self.word(w)] for x in map(self.normalized, texts)]
            return np.array([len(x) for x in made], np.int64), np.array([i for x in made for i in x], np.int64)
        number: defaultdict[str, int] = defaultdict(count().__next__)
        used, stops = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = self.words(self.normalized(text))
            used.append(np.fromiter(map(number.__getitem__, own), np.int32, len(own)))
            stops[i] = len(own)
        stops = np.cumsum(stops)
        words = list(number)
        size = np.fromiter(map(len, words), np.int64, len(words))
        size[[k for k, w in enumerate(words) if w[:2] == BLANK * 2]] = WIDTHS[-1] + 1
        lens, first, made, total, least = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0, 0
        for width in WIDTHS:
            some = np.flatnonzero((size > least) & (size <= width))
            least = width
            for k in range(0, len(some), LANES):
                part = some[k : k + LANES]
                n, ids = self.lanes.search([words[i] for i in part.tolist()], self.p.agree)
                lens[part], first[part] = n, total + np.cumsum(n) - n
                made.append(ids)
                total += len(ids)
        for k in np.flatnonzero(size > WIDTHS[-1]).tolist():
            ids = np.array(self.word(words[k]), np.int64)
            lens[k], first[k] = len(ids), total
            made.append(ids)
            total += len(ids)
        ids = np.concatenate([np.zeros(0, np.int64), *made])
        at = np.concatenate([np.zeros(0, np.int32), *used])
        wide = lens[at]
        ends = np.cumsum(wide)
        out = ids[np.arange(int(wide.sum())) + np.repeat(first[at] - (ends - wide), wide)]
        return np.diff(np.append(0, ends)[stops], prepend=0), out

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


@lru_cache(1)
def codec(path: str, kind: str) -> Codec:
    return Codec(path, kind)


def encode_documents(docs: DataFrame, model: str, kind: str = "bpe", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids, ids_crc32 (of little-endian 32-bit ids), lossless.

    lossless tells whether decoding the ids gives the text back; only texts that hold the blank's
    own symbol, or that the model normalizes, don't. Null and empty texts have no ids. Rows are
    independent, so repeated identifiers give a row each; other columns of docs are not read.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, kind)
        for b in batches:
            doc_ids, texts, at = b.column(0), b.column(1), 0
            for some in text_slices(texts, CHARS):
                sizes, flat = own.encode_many(some)
                ends = np.append(0, np.cumsum(sizes))
                flat = flat.astype("<i4")
                parts = [flat[a:z] for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                same = [own.decode(x.tolist()) == t for x, t in zip(parts, some, strict=True)]
                crcs = pa.array([zlib.crc32(x) for x in parts], pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([doc_ids.slice(at, len(some)), pa.array(sizes), lists, crcs, pa.array(same, pa.bool_())], names=SCHEMA.names)
                at += len(some)
                some = sizes = flat = ends = parts = same = crcs = lists = None
                release_memory()
            b = doc_ids = texts = None
        release_memory()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(each, SCHEMA)


def decode_documents(encoded: DataFrame, model: str, kind: str = "bpe") -> DataFrame:
    """doc_id and text of rows with doc_id and ids."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, kind)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([own.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(each, "doc_id long, text string")
