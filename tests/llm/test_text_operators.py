import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cellweave.llm import arrow, language_id, piece_viterbi, secret_scan, token_files

from .helpers import docs, rows

WORDS, PIECES = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
ODD = ["", "a§b § c", "<|endoftext|> x <|ENDOFTEXT|>", "İstanbul x y\x1cz", "é ́a", "Don't  it's'S\n\tx", "ΣΑΣ ς.", "a\x85b\x0bc", "日本語 テスト 🙂🙂x", "K§", "١٢٣ 12.5!!", " \n ", "▁ ▁▁x", "a" * 5000, " " * 300 + "x."]


# ---- token files


def test_token_files_hold_the_library_s_ids(spark):
    table = docs(spark, [(len(ODD) - i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (99, None), (100, "tie b"), (100, "tie a")])
    manifest = token_files.write_token_files(table, WORDS, block=64)
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_token_files(manifest).collect()), key=lambda r: r[1])
    tok, start, want = Tokenizer.from_file(WORDS), 0, []
    for i, t in sorted(((r["doc_id"], r["text"] or "") for r in table.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    assert token_files.read_token_files(token_files.write_token_files(table.where("doc_id > 999"), WORDS)).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=300), st.booleans())
def test_planes_round_trip(ids, bits):
    x = np.array(ids, np.uint32)
    assert (token_files.from_planes(token_files.to_planes(x, bits), len(x), bits) == x).all()


@pytest.mark.parametrize("bits", [False, True])
def test_file_round_trip(tmp_path, bits):
    from pyarrow import fs

    rng, store = np.random.default_rng(1), fs.LocalFileSystem()
    counts = rng.integers(0, 700, 40)
    ids = rng.integers(0, 49408, counts.sum()).astype(np.uint32)
    with store.open_output_stream(str(tmp_path / "x")) as out:
        w, at = token_files.Writer(out, 256, bits), 0
        for k in range(0, 40, 8):
            n = int(counts[k : k + 8].sum())
            w.add([None if i == 3 else i for i in range(k, k + 8)], counts[k : k + 8], ids[at : at + n])
            at += n
        w.close()
    with store.open_input_file(str(tmp_path / "x")) as f:
        r = token_files.Reader(f, f.size())
        assert np.concatenate([p for d in r.documents() for p in d]).tolist() == ids.tolist()
        assert r.counts.tolist() == counts.tolist() and r.nulls.tolist() == [i == 3 for i in range(40)]
        assert r.chunk(2).tolist() == ids[512:768].tolist()
        with pytest.raises(ValueError):
            token_files.Reader(f, f.size() - 1)


def test_full_word_store_drops_its_later_half(monkeypatch):
    monkeypatch.setattr(token_files, "KEPT_WORDS", 2)
    e = token_files.WordEncoder(WORDS, 1)
    for _ in range(3):
        counts, ids = e(["one two three", "four"])
        assert ids.tolist() == e.encode("one two three") + [1] + e.encode("four") + [1] and counts.tolist() == [4, 2]


# ---- pieces


@pytest.fixture(scope="module")
def codec():
    return piece_viterbi.Codec(PIECES)


def test_pieces_match_the_library(codec):
    sp = SentencePieceProcessor(model_file=PIECES)
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist() + ODD
    assert [codec.encode(t or "") for t in texts] == sp.encode([t or "" for t in texts])


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab the ing  \n\té日🙂\x00.=1A▁—_-x,;²"), max_size=60))
def test_any_text_matches_the_library(codec, text):
    sp = SentencePieceProcessor(model_file=PIECES)
    ids = codec.encode(text)
    assert ids == sp.encode(text)
    if "▁" not in text:
        assert codec.decode(ids) == text


def test_search_commits_within_the_window(codec):
    text, search = "thequickbrownfoxjumps" * 40, piece_viterbi.Search(codec.p)
    out, most = [], 0
    for k in range(0, len(text), 7):
        out += search.feed(text[k : k + 7])
        most = max(most, len(search.nodes))
    assert out + search.finish() == codec.search.whole(text) and most < 60
    assert search.in_window("thequick") == search.feed("thequick") + search.finish()


def test_short_texts_in_the_window_are_as_in_the_stream(codec):
    stream = piece_viterbi.Search(codec.p)
    for text in ["", "a", "▁the", "▁▁▁a", "é🙂x", "\x00\x00", "qwzx▁k", *list(codec.p.ids)[::4000]]:
        assert len(text) <= codec.p.longest and codec.search.in_window(text) == codec.search.whole(text) == stream.feed(text) + stream.finish()


def test_unigram_search_is_the_best_path(codec):
    class Model:
        kind, byte_ids, unknown, longest, lowest = "unigram", {}, 0, 3, -6.0
        ids = {"a": 1, "b": 2, "ab": 3, "ba": 4, "aba": 5, "c": 6}
        score = {1: -2.0, 2: -2.5, 3: -3.0, 4: -2.0, 5: -6.0, 6: -1.0}
        arcs = {p[:k]: -1 for p in ids for k in range(1, len(p))} | ids

    def best(text):
        found = {0: (0.0, [])}
        for i in range(len(text)):
            for p, k in Model.ids.items():
                if i in found and text.startswith(p, i):
                    s = found[i][0] + Model.score[k]
                    if i + len(p) not in found or s > found[i + len(p)][0]:
                        found[i + len(p)] = (s, found[i][1] + [k])
        return found[len(text)]

    random.seed(2)
    for _ in range(200):
        text = "".join(random.choice("abc") for _ in range(random.randint(1, 30)))
        ids = piece_viterbi.Search(Model).whole(text)
        names = {v: k for k, v in Model.ids.items()}
        assert "".join(names[i] for i in ids) == text and abs(sum(Model.score[i] for i in ids) - best(text)[0]) < 1e-9


def test_piece_documents(spark):
    table = docs(spark, [(i, t) for i, t in enumerate(ODD)] + [(None, None), (1, "again")])
    out = piece_viterbi.encode_documents(table, PIECES)
    got = {(r["doc_id"], r["n_tokens"]): r for r in out.collect()}
    sp = SentencePieceProcessor(model_file=PIECES)
    assert len(got) == len(ODD) + 2 and got[(None, 0)]["ids"] == []
    for i, t in enumerate(ODD):
        r = got[(i, len(sp.encode(t)))]
        assert r["ids"] == sp.encode(t) and r["lossless"] == ("▁" not in t) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    back = {r["doc_id"]: r["text"] for r in piece_viterbi.decode_documents(out.where("doc_id = 8"), PIECES).collect()}
    assert back == {8: ODD[8]}
    assert piece_viterbi.encode_documents(table.where("doc_id > 999"), PIECES).count() == 0


# ---- languages


def test_languages_on_held_out_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language_id.fit(table, per_language=200)
    out = language_id.predict_documents(table, model).join(table.select("doc_id", "lang"), "doc_id").toPandas()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    held = out[out.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97 and held.accepted.mean() > 0.99 and held.score.between(0, 1).all()


def test_language_edges(spark):
    table = docs(spark, [(i, w * 30, "a", lang) for i, (w, lang) in enumerate([("the house ", "en"), ("le chat noir ", "fr"), ("der hund und ", "de")] * 30)])
    model = language_id.fit(table)
    odd = docs(spark, [(1, None), (2, ""), (3, "123 .."), (None, "the house"), (5, "the house " * 100_000), (5, "le chat noir ")])
    got = rows(language_id.predict_documents(odd, model), "doc_id", "lang_pred", "accepted")
    assert got == sorted([(1, "und", False), (2, "und", False), (3, "und", False), (None, "en", True), (5, "en", True), (5, "fr", True)], key=str)
    kept = language_id.accepted_documents(odd, model)
    assert kept.columns == odd.columns and kept.count() == 3
    none = language_id.fit(odd.where("doc_id > 99"))
    assert {r["lang_pred"] for r in language_id.predict_documents(odd, none).collect()} == {"und"}
    assert language_id.predict_documents(odd.where("doc_id > 99"), model).count() == 0


def test_long_texts_in_pieces_score_alike(monkeypatch):
    model = language_id.train([(i, t, t[:1]) for i, t in enumerate(["aaa bab cab " * 9, "xyx yzy zxz " * 9] * 20)])
    whole = model.logits([language_id.letters("aab xyz " * 50)])
    monkeypatch.setattr(language_id, "CHUNK", 37)
    assert np.allclose(model.logits([language_id.letters("aab xyz " * 50)]), whole)


# ---- secrets

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base(text):
    out = [(m.start(), m.end(), "assign") for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24], key=lambda x: (x[0], ("assign", "access", "hex").index(x[2])))


PARTS = ["token", "TOKEN=", "secret: ", "api_key='", "apikey", "passwd", "password = ", "abc123", "AKIA", "ABCDEFGHIJ123456", "0123456789abcdef" * 2, "=", ":", '"', " ", "é", "İ", "K", "ſecret=abcdefgh", "x.y-z/", "\n", "ghp_", "deadbeef"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_base_secrets_match_the_patterns(parts):
    text = "".join(parts)
    assert [x for x in secret_scan.find_secrets(text) if x[2] in ("assign", "access", "hex")] == base(text)


def github(body, head="ghp_"):
    value, tail = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, k = divmod(value, 62)
        tail = secret_scan.BASE62[k] + tail
    return head + body + tail


def test_checksums_decide(spark):
    good, bad = github("A" * 30), "ghp_" + "A" * 36
    assert [x[2] for x in secret_scan.find_secrets(f"x {good} {bad} {github('Z' * 30, 'npm_')}")] == ["github", "npm"]
    got = {r["doc_id"]: r for r in secret_scan.scan_documents(docs(spark, [(1, "é token=abcdef9 " + good), (2, None), (None, "")])).collect()}
    assert got[1]["spans"] == "assign:2:15,github:16:56" and got[1]["n_assign"] == 1
    assert got[1]["base_sha256"] == hashlib.sha256(b"assign:2:15").hexdigest() and got[2]["spans"] == "" and got[None]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_foreign_and_random_texts_go(spark):
    table = [r.asDict() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()]
    table = [r for r in table if r["lang"] and r["text"] and language_id.LETTER.search(r["text"])]
    held = [r for r in table if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    rng = random.Random(3)
    noise = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 10))) for _ in range(80)) for _ in range(100)]
    langs = sorted({r["lang"] for r in table})
    for known in (langs, langs[:-1], langs[:2]):
        model = language_id.train([(r["doc_id"], r["text"], r["lang"]) for r in table if r["lang"] in known and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2])
        share = lambda texts: np.mean(model.predict(texts)[2])
        by = [[r["text"][:600] for r in held if r["lang"] == x] for x in known[:2]]
        assert share([r["text"] for r in held if r["lang"] in known]) > 0.99
        assert share([f"{a} {b}" for a, b in zip(*by)]) > 0.9
        assert share(noise) < 0.05
        if known != langs:
            assert share([r["text"] for r in table if r["lang"] not in known]) < 0.1


def test_language_scores_match_a_loop_over_subwords():
    rows = [(i, t, l) for i, (t, l) in enumerate([("the cat sat on the mat", "en"), ("die katze lag auf der matte", "de"), ("le chat est sur le tapis", "fr")] * 30)]
    model = language_id.train(rows)

    def score(text):
        raw, marks = language_id.letters(text), []
        for n in language_id.GRAMS:
            for k in range(len(raw) - n + 1):
                gram, h = raw[k : k + n], 0
                if b" " in gram[1:-1] or (n == 2 and gram == b"  "):
                    continue
                for c in gram:
                    h = (h * 0x01000193 + c) & 0xFFFFFFFF
                marks.append(((h * 0x9E3779B1 & 0xFFFFFFFF) >> 16) % language_id.BUCKETS)
        z = (np.mean([model.scores[m].astype(float) for m in marks], axis=0) + model.bias) / model.temperature
        p = np.exp(z - z.max())
        return model.langs[int(p.argmax())], float(p.max() / p.sum())

    texts = ["the mat", "Katze auf der Matte!", "le tapis", "x", "cat " * 3000, "ünï chat 12"]
    lang, found, _ = model.predict(texts)
    for text, l, s in zip(texts, lang, found):
        assert l == score(text)[0] and abs(s - score(text)[1]) < 1e-4
    assert model.predict(["", "12 !"])[0] == ["und", "und"]


def test_ordinary_words_keep_no_pairs_for_the_stream(codec):
    own = piece_viterbi.Codec(PIECES)
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    words = [" ".join(w for w in (t or "").split() if len(w) < 16) for t in texts]
    assert own.encode_many(words)[1].tolist() == codec.encode_many(words)[1].tolist()
    assert own.lanes.pairs.size > 1000 and len(own.search.pairs) < 100


def test_encoding_holds_few_texts_at_once(codec):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    want = codec.encode_many([t or "" for t in texts])[1].tolist()
    tracemalloc.start()
    got = []
    for some in arrow.text_slices(pa.array([t or "" for t in texts] * 3), piece_viterbi.CHARS):
        got.append(codec.encode_many(some)[1].astype("<i4"))
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert np.concatenate(got).tolist() == want * 3 and most < 50


class FewTexts:
    """Accepts texts that start with a; refuses many at once."""

    def predict(self, texts):
        assert sum(map(len, texts)) < 2 << 20
        return [], [], [t[:1] == "a" for t in texts]


def test_languages_are_judged_on_few_texts_at_once(spark):
    table = spark.createDataFrame([(i, None if i % 7 == 0 else "ab"[i % 2] * 10_000) for i in range(700)], "doc_id long, text string").coalesce(1)
    got = sorted(r["doc_id"] for r in language_id.accepted_documents(table, FewTexts()).select("doc_id").collect())
    assert got == [i for i in range(700) if i % 7 and i % 2 == 0]
