"""Fingerprints, tokens, languages and language model against plain versions."""

from __future__ import annotations

import math
import resource
import sys
import tracemalloc
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlens.llm import (
    language_spans, ngram_trie, odd_minhash, order_minhash, sentencepiece_bpe, substring_dedup, worker_cache,
)
from tests.llm.rows import awkward, frame

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abehint rs  \n\té日😀▁0123①")), max_size=60))
def test_backtracking_equals_library(text):
    own = sentencepiece_bpe.model(open(PATH, "rb").read())
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = np.frombuffer(own.encode(text), np.int32)
    assert ids.tolist() == lib.encode(text)
    assert own.decode(ids) == lib.decode(lib.encode(text))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aÀßжЧ一个ال²─09.,;()-]^\\[&~#|\"'\r\n\u0000 😀▁")), max_size=40))
def test_groups_of_characters_equal_library(text):
    own = sentencepiece_bpe.model(open(PATH, "rb").read())
    assert np.frombuffer(own.encode(text), np.int32).tolist() == sentencepiece.SentencePieceProcessor(model_file=PATH).encode(text)


def counted(model, monkeypatch):
    """Texts that a model backtracks over from now on."""
    done = []
    inner = model.backtracked
    monkeypatch.setattr(model, "backtracked", lambda text: done.append(text) or inner(text))
    return done


def test_words_are_encoded_once_whatever_follows_them(library, monkeypatch):
    own = sentencepiece_bpe.Model(open(PATH, "rb").read())
    done = counted(own, monkeypatch)
    text = " ".join(f"wort{chr(97 + i)}{end}" for end in (".", ",", "###", ";", ")", "!?") for i in range(20))
    assert np.frombuffer(own.encode(text), np.int32).tolist() == library.encode(text)
    assert len(done) == 20 + 6


def test_frequent_words_outlive_a_full_memory(library, monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "REMEMBERED", 100 * 250)
    own = sentencepiece_bpe.Model(open(PATH, "rb").read())
    done = counted(own, monkeypatch)
    for i in range(100):
        text = "und " + " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j)}" for j in range(10))
        assert np.frombuffer(own.encode(text), np.int32).tolist() == library.encode(text)
    assert len(done) > 1000 and done.count("▁und") == 1
    assert sentencepiece_bpe.ENTRY * (len(own.seen) + len(own.older)) < 100 * 300


def test_encode_and_decode_awkward_rows(spark, library):
    docs = frame(spark).withColumn("ids", F.lit("clash"))
    together = {(r.doc_id, r.text): r for r in sentencepiece_bpe.round_trip(docs, PATH).collect()}
    apart = sentencepiece_bpe.decode(sentencepiece_bpe.encode(docs, PATH), PATH).collect()
    assert len(apart) == len(awkward())
    for r in apart:
        want = library.encode(r.text) if r.text else []
        assert r.ids == want and r.decoded == (library.decode(want) if want else "")
        assert together[r.doc_id, r.text].ids == want and together[r.doc_id, r.text].decoded == r.decoded
    assert sentencepiece_bpe.round_trip(frame(spark, []), PATH).count() == 0


def plain_signature(text, k, vectors, size, hashed):
    """Tuple hashes by the definition; ``hashed`` chains values into a 64-bit hash as Spark does."""
    words = (text or "").replace("\x0b", " ").split()
    if not words:
        return []
    runs = [tuple(words[i:i + k]) + (None,) * (k - len(words[i:i + k])) for i in range(max(len(words) - k, 0) + 1)]
    seen, numbered = Counter(), []
    low = (1 << 33) - 1
    for i, run in enumerate(runs):
        n = seen[run]
        seen[run] += 1
        h = hashed(list(run)) & low
        numbered.append((h if n == 0 else hashed([h, n]) & low, i))
    parts = {}
    for h, i in sorted(numbered):
        own = parts.setdefault(h >> (33 - vectors.bit_length() + 1), [])
        if len(own) < size:
            own.append((i, h))
    out = []
    for part, own in parts.items():
        total = 0
        for _, h in sorted(own):
            total = hashed([total, h])
        out.append((part << 32) + (total & 0xFFFFFFFF))
    return out


@pytest.mark.parametrize("k,vectors,size", [(2, 64, 2), (3, 8, 3), (1, 4, 1)])
def test_order_minhash_equals_definition(spark, k, vectors, size):
    texts = ["", "one", "b a b a b a b", "the the the the the the the the the", "to be or not to be or not to be that",
             "  x  y\tz\n", " ".join(f"v{i % 37} u{i % 11}" for i in range(300))]
    got = {r.text: r.sig for r in order_minhash.with_signature(
        spark.createDataFrame([(t,) for t in texts], "text string"), "text", "sig", k, vectors, size).collect()}

    def hashed(values):
        seed = 42
        for v in values:
            if v is not None:
                raw = v.encode() if isinstance(v, str) else (v & (1 << 64) - 1).to_bytes(8, "little")
                seed = xxhash.xxh64(raw, seed).intdigest()
        return seed

    for t in texts:
        assert got[t] == plain_signature(t, k, vectors, size, hashed), t
    assert got[""] == [] and len(got["one"]) == 1


def test_fingerprints_awkward_rows(spark):
    rows = awkward()
    got = order_minhash.fingerprints(frame(spark), bucket_docs=3).select(
        "*", order_minhash.likeness("signature", "edited_signature").alias("near"),
        order_minhash.likeness("signature", "next_signature").alias("next")).collect()
    assert len(got) == len(rows)
    keyed = sorted([(r[0], r[1] or "") for r in rows if r[0] is not None], key=lambda x: x[0])
    texts = {k: t for k, t in keyed}
    ids = sorted(texts)
    by_text = {}
    for r in got:
        assert 0 <= r.near <= 1 and 0 <= r.next <= 1
        if r.doc_id is None:
            continue
        own = texts[r.doc_id]
        follow = own if sum(k == r.doc_id for k, _ in keyed) > 1 else texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        half = len(own) // 2
        assert r.n_chars == len(own)
        if sum(k == r.doc_id for k, _ in keyed) == 1:
            assert r.edited == own[:len(own) - half] + follow[:half]
        assert by_text.setdefault(own, r.signature) == r.signature
    assert order_minhash.fingerprints(frame(spark, [])).count() == 0
    single = order_minhash.fingerprints(frame(spark, rows[5:6])).first()
    assert single.signature == single.next_signature


def test_order_changes_the_signature(spark):
    words = [f"w{i}" for i in range(200)]
    swapped = words[100:] + words[:100]
    sig = order_minhash.with_signature(spark.createDataFrame(
        [(0, " ".join(words)), (1, " ".join(swapped)), (2, " ".join(words[:190] + ["new"] * 10))], "i int, text string"),
        "text", "s").orderBy("i").collect()
    same = [len(set(sig[0].s) & set(s.s)) / len(set(sig[0].s) | set(s.s)) for s in sig]
    assert same[0] == 1 and same[1] < 0.9 and same[2] > 0.5


def plain_viterbi(scores, penalty):
    best, back = list(scores[0]), []
    for row in scores[1:]:
        top = int(np.argmax(best))
        back.append([j if best[j] >= best[top] - penalty else top for j in range(len(row))])
        best = [max(best[j], best[top] - penalty) + row[j] for j in range(len(row))]
    path = [int(np.argmax(best))]
    for b in reversed(back):
        path.append(b[path[-1]])
    return path[::-1]


def test_viterbi_equals_plain_version():
    rng = np.random.default_rng(1)
    lengths = np.array([5, 0, 40, 1, 17])
    scores = rng.integers(-20, 1, (lengths.sum(), 3)).astype(np.float32)
    got = language_spans.viterbi(scores, lengths, 9.0)
    at = 0
    for n in lengths:
        if n:
            assert got[at:at + n].tolist() == plain_viterbi(scores[at:at + n], 9.0)
        at += n


def test_features_equal_plain_version():
    words = ["a", "ab", "été", "αθήνα", "日本語", "дaб", "aд", "дa", "\U00020000\U0002f800", "ss" * 400]
    starts = [start for start, _ in language_spans.SCRIPT_RANGES]
    buckets, begins, scripts = language_spans.features(words)
    for word, begin, end, script in zip(words, begins, [*begins[1:], len(buckets)], scripts):
        marked = f"_{word}_"
        assert buckets[begin:end].tolist() == [
            zlib.crc32(marked[i:i + n].encode("utf-32-le")) % language_spans.BUCKETS
            for n in (2, 3, 4) for i in range(len(marked) - n + 1)]
        own = [language_spans.SCRIPTS.index(language_spans.SCRIPT_RANGES[bisect_right(starts, ord(c)) - 1][1]) for c in word]
        assert script == max(set(own), key=lambda s: (own.count(s), -s))


def test_few_python_calls_for_a_new_word():
    counts = np.ones((2, language_spans.BUCKETS + len(language_spans.SCRIPTS)), np.int64)
    model = language_spans.Model(["a", "b"], counts)
    model.scores(["warm"])
    words = [f"wort{chr(97 + i % 26)}{'xyz' * (i % 9)}{chr(97 + i // 26)}" for i in range(500)]
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        model.scores(words)
    finally:
        sys.setprofile(None)
    # Hashing the n-grams one by one takes over 20.
    assert calls["call"] + calls["c_call"] < 10 * len(words)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    fitted = language_spans.fit(docs.where(~held), F.col("doc_id"))
    got = language_spans.label(docs.where(held), fitted).select("lang", "language").collect()
    assert np.mean([r.lang == r.language.lang for r in got]) > 0.95


def test_language_edges(spark):
    fitted = language_spans.fit(spark.createDataFrame(
        [(0, "the cat and the dog sat with their mothers", "en"), (1, "der Hund und die Katze sassen mit ihren Müttern", "de"),
         (2, "Собака и кошка сидели вместе", "ru"), (3, None, "en"), (4, "text", None)], "id int, text string, lang string"),
        F.col("id"))
    assert fitted[0] == ["de", "en", "ru"]
    texts = [None, "", "12 34 --", "кошка", "the cat and the dog sat der Hund und die Katze sassen mit", "the " * 5000]
    got = [r.language for r in language_spans.label(
        spark.createDataFrame([(t, "clash") for t in texts], "text string, language string"), fitted).collect()]
    assert [g.lang for g in got[:4]] == ["und", "und", "und", "ru"] and got[0].score == 0 and got[0].spans == []
    assert [s.lang for s in got[4].spans] == ["en", "de"]
    assert got[5].lang == "en" and got[5].score == 1
    none = language_spans.fit(spark.createDataFrame([], "id int, text string, lang string"), F.col("id"))
    assert language_spans.label(frame(spark), none).where("language.lang <> 'und'").count() == 0


def test_elias_fano_and_trie(tmp_path):
    rng = np.random.default_rng(3)
    for n, top in [(1, 1), (9, 9), (700, 5000), (400, 10**14)]:
        values = np.unique(rng.integers(0, top, n)).astype(np.uint64)
        seq = ngram_trie.EliasFano.of(values)
        assert (seq.get(np.arange(len(values))) == values).all()
        asked = np.concatenate([values, rng.integers(0, top + 5, 300).astype(np.uint64)])
        place = {int(v): i for i, v in enumerate(values)}
        assert seq.find(asked).tolist() == [place.get(int(a), -1) for a in asked]
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 60, (900, 2))})
    c, w = (np.array(x, np.uint64) * np.uint64(10**15) for x in zip(*pairs))
    share = rng.random(len(pairs)) * 0.9 + 1e-6
    trie = ngram_trie.Trie.build(c, w, share)
    trie.save(tmp_path / "trie")
    again = ngram_trie.Trie.open(tmp_path / "trie")
    grid = np.array([(a, b) for a in range(60) for b in range(60)], np.uint64) * np.uint64(10**15)
    codes = again.look_up(grid[:, 0], grid[:, 1])
    known = {p: s for p, s in zip(pairs, share)}
    for (a, b), code in zip((grid // np.uint64(10**15)).tolist(), codes):
        assert (code > 0) == ((a, b) in known)
        if code:
            assert ngram_trie.shares(np.array([code]))[0] == pytest.approx(known[a, b], rel=1e-3)


@pytest.mark.parametrize("hot", [None, 3])
def test_language_model_equals_plain_version(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(ngram_trie, "HOT", hot)
    rows = [r for r in awkward() if r[0] is not None]
    low = [bytes(b + 32 if 65 <= b <= 90 else b for b in (r[1] or "").encode()).split() + [b" end"] for r in rows]
    learned = [zlib.crc32(str(r[0]).encode()) % 7 != 2 for r in rows]
    count, pairs = Counter(), Counter()
    for ws, use in zip(low, learned):
        if use:
            count.update(ws)
            pairs.update(zip([b" start", *ws], ws))
    n, v, prior = sum(count.values()), len(count), ngram_trie.PRIOR
    count_of = {**count, b" start": sum(learned)}
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = ngram_trie.score(frame(spark, rows), held, chunk_docs=4).collect()
    assert len(got) == len(rows)
    for r in got:
        ws = low[[x[0] for x in rows].index(r.doc_id)]
        plain = [(count[w] + 1) / (n + v + 1) for w in ws]
        score = sum(math.log10((pairs[a, w] + prior * p) / (count_of.get(a, 0) + prior))
                    for a, w, p in zip([b" start", *ws], ws, plain))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(map(math.log10, plain)), rel=1e-9)
        assert r.score == pytest.approx(score, rel=1e-4)
    assert ngram_trie.score(frame(spark, []), held).count() == 0


def test_model_beats_word_counts_on_held_out_text(spark):
    from flowlens.llm.queries import QUERIES
    got = QUERIES["op6_ngram_trie"](spark, "/root/testdata/sf0.01").where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def resident() -> int:
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * resource.getpagesize()


def test_what_a_task_has_freed_goes_back_to_the_system():
    pins = []

    def work(batches):
        for _ in batches:
            some = [b"x" * 100_000 for _ in range(2000)]
            pins.append(some[-1])  # lies behind the others, so that the C library alone gives nothing back
            del some
            yield resident()

    list(work([1]))
    begun = resident()
    list(worker_cache.tidy(work)([1]))
    assert resident() < begun - 100e6
    assert worker_cache.tidy_group(lambda key, table: len(table))(1, pins) == len(pins)
    assert resident() < begun - 100e6


def test_workers_of_the_pipeline_give_back_after_each_batch(spark, monkeypatch):
    given_back, functions = [], []
    monkeypatch.setattr(worker_cache, "give_back", lambda: given_back.append(1))
    docs = frame(spark).select("doc_id", "text", "lang")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, work, schema: functions.append(work) or self)
    sentencepiece_bpe.round_trip(docs, PATH)
    language_spans.label(docs, (["de"], np.ones((1, language_spans.BUCKETS + len(language_spans.SCRIPTS)), np.int64)))
    odd_minhash.signatures(docs, "doc_id", "text", 5, 32, 5)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["ein text", "noch ein text"], "lang": ["de", None]})
    for work in (*functions, language_spans._counts):
        given_back.clear()
        out = list(work([batch.slice(0, 1), batch]))
        assert len(given_back) == len(out) + 1
    assert len(functions) == 3
    given_back.clear()
    sent = pa.table({"chunk": [0, 1], "part": [0, 0], "kind": [0, 0], "data": [np.array(x, np.uint64).tobytes() for x in ([1, 2], [2])]})
    assert substring_dedup._shared_names(sent).column("data").to_pylist() == [b"\x00\x01", b"\x01"]
    assert len(given_back) == 1


def test_repeated_words_of_a_block_are_held_once():
    model = language_spans.Model(["de"], np.ones((1, language_spans.BUCKETS + len(language_spans.SCRIPTS)), np.int64))
    text = " ".join(f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500))
    language_spans.label_texts(model, [text], 9.0)
    tracemalloc.start()
    langs, shares, spans = language_spans.label_texts(model, (text for _ in range(600)), 9.0)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert langs == ["de"] * 600 and shares == [1.0] * 600
    assert spans == [[{"first": 0, "last": 499, "lang": "de"}]] * 600
    assert most < 14e6  # 300 000 words take over 17 MB as strings
