"""Turn repair, spelling variants and packing against plain versions."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowlens.llm import spelling_tiles, swap_packing, turn_repair
from tests.llm.rows import awkward, frame

AHEAD = {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def cheapest(turns):
    """(cost, letters) by best-first search; turns are (role initial, fault)."""
    heap, seen = [(0, "", 0, 0)], set()
    while True:
        cost, letters, i, state = heapq.heappop(heap)
        if i == len(turns) and state in (0, 3):
            return cost, letters
        if (i, state) in seen:
            continue
        seen.add((i, state))
        heapq.heappush(heap, (cost + 2, letters + "I", i, AHEAD[state]))
        if i < len(turns):
            initial, fault = turns[i]
            heapq.heappush(heap, (cost + 3, letters + "D", i + 1, state))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + more, letters + "R", i + 1, AHEAD[state]))
                if (initial, state) in KEPT:
                    heapq.heappush(heap, (cost + more, letters + "K", i + 1, KEPT[initial, state]))


def plain_repair(rows):
    """All measures of one conversation of (turn, role, text)."""
    rows = sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip("\x20\t\n\r\v\f")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    cost, audit = cheapest([(r[1][:1], f) for r, f in zip(rows, faults)])
    state, at, lines = 0, 0, []
    for letter in audit:
        if letter in "IR":
            lines.append(("assistant" if state == 2 else "user") + ":" + ("" if letter == "I" else rows[at][2]))
            state = AHEAD[state]
        elif letter == "K":
            lines.append(f"{rows[at][1]}:{rows[at][2]}")
            state = KEPT[rows[at][1][:1], state]
        at += letter != "I"
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    n = Counter(faults)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 8), min_size=1, max_size=14), st.lists(st.integers(1, 13), max_size=4))
def test_divide_and_conquer_equals_search(kinds, cuts):
    """Blocks of any lengths give the same edits, ties included."""
    faults = ["duplicate" if k == 8 else "truncated" if k > 3 else None for k in kinds]
    want = cheapest([("" if k == 8 else "sua?"[k % 4], f) for k, f in zip(kinds, faults)])
    cuts = np.array(sorted({0, len(kinds), *(c for c in cuts if c < len(kinds))}))
    kinds = np.array(kinds)
    states, cost = turn_repair.edge_states(*turn_repair.tables(kinds, cuts))
    before = turn_repair.solve(kinds, cuts, np.array(states[:-1]), np.array(states[1:]))
    after = np.append(before[1:], 0)
    after[cuts[1:] - 1] = states[1:]
    letters = "".join(turn_repair.LETTERS[k][a][b] for k, a, b in zip(kinds, before, after)) + turn_repair.END[states[-1]]
    assert (cost, letters) == want


TURNS = "conv_id long, turn long, role string, text string, at string, block int, key string"


def talk(seed=3):
    rng = random.Random(seed)
    texts = [None, "", " \n", "Yes.", "No!", "cut off", "Why? ", "end.\x0b", "日本。", "dots…"]
    rows = [(c, rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", "tool", "", None, "ü"]), rng.choice(texts))
            for c in (None, 1, 2, 3, 5, 8, 13) for _ in range(rng.randrange(1, 14))]
    rows += [(21, 1, "user", "again.")] * 40 + [(34, 0, "user", ""), (55, None, "user", "x" * 300_000 + ".")]
    rows += [(89, i, "ua"[i % 2] + "x", f"turn {i}" + ".!"[i % 3 == 0] * (i % 7 > 0)) for i in range(2500)]
    return [(*r, "clash", 7, "clash") for r in rows]


def test_repair_of_awkward_conversations(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "BLOCK_BITS", 4)  # many blocks in a conversation
    df = spark.createDataFrame(talk(), TURNS)
    edited = turn_repair.repair(turn_repair.records(df)).cache()
    measures = {r.key: r for r in turn_repair.measures(edited).collect()}
    digests = {r.key: r for r in turn_repair.digests(edited).collect()}
    turns = defaultdict(list)
    for r in turn_repair.repaired_turns(edited).orderBy("at", "place").collect():
        turns[r.key].append(f"{r.role}:{r.text}")
    groups = defaultdict(list)
    for c, t, r, x, *_ in talk():
        groups[c].append((t, r, x))
    assert measures.keys() == digests.keys() == groups.keys()
    for c, rows in groups.items():
        m, d = measures[c], digests[c]
        got = (m.gaps, m.blank, m.duplicate, m.truncated, d.illegal, m.cost, d.audit, d.digest, turns[c])
        assert got == plain_repair(rows), c


def test_repair_of_nothing(spark):
    edited = turn_repair.repair(turn_repair.records(spark.createDataFrame([], TURNS)))
    assert edited.count() == turn_repair.digests(edited).count() == turn_repair.measures(edited).count() == 0


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abÿ", min_size=1, max_size=7), min_size=2, max_size=30))
def test_tiles_find_single_edits(words):
    words = sorted(words)
    left, right = spelling_tiles.matrices(words, max(map(len, words)))
    lengths = np.array([len(w) for w in words])
    every = slice(0, len(words))
    near, at = spelling_tiles.tile(left, right, lengths, every, every)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert near[i, j] == one_edit(a, b)
            if near[i, j]:
                assert 0 <= at[i, j] < max(len(a), len(b))


@pytest.mark.parametrize("limit", [2, 9, 2048])
def test_variants_equal_all_pairs(spark, limit):
    """Buckets cut down to single positions, and buckets left whole, lose no pair and count none twice."""
    rng = random.Random(limit)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randrange(4, 8))) for _ in range(500)} | {"z" * 400, "z" * 401})
    counts = {w: rng.choice([3, 3, 4, 6, 12, 50, 50, 1000]) for w in words}
    got = {r.word: r for r in spelling_tiles.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), limit).collect()}
    assert got.keys() == counts.keys()
    form = {}
    for w in words:
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x)) if near else None
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
        assert got[w].n_near == len(near) and got[w].form == form[w] and got[w].n == counts[w]
        assert got[w].form_n == (counts[form[w]] if form[w] else None)
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        assert got[w].root == root


def test_vocabulary_of_awkward_rows(spark):
    rows = awkward() + [(200 + i, "Étude étude ÉTUDE Maß×÷ naïve coöperate co-operate", None, None, None, None, None, None, None) for i in range(300)]
    want = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            want[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    got = {r.word: r.n for r in spelling_tiles.vocabulary(frame(spark, rows), damage=97).collect()}
    assert got == {w: n for w, n in want.items() if n >= 3 and len(w) >= 5}
    assert spelling_tiles.variants(spelling_tiles.vocabulary(frame(spark, []))).count() == 0


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER), swap_packing.Words(open(TOKENIZER, "rb").read())


def test_words_leave_the_memory_in_turns(library, monkeypatch):
    monkeypatch.setattr(swap_packing, "REMEMBERED", 4000)
    words = swap_packing.Words(open(TOKENIZER, "rb").read())
    texts = [f"Word{i % 37} été{i}. ßA! {chr(0xC0 + i % 64)}x Übung{i % 5}," for i in range(300)]
    for text in texts:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == library[0].encode(text, add_special_tokens=False).ids + [1]
        assert len(words) + len(words.old) < 60


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abEIs't  \n\t\r\v\f\x1c\x85\xa0 éÉé日😀Σς<|>¹Ⅷ3_.,!")), max_size=40))
def test_ids_by_word_equal_the_library(library, text):
    words = library[1]
    ids = np.frombuffer(words.encode(text), "<u4").tolist()
    assert ids == library[0].encode(text, add_special_tokens=False).ids + [1]
    assert ids == np.frombuffer(words.encode(text), "<u4").tolist()  # from memory


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 99), max_size=60))
def test_packing_of_a_shard(sizes):
    bins = swap_packing.Bins(sizes, 100)
    bins.best_fit()
    before = sum(f * f for f in bins.fill), len(bins.held)
    bins.search()
    assert sorted(i for held in bins.held for i in held) == list(range(len(sizes)))
    for held, fill in zip(bins.held, bins.fill):
        assert sum(sizes[i] for i in held) == fill <= 100
    assert sum(f * f for f in bins.fill) >= before[0] and sum(map(bool, bins.held)) <= before[1]


def test_swaps_empty_a_sequence():
    """Largest first leaves one sequence more than the pieces need."""
    bins = swap_packing.Bins([57, 47, 37, 32, 29, 25, 25, 24, 7], 100)
    bins.best_fit()
    assert sum(map(bool, bins.held)) == 4
    assert bins.search() > 0 and sum(map(bool, bins.held)) == 3


def test_packed_pieces(spark):
    rows = awkward() + [(1000 + i, "word " * (i % 700 + 1), None, None, None, None, None, None, None) for i in range(900)]
    rows += [(5, "a " * 9000 + "x" * 3000, None, None, None, None, None, None, None)]
    packed = swap_packing.packed_pieces(frame(spark, rows), TOKENIZER, capacity=1024, shard=100).collect()
    library = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), 1024)):
            part = ids[at:at + 1024]
            want[doc_id, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    filled = defaultdict(list)
    for r in packed:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(filled) <= -(-sum(r.length for r in packed) // 1024) * 1.01 + 1
    assert swap_packing.packed_pieces(frame(spark, []), TOKENIZER).count() == 0


def test_pieces_of_one_length_stay_few_sequences(spark):
    """Pieces over half a sequence fill one each, however many rounds there are."""
    cut = spark.range(700).select(F.col("id").alias("row"), F.lit(600).cast("long").alias("length"))
    got = swap_packing.sequences(cut, 1000, shard=50).collect()
    assert len(got) == len({r.row for r in got}) == len({r.sequence_id for r in got}) == 700
