"""Mix, duplicates, passages, search, fixity and links against plain versions, and the pipeline."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowlens.llm import block_max_search, link_trust, odd_minhash, source_mix, substring_dedup, warc_fixity
from tests.llm.rows import awkward, frame


@pytest.mark.parametrize("good,bad,draws", [(5, 7, 4), (100, 300, 50), (3, 5000, 2500), (9, 3, 11), (40000, 90000, 60000)])
def test_hypergeometric_moments(spark, good, bad, draws):
    n = 3000
    got = np.array([r[0] for r in spark.range(n, numPartitions=4).select(source_mix.hypergeometric(
        *[F.lit(x).cast("long") for x in (good, bad, draws)], F.col("id"))).collect()])
    total = good + bad
    mean = draws * good / total
    var = mean * (1 - good / total) * (total - draws) / (total - 1)
    assert got.min() >= max(0, draws - bad) and got.max() <= min(good, draws)
    assert abs(got.mean() - mean) < 5 * (var / n) ** 0.5 and 0.85 < got.var() / var < 1.15


def plain_targets(sizes, weights, share, repeats):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > repeats * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = repeats * sizes[s]
            open_.remove(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


@pytest.mark.parametrize("block_words", [7, None])
def test_mix_meets_targets(spark, block_words):
    rows = awkward() + [(100 + i, "w " * (i % 50 + 1), "en", f"s{i % 5}", None, None, None, None, None) for i in range(400)]
    sizes, plan, blocks = source_mix.mix(frame(spark, rows), block_words=block_words, blocks_per_shard=16)
    own = {r.row: r for r in sizes.collect()}
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in own.values()) == sorted(
        (r[0] is None, r[0] or 0, len((r[1] or "").split())) for r in rows)
    totals = Counter()
    for r in own.values():
        totals[r.source] += r.size
    want = plain_targets(totals, source_mix.WEIGHTS, 1.5, 2.0)
    got = {r.source: r for r in plan.collect()}
    assert {s: pytest.approx(t) for s, t in want.items()} == {s: r.target for s, r in got.items()}
    taken, per_doc, drawn = Counter(), Counter(), blocks.collect()
    assert len({(r.row, r.block, r.epoch) for r in drawn}) == len(drawn)
    for r in drawn:
        taken[own[r.row].source] += r.words
        per_doc[r.row] += r.words
    most = defaultdict(int)
    for r in drawn:
        most[own[r.row].source] = max(most[own[r.row].source], r.words)
    for s, t in want.items():
        assert abs(taken[s] - t) <= most[s] / 2 + 1e-6
    assert all(per_doc[k] <= 2 * r.size for k, r in own.items())
    shards = Counter(r.shard for r in drawn)
    assert len(shards) > 4 and max(shards.values()) - min(shards.values()) <= 1
    for shard in shards:
        assert sorted(r.position for r in drawn if r.shard == shard) == list(range(shards[shard]))
    key = lambda x: sorted((r.doc_id is None, r.doc_id or 0, r.block, r.epoch, r.shard, r.position) for r in x)
    assert key(source_mix.mix(frame(spark, rows), block_words=block_words, blocks_per_shard=16)[2].collect()) == key(drawn)


def test_mix_of_nothing_and_taken_rows(spark):
    sizes, plan, blocks = source_mix.mix(frame(spark, []))
    assert (sizes.count(), plan.count(), blocks.count()) == (0, 0, 0)
    docs = frame(spark)
    _, _, blocks = source_mix.mix(docs, block_words=None)
    assert source_mix.taken_rows(docs, blocks).count() == blocks.count()
    blank = frame(spark, [r for r in awkward() if not (r[1] or "").split()])
    assert source_mix.mix(blank)[2].count() == 0


def plain_repeats(rows, window):
    first = {}
    for key, text in rows:
        ws = (text or "").split(" ") if False else (text or "").encode().split()
        for i in range(len(ws) - window + 1):
            w = tuple(ws[i:i + window])
            first[w] = min(first.get(w, 1 << 62), 1 << 62 if key is None else key)
    out = []
    for key, text in rows:
        ws, gone = (text or "").encode().split(), set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < (1 << 62 if key is None else key):
                gone.update(range(i, i + window))
        out.append((key, len(ws), len(gone), b" ".join(w for i, w in enumerate(ws) if i not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,rounds,chunk_docs", [(50, 5, 3), (50, 5, 100), (8, 2, 4), (8, 5, 4)])
def test_repeated_passages_equal_plain_version(spark, window, rounds, chunk_docs):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in rng.integers(0, 40, 400)]
    more = []
    for i in range(30):
        at, n = rng.integers(0, 300), int(rng.integers(5, 90))
        own = [f"w{j}" for j in rng.integers(0, 40, 30)]
        more.append((200 + i, " ".join(own + base[at:at + n] + own[:5] + ["r"] * int(rng.integers(0, 70))), None, None, None,
                     None, None, None, None))
    rows = awkward() + more
    got = substring_dedup.without_repeats(frame(spark, rows), window=window, rounds=rounds, chunk_docs=chunk_docs, carry=("lang",))
    have = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()), key=repr)
    assert have == plain_repeats([(r[0], r[1]) for r in rows], window)


def test_repeats_of_nothing(spark):
    assert substring_dedup.without_repeats(frame(spark, [])).count() == 0
    assert substring_dedup.without_repeats(frame(spark, [r for r in awkward() if not (r[1] or "").split()])).count() == 4


def plain_components(rows, k, similarity):
    sets, keys = [], []
    for key, text in rows:
        ws = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
        sets.append({tuple(ws[i:i + k]) for i in range(max(len(ws) - k, 0) + 1)} if ws else set())
        keys.append(key)
    parent = {k: k for k in keys if k is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if keys[i] is not None and keys[j] is not None and both and 100 * both >= similarity * len(sets[i] | sets[j]):
                a, b = sorted((root(keys[i]), root(keys[j])))
                parent[b] = a
    return sorted(((k, len(s), None if k is None else root(k)) for k, s in zip(keys, sets)), key=repr)


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_plain_version(spark, k):
    rng = np.random.default_rng(9)
    rows = awkward()
    for group in range(12):
        words = [f"g{group}x{i}" for i in rng.integers(0, 500, int(rng.integers(3, 150)))]
        for copy in range(int(rng.integers(1, 12))):
            own = list(words)
            for _ in range(copy):
                own[int(rng.integers(0, len(own)))] = f"new{rng.integers(0, 10**6)}"
            rows.append((1000 + 100 * group + copy, " ".join(own), None, None, None, None, None, None, None))
    got = odd_minhash.near_duplicates(frame(spark, rows), k=k).collect()
    have = sorted(((r.doc_id, r.n_shingles, r.component) for r in got), key=repr)
    assert have == plain_components([(r[0], r[1]) for r in rows], k, 80)


def test_near_duplicates_of_nothing(spark):
    assert odd_minhash.near_duplicates(frame(spark, [])).count() == 0


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    got = dict(odd_minhash.components(spark.createDataFrame(path + star, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[100 + i] == 100 for i in range(1, 60))


def test_shingles_of_a_slice_equal_those_of_its_rows():
    texts = pa.array([f"Word{i} und été W{i % 7} {i}" for i in range(50)] + [None, ""])
    whole, part = odd_minhash.shingles(texts, 2), odd_minhash.shingles(texts.slice(30, 15), 2)
    inside = (whole[0] >= 30) & (whole[0] < 45)
    assert (whole[0][inside] - 30).tolist() == part[0].tolist() and whole[1][inside].tolist() == part[1].tolist()


def test_odd_sketch_estimates(spark):
    hashes = odd_minhash.Hashes(odd_minhash.BANDS, odd_minhash.ROWS)
    rng = np.random.default_rng(0)
    for similarity in (0.95, 0.9, 0.8):
        errors = []
        for _ in range(30):
            n = 400
            common = rng.integers(0, 1 << 63, int(n * 2 * similarity / (1 + similarity)), dtype=np.uint64)
            sets = [np.append(common, rng.integers(0, 1 << 63, n - len(common), dtype=np.uint64)) for _ in range(2)]
            samples = hashes.samples(np.concatenate(sets), np.array([0, n]))
            a, b = hashes.sketches(samples, odd_minhash.SKETCH_LONGS)
            z = int(np.bitwise_count(a ^ b).sum())
            bits, m = 64 * odd_minhash.SKETCH_LONGS, samples.shape[1]
            errors.append(1 + bits / 2 * np.log(1 - 2 * z / bits) / (2 * m) - len(common) / (2 * n - len(common)))
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.05


@pytest.mark.parametrize("shard_docs,at_once", [(4, 50), (1000, 10**6)])
def test_search_equals_plain_version(spark, shard_docs, at_once):
    rng = np.random.default_rng(2)
    rows = awkward() + [(300 + i, " ".join(f"t{j}" for j in rng.zipf(1.3, 60) % 90), *[None] * 7) for i in range(200)]
    docs = frame(spark, rows)
    index = block_max_search.build(docs, shard_docs=shard_docs)
    queries = block_max_search.query_terms(docs.where("doc_id % 10 = 0"))
    got = defaultdict(list)
    for r in block_max_search.search(index, queries, 5, at_once).orderBy("query", "rank").collect():
        got[r.query].append((r.key, r.score))
    texts = [(r[0], Counter((bytes(b + 32 if 65 <= b <= 90 else b for b in (r[1] or "").encode())).split())) for r in rows
             if r[0] is not None]
    n, words = len(texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    for key, asked in {k: c for k, c in texts if k % 10 == 0}.items():
        scores = []
        for other, c in texts:
            norm = 1.2 * (1 - 0.75 + 0.75 * sum(c.values()) / (words / n))
            s = sum(int(np.floor(1_000_000 * np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * (c[t] * 2.2 / (c[t] + norm))))
                    for t in asked if t in c)
            if s:
                scores.append((other, s))
        want = sorted(scores, key=lambda x: (-x[1], x[0]))[:5]
        if key != 6:  # its rows repeat, so does what they find
            assert got[key] == want, key
    assert got[0] == [] and got[2] == []
    empty = frame(spark, [])
    assert block_max_search.search(block_max_search.build(empty), block_max_search.query_terms(empty)).count() == 0


def records(spark, rows):
    return spark.createDataFrame(rows, "file long, seq long, record binary")


def test_fixity_finds_all_damage(spark):
    rng = np.random.default_rng(8)
    rows = [(f, s, rng.bytes(int(rng.integers(1, 400)))) for f in range(40) for s in range(30)]
    bad = list(rows)
    bad[35] = (1, 5, b"!" * len(rows[35][2]))
    bad[200] = (6, 20, None)
    bad[200] = (6, 20, bytes(len(rows[200][2])))
    del bad[599]
    bad.append((39, 30, b"more"))
    bad.append((77, 0, b"new file"))
    got = warc_fixity.audit(records(spark, rows), records(spark, bad), range_bytes=512, fanout=3)
    assert sorted((r.file, r.seq, r.damage) for r in got.collect()) == [
        (1, 5, "changed"), (6, 20, "changed"), (19, 29, "missing"), (39, 30, "extra"), (77, 0, "extra")]
    assert warc_fixity.audit(records(spark, rows), records(spark, rows)).count() == 0


def test_fixity_edges(spark):
    rows = [(None, 0, b"x"), (0, None, b"y"), (0, 1, None), (0, 2, b"z"), (0, 2, b"z")]
    assert warc_fixity.audit(records(spark, rows), records(spark, rows)).count() == 0
    assert warc_fixity.audit(records(spark, rows), records(spark, [])).where("damage = 'missing'").count() == 5
    assert warc_fixity.audit(records(spark, []), records(spark, rows)).where("damage = 'extra'").count() == 5
    assert warc_fixity.audit(records(spark, []), records(spark, [])).count() == 0


def plain_audit(good, bad):
    """Damage by file, seq and contents, in offsets of the first replica."""
    out, size = [], lambda r: len(r or b"")
    for f in {r[0] for r in good + bad}:
        a, b = ({s: r for g, s, r in rows if g == f} for rows in (good, bad))
        at = 0
        for s in sorted(a.keys() | b.keys()):
            if s not in b or s in a and a[s] != b[s]:
                out.append((f, s, at, at + size(a[s]), "changed" if s in b else "missing"))
            if s in a:
                at, more = at + size(a[s]), 0
            else:
                more = 0 if s - 1 in a or s == 0 else more
                out.append((f, s, at + more, at + more + size(b[s]), "extra"))
                more += size(b[s])
    return sorted(out)


@pytest.mark.parametrize("range_bytes", [64, 512, 1 << 17])
def test_fixity_finds_damage_that_moves_later_records(spark, range_bytes):
    rng = np.random.default_rng(9)
    rows = [(f, s, rng.bytes(int(rng.integers(1, 400)))) for f in (0, 1, 2, 3, 9) for s in range(0, 120, 3)]
    bad = {(f, s): r for f, s, r in rows}
    bad[0, 30] = bad[0, 30][:-1]  # truncated
    bad[1, 45] += b"more"  # lengthened
    del bad[1, 60], bad[2, 0]  # lost
    bad[2, 61], bad[2, 62] = b"first inserted", rng.bytes(5000)
    bad[3, 33] = bad[3, 33] + rng.bytes(3000)
    bad[3, 117] = bytes(len(bad[3, 117]))
    bad = [(f, s, r) for (f, s), r in bad.items()]
    bad += [(9, 118 + s, rng.bytes(300)) for s in range(20)] + [(50, s, rng.bytes(90)) for s in range(20)]
    got = warc_fixity.audit(records(spark, rows), records(spark, bad), range_bytes=range_bytes, fanout=3)
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, bad)


def test_fixity_of_repeated_places(spark):
    rows = [(0, s, b"%d-%d" % (s, c)) for s in range(30) for c in range(4)] + [(0, 7, b"same")] * 40 + [(0, None, b"%d" % i) for i in range(50)]
    bad = [r for r in rows if r not in ((0, 4, b"4-1"), (0, None, b"17"))] + [(0, 4, b"new"), (0, 9, b"more"), (0, 7, b"same")]
    got = warc_fixity.audit(records(spark, rows), records(spark, bad), range_bytes=32, fanout=3)
    assert sorted((r.seq is None, r.seq or 0, r.damage) for r in got.collect()) == [
        (False, 4, "changed"), (False, 7, "extra"), (False, 9, "extra"), (True, 0, "missing")]


def plain_rank(seeds, edges, damping, iterations):
    score = dict(seeds)
    out = Counter()
    for a, _, n in edges:
        out[a] += n
    for _ in range(iterations):
        new = {h: (1 - damping) * s for h, s in seeds.items()}
        for a, b, n in edges:
            if a in score:
                new[b] = new.get(b, 0) + damping * score[a] * n / out[a]
        score = new
    return score


def test_links_carry_trust_and_distrust(spark):
    link = lambda *hosts: "".join(f'<a class=x HREF="https://{h}/p">t</a>' for h in hosts)
    pages = [
        (0, "http://good.example.net/en/1", link("Friend.com", "friend.com")), (1, "http://bad.net/x", link("friend.com")),
        (2, "https://friend.com/", link("second.com")), (3, "https://farm.com/a?b", link("bad.net", "farm.com")),
        (4, "http://second.com#f", None), (5, None, link("bad.net")), (6, "no scheme", "<p>"), (7, "http://lonely.com/de/", ""),
        (8, "http://sub.example.com/de/x", "href='//second.com'"), (9, "HTTP://A.NET", None), (9, "HTTP://A.NET", None),
        (10, "http://x.org/fr/", " href=//third.com "), (None, "http://notexample.net/en/", None)]
    got = {}
    for r in link_trust.judge(spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string"),
                              key="page_id").collect():
        got[r.page_id] = r
    assert [got[i].rule for i in (0, 1, 2, 5, 6, 8, 9, 10, None)] == [
        "example.net/en/", "net/", None, None, None, "example.com/de/", None, "org/fr/", "net/"]
    assert got[9].host == "a.net" and got[9].path == "" and got[5].host == "" and got[6].verdict == "allow"
    assert got[3].verdict == "block" and got[2].verdict == "allow" and got[4].verdict == "allow" and got[7].verdict == "allow"
    trust = plain_rank({"good.example.net": 0.5, "x.org": 0.5}, [
        ("good.example.net", "friend.com", 1), ("bad.net", "friend.com", 1), ("friend.com", "second.com", 1),
        ("farm.com", "bad.net", 1), ("sub.example.com", "second.com", 1), ("x.org", "third.com", 1)], 0.8, 200)
    assert got[2].trust == pytest.approx(trust["friend.com"]) and got[4].trust == pytest.approx(trust["second.com"])
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert link_trust.judge(empty).count() == 0


def test_links_are_followed_until_nothing_changes(spark):
    """A chain of 30 hosts to a blocked one, a cycle, a hub that links to all, and a host that many link to."""
    link = lambda *hosts: "".join(f'<a href="https://{h}/p">t</a>' for h in hosts)
    chain = [f"c{i}.com" for i in range(30)] + ["bad.net"]
    links = [(a, b) for a, b in zip(chain, chain[1:])] + [("r1.com", "r2.com"), ("r2.com", "r3.com"), ("r3.com", "r1.com"),
                                                       ("r2.com", "bad.net"), ("good.org", "r1.com")]
    links += [("hub.com", f"h{i}.com") for i in range(200)] + [("hub.com", "bad.net")] + [(f"h{i}.com", "popular.com") for i in range(200)]
    by_host = defaultdict(list)
    for a, b in links:
        by_host[a].append(b)
    seeds = {"bad.net": "http://bad.net/", "good.org": "http://good.org/fr/"}
    hosts = sorted({h for e in links for h in e})
    pages = [(i, seeds.get(h, f"http://{h}/"), link(*by_host[h])) for i, h in enumerate(hosts)]
    got = {r.host: r for r in link_trust.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[h].verdict == "block" for h in chain)
    back = [(b, a, 1) for a, b in links]
    distrust = plain_rank({"bad.net": 1.0}, back, 0.8, 400)
    trust = plain_rank({"good.org": 1.0}, [(a, b, 1) for a, b in links], 0.8, 400)
    for h in hosts:
        assert got[h].distrust == pytest.approx(distrust.get(h, 0.0), abs=1e-9) and got[h].trust == pytest.approx(trust.get(h, 0.0), abs=1e-9)
    assert got["hub.com"].verdict == "block" and got["h7.com"].verdict == got["popular.com"].verdict == "allow"
    assert got["c0.com"].distrust == pytest.approx(got["c1.com"].distrust * 0.8)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as pipeline
    docs, before = frame(spark, awkward() + [(50, awkward()[5][1] + " tail", "de", "s1", 1, None, None, None, None)]), None
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"file://{tmp_path}/{name.replace(' ', '_')}")
        before, docs = docs, spark.read.parquet(f"file://{tmp_path}/{name.replace(' ', '_')}")
        if name != "tokens":
            assert docs.columns == pipeline.COLUMNS
        if name == "language identification":
            assert docs.where("text IS NULL OR NOT text RLIKE '[A-Za-z]'").count() == 0
        if name == "near duplicates":
            ids = sorted(r.doc_id for r in docs.where("doc_id IS NOT NULL").collect())
            assert len(ids) == len(set(ids)) and 50 not in ids and 14 not in ids and 5 in ids
        if name == "repeated passages":
            assert docs.count() == before.count()
    assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded"] and docs.count() > 0
    nothing = frame(spark, [])
    for _, stage in pipeline.STAGES:
        nothing = stage(spark, nothing, str(tmp_path))
    assert nothing.count() == 0


def sets_of(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\x0b", " ").split()
    return {tuple(words[i:i + k]) for i in range(max(len(words) - k, 0) + 1)} if words else set()


def plain_passages(rows):
    """(doc_id, text) without the 50-word windows that start in a document with a smaller id."""
    words = {key: text.split() for key, text in rows}
    starts = defaultdict(set)
    for key, ws in words.items():
        for i in range(len(ws) - 49):
            starts[tuple(ws[i:i + 50])].add(key)
    out = {}
    for key, ws in words.items():
        gone = {j for i in range(len(ws) - 49) if min(starts[tuple(ws[i:i + 50])]) < key for j in range(i, i + 50)}
        out[key] = " ".join(w for j, w in enumerate(ws) if j not in gone) if gone else dict(rows)[key]
    return out


def test_pipeline_equals_plain_stages(spark, tmp_path):
    """Rows of each stage from the rows of the stage before."""
    import public_tokenizers
    import sentencepiece

    import corpus_pipeline as pipeline
    rng = np.random.default_rng(4)
    vocab = {"de": [f"{a}ung{b}" for a in "äöübdgk" for b in ("", "en", "er", "lich")],
             "en": [f"th{a}{b}" for a in "aeiou" for b in ("ing", "ed", "ly", "ness", "")]}
    passage = " ".join(f"part{i}" for i in range(70))
    rows = []
    for i in range(120):
        lang = ("de", "en")[i % 2]
        words = list(rng.choice(vocab[lang], 90 + i))
        text = " ".join(words) + (f" {passage} end{i}" if i % 10 == 3 else "")
        rows.append((i, text, None if i % 7 == 0 else lang, f"s{i % 3}", len(text), None, None, None, None))
    rows += [(500 + i, rows[i][1] + " tail", "en", "s0", 1, None, None, None, None) for i in range(0, 40, 4)]
    rows += [(600, "12 -- 34", "en", "s0", 8, None, None, None, None), (601, None, None, None, None, None, None, None, None)]
    docs = frame(spark, rows)
    got = {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"file://{tmp_path}/{name.replace(' ', '_')}")
        docs = spark.read.parquet(f"file://{tmp_path}/{name.replace(' ', '_')}")
        got[name] = docs.collect()
    named = {r.doc_id: (r.text, r.lang) for r in got["language identification"]}
    assert named == {r[0]: (r[1], "de" if r[0] < 500 and r[0] % 2 == 0 or r[0] >= 500 else "en") for r in rows if r[0] < 600}
    shingles = {key: sets_of(text, 5) for key, (text, _) in named.items()}
    first = {}
    for key in sorted(shingles):
        near = [o for o in first if first[o] == o and len(shingles[o] & shingles[key]) >= 0.8 * len(shingles[o] | shingles[key])]
        first[key] = near[0] if near else key
    assert {r.doc_id for r in got["near duplicates"]} == {k for k, o in first.items() if k == o} == set(range(120))
    kept = {r.doc_id: r.text for r in got["repeated passages"]}
    assert kept == plain_passages([(r.doc_id, r.text) for r in got["near duplicates"]])
    assert sum("part33" in text for text in kept.values()) == 1
    sizes = Counter()
    for r in got["repeated passages"]:
        sizes[r.source] += len(r.text.split())
    targets, mixed = plain_targets(sizes, source_mix.WEIGHTS, 1.5, 2.0), Counter()
    for r in got["source mix"]:
        mixed[r.source] += len(r.text.split())
        assert kept[r.doc_id] == r.text
    assert max(Counter(r.doc_id for r in got["source mix"]).values()) <= 2
    longest = max(len(text.split()) for text in kept.values())
    assert all(abs(mixed[s] - targets[s]) <= 2 * longest for s in targets)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert Counter((r.doc_id, r.lang, r.source, tuple(r.ids), r.decoded, r.n_tokens) for r in got["tokens"]) == Counter(
        (r.doc_id, r.lang, r.source, tuple(library.encode(r.text)), library.decode(library.encode(r.text)), len(library.encode(r.text)))
        for r in got["source mix"])


def test_pipeline_rows_without_id_or_language(spark):
    import corpus_pipeline as pipeline
    words = [f"w{i}" for i in range(200)]
    text, near, other = " ".join(words), " ".join(words + ["tail"]), " ".join(reversed(words))
    row = lambda key, t, lang=None: (key, t, lang, "s", 1, None, None, None, None)
    docs = frame(spark, [row(7, text), row(None, text), row(None, near), row(None, other), row(None, other),
                         row(None, other + " end"), row(None, "été"), row(None, "12 --"), row(None, None)])
    named = pipeline.identify_language(spark, docs, "")
    assert named.columns == pipeline.COLUMNS and named.count() == 7
    assert named.where("text = '12 --' OR text IS NULL").count() == 0
    got = [(r.doc_id, r.text) for r in pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert len(got) == 5 and {(7, text), (None, "été"), (None, "12 --"), (None, None)} < set(got)
    assert len({(None, other), (None, other + " end")} & set(got)) == 1
