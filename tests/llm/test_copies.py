"""Near duplicates, repeated passages, fingerprints and benchmark tiling against brute force."""

import hashlib
import random
import re
import time
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tablehouse.llm import order_minhash, spotsigs, substrings, tiling

WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def words(t):
    return WORD.findall((t or "").lower())


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


# ---- Order MinHash -----------------------------------------------------------------------


def test_alignment_in_a_band():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(0, 30))]
        b = a.copy()
        for _ in range(rng.randrange(0, 8)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(6)) if rng.random() < 0.5 or not b else b.pop(rng.randrange(len(b)))
        x, y = (np.array(v, np.uint32) for v in (a, b))
        assert order_minhash.aligned(x, y, 40) == lcs(a, b)
        band = max(len(a), len(b)) // 5
        if lcs(a, b) >= 0.8 * max(len(a), len(b)):
            assert order_minhash.aligned(x, y, band) == lcs(a, b)


def test_order_matters():
    kmers = np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a = order_minhash.sketch(kmers, kmers, 24, 4)
    b = order_minhash.sketch(kmers[::-1].copy(), kmers[::-1].copy(), 24, 4)
    assert len(a) == 24 and len(set(a) & set(b)) == 0 and (a == order_minhash.sketch(kmers, kmers, 24, 4)).all()


def test_occurrences_are_told_apart():
    kmers = np.array([5, 5, 7, 5], np.uint64)
    assert len(set(order_minhash.labelled(kmers, np.zeros(4, np.int64)).tolist())) == 4
    assert len(set(order_minhash.labelled(kmers, np.array([0, 1, 1, 2])).tolist())) == 2


def edited(rng, base, share):
    out = base.copy()
    for _ in range(int(share * len(base))):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def brute_classes(texts, least=0.8):
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = texts[i], texts[j]
            if find(i) != find(j) and min(len(a), len(b)) >= least * max(len(a), len(b)) and lcs(a, b) >= least * max(len(a), len(b)):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in ids}


def test_classes_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    texts = []
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(60)]
        texts += [base, base, *[edited(rng, base, s) for s in (0.02, 0.03, 0.05)]]
    texts += [[*passage, *(rng.choice(vocabulary) for _ in range(35))] for _ in range(15)]
    texts += [[], ["one"], ["one", "two"], ["one"]]
    rng.shuffle(texts)
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in order_minhash.classes(frame).collect()}
    assert found == brute_classes(dict(enumerate(texts)))


def _found(a, b):
    """Whether two word lists share a sketch."""
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([" ".join(a), " ".join(b)])], names=["doc_id", "text"])
    x, y = next(order_minhash._scan(order_minhash.K, order_minhash.PICKS, order_minhash.SKETCHES)([batch])).column("sketches").to_pylist()
    return bool({*x} & {*y})


@pytest.mark.parametrize("size", [10, 20, 100, 300])
def test_recall_on_shingles(size):
    """Pairs whose five-word shingles overlap by 0.8 or more (Jaccard) share a sketch, whatever their length."""
    rng = random.Random(size)
    found = []
    while len(found) < 150:
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        other = edited(rng, base, rng.random() * 2.5 / size + 0.02) + ["tail"] * rng.randrange(2)
        x, y = ({tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in (base, other))
        if base != other and len(x & y) >= 0.8 * len(x | y):
            found.append(_found(base, other))
    assert sum(found) >= 0.99 * len(found)


def test_chain_of_left_overs(spark):
    """Texts that are near their neighbours in a chain only; the least of a bucket is not near all."""
    base = [f"c{i}" for i in range(60)]
    texts = [base[:60 - 0] if not s else [*base[s:], *[f"t{k}" for k in range(s)]] for s in range(0, 40, 6)]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in order_minhash.classes(frame).collect()}
    assert found == brute_classes(dict(enumerate(texts)))


def test_bags():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a, b = (rng.choice(np.array([1, 7, 2**31, 2**32 - 1], np.uint32), rng.integers(0, 30)) for _ in range(2))
        x, y = order_minhash.bag(a), order_minhash.bag(b)
        assert len(set(x.tolist())) == len(a) and len({*x.tolist()} & {*y.tolist()}) == (Counter(a.tolist()) & Counter(b.tolist())).total()


def test_texts_about_a_class_are_not_aligned(spark, monkeypatch):
    """Texts with too few words in common with any text of a large class, though not by the triangle inequality, make no pairs with it."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    change = lambda n, first: [f"x{rng.randrange(10**9)}" if i in picked else w for picked in [set(rng.sample(range(first, 60), n))] for i, w in enumerate(base)]
    texts = [base, *[change(rng.randrange(1, 5), 30) for _ in range(60)], *[change(18, 30) for _ in range(40)], *[change(13, 30) for _ in range(10)]]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    verify, sent = order_minhash.verify, []

    def counted(pairs, *more):
        sent.append(pairs.count())
        return verify(pairs, *more)

    monkeypatch.setattr(order_minhash, "verify", counted)
    found = {r.doc_id: r.class_id for r in order_minhash.classes(frame).collect()}
    assert found == brute_classes(dict(enumerate(texts)))
    assert sum(sent) < 8 * len(texts)  # 1,728 pairs of 111 texts without the bags


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100, i) for i in range(101, 140)] + [(200 + i, 201 + i) for i in range(30)]
    frame = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "a binary, b binary") if max(max(e) for e in edges) < 256 else None
    found = {r.node[0]: r.root[0] for r in order_minhash.components(frame).collect()}
    want = {}
    for n in {x for e in edges for x in e}:
        seen, todo = {n}, [n]
        while todo:
            x = todo.pop()
            for a, b in edges:
                for p, q in ((a, b), (b, a)):
                    if p == x and q not in seen:
                        seen.add(q), todo.append(q)
        if len(seen) > 1:
            want[n] = min(seen)
    assert found == want


def test_keep_one(odd, none):
    kept = order_minhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert len(rows) == len({tuple(words(r.text)) for r in odd.collect()})
    assert {r.doc_id for r in rows if not words(r.text)} == {2}
    assert order_minhash.keep_one(none).count() == 0


def test_classes_cover_all_rows(docs, odd, none):
    for frame in (docs, odd):
        assert sorted((r.doc_id or 0) for r in order_minhash.classes(frame).collect()) == sorted((r.doc_id or 0) for r in frame.collect())
    assert order_minhash.classes(none).count() == 0


# ---- repeated passages ---------------------------------------------------------------------


def brute_repeats(rows, k):
    cut = [(d, re.findall("[^\\x20\\x09-\\x0D]+", t or "")) for d, t in rows]
    seen = Counter(tuple(w[i:i + k]) for _, w in cut for i in range(len(w) - k + 1))
    out = []
    for d, w in cut:
        gone = {j for i in range(len(w) - k + 1) if seen[tuple(w[i:i + k])] > 1 for j in range(i, i + k)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [3, 35])
def test_repeats(docs, odd, none, k, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_TEXT", 1 << 16)
    monkeypatch.setattr(substrings, "RANGE_WINDOWS", 1 << 10)
    for frame in (docs, odd):
        found = substrings.remove_repeats(frame, k, digest=True).drop("spans").collect()
        assert sorted(map(tuple, found), key=str) == brute_repeats([(r.doc_id, r.text) for r in frame.collect()], k)
    assert substrings.remove_repeats(none, k).count() == 0


def test_intervals_are_maximal(spark):
    frame = spark.createDataFrame([(1, "a b c d x e"), (2, "z a b c d y"), (3, "q q q q")], "doc_id long, text string")
    found = {r.doc_id: r for r in substrings.remove_repeats(frame, 3).collect()}
    assert [(s.first, s.last) for s in found[1].spans] == [(0, 3)] and found[1].kept == "x e"
    assert found[2].kept == "z y" and found[3].kept == "" and found[3].n_removed == 4


# ---- SpotSigs --------------------------------------------------------------------------------


def brute_set(text):
    w = words(text)
    common = set(spotsigs.ANCHORS + spotsigs.COMMON)
    out = set()
    for i, x in enumerate(w):
        rest = [y for y in w[i + 1:] if y not in common]
        if x in set(spotsigs.ANCHORS) and len(rest) >= spotsigs.CHAIN:
            out.add((x, *rest[:spotsigs.CHAIN]))
    return out or {("whole", *w)}


def overlap(a, b):
    return len(a & b) / len(a | b)


def test_neighbours(docs, odd, none, texts):
    short = {i: t for i, t in texts.items() if len(t) < 4000}
    for frame in (docs.filter("n_chars < 4000"), odd.filter("doc_id <> 6 or doc_id is null")):
        rows = sorted(((r.doc_id, r.text or "") for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        want = []
        for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
            cut = len(t) // 4
            other = t[:len(t) - cut] + after[:cut]
            want.append((d, len(t), hashlib.sha256(other.encode()).hexdigest(), round(overlap(brute_set(t), brute_set(other)), 9), round(overlap(brute_set(t), brute_set(after)), 9)))
        found = spotsigs.neighbours(frame).collect()
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in found), key=str) == sorted(want, key=str)
    assert short and spotsigs.neighbours(none).count() == 0


def test_fingerprints_of_any_language(spark, odd, none, tmp_path):
    from tablehouse.llm import queries

    rng = random.Random(4)
    line = lambda n: " ".join(f"s{rng.randrange(5000)} {rng.choice(('ja', 'oraz'))}" for _ in range(n))
    rows = [(i, line(40), "pl", "s", 0) for i in range(60)] + [(100 + i, " ".join(f"menu{rng.randrange(10**6)}" for _ in range(24)), None, "m", 0) for i in range(5)]
    spark.createDataFrame(rows, odd.schema.names[:5]).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op9_spotsigs(spark, str(tmp_path)).collect()}
    assert len(found) == 65 and all(0.3 < r.near_edited < 1 for r in found.values())
    assert all(r.near_next < 0.1 for r in found.values())
    lists = spotsigs.common_words(spark.createDataFrame(rows, odd.schema.names[:5]))
    assert len(lists[0]) - len(set(spotsigs.ANCHORS)) == 2
    assert spotsigs.neighbours(odd, spotsigs.common_words(odd)).count() == odd.count() and spotsigs.neighbours(none, spotsigs.common_words(none)).count() == 0


def test_equal_texts_equal_fingerprints(docs, texts):
    prints = {r.doc_id: r.fingerprint for r in spotsigs.fingerprints(docs).collect()}
    by = defaultdict(set)
    for i, t in texts.items():
        by[t].add(prints[i])
    assert all(len(v) == 1 for v in by.values()) and len(set(prints.values())) > 0.9 * len({tuple(words(t)) for t in by})


def test_near_pairs(docs, texts):
    members, pairs = spotsigs.near_pairs(spotsigs.fingerprints(docs), 0.5)
    of = {r.doc_id: r.print for r in members.collect()}
    sets = {of[i]: brute_set(t) for i, t in texts.items()}
    names = sorted(sets)
    want = {(a, b): round(overlap(sets[a], sets[b]), 9) for i, b in enumerate(names) for a in names[:i] if overlap(sets[a], sets[b]) >= 0.5}
    assert want and {(r.a, r.b): round(r.likeness, 9) for r in pairs.collect()} == want


# ---- tiling ------------------------------------------------------------------------------------


def brute_tiles(doc, item, k):
    """Coverage of the item by greedy tiling."""
    in_doc, in_item = [False] * len(doc), [False] * len(item)
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not in_item[i + n] and not in_doc[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < k:
            return sum(in_item)
        in_item[i:i + n] = in_doc[j:j + n] = [True] * n


def test_tiles_against_brute_force():
    rng = random.Random(9)
    for _ in range(60):
        item = [rng.randrange(9) for _ in range(rng.randrange(5, 25))]
        doc = [rng.randrange(9) for _ in range(20)]
        for _ in range(3):
            a = rng.randrange(len(item))
            doc[rng.randrange(20):0] = item[a:a + rng.randrange(3, 12)]
        x, y = np.array(doc, np.uint64), np.array(item, np.uint64)
        seeds = [(i, j) for i in range(len(item) - 2) for j in range(len(doc) - 2) if item[i:i + 3] == doc[j:j + 3]]
        if not seeds:
            continue
        i, j = (np.array(v) for v in zip(*seeds))
        found = tiling.tiles(x, y, i, j, 3)
        assert sorted(n for _, _, n in found)[-1] == max(n for n in _longest(item, doc))
        assert sum(n for *_, n in found) == brute_tiles(doc, item, 3)


def _longest(item, doc):
    for i in range(len(item)):
        for j in range(len(doc)):
            n = 0
            while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]:
                n += 1
            yield n


def test_contaminated(spark, docs, texts, sf_dir, monkeypatch):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: words(r.text) for r in bench.collect()}
    held = {i: words(t) for i, t in texts.items()}
    want = set()
    for i, w in held.items():
        grams = {tuple(w[j:j + 5]) for j in range(len(w) - 4)}
        for b, v in items.items():
            if any(tuple(v[j:j + 5]) in grams for j in range(len(v) - 4)) and brute_tiles(w, v, 5) >= 0.5 * len(v):
                want.add((i, b))
    found = {(r.doc_id, r.item_id) for r in tiling.contaminated(docs, bench).collect()}
    assert found == want and want
    assert {r.doc_id for r in tiling.clean(docs, bench).collect()} == set(held) - {i for i, _ in want}
    monkeypatch.setattr(tiling, "BLOCK_WORDS", 300)  # several blocks
    assert {(r.doc_id, r.item_id) for r in tiling.contaminated(docs, bench).collect()} == want


def _tilings(bench, texts, k=5):
    """(document, item, covered words, tiles) through the batch code."""
    items = tiling.items_of(list(range(len(bench))), bench, k)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    return [(r, f["item_id"], f["covered"], len(f["tiles"])) for r, f in tiling._rows(items, batch, k, 0.0)]


@pytest.mark.parametrize("together", [1, 40, 1 << 20])
def test_batches_against_brute_force(monkeypatch, together):
    monkeypatch.setattr(tiling, "STARTS", together)
    rng = random.Random(4)
    for alphabet in (1, 2, 3, 9):
        bench = [" ".join(str(rng.randrange(alphabet)) for _ in range(rng.randrange(0, 25))) for _ in range(6)]
        texts = [" ".join([str(rng.randrange(alphabet)) for _ in range(rng.randrange(0, 12))] + rng.choice(bench).split()[rng.randrange(4):]) for _ in range(8)]
        found = {(r, o): n for r, o, n, _ in _tilings(bench, [*texts, None, ""], 3)}
        for r, t in enumerate(texts):
            for o, b in enumerate(bench):
                assert found.pop((r, o), 0) == brute_tiles(t.split(), b.split(), 3)
        assert not found


def test_repeated_words_stay_small():
    """20,000 equal words against 3,000: as many stretches as words, not as pairs of them."""
    tracemalloc.start()
    begin = time.perf_counter()
    found = _tilings(["la " * 3000, "a b " * 1500], ["la " * 20_000, "a b " * 10_000, "x " + "la " * 2999])
    assert found == [(0, 0, 3000, 1), (1, 1, 3000, 1), (2, 0, 2999, 1)]
    assert time.perf_counter() - begin < 10 and tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_reordered_and_odd(spark, odd, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "one two"), (None, "")], "item_id long, text string")
    mixed = spark.createDataFrame([(1, "x eta theta iota kappa lambda mu y alpha beta gamma delta epsilon zeta z"), (2, "alpha beta gamma delta")], "doc_id long, text string")
    rows = tiling.contaminated(mixed, bench).collect()
    assert [(r.doc_id, r.item_id, r.coverage, [t.words for t in r.tiles]) for r in rows] == [(1, 1, 1.0, [6, 6])]
    assert [(r.doc_id, r.coverage) for r in tiling.contaminated(odd, bench).collect()] == [(1, 0.5), (1, 0.5)]
    assert tiling.clean(odd, bench).columns == odd.columns and tiling.clean(odd, bench).count() == odd.count() - 2
    assert tiling.contaminated(none, bench).count() == 0 and tiling.contaminated(odd, bench.filter("false")).count() == 0
