"""Quality scores: statistics by counting, equations and pools by definition, held-out accuracy."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tablehouse.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def share(a, b):
    return a / b if b else 0.0


def by_counting(text):
    raw = (text or "").encode()
    chars = [c for c in raw if not 128 <= c < 192]
    is_in = lambda s: sum(c in s for c in raw)
    letter = lambda c: 65 <= c < 91 or 97 <= c < 123 or c >= 192
    spaces = b" \t\r\n\x0b\x0c"
    words, word = [], b""
    for c in raw + b" ":
        if c in spaces:
            words += [word] if word else []
            word = b""
        else:
            word += bytes([c])
    lines = [x for x in raw.split(b"\n") if x]
    triples = list(zip(words, words[1:], words[2:]))
    n, w = len(chars), len(words)
    blank, letters = is_in(spaces), sum(map(letter, raw))
    upper = [sum(65 <= c < 91 for c in x) for x in words]
    lower = [sum(97 <= c < 123 for c in x) for x in words]
    entropy = -sum(k / len(raw) * math.log2(k / len(raw)) for k in Counter(raw).values()) / 8 if raw else 0.0
    return [
        math.log1p(w) / 10, math.log1p(share(n - blank, w)) / 4, share(sum(upper), letters), share(is_in(b"0123456789"), n), share(is_in(b".,;:?'\"-()"), n),
        share(is_in(b"!"), n), share(is_in(b"#$%&*+/<=>@[\\]^_`{|}~"), n), share(blank, n), share(is_in(b"\n"), n), share(sum(c >= 192 for c in raw), n), entropy,
        share(sum(not any(map(letter, x)) for x in words), w), share(sum(u > 1 and not v for u, v in zip(upper, lower)), w), share(sum(65 <= x[0] < 91 for x in words), w),
        share(len(set(words)), w), share(max(Counter(words).values(), default=0), w), share(len(triples) - len(set(triples)), len(triples)),
        math.log1p(share(n - is_in(b"\n"), len(lines))) / 8, share(len(lines) - len(set(lines)), len(lines)), share(sum(x[-1] in b".!?:;\"" for x in lines), len(lines))]


def test_statistics(texts):
    odd = ["", None, " ", "\n\n", "a", "A", "!!!\n!!!\n", "naïve ÉTÉ 你好 🙂", "AA bb AA bb AA bb\nAA bb", "x\n" * 50 + "end.", "É"]
    cases = odd + [texts[i] for i in sorted(texts)[:60]] + odd
    assert quality.statistics(pa.array(cases, pa.string())) == pytest.approx(np.array([by_counting(t) for t in cases]), abs=1e-12)
    assert quality.statistics(pa.array([], pa.string())).shape == (0, len(quality.STATISTICS))


def test_pools():
    rng = np.random.default_rng(5)
    for _ in range(50):
        m = int(rng.integers(1, 30))
        x, n = np.arange(m) / 7, rng.integers(1, 5, m).astype(float)
        ones = np.array([rng.integers(0, k + 1) for k in n], float)
        at, value = quality.pooled(x, ones, n)
        assert (np.diff(at) > 0).all() and (np.diff(value) > 0).all()
        # minimax form of isotonic regression
        want = [max(min(ones[i:j].sum() / n[i:j].sum() for j in range(k + 1, m + 1)) for i in range(k + 1)) for k in range(m)]
        assert sorted(set(np.round(want, 9))) == pytest.approx(list(np.round(value, 9)))


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]


def test_equations_are_exact(spark, tables):
    """The model is that of one matrix over all labelled rows, whatever the partitions."""
    docs, labels = tables
    models = [quality.train(quality.measure(docs.repartition(n)), labels.repartition(n)) for n in (1, 5)]
    assert (models[0].weights == models[1].weights).all() and all((a == b).all() for a, b in zip(models[0].steps, models[1].steps))
    votes = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(by_counting(r.text), votes[r.doc_id]) for r in docs.collect() if r.doc_id in votes and zlib.crc32(str(r.doc_id).encode()) % 4 < 2]
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    kernel = quality.Kernel(list(x.mean(0)), list(np.maximum(x.std(0), 1e-3)))
    z = np.sqrt(2 / quality.FEATURES) * np.cos(np.clip((x - kernel.mean) / kernel.spread, -8, 8) @ kernel.w + kernel.b)
    z = np.concatenate((z, np.full((len(z), 1), np.sqrt(2 / quality.FEATURES))), 1)
    penalty = np.diag([quality.RIDGE * len(z)] * quality.FEATURES + [1e-9 * len(z)])
    assert models[0].raw(x) == pytest.approx(z @ np.linalg.solve(z.T @ z + penalty, z.T @ y), abs=0.02)


def test_held_out(tables):
    docs, labels = tables
    got = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    for q in (0, 1):
        assert np.mean([r.predicted == q for k, r in held if k == q]) >= 0.95


def test_labels_of_the_held_out_do_not_count(tables):
    docs, labels = tables
    turned = labels.selectExpr("doc_id", "case when pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2 then 1 - quality else quality end as quality", "toxic")
    a, b = ({r.doc_id: r.score for r in quality.quality(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (1, 0, 0), (3, 0, 0), (5, None, 0), (6, 1, 0), (7, 2, 0), (8, 1, 1), (8, 0, 1), (None, 1, 0), (99, 0, 0)], LABELS)
    assert sorted((r.doc_id, r.label) for r in quality.majority(labels).collect()) == [(1, 1), (3, 0), (6, 1), (99, 0)]
    got = quality.quality(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    assert {r.score for r in quality.quality(odd, labels.filter("false")).collect()} == {0.5}
    assert quality.quality(none, labels).count() == 0
    same = [r.score for r in got if r.doc_id == 1]
    assert len(same) == 2 and len(set(same)) == 1
    empty = {r.doc_id: r.score for r in got if r.doc_id in (2, 3)}
    assert empty[2] == empty[3]
