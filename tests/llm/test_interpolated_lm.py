import collections
import math
import re
import zlib

import numpy as np

from folioweave.llm import interpolated_lm as L

from cases import clashing, documents, prose

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER)) + [b" "]


def fold(i):
    return 0 if i is None else zlib.crc32(str(i).encode()) % 10


def model(rows, weights):
    """The scores by plain counting, under given weights."""
    train = [tokens(t) for i, t in rows if fold(i)]
    one = collections.Counter(w for ws in train for w in ws)
    two = collections.Counter(p for ws in train for p in zip([b" ", *ws], ws))
    n, v = sum(one.values()), len(one)
    scale = sum(len(tokens(t)) for i, t in rows if fold(i) > 1) / n if n else 1
    out = []
    for i, t in rows:
        ws, total, base = tokens(t), 0.0, 0.0
        for u, w in zip([b" ", *ws], ws):
            c = one[u]
            a = weights[min(int(1 + math.log2(max(c * scale, 1))), L.BUCKETS - 1) if c else 0]
            total += math.log10(a[0] * (two[u, w] / c if c else 0) + a[1] * (one[w] / n if n else 0) + a[2] / (v + 1))
            base += math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1)))
        out.append((i, fold(i) == 0, len(ws), sum(one[w] > 0 for w in ws), n, base, total))
    return sorted(out, key=repr)


def scored(rows):
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_against_plain_counts(spark, monkeypatch):
    texts = [*prose(51, 120, 5, 40, 60), None, "", "A\x0bb\x1cc Ä ä", "A\x0bb\x1cc Ä ä", "long " * 4000]
    ids = [*range(len(texts) - 2), 3, None]
    kept = {}
    real = L.mixture
    monkeypatch.setattr(L, "mixture", lambda *a: kept.setdefault("w", real(*a)))
    got = scored(L.score(clashing(documents(spark, texts, ids))))
    want = model(list(zip(ids, texts)), kept["w"])
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)
    assert np.allclose(kept["w"].sum(axis=1), 1) and kept["w"][0, 0] == 0


def test_ranges_change_nothing_and_held_out_text_gains(spark, monkeypatch):
    texts = [" ".join(f"k{(s + j) % 37}" for j in range(30)) for s in range(200)]
    rows = documents(spark, texts)
    one = scored(L.score(rows))
    monkeypatch.setattr(L, "RANGE_BYTES", 1 << 10)
    two = scored(L.score(rows))
    assert [r[:5] for r in one] == [r[:5] for r in two]
    assert np.allclose([r[5:] for r in one], [r[5:] for r in two])
    held = [r for r in one if r[1]]
    assert sum(r[6] for r in held) > 0.5 * sum(r[5] for r in held)


def test_no_training_text_and_empty_table(spark):
    got = scored(L.score(documents(spark, ["a b", None], [None, None])))
    assert [r[:5] for r in got] == [(None, True, 1, 0, 0), (None, True, 3, 0, 0)]
    assert all(math.isfinite(r[6]) for r in got)
    assert L.score(documents(spark, [])).count() == 0
