import random

import numpy as np

from folioweave.llm import gear_chunks as G
from folioweave.llm.common import text_buffer
import pyarrow as pa

from cases import clashing, documents, prose


def chunks(text):
    data, offsets = text_buffer(pa.array([text]))
    _, start, end = G.chunk_bounds(data, offsets)
    raw = text.encode()
    return [raw[a:b] for a, b in zip(start, end)]


def slow_chunks(text):
    raw, out, start = text.encode(), [], 0
    while start < len(raw):
        end, h = start, 0
        while end < len(raw):
            h = (2 * h + int(G._GEAR[raw[end]])) % 2 ** G.WIDTH
            end += 1
            inside = end < len(raw) and raw[end] & 0xC0 == 0x80
            if not inside and (end - start >= G.MOST or end - start >= G.LEAST and h >> (G.WIDTH - G.BITS) == 0):
                break
        out.append(raw[start:end])
        start = end
    return out


def test_chunks_equal_a_rolling_hash():
    for text in [*prose(3, 20, 1, 300), "", "é" * 400, "a" * 1000, "日本" * 300]:
        got = chunks(text)
        assert b"".join(got) == text.encode()
        assert got == slow_chunks(text)
        assert all(c.decode() or True for c in got)


def test_shift_resistance():
    text = prose(4, 1, 400, 401)[0]
    same = set(chunks(text)) & set(chunks("inserted words " + text))
    assert len(same) > 0.8 * len(chunks(text))


def brute(rows):
    """Kept texts in order of (id, text): of equal rows the first keeps its chunks."""
    seen, out, met = set(), [], set()
    for key in sorted(((i, t or "") for i, t in rows), key=lambda k: (k[0] is not None, k[0] or 0)):
        if key in met:
            out.append((key[0], ""))
            continue
        met.add(key)
        cut, before = chunks(key[1]), b""
        marks = []
        for c in cut:
            name = c if len(c) >= G.LEAST else (before, c)
            marks.append(name in seen)
            seen.add(name)
            before = c
        kept, i = [], 0
        while i < len(cut):
            j = i
            while j < len(cut) and marks[j]:
                j += 1
            run = b"".join(cut[i:j])
            if run and not (len(run) >= G.RUN or j - i == len(cut)):
                kept.append(run)
            if j < len(cut):
                kept.append(cut[j])
            i = j + 1
        out.append((key[0], b"".join(kept).decode()))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rng = random.Random(6)
    base = prose(5, 12, 50, 120)
    passage = prose(7, 1, 60, 61)[0]
    texts = [*base, base[3], None, "", "tiny", "tiny", *[t[:rng.randrange(200)] + " " + passage + " tail" for t in base],
             "é" * 300, "x" + "é" * 300]
    ids = [*range(len(texts) - 1), None]
    rows = clashing(documents(spark, texts, ids))
    got = G.dedup_substrings(rows)
    assert got.columns == [c for c in rows.columns if c != "spans"] + ["spans"]
    assert sorted(((r["doc_id"], r["text"] or "") for r in got.collect()), key=repr) == brute(list(zip(ids, texts)))
    assert sum(passage in (r["text"] or "") for r in got.collect()) == 1


def test_empty_table_and_repeated_rows(spark):
    assert G.dedup_substrings(documents(spark, [])).count() == 0
    text = prose(8, 1, 60, 61)[0]
    rows = [(1, text), (1, text), (None, "short one"), (None, "short one"), (None, None), (None, ""), (2, "short one"), (3, "one")]
    got = G.dedup_substrings(documents(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted(((r["doc_id"], r["text"] or "") for r in got), key=repr) == brute(rows)
    assert sum(r["text"] == "short one" for r in got) == 1 and sum(r["text"] == text for r in got) == 1


def test_phrases_stay_and_the_tail_of_a_copy_goes(spark):
    phrase = "a common phrase of forty bytes or so, yes. "
    a, b, c = prose(9, 3, 90, 120, 4000)
    copy = "other words first " + a
    got = {r["doc_id"]: r["text"] for r in G.dedup_substrings(documents(spark, [a, phrase + b, phrase + c, copy])).collect()}
    assert got[0] == a and got[1] == phrase + b and got[2] == phrase + c
    assert len(got[3]) < 18 + 2 * G.MOST and not got[3].endswith(a[-G.LEAST:])
