from array import array
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from folioweave.llm import piece_lattice as P

from cases import clashing, documents, prose


@pytest.fixture(scope="module")
def pieces():
    return P.Pieces(public_tokenizers.path(P.MODEL))


def every(pieces, text):
    whole = (P.SPACE + text.replace(" ", P.SPACE)) if text else ""
    into = pieces.lattice(whole)

    def walk(j):
        if j == 0:
            yield 0.0, ()
        for i, ids, s in into[j]:
            for score, before in walk(i):
                yield score + s, before + ids
    return sorted(walk(len(whole)), key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["", " ", "hello", "a  b", " the thing.", "x\ny ê日", "an anand", "ab. c\n\nd", "\n", "q\n z"])
def test_n_best_against_all_segmentations(pieces, text):
    want = every(pieces, text)
    for n in (1, 4, 7):
        (ids, best), = pieces.encode([text], n)
        assert [s for s, *_ in best] == [s for s, _ in want[:n]]
        scores = {zlib.crc32(array("I", i).tobytes()): s for s, i in want}
        assert [scores[c] for *_, c in best] == [s for s, *_ in best]
        assert len({c for *_, c in best}) == len(best)
        assert best[0][2] == zlib.crc32(ids) and best[0][1] == len(ids) // 4
        assert pieces.decode(np.frombuffer(ids, np.uint32)) == text


def test_queue_order_equals_sorted_scores(pieces):
    got = [s for s, _ in pieces.n_best("▁internationalisation", 50)]
    assert got == [s for s, _ in every(pieces, "internationalisation")[:50]]


def test_a_full_memory_changes_nothing(pieces, monkeypatch):
    texts = [*prose(3, 10), "one two. three", "日本 語", "a\nb c"]
    want = [list(pieces.encode([t])) for t in texts]
    monkeypatch.setattr(P, "REMEMBERED", 5)
    small = P.Pieces(public_tokenizers.path(P.MODEL))
    assert [list(small.encode([t])) for t in texts + texts] == want + want


def test_short_units_are_solved_together(pieces, monkeypatch):
    rng = random.Random(6)
    letters = "abcdeéà日本語🙂\n.,;▁ 123'-\x00ßж"
    units = ["", "\n", "▁the", *("".join(rng.choice(letters) for _ in range(rng.randrange(1, 70))) for _ in range(400))]
    want = [pieces.best_and_gap(u) for u in units]
    small = P.Pieces(public_tokenizers.path(P.MODEL))
    one_by_one = []
    monkeypatch.setattr(small, "best_and_gap", lambda u: one_by_one.append(u) or pieces.best_and_gap(u))
    for cells in (1, 1000, P.CELLS):
        monkeypatch.setattr(P, "CELLS", cells)
        assert list(zip(*small.solve(units))) == want
    assert {len(u) > P.SHORT for u in one_by_one} == {True}


def test_long_units_fall_into_parts(pieces, monkeypatch):
    texts = ["日本語🙂." * 40, "a.b;c-d" * 30 + " word " + "日本語🙂." * 40, "z" * 200]
    for limit in (0, P.REMEMBERED):
        monkeypatch.setattr(P, "REMEMBERED", limit)
        small = P.Pieces(public_tokenizers.path(P.MODEL))
        for _ in range(2):
            for text, (ids, best) in zip(texts, small.encode(texts)):
                whole, total, gap = pieces.best_and_gap(P.SPACE + text.replace(" ", P.SPACE))
                assert (ids, best[0][0]) == (whole, total)
                assert [s for s, *_ in best[1:2]] == [total - gap] * (gap < np.inf)


def test_documents(spark, pieces):
    texts = [None, "", "two words", "two words", "▁ literal", "x" * 3000, " ".join(prose(4, 30, 50, 90))]
    got = P.segment(clashing(documents(spark, texts, [0, None, 2, 2, 4, 5, 6]))).collect()
    assert len(got) == len(texts) and all(r["round_trip"] for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["ids"] == [] and [tuple(b) for b in by_id[0]["best"]] == [(0.0, 0, 0)]
    assert all(len(r["best"]) == 4 for r in got if r["doc_id"] in (2, 4, 5, 6))
    assert P.segment(documents(spark, [])).count() == 0


def test_all_segmentations_leave_with_their_ids_and_decode(spark, pieces):
    texts = [None, "", "hello", "a  b", " the thing.", "x\ny ê日", "an anand", "an anand", "q\n z", *prose(5, 3)]
    ids = [0, None, 2, 3, 4, 5, 6, 6, *range(8, len(texts))]
    found = P.segment(documents(spark, texts, ids))
    rows = P.decode(P.alternatives(found).withColumnRenamed("ids", "units"), "units").collect()
    best = {r["doc_id"]: r["best"] for r in found.collect()}
    for i, t in zip(ids, texts):
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["rank"])[::texts.count(t) if t else 1]
        assert [(r["score"], len(r["units"]), zlib.crc32(array("I", r["units"]).tobytes())) for r in mine] == [
            tuple(b) for b in best[i]]
        assert {r["text"] for r in mine} == {t or ""}
        if len(t or "") < 12:
            want = dict((u, s) for s, u in every(pieces, t or ""))
            assert [want[tuple(r["units"])] for r in mine] == [r["score"] for r in mine]
    other = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r["text"] for r in P.decode(other).collect()] == [None, ""]
