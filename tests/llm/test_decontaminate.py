import random


from folioweave.llm import decontaminate as D

from cases import clashing, documents, prose, words


def items(spark, texts, ids=None):
    return spark.createDataFrame(list(zip(ids or range(len(texts)), texts)), "item_id long, text string")


def slow_words(text):
    out, now = [], ""
    for c in (text or "").lower():
        if c.isascii() and not c.isalnum():
            out, now = ([*out, now] if now else out), ""
        else:
            now += c
    return [*out, now] if now else out


def slow_distance(want, have):
    row = [0] * (len(have) + 1)
    for i, w in enumerate(want, 1):
        new = [i]
        for j, x in enumerate(have, 1):
            new.append(min(row[j - 1] + (w != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def brute(docs, wanted):
    out = {}
    for d, text in docs:
        have = slow_words(text)
        for i, item in wanted:
            want = slow_words(item)
            if want:
                distance = slow_distance(want, have)
                if distance <= int(len(want) * 0.2 + 1e-9):
                    out[(d, i)] = distance
    return out


def edited(rng, want, edits):
    w = list(want)
    for _ in range(edits):
        p = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[p] = f"w{rng.randrange(400)}"
        elif kind == 1 and len(w) > 1:
            del w[p]
        else:
            w.insert(p, f"w{rng.randrange(400)}")
    return w


def test_against_brute_force(spark):
    rng = random.Random(11)
    wanted = [*prose(12, 12, 14, 60), "one two three", "Édition spéciale, numéro un", None, "", "..."]
    docs = [None, "", "no passage", " ".join(words(rng, 5000)), "x one TWO, three y", "une édition spéciale numéro un"]
    for item in wanted[:12]:
        for share in (0, 0.05, 0.1, 0.2, 0.4):
            w = item.split()
            docs.append(" ".join(words(rng, rng.randrange(40)) + edited(rng, w, int(share * len(w)))
                                 + words(rng, rng.randrange(40))))
    found = D.find(clashing(documents(spark, docs)), items(spark, wanted)).collect()
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in found}
    want = brute(list(enumerate(docs)), list(enumerate(wanted)))
    assert set(got) <= set(want)
    assert len(got) >= 0.99 * len(want)
    assert all(got[k] >= want[k] for k in got) and sum(got[k] == want[k] for k in got) >= 0.95 * len(got)


def test_spans_ties_and_repeated_rows(spark):
    item = prose(13, 1, 20, 21)[0]
    docs = documents(spark, [f"a b {item} c {item}"] * 2, [None, None])
    rows = D.find(docs, items(spark, [item, item], [4, 4])).collect()
    assert [(r["first_word"], r["end_word"], r["similarity"]) for r in rows] == [(2, 22, 1.0)] * 2


def test_clean_and_empty_tables(spark):
    item = prose(14, 1, 20, 21)[0]
    docs = clashing(documents(spark, [f"a {item}", None, "", "clean words here"]))
    kept = D.clean(docs, items(spark, [item]))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3]
    assert D.clean(docs, items(spark, [])).count() == 4
    assert D.find(documents(spark, []), items(spark, [item])).count() == 0
    assert D.find(docs, items(spark, [])).count() == 0


def test_nearest_stretch():
    rng = random.Random(3)
    for _ in range(50):
        want, have = words(rng, 6, 5), words(rng, 12, 5)
        distance, first, end = D.nearest_stretch(want, have)
        assert distance == slow_distance(want, have)
        assert slow_distance(want, have[first:end]) == distance
