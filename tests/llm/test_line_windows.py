from folioweave.llm import line_windows as L

from cases import clashing, documents


def brute(rows):
    """Kept text of every row, in order of (id, text hash): of equal rows the first holds the windows."""
    seen, out = set(), []
    for key in sorted(((i, t or "") for i, t in rows), key=lambda k: (k[0] is not None, k[0] or 0)):
        lines, gone = key[1].split("\n"), set()
        for p in range(len(lines) - 2):
            window = tuple(lines[p:p + 3])
            if window in seen:
                gone.update(range(p, p + 3))
            seen.add(window)
        out.append((key[0] or -1, "\n".join(x for p, x in enumerate(lines) if p not in gone), len(lines), len(gone)))
    return sorted(out)


def check(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = clashing(documents(spark, texts, ids))
    got = L.dedup_lines(rows)
    assert got.columns == [*rows.columns, "n_lines", "n_removed"]
    found = got.select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted((r[0] or -1, r[1] or "", r[2], r[3]) for r in found) == brute(list(zip(ids, texts)))
    return found


def test_windows(spark):
    a, b = "l1\nl2\nl3\nl4", "x\nl1\nl2\nl3\nl4\ny"
    found = check(spark, [a, b, None, "", "a\nb", "a\nb", "q\nq\nq\nq\nq", "\n\n\n", a, "z\nl2\nl3\nl4",
                          "\n".join(f"long {i}" for i in range(3000))])
    assert {r["doc_id"]: r["text"] for r in found}[2] is None


def test_repeated_rows_and_null_ids(spark):
    a = "l1\nl2\nl3"
    check(spark, [a, a, a, "p\n" + a], [4, 4, None, 9])
    check(spark, [a, a, "two\nlines", "two\nlines", None, None], [None] * 6)
    b = "m1\nm2\nm3\nm1\nm2\nm3\nm4"
    check(spark, [b, b, b, "m2\nm3\nm4"], [7, 7, 7, 8])


def test_one_text_of_many_repeated_lines(spark):
    check(spark, ["\n".join(["same"] * 30000), "\n".join(f"{i % 5000}" for i in range(20000))])


def test_empty_table(spark):
    assert L.dedup_lines(documents(spark, [])).count() == 0
