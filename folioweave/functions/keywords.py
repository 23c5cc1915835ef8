"""Top keywords per text, counted inside the row: no shuffle of the corpus's words and no Python."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from folioweave import fixed_values as V


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value found once: a plain column would be found anew in every lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def top_keywords(text: Column, limit: int = V.KEYWORD_LIMIT) -> Column:
    """Most frequent words first; equal counts keep the order of first appearance. Null has none.

    Words are sorted with their places, so equal ones are neighbours and the first of each run
    holds its first place; a run's length is the distance to the next one's start.
    """
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(V.KEYWORD_PATTERN), F.lit(0))
    words = F.filter(found, lambda w: (F.length(w) > 3) & ~w.isin(*V.STOPWORDS))
    placed = F.array_sort(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("place"))))

    def best(run):
        starts = F.filter(F.transform(run, lambda _, i: i), lambda i: (i == 0) | (
            F.get(run, i)["word"] != F.get(run, i - 1)["word"]))
        counted = _with(starts, lambda s: F.transform(s, lambda i, j: F.struct(
            (i - F.coalesce(F.get(s, j + 1), F.size(run))).alias("fewer"),
            F.get(run, i)["place"].alias("place"), F.get(run, i)["word"].alias("word"))))
        return F.transform(F.slice(F.array_sort(counted), 1, limit), lambda x: x["word"])

    return _with(placed, best)
