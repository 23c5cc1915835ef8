"""Row-level span rules used inside Arrow batches.

A page's spans depend on each other (each start follows from the previous end), so they
are found by one forward pass per page. Pages are independent of each other.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
import re

from folioweave import fixed_values as V

# A greedy prefix lands on the last break of its kind inside the window.
_LAST_BREAK = [re.compile("(?s:.*)(?:" + pattern + ")") for pattern in V.BREAK_PATTERNS]


def last_break(text: str, start: int, limit: int, least: int) -> int:
    """The strongest usable break in ``(start, limit]``; ``limit`` itself if none."""
    if limit >= len(text):
        return limit
    *strong, space = _LAST_BREAK
    for pattern in strong:
        found = pattern.match(text, start, limit)
        if found and found.end() >= least:
            return found.end()
    if text[limit].isspace() and limit >= least:
        return limit
    found = space.match(text, start, limit)
    return found.end() if found and found.end() >= least else limit


def boundary_spans(text: str, size: int, overlap: int) -> Iterator[tuple]:
    start, length = 0, len(text)
    while True:
        end = last_break(text, start, min(start + size, length), start + overlap + 1)
        yield start, end, None, None
        if end >= length:
            return
        start = end - overlap


# A look-ahead begins with so many characters; so many equal tokens in a row are agreement.
_LOOK_AHEAD, _AGREEING = 96, 4


def _agreement(own: list[tuple], page: list[tuple], starts: list[int]) -> tuple[int, int] | None:
    """Where a row of tokens first equals one of the page's: positions in both.

    The last two tokens of a look-ahead are left out, as its end may have cut them.
    """
    for i in range(len(own) - 2 - _AGREEING):
        j = bisect_left(starts, own[i][0])
        if page[j:j + _AGREEING] == own[i:i + _AGREEING]:
            return i, j
    return None


def _reach(text: str, start: int, page: list[tuple], starts: list[int], tokenizer, budget: int) -> int:
    """Where the ``budget``-th token of the text from ``start`` on ends; the text's end if none follows.

    A tokenizer that starts inside a token of the page gives other tokens, but only for a while: tokens
    of whole words, and a merged word's tokens between two common bounds, do not depend on what
    lies beyond. So a short stretch is encoded, twice as long each time until it runs along the tokens
    of the whole page, which then go on; a stretch that never does ends with the text.
    """
    ahead = _LOOK_AHEAD
    while True:
        stop = min(start + ahead, len(text))
        own = [(a + start, b + start) for a, b in tokenizer.measure(text[start:stop]).spans]
        if stop == len(text):
            return own[budget - 1][1] if len(own) > budget else stop
        met = _agreement(own, page, starts)
        if met:
            mine, theirs = met
            if mine + len(page) - theirs <= budget:
                return len(text)
            return own[budget - 1][1] if budget <= mine else page[theirs + budget - mine - 1][1]
        ahead *= 2


def _fitting(text: str, start: int, stop: int, tokenizer, budget: int, ceiling: int):
    """The first end at or before ``stop`` whose slice is within both budgets, and its measure.

    A slice may have more tokens than a longer one, so every end is tried on the way down.
    """
    for end in range(stop, start, -1):
        found = tokenizer.measure(text[start:end])
        if found.content <= budget and found.complete <= ceiling:
            return end, found
    raise ValueError("one character is more than the token budget")


def _spans_of_words(text: str, words, budget: int, overlap: int, ceiling: int) -> Iterator[tuple]:
    """``token_spans`` by the tokens of words; such tokenizers add no special tokens."""
    start, most = 0, min(budget, ceiling)
    while start < len(text):
        rest = words.rest(start)
        stop = last_break(text, start, max(rest.reach(budget), start + 1), start + 1)
        for stop in range(stop, start, -1):
            count, kept = rest.measured(stop, overlap)
            if count <= most:
                break
        else:
            raise ValueError("one character is more than the token budget")
        yield start, stop, count, count
        if stop == len(text):
            return
        start = stop if kept is None else max(start + 1, kept)


def token_spans(text: str, tokenizer, budget: int, overlap: int, ceiling: int) -> Iterator[tuple]:
    """Spans of at most ``budget`` tokens whose slices were measured on their own.

    A span reaches as far as the tokens of the text from its start on allow; the page is encoded
    once, and each start only until its tokens meet the page's. A tokenizer that lays a page out in
    ``words`` measures slices by them.
    """
    words = tokenizer.words(text) if hasattr(tokenizer, "words") else None
    if words is not None:
        yield from _spans_of_words(text, words, budget, overlap, ceiling)
        return
    page = tokenizer.measure(text).spans
    starts, start = [a for a, _ in page], 0
    while start < len(text):
        reach = _reach(text, start, page, starts, tokenizer, budget)
        stop = last_break(text, start, max(reach, start + 1), start + 1)
        stop, measure = _fitting(text, start, stop, tokenizer, budget, ceiling)
        yield start, stop, measure.content, measure.complete
        if stop == len(text):
            return
        kept = measure.spans[-overlap:] if overlap else []
        # the next span repeats the last tokens, but never begins where this one began
        start = max(start + 1, start + kept[0][0]) if kept else stop
