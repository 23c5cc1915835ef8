"""Text functions as native column expressions.

White space is always the explicit 29-point class, because the engines' own notions of
``\\s`` and ``trim`` differ from each other.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from folioweave import fixed_values as V

WS = f"[{V.WHITESPACE_CLASS_BODY}]"
# A word character in the Unicode sense, and zero-width tests for its edges.
WORD = r"\p{L}\p{N}_"
EDGE_BEFORE = rf"(?<![{WORD}])"
EDGE_AFTER = rf"(?![{WORD}])"


def strip(text: Column) -> Column:
    """Unicode strip of both ends."""
    return F.btrim(text, F.lit(V.WHITESPACE_CHARACTERS))


def is_blank(text: Column) -> Column:
    return F.length(strip(F.coalesce(text, F.lit("")))) == 0


def squeeze(text: Column) -> Column:
    """Every run of white space becomes one space; ends are trimmed."""
    return strip(F.regexp_replace(text, WS + "+", " "))


def clean_text(raw: Column) -> Column:
    """Layout-safe cleanup of extracted page text.

    NUL is dropped, line ends and NBSP are unified, tabs/spaces collapse, every line is
    stripped and blank-line runs shrink to one.
    """
    text = F.coalesce(raw, F.lit(""))
    for old, new in (("\x00", ""), ("\r\n", "\n"), ("\r", "\n"), ("\u00a0", " ")):
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.array_join(F.transform(F.split(text, "\n"), lambda line: strip(line)), "\n")
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def snippet(text: Column, width: int) -> Column:
    return F.substring(squeeze(text), 1, width)


def shorten(label: Column, width: int = 40) -> Column:
    """Chart label: over-long labels end in an ellipsis and never in white space."""
    cut = F.rtrim(F.substring(label, 1, width - 1))
    cut = F.regexp_replace(cut, WS + r"+\z", "")
    return F.when(F.length(label) <= width, label).otherwise(F.concat(cut, F.lit("…")))


# ---- titles -------------------------------------------------------------------

def title_from_filename(name: Column) -> Column:
    stem = F.regexp_replace(name, r"(?i)\.pdf\z", "")
    mark = F.instr(stem, "_")
    stem = F.when(mark > 0, F.substring(stem, mark + 1, F.length(stem))).otherwise(stem)
    stem = F.regexp_replace(stem, r"v\d+\z", "")
    return strip(F.regexp_replace(stem, "[-_]+", " "))


def clean_title(metadata_title: Column, filename: Column) -> Column:
    """Document metadata wins unless it is missing, odd in length or a tool's leftover."""
    title = squeeze(metadata_title)
    low = F.lower(title)
    junk = F.lit(False)
    for hint in V.BAD_TITLE_HINTS:
        junk = junk | F.contains(low, F.lit(hint))
    usable = title.isNotNull() & F.length(title).between(5, 200) & ~junk
    return F.when(usable, title).otherwise(title_from_filename(filename))


def conversation_title(reply: Column) -> Column:
    """Sidebar title from a model reply: no quotes, no final dots, 80 points at most."""
    bare = F.btrim(strip(reply), F.lit("\"'"))
    bare = F.regexp_replace(bare, r"\.+\z", "")
    bare = F.substring(bare, 1, 80)
    return F.when(F.length(bare) > 0, bare).otherwise(F.lit(V.UNTITLED))


# ---- abstract, words, keywords, theme -----------------------------------------

def extract_abstract(text: Column, limit: int = V.ABSTRACT_LIMIT) -> Column:
    """The passage between an abstract heading and the next section heading.

    Without such a passage the start of the text stands in for it.
    """
    whole = F.replace(text, F.lit("\x00"), F.lit(" "))
    head = rf"{EDGE_BEFORE}abstract{EDGE_AFTER}[{V.WHITESPACE_CLASS_BODY}:.\-—]*"
    stop = (rf"(?=\n{WS}*(?:1\.?{WS}+)?introduction{EDGE_AFTER}"
            rf"|\n{WS}*keywords{EDGE_AFTER}|\n{WS}*1\.{WS})")
    body = squeeze(F.regexp_extract(whole, rf"(?isu){head}(.*?){stop}", 1))
    return F.substring(F.when(F.length(body) > 0, body).otherwise(squeeze(whole)), 1, limit)


def word_count(text: Column) -> Column:
    """Words with inner hyphens, over the whole text."""
    return F.regexp_count(text, F.lit(rf"-*[{WORD}][{WORD}\-]*")).cast("long")


def theme(title: Column, abstract: Column) -> Column:
    """The theme with most keywords present; ties go to the theme listed first."""
    combined = F.lower(F.concat_ws(" ", title, abstract))
    scored = []
    for position, (name, keywords) in enumerate(V.THEMES):
        score = F.lit(0)
        for keyword in keywords:
            # The cheap substring test keeps the regex off nearly every row.
            present = F.contains(combined, F.lit(keyword)) & F.regexp_like(
                combined, F.lit(rf"(^|[^{WORD}]){keyword}($|[^{WORD}])"))
            score = score + present.cast("int")
        scored.append(F.struct(score.alias("score"), F.lit(-position).alias("order"),
                               F.lit(name).alias("name")))
    best = F.array_max(F.array(*scored))
    return F.when(best["score"] > 0, best["name"]).otherwise(F.lit(V.DEFAULT_THEME))
