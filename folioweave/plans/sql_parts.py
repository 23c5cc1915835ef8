"""SQL building blocks of the oracles, written for DuckDB."""

from __future__ import annotations

from folioweave import fixed_values as V
from folioweave.plans import corpus

WS_TEXT = "'" + V.WHITESPACE_CHARACTERS + "'"
WS_BODY = (r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
           r"\x{202f}\x{205f}\x{3000}")
WS = f"[{WS_BODY}]"
LF, CR, NBSP, TAB, NUL, VT = "chr(10)", "chr(13)", "chr(160)", "chr(9)", "chr(0)", "chr(11)"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WS_TEXT})"


def blank(x: str) -> str:
    return f"(length({strip(x)}) = 0)"


def squeeze(x: str) -> str:
    return strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def clean(x: str) -> str:
    """Line-by-line cleanup, as a check on the whole-text form."""
    flat = (f"replace(replace(replace(replace({x}, {NUL}, ''), {CR}||{LF}, {LF}), {CR}, {LF}), "
            f"{NBSP}, ' ')")
    line = strip("regexp_replace(l, '[ \\t]+', ' ', 'g')")
    joined = f"array_to_string(list_transform(string_split({flat}, {LF}), lambda l: {line}), {LF})"
    return strip(f"regexp_replace({joined}, '\\n{{3,}}', {LF}||{LF}, 'g')")


def sql_text(value: str) -> str:
    """A string literal whose control characters are spelled with chr()."""
    parts, plain = [], ""
    for ch in value:
        if ch < " " or ch == "\u00a0":
            if plain:
                parts.append(quoted(plain))
                plain = ""
            parts.append(f"chr({ord(ch)})")
        else:
            plain += ch
    if plain:
        parts.append(quoted(plain))
    return "(" + " || ".join(parts) + ")"


def noise(x: str) -> str:
    for old, new in corpus.NOISE:
        x = f"replace({x}, {quoted(old)}, {sql_text(new)})"
    return f"('  ' || {x})"


PAPER_ID = ("printf('%04d.%05dv%d', (doc_id // 100000) % 10000, doc_id % 100000, "
            "1 + doc_id // 1000000000)")


def abstract(x: str) -> str:
    whole = f"replace({x}, {NUL}, ' ')"
    word = r"(?:^|[^\pL\pN_])"
    edge = r"(?:$|[^\pL\pN_])"
    pattern = (rf"(?is){word}abstract(?:[{WS_BODY}:.\-—]+|$|(?:[^\pL\pN_]))"
               r"(.*?)" + rf"(?:\n{WS}*(?:1\.?{WS}+)?introduction{edge}|\n{WS}*keywords{edge}"
               rf"|\n{WS}*1\.{WS})")
    body = squeeze(f"regexp_extract({whole}, '{pattern}', 1)")
    return (f"substring(CASE WHEN length({body}) > 0 THEN {body} ELSE {squeeze(whole)} END, "
            f"1, {V.ABSTRACT_LIMIT})")


HEAD = strip(f"substring({squeeze('string_split(text, chr(10))[1]')}, 1, 80)")

DESCRIBED = f"""
described AS (
  SELECT doc_id, text, lang, source, {PAPER_ID} AS paper_id,
         'v' || (1 + doc_id // 1000000000) AS paper_version,
         CASE WHEN length({HEAD}) > 0 THEN {HEAD} ELSE 'Paper ' || {PAPER_ID} END AS title,
         ['Author ' || source, 'Editor ' || lang] AS authors,
         strftime(DATE '2024-01-01' + CAST(doc_id % 366 AS INTEGER), '%Y-%m-%d') AS published,
         'https://arxiv.org/pdf/' || {PAPER_ID} AS pdf_url,
         'data/' || source || '/' || {PAPER_ID} || '.pdf' AS source_path,
         'https://arxiv.org/abs/' || {PAPER_ID} AS url
  FROM documents)"""

_LINES = corpus.LINES_PER_PAGE
RAW_PAGES = DESCRIBED + f""",
bodies AS (
  SELECT * EXCLUDE (text),
         list_transform(range(0, (len(string_split(text, {LF})) - 1) // {_LINES} + 1),
           lambda g: {noise(f"array_to_string(string_split(text, {LF})[g * {_LINES} + 1:g * {_LINES} + {_LINES}], {LF})")})
         || CASE WHEN lang = 'de' THEN [{sql_text(corpus.BLANK_PAGE)}] ELSE [] END AS body
  FROM described),
raw_pages AS (
  SELECT * EXCLUDE (body), unnest(range(1, len(body) + 1)) AS page_number,
         unnest(body) AS raw_text FROM bodies)"""

PAGES = RAW_PAGES + f""",
paper_pages AS (SELECT * EXCLUDE (raw_text), {clean('raw_text')} AS text FROM raw_pages)"""

REQUESTED = """
withheld AS (SELECT DISTINCT printf('9999.%05dv1', item_id) AS paper_id, item_id % 3 AS reason FROM benchmark),
requested AS (SELECT paper_id, source FROM described UNION ALL SELECT paper_id, 'withheld' FROM withheld),
requested_pages AS (SELECT paper_id, text FROM paper_pages
  UNION ALL SELECT paper_id, '' FROM withheld WHERE reason = 2)"""


def fixed_chunks(size: int = 1800, overlap: int = 200, pages: str = "paper_pages",
                 name: str = "spans") -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (text, s), s AS start_character,
         least(s + {size}, length(text)) AS end_character,
         substring(text, s + 1, {size}) AS text, sha256(text) AS page_text_sha256
  FROM (SELECT *, unnest(range(0, greatest(length(text) - {overlap}, 1), {size - overlap})) AS s
        FROM {pages} WHERE NOT {blank('text')}))"""


def boundary_chunks(size: int = 1800, overlap: int = 200, pages: str = "paper_pages",
                    name: str = "spans") -> str:
    def end(start: str) -> str:
        window = f"substring(text, {start} + 1, {size})"
        def found(pattern):
            return f"length(regexp_extract({window}, '(?s)^(.*{pattern})', 1))"
        para, sent, space = (found(p) for p in (
            rf"\n{WS}*\n", rf"[.!?][\"'')\]]*{WS}+", WS))
        least = overlap + 1
        return f"""CASE WHEN {start} + {size} >= length(text) THEN length(text)
          WHEN {para} >= {least} THEN {start} + {para}
          WHEN {sent} >= {least} THEN {start} + {sent}
          WHEN {blank(f'substring(text, {start} + {size} + 1, 1)')} THEN {start} + {size}
          WHEN {space} >= {least} THEN {start} + {space}
          ELSE {start} + {size} END"""
    return f"""
walk AS (
  SELECT paper_id, page_number, text, 0::BIGINT AS s, ({end('0')})::BIGINT AS e
  FROM {pages} WHERE NOT {blank('text')}
  UNION ALL
  SELECT paper_id, page_number, text, e - {overlap}, ({end(f'(e - {overlap})')})::BIGINT
  FROM walk WHERE e < length(text)),
{name} AS (
  SELECT p.* EXCLUDE (text), w.s AS start_character, w.e AS end_character,
         substring(w.text, w.s + 1, w.e - w.s) AS text, sha256(w.text) AS page_text_sha256
  FROM walk w JOIN {pages} p USING (paper_id, page_number))"""


def token_chunks(budget: int = 200, overlap: int = 40, pages: str = "paper_pages",
                 name: str = "spans") -> str:
    """Whitespace-separated tokens; their counts never need the shrinking step."""
    word = f"[^{WS_BODY}]+"

    def limit(start):
        return (f"CASE WHEN len(list_filter(ends, lambda x: x > {start})) > {budget} "
                f"THEN list_filter(ends, lambda x: x > {start})[{budget}] ELSE length(text) END")

    def found(pattern):
        window = "substring(text, s + 1, hard - s)"
        return f"length(regexp_extract({window}, '(?s)^(.*{pattern})', 1))"
    para, sent, space = (found(p) for p in (
        rf"\n{WS}*\n", rf"[.!?][\"'')\]]*{WS}+", WS))
    end = f"""CASE WHEN hard >= length(text) THEN length(text) WHEN {para} >= 1 THEN s + {para}
      WHEN {sent} >= 1 THEN s + {sent}
      WHEN {blank('substring(text, hard + 1, 1)')} THEN hard
      WHEN {space} >= 1 THEN s + {space} ELSE hard END"""
    inside = "list_filter(starts, lambda x: x >= s AND x < e)"
    # A window that begins inside a token counts the rest of it as its first token.
    all_in = (f"CASE WHEN {blank('substring(text, s + 1, 1)')} OR list_contains(starts, s) "
              f"THEN {inside} ELSE list_prepend(s, {inside}) END")
    back = f"""CASE WHEN len({all_in}) = 0 THEN e ELSE greatest(s + 1,
      ({all_in})[greatest(len({all_in}) - {overlap - 1}, 1)]) END"""
    return f"""
pieces AS (SELECT paper_id, page_number, text, regexp_extract_all(text, '{WS}*{word}') AS parts
  FROM {pages} WHERE NOT {blank('text')}),
laid AS (SELECT paper_id, page_number, text,
    list_transform(range(1, len(parts) + 1), lambda i: length(array_to_string(parts[1:i], ''))) AS ends,
    list_transform(parts, lambda x: length(trim(x, {WS_TEXT}))) AS sizes FROM pieces),
marked AS (SELECT paper_id, page_number, text, ends,
    list_transform(range(1, len(ends) + 1), lambda i: ends[i] - sizes[i]) AS starts FROM laid),
walk AS (
  SELECT *, ({end})::BIGINT AS e FROM (
    SELECT paper_id, page_number, text, ends, starts, 0::BIGINT AS s, ({limit('0')})::BIGINT AS hard
    FROM marked)
  UNION ALL
  SELECT *, ({end})::BIGINT AS e FROM (
    SELECT paper_id, page_number, text, ends, starts, s, ({limit('s')})::BIGINT AS hard FROM (
      SELECT paper_id, page_number, text, ends, starts, ({back})::BIGINT AS s FROM walk WHERE e < length(text)))),
{name} AS (
  SELECT p.* EXCLUDE (text), w.s AS start_character, w.e AS end_character,
         substring(w.text, w.s + 1, w.e - w.s) AS text, sha256(w.text) AS page_text_sha256,
         len(regexp_extract_all(substring(w.text, w.s + 1, w.e - w.s), '{word}')) AS tokens
  FROM walk w JOIN {pages} p USING (paper_id, page_number))"""


def chunk_id(profile_hash: str, source: str = "") -> str:
    def js(x):
        return f"replace(to_json({x})::VARCHAR, '\\u000B', '\\u000b')"
    authors = f"'[' || {js(source + 'authors[1]')} || ',' || {js(source + 'authors[2]')} || ']'"
    json = (f"'{{\"authors\":' || {authors} || ',\"chunking_profile_sha256\":\"{profile_hash}\""
            f",\"end_character\":' || {source}end_character || ',\"page_number\":' || "
            f"{source}page_number || ',\"page_text_sha256\":\"' || {source}page_text_sha256 || "
            f"'\",\"paper_id\":\"' || {source}paper_id || '\",\"paper_version\":\"' || "
            f"{source}paper_version || '\",\"pdf_url\":\"' || {source}pdf_url || "
            f"'\",\"published\":\"' || {source}published || '\",\"start_character\":' || "
            f"{source}start_character || ',\"text\":' || {js(source + 'text')} || ',\"title\":' || "
            f"{js(source + 'title')} || '}}'")
    return (f"{source}paper_id || ':' || printf('p%04d', {source}page_number) || ':' || "
            f"sha256({json})")


def cosine(a: str, b: str) -> str:
    return f"list_cosine_similarity({a}::DOUBLE[], {b}::DOUBLE[])"
