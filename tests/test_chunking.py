import pathlib
import random
import re

import pytest

from folioweave.functions.spans import boundary_spans, token_spans
from folioweave.operators import contracts
from folioweave.operators.chunking import ChunkSettings, chunk_pages
from folioweave.sources.tokenizer import JsonTokenizer, PatternTokenizer
from tests import fixtures


def spans(spark, texts, settings, tokenizer=None):
    rows = chunk_pages(fixtures.pages(spark, *texts), settings, tokenizer).orderBy(
        "page_number", "start_character").collect()
    out = [[] for _ in texts]
    for r in rows:
        out[r["page_number"] - 1].append((r["start_character"], r["end_character"], r["text"]))
    return out


def test_fixed_golden(spark):
    settings = ChunkSettings("fixed_characters", 6, 2)
    assert spans(spark, ["abcdefghij"], settings) == [[(0, 6, "abcdef"), (4, 10, "efghij")]]


def test_boundary_prefers_paragraphs(spark):
    found = spans(spark, ["alpha\n\nbeta gamma delta"], ChunkSettings("boundary_characters", 15, 2))[0]
    assert found[0] == (0, 7, "alpha\n\n") and found[1][0] == 5


def test_blank_pages_give_nothing(spark):
    for profile in ("fixed_characters", "boundary_characters"):
        assert spans(spark, ["", " \n\t", "x"], ChunkSettings(profile, 6, 2)) == [[], [], [(0, 1, "x")]]


TEXTS = ["😀é" * 9, "a" * 37, "a" + " " * 19 + "b", " a\n\nb\t c ", "One. Two!  Three?\n\n Four"]


@pytest.mark.parametrize("size, overlap", [(s, o) for s in (1, 2, 6) for o in range(s)])
def test_full_coverage_for_every_budget(spark, size, overlap):
    for profile in ("fixed_characters", "boundary_characters"):
        for text, found in zip(TEXTS, spans(spark, TEXTS, ChunkSettings(profile, size, overlap))):
            covered = set()
            for start, end, part in found:
                assert text[start:end] == part and 0 < end - start <= size
                covered.update(range(start, end))
            assert covered == set(range(len(text)))
            assert all(b[0] == a[1] - overlap for a, b in zip(found, found[1:]))


def plain_boundary(text, size, overlap):
    """Breaks listed one by one, as a check on the search from the window's end."""
    out, start = [], 0
    while True:
        end = min(start + size, len(text))
        if end < len(text):
            least = start + overlap + 1
            for kind in (r"\n\s*\n", "[.!?][\"')\\]]*\\s+", r"\s+"):
                stops = [start + m.end() for m in re.finditer(kind, text[start:end])]
                if kind == r"\s+" and text[end].isspace():
                    stops.append(end)
                stops = [s for s in stops if s >= least]
                if stops:
                    end = stops[-1]
                    break
        out.append((start, end))
        if end == len(text):
            return out
        start = end - overlap


def test_boundary_spans_against_listing():
    pick = random.Random(11)
    for _ in range(20000):
        text = "".join(pick.choice("ab .!\n\n\t\"' ") for _ in range(pick.randint(1, 40)))
        size = pick.randint(1, 12)
        overlap = pick.randint(0, size - 1)
        assert [s[:2] for s in boundary_spans(text, size, overlap)] == plain_boundary(text, size, overlap), (text, size, overlap)


@pytest.mark.parametrize("bad", [
    {"size": 0}, {"size": True}, {"overlap": -1}, {"size": 5, "overlap": 5}, {"profile": "other"},
    {"token_budget": 300}, {"token_overlap": 200}])
def test_bad_settings(bad):
    with pytest.raises(ValueError):
        ChunkSettings(**bad)


def test_tokenizer_profile_needs_a_tokenizer(spark):
    with pytest.raises(ValueError):
        chunk_pages(fixtures.pages(spark, "a"), ChunkSettings("tokenizer"))


def test_pattern_token_spans_respect_budgets():
    pick = random.Random(5)
    tokenizer = PatternTokenizer(special_tokens=2)
    for _ in range(3000):
        text = "".join(pick.choice("ab .\n") for _ in range(pick.randint(1, 60)))
        if not text.strip():
            continue
        budget = pick.randint(1, 5)
        found = list(token_spans(text, tokenizer, budget, pick.randint(0, budget - 1), budget + 2))
        covered = set()
        for start, end, content, complete in found:
            assert content == len(text[start:end].split()) <= budget and complete == content + 2
            covered.update(range(start, end))
        assert covered == set(range(len(text)))
        starts = [f[0] for f in found]
        assert starts == sorted(set(starts))


def word_piece():
    tokenizers = pytest.importorskip("tokenizers")
    from tokenizers import models, normalizers, pre_tokenizers, processors
    words = {w: i for i, w in enumerate(["[UNK]", "[CLS]", "[SEP]", "a", "b", "c", "é"])}
    built = tokenizers.Tokenizer(models.WordPiece(words, unk_token="[UNK]"))
    built.normalizer, built.pre_tokenizer = normalizers.NFC(), pre_tokenizers.Whitespace()
    built.post_processor = processors.TemplateProcessing(
        single="[CLS] $A [SEP]", special_tokens=[("[CLS]", 1), ("[SEP]", 2)])
    return JsonTokenizer(built.to_str().encode(), "tiny", "1")


def test_json_tokenizer_chunks(spark):
    tokenizer = word_piece()
    assert tokenizer.measure("a b")[1:] == (2, 4)
    settings = ChunkSettings("tokenizer", token_budget=3, token_overlap=1, max_input_tokens=5)
    text = "a b c a b c"
    found = spans(spark, [text], settings, tokenizer)[0]
    assert found[0][2].strip() == "a b c" and found[1][0] == 4
    chunks = chunk_pages(fixtures.pages(spark, text), settings, tokenizer)
    assert contracts.chunk_violations(chunks, fixtures.pages(spark, text)).count() == 0
    with pytest.raises(ValueError):
        JsonTokenizer(b"{}", "m", "r")
    with pytest.raises(ValueError):
        JsonTokenizer(tokenizer.asset, " ", "r")
    with pytest.raises(ValueError):
        list(token_spans("a", tokenizer, 1, 0, 1))


def plain_token_spans(text, tokenizer, budget, overlap, ceiling):
    """Every span from the whole remainder's own tokens, as a check on the short look-aheads."""
    from folioweave.functions.spans import last_break
    out, start = [], 0
    while start < len(text):
        ends = [b for _, b in tokenizer.measure(text[start:]).spans]
        reach = len(text) if len(ends) <= budget else start + ends[budget - 1]
        stop = last_break(text, start, reach, start + 1)
        while True:
            spans, content, complete = tokenizer.measure(text[start:stop])
            if content <= budget and complete <= ceiling:
                break
            stop -= 1
        out.append((start, stop, content, complete))
        if stop == len(text):
            break
        kept = spans[-overlap:] if overlap else []
        start = max(start + 1, start + kept[0][0]) if kept else stop
    return out


def larger_word_piece(texts):
    """A vocabulary of the texts' characters and some of their word starts and word ends."""
    tokenizers = pytest.importorskip("tokenizers")
    from tokenizers import models, normalizers, pre_tokenizers
    words = sorted({w.lower() for t in texts for w in re.findall(r"\w+", t)})
    pieces = ["[UNK]", *sorted({c for w in words for c in (w[0], *("##" + x for x in w[1:]))}),
              *sorted({w[:3] for w in words[::2]}), *sorted({"##" + w[-3:] for w in words[::3]})]
    built = tokenizers.Tokenizer(models.WordPiece({w: i for i, w in enumerate(dict.fromkeys(pieces))}, unk_token="[UNK]"))
    built.normalizer, built.pre_tokenizer = normalizers.BertNormalizer(), pre_tokenizers.BertPreTokenizer()
    return JsonTokenizer(built.to_str().encode(), "pieces", "1")


def subword_texts(seed, count, length=400):
    pick = random.Random(seed)
    words = ["the", "cost", "of", "agents", "isn't", "réduit", "straße", "1984", "x_1", "e\u0301t\u00e9", "漢字", "😀",
             "aaaaaaaaaaaa", "tokenization", "A.B.C.", "http://a.b/c?d=e", "--", "\n\n", "\t", "  ", "don't", "'s"]
    out = []
    for _ in range(count):
        parts, size = [], 0
        while size < length:
            parts.append(pick.choice(words) + pick.choice(["", " ", " ", " ", ". ", "\n", ", "]))
            size += len(parts[-1])
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "pieces"])
def test_subword_spans_equal_those_of_the_whole_remainder(name):
    texts = subword_texts(3, 40)
    if name == "pieces":
        tokenizer = larger_word_piece(texts)
    else:
        files = pytest.importorskip("public_tokenizers")
        tokenizer = JsonTokenizer.from_file(files.path(name), name, "1")
    for text in texts:
        for budget, overlap, ceiling in ((20, 4, 24), (50, 10, 64), (7, 2, 7), (40, 39, 44), (9, 0, 10)):
            assert list(token_spans(text, tokenizer, budget, overlap, ceiling)) == plain_token_spans(
                text, tokenizer, budget, overlap, ceiling)


def test_slices_by_words_equal_the_library_and_spare_it():
    """Pages laid out in words: the library reads unknown words, not every slice again."""
    files = pytest.importorskip("public_tokenizers")

    class Plain(JsonTokenizer):
        def words(self, text):
            return None

    class Counting(JsonTokenizer):
        calls = 0

        def measure(self, text):
            Counting.calls += 1
            return super().measure(text)

    path = files.path("byte_bpe_50k.json")
    plain, own = Plain.from_file(path, "m", "1"), Counting.from_file(path, "m", "1")
    pick = random.Random(4)
    parts = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "'", "'s", "'re", "'l", "l", "1984", "\u00e9", "e\u0301", "\u6f22\u5b57",
             "\U0001f600", "!", "--", ". ", ", ", "\x1c", "\x85", "\u00a0", "\x00", "x_1", "isn't", "tokenization", "\r\n",
             "\u0663", "\u00b2", "\u00aa", "\u00d7", "\u0131", "\u180e", "\u2028"]
    for _ in range(600):
        text = "".join(pick.choice(parts) for _ in range(pick.randrange(1, 40)))
        words = own.words(text)
        for _ in range(6):
            start, overlap, budget = pick.randrange(len(text)), pick.randrange(8), pick.randrange(1, 9)
            end = pick.randrange(start + 1, len(text) + 1)
            found, spans = plain.measure(text[start:end]), plain.measure(text[start:]).spans
            kept = start + found.spans[-overlap:][0][0] if overlap else None
            assert words.rest(start).measured(end, overlap) == (found.content, kept), (text, start, end)
            assert words.rest(start).reach(budget) == (
                len(text) if len(spans) <= budget else start + spans[budget - 1][1]), (text, start)
    Counting.calls = 0
    for text in subword_texts(9, 20):
        assert list(token_spans(text, own, 20, 4, 24)) == list(token_spans(text, plain, 20, 4, 24))
    assert Counting.calls == 0
    text = "a <|endoftext|> of tokens " * 9     # a special token is found in the text before its words
    assert own.words(text) is None
    assert list(token_spans(text, own, 9, 2, 9)) == list(token_spans(text, plain, 9, 2, 9))
    assert word_piece().words("a b") is None


def test_work_on_a_long_page_is_linear():
    files = pytest.importorskip("public_tokenizers")

    class Counting(JsonTokenizer):
        read = 0

        def measure(self, text):
            Counting.read += len(text)
            return super().measure(text)

    tokenizer = Counting.from_file(files.path("byte_bpe_50k.json"), "m", "1")
    for length in (50_000, 1_000_000):
        Counting.read = 0
        text = subword_texts(5, 1, length)[0]
        assert sum(1 for _ in token_spans(text, tokenizer, 200, 40, 256)) > length / 1200
        assert Counting.read < 12 * len(text)       # the whole remainder each time: over 100 times


def test_subword_query_equals_the_plain_rule(spark):
    files = pytest.importorskip("public_tokenizers")
    from folioweave.plans import corpus, queries_text as Q
    data = "/root/testdata/sf0.001"
    if not pathlib.Path(data).exists():
        pytest.skip("no test tables")
    tokenizer = JsonTokenizer.from_file(files.path("byte_bpe_50k.json"), "m", "1")
    found = {}
    for r in Q.subword_chunks(spark, data).collect():
        found.setdefault((r["paper_id"], r["page_number"]), []).append(
            (r["start_character"], r["end_character"], r["content_token_count"], r["input_token_count"]))
    pages = {(r["paper_id"], r["page_number"]): r["text"] for r in corpus.pages(spark, data).collect()
             if r["text"].strip()}
    assert set(found) == set(pages)
    for key, text in pages.items():
        if len(text) < 2500:                        # the plain rule is quadratic
            assert sorted(found[key]) == plain_token_spans(text, tokenizer, 200, 40, 256)
        assert max(end for _, end, _, _ in found[key]) == len(text)
