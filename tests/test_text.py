from collections import Counter
import random
import re

from pyspark.sql import functions as F
import pytest

from folioweave import fixed_values as V
from folioweave.functions import text as X
from folioweave.functions.keywords import top_keywords


def evaluate(spark, function, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = rows.select("i", function(F.col("v")).alias("o")).collect()
    return [r["o"] for r in sorted(out, key=lambda r: r["i"])]


def test_whitespace_class_is_complete():
    every = {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(V.WHITESPACE_CHARACTERS) == every
    assert {c for c in map(chr, range(0x3100)) if re.match(f"[{V.WHITESPACE_CLASS_BODY}]", c)} == every


def test_clean_text_golden(spark):
    raw = "  first  line\r\n\r\n\r\nsecond-\nline\u00a0value\x00  "
    assert evaluate(spark, X.clean_text, [raw, None, "", " \n\t"]) == [
        "first line\n\nsecond-\nline value", "", "", ""]


def plain_clean(text):
    text = text.replace("\x00", "").replace("\r\n", "\n").replace("\r", "\n").replace("\u00a0", " ")
    kept = []
    for line in text.split("\n"):
        line = re.sub("[ \t]+", " ", line).strip()
        if line or not kept or kept[-1]:
            kept.append(line)
    return "\n".join(kept).strip()


def test_clean_and_squeeze_agree_with_python(spark):
    pick = random.Random(7)
    alphabet = "ab \t\n\r\x00\u00a0 \x0b\x1cé😀"
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, 40))) for _ in range(800)]
    assert evaluate(spark, X.clean_text, texts) == [plain_clean(t) for t in texts]
    assert evaluate(spark, X.squeeze, texts) == [" ".join(t.split()) for t in texts]
    assert evaluate(spark, X.strip, texts) == [t.strip() for t in texts]


def test_word_count_agrees_with_python(spark):
    pick = random.Random(3)
    texts = ["".join(pick.choice("aé_-1 .\n²") for _ in range(pick.randint(0, 20))) for _ in range(800)]
    assert evaluate(spark, X.word_count, texts) == [len(re.findall(r"\b[\w\-]+\b", t)) for t in texts]


@pytest.mark.parametrize("name, title", [
    ("2608.20316v1_Deep-Nets_v2v1.pdf", "Deep Nets v2"), ("plain.PDF", "plain"), ("a_b_c.pdf", "b c")])
def test_title_from_filename(spark, name, title):
    assert evaluate(spark, X.title_from_filename, [name]) == [title]


def test_clean_title_falls_back_on_junk(spark):
    pick = lambda c: X.clean_title(c, F.lit("x_Good-name.pdf"))
    assert evaluate(spark, pick, ["  A fine \n title ", "Microsoft Word - a.docx", "abc", None, "t" * 201]) == [
        "A fine title", "Good name", "Good name", "Good name", "Good name"]


def test_abstract_between_headings(spark):
    texts = ["Title\nAbstract: We  do\nthings.\n1. Introduction\nrest", "ABSTRACT — short \n Keywords x",
             "no heading here", "abstracted words\n1. x", "Abstract\n\n1 Introduction"]
    assert evaluate(spark, X.extract_abstract, texts) == [
        "We do things.", "short", "no heading here", "abstracted words 1. x", "Abstract 1 Introduction"]


def test_themes_prefer_the_first_on_ties(spark):
    pick = lambda c: X.theme(F.lit("t"), c)
    assert evaluate(spark, pick, ["cost and agent", "agent recursive cost", "nothing", "costs", "self-improvement"]) == [
        "Inference routing & model efficiency", "AI agents & self-improvement",
        V.DEFAULT_THEME, V.DEFAULT_THEME, "AI agents & self-improvement"]


def test_keywords_keep_first_appearance_on_ties(spark):
    assert evaluate(spark, top_keywords, ["zeta beta beta alpha the model don't"]) == [["beta", "zeta", "alpha", "don't"]]
    assert evaluate(spark, top_keywords, ["Zeta BETA beta", None]) == [["beta", "zeta"], []]


def test_keywords_equal_a_counter(spark):
    pick = random.Random(3)
    words = ["agent", "Agents", "cost's", "a-b", "the", "their", "x1y2zzz", "ROUTE", "éclair", "models", "-dash", "abc", "abcd"]
    texts = [" ".join(pick.choices(words, k=n)) for n in (0, 1, 5, 40, 200, 200)]

    def plain(text):
        found = [w for w in re.findall(V.KEYWORD_PATTERN, text.lower()) if len(w) > 3 and w not in V.STOPWORDS]
        return [w for w, _ in Counter(found).most_common(3)]

    assert evaluate(spark, lambda c: top_keywords(c, 3), texts) == [plain(t) for t in texts]


def test_conversation_title_and_shorten(spark):
    assert evaluate(spark, X.conversation_title, [' "A title.." ', "", "x" * 90]) == [
        "A title", V.UNTITLED, "x" * 80]
    assert evaluate(spark, X.shorten, ["a" * 40, "a" * 38 + " bc"]) == ["a" * 40, "a" * 38 + "…"]
