import uuid
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from folioweave.llm import token_store as T

from cases import clashing, documents, prose

TEXTS = [None, "", " ", "a  b", "trailing ", "x \n y", "it's I'll x's", "<|endoftext|> a <|endoftext|>b", "a\n\nb\n\n\nc\n\n",
         "日本　語", "a\tb", " a b\n", "é à, b.c d!", "1 2  3", "\r\n", "²³ ⅷ", *prose(2, 5), " ".join(prose(3, 40, 100, 200))]


def library():
    return Tokenizer.from_file(public_tokenizers.path(T.TOKENIZER))


def test_encoder_equals_the_library_also_with_a_full_memory(monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 20)
    tokenizer, encoder = library(), T.Encoder(public_tokenizers.path(T.TOKENIZER))
    texts = [t or "" for t in TEXTS]
    for some in (texts, texts[::-1], texts[5:], texts):
        assert [np.frombuffer(b, np.uint32).tolist() for b in encoder.encode(some)] == [
            tokenizer.encode(t, add_special_tokens=False).ids for t in some]


def test_new_words_go_to_the_library_together(monkeypatch):
    tokenizer, encoder = library(), T.Encoder(public_tokenizers.path(T.TOKENIZER))
    monkeypatch.setattr(T, "TOGETHER", 7)
    calls = []
    merge = encoder.merge
    encoder.merge = lambda *given, **options: calls.append(1) or merge(*given, **options)
    texts = ["Ünïcode ßtraße. naïve, été; Ж日本語! a.b. 12. x1, .. a., \"q\". it's. we'll, end.", "one\ntwo.\n\nthree, it's\nfour.",
             ".", "\n", "a.\n", " lead. word", *prose(8, 5), " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(70))]
    for some in (texts, texts[::-1]):
        assert [np.frombuffer(b, np.uint32).tolist() for b in encoder.encode(some)] == [
            tokenizer.encode(t, add_special_tokens=False).ids for t in some]
    assert 10 < len(calls) < 40
    first = len(calls)
    encoder.encode(texts)
    assert len(calls) == first


def test_files_hold_all_ids_in_order(spark):
    ids = [None, *range(len(TEXTS) - 1)]
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    T.write_tokens(clashing(documents(spark, [*TEXTS, "twice", "twice"], [*ids, 3, 3])), path)
    got = sorted(T.token_index(spark, path).collect(), key=lambda r: r["start"])
    assert len(got) == len(TEXTS) + 2
    at, tokenizer = 0, library()
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in got] == sorted([*ids, 3, 3], key=lambda i: (i is not None, i or 0))
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in zip(ids, TEXTS)}
    for r in got:
        if r["doc_id"] != 3:
            assert r["n_tokens"] == len(want[r["doc_id"]])
            assert r["ids_crc32"] == zlib.crc32(np.array(want[r["doc_id"]], np.uint32).tobytes())
    assert T.lookup(spark, path, [7]).first()["ids"] == want[7]


def test_empty_table(spark):
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    T.write_tokens(documents(spark, []), path)
    assert T.token_index(spark, path).count() == 0
