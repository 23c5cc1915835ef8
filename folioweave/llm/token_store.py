"""Token ids in ORC: run-length encoded stripes, row indexes, Bloom filters on document ids.

Texts are encoded whole by the tokenizers library and end with one end id. Rows are range
partitioned and sorted by id, so every file and stripe covers a narrow range of ids, which
its statistics and Bloom filters let readers skip; stripes are read in parallel.

A worker remembers the ids of words it has met. The tokenizer's pattern parts every text at
each space between two non-space characters, so texts are cut there, all of a call by Arrow, which
also lists the distinct words; unknown words are cut further by the pattern, and only unknown tokens
go to the library. The memory is bounded
and changes no result. Texts with other white space go to the library whole.

Defined results: null texts are empty and hold the end id alone; a null id sorts first; rows
equal in id are ordered by a hash of their texts and then by arrival, and stay separate;
an empty table gives empty files and no rows. Further columns of the input are not read.
"""

from __future__ import annotations

from array import array
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from folioweave.llm.common import parts, table, work_folder

TOKENIZER, END_ID, REMEMBERED, TOGETHER = "byte_bpe_50k.json", 2, 600_000, 1000
ORC_OPTIONS = {"compression": "zstd", "orc.create.index": "true", "orc.row.index.stride": "5000",
               "orc.stripe.size": str(32 << 20), "orc.bloom.filter.columns": "doc_id",
               "orc.bloom.filter.fpp": "0.01"}

_OTHER_SPACE = re.compile(r"[^\S \n]").search         # white space other than space and feed
_POINT = r"(\pL)([.,;:!?])( |$)"                        # its mark: a token that no space precedes
# Byte-level vocabularies spell the bytes that are no visible character by letters from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_FEED, _BLANK = chr(256 + 10), chr(256 + 32)
_BYTE_LETTERS = [chr(256 + _HIDDEN.index(b)) if b in _HIDDEN else chr(b) for b in range(256)]


class Encoder:
    """One worker's tokenizer with its memory of words, as little-endian ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.library = Tokenizer.from_file(path)
        merger = Tokenizer(self.library.model)
        merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.merge = merger.encode_batch_fast
        vocabulary = merger.get_vocab()
        self.spaced, self.fed = np.zeros((2, max(vocabulary.values()) + 1), bool)
        self.spaced[[i for t, i in vocabulary.items() if t[:1] == _BLANK]] = True
        self.fed[vocabulary[_FEED]] = True
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}       # words after a space, which their ids include
        self.others: dict[str, bytes] = {}      # any further tokens, as they are
        self.sizes = 0, 0

    def _library(self, texts: list[str]) -> list[bytes]:
        got = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in got]

    def _merged(self, letters: list[str], spaced: bool) -> list[bytes]:
        """Ids of tokens of letters, after a space or not; the library takes many at once, in the
        spelling of its vocabulary. A space begins the next token; else line feeds part them,
        as no letter's bytes hold either.
        """
        before, skip, begins, out = (_BLANK, 0, self.spaced, []) if spaced else (f"{_FEED} ", 4, self.fed, [])
        for k in range(0, len(letters), TOGETHER):
            spelled = [before + (t if t.isascii() else "".join([_BYTE_LETTERS[b] for b in t.encode()]))
                       for t in letters[k:k + TOGETHER]]
            ids = array("I", self.merge([" ".join(spelled)], add_special_tokens=False)[0].ids)
            starts = np.flatnonzero(begins[ids]).tolist()
            held = ids.tobytes()
            out += [held[4 * a + skip:4 * b] for a, b in zip(starts, [*starts[1:], len(ids)])]
        return out

    def _learn(self, words: list[str]) -> None:
        """Remember unknown words; letters after a space are one token of the pattern."""
        held, known = self.words, self.others
        cores, mixed = [], []
        for w in words:
            (cores if w.isalpha() else mixed).append(w)
        # a word that is marked by a return has no space before it, a feed none either
        cut = [self.cut(w.lstrip("\r") if w[:1] in ("\r", "\n") else " " + w) for w in mixed]
        inner = {t[1:] for p in cut for t in p if t[0] == " " and t[1:].isalpha()}
        cores += inner.difference(held, cores)
        held.update(zip(cores, self._merged(cores, True)))
        self._learn_others({t for p in cut for t in p if not (t[0] == " " and t[1:].isalpha())})
        for w, p in zip(mixed, cut):
            held[w] = b"".join([held[t[1:]] if t[0] == " " and t[1:].isalpha() else known[t] for t in p])

    def _learn_others(self, tokens) -> None:
        new = [t for t in tokens if t not in self.others]
        letters = [t for t in new if t.isalpha()]
        self.others.update(zip(letters, self._merged(letters, False)))
        rest = [t for t in new if not t.isalpha()]
        self.others.update(zip(rest, self._library(rest)))

    def _marked(self, text: str) -> str | None:
        """The text with spaces around each line feed, to be cut at spaces; None for a text with other
        white space, neighbouring spaces or long blank stretches.

        A line's first word, which no space precedes, is marked by a return.
        """
        if ("  " in text or " \n" in text or "\n " in text or "\n\n\n" in text
                or text.endswith("\n\n") or any(s in text for s in self.special)):
            return None
        if not text.replace("\n", "").isprintable() and _OTHER_SPACE(text):
            return None
        return "\r" + text.replace("\n", " \n \r")

    def encode(self, texts: list[str]) -> list[bytes]:
        marked = list(map(self._marked, texts))
        # once the memory is full, a call's new words are forgotten by the next
        for memory, size in ((self.words, self.sizes[0]), (self.others, self.sizes[1])):
            while len(memory) > max(size, REMEMBERED):
                memory.popitem()
        self.sizes = len(self.words), len(self.others)
        cut = [m for m in marked if m is not None]
        done = iter(self._words(cut) if cut else [])
        whole = iter(self._library([t for t, m in zip(texts, marked) if m is None]))
        return [next(whole if m is None else done) for m in marked]

    def _words(self, marked: list[str]) -> list[bytes]:
        """Ids of texts that are cut at their spaces."""
        parted = pc.replace_substring_regex(pa.array(marked, pa.large_string()), _POINT, "\\1 \r\\2\\3")
        lists = pc.split_pattern(parted, " ")
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        blobs = list(map(self.words.get, distinct))
        missing = [k for k, ids in enumerate(blobs) if ids is None]
        self._learn([distinct[k] for k in missing])
        for k in missing:
            blobs[k] = self.words[distinct[k]]
        ids = pa.array(blobs, pa.large_binary()).take(words.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[lists.offsets.to_numpy()].tolist()
        held = memoryview(ids.buffers()[2] or b"")
        return [held[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _encode_partition(path: str, end: int):
    tail = np.array([end], np.uint32).tobytes()

    def run(batches):
        encoder, part, seq = _encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("text")
            for low, n in parts(texts, 4 << 20):
                ids = [x + tail for x in encoder.encode(texts.slice(low, n).to_pylist())]
                ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n)),
                     batch.column("doc_id").slice(low, n), pa.array(np.diff(ends)),
                     pa.ListArray.from_arrays(pa.array(ends), values)],
                    ["part", "seq", "doc_id", "n_ids", "ids"])
                seq += n
    return run


def write_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode all documents and write them in ascending order of their ids."""
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    content = F.coalesce(F.col(text), F.lit(""))
    # hash and arrival split an id that very many rows share
    rows = docs.select(F.col(key).alias("doc_id"), content.alias("text"), F.xxhash64(content).alias("h"),
                       F.monotonically_increasing_id().alias("u"))
    order = ["doc_id", "h", "u"]
    kind = docs.schema[key].dataType.simpleString()
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(_encode_partition(tokenizer, end_id),
                 f"part int, seq long, doc_id {kind}, n_ids int, ids array<int>")
     .write.options(**ORC_OPTIONS).orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """part, seq (the order of all documents), doc_id, n_ids and ids."""
    return spark.read.orc(path)


def lookup(spark: SparkSession, path: str, ids: list) -> DataFrame:
    """The documents of a few ids; stripes are skipped by their statistics and Bloom filters."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(ids))


def _checks(batches):
    for batch in batches:
        ids = batch.column("ids")
        at = ids.offsets.to_numpy().astype(np.int64)
        values = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False))).cast("B")
        crc = [zlib.crc32(values[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("seq"), batch.column("doc_id"),
             pa.array(np.diff(at)), pa.array(crc, pa.int64())],
            ["part", "seq", "doc_id", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each document's ids begin in the sequence of all, read from the files."""
    stored = read_tokens(spark, path)
    kind = stored.schema["doc_id"].dataType.simpleString()
    rows = stored.mapInArrow(
        _checks, f"part int, seq long, doc_id {kind}, n_tokens long, ids_crc32 long")
    # one row for each written file: its total, read without the ids, and what comes before it
    totals = stored.groupBy("part").agg(F.sum(F.col("n_ids").cast("long")).alias("n"))
    before = totals.select(F.col("part").alias("p"), (F.sum("n").over(
        Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return (rows.withColumn("inside", inside).join(before, F.col("part") == F.col("p"))
            .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens",
                    "ids_crc32"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_folder(spark)}/tokens"
    write_tokens(table(spark, sf_dir, "documents"), path)
    return token_index(spark, path)


QUERIES = {"op4_token_store": op4_token_store}
ORACLES: dict[str, str] = {}
