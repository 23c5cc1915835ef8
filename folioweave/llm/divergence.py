"""Source divergence audit: how far the sources of a language differ in their words.

``document_vectors`` fits ``CountVectorizer`` for each language, with ``minDF`` and the largest
integer as ``vocabSize``, and gives every document's exact sparse vector. A vectoriser holds its
vocabulary on the driver and sends it to all tasks, so the words are dealt into slices by hash, one
vectoriser each, as many as keep a slice near ``SLICE_TERMS`` distinct words, of which only those in
enough documents are held; a word carries its language, so one fit serves all languages. Documents
hand over their distinct words with counts, once for the fit and once for the vectors, which look
the words up in Arrow batches: a vector's text is never repeated. The saved model is the vocabulary
table. ``group_sums`` adds the vectors of each (language, source).

``pair_values`` evaluates all pairs of sources sparsely: rows are grouped by a range of terms
and a pair of source blocks, and a group touches only terms that a source has; a pair of terms
that both lack is counted, not visited. Each group gives one partial sum for each pair.

All arithmetic is exact: counts are longs, probabilities are decimal quotients cut to whole
billionths, and values are sums of integers.

Defined results: null text, language and source are ''. A group without kept terms has counts of
zero; a language without kept terms gives pairs of value 0. Repeated rows and rows without id are
documents of their own. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from folioweave.llm import terms as T
from folioweave.llm.common import native_text, parts, stored, table, work_folder

MIN_DOCUMENTS, VOCABULARY, SLICE_TERMS = 10, 2**31 - 1, 2_000_000
PARTS, RANGE_TERMS, SOURCE_BLOCK, TOP, HELD = 64, 4096, 256, 10, 2_000_000
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
BILLION = 1_000_000_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _sampled(batches):
    """Languages and hashes of the words whose hash falls into one part of ``PARTS``."""
    for batch in batches:
        for low, n in parts(batch.column("text"), 2 << 20):
            found = T.cut(batch.column("text").slice(low, n), T.LETTERS)
            h = found.hashes()
            own = np.flatnonzero(h % np.uint64(PARTS) == 0)
            yield pa.RecordBatch.from_arrays([batch.column("lang").slice(low, n).take(pa.array(found.rows[own])),
                                              pa.array(h[own].view(np.int64))], ["lang", "h"])


def _words(n_slices: int):
    """Rows (documents' own columns, slice, words, counts): a document's distinct words of each slice.

    A word ends where its language begins: no word holds a zero byte.
    """
    def run(batches):
        for batch in batches:
            kept = batch.drop_columns(["text"])
            for low, n in parts(batch.column("text"), 2 << 20):
                found = T.cut(batch.column("text").slice(low, n), T.LETTERS)
                h, dealt = found.hashes(), found.rows * n_slices
                if n_slices > 1:
                    dealt = dealt + (h % np.uint64(n_slices)).astype(np.int64)
                order = np.lexsort((h, dealt))
                h, dealt = h[order], dealt[order]
                heads = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (dealt[1:] != dealt[:-1])][:len(h)])
                cells, first = np.unique(dealt[heads], return_index=True)
                lang = batch.column("lang").slice(low, n).take(pa.array(found.rows[order[heads]]))
                words = pc.binary_join_element_wise(found.strings(order[heads]), lang, "\0")
                at = pa.array(np.append(first, len(heads)).astype(np.int32))
                counts = pa.array(np.diff(np.append(heads, len(h))).astype(np.int32))
                taken = kept.take(pa.array(cells // n_slices + low))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array((cells % n_slices).astype(np.int32)),
                     pa.ListArray.from_arrays(at, words), pa.ListArray.from_arrays(at, counts)],
                    [*taken.schema.names, "slice", "words", "counts"])
    return run


def _vectors(vocabulary):
    """Rows (documents' own columns, slice, indices, counts) of the words that a model knows."""
    def run(batches):
        known = pa.array(vocabulary.value, pa.string())
        for batch in batches:
            words, counts = batch.column("words"), batch.column("counts").flatten().to_numpy()
            sizes = np.diff(words.offsets.to_numpy())
            index = pc.index_in(words.flatten(), known).fill_null(-1).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            met = np.flatnonzero(index >= 0)
            met = met[np.lexsort((index[met], rows[met]))]
            at = np.zeros(len(sizes) + 1, np.int32)
            np.cumsum(np.bincount(rows[met], minlength=len(sizes)), out=at[1:])
            kept = batch.drop_columns(["words", "counts"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.ListArray.from_arrays(pa.array(at), pa.array(index[met].astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(counts[met]))],
                [*kept.schema.names, "indices", "counts"])
    return run


def read_groups(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc_id, lang, source and text with nulls read as ''."""
    return docs.select(F.col(key).alias("doc_id"), *[native_text(n).alias(n) for n in (
        "lang", "source", "text")])


def document_vectors(docs: DataFrame, folder: str, min_documents: int = MIN_DOCUMENTS,
                     slice_terms: int = SLICE_TERMS) -> tuple[DataFrame, DataFrame]:
    """(vectors, vocabulary) of ``read_groups`` rows, stored below ``folder``.

    Vectors: doc_id, lang, source, slice, indices, counts; a document has a row for each slice it
    has words of. Vocabulary: slice, index, lang, term.
    """
    spark = docs.sparkSession
    # only the number of slices hangs on this estimate, from one hash in PARTS over all texts
    n_terms = PARTS * docs.select("lang", "text").mapInArrow(_sampled, "lang string, h long").agg(
        F.approx_count_distinct(F.xxhash64("lang", "h"), 0.02)).head()[0]
    n_slices = max(1, math.ceil(n_terms / slice_terms))
    kind = docs.schema["doc_id"].dataType.simpleString()
    own_columns = f"doc_id {kind}, lang string, source string, slice int"
    schema = f"{own_columns}, words array<string>, counts array<int>"
    written = docs.mapInArrow(_words(n_slices), schema).write
    (written.partitionBy("slice") if n_slices > 1 else written).parquet(f"{folder}/words")
    words = spark.read.schema(schema).parquet(f"{folder}/words")
    # the distinct words of each document give the vocabulary that all its words would
    counter = CountVectorizer(minTF=1.0, minDF=float(min_documents), vocabSize=VOCABULARY,
                              inputCol="words", outputCol="vector")
    vectors = spark.createDataFrame([], f"{own_columns}, indices array<int>, counts array<int>")
    vocabulary = spark.createDataFrame([], "slice int, index int, lang string, term string")
    for i in range(n_slices):
        own = words.where(F.col("slice") == i)
        model = counter.fit(own.select("words"))
        model.write().save(f"{folder}/models/{i}")
        known = spark.sparkContext.broadcast(model.vocabulary)
        own.mapInArrow(_vectors(known), vectors.schema).write.parquet(f"{folder}/vectors/{i}")
        parted = F.split("word", "\0", 2)
        listed = spark.read.parquet(f"{folder}/models/{i}/data").select(F.posexplode("vocabulary").alias("index", "word"))
        vocabulary = vocabulary.unionByName(listed.select(
            F.lit(i).alias("slice"), F.col("index").cast("int").alias("index"), parted[1].alias("lang"),
            parted[0].alias("term")))
        vectors = vectors.unionByName(spark.read.schema(vectors.schema).parquet(f"{folder}/vectors/{i}"))
    return vectors, stored(vocabulary)


def _totals(held: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(held).group_by("key", use_threads=False).aggregate([("value", "sum")])
    return found.rename_columns({"value_sum": "value"})


def _named(found: pa.Table, names: list[tuple]) -> pa.RecordBatch:
    keys = found.column("key").to_numpy()
    lang, source, piece = (pa.array(n, kind) for n, kind in zip(zip(*names), (pa.string(), pa.string(), pa.int32())))
    of = pa.array(keys >> 32)
    return pa.RecordBatch.from_arrays(
        [lang.take(of), source.take(of), piece.take(of), pa.array((keys & 0xFFFFFFFF).astype(np.int32)),
         found.column("value").combine_chunks()], ["lang", "source", "slice", "index", "value"])


def _added(batches):
    """Vectors of a task added up by group, in a memory of at most some ``HELD`` sums."""
    number: dict[tuple, int] = {}
    held, rows = [], 0
    for batch in batches:
        of = [batch.column(n).dictionary_encode() for n in ("lang", "source", "slice")]
        lang, source, piece = (c.indices.to_numpy().astype(np.int64) for c in of)
        met, place = np.unique((lang * len(of[1].dictionary) + source) * len(of[2].dictionary) + piece,
                               return_inverse=True)
        upper, pieces = np.divmod(met, max(1, len(of[2].dictionary)))
        langs, sources = np.divmod(upper, max(1, len(of[1].dictionary)))
        names = zip(*[c.dictionary.take(pa.array(k)).to_pylist() for c, k in zip(of, (langs, sources, pieces))])
        codes = np.array([number.setdefault(name, len(number)) for name in names], np.int64)[place]
        indices = batch.column("indices")
        # one key of a group's slice and an index
        keys = np.repeat(codes << 32, np.diff(indices.offsets.to_numpy())) | indices.flatten().to_numpy()
        held.append(pa.table({"key": keys, "value": batch.column("counts").flatten().cast(pa.int64())}))
        rows += len(keys)
        if rows > HELD:
            held = [_totals(held)]
            rows = held[0].num_rows
            if rows > HELD // 2:
                yield _named(held[0], list(number))
                held, rows = [], 0
    if rows:
        yield _named(_totals(held), list(number))


def group_sums(vectors: DataFrame) -> DataFrame:
    """lang, source, slice, index and n: the vectors of each group added up."""
    each = vectors.drop("doc_id").mapInArrow(
        _added, "lang string, source string, slice int, index int, value long")
    return each.groupBy("lang", "source", "slice", "index").agg(F.sum("value").alias("n"))


def share(count: str, total: str) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 V)); in decimals where a product of longs would overflow."""
    under = f"greatest({total} + 2 * v, 1)"
    return F.expr(f"1 + if({count} < 9000000000, ({count} + 2) * {BILLION}L div {under}, "
                  f"(cast({count} + 2 as decimal(27,0)) * cast({BILLION} as decimal(10,0))) "
                  f"div cast({under} as decimal(38,0)))")


def groups_of(docs: DataFrame, sums: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """One row for each (lang, source): number, size, words of the language, N of both, zero share."""
    own = sums.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = vocabulary.groupBy("lang").agg(F.count("*").alias("v"))
    all_of = own.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    groups = (docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left")
              .join(kept, "lang", "left").join(all_of, "lang", "left").na.fill(0, ["total", "v", "lang_total"]))
    numbers = Window.partitionBy("lang").orderBy("source")
    return groups.withColumn("number", F.row_number().over(numbers).cast("int") - 1)


def _values(group: pa.Table) -> pa.Table:
    """Partial values of all pairs of a (range of terms, pair of source blocks)."""
    number, p = (group.column(n).to_numpy() for n in ("number", "p"))
    none = group.column("term").is_null().to_numpy()
    sources, first = np.unique(number[none], return_index=True)
    zero, n_terms = p[none][first], int(group.column("n_terms")[int(np.flatnonzero(none)[0])].as_py())
    low, high = (group.column(n)[0].as_py() for n in ("low", "high"))
    s = np.searchsorted(sources, number[~none])
    _, t = np.unique(group.column("term").filter(pa.array(~none)).to_numpy(), return_inverse=True)
    order = np.lexsort((t, s))
    s, t, p = s[order], t[order], p[~none][order]
    bounds = np.searchsorted(s, np.arange(len(sources) + 1))
    others = np.flatnonzero(sources // SOURCE_BLOCK == high)
    inside = np.isin(s, others)
    os, ot, op = s[inside], t[inside], p[inside]
    dense = np.repeat(zero[others][:, None], t.max(initial=-1) + 1, 1)
    dense[np.searchsorted(others, os), ot] = op
    out = []
    for i in np.flatnonzero(sources // SOURCE_BLOCK == low):
        mine, js = slice(bounds[i], bounds[i + 1]), others[others > i] if low == high else others
        if not len(js):
            continue
        rows = np.searchsorted(others, js)
        held = np.zeros(dense.shape[1], bool)
        held[t[mine]] = True
        met = _difference(p[mine][None, :], dense[np.ix_(rows, t[mine])]).sum(1)
        lone = ~held[ot]                                    # terms of the others alone
        alone = _difference(zero[i], op[lone])
        more = np.bincount(os[lone], alone, len(sources))[js].astype(np.int64)  # below 2^53: exact
        seen = held.sum() + np.bincount(os[lone], minlength=len(sources))[js]
        out.append((np.full(len(js), sources[i]), sources[js],
                    met + more + (n_terms - seen) * _difference(zero[i], zero[js])))
    a, b, value = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3
    return pa.table({"lang": pa.array([group.column("lang")[0].as_py()] * len(a), pa.string()),
                     "a": pa.array(a.astype(np.int32)), "b": pa.array(b.astype(np.int32)),
                     "value": pa.array(value)})


def _difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def pair_values(sums: DataFrame, groups: DataFrame, vocabulary: DataFrame,
                range_terms: int = RANGE_TERMS) -> DataFrame:
    """lang, a, b (source numbers, a < b) and value, over all kept terms."""
    ranges = F.greatest(F.ceil(F.col("v") / range_terms), F.lit(1)).cast("int")
    blocks = groups.groupBy("lang").agg(
        (F.floor(F.max("number") / SOURCE_BLOCK) + 1).cast("int").alias("n_blocks"),
        F.first(ranges).alias("n_ranges"))
    dealt = F.pmod(F.xxhash64("slice", "index"), F.col("n_ranges")).cast("int").alias("range")
    block = F.floor(F.col("number") / SOURCE_BLOCK).cast("int")
    facts = groups.join(blocks, "lang")
    counted = vocabulary.join(blocks, "lang").groupBy("lang", dealt).agg(F.count("*").alias("n_terms"))
    held = sums.join(facts, ["lang", "source"]).select(
        "lang", dealt, "number", block.alias("block"), "n_blocks",
        F.expr("shiftleft(cast(slice as bigint), 32) + index").alias("term"), share("n", "total").alias("p"))
    absent = (facts.select("lang", "number", block.alias("block"), "n_blocks", share("0", "total").alias("p"),
                           F.explode(F.sequence(F.lit(0), F.col("n_ranges") - 1)).alias("range"))
              .join(counted, ["lang", "range"], "left").na.fill(0, ["n_terms"])
              .withColumn("term", F.lit(None).cast("long")))
    each = held.withColumn("n_terms", F.lit(None).cast("long")).unionByName(absent)
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    dealt_out = each.select("lang", "range", F.least("block", "other").alias("low"),
                            F.greatest("block", "other").alias("high"), "number", "term", "p", "n_terms")
    found = dealt_out.groupBy("lang", "range", "low", "high").applyInArrow(
        _values, "lang string, a int, b int, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def ranked_pairs(values: DataFrame, groups: DataFrame) -> DataFrame:
    """Part ``pair``: every other source of each group by its value."""
    both = values.select("lang", "value", F.inline(F.array(
        F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))))
    one = groups.select("lang", F.col("number").alias("x"), "source")
    two = groups.select("lang", F.col("number").alias("y"), F.col("source").alias("item"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return both.join(one, ["lang", "x"]).join(two, ["lang", "y"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def ranked_terms(sums: DataFrame, groups: DataFrame, vocabulary: DataFrame, top: int = TOP) -> DataFrame:
    """Part ``term``: the words by which each group exceeds its language most."""
    whole = F.sum("n").over(Window.partitionBy("lang", "slice", "index")).alias("lang_n")
    shares = sums.select("*", whole).join(groups, ["lang", "source"]).select(
        "lang", "source", "slice", "index", share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q"))
    more = shares.where("p > q").join(vocabulary, ["lang", "slice", "index"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, slice_terms: int = SLICE_TERMS,
          range_terms: int = RANGE_TERMS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: both parts of the audit."""
    docs = read_groups(docs)
    vectors, vocabulary = document_vectors(docs, work_folder(docs.sparkSession), min_documents, slice_terms)
    sums = stored(group_sums(vectors))
    groups = stored(groups_of(docs, sums, vocabulary))
    values = pair_values(sums, groups, vocabulary, range_terms)
    return ranked_pairs(values, groups).unionByName(ranked_terms(sums, groups, vocabulary, top))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      coalesce(text, '') AS text FROM documents),
  g AS (SELECT DISTINCT lang, source FROM d),
  w AS (SELECT r, lang, source, unnest(regexp_extract_all(
      translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{TERM}')) AS term FROM d),
  kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term
    HAVING count(DISTINCT r) >= {MIN_DOCUMENTS}),
  size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
  c AS (SELECT w.lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
  own AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
  p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
      1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(own.total, 0) + 2 * size.v)::HUGEINT AS p,
      1 + (1000000000::HUGEINT * (k.n + 2)) // (size.total + 2 * size.v)::HUGEINT AS q
    FROM g JOIN kept k USING (lang) JOIN size USING (lang)
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    LEFT JOIN own ON own.lang = g.lang AND own.source = g.source),
  sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
  pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
  terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
    FROM p WHERE n > 0 AND p > q),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""

QUERIES = {"op11_divergence": op11_divergence}
ORACLES = {"op11_divergence": SQL}
