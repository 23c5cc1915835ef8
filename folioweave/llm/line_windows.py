"""Removal of repeated line passages by overlapping windows, in DataFrame functions only.

Lines are the parts of a text between line feeds, taken as they are. Every window of three
consecutive lines is hashed to 128 bits. The first occurrence of a window over the whole
corpus, by (document, text, row, position), stays; all lines covered by any later occurrence
go. Overlapping and touching windows merge.

Rows equal in id and text are told apart by a row number, fixed in a stored table. Which of them is
first is the only thing it decides: every window of the others has stood in the first, so all
their lines go where they have three or more.

Defined results: null texts are empty; texts with fewer than three lines have no window and
stay whole; windows of blank lines count like any others; rows that share only the id are told
apart by their texts; a null id sorts first. An empty table gives no rows. Further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioweave.llm.common import stored, table

LINES = 3


def _windows(lines: Column) -> Column:
    """(position, two hashes) of every window of an array of lines."""
    one = F.transform(lines, lambda x: F.xxhash64(x))
    two = F.transform(lines, lambda x: F.xxhash64(F.lit(7), x))
    both = F.struct(one.alias("a"), two.alias("b"))
    at = F.sequence(F.lit(0), F.size(lines) - LINES)
    return F.when(F.size(lines) >= LINES, F.transform(F.array(both), lambda h: F.transform(
        at, lambda i: F.struct(
            i.alias("pos"),
            F.xxhash64(h["a"][i], h["a"][i + 1], h["a"][i + 2]).alias("w1"),
            F.xxhash64(F.lit(3), h["b"][i], h["b"][i + 1], h["b"][i + 2]).alias("w2"))))[0])


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.struct(F.col(key).alias("id"), F.xxhash64(content).alias("t1"),
                                F.crc32(content.cast("binary")).alias("t2")).alias("doc"),
                       F.split(content, "\n").alias("lines"))


def covered_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, starts): where later windows begin, in order, for documents that have any.

    Equal rows are one document here. Counting combines on the map side, so a window that a
    third of all documents share is one row per task. Only repeated windows reach the join, as
    a stored table: both of its sides are plain exchanges, whose hot partitions adaptive
    execution splits.
    """
    spots = _keyed(docs, key, text).select("doc", F.inline(_windows(F.col("lines"))))
    repeated = stored(spots.groupBy("w1", "w2").agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "pos")).alias("first"))
        .where("n > 1").select("w1", "w2", "first"))
    later = (spots.join(repeated.hint("merge"), ["w1", "w2"])
             .where(~F.struct("doc", "pos").eqNullSafe(F.col("first"))))
    return later.groupBy("doc").agg(F.sort_array(F.collect_set("pos")).alias("starts"))


def _uncovered(lines: Column, starts: Column) -> Column:
    """The lines outside all windows at ascending ``starts``: the gaps between them, in linear time.

    The arrays are bound once, as a one-element array, so a gap costs its own lines only.
    """
    def gaps(h: Column) -> Column:
        n = F.size(h["starts"])

        def gap(k: Column) -> Column:
            begin = F.when(k == 0, F.lit(0)).otherwise(F.get(h["starts"], k - 1) + LINES)
            end = F.when(k == n, F.size(h["lines"])).otherwise(F.get(h["starts"], k))
            return F.slice(h["lines"], begin + 1, F.greatest(end - begin, F.lit(0)))

        return F.flatten(F.transform(F.sequence(F.lit(0), n), gap))

    return F.transform(F.array(F.struct(lines.alias("lines"), starts.alias("starts"))), gaps)[0]


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeated passages taken out, ``n_lines`` and ``n_removed``.

    The two count columns replace columns of those names in the input.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    mine = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                              F.monotonically_increasing_id().alias("place")))
    content = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    mine = mine.withColumns({"id": F.col(f"row.`{key}`"), "t1": F.xxhash64(content),
                             "t2": F.crc32(content.cast("binary"))})
    cover = covered_lines(mine.select(F.col("id").alias(key), content.alias(text)), key, text).select(
        "doc.id", "doc.t1", "doc.t2", "starts", F.lit(None).cast("long").alias("first"))
    # the first of equal rows; one partial row per task for each
    firsts = mine.groupBy("id", "t1", "t2").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    facts = cover.unionByName(firsts.drop("n").withColumn("starts", F.lit(None).cast("array<int>")))
    facts = facts.groupBy(F.col("id").alias("cid"), F.col("t1").alias("c1"), F.col("t2").alias("c2")).agg(
        F.first("starts", True).alias("starts"), F.max("first").alias("first"))
    joined = mine.join(facts, (F.col("t1") == F.col("c1")) & (F.col("t2") == F.col("c2"))
                       & F.col("id").eqNullSafe(F.col("cid")), "left")
    lines = F.split(content, "\n")
    again = F.coalesce((F.col("place") > F.col("first")) & (F.size(lines) >= LINES), F.lit(False))
    kept = (F.when(again, F.array().cast("array<string>"))
            .when(F.col("starts").isNotNull(), _uncovered(lines, F.col("starts"))))
    told = joined.select("row", F.size(lines).alias("n_lines"), kept.alias("kept"))
    changed = F.when(F.col("kept").isNull(), F.col(f"row.`{text}`")).otherwise(F.array_join("kept", "\n"))
    return told.select(
        *[(changed.alias(c) if c == text else F.col(f"row.`{c}`").alias(c)) for c in names],
        "n_lines", F.coalesce(F.col("n_lines") - F.size("kept"), F.lit(0)).alias("n_removed"))


def op3_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


# One statement for the whole of a documents table named in braces.
SQL = """
lined AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM {docs}),
spots AS (SELECT doc_id, unnest(range(1, len(lines) - 1)) AS pos, lines FROM lined WHERE len(lines) >= 3),
windows AS (SELECT doc_id, pos, lines[pos] AS l1, lines[pos + 1] AS l2, lines[pos + 2] AS l3 FROM spots),
ordered AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, pos) AS nth
            FROM windows),
covered AS (SELECT DISTINCT doc_id, pos + d AS pos FROM ordered, (VALUES (0), (1), (2)) AS t(d) WHERE nth > 1),
gone AS (SELECT doc_id, list(pos) AS covered FROM covered GROUP BY doc_id),
deduped AS (
  SELECT l.doc_id,
         CASE WHEN g.covered IS NULL THEN l.text ELSE array_to_string(list_transform(list_filter(
           list_zip(l.lines, range(1, len(l.lines) + 1)), lambda z: NOT list_contains(g.covered, z[2])),
           lambda z: z[1]), chr(10)) END AS text,
         CAST(len(l.lines) AS INTEGER) AS n_lines, CAST(coalesce(len(g.covered), 0) AS INTEGER) AS n_removed
  FROM lined l LEFT JOIN gone g USING (doc_id))
"""

QUERIES = {"op3_line_windows": op3_line_windows}
ORACLES = {"op3_line_windows": "WITH " + SQL.format(docs="documents")
           + "SELECT doc_id, text, n_lines, n_removed FROM deduped"}
