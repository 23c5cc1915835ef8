"""JSON-lines tables and the metadata CSV, read with explicit schemas."""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from folioweave.functions import identity
from folioweave.functions.text import is_blank
from folioweave.operators import contracts
from folioweave.sources.files import Files


def parse_lines(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Parsed records beside the problem, if any, that each line has.

    Blank lines are skipped. Values are checked on the parsed variant first, because a
    typed parse would quietly turn ``true`` or ``1.0`` into another type.
    """
    kept = lines.where(~is_blank(F.col(column)))
    loose = F.try_parse_json(F.col(column))
    parsed = kept.withColumns({"loose": loose,
                               "record": F.from_json(F.col(column), schema,
                                                     {"mode": "PERMISSIVE"})})
    kind = F.schema_of_variant("loose")
    wrong = [F.when(~_kind_ok(field), F.lit(field.name)) for field in schema]
    problem = (F.when(F.col("loose").isNull(), F.lit("invalid JSON"))
               .when(~F.startswith(kind, F.lit("OBJECT")), F.lit("not an object"))
               .otherwise(F.nullif(F.array_join(F.array_compact(F.array(*wrong)), ","),
                                   F.lit(""))))
    return parsed.withColumn("problem", problem).drop("loose")


def _kind_ok(field: T.StructField) -> Column:
    found = F.schema_of_variant(F.try_variant_get("loose", f"$.{field.name}", "variant"))
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        good = found.isin("BIGINT", "VOID")
    elif isinstance(field.dataType, T.StringType):
        good = found.isin("STRING", "VOID")
    elif isinstance(field.dataType, T.ArrayType):
        good = F.startswith(found, F.lit("ARRAY")) | (found == "VOID")
    else:
        return F.lit(True)
    return F.coalesce(good, F.lit(True))


def read_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON-lines table; any bad line fails the read with the file that holds it."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    parsed = parse_lines(raw, schema)
    bad = parsed.where("problem IS NOT NULL").select("file", "problem").limit(3).collect()
    if bad:
        shown = "; ".join(f"{row['file']}: {row['problem']}" for row in bad)
        raise ValueError(f"invalid record at {shown}")
    return parsed.select("record.*")


def write_lines(rows: DataFrame, path: str) -> None:
    """JSON lines with sorted keys."""
    ordered = rows.select(*sorted(rows.columns))
    ordered.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def read_manifest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A paper manifest: a folder of JSON lines, or one JSON list of objects in a file.

    The folder, as ``save_manifest`` writes it, is the form for many papers: it is read in
    parallel. A file is parsed as a stream, whatever its size.
    """
    files = Files(spark)
    if files.exists(path) and files.is_directory(path):
        return read_lines(spark, path, schema)
    if files.first_character(path) != "[":
        raise ValueError("the paper manifest must be a JSON list")
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def save_manifest(papers: DataFrame, path: str) -> None:
    """A validated manifest as JSON lines, sorted by paper identifier.

    The sort is a range-partitioned one: part files follow each other in order.
    """
    papers = contracts.normalize_papers(papers)
    contracts.require_empty(contracts.paper_violations(papers), "the paper manifest")
    write_lines(papers.orderBy("paper_id"), path)


def read_metadata_ids(spark: SparkSession, path: str, encoding: str = "utf-8-sig") -> DataFrame:
    """The ``id`` column of a metadata CSV whose header names it exactly once.

    Spark renames repeated columns, so the header line is checked as text first.
    """
    first = spark.read.text(path).head()
    header = next(csv.reader(io.StringIO((first[0] if first else "").lstrip("\ufeff"))), [])
    if header.count("id") != 1 or len(set(header)) != len(header):
        raise ValueError("the metadata CSV must have an unambiguous id column")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    rows = (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
            .option("multiLine", True).option("escape", '"').csv(path))
    return rows.select("id")


def id_problems(ids: DataFrame, column: str = "id") -> DataFrame:
    """Noncanonical or repeated identifiers of an id list."""
    bad = ids.where(~identity.is_paper_id(F.col(column))).select(
        F.lit("noncanonical").alias("rule"), F.col(column).alias("key"))
    twice = ids.groupBy(column).count().where("count > 1").select(
        F.lit("duplicate").alias("rule"), F.col(column).alias("key"))
    return bad.unionByName(twice)
