"""A consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Every shard owns ``VNODES`` points of a ring; a key belongs to the first point clockwise of
its own position. Loads are bounded by the exact quota of each shard (row counts of any two
shards differ by one at most): what a full shard cannot take continues clockwise, arc by
arc, to the next shard with room. Only the counts of the arcs (``shards * VNODES``, a
parameter) pass the driver; rows are numbered inside small cells of each arc, so one key or
one text that holds a third of all rows is spread over ``CELLS`` cells.

Defined results: a null key is one key with its own ring position; a null text has size 1;
repeated rows are placed one by one; an empty table gives no rows. Other columns of the
input are not read, so their names cannot clash.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from folioweave.llm.common import stored, table

SHARDS, VNODES, CELLS = 8, 64, 32


def ring_points(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise; a shard's points never move."""
    points = [(int(hashlib.md5(f"shard {s} node {v}".encode()).hexdigest()[:8], 16), s)
              for s in range(shards) for v in range(vnodes)]
    return sorted(points)


def ring_position(key: Column) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def flow(points: list[tuple[int, int]], counts: dict[int, int],
         capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Where each stretch of each arc's rows goes: (arc, low, high, shard, first slot).

    First every shard takes the rows of its own arcs, clockwise, up to its capacity. The
    rest moves on clockwise one arc at a time, the earliest comers first.
    """
    room, used, out = list(capacity), [0] * len(capacity), []

    def take(arc: int, low: int, high: int, shard: int) -> int:
        n = min(room[shard], high - low)
        if n:
            out.append((arc, low, low + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return low + n

    waiting = []
    for arc, (_, shard) in enumerate(points):
        n = counts.get(arc, 0)
        rest = take(arc, 0, n, shard)
        if rest < n:
            waiting.append((arc, rest, n))
    step = 0
    while waiting:
        step += 1
        moved = []
        for arc, low, high in waiting:
            low = take(arc, low, high, points[(arc + step) % len(points)][1])
            if low < high:
                moved.append((arc, low, high))
        waiting = moved
    return out


def _arc_lookup(spark: SparkSession, points: list[tuple[int, int]]) -> DataFrame:
    """Arc boundaries by the top 12 bits of a position: at most a few arcs share a slot."""
    places = [p for p, _ in points]
    rows = []
    for slot in range(4096):
        low, high = slot << 20, ((slot + 1) << 20) - 1
        first = bisect.bisect_left(places, low)
        last = bisect.bisect_left(places, high)
        rows.append((slot, first, places[first:last]))
    return spark.createDataFrame(rows, "slot int, first int, inner array<long>")


def assign(rows: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
           vnodes: int = VNODES) -> DataFrame:
    """Key, size, checksum, arc, shard and slot of every row; law: row counts.

    The narrow digest is stored once, so that numbering and counting see the same rows even
    if executors are lost in between.
    """
    spark = rows.sparkSession
    points = ring_points(shards, vnodes)
    content = F.coalesce(F.col(text), F.lit(""))
    lookup = F.broadcast(_arc_lookup(spark, points))        # 4096 rows, by the parameters
    digest = (rows.select(F.col(key).alias("key"), (F.octet_length(content) + 1).cast("long").alias("size"),
                          F.crc32(content.cast("binary")).alias("crc"))
              .withColumns({"at": ring_position(F.col("key")),
                            "cell": F.pmod(F.xxhash64("key", "crc", F.monotonically_increasing_id()),
                                           F.lit(CELLS)).cast("int")})
              .withColumn("slot", F.expr("cast(at >> 20 as int)"))
              .join(lookup, "slot"))
    arc = F.pmod(F.col("first") + F.size(F.filter("inner", lambda p: p < F.col("at"))),
                 F.lit(len(points)))
    digest = stored(digest.select("key", "size", "crc", "cell", arc.cast("int").alias("arc")))
    cells = digest.groupBy("arc", "cell").count()
    counts = {r["arc"]: r["n"] for r in                      # shards * vnodes rows at most
              cells.groupBy("arc").agg(F.sum("count").alias("n")).collect()}
    plan = flow(points, counts, quotas(sum(counts.values()), shards))
    stretches: dict[int, list] = {}
    for a, low, high, shard, first in plan:
        stretches.setdefault(a, []).append((low, high, shard, first))
    goes = spark.createDataFrame(
        list(stretches.items()),
        "arc int, goes array<struct<low: long, high: long, shard: int, first: long>>")
    before = cells.select("arc", "cell", (F.sum("count").over(
        Window.partitionBy("arc").orderBy("cell")) - F.col("count")).alias("before"))
    within = F.row_number().over(Window.partitionBy("arc", "cell").orderBy("key", "crc", "size"))
    ranked = (digest.withColumn("n", within)
              .join(before, ["arc", "cell"])
              .withColumn("rank", F.col("before") + F.col("n") - 1)
              .join(F.broadcast(goes), "arc"))              # one row for each arc
    place = F.filter("goes", lambda g: (F.col("rank") >= g["low"]) & (F.col("rank") < g["high"]))[0]
    return (ranked.withColumn("place", place)
            .select("key", "size", "crc", "arc", F.col("place.shard").alias("shard"),
                    (F.col("place.first") + F.col("rank") - F.col("place.low")).alias("slot")))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign(table(spark, sf_dir, "documents"))
    return placed.select(
        F.col("key").alias("doc_id"), "size", F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op7_shards": op7_shards}
ORACLES: dict[str, str] = {}
