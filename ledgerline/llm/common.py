"""Helpers shared by the operators: tables, shared scratch space, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir, scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def ready(spark: SparkSession) -> SparkSession:
    """Checkpoint folder known, and this package importable in the Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to the shared folder and read back: lineage ends at files that outlive executors."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: Rows, and bytes of their values as JSON, that ``joined`` broadcasts at most.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def joined(rows: DataFrame, few: DataFrame, on: list[str], how: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` joined with ``few``: by broadcast if that has been measured as small, else by shuffle."""
    few = stored(few, "joined")
    size = few.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct(*few.columns)))).alias("bytes")).first()
    small = size.n <= most and (size.bytes or 0) <= BROADCAST_BYTES
    return rows.join(F.broadcast(few) if small else few, on, how)


def components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges`` (``a``, ``b`` long): rows ``node``, ``root`` (smallest node).

    Alternating large-star and small-star rounds: every round joins each node's
    neighbours to its smallest one, the number of edges never grows, and the
    number of rounds grows with the logarithm of the largest component.  Each
    round is a pair of shuffles on the node; its edges are written to the
    shared folder.  A hub's neighbours never meet in one row: only its minimum
    is aggregated, which combines before the shuffle.
    """
    now = stored(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), label
    )
    for _ in range(max_rounds):
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: neighbours above a node move to its smallest neighbour (or itself).
        large = both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(F.col("m").alias("m"), "a", "b")
        moved = (
            small.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b")
            .union(small.select(F.col("m").alias("a"), "b"))
            .distinct()
        )
        new = stored(moved, label)
        # Done when every node has one edge and no root is itself below another node.
        deep = new.select("b").groupBy("b").count().where("count > 1").limit(1).count()
        chained = 0 if deep else new.select(F.col("a").alias("b")).distinct().join(new.select("b"), "b", "left_semi").limit(1).count()
        now = new
        if not deep and not chained:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
