"""Arrival order: dense position, positional chunks, order from Parquet files."""

import os
import tempfile

from pyspark.sql import functions as F

from ledgerline.operators.sequence import dense_position, positional_chunks, sequence_from_files


def test_dense_position_small_span(spark):
    df = spark.createDataFrame([(s,) for s in [5, 1, 900, 33, 34, 2]], "seq long")
    got = {r.seq: r.original_order for r in dense_position(df, span=4).collect()}
    assert got == {1: 1, 2: 2, 5: 3, 33: 4, 34: 5, 900: 6}


def test_positional_chunks(spark):
    df = spark.range(0, 50).select((F.col("id") * 3).alias("seq"))
    got = positional_chunks(df, 7, span=8).collect()
    assert sorted((r.original_order - 1) // 7 for r in got) == sorted(r.chunk for r in got)
    assert max(r.chunk for r in got) == 7


def test_sequence_from_parquet_files(spark):
    out = tempfile.mkdtemp(prefix="ledgerline-seq-")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.parquet(os.path.join(out, f"part{i}"))
    df = spark.read.parquet(os.path.join(out, "part*"))
    rows = sequence_from_files(df).orderBy("seq").collect()
    assert [r.id for r in rows] == list(range(30))


def test_sequence_from_csv_splits(spark):
    out = tempfile.mkdtemp(prefix="ledgerline-seqcsv-")
    for i in range(2):
        rows = "\n".join(f"{i * 1000 + j},x{j % 7}" for j in range(1000))
        with open(os.path.join(out, f"part{i}.csv"), "w") as fh:
            fh.write("n,tag\n" + rows + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # many splits per file
    try:
        df = spark.read.option("header", True).csv(out)
        assert df.rdd.getNumPartitions() > 4
        rows = sequence_from_files(df).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [int(r.n) for r in rows] == list(range(2000))
    assert [r.seq for r in rows] == list(range(1, 2001))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dense_position_of_any_order(spark):
    import random

    rng = random.Random(4)
    seqs = list({rng.randrange(-(1 << 63), 1 << 63) for _ in range(400)} | {rng.randrange(-50, 50) * (1 << 23) for _ in range(80)} | {0, -1, (1 << 63) - 1, -(1 << 63)})
    df = spark.createDataFrame([(s,) for s in seqs], "seq long").repartition(5)
    for span in (1, 4096, 1 << 22):
        found = dense_position(df, span=span)
        assert {r.seq: r.original_order for r in found.collect()} == {s: i + 1 for i, s in enumerate(sorted(seqs))}
        assert "SinglePartition" not in plan_of(found)


def test_neighbours_of_a_sparse_hot_account(spark):
    import random

    from ledgerline.operators.neighbors import add_neighbors
    from ledgerline.operators.skew import Split

    rng = random.Random(5)
    rows = [("HOT" if i % 3 else f"a{i % 9}", s, float(i)) for i, s in enumerate({rng.randrange(-(1 << 62), 1 << 62) for _ in range(300)})]
    df = spark.createDataFrame(rows, "k string, seq long, v double").repartition(4)
    want = add_neighbors(df, "k", "seq", lead={"n": "v"}, lag={"p": "v"})
    for span in (1, 1 << 22):
        got = add_neighbors(df, "k", "seq", lead={"n": "v"}, lag={"p": "v"}, span=Split(span, 5))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
