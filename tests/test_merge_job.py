"""Disk and shape of the merge job (F1 of round 04)."""

from collections import Counter

from pyspark.sql import functions as F

from episodeframe import session
from episodeframe.operators import merge as M
from episodeframe.operators import stats as S
from episodeframe.operators.blocks import block_of, dense_index
from episodeframe.plans import merge_job_queries as Q
from episodeframe.sinks import writers as W


def _shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_leave_no_shuffle(spark):
    before = _shuffle_files(spark)
    kept = session.cut_lineage(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    assert _shuffle_files(spark) <= before and kept.count() == 7
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"  # as it was


def test_release_tables_of_one_step(spark):
    first = session.cut_lineage(spark.range(3))
    since = session.tables_written()
    session.cut_lineage(spark.range(4))
    last = session.cut_lineage(spark.range(5))
    assert session.release_tables(spark, since, keep=1) == 1 and session.tables_written() == since + 1
    assert (first.count(), last.count()) == (3, 5)


def test_renumber_shuffles_frames_once_into_ranges(spark, tmp_path):
    rows = [(s, e, i, f"{s}{e}{i}") for s, e, n in (("b", 1, 3), ("a", 2, 70_000), ("a", 1, 2), (None, 1, 2), ("b", None, 1)) for i in range(n)]
    spark.createDataFrame(rows, "s string, e long, i long, v string").repartition(4).write.parquet(f"{tmp_path}/f")
    frames, eps = M.renumber(spark.read.parquet(f"{tmp_path}/f"), ["s", "e"], ["i"], ["s", "e"], materialize=False, ranged=True)
    by = {(r.s, r.e): r for r in eps.collect()}
    assert [(k, by[k].episode_index, by[k].length) for k in sorted(by, key=lambda k: by[k].episode_index)] == [
        ((None, 1), 0, 2), (("a", 1), 1, 2), (("a", 2), 2, 70_000), (("b", None), 3, 1), (("b", 1), 4, 3)]
    got = frames.withColumn("p", F.spark_partition_id()).collect()
    # episodes without a whole key keep their numbers and lose their frames, as in a join
    assert Counter((r.s, r.e) for r in got) == {("a", 1): 2, ("a", 2): 70_000, ("b", 1): 3}
    assert all(r.frame_index == r.i and r["index"] == by[r.s, r.e].dataset_from_index + r.i for r in got)
    got.sort(key=lambda r: r["index"])
    assert [r.p for r in got] == sorted(r.p for r in got) and len({r.p for r in got}) > 1
    assert _plan(frames).count("rangepartitioning") == 1 and "v#" not in "".join(x for x in _plan(frames).splitlines() if "hashpartitioning" in x)
    cols = [F.lit(0.0).alias("timestamp"), "frame_index", "episode_index", "index", F.lit(0).alias("task_index"),
            F.array(F.lit(1.0)).alias("observation.state"), F.array(F.lit(1.0)).alias("action")]
    W.write_frames(frames.select(*cols), f"{tmp_path}/out", ranged=True)
    assert spark.read.parquet(f"{tmp_path}/out/data").count() == 70_005


def test_attached_index_over_blocks(spark):
    df = spark.createDataFrame([(k, i) for k in (1, 2, 3, None) for i in range(10)], "k long, i long")
    per = spark.createDataFrame([(1, [7, 8]), (2, []), (None, [0])], "k long, x array<int>")
    got = dense_index(df.where("i != 4"), ["k"], [F.col("i").desc()], "n", block_of(F.lit(9) - F.col("i"), 3), attach=per, partitions=3).collect()
    left = [i for i in range(9, -1, -1) if i != 4]
    assert Counter((r.k, r.i, r.n, tuple(r.x)) for r in got) == Counter((k, i, n, x) for k, x in ((1, (7, 8)), (2, ())) for n, i in enumerate(left))


def test_exact_stats_of_stored_vectors_keep_no_copy(spark, tmp_path):
    df = spark.range(500).select(F.array(*[(F.col("id") * k % 97).cast("double") for k in (1, 5)]).alias("v"))
    df.write.parquet(f"{tmp_path}/v")
    df, since = spark.read.parquet(f"{tmp_path}/v"), session.tables_written()
    a = S.vector_stats(df, ["v"], quantiles=True, exact=True).orderBy("pos").collect()
    copied = session.tables_written() - since
    b = S.vector_stats(df, ["v"], quantiles=True, exact=True, stored=True).orderBy("pos").collect()
    assert a == b and session.tables_written() - since == 2 * copied - 1


def _tables(spark, d):
    """Orders 1 and 2 come twice, order 2 under two customers of other nations; line items come twice too."""
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")

    put("customer", [(1, 3), (2, 5), (2, 5), (3, 8), (4, None)], "c_custkey long, c_nationkey int")
    put("orders", [(1, 1, "x"), (1, 1, "x"), (2, 1, "x"), (2, 2, "y"), (3, 3, "y"), (4, 4, "y"), (5, 9, "x"), (None, 1, "x"), (6, 1, "x")],
        "o_orderkey long, o_custkey long, o_orderpriority string")
    lines = [(o, i, 10 * i, 7, float(o or 9), 100.0 * (o or 9) + i, 0.1, 0.02) for o in (1, 2, 3, 4, 5, None) for i in (1, 2, 3)] + [(2, 70_000, 1, 1, 2.0, 5.0, 0.0, 0.0)]
    put("lineitem", lines + lines[3:4], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double")


def test_sources_hold_every_frame_in_few_files(spark, tmp_path):
    d = f"{tmp_path}/t"
    _tables(spark, d)
    since = session.tables_written()
    Q.write_sources(spark, d, f"{tmp_path}/base")
    assert session.tables_written() == since  # nothing is kept but the sources
    data = spark.read.option("recursiveFileLookup", "true")
    # joined row by row, as the sources were made before: (task, nation, order) by the rows of orders and customers
    orders = [(1, 0, "03"), (1, 0, "03"), (2, 0, "03"), (2, 1, "05"), (2, 1, "05"), (3, 1, "08"), (4, 1, "null")]
    lines = {1: [1, 2, 3], 2: [1, 1, 2, 3, 70_000], 3: [1, 2, 3], 4: [1, 2, 3]}
    want = {f"{t}-{n}": Counter() for _, t, n in orders}
    for o, t, n in orders:
        held = sorted({(b, c) for a, b, c in orders if a == o})  # an order of two sources counts for both
        for line in lines[o]:
            for b, c in held:
                eps = sorted({a for a, x, y in orders if (x, y) == (b, c)})
                want[f"{t}-{n}"][eps.index(o), float(line)] += 1
    files = 0
    for name, rows in want.items():
        got = data.parquet(f"{tmp_path}/base/source={name}/table=data").collect()
        assert Counter((r.episode_index, r.timestamp) for r in got) == rows, name
        files += len(spark.read.parquet(f"{tmp_path}/base/source={name}/table=data").inputFiles())
    assert files < len(want) + spark.sparkContext.defaultParallelism  # a task begins a source or goes on with the last one
    # the position counts all line items of an order, those of its other sources too
    two = [r for x in ("0-03", "1-05") for r in data.parquet(f"{tmp_path}/base/source={x}/table=data").collect() if r["observation.state"][0] == 2.0]
    assert Counter(r["index"] for r in two) == {i: 2 for i in range(15)}
    by_place = sorted((r["index"], r.timestamp) for r in two)
    assert [t for _, t in by_place] == sorted(t for _, t in by_place)
