"""A layout along a curve: what a box scans, and that it finds the same rows."""

from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.sources import clustered, readers


def scanned(df):
    """Rows that the Parquet scan of an executed plan put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    nodes, rows = [plan], []
    while nodes:
        node = nodes.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            nodes.append(node.executedPlan())
        if node.nodeName().startswith("Scan parquet"):
            rows.append(node.metrics().apply("numOutputRows").value())
        kids = node.children()
        nodes += [kids.apply(i) for i in range(kids.size())]
    return sum(rows)


def test_the_curve_interleaves_bits(spark):
    r = spark.sql("select 0.0D lon, 0.0D lat union all select 180.0, 90.0 union all select -180.0, -90.0 union all select null, 1.0")
    got = [x[0] for x in r.select(clustered.curve(F.col("lon"), F.col("lat"))).collect()]
    assert got == [0b11 << 30, (1 << 32) - 1, 0, None]


def test_a_box_scans_few_rows(spark, tmp_path):
    """The delta box of points over the region: at least five times fewer rows leave the scan than of the unsorted table."""
    points = spark.range(120_000).select("id", (22 + (F.col("id") * 7919 % 14000) / 1000).alias("lon"), (30 + (F.col("id") * 104729 % 7000) / 1000).alias("lat"))
    plain, sorted_ = f"file://{tmp_path}/plain", f"file://{tmp_path}/sorted"
    points.repartition(4).write.option("parquet.block.size", 64 << 10).option("parquet.page.size", 64 << 10).parquet(plain)
    clustered.write_clustered(points, sorted_, files=4, group_bytes=64 << 10)
    box = lambda path: readers.read_box(spark, path, C.DELTA).select("id", "lon", "lat")
    want = points.where(F.col("lon").between(C.DELTA[0], C.DELTA[2]) & F.col("lat").between(C.DELTA[1], C.DELTA[3]))
    rows = sorted(map(tuple, box(sorted_).collect()))
    assert rows == sorted(map(tuple, want.collect())) == sorted(map(tuple, box(plain).collect())) and len(rows) > 1000
    before, after = scanned(box(plain)), scanned(box(sorted_))
    assert before == 120_000 and after >= len(rows) and before >= 5 * after, (before, after)


def test_points_without_a_position_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 2.0), (2, 30.0, 31.0), (3, 30.0, 31.0)], "id int, lon double, lat double")
    clustered.write_clustered(df, f"file://{tmp_path}/a")
    assert sorted(r.id for r in spark.read.parquet(f"file://{tmp_path}/a").collect()) == [1, 2, 3]
    assert [r.id for r in readers.read_box(spark, f"file://{tmp_path}/a", (29, 30, 31, 32)).orderBy("id").collect()] == [2, 3]
    clustered.write_clustered(df.where("false"), f"file://{tmp_path}/b")
    assert spark.read.schema(df.schema).parquet(f"file://{tmp_path}/b").count() == 0
