"""Session helpers: shared folder, spreading small inputs only."""

from ticksmith.functions.columns import fence, spread
from ticksmith.session import checkpoint_root, configure, shared_dir


def test_spread_only_small_inputs(spark):
    want = spark.sparkContext.defaultParallelism
    small = spark.range(10).coalesce(1)
    assert spread(small).rdd.getNumPartitions() >= want
    big = spark.range(1000).repartition(want * 3)
    assert spread(big) is big


def test_fence_keeps_rows_and_columns(spark):
    df = spark.range(5).selectExpr("id", "id * 2 AS twice")
    out = fence(df)
    assert out.columns == ["id", "twice"] and sorted(tuple(r) for r in out.collect()) == [(i, 2 * i) for i in range(5)]


def test_shared_folder_from_session(spark):
    root = checkpoint_root(spark)
    assert root
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))
    configure(spark)
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "true"
    # checkpoint() works against the registered folder
    assert spark.range(3).checkpoint(eager=True).count() == 3
