from pyspark.sql import functions as F

from earshot.sources.colocated import colocate


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_without_exchange(spark):
    key = (F.col("id") * 7 % 3000).alias("item")
    parts = {
        "a": spark.range(3000).select(key, F.col("id").alias("a")),
        "b": spark.range(0, 3000, 2).select("id", (F.col("id") * 2).alias("b")).withColumnRenamed("id", "item"),
        "c": spark.range(0, 3000, 3).select(F.col("id").alias("item"), F.lit("c").alias("c")),
        "d": spark.range(2000).select(F.when(F.col("id") > 0, F.col("id")).alias("item"), F.lit(1).alias("d")),
    }
    tables = colocate(parts, "item", rows_per_bucket=500)
    found = tables.joined()
    text = plan(found)
    assert text.count("SortMergeJoin") == 3 and "Exchange" not in text
    expected = parts["a"].join(parts["b"], "item").join(parts["c"], "item").join(parts["d"], "item")
    assert sorted(found.collect()) == sorted(expected.collect())
    assert found.count() == len(range(6, 2000, 6))
    tables.drop()
    assert not [t for t in spark.catalog.listTables() if t.name in tables.names.values()]


def test_empty_table_joins_to_nothing(spark):
    rows = spark.range(5).select(F.col("id").alias("item"))
    tables = colocate({"a": rows, "b": rows.limit(0)}, "item")
    assert tables.joined().count() == 0
    tables.drop()
