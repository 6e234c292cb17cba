import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from earshot import session
from earshot.operators.coldstart import logistic_regression
from earshot.operators.models import save_model
from earshot.sources import store, tables


def test_logistic_model_is_saved_and_loaded(spark, tmp_path):
    rows = [(float(i % 2), Vectors.dense([float(i % 2), 1.0])) for i in range(20)]
    df = spark.createDataFrame(rows, ["label", "features"])
    model = logistic_regression().fit(df)
    save_model(model, str(tmp_path / "lr"))
    save_model(model, str(tmp_path / "lr"))  # overwrites
    assert LogisticRegressionModel.load(str(tmp_path / "lr")).transform(df).where("label <> prediction").count() == 0


def test_writing_twice_needs_overwrite(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "t")
    store.write_table(df, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.write_table(df, path)
    store.write_table(spark.range(5), path, overwrite=True)
    assert spark.read.parquet(path).count() == 5


def test_clustered_files_hold_sorted_ranges_even_with_a_hot_value(spark, tmp_path):
    path = str(tmp_path / "c")
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100)
    df = spark.range(60000).select(hot.alias("k"), "id")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        store.write_clustered(df, path, "k")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    back = spark.read.parquet(path)
    assert back.count() == 60000
    files = back.groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count("*").alias("n"))
    rows = sorted(files.collect(), key=lambda r: (r.low, r.high))
    assert len(rows) > 3 and max(r.n for r in rows) < 20000  # the hot value alone has 20200 rows
    assert all(a.high <= b.low for a, b in zip(rows, rows[1:]))


def test_matrix_round_trip(spark, data, tmp_path):
    vectors, path = tables.factors(spark, data), str(tmp_path / "m")
    store.write_matrix(vectors, path, 64)
    rows = lambda df: sorted((r.id, r.features) for r in df.collect())
    assert rows(store.read_matrix(spark, path, 64)) == rows(vectors)
    assert store.read_matrix(spark, path, 64, keep_id=False).columns == ["features"]


def test_result_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("exact", 1, 0.5), ("cells", 5, 1.0)], "method string, m int, recall double")
    store.write_result(df, str(tmp_path / "r"))
    back = store.read_result(spark, str(tmp_path / "r"), "method string, m int, recall double")
    assert sorted(back.collect()) == sorted(df.collect())


def test_centres_are_a_table(spark, tmp_path):
    centres = spark.createDataFrame([(0, [1.0, 2.0])], "center_idx int, center array<double>")
    store.write_table(centres, str(tmp_path / "centres"))
    assert spark.read.parquet(str(tmp_path / "centres")).collect() == centres.collect()


def test_scratch_folder_is_the_one_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_root(spark) == root
    assert session.scratch_path(spark, "x").startswith(root)
    assert session.stored(spark.range(3), "s").inputFiles()[0].startswith(f"file://{root}")


def test_stored_partitions_keep_columns(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "part string, n int")
    back = session.stored(df, "p", partition_by="part")
    assert sorted((r.part, r.n) for r in back.collect()) == [("a", 1), ("b", 2)]


def test_a_cluster_without_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())
