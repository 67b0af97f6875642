import pytest
from pyspark.sql import functions as F

from kelpfit.operators import linreg
from kelpfit.sources import generators, reshape, tables


def test_csv_round_trip_with_and_without_schema(spark, tmp_path):
    path = tmp_path / "drug200.csv"
    path.write_text("Age,Sex,BP,Cholesterol,Na_to_K,Drug\n23,F,HIGH,HIGH,25.355,drugY\n47,M,LOW,HIGH,13.093,drugC\n")
    declared = tables.read_csv(spark, str(path), "drug200")
    assert declared.dtypes[0] == ("Age", "bigint") and declared.dtypes[4] == ("Na_to_K", "double")
    assert tables.read_csv(spark, str(path)).count() == declared.count() == 2
    assert reshape.feature_kinds(declared, ["Age", "Sex"]) == {"Age": "continuous", "Sex": "categorical"}


def test_malformed_csv_fails(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("x,y\n1,2\nten,3\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(path), "x long, y long").collect()


def test_results_are_written_once(spark, tmp_path):
    out = str(tmp_path / "out")
    tables.write_table(spark.range(4).withColumn("part", F.col("id") % 2), out, partition_by=["part"])
    assert spark.read.parquet(out).count() == 4
    with pytest.raises(Exception):
        tables.write_table(spark.range(1), out)


def test_vectors_and_columns(spark):
    df = spark.createDataFrame([(1, 2, 3.5)], "id int, a int, b double")
    packed = reshape.to_vector(df, ["a", "b"])
    assert packed.first()["features"] == [2.0, 3.5]
    assert reshape.from_vector(packed, "features", 2).columns == ["id", "Column 0", "Column 1"]
    assert reshape.columns_between(df, None, -1).columns == ["id", "a"]
    assert tables.peek(spark.range(9), 3).count() == 3
    with pytest.raises(TypeError):
        reshape.feature_kinds(packed, ["features"])


def test_generators_follow_their_shares(spark):
    df = generators.with_yes_no(generators.key_table(spark, 6000), "id", seed=1)
    shares = df.agg(*[F.avg((F.col(c) == "Yes").cast("int")).alias(c) for c in generators.HEART_SHARES]).first()
    for name, share in generators.HEART_SHARES.items():
        assert abs(shares[name] - share) < 0.03
    again = generators.with_yes_no(generators.key_table(spark, 6000).repartition(9), "id", seed=1)
    assert again.exceptAll(df).count() == 0


def test_generated_ranges(spark):
    df = generators.with_integers(generators.key_table(spark, 2000), "id", "n", 1, 20, 3)
    df = generators.with_uniform(df, "id", "amount", 10, 1000, 3, places=2)
    row = df.agg(F.min("n"), F.max("n"), F.min("amount"), F.max("amount")).first()
    assert (row[0], row[1]) == (1, 19) and 10 <= row[2] < 20 and 990 < row[3] <= 1000


def test_two_gaussians(spark):
    df = generators.with_two_gaussians(generators.key_table(spark, 4000), "id", seed=2)
    rows = {r["y"]: r for r in df.groupBy("y").agg(
        F.avg("X").alias("m"), F.stddev("X").alias("s"), F.count("X").alias("n")).collect()}
    assert abs(rows[0]["m"] + 1.25) < 0.06 and abs(rows[1]["m"] - 1.25) < 0.06
    assert abs(rows[0]["s"] - 0.75) < 0.05 and abs(rows[0]["n"] - 2000) < 150


def test_synthetic_rows_stay_in_range(spark):
    df = spark.createDataFrame([(1, 3, 2.0), (2, 7, 9.0)], "id long, a int, b double")
    keys = spark.range(100, 400).withColumnRenamed("id", "id")
    rows = generators.with_synthetic_rows(df, ["a", "b"], keys, "id", seed=4)
    new = rows.where("id >= 100").agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    assert rows.count() == 302 and rows.dtypes == [("id", "bigint"), ("a", "int"), ("b", "double")]
    assert new[0] == 3 and new[1] == 6 and 2.0 <= new[2] and new[3] <= 9.0


def test_line_scan_reads_two_columns_only(spark, folder):
    df = tables.read_table(spark, folder, "lineitem").where("l_shipdate > '1998-01-01'")
    plan = linreg.coefficients(df, "l_quantity", "l_extendedprice")._jdf.queryExecution().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert schema == "struct<l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>"
    assert "GreaterThan(l_shipdate" in plan
