"""Reading declared CSV files and Parquet tables, writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The column names and types of the sample CSV files.
CSV_SCHEMAS = {
    "advertising": "TV double, Radio double, Newspaper double, Sales double",
    "diabetes": (
        "Pregnancies long, Glucose long, BloodPressure long, SkinThickness long, Insulin long, "
        "BMI double, DiabetesPedigreeFunction double, Age long, Outcome long"
    ),
    "mall_customers": (
        "CustomerID long, Gender string, Age long, `Annual Income (k$)` long, "
        "`Spending Score (1-100)` long"
    ),
    "drug200": "Age long, Sex string, BP string, Cholesterol string, Na_to_K double, Drug string",
}


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header line. ``schema`` is a DDL string or a known file's name.

    Without one the types are inferred, which costs an extra pass over the file.
    """
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.schema(CSV_SCHEMAS.get(schema, schema)).csv(
        path, header=True, enforceSchema=False, mode="FAILFAST")


def read_table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    """A Parquet table.

    ``spread`` deals the rows out to all cores when the scan has fewer tasks than
    that, as with one file; it pays before repeated passes and shuffles nothing
    where there are files enough.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def peek(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
