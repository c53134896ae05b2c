"""CSV, event-domain, feature-table and split-id sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Microsecond text form so timestamps survive a CSV round trip unchanged.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DOMAIN_COLUMN = "domain"
HELPER_COLUMNS = ("chunk",)


def read_csv_table(spark: SparkSession, path: str, schema: StructType | str,
                   columns: list[str] | None = None) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass), whose names the
    header must match; optional subset (S1, E7)."""
    df = (spark.read.schema(schema).option("header", True)
          .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
          .option("mode", "FAILFAST").option("enforceSchema", False).csv(path))
    return df.select(*columns) if columns else df


def write_csv_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, no index column (S2). One file per partition, written in parallel."""
    (df.write.mode(mode).option("header", True)
     .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).csv(path))


def write_domains(domains: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """Event domains as one hive-partitioned dataset, ``domain=NAME``.

    Each domain keeps its own columns (point and interval forms differ), so
    each is written to its own partition directory.
    """
    for name, df in domains.items():
        df.write.mode(mode).parquet(f"{path.rstrip('/')}/{DOMAIN_COLUMN}={name}")


def domain_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the stored domains, from the partition column alone."""
    rows = spark.read.parquet(path).select(DOMAIN_COLUMN).distinct().collect()
    return sorted(r[DOMAIN_COLUMN] for r in rows)


def read_domains(spark: SparkSession, path: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Domain dict back from :func:`write_domains` (S3); each read prunes to its
    own partition directory and schema."""
    names = domain_names(spark, path) if names is None else names
    root = path.rstrip("/")
    return {n: spark.read.parquet(f"{root}/{DOMAIN_COLUMN}={n}") for n in names}


def select_domains(names, include: str = "base", exclude: str = "INPUT", suffix: str = "_base") -> dict[str, str]:
    """Pick table names containing ``include`` and not ``exclude``; the output
    name is the text before ``suffix`` (S7, P10)."""
    out = {}
    for n in names:
        if include in n and exclude not in n:
            out[n.split(suffix)[0]] = n
    return out


def write_features(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Feature table sink."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature table scan; helper columns such as ``chunk`` are dropped."""
    df = spark.read.parquet(path)
    return df.drop(*[c for c in HELPER_COLUMNS if c in df.columns])


def write_split_ids(splits: DataFrame, path: str, id_col: str = "ID") -> None:
    """Split assignment as JSON lines partitioned by split (S15). The ids stay
    distributed instead of one JSON document of lists."""
    splits.select(id_col, "split").write.mode("overwrite").partitionBy("split").json(path)


def read_split_ids(spark: SparkSession, path: str, id_col: str = "ID") -> DataFrame:
    return spark.read.schema(f"{id_col} long, split string").json(path).select(id_col, F.col("split"))
