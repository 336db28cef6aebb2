"""Batch sinks (K1, K2, K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowtally.schemas import conform


def write_csv_parts(df: DataFrame, path: str, header: bool = True) -> None:
    """K1: a result as headered CSV part files, one directory per result.

    Every task writes its own part; nothing is funnelled through one task.
    """
    df.write.mode("overwrite").option("header", header).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write a table below the shared folder and return a DataFrame reading it.

    Used to cut lineage (e.g. a baseline that a stream looks up every
    micro-batch) in a way that survives the loss of any executor.
    """
    df.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "overwrite", result_table: str | None = None,
               series: tuple[str, ...] = ()) -> None:
    """K2: write a result to a relational table with its declared schema.

    Spark's JDBC writer opens one connection per partition and batches the
    inserts (``batchsize``); ``numPartitions`` caps concurrent connections.
    The default replaces the table's rows (``truncate``, keeping its
    definition), so an import that is run twice leaves it the same.
    """
    if result_table is not None:
        df = conform(df, result_table, series)
    df.write.mode(mode).option("truncate", True).jdbc(url, table, properties=properties or {})


def save_result_table(df: DataFrame, name: str, result_table: str, path: str,
                      series: tuple[str, ...] = (), mode: str = "overwrite") -> DataFrame:
    """K2 on Spark's own catalog: the result, conformed to its declared
    schema, saved as table ``name`` with its files at ``path`` (a shared
    folder), then returned as read from the catalog."""
    (conform(df, result_table, series).write.mode(mode).format("parquet")
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def export_csv(df: DataFrame, path: str) -> None:
    """K4: export a result table as ONE headered CSV file.

    The result is computed in parallel; only the writing of the finished rows
    is one task, which is what one file means.  For results that should not
    pass through one task, :func:`write_csv_parts` writes a file per task.
    """
    (df.repartition(1).write.mode("overwrite").option("header", True)
     .option("maxRecordsPerFile", 0).csv(path))
