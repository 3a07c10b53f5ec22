"""Publishing to a warehouse table over JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from millrace.operators.mapping import warehouse_columns, warehouse_ddl


def writer_options(columns: Sequence[tuple[str, str]], options: dict) -> dict:
    """Caller's JDBC options plus the declared column types."""
    return {
        "createTableColumnTypes": warehouse_ddl(columns),
        **options,
    }


def publish_jdbc(df: DataFrame, columns: Sequence[tuple[str, str]], options: dict) -> None:
    """Drop, create as declared and load the table `options['dbtable']`, in declared order."""
    (warehouse_columns(df, columns).write.format("jdbc").mode("overwrite")
     .options(**writer_options(columns, options)).save())
