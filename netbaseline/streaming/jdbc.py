"""Keyed merge of result rows into a JDBC table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def upsert_statement(table: str, staging: str) -> str:
    """Keyed merge of a staging table into the result table: new keys are inserted, known ones get the new profile."""
    columns = ("id", "modeling_params_id", "src_id", "src_ip", "protocol", "flow", "up_down", "in_out", "time")
    names = ", ".join(f"`{c}`" for c in columns)
    return (f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} AS s "
            f"ON DUPLICATE KEY UPDATE `flow` = s.`flow`")


def upsert_to_jdbc(rows: DataFrame, options: dict, execute=None) -> None:
    """Merge result rows into a JDBC table by key, in one statement; rows of other models stay.

    The rows (profile as JSON text) go to ``<dbtable>_staging`` first, which a
    repeated call simply replaces; ``id`` must be the table's unique key.
    ``options`` are Spark's JDBC options; ``execute`` runs a statement (default:
    over the driver's own JDBC connection).
    """
    staging = f"{options['dbtable']}_staging"
    writer = rows.withColumn("flow", F.to_json("flow")).write.format("jdbc").mode("overwrite")
    for k, v in (options | {"dbtable": staging}).items():
        writer = writer.option(k, v)
    writer.save()
    (execute or _execute_over_jdbc(rows.sparkSession, options))(upsert_statement(options["dbtable"], staging))


def _execute_over_jdbc(spark: SparkSession, options: dict):
    def execute(statement: str) -> None:
        manager = spark.sparkContext._jvm.java.sql.DriverManager
        connection = manager.getConnection(options["url"], options.get("user"), options.get("password"))
        try:
            connection.createStatement().executeUpdate(statement)
        finally:
            connection.close()

    return execute
