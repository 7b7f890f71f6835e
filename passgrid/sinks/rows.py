"""Rows into relational tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame

from passgrid.settings import DETAIL_COLUMNS, TrafficSettings

# ---- Fixed values: table and column names --------------------------------------------------------------------------

DETAIL_TABLE = "traffic_pass_dev"
STATS_TABLE = "stats_realtime"
ALERT_TABLE = "alert_plate_clone"
STATS_COLUMNS = ["station_id", "window_start", "window_end", "cnt", "by_dir", "by_type"]
ALERT_COLUMNS = [
    "station_id", "hphm_mask", "first_station_id", "second_station_id", "time_gap_sec", "distance_km", "speed_kmh",
    "confidence",
]
DETAIL_TABLE_COLUMNS = [*DETAIL_COLUMNS, "created_at"]


def jdbc_options(url: str, table: str, *, user: str, password: str, batch_size: int = TrafficSettings.batch_size,
                 driver: str = "com.mysql.cj.jdbc.Driver", connections: int = 32) -> dict[str, str]:
    """Options of Spark's JDBC writer; ``connections`` limits how many tasks write at once."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
    }


def write_jdbc(df: DataFrame, options: dict[str, str], columns: Sequence[str]) -> None:
    """Append through Spark's JDBC writer. The driver jar must be on the class path."""
    df.select(*columns).write.format("jdbc").options(**options).mode("append").save()


def insert_statement(table: str, columns: Sequence[str], mark: str = "%s") -> str:
    names = ",".join(columns)
    return f"INSERT INTO {table} ({names}) VALUES ({','.join([mark] * len(columns))})"


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str], mark: str = "%s") -> str:
    """MySQL upsert on the table's unique key; the last write wins."""
    updates = ",".join(f"{c}=VALUES({c})" for c in columns if c not in keys)
    return f"{insert_statement(table, columns, mark)} ON DUPLICATE KEY UPDATE {updates}"


def write_rows(df: DataFrame, connect: Callable[[], Any], statement: str, columns: Sequence[str], *,
               batch_size: int = TrafficSettings.batch_size, connections: int = 32) -> None:
    """Run ``statement`` for every row, each task over its own DB-API connection, committing per batch; at most
    ``connections`` tasks write.

    Delivery is at least once, as a task may be repeated; an upsert statement makes repeats harmless.
    """

    def write_partition(rows: Iterator) -> None:
        rows = iter(rows)
        connection = None
        try:
            while chunk := [tuple(r) for r in islice(rows, batch_size)]:
                connection = connection or connect()
                cursor = connection.cursor()
                cursor.executemany(statement, chunk)
                connection.commit()
                cursor.close()
        finally:
            if connection is not None:
                connection.close()

    df.select(*columns).coalesce(connections).foreachPartition(write_partition)


def jdbc_batches(options: dict[str, str], columns: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: append each micro-batch by JDBC. A replayed batch is appended again (at least once)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_jdbc(batch, options, columns)

    return write


def row_batches(connect: Callable[[], Any], statement: str, columns: Sequence[str], *,
                batch_size: int = TrafficSettings.batch_size,
                connections: int = 32) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: run a statement for each row; with an upsert, a replayed batch changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_rows(batch, connect, statement, columns, batch_size=batch_size, connections=connections)

    return write
