"""Device events: arriving JSON files to bronze, upserted silver, monthly gold."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import to_event_time
from tierline.operators.cleaning import date_parts_first, empty_like
from tierline.operators.rollup import ROWS, monthly_rollup
from tierline.sources import storage
from tierline.sources.catalog import Workspace, maintain
from tierline.sources.files import read_json
from tierline.sources.versioned import VersionedTable
from tierline.streaming.ingest import copy_into, merge_new, rollup_new, start_stream

# Table and column names of the flow.
DEVICES, BRONZE, SILVER, GOLD = (
    "iot_devices", "iot_stream_bronze", "iot_stream_silver", "iot_stream_gold",
)
SUMS = "iot_stream_gold_sums"
KEYS = ["device_id", "id", "user_id"]
MEASURES = ["calories_burnt", "miles_walked", "num_steps"]
GOLD_COLUMNS = [
    "calories_burnt", "device_id", "id", "miles_walked", "num_steps", "user_id", "year", "month",
]


def load_devices(ws: Workspace, folder: str) -> VersionedTable:
    """Bulk load: an empty table with the schema of the files, then each file once."""
    ws.use()
    table = ws.table(DEVICES)
    if not table.exists:
        table.create(empty_like(read_json(ws.spark, folder)).schema)
    copy_into(table, folder)
    ws.register(DEVICES)
    return table


def bronze(
    ws: Workspace, folder: str, *, checkpoint: str, schema_location: str, **options: str
) -> VersionedTable:
    """Append what has arrived since the last call, then stop. Files get the table's size; the schema grows
    at any depth."""
    ws.use()
    options = {"evolve": "nested", **options}
    table = ws.table(BRONZE, size_writes=True)
    query = start_stream(
        table, folder, checkpoint=checkpoint, schema_location=schema_location, **options
    )
    query.awaitTermination()
    ws.register(BRONZE)
    return table


def silver(
    ws: Workspace,
    *,
    erase_ids: Iterable[int] | DataFrame = (),
    latest_by: str | None = None,
    restore_to: int | None = None,
) -> VersionedTable:
    """Upsert the new bronze rows by ``id``, partition by month, erase, cluster.

    Bronze may hold an ``id`` many times. On the first run all its rows are inserted; later a
    repeated ``id`` that silver already has is an error unless ``latest_by`` names the column with
    the moment that picks the row to keep; a moment that can't be read comes before all others.
    ``erase_ids`` is a list of ids or a frame with a column ``id``. ``restore_to`` goes back to an
    earlier version before clustering, which also brings erased rows back; leave it out to keep
    them erased.
    """
    ws.use()
    source, table = ws.table(BRONZE), ws.table(SILVER, size_writes=True)
    if not table.exists:
        table.create(source.schema)
    parted = "year" in table.schema.fieldNames()
    merge_new(
        table,
        source,
        ["id"],
        order_by=[_moment(source, latest_by), latest_by] if latest_by else None,
        prepare=_with_month if parted else None,
    )
    if not parted:
        table.replace(_with_month(table.read()), partition_by=["year", "month"])
    if isinstance(erase_ids, DataFrame):
        table.delete_keys(erase_ids, "id")
    elif ids := [(int(i),) for i in erase_ids]:
        table.delete_keys(ws.spark.createDataFrame(ids, "id bigint"), "id")
    if restore_to is not None:
        table.restore(restore_to)
    table.cluster("id")
    ws.register(SILVER)
    return table


def _moment(table: VersionedTable, column: str) -> Column:
    return to_event_time(F.col(column), table.schema[column].dataType)


def _with_month(df: DataFrame) -> DataFrame:
    return date_parts_first(df, "timestamp")


def gold(ws: Workspace, *, incremental: bool = False) -> DataFrame:
    """Sums per month, device, id and user, partitioned by month.

    ``incremental``: kept from call to call by what changed in silver, in a table of their own that the
    name of the gold table shows.
    """
    ws.use()
    if incremental:
        rollup_new(ws.table(SUMS), ws.table(SILVER), "timestamp", KEYS, MEASURES)
        ws.register(SUMS)
        return ws.show(GOLD, f"SELECT {', '.join(GOLD_COLUMNS)} FROM {SUMS} WHERE {ROWS} > 0")
    sums = monthly_rollup(ws.table(SILVER).read(), "timestamp", KEYS, MEASURES)
    return ws.save(GOLD, sums.select(*GOLD_COLUMNS), partition_by=["year", "month"])


def daily_maintenance(ws: Workspace) -> None:
    """Put small files of silver and gold together and cluster them by ``id``."""
    maintain(ws, {SILVER: "id", GOLD: "id"})


def cleanup(ws: Workspace, *folders: str) -> None:
    """Start over: drop the tables, and remove the folders of input, checkpoint and schema.

    The folders need not lie below the workspace, but must be named one by one.
    """
    ws.drop([DEVICES, BRONZE, SILVER, GOLD, SUMS])
    for folder in folders:
        storage.remove(ws.spark, folder)
