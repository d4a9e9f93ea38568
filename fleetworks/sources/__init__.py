from fleetworks.sources.catalog import Catalog, conform, csv_scan, parquet_scan
from fleetworks.sources.literals import literal_frame
from fleetworks.sources.sinks import (
    append_jdbc,
    append_missing,
    as_messages,
    publish_kafka,
    write_csv,
    write_daily_csv,
    write_table,
)

__all__ = [
    "Catalog", "conform", "csv_scan", "parquet_scan", "literal_frame", "append_jdbc", "append_missing", "as_messages", "publish_kafka",
    "write_csv", "write_daily_csv", "write_table",
]
