from tidelane.sources.log import fill_time_by_increment, ingest_keyvalue_log, parse_keyvalue_lines
from tidelane.sources.sinks import write_csv_series, write_parquet_series, write_products
from tidelane.sources.tables import (
    read_csv_lenient_time,
    read_epoch_table,
    read_instrument_csv,
    read_intervals,
    read_oxygen,
    read_parquet_series,
)
from tidelane.sources.tracks import ingest_track_points
