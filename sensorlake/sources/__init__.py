from sensorlake.sources.headers import escaped, read_csv_by_name
from sensorlake.sources.readers import CORRUPT, preview, read_measurements_csv, read_path, read_table

__all__ = [
    "CORRUPT",
    "escaped",
    "preview",
    "read_csv_by_name",
    "read_measurements_csv",
    "read_path",
    "read_table",
]
