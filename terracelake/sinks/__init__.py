"""Writers for processed tables and for published results."""

from terracelake.sinks.files import publish, write_csv, write_parquet, write_partitioned
from terracelake.sinks.swap import replaced

__all__ = ["publish", "replaced", "write_csv", "write_parquet", "write_partitioned"]
