"""File sinks (K1-K7)."""

from cargoline.sinks.files import (
    SinkExistsError,
    SinkSpec,
    read_back,
    rows_per_directory,
    write,
    write_by_date,
)

__all__ = [
    "SinkExistsError",
    "SinkSpec",
    "read_back",
    "rows_per_directory",
    "write",
    "write_by_date",
]
