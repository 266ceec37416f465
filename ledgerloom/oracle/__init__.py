"""Independent SQL for every report, to compare results with another engine."""

from ledgerloom.oracle.build import oracle_sql

__all__ = ["oracle_sql"]
