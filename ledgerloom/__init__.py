"""Retail and ERP ledger analytics as Spark DataFrame operators."""

from ledgerloom.model import Model
from ledgerloom.session import get_session

__all__ = ["Model", "get_session"]
