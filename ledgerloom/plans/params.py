"""Parameters of the registered reports, in place of the wall clock."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from ledgerloom.functions.months import Month, months_between


@dataclass(frozen=True)
class Params:
    as_of: date = date(2001, 6, 30)
    check_day: date = date(1995, 7, 20)
    project: str = "BUILDING"
    years: tuple[int, ...] = (1997, 1998, 1999, 2000, 2001)
    first_month: int = 1
    last_month: int = 6
    pool: int = 200
    picks: int = 3
    units: int = 2
    seed: int = 7
    batch_size: int = 100
    holidays: tuple[date, ...] = field(
        default_factory=lambda: tuple(date(y, m, d) for y in range(1995, 2002)
                                      for m, d in ((2, 21), (3, 26), (5, 1), (12, 16))))

    def back(self, days: int) -> date:
        return self.as_of - timedelta(days=days)

    @property
    def ledger_end(self) -> date:
        return self.back(3)

    @property
    def ledger_start(self) -> date:
        return self.ledger_end - timedelta(days=720)

    @property
    def months(self) -> list[Month]:
        return months_between(self.ledger_start, self.ledger_end)

    @property
    def pl_months(self) -> list[Month]:
        """The months, with the opening period 0 of each year."""
        years = sorted({y for y, _ in self.months})
        return sorted([*self.months, *[(y, 0) for y in years]])

    @property
    def profit_window(self) -> tuple[date, date]:
        return self.back(33), self.back(2)


DEFAULT = Params()
