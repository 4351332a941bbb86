"""What became of every row of a load, counted by the job that writes it.

A landed file's rows are loaded, or skipped because they have more cells than the header. Of the loaded ones some were
short and filled up, and some cells may not fit their column's type. Metrics observe all of that in the write
itself: each task sends one line of counts, and no row is read a second time.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quipu.functions.text import col
from quipu.sources.landing import LONG, SHORT, fitting, is_code, typed


class Refused(Exception):
    """Too much of a load does not fit; the table was left as it was. ``account`` tells of its rows."""

    def __init__(self, text: str, account: Account):
        super().__init__(text)
        self.account = account


@dataclass(frozen=True)
class Account:
    """Rows read, skipped as over-long, filled up as short, and loaded; cells that fit no type, by column."""

    read: int
    long: int
    short: int
    loaded: int
    invalid: dict[str, int]

    @property
    def invalid_cells(self) -> int:
        return sum(self.invalid.values())

    def check(self, most: int) -> None:
        """Refuses the load where more than ``most`` cells would be lost."""
        if self.invalid_cells > most:
            cells = ", ".join(f"{n} in {c}" for c, n in sorted(self.invalid.items()) if n)
            raise Refused(f"cells that do not fit their type: {cells}", self)


class Counter:
    """``rows`` are the typed rows to write; when they are written, ``account`` tells what became of all."""

    def __init__(self, marked: DataFrame, types: Mapping[str, str]):
        over, under = F.col(LONG), F.col(SHORT)
        self.columns = [n for n in marked.columns if n in types and not is_code(n)]
        fits = {n: col(n).try_cast(types[n]) for n in self.columns}
        lost = [F.count_if(~over & col(n).isNotNull() & fits[n].isNull()).alias(f"m{i}") for i, n in enumerate(self.columns)]
        self.observed = Observation()
        counted = marked.observe(
            self.observed,
            F.count(F.lit(1)).alias("read"),
            F.count_if(over).alias("long"),
            F.count_if(under).alias("short"),
            *lost,
        )
        self.rows = typed(fitting(counted), types)

    def account(self) -> Account:
        found = self.observed.get
        invalid = {n: found[f"m{i}"] for i, n in enumerate(self.columns)}
        return Account(found["read"], found["long"], found["short"], found["read"] - found["long"], invalid)
