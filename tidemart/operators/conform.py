"""Warehouse column contracts: typed projection and a report of breaches."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.schema import TableContract
from tidemart.session import together


def conform(frame: DataFrame, contract: TableContract) -> DataFrame:
    """The contract's columns in its order and types; a value that does not fit raises."""
    return frame.select(
        *(F.col(name).cast(dtype).alias(name) for name, dtype in contract.columns)
    )


class ContractWatch:
    """Counts a frame's breaches of its contract while something else reads the frame.

    ``watched`` is the frame with counters on the way: NULLs where none may be and values that do not fit. They
    are there once an action over it has ended, so a write of the frame counts them for free. Whether keys
    repeat needs a shuffle of the keys alone, over the frame or what was written of it.
    """

    def __init__(self, frame: DataFrame, contract: TableContract):
        self.contract, self._counted = contract, Observation()
        tests: dict[str, Column] = {}
        for name, dtype in contract.columns:
            column = F.col(name)
            if name not in contract.nullable:
                tests[f"not_null:{name}"] = column.isNull()
            if isinstance(dtype, (T.DecimalType, T.IntegerType)):
                tests[f"fits:{name}"] = column.isNotNull() & column.try_cast(dtype).isNull()
        self.rules = list(tests)
        self.watched = frame.observe(
            self._counted, *(F.count_if(test).alias(f"rule_{i}") for i, test in enumerate(tests.values()))
        )

    def repeated(self, rows: DataFrame) -> int:
        """Rows beyond the first of each key; an action."""
        keys = rows.groupBy(*self.contract.key).agg((F.count("*") - 1).alias("more"))
        return keys.agg(F.sum("more")).first()[0] or 0

    def breaches(self, repeated: int) -> list[tuple[str, str, int]]:
        """``(table_name, rule, breaches)``; call it after an action over ``watched``."""
        # An empty frame may be optimised away with its counters.
        counted = self._counted.get
        found = [(rule, counted.get(f"rule_{i}") or 0) for i, rule in enumerate(self.rules)]
        found.append(("unique:" + ",".join(self.contract.key), repeated))
        return [(self.contract.name, rule, count) for rule, count in found]


BREACHES = "table_name string, rule string, breaches bigint"


def contract_breaches(frame: DataFrame, contract: TableContract) -> DataFrame:
    """``(table_name, rule, breaches)`` for every promise of the contract.

    Rules are ``not_null:<column>``, ``fits:<column>`` (non-null values that the column's type
    cannot hold) and ``unique:<key>`` (rows beyond the first per key). The frame is read once: the first two
    are counted in passing, and the keys with their counts are all that is shuffled.
    """
    return all_breaches([(frame, contract)])


def all_breaches(frames: list[tuple[DataFrame, TableContract]]) -> DataFrame:
    """The breaches of several frames, which are read at the same time."""

    def counted(frame: DataFrame, contract: TableContract) -> list[tuple[str, str, int]]:
        watch = ContractWatch(frame, contract)
        return watch.breaches(watch.repeated(watch.watched))

    found = together([partial(counted, *pair) for pair in frames])
    return frames[0][0].sparkSession.createDataFrame([row for rows in found for row in rows], BREACHES)
