"""Distributed scan of transition functions.

A sequential fold over a key's rows becomes parallel when each chunk of rows is first reduced to its transition
function: which state it leaves for each state it may start in. Here such functions are piecewise constant and stored as
their break points, a few numbers where neighbouring pieces agree. A scan over them has three steps:

* up: the functions of one (key, partition) are composed into one;
* across: per key, the composed functions, at most one a partition, turn the initial state into each partition's;
* down: from its partition's state, each chunk's is found by going over the partition's functions in order.

No task reads all chunks of a key: up and down see one partition's, across sees one row a partition.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits below the partition number in ``monotonically_increasing_id``.
PARTITION_BITS = 33


class Transition:
    """How functions are stored, applied and composed. ``fields``/``state`` are DDL; ``start`` the state before a key's first row."""

    fields: str
    state: str
    start: tuple

    def apply(self, state: tuple, fn: tuple) -> tuple:
        raise NotImplementedError

    def then(self, first: tuple, second: tuple) -> tuple:
        raise NotImplementedError


class Steps(Transition):
    """Positions to positions: from p <= ends[k] (and > ends[k-1]) to outs[k]; beyond the last end, p stays."""

    fields = "ends array<bigint>, outs array<bigint>"
    state = "in_at bigint"
    start = (-1,)

    def apply(self, state, fn):
        ends, outs = fn
        k = bisect_left(ends, state[0])
        return (int(outs[k]),) if k < len(ends) else state

    def then(self, first, second):
        ends, outs = list(first[0]), [self.apply((o,), second)[0] for o in first[1]]
        return merge_steps(ends + list(second[0]), outs + list(second[1]))


def merge_steps(ends: list, outs: list) -> tuple[list, list]:
    """Neighbouring steps with one outcome become one."""
    keep = [k for k in range(len(ends)) if k + 1 == len(ends) or outs[k] != outs[k + 1]]
    return [int(ends[k]) for k in keep], [int(outs[k]) for k in keep]


def _names(ddl: str) -> list[str]:
    return [f.name for f in T.StructType.fromDDL(ddl)]


def _each(pdf: pd.DataFrame, cols: Sequence[str]) -> Iterator[tuple]:
    lists = [[v.tolist() if hasattr(v, "tolist") else v for v in pdf[c]] for c in cols]
    return zip(*lists)


def _frame(rows: list[tuple], cols: Sequence[str]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([r[k] for r in rows], dtype="object") for k, c in enumerate(cols)})


def _compose(keys: list[str], how: Transition):
    fields, n = _names(how.fields), len(keys) + 1

    def run(batches):
        who, fn = None, None
        for pdf in batches:
            out = []
            for row in _each(pdf, [*keys, "part", *fields]):
                if row[:n] == who:
                    fn = how.then(fn, row[n:])
                else:
                    if who is not None:
                        out.append(who + tuple(fn))
                    who, fn = row[:n], row[n:]
            yield _frame(out, [*keys, "part", *fields])
        if who is not None:
            yield _frame([who + tuple(fn)], [*keys, "part", *fields])
    return run


def _states(group: list[str], place: str, how: Transition, seeded: bool):
    """The state before each row, going over a group's functions in order from ``start`` (or the state columns, if seeded)."""
    fields, states, n = _names(how.fields), _names(how.state), len(group)

    def run(batches):
        who, state = None, None
        for pdf in batches:
            out = []
            for row in _each(pdf, [*group, place, *fields, *(states if seeded else [])]):
                if row[:n] != who:
                    who, state = row[:n], (row[n + 1 + len(fields):] if seeded else how.start)
                out.append(row[:n + 1] + tuple(state))
                state = how.apply(state, row[n + 1:n + 1 + len(fields)])
            yield _frame(out, [*group, place, *states])
    return run


def same(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``cols``, nulls alike, keeping the left side's."""
    other = right.select(*(F.col(c).alias(f"_r_{c}") for c in cols), *(c for c in right.columns if c not in cols))
    return left.join(other, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols], how).drop(*(f"_r_{c}" for c in cols))


def scan(tables: DataFrame, keys: Sequence[str], place: str, how: Transition, partition_shift: int) -> DataFrame:
    """The state each function of ``tables`` (keys, ``place``, the transition's fields) starts in: keys, place, state columns.

    ``place`` orders a key's functions; ``place >> partition_shift`` is the partition its rows lie in.
    """
    keys = list(keys)
    fields = _names(how.fields)
    tables = tables.select(*keys, place, *fields).withColumn("part", F.shiftright(place, partition_shift))
    kinds = [tables.schema[c] for c in keys]
    part, at = T.StructField("part", T.LongType()), T.StructField(place, T.LongType())
    fn_type, state_type = list(T.StructType.fromDDL(how.fields)), list(T.StructType.fromDDL(how.state))
    whole = (tables.repartition(*keys, "part").sortWithinPartitions(*keys, "part", place)
             .mapInPandas(_compose(keys, how), T.StructType([*kinds, part, *fn_type])))
    entry = (whole.repartition(*keys).sortWithinPartitions(*keys, "part")
             .mapInPandas(_states(keys, "part", how, False), T.StructType([*kinds, part, *state_type])))
    return (same(tables, entry, [*keys, "part"]).repartition(*keys, "part").sortWithinPartitions(*keys, "part", place)
            .mapInPandas(_states([*keys, "part"], place, how, True), T.StructType([*kinds, part, at, *state_type])).drop("part"))
