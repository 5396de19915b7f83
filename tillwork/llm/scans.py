"""Running values over arrays inside one row, with DataFrame functions only.

Adding to an array copies it, so a running value built element by element costs the square
of the length. Built in pieces of ``PIECE`` elements, which are then moved by what lies before
them, it costs little more than the length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _last(values: Column) -> Column:
    return F.get(values, F.size(values) - 1)


def _appended(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    none = F.array().cast("array<int>")
    return F.aggregate(
        values,
        none,
        lambda done, v: F.concat(
            done, F.array(F.when(F.size(done) > 0, join(_last(done), v)).otherwise(v))
        ),
    )


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each of some ints, what ``join``, which is associative, makes of all up to it."""

    def in_pieces(v: Column) -> Column:
        last = F.greatest(F.ceil(F.size(v) / PIECE).cast("int") - 1, F.lit(0))
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: _appended(F.slice(v, i * PIECE + 1, F.lit(PIECE)), join),
        )

    def moved(pieces: Column, before: Column) -> Column:
        return F.flatten(
            F.transform(
                pieces,
                lambda p, i: F.when(i == 0, p).otherwise(
                    let(F.get(before, i - 1), lambda b: F.transform(p, lambda v: join(b, v)))
                ),
            )
        )

    return let(
        let(values, in_pieces),
        lambda pieces: let(
            _appended(F.transform(pieces, _last), join), lambda before: moved(pieces, before)
        ),
    )


def shifted(values: Column, first: int) -> Column:
    """Each value one place on, with ``first`` in front."""
    return let(
        F.concat(F.array(F.lit(first)), values), lambda v: F.slice(v, F.lit(1), F.size(v) - 1)
    )
