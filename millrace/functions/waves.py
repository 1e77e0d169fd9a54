"""Wave and counter series as arithmetic over a row number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The turn used for one full wave, and the growth per month.
TURN = 6.28
MONTH_GROWTH = [
    (1, 1.04), (2, 1.0), (3, 1.0), (4, 1.0), (5, 1.0), (6, 1.10),
    (7, 1.0), (8, 1.0), (9, 1.0), (10, 1.0), (11, 1.08), (12, 1.18),
]


def cosine_wave(rownum: Column, period: float, amplitude: float = 1.0, offset: float = 0.0,
                shift: int = 1) -> Column:
    """``offset + amplitude * cos((rownum - shift) * TURN / period)``."""
    turn = F.cos((rownum - F.lit(shift)) * F.lit(TURN) / F.lit(float(period)))
    return F.lit(float(offset)) + F.lit(float(amplitude)) * turn


def growing(value: Column, rownum: Column) -> Column:
    """A value scaled by its place in the series."""
    return value * rownum


def counter_reset(rownum: Column, every: int = 10) -> Column:
    """1..every, then again from 1."""
    place = rownum % every
    return F.when(place == 0, F.lit(every)).otherwise(place)
