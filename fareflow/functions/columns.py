from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

def duration_minutes(start: str | Column, end: str | Column) -> Column:
    """Minutes between two instants; each end is cut to whole seconds first."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60)


def round_stable(value: Column, digits: int) -> Column:
    """Round half up, giving the same answer whatever order the sum was taken in.

    A double sum differs in its last bits from run to run, which decides ties at
    random (266.4 / 32 is 8.325 or a hair below). Going through ten decimals first
    removes that noise. NaN and infinities stay what they are; a number of more than 28
    digits before the point has no such decimals and gives null.
    """
    settled = F.round(value.try_cast("decimal(38,10)"), digits).cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), settled).otherwise(value)


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; null where ``whole`` is zero."""
    return F.try_divide(part, whole) * F.lit(100)


def moment(value: Column | datetime | None) -> Column:
    """A timestamp column: the given one, or the time the query started."""
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value)


def in_split(keys: Sequence[str | Column], percent: int) -> Column:
    """True for a fixed ``percent`` of all keys, whatever the partitioning; see ``in_share``."""
    return in_share(keys, _share(percent))


def in_share(keys: Sequence[str | Column], share: float) -> Column:
    """True for a fixed share, from 0 to 1, of all keys.

    A key's MD5 is compared, as text, with the same share of the hash range, so a row
    lands on the same side in every run and equal keys are never parted. Any SQL engine
    can repeat it.
    """
    digest = F.md5(F.concat_ws("-", *keys).cast("binary"))
    bound = round(2**32 * share)
    return F.lit(True) if bound >= 2**32 else digest < f"{bound:08x}"


def in_hash_split(keys: Sequence[str | Column], percent: int) -> Column:
    """The same by Spark's own hash of the typed values.

    Nothing is turned into text, so it is cheaper where times and doubles make up the
    key, and the session's time zone has no say in it.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(10_000)) < round(10_000 * _share(percent))


def _share(percent: int) -> float:
    if not 0 < percent < 100:
        raise ValueError(f"percent must lie between 0 and 100, not {percent}")
    return percent / 100
