"""Column functions on signal and expression values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def subtract_background(signal, background) -> Column:
    """Signal minus background, not below 0."""
    return F.greatest(F.lit(0.0), _c(signal) - _c(background))


def expression_floor(value) -> Column:
    """Missing and negative to 0; positive values below 0.01 to 0.01."""
    col = F.coalesce(_c(value), F.lit(0.0))
    return F.when(col < 0, 0.0).when((col > 0) & (col < 0.01), 0.01).otherwise(col)


def log2_ratio(a, b, mmr_a, mmr_b, epsilon: float = 1.0) -> Column:
    return F.log2((_c(a) / _c(mmr_a) + epsilon) / (_c(b) / _c(mmr_b) + epsilon))


def clipped_log2_fold(after, before, scale_after, scale_before, limit: float = 8.0) -> Column:
    """log2 fold of values floored at 1 and divided by their scale, clipped to +-limit."""
    up = F.greatest(_c(after), F.lit(1.0)) / _c(scale_after)
    down = F.greatest(_c(before), F.lit(1.0)) / _c(scale_before)
    return F.greatest(F.lit(-limit), F.least(F.lit(limit), F.log2(up / down)))


def density(count, start, end, mapped) -> Column:
    """Reads per million per base; NULL for an empty span."""
    width = F.nullif(_c(end) - _c(start), F.lit(0))
    return _c(count) / width / (_c(mapped) / 1e6)


def change_class(change, cutoff: float, gained="GAINED", lost="LOST", same="CONSERVED") -> Column:
    col = _c(change)
    return F.when(col > cutoff, gained).when(col < -cutoff, lost).otherwise(same)


def magnitude(x, y) -> Column:
    return F.sqrt(_c(x) * _c(x) + _c(y) * _c(y))


def diagonal_skew(x, y) -> Column:
    """Distance from the diagonal x = y."""
    middle = (_c(x) + _c(y)) / 2
    return F.sqrt(2 * (_c(x) - middle) * (_c(x) - middle))
