"""Column functions on nucleotide text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(column, *, reverse: bool = True, rna: bool = False) -> Column:
    """Complement (reversed unless told otherwise); other letters stay as they are."""
    col = F.col(column) if isinstance(column, str) else column
    paired = F.translate(col, "ACGTUacgtu", "UGCAAugcaa" if rna else "TGCAAtgcaa")
    return F.reverse(paired) if reverse else paired


def anchored_slice(column, anchor: str, offset: int, length: int, source=None) -> Column:
    """``length`` characters of ``source`` from ``offset`` past the first anchor in ``column``.

    NULL without an anchor; a short tail gives a short slice.
    """
    at = F.instr(column, anchor)
    text = F.col(source if source is not None else column)
    return F.when(at > 0, F.substr(text, at + offset, F.lit(length)))
