"""Column functions on loci.

A locus is (chrom, start, end, strand, id); ``end`` is inclusive and strand is
``+``, ``-`` or ``.`` (either). Functions that compare two loci take the column
prefix of each side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCUS_KEY = ["chrom", "start", "end", "strand"]


def _side(prefix: str) -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(prefix + name) for name in LOCUS_KEY)


def normalise(df: DataFrame) -> DataFrame:
    """Sort the coordinates of every locus and reject unknown strands."""
    bad = F.raise_error(F.concat(F.lit("unknown strand: "), F.coalesce("strand", F.lit("null"))))
    return df.withColumns(
        {
            "start": F.least("start", "end"),
            "end": F.greatest("start", "end"),
            "strand": F.when(F.col("strand").isin("+", "-", "."), F.col("strand")).otherwise(bad),
        }
    )


def length(start="start", end="end") -> Column:
    """Inclusive length of a locus."""
    return F.col(end) - F.col(start) + 1


def size(start="start", end="end") -> Column:
    """Exclusive span, the quantity summed for the size of a collection."""
    return F.col(end) - F.col(start)


def flip(strand) -> Column:
    return F.translate(strand, "+-", "-+")


def strand_matches(a: str, b: str, mode: str = "sense") -> Column:
    """Strand rule of ``sense``, ``antisense`` and ``both``; ``.`` goes with anything."""
    if mode == "both":
        return F.lit(True)
    left, right = F.col(a + "strand"), F.col(b + "strand")
    if mode == "antisense":
        right = flip(right)
    elif mode != "sense":
        raise ValueError(f"unknown strand mode {mode!r}")
    return (left == right) | (left == ".") | (right == ".")


def overlaps(a: str, b: str, mode: str = "sense") -> Column:
    """Both loci share at least one base."""
    ac, a0, a1, _ = _side(a)
    bc, b0, b1, _ = _side(b)
    return (ac == bc) & (a0 <= b1) & (b0 <= a1) & strand_matches(a, b, mode)


def contains(a: str, b: str, mode: str = "sense") -> Column:
    """Every base of ``b`` lies in ``a``."""
    ac, a0, a1, _ = _side(a)
    bc, b0, b1, _ = _side(b)
    return (ac == bc) & (a0 <= b0) & (b1 <= a1) & strand_matches(a, b, mode)


def text(prefix: str = "") -> Column:
    """``chr(strand):start-end``"""
    c, s, e, d = _side(prefix)
    return F.concat(c, F.lit("("), d, F.lit("):"), s.cast("string"), F.lit("-"), e.cast("string"))


def plot_text(prefix: str = "") -> Column:
    """``chr:strand:start-end``"""
    c, s, e, d = _side(prefix)
    return F.concat(c, F.lit(":"), d, F.lit(":"), s.cast("string"), F.lit("-"), e.cast("string"))


def place_text(prefix: str = "") -> Column:
    """``chr:start-end``"""
    c, s, e, _ = _side(prefix)
    return F.concat(c, F.lit(":"), s.cast("string"), F.lit("-"), e.cast("string"))


def gff_columns(id_col: str = "id") -> list[Column]:
    """The nine GFF columns of a locus."""
    blank = F.lit("")
    return [
        F.col("chrom").alias("seqname"), F.col(id_col).alias("source"), blank.alias("feature"),
        F.col("start"), F.col("end"), blank.alias("score"), F.col("strand"),
        blank.alias("frame"), F.col(id_col).alias("attribute"),
    ]


def parse_text(column) -> dict[str, Column]:
    """Columns of ``chr(strand):start-end``."""
    pattern = r"^(.*)\(([+\-.])\):(-?\d+)-(-?\d+)$"
    return {
        "chrom": F.regexp_extract(column, pattern, 1),
        "strand": F.regexp_extract(column, pattern, 2),
        "start": F.regexp_extract(column, pattern, 3).cast("long"),
        "end": F.regexp_extract(column, pattern, 4).cast("long"),
    }


def parse_region(column) -> dict[str, Column]:
    """Columns of a user region ``chr1:+:1-100``; anything else is an error."""
    pattern = r"^([^:]+):([+\-.]):(\d+)-(\d+)$"
    text_col = F.col(column) if isinstance(column, str) else column
    message = F.concat(F.lit("not a region of the form chr1:+:1-100: "), text_col)
    checked = F.when(text_col.rlike(pattern), text_col).otherwise(F.raise_error(message).cast("string"))
    return {
        "chrom": F.regexp_extract(checked, pattern, 1),
        "strand": F.regexp_extract(checked, pattern, 2),
        "start": F.regexp_extract(checked, pattern, 3).cast("long"),
        "end": F.regexp_extract(checked, pattern, 4).cast("long"),
    }


def flank(df: DataFrame, upstream: int, downstream: int) -> DataFrame:
    """Widen loci; on ``-`` upstream lies at the high coordinate."""
    minus = F.col("strand") == "-"
    return df.withColumns(
        {
            "start": F.col("start") - F.when(minus, F.lit(downstream)).otherwise(F.lit(upstream)),
            "end": F.col("end") + F.when(minus, F.lit(upstream)).otherwise(F.lit(downstream)),
        }
    )


def tss_window(upstream: int, downstream: int, tss="tss", strand="strand") -> dict[str, Column]:
    """Window around a transcription start; on ``-`` the sides swap."""
    minus = F.col(strand) == "-"
    return {
        "start": F.col(tss) - F.when(minus, F.lit(downstream)).otherwise(F.lit(upstream)),
        "end": F.col(tss) + F.when(minus, F.lit(upstream)).otherwise(F.lit(downstream)),
    }


def centre(start="start", end="end") -> Column:
    """Middle of a locus, rounded down (also below zero)."""
    return F.floor((F.col(start) + F.col(end)) / 2)


def centre_window(window: int, start="start", end="end") -> dict[str, Column]:
    middle = centre(start, end)
    return {"start": middle - window, "end": middle + window}


def stretch_to(minimum: int, start="start", end="end") -> dict[str, Column]:
    """Pad both sides of loci shorter than ``minimum`` until they reach it."""
    span = F.col(end) - F.col(start)
    pad = F.when(span < minimum, F.floor((F.lit(minimum) - span) / 2)).otherwise(F.lit(0)).cast("long")
    return {"start": F.col(start) - pad, "end": F.col(end) + pad}
