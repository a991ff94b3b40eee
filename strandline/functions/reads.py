"""Column functions on alignments.

A read has ``pos`` (0-based start), ``flag``, ``cigar`` and ``seq``; its
aligned span ``start``..``end`` is half open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strand_of(flag="flag") -> Column:
    """Bit 16 of the flag marks the reverse strand."""
    return F.when(F.col(flag).bitwiseAND(16) != 0, "-").otherwise("+")


def is_mapped(flag="flag") -> Column:
    return F.col(flag).bitwiseAND(4) == 0


def aligned_length(cigar="cigar") -> Column:
    """Reference bases covered: the M, D and N operations."""
    col = F.col(cigar)
    plain = F.translate(col, "0123456789", "") == "M"
    parts = F.regexp_extract_all(col, F.lit("([0-9]+)[MDN]"), F.lit(1))
    total = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, n: acc + n.cast("long"))
    return F.when(plain, F.rtrim(col, F.lit("M")).cast("long")).otherwise(total)


def junctions(cigar="cigar") -> Column:
    return F.length(cigar) - F.length(F.translate(F.col(cigar), "N", ""))


def with_span(df: DataFrame) -> DataFrame:
    """Add ``start``, ``end`` (half open) and ``strand`` from pos, cigar and flag."""
    return df.withColumns(
        {"start": F.col("pos"), "end": F.col("pos") + aligned_length(), "strand": strand_of()})


def extended(extension: int, start="start", end="end", strand="strand") -> dict[str, Column]:
    """Span grown at its 3' end; the start never drops below 0."""
    if not extension:
        return {"ext_start": F.col(start), "ext_end": F.col(end)}
    forward = F.col(strand) == "+"
    return {
        "ext_start": F.when(forward, F.col(start)).otherwise(
            F.greatest(F.lit(0), F.col(start) - extension)),
        "ext_end": F.when(forward, F.col(end) + extension).otherwise(F.col(end)),
    }


def on_strand(mode: str, region_strand: str, read_strand: str = "strand") -> Column:
    """Reads a region wants: ``.`` all, ``+`` its own strand, ``-`` the opposite one."""
    wanted, own = F.col(region_strand), F.col(read_strand)
    if mode == ".":
        return F.lit(True)
    if mode == "-":
        wanted = F.translate(wanted, "+-", "-+")
    elif mode != "+":
        raise ValueError(f"unknown read strand mode {mode!r}")
    return (wanted == ".") | (wanted == own)


def without_junctions(df: DataFrame) -> DataFrame:
    return df.where(~F.col("cigar").contains("N"))


def read_loci(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Reads as closed loci from their 1-based start over the sequence length.

    A read with one junction becomes two loci, one with more is dropped.
    """
    first = F.regexp_extract("cigar", r"^\D*(\d+)\D+(\d+)\D+(\d+)", 1).cast("long")
    gap = F.regexp_extract("cigar", r"^\D*(\d+)\D+(\d+)\D+(\d+)", 2).cast("long")
    second = F.regexp_extract("cigar", r"^\D*(\d+)\D+(\d+)\D+(\d+)", 3).cast("long")
    begin = F.col("pos") + 1
    span = lambda s, e, part: F.struct(s.alias("start"), e.alias("end"), F.lit(part).alias("part"))
    whole = F.array(span(begin, begin + F.col("seq_len"), 1))
    halves = F.array(span(begin, begin + first, 1),
                     span(begin + first + gap, begin + first + gap + second, 2))
    pieces = F.when(junctions() == 0, whole).when(junctions() == 1, halves)
    out = df.drop("start", "end").withColumn("_piece", F.explode(pieces)).select("*", "_piece.*")
    out = out.drop("_piece")
    return out.withColumn("id", F.col(id_col)) if id_col else out


def per_million(mapped="mapped") -> Column:
    """Mapped reads in millions, rounded to four places."""
    return F.round(F.col(mapped) / 1e6, 4)
