"""Read coverage of bins and regions.

Reads carry file_key, chrom, start, end (half open), strand; ``files`` holds
one row per file with its mapped total, ``file_chroms`` one row per file and
chromosome with the chromosome's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import loci
from strandline.functions import reads as rd
from strandline.functions.signal import density
from strandline.operators import ordering
from strandline.operators.cumulative import _codes, _ranges, sums_at
from strandline.operators.overlaps import overlap_join

# fixed values: name fragments of chromosomes left out of bin counting
BIN_BLACKLIST = ["chrUn", "_random", "Zv9_", "_hap"]
HIGH, LOW = 95, 5
#: bits of a window of unique_reads: a task holds the reads of 2**UNIQUE_BITS bases
UNIQUE_BITS = 11


def drop_blacklisted(df: DataFrame, fragments: list[str] = BIN_BLACKLIST) -> DataFrame:
    """Drop chromosomes whose name contains any of the fragments."""
    return reduce(lambda out, part: out.where(~F.col("chrom").contains(part)), fragments, df)


def file_totals(reads: DataFrame, by: list[str] = ("file_key",)) -> DataFrame:
    """Mapped and total reads per file, over all chromosomes."""
    return reads.groupBy(*by).agg(
        F.sum(rd.is_mapped().cast("long")).alias("mapped"), F.count(F.lit(1)).alias("total"))


def file_index_stats(reads: DataFrame, chrom_sizes: DataFrame) -> DataFrame:
    """Mapped reads per file and chromosome, with the chromosome's length."""
    counts = reads.groupBy("file_key", "chrom").agg(
        F.sum(rd.is_mapped().cast("long")).alias("mapped"))
    return counts.join(chrom_sizes.select("chrom", "length"), "chrom")


def with_zeros(hits: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of ``hits`` per key of ``known``, 0 where there are none. Known keys join as zero rows of the same
    aggregate, so hits are summed before the one shuffle."""
    zeros = known.select(*keys, F.lit(0).cast("long").alias("count"), F.lit(True).alias("_known"))
    rows = hits.select(*keys, "count", F.lit(False).alias("_known")).unionByName(zeros)
    return rows.groupBy(*keys).agg(F.sum("count").alias("count"), F.max("_known").alias("_known")).where("_known").drop("_known")


def empty_bins(file_chroms: DataFrame, bin_size: int, blacklist: list[str] = BIN_BLACKLIST) -> DataFrame:
    """Every bin of every file: (file_key, cell_type, chrom, bin_number)."""
    last = F.ceil(F.col("length") / bin_size).cast("int") - 1
    return drop_blacklisted(file_chroms, blacklist).where("length > 0").select(
        "file_key", "cell_type", "chrom", F.explode(F.sequence(F.lit(0), last)).alias("bin_number"))


def bin_hits(reads: DataFrame, bin_size: int, *, extension: int = 0, strand: str = ".",
             blacklist: list[str] = BIN_BLACKLIST) -> DataFrame:
    """Bases each read adds to each bin its alignment touches; works on streams and on tables."""
    if bin_size < 1:
        raise ValueError("bin size must be at least 1")
    if strand != ".":
        reads = reads.where(F.col("strand") == strand)
    size = F.lit(bin_size)
    first = F.floor(F.col("start") / size).cast("int")
    last_base = "end" if extension else "end - 1"
    last = F.floor(F.expr(last_base) / size).cast("int")
    touched = drop_blacklisted(reads, blacklist).where("end > start").withColumns(
        rd.extended(extension)
    ).select("file_key", "cell_type", "chrom", "ext_start", "ext_end",
             F.explode(F.sequence(first, last)).alias("bin_number"))
    low = F.col("bin_number").cast("long") * size
    bases = F.least(F.col("ext_end"), low + size) - F.greatest(F.col("ext_start"), low)
    return touched.select("file_key", "cell_type", "chrom", "bin_number", F.greatest(bases, F.lit(0)).alias("count"))


def bin_counts(reads: DataFrame, file_chroms: DataFrame, bin_size: int, *, extension: int = 0,
               strand: str = ".", blacklist: list[str] = BIN_BLACKLIST) -> DataFrame:
    """Covered bases per (file_key, cell_type, chrom, bin_number), empty bins included.

    A read counts for the bins its alignment touches; extension only changes
    how many bases it adds there.
    """
    hits = bin_hits(reads, bin_size, extension=extension, strand=strand, blacklist=blacklist)
    return with_zeros(hits, empty_bins(file_chroms, bin_size, blacklist), ["file_key", "cell_type", "chrom", "bin_number"])


def normalised_bins(counts: DataFrame, files: DataFrame, bin_size: int) -> DataFrame:
    """Bin counts as reads per million per base in ``value``."""
    factor = (F.lit(1.0) / bin_size) * (F.lit(1.0) / (F.col("mapped") / 1e6))
    with_total = counts.join(files.select("file_key", "mapped"), "file_key")
    return with_total.withColumn("value", F.col("count") * factor).drop("mapped")


def bin_percentiles(counts: DataFrame, files: DataFrame, bin_size: int) -> DataFrame:
    """Normalised bins with their percentile among all bins of the file.

    Within a file the factor is one constant, so ranking the whole-number
    counts gives the ranks of the normalised values.
    """
    ranked = ordering.percentile(counts, ["cell_type", "file_key"], "count", "percentile")
    return normalised_bins(ranked, files, bin_size).select(
        "bin_number", "cell_type", "chrom", "file_key", "value", "percentile")


def cell_type_averages(normalised: DataFrame, files: DataFrame, bin_size: int) -> DataFrame:
    """Mean over the files of a cell type (file_key 0) with its own percentile.

    Ranks compare the means to 12 significant digits, so equal bins tie
    whatever order their files were added in.
    """
    n_files = files.groupBy("cell_type").agg(F.count_distinct("file_key").alias("_files"))
    sums = normalised.groupBy("cell_type", "chrom", "bin_number").agg(F.sum("value").alias("_sum"))
    means = sums.join(n_files, "cell_type").select(
        "bin_number", "cell_type", "chrom", F.lit(0).alias("file_key"),
        (F.col("_sum") / F.col("_files")).alias("value"))
    means = means.withColumn("_digits", F.format_string("%.11e", "value").cast("double"))
    ranked = ordering.percentile(means, ["cell_type"], "_digits", "percentile")
    return ranked.select("bin_number", "cell_type", "chrom", "file_key", "value", "percentile")


def bin_summary(normalised: DataFrame) -> DataFrame:
    """Counters per (chrom, bin) over file rows and cell-type rows (file_key 0)."""
    average, line = F.col("file_key") == 0, F.col("file_key") != 0
    at = lambda who, test: F.sum(F.when(who & test, 1).otherwise(0)).alias
    p = F.coalesce(F.col("percentile"), F.lit(-1.0))
    bins = normalised.groupBy("chrom", "bin_number").agg(
        F.sum(F.when(average, F.col("percentile"))).alias("_sum"),
        at(average, p >= HIGH)("cell_types_gte_95th_percentile"),
        at(average, p < HIGH)("cell_types_lt_95th_percentile"),
        at(line, p >= HIGH)("lines_gte_95th_percentile"),
        at(line, p < HIGH)("lines_lt_95th_percentile"),
        at(average, p >= LOW)("cell_types_gte_5th_percentile"),
        at(average, p < LOW)("cell_types_lt_5th_percentile"),
        at(line, p >= LOW)("lines_gte_5th_percentile"),
        at(line, p < LOW)("lines_lt_5th_percentile"))
    types = normalised.where(average).groupBy("chrom").agg(
        F.count_distinct("cell_type").alias("_types"))
    mean = (F.col("_sum") / F.col("_types")).alias("avg_cell_type_percentile")
    return bins.join(types, "chrom").select(
        "bin_number", "chrom", mean,
        *[c for c in bins.columns if c.endswith("percentile")])


def sorted_summary(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.desc("avg_cell_type_percentile"), "chrom", "bin_number")


def summary_violations(summary: DataFrame, files: DataFrame) -> DataFrame:
    """Summary rows whose counters do not add up to the files and cell types; none are expected."""
    totals = files.agg(F.count_distinct("cell_type").alias("n_types"),
                       F.count_distinct("file_key").alias("n_files"))
    n_types, n_files = totals.select("n_types").scalar(), totals.select("n_files").scalar()
    wrong = F.lit(False)
    for level in ("95th", "5th"):
        for who, n in (("cell_types", n_types), ("lines", n_files)):
            total = F.col(f"{who}_gte_{level}_percentile") + F.col(f"{who}_lt_{level}_percentile")
            wrong = wrong | (total != n)
    return summary.where(wrong)


def append_new_files(known: DataFrame, candidates: DataFrame, name: str = "file_name") -> DataFrame:
    """Files not counted yet."""
    return candidates.join(known.select(name), name, "left_anti")


def regions_by_file(regions: DataFrame, file_chroms: DataFrame) -> DataFrame:
    """Each region once per file that has its chromosome, if it ends within it."""
    sized = file_chroms.select("chrom", "file_key", "cell_type", "length")
    return regions.join(sized, "chrom").where(F.col("end") <= F.col("length")).drop("length")


def fetched(reads: DataFrame, regions: DataFrame, mode: str = ".", **kwargs) -> DataFrame:
    """Pairs of reads and the regions their alignment touches or ends right before.

    ``mode``: ``.`` every read, ``+`` reads on the region's strand, ``-`` on the opposite one.
    """
    if mode != ".":
        kwargs["by"] = ()
    # the alignment's exclusive end counts as touched, the region's end does not
    closed = regions.withColumns({"_stop": F.col("end"), "end": F.col("end") - 1}).where("end >= start")
    pairs = overlap_join(reads, closed, "both", **kwargs)
    pairs = pairs.withColumn("b_end", F.col("b__stop")).drop("b__stop")
    return pairs.where(rd.on_strand(mode, "b_strand"))


def _events(rows: DataFrame, by: list[str], weights: list[str], marks: list[tuple]) -> DataFrame:
    """(chrom, by, pos, weights): one row per row and mark, a mark being a position and its weights."""
    cells = [F.struct(F.expr(at).cast("long").alias("pos"), *[
        F.expr(own.get(w, "0")).cast("long").alias(w) for w in weights]) for at, own in marks]
    return rows.select("chrom", *by, F.explode(F.array(*cells)).alias("_e")).select("chrom", *by, "_e.*")


def piece_sums(reads: DataFrame, regions: DataFrame, by: list[str], *, extension: int = 0, mode: str = ".") -> DataFrame:
    """Covered bases between the positions ``_edges`` of each region, in order from its start, as arrays ``pieces``.

    A read counts if its alignment touches the region or ends right before it.
    Rows of one region and ``by`` have to be added up. No pairs are built: the
    bases below a position are a running sum. Of grown reads those are taken
    off that reach the region with their extension only.
    """
    by = [*by, *(["_read_strand"] if mode != "." or extension else [])]
    reads = reads.withColumn("_read_strand", F.col("strand")).where("end >= start")
    regions = regions.where("end > start")
    if not extension:
        events = _events(reads, by, ["n"], [("start", {"n": "1"}), ("end", {"n": "-1"})])
        found = sums_at(events, regions.withColumn("points", F.col("_edges")), by, ["n"], steps=True)
        found = found.withColumnRenamed("n", "pieces")
    else:
        forward = F.coalesce(F.col("strand") == "+", F.lit(False))
        # backwards a read grows down to 0 at most
        grown = reads.withColumn("_plus", forward).where("_plus OR end >= 0").withColumn(
            "start", F.when(forward, F.col("start")).otherwise(F.greatest(F.lit(0), "start")))
        grown = grown.withColumns(rd.extended(extension)).withColumns({
            "_tip": F.when(forward, F.col("ext_end")).otherwise(F.col("ext_start")),
            "_near": F.when(forward, F.col("end")).otherwise(F.col("start"))})
        events = _events(grown, by, ["n", "tip", "near", "near_tips"], [
            ("ext_start", {"n": "1"}), ("ext_end", {"n": "-1"}), ("_tip", {"tip": "1"}),
            ("_near", {"near": "1", "near_tips": "_tip"})])
        points = F.concat(F.array("start", "end"), "_edges")
        found = sums_at(events, regions.withColumn("points", points), by, ["n", "tip"], ["near", "near_tips"])
        # bases below an edge of reads that end before the region, or start after it, and reach it by their extension
        below = """transform(_edges, (y, i) -> CASE
            WHEN _read_strand <=> '+' THEN n[i + 2] + IF(y - {0} < start, near_tips[0] - y * near[0] + tip[i + 2], 0)
            ELSE n[i + 2] - IF(greatest(0, y) + {0} > end, near_tips[1] - greatest(0, y) * near[1] + tip[i + 2], 0) END)"""
        found = found.withColumn("_below", F.expr(below.format(extension))).withColumn(
            "pieces", F.expr("transform(slice(_below, 2, size(_below)), (b, i) -> b - _below[i])"))
    found = found.where(rd.on_strand(mode, "strand", "_read_strand")) if mode != "." else found
    return found.select(*regions.columns, *[c for c in by if c != "_read_strand"], "pieces")


def _region_sums(reads: DataFrame, regions: DataFrame, extension: int, mode: str) -> DataFrame:
    """Bases of each file in each region, to be added up."""
    region_cols = ["id", *loci.LOCUS_KEY]
    edges = regions.select(*region_cols, F.array("start", "end").alias("_edges"))
    reads = reads.select("file_key", "chrom", "start", "end", "strand")
    return piece_sums(reads, edges, ["file_key"], extension=extension, mode=mode).select(
        "file_key", *region_cols, F.col("pieces")[0].alias("count"))


def region_hits(reads: DataFrame, regions: DataFrame, *, extension: int = 0, mode: str = ".") -> DataFrame:
    """Bases the reads of each file add to each region they cover: (file_key, id, locus, count)."""
    return _region_sums(reads, regions, extension, mode).groupBy("file_key", "id", *loci.LOCUS_KEY).agg(
        F.sum("count").alias("count")).where("count > 0")


def region_counts(reads: DataFrame, regions: DataFrame, file_chroms: DataFrame, *,
                  extension: int = 0, mode: str = ".") -> DataFrame:
    """Covered bases per (file, region), zero rows included."""
    keys = ["file_key", "id", *loci.LOCUS_KEY]
    zeros = regions_by_file(regions.select(*keys[1:]), file_chroms).select(*keys)
    return with_zeros(_region_sums(reads, regions, extension, mode), zeros, keys)


def region_densities(counts: DataFrame, files: DataFrame) -> DataFrame:
    """Region counts with reads per million per base."""
    return counts.join(files.select("file_key", "mapped"), "file_key").withColumn(
        "density", density("count", "start", "end", "mapped")).drop("mapped")


def region_matrix(densities: DataFrame, file_names: dict[int, str]) -> DataFrame:
    """One row per region: GENE_ID, locusLine and a density column (4 places) per file."""
    cells = [F.max(F.when(F.col("file_key") == k, F.round("density", 4))).alias("bin_1_" + name)
             for k, name in file_names.items()]
    return densities.groupBy(F.col("id").alias("GENE_ID"), loci.text().alias("locusLine")).agg(*cells)


def _piece_sums(reads: DataFrame, regions: DataFrame, pieces, extension: int, mode: str, by: list[str]) -> DataFrame:
    """Arrays ``pieces`` of covered bases per region and ``by``, to be added up."""
    n = F.lit(pieces) if isinstance(pieces, int) else pieces
    region_cols = ["id", *loci.LOCUS_KEY, "n_pieces"]
    sized = regions.withColumn("n_pieces", n.cast("int")).select(*region_cols).where("n_pieces > 0")
    sized = sized.withColumn("_width", F.floor((F.col("end") - F.col("start")) / F.col("n_pieces"))).where("_width > 0")
    edges = sized.withColumn("_edges", F.expr("transform(sequence(0, n_pieces), i -> start + i * _width)")).drop("_width")
    return piece_sums(reads.select(*by, "chrom", "start", "end", "strand"), edges, by, extension=extension,
                      mode=mode).select(*by, *region_cols, "pieces")


def _added_up(arrays: str) -> str:
    """Sum of the arrays of one value per piece."""
    return (f"aggregate({arrays}, array_repeat(0L, n_pieces), (total, own) -> zip_with(total, own, (x, y) -> x + y))")


def piece_counts(reads: DataFrame, regions: DataFrame, pieces, *, extension: int = 0,
                 mode: str = ".", by: list[str] = ()) -> DataFrame:
    """Covered bases per region piece, only pieces with reads.

    ``pieces`` is a number or a column of ``regions``; a piece is
    floor((end-start)/n) wide and the rest of the region is dropped.
    """
    keys = [*by, "id", *loci.LOCUS_KEY, "n_pieces"]
    sums = _piece_sums(reads, regions, pieces, extension, mode, list(by)).groupBy(*keys).agg(
        F.collect_list("pieces").alias("_parts"))
    each = sums.select(*keys, F.posexplode(F.expr(_added_up("_parts"))).alias("piece", "count"))
    return each.where("count > 0").withColumn("piece", F.col("piece").cast("long"))


def piece_densities(reads: DataFrame, regions: DataFrame, files: DataFrame, file_chroms: DataFrame, *,
                    n_bins: int | None = None, bin_size: int | None = None, extension: int = 0,
                    mode: str = ".") -> DataFrame:
    """Density per region bin and file, bins counted from the 5' end of the region.

    ``n_bins`` cuts every region into that many bins (NULL when it is shorter),
    ``bin_size`` into bins of that size. Rounded to four places. The bins of a
    region travel in one array and become rows at the end.
    """
    if (n_bins is None) == (bin_size is None):
        raise ValueError("give either n_bins or bin_size")
    inclusive = loci.length()
    if n_bins is not None:
        pieces, width = F.lit(n_bins), F.floor(inclusive / n_bins)
    else:
        pieces, width = F.floor(inclusive / bin_size), F.lit(bin_size)
    region_cols = ["id", *loci.LOCUS_KEY]
    keys = ["file_key", *region_cols, "n_pieces"]
    counted = _piece_sums(reads, regions, pieces, extension, mode, ["file_key"])
    known = regions_by_file(regions.select(*region_cols), file_chroms).withColumn("n_pieces", pieces.cast("int")).where(
        "n_pieces > 0").select(*keys, F.lit(None).cast("array<bigint>").alias("pieces"), F.lit(True).alias("_known"))
    sums = counted.select(*keys, "pieces", F.lit(False).alias("_known")).unionByName(known).groupBy(*keys).agg(
        F.collect_list("pieces").alias("_parts"), F.max("_known").alias("_known")).where("_known")
    mapped = files.select("file_key", rd.per_million().alias("_mmr"))
    each = sums.join(mapped, "file_key").select(
        *keys, "_mmr", F.posexplode(F.expr(_added_up("_parts"))).alias("piece", "count"))
    value = F.round(F.col("count") / F.nullif(width, F.lit(0)) / F.col("_mmr"), 4)
    position = F.when(F.col("strand") == "-", F.col("n_pieces") - F.col("piece")).otherwise(F.col("piece") + 1)
    return each.select("file_key", *region_cols, position.cast("int").alias("bin"), value.alias("density"))


def density_arrays(densities: DataFrame, name: str = "densities") -> DataFrame:
    """One array per region and file, in bin order. The arrays hold one value per bin."""
    cells = F.array_sort(F.collect_list(F.struct("bin", "density")))
    return densities.groupBy("file_key", "id", *loci.LOCUS_KEY).agg(
        F.transform(cells, lambda c: c["density"]).alias(name))


def region_read_counts(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """Reads without junctions per region: total, on its strand and on the other one.

    Those that start before the region's end less those that end before its start.
    """
    key = ["id", *loci.LOCUS_KEY]
    plain = rd.without_junctions(reads).select("chrom", "start", "end", F.col("strand").alias("_read_strand")).where("end >= start")
    events = _events(plain, ["_read_strand"], ["starts", "ends"], [("start", {"starts": "1"}), ("end", {"ends": "1"})])
    asked = regions.select(*key, F.array("start", "end").alias("points")).where("end > start")
    found = sums_at(events, asked, ["_read_strand"], [], ["starts", "ends"])
    n, own = F.col("starts")[1] - F.col("ends")[0], F.col("strand")
    sense = (own == ".") & (F.col("_read_strand") == "+") | (own == F.col("_read_strand"))
    hits = found.select(*key, n.alias("_n"), F.when(sense, n).otherwise(0).alias("_sense"))
    zeros = regions.select(*key, F.lit(0).cast("long").alias("_n"), F.lit(0).cast("long").alias("_sense"))
    return hits.unionByName(zeros).groupBy(*key).agg(
        F.sum("_n").alias("total"), F.sum("_sense").alias("sense"),
        (F.sum("_n") - F.sum("_sense")).alias("antisense"))


def region_starts(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """Start positions (1-based) per region and strand with how often they occur.

    Reads with one start become one row before they meet the regions, so a
    pair is a row of the result. Of starts before a region only the reads that
    reach it count; ``_ends`` holds how many reads of a start end where.
    """
    plain = rd.without_junctions(reads).select("chrom", "start", "end", "strand").where("end >= start")
    ends = plain.groupBy("chrom", "start", "strand", "end").agg(F.count(F.lit(1)).alias("n"))
    starts = ends.groupBy("chrom", "start", "strand").agg(
        F.max("end").alias("end"), F.sum("n").alias("_n"), F.collect_list(F.struct("end", "n")).alias("_ends"))
    pairs = fetched(starts, regions.select("id", *loci.LOCUS_KEY))
    reaching = F.expr("CASE WHEN start >= b_start THEN _n ELSE "
                      "aggregate(_ends, 0L, (total, e) -> total + IF(e.end >= b_start, e.n, 0L)) END")
    rows = pairs.select(F.col("b_id").alias("id"), "strand", (F.col("start") + 1).alias("read_start"), reaching.alias("n"))
    # rows of an id stay together for what gathers them; summing before the shuffle would find nothing to sum
    return rows.repartition("id").groupBy("id", "strand", "read_start").agg(F.sum("n").alias("n"))


def starts_text(starts: DataFrame) -> DataFrame:
    """``+:a,b;-:c`` per region, for regions whose starts fit one cell of a text table."""
    # a start is written once and repeated; sorting structs sorts numbers
    there = lambda s: F.when((F.col("strand") == s) & (F.col("n") > 0), F.struct("read_start", F.col("n").cast("int").alias("n")))
    again = lambda x: F.call_function("repeat", F.concat(x["read_start"].cast("string"), F.lit(",")), x["n"] - 1)
    text = lambda s: F.array_join(F.transform(F.array_sort(F.collect_list(there(s))), lambda x: F.concat(
        again(x), x["read_start"].cast("string"))), ",")
    return starts.groupBy("id").agg(F.concat(F.lit("+:"), text("+"), F.lit(";-:"), text("-")).alias("starts"))


def _first_in_region(cols: list[str]):
    """Of rows sorted by place, kind (reads before regions), seq and the order of reads: the first read of each seq in a
    region. A task holds the reads of one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, reads = None, [], None
        for batch in batches:
            window, kind, chrom = batch["_window"].to_numpy(), batch["_kind"].to_numpy(), _codes(batch["chrom"])
            turn = (chrom[1:] != chrom[:-1]) | (window[1:] != window[:-1]) | (kind[1:] != kind[:-1])
            for low, high in _ranges(np.concatenate(([0], np.cumsum(turn)))):
                rows = batch.slice(low, high - low)
                at = (rows["chrom"][0].as_py(), int(window[low]))
                if at != place:
                    place, held, reads = at, [], None
                if not kind[low]:
                    held.append(rows.select(cols))
                elif held:
                    reads = reads or (table := pa.Table.from_batches(held), table["start"].to_numpy(), table["end"].to_numpy(), _codes(table["seq"]))
                    yield from found(rows, *reads)

    def found(rows: pa.RecordBatch, table: pa.Table, start: np.ndarray, end: np.ndarray, seq: np.ndarray) -> Iterator[pa.RecordBatch]:
        first, last = rows["b_start"].to_numpy(), rows["b_last"].to_numpy()
        which, size = [], 0
        for k in range(rows.num_rows):
            own = np.flatnonzero((start <= last[k]) & (end >= first[k]))
            which.append(own[np.diff(seq[own], prepend=-1) != 0])
            size += len(which[-1])
            if size > 100_000 or k + 1 == rows.num_rows:
                regions = pa.array(np.repeat(np.arange(k + 1 - len(which), k + 1), [len(x) for x in which]))
                picked = table.take(pa.array(np.concatenate(which))).combine_chunks()
                yield pa.RecordBatch.from_arrays([rows["b_id"].take(regions), rows["b_strand"].take(regions), *[
                    picked[c].combine_chunks() for c in cols]], names=["b_id", "b_strand", *cols])
                which, size = [], 0

    return run


def unique_reads(reads: DataFrame, regions: DataFrame, mode: str = ".", order: list = ("start",)) -> DataFrame:
    """First read of every sequence in a region; the strand test comes afterwards.

    Regions shorter than a window (``2**UNIQUE_BITS``) lie in the window of their start, where all reads that they may
    touch are sent, so no pair of a read and a region is shuffled. Longer ones, and ids of several places, are joined.
    """
    cols = list(dict.fromkeys(["chrom", "start", "end", "strand", "seq", *order]))
    plain, places = rd.without_junctions(reads).select(*cols), regions.select("id", *loci.LOCUS_KEY)
    alone = F.count(F.lit(1)).over(Window.partitionBy("id")) == 1
    places = places.withColumn("_near", F.coalesce(alone & (F.col("end") - F.col("start") <= 1 << UNIQUE_BITS), F.lit(False)))
    near, others = places.where("_near AND end > start").drop("_near"), places.where("NOT _near").drop("_near")

    window = lambda c: F.shiftright(c.cast("long"), UNIQUE_BITS)
    reach = near.agg(F.max(F.col("end") - F.col("start"))).scalar()
    dealt = plain.withColumn("_reach", reach).withColumn("_window", F.explode(F.sequence(
        window(F.col("start") - F.col("_reach")), window(F.greatest("start", "end"))))).drop("_reach")
    asked = near.select(
        "chrom", window(F.col("start")).alias("_window"), F.col("id").alias("b_id"), F.col("strand").alias("b_strand"),
        F.col("start").cast("long").alias("b_start"), (F.col("end") - 1).cast("long").alias("b_last"))
    rows = dealt.withColumn("_kind", F.lit(0)).unionByName(asked.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    rows = rows.where("chrom IS NOT NULL").repartition("chrom", "_window").sortWithinPartitions("chrom", "_window", "_kind", "seq", *order)
    out = T.StructType([rows.schema[c] for c in ("b_id", "b_strand", *cols)])
    first = rows.mapInArrow(_first_in_region(cols), out)

    any_other = others.agg(F.count(F.lit(1)) > 0).scalar()
    pairs = fetched(plain.where(any_other), others)
    joined = ordering.keep_first(pairs, ["b_id", "seq"], [F.col(c) for c in order])
    kept = first.unionByName(joined.select(*first.columns)).where(rd.on_strand(mode, "b_strand"))
    return kept.select(F.col("b_id").alias("id"), *cols)


def depth_segments(locus_reads: DataFrame, by: list[str] = ("chrom",), extension: int = 0) -> DataFrame:
    """Runs of equal depth (start..end inclusive) with depth on + and on -.

    Closed read loci become +1 and -1 events, equal events are added up before
    the shuffle, and depth is their running sum. No row per base exists.
    """
    minus = F.col("strand") == "-"
    grown = locus_reads.select(
        *by, "strand",
        F.when(minus, F.col("start") - extension).otherwise(F.col("start")).alias("start"),
        F.when(minus, F.col("end")).otherwise(F.col("end") + extension).alias("end"))
    event = lambda at, n: F.struct(at.alias("pos"), F.lit(n).alias("delta"))
    events = grown.select(*by, "strand", F.explode(
        F.array(event(F.col("start"), 1), event(F.col("end") + 1, -1))).alias("_e"))
    per_strand = lambda s: F.sum(F.when(F.col("strand") == s, F.col("_e.delta")).otherwise(0))
    changes = events.groupBy(*by, F.col("_e.pos").alias("start")).agg(
        F.sum(F.when(minus, 0).otherwise(F.col("_e.delta"))).alias("_plus"),
        per_strand("-").alias("_minus")).where("_plus != 0 or _minus != 0")
    depth = ordering.scan(changes, list(by), "start", {
        "plus": ("sum", F.col("_plus")), "minus": ("sum", F.col("_minus"))}, following="_next")
    return depth.where("plus + minus > 0").select(
        *by, "start", (F.col("_next.start") - 1).alias("end"), "plus", "minus")


def _depth_events(segments: DataFrame, floor: int) -> DataFrame:
    deep = segments.where(F.col("plus") + F.col("minus") > floor).select("chrom", "start", "end", "plus", "minus")
    return _events(deep, [], ["plus", "minus"], [
        ("start", {"plus": "plus", "minus": "minus"}), ("end + 1", {"plus": "-plus", "minus": "-minus"})])


def region_depths(regions: DataFrame, segments: DataFrame, *, floor: int = 0, mmr: float = 1.0) -> DataFrame:
    """Mean per-base depth on the region's strand and the other one.

    Only bases strictly inside the region and deeper than ``floor`` count.
    """
    key = ["id", *loci.LOCUS_KEY]
    asked = regions.select(*key, F.expr("array(start + 1, end)").alias("points")).where("end > start + 1")
    found = sums_at(_depth_events(segments, floor), asked, [], ["plus", "minus"], steps=True)
    plus, minus, back = F.col("plus")[0], F.col("minus")[0], F.col("strand") == "-"
    hits = found.select(*key, F.when(back, minus).otherwise(plus).alias("_sense"),
                        F.when(back, plus).otherwise(minus).alias("_anti"))
    zeros = regions.select(*key, F.lit(0).cast("long").alias("_sense"), F.lit(0).cast("long").alias("_anti"))
    value = lambda c: F.round(F.sum(c) / loci.length() / mmr, 4)
    return hits.unionByName(zeros).groupBy(*key).agg(
        value("_sense").alias("sense_density"), value("_anti").alias("antisense_density"))


def depth_bins(regions: DataFrame, segments: DataFrame, n_bins: int, *, floor: int = 0, mmr: float = 1.0) -> DataFrame:
    """Mean depth of both strands per region bin from the 5' end.

    A bin is floor((length-1)/n) wide; its first and last base are not counted.
    """
    key = ["id", *loci.LOCUS_KEY]
    width = F.floor((loci.length() - 1) / n_bins)
    # bin 0 lies at the region's start, or at its end on the minus strand
    low = "IF(strand <=> '-', end - (i + 1) * _w, start + i * _w)"
    points = f"flatten(transform(sequence(0, {n_bins - 1}), i -> array({low} + 1, greatest({low} + 1, {low} + _w))))"
    asked = regions.select(*key).withColumn("_w", width).where("_w > 0").withColumn("points", F.expr(points)).drop("_w")
    found = sums_at(_depth_events(segments, floor), asked, [], ["plus", "minus"], steps=True)
    hits = found.select(*key, F.posexplode(F.expr(
        f"transform(sequence(0, {n_bins - 1}), i -> plus[2 * i] + minus[2 * i])")).alias("bin", "_sum"))
    zeros = regions.select(*key, F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"),
                           F.lit(0).cast("long").alias("_sum"))
    value = F.round(F.sum("_sum") / F.nullif(width, F.lit(0)) / mmr, 4)
    return hits.unionByName(zeros).groupBy(*key, "bin").agg(value.alias("density")).withColumn(
        "bin", F.col("bin") + 1)


#: a score is taken apart into whole numbers of 2**-18, 2**-36 and 2**-54; these add up without any error
SCORE_PARTS, SCORE_BITS = ("_a", "_b", "_c"), 18


def mean_conservation(regions: DataFrame, scores: DataFrame) -> DataFrame:
    """Length-weighted score sum over a region's score lines, by its inclusive length.

    A line inside the region counts for its length less one base, one that
    comes in from the left for all of its bases there. Scores are added up as
    whole numbers, so the difference of two running sums loses nothing.
    """
    key = ["id", *loci.LOCUS_KEY]
    unit = float(1 << SCORE_BITS)
    lines = scores.select("chrom", "start", "end", (F.col("score") * unit).alias("_s")).where("end >= start AND _s IS NOT NULL")
    for part in SCORE_PARTS:
        lines = lines.withColumn(part, F.floor("_s")).withColumn("_s", (F.col("_s") - F.floor("_s")) * unit)
    own, less = {p: p for p in SCORE_PARTS}, {p: f"-{p}" for p in SCORE_PARTS}
    events = _events(lines, [], list(SCORE_PARTS), [("start", own), ("end", less)])
    events = events.withColumns({f"_n{p}": F.col(p) for p in SCORE_PARTS})
    asked = regions.select(*key, F.expr("array(start, end + 1)").alias("points")).where("end >= start")
    found = sums_at(events, asked, [], list(SCORE_PARTS), [f"_n{p}" for p in SCORE_PARTS])
    hits = found.select(*key, *[
        F.expr(f"{p}[1] - _n{p}[1] - {p}[0] + _n{p}[0]").alias(p) for p in SCORE_PARTS])
    zeros = regions.select(*key, *[F.lit(0).cast("long").alias(p) for p in SCORE_PARTS])
    total = reduce(lambda sum_, part: sum_ / unit + F.sum(part), reversed(SCORE_PARTS[:-1]), F.sum(SCORE_PARTS[-1]).cast("double"))
    return hits.unionByName(zeros).groupBy(*key).agg((total / unit / loci.length()).alias("conservation"))


def drop_duplicate_reads(reads: DataFrame, by: list[str] = ("file_key",)) -> DataFrame:
    """Without mitochondrial reads, one read per file, position and strand."""
    return reads.where(F.col("chrom") != "chrM").select(*by, "chrom", "pos", "strand").distinct()


def merge_samples(reads: DataFrame, new_key: int, keys: list[int]) -> DataFrame:
    """Reads of several files under one new file key."""
    return reads.where(F.col("file_key").isin(keys)).withColumn("file_key", F.lit(new_key))


def meta_profile(parts_sense: list[DataFrame], parts_anti: list[DataFrame]) -> DataFrame:
    """Bin arrays of the gene's parts joined end to end, both strands added.

    Every part holds (file_key, id, densities); a gene lacking a bin anywhere
    gets NULL for the whole row.
    """
    def joined(parts, name):
        out = None
        for i, part in enumerate(parts):
            side = part.select("file_key", "id", F.col("densities").alias(f"_{i}"))
            out = side if out is None else out.join(side, ["file_key", "id"])
        return out.select("file_key", "id", F.concat(*[f"_{i}" for i in range(len(parts))]).alias(name))

    both = joined(parts_sense, "_sense").join(joined(parts_anti, "_anti"), ["file_key", "id"])
    total = F.zip_with("_sense", "_anti", lambda a, b: a + b)
    gap = F.exists(total, lambda v: v.isNull())
    return both.select("file_key", "id", F.when(~gap, total).alias("profile"))
