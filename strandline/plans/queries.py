"""One query per operator over the derived tables, registered by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import loci
from strandline.functions import reads as rd
from strandline.functions.sequence import reverse_complement
from strandline.functions.signal import diagonal_skew, magnitude, subtract_background
from strandline.operators import (collections, comparison, coverage, expression, genes, matrices, ordering,
                                  overlaps, ranking, screen, sequences, stitching, tracks)
from strandline.operators import regions as region_sets
from strandline.plans import jobs
from strandline.session import checkpoint_dir, checkpointed
from strandline.sources import readstore
from strandline.sources.views import SAMPLES, Views
from strandline.streaming import append

BIN_SIZE = 5000
STITCH = 50
FILES = {1: "file1", 2: "file2", 3: "file3"}
GROUPS = {"A": ["A_F", "A_O"], "N": ["N_F", "N_O"], "R": ["R_F", "R_O"]}
GENE_WINDOW, GENE_REACH = 10_000, 1_000_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Views(spark, folder))

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


# --- bin counting -------------------------------------------------------------------------------

def _counts(v: Views) -> DataFrame:
    return coverage.bin_counts(v.reads(), v.file_chroms(), BIN_SIZE)


def _bins(v: Views) -> dict[str, DataFrame]:
    return jobs.bin_counting(v.reads(), v.files(), v.file_chroms(), BIN_SIZE)


@query
def bin_counts(v):
    return _counts(v)


@query
def bin_counts_extended(v):
    """Reads grown by 200 bases at their 3' end; the alignment decides which bins it counts for."""
    return coverage.bin_counts(v.reads(), v.file_chroms(), BIN_SIZE, extension=200)


@query
def bin_normalized(v):
    return rounded(coverage.normalised_bins(_counts(v), v.files(), BIN_SIZE), "value")


@query
def bin_percentile(v):
    return rounded(coverage.bin_percentiles(_counts(v), v.files(), BIN_SIZE), "value", "percentile")


@query
def bin_celltype_avg(v):
    lines = coverage.bin_percentiles(_counts(v), v.files(), BIN_SIZE)
    return rounded(coverage.cell_type_averages(lines, v.files(), BIN_SIZE), "value", "percentile")


@query
def bin_summary(v):
    return rounded(_bins(v)["summary"], "avg_cell_type_percentile")


@query
def sorted_summary(v):
    return rounded(_bins(v)["sorted_summary"], "avg_cell_type_percentile")


@query
def summary_validate(v):
    summary = _bins(v)["summary"]
    wrong = coverage.summary_violations(summary, v.files()).agg(F.count(F.lit(1))).scalar()
    return summary.agg(F.count(F.lit(1)).alias("n_bins"), F.max(wrong).alias("violations"))


def _by_name(df: DataFrame) -> DataFrame:
    return df.withColumn("file_name", F.col("file_key").cast("string"))


def _appended(v: Views, **settings) -> str:
    """A store that got files 1 and 2, then all three, then file 2 again."""
    store = f"{checkpoint_dir(v.spark)}/strandline-store-{uuid.uuid4().hex}"
    append.create_store(v.spark, store, **settings)
    reads = _by_name(v.reads())
    append.append(reads.where("file_key <= 2"), store, "first")
    append.append(reads, store, "all")
    append.append(reads.where("file_key = 2"), store, "again")
    return store


@query
def append_counts(v):
    """Counting file 3 after files 1 and 2, unknown files only, gives the table of one run."""
    store = _appended(v, bin_size=BIN_SIZE)
    return append.stored_counts(v.spark, store, _by_name(v.file_chroms()))


@query
def append_counts_extended(v):
    """The same with reads grown by 200 bases."""
    store = _appended(v, bin_size=BIN_SIZE, extension=200)
    return append.stored_counts(v.spark, store, _by_name(v.file_chroms()))


@query
def append_summary(v):
    """Summary rebuilt from the stored counts."""
    tables = append.derived_tables(v.spark, _appended(v, bin_size=BIN_SIZE), _by_name(v.file_chroms()), _by_name(v.files()))
    return rounded(tables["summary"], "avg_cell_type_percentile")


@query
def append_region_counts(v):
    """The region form, reads of the region's strand grown by 200 bases."""
    store = _appended(v, regions=v.regions(), extension=200, strand="+")
    return append.stored_counts(v.spark, store, _by_name(v.file_chroms()))


# --- region counting ----------------------------------------------------------------------------

def _region_counts(v: Views, mode: str = ".") -> DataFrame:
    return coverage.region_counts(v.reads(), v.regions(), v.file_chroms(), mode=mode)


@query
def region_counts(v):
    return _region_counts(v)


@query
def region_counts_sense(v):
    return _region_counts(v, "+")


@query
def region_counts_antisense(v):
    return _region_counts(v, "-")


STORE_BITS = 16  # the chromosomes of the views have 260,000 bases


def _read_store(v: Views) -> str:
    path = f"{checkpoint_dir(v.spark)}/strandline-reads-{uuid.uuid4().hex}"
    readstore.store_reads(v.reads().select("file_key", "chrom", "start", "end", "strand"), path, tile_bits=STORE_BITS)
    return path


@query
def store_region(v):
    """Reads of one region from a store of all reads."""
    region = readstore.region_reads(v.spark, _read_store(v), "chr3", 100_000, 101_000, tile_bits=STORE_BITS)
    return region.groupBy("file_key", "chrom", "start", "end", "strand").agg(F.count(F.lit(1)).alias("n"))


@query
def store_counts(v):
    """Region counts of the peaks, from the tiles of a store that they need."""
    near = readstore.nearby_reads(v.spark, _read_store(v), v.peaks(), tile_bits=STORE_BITS)
    return coverage.region_counts(near, v.peaks(), v.file_chroms())


@query
def region_density(v):
    return rounded(coverage.region_densities(_region_counts(v), v.files()), "density")


@query
def region_matrix(v):
    return coverage.region_matrix(coverage.region_densities(_region_counts(v), v.files()), FILES)


@query
def region_pieces(v):
    return coverage.piece_counts(v.reads(), v.regions(), 4).select("id", "piece", "count")


@query
def region_read_counts(v):
    return coverage.region_read_counts(v.reads(), v.regions()).select("id", "total", "sense", "antisense")


@query
def region_starts(v):
    return coverage.region_starts(v.reads(), v.regions())


@query
def region_starts_text(v):
    """The starts of every region in one cell of text, as often as they occur."""
    return coverage.starts_text(coverage.region_starts(v.reads(), v.regions()))


@query
def unique_reads(v):
    return coverage.unique_reads(v.reads(), v.regions(), "+", ["start", "end", "strand"])


def _segments(v: Views, by: list[str]) -> DataFrame:
    plain = rd.without_junctions(v.reads())
    return coverage.depth_segments(rd.read_loci(plain), by)


@query
def depth_segments(v):
    return _segments(v, ["file_key", "chrom"])


@query
def region_depth(v):
    return coverage.region_depths(v.regions(), _segments(v, ["chrom"]), floor=1).select(
        "id", "sense_density", "antisense_density")


@query
def depth_bins(v):
    return coverage.depth_bins(v.regions(), _segments(v, ["chrom"]), 4, floor=1).select("id", "bin", "density")


@query
def clustergram(v):
    """Fixed-size bins per region, reversed on the minus strand."""
    return coverage.piece_densities(v.reads(), v.regions(), v.files(), v.file_chroms(), bin_size=50).select(
        "file_key", "id", "bin", "density")


@query
def matrix_bins(v):
    """Ten bins per region, reads of the region's strand."""
    return coverage.piece_densities(v.reads(), v.regions(), v.files(), v.file_chroms(), n_bins=10, mode="+").select(
        "file_key", "id", "bin", "density")


@query
def meta_profile(v):
    starts = genes.start_table(v.annotation())
    profile = jobs.meta_gene(v.reads(), starts, v.files(), v.file_chroms(), {"tss": 10, "txn": 5, "ttr": 10})
    rows = profile.where("profile is not null").select("file_key", "id", F.posexplode("profile").alias("bin", "value"))
    return rounded(rows, "value")


@query
def conservation_mean(v):
    return rounded(coverage.mean_conservation(v.regions(), v.score_lines()).select("id", "conservation"),
                   "conservation", places=9)


# --- interval joins -----------------------------------------------------------------------------

def _pair_ids(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").alias("a_id"), F.col("b_id"))


@query
def overlap_join(v):
    return _pair_ids(overlaps.overlap_join(v.peaks("F"), v.peaks("O"), "sense"))


@query
def overlap_both(v):
    return _pair_ids(overlaps.overlap_join(v.peaks("F"), v.peaks("O"), "both"))


@query
def overlap_antisense(v):
    return _pair_ids(overlaps.overlap_join(v.peaks("F"), v.peaks("O"), "antisense"))


@query
def contained_join(v):
    return _pair_ids(overlaps.overlap_join(v.peaks(), genes.transcripts(v.annotation()), "both", "contained"))


@query
def containers_join(v):
    return _pair_ids(overlaps.overlap_join(genes.transcripts(v.annotation()), v.peaks(), "sense", "contains"))


@query
def overlap_semi(v):
    return overlaps.overlapping(v.peaks("F"), v.peaks("O"), "sense").select("id")


@query
def mask_anti(v):
    return overlaps.not_overlapping(v.peaks("F"), v.peaks("P")).select("id")


@query
def has_locus(v):
    """Regions whose place is also the place of a region of another status, or of any region moved by 100 bases."""
    places = v.regions().select("chrom", "start", "end", "strand", "status")
    other = places.where("status != 'F'").select(*loci.LOCUS_KEY)
    moved = places.select("chrom", (F.col("start") + 100).alias("start"), (F.col("end") + 100).alias("end"), "strand")
    return overlaps.has_locus(v.regions(), other.unionByName(moved)).select("id")


@query
def tss_filter(v):
    zone = genes.tss_loci(genes.start_table(v.annotation()), 1000, 1000)
    return overlaps.overlap_filter(v.peaks(), zone, relation="contained", keep=False).select("id")


def _consensus(v: Views) -> DataFrame:
    both = v.peaks("F").unionByName(v.peaks("O")).drop("signal")
    return stitching.consensus_regions(both, "x")


@query
def consensus_regions(v):
    return _consensus(v).select("id", "chrom", "start", "end", "strand", "num_loci")


def _occupancy(v: Views) -> DataFrame:
    consensus = _consensus(v).select("id", "chrom", "start", "end")
    peaks = v.regions().select("chrom", "start", "end", F.col("status").alias("sample"))
    return overlaps.occupancy_matrix(consensus, peaks, ["F", "O", "P"])


@query
def occupancy_matrix(v):
    return _occupancy(v)


@query
def gene_set_logic(v):
    return _occupancy(v).where(overlaps.any_of_all([["F", "O"], ["P"]])).select("id", "F", "O", "P")


# --- stitching ----------------------------------------------------------------------------------

def _stitched(v: Views) -> DataFrame:
    return stitching.stitch(v.peaks(), STITCH)


@query
def stitch(v):
    return _stitched(v)


@query
def stitch_sense(v):
    return stitching.stitch(v.peaks().where(F.col("strand") != "."), STITCH, mode="sense")


@query
def stitch_sweep(v):
    return stitching.stitch_sweep(v.peaks())


@query
def stitch_fraction_drop(v):
    sweep = stitching.fraction_drop(stitching.stitch_sweep(v.peaks()))
    return rounded(sweep.select("step", "ratio", "drop"), "ratio", "drop")


@query
def stitch_best_step(v):
    return stitching.best_step(stitching.stitch_sweep(v.peaks()))


@query
def constituent_size(v):
    return stitching.constituent_size(_stitched(v), v.peaks()).select("id", "num_loci", "constituent_size")


@query
def multi_tss_unstitch(v):
    starts = genes.start_table(v.annotation())
    return stitching.unstitch_multi_tss(stitching.stitch(v.peaks(), 500), v.peaks(), starts)


@query
def merged_provenance(v):
    a = v.peaks("F").withColumn("id", F.concat(F.lit("A_"), "id"))
    b = v.peaks("O").withColumn("id", F.concat(F.lit("B_"), "id"))
    return stitching.merged_with_sources(a, b).select("id", "chrom", "start", "end", "in_a", "in_b")


# --- signal, ranks ------------------------------------------------------------------------------

def _region_map(v: Views) -> DataFrame:
    stitched = checkpointed(stitching.constituent_size(checkpointed(_stitched(v)), v.peaks()))
    densities = coverage.region_densities(
        coverage.region_counts(v.reads(), stitched, v.file_chroms()), v.files())
    return matrices.region_map(stitched, densities, FILES, apart=True)


def _ranked_map(v: Views) -> DataFrame:
    return checkpointed(_region_map(v).withColumn("signal", subtract_background("file1", "file3")))


@query
def region_map(v):
    return rounded(_region_map(v), "file1", "file2", "file3", places=4)


@query
def replicate_collapse(v):
    out = matrices.collapse_replicates(_region_map(v), [("file1", "file3"), ("file2", "file3")])
    return rounded(out.select("id", "signal"), "signal")


@query
def signal_table_median(v):
    out = matrices.median_normalised(checkpointed(_region_map(v)), {"s1": ("file1", "file3"), "s2": ("file2", None)})
    return rounded(out.select("id", "s2"), "s2")


@query
def super_cutoff(v):
    return rounded(ranking.tangent_cutoff(_ranked_map(v), "signal"), "cutoff", places=4)


@query
def super_table(v):
    return rounded(ranking.super_table(_ranked_map(v)), "signal", places=4).select(
        "id", "signal", "enhancer_rank", "is_super")


@query
def stretch_table(v):
    return ranking.stretch_table(_ranked_map(v)).select("id", "constituent_size", "enhancer_rank", "is_stretch")


@query
def super_stretch(v):
    out = ranking.super_stretch_table(_ranked_map(v))
    return rounded(out.select("id", "magnitude", "enhancer_rank", "is_super_stretch"), "magnitude")


@query
def axis_magnitude(v):
    """Length and skew of the two-axis vector of each region."""
    df = v.peaks().select("id", (loci.length() / 1000.0).alias("x"), (F.col("signal") / 100000.0).alias("y"))
    return rounded(df.select("id", magnitude("x", "y").alias("magnitude"), diagonal_skew("x", "y").alias("skew")),
                   "magnitude", "skew")


# --- genes --------------------------------------------------------------------------------------

def _gene_tables(v: Views) -> dict[str, DataFrame]:
    return jobs.map_genes(checkpointed(ranking.super_table(_ranked_map(v))), v.annotation(), window=GENE_WINDOW)


@query
def gene_assign(v):
    return _gene_tables(v)["region_genes"].select("id", "overlap_genes", "proximal_genes", "closest_gene")


@query
def nearest_gene(v):
    starts, regions = genes.start_table(v.annotation()), v.peaks()
    pairs = genes.gene_pairs(regions, starts, genes.transcripts(v.annotation()), GENE_WINDOW, closest=GENE_REACH)
    return genes.nearest_gene(regions, starts, pairs, GENE_REACH)


@query
def gene_pairs(v):
    return genes.gene_pairs(v.peaks(), genes.start_table(v.annotation()),
                            genes.transcripts(v.annotation()), GENE_WINDOW).select("id", "gene_id", "class")


@query
def gene_rollup(v):
    return _gene_tables(v)["gene_regions"]


@query
def top_gene(v):
    ranked = checkpointed(ranking.super_table(_ranked_map(v)))
    tables = jobs.map_genes_by_signal(ranked, v.annotation(), v.reads(), v.files(), v.file_chroms(), 1,
                                      window=GENE_WINDOW)
    return tables["top_genes"].select("id", "top_gene", "tss_signal")


@query
def promoter_regions(v):
    return genes.promoter_regions(v.peaks(), genes.start_table(v.annotation())).select(
        "id", "start", "end", "names", "gene_ids")


def _peak_genes(v: Views) -> DataFrame:
    return genes.peak_genes(v.peaks(), genes.start_table(v.annotation()), tss_window=1000, window=GENE_WINDOW)


@query
def peak_genes(v):
    return _peak_genes(v).select("id", "gene_id", "tss_peak", "signal")


@query
def peak_gene_signal(v):
    return genes.gene_signal(_peak_genes(v))


@query
def gene_name_signal(v):
    return genes.collapse_names(genes.gene_signal(_peak_genes(v))).select(
        "name", "gene_id", "proximal_events", "total_signal")


@query
def rank_lookup(v):
    ranked = ranking.super_table(_ranked_map(v))
    return genes.rank_lookup(_consensus(v), checkpointed(ranked), "best_rank").select("id", "best_rank")


@query
def gene_lookup(v):
    return genes.lowest_id(genes.start_table(v.annotation()))


@query
def start_table(v):
    return genes.start_table(v.annotation())


@query
def name_dedupe(v):
    return ordering.keep_first(v.annotation(), ["name"], [F.col("row")]).select("name", "id")


@query
def transcript_windows(v):
    return genes.transcripts(v.annotation(), 500, 200).select("id", "chrom", "start", "end", "strand")


# --- comparison ---------------------------------------------------------------------------------

def _delta(v: Views) -> DataFrame:
    region_map = checkpointed(_region_map(v))
    m1 = ordering.median(region_map.where("file1 > 0"), [], "file1", "m").scalar()
    m2 = ordering.median(region_map.where("file2 > 0"), [], "file2", "m").scalar()
    return comparison.delta_table(region_map, "file1", "file2", m1, m2)


@query
def delta_table(v):
    return rounded(_delta(v).select("id", "log2_change", "scaled1", "scaled2", "rank"),
                   "log2_change", "scaled1", "scaled2")


@query
def gain_loss(v):
    return comparison.gained_lost(_delta(v), 1.0).select("id", "status")


@query
def status_genes(v):
    delta = checkpointed(_delta(v))
    located = jobs.map_genes(delta.withColumnRenamed("rank", "enhancer_rank"), v.annotation(),
                             window=1000)["region_genes"]
    return comparison.status_genes(comparison.gained_lost(located, 1.0)).select("gene", "id", "status")


@query
def region_cluster(v):
    return comparison.region_clusters(v.expression_matrix(), SAMPLES, 10).select("gene", "cluster")


@query
def cluster_exemplar(v):
    """Median profile per brand, the brands standing for clusters."""
    brands = v.table("part").select(F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("gene"),
                                    F.col("p_brand").alias("cluster"))
    return comparison.cluster_exemplars(v.expression_matrix().join(brands, "gene"), SAMPLES)


@query
def sample_corr(v):
    return rounded(expression.sample_correlation(v.expression_matrix(), SAMPLES), "r", "distance")


@query
def heatmap_order(v):
    out = matrices.heatmap_order(v.expression_matrix(), ["A_F", "A_O"], {"A_F": "R_F", "A_O": "R_O"}, key="gene")
    return rounded(out.select("gene", "mean_signal", "row_order"), "mean_signal")


@query
def colour_limits(v):
    return rounded(matrices.colour_limits(v.expression_matrix(), SAMPLES), "low", "high")


# --- regions ------------------------------------------------------------------------------------

@query
def tss_regions(v):
    return region_sets.gene_regions(genes.start_table(v.annotation()))


@query
def meta_regions(v):
    return region_sets.meta_regions(genes.start_table(v.annotation()))


@query
def chrom_tiles(v):
    return region_sets.chrom_tiles(v.chrom_sizes(), 7000)


@query
def enriched_windows(v):
    return region_sets.widened(v.peaks(), 2000).select("id", "chrom", "start", "end", "strand")


@query
def strand_flanks(v):
    return loci.flank(v.peaks(), 500, 100).select("id", "start", "end")


@query
def centre_windows(v):
    return v.peaks().select("id", *[c.alias(n) for n, c in loci.centre_window(300).items()])


@query
def stretch_regions(v):
    return v.peaks().select("id", *[c.alias(n) for n, c in loci.stretch_to(300).items()])


@query
def region_parse(v):
    text = v.peaks().withColumn("text", loci.plot_text())
    return text.select("id", "text", *[c.alias(n) for n, c in loci.parse_region("text").items()])


@query
def locus_text(v):
    df = v.peaks().withColumn("locus_line", loci.text())
    return df.select("id", "locus_line", loci.place_text().alias("place"),
                     *[c.alias("p_" + n) for n, c in loci.parse_text("locus_line").items()])


@query
def gene_plot_region(v):
    starts = genes.start_table(v.annotation())
    return region_sets.plot_region(starts, "TXN").withColumn("kind", F.lit("TXN")).unionByName(
        region_sets.plot_region(starts, "TSS").withColumn("kind", F.lit("TSS")))


@query
def plot_features(v):
    out = tracks.feature_coordinates(v.peaks(), genes.transcripts(v.annotation()), 200)
    return rounded(out, "name_at", "x_start", "x_end")


# --- expression ---------------------------------------------------------------------------------

@query
def expr_floor(v):
    shifted = v.expression().withColumn("value", F.col("value") / 1000 - 0.02)
    return rounded(expression.floored(shifted), "value")


@query
def expr_filter(v):
    return expression.expressed_genes(v.expression(), len(SAMPLES))


@query
def group_means(v):
    return rounded(expression.group_means(v.expression(), list(GROUPS)), *GROUPS)


@query
def diff_table(v):
    out = expression.differential(v.expression(), "^A", "^R").drop("p_value")
    return rounded(out, "mean1", "mean2", "log2_fold_change", "t", "df")


@query
def diff_p_values(v):
    return rounded(expression.differential(v.expression(), "^A", "^R").select("gene", "p_value"), "p_value", places=5)


@query
def sig_genes(v):
    table = expression.significant(expression.differential(v.expression(), "^A", "^R"))
    return rounded(rounded(table.select("gene", "direction", "log2_fold_change", "p_value"), "log2_fold_change"), "p_value", places=5)


@query
def replicate_spearman(v):
    return rounded(expression.replicate_spearman(v.expression(), GROUPS), "spearman")


def _controls(v: Views) -> DataFrame:
    return v.table("part").where(F.col("p_type") == "ECONOMY").select(
        F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("gene"))


@query
def spike_offset(v):
    return rounded(expression.spike_offsets(v.expression(), _controls(v)), "offset")


@query
def spike_normalised(v):
    return rounded(expression.spike_normalised(v.expression(), _controls(v)), "value", places=4)


@query
def spike_table(v):
    listed = v.table("part").select(
        F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("control_id"),
        F.col("p_retailprice").alias("concentration"))
    return expression.spike_table(v.expression(), _controls(v), listed)


@query
def probe_best(v):
    rows = v.expression_matrix().select(
        F.col("gene").alias("probe"), F.substr("gene", F.lit(2)).cast("long").alias("row"), *SAMPLES)
    listed = v.table("part").select(
        F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("probe"), F.col("p_name").alias("gene_id"))
    return rounded(expression.best_probe(rows, listed, SAMPLES).select("gene_id", "probe", "mean"), "mean")


@query
def unpivot_expr(v):
    return matrices.lengthen(v.expression_matrix(), ["gene"], SAMPLES)


@query
def moving_avg(v):
    """Centred mean of 39 values along the genes ordered by the first group."""
    df = v.expression_matrix().select("gene", "A_F", "R_F")
    return rounded(ordering.moving_average(df, [], [F.col("A_F"), F.col("gene")], "R_F", 39, "smooth"), "smooth")


@query
def quantile_limits(v):
    return rounded(expression.value_limits(v.expression()), "axis_min", "axis_max")


@query
def row_sample(v):
    return expression.row_sample(v.expression_matrix(), by=["gene"])


# --- screen, sequences --------------------------------------------------------------------------

@query
def guide_extract(v):
    return screen.extract_guides(v.sequence_records(), "the", 3, 20).select("record", "guide")


@query
def guide_stats(v):
    return rounded(screen.extraction_stats(v.sequence_records(), "the"), "fraction")


@query
def guide_slice_counts(v):
    guides = screen.extract_guides(v.sequence_records(), "th", 2, 3).withColumn("sample", F.lit("documents"))
    return screen.guide_counts(guides)


def _folds(v: Views) -> DataFrame:
    mmr = lambda flag: v.guide_counts(flag).agg(F.round(F.sum("count") / 1e6, 4)).scalar()
    return screen.fold_table(v.guide_counts("A"), v.guide_counts("R"), v.guide_annotation(), mmr("A"), mmr("R"))


@query
def fold_table(v):
    return rounded(_folds(v), "log2_ratio")


@query
def construct_rank(v):
    """Ranks follow the ratio rounded to nine places, so equal ratios tie in any engine."""
    folds = rounded(_folds(v), "log2_ratio", places=9)
    return rounded(screen.construct_ranks(folds), "log2_ratio")


@query
def rev_comp(v):
    return v.sequence_records().select("record", F.md5(reverse_complement("seq")).alias("rc"),
                                       F.md5(reverse_complement("seq", reverse=False, rna=True)).alias("rna"))


@query
def fasta_fetch(v):
    name = f"strandline_genome_{uuid.uuid4().hex}"
    genome = sequences.store_genome(v.sequences(), name, f"{checkpoint_dir(v.spark)}/{name}")
    out = sequences.fetch(v.sequence_regions(), genome)
    return out.select("id", F.length("sequence").cast("long").alias("n"), F.md5("sequence").alias("sequence"))


@query
def category_counts(v):
    return collections.category_counts(v.table("documents"), "text", " ")


# --- reads --------------------------------------------------------------------------------------

@query
def cigar_len(v):
    return v.alignments().groupBy("cigar", rd.aligned_length().alias("aligned")).agg(F.count(F.lit(1)).alias("n"))


@query
def read_extend(v):
    ext = v.reads().withColumns(rd.extended(200))
    return ext.groupBy("strand", "ext_start", "ext_end").agg(F.count(F.lit(1)).alias("n"))


@query
def junction_split(v):
    pieces = rd.read_loci(v.reads())
    return pieces.groupBy("chrom", "start", "end", "strand", "part").agg(F.count(F.lit(1)).alias("n"))


@query
def reads_dedup(v):
    return coverage.drop_duplicate_reads(v.alignments().withColumn("strand", rd.strand_of()))


@query
def reads_merge(v):
    merged = coverage.merge_samples(v.reads(), 9, [1, 2])
    return merged.groupBy("file_key", "chrom", "pos").agg(F.count(F.lit(1)).alias("n"))


@query
def file_index_stats(v):
    return coverage.file_index_stats(v.alignments(), v.chrom_sizes())


@query
def file_totals(v):
    return coverage.file_totals(v.alignments())


# --- collections --------------------------------------------------------------------------------

@query
def locus_normalise(v):
    swapped = v.peaks().select("id", "chrom", F.col("end").alias("start"), F.col("start").alias("end"), "strand")
    return loci.normalise(swapped).select("id", "start", "end", loci.length().alias("length"))


@query
def collection_size(v):
    return v.regions().groupBy("status").agg(F.sum(loci.size()).alias("size"), F.count(F.lit(1)).alias("n"))


@query
def union_loci(v):
    return collections.union_loci(v.peaks("F"), v.peaks("O"), v.peaks("P"))


@query
def remove_loci(v):
    return collections.remove_loci(v.regions(), v.peaks("P")).select("id")


@query
def chrom_filter(v):
    allowed = collections.chrom_consensus(v.file_chroms())
    return collections.on_chromosomes(v.regions(), allowed).select("id")


@query
def chrom_blacklist(v):
    """Chromosome names read as fragments: everything with a 2 in its name goes."""
    return coverage.drop_blacklisted(v.regions(), ["r2", "chr12"]).select("id", "chrom")


@query
def chrom_consensus(v):
    return collections.chrom_consensus(v.file_chroms())


@query
def unique_ids(v):
    return collections.require_unique(v.regions()).select("id")


@query
def set_ops(v):
    a = v.peaks("F").select("chrom", F.floor(F.col("start") / 5000).alias("tile"))
    b = v.peaks("O").select("chrom", F.floor(F.col("start") / 5000).alias("tile"))
    return collections.set_operations(a, b)


@query
def sample_filter(v):
    return collections.signal_samples(v.samples(), prefix="S").select("name")


@query
def background_pairs(v):
    return collections.background_pairs(v.samples())


@query
def bam_table(v):
    lookup = v.table("supplier").select(
        F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("wce_"), F.col("s_suppkey").cast("string")))
        .otherwise(F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))).alias("name"),
        F.col("s_name").alias("source"))
    return collections.sorted_sources(v.samples().select("name", "file_path"), lookup)


@query
def rank_none(v):
    df = v.table("customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("value"))
    return ordering.order_index(df, "value", [F.col("c_custkey")], descending=True)


@query
def topn(v):
    return ordering.top_n(v.peaks(), 50, [F.desc("signal"), F.asc("id")]).select("id", "signal")


@query
def greedy_enhancers(v):
    peaks = v.regions().withColumn("sample_rank", F.when(F.col("status") == "F", 1)
                                   .when(F.col("status") == "O", 2).otherwise(3))
    return genes.greedy_windows(peaks, genes.start_table(v.annotation()), window=500, tss_window=500)
