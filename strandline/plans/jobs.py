"""The composite jobs: each takes DataFrames and returns the tables a user reads.

A table that several later steps use is checkpointed once, where the original
workflow writes a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import loci
from strandline.functions.signal import subtract_background
from strandline.operators import (collections, comparison, coverage, expression, genes, matrices, ordering,
                                  overlaps, ranking, regions as region_sets, screen, stitching, tracks)
from strandline.session import checkpointed


def bin_counting(reads: DataFrame, files: DataFrame, file_chroms: DataFrame, bin_size: int = 100_000, *,
                 extension: int = 0, strand: str = ".",
                 blacklist: list[str] = coverage.BIN_BLACKLIST) -> dict[str, DataFrame]:
    """Bin counts, normalised bins with percentiles and the summary."""
    counts = checkpointed(coverage.bin_counts(reads, file_chroms, bin_size, extension=extension, strand=strand,
                                              blacklist=blacklist))
    return {"bin_counts": counts, **derived_from_counts(counts, files, bin_size)}


def derived_from_counts(counts: DataFrame, files: DataFrame, bin_size: int) -> dict[str, DataFrame]:
    """Normalised bins with percentiles and the summary; ``counts`` and ``files`` are read several times."""
    lines = coverage.bin_percentiles(counts, files, bin_size)
    averages = coverage.cell_type_averages(coverage.normalised_bins(counts, files, bin_size), files, bin_size)
    normalised = checkpointed(lines.unionByName(averages))
    summary = coverage.bin_summary(normalised)
    return {"normalized_counts": normalised, "summary": summary,
            "sorted_summary": coverage.sorted_summary(summary)}


def region_counting(reads: DataFrame, regions: DataFrame, files: DataFrame, file_chroms: DataFrame,
                    names: dict[int, str], *, extension: int = 0, mode: str = ".") -> dict[str, DataFrame]:
    """Region counts with densities and the region x file matrix."""
    counts = coverage.region_counts(reads, regions, file_chroms, extension=extension, mode=mode)
    densities = coverage.region_densities(counts, files)
    return {"region_counts": densities, "matrix": coverage.region_matrix(densities, names)}


def stitched_regions(peaks: DataFrame, starts: DataFrame | None = None, *, window: int | None = 12_500,
                     tss_window: int = 0, mask: DataFrame | None = None,
                     allowed_chroms: DataFrame | None = None) -> DataFrame:
    """Filtered peaks merged within ``window``; without a window the best step of the sweep is used."""
    kept = peaks
    if allowed_chroms is not None:
        kept = collections.on_chromosomes(kept, allowed_chroms)
    kept = collections.require_unique(kept)
    if mask is not None:
        kept = overlaps.not_overlapping(kept, mask)
    if starts is not None and tss_window > 0:
        zone = genes.tss_loci(starts, tss_window, tss_window)
        kept = overlaps.overlap_filter(kept, zone, relation="contained", keep=False)
    kept = checkpointed(stitching.dedupe_loci(kept))
    if window is None:
        window = int(stitching.best_step(stitching.stitch_sweep(kept)).first()["best_step"])
    merged = stitching.stitch(kept, window)
    if starts is not None and tss_window > 0:
        merged = stitching.unstitch_multi_tss(merged, kept, starts)
    return checkpointed(stitching.constituent_size(merged, peaks))


def enhancer_ranking(peaks: DataFrame, reads: DataFrame, files: DataFrame, file_chroms: DataFrame,
                     samples: dict[int, str], rank_by: str, control: str | None = None,
                     starts: DataFrame | None = None, **stitching_options) -> dict[str, DataFrame]:
    """Stitched regions with signal per sample, then super, stretch and combined tables."""
    stitched = stitched_regions(peaks, starts, **stitching_options)
    counted = coverage.region_densities(coverage.region_counts(reads, stitched, file_chroms), files)
    region_map = matrices.region_map(stitched, counted, samples)
    signal = subtract_background(rank_by, control) if control else F.greatest(F.lit(0.0), F.col(rank_by))
    region_map = checkpointed(region_map.withColumn("signal", signal))
    return {"region_map": region_map, "super": ranking.super_table(region_map),
            "stretch": ranking.stretch_table(region_map),
            "super_stretch": ranking.super_stretch_table(region_map)}


def replicate_ranking(peak_sets: list[DataFrame], reads: DataFrame, files: DataFrame, file_chroms: DataFrame,
                      samples: dict[int, str], pairs: list[tuple[str, str | None]], window: int = 12_500,
                      starts: DataFrame | None = None, tss_window: int = 0) -> dict[str, DataFrame]:
    """Ranking on the union of replicate peaks and the mean of their clipped signals."""
    union = stitching.stitch(collections.union_loci(*peak_sets), 1)
    stitched = stitched_regions(union.select(*loci.LOCUS_KEY, "id"), starts, window=window, tss_window=tss_window)
    densities = coverage.region_densities(coverage.region_counts(reads, stitched, file_chroms), files)
    region_map = matrices.collapse_replicates(matrices.region_map(stitched, densities, samples), pairs)
    region_map = checkpointed(region_map)
    return {"region_map": region_map, "super": ranking.super_table(region_map)}


def map_genes(ranked: DataFrame, annotation: DataFrame, *, window: int = 50_000,
              unique_names: bool = True) -> dict[str, DataFrame]:
    """Regions with their genes, genes with their regions, by proximity."""
    starts = genes.start_table(annotation)
    pairs = checkpointed(genes.gene_pairs(ranked, starts, genes.transcripts(annotation), window))
    nearest = genes.nearest_gene(ranked, starts, pairs)
    return {"pairs": pairs, "region_genes": genes.assign_genes(ranked, pairs, nearest),
            "gene_regions": genes.gene_rollup(ranked, pairs, unique_names=unique_names)}


def map_genes_by_signal(ranked: DataFrame, annotation: DataFrame, reads: DataFrame, files: DataFrame,
                        file_chroms: DataFrame, file_key: int, control: int | None = None, *,
                        window: int = 50_000) -> dict[str, DataFrame]:
    """As ``map_genes`` plus the gene of highest signal (transcript +- 5 kb) per region."""
    tables = map_genes(ranked, annotation, window=window)
    around = genes.transcripts(annotation, 5000, 5000, dedupe="id")
    counts = coverage.region_counts(reads, around, file_chroms)
    wide = coverage.region_densities(counts, files).groupBy(F.col("id").alias("gene_id")).agg(
        F.max(F.when(F.col("file_key") == file_key, F.round("density", 4))).alias("_t"),
        F.max(F.when(F.col("file_key") == (control or 0), F.round("density", 4))).alias("_c"))
    value = subtract_background("_t", "_c") if control else F.col("_t")
    signal = wide.select("gene_id", value.alias("signal"))
    tables["top_genes"] = genes.top_gene(tables["region_genes"], tables["pairs"], tables["gene_regions"], signal)
    return tables


def dynamic_enhancers(ranked1: DataFrame, ranked2: DataFrame, reads: DataFrame, files: DataFrame,
                      file_chroms: DataFrame, samples: dict[int, str], name1: str, name2: str,
                      annotation: DataFrame, *, cutoff: float = 1.0, window: int = 100_000,
                      super_only: bool = True) -> dict[str, DataFrame]:
    """Gained, lost and conserved regions between two ranked tables.

    ``samples`` names the files ``name1`` and ``name2``.
    """
    def chosen(df, name):
        df = df.where("is_super = 1") if super_only else df
        return df.select("chrom", "start", "end", F.lit(".").alias("strand"),
                         F.concat(F.lit(name + "_"), "id").alias("id"))

    merged = checkpointed(stitching.merged_with_sources(chosen(ranked1, name1), chosen(ranked2, name2)))
    densities = coverage.region_densities(coverage.region_counts(reads, merged, file_chroms), files)
    region_map = checkpointed(matrices.region_map(merged, densities, samples))
    m1 = ordering.median(ranked1, [], "signal", "m").scalar()
    m2 = ordering.median(ranked2, [], "signal", "m").scalar()
    delta = checkpointed(comparison.delta_table(region_map, name1, name2, m1, m2))
    located = map_genes(delta.withColumnRenamed("rank", "enhancer_rank"), annotation, window=window)["region_genes"]
    looked = genes.rank_lookup(genes.rank_lookup(located, ranked1, "rank_1"), ranked2, "rank_2")
    table = comparison.gained_lost(looked, cutoff, (name1, name2))
    return {"delta": delta, "table": table, "genes": comparison.status_genes(table)}


def consensus_clusters(peaks: DataFrame, analysis: str, reads: DataFrame, files: DataFrame,
                       file_chroms: DataFrame, samples: dict[int, str],
                       pairs: dict[str, tuple[str, str | None]], k: int = 10) -> dict[str, DataFrame]:
    """Consensus regions, median-normalised signal, sample correlation, clusters and exemplars."""
    merged = checkpointed(stitching.consensus_regions(peaks, analysis))
    densities = coverage.region_densities(coverage.region_counts(reads, merged, file_chroms), files)
    matrix = checkpointed(matrices.median_normalised(
        matrices.region_map(merged, densities, samples), pairs))
    names = list(pairs)
    clustered = comparison.region_clusters(matrix, names, k)
    return {"regions": merged, "signal": matrix, "correlation": expression.sample_correlation(matrix, names),
            "clusters": clustered, "exemplars": comparison.cluster_exemplars(clustered, names)}


def hyper_occupancy(peaks: DataFrame, annotation: DataFrame, window: int = 50_000) -> dict[str, DataFrame]:
    """Peaks assigned to genes and the signal per gene, names collapsed."""
    starts = genes.start_table(annotation)
    rows = genes.peak_genes(peaks, starts, window=window)
    signal = genes.gene_signal(rows)
    return {"peak_genes": rows, "gene_signal": signal, "by_name": genes.collapse_names(signal)}


def occupancy(regions: DataFrame, peaks: DataFrame, samples: list[str],
              logic: list[list[str]]) -> dict[str, DataFrame]:
    matrix = overlaps.occupancy_matrix(regions, peaks, samples)
    return {"matrix": matrix, "selected": matrix.where(overlaps.any_of_all(logic))}


def meta_gene(reads: DataFrame, starts: DataFrame, files: DataFrame, file_chroms: DataFrame,
              bins: dict[str, int] | None = None, extension: int = 0) -> DataFrame:
    """Upstream, transcript and downstream densities of every gene in one row, both strands added."""
    bins = bins or {"tss": 60, "txn": 200, "ttr": 60}
    parts = region_sets.meta_regions(starts)
    arrays = {}
    for mode in ("+", "-"):
        arrays[mode] = [coverage.density_arrays(coverage.piece_densities(
            reads, parts.where(F.col("kind") == kind), files, file_chroms, n_bins=n, extension=extension,
            mode=mode)) for kind, n in bins.items()]
    return coverage.meta_profile(arrays["+"], arrays["-"])


def guide_screen(test: DataFrame, control: DataFrame, annotation: DataFrame, test_mmr,
                 control_mmr) -> dict[str, DataFrame]:
    folds = screen.fold_table(test, control, annotation, test_mmr, control_mmr)
    return {"folds": folds, "constructs": screen.construct_ranks(folds)}


def expression_report(long: DataFrame, groups: dict[str, list[str]], first: str, second: str,
                      controls: DataFrame | None = None) -> dict[str, DataFrame]:
    """Normalised table, group means, replicate agreement, differential table and its significant genes."""
    table = expression.floored(long)
    if controls is not None:
        table = expression.spike_normalised(table, controls)
    kept = table.join(expression.expressed_genes(table), "gene", "left_semi")
    diff = expression.differential(kept, first, second)
    hits = expression.significant(diff)
    return {"table": table, "means_all": expression.group_means(table, list(groups)),
            "means": expression.group_means(kept, list(groups)),
            "replicates": expression.replicate_spearman(table, groups), "differential": diff,
            "significant": hits, "top": expression.top_per_direction(hits)}


def probe_genes(probe_rows: DataFrame, probe_annotation: DataFrame, starts: DataFrame,
                samples: list[str]) -> DataFrame:
    """Gene table of the best probes; a probe without a transcript id maps through its gene name."""
    direct = probe_annotation.where(F.col("transcript").startswith("NM")).select(
        "probe", F.substring_index("transcript", ".", 1).alias("gene_id"))
    named = probe_annotation.where(~F.col("transcript").startswith("NM")).select("probe", F.col("name").alias("gene_id"))
    # the best probe of a name is found before the name meets its genes, so many probes and genes of one name make no pairs
    by_name = expression.best_rows(probe_rows, named, samples).withColumnRenamed("gene_id", "name")
    by_name = by_name.join(starts.select("name", F.col("id").alias("gene_id")), "name").drop("name")
    by_id = expression.best_rows(probe_rows, direct, samples)
    best = expression.first_of_gene(by_id.unionByName(by_name)).drop("row")
    return best.join(starts.select(F.col("id").alias("gene_id"), "name"), "gene_id").select(
        "gene_id", "name", *samples)


def heatmap(matrix: DataFrame, columns: list[str], background: dict[str, str] | None = None) -> dict[str, DataFrame]:
    return {"rows": matrices.heatmap_order(matrix, columns, background),
            "limits": matrices.colour_limits(matrix, columns)}


def locus_tracks(plot_regions: DataFrame, reads: DataFrame, files: DataFrame, file_chroms: DataFrame,
                 annotation: DataFrame, beds: DataFrame | None = None, *, n_bins: int = 200,
                 extension: int = 200) -> dict[str, DataFrame]:
    """Signal, gene and BED tables behind a locus plot."""
    out = {"signal": coverage.piece_densities(reads, plot_regions, files, file_chroms, n_bins=n_bins,
                                              extension=extension),
           "genes": tracks.feature_coordinates(plot_regions, genes.transcripts(annotation), n_bins)}
    if beds is not None:
        out["beds"] = tracks.feature_coordinates(plot_regions, beds, n_bins)
    return out
