"""The composite jobs as queries, end to end over the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import loci
from strandline.operators import collections, genes, stitching
from strandline.operators import regions as region_sets
from strandline.plans import jobs
from strandline.plans.queries import FILES, GENE_WINDOW, GROUPS, query, rounded
from strandline.session import checkpointed
from strandline.sources.views import SAMPLES, Views


def _counted(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    return v.reads(), checkpointed(v.files()), checkpointed(v.file_chroms())


@query
def job_region_counting(v):
    """Reads of the region's strand grown by 200 bases, one column per file."""
    return jobs.region_counting(v.reads(), v.regions(), v.files(), v.file_chroms(), FILES, extension=200, mode="+")["matrix"]


@query
def job_enhancer_ranking(v):
    """Peaks on all chromosomes of all files, masked, away from TSS, stitched, unstitched where crowded, ranked."""
    reads, files, chroms = _counted(v)
    out = jobs.enhancer_ranking(
        v.peaks(), reads, files, chroms, FILES, "file1", "file3", genes.start_table(v.annotation()), window=500,
        tss_window=1000, mask=v.peaks("P"), allowed_chroms=collections.chrom_consensus(chroms))
    table = out["super_stretch"].join(out["super"].select("id", "is_super"), "id")
    return rounded(table.select("id", "num_loci", "constituent_size", "signal", "magnitude", "enhancer_rank", "is_super",
                                "is_super_stretch"), "signal", "magnitude", places=4)


@query
def job_replicate_ranking(v):
    reads, files, chroms = _counted(v)
    out = jobs.replicate_ranking([v.peaks("F"), v.peaks("O")], reads, files, chroms, FILES,
                                 [("file1", "file3"), ("file2", "file3")], 500)
    return rounded(out["super"].select("id", "constituent_size", "signal", "enhancer_rank", "is_super"), "signal")


@query
def job_dynamic_enhancers(v):
    """Changes between the peaks of two conditions, with genes and the best rank in either."""
    reads, files, chroms = _counted(v)
    names, ranked = {1: "one", 2: "two"}, []
    for status, name in (("F", "one"), ("O", "two")):
        out = jobs.enhancer_ranking(v.peaks(status), reads, files, chroms, names, name, window=500)
        ranked.append(checkpointed(out["super"].withColumn("signal", F.greatest("signal", F.lit(1.0)))))
    table = jobs.dynamic_enhancers(*ranked, reads, files, chroms, names, "one", "two", v.annotation(), window=5000,
                                   super_only=False)["table"]
    return rounded(table.select("id", "log2_change", F.col("enhancer_rank").alias("rank"), "status", "rank_1", "rank_2",
                                "overlap_genes", "proximal_genes", "closest_gene"), "log2_change")


@query
def job_consensus_clusters(v):
    """Sample correlation over the consensus regions of two conditions."""
    reads, files, chroms = _counted(v)
    wide = region_sets.widened(v.peaks("F").unionByName(v.peaks("O")).drop("signal"), 300)
    out = jobs.consensus_clusters(wide, "x", reads, files, chroms, {1: "a", 2: "b", 3: "c"},
                                  {"a": ("a", None), "b": ("b", None), "c": ("c", None)}, k=3)
    return rounded(out["correlation"], "r", "distance")


@query
def job_hyper_occupancy(v):
    return jobs.hyper_occupancy(v.peaks(), v.annotation(), GENE_WINDOW)["by_name"].select(
        "name", "gene_id", "proximal_events", "total_signal", "promoter_regions", "distal_signal")


@query
def job_occupancy(v):
    consensus = stitching.consensus_regions(v.peaks("F").unionByName(v.peaks("O")).drop("signal"), "x")
    peaks = v.regions().select("chrom", "start", "end", F.col("status").alias("sample"))
    out = jobs.occupancy(checkpointed(consensus.select("id", "chrom", "start", "end")), peaks, ["F", "O", "P"], [["F", "P"], ["O", "P"]])
    return out["selected"].select("id", "F", "O", "P")


@query
def job_guide_screen(v):
    """Ranks of the constructs; the ratios are of whole counts, so equal ones tie exactly."""
    mmr = lambda flag: v.guide_counts(flag).agg(F.round(F.sum("count") / 1e6, 4)).scalar()
    out = jobs.guide_screen(v.guide_counts("A"), v.guide_counts("R"), v.guide_annotation(), mmr("A"), mmr("R"))
    return rounded(out["constructs"].select("guide", "gene", "log2_ratio", "hairpin_weight"), "log2_ratio")


@query
def job_expression_report(v):
    """Differences of two groups after spike-in normalisation, expressed genes only."""
    controls = v.table("part").where(F.col("p_type") == "ECONOMY").select(
        F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("gene"))
    out = jobs.expression_report(v.expression(), GROUPS, "^A", "^R", controls)
    table = out["differential"].select("gene", "mean1", "mean2", "log2_fold_change")
    return rounded(table.join(out["means"].select("gene", F.col("N").alias("mean_n")), "gene"),
                   "mean1", "mean2", "log2_fold_change", "mean_n", places=4)


@query
def job_probe_genes(v):
    """Probes with a transcript id map through it, the others through the name of their gene."""
    key = F.col("p_partkey")
    listed = v.table("part").select(
        F.concat(F.lit("g"), key.cast("string")).alias("probe"),
        F.concat(F.when(key % 2 == 0, "NM_").otherwise("XR_"), key.cast("string"), F.lit(".2")).alias("transcript"),
        F.col("p_name").alias("name"))
    rows = v.expression_matrix().select(
        F.col("gene").alias("probe"), F.substr("gene", F.lit(2)).cast("long").alias("row"), *SAMPLES)
    return jobs.probe_genes(rows, listed, genes.start_table(v.annotation()), SAMPLES)


@query
def job_heatmap(v):
    out = jobs.heatmap(v.expression_matrix().withColumnRenamed("gene", "id"), ["A_F", "N_O"], {"A_F": "R_F", "N_O": "R_O"})
    low, high = (out["limits"].select(c).scalar() for c in ("low", "high"))
    return rounded(out["rows"].select("id", "mean_signal", "row_order", low.alias("low"), high.alias("high")),
                   "mean_signal", "low", "high")


@query
def job_locus_tracks(v):
    """Signal, gene and BED tracks of the longer peaks, as (kind, id, track, place, value) rows."""
    beds = v.peaks("O").select("id", *loci.LOCUS_KEY, F.col("id").alias("name"))
    out = jobs.locus_tracks(v.peaks().where("end - start > 300"), v.reads(), v.files(), v.file_chroms(), v.annotation(),
                            beds, n_bins=20, extension=0)
    row = lambda kind, track, place, value: [F.lit(kind).alias("kind"), "id", track.alias("track"),
                                             place.cast("double").alias("place"), value.alias("value")]
    tracks = out["signal"].select(*row("signal", F.col("file_key").cast("string"), F.col("bin"), F.col("density")))
    for kind in ("genes", "beds"):
        tracks = tracks.unionByName(out[kind].select(*row(kind, F.col("feature"), F.col("x_start"), F.col("x_end"))))
    return rounded(tracks, "place", "value", places=4)
