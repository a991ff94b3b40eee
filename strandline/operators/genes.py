"""Annotation tables and the assignment of regions to genes.

``annotation`` rows hold id, chrom, strand, tx_start, tx_end, name and ``row``,
their order in the source; an id may occur more than once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import loci
from strandline.operators import ordering
from strandline.operators.overlaps import overlap_filter, overlap_join
from strandline.session import checkpoint_dir, checkpointed, discard

OVERLAP, PROXIMAL, DISTAL = 0, 1, 2


def start_table(annotation: DataFrame) -> DataFrame:
    """One row per id, the first of the source: id, name, chrom, strand, tss, tts."""
    first = ordering.keep_first(annotation, ["id"], [F.col("row")])
    minus = F.col("strand") == "-"
    return first.select(
        "id", "name", "chrom", "strand",
        F.when(minus, F.col("tx_end")).otherwise(F.col("tx_start")).alias("tss"),
        F.when(minus, F.col("tx_start")).otherwise(F.col("tx_end")).alias("tts"))


def repeated_ids(annotation: DataFrame) -> DataFrame:
    return annotation.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def transcripts(annotation: DataFrame, upstream: int = 0, downstream: int = 0, *,
                dedupe: str = "coords") -> DataFrame:
    """Transcript loci of all annotation rows, widened. Equal places keep one id unless dedupe is ``id``."""
    all_rows = loci.flank(annotation.select(
        "id", "name", "chrom", "strand", F.col("tx_start").alias("start"), F.col("tx_end").alias("end")),
        upstream, downstream)
    key = loci.LOCUS_KEY if dedupe == "coords" else [*loci.LOCUS_KEY, "id"]
    return ordering.keep_first(all_rows, key, [F.col("id")])


def tss_loci(starts: DataFrame, upstream: int = 0, downstream: int = 0, *, dedupe: str = "coords") -> DataFrame:
    windows = starts.select("id", "name", "chrom", "strand", "tss", *[
        c.alias(n) for n, c in loci.tss_window(upstream, downstream).items()])
    key = loci.LOCUS_KEY if dedupe == "coords" else [*loci.LOCUS_KEY, "id"]
    return ordering.keep_first(windows, key, [F.col("id")])


def exon_arrays(annotation: DataFrame) -> DataFrame:
    """Exons, coding exons, introns and UTRs from comma lists of starts and ends."""
    numbers = lambda c: F.transform(F.split(F.rtrim(F.col(c), F.lit(",")), ","), lambda x: x.cast("long"))
    pair = lambda s, e: F.struct(s.alias("start"), e.alias("end"))
    exons = F.zip_with(numbers("exon_starts"), numbers("exon_ends"), pair)
    coding = (F.col("cds_start") != 0) | (F.col("cds_end") != 0)
    cut = lambda low, high: lambda e: pair(F.greatest(e["start"], low), F.least(e["end"], high))
    proper = lambda e: e["start"] < e["end"]
    df = annotation.withColumn("exons", exons).withColumn("is_coding", coding.cast("int"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    inner = F.filter(F.transform("exons", cut(F.col("cds_start"), F.col("cds_end"))), proper)
    left = F.filter(F.transform("exons", cut(F.lit(0), F.col("cds_start"))), proper)
    right = F.filter(F.transform("exons", cut(F.col("cds_end"), F.lit(1 << 40))), proper)
    count = F.size("exons")
    introns = F.zip_with(F.slice("exons", F.lit(1), count - 1), F.slice("exons", F.lit(2), count - 1),
                         lambda a, b: pair(a["end"], b["start"]))
    minus = F.col("strand") == "-"
    five = F.when(minus, right).otherwise(left)
    three = F.when(minus, left).otherwise(right)
    return df.withColumns(
        {"coding_exons": F.when(coding, inner).otherwise(empty),
         "introns": F.when(count > 1, introns).otherwise(empty),
         "utr5": F.when(coding, five).otherwise(empty),
         "utr3": F.when(coding, three).otherwise(empty)})


def gene_pairs(regions: DataFrame, starts: DataFrame, transcript_loci: DataFrame, window: int = 50_000, *,
               closest: int | None = None) -> DataFrame:
    """(region, gene, class, tss): class 0 transcript touches the region, 1 TSS within ``window``.

    With ``closest`` only the pairs that :func:`nearest_gene` with this reach may choose, a few per region; of genes
    with one TSS only the lowest id is sure to have class 0.
    """
    if closest is not None:
        return _closest_pairs(regions, starts, transcript_loci, window, closest)
    key = ["id", "chrom", "start", "end"]
    tss = tss_loci(starts)
    touching = overlap_join(regions.select(*key), transcript_loci).select(
        "id", "chrom", F.col("b_id").alias("gene_id"), F.lit(OVERLAP).alias("class"))
    wider = regions.select("id", "chrom", (F.col("start") - window).alias("start"),
                           (F.col("end") + window).alias("end"))
    near = overlap_join(wider, tss).select(
        "id", "chrom", F.col("b_id").alias("gene_id"), F.lit(PROXIMAL).alias("class"))
    return _named_pairs(touching.unionByName(near), starts)


def _named_pairs(pairs: DataFrame, starts: DataFrame) -> DataFrame:
    best = pairs.groupBy("id", "chrom", "gene_id").agg(F.min("class").alias("class"))
    named = starts.select(F.col("id").alias("gene_id"), "name", "tss")
    return best.join(named, "gene_id")


def _closest_pairs(regions: DataFrame, starts: DataFrame, transcript_loci: DataFrame, window: int,
                   reach: int) -> DataFrame:
    """The pairs of :func:`gene_pairs` that may be the closest one.

    Of the TSS, those next to the centre on either side. A transcript no longer than ``reach`` that begins or ends
    with the TSS of its gene is only chosen where that is one of these two, as the next one lies within reach and is
    closer. Of all other transcripts (repeated ids, very long ones) the closest is taken from those that touch the
    region. An id with several places is measured from each of their centres and keeps all its pairs.
    """
    places = regions.where(F.col("id").isNotNull()).groupBy("id").agg(
        *[f(F.struct("chrom", "start", "end")).alias(n) for n, f in (("_place", F.min), ("_last", F.max))])
    single = F.col("_place").eqNullSafe(F.col("_last"))
    points = places.where(single).select("id", "_place.*", loci.centre("_place.start", "_place.end").alias("centre"))
    several = regions.join(places.where(~single).select("id"), "id", "left_semi")
    tss = tss_loci(starts)
    sided = ordering.nearest_before_after(points, tss, ["chrom"], "centre", "tss")
    sides = sided.withColumn("tss", F.explode(F.array_distinct(F.array("before", "after")))).drop("before", "after")
    within = F.col("tss").between(F.col("start") - window, F.col("end") + window)
    near = sides.where(within).join(tss.select("chrom", "tss", F.col("id").alias("gene_id")), ["chrom", "tss"])

    own = starts.select("id", F.col("chrom").alias("_chrom"), "tss")
    placed = transcript_loci.select("id", "chrom", "start", "end").join(own, "id")
    at_end = (F.col("chrom") == F.col("_chrom")) & F.col("tss").isin(F.col("start"), F.col("end"))
    plain = F.coalesce(at_end & (F.col("end") - F.col("start") <= reach), F.lit(False))
    at_tss = _touching_at_tss(sides, placed.where(plain))

    far = overlap_join(points, placed.where(~plain).drop("_chrom"))
    order = F.struct(F.abs(F.col("centre") - F.col("b_tss")).alias("d"), "b_id")
    far = far.groupBy("id", "chrom").agg(F.min_by("b_id", order).alias("gene_id"))

    touching = at_tss.select("id", "chrom", "gene_id").unionByName(far)
    rows = touching.withColumn("class", F.lit(OVERLAP)).unionByName(
        near.select("id", "chrom", "gene_id", F.lit(PROXIMAL).alias("class")))
    return _named_pairs(rows, starts).unionByName(gene_pairs(several, starts, transcript_loci, window))


def _touching_at_tss(sides: DataFrame, transcript_loci: DataFrame) -> DataFrame:
    """``sides`` (region, tss) with the lowest ``gene_id`` of the transcripts that have their TSS there and touch the region.

    A transcript that starts at the TSS has to reach the start of the region, one that ends there has to begin before
    its end. Of all that reach as far, the lowest id is a running value along how far they reach.
    """
    key = ["chrom", "tss", "_side", "_far"]
    first = F.when(F.col("tss") == F.col("start"), F.struct(F.lit(0).alias("_side"), F.col("end").alias("_far")))
    last = F.when(F.col("tss") == F.col("end"), F.struct(F.lit(1).alias("_side"), (-F.col("start")).alias("_far")))
    reaching = transcript_loci.withColumn("_r", F.explode(F.array(first, last))).where("_r IS NOT NULL").select(
        "chrom", "tss", "_r.*", F.col("id").alias("gene_id"))
    first = F.when(F.col("tss") <= F.col("end"), F.struct(F.lit(0).alias("_side"), F.col("start").alias("_far")))
    last = F.when(F.col("tss") >= F.col("start"), F.struct(F.lit(1).alias("_side"), (-F.col("end")).alias("_far")))
    asked = sides.withColumn("_r", F.explode(F.array(first, last))).where("_r IS NOT NULL").select(
        "id", "chrom", "tss", "_r.*")
    marks = reaching.unionByName(asked.select(*key, F.lit(None).cast("string").alias("gene_id")))
    marks = marks.groupBy(*key).agg(F.min("gene_id").alias("_own"))
    lowest = ordering.scan(marks, key[:3], "_far", back={"gene_id": ("min", F.col("_own"))})
    return asked.join(lowest.where("gene_id IS NOT NULL").select(*key, "gene_id"), key)


def nearest_gene(regions: DataFrame, starts: DataFrame, pairs: DataFrame, reach: int = 1_000_000) -> DataFrame:
    """Closest TSS to the region centre; ties go to the lower class, then the lower id.

    The TSS on either side of the centre come from one ordered scan, so the
    wide search area is never joined.
    """
    points = regions.select("id", "chrom", "start", "end", loci.centre().alias("centre"))
    tss = tss_loci(starts)
    sided = ordering.nearest_before_after(points, tss, ["chrom"], "centre", "tss")
    sides = sided.withColumn("tss", F.explode(F.array_distinct(F.array("before", "after"))))
    sides = sides.where((F.col("tss") >= F.col("start") - reach) & (F.col("tss") <= F.col("end") + reach))
    wide = sides.select("id", "chrom", "centre", "tss").join(
        tss.select("chrom", "tss", F.col("id").alias("gene_id"), "name"), ["chrom", "tss"])
    wide = wide.select("id", "centre", "tss", "gene_id", "name", F.lit(DISTAL).alias("class"))
    known = pairs.drop("chrom").join(points.select("id", "centre"), "id").select(
        "id", "centre", "tss", "gene_id", "name", "class")
    distance = F.abs(F.col("centre") - F.col("tss"))
    order = F.struct(distance.alias("d"), F.col("class"), F.col("gene_id"))
    return wide.unionByName(known).groupBy("id").agg(
        F.min_by("name", order).alias("closest_gene"), F.min(distance).alias("distance"))


def assign_genes(regions: DataFrame, pairs: DataFrame, nearest: DataFrame) -> DataFrame:
    """Region table with the gene names it touches, the further names nearby and the closest one."""
    names = lambda c: F.array_join(F.array_sort(F.collect_set(
        F.when(F.col("class") == c, F.col("name")))), ",")
    lists = pairs.groupBy("id").agg(names(OVERLAP).alias("overlap_genes"),
                                    names(PROXIMAL).alias("proximal_genes"))
    out = regions.join(lists, "id", "left").join(nearest.select("id", "closest_gene"), "id", "left")
    return out.fillna("", subset=["overlap_genes", "proximal_genes", "closest_gene"])


def gene_rollup(ranked: DataFrame, pairs: DataFrame, *, unique_names: bool = True) -> DataFrame:
    """Per gene: its regions (touching first), their ranks, the best rank and the highest flag.

    With ``unique_names`` the id with the best rank stands for its name. The
    lists hold the regions within the search window of one gene.
    """
    regions = ranked.select("id", loci.place_text().alias("place"), F.col("enhancer_rank").alias("rank"),
                            F.col("is_super").alias("flag"))
    rows = pairs.select("id", "gene_id", "name", "class").join(regions, "id")
    cells = F.array_sort(F.collect_list(F.struct("class", "rank", "place")))
    ranks = F.array_sort(F.collect_list("rank"))
    genes = rows.groupBy("gene_id", "name").agg(
        F.array_join(F.transform(cells, lambda c: c["place"]), ",").alias("proximal_enhancers"),
        F.array_join(ranks.cast("array<string>"), ",").alias("enhancer_ranks"),
        F.max("flag").alias("is_super"), F.min("rank").alias("best_rank"))
    if unique_names:
        genes = ordering.keep_first(genes, ["name"], [F.col("best_rank"), F.col("gene_id")])
    return genes.select("name", "gene_id", "proximal_enhancers", "enhancer_ranks", "is_super", "best_rank")


def top_gene(regions: DataFrame, pairs: DataFrame, rolled: DataFrame, signal: DataFrame) -> DataFrame:
    """The nearby gene name with the highest signal; NULL when none has any.

    ``signal`` is (gene_id, signal); only the ids kept in the roll-up count.
    """
    by_name = rolled.join(signal, "gene_id", "left").groupBy("name").agg(
        F.max(F.coalesce("signal", F.lit(0.0))).alias("signal"))
    named = pairs.select("id", "name", "class").join(by_name, "name")
    order = F.struct(-F.col("signal"), F.col("class"), F.col("name"))
    best = named.groupBy("id").agg(F.min_by(F.struct("name", "signal"), order).alias("_top"))
    found = F.col("_top.signal") > 0
    best = best.select("id", F.when(found, F.col("_top.name")).alias("top_gene"),
                       F.when(found, F.col("_top.signal")).alias("tss_signal"))
    return regions.join(best, "id", "left")


def peak_genes(peaks: DataFrame, starts: DataFrame, *, tss_window: int = 5000, window: int = 50_000) -> DataFrame:
    """(peak, gene) rows: genes whose TSS window the peak touches, else those around its centre."""
    tss = tss_loci(starts, tss_window, tss_window)
    cols = ["id", "chrom", "start", "end", "signal"]
    at_tss = overlap_join(peaks.select(*cols), tss).withColumn("tss_peak", F.lit(1))
    away = overlap_filter(peaks.select(*cols), tss, keep=False)
    centred = away.select("id", "chrom", "signal", *[
        c.alias(n) for n, c in loci.centre_window(window).items()])
    around = overlap_join(centred, tss).withColumn("tss_peak", F.lit(0))
    picked = ["id", "signal", "tss_peak", F.col("b_id").alias("gene_id"), F.col("b_name").alias("name")]
    return at_tss.select(*picked).unionByName(around.select(*picked))


def gene_signal(rows: DataFrame) -> DataFrame:
    """Events and total signal per gene id, split into promoter and distal."""
    tss, value = F.col("tss_peak") == 1, F.col("signal")
    return rows.groupBy("gene_id", "name").agg(
        F.count(F.lit(1)).alias("proximal_events"), F.sum(value).alias("total_signal"),
        F.sum(F.when(tss, 1).otherwise(0)).alias("promoter_regions"),
        F.sum(F.when(tss, value).otherwise(0)).alias("promoter_signal"),
        F.sum(F.when(tss, 0).otherwise(1)).alias("distal_regions"),
        F.sum(F.when(tss, 0).otherwise(value)).alias("distal_signal"))


def collapse_names(signals: DataFrame) -> DataFrame:
    """Per gene name the id with the highest total signal."""
    return ordering.keep_first(signals, ["name"], [-F.col("total_signal"), F.col("gene_id")])


def promoter_regions(peaks: DataFrame, starts: DataFrame, *, max_names: int = 2, window: int = 0) -> DataFrame:
    """Peaks on the TSS of one to ``max_names`` gene names, with the ids they hit."""
    points = starts.select("id", "name", "chrom", F.col("tss").alias("start"),
                           (F.col("tss") + 1).alias("end"), F.lit(".").alias("strand"))
    points = ordering.keep_first(points, loci.LOCUS_KEY, [F.col("id")])
    key = ["id", *loci.LOCUS_KEY]
    hits = overlap_join(peaks.select(*key), points)
    found = hits.groupBy(*key).agg(F.count_distinct("b_name").alias("names")).where(F.col("names") <= max_names)
    ids = hits.join(found, key).groupBy(*key, "names").agg(
        F.array_join(F.array_sort(F.collect_set("b_id")), ",").alias("gene_ids"))
    return ids.withColumns({"start": F.col("start") - window, "end": F.col("end") + window})


def rank_lookup(regions: DataFrame, ranked: DataFrame, name: str) -> DataFrame:
    """Best rank of the ranked loci a region touches; the size of that table when there is none."""
    pairs = overlap_join(regions.select("id", "chrom", "start", "end"),
                         ranked.select("chrom", "start", "end", F.col("enhancer_rank").alias("rank")))
    best = pairs.groupBy("id").agg(F.min("b_rank").alias(name))
    default = ranked.agg(F.count(F.lit(1))).scalar()
    return regions.join(best, "id", "left").withColumn(name, F.coalesce(name, default))


def lowest_id(starts: DataFrame) -> DataFrame:
    """Per gene name the id with the lowest number, and how many ids it has."""
    number = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    return starts.groupBy("name").agg(
        F.min_by("id", F.struct(number.alias("n"), F.col("id"))).alias("id"),
        F.count_distinct("id").alias("n_ids"))


def greedy_windows(peaks: DataFrame, starts: DataFrame, *, window: int = 2000, tss_window: int = 5000) -> DataFrame:
    """Peaks away from any TSS whose span meets no window (centre +- ``window``) chosen before.

    Peaks are taken by ``sample_rank`` and then in a fixed scattered order (by
    the md5 of their place, then id). Of peaks with centres in one cell of
    ``window`` bases only one can be chosen, so a round looks at the first open
    peak of every cell: it is chosen when no open earlier peak's window meets
    it. A round drops what its choices rule out and hands on the open peaks;
    what it chose is written once. The first open peak of all is always
    chosen, so the rounds end.
    """
    tss = tss_loci(starts, tss_window, tss_window)
    place = F.md5(F.concat_ws(":", "chrom", F.col("start").cast("string"), F.col("end").cast("string")))
    turn = F.struct(F.col("sample_rank").alias("rank"), place.alias("place"), F.col("id").alias("id")).alias("turn")
    away = overlap_filter(peaks.select("id", "chrom", "start", "end", "sample_rank"), tss, keep=False)
    # of peaks with the same span only the first matters: it rules out the others, or falls to what rules them out too
    spans = away.groupBy("chrom", "start", "end").agg(F.min(turn).alias("turn"))
    cell = F.floor(loci.centre() / F.lit(window + 1)).alias("cell")
    open_ = checkpointed(spans.select("chrom", "start", "end", "turn", cell))
    reach = [c.alias(n) for n, c in loci.centre_window(window).items()]
    folder = f"{checkpoint_dir(peaks.sparkSession)}/strandline-windows-{uuid.uuid4().hex}"
    rounds = 0
    while rounds == 0 or not open_.isEmpty():
        first = open_.groupBy("chrom", "cell").agg(F.min_by(F.struct("start", "end", "turn"), "turn").alias("_p")).select(
            "chrom", "_p.*")
        waits = overlap_join(first, open_.select("chrom", *reach, "turn")).where("b_turn < turn").select("turn").distinct()
        free = first.join(waits, "turn", "left_anti")
        path = f"{folder}/round={rounds}"
        free.write.parquet(path)
        free = peaks.sparkSession.read.parquet(path)
        met = overlap_join(open_.select("chrom", "start", "end", "turn"), free.select("chrom", *reach, "turn"))
        settled = met.where("b_turn <= turn").select("turn").distinct().unionByName(free.select("turn"))
        left = checkpointed(open_.join(settled, "turn", "left_anti"))
        discard(open_)
        open_, rounds = left, rounds + 1
    chosen = peaks.sparkSession.read.option("basePath", folder).parquet(folder)
    return chosen.select(F.col("turn.id").alias("id"), "chrom", F.col("turn.rank").alias("sample_rank"), *reach)
