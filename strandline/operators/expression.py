"""Expression tables: floors, group means, differentials, spike-ins, probes.

Long tables hold (gene, sample, value). A sample belongs to every group whose
pattern occurs in its name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.signal import expression_floor, magnitude
from strandline.operators import ordering
from strandline.operators.matrices import widen
from strandline.session import checkpointed


def floored(long: DataFrame) -> DataFrame:
    return long.withColumn("value", expression_floor("value"))


def _extremes(long: DataFrame, n_samples: int | None = None) -> DataFrame:
    """(gene, _max, _min) over all samples of the table; a sample without a value of a gene counts as 0."""
    samples = long.agg(F.countDistinct("sample")).scalar() if n_samples is None else F.lit(n_samples)
    per_gene = long.groupBy("gene").agg(
        F.max("value").alias("_max"), F.min("value").alias("_least"), F.count("value").alias("_n"))
    least = F.when(F.col("_n") >= samples, F.col("_least")).otherwise(F.least("_least", F.lit(0.0)))
    return per_gene.select("gene", "_max", least.alias("_min"))


def expressed_genes(long: DataFrame, n_samples: int | None = None) -> DataFrame:
    """Genes above 1 in some sample and above 0 in all."""
    return _extremes(long, n_samples).where("_max > 1 and _min > 0").select("gene")


def _in_group(groups: list[str]):
    return F.explode(F.array_compact(F.array(*[F.when(F.col("sample").rlike(g), F.lit(g)) for g in groups])))


def group_means(long: DataFrame, groups: list[str]) -> DataFrame:
    """One row per gene with the mean of each group."""
    rows = long.withColumn("group", _in_group(groups))
    return widen(rows, ["gene"], "group", "value", groups, agg=F.avg)


def differential(long: DataFrame, first: str, second: str) -> DataFrame:
    """Means, log2 fold change, Welch t, degrees of freedom and p of two groups.

    p is 1 when all values agree and NULL when a group has one sample. All
    sums come from one pass over the samples of a gene.
    """
    stats = []
    for i, g in ((1, first), (2, second)):
        value = F.when(F.col("sample").rlike(g), F.col("value"))
        stats += [F.avg(value).alias(f"mean{i}"), F.var_samp(value).alias(f"var{i}"), F.count(value).alias(f"n{i}"),
                  F.min(value).alias(f"low{i}"), F.max(value).alias(f"high{i}")]
    per_gene = long.groupBy("gene").agg(*stats)
    enough = (F.col("n1") > 1) & (F.col("n2") > 1)
    constant = F.least("low1", "low2") == F.greatest("high1", "high2")
    e1, e2 = F.col("var1") / F.col("n1"), F.col("var2") / F.col("n2")
    error = F.nullif(e1 + e2, F.lit(0.0))
    t = F.when(enough, (F.col("mean1") - F.col("mean2")) / F.sqrt(error))
    df = F.when(enough, error * error / (e1 * e1 / (F.col("n1") - 1) + e2 * e2 / (F.col("n2") - 1)))
    out = per_gene.select(
        "gene", "mean1", "mean2", F.log2(F.col("mean2") / F.col("mean1")).alias("log2_fold_change"),
        t.alias("t"), df.alias("df"), (enough & constant).alias("_constant"))
    p = F.when(F.col("_constant"), F.lit(1.0)).when(F.col("t").isNotNull(), welch_p("t", "df"))
    return out.withColumn("p_value", p).drop("_constant")


def two_sided_p():
    """Function from arrays (t, df) to the two-sided p of Student's t, any degrees of freedom.

    Built inside a function so that it travels to the executors by value.
    """
    from math import lgamma

    def beta_fraction(a, b, x):
        # continued fraction of the incomplete beta function, whole arrays at a time
        tiny = 1e-300
        keep_off = lambda v: np.where(np.abs(v) < tiny, tiny, v)
        c = np.ones_like(x)
        d = 1.0 / keep_off(1.0 - (a + b) * x / (a + 1.0))
        h = d
        for m in range(1, 10_000):
            for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                         -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1.0 / keep_off(1.0 + step * d)
                c = keep_off(1.0 + step / c)
                h = h * d * c
            done = np.abs(d * c - 1.0) < 1e-14
            if np.all(done | ~np.isfinite(h)):
                return h
        raise ArithmeticError("the continued fraction did not converge")

    def p_value(t, df):
        a, b = df / 2.0, np.full_like(df, 0.5)
        x = df / (df + t * t)
        lg = np.vectorize(lgamma, otypes=[float])
        with np.errstate(divide="ignore", invalid="ignore"):
            front = np.exp(lg(a + b) - lg(a) - lg(b) + a * np.log(x) + b * np.log1p(-x))
            far = x >= (a + 1.0) / (a + b + 2.0)  # there the fraction converges for the other end
            own, other = np.where(far, b, a), np.where(far, a, b)
            part = front * beta_fraction(own, other, np.where(far, 1.0 - x, x)) / own
        p = np.where(far, 1.0 - part, part)
        return np.where(t == 0, 1.0, np.where(x <= 0, 0.0, p))

    return p_value


def welch_p(t, df):
    """Column of p values, computed on Arrow batches."""
    p_value = two_sided_p()

    def batch(t: pd.Series, df: pd.Series) -> pd.Series:
        values, freedom = t.to_numpy(float), df.to_numpy(float)
        known = np.isfinite(values) & np.isfinite(freedom)
        out = np.full(len(values), np.nan)
        if known.any():
            out[known] = p_value(values[known], freedom[known])
        return pd.Series(out).where(known, None)

    batch.__annotations__ = {"t": pd.Series, "df": pd.Series, "return": pd.Series}
    return F.pandas_udf(batch, T.DoubleType())(t, df)


def significant(table: DataFrame, p: float = 0.05, fold: float = 1.0, value: str = "p_value") -> DataFrame:
    """Genes beyond the fold and below p, with direction and the size of (fold, log10 p)."""
    change = F.col("log2_fold_change")
    return table.where((F.abs(change) > fold) & (F.col(value) < p)).withColumns(
        {"direction": F.when(change > 0, "up").otherwise("down"),
         "magnitude": magnitude(change, F.log10(value))})


def top_per_direction(table: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` genes of largest magnitude per direction."""
    parts = [ordering.top_n(table.where(F.col("direction") == d), n, [F.desc("magnitude"), F.asc("gene")])
             for d in ("up", "down")]
    return parts[0].unionByName(parts[1])


def replicate_spearman(long: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Mean rank correlation over all replicate pairs of each group, expressed genes only."""
    kept = long.join(expressed_genes(long), "gene", "left_semi")
    ranked = ordering.average_rank(kept, ["sample"], "value", "rank")
    samples = sorted({s for names in groups.values() for s in names})
    wide = checkpointed(widen(ranked, ["gene"], "sample", "rank", samples))
    pairs = sample_correlation(wide, samples).where("sample_a < sample_b")
    members = long.sparkSession.createDataFrame([(g, s) for g, names in groups.items() for s in names], "group string, sample string")
    first, second = (members.select("group", F.col("sample").alias(f"sample_{x}")) for x in "ab")
    return pairs.join(first, "sample_a").join(second, ["group", "sample_b"]).groupBy("group").agg(
        F.avg("r").alias("spearman"))


#: Tasks that add up the moment matrices of all partitions.
MERGERS = 16


def _moments(size: int, centre: np.ndarray):
    """Functions over Arrow batches: rows of values to one moment matrix per partition, matrices to their sum, and that to
    (i, j, n, x, y, xx, yy, xy) rows of the pairs i <= j."""
    shape = (4, size, size)

    def packed(total):
        yield pa.record_batch([pa.array([total.tobytes()], pa.large_binary())], ["m"])

    def count(batches):
        total = np.zeros(shape)
        for batch in batches:
            cells = batch.column(0)
            known = cells.values.is_valid().to_numpy(zero_copy_only=False).reshape(-1, size).astype(float)
            x = cells.values.to_numpy(zero_copy_only=False).reshape(-1, size) - centre
            x = np.where(known > 0, x, 0.0)
            for k, (left, right) in enumerate(((known, known), (x, known), (x * x, known), (x, x))):
                total[k] += left.T @ right
        return packed(total)

    def merge(batches):
        total = np.zeros(shape)
        for batch in batches:
            for m in batch.column(0):
                total += np.frombuffer(m.as_buffer(), float).reshape(shape)
        return packed(total)

    def pairs(batches):
        for batch in merge(batches):
            n, x, xx, xy = np.frombuffer(batch.column(0)[0].as_buffer(), float).reshape(shape)
            i, j = np.triu_indices(size)
            columns = (i, j, n[i, j], x[i, j], x[j, i], xx[i, j], xx[j, i], xy[i, j])
            yield pa.record_batch([pa.array(c) for c in columns], ["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    return count, merge, pairs


def sample_correlation(matrix: DataFrame, samples: list[str]) -> DataFrame:
    """Pearson r and 1 - r of all sample pairs over the rows that have both; NULL where a sample does not vary.

    A partition adds up one matrix of moments about the column means, a few
    tasks add those up, and each pair's r comes from the sums. The plan does
    not grow with the number of samples, the means are one number per sample.
    """
    cells = matrix.select(F.array(*[F.col(s).cast("double") for s in samples]).alias("v"))
    means = cells.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("mean")).collect()
    centre = np.zeros(len(samples))
    for row in means:
        centre[row["i"]] = row["mean"] or 0.0
    count, merge, pairs = _moments(len(samples), centre)
    sums = "i long, j long, n double, x double, y double, xx double, yy double, xy double"
    parts = cells.mapInArrow(count, "m binary").repartition(MERGERS).mapInArrow(pairs, sums)
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    spread = lambda a, aa: F.col("n") * F.col(aa) - F.col(a) * F.col(a)
    scale = F.sqrt(spread("x", "xx") * spread("y", "yy"))
    # a sample that does not vary leaves rounding only
    varies = (spread("x", "xx") > 1e-12 * F.col("n") * F.col("xx")) & (spread("y", "yy") > 1e-12 * F.col("n") * F.col("yy"))
    r = F.when(varies, (F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / scale)
    names = F.array(*[F.lit(s) for s in samples])
    rows = total.select(F.get(names, F.col("i").cast("int")).alias("sample_a"), F.get(names, F.col("j").cast("int")).alias("sample_b"), r.alias("r"))
    return rows.withColumn("distance", 1 - F.col("r"))


def spike_offsets(long: DataFrame, controls: DataFrame, pseudo: float = 0.1) -> DataFrame:
    """Per sample: mean log2 of the control genes minus the mean over all samples."""
    control_rows = long.join(controls.select("gene"), "gene", "left_semi")
    per_sample = control_rows.groupBy("sample").agg(F.avg(F.log2(F.col("value") + pseudo)).alias("_mean"))
    grand = per_sample.agg(F.avg("_mean")).scalar()
    return per_sample.select("sample", (F.col("_mean") - grand).alias("offset"))


def spike_normalised(long: DataFrame, controls: DataFrame, pseudo: float = 0.1) -> DataFrame:
    """Values scaled so that control genes agree between samples, floored again."""
    offsets = spike_offsets(long, controls, pseudo)
    scaled = (F.col("value") + pseudo) / F.pow(F.lit(2.0), F.col("offset"))
    return long.join(offsets, "sample").withColumn("value", expression_floor(scaled)).drop("offset")


def spike_table(long: DataFrame, controls: DataFrame, concentrations: DataFrame, width: int = 10) -> DataFrame:
    """Control genes above 0 in all samples, with the concentration listed for their first ``width`` characters."""
    rows = long.join(controls.select("gene"), "gene", "left_semi")
    detected = rows.join(_extremes(long).where("_min > 0"), "gene", "left_semi")
    listed = concentrations.select(F.col("control_id").alias("_key"), "concentration")
    return detected.withColumn("_key", F.substring("gene", 1, width)).join(listed, "_key").drop("_key")


def first_per_gene(rows: DataFrame, order: list, gene: str = "gene") -> DataFrame:
    """First instance of every gene; a missing gene becomes ``GENE_NA``."""
    named = rows.withColumn(gene, F.coalesce(gene, F.lit("GENE_NA")))
    return ordering.keep_first(named, [gene], order)


def first_of_gene(rows: DataFrame) -> DataFrame:
    """Of rows with gene_id, ``mean`` and ``row`` the one of highest mean per gene; ties keep the first row."""
    return ordering.keep_first(rows, ["gene_id"], [-F.col("mean"), F.col("row")])


def best_rows(expression: DataFrame, annotation: DataFrame, samples: list[str]) -> DataFrame:
    """Per gene the probe with the highest mean, with its ``row``."""
    total = sum([F.col(s) for s in samples[1:]], F.col(samples[0]))
    return first_of_gene(expression.withColumn("mean", total / len(samples)).join(annotation, "probe"))


def best_probe(expression: DataFrame, annotation: DataFrame, samples: list[str]) -> DataFrame:
    """Per gene the probe with the highest mean; ties keep the first probe.

    ``expression`` holds (probe, row, samples..), ``annotation`` (probe, gene_id).
    """
    return best_rows(expression, annotation, samples).drop("row")


def value_limits(long: DataFrame, low: float = 0.005, high: float = 0.995) -> DataFrame:
    """Axis limits: outer quantiles of the values, the lower one at least 0.5."""
    limits = ordering.quantiles(long, [], "value", {"low": low, "high": high})
    return limits.select(F.greatest("low", F.lit(0.5)).alias("axis_min"), F.col("high").alias("axis_max"))


def row_sample(df: DataFrame, n: int = 1000, seed: int = 7, by: list[str] | None = None) -> DataFrame:
    """The ``n`` rows whose ``by`` columns (all, if not given) have the lowest seeded hash: a random sample that does
    not depend on how the rows are stored. A task keeps its own ``n`` lowest, so nothing larger is ever sorted."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by or df.columns]
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), *names))
    return df.orderBy(place, *(by or df.columns)).limit(n)
