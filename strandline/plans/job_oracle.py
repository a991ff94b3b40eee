"""SQL of the composite jobs, over the tables of :mod:`strandline.plans.oracle`."""

from __future__ import annotations

import re

from strandline.plans.oracle import (_MEET, _TIES, ORACLE, TABLES, _cutoff, _lists, _merge, _nearest, _pairs,
                                     _pieces, _unique)



def _signal_map(prefix: str, sized: str, files: dict[int, str]) -> None:
    """Register ``<prefix>_dens`` (id, file_key, signal) and ``<prefix>_map``: a column per file over the regions ``sized``."""
    TABLES[f"{prefix}_dens"] = f"""
SELECT t.id, t.chrom, t.s, t.e, f.file_key, round(coalesce(c.n, 0) / (t.e - t.s) / (f.mapped / 1e6::DOUBLE), 4) * (t.e - t.s) AS signal
FROM {sized} t JOIN file_chroms h ON h.chrom = t.chrom AND t.e <= h.length JOIN files f ON f.file_key = h.file_key
LEFT JOIN (SELECT r.file_key, g.id, sum(least(r.e, g.e) - greatest(r.s, g.s)) AS n FROM reads r
  JOIN {sized} g ON r.chrom = g.chrom AND r.s < g.e AND r.e > g.s GROUP BY 1, 2) c ON c.file_key = f.file_key AND c.id = t.id"""
    cells = ", ".join(f"coalesce(d.{name}, 0.0) AS {name}" for name in files.values())
    sums = ", ".join(f"sum(b.signal) FILTER (WHERE b.file_key = {k}) AS {name}" for k, name in files.items())
    TABLES[f"{prefix}_map"] = f"""
SELECT t.*, {cells} FROM {sized} t LEFT JOIN (SELECT a.id, {sums} FROM {sized} a JOIN {prefix}_dens b ON {_MEET} GROUP BY 1) d USING (id)"""


def _sized(merged: str, originals: str) -> str:
    return f"""
SELECT t.*, CAST(coalesce(c.n, 0) AS BIGINT) AS constituent_size FROM {merged} t LEFT JOIN (
  SELECT a.id, sum(b.e - b.s + 1) AS n FROM {merged} a JOIN {originals} b ON {_MEET} GROUP BY 1) c ON c.id = t.id"""


_THREE = {1: "file1", 2: "file2", 3: "file3"}

ORACLE["job_region_counting"] = f"""
SELECT id AS "GENE_ID", chrom || '(' || strand || '):' || "start" || '-' || "end" AS "locusLine",
  {", ".join(f"max(d) FILTER (WHERE file_key = {k}) AS bin_1_file{k}" for k in _THREE)}
FROM (SELECT c.*, round(c.count / (c."end" - c."start") / (f.mapped / 1e6::DOUBLE), 4) AS d
  FROM ({ORACLE["append_region_counts"]}) c JOIN files f USING (file_key)) GROUP BY 1, 2"""

# --- ranking with all filters
TABLES["er_kept"] = f"""
SELECT * FROM peaks a WHERE chrom IN ({ORACLE["chrom_consensus"]})
  AND NOT EXISTS (SELECT 1 FROM regions b WHERE b.status = 'P' AND {_MEET})
  AND NOT EXISTS (SELECT 1 FROM genes b WHERE a.chrom = b.chrom AND b.tss - 1000 <= a.s AND a.e <= b.tss + 1000)"""
TABLES["er_unique"] = _unique("er_kept")
TABLES["er_merged"] = _merge("er_unique", "500")
TABLES["er_crowded"] = """
SELECT a.id, a.chrom, a.s, a.e, a.strand FROM er_merged a JOIN genes b ON a.chrom = b.chrom AND a.s <= b.tss + 50 AND b.tss - 50 <= a.e
GROUP BY ALL HAVING count(DISTINCT b.name) > 2"""
TABLES["er_unstitched"] = f"""
SELECT min(id) AS id, chrom, s, e, strand, arg_min(num_loci, id) AS num_loci FROM (
  SELECT id, chrom, s, e, strand, num_loci FROM er_merged a WHERE NOT EXISTS (SELECT 1 FROM er_crowded c WHERE c.id = a.id)
  UNION ALL SELECT DISTINCT b.id, b.chrom, b.s, b.e, b.strand, CAST(1 AS BIGINT) FROM er_crowded a JOIN er_unique b ON {_MEET})
GROUP BY chrom, s, e, strand"""
TABLES["er_sized"] = _sized("er_unstitched", "upeaks")
_signal_map("er", "er_sized", _THREE)
TABLES["er_signal"] = "SELECT *, greatest(0.0::DOUBLE, file1 - file3) AS signal FROM er_map"
ORACLE["job_enhancer_ranking"] = f"""
SELECT id, num_loci, constituent_size, round(signal, 4) AS signal, round(m, 4) AS magnitude,
  row_number() OVER (ORDER BY m DESC, {_TIES}) AS enhancer_rank, CAST(signal > {_cutoff('signal', 'er_signal')} AS INTEGER) AS is_super,
  CAST(signal > {_cutoff('signal', 'er_signal')} AND constituent_size > {_cutoff('constituent_size', 'er_signal')} AS INTEGER) AS is_super_stretch
FROM (SELECT *, sqrt(x * x + y * y) AS m FROM (SELECT *, constituent_size / (SELECT max(constituent_size) FROM er_signal) AS x,
  signal / (SELECT max(signal) FROM er_signal) AS y FROM er_signal))"""

# --- replicates
TABLES["rr_union"] = _unique("regions", "status IN ('F', 'O')")[1:-1]
TABLES["rr_once"] = _merge("rr_union", "1")
TABLES["rr_merged"] = _merge("rr_once", "500")
TABLES["rr_sized"] = _sized("rr_merged", "rr_once")
_signal_map("rr", "rr_sized", _THREE)
TABLES["rr_signal"] = "SELECT *, (greatest(0.0, file1 - file3) + greatest(0.0, file2 - file3)) / 2 AS signal FROM rr_map"
ORACLE["job_replicate_ranking"] = f"""
SELECT id, constituent_size, round(signal, 6) AS signal, row_number() OVER (ORDER BY signal DESC, {_TIES}) AS enhancer_rank,
  CAST(signal > {_cutoff('signal', 'rr_signal')} AS INTEGER) AS is_super FROM rr_signal"""

# --- two conditions
_TWO = {1: "one", 2: "two"}
for _prefix, _peaks, _name in (("da", "peaks", "one"), ("db", "open_peaks", "two")):
    TABLES[f"{_prefix}_unique"] = _unique(_peaks)[1:-1]
    TABLES[f"{_prefix}_merged"] = _merge(f"{_prefix}_unique", "500")
    _signal_map(_prefix, f"{_prefix}_merged", _TWO)
    TABLES[f"{_prefix}_ranked"] = f"""
SELECT id, chrom, s, e, greatest(v, 1.0) AS signal, row_number() OVER (ORDER BY v DESC, {_TIES}) AS enhancer_rank
FROM (SELECT *, greatest(0.0::DOUBLE, {_name}) AS v FROM {_prefix}_map)"""
TABLES["dd_union"] = """
SELECT chrom, s, e, '.' AS strand, min(id) AS id FROM (SELECT chrom, s, e, 'one_' || id AS id FROM da_ranked
  UNION ALL SELECT chrom, s, e, 'two_' || id FROM db_ranked) GROUP BY 1, 2, 3"""
TABLES["dd_flagged"] = f"""
SELECT a.*, EXISTS (SELECT 1 FROM da_ranked b WHERE {_MEET}) AND EXISTS (SELECT 1 FROM db_ranked b WHERE {_MEET}) AS shared
FROM ({_merge('dd_union', '1')}) a"""
TABLES["dd_merged"] = """
SELECT * EXCLUDE (id, shared), CASE WHEN shared THEN 'CONSERVED_' || row_number() OVER (PARTITION BY shared ORDER BY chrom, s, e, strand)
  ELSE substr(id, 3) END AS id FROM dd_flagged"""
_signal_map("dd", "dd_merged", _TWO)
TABLES["dd_delta"] = """
SELECT *, greatest(-8.0::DOUBLE, least(8.0::DOUBLE, log2((greatest(two, 1.0) / (SELECT median(signal) FROM db_ranked))
  / (greatest(one, 1.0) / (SELECT median(signal) FROM da_ranked))))) AS change FROM dd_map"""
TABLES["dd_pairs"] = f"SELECT p.*, g.name FROM ({_pairs('dd_merged', 5000)}) p JOIN genes g ON g.id = p.gene_id"


def _best_rank(ranked: str) -> str:
    return f"coalesce((SELECT min(b.enhancer_rank) FROM {ranked} b WHERE {_MEET}), (SELECT count(*) FROM {ranked}))"


ORACLE["job_dynamic_enhancers"] = f"""
SELECT replace(a.id, '_lociStitched', '') AS id, round(change, 6) AS log2_change,
  row_number() OVER (ORDER BY change DESC, a.chrom, a.s, a.e, a.id) AS rank,
  CASE WHEN change > 1 THEN 'two' WHEN change < -1 THEN 'one' ELSE 'CONSERVED' END AS status,
  {_best_rank('da_ranked')} AS rank_1, {_best_rank('db_ranked')} AS rank_2, coalesce(overlap_genes, '') AS overlap_genes,
  coalesce(proximal_genes, '') AS proximal_genes, coalesce(closest_gene, '') AS closest_gene
FROM dd_delta a LEFT JOIN ({_lists('dd_pairs')}) l ON l.id = a.id LEFT JOIN ({_nearest('dd_merged', 5000)}) n ON n.id = a.id"""

# --- many samples
TABLES["cc_wide"] = "SELECT id, chrom, s - 300 AS s, e + 300 AS e, strand FROM regions WHERE status IN ('F', 'O')"
TABLES["cc_unique"] = _unique("cc_wide")[1:-1]
TABLES["cc_merged"] = _merge("cc_unique", "1")
_signal_map("cc", "cc_merged", {1: "a", 2: "b", 3: "c"})
TABLES["cc_scaled"] = "SELECT " + ", ".join(
    f"greatest(0.0, {x}) / nullif((SELECT median({x}) FROM cc_map), 0.0) AS {x}" for x in "abc") + " FROM cc_map"
ORACLE["job_consensus_clusters"] = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS sample_a, '{b}' AS sample_b, round(corr({a}, {b}), 6) AS r, round(1 - corr({a}, {b}), 6) + 0 AS distance FROM cc_scaled"
    for i, a in enumerate("abc") for b in "abc"[i:])

TABLES["hy_genes"] = re.sub(r"\b1000\b", "5000", TABLES["pgenes"])
TABLES["hy_signal"] = TABLES["gsignal"].replace("pgenes", "hy_genes")
ORACLE["job_hyper_occupancy"] = """
SELECT name, gene_id, proximal_events, total_signal, promoter_regions, distal_signal FROM hy_signal
QUALIFY row_number() OVER (PARTITION BY name ORDER BY total_signal DESC, gene_id) = 1"""
ORACLE["job_occupancy"] = 'SELECT id, "F", "O", "P" FROM occupied WHERE ("F" = 1 AND "P" = 1) OR ("O" = 1 AND "P" = 1)'

# --- screen and expression
ORACLE["job_guide_screen"] = """
SELECT guide, gene, round(ratio, 6) AS log2_ratio, 1 AS hairpin_weight FROM folds
WHERE gene IN (SELECT gene FROM folds GROUP BY 1 HAVING count(*) > 1)"""
TABLES["xr_values"] = """
SELECT sample, gene, CASE WHEN v < 0.01 AND v > 0 THEN 0.01 ELSE greatest(v, 0) END AS value
FROM (SELECT sample, gene, (value + 0.1) / pow(2.0::DOUBLE, o) AS v FROM expr JOIN offsets USING (sample))"""
ORACLE["job_expression_report"] = """
SELECT gene, round(avg(value) FILTER (WHERE sample LIKE 'A%'), 4) AS mean1, round(avg(value) FILTER (WHERE sample LIKE 'R%'), 4) AS mean2,
  round(log2(avg(value) FILTER (WHERE sample LIKE 'R%') / avg(value) FILTER (WHERE sample LIKE 'A%')), 4) AS log2_fold_change,
  round(avg(value) FILTER (WHERE contains(sample, 'N')), 4) AS mean_n
FROM xr_values GROUP BY 1 HAVING max(value) > 1 AND min(value) > 0 AND count(*) = (SELECT count(DISTINCT sample) FROM expr)"""
ORACLE["job_probe_genes"] = """
SELECT gene_id, name, "A_F", "A_O", "N_F", "N_O", "R_F", "R_O" FROM (
  SELECT m.gene_id, w.*, ("A_F" + "A_O" + "N_F" + "N_O" + "R_F" + "R_O") / 6 AS mean, CAST(substr(gene, 2) AS BIGINT) AS k FROM expr_wide w JOIN (
    SELECT 'g' || CAST(p_partkey AS VARCHAR) AS gene, 'NM_' || CAST(p_partkey AS VARCHAR) AS gene_id FROM part WHERE p_partkey % 2 = 0 UNION ALL
    SELECT 'g' || CAST(p_partkey AS VARCHAR), g.id FROM part JOIN genes g ON g.name = p_name WHERE p_partkey % 2 = 1) m USING (gene))
JOIN (SELECT id, name FROM genes) ON id = gene_id
QUALIFY row_number() OVER (PARTITION BY gene_id ORDER BY mean DESC, k) = 1"""
ORACLE["job_heatmap"] = """
SELECT gene AS id, round(m, 6) AS mean_signal, row_number() OVER (ORDER BY m DESC, gene) AS row_order, low, high
FROM (SELECT gene, (greatest(0.0, "A_F" - "R_F") + greatest(0.0, "N_O" - "R_O")) / 2 AS m FROM expr_wide),
  (SELECT round(quantile_cont(v, 0.6), 6) AS low, round(quantile_cont(v, 0.95), 6) AS high
   FROM (UNPIVOT (SELECT "A_F", "N_O" FROM expr_wide) ON "A_F", "N_O" INTO NAME sample VALUE v))"""

# --- tracks
TABLES["lt_regions"] = "SELECT * FROM peaks WHERE e - s > 300"


def _track(kind: str, features: str) -> str:
    return f"""
SELECT '{kind}' AS kind, id, track, round(abs(b0 - ref) * f, 4) AS place, round(abs(b1 - ref) * f, 4) AS value
FROM (SELECT a.id, b.id AS track, b.s AS b0, b.e AS b1, CASE a.strand WHEN '-' THEN a.e ELSE a.s END AS ref,
  20.0::DOUBLE / (a.e - a.s + 1) AS f FROM lt_regions a JOIN {features} b ON {_MEET})"""


ORACLE["job_locus_tracks"] = f"""
SELECT 'signal' AS kind, id, CAST(file_key AS VARCHAR) AS track, CAST(bin AS DOUBLE) AS place, density AS value
FROM ({_pieces("SELECT * FROM lt_regions", "20", "(e - s + 1) // 20", "true")})
UNION ALL {_track('genes', 'tx')} UNION ALL {_track('beds', 'open_peaks')}"""
