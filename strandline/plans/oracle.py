"""Independent SQL for the queries, over plain inequality joins and windows."""

from __future__ import annotations

import re

TABLES: dict[str, str] = {}
ORACLE: dict[str, str] = {}

TABLES["reads"] = """
SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS file_key,
  CASE WHEN l_returnflag IN ('A', 'N') THEN 'ct1' ELSE 'ct2' END AS cell_type,
  'chr' || CAST(l_suppkey % 22 + 1 AS VARCHAR) AS chrom,
  date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) * 100 + l_linenumber * 10 AS pos,
  date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) * 100 + l_linenumber * 10 AS s,
  date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) * 100 + l_linenumber * 10
    + CAST(l_quantity AS BIGINT) + CASE WHEN l_linenumber = 7 AND l_quantity > 1 THEN 100 ELSE 0 END AS e,
  CASE WHEN l_linestatus = 'F' THEN '-' ELSE '+' END AS strand,
  CAST(l_quantity AS BIGINT) AS seq_len,
  l_linenumber = 7 AND l_quantity > 1 AS spliced,
  CAST(l_partkey AS VARCHAR) AS seq
FROM lineitem"""
TABLES["chrom_sizes"] = """
SELECT DISTINCT 'chr' || CAST(c_custkey % 22 + 1 AS VARCHAR) AS chrom, CAST(260000 AS BIGINT) AS length FROM customer"""
TABLES["file_chroms"] = """
SELECT r.file_key, r.cell_type, r.chrom, c.length, count(*) AS mapped
FROM reads r JOIN chrom_sizes c ON r.chrom = c.chrom GROUP BY ALL"""
TABLES["files"] = "SELECT file_key, cell_type, count(*) AS mapped FROM reads GROUP BY ALL"
TABLES["regions"] = """
SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS id, 'chr' || CAST(o_custkey % 22 + 1 AS VARCHAR) AS chrom,
  date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 100 + o_orderkey % 100 AS s,
  date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 100 + o_orderkey % 100 + 50 + o_orderkey % 400 AS e,
  CASE o_orderkey % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END AS strand,
  o_orderstatus AS status, CAST(floor(o_totalprice) AS BIGINT) AS signal
FROM orders"""
TABLES["peaks"] = "SELECT * FROM regions WHERE status = 'F'"
TABLES["open_peaks"] = "SELECT * FROM regions WHERE status = 'O'"
TABLES["genes"] = """
SELECT id, name, chrom, strand, txs, txe, row_no, CASE strand WHEN '-' THEN txe ELSE txs END AS tss,
  CASE strand WHEN '-' THEN txs ELSE txe END AS tts
FROM (SELECT 'NM_' || CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
  'chr' || CAST(p_partkey % 22 + 1 AS VARCHAR) AS chrom, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
  ((p_partkey * 7919) % 2400) * 100 AS txs, ((p_partkey * 7919) % 2400) * 100 + 200 + p_size * 50 AS txe,
  p_partkey AS row_no FROM part)"""
TABLES["tx"] = """
SELECT chrom, txs AS s, txe AS e, strand, min(id) AS id, arg_min(name, id) AS name
FROM genes GROUP BY chrom, txs, txe, strand"""
TABLES["tss"] = "SELECT chrom, tss, strand, min(id) AS id, arg_min(name, id) AS name FROM genes GROUP BY chrom, tss, strand"
TABLES["samples"] = """
SELECT '/data/' || CAST(s_suppkey AS VARCHAR) || '.bam' AS file_path,
  CASE WHEN s_suppkey % 5 = 0 THEN 'wce_' ELSE 'S' END || CAST(s_suppkey AS VARCHAR) AS name,
  CASE WHEN s_suppkey % 5 = 0 THEN 'NONE' ELSE 'wce_' || CAST(s_suppkey // 5 * 5 AS VARCHAR) END AS background,
  CASE WHEN s_nationkey % 2 = 0 THEN 'peaks' || CAST(s_suppkey AS VARCHAR) ELSE 'NONE' END AS enriched_macs
FROM supplier"""
TABLES["expr"] = """
SELECT 'g' || CAST(l_partkey AS VARCHAR) AS gene, l_returnflag || '_' || l_linestatus AS sample,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS value FROM lineitem GROUP BY 1, 2"""
_WIDE = ", ".join(
    f"sum(CASE WHEN l_returnflag || '_' || l_linestatus = '{s}' THEN l_quantity ELSE 0.0 END) AS \"{s}\""
    for s in ("A_F", "A_O", "N_F", "N_O", "R_F", "R_O"))
TABLES["expr_wide"] = f"SELECT 'g' || CAST(l_partkey AS VARCHAR) AS gene, {_WIDE} FROM lineitem GROUP BY 1"
TABLES["scores"] = """
SELECT 'chr' || CAST(user_id % 22 + 1 AS VARCHAR) AS chrom,
  CAST(floor((epoch_us(ts) - 1704067200000000) / 10000000) AS BIGINT) AS s,
  CAST(floor((epoch_us(ts) - 1704067200000000) / 10000000) AS BIGINT) + CAST(ceil(value) AS BIGINT) AS e,
  value AS score FROM events"""

# --- bins
TABLES["bins"] = """
SELECT f.file_key, f.cell_type, f.chrom, CAST(b.n AS INTEGER) AS bin_number
FROM file_chroms f, range(0, 52) b(n)"""
TABLES["counts"] = """
SELECT b.file_key, b.cell_type, b.chrom, b.bin_number, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM bins b LEFT JOIN (
  SELECT r.file_key, r.chrom, g.n AS bin_number,
    sum(least(r.e, (g.n + 1) * 5000) - greatest(r.s, g.n * 5000)) AS n
  FROM reads r JOIN range(0, 52) g(n) ON r.s < (g.n + 1) * 5000 AND r.e > g.n * 5000
  GROUP BY 1, 2, 3) c USING (file_key, chrom, bin_number)"""
TABLES["normed"] = """
SELECT c.*, c.count * ((1.0::DOUBLE / 5000) * (1.0::DOUBLE / (f.mapped / 1e6::DOUBLE))) AS value
FROM counts c JOIN files f USING (file_key)"""
TABLES["line_pct"] = """
SELECT bin_number, cell_type, chrom, file_key, value,
  (rank() OVER (PARTITION BY cell_type, file_key ORDER BY count)
   + (count(*) OVER (PARTITION BY cell_type, file_key, count) - 1) / 2.0::DOUBLE - 1)
  / (count(*) OVER (PARTITION BY cell_type, file_key) - 1) * 100 AS percentile
FROM normed"""
TABLES["ct_avg"] = """
SELECT cell_type, chrom, bin_number, CAST(0 AS INTEGER) AS file_key, value, (rank() OVER (PARTITION BY cell_type ORDER BY digits)
   + (count(*) OVER (PARTITION BY cell_type, digits) - 1) / 2.0::DOUBLE - 1)
  / (count(*) OVER (PARTITION BY cell_type) - 1) * 100 AS percentile
FROM (SELECT *, CAST(printf('%.11e', value) AS DOUBLE) AS digits
  FROM (SELECT n.cell_type, n.chrom, n.bin_number, sum(n.value) / any_value(k.files) AS value
    FROM normed n JOIN (SELECT cell_type, count(*) AS files FROM files GROUP BY 1) k USING (cell_type)
    GROUP BY 1, 2, 3))"""
TABLES["all_pct"] = """
SELECT bin_number, cell_type, chrom, file_key, value, percentile FROM line_pct
UNION ALL SELECT bin_number, cell_type, chrom, file_key, value, percentile FROM ct_avg"""


def _tally(kind: str, test: str) -> str:
    side = "file_key = 0" if kind == "cell_types" else "file_key <> 0"
    name = {">= 95": "gte_95th", "< 95": "lt_95th", ">= 5": "gte_5th", "< 5": "lt_5th"}[test]
    return f"count(*) FILTER (WHERE {side} AND percentile {test}) AS {kind}_{name}_percentile"


TABLES["summary"] = f"""
SELECT bin_number, chrom, sum(percentile) FILTER (WHERE file_key = 0) / count(DISTINCT cell_type) AS avg_cell_type_percentile,
  {", ".join(_tally(k, t) for k in ("cell_types", "lines") for t in (">= 95", "< 95", ">= 5", "< 5"))}
FROM all_pct GROUP BY bin_number, chrom"""

ORACLE["bin_counts"] = "SELECT * FROM counts"
ORACLE["bin_counts_extended"] = """
SELECT b.file_key, b.cell_type, b.chrom, b.bin_number, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM bins b LEFT JOIN (
  SELECT r.file_key, r.chrom, g.n AS bin_number,
    sum(greatest(0, least(r.e + CASE strand WHEN '+' THEN 200 ELSE 0 END, (g.n + 1) * 5000)
      - greatest(greatest(0, r.s - CASE strand WHEN '-' THEN 200 ELSE 0 END), g.n * 5000))) AS n
  FROM reads r JOIN range(0, 52) g(n) ON r.s < (g.n + 1) * 5000 AND r.e >= g.n * 5000
  GROUP BY 1, 2, 3) c USING (file_key, chrom, bin_number)"""
ORACLE["bin_normalized"] = """
SELECT file_key, cell_type, chrom, bin_number, count, round(value, 6) AS value FROM normed"""
ORACLE["bin_percentile"] = """
SELECT bin_number, cell_type, chrom, file_key, round(value, 6) AS value, round(percentile, 6) AS percentile FROM line_pct"""
ORACLE["bin_celltype_avg"] = ORACLE["bin_percentile"].replace("line_pct", "ct_avg")
ORACLE["bin_summary"] = """
SELECT * REPLACE (round(avg_cell_type_percentile, 6) AS avg_cell_type_percentile) FROM summary"""
ORACLE["sorted_summary"] = ORACLE["bin_summary"]
ORACLE["summary_validate"] = """
SELECT count(*) AS n_bins, count(*) FILTER (WHERE
  cell_types_gte_95th_percentile + cell_types_lt_95th_percentile <> t OR
  cell_types_gte_5th_percentile + cell_types_lt_5th_percentile <> t OR
  lines_gte_95th_percentile + lines_lt_95th_percentile <> f OR
  lines_gte_5th_percentile + lines_lt_5th_percentile <> f) AS violations
FROM summary, (SELECT count(DISTINCT cell_type) AS t, count(DISTINCT file_key) AS f FROM files)"""
ORACLE["append_counts"] = ORACLE["bin_counts"]
ORACLE["append_counts_extended"] = ORACLE["bin_counts_extended"]
ORACLE["append_summary"] = ORACLE["bin_summary"]

# --- region counts
TABLES["region_files"] = """
SELECT g.*, f.file_key FROM regions g JOIN file_chroms f ON g.chrom = f.chrom AND g.e <= f.length"""


def _region_counts(strand: str) -> str:
    return f"""
SELECT g.file_key, g.id, g.chrom, g.s, g.e, g.strand, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM region_files g LEFT JOIN (
  SELECT r.file_key, g.id, sum(least(r.e, g.e) - greatest(r.s, g.s)) AS n
  FROM reads r JOIN regions g ON r.chrom = g.chrom AND r.s < g.e AND r.e > g.s AND ({strand}) GROUP BY 1, 2) c
USING (file_key, id)"""


TABLES["rcounts"] = _region_counts("true")
_LOCUS = 'chrom, s AS "start", e AS "end", strand'
_COUNTS = f'SELECT file_key, id, {_LOCUS}, n AS count FROM '
ORACLE["region_counts"] = _COUNTS + "rcounts"
ORACLE["store_region"] = f"""
SELECT file_key, {_LOCUS}, count(*) AS n FROM reads WHERE chrom = 'chr3' AND s < 101000 AND e >= 100000 GROUP BY ALL"""
ORACLE["store_counts"] = _COUNTS + "rcounts WHERE id IN (SELECT id FROM peaks)"
ORACLE["region_counts_sense"] = _COUNTS + f"({_region_counts('g.strand IN (r.strand, chr(46))')})"
ORACLE["region_counts_antisense"] = _COUNTS + f"({_region_counts('g.strand <> r.strand')})"
TABLES["rdens"] = """
SELECT c.*, c.n / (c.e - c.s) / (f.mapped / 1e6::DOUBLE) AS density FROM rcounts c JOIN files f USING (file_key)"""
ORACLE["region_density"] = f"SELECT file_key, id, {_LOCUS}, n AS count, round(density, 6) AS density FROM rdens"
ORACLE["region_matrix"] = """
SELECT id AS "GENE_ID", chrom || '(' || strand || '):' || s || '-' || e AS "locusLine",
  max(round(density, 4)) FILTER (WHERE file_key = 1) AS bin_1_file1,
  max(round(density, 4)) FILTER (WHERE file_key = 2) AS bin_1_file2,
  max(round(density, 4)) FILTER (WHERE file_key = 3) AS bin_1_file3
FROM rdens GROUP BY 1, 2"""
ORACLE["region_pieces"] = """
SELECT p.id, p.k AS piece, CAST(sum(least(r.e, p.s + (p.k + 1) * p.w) - greatest(r.s, p.s + p.k * p.w)) AS BIGINT) AS count
FROM (SELECT g.*, (g.e - g.s) // 4 AS w, k.k FROM regions g, range(0, 4) k(k)) p
JOIN reads r ON r.chrom = p.chrom AND r.s < p.s + (p.k + 1) * p.w AND r.e > p.s + p.k * p.w GROUP BY 1, 2"""
TABLES["fetched"] = """
SELECT g.id, g.strand AS g_strand, r.* FROM reads r JOIN regions g ON r.chrom = g.chrom AND r.s < g.e AND r.e >= g.s
WHERE NOT r.spliced"""
ORACLE["append_region_counts"] = f"""
SELECT g.file_key, g.id, g.chrom, g.s AS "start", g.e AS "end", g.strand, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM region_files g LEFT JOIN (
  SELECT r.file_key, g.id, sum(greatest(0, least(r.e + CASE r.strand WHEN '+' THEN 200 ELSE 0 END, g.e)
    - greatest(greatest(0, r.s - CASE r.strand WHEN '-' THEN 200 ELSE 0 END), g.s))) AS n
  FROM reads r JOIN regions g ON r.chrom = g.chrom AND r.s < g.e AND r.e >= g.s AND g.strand IN (r.strand, '.') GROUP BY 1, 2) c
USING (file_key, id)"""
ORACLE["region_read_counts"] = """
SELECT g.id, coalesce(n, 0) AS total, coalesce(k, 0) AS sense, coalesce(n - k, 0) AS antisense
FROM regions g LEFT JOIN (SELECT id, count(*) AS n,
  count(*) FILTER (WHERE strand = CASE g_strand WHEN '.' THEN '+' ELSE g_strand END) AS k FROM fetched GROUP BY 1) USING (id)"""
ORACLE["region_starts"] = """
SELECT id, strand, s + 1 AS read_start, count(*) AS n FROM fetched GROUP BY 1, 2, 3"""
ORACLE["region_starts_text"] = """
SELECT id, '+:' || coalesce(string_agg(CAST(s + 1 AS VARCHAR), ',' ORDER BY s) FILTER (WHERE strand = '+'), '') || ';-:'
  || coalesce(string_agg(CAST(s + 1 AS VARCHAR), ',' ORDER BY s) FILTER (WHERE strand = '-'), '') AS starts FROM fetched GROUP BY 1"""
ORACLE["unique_reads"] = f"""
SELECT id, {_LOCUS}, seq FROM (SELECT *, row_number() OVER (PARTITION BY id, seq ORDER BY s, e, strand) AS k FROM fetched)
WHERE k = 1 AND g_strand IN ('.', strand)"""


def _segments(by: str) -> str:
    return f"""
SELECT * FROM (
  SELECT {by}, pos AS s, lead(pos) OVER w - 1 AS e, CAST(sum(p) OVER w AS BIGINT) AS plus, CAST(sum(m) OVER w AS BIGINT) AS minus
  FROM (SELECT {by}, pos, sum(d) FILTER (WHERE strand = '+') AS p, sum(d) FILTER (WHERE strand = '-') AS m FROM (
      SELECT {by}, strand, s + 1 AS pos, 1 AS d FROM reads WHERE NOT spliced UNION ALL
      SELECT {by}, strand, s + seq_len + 2, -1 FROM reads WHERE NOT spliced)
    GROUP BY {by}, pos HAVING coalesce(sum(d) FILTER (WHERE strand = '+'), 0) <> 0
      OR coalesce(sum(d) FILTER (WHERE strand = '-'), 0) <> 0)
  WINDOW w AS (PARTITION BY {by} ORDER BY pos))
WHERE coalesce(plus, 0) + coalesce(minus, 0) > 0"""


ORACLE["depth_segments"] = f"""
SELECT file_key, chrom, s AS "start", e AS "end", coalesce(plus, 0) AS plus, coalesce(minus, 0) AS minus
FROM ({_segments('file_key, chrom')})"""
TABLES["segments"] = _segments("chrom")
TABLES["deep"] = "SELECT chrom, s, e, coalesce(plus, 0) AS plus, coalesce(minus, 0) AS minus FROM segments WHERE coalesce(plus, 0) + coalesce(minus, 0) > 1"
ORACLE["region_depth"] = """
SELECT id, round(coalesce(a, 0) / (e - s + 1), 4) AS sense_density, round(coalesce(b, 0) / (e - s + 1), 4) AS antisense_density
FROM regions LEFT JOIN (
  SELECT g.id, CAST(sum(n * CASE WHEN strand = '-' THEN minus ELSE plus END) AS DOUBLE) AS a,
    CAST(sum(n * CASE WHEN strand = '-' THEN plus ELSE minus END) AS DOUBLE) AS b
  FROM (SELECT g.id, g.strand, d.plus, d.minus, greatest(0, least(d.e, g.e - 1) - greatest(d.s, g.s + 1) + 1) AS n
    FROM regions g JOIN deep d ON g.chrom = d.chrom AND d.s < g.e AND d.e > g.s) g GROUP BY 1) USING (id)"""
ORACLE["depth_bins"] = """
SELECT p.id, p.k + 1 AS bin, round(CAST(coalesce(sum(greatest(0, least(d.e, p.hi - 1) - greatest(d.s, p.lo + 1) + 1)
    * (d.plus + d.minus)), 0) AS DOUBLE) / any_value(p.w), 4) AS density
FROM (SELECT id, chrom, w, k, CASE WHEN strand = '-' THEN e - (k + 1) * w ELSE s + k * w END AS lo,
    CASE WHEN strand = '-' THEN e - k * w ELSE s + (k + 1) * w END AS hi
  FROM (SELECT g.*, (g.e - g.s) // 4 AS w, CAST(k.k AS INTEGER) AS k FROM regions g, range(0, 4) k(k))) p
LEFT JOIN deep d ON p.chrom = d.chrom AND d.s < p.hi AND d.e > p.lo GROUP BY 1, 2"""


def _pieces(regions: str, number: str, width: str, match: str, extra: str = "") -> str:
    """Densities of pieces 0..n-1 of (id, chrom, s, e, strand)."""
    return f"""
SELECT p.file_key, p.id, {extra} CAST(CASE WHEN p.strand = '-' THEN p.n - p.k ELSE p.k + 1 END AS INTEGER) AS bin,
  round(coalesce(c.total, 0) / nullif(p.width, 0) / p.mmr, 4) AS density
FROM (SELECT g.*, f.file_key, t.mmr, k.k FROM (
    SELECT *, {number} AS n, {width} AS width FROM ({regions})) g
  JOIN file_chroms f ON f.chrom = g.chrom AND g.e <= f.length
  JOIN (SELECT file_key, round(mapped / 1e6::DOUBLE, 4) AS mmr FROM files) t ON t.file_key = f.file_key
  JOIN range(0, 100) k(k) ON k.k < g.n) p
LEFT JOIN (SELECT r.file_key, q.id, {extra.replace('p.', 'q.')} q.k, sum(least(r.e, q.s + (q.k + 1) * q.piece) - greatest(r.s, q.s + q.k * q.piece)) AS total
  FROM (SELECT g.*, (g.e - g.s) // g.n AS piece, k.k FROM (SELECT *, {number} AS n FROM ({regions})) g
    JOIN range(0, 100) k(k) ON k.k < g.n WHERE g.n > 0) q
  JOIN reads r ON r.chrom = q.chrom AND r.s < q.s + (q.k + 1) * q.piece AND r.e > q.s + q.k * q.piece AND ({match})
  GROUP BY ALL) c ON c.file_key = p.file_key AND c.id = p.id AND c.k = p.k {"AND c.kind = p.kind" if extra else ""}"""


_ON, _OFF = "q.strand IN (r.strand, '.')", "q.strand <> r.strand"
ORACLE["clustergram"] = _pieces("SELECT * FROM regions", "(e - s + 1) // 50", "50", "true")
ORACLE["matrix_bins"] = _pieces("SELECT * FROM regions", "10", "(e - s + 1) // 10", _ON)
TABLES["meta"] = """
SELECT id, chrom, strand, 'tss' AS kind, 10 AS bins, 0 AS shift, CASE strand WHEN '+' THEN tss - 3000 ELSE tss END AS s,
  CASE strand WHEN '+' THEN tss ELSE tss + 3000 END AS e FROM genes UNION ALL
SELECT id, chrom, strand, 'txn', 5, 10, txs, txe FROM genes UNION ALL
SELECT id, chrom, strand, 'ttr', 10, 15, CASE strand WHEN '+' THEN tts ELSE tts - 3000 END,
  CASE strand WHEN '+' THEN tts + 3000 ELSE tts END FROM genes"""
TABLES["meta_bins"] = (
    _pieces("SELECT * FROM meta", "bins", "(e - s + 1) // bins", _ON, "p.kind, p.shift,") + "\nUNION ALL\n"
    + _pieces("SELECT * FROM meta", "bins", "(e - s + 1) // bins", _OFF, "p.kind, p.shift,"))
ORACLE["meta_profile"] = """
SELECT file_key, id, bin, round(value, 6) AS value FROM (
  SELECT file_key, id, CAST(bin + shift - 1 AS INTEGER) AS bin, sum(density) AS value,
    count(*) OVER (PARTITION BY file_key, id) AS n
  FROM meta_bins GROUP BY file_key, id, bin, shift) WHERE n = 25"""
ORACLE["conservation_mean"] = """
SELECT g.id, round(coalesce(sum(CASE WHEN c.s < g.s THEN (least(c.e, g.e) - g.s + 1) * c.score
  WHEN c.e > g.e THEN (g.e - greatest(c.s, g.s)) * c.score ELSE (c.e - c.s) * c.score END), 0.0)
  / any_value(g.e - g.s + 1), 9) AS conservation
FROM regions g LEFT JOIN scores c ON g.chrom = c.chrom AND c.s <= g.e AND g.s <= c.e GROUP BY 1"""

# --- interval joins
_MEET = "a.chrom = b.chrom AND a.s <= b.e AND b.s <= a.e"
_SENSE = "(a.strand = b.strand OR a.strand = '.' OR b.strand = '.')"
_ANTI = "(a.strand = translate(b.strand, '+-', '-+') OR a.strand = '.' OR b.strand = '.')"
_PAIR = "SELECT a.id AS a_id, b.id AS b_id FROM "
ORACLE["overlap_join"] = f"{_PAIR} peaks a JOIN open_peaks b ON {_MEET} AND {_SENSE}"
ORACLE["overlap_both"] = f"{_PAIR} peaks a JOIN open_peaks b ON {_MEET}"
ORACLE["overlap_antisense"] = f"{_PAIR} peaks a JOIN open_peaks b ON {_MEET} AND {_ANTI}"
ORACLE["contained_join"] = f"{_PAIR} peaks a JOIN tx b ON a.chrom = b.chrom AND b.s <= a.s AND a.e <= b.e"
ORACLE["containers_join"] = f"{_PAIR} tx a JOIN peaks b ON a.chrom = b.chrom AND a.s <= b.s AND b.e <= a.e AND {_SENSE}"
ORACLE["overlap_semi"] = f"SELECT id FROM peaks a WHERE EXISTS (SELECT 1 FROM open_peaks b WHERE {_MEET} AND {_SENSE})"
ORACLE["mask_anti"] = f"""
SELECT id FROM peaks a WHERE NOT EXISTS (SELECT 1 FROM regions b WHERE b.status = 'P' AND {_MEET})"""
ORACLE["has_locus"] = """
SELECT id FROM regions a WHERE EXISTS (SELECT 1 FROM regions b WHERE a.chrom = b.chrom AND a.strand = b.strand
  AND (b.status <> 'F' AND a.s = b.s AND a.e = b.e OR a.s = b.s + 100 AND a.e = b.e + 100))"""
ORACLE["tss_filter"] = """
SELECT id FROM peaks a WHERE NOT EXISTS (SELECT 1 FROM genes b WHERE a.chrom = b.chrom
  AND b.tss - 1000 <= a.s AND a.e <= b.tss + 1000)"""


# --- stitching
def _islands(source: str, window: str, by: str = "", strand: bool = False) -> str:
    """Members of (by, chrom, s, e, strand, id) with the start of their island."""
    part = f"{by + ', ' if by else ''}chrom{', strand' if strand else ''}"
    return f"""
SELECT *, max(CASE WHEN reach IS NULL OR s > reach + {window} THEN s END) OVER (
  PARTITION BY {part} ORDER BY s, e, strand, id ROWS UNBOUNDED PRECEDING) AS island
FROM (SELECT *, max(e) OVER (PARTITION BY {part} ORDER BY s, e, strand, id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source})"""


def _merge(source: str, window: str, by: str = "", strand: bool = False, extra: str = "") -> str:
    keys = f"{by + ', ' if by else ''}chrom"
    shown = "strand" if strand else "CASE WHEN count(*) = 1 THEN any_value(strand) ELSE '.' END AS strand"
    return f"""
SELECT {keys}, min(s) AS s, max(e) AS e, {shown},
  count(*) || '_' || first(id ORDER BY s, e, strand, id) || '_lociStitched' AS id, count(*) AS num_loci {extra}
FROM ({_islands(source, window, by, strand)}) GROUP BY {keys}, island{', strand' if strand else ''}"""


def _unique(source: str, where: str = "true") -> str:
    return f"(SELECT chrom, s, e, strand, min(id) AS id FROM {source} WHERE {where} GROUP BY chrom, s, e, strand)"


TABLES["upeaks"] = _unique("peaks")
TABLES["stitched"] = _merge("upeaks", "50")
_STITCH = f"SELECT id, {_LOCUS}, num_loci FROM "
ORACLE["stitch"] = _STITCH + "stitched"
ORACLE["stitch_sense"] = _STITCH + f"({_merge(_unique('peaks', chr(115) + 'trand <> chr(46)'), '50', strand=True)})"
TABLES["consolidated"] = _merge("upeaks", "0")
TABLES["steps"] = "SELECT CAST(n AS INTEGER) AS step FROM range(0, 15001, 500) t(n)"
TABLES["swept"] = _merge("(SELECT step, c.* FROM consolidated c, steps)", "step", "step", extra=", sum(e - s + 1) AS constit")
TABLES["sweep"] = """
SELECT step, count(*) AS num_regions, CAST(sum(constit) AS BIGINT) AS total_constit, CAST(sum(e - s + 1) AS BIGINT) AS total_region,
  round(avg(constit), 2) AS mean_constit, round(median(constit), 2) AS median_constit,
  round(avg(e - s + 1), 2) AS mean_region, round(median(e - s + 1), 2) AS median_region,
  round(avg(constit / (e - s + 1)), 2) AS mean_stitch_fraction, round(median(constit / (e - s + 1)), 2) AS median_stitch_fraction
FROM swept GROUP BY step"""
ORACLE["stitch_sweep"] = "SELECT * FROM sweep"
TABLES["drops"] = """
SELECT step, ratio, ratio - lag(ratio) OVER (ORDER BY step) AS drop_ FROM (SELECT step, mean_constit / mean_region AS ratio FROM sweep)"""
ORACLE["stitch_fraction_drop"] = 'SELECT step, round(ratio, 6) AS ratio, round(drop_, 6) AS "drop" FROM drops'
ORACLE["stitch_best_step"] = """
SELECT arg_min(step, (smooth, step)) AS best_step FROM (SELECT step,
  avg(drop_) OVER (ORDER BY step ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS smooth FROM drops WHERE drop_ IS NOT NULL)"""
TABLES["sized"] = """
SELECT t.*, CAST(coalesce(c.n, 0) AS BIGINT) AS constituent_size FROM stitched t LEFT JOIN (
  SELECT a.id, a.chrom, sum(b.e - b.s + 1) AS n FROM stitched a JOIN upeaks b ON a.chrom = b.chrom AND a.s <= b.e AND b.s <= a.e
  GROUP BY 1, 2) c ON c.id = t.id AND c.chrom = t.chrom"""
ORACLE["constituent_size"] = "SELECT id, num_loci, constituent_size FROM sized"
TABLES["stitched500"] = _merge("upeaks", "500")
TABLES["crowded"] = """
SELECT a.id, a.chrom, a.s, a.e, a.strand FROM stitched500 a JOIN genes b ON a.chrom = b.chrom AND a.s <= b.tss + 50 AND b.tss - 50 <= a.e
GROUP BY ALL HAVING count(DISTINCT b.name) > 2"""
ORACLE["multi_tss_unstitch"] = f"""
SELECT min(id) AS id, {_LOCUS}, arg_min(num_loci, id) AS num_loci FROM (
  SELECT id, chrom, s, e, strand, num_loci FROM stitched500 a WHERE NOT EXISTS (SELECT 1 FROM crowded c WHERE c.id = a.id)
  UNION ALL SELECT DISTINCT b.id, b.chrom, b.s, b.e, b.strand, CAST(1 AS BIGINT) FROM crowded a JOIN upeaks b ON {_MEET})
GROUP BY chrom, s, e, strand"""
TABLES["two_sources"] = """
SELECT chrom, s, e, strand, min(id) AS id FROM (SELECT chrom, s, e, strand, 'A_' || id AS id FROM peaks
  UNION ALL SELECT chrom, s, e, strand, 'B_' || id FROM open_peaks) GROUP BY 1, 2, 3, 4"""
TABLES["provenance"] = f"""
SELECT a.*, CAST(EXISTS (SELECT 1 FROM peaks b WHERE {_MEET} AND {_SENSE}) AS INTEGER) AS in_a,
  CAST(EXISTS (SELECT 1 FROM open_peaks b WHERE {_MEET} AND {_SENSE}) AS INTEGER) AS in_b FROM ({_merge('two_sources', '1')}) a"""
ORACLE["merged_provenance"] = """
SELECT CASE WHEN in_a = 1 AND in_b = 1 THEN 'CONSERVED_' || row_number() OVER (PARTITION BY in_a, in_b ORDER BY chrom, s, e, strand)
  ELSE substr(id, 3) END AS id, chrom, s AS "start", e AS "end", in_a, in_b FROM provenance"""
TABLES["consensus"] = f"""
SELECT chrom, s, e, strand, num_loci, 'merged_x_' || row_number() OVER (ORDER BY e - s DESC, chrom, s, e, strand) AS id
FROM ({_merge(_unique("regions", "status IN ('F', 'O')"), "1")})"""
ORACLE["consensus_regions"] = _STITCH + "consensus"
TABLES["occupied"] = "SELECT id, chrom, s, e, " + ", ".join(
    f"CAST(EXISTS (SELECT 1 FROM regions b WHERE b.status = '{x}' AND {_MEET}) AS INTEGER) AS \"{x}\"" for x in "FOP") + " FROM consensus a"
ORACLE["occupancy_matrix"] = 'SELECT id, chrom, s AS "start", e AS "end", "F", "O", "P" FROM occupied'
ORACLE["gene_set_logic"] = 'SELECT id, "F", "O", "P" FROM occupied WHERE ("F" = 1 AND "O" = 1) OR "P" = 1'

# --- region map and ranks
TABLES["sdens"] = """
SELECT t.id, f.file_key, round(coalesce(c.n, 0) / (t.e - t.s) / (f.mapped / 1e6::DOUBLE), 4) * (t.e - t.s) AS signal
FROM stitched t JOIN file_chroms h ON h.chrom = t.chrom AND t.e <= h.length JOIN files f ON f.file_key = h.file_key
LEFT JOIN (SELECT r.file_key, g.id, g.chrom, sum(least(r.e, g.e) - greatest(r.s, g.s)) AS n FROM reads r
  JOIN stitched g ON r.chrom = g.chrom AND r.s < g.e AND r.e > g.s GROUP BY 1, 2, 3) c
ON c.file_key = f.file_key AND c.id = t.id AND c.chrom = t.chrom"""
TABLES["rmap"] = """
SELECT t.*, coalesce(d.file1, 0.0) AS file1, coalesce(d.file2, 0.0) AS file2, coalesce(d.file3, 0.0) AS file3,
  greatest(0.0::DOUBLE, coalesce(d.file1, 0.0) - coalesce(d.file3, 0.0)) AS signal
FROM sized t LEFT JOIN (SELECT id, sum(signal) FILTER (WHERE file_key = 1) AS file1, sum(signal) FILTER (WHERE file_key = 2) AS file2,
  sum(signal) FILTER (WHERE file_key = 3) AS file3 FROM sdens GROUP BY 1) d USING (id)"""
ORACLE["region_map"] = f"""
SELECT id, {_LOCUS}, num_loci, constituent_size, round(file1, 4) AS file1, round(file2, 4) AS file2, round(file3, 4) AS file3 FROM rmap"""
ORACLE["replicate_collapse"] = """
SELECT id, round((greatest(0.0, file1 - file3) + greatest(0.0, file2 - file3)) / 2, 6) AS signal FROM rmap"""
ORACLE["signal_table_median"] = """
SELECT id, round(greatest(0.0, file2) / (SELECT nullif(median(file2), 0) FROM rmap), 6) AS s2 FROM rmap"""


def _cutoff(value: str, table: str = "rmap") -> str:
    return f"""(SELECT arg_min(v, (v - slope * i, i)) FROM (SELECT v, row_number() OVER (ORDER BY v) AS i,
  (max(v) OVER () - min(v) OVER ()) / count(*) OVER () AS slope FROM (SELECT CAST(greatest({value}, 0) AS DOUBLE) AS v FROM {table})))"""


_TIES = "e - s ASC, chrom DESC, s DESC, e DESC, id DESC"
ORACLE["super_cutoff"] = f"SELECT round({_cutoff('signal')}, 4) AS cutoff"
TABLES["supers"] = f"""
SELECT *, row_number() OVER (ORDER BY signal DESC, {_TIES}) AS enhancer_rank, CAST(signal > {_cutoff('signal')} AS INTEGER) AS is_super FROM rmap"""
ORACLE["super_table"] = "SELECT id, round(signal, 4) AS signal, enhancer_rank, is_super FROM supers"
ORACLE["stretch_table"] = f"""
SELECT id, constituent_size, row_number() OVER (ORDER BY constituent_size DESC, {_TIES}) AS enhancer_rank,
  CAST(constituent_size > {_cutoff('constituent_size')} AS INTEGER) AS is_stretch FROM rmap"""
ORACLE["super_stretch"] = f"""
SELECT id, round(m, 6) AS magnitude, row_number() OVER (ORDER BY m DESC, {_TIES}) AS enhancer_rank,
  CAST(signal > {_cutoff('signal')} AND constituent_size > {_cutoff('constituent_size')} AS INTEGER) AS is_super_stretch
FROM (SELECT *, sqrt(x * x + y * y) AS m FROM (SELECT *, constituent_size / (SELECT max(constituent_size) FROM rmap) AS x,
  signal / (SELECT max(signal) FROM rmap) AS y FROM rmap))"""
ORACLE["axis_magnitude"] = """
SELECT id, round(sqrt(x * x + y * y), 6) AS magnitude, round(abs(x - y) / sqrt(2.0), 6) AS skew
FROM (SELECT id, (e - s + 1) / 1000.0::DOUBLE AS x, signal / 100000.0::DOUBLE AS y FROM peaks)"""


# --- genes
def _pairs(regions: str, window: int) -> str:
    return f"""
SELECT id, gene_id, min(class) AS class FROM (
  SELECT a.id, b.id AS gene_id, 0 AS class FROM {regions} a JOIN tx b ON {_MEET} UNION ALL
  SELECT a.id, b.id, 1 FROM {regions} a JOIN tss b ON a.chrom = b.chrom AND b.tss BETWEEN a.s - {window} AND a.e + {window})
GROUP BY 1, 2"""


def _nearest(regions: str, window: int) -> str:
    return f"""
SELECT id, arg_min(name, (d, class, gene_id)) AS closest_gene, min(d) AS distance FROM (
  SELECT a.id, g.name, p.gene_id, p.class, abs(CAST(floor((a.s + a.e) / 2) AS BIGINT) - g.tss) AS d
  FROM (SELECT * FROM ({_pairs(regions, window)}) UNION ALL
    SELECT a.id, b.id, 2 FROM {regions} a JOIN tss b ON a.chrom = b.chrom AND b.tss BETWEEN a.s - 1000000 AND a.e + 1000000) p
  JOIN {regions} a ON a.id = p.id JOIN genes g ON g.id = p.gene_id) GROUP BY 1"""


ORACLE["gene_pairs"] = f"SELECT * FROM ({_pairs('peaks', 10000)})"
ORACLE["nearest_gene"] = _nearest("peaks", 10000)
TABLES["spairs"] = f"SELECT p.*, g.name FROM ({_pairs('stitched', 10000)}) p JOIN genes g ON g.id = p.gene_id"


def _lists(pairs: str) -> str:
    return f"""
SELECT id, coalesce(string_agg(DISTINCT name, ',' ORDER BY name) FILTER (WHERE class = 0), '') AS overlap_genes,
  coalesce(string_agg(DISTINCT name, ',' ORDER BY name) FILTER (WHERE class = 1), '') AS proximal_genes FROM {pairs} GROUP BY 1"""


ORACLE["gene_assign"] = f"""
SELECT t.id, coalesce(overlap_genes, '') AS overlap_genes, coalesce(proximal_genes, '') AS proximal_genes,
  coalesce(closest_gene, '') AS closest_gene
FROM stitched t LEFT JOIN ({_lists('spairs')}) USING (id) LEFT JOIN ({_nearest('stitched', 10000)}) USING (id)"""
TABLES["rolled"] = """
SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY best_rank, gene_id) AS k FROM (
  SELECT p.name, p.gene_id, string_agg(t.chrom || ':' || t.s || '-' || t.e, ',' ORDER BY p.class, t.enhancer_rank) AS proximal_enhancers,
    string_agg(CAST(t.enhancer_rank AS VARCHAR), ',' ORDER BY t.enhancer_rank) AS enhancer_ranks,
    max(t.is_super) AS is_super, min(t.enhancer_rank) AS best_rank
  FROM spairs p JOIN supers t ON t.id = p.id GROUP BY 1, 2)) WHERE k = 1"""
ORACLE["gene_rollup"] = "SELECT * FROM rolled"
TABLES["gene_level"] = """
SELECT g.id AS gene_id, round(coalesce(sum(least(r.e, g.e) - greatest(r.s, g.s)), 0) / any_value(g.e - g.s)
  / ((SELECT mapped FROM files WHERE file_key = 1) / 1e6::DOUBLE), 4) AS signal
FROM (SELECT id, chrom, txs - 5000 AS s, txe + 5000 AS e FROM genes) g
LEFT JOIN reads r ON r.file_key = 1 AND r.chrom = g.chrom AND r.s < g.e AND r.e > g.s
WHERE g.e <= 260000 AND g.chrom IN (SELECT chrom FROM file_chroms WHERE file_key = 1) GROUP BY 1"""
ORACLE["top_gene"] = """
SELECT t.id, CASE WHEN v > 0 THEN n END AS top_gene, CASE WHEN v > 0 THEN v END AS tss_signal FROM stitched t LEFT JOIN (
  SELECT p.id, arg_min(p.name, (-s.v, p.class, p.name)) AS n, max(s.v) AS v FROM spairs p JOIN (
    SELECT name, max(coalesce(l.signal, 0.0)) AS v FROM rolled LEFT JOIN gene_level l USING (gene_id) GROUP BY 1) s ON s.name = p.name
  GROUP BY 1) USING (id)"""
ORACLE["promoter_regions"] = """
SELECT a.id, a.s AS "start", a.e AS "end", count(DISTINCT b.name) AS names, string_agg(DISTINCT b.id, ',' ORDER BY b.id) AS gene_ids
FROM peaks a JOIN (SELECT chrom, tss, min(id) AS id, arg_min(name, id) AS name FROM genes GROUP BY 1, 2) b
ON a.chrom = b.chrom AND a.s <= b.tss + 1 AND b.tss <= a.e GROUP BY 1, 2, 3 HAVING count(DISTINCT b.name) <= 2"""
TABLES["pgenes"] = """
SELECT a.id, b.id AS gene_id, b.name, 1 AS tss_peak, a.signal FROM peaks a
JOIN tss b ON a.chrom = b.chrom AND a.s <= b.tss + 1000 AND b.tss - 1000 <= a.e UNION ALL
SELECT a.id, b.id, b.name, 0, a.signal FROM peaks a JOIN tss b ON a.chrom = b.chrom
  AND (a.s + a.e) // 2 - 10000 <= b.tss + 1000 AND b.tss - 1000 <= (a.s + a.e) // 2 + 10000
WHERE NOT EXISTS (SELECT 1 FROM tss c WHERE a.chrom = c.chrom AND a.s <= c.tss + 1000 AND c.tss - 1000 <= a.e)"""
ORACLE["peak_genes"] = "SELECT id, gene_id, tss_peak, signal FROM pgenes"
TABLES["gsignal"] = """
SELECT gene_id, name, count(*) AS proximal_events, CAST(sum(signal) AS BIGINT) AS total_signal,
  count(*) FILTER (WHERE tss_peak = 1) AS promoter_regions,
  CAST(coalesce(sum(signal) FILTER (WHERE tss_peak = 1), 0) AS BIGINT) AS promoter_signal,
  count(*) FILTER (WHERE tss_peak = 0) AS distal_regions,
  CAST(coalesce(sum(signal) FILTER (WHERE tss_peak = 0), 0) AS BIGINT) AS distal_signal FROM pgenes GROUP BY 1, 2"""
ORACLE["peak_gene_signal"] = "SELECT * FROM gsignal"
ORACLE["gene_name_signal"] = """
SELECT name, gene_id, proximal_events, total_signal FROM gsignal
QUALIFY row_number() OVER (PARTITION BY name ORDER BY total_signal DESC, gene_id) = 1"""
ORACLE["rank_lookup"] = """
SELECT a.id, coalesce(min(b.enhancer_rank), (SELECT count(*) FROM supers)) AS best_rank
FROM consensus a LEFT JOIN supers b ON a.chrom = b.chrom AND a.s <= b.e AND b.s <= a.e GROUP BY 1"""
ORACLE["gene_lookup"] = "SELECT name, arg_min(id, row_no) AS id, count(DISTINCT id) AS n_ids FROM genes GROUP BY 1"
ORACLE["start_table"] = "SELECT id, name, chrom, strand, tss, tts FROM genes"
ORACLE["name_dedupe"] = "SELECT name, arg_min(id, row_no) AS id FROM genes GROUP BY 1"
ORACLE["transcript_windows"] = """
SELECT min(id) AS id, chrom, s AS "start", e AS "end", strand FROM (
  SELECT id, chrom, strand, txs - CASE strand WHEN '-' THEN 200 ELSE 500 END AS s,
    txe + CASE strand WHEN '-' THEN 500 ELSE 200 END AS e FROM genes) GROUP BY chrom, s, e, strand"""

# --- comparison
TABLES["delta"] = """
SELECT *, log2(scaled2 / scaled1) AS raw, greatest(-8.0::DOUBLE, least(8.0::DOUBLE, log2(scaled2 / scaled1))) AS change FROM (
  SELECT *, greatest(file1, 1.0) / (SELECT median(file1) FROM rmap WHERE file1 > 0) AS scaled1,
    greatest(file2, 1.0) / (SELECT median(file2) FROM rmap WHERE file2 > 0) AS scaled2 FROM rmap)"""
ORACLE["delta_table"] = """
SELECT id, round(change, 6) AS log2_change, round(scaled1, 6) AS scaled1, round(scaled2, 6) AS scaled2,
  row_number() OVER (ORDER BY change DESC, chrom, s, e, id) AS rank FROM delta"""
TABLES["status"] = """
SELECT * REPLACE (replace(id, '_lociStitched', '') AS id), CASE WHEN change > 1 THEN 'GAINED' WHEN change < -1 THEN 'LOST' ELSE 'CONSERVED' END AS status
FROM delta"""
ORACLE["gain_loss"] = "SELECT id, status FROM status"
TABLES["near_names"] = f"SELECT p.id, g.name FROM ({_pairs('stitched', 1000)}) p JOIN genes g ON g.id = p.gene_id UNION SELECT id, closest_gene FROM ({_nearest('stitched', 1000)})"
ORACLE["status_genes"] = """
SELECT n.name AS gene, t.id, t.status FROM near_names n JOIN status t ON t.id = replace(n.id, '_lociStitched', '')"""
_S = ["A_F", "A_O", "N_F", "N_O", "R_F", "R_O"]
ORACLE["cluster_exemplar"] = "SELECT p_brand AS cluster, " + ", ".join(f'median("{s}") AS "{s}"' for s in _S) + """
FROM expr_wide JOIN part ON gene = 'g' || CAST(p_partkey AS VARCHAR) GROUP BY 1"""
ORACLE["sample_corr"] = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS sample_a, '{b}' AS sample_b, round(corr(\"{a}\", \"{b}\"), 6) AS r, round(1 - corr(\"{a}\", \"{b}\"), 6) + 0 AS distance FROM expr_wide"
    for i, a in enumerate(_S) for b in _S[i:])
ORACLE["heatmap_order"] = """
SELECT gene, round(m, 6) AS mean_signal, row_number() OVER (ORDER BY m DESC, gene) AS row_order
FROM (SELECT gene, (greatest(0.0, "A_F" - "R_F") + greatest(0.0, "A_O" - "R_O")) / 2 AS m FROM expr_wide)"""
ORACLE["colour_limits"] = """
SELECT round(quantile_cont(v, 0.6), 6) AS low, round(quantile_cont(v, 0.95), 6) AS high
FROM (UNPIVOT expr_wide ON "A_F", "A_O", "N_F", "N_O", "R_F", "R_O" INTO NAME sample VALUE v)"""

# --- regions
ORACLE["tss_regions"] = """
SELECT id, chrom, 'tss_' || w AS kind, tss - w AS "start", tss + w AS "end", strand FROM genes, (VALUES (5000), (1000), (300)) t(w) UNION ALL
SELECT id, chrom, 'body', CASE strand WHEN '+' THEN tss + 300 ELSE tts - 3000 END,
  CASE strand WHEN '+' THEN tts + 3000 ELSE tss - 300 END, strand FROM genes"""
ORACLE["meta_regions"] = 'SELECT id, chrom, kind, s AS "start", e AS "end", strand FROM meta'
ORACLE["chrom_tiles"] = """
SELECT chrom, 'bin_' || ((n - 1) // 7000 + 1) AS id, n AS "start", n + 7000 AS "end", '.' AS strand
FROM chrom_sizes, range(1, 260000, 7000) t(n)"""
ORACLE["enriched_windows"] = 'SELECT id, chrom, s - 2000 AS "start", e + 2000 AS "end", strand FROM peaks'
ORACLE["strand_flanks"] = """
SELECT id, s - CASE strand WHEN '-' THEN 100 ELSE 500 END AS "start", e + CASE strand WHEN '-' THEN 500 ELSE 100 END AS "end" FROM peaks"""
ORACLE["centre_windows"] = 'SELECT id, (s + e) // 2 - 300 AS "start", (s + e) // 2 + 300 AS "end" FROM peaks'
ORACLE["stretch_regions"] = """
SELECT id, s - p AS "start", e + p AS "end" FROM (SELECT *, CASE WHEN e - s < 300 THEN (300 - (e - s)) // 2 ELSE 0 END AS p FROM peaks)"""
ORACLE["region_parse"] = f"""
SELECT id, chrom || ':' || strand || ':' || s || '-' || e AS text, {_LOCUS} FROM peaks"""
ORACLE["locus_text"] = """
SELECT id, chrom || '(' || strand || '):' || s || '-' || e AS locus_line, chrom || ':' || s || '-' || e AS place,
  chrom AS p_chrom, strand AS p_strand, s AS p_start, e AS p_end FROM peaks"""
ORACLE["gene_plot_region"] = """
SELECT id, chrom || ':' || strand || ':' || (txs - o) || '-' || (txe + o) AS region, 'TXN' AS kind
FROM (SELECT *, CAST(round((txe - txs) * 0.5 / 1000) * 1000 AS BIGINT) AS o FROM genes) UNION ALL
SELECT id, chrom || ':' || strand || ':' || (tss - 5000) || '-' || (tss + 5000), 'TSS' FROM genes"""
ORACLE["plot_features"] = """
SELECT id, feature, name, round(abs(CASE bs WHEN '+' THEN b0 ELSE b1 END - ref) * f, 6) AS name_at,
  round(abs(b0 - ref) * f, 6) AS x_start, round(abs(b1 - ref) * f, 6) AS x_end
FROM (SELECT a.id, b.id AS feature, b.name, b.s AS b0, b.e AS b1, b.strand AS bs, CASE a.strand WHEN '-' THEN a.e ELSE a.s END AS ref,
  200.0::DOUBLE / (a.e - a.s + 1) AS f FROM peaks a JOIN tx b ON a.chrom = b.chrom AND a.s <= b.e AND b.s <= a.e)"""

# --- expression
ORACLE["expr_floor"] = """
SELECT gene, sample, round(CASE WHEN v < 0 THEN 0.0 WHEN v > 0 AND v < 0.01 THEN 0.01 ELSE v END, 6) AS value
FROM (SELECT gene, sample, value / 1000 - 0.02::DOUBLE AS v FROM expr)"""
ORACLE["expr_filter"] = "SELECT gene FROM expr GROUP BY 1 HAVING max(value) > 1 AND min(value) > 0 AND count(*) = 6"
ORACLE["group_means"] = "SELECT gene, " + ", ".join(
    f"round(avg(value) FILTER (WHERE contains(sample, '{g}')), 6) AS \"{g}\"" for g in "ANR") + " FROM expr GROUP BY 1"
ORACLE["diff_table"] = """
SELECT gene, round(m1, 6) AS mean1, round(m2, 6) AS mean2, round(log2(m2 / m1), 6) AS log2_fold_change,
  round((m1 - m2) / sqrt(nullif(e1 + e2, 0)), 6) AS t,
  round(nullif(e1 + e2, 0) * nullif(e1 + e2, 0) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)), 6) AS df
FROM (SELECT gene, avg(x) AS m1, avg(y) AS m2, var_samp(x) / count(x) AS e1, var_samp(y) / count(y) AS e2, count(x) AS n1, count(y) AS n2
  FROM (SELECT gene, CASE WHEN sample LIKE 'A%' THEN value END AS x, CASE WHEN sample LIKE 'R%' THEN value END AS y FROM expr) GROUP BY 1)"""
# the integral of Student's density up to |t|, by Simpson's rule over the angle atan(t / sqrt(df))
TABLES["welch"] = """
SELECT *, CASE WHEN n1 < 2 OR n2 < 2 THEN NULL WHEN lo = hi THEN 1.0 WHEN t IS NOT NULL THEN 1 - 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi())
  * h / 3 * list_sum(list_transform(range(0, 2001), lambda k: CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END * pow(cos(k * h), df - 1))) END AS p
FROM (SELECT *, atan(abs(t) / sqrt(df)) / 2000 AS h FROM (
  SELECT *, (m1 - m2) / sqrt(nullif(e1 + e2, 0)) AS t,
    nullif(e1 + e2, 0) * nullif(e1 + e2, 0) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)) AS df
  FROM (SELECT gene, avg(x) AS m1, avg(y) AS m2, var_samp(x) / count(x) AS e1, var_samp(y) / count(y) AS e2, count(x) AS n1, count(y) AS n2,
      least(min(x), min(y)) AS lo, greatest(max(x), max(y)) AS hi
    FROM (SELECT gene, CASE WHEN sample LIKE 'A%' THEN value END AS x, CASE WHEN sample LIKE 'R%' THEN value END AS y FROM expr) GROUP BY 1)))"""
ORACLE["diff_p_values"] = "SELECT gene, round(p, 5) AS p_value FROM welch"
ORACLE["sig_genes"] = """
SELECT gene, CASE WHEN log2(m2 / m1) > 0 THEN 'up' ELSE 'down' END AS direction, round(log2(m2 / m1), 6) AS log2_fold_change, round(p, 5) AS p_value
FROM welch WHERE abs(log2(m2 / m1)) > 1 AND p < 0.05"""
TABLES["ranked_expr"] = """
SELECT gene, sample, rank() OVER (PARTITION BY sample ORDER BY value) + (count(*) OVER (PARTITION BY sample, value) - 1) / 2.0::DOUBLE AS r
FROM expr WHERE gene IN (SELECT gene FROM expr GROUP BY 1 HAVING max(value) > 1 AND min(value) > 0
  AND count(value) = (SELECT count(DISTINCT sample) FROM expr))"""
ORACLE["replicate_spearman"] = """
SELECT left(a.sample, 1) AS "group", round(corr(a.r, b.r), 6) AS spearman FROM ranked_expr a JOIN ranked_expr b
ON a.gene = b.gene AND left(a.sample, 1) = left(b.sample, 1) AND a.sample < b.sample GROUP BY 1"""
TABLES["offsets"] = """
SELECT sample, m - avg(m) OVER () AS o FROM (SELECT sample, avg(log2(value + 0.1)) AS m FROM expr
  WHERE gene IN (SELECT 'g' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_type = 'ECONOMY') GROUP BY 1)"""
ORACLE["spike_offset"] = 'SELECT sample, round(o, 6) AS "offset" FROM offsets'
ORACLE["spike_normalised"] = """
SELECT sample, gene, round((value + 0.1) / pow(2.0::DOUBLE, o), 4) AS value FROM expr JOIN offsets USING (sample)"""
ORACLE["spike_table"] = """
SELECT gene, sample, value, p_retailprice AS concentration FROM expr JOIN part ON left(gene, 10) = 'g' || CAST(p_partkey AS VARCHAR)
WHERE gene IN (SELECT 'g' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_type = 'ECONOMY')
  AND gene IN (SELECT gene FROM expr GROUP BY gene HAVING min(value) > 0 AND count(value) = (SELECT count(DISTINCT sample) FROM expr))"""
ORACLE["probe_best"] = """
SELECT gene_id, probe, round(m, 6) AS mean FROM (SELECT p_name AS gene_id, gene AS probe,
  ("A_F" + "A_O" + "N_F" + "N_O" + "R_F" + "R_O") / 6 AS m, p_partkey FROM expr_wide JOIN part ON gene = 'g' || CAST(p_partkey AS VARCHAR))
QUALIFY row_number() OVER (PARTITION BY gene_id ORDER BY m DESC, p_partkey) = 1"""
ORACLE["unpivot_expr"] = """
UNPIVOT expr_wide ON "A_F", "A_O", "N_F", "N_O", "R_F", "R_O" INTO NAME sample VALUE value"""
ORACLE["moving_avg"] = """
SELECT gene, "A_F", "R_F", round(CASE WHEN count(*) OVER w = 39 THEN avg("R_F") OVER w END, 6) AS smooth FROM expr_wide
WINDOW w AS (ORDER BY "A_F", gene ROWS BETWEEN 19 PRECEDING AND 19 FOLLOWING)"""
ORACLE["quantile_limits"] = """
SELECT round(greatest(quantile_cont(value, 0.005), 0.5), 6) AS axis_min, round(quantile_cont(value, 0.995), 6) AS axis_max FROM expr"""

# --- screen, sequences
ORACLE["guide_extract"] = """
SELECT doc_id AS record, substr(text, strpos(text, 'the') + 3, 20) AS guide FROM documents WHERE strpos(text, 'the') > 0"""
ORACLE["guide_stats"] = """
SELECT count(*) AS records, count(*) FILTER (WHERE strpos(text, 'the') > 0) AS found,
  round(count(*) FILTER (WHERE strpos(text, 'the') > 0) / count(*), 6) AS fraction FROM documents"""
ORACLE["guide_slice_counts"] = """
SELECT 'documents' AS sample, substr(text, strpos(text, 'th') + 2, 3) AS guide, count(*) AS count
FROM documents WHERE strpos(text, 'th') > 0 GROUP BY 2"""
TABLES["folds"] = """
SELECT guide, coalesce(p_name, '') AS gene, log2((t / tm + 1) / (c / cm + 1)) AS ratio, round(t / tm + 1, 4) AS test, round(c / cm + 1, 4) AS control
FROM (SELECT 'sg' || CAST(l_partkey AS VARCHAR) AS guide, l_partkey, count(*) FILTER (WHERE l_returnflag = 'A') AS t,
    count(*) FILTER (WHERE l_returnflag = 'R') AS c FROM lineitem GROUP BY 1, 2),
  (SELECT round(count(*) FILTER (WHERE l_returnflag = 'A') / 1e6::DOUBLE, 4) AS tm,
    round(count(*) FILTER (WHERE l_returnflag = 'R') / 1e6::DOUBLE, 4) AS cm FROM lineitem)
LEFT JOIN part ON p_partkey = l_partkey WHERE t > 0 AND c > 0"""
ORACLE["fold_table"] = "SELECT guide, gene, round(ratio, 6) AS log2_ratio, test, control FROM folds"
ORACLE["construct_rank"] = """
SELECT guide, gene, round(ratio, 6) AS log2_ratio, row_number() OVER (ORDER BY round(ratio, 9) DESC, guide) AS construct_rank,
  1 AS hairpin_weight FROM folds WHERE gene IN (SELECT gene FROM folds GROUP BY 1 HAVING count(*) > 1)"""
ORACLE["rev_comp"] = """
SELECT doc_id AS record, md5(reverse(translate(text, 'ACGTUacgtu', 'TGCAAtgcaa'))) AS rc,
  md5(translate(text, 'ACGTUacgtu', 'UGCAAugcaa')) AS rna FROM documents"""
ORACLE["fasta_fetch"] = """
SELECT id, length(t) AS n, md5(CASE WHEN k % 2 = 0 THEN t ELSE reverse(translate(t, 'ACGTUacgtu', 'TGCAAtgcaa')) END) AS sequence
FROM (SELECT 'q' || CAST(doc_id AS VARCHAR) AS id, doc_id AS k, substr(text, doc_id % 90 + 2, n_chars // 2 - 1) AS t
  FROM documents WHERE n_chars // 2 > 1) WHERE t <> ''"""
ORACLE["category_counts"] = """
SELECT trim(w) AS category, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) WHERE trim(w) <> '' GROUP BY 1"""

# --- reads
ORACLE["cigar_len"] = """
SELECT cigar, aligned, count(*) AS n FROM (SELECT e - s AS aligned, CASE WHEN spliced
  THEN (seq_len // 2) || 'M100N' || (seq_len - seq_len // 2) || 'M' ELSE seq_len || 'M' END AS cigar FROM reads) GROUP BY 1, 2"""
ORACLE["read_extend"] = """
SELECT strand, CASE strand WHEN '-' THEN greatest(0, s - 200) ELSE s END AS ext_start,
  CASE strand WHEN '+' THEN e + 200 ELSE e END AS ext_end, count(*) AS n FROM reads GROUP BY 1, 2, 3"""
ORACLE["junction_split"] = """
SELECT chrom, "start", "end", strand, part, count(*) AS n FROM (
  SELECT chrom, s + 1 AS "start", s + 1 + seq_len AS "end", strand, 1 AS part FROM reads WHERE NOT spliced UNION ALL
  SELECT chrom, s + 1, s + 1 + seq_len // 2, strand, 1 FROM reads WHERE spliced UNION ALL
  SELECT chrom, s + 1 + seq_len // 2 + 100, s + 1 + seq_len + 100, strand, 2 FROM reads WHERE spliced) GROUP BY ALL"""
ORACLE["reads_dedup"] = "SELECT DISTINCT file_key, chrom, pos, strand FROM reads"
ORACLE["reads_merge"] = "SELECT 9 AS file_key, chrom, pos, count(*) AS n FROM reads WHERE file_key IN (1, 2) GROUP BY 2, 3"
ORACLE["file_index_stats"] = "SELECT chrom, file_key, mapped, length FROM file_chroms"
ORACLE["file_totals"] = "SELECT file_key, mapped, mapped AS total FROM files"

# --- collections
ORACLE["locus_normalise"] = 'SELECT id, s AS "start", e AS "end", e - s + 1 AS length FROM peaks'
ORACLE["collection_size"] = "SELECT status, CAST(sum(e - s) AS BIGINT) AS size, count(*) AS n FROM regions GROUP BY 1"
ORACLE["union_loci"] = f"SELECT {_LOCUS}, min(id) AS id FROM regions GROUP BY chrom, s, e, strand"
ORACLE["remove_loci"] = """
SELECT id FROM regions a WHERE NOT EXISTS (SELECT 1 FROM regions b WHERE b.status = 'P' AND a.chrom = b.chrom AND a.s = b.s
  AND a.e = b.e AND a.strand = b.strand)"""
ORACLE["chrom_consensus"] = """
SELECT chrom FROM file_chroms GROUP BY 1 HAVING count(DISTINCT file_key) = (SELECT count(DISTINCT file_key) FROM file_chroms)"""
ORACLE["chrom_filter"] = f"SELECT id FROM regions WHERE chrom IN ({ORACLE['chrom_consensus']})"
ORACLE["chrom_blacklist"] = "SELECT id, chrom FROM regions WHERE NOT contains(chrom, 'r2') AND NOT contains(chrom, 'chr12')"
ORACLE["unique_ids"] = "SELECT id FROM regions"
_TILE = "SELECT DISTINCT chrom, CAST(floor(s / 5000) AS BIGINT) AS tile FROM regions WHERE status = "
ORACLE["set_ops"] = f"""
SELECT *, 'both' AS found_in FROM (({_TILE} 'F') INTERSECT ({_TILE} 'O')) UNION ALL
SELECT *, 'first' FROM (({_TILE} 'F') EXCEPT ({_TILE} 'O')) UNION ALL
SELECT *, 'second' FROM (({_TILE} 'O') EXCEPT ({_TILE} 'F'))"""
ORACLE["sample_filter"] = """
SELECT name FROM samples WHERE background <> 'NONE' AND enriched_macs <> 'NONE' AND name LIKE 'S%' AND name NOT ILIKE '%wce%'"""
ORACLE["background_pairs"] = """
SELECT a.name, a.file_path, a.background, b.file_path AS background_path FROM samples a LEFT JOIN samples b ON a.background = b.name"""
ORACLE["bam_table"] = """
SELECT name, file_path, s_name AS source FROM samples JOIN supplier ON file_path = '/data/' || CAST(s_suppkey AS VARCHAR) || '.bam'"""
ORACLE["rank_none"] = """
SELECT c_custkey, v AS value, row_number() OVER (ORDER BY v DESC NULLS LAST, c_custkey) AS position
FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS v FROM customer)"""
ORACLE["row_sample"] = """
SELECT * FROM expr_wide ORDER BY md5('7:' || gene), gene LIMIT 1000"""
TABLES["away"] = """
SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY sample_rank, md5(chrom || ':' || s || ':' || e), id) AS k FROM (
  SELECT *, CASE status WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS sample_rank, CAST(floor((s + e) / 2) AS BIGINT) AS centre FROM regions) a
WHERE NOT EXISTS (SELECT 1 FROM genes b WHERE a.chrom = b.chrom AND a.s <= b.tss + 500 AND b.tss - 500 <= a.e)"""
ORACLE["greedy_enhancers"] = """
SELECT id, chrom, sample_rank, centre - 500 AS "start", centre + 500 AS "end" FROM away JOIN (
  WITH RECURSIVE walk AS (
    SELECT DISTINCT chrom, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS taken, false AS took FROM away UNION ALL
    SELECT a.chrom, a.k, CASE WHEN a.free THEN list_append(a.taken, a.centre) ELSE a.taken END, a.free FROM (
      SELECT p.chrom, p.k, w.taken, p.centre, len(list_filter(w.taken, lambda c: c - 500 <= p.e AND p.s <= c + 500)) = 0 AS free
      FROM walk w JOIN away p ON p.chrom = w.chrom AND p.k = w.k + 1) a)
  SELECT chrom, k FROM walk WHERE took) USING (chrom, k)"""
ORACLE["topn"] = "SELECT id, signal FROM peaks ORDER BY signal DESC, id LIMIT 50"


def _needed(sql: str) -> list[str]:
    """Derived tables a statement uses, directly or through others, in definition order."""
    found: set[str] = set()
    open_ = [sql]
    while open_:
        words = set(re.findall(r"[a-z_0-9]+", open_.pop()))
        fresh = (words & set(TABLES)) - found
        found |= fresh
        open_ += [TABLES[name] for name in fresh]
    return [name for name in TABLES if name in found]


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in ORACLE.items():
        tables = _needed(sql)
        head = "WITH " + ",\n".join(f"{t} AS ({TABLES[t].strip()})" for t in tables) + "\n" if tables else ""
        out[name] = head + sql.strip()
    return out
