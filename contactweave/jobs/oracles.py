"""SQL over the same tables that gives each query's rows."""

from __future__ import annotations

from contactweave.jobs.catalog import HALF, MAX_DENSITY, MIN_LINKS, MIN_RE, MOTIFS, RATIO

CTES = {
    "contigs": """SELECT s_suppkey::int AS contig_id, s_name AS name, (count(*) * 1000)::int AS length, (count(DISTINCT l_partkey) + 1)::int AS re_count
        FROM supplier JOIN lineitem ON s_suppkey = l_suppkey GROUP BY 1, 2""",
    "alignments": """SELECT a.l_suppkey::int AS ref_id, ((a.l_orderkey * 7919 + a.l_linenumber::bigint * 104729) % ca.length)::int AS pos,
        b.l_suppkey::int AS next_ref_id, ((b.l_orderkey * 6101 + b.l_linenumber::bigint * 15485863) % cb.length)::int AS next_pos,
        ((a.l_orderkey * 31 + a.l_linenumber) % 61)::int AS mapq, (CASE WHEN a.l_orderkey % 17 = 0 THEN 1024 WHEN a.l_orderkey % 23 = 0 THEN 256 ELSE 0 END)::int AS flag, 150 AS l_seq
        FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.l_suppkey <> b.l_suppkey
        JOIN contigs ca ON ca.contig_id = a.l_suppkey JOIN contigs cb ON cb.contig_id = b.l_suppkey""",
    "reads": "SELECT ref_id, pos, next_ref_id, next_pos FROM alignments",
    "sequences": "SELECT doc_id::int AS contig_id, upper(regexp_replace(text, '[^ACGTacgt]', '', 'g')) AS seq FROM documents",
    "allele_m": """SELECT DISTINCT row_id, c AS contig_id FROM (SELECT s_nationkey::int AS row_id, s_suppkey::int AS c FROM supplier
        UNION ALL SELECT (1000 + s_suppkey % 7)::int, s_suppkey::int FROM supplier) QUALIFY count(*) OVER (PARTITION BY row_id) >= 2""",
    "members": "SELECT (contig_id % 4)::int AS group_id, contig_id FROM contigs",
    "seq_order": """SELECT (contig_id % 4)::int AS group_id, (row_number() OVER (PARTITION BY contig_id % 4 ORDER BY s_acctbal, s_suppkey) - 1)::int AS ord, contig_id
        FROM contigs JOIN supplier ON s_suppkey = contig_id""",
    "counts": "SELECT least(ref_id, next_ref_id) AS lo, greatest(ref_id, next_ref_id) AS hi, count(*) AS pairs FROM reads WHERE ref_id <> next_ref_id GROUP BY 1, 2",
    "weighted": f"""SELECT lo, hi, pairs, (((SELECT max(re_count) FROM contigs)::bigint ** 2)::bigint * pairs // (a.re_count::bigint * b.re_count))::double AS weight
        FROM counts JOIN contigs a ON lo = a.contig_id JOIN contigs b ON hi = b.contig_id WHERE pairs >= {MIN_LINKS}""",
    "directed": "SELECT lo AS s, hi AS e, pairs, weight FROM weighted UNION ALL SELECT hi, lo, pairs, weight FROM weighted",
    "degrees": "SELECT contig_id, re_count, coalesce(sum(weight), 0)::double AS degree FROM contigs LEFT JOIN directed ON s = contig_id GROUP BY 1, 2",
    "factors": "SELECT contig_id, re_count, degree, degree / nullif((SELECT sum(degree) / count(*)::double FROM degrees), 0) AS factor FROM degrees",
    "invalid": f"SELECT contig_id FROM factors WHERE re_count < {MIN_RE} OR coalesce(factor, 0) >= {MAX_DENSITY}",
    "edges": """SELECT s AS "start", e AS "end", pairs, ceil(weight / factor)::double AS weight FROM directed JOIN factors ON s = contig_id""",
    "hits": f"""SELECT contig_id, motif, seq, string_split(seq, motif) AS p FROM sequences, (SELECT unnest({MOTIFS}) AS motif) WHERE contains(seq, motif)""",
    "positions": """SELECT contig_id, motif, (coalesce(sum(length(x)) OVER (PARTITION BY contig_id, motif ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (k - 2) * length(motif))::int AS pos, k
        FROM (SELECT contig_id, motif, unnest(p) AS x, unnest(range(1, len(p) + 1)) AS k FROM hits) QUALIFY k > 1""",
    "item_sites": """SELECT DISTINCT contig_id, length, ((l_partkey * 7919 + l_linenumber::bigint * 104729) % length)::int AS pos FROM lineitem JOIN contigs ON contig_id = l_suppkey""",
    "costs": """SELECT ref_id, next_ref_id, pos, next_pos, a.ord AS oa, b.ord AS ob, ca.length::bigint AS la, cb.length::bigint AS lb FROM reads JOIN seq_order a ON ref_id = a.contig_id JOIN seq_order b ON next_ref_id = b.contig_id
        JOIN contigs ca ON ref_id = ca.contig_id JOIN contigs cb ON next_ref_id = cb.contig_id WHERE a.group_id = b.group_id""",
    "cost_ends": """SELECT ref_id AS c, CASE WHEN oa > ob THEN pos ELSE la - pos END AS f, la AS l FROM costs UNION ALL SELECT next_ref_id, CASE WHEN oa > ob THEN lb - next_pos ELSE next_pos END, lb FROM costs""",
    "cost_sums": """SELECT group_id, ord, contig_id, coalesce(f, 0)::double AS cost_forward, coalesce(r, 0)::double AS cost_reversed FROM seq_order
        LEFT JOIN (SELECT c, sum(f) AS f, sum(l - f) AS r FROM cost_ends GROUP BY 1) ON c = contig_id""",
    "chromosomes": "SELECT group_id, ord, contig_id, cost_reversed < cost_forward AS reversed FROM cost_sums",
    "laid": """SELECT group_id, name, length, reversed, row_number() OVER w AS k, (coalesce(sum(length::bigint) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 100 * (row_number() OVER w - 1))::bigint AS o
        FROM chromosomes JOIN contigs USING (contig_id) WINDOW w AS (PARTITION BY group_id ORDER BY ord)""",
    "pruned": """SELECT * FROM counts WHERE NOT EXISTS (SELECT 1 FROM allele_m a JOIN allele_m b USING (row_id) WHERE a.contig_id = lo AND b.contig_id = hi)""",
    "confl": "SELECT DISTINCT a.contig_id, b.contig_id AS other_id FROM allele_m a JOIN allele_m b USING (row_id) WHERE a.contig_id <> b.contig_id",
    "g_edges": """SELECT a.group_id, "start" AS lo, "end" AS hi, pairs FROM edges JOIN members a ON "start" = a.contig_id JOIN members b ON "end" = b.contig_id AND a.group_id = b.group_id WHERE "start" < "end" """,
    "mids": """SELECT group_id, ord, contig_id, sum(length::bigint) OVER (PARTITION BY group_id ORDER BY ord) - length / 2 AS mid FROM seq_order JOIN contigs USING (contig_id)""",
}


def _windows(sites: str, half: int) -> str:
    return f"""SELECT contig_id, min(a)::int AS "start", max(z)::int AS "end" FROM (SELECT *, sum(o) OVER (PARTITION BY contig_id ORDER BY a, z, pos) AS island FROM (SELECT *,
        CASE WHEN a < max(z) OVER (PARTITION BY contig_id ORDER BY a, z, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS o
        FROM (SELECT contig_id, pos, greatest(0, pos - {half}) AS a, CASE WHEN pos > length - {half} THEN length ELSE pos + {half} END AS z FROM ({sites})))) GROUP BY contig_id, island"""


CTES["item_windows"] = _windows("SELECT * FROM item_sites", 300)
OVERLAP = 'EXISTS (SELECT 1 FROM item_windows w WHERE w.contig_id = ref_id AND pos + {n} >= w."start" AND pos <= w."end")'


def _sql(body: str) -> str:
    """The body behind the tables that it names, and those that these name."""
    need, todo = set(), [body]
    while todo:
        text = todo.pop()
        words = set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())
        for name in CTES:
            if name in words and name not in need:
                need.add(name)
                todo.append(CTES[name])
    order = [n for n in (*[k for k in CTES if k != "item_windows"], "item_windows") if n in need]
    return ("WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in order) + (", " + body[5:] if body.startswith("WITH ") else " " + body)) if order else body


def _count(motifs: list[str]) -> str:
    return "(1 + " + " + ".join(f"(length(seq) - length(replace(seq, '{m}', ''))) // {len(m)}" for m in motifs) + ")::int"


ORACLES = {name: _sql(body) for name, body in {
    "contig_table": "SELECT contig_id, name, re_count, length FROM contigs",
    "link_counts": "SELECT * FROM counts",
    "link_counts_symmetric": 'SELECT lo AS "start", hi AS "end", pairs FROM counts UNION ALL SELECT hi, lo, pairs FROM counts',
    "edge_weights": "SELECT * FROM weighted",
    "node_factors": "SELECT contig_id, degree, round(factor, 9) AS factor FROM factors",
    "invalid_nodes": "SELECT * FROM invalid",
    "invalid_summary": "SELECT count(*) AS contigs, (SELECT count(*) FROM invalid) AS invalid, sum(length)::bigint AS total_bp FROM contigs",
    "draft_edges": "SELECT * FROM edges",
    "motif_counts": f"SELECT contig_id, length(seq)::int AS length, {_count(MOTIFS)} AS re_count FROM sequences",
    "motif_weight_counts": f"SELECT contig_id, length(seq)::int AS length, {_count(['GAAT', 'GACT', 'GAGT', 'GATT'])} AS re_count FROM sequences",
    "motif_positions": "SELECT contig_id, motif, pos FROM positions",
    "site_ranges": _windows("SELECT DISTINCT contig_id, pos, length(seq) AS length FROM positions JOIN sequences USING (contig_id)", HALF),
    "nucleotide_check": "SELECT doc_id, regexp_full_match(upper(text), '[ACGTU]*') AS text_ok, true AS seq_ok FROM documents",
    "bam_filter": f"SELECT ref_id, pos, next_ref_id, next_pos FROM alignments WHERE mapq >= 40 AND mapq NOT IN (0, 255) AND flag & 3852 = 0 AND ref_id <> next_ref_id AND {OVERLAP.format(n='l_seq')}",
    "bam_alignments": "SELECT ref_id, pos, mapq, flag, l_seq, next_ref_id, next_pos FROM alignments",
    "filter_counts": f"""WITH a AS (SELECT *, ref_id = next_ref_id AS same, mapq < 40 OR mapq IN (0, 255) AS low, flag & 3852 <> 0 AS bad FROM alignments)
        SELECT 'alignments' AS label, 'rows' AS what, count(*) AS n FROM a UNION ALL SELECT 'alignments', 'unknown_contig', count_if(ref_id IS NULL OR next_ref_id IS NULL)::bigint FROM a
        UNION ALL SELECT 'alignments', 'same_contig', count_if(same)::bigint FROM a UNION ALL SELECT 'alignments', 'mapping_quality', count_if(low AND NOT same)::bigint FROM a
        UNION ALL SELECT 'alignments', 'flags', count_if(bad AND NOT low AND NOT same)::bigint FROM a
        UNION ALL SELECT 'alignments kept', 'rows', count(*) FROM a WHERE NOT same AND NOT low AND NOT bad AND {OVERLAP.format(n='l_seq')}""",
    "bam_filter_no_flags": "SELECT ref_id, pos, next_ref_id, next_pos FROM alignments WHERE mapq >= 40 AND mapq NOT IN (0, 255) AND ref_id <> next_ref_id",
    "pairs_filter": f"SELECT * FROM reads WHERE ref_id <> next_ref_id AND {OVERLAP.format(n=150)}",
    "range_semi_join": f"SELECT * FROM reads WHERE {OVERLAP.format(n=0)}",
    "pairs_parse": "SELECT ref_id, pos, next_ref_id, (CASE WHEN next_pos % 11 = 0 THEN 0 ELSE next_pos END)::int AS next_pos FROM reads WHERE pos % 5 <> 0 AND pos % 7 <> 0",
    "fasta_records": "SELECT doc_id AS place, 'doc' || doc_id AS name, regexp_replace(text, '[^ACGTacgt]', '', 'g') AS seq FROM documents WHERE regexp_matches(text, '[ACGTacgt]')",
    "allele_text_rows": "SELECT row_id, string_agg(contig_id::varchar, ',' ORDER BY contig_id) AS contig_ids FROM allele_m JOIN contigs USING (contig_id) GROUP BY 1 HAVING count(*) >= 2",
    "allele_conflicts": "SELECT contig_id, string_agg(other_id::varchar, ',' ORDER BY other_id) AS other_ids FROM confl GROUP BY 1",
    "allele_intra_row_prune": "SELECT * FROM pruned",
    "allele_row_candidates": """SELECT a.row_id AS row_i, b.row_id AS row_j, i AS contig_i, j AS contig_j, pairs FROM (SELECT lo AS i, hi AS j, pairs FROM pruned UNION ALL SELECT hi, lo, pairs FROM pruned)
        JOIN allele_m a ON a.contig_id = i JOIN allele_m b ON b.contig_id = j AND a.row_id < b.row_id
        WHERE NOT EXISTS (SELECT 1 FROM allele_m x WHERE x.row_id = b.row_id AND x.contig_id = i) AND NOT EXISTS (SELECT 1 FROM allele_m x WHERE x.row_id = a.row_id AND x.contig_id = j)""",
    "merge_ops": 'SELECT "start" AS a, "end" AS b, weight AS score FROM edges WHERE "start" < "end" AND "start" NOT IN (FROM invalid) AND "end" NOT IN (FROM invalid)',
    "cluster_linkage": """SELECT a.group_id AS from_group, b.group_id AS to_group, sum(weight) AS total, round(sum(weight) / (SELECT count(*) FROM members m WHERE m.group_id = a.group_id) / (SELECT count(*) FROM members m WHERE m.group_id = b.group_id), 9) AS linkage
        FROM edges JOIN members a ON "start" = a.contig_id JOIN members b ON "end" = b.contig_id AND a.group_id <> b.group_id GROUP BY 1, 2""",
    "cluster_conflicts": """SELECT least(a.group_id, b.group_id) AS group_a, greatest(a.group_id, b.group_id) AS group_b, count(*) AS conflicts FROM confl JOIN members a ON a.contig_id = confl.contig_id
        JOIN members b ON b.contig_id = other_id WHERE confl.contig_id < other_id AND a.group_id <> b.group_id GROUP BY 1, 2""",
    "recover_contigs": f"""SELECT contig_id, group_id, round(best, 6) AS best, round(second, 6) AS second FROM (SELECT *, row_number() OVER w AS k, coalesce(lead(best) OVER w, 0) AS second FROM (
        SELECT "start" AS contig_id, g.group_id, sum(weight) / n AS best FROM edges JOIN (SELECT * FROM members WHERE contig_id NOT IN (FROM invalid)) g ON "end" = g.contig_id
        JOIN (SELECT group_id, count(*) AS n FROM members WHERE contig_id NOT IN (FROM invalid) GROUP BY 1) z ON z.group_id = g.group_id WHERE "start" IN (FROM invalid) GROUP BY 1, 2, n)
        WINDOW w AS (PARTITION BY contig_id ORDER BY best DESC, group_id)) WHERE k = 1 AND best >= {RATIO} AND (second = 0 OR best / second >= {RATIO})""",
    "group_stats": "SELECT group_id, count(*) AS contigs, sum(re_count)::bigint AS total_re, sum(length)::bigint AS total_bp, (sum(length)::bigint // sum(re_count)::bigint)::bigint AS bp_per_re FROM members JOIN contigs USING (contig_id) GROUP BY 1",
    "group_edges": "SELECT * FROM g_edges",
    "order_midpoints": "SELECT group_id, ord, contig_id, mid::double AS mid FROM mids",
    "order_score": """SELECT e.group_id, round(-sum(pairs / abs(a.mid - b.mid)), 6) AS score FROM g_edges e JOIN mids a ON a.contig_id = lo JOIN mids b ON b.contig_id = hi WHERE abs(a.mid - b.mid) <= 10000000 GROUP BY 1""",
    "orientation_costs": "SELECT * FROM cost_sums",
    "orientation": "SELECT * FROM chromosomes",
    "reverse_complements": "SELECT contig_id, translate(reverse(seq), 'ACGT', 'TGCA') AS seq FROM sequences",
    "agp": """SELECT 'Group_' || group_id AS object, object_beg, object_end, part_number, component_type, component_id, component_beg, component_end, orientation FROM (
        SELECT group_id, o + 1 AS object_beg, o + length AS object_end, (2 * k - 1)::int AS part_number, 'W' AS component_type, name AS component_id, '1' AS component_beg, length::varchar AS component_end, CASE WHEN reversed THEN '-' ELSE '+' END AS orientation FROM laid
        UNION ALL SELECT group_id, o - 99, o, (2 * k - 2)::int, 'U', '100', 'contig', 'yes', 'map' FROM laid WHERE k > 1)""",
    "scaffold_fasta": "SELECT 'Group_' || (contig_id % 16) AS object, string_agg(CASE WHEN contig_id % 3 = 0 THEN translate(reverse(seq), 'ACGT', 'TGCA') ELSE seq END, '' ORDER BY contig_id) AS seq FROM sequences GROUP BY contig_id % 16",
    "dump_edges": 'SELECT a.name AS start_name, b.name AS end_name, pairs, weight FROM edges JOIN contigs a ON "start" = a.contig_id JOIN contigs b ON "end" = b.contig_id',
    "dump_reads": "SELECT a.name AS name, pos, b.name AS next_name, next_pos FROM reads JOIN contigs a ON ref_id = a.contig_id JOIN contigs b ON next_ref_id = b.contig_id",
    "dump_alignments": "SELECT a.name AS name, pos, mapq::smallint AS mapq, flag, l_seq, b.name AS next_name, next_pos FROM alignments JOIN contigs a ON ref_id = a.contig_id JOIN contigs b ON next_ref_id = b.contig_id",
    "dump_group": "SELECT group_id, contig_id, name, length FROM members JOIN contigs USING (contig_id)",
    "dump_chromosomes": "SELECT group_id, ord, name, length, CASE WHEN reversed THEN '-' ELSE '+' END AS direction FROM chromosomes JOIN contigs USING (contig_id)",
    "dump_alleles": "SELECT row_id, string_agg(name, chr(9) ORDER BY contig_id) AS names FROM allele_m JOIN contigs USING (contig_id) GROUP BY 1",
    "event_adjacency": """SELECT least(a, b) AS lo, greatest(a, b) AS hi, count(*) AS pairs FROM (SELECT user_id AS a, lead(user_id) OVER (PARTITION BY date_trunc('hour', ts) ORDER BY ts, event_id) AS b FROM events) WHERE a <> b GROUP BY 1, 2""",
}.items()}
