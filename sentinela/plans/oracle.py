"""Independent DuckDB SQL for every contract query (same column names).

Written from the semantics, not from the Spark code: windows with
``row_number`` where the Spark side uses range buckets, anti joins written as
``NOT EXISTS``, ages from ``date_diff`` and ``strftime``, and so on.
"""

INF = ("inf AS (SELECT user_id AS record_id, event_type AS bacteria, count(event_type) AS otu "
       "FROM events GROUP BY user_id, event_type)")

_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_MOST = ("translate(regexp_replace(lower(text), '[^\\p{L}]', '', 'g'), "
         f"'{_LETTERS}', '{('ACGT' * 20)[:len(_LETTERS)]}')")
_DNA = (f"CASE WHEN regexp_matches({_MOST}, '[^ACGT]') THEN array_to_string([CASE WHEN c IN ('A', 'C', 'G', 'T') THEN c "
        f"ELSE substring('ACGT', unicode(c) % 4 + 1, 1) END FOR c IN string_split({_MOST}, '')], '') ELSE {_MOST} END")

_WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda x: x <> '')"

ORACLE_SQL = {
    "gene_abundance": """
        SELECT user_id AS record_id, event_type AS gene, count(event_type) AS otu
        FROM events WHERE contains(event_type, 'i') GROUP BY user_id, event_type""",
    "infection_profile": f"""
        WITH {INF}
        SELECT record_id,
               string_agg(bacteria, ',' ORDER BY otu DESC, bacteria) AS all_bacteria,
               string_agg(CAST(otu AS VARCHAR), ',' ORDER BY otu DESC, bacteria) AS all_otu
        FROM inf WHERE bacteria IS NOT NULL GROUP BY record_id""",
    "profile_explode": f"""
        WITH {INF}
        SELECT record_id,
               CAST(row_number() OVER (PARTITION BY record_id ORDER BY otu DESC, bacteria) - 1 AS INTEGER) AS pos,
               bacteria, otu
        FROM inf""",
    "top_share": f"""
        WITH {INF},
        r AS (SELECT record_id, bacteria, otu,
                     row_number() OVER (PARTITION BY record_id ORDER BY otu DESC, bacteria) AS rn
              FROM inf),
        t AS (SELECT *, sum(otu) OVER (PARTITION BY record_id) AS tot FROM r WHERE rn <= 3)
        SELECT record_id, CAST(rn - 1 AS INTEGER) AS pos, bacteria, otu,
               round(CAST(otu AS DOUBLE) * 1000000 / CAST(tot AS DOUBLE)) / CAST(10000 AS DOUBLE) AS share
        FROM t""",
    "taxonomy_join": """
        SELECT s.s_nationkey AS gene, count(s.s_nationkey) AS otu,
               concat_ws('_', r.r_name, n.n_name) AS bacteria
        FROM supplier s
        JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey
        GROUP BY s.s_nationkey, r.r_name, n.n_name""",
    "new_samples_anti": """
        SELECT c.c_custkey AS record_id FROM customer c
        WHERE NOT EXISTS (SELECT 1 FROM orders o
                          WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""",
    "min_rows_guard": """
        SELECT user_id AS record_id, count(*) AS n FROM events
        WHERE event_type = 'error' GROUP BY user_id HAVING count(*) >= 2""",
    "patient_index": f"""
        WITH {INF},
        p AS (SELECT c_custkey AS record_id, row_number() OVER (ORDER BY c_custkey) - 1 AS idx FROM customer)
        SELECT i.bacteria, i.otu, p.record_id FROM inf i JOIN p ON i.record_id = p.idx""",
    "typed_union": """
        SELECT user_id AS "index", event_type AS bacteria, count(event_type) AS otu
        FROM events GROUP BY user_id, event_type""",
    "sink_append": f"""
        WITH {INF}
        SELECT * FROM inf UNION ALL SELECT * FROM inf""",
    "delimited_project": """
        SELECT o_orderkey AS record_id, o_orderstatus AS hospital_city,
               o_orderpriority AS campus_name, o_orderstatus AS patient_type,
               CAST(o_custkey AS VARCHAR) AS billing_no,
               date_trunc('second', o_orderdate) AS admit_date,
               o_custkey % 90 AS age, o_totalprice AS billed_charges
        FROM orders""",
    "string_cleanup": """
        SELECT o_orderkey,
               replace(o_orderpriority, '-', '') AS no_dash,
               replace(replace(o_orderpriority, '-', ''), ' ', '') AS no_dash_space,
               trim(o_orderpriority, '1') AS stripped,
               substring(o_orderpriority, 2, greatest(length(o_orderpriority) - 2, 0)) AS inner1,
               substring(o_orderpriority, 2, greatest(length(o_orderpriority) - 3, 0)) AS inner2,
               substring(trim(o_orderpriority, '1'), 2, 3) AS code,
               substring(trim(o_orderpriority, '1'), 9,
                         greatest(length(trim(o_orderpriority, '1')) - 9, 0)) AS title,
               substring(o_orderpriority, 1, 1) AS "first",
               substring(o_orderpriority, 4, greatest(length(o_orderpriority) - 3, 0)) AS tail
        FROM orders""",
    "age_at_date": """
        SELECT date_diff('year', o.o_orderdate, l.l_shipdate)
               - CASE WHEN strftime(l.l_shipdate, '%m%d') < strftime(o.o_orderdate, '%m%d')
                      THEN 1 ELSE 0 END AS age,
               count(*) AS n
        FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
        GROUP BY 1""",
    "json_project": """
        SELECT user_id AS record_id, event_type AS drug_class,
               upper(event_type) AS therapeutic_category, props AS generic_drug,
               CAST(json_extract(props, '$.k') AS DOUBLE) AS adj_pharmacy_charges,
               value AS pharmacy_charges, date_trunc('second', ts) AS date_of_service
        FROM events""",
    "quarantine": """
        SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'bad_id'
                    WHEN o_orderkey % 11 = 0 THEN 'bad_date'
                    ELSE 'ok' END AS status,
               count(*) AS n
        FROM orders GROUP BY 1""",
    "skip_leading_rows": """
        SELECT doc_id, lang FROM (
            SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn
            FROM documents) WHERE rn > 3""",
    "record_chunks": """
        WITH c AS (
            SELECT event_type, event_id,
                   (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 500 + 1 AS chunk
            FROM events)
        SELECT event_type, chunk, event_type || '_' || CAST(chunk AS VARCHAR) AS name,
               count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
        FROM c GROUP BY event_type, chunk""",
    "record_framing": """
        SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS text_len FROM conversations""",
    "catalogue_filter": """
        SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#11'""",
    "source_worklist": """
        SELECT substring(source, 1, 4) AS prefix, source, count(*) AS n, max(n_chars) AS max_size
        FROM documents WHERE n_chars > 2000 AND suffix(source, '1')
        GROUP BY 1, 2""",
    "distinct_ids": """
        SELECT DISTINCT user_id AS record_id FROM events""",
    "patient_metadata": """
        SELECT record_id, admit_date, o_orderkey, patient_type, total_charge FROM (
            SELECT o_custkey AS record_id, o_orderdate AS admit_date, o_orderkey,
                   o_orderstatus AS patient_type, o_totalprice AS total_charge,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders) WHERE rn = 1""",
    "level_band": """
        WITH b AS (SELECT CAST(least(greatest(floor(p_size / 5.0), 0), 8) AS INTEGER) AS band FROM part
                   WHERE p_size IS NOT NULL)
        SELECT band, CAST(band AS VARCHAR) || '-' || CAST(band + 1 AS VARCHAR) AS label, count(*) AS n
        FROM b GROUP BY band""",
    "patient_report": f"""
        WITH {INF},
        o AS (SELECT o_custkey AS record_id, count(*) AS n_orders,
                     CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_billed
              FROM orders GROUP BY o_custkey),
        p AS (SELECT record_id, string_agg(bacteria, ',' ORDER BY otu DESC, bacteria) AS all_bacteria
              FROM inf GROUP BY record_id)
        SELECT c.c_custkey AS record_id, c.c_name, c.c_mktsegment, o.n_orders, o.total_billed, p.all_bacteria
        FROM customer c
        LEFT JOIN o ON o.record_id = c.c_custkey
        LEFT JOIN p ON p.record_id = c.c_custkey""",
    "ctas_cast": """
        SELECT o_totalprice AS adj_pharmacy_charges,
               date_trunc('second', CAST(o_orderdate AS TIMESTAMP)) AS date_of_service,
               o_orderstatus AS drug_class, o_orderkey AS record_id
        FROM orders""",
    "key_check": """
        SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""",
    "read_mapping": f"""
        WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 7], ' ') AS s
               FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i
                     FROM dw WHERE len(w) >= 8)),
        bw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 7], ' ') AS s
               FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 7)) AS i
                     FROM bw WHERE len(w) >= 8)),
        seeds AS (SELECT ds.doc_id, bs.item_id, count(*) AS seeds
                  FROM ds JOIN bs ON ds.s = bs.s GROUP BY ds.doc_id, bs.item_id),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY seeds DESC, item_id) AS rn
                   FROM seeds)
        SELECT doc_id, item_id, seeds FROM ranked WHERE rn = 1""",
    "read_mapping_dna": f"""
        WITH d AS (SELECT doc_id, source AS sample, {_DNA} AS dna FROM documents),
        r0 AS (SELECT sample, doc_id, dna, unnest(generate_series(0, greatest(length(dna) - 1, 0), 100)) AS read_start
               FROM d),
        reads AS (SELECT sample, doc_id, read_start, substring(dna, read_start + 1, 100) AS seq FROM r0),
        rq AS (SELECT sample, doc_id, read_start, length(seq) AS nt_length, seq,
                      reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM reads WHERE length(seq) >= 16),
        q AS (SELECT doc_id, read_start, nt_length, seq, rc,
                     unnest(generate_series(0, nt_length - 16)) AS qpos FROM rq),
        qk AS (SELECT doc_id, read_start, nt_length, '+' AS strand, qpos, substring(seq, qpos + 1, 16) AS kmer FROM q
               UNION ALL
               SELECT doc_id, read_start, nt_length, '-' AS strand, qpos, substring(rc, qpos + 1, 16) AS kmer FROM q),
        b AS (SELECT item_id, {_DNA} AS dna FROM benchmark),
        rk AS (SELECT item_id, rpos, substring(dna, rpos + 1, 16) AS kmer
               FROM (SELECT item_id, dna, unnest(generate_series(0, length(dna) - 16)) AS rpos
                     FROM b WHERE length(dna) >= 16)),
        votes AS (SELECT qk.doc_id, qk.read_start, qk.nt_length, qk.strand, rk.item_id,
                         rk.rpos - qk.qpos AS diag, count(*) AS seeds
                  FROM qk JOIN rk ON qk.kmer = rk.kmer
                  GROUP BY 1, 2, 3, 4, 5, 6 HAVING count(*) >= 2),
        best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, read_start
                                              ORDER BY seeds DESC, item_id, strand, diag) AS rn FROM votes),
        won AS (SELECT rq.sample, best.*, CASE strand WHEN '+' THEN seq ELSE rc END AS o, b.dna
                FROM best JOIN rq USING (doc_id, read_start) JOIN b USING (item_id) WHERE rn = 1),
        bases AS (SELECT doc_id, read_start, count(*) AS same
                  FROM (SELECT doc_id, read_start, o, dna, diag, unnest(generate_series(0, nt_length - 1)) AS i FROM won)
                  WHERE diag + i >= 0 AND diag + i < length(dna)
                    AND substring(o, i + 1, 1) = substring(dna, diag + i + 1, 1)
                  GROUP BY doc_id, read_start)
        SELECT sample, doc_id, read_start, item_id, strand, diag AS start, diag + won.nt_length AS "end",
               won.nt_length, seeds, round(same / CAST(won.nt_length AS DOUBLE), 6) AS identity
        FROM won JOIN bases USING (doc_id, read_start)""",
    "incremental_load": """
        SELECT user_id AS record_id, event_type AS bacteria, count(event_type) AS otu
        FROM events GROUP BY user_id, event_type""",
}
