"""Independent DuckDB SQL for the queries of ``file_contract`` (same column names)."""

from .oracle import _DNA, INF, ORACLE_SQL

#: Amount columns of the billing table by their position in a discharge line.
_AMOUNTS = {76: "adj_billed_charges", 77: "clinical_charges", 78: "imaging_charges", 79: "lab_charges",
            80: "other_charges", 81: "pharmacy_charges", 82: "supply_charges", 83: "adj_clinical_charges",
            84: "adj_imaging_charges", 85: "adj_lab_charges", 86: "adj_other_charges", 87: "adj_pharmacy_charges",
            88: "adj_supply_charges"}


def _left(n: int) -> str:
    return f"CAST(o_orderkey % {n} AS VARCHAR)"


FILE_ORACLE_SQL = {
    "annotation_job": """
        WITH h AS (SELECT 'ward=W' || lpad(CAST(user_id // 10 AS VARCHAR), 9, '0') AS sample, event_type FROM events),
        c AS (SELECT sample, event_type, count(*) AS otu FROM h
              WHERE event_type NOT IN ('error', 'view') GROUP BY sample, event_type),
        s AS (SELECT sample, row_number() OVER (ORDER BY sample) AS i FROM (SELECT DISTINCT sample FROM h)),
        p AS (SELECT c_custkey AS record_id, row_number() OVER (ORDER BY c_custkey) AS i FROM customer)
        SELECT c.sample, 'Bacteria_' || c.event_type AS bacteria, c.otu, p.record_id
        FROM c JOIN s ON c.sample = s.sample JOIN p ON s.i = p.i
        WHERE c.sample IN (SELECT sample FROM c GROUP BY sample HAVING count(*) >= 2)""",
    "sequencing_pipeline": f"""
        WITH d AS (SELECT doc_id, {_DNA} AS dna FROM documents),
        r0 AS (SELECT doc_id, dna, unnest(generate_series(0, greatest(length(dna) - 1, 0), 100)) AS read_start FROM d),
        rq AS (SELECT doc_id, read_start, substring(dna, read_start + 1, 100) AS seq FROM r0),
        rs AS (SELECT doc_id, read_start, '+' AS strand, seq FROM rq WHERE length(seq) >= 16
               UNION ALL SELECT doc_id, read_start, '-', reverse(translate(seq, 'ACGT', 'TGCA')) FROM rq WHERE length(seq) >= 16),
        qk AS (SELECT doc_id, read_start, strand, qpos, substring(seq, qpos + 1, 16) AS kmer
               FROM (SELECT *, unnest(generate_series(0, length(seq) - 16)) AS qpos FROM rs)),
        rk AS (SELECT item_id, rpos, substring(dna, rpos + 1, 16) AS kmer
               FROM (SELECT item_id, dna, unnest(generate_series(0, length(dna) - 16)) AS rpos
                     FROM (SELECT item_id, {_DNA} AS dna FROM benchmark) WHERE length(dna) >= 16)),
        votes AS (SELECT doc_id, read_start, strand, item_id, rpos - qpos AS diag, count(*) AS n
                  FROM qk JOIN rk USING (kmer) GROUP BY ALL),
        chain AS (SELECT doc_id, read_start, strand, item_id, moved, floor((diag + moved) / 12.0) AS bucket,
                         sum(n) AS seeds, max(diag) - min(diag) AS width, min(diag) AS low
                  FROM votes, (SELECT unnest([0, 6]) AS moved) GROUP BY ALL HAVING sum(n) >= 2),
        best AS (SELECT doc_id, item_id FROM chain
                 QUALIFY row_number() OVER (PARTITION BY doc_id, read_start
                                            ORDER BY seeds DESC, width, item_id, strand, low) = 1),
        h AS (SELECT 'sample=SRS' || lpad(CAST(doc_id // 100 AS VARCHAR), 6, '0') AS sample, item_id FROM best),
        c AS (SELECT sample, item_id, count(*) AS otu FROM h GROUP BY ALL),
        s AS (SELECT sample, row_number() OVER (ORDER BY sample) AS i FROM (SELECT DISTINCT sample FROM h)),
        p AS (SELECT c_custkey AS record_id, row_number() OVER (ORDER BY c_custkey) AS i FROM customer)
        SELECT c.sample, 'Bacteria_Family f' || (item_id % 7 % 3) || '_Genus g' || (item_id % 7) || '_item ' || item_id AS bacteria,
               c.otu, p.record_id
        FROM c JOIN s ON c.sample = s.sample JOIN p ON s.i = p.i
        WHERE c.sample IN (SELECT sample FROM c GROUP BY sample HAVING count(*) >= 2)""",
    "incremental_annotation": """
        WITH c AS (SELECT user_id // 10 AS w, event_type, count(*) AS otu FROM events
                   WHERE event_type NOT IN ('view', 'error') GROUP BY ALL)
        SELECT 'ward=W' || w AS sample, upper(event_type) AS bacteria, otu FROM c
        WHERE w IN (SELECT w FROM c GROUP BY w HAVING count(*) >= 2)""",
    "pending_chunks": """
        WITH w AS (SELECT 'SRS' || lpad(CAST(conv_id // 40 AS VARCHAR), 6, '0') AS sample, CAST(turn % 2 + 1 AS INTEGER) AS mate,
                          CAST(conv_id % 3 + 1 AS INTEGER) AS chunk, strlen(coalesce(text, '')) + 1 AS n,
                          (conv_id // 40 + turn % 2 + conv_id % 3) % 2 = 0 AS done
                   FROM conversations)
        SELECT sample, mate, chunk, CAST(sum(n) AS BIGINT) AS length FROM w
        GROUP BY sample, mate, chunk HAVING NOT bool_or(done)""",
    "taxon_lineages": """
        SELECT 'c' || c_custkey AS taxon,
               CASE WHEN c_custkey % 97 = 0 OR c_custkey % 101 = 0 THEN c_name ELSE r_name || '_' || n_name || '_' || c_name END AS label,
               CASE WHEN c_custkey % 97 = 0 OR c_custkey % 101 = 0 THEN 1 ELSE 3 END AS depth,
               CASE WHEN c_custkey % 97 = 0 THEN 'orphan' ELSE 'ok' END AS status
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 'n' || n_nationkey, r_name || '_' || n_name, 2, 'ok' FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 'r' || r_regionkey, r_name, 1, 'ok' FROM region""",
    "profile_refresh": ORACLE_SQL["infection_profile"],
    "keyed_append": """
        WITH l AS (SELECT l_orderkey AS k, l_linenumber AS m FROM lineitem),
        a AS (SELECT k, count(*) AS n, min(m) AS m FROM l WHERE m <= 2 GROUP BY k),
        b AS (SELECT k, count(*) AS n, min(m) AS m FROM l WHERE m >= 2 OR k % 5 = 0 GROUP BY k)
        SELECT k AS order_key, CAST(m AS BIGINT) AS n, 'kept' AS status FROM a
        UNION ALL SELECT k, CAST(m AS BIGINT), 'kept' FROM b WHERE k NOT IN (SELECT k FROM a)
        UNION ALL SELECT k, n, 'repeated' FROM a WHERE n > 1
        UNION ALL SELECT k, n, CASE WHEN k IN (SELECT k FROM a) THEN 'exists' ELSE 'repeated' END FROM b
        WHERE n > 1 OR k IN (SELECT k FROM a)""",
    "patient_lookup": """
        SELECT o_custkey AS record_id, o_orderdate AS admit_date, o_orderpriority AS campus_name, o_orderkey
        FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders)""",
    "limited_parts": "SELECT event_id FROM events WHERE event_id % 4 IN (0, 1)",
    "source_rejects": r"""
        SELECT CASE WHEN k % 9 = 0 THEN 'malformed' WHEN k % 9 = 1 THEN 'bad_number' ELSE 'ok' END AS status, count(*) AS n
        FROM (SELECT CAST(regexp_extract(props, '\d+') AS BIGINT) AS k FROM events) GROUP BY 1""",
    "gene_checks": """
        SELECT 'NC_error' AS gene, 'unknown' AS problem
        WHERE EXISTS (FROM events WHERE event_type = 'error' AND event_id % 13 <> 0)
        UNION ALL
        SELECT NULL, 'null ' || count(*) FROM events WHERE event_id % 13 = 0 HAVING count(*) > 0""",
    "fastq_chunks": f"""
        WITH d AS (SELECT doc_id, 'SRS' || lpad(CAST(doc_id // 100 AS VARCHAR), 6, '0') AS sample, doc_id % 2 + 1 AS mate,
                          length({_DNA}) AS bases FROM documents),
        n AS (SELECT *, (row_number() OVER (PARTITION BY sample, mate ORDER BY doc_id) - 1) // 15 + 1 AS c FROM d)
        SELECT sample || '_' || mate || '_' || c AS chunk, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id,
               CAST(sum(bases) AS BIGINT) AS bases, count(*) AS whole
        FROM n GROUP BY sample, mate, c""",
    "agg_infection": ORACLE_SQL["infection_profile"],
    "catalogue_file": ORACLE_SQL["catalogue_filter"],
    "id_list_file": """
        SELECT user_id AS record_id, user_id = (SELECT min(user_id) FROM events) AS is_default
        FROM events GROUP BY user_id""",
    "object_worklist": """
        WITH o AS (SELECT 'SRS' || lpad(CAST(conv_id // 10 AS VARCHAR), 6, '0') AS sample,
                          turn % 2 AS mate, sum(strlen(coalesce(text, '')) + 1) AS length
                   FROM conversations GROUP BY ALL)
        SELECT sample || '_1.fastq' AS name, CAST(length AS BIGINT) AS length, sample, '1' AS mate,
               '1.fastq' AS rest, sample || '_1' AS stem, sample || '_1_1' AS chunk
        FROM o WHERE mate = 1 AND length > 500""",
    "parts_file": "SELECT event_id FROM events",
    "chunk_files": """
        SELECT event_type, chunk, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
        FROM (SELECT event_type, event_id,
                     (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 500 + 1 AS chunk
              FROM events)
        GROUP BY event_type, chunk""",
    "keyed_table": """
        SELECT o_custkey AS record_id, count(*) AS n, max(o_orderkey) AS last_key FROM orders GROUP BY o_custkey""",
    "discharge_demographics": f"""
        SELECT o_custkey AS record_id, o_orderstatus AS hospital_city, o_orderpriority AS campus_name,
               CAST(CAST(o_orderdate AS DATE) - to_years(CAST(o_custkey % 90 AS INTEGER)) AS TIMESTAMP) AS dob,
               o_custkey % 90 AS age, {_left(2)} AS gender, {_left(5)} AS ethnicity, o_orderstatus AS patient_type,
               date_trunc('second', o_orderdate) AS admit_date, substring(o_orderpriority, 1, 1) AS source_admission,
               {_left(3)} AS icu_flag, {_left(4)} AS nicu_flag, {_left(6)} AS infection_flag,
               CAST(o_orderkey % 73 AS DOUBLE) AS total_days_in_icu, CAST(o_orderkey % 74 AS DOUBLE) AS diagnosis_count,
               {_left(11)} AS renal_urologic_flag, {_left(7)} AS medical_complication_flag,
               {_left(8)} AS surgical_complication_flag, lpad({_left(1000)}, 3, '0') AS icd_code,
               lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS icd_title, {_left(9)} AS severity_level,
               {_left(10)} AS risk_of_mortality
        FROM orders""",
    "discharge_billing": f"""
        SELECT o_custkey AS record_id, CAST(o_orderkey AS VARCHAR) AS billing_no, o_totalprice AS billed_charges,
               {', '.join(f'CAST(o_orderkey % {p} AS DOUBLE) AS {name}' for p, name in _AMOUNTS.items())}
        FROM orders""",
    "patient_panel": f"""
        SELECT record_id, "Admit Date", "Hospital", "Gender", "Age", "Diagnosis Count", "ICD Title", "Patient Type",
               "ICU Flag"
        FROM (SELECT o_custkey AS record_id, date_trunc('second', o_orderdate) AS "Admit Date",
                     o_orderpriority AS "Hospital", {_left(2)} AS "Gender", o_custkey % 90 AS "Age",
                     CAST(o_orderkey % 74 AS DOUBLE) AS "Diagnosis Count",
                     lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS "ICD Title", o_orderstatus AS "Patient Type",
                     {_left(3)} AS "ICU Flag",
                     row_number() OVER (PARTITION BY o_custkey
                                        ORDER BY date_trunc('second', o_orderdate) DESC, o_orderkey DESC) AS rn
              FROM orders)
        WHERE rn = 1""",
    "pharmacy_rejects": """
        SELECT CASE WHEN event_id % 7 = 0 THEN 'bad_id' WHEN event_id % 11 = 0 THEN 'bad_date' ELSE 'ok' END AS status,
               count(*) AS n
        FROM events GROUP BY 1""",
    "patient_facts": f"""
        WITH {INF},
        b AS (SELECT o_custkey AS record_id, count(*) AS n_bills,
                     CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_billed
              FROM orders GROUP BY o_custkey),
        g AS (SELECT user_id AS record_id, count(*) AS n_prescriptions,
                     CAST(sum(CAST(json_extract(props, '$.k') AS DECIMAL(18, 2))) AS DOUBLE) AS total_pharmacy
              FROM events GROUP BY user_id),
        p AS (SELECT record_id, string_agg(bacteria, ',' ORDER BY otu DESC, bacteria) AS all_bacteria,
                     string_agg(CAST(otu AS VARCHAR), ',' ORDER BY otu DESC, bacteria) AS all_otu
              FROM inf WHERE bacteria IS NOT NULL GROUP BY record_id)
        SELECT c.c_custkey AS record_id, c.c_name, b.total_billed, b.n_bills, g.total_pharmacy, g.n_prescriptions,
               p.all_bacteria, p.all_otu
        FROM customer c
        LEFT JOIN b ON b.record_id = c.c_custkey
        LEFT JOIN g ON g.record_id = c.c_custkey
        LEFT JOIN p ON p.record_id = c.c_custkey""",
}
