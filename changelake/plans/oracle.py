"""DuckDB SQL for the queries, written apart from the operators: what the results have to be."""

LOG = """log AS (SELECT event_id AS lsn, event_id // 7 AS txn_id, event_id % 7 + 1 AS total_order, user_id,
  CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op, event_type, value, ts, props FROM events)"""
UNITS = LOG + """, units AS (SELECT txn_id, max(lsn) AS last_lsn, count(*) AS event_count FROM log GROUP BY txn_id)"""
GROUPS = "RECURSIVE " + UNITS + """, uneven AS (SELECT txn_id, last_lsn, event_count * CASE WHEN txn_id % 13 = 5 THEN 100 ELSE 1 END AS event_count FROM units),
  running AS (SELECT *, (sum(event_count) OVER (ORDER BY last_lsn))::BIGINT AS upto FROM uneven),
  closings(n, mark) AS (SELECT 0::BIGINT, 0::BIGINT UNION ALL SELECT c.n + 1, (SELECT min(r.upto) FROM running r WHERE r.upto >= c.mark + 500) FROM closings c WHERE c.mark IS NOT NULL),
  grouped AS (SELECT txn_id, last_lsn, event_count, (SELECT count(*) FROM closings c WHERE c.n > 0 AND c.mark < running.upto) + 1 AS commit_id FROM running)"""
COUNTS = LOG + """, observed AS (SELECT txn_id, event_type AS src_table, count(*) AS observed FROM log GROUP BY ALL),
  declared AS (SELECT txn_id, src_table, observed + CASE WHEN txn_id % 50 = 21 AND src_table = min(src_table) OVER (PARTITION BY txn_id) THEN 1 ELSE 0 END AS declared FROM observed)"""
MIXED = LOG + """, k AS (SELECT *, props->>'$.k' AS k FROM log), mixed AS (SELECT lsn, event_type, CASE lsn % 5
  WHEN 0 THEN '{"a": ' || k || ', "b": ' || k || ', "c": true}' WHEN 1 THEN '{"a": ' || k || ', "b": ' || k || '.5, "c": null}'
  WHEN 2 THEN '{"a": null, "b": 1, "c": false, "d": "x' || k || '"}' WHEN 3 THEN '{"a": 4, "e": {"z": 1}, "d": 7}' ELSE '{"e": [1, 2], "f": null}' END AS js FROM k)"""
PRESENT = MIXED + """, present AS (SELECT event_type AS target, lsn, unnest(json_keys(js)) AS column_name FROM mixed)"""
ORDINALS = LOG + """, numbered AS (SELECT event_type AS src_table, lsn, row_number() OVER (PARTITION BY event_type ORDER BY lsn) AS ordinal FROM log)"""
EPOCHS = LOG + """, cut AS (SELECT *, lsn % 997 = 500 AS is_truncate, sum((lsn % 997 = 500)::INT) OVER (PARTITION BY event_type ORDER BY lsn) AS epoch FROM log),
  ends AS (SELECT *, max(epoch) OVER (PARTITION BY event_type) AS last_epoch FROM cut)"""
RELATIONS = """known(schema, "table", oid, reltype_oid, published, columns) AS (VALUES ('app','a',1,10,true,'x'),('app','b',2,20,true,'x'),('app','c',3,30,true,'x'),('app','d',4,40,true,'x'),('app','e',5,50,false,'x'),('gone','f',6,60,true,'x'),('app','g',7,70,true,'x')),
  seen(schema, "table", oid, reltype_oid, published, columns) AS (VALUES ('app','a',1,10,true,'x'),('app','b',22,21,true,'x'),('app','d',4,40,false,'x'),('app','e',5,50,true,'x'),('app','g',7,70,true,'x,y'),('app','h',8,80,true,'x'))"""

SQL = {
    "event_identity": f"WITH {LOG} SELECT lsn, lsn || ':' || txn_id || ':' || total_order AS event_id FROM log",
    "envelope_decode": f"WITH {LOG} SELECT 'data' AS kind, op, 'users' AS src_table, lsn, txn_id::VARCHAR AS txn_id, total_order, CASE WHEN op <> 'd' THEN user_id END AS after_user, user_id AS key_user FROM log",
    "json_props_decode": f"WITH {LOG} SELECT lsn, json_extract_string(props, '$.k')::BIGINT AS k FROM log",
    "destination_rows": f"WITH {LOG} SELECT user_id, value, op AS dbz_op, lsn AS dbz_lsn, txn_id AS dbz_tx_id, total_order AS cdcf_total_order, lsn || ':' || txn_id || ':' || total_order AS cdcf_event_id, epoch_us(ts) // 1000 AS dbz_source_ts_ms FROM log",
    "identifier_names": r"SELECT DISTINCT p_type || ' ' || p_brand AS name, lower(regexp_replace(regexp_replace(p_type || ' ' || p_brand, '([a-z0-9])([A-Z])', '\1_\2', 'g'), '[^A-Za-z0-9_]+', '_', 'g')) AS snake FROM part",
    "captured_tables": f"WITH {LOG} SELECT 'configured' AS mode, event_type, count(*) AS events FROM log WHERE event_type IN ('click', 'purchase') GROUP BY ALL UNION ALL SELECT 'discovery', event_type, count(*) FROM log GROUP BY ALL",
    "txn_completeness": f"""WITH {COUNTS}, wrong AS (SELECT DISTINCT d.txn_id FROM declared d JOIN observed o USING (txn_id, src_table) WHERE d.declared <> o.observed)
      SELECT txn_id, count(*) AS events, 7 + CASE WHEN txn_id % 50 = 13 THEN 1 ELSE 0 END::BIGINT AS declared, max(lsn) AS last_lsn,
        count(*) = 7 + CASE WHEN txn_id % 50 = 13 THEN 1 ELSE 0 END AND min(total_order) = 1 AND max(total_order) = count(*) AND txn_id NOT IN (FROM wrong) AS complete FROM log GROUP BY txn_id""",
    "txn_table_counts": f"WITH {COUNTS} SELECT txn_id, src_table, declared, observed FROM declared JOIN observed USING (txn_id, src_table) WHERE declared <> observed",
    "txn_incomplete_tail": f"WITH {LOG} SELECT txn_id, lsn, total_order FROM log WHERE txn_id NOT IN (SELECT txn_id FROM log WHERE total_order = 7)",
    "ordinal_gap_check": f"""WITH {LOG}, p AS (SELECT txn_id, lsn AS seq, lsn * 128 - CASE WHEN lsn % 89 = 7 THEN 300 ELSE 0 END AS lsn, total_order FROM log WHERE lsn % 97 <> 5),
        x AS (SELECT *, lag(total_order) OVER w AS b, lag(lsn) OVER w AS lb FROM p WINDOW w AS (PARTITION BY txn_id ORDER BY seq))
      SELECT txn_id, lsn, total_order, coalesce(b, 0) AS previous_order, coalesce(lsn < lb, false) AS steps_back FROM x WHERE total_order <> coalesce(b, 0) + 1 OR lsn < lb""",
    "unit_statistics": f"WITH {LOG} SELECT txn_id, greatest(max(lsn), max(CASE WHEN total_order = 7 THEN lsn + txn_id % 3 END)) AS last_lsn, count(*) AS event_count, array_to_string(list_sort(list_distinct(list(event_type))), ',') AS tables, arg_min(event_type, lsn) AS first_table, arg_max(event_type, lsn) AS last_table, max(ts) AS max_source_ts FROM log GROUP BY 1",
    "replay_fence": f"WITH {UNITS} SELECT last_lsn <= (SELECT max(last_lsn) * 2 // 5 FROM units) AS fenced, count(*) AS units, sum(event_count)::BIGINT AS events, min(last_lsn) AS lo, max(last_lsn) AS hi FROM units GROUP BY 1",
    "watermark_fence": f"WITH {UNITS} SELECT event_type, count(*) AS kept, min(lsn) AS first_lsn FROM log JOIN units USING (txn_id) WHERE last_lsn >= CASE event_type WHEN 'click' THEN 3000 WHEN 'view' THEN 6000 ELSE 0 END GROUP BY 1",
    "schema_epoch_split": f"WITH {UNITS} SELECT CASE WHEN txn_id % 101 = 3 AND txn_id % 7 = 3 THEN 'mixed' WHEN last_lsn > (SELECT max(last_lsn) // 2 FROM units) OR txn_id % 101 = 3 THEN 'after' ELSE 'before' END AS epoch, count(*) AS units, min(last_lsn) AS lo, max(last_lsn) AS hi FROM units GROUP BY 1",
    "commit_groups": f"WITH {GROUPS} SELECT commit_id, count(*) AS units, sum(event_count)::BIGINT AS events, min(last_lsn) AS first_lsn, max(last_lsn) AS last_lsn FROM grouped GROUP BY 1",
    "keyed_current_state": f"WITH {LOG} SELECT user_id, lsn, op, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS n FROM log) WHERE n = 1 AND op <> 'd'",
    "physical_row_fold": f"""WITH {LOG}, x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS n FROM log)
      SELECT user_id, CASE op WHEN 'd' THEN 'delete' ELSE 'upsert' END AS action, CASE WHEN op <> 'd' THEN lsn END AS lsn, NULL::VARCHAR AS ambiguous FROM x WHERE n = 1""",
    "fold_scenarios": """SELECT * FROM (VALUES ('deferred permutation','2','a'),('deferred permutation','3','b'),('chain','3','a'),('two transactions','2','a'),('two transactions','3','b'),
      ('two rows wear one key','3','b'),('untouched row keeps its origin','2','b'),('untouched row keeps its origin','5','a'),('unattributable delete','refused',NULL),('key-only delete','1','a'),
      ('truncate then key move','2','z'),('reuse then truncate','5','final'),('insert around a truncate','61','q'),('two rows at the end','refused',NULL)) t(scenario, key, v)""",
    "pk_update_move": "SELECT 'remove' AS kind, count(*) AS ops, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders UNION ALL SELECT 'place', count(*), min(o_orderkey) + 1000000, max(o_orderkey) + 1000000 FROM orders",
    "keyless_changelog": """WITH r AS (SELECT *, concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::BIGINT, l_shipdate::DATE) AS n FROM lineitem)
      SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, op AS dbz_op, n || ':' || op AS cdcf_event_id FROM r, (VALUES ('c'), ('d')) o(op) WHERE op = 'c' OR l_returnflag = 'R'""",
    "truncate_survivors": f"WITH {EPOCHS} SELECT event_type, lsn, user_id FROM ends WHERE NOT is_truncate AND epoch = last_epoch",
    "truncate_rows_removed": f"""WITH {LOG}, cuts AS (SELECT 'users_' || (lsn // 997) % 4 AS target, lsn * 2 + 1 AS seq, row_number() OVER (PARTITION BY (lsn // 997) % 4 ORDER BY lsn) - 1 AS epoch FROM log WHERE lsn % 997 = 500),
        o AS (SELECT 'users_' || user_id % 4 AS target, user_id, lsn, op, (SELECT count(*) FROM cuts c WHERE c.target = 'users_' || log.user_id % 4 AND c.seq < log.lsn * 2) AS epoch FROM log),
        last AS (SELECT target, epoch, user_id, arg_max(op, lsn) AS op FROM o GROUP BY 1, 2, 3), live AS (SELECT target, epoch, count(*) AS n FROM last WHERE op <> 'd' GROUP BY 1, 2),
        held AS (SELECT 'users_' || c_custkey % 4 AS target, count(*) AS n FROM customer GROUP BY 1)
      SELECT c.target, c.seq, c.epoch, coalesce(l.n, 0) + CASE WHEN c.epoch = 0 THEN coalesce(h.n, 0) ELSE 0 END AS rows_removed FROM cuts c LEFT JOIN live l USING (target, epoch) LEFT JOIN held h USING (target)""",
    "null_safe_delete": "WITH r AS (SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS seg, c_nationkey AS nation, c_custkey FROM customer), k AS (SELECT DISTINCT seg, nation FROM r WHERE c_custkey % 5 = 0 AND nation < 8) SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.seg IS NOT DISTINCT FROM r.seg AND k.nation IS NOT DISTINCT FROM r.nation)",
    "merge_orders": "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 9 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 9 <> 2 UNION ALL SELECT o_orderkey + 10000000, o_custkey, 'N' FROM orders WHERE o_orderkey % 1000 = 7",
    "identity_duplicates": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "type_inference": f"""WITH {MIXED}, t AS (SELECT c AS column_name, CASE json_type(js, '$.' || c) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'OBJECT' THEN 'JSON' WHEN 'ARRAY' THEN 'JSON' WHEN 'NULL' THEN NULL ELSE json_type(js, '$.' || c) END AS k FROM mixed, (VALUES ('a'),('b'),('c'),('d'),('e'),('f')) v(c))
      SELECT column_name, CASE WHEN count(DISTINCT k) = 0 THEN 'unknown' WHEN count(DISTINCT k) = 1 THEN max(k) WHEN bool_and(k IS NULL OR k IN ('BIGINT', 'DOUBLE')) THEN 'DOUBLE' ELSE 'VARCHAR' END AS kind FROM t GROUP BY 1""",
    "bind_values": f"""WITH {LOG}, r AS (SELECT lsn, CASE lsn % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'T' WHEN 2 THEN lsn::VARCHAR WHEN 3 THEN lsn || '.5' WHEN 4 THEN 'oops' END AS raw FROM log)
      SELECT lsn, CASE WHEN raw IS NOT NULL THEN lower(trim(raw)) IN ('true', 't', '1') END AS as_boolean, CASE WHEN lsn % 6 = 0 THEN 1 WHEN lsn % 6 = 2 THEN lsn END::BIGINT AS as_bigint, CASE lsn % 6 WHEN 2 THEN lsn WHEN 3 THEN lsn + 0.5 END::DOUBLE AS as_double FROM r""",
    "column_diff": """SELECT * FROM (VALUES (2::INT,'renamed','name','full_name',false,2::INT),(3,'dropped','city',NULL,false,1),(4,'type_changed','zip','zip',false,4),(5,'added',NULL,'email',false,4),(6,'renamed','note','city',true,2)) t(attnum, kind, old_name, new_name, also_retyped, step)""",
    "source_types": """SELECT * FROM (VALUES ('smallint','BIGINT'),('integer','BIGINT'),('bigint','BIGINT'),('real','DOUBLE'),('double precision','DOUBLE'),('numeric(30,10)','DOUBLE'),('numeric','DOUBLE'),('boolean','BOOLEAN'),('character(4)','VARCHAR'),('character varying(8)','VARCHAR'),('text','VARCHAR'),('bytea','VARCHAR'),('date','VARCHAR'),('time without time zone','VARCHAR'),('interval','VARCHAR'),('uuid','VARCHAR'),('json','JSON'),('jsonb','JSON'),('integer[]','VARCHAR'),('inet','VARCHAR'),('money','VARCHAR'),('point','VARCHAR')) t(formatted, kind)""",
    "add_column_backfill": "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders",
    "keyless_uniform_backfill": "SELECT c AS column_name, v AS value, d AS decision, n AS rows FROM (SELECT count(*) AS n FROM lineitem), (VALUES ('l_returnflag', NULL, 'refuse'), ('added', 'v1', 'backfill'), ('empty', NULL, 'backfill')) t(c, v, d)",
    "rename_merge": f"WITH {LOG} SELECT lsn, CASE WHEN lsn % 3 = 0 THEN CASE WHEN lsn % 12 = 0 THEN 'late' END ELSE event_type END AS new_kind FROM log",
    "column_presence": f"WITH {PRESENT} SELECT target, column_name, count(*) AS events FROM present GROUP BY 1, 2",
    "unexplained_fields": f"WITH {PRESENT} SELECT DISTINCT target, column_name FROM present WHERE column_name IN ('e', 'f')",
    "snapshot_ordinal": f"WITH {ORDINALS} FROM numbered",
    "snapshot_chunks": f"""WITH {LOG}, numbered AS (SELECT event_type AS src_table, strlen(props) AS b, row_number() OVER w AS ordinal, sum(strlen(props)) OVER w - strlen(props) AS before FROM log WINDOW w AS (PARTITION BY event_type ORDER BY lsn)),
        c AS (SELECT src_table, count(*) AS rows, min(ordinal) AS first, max(ordinal) AS last FROM numbered GROUP BY src_table, (ordinal - 1) // 300, before // 2000)
      SELECT src_table, row_number() OVER (PARTITION BY src_table ORDER BY first) - 1 AS chunk, rows, first, last, last = max(last) OVER (PARTITION BY src_table) AS is_last FROM c""",
    "snapshot_event_ids": f"WITH {ORDINALS} SELECT lsn, 'snap:3:app.' || src_table || ':' || ordinal AS event_id FROM numbered",
    "snapshot_completion_counts": f"""WITH {LOG}, n AS (SELECT event_type AS src_table, count(*) AS n FROM log GROUP BY 1), x AS (SELECT src_table, CASE WHEN src_table <> 'error' THEN n + (src_table = 'click')::INT END::BIGINT AS declared, CASE WHEN src_table <> 'view' THEN n END AS committed FROM n)
      SELECT *, coalesce(declared = committed, false) AS complete FROM x""",
    "verified_empty": "SELECT * FROM (VALUES ('a','verified_empty',10::BIGINT),('b','loaded',NULL),('c','owed',NULL),('d','owed',NULL),('e','unobservable',NULL)) t(src_table, verdict, fence_lsn)",
    "shadow_swap_state": "SELECT c_custkey, c_mktsegment, 4::BIGINT AS snapshot_epoch FROM customer WHERE c_custkey % 3 <> 0",
    "recovery_owed": f"WITH {LOG} SELECT DISTINCT event_type AS src_table, 'owed' AS why FROM log WHERE event_type IN ('view', 'error') UNION ALL SELECT DISTINCT event_type, 'unfinished' FROM log WHERE event_type <> 'click'",
    "interrupted_snapshots": "SELECT * FROM (VALUES ('click','complete'),('view','awaiting_snapshot'),('error','awaiting_snapshot'),('signup','none')) t(src_table, snapshot_state)",
    "catalog_changes": f"""WITH {RELATIONS}, x AS (SELECT coalesce(k.schema, o.schema) AS schema, coalesce(k."table", o."table") AS "table", k.oid::BIGINT AS old_oid, o.oid::BIGINT AS new_oid,
        CASE WHEN k.oid IS NULL THEN 'new' WHEN o.oid IS NULL THEN 'dropped' WHEN (k.oid, k.reltype_oid) <> (o.oid, o.reltype_oid) THEN 'recreated' WHEN k.published AND NOT o.published THEN 'unpublished' WHEN o.published AND NOT k.published THEN 'republished' WHEN k.columns <> o.columns THEN 'schema' END AS kind
        FROM known k FULL JOIN seen o ON k.schema = o.schema AND k."table" = o."table") SELECT * FROM x WHERE kind IS NOT NULL AND schema IN (SELECT schema FROM seen)""",
    "schema_liveness": f"WITH {RELATIONS} SELECT s.schema, count(o.oid) AS relations, count(o.oid) > 0 AS visible FROM (VALUES ('app'), ('gone')) s(schema) LEFT JOIN seen o USING (schema) GROUP BY 1",
    "confirm_streak": f"""WITH {LOG}, p AS (SELECT user_id AS relation, lsn // 150 AS poll, min(event_type) AS shape FROM log GROUP BY 1, 2),
        f AS (SELECT *, CASE WHEN shape = lag(shape) OVER w AND poll = lag(poll) OVER w + 1 THEN 0 ELSE 1 END AS fresh FROM p WINDOW w AS (PARTITION BY relation ORDER BY poll)),
        g AS (SELECT *, sum(fresh) OVER (PARTITION BY relation ORDER BY poll) AS streak FROM f)
      SELECT relation, shape, min(poll) AS first_poll, min(poll) + 1 AS confirmed_at, count(*) AS polls FROM g GROUP BY relation, streak, shape HAVING count(*) >= 2""",
    "mass_drop_breaker": f"""WITH {LOG}, c AS (SELECT txn_id AS plan_id, lsn, CASE WHEN event_type = 'error' AND lsn % 2 = 0 THEN 'dropped' WHEN event_type = 'signup' AND lsn % 3 = 0 THEN 'recreated' ELSE 'schema' END AS kind FROM log)
      SELECT *, CASE WHEN kind <> 'schema' AND count(*) FILTER (kind <> 'schema') OVER (PARTITION BY plan_id) > 1 THEN 'refused' ELSE 'apply' END AS decision FROM c""",
    "lsn_fence": f"WITH {LOG} SELECT user_id AS relation, lsn AS detected_lsn, grace::INT AS grace FROM log, (VALUES (0), (64)) g(grace) WHERE lsn <= (SELECT max(lsn) // 3 FROM log) + grace",
    "unrelatable_relations": f"WITH {LOG} SELECT user_id AS relation, count(*) AS rows FROM log WHERE user_id % 4 = 1 GROUP BY 1",
    "column_lists": "SELECT * FROM (VALUES ('app','a','1:col1:bigint,2:col2:bigint,3:col3:bigint',3::BIGINT),('app','b','1:col1:text,2:col2:text,3:col3:text',3)) t(schema, \"table\", columns, n_columns)",
    "slot_verdicts": """SELECT * FROM (VALUES ('dark','source_unobservable','proceed'),('fresh','fresh_start','proceed'),('unpositioned','fresh_start','proceed'),('populated','no_durable_destination_row','refuse'),('empty','no_durable_destination_row','resnapshot'),('unseen','no_durable_destination_row','refuse'),
      ('clone','source_identity_changed','resnapshot'),('fork','source_timeline_changed','resnapshot'),('rewound','source_lsn_regressed','resnapshot'),('dropped','slot_missing','resnapshot'),('remade','slot_recreated','resnapshot'),('crashed','ok','proceed'),('ahead','slot_ahead_of_destination','resnapshot'),('fine','ok','proceed'),('first look','ok','proceed')) t(name, verdict, action)""",
    "offset_decisions": """SELECT * FROM (VALUES ('nothing','fresh_start'),('orphan','refused_orphan_file'),('orphan accepted','orphan_accepted_resnapshot'),('no file','file_missing_rebuilt'),('no file, no repair','file_missing_repair_disabled'),('no file, no offset','file_missing_no_durable_offset'),('corrupt','file_corrupt_rebuilt'),('ahead','file_ahead_rebuilt'),('behind','file_behind_rebuilt'),('same position, other map','file_offset_mismatch_rebuilt'),('agrees','resume'),('nothing to compare','resume')) t(name, decision)""",
    "state_reachability": "SELECT * FROM (VALUES ('run_phase','stopped'),('run_phase','failed'),('snapshot_completion','streaming'),('destination_ownership','callback_owned'),('catalog_change','applied')) t(machine, state)",
    "commit_log_stats": f"WITH {GROUPS} SELECT commit_id, count(*) AS event_count, count(DISTINCT txn_id) AS txns, arg_min(txn_id, lsn) AS first_txn, arg_max(txn_id, lsn) AS last_txn, min(lsn) AS first_lsn, max(lsn) AS last_lsn, max(ts) AS max_source_ts FROM log JOIN grouped USING (txn_id) GROUP BY 1",
    "ledger_balance": f"WITH {GROUPS} SELECT count(DISTINCT commit_id) AS commits, sum(event_count)::BIGINT AS events, (max(commit_id) - count(DISTINCT commit_id))::BIGINT AS gaps, 0::BIGINT AS falls FROM grouped",
    "one_commit_per_txn": f"WITH {GROUPS} SELECT 1::BIGINT AS commits, count(*) AS txns FROM grouped",
    "op_histogram": f"WITH {LOG} SELECT op, count(*) AS events, count(DISTINCT user_id) AS keys FROM log GROUP BY 1",
    "no_row_lost": f"WITH {LOG} SELECT lsn FROM log WHERE lsn % 97 = 5",
    "applied_counts": f"WITH {LOG} SELECT event_type, count(*) AS applied, count(*) FILTER (op = 'd') AS deletes FROM log GROUP BY 1",
    "refusals_pending": f"WITH {LOG} SELECT user_id AS relation, lsn % 3 AS refusal, max(lsn) AS at, 'pending' AS state FROM log GROUP BY 1, 2 HAVING arg_max(event_type, lsn) = 'error'",
    "snapshot_audit": f"WITH {LOG} SELECT DISTINCT event_type, txn_id, 'completed' AS event FROM log",
    "superseded_changes": f"""WITH {LOG}, c AS (SELECT user_id AS relation, lsn, CASE event_type WHEN 'error' THEN 'dropped' WHEN 'signup' THEN 'present' WHEN 'click' THEN 'recreated' ELSE 'schema' END AS kind FROM log),
        l AS (SELECT relation, max(lsn) FILTER (kind = 'dropped') AS d, max(lsn) FILTER (kind = 'present') AS p, max(lsn) FILTER (kind = 'recreated') AS r, max(lsn) FILTER (kind = 'schema') AS s FROM c GROUP BY 1),
        m AS (SELECT c.*, CASE WHEN lsn < CASE kind WHEN 'dropped' THEN d WHEN 'present' THEN p WHEN 'recreated' THEN r ELSE s END OR (kind = 'dropped' AND (lsn < coalesce(p, -1) OR lsn < coalesce(r, -1))) THEN 'superseded' ELSE 'pending' END AS state FROM c JOIN l USING (relation))
      SELECT relation, kind, state, count(*) AS changes, max(lsn) AS last_lsn FROM m GROUP BY 1, 2, 3""",
    "recovery_journal": "SELECT * FROM (VALUES ('p','offsets_file_deleted','delete_resume_point'),('q','requested','delete_offsets_file'),('r','armed','rebuild'),('s','resume_point_deleted','drop_slot')) t(pipeline, phase, next_step)",
    "recovery_finished": "SELECT * FROM (VALUES ('p', true), ('q', true), ('r', false), ('s', false)) t(pipeline, finished)",
    "slot_history": f"""WITH {LOG}, o AS (SELECT user_id AS slot, lsn, CASE WHEN lsn % 11 = 0 THEN 0 ELSE lsn END AS r, CASE WHEN lsn % 22 = 0 THEN 0 ELSE lsn END AS c FROM log),
        h AS (SELECT *, lag(r) OVER w AS pr, lag(c) OVER w AS pc FROM o WINDOW w AS (PARTITION BY slot ORDER BY lsn))
      SELECT slot, CASE WHEN r < pr AND c < pc THEN 'slot_recreated' ELSE 'ok' END AS verdict, count(*) AS seen FROM h GROUP BY 1, 2""",
    "lag_steady": f"""WITH {LOG}, b AS (SELECT user_id, coalesce(max(lsn) FILTER (value > 60), -1) AS broken FROM log GROUP BY 1)
      SELECT user_id AS source, min(lsn) AS steady_since, count(*) AS samples FROM log JOIN b USING (user_id) WHERE lsn > broken GROUP BY 1""",
    "commit_triggers": "SELECT * FROM (VALUES ('a', NULL), ('b', 'age'), ('c', 'bytes'), ('d', 'events'), ('e', 'phase_change'), ('f', 'drained'), ('g', 'events')) t(name, trigger)",
    "resume_point": f"""WITH {COUNTS}, wrong AS (SELECT DISTINCT d.txn_id FROM declared d JOIN observed o USING (txn_id, src_table) WHERE d.declared <> o.observed),
        w AS (SELECT txn_id, max(lsn) AS last_lsn, (txn_id % 50 <> 13 AND txn_id NOT IN (FROM wrong) AND count(*) = 7) OR txn_id < (SELECT max(txn_id) FROM log) - 100 AS complete FROM log GROUP BY 1)
      SELECT max(last_lsn) AS last_lsn, arg_max(txn_id, last_lsn) AS last_txn_id, count(*) AS units FROM w WHERE complete AND last_lsn < (SELECT min(last_lsn) FROM w WHERE NOT complete)""",
    "truncate_modes": f"WITH {LOG} SELECT event_type, lsn, mode = 'replicate' AS applied, mode FROM log, (VALUES ('replicate'), ('log')) m(mode) WHERE lsn % 997 = 500",
    "telling_columns": f"WITH {LOG} SELECT lsn, CASE WHEN lsn % 2 = 0 THEN 'kind' ELSE 'kind,props' END AS columns FROM log",
    "snapshot_notifications": "SELECT * FROM (VALUES (1::BIGINT,'STARTED',NULL,NULL::BIGINT,NULL),(2,'TABLE_SCAN_COMPLETED','app.a',12,'SUCCEEDED'),(3,'TABLE_SCAN_COMPLETED','app.b',0,'EMPTY'),(4,'COMPLETED',NULL,NULL,NULL)) t(seq, observation, src_table, declared, status)",
    "snapshot_phase": "SELECT * FROM (VALUES ('whole','callbacks_complete'),('one missing','completion_notified'),('running','callbacks_started'),('not begun','awaiting_callbacks')) t(name, state)",
    "snapshot_watermarks": f"WITH {LOG} SELECT event_type AS src_table, max(lsn) AS snapshot_lsn FROM log WHERE event_type = 'click' GROUP BY 1",
    "wal_position": f"WITH {LOG} SELECT user_id AS server, max(CASE WHEN user_id % 4 = 0 THEN CASE WHEN lsn % 2 = 0 THEN lsn - 1 END ELSE lsn END) AS current_lsn FROM log GROUP BY 1",
    "source_catalog": "SELECT * FROM (VALUES ('app','a','id:bigint,v:text','id',true,0::BIGINT),('app','p','at:date','at',true,2)) t(schema, \"table\", columns, key, published, partitions)",
    "synthetic_changes": """WITH d AS (SELECT o_orderkey, o_custkey, ('0x' || substr(md5('42c:' || o_orderkey), 1, 8))::BIGINT % 100 AS c, ('0x' || substr(md5('42i:' || o_orderkey), 1, 8))::BIGINT % 100 AS i FROM orders)
      SELECT o_orderkey, o_custkey, CASE WHEN c < 5 THEN 'd' ELSE 'u' END AS op, o_orderkey * 3 AS seq FROM d WHERE c < 20 UNION ALL SELECT -o_orderkey - 1, o_custkey, 'c', (o_orderkey + 1) * 3 + 2 FROM d WHERE i < 3""",
    "normalized_types": "SELECT * FROM (VALUES ('TINYINT','BIGINT'),('HUGEINT','BIGINT'),('real','DOUBLE'),('FLOAT','DOUBLE'),('Boolean','BOOLEAN'),('JSON','JSON'),('TEXT','VARCHAR'),('TIMESTAMP','VARCHAR'),('DECIMAL(10,2)','VARCHAR')) t(type_name, kind)",
    "stream_faults": f"""WITH {LOG} SELECT seq, txn_id::VARCHAR AS txn_id, rule FROM (SELECT lsn * 4 AS seq, txn_id, CASE WHEN txn_id % 50 = 10 AND total_order = 1 THEN 'another transaction without END' WHEN txn_id % 50 = 17 AND total_order = 3 THEN 'ordinal given twice'
        WHEN txn_id % 50 = 23 AND total_order = 1 THEN 'ordinal below 1' WHEN txn_id % 50 = 31 AND total_order = 4 THEN 'no ordinal' END AS rule FROM log
        UNION ALL SELECT lsn * 4 - 1, txn_id, 'BEGIN while a transaction is open' FROM log WHERE txn_id % 50 = 40 AND total_order = 5) WHERE rule IS NOT NULL""",
    "stream_proofs": f"""WITH {LOG}, p AS (SELECT txn_id, count(*) AS events, max(lsn) AS last_lsn, max(total_order) = 7 AND txn_id % 50 <> 9 AS ended FROM log GROUP BY 1)
      SELECT txn_id::VARCHAR AS txn_id, events, CASE WHEN ended THEN 7::BIGINT END AS declared, last_lsn, ended, CASE WHEN NOT ended THEN 'open' WHEN txn_id % 50 IN (17, 23, 31) THEN 'ordinals' END AS reason FROM p""",
    "control_units": f"WITH {LOG} SELECT lsn * 4 - 1 AS seq, 'heartbeat' AS kind, NULL::VARCHAR AS txn_id, lsn FROM log WHERE txn_id % 50 = 42 AND total_order = 1",
    "phase_groups": f"""WITH {UNITS}, s AS (SELECT *, (txn_id // 100) % 3 = 0 AS is_snapshot FROM units), c AS (SELECT *, coalesce((is_snapshot <> lag(is_snapshot) OVER (ORDER BY last_lsn))::INT, 0) AS changed FROM s),
        g AS (SELECT *, (sum(changed) OVER (ORDER BY last_lsn))::BIGINT AS phase FROM c) SELECT phase, is_snapshot, count(*) AS units, min(last_lsn) AS lo, max(last_lsn) AS hi FROM g GROUP BY ALL""",
    "batched_apply": f"""WITH {LOG}, whole AS (SELECT * FROM log WHERE txn_id IN (SELECT txn_id FROM log WHERE total_order = 7)), x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS n FROM whole)
      SELECT user_id, value, lsn || ':' || txn_id || ':' || total_order AS cdcf_event_id, lsn AS dbz_lsn FROM x WHERE n = 1 AND op <> 'd'""",
    "source_missing_policy": """SELECT src_table, CASE WHEN fate = 'final' THEN CASE WHEN mode = 'replicate' THEN 'dropped' ELSE 'logged' END ELSE fate END AS fate, mode
      FROM (VALUES ('done','kept'),('there','kept'),('gone','final'),('running','owed'),('seen','owed'),('nowhere','owed')) t(src_table, fate), (VALUES ('replicate'),('log'),('ignore')) m(mode)""",
    "consistent_point": f"WITH {LOG}, r AS (SELECT user_id AS image, max(lsn) AS l, user_id % 5 <> 0 AND user_id % 7 = 0 AS refused FROM log GROUP BY 1) SELECT image, CASE WHEN NOT refused THEN l END AS point, refused FROM r",
    "catalog_plan": f"""WITH {LOG}, c AS (SELECT user_id, max(lsn) AS detected_lsn, CASE arg_max(event_type, lsn) WHEN 'error' THEN 'dropped' WHEN 'signup' THEN 'new' ELSE 'schema' END AS kind FROM log GROUP BY 1),
        d AS (SELECT c.*, kind = 'dropped' AND user_id % 3 = 0 AS held, mode, mode LIKE 'replicate%' AND kind = 'dropped' AND user_id % 3 <> 0 AS destroys FROM c, (VALUES ('replicate False'), ('replicate True'), ('log False')) m(mode) WHERE detected_lsn <= (SELECT max(lsn) - 60 FROM log))
      SELECT user_id::VARCHAR AS "table", detected_lsn, kind, CASE WHEN held THEN 'deferred' WHEN destroys AND mode = 'replicate False' AND count(*) FILTER (destroys) OVER (PARTITION BY mode) > 1 THEN 'refused' ELSE 'apply' END AS decision, mode FROM d""",
    "publication_admissions": "SELECT * FROM (VALUES ('ours','admitted','own'),('theirs','external','own'),('every','external','own'),('failed','error','own'),('ours','refused','external'),('theirs','external','external'),('every','external','external'),('failed','refused','external')) t(\"table\", admission, ownership)",
    "identity_metadata": "SELECT * FROM (VALUES ('a','z,x'),('b','k')) t(\"table\", key_columns)",
    "partition_children": "SELECT * FROM (VALUES ('app','p_1','app','p'),('app','p_2','app','p')) t(schema, \"table\", root_schema, root_table)",
    "inspection": f"""WITH {LOG}, p AS (SELECT event_type AS src_table, count(*) AS rows, count(*) FILTER (op = 'c') AS inserts, count(*) FILTER (op = 'u') AS updates, count(*) FILTER (op = 'd') AS deletes, max(lsn) AS last_lsn FROM log GROUP BY 1)
      SELECT coalesce(p.src_table, s.t) AS src_table, coalesce(rows, 0) AS rows, coalesce(inserts, 0) AS inserts, coalesce(updates, 0) AS updates, coalesce(deletes, 0) AS deletes, last_lsn, coalesce(s.c, false) AS complete FROM p FULL JOIN (VALUES ('click', true), ('view', false), ('error', false), ('signup', false)) s(t, c) ON p.src_table = s.t""",
    "acknowledgement_guard": f"""WITH {LOG}, s AS (SELECT user_id AS slot, CASE WHEN user_id % 5 <> 0 THEN max(lsn) END AS confirmed_flush_lsn, CASE WHEN user_id % 3 <> 0 THEN max(lsn) - user_id % 2 END AS durable_lsn, user_id % 2 = 0 AS snapshot_reads_data FROM log GROUP BY user_id),
        d AS (SELECT *, CASE WHEN confirmed_flush_lsn IS NULL THEN 'ok' WHEN durable_lsn IS NULL THEN CASE WHEN snapshot_reads_data THEN 'no_durable_row_full_snapshot' ELSE 'no_durable_destination_row' END WHEN confirmed_flush_lsn > durable_lsn THEN 'slot_ahead_of_destination' ELSE 'ok' END AS decision FROM s)
      SELECT *, decision IN ('ok', 'no_durable_row_full_snapshot') AS ok FROM d""",
    "typed_offsets": f"WITH {LOG} SELECT lsn, 'long' AS kind, lsn % 2 = 0 AS equal FROM log",
}
