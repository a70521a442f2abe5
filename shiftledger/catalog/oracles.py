"""Equivalent SQL of the queries, for DuckDB over the same tables.

Shared sub-selects are named below; each statement gets those it mentions.
"""

from __future__ import annotations

import re

# Hours from whole seconds, halves rounded up on integers.
_HOURS = "((({s}) * 100 + 1800) // 3600)"


def _cents(seconds: str) -> str:
    return _HOURS.format(s=seconds)


_PROJECT_KEY = (
    "CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_custkey + o_orderkey % 40 END"
)
_START = "(o_orderdate + to_seconds((o_orderkey * 7919) % 86400))"
_SECS = "CASE WHEN o_orderkey % 13 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 36000 END"
_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
_RUN = "'2002-01-01 00:00:00'"
_WINDOW = "TIMESTAMP '2000-01-01 00:00:00'"


def _report(entries: str, users: str, bucket: str, label: str) -> str:
    """Monthly or payroll rows over a set of entries, with cents and the raw link."""
    return f"""
    SELECT user_link, user_name, coalesce(raw_project_link, (SELECT link_id FROM projects_t WHERE source_id = 'NO-PROJECT')) AS project_link,
           coalesce(raw_project_name, 'No Project') AS project_name, raw_project_link, {label} AS month, {_cents('secs')} AS cents
    FROM (SELECT u.link_id AS user_link, u.name AS user_name, p.link_id AS raw_project_link, p.name AS raw_project_name,
                 {bucket} AS b, CAST(sum(e.secs) AS BIGINT) AS secs
          FROM {entries} e JOIN {users} u ON e.user_id = u.id LEFT JOIN projects_t p ON e.project_id = p.id
          WHERE e.deleted_at IS NULL AND e.secs IS NOT NULL
          GROUP BY u.link_id, u.name, p.link_id, p.name, {bucket})"""


_MONTH = ("date_trunc('month', e.start_time + INTERVAL 2 HOUR)", "strftime(b, '%B %Y')")
_CYCLE = (
    "date_trunc('month', e.start_time + INTERVAL 2 HOUR - INTERVAL 22 DAY)",
    "'23 ' || strftime(b, '%b') || ' to 22 ' || strftime(b + INTERVAL 1 MONTH, '%b %Y')",
)
_ROW_DIGEST = (
    "md5(coalesce(user_link, '-') || '|' || user_name || '|' || coalesce(raw_project_link, '-')"
    " || '|' || project_name || '|' || month)"
)

_NORM = "lower(trim({0}, E' \\t\\n\\r'))"

CTES = {
    "clients_t": """
    SELECT 'c' || n_nationkey AS id, 'sc' || n_nationkey AS source_id, n_name AS name,
           CASE WHEN n_nationkey % 4 <> 0 THEN 'recC' || n_nationkey END AS link_id FROM nation""",
    "users_t": """
    SELECT 'u' || c_custkey AS id, 'su' || c_custkey AS source_id, c_name AS name,
           CASE WHEN c_custkey % 7 <> 0 THEN lower(c_name) || '@example.com' END AS email,
           CASE WHEN c_custkey % 11 <> 3 THEN 'recU' || c_custkey END AS link_id,
           CASE WHEN c_custkey % 13 = 5 THEN 'S' || c_custkey END AS chat_id, c_mktsegment AS segment FROM customer""",
    "projects_t": """
    SELECT 'p' || p_partkey AS id, CASE WHEN p_partkey = 0 THEN 'NO-PROJECT' ELSE 'sp' || p_partkey END AS source_id,
           CASE WHEN p_partkey = 0 THEN 'No Project' ELSE p_name END AS name, 'c' || (p_partkey % 25) AS client_id,
           CASE WHEN p_partkey = 0 THEN 'recNOPROJ' WHEN p_partkey % 9 <> 0 THEN 'recP' || p_partkey END AS link_id
    FROM part""",
    "entries_t": f"""
    SELECT 'se' || o_orderkey AS source_id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS description,
           {_START} AS start_time, {_SECS} AS secs, 'u' || o_custkey AS user_id, 'p' || ({_PROJECT_KEY}) AS project_id,
           CASE WHEN o_orderkey % 17 = 0 THEN TIMESTAMP '2001-01-01 00:00:00' END AS deleted_at,
           o_orderpriority AS priority FROM orders""",
    "stored_t": "SELECT * FROM entries_t WHERE priority <> '1-URGENT'",
    "current_t": "SELECT * FROM entries_t WHERE priority <> '5-LOW'",
    "extract_t": f"""
    SELECT 'se' || o_orderkey AS source_id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS description,
           {_START} + CASE WHEN o_orderstatus = 'P' THEN INTERVAL 180 DAY ELSE INTERVAL 0 DAY END AS start_time,
           ({_SECS}) + CASE WHEN o_orderstatus = 'P' THEN 600 ELSE 0 END AS secs,
           CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE 'u' || o_custkey END AS user_id,
           CASE WHEN o_orderkey % 41 = 0 THEN 'gone' || o_custkey ELSE 'su' || o_custkey END AS user_source_id,
           'p' || ({_PROJECT_KEY}) AS project_id
    FROM orders WHERE o_orderpriority <> '5-LOW'""",
    "window_t": f"SELECT * FROM extract_t WHERE start_time >= {_WINDOW}",
    "line_users_t": """
    SELECT 'u' || s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 11 <> 3 THEN 'recU' || s_suppkey END AS link_id
    FROM supplier""",
    "line_entries_t": """
    SELECT l_shipdate + to_hours(l_linenumber) AS start_time, CAST(l_quantity * 900 AS BIGINT) AS secs,
           'u' || l_suppkey AS user_id, 'p' || l_partkey AS project_id, NULL AS deleted_at FROM lineitem""",
    "unassigned_t": f"""
    SELECT e.source_id, e.user_id, e.secs, strftime(e.start_time + INTERVAL 2 HOUR, '%Y-%m-%d') AS date,
           coalesce(e.description, '(No description provided)') AS description,
           CAST({_cents('e.secs')} AS DOUBLE) / 100 AS duration_hours
    FROM entries_t e
    WHERE e.start_time >= TIMESTAMP '1998-02-22 22:00:00' AND e.start_time < TIMESTAMP '1998-03-22 22:00:00'
      AND e.deleted_at IS NULL AND e.secs IS NOT NULL AND (e.project_id IS NULL OR e.project_id = 'p0')""",
    "unassigned_hours_t": f"""
    SELECT u.id AS user_id, u.name AS user_name, u.email AS user_email, u.chat_id,
           CAST({_cents('CAST(sum(t.secs) AS BIGINT)')} AS DOUBLE) / 100 AS unassigned_hours, count(*) AS entry_count
    FROM unassigned_t t JOIN users_t u ON t.user_id = u.id GROUP BY ALL HAVING sum(t.secs) > 0""",
    "names_t": """
    SELECT 'user' AS kind, u.name AS name FROM entries_t e JOIN users_t u ON e.user_id = u.id
    WHERE e.deleted_at IS NULL AND e.secs IS NOT NULL AND u.name <> ''
    UNION
    SELECT 'project', coalesce(p.name, 'No Project') FROM entries_t e JOIN users_t u ON e.user_id = u.id
    LEFT JOIN projects_t p ON e.project_id = p.id
    WHERE e.deleted_at IS NULL AND e.secs IS NOT NULL AND coalesce(p.name, 'No Project') <> ''""",
    "stored_users_t": "SELECT * FROM users_t WHERE segment <> 'FURNITURE'",
    "user_extract_t": """
    SELECT 'su' || c_custkey AS source_id,
           CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) ELSE c_name END AS name,
           CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name || '@new.example' END AS email FROM customer""",
    "user_changes_t": """
    SELECT 'added' AS kind, x.name AS text FROM user_extract_t x
    WHERE x.source_id NOT IN (SELECT source_id FROM stored_users_t)
    UNION ALL
    SELECT 'renamed', s.name || ' ➔ ' || x.name FROM user_extract_t x JOIN stored_users_t s USING (source_id)
    WHERE s.name <> x.name""",
    "client_changes_t": """
    SELECT 'added' AS kind, lower(name) AS text FROM clients_t WHERE link_id IS NULL""",
    "project_extract_t": """
    SELECT CASE WHEN p_partkey = 0 THEN 'NO-PROJECT' ELSE 'sp' || p_partkey END AS source_id,
           p_brand || ' ' || p_name AS name, CASE WHEN p_partkey % 30 < 25 THEN 'c' || (p_partkey % 30) END AS client_id
    FROM part""",
    "project_changes_t": """
    SELECT 'added' AS kind, x.name AS text FROM project_extract_t x JOIN projects_t p USING (source_id)
    WHERE p.link_id IS NULL""",
    "scanned_t": "SELECT id AS user_id FROM users_t WHERE email IS NOT NULL",
    "ghosts_t": f"""
    SELECT source_id, user_id FROM stored_t WHERE start_time >= {_WINDOW} AND deleted_at IS NULL
      AND user_id IN (SELECT user_id FROM scanned_t) AND source_id NOT IN (SELECT source_id FROM window_t)""",
    "sync_t": f"""
    SELECT s.source_id, CASE WHEN x.user_id IS NOT NULL THEN x.description ELSE s.description END AS description,
           CASE WHEN x.user_id IS NOT NULL THEN x.start_time ELSE s.start_time END AS start_time,
           CASE WHEN x.user_id IS NOT NULL THEN x.secs ELSE s.secs END AS secs,
           CASE WHEN x.user_id IS NOT NULL THEN x.user_id ELSE s.user_id END AS user_id,
           CASE WHEN x.user_id IS NOT NULL THEN x.project_id ELSE s.project_id END AS project_id,
           CASE WHEN x.user_id IS NOT NULL THEN NULL WHEN g.source_id IS NOT NULL THEN {_RUN}
                ELSE {_TS.format('s.deleted_at')} END AS deleted_at,
           CASE WHEN x.user_id IS NOT NULL OR g.source_id IS NOT NULL THEN {_RUN} END AS updated_at,
           CASE WHEN x.user_id IS NOT NULL THEN 'updated' WHEN g.source_id IS NOT NULL THEN 'deleted' ELSE 'kept' END AS sync_action,
           CASE WHEN x.user_id IS NOT NULL
                THEN s.deleted_at IS NOT NULL OR x.start_time <> s.start_time OR x.secs IS DISTINCT FROM s.secs
                ELSE g.source_id IS NOT NULL END AS sync_changed
    FROM stored_t s LEFT JOIN window_t x USING (source_id) LEFT JOIN ghosts_t g ON g.source_id = s.source_id
    UNION ALL
    SELECT source_id, description, start_time, secs, user_id, project_id, NULL, {_RUN}, 'inserted', true
    FROM window_t WHERE user_id IS NOT NULL AND source_id NOT IN (SELECT source_id FROM stored_t)""",
    "sync_stats_t": """
    SELECT user_id, count(*) FILTER (sync_action IN ('updated', 'inserted')) AS upserted,
           count(*) FILTER (sync_action = 'deleted') AS deleted, count(*) FILTER (sync_changed) AS changed
    FROM sync_t WHERE sync_action <> 'kept' GROUP BY user_id""",
    "report_t": """
    SELECT *, upserted + deleted AS synced,
           upserted > 0 OR deleted > 0 OR new_users > 0 OR renamed_users > 0 OR new_projects > 0 AS has_changes FROM (
      SELECT CAST((SELECT sum(upserted) FROM sync_stats_t) AS BIGINT) AS upserted,
             CAST((SELECT sum(deleted) FROM sync_stats_t) AS BIGINT) AS deleted,
             CAST((SELECT sum(changed) FROM sync_stats_t) AS BIGINT) AS changed,
             (SELECT count(*) FROM user_changes_t WHERE kind = 'added') AS new_users,
             (SELECT count(*) FROM user_changes_t WHERE kind = 'renamed') AS renamed_users,
             (SELECT count(*) FROM project_changes_t) AS new_projects,
             (SELECT count(*) FROM client_changes_t) AS new_clients,
             (SELECT count(*) FROM scanned_t) AS users_scanned)""",
    "name_records_t": """
    SELECT 'recU' || c_custkey AS id, upper(c_name) || ' ' AS name FROM customer
    UNION ALL
    SELECT 'recB' || p_partkey, E'\\t' || upper(p_brand) || ' ' || upper(p_type) || ' ' || p_size FROM part""",
    "name_state_t": f"""
    SELECT {_NORM.format('name')} AS norm, count(*) AS records, CASE WHEN count(*) = 1 THEN min(id) END AS link_id,
           count(*) > 1 AS conflicted FROM name_records_t GROUP BY 1""",
    "unlinked_t": """
    SELECT 'u' || c_custkey AS id, c_name AS name FROM customer
    UNION ALL
    SELECT 'b' || p_partkey, p_brand || ' ' || p_type || ' ' || (p_size + 1) FROM part""",
    "resolved_t": f"""
    SELECT m.id, m.name, CASE WHEN s.conflicted THEN 'conflict' WHEN s.link_id IS NOT NULL THEN 'heal' ELSE 'create' END AS action,
           s.link_id FROM unlinked_t m LEFT JOIN name_state_t s ON {_NORM.format('m.name')} = s.norm""",
    "prev_monthly_t": _report("stored_t", "users_t", *_MONTH),
    "cur_monthly_t": _report("current_t", "users_t", *_MONTH),
    "prev_payroll_t": _report("stored_t", "users_t", *_CYCLE),
    "cur_payroll_t": _report("current_t", "users_t", *_CYCLE),
    "prev_index_t": """
    SELECT DISTINCT project_link, strftime(strptime('1 ' || month, '%d %B %Y'), '%Y-%m-%d') AS month_date,
           'rec' || substr(md5(project_link || '|' || month), 1, 14) AS assignment_id
    FROM prev_monthly_t WHERE project_link IS NOT NULL""",
    "cur_pairs_t": """
    SELECT DISTINCT project_link, strftime(strptime('1 ' || month, '%d %B %Y'), '%Y-%m-%d') AS month_date
    FROM cur_monthly_t WHERE project_link IS NOT NULL""",
    "missing_pairs_t": """
    SELECT c.project_link, c.month_date FROM cur_pairs_t c ANTI JOIN prev_index_t p USING (project_link, month_date)""",
    "full_index_t": """
    SELECT project_link, month_date, assignment_id FROM prev_index_t
    UNION ALL
    SELECT project_link, month_date, 'new' || substr(md5(project_link || '|' || month_date), 1, 14) FROM missing_pairs_t""",
    "pay_dest_t": f"""
    SELECT 'rec' || substr(d, 1, 14) AS id, d AS pos, coalesce(user_link, 'no_user') AS uk,
           coalesce(project_link, 'no_project') AS pk, month AS mk,
           CASE WHEN cents % 7 = 0 THEN 'absent' WHEN cents % 11 = 0 THEN 'other' ELSE 'number' END AS kind,
           CASE WHEN cents % 7 <> 0 AND cents % 11 <> 0 THEN CAST(cents AS DOUBLE) / 100 END AS actual
    FROM (SELECT *, {_ROW_DIGEST} AS d FROM prev_payroll_t)""",
    "pay_index_t": """
    SELECT * FROM pay_dest_t QUALIFY row_number() OVER (PARTITION BY uk, pk, mk ORDER BY pos DESC, id DESC) = 1""",
    "pay_judged_t": """
    SELECT s.*, CAST(s.cents AS DOUBLE) / 100 AS hours, i.id AS record_id,
           CASE WHEN i.id IS NOT NULL THEN
                     CASE WHEN abs(CAST(s.cents AS DOUBLE) / 100 - coalesce(i.actual, 0)) > 0.01
                            OR (s.cents = 0 AND i.kind = 'absent') THEN 'update' ELSE 'unchanged' END
                WHEN s.user_link IS NOT NULL THEN 'insert' ELSE 'missing' END AS outcome
    FROM cur_payroll_t s LEFT JOIN pay_index_t i
      ON coalesce(s.user_link, 'no_user') = i.uk AND coalesce(s.project_link, 'no_project') = i.pk AND s.month = i.mk""",
    "pay_stale_t": """
    SELECT id FROM pay_dest_t WHERE kind <> 'absent' AND coalesce(actual <> 0, true)
      AND id NOT IN (SELECT record_id FROM pay_judged_t WHERE record_id IS NOT NULL)""",
    "pay_updates_t": """
    SELECT record_id, hours AS set_actual, user_name, project_name, raw_project_link, user_link FROM pay_judged_t
    WHERE outcome = 'update'
    UNION ALL SELECT id, 0.0, NULL, NULL, NULL, NULL FROM pay_stale_t""",
    "pay_deduped_t": """
    SELECT record_id, set_actual FROM pay_updates_t
    QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY user_name DESC NULLS LAST, project_name DESC NULLS LAST,
            raw_project_link DESC NULLS LAST, user_link DESC NULLS LAST, set_actual DESC) = 1""",
    "asg_dest_t": f"""
    SELECT 'rec' || substr(d, 1, 14) AS id, d AS pos, user_link AS uk,
           'rec' || substr(md5(project_link || '|' || month), 1, 14) AS ak, CAST(cents AS DOUBLE) / 100 AS actual,
           cents % 5 = 0 AS unassigned
    FROM (SELECT *, {_ROW_DIGEST} AS d FROM prev_monthly_t) WHERE project_link IS NOT NULL AND user_link IS NOT NULL""",
    "asg_index_t": """
    SELECT * FROM asg_dest_t QUALIFY row_number() OVER (PARTITION BY uk, ak ORDER BY pos DESC, id DESC) = 1""",
    "asg_judged_t": """
    SELECT s.*, CAST(s.cents AS DOUBLE) / 100 AS hours, f.assignment_id, i.id AS record_id,
           abs(CAST(s.cents AS DOUBLE) / 100 - i.actual) > 0.01 AS differs, i.unassigned,
           CASE WHEN s.project_link IS NULL THEN 'skipped'
                WHEN i.id IS NOT NULL THEN
                     CASE WHEN abs(CAST(s.cents AS DOUBLE) / 100 - i.actual) > 0.01 OR i.unassigned THEN 'update' ELSE 'unchanged' END
                WHEN s.user_link IS NOT NULL AND f.assignment_id IS NOT NULL THEN 'insert' ELSE 'missing' END AS outcome
    FROM cur_monthly_t s
    LEFT JOIN full_index_t f ON f.project_link = s.project_link
         AND f.month_date = strftime(strptime('1 ' || s.month, '%d %B %Y'), '%Y-%m-%d')
    LEFT JOIN asg_index_t i ON i.uk = s.user_link AND i.ak = f.assignment_id""",
    "asg_stale_t": """
    SELECT id FROM asg_dest_t WHERE actual <> 0
      AND id NOT IN (SELECT record_id FROM asg_judged_t WHERE record_id IS NOT NULL)""",
    "asg_updates_t": """
    SELECT record_id, CASE WHEN differs THEN hours END AS set_actual, CASE WHEN unassigned THEN CAST(0 AS DOUBLE) END AS set_assigned
    FROM asg_judged_t WHERE outcome = 'update'
    UNION ALL SELECT id, 0.0, NULL FROM asg_stale_t""",
    "roster_t": """
    SELECT 'S' || c_custkey AS id, upper(c_name) AS name,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN ' ' || upper(c_name) || '@EXAMPLE.COM' END AS email, c_custkey AS pos
    FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""",
    "by_email_t": "SELECT lower(trim(email)) AS k, arg_min(id, pos) AS id FROM roster_t WHERE email IS NOT NULL GROUP BY 1",
    "by_name_t": "SELECT lower(trim(name)) AS k, arg_min(id, pos) AS id FROM roster_t GROUP BY 1",
    "matched_t": """
    SELECT u.id AS user_id, u.name AS user_name, u.email AS user_email, u.chat_id,
           coalesce(u.chat_id, e.id, n.id) AS matched_chat_id,
           CASE WHEN u.chat_id IS NOT NULL THEN 'cache' WHEN e.id IS NOT NULL THEN 'email' WHEN n.id IS NOT NULL THEN 'name' END AS matched_by
    FROM users_t u LEFT JOIN by_email_t e ON lower(trim(u.email)) = e.k LEFT JOIN by_name_t n ON lower(trim(u.name)) = n.k""",
    "raw_entries_t": f"""
    SELECT 'se' || o_orderkey AS id, o_orderpriority AS description, {_START} AS start_time, {_SECS} AS secs,
           'sp' || ({_PROJECT_KEY}) AS project_source_id, 'su' || o_custkey AS user_source_id,
           o_orderkey % 29 = 2 AS no_user, o_orderkey % 37 = 1 AS bad_duration FROM orders""",
    "dated_t": """
    SELECT md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|' || CAST(l_quantity AS BIGINT)) AS d,
           CASE WHEN l_linenumber = 2 THEN '' ELSE 'recP' || l_partkey END AS project_link,
           strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month_date FROM lineitem""",
}

_ENTRY = f"""source_id, description, {_TS.format('start_time')} AS start_time, secs * 1000000 AS duration_us, user_id, project_id"""
_HOURS_COLUMNS = "user_link, user_name, project_link, project_name, month, CAST(cents AS DOUBLE) / 100 AS total_hours"


def _merged_entries(extract: str) -> str:
    """Stored entries after merging an extract."""
    pick = ", ".join(
        f"CASE WHEN x.user_id IS NOT NULL THEN x.{c} ELSE s.{c} END AS {c}"
        for c in ("description", "start_time", "secs", "user_id", "project_id")
    )
    return f"""
    SELECT {_ENTRY}, deleted_at, updated_at FROM (
      SELECT s.source_id, {pick},
             CASE WHEN x.user_id IS NULL THEN {_TS.format('s.deleted_at')} END AS deleted_at,
             CASE WHEN x.user_id IS NOT NULL THEN {_RUN} END AS updated_at
      FROM stored_t s LEFT JOIN {extract} x USING (source_id)
      UNION ALL
      SELECT source_id, description, start_time, secs, user_id, project_id, NULL, {_RUN}
      FROM {extract} WHERE user_id IS NOT NULL AND source_id NOT IN (SELECT source_id FROM stored_t))"""


_STATEMENTS = {
    "monthly_hours": f"SELECT {_HOURS_COLUMNS} FROM ({_report('entries_t', 'users_t', *_MONTH)})",
    "monthly_hours_incremental": f"SELECT {_HOURS_COLUMNS} FROM ({_report('sync_t', 'users_t', *_MONTH)})",
    "payroll_hours_incremental": f"SELECT {_HOURS_COLUMNS} FROM ({_report('sync_t', 'users_t', *_CYCLE)})",
    "changed_hours": """
    SELECT user_id, project_id, strftime(start_time + INTERVAL 2 HOUR, '%Y-%m') AS month,
           strftime(start_time + INTERVAL 2 HOUR - INTERVAL 22 DAY, '%Y-%m') AS cycle, CAST(sum(sign * secs) AS BIGINT) AS seconds, CAST(sum(sign) AS BIGINT) AS n
    FROM (SELECT user_id, project_id, start_time, secs, 1 AS sign FROM sync_t WHERE deleted_at IS NULL AND secs IS NOT NULL
          UNION ALL
          SELECT user_id, project_id, start_time, secs, -1 FROM stored_t WHERE deleted_at IS NULL AND secs IS NOT NULL)
    GROUP BY ALL HAVING sum(sign * secs) <> 0 OR sum(sign) <> 0""",
    "payroll_hours": f"SELECT {_HOURS_COLUMNS} FROM ({_report('entries_t', 'users_t', *_CYCLE)})",
    "monthly_hours_lines": f"SELECT {_HOURS_COLUMNS} FROM ({_report('line_entries_t', 'line_users_t', *_MONTH)})",
    "payroll_hours_lines": f"SELECT {_HOURS_COLUMNS} FROM ({_report('line_entries_t', 'line_users_t', *_CYCLE)})",
    "active_entries": f"""
    SELECT source_id, user_id, project_id, {_TS.format('start_time')} AS start_time, secs * 1000000 AS duration_us
    FROM entries_t WHERE deleted_at IS NULL AND secs IS NOT NULL""",
    "active_names": "SELECT kind, name FROM names_t",
    "cycle_bounds": f"""
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day,
           {_TS.format("date_trunc('month', o_orderdate - INTERVAL 22 DAY) + INTERVAL 22 DAY - INTERVAL 2 HOUR")} AS cycle_start,
           {_TS.format("date_trunc('month', o_orderdate - INTERVAL 22 DAY) + INTERVAL 1 MONTH + INTERVAL 22 DAY - INTERVAL 2 HOUR")} AS cycle_end
    FROM orders""",
    "unassigned_hours": "SELECT * FROM unassigned_hours_t",
    "unassigned_time": """
    SELECT h.*, t.source_id, t.date, t.description, t.duration_hours FROM unassigned_hours_t h JOIN unassigned_t t USING (user_id)""",
    "entry_items_json": """
    SELECT source_id, user_id, '{"date":"' || date || '","description":' || to_json(description) || ',"hours":'
           || printf('%.2f', duration_hours) || '}' AS item FROM unassigned_t""",
    "unassigned_entries": "SELECT source_id, user_id, date, description, duration_hours FROM unassigned_t",
    "users_default_name": """
    SELECT source_id, coalesce(name, email, 'Unknown User') AS name, email, status FROM (
      SELECT 'su' || c_custkey AS source_id,
             CASE WHEN c_custkey % 3 <> 0 THEN c_name WHEN c_custkey % 9 = 0 THEN '' END AS name,
             CASE WHEN c_custkey % 5 <> 0 THEN lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
             c_mktsegment AS status FROM customer)""",
    "flat_entries": f"""
    SELECT id AS source_id, description, {_TS.format('start_time')} AS start_time, secs * 1000000 AS duration_us,
           user_source_id, project_source_id FROM raw_entries_t WHERE NOT no_user AND NOT bad_duration""",
    "rejected_entries": """
    SELECT id, concat_ws(',', CASE WHEN no_user THEN 'userId' END, CASE WHEN bad_duration THEN 'duration' END) AS reasons
    FROM raw_entries_t WHERE no_user OR bad_duration""",
    "user_window": f"""
    SELECT source_id, user_id, {_TS.format('start_time')} AS start_time FROM entries_t
    WHERE start_time >= {_WINDOW} AND user_id IN (SELECT id FROM users_t WHERE link_id IS NOT NULL)""",
    "destination_cells": """
    SELECT 'ev' || event_id AS id, CASE WHEN json_extract(props, '$.k') IS NULL THEN 'absent' ELSE 'number' END AS kind,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS number FROM events""",
    "cell_kinds": """
    SELECT 'ev' || event_id AS id,
           CASE event_id % 4 WHEN 0 THEN 'number' WHEN 1 THEN 'null' WHEN 2 THEN 'other' ELSE 'absent' END AS kind,
           CASE WHEN event_id % 4 = 0 THEN event_id + CAST(0.25 AS DOUBLE) END AS number,
           CASE WHEN event_id % 4 = 2 THEN CAST(event_id AS VARCHAR) END AS text FROM events""",
    "reference_records": "SELECT 'pg' || page_id AS id, url AS name FROM pages WHERE page_id % 3 = 0 AND url IS NOT NULL",
    "roster_members": """
    SELECT 'S' || c_custkey AS id, CASE WHEN c_custkey % 4 <> 0 THEN c_name ELSE lower(c_name) END AS name,
           CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) || '@example.com' END AS email
    FROM customer WHERE c_mktsegment NOT IN ('FURNITURE', 'MACHINERY') AND c_custkey <> 1""",
    "inspect_records": """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""",
    "lookup_rows": """
    SELECT id, name, client_id FROM projects_t WHERE client_id IN (SELECT id FROM clients_t WHERE link_id IS NULL)""",
    "upsert_users": """
    SELECT source_id, x.name, x.email, s.link_id, s.chat_id FROM user_extract_t x LEFT JOIN stored_users_t s USING (source_id)""",
    "user_changes": "SELECT kind, text FROM user_changes_t",
    "upsert_clients": "SELECT source_id, lower(name) AS name, link_id FROM clients_t",
    "client_changes": "SELECT kind, text FROM client_changes_t",
    "upsert_projects": """
    SELECT source_id, x.name, x.client_id, p.link_id FROM project_extract_t x JOIN projects_t p USING (source_id)""",
    "project_changes": "SELECT kind, text FROM project_changes_t",
    "upsert_entries": _merged_entries("extract_t"),
    "skipped_entries": "SELECT source_id, user_source_id FROM extract_t WHERE user_id IS NULL",
    "set_links": """
    SELECT id, name, CASE WHEN segment = 'BUILDING' THEN 'recNew' || substr(id, 2) ELSE link_id END AS link_id FROM users_t""",
    "clear_dead_links": """
    SELECT id, name, CASE WHEN link_id IN (SELECT 'recU' || o_custkey FROM orders WHERE o_totalprice > 450000)
                          THEN NULL ELSE link_id END AS link_id FROM users_t""",
    "seed_if_absent": """
    SELECT id, source_id, CASE WHEN link_id IS NULL THEN 'seed' ELSE name END AS name, link_id FROM projects_t""",
    "integrity_report": """
    SELECT t AS "table", k AS "check", CAST(v AS BIGINT) AS violations FROM (
      SELECT 'users' AS t, 'not_null' AS k, 0 AS v UNION ALL SELECT 'users', 'unique_source_id', 0
      UNION ALL SELECT 'clients', 'not_null', 0 UNION ALL SELECT 'clients', 'unique_source_id', 0
      UNION ALL SELECT 'projects', 'not_null', count(*) FILTER (id IS NULL OR source_id IS NULL OR name IS NULL) FROM projects_t
      UNION ALL SELECT 'projects', 'unique_source_id', count(*) - count(DISTINCT source_id) FROM projects_t
      UNION ALL SELECT 'entries', 'not_null', count(*) FILTER (start_time IS NULL OR user_id IS NULL) FROM entries_t
      UNION ALL SELECT 'entries', 'unique_source_id', count(*) - count(DISTINCT source_id) FROM entries_t
      UNION ALL SELECT 'projects', 'known_client_id', count(*) FROM projects_t
        WHERE client_id NOT IN (SELECT id FROM clients_t WHERE link_id IS NOT NULL)
      UNION ALL SELECT 'entries', 'known_user_id', count(*) FROM entries_t WHERE user_id NOT IN (SELECT id FROM stored_users_t)
      UNION ALL SELECT 'entries', 'known_project_id', count(*) FROM entries_t
        WHERE project_id IS NOT NULL AND project_id NOT IN (SELECT id FROM projects_t))""",
    "detach_clients": """
    SELECT id, name, CASE WHEN client_id IN (SELECT id FROM clients_t WHERE link_id IS NULL) THEN NULL ELSE client_id END AS client_id
    FROM projects_t""",
    "ghost_entries": "SELECT source_id, user_id FROM ghosts_t",
    "soft_delete": f"""
    SELECT {_ENTRY}, CASE WHEN source_id IN (SELECT source_id FROM ghosts_t) THEN {_RUN} ELSE {_TS.format('deleted_at')} END AS deleted_at,
           CASE WHEN source_id IN (SELECT source_id FROM ghosts_t) THEN {_RUN} END AS updated_at FROM stored_t""",
    "audit_changes": f"SELECT {_ENTRY}, deleted_at, updated_at, sync_action FROM sync_t WHERE sync_changed",
    "audit_groups": f"""
    SELECT coalesce(s.user_id, x.user_id) AS user_id, coalesce(s.day, x.day) AS day
    FROM (SELECT user_id, strftime(start_time, '%Y-%m-%d') AS day, list_sort(list((source_id, description, start_time, secs, project_id)::VARCHAR)) AS c
          FROM stored_t WHERE deleted_at IS NULL AND start_time >= {_WINDOW} GROUP BY ALL) s
    FULL JOIN (SELECT user_id, strftime(start_time, '%Y-%m-%d') AS day, list_sort(list((source_id, description, start_time, secs, project_id)::VARCHAR)) AS c
               FROM window_t WHERE user_id IS NOT NULL GROUP BY ALL) x ON s.user_id = x.user_id AND s.day = x.day
    WHERE s.c IS DISTINCT FROM x.c""",
    "window_sync": f"SELECT {_ENTRY}, deleted_at, updated_at, sync_action, sync_changed FROM sync_t",
    "window_sync_stats": "SELECT * FROM sync_stats_t",
    "sync_report": "SELECT * FROM report_t",
    "sync_report_text": """
    SELECT 'sync_report' AS kind, 'What the last run did' AS title, section, text FROM (
      SELECT 'users ' || kind AS section, text FROM user_changes_t
      UNION ALL SELECT 'projects ' || kind, text FROM project_changes_t
      UNION ALL SELECT 'clients ' || kind, text FROM client_changes_t
      UNION ALL SELECT 'run', 'outcome: SUCCESS'
      UNION ALL SELECT 'run', 'merged entries: ' || upserted FROM report_t
      UNION ALL SELECT 'run', 'removed entries: ' || deleted FROM report_t
      UNION ALL SELECT 'run', 'people looked at: ' || users_scanned FROM report_t)""",
    "backfill": _merged_entries("window_t"),
    "name_state": "SELECT * FROM name_state_t",
    "missing_users": """
    SELECT id, name FROM users_t WHERE link_id IS NULL AND name IN (SELECT name FROM names_t WHERE kind = 'user')""",
    "missing_projects": """
    SELECT id, name FROM projects_t WHERE link_id IS NULL AND name IN (SELECT name FROM names_t WHERE kind = 'project')""",
    "missing_clients": """
    SELECT id, name FROM clients_t WHERE link_id IS NULL AND id IN (
      SELECT client_id FROM projects_t WHERE name IN (SELECT name FROM names_t WHERE kind = 'project'))""",
    "resolve_links": "SELECT id, name, action, link_id FROM resolved_t",
    "assignment_index": """
    SELECT project_link, month_date, 'rec' || substr(max(d), 1, 14) AS assignment_id FROM dated_t
    WHERE project_link <> '' GROUP BY project_link, month_date""",
    "missing_assignments": "SELECT project_link, month_date FROM missing_pairs_t",
    "new_assignment_rows": """
    SELECT project_link, month_date, CAST(0 AS DOUBLE) AS commitment_hours, CAST(0 AS DOUBLE) AS hours_to_be_paid,
           CAST(0 AS DOUBLE) AS original_invoice_amount FROM missing_pairs_t""",
    "complete_assignments": "SELECT project_link, month_date, assignment_id FROM full_index_t",
    "created_links": """
    SELECT id, name, CASE WHEN action = 'create' THEN 'rec' || substr(sha256('rows' || chr(1) || 'query' || chr(1) || id), 1, 14)
                          ELSE link_id END AS link_id FROM resolved_t""",
    "clients_default_name": """
    SELECT 'sc' || n_nationkey AS source_id, CASE WHEN n_nationkey % 4 = 0 THEN 'Unknown Client' WHEN n_nationkey % 4 = 1 THEN '' ELSE n_name END AS name
    FROM nation""",
    "projects_default_name": """
    SELECT 'sp' || p_partkey AS source_id, CASE WHEN p_partkey % 6 = 0 THEN 'Unknown Project' WHEN p_partkey % 6 = 1 THEN '' ELSE p_name END AS name,
           CASE WHEN p_partkey % 5 <> 0 THEN 'sc' || (p_partkey % 25) END AS client_source_id FROM part""",
    "lookback_modes": """
    SELECT d::INTEGER AS days, CASE WHEN d > 1 THEN 'DEEP' ELSE 'FAST' END AS mode,
           strftime(TIMESTAMP '1998-06-01 12:00:00' - to_days(d::INTEGER), '%Y-%m-%d %H:%M:%S') AS start,
           (SELECT count(*) FROM entries_t WHERE start_time >= TIMESTAMP '1998-06-01 12:00:00' - to_days(d::INTEGER)) AS entries
    FROM (SELECT unnest([1, 1, 30, 400]) AS d)""",
    "write_back": "SELECT id, name, link_id FROM resolved_t",
    "heal_dead_links": """
    SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 < 3 AND o_orderkey % 3 <> 0)
                           THEN NULL ELSE 'rec' || lpad(CAST(c_custkey AS VARCHAR), 14, '0') END AS link_id FROM customer""",
    "heal_report": """
    SELECT 'auto_heal' AS kind, 'Links found again' AS title, 'all' AS section, name || ' is linked to ' || link_id AS text
    FROM resolved_t WHERE action = 'heal'""",
    "payroll_actions": """
    SELECT outcome, record_id, user_link, user_name, project_link AS project_id, project_name, month, hours,
           CASE WHEN outcome = 'update' THEN hours END AS set_actual FROM pay_judged_t
    UNION ALL
    SELECT 'zeroed', id, NULL, NULL, NULL, NULL, NULL, NULL, 0.0 FROM pay_stale_t""",
    "laid_out_actions": """
    SELECT outcome, record_id, user_link, user_name, project_link AS project_id, project_name, month, hours,
           CASE WHEN outcome = 'update' THEN hours END AS set_actual FROM pay_judged_t
    UNION ALL
    SELECT 'zeroed', id, NULL, NULL, NULL, NULL, NULL, NULL, 0.0 FROM pay_stale_t""",
    "payroll_updates": "SELECT record_id, set_actual FROM pay_updates_t",
    "payroll_inserts": """
    SELECT user_link AS "user", coalesce(project_link, '') AS project, month, hours AS actual_hours
    FROM pay_judged_t WHERE outcome = 'insert'""",
    "payroll_zeroed": "SELECT id AS record_id, CAST(0 AS DOUBLE) AS set_actual FROM pay_stale_t",
    "dedup_updates": "SELECT record_id, set_actual FROM pay_deduped_t",
    "diff_stats": """
    SELECT CAST(sum(outcome IN ('update', 'zeroed')) AS BIGINT) AS updated, CAST(sum(outcome = 'insert') AS BIGINT) AS inserted,
           CAST(sum(outcome IN ('skipped', 'unchanged')) AS BIGINT) AS skipped, CAST(sum(outcome = 'missing') AS BIGINT) AS missing
    FROM (SELECT outcome FROM pay_judged_t UNION ALL SELECT 'zeroed' FROM pay_stale_t
          UNION ALL SELECT outcome FROM asg_judged_t UNION ALL SELECT 'zeroed' FROM asg_stale_t)""",
    "assignment_updates": "SELECT record_id, set_actual, set_assigned FROM asg_updates_t",
    "assignment_inserts": """
    SELECT user_link AS person, assignment_id AS project_assignment, hours AS actual_hours, CAST(0 AS DOUBLE) AS assigned_hours
    FROM asg_judged_t WHERE outcome = 'insert'""",
    "action_batches": """
    SELECT batch, count(*) AS rows, min(record_id) AS first_id, max(record_id) AS last_id FROM (
      SELECT record_id, (row_number() OVER (
        ORDER BY CAST('0x' || substr(md5(record_id), 1, 8) AS BIGINT) % 1024, record_id) - 1) // 10 AS batch
      FROM pay_deduped_t) GROUP BY batch""",
    "dead_links": """
    SELECT 'x' || o_orderkey AS error_id, 'rec' || lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS link_id
    FROM orders WHERE o_orderkey % 5 < 3 AND o_orderkey % 3 <> 0""",
    "match_identity": "SELECT * FROM matched_t",
    "discovered_ids": """
    SELECT user_id AS id, matched_chat_id AS value FROM matched_t WHERE chat_id IS NULL AND matched_chat_id IS NOT NULL""",
    "unmatched_users": "SELECT user_id, user_name, user_email FROM matched_t WHERE matched_chat_id IS NULL",
    "matched_count": """
    SELECT count(*) AS total, count(*) FILTER (matched_chat_id IS NULL) AS unmatched,
           count(*) FILTER (matched_chat_id IS NOT NULL) AS matched FROM matched_t""",
    "nudge_rows": """
    SELECT m.matched_chat_id AS chat_id, h.user_id, split_part(h.user_name, ' ', 1) AS first_name,
           rtrim(rtrim(printf('%.2f', h.unassigned_hours), '0'), '.') AS hours, t.date, t.source_id,
           t.date || ' ' || rtrim(rtrim(printf('%.2f', t.duration_hours), '0'), '.') || 'h ' || t.description AS text
    FROM unassigned_hours_t h JOIN matched_t m USING (user_id) JOIN unassigned_t t ON t.user_id = h.user_id
    WHERE m.matched_chat_id IS NOT NULL""",
    "unmatched_report": """
    SELECT 'unmatched_people' AS kind, 'Not on the roster' AS title, 'people' AS section,
           user_name || ', ' || coalesce(nullif(user_email, ''), 'address unknown') AS text
    FROM matched_t WHERE matched_chat_id IS NULL""",
    "conflict_report": """
    SELECT 'conflict' AS kind, 'Ambiguous name' AS title, name AS section,
           'Several records answer to this name, so none was linked; one of them has to stay alone.' AS text
    FROM resolved_t WHERE action = 'conflict'""",
}


def _needed(sql: str) -> list[str]:
    """Shared sub-selects a statement needs, in order of definition."""
    wanted: set[str] = set()
    open_ = [sql]
    while open_:
        for word in set(re.findall(r"\b[a-z_]+_t\b", open_.pop())):
            if word in CTES and word not in wanted:
                wanted.add(word)
                open_.append(CTES[word])
    return [name for name in CTES if name in wanted]


def _statement(sql: str) -> str:
    shared = ",\n".join(f"{name} AS ({CTES[name]})" for name in _needed(sql))
    return f"WITH {shared}\n{sql}" if shared else sql


ORACLES = {name: _statement(sql) for name, sql in _STATEMENTS.items()}
