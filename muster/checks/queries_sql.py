"""The expected result of every registered query, as DuckDB SQL."""

from __future__ import annotations

from muster.checks.tables_sql import AS_OF, TABLES, with_digests, with_tables

_ADDRESS = """LEFT JOIN address a ON a.contact_id = c.id AND a.is_primary = 1
    LEFT JOIN address_statistics s ON s.entity_id = a.id
    LEFT JOIN country y ON y.id = a.country_id"""

# Named subqueries shared by several checks.
SHARED: dict[str, str] = {
    "active_direct_debit": """
        SELECT m.*, p.membership_recurring_contribution
        FROM membership m
        JOIN membership_status ms ON ms.id = m.status_id AND ms.label IN ('Current', 'Paused')
        JOIN value_membership_payment p ON p.entity_id = m.id
        JOIN options o ON o.group_name = 'payment_instrument' AND CAST(o.value AS BIGINT) = p.payment_instrument
                      AND o.name IN ('RCUR', 'FRST')""",
    "new_direct_debit": f"""
        SELECT * FROM active_direct_debit
        WHERE join_date >= {AS_OF} - INTERVAL 6 MONTH AND join_date < {AS_OF} - INTERVAL 2 DAY""",
    "set_direct_debit": "SELECT DISTINCT contact_id FROM new_direct_debit",
    "set_direct_debit_floor":
        "SELECT DISTINCT contact_id FROM new_direct_debit WHERE join_date >= DATE '1995-01-01'",
    "set_tagged_four": """
        SELECT DISTINCT e.entity_id AS contact_id FROM entity_tag e JOIN tag g ON g.id = e.tag_id
        WHERE e.entity_table = 'civicrm_contact' AND g.name IN ('inaktiv', 'VIP', 'Firma', 'Schule')""",
    "set_tagged_two": """
        SELECT DISTINCT e.entity_id AS contact_id FROM entity_tag e JOIN tag g ON g.id = e.tag_id
        WHERE e.entity_table = 'civicrm_contact' AND g.name IN ('inaktiv', 'VIP')""",
    "set_group": """
        SELECT DISTINCT gc.contact_id FROM group_contact gc JOIN crm_group g ON g.id = gc.group_id
        WHERE g.title = 'Erblasser'""",
    "gifts": f"""
        SELECT k.contact_id, k.total_amount, o.label AS status
        FROM contribution k
        LEFT JOIN options o ON o.group_name = 'contribution_status' AND CAST(o.value AS BIGINT) = k.contribution_status_id
        WHERE k.receive_date >= {AS_OF} - INTERVAL 1 YEAR""",
    "set_major": """
        SELECT contact_id FROM gifts WHERE status = 'Completed' GROUP BY contact_id HAVING sum(total_amount) >= 1000""",
    "set_major_any": "SELECT contact_id FROM gifts GROUP BY contact_id HAVING sum(total_amount) >= 1000",
    "set_major_fanout": """
        SELECT g.contact_id FROM base_pairs b JOIN gifts g ON g.contact_id = b.contact_id
        WHERE g.status = 'Completed' GROUP BY g.contact_id HAVING sum(g.total_amount) >= 1000""",
    "done": """
        SELECT a.*, o.label AS status FROM activity a
        JOIN options o ON o.group_name = 'activity_status' AND CAST(o.value AS BIGINT) = a.status_id""",
    "set_mailed": f"""
        SELECT DISTINCT l.contact_id FROM activity_contact l
        JOIN done a ON a.id = l.activity_id AND a.status = 'Completed'
        JOIN campaign c ON c.id = a.campaign_id AND c.external_identifier = 'AKTION-7767'
        WHERE l.record_type_id = 3 AND a.activity_date_time >= {AS_OF} - INTERVAL 6 MONTH""",
    "set_called": """
        SELECT DISTINCT l.contact_id FROM activity_contact l
        JOIN done a ON a.id = l.activity_id AND a.status IN ('Completed', 'Scheduled')
        WHERE l.record_type_id = 3 AND a.campaign_id IN
              (SELECT id FROM campaign WHERE external_identifier = 'AKTION-7571' OR title = 'Welcome Calls')""",
    "set_tree": f"""
        SELECT DISTINCT l.contact_id FROM activity_contact l
        JOIN done a ON a.id = l.activity_id AND a.status = 'Completed'
        JOIN lineage n ON n.id = a.campaign_id AND list_contains(n.names, 'TM')
        WHERE l.record_type_id = 3 AND a.activity_date_time >= {AS_OF} - INTERVAL 3 MONTH""",
    "membership_money": """
        SELECT mp.membership_id, mp.contribution_id, o.label AS status
        FROM membership_payment mp
        JOIN contribution k ON k.id = mp.contribution_id
        JOIN options o ON o.group_name = 'contribution_status' AND CAST(o.value AS BIGINT) = k.contribution_status_id""",
    "set_failed": "SELECT DISTINCT membership_id FROM membership_money WHERE status IN ('Cancelled', 'Refunded')",
    "set_paid": "SELECT DISTINCT membership_id FROM membership_money WHERE status = 'Completed'",
    "located": f"""
        SELECT c.*, a.street_address, a.postal_code, a.city, s.rts_counter, y.iso_code FROM contact c {_ADDRESS}""",
    "set_no_post": """
        SELECT DISTINCT id AS contact_id FROM located
        WHERE is_deleted = 1 OR is_deceased = 1 OR do_not_mail = 1 OR iso_code <> 'AT' OR street_address IS NULL
           OR postal_code IS NULL OR city IS NULL OR rts_counter >= 2 OR contact_type = 'Organization'
           OR (contact_type = 'Individual' AND (first_name IS NULL OR last_name IS NULL))
           OR (contact_type = 'Household' AND household_name IS NULL)""",
    "set_recruited": f"""
        SELECT DISTINCT m.id AS membership_id FROM active_direct_debit m
        JOIN contribution_recur r ON r.id = m.membership_recurring_contribution
        JOIN lineage n ON n.id = m.campaign_id AND list_contains(n.names, 'DD')
        WHERE r.next_sched_contribution_date > {AS_OF}""",
    "base_pairs": f"""
        SELECT DISTINCT c.id AS contact_id, m.id AS membership_id
        FROM contact c
        JOIN phone p ON p.contact_id = c.id AND p.phone IS NOT NULL
        JOIN membership m ON m.contact_id = c.id
        WHERE m.join_date >= {AS_OF} - INTERVAL 1 MONTH
          AND c.is_deceased = 0 AND c.is_deleted = 0 AND c.do_not_phone = 0
          AND day({AS_OF}) NOT IN (2, 9, 16, 24)""",
    "signed": """
        SELECT l.contact_id, l.activity_id, v.title AS petition, c.title AS campaign_topic
        FROM activity_contact l
        JOIN activity a ON a.id = l.activity_id
        JOIN options o ON o.group_name = 'activity_type' AND o.name = 'Petition'
                      AND CAST(o.value AS BIGINT) = a.activity_type_id
        JOIN survey v ON v.id = a.source_record_id AND v.activity_type_id = CAST(o.value AS BIGINT)
        JOIN campaign c ON c.id = v.campaign_id""",
    "petition_texts": """
        SELECT contact_id, string_agg(petition, ', ' ORDER BY first, petition) AS petition
        FROM (SELECT contact_id, petition, min(activity_id) AS first FROM signed GROUP BY ALL) GROUP BY contact_id""",
    "topic_texts": """
        SELECT contact_id, string_agg(campaign_topic, ', ' ORDER BY first, campaign_topic) AS campaign_topic
        FROM (SELECT contact_id, campaign_topic, min(activity_id) AS first FROM signed GROUP BY ALL)
        GROUP BY contact_id""",
    "kinds": """
        SELECT contact_id, string_agg(name, ', ' ORDER BY name) AS membership_type
        FROM (SELECT DISTINCT m.contact_id, t.name FROM new_direct_debit m
              JOIN membership_type t ON t.id = m.membership_type_id) GROUP BY contact_id""",
    "prefixes": "SELECT CAST(value AS BIGINT) AS code, label FROM options WHERE group_name = 'individual_prefix'",
    "mailing": """
        SELECT c.hash AS "Contact_Hash", e.email AS "Email", x.label AS "Salutation", c.first_name AS "Firstname",
               c.last_name AS "Lastname", CAST(c.birth_date AS VARCHAR) AS "Birthday", c.formal_title AS "Title",
               c.postal_code AS "ZIP", c.city AS "City", c.iso_code AS "Country", c.street_address AS "Address",
               c.id AS contact_id, p.phone AS "Telephone", c.external_identifier AS "PersonID_IMB",
               CAST(NULL AS INTEGER) AS "Package_id", CAST(NULL AS INTEGER) AS "Segment_id",
               g1.status AS "Community_NL", g2.status AS "Donation_Info",
               tt.campaign_topic AS "Campaign_Topic", pt.petition AS "Petition"
        FROM located c
        JOIN email e ON e.contact_id = c.id AND e.is_primary = 1
        LEFT JOIN phone p ON p.contact_id = c.id AND p.is_primary = 1
        LEFT JOIN prefixes x ON x.code = c.prefix_id
        LEFT JOIN group_contact g1 ON g1.contact_id = c.id AND g1.group_id = 1
        LEFT JOIN group_contact g2 ON g2.contact_id = c.id AND g2.group_id = 2
        LEFT JOIN petition_texts pt ON pt.contact_id = c.id
        LEFT JOIN topic_texts tt ON tt.contact_id = c.id
        WHERE c.do_not_email = 0 AND c.is_opt_out = 0 AND c.contact_type = 'Individual' AND e.email IS NOT NULL
          AND c.is_deceased = 0 AND c.is_deleted = 0 AND c.external_identifier NOT LIKE 'USER-%'
          AND c.id NOT IN (SELECT contact_id FROM uf_match)""",
    "welcome_email": """
        SELECT DISTINCT c.hash AS "Contact_Hash", e.email AS "Email", c.id AS contact_id
        FROM contact c JOIN email e ON e.contact_id = c.id AND e.is_primary = 1
        WHERE c.is_deceased = 0 AND c.is_deleted = 0 AND c.do_not_email = 0 AND c.is_opt_out = 0
          AND e.email IS NOT NULL
          AND c.id NOT IN (SELECT contact_id FROM set_tagged_two)
          AND c.id NOT IN (SELECT contact_id FROM set_group)
          AND c.id NOT IN (SELECT contact_id FROM set_major_any)
          AND c.id IN (SELECT contact_id FROM set_direct_debit_floor)""",
    "welcome_call": """
        SELECT DISTINCT contact_id FROM base_pairs
        WHERE contact_id NOT IN (SELECT contact_id FROM set_tagged_two)
          AND contact_id NOT IN (SELECT contact_id FROM set_major_fanout)
          AND contact_id NOT IN (SELECT contact_id FROM set_called)
          AND contact_id NOT IN (SELECT contact_id FROM set_tree)
          AND membership_id NOT IN (SELECT membership_id FROM set_failed)
          AND membership_id NOT IN (SELECT membership_id FROM set_paid)
          AND membership_id IN (SELECT membership_id FROM set_recruited)""",
    "pending": """
        SELECT w.* FROM webshop_order w
        WHERE w.activity_type_id = (SELECT CAST(value AS BIGINT) FROM options
                                    WHERE group_name = 'activity_type' AND name = 'Webshop Order')
          AND w.payment_received = 1 AND w.order_exported = 0""",
    "order_types": "SELECT CAST(value AS BIGINT) AS code, label FROM options WHERE group_name = 'order_type'",
    "shop_lines": """
        SELECT w.id, c.formal_title AS titel, x.label AS anrede, c.first_name AS vorname, c.last_name AS nachname,
               CASE WHEN c.contact_type = 'Individual' THEN c.organization_name END AS co, a.street_address AS strasse, a.state_province AS state, a.city AS ort,
               a.postal_code AS postfach, y.name AS land,
               CASE WHEN length(CAST(coalesce(w.campaign_id, 0) AS VARCHAR)) < 4
                    THEN lpad(CAST(coalesce(w.campaign_id, 0) AS VARCHAR), 4, '0')
                    ELSE CAST(coalesce(w.campaign_id, 0) AS VARCHAR) END || 'C' ||
               CASE WHEN length(CAST(c.id AS VARCHAR)) < 9 THEN lpad(CAST(c.id AS VARCHAR), 9, '0')
                    ELSE CAST(c.id AS VARCHAR) END AS kundennummer,
               t.label AS item, w.order_count AS anzahl_items, w.shirt_type AS tshirt_type,
               w.shirt_size AS tshirt_size, strftime(w.activity_date_time, '%Y-%m-%d %H:%M:%S') AS date_of_order,
               w.details AS activity_description, w.linked_contribution AS contribution_id,
               w.linked_membership AS membership_id, w.multi_purpose, w.order_type, e.email,
               coalesce(r.route_key, 'default') AS route_key, c.id AS source_contact_id
        FROM pending w
        JOIN contact c ON c.id = w.source_contact_id
        LEFT JOIN address a ON a.contact_id = c.id AND a.is_primary = 1
        LEFT JOIN country y ON y.id = a.country_id
        LEFT JOIN email e ON e.contact_id = c.id AND e.is_primary = 1
        LEFT JOIN prefixes x ON x.code = c.prefix_id
        LEFT JOIN order_types t ON t.code = TRY_CAST(w.order_type AS BIGINT)
        LEFT JOIN routes r ON r.route_key = w.order_type""",
}

ORDER_COLUMNS = (
    "id, titel, anrede, vorname, nachname, co, strasse, state, ort, postfach, land, kundennummer, item, anzahl_items,"
    " tshirt_type, tshirt_size, date_of_order, activity_description, contribution_id, membership_id, multi_purpose,"
    " order_type, email"
)


def _line(columns: str) -> str:
    fields = []
    for column in columns.split(", "):
        text = f"coalesce(CAST({column.strip()} AS VARCHAR), '')"
        fields.append(
            f"CASE WHEN regexp_matches({text}, '[;\"\\\\\\n\\r\\t ]')"
            f" THEN '\"' || replace({text}, '\"', '\"\"') || '\"' ELSE {text} END"
        )
    return " || ';' || ".join(fields)


CHECKS: dict[str, str] = {
    # Sources and sinks.
    "load_tables": "\nUNION ALL\n".join(
        f"SELECT '{'group' if name == 'crm_group' else name}' AS table_name, count(*) AS row_count FROM {name}"
        for name in TABLES
        if name not in ("options", "lineage", "routes")
    ),
    "pending_orders": "SELECT id, source_contact_id, campaign_id, order_type, order_count FROM pending",
    "custom_field_rename": """
        SELECT id, payment_received, order_exported, order_type, order_count, shirt_type, shirt_size,
               linked_contribution, linked_membership, multi_purpose FROM webshop_order""",
    "route_table": """
        SELECT w.id, r.route_key, r.file, r.remote FROM webshop_order w
        JOIN routes r ON r.route_key = CASE WHEN w.order_type IN ('1', '3') THEN w.order_type ELSE 'default' END""",
    "csv_export": f"SELECT {ORDER_COLUMNS} FROM shop_lines",
    "csv_lines": f"SELECT {_line(ORDER_COLUMNS)} AS value FROM shop_lines",
    "routed_export": f"SELECT {ORDER_COLUMNS}, route_key FROM shop_lines",
    "mass_activity": """
        SELECT (SELECT (max(id) // 1024 + 1) * 1024 FROM activity) AS activity_id, 34 AS activity_type_id,
               (SELECT id FROM campaign WHERE external_identifier = 'AKTION-7767') AS campaign_id, 2 AS status_id,
               'Export' AS subject, '2001-07-15 12:00:00' AS activity_date_time, contact_id, 3 AS record_type_id
        FROM mailing""",
    "call_tasks": """
        SELECT w.contact_id AS call_for, 35 AS activity_type_id, 43 AS campaign_id, 1 AS status_id,
               'Service Call' AS subject, '2001-07-15 12:00:00' AS activity_date_time,
               CASE WHEN p.contact_id = 0 THEN w.contact_id ELSE p.contact_id END AS contact_id, p.record_type_id
        FROM welcome_call w,
             (VALUES (0, 3), (94, 1), (77, 1), (105, 1), (16, 2)) p(contact_id, record_type_id)""",
    "export_ledger": """
        SELECT id, 1 AS order_exported, '2001-07-15 12:00:00' AS order_exported_date, 2 AS status_id
        FROM shop_lines WHERE route_key <> '1'
        UNION ALL SELECT id, 0, NULL, 1 FROM shop_lines WHERE route_key = '1'""",
    "export_summary": """
        SELECT r.route_key, count(l.id) AS count, r.file || '_20010715120000.csv' AS filename,
               CASE WHEN count(l.id) > 0 THEN 'out/file-' || r.route_key END AS folder,
               CAST(count(l.id) = 0 AS INTEGER) AS is_error,
               CASE WHEN count(l.id) = 0 THEN 'No data available for upload' END AS message,
               CAST(count(l.id) = 0 AS INTEGER) AS error_code, CAST(NULL AS VARCHAR) AS follow_up_error
        FROM routes r LEFT JOIN shop_lines l ON l.route_key = r.route_key GROUP BY r.route_key, r.file""",
    # Filters.
    "flags_filter": """
        SELECT id FROM contact WHERE do_not_email + is_opt_out + is_deceased + is_deleted + do_not_phone = 0""",
    "type_filter": "SELECT id, contact_type FROM contact WHERE contact_type = 'Individual'",
    "not_null_after_left_join": """
        SELECT c.id AS contact_id, e.email FROM contact c LEFT JOIN email e ON e.contact_id = c.id AND e.is_primary = 1
        WHERE e.email IS NOT NULL""",
    "not_like_prefix": "SELECT id, external_identifier FROM contact WHERE external_identifier NOT LIKE 'USER-%'",
    "in_list": """
        SELECT m.id, t.name AS membership_type FROM membership m JOIN membership_type t ON t.id = m.membership_type_id
        WHERE t.name IN ('Guardian', 'Baum')""",
    "rolling_window": f"""
        SELECT id, CAST(join_date AS VARCHAR) AS join_date FROM membership
        WHERE join_date >= {AS_OF} - INTERVAL 6 MONTH AND join_date < {AS_OF} - INTERVAL 2 DAY""",
    "fixed_floor_date": """
        SELECT id, CAST(join_date AS VARCHAR) AS join_date FROM membership WHERE join_date >= DATE '2000-02-29'""",
    "future_filter": f"SELECT id FROM contribution_recur WHERE next_sched_contribution_date > {AS_OF}",
    "run_day_gate": f"""
        SELECT id, d AS run_day FROM membership, (VALUES (1), (2), (9), (15), (16), (24)) v(d)
        WHERE d NOT IN (2, 9, 16, 24)""",
    "or_eligibility": """
        SELECT id AS contact_id FROM located
        WHERE coalesce(is_deleted = 1, false) OR coalesce(is_deceased = 1, false) OR coalesce(do_not_mail = 1, false)
           OR coalesce(iso_code <> 'AT', false) OR street_address IS NULL OR postal_code IS NULL OR city IS NULL
           OR coalesce(rts_counter >= 2, false) OR contact_type = 'Organization'
           OR (contact_type = 'Individual' AND first_name IS NULL)
           OR (contact_type = 'Individual' AND last_name IS NULL)
           OR (contact_type = 'Household' AND household_name IS NULL)""",
    "entity_scope": "SELECT entity_id, tag_id FROM entity_tag WHERE entity_table = 'civicrm_contact'",
    "role_filter": "SELECT activity_id, contact_id FROM activity_contact WHERE record_type_id = 3",
    # Joins.
    "primary_detail_join": """
        SELECT c.id AS contact_id, a.street_address, e.email, p.phone FROM contact c
        LEFT JOIN address a ON a.contact_id = c.id AND a.is_primary = 1
        LEFT JOIN email e ON e.contact_id = c.id AND e.is_primary = 1
        LEFT JOIN phone p ON p.contact_id = c.id AND p.is_primary = 1""",
    "dimension_lookup_join": """
        SELECT a.id, y.iso_code, s.rts_counter FROM address a
        LEFT JOIN country y ON y.id = a.country_id LEFT JOIN address_statistics s ON s.entity_id = a.id""",
    "option_lookup_join": """
        SELECT c.id, c.prefix_id, x.label AS salutation FROM contact c LEFT JOIN prefixes x ON x.code = c.prefix_id""",
    "inner_chain": "SELECT * FROM signed",
    "multi_key_join": """
        SELECT a.id AS activity_id, v.id AS survey_id, v.title FROM activity a
        JOIN survey v ON v.id = a.source_record_id AND v.activity_type_id = a.activity_type_id""",
    "any_phone_join": """
        SELECT DISTINCT c.id AS contact_id FROM contact c JOIN phone p ON p.contact_id = c.id AND p.phone IS NOT NULL""",
    "hierarchy_join": """
        SELECT m.id, m.campaign_id FROM membership m
        JOIN lineage n ON n.id = m.campaign_id AND list_contains(n.names, 'DD')""",
    "attach_aggregate": """
        SELECT c.id AS contact_id, k.membership_type FROM contact c LEFT JOIN kinds k ON k.contact_id = c.id""",
    "recurring_payment_join": f"""
        SELECT m.id, p.payment_instrument, CAST(r.next_sched_contribution_date AS VARCHAR) AS next_charge
        FROM membership m JOIN value_membership_payment p ON p.entity_id = m.id
        JOIN contribution_recur r ON r.id = p.membership_recurring_contribution
        WHERE r.next_sched_contribution_date > {AS_OF}""",
    "payment_link_join": """
        SELECT membership_id, contribution_id FROM membership_money WHERE status IN ('Completed', 'Cancelled')""",
    "order_contact_join": """
        SELECT w.id, w.source_contact_id, c.first_name, c.last_name FROM webshop_order w
        JOIN contact c ON c.id = w.source_contact_id""",
    # Semi and anti joins.
    "not_in_null_aware": """
        SELECT id, 0 AS nulls FROM contact WHERE id NOT IN (SELECT contact_id FROM uf_match)
        UNION ALL
        SELECT id, 1 FROM contact WHERE id NOT IN (SELECT contact_id FROM uf_match UNION ALL SELECT NULL)""",
    "suppress": """
        SELECT id AS contact_id FROM contact WHERE id NOT IN (SELECT contact_id FROM set_tagged_four)
        AND id NOT IN (SELECT contact_id FROM set_group) AND id NOT IN (SELECT contact_id FROM set_major)""",
    "keep": "SELECT id AS contact_id FROM contact WHERE id IN (SELECT contact_id FROM set_direct_debit)",
    "suppress_membership": """
        SELECT id AS membership_id FROM membership WHERE id NOT IN (SELECT membership_id FROM set_failed)
        AND id NOT IN (SELECT membership_id FROM set_paid)""",
    "exists_in_contact": """
        SELECT DISTINCT user_id AS contact_id FROM events WHERE user_id IN (SELECT id FROM contact)""",
    "in_subquery_filter": """
        SELECT id, campaign_id FROM membership WHERE campaign_id IN
               (SELECT id FROM campaign WHERE external_identifier = 'AKTION-7571' OR title = 'Campaign NATION_3')""",
    # Rules.
    "rule_tagged": """
        SELECT contact_id, 4 AS tags FROM set_tagged_four UNION ALL SELECT contact_id, 2 FROM set_tagged_two""",
    "rule_group_member": "SELECT contact_id FROM set_group",
    "rule_major_donor": "SELECT contact_id FROM set_major",
    "rule_major_donor_any_status": "SELECT contact_id FROM set_major_any",
    "rule_major_donor_fanout": "SELECT contact_id FROM set_major_fanout",
    "rule_recent_mailing": "SELECT contact_id FROM set_mailed",
    "rule_previous_call": "SELECT contact_id FROM set_called",
    "rule_campaign_tree_contact": "SELECT contact_id FROM set_tree",
    "rule_membership_failed": "SELECT membership_id FROM set_failed",
    "rule_membership_paid": "SELECT membership_id FROM set_paid",
    "rule_postal_ineligible": "SELECT contact_id FROM set_no_post",
    "keep_recent_direct_debit": "SELECT contact_id FROM set_direct_debit",
    "keep_recruited_membership": "SELECT membership_id FROM set_recruited",
    # Aggregation and set operations.
    "distinct_rows": "SELECT DISTINCT contact_id, membership_type_id FROM membership",
    "sum_having": """
        SELECT contact_id, CAST(sum(total_amount) AS DOUBLE) AS total FROM contribution
        GROUP BY contact_id HAVING sum(total_amount) >= 5000""",
    "concat_distinct_sorted": "SELECT contact_id, membership_type FROM kinds",
    "concat_distinct_by_other": """
        SELECT p.contact_id, p.petition, t.campaign_topic FROM petition_texts p
        JOIN topic_texts t ON t.contact_id = p.contact_id""",
    "count_per_route": "SELECT route_key, count(*) AS count FROM shop_lines GROUP BY route_key",
    "union_ids": """
        SELECT contact_id FROM set_tagged_two UNION SELECT contact_id FROM set_group
        UNION SELECT contact_id FROM set_major_any""",
    "insert_select_union": "SELECT contact_id FROM set_called UNION ALL SELECT contact_id FROM set_tree",
    "difference": """
        SELECT DISTINCT contact_id, campaign_id FROM membership
        WHERE contact_id NOT IN (SELECT contact_id FROM set_tagged_two)
          AND contact_id NOT IN (SELECT contact_id FROM set_group)""",
    # Row-modifying steps.
    "update_from_join": """
        SELECT c.id AS contact_id, g1.status AS "Community_NL", g2.status AS "Donation_Info" FROM contact c
        LEFT JOIN group_contact g1 ON g1.contact_id = c.id AND g1.group_id = 1
        LEFT JOIN group_contact g2 ON g2.contact_id = c.id AND g2.group_id = 2""",
    "update_from_aggregate": """
        SELECT c.id AS contact_id, p.petition, t.campaign_topic FROM contact c
        LEFT JOIN petition_texts p ON p.contact_id = c.id LEFT JOIN topic_texts t ON t.contact_id = c.id""",
    "assert_unique_key": """
        SELECT 'contact' AS table_name, CAST(NULL AS BIGINT) AS key, count(*) AS copies FROM contact
        UNION ALL SELECT 'address', contact_id, count(*) FROM address GROUP BY contact_id HAVING count(*) > 1""",
    "insert_ignore": """
        SELECT DISTINCT m.contact_id, 2 AS group_id, 'Added' AS status FROM membership m
        WHERE NOT EXISTS (SELECT 1 FROM group_contact g WHERE g.contact_id = m.contact_id AND g.group_id = 2)""",
    # Expressions.
    "scalar_lookup": """
        SELECT contact_id, status FROM group_contact
        WHERE group_id = (SELECT id FROM crm_group WHERE title = 'Community NL')""",
    "customer_number_sql": """
        SELECT id, lpad(CAST(nullif(id % 9, 0) * 12345 AS VARCHAR), 5, '0') || 'C' ||
               lpad(CAST(contact_id * 1000003 AS VARCHAR), 9, '0') AS kundennummer FROM membership""",
    "customer_number_app": """
        SELECT id, printf('%04d', coalesce(campaign_id * 777, 0)) || 'C' || printf('%09d', source_contact_id * 100000007)
               AS kundennummer FROM webshop_order""",
    "name_by_type": """
        SELECT id, CASE WHEN contact_type = 'Individual' THEN last_name
                        WHEN contact_type = 'Organization' THEN organization_name
                        WHEN contact_type = 'Household' THEN household_name END AS nachname FROM contact""",
    "typed_null_columns": """
        SELECT id, CAST(NULL AS INTEGER) AS package_id, CAST(NULL AS VARCHAR) AS co FROM contact""",
    "project_keys": """
        SELECT c.hash AS "Contact_Hash", e.email AS "Email", c.id AS contact_id
        FROM contact c JOIN email e ON e.contact_id = c.id AND e.is_primary = 1
        WHERE c.is_deceased = 0 AND c.is_deleted = 0 AND c.do_not_email = 0 AND c.is_opt_out = 0""",
    "option_label": """
        SELECT w.id, w.order_type, t.label AS item FROM webshop_order w
        LEFT JOIN order_types t ON t.code = TRY_CAST(w.order_type AS BIGINT)""",
    "route_key": """
        SELECT id, CASE WHEN order_type IN ('1', '3') THEN order_type ELSE 'default' END AS route_key
        FROM webshop_order""",
    "date_ago": """
        SELECT id, CAST(CAST(join_date - INTERVAL 6 MONTH AS DATE) AS VARCHAR) AS six_months,
               CAST(CAST(join_date - INTERVAL 2 DAY AS DATE) AS VARCHAR) AS two_days,
               CAST(CAST(join_date - INTERVAL 1 YEAR AS DATE) AS VARCHAR) AS one_year FROM membership""",
    # Exports.
    "export_mailing": "SELECT * FROM mailing",
    "export_welcome_post": """
        SELECT w.contact_id, c.formal_title AS titel, x.label AS anrede, c.first_name AS vorname,
               CASE c.contact_type WHEN 'Individual' THEN c.last_name WHEN 'Household' THEN c.household_name
                                   WHEN 'Organization' THEN c.organization_name END AS nachname,
               CAST(NULL AS VARCHAR) AS co, c.street_address AS strasse, c.postal_code AS plz, c.city AS ort,
               CAST(NULL AS VARCHAR) AS postfach, c.iso_code AS land,
               lpad(CAST((SELECT id FROM campaign WHERE external_identifier = 'AKTION-7767') AS VARCHAR), 5, '0') || 'C'
                   || lpad(CAST(w.contact_id AS VARCHAR), 9, '0') AS kundennummer,
               k.membership_type AS vertragstyp
        FROM set_direct_debit w
        LEFT JOIN located c ON c.id = w.contact_id
        LEFT JOIN prefixes x ON x.code = c.prefix_id
        LEFT JOIN kinds k ON k.contact_id = w.contact_id
        WHERE w.contact_id NOT IN (SELECT contact_id FROM set_no_post)
          AND w.contact_id NOT IN (SELECT contact_id FROM set_tagged_four)
          AND w.contact_id NOT IN (SELECT contact_id FROM set_group)
          AND w.contact_id NOT IN (SELECT contact_id FROM set_major)
          AND w.contact_id NOT IN (SELECT contact_id FROM set_mailed)""",
    "export_welcome_email": "SELECT * FROM welcome_email",
    "export_welcome_call": "SELECT * FROM welcome_call",
    "export_orders": f"SELECT {ORDER_COLUMNS}, route_key FROM shop_lines",
}


#: Queries over lines numbered by their digest.
BY_DIGEST = ("role_filter", "payment_link_join")


def oracle_sql() -> dict[str, str]:
    sql = {name: with_tables(body, SHARED) for name, body in CHECKS.items()}
    return sql | {name: with_digests(sql[name]) for name in BY_DIGEST}
