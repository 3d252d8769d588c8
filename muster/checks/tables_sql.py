"""The derived CRM tables of FIXTURES.md once more, as DuckDB SQL over the driver's views."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2001-07-15 12:00:00'"

# A line's own number: an order may hold one line number several times, but not at one price.
_LINE_ID = "(l_orderkey * 8 + l_linenumber) * 16777216 + CAST(round(l_extendedprice * 100) AS BIGINT)"
# One that also tells lines of one number and price apart by part and supplier.
_LINE_DIGEST = (
    "CAST('0x' || left(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,"
    " CAST(round(l_extendedprice * 100) AS BIGINT))), 15) AS BIGINT)"
)

TABLES: dict[str, str] = {
    "contact": """
        SELECT c_custkey AS id, md5(c_name) AS hash,
               CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'USER-' || c_custkey
                    ELSE 'IMB-' || c_custkey END AS external_identifier,
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Household' WHEN 'MACHINERY' THEN 'Organization'
                    ELSE 'Individual' END AS contact_type,
               nullif(c_custkey % 4, 0) AS prefix_id,
               CASE WHEN c_custkey % 29 <> 0 THEN 'F' || c_custkey END AS first_name,
               'L' || c_custkey AS last_name, 'O' || c_custkey AS organization_name,
               CASE WHEN c_custkey % 31 <> 0 THEN 'H' || c_custkey END AS household_name,
               CASE WHEN c_custkey % 10 = 0 THEN 'Dr' END AS formal_title,
               DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER) AS birth_date,
               CAST(c_custkey % 13 = 0 AS INTEGER) AS do_not_email,
               CAST(c_custkey % 17 = 0 AS INTEGER) AS do_not_mail,
               CAST(c_custkey % 19 = 0 AS INTEGER) AS do_not_phone,
               CAST(c_acctbal < -500 AS INTEGER) AS is_opt_out,
               CAST(c_custkey % 37 = 0 AS INTEGER) AS is_deceased,
               CAST(c_custkey % 41 = 0 AS INTEGER) AS is_deleted
        FROM customer""",
    "address": """
        SELECT 2 * c_custkey AS id, c_custkey AS contact_id, 1 AS is_primary,
               CASE WHEN c_custkey % 23 <> 0 THEN 'Street ' || c_custkey END AS street_address,
               CAST(1000 + c_custkey % 9000 AS VARCHAR) AS postal_code, 'City' || (c_custkey % 20) AS city,
               CASE WHEN c_custkey % 43 <> 0 THEN c_nationkey END AS country_id,
               'State ' || (c_nationkey % 9) AS state_province
        FROM customer
        UNION ALL
        SELECT 2 * c_custkey + 1, c_custkey, 0, 'Second ' || c_custkey, '9999', 'Other',
               CASE WHEN c_custkey % 43 <> 0 THEN c_nationkey END, 'State ' || (c_nationkey % 9)
        FROM customer WHERE c_custkey % 5 = 0""",
    "address_statistics": """
        SELECT 2 * c_custkey AS entity_id, CAST(c_custkey % 4 AS INTEGER) AS rts_counter
        FROM customer WHERE c_custkey % 5 = 0""",
    "country": """
        SELECT n_nationkey AS id,
               CASE WHEN n_nationkey % 2 = 0 THEN 'AT' ELSE 'X' || chr(65 + n_nationkey) END AS iso_code,
               n_name AS name
        FROM nation""",
    "email": """
        SELECT c_custkey AS contact_id, 'c' || c_custkey || '@example.org' AS email, 1 AS is_primary
        FROM customer WHERE c_custkey % 9 <> 0
        UNION ALL
        SELECT c_custkey, 'alt' || c_custkey || '@example.org', 0 FROM customer WHERE c_custkey % 6 = 0""",
    "phone": """
        SELECT c_custkey AS contact_id, CASE WHEN c_custkey % 10 <> 0 THEN '+43' || c_custkey END AS phone,
               1 AS is_primary
        FROM customer WHERE c_custkey % 8 <> 0
        UNION ALL
        SELECT c_custkey, '+44' || c_custkey, 0 FROM customer WHERE c_custkey % 6 = 0""",
    "uf_match": "SELECT c_custkey AS contact_id FROM customer WHERE c_custkey % 21 = 0",
    "crm_group": "SELECT * FROM (VALUES (1, 'Community NL'), (2, 'Donation Info'), (3, 'Erblasser')) v(id, title)",
    "group_contact": """
        SELECT c_custkey AS contact_id, 1 AS group_id,
               CASE WHEN c_custkey % 2 = 0 THEN 'Added' ELSE 'Removed' END AS status
        FROM customer WHERE c_custkey % 3 = 0
        UNION ALL SELECT c_custkey, 2, 'Added' FROM customer WHERE c_custkey % 4 = 0
        UNION ALL SELECT c_custkey, 3, 'Removed' FROM customer WHERE c_custkey % 47 = 0""",
    "tag": """
        SELECT * FROM (VALUES (0, 'inaktiv'), (1, 'VIP'), (2, 'Firma'), (3, 'Schule'), (4, 'other')) v(id, name)""",
    "entity_tag": """
        SELECT c_custkey AS entity_id, c_custkey % 50 AS tag_id,
               CASE WHEN c_custkey % 3 = 0 THEN 'civicrm_activity' ELSE 'civicrm_contact' END AS entity_table
        FROM customer WHERE c_custkey % 50 < 5""",
    "option_group": """
        SELECT * FROM (VALUES (1, 'individual_prefix'), (2, 'payment_instrument'), (3, 'contribution_status'),
                              (4, 'activity_status'), (5, 'activity_type'), (6, 'order_type')) v(id, name)""",
    "option_value": """
        SELECT * FROM (VALUES
            (1, '1', 'Mr', 'Herr'), (1, '2', 'Mrs', 'Frau'), (1, '3', 'Fam', 'Familie'),
            (2, '1', 'RCUR', 'RCUR'), (2, '2', 'FRST', 'FRST'), (2, '3', 'OOFF', 'OOFF'), (2, '4', 'Cash', 'Cash'),
            (3, '1', 'Completed', 'Completed'), (3, '2', 'Pending', 'Pending'), (3, '3', 'Cancelled', 'Cancelled'),
            (4, '1', 'Scheduled', 'Scheduled'), (4, '2', 'Completed', 'Completed'),
            (4, '3', 'Cancelled', 'Cancelled'),
            (5, '32', 'Petition', 'Petition'), (5, '2', 'Phone Call', 'Phone Call'),
            (5, '33', 'Webshop Order', 'Webshop Order'), (5, '34', 'Action', 'Action'),
            (5, '35', 'Outgoing Call', 'Outgoing Call'),
            (6, '0', 'Type 0', 'Type 0'), (6, '1', 'Type 1', 'Type 1'), (6, '2', 'Type 2', 'Type 2'),
            (6, '3', 'Type 3', 'Type 3'), (6, '4', 'Type 4', 'Type 4')) v(option_group_id, value, name, label)""",
    # One row per option with its group's name: how the checks spell "value v of group g".
    "options": """
        SELECT g.name AS group_name, v.value, v.name, v.label
        FROM option_value v JOIN option_group g ON g.id = v.option_group_id""",
    "membership": """
        SELECT o_orderkey AS id, o_custkey AS contact_id, CAST(o_orderdate AS DATE) AS join_date,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS status_id,
               CAST(left(o_orderpriority, 1) AS INTEGER) AS membership_type_id, o_orderkey % 25 AS campaign_id
        FROM orders""",
    "membership_status": "SELECT * FROM (VALUES (1, 'Current'), (2, 'Paused'), (3, 'Cancelled')) v(id, label)",
    "membership_type": """
        SELECT * FROM (VALUES (1, 'Foerderer'), (2, 'Guardian'), (3, 'Schatten'), (4, 'Baum'), (5, 'Meer')) v(id, name)""",
    "value_membership_payment": """
        SELECT o_orderkey AS entity_id, CAST(o_orderkey % 4 + 1 AS INTEGER) AS payment_instrument,
               o_orderkey AS membership_recurring_contribution
        FROM orders""",
    "contribution_recur": """
        SELECT o_orderkey AS id, o_orderdate + to_days(CAST(o_orderkey % 60 AS INTEGER)) AS next_sched_contribution_date
        FROM orders""",
    "contribution": f"""
        SELECT {_LINE_ID} AS id, o_custkey AS contact_id,
               CAST(l_quantity * 10 AS DECIMAL(20, 2)) AS total_amount, l_shipdate AS receive_date,
               CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS contribution_status_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "membership_payment": f"""
        SELECT l_orderkey AS membership_id, {_LINE_ID} AS contribution_id
        FROM lineitem WHERE l_orderkey % 4 <> 0""",
    "activity": f"""
        SELECT {_LINE_ID} AS id, CASE WHEN l_linenumber <= 3 THEN 32 ELSE 2 END AS activity_type_id,
               l_partkey % 25 AS campaign_id,
               CASE WHEN l_linenumber = 5 THEN 3 WHEN l_linestatus = 'F' THEN 2 WHEN l_linestatus = 'O' THEN 1 END
                   AS status_id,
               l_shipdate AS activity_date_time, l_partkey AS source_record_id
        FROM lineitem""",
    "activity_contact": f"""
        SELECT {_LINE_ID} AS activity_id, o_custkey AS contact_id,
               l_linenumber % 3 + 1 AS record_type_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "campaign": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, 'Campaign ' || n_name AS title, n_name AS name,
               CASE n_nationkey WHEN 7 THEN 'AKTION-7767' WHEN 9 THEN 'AKTION-7769' WHEN 11 THEN 'AKTION-7571'
                    ELSE 'A-' || n_nationkey END AS external_identifier,
               25 + n_regionkey AS parent_id
        FROM nation
        UNION ALL
        SELECT 25 + r_regionkey, 'Campaign ' || r_name, r_name, 'A-' || (25 + r_regionkey),
               CASE r_regionkey WHEN 0 THEN 30 WHEN 1 THEN 31 WHEN 2 THEN 31 WHEN 3 THEN 33 WHEN 4 THEN 34 END
        FROM region
        UNION ALL
        SELECT * FROM (VALUES (30, 'TM', 'TM', 'A-30', NULL), (31, 'DD', 'DD', 'A-31', NULL),
                              (32, 'Welcome Calls', 'WC', 'A-32', 30), (33, 'Mid', 'Mid', 'A-33', 31),
                              (34, 'Deep', 'Deep', 'A-34', 33), (35, 'Web Shop', 'Shop', 'Web_Shop', NULL)) v""",
    # Every campaign with its own name and those of up to three ancestors.
    "lineage": """
        SELECT c0.id, [c0.name, c1.name, c2.name, c3.name] AS names
        FROM campaign c0
        LEFT JOIN campaign c1 ON c1.id = c0.parent_id
        LEFT JOIN campaign c2 ON c2.id = c1.parent_id
        LEFT JOIN campaign c3 ON c3.id = c2.parent_id""",
    "survey": """
        SELECT p_partkey AS id, p_name AS title,
               CASE WHEN p_partkey % 8 <> 0 THEN p_partkey % 25 END AS campaign_id, 32 AS activity_type_id
        FROM part""",
    "webshop_order": """
        SELECT event_id AS id, CASE WHEN event_type = 'purchase' THEN 33 ELSE 2 END AS activity_type_id,
               user_id AS source_contact_id, CASE WHEN event_id % 10 <> 0 THEN event_id % 25 END AS campaign_id,
               ts AS activity_date_time, event_type AS details, 1 AS status_id,
               CAST(value >= 5 AS INTEGER) AS payment_received, CAST(event_id % 3 = 0 AS INTEGER) AS order_exported,
               CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR) AS order_type,
               CAST(event_id % 4 + 1 AS INTEGER) AS order_count,
               CASE WHEN event_id % 4 <> 0 THEN 'Shirt ' || (event_id % 3) END AS shirt_type,
               CASE WHEN event_id % 2 = 0 THEN 'S' ELSE 'M' END AS shirt_size,
               CASE WHEN event_id % 5 = 0 THEN CAST(event_id * 7 AS VARCHAR) END AS linked_contribution,
               CASE WHEN event_id % 6 = 1 THEN CAST(event_id AS VARCHAR) END AS linked_membership,
               CASE WHEN event_id % 8 = 1 THEN 'note; "' || event_id || '"' END AS multi_purpose
        FROM events""",
    "routes": """
        SELECT * FROM (VALUES ('default', 'webshopdefault', 'out/default/'), ('1', 'webshop1', 'out/webshop1/'),
                              ('3', 'webshop3', 'out/webshop3/')) v(route_key, file, remote)""",
}

_WORD = re.compile(r"\b[a-z_]+\b")


def with_tables(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind a WITH clause of the tables (and named subqueries) it uses, each after those it needs."""
    known = {**TABLES, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for word in _WORD.findall(text):
            if word in known and word != own and word not in ordered:
                visit(known[word], word)
                if word not in ordered:
                    ordered.append(word)

    visit(body)
    clauses = ",\n".join(f"{name} AS ({known[name].strip()})" for name in ordered)
    return f"WITH {clauses}\n{body.strip()}" if clauses else body.strip()


def with_digests(sql: str) -> str:
    """``sql`` with lines numbered by their digest."""
    return sql.replace(_LINE_ID, _LINE_DIGEST)
