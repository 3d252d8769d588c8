"""CRM tables derived from the star-schema test tables, as laid down in FIXTURES.md.

Every table is built on first use, so a query touches only the files it needs.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from muster.schemas import SCHEMAS
from muster.sources.local import local_rows
from muster.sources.tables import LazyTables, rename_custom

AS_OF = datetime(2001, 7, 15, 12, 0, 0)
FLOOR_DAY = "1995-01-01"
ROUTES = (
    '{"default":{"file":"webshopdefault","remote":"out/default/"},'
    '"1":{"file":"webshop1","remote":"out/webshop1/"},'
    '"3":{"file":"webshop3","remote":"out/webshop3/"}}'
)
CUSTOM_FIELDS = {
    "payment_received": 201,
    "order_exported": 202,
    "order_exported_date": 203,
    "order_type": 204,
    "order_count": 205,
    "shirt_type": 206,
    "shirt_size": 207,
    "linked_contribution": 208,
    "linked_membership": 209,
    "multi_purpose": 210,
}

# Groups, tags, options, statuses, types and campaigns that the rules look for.
_GROUPS = [(1, "Community NL"), (2, "Donation Info"), (3, "Erblasser")]
_TAGS = [(0, "inaktiv"), (1, "VIP"), (2, "Firma"), (3, "Schule"), (4, "other")]
_OPTION_GROUPS = [
    (1, "individual_prefix"),
    (2, "payment_instrument"),
    (3, "contribution_status"),
    (4, "activity_status"),
    (5, "activity_type"),
    (6, "order_type"),
]
_OPTION_VALUES = [
    (1, "1", "Mr", "Herr"),
    (1, "2", "Mrs", "Frau"),
    (1, "3", "Fam", "Familie"),
    (2, "1", "RCUR", "RCUR"),
    (2, "2", "FRST", "FRST"),
    (2, "3", "OOFF", "OOFF"),
    (2, "4", "Cash", "Cash"),
    (3, "1", "Completed", "Completed"),
    (3, "2", "Pending", "Pending"),
    (3, "3", "Cancelled", "Cancelled"),
    (4, "1", "Scheduled", "Scheduled"),
    (4, "2", "Completed", "Completed"),
    (4, "3", "Cancelled", "Cancelled"),
    (5, "32", "Petition", "Petition"),
    (5, "2", "Phone Call", "Phone Call"),
    (5, "33", "Webshop Order", "Webshop Order"),
    (5, "34", "Action", "Action"),
    (5, "35", "Outgoing Call", "Outgoing Call"),
    *[(6, str(n), f"Type {n}", f"Type {n}") for n in range(5)],
]
_STATUSES = [(1, "Current"), (2, "Paused"), (3, "Cancelled")]
_TYPES = [(1, "Foerderer"), (2, "Guardian"), (3, "Schatten"), (4, "Baum"), (5, "Meer")]
_TOP_CAMPAIGNS = [
    (30, "TM", "TM", "A-30", None),
    (31, "DD", "DD", "A-31", None),
    (32, "Welcome Calls", "WC", "A-32", 30),
    (33, "Mid", "Mid", "A-33", 31),
    (34, "Deep", "Deep", "A-34", 33),
    (35, "Web Shop", "Shop", "Web_Shop", None),
]


_SCHEMAS: dict[str, dict[str, T.StructType]] = {}


class DerivedTables(LazyTables):
    """The CRM tables over the parquet files of one test data folder."""

    def __init__(self, spark: SparkSession, directory: str, line_id: str | None = None):
        super().__init__(lambda name: _BUILDERS[name](self))
        self._spark = spark
        self._directory = directory
        self.line_id = line_id or _LINE_ID
        self._base: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self._read(f"{self._directory}/{name}.parquet")
        return self._base[name]

    def _read(self, path: str) -> DataFrame:
        """Infer a file's schema once per session; each inference is a job of its own."""
        known = _SCHEMAS.setdefault(self._spark.sparkContext.applicationId, {})
        if path not in known:
            known[path] = self._spark.read.parquet(path).schema
        return self._spark.read.schema(known[path]).parquet(path)

    def numbered(self, line_id: str) -> DerivedTables:
        """The same tables with another number of the lines."""
        return DerivedTables(self._spark, self._directory, line_id)

    def rows(self, name: str, values: list[tuple]) -> DataFrame:
        return local_rows(self._spark, values, SCHEMAS[name])


def _contact(d: DerivedTables) -> DataFrame:
    return d.base("customer").selectExpr(
        "c_custkey AS id",
        "md5(c_name) AS hash",
        "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN concat('USER-', c_custkey)"
        " ELSE concat('IMB-', c_custkey) END AS external_identifier",
        "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Household' WHEN 'MACHINERY' THEN 'Organization'"
        " ELSE 'Individual' END AS contact_type",
        "nullif(c_custkey % 4, 0) AS prefix_id",
        "if(c_custkey % 29 = 0, NULL, concat('F', c_custkey)) AS first_name",
        "concat('L', c_custkey) AS last_name",
        "concat('O', c_custkey) AS organization_name",
        "if(c_custkey % 31 = 0, NULL, concat('H', c_custkey)) AS household_name",
        "if(c_custkey % 10 = 0, 'Dr', NULL) AS formal_title",
        "date_add(DATE'1950-01-01', CAST(c_custkey % 18000 AS INT)) AS birth_date",
        "CAST(c_custkey % 13 = 0 AS INT) AS do_not_email",
        "CAST(c_custkey % 17 = 0 AS INT) AS do_not_mail",
        "CAST(c_custkey % 19 = 0 AS INT) AS do_not_phone",
        "CAST(c_acctbal < -500 AS INT) AS is_opt_out",
        "CAST(c_custkey % 37 = 0 AS INT) AS is_deceased",
        "CAST(c_custkey % 41 = 0 AS INT) AS is_deleted",
    )


def _address(d: DerivedTables) -> DataFrame:
    customer = d.base("customer")
    country = "if(c_custkey % 43 = 0, NULL, c_nationkey) AS country_id"
    state = "concat('State ', c_nationkey % 9) AS state_province"
    first = customer.selectExpr(
        "2 * c_custkey AS id",
        "c_custkey AS contact_id",
        "1 AS is_primary",
        "if(c_custkey % 23 = 0, NULL, concat('Street ', c_custkey)) AS street_address",
        "CAST(1000 + c_custkey % 9000 AS STRING) AS postal_code",
        "concat('City', c_custkey % 20) AS city",
        country,
        state,
    )
    second = customer.filter("c_custkey % 5 = 0").selectExpr(
        "2 * c_custkey + 1 AS id",
        "c_custkey AS contact_id",
        "0 AS is_primary",
        "concat('Second ', c_custkey) AS street_address",
        "'9999' AS postal_code",
        "'Other' AS city",
        country,
        state,
    )
    return first.unionByName(second)


def _address_statistics(d: DerivedTables) -> DataFrame:
    return (
        d.base("customer")
        .filter("c_custkey % 5 = 0")
        .selectExpr("2 * c_custkey AS entity_id", "c_custkey % 4 AS rts_counter")
    )


def _country(d: DerivedTables) -> DataFrame:
    return d.base("nation").selectExpr(
        "n_nationkey AS id",
        "if(n_nationkey % 2 = 0, 'AT', concat('X', chr(65 + n_nationkey))) AS iso_code",
        "n_name AS name",
    )


def _email(d: DerivedTables) -> DataFrame:
    customer = d.base("customer")
    first = customer.filter("c_custkey % 9 <> 0").selectExpr(
        "c_custkey AS contact_id", "concat('c', c_custkey, '@example.org') AS email", "1 AS is_primary"
    )
    second = customer.filter("c_custkey % 6 = 0").selectExpr(
        "c_custkey AS contact_id", "concat('alt', c_custkey, '@example.org') AS email", "0 AS is_primary"
    )
    return first.unionByName(second)


def _phone(d: DerivedTables) -> DataFrame:
    customer = d.base("customer")
    first = customer.filter("c_custkey % 8 <> 0").selectExpr(
        "c_custkey AS contact_id",
        "if(c_custkey % 10 = 0, NULL, concat('+43', c_custkey)) AS phone",
        "1 AS is_primary",
    )
    second = customer.filter("c_custkey % 6 = 0").selectExpr(
        "c_custkey AS contact_id", "concat('+44', c_custkey) AS phone", "0 AS is_primary"
    )
    return first.unionByName(second)


def _uf_match(d: DerivedTables) -> DataFrame:
    return d.base("customer").filter("c_custkey % 21 = 0").selectExpr("c_custkey AS contact_id")


def _group_contact(d: DerivedTables) -> DataFrame:
    customer = d.base("customer")
    community = customer.filter("c_custkey % 3 = 0").selectExpr(
        "c_custkey AS contact_id", "1 AS group_id", "if(c_custkey % 2 = 0, 'Added', 'Removed') AS status"
    )
    donation = customer.filter("c_custkey % 4 = 0").selectExpr(
        "c_custkey AS contact_id", "2 AS group_id", "'Added' AS status"
    )
    legacy = customer.filter("c_custkey % 47 = 0").selectExpr(
        "c_custkey AS contact_id", "3 AS group_id", "'Removed' AS status"
    )
    return community.unionByName(donation).unionByName(legacy)


def _entity_tag(d: DerivedTables) -> DataFrame:
    return (
        d.base("customer")
        .filter("c_custkey % 50 < 5")
        .selectExpr(
            "c_custkey AS entity_id",
            "c_custkey % 50 AS tag_id",
            "if(c_custkey % 3 = 0, 'civicrm_activity', 'civicrm_contact') AS entity_table",
        )
    )


def _membership(d: DerivedTables) -> DataFrame:
    return d.base("orders").selectExpr(
        "o_orderkey AS id",
        "o_custkey AS contact_id",
        "CAST(o_orderdate AS DATE) AS join_date",
        "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS status_id",
        "CAST(left(o_orderpriority, 1) AS INT) AS membership_type_id",
        "o_orderkey % 25 AS campaign_id",
    )


def _value_membership_payment(d: DerivedTables) -> DataFrame:
    return d.base("orders").selectExpr(
        "o_orderkey AS entity_id",
        "CAST(o_orderkey % 4 + 1 AS INT) AS payment_instrument",
        "o_orderkey AS membership_recurring_contribution",
    )


def _contribution_recur(d: DerivedTables) -> DataFrame:
    return d.base("orders").selectExpr(
        "o_orderkey AS id",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) + make_dt_interval(CAST(o_orderkey % 60 AS INT))"
        " AS next_sched_contribution_date",
    )


# A line's own number: an order may hold one line number several times, but not at one price.
_LINE_ID = "(l_orderkey * 8 + l_linenumber) * 16777216 + CAST(round(l_extendedprice * 100) AS BIGINT)"
# One that also tells lines of one number and price apart by part and supplier.
LINE_DIGEST = (
    "CAST(conv(left(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,"
    " CAST(round(l_extendedprice * 100) AS BIGINT))), 15), 16, 10) AS BIGINT)"
)


def _lines_with_customer(d: DerivedTables) -> DataFrame:
    orders = d.base("orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
    return d.base("lineitem").join(orders, "l_orderkey")


def _contribution(d: DerivedTables) -> DataFrame:
    return _lines_with_customer(d).selectExpr(
        f"{d.line_id} AS id",
        "o_custkey AS contact_id",
        "CAST(l_quantity * 10 AS DECIMAL(20, 2)) AS total_amount",
        "l_shipdate AS receive_date",
        "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS contribution_status_id",
    )


def _membership_payment(d: DerivedTables) -> DataFrame:
    # Every fourth membership was never charged.
    charged = d.base("lineitem").filter("l_orderkey % 4 <> 0")
    return charged.selectExpr("l_orderkey AS membership_id", f"{d.line_id} AS contribution_id")


def _activity(d: DerivedTables) -> DataFrame:
    return d.base("lineitem").selectExpr(
        f"{d.line_id} AS id",
        "if(l_linenumber <= 3, 32, 2) AS activity_type_id",
        "l_partkey % 25 AS campaign_id",
        "CASE WHEN l_linenumber = 5 THEN 3 WHEN l_linestatus = 'F' THEN 2 WHEN l_linestatus = 'O' THEN 1 END"
        " AS status_id",
        "l_shipdate AS activity_date_time",
        "l_partkey AS source_record_id",
    )


def _activity_contact(d: DerivedTables) -> DataFrame:
    return _lines_with_customer(d).selectExpr(
        f"{d.line_id} AS activity_id",
        "o_custkey AS contact_id",
        "l_linenumber % 3 + 1 AS record_type_id",
    )


def _campaign(d: DerivedTables) -> DataFrame:
    nations = d.base("nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS id",
        "concat('Campaign ', n_name) AS title",
        "n_name AS name",
        "CASE n_nationkey WHEN 7 THEN 'AKTION-7767' WHEN 9 THEN 'AKTION-7769' WHEN 11 THEN 'AKTION-7571'"
        " ELSE concat('A-', n_nationkey) END AS external_identifier",
        "CAST(25 + n_regionkey AS BIGINT) AS parent_id",
    )
    regions = d.base("region").selectExpr(
        "CAST(25 + r_regionkey AS BIGINT) AS id",
        "concat('Campaign ', r_name) AS title",
        "r_name AS name",
        "concat('A-', 25 + r_regionkey) AS external_identifier",
        "CAST(CASE r_regionkey WHEN 0 THEN 30 WHEN 1 THEN 31 WHEN 2 THEN 31 WHEN 3 THEN 33 WHEN 4 THEN 34 END"
        " AS BIGINT) AS parent_id",
    )
    return nations.unionByName(regions).unionByName(d.rows("campaign", _TOP_CAMPAIGNS))


def _survey(d: DerivedTables) -> DataFrame:
    return d.base("part").selectExpr(
        "p_partkey AS id",
        "p_name AS title",
        "if(p_partkey % 8 = 0, NULL, p_partkey % 25) AS campaign_id",
        "32 AS activity_type_id",
    )


def webshop_activity(d: DerivedTables) -> DataFrame:
    """Shop events as the CRM stores them: custom fields under their numbers."""
    names = {name: f"custom_{field_id}" for name, field_id in CUSTOM_FIELDS.items()}
    return d.base("events").selectExpr(
        "event_id AS id",
        "if(event_type = 'purchase', 33, 2) AS activity_type_id",
        "user_id AS source_contact_id",
        "if(event_id % 10 = 0, NULL, event_id % 25) AS campaign_id",
        "ts AS activity_date_time",
        "event_type AS details",
        "1 AS status_id",
        f"CAST(value >= 5 AS INT) AS {names['payment_received']}",
        f"CAST(event_id % 3 = 0 AS INT) AS {names['order_exported']}",
        f"CAST(NULL AS TIMESTAMP_NTZ) AS {names['order_exported_date']}",
        f"CAST(CAST(get_json_object(props, '$.k') AS INT) % 5 AS STRING) AS {names['order_type']}",
        f"CAST(event_id % 4 + 1 AS INT) AS {names['order_count']}",
        f"if(event_id % 4 = 0, NULL, concat('Shirt ', event_id % 3)) AS {names['shirt_type']}",
        f"if(event_id % 2 = 0, 'S', 'M') AS {names['shirt_size']}",
        f"if(event_id % 5 = 0, CAST(event_id * 7 AS STRING), NULL) AS {names['linked_contribution']}",
        f"if(event_id % 6 = 1, CAST(event_id AS STRING), NULL) AS {names['linked_membership']}",
        f"if(event_id % 8 = 1, concat('note; \"', event_id, '\"'), NULL) AS {names['multi_purpose']}",
    )


def _webshop_order(d: DerivedTables) -> DataFrame:
    return rename_custom(webshop_activity(d), CUSTOM_FIELDS)


_BUILDERS: dict[str, Callable[[DerivedTables], DataFrame]] = {
    "contact": _contact,
    "address": _address,
    "address_statistics": _address_statistics,
    "country": _country,
    "email": _email,
    "phone": _phone,
    "uf_match": _uf_match,
    "group": lambda d: d.rows("group", _GROUPS),
    "group_contact": _group_contact,
    "tag": lambda d: d.rows("tag", _TAGS),
    "entity_tag": _entity_tag,
    "option_group": lambda d: d.rows("option_group", _OPTION_GROUPS),
    "option_value": lambda d: d.rows("option_value", _OPTION_VALUES),
    "membership": _membership,
    "membership_status": lambda d: d.rows("membership_status", _STATUSES),
    "membership_type": lambda d: d.rows("membership_type", _TYPES),
    "value_membership_payment": _value_membership_payment,
    "contribution_recur": _contribution_recur,
    "contribution": _contribution,
    "membership_payment": _membership_payment,
    "activity": _activity,
    "activity_contact": _activity_contact,
    "campaign": _campaign,
    "survey": _survey,
    "webshop_order": _webshop_order,
}
