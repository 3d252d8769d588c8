"""The load contract: one schema per CRM table, holding the columns the exports read."""

from __future__ import annotations

from pyspark.sql import types as T

_FIELD_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "money": T.DecimalType(20, 2),
}


def _schema(columns: str) -> T.StructType:
    pairs = (column.split(":") for column in columns.split())
    return T.StructType([T.StructField(name, _FIELD_TYPES[kind], True) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {
    "contact": _schema(
        "id:bigint hash:string external_identifier:string contact_type:string prefix_id:bigint"
        " first_name:string last_name:string organization_name:string household_name:string"
        " formal_title:string birth_date:date do_not_email:int do_not_mail:int do_not_phone:int"
        " is_opt_out:int is_deceased:int is_deleted:int"
    ),
    "address": _schema(
        "id:bigint contact_id:bigint is_primary:int street_address:string postal_code:string"
        " city:string country_id:int state_province:string"
    ),
    "address_statistics": _schema("entity_id:bigint rts_counter:int"),
    "country": _schema("id:int iso_code:string name:string"),
    "email": _schema("contact_id:bigint email:string is_primary:int"),
    "phone": _schema("contact_id:bigint phone:string is_primary:int"),
    "uf_match": _schema("contact_id:bigint"),
    "group": _schema("id:bigint title:string"),
    "group_contact": _schema("contact_id:bigint group_id:bigint status:string"),
    "tag": _schema("id:bigint name:string"),
    "entity_tag": _schema("entity_id:bigint tag_id:bigint entity_table:string"),
    "option_group": _schema("id:bigint name:string"),
    "option_value": _schema("option_group_id:bigint value:string name:string label:string"),
    "membership": _schema(
        "id:bigint contact_id:bigint join_date:date status_id:int membership_type_id:int campaign_id:bigint"
    ),
    "membership_status": _schema("id:int label:string"),
    "membership_type": _schema("id:int name:string"),
    "value_membership_payment": _schema(
        "entity_id:bigint payment_instrument:int membership_recurring_contribution:bigint"
    ),
    "contribution_recur": _schema("id:bigint next_sched_contribution_date:timestamp"),
    "contribution": _schema(
        "id:bigint contact_id:bigint total_amount:money receive_date:timestamp contribution_status_id:int"
    ),
    "membership_payment": _schema("membership_id:bigint contribution_id:bigint"),
    "activity": _schema(
        "id:bigint activity_type_id:int campaign_id:bigint status_id:int activity_date_time:timestamp"
        " source_record_id:bigint"
    ),
    "activity_contact": _schema("activity_id:bigint contact_id:bigint record_type_id:int"),
    "campaign": _schema("id:bigint title:string name:string external_identifier:string parent_id:bigint"),
    "survey": _schema("id:bigint title:string campaign_id:bigint activity_type_id:int"),
    "webshop_order": _schema(
        "id:bigint activity_type_id:int source_contact_id:bigint campaign_id:bigint activity_date_time:timestamp"
        " details:string status_id:int payment_received:int order_exported:int order_exported_date:timestamp"
        " order_type:string order_count:int shirt_type:string shirt_size:string linked_contribution:string"
        " linked_membership:string multi_purpose:string"
    ),
}
