"""Helpers for hand-made CRM rows."""

from __future__ import annotations

OPTION_GROUPS = [
    {"id": number, "name": name}
    for number, name in enumerate(
        ["individual_prefix", "payment_instrument", "contribution_status", "activity_status", "activity_type", "order_type"],
        start=1,
    )
]


def option(group: str, value: str, label: str, name: str | None = None) -> dict:
    number = next(entry["id"] for entry in OPTION_GROUPS if entry["name"] == group)
    return {"option_group_id": number, "value": value, "name": name or label, "label": label}


def values(df, column: str) -> list:
    return sorted((row[column] for row in df.select(column).collect()), key=lambda v: (v is None, v))
