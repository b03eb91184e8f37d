"""Scalar Column builders; all are built-in Spark expressions (no Python UDFs)."""

from rillflow.functions.identity import (canonical_json, content_hash, record_identity, record_identity_from_json,
                                         truncate_payload)
from rillflow.functions.numeric import parse_litres, parse_litres_text, with_litres
from rillflow.functions.temporal import (date_from_name, day_floor, normalize_date_text, parse_timestamp_text,
                                         parse_timestamp_variant, utc_datetime, with_timestamp,
                                         with_timestamp_variant)
from rillflow.functions.variant import (ALIAS_KEYS, DEVICE_KEYS, TIME_KEYS, VALUE_KEYS, meter_key, strip_text, truthy_sql, variant_text)

__all__ = [
    "ALIAS_KEYS", "DEVICE_KEYS", "TIME_KEYS", "VALUE_KEYS", "canonical_json", "content_hash", "date_from_name",
    "day_floor", "meter_key", "normalize_date_text",
    "parse_litres", "parse_litres_text", "parse_timestamp_text", "parse_timestamp_variant", "record_identity",
    "record_identity_from_json",
    "strip_text", "truncate_payload", "truthy_sql", "utc_datetime", "variant_text", "with_litres", "with_timestamp",
    "with_timestamp_variant",
]
