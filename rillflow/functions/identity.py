"""Record identity (F7, F8) and payload truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the largest payload the truncating store keeps, in characters.
PAYLOAD_LIMIT = 30000


def canonical_json(v: Column) -> Column:
    """JSON text of a VARIANT with object keys sorted at every depth."""
    return F.to_json(v)


def content_hash(text: Column) -> Column:
    """SHA-256 hex of a canonical text."""
    return F.sha2(text, 256)


# Keys that change from run to run and are no part of a record's identity.
VOLATILE_KEYS = ("_ingested_at", "_run_id", "_saved_at", "_last_run_id")


def without_keys(payload: Column, keys, present: Column) -> Column:
    """A payload without the given top-level keys; only one for which ``present`` holds is taken apart."""
    rest = F.to_variant_object(F.map_filter(payload.try_cast("map<string,variant>"), lambda k, _v: ~k.isin(*keys)))
    return F.when(present, rest).otherwise(payload)


def stable_json(payload: Column, canon: Column) -> Column:
    """The canonical JSON ``canon`` of an object without its top-level volatile keys.

    A text without the two characters that begin such a key is taken as it is; the rest, few or none, are looked at.
    """
    named = canon.startswith("{") & canon.contains('"_') & canon.rlike('"(?:' + "|".join(VOLATILE_KEYS) + ')":')
    return F.when(named, canonical_json(without_keys(payload, VOLATILE_KEYS, F.lit(True)))).otherwise(canon)


def record_identity(payload: Column, source_file: Column) -> Column:
    """F8: stable identity of a record.

    The volatile stamps (ingest time, run id, save time, last run id) are not part of it, neither beside the payload nor
    as keys inside it: only the rest of the payload and the source file name are hashed, so a re-ingest of the same file
    content yields the same id.
    """
    return record_identity_from_json(stable_json(payload, canonical_json(payload)), source_file)


def record_identity_from_json(payload_json: Column, source_file: Column) -> Column:
    """``record_identity`` when the payload's canonical JSON is already at hand.

    The canonical document ``{"_source_file": s, "payload": p}`` has its keys in sorted
    order, so its text is assembled around the existing payload JSON instead of
    serialising the payload a second time.
    """
    text = F.concat(F.lit('{"_source_file":'), F.to_json(source_file.cast("variant")), F.lit(',"payload":'),
                    payload_json, F.lit("}"))
    return content_hash(text)


def truncate_payload(text: Column, limit: int = PAYLOAD_LIMIT) -> Column:
    """keep the first ``limit`` characters."""
    return F.substring(text, 1, limit)
