"""Column names and schemas shared by every source, operator and sink."""

from __future__ import annotations

from pyspark.sql import types as T

# The public column order of a revision row.
FIELDS = [
    "id",
    "parent_id",
    "page_title",
    "contributor_id",
    "contributor_name",
    "contributor_ip",
    "timestamp",
    "text",
    "comment",
    "page_id",
    "page_ns",
]

# The columns that may never be null.
REQUIRED = ["id", "timestamp", "page_id", "page_title", "page_ns"]

_TYPES = {
    "id": T.LongType(),
    "parent_id": T.LongType(),
    "contributor_id": T.LongType(),
    "timestamp": T.TimestampType(),
    "page_id": T.LongType(),
    "page_ns": T.IntegerType(),
}

# What the parser and the CSV files hold: text only.
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in FIELDS])

# What tables hold.
TYPED_SCHEMA = T.StructType(
    [T.StructField(name, _TYPES.get(name, T.StringType()), name not in REQUIRED) for name in FIELDS]
)

# XML fragments. Every leaf is a plain string: an element that is absent reads
# as null and one that is empty reads as "", so the two can be told apart
# before both become null.
CORRUPT = "corrupt"
PAGE_XML = f"title string, ns string, id string, {CORRUPT} string"
_REVISION_XML = {
    "id": "id string",
    "parentid": "parentid string",
    "timestamp": "timestamp string",
    "contributor": "contributor struct<ip: string, username: string, id: string>",
    "comment": "comment string",
    "text": "text string",
}


def revision_xml(fields: list[str]) -> str:
    """The part of a revision that these fields are read from."""
    elements = {"parentid" if c == "parent_id" else c.split("_")[0] for c in fields}
    return ", ".join([*[kind for name, kind in _REVISION_XML.items() if name in elements], f"{CORRUPT} string"])
