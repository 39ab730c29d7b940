"""Event data model: field names, action and verdict constants, schemas.

A change event is one DataFrame row.  Its public part (what is encoded and
delivered) is, in this order::

    schema, table, action, before, after, meta, kafka

``before``/``after`` are lists of row images (``array<struct>`` in the typed
layout, ``array<map<string,string>>`` in the mixed layout).  Side columns that
are carried along but never encoded hold the source position.
"""

from __future__ import annotations

# Fixed values of the event contract (must equal the upstream tool's).
ACTION_INSERT = "insert"
ACTION_UPDATE = "update"
ACTION_DELETE = "delete"
ROW_ACTIONS = (ACTION_INSERT, ACTION_UPDATE, ACTION_DELETE)

ACTION_CONT = 0
ACTION_DROP = 1

TOPIC_SEPARATOR = "."
KEY_SEPARATOR = "."
MASK_TEXT = "****"

# Public envelope fields, in encoding order.
ENVELOPE_FIELDS = ("schema", "table", "action", "before", "after", "meta", "kafka")

# Side columns: carried with the event, never encoded.
GTID_UUID = "gtid_uuid"
GTID_SEQ = "gtid_seq"
POS = "pos"

# Raw change-log columns (the input contract of the envelope builder).
RAW_ROWS = "rows"
RAW_PK = "pk_columns"

# Internal bookkeeping columns of the rule fold.
VERDICT_COL = "_verdict"
ERROR_COL = "_error"
