"""JSON payload encode/decode (E12, E13) and value forms for encoding.

The payload is the public envelope in field order; null images stay as an
explicit ``null``.  Within an image the keys come out in name order because
images are built with sorted fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowcast.model import ENVELOPE_FIELDS, GTID_SEQ, GTID_UUID, POS

JSON_OPTIONS = {"ignoreNullFields": "false"}
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DATE_FORMAT = "yyyy-MM-dd"


def payload_parts(events: DataFrame) -> list[Column]:
    """The envelope fields of ``events`` in the form that is encoded: images
    with their columns in name order and times in one text format, whichever
    layout they come in."""
    from rowcast.operators.mixed import sorted_rows

    parts = []
    for f in ENVELOPE_FIELDS:
        dt = events.schema[f].dataType
        if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.MapType):
            parts.append(sorted_rows(F.col(f)).alias(f))
        elif isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
            parts.append(prepare_images(F.col(f), dt.elementType).alias(f))
        else:
            parts.append(F.col(f))
    return parts


def payload(events: DataFrame) -> Column:
    """The JSON text of each of ``events``."""
    return F.to_json(F.struct(*payload_parts(events)), JSON_OPTIONS)


def image_json(image: str | Column) -> Column:
    c = F.col(image) if isinstance(image, str) else image
    return F.to_json(c, JSON_OPTIONS)


def encode(events: DataFrame, keep: tuple[str, ...] = (GTID_UUID, GTID_SEQ, POS)) -> DataFrame:
    """Events -> delivery records ``(pipeline, topic, key, value, <position>)``.

    Both image layouts encode to the same text (:func:`payload`).
    """
    side = [c for c in keep if c in events.columns]
    value = payload(events)
    return events.select(F.col("meta.pipeline").alias("pipeline"), F.col("kafka.topic").alias("topic"),
                         F.col("kafka.key").alias("key"), value.alias("value"), *side)


def event_schema(image_type: T.DataType) -> T.StructType:
    """Schema to decode a payload whose images have ``image_type``."""
    imgs = T.ArrayType(image_type)
    return T.StructType([
        T.StructField("schema", T.StringType()), T.StructField("table", T.StringType()),
        T.StructField("action", T.StringType()), T.StructField("before", imgs), T.StructField("after", imgs),
        T.StructField("meta", T.StructType([T.StructField("timestamp", T.LongType()),
                                            T.StructField("pipeline", T.StringType())])),
        T.StructField("kafka", T.StructType([T.StructField("topic", T.StringType()),
                                             T.StructField("key", T.StringType())])),
    ])


def decode(records: DataFrame, image_type: T.DataType | str, value: str = "value") -> DataFrame:
    """Delivered JSON -> typed event columns (consumer side).

    ``image_type`` may also be a DDL string such as
    ``"struct<int_col:int,text_col:string>"`` or ``"map<string,string>"``.
    """
    it = T._parse_datatype_string(image_type) if isinstance(image_type, str) else image_type
    parsed = F.from_json(F.col(value), event_schema(it))
    rest = [c for c in records.columns if c != value]
    return records.select(*rest, parsed.alias("_evt")).select(*rest, "_evt.*")


def json_forms(image_type: T.StructType) -> dict[str, callable]:
    """Per-field conversion into the JSON form we emit.

    Timestamps become ``yyyy-MM-dd HH:mm:ss.SSSSSS`` text (to_json would add a
    ``T`` and an offset); everything else is left to ``to_json`` (binary is
    base64, dates ``yyyy-MM-dd``, decimals as numbers).
    """
    out = {}
    for f in image_type.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out[f.name] = lambda c: F.date_format(c, TIME_FORMAT)
    return out


def prepare_images(image: Column, image_type: T.StructType) -> Column:
    """Apply :func:`json_forms` inside every row of an image list."""
    forms = json_forms(image_type)
    if not forms:
        return image

    def fix(r):
        for name, fn in forms.items():
            r = r.withField(name, fn(r[name]))
        return r
    return F.transform(image, fix)


def decode_variant(records: DataFrame, value: str = "value") -> DataFrame:
    """E13 without a schema: the payload as a ``variant`` column ``event``;
    read fields with ``variant_get(event, '$.after[0].text_col', 'string')``."""
    return records.withColumn("event", F.parse_json(F.col(value)))
