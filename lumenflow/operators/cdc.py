"""Change-data-capture envelopes: parse, split rejects, newest row per key.

Input rows look like a Kafka source: ``value`` (binary or string JSON),
``partition``, ``offset``, ``timestamp``.  Parsing uses the VARIANT
functions, which keep every case of the envelope apart:

* value not JSON, top level not an object, ``payload`` or ``after`` JSON
  null or not an object  -> ``malformed`` (reported, skipped); white space
  around the JSON and repeated keys (the last one counts) are no fault
* ``payload`` missing or ``op`` not c/u                   -> ``skipped``
* ``op`` c/u with ``after`` missing                      -> ``accepted`` as an
  empty row whose key is null
* otherwise                                               -> ``accepted``

Fields of ``after`` that the row schema doesn't have, and values that don't
fit their declared type, are reported by ``field_report``, and kept by
``latest_with_drift``: its columns are the union of the fields of the images that it
exports.

Messages are consumed by offset: within a partition the offset is the order
(timestamps may go back), and partitions are read side by side, so the order
is (offset, partition).  A key belongs to one partition.

The newest image per key is a plain grouped ``max_by`` (partial aggregate
per map task, so a hot key costs one row per task before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lumenflow.session import materialize

# Operations that carry a new row image (create, update).
UPSERT_OPS = ("c", "u")
ACCEPTED, SKIPPED, MALFORMED = "accepted", "skipped", "malformed"
ORDER_COLUMNS = ("offset", "partition")
JSON_BLANKS = " \t\n\r"


def _is_object(v: Column) -> Column:
    return F.substring(F.schema_of_variant(v), 1, 6) == "OBJECT"


def parse_envelopes(messages: DataFrame, row_schema: StructType | str,
                    partitions: int | None = None) -> DataFrame:
    """Adds ``status``, ``op``, ``after`` (typed by ``row_schema``), ``image`` (all
    of ``after`` as a VARIANT; only the declared fields where the envelope has a key
    twice) and ``fields`` (what ``field_report`` counts).  ``partitions`` deals the
    messages out first, for a source that arrives in fewer tasks than there
    are cores.

    The checks are ordered so that the common case costs one parse and a
    few path lookups: a parsed text is an object iff its first non-blank
    character is ``{``; a payload with an ``op`` is an object; an ``after``
    is an object iff it casts to the row struct.  Only a payload without
    ``op`` has its type inspected.
    """
    if partitions:
        messages = messages.repartition(partitions)
    schema = row_schema if isinstance(row_schema, str) else row_schema.simpleString()
    # Each step is its own column so the text is parsed once per message
    # (Catalyst does not inline an expensive expression used several times).
    staged = messages.withColumn("_t", F.btrim(F.col("value").cast("string"), F.lit(JSON_BLANKS)))
    # A text with a repeated key is no VARIANT; the struct reader keeps the last
    # value, and writing it back makes it one.
    again = F.from_json("_t", f"payload struct<op: string, after: {schema}>, _bad string",
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    staged = (staged
              .withColumn("_v0", F.try_parse_json("_t"))
              .withColumn("_again", F.when(F.col("_v0").isNull() & F.col("_t").startswith("{"), again))
              .withColumn("_v", F.coalesce("_v0", F.try_parse_json(F.when(
                  F.col("_again").isNotNull() & F.col("_again._bad").isNull(),
                  F.to_json(F.struct("_again.payload"))))))
              .withColumn("_p", F.try_variant_get("_v", "$.payload", "variant"))
              .withColumns({"op": F.try_variant_get("_p", "$.op", "string"),
                            "_a": F.try_variant_get("_p", "$.after", "variant")})
              .withColumn("_r", F.try_variant_get("_a", "$", schema)))
    v, payload, op, after, row = (F.col(c) for c in ("_v", "_p", "op", "_a", "_r"))
    status = (
        F.when(v.isNull() | ~F.col("_t").startswith("{"), MALFORMED)
        .when(payload.isNull(), SKIPPED)
        .when(op.isNull(), F.when(_is_object(payload), SKIPPED).otherwise(MALFORMED))
        .when(~op.isin(*UPSERT_OPS), SKIPPED)
        .when(after.isNull(), ACCEPTED)
        .when(row.isNull(), MALFORMED)
        .otherwise(ACCEPTED)
    )
    # An absent ``after`` is an empty row: every field null, key included.
    empty = F.from_json(F.lit("{}"), schema)
    return (staged.withColumns({"status": status,
                                "after": F.when(row.isNull(), empty).otherwise(row)})
            .withColumn("fields", F.when(F.col("status") == ACCEPTED, _field_faults(schema)))
            .withColumnRenamed("_a", "image").drop("_t", "_v0", "_again", "_v", "_p", "_r"))


def _field_faults(schema: str) -> Column:
    """``<field>: unknown`` and ``<field>: type`` of an accepted image."""
    known = StructType.fromDDL(schema[len("struct<"):-1])
    names = F.array(*[F.lit(f.name) for f in known])
    present = F.coalesce(F.json_object_keys(F.to_json("_a")), F.array().cast("array<string>"))
    unknown = F.transform(F.array_except(present, names), lambda n: F.concat(n, F.lit(": unknown")))
    mistyped = F.array_compact(F.array(*[
        F.when(F.try_variant_get("_a", f"$.{f.name}", "string").isNotNull() & F.col(f"_r.{f.name}").isNull(),
               F.lit(f"{f.name}: type")) for f in known]))
    return F.concat(unknown, mistyped)


def field_report(parsed: DataFrame) -> DataFrame:
    """(fault, messages): fields of accepted images that the row schema would
    drop, and values that it turns into null.

    An inner ``explode`` has Spark infer a filter on ``fields``, which is pushed below the
    repartition and parses every message again, in the scan's tasks."""
    return (parsed.select(F.explode_outer("fields").alias("fault")).where(F.col("fault").isNotNull())
            .groupBy("fault").agg(F.count(F.lit(1)).alias("messages")))


def reject_split(parsed: DataFrame) -> DataFrame:
    """One row per message with its outcome."""
    return parsed.select("partition", "offset", "op", "status")


def _order() -> Column:
    return F.struct(*[F.col(c) for c in ORDER_COLUMNS])


def accepted_order(order: Column | None = None) -> Column:
    """The consumption order of accepted messages, null for the others.

    Aggregates skip null orderings, so acceptance is applied inside the
    aggregate rather than by a filter: a filter on ``status`` would be
    pushed below the repartition and evaluate the parse a second time, in
    the scan task."""
    return F.when(F.col("status") == ACCEPTED, _order() if order is None else order)


def latest_by_key(parsed: DataFrame, key: str) -> DataFrame:
    """Last image per key in consumption order, expanded to columns."""
    fields = parsed.schema["after"].dataType.fieldNames()
    newest = (parsed.groupBy(F.col("after")[key].alias("_key"))
              .agg(F.max_by("after", accepted_order()).alias("_row"),
                   F.max(accepted_order()).alias("_last")))
    return (newest.where(F.col("_last").isNotNull())
            .select(*[F.col("_row")[f].alias(f) for f in fields]))


MOST_FIELDS = 5_000         # names of a topic's fields; beyond, the names are data


def _path(field: str) -> str:
    escaped = field.replace("\\", "\\\\").replace('"', '\\"')
    return f'$["{escaped}"]'


def latest_with_drift(parsed: DataFrame, key: str) -> DataFrame:
    """Last image per key with every field that any of them has: the declared
    columns in their order, then the others by name.

    A declared column keeps its type if all these images fit it and is text otherwise;
    another column has the type that its values share (text where they share none, JSON
    text of objects and arrays).  The fields are found in the images that are exported,
    not in the whole topic; only their names and types come to the driver."""
    declared = {f.name: f.dataType.simpleString() for f in parsed.schema["after"].dataType}
    image = F.to_json("image")
    newest = (parsed.groupBy(F.col("after")[key].alias("_key"))
              .agg(F.max_by(F.struct(F.col("after").alias("row"), image.alias("image")), accepted_order()).alias("_m"),
                   F.max(accepted_order()).alias("_last"))
              .where(F.col("_last").isNotNull()).select("_m.row", "_m.image"))
    # written: it is read for the fields, for their types and for the rows
    newest = materialize(newest, "images")
    named = (newest.select(F.explode(F.json_object_keys("image")).alias("f")).distinct().limit(MOST_FIELDS + 1).collect())
    if len(named) > MOST_FIELDS:
        raise ValueError(f"more than {MOST_FIELDS} fields: these images are no table")
    added = sorted(r["f"] for r in named if r["f"] not in declared)
    images = newest.select("row", F.try_parse_json("image").alias("v"))
    text = {f: F.try_variant_get("v", _path(f), "string") for f in (*declared, *added)}
    kinds = images.agg(
        *[F.max(text[f].isNotNull() & F.col("row")[f].isNull()).alias(f"d{i}") for i, f in enumerate(declared)],
        *[F.schema_of_variant_agg(F.try_variant_get("v", _path(f), "variant")).alias(f"a{i}") for i, f in enumerate(added)]).first()
    columns = [(text[f] if kinds[f"d{i}"] else F.col("row")[f]).alias(f) for i, f in enumerate(declared)]
    for i, f in enumerate(added):
        kind = (kinds[f"a{i}"] or "VOID").lower()
        simple = kind in ("bigint", "double", "boolean") or kind.startswith("decimal(")
        columns.append((F.try_variant_get("v", _path(f), kind) if simple else text[f]).alias(f))
    return images.select(*columns)


def key_bound_cutoff(parsed: DataFrame, key: str, batch_size: int, order: Column | None = None):
    """Order position at which a sequential consumer holding at most
    ``batch_size`` distinct keys stops, or None when it reads everything.

    The first position of every key is one grouped aggregate; the
    ``batch_size`` smallest are a top-k (``TakeOrderedAndProject``: k rows
    per task, merged once), and only one scalar reaches the driver.
    """
    firsts = (parsed.groupBy(F.col("after")[key].alias("_key"))
              .agg(F.min(accepted_order(order)).alias("_first"))
              .where(F.col("_first").isNotNull()))
    top = firsts.orderBy("_first").limit(batch_size)
    row = top.agg(F.count(F.lit(1)).alias("n"), F.max("_first").alias("cut")).first()
    if row is None or row["n"] < batch_size:
        return None
    return row["cut"]


def position(cut, parsed: DataFrame) -> Column:
    """The struct literal of a position."""
    return F.struct(*[F.lit(cut[c]).cast(parsed.schema[c].dataType).alias(c) for c in ORDER_COLUMNS])


def key_bounded_batch(parsed: DataFrame, key: str, batch_size: int) -> DataFrame:
    """Newest image per key among the messages of the first batch."""
    cut = key_bound_cutoff(parsed, key, batch_size)
    if cut is not None:
        parsed = parsed.where(_order() <= position(cut, parsed))
    return latest_by_key(parsed, key)


def export_name(topic: str) -> str:
    """File name of the export of ``topic``: dots become underscores."""
    return topic.replace(".", "_")
