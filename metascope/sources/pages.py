"""Reading landed pages: one JSON envelope per line, an array of records in each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookups import LANDED
from .schemas import DETAILS, ENVELOPES, PLAIN_NAMES


ON_DAMAGE = ("fail", "column", "skip")
DAMAGED = "damaged_page"


def _reading(on_damage: str) -> dict[str, str]:
    if on_damage not in ON_DAMAGE:
        raise ValueError(f"on_damage must be one of {ON_DAMAGE}: {on_damage!r}")
    return {"mode": "FAILFAST"} if on_damage == "fail" else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": DAMAGED}


def _records(pages: DataFrame, entity: str, envelope: str) -> DataFrame:
    field, _ = ENVELOPES[entity]
    context = [c for c in pages.columns if c not in (field, envelope)]
    records = F.col(envelope)
    if DAMAGED in context:
        # A damaged page has a row of its own, with its text, besides the records that could be read.
        records = F.when(F.col(DAMAGED).isNull(), records).otherwise(F.concat(F.coalesce(records, F.array()), F.array(F.lit(None))))
    rows = pages.select(*context, F.explode(records).alias("record"))
    if DAMAGED in context:
        rows = rows.withColumn(DAMAGED, F.when(F.col("record").isNull(), F.col(DAMAGED)))
    if entity in PLAIN_NAMES:
        return rows.withColumnRenamed("record", PLAIN_NAMES[entity])
    return rows.select(*context, "record.*")


def _envelope(entity: str, fields: Sequence[str] | None) -> T.StructType:
    """Type of a page, its records cut down to ``fields``."""
    field, record = ENVELOPES[entity]
    kind = T.StructType.fromDDL(f"record {record}")["record"].dataType
    if fields is not None:
        if not isinstance(kind, T.StructType):
            raise ValueError(f"records of {entity} have no fields")
        kind = T.StructType([kind[f] for f in fields])
    return T.StructType([T.StructField(field, T.ArrayType(kind))])


def _with_damaged(schema: T.StructType, on_damage: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAMAGED, T.StringType())]) if on_damage == "column" else schema


def read_pages(
    spark: SparkSession,
    path: str,
    entity: str,
    *,
    fields: Sequence[str] | None = None,
    nested: bool = False,
    multiline: bool = False,
    on_damage: str = "fail",
) -> DataFrame:
    """Records of all page files in ``path``.

    The schema is fixed, so nothing is scanned to infer it.  ``fields`` names the
    record fields to parse: JSON arrays are not pruned by Spark, so name them
    if a few suffice.  Folders named like ``bucket=logs/`` become columns and
    prune the scan; other subfolders are read only with ``nested``, which gives
    up those columns.  ``multiline`` reads one page per file, pretty-printed or
    not, instead of one per line; such files are not split.  A page without the
    envelope field has no records.

    A page that cannot be read whole ends the job (``fail``), or is a row of its
    own with its text in ``damaged_page`` (``column``), or is left out (``skip``).
    """
    reader = spark.read.schema(_with_damaged(_envelope(entity, fields), on_damage)).options(
        recursiveFileLookup=str(nested).lower(), multiLine=str(multiline).lower(), **_reading(on_damage)
    )
    return _records(reader.json(path), entity, ENVELOPES[entity][0])


def records_of(pages: DataFrame, entity: str, text: str = "value", on_damage: str = "fail") -> DataFrame:
    """Records of pages held as JSON text in a column, batch or streaming; ``on_damage`` as in ``read_pages``."""
    field, record = ENVELOPES[entity]
    extra = f", {DAMAGED} string" if on_damage == "column" else ""
    parsed = pages.withColumn(text, F.from_json(text, f"{field} array<{record}>{extra}", _reading(on_damage)))
    if on_damage == "column":
        parsed = parsed.withColumn(DAMAGED, F.col(text)[DAMAGED])
    return _records(parsed.withColumn(text, F.col(text)[field]), entity, text)


def tag_rows(records: DataFrame, resource: str, tags: str = "Tags", key: str = "Key", value: str = "Value") -> DataFrame:
    """(resource_id, key, value, seq) from records with a list of tags; ``seq`` is the place in the list.

    Records without tags have no rows.  Lists of the other spelling are read with
    ``tags="tags"``, ``key="key"`` and ``value="value"``.
    """
    rows = records.select(F.col(resource).alias("resource_id"), F.posexplode(tags).alias("seq", "tag"))
    return rows.select("resource_id", F.col("tag")[key].alias("key"), F.col("tag")[value].alias("value"), "seq")


def read_tags(spark: SparkSession, path: str, resource: str, tags: str = "Tags", key: str = "Key", value: str = "Value") -> DataFrame:
    """``tag_rows`` of landed records under ``path``, one JSON record per line."""
    schema = f"{resource} string, {tags} array<struct<{key}:string,{value}:string>>"
    return tag_rows(spark.read.schema(schema).options(mode="FAILFAST").json(path), resource, tags, key, value)


def read_details(spark: SparkSession, path: str, entity: str, on_damage: str = "fail") -> DataFrame:
    """Landed describe results under ``path``, one JSON record per line, with the time they landed.

    ``landed_at`` is the time of a record's file: of details of one key that landed
    twice, lookups take the newest.  ``on_damage`` is as in ``read_pages``; a line
    that cannot be read is one page.
    """
    kind = T.StructType.fromDDL(DETAILS[entity])
    schema = _with_damaged(kind, "fail" if on_damage == "fail" else "column")
    rows = spark.read.schema(schema).options(**_reading(on_damage)).json(path)
    landed = F.col("_metadata.file_modification_time").alias(LANDED)
    if on_damage == "fail":
        return rows.select("*", landed)
    whole = F.col(DAMAGED).isNull()
    if on_damage == "skip":
        # A record without its id is nobody's detail; naming it keeps the damaged text from being the only column read.
        return rows.select(*kind.names, DAMAGED, landed).filter(whole & F.col(kind.names[0]).isNotNull()).drop(DAMAGED)
    return rows.select(*[F.when(whole, F.col(c)).alias(c) for c in kind.names], DAMAGED, landed)
