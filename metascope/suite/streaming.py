"""Person records: generated, encoded, and taken in as a stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_dir
from ..sinks.files import write_jsonl
from ..streaming import records as r
from .registry import query


def _pick(slot: int, words: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"list_extract([{listed}], {_draw(slot, len(words))} + 1)"


def _draw(slot: int, n: int) -> str:
    return f"(cast('0x' || substring(digest, {4 * slot + 1}, 4) as int) % {n})"


LETTER = f"substring('{r.ZIP_LETTERS}', {{}} + 1, 1)"
GENERATED = f"""select concat_ws('-', substring(digest, 1, 8), substring(digest, 9, 4), substring(digest, 13, 4),
      substring(digest, 17, 4), substring(digest, 21, 12)) as id, name, surname,
    lower(name) || '.' || lower(surname) || substring(digest, 29, 4) || '@example.com' as email,
    cast({_draw(2, r.MAX_AGE - r.MIN_AGE + 1)} + {r.MIN_AGE} as int) as age,
    lower(name) || '.' || lower(surname) || substring(digest, 29, 4) as username,
    {_pick(3, r.OCCUPATIONS)} as occupation, {_pick(5, r.STREETS)} as street, {_pick(6, r.CITIES)} as city,
    {LETTER.format(_draw(4, len(r.ZIP_LETTERS)))} || {_draw(4, 10)} || {LETTER.format(_draw(5, len(r.ZIP_LETTERS)))} || ' ' ||
    {_draw(5, 10)} || {LETTER.format(_draw(6, len(r.ZIP_LETTERS)))} || {_draw(6, 10)} as zipcode
    from (select digest, {_pick(0, r.NAMES)} as name, {_pick(1, r.SURNAMES)} as surname
          from (select md5('7:' || cast(o_orderkey as varchar)) as digest from orders) d) p"""


def generated(fx) -> DataFrame:
    """A person per order."""
    return fx.table("orders").select(*r.person_columns("o_orderkey", seed=7))


@query("gen1_persons", GENERATED)
def _(fx):
    return r.flatten(generated(fx))


@query("snk5_bulk_json", GENERATED)
def _(fx):
    path = work_dir(fx.spark, "persons")
    write_jsonl(generated(fx), path)
    return r.flatten(fx.spark.read.schema(r.PERSON).json(path))


def landed(fx) -> DataFrame:
    """A person record per customer, from names, cities and regions of the tables."""
    address = F.struct(F.col("region").alias("street"), "city", F.col("region").alias("zipcode"))
    return fx.view("person_source").select(
        F.col("id").cast("string").alias("id"), "name", "occupation", address.alias("address")
    )


@query(
    "str1_records",
    """select cast(id as varchar) as partition_key, '{"id":"' || id || '","name":"' || name || '","occupation":"' ||
        occupation || '","address":{"street":"' || region || '","city":"' || city || '","zipcode":"' || region || '"}}'
        as data from person_source""",
)
def _(fx):
    return r.to_records(landed(fx))


@query(
    "str2_stream_ingest",
    """select cast(id as varchar) as id, name, cast(null as varchar) as surname, cast(null as varchar) as email,
        cast(null as int) as age, cast(null as varchar) as username, occupation, cast(null as varchar) as malformed,
        region as street, city, region as zipcode from person_source""",
)
def stream_ingest(fx):
    """Lands the records as JSON, takes them in as a stream, and returns the table."""
    base = work_dir(fx.spark, "stream")
    write_jsonl(landed(fx), f"{base}/landing")
    people = r.read_persons(fx.spark, f"{base}/landing")
    r.ingest(people, f"{base}/checkpoint", path=f"{base}/people").awaitTermination()
    return fx.spark.read.parquet(f"{base}/people")
