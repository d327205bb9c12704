"""Generation, encoding and streaming ingest of person records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import col
from ..sinks.files import NESTED, write_jsonl
from ..sources.schemas import PERSON

NAMES = ("Ada", "Alan", "Barbara", "Clara", "Donald", "Edsger", "Frances", "Grace", "Hedy", "Ken", "Leslie", "Radia")
SURNAMES = ("Allen", "Bell", "Clark", "Davis", "Evans", "Fraser", "Grant", "Hughes", "Irwin", "Jones", "King", "Lee")
OCCUPATIONS = ("Baker", "Carpenter", "Dentist", "Editor", "Farmer", "Geologist", "Librarian", "Nurse", "Pilot", "Tailor")
STREETS = ("Birch Lane", "Cedar Street", "Elm Avenue", "King Road", "Lake Drive", "Maple Street", "Oak Court", "Pine Way")
CITIES = ("Calgary", "Edmonton", "Halifax", "Montreal", "Ottawa", "Quebec", "Regina", "Toronto", "Vancouver", "Winnipeg")
ZIP_LETTERS = "ABCEGHJKLMNPRSTVXY"
MIN_AGE, MAX_AGE = 16, 66


def person_columns(number: str | Column, seed: int = 0) -> list[Column]:
    """The columns of a person, all derived from one digest of seed and number.

    The same seed and number always make the same person, on any partitioning
    and after any retry.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), col(number).cast("string")))

    def draw(slot: int, n: int) -> Column:
        """A number below ``n`` from the slot-th four hex digits of the digest."""
        return F.conv(F.substring(digest, 4 * slot + 1, 4), 16, 10).cast("int") % n

    def pick(slot: int, words: tuple[str, ...]) -> Column:
        return F.element_at(F.array(*map(F.lit, words)), draw(slot, len(words)) + 1)

    def letter(slot: int) -> Column:
        return F.substr(F.lit(ZIP_LETTERS), draw(slot, len(ZIP_LETTERS)) + 1, F.lit(1))

    name, surname = pick(0, NAMES), pick(1, SURNAMES)
    login = F.concat(F.lower(name), F.lit("."), F.lower(surname), F.substring(digest, 29, 4))
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    digit = [draw(slot, 10).cast("string") for slot in (4, 5, 6)]
    zipcode = F.concat(letter(4), digit[0], letter(5), F.lit(" "), digit[1], letter(6), digit[2])
    return [
        F.concat_ws("-", *[F.substring(digest, start, n) for start, n in parts]).alias("id"),
        name.alias("name"),
        surname.alias("surname"),
        F.concat(login, F.lit("@example.com")).alias("email"),
        (draw(2, MAX_AGE - MIN_AGE + 1) + MIN_AGE).alias("age"),
        login.alias("username"),
        pick(3, OCCUPATIONS).alias("occupation"),
        F.struct(
            pick(5, STREETS).alias("street"), pick(6, CITIES).alias("city"), zipcode.alias("zipcode")
        ).alias("address"),
    ]


def persons(spark: SparkSession, n: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """``n`` synthetic persons."""
    return spark.range(0, n, 1, partitions).select(*person_columns("id", seed))


def write_persons(spark: SparkSession, path: str, n: int = 600, seed: int = 0) -> None:
    """A folder of ``n`` generated records as JSON lines."""
    write_jsonl(persons(spark, n, seed), path)


def to_records(df: DataFrame, key: str = "id") -> DataFrame:
    """(partition_key, data) of each row, data being the whole row as JSON.

    The key should differ from row to row: a constant sends everything to one
    shard.
    """
    return df.select(F.col(key).cast("string").alias("partition_key"), F.to_json(F.struct("*"), NESTED).alias("data"))


def from_records(records: DataFrame) -> DataFrame:
    """Typed persons from encoded records, batch or streaming."""
    return records.select(F.from_json("data", PERSON).alias("person")).select("person.*")


def read_persons(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the JSON records landing under ``path``.

    A line that is no record keeps its text in ``malformed``.
    """
    reader = spark.readStream.schema(f"{PERSON}, malformed string").option("columnNameOfCorruptRecord", "malformed")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def flatten(persons: DataFrame) -> DataFrame:
    """Persons with the fields of their address as columns."""
    return persons.select(*[c for c in persons.columns if c != "address"], "address.*")


def ingest(persons: DataFrame, checkpoint: str, *, path: str | None = None, table: str | None = None) -> StreamingQuery:
    """Appends all that has landed to a Parquet folder or a table, then stops.

    Started again with the same checkpoint it takes up where it ended: a lost
    executor or driver neither loses nor repeats a record.
    """
    if (path is None) == (table is None):
        raise ValueError("give either path or table")
    writer = (
        flatten(persons)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return writer.start(path) if path else writer.toTable(table)
