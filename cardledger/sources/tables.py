"""Tables at rest: CSV files into typed tables, JDBC and parquet tables, result files."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardledger.functions.text import blank_to_null
from cardledger.schemas import TABLES, require_primary_key
from cardledger.sources import files
from cardledger.sources.csv_records import csv_records
from cardledger.sources.published import VersionedStore
from cardledger.sources.scratch import COMPRESSION, saved

_MALFORMED = "_malformed"


def _read_text_fields(spark: SparkSession, path: str, schema: StructType, multi_line: bool):
    """The fields as text, and the whole line where it has too many or too few of them."""
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    unknown = set(header) - set(schema.names)
    if unknown:
        raise ValueError(f"{path}: no such columns: {sorted(unknown)}")
    # All text, so that only a wrong number of fields makes a line malformed, not a bad value.
    text = StructType([StructField(c, StringType()) for c in [*header, _MALFORMED]])
    if multi_line:
        return _parsed(spark, path, header, text, mode="PERMISSIVE", columnNameOfCorruptRecord=_MALFORMED)
    reader = spark.read.options(
        **options,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=_MALFORMED,
        enforceSchema=False,
        columnPruning=False,
    )
    return reader.schema(text).csv(path)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _parsed(spark: SparkSession, path: str, header: list[str] | None, schema: StructType, **options) -> DataFrame:
    """The fields of all records of the files at `path`, whose header must be `header`, if it is given."""
    quotes = {"quote": '"', "escape": '"'}
    is_row = F.when(~F.col("header"), True)
    if header is not None:
        names = F.from_csv("record", ", ".join(f"_{i} string" for i in range(len(header))), quotes)
        found = F.array(*[F.trim(F.replace(names[f"_{i}"], F.lit("\ufeff"), F.lit(""))) for i in range(len(header))])
        other = F.raise_error(F.concat(F.lit(f"{path}: a file has another header: "), F.col("record")))
        is_row = is_row.when(found != F.array(*map(F.lit, header)), other.cast("boolean"))
    rows = csv_records(spark, path).where(is_row.otherwise(False))
    return rows.select(F.from_csv("record", _ddl(schema), quotes | options).alias("_r")).select("_r.*")


def _is_malformed(fields: DataFrame) -> Column:
    # Spark reads no CSV for the malformed lines alone, so the test takes in a field as well.
    other = next(c for c in fields.columns if c != _MALFORMED)
    return F.concat(F.col(_MALFORMED), F.coalesce(F.col(other), F.lit(""))).isNotNull()


def _typed(fields: DataFrame, schema: StructType) -> DataFrame:
    def column(f: StructField):
        if f.name not in fields.columns:
            return F.lit(None)
        if f.name == "related_transaction_id":
            return blank_to_null(F.col(f.name))
        # An empty field of a text column is empty text.
        c = F.col(f.name)
        return F.when(c.isNull(), F.lit("")).otherwise(c) if isinstance(f.dataType, StringType) else c

    return fields.filter(~_is_malformed(fields)).select(
        *[column(f).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_csv(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """Read CSV with a header into `schema`, without the lines `skipped_lines` gives.

    Columns are matched by name; those the file lacks are null. Empty text is empty, not null. `multi_line`
    allows line breaks in quotes, at the price of reading the files twice; files are split all the same.
    """
    return _typed(_read_text_fields(spark, path, schema, multi_line), schema)


def skipped_lines(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """The lines with too many or too few fields."""
    fields = _read_text_fields(spark, path, schema, multi_line)
    return fields.filter(_is_malformed(fields)).select(F.col(_MALFORMED).alias("line"))


def read_typed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read result files back with their types; a value of another type is an error.

    Line breaks in quotes are kept, and files are split. CSV has one sign for empty text and for null: it
    comes back as null, but as empty text in a status. Jobs go on from parquet, not from these files.
    """
    df = _parsed(spark, path, None, schema, mode="FAILFAST")
    return df.fillna("", ["status"]) if "status" in df.columns else df


_WRITTEN = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def save_csv(df: DataFrame, path: str, single_file: bool = False, compression: str | None = None) -> None:
    """Write CSV with a header, over what was there. One file only where the data is small.

    Text keeps the white space around it. `compression`: plain files, or such as gzip, which readers of CSV
    take as they are, but do not split.
    """
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite").options(**_WRITTEN)
    writer.csv(path, compression=compression)


def save_sorted(
    df: DataFrame,
    key: str,
    folder: str,
    results: dict[str, dict[str, Column]],
    single_file: bool = False,
    compression: str | None = None,
) -> None:
    """Write `df` in the order of `key` as several results, over what was there: `folder`/name for each of
    `results`, which has the columns that are other than in `df`. The rows are dealt and sorted once for all.
    """
    spark, of = df.sparkSession, F.col("_result")
    rows = df.coalesce(1) if single_file else df.repartitionByRange(key)
    rows = rows.withColumn("_result", F.explode(F.array(*map(F.lit, results))))
    for name, others in results.items():
        rows = rows.withColumns({c: F.when(of == name, new).otherwise(F.col(c)) for c, new in others.items()})
    aside = f"{folder}/_{uuid.uuid4().hex}"
    rows = rows.select(*df.columns, "_result").sortWithinPartitions("_result", key)
    rows.write.options(**_WRITTEN).partitionBy("_result").csv(aside, compression=compression)
    for name in results:
        written, path = f"{aside}/_result={name}", f"{folder}/{name}"
        if files.exists(spark, written):
            files.remove_folder(spark, path)
            files.move_folder(spark, written, path)
            files.write_new(spark, f"{path}/_SUCCESS", "")
        else:  # no rows: a header alone
            save_csv(df.limit(0), path, single_file, compression)
    files.remove_folder(spark, aside)


def sorted_report(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """One row on the result files at `path` (none if they are empty): n_rows, and n_misplaced, the rows whose
    `key` is below that of the row before them, in the order of files by name and of rows within. Values have
    no line breaks.

    Rows are compared within each file, and files by their first and last keys alone.
    """
    rows = spark.read.options(header=True, quote='"', escape='"').schema(schema).csv(path)
    rows = rows.select(
        F.col(key).alias("key"),
        F.col("_metadata.file_name").alias("file"),
        F.regexp_extract("_metadata.file_path", "^(.*)/", 1).alias("folder"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),  # within a block, in the order of its rows
    )
    before = F.lag("key").over(Window.partitionBy("folder", "file").orderBy("block", "place"))
    per_file = rows.withColumn("falls", F.coalesce(F.col("key") < before, F.lit(False)).cast("long")).groupBy("folder", "file").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("falls").alias("falls"),
        F.min_by("key", F.struct("block", "place")).alias("first"),
        F.max_by("key", F.struct("block", "place")).alias("last"),
    )
    earlier = F.lag("last").over(Window.partitionBy("folder").orderBy("file"))
    per_file = per_file.withColumn("falls", F.col("falls") + F.coalesce(F.col("first") < earlier, F.lit(False)).cast("long"))
    return per_file.groupBy("folder").agg(F.sum("n").alias("n_rows"), F.sum("falls").alias("n_misplaced")).drop("folder")


def jdbc_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> dict[str, str]:
    """`split` reads in parallel: (column, lower bound, upper bound, partitions)."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    if split:
        column, lower, upper, partitions = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


@dataclass(frozen=True)
class ParquetStore:
    """The tables as parquet folders under `root`."""

    spark: SparkSession
    root: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name][0]).parquet(f"{self.root}/{name}")

    def write(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}", compression=COMPRESSION)


@dataclass(frozen=True)
class JdbcStore:
    """The tables in a database. `splits`: by table, how to read it in parallel."""

    spark: SparkSession
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    splits: dict[str, tuple[str, int, int, int]] = field(default_factory=dict)

    def read(self, name: str) -> DataFrame:
        options = jdbc_options(self.url, name, self.properties, self.splits.get(name))
        df = self.spark.read.format("jdbc").options(**options).load()
        return df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[name][0].fields])

    def write(self, df: DataFrame, name: str) -> None:
        """Empty the table, then insert. The table's own definition stays."""
        options = jdbc_options(self.url, name, self.properties)
        df.write.format("jdbc").mode("overwrite").options(**options, truncate=True).save()


Store = ParquetStore | JdbcStore | VersionedStore


def load_table(store: Store, csv_path: str, name: str, multi_line: bool = True) -> tuple[DataFrame, int]:
    """Load a CSV file over the table `name`: (the table, lines skipped).

    The new rows are written aside and their key is checked before the old table is replaced. The
    skipped lines are counted in the same pass. Quoted text may hold line breaks, at the price of one more
    pass over the files; without `multi_line` a line break ends a row.
    """
    schema, key = TABLES[name]
    seen = Observation()
    fields = _read_text_fields(store.spark, csv_path, schema, multi_line).observe(
        seen, F.count(_MALFORMED).alias("skipped")
    )
    store.write(require_primary_key(saved(_typed(fields, schema), name), key), name)
    return store.read(name), seen.get["skipped"]


def load_all(store: Store, unchecked: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The four tables, with unique keys: a key listed twice would multiply rows in joins."""
    tables = {name: store.read(name) for name in TABLES}
    for name, (_, key) in TABLES.items():
        if name not in unchecked:
            require_primary_key(tables[name], key)
    return tables


def publish_serving(store: Store, cards: DataFrame, customers: DataFrame) -> None:
    """Put the batch results in place of the cards and customers tables.

    Both are saved first, so no plan reads a table while it is overwritten. A store with versions writes
    new folders and takes both at once.
    """
    if isinstance(store, VersionedStore):
        store.publish({"cards": cards, "customers": customers})
        return
    new = {
        name: saved(df.select(*TABLES[name][0].names), name)
        for name, df in (("cards", cards), ("customers", customers))
    }
    for name, df in new.items():
        store.write(require_primary_key(df, TABLES[name][1]), name)
