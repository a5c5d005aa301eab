"""Raw files, curated tables and warehouse tables."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelyard import schemas

CORRUPT_RECORD = "_corrupt_record"


def raw_csv(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One raw data set, by the names in its header, whatever their order; further columns are left out.

    Values have the declared types; one that does not fit is NULL, and `csv_rejects` has its text. A column that the
    header lacks raises.
    """
    read = _header_csv(spark, name, path)
    return read.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.RAW_FILES[name]])


def csv_rejects(spark: SparkSession, name: str, path: str) -> DataFrame:
    """What `raw_csv` and the cleaning after it cannot take: one row per value, or per line that has too few or too
    many values, with the line's key (its first declared column), the text and the reason.

    An empty value is no reject. Times count as text in the raw files and as times here.
    """
    read, fields = _header_csv(spark, name, path, whole_lines=True), schemas.RAW_FILES[name].fields

    def reject(column: str | None, value: Column, reason: str, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(column).alias("column_name"), value.alias("value"), F.lit(reason).alias("reason")))

    found = [reject(None, F.col(CORRUPT_RECORD), "wrong_number_of_values", F.col(CORRUPT_RECORD).isNotNull())]
    for field in fields:
        kind = "timestamp_ntz" if field.name in schemas.MILESTONES else field.dataType.simpleString()
        text = F.col(field.name)
        if kind != "string":
            found.append(reject(field.name, text, f"not_{kind}", text.isNotNull() & text.try_cast(kind).isNull()))
    key = F.col(fields[0].name).alias("record_key")
    rows = read.select(F.lit(name).alias("data_set"), key, F.explode(F.array(*found)).alias("reject"))
    return rows.filter(F.col("reject").isNotNull()).select("data_set", "record_key", "reject.*")


def _header_csv(spark: SparkSession, name: str, path: str, whole_lines: bool = False) -> DataFrame:
    """All columns of the header as text; with `whole_lines`, lines that have another number of values than the header
    are in `_corrupt_record`, which takes parsing every column."""
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    if lacking := [c for c in schemas.RAW_FILES[name].names if c not in header]:
        raise ValueError(f"{name}: the header of {path} lacks {lacking}")
    text = schemas.T.StringType()
    schema = schemas.T.StructType([schemas.T.StructField(c, text) for c in (*header, CORRUPT_RECORD)])
    reader = spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    return reader.option("mode", "PERMISSIVE").option("columnPruning", not whole_lines).csv(path)


def event_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON Lines event batches under `path` (a folder, a glob or a list of them). Lines that do not parse keep their
    text in `_corrupt_record` and have NULL fields."""
    schema = schemas.T.StructType(schemas.EVENT_TEXT.fields + [schemas.T.StructField(CORRUPT_RECORD, schemas.T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        .option("recursiveFileLookup", True)
        .json(path)
    )


def curated_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.WAREHOUSE[name]).parquet(f"{folder.rstrip('/')}/{name}")


def warehouse_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"{database}.{name}")
