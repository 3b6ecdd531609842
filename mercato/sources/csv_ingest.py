"""CSV to typed raw tables: strict headers, explicit casts, errors instead of silent NULLs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.schema import RAW_TABLES, TableSpec

# Texts read as missing, and the timestamp format written to files.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
MOMENT_FORMAT = "yyyy-MM-dd HH:mm:ss"


class HeaderMismatch(ValueError):
    """A file's header differs from the expected ordered column list."""


QUOTING = {"quote": '"', "escape": '"'}


def read_strings(spark: SparkSession, path: str, spec: TableSpec, table: str) -> DataFrame:
    """Read a CSV file or folder as text after checking its header, name by name and in order.

    Line breaks inside quotes are only possible in free-text tables; their files are split as well, see ``read_split``.
    """
    options = {"header": True, **QUOTING, "encoding": "UTF-8"}
    header = spark.read.options(**options, multiLine=True).csv(path).columns
    if header != spec.names:
        raise HeaderMismatch(f"unexpected columns for {table}\nexpected: {spec.names}\nfound: {header}")
    if spec.free_text:
        return read_split(spark, path, spec, table)
    text = T.StructType([T.StructField(name, T.StringType()) for name in spec.names])
    # enforceSchema=False makes every further file of a folder prove its own header too
    return spark.read.options(**options, enforceSchema=False).schema(text).csv(path)


def read_split(spark: SparkSession, path: str, spec: TableSpec, table: str) -> DataFrame:
    """A CSV file with quoted line breaks, read by as many tasks as it has splits.

    A line begins a record if the quotes before it in its file are even in number (an escaped quote counts twice).
    Quotes are summed per split, the few sums are prefix-summed over a file's splits, and every line then knows the
    parity before it. Most records are one line; only the lines of longer ones meet, by file and record number.
    """
    split = ["file", "block"]
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    inside = Window.partitionBy(*split).orderBy("line")
    before = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    counted = lines.withColumn("quotes", quotes.cast("bigint")).withColumn("before", before)
    # a split does not know how many quotes come before it: it counts its record starts for both parities
    sums = counted.groupBy(*split).agg(
        F.sum("quotes").alias("quotes"), F.count_if(F.col("before") == 0).alias("even"), F.count_if(F.col("before") == 1).alias("odd")
    )
    onwards = Window.partitionBy("file").orderBy("block")
    earlier = onwards.rowsBetween(Window.unboundedPreceding, -1)
    known = sums.withColumn("parity", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("parity") == 0, F.col("even")).otherwise(F.col("odd"))
    known = known.withColumn("starts", starts).withColumn("earlier", F.coalesce(F.sum("starts").over(earlier), F.lit(0)))
    parity = (F.col("before") + F.col("parity")) % 2
    # one row per split of the files
    placed = counted.join(F.broadcast(known.select(*split, "parity", "earlier")), split).withColumn("parity", parity)
    number = F.col("earlier") + F.sum((F.col("parity") == 0).cast("bigint")).over(inside)
    placed = placed.withColumn("record", number).withColumn("whole", (F.col("parity") == 0) & (F.col("quotes") % 2 == 0))
    pieces = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    longer = placed.where("NOT whole").groupBy("file", "record").agg(pieces.alias("pieces"))
    joined = longer.select("record", F.array_join(F.transform("pieces", lambda p: p["value"]), "\n").alias("value"))
    records = placed.where("whole").select("record", "value").unionByName(joined)
    text = ", ".join(f"`{name}` string" for name in spec.names)
    records = records.withColumn("value", F.regexp_replace("value", "\r$", ""))  # records may end in CR LF
    parsed = records.where(F.trim("value") != "").withColumn("row", F.from_csv("value", text, QUOTING))
    # every file begins with its header
    expected = F.struct(*[F.lit(name).alias(name) for name in spec.names])
    wrong = F.raise_error(F.concat(F.lit(f"unexpected header in a file of {table}: "), F.col("value"))).cast("boolean")
    header = F.when(F.col("record") > 1, F.lit(False)).otherwise(F.when(F.col("row") == expected, F.lit(True)).otherwise(wrong))
    return parsed.where(~header).select("row.*")


#: A whole date, with or without a time of day, never with a zone.
DATE_TIME = r"^\s*\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?\s*$"


#: Of these characters every text consists that the pattern of a blank one matches.
BLANK = " \t\n\x0b\f\r\x85\u2028\u2029"


def _present(column: Column) -> Column:
    blank = (F.ltrim(column, F.lit(BLANK)) == "") & column.rlike(r"^\s*$")  # few values come as far as the pattern
    return F.when(~column.isin(MISSING_TOKENS) & ~blank, column)


def _parsed(column: Column, target: T.DataType) -> Column:
    if isinstance(target, T.TimestampNTZType):
        return F.when(column.rlike(DATE_TIME), column.try_cast("timestamp_ntz"))
    if isinstance(target, T.LongType):
        return column.try_cast("bigint")
    if isinstance(target, T.IntegerType):
        number = column.try_cast("double")  # integer columns with gaps arrive as '7.0'
        return F.when(number == F.floor(number), number.try_cast("int"))
    if isinstance(target, T.DecimalType):
        value = column.try_cast(target.simpleString())  # which rounds: further digits are an error
        return F.when(column.try_cast("decimal(38,18)") == value, value)
    return column


def typed(df: DataFrame, spec: TableSpec, table: str, types: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """Cast text columns; a present value that does not parse stops the load with its content.

    Three steps, each of which looks several times at what the one before has made once.
    """
    kinds = {name: (types or {}).get(name, target) for name, target, _ in spec.columns}
    given = df.select(*[_present(F.col(name)).alias(name) for name in kinds])
    cast = [name for name, target in kinds.items() if not isinstance(target, T.StringType)]
    parsed = given.select("*", *[_parsed(F.col(name), kinds[name]).alias(f"__{name}") for name in cast])

    def checked(name: str) -> Column:
        if name not in cast:
            return F.col(name)
        raw, value = F.col(name), F.col(f"__{name}")
        message = F.concat(F.lit(f"bad value in {table}.{name}: "), raw)
        wrong = F.raise_error(message).cast(kinds[name])
        return F.when(raw.isNotNull() & value.isNull(), wrong).otherwise(value).alias(name)

    return parsed.select(*[checked(name) for name in kinds])


def _problems(spec: TableSpec, types: Mapping[str, T.DataType] | None = None) -> Column:
    """(column, value, reason) of every present value of a row that does not parse."""
    found = []
    for name, target, _ in spec.columns:
        target = (types or {}).get(name, target)
        if isinstance(target, T.StringType):
            continue
        raw = _present(F.col(name))
        reason = F.lit(f"not a value of type {target.simpleString()}")
        problem = F.struct(F.lit(name).alias("column"), raw.alias("value"), reason.alias("reason"))
        found.append(F.when(raw.isNotNull() & _parsed(raw, target).isNull(), problem))
    return F.array_compact(F.array(*found))


def quarantined(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows with at least one present but unparsable value, as read."""
    return df.where(F.size(_problems(spec)) > 0)


def load_with_quarantine(
    spark: SparkSession, path: str, table: str, target: str, types: Mapping[str, T.DataType] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Load a CSV table in one pass that writes good rows and bad ones to two folders below ``target``.

    Returns the typed good rows and, one line per bad value, the row as read (JSON), column, value and reason.
    """
    spec = RAW_TABLES[table]
    strings = read_strings(spark, path, spec, table)
    values = [_parsed(_present(F.col(n)), (types or {}).get(n, t)).alias(n) for n, t, _ in spec.columns]
    judged = strings.select(F.to_json(F.struct(*spec.names)).alias("_row"), *values, _problems(spec, types).alias("_problems"))
    judged = judged.withColumn("quarantined", F.size("_problems") > 0)
    judged = judged.withColumn("_row", F.when(F.col("quarantined"), F.col("_row")))
    judged.write.mode("overwrite").partitionBy("quarantined").parquet(target)
    stored = spark.read.schema(judged.schema).parquet(target)
    bad = stored.where("quarantined").select(F.col("_row").alias("row"), F.inline("_problems"))
    return stored.where("NOT quarantined").select(*spec.names), bad


def read_table(
    spark: SparkSession, path: str, table: str, types: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    spec = RAW_TABLES[table]
    return typed(read_strings(spark, path, spec, table), spec, table, types)


def ingest(
    spark: SparkSession, folder: str, target: str, files: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """Full refresh of all raw tables: parents first, each overwritten as Parquet below ``target``.

    ``files`` maps table names to file names; a table is ``<table>.csv`` unless listed.
    """
    names = {table: f"{table}.csv" for table in RAW_TABLES} | dict(files or {})
    loaded = {}
    for table in RAW_TABLES:
        out = f"{target.rstrip('/')}/{table}"
        read_table(spark, f"{folder.rstrip('/')}/{names[table]}", table).write.mode("overwrite").parquet(out)
        loaded[table] = spark.read.parquet(out)
    return loaded


def write_csv(df: DataFrame, path: str) -> str:
    """Write a raw table as headed CSV part files in the layout the reader expects."""
    plain = [
        F.date_format(c, MOMENT_FORMAT).alias(c) if isinstance(f.dataType, T.TimestampNTZType) else F.col(c)
        for c, f in ((f.name, f) for f in df.schema.fields)
    ]
    df.select(*plain).write.mode("overwrite").options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path
