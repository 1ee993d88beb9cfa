"""Raw JSON files as streams of events.

Both readers give the same columns, so a table can be fed by either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.spec import CORRUPT, RESCUED, Entity


def json_stream(
    spark: SparkSession, path: str, entity: Entity, multi_line: bool = True, **options
) -> DataFrame:
    """Spark's JSON reader with a fixed schema; unreadable text is kept as is.

    ``multi_line`` is for files holding one array or one object.  Such a file is
    read as a whole: one mistyped field makes Spark give up on all its records,
    and only the first record of a JSON Lines file is read.  Files with a record
    per line are split among tasks when it is off.
    """
    return (
        spark.readStream.format("json")
        .schema(f"{entity.raw_schema}, `{CORRUPT}` string")
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .options(**options)
        .load(path)
        .select(*entity.raw, F.lit(None).cast("string").alias(RESCUED), CORRUPT)
    )


def rescue_stream(
    spark: SparkSession, path: str, entity: Entity, layout: str = "auto", **options
) -> DataFrame:
    """Events with whatever did not fit the schema kept per record.

    ``split``  each file is an array, one object, or a record per line; arrays and lines
               are split among tasks.  The stream only lists the files, and each batch of
               paths is read by :func:`tidemark.sources.json_ranges.read_records`.
    ``lines``  a record per line; files are split among tasks, so their size
               does not matter.
    ``auto``   the kinds of ``split``, but a file is the unit of work and must fit into one task.
    """
    if layout == "split":
        # the content is not read
        files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
        return files.options(**options).load(path).select("path")
    whole = layout == "auto"
    texts = (
        spark.readStream.format("text").option("wholetext", whole).options(**options).load(path)
    )
    records = split_records(texts, "value") if whole else lines(texts, "value")
    return parse_with_rescue(records, entity)


def lines(texts: DataFrame, column: str) -> DataFrame:
    return texts.select(F.col(column).alias("record")).filter(F.trim("record") != "")


def split_records(texts: DataFrame, column: str) -> DataFrame:
    """One row ``record`` per JSON record of each file text."""
    text = F.col(column)
    body = F.trim(F.regexp_replace(text, r"^[\s\x{FEFF}]+|\s+$", ""))
    elements = F.from_json("body", "array<string>")
    rows = F.filter(F.split("body", r"\r?\n"), lambda line: F.trim(line) != "")
    first_is_record = F.from_json(F.element_at("rows", 1), "map<string,string>").isNotNull()
    records = (
        # an array that cannot be read is one corrupt record
        F.when(F.startswith("body", F.lit("[")), F.coalesce("elements", F.array("body")))
        .when(first_is_record | (F.size("rows") == 1), F.col("rows"))
        # the first line alone is no record: a single object over several lines,
        # or lines of which the first is broken
        .when(F.from_json("body", "map<string,string>").isNotNull(), F.array("body"))
        .otherwise(F.col("rows"))
    )
    return (
        texts.select(body.alias("body"))
        .filter("body != ''")
        .withColumns({"elements": elements, "rows": rows})
        .select(F.explode(records).alias("record"))
        .withColumn("record", F.coalesce("record", F.lit("null")))
    )


def parse_with_rescue(records: DataFrame, entity: Entity) -> DataFrame:
    """Typed fields, plus a JSON object of the unknown and the mistyped ones."""
    known = list(entity.raw)
    parsed = records.select(
        "record",
        F.from_json("record", entity.raw_schema).alias("typed"),
        F.json_object_keys("record").alias("names"),
    )
    readable = F.array_remove(
        F.array(
            *[F.when(F.col(f"typed.`{c}`").isNotNull(), F.lit(c)).otherwise(F.lit("")) for c in known]
        ),
        "",
    )
    left_over = F.map_filter(
        "found",
        lambda name, value: ~name.isin(known)
        | (value.isNotNull() & ~F.array_contains("readable", name)),
    )
    # a record whose names are all read is not parsed by name
    plain = F.coalesce(F.size(F.array_except("names", "readable")) == 0, F.lit(False))
    return (
        parsed.withColumn("readable", readable)
        .withColumn("plain", F.col("names").isNotNull() & plain)
        .withColumn("found", F.when(~F.col("plain"), F.from_json("record", "map<string,string>")))
        .withColumn("left_over", left_over)
        .select(
            *[F.col(f"typed.`{c}`").alias(c) for c in known],
            F.when(F.size("left_over") > 0, F.to_json("left_over")).alias(RESCUED),
            F.when(~F.col("plain") & F.col("found").isNull(), F.col("record")).alias(CORRUPT),
        )
    )
