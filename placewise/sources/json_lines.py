"""Line-delimited JSON with explicit or inferred schema, and quarantine of bad lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placewise.schemas import ENTITY_DDL, ENTITY_KEY, entity_schema

BAD_LINE = "_bad_line"
# Where a record stood: its file, the file's time, and its place in the file.
PATH, MODIFIED, LINE, LINE_JSON = "_path", "_modified", "_line", "_line_json"


def with_bad_line(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])


def scan_entity(spark: SparkSession, path: str | list[str], entity: str) -> DataFrame:
    """All lines of an entity with its declared schema; unparsable text lands in ``_bad_line``."""
    return (spark.read.schema(with_bad_line(entity_schema(entity)))
            .option("columnNameOfCorruptRecord", BAD_LINE).json(path))


def scan_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with the schema Spark infers from them (reads the input twice), and ``_bad_line``."""
    found = spark.read.option("columnNameOfCorruptRecord", BAD_LINE).json(path)
    return found if BAD_LINE in found.columns else found.withColumn(BAD_LINE, F.lit(None).cast("string"))


def _is_good(entity: str) -> Column:
    keyed = [F.col(k).isNotNull() for k in ENTITY_KEY[entity]]
    return reduce(lambda a, b: a & b, keyed, F.col(BAD_LINE).isNull())


def with_place(scanned: DataFrame) -> DataFrame:
    """A file scan plus where each record stood (``_modified``, ``_path``, ``_line``).

    Lines of a file are in the order of ``_line``: the start of its split, then the row's number in it.
    """
    row = F.monotonically_increasing_id()
    return scanned.select("*", F.col("_metadata.file_modification_time").alias(MODIFIED), F.col("_metadata.file_path").alias(PATH),
                          F.struct(F.col("_metadata.file_block_start").alias("split"), row.alias("row")).alias(LINE)).drop("_metadata")


def extra_columns(line: Column, declared: list[str]) -> Column:
    """The members of a JSON line that are not declared, as a map of JSON texts."""
    every = F.from_json(line, "map<string,string>")
    return F.map_filter(every, lambda name, _: ~name.isin(declared))


def _keyed(scanned: DataFrame, entity: str) -> DataFrame:
    """Inferred columns may lack the key, if no line has it."""
    return scanned.withColumns({k: F.lit(None).cast("string") for k in ENTITY_KEY[entity] if k not in scanned.columns})


def accepted(scanned: DataFrame, entity: str) -> DataFrame:
    """Parsed records that carry their key; the reader alone would let the others through."""
    return _keyed(scanned, entity).where(_is_good(entity)).drop(BAD_LINE)


def rejected(scanned: DataFrame, entity: str) -> DataFrame:
    """Records for quarantine, with their raw text where the line did not parse."""
    return _keyed(scanned, entity).where(~_is_good(entity))


def read_entity(spark: SparkSession, path: str | list[str], entity: str, infer: bool = False) -> DataFrame:
    """Records of one entity ready to store; ``infer`` keeps every column found in the files."""
    if infer:
        return accepted(scan_inferred(spark, path), entity)
    return accepted(scan_entity(spark, path, entity), entity)


def create_json_view(spark: SparkSession, name: str, path: str, entity: str | None = None) -> None:
    """A temporary SQL view straight over JSON files."""
    columns = f" ({ENTITY_DDL[entity]})" if entity else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name}{columns} USING json OPTIONS (path '{path}')")
