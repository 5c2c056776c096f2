"""File formats read and written at the edges: typed CSV, form XML, export JSON."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import moment

DIALING_CODES = T.StructType(
    [
        T.StructField("CountryId", T.IntegerType()),
        T.StructField("Prefix", T.IntegerType()),
        T.StructField("NumberLength", T.IntegerType()),
        T.StructField("Created", T.TimestampNTZType()),
        T.StructField("Updated", T.TimestampNTZType()),
    ]
)

FORM_DEFINITIONS = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "TypeFlag", "FormId", "GetStatuses", "SetStatus", "XSLT", "OutputPath", "ImageFileName", "Autofile", "TestMode", "DeleteIndex",
        )
    ]
)

# The record element of a forms export and the fields its index line holds.
FORM_RECORD = "DynamicForm"
FORM_FIELDS = ("zNGImageName", "PEOPLE_CODE_ID", "EmailAddress")


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, defaults: Mapping[str, datetime] | None = None) -> DataFrame:
    """CSV with a header (and perhaps a byte order mark); missing stamps take the given moment."""
    df = (
        spark.read.option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm")
        .option("mode", "FAILFAST")
        .schema(schema)
        .csv(path)
    )
    if defaults:
        df = df.withColumns({c: F.coalesce(F.col(c), moment(v)) for c, v in defaults.items()})
    return df


def read_forms(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField(f, T.StringType()) for f in FORM_FIELDS])
    return spark.read.format("xml").option("rowTag", FORM_RECORD).schema(schema).load(path)


def form_index_lines(forms: DataFrame) -> DataFrame:
    """One line per form; an absent field is empty."""
    return forms.select(F.concat_ws(",", *[F.coalesce(F.col(f), F.lit("")) for f in FORM_FIELDS]).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("errorifexists").option("lineSep", "\r\n").text(path)


def json_field(c: Column | str, key: str, kind: str = "string") -> Column:
    """One field of a JSON object; null when the object lacks it."""
    return F.get_json_object(c, f"$.{key}").cast(kind)


def export_ids(listing: DataFrame, column: str = "value", key: str = "uid", **equal: str) -> DataFrame:
    """Ids of the listed exports that have one, limited to elements whose fields equal ``equal``.

    ``listing`` holds one JSON array of objects per row.
    """
    kind = "array<map<string,string>>"
    items = listing.select(F.explode(F.from_json(F.col(column), kind)).alias("item"))
    test = F.col("item")[key].isNotNull()
    for name, value in equal.items():
        test = test & (F.col("item")[name] == value)
    return items.filter(test).select(F.col("item")[key].alias(key))
