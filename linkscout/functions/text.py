"""Text, date and JSON helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_AGL = 30.0
MICROS_PER_DAY = 86400e6


def sanitise_name(name: Column) -> Column:
    """Blanks become underscores; letters, digits and underscores stay; the rest goes."""
    return F.regexp_replace(F.translate(name, " ", "_"), r"[^\p{L}\p{N}_]", "")


def sanitise_field(name: str) -> str:
    """Column name as the feature sink wants it."""
    return name.replace(" ", "_").replace("(", "_").replace(")", "_")


def parse_flag(value: Column) -> Column:
    """'true' or 'false' text to boolean; any other value raises."""
    return (
        F.when(value == "true", F.lit(True))
        .when(value == "false", F.lit(False))
        .otherwise(F.raise_error(F.concat(F.lit("not a flag: "), F.coalesce(value, F.lit("NULL")))).cast("boolean"))
    )


def open_level_agl(levels: Column) -> Column:
    """Highest open level minus five, from text such as ``30 - 115 FT , 129 - 150 FT``; 30 where none can be read.

    Only the text after the last hyphen counts, and all its digits are taken together (``150.5`` reads 1505).
    """
    last = F.element_at(F.split(levels, "-"), -1)
    digits = F.nullif(F.regexp_replace(last, "[^0-9]", ""), F.lit(""))
    unset = levels.isNull() | levels.isin("NULL", "None", "nan")
    return F.coalesce(F.when(~unset, digits.cast("double") - 5), F.lit(DEFAULT_AGL))


def fractional_days(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / MICROS_PER_DAY


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days of the interval, towards zero."""
    return F.extract(F.lit("DAY"), later - earlier).cast("long")


LINK_REPLY = T.StructType(
    [
        T.StructField("antenna", T.StringType()),
        T.StructField("capacity", T.IntegerType()),
        T.StructField("d_km", T.DoubleType()),
        T.StructField("link_margin", T.DoubleType()),
        T.StructField("model", T.StringType()),
        T.StructField("modulation", T.StringType()),
        T.StructField("oxygen_attenuation_km", T.DoubleType()),
        T.StructField("rain_attenuation_km", T.DoubleType()),
        T.StructField("rain_attenuation_total", T.DoubleType()),
    ]
)

ELEVATION_REPLY = T.StructType(
    [T.StructField("results", T.ArrayType(T.StructType([T.StructField("elevation", T.DoubleType())])))]
)


#: Holds a reply that does not parse.
BROKEN = "reply_error"


def _parsed(reply: Column, schema: T.StructType) -> Column:
    held = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    return F.from_json(reply, held, {"columnNameOfCorruptRecord": BROKEN})


def parse_link_reply(df: DataFrame, reply: str) -> DataFrame:
    """Replace a stored link-budget reply by its columns and ``reply_error``, the text of a reply that does not parse."""
    kept = [c for c in df.columns if c != reply]
    return df.withColumn("_reply", _parsed(F.col(reply), LINK_REPLY)).select(*kept, "_reply.*")


def parse_elevation_reply(df: DataFrame, reply: str) -> DataFrame:
    """Replace a stored terrain reply by its ordered ``elevations`` and ``reply_error``."""
    kept = [c for c in df.columns if c != reply]
    parsed = df.withColumn("_reply", _parsed(F.col(reply), ELEVATION_REPLY))
    elevations = F.transform("_reply.results", lambda r: r.elevation).alias("elevations")
    return parsed.select(*kept, elevations, f"_reply.{BROKEN}")


def quarantined(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose reply parsed, and beside them those whose reply did not, with its text."""
    broken = F.col(BROKEN).isNotNull()
    results = {f.name for f in (*LINK_REPLY.fields, T.StructField("elevations", T.NullType()))}
    return parsed.where(~broken).drop(BROKEN), parsed.where(broken).select(*[c for c in parsed.columns if c not in results])


def column_widths(df: DataFrame) -> DataFrame:
    """One row per column with the width a sheet needs: longest rendered value or header, plus one.

    One aggregate over all columns. A missing text renders as ``None``, a missing number as ``nan``.
    """
    missing = {f.name: 4 if isinstance(f.dataType, T.StringType) else 3 for f in df.schema.fields}
    longest = df.agg(
        *[
            F.max(F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(missing[c]))).alias(c)
            for c in df.columns
        ]
    )
    pairs = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.greatest(F.coalesce(F.col(f"`{c}`"), F.lit(0)), F.lit(len(c))) + 1).cast("int").alias("width"),
        )
        for c in df.columns
    ]
    return longest.select(F.inline(F.array(*pairs)))
