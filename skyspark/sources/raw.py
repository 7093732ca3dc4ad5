"""Raw locus records: nested JSON properties, malformed rows, flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import join_tags
from ..schema import ID, LOCI, conform

BAD = "_malformed"


def parse_properties(raw: DataFrame, properties: str | T.StructType, column: str = "properties") -> DataFrame:
    """Read the JSON text into a struct; ``_malformed`` holds the text of rows that are no JSON or have a null tag."""
    schema = T.StructType.fromDDL(properties) if isinstance(properties, str) else properties
    parsed = F.from_json(column, T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    null_tag = F.coalesce(F.exists("tags_arr", F.isnull), F.lit(False)) if "tags_arr" in raw.columns else F.lit(False)
    struct = raw.withColumn("_p", parsed)
    bad = F.coalesce(F.col("_p._bad"), F.when(null_tag, F.coalesce(F.col(column), F.lit(""))))
    return struct.withColumn(BAD, bad).withColumn("_p", F.struct(*[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields]))


def malformed_count(parsed: DataFrame) -> DataFrame:
    """One row with the numbers of rows read and rejected."""
    return parsed.agg(F.count("*").alias("n_rows"), F.count(BAD).alias("n_malformed"))


def flatten_loci(parsed: DataFrame, column: str = "properties") -> DataFrame:
    """One column for each property beside the base columns; a property with a base column's name replaces it. Malformed rows are dropped."""
    good = parsed.filter(F.col(BAD).isNull())
    names = parsed.schema["_p"].dataType.names
    base = [c for c in parsed.columns if c not in (column, "_p", BAD, *names)]
    tags = [] if "tags" in base or "tags" in names else [join_tags(F.col("tags_arr")).alias("tags")]
    return good.select(*base, *tags, *[F.col(f"_p.{n}").alias(n) for n in names])


def read_loci(raw: DataFrame, properties: str) -> DataFrame:
    """Records to a conforming loci table."""
    return conform(flatten_loci(parse_properties(raw, properties)), LOCI).filter(F.col(ID).isNotNull())
