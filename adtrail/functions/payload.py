"""Message payloads: casts, JSON and Avro codecs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail.registry import SourceSpec

CORRUPT = "_corrupt_record"


class ConnectorMissing(RuntimeError):
    """A connector package is not on the class path of this session."""


def as_text(payload: Column | str) -> Column:
    return _column(payload).cast("string")


def as_binary(payload: Column | str) -> Column:
    return _column(payload).cast("binary")


def from_json(payload: Column | str, schema: T.StructType) -> Column:
    """Decode JSON text; text that is no object of the schema is kept in ``_corrupt_record``."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(as_text(payload), with_corrupt, options)


def to_json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns))


def from_avro(payload: Column | str, schema: str) -> Column:
    """Decode an Avro datum; a broken one gives NULL and does not stop the job."""
    require_avro()
    from pyspark.sql.avro.functions import from_avro as decode

    return decode(as_binary(payload), schema, {"mode": "PERMISSIVE"})


def to_avro(columns: list[str], schema: str) -> Column:
    require_avro()
    from pyspark.sql.avro.functions import to_avro as encode

    return encode(F.struct(*columns), schema)


def decode(payload: Column | str, spec: SourceSpec) -> Column:
    """Decode one payload of a source into a struct, NULL if nothing can be read.

    JSON text without a closing brace is no object. The parser would raise an error for each, at
    several times the cost of decoding a whole message.
    """
    if spec.codec == "json":
        return from_json(F.when(as_text(payload).contains("}"), _column(payload)), spec.schema)
    if spec.codec == "avro":
        return from_avro(payload, spec.avro_schema)
    raise ValueError(f"unknown codec {spec.codec!r} of source {spec.name}")


def encode(spec: SourceSpec) -> Column:
    """Encode the fields of a source as one binary payload."""
    if spec.codec == "json":
        return as_binary(to_json(spec.fields))
    if spec.codec == "avro":
        return to_avro(spec.fields, spec.avro_schema)
    raise ValueError(f"unknown codec {spec.codec!r} of source {spec.name}")


def avro_available() -> bool:
    spark = SparkSession.active()
    try:
        spark.read.format("avro").schema("probe string").load([])
    except AnalysisException:
        return False
    return True


def require_avro() -> None:
    if not avro_available():
        raise ConnectorMissing(
            "Avro payloads need the spark-avro package that belongs to this Spark version "
            "(spark.jars.packages=org.apache.spark:spark-avro_2.13:<version>)"
        )


def _column(payload: Column | str) -> Column:
    return F.col(payload) if isinstance(payload, str) else payload
