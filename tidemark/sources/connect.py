"""JSON records that carry their schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binding import bound, with_once

# Carried type names and the column types they stand for.
CONNECT_TYPES = {"int64": T.LongType(), "string": T.StringType(), "double": T.DoubleType()}

FIELDS = T.ArrayType(
    T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("optional", T.BooleanType()),
            T.StructField("field", T.StringType()),
        ]
    )
)


def unwrap_connect_json(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Columns of ``payload`` typed by the carried schema, and ``error`` for rows that break it.

    ``fields`` gives the expected carried type per field. A record whose schema
    says otherwise, or whose required field is absent, gets an error. The text
    is parsed once.
    """
    image = T.StructType([T.StructField(n, CONNECT_TYPES[t]) for n, t in fields.items()])
    envelope = T.StructType(
        [T.StructField("schema", T.StructType([T.StructField("fields", FIELDS)])), T.StructField("payload", image)]
    )

    def checked(env: Column) -> Column:
        row, specs = env["payload"], env["schema"]["fields"]
        names = F.transform(specs, lambda f: f["field"])
        error = F.when(row.isNull(), F.lit("unreadable record"))
        for name, kind in fields.items():
            spec = F.get(specs, F.array_position(names, name).cast("int") - 1)
            error = error.when(~spec["type"].eqNullSafe(F.lit(kind)), F.lit(f"{name} is not declared as {kind}"))
            required = ~F.coalesce(spec["optional"], F.lit(False))
            error = error.when(row[name].isNull() & required, F.lit(f"{name} is missing"))
        return F.struct(*[row[n].alias(n) for n in fields], error.alias("error"))

    rest = [c for c in df.columns if c != "value"]
    parsed = with_once(df, "__row", bound(F.from_json("value", envelope), checked))
    return parsed.select(*rest, "__row.*")
