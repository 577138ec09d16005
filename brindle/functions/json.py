"""JSON text as typed columns, with what can't be read beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.sources.shared import quoted

REASONS = ("malformed", "not an object", "wrong type")


def extract(df: DataFrame, column: str, fields: T.StructType, prefix: str = "", reason: str = "json_error") -> DataFrame:
    """df with a column for each of ``fields`` (behind ``prefix``) from the JSON object in ``column``, and ``reason``: null
    where all is well, else one of REASONS.

    Fields that the object lacks, or holds as null, are null; further ones are passed over. A null text gives nulls and
    no reason; empty or broken text is malformed, an array or a plain value no object. What stands behind a whole object is
    passed over, as by Spark's parsers. Where a field is of another type
    than asked for, it is null, the others are read. No row is dropped. All is done by Spark's own parsers in one pass.
    """
    new = [prefix + f.name for f in fields.fields]
    if clash := {c.lower() for c in df.columns} & {n.lower() for n in (*new, reason)}:
        raise ValueError(f"already there: {', '.join(sorted(clash))}")
    text, bad = F.col(quoted(column)), "__bad"
    asked = T.StructType([*(T.StructField(f.name, f.dataType) for f in fields.fields), T.StructField(bad, T.StringType())])
    parsed = df.withColumn("__json", F.from_json(text, asked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}))
    whole = F.try_parse_json(text)
    kind = F.schema_of_variant(whole)
    why = F.when(text.isNull(), None).when(whole.isNull(), REASONS[0]).when(~kind.startswith("OBJECT"), REASONS[1]).when(F.col(f"__json.{bad}").isNotNull(), REASONS[2])
    # what isn't an object has no fields, whatever the parser made of it
    value = lambda f: F.when(whole.isNotNull() & kind.startswith("OBJECT"), F.col(f"__json.{quoted(f.name)}")).alias(prefix + f.name)
    return parsed.select(*(F.col(quoted(c)) for c in df.columns), *map(value, fields.fields), why.alias(reason))
