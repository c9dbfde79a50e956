"""Landed JSON parsed once, and each document judged by the types its fields are declared to have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_OBJECT = "no JSON object"
NESTED = "a nested value has another type"
_CORRUPT = "_corrupt"


def _is_a(kind: Column, declared: T.DataType) -> Column:
    """Whether a value of this VARIANT type is of the declared one. Any value can be read as text."""
    if isinstance(declared, (T.LongType, T.IntegerType)):
        return kind == "BIGINT"
    if isinstance(declared, (T.DoubleType, T.FloatType)):
        return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    if isinstance(declared, T.ArrayType):
        return kind.startswith("ARRAY")
    if isinstance(declared, T.StructType):
        return kind.startswith("OBJECT")
    return F.lit(True)


def _reasons(schema: T.StructType, id_field: str) -> list[str]:
    wrong = [f"{f.name} is no {f.dataType.simpleString().split('<')[0]}" for f in schema.fields]
    return [NO_OBJECT, f"no {id_field}", *wrong, NESTED]


def _made_once(col: Column, name: str) -> Column:
    """A column behind a generator of one row per row: whatever reads it, it is not made again for every reader."""
    return F.inline(F.array(F.struct(col.alias(name))))


def _reason(blob: Column, schema: T.StructType, id_field: str) -> Column:
    """Why a document that doesn't fit the schema doesn't."""
    kind = lambda name: F.schema_of_variant(F.try_variant_get(blob, f"$.{name}", "variant"))
    missing = lambda name: F.coalesce(kind(name) == "VOID", F.lit(True))
    whole = F.coalesce(F.schema_of_variant(blob).startswith("OBJECT"), F.lit(False))
    reason = F.when(~whole, NO_OBJECT).when(missing(id_field), f"no {id_field}")
    fields = sorted(schema.fields, key=lambda f: f.name != id_field)
    for field in fields:
        told = f"{field.name} is no {field.dataType.simpleString().split('<')[0]}"
        cast = F.try_variant_get(blob, f"$.{field.name}", field.dataType.simpleString())
        fits = _is_a(kind(field.name), field.dataType)
        if isinstance(field.dataType, (T.LongType, T.IntegerType)):
            fits = fits & cast.isNotNull()
        reason = reason.when(~missing(field.name) & ~fits, told)
    return reason.otherwise(NESTED)


def judge_documents(
    landed: DataFrame,
    schema: str,
    id_field: str = "id",
    payload: str = "payload",
    observation: Observation | None = None,
) -> DataFrame:
    """All landed columns, `doc` (the fields of the schema) and `reason`: null for a document that fits.

    A document fits if it is a JSON object, has the id, and no declared field holds a value of
    another type. It is parsed once; only one that doesn't fit is read again, as a VARIANT, to tell
    why. An `observation` counts, while the result is written or read, the documents that `landed`, that were
    `rejected`, and those of every reason.
    """
    declared = T.StructType.fromDDL(schema)
    whole = T.StructType([*declared.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = _made_once(F.from_json(payload, whole, {"columnNameOfCorruptRecord": _CORRUPT}), "doc")
    fits = F.col(f"doc.{_CORRUPT}").isNull() & F.col(f"doc.{id_field}").isNotNull()
    fits = F.coalesce(fits, F.lit(False))
    blob = _made_once(F.when(~fits, F.try_parse_json(payload)), "_blob")
    reason = F.when(fits, F.lit(None).cast("string")).otherwise(_reason(F.col("_blob"), declared, id_field))
    judged = landed.select("*", parsed).select("*", blob).select("*", _made_once(reason, "reason")).drop("_blob")
    judged = judged.withColumn("doc", F.struct(*[F.col(f"doc.{f.name}") for f in declared.fields]))
    if observation is not None:
        counts = [F.count_if(F.col("reason") == r).alias(r) for r in _reasons(declared, id_field)]
        judged = judged.observe(
            observation, F.count(F.lit(1)).alias("landed"), F.count("reason").alias("rejected"), *counts
        )
    return judged


def split_judged(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that fit, rejects with their reason and without what was read of them)."""
    return judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL").drop("doc")
