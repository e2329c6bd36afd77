"""Frame split and body decode.

Bodies are JSON text (locally testable) or Avro (``from_avro``/``to_avro``,
which need the spark-avro package on the classpath). Each body is parsed once:
parsed structs are not inlined into every field reference or into a later
filter (see ``_one_evaluation``).
"""

from __future__ import annotations

import json
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.functions.framing import build_frame, frame_magic, frame_payload, frame_schema_id
from ordertide.params import PipelineParams
from ordertide.schemas import ORDER_EVENT

#: A schema version: a struct, DDL text, or the Avro schema text that describes the bytes.
Schema = T.StructType | str


def split_frame(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``magic`` (hex), ``schema_id`` (bigint) and ``payload`` (binary)."""
    v = F.col(value_col)
    return df.withColumns({
        "magic": frame_magic(v),
        "schema_id": frame_schema_id(v),
        "payload": frame_payload(v),
    })


def as_struct(schema: Schema) -> T.StructType:
    """Spark struct of a schema given as a struct, as DDL text or as Avro schema text."""
    if isinstance(schema, T.StructType):
        return schema
    if schema.lstrip().startswith("{"):
        return avro_struct(schema)
    return T.StructType.fromDDL(schema)


def _parse(payload: Column, schema: Schema, body_format: str, mode: str) -> Column:
    if body_format == "json":
        return F.from_json(payload.cast("string"), as_struct(schema), {"mode": mode})
    if body_format == "avro":
        from pyspark.sql.avro.functions import from_avro  # needs spark-avro
        # the given text describes the bytes; only a schema given as a struct gets a derived one
        text = schema if isinstance(schema, str) and schema.lstrip().startswith("{") else avro_schema_json(as_struct(schema))
        return from_avro(payload, text, {"mode": mode})
    raise ValueError(f"unknown body format {body_format!r}")


def _encode(struct_col: Column, schema: T.StructType, body_format: str) -> Column:
    if body_format == "json":
        return F.to_json(struct_col)
    if body_format == "avro":
        from pyspark.sql.avro.functions import to_avro  # needs spark-avro
        return to_avro(struct_col, avro_schema_json(schema))
    raise ValueError(f"unknown body format {body_format!r}")


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Union of two versions of a type: structs by field, arrays by element, at any depth."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return superset_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType), True)
    if a != b:
        raise ValueError(f"versions disagree: {a.simpleString()} and {b.simpleString()}")
    return a


def superset_schema(schemas: Iterable[Schema]) -> T.StructType:
    """Union of all versions' fields, nested ones too, first-seen order (additive evolution)."""
    fields: dict[str, T.DataType] = {}
    for schema in map(as_struct, schemas):
        for f in schema.fields:
            fields[f.name] = merged_type(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(name, _nullable(kind), True) for name, kind in fields.items()])


def _nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    return kind


def shaped(value: Column, has: T.DataType, target: T.DataType) -> Column:
    """``value`` of type ``has`` as the superset type ``target``; fields that ``has`` lacks are null."""
    if _nullable(has) == target:
        return value
    if isinstance(target, T.StructType):
        own = {f.name: f.dataType for f in has.fields}
        fields = [(shaped(value.getField(f.name), own[f.name], f.dataType) if f.name in own
                   else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return F.transform(value, lambda x: shaped(x, has.elementType, target.elementType))


def _one_evaluation(fields: list[Column]) -> Column:
    """Emits the decoded fields through a one-row generator.

    Filters on decoded fields cannot be pushed below a generator, so the
    bodies are parsed once per record instead of once more per filter
    reference (a pushed-down filter would inline the parser).
    """
    return F.inline(F.array(F.struct(*fields)))


def decode_fixed(df: DataFrame, schema: Schema = ORDER_EVENT, body_format: str = "json",
                 mode: str = "FAILFAST", value_col: str = "value",
                 keep: Iterable[str] = ()) -> DataFrame:
    """D3 + D6: cut the header, parse every body with one reader schema, flatten.

    The header's schema id is not consulted. FAILFAST (the decoder's default)
    raises on a malformed body; PERMISSIVE yields nulls.
    """
    keep = list(keep)
    parsed = _parse(frame_payload(F.col(value_col)), schema, body_format, mode).alias("__v")
    out = [F.col(k).alias(k) for k in keep] + [
        F.col("__v").getField(f.name).alias(f.name) for f in as_struct(schema).fields]
    return df.select(*[F.col(k) for k in keep], parsed).select(_one_evaluation(out))


def prune_schema(schema: T.StructType, fields: Iterable[str] | None) -> T.StructType:
    """Top-level fields of ``schema`` that are in ``fields`` (all when None)."""
    if fields is None:
        return schema
    wanted = set(fields)
    return T.StructType([f for f in schema.fields if f.name in wanted])


def decode_by_schema_id(df: DataFrame, schemas: Mapping[int, Schema],
                        body_format: str = "json", mode: str = "PERMISSIVE",
                        value_col: str = "value", keep: Iterable[str] = (),
                        with_schema_id: bool = False,
                        fields: Iterable[str] | None = None,
                        unknown: str = "drop") -> DataFrame:
    """D4 + D6: parse each frame with the schema its header id names.

    The result has the superset of all versions' fields, at any depth (or only
    the top-level ``fields``); fields a version lacks are null. A frame with a
    wrong magic byte or a body that does not parse yields an all-null row
    (later dropped by the validity filter; ``frame_outcomes`` counts them), and
    so does an unregistered id, unless ``unknown="fail"``, which raises on it.
    Adding a schema version is a change of ``schemas`` plus restart.

    Each body is parsed once: the parser of every other version gets a null
    input and does no work, and the parsed structs are not inlined into each
    field reference (two projections) nor into later filters (generator).
    With ``fields`` the JSON parse schema keeps only those fields.
    """
    if not schemas:
        raise ValueError("decoding by schema id needs the registered schemas, {id: schema}")
    fields = None if fields is None else list(fields)
    structs = {int(k): prune_schema(as_struct(s), fields) for k, s in schemas.items()}
    target = superset_schema(structs.values())
    v = F.col(value_col)
    sid, payload = frame_schema_id(v), frame_payload(v)
    ok = frame_magic(v) == F.lit("00")
    keep = list(keep)
    parsed = []
    for k, schema in schemas.items():
        reader = structs[int(k)] if body_format == "json" else schema
        parsed.append(_parse(F.when(ok & (sid == F.lit(int(k))), payload), reader, body_format, mode).alias(f"__v{k}"))
    seen = sid
    if unknown == "fail":
        stray = ok & ~sid.isin(*structs)
        seen = F.when(stray, F.raise_error(F.concat(F.lit("unregistered schema id "), sid.cast("string")))).otherwise(sid)
    first = df.select(*[F.col(k) for k in keep], seen.cast("bigint").alias("schema_id"), *parsed)
    out = [F.col(k).alias(k) for k in keep]
    if with_schema_id or unknown == "fail":
        out.append(F.col("schema_id"))
    for f in target.fields:
        options = [shaped(F.col(f"__v{k}").getField(f.name), s[f.name].dataType, f.dataType)
                   for k, s in structs.items() if f.name in s.fieldNames()]
        out.append((options[0] if len(options) == 1 else F.coalesce(*options)).alias(f.name))
    return first.select(_one_evaluation(out))


def frame_outcomes(df: DataFrame, schemas: Mapping[int, Schema], body_format: str = "json",
                   value_col: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """``outcome`` of each frame: short_frame, bad_magic, unknown_schema, bad_body or decoded.

    Group and count it in batch, or attach ``F.count_if`` of each through
    ``DataFrame.observe`` to see what a stream's batches drop.
    """
    v = F.col(value_col)
    sid, payload = frame_schema_id(v), frame_payload(v)
    good = []
    for k, schema in schemas.items():
        mine = F.when(sid == F.lit(int(k)), payload)
        if body_format == "json":
            marked = T.StructType([*as_struct(schema).fields, T.StructField("_corrupt_record", T.StringType())])
            parsed = F.from_json(mine.cast("string"), marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
            good.append(parsed.isNotNull() & parsed["_corrupt_record"].isNull() & (F.trim(mine.cast("string")) != ""))
        else:
            good.append(_parse(mine, schema, body_format, "PERMISSIVE").isNotNull())
    outcome = (F.when(v.isNull() | (F.length(v) < 5), F.lit("short_frame"))
               .when(frame_magic(v) != "00", F.lit("bad_magic"))
               .when(~sid.isin(*[int(k) for k in schemas]), F.lit("unknown_schema"))
               .when(F.coalesce(*[F.when(g, F.lit(True)) for g in good], F.lit(False)), F.lit("decoded"))
               .otherwise(F.lit("bad_body")))
    return df.select(*keep, outcome.alias("outcome"))


def decode(df: DataFrame, params: PipelineParams, keep: Iterable[str] = (),
           fields: Iterable[str] | None = None, value_col: str = "value") -> DataFrame:
    """Decoder choice by parameter (``value_col``: "raw_payload" on bronze)."""
    if params.decode == "fixed":
        schema = params.fixed_schema or ORDER_EVENT
        if params.body_format == "json":
            schema = prune_schema(as_struct(schema), fields)
        return decode_fixed(df, schema, params.body_format, params.parse_mode, value_col=value_col,
                            keep=keep)
    if params.decode == "by_schema_id":
        return decode_by_schema_id(df, params.schemas, params.body_format, params.parse_mode,
                                   value_col=value_col, keep=keep, fields=fields, unknown=params.unknown_schema)
    raise ValueError(f"unknown decoder {params.decode!r}")


def encode_frames(df: DataFrame, schema_id: Column | int, schema: T.StructType = ORDER_EVENT,
                  body_format: str = "json", out_col: str = "value",
                  keep: Iterable[str] = ()) -> DataFrame:
    """Order columns -> framed record (magic, id, encoded body)."""
    record = F.struct(*[F.col(f.name) for f in schema.fields])
    return df.select(*keep, build_frame(schema_id, _encode(record, schema, body_format)).alias(out_col))


# --- Avro schema text for a StructType (reader/writer schema of from_avro) ---

def _avro_type(dt: T.DataType, name: str, nullable: bool):
    if isinstance(dt, T.StringType):
        base = "string"
    elif isinstance(dt, T.IntegerType):
        base = "int"
    elif isinstance(dt, T.LongType):
        base = "long"
    elif isinstance(dt, T.DoubleType):
        base = "double"
    elif isinstance(dt, T.BooleanType):
        base = "boolean"
    elif isinstance(dt, T.ArrayType):
        base = {"type": "array", "items": _avro_type(dt.elementType, name + "_item", False)}
    elif isinstance(dt, T.StructType):
        base = _avro_record(dt, name)
    else:
        raise TypeError(f"no Avro mapping for {dt}")
    return ["null", base] if nullable else base


def _avro_record(schema: T.StructType, name: str) -> dict:
    return {"type": "record", "name": name, "fields": [
        {"name": f.name, "type": _avro_type(f.dataType, f"{name}_{f.name}", f.nullable),
         **({"default": None} if f.nullable else {})}
        for f in schema.fields]}


def avro_schema_json(schema: T.StructType, name: str = "LiveOrderEvent") -> str:
    return json.dumps(_avro_record(schema, name))


# --- StructType of an Avro schema text ---

_AVRO_PRIMITIVES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
                    "float": T.FloatType(), "boolean": T.BooleanType(), "bytes": T.BinaryType()}


def _avro_spark_type(kind) -> tuple[T.DataType, bool]:
    """Spark type and nullability of an Avro type."""
    if isinstance(kind, list):
        rest = [k for k in kind if k != "null"]
        if len(rest) != 1:
            raise TypeError(f"no Spark type for union {kind}")
        return _avro_spark_type(rest[0])[0], "null" in kind
    if isinstance(kind, str):
        return _AVRO_PRIMITIVES[kind], False
    if kind["type"] == "record":
        fields = []
        for f in kind["fields"]:
            spark_type, nullable = _avro_spark_type(f["type"])
            fields.append(T.StructField(f["name"], spark_type, nullable))
        return T.StructType(fields), False
    if kind["type"] == "array":
        element, nullable = _avro_spark_type(kind["items"])
        return T.ArrayType(element, nullable), False
    if kind["type"] == "enum":
        return T.StringType(), False
    return _avro_spark_type(kind["type"])


def avro_struct(text: str) -> T.StructType:
    return _avro_spark_type(json.loads(text))[0]
