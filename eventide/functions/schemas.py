"""Records of several schema versions read as one: schema resolution as column expressions.

Schemas are Avro schemas in JSON. A record is decoded with the schema that it was written with
and then turned into the reader's shape by one expression per writer version, compiled once while
the plan is built; nothing is looked up per row but the record's version. Resolution follows the
Avro rules:

* a reader's field takes the writer's field of its name, or of one of its aliases; a field that
  the writer does not have takes its default;
* int becomes long, float or double; long becomes float or double; float becomes double; string
  and bytes become each other;
* records, arrays, maps and optional values (unions of null and one type) are resolved inside;
* symbols that the reader's enum does not have become its default.

``problems`` lists why a reader cannot read what a writer may write; ``compatibility`` does so
for a history of versions. A pair with problems is refused while the plan is built. Unions of
several types besides null and schemas that contain themselves have no column type and are refused.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions import codec as C

PRIMITIVES = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(),
              "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(),
              "string": T.StringType()}
PROMOTED = {"int": {"long", "float", "double"}, "long": {"float", "double"},
            "float": {"double"}, "string": {"bytes"}, "bytes": {"string"}}
NUMBERS = {"int": int, "long": int, "float": (int, float), "double": (int, float)}


class SchemaError(ValueError):
    """A schema that is none, or a writer and a reader that do not go together."""


@dataclass(frozen=True)
class Field:
    name: str
    type: Type
    aliases: tuple[str, ...] = ()
    has_default: bool = False
    default: object = None


@dataclass(frozen=True)
class Type:
    """``kind`` is a primitive, record, enum, array or map; ``item`` is what an array or a map
    holds. An optional type is a union with null, whose first branch a default belongs to."""
    kind: str
    name: str | None = None
    aliases: tuple[str, ...] = ()
    fields: tuple[Field, ...] = ()
    symbols: tuple[str, ...] = ()
    default: str | None = None
    item: Type | None = None
    optional: bool = False
    null_first: bool = False
    text: str = field(default="", compare=False)


def parse(schema: str | dict | list) -> Type:
    """A schema from its JSON text (or the object it stands for)."""
    spec = json.loads(schema) if isinstance(schema, str) and schema.lstrip()[:1] in '{["' else schema
    node = _type(spec, {}, ())
    return Type(**{**node.__dict__, "text": schema if isinstance(schema, str) else json.dumps(schema)})


def _type(spec, known: dict[str, Type], inside: tuple[str, ...]) -> Type:
    if isinstance(spec, list):
        rest = [b for b in spec if b != "null"]
        if len(rest) != 1 or len(spec) > 2:
            raise SchemaError(f"unions are of null and one type, not {spec}")
        inner = _type(rest[0], known, inside)
        if len(spec) == 1:
            return inner
        return Type(**{**inner.__dict__, "optional": True, "null_first": spec[0] == "null"})
    if isinstance(spec, str):
        if spec in PRIMITIVES:
            return Type(spec)
        name = spec.rsplit(".", 1)[-1]
        if name in inside:
            raise SchemaError(f"{spec} contains itself")
        if name not in known:
            raise SchemaError(f"unknown type {spec}")
        return known[name]
    if not isinstance(spec, dict) or "type" not in spec:
        raise SchemaError(f"no schema: {spec}")
    kind = spec["type"]
    if kind == "array":
        return Type("array", item=_type(spec["items"], known, inside))
    if kind == "map":
        return Type("map", item=_type(spec["values"], known, inside))
    if kind not in ("record", "enum"):
        return _type(kind, known, inside)
    name = spec["name"].rsplit(".", 1)[-1]
    aliases = tuple(a.rsplit(".", 1)[-1] for a in spec.get("aliases", ()))
    if kind == "enum":
        node = Type("enum", name, aliases, symbols=tuple(spec["symbols"]),
                    default=spec.get("default"))
        if node.default is not None and node.default not in node.symbols:
            raise SchemaError(f"{name}: the default {node.default} is no symbol")
    else:
        fields = tuple(Field(f["name"], _type(f["type"], known, (*inside, name)),
                             tuple(f.get("aliases", ())), "default" in f, f.get("default"))
                       for f in spec["fields"])
        if len({f.name for f in fields}) < len(fields):
            raise SchemaError(f"{name}: a field name occurs twice")
        for f in fields:
            if f.has_default:
                _check_default(f.type, f.default, f"{name}.{f.name}")
        node = Type("record", name, aliases, fields=fields)
    known[name] = node
    return node


def spark_type(node: Type) -> T.DataType:
    """The column type of a schema's values."""
    if node.kind == "record":
        return T.StructType([T.StructField(f.name, spark_type(f.type)) for f in node.fields])
    if node.kind == "array":
        return T.ArrayType(spark_type(node.item))
    if node.kind == "map":
        return T.MapType(T.StringType(), spark_type(node.item))
    return T.StringType() if node.kind == "enum" else PRIMITIVES[node.kind]


def _check_default(node: Type, value, path: str) -> None:
    """A default has its type's form; that of an optional type is of the first branch."""
    wrong = SchemaError(f"{path}: {json.dumps(value)} is no default of {node.kind}")
    if value is None:
        fits = node.optional and node.null_first
    elif node.optional and node.null_first:
        fits = False
    elif node.kind in ("record", "map"):
        fits = isinstance(value, dict)
    elif node.kind == "array":
        fits = isinstance(value, list)
    elif node.kind == "boolean":
        fits = isinstance(value, bool)
    elif node.kind in NUMBERS:
        fits = isinstance(value, NUMBERS[node.kind]) and not isinstance(value, bool)
    else:
        fits = isinstance(value, str) and (node.kind != "enum" or value in node.symbols)
    if not fits:
        raise wrong
    if value is not None and node.kind == "record":
        for f in node.fields:
            if f.name in value:
                _check_default(f.type, value[f.name], f"{path}.{f.name}")
            elif not f.has_default:
                raise SchemaError(f"{path}: the default lacks {f.name}")
    elif value is not None and node.item:
        for v in value.values() if node.kind == "map" else value:
            _check_default(node.item, v, f"{path}[]")


def constant(node: Type, value) -> Column:
    """A default as a column."""
    if value is None:
        return F.lit(None).cast(spark_type(node))
    if node.kind == "record":
        return F.struct(*[constant(f.type, value.get(f.name, f.default)).alias(f.name)
                          for f in node.fields])
    if node.kind == "array":
        return F.array(*[constant(node.item, v) for v in value]).cast(spark_type(node))
    if node.kind == "map":
        pairs = [c for k, v in value.items() for c in (F.lit(k), constant(node.item, v))]
        return F.create_map(*pairs).cast(spark_type(node))
    if node.kind == "bytes":
        return F.lit(bytearray(value.encode("latin-1")))
    return F.lit(value).cast(spark_type(node))


def _source(reader: Field, writer: Type) -> Field | None:
    """The writer's field that a reader's field is read from: its own name goes before aliases."""
    by_name = {f.name: f for f in writer.fields}
    return next((by_name[n] for n in (reader.name, *reader.aliases) if n in by_name), None)


def problems(writer: Type, reader: Type, path: str = "record") -> list[str]:
    """Why a reader cannot read everything the writer may write; empty if it can."""
    out = []
    if writer.optional and not reader.optional:
        out.append(f"{path}: null may be written, but not read")
    if writer.kind != reader.kind:
        if reader.kind not in PROMOTED.get(writer.kind, ()):
            out.append(f"{path}: {writer.kind} does not become {reader.kind}")
        return out
    if writer.kind in ("record", "enum") and writer.name not in (reader.name, *reader.aliases):
        out.append(f"{path}: {writer.name} is read as {reader.name}")
    if writer.kind == "enum" and reader.default is None:
        unknown = [s for s in writer.symbols if s not in reader.symbols]
        if unknown:
            out.append(f"{path}: no symbol or default for {', '.join(unknown)}")
    if writer.item:
        out += problems(writer.item, reader.item, f"{path}[]")
    for f in reader.fields:
        source = _source(f, writer)
        if source:
            out += problems(source.type, f.type, f"{path}.{f.name}")
        elif not f.has_default:
            out.append(f"{path}.{f.name}: not written, and without a default")
    return out


def compatibility(history: list[Type], new: Type, mode: str = "BACKWARD") -> list[str]:
    """Why ``new`` may not follow the versions in ``history`` (oldest first). BACKWARD: it reads
    what they wrote; FORWARD: they read what it writes; FULL: both; with ``_TRANSITIVE`` all
    versions count, otherwise the last."""
    way, _, rest = mode.partition("_")
    if way not in ("BACKWARD", "FORWARD", "FULL", "NONE") or rest not in ("", "TRANSITIVE"):
        raise ValueError(f"unknown mode {mode}")
    out = []
    for number, old in list(enumerate(history, 1))[0 if rest else -1:]:
        if way in ("BACKWARD", "FULL"):
            out += [f"reading version {number}: {p}" for p in problems(old, new)]
        if way in ("FORWARD", "FULL"):
            out += [f"read by version {number}: {p}" for p in problems(new, old)]
    return out


def resolved(value: Column, writer: Type, reader: Type, path: str = "record") -> Column:
    """A value decoded with the writer's schema, in the reader's shape. A null where the writer's
    schema has none fails the job: the record was not written with that schema."""
    if writer.kind == "record":
        parts = []
        for f in reader.fields:
            source, at = _source(f, writer), f"{path}.{f.name}"
            part = (resolved(value[source.name], source.type, f.type, at) if source
                    else constant(f.type, f.default))
            parts.append(part.alias(f.name))
        out = F.struct(*parts)
    elif writer.kind == "array":
        out = F.transform(value, lambda x: resolved(x, writer.item, reader.item, f"{path}[]"))
    elif writer.kind == "map":
        out = F.transform_values(value, lambda _, x: resolved(x, writer.item, reader.item,
                                                              f"{path}[]"))
    elif writer.kind == "enum":
        foreign = (F.raise_error(F.concat(F.lit(f"{path}: no symbol "), value))
                   if reader.default is None else F.lit(reader.default))
        out = F.when(value.isin(*reader.symbols), value).otherwise(foreign)
    else:
        out = value.cast(spark_type(reader))
    if writer.optional:
        return F.when(value.isNotNull(), out)
    return F.when(value.isNull(), F.raise_error(F.lit(f"{path}: no value"))).otherwise(out)


def from_json_text(value: Column, writer: Type) -> Column:
    """Decode JSON text (binary fields in base 64); what is no JSON fails the job."""
    return C.decode_json(value, spark_type(writer), failfast=True)


def read_versions(records: DataFrame, value: str, version: str, writers: dict[int, Type],
                  reader: Type, decode: Callable[[Column, Type], Column] = from_json_text
                  ) -> DataFrame:
    """``records`` without ``value`` and with a struct ``record`` in the reader's shape. Each
    value is decoded with the schema that its ``version`` names; a version that ``writers`` does
    not have fails the job. ``decode`` may be an Avro decoder (``Type.text`` is the schema). A
    null value is a null record. Works on tables and streams."""
    wrong = [f"version {v}: {p}" for v, w in sorted(writers.items()) for p in problems(w, reader)]
    if wrong:
        raise SchemaError("; ".join(wrong))
    kept = [c for c in records.columns if c != value]
    # decoded in a projection of its own: the expressions below name each field of it once or more
    decoded = records.select(*kept, F.col(value).alias("__value"), F.col(version).alias("__version"), *[
        F.when(F.col(version) == v, decode(F.col(value), w)).alias(f"__v{v}")
        for v, w in writers.items()])
    unknown = F.raise_error(F.concat(F.lit("no schema for version "),
                                     F.coalesce(F.col("__version").cast("string"), F.lit("null"))))
    record = F.when(F.col("__value").isNull(), F.lit(None).cast(spark_type(reader)))
    for v, w in writers.items():
        record = record.when(F.col("__version") == v, resolved(F.col(f"__v{v}"), w, reader))
    return decoded.select(*kept, record.otherwise(unknown).alias("record"))
