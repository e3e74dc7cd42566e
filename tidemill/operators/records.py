"""Record types: their schemas, validation of JSON against them, provenance, flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemill.functions.dates import parse_iso_date
from tidemill.operators.filters import instant

# The allowed pricing models and the schema version.
PRICING_MODELS = ("FREE", "FREEMIUM", "PAID", "ENTERPRISE", "UNKNOWN")
SCHEMA_VERSION = "1.0"


def _field(name: str, kind, required: bool = False, **rules) -> T.StructField:
    """``rules``: ``default`` for a missing key, ``enum`` for allowed values. A rule-less optional field may be null."""
    return T.StructField(name, kind, not required, rules)


def _struct(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


_TEXT, _INT, _BOOL, _TIME = T.StringType(), T.IntegerType(), T.BooleanType(), T.TimestampType()
SOURCE = _struct(_field("name", _TEXT, True), _field("url", _TEXT, True))


def _envelope(kind: str, content: T.StructType, provenance_required: bool = True) -> T.StructType:
    return _struct(
        _field("schemaVersion", _TEXT, True, default=SCHEMA_VERSION),
        _field("recordType", _TEXT, True, default=kind, enum=[kind]),
        _field("source", SOURCE, provenance_required),
        _field("content", content, True),
        _field("collectedAt", _TIME, provenance_required),
    )


CONTENTS = {
    "STARTUP": _struct(
        _field("entityName", _TEXT, True),
        _field(
            "data",
            _struct(
                _field("employeeCount", _INT), _field("foundedYear", _INT), _field("fundingTotal", _TEXT),
                _field("fundingStage", _TEXT), _field("description", _TEXT),
            ),
            True,
        ),
    ),
    "PRODUCT": _struct(_field("startupName", _TEXT, True), _field("pricingModel", _TEXT, True, enum=list(PRICING_MODELS))),
    "ECOMMERCE_PRODUCT": _struct(
        _field("productName", _TEXT, True), _field("price", _TEXT), _field("brand", _TEXT), _field("rating", _TEXT)
    ),
    "RESEARCH_PAPER": _struct(
        _field("title", _TEXT, True), _field("authors", T.ArrayType(_TEXT), True), _field("paper_url", _TEXT, True),
        _field("github_url", _TEXT), _field("github_stars", _INT), _field("published_date", _TIME, True),
    ),
    "NEWS": _struct(
        _field("title", _TEXT, True), _field("url", _TEXT, True), _field("published_date", _TIME, True),
        _field("summary", _TEXT), _field("full_text", _TEXT),
    ),
    "JOB": _struct(
        _field("company", _TEXT), _field("date", _TIME, True), _field("is_remote", _BOOL, True, default=False),
        _field("role_family", _TEXT, True, default="Engineering"),
    ),
}
RECORDS = {kind: _envelope(kind, content, kind != "JOB") for kind, content in CONTENTS.items()}
_ENTITY_RECORDS = {"startup": "STARTUP", "product": "PRODUCT", "ecommerce": "ECOMMERCE_PRODUCT"}


def record_type(entity_type: str) -> str:
    """The record type of an entity type; unknown ones are products."""
    return _ENTITY_RECORDS.get(entity_type, "PRODUCT")


def record_schema(entity_type: str) -> T.StructType:
    return RECORDS[record_type(entity_type)]


# --- building records ---------------------------------------------------------------------------------


def stamp(df: DataFrame, source_name, source_url, as_of) -> DataFrame:
    """Adds ``source`` and ``collectedAt``; names and addresses are columns, or text literals for ``str``."""
    name, url = (F.lit(x) if isinstance(x, str) else x for x in (source_name, source_url))
    return df.withColumn("source", F.struct(name.alias("name"), url.alias("url"))).withColumn("collectedAt", instant(as_of))


def to_records(df: DataFrame, kind: str, fields: dict[str, Column]) -> DataFrame:
    """Envelope rows from a stamped frame; content fields without an expression are null or take their default."""

    def build(schema: T.StructType, prefix: str = "") -> Column:
        parts = []
        for f in schema.fields:
            path = prefix + f.name
            if isinstance(f.dataType, T.StructType) and path not in fields:
                value = build(f.dataType, path + ".")
            else:
                value = fields.get(path, F.lit(f.metadata.get("default"))).cast(f.dataType)
            parts.append(value.alias(f.name))
        return F.struct(*parts)

    return df.select(
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        F.lit(kind).alias("recordType"),
        "source",
        build(CONTENTS[kind]).alias("content"),
        "collectedAt",
    )


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs to ``a.b.c`` columns; lists stay lists, an empty struct yields no column."""

    def leaves(schema: T.StructType, path: tuple[str, ...] = ()):
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here)
            else:
                yield here

    def column(path: tuple[str, ...]) -> Column:
        return F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path))

    return df.select(*[column(p) for p in leaves(df.schema)])


# --- validation ---------------------------------------------------------------------------------------


def _quoted(value) -> str:
    return str(value).lower() if isinstance(value, (bool, int)) else "'" + str(value).replace("'", "\\'") + "'"


def _error(path: str, what: str) -> str:
    return f"array('{path}: {what}')"


_NO_ERRORS = "cast(array() as array<string>)"


def _leaf(f: T.StructField, kind: str, text: str) -> Column:
    """The typed value of a scalar or list, null when it does not fit the type."""
    number = f"(startswith({kind}, 'DECIMAL') or {kind} in ('BIGINT', 'DOUBLE'))"
    if isinstance(f.dataType, T.ArrayType):
        return F.expr(f"case when {kind} in ('ARRAY<STRING>', 'ARRAY<VOID>') then {text} end")
    if isinstance(f.dataType, T.IntegerType):
        whole = rf"rlike({text}, r'^\s*[+-]?[0-9]+(\.0*)?\s*$') and ({number} or {kind} = 'STRING')"
        return F.expr(f"case when {whole} then try_cast(try_cast(btrim({text}) as decimal(38,2)) as int) end")
    if isinstance(f.dataType, T.BooleanType):
        return F.expr(
            f"case when lower(btrim({text})) in ('true', '1', 'yes', 'on', 't', 'y') then true "
            f"when lower(btrim({text})) in ('false', '0', 'no', 'off', 'f', 'n') then false end"
        )
    if isinstance(f.dataType, T.TimestampType):
        seconds = F.expr(f"case when {number} then timestamp_seconds(try_cast({text} as double)) end")
        return F.when(F.col(kind) == "STRING", parse_iso_date(F.col(text))).otherwise(seconds)
    allowed = f" and {text} in ({', '.join(map(_quoted, f.metadata['enum']))})" if "enum" in f.metadata else ""
    return F.expr(f"case when {kind} = 'STRING'{allowed} then {text} end")


def _judge(f: T.StructField, path: tuple[str, ...], number: dict[tuple[str, ...], int]) -> tuple[str, str]:
    """SQL for value and errors of a field: ``kind`` is null for a missing key and VOID for an explicit null.

    A missing key takes the default; an explicit null is an error unless the field may be null.
    """
    i, where = number[path], ".".join(path)
    kind = f"_k{i}"
    if isinstance(f.dataType, T.StructType):
        parts = [(g.name, *_judge(g, (*path, g.name), number)) for g in f.dataType.fields]
        is_object = f"startswith({kind}, 'OBJECT')"
        value = f"case when {is_object} then named_struct({', '.join(f"'{n}', {v}" for n, v, _ in parts)}) end"
        inner = f"flatten(array({', '.join(e for _, _, e in parts)}))"
        errors = f"case when {is_object} then {inner} else {_error(where, 'not an object')} end"
    else:
        value = f"_x{i}"
        errors = f"case when {value} is null then {_error(where, 'invalid')} else {_NO_ERRORS} end"
    if "default" in f.metadata:
        value = f"case when {kind} is null then {_quoted(f.metadata['default'])} else {value} end"
        return value, f"case when {kind} is null then {_NO_ERRORS} else {errors} end"
    if f.nullable:
        return value, f"case when {kind} is null or {kind} = 'VOID' then {_NO_ERRORS} else {errors} end"
    return value, f"case when {kind} is null then {_error(where, 'missing')} else {errors} end"


def _nodes(schema: T.StructType, parents: tuple[str, ...] = ()):
    """Every field of a schema with its path, nested ones too."""
    for f in schema.fields:
        here = (*parents, f.name)
        yield here, f
        if isinstance(f.dataType, T.StructType):
            yield from _nodes(f.dataType, here)


def parse_records(df: DataFrame, json: str, schema: T.StructType | str) -> DataFrame:
    """Adds ``record`` and ``errors``: the typed record and what is wrong with it; the record is null when anything is.

    One projection parses, the next looks up kind and text of every field, the next gives them types: plain columns that
    compile to one generated loop, each computed once.
    """
    schema = RECORDS[schema] if isinstance(schema, str) else schema
    nodes = list(_nodes(schema))
    number = {path: i for i, (path, _) in enumerate(nodes)}
    found, typed = ["schema_of_variant(_v) as _k"], [F.col("_k")]
    for i, (path, f) in enumerate(nodes):
        pointer = "$." + ".".join(path)
        found.append(f"schema_of_variant(try_variant_get(_v, '{pointer}', 'variant')) as _k{i}")
        typed.append(F.col(f"_k{i}"))
        if not isinstance(f.dataType, T.StructType):
            kind = "array<string>" if isinstance(f.dataType, T.ArrayType) else "string"
            found.append(f"try_variant_get(_v, '{pointer}', '{kind}') as _t{i}")
            typed.append(_leaf(f, f"_k{i}", f"_t{i}").alias(f"_x{i}"))
    parts = [(f.name, *_judge(f, (f.name,), number)) for f in schema.fields]
    record = f"named_struct({', '.join(f"'{n}', {v}" for n, v, _ in parts)})"
    errors = f"flatten(array({', '.join(e for _, _, e in parts)}))"
    kept = [F.col(f"`{c}`") for c in df.columns]
    return (
        df.select(*kept, F.try_parse_json(F.col(json)).alias("_v"))
        .select(*kept, *map(F.expr, found))
        .select(*kept, *typed)
        .select(
            *kept,
            F.expr(f"{record} as record"),
            F.expr(f"case when startswith(_k, 'OBJECT') then {errors} else array('not an object') end as errors"),
        )
        .select(*kept, F.expr("case when size(errors) = 0 then record end as record"), "errors")
    )


def parse_valid(df: DataFrame, json: str, schema: T.StructType | str) -> DataFrame:
    """Rows whose JSON is a valid record, with ``record`` in place of the JSON column.

    The record comes out of a generator: a filter on it would be pushed below and parse every row a second time.
    """
    parsed = parse_records(df, json, schema)
    found = F.when(F.size("errors") == 0, F.array("record"))
    return parsed.select(*[c for c in df.columns if c != json], F.explode(found).alias("record"))


def conform(df: DataFrame, json: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """Split rows by validity: ``(valid with record, rejected with errors)``; the JSON column is dropped from the valid."""
    failed = F.when(F.size("errors") > 0, F.array("errors"))
    rejected = parse_records(df, json, schema).select(*df.columns, F.explode(failed).alias("errors"))
    return parse_valid(df, json, schema), rejected
