"""Reshaping: flattening of nested rows, aliases, defaults, items of several shapes, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame, joiner: str = ".", depth: int = 8) -> DataFrame:
    """Structs as columns named by their path, to ``depth``; arrays and maps stay. Clashing names get a number."""

    def fields(schema: T.StructType, prefix: tuple[str, ...], left: int):
        for f in schema.fields:
            path = (*prefix, f.name)
            if isinstance(f.dataType, T.StructType) and left:
                yield from fields(f.dataType, path, left - 1)
            else:
                yield path

    used: dict[str, int] = {}
    out = []
    for path in fields(df.schema, (), depth):
        column = F.col(f"`{path[0]}`")
        for part in path[1:]:
            column = column[part]
        name = joiner.join(path)
        used[name] = used.get(name, 0) + 1
        out.append(column.alias(name if used[name] == 1 else f"{name}_{used[name]}"))
    return df.select(*out)


def renamed(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns under one name, from the first of several names that has a value; the others are dropped."""
    out = df
    for name, others in aliases.items():
        present = [c for c in [name, *others] if c in df.columns]
        value = F.coalesce(*(F.col(c) for c in present)) if present else F.lit(None).cast("string")
        out = out.drop(*present).withColumn(name, value) if not present else out.withColumn("__v", value).drop(*present).withColumnRenamed("__v", name)
    return out


def only(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of the columns that there are, in the given order."""
    return df.select(*[c for c in columns if c in df.columns])


def defaulted(value: Column, **defaults: Column) -> Column:
    """A struct with its null fields, or all of them, replaced by defaults."""
    return F.struct(*(F.coalesce(value[name], default).alias(name) for name, default in defaults.items()))


def coerced_items(items: Column, fields: dict[str, list[str]], main: str, number: str | None = None, pattern: str = "item_%03d") -> Column:
    """Items of a JSON array, strings or objects with varying keys, as structs of strings.

    A string is the ``main`` field of its struct; each field takes the first of its names that an
    object has. With ``number`` a missing value of that field is numbered by position. Items that
    are neither, and null, are dropped; what is no array gives an empty one.
    """
    array = F.coalesce(F.from_json(items, T.ArrayType(T.StringType())), F.array().cast("array<string>"))

    def one(item: Column, i: Column) -> Column:
        is_object = F.ltrim(item).startswith("{")
        parts = []
        for name, names in fields.items():
            found = F.coalesce(*(F.get_json_object(item, f"$.{n}") for n in [name, *names]))
            value = F.when(is_object, found).when(F.lit(name == main), item)
            if name == number:
                value = F.coalesce(value, F.format_string(pattern, i + 1))
            parts.append(value.alias(name))
        return F.struct(*parts)

    kept = F.filter(array, lambda x: x.isNotNull() & (F.trim(x) != "") & ~F.ltrim(x).startswith("["))
    return F.transform(kept, one)


def validated(rows: DataFrame, required: list[str], longest: dict[str, int] | None = None) -> DataFrame:
    """Rows with ``errors``, a code for each required value that is missing, ``valid``, and arrays cut to their longest."""
    missing = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    errors = F.array_compact(F.array(*(F.when(missing(c), F.lit(f"missing_{c}")) for c in required)))
    out = rows.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)
    for c, n in (longest or {}).items():
        out = out.withColumn(c, F.slice(c, 1, n))
    return out


def looked_up(value: Column, table: dict[str, str], default: str | None = None) -> Column:
    """A value by a small fixed table; itself, or ``default``, where the table has none."""
    if not table:
        return value if default is None else F.lit(default)
    entries = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.coalesce(F.try_element_at(entries, value), F.lit(default) if default is not None else value)


def label_of_first(items: Column, *fields: str, joiner: str = ":") -> Column:
    """The fields of the first item of an array of structs, joined; empty without items."""
    first = F.try_element_at(items, F.lit(1))
    return F.when(F.size(items) > 0, F.concat_ws(joiner, *(first[f].cast("string") for f in fields))).otherwise(F.lit(""))


def numeric_entries(mapping: Column, digits: int = 3) -> Column:
    """The entries of a map of strings that are numbers, rounded."""
    kept = F.map_filter(mapping, lambda _, v: v.try_cast("double").isNotNull())
    return F.transform_values(kept, lambda _, v: F.round(v.try_cast("double"), digits))
