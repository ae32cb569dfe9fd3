"""Access to the dynamic dimensions of log rows: a map, a JSON text or a variant.

A variant is JSON that was parsed once, when it was stored; text is parsed by every query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MAP = "map<string,string>"


def parsed_dimensions(df: DataFrame, name: str) -> Column:
    """Dimensions as a variant; text that is no JSON gives NULL."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.VariantType):
        return F.col(name)
    if isinstance(kind, T.MapType):
        return F.try_parse_json(F.to_json(F.col(name)))
    return F.try_parse_json(F.col(name))


def dimension(df: DataFrame, name: str, key: str) -> Column:
    """The value of one dimension as a string; NULL when it is absent."""
    if isinstance(df.schema[name].dataType, T.MapType):
        return F.try_element_at(F.col(name), F.lit(key)).cast("string")
    if isinstance(df.schema[name].dataType, T.VariantType):
        return F.try_variant_get(F.col(name), f"$['{key}']", "string")
    return F.get_json_object(F.col(name), f"$['{key}']")


def dimension_map(df: DataFrame, name: str) -> Column:
    """All dimensions as a map of strings."""
    if isinstance(df.schema[name].dataType, T.MapType):
        return F.col(name).cast(_MAP)
    if isinstance(df.schema[name].dataType, T.VariantType):
        return F.try_variant_get(F.col(name), "$", _MAP)
    return F.from_json(F.col(name), _MAP)


def merge_dimensions(defaults: Column, record: Column) -> Column:
    """Both maps in one; where a key is in both, the record's value stays.

    A NULL map counts as empty.
    """
    empty = F.create_map().cast(_MAP)
    record = F.coalesce(record, empty)
    missing = F.map_filter(
        F.coalesce(defaults, empty), lambda key, _: ~F.map_contains_key(record, key)
    )
    return F.map_concat(missing, record)
