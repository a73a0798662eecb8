"""Decoded entities to service tables: routing, numbers and times, the fetch time, the one-level flatten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timebucket import epoch_seconds
from ..plans.schemas import SERVICES, SEVERITY, Service, as_text


def typed(value: Column, kind: T.DataType, raw: T.DataType, name: str = "") -> Column:
    """``value`` of type ``raw`` as ``kind``: by name, numbers coerced, null where a number does not read as one."""
    if isinstance(kind, T.StructType):
        fields = [typed(value[f.name], f.dataType, raw[f.name].dataType, f.name).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return value if kind.elementType == raw.elementType else F.transform(value, lambda x: typed(x, kind.elementType, raw.elementType))
    if name == "severityLevel":
        return F.coalesce(F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])[value], value.try_cast("int"))
    return value if kind == raw else value.try_cast(kind)


def route(entities: DataFrame, service: str, strict: bool = False) -> DataFrame:
    """The rows of one service, from (fetch_time, entityId, <payload key> as JSON, ...): entityId, fetchTime, payload columns.

    An entity with several payloads gives a row to each service. Unknown fields are dropped, missing ones null. A payload
    that is no JSON of the right shape gives null fields, or fails the query if ``strict``.
    """
    known = SERVICES[service]
    raw = as_text(known.payload)
    options = {"mode": "FAILFAST" if strict else "PERMISSIVE", "allowNonNumericNumbers": "true"}
    rows = entities.where(F.col(known.key).isNotNull())
    return rows.select("entityId", epoch_seconds(F.col("fetch_time")).alias("fetchTime"), F.from_json(known.key, raw, options).alias("_p")).select(
        "entityId", "fetchTime", *[typed(F.col("_p")[f.name], f.dataType, raw[f.name].dataType, f.name).alias(f.name) for f in known.payload.fields]
    )


def flatten(df: DataFrame) -> DataFrame:
    """Each top-level struct's fields as columns ``parent_child``; what is nested deeper, and arrays, stay. Dots in names become underscores."""
    out = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StructType):
            out += [column[x.name].alias(f"{f.name}_{x.name}".replace(".", "_")) for x in f.dataType.fields]
        else:
            out.append(column.alias(f.name.replace(".", "_")))
    return df.select(*out)


def service_table(entities: DataFrame, service: str, strict: bool = False) -> DataFrame:
    """Routed, typed and flattened."""
    return flatten(route(entities, service, strict))


def conform(df: DataFrame, service: Service | str) -> DataFrame:
    """A foreign table under a service's flat schema: by name, numbers cast (unsigned 64-bit ones arrive as decimals), missing columns null."""
    known = SERVICES[service] if isinstance(service, str) else service
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in known.schema.fields])


def service_counts(entities: DataFrame) -> DataFrame:
    """(service, n): rows per service."""
    return entities.select(F.explode(F.array(*[F.when(F.col(s.key).isNotNull(), F.lit(s.name)) for s in SERVICES.values() if s.key in entities.columns])).alias("service")).where("service IS NOT NULL").groupBy("service").agg(F.count(F.lit(1)).alias("n"))
