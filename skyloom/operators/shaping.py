"""Projections: column names, layouts and the long form of a row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from skyloom.constants import CITY_TO_IATA, FLIGHT_KEYS, PROTECTED_WORDS, TRANSFORM_KEEP


def suffixed(df: DataFrame, suffix: str, keep: Iterable[str] = ()) -> DataFrame:
    kept = set(keep)
    return df.toDF(*[c if c in kept else c + suffix for c in df.columns])


def trimmed_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def rename_if_free(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns that exist, unless the new name is taken already."""
    return df.withColumnsRenamed(
        {old: new for old, new in names.items() if old in df.columns and new not in df.columns}
    )


AFTER_REPAIR = {"movement_date_dep": "movement_date", "status_dep": "status"}
AFTER_REPAIR_WIDE = {
    "scheduled_departure_dep": "scheduled_departure",
    "scheduled_arrival_arr": "scheduled_arrival",
    **AFTER_REPAIR,
}


def harmonize(df: DataFrame, wide: bool = False) -> DataFrame:
    """Give repaired flights the plain names again (``wide`` includes the scheduled times)."""
    return rename_if_free(df, AFTER_REPAIR_WIDE if wide else AFTER_REPAIR)


def kept_by_name(
    names: Iterable[str],
    extra: Iterable[str] = TRANSFORM_KEEP,
    suffixes: tuple[str, ...] = ("_dep", "_arr"),
    keys: Iterable[str] = FLIGHT_KEYS,
    protected: Iterable[str] = PROTECTED_WORDS,
) -> list[str]:
    """Names kept by the purge rule: side suffixes, keys, delay words and a few extras."""
    keys, extra = set(keys), set(extra)
    return [
        n
        for n in names
        if n.endswith(suffixes) or n in keys or n in extra or any(w in n.lower() for w in protected)
    ]


def drop_matching(df: DataFrame, part: str = "NBVol") -> DataFrame:
    return df.drop(*[c for c in df.columns if part in c])


def drop_leading(df: DataFrame, count: int = 4) -> DataFrame:
    """Drop the leading identity columns."""
    return df.drop(*df.columns[:count])


def recode(df: DataFrame, column: str, codes: Mapping[str, str] = CITY_TO_IATA) -> DataFrame:
    """Replace known values by their code; others stay."""
    pairs = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return df.withColumn(column, F.coalesce(F.try_element_at(pairs, F.col(column)), F.col(column)))


def key_value(df: DataFrame, row_id: list[str], name: str = "colonne", value: str = "valeur") -> DataFrame:
    """One row per cell: the row's identity, the column name and the value as text."""
    others = [c for c in df.columns if c not in row_id]
    as_text = df.select(*row_id, *[F.col(f"`{c}`").cast("string").alias(c) for c in others])
    return as_text.unpivot(row_id, others, name, value)


def key_value_report(df: DataFrame, row_id: str, stamp: str) -> DataFrame:
    """``key_value`` with a generation stamp and the row's number ahead of each row's cells."""
    cells = key_value(df, [row_id]).select(
        row_id, F.lit(2).alias("part"), "colonne", "valeur"
    )
    head = df.select(
        row_id,
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("part"), F.lit("DATE_GENERATION").alias("colonne"), F.lit(stamp).alias("valeur")),
                F.struct(
                    F.lit(1).alias("part"),
                    F.concat(F.lit("LineNumber_"), F.col(row_id)).alias("colonne"),
                    F.col(row_id).cast("string").alias("valeur"),
                ),
            )
        ).alias("cell"),
    ).select(row_id, "cell.*")
    return head.unionByName(cells)


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs as flat columns with dotted names."""

    def leaves(schema: StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, StructType):
                yield from leaves(field.dataType, here)
            else:
                yield here

    return df.select(
        *[
            F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path))
            for path in leaves(df.schema, ())
        ]
    )


def stack(*tables: DataFrame) -> DataFrame:
    """Union by name; columns a table lacks are null."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result
