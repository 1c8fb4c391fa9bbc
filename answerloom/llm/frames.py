"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a table that the driver made itself is broadcast by hint.
BROADCAST_ROWS = 200_000


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` changed, where needed, so that they clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of rows that the driver computed, as SQL literals (no RDD, no Python)."""
    fields = [x.split() for x in schema.split(",")]
    text = json.dumps([{f: v for (f, _), v in zip(fields, r, strict=True)} for r in rows])
    kind = ",".join(f"{name}:{kind}" for name, kind in fields)
    parsed = F.from_json(F.lit(text), f"array<struct<{kind}>>")
    table = spark.range(1).select(F.inline(parsed))
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(name: str) -> Column:
    """The text column; null is empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct, so that no working column clashes with them."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])
