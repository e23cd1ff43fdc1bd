"""Helpers shared by the operators of this subpackage.

An input may have further columns of any name. A column that has the name of a
result column is replaced by it; helper columns take names the input lacks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, in any case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def col(name: str) -> Column:
    """A column by its plain name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name), F.lit(""))


def prefix_sums(lengths: Column) -> Column:
    """Running totals of an array of longs, itself included.

    Blocks of 256 keep the work at n**1.5 where a fold that appends is quadratic.
    """
    zero = F.lit(0).cast("bigint")

    def total(values: Column) -> Column:
        return F.aggregate(values, zero, lambda acc, x: acc + x)

    blocks = F.transform(
        F.when(F.size(lengths) > 0, F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / 256).cast("int"))).otherwise(
            F.array().cast("array<int>")
        ),
        lambda b: F.slice(lengths, b * 256 + 1, F.lit(256)),
    )

    def within(parts: Column) -> Column:
        sums = F.transform(parts, total)
        return F.transform(
            F.array(sums),
            lambda s: F.flatten(
                F.transform(
                    parts,
                    lambda part, b: F.transform(
                        F.array(total(F.slice(s, F.lit(1), b))),
                        lambda before: F.transform(part, lambda _, i: before + total(F.slice(part, F.lit(1), i + 1))),
                    )[0],
                )
            ),
        )[0]

    return F.transform(F.array(blocks), within)[0]
