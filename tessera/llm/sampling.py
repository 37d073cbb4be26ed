"""A bounded, repeatable sample of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, mod ``modulus``, is ``remainder`` (null id: of "null")."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return F.crc32(text.cast("binary")) % modulus == remainder


def per_class(df: DataFrame, class_col: str, most: int | dict, classes: int, tie: Column) -> tuple[DataFrame | None, list]:
    """At most ``most`` rows (or as many as it has for the value) of each value of ``class_col``, those with the
    smallest hash ``tie``, and the sorted values.  More than ``classes``
    values are an error.  One pass counts the values and one reads the sample: rows far
    above a class's expected cut are filtered out where they are read, so the window
    that picks the rest sees few rows of each class, whatever its size."""
    counts = sorted((r[0], r[1]) for r in df.where(F.col(class_col).isNotNull()).groupBy(class_col).count().take(classes + 1))
    if len(counts) > classes:
        raise ValueError(f"{class_col} has more than {classes} values")
    if not counts:
        return None, []
    per = {value: most[value] if isinstance(most, dict) else most for value, _ in counts}
    cut = {value: int(1.5 * per[value] / n * (1 << 20)) + 1 if n > 2 * per[value] else 1 << 20 for value, n in counts}
    of = lambda table: F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), F.col(class_col))
    near = (df.where(F.col(class_col).isNotNull()).withColumn("_tie", F.pmod(tie, F.lit(1 << 20)))
            .where(F.col("_tie") < of(cut)))
    nth = F.row_number().over(Window.partitionBy(class_col).orderBy("_tie", *df.columns))
    return near.withColumn("_nth", nth).where(F.col("_nth") <= of(per)).drop("_tie", "_nth"), [v for v, _ in counts]
