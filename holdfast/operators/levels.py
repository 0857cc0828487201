"""Categories of any number of levels as sparse vectors, learned into a table.

A level's place is its position among the sorted values of its column. Places come from a table
that is cut by value ranges, so neither the levels nor their order ever meet in one task or on
the driver, and rows find their places by a join. A column per level is never made.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.operators.features import category_counts
from holdfast.session import materialize

#: Columns of up to so many levels, and levels of so many rows, find their rows by a broadcast: a shuffle by a
#: column of few values, or of one frequent value, would bring most rows to a few tasks.
FEW_LEVELS = 10_000
MANY_ROWS = 100_000
_SCATTER = 1_000

LEVEL_SCHEMA = "column string, value string, rows long, place long"


def level_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, rows, place`` of every value but NULL; places count from 0 in value order."""
    counts = category_counts(df, columns).where(F.col("value").isNotNull())
    ranged = counts.repartitionByRange("column", "value")
    # written before places are given: a piece that is made again could be cut elsewhere
    pieces = materialize(ranged.withColumn("_piece", F.spark_partition_id()), "levels")
    sizes = pieces.groupBy("column", "_piece").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("column").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("column", "_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("column", "_piece").orderBy("value")
    return (
        pieces.withColumn("_nth", F.row_number().over(inside))
        .join(starts, ["column", "_piece"])
        .select("column", "value", "rows", (F.col("_start") + F.col("_nth") - 1).alias("place"))
    )


@dataclass(frozen=True)
class LevelEncoder:
    """Learned levels: the table, the number of levels and the most frequent value of each column."""

    levels: DataFrame
    columns: tuple[str, ...]
    sizes: dict[str, int]
    modes: dict[str, str | None]

    @property
    def widths(self) -> dict[str, int]:
        """Places of a column in the vector; a column of two levels keeps its second one only."""
        return {c: 1 if n == 2 else n for c, n in self.sizes.items()}

    @property
    def size(self) -> int:
        return sum(self.widths.values())

    def _placed(self, df: DataFrame) -> DataFrame:
        """``df`` with a place per column, NULL for a value unknown to the fit."""
        out = df
        for i, c in enumerate(self.columns):
            two = self.sizes[c] == 2
            own = self.levels.where(F.col("column") == c).select(
                F.col("value").alias(f"_value{i}"),
                (F.col("place") - (1 if two else 0)).alias(f"_place{i}"),
                F.col("rows").alias("_rows"),
            )
            filled = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(self.modes[c]))
            out = out.withColumn(f"_filled{i}", filled)
            same = F.col(f"_filled{i}") == F.col(f"_value{i}")
            if self.sizes[c] <= FEW_LEVELS:
                out = out.join(F.broadcast(own.drop("_rows")), same, "left")
                known = F.col(f"_place{i}")
            else:
                common = own.where(F.col("_rows") >= MANY_ROWS).select(
                    F.col(f"_value{i}").alias("_common"), F.col(f"_place{i}").alias("_found")
                )
                rest = own.where(F.col("_rows") < MANY_ROWS).select(
                    f"_value{i}", f"_place{i}", F.lit(0).cast("bigint").alias("_at")
                )
                out = out.join(F.broadcast(common), F.col(f"_filled{i}") == F.col("_common"), "left")
                # rows that found their level, and those without a value, are spread and match nothing
                spread = F.pmod(F.xxhash64(*(F.col(f"`{n}`") for n in df.columns)), F.lit(_SCATTER)) + 1
                waits = F.col("_found").isNull() & F.col(f"_filled{i}").isNotNull()
                out = out.withColumns({
                    f"_filled{i}": F.coalesce(F.col(f"_filled{i}"), F.lit("")),
                    "_to": F.when(waits, F.lit(0)).otherwise(spread).cast("bigint"),
                })
                out = out.join(rest, same & (F.col("_to") == F.col("_at")), "left")
                known = F.coalesce(F.col("_found"), F.col(f"_place{i}"))
            out = out.withColumn(f"_place{i}", F.when(known >= 0, known))
            out = out.drop(f"_filled{i}", f"_value{i}", "_common", "_found", "_to", "_at")
        return out

    def indices(self, df: DataFrame, name: str = "indices") -> DataFrame:
        """Adds the ascending positions of a row's ones in the vector of all columns."""
        start, cells = 0, []
        for i, c in enumerate(self.columns):
            cells.append(F.col(f"_place{i}") + F.lit(start))
            start += self.widths[c]
        found = self._placed(df).withColumn(name, F.array_compact(F.array(*cells)))
        return found.select(*df.columns, name)

    def transform(self, df: DataFrame, name: str = "features") -> DataFrame:
        """Adds the sparse vector: most frequent fill, a place per level, zeros for unknown values."""
        used = [(i, c) for i, c in enumerate(self.columns) if self.widths[c]]
        placed = self._placed(df)
        inputs, outputs = [f"_place{i}" for i, _ in used], [f"_vector{i}" for i, _ in used]
        # a place past the last stands for unknown, which the encoder drops
        placed = placed.withColumns(
            {f"_place{i}": F.coalesce(F.col(f"_place{i}"), F.lit(self.widths[c])).cast("double") for i, c in used}
        )
        encoder = OneHotEncoder(inputCols=inputs, outputCols=outputs, dropLast=True, handleInvalid="keep")
        widest = [tuple(float(self.widths[c] - 1) for _, c in used)]
        fitted = encoder.fit(df.sparkSession.createDataFrame(widest, inputs))
        vectors = VectorAssembler(inputCols=outputs, outputCol=name).transform(fitted.transform(placed))
        return vectors.select(*df.columns, name)

    def save(self, path: str) -> None:
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")
        rows = [(i, c, self.sizes[c], self.modes[c]) for i, c in enumerate(self.columns)]
        spark = self.levels.sparkSession
        spark.createDataFrame(rows, "nth int, column string, size long, mode string").write.mode(
            "overwrite"
        ).parquet(f"{path}/columns")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LevelEncoder:
        rows = spark.read.parquet(f"{path}/columns").orderBy("nth").collect()
        return cls(
            spark.read.schema(LEVEL_SCHEMA).parquet(f"{path}/levels"),
            tuple(r["column"] for r in rows),
            {r["column"]: r["size"] for r in rows},
            {r["column"]: r["mode"] for r in rows},
        )


def fit_levels_table(df: DataFrame, columns: Sequence[str]) -> LevelEncoder:
    """Learns the levels of ``columns``; the driver gets one row per column.

    The most frequent value fills a NULL, the smaller one on a tie. A column without values has no place.
    """
    levels = materialize(level_table(df, columns), "level-table")
    first = F.min_by("value", F.struct((-F.col("rows")).alias("rows"), "value"))
    found = levels.groupBy("column").agg(F.count("*").alias("n"), first.alias("mode")).collect()
    sizes, modes = dict.fromkeys(columns, 0), dict.fromkeys(columns)
    for r in found:
        sizes[r["column"]], modes[r["column"]] = r["n"], r["mode"]
    return LevelEncoder(levels, tuple(columns), sizes, modes)
