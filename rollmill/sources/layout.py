"""Tables grouped by key: which rows lie together, and a stored form that spares the shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmill.plans.scale import attach, hot_hashes
from rollmill.plans.session import shared_dir

#: 0 for the rows of an ordinary group, the number of a slice for those of a hot one.
PART = "group_part"
SLICES = 256


@dataclass(frozen=True)
class Grouped:
    """Rows with their `keys` and PART. All rows of a group that is not hot have PART 0; `hot` tells whether others exist."""

    rows: DataFrame
    keys: tuple[str, ...]
    hot: bool

    def with_facts(self, facts: Mapping[str, Column]) -> DataFrame:
        """The rows with aggregates of their group.

        Ordinary groups are read once, in windows that need no shuffle where the rows already lie by group. The
        slices of hot groups meet in partial aggregates, which come back through a join that AQE can split.
        """
        w = Window.partitionBy(*self.keys, PART) if self.hot else Window.partitionBy(*self.keys)
        found = self.rows.select("*", *[c.over(w).alias(n) for n, c in facts.items()])
        if not self.hot:
            return found.drop(PART)
        whole = self.rows.where(F.col(PART) > 0).groupBy(*self.keys).agg(*[c.alias(f"_w_{n}") for n, c in facts.items()])
        met = attach(found, whole, self.keys)
        picked = {n: F.when(F.col(PART) > 0, F.col(f"_w_{n}")).otherwise(F.col(n)) for n in facts}
        return met.withColumns(picked).drop(PART, *[f"_w_{n}" for n in facts])

    def ends(self, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
        """keys, first, last: structs of `columns` of the first and last row of each group in `order`, which reads `columns` alone.

        Hot groups are reduced slice by slice, and then the ends of their slices.
        """
        if not self.hot:
            return _ends(self.rows, self.keys, order, columns)
        parts = _ends(self.rows, (*self.keys, PART), order, columns)
        return _ends(parts.select(*self.keys, F.inline(F.array("first", "last"))), self.keys, order, columns)


def _ends(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    row = F.struct(*columns)
    w = Window.partitionBy(*keys).orderBy(*order)
    both = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = df.select(*keys, F.row_number().over(w).alias("_at"), F.first(row).over(both).alias("first"), F.last(row).over(both).alias("last"))
    return found.where("_at = 1").drop("_at")


def grouped(df: DataFrame, keys: Sequence[str], by: Sequence[str] = (), hot: Sequence[int] | None = None) -> Grouped:
    """`df` with PART. Groups are hot if their keys `by` (default: all) are among `hot`, the `hot_hashes` of those (default:
    looked for in `df`).

    Slices follow the hash of the whole row, so that a task that runs again deals them alike.
    """
    by = list(by or keys)
    hot = hot_hashes(df, by) if hot is None else list(hot)
    slices = F.lit(1) + F.pmod(F.xxhash64(*df.columns), F.lit(SLICES)).cast("int")
    part = F.when(F.xxhash64(*by).isin(hot), slices).otherwise(F.lit(0)) if hot else F.lit(0)
    return Grouped(df.withColumn(PART, part), tuple(keys), bool(hot))


def store_grouped(groups: Grouped, by: Sequence[str] = (), name: str = "rollouts", buckets: int | None = None) -> Grouped:
    """The same rows written once, bucketed by the keys `by` (default: all) and PART.

    Whoever reads them by group needs no shuffle: neither groupBy nor windows nor joins with a table stored alike.
    A hot group's slices lie in many buckets. The table is registered in the session's catalog, its files lie in the shared folder.
    """
    spark = groups.rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [*(by or groups.keys), *[PART] * groups.hot]
    table = f"{name}_{uuid.uuid4().hex}"
    rows = groups.rows.repartition(buckets, *columns)
    rows.write.option("path", shared_dir(spark, name)).bucketBy(buckets, *columns).saveAsTable(table)
    return Grouped(spark.table(table), groups.keys, groups.hot)
