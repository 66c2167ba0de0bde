"""Match each subject to one candidate, falling back to a coarser cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sojourn.functions.expr import hex_to_long, keyed_hash

#: Hex digits of a candidate's hash that deal a cell to groups, which are ranked apart.
GROUP_DIGITS = 3


def _cell(fine: str) -> Column:
    return F.concat(F.lit("="), F.col(fine))


def _both_cells(fine: str, of_fine: Sequence[Column], of_coarse: Sequence[Column], names: Sequence[str]) -> Column:
    """Entries of a candidate, or of a count of candidates: one in the coarse cell and, with a fine value, one in the fine one."""
    entry = lambda cell, values: F.struct(cell.alias("_cell"), *[v.alias(n) for v, n in zip(values, names, strict=True)])
    own = F.when(F.col(fine).isNotNull(), entry(_cell(fine), of_fine))
    return F.explode(F.array_compact(F.array(entry(F.lit("*"), of_coarse), own)))


def cell_offsets(hashed: DataFrame, coarse: str, fine: str) -> DataFrame:
    """One table for both kinds of cells: candidates of a cell before each group of its hash order, and in the whole cell."""
    counts = hashed.groupBy(coarse, fine, "_group").agg(F.count(F.lit(1)).alias("_c"))
    n = F.col("_c")
    entries = counts.select(coarse, "_group", _both_cells(fine, [n], [n], ["_c"]).alias("_e")).select(coarse, "_group", "_e.*")
    groups = entries.groupBy(coarse, "_cell", "_group").agg(F.sum("_c").alias("_c"))
    cell = Window.partitionBy(coarse, "_cell")
    before = cell.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    return groups.select(
        coarse, "_cell", "_group", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"),
        F.sum("_c").over(cell.orderBy("_group").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_n"),
    )


def match_with_fallback(
    subjects: DataFrame, candidates: DataFrame, coarse: str, fine: str,
    subject_key: str, candidate_key: str, seed: int, carry: Sequence[str] = (),
    digits: int = GROUP_DIGITS,
) -> DataFrame:
    """Pick one candidate per subject by hash, from the fine cell or else the coarse one.

    Subjects never meet a whole cell: each draws a position below the cell's
    size and is joined to the one candidate holding it, whose ``carry`` columns
    come along. A subject whose coarse cell is empty gets a null candidate and
    tier. Candidates are read twice: once counted by cell and hash group, once ranked within
    their group, which both kinds of cells share, so a hot coarse cell is dealt to 16**digits tasks.
    ``candidate_key`` must be unique in a coarse cell.
    """
    hashed = candidates.withColumn("_hash", keyed_hash(seed, candidate_key)).withColumn("_group", F.coalesce(hex_to_long(F.col("_hash"), digits), F.lit(0)))
    offsets = cell_offsets(hashed, coarse, fine)
    in_group = Window.partitionBy(coarse, "_group").orderBy("_hash", candidate_key)
    in_fine = Window.partitionBy(coarse, "_group", fine).orderBy("_hash", candidate_key)
    ranked = hashed.withColumns({"_of_coarse": F.row_number().over(in_group), "_of_fine": F.row_number().over(in_fine)})
    entries = ranked.select(
        F.col(coarse).alias("_coarse"), "_group", candidate_key, *carry,
        _both_cells(fine, [F.col("_of_fine")], [F.col("_of_coarse")], ["_rank"]).alias("_e"),
    ).select("_coarse", F.col("_group").alias("_of_group"), candidate_key, *carry, F.col("_e._cell").alias("_of_cell"), "_e._rank")
    same = (F.col("_coarse") == F.col(coarse)) & (F.col("_of_cell") == F.col("_cell")) & (F.col("_of_group") == F.col("_group"))
    slots = entries.join(offsets, same).select(
        coarse, "_cell", (F.col("_before") + F.col("_rank") - 1).alias("_position"), candidate_key, *carry
    )
    # Offsets are asked three times, each time by coarse value and cell, so that all share one exchange.
    sizes = offsets.groupBy(coarse, "_cell").agg(F.max("_n").alias("_n"))
    of_fine = sizes.withColumnsRenamed({"_cell": "_wanted", "_n": "_n_fine"})
    of_coarse = sizes.withColumnsRenamed({"_cell": "_any", "_n": "_n_coarse"})
    any_fine = F.substring(F.concat(F.lit("*"), F.col(coarse).cast("string")), 1, 1)
    draw = hex_to_long(keyed_hash(seed, subject_key), 15)
    drawn = (
        subjects.select(subject_key, coarse, fine, _cell(fine).alias("_wanted"), any_fine.alias("_any"))
        .join(of_fine, [coarse, "_wanted"], "left")
        .join(of_coarse, [coarse, "_any"], "left")
        .withColumn(
            "match_tier",
            F.when(F.col("_n_fine").isNotNull(), "fine").when(F.col("_n_coarse").isNotNull(), "coarse"),
        )
        .withColumn("_cell", F.when(F.col("_n_fine").isNotNull(), F.col("_wanted")).otherwise(F.lit("*")))
        .withColumn("_position", F.try_mod(draw, F.coalesce("_n_fine", "_n_coarse")))
    )
    # The subject's wanted fine value stays apart from the candidate's own.
    wanted = F.col(fine).alias(f"wanted_{fine}")
    return (
        drawn.select(subject_key, coarse, wanted, "match_tier", "_cell", "_position")
        .join(slots, [coarse, "_cell", "_position"], "left")
        .select(subject_key, coarse, f"wanted_{fine}", candidate_key, "match_tier", *carry)
    )
