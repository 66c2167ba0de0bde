"""Served views, KPIs, segment counts, missingness and fingerprints over the journey."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.functions.expr import age_band, burden_band, hex_to_long, truth
from sojourn.params import Params


def eligible_population(journey: DataFrame) -> DataFrame:
    return journey.filter("eligible_for_arpi")


def eligible_not_initiated(journey: DataFrame) -> DataFrame:
    return journey.filter("eligible_not_initiated_90d")


def treatment_initiation(journey: DataFrame) -> DataFrame:
    return journey.filter("treatment_initiated")


def persistence(journey: DataFrame) -> DataFrame:
    return journey.filter("treatment_initiated").select(
        "patient_id", "persistent_3m", "persistent_6m", "persistent_12m"
    )


def switches(journey: DataFrame) -> DataFrame:
    return journey.filter("switch_flag")


def referral_delays(journey: DataFrame) -> DataFrame:
    return journey.select("patient_id", "initial_care_setting", "referral_delay_days")


def final_outcomes(journey: DataFrame) -> DataFrame:
    return journey.select(
        "patient_id", "final_outcome_status", "death_flag", "lost_to_follow_up_flag"
    )


def treatment_gap_by_segment(journey: DataFrame) -> DataFrame:
    """Eligible, initiated and gap counts by setting, specialty, region, age and burden."""
    return journey.groupBy(
        F.col("initial_care_setting").alias("care_setting"),
        F.col("initial_provider_specialty").alias("provider_specialty"),
        "region",
        age_band(F.col("age_at_index")).alias("age_group"),
        burden_band(F.col("comorbidity_score")).alias("comorbidity_group"),
    ).agg(
        F.count_if("eligible_for_arpi").alias("eligible"),
        F.count_if("initiated_within_90d").alias("initiated_90d"),
        F.count_if("eligible_not_initiated_90d").alias("treatment_gap"),
    )


#: Names of the served views.
VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "vw_eligible_population": eligible_population,
    "vw_eligible_not_initiated": eligible_not_initiated,
    "vw_treatment_initiation": treatment_initiation,
    "vw_persistence": persistence,
    "vw_switches": switches,
    "vw_referral_delays": referral_delays,
    "vw_final_outcomes": final_outcomes,
    "vw_treatment_gap_by_segment": treatment_gap_by_segment,
}

SEGMENT_KEYS = ("care_setting", "provider_specialty", "region", "age_group", "comorbidity_group")


def register_tables(tables: Mapping[str, DataFrame]) -> None:
    """Make every table, and the eight views, available to SQL in the session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(tables["patient_journey"]).createOrReplaceTempView(name)


def top_segments(segments: DataFrame, limit: int = 20) -> DataFrame:
    """Segments with the largest gap; the keys make the order total."""
    return segments.orderBy(F.desc("treatment_gap"), *SEGMENT_KEYS).limit(limit)


def kpis(journey: DataFrame, params: Params) -> DataFrame:
    """Headline counts from one aggregate, one row per KPI."""
    # KPI names and the columns they count.
    flags = {
        "mhspc": "mhspc_flag",
        "eligible": "eligible_for_arpi",
        "initiated": "treatment_initiated",
        "initiated_30d": "initiated_within_30d",
        "initiated_60d": "initiated_within_60d",
        "initiated_90d": "initiated_within_90d",
        "treatment_gap_90d": "eligible_not_initiated_90d",
        "persistent_3m": "persistent_3m",
        "persistent_6m": "persistent_6m",
        "persistent_12m": "persistent_12m",
        "discontinuations": "discontinuation_flag",
        "switches": "switch_flag",
        "restarts": "restart_flag",
        "progressions": "progression_event",
        "deaths": "death_flag",
        "lost_to_follow_up": "lost_to_follow_up_flag",
    }
    rows = F.count(F.lit(1))
    counts = journey.agg(
        rows.alias("total_patients"),
        rows.alias("prostate_cancer"),
        *[F.count_if(column).alias(name) for name, column in flags.items()],
    )
    return counts.unpivot([], counts.columns, "kpi", "value").withColumn(
        "data_label", F.lit(params.data_label)
    )


def value_counts(
    journey: DataFrame,
    columns: Sequence[str] = ("initial_care_setting", "initial_provider_specialty", "initial_treatment"),
    missing: str = "not_initiated",
) -> DataFrame:
    """Counts per value of several columns in one pass, largest first within a column."""
    filled = journey.select(*[F.coalesce(F.col(c), F.lit(missing)).alias(c) for c in columns])
    long = filled.unpivot([], list(columns), "column_name", "value")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("column_name", F.desc("n"), "value")


def missingness(df: DataFrame) -> DataFrame:
    """Null count of every column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], counts.columns, "column_name", "missing")


def exact_text(df: DataFrame, column: str) -> Column:
    """Text that two values share only if they are equal. Doubles go by their decimal digits where 18 decimals hold them, else by their plain text."""
    text, kind = F.col(column).cast("string"), dict(df.dtypes)[column]
    if kind in ("double", "float"):
        digits = text.try_cast("decimal(38,18)")
        return F.when(digits.cast(kind) == F.col(column), digits.cast("string")).otherwise(text)
    return text


def row_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """Text of a row for hashing: each value with its length before it, a missing one told apart."""
    parts = []
    for column in columns:
        text = exact_text(df, column)
        sized = F.concat(F.lit("v"), F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("n")))
    return F.concat(*parts)


FINGERPRINT_MODULUS = 2**61 - 1
#: Key ranges of a table's digest tree: the first two hex digits of a row key's hash.
RANGE_DIGITS = 2


def _summed(value: Column) -> Column:
    """Sum modulo a fixed prime, 0 of nothing. Sums of sums are the sum of all, so ranges roll up to the table."""
    zero = F.lit(0).cast("decimal(38,0)")
    total = F.coalesce(F.sum(value), zero)
    return F.pmod(total, F.lit(FINGERPRINT_MODULUS).cast("decimal(38,0)")).cast("bigint")


#: First hex digit of each half of a digest.
HALVES = {"fingerprint": 1, "fingerprint_low": 17}
#: A half in pieces that sum up as whole numbers, for 2**39 rows at least: first digit, digits, bits below.
PIECES = ((0, 6, 40), (6, 5, 20), (11, 5, 0))


def _digest_sums(df: DataFrame, columns: Sequence[str], by: Mapping[str, Column]) -> DataFrame:
    """Row count and both halves of the rows' digests, summed modulo a fixed prime, of all rows or by key.

    Each digest is made once, and its pieces are summed as whole numbers; only the sums are decimals.
    """
    hashed = df.select(*[key.alias(name) for name, key in by.items()], F.md5(row_text(df, columns)).alias("_digest"))
    parts = {
        f"_{name}_{below}": F.sum(F.conv(F.substring("_digest", start + first, digits), 16, 10).cast("bigint"))
        for name, start in HALVES.items() for first, digits, below in PIECES
    }
    sums = hashed.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *[part.alias(name) for name, part in parts.items()])

    def whole(name: str) -> Column:
        terms = [
            F.coalesce(F.col(f"_{name}_{below}"), F.lit(0)).cast("decimal(19,0)") * F.lit(2**below).cast("decimal(13,0)")
            for _, _, below in PIECES
        ]
        return F.pmod(terms[0] + terms[1] + terms[2], F.lit(FINGERPRINT_MODULUS).cast("decimal(38,0)")).cast("bigint")

    return sums.select(*by, "n_rows", *[whole(name).alias(name) for name in HALVES])


def table_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and content hash of all columns, or those named, whatever the order of rows, files and partitions.

    Both halves of each row's digest are summed, each into a number of its own.
    """
    return _digest_sums(df, columns or df.columns, {})


def range_fingerprints(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The leaves of a table's digest tree: key_range, row count and content hash of the rows in it.

    Rows are dealt to 256 ranges by the hash of their key, a missing one as the empty text, and summed map-side.
    """
    spread = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, RANGE_DIGITS)
    return _digest_sums(df, columns or df.columns, {"key_range": spread})


def roll_up(leaves: DataFrame, *by: str) -> DataFrame:
    """Row counts and fingerprints of ranges added up: the root of a digest tree, equal to the fingerprint of its table."""
    names = ("fingerprint", "fingerprint_low")
    return leaves.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), *[_summed(F.col(name).cast("decimal(20,0)")).alias(name) for name in names]
    )


def changed_ranges(old: DataFrame, new: DataFrame) -> DataFrame:
    """Ranges in which two sets of leaves differ, with the rows each has there; a range that one lacks has none."""
    def side(leaves: DataFrame, suffix: str) -> DataFrame:
        return leaves.select(
            "table_name", "key_range", F.col("n_rows").alias(f"rows_{suffix}"),
            F.struct("n_rows", "fingerprint", "fingerprint_low").alias(f"print_{suffix}"),
        )

    both = side(old, "before").join(side(new, "after"), ["table_name", "key_range"], "full")
    differ = ~F.col("print_before").eqNullSafe(F.col("print_after"))
    rows = {name: F.coalesce(F.col(name), F.lit(0)) for name in ("rows_before", "rows_after")}
    return both.filter(differ).withColumns(rows).select("table_name", "key_range", *rows)


def share_missing(df: DataFrame, limit: float) -> Column:
    """Number of columns whose null share exceeds a limit, as an aggregate."""
    rows = F.count(F.lit(1))
    over = [truth(F.count_if(F.col(c).isNull()) > rows * limit).cast("bigint") for c in df.columns]
    total = over[0]
    for column in over[1:]:
        total = total + column
    return total
