"""Cross-table data-quality rules as a few aggregates, and the gate over them.

Row rules are measured as soon as a table is written, or later, by one scan of the columns they need. Key rules share one census
per key. Date rules across tables count per day instead of forming row pairs.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.functions.expr import truth
from sojourn.operators.keys import after_terminal, key_census, ordered_pairs
from sojourn.params import EXPECTED_CATEGORIES, Params
from sojourn.plans.serving import share_missing

Tables = Mapping[str, DataFrame]

# ---------------------------------------------------------------------------
# Rule names, severities and details of the published report.
# ---------------------------------------------------------------------------
RULES: dict[str, tuple[str, str]] = {
    "patient_unique": ("critical", "patient_id must be unique"),
    "male_only": ("critical", "prostate cohort contains males only"),
    "birth_before_diagnosis": ("critical", "birth precedes diagnosis"),
    "diagnosis_before_metastatic": ("critical", "diagnosis <= metastatic"),
    "eligibility_before_treatment": ("critical", "eligibility <= start"),
    "treatment_dates": ("critical", "start < end"),
    "death_after_birth": ("critical", "death after birth"),
    "death_censor_alignment": ("critical", "death not after censor"),
    "mhspc_implies_metastatic": ("critical", "mHSPC => metastatic"),
    "mhspc_implies_hormone_sensitive": ("critical", "mHSPC => hormone sensitive"),
    "mhspc_excludes_cr": ("critical", "mHSPC excludes CR at index"),
    "eligibility_implies_mhspc": ("critical", "demo eligibility => mHSPC"),
    "nonnegative_referral_delay_days": ("critical", "referral_delay_days cannot be negative"),
    "nonnegative_days_to_initiation": ("critical", "days_to_initiation cannot be negative"),
    "nonnegative_days_to_discontinuation": ("critical", "days_to_discontinuation cannot be negative"),
    "nonnegative_days_to_switch": ("critical", "days_to_switch cannot be negative"),
    "nonnegative_days_to_progression": ("critical", "days_to_progression cannot be negative"),
    "persistence_requires_followup": ("warning", "12m persistence requires follow-up"),
    "switch_has_date": ("critical", "switch implies date"),
    "restart_has_date": ("critical", "restart implies date"),
    "death_has_date": ("critical", "death implies date"),
    "ltfu_has_last_observed": ("critical", "LTFU implies last observed"),
    "no_switch_after_death": ("critical", "no switch after death"),
    "no_treatment_after_death": ("critical", "no treatment after death"),
    "death_not_nonadherence": ("critical", "death is a separate outcome"),
    "ltfu_not_discontinuation": ("critical", "LTFU is separate"),
    "persistence_requires_initiation": ("critical", "persistence requires initiation"),
    "refill_after_start": ("critical", "refill >= start"),
    "coverage_after_refill": ("critical", "coverage >= refill"),
    "encounter_provider_fk": ("critical", "encounter provider exists"),
    "treatment_provider_fk": ("critical", "prescriber exists"),
    "patient_foreign_keys": ("critical", "all patient foreign keys exist"),
    "diagnosis_patient_coverage": ("critical", "each patient has diagnosis"),
    "outcome_patient_coverage": ("critical", "each patient has outcome"),
}
EXTRA_RULES: dict[str, tuple[str, str]] = {
    "missingness": ("warning", "journey columns whose null share exceeds the limit"),
    "expected_categories": ("warning", "category values outside the published domain"),
    "age_in_configured_range": ("warning", "age at index outside the configured range"),
    "event_after_censor": ("warning", "stop, progression or hospitalisation after censor date"),
}
# --------------------------------------------------------------- end of fixed

NONNEGATIVE = (
    "referral_delay_days",
    "days_to_initiation",
    "days_to_discontinuation",
    "days_to_switch",
    "days_to_progression",
)


def _patient_conditions() -> dict[str, Column]:
    return {"male_only": ~F.col("sex").eqNullSafe("male")}


def _treatment_conditions() -> dict[str, Column]:
    start, refill = F.col("treatment_start_date"), F.col("refill_date")
    reason = F.col("discontinuation_reason")
    return {
        "treatment_dates": start >= F.col("treatment_end_date"),
        "death_not_nonadherence": reason == "death",
        "ltfu_not_discontinuation": reason == "lost_to_follow_up",
        "refill_after_start": refill < start,
        "coverage_after_refill": F.col("covered_until_date") < refill,
    }


def _outcome_conditions() -> dict[str, Column]:
    return {
        "death_has_date": F.col("death_flag") & F.col("death_date").isNull(),
        "ltfu_has_last_observed": F.col("lost_to_follow_up_flag") & F.col("last_observed_date").isNull(),
    }


def _journey_conditions() -> dict[str, Column]:
    c = F.col
    persistent = truth(c("persistent_3m")) | truth(c("persistent_6m")) | truth(c("persistent_12m"))
    return {
        "eligibility_before_treatment": c("eligibility_date") > c("treatment_start_date"),
        "mhspc_implies_metastatic": c("mhspc_flag") & ~c("metastatic_flag"),
        "mhspc_implies_hormone_sensitive": c("mhspc_flag") & ~c("hormone_sensitive_flag"),
        "mhspc_excludes_cr": c("mhspc_flag") & c("castration_resistant_flag"),
        "eligibility_implies_mhspc": c("eligible_for_arpi") & ~c("mhspc_flag"),
        **{f"nonnegative_{name}": c(name) < 0 for name in NONNEGATIVE},
        "persistence_requires_followup": c("persistent_12m") & (c("follow_up_days") < 365),
        "switch_has_date": truth(c("switch_flag")) & c("switch_date").isNull(),
        "restart_has_date": truth(c("restart_flag")) & c("restart_date").isNull(),
        "persistence_requires_initiation": persistent & ~truth(c("treatment_initiated")),
    }


def _patient_key_rules(tables: Tables) -> list[DataFrame]:
    """Uniqueness, orphans, coverage, and patient-weighted row rules from one census.

    Rules stated over patient-joined rows weigh each failing row by the number
    of patient rows sharing its key.
    """
    d, o = tables["diagnosis"], tables["outcome"]
    late = d.filter(F.col("diagnosis_date") > F.col("metastatic_date"))
    misaligned = o.filter(F.col("death_flag") & (F.col("death_date") > F.col("censor_date")))
    children = {
        "d": d, "e": tables["encounter"], "t": tables["treatment"], "o": o, "j": tables["patient_journey"],
    }
    census = key_census(
        {
            "p": (tables["patient"], "patient_id"),
            **{name: (df, "patient_id") for name, df in children.items()},
            "late": (late, "patient_id"),
            "misaligned": (misaligned, "patient_id"),
        }
    )
    p, keyed = F.col("p"), F.col("key").isNotNull()
    child_rows = F.col("d") + F.col("e") + F.col("t") + F.col("o") + F.col("j")
    orphan = ~keyed | (p == 0)
    return [
        census.agg(
            _total(F.when(p > 0, p - 1)).alias("patient_unique"),
            _total(F.when(orphan, child_rows)).alias("patient_foreign_keys"),
            F.count_if((p > 0) & (~keyed | (F.col("d") == 0))).alias("diagnosis_patient_coverage"),
            F.count_if((p > 0) & (~keyed | (F.col("o") == 0))).alias("outcome_patient_coverage"),
            _total(F.when(keyed, p * F.col("late"))).alias("diagnosis_before_metastatic"),
            _total(F.when(keyed, p * F.col("misaligned"))).alias("death_censor_alignment"),
        )
    ]


def _provider_key_rules(tables: Tables) -> list[DataFrame]:
    census = key_census(
        {
            "pr": (tables["provider"], "provider_id"),
            "e": (tables["encounter"], "provider_id"),
            "t": (tables["treatment"], "prescribing_provider_id"),
        }
    )
    orphan = F.col("key").isNull() | (F.col("pr") == 0)
    return [
        census.agg(
            _total(F.when(orphan, F.col("e"))).alias("encounter_provider_fk"),
            _total(F.when(orphan, F.col("t"))).alias("treatment_provider_fk"),
        )
    ]


def _date_rules(tables: Tables) -> list[DataFrame]:
    p, d, o, t = (tables[n] for n in ("patient", "diagnosis", "outcome", "treatment"))
    deaths = o.filter(F.col("death_date").isNotNull())

    def late(date: str, rule: str) -> DataFrame:
        dated = t.filter(F.col(date).isNotNull())
        return after_terminal(dated, date, deaths, "death_date").agg(_total(F.col("n_after")).alias(rule))

    return [
        ordered_pairs(p, "birth_date", d, "diagnosis_date", "patient_id").withColumnRenamed(
            "pairs", "birth_before_diagnosis"
        ),
        ordered_pairs(p, "birth_date", o, "death_date", "patient_id").withColumnRenamed(
            "pairs", "death_after_birth"
        ),
        late("switch_date", "no_switch_after_death"),
        late("treatment_start_date", "no_treatment_after_death"),
    ]


def _extra_measures(j: DataFrame, params: Params) -> dict[str, Column]:
    unexpected = [
        _total((F.col(column).isNotNull() & ~F.col(column).isin(*allowed)).cast("bigint"))
        for column, allowed in EXPECTED_CATEGORIES.items()
    ]
    total = unexpected[0]
    for count in unexpected[1:]:
        total = total + count
    censor = F.col("censor_date")
    late = (
        truth(F.col("discontinuation_date") > censor)
        | truth(F.col("progression_date") > censor)
        | truth(F.col("first_hospitalisation_date") > censor)
    )
    age = F.col("age_at_index")
    return {
        "missingness": share_missing(j, params.missingness_warning_share),
        "expected_categories": total,
        "age_in_configured_range": F.count_if(~age.between(params.minimum_age, params.maximum_age)),
        "event_after_censor": F.count_if(late),
    }


#: Conditions that a row of a table fails by itself.
ROW_RULES = {
    "patient": _patient_conditions,
    "treatment": _treatment_conditions,
    "outcome": _outcome_conditions,
    "patient_journey": _journey_conditions,
}


def row_measures(name: str, df: DataFrame, params: Params | None = None) -> dict[str, Column]:
    """Aggregates that measure the row rules of a table, by rule; none for a table without any.

    They can be taken as soon as the table is written; ``observe`` would interpret them row by row during the write.
    """
    if name not in ROW_RULES:
        return {}
    measures = {rule: F.count_if(condition) for rule, condition in ROW_RULES[name]().items()}
    if name == "patient_journey" and params is not None:
        measures |= _extra_measures(df, params)
    return measures


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


def _as_results(counts: DataFrame) -> DataFrame:
    """Turn a one-row frame of named counts into one result row per rule."""
    known = {**RULES, **EXTRA_RULES}
    rows = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.lit(known[rule][0]).alias("severity"),
            F.when(F.col(rule) == 0, "pass").otherwise("fail").alias("status"),
            F.col(rule).cast("bigint").alias("failure_count"),
            F.lit(known[rule][1]).alias("detail"),
        )
        for rule in counts.columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def validate_tables(
    tables: Tables, params: Params | None = None, only: Collection[str] | None = None,
    measured: Mapping[str, int] | None = None,
) -> DataFrame:
    """Result rows (rule, severity, status, failure_count, detail) for the 34 rules.

    With ``params`` the warnings on missingness, categories, age range and
    events after censoring are added. ``only`` restricts the check to some rules. ``measured`` holds
    failure counts that are known already, such as those taken when a table was written.
    """
    known = dict(measured or {})
    probes = []
    for name in ROW_RULES:
        wanted = {r: m for r, m in row_measures(name, tables[name], params).items() if r not in known}
        if wanted:
            probes.append(tables[name].agg(*[m.alias(r) for r, m in wanted.items()]))
    probes += _patient_key_rules(tables) + _provider_key_rules(tables) + _date_rules(tables)
    if known:
        one = tables["patient"].sparkSession.range(1)
        probes.append(one.select(*[F.lit(int(count)).cast("bigint").alias(rule) for rule, count in known.items()]))
    if only is not None:
        wanted = [[rule for rule in probe.columns if rule in only] for probe in probes]
        probes = [probe.select(*rules) for probe, rules in zip(probes, wanted, strict=True) if rules]
        if not probes:
            raise ValueError(f"no such rules: {sorted(only)}")
    results = _as_results(probes[0])
    for probe in probes[1:]:
        results = results.unionByName(_as_results(probe))
    return results


def gate(results: DataFrame) -> DataFrame:
    """One row: rules checked, failing rules by severity, critical failures, verdict."""
    critical = F.col("severity") == "critical"
    failed = F.col("failure_count") > 0
    failures = F.sum(F.when(critical, F.col("failure_count")).otherwise(0)).cast("bigint")
    return results.agg(
        F.count(F.lit(1)).alias("rules_checked"),
        F.count_if(critical & failed).alias("critical_rules_failed"),
        F.count_if(~critical & failed).alias("warning_rules_failed"),
        failures.alias("critical_failures"),
    ).withColumn(
        "verdict", F.when(F.col("critical_failures") == 0, "publish").otherwise("hold")
    )


class CriticalQualityFailure(ValueError):
    """Raised when a critical rule fails; names the rules."""


def raise_on_critical(results: DataFrame) -> None:
    """Stop on critical failures. Brings back failing rule names only."""
    failed = results.filter((F.col("severity") == "critical") & (F.col("failure_count") > 0))
    names = sorted(row["rule"] for row in failed.select("rule").collect())
    if names:
        raise CriticalQualityFailure("Critical data-quality failures: " + ", ".join(names))
