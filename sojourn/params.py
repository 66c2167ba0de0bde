"""Scenario parameters and the fixed values every module shares."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Category names, drug classes, weights and thresholds that have
# to equal the published data contract.
# ---------------------------------------------------------------------------
TABLES = (
    "patient",
    "diagnosis",
    "provider",
    "encounter",
    "treatment",
    "outcome",
    "patient_journey",
)

DRUG_CLASS = {
    "ADT": "ADT",
    "darolutamide": "ARPI",
    "enzalutamide": "ARPI",
    "apalutamide": "ARPI",
    "abiraterone": "ARPI",
    "docetaxel": "chemotherapy",
    "other_systemic_therapy": "other",
}

CARE_SETTING_WEIGHTS = {
    "community_urology": 0.36,
    "community_oncology": 0.24,
    "academic_oncology": 0.25,
    "mixed_pathway": 0.15,
}

SPECIALTY_WEIGHTS = {
    "urology": 0.34,
    "medical_oncology": 0.38,
    "radiation_oncology": 0.12,
    "primary_care": 0.10,
    "other": 0.06,
}

STAGES = ("localized", "locally_advanced", "metastatic", "unknown")

OUTCOME_STATUSES = (
    "deceased",
    "lost_to_follow_up",
    "progressed",
    "restarted",
    "switched",
    "discontinued",
    "active_treatment",
    "censored",
)

EXPECTED_CATEGORIES = {
    "prostate_stage": STAGES,
    "initial_care_setting": tuple(CARE_SETTING_WEIGHTS),
    "initial_provider_specialty": tuple(SPECIALTY_WEIGHTS),
    "initial_treatment": tuple(DRUG_CLASS),
    "final_outcome_status": OUTCOME_STATUSES,
}
# --------------------------------------------------------------- end of fixed


@dataclass(frozen=True)
class Params:
    """One scenario. Defaults are the published demo scenario."""

    random_seed: int = 42
    target_cohort_size: int = 10_000
    minimum_age: int = 50
    maximum_age: int = 90
    scenario_version: str = "demo-v1.0"
    index_date: dt.date = dt.date(2022, 1, 1)
    observation_end_date: dt.date = dt.date(2025, 12, 31)
    minimum_follow_up_days: int = 90
    eligibility_rule_version: str = "DEMO-ARPI-v1"
    allowable_gap_days: int = 60
    switch_window_days: int = 90
    days_supply: int = 30
    loss_to_follow_up_days: int = 180
    initiation_windows: tuple[int, ...] = (30, 60, 90)
    persistence_landmarks: tuple[tuple[int, int], ...] = ((3, 90), (6, 180), (12, 365))
    persistence_sensitivity_gaps: tuple[int, ...] = (30, 60, 90)
    missingness_warning_share: float = 0.5
    data_label: str = "SYNTHETIC DEMO DATA"
    care_setting_weights: dict[str, float] = field(
        default_factory=lambda: dict(CARE_SETTING_WEIGHTS)
    )
    specialty_weights: dict[str, float] = field(
        default_factory=lambda: dict(SPECIALTY_WEIGHTS)
    )

    def __post_init__(self) -> None:
        if self.target_cohort_size <= 0:
            raise ValueError("target_cohort_size must be positive")
        if self.minimum_age > self.maximum_age:
            raise ValueError("minimum_age exceeds maximum_age")
        if self.days_supply <= 0:
            raise ValueError("days_supply must be positive")
