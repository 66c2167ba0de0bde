"""Bind the order-management tables to the patient-journey roles.

customer -> patient, first order -> diagnosis, supplier -> provider,
lineitem with its order and part -> fill and clinical event, events -> visit.
Every role keeps the natural key of its source as patient_id or provider_id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sojourn.functions.expr import literal_item, literal_map, weighted_bucket
from sojourn.operators.cohort import normalize_patients
from sojourn.operators.eligibility import flag_stage
from sojourn.operators.matching import match_with_fallback
from sojourn.operators.network import academic_flag, organization_number
from sojourn.operators.pathway import first_record
from sojourn.params import Params
from sojourn.plans.publish import Observed
from sojourn.sources.files import spread

#: The scenario as it fits the years these tables cover.
BOUND = Params(
    index_date=dt.date(2000, 1, 1),
    observation_end_date=dt.date(2001, 12, 31),
    minimum_follow_up_days=2400,
)

# ---------------------------------------------------------------------------
# Fixed values of the binding.
# ---------------------------------------------------------------------------
GENDER_OF_SEGMENT = {
    "AUTOMOBILE": "M",
    "BUILDING": "F",
    "FURNITURE": "M",
    "HOUSEHOLD": "male",
    "MACHINERY": "m",
}
STAGE_OF_PRIORITY = {
    "1-URGENT": "metastatic",
    "2-HIGH": "metastatic",
    "3-MEDIUM": "locally_advanced",
    "4-NOT SPECIFIED": "unknown",
    "5-LOW": "localized",
}
RISK_OF_PRIORITY = {
    "1-URGENT": "high",
    "2-HIGH": "high",
    "3-MEDIUM": "intermediate",
    "4-NOT SPECIFIED": "unknown",
    "5-LOW": "low",
}
DRUG_OF_TYPE = {
    "ECONOMY": "ADT",
    "LARGE": "darolutamide",
    "MEDIUM": "enzalutamide",
    "PROMO": "apalutamide",
    "SMALL": "docetaxel",
    "STANDARD": "other_systemic_therapy",
}
VISIT_OF_EVENT = {
    "signup": "urology_follow_up",
    "purchase": "oncology_consultation",
}
ADVERSE_TYPES = ("fatigue", "hypertension", "laboratory_abnormality", "other")
INSURANCE = ("commercial", "medicare", "medicaid", "other")
METASTATIC_SITES = ("bone", "lymph_node", "visceral", "multiple", "unknown")
SOCIOECONOMIC = ("low", "medium", "high")
FIRST_BIRTH = dt.date(1907, 6, 1)
SETTING_SEED, SPECIALTY_SEED = 7, 11
# --------------------------------------------------------------- end of fixed


#: Declared schemas spare a footer-reading job per table.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.select(F.col("n_nationkey").alias("nation"), F.col("r_name").alias("region"))


def raw_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a raw demographics table, header case and bad dates included."""
    customer = read(spark, sf_dir, "customer")
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    born = F.date_add(F.lit(FIRST_BIRTH), F.floor((balance + 1000) * 1.5).cast("int"))
    burden = (
        F.when(balance < 0, F.floor((balance + 1000) / 500))
        .when(balance < 5000, 2 + F.floor(balance / 2500))
        .otherwise(F.least(4 + F.floor((balance - 5000) / 1000), F.lit(8)))
    )
    zip_code = F.concat(
        F.lpad((F.col("c_nationkey")).cast("string"), 2, "0"),
        F.lpad((key % 1000).cast("string"), 3, "0"),
    )
    place = places(spark, sf_dir)
    return customer.join(place, customer["c_nationkey"] == place["nation"], "left").select(
        key.alias("Id"),
        F.when(balance < -990, "unknown").otherwise(born.cast("string")).alias("BIRTHDATE"),
        literal_map(GENDER_OF_SEGMENT, "c_mktsegment").alias("GENDER"),
        F.col("c_mktsegment").alias("RACE"),
        F.col("region").alias("STATE"),
        zip_code.alias("ZIP"),
        literal_item(INSURANCE, "c_nationkey % 5").alias("insurance_type"),
        burden.cast("int").alias("comorbidity_score"),
        (F.floor((balance + 1000) / 11) / 1000.0).alias("frailty_proxy"),
        literal_item(SOCIOECONOMIC, "c_custkey % 3").alias("socioeconomic_proxy"),
        (balance < -500).alias("contraindication_flag"),
        F.col("c_nationkey").alias("nation"),
    )


def patients(spark: SparkSession, sf_dir: str, params: Params = BOUND) -> DataFrame:
    raw = raw_patients(spark, sf_dir)
    return normalize_patients(raw, params, carry=("contraindication_flag", "nation"))


def index_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First order of each customer by date and key."""
    orders = read(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    keep = ("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return first_record(orders, "o_custkey", ("o_orderdate", "o_orderkey"), keep)


def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    record = index_records(spark, sf_dir).select(
        F.concat(F.lit("DX-"), key.cast("string")).alias("diagnosis_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").alias("diagnosis_date"),
        F.lit(True).alias("prostate_cancer_flag"),
        literal_map(STAGE_OF_PRIORITY, "o_orderpriority").alias("prostate_stage"),
        F.date_add("o_orderdate", (key % 61).cast("int")).alias("metastatic_date"),
        literal_item(METASTATIC_SITES, "o_orderkey % 5").alias("_site"),
        F.col("o_orderstatus").isin("F", "P").alias("hormone_sensitive_flag"),
        (price > 450000.5).alias("castration_resistant_flag"),
        literal_map(RISK_OF_PRIORITY, "o_orderpriority").alias("risk_group"),
        (F.floor(price / 100) / 10.0).alias("psa_value"),
        F.when(key % 20 != 0, 6 + key % 5).alias("gleason_score"),
    )
    flagged = flag_stage(record)
    metastatic = F.col("metastatic_flag")
    return flagged.select(
        "diagnosis_id",
        "patient_id",
        "diagnosis_date",
        "prostate_cancer_flag",
        "prostate_stage",
        "localized_flag",
        "locally_advanced_flag",
        "metastatic_flag",
        "metastatic_date",
        F.when(metastatic, F.col("_site")).otherwise("unknown").alias("metastatic_site"),
        "hormone_sensitive_flag",
        "hormone_sensitive_confirmation_date",
        "castration_resistant_flag",
        F.lit(None).cast("date").alias("castration_resistant_date"),
        "risk_group",
        "psa_value",
        "gleason_score",
        "isup_grade_group",
        F.lit("synthetic_enrichment").alias("diagnosis_source"),
        F.lit("pass").alias("data_quality_flag"),
    )


#: Columns in the order of the table.
PROVIDER_COLUMNS = (
    "provider_id", "organization_id", "provider_specialty", "care_setting", "academic_flag", "region",
    "annual_prostate_volume", "multidisciplinary_team_flag", "synthetic_provider_flag",
)


def network(spark: SparkSession, sf_dir: str, params: Params = BOUND) -> DataFrame:
    """Suppliers as providers; ``nation`` is the coarse match cell."""
    key = F.col("s_suppkey")
    setting = weighted_bucket("s_suppkey", SETTING_SEED, params.care_setting_weights)
    return read(spark, sf_dir, "supplier").select(
        key.alias("provider_id"),
        F.concat(F.lit("ORG-"), organization_number(key).cast("string")).alias("organization_id"),
        weighted_bucket("s_suppkey", SPECIALTY_SEED, params.specialty_weights).alias("provider_specialty"),
        setting.alias("care_setting"),
        academic_flag(setting).alias("academic_flag"),
        (30 + key % 420).cast("int").alias("annual_prostate_volume"),
        (F.col("s_acctbal") > 4000).alias("multidisciplinary_team_flag"),
        F.lit(True).alias("synthetic_provider_flag"),
        F.col("s_nationkey").alias("nation"),
    )


def providers(spark: SparkSession, sf_dir: str, params: Params = BOUND) -> DataFrame:
    """The provider table, with its region looked up."""
    return (
        network(spark, sf_dir, params)
        .join(places(spark, sf_dir), "nation", "left")
        .select(*PROVIDER_COLUMNS)
    )


def wanted_settings(spark: SparkSession, sf_dir: str, params: Params = BOUND) -> DataFrame:
    """Each patient's nation and the care setting its hash draws."""
    wanted = weighted_bucket("c_custkey", SETTING_SEED, params.care_setting_weights)
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("patient_id"),
        F.col("c_nationkey").alias("nation"),
        wanted.alias("care_setting"),
    )


def assignments(spark: SparkSession, sf_dir: str, params: Params = BOUND) -> DataFrame:
    """Each patient's matched provider with the attributes the journey and encounters use."""
    return match_with_fallback(
        wanted_settings(spark, sf_dir, params), network(spark, sf_dir, params),
        "nation", "care_setting", "patient_id", "provider_id", params.random_seed,
        carry=("organization_id", "provider_specialty", "care_setting", "multidisciplinary_team_flag"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").filter(F.col("event_type").isin(*VISIT_OF_EVENT)).select(
        F.col("user_id").alias("patient_id"),
        literal_map(VISIT_OF_EVENT, "event_type").alias("event_type"),
        F.col("ts").cast("date").alias("event_date"),
    )


def order_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("patient_id")
    )


#: More lines than any order has, so that line numbers of two orders never meet in ``fill_seq``.
LINES_OF_ORDER = 2**20


def fills(spark: SparkSession, sf_dir: str, params: Params = BOUND) -> DataFrame:
    """Line items as fills; order and line number order the fills of a day."""
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    line = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
    )
    dealt = spread(line.join(part, "l_partkey"), "l_orderkey")
    joined = dealt.join(order_subjects(spark, sf_dir), "l_orderkey")
    return joined.select(
        "patient_id",
        F.col("l_shipdate").cast("date").alias("fill_date"),
        (F.col("l_orderkey") * LINES_OF_ORDER + F.col("l_linenumber")).alias("fill_seq"),
        literal_map(DRUG_OF_TYPE, "p_type").alias("drug_name"),
        F.col("l_suppkey").alias("provider_id"),
        F.lit(params.days_supply).alias("days_supply"),
    )


def clinical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a marked discount or tax as clinical events.

    The marks are tested on the scan, so few rows reach the join. Thresholds
    lie half a step below the values they select.
    """
    flag, discount, tax = F.col("l_returnflag"), F.col("l_discount"), F.col("l_tax")
    high_discount, high_tax = discount > 0.095, tax > 0.075
    kinds = F.array(
        F.when((flag == "R") & high_discount, "progression"),
        F.when((flag == "R") & high_discount & (F.col("l_quantity") > 25.5), "castration_resistant"),
        F.when((flag == "N") & high_discount & high_tax, "hospitalisation"),
        F.when((flag == "R") & high_tax, "adverse_event"),
        F.when((flag == "A") & high_discount & high_tax, "death"),
    )
    marked = (
        read(spark, sf_dir, "lineitem")
        .filter(high_discount | high_tax)
        .withColumn("kinds", F.array_compact(kinds))
        .filter(F.size("kinds") > 0)
        .select("l_orderkey", "l_shipdate", "l_linenumber", "kinds")
    )
    return marked.join(order_subjects(spark, sf_dir), "l_orderkey").select(
        "patient_id",
        F.explode("kinds").alias("event_type"),
        F.col("l_shipdate").cast("date").alias("event_date"),
        literal_item(ADVERSE_TYPES, "l_linenumber % 4").alias("event_detail"),
    )


def observed(spark: SparkSession, sf_dir: str, params: Params = BOUND) -> Observed:
    return Observed(
        patient=patients(spark, sf_dir, params).drop("nation"),
        diagnosis=diagnoses(spark, sf_dir),
        provider=providers(spark, sf_dir, params),
        assignment=assignments(spark, sf_dir, params),
        visits=visits(spark, sf_dir),
        clinical=clinical_events(spark, sf_dir),
        fills=fills(spark, sf_dir, params),
    )
