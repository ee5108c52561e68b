"""What the engine computes, as data: columns, flags, sentinels, segments.

The operators take these specs as arguments, so they run on any pair of "one row
per entity" and "many history rows per entity" tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}

# --------------------------------------------------------------------------
# Fixed values. Raw column, type at the CSV boundary, silver name.
# --------------------------------------------------------------------------

APPLICATION_COLUMNS = """
SK_ID_CURR                   long    application_id
TARGET                       int     target
NAME_CONTRACT_TYPE           string  contract_type
CODE_GENDER                  string  gender
FLAG_OWN_CAR                 string  owns_car
FLAG_OWN_REALTY              string  owns_realty
CNT_CHILDREN                 int     num_children
AMT_INCOME_TOTAL             double  total_income
AMT_CREDIT                   double  credit_amount
AMT_ANNUITY                  double  annuity_amount
AMT_GOODS_PRICE              double  goods_price
NAME_TYPE_SUITE              string  accompanied_by
NAME_INCOME_TYPE             string  income_type
NAME_EDUCATION_TYPE          string  education_type
NAME_FAMILY_STATUS           string  family_status
NAME_HOUSING_TYPE            string  housing_type
REGION_POPULATION_RELATIVE   double  region_population_density
DAYS_BIRTH                   int     days_birth
DAYS_EMPLOYED                int     days_employed
DAYS_REGISTRATION            double  days_registration
DAYS_ID_PUBLISH              int     days_id_publish
OWN_CAR_AGE                  double  car_age_years
FLAG_MOBIL                   int     has_mobile_phone
FLAG_EMP_PHONE               int     has_work_phone
FLAG_WORK_PHONE              int     has_home_phone
FLAG_CONT_MOBILE             int     mobile_phone_reachable
FLAG_PHONE                   int     has_second_home_phone
FLAG_EMAIL                   int     has_email
OCCUPATION_TYPE              string  occupation_type
CNT_FAM_MEMBERS              double  family_members_count
REGION_RATING_CLIENT         int     region_rating
REGION_RATING_CLIENT_W_CITY  int     region_rating_with_city
WEEKDAY_APPR_PROCESS_START   string  application_weekday
HOUR_APPR_PROCESS_START      int     application_hour
REG_REGION_NOT_LIVE_REGION   int     region_mismatch_permanent_vs_contact
REG_REGION_NOT_WORK_REGION   int     region_mismatch_permanent_vs_work
LIVE_REGION_NOT_WORK_REGION  int     region_mismatch_contact_vs_work
REG_CITY_NOT_LIVE_CITY       int     city_mismatch_permanent_vs_contact
REG_CITY_NOT_WORK_CITY       int     city_mismatch_permanent_vs_work
LIVE_CITY_NOT_WORK_CITY      int     city_mismatch_contact_vs_work
ORGANIZATION_TYPE            string  organization_type
EXT_SOURCE_1                 double  external_score_1
EXT_SOURCE_2                 double  external_score_2
EXT_SOURCE_3                 double  external_score_3
FONDKAPREMONT_MODE           string  building_renovation_fund_mode
HOUSETYPE_MODE               string  building_house_type_mode
TOTALAREA_MODE               double  building_total_area_mode
WALLSMATERIAL_MODE           string  building_walls_material_mode
EMERGENCYSTATE_MODE          string  building_emergency_state_mode
OBS_30_CNT_SOCIAL_CIRCLE     double  social_circle_observed_30dpd
DEF_30_CNT_SOCIAL_CIRCLE     double  social_circle_defaulted_30dpd
OBS_60_CNT_SOCIAL_CIRCLE     double  social_circle_observed_60dpd
DEF_60_CNT_SOCIAL_CIRCLE     double  social_circle_defaulted_60dpd
DAYS_LAST_PHONE_CHANGE       double  days_last_phone_change
AMT_REQ_CREDIT_BUREAU_HOUR   double  bureau_inquiries_last_hour
AMT_REQ_CREDIT_BUREAU_DAY    double  bureau_inquiries_last_day
AMT_REQ_CREDIT_BUREAU_WEEK   double  bureau_inquiries_last_week
AMT_REQ_CREDIT_BUREAU_MON    double  bureau_inquiries_last_month
AMT_REQ_CREDIT_BUREAU_QRT    double  bureau_inquiries_last_quarter
AMT_REQ_CREDIT_BUREAU_YEAR   double  bureau_inquiries_last_year
"""

BUREAU_COLUMNS = """
SK_ID_CURR              long    application_id
SK_ID_BUREAU            long    bureau_credit_id
SK_BUREAU_ID            long    bureau_credit_id
CREDIT_ACTIVE           string  credit_status
CREDIT_CURRENCY         string  credit_currency
DAYS_CREDIT             int     days_credit
CREDIT_DAY_OVERDUE      int     days_overdue
DAYS_CREDIT_ENDDATE     double  days_to_credit_end
DAYS_ENDDATE_FACT       double  days_enddate_fact
AMT_CREDIT_MAX_OVERDUE  double  max_overdue_amount
CNT_CREDIT_PROLONG      int     credit_prolongation_count
AMT_CREDIT_SUM          double  credit_amount
AMT_CREDIT_SUM_DEBT     double  credit_debt_amount
AMT_CREDIT_SUM_LIMIT    double  credit_limit_amount
AMT_CREDIT_SUM_OVERDUE  double  credit_overdue_amount
CREDIT_TYPE             string  credit_type
DAYS_CREDIT_UPDATE      int     days_credit_update
AMT_ANNUITY             double  annuity_amount
"""

# Building measurements without a name of their own: stem x suffix, all double.
BUILDING_STEMS = """
APARTMENTS BASEMENTAREA YEARS_BEGINEXPLUATATION YEARS_BUILD COMMONAREA ELEVATORS
ENTRANCES FLOORSMAX FLOORSMIN LANDAREA LIVINGAPARTMENTS LIVINGAREA
NONLIVINGAPARTMENTS NONLIVINGAREA
""".split()
BUILDING_SUFFIXES = ("_AVG", "_MODE", "_MEDI")

DOCUMENT_NUMBERS = range(2, 22)
TEXT_SENTINEL = "XNA"
NO_EMPLOYMENT_DAYS = 365243
DAYS_PER_YEAR = 365.25
LINEAGE_COLUMNS = ("_ingested_at", "_source_file")
SEED = 42
TRAIN_PERCENT = 80

# --------------------------------------------------------------------------


@dataclass(frozen=True)
class NumericSentinel:
    """`column == value` means "missing"; `flag` records where that was the case."""

    column: str
    value: float
    flag: str


@dataclass(frozen=True)
class Derived:
    """`name` is `-source / divisor` (a plain sign flip without a divisor)."""

    name: str
    source: str
    divisor: float | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    types: Mapping[str, T.DataType]
    renames: Mapping[str, str]
    text_sentinel: str = TEXT_SENTINEL
    yes_no_flags: tuple[str, ...] = ()
    zero_one_flags: tuple[str, ...] = ()
    sentinels: tuple[NumericSentinel, ...] = ()
    derived: tuple[Derived, ...] = ()

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.types.items()])


def _columns(text: str) -> tuple[dict[str, T.DataType], dict[str, str]]:
    rows = [line.split() for line in text.strip().splitlines()]
    return {raw: TYPES[kind] for raw, kind, _ in rows}, {raw: new for raw, _, new in rows}


def _application() -> TableSpec:
    types, renames = _columns(APPLICATION_COLUMNS)
    documents = {f"FLAG_DOCUMENT_{i}": f"document_{i}_provided" for i in DOCUMENT_NUMBERS}
    types |= {stem + suffix: TYPES["double"] for suffix in BUILDING_SUFFIXES for stem in BUILDING_STEMS}
    types |= dict.fromkeys(documents, TYPES["int"])
    renames |= documents
    flags = [renames[raw] for raw in types if raw.startswith("FLAG_")]
    yes_no = ("owns_car", "owns_realty")
    return TableSpec(
        name="application_train",
        key="application_id",
        types=types,
        renames=renames,
        yes_no_flags=yes_no,
        zero_one_flags=("target", *(f for f in flags if f not in yes_no)),
        sentinels=(NumericSentinel("days_employed", NO_EMPLOYMENT_DAYS, "is_employment_anomaly"),),
        derived=(
            Derived("age_years", "days_birth", DAYS_PER_YEAR),
            Derived("employment_years", "days_employed", DAYS_PER_YEAR),
            Derived("years_since_registration_change", "days_registration", DAYS_PER_YEAR),
            Derived("years_since_id_change", "days_id_publish", DAYS_PER_YEAR),
            Derived("days_since_phone_change", "days_last_phone_change"),
        ),
    )


def _bureau() -> TableSpec:
    types, renames = _columns(BUREAU_COLUMNS)
    return TableSpec(
        name="bureau",
        key="application_id",
        types=types,
        renames=renames,
        derived=(
            Derived("days_since_credit_started", "days_credit"),
            Derived("days_since_credit_closed", "days_enddate_fact"),
            Derived("days_since_credit_update", "days_credit_update"),
        ),
    )


APPLICATION = _application()
BUREAU = _bureau()


@dataclass(frozen=True)
class Ratio:
    """`numerator / denominator` where the denominator is positive, else null."""

    name: str
    numerator: str
    denominator: str


# --------------------------------------------------------------------------
# Fixed values of the book.
# --------------------------------------------------------------------------

RATIOS = (
    Ratio("debt_to_credit_ratio", "credit_debt_amount", "credit_amount"),
    Ratio("overdue_to_credit_ratio", "credit_overdue_amount", "credit_amount"),
    Ratio("limit_usage_ratio", "credit_debt_amount", "credit_limit_amount"),
)

INDICATORS = tuple(
    """
    days_credit days_overdue days_to_credit_end days_enddate_fact max_overdue_amount
    credit_prolongation_count credit_amount credit_debt_amount credit_limit_amount
    credit_overdue_amount days_credit_update annuity_amount days_since_credit_started
    days_since_credit_closed days_since_credit_update debt_to_credit_ratio
    overdue_to_credit_ratio limit_usage_ratio
    """.split()
)
STATISTICS = ("min", "max", "mean", "sum")
STATUSES = ("Active", "Closed", "Sold", "Bad debt")
TOP_TYPES = 8
OTHER_TYPE = "Other"

# --------------------------------------------------------------------------


@dataclass(frozen=True)
class BookSpec:
    key: str = "application_id"
    prefix: str = "bureau"
    status: str = "credit_status"
    category: str = "credit_type"
    recency: str = "days_since_credit_started"
    indicators: tuple[str, ...] = INDICATORS
    ratios: tuple[Ratio, ...] = RATIOS
    statuses: tuple[str, ...] = STATUSES
    #: feature-name part -> status whose rows the segment holds; None holds every row
    segments: Mapping[str, str | None] = field(
        default_factory=lambda: {"all": None, "active": "Active", "closed": "Closed"}
    )
    #: indicators that are the exact negation of another one: their statistics
    #: follow from the other's and need no aggregation of their own
    mirrors: Mapping[str, str] = field(
        default_factory=lambda: {d.name: d.source for d in BUREAU.derived if d.divisor is None}
    )
    top_n: int = TOP_TYPES
    other: str = OTHER_TYPE
    history_flag: str = "has_bureau_history"


BOOK = BookSpec()


@dataclass(frozen=True)
class ModelParams:
    """Boosted-tree settings; the defaults are those of the two compared models."""

    trees: int = 150
    depth: int = 5
    learning_rate: float = 0.08
    seed: int = SEED


RANKING_PARAMS = {
    "application_only": ModelParams(trees=200, depth=5, learning_rate=0.08),
    "full_abt": ModelParams(trees=100, depth=4, learning_rate=0.1),
}
RANKING_SAMPLE_ROWS = 150_000
