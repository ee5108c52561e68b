"""The registered queries as SQL for DuckDB, generated from the same specs."""

from __future__ import annotations

import re

from loanloom.catalog import (
    CATEGORY_COLUMNS,
    OFF_EDGE,
    SAMPLE_ROWS,
    SAVED_TYPES,
    SEGMENT_COLUMNS,
    STUMP_FEATURES,
    SUMMARY_COLUMNS,
)
from loanloom.functions.naming import share_name, status_part, type_part
from loanloom.sources.views import RAW_APP, RAW_BUREAU
from loanloom.specs import BOOK, BUREAU

_DAYS = {
    "{%s}" % c: f"CAST(CAST({c} AS DATE) - DATE '1970-01-01' AS INT)" for c in ("o_orderdate", "l_shipdate")
}


def _raw(text: str) -> str:
    for placeholder, days in _DAYS.items():
        text = text.replace(placeholder, days)
    return re.sub(r"\{(\w+)\}", r"\1", text).strip()


def _round(x: str, digits: int = 6) -> str:
    return f"round({x} + CAST({OFF_EDGE!r} AS DOUBLE), {digits})"


def _clean(c: str) -> str:
    return f"CASE WHEN trim({c}) <> 'XNA' THEN {c} END"


_YEARS = """
 -days_birth / CAST(365.25 AS DOUBLE) AS age_years,
 {employed}-days_registration / CAST(365.25 AS DOUBLE) AS years_since_registration_change,
 -days_id_publish / CAST(365.25 AS DOUBLE) AS years_since_id_change,
 -days_last_phone_change AS days_since_phone_change
"""

RENAMED_APP = """
SELECT SK_ID_CURR AS application_id, TARGET AS target, ORGANIZATION_TYPE AS organization_type,
 FLAG_OWN_CAR AS owns_car, FLAG_MOBIL AS has_mobile_phone, FLAG_DOCUMENT_2 AS document_2_provided,
 AMT_INCOME_TOTAL AS total_income, DAYS_BIRTH AS days_birth, DAYS_EMPLOYED AS days_employed,
 DAYS_REGISTRATION AS days_registration, DAYS_ID_PUBLISH AS days_id_publish,
 DAYS_LAST_PHONE_CHANGE AS days_last_phone_change, LIVINGAREA_MEDI AS building_livingarea_medi
FROM raw_app
"""

APP = f"""
SELECT *, {_YEARS.format(employed="-days_employed / CAST(365.25 AS DOUBLE) AS employment_years, ")}
FROM (
 SELECT application_id, target = 1 AS target, {_clean("organization_type")} AS organization_type,
  owns_car = 'Y' AS owns_car, has_mobile_phone = 1 AS has_mobile_phone,
  document_2_provided = 1 AS document_2_provided, total_income, days_birth,
  CASE WHEN days_employed <> 365243 THEN days_employed END AS days_employed,
  days_registration, days_id_publish, days_last_phone_change, building_livingarea_medi,
  days_employed = 365243 AS is_employment_anomaly
 FROM renamed_app)
"""

_BUREAU_NAMES = {r: n for r, n in BUREAU.renames.items() if r != "SK_BUREAU_ID"}
_BUREAU_TEXT = ("CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE")
SILVER_BUREAU = (
    "SELECT "
    + ", ".join(f"{_clean(r) if r in _BUREAU_TEXT else r} AS {n}" for r, n in _BUREAU_NAMES.items())
    + ", -DAYS_CREDIT AS days_since_credit_started, -DAYS_ENDDATE_FACT AS days_since_credit_closed,"
    " -DAYS_CREDIT_UPDATE AS days_since_credit_update FROM raw_bureau"
)

HISTORY = """
SELECT *,
 CASE WHEN credit_amount > 0 THEN credit_debt_amount / credit_amount END AS debt_to_credit_ratio,
 CASE WHEN credit_amount > 0 THEN credit_overdue_amount / credit_amount END AS overdue_to_credit_ratio,
 CASE WHEN credit_limit_amount > 0 THEN credit_debt_amount / credit_limit_amount END AS limit_usage_ratio
FROM bureau
"""


def _statistics(segment: str, filtered: bool) -> list[str]:
    status = BOOK.segments[segment]
    where = f" FILTER (WHERE credit_status = '{status}')" if filtered and status else ""
    columns = []
    for c in BOOK.indicators:
        fraction = c in {r.name for r in BOOK.ratios}
        total = f"sum({c}){where}" if fraction else f"CAST(sum({c}){where} AS BIGINT)"
        mean = f"CAST(sum({c}){where} AS DOUBLE) / nullif(count({c}){where}, 0)"
        if fraction:
            total, mean = _round(total, 8), _round(mean, 8)
        values = {"min": f"min({c}){where}", "max": f"max({c}){where}", "mean": mean, "sum": total}
        columns += [f"{v} AS bureau_{segment}_{c}_{s}" for s, v in values.items()]
    return columns


def _segment(segment: str) -> str:
    status = BOOK.segments[segment]
    where = f" WHERE credit_status = '{status}'" if status else ""
    columns = ", ".join(_statistics(segment, filtered=False))
    return f"SELECT application_id, {columns} FROM history{where} GROUP BY application_id"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_STATUS = {
    f"bureau_status_{status_part(s)}_count": f"count(*) FILTER (WHERE credit_status = {_literal(s)})"
    for s in BOOK.statuses
}
_SAVED = ", ".join(map(_literal, SAVED_TYPES))
_TYPE = {
    f"bureau_type_{type_part(t)}_count": f"count(*) FILTER (WHERE credit_type = {_literal(t)})"
    for t in SAVED_TYPES
} | {"bureau_type_other_count": f"count(*) FILTER (WHERE credit_type NOT IN ({_SAVED}) OR credit_type IS NULL)"}
_META = """count(*) AS bureau_credit_count,
 count(*) FILTER (WHERE credit_status = 'Active') AS bureau_active_count,
 count(*) FILTER (WHERE credit_status = 'Closed') AS bureau_closed_count,
 count(DISTINCT credit_type) AS bureau_distinct_credit_types,
 max(days_since_credit_started) AS bureau_days_since_first_credit,
 min(days_since_credit_started) AS bureau_days_since_last_credit"""


def _named(columns: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in columns.items())


def _per_application(columns: str) -> str:
    return f"SELECT application_id, {columns} FROM history GROUP BY application_id"


_CATEGORIES = _STATUS | _TYPE
_SHARES = {share_name(k): f"({v}) / count(*)" for k, v in _CATEGORIES.items()}
BOOK_SQL = _per_application(
    ", ".join(
        [
            _META,
            *[c for s in BOOK.segments for c in _statistics(s, filtered=True)],
            _named(_CATEGORIES),
            _named(_SHARES),
        ]
    )
)
_BOOK_FEATURES = re.findall(r" AS (bureau_\w+)", BOOK_SQL)
_FILLED = ", ".join(
    f"coalesce({c}, 0) AS {c}" if "_count" in c else c for c in _BOOK_FEATURES
)

TOP = """
SELECT credit_type, n FROM (
 SELECT credit_type, count(*) AS n FROM bureau GROUP BY credit_type
 ORDER BY n DESC, credit_type ASC NULLS FIRST LIMIT 8)
WHERE credit_type IS NOT NULL
"""

SPLIT = """
SELECT application_id, target, total_income,
 CASE WHEN ('0x' || substr(md5('42:' || CAST(application_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 80
  THEN 'train' ELSE 'validation' END AS split
FROM app
"""

TOP_RANKED = "SELECT credit_type, row_number() OVER (ORDER BY n DESC, credit_type) AS r FROM top"
HISTORY_RANKED = """
SELECT history.*, coalesce(r, 0) AS type_rank
FROM history LEFT JOIN top_ranked ON history.credit_type = top_ranked.credit_type
"""
_RANKED = {
    f"bureau_type_rank_{i}_count": f"count(*) FILTER (WHERE type_rank = {i})" for i in range(1, BOOK.top_n + 1)
} | {"bureau_type_other_count": "count(*) FILTER (WHERE type_rank = 0)"}
_RANKED_ALL = _STATUS | _RANKED
_RANKED_SHARES = {k.replace("_count", "_share"): f"({v}) / count(*)" for k, v in _RANKED_ALL.items()}
BOOK_RANKED = (
    "SELECT application_id, "
    + ", ".join(
        [
            _META,
            *[c for s in BOOK.segments for c in _statistics(s, filtered=True)],
            _named(_RANKED_ALL),
            _named(_RANKED_SHARES),
        ]
    )
    + " FROM history_ranked GROUP BY application_id"
)
_RANKED_FILLED = ", ".join(
    f"coalesce({c}, 0) AS {c}" if "_count" in c else c for c in re.findall(r" AS (bureau_\w+)", BOOK_RANKED)
)


def _stump(features: tuple[str, ...], name: str) -> dict[str, str]:
    """Views of the one split of largest gain on the training side, labels as 1 and -1.

    The variance of such labels is 1 less their squared mean. Missing values lie below all
    others; whether a value is missing is a split too, the same one.
    """
    cuts = [(f, f"{f} IS NULL") for f in features] + [(f, f"{f} IS NULL OR NOT {f}") for f in features]
    tried = _union(
        [f"SELECT {i} AS cut, '{f}' AS feature, application_id, split, y, {rule} AS is_left FROM stump_rows" for i, (f, rule) in enumerate(cuts)]
    )
    return {
        f"{name}_cuts": tried,
        f"{name}_sides": f"""SELECT cut, feature, is_left, CAST(count(*) AS DOUBLE) AS n, avg(y) AS m
 FROM {name}_cuts WHERE split = 'train' GROUP BY ALL""",
        f"{name}_best": f"""SELECT cut, feature,
 1 - pow(sum(n * m) / sum(n), 2) - sum(n * (1 - m * m)) / sum(n) AS gain
 FROM {name}_sides GROUP BY cut, feature HAVING count(*) = 2 ORDER BY gain DESC, cut LIMIT 1""",
        f"{name}_scores": f"""SELECT application_id, split, y, 1 / (1 + exp(-2 * m)) AS score
 FROM {name}_cuts JOIN {name}_sides USING (cut, is_left) WHERE cut = (SELECT cut FROM {name}_best)""",
    }


# Every view, in order of definition; a query gets those it needs.
VIEWS = {
    "raw_app": _raw(RAW_APP),
    "raw_bureau": _raw(RAW_BUREAU),
    "renamed_app": RENAMED_APP,
    "app": APP,
    "bureau": SILVER_BUREAU,
    "history": HISTORY,
    "meta": _per_application(_META),
    "book": BOOK_SQL,
    "top": TOP,
    "top_ranked": TOP_RANKED,
    "history_ranked": HISTORY_RANKED,
    "book_ranked": BOOK_RANKED,
    "sides": SPLIT,
}


STUMP_ROWS = """
SELECT application_id, split, owns_car, has_mobile_phone, document_2_provided, CASE WHEN target THEN 1 ELSE -1 END AS y
FROM sides JOIN app USING (application_id, target, total_income)
"""


def _with_views(sql: str) -> str:
    needed: list[str] = []
    text = sql
    for name in reversed(VIEWS):
        if re.search(rf"\b{name}\b", text):
            needed.insert(0, name)
            text += VIEWS[name]
    views = ", ".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed)
    return f"WITH {views} {sql.strip()}" if views else sql.strip()


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


VIEWS |= {"stump_rows": STUMP_ROWS} | _stump(STUMP_FEATURES[2:], "small") | _stump(STUMP_FEATURES, "full")


def _missing(column: str, extra: str = "") -> str:
    return f"""SELECT '{column}' AS column_name, count(*) - count({column}) AS n_missing,
     (count(*) - count({column})) / count(*) AS missing_share,
     count({column}) = count(*) AS is_complete,
     count({column}) = 0 AND count(*) > 0 AS is_all_null FROM app"""


_APP_COLUMNS = """
application_id target organization_type owns_car has_mobile_phone document_2_provided total_income
days_birth days_employed days_registration days_id_publish days_last_phone_change
building_livingarea_medi is_employment_anomaly age_years employment_years
years_since_registration_change years_since_id_change days_since_phone_change
""".split()
_APP_FLAGS = "target owns_car has_mobile_phone document_2_provided is_employment_anomaly".split()
_APP_NUMBERS = [
    c for c in _APP_COLUMNS if c not in {*_APP_FLAGS, "application_id", "organization_type"}
]
_MISSING = _union([_missing(c) for c in _APP_COLUMNS])


def _auc(rows: str, by: str = "") -> str:
    """`rows` selects s (score), y (0/1) and the grouping column."""
    part = f"PARTITION BY {by} " if by else ""
    group = f"GROUP BY {by}" if by else ""
    head = f"{by}, " if by else ""
    return f"""
SELECT {head}CAST(sum(p) AS BIGINT) AS n_positive, CAST(sum(n) AS BIGINT) AS n_negative,
 sum(p * (below + n / 2)) / nullif(CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE), 0) AS auc
FROM (SELECT *, CAST(sum(n) OVER ({part}ORDER BY s) - n AS DOUBLE) AS below
 FROM (SELECT {head}s, CAST(sum(y) AS DOUBLE) AS p, CAST(sum(1 - y) AS DOUBLE) AS n
  FROM ({rows}) GROUP BY {head}s)) {group}
"""


_INCOME_SCORE = "SELECT total_income AS s, CAST(target AS INT) AS y{extra} FROM {table}".format

_CURVE = f"""
SELECT CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
UNION ALL
SELECT fp / nn AS fpr, tp / np AS tpr FROM (
 SELECT *, sum(n) OVER (ORDER BY s DESC) AS fp, sum(p) OVER (ORDER BY s DESC) AS tp,
  sum(n) OVER () AS nn, sum(p) OVER () AS np,
  lag(s) OVER (ORDER BY s DESC) IS NULL OR lead(s) OVER (ORDER BY s DESC) IS NULL
   OR lead(n) OVER (ORDER BY s DESC) <> n OR lead(p) OVER (ORDER BY s DESC) <> p AS kept
 FROM (SELECT s, CAST(sum(y) AS DOUBLE) AS p, CAST(sum(1 - y) AS DOUBLE) AS n
  FROM ({_INCOME_SCORE(extra="", table="app")}) GROUP BY s)) WHERE kept
"""

_DIGEST = "md5('42:' || CAST(application_id AS VARCHAR))"



def _first_per_class(columns: str, n: str, select: str) -> str:
    """Rows with their place in their class and the quota of the class out of n rows."""
    return f"""
SELECT {select}
FROM (SELECT {columns}, row_number() OVER (PARTITION BY target ORDER BY {_DIGEST}) AS place FROM app)
JOIN (
 SELECT target, floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, CAST(target AS VARCHAR))
  <= n - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS quota
 FROM (SELECT target, n, n * k / total AS x FROM (
  SELECT target, count(*) AS k, sum(count(*)) OVER () AS total, {n} AS n
  FROM app GROUP BY target))) USING (target)
"""


_EXACT_SPLIT = _first_per_class(
    "application_id, target",
    "sum(count(*)) OVER () - ceil(sum(count(*)) OVER () * 20 / 100)",
    "application_id, target, CASE WHEN place <= quota THEN 'train' ELSE 'validation' END AS split",
)
_STRATIFIED_SAMPLE = (
    _first_per_class(
        "application_id, target, total_income", str(SAMPLE_ROWS), "application_id, target, total_income"
    )
    + " WHERE place <= quota"
)


def _category(column: str) -> str:
    return f"""SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS {column}_index
 FROM bureau WHERE {column} IS NOT NULL GROUP BY {column}"""


_CATEGORY_INDEX = (
    "SELECT application_id, bureau_credit_id, "
    + ", ".join(
        f"CAST(coalesce({c}_index, (SELECT count(DISTINCT {c}) FROM bureau)) AS DOUBLE) AS {c}_index"
        for c in CATEGORY_COLUMNS
    )
    + " FROM bureau "
    + " ".join(f"LEFT JOIN ({_category(c)}) USING ({c})" for c in CATEGORY_COLUMNS)
)


_FLOATS = ", ".join(
    f"CAST({c} AS FLOAT) AS {c}"
    for c in _APP_COLUMNS
    if c in ("total_income", "building_livingarea_medi") or "years" in c
)
_FRACTIONS = ("_mean", "_share")


def _narrowed(c: str) -> str:
    value = f"coalesce({c}, 0)" if "_count" in c else c
    is_fraction = c.endswith(_FRACTIONS) or any(r.name in c for r in BOOK.ratios)
    return f"CAST({value} AS FLOAT) AS {c}" if is_fraction else f"{value} AS {c}"


_RANKED_NARROW = ", ".join(map(_narrowed, re.findall(r" AS (bureau_\w+)", BOOK_RANKED)))
_COUNTS = re.findall(r" AS (bureau_\w+(?:_count|_types))", _META)
_BYTES = ", ".join(
    f"CAST({f'coalesce({c}, 0)' if '_count' in c else c} AS TINYINT) AS {c}" for c in _COUNTS
)


def _bronze(view: str, name: str, doubles: tuple[str, ...], more: str = "") -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({casts}), {more} '{name}.csv' AS _source_file FROM {view}"


def _rate(segment: str) -> str:
    return f"""SELECT '{segment}' AS segment, CAST({segment} AS VARCHAR) AS value, count(*) AS n,
 count(*) FILTER (WHERE target) AS n_positive, count(*) FILTER (WHERE target) / count(target) AS positive_rate,
 count(*) < 100 AS is_small FROM app GROUP BY {segment}"""


def _sentinel(table: str, view: str, column: str, hit: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
 count(*) FILTER (WHERE {hit}) AS n_sentinel, count(*) FILTER (WHERE {hit}) / count(*) AS sentinel_share
 FROM {view}"""


def _model(name: str, view: str, n_features: int) -> str:
    aucs = _auc(f"SELECT split, score AS s, (y + 1) // 2 AS y FROM {view}_scores", "split")

    def of(side: str, value: str) -> str:
        return f"max(CASE WHEN split = '{side}' THEN {value} END)"

    rows = "n_positive + n_negative"
    return f"""SELECT '{name}' AS model, {of("train", "auc")} AS auc_train, {of("validation", "auc")} AS auc_val,
 CAST({n_features} AS INT) AS n_features, {of("train", rows)} AS n_train, {of("validation", rows)} AS n_val
 FROM ({aucs})"""


_MODELS = f"""SELECT * FROM ({_model("baseline", "small", 1)}) UNION ALL SELECT * FROM ({_model("challenger", "full", 3)})"""
STUMP_METRICS = f"""
SELECT model, {_round("auc_train", 9)} AS auc_train, {_round("auc_val", 9)} AS auc_val, n_features, n_train, n_val,
 {_round("auc_val - max(CASE WHEN model = 'baseline' THEN auc_val END) OVER ()", 9)} AS auc_gain,
 CAST(1 AS INT) AS trees, CAST(1 AS INT) AS depth, CAST(0.08 AS DOUBLE) AS learning_rate, CAST(42 AS INT) AS seed
FROM ({_MODELS})
"""

ORACLES = {
    "bronze_csv_ingest": _bronze(
        "raw_app", "application_train", ("DAYS_REGISTRATION", "DAYS_LAST_PHONE_CHANGE")
    ),
    "bronze_csv_ingest_bureau": _bronze(
        "raw_bureau",
        "bureau",
        (
            "DAYS_CREDIT_ENDDATE",
            "DAYS_ENDDATE_FACT",
            "AMT_CREDIT_MAX_OVERDUE",
            "AMT_CREDIT_SUM",
            "AMT_CREDIT_SUM_DEBT",
            "AMT_CREDIT_SUM_LIMIT",
            "AMT_CREDIT_SUM_OVERDUE",
            "AMT_ANNUITY",
        ),
    ),
    "bronze_unknown_columns": _bronze(
        "raw_app",
        "application_train",
        ("DAYS_REGISTRATION", "DAYS_LAST_PHONE_CHANGE"),
        """CAST(SK_ID_CURR % 7 AS INT) AS NEW_COUNT, SK_ID_CURR / CAST(2 AS DOUBLE) + CAST(0.25 AS DOUBLE) AS NEW_RATE,
 't' || CAST(SK_ID_CURR AS VARCHAR) AS NEW_TEXT,""",
    ),
    "table_audit": _union(
        [
            f"""SELECT '{name}' AS table_name, count(*) AS n_rows, CAST({width} AS INT) AS n_columns,
             count(*) FILTER (WHERE SK_ID_CURR IS NULL) AS n_null_keys FROM {view}"""
            for name, view, width in (("application_train", "raw_app", 15), ("bureau", "raw_bureau", 19))
        ]
    ),
    "silver_rename": "SELECT * FROM renamed_app",
    "clean_sentinel_strings": "SELECT SK_ID_BUREAU, "
    + ", ".join(f"{_clean(c)} AS {c}" for c in _BUREAU_TEXT)
    + " FROM raw_bureau",
    "to_bool_flags": """SELECT application_id, target = 1 AS target, owns_car = 'Y' AS owns_car,
 has_mobile_phone = 1 AS has_mobile_phone, document_2_provided = 1 AS document_2_provided FROM renamed_app""",
    "sentinel_flag": """SELECT application_id, days_employed = 365243 AS is_employment_anomaly,
 CASE WHEN days_employed <> 365243 THEN days_employed END AS days_employed FROM renamed_app""",
    "days_to_years": f"""SELECT application_id, days_birth, days_registration, days_id_publish,
 days_last_phone_change, {_YEARS.format(employed="")} FROM renamed_app""",
    "silver_application": "SELECT * FROM app",
    "silver_bureau": "SELECT * FROM bureau",
    "ratio_columns": "SELECT bureau_credit_id, "
    + ", ".join(r.name for r in BOOK.ratios)
    + " FROM history",
    "segment_all": _segment("all"),
    "segment_active": _segment("active"),
    "segment_closed": _segment("closed"),
    "bureau_meta": _per_application(_META),
    "top_types": "SELECT * FROM top",
    "status_counts": _per_application(_named(_STATUS)),
    "type_bucket_counts": _per_application(_named(_TYPE)),
    "type_bucket_profile": """SELECT application_id,
 CASE WHEN credit_type IN (SELECT credit_type FROM top) THEN credit_type ELSE 'Other' END AS type_bucket,
 count(*) AS n FROM bureau GROUP BY ALL""",
    "category_shares": _per_application(f"{_named(_CATEGORIES)}, {_named(_SHARES)}"),
    "bureau_book": "SELECT * FROM book",
    "feature_dictionary": _union(
        [
            f"SELECT '{c}' AS feature, 'bureau_book' AS origin, count(*) - count({c}) AS n_missing FROM book"
            for c in _BOOK_FEATURES
        ]
    ),
    "abt": f"""SELECT app.*, {_FILLED}, coalesce(bureau_credit_count, 0) > 0 AS has_bureau_history
 FROM app LEFT JOIN book USING (application_id)""",
    "narrow_abt": f"""SELECT app.* REPLACE ({_FLOATS}), {_RANKED_NARROW}, coalesce(bureau_credit_count, 0) > 0 AS has_bureau_history
 FROM app LEFT JOIN book_ranked USING (application_id)""",
    "narrow_numeric": f"""SELECT app.* EXCLUDE (application_id) REPLACE ({_FLOATS}),
 {_BYTES}, meta.* EXCLUDE (application_id, {", ".join(_COUNTS)}),
 coalesce(bureau_credit_count, 0) > 0 AS has_bureau_history
 FROM app LEFT JOIN meta USING (application_id)""",
    "target_profile": """SELECT count(target) AS n, count(*) FILTER (WHERE target) AS n_positive,
 count(*) FILTER (WHERE target) / count(target) AS positive_rate,
 count(*) FILTER (WHERE NOT target) / nullif(count(*) FILTER (WHERE target), 0) AS negatives_per_positive
 FROM app""",
    "missing_profile": _MISSING,
    "top_missing": f"SELECT * FROM ({_MISSING}) ORDER BY missing_share DESC, column_name LIMIT 15",
    "numeric_summary": _union(
        [
            f"""SELECT '{c}' AS column_name, {_round(f"avg({c})")} AS mean,
             {_round(f"quantile_cont({c}, 0.5)")} AS median, {_round(f"min({c})")} AS min,
             {_round(f"max({c})")} AS max FROM app"""
            for c in SUMMARY_COLUMNS
        ]
    ),
    "outlier_profile": _union(
        [
            f"""SELECT '{c}' AS column_name, {_round(f"quantile_cont({c}, 0.999)")} AS tail_value,
             {_round(f"max({c})")} AS max, {_round(f"max({c}) / quantile_cont({c}, 0.5)")} AS max_to_median
             FROM app"""
            for c in SUMMARY_COLUMNS
        ]
    ),
    "default_rate_by_segment": _union([_rate(s) for s in SEGMENT_COLUMNS]),
    "target_correlation": _union(
        [
            f"SELECT '{c}' AS column_name, {_round(f'corr({c}, CAST(target AS INT))')} AS correlation FROM app"
            for c in _APP_NUMBERS
        ]
    ),
    "histogram_by_target": """SELECT floor(age_years / CAST(0.5 AS DOUBLE)) * CAST(0.5 AS DOUBLE) AS bin_start,
 target, count(*) AS n FROM app WHERE age_years IS NOT NULL GROUP BY ALL""",
    "history_coverage": """SELECT count(*) AS n, count(*) FILTER (WHERE known) AS n_with_history,
 avg(CAST(known AS INT)) AS coverage
 FROM (SELECT application_id IN (SELECT application_id FROM bureau) AS known FROM app)""",
    "sentinel_audit": _union(
        [
            _sentinel("application_train", "raw_app", "organization_type", "trim(ORGANIZATION_TYPE) = 'XNA'"),
            _sentinel("application_train", "raw_app", "owns_car", "trim(FLAG_OWN_CAR) = 'XNA'"),
            _sentinel("application_train", "raw_app", "days_employed", "DAYS_EMPLOYED = 365243"),
            *[
                _sentinel("bureau", "raw_bureau", BUREAU.renames[c], f"trim({c}) = 'XNA'")
                for c in _BUREAU_TEXT
            ],
        ]
    ),
    "sample_n": f"""SELECT application_id, target, total_income FROM app
 ORDER BY {_DIGEST} LIMIT {SAMPLE_ROWS}""",
    "sample_n_stratified": _STRATIFIED_SAMPLE,
    "stratified_split": "SELECT application_id, target, split FROM sides",
    "stratified_split_exact": _EXACT_SPLIT,
    "holdout_datasets": """SELECT split, CAST(target AS INT) AS __y__, count(*) AS n,
 max(total_income) AS max_income FROM sides GROUP BY ALL""",
    "holdout_datasets_exact": f"""SELECT split, CAST(target AS INT) AS __y__, count(*) AS n,
 max(total_income) AS max_income FROM ({_EXACT_SPLIT}) JOIN app USING (application_id, target) GROUP BY ALL""",
    "category_index": _CATEGORY_INDEX,
    "type_rank_counts": f"SELECT application_id, {_named(_RANKED)} FROM history_ranked GROUP BY application_id",
    "bureau_book_ranked": "SELECT * FROM book_ranked",
    "abt_ranked": f"""SELECT app.*, {_RANKED_FILLED}, coalesce(bureau_credit_count, 0) > 0 AS has_bureau_history
 FROM app LEFT JOIN book_ranked USING (application_id)""",
    "top_correlations": "SELECT * FROM ("
    + _union(
        [
            f"SELECT '{c}' AS column_name, {_round(f'corr({c}, CAST(target AS INT))')} AS correlation FROM app"
            for c in _APP_NUMBERS
        ]
    )
    + ") ORDER BY abs(correlation) DESC NULLS LAST, column_name LIMIT 5",
    "stump_score": f"SELECT application_id, split, {_round('score', 9)} AS score FROM full_scores",
    "stump_importance": f"SELECT feature, {_round('gain', 12)} AS gain FROM full_best",
    "stump_origin": f"""SELECT feature, {_round("gain", 12)} AS gain, 'application' AS origin,
 CAST(1 AS BIGINT) AS n_features, CAST(1 AS DOUBLE) AS share FROM full_best""",
    "stump_metrics": STUMP_METRICS,
    "model_input": "SELECT * EXCLUDE (application_id, target), CAST(target AS INT) AS __y__ FROM app",
    "roc_auc": _auc(_INCOME_SCORE(extra="", table="app")),
    "roc_auc_quality": _auc(
        "SELECT CAST(n_chars AS DOUBLE) AS s, quality AS y FROM documents JOIN labels USING (doc_id)"
    ),
    "roc_curve": _CURVE,
    "auc_by_split": _auc(_INCOME_SCORE(extra=", split", table="sides"), "split"),
}


def oracle_sql() -> dict[str, str]:
    return {name: _with_views(sql) for name, sql in ORACLES.items()}
