"""SQL of the queries over what is kept. State does not show in a result, so most equal those of whole tables."""

from __future__ import annotations

import re

from loanloom.catalog import SUMMARY_COLUMNS
from loanloom.oracles import ORACLES, _round
from loanloom.sources.views import RAW_BUREAU
from loanloom.specs import BUREAU

#: Which half of the lines a file has, and whether its amount is no number.
_FILE = "CASE WHEN SK_ID_BUREAU % 2 = 0 THEN 'monday.csv' ELSE 'tuesday.csv' END"
_BAD = "SK_ID_BUREAU % 97 = 0"
_DOUBLES = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}"
    for c, kind in BUREAU.types.items()
    if kind.simpleString() == "double" and c != "SK_BUREAU_ID"
)
_LINE = " || ',' || ".join(
    "'n/a'" if c == "AMT_CREDIT_SUM" else f"coalesce(CAST({c} AS VARCHAR), '')"
    for c in re.findall(r" AS ([A-Z_]+)[,\n]", RAW_BUREAU)
)


def _paired(rows: str, z: bool = True) -> str:
    """`rows` selects y (0/1) and the scores a and b of the same row."""
    place = "(sum({0}) OVER (ORDER BY {1} {2}) - sum({0}) OVER (PARTITION BY {1}) / 2) / sum({0}) OVER ()".format
    columns = ", ".join(
        f"CASE WHEN y = 1 THEN {place('n', s, 'ASC')} ELSE {place('p', s, 'DESC')} END AS v{s}" for s in "ab"
    )
    spread = " + ".join(
        f"(var_samp(va) FILTER (WHERE y = {y}) + var_samp(vb) FILTER (WHERE y = {y}) - 2 * covar_samp(va, vb) FILTER (WHERE y = {y})) / count(*) FILTER (WHERE y = {y})"
        for y in (0, 1)
    )
    auc = "avg(v{0}) FILTER (WHERE y = 1)".format
    values = {"auc_baseline": auc("a"), "auc_challenger": auc("b"), "auc_gain": f"{auc('b')} - {auc('a')}", "gain_error": f"sqrt(greatest({spread}, 0))"}
    if z:
        values["z"] = f"({auc('b')} - {auc('a')}) / sqrt({spread})"
    return f"""
SELECT count(*) FILTER (WHERE y = 1) AS n_positive, count(*) FILTER (WHERE y = 0) AS n_negative,
 {", ".join(f"{_round(v, 9)} AS {k}" for k, v in values.items())}
FROM (SELECT y, {columns} FROM (SELECT y, a, b, CAST(y AS DOUBLE) AS p, CAST(1 - y AS DOUBLE) AS n FROM ({rows})))
"""


ORACLES |= {
    "paired_auc": _paired("SELECT CAST(target AS INT) AS y, total_income AS a, age_years AS b FROM app"),
    "stump_paired_gain": _paired(
        """SELECT (small_scores.y + 1) // 2 AS y, small_scores.score AS a, full_scores.score AS b
 FROM small_scores JOIN full_scores USING (application_id, split) WHERE split = 'validation'""",
        z=False,
    ),
    "bronze_accepted": f"SELECT * REPLACE ({_DOUBLES}), {_FILE} AS _source_file FROM raw_bureau WHERE NOT {_BAD}",
    "bronze_quarantine": f"SELECT {_FILE} AS _source_file, {_LINE} AS record FROM raw_bureau WHERE {_BAD}",
    "load_audit": f"""SELECT 'bureau' AS table_name, {_FILE} AS load, count(*) FILTER (WHERE NOT {_BAD}) AS n_rows,
  count(*) FILTER (WHERE {_BAD}) AS n_rejected, CAST(0 AS BIGINT) AS n_null_keys FROM raw_bureau GROUP BY ALL
 UNION ALL SELECT 'bureau', 'monday.csv', count(*), 0, 0 FROM raw_bureau WHERE SK_ID_BUREAU % 2 = 0""",
    "bronze_reload": f"""SELECT SK_ID_BUREAU, CAST(DAYS_CREDIT + CASE WHEN SK_ID_BUREAU % 2 = 0 THEN 1 ELSE 0 END AS INT) AS DAYS_CREDIT,
  CAST(AMT_CREDIT_SUM AS DOUBLE) AS AMT_CREDIT_SUM, {_FILE} AS _source_file,
  CASE WHEN SK_ID_BUREAU % 2 = 0 THEN CAST(0 AS BIGINT) ELSE (SELECT count(*) FROM raw_bureau WHERE {_BAD} AND SK_ID_BUREAU % 2 = 1) END AS n_rejected
 FROM raw_bureau WHERE SK_ID_BUREAU % 2 = 0 OR NOT {_BAD}""",
    "book_after_load": ORACLES["bureau_book"],
    "type_frequencies_after_load": "SELECT credit_type, count(*) AS n FROM bureau GROUP BY credit_type",
    "load_log": """SELECT CASE WHEN bureau_credit_id % 10 < 7 THEN 'monday' ELSE 'tuesday' END AS load,
 count(*) AS rows, count(*) FILTER (WHERE application_id IS NULL) AS null_keys FROM bureau GROUP BY 1""",
    "distinct_types_bitmap": "SELECT application_id, bureau_distinct_credit_types FROM meta",
    "book_at_rest": ORACLES["bureau_book"],
    "abt_pruned": ORACLES["abt"] + " WHERE application_id % 10 = 3",
    "table_audit_from_footers": ORACLES["table_audit"],
    "missing_profile_from_footers": ORACLES["missing_profile"],
    "narrow_numeric_from_footers": ORACLES["narrow_numeric"],
    "quantiles_from_sketches": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, CAST({p} AS DOUBLE) AS prob, true AS within FROM app"
        for c in SUMMARY_COLUMNS
        for p in (0.001, 0.25, 0.5, 0.75, 0.999)
    ),
    "saved_stump_score": ORACLES["stump_score"],
    "top_types_sketched": ORACLES["top_types"],
    "top_open_categories": """SELECT days_credit AS value, count(*) AS n FROM bureau GROUP BY days_credit
 ORDER BY n DESC, value ASC NULLS FIRST LIMIT 20""",
    "abt_at_rest": ORACLES["abt"],
}
