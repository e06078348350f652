"""name -> SQL with the result of the query of the same name."""

from __future__ import annotations

from verification.binding import INDEX_CONDITION, SECOND_CONDITION

_N, _DAYS, _FUTURE = 10, 90, 10

_ENCOUNTER = (
    "Enc_Id, CAST(START_TIME AS VARCHAR) AS START_TIME, CAST(END_TIME AS VARCHAR) AS END_TIME,"
    " PATIENT, ORGANIZATION, ENCOUNTERCLASS, COST, DESCRIPTION, REASONDESCRIPTION"
)
_PERSONAL = (
    "SSN", "DRIVERS", "PASSPORT", "PREFIX", "FIRST", "LAST", "SUFFIX", "MAIDEN", "BIRTHPLACE",
    "ADDRESS",
)
_HIDDEN = ", ".join(f'"{c}"' for c in _PERSONAL)
_PATIENT = f"{_HIDDEN}, CAST(BIRTHDATE AS VARCHAR) AS BIRTHDATE, RACE, GENDER, ZIP"
_ORGANIZATION = (
    "Org_Name, PROVIDER_ADDRESS, PROVIDER_CITY, PROVIDER_STATE, PROVIDER_ZIP, PROVIDER_GENDER"
)
_WIDE = f"{_ENCOUNTER}, {_PATIENT}, {_ORGANIZATION}"

# Each entry may use the ones before it.
_CTES = {
    "raw_patients": """
        SELECT c_custkey AS Id, c_custkey AS SSN, 'S' || c_custkey % 1000 AS DRIVERS,
               CASE WHEN c_custkey % 3 <> 0 THEN 'X' || c_custkey || 'X' END AS PASSPORT,
               CASE WHEN c_custkey % 4 = 0 THEN 'Dr.' WHEN c_custkey % 2 = 0 THEN 'Ms.'
                    ELSE 'Mr.' END AS PREFIX,
               c_name AS "FIRST",
               upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || c_custkey % 50 AS "LAST",
               CASE WHEN c_custkey % 10 = 0 THEN 'PhD' END AS SUFFIX,
               CASE WHEN c_custkey % 2 = 0 THEN reverse(c_name) END AS MAIDEN,
               'Town ' || c_nationkey AS BIRTHPLACE,
               c_custkey % 900 + 1 || ' Main St é' AS ADDRESS,
               DATE '1940-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) AS BIRTHDATE,
               nullif(c_mktsegment, 'MACHINERY') AS RACE,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS GENDER,
               c_nationkey AS ZIP
        FROM customer""",
    "patients": f"""
        SELECT Id AS PATIENT,
               {", ".join(f'sha1(CAST("{c}" AS VARCHAR)) AS "{c}"' for c in _PERSONAL)},
               BIRTHDATE, RACE, GENDER, ZIP
        FROM raw_patients""",
    "organizations": """
        SELECT s_suppkey AS ORGANIZATION, s_name AS Org_Name,
               s_suppkey % 500 + 1 || ' High St' AS PROVIDER_ADDRESS,
               'City ' || s_nationkey AS PROVIDER_CITY, n_name AS PROVIDER_STATE,
               s_nationkey AS PROVIDER_ZIP,
               CASE WHEN s_suppkey % 5 = 0 THEN 'F' WHEN s_suppkey % 5 = 1 THEN 'M' END
                 AS PROVIDER_GENDER
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "encounters": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         CAST(l_shipdate AS DATE)) AS Enc_Id,
               l_shipdate AS START_TIME, l_shipdate + to_days(l_linenumber) AS END_TIME,
               o_custkey AS PATIENT, l_suppkey AS ORGANIZATION,
               o_orderpriority AS ENCOUNTERCLASS, l_extendedprice AS COST,
               nullif(p_type, 'PROMO') AS DESCRIPTION,
               CASE WHEN l_returnflag <> 'N' THEN p_name END AS REASONDESCRIPTION
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                      JOIN part ON l_partkey = p_partkey""",
    "pe": """
        SELECT * FROM encounters JOIN patients USING (PATIENT)
                                 JOIN organizations USING (ORGANIZATION)""",
    "cases": f"""
        SELECT DISTINCT PATIENT FROM pe
        WHERE lower(REASONDESCRIPTION) LIKE '%{INDEX_CONDITION}%'""",
    "others": """
        SELECT DISTINCT PATIENT FROM pe WHERE PATIENT NOT IN (SELECT PATIENT FROM cases)""",
    "ranked_others": """
        SELECT PATIENT, row_number() OVER (ORDER BY md5(CAST(PATIENT AS VARCHAR))) AS place
        FROM others""",
    "controls": """
        SELECT PATIENT FROM ranked_others WHERE place <= (SELECT count(*) FROM cases)""",
    "cohort": """
        SELECT PATIENT, true AS is_positive FROM cases
        UNION ALL SELECT PATIENT, false FROM controls""",
    "qualified": """
        SELECT * FROM pe JOIN cohort USING (PATIENT) WHERE DESCRIPTION IS NOT NULL""",
    "comorbid": """
        SELECT REASONDESCRIPTION, count(DISTINCT PATIENT) AS patients,
               row_number() OVER (ORDER BY count(DISTINCT PATIENT) DESC, REASONDESCRIPTION) - 1
                 AS place
        FROM pe JOIN cases USING (PATIENT) WHERE REASONDESCRIPTION IS NOT NULL
        GROUP BY REASONDESCRIPTION""",
}

_USES = {
    "patients": ["raw_patients"],
    "pe": ["encounters", "patients", "organizations"],
    "cases": ["pe"],
    "others": ["cases"],
    "ranked_others": ["others"],
    "controls": ["ranked_others"],
    "cohort": ["controls"],
    "qualified": ["cohort"],
    "comorbid": ["cases"],
}


def _with(select: str, *names: str, extra: dict[str, str] | None = None) -> str:
    needed = set()

    def add(name):
        needed.add(name)
        for used in _USES.get(name, ()):
            add(used)

    for name in names:
        add(name)
    ctes = {**{n: s for n, s in _CTES.items() if n in needed}, **(extra or {})}
    body = ",\n".join(f"{n} AS ({s})" for n, s in ctes.items())
    return f"WITH {body}\n{select}" if ctes else select


def _flags(source: str) -> str:
    columns = ", ".join(
        "coalesce(CAST(REASONDESCRIPTION LIKE '%' || (SELECT REASONDESCRIPTION FROM comorbid"
        f" WHERE place = {i}) || '%' AS INTEGER), 0) AS comorbidity_{i}"
        for i in range(_N)
    )
    return f"SELECT *, {columns} FROM {source}"


_DATED = """
    SELECT *, (SELECT min(START_TIME) FROM flagged) AS EARLIEST_TIME,
           CAST(date_diff('day', CAST((SELECT min(START_TIME) FROM flagged) AS DATE),
                          CAST(START_TIME AS DATE)) AS INTEGER) AS day,
           CAST(date_diff('day', BIRTHDATE, CAST(START_TIME AS DATE)) AS INTEGER) AS patient_age
    FROM flagged"""

_RECENT = ", ".join(
    f"CAST(coalesce(sum(comorbidity_{i}) OVER (PARTITION BY PATIENT ORDER BY day"
    f" RANGE BETWEEN {_DAYS} PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS recent_{i}"
    for i in range(_N)
)


def _label(first: str) -> str:
    return (
        "coalesce(max(comorbidity_0) OVER (PARTITION BY PATIENT ORDER BY day"
        f" RANGE BETWEEN {first} AND {_FUTURE} FOLLOWING), 0) AS label"
    )


_LABEL = _label("CURRENT ROW")
_CALENDAR = (
    "CAST(year(START_TIME) AS INTEGER) AS START_YEAR,"
    " CAST(month(START_TIME) AS INTEGER) AS START_MONTH"
)


def _dated(source: str) -> dict[str, str]:
    return {"flagged": _flags(source), "dated": _DATED}


_FEATURES = {
    **_dated("qualified"),
    "features": f"SELECT * EXCLUDE (ZIP), CAST(ZIP AS VARCHAR) AS ZIP, {_CALENDAR},"
    f" {_RECENT}, {_LABEL} FROM dated",
}
_BALANCED = {
    **_FEATURES,
    "zeros": "SELECT *, row_number() OVER (ORDER BY md5(Enc_Id)) AS place"
    " FROM features WHERE label = 0",
    "balanced": "SELECT * FROM features WHERE label = 1 UNION ALL BY NAME"
    " SELECT * EXCLUDE (place) FROM zeros"
    " WHERE place <= (SELECT count(*) FROM features WHERE label = 1)",
}
_NUMBERED = ", ".join(f"{c}_{i}" for c in ("recent", "comorbidity") for i in range(_N))
# Folds of the rows with a race: each label is spread by the order of md5.
_FOLDS = {
    **_BALANCED,
    "races": "SELECT Enc_Id, RACE, label, substr(md5(Enc_Id), 1, 4) AS part FROM balanced"
    " WHERE RACE IS NOT NULL AND label IS NOT NULL",
    "parts": "SELECT label, part, count(*) AS n FROM races GROUP BY label, part",
    "numbered": """
        SELECT label, part, CAST(floor(
                 coalesce(sum(n) OVER (PARTITION BY label ORDER BY part
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 * 5 / sum(n) OVER (PARTITION BY label)) AS INTEGER) AS fold
        FROM parts""",
    "folded": "SELECT Enc_Id, RACE, label, fold FROM races JOIN numbered USING (label, part)",
    # The others' label rate of a race is the risk that their model gives it.
    "guessed": """
        SELECT f.fold, f.label,
               (SELECT avg(o.label) FROM folded o
                WHERE o.RACE = f.RACE AND o.fold <> f.fold) > 0.5 AS guess
        FROM folded f""",
    "judged": """
        SELECT fold, 2.0 * count(*) FILTER (WHERE label = 1 AND guess)
                     / nullif(count(*) FILTER (WHERE label = 1)
                              + count(*) FILTER (WHERE guess), 0) AS f1
        FROM guessed GROUP BY fold""",
}
_MODEL_COLUMNS = (
    f"ENCOUNTERCLASS, COST, PROVIDER_ZIP, START_YEAR, RACE, GENDER, ZIP, patient_age, {_NUMBERED}"
)
_NOT_NULL = " AND ".join(f"{c.strip()} IS NOT NULL" for c in _MODEL_COLUMNS.split(","))


def _mentions(condition: str) -> str:
    return f"lower(REASONDESCRIPTION) LIKE '%{condition}%'"


def _pairs(second: str) -> dict[str, str]:
    return {
        "pairs": f"""
            SELECT PATIENT, CASE WHEN a THEN '{INDEX_CONDITION}' ELSE 'none' END AS first,
                   CASE WHEN b THEN '{second}' ELSE 'none' END AS second
            FROM (SELECT PATIENT,
                         PATIENT IN (SELECT PATIENT FROM pe WHERE {_mentions(INDEX_CONDITION)}) AS a,
                         PATIENT IN (SELECT PATIENT FROM pe WHERE {_mentions(second)}) AS b
                  FROM patients)""",
        "grid": f"""
            SELECT a.v AS first, b.v AS second
            FROM (VALUES ('{INDEX_CONDITION}'), ('none')) a(v),
                 (VALUES ('{second}'), ('none')) b(v)""",
        "cells": """
            SELECT grid.first, grid.second, count(pairs.PATIENT) AS patients
            FROM grid LEFT JOIN pairs ON grid.first = pairs.first AND grid.second = pairs.second
            GROUP BY grid.first, grid.second""",
    }


_PAIRS = _pairs(SECOND_CONDITION)


def _chi_square(
    correction: float,
    pairs: dict[str, str] = _PAIRS,
    shown: str = "round(statistic, 8) AS statistic, 1 AS df, round(p, 8) AS p_value,"
    " round(log10_p, 8) AS log10_p",
) -> str:
    # Sum over the four cells, as the test is usually written down. The p-value is
    # 1 - erf(z), z = sqrt(statistic / 2), by the series of erf in positive terms; where
    # that leaves too few digits, its logarithm is that of the asymptotic series of erfc.
    return _with(
        f"""
        SELECT {shown},
               CASE WHEN p < 1e-10 THEN 'highly significant'
                    WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS verdict
        FROM judged""",
        "pe",
        extra={
            **pairs,
            "expected": """
                SELECT CAST(patients AS DOUBLE) AS o,
                       sum(patients) OVER (PARTITION BY first)
                       * CAST(sum(patients) OVER (PARTITION BY second) AS DOUBLE)
                       / sum(patients) OVER () AS e
                FROM cells""",
            "statistics": f"""
                SELECT sum((abs(o - e) - least({correction}, abs(o - e))) ** 2 / e) AS statistic
                FROM expected""",
            "tested": """
                SELECT statistic,
                       1 - 2 / sqrt(pi()) * exp(-statistic / 2) * (
                         SELECT sum(exp(k * ln(2) + (2 * k + 1) * ln(sqrt(statistic / 2))
                                        - (lgamma(2 * k + 2) - k * ln(2) - lgamma(k + 1))))
                         FROM generate_series(0, 200) AS terms(k)) AS p
                FROM statistics""",
            "judged": """
                SELECT *, CASE WHEN statistic < 40 THEN log10(p) ELSE
                         (-statistic / 2 - ln(sqrt(pi() * statistic / 2))
                          + ln((SELECT sum((-1) ** k * exp(lgamma(2 * k + 1) - lgamma(k + 1)
                                                           - k * ln(2 * statistic)))
                                FROM generate_series(0, 15) AS terms(k)))) / ln(10) END AS log10_p
                FROM tested""",
        },
    )


ORACLE = {
    "curate_encounters": _with(f"SELECT {_ENCOUNTER} FROM encounters", "encounters"),
    "curate_patients": _with(
        f"SELECT Id AS PATIENT, {_PATIENT} FROM raw_patients", "raw_patients"
    ),
    "curate_organizations": _with(
        f"SELECT ORGANIZATION, {_ORGANIZATION} FROM organizations", "organizations"
    ),
    "curate_providers": "SELECT s_suppkey AS PROVIDER, s_name AS Provider_Name FROM supplier",
    "deid_patients": _with(f"SELECT PATIENT AS Id, {_HIDDEN} FROM patients", "patients"),
    "patient_encounters": _with(f"SELECT {_WIDE} FROM pe", "pe"),
    "table_row_counts": _with(
        " UNION ALL ".join(
            f'SELECT \'{name}\' AS "table", count(*) AS "rows" FROM {cte}'
            for name, cte in (
                ("encounters", "encounters"),
                ("organizations", "organizations"),
                ("patient_encounters", "pe"),
                ("patients", "patients"),
                ("providers", "supplier"),
            )
        ),
        "pe",
    ),
    "top_conditions_encounters": _with(
        """
        SELECT REASONDESCRIPTION, count(*) AS "count" FROM pe
        WHERE REASONDESCRIPTION IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
        "pe",
    ),
    "top_conditions_patients": _with(
        """
        SELECT REASONDESCRIPTION, count(DISTINCT PATIENT) AS "count" FROM pe
        WHERE REASONDESCRIPTION IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
        "pe",
    ),
    "condition_counts_two": _with(
        f"""
        SELECT REASONDESCRIPTION, count(*) AS "count" FROM pe
        WHERE {_mentions(INDEX_CONDITION)} OR {_mentions(SECOND_CONDITION)} GROUP BY 1""",
        "pe",
    ),
    "comorbid_excl_index": _with(
        f"""
        SELECT REASONDESCRIPTION, patients AS "count" FROM comorbid
        WHERE NOT {_mentions(INDEX_CONDITION)} ORDER BY place LIMIT 20""",
        "comorbid",
    ),
    "comorbid_incl_index": _with(
        'SELECT REASONDESCRIPTION, patients AS "count" FROM comorbid WHERE place < 10',
        "comorbid",
    ),
    "cases": _with("SELECT PATIENT, true AS is_positive FROM cases", "cases"),
    "non_cases": _with("SELECT PATIENT FROM others", "others"),
    "controls": _with("SELECT PATIENT, false AS is_positive FROM controls", "controls"),
    "case_control": _with("SELECT PATIENT, is_positive FROM cohort", "cohort"),
    "qualified_encounters": _with(f"SELECT {_WIDE}, is_positive FROM qualified", "qualified"),
    "comorbidity_flags": _with(
        f"SELECT Enc_Id, {', '.join(f'comorbidity_{i}' for i in range(_N))} FROM flagged",
        "comorbid",
        extra={"flagged": _flags("pe")},
    ),
    "day_and_age": _with(
        "SELECT Enc_Id, CAST(EARLIEST_TIME AS VARCHAR) AS EARLIEST_TIME, day, patient_age"
        " FROM dated",
        "pe",
        extra={"flagged": "SELECT * FROM pe", "dated": _DATED},
    ),
    "calendar_features": _with(
        f"SELECT Enc_Id, {_CALENDAR}, CAST(ZIP AS VARCHAR) AS ZIP FROM pe", "pe"
    ),
    "recent_history": _with(
        f"SELECT Enc_Id, {_RECENT} FROM dated", "comorbid", extra=_dated("pe")
    ),
    "label_lookahead": _with(
        f"SELECT Enc_Id, {_LABEL} FROM dated", "comorbid", extra=_dated("pe")
    ),
    "label_next_days": _with(
        f"SELECT Enc_Id, {_label('1 FOLLOWING')} FROM dated", "comorbid", extra=_dated("pe")
    ),
    "encounter_features": _with(
        f"SELECT {_WIDE.replace(', ZIP', '')}, is_positive, ZIP, START_YEAR, START_MONTH,"
        " CAST(EARLIEST_TIME AS VARCHAR) AS EARLIEST_TIME, day, patient_age,"
        f" {_NUMBERED}, label FROM features",
        "qualified",
        "comorbid",
        extra=_FEATURES,
    ),
    "label_distribution": _with(
        'SELECT label, count(*) AS "count" FROM features GROUP BY label',
        "qualified",
        "comorbid",
        extra=_FEATURES,
    ),
    "balanced_training_set": _with(
        "SELECT Enc_Id, PATIENT, day, label FROM balanced",
        "qualified",
        "comorbid",
        extra=_BALANCED,
    ),
    "balanced_label_distribution": _with(
        'SELECT label, count(*) AS "count" FROM balanced GROUP BY label',
        "qualified",
        "comorbid",
        extra=_BALANCED,
    ),
    "training_set": _with(
        f"SELECT Enc_Id, {_MODEL_COLUMNS}, label FROM balanced WHERE {_NOT_NULL}",
        "qualified",
        "comorbid",
        extra=_BALANCED,
    ),
    "first_encounters_by_hash": _with(
        "SELECT Enc_Id, PATIENT, CAST(START_TIME AS VARCHAR) AS START_TIME FROM pe"
        " ORDER BY md5(Enc_Id) LIMIT 100",
        "pe",
    ),
    "co_occurrence": _with("SELECT PATIENT, first, second FROM pairs", "pe", extra=_PAIRS),
    "contingency": _with("SELECT first, second, patients FROM cells", "pe", extra=_PAIRS),
    "chi_square": _chi_square(0.5),
    "chi_square_uncorrected": _chi_square(0.0),
    "zorder_write": _with(f"SELECT {_WIDE} FROM pe", "pe"),
    "zorder_patients": _with(f"SELECT PATIENT, {_PATIENT} FROM patients", "patients"),
    "encoded_features": _with(
        "SELECT Enc_Id, "
        + ", ".join(
            f"CAST(dense_rank() OVER (ORDER BY CAST({c.strip()} AS VARCHAR)) - 1 AS INTEGER)"
            f" AS {c.strip()}"
            for c in _MODEL_COLUMNS.split(",")
        )
        + f" FROM balanced WHERE {_NOT_NULL}",
        "qualified",
        "comorbid",
        extra=_BALANCED,
    ),
    "fold_counts": _with(
        'SELECT label, fold, count(*) AS "count" FROM folded GROUP BY label, fold',
        "qualified",
        "comorbid",
        extra=_FOLDS,
    ),
    "risk_of_group": _with(
        "SELECT Enc_Id, RACE, round(avg(label) OVER (PARTITION BY RACE), 3) AS risk_score"
        " FROM races",
        "qualified",
        "comorbid",
        extra=_FOLDS,
    ),
    "tune_of_group": _with(
        "SELECT CAST(trial AS INTEGER) AS trial, round(-min(coalesce(f1, 0)), 8) AS loss"
        " FROM judged, range(2) AS trials(trial) GROUP BY trial",
        "qualified",
        "comorbid",
        extra=_FOLDS,
    ),
    "zorder_skipping": _with(
        f"""
        SELECT 'REASONDESCRIPTION' AS "column",
               count(*) FILTER (WHERE REASONDESCRIPTION = '{INDEX_CONDITION}') AS "rows",
               true AS fewer_files FROM pe
        UNION ALL
        SELECT 'START_TIME',
               count(*) FILTER (WHERE START_TIME BETWEEN '1997-01-01' AND '1997-02-01'), true FROM pe
        UNION ALL SELECT 'ZIP', count(*) FILTER (WHERE ZIP BETWEEN 3 AND 4), true FROM pe
        UNION ALL
        SELECT 'PATIENT', count(*) FILTER (WHERE PATIENT BETWEEN 100 AND 120), true FROM pe""",
        "pe",
    ),
    "csv_round_trip": _with(
        """
        SELECT Enc_Id AS Id, CAST(START_TIME AS VARCHAR) AS "START",
               CAST(END_TIME AS VARCHAR) AS "END", CAST(PATIENT AS VARCHAR) AS PATIENT,
               CAST(ORGANIZATION AS VARCHAR) AS PROVIDER, ENCOUNTERCLASS, COST, DESCRIPTION,
               REASONDESCRIPTION
        FROM encounters""",
        "encounters",
    ),
    "csv_unparsed": _with(
        """
        SELECT Enc_Id AS Id, CASE WHEN PATIENT % 7 <> 0 THEN COST END AS COST,
               ORGANIZATION % 50 = 0 AS no_start,
               CASE WHEN PATIENT % 7 = 0 THEN 'n/a' END AS cost_text,
               CASE WHEN ORGANIZATION % 50 = 0 THEN 'day ' || PATIENT END AS start_text
        FROM encounters WHERE PATIENT % 7 = 0 OR ORGANIZATION % 50 = 0""",
        "encounters",
    ),
    "csv_unparsed_counts": _with(
        """
        SELECT 'encounters' AS "table", 'COST' AS "column", count(*) AS "values"
        FROM encounters WHERE PATIENT % 7 = 0
        UNION ALL
        SELECT 'encounters', 'START', count(*) FROM encounters WHERE ORGANIZATION % 50 = 0""",
        "encounters",
    ),
    "refresh_tables": _with(
        """
        SELECT Enc_Id, CAST(PATIENT AS VARCHAR) AS PATIENT,
               CAST(ORGANIZATION AS VARCHAR) AS ORGANIZATION,
               CAST(START_TIME AS VARCHAR) AS START_TIME, COST, "FIRST", ADDRESS,
               CAST(BIRTHDATE AS VARCHAR) AS BIRTHDATE, PROVIDER_CITY
        FROM pe""",
        "pe",
    ),
    "refresh_row_counts": _with(
        " UNION ALL ".join(
            f'SELECT \'{name}\' AS "table", count(*) AS "rows" FROM {cte}'
            for name, cte in (
                ("encounters", "encounters"),
                ("organizations", "organizations"),
                ("patient_encounters", "pe"),
                ("patients", "patients"),
                ("providers", "supplier"),
            )
        ),
        "pe",
    ),
    "dashboard_reports": _with(
        f"""
        (SELECT 'top_by_encounters' AS report, REASONDESCRIPTION, count(*) AS "count" FROM pe
         WHERE REASONDESCRIPTION IS NOT NULL GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 20)
        UNION ALL
        (SELECT 'top_by_patients', REASONDESCRIPTION, count(DISTINCT PATIENT) AS n FROM pe
         WHERE REASONDESCRIPTION IS NOT NULL GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 20)
        UNION ALL
        (SELECT 'selected_conditions', REASONDESCRIPTION, count(*) FROM pe
         WHERE {_mentions(INDEX_CONDITION)} OR {_mentions(SECOND_CONDITION)} GROUP BY 2)
        UNION ALL
        (SELECT 'comorbid_conditions', REASONDESCRIPTION, patients FROM comorbid
         WHERE NOT {_mentions(INDEX_CONDITION)} ORDER BY place LIMIT 20)""",
        "comorbid",
    ),
    "run_log": _with(
        f"""
        SELECT 'trial-' || i AS run_name, (SELECT count(*) FROM balanced WHERE {_NOT_NULL}) AS "rows",
               true AS has_loss, CAST(NULL AS BOOLEAN) AS is_least,
               CAST(NULL AS BOOLEAN) AS has_accuracy, false AS has_model
        FROM range(32) AS trials(i)
        UNION ALL SELECT 'tuning', NULL, true, true, NULL, false
        UNION ALL SELECT 'training', NULL, NULL, NULL, true, true""",
        "qualified",
        "comorbid",
        extra=_BALANCED,
    ),
    "chi_square_strong": _chi_square(
        0.5,
        _pairs(INDEX_CONDITION.split()[0]),
        "round(statistic, 6) AS statistic, 1 AS df, round(log10_p, 6) AS log10_p",
    ),
}
