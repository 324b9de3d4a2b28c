"""Derived tables as plain SQL for the engine that checks the results."""

from __future__ import annotations

import re

TABLES = {
    "raw_sev": """
        SELECT CAST(l_orderkey AS DOUBLE) AS IDpol,
               l_extendedprice * l_extendedprice / CAST(200000 AS DOUBLE) AS ClaimAmount
        FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 40""",
    "claim_count": "SELECT IDpol, count(*) AS n FROM raw_sev GROUP BY IDpol",
    "raw_freq": """
        SELECT CAST(o_orderkey AS DOUBLE) AS IDpol,
               CAST(CASE WHEN o_orderkey % 101 = 0 THEN 0 WHEN o_orderkey % 1013 = 5 THEN 6
                    ELSE coalesce(n, 0) + CASE WHEN o_orderkey % 97 = 3 THEN 1 ELSE 0 END END AS BIGINT) AS ClaimNb,
               (1 + o_custkey % 26) * CAST(0.05 AS DOUBLE) AS Exposure,
               substr('ABCDEF', CAST(1 + o_custkey % 6 AS INTEGER), 1) AS Area,
               CAST(4 + o_custkey % 12 AS BIGINT) AS VehPower,
               CAST(CASE WHEN o_custkey % 50 = 0 THEN 100 ELSE (o_custkey * 7) % 25 END AS BIGINT) AS VehAge,
               CAST(18 + o_custkey % 83 AS BIGINT) AS DrivAge,
               CAST(50 + 10 * (o_orderkey % 4) AS BIGINT) AS BonusMalus,
               'B' || CAST(1 + o_custkey % 7 AS VARCHAR) AS VehBrand,
               CASE WHEN o_orderstatus = 'F' THEN 'Diesel' ELSE 'Regular' END AS VehGas,
               1 + abs(c_acctbal) AS Density,
               'R' || CAST(c_nationkey AS VARCHAR) AS Region
        FROM orders JOIN customer ON o_custkey = c_custkey
        LEFT JOIN claim_count ON claim_count.IDpol = o_orderkey""",
    "freq": "SELECT * REPLACE (CAST(IDpol AS BIGINT) AS IDpol) FROM raw_freq",
    "sev": "SELECT CAST(IDpol AS BIGINT) AS IDpol, ClaimAmount FROM raw_sev",
    "spoiled": """
        SELECT IDpol,
               CAST(CASE WHEN IDpol % 61 = 7 THEN -1 ELSE ClaimNb END AS BIGINT) AS ClaimNb,
               CASE WHEN IDpol % 53 = 1 THEN CAST(0 AS DOUBLE) ELSE Exposure END AS Exposure,
               CASE WHEN IDpol % 47 = 2 THEN 'Z' ELSE Area END AS Area,
               VehPower, VehAge,
               CAST(CASE WHEN IDpol % 50 = 0 THEN 200 ELSE DrivAge END AS BIGINT) AS DrivAge,
               CAST(CASE WHEN IDpol % 59 = 4 THEN 351 ELSE BonusMalus END AS BIGINT) AS BonusMalus,
               VehBrand, VehGas, Density,
               CASE WHEN IDpol % 43 = 3 THEN NULL ELSE Region END AS Region
        FROM freq""",
    "faulty": "SELECT * FROM spoiled UNION ALL SELECT * FROM spoiled WHERE IDpol % 89 = 6",
    "faulty_reasons": """
        SELECT *, list_sort(list_distinct(list_filter([
                 CASE WHEN ClaimNb < 0 THEN 'greater_than_or_equal_to(0)' END,
                 CASE WHEN Exposure <= 0 THEN 'greater_than(0)' END,
                 CASE WHEN Area NOT IN ('A','B','C','D','E','F') THEN 'isin([''A'', ''B'', ''C'', ''D'', ''E'', ''F''])' END,
                 CASE WHEN DrivAge < 18 OR DrivAge > 100 THEN 'in_range(18, 100)' END,
                 CASE WHEN BonusMalus < 50 OR BonusMalus > 350 THEN 'in_range(50, 350)' END,
                 CASE WHEN Region IS NULL THEN 'not_nullable' END,
                 CASE WHEN count(*) OVER (PARTITION BY IDpol) > 1 THEN 'field_uniqueness' END],
               lambda x: x IS NOT NULL))) AS reasons
        FROM faulty""",
    "capped": """
        SELECT * REPLACE (CASE WHEN Exposure > 1 THEN CAST(1 AS DOUBLE) ELSE Exposure END AS Exposure,
                          CASE WHEN ClaimNb > 4 THEN CAST(4 AS BIGINT) ELSE ClaimNb END AS ClaimNb)
        FROM freq""",
    "flagged": """
        SELECT *, count(*) OVER (PARTITION BY Area, VehPower, VehAge, DrivAge, BonusMalus, VehBrand, VehGas, Density,
                                 Region) AS n_covariate_duplicates
        FROM capped""",
    "sev_capped": """
        SELECT IDpol, ClaimAmount, CASE WHEN ClaimAmount > 50000 THEN CAST(50000 AS DOUBLE) ELSE ClaimAmount END AS c
        FROM sev""",
    "sev_agg": """
        SELECT IDpol, sum(ClaimAmount) AS total_claim_amount, count(ClaimAmount) AS n_rows,
               max(ClaimAmount) AS max_claim_amount, sum(c) AS capped_claim_amount,
               sum(ClaimAmount - c) AS excess_claim_amount
        FROM sev_capped GROUP BY IDpol""",
    "joined": """
        SELECT flagged.*, n_covariate_duplicates > 1 AS is_duplicate_group,
               CASE WHEN ClaimNb = 0 THEN coalesce(total_claim_amount, 0) ELSE total_claim_amount END AS total_claim_amount,
               coalesce(n_rows, 0) AS n_severity_rows,
               CASE WHEN ClaimNb = 0 THEN coalesce(max_claim_amount, 0) ELSE max_claim_amount END AS max_claim_amount,
               CASE WHEN ClaimNb = 0 THEN coalesce(capped_claim_amount, 0) ELSE capped_claim_amount END
                 AS capped_claim_amount,
               CASE WHEN ClaimNb = 0 THEN coalesce(excess_claim_amount, 0) ELSE excess_claim_amount END
                 AS excess_claim_amount,
               n_rows IS NOT NULL AS has_severity_record, coalesce(n_rows, 0) <> ClaimNb AS claim_count_mismatch
        FROM flagged LEFT JOIN sev_agg ON flagged.IDpol = sev_agg.IDpol""",
    "silver_all": """
        SELECT IDpol AS policy_id, ClaimNb AS claim_nb, Exposure AS exposure, Area AS area, VehPower AS veh_power,
               VehAge AS veh_age, DrivAge AS driv_age, BonusMalus AS bonus_malus, VehBrand AS veh_brand,
               VehGas AS veh_gas, Density AS density, Region AS region, n_covariate_duplicates, is_duplicate_group,
               total_claim_amount, n_severity_rows, max_claim_amount, capped_claim_amount, excess_claim_amount,
               has_severity_record, claim_count_mismatch, ClaimNb / Exposure AS claim_frequency,
               CASE WHEN ClaimNb > 0 THEN capped_claim_amount / ClaimNb END AS avg_claim_amount,
               capped_claim_amount / Exposure AS pure_premium
        FROM joined""",
    "silver": "SELECT * FROM silver_all WHERE NOT (claim_nb > 0 AND NOT has_severity_record)",
    "quarantine": "SELECT * FROM silver_all WHERE claim_nb > 0 AND NOT has_severity_record",
    "ranked": """
        SELECT policy_id, claim_nb > 0 AS s, count(*) OVER (PARTITION BY claim_nb > 0) AS n,
               row_number() OVER (PARTITION BY claim_nb > 0 ORDER BY md5('42:' || CAST(policy_id AS VARCHAR))) AS rn
        FROM silver""",
    "labels_": """
        SELECT policy_id, CASE WHEN rn <= t THEN 'test'
                               WHEN rn <= t + ceil((n - t) * CAST(0.25 AS DOUBLE)) THEN 'val' ELSE 'train' END AS split
        FROM (SELECT *, ceil(n * CAST(0.2 AS DOUBLE)) AS t FROM ranked)""",
    "eng": """
        SELECT silver.*, split, ln(density) AS log_density,
               CASE WHEN driv_age < 18 OR driv_age >= 100 THEN 'nan' WHEN driv_age < 25 THEN '[18.0, 25.0)'
                    WHEN driv_age < 30 THEN '[25.0, 30.0)' WHEN driv_age < 40 THEN '[30.0, 40.0)'
                    WHEN driv_age < 50 THEN '[40.0, 50.0)' WHEN driv_age < 60 THEN '[50.0, 60.0)'
                    WHEN driv_age < 70 THEN '[60.0, 70.0)' ELSE '[70.0, 100.0)' END AS driv_age_band,
               CASE WHEN veh_age < 0 OR veh_age >= 100 THEN 'nan' WHEN veh_age < 1 THEN '[0.0, 1.0)'
                    WHEN veh_age < 3 THEN '[1.0, 3.0)' WHEN veh_age < 5 THEN '[3.0, 5.0)'
                    WHEN veh_age < 10 THEN '[5.0, 10.0)' WHEN veh_age < 20 THEN '[10.0, 20.0)'
                    ELSE '[20.0, 100.0)' END AS veh_age_band,
               CASE WHEN veh_power < 0 OR veh_power >= 15 THEN 'nan' WHEN veh_power < 4 THEN '[0.0, 4.0)'
                    WHEN veh_power < 6 THEN '[4.0, 6.0)' WHEN veh_power < 8 THEN '[6.0, 8.0)'
                    WHEN veh_power < 10 THEN '[8.0, 10.0)' ELSE '[10.0, 15.0)' END AS veh_power_band,
               CASE WHEN veh_age <= 1 THEN 1 ELSE 0 END AS is_new_vehicle
        FROM silver JOIN labels_ USING (policy_id)""",
    "gold_f": "SELECT *, claim_frequency AS y, exposure AS w FROM eng",
    "gold_s": "SELECT *, avg_claim_amount AS y, CAST(claim_nb AS DOUBLE) AS w FROM eng WHERE claim_nb > 0",
    "gold_p": "SELECT *, pure_premium AS y, exposure AS w FROM eng",
    "eval_f": """
        SELECT *, CAST(0.05 AS DOUBLE) + CAST(0.002 AS DOUBLE) * bonus_malus + CAST(0.001 AS DOUBLE) * driv_age AS yhat
        FROM gold_f""",
    "eval_s": """
        SELECT *, CAST(15000 + 20 * driv_age - 10 * veh_age AS DOUBLE) AS yhat FROM gold_s""",
    "eval_p": """
        SELECT *, CAST(40 * bonus_malus + 30 * driv_age + 5 * veh_power AS DOUBLE) AS yhat
        FROM gold_p""",
    "quotes": """
        SELECT IDpol AS policy_id, Exposure AS exposure, Area AS area, VehPower AS veh_power, VehAge AS veh_age,
               CAST(CASE WHEN IDpol % 50 = 0 THEN 200 ELSE DrivAge END AS BIGINT) AS driv_age,
               BonusMalus AS bonus_malus, VehBrand AS veh_brand, VehGas AS veh_gas, Density AS density,
               Region AS region
        FROM freq""",
    "good_quotes": """
        SELECT *, ln(density) AS log_density,
               CASE WHEN veh_power < 6 THEN '[4.0, 6.0)' WHEN veh_power < 8 THEN '[6.0, 8.0)'
                    WHEN veh_power < 10 THEN '[8.0, 10.0)' WHEN veh_power < 15 THEN '[10.0, 15.0)'
                    ELSE 'nan' END AS veh_power_band
        FROM quotes WHERE driv_age <= 100""",
}


def with_tables(sql: str) -> str:
    """Prefix the statement with the derived tables it needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    body = ",\n".join(f"{n} AS ({TABLES[n]})" for n in needed)
    stripped = sql.lstrip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {body},\n{stripped[5:]}"
    return f"WITH {body}\n{sql}"


def rising(feature: str, low: str, high: str, i: int) -> str:
    """Cubic basis value i of a feature as SQL, written out from its four pieces."""
    u = f"((least(greatest(CAST({feature} AS DOUBLE), {low}), {high}) - {low}) / (({high} - {low}) / 4))"
    v = f"({u} - {i - 3})"
    return (
        f"CASE WHEN {v} < 0 OR {v} >= 4 THEN 0 WHEN {v} < 1 THEN {v}**3 / 6 "
        f"WHEN {v} < 2 THEN (-3 * {v}**3 + 12 * {v}**2 - 12 * {v} + 4) / 6 "
        f"WHEN {v} < 3 THEN (3 * {v}**3 - 24 * {v}**2 + 60 * {v} - 44) / 6 ELSE (4 - {v})**3 / 6 END"
    )
