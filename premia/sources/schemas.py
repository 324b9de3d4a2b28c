"""Column names and types of the stored layers (fixed values)."""

from __future__ import annotations

RAW_POLICY_FIELDS = (
    ("IDpol", "bigint"),
    ("ClaimNb", "bigint"),
    ("Exposure", "double"),
    ("Area", "string"),
    ("VehPower", "bigint"),
    ("VehAge", "bigint"),
    ("DrivAge", "bigint"),
    ("BonusMalus", "bigint"),
    ("VehBrand", "string"),
    ("VehGas", "string"),
    ("Density", "double"),
    ("Region", "string"),
)
RAW_CLAIM_FIELDS = (("IDpol", "bigint"), ("ClaimAmount", "double"))
AUDIT_FIELDS = (("_ingested_at", "timestamp"), ("_source_hash", "string"))

SNAKE_NAMES = {
    "IDpol": "policy_id",
    "ClaimNb": "claim_nb",
    "Exposure": "exposure",
    "Area": "area",
    "VehPower": "veh_power",
    "VehAge": "veh_age",
    "DrivAge": "driv_age",
    "BonusMalus": "bonus_malus",
    "VehBrand": "veh_brand",
    "VehGas": "veh_gas",
    "Density": "density",
    "Region": "region",
}
COVARIATES = tuple(name for name, _ in RAW_POLICY_FIELDS if name not in ("IDpol", "ClaimNb", "Exposure"))
QUOTE_FIELDS = tuple(v for v in SNAKE_NAMES.values() if v != "claim_nb")


def ddl(fields) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields)


BRONZE_POLICIES = ddl(RAW_POLICY_FIELDS + AUDIT_FIELDS)
BRONZE_CLAIMS = ddl(RAW_CLAIM_FIELDS + AUDIT_FIELDS)
