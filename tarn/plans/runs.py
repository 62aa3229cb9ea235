"""What is recorded of a run, and the guards that refuse comparisons which make no sense. Small values on the driver."""

from __future__ import annotations

import hashlib
import json

#: Parts of a configuration that leave the results as they are.
NOT_SCIENTIFIC = ("run_label", "compute", "output", "gapfill")
#: Fields that two runs must share: all that are there, and these in any case.
COMPARED = (
    "schema_version", "aoi_id", "source", "resolution_m", "crs", "validity_policy", "monthly_composite", "water_threshold", "threshold_method",
    "min_valid_obs", "min_valid_fraction_month", "area_method", "min_patch_pixels", "connectivity_rule", "node_source",
)
REQUIRED = ("schema_version", "aoi_id", "source", "resolution_m", "crs", "validity_policy", "monthly_composite", "min_patch_pixels", "connectivity_rule")


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def digest(value: object) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def config_hash(config: dict) -> str:
    """Equal for configurations that give equal results."""
    return digest({k: v for k, v in config.items() if k not in NOT_SCIENTIFIC})


def manifest(config: dict, **fields: object) -> dict:
    return {"config_hash": config_hash(config), **fields}


def compared(left: dict, right: dict, overrides: dict[str, str] | None = None) -> dict[str, tuple]:
    """Fields in which two manifests differ, each with both values and the reason why it may; without a reason, an error."""
    reasons = overrides or {}
    for name, why in reasons.items():
        if name not in COMPARED or not str(why).strip():
            raise ValueError(f"no field, or no reason: {name}")
    differ = {f: (left.get(f), right.get(f), reasons.get(f)) for f in COMPARED if left.get(f) != right.get(f) or (f in REQUIRED and left.get(f) is None)}
    open_ = [f for f, x in differ.items() if not x[2]]
    if open_:
        raise ValueError("runs can't be compared: " + ", ".join(f"{f} ({left.get(f)}, {right.get(f)})" for f in open_))
    unused = set(reasons) - set(differ)
    if unused:
        raise ValueError(f"nothing to override: {', '.join(sorted(unused))}")
    return differ


def area_allowed(crs_is_geographic: bool, per_pixel: bool = False) -> None:
    """Areas in square degrees are refused."""
    if crs_is_geographic and not per_pixel:
        raise ValueError("areas need a projected CRS")
