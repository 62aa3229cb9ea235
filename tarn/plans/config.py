"""The configuration of a run: defaults, strict checks and two hashes. Small values on the driver.

A configuration is a nested mapping. Unknown keys are refused by their path, missing ones take the default, and numbers
are brought to the default's type, so that equal configurations have equal hashes however they are written.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from .runs import digest


class ConfigError(ValueError):
    """A configuration that has unknown keys, lacks needed ones or has values out of range."""


#: Keys and defaults of what changes results. Fixed values.
SCIENTIFIC: dict[str, Any] = {
    "config_schema_version": None,
    "input": {"kind": None, "variable_map": {}, "water_threshold": None, "threshold_method": None, "probability_source": None},
    "validity": {"policy": "p_native_season_stratified_v1", "min_valid_obs": 20, "min_valid_fraction_month": 0.70, "low_support_behavior": "suppress_value"},
    "spatial": {"target_crs": "EPSG:3577", "area_method": "projected", "windowing": {"mode": "none", "length_m": None}},
    "patches": {"min_patch_pixels": 3, "connectivity_rule": 8, "width_resolution_floor_pixels": None},
    "persistence": {"refuge_threshold": 0.90},
    "zones": {"t_persist": 0.50, "t_season": 0.10},
    "temporal": {"input_cadence": None, "monthly_composite": None, "composite_owner": None},
    "dynamics": {"composite_sensitivity_tolerance_pp": 10.0, "contraction_method": "linear", "minimum_points": 3},
    # the detector's name is part of the hash of results; the one that runs is operators.dynamics.anchors
    "hydroyear": {
        "algorithm": "hydroseason.detect_hydrological_years",
        "parameters": {"wet_start_month": 11, "wet_end_month": 4, "dry_start_month": 7, "dry_end_month": 12, "min_wet_months": 2, "min_dry_months": 2, "low_confidence_ratio": 0.25, "medium_confidence_ratio": 0.5},
    },
    "channel": {"source": None, "node_source": None},
    "state": {"enabled": False, "connectivity_metric": None, "connectivity_threshold": None},
    "connectivity": {"edge_rule": None},
    "metric_profiles": ["contracts_core"],
    "metric_overrides": {"add": [], "remove": [], "reasons": {}},
}
#: Keys and defaults of what leaves results as they are. Fixed values.
EXECUTION: dict[str, Any] = {
    "compute": {
        "accelerator": "auto", "cuda_strict": False, "target_chunk_bytes": None, "worker_memory_fraction": None, "checkpoint": "zarr",
        "scheduler": "local", "workers": 1, "scheduler_address": None, "checkpoint_path": None,
    },
    "gapfill": False,
    "output": {"formats": ["parquet"], "include_patch_table": False, "include_vectors": False, "output_dir": None},
}
#: Allowed values by path. Fixed values.
CHOICES: dict[str, tuple] = {
    "input.kind": (None, "watermask_tsfill", "generic_binary", "generic_probability", "raw_wofs"),
    "validity.low_support_behavior": ("suppress_value", "emit_flagged_value", "metric_specific"),
    "spatial.area_method": ("projected", "per_pixel"),
    "spatial.windowing.mode": ("none", "channel_length", "regular_grid"),
    "patches.connectivity_rule": (4, 8),
    "temporal.monthly_composite": ("max_water", "median", "mode", "end_of_month_nearest", "supplied"),
    "dynamics.contraction_method": ("linear", "theil_sen"),
    "state.connectivity_metric": (None, "RC", "LPSEC", "LPI", "DCI"),
    "compute.accelerator": ("none", "auto", "cuda"),
}
REQUIRED = ("config_schema_version", "temporal.input_cadence", "temporal.monthly_composite", "temporal.composite_owner")
FRACTIONS = ("input.water_threshold", "validity.min_valid_fraction_month", "persistence.refuge_threshold", "zones.t_persist", "zones.t_season", "compute.worker_memory_fraction")
LEAST = {"validity.min_valid_obs": 1, "patches.min_patch_pixels": 1, "dynamics.minimum_points": 3}
REAL = ("spatial.windowing.length_m", "patches.width_resolution_floor_pixels", "state.connectivity_threshold", *FRACTIONS)
#: Mappings whose keys the user chooses; sequences that are sets.
FREE, SETS = ("input.variable_map", "metric_overrides.reasons"), ("metric_profiles", "metric_overrides.add", "metric_overrides.remove", "output.formats")


def _typed(path: str, default: Any, value: Any) -> Any:
    try:
        if path in SETS:
            if isinstance(value, str):
                raise ConfigError(f"{path} must be a sequence, not a string")
            return sorted({str(v) for v in value})
        if value is None:
            return copy.deepcopy(default)
        if path in REAL or type(default) is float:
            return float(value)
        return type(default)(value) if type(default) in (bool, int, str) else value
    except (TypeError, ValueError) as why:
        raise ConfigError(f"{path}: {why}") from why


def _merged(defaults: Mapping, given: Any, at: str = "") -> dict:
    if not isinstance(given, Mapping):
        raise ConfigError(f"{at.rstrip('.') or 'config'} must be a mapping")
    unknown = sorted(set(given) - set(defaults))
    if unknown:
        raise ConfigError(f"unknown config key: {at or 'config.'}{unknown[0]}")
    out = {}
    for key, default in defaults.items():
        path, value = f"{at}{key}", given.get(key, default)
        if path in FREE:
            out[key] = {str(k): str(v) for k, v in dict(value).items()}
        elif isinstance(default, dict):
            out[key] = _merged(default, value, f"{path}.")
        else:
            out[key] = _typed(path, default, value)
    return out


@dataclass(frozen=True)
class Config:
    """Checked values; config["patches.connectivity_rule"] reads one."""

    values: dict
    run_label: str | None = None

    def __getitem__(self, path: str) -> Any:
        value: Any = self.values
        for key in path.split("."):
            value = value[key]
        return value

    @property
    def scientific(self) -> dict:
        return {k: self.values[k] for k in SCIENTIFIC}

    @property
    def execution(self) -> dict:
        return {k: self.values[k] for k in EXECUTION}

    @property
    def config_hash(self) -> str:
        """Equal for configurations that give equal results."""
        return digest(self.scientific)

    @property
    def execution_hash(self) -> str:
        return digest(self.execution)


def configured(raw: Mapping) -> Config:
    """The checked configuration of a mapping."""
    given = dict(raw) if isinstance(raw, Mapping) else raw
    label = given.pop("run_label", None) if isinstance(given, dict) else None
    config = Config(_merged(SCIENTIFIC | EXECUTION, given), label)
    for path in REQUIRED:
        if config[path] in (None, ""):
            raise ConfigError(f"{path} is required")
    for path, allowed in CHOICES.items():
        if config[path] not in allowed:
            raise ConfigError(f"{path} can't be {config[path]!r}; choose from {allowed}")
    for path in FRACTIONS:
        if config[path] is not None and not 0 <= config[path] <= 1:
            raise ConfigError(f"{path} does not lie between 0 and 1")
    for path, least in LEAST.items():
        if config[path] < least:
            raise ConfigError(f"{path} takes numbers of at least {least}")
    floor, windows, state = config["patches.width_resolution_floor_pixels"], config["spatial.windowing"], config["state"]
    if floor is not None and not (math.isfinite(floor) and floor > 0):
        raise ConfigError("the floor of widths is no positive finite number")
    if windows["mode"] == "channel_length" and windows["length_m"] is None:
        windows["length_m"] = 5000.0
    if config["zones.t_season"] >= config["zones.t_persist"]:
        raise ConfigError("zones.t_season lies at or above zones.t_persist")
    if config["input.kind"] == "generic_probability" and None in (config["input.water_threshold"], config["input.threshold_method"], config["input.probability_source"]):
        raise ConfigError("input: probabilities need water_threshold, threshold_method and probability_source")
    if state["enabled"] and None in (state["connectivity_metric"], state["connectivity_threshold"]):
        raise ConfigError("state.enabled needs a connectivity_metric and a connectivity_threshold")
    if config["compute.cuda_strict"] and config["compute.accelerator"] != "cuda":
        raise ConfigError("cuda_strict is for the accelerator cuda only")
    if not config["metric_profiles"]:
        raise ConfigError("metric_profiles is empty")
    return config
