"""Which metrics a run makes: their specifications, and what a choice of them comes to with the inputs at hand."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Metric:
    """A metric's place in the long table, and the inputs it needs beside the observations."""

    family: str
    unit: str
    value_type: str = "monthly"
    needs: frozenset[str] = frozenset()


#: The registered metrics: id, family, unit, value type and what they need. Fixed values.
REGISTRY = {
    "occurrence": Metric("persistence", "percent", "raster_summary", frozenset({"validity"})),
    "refuge_area": Metric("persistence", "km2", "raster_summary", frozenset({"validity"})),
    "apsec": Metric("extent", "percent"),
    "number_of_pools": Metric("fragmentation", "count", needs=frozenset({"patches"})),
    "lpi": Metric("fragmentation", "percent", needs=frozenset({"patches"})),
    "awre": Metric("morphology", "dimensionless", needs=frozenset({"patches"})),
    "awmsi": Metric("morphology", "dimensionless", needs=frozenset({"patches"})),
    "recurrence": Metric("persistence", "percent", "raster_summary", frozenset({"validity"})),
    "hydroperiod": Metric("persistence", "fraction", "raster_summary", frozenset({"validity"})),
    "extent_contraction": Metric("dynamics", "percent_per_month", "HY_summary", frozenset({"HY_anchor", "dual_composite"})),
    "reconnection_timing": Metric("dynamics", "month", "HY_summary", frozenset({"HY_anchor"})),
    "refuge_spatial_stability": Metric("dynamics", "dimensionless", "HY_summary", frozenset({"HY_anchor"})),
    "lpsec": Metric("extent", "percent", needs=frozenset({"channel"})),
    "inter_pool_gap": Metric("clustering", "km", needs=frozenset({"channel"})),
    "mesh": Metric("fragmentation", "m2", needs=frozenset({"patches", "mesh_validation"})),
    "pool_width": Metric("morphology", "m", needs=frozenset({"patches", "width_floor"})),
    "realised_connectivity": Metric("connectivity", "dimensionless", needs=frozenset({"fixed_nodes", "graph"})),
    "tcf": Metric("connectivity", "percent", needs=frozenset({"fixed_nodes", "graph", "validity"})),
}
#: Which metrics a profile stands for, in order. Fixed values.
PROFILES = {
    "contracts_core": ("occurrence", "refuge_area", "apsec", "number_of_pools", "lpi", "awre", "awmsi"),
    "pixel_temporal": ("recurrence", "hydroperiod"),
    "dynamics": ("extent_contraction",),
    "channel": ("lpsec", "inter_pool_gap"),
    "secondary": ("mesh", "pool_width"),
    "connectivity": ("realised_connectivity", "tcf"),
}
#: Ids of the legacy library that the long table refuses. Fixed values.
FORBIDDEN = ("pf", "plf", "awmpa", "awmpl", "awmpw", "pcf", "nni", "degree_centrality", "betweenness_centrality")
#: Registered metrics and this library's own ones.
METRICS = REGISTRY | {
    "rc_edge": Metric("connectivity", "percent", needs=frozenset({"reaches"})),
    "rc_pair": Metric("connectivity", "percent", needs=frozenset({"reaches"})),
    "dci": Metric("connectivity", "percent", needs=frozenset({"reaches"})),
}


def plan(profiles: list[str], available: set[str], add: list[str] = (), remove: list[str] = ()) -> tuple[list[str], dict[str, str]]:
    """(metrics to make, in the profiles' order and once each; reasons of those left out), after additions and removals."""
    unknown = [p for p in profiles if p not in PROFILES] + [m for m in (*add, *remove) if m not in REGISTRY]
    if unknown:
        raise ValueError(f"no metric or profile: {', '.join(unknown)}")
    chosen = [m for m in dict.fromkeys([m for p in profiles for m in PROFILES[p]] + list(add)) if m not in remove]
    lacking = {m: sorted(REGISTRY[m].needs - available) for m in chosen}
    return [m for m in chosen if not lacking[m]], {m: "needs " + ", ".join(x) for m, x in lacking.items() if x}


def resolve(wanted: list[str], available: set[str]) -> tuple[list[str], dict[str, str]]:
    """(metrics to make, in order and once each; reasons of those left out). A family's name stands for all its metrics."""
    chosen: list[str] = []
    for name in wanted:
        of = [m for m, spec in METRICS.items() if spec.family == name] or [name]
        if of == [name] and name not in METRICS:
            raise ValueError(f"no such metric or family: {name}")
        chosen += [m for m in of if m not in chosen]
    skipped = {m: "needs " + ", ".join(sorted(METRICS[m].needs - available)) for m in chosen if METRICS[m].needs - available}
    return [m for m in chosen if m not in skipped], skipped
