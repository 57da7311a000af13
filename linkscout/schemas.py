"""Fixed schemas and vocabularies of the data model."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Candidate sources in search order (fixed values).
CANDIDATE_TYPES = ("ospi", "re_asd", "re_mgt", "cci_sites")

CANDIDATES = {
    "site_id": "string", "candidate_type": "string", "id": "string", "cand_dist_km": "double",
    "long": "double", "lat": "double", "height": "double", "vertex": "string",
}

# Rank attributes by source, in output order (fixed values).
LIT_RANK = {
    "id": "string", "name": "string", "clli": "string", "street": "string", "city": "string", "state": "string",
    "structure": "string", "on_net_status": "string", "data_consistency": "string", "fcc_cnt": "long",
}
CCI_RANK = {
    "id": "string", "crown_ae": "string", "structure": "string", "revshare": "string", "name": "string",
    "open_levels": "string", "current_tower_capacity": "string", "last_sa_tia_code_revision": "string",
    "fiber_on_site": "string", "fiber_provider": "string", "is_cci_power_available": "string",
    "if_no_cci_power_is_meter_avail": "string", "power_company": "string", "active_apps_count_on_site": "int",
    "pt_id": "int", "poptier": "string", "street": "string", "city": "string", "site_county": "string",
    "state": "string", "score": "int",
}
ASD_RANK = {
    "id": "string", "uid2": "string", "name": "string", "street": "string", "city": "string", "state": "string",
    "structure": "string", "fi_dist": "double", "score": "int",
}
MGT_RANK = {
    "id": "string", "uid2": "string", "name": "string", "city": "string", "state": "string", "structure": "string",
    "fi_dist": "double",
}
RANKS = {"ospi": LIT_RANK, "re_asd": ASD_RANK, "re_mgt": MGT_RANK, "cci_sites": CCI_RANK}

# Sink field map (fixed values): output field and its width class. Names are lower case throughout.
SINK_FIELDS = {
    "fw_rank": "short", "candidate_type": "string", "id": "string", "cand_dist_km": "double", "long": "double",
    "lat": "double", "height": "short", "clearance_score": "string", "antenna": "string", "speed": "short",
    "d_km": "double", "link_margin": "double", "equipment": "string", "modulation": "string",
    "oxygen_attenuation_km": "double", "rain_attenuation_km": "double", "rain_attenuation_total": "double",
    "name": "string", "clli": "string", "street": "string", "city": "string", "state": "string",
    "structure": "string", "score": "double", "fcc_count": "int", "demand_1500m": "int", "demand_4000m": "int",
    "demand_8000m": "int", "crown_ae": "string", "revshare": "string", "s_hgt_no_appurt": "double",
    "open_levels": "string", "current_tower_capacity": "string", "last_sa_tia_code_revision": "string",
    "fiber_on_site": "string", "fiber_provider": "string", "is_cci_power_available": "string",
    "if_no_cci_power_is_meter_avail": "string", "power_company": "string", "active_apps_count_on_site": "double",
    "pt_id": "short", "poptier": "string", "site_county": "string", "tx_agl": "short", "uid2": "string",
    "fi_dist": "double", "status": "string", "data_consistent": "string",
}


# Sink fields that a run need not have: losses of replies that do not report them, demand counts, the tower's height, the
# status, and two fields that the rank tables hold under other names.
SINK_OPTIONAL = (
    "oxygen_attenuation_km", "rain_attenuation_km", "rain_attenuation_total", "fcc_count", "demand_1500m", "demand_4000m",
    "demand_8000m", "s_hgt_no_appurt", "status", "data_consistent",
)


def required(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The table as it is; raises if it lacks one of ``names``, as a NULL in its place would read like a value."""
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def conform(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Exactly the columns of ``schema``, cast; raises if one is missing."""
    return required(df, schema).select(*[F.col(c).cast(t).alias(c) for c, t in schema.items()])
