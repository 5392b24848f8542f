"""Clinical vocabulary the plans are composed with.

Operators never import this module; only ``anchorage.plans`` does.
"""

from dataclasses import dataclass, field

# --- fixed values: item codes, feature names and their order, label, category codes ---

LAB_CODES = {
    "glucose": [50809, 50931],
    "lactate": [50813],
    "creatinine": [50912],
}
# blood_pressure pools the emergency-department systolic reading with the
# bedside non-invasive mean (220181); kept as a mapping so it can be changed.
CHART_CODES = {
    "heart_rate": [220045],
    "blood_pressure": [220181],
    "resp_rate": [220210],
    "temp_f": [223761],
    "spO2": [220277],
}
ED_COLUMNS = {
    "heart_rate": "heartrate",
    "blood_pressure": "sbp",
    "resp_rate": "resprate",
    "temp_f": "temperature",
    "spO2": "o2sat",
}
LABS = ["glucose", "lactate", "creatinine"]
VITALS = ["heart_rate", "blood_pressure", "resp_rate", "temp_f", "spO2"]
MANDATORY = ["gender", "age", "hospital_expire_flag"]
GENDER_CODES = {"M": 0, "F": 1}
LABEL = "hospital_expire_flag"
FRONTAL_VIEWS = ["AP", "PA"]
POSITIVE_WEIGHT = 5160 / 936
SPLIT_FRACTIONS = {"train": 0.80, "val": 0.18, "test": 0.02}
SPLIT_SEED = 42

# --- derived from the fixed values ---

CORE = LABS + VITALS
# labs are ordered min, max, mean; vitals mean, min, max
MEASUREMENTS = [f"{f}_{s}" for f in LABS for s in ("min", "max", "mean")] + [
    f"{f}_{s}" for f in VITALS for s in ("mean", "min", "max")
]
INDICATORS = [f"{f}_missing" for f in CORE]
CONTINUOUS = ["age"] + MEASUREMENTS
FEATURE_ORDER = ["gender", "age"] + MEASUREMENTS + INDICATORS


@dataclass(frozen=True)
class Lookback:
    """Window before the anchor time, both ends inclusive."""

    hours: int = 24
    pick: str = "closest"


@dataclass(frozen=True)
class Tables:
    """The input DataFrames, whatever catalog or path they came from."""

    icustays: object
    admissions: object
    patients: object
    labevents: object
    chartevents: object
    vitalsign: object
    cxr_meta: object
    lookback: Lookback = field(default_factory=Lookback)
