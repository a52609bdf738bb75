"""Fixed values shared by every operator.

The lists, codes and limits below are data contracts: they name columns, code
samples or bound inputs, and must keep exactly these values so that tables
written by different producers stay comparable.
"""

from __future__ import annotations

import math

# --- fixed values: leptons, momenta and levels ------------------------------
LEPTONS = ("electron_minus", "electron_plus", "muon_minus", "muon_plus")
MOMENTUM = ("px", "py", "pz", "E")
LEVELS = ("lhe", "dressed", "reco")
PDG_OF_LEPTON = {
    "electron_minus": 11,
    "electron_plus": -11,
    "muon_minus": 13,
    "muon_plus": -13,
}
LEPTON_MASS_GEV = {"electron": 0.00051099895, "muon": 0.1056583755}
LEPTON_PAIRS = tuple(
    (a, b) for i, a in enumerate(LEPTONS) for b in LEPTONS[i + 1 :]
)

# --- fixed values: per-level output fields, in table order -------------------
PROJECTION_FIELDS = (
    "raw_m4l",
    "born_m4l",
    "raw_y4l",
    "born_y4l",
    "raw_pt4l",
    "born_pt4l",
)
ANGULAR_FIELDS = (
    "m_Z1",
    "m_Z2",
    "m_ZZ",
    "y_ZZ",
    "pt_ZZ",
    "theta1",
    "phi1",
    "cos_theta1",
    "theta2",
    "phi2",
    "cos_theta2",
    "cos_theta_star",
    "abs_cos_theta_star",
    "theta1_standard",
    "theta2_standard",
    "Phi_standard",
    "Phi1_standard",
    "Psi_standard",
)
# Spark and most SQL engines fold case, so Phi1 and phi1 cannot share a table.
# These three carry a suffix here; `exact_names` restores the published names
# in a case-sensitive session.
PUBLISHED_ANGLE_NAMES = {
    "Phi_standard": "Phi",
    "Phi1_standard": "Phi1",
    "Psi_standard": "Psi",
}
DEGENERACY_FLAGS = ("frame_degenerate", "standard_angles_degenerate")
COUNT_FIELDS = (
    "n_electron_minus",
    "n_electron_plus",
    "n_muon_minus",
    "n_muon_plus",
    "n_electrons",
    "n_muons",
)

# --- fixed values: status codes, samples and channels ------------------------
STATUS_VALID = 0
STATUS_INVALID_TOPOLOGY = 1
STATUS_PROJECTION_FAILED = 2
SAMPLE_CODES = {
    "gg4l": 0,
    "qqZZ": 1,
    "gg4l_h": 2,
    "gg4l_b": 3,
    "vpolar_LL": 10,
    "vpolar_TT": 11,
    "vpolar_TL": 12,
    "vpolar_LT": 13,
}
CHANNELS = ("LL", "TT", "TL", "LT")
CHANNEL_CODES = {name: code for code, name in enumerate(CHANNELS)}
COMPONENTS = ("00_20", "20_20", "mixed_incoherent")
COMPONENT_WEIGHT_COLUMNS = {
    "00_20": "weight_polcomb_00_20_pb",
    "20_20": "weight_polcomb_20_20_pb",
    "mixed_incoherent": "weight_mixed_incoherent_pb",
}
# coefficient of each source channel in each component
COMBINATION_COEFFICIENTS = {
    "00_20": {
        "LL": -math.sqrt(2.0 / 5.0),
        "TT": 1.0 / math.sqrt(10.0),
        "TL": -1.0 / (2.0 * math.sqrt(10.0)),
        "LT": -1.0 / (2.0 * math.sqrt(10.0)),
    },
    "20_20": {"LL": 1.0 / 5.0, "TT": 1.0 / 20.0, "TL": -1.0 / 10.0, "LT": -1.0 / 10.0},
    "mixed_incoherent": {"LL": 0.0, "TT": 0.0, "TL": 1.0, "LT": 1.0},
}

# --- fixed values: harmonic components (slug, label, l1, m1, l2, m2) ----------
HARMONIC_COMPONENTS = (
    ("00_20", "(0,0;2,0)", 0, 0, 2, 0),
    ("20_20", "(2,0;2,0)", 2, 0, 2, 0),
    ("2m1_2p1", "(2,-1;2,1)", 2, -1, 2, 1),
    ("2m2_2p2", "(2,-2;2,2)", 2, -2, 2, 2),
)
HARMONIC_SLUGS = tuple(row[0] for row in HARMONIC_COMPONENTS)
BASIS_SLUGS = ("00_00", *HARMONIC_SLUGS)

# --- fixed values: technical weights and contracts ---------------------------
MARKER_ID = "AUX_OAP_EVENT_ID"
MARKER_UNIT = "AUX_OAP_EVENT_UNIT"
NORMALIZATION_CONTRACT = "idwtup-minus4-sample-mean-v1"
MATCH_CONTRACT = "named-weight-id-v1"
NOMINAL_UNITS = "pb"
WEIGHTING_STRATEGY = -4

# --- fixed values: limits and tolerances -------------------------------------
MAX_SOURCE_EVENT_ID = 1_000_000
MAX_EVENTS_PER_JOB = 100_000
ID_RELATIVE_TOLERANCE = 5.0e-8
ID_ABSOLUTE_TOLERANCE = 1.0e-7
LUMINOSITY_PB_INVERSE = 312000.0
ANALYSIS_SCHEMA_VERSION = 2
MERGE_SCHEMA_VERSION = 2
COMPOSITION_SCHEMA_VERSION = 1
EPS = 2.0**-52

JOB_KEY = ("campaign_id", "sample_code", "job_id")
EVENT_KEY = (*JOB_KEY, "source_event_id")
IDENTITY = (
    "campaign_id",
    "sample_code",
    "job_id",
    "lhe_event_index",
    "source_event_id",
    "event_uid_hi",
    "event_uid_lo",
)


def momentum_column(level: str, frame: str, lepton: str, component: str) -> str:
    return f"{level}_{frame}_{lepton}_{component}"


def momentum_columns(level: str, frame: str) -> list[str]:
    return [momentum_column(level, frame, k, c) for k in LEPTONS for c in MOMENTUM]
