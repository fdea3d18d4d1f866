"""Values that must be exactly these for results to match.

Everything in this file is a fixed value: input column names, metric lists in
their defined order, thresholds, the remediation action list and the default
texts.  No logic lives here.
"""

# Input column name -> canonical column name (dots break column resolution).
SOURCE_COLUMNS = {
    "DRB.UEThpDl": "thp_dl",
    "DRB.UEThpUl": "thp_ul",
    "RRU.PrbTotDl": "prb_dl",
    "RRU.PrbTotUl": "prb_ul",
    "RRC.ConnEstabSucc.Sum": "rrc_succ",
    "RRC.ConnEstabAtt.Sum": "rrc_att",
    "DRB.UECqiDl": "cqi_dl",
    "DRB.UEBlerDl": "bler_dl",
    "SM.PDUSessionSetupSucc": "pdu_succ",
    "QF.EstabSuccNbr": "qf_succ",
    "PEE.AvgPower": "avg_power",
    "Viavi.PEE.EnergyEfficiency": "energy_eff",
    "Viavi.Slice.MinPrb": "min_prb",
    "Viavi.Slice.MaxPrb": "max_prb",
    "RRC_SuccRate": "rrc_rate",
    "timestamp": "ts",
}

RAW_KPIS = [
    "thp_dl", "thp_ul", "prb_dl", "prb_ul", "rrc_succ", "rrc_att", "cqi_dl",
    "bler_dl", "pdu_succ", "qf_succ", "avg_power", "energy_eff", "min_prb", "max_prb",
]
RATE_KPI = "rrc_rate"
KPIS = RAW_KPIS + [RATE_KPI]

# KPIs that get a percent-deviation feature.
DELTA_KPIS = [
    "thp_dl", "thp_ul", "prb_dl", "prb_ul", "cqi_dl", "bler_dl",
    "rrc_rate", "avg_power", "energy_eff",
]
DELTA_SUFFIX = "__delta_pct"

# Order matters: it breaks ties between equal deviations.
FINGERPRINT_METRICS = [
    "bler_dl", "cqi_dl", "thp_dl", "prb_dl", "rrc_rate", "energy_eff", "avg_power",
]
VERIFY_METRICS = ["bler_dl", "cqi_dl", "thp_dl", "prb_dl", "rrc_rate", "energy_eff"]
SAMPLE_METRICS = ["bler_dl", "cqi_dl", "thp_dl", "prb_dl", "rrc_rate"]

# +1: higher is better, -1: lower is better; prb_dl has no polarity.
POLARITY = {"bler_dl": -1, "cqi_dl": 1, "thp_dl": 1, "rrc_rate": 1, "energy_eff": 1}

EPSILON = 1e-9
TOP_SIGNALS = 8
TOP_ATTRIBUTIONS = 5
SEVERITY_LOW = 0.1
SEVERITY_MEDIUM = 0.3

# Diagnosis thresholds, percent deviation from the entity baseline.
BLER_UP = 30.0
CQI_DOWN = -20.0
PRB_UP = 25.0
THP_DOWN = -20.0
RRC_DOWN = -10.0
EFF_DOWN = -20.0
POWER_UP = 10.0
CAUSE_CONFIDENCE = {
    "interference": 0.8,
    "high_load": 0.75,
    "connection_failure": 0.7,
    "power_anomaly": 0.7,
    "low_throughput": 0.65,
    "inconclusive": 0.5,
}

# Evidence of a cause, in order: a label that its deviation follows, or a plain sentence.
EVIDENCE = {
    "interference": [("BLER up", "bler_dl"), ("CQI down", "cqi_dl"), ("PRB not high", None)],
    "high_load": [("DL PRB up", "prb_dl"), ("Throughput down", "thp_dl")],
    "connection_failure": [("RRC success rate down", "rrc_rate")],
    "power_anomaly": [("Energy efficiency down", "energy_eff")],
    "low_throughput": [("Throughput down", "thp_dl"), ("Load not high", None)],
}
EVIDENCE_DRIVERS = "SHAP top drivers: "

# action id, parameter names, reversible, risk, description
ACTIONS = [
    ("scheduler_protection", ["cell", "on"], True, "low",
     "Enable/disable scheduler protection for interference mitigation"),
    ("tilt_neighbor", ["neighbor", "delta_db"], True, "low",
     "Adjust antenna tilt of neighbor cell"),
    ("enable_load_balancing", ["cluster", "cio_delta_db"], True, "low",
     "Enable load balancing with CIO adjustment"),
    ("raise_prb_cap", ["cell", "delta"], True, "low",
     "Increase PRB capacity limit"),
    ("restart_signaling_stack", ["cell"], True, "medium",
     "Restart signaling stack"),
    ("check_backhaul", ["cell"], False, "low",
     "Verify backhaul connectivity"),
    ("limit_tx_power", ["cell", "preset"], True, "medium",
     "Limit transmission power"),
    ("soft_reset_rru", ["cell"], True, "medium",
     "Soft reset of Remote Radio Unit"),
    ("adjust_scheduler_weights", ["cell", "profile"], True, "low",
     "Adjust scheduler weights"),
    ("reduce_tx_power", ["cell", "delta_db"], True, "low",
     "Reduce transmission power"),
    ("handover_parameters", ["cell", "threshold_delta"], True, "low",
     "Adjust handover thresholds"),
]
RISK_RANK = {"low": 1, "medium": 2, "high": 3}
MAX_PLAN_ACTIONS = 3
MAX_BLAST_RADIUS = 3
REQUIRE_CHANGE_WINDOW = True
AUTO_ROLLBACK = True
MANUAL_INTERVENTION = "medium"

DEFAULT_PRECHECKS = ["no critical alarms", "within change window"]
DEFAULT_SLA_MINUTES = 15
DEFAULT_SLA_CRITERIA = "all_postchecks_green"

ISSUE_BASIC_CHECK = "Basic check only - LLM unavailable"
ISSUE_BAD_RESPONSE = "LLM response format error"

REQUIRED_LEARNING_KEYS = ["case_id", "pattern", "solution", "learning", "citation"]
REQUIRED_VERDICT_KEYS = ["closed", "checks"]
REQUIRED_SIGNAL_KEYS = ["metric", "value", "baseline", "delta_pct", "dir"]

# Similarity score = overlap * 0.6 + cause * 0.4, kept when strictly above 0.3.
SIMILARITY_OVERLAP_WEIGHT = 0.6
SIMILARITY_CAUSE_WEIGHT = 0.4
SIMILARITY_OTHER_CAUSE = 0.3
SIMILARITY_MIN_SCORE = 0.3
RECOMMEND_MIN_CONFIDENCE = 0.5

# First family whose words occur in the lower-cased model id.
MODEL_FAMILIES = [
    ("claude", ["anthropic", "claude"]),
    ("nova", ["nova"]),
    ("titan", ["titan"]),
]
UNKNOWN = "unknown"
EMPTY_HISTORY = "No conversation history"
