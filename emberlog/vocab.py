"""Vocabularies, lookup rows, texts and schemas the results depend on."""

from __future__ import annotations

# --- fixed values: log lines -------------------------------------------------
LEVELS = ["INFO", "WARN", "ERROR", "FATAL", "DEBUG"]
ALWAYS_KEPT_LEVELS = ["WARN", "ERROR", "FATAL"]
DEFAULT_LEVEL = "INFO"
DEFAULT_COMPONENT = "unknown"
INFORMATIVE_KEYWORDS = [
    "retry", "slow", "timeout", "fail", "exception", "terminating", "unable",
    "refused", "exceeded", "corrupt", "denied", "backlog", "lag", "waiting",
    "dropped", "disconnect", "unreachable", "exhausted", "thrott",
]

# --- fixed values: label rules -----------------------------------------------
SEVERITIES = ["SEV-1", "SEV-2", "SEV-3"]
CRITICAL_KEYWORDS = ["exception", "fatal", "error", "failed"]
NETWORK_KEYWORDS = ["timeout", "refused", "unreachable", "disconnect"]
DEGRADATION_KEYWORDS = ["slow", "lag", "backlog", "thrott"]
SERVING_PHRASE = "exception while serving"
OVERRIDE_PHRASE = "got exception while serving"

BLOCK_SERVING = "Block serving exception"
NETWORK = "Network connectivity issue"
DEGRADATION = "Service degradation"
PACKET_RESPONDER = "Packet responder termination"
DEFAULT_CAUSE = "HDFS operational event"

ACTIONS = {
    BLOCK_SERVING: "Investigate DataNode block serving failures and check network connectivity between nodes",
    PACKET_RESPONDER: "Monitor DataNode for abnormal packet responder patterns; verify normal block replication",
    NETWORK: "Check network configuration and firewall rules; verify DataNode-NameNode connectivity",
    DEGRADATION: "Review system resources (CPU, memory, disk I/O); check for performance bottlenecks",
    DEFAULT_CAUSE: "Monitor cluster health metrics; no immediate action required unless pattern persists",
}
DEFAULT_ACTION = "Review incident logs and correlate with cluster metrics"
# the repair path only knows these two causes
REPAIR_CAUSES = [PACKET_RESPONDER, BLOCK_SERVING]

# --- fixed values: prompt text -----------------------------------------------
INCIDENT_MARKER = "Incident:\n"
REQUIREMENTS_MARKER = "\n\nSTRICT REQUIREMENTS:"
EMPTY_SEVERITY_SLOT = '"severity": ""'
PROMPT_HEAD = (
    "You are an incident triage assistant.\n"
    "Fill in the JSON template below using the incident information.\n"
    "\n"
    "JSON:\n"
    "{\n"
    '  "severity": "",\n'
    '  "likely_cause": "",\n'
    '  "recommended_action": ""\n'
    "}\n"
    "\n"
    "Incident:\n"
)
PROMPT_TAIL = (
    "\n"
    "\n"
    "STRICT REQUIREMENTS:\n"
    "- Return a SINGLE JSON object only. No extra text.\n"
    '- Use ONLY standard ASCII double quotes ("). Do NOT use smart quotes.\n'
    "- Do NOT use parentheses for values.\n"
    "- Do NOT stop early. Ensure recommended_action is present and non-empty.\n"
    '- severity must be exactly "SEV-1" or "SEV-3"\n'
    '- likely_cause must be exactly "Packet responder termination" OR "Block serving exception"\n'
    "\n"
    "Output ONLY the completed JSON:\n"
)

# --- fixed values: model output repair ---------------------------------------
FIELDS = ["severity", "likely_cause", "recommended_action"]
UNKNOWN = "UNKNOWN"
UNKNOWN_FIELD = "UNKNOWN (model output incomplete)"
EXTRACTED_SEVERITIES = ["1", "3"]
STATUS_MISSING = "⚠ FORMAT WARNING: Missing required keys"
STATUS_INCOMPLETE = "⚠ FORMAT WARNING: Incomplete fields"
STATUS_BAD_SEVERITY = "⚠ FORMAT WARNING: Invalid severity format"
STATUS_REPAIRED = "✓ FORMAT OK (auto-repaired)"
STATUS_OK = "✓ FORMAT OK"
CONFIDENCE_HIGH = "High (Valid JSON)"
CONFIDENCE_MEDIUM = "Medium (Auto-repaired)"
NOT_AVAILABLE = "N/A"
EMPTY_INPUT_HINT = "Please enter incident logs"

# what each policy writes into a field that could not be recovered
FILL_VALUES = {
    "mark": [UNKNOWN_FIELD, UNKNOWN_FIELD, UNKNOWN_FIELD],
    "default": ["SEV-3", DEFAULT_CAUSE, DEFAULT_ACTION],
    "blank": ["", "", ""],
}

# --- fixed values: tuning configurations -------------------------------------
CONFIGS = [
    # name, learning rate, batch size, epochs
    ("Config A (Baseline)", 5e-5, 4, 3),
    ("Config B (Lower LR)", 2e-5, 4, 3),
    ("Config C (Higher Capacity)", 5e-5, 2, 5),
]
BASELINE_CONFIG = CONFIGS[0][0]
BEST_CONFIG = CONFIGS[2][0]

# --- fixed values: characters that count as white space in text --------------
WHITESPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

# --- schemas -----------------------------------------------------------------
LINE_SCHEMA = "source string, seq bigint, line string"
INCIDENT_SCHEMA = (
    "incident_id string, service string, lines array<string>, incident_text string, "
    "stats struct<levels_count: map<string,bigint>, top_components: map<string,bigint>>"
)
PAIR_SCHEMA = "prompt string, response string"
LABEL_SCHEMA = "severity string, likely_cause string, recommended_action string"
