"""The registered queries restated in SQL, as chains of named common table expressions."""

from __future__ import annotations

from emberlog import vocab


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_of(column: str, needles: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {lit(n)})" for n in needles) + ")"


WS = lit(vocab.WHITESPACE)
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
LEVEL = r"\b(?:INFO|WARN|ERROR|FATAL|DEBUG)\b"
IPV4 = r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def level(x: str) -> str:
    return f"coalesce(nullif(regexp_extract({x}, '({LEVEL})', 1), ''), 'INFO')"


def component(x: str) -> str:
    return rf"coalesce(nullif(regexp_extract({x}, '\b(dfs\.\w+|\w+\.\w+)\b', 1), ''), 'unknown')"


def message(x: str) -> str:
    return strip(
        f"CASE WHEN regexp_matches({x}, '{LEVEL}') "
        f"THEN regexp_extract({x}, '(?s){LEVEL}\\s*:*\\s*(.*)$', 1) ELSE {x} END"
    )


MASKS = {
    "lowercase": lambda x: f"lower({x})",
    "strip_timestamp": lambda x: rf"regexp_replace({x}, '^\d{{6}}\s+\d{{6}}\s+\d+\s*', '')",
    "mask_block_id": lambda x: rf"regexp_replace({x}, 'blk_-?\d+', 'blk_<ID>', 'g')",
    "mask_ip_port": lambda x: rf"regexp_replace({x}, '{IPV4}:\d+\b', '<IP:PORT>', 'g')",
    "mask_ip": lambda x: rf"regexp_replace({x}, '{IPV4}\b', '<IP>', 'g')",
    "mask_size": lambda x: rf"regexp_replace({x}, '\bsize\s+\d+\b', 'size <SIZE>', 'g')",
    "collapse_whitespace": lambda x: strip(f"regexp_replace({x}, '{SPACE}+', ' ', 'g')"),
}


def normalized(x: str) -> str:
    for mask in MASKS.values():
        x = mask(x)
    return x


def service(x: str) -> str:
    return (
        f"CASE WHEN contains(lower({x}), 'datanode') THEN 'hdfs-datanode' "
        f"WHEN contains(lower({x}), 'namenode') OR contains(lower({x}), 'namesystem') "
        "THEN 'hdfs-namenode' ELSE 'hdfs' END"
    )


def actions(x: str, causes: list[str]) -> str:
    arms = " ".join(f"WHEN {lit(c)} THEN {lit(vocab.ACTIONS[c])}" for c in causes)
    return f"CASE {x} {arms} ELSE {lit(vocab.DEFAULT_ACTION)} END"


def response(sev: str, cause: str, action: str) -> str:
    return (
        f"""'{{"severity": "' || {sev} || '", "likely_cause": "' || {cause} """
        f"""|| '", "recommended_action": "' || {action} || '"}}'"""
    )


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


def with_sql(final: str, *deps: str) -> str:
    """``final`` behind the WITH chain its dependencies need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in CTES[name][0]:
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for dep in deps:
        visit(dep)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + final


# --- lines -------------------------------------------------------------------
cte(
    "log_lines",
    [],
    """
    SELECT CAST(user_id % 8 AS VARCHAR) AS source, event_id AS seq,
      concat(100000 + event_id % 900000, ' 203615 ', user_id, ' ',
        CASE WHEN event_type = 'error' AND (event_id // 200) % 4 = 1
               THEN 'WARN dfs.DataNode$DataXceiver: 10.250.'
             WHEN event_type = 'error' AND (event_id // 200) % 4 = 2
               THEN 'WARN dfs.FSNamesystem: slow response from 10.250.'
             WHEN event_type = 'error' AND (event_id // 200) % 4 = 3 AND value > 60
               THEN 'ERROR dfs.NameNode: timeout reaching 10.250.'
             WHEN event_type = 'purchase'
               THEN 'INFO dfs.FSNamesystem: BLOCK* NameSystem.addStoredBlock: blockMap updated: 10.251.'
             WHEN event_type = 'click'
               THEN 'DEBUG dfs.DataBlockScanner: Verification succeeded for 10.251.'
             ELSE 'INFO dfs.DataNode$PacketResponder: PacketResponder 1 for block terminating 10.251.'
        END,
        user_id % 250, '.', event_id % 250, ':50010',
        CASE WHEN event_type = 'error' AND (event_id // 200) % 4 = 1
             THEN ':Got exception while serving blk_-' ELSE ' blk_' END,
        event_id * 7919, ' size ', event_id % 1000) AS line
    FROM events""",
)
cte(
    "doc_lines",
    [],
    """
    SELECT CAST(doc_id AS VARCHAR) AS source, i - 1 AS seq, parts[i] AS line
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
          FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))""",
)
cte(
    "all_lines",
    ["log_lines", "doc_lines"],
    """
    SELECT 'log-' || source AS source, seq, line FROM log_lines
    UNION ALL SELECT 'doc-' || source, seq, line FROM doc_lines""",
)
cte(
    "parsed",
    ["log_lines"],
    f"""
    SELECT source, seq, line, {level('line')} AS level, {component('line')} AS component,
      {message('line')} AS message FROM log_lines""",
)
cte(
    "kept",
    ["parsed"],
    f"""
    SELECT source, seq, level, component, {normalized('line')} AS normalized,
      row_number() OVER (PARTITION BY source ORDER BY seq) - 1 AS pos
    FROM parsed
    WHERE level IN ('WARN', 'ERROR', 'FATAL')
       OR {any_of('lower(message)', vocab.INFORMATIVE_KEYWORDS)}""",
)




def window_body(size: int, stride: int) -> str:
    """Lines with the number of every full window that covers them."""
    first = f"greatest(0, CAST(floor((pos - {size}) / {stride}.0) AS BIGINT) + 1)"
    return f"""
    SELECT source, win, pos, level, component, normalized
    FROM (SELECT *, count(*) OVER (PARTITION BY source, win) AS n
          FROM (SELECT *, unnest(range({first}, pos // {stride} + 1)) AS win FROM kept))
    WHERE n = {size}"""


cte("wl", ["kept"], window_body(8, 4))
cte("wl_gap", ["kept"], window_body(3, 5))
cte("wl_dense", ["kept"], window_body(8, 1))
cte(
    "comp_rank",
    ["wl"],
    """
    SELECT *, row_number() OVER (PARTITION BY source, win ORDER BY n DESC, first_pos) AS place
    FROM (SELECT source, win, component, count(*) AS n, min(pos) AS first_pos
          FROM wl GROUP BY source, win, component)""",
)
cte(
    "win_text",
    ["wl", "comp_rank"],
    f"""
    SELECT w.source, w.win, {service('c.component')} AS service, w.body, w.warn, w.bad,
      'service: ' || {service('c.component')} || chr(10) || w.body AS incident_text
    FROM (SELECT source, win, string_agg(normalized, chr(10) ORDER BY pos) AS body,
            count(*) FILTER (level = 'WARN') AS warn,
            count(*) FILTER (level IN ('ERROR', 'FATAL')) AS bad
          FROM wl GROUP BY source, win) w
    JOIN comp_rank c ON c.source = w.source AND c.win = w.win AND c.place = 1""",
)
cte(
    "windows",
    ["win_text"],
    "SELECT *, substr(sha1(incident_text), 1, 12) AS incident_id FROM win_text",
)


def labelled_body(table: str) -> str:
    low = "lower(incident_text)"
    sev = (
        f"CASE WHEN bad > 0 OR warn >= 4 OR {any_of(low, vocab.CRITICAL_KEYWORDS)} THEN 'SEV-1' "
        "WHEN warn >= 2 THEN 'SEV-2' ELSE 'SEV-3' END"
    )
    cause = (
        f"CASE WHEN contains({low}, {lit(vocab.SERVING_PHRASE)}) THEN {lit(vocab.BLOCK_SERVING)} "
        f"WHEN {any_of(low, vocab.NETWORK_KEYWORDS)} THEN {lit(vocab.NETWORK)} "
        f"WHEN {any_of(low, vocab.DEGRADATION_KEYWORDS)} THEN {lit(vocab.DEGRADATION)} "
        f"WHEN contains({low}, 'packetresponder') AND contains({low}, 'terminating') "
        f"THEN {lit(vocab.PACKET_RESPONDER)} ELSE {lit(vocab.DEFAULT_CAUSE)} END"
    )
    action = actions("likely_cause", list(vocab.ACTIONS))
    return f"""
    SELECT *, {lit(vocab.PROMPT_HEAD)} || incident_text || {lit(vocab.PROMPT_TAIL)} AS prompt,
      {response('severity', 'likely_cause', 'recommended_action')} AS response
    FROM (SELECT *, {action} AS recommended_action
          FROM (SELECT *, {sev} AS severity, {cause} AS likely_cause FROM {table}))"""


cte(
    "incidents",
    ["windows"],
    """
    SELECT * EXCLUDE (place) FROM (
      SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY source, win) AS place
      FROM windows) WHERE place = 1""",
)

#: Sources stop early here, the first one after an eighth of the events.
cte(
    "early",
    ["kept"],
    """
    SELECT k.source, e.ts::TIMESTAMP AS ts
    FROM kept k JOIN events e ON k.seq = e.event_id,
      (SELECT min(event_id) AS low, max(event_id) AS high FROM events)
    WHERE (e.event_id - low) / (high - low + 1) <= (k.source::BIGINT + 1) / 8""",
)
#: The windows come in runs of one hour each, those of two sources in three one or two runs late.
cte(
    "late_feed",
    ["windows"],
    """
    SELECT source, source || '/' || incident_id AS incident_id, hour, hour + source::BIGINT % 3 AS run
    FROM (SELECT *, (win * 5 // (max(win) OVER () + 1))::BIGINT AS hour FROM windows)""",
)
#: Rows of ``late_feed`` that were not behind the watermark, with the latest hour of earlier runs.
cte(
    "late_marks",
    ["late_feed"],
    "SELECT run, max(max(hour)) OVER (ORDER BY run) AS latest FROM late_feed GROUP BY run",
)
cte(
    "late_facts",
    ["late_feed", "late_marks"],
    """
    SELECT f.*, before, coalesce(hour <= before - 1, false) AS late
    FROM late_feed f JOIN (
      SELECT r.run, max(m.latest) AS before FROM late_marks r LEFT JOIN late_marks m ON m.run < r.run GROUP BY r.run
    ) USING (run)""",
)
cte("all_labelled", ["windows"], labelled_body("windows"))
cte("labelled", ["incidents"], labelled_body("incidents"))


def splits_body(table: str) -> str:
    return f"""
    SELECT * EXCLUDE (place, total),
      CASE WHEN place < floor(total * CAST(0.7 AS DOUBLE)) THEN 'train'
           WHEN place < floor(total * CAST(0.7 AS DOUBLE)) + floor(total * CAST(0.15 AS DOUBLE))
             THEN 'val' ELSE 'test' END AS split
    FROM (SELECT *, count(*) OVER (PARTITION BY severity) AS total,
            row_number() OVER (PARTITION BY severity
              ORDER BY sha1(concat('42|', source, '|', win, '|', incident_id))) - 1 AS place
          FROM {table})"""


cte("splits", ["labelled"], splits_body("labelled"))
cte("all_splits", ["all_labelled"], splits_body("all_labelled"))

# --- model outputs -----------------------------------------------------------
CLEAN = response("severity", "likely_cause", "recommended_action")
KEY = '"recommended_action":'
RAW = f"""
    CASE kind WHEN 0 THEN clean
      WHEN 1 THEN replace(clean, '"', '`')
      WHEN 2 THEN regexp_replace(clean, '"([^"]*)"', '“\\1”', 'g')
      WHEN 3 THEN split_part(clean, '{KEY}', 1) || '{KEY}'
      WHEN 4 THEN concat('{{"severity": "', severity, '", "likely_cause": (', likely_cause,
                         '), "recommended_action": ("', recommended_action, '")}}')
      WHEN 5 THEN 'The incident shows unusual activity on several nodes.'
      WHEN 6 THEN 'Answer: ' || clean || ' done'
      ELSE CASE WHEN (win // 8) % 2 = 0
             THEN {response("CASE severity WHEN 'SEV-1' THEN 'SEV-3' ELSE 'SEV-1' END",
                            'likely_cause', 'recommended_action')}
             ELSE '{{"note": "n/a", ' || substr(clean, 2) END END"""
cte(
    "outputs",
    ["all_labelled"],
    f"""
    SELECT concat(source, '-', win) AS example_id, run, win, incident_text, {RAW} AS raw_output,
      response
    FROM (SELECT *, {CLEAN} AS clean, 'candidate' AS run, win % 8 AS kind FROM all_labelled
          UNION ALL
          SELECT *, {CLEAN}, 'baseline', CASE win % 8 WHEN 0 THEN 0 ELSE 5 END
          FROM all_labelled)""",
)


def parse_body(clean: str) -> str:
    """Candidate slice, parsed object and its three values."""
    return f"""
    SELECT *, json_extract_string(j, '$.severity') AS p1,
      json_extract_string(j, '$.likely_cause') AS p2,
      json_extract_string(j, '$.recommended_action') AS p3
    FROM (SELECT *, CASE WHEN json_valid(cand) AND starts_with(cand, '{{')
                    THEN CAST(cand AS JSON) END AS j
          FROM (SELECT *, CASE WHEN braces THEN regexp_extract(clean, '(?s)\\{{.*\\}}', 0)
                          ELSE clean END AS cand
                FROM (SELECT *, {clean} AS clean,
                        regexp_matches({clean}, '(?s)\\{{.*\\}}') AS braces FROM outputs)))"""


NORMAL = strip("translate(raw_output, '“”`‘’', '\"\"\"''''')")
AS_WRITTEN = strip("replace(raw_output, '`', '\"')")


def good(p: str) -> str:
    return f"coalesce({p} <> '' AND {strip(p)} <> '' AND NOT contains({p}, 'UNKNOWN'), false)"


VALID = " AND ".join(good(p) for p in ("p1", "p2", "p3"))
HAS_KEYS = "(p1 IS NOT NULL AND p2 IS NOT NULL AND p3 IS NOT NULL)"


def cleaned(x: str) -> str:
    head = f"""regexp_replace({strip(x)}, '^(?:\\(|\\)"|\\\\"|"|'')+', '')"""
    return strip(f"""regexp_replace({head}, '[)"'']+$', '')""")


ACTION_PATTERN = (
    r"""(?i)recommended_action["'']?\s*:?\s*["'']?\s*\(?\s*([^}\n]+)"""
)
FOUND_SEVERITY = (
    r"CASE WHEN regexp_matches(clean, '(?i)\bSEV-(1|3)\b') "
    r"THEN 'SEV-' || regexp_extract(clean, '(?i)\bSEV-(1|3)\b', 1) ELSE '' END"
)
FOUND_CAUSE = (
    f"CASE WHEN contains(lower(clean), 'block serving') THEN {lit(vocab.BLOCK_SERVING)} "
    f"WHEN contains(lower(clean), 'packet responder') THEN {lit(vocab.PACKET_RESPONDER)} ELSE '' END"
)
FOUND_ACTION_RAW = cleaned(f"regexp_extract(clean, '{ACTION_PATTERN}', 1)")
FOUND_ACTION = (
    f"CASE WHEN regexp_matches({FOUND_ACTION_RAW}, '[\\p{{L}}\\p{{Nd}}]') "
    f"THEN {FOUND_ACTION_RAW} ELSE '' END"
)
REPAIR_ACTION = actions("f2", vocab.REPAIR_CAUSES)


def repaired_body(parsed: str, policy: str, found_action: str = "''") -> str:
    fill = [lit(v) for v in vocab.FILL_VALUES[policy]]
    third = "f3" if policy == "blank" else f"CASE WHEN f3 = '' AND f2 <> '' THEN {REPAIR_ACTION} ELSE f3 END"
    ok = HAS_KEYS if policy == "blank" else f"({VALID})"
    return f"""
    SELECT example_id, run, win, incident_text, raw_output, response, clean, braces,
      CASE WHEN ok THEN p1 WHEN f1 = '' THEN {fill[0]} ELSE f1 END AS severity,
      CASE WHEN ok THEN p2 WHEN f2 = '' THEN {fill[1]} ELSE f2 END AS likely_cause,
      CASE WHEN ok THEN p3 WHEN g3 = '' THEN {fill[2]} ELSE g3 END AS recommended_action,
      CASE WHEN ok THEN len(list_distinct(json_keys(j))) ELSE 3 END AS n_keys,
      NOT ok AS was_repaired, (j IS NOT NULL AND braces) AS is_json
    FROM (SELECT *, {third} AS g3
          FROM (SELECT *, {ok} AS ok, {FOUND_SEVERITY} AS f1, {FOUND_CAUSE} AS f2,
                  {found_action} AS f3 FROM {parsed}))"""


def override_body(table: str) -> str:
    action = lit(vocab.ACTIONS[vocab.BLOCK_SERVING])
    return f"""
    SELECT * EXCLUDE (severity, likely_cause, recommended_action, hit), hit AS was_overridden,
      hit AND NOT (severity = 'SEV-1' AND likely_cause = {lit(vocab.BLOCK_SERVING)}
                   AND recommended_action = {action}) AS override_changed,
      CASE WHEN hit THEN 'SEV-1' ELSE severity END AS severity,
      CASE WHEN hit THEN {lit(vocab.BLOCK_SERVING)} ELSE likely_cause END AS likely_cause,
      CASE WHEN hit THEN {action} ELSE recommended_action END AS recommended_action
    FROM (SELECT *, contains(lower(incident_text), {lit(vocab.OVERRIDE_PHRASE)}) AS hit FROM {table})"""


cte("p_raw", ["outputs"], parse_body("raw_output"))
cte("p_norm", ["outputs"], parse_body(NORMAL))
cte("p_written", ["outputs"], parse_body(AS_WRITTEN))
cte("rep_mark", ["p_norm"], repaired_body("p_norm", "mark", FOUND_ACTION))
cte("rep_written", ["p_written"], repaired_body("p_written", "mark", FOUND_ACTION_RAW))
cte("rep_default", ["p_norm"], repaired_body("p_norm", "default"))
cte("rep_blank", ["p_norm"], repaired_body("p_norm", "blank"))
for _p in ("mark", "default", "blank"):
    cte(f"pred_{_p}", [f"rep_{_p}"], override_body(f"rep_{_p}"))
cte(
    "scored",
    ["pred_blank"],
    """
    SELECT *, severity = true_severity AS severity_ok, likely_cause = true_cause AS cause_ok,
      recommended_action = true_action AS action_ok,
      severity = true_severity AND likely_cause = true_cause
        AND recommended_action = true_action AND n_keys = 3 AS exact,
      severity <> '' AND likely_cause <> '' AND recommended_action <> ''
        AND NOT contains(severity || likely_cause || recommended_action, 'UNKNOWN') AS filled
    FROM (SELECT *, json_extract_string(response, '$.severity') AS true_severity,
            json_extract_string(response, '$.likely_cause') AS true_cause,
            json_extract_string(response, '$.recommended_action') AS true_action
          FROM pred_blank)""",
)

# --- tuning runs -------------------------------------------------------------
cte(
    "runs",
    ["splits"],
    """
    SELECT ord, config_name, learning_rate, batch_size, epochs,
      CAST(sum(sq) FILTER (split = 'train') AS BIGINT) / count(*) FILTER (split = 'train') / 10000 AS train_loss,
      CAST(sum(sq) FILTER (split = 'val') AS BIGINT) / count(*) FILTER (split = 'val') / 10000 AS val_loss,
      count(*) FILTER (split = 'train') * epochs / batch_size AS runtime_seconds
    FROM (SELECT c.*, split,
            (least(base + weight * warn, 95) - CASE severity WHEN 'SEV-1' THEN 100 ELSE 0 END)
            * (least(base + weight * warn, 95) - CASE severity WHEN 'SEV-1' THEN 100 ELSE 0 END) AS sq
          FROM splits, (VALUES
            (0, 'Config A (Baseline)', 5e-5, 4, 3, 20, 10),
            (1, 'Config B (Lower LR)', 2e-5, 4, 3, 35, 5),
            (2, 'Config C (Higher Capacity)', 5e-5, 2, 5, 5, 30))
            c(ord, config_name, learning_rate, batch_size, epochs, base, weight))
    GROUP BY ord, config_name, learning_rate, batch_size, epochs""",
)
