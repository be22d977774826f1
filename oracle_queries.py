"""SQL counterparts of the registered queries, for a second engine.

Written from the mapping of the test tables (FIXTURES.md, part 3) in plain
relational terms: window functions over whole sessions, joins and CASE. Nothing
is shared with the library but the wording of the judge prompt.
"""

from __future__ import annotations

from sessionlens.operators import judge

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
FIRST_RUN = "TIMESTAMP '2024-01-20 00:00:00'"
CUT = "TIMESTAMP '2024-01-17 00:00:00'"
IDLE = "INTERVAL 2 DAY"

_CTES = {
    "ev": """
        SELECT event_id, event_type, user_id, ts, epoch_us(ts) AS micros,
               'u' || user_id || '-w' || strftime(date_trunc('week', ts), '%Y%m%d') AS session_id,
               CAST(round(value * 100) AS BIGINT) AS cents,
               CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
               CASE WHEN CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 10 = 9 THEN 'modify'
                    WHEN CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 4 = 0 THEN 'reject'
                    ELSE 'accept' END AS decision
        FROM events""",
    "interactions": """
        SELECT session_id, arg_min(CAST(user_id AS VARCHAR), micros) AS user_id,
               count(*) AS num_interactions,
               make_timestamp(min(micros)) AS session_start,
               make_timestamp(max(micros + (cents // 100) * 1000000)) AS session_end,
               avg(k) AS avg_prompt_length,
               arg_min('v' || (k % 3), micros) AS service_version,
               arg_min('os' || (k % 2), micros) AS os_type,
               arg_min('t' || (k % 2), micros) AS terminal_type
        FROM ev WHERE event_type = 'signup' GROUP BY session_id""",
    "llm": """
        SELECT session_id, count(*) AS num_llm_requests,
               CAST(sum(cents // 10) AS BIGINT) AS total_input_tokens,
               CAST(sum(k * 5) AS BIGINT) AS total_output_tokens,
               CAST(sum(k * 3) AS BIGINT) AS total_cache_read,
               CAST(sum(k) AS BIGINT) AS total_cache_creation,
               avg(cents / 100.0) AS avg_ttft_ms, avg(cents / 10.0) AS avg_llm_duration_ms
        FROM ev WHERE event_type = 'view' GROUP BY session_id""",
    "tools": """
        SELECT session_id, count(*) AS num_tool_calls,
               count(DISTINCT k % 5) AS distinct_tools
        FROM ev WHERE event_type = 'purchase' GROUP BY session_id""",
    "executions": """
        SELECT session_id, count(*) AS num_tool_executions,
               count(*) FILTER (k % 10 <> 0) AS tool_successes
        FROM ev WHERE event_type = 'purchase' GROUP BY session_id""",
    "approvals": """
        SELECT session_id, count(*) AS num_blocked_on_user,
               count(*) FILTER (decision = 'accept') AS auto_accepted
        FROM ev WHERE event_type = 'click' GROUP BY session_id""",
    "costs": """
        SELECT session_id, sum(cents / 100000.0) AS total_cost_usd
        FROM ev WHERE event_type = 'view' GROUP BY session_id""",
    "tokens": """
        SELECT session_id, CAST(sum(cents // 10) AS DOUBLE) AS input_tokens,
               CAST(sum(k * 5) AS DOUBLE) AS output_tokens,
               CAST(sum(k * 3) AS DOUBLE) AS cache_read_tokens,
               CAST(sum(k) AS DOUBLE) AS cache_creation_tokens
        FROM ev WHERE event_type = 'view' GROUP BY session_id""",
    "active": """
        SELECT session_id,
               sum(CASE WHEN k % 2 = 1 THEN cents / 100.0 ELSE 0.0 END) AS active_time_cli_s,
               sum(CASE WHEN k % 2 = 0 THEN cents / 100.0 ELSE 0.0 END) AS active_time_user_s
        FROM ev WHERE event_type = 'click' GROUP BY session_id""",
    "model_costs": """
        SELECT session_id, 'm' || (k % 3) AS model,
               CASE WHEN k % 2 = 0 THEN 'high' ELSE 'low' END AS effort,
               sum(cents) AS cents
        FROM ev WHERE event_type = 'view' GROUP BY ALL""",
    "models": """
        SELECT session_id, model AS primary_model, effort AS effort_level
        FROM (SELECT *, row_number() OVER (PARTITION BY session_id
                                           ORDER BY cents DESC, model, effort) AS rn
              FROM model_costs) WHERE rn = 1""",
    "metrics": """
        SELECT session_id, total_cost_usd, input_tokens, output_tokens, cache_read_tokens,
               cache_creation_tokens, active_time_cli_s, active_time_user_s,
               primary_model, effort_level
        FROM costs FULL JOIN tokens USING (session_id) FULL JOIN active USING (session_id)
             LEFT JOIN models USING (session_id)""",
    "summary": """
        SELECT session_id, user_id, session_start, session_end,
               CAST(epoch_us(date_trunc('second', session_end)) // 1000000
                    - epoch_us(date_trunc('second', session_start)) // 1000000 AS BIGINT)
                 AS session_duration_s,
               num_interactions, num_llm_requests, num_tool_calls, total_input_tokens,
               total_output_tokens, total_cache_read, total_cache_creation,
               CAST(coalesce(total_cache_read, 0) AS DOUBLE)
                 / greatest(total_input_tokens + total_output_tokens
                            + coalesce(total_cache_read, 0)
                            + coalesce(total_cache_creation, 0), 1) AS cache_hit_rate,
               avg_ttft_ms, avg_llm_duration_ms,
               tool_successes / CAST(num_tool_executions AS DOUBLE) AS tool_success_rate,
               auto_accepted / CAST(num_blocked_on_user AS DOUBLE) AS auto_accept_rate,
               num_tool_calls / CAST(num_interactions AS DOUBLE) AS tools_per_interaction,
               num_llm_requests / CAST(num_interactions AS DOUBLE) AS llm_calls_per_interaction,
               avg_prompt_length, service_version, os_type, terminal_type, total_cost_usd,
               active_time_cli_s + active_time_user_s AS total_active_time_s
        FROM interactions LEFT JOIN llm USING (session_id) LEFT JOIN tools USING (session_id)
             LEFT JOIN executions USING (session_id) LEFT JOIN approvals USING (session_id)
             LEFT JOIN metrics USING (session_id)""",
    "completed": f"SELECT * FROM summary WHERE session_end < {AS_OF} - {IDLE}",
    "prompts": """
        SELECT session_id, ts AS event_ts, 'USER_PROMPT' AS event_type,
               CASE WHEN k % 4 = 0 THEN '/cmd' || (k % 3) ELSE '' END AS detail_name,
               CAST(NULL AS DOUBLE) AS duration_ms, CAST(NULL AS BIGINT) AS input_tokens,
               CAST(NULL AS BIGINT) AS output_tokens, CAST(NULL AS DOUBLE) AS cost_usd,
               CAST(NULL AS VARCHAR) AS success, 'p' || event_id AS content_preview,
               'p' || event_id AS full_content, 'log' AS event_source,
               CAST(NULL AS VARCHAR) AS model, CAST(NULL AS VARCHAR) AS tool_name,
               CAST(NULL AS VARCHAR) AS error_category, 'p' || (event_id // 10) AS prompt_id,
               CAST(NULL AS VARCHAR) AS tool_use_id, CAST(NULL AS VARCHAR) AS decision_source
        FROM ev WHERE event_type = 'signup'""",
    "llm_calls": """
        SELECT session_id, ts AS event_ts, 'LLM_CALL' AS event_type,
               CASE WHEN k % 8 <> 0 THEN 'main' END AS detail_name,
               cents / 10.0 AS duration_ms, cents // 10 AS input_tokens,
               CAST(k * 5 AS BIGINT) AS output_tokens, cents / 100000.0 AS cost_usd,
               CAST(NULL AS VARCHAR) AS success,
               'm' || (k % 3) || ' | in:' || (cents // 10) || ' out:' || (k * 5)
                 || ' cache_read:' || (k * 3) AS content_preview,
               CAST(NULL AS VARCHAR) AS full_content, 'log' AS event_source, 'm' || (k % 3) AS model,
               CAST(NULL AS VARCHAR) AS tool_name, CAST(NULL AS VARCHAR) AS error_category, 'p' || (event_id // 10) AS prompt_id,
               CAST(NULL AS VARCHAR) AS tool_use_id, CAST(NULL AS VARCHAR) AS decision_source
        FROM ev WHERE event_type = 'view'""",
    "tool_calls": """
        SELECT session_id, ts AS event_ts, 'TOOL_CALL' AS event_type,
               CASE WHEN k % 2 = 0 THEN 'run ' || k WHEN k % 5 <> 0 THEN '/src/' || k
                    ELSE '' END AS detail_name,
               cents / 100.0 AS duration_ms, CAST(NULL AS BIGINT) AS input_tokens,
               CAST(NULL AS BIGINT) AS output_tokens, CAST(NULL AS DOUBLE) AS cost_usd,
               CAST(NULL AS VARCHAR) AS success, CASE WHEN k % 7 <> 0 THEN 'out' || event_id END AS content_preview,
               CASE WHEN k % 7 <> 0 THEN 'out' || event_id END AS full_content,
               'trace' AS event_source, CAST(NULL AS VARCHAR) AS model, 'tool' || (k % 5) AS tool_name,
               CAST(NULL AS VARCHAR) AS error_category, CAST(NULL AS VARCHAR) AS prompt_id, 'tu' || event_id AS tool_use_id,
               CAST(NULL AS VARCHAR) AS decision_source
        FROM ev WHERE event_type = 'purchase'""",
    "decisions": """
        SELECT session_id, ts AS event_ts, 'TOOL_DECISION' AS event_type,
               decision AS detail_name, CAST(NULL AS DOUBLE) AS duration_ms,
               CAST(NULL AS BIGINT) AS input_tokens, CAST(NULL AS BIGINT) AS output_tokens,
               CAST(NULL AS DOUBLE) AS cost_usd, CAST(NULL AS VARCHAR) AS success,
               CASE WHEN k <> 97 THEN 'tool' || (k % 5) END || ' → ' || decision || ' (source: '
                 || CASE WHEN k % 6 = 0 THEN 'unknown' WHEN k % 2 = 0 THEN 'config'
                         ELSE 'user' END || ')' AS content_preview,
               CAST(NULL AS VARCHAR) AS full_content, 'log' AS event_source, CAST(NULL AS VARCHAR) AS model,
               CASE WHEN k <> 97 THEN 'tool' || (k % 5) END AS tool_name,
               CAST(NULL AS VARCHAR) AS error_category, 'p' || (event_id // 10) AS prompt_id,
               'tu' || event_id AS tool_use_id,
               CASE WHEN k % 6 = 0 THEN NULL WHEN k % 2 = 0 THEN 'config'
                    ELSE 'user' END AS decision_source
        FROM ev WHERE event_type = 'click'""",
    "results": """
        SELECT session_id, ts AS event_ts, 'TOOL_RESULT' AS event_type,
               'tool' || (k % 5) || ' | in:' || CASE WHEN k % 9 <> 0 THEN k * 2 ELSE 0 END
                 || 'B out:' || cents || 'B' AS detail_name,
               cents / 100.0 AS duration_ms, CAST(NULL AS BIGINT) AS input_tokens,
               CAST(NULL AS BIGINT) AS output_tokens, CAST(NULL AS DOUBLE) AS cost_usd,
               CASE WHEN k % 10 <> 0 THEN 'true' ELSE 'false' END AS success,
               '{in ' || k || '}' AS content_preview, '{in ' || k || '}' AS full_content,
               'log' AS event_source, CAST(NULL AS VARCHAR) AS model, 'tool' || (k % 5) AS tool_name,
               CAST(NULL AS VARCHAR) AS error_category, 'p' || (event_id // 10) AS prompt_id,
               'tu' || event_id AS tool_use_id, CAST(NULL AS VARCHAR) AS decision_source
        FROM ev WHERE event_type = 'purchase'""",
    "failures": """
        SELECT *, CASE WHEN k >= 60 THEN 'boom' WHEN k >= 40 THEN 'Request was aborted.' END
                    AS error,
               CASE WHEN k % 3 <> 0 THEN 'E' || k END AS error_name
        FROM ev WHERE event_type = 'error'""",
    "errors": """
        SELECT session_id, ts AS event_ts,
               CASE WHEN k < 20 THEN 'INTERNAL_ERROR' WHEN k < 40 THEN 'BACKGROUND_ABORTED'
                    WHEN k < 60 THEN 'USER_ABORTED' ELSE 'ERROR' END AS event_type,
               coalesce(error, error_name, 'unknown') AS detail_name,
               cents / 100.0 AS duration_ms, CAST(NULL AS BIGINT) AS input_tokens,
               CAST(NULL AS BIGINT) AS output_tokens, CAST(NULL AS DOUBLE) AS cost_usd,
               CAST(NULL AS VARCHAR) AS success, coalesce(error, 'error_name=' || error_name) AS content_preview,
               CAST(NULL AS VARCHAR) AS full_content, 'log' AS event_source, 'm' || (k % 3) AS model,
               CAST(NULL AS VARCHAR) AS tool_name,
               CASE WHEN k < 60 THEN 'invisible' ELSE 'user_visible' END AS error_category,
               'p' || (event_id // 10) AS prompt_id, CAST(NULL AS VARCHAR) AS tool_use_id, CAST(NULL AS VARCHAR) AS decision_source
        FROM failures""",
    "timeline": """
        SELECT * FROM prompts UNION ALL SELECT * FROM llm_calls
        UNION ALL SELECT * FROM tool_calls UNION ALL SELECT * FROM decisions
        UNION ALL SELECT * FROM results UNION ALL SELECT * FROM errors""",
    "decision_counts": """
        SELECT session_id, count(*) AS num_tool_decisions,
               count(*) FILTER (detail_name = 'reject') AS num_tool_rejects,
               count(*) FILTER (detail_name = 'accept') AS num_tool_accepts
        FROM timeline WHERE event_type = 'TOOL_DECISION' AND detail_name IN ('accept', 'reject')
        GROUP BY session_id""",
    "abort_counts": """
        SELECT session_id, count(*) AS num_user_aborts
        FROM timeline WHERE event_type = 'USER_ABORTED' GROUP BY session_id""",
    "correction_counts": """
        SELECT session_id, count(*) AS num_corrections FROM (
          SELECT session_id, event_type, epoch_us(event_ts) // 1000000 AS sec,
                 lag(event_type) OVER w AS previous_type,
                 lag(epoch_us(event_ts) // 1000000) OVER w AS previous_sec
          FROM timeline WINDOW w AS (PARTITION BY session_id ORDER BY event_ts, event_type))
        WHERE event_type = 'USER_PROMPT' AND previous_type = 'TOOL_RESULT'
              AND sec - previous_sec <= 21600 GROUP BY session_id""",
    "counted": f"""
        SELECT session_id, user_id, primary_model, session_start, num_interactions,
               coalesce(num_tool_decisions, 0) AS num_tool_decisions,
               coalesce(num_tool_rejects, 0) AS num_tool_rejects,
               coalesce(num_tool_accepts, 0) AS num_tool_accepts,
               coalesce(num_user_aborts, 0) AS num_user_aborts,
               coalesce(num_corrections, 0) AS num_corrections
        FROM completed LEFT JOIN decision_counts USING (session_id)
             LEFT JOIN abort_counts USING (session_id)
             LEFT JOIN correction_counts USING (session_id) LEFT JOIN models USING (session_id)""",
    "rated": """
        SELECT *, CASE WHEN num_tool_decisions > 0
                       THEN CAST(num_tool_rejects AS DOUBLE) / num_tool_decisions END AS reject_rate,
               CAST(num_user_aborts AS DOUBLE) / num_interactions AS abort_rate,
               CAST(num_corrections AS DOUBLE) / num_interactions AS correction_intensity,
               num_tool_decisions + num_user_aborts + num_corrections > 0 AS signal_strength
        FROM counted""",
    "human_signals": f"""
        SELECT *, CASE WHEN signal_strength THEN
                    least(100.0, greatest(0.0, 100.0 * (0.4 * coalesce(reject_rate, 0)
                      + 0.3 * abort_rate + 0.3 * correction_intensity))) END
                 AS human_friction_score, {AS_OF} AS computed_at
        FROM rated""",
    "visible": """
        SELECT session_id, count(*) AS visible_error_count
        FROM timeline WHERE error_category = 'user_visible' GROUP BY session_id""",
    "ruled": """
        SELECT completed.*, coalesce(visible_error_count, 0) AS visible_error_count,
               least(100.0, cache_hit_rate * 60 + greatest(0.0, 40.0
                 - coalesce(total_cost_usd, 0) / num_interactions * 400)) AS efficiency_score,
               least(100.0, least(50.0, coalesce(num_tool_calls, 0)
                 / CAST(num_interactions AS DOUBLE) * 25)
                 + least(50.0, num_interactions * 10.0)) AS productivity_score,
               least(100.0, coalesce(tool_success_rate, 1.0) * 70
                 + greatest(0.0, 30.0 - coalesce(visible_error_count, 0) * 15.0)) AS quality_score,
               coalesce(auto_accept_rate, 0.0) * 100 AS autonomy_score,
               least(100.0, least(50.0, session_duration_s / 60.0 * 50)
                 + least(50.0, coalesce(avg_prompt_length, 0.0))) AS engagement_score
        FROM completed LEFT JOIN visible USING (session_id)""",
    "scored": """
        SELECT *, efficiency_score * 0.20 + productivity_score * 0.25 + quality_score * 0.20
                  + autonomy_score * 0.15 + engagement_score * 0.20 AS composite_score
        FROM ruled""",
}

_EVENT_ORDER = """event_ts NULLS FIRST, event_type, detail_name NULLS FIRST, model NULLS FIRST,
    input_tokens NULLS FIRST, output_tokens NULLS FIRST, cost_usd NULLS FIRST,
    error_category NULLS FIRST, content_preview NULLS FIRST, duration_ms NULLS FIRST"""


def _replay_ctes(source: str, keep: int) -> dict[str, str]:
    """Interactions, lines and texts of the timeline rows of `source`."""
    return {
        "running": f"""
            SELECT *, row_number() OVER w AS pos,
                   sum(CASE WHEN event_type = 'USER_PROMPT' THEN 1 ELSE 0 END) OVER w AS begun
            FROM {source}
            WINDOW w AS (PARTITION BY session_id ORDER BY {_EVENT_ORDER}
                         ROWS UNBOUNDED PRECEDING)""",
        "indexed": """
            SELECT *, CAST(begun - min(begun) OVER (PARTITION BY session_id) AS BIGINT)
                        AS interaction_index
            FROM running""",
        "sized": """
            SELECT *, max(interaction_index) OVER (PARTITION BY session_id) + 1 AS n
            FROM indexed""",
        "verbatim": f"""
            SELECT session_id, interaction_index, pos, n,
                   CASE WHEN epoch_us(event_ts) % 1000000 = 0
                        THEN strftime(event_ts, '%Y-%m-%d %H:%M:%S')
                        ELSE strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') END
                   || ' [' || event_type || '] ' || coalesce(detail_name, 'None')
                   || ' model=' || coalesce(model, 'None')
                   || ' tokens=' || coalesce(input_tokens, 0) || '/' || coalesce(output_tokens, 0)
                   || ' cost=$' || printf('%.4f', coalesce(cost_usd, 0.0))
                   || ' err=' || coalesce(error_category, '')
                   || ' | ' || substring(coalesce(content_preview, ''), 1, 200) AS line
            FROM sized
            WHERE n <= {2 * keep} OR interaction_index < {keep} OR interaction_index >= n - {keep}""",
        "types": """
            SELECT session_id, interaction_index, event_type, count(*) AS n, min(pos) AS first_pos,
                   coalesce(sum(cost_usd), 0) AS usd, coalesce(sum(duration_ms), 0) AS ms
            FROM indexed GROUP BY ALL""",
        "compressed": """
            SELECT session_id, interaction_index, CAST(sum(n) AS BIGINT) AS num_events,
                   '--- [compressed: ' || CAST(sum(n) AS BIGINT) || ' events, types: '
                   || string_agg(event_type || '=' || n, ' ' ORDER BY n DESC, first_pos)
                   || ', cost=$' || printf('%.4f', round(sum(usd), 9)) || ', duration='
                   || CASE WHEN sum(ms) = 0 THEN '0'
                           ELSE CAST(CAST(round(sum(ms), 6) AS DOUBLE) AS VARCHAR) END
                   || 'ms] ---' AS line
            FROM types GROUP BY session_id, interaction_index""",
        "lines": f"""
            SELECT session_id, CASE WHEN n <= {2 * keep} OR interaction_index < {keep}
                                    THEN 0 ELSE 2 END AS part, pos AS ord, line
            FROM verbatim
            UNION ALL
            SELECT session_id, 1, interaction_index, line
            FROM compressed JOIN (SELECT DISTINCT session_id, n FROM sized) USING (session_id)
            WHERE n > {2 * keep} AND interaction_index >= {keep}
                  AND interaction_index < n - {keep}""",
        "begun_lines": """
            SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY session_id
                               ORDER BY part, ord
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins_at
            FROM lines""",
        "replays": """
            SELECT session_id,
                   substring(string_agg(line, chr(10) ORDER BY part, ord), 1, 30000) AS replay_text
            FROM lines GROUP BY session_id""",
    }


_REPLAY = _replay_ctes("timeline", 2)
_CONVERSATION = {
    "turns": """
        SELECT CAST(conv_id AS VARCHAR) AS session_id,
               make_timestamp(turn * 1000000) AS event_ts,
               CASE role WHEN 'user' THEN 'USER_PROMPT' WHEN 'assistant' THEN 'LLM_CALL'
                         ELSE 'SYSTEM' END AS event_type,
               role AS detail_name, CAST(NULL AS VARCHAR) AS model,
               CAST(length(text) AS BIGINT) AS input_tokens, CAST(NULL AS BIGINT) AS output_tokens,
               CAST(NULL AS DOUBLE) AS cost_usd, CAST(NULL AS VARCHAR) AS error_category,
               text AS content_preview, CAST(NULL AS DOUBLE) AS duration_ms
        FROM conversations""",
    **_replay_ctes("turns", 1),
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_PROMPT = f"""
    SELECT session_id, {_quoted(judge.PROMPT_TASK.format(subject=judge.PROMPT_SUBJECT))}
      || {_quoted(judge.PROMPT_EXCUSED)} || 'Session replay:' || chr(10)
      || coalesce(replay_text, '(no events)') || chr(10) || chr(10)
      || 'Session metrics:' || chr(10) || '- interactions: ' || num_interactions
      || ', cost: $' || printf('%.4f', round(coalesce(total_cost_usd, 0.0), 9))
      || ', cache_hit_rate: ' || printf('%.2f', round(coalesce(cache_hit_rate, 0.0) * 100, 9)) || '%'
      || chr(10) || '- tool_success_rate: ' || printf('%.2f', round(coalesce(tool_success_rate, 0.0), 9))
      || ', auto_accept_rate: ' || printf('%.2f', round(coalesce(auto_accept_rate, 0.0), 9))
      || chr(10) || chr(10) || {_quoted(judge.PROMPT_DIMENSIONS)}
      || {_quoted(judge.PROMPT_ANSWER)} AS full_prompt
    FROM scored LEFT JOIN replays USING (session_id)"""

_SCORES = f"""
    SELECT session_id, user_id, session_start, num_interactions, total_cost_usd,
           efficiency_score, productivity_score, quality_score, autonomy_score,
           engagement_score, composite_score,
           CAST(floor(round(engagement_score, 6)) AS INTEGER) AS llm_task_clarity,
           CAST(floor(round(productivity_score, 6)) AS INTEGER) AS llm_agent_effectiveness,
           CAST(floor(round(productivity_score, 6)) AS INTEGER) AS llm_tool_strategy,
           CAST(floor(round(quality_score, 6)) AS INTEGER) AS llm_error_handling,
           CAST(floor(round(efficiency_score, 6)) AS INTEGER) AS llm_cost_efficiency,
           CAST(floor(round(composite_score, 6)) AS INTEGER) AS llm_overall_score,
           'graded by rule' AS llm_summary,
           CASE WHEN quality_score < 70 THEN 'look into the errors' ELSE 'none' END
             AS llm_recommendations,
           {AS_OF} AS scored_at, session_end AS scored_session_end, {AS_OF} AS first_scored_at
    FROM scored"""

_SIGNALS = """SELECT session_id, user_id, primary_model, session_start, num_interactions,
    num_tool_decisions, num_tool_rejects, num_tool_accepts, num_user_aborts, num_corrections,
    reject_rate, abort_rate, correction_intensity, human_friction_score, signal_strength,
    computed_at FROM human_signals"""

_BY_TOOL = f"""
    SELECT session_id, user_id, primary_model, tool_name, count(*) AS num_tool_decisions,
           count(*) FILTER (detail_name = 'reject') AS num_tool_rejects,
           count(*) FILTER (detail_name = 'accept') AS num_tool_accepts,
           CAST(count(*) FILTER (detail_name = 'reject') AS DOUBLE) / count(*) AS reject_rate,
           {AS_OF} AS computed_at
    FROM (SELECT session_id, tool_name, detail_name FROM timeline
          WHERE event_type = 'TOOL_DECISION' AND detail_name IN ('accept', 'reject')
                AND tool_name IS NOT NULL)
         JOIN (SELECT session_id, user_id FROM completed) USING (session_id)
         LEFT JOIN models USING (session_id)
    GROUP BY ALL"""

_TRACES = """
    SELECT 'claude_code.interaction' AS name, session_id, micros * 1000 AS start_time_unix_nano,
           micros * 1000 + (cents // 100) * 1000000000 AS end_time_unix_nano,
           CAST(k AS VARCHAR) AS user_prompt_length, CAST(NULL AS VARCHAR) AS input_tokens,
           CAST(NULL AS VARCHAR) AS ttft_ms, CAST(NULL AS VARCHAR) AS tool_name,
           CAST(NULL AS VARCHAR) AS success, CAST(NULL AS VARCHAR) AS decision,
           'v' || (k % 3) AS service_version, CAST(NULL AS VARCHAR) AS output,
           CAST(NULL AS VARCHAR) AS content
    FROM ev WHERE event_type = 'signup'
    UNION ALL
    SELECT 'claude_code.llm_request', session_id, micros * 1000, micros * 1000, NULL,
           CAST(cents // 10 AS VARCHAR),
           CAST(CAST(cents AS DECIMAL(18, 0)) * 0.01 AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL
    FROM ev WHERE event_type = 'view'
    UNION ALL
    SELECT 'claude_code.tool.blocked_on_user', session_id, micros * 1000, micros * 1000, NULL,
           NULL, NULL, NULL, NULL, decision, NULL, NULL, NULL
    FROM ev WHERE event_type = 'click'
    UNION ALL
    SELECT 'claude_code.tool', session_id, micros * 1000, micros * 1000, NULL, NULL, NULL,
           'tool' || (k % 5), NULL, NULL, NULL,
           CASE WHEN k % 7 <> 0 AND k % 3 <> 0 THEN 'out' || event_id END,
           CASE WHEN k % 7 <> 0 AND k % 3 = 0 THEN 'out' || event_id END
    FROM ev WHERE event_type = 'purchase'
    UNION ALL
    SELECT 'claude_code.tool.execution', session_id, micros * 1000, micros * 1000, NULL, NULL,
           NULL, NULL, CASE WHEN k % 10 <> 0 THEN 'true' ELSE 'false' END, NULL, NULL, NULL, NULL
    FROM ev WHERE event_type = 'purchase'"""

_LOGS = """
    SELECT CASE event_type WHEN 'signup' THEN 'claude_code.user_prompt'
                           WHEN 'view' THEN 'claude_code.api_request'
                           WHEN 'click' THEN 'claude_code.tool_decision'
                           WHEN 'purchase' THEN 'claude_code.tool_result'
                           ELSE CASE WHEN k < 20 THEN 'claude_code.internal_error'
                                     ELSE 'claude_code.api_error' END END AS body,
           session_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_timestamp,
           'p' || (event_id // 10) AS prompt_id,
           CASE WHEN event_type IN ('view', 'error') THEN 'm' || (k % 3) END AS model,
           CASE WHEN event_type = 'view'
                THEN CAST(CAST(cents AS DECIMAL(18, 0)) * 0.00001 AS VARCHAR) END AS cost_usd,
           CASE WHEN event_type = 'view'
                THEN CAST(CAST(cents AS DECIMAL(18, 0)) * 0.1 AS VARCHAR)
                WHEN event_type IN ('purchase', 'error')
                THEN CAST(CAST(cents AS DECIMAL(18, 0)) * 0.01 AS VARCHAR) END AS duration_ms,
           CASE WHEN event_type = 'purchase' OR (event_type = 'click' AND k <> 97)
                THEN 'tool' || (k % 5) END AS tool_name,
           CASE WHEN event_type = 'click' THEN decision END AS decision,
           CASE WHEN event_type = 'error' AND k >= 60 THEN 'boom'
                WHEN event_type = 'error' AND k >= 40 THEN 'Request was aborted.' END AS error
    FROM ev"""

_POINTS = """
    SELECT 'claude_code.cost.usage' AS name, session_id, cents / 100000.0 AS value,
           CAST(NULL AS VARCHAR) AS type, 'm' || (k % 3) AS model,
           CASE WHEN k % 2 = 0 THEN 'high' ELSE 'low' END AS effort
    FROM ev WHERE event_type = 'view'
    UNION ALL
    SELECT 'claude_code.token.usage', session_id,
           CAST(CASE type WHEN 'input' THEN cents // 10 WHEN 'output' THEN k * 5
                          WHEN 'cacheRead' THEN k * 3 ELSE k END AS DOUBLE), type, NULL, NULL
    FROM ev CROSS JOIN (VALUES ('input'), ('output'), ('cacheRead'), ('cacheCreation')) t(type)
    WHERE event_type = 'view'
    UNION ALL
    SELECT 'claude_code.active_time.total', session_id, cents / 100.0,
           CASE WHEN k % 2 = 1 THEN 'cli' ELSE 'user' END, NULL, NULL
    FROM ev WHERE event_type = 'click'"""

_OLD = f"event_ts < {CUT}"
_NEW = f"event_ts >= {CUT}"


def _session_counts(where: str) -> str:
    return (
        "SELECT session_id, count(*) AS events, max(event_ts) AS last_ts "
        f"FROM timeline WHERE {where} GROUP BY session_id"
    )


def _tool_counts(where: str) -> str:
    return (
        "SELECT session_id, tool_name, count(*) AS events FROM timeline "
        f"WHERE tool_name IS NOT NULL AND {where} GROUP BY session_id, tool_name"
    )


_FOUR = "session_id, event_ts, event_type, detail_name"
_NEW_IDS = f"(SELECT session_id FROM timeline WHERE {_NEW})"
_FIRST_IDS = f"(SELECT session_id FROM summary WHERE session_end < {FIRST_RUN} - {IDLE})"
_FIRST_END = (
    "(CASE WHEN num_interactions % 3 = 0 THEN session_end - INTERVAL 1 HOUR ELSE session_end END)"
)
_SHORT = "SELECT session_id, substring(replay_text, 1, 400) AS replay_text FROM replays"

_QUERIES: dict[str, str] = {
    "bronze_traces_scan": _TRACES,
    "bronze_logs_scan": _LOGS,
    "bronze_metrics_scan": _POINTS,
    "interaction_rollup": "SELECT * FROM interactions",
    "llm_rollup": "SELECT * FROM llm",
    "tool_rollup": "SELECT * FROM tools",
    "tool_exec_rollup": "SELECT * FROM executions",
    "approval_rollup": "SELECT * FROM approvals",
    "session_summary": "SELECT * FROM summary",
    "cost_by_session": "SELECT * FROM costs",
    "token_pivot": "SELECT * FROM tokens",
    "active_time_pivot": "SELECT * FROM active",
    "cost_by_model": """SELECT session_id, model, effort, cents / 100000.0 AS model_cost
        FROM model_costs""",
    "primary_model": "SELECT * FROM models",
    "session_metrics": "SELECT * FROM metrics",
    "timeline_prompts": "SELECT * FROM prompts",
    "timeline_llm": "SELECT * FROM llm_calls",
    "timeline_tool_calls": "SELECT * FROM tool_calls",
    "timeline_decisions": "SELECT * FROM decisions",
    "timeline_results": "SELECT * FROM results",
    "timeline_errors": "SELECT * FROM errors",
    "session_events": "SELECT * FROM timeline",
    "distinct_sessions": "SELECT DISTINCT session_id FROM timeline",
    "completed_sessions": "SELECT * FROM completed",
    "decision_counts": "SELECT * FROM decision_counts",
    "abort_counts": "SELECT * FROM abort_counts",
    "correction_counts": "SELECT * FROM correction_counts",
    "session_human_signals": _SIGNALS,
    "signals_by_tool": _BY_TOOL,
    "visible_error_counts": "SELECT * FROM visible",
    "rule_scores": "SELECT * FROM scored",
    "interaction_index": f"SELECT {_FOUR}, duration_ms, interaction_index FROM indexed",
    "interaction_compressed": "SELECT * FROM compressed",
    "replay_lines": "SELECT session_id, part, line FROM begun_lines WHERE begins_at <= 30000",
    "session_replay": "SELECT * FROM replays",
    "conversation_replay": "SELECT * FROM replays",
    "judge_prompt": _PROMPT,
    "judge_parse": _SCORES,
    "upsert_merge": f"""{_session_counts(_NEW)} UNION ALL
        SELECT * FROM ({_session_counts(_OLD)}) WHERE session_id NOT IN {_NEW_IDS}""",
    "upsert_composite": f"""{_tool_counts(_NEW)} UNION ALL
        SELECT * FROM ({_tool_counts(_OLD)}) AS o WHERE NOT EXISTS (
          SELECT 1 FROM ({_tool_counts(_NEW)}) AS s
          WHERE s.session_id = o.session_id AND s.tool_name = o.tool_name)""",
    "delete_keys": f"""SELECT * FROM ({_tool_counts("true")})
        WHERE session_id NOT IN (SELECT session_id FROM visible)""",
    "replace_by_session": f"""SELECT {_FOUR} FROM timeline
        WHERE {_NEW} OR session_id NOT IN {_NEW_IDS}""",
    "replace_tools": f"""{_tool_counts(_NEW)} UNION ALL
        SELECT * FROM ({_tool_counts(_OLD)}) WHERE session_id NOT IN {_NEW_IDS}""",
    "append_evolve": f"""SELECT {_FOUR}, CASE WHEN {_NEW} THEN error_category END AS error_category,
        CASE WHEN {_NEW} THEN decision_source END AS decision_source FROM timeline""",
    "write_once_scores": f"""SELECT session_id, session_end, num_interactions FROM completed
        WHERE session_id NOT IN {_FIRST_IDS}""",
    "due_sessions": f"""SELECT session_id, session_end, num_interactions FROM completed
        WHERE session_id NOT IN {_FIRST_IDS}
              OR (session_end > {_FIRST_END} AND session_end <= {FIRST_RUN} + INTERVAL 7 DAY)""",
    "events_of_work_set": f"""SELECT {_FOUR} FROM timeline WHERE session_id IN (
        SELECT session_id FROM completed WHERE session_id NOT IN {_FIRST_IDS}
              OR (session_end > {_FIRST_END} AND session_end <= {FIRST_RUN} + INTERVAL 7 DAY))""",
    "session_replay_short": _SHORT,
    "conversation_replay_short": _SHORT,
    "judge_parse_mixed": f"{_SCORES} WHERE num_interactions % 5 < 2",
    "idle_segments": """
        SELECT session_id, CAST(segment AS BIGINT) AS segment, min(event_ts) AS segment_start,
               max(event_ts) AS segment_end, count(*) AS num_events
        FROM (SELECT *, sum(cut) OVER (PARTITION BY session_id ORDER BY event_ts
                                       RANGE UNBOUNDED PRECEDING) AS segment
              FROM (SELECT session_id, event_ts,
                           CASE WHEN epoch_us(event_ts) - lag(epoch_us(event_ts)) OVER (
                                  PARTITION BY session_id ORDER BY event_ts) > 86400000000
                                THEN 1 ELSE 0 END AS cut FROM timeline))
        GROUP BY session_id, segment""",
    "gold_rollup": """
        SELECT primary_model, user_id, CAST(grouping(primary_model, user_id) AS INTEGER) AS level,
               count(*) AS sessions, CAST(sum(num_tool_decisions) AS BIGINT) AS decisions,
               CAST(sum(num_tool_rejects) AS BIGINT) AS rejects,
               CAST(sum(num_corrections) AS BIGINT) AS corrections,
               avg(human_friction_score) AS avg_friction
        FROM human_signals GROUP BY ROLLUP (primary_model, user_id)""",
    "daily_scores": """
        SELECT CAST(session_start AS DATE) AS day, count(*) AS sessions,
               sum(total_cost_usd) AS cost_usd, avg(composite_score) AS avg_composite,
               min(composite_score) AS min_composite, max(composite_score) AS max_composite
        FROM scored GROUP BY 1""",
}


# Jobs on stored tables, and their frame forms.
_SAME_AS = {
    "metrics_by_temporality": "session_metrics",
    "stored_silver_summary": "session_summary",
    "stored_silver_metrics": "session_metrics",
    "stored_scores": "judge_parse",
    "stored_upsert": "upsert_merge",
    "stored_replace_by_session": "replace_by_session",
    "stored_replace_tools": "replace_tools",
    "stored_append_evolve": "append_evolve",
    "stored_deliveries": "session_events",
    "stored_work_set": "events_of_work_set",
    "streamed_timeline": "session_events",
}

# Sums and averages of doubles depend on the order of the rows, so both sides round
# these columns to nine decimals.
_SUMMARY_DOUBLES = """cache_hit_rate avg_ttft_ms avg_llm_duration_ms tool_success_rate
    auto_accept_rate tools_per_interaction llm_calls_per_interaction avg_prompt_length
    total_cost_usd total_active_time_s"""
_SCORE_DOUBLES = """efficiency_score productivity_score quality_score autonomy_score
    engagement_score composite_score"""
_TOKEN_DOUBLES = "input_tokens output_tokens cache_read_tokens cache_creation_tokens"
_ACTIVE_DOUBLES = "active_time_cli_s active_time_user_s"
_ROUNDED: dict[str, str] = {
    "bronze_metrics_scan": "value",
    "interaction_rollup": "avg_prompt_length",
    "llm_rollup": "avg_ttft_ms avg_llm_duration_ms",
    "session_summary": _SUMMARY_DOUBLES,
    "completed_sessions": _SUMMARY_DOUBLES,
    "cost_by_session": "total_cost_usd",
    "token_pivot": _TOKEN_DOUBLES,
    "active_time_pivot": _ACTIVE_DOUBLES,
    "cost_by_model": "model_cost",
    "session_metrics": f"total_cost_usd {_TOKEN_DOUBLES} {_ACTIVE_DOUBLES}",
    "timeline_llm": "duration_ms cost_usd",
    "timeline_tool_calls": "duration_ms",
    "timeline_results": "duration_ms",
    "timeline_errors": "duration_ms",
    "session_events": "duration_ms cost_usd",
    "session_human_signals": """reject_rate abort_rate correction_intensity
        human_friction_score""",
    "signals_by_tool": "reject_rate",
    "rule_scores": f"{_SUMMARY_DOUBLES} {_SCORE_DOUBLES}",
    "interaction_index": "duration_ms",
    "judge_parse": f"total_cost_usd {_SCORE_DOUBLES}",
    "judge_parse_mixed": f"total_cost_usd {_SCORE_DOUBLES}",
    "gold_rollup": "avg_friction",
    "daily_scores": "cost_usd avg_composite min_composite max_composite",
}


def _with(name: str, query: str) -> str:
    ctes = _CONVERSATION if name.startswith("conversation_replay") else {**_CTES, **_REPLAY}
    listed = ",\n".join(f"{cte} AS ({body})" for cte, body in ctes.items())
    rounded = ", ".join(f"round({c}, 9) AS {c}" for c in _ROUNDED.get(name, "").split())
    columns = f"* REPLACE ({rounded})" if rounded else "*"
    return f"WITH {listed}\nSELECT {columns} FROM ({query}) AS q"


def oracle_sql() -> dict[str, str]:
    found = {name: _with(name, query) for name, query in _QUERIES.items()}
    return found | {name: found[frame_form] for name, frame_form in _SAME_AS.items()}
