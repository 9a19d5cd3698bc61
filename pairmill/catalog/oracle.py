"""The same results in DuckDB SQL, written on their own from the definitions."""

from __future__ import annotations

from pairmill.catalog.byte_pair_sql import BYTE_PAIRS

# What Python's strip() leaves nothing of.
BLANK = r"NOT regexp_matches({0}, '[^\s\p{{Z}}\x{{85}}\x{{1c}}-\x{{1f}}\v]')"
PREFIX = "'<|im_start|>user' || chr(10)"
SUFFIX = "'<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)"
EOS = 0x110000


def blank(column: str) -> str:
    return f"({column} IS NULL OR {BLANK.format(column)})"


PAIRS = """
pairs AS (
  SELECT conv_id, turn, text AS instruction, next_text AS response
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""

GAPPY = f"""{PAIRS},
gappy AS (
  SELECT conv_id, turn, instruction,
         CASE conv_id % 10 WHEN 3 THEN NULL WHEN 7 THEN chr(160) || ' ' || chr(9)
                           ELSE response END AS response
  FROM pairs)"""

DEDUPED = f"""{PAIRS},
deduped AS (
  SELECT DISTINCT instruction, response,
         sha256(instruction || chr(0) || response) AS content_hash
  FROM pairs WHERE NOT {blank('instruction')} AND NOT {blank('response')})"""


def split(source: str = DEDUPED) -> str:
    return f"""{source},
ranked AS (
  SELECT *, row_number() OVER (ORDER BY content_hash) AS place,
         least(32, greatest(1, CAST(floor(count(*) OVER () * CAST(0.25 AS DOUBLE)) AS BIGINT)))
           AS held
  FROM deduped),
train AS (SELECT instruction, response, content_hash FROM ranked WHERE place > held),
eval AS (SELECT instruction, response, content_hash FROM ranked WHERE place <= held)"""


def codepoints(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda c: CAST(unicode(c) AS BIGINT))"


def repeat(value: int, count: str) -> str:
    return f"list_transform(range({count}), lambda i: CAST({value} AS BIGINT))"


def encoded(max_len: int, source: str) -> str:
    """Training rows, their arrays kept as lists."""
    return f"""{split(source)},
tokens AS (
  SELECT content_hash,
         {codepoints(f"{PREFIX} || instruction || {SUFFIX}")} AS p,
         {codepoints('response')} AS a
  FROM train),
kept AS (
  SELECT content_hash, p,
         list_concat(a[1:least(len(a), {max_len} - len(p) - 1)], [CAST({EOS} AS BIGINT)]) AS s
  FROM tokens WHERE {max_len} - len(p) >= 17),
encoded AS (
  SELECT content_hash, len(s) AS n_supervised,
         list_concat(list_concat(p, s), {repeat(EOS, f'{max_len} - len(p) - len(s)')})
           AS input_ids,
         list_concat({repeat(1, 'len(p) + len(s)')},
                     {repeat(0, f'{max_len} - len(p) - len(s)')}) AS attention_mask,
         list_concat(list_concat({repeat(-100, 'len(p)')}, s),
                     {repeat(-100, f'{max_len} - len(p) - len(s)')}) AS labels
  FROM kept)"""


def encoded_rows(max_len: int, source: str = DEDUPED) -> str:
    return f"""WITH {encoded(max_len, source)}
SELECT content_hash, array_to_string(input_ids, ',') AS input_ids,
       array_to_string(attention_mask, ',') AS attention_mask,
       array_to_string(labels, ',') AS labels
FROM encoded"""


# What preparation makes of the gappy pairs.
PREPARED = f"""{GAPPY},
deduped AS (
  SELECT DISTINCT instruction, response,
         sha256(instruction || chr(0) || response) AS content_hash
  FROM gappy WHERE NOT {blank('instruction')} AND NOT {blank('response')})"""


def acceptance(limit: float, by: str = "", rows: str = "gappy") -> str:
    group = f"GROUP BY {by}" if by else ""
    columns = f"{by}, " if by else ""
    bad = f"count(*) FILTER (WHERE {blank('response')})"
    return f"""
SELECT {columns}count(*) AS rows_checked, {bad} AS rows_unusable,
       CAST({bad} AS DOUBLE) / count(*) AS empty_fraction,
       CAST({limit} AS DOUBLE) AS max_empty_fraction,
       CAST({bad} AS DOUBLE) / count(*) <= CAST({limit} AS DOUBLE) AS passed
FROM {rows} {group}"""


def batches(workers: int, size: int, source: str, epochs: int = 2, seed: int = 42) -> str:
    """The batch plan over rows with a content_hash, by a plain global numbering."""
    return f"""
placed AS (
  SELECT e AS epoch, content_hash,
         row_number() OVER (PARTITION BY e ORDER BY md5(content_hash || ':' || (e + {seed})),
                            content_hash) - 1 AS idx,
         count(*) OVER (PARTITION BY e) AS total
  FROM {source}, range({epochs}) AS epochs(e)),
sharded AS (SELECT *, (idx * {workers}) // total AS shard FROM placed),
dealt AS (SELECT *, row_number() OVER (PARTITION BY epoch, shard ORDER BY idx) - 1 AS place
          FROM sharded),
plan AS (
  SELECT CAST(epoch AS INTEGER) AS epoch, shard, place // {size} AS batch, place % {size} AS pos,
         content_hash
  FROM dealt)"""


LOSSES = """
losses AS (
  SELECT user_id AS run_id, CAST(day(ts) AS INTEGER) AS epoch,
         CASE WHEN event_type <> 'error' THEN value END AS loss
  FROM events),
epochs AS (
  SELECT run_id, epoch,
         round(avg(loss), 9) AS loss,
         count(loss) AS steps, count(*) - count(loss) AS skipped_batches, count(loss) > 0 AS valid
  FROM losses GROUP BY ALL),
checkpoints AS (
  SELECT run_id, epoch, CASE WHEN run_id % 7 <> 0 THEN loss END AS loss,
         'ckpt-' || run_id || '-' || epoch AS checkpoint
  FROM epochs)"""

LINES = """
turns AS (
  SELECT conv_id, turn, text, conv_id % 7 AS fault, CAST(ceil(length(text) / 40.0) AS BIGINT) AS n
  FROM conversations),
numbered AS (SELECT *, unnest(range(n + 2)) AS seq FROM turns),
lines AS (
  SELECT conv_id || ':' || turn AS request_id, seq,
         conv_id * 60000000 + turn * 10000000 + CASE fault WHEN 3 THEN 0 ELSE seq * 50000 END AS us,
         CASE WHEN seq = n + 1 THEN NULL
              WHEN seq = n THEN 'data: [DONE]'
              WHEN fault = 2 AND seq = n // 2 THEN 'data: {"error":{"message":"overloaded"}}'
              WHEN fault = 5 AND seq = n // 2 AND turn % 2 = 0 THEN 'data: {"choices":['
              WHEN fault = 5 AND seq = n // 2 THEN 'data: {"choices":[]},0]'
              WHEN fault = 4 THEN 'data: {"choices":[{"delta":{"role":"assistant"}}]}'
              ELSE 'data: ' || CAST(to_json({'choices': [{'delta': {'content':
                     substring(text, CAST(seq * 40 + 1 AS BIGINT), 40)}}]}) AS VARCHAR) END AS line,
         CASE WHEN seq = n + 1 THEN CASE fault WHEN 6 THEN 28 ELSE 0 END END AS transfer_rc
  FROM numbered WHERE fault <> 1 OR seq <> n)"""

STREAM_AUDIT = f"""WITH {LINES},
payloads AS (
  SELECT request_id, seq, us, transfer_rc,
         CASE WHEN starts_with(line, 'data: ') THEN trim(substring(line, 7)) END AS payload
  FROM lines),
kinds AS (
  SELECT *, CASE WHEN payload IS NULL THEN 'ignored'
                 WHEN payload = '[DONE]' THEN 'done'
                 WHEN NOT json_valid(payload) THEN 'unparseable'
                 WHEN list_contains(json_keys(payload), 'error') THEN 'error'
                 WHEN length(json_extract_string(payload, '$.choices[0].delta.content')) > 0
                   THEN 'content'
                 ELSE 'protocol' END AS kind,
         CASE WHEN json_valid(payload)
              THEN json_extract_string(payload, '$.choices[0].delta.content') END AS piece
  FROM payloads),
totals AS (
  SELECT request_id, max(transfer_rc) AS rc,
         min_by(kind, seq) FILTER (WHERE kind IN ('unparseable', 'error')) AS bad,
         min_by(substring(payload, 1, 200), seq) FILTER (WHERE kind IN ('unparseable', 'error'))
           AS evidence,
         bool_or(kind = 'done') AS done,
         count(*) FILTER (WHERE kind = 'content') AS chunks,
         coalesce(sum(length(piece)) FILTER (WHERE kind = 'content'), 0) AS chars,
         count(*) FILTER (WHERE kind = 'protocol') AS protocol_frames,
         max(us) FILTER (WHERE kind = 'content') - min(us) FILTER (WHERE kind = 'content')
           AS span_us,
         string_agg(piece, '' ORDER BY seq) FILTER (WHERE kind = 'content') AS text
  FROM kinds GROUP BY request_id)
SELECT request_id,
       CASE WHEN rc IS NULL OR rc <> 0 THEN 'transfer_failed'
            WHEN bad = 'unparseable' THEN 'unparseable'
            WHEN bad = 'error' THEN 'error_event'
            WHEN NOT done THEN 'no_done'
            WHEN chunks = 0 THEN 'no_content'
            WHEN chunks > 1 AND span_us < 150000 THEN 'buffered'
            ELSE 'ok' END AS verdict,
       chunks, CAST(chars AS BIGINT) AS chars, protocol_frames, span_us, evidence,
       replace(substring(text, 1, 120), chr(10), ' ') AS preview
FROM totals"""

OBSERVATIONS = """
observations AS (
  SELECT user_id AS job, ts AS observed_at, event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'Initializing' WHEN 'view' THEN 'Running'
                         WHEN 'click' THEN 'Running' ELSE 'Complete' END AS deploy_status,
         CASE event_type WHEN 'signup' THEN '' WHEN 'view' THEN 'RUNNING' WHEN 'click' THEN 'RUNNING'
                         WHEN 'purchase' THEN 'SUCCEEDED' ELSE 'FAILED' END AS job_status,
         event_type AS reason, props AS message
  FROM events)"""

ACCOUNTED = """
seen AS (
  SELECT source, avg(length(text)) AS average_length, max(length(text)) AS max_model_len,
         count(*) AS target,
         CASE WHEN max(length(text)) % 2 = 0 THEN count(*) ELSE 2 * count(*) END AS most
  FROM documents GROUP BY source),
models(model, layers, kv_heads, head_dim, weight_bytes) AS (
  VALUES ('qwen3-8b', 36, 8, 128, 16381470720), ('qwen2.5-7b', 28, 4, 128, 15231233024),
         ('qwen2.5-0.5b', 24, 2, 64, 988000000)),
cards(card_gb) AS (VALUES (16), (24), (80)),
pools AS (
  SELECT *, CAST(2 * layers * kv_heads * head_dim * 2 AS BIGINT) AS per_token,
         CAST(card_gb AS DOUBLE) * 1e9 * 1 * CAST(0.85 AS DOUBLE) - weight_bytes AS pool
  FROM seen, models, cards),
accounted AS (
  SELECT *, CASE WHEN pool > 0 THEN pool / per_token ELSE CAST(0 AS DOUBLE) END AS budget
  FROM pools)"""



def quantiles(by: str) -> str:
    """The exact quantiles of the lengths, each as the largest length of its bucket."""
    return f"""
ordered AS (
  SELECT {by}, length(text) AS n, row_number() OVER (PARTITION BY {by} ORDER BY length(text)) AS k,
         count(*) OVER (PARTITION BY {by}) AS total
  FROM documents),
exact AS (
  SELECT {by}, percent, n, greatest(length(bin(n)) - 7, 0) AS s
  FROM ordered, (VALUES (50), (90), (99)) AS asked(percent)
  WHERE k = (total * percent + 99) // 100),
quantiles AS (
  SELECT {by}, CAST(percent AS INTEGER) AS percent,
         CAST((((n >> s) + 1) << s) - 1 AS BIGINT) AS length
  FROM exact)"""


ORACLE = {
    "sft_pairs": f"WITH {PAIRS} SELECT * FROM pairs",
    "sft_pairs_with_gaps": """
SELECT conv_id, turn, text AS instruction, next_text AS response
FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
      FROM conversations WHERE role <> 'system' AND (conv_id + turn) % 7 <> 2
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
WHERE role = 'user' AND next_role = 'assistant'""",
    "raw_jsonl_scan": f"""WITH {GAPPY}
SELECT instruction, response, CAST(repeat AS INTEGER) AS repeat
FROM gappy, range(3) AS repeats(repeat)""",
    "raw_strict_scan": f"""WITH {PAIRS}
SELECT CASE conv_id % 4 WHEN 1 THEN nullif(CAST(turn AS VARCHAR), '0') WHEN 2 THEN NULL
                        ELSE instruction END AS instruction, response
FROM pairs""",
    "eval_roundtrip": f"WITH {split()} SELECT instruction, response FROM eval",
    "prep_manifest": f"""WITH {encoded(256, PREPARED)}
SELECT 'first' AS run_id, 'codepoints' AS base_model,
       (SELECT 3 * count(*) FROM gappy) AS raw_rows,
       (SELECT count(*) FROM deduped) AS deduped_rows,
       (SELECT count(*) FROM train) AS train_rows_before_tokenize,
       (SELECT count(*) FROM encoded) AS train_rows,
       (SELECT count(*) FROM train) - (SELECT count(*) FROM encoded) AS rejected_overlength,
       (SELECT count(*) FROM eval) AS eval_rows,
       CAST(256 AS BIGINT) AS max_len, CAST(16 AS BIGINT) AS min_answer_tokens""",
    "version_roundtrip": encoded_rows(256, PREPARED),
    "nonblank_filter": f"""WITH {GAPPY}
SELECT * FROM gappy WHERE NOT {blank('instruction')} AND NOT {blank('response')}""",
    "content_hash": f"""WITH {PAIRS}
SELECT conv_id, turn, sha256(instruction || chr(0) || response) AS content_hash FROM pairs""",
    "exact_dedup": """
SELECT doc_id, lang AS instruction, text AS response, source, content_hash, copies
FROM (SELECT *, sha256(lang || chr(0) || text) AS content_hash,
             row_number() OVER (PARTITION BY sha256(lang || chr(0) || text) ORDER BY doc_id) AS n,
             count(*) OVER (PARTITION BY sha256(lang || chr(0) || text)) AS copies
      FROM documents)
WHERE n = 1""",
    "exact_dedup_late": """
SELECT doc_id, lang AS instruction, text AS response, source, CAST(0 AS INTEGER) AS repeat,
       content_hash, 3 * copies AS copies
FROM (SELECT *, sha256(lang || chr(0) || text) AS content_hash,
             row_number() OVER (PARTITION BY sha256(lang || chr(0) || text) ORDER BY doc_id) AS n,
             count(*) OVER (PARTITION BY sha256(lang || chr(0) || text)) AS copies
      FROM documents)
WHERE n = 1""",
    "split_fingerprints": f"""WITH {split()},
sides AS (
  SELECT 'deduped' AS side, content_hash AS h FROM deduped
  UNION ALL SELECT 'train', content_hash FROM train
  UNION ALL SELECT 'eval', content_hash FROM eval)
SELECT side, count(*) AS rows,
       CAST(sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) % 1000000000000000003 AS BIGINT)
         AS sum_one,
       CAST(sum(CAST('0x' || substr(h, 17, 15) AS BIGINT)) % 999999999999999989 AS BIGINT)
         AS sum_two
FROM sides GROUP BY side""",
    "version_check": f"""WITH {encoded(256, PREPARED)}
SELECT 'eval' AS side, count(*) AS rows, count(*) AS rows_found, true AS intact FROM eval
UNION ALL SELECT 'kept', count(*), count(*), true FROM kept""",
    "holdout_keys": f"WITH {split()} SELECT content_hash FROM eval",
    "holdout_eval": f"WITH {split()} SELECT * FROM eval",
    "holdout_train": f"WITH {split()} SELECT * FROM train",
    "split_invariants": f"""WITH {split()}
SELECT (SELECT count(*) FROM deduped) AS deduped_rows, (SELECT count(*) FROM train) AS train_rows,
       (SELECT count(*) FROM eval) AS eval_rows,
       (SELECT count(*) FROM (SELECT content_hash FROM train INTERSECT
                              SELECT content_hash FROM eval)) AS in_both,
       (SELECT count(*) FROM (SELECT content_hash FROM deduped EXCEPT
                              (SELECT content_hash FROM train UNION
                               SELECT content_hash FROM eval))) AS not_covered""",
    "render_prompt": f"""WITH {PAIRS}
SELECT conv_id, turn, {PREFIX} || instruction || {SUFFIX} AS prompt FROM pairs""",
    "tokenize_codepoints": f"""
SELECT conv_id, turn, array_to_string({codepoints('text')}, ',') AS ids FROM conversations""",
    "tokenize_byte_pairs": BYTE_PAIRS,
    "overlength_split": f"""WITH {PAIRS},
sizes AS (
  SELECT conv_id, turn, length({PREFIX} || instruction || {SUFFIX}) AS prompt_tokens,
         length(response) AS answer_tokens
  FROM pairs)
SELECT *, CASE WHEN 256 - prompt_tokens < 17 THEN 'rejected'
               WHEN answer_tokens > 256 - prompt_tokens - 1 THEN 'truncated'
               ELSE 'whole' END AS policy
FROM sizes""",
    "encode_sft": encoded_rows(256),
    "encode_sft_512": encoded_rows(512),
    "supervision_audit": f"""WITH {encoded(256, DEDUPED)},
counted AS (SELECT len(list_filter(labels, lambda x: x <> -100)) AS n FROM encoded)
SELECT count(*) AS rows, CAST(sum(n) AS BIGINT) AS supervised_tokens, min(n) AS min_supervised,
       max(n) AS max_supervised, count(*) FILTER (WHERE n = 0) AS unsupervised_rows
FROM counted""",
    "generation_requests": f"""WITH {PAIRS}
SELECT conv_id, turn, CAST(1 AS BIGINT) AS messages, 'user' AS role, instruction AS content,
       CAST(0 AS DOUBLE) AS temperature, CAST(256 AS INTEGER) AS max_tokens,
       false AS detokenize
FROM pairs""",
    "request_bodies": f"""WITH {PAIRS}
SELECT conv_id, turn,
       CAST(to_json({{'model': 'sft-qwen', 'messages': [{{'role': 'user', 'content': instruction}}],
                     'max_tokens': 128, 'temperature': 0, 'stream': false}}) AS VARCHAR) AS body
FROM pairs""",
    "gate_roundtrip": f"""WITH {GAPPY}
SELECT 'first' AS run_id, 'model' AS model_version, 'holdout' AS eval_version,
       (SELECT count(*) FROM gappy) AS rows_total, * FROM ({acceptance(0.5)})""",
    "acceptance_report": f"WITH {GAPPY} {acceptance(0.1)}",
    "acceptance_by_turn": f"WITH {GAPPY} {acceptance(0.2, 'turn')}",
    "acceptance_sample": f"""WITH {GAPPY},
present AS (
  SELECT response, '=' || instruction AS i, coalesce('=' || response, '') AS r FROM gappy),
checked AS (
  SELECT response FROM present ORDER BY sha256(i || chr(0) || r || chr(0) || r) LIMIT 50)
{acceptance(0.2, rows='checked')}""",
    "acceptance_sample_by_turn": f"""WITH {GAPPY},
present AS (
  SELECT turn, response, '=' || instruction AS i, coalesce('=' || response, '') AS r FROM gappy),
checked AS (
  SELECT turn, response FROM present QUALIFY row_number() OVER (
    PARTITION BY turn ORDER BY sha256(i || chr(0) || r || chr(0) || r)) <= 20)
{acceptance(0.2, 'turn', 'checked')}""",
    "context_budget": f"""
SELECT source, count(*) AS requests, max(length({PREFIX} || text || {SUFFIX}) + 256) AS longest,
       count(*) FILTER (WHERE length({PREFIX} || text || {SUFFIX}) + 256 > 2048) AS over_budget
FROM documents GROUP BY source""",
    "batch_plan": f"WITH {DEDUPED}, {batches(3, 4, 'deduped')} SELECT * FROM plan",
    "batch_steps": f"""WITH {DEDUPED}, {batches(3, 4, 'deduped')}
SELECT epoch, shard, count(*) AS rows, max(batch) + 1 AS steps FROM plan GROUP BY epoch, shard""",
    "batch_layout": f"""WITH {encoded(256, PREPARED)}, {batches(2, 4, 'encoded')}
SELECT epoch, CAST(shard AS INTEGER) AS shard, batch, count(*) AS rows,
       CAST(sum(n_supervised) AS BIGINT) AS supervised_tokens,
       min(n_supervised) AS min_supervised, max(n_supervised) AS max_supervised,
       count(*) FILTER (WHERE n_supervised = 0) AS unsupervised_rows
FROM plan JOIN encoded USING (content_hash) GROUP BY epoch, shard, batch""",
    "batch_resume": f"""WITH {encoded(256, PREPARED)}, {batches(2, 4, 'encoded')}
SELECT epoch, CAST(shard AS INTEGER) AS shard, batch, pos, content_hash
FROM (SELECT *, max(batch) OVER (PARTITION BY epoch, shard) + 1 AS steps FROM plan)
WHERE batch >= steps // 2""",
    "batch_index": f"""WITH {encoded(256, PREPARED)}, {batches(2, 4, 'encoded')}
SELECT epoch, CAST(shard AS INTEGER) AS shard, batch, count(*) AS rows, CAST(0 AS BIGINT) AS first_pos
FROM plan GROUP BY epoch, shard, batch""",
    "epoch_loss": f"WITH {LOSSES} SELECT * FROM epochs",
    "checkpoint_topk": f"""WITH {LOSSES}
SELECT run_id, epoch, checkpoint, CAST(place AS INTEGER) AS place
FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY loss, epoch) AS place
      FROM checkpoints WHERE loss IS NOT NULL)
WHERE place <= 2""",
    "checkpoint_select": f"""WITH {LOSSES}
SELECT run_id, epoch, checkpoint,
       CASE WHEN loss IS NULL THEN 'latest' ELSE 'best-by-loss' END AS selection
FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY loss IS NULL, loss,
                CASE WHEN loss IS NULL THEN -epoch ELSE epoch END) AS place FROM checkpoints)
WHERE place = 1""",
    "export_provenance": f"""WITH {encoded(256, PREPARED)}, {LOSSES}
SELECT CAST(run_id AS VARCHAR) AS run_id, (SELECT count(*) FROM encoded) AS data_rows,
       'best-by-loss' AS checkpoint_selection, loss
FROM checkpoints WHERE loss IS NOT NULL ORDER BY loss, run_id LIMIT 1""",
    "response_audit": f"""WITH bodies AS (
  SELECT conv_id, turn,
         CASE conv_id % 6
           WHEN 2 THEN '{{"error":null,"choices":[]}}'
           WHEN 3 THEN CASE turn % 2 WHEN 1 THEN '{{"choices":[]}},0]' ELSE '{{"choices":[]}}' END
           WHEN 4 THEN CAST(to_json({{'choices': [{{'message': {{'content': chr(160) || ' ' || chr(9)}},
                                                   'finish_reason': 'stop'}}]}}) AS VARCHAR)
           WHEN 5 THEN CAST(to_json({{'choices': [{{'message': {{'content': text}}}}]}}) AS VARCHAR)
           ELSE CAST(to_json({{'choices': [{{'message': {{'content': text}},
                                            'finish_reason': 'stop'}}]}}) AS VARCHAR) END AS body
  FROM conversations),
valid AS (SELECT *, CASE WHEN json_valid(body) THEN body END AS json FROM bodies),
opened AS (
  SELECT *, json_extract_string(json, '$.choices[0].message.content') AS content,
         json_extract_string(json, '$.choices[0].finish_reason') AS finish
  FROM valid),
judged AS (
  SELECT *, CASE WHEN json IS NULL THEN 'unparseable'
                 WHEN list_contains(json_keys(json), 'error') THEN 'error'
                 WHEN json_array_length(json, '$.choices') = 0 THEN 'no_choices'
                 WHEN {blank('content')} THEN 'no_content'
                 WHEN finish IS NULL OR finish = '' THEN 'no_finish_reason'
                 ELSE 'ok' END AS reason
  FROM opened)
SELECT conv_id, turn, reason, length(content) AS content_chars,
       replace(substring(content, 1, 120), chr(10), ' ') AS preview, finish AS finish_reason,
       CASE WHEN reason IN ('unparseable', 'error') THEN substring(body, 1, 200) END AS evidence
FROM judged""",
    "model_listed": """
SELECT conv_id, turn, 'm-' || (conv_id % 5) = 'm-3' OR 'm-' || turn = 'm-3' AS listed
FROM conversations""",
    "stream_audit": STREAM_AUDIT,
    "live_stream_report": STREAM_AUDIT,
    "live_report_table": STREAM_AUDIT.replace(
        "SELECT request_id, seq, us, transfer_rc,",
        """SELECT request_id, seq, transfer_rc,
         us + CASE WHEN CAST(split_part(request_id, ':', 1) AS BIGINT) % 5 = 0 AND seq > 2
                   THEN 600000000 ELSE 0 END AS us,""",
    ).replace("AS preview\n", "AS preview, true AS final\n"),
    "status_changes": f"""WITH {OBSERVATIONS},
states AS (
  SELECT *, coalesce(nullif(deploy_status, ''), '?') || '/' || coalesce(nullif(job_status, ''), '?')
           AS state
  FROM observations),
ordered AS (
  SELECT *, lag(state) OVER (PARTITION BY job ORDER BY observed_at, seq) AS previous FROM states)
SELECT job, observed_at, seq, previous, state FROM ordered
WHERE previous IS NULL OR previous <> state""",
    "job_outcome": f"""WITH {OBSERVATIONS},
judged AS (
  SELECT *, CASE WHEN job_status = 'SUCCEEDED' THEN 'success'
                 WHEN job_status IN ('FAILED', 'STOPPED') THEN 'failed'
                 WHEN deploy_status = 'Failed' THEN 'deploy_failed'
                 WHEN observed_at > min(observed_at) OVER (PARTITION BY job)
                                    + INTERVAL 43200 SECOND THEN 'timeout' END AS verdict
  FROM observations)
SELECT job, coalesce(arg_min(verdict, (observed_at, seq)) FILTER (WHERE verdict IS NOT NULL),
                     'running') AS outcome,
       count(*) AS observations, min(observed_at) AS first_at, max(observed_at) AS last_at,
       CASE WHEN outcome NOT IN ('timeout', 'running') THEN
         arg_min(reason, (observed_at, seq)) FILTER (WHERE verdict IS NOT NULL) END AS reason,
       CASE WHEN outcome NOT IN ('timeout', 'running') THEN
         arg_min(message, (observed_at, seq)) FILTER (WHERE verdict IS NOT NULL) END AS message
FROM judged GROUP BY job""",
    "live_job_watch": f"""WITH {OBSERVATIONS},
judged AS (
  SELECT *, CASE WHEN job_status = 'SUCCEEDED' THEN 'success'
                 WHEN job_status IN ('FAILED', 'STOPPED') THEN 'failed'
                 WHEN deploy_status = 'Failed' THEN 'deploy_failed'
                 WHEN observed_at > min(observed_at) OVER (PARTITION BY job)
                                    + INTERVAL 43200 SECOND THEN 'timeout' END AS verdict
  FROM observations),
ended AS (
  SELECT job, min(observed_at) AS first_at,
         arg_min(verdict, (observed_at, seq)) FILTER (WHERE verdict IS NOT NULL) AS seen,
         arg_min(reason, (observed_at, seq)) FILTER (WHERE verdict IS NOT NULL) AS reason,
         arg_min(message, (observed_at, seq)) FILTER (WHERE verdict IS NOT NULL) AS message
  FROM judged GROUP BY job)
SELECT CAST(job AS VARCHAR) AS job, coalesce(seen, 'timeout') AS outcome, first_at,
       seen IS NULL AS silent,
       CASE WHEN seen <> 'timeout' THEN reason END AS reason,
       CASE WHEN seen <> 'timeout' THEN message END AS message
FROM ended""",
    "capacity_accounting": f"""WITH {ACCOUNTED}
SELECT source, model, CAST(card_gb AS INTEGER) AS card_gb, CAST(max_model_len AS INTEGER)
         AS max_model_len, per_token AS kv_bytes_per_token,
       CAST(floor(budget) AS BIGINT) AS token_budget,
       round(budget / max_model_len, 6) AS worst_case_sequences,
       CAST(floor(CAST(card_gb AS DOUBLE) * 1e9 * 1 * CAST(0.85 AS DOUBLE)) AS BIGINT)
         AS reserved_bytes,
       CAST(weight_bytes AS BIGINT) AS weight_bytes, per_token * max_model_len AS sequence_bytes
FROM accounted""",
    "capacity_by_length": f"""WITH {ACCOUNTED}
SELECT source, model, CAST(card_gb AS INTEGER) AS card_gb, CAST(n AS INTEGER) AS length,
       CAST(floor(budget / n) AS BIGINT) AS sequences
FROM accounted, (VALUES (512), (1024), (2048), (4096)) AS lengths(n)""",
    "capacity_at_quantiles": f"""WITH {ACCOUNTED}, {quantiles('source')}
SELECT source, model, CAST(card_gb AS INTEGER) AS card_gb, percent, length,
       CAST(floor(budget / greatest(length, 1)) AS BIGINT) AS sequences
FROM accounted JOIN quantiles USING (source)""",
    "length_quantiles": f"WITH {quantiles('lang')} SELECT * FROM quantiles",
    "capacity_at_observed_length": f"""WITH {ACCOUNTED}
SELECT source, model, CAST(card_gb AS INTEGER) AS card_gb,
       CAST(floor(budget / average_length) AS BIGINT) AS sequences
FROM accounted""",
    "capacity_findings": f"""WITH {ACCOUNTED}
SELECT source, model, CAST(card_gb AS INTEGER) AS card_gb,
       array_to_string(list_filter([
         CASE WHEN pool <= 0 THEN 'weights_exceed_memory' END,
         CASE WHEN target <> 0 AND budget <> 0 THEN
           CASE WHEN target > budget / max_model_len THEN 'oversubscribed'
                WHEN budget / max_model_len / target > 20 THEN 'too_conservative' END END,
         CASE WHEN most <> 0 AND target <> 0 AND most <= target THEN 'no_buffer' END],
         lambda f: f IS NOT NULL), ',') AS findings,
       CASE WHEN target <> 0 AND budget <> 0
            THEN round(budget / max_model_len / target, 6) END AS target_ratio
FROM accounted""",
}
