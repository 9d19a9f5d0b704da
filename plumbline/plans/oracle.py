"""DuckDB SQL of the core queries, formulated on its own."""

from __future__ import annotations

from plumbline.functions.text import AVOID_WORDS, CHOICE_WORDS, CONSTRAINT_WORDS, PROCEDURAL_WORDS, STRUCTURED_WORDS, TRAP_WORDS
from plumbline.operators.collect import HINTS
from plumbline.plans.analytics import FAMILIES, PERCENTS, TARGET_MODEL
from plumbline.plans.collecting import GOLDEN_MODEL, GOLDEN_SECONDS, GOLDEN_SET
from plumbline.schema import DIMENSIONS

Z = "1.959963984540054"

TASKS = """
tasks AS (
  SELECT id AS task_id, eval_session_id AS session_id, eval_set_id, content_id, no, end_at - start_at AS seconds, result
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dt DESC) AS place FROM eval_tasks)
  WHERE place = 1 AND status = 12 AND eval_set_id >= 10
),
ballots AS (
  SELECT t.*, CASE WHEN 2 * no <= max_no THEN 'EARLY' ELSE 'LATE' END AS time_bin,
    (e ->> '$.winner_id')::BIGINT AS winner_id, (e ->> '$.eval_dim_id')::BIGINT AS eval_dim_id, e ->> '$.eval_dim_key' AS eval_dim_key
  FROM tasks t
  JOIN (SELECT session_id AS s, max(no) AS max_no FROM tasks GROUP BY session_id) ON s = session_id,
  unnest(CASE WHEN json_valid(result) THEN json_extract(result, '$[*]') ELSE [] END) AS u(e)
)"""

ANSWERS = """
names AS (SELECT id, max(model_name) AS model_name FROM llm_models WHERE dt = (SELECT max(dt) FROM llm_models) GROUP BY id),
known AS (
  SELECT a.id AS answer_id, a.uuid, a.eval_set_id, a.eval_query_id, a.llm_model_id, n.model_name, a.game_id, a.content, length(coalesce(a.content, '')) AS chars
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, created_at DESC) AS place FROM llm_answers) a
  LEFT JOIN names n ON n.id = a.llm_model_id WHERE place = 1
)"""

MATCHUPS = f"""{ANSWERS},
pairs AS (
  SELECT c.id AS content_id, c.eval_set_id, c.eval_query_id, c.answer_left, c.answer_right, c.is_golden, l.game_id,
    l.llm_model_id AS left_id, r.llm_model_id AS right_id, l.model_name AS left_model, r.model_name AS right_model, l.chars AS left_chars, r.chars AS right_chars
  FROM (SELECT DISTINCT ON (id) * FROM eval_comparisons ORDER BY id, dt DESC) c
  LEFT JOIN known l ON (l.answer_id, l.eval_set_id, l.eval_query_id) = (c.answer_left, c.eval_set_id, c.eval_query_id)
  LEFT JOIN known r ON (r.answer_id, r.eval_set_id, r.eval_query_id) = (c.answer_right, c.eval_set_id, c.eval_query_id)
)"""

TRUTH = """
told AS (
  SELECT answer_id::VARCHAR AS uuid,
    CASE WHEN json_valid(generation_metadata) THEN lower(trim(generation_metadata ->> '$.correct')) END AS word
  FROM (SELECT *, row_number() OVER (PARTITION BY answer_id ORDER BY generated_at DESC) AS place FROM llm_answer) WHERE place = 1
),
said AS (
  SELECT k.id AS answer_id, word IN ('true', '1', 't', 'yes', 'y') AS yes
  FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY updated_at DESC, created_at DESC, id DESC) AS place FROM llm_answers) k
  JOIN told USING (uuid) WHERE place = 1 AND word IN ('true', '1', 't', 'yes', 'y', 'false', '0', 'f', 'no', 'n')
),
judged AS (
  SELECT p.*, CASE WHEN is_golden <> 1 THEN NULL
    WHEN coalesce(a.yes, false) AND NOT coalesce(b.yes, false) THEN answer_left
    WHEN coalesce(b.yes, false) AND NOT coalesce(a.yes, false) THEN answer_right END AS correct_answer
  FROM pairs p LEFT JOIN said a ON a.answer_id = answer_left LEFT JOIN said b ON b.answer_id = answer_right
)"""

PEOPLE = """
people AS (
  SELECT id AS session_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dt DESC) AS place FROM eval_sessions)
  WHERE place = 1 AND user_id IS NOT NULL
)"""

VOTES = f"{TASKS},{MATCHUPS}, votes AS (SELECT * FROM ballots JOIN pairs USING (content_id, eval_set_id))"
USER_VOTES = f"{TASKS},{MATCHUPS},{PEOPLE}, votes AS (SELECT * FROM ballots JOIN pairs USING (content_id, eval_set_id) JOIN people USING (session_id))"
GOLDEN_VOTES = f"{TASKS},{MATCHUPS},{TRUTH},{PEOPLE}, votes AS (SELECT * FROM ballots JOIN judged USING (content_id, eval_set_id) JOIN people USING (session_id))"

SIDES = """
sides AS (
  SELECT *, 'left' AS position, left_model AS model, right_model AS opponent, CASE WHEN winner_id = answer_left THEN 1 ELSE 0 END AS won FROM votes
  UNION ALL
  SELECT *, 'right', right_model, left_model, CASE WHEN winner_id = answer_right THEN 1 ELSE 0 END FROM votes
)"""

SESSIONS = """
sessions AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dt DESC) AS place FROM eval_sessions)
  WHERE place = 1 AND eval_set_id >= 10
)"""


def _pick(p: int, values: str = "seconds") -> str:
    """The discrete percentile by integer rank."""
    return f"list_sort(list({values}) FILTER (WHERE {values} IS NOT NULL))[(({p} * count({values}) + 99) // 100)::BIGINT]"


GOLDEN_CHECK = f"""{GOLDEN_VOTES},
firsts AS (
  SELECT *, seconds / 60.0::DOUBLE AS minutes FROM (
    SELECT *, row_number() OVER (PARTITION BY task_id, content_id ORDER BY eval_dim_id) AS n FROM votes WHERE is_golden = 1) WHERE n = 1
),
checked AS (
  SELECT user_id, count(*) AS golden_total,
    count(*) FILTER (WHERE minutes >= 0.25 AND correct_answer IS NOT NULL) AS golden_scored,
    count(*) FILTER (WHERE minutes >= 0.25 AND winner_id = correct_answer) AS golden_correct,
    count(*) FILTER (WHERE minutes < 0.25) AS too_fast,
    round(median(minutes), 6) AS median_minutes, round(avg(minutes), 6) AS avg_minutes
  FROM firsts GROUP BY user_id
),
rated AS (
  SELECT *, round(golden_correct / nullif(golden_scored, 0)::DOUBLE, 6) AS golden_accuracy, round(too_fast / golden_total::DOUBLE, 6) AS fast_rate FROM checked
)"""

TARGET = f"""{VOTES},{SIDES},
kinds AS (
  SELECT query_id AS eval_query_id, category, raw_query FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dm DESC) AS place FROM query_item) WHERE place = 1
),
mine AS (
  SELECT s.* EXCLUDE (game_id, result), coalesce(game_id, 'unknown') AS game_id, coalesce(category, 'UNCLASSIFIED') AS category, raw_query,
    CASE WHEN winner_id = 0 THEN 'draw' WHEN won = 1 THEN 'win' ELSE 'loss' END AS result
  FROM sides s LEFT JOIN kinds USING (eval_query_id) WHERE winner_id IS NOT NULL AND model = '{TARGET_MODEL}'
)"""

_TARGET_SUMS = """count(DISTINCT eval_query_id) AS queries, count(DISTINCT content_id) AS comparisons, count(*) AS votes,
  count(*) FILTER (WHERE result = 'win') AS wins, count(*) FILTER (WHERE result = 'loss') AS losses, count(*) FILTER (WHERE result = 'draw') AS draws,
  round(count(*) FILTER (WHERE result = 'win') / nullif(count(*) FILTER (WHERE result <> 'draw'), 0)::DOUBLE, 6) AS winrate"""


def _target_rates() -> str:
    family = " ".join(f"WHEN starts_with(lower(opponent), '{p}') THEN '{n}'" for n, p in FAMILIES.items())
    rate = "round(count(*) FILTER (WHERE result = 'win' AND {0}) / nullif(count(*) FILTER (WHERE result <> 'draw' AND {0}), 0)::DOUBLE, 6)"
    columns = [rate.format(f"eval_dim_key = '{d}'") + f" AS wr_{d}" for d in DIMENSIONS]
    columns += [rate.format(f"eval_dim_key = '{d}' AND family = '{n}'") + f" AS wr_{d}_{n}" for d in DIMENSIONS for n in FAMILIES]
    texts = [f"max(content) FILTER (WHERE starts_with(lower(model_name), '{p}')) AS {n}_answer" for n, p in {"target": TARGET_MODEL, **FAMILIES}.items()]
    return f"""WITH {TARGET},
      familied AS (SELECT *, CASE {family} END AS family FROM mine),
      texts AS (SELECT eval_query_id, {", ".join(texts)} FROM known WHERE eval_set_id >= 10 GROUP BY eval_query_id),
      rates AS (
        SELECT game_id, category, eval_query_id, max(raw_query) AS raw_query, count(DISTINCT content_id) AS comparisons, count(*) AS votes,
          count(*) FILTER (WHERE position = 'left') AS left_votes, count(*) FILTER (WHERE position = 'right') AS right_votes, {", ".join(columns)}
        FROM familied GROUP BY game_id, category, eval_query_id)
      SELECT * FROM rates LEFT JOIN texts USING (eval_query_id)"""


MATRIX = f"""{VOTES},{SIDES},
scored AS (
  SELECT game_id, eval_dim_key, model, opponent, position, time_bin, CASE WHEN winner_id = 0 THEN 0.5::DOUBLE ELSE won END AS points
  FROM sides WHERE is_golden = 0 AND winner_id IS NOT NULL AND model IS NOT NULL AND opponent IS NOT NULL
),
doubled AS (SELECT * FROM scored UNION ALL SELECT 'all', * EXCLUDE (game_id) FROM scored),
strata AS (
  SELECT game_id, eval_dim_key, model, opponent, position, time_bin, count(*) AS n, avg(points) AS rate, sum(points) AS points
  FROM doubled GROUP BY ALL
),
met AS (
  SELECT game_id, eval_dim_key, model AS row_model, opponent AS col_model, sum(n)::BIGINT AS total_matches, sum(points) / sum(n) AS raw, avg(rate) AS even,
    sum(n) FILTER (WHERE position = 'left' AND time_bin = 'EARLY') / sum(n) AS le, sum(n) FILTER (WHERE position = 'left' AND time_bin = 'LATE') / sum(n) AS ll,
    sum(n) FILTER (WHERE position = 'right' AND time_bin = 'EARLY') / sum(n) AS re, sum(n) FILTER (WHERE position = 'right' AND time_bin = 'LATE') / sum(n) AS rl
  FROM strata GROUP BY ALL
),
matrix AS (
  SELECT *, avg(total_matches) OVER (PARTITION BY game_id, eval_dim_key) AS usual FROM met
)"""

MATRIX_ROWS = """SELECT game_id, eval_dim_key, row_model, col_model, total_matches, round(raw, 6) AS raw_winrate, round(even, 6) AS stratified_winrate,
  round(0.5 + (raw - 0.5) * least(1.0, total_matches / usual), 6) AS confidence_adjusted_winrate, round(least(1.0, total_matches / usual), 6)::DOUBLE AS pair_confidence,
  round(usual, 6) AS avg_pair_matches, round(le, 6) AS weight_left_early, round(ll, 6) AS weight_left_late, round(re, 6) AS weight_right_early, round(rl, 6) AS weight_right_late,
  round(pow(coalesce(le, 0.25) - 0.25, 2) + pow(coalesce(ll, 0.25) - 0.25, 2) + pow(coalesce(re, 0.25) - 0.25, 2) + pow(coalesce(rl, 0.25) - 0.25, 2), 6) AS weight_variance
FROM matrix"""

IPW = f"""WITH {VOTES},
full_sessions AS (SELECT session_id FROM votes GROUP BY session_id HAVING count(DISTINCT content_id) = 18),
kept AS (SELECT * FROM votes WHERE is_golden = 0 AND winner_id IS NOT NULL AND session_id IN (FROM full_sessions)),
{SIDES.replace("FROM votes", "FROM kept")},
named AS (SELECT * FROM sides WHERE model IS NOT NULL),
shown AS (
  SELECT model AS m, avg((position = 'left')::INT) AS p_left, avg((time_bin = 'EARLY')::INT) AS p_early FROM named GROUP BY model
),
met AS (
  SELECT least(left_model, right_model) AS a, greatest(left_model, right_model) AS b, count(*) / (SELECT count(*) FROM kept)::DOUBLE AS p_pair FROM kept GROUP BY ALL
),
weighted AS (
  SELECT n.*, least(5.0, greatest(0.2, 1 / (
    (CASE position WHEN 'left' THEN p_left ELSE 1 - p_left END) * (CASE time_bin WHEN 'EARLY' THEN p_early ELSE 1 - p_early END) * coalesce(p_pair, 0.16667))))::DOUBLE AS w
  FROM named n JOIN shown ON m = model LEFT JOIN met ON a = least(model, opponent) AND b = greatest(model, opponent)
),
weights AS (
  SELECT model AS m, round(min(w), 6) AS min_weight, round(max(w), 6) AS max_weight, round(avg(w), 6) AS avg_weight, round(stddev_pop(w), 4) AS stddev_weight FROM weighted GROUP BY model
),
rates AS (
  SELECT game_id, eval_dim_key, model AS model_name, count(*) AS total_matches, sum(won)::BIGINT AS wins, avg(won) AS raw, sum(won * w) / sum(w) AS ipw, pow(sum(w), 2) / sum(w * w) AS eff
  FROM weighted GROUP BY ALL
)
SELECT game_id, eval_dim_key, model_name, total_matches, wins, round(raw, 6) AS raw_winrate, round(ipw, 6) AS ipw_winrate, round((ipw - raw) * 100, 4) AS correction_pct,
  round(eff, 3) AS effective_n, min_weight, max_weight, avg_weight, stddev_weight,
  CASE WHEN (ipw - raw) * 100 > 1 THEN 'upward_significant' WHEN (ipw - raw) * 100 < -1 THEN 'downward_significant' ELSE 'minor_adjustment' END AS direction
FROM rates LEFT JOIN weights ON m = model_name"""

FLAGS = f"""
limits AS (
  SELECT eval_set_id, content_id, {_pick(15)} AS p15 FROM votes WHERE is_golden = 0 GROUP BY eval_set_id, content_id
),
session_asked AS (
  SELECT session_id, eval_set_id, content_id, is_golden, max(seconds) AS seconds FROM votes GROUP BY ALL
),
session_flags AS (
  SELECT session_id, count(DISTINCT content_id) FILTER (WHERE is_golden = 0) >= 15 AS complete,
    count(*) FILTER (WHERE is_golden = 0 AND p15 IS NOT NULL) > 0 AND count(*) FILTER (WHERE is_golden = 0 AND seconds < p15) = 0 AS unhurried
  FROM session_asked LEFT JOIN limits USING (eval_set_id, content_id) GROUP BY session_id
),
passed AS (
  SELECT session_id, unnest(list_filter(['no_filter', CASE WHEN complete THEN 'complete' END, CASE WHEN unhurried THEN 'unhurried' END,
    CASE WHEN complete OR unhurried THEN 'either' END, CASE WHEN complete AND unhurried THEN 'both' END], lambda x: x IS NOT NULL)) AS filter
  FROM session_flags
)"""


def _proportion(method: str, source: str, subject: str, expected: str, above: str, below: str, neither: str) -> str:
    return f"""SELECT '{method}' AS method, filter, subject, n, k, round(p, 6) AS p_hat, round(lo, 6) AS ci_low, round(hi, 6) AS ci_high,
        CASE WHEN lo > q THEN '{above}' WHEN hi < q THEN '{below}' ELSE '{neither}' END AS decision,
        CASE WHEN lo > q OR hi < q THEN 'significant' ELSE 'not-significant' END AS significance,
        round(abs(p - q) / nullif(sqrt(p * (1 - p) / n), 0), 4) AS z_score, round((p - q) * 100, 4) AS effect,
        round(100 * CASE WHEN lo > q THEN lo - q WHEN hi < q THEN q - hi ELSE -least(abs(lo - q), abs(hi - q)) END, 4) AS ci_margin
      FROM (SELECT *, greatest(0.0, (p + {Z} * {Z} / (2 * n) - {Z} * sqrt((p * (1 - p) + {Z} * {Z} / (4 * n)) / n)) / (1 + {Z} * {Z} / n)) AS lo,
              least(1.0, (p + {Z} * {Z} / (2 * n) + {Z} * sqrt((p * (1 - p) + {Z} * {Z} / (4 * n)) / n)) / (1 + {Z} * {Z} / n)) AS hi
            FROM (SELECT *, k / n::DOUBLE AS p, {expected} AS q FROM (SELECT filter, {subject} AS subject, {source} GROUP BY ALL)))"""


def _balance(method: str, source: str, word: str) -> str:
    return f"""SELECT '{method}' AS method, filter, subject, n, n AS k, round(n / total::DOUBLE, 6) AS p_hat, NULL::DOUBLE AS ci_low, NULL::DOUBLE AS ci_high,
        CASE WHEN z > 1.96 THEN 'over-{word}' WHEN z < -1.96 THEN 'under-{word}' ELSE 'balanced' END AS decision,
        CASE WHEN abs(z) > 1.96 THEN 'significant' ELSE 'not-significant' END AS significance,
        round(z, 4) AS z_score, round(n - usual, 4) AS effect, round(abs(z) - 1.96, 4) AS ci_margin
      FROM (SELECT *, (n - usual) / sqrt(usual) AS z FROM (
        SELECT *, avg(n) OVER (PARTITION BY filter) AS usual, sum(n) OVER (PARTITION BY filter) AS total FROM ({source})))"""


BIAS = f"""WITH {VOTES},{FLAGS},
kept AS (
  SELECT v.*, p.filter, CASE winner_id WHEN answer_left THEN 'left' WHEN answer_right THEN 'right' END AS winner
  FROM votes v JOIN passed p USING (session_id) WHERE is_golden = 0
),
decided AS (SELECT * FROM kept WHERE winner IS NOT NULL),
shown AS (
  SELECT filter, 'left' AS position, left_model AS model, time_bin FROM kept WHERE left_model IS NOT NULL
  UNION ALL SELECT filter, 'right', right_model, time_bin FROM kept WHERE right_model IS NOT NULL
),
halves AS (
  SELECT filter, count(*) FILTER (WHERE time_bin = 'EARLY') AS n1, count(*) FILTER (WHERE time_bin = 'LATE') AS n2,
    count(*) FILTER (WHERE time_bin = 'EARLY' AND winner = 'left') AS k1, count(*) FILTER (WHERE time_bin = 'LATE' AND winner = 'left') AS k2
  FROM decided GROUP BY filter
),
gaps AS (
  SELECT *, k1 / n1::DOUBLE - k2 / n2::DOUBLE AS gap, sqrt(k1 / n1::DOUBLE * (1 - k1 / n1::DOUBLE) / n1 + k2 / n2::DOUBLE * (1 - k2 / n2::DOUBLE) / n2) AS se FROM halves
),
lengths AS (
  SELECT filter, left_chars::DOUBLE AS x, (winner = 'left')::INT::DOUBLE AS y FROM decided WHERE left_chars > 0
  UNION ALL SELECT filter, right_chars::DOUBLE, (winner = 'right')::INT::DOUBLE FROM decided WHERE right_chars > 0
),
related AS (
  SELECT *, tanh(atanh(r) - {Z} / sqrt(n - 3)) AS lo, tanh(atanh(r) + {Z} / sqrt(n - 3)) AS hi
  FROM (SELECT filter, count(*) AS n, corr(x, y) AS r FROM lengths GROUP BY filter HAVING count(*) >= 100)
)
SELECT 'data_quality' AS method, filter, 'NULL_filtering' AS subject, count(*) AS n, count(*) FILTER (WHERE winner IS NULL) AS k,
  round(avg((winner IS NULL)::INT), 6) AS p_hat, NULL::DOUBLE AS ci_low, NULL::DOUBLE AS ci_high,
  'filtered_out_' || count(*) FILTER (WHERE winner IS NULL) || '_records' AS decision,
  CASE WHEN avg((winner IS NULL)::INT) * 100 > 5 THEN 'warning' ELSE 'normal' END AS significance,
  NULL::DOUBLE AS z_score, round(100 * avg((winner IS NULL)::INT), 4) AS effect, NULL::DOUBLE AS ci_margin
FROM kept GROUP BY filter
UNION ALL {_proportion("position_bias", "count(*) AS n, count(*) FILTER (WHERE winner = 'left') AS k FROM (SELECT filter, winner, unnest([eval_dim_key, '_ALL_']) AS dim FROM decided)", "dim", "0.5", "left", "right", "non-significant")}
UNION ALL {_proportion("time_exposure", "count(*) AS n, count(*) FILTER (WHERE time_bin = 'EARLY') AS k FROM shown", "model", "sum(k) OVER (PARTITION BY filter) / sum(n) OVER (PARTITION BY filter)", "early-heavy", "late-heavy", "balanced")}
UNION ALL {_proportion("model_position_bias", "count(*) AS n, count(*) FILTER (WHERE position = 'left') AS k FROM shown", "model", "0.5", "left-biased", "right-biased", "balanced")}
UNION ALL {_balance("model_exposure_balance", "SELECT filter, model AS subject, count(*) AS n FROM shown GROUP BY ALL", "exposed")}
UNION ALL {_balance("model_pairing_balance", "SELECT filter, least(left_model, right_model) || ' vs ' || greatest(left_model, right_model) AS subject, count(*) AS n FROM kept WHERE left_model IS NOT NULL AND right_model IS NOT NULL GROUP BY ALL", "paired")}
UNION ALL
SELECT 'order_bias', filter, 'EARLY_vs_LATE', n1 + n2, NULL, round(gap, 6), round(gap - {Z} * se, 6), round(gap + {Z} * se, 6),
  CASE WHEN gap - {Z} * se > 0 THEN 'early-higher' WHEN gap + {Z} * se < 0 THEN 'late-higher' ELSE 'no-difference' END,
  CASE WHEN abs(gap) > {Z} * se THEN 'significant' ELSE 'not-significant' END, round(abs(gap) / nullif(se, 0), 4), round(100 * gap, 4),
  round(100 * CASE WHEN abs(gap) > {Z} * se THEN abs(gap) - {Z} * se ELSE -least(abs(gap - {Z} * se), abs(gap + {Z} * se)) END, 4)
FROM gaps
UNION ALL
SELECT 'answer_length_winrate_corr', filter, 'answer_length_vs_winrate', n, NULL, round(r, 6), round(lo, 6), round(hi, 6),
  CASE WHEN lo > 0 THEN 'length-positive' WHEN hi < 0 THEN 'length-negative' ELSE 'no-correlation' END,
  CASE WHEN lo > 0 OR hi < 0 THEN 'significant' ELSE 'not-significant' END, round(abs(r * sqrt(n - 2) / sqrt(1 - r * r)), 4), round(100 * r, 4),
  round(100 * CASE WHEN lo > 0 THEN lo WHEN hi < 0 THEN -hi ELSE -least(abs(lo), abs(hi)) END, 4)
FROM related"""


def _times() -> str:
    values = ", ".join(f"{_pick(p)} AS p{p:02d}" for p in PERCENTS)
    limits = ", ".join(f"{_pick(p)} AS t{p:02d}" for p in PERCENTS)
    flags = ", ".join(f"max((seconds < t{p:02d})::INT) AS f{p:02d}" for p in PERCENTS)
    sums = ", ".join(f"sum(f{p:02d})::BIGINT AS e{p:02d}" for p in PERCENTS)
    rows = " UNION ALL ".join(f"SELECT game_id, 'P{p:02d}' AS percentile, round(p{p:02d} / 60.0::DOUBLE, 6) AS minutes, coalesce(e{p:02d}, 0) AS excluded_users, total_users FROM spread LEFT JOIN excluded USING (game_id) LEFT JOIN totals USING (game_id)" for p in PERCENTS)
    return f"""WITH {USER_VOTES},
      asked AS (SELECT user_id, eval_set_id, game_id, content_id, max(seconds) AS seconds FROM votes WHERE is_golden = 0 GROUP BY ALL),
      doubled AS (SELECT * FROM asked UNION ALL SELECT * REPLACE ('all' AS game_id) FROM asked),
      spread AS (SELECT game_id, {values} FROM doubled GROUP BY game_id),
      totals AS (SELECT game_id, count(DISTINCT user_id) AS total_users FROM doubled GROUP BY game_id),
      limits AS (SELECT eval_set_id, content_id, {limits} FROM asked GROUP BY ALL),
      flagged AS (SELECT user_id, eval_set_id, game_id, {flags} FROM asked JOIN limits USING (eval_set_id, content_id) GROUP BY ALL),
      excluded AS (SELECT game_id, {sums} FROM (SELECT * FROM flagged UNION ALL SELECT * REPLACE ('all' AS game_id) FROM flagged) GROUP BY game_id)
      {rows}"""


QUALITY = f"""WITH {USER_VOTES},
limits AS (SELECT eval_set_id, content_id, {_pick(15)} AS p15 FROM votes GROUP BY ALL),
asked AS (SELECT user_id, eval_set_id, game_id, content_id, is_golden, max(seconds) AS seconds FROM votes GROUP BY ALL),
flags AS (
  SELECT user_id, eval_set_id, game_id, count(DISTINCT content_id) FILTER (WHERE is_golden = 0) >= 15 AS complete,
    count(*) FILTER (WHERE is_golden = 0 AND p15 IS NOT NULL) > 0 AND count(*) FILTER (WHERE is_golden = 0 AND seconds < p15) = 0 AS unhurried
  FROM asked LEFT JOIN limits USING (eval_set_id, content_id) GROUP BY ALL
),
named AS (
  SELECT *, unnest(['complete', 'unhurried', 'either', 'both', 'total']) AS filter,
    unnest([complete, unhurried, complete OR unhurried, complete AND unhurried, true]) AS held FROM flags
)
SELECT game_id, filter, count(DISTINCT user_id) FILTER (WHERE held) AS users FROM named GROUP BY ALL
UNION ALL SELECT 'all', filter, count(*) FILTER (WHERE held) FROM named GROUP BY filter"""

ANSWERED = f"""{GOLDEN_VOTES},
questions AS (
  SELECT user_id, eval_set_id, game_id, content_id, is_golden, max(seconds) / 60.0::DOUBLE AS minutes,
    min(CASE WHEN is_golden = 1 AND winner_id IS NOT NULL AND correct_answer IS NOT NULL THEN (winner_id = correct_answer)::INT END) AS ok
  FROM votes GROUP BY ALL
),
answered AS (SELECT * FROM questions UNION ALL SELECT * REPLACE ('all' AS game_id) FROM questions),
golden AS (
  SELECT game_id, content_id, count(DISTINCT user_id) AS attempts, count(*) FILTER (WHERE ok = 1) AS "right", count(*) FILTER (WHERE ok = 0) AS wrong,
    round(count(*) FILTER (WHERE ok = 1) / count(DISTINCT user_id)::DOUBLE, 6) AS right_rate, round(avg(minutes), 6) AS avg_minutes, round(median(minutes), 6) AS median_minutes
  FROM answered WHERE is_golden = 1 GROUP BY ALL
)"""


POOL = """
pool AS (
  SELECT query_id, game_id, game_name, raw_query, coalesce(lower(trim(category)), 'unclassified') AS category
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dm DESC) AS place FROM query_item) WHERE place = 1
)"""

INVALID = """(length(trim(coalesce(raw_query, ''))) <= 5
  OR length(regexp_replace(trim(coalesce(raw_query, '')), '[^\\p{L}\\p{N}]', '', 'g')) / greatest(length(trim(coalesce(raw_query, ''))), 1)::DOUBLE < 0.3)"""

GROUPS = """
links AS (
  SELECT query_id_a AS a, query_id_b AS b FROM query_match WHERE is_match = 1 AND query_id_a <> query_id_b
  UNION SELECT query_id_b, query_id_a FROM query_match WHERE is_match = 1 AND query_id_a <> query_id_b
),
reached(id, other) AS (
  SELECT a, a FROM links UNION SELECT reached.id, links.b FROM reached JOIN links ON reached.other = links.a
),
grouped AS (SELECT id, min(other) AS component FROM reached GROUP BY id)"""

MARKED = f"""{GROUPS},{POOL},
marked AS (
  SELECT p.*, coalesce(first_value(query_id) OVER (PARTITION BY coalesce(component, -query_id) ORDER BY length(coalesce(raw_query, '')) DESC, query_id), query_id) AS canonical_id
  FROM pool p LEFT JOIN grouped ON id = query_id
),
told AS (SELECT *, CASE WHEN canonical_id = query_id THEN 'relevant' ELSE 'duplicate' END AS status FROM marked)"""

CANDIDATES = f"""{MARKED},
candidates AS (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY total_score DESC, query_id) AS represent_rank
  FROM (SELECT *, round(0.3::DOUBLE * least(100, 25 * len(regexp_extract_all(raw_query, '[0-9]+')))
          + 0.3::DOUBLE * least(100, 15 * len(regexp_extract_all(raw_query, '[,，;；:：|、]'))) + 0.4::DOUBLE * least(100, length(raw_query)), 4) AS total_score
        FROM told WHERE status = 'relevant' AND NOT {INVALID})
),
counts AS (SELECT category, count(*) AS queries FROM candidates GROUP BY category),
exact AS (SELECT *, round(queries * 60.0::DOUBLE / sum(queries) OVER (), 9) AS x FROM counts),
seats AS (
  SELECT category, queries, (floor(x) + (row_number() OVER (ORDER BY x - floor(x) DESC, category) <= 60 - sum(floor(x)) OVER ())::INT)::BIGINT AS quota FROM exact
)"""

#: Model names of the test tables, in the order of the columns of wide tables.
MODELS = ("fennel-pro", "heron-large", "juniper-x", "orbit-mini", "quartz-7", "sable-chat", "tamarin-2", "wicker-base")

CLEAN_ANSWERS = """
said AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY answer_id ORDER BY generated_at DESC) AS place FROM llm_answer) WHERE place = 1)"""


CLEANING = (
    ("links", r"(?i)\[([^\]]+)\]\(\s*(?:https?://|www\.)[^\s)]+\s*\)", r"\1"),
    ("urls", r"(?i)(^|[^\p{L}\p{N}_])(?:(?:https?://|www\.)\S+|(?:[a-z0-9-]+\.)+[a-z]{2,}(?:/[\w\-.~/?#%&=+]*)?)", r"\1"),
    ("citations", r"(?i)\[\s*\^?(?:\d+|refs?|cite|note\d*|footnote\d*|source\d*)\s*\]", ""),
    ("emoji", r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{1F000}-\x{1F02F}\x{FE0F}\x{200D}]+", ""),
    ("empty_parens", r"\(\s*\)", ""),
    ("empty_brackets", r"\[\s*\]", ""),
    ("bullets", r"(?m)^([\t ]*)[*•·●▪◦➤▹►]+[ \t]+", r"\1- "),
)


def _cleaned() -> str:
    """The cleaning as a chain of subqueries, each of which counts and replaces."""
    rows = "SELECT *, answer_content AS t FROM said"
    for name, pattern, put in CLEANING:
        rows = f"SELECT * EXCLUDE (t), regexp_replace(t, '{pattern}', '{put}', 'g') AS t, len(regexp_extract_all(t, '{pattern}')) AS {name} FROM ({rows})"
    for pattern, put in ((r"[ \t]+\n", "' || chr(10) || '"), (r"\n{3,}", "' || chr(10) || chr(10) || '"), (r" {2,}", " "), (r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")):
        rows = f"SELECT * EXCLUDE (t), regexp_replace(t, '{pattern}', '{put}', 'g') AS t FROM ({rows})"
    return f"{CLEAN_ANSWERS}, tidy AS ({rows})"


def _chars(text: str) -> str:
    """Letters, digits and underscores of a text without fences, numbers in brackets and the usual opening."""
    for pattern in (r"(?s)```.*?```", r"\[\d+\]", r"关于《.*?》.*?以下是详细解答[:：]"):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    return rf"length(regexp_replace({text}, '[^\p{{L}}\p{{N}}_]+', '', 'g'))"


def _meaningful(text: str) -> str:
    body = rf"regexp_replace(coalesce({text}, ''), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
    return f"(lower({body}) NOT IN ('', '{{}}', '[]', 'null', 'none') AND {_chars(body)} >= 5)"


def _tokens(text: str) -> str:
    wide = rf"len(regexp_extract_all({text}, '[\x{{4e00}}-\x{{9fff}}]'))"
    return f"floor({wide} / 1.5::DOUBLE + (length({text}) - {wide}) / 4.0::DOUBLE)"


def _any(words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(raw_query, '{w}')" for w in words) + ")"


MARKS = " + ".join(f"contains(raw_query, '{w}')::INT" for w in CONSTRAINT_WORDS)
TAGS = rf"""list_filter([
  CASE WHEN regexp_matches(raw_query, '(^|[^\p{{L}}\p{{N}}_])\d+(\.\d+){{1,2}}([^\p{{L}}\p{{N}}_]|$)') OR regexp_matches(raw_query, '(^|[^\p{{L}}\p{{N}}_])[sS]\d+([^\p{{L}}\p{{N}}_]|$)|赛季\d+|第\d+赛季')
    OR {_any(TRAP_WORDS)} THEN 'trap_unreleased' END,
  CASE WHEN {_any(PROCEDURAL_WORDS)} THEN 'procedural' END,
  CASE WHEN {_any(STRUCTURED_WORDS)} THEN 'structured' END,
  CASE WHEN {MARKS} >= 2 OR ({MARKS} >= 1 AND len(regexp_extract_all(raw_query, '[，,；;、]')) >= 2) OR ({_any(AVOID_WORDS)} AND {_any(CHOICE_WORDS)}) THEN 'constraint_heavy' END
], lambda x: x IS NOT NULL)"""

PARTED = r"""
named_parts AS (
  SELECT *, CASE WHEN regexp_matches(raw_query, '[=＝]|^\s*\{') THEN 'fields' WHEN regexp_matches(raw_query, '[\x{4e00}-\x{9fff}]') THEN 'chinese'
    WHEN regexp_matches(raw_query, '[?？]') THEN 'question' END AS part FROM pool
),
part_sizes AS (SELECT category, part, count(*) AS n, sum(count(*)) OVER (PARTITION BY category) AS all_n,
  coalesce(sum(count(*) FILTER (WHERE part IS NULL)) OVER (PARTITION BY category), 0) AS lost FROM named_parts GROUP BY category, part),
largest_parts AS (SELECT category, part AS largest FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, part) AS p FROM part_sizes WHERE part IS NOT NULL) WHERE p = 1),
parted AS (
  SELECT s.category, n, CASE WHEN all_n <= 50 OR largest IS NULL THEN s.category
    WHEN part IS NULL OR n + CASE WHEN part = largest THEN lost ELSE 0 END < 20 THEN largest ELSE part END AS rank_category
  FROM part_sizes s LEFT JOIN largest_parts USING (category)
)"""

EDGES = """
near AS (
  SELECT a, b, s FROM (
    SELECT a.vec_id AS a, b.vec_id AS b, a.label AS la, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s,
      row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC, b.vec_id) AS place
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0) WHERE place <= 10 AND a < b AND s >= 0.4
)"""

PICKED = """
tagged AS (SELECT query_id, category, represent_rank, represent_rank <= quota AS quota_met FROM candidates JOIN seats USING (category)),
placed AS (SELECT *, row_number() OVER (ORDER BY quota_met DESC, represent_rank, category, query_id) AS p FROM tagged),
picked AS (SELECT query_id, category, represent_rank, CASE WHEN quota_met THEN 'category_quota' ELSE 'top_up' END AS reason FROM placed WHERE p <= 60)"""

GOLDEN_ITEMS = f"""{CLEAN_ANSWERS},
right_ones AS (
  SELECT query_id, answer_content, CASE WHEN json_valid(generation_metadata) THEN lower(trim(generation_metadata ->> '$.correct')) END AS word FROM said
),
pairs AS (
  SELECT query_id, min(answer_content) FILTER (WHERE word IN ('true', '1', 't', 'yes', 'y')) AS good, min(answer_content) FILTER (WHERE word IN ('false', '0', 'f', 'no', 'n')) AS bad
  FROM right_ones GROUP BY query_id
),
items AS (
  SELECT query_id AS item, raw_query AS question, good, bad, row_number() OVER (ORDER BY query_id) AS number
  FROM pairs JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dm DESC) AS place FROM query_item) WHERE place = 1) USING (query_id)
  WHERE raw_query IS NOT NULL AND good IS NOT NULL AND bad IS NOT NULL AND trim(good, ' ') <> trim(bad, ' ')
),
sided AS (SELECT *, unnest([0, 1]) AS side, substring(md5(item::VARCHAR), 1, 1) < '8' AS swapped FROM items),
written AS (SELECT *, (side = 0) = swapped AS correct, (SELECT max(query_id) FROM query_item) + number AS query_id FROM sided)"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {
        "q01_daily_users": f"""WITH {SESSIONS}
            SELECT strftime(make_timestamp(start_at * 1000000), '%Y-%m-%d') AS eval_date, count(DISTINCT user_id) AS total_users,
              count(DISTINCT user_id) FILTER (WHERE status = 5) AS submit_users,
              round(count(DISTINCT user_id) FILTER (WHERE status = 5) / nullif(count(DISTINCT user_id), 0)::DOUBLE, 6) AS submit_rate
            FROM sessions GROUP BY eval_date""",
        "q02_model_text_lengths": """
            WITH a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY answer_id ORDER BY generated_at DESC) AS place FROM llm_answer) WHERE place = 1),
            q AS (SELECT query_id, game_id, raw_query FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dm DESC) AS place FROM query_item) WHERE place = 1)
            SELECT model_id, model_name, round(avg(length(raw_query)), 4) AS avg_query_chars, round(avg(strlen(raw_query)), 4) AS avg_query_bytes,
              round(avg(length(answer_content)), 4) AS avg_answer_chars, round(avg(strlen(answer_content)), 4) AS avg_answer_bytes, count(*) AS samples
            FROM a JOIN q USING (query_id, game_id) GROUP BY model_id, model_name""",
        "q03_session_funnel": f"""WITH {SESSIONS}, doubled AS (SELECT * FROM sessions UNION ALL SELECT * REPLACE ('all' AS game_id) FROM sessions)
            SELECT game_id, eval_set_id, CASE status WHEN 1 THEN 'quit' WHEN 4 THEN 'ongoing' WHEN 5 THEN 'submit' END AS eval_status,
              count(DISTINCT user_id) AS users, round(median((end_at - start_at) / 60.0::DOUBLE), 6) AS median_minutes, count(*) FILTER (WHERE submitted = 0) AS quick_quits,
              round(count(*) FILTER (WHERE submitted = 0) / nullif(count(DISTINCT user_id), 0)::DOUBLE, 6) AS quick_quit_rate
            FROM doubled GROUP BY game_id, eval_set_id, status""",
        "q04_golden_check": f"WITH {GOLDEN_CHECK} SELECT * FROM rated",
        "q05_target_by_category": f"""WITH {TARGET}
            SELECT 'by_category' AS level, game_id, category, NULL AS eval_dim_key, {_TARGET_SUMS} FROM mine GROUP BY game_id, category
            UNION ALL SELECT 'by_category_eval_dim', game_id, category, eval_dim_key, {_TARGET_SUMS} FROM mine GROUP BY game_id, category, eval_dim_key""",
        "q06_target_by_query": _target_rates(),
        "q07_winrate_matrix": f"WITH {MATRIX} {MATRIX_ROWS}",
        "q08_ipw_winrates": IPW,
        "q09_bias_battery": BIAS,
        "q09a_session_filters": f"WITH {VOTES},{FLAGS} SELECT filter, count(*) AS sessions FROM passed GROUP BY filter",
        "q10_answer_times": _times(),
        "q11_user_quality": QUALITY,
        "q12a_user_behaviour": f"""WITH {ANSWERED}, one AS (
              SELECT user_id, eval_set_id, game_id, count(DISTINCT content_id) AS answered, count(*) FILTER (WHERE ok = 1) AS good, count(*) FILTER (WHERE is_golden = 1) AS golden_n,
                count(*) FILTER (WHERE is_golden <> 1) AS normal, avg(minutes) AS mean, median(minutes) AS middle
              FROM answered GROUP BY ALL)
            SELECT game_id, count(DISTINCT user_id) AS users, round(avg(answered), 6) AS avg_answered, round(avg(18 - answered), 6) AS avg_skipped, round(avg(good), 6) AS avg_golden_right,
              round(avg(normal), 6) AS avg_normal, round(avg(mean), 6) AS avg_minutes, round(avg(middle), 6) AS avg_median_minutes,
              round(count(*) FILTER (WHERE answered = 18) / count(DISTINCT user_id)::DOUBLE, 6) AS completion_rate,
              round(count(*) FILTER (WHERE good = golden_n AND golden_n > 0) / count(DISTINCT user_id)::DOUBLE, 6) AS golden_perfect_rate
            FROM one GROUP BY game_id""",
        "q12b_golden_questions": f"WITH {ANSWERED} SELECT * FROM golden",
        "q12c_golden_details": f"""WITH {ANSWERED},
            asked AS (SELECT query_id, raw_query FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dm DESC) AS place FROM query_item) WHERE place = 1)
            SELECT g.game_id, g.content_id, attempts, "right", right_rate, avg_minutes, j.eval_set_id, j.eval_query_id, j.answer_left, j.answer_right, j.correct_answer,
              raw_query AS question, l.content AS left_text, r.content AS right_text,
              CASE correct_answer WHEN answer_left THEN 'LEFT' WHEN answer_right THEN 'RIGHT' ELSE 'UNKNOWN' END AS correct_side
            FROM golden g JOIN judged j ON j.content_id = g.content_id AND j.is_golden = 1 LEFT JOIN asked ON query_id = eval_query_id
            LEFT JOIN known l ON l.answer_id = answer_left LEFT JOIN known r ON r.answer_id = answer_right WHERE g.game_id <> 'all'""",
        "b14_user_verdicts": f"""WITH {GOLDEN_CHECK}
            SELECT user_id, golden_scored, golden_accuracy, fast_rate, CASE
              WHEN golden_scored >= 3 AND golden_accuracy < 0.6 AND fast_rate > 0.3 THEN 'inaccurate_and_fast' WHEN golden_scored >= 3 AND golden_accuracy < 0.6 THEN 'inaccurate'
              WHEN fast_rate > 0.3 THEN 'fast' ELSE 'good' END AS verdict FROM rated""",
        "b08_game_balance": f"""WITH {MATRIX}, totals AS (SELECT game_id, sum(total_matches)::BIGINT AS matches FROM matrix WHERE game_id <> 'all' GROUP BY game_id)
            SELECT game_id, matches, round(max(matches) OVER () / matches::DOUBLE, 6) AS factor, round(max(matches) OVER (), 3)::DOUBLE AS balanced_matches FROM totals""",
        "b09_winrate_differences": f"""WITH {MATRIX}, rows AS ({MATRIX_ROWS})
            SELECT game_id, eval_dim_key, row_model, col_model, total_matches, round(stratified_winrate - raw_winrate, 6) AS diff, round(abs(stratified_winrate - raw_winrate), 6) AS abs_diff FROM rows""",
        "b09_difference_summary": f"""WITH {MATRIX}, rows AS ({MATRIX_ROWS}), d AS (SELECT round(abs(stratified_winrate - raw_winrate), 6) AS x FROM rows)
            SELECT count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50,
              round(quantile_cont(x, 0.75), 6) AS p75, max(x) AS max FROM d""",
        "b10_matrix_labels": f"""WITH {MATRIX}, rows AS ({MATRIX_ROWS})
            SELECT eval_dim_key, row_model, col_model, printf('%d.%02d%% (n=%d)', c // 100, c % 100, total_matches) AS label
            FROM (SELECT *, (round(stratified_winrate * 1e6)::BIGINT + 50) // 100 AS c FROM rows WHERE game_id = 'all')""",
        "b11_dimension_shares": f"""WITH {MATRIX}, rows AS ({MATRIX_ROWS}),
            p AS (SELECT game_id, row_model AS model, eval_dim_key, sum(raw_winrate * total_matches) AS x FROM rows WHERE game_id <> 'all' GROUP BY ALL)
            SELECT game_id, model, {", ".join(f"round(coalesce(100 * sum(x) FILTER (WHERE eval_dim_key = '{d}') / nullif(sum(x), 0), 0), 2) AS {d}" for d in DIMENSIONS)} FROM p GROUP BY game_id, model""",
        "g02_exact_dedup": f"""WITH {POOL} SELECT query_id, raw_query FROM pool WHERE raw_query IS NULL
            UNION ALL SELECT min(query_id), raw_query FROM pool WHERE raw_query IS NOT NULL GROUP BY raw_query""",
        "g02_folded_dedup": f"""WITH {POOL}, f AS (SELECT *, trim(regexp_replace(regexp_replace(lower(raw_query), '[\\p{{P}}\\p{{S}}]', '', 'g'), '\\s+', ' ', 'g'), ' ') AS body FROM pool)
            SELECT query_id, raw_query FROM f WHERE body IS NULL OR query_id = (SELECT min(query_id) FROM f g WHERE g.body = f.body)""",
        "g03_invalid_queries": f"WITH {POOL} SELECT query_id, raw_query FROM pool WHERE {INVALID}",
        "g06_neighbours": """SELECT query_id, neighbour_id, round(s, 4) AS similarity, place FROM (
              SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s,
                row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC, b.vec_id) AS place
              FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0) WHERE place <= 10""",
        "g08_duplicate_groups": f"WITH RECURSIVE {GROUPS} SELECT id, component FROM grouped",
        "g10_marked_duplicates": f"WITH RECURSIVE {MARKED} SELECT query_id, canonical_id, status FROM told",
        "g12_scores": f"WITH RECURSIVE {CANDIDATES} SELECT query_id, category, total_score, represent_rank FROM candidates",
        "g13_quotas": f"WITH RECURSIVE {CANDIDATES} SELECT category, queries, quota FROM seats",
        "g16_selection": f"""WITH RECURSIVE {CANDIDATES},
            tagged AS (SELECT query_id, category, represent_rank, represent_rank <= quota AS quota_met FROM candidates JOIN seats USING (category)),
            placed AS (SELECT *, row_number() OVER (ORDER BY quota_met DESC, represent_rank, category, query_id) AS p FROM tagged)
            SELECT query_id, category, represent_rank, CASE WHEN quota_met THEN 'category_quota' ELSE 'top_up' END AS reason FROM placed WHERE p <= 60""",
        "g21_run_summary": f"""WITH RECURSIVE {MARKED},
            o AS (SELECT category, CASE WHEN status = 'duplicate' THEN 'duplicate' WHEN {INVALID} THEN 'irrelevant' ELSE 'relevant' END AS outcome FROM told)
            SELECT outcome, count(*) AS queries, count(DISTINCT category) AS categories, round(count(*) / (SELECT count(*) FROM o)::DOUBLE, 6) AS share FROM o GROUP BY outcome""",
        "c09_latest_sets": """SELECT game_id, set_id, dm, strftime(last_day((dm || '-01')::DATE), '%Y-%m-%d') AS month_end FROM (
              SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY dm DESC, set_id DESC) AS p FROM query_item WHERE set_id IS NOT NULL) WHERE p = 1""",
        "c11_answer_statistics": f"""WITH {CLEAN_ANSWERS}, v AS (SELECT *, {_meaningful("answer_content")} AS good FROM said)
            SELECT model_name, count(*) AS answers, count(*) FILTER (WHERE good) AS succeeded, count(*) FILTER (WHERE NOT good) AS empty, sum({_tokens("answer_content")})::BIGINT AS tokens
            FROM v GROUP BY model_name""",
        "c04_cleaned_answers": f"""WITH {_cleaned()} SELECT answer_id, t AS clean_text, {" + ".join(n for n, _, _ in CLEANING)} = 0 AS unchanged, {_meaningful("t")} AS meaningful,
            {", ".join(n for n, _, _ in CLEANING)} FROM tidy""",
        "c04_answer_metadata": f"""WITH {_cleaned()} SELECT answer_id, model_name AS model, {_tokens("t")}::BIGINT AS tokens, {" + ".join(n for n, _, _ in CLEANING)} = 0 AS raw_equals_clean FROM tidy""",
        "c07_wide_answers": f"""WITH {CLEAN_ANSWERS} SELECT query_id, {", ".join(f"""min(length(answer_content)) FILTER (WHERE model_name = '{m}') AS "{m}" """ for m in sorted((*MODELS, "golden-author")))}
            FROM said GROUP BY query_id""",
        "c10_named_models": """SELECT id AS model_id, max(model_name) AS model_name, upper(substring(max(model_name), 1, 4)) AS short FROM llm_models
            WHERE dt = (SELECT max(dt) FROM llm_models) GROUP BY id HAVING lower(max(model_name)) IN ('orbit-mini', 'quartz-7')""",
        "c13_golden_items": f"""WITH {GOLDEN_ITEMS}
            SELECT query_id, question, side, regexp_replace(CASE WHEN correct THEN good ELSE bad END, '[。，]+$', '') || CASE side WHEN 0 THEN '{HINTS[0]}' ELSE '{HINTS[1]}' END AS answer,
              ({GOLDEN_SECONDS} + (number - 1) // 100) * 1000000000 + {GOLDEN_MODEL % 100} * 10000000 + {GOLDEN_SET % 1000} * 10000 + (query_id * 100 + side + 1) % 10000 AS answer_id,
              '{{"correct":' || correct || ',"selection":"' || CASE side WHEN 0 THEN 'modelA' ELSE 'modelB' END || '","anti_cheat":true}}' AS generation_metadata FROM written""",
        "c14_games": """SELECT game_id, game_name, set_id FROM (
              SELECT *, row_number() OVER (PARTITION BY game_id, game_name ORDER BY dm DESC NULLS LAST, set_id DESC NULLS LAST) AS p FROM query_item) WHERE p = 1""",
        "f13_text_measures": rf"""WITH {POOL} SELECT query_id, {_tokens("raw_query")}::BIGINT AS tokens, {_chars("raw_query")} AS chars, array_to_string({TAGS}, ',') AS tags,
              length(trim(regexp_replace(regexp_replace(lower(raw_query), '[\p{{P}}\p{{S}}]', '', 'g'), '\s+', ' ', 'g'), ' ')) AS folded_chars,
              regexp_replace(game_name, '[^A-Za-z0-9_\x{{4e00}}-\x{{9fff}}]', '_', 'g') AS game FROM pool""",
        "q07_matrix_report": f"""WITH {MATRIX}, rows AS ({MATRIX_ROWS})
            SELECT game_id, eval_dim_key, row_model, col_model, total_matches, stratified_winrate FROM rows
            ORDER BY CASE game_id WHEN 'all' THEN 0 ELSE 1 END, game_id, eval_dim_key, total_matches DESC, row_model, col_model LIMIT 1000""",
        "q08_ipw_report": f"""WITH every AS ({IPW})
            SELECT * EXCLUDE (effective_n, min_weight, max_weight, avg_weight, stddev_weight) FROM every
            WHERE game_id IN (SELECT DISTINCT game_id FROM every WHERE game_id <> 'all' ORDER BY game_id LIMIT 10) OR game_id = 'all'""",
        "b02_single_games": f"""WITH {MATRIX}, rows AS ({MATRIX_ROWS}), halves AS (
              SELECT game_id, eval_dim_key, 'row' AS winner, round_even(stratified_winrate * total_matches, 0)::BIGINT AS n FROM rows WHERE game_id <> 'all'
              UNION ALL SELECT game_id, eval_dim_key, 'col', round_even((1 - stratified_winrate) * total_matches, 0)::BIGINT FROM rows WHERE game_id <> 'all')
            SELECT game_id, eval_dim_key, winner, sum(n)::BIGINT AS games FROM halves WHERE n > 0 GROUP BY ALL""",
        "b09_top_differences": f"""WITH {MATRIX}, rows AS ({MATRIX_ROWS})
            SELECT game_id, eval_dim_key, row_model, col_model, total_matches, round(stratified_winrate - raw_winrate, 6) AS diff, round(abs(stratified_winrate - raw_winrate), 6) AS abs_diff
            FROM rows ORDER BY abs_diff DESC, game_id, eval_dim_key, row_model, col_model LIMIT 10""",
        "b09_difference_wide": f"""WITH {MATRIX}, rows AS ({MATRIX_ROWS})
            SELECT eval_dim_key, row_model, {", ".join(f"""max(round(stratified_winrate - raw_winrate, 6)) FILTER (WHERE col_model = '{m}') AS "{m}" """ for m in MODELS)}
            FROM rows WHERE game_id = 'all' GROUP BY eval_dim_key, row_model""",
        "b10_matrix_wide": f"""WITH {MATRIX}, rows AS ({MATRIX_ROWS})
            SELECT eval_dim_key, row_model, {", ".join(f"""max(stratified_winrate) FILTER (WHERE col_model = '{m}') AS "{m}" """ for m in MODELS)}
            FROM rows WHERE game_id = 'all' GROUP BY eval_dim_key, row_model""",
        "g06_edges": f"WITH {EDGES} SELECT a, b, CASE WHEN s >= 0.6 THEN 'strict' ELSE 'border' END AS kind, round(s, 4) AS similarity FROM near",
        "g07_confirmed_edges": f"""WITH {EDGES} SELECT a, b, CASE WHEN s >= 0.6 THEN 'strict' ELSE 'border' END AS kind
            FROM near JOIN embeddings x ON x.vec_id = a JOIN embeddings y ON y.vec_id = b WHERE s >= 0.6 OR x.label = y.label""",
        "g11_excluded": f"""WITH {POOL} SELECT query_id, category FROM pool WHERE category IN ('other', 'classification_failed')
            OR contains(lower(coalesce(raw_query, '')), 's36') OR contains(lower(coalesce(raw_query, '')), '购买')""",
        "g11_subcategories": f"WITH {POOL},{PARTED} SELECT category, rank_category, sum(n)::BIGINT AS queries FROM parted GROUP BY category, rank_category",
        "g13_game_quotas": f"""WITH RECURSIVE {CANDIDATES},
            c AS (SELECT game_id, category, count(*) AS queries FROM candidates GROUP BY ALL),
            e AS (SELECT *, round(queries * 20.0::DOUBLE / sum(queries) OVER (PARTITION BY game_id), 9) AS x FROM c)
            SELECT game_id, category, queries, (floor(x) + (row_number() OVER (PARTITION BY game_id ORDER BY x - floor(x) DESC, category) <= 20 - sum(floor(x)) OVER (PARTITION BY game_id))::INT)::BIGINT AS quota FROM e""",
        "g14_slice_coverage": f"""WITH RECURSIVE {CANDIDATES}, t AS (SELECT raw_query, unnest({TAGS}) AS slice FROM candidates)
            SELECT slice, count(*) AS queries, sum({_tokens("raw_query")})::BIGINT AS tokens FROM t GROUP BY slice""",
        "g18_selection_details": f"""WITH RECURSIVE {CANDIDATES}, {PICKED}
            SELECT t.query_id, canonical_id, CASE WHEN status = 'duplicate' THEN 'duplicate' WHEN {INVALID} THEN 'irrelevant' ELSE 'relevant' END AS status,
              CASE WHEN status = 'duplicate' OR {INVALID} THEN '不参与分类' ELSE t.category END AS category,
              coalesce(p.represent_rank, -1) AS represent_rank, p.query_id IS NOT NULL AS selected, reason FROM told t LEFT JOIN picked p USING (query_id)""",
        "g04_prepared_queries": f"""WITH {POOL}, tidied AS (SELECT query_id, raw_query AS raw_query_original, trim(regexp_replace(raw_query, '[ \\t]+', ' ', 'g'), ' ') AS raw_query FROM pool)
            SELECT query_id, raw_query, raw_query_original, NOT {INVALID} AND (coalesce(length(raw_query), 0) >= 12 OR coalesce(regexp_matches(raw_query, '[?？]'), true)) AS is_relevant FROM tidied""",
        "s02_month_answers": "SELECT model_name, count(*) AS answers FROM llm_answer WHERE dm = '2025-02' AND answer_content IS NOT NULL GROUP BY model_name",
        "c01_collection_run": f"""WITH {POOL}, names AS (SELECT DISTINCT max(model_name) AS model FROM llm_models WHERE dt = (SELECT max(dt) FROM llm_models) GROUP BY id),
            tried AS (SELECT model, md5(raw_query || model) LIKE '0%' AS lost, md5(raw_query || ' ' || model) LIKE '0%' AS lost_again FROM pool, names WHERE raw_query IS NOT NULL)
            SELECT model, 1 AS attempts, count(*) AS answered, 0 AS failed FROM tried WHERE NOT lost GROUP BY model
            UNION ALL SELECT model, 2, count(*) FILTER (WHERE NOT lost_again), count(*) FILTER (WHERE lost_again) FROM tried WHERE lost GROUP BY model""",
        "g19_rejected": rf"""WITH RECURSIVE {CANDIDATES}, {PICKED},
            r AS (SELECT p.query_id, array_to_string(list_filter([CASE WHEN length(raw_query) < 20 THEN 'short' END, CASE WHEN NOT regexp_matches(raw_query, '[0-9]') THEN 'no_number' END,
              CASE WHEN regexp_matches(raw_query, '[=＝]|^\s*\{{') THEN 'fields' END], lambda x: x IS NOT NULL), ',') AS broken FROM picked p JOIN pool USING (query_id))
            SELECT query_id, broken FROM r WHERE broken <> ''""",
        "f11_answer_truths": f"""WITH {CLEAN_ANSWERS}, w AS (
              SELECT answer_id, query_id, generated_at, CASE WHEN json_valid(generation_metadata) THEN generation_metadata ->> '$.correct' END AS told, lower(trim(told)) AS word FROM said)
            SELECT answer_id, query_id, (word IN ('true', '1', 't', 'yes', 'y'))::INT AS correct,
              CASE WHEN told IN ('true', '1', 't', 'yes', 'y') THEN 1 WHEN told IN ('false', '0', 'f', 'no', 'n') THEN 0 ELSE -1 END AS code,
              coalesce(strftime(make_timestamp(generated_at * 1000000), '%Y年%m月'), '未知时间') AS month FROM w WHERE word IN ('true', '1', 't', 'yes', 'y', 'false', '0', 'f', 'no', 'n')""",
    }
