"""DuckDB SQL that computes what each registered query computes, from the raw tables.

Used by the driver's side-by-side check and by the tests. Shared pieces are
CTE snippets; the multi-batch model fold is generated one block per day.
"""

from __future__ import annotations

from .queries import CAPPED_BATCHES, DECAY_CASE, FAR_FACTOR, INIT_SEED, K, PUBLISH_STEPS, REPORT_SPAN, ROUND, SAMPLE_FRACTION, WIDE
from ..operators.features import sample_threshold
from ..operators.kmeans import DYING_RATIO, SPLIT_EPS, WEIGHT_FLOOR
from ..sources.fixtures import MOVIE_ID_MODULUS, PARTITIONS, SKEW, TOPIC

# Days of the events table (2024-01-01 .. 2024-01-30); one model batch per
# day, numbered as days since 1970-01-01 (2024-01-01 is day 19723).
FIRST_EPOCH_DAY = 19723
N_DAYS = 30

_MSGS = f"""
msgs AS (
  SELECT event_id AS msg_id, ts, user_id, event_type,
         concat_ws(',', CAST(user_id AS VARCHAR), CAST(event_id % {MOVIE_ID_MODULUS} AS VARCHAR),
                   CASE WHEN event_type = 'error' THEN props ELSE CAST(value AS VARCHAR) END) AS value
  FROM events
)"""

_LINES = """
lines AS (
  SELECT msg_id, value || ',' || CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS value FROM msgs
)"""

_FIELDS = """
fields AS (
  SELECT msg_id, ts, user_id AS src_user, value, string_split(regexp_replace(value, ',+$', ''), ',') AS f FROM msgs
)"""

_PARSED = r"""
parsed AS (
  SELECT msg_id, ts, src_user, value, f,
    CASE WHEN regexp_full_match(f[1], '[+-]?[0-9]+') THEN TRY_CAST(f[1] AS INTEGER) END AS u,
    CASE WHEN regexp_full_match(f[2], '[+-]?[0-9]+') THEN TRY_CAST(f[2] AS INTEGER) END AS m,
    regexp_replace(f[3], '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS rt
  FROM fields
),
typed AS (
  SELECT msg_id, ts, src_user, value, u, m, len(f) AS nf,
    CASE WHEN regexp_full_match(rt, '[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)')
         THEN TRY_CAST(regexp_replace(rt, '[fFdD]$', '') AS FLOAT) END AS r
  FROM parsed
),
checked AS (
  SELECT *, CASE WHEN nf <> 3 THEN 'field_count' WHEN u IS NULL THEN 'user_id'
                 WHEN m IS NULL THEN 'movie_id' WHEN r IS NULL THEN 'rating' END AS reject_reason
  FROM typed
),
good AS (
  SELECT msg_id, ts, u AS user_id, m AS movie_id, r AS rating FROM checked WHERE reject_reason IS NULL
)"""

_VEC = """
vec AS (
  SELECT CAST(vec_id AS INTEGER) AS movie_id, CAST(i AS INTEGER) AS tag_id,
         embedding[i] AS score, CAST(CAST(embedding[i] AS VARCHAR) AS DOUBLE) AS x
  FROM embeddings, range(1, len(embedding) + 1) r(i)
),
vecs AS (
  SELECT CAST(vec_id AS INTEGER) AS movie_id, embedding AS scores,
         list_transform(embedding, lambda e: CAST(CAST(e AS VARCHAR) AS DOUBLE)) AS features
  FROM embeddings
)"""

_START = f"""
start AS (
  SELECT CAST(rank() OVER (ORDER BY movie_id) - 1 AS INTEGER) AS cluster, movie_id AS start_movie
  FROM (SELECT movie_id FROM vecs ORDER BY movie_id LIMIT {K})
),
st0 AS (
  SELECT s.cluster, v.tag_id AS i, v.x AS c, 0.0::DOUBLE AS w
  FROM start s JOIN vec v ON v.movie_id = s.start_movie
)"""


def _java_text(x: str) -> str:
    """SQL for the JVM's text of a double ``x`` (``Double.toString``), from DuckDB's shortest text.

    Plain decimal for 1e-3 <= |x| < 1e7 (and 0), else ``d.dddE±n`` with at
    least one digit after the point and no exponent padding.
    """
    s = f"CAST(abs({x}) AS VARCHAR)"
    sci_m = f"regexp_extract({s}, '^([0-9.]+)e', 1)"
    sci_e = f"CAST(regexp_extract({s}, 'e([-+][0-9]+)$', 1) AS INTEGER)"
    zeros = f"length(regexp_extract({s}, '^0\\.(0*)', 1))"
    small = f"regexp_extract({s}, '^0\\.0*([0-9]+)$', 1)"
    whole = f"regexp_extract({s}, '^([0-9]+)\\.', 1)"
    frac = f"regexp_extract({s}, '\\.([0-9]+)$', 1)"

    def mantissa(digits: str) -> str:
        d = f"rtrim({digits}, '0')"
        return f"(left({d}, 1) || '.' || CASE WHEN length({d}) > 1 THEN substr({d}, 2) ELSE '0' END)"

    sci = f"""CASE
      WHEN contains({s}, 'e') THEN (CASE WHEN contains({sci_m}, '.') THEN {sci_m} ELSE {sci_m} || '.0' END)
                                   || 'E' || CAST({sci_e} AS VARCHAR)
      WHEN abs({x}) < 1 THEN {mantissa(small)} || 'E' || CAST(-({zeros} + 1) AS VARCHAR)
      ELSE {mantissa(f"{whole} || {frac}")} || 'E' || CAST(length({whole}) - 1 AS VARCHAR) END"""
    return (
        f"(CASE WHEN {x} = 0 OR (abs({x}) >= 1e-3 AND abs({x}) < 1e7) THEN CAST({x} AS VARCHAR) "
        f"ELSE CASE WHEN {x} < 0 THEN '-' ELSE '' END || ({sci}) END)"
    )


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


def _summary(arr: str) -> str:
    return (
        f"CAST(len({arr}) AS INTEGER) AS dim, round(list_sum({arr}), {ROUND}) AS f_sum, "
        f"list_min({arr}) AS f_min, list_max({arr}) AS f_max"
    )


def _joined() -> str:
    return _with(_MSGS, _FIELDS, _PARSED, _VEC) + """,
joined AS (
  SELECT g.msg_id, g.ts, g.user_id, g.movie_id, g.rating, v.scores, v.features
  FROM good g JOIN vecs v ON v.movie_id = g.movie_id
)"""


def _assign_block(tag: str, counts: str, state: str) -> str:
    """CTEs ``d_{tag}``/``a_{tag}``: nearest centre of each movie in ``counts`` under ``state``."""
    return f"""
d_{tag} AS (
  SELECT p.movie_id, s.cluster, sum((v.x - s.c) * (v.x - s.c)) AS d
  FROM (SELECT DISTINCT movie_id FROM {counts}) p
  JOIN vec v ON v.movie_id = p.movie_id
  JOIN {state} s ON s.i = v.tag_id
  GROUP BY p.movie_id, s.cluster
),
a_{tag} AS (
  SELECT movie_id, cluster FROM (
    SELECT movie_id, cluster, row_number() OVER (PARTITION BY movie_id ORDER BY d, cluster) AS rn FROM d_{tag})
  WHERE rn = 1
)"""


def _step_block(tag: str, counts: str, state: str, decay: float) -> str:
    """One training step over ``counts(movie_id, n)`` from ``state(cluster, i, c, w)`` → ``st_{tag}``."""
    return _assign_block(tag, counts, state) + f""",
stat_{tag} AS (
  SELECT a.cluster, v.tag_id AS i, sum(p.n) AS m, sum(p.n * v.x) AS s
  FROM {counts} p JOIN a_{tag} a ON a.movie_id = p.movie_id JOIN vec v ON v.movie_id = p.movie_id
  GROUP BY a.cluster, v.tag_id
),
u_{tag} AS (
  SELECT st.cluster, st.i, st.c, st.w * {float(decay)!r} AS w1, coalesce(t.m, 0) AS m, t.s
  FROM {state} st LEFT JOIN stat_{tag} t ON t.cluster = st.cluster AND t.i = st.i
),
v_{tag} AS (
  SELECT cluster, i,
    CASE WHEN m > 0 THEN (1.0 - m / greatest(w1 + m, {WEIGHT_FLOOR!r})) * c
                         + ((m / greatest(w1 + m, {WEIGHT_FLOOR!r})) / m) * s ELSE c END AS c,
    CASE WHEN m > 0 THEN w1 + m ELSE w1 END AS w
  FROM u_{tag}
),
x_{tag} AS (
  SELECT *, max(w) OVER () AS maxw, min(w) OVER () AS minw FROM v_{tag}
),
y_{tag} AS (
  SELECT *, min(CASE WHEN w = maxw THEN cluster END) OVER () AS big,
            min(CASE WHEN w = minw THEN cluster END) OVER () AS small FROM x_{tag}
),
st_{tag} AS MATERIALIZED (
  SELECT y.cluster, y.i,
    CASE WHEN y.minw < {DYING_RATIO!r} * y.maxw AND y.cluster = y.big
           THEN b.c + 1.0 * ({SPLIT_EPS!r} * greatest(abs(b.c), 1.0))
         WHEN y.minw < {DYING_RATIO!r} * y.maxw AND y.cluster = y.small
           THEN b.c + -1.0 * ({SPLIT_EPS!r} * greatest(abs(b.c), 1.0))
         ELSE y.c END AS c,
    CASE WHEN y.minw < {DYING_RATIO!r} * y.maxw AND y.cluster IN (y.big, y.small)
         THEN (y.maxw + y.minw) / 2.0 ELSE y.w END AS w
  FROM y_{tag} y JOIN y_{tag} b ON b.cluster = b.big AND b.i = y.i
)"""


def _state_out(state: str) -> str:
    return f"""
SELECT CAST(cluster AS INTEGER) AS cluster, round(w, {ROUND}) AS weight,
       CAST(i AS INTEGER) AS tag_id, round(c, {ROUND}) AS center
FROM {state}"""


def _one_step(state0: str, decay: float, out: str | None = None) -> str:
    counts = """
cnt1 AS (SELECT movie_id, count(*) AS n FROM good GROUP BY movie_id)"""
    return (
        _with(_MSGS, _FIELDS, _PARSED, _VEC, _START, state0, counts)
        + ","
        + _step_block("1", "cnt1", "s_in", decay)
        + (out if out is not None else _state_out("st_1"))
    )


def _daily_fold(with_predictions: bool = False, out: str | None = None) -> str:
    blocks = []
    prev = "st0"
    for b in range(N_DAYS):
        blocks.append(
            f"""
cnt_d{b} AS (
  SELECT movie_id, count(*) AS n FROM good
  WHERE epoch_us(ts) // 86400000000 = {FIRST_EPOCH_DAY + b} GROUP BY movie_id
)"""
        )
        blocks.append(_step_block(f"d{b}", f"cnt_d{b}", prev, 1.0))
        prev = f"st_d{b}"
    head = _with(_MSGS, _FIELDS, _PARSED, _VEC, _START, *blocks)
    if out == "model_report":
        return head + "\n" + "\nUNION ALL\n".join(
            f"SELECT {b} AS batch_id, CAST(cluster AS INTEGER) AS cluster, CAST(i AS INTEGER) AS tag_id, round(c, {ROUND}) AS center FROM st_d{b}"
            for b in range(N_DAYS)
        )
    if out == "assignment":
        return f'{head},{_assign_block("fin", "vecs", prev).strip(chr(10))}' + "\nSELECT movie_id, cluster FROM a_fin"
    if not with_predictions:
        return head + _state_out(prev)
    thr = sample_threshold(SAMPLE_FRACTION)
    preds = []
    for b in range(N_DAYS):
        preds.append(
            f"""
sp_d{b} AS (
  SELECT msg_id, user_id, movie_id FROM good
  WHERE epoch_us(ts) // 86400000000 = {FIRST_EPOCH_DAY + b}
    AND substr(md5(concat_ws(':', '17', '{TOPIC}',
               CAST(user_id % {PARTITIONS} AS VARCHAR), CAST(msg_id AS VARCHAR))), 1, 8) < '{thr}'
)"""
        )
        preds.append(_assign_block(f"p{b}", f"sp_d{b}", f"st_d{b}"))
    union = "\nUNION ALL\n".join(
        f"SELECT s.msg_id, s.user_id, s.movie_id, a.cluster{f', {b} AS batch_id' if out else ''} FROM sp_d{b} s JOIN a_p{b} a ON a.movie_id = s.movie_id"
        for b in range(N_DAYS)
    )
    if out == "prediction_report":
        # the partition is the source user's, as the records were published
        union = f"""
SELECT batch_id, '{TOPIC}' AS topic, CAST(g.src_user % {PARTITIONS} AS INTEGER) AS partition, p.msg_id // {REPORT_SPAN} AS line_no,
       count(*) AS n, string_agg(CAST(cluster AS VARCHAR), ',' ORDER BY p.msg_id) AS line
FROM ({union}) p JOIN checked g ON g.msg_id = p.msg_id GROUP BY 1, 2, 3, 4"""
    return head + "," + ",".join(p.strip("\n") for p in preds) + "\n" + union


def sql() -> dict[str, str]:
    thr = sample_threshold(SAMPLE_FRACTION)
    joined = _joined()
    q: dict[str, str] = {}

    q["scan_tag_scores"] = _with(_VEC) + """
SELECT movie_id, tag_id, score AS relevance FROM vec"""
    q["scan_rating_lines"] = _with(_MSGS, _LINES) + "\nSELECT value FROM lines"
    q["count_lines"] = "SELECT count(*) AS n_lines FROM events"
    q["project_value"] = _with(_MSGS) + "\nSELECT value FROM msgs"
    q["stream_offset_report"] = f"""
SELECT '{TOPIC}' AS topic, CAST(user_id % {PARTITIONS} AS INTEGER) AS partition,
       min(event_id) AS from_offset, max(event_id) + 1 AS until_offset, count(*) AS n
FROM events GROUP BY 2"""

    q["parse_rating"] = _with(_MSGS, _FIELDS, _PARSED) + "\nSELECT msg_id, user_id, movie_id, rating FROM good"
    q["parse_rating_quarantine"] = _with(_MSGS, _FIELDS, _PARSED) + """
SELECT msg_id, value, reject_reason FROM checked WHERE reject_reason IS NOT NULL"""
    q["reject_bad_lines"] = _with(_MSGS, _LINES) + """
SELECT msg_id, u AS user_id, u IS NULL AS rejected FROM (
  SELECT msg_id, CASE WHEN regexp_full_match(string_split(value, ',')[1], '[+-]?[0-9]+')
                      THEN TRY_CAST(string_split(value, ',')[1] AS INTEGER) END AS u FROM lines)"""
    q["drop_last_field"] = _with(_MSGS) + "\nSELECT msg_id, value FROM msgs"
    q["user_parity_key"] = _with(_MSGS, _FIELDS, _PARSED) + f"""
SELECT msg_id, user_id, CAST(user_id % {PARTITIONS} AS INTEGER) AS key FROM good"""
    q["encode_key"] = f"""
SELECT event_id AS msg_id, CAST(user_id AS INTEGER) AS user_id,
       lpad(right(hex(CAST(user_id AS BIGINT)), 8), 8, '0') AS user_hex,
       lpad(right(hex(CAST(user_id % {PARTITIONS} AS BIGINT)), 8), 8, '0') AS key_hex
FROM events"""
    q["publish_ratings"] = _with(_MSGS) + f"""
SELECT lpad(right(hex(CAST(user_id % {PARTITIONS} AS BIGINT)), 8), 8, '0') AS key_hex, value,
       '{TOPIC}' AS topic, CAST(user_id % {PARTITIONS} AS INTEGER) AS partition
FROM msgs"""
    q["publish_summary"] = _with(_MSGS, _LINES) + f"""
, rb AS (SELECT NOT coalesce(regexp_full_match(string_split(value, ',')[1], '[+-]?[0-9]+')
                             AND TRY_CAST(string_split(value, ',')[1] AS INTEGER) IS NOT NULL, false) AS rejected
         FROM lines)
SELECT count(*) AS n_read, count(*) FILTER (WHERE rejected) AS n_rejected,
       count(*) FILTER (WHERE NOT rejected) AS n_published,
       round(100.0 * count(*) FILTER (WHERE NOT rejected) / count(*), {ROUND}) AS pct_published FROM rb"""
    q["stamp_time"] = _with(_MSGS, _FIELDS, _PARSED) + """
SELECT msg_id, user_id, movie_id, rating, true AS stamped, CAST(1 AS BIGINT) AS n_stamps FROM good"""
    q["rekey_by_movie"] = _with(_MSGS, _FIELDS, _PARSED) + "\nSELECT movie_id, user_id, rating FROM good"

    q["assemble_tag_vectors"] = _with(_VEC) + "\nSELECT movie_id, tag_id, score FROM vec"
    q["assemble_tag_vectors_sparse"] = """
WITH li AS (SELECT CAST(l_partkey AS INTEGER) AS movie_id, CAST(l_linenumber AS INTEGER) AS tag_id,
                   CAST(l_discount AS FLOAT) AS rel FROM lineitem),
dim AS (SELECT max(tag_id) AS d FROM li),
mx AS (SELECT movie_id, tag_id, max(rel) AS rel FROM li GROUP BY movie_id, tag_id),
grid AS (SELECT DISTINCT li.movie_id, CAST(r.i AS INTEGER) AS tag_id
         FROM li, dim, range(1, dim.d + 1) r(i))
SELECT g.movie_id, g.tag_id, coalesce(mx.rel, CAST(0 AS FLOAT)) AS score
FROM grid g LEFT JOIN mx ON mx.movie_id = g.movie_id AND mx.tag_id = g.tag_id"""
    q["assemble_tag_vectors_nonfinite"] = """
WITH li AS (SELECT CAST(l_partkey AS INTEGER) AS movie_id, CAST(l_linenumber AS INTEGER) AS tag_id,
                   CAST(l_discount AS FLOAT) AS rel FROM lineitem),
dim AS (SELECT max(tag_id) AS d FROM li),
fine AS (SELECT * FROM li WHERE rel NOT IN (CAST(0.05 AS FLOAT), CAST(0.06 AS FLOAT))),
mx AS (SELECT movie_id, tag_id, max(rel) AS rel FROM fine GROUP BY movie_id, tag_id),
grid AS (SELECT DISTINCT fine.movie_id, CAST(r.i AS INTEGER) AS tag_id
         FROM fine, dim, range(1, dim.d + 1) r(i))
SELECT g.movie_id, g.tag_id, coalesce(mx.rel, CAST(0 AS FLOAT)) AS score
FROM grid g LEFT JOIN mx ON mx.movie_id = g.movie_id AND mx.tag_id = g.tag_id"""
    q["array_to_features"] = _with(_VEC) + "\nSELECT movie_id, tag_id, x AS feature FROM vec"

    q["join_ratings_features"] = joined + f"""
SELECT msg_id, user_id, movie_id, rating, {_summary('features')} FROM joined"""
    q["scale_features"] = joined + f"""
, scaled AS (SELECT msg_id, movie_id, rating,
    list_transform(scores, lambda e: CAST(CAST(e * rating AS FLOAT) AS DOUBLE)) AS scaled
  FROM joined)
SELECT msg_id, movie_id, rating, {_summary('scaled')} FROM scaled"""
    q["label_points"] = joined + f"""
SELECT CAST(user_id AS DOUBLE) AS label, msg_id, movie_id, {_summary('features')} FROM joined"""
    q["project_features"] = joined + f"\nSELECT {_summary('features')} FROM joined"
    q["sample_rows"] = joined + f"""
SELECT msg_id, user_id, movie_id FROM joined
WHERE substr(md5(CAST(msg_id AS VARCHAR)), 1, 8) < '{thr}'"""

    assign_head = _with(_MSGS, _FIELDS, _PARSED, _VEC, _START) + ","
    q["assign_clusters"] = assign_head + _assign_block("x", "good", "st0") + """
SELECT g.msg_id, g.user_id, g.movie_id, a.cluster FROM good g JOIN a_x a ON a.movie_id = g.movie_id"""
    q["assign_clusters_wide"] = _with(_MSGS, _FIELDS, _PARSED, _VEC) + f""",
wide AS (
  SELECT v.movie_id, (r.t * d.dim + v.tag_id) AS tag_id, v.x
  FROM vec v, (SELECT max(tag_id) AS dim FROM vec) d, range(0, {WIDE}) r(t)
  WHERE r.t * d.dim + v.tag_id <= {WIDE}
),
stw AS (
  SELECT CAST(dense_rank() OVER (ORDER BY movie_id) - 1 AS INTEGER) AS cluster, tag_id AS i, x AS c FROM wide
  WHERE movie_id IN (SELECT movie_id FROM vecs ORDER BY movie_id LIMIT {K})
),
d_w AS (
  SELECT v.movie_id, s.cluster, sum((v.x - s.c) * (v.x - s.c)) AS d
  FROM wide v JOIN stw s ON s.i = v.tag_id
  WHERE v.movie_id IN (SELECT movie_id FROM good)
  GROUP BY v.movie_id, s.cluster
)
SELECT movie_id, cluster FROM d_w QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY d, cluster) = 1"""
    q["cluster_sizes"] = assign_head + _assign_block("x", "good", "st0") + """
SELECT a.cluster, count(*) AS n FROM good g JOIN a_x a ON a.movie_id = g.movie_id GROUP BY a.cluster"""
    q["cluster_stats"] = assign_head + """
cnt AS (SELECT movie_id, count(*) AS n FROM good GROUP BY movie_id),""" + _assign_block(
        "x", "cnt", "st0"
    ) + f"""
SELECT a.cluster, CAST(sum(p.n) AS BIGINT) AS n, v.tag_id, round(sum(p.n * v.x), {ROUND}) AS total
FROM cnt p JOIN a_x a ON a.movie_id = p.movie_id JOIN vec v ON v.movie_id = p.movie_id
GROUP BY a.cluster, v.tag_id"""

    # The exact sum as a whole number of 2^-90ths, rounded once to 53 bits (half to even).
    q["cluster_stats_exact"] = assign_head + """
cnt AS (SELECT movie_id, count(*) AS n FROM good GROUP BY movie_id),""" + _assign_block("x", "cnt", "st0") + """,
summed AS (
  SELECT a.cluster, v.tag_id, CAST(sum(p.n) AS BIGINT) AS n, sum(p.n * CAST(v.x * pow(2, 90) AS HUGEINT)) AS s
  FROM cnt p JOIN a_x a ON a.movie_id = p.movie_id JOIN vec v ON v.movie_id = p.movie_id GROUP BY 1, 2),
sized AS (SELECT *, abs(s) AS a, CAST(floor(log2(CAST(greatest(abs(s), 1) AS DOUBLE))) AS INTEGER) AS g FROM summed),
bits AS (SELECT *, CASE WHEN a >= (CAST(1 AS HUGEINT) << (g + 1)) THEN g + 1 WHEN a < (CAST(1 AS HUGEINT) << g) THEN greatest(g - 1, 0) ELSE g END AS k FROM sized),
cut AS (SELECT *, greatest(k - 52, 0) AS e, CAST(1 AS HUGEINT) << greatest(k - 52, 0) AS u FROM bits)
SELECT cluster, n, tag_id, sign(s) * CAST(a // u + CASE WHEN 2 * (a % u) > u OR (2 * (a % u) = u AND (a // u) % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE)
       * pow(2, e - 90) AS total
FROM cut"""
    q["update_centers"] = _one_step("s_in AS (SELECT * FROM st0)", 1.0)
    decay, w0 = DECAY_CASE
    q["decay_weights"] = _with(_MSGS, _FIELDS, _PARSED, _VEC, _START) + f"""
SELECT CAST(cluster AS INTEGER) AS cluster, round({float(w0)!r}::DOUBLE * {float(decay)!r}::DOUBLE, {ROUND}) AS weight,
       CAST(i AS INTEGER) AS tag_id, round(c, {ROUND}) AS center FROM st0"""
    q["update_centers_decay"] = _one_step(f"s_in AS (SELECT cluster, i, c, {float(w0)!r} AS w FROM st0)", decay)
    q["split_dying_cluster"] = _one_step(
        f"s_in AS (SELECT cluster, i, CASE WHEN cluster = {K - 1} THEN c * {FAR_FACTOR!r} ELSE c END AS c, w FROM st0)",
        1.0,
    )
    q["format_center"] = _with(_MSGS, _FIELDS, _PARSED, _VEC, _START) + f"""
SELECT cluster, string_agg({_java_text('c')}, ',' ORDER BY i) AS center_text FROM st0 GROUP BY cluster"""
    q["model_report"] = _one_step(
        "s_in AS (SELECT * FROM st0)",
        1.0,
        f"""
SELECT cluster, string_agg({_java_text(f'round(c, {ROUND})')}, ',' ORDER BY i) AS line
FROM st_1 GROUP BY cluster""",
    )
    q["prediction_report"] = assign_head + _assign_block("x", "good", "st0") + f"""
, preds AS (
  SELECT g.msg_id, a.cluster FROM good g JOIN a_x a ON a.movie_id = g.movie_id
  WHERE substr(md5(CAST(g.msg_id AS VARCHAR)), 1, 8) < '{thr}'
)
SELECT msg_id // {REPORT_SPAN} AS line_no, count(*) AS n,
       string_agg(CAST(cluster AS VARCHAR), ',' ORDER BY msg_id) AS line
FROM preds GROUP BY 1"""
    q["init_centers"] = f"""
WITH g AS (
  SELECT CAST(k.range AS INTEGER) AS cluster, CAST(i.range AS INTEGER) AS tag_id
  FROM range({K}) k, range(1, (SELECT max(len(embedding)) FROM embeddings) + 1) i
), u AS (
  SELECT *, (('0x' || substr(md5('{INIT_SEED}:' || cluster || ':' || tag_id || ':1'), 1, 12))::BIGINT + 1) / {float(2**48 + 1)!r} AS u1,
            (('0x' || substr(md5('{INIT_SEED}:' || cluster || ':' || tag_id || ':2'), 1, 12))::BIGINT + 1) / {float(2**48 + 1)!r} AS u2
  FROM g
)
SELECT cluster, 0.0::DOUBLE AS weight, tag_id, round(sqrt(-2.0 * ln(u1)) * cos(2 * pi() * u2), {ROUND}) AS center FROM u"""
    q["latest_model"] = _daily_fold()
    q["fold_signed_batches"] = q["latest_model"]
    q["stateful_model"] = q["latest_model"]
    ranges = f"""
part AS (SELECT CAST(CASE WHEN user_id % {SKEW} = 0 THEN 1 ELSE 0 END AS INTEGER) AS partition, count(*) AS n FROM events GROUP BY 1),
cap AS (SELECT (max(n) + {CAPPED_BATCHES} - 1) // {CAPPED_BATCHES} AS cap FROM part),
taken AS (
  SELECT CAST(b AS INTEGER) AS batch_id, '{TOPIC}' AS topic, partition,
         CAST(b * cap AS BIGINT) AS from_offset, CAST(least(n, (b + 1) * cap) AS BIGINT) AS until_offset
  FROM part, cap, range({CAPPED_BATCHES}) r(b) WHERE b * cap < n
)"""
    q["stream_capped_offsets"] = _with(ranges) + "\nSELECT *, until_offset - from_offset AS n FROM taken"
    q["stream_commit_log"] = _with(ranges) + """
SELECT attempt, t.batch_id, outcome, outcome = 'failed' AS has_error, true AS timed, n_records, topic, partition, from_offset, until_offset
FROM (SELECT CAST(batch_id + 1 AS INTEGER) AS attempt, batch_id, 'committed' AS outcome FROM (SELECT DISTINCT batch_id FROM taken)
      UNION ALL SELECT 0, 0, 'failed') a
JOIN taken t ON t.batch_id = a.batch_id
JOIN (SELECT batch_id, CAST(sum(until_offset - from_offset) AS BIGINT) AS n_records FROM taken GROUP BY batch_id) s ON s.batch_id = t.batch_id"""
    q["publish_progress"] = _with(_MSGS) + f"""
SELECT 'sent' AS kind, count(*) AS n_read, CAST(0 AS BIGINT) AS n_rejected, count(*) AS n_published, 100.0::DOUBLE AS pct_published,
       CAST(0 AS BIGINT) AS n_missing, CAST({PUBLISH_STEPS} AS BIGINT) AS n_steps, true AS monotone
FROM msgs"""
    q["publish_waves"] = _with(_MSGS) + f"""
SELECT '{TOPIC}' AS topic, CAST(user_id % {PARTITIONS} AS INTEGER) AS partition, 2 * count(*) AS n, 2 * count(*) AS n_offsets,
       CAST(0 AS BIGINT) AS first_offset, 2 * count(*) - 1 AS last_offset, min(md5(value)) AS least, max(md5(value)) AS largest
FROM msgs GROUP BY 2"""
    q["assign_clusters_incremental"] = _daily_fold(out="assignment")
    q["stream_model_report"] = _daily_fold(out="model_report")
    q["stream_prediction_report"] = _daily_fold(with_predictions=True, out="prediction_report")
    q["stream_predictions"] = _daily_fold(with_predictions=True)
    q["stream_quarantine"] = _with(_MSGS, _FIELDS, _PARSED) + """
SELECT msg_id, value, reject_reason FROM checked WHERE reject_reason IS NOT NULL"""
    q["stream_ratings"] = _with(_MSGS) + "\nSELECT msg_id, value FROM msgs"
    q["stream_offsets"] = _with(_MSGS, _FIELDS, _PARSED) + f"""
SELECT CAST(epoch_us(ts) // 86400000000 - {FIRST_EPOCH_DAY} AS INTEGER) AS batch_id, '{TOPIC}' AS topic,
       CAST(src_user % {PARTITIONS} AS INTEGER) AS partition,
       min(msg_id) AS from_offset, max(msg_id) + 1 AS until_offset, count(*) AS n,
       count(*) FILTER (WHERE reject_reason IS NOT NULL) AS n_rejected
FROM checked GROUP BY 1, 3"""
    return q
