"""Registered queries: hidden Markov model scoring of user event sequences (§2.5).

Sequences: ``events`` per ``user_id`` in (ts, event_id) order, symbol =
``event_type`` indexed by falling frequency.  The oracle is a recursive CTE
over positions carrying the scaled forward variables.
"""

from __future__ import annotations

from ..operators.sequence import hmm_score, positions
from ..sources.tables import read_table
from .registry import dbl, query, rnd, r4

# fixed model values: 3 hidden states, 5 symbols (the event types)
HMM_PI = (0.5, 0.3, 0.2)
HMM_A = ((0.6, 0.3, 0.1),
         (0.2, 0.7, 0.1),
         (0.1, 0.4, 0.5))
HMM_B = ((0.30, 0.20, 0.20, 0.20, 0.10),
         (0.10, 0.30, 0.20, 0.20, 0.20),
         (0.20, 0.10, 0.30, 0.10, 0.30))

_SEQ_SQL = """
sym AS MATERIALIZED (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS obs
                     FROM events WHERE event_type IS NOT NULL GROUP BY event_type),
seq AS MATERIALIZED (SELECT e.user_id, row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) AS pos,
                            s.obs FROM events e JOIN sym s ON e.event_type = s.event_type)"""


def _b(j: int, o: str) -> str:
    return f"[{', '.join(dbl(v) for v in HMM_B[j])}][{o} + 1]"


def _forward_sql() -> str:
    n = len(HMM_PI)
    init = ", ".join(f"{dbl(HMM_PI[j])} * {_b(j, 'obs')} AS a{j}" for j in range(n))
    u = [f"((" + " + ".join(f"f.a{i} * {dbl(HMM_A[i][j])}" for i in range(n)) + f") * {_b(j, 's.obs')})"
         for j in range(n)]
    norm = "(" + " + ".join(u) + ")"
    step = ", ".join(f"{u[j]} / {norm} AS a{j}" for j in range(n))
    a0 = " + ".join(f"a{j}" for j in range(n))
    return f"""WITH RECURSIVE {_SEQ_SQL},
fwd AS (
  SELECT user_id, pos, {", ".join(f"a{j} / ({a0}) AS a{j}" for j in range(n))}, ln({a0}) AS ls
  FROM (SELECT user_id, pos, {init} FROM seq WHERE pos = 1)
  UNION ALL
  SELECT s.user_id, s.pos, {step}, f.ls + ln({norm}) AS ls
  FROM fwd f JOIN seq s ON s.user_id = f.user_id AND s.pos = f.pos + 1)
SELECT f.user_id, CAST(f.pos AS BIGINT) AS n_obs, {rnd('f.ls')} AS log_likelihood
FROM fwd f JOIN (SELECT user_id, max(pos) AS n FROM seq GROUP BY user_id) m
  ON f.user_id = m.user_id AND f.pos = m.n"""


@query("hmm_sequences", f"""WITH {_SEQ_SQL}
SELECT user_id, CAST(pos AS BIGINT) AS pos, CAST(obs AS INTEGER) AS obs FROM seq""")
def hmm_sequences_query(spark, d):
    ev = read_table(spark, d, "events")
    return positions(ev, "user_id", ["ts", "event_id"], "event_type")


def _score(spark, d, method):
    ev = read_table(spark, d, "events")
    out = hmm_score(ev, "user_id", ["ts", "event_id"], "event_type", HMM_PI, HMM_A, HMM_B, method=method)
    return out.select("user_id", "n_obs", r4("log_likelihood", 4).alias("log_likelihood"))


@query("hmm_forward", _forward_sql)
def hmm_forward_query(spark, d):
    return _score(spark, d, "forward")


@query("hmm_backward", _forward_sql)
def hmm_backward_query(spark, d):
    return _score(spark, d, "backward")
