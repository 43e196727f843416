"""Generated answers: Spark's verdict equals the independent DuckDB condition."""

import json

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskmart.operators.casenotes import parse_responses

KEYS = ["risk_assessment", "likely_pattern", "confidence", "reasoning", "recommended_action",
        "case_note"]
text = st.text(alphabet="abc {}[],:\"'\\\n xyz0123456789", max_size=12)
value = st.one_of(st.none(), st.booleans(), st.integers(-3, 3),
                  st.floats(-2, 2, allow_nan=False).map(lambda x: round(x, 3)),
                  st.sampled_from(["low", "medium", "high", "critical", "HIGH", "0.5", "x", ""]),
                  text)


@st.composite
def answer(draw):
    obj = {}
    for k in KEYS:
        if draw(st.integers(0, 9)) > 0:                     # usually present
            if k == "risk_assessment":
                obj[k] = draw(st.sampled_from(["low", "medium", "high", "critical", "severe",
                                               "High", None, 1]))
            elif k == "confidence":
                obj[k] = draw(st.one_of(st.floats(-0.5, 1.5, allow_nan=False), st.booleans(),
                                        st.none(), st.sampled_from(["0.3", "1", "x", " 0.2 "])))
            else:
                obj[k] = draw(value)
    body = json.dumps(obj)
    shape = draw(st.integers(0, 6))
    if shape == 1:
        body = "```json\n" + body + "\n```"
    elif shape == 2:
        body = draw(st.sampled_from(["Sure: ", "Answer\n", ""])) + body + " thanks"
    elif shape == 3:
        body = body + " and }"
    elif shape == 4:
        body = body[:-1]
    elif shape == 5:
        body = body + body
    elif shape == 6:
        body = "  \n" + body + "\t "
    return body


DUCK = r"""
WITH b AS (SELECT i, NULLIF(regexp_extract(regexp_replace(regexp_replace(
             regexp_replace(raw, '^\s+|\s+$', '', 'g'), '^```(?:json)?\s*', ''),
             '\s*```$', ''), '(?s)\{.*\}', 0), '') AS body FROM a),
     v AS (SELECT i, CASE WHEN json_valid(body) THEN body::JSON END AS v FROM b)
SELECT i, COALESCE(v IS NOT NULL
  AND list_has_all(json_keys(v), ['risk_assessment', 'likely_pattern', 'confidence',
                                  'reasoning', 'recommended_action', 'case_note'])
  AND json_extract_string(v, '$.risk_assessment') IN ('low', 'medium', 'high', 'critical')
  AND CASE json_type(v, '$.confidence') WHEN 'BOOLEAN' THEN 1.0
      ELSE TRY_CAST(json_extract_string(v, '$.confidence') AS DOUBLE) END BETWEEN 0 AND 1,
  FALSE) FROM v"""


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(answer(), min_size=40, max_size=60))
def test_generated_answers_agree(spark, answers):
    rows = [(i, 1, a) for i, a in enumerate(answers)]
    df = spark.createDataFrame(rows, "transaction_id bigint, attempt int, raw_response string")
    got = {r["transaction_id"]: r["valid"] for r in parse_responses(df).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE a(i INT, raw VARCHAR)")
    con.executemany("INSERT INTO a VALUES (?, ?)", [(i, a) for i, a in enumerate(answers)])
    want = dict(con.execute(DUCK).fetchall())
    diff = {i: answers[i] for i in got if got[i] != want[i]}
    assert not diff, diff
