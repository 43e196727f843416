"""The 22 answer shapes of FIXTURES.md section 4: Spark verdicts vs the expected ones,
and the same verdicts from an independent DuckDB condition."""

import json

import duckdb
import pytest

from riskmart.operators.casenotes import first_valid, parse_responses

BASE = {"risk_assessment": "high", "likely_pattern": "card_testing", "confidence": 0.8,
        "reasoning": "Amount far above the card's usual.", "recommended_action": "decline",
        "case_note": "Declined after review."}


def j(**over):
    d = dict(BASE)
    for k, v in over.items():
        if v is KeyError:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


J = j()
CASES = [
    # (name, raw answer, expected verdict, expected confidence when valid)
    ("plain", J, True, 0.8),
    ("fenced", "```json\n" + J + "\n```", True, 0.8),
    ("prose_around", "Sure, here it is: " + J + " Hope that helps.", True, 0.8),
    ("trailing_brace", J + " also }", False, None),
    ("truncated", J[:-1], False, None),
    ("no_json", "I cannot review this one.", False, None),
    ("risk_severe", j(risk_assessment="severe"), False, None),
    ("confidence_high", j(confidence=1.5), False, None),
    ("only_risk", json.dumps({"risk_assessment": "low"}), False, None),
    ("confidence_text", j(confidence="0.8"), True, 0.8),
    ("confidence_true", j(confidence=True), True, 1.0),
    ("confidence_null", j(confidence=None), False, None),
    ("confidence_word", j(confidence="x"), False, None),
    ("case_note_null", j(case_note=None), True, 0.8),
    ("empty_object", "{}", False, None),
    ("two_objects", J + J, False, None),
    ("two_objects_comma", J + "," + J, False, None),
    ("extra_nested", j(extra={"a": {"b": [1, 2]}}), True, 0.8),
    ("risk_upper", j(risk_assessment="HIGH"), False, None),
    ("braces_in_text", j(reasoning="Pattern {x} and } and {"), True, 0.8),
    ("empty_text", "", False, None),
    ("null_answer", None, False, None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, 1, raw) for i, (_, raw, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "transaction_id bigint, attempt int, raw_response string")
    return {r["transaction_id"]: r for r in parse_responses(df).collect()}


@pytest.mark.parametrize("idx", range(len(CASES)), ids=[c[0] for c in CASES])
def test_verdict(parsed, idx):
    name, raw, valid, conf = CASES[idx]
    row = parsed[idx]
    assert row["valid"] is valid, name
    if valid:
        assert row["confidence"] == conf
        assert row["risk_assessment"] == json.loads(
            raw[raw.index("{"):raw.rindex("}") + 1])["risk_assessment"]
    else:
        assert row["risk_assessment"] is None and row["confidence"] is None


def test_case_note_null_is_kept_as_null(parsed):
    idx = [c[0] for c in CASES].index("case_note_null")
    assert parsed[idx]["valid"] and parsed[idx]["case_note"] is None


def test_duckdb_condition_agrees():
    con = duckdb.connect()
    con.execute("CREATE TABLE a(i INT, raw VARCHAR)")
    con.executemany("INSERT INTO a VALUES (?, ?)", [(i, c[1]) for i, c in enumerate(CASES)])
    got = dict(con.execute(r"""
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
        FALSE) FROM v""").fetchall())
    assert got == {i: c[2] for i, c in enumerate(CASES)}


def test_first_valid_takes_lowest_valid_attempt(spark):
    rows = [(1, 1, "no"), (1, 2, J), (1, 3, j(risk_assessment="low")),
            (2, 1, "no"), (2, 2, "no"), (2, 3, "no"),
            (3, 4, J)]                      # beyond max_retries + 1 attempts
    df = spark.createDataFrame(rows, "transaction_id bigint, attempt int, raw_response string")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "transaction_id bigint")
    out = {r["transaction_id"]: r for r in first_valid(parse_responses(df), ids).collect()}
    assert out[1]["succeeded"] and out[1]["attempt"] == 2 and out[1]["risk_assessment"] == "high"
    assert not out[2]["succeeded"] and out[2]["attempt"] is None
    assert not out[3]["succeeded"]
