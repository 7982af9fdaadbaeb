"""Rule engine: the hand-derived 7-row golden of the event checks, plus price/email/amount rules."""

import datetime as dt

from pyspark.sql import functions as F

from lakeloom.operators import quality as q
from lakeloom.sources.files import inline

EVENT_SCHEMA = ("id int, user_id int, session_id string, ip_address string, city string, state string, "
                "postal_code string, browser string, traffic_source string, uri string, event_type string, "
                "created_at timestamp, sequence_number int")


def _events(spark):
    t = dt.datetime
    rows = [
        (3, 111, "session_i", None, "", None, None, None, None, None, "view", t(2023, 1, 1, 10, 10), 1),
        (8, 112, "session_gi", None, "", None, None, None, None, None, "view", t(2023, 1, 1, 10, 10), 1),
        (3, -5, "session_ghi", None, "Chicago", None, None, None, None, None, "view", t(2023, 1, 1, 10, 10), 1),
        (4, 104, "", None, "Houston", None, None, None, None, None, "view", t(2023, 1, 1, 10, 15), 1),
        (5, 105, "session_jkl", None, "Phoenix", None, None, None, None, None, "view", None, 1),
        (6, None, "session_mno", None, " Philadelphia ", None, None, None, None, None, "view", t(2023, 1, 1, 10, 25), 1),
        (7, 0, "   ", None, "San Antonio", None, None, None, None, None, "view", t(2023, 1, 1, 10, 30), 1),
    ]
    return inline(spark, rows, EVENT_SCHEMA)


def test_event_golden(spark):
    valid, invalid = q.clean_events(_events(spark))
    v = valid.collect()
    assert [(r.id, r.user_id, r.city) for r in v] == [(6, -1, "Philadelphia")]
    got = sorted((r.id, r.user_id, r.validation_errors) for r in invalid.collect())
    assert got == sorted([
        (3, 111, "CITY_EMPTY;"), (8, 112, "CITY_EMPTY;"), (3, -5, "USER_ID_INVALID;"),
        (4, 104, "SESSION_ID_EMPTY;"), (5, 105, "CREATED_AT_NULL;"), (7, 0, "USER_ID_INVALID;SESSION_ID_EMPTY;"),
    ])
    # after trimming, row 7's session id is the empty string
    assert invalid.filter("id = 7").first().session_id == ""
    # clean + dlq = input
    assert valid.count() + invalid.count() == 7


def test_price_rules_nulls(spark):
    df = inline(spark, [("A", "2025-01-02", None, 5), ("B", "2025-01-02", -1.0, -3), (None, None, 2.0, 1),
                        ("C", "2025-01-02", 3.0, 0)], "ticker string, date string, close double, volume long")
    out = {r.close: r.validation_errors for r in q.validate(df, q.price_rules()).collect()}
    assert out[None] == "INVALID_CLOSE;"
    assert out[-1.0] == "INVALID_CLOSE;INVALID_VOLUME;"
    assert out[2.0] == "MISSING_KEY;"
    assert out[3.0] == ""


def test_email_and_amount_rules(spark):
    df = inline(spark, [(1, "a.b@example.com"), (2, "bad@"), (None, None)], "id long, email string")
    out = {r.id: r.validation_errors for r in q.validate(df, q.email_rules()).collect()}
    assert out == {1: "", 2: "EMAIL_INVALID;", None: "ID_NULL;EMAIL_NULL;"}
    amounts = inline(spark, [("12.50",), ("abc",), ("-3",), ("",), (None,)], "amount string")
    got = [r.validation_errors for r in q.validate(amounts, q.amount_rules()).collect()]
    assert got == ["", "AMOUNT_NOT_NUMERIC;", "AMOUNT_NEGATIVE;", "AMOUNT_MISSING;", "AMOUNT_MISSING;"]


def test_error_counts_and_profile(spark):
    df = inline(spark, [("A;B;",), ("A;",), ("",)], "validation_errors string")
    counts = {r.error_code: r.n_errors for r in q.error_counts(df).collect()}
    assert counts == {"A": 2, "B": 1}
    prof = q.profile(inline(spark, [(1,), (None,)], "x int"), {"x_present": F.col("x").isNotNull()}).first()
    assert prof.rows == 2 and prof.x_present == 0.5
