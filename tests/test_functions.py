from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lodgeframe.functions import clean as C
from lodgeframe.functions import dates as D
from lodgeframe.functions import features as X
from lodgeframe.functions import text as T
from tests.helpers import values


def test_clean_currency(spark):
    texts = ["$1,234.50", "97%", "€80", None, "", "n/a", "1d", " 12 ", "-3.5", "1e3"]
    got = values(spark, texts, "c string", C.clean_currency(F.col("c")))
    assert got == [1234.5, 97.0, 80.0, None, None, None, None, 12.0, -3.5, 1000.0]


def test_clean_currency_strict_fails_on_junk(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["n/a"], "c string", C.clean_currency(F.col("c"), strict=True))
    assert values(spark, ["$5"], "c string", C.clean_currency(F.col("c"), strict=True)) == [5.0]


def test_clean_rate_bounds(spark):
    got = values(spark, ["0%", "100%", "100.5%", "-1%", "x", None], "c string", C.clean_rate(F.col("c")))
    assert got == [0.0, 100.0, None, None, None, None]


def test_map_bool_of_each_type(spark):
    assert values(spark, ["t", "f", None, "x", "True"], "c string", C.map_bool(F.col("c"))) == [
        True, False, None, None, None,
    ]
    assert values(spark, [True, False, None], "c boolean", C.map_bool(F.col("c"))) == [True, False, None]
    assert values(spark, [1, 0, 2, None], "c int", C.map_bool(F.col("c"))) == [True, False, None, None]
    assert values(spark, [1.0, 0.0, None], "c double", C.map_bool(F.col("c"))) == [True, False, None]


def test_bool_eq_reads_null_as_false(spark):
    assert values(spark, ["t", "f", None], "c string", C.bool_eq(F.col("c"))) == [True, False, False]


def test_parse_numeric(spark):
    texts = ["1.5 baths", "Half-bath", "medio baño", "2 shared baths", "Private", None, "1.2.3", "."]
    got = values(spark, texts, "c string", C.parse_numeric(F.col("c")))
    assert got == [1.5, 0.5, 0.5, 2.0, None, None, None, None]


def test_clip_keeps_null(spark):
    data = [None, -1.0, 0.0, 5.0, 10.0, 11.0]
    assert values(spark, data, "c double", C.clip(F.col("c"), 0.0, 10.0)) == [None, 0.0, 0.0, 5.0, 10.0, 10.0]
    assert values(spark, data, "c double", C.clip(F.col("c"), hi=10.0)) == [None, -1.0, 0.0, 5.0, 10.0, 10.0]
    assert values(spark, data, "c double", C.clip(F.col("c"), lo=0.0)) == [None, 0.0, 0.0, 5.0, 10.0, 11.0]
    assert values(spark, data, "c double", C.clip(F.col("c"))) == data


def test_parse_date_and_sanity(spark):
    got = values(spark, ["2024-02-29", "2025-13-01", "2023-02-29", "x", None], "c string", C.parse_date(F.col("c")))
    assert got == [dt.date(2024, 2, 29), None, None, None, None]
    pairs = [(dt.date(2024, 1, 1), dt.date(2024, 1, 2)), (dt.date(2024, 1, 3), dt.date(2024, 1, 2)), (None, dt.date(2024, 1, 2))]
    first, last = C.ordered_pair(F.col("a"), F.col("b"))
    assert values(spark, pairs, "a date, b date", first) == [dt.date(2024, 1, 1), None, None]
    assert values(spark, pairs, "a date, b date", last) == [dt.date(2024, 1, 2), None, dt.date(2024, 1, 2)]


def test_small_value_steps(spark):
    assert values(spark, [0.0, 1.0, None], "c double", C.zero_to_null(F.col("c"))) == [None, 1.0, None]
    assert values(spark, [0, 2, None], "c int", C.zero_to_null(F.col("c"))) == [None, 2, None]
    assert values(spark, ["a", "b", None], "c string", C.map_lookup(F.col("c"), {"a": 1})) == [1, None, None]
    got = values(spark, [(None, 1.0), (True, 1.0), (False, 1.0)], "m boolean, c double", C.cond_assign(F.col("c"), F.col("m"), F.lit(9.0)))
    assert got == [1.0, 9.0, 1.0]
    assert values(spark, [0.5, 1.5, 2.5, -0.5, None], "c double", C.round_half_even(F.col("c"))) == [0.0, 2.0, 2.0, 0.0, None]


def test_tri_state(spark):
    cases = [(True, None, None), (None, True, True), (None, False, True), (None, None, True), (None, None, None)]
    got = values(spark, cases, "k boolean, y boolean, n boolean", C.tri_state(F.col("k"), F.col("y"), F.col("n"), F.lit(True)))
    assert got == [True, True, False, False, True]


def test_clean_text(spark):
    texts = ["<br/>Muy BIEN!! ñandú ½", "", None, "?!...", "a_b  c\n\td", "<a\nhref>x</a>", "naïve—test"]
    got = values(spark, texts, "c string", T.clean_text(F.col("c")))
    assert got == ["muy bien ñandú ½", "", "", "", "a_b c d", "x", "naïve test"]


def test_keyword_flags(spark):
    texts = ["Casa en el CENTRO", "HISTÓRICO", None, "Rosalia", "Pisos SL"]
    assert values(spark, texts, "c string", T.keyword_flag(F.col("c"), "centro|histórico")) == [1, 1, 0, 0, 0]
    assert values(spark, texts, "c string", T.keyword_flag(F.col("c"), "sl|sa")) == [1, 0, 0, 1, 1]
    assert values(spark, texts, "c string", T.keyword_flag(F.col("c"), "sl|sa", whole_word=True)) == [0, 0, 0, 0, 1]


def test_categorize_text_takes_the_first_rule(spark):
    rules = [(("málaga", "malaga"), "near"), (("spain",), "land")]
    got = values(spark, ["Málaga, Spain", "Spain", "Buenos Aires", "Nantes", None], "c string",
                 T.categorize_text(F.col("c"), rules, "abroad", "unknown"))
    assert got == ["near", "land", "abroad", "abroad", "unknown"]


def test_lists(spark):
    texts = ['["Wifi", "Kitchen"]', "['email', 'phone']", "[]", '["Children\'s toys"]', "[bad", None]
    assert values(spark, texts, "c string", T.parse_list(F.col("c"))) == [
        ["Wifi", "Kitchen"], ["email", "phone"], [], ["Children's toys"], [], [],
    ]
    assert values(spark, texts, "c string", T.parse_list(F.col("c"), compat=True))[3] == []
    assert values(spark, texts, "c string", T.printed_list(F.col("c")))[1:3] == [["email", "phone"], []]
    assert values(spark, ["a,b", "a", None], "c string", T.comma_count(F.col("c"))) == [2, 1, 0]


def test_words_of_whole_text(spark):
    text = "Don't STOP, the café was very good good " + "zebra " * 5000
    (got,) = values(spark, [text], "c string", T.words(F.col("c")))
    assert [w for w in got if w][:8] == ["dont", "stop", "the", "caf", "was", "very", "good", "good"]
    assert got.count("zebra") == 5000


def _computus(year: int) -> dt.date:
    """Gauss's rule, another formula than the one under test."""
    k = year // 100
    m = (15 - (13 + 8 * k) // 25 + k - k // 4) % 30
    n = (4 + k - k // 4) % 7
    d = (19 * (year % 19) + m) % 30
    e = (2 * (year % 4) + 4 * (year % 7) + 6 * d + n) % 7
    if d == 29 and e == 6:
        day = 50
    elif d == 28 and e == 6 and (11 * m + 11) % 30 < 19:
        day = 49
    else:
        day = 22 + d + e
    return dt.date(year, 3, 1) + dt.timedelta(days=day - 1)


def test_easter(spark):
    years = list(range(1583, 2600))
    got = values(spark, years, "y int", D.easter_sunday(F.col("y")))
    assert got == [_computus(y) for y in years]
    known = {2000: (4, 23), 2008: (3, 23), 2024: (3, 31), 2025: (4, 20), 2026: (4, 5), 2038: (4, 25)}
    assert all(got[y - 1583] == dt.date(y, *md) for y, md in known.items())


def test_event_label(spark):
    N, days = D.EventNames(), {
        "2026-03-26": "normal", "2026-03-27": "easter", "2026-04-04": "easter", "2026-04-05": "normal",
        "2026-08-14": "summer", "2026-08-15": "fair", "2026-08-22": "fair", "2026-08-23": "summer",
        "2026-06-22": "summer", "2026-06-23": "midsummer", "2026-07-01": "summer", "2026-12-19": "normal",
        "2026-12-20": "christmas", "2026-01-06": "christmas", "2026-01-07": "normal",
    }
    got = values(spark, [dt.date.fromisoformat(d) for d in days] + [None], "d date", D.event_label(F.col("d")))
    assert got == [getattr(N, n) for n in days.values()] + [None]


def test_date_parts(spark):
    monday, sunday = dt.date(2026, 4, 6), dt.date(2026, 4, 5)
    assert values(spark, [monday, sunday, None], "d date", D.weekday(F.col("d"))) == [0, 6, None]
    assert values(spark, [monday, sunday, None], "d date", D.is_weekend(F.col("d"))) == [False, True, False]
    got = values(spark, [sunday, None], "d date", D.days_since(F.col("d"), F.lit("2026-04-10").cast("date")))
    assert got == [5, 0]


def test_haversine(spark):
    (km, zero) = values(spark, [(40.4168, -3.7038), (36.7213, -4.4214)], "a double, b double",
                        X.haversine_km(F.col("a"), F.col("b"), F.lit(36.7213), F.lit(-4.4214)))
    assert km == pytest.approx(415.6, abs=1.0) and zero == pytest.approx(0.0, abs=1e-9)


def test_features(spark):
    assert values(spark, [(4.5, 9), (None, 9)], "r double, n int", X.trust_score(F.col("r"), F.col("n"))) == [
        pytest.approx(4.5 * math.log(10)), 0.0,
    ]
    assert values(spark, [(1.0, 2), (1.0, 0), (None, 2), (1.0, None)], "a double, b int", X.safe_ratio(F.col("a"), F.col("b"))) == [0.5, 0.0, None, 0.0]
    assert values(spark, [1, 2, 4, 5, None], "n int", X.segment_count(F.col("n"))) == [
        "Individual", "Small_Investor", "Small_Investor", "Agency", "Agency",
    ]
    assert values(spark, [(5, 1, 1), (1, 1, 3), (None, 1, 1)], "t int, a int, b int", X.residual_count(F.col("t"), [F.col("a"), F.col("b")])) == [3, 0, None]
    assert values(spark, [366, 365, None], "n int", X.long_stay(F.col("n"))) == [True, False, False]
    assert values(spark, [("x", 5), ("Pisos SL", 1), ("Rosalia", 4), (None, None)], "h string, n int", X.company_flag(F.col("h"), F.col("n"), "sl|sa")) == [1, 1, 0, 0]


def test_status_rule_needs_every_input(spark):
    data = [(None, 10, 0.9, 0.9, 4.8), (None, 9, 1.0, 1.0, 5.0), (None, None, 1.0, 1.0, 5.0), (True, 0, 0.0, 0.0, 0.0)]
    got = values(spark, data, "k boolean, n int, a double, b double, r double",
                 X.status_rule(*[F.col(c) for c in "knabr"]))
    assert got == [True, False, False, True]
