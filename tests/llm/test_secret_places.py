"""Places where credentials stand, and values of any form in them."""

import pytest
from pyspark.sql import functions as F

from trendlake.llm import secrets

VALUE = "kT9xQ2vLm8ZrB4wN"


def values(text, kind="guess", **more):
    return [text[s[1] : s[2]] for s in secrets.scan(text, **more) if s[0] == kind]


@pytest.mark.parametrize("scheme", ["Bearer", "bearer", "Basic", "token", "Bearer  "])
@pytest.mark.parametrize("form", ["Authorization: %s", '{"Authorization": "%s"}', "curl -H 'authorization: %s' host", "auth = %s"])
def test_header_forms(form, scheme):
    assert values(form % f"{scheme} {VALUE}") == [VALUE]


def test_schemes_alone():
    assert values(f"Bearer {VALUE}") == [VALUE] and values("Authorization: Bearer") == [] and values("Authorization: Bearer \nnext") == []


@pytest.mark.parametrize(
    "text",
    [
        "pwd        = %s",
        "pwd\t\t\t\t\t\t:\t\t\t\t\t\t'%s'",
        "pass_for_the_production_database_of_the_company: %s",
        "redis://:%s@host/0",
        "https://" + "u" * 80 + ":%s@host",
        "login: pass: %s",
    ],
)
def test_values_far_from_their_word(text):
    assert values(text % VALUE) == [VALUE]


def test_long_names_and_values_take_linear_time():
    for text in ("token_" * 50000, "pass=" * 2000, "pwd" + " " * 10**6 + "x", "://" * 10**5, "token_" * 50000 + " = " + VALUE):
        assert secrets.scan(text) == [] or text.endswith(VALUE)


def test_values_that_go_on_behind_an_assign_span():
    text = 'password="Abcdefgh!9xQ#v" token=' + VALUE
    assert values(text, "assign") == ['password="Abcdefgh', "token=" + VALUE]
    assert values(text) == ["Abcdefgh!9xQ#v"]
    assert values(f"password={VALUE}.") == []


def test_ordinary_words_are_no_secrets(spark):
    prose = "The passenger is travelling with Margaret Lindqvist to a remarkable neighbourhood, says the Secretary"
    rows = [(i, prose) for i in range(5)]
    rows += [(10, "passenger is travelling. Author: Margaret"), (11, "The secretary is remarkable"), (12, "login: MargaretLindqvist")]
    rows += [(20, f"passenger_pwd = {VALUE}"), (21, "pass: qkvjxwzrtbp"), (22, "dbAuth: kT9xQ2vL#m8Z")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("nr", F.lit("mine"))
    many = secrets.find_secrets(table).collect()
    each = secrets.find_secrets(table, max_words=0).collect()
    key = lambda r: r["doc_id"]
    assert sorted(many, key=key) == sorted(each, key=key) and len(many) == len(rows)
    found = {r["doc_id"]: [r["text"][s["start"] : s["end"]] for s in r["secrets"] if s["kind"] == "guess"] for r in many}
    assert {k: v for k, v in found.items() if v} == {20: [VALUE], 21: ["qkvjxwzrtbp"], 22: ["kT9xQ2vL#m8Z"]}


def test_key_words_within_other_words():
    for text in ("passenger is Przybyszewski", "Author: Przybyszewskaja", "secretary: Przybyszewskaja", "PASSENGER IS PRZYBYSZEWSKI"):
        assert values(text) == []
    for text in ("auth_user: %s", "authUser: %s", "passengerPass: %s", "passvalue = %s", "secrets: %s"):
        assert values(text % VALUE) == [VALUE]
