"""Input made to be slow: time grows with its length, not with the square."""

import time

import pytest

from trendlake.llm import html_text, secrets

WANT = "One paragraph of plain words.\nAnother one, with more of them in it."
BODY = "<article><p>One paragraph of plain words.</p><p>Another one, with more of them in it.</p></article>"
OPEN = ["<ab ", "<![CDATA[x ", "<!x ", "<a<", "<a b='", '<a b="\' ', "</ab ", "<?x "]


@pytest.mark.parametrize("part", OPEN)
def test_tags_that_never_end(part):
    page = f"<body>{BODY}<div class=sidebar>" + part * (1_000_000 // len(part))
    start = time.process_time()
    assert html_text.main_text(page).startswith(WANT)
    assert time.process_time() - start < 15


@pytest.mark.parametrize("part", ['<a b=">x', "<a b='>\"x", '<i "\'>x'])
def test_quotes_that_never_end(part):
    page = f"<body>{BODY}<div class=sidebar>" + part * (400_001 // len(part)) + "</div>"
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 15


@pytest.mark.parametrize(
    "tag, want",
    [
        ('<p title="a > b">x</p>', "x"),
        ("<p title='a > \"b'>x</p>", "x"),
        ('<p title="open>x</p>', "x"),
        ("<p><![CDATA[a < b]]></p>", "a < b"),
        ("<p>a<!-- <p>no</p> -->b<!-- open", "ab"),
        ("<p>a<!DOCTYPE x>b<?php no ?>c", "abc"),
        ("<p>a < b and c</p><ab", "a < b and c"),
    ],
)
def test_forms_of_tags(tag, want):
    assert html_text.main_text(f"<body><article>{tag}") == want


def test_pieces_of_a_long_value_are_given_one_by_one():
    pieces = secrets._pieces("abcdefghij" * 100_000)
    assert len({next(pieces) for _ in range(1000)}) > 100
    short = "abcde"
    assert set(secrets._pieces(short)) == {short[i:j] for i in range(5) for j in range(i + secrets.SHORTEST, 6)}


def test_words_of_long_values(spark):
    rows = [(n, "password: " + "".join(chr(97 + (i * i + n) % 26) for i in range(5_000)) + " harbour lights") for n in range(3)]
    words, _ = secrets.corpus_words(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r["word"]: r["asked"] for r in words.collect()}
    assert found["harbour"] is False and found["lights"] is False
