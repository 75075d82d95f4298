"""Decontamination against a plain search."""

import random
import re

import pytest

from trendlake.llm import decontamination
from trendlake.llm.decontamination import WindowSet, mark_contaminated, normalised, remove_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, window):
    words, hit, found = words_of(text), set(), set()
    for name, item in items:
        own = words_of(item)
        k = min(window, len(own))
        windows = {tuple(own[s : s + k]) for s in range(len(own) - k + 1)} if k else set()
        for at in range(len(words) - k + 1):
            if tuple(words[at : at + k]) in windows:
                hit |= set(range(at, at + k))
                found.add("" if name is None else str(name))
    return len(words), len(hit), sorted(found)


def made(rng, n):
    return "".join(rng.choice(["a", "b", "Ab", "é", "É", "x1", "d"]) + rng.choice([" ", "\n", ". ", "--", "\x00"]) for _ in range(n))


def test_windows_of_random_items():
    rng = random.Random(3)
    for _ in range(150):
        window = rng.choice([2, 3, 4])
        items = [(str(n), made(rng, rng.choice([0, 1, 2, 3, 6, 9]))) for n in range(3)]
        docs = [made(rng, rng.choice([0, 1, 5, 30, 60])) for _ in range(4)]
        rows = WindowSet([(n, normalised(t)) for n, t in items], window).scan([normalised(d) for d in docs])
        assert [(n, sum(b - a for a, b in r), i) for n, r, i in rows] == [plain(d, items, window) for d in docs]


def test_words_are_told_apart_when_hashes_meet(monkeypatch):
    """A hash of one bit sends every lookup to a wrong window now and then; all words are compared."""
    weak = decontamination._hash
    monkeypatch.setattr(decontamination, "_hash", lambda rows, seed: weak(rows, seed) >> decontamination.U64(55))
    items = [("i", b"a b c d"), ("j", b"b c a d")]
    found = WindowSet(items, 3).scan([b"a b c", b"c d a", b"b c a", b"a b d", b"b c d c a d"])
    assert [i for _, _, i in found] == [["i"], [], ["j"], [], ["i", "j"]]


ITEMS = [
    (10, "One two three four five six seven eight nine ten eleven twelve"),
    (9, "short, item"),
    (9, "second text of nine " * 4),
    (None, "words of a nameless item come here and there in a text of it"),
    (7, None),
    (8, "  ?!"),
]
DOCS = [
    (1, "Before. ONE two-three four five six\nseven eight nine ten! After", "x", "y"),
    (1, "Before. ONE two-three four five six\nseven eight nine ten! After", "x", "y"),
    (2, "one two three four five six seven eight nine", "x", None),
    (3, None, None, "z"),
    (4, "", "x", "y"),
    (5, "the short item " + "and " * 3000 + "eleven short; item", "x", "y"),
    (None, "of a nameless item come here and there in a text", "x", "y"),
    (6, "word" * 5000 + " " + "one two three four five six seven eight nine ten eleven twelve " * 200, "x", "y"),
]
CLASH = "doc_id long, text string, _found string, words string"


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_rows_and_blocks(spark, block_bytes):
    docs, items = spark.createDataFrame(DOCS, CLASH), spark.createDataFrame(ITEMS, "item_id long, text string")
    found = mark_contaminated(docs, items, block_bytes=block_bytes)
    rows = [(r.doc_id, r._found, r.words, r.n_words, r.n_hit, r.hit_items) for r in found.collect()]
    want = [(k, a, b, *plain(t, ITEMS, 10)) for k, t, a, b in DOCS]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert [r[5] for r in rows if r[0] == 1] == [["10"]] * 2


def test_removal(spark):
    docs, items = spark.createDataFrame(DOCS, CLASH), spark.createDataFrame(ITEMS, "item_id long, text string")
    cut = remove_contaminated(docs, items)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[1] == "Before. ! After" and texts[5] == "the " + " " + "and " * 3000 + "eleven " and texts[3] is None
    assert texts[2] == DOCS[2][1] and len(texts[6]) == 20_000 + 1 + 1
    left = remove_contaminated(docs, items, how="documents")
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4]
    some = remove_contaminated(docs, items, how="documents", most=0.9)
    assert sorted(r.doc_id for r in some.collect() if r.doc_id) == [1, 1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        remove_contaminated(docs, items, how="all")


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS, CLASH), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert {r.n_hit for r in mark_contaminated(docs, items.limit(0)).collect()} == {0}
    assert mark_contaminated(docs.limit(0), items).count() == 0


def test_long_items_are_cut_without_losing_windows(spark):
    long = [f"w{n}" for n in range(9000)]
    docs = [(n, " ".join(long[n : n + 10]), "", "") for n in range(0, 8990, 7)] + [(-1, " ".join(long[5:14]), "", "")]
    found = mark_contaminated(spark.createDataFrame(docs, CLASH), spark.createDataFrame([(1, " ".join(long))], "item_id long, text string"))
    assert {(r.doc_id >= 0, r.n_hit) for r in found.collect()} == {(True, 10), (False, 0)}
