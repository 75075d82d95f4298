"""Secrets in texts: fixed patterns, and values that would be costly to guess.

The guess cost of a value is the least sum of bits over its segmentations into words of passwords and
of the corpus itself, by their rank (also with digits for letters), dates, repeats, keyboard walks and brute-force spans, found by dynamic
programming. It is applied to values that stand where credentials stand (``pwd: ...``,
``https://user:...@host``, ``Bearer ...``,
``Authorization: Basic ...``); those costing at least ``MIN_BITS`` are reported as
``guess`` beside the fixed kinds, unless the value of a fixed ``assign`` span holds all of them.

Positions are code points, the end exclusive. Null counts as empty: no spans. Whole texts are
scanned; the cost of a value grows in proportion to its length.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import without
from trendlake.session import materialise

KINDS = ("assign", "access", "hex", "guess")
MIN_BITS = 45.0
SPLIT_BITS = 1.0  # each further segment of a guess

# The patterns of the base kinds.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")  # see LONG_HEX
LEAST = {"assign": 8, "access": 16, "hex": 32}
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Where credentials stand, beyond the base kind.
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "login", "://")
KEY = re.compile(
    r"""(?ai:pass(?:word|wd|phrase|code|key)|pwd|(?:api|access|private|secret|auth)[_-]?key)|(?P<bearer>(?ai:bearer)[ \t]++)"""
    r"""|(?ai:(?:pass|secret|token|credential|auth(?:orization|entication)?|login)s?)"""
    # The word ends here, or goes on as another one: passenger, author, secretary.
    r"""(?:(?![^\W\d_])|(?<=[a-z])(?=[A-Z])|(?P<goes_on>))"""
)
KEY_END = re.compile(r"[\w-]*+", re.A)
SEPARATOR = re.compile(r"""(?ai:["']?[ \t]*+(?:=>|:=|[:=]|\bis\b)[ \t]*+["']?(?:(?:bearer|basic|token)[ \t]++)?+)""")
VALUE = re.compile(r"""[^\s"'<>,;]++""")
URL_PASSWORD = re.compile(r"""://[^\s/:@"']*+:([^\s/@"']++)@""")
LEAST_VALUE = 6
TRAILING = ".,;:!?)]}"

# Common words of passwords, most frequent first.
WORDS = (
    "password qwerty dragon monkey letmein master sunshine princess football baseball welcome shadow superman batman "
    "michael jordan hunter ranger buster soccer hockey killer george charlie andrew michelle love secret summer winter "
    "spring autumn hello freedom whatever trustno starwars computer internet admin administrator root user guest test "
    "login access default changeme change me example sample demo temp pass passwd token key api null none true false "
    "company service system server database backup office home house family friend happy lucky flower orange banana "
    "apple cookie coffee cheese chocolate pepper ginger silver golden diamond purple yellow green blue black white red "
    "january february march april may june july august september october november december monday friday sunday"
).split()
WORD_BITS = {w: math.log2(n + 2) for n, w in reversed(list(enumerate(WORDS)))}
WORD_LENGTHS = sorted({len(w) for w in WORDS})
# Words of the corpus: runs of so many letters, in so many documents outside the places of credentials.
SHORTEST, LONGEST, LEAST_DOCS = 3, 40, 3
ALL_LENGTHS = sorted({*WORD_LENGTHS, *range(SHORTEST, LONGEST + 1)})
MAX_WORDS = 300_000  # words sent to every task; beyond that each row is joined with its own
STEPS = 8  # steps of word frequency per power of two; words of one step have one rank
RUN, LETTERS = re.compile(r"\w++"), re.compile(r"[^\W\d_]++")
LEET = str.maketrans("40381$57@!|", "aoeblssta" + "il")
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
DATE = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d"
    r"|(?:19|20)\d\d"
)
DATE_BITS, YEAR_BITS = math.log2(365 * 130), math.log2(130)
MAX_UNIT = 16  # longest repeated unit looked for


def _neighbours() -> set[str]:
    """Pairs of keys that touch, in either direction; rows are half a key apart."""
    place = {key: (x + row / 2, row) for row, keys in enumerate(KEY_ROWS) for x, key in enumerate(keys)}
    near = lambda a, b: abs(a[1] - b[1]) <= 1 and abs(a[0] - b[0]) <= 1 and a != b
    return {a + b for a, p in place.items() for b, q in place.items() if near(p, q)}


NEAR = _neighbours()
ALPHABETS = ((re.compile(r"\d*\Z"), 10), (re.compile(r"[\da-f]*\Z"), 16), (re.compile(r"[a-z]*\Z"), 26), (re.compile(r"[\da-z]*\Z"), 36), (re.compile(r"[\da-zA-Z]*\Z"), 62))


def _letter_bits(value: str) -> float:
    """Bits of one character drawn from the smallest alphabet that holds the value."""
    return math.log2(next((n for pattern, n in ALPHABETS if pattern.match(value)), 94))


def _lowered(value: str) -> str:
    low = value.lower()
    return low if len(low) == len(value) else value  # a letter whose small form is longer


def guess_bits(value: str, words: dict[str, float] | None = None) -> float:
    """log2 of the guesses for ``value`` along its cheapest segmentation; 0 for the empty value.

    ``words``: the bits of further words, of ``SHORTEST`` to ``LONGEST`` letters.
    """
    n = len(value)
    low = _lowered(value)
    plain = low.translate(LEET)
    words = words or {}
    lengths = ALL_LENGTHS if words else WORD_LENGTHS
    letter = _letter_bits(value)
    ends: dict[int, list[tuple[int, float]]] = {}
    for found in DATE.finditer(value):
        bits = YEAR_BITS if found.end() - found.start() == 4 else DATE_BITS
        ends.setdefault(found.end(), []).append((found.start(), bits))
    walk = 1
    runs = [0] * (MAX_UNIT + 1)
    spent, forced = [0.0] + [math.inf] * n, [math.inf] * (n + 1)  # forced: the last segment is brute force
    for j in range(1, n + 1):
        forced[j] = min(forced[j - 1], spent[j - 1] + (SPLIT_BITS if j > 1 else 0)) + letter
        best = forced[j]
        for length in lengths:
            i = j - length
            if i < 0:
                break
            word = plain[i:j]
            if (bits := min(WORD_BITS.get(word, math.inf), words.get(word, math.inf))) < math.inf:
                bits += (value[i:j] != low[i:j]) + 2 * (low[i:j] != plain[i:j])
                best = min(best, spent[i] + (SPLIT_BITS if i else 0) + bits)
        for i, bits in ends.get(j, ()):
            best = min(best, spent[i] + (SPLIT_BITS if i else 0) + bits)
        walk = walk + 1 if j > 1 and low[j - 2 : j] in NEAR else 1
        if walk >= 3:
            i = j - walk
            best = min(best, spent[i] + (SPLIT_BITS if i else 0) + math.log2(len(KEY_ROWS) * 12) + 1.5 * (walk - 1))
        for unit in range(1, min(MAX_UNIT, j - 1) + 1):
            runs[unit] = runs[unit] + 1 if value[j - 1] == value[j - 1 - unit] else 0
            times = runs[unit] // unit + 1
            if times >= 2 and times * unit >= 3:
                i = j - times * unit
                best = min(best, spent[i] + (SPLIT_BITS if i else 0) + unit * letter + math.log2(times))
        spent[j] = best
    return spent[n]


def _has_places(low: str) -> bool:
    return any(w in low for w in CONTEXT_WORDS)


def _values(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the values that stand where credentials stand.

    A name, the separator after it and a value are each read once, however many key words the name
    or the value holds; a value's tail behind a further key word is part of that value. Where the key
    word only begins another word the separator must be one of program text.
    """
    name_end, found, start, value_end = -1, None, None, -1
    for key in KEY.finditer(text):
        if key["bearer"]:
            at = key.end()
        else:
            if key.end() > name_end:
                name_end = KEY_END.match(text, key.end()).end()
                found = SEPARATOR.match(text, name_end)
                start = found and found.end()
            at = start if key["goes_on"] is None or (found and "=" in found[0]) else None
        if at is None or at < value_end or not (value := VALUE.match(text, at)):
            continue
        value_end = value.end()
        if value_end - at >= LEAST_VALUE:
            yield at, value_end
    for url in URL_PASSWORD.finditer(text):
        if len(url[1]) >= LEAST_VALUE:
            yield url.span(1)


def scan(text: str | None, min_bits: float = MIN_BITS, words: dict[str, float] | None = None) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, bits) by start, then kind as listed; bits only for ``assign`` and ``guess``."""
    if not text:
        return []
    low = text.lower()
    found = []
    assigned = []
    if any(w in low for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[1]) >= LEAST["assign"]:
                assigned.append(m.span(1))
                found.append(("assign", *m.span(), guess_bits(m[1], words)))
    if "AKIA" in text:
        found += [("access", *m.span(), None) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [("hex", *m.span(), None) for m in LONG_HEX.finditer(text)]
    if _has_places(low):
        seen = set()
        for start, end in _values(text):
            end = start + len(text[start:end].rstrip(TRAILING))
            last = bisect_right(assigned, (start, math.inf)) - 1
            covered = (start, end) in seen or (last >= 0 and end <= assigned[last][1])
            if end > start and not covered and (bits := guess_bits(text[start:end], words)) >= min_bits:
                seen.add((start, end))
                found.append(("guess", start, end, bits))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# A maximal run of hex letters is one match of HEX; only runs long enough matter.
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % LEAST["hex"])


def _words_and_values(text: str) -> tuple[set[str], list[str]]:
    """The words outside the places of credentials, and the values in them."""
    low = text.lower()
    spans = sorted(_values(text)) if _has_places(low) else []
    if any(w in low for w in ASSIGN_WORDS):
        spans = sorted(spans + [m.span(1) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST["assign"]])
    if spans:
        parts, at = [], 0
        for start, end in spans:
            parts.append(text[at:start])
            at = max(at, end)
        low = " ".join([*parts, text[at:]]).lower()
    runs = {w for w in set(RUN.findall(low)) if SHORTEST <= len(w) <= LONGEST and w.isalpha()}
    return runs, [text[start:end] for start, end in spans]


def _pieces(value: str) -> Iterator[str]:
    """The runs of letters in a value that may be words of the corpus, one by one: a long value has very many."""
    plain = _lowered(value).translate(LEET)
    for piece in LETTERS.findall(plain):
        n = len(piece)
        for i in range(n - SHORTEST + 1):
            for j in range(i + SHORTEST, min(n, i + LONGEST) + 1):
                yield piece[i:j]


def corpus_words(df: DataFrame, text: str = "text") -> tuple[DataFrame, dict[int, float]]:
    """(word, step, asked) of the corpus's words, and the bits of each step of frequency.

    ``asked``: whether some value holds the word. One pass over the text; what it gives is added up
    per task and written to the scratch folder.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs: Counter[str] = Counter()
        asked: set[str] = set()

        def flush() -> pd.DataFrame:
            rows = list(docs.keys() | asked)
            out = pd.DataFrame({"word": rows, "docs": [docs[w] for w in rows], "asked": [w in asked for w in rows]})
            docs.clear()
            asked.clear()
            return out

        for batch in batches:
            for t in batch["text"]:
                if t:
                    runs, values = _words_and_values(t)
                    docs.update(runs)
                    for piece in chain.from_iterable(map(_pieces, values)):
                        asked.add(piece)
                        if len(asked) > 100_000:
                            yield flush()
                    if len(docs) + len(asked) > 100_000:
                        yield flush()
        if docs or asked:
            yield flush()

    parts = df.select(F.col(f"`{text}`").alias("text")).mapInPandas(counted, "word string, docs long, asked boolean")
    summed = parts.groupBy("word").agg(F.sum("docs").alias("docs"), F.max("asked").alias("asked")).where(F.col("docs") >= LEAST_DOCS)
    words = materialise(summed.select("word", F.floor(F.log2("docs") * STEPS).cast("int").alias("step"), "asked"), "secret-words")
    bits, before = {}, 0
    for row in sorted(words.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        bits[row["step"]] = math.log2(before + row["count"] / 2 + 2)
        before += row["count"]
    return words, bits


def find_secrets(
    df: DataFrame, text: str = "text", out: str = "secrets", min_bits: float = MIN_BITS, max_words: int = MAX_WORDS
) -> DataFrame:
    """``df`` with ``out``: array of (kind, start, end, bits) of every whole text.

    Words are priced by their rank in the whole of ``df``. Only those that some value holds are looked
    at; up to ``max_words`` of them are sent to every task.
    """
    names = ("kind", "start", "end", "bits")
    spans = "array<struct<kind: string, start: long, end: long, bits: double>>"
    words, bits = corpus_words(df, text)
    asked = words.where("asked").select("word", "step")
    rows = asked.limit(max_words + 1).collect()
    kept = without(df, out)
    if len(rows) <= max_words:
        known = df.sparkSession.sparkContext.broadcast({r["word"]: bits[r["step"]] for r in rows})

        @F.pandas_udf(spans)
        def secrets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([[dict(zip(names, s)) for s in scan(t, min_bits, known.value)] for t in texts], dtype=object)

        return kept.withColumn(out, secrets(F.col(f"`{text}`")))

    @F.pandas_udf("array<string>")
    def pieces(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(set().union(*map(_pieces, _words_and_values(t)[1]))) if t else [] for t in texts], dtype=object)

    @F.pandas_udf(spans)
    def secrets_of(texts: pd.Series, own: pd.Series, steps: pd.Series) -> pd.Series:
        found = []
        for t, w, k in zip(texts, own, steps):
            priced = {} if w is None else {x: bits[y] for x, y in zip(w, k)}
            found.append([dict(zip(names, s)) for s in scan(t, min_bits, priced)])
        return pd.Series(found, dtype=object)

    # The row is one column here, so that no name of its columns can be in the way.
    numbered = kept.select(F.struct(*[f"`{c}`" for c in kept.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    numbered = materialise(numbered.withColumn("nr", F.monotonically_increasing_id()), "secret-rows")
    held = numbered.select("nr", F.explode(pieces("text")).alias("word")).join(asked, "word")
    held = held.groupBy("nr").agg(F.collect_list(F.struct("word", "step")).alias("held"))
    joined = numbered.join(held, "nr", "left")
    return joined.select("row", secrets_of("text", F.col("held.word"), F.col("held.step")).alias("found")).select(
        *[F.col("row")[c].alias(c) for c in kept.columns], F.col("found").alias(out)
    )
