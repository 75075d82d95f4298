"""No operator loses or mistakes a column of its input, whatever it is called."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trendlake.llm import bpe, decontamination, exact_dedup, html_text, language, line_rules, mixing, near_dedup, periodic_runs, secrets, suffix_dedup
from trendlake.llm.queries import tokenizer_path

# Names that operators use, have used or might use for columns of their own.
NAMES = [
    "_sha", "_gone", "_gone_sha", "_row", "_key", "_hash", "_copy", "_copies", "_host", "_lines", "_line", "_removed", "_found",
    "_words", "_keys", "_placed", "_at", "_t", "key_", "row_", "_ranges", "_cut", "_bound", "_predicted", "_score", "_own_key",
    "_own_row", "_of_key", "_at_key", "_of_row", "_text", "bound", "found", "row", "key", "n", "id", "size", "rows", "copies", "Group",
    "component", "node", "elements", "band", "dotted.name", "_common_host", "digest",
]
WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
DOCS = [
    (1, WORDS + "\nshared line\nshared line", "a"),
    (2, WORDS + "\nshared line\nshared line", "a"),
    (3, " ".join(WORDS.split()[::-1]) * 20, "b"),
    (4, None, None),
    (4, None, None),
    (None, "", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(DOCS, "doc_id long, text string, source string").repartition(3)
    mine = {name: F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for name in NAMES}
    return rows.select("*", *[c.alias(name) for name, c in mine.items()])


def _model():
    random = np.random.default_rng(0)
    return random.normal(size=language.DIM)


OPERATORS = {
    "encode_texts": lambda d: bpe.encode_texts(d, tokenizer_path()),
    "encode_checked": lambda d: bpe.encode_checked(d.drop("digest"), tokenizer_path()),
    "extract_text": lambda d: html_text.extract_text(d, "text", "main"),
    "find_secrets": secrets.find_secrets,
    "find_secrets by a join": lambda d: secrets.find_secrets(d, max_words=-1),
    "text_figures": line_rules.text_figures,
    "remove_common_lines": lambda d: line_rules.remove_common_lines(d, max_docs=1, clean_text="clean"),
    "identify": lambda d: language.identify(d, {"xx": _model()}, score="cosine"),
    "drop_copies": exact_dedup.drop_copies,
    "drop_near_copies": near_dedup.drop_near_copies,
    "remove_repeats": lambda d: suffix_dedup.remove_repeats(d, length=40),
    "apply_mix": mixing.apply_mix,
    "mark_contaminated": lambda d: decontamination.mark_contaminated(d, d.sparkSession.createDataFrame([("i", WORDS)], "item_id string, text string")),
    "mark_runs": periodic_runs.mark_runs,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_stay(docs, name):
    found = OPERATORS[name](docs)
    kept = [c for c in NAMES if not (name == "encode_checked" and c == "digest")]
    assert set(kept) <= set(found.columns), name
    assert len({c.lower() for c in found.columns}) == len(found.columns)
    rows = found.select("doc_id", *[F.col(f"`{c}`") for c in kept]).collect()
    assert rows
    for row in rows:
        assert list(row)[1:] == [f"{c}:{'none' if row[0] is None else row[0]}" for c in kept], name


def test_rows_that_stay(docs):
    ids = lambda df: sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=repr)
    assert ids(exact_dedup.drop_copies(docs)) == [2, 3, 4]
    assert ids(near_dedup.drop_near_copies(docs)) in ([1, 3, 4, 4, None], [2, 3, 4, 4, None])
    clean = line_rules.remove_common_lines(docs, max_docs=1, clean_text="text").where("doc_id < 3")
    assert {r["text"] for r in clean.collect()} == {""}


def test_first_stage(spark):
    """It scores the rows; a column named like its score stays as it was."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.concat(F.lit("mine"), "doc_id").alias("_score"))
    found = corpus_pipeline.keep_good(spark, docs, sf)
    assert found.columns == docs.columns
    rows = found.collect()
    assert rows and all(r["_score"] == f"mine{r['doc_id']}" for r in rows)
