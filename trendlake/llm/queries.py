"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm import (
    bpe,
    decontamination,
    exact_dedup,
    html_text,
    language,
    line_rules,
    mixing,
    near_dedup,
    periodic_runs,
    phrases,
    quality_model,
    secrets,
    suffix_dedup,
)
from trendlake.llm.common import bind, fold, read, words
from trendlake.session import materialise

TOKENIZER = "word_bpe_49k.json"
REJECT_BELOW = 0.3


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read(spark, sf_dir, "documents", *columns)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode_checked(_documents(spark, sf_dir, "doc_id", "text"), tokenizer_path())
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")


def quality_model_of(docs: DataFrame, labels: DataFrame, learn: Column) -> quality_model.QualityModel:
    """Fitted on the labelled rows of ``docs`` for which ``learn`` holds."""
    rows = docs.select("doc_id", "text").where(learn).join(labels.select("doc_id", "quality"), "doc_id")
    return quality_model.fit_quality(rows)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    model = quality_model_of(docs, read(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    scored = quality_model.score_quality(docs, model)
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted")
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_text(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_documents(spark, sf_dir, "doc_id", "text"))
    of_kind = lambda kind: F.filter("secrets", lambda s: s["kind"] == kind)
    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        *[F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("secrets")).alias("spans"),
        F.size(of_kind("guess")).cast("long").alias("n_guess"),
        F.array_max(F.transform("secrets", lambda s: s["bits"])).alias("most_bits"),
    )


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ("row", "lines")
    docs = line_rules.with_lines(line_rules.text_figures(_documents(spark, sf_dir, "doc_id", "text", "source")), lines).drop("text")
    found = line_rules.remove_common_lines(materialise(docs, "line-figures"), lines=lines)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~F.col("depleted")).alias("kept"), "n_lines_removed", "n_words_kept",
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text", "lang")
    held_out = fold("doc_id", 3) == 1
    profiles = language.fit_profiles(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_documents(spark, sf_dir, "doc_id", "text", "source"))
    return found.select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_groups(_documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "class_id", "class_size", "kept")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_documents(spark, sf_dir, "doc_id", "text"))
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return found.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(_documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = read(spark, sf_dir, "benchmark", "item_id", "text")
    found = decontamination.mark_contaminated(_documents(spark, sf_dir, "doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = phrases.frequent_phrases(_documents(spark, sf_dir, "lang", "text"))
    found = phrases.top_collocations(phrases.collocations(counts), 2000)
    return found.select(F.col("grp").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def planted_period(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in which one text of ten has a periodic end, as told by its id."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    own = bind(docs.withColumn("g", F.floor(h / 10).cast("long")).withColumn("chosen", h % 10 == 0), words=F.when(F.col("chosen"), words(F.col("text"))))
    n = F.size("words").cast("long")
    own = own.withColumn("a", F.when(n > 0, F.col("g") % n))
    own = own.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    moved = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("words", place(i).cast("int")))
    return own.select("doc_id", F.when(F.col("chosen") & (n > 0), F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.mark_runs(planted_period(_documents(spark, sf_dir, "doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    out = found.select("doc_id", "runs", "collapsed", longest.alias("best"), F.array_join(lines, "").alias("lines"))
    length, period = F.col("best.length").cast("long"), -F.col("best.col3").cast("long")
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2").cast("long")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_html_extraction": op3_html_extraction,
        "op4_secret_scan": op4_secret_scan,
        "op5_line_frequency": op5_line_frequency,
        "op6_language_id": op6_language_id,
        "op7_source_mixing": op7_source_mixing,
        "op8_near_dedup": op8_near_dedup,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_decontamination": op11_decontamination,
        "op12_collocations": op12_collocations,
        "op13_periodic_runs": op13_periodic_runs,
        "pipeline": pipeline,
    }


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


# DuckDB for "A-Z in lower case", and the words of a benchmark item or document.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ITEM_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def oracle_sql() -> dict[str, str]:
    return {
        "op10_exact_dedup": """SELECT doc_id, keep_id, group_size,
              doc_id IS NOT DISTINCT FROM keep_id AND copy = 1 AS kept, sha256(text) AS text_sha256
            FROM (SELECT doc_id, coalesce(text, '') AS text,
                    max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
                    count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
                    row_number() OVER (PARTITION BY coalesce(text, ''), doc_id) AS copy
                  FROM documents)""",
        "op11_decontamination": f"""WITH items AS (
              SELECT coalesce(item_id::VARCHAR, '') AS item, w, least(10, len(w)) AS k
              FROM (SELECT item_id, {ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
            windows AS (SELECT DISTINCT item, k, w[i:i + k - 1] AS s FROM items, unnest(range(1, len(w) - k + 2)) AS u(i)),
            docs AS (SELECT row_number() OVER () AS r, doc_id, {ITEM_WORDS} AS w FROM documents),
            placed AS (
              SELECT r, k, i, w[i:i + k - 1] AS s
              FROM docs, (SELECT DISTINCT k FROM windows), unnest(range(1, len(w) - k + 2)) AS u(i)),
            hits AS (SELECT r, k, i, item FROM placed JOIN windows USING (k, s)),
            words AS (SELECT r, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + k)) AS u(j) GROUP BY r),
            found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
                      FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
            SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
              sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
            FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)""",
        "op12_collocations": rf"""WITH pieces AS (
              SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w
              FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\n\x0B\f\r]')) AS piece
                    FROM documents)),
            grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
                      FROM pieces, range(1, 4) AS t(k), unnest(range(1, len(w) - k + 2)) AS u(i)),
            f AS (SELECT lang, k, phrase, count(*) AS c FROM grams GROUP BY ALL),
            total AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
            cuts AS (SELECT lang, k, phrase, c AS a, j, array_to_string(string_split(phrase, ' ')[:j], ' ') AS head,
                       array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS tail
                     FROM f, range(1, 3) AS t(j) WHERE k > 1 AND c >= 10 AND j < k),
            scored AS (SELECT x.lang, x.k, x.phrase, a, l.c AS l, r.c AS r,
                         1000000::HUGEINT * a * a // (l.c::HUGEINT * r.c) AS score,
                         row_number() OVER (PARTITION BY x.lang, x.phrase
                           ORDER BY 1000000::HUGEINT * a * a // (l.c::HUGEINT * r.c), j) AS cut
                       FROM cuts x JOIN f l ON l.lang = x.lang AND l.phrase = head JOIN f r ON r.lang = x.lang AND r.phrase = tail),
            inner_ AS (SELECT lang, max(a) AS longer, part FROM (
                         SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[:2], ' '),
                                                 array_to_string(string_split(phrase, ' ')[2:], ' ')]) AS part
                         FROM scored WHERE cut = 1 AND k = 3) GROUP BY lang, part),
            ranked AS (SELECT s.lang, phrase, a, l, r, n, score::BIGINT AS score,
                         row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank
                       FROM scored s JOIN total ON total.lang = s.lang
                         LEFT JOIN inner_ i ON i.lang = s.lang AND i.part = s.phrase
                       WHERE cut = 1 AND coalesce(100 * longer < 50 * a, true))
            SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
    }
