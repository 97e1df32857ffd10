"""Quality rules whose thresholds come from the data: quantile sketches per language and source.

Each document gets a few measures. Their distribution is held in mergeable quantile sketches per language and source; from
the quartiles follows a fence for each measure, and the documents are joined with the fences of their group. The merged sketch of
all documents counts as `PRIOR` documents in a language's quartiles, and those of the language as `PRIOR` documents in a group's,
whatever its size: a small group follows its language, a large one itself, and one document more moves a threshold a little.
DataFrame operations only, no Python code.

Cases: a null text has no words; null languages and sources are groups of their own; repeated rows and null ids stay; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from .common import texts, written

#: Fixed rules that come before the fences.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A fence lies so many quartile distances from the quartile, and at least the floor of its measure.
FENCE_WIDTH, PRIOR, SKETCH_K = 3.0, 100, 400
#: Measure: least distance between quartile and fence, and whether low values are bad too.
MEASURES = {
    "symbols_per_word": (0.1, False),
    "marks_per_word": (0.25, False),
    "duplicate_line_share": (0.3, False),
    "repeat_word_share": (0.25, False),
    "chars_per_word": (1.5, True),
}
SPACES = " \t\n\x0b\f\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
MARK = "[!?]"


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern, -1)) - 1


def word_counts(docs: DataFrame) -> DataFrame:
    """`doc_id`, `lang`, `source` and the counts of each whole text.

    A step refers to the arrays of the step before more than once, so that they are computed once and not inlined.
    """
    bare = F.btrim(F.col("text"), F.lit(SPACES))
    step = texts(docs, "lang", "source").select(
        "doc_id",
        "lang",
        "source",
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP)).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("lines"),
        _count(F.col("text"), SYMBOL).alias("n_symbols"),
        _count(F.col("text"), MARK).alias("n_marks"),
    )
    keep = ["doc_id", "lang", "source", "n_symbols", "n_marks"]
    step = step.select(
        *keep,
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.size("words") < 4, F.array().cast("array<bigint>"))
        .otherwise(
            F.transform(
                F.sequence(F.lit(0), F.size("words") - 3),
                lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
            )
        )
        .alias("windows"),
    )
    keep += ["n_words", "word_chars", "n_lines", "n_dup_lines"]
    # Most texts have no window twice; only the others are sorted.
    step = step.select(
        *keep,
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        )
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
        .alias("ordered"),
    )
    same = lambda j, x: F.coalesce(F.get("ordered", j)["h"] == x["h"], F.lit(False))
    twice = F.filter("ordered", lambda x, j: same(j - 1, x) | same(j + 1, x))
    step = step.select(*keep, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("starts"))
    new = F.transform("starts", lambda at, j: F.least(F.lit(3), F.coalesce(F.get("starts", j + 1) - at, F.lit(3))))
    return step.select(*keep, F.aggregate(new, F.lit(0), lambda total, x: total + x).alias("n_repeat_words"))


def _measures() -> dict[str, Column]:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "marks_per_word": F.col("n_marks") / words,
        "duplicate_line_share": F.col("n_dup_lines") / lines,
        "repeat_word_share": F.col("n_repeat_words") / words,
        "chars_per_word": F.col("word_chars") / words,
    }


def group_fences(counts: DataFrame) -> DataFrame:
    """`lang`, `source` and the fences `low_<measure>`, `high_<measure>` of each group that occurs."""
    sketches = [F.kll_sketch_agg_double(column.cast("double"), F.lit(SKETCH_K)).alias(name) for name, column in _measures().items()]
    groups = counts.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *sketches)
    merged = [F.kll_merge_agg_double(name, F.lit(SKETCH_K)).alias(name) for name in MEASURES]
    by_lang = groups.groupBy("lang").agg(F.sum("n").alias("n"), *merged)
    overall = by_lang.withColumn("level", F.col("n") * 0).groupBy("level").agg(*merged)

    def prefixed(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*(F.col(c).alias(prefix + c) for c in df.columns))

    joined = groups.join(prefixed(by_lang, "lang_"), F.col("lang").eqNullSafe(F.col("lang_lang"))).join(prefixed(overall, "all_"), F.col("n") * 0 == F.col("all_level"))

    def quartile(name: str, q: float) -> Column:
        own, lang, overall = (F.kll_sketch_get_quantile_double(prefix + name, F.lit(q)) for prefix in ("", "lang_", "all_"))
        lang = (F.col("lang_n") * lang + PRIOR * overall) / (F.col("lang_n") + PRIOR)
        return (F.col("n") * own + PRIOR * lang) / (F.col("n") + PRIOR)

    def fences(name: str) -> list[Column]:
        floor, both = MEASURES[name]
        q1, q3 = quartile(name, 0.25), quartile(name, 0.75)
        reach = F.greatest(F.lit(floor), F.lit(FENCE_WIDTH) * (q3 - q1))
        low = q1 - reach if both else F.lit(None).cast("double")
        return [low.alias(f"low_{name}"), (q3 + reach).alias(f"high_{name}")]

    return joined.select("lang", "source", *(f for name in MEASURES for f in fences(name)))


def judged(docs: DataFrame) -> DataFrame:
    """The counts, `base_failed` and `kept` of each row of `docs`."""
    counts = written(word_counts(docs), "word-counts")
    fences = group_fences(counts).withColumnsRenamed({"lang": "fence_lang", "source": "fence_source"})
    joined = counts.join(fences, F.col("lang").eqNullSafe(F.col("fence_lang")) & F.col("source").eqNullSafe(F.col("fence_source")), "left")
    inside = F.lit(True)
    for name, column in _measures().items():
        inside &= column <= F.col(f"high_{name}")
        if MEASURES[name][1]:
            inside &= column >= F.col(f"low_{name}")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words").cast("long") > MAX_REPEAT_PERCENT * F.col("n_words").cast("long"))
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return joined.select(
        "doc_id", "lang", "source", *(F.col(c).cast("long").alias(c) for c in longs), failed.alias("base_failed"), (~failed & F.coalesce(inside, F.lit(False))).alias("kept")
    )
