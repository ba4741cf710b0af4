"""Document quality rules whose thresholds come from the corpus, per language and source.

Every document is measured with built-in functions. A few limits hold for all (``base_failed``: too few
words, or too many in repeated windows). Beyond them a document is rejected when a measure lies far
outside of what is usual for its language and source: above the upper quartile by more than
``SPREAD`` times the distance between the quartiles, or, for some measures, as far below the lower one.

Quartiles are read from quantile sketches: counts of values in buckets whose edges grow by a fixed
factor, so a quantile is right to within ``STEP``. Such a sketch is a small table of counts; it is
built by a grouped count, two of them are merged by adding up, and nothing in it is left to chance, so
the same rows always give the same thresholds. A source with a third of all documents is combined
before it is shuffled like any other. The limits of a (language, source) are moved towards those of the
language, and these towards those of the corpus, as ``PRIOR_ROWS`` documents would, so that a small
group follows the larger ones. Where all of a group are alike, a least distance
between the quartiles keeps ordinary documents from being rejected for a trifle.

Defined results: a null text has no words and fails; a null language or source is a group of its
own; repeated rows count as often as they occur; a measure equal to a limit is within it; an empty
table gives no rows; columns other than those named are passed over. Texts are measured whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.sources.sinks import materialise

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SPREAD = 6.0
#: Documents that the limits of the larger group count for.
PRIOR_ROWS = 20
#: Relative width of a bucket of the sketches.
STEP = 0.002
#: Bucket of the value 0.
ZERO = -(2**31)
#: Rows of thresholds (about 100 bytes each) up to which they are sent to all tasks.
BROADCAST_ROWS = 20_000
#: Measures, whether they are judged below as well, and the least distance of quartiles taken.
MEASURES = {"symbol_share": (False, 0.005), "repeat_share": (False, 0.05),
            "line_share": (False, 0.07), "shout_share": (False, 0.01),
            "letter_share": (True, 0.015), "word_length": (True, 0.05)}
QUARTILES = {"q1": 0.25, "q3": 0.75}


def _removed(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated_words(hashes: Column) -> Column:
    """Words in 3-word windows that occur twice or more, from the hashes of the windows."""
    ordered = F.array_sort(F.transform(
        hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        def alike(x: Column, j: Column) -> Column:
            return F.coalesce((x["h"] == F.get(s, j - 1)["h"]) & (j > 0), F.lit(False)) | \
                F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, alike), lambda x: x["i"]))

    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("words"))
    # The array is bound to a name once: an expression is evaluated wherever it stands.
    kept = F.transform(F.array(ordered), places)[0]
    return F.aggregate(kept, start, lambda s, p: F.struct(
        p.alias("last"), (s["words"] + F.least(F.lit(3), p - s["last"])).alias("words")),
        lambda s: s["words"])


def measures(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Counts of every document beside ``lang``, ``source`` and a struct ``row`` of other columns."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, f"[{SPACE}]+", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: _removed(x, SPACE) != "")
    split = docs.select(
        F.struct(*carried).alias("row"), F.col("lang"), F.col("source"), text.alias("text"),
        words.alias("words"),
        lines.alias("lines"))
    three = F.when(F.size("words") >= 3, F.transform(
        F.slice("words", F.lit(1), F.size("words") - 2),
        lambda w, i: F.xxhash64(w, F.get(F.col("words"), i + 1), F.get(F.col("words"), i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = split.withColumn("windows", three)
    repeated = F.when(F.size("windows") == F.size(F.array_distinct("windows")),
                      F.lit(0).cast("long")).otherwise(_repeated_words(F.col("windows")))
    letters = _removed(F.col("text"), SPACE)
    return hashed.select(
        "row", "lang", "source", F.size("words").cast("long").alias("n_words"),
        F.length(letters).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_removed(F.col("text"), SYMBOLS))).cast("long")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace(letters, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(letters, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
    )


def _shares(measured: DataFrame) -> DataFrame:
    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))
    return (measured.withColumn("symbol_share", share("n_symbols", "word_chars"))
            .withColumn("repeat_share", share("n_repeat_words", "n_words"))
            .withColumn("line_share", share("n_dup_lines", "n_lines"))
            .withColumn("shout_share", share("n_upper", "word_chars"))
            .withColumn("letter_share", share("n_letters", "word_chars"))
            .withColumn("word_length", share("word_chars", "n_words")))


def sketches(shared: DataFrame) -> DataFrame:
    """Mergeable sketches: (lang, source, measure, bucket, n)."""
    def bucket(name: str) -> Column:
        log = F.ceil(F.log(F.col(name)) / F.log(F.lit(1 + STEP))).cast("int")
        return F.when(F.col(name) > 0, log).otherwise(ZERO)

    values = F.array(*[F.struct(F.lit(n).alias("measure"), bucket(n).alias("bucket"))
                       for n in MEASURES])
    return shared.select("lang", "source", F.inline(values)).groupBy(
        "lang", "source", "measure", "bucket").agg(F.count("*").alias("n"))


def merged(found: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of larger groups."""
    return found.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, rows, q1, q3) read from sketches; a group has a few thousand buckets at most."""
    group = Window.partitionBy(*keys, "measure")
    ordered = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = found.withColumn("below", F.sum("n").over(ordered)).withColumn(
        "rows", F.sum("n").over(group))
    value = F.when(F.col("bucket") == ZERO, 0.0).otherwise(
        F.pow(F.lit(1 + STEP), F.col("bucket") - 0.5))
    return counted.withColumn("value", value).groupBy(*keys, "measure").agg(
        F.max("rows").alias("rows"),
        *[F.min(F.when(F.col("below") >= part * F.col("rows"), F.col("value"))).alias(q)
          for q, part in QUARTILES.items()])


def _limits(found: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    """(keys, measure, rows, least, most) with a suffix."""
    room = F.lit(None).cast("double")
    for name, (_, least) in MEASURES.items():
        room = F.when(F.col("measure") == name, SPREAD * F.greatest(
            F.lit(least), F.col("q3") - F.col("q1"))).otherwise(room)
    return quartiles(found, keys).withColumn("room", room).select(
        *[F.col(k).alias(f"{k}{suffix}") for k in keys], F.col("measure").alias(f"measure{suffix}"),
        F.col("rows").alias(f"rows{suffix}"), (F.col("q1") - F.col("room")).alias(f"least{suffix}"),
        (F.col("q3") + F.col("room")).alias(f"most{suffix}"))


def thresholds(found: DataFrame) -> DataFrame:
    """One row for each (lang, source) with the limits that hold for it."""
    own = _limits(found, ["lang", "source"], "_own")
    language = _limits(merged(found, ["lang"]), ["lang"], "_lang")
    corpus = _limits(merged(found, []), [], "_all")  # a row for each measure
    same = (F.col("lang_own").eqNullSafe(F.col("lang_lang"))
            & (F.col("measure_own") == F.col("measure_lang")))
    both = own.join(language, same).join(
        F.broadcast(corpus), F.col("measure_own") == F.col("measure_all"))

    def moved(side: str) -> Column:
        def towards(rows: str, value: Column, other: Column) -> Column:
            return (F.col(rows) * value + PRIOR_ROWS * other) / (F.col(rows) + PRIOR_ROWS)

        of_language = towards("rows_lang", F.col(f"{side}_lang"), F.col(f"{side}_all"))
        return towards("rows_own", F.col(f"{side}_own"), of_language)

    each = both.select("lang_own", "source_own", "measure_own", moved("least").alias("least"),
                       moved("most").alias("most"))
    columns = [F.max(F.when(F.col("measure_own") == n, F.col(side))).alias(f"{n}_{side}")
               for n in MEASURES for side in ("least", "most")]
    return each.groupBy("lang_own", "source_own").agg(*columns).withColumnsRenamed(
        {"lang_own": "of_lang", "source_own": "of_source"})


def judged(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every row, and the carried columns in ``row``."""
    measured = materialise(_shares(measures(docs, carried)), "measures")
    found = materialise(sketches(measured), "sketches")
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))
    limits = materialise(thresholds(found), "thresholds")
    # Sent to all tasks only after its rows are counted; else rows and limits meet in a shuffle,
    # where a hot source can be split.
    if limits.count() <= BROADCAST_ROWS:
        limits = F.broadcast(limits)
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("of_lang"))
                           & F.col("source").eqNullSafe(F.col("of_source")), "left")
    usual = F.lit(True)
    for name, (both_sides, _) in MEASURES.items():
        usual = usual & (F.col(name) <= F.col(f"{name}_most"))
        if both_sides:
            usual = usual & (F.col(name) >= F.col(f"{name}_least"))
    return joined.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & usual)


def digest(found: DataFrame) -> DataFrame:
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return judged(docs, docs.columns).where("kept").select("row.*")
