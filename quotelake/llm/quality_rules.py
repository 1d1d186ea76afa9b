"""Quality rules whose cutoffs adapt to each language and source.  [native: built-in functions only]

Every document gets rule counts from its whole text:

* ``n_words``: words, maximal runs of characters outside ``[\\x20\\x09-\\x0D]``; a null text has none;
* ``word_chars``: code points inside words;
* ``n_symbols``: characters of ``[#*$%&|<>]``;
* ``n_dup_lines``: lines (split at ``\\n``) holding a word that equal an earlier such line of the text;
* ``n_repeat_words``: word places covered by a 3-word window that occurs twice or more in the text
  (its first occurrence included).

A document fails the fixed base rules (``base_failed``) with fewer than 50 words or when repeated
windows cover more than half of its words. The method then replaces fixed cutoffs on four ratios
(symbols, duplicate lines and repeated words a word, mean word length) by cutoffs read from
mergeable quantile sketches (``percentile_approx``, merged map side before the shuffle) of the
documents that pass the base rules, per (lang, source): the upper cutoff is ``q3 + FENCE * (q3 - q1)
+ SLACK``, the lower one of the word length ``q1 - FENCE * (q3 - q1) - SLACK``. A (lang, source)
with fewer than ``MIN_GROUP`` passing documents takes its language's sketch, a language with too
few the sketch of all documents; the three levels come out of one rollup. The cutoffs are joined
back: broadcast while their rows are at most ``BROADCAST_GROUPS``, else by a join salted over
``SALTS`` cells so that a (lang, source) holding a third of all rows spreads over many tasks.
``kept`` is false if ``base_failed``, else true when every ratio lies within its cutoffs.

Defined cases: a null or empty text has no words and fails the base rules; null lang or source is a
group of its own; repeated rows and ids are scored row by row; an empty table gives no rows; input
columns named like a result column are replaced by it; every other input column is carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import SPACE, stored

# Fixed values of the rules (they must equal the dealt contract).
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
REPEAT_WINDOW = 3
MAX_REPEAT_PERCENT = 50

#: Tukey's far-out fence, the quartiles it spans, and the sketch's accuracy.
FENCE = 3.0
QUARTILES = (0.25, 0.75)
ACCURACY = 10_000
#: Passing documents a group needs before its own sketch sets its cutoffs.
MIN_GROUP = 30
#: Absolute tolerance added to each cutoff: the customary fixed cutoffs, which hold where a group's
#: quartiles are all equal (most groups have no symbols and no duplicate lines at all).
SLACK = {"symbol_ratio": 0.1, "dup_line_ratio": 0.3, "repeat_ratio": 0.2, "word_length": 2.0}
#: Rows of cutoffs that may be broadcast; beyond it a salted join.
BROADCAST_GROUPS = 500_000
SALTS = 64

RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _fresh(df: DataFrame, base: str) -> str:
    name = base
    while name in df.columns:
        name = "_" + name
    return name


def _with_counts(df: DataFrame, text: Column, into: str) -> DataFrame:
    """``df`` with a struct ``into`` of the base counts of ``text``, from built-in array functions.

    Every array a lambda reads is a column of its own first: an expression named inside a lambda
    would be evaluated again for every element.
    """
    words, wins, lines = into + "_w", into + "_g", into + "_l"
    step = (
        df.withColumn(words, F.filter(F.split(text, f"{SPACE}+"), lambda w: w != ""))
        .withColumn(lines, F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    )
    n = F.size(F.col(words))
    # windows as (text, start), sorted so that equal windows are neighbours
    step = step.withColumn(
        wins,
        F.array_sort(
            F.transform(
                F.when(n >= REPEAT_WINDOW, F.sequence(F.lit(0), n - REPEAT_WINDOW)).otherwise(F.array().cast("array<int>")),
                lambda i: F.struct(F.array_join(F.slice(F.col(words), i + 1, REPEAT_WINDOW), " ").alias("g"), i.alias("i")),
            )
        ),
    )
    g = F.col(wins)
    m = F.size(g)
    repeated = F.filter(
        F.transform(
            g,
            lambda x, k: F.struct(
                x["i"].alias("i"),
                (F.when(k > 0, F.element_at(g, k)["g"] == x["g"]).otherwise(F.lit(False))
                 | F.when(k + 1 < m, F.element_at(g, k + 2)["g"] == x["g"]).otherwise(F.lit(False))).alias("r"),
            ),
        ),
        lambda y: y["r"],
    )
    covered = F.array_distinct(
        F.flatten(F.transform(repeated, lambda y: F.sequence(y["i"], y["i"] + REPEAT_WINDOW - 1)))
    )
    return step.withColumn(
        into,
        F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(F.col(lines)) - F.size(F.array_distinct(F.col(lines)))).cast("long").alias("n_dup_lines"),
            F.size(F.col(lines)).cast("long").alias("n_lines"),
            F.size(covered).cast("long").alias("n_repeat_words"),
        ),
    ).drop(words, wins, lines)


def rule_counts(docs: DataFrame, text: str = "text", into: str = "rules") -> DataFrame:
    """``docs`` with a struct column ``into`` of the base counts, ratios and ``base_failed``."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    tmp = _fresh(docs, "__counts")
    c = F.col(tmp)
    n = c["n_words"]
    return _with_counts(docs, body, tmp).withColumn(
        into,
        F.struct(
            *(c[name].alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
            ((n < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * n)).alias("base_failed"),
            F.try_divide(c["n_symbols"].cast("double"), n).alias("symbol_ratio"),
            F.try_divide(c["n_dup_lines"].cast("double"), c["n_lines"]).alias("dup_line_ratio"),
            F.try_divide(c["n_repeat_words"].cast("double"), n).alias("repeat_ratio"),
            F.try_divide(c["word_chars"].cast("double"), n).alias("word_length"),
        ),
    ).drop(tmp)


RATIOS = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "word_length")


def _cutoffs(rules: DataFrame, lang: str, source: str, r: str) -> DataFrame:
    """One row per (lang, source) present: its cutoffs, from its own, its language's or all sketches."""
    passing = ~F.col(r)["base_failed"]
    sketches = [
        F.percentile_approx(F.when(passing, F.col(r)[ratio]), list(QUARTILES), ACCURACY).alias(ratio)
        for ratio in RATIOS
    ]
    levels = (
        rules.rollup(F.col(lang).alias("g_lang"), F.col(source).alias("g_source"))
        .agg(F.grouping_id().alias("level"), F.count(F.when(passing, 1)).alias("n_pass"), *sketches)
    )

    def bounds(prefix: str) -> list[Column]:
        out = [F.col("n_pass").alias(f"{prefix}n")]
        for ratio in RATIOS:
            q1, q3 = F.col(ratio)[0], F.col(ratio)[1]
            out.append((q3 + F.lit(FENCE) * (q3 - q1) + F.lit(SLACK[ratio])).alias(f"{prefix}hi_{ratio}"))
            out.append((q1 - F.lit(FENCE) * (q3 - q1) - F.lit(SLACK[ratio])).alias(f"{prefix}lo_{ratio}"))
        return out

    own = levels.where("level = 0").select("g_lang", "g_source", *bounds("a_"))
    by_lang = levels.where("level = 1").select(F.col("g_lang").alias("l_lang"), *bounds("b_"))
    everything = levels.where("level = 3").select(F.lit(0).alias("k_all"), *bounds("c_"))
    joined = (
        own.join(by_lang, own["g_lang"].eqNullSafe(by_lang["l_lang"]), "left")
        .withColumn("k_all", F.lit(0))
        .join(everything, "k_all", "left")
    )

    def pick(kind: str, ratio: str) -> Column:
        return (
            F.when(F.col("a_n") >= MIN_GROUP, F.col(f"a_{kind}_{ratio}"))
            .when(F.col("b_n") >= MIN_GROUP, F.col(f"b_{kind}_{ratio}"))
            .otherwise(F.col(f"c_{kind}_{ratio}"))
        )

    level = F.when(F.col("a_n") >= MIN_GROUP, "source").when(F.col("b_n") >= MIN_GROUP, "lang").otherwise("all")
    return joined.select(
        "g_lang", "g_source", level.alias("cutoff_level"),
        *(pick("hi", ratio).alias(f"hi_{ratio}") for ratio in RATIOS),
        pick("lo", "word_length").alias("lo_word_length"),
    )


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Every row of ``docs`` with the base counts, ``base_failed``, ``kept`` and ``cutoff_level``.

    The rule counts are stored once in the shared folder, so the sketches and the join read them
    instead of splitting every text twice.
    """
    r = _fresh(docs, "__rules")
    salt = _fresh(docs, "__salt")
    key_lang, key_source = _fresh(docs, "__lang"), _fresh(docs, "__source")
    counted = stored(
        rule_counts(docs, text, r)
        .withColumn(key_lang, F.col(lang).cast("string"))
        .withColumn(key_source, F.col(source).cast("string")),
        "quality-rules",
    )
    cutoffs = stored(_cutoffs(counted, key_lang, key_source, r), "quality-cutoffs")
    on_lang = F.col(key_lang).eqNullSafe(F.col("g_lang"))
    on_source = F.col(key_source).eqNullSafe(F.col("g_source"))
    if cutoffs.count() <= BROADCAST_GROUPS:
        joined = counted.join(F.broadcast(cutoffs), on_lang & on_source, "left")
    else:
        salted = cutoffs.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        mine = counted.withColumn(salt, F.pmod(F.xxhash64(F.col(r), F.monotonically_increasing_id()), F.lit(SALTS)))
        joined = mine.join(salted, on_lang & on_source & (mine[salt] == salted[salt]), "left").drop(salted[salt]).drop(salt)
    q = F.col(r)
    within = (
        (q["symbol_ratio"] <= F.col("hi_symbol_ratio"))
        & (q["dup_line_ratio"] <= F.col("hi_dup_line_ratio"))
        & (q["repeat_ratio"] <= F.col("hi_repeat_ratio"))
        & (q["word_length"] <= F.col("hi_word_length"))
        & (q["word_length"] >= F.col("lo_word_length"))
    )
    keep_inputs = [F.col(f"`{c}`") for c in docs.columns if c not in RESULTS and c != "cutoff_level"]
    return joined.select(
        *keep_inputs,
        *(q[name].alias(name) for name in RESULTS[:5]),
        q["base_failed"].alias("base_failed"),
        (~q["base_failed"] & F.coalesce(within, F.lit(False))).alias("kept"),
        "cutoff_level",
    )
