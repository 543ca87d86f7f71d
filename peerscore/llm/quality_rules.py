"""Quality rules as a bitmask ledger; DataFrame functions only.

Every rule is evaluated once per document: the ledger stores the measurements and one bit per
failed rule. Policies are versioned masks over these bits, applied without reading texts again,
and ablations are sums over the few distinct bit patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
#: Words per window of the repetition rule.
WINDOW = 5

# Fixed order: a rule's bit is its place. A rule says when a document fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "many_symbols": "10 * n_symbols > 4 * n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "capitals": "2 * n_capitals > word_chars",
}
BASE = ("few_words", "repeated_words")
# Versions are never changed, only added.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "many_symbols", "repeated_lines", "short_words", "long_words", "capitals"),
}


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(x) for x in set(rules))


def _let(value: Column, use) -> Column:
    """use(value), where value is computed once, however often it is used inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words in windows that occur more than once; windows are compared by 64-bit hashes."""

    def covered(places: Column) -> Column:
        # windows at sorted places cover WINDOW words each, less what the next one covers too
        steps = F.zip_with(
            F.slice(places, 1, F.size(places) - 1), F.slice(places, 2, F.size(places) - 1),
            lambda a, b: F.least(b - a, F.lit(WINDOW)),
        )
        return F.aggregate(steps, F.lit(WINDOW), lambda total, x: total + x)

    def counted(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(pairs: Column) -> Column:
            same = F.zip_with(
                F.slice(pairs, 1, F.size(pairs) - 1), F.slice(pairs, 2, F.size(pairs) - 1),
                lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
            )
            return F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))

        repeated = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(repeated, _let(ordered, lambda x: _let(places(x), covered))).otherwise(F.lit(0))

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - F.lit(WINDOW)),
            lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(WINDOW))),
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    counted_windows = _let(hashes, lambda h: _let(windows(h), counted))
    return F.when(F.size(words) > WINDOW, counted_windows).otherwise(F.lit(0))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns, with the measurements that the rules read.

    n_words, word_chars (code points in words), n_symbols, n_lines, n_dup_lines (lines with a word
    that equal an earlier line), n_repeat_words (words in 5-word windows that occur twice or more),
    n_capitals (A-Z). Columns of these names in the input are replaced. Null or empty text: all 0.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    chars = F.char_length(whole)

    def without(letters: str) -> Column:
        return F.char_length(F.translate(whole, letters, ""))

    blanks = " \t\n\x0b\f\r"
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.translate(x, blanks, "")) > 0)
    words = F.filter(F.split(whole, BLANK), lambda x: x != "")
    made = {
        "n_words": F.element_at("__words", 1),
        "word_chars": without(blanks),
        "n_symbols": chars - without("#*$%&|<>"),
        "n_lines": F.size(F.split(whole, "\n")),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": F.element_at("__words", 2),
        "n_capitals": chars - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    }
    counted = docs.drop(*made).withColumn(
        "__words", _let(words, lambda w: F.array(F.size(w), _repeat_words(w)))
    )
    return counted.withColumns({k: v.cast("long") for k, v in made.items()}).drop("__words")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``measured`` with ``failed``: bit i is set if rule i of RULES fails. It replaces an input
    column of that name."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << i).cast("long")).otherwise(F.lit(0)))
    return measured(docs, text).withColumn("failed", bits)


def fails(rules: tuple[str, ...]) -> Column:
    """Whether a ledger row fails any of these rules."""
    return F.col("failed").bitwiseAND(F.lit(mask(rules)).cast("long")) != 0


def apply_policy(ledger: DataFrame, version: str = "v1") -> DataFrame:
    """Ledger rows with base_failed and kept, by a versioned policy."""
    return ledger.withColumns({
        "base_failed": fails(BASE), "kept": ~fails((*BASE, *POLICIES[version])),
    })


def ablations(ledger: DataFrame, version: str = "v1") -> DataFrame:
    """(rule, n_failed, n_only): rows that fail a rule, and that only this rule of the policy drops.

    Documents are counted by bit pattern first, so the sums run over 2 ** rules rows at most.
    """
    counts = ledger.groupBy("failed").agg(F.count("*").alias("n"))
    whole = F.lit(mask(POLICIES[version])).cast("long")
    rows = F.explode(F.array(*(
        F.struct(F.lit(name).alias("rule"), F.lit(mask((name,))).cast("long").alias("bit"))
        for name in POLICIES[version]
    )))
    each = counts.withColumn("r", rows).select("r.*", "failed", "n")
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failed").bitwiseAND(whole) == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
    )
