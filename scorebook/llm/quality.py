"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and one failure bit per rule.
Policies are versioned sets of rules, applied to stored ledgers without reading a text again, and ablations are
computed from the bits alone. All of it is column expressions: no Python runs over rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorebook.llm.common import WORD, let, whole, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shouts")

#: Rules by bit. A measurement that cannot be taken (no words) counts as zero.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "upper_case": "100 * n_upper > 30 * word_chars",
    "shouting": "10 * n_shouts > n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "long_words": "word_chars > 20 * n_words",
}

#: Rules that reject, by version of the policy.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return reduce(lambda bits, rule: bits | bit(rule), POLICIES[policy], 0)


def _covered(p: Column) -> Column:
    """Words inside windows of three words that begin at the sorted positions ``p``."""
    return F.when(F.size(p) == 0, F.lit(0).cast("long")).otherwise(
        F.aggregate(
            F.sequence(F.lit(0), F.size(p) - 1),
            F.lit(0).cast("long"),
            lambda done, j: done + F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - F.get(p, j), F.lit(3))),
        )
    )


def _positions(k: Column) -> Column:
    """Sorted positions of the keys that occur twice or more, by sorting keys with their positions."""
    pairs = F.sort_array(F.transform(k, lambda x, i: F.struct(x.alias("k"), i.alias("i"))))
    key = lambda s, j: F.get(s, j)["k"]
    equal = lambda s: F.filter(
        F.sequence(F.lit(0), F.size(s) - 1), lambda j: (key(s, j) == key(s, j + 1)) | (key(s, j) == key(s, j - 1))
    )
    return let(pairs, lambda s: F.sort_array(F.transform(equal(s), lambda j: F.get(s, j)["i"])))


def _repeated(tokens: Column) -> Column:
    """Words inside windows of three words that the text holds twice or more, the first included.

    Windows are compared by 64-bit hashes; a text without repeated windows, the usual case, is not sorted.
    """
    none = F.lit(0).cast("long")
    keys = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2))
    )
    found = lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), none).otherwise(let(_positions(k), _covered))
    hashed = lambda h: F.when(F.size(h) < 3, none).otherwise(let(keys(h), found))
    return let(F.transform(tokens, lambda w: F.xxhash64(w)), hashed)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of measurements per document, from its whole text.

    A null text has no words and no lines. Other columns of ``docs`` are not read, so their names do not matter;
    rows repeat as they come, a null id is kept.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    split = base.select("doc_id", "text", words(F.col("text")).alias("w"))
    lines = F.filter(F.split(F.col("text"), "\n", -1), lambda line: line.rlike(WORD))
    count = lambda pattern: F.length(F.regexp_replace("text", f"[^{pattern}]+", "")).cast("long")
    return split.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        count("#*$%&|<>").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d"))).alias("lines"),
        _repeated(F.col("w")).alias("n_repeat_words"),
        count("A-Z").alias("n_upper"),
        count("!").alias("n_shouts"),
    ).select(
        "doc_id", "n_words", "word_chars", "n_symbols", F.col("lines.d").alias("n_dup_lines"), "n_repeat_words",
        F.col("lines.n").alias("n_lines"), "n_upper", "n_shouts",
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``failed``, whose bit i is set if rule i of ``RULES`` fails."""
    bits = reduce(lambda a, b: a.bitwiseOR(b), (F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())))
    return measure(docs, id_col, text_col).withColumn("failed", bits.cast("int"))


def apply_policy(stored: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Add ``kept``: no rule of the policy failed. An unknown policy raises ``KeyError``."""
    return stored.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0)


def ablations(stored: DataFrame, policies: Mapping[str, tuple[str, ...]] | None = None) -> DataFrame:
    """What each rule of each policy does: one row per policy and rule.

    ``failing`` documents fail the rule, ``alone`` fail no other rule of the policy (they come back without it),
    ``kept`` pass the policy, ``kept_without`` pass it without the rule; ``together`` has the bits of all rules that
    fail together with this one somewhere. Documents are first counted by their bits, at most 2^rules rows.
    """
    counted = stored.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    out = []
    for name, rules in (policies or POLICIES).items():
        full = reduce(lambda bits, rule: bits | bit(rule), rules, 0)
        hits = F.col("failed").bitwiseAND(F.lit(full))
        for rule in rules:
            one = bit(rule)
            failing = F.col("failed").bitwiseAND(F.lit(one)) != 0
            total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).alias
            out.append(
                counted.agg(
                    total(failing)("failing"),
                    total(hits == one)("alone"),
                    total(hits == 0)("kept"),
                    total(hits.bitwiseAND(F.lit(full & ~one)) == 0)("kept_without"),
                    F.coalesce(F.bit_or(F.when(failing, hits)), F.lit(0)).alias("together"),
                ).select(F.lit(name).alias("policy"), F.lit(rule).alias("rule"), "failing", "alone", "kept", "kept_without", "together")
            )
    return reduce(DataFrame.unionByName, out)


def keep_good(docs: DataFrame, policy: str = CURRENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that pass the policy, all columns as they are; the texts do not move.

    The verdict of a row is computed from its own text inside the scan, so repeated ids are judged row by row.
    """
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"))
    judged = ledger(row.select(F.col("row").alias("doc_id"), F.col(f"row.`{text_col}`").alias("text")))
    kept = apply_policy(judged, policy).filter("kept")
    return kept.select(*[F.col(f"doc_id.`{name}`").alias(name) for name in names])
