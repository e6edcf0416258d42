"""Quality rules as a bitmask ledger (built-in functions only).

``ledger`` evaluates every rule once per document and stores the measurements
and one long, ``fail_bits``, with a bit for each failed rule. A policy is a
named, versioned set of rules, that is, a mask: ``apply_policy`` compares the
stored bits with the mask and never looks at the text again. ``ablation``
groups the ledger by its bits (at most 2**rules groups, counted before the
shuffle) and derives from these counts, for each policy and rule, how many
documents fail the rule, fail only that rule, and would be kept without it.

Defined results: a null text has no words; an empty text fails the length
rule; repeated rows are judged each on its own; an empty table gives an empty
ledger. Columns of the input whose names clash with the ledger's are replaced
by the ledger's; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\u000b\f\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

# Every rule: its name and the condition under which a document fails it, in
# whole numbers. The bit of a rule is its place in this list; new rules are
# appended, so that stored ledgers keep their meaning.
RULES: list[tuple[str, str]] = [
    ("too_short", "n_words < 50"),
    ("repeated_phrases", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("short_words", "word_chars < 3 * n_words"),
    ("long_words", "word_chars > 10 * n_words"),
    ("few_lines_long", "n_lines <= 1 and n_words > 2000"),
]
BASE = ("too_short", "repeated_phrases")
# Versioned policies. A rule outside a policy is still in the ledger.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": BASE,
    "web-1": BASE + ("symbols", "duplicate_lines"),
    "web-2": BASE + ("symbols", "duplicate_lines", "short_words", "long_words"),
}
DEFAULT_POLICY = "web-2"


def mask(rules) -> int:
    """The bits of the named rules."""
    place = {name: i for i, (name, _) in enumerate(RULES)}
    return sum({1 << place[r] for r in rules})


def _repeat_words() -> Column:
    """Words inside 3-word windows that occur at least twice, counted once each.

    ``grams`` holds a 64-bit hash per window. Only where two of them are equal
    are they sorted with their places; the places of equal neighbours, sorted,
    each cover three words less what the next one covers."""
    st = F.col("_sorted")
    twin = F.filter(st, lambda x, i: (x["h"] == F.get(st, i - 1)["h"]) | (x["h"] == F.get(st, i + 1)["h"]))
    return F.sort_array(F.transform(twin, lambda x: x["i"]))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements (long) to every row; whole texts, one pass, no shuffle."""
    t = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(t, F.lit(WHITE))
    words = F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    out = docs.drop(*MEASURES).withColumns({"_words": words, "_lines": lines})
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]", ""))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_hashes": F.transform("_words", lambda x: F.xxhash64(x)),
    }).drop("_words", "_lines")
    h = F.col("_hashes")
    out = out.withColumn("_grams", F.when(F.size(h) >= 3, F.transform(
        F.slice(h, 3, F.greatest(F.size(h) - 2, F.lit(1))), lambda x, i: F.xxhash64(F.get(h, i), F.get(h, i + 1), x))))
    g = F.col("_grams")
    out = out.withColumn("_sorted", F.when(
        F.size(F.array_distinct(g)) < F.size(g),
        F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop("_hashes", "_grams")
    out = out.withColumn("_places", _repeat_words()).drop("_sorted")
    p = F.col("_places")
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_places")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measurements and ``fail_bits`` of every row; other columns pass through."""
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measure(docs.drop("fail_bits"), text).withColumn("fail_bits", bits)


def apply_policy(led: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Add ``base_failed``, ``kept`` and ``policy`` from the stored bits alone."""
    fails = lambda names: F.col("fail_bits").bitwiseAND(F.lit(mask(names))) != 0
    return led.withColumns({"base_failed": fails(BASE), "kept": ~fails((*BASE, *POLICIES[policy])),
                            "policy": F.lit(policy)})


def keep(docs: DataFrame, text: str = "text", policy: str = DEFAULT_POLICY) -> DataFrame:
    """The input's rows that the policy keeps.

    The optimiser moves a filter below the columns that it reads by repeating
    their expressions in it; with measurements built on measurements, that copy
    is far larger than the plan. A column of random numbers, which a filter
    can't pass, holds it above them."""
    led = apply_policy(ledger(docs, text), policy).withColumn("_guard", F.rand())
    return led.where(F.col("kept") & (F.col("_guard") >= 0)).select(*docs.columns)


def ablation(led: DataFrame, policies: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Per policy and rule: n_docs, n_failed, n_only (documents that only this
    rule of the policy rejects, so that it alone decides) and n_kept_without."""
    policies = POLICIES if policies is None else policies
    asked = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"),
                               F.lit(mask([r])).cast("long").alias("rule_bit"),
                               F.lit(mask(rs)).cast("long").alias("policy_mask"))
                      for p, rs in policies.items() for r in rs])
    groups = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    cell = groups.select("fail_bits", "n", F.inline(asked))  # at most 2**len(RULES) groups
    hit = F.col("fail_bits").bitwiseAND(F.col("policy_mask"))
    one = F.col("rule_bit")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    return cell.groupBy("policy", "rule").agg(
        F.sum("n").cast("long").alias("n_docs"), total(hit.bitwiseAND(one) != 0).alias("n_failed"),
        total(hit == one).alias("n_only"), total((hit == 0) | (hit == one)).alias("n_kept_without"))
