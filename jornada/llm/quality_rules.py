"""Quality rules as a bitmask ledger (DataFrame expressions only).

Every rule is evaluated once per document. The ledger keeps the measurements and
one failure bit per rule; a policy is a versioned mask over those bits, so a policy
change or an ablation never reads the texts again.

Defined cases: a null text counts as empty (all measurements 0, ``few_words``
fails); repeated rows are measured each on their own; extra columns are kept by
:func:`ledger` and ignored by the measurements; an empty table gives an empty
ledger. Texts of any length are measured whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SEPARATOR


@dataclass(frozen=True)
class Rule:
    """A failure condition, as SQL over the ledger's measurements."""

    name: str
    fails: str


# Bit i of fail_bits belongs to RULES[i]. New rules go to the end: stored bits keep
# their meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeat_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("upper_case", "100 * n_upper > 30 * word_chars"),
    Rule("dup_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
)
BASE_RULES = ("few_words", "repeat_words")

#: Policies by version: the rules that reject a document.
POLICIES = {
    "base": BASE_RULES,
    "v1": BASE_RULES + ("symbols",),
    "v2": tuple(r.name for r in RULES),
}
CURRENT = "v2"
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                "n_repeat_words", "n_upper")


def mask(rules) -> int:
    """Bits of the named rules."""
    names = [r.name for r in RULES]
    out = 0
    for rule in rules:
        out |= 1 << names.index(rule)
    return out


def _shift(array: Column, by: int) -> Column:
    """The array without its first ``by`` entries."""
    return F.slice(array, by + 1, F.greatest(F.size(array) - by, F.lit(0)))


def _covered(windows: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    ``windows`` holds (hash, position). Sorted, equal windows are neighbours; their
    positions, sorted again, cover min(3, distance to the previous one) new words.
    """
    ordered = F.sort_array(windows)
    none = F.array(F.lit(None).cast("struct<k:bigint,p:int>"))

    def repeated(s: Column) -> Column:
        marked = F.zip_with(s, F.concat(none, s), lambda own, before: F.struct(
            own["k"].alias("k"), own["p"].alias("p"), (own["k"] == before["k"]).alias("again")))
        hit = F.zip_with(marked, _shift(s, 1), lambda own, after: F.when(
            own["again"] | (own["k"] == after["k"]), own["p"]))
        return F.sort_array(F.filter(hit, lambda p: p.isNotNull()))

    # transform over a one-entry array binds the sorted array once for its three uses.
    positions = F.transform(F.array(ordered), repeated)[0]
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        positions, start,
        lambda acc, p: F.struct(p.alias("last"),
                                (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
        lambda acc: acc["n"])


#: Columns that measure() makes for itself.
_TEMPORARY = ("_t", "_words", "_lines", "_hashes", "_windows")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements of MEASUREMENTS (long, never null)."""
    t = F.col("_t")
    words = F.col("_words")
    hashes = F.col("_hashes")
    lines = F.col("_lines")
    out = docs.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumns({
        "_words": F.filter(F.split(t, SEPARATOR), lambda w: w != ""),
        "_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    out = out.withColumn("_hashes", F.transform(words, lambda w: F.xxhash64(w)))
    pairs = F.zip_with(hashes, _shift(hashes, 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    triples = F.zip_with(pairs, _shift(hashes, 2), lambda ab, c: F.when(
        c.isNotNull(), F.xxhash64(ab["a"], ab["b"], c)))
    out = out.withColumn("_windows", F.filter(
        F.transform(triples, lambda k, i: F.struct(k.alias("k"), i.alias("p"))),
        lambda w: w["k"].isNotNull()))
    out = out.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _covered(F.col("_windows")),
        "n_upper": (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).cast("long"),
    })
    return out.drop(*_TEMPORARY)


def _fail_bits() -> Column:
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        bits = bits + F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return bits


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measurements and ``fail_bits`` (one bit per rule) of every document.

    Other columns are kept, but for those named like a measurement, ``fail_bits`` or a
    temporary of :func:`measure`; :func:`keep` returns rows with all of theirs.
    """
    taken = {c.lower() for c in (*MEASUREMENTS, "fail_bits", *_TEMPORARY)}
    own = [c for c in docs.columns if c.lower() not in taken]
    return measure(docs.select(*own), text).withColumn("fail_bits", _fail_bits())


def keep(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """The documents that a policy keeps, with their own columns whatever these are named."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return measure(rows).withColumn("fail_bits", _fail_bits()).where(~failed(version)).select("row.*")


def failed(version_or_rules) -> Column:
    """True where the policy (a version, or rule names) rejects the document."""
    rules = POLICIES[version_or_rules] if isinstance(version_or_rules, str) else version_or_rules
    return F.col("fail_bits").bitwiseAND(F.lit(mask(rules)).cast("long")) != 0


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """Add ``base_failed`` and ``kept`` under a policy version to a ledger."""
    return rows.withColumns({"base_failed": failed("base"), "kept": ~failed(version)})


def ablation(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents it fails, rejects alone, and kept without it.

    Documents are first counted per bit pattern (at most 2**rules rows), so every
    ablation is bit arithmetic on that small table.
    """
    m = mask(POLICIES[version])
    patterns = (rows.select(F.col("fail_bits").bitwiseAND(F.lit(m).cast("long")).alias("bits"))
                .groupBy("bits").agg(F.count(F.lit(1)).alias("n")))
    rules = F.explode(F.array(*(F.struct(F.lit(i).alias("bit"), F.lit(r.name).alias("rule"))
                                for i, r in enumerate(RULES) if m >> i & 1)))
    one = F.expr("shiftleft(1L, r.bit)")
    bits = F.col("bits")
    return (patterns.select("bits", "n", rules.alias("r"))
            .groupBy(F.col("r.rule").alias("rule"), F.lit(version).alias("policy"))
            .agg(F.sum(F.when(bits.bitwiseAND(one) != 0, F.col("n")).otherwise(0)).alias("fails"),
                 F.sum(F.when(bits == one, F.col("n")).otherwise(0)).alias("rejects_alone"),
                 F.sum(F.when(bits.bitwiseAND(F.bitwise_not(one)) == 0, F.col("n"))
                       .otherwise(0)).alias("kept_without")))
