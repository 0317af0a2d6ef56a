"""Quality rules as a ledger of failure bits, with policies and ablations on top.

Every rule is evaluated once per text.  The ledger keeps the measurements and
one long whose bit k says that rule k failed.  A policy is a named, versioned
set of rules: a text stays if it fails none of them, one AND on the mask.
Ablations need no second look at the texts: documents are counted per mask,
and bit arithmetic on the few masks tells what each rule does alone and what
would stay without it.

Everything is SQL functions on one row; a text is never exploded into rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.text import with_columns, words

SYMBOLS = r"[^#*$%&|<>]+"


def repeat_words(listed: Column) -> Column:
    """Words inside a window of three that occurs twice or more in the text, the first occurrence included.

    Windows are compared by 64-bit hash.  Sorting (hash, place) puts equal
    windows side by side; sorting the places of those gives runs to measure.
    """
    count = F.size(listed)
    hashes = F.transform(
        F.slice(listed, 1, F.greatest(count - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(listed, i + 1), F.get(listed, i + 2)),
    )
    return F.when(count < 4, F.lit(0).cast("long")).otherwise(_covered(hashes))


def _covered(hashes: Column) -> Column:
    def from_sorted(pairs: Column) -> Column:
        twins = F.filter(
            F.transform(
                pairs,
                lambda p, i: F.when(
                    (p["h"] == F.get(pairs, i - 1)["h"]) | (p["h"] == F.get(pairs, i + 1)["h"]), p["at"]
                ),
            ),
            lambda at: at.isNotNull(),
        )
        return held(F.sort_array(twins), lambda places: F.aggregate(
            F.transform(places, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - at, F.lit(3)))),
            F.lit(0).cast("long"),
            lambda n, step: n + step,
        ))

    def if_any(hashed: Column) -> Column:
        pairs = F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        # Most texts repeat no window: a distinct count spares them the sort of pairs.
        return F.when(F.size(F.array_distinct(hashed)) == F.size(hashed), F.lit(0).cast("long")).otherwise(held(F.sort_array(pairs), from_sorted))

    return held(hashes, if_any)


def held(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def measurements(text: Column) -> dict[str, Column]:
    """``n_words word_chars n_symbols n_dup_lines n_repeat_words`` of a text; NULL counts as empty.

    Needs a column ``words`` with the text's words.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size("words").cast("long"),
        "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace(whole, SYMBOLS, "")).cast("long"),
        "n_dup_lines": held(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(F.col("words")),
    }


#: Rule k sets bit k; a rule is a failure condition on the measurements.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "many_symbols": "5 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > n_words",
    "no_words": "n_words = 0",
}


@dataclass(frozen=True)
class Policy:
    """A named and versioned choice of rules."""

    name: str
    version: int
    rules: tuple[str, ...] = field(default_factory=tuple)

    def mask(self, rules: dict[str, str] = RULES) -> int:
        names = list(rules)
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STRICT = Policy("clean", 1, tuple(RULES))


def ledger(docs: DataFrame, *, text: str = "text", rules: dict[str, str] = RULES) -> DataFrame:
    """``docs`` with the measurements and ``failures``, the bits of the rules that failed.

    NULL, empty and blank texts measure zero everywhere.  Repeated rows stay;
    an input column named like an added one gives way.
    """
    listed = docs.select(with_columns(docs, {"words": words(F.col(f"`{text}`"))}))
    measured = listed.select(with_columns(listed, measurements(F.col(f"`{text}`")))).drop("words")
    bits = [F.when(F.expr(test), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, test in enumerate(rules.values())]
    whole = bits[0]
    for bit in bits[1:]:
        whole = whole.bitwiseOR(bit)
    return measured.select(with_columns(measured, {"failures": whole}))


def fails(policy: Policy, rules: dict[str, str] = RULES) -> Column:
    """Whether a ledger row fails a policy."""
    return F.col("failures").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) != 0


def verdicts(rows: DataFrame, policies: list[Policy], rules: dict[str, str] = RULES) -> DataFrame:
    """``rows`` with a column ``<name>_v<version>`` per policy: true if the text stays."""
    return rows.withColumns({f"{p.name}_v{p.version}": ~fails(p, rules) for p in policies})


def ablations(rows: DataFrame, policy: Policy, rules: dict[str, str] = RULES) -> DataFrame:
    """Per rule of a policy: ``failed``, ``failed_alone`` and ``kept_without``, besides ``kept`` and ``total``.

    One count per mask (2 to the number of rules at most), then bits.
    """
    mask = F.lit(policy.mask(rules)).cast("long")
    masks = rows.groupBy(F.col("failures").bitwiseAND(mask).alias("failures")).agg(F.count(F.lit(1)).alias("n"))
    names = list(rules)
    listed = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in policy.rules])
    each = masks.select("failures", "n", F.inline(listed))
    has = F.col("failures").bitwiseAND(F.col("bit")) != 0
    rest = F.col("failures").bitwiseAND(F.bitwise_not("bit"))
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).alias
    return each.groupBy("rule").agg(
        count(has)("failed"),
        count(has & (rest == 0))("failed_alone"),
        count(rest == 0)("kept_without"),
        count(F.col("failures") == 0)("kept"),
        F.sum("n").alias("total"),
    )
