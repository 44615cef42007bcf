"""Quality rules (3): a rule ledger of failure bits and measurements, and policies over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.llm.common import WORD, let, words

SYMBOLS = r"[#*$%&|<>]"
#: A word in capitals has two upper-case letters or more and no lower-case letter.  Two patterns that each
#: pass a word once: one pattern for both would try every pair of places in a long word.
LOWER, TWO_UPPER = r"\p{Ll}", r"(?s)\p{Lu}.*\p{Lu}"

#: Rule name to its failing condition; the position of a rule is its bit.  New rules go to the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "capitals": "100 * n_capitals > 40 * n_words",
    "few_letters": "100 * n_letter_words < 70 * n_words",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
#: Versioned policies: the rules that reject under each.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "short_words", "long_words"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(policy: str) -> int:
    return sum(BITS[r] for r in POLICIES[policy])


def repeat_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the word array ``w``."""
    def windows(v):
        return F.transform(F.slice(v, 1, F.greatest(F.size(v) - 2, F.lit(0))),
                           lambda x, i: F.xxhash64(x, F.get(v, i + 1), F.get(v, i + 2)))

    def repeated(h):  # starts of repeated windows, by sorting (hash, start)
        def of(s):
            same = F.filter(s, lambda e, j: F.coalesce(e.h == F.get(s, j - 1).h, F.lit(False))
                            | F.coalesce(e.h == F.get(s, j + 1).h, F.lit(False)))
            return F.sort_array(F.transform(same, lambda e: e.p))
        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), of)

    def covered(p):  # each start covers itself and the two words after it
        return F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
                           F.lit(0), lambda acc, x: acc + x)

    return let(let(w, windows),
               lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
               .otherwise(let(repeated(h), covered))).cast("long")


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with measurements and ``failed``, the bits of the rules it fails.

    Every rule is evaluated once per row, without a shuffle; policies, verdicts and
    ablations only read the bits.  A null or empty text has no words (all measurements
    0) and fails ``few_words`` alone; rows that repeat are judged alike; other columns
    pass through, and a column with the name of a measurement is replaced.  Windows are compared
    by 64-bit hash within one text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    w, l = (next(n for n in (f"_{x}{i or ''}" for i in range(len(docs.columns) + 1)) if n not in docs.columns) for x in "wl")
    d = docs.withColumns({w: words(F.col("text")), l: lines})
    d = d.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.aggregate(w, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x)),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size(l).cast("long"),
        "n_dup_lines": (F.size(l) - F.size(F.array_distinct(l))).cast("long"),
        "n_repeat_words": repeat_words(F.col(w)),
        "n_capitals": F.size(F.filter(w, lambda x: F.rlike(x, F.lit(TWO_UPPER)) & ~F.rlike(x, F.lit(LOWER)))).cast("long"),
        "n_letter_words": F.size(F.filter(w, lambda x: F.rlike(x, F.lit(r"\p{L}")))).cast("long"),
    }).drop(w, l)
    bits = [F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0)) for name, rule in RULES.items()]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return d.withColumn("failed", failed)


def passes(policy: str = CURRENT) -> Column:
    """Verdict of a policy over ledger rows."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: rows that fail it, and rows kept again without it.

    Ledger rows are first counted per distinct mask (map-side, at most two to the number
    of rules), so the ablation reads the bits, never the texts.  An empty ledger gives
    no row; bit_or over the masks tells whether a rule ever failed.
    """
    m = mask(policy)
    masks = rows.groupBy(F.col("failed").bitwiseAND(F.lit(m)).alias("failed")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).alias("bit"))
                                for r in POLICIES[policy]]))
    one = masks.select("failed", "n", rules.alias("r")).select("failed", "n", "r.rule", "r.bit")
    hit, only = F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("failed") == F.col("bit")
    return one.groupBy("rule", "bit").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(only, F.col("n")).otherwise(0)).alias("n_only"),
        (F.bit_or(F.col("failed")).bitwiseAND(F.first("bit")) != 0).alias("ever"),
    )


def judge(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per document: measurements, ``failed``, ``base_failed`` and ``kept``."""
    return ledger(docs).withColumns({
        "base_failed": ~passes("base"),
        "kept": passes("base") & passes(policy),
    })
