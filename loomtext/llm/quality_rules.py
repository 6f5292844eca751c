"""Line-first quality rules (native).

Every line is tested by punctuation, navigation and boilerplate rules; failing lines are removed;
a document that loses too much of its text, or fails the base rules, is rejected. The whole operator
is one projection: no shuffle, no Python, and memory bounded by one text.

Defined results: a null text has no words and is rejected; an empty or blank text likewise; repeated
rows and ties are judged row by row and alike; an empty table gives an empty table; extra input
columns pass through ``clean`` untouched and cannot clash, as all working values live in one struct
whose name is chosen against the input's columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, fresh, let, words

SYMBOLS = r"[#*$%&|<>]"
#: Marks that running prose uses rarely; a line dense in them fails the punctuation rule.
ODD_MARKS = r"[#*$%&|<>!?^~=_{}\[\]\\@+]"
SEPARATORS = r"[|»›•·>]"
#: Phrases of page furniture in English, French, German and Spanish, lower case.
BOILERPLATE = (
    "all rights reserved", "licensed under", "accept cookies", "cookie policy", "privacy policy",
    "terms of use", "terms of service", "click here", "sign up for", "log in to", "share this",
    "skip to content", "powered by", "subscribe to",
    "tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "cliquez ici",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "hier klicken",
    "todos los derechos reservados", "política de privacidad", "términos de uso", "haga clic aquí",
)


def repeated_window_words(ws: Column) -> Column:
    """Words that lie in a 3-word window found at least twice in the array.

    Windows are compared by 64-bit hashes. Their positions are brought together by sorting numbers whose high
    bits are the hash's and whose low 20 bits are the position; where the high bits alone would merge different
    hashes, or a text has over 2^20 words, (hash, position) pairs are sorted instead.
    """
    low = (1 << 20) - 1

    def covered(positions: Column) -> Column:
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            positions,
            zero,
            lambda a, p: F.struct(
                (p + 3).alias("end"), (a["n"] + (p + 3) - F.greatest(a["end"], p)).cast("long").alias("n")
            ),
            lambda a: a["n"],
        )

    def by_pairs(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda s, x, j: F.get(s, j)["h"].eqNullSafe(x["h"])
        twice = let(pairs, lambda s: F.transform(F.filter(s, lambda x, i: same(s, x, i - 1) | same(s, x, i + 1)), lambda x: x["i"]))
        return covered(F.sort_array(twice))

    def by_packed(h: Column, n_distinct: Column) -> Column:
        packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))
        near = lambda s, x, j: F.shiftright(F.get(s, j), 20).eqNullSafe(F.shiftright(x, 20))
        return let(
            packed,
            lambda s: F.when(
                F.size(F.filter(s, lambda x, i: ~near(s, x, i - 1))) == n_distinct,
                covered(
                    F.sort_array(
                        F.transform(
                            F.filter(s, lambda x, i: near(s, x, i - 1) | near(s, x, i + 1)),
                            lambda x: x.bitwiseAND(F.lit(low)).cast("int"),
                        )
                    )
                ),
            ).otherwise(by_pairs(h)),
        )

    def windows(w: Column) -> Column:
        n = F.size(w)
        two = F.zip_with(w, F.slice(w, F.lit(2), n), lambda a, b: F.xxhash64(a, b))
        three = F.zip_with(two, F.slice(w, F.lit(3), n), lambda h, c: F.xxhash64(h, c))
        return F.slice(three, F.lit(1), F.greatest(n - 2, F.lit(0)))

    none = F.lit(0).cast("long")
    return let(
        ws,
        lambda w: F.when(F.size(w) < 4, none).otherwise(
            let(
                windows(w),
                lambda h: let(
                    F.size(F.array_distinct(h)),
                    lambda d: F.when(d == F.size(h), none)
                    .when(F.size(h) > low, by_pairs(h))
                    .otherwise(by_packed(h, d)),
                ),
            )
        ),
    )


def line_passes(line: Column, *, max_mark_share: float, max_separators: int) -> Column:
    """False for a line that looks like symbol noise, navigation or boilerplate; blank lines pass."""
    noisy = F.regexp_count(line, F.lit(ODD_MARKS)) > F.length(line) * F.lit(max_mark_share)
    navigation = F.regexp_count(line, F.lit(SEPARATORS)) >= max_separators

    def boilerplate(low: Column) -> Column:
        found = F.lit(False)
        for phrase in BOILERPLATE:
            found = found | F.contains(low, F.lit(phrase))
        return found

    return ~(noisy | navigation | let(F.lower(line), boilerplate))


def judged(
    text: Column,
    *,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_mark_share: float = 0.08,
    max_separators: int = 3,
    max_lost_percent: int = 30,
) -> Column:
    """A struct of counts, the cleaned text and the verdict for one text."""
    passed = lambda x: line_passes(x, max_mark_share=max_mark_share, max_separators=max_separators)

    def counts(t: Column, w: Column, lines: Column) -> Column:
        full = F.filter(lines, lambda x: F.btrim(x, F.lit(SPACES)) != "")
        clean_lines = F.filter(lines, passed)
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            let(full, lambda f: (F.size(f) - F.size(F.array_distinct(f))).cast("long")).alias("n_dup_lines"),
            repeated_window_words(w).alias("n_repeat_words"),
            let(clean_lines, lambda c: F.when(F.size(c) == F.size(lines), t).otherwise(F.array_join(c, "\n"))).alias("clean_text"),
        )

    def verdict(t: Column, c: Column) -> Column:
        n, repeated = c["n_words"], c["n_repeat_words"]
        failed = (n < min_words) | (repeated * 100 > n * max_repeat_percent)
        lost = F.when(c["clean_text"] == t, F.lit(0).cast("long")).otherwise(n - F.size(words(c["clean_text"])))
        return let(
            F.struct(failed.alias("f"), lost.alias("l")),
            lambda v: F.struct(
                *[c[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                v["f"].alias("base_failed"),
                c["clean_text"].alias("clean_text"),
                v["l"].alias("n_lost_words"),
                (~v["f"] & (v["l"] * 100 <= n * max_lost_percent)).alias("kept"),
            ),
        )

    def judge(t: Column) -> Column:
        counted = let(words(t), lambda w: let(F.split(t, "\n", -1), lambda lines: counts(t, w, lines)))
        return let(counted, lambda c: verdict(t, c))

    return let(F.coalesce(text, F.lit("")), judge)


def assess(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """One row per document: id, the base counts, ``base_failed``, ``n_lost_words``, ``clean_text`` and ``kept``."""
    return docs.select(F.col(id_col), judged(F.col(text_col), **rules).alias("_judged")).select(id_col, "_judged.*")


def clean(docs: DataFrame, *, text_col: str = "text", length_col: str = "n_chars", **rules) -> DataFrame:
    """Kept documents with their failing lines removed, in the input's columns."""
    name = fresh(docs.columns, "_judged")
    out = docs.withColumn(name, judged(F.col(text_col), **rules)).where(F.col(name)["kept"])
    out = out.withColumn(text_col, F.col(name)["clean_text"])
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)
