"""Benchmark decontamination by template canonicalisation (native).

Numbers, units and names become typed placeholders; the rest is lower case without punctuation. Numbers are digits or
number words, and a run of number words ("one hundred") is one number. A capitalised
word that begins the text or a sentence, or follows a quote, bracket or other mark, may be a name or not: there are
two templates, a narrow one in which it is a plain word and a wide one in which it is a name. The benchmark's windows
also come in a third one, plain, without names, so that a copy in lower case, whose names cannot be told, is found by
the words themselves.
Windows of ``window`` template words are hash-joined with those of the benchmark. A (document, item) pair whose
windows matched by any template are at least ``min_share`` of the item's distinct windows is a candidate. For candidates
matched windows are laid out by their shift, the place in the document less the place in the item: a copy has one shift,
and one more for each stretch of words put in or left out. As every such change costs it ``window`` - 1 windows, a copy that
keeps ``min_share`` of n windows has at most 1 + (1 - min_share) n / (window - 1) shifts. The fullest shifts, as many as
it takes to reach ``min_share`` and no more than that, are the alignment, and only its windows count: windows that match
here and there do not. Within it the words behind the placeholders are compared: each value of the item must stand for
one value of the document. A pair is reported if at least ``min_consistent`` of its slot values do (a pair that passes
by the narrow template alone is judged and counted by that alone), so questions with other numbers or names are caught
and chance matches of placeholders are not. A copy in lower case with other names than the item's is not caught.

The benchmark's windows are written to the shared folder and counted: up to ``broadcast_windows`` they are
broadcast and documents are not shuffled, beyond that it is an ordinary join. Candidates with their items' texts are
broadcast up to ``broadcast_bytes``, as counted from the written table.

Defined results: null or empty text, and an item without words, match nothing; a text or item with fewer words
than ``window`` has one window, its whole sequence; repeated rows and rows that share an id count as one
document; a null id is a document of its own; empty tables give no pairs; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, fresh, let

#: Units that become a placeholder (fixed list).
UNITS = (
    "mm", "cm", "m", "km", "mg", "g", "kg", "ml", "l", "s", "sec", "min", "h", "hr", "hrs", "inch", "inches", "ft", "feet",
    "yard", "yards", "mile", "miles", "lb", "lbs", "oz", "pound", "pounds", "second", "seconds", "minute", "minutes",
    "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "meter", "meters", "metre",
    "metres", "gram", "grams", "litre", "litres", "liter", "liters", "dollar", "dollars", "cent", "cents", "euro",
    "euros", "percent", "degrees", "mph", "kmh", "kw", "kwh", "hz",
)
#: Words that are numbers (fixed list).
NUMBERS = (
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen",
    "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty",
    "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion",
)
#: Marks a capitalised word that follows a letter, digit or comma: a name.
MARK = "\x01"
NAME_PATTERN = r"(?<=[\p{L}\p{N},;][ \t-\r])(?=\p{Lu}\p{Ll})"
#: Marks a capitalised word anywhere else: a name in the wide template.
START = "\x02"
#: Words that begin with a mark are smaller, all others are not.
MARK_END = "\x03"
START_PATTERN = r"(?<![\p{L}\p{N}\x01])(?=\p{Lu}\p{Ll})"
PUNCTUATION = r"[^\p{L}\p{N}\x01\x02]+"
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
#: Templates by what counts as a name.
NARROW, WIDE, PLAIN = range(3)


def _first(w: Column) -> Column:
    return F.substring(w, 1, 1)


def _bare(w: Column) -> Column:
    return F.when(_first(w).isin(MARK, START), F.substring(w, 2, 2**30)).otherwise(w)


def _digits(w: Column) -> Column:
    return F.coalesce(_first(w).between("0", "9"), F.lit(False))


def raw_words(text: Column) -> Column:
    """Lower-case words without punctuation; a name begins with ``MARK``, or ``START`` if it may be none; decimal marks
    inside numbers, and number words that follow a number, are dropped."""
    names = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), MARK + START, "  "), NAME_PATTERN, MARK)
    marked = F.regexp_replace(names, START_PATTERN, START)
    numbers = let(marked, lambda m: F.when(m.rlike("[0-9][.,][0-9]"), F.regexp_replace(m, "(?<=[0-9])[.,](?=[0-9])", "")).otherwise(m))
    forms = [mark + n for n in NUMBERS for mark in ("", MARK, START)]

    def one_number(each: Column) -> Column:
        before = lambda i: F.get(each, i - 1)
        return F.filter(each, lambda w, i: ~(w.isin(*forms) & F.coalesce(before(i).isin(*forms) | _digits(before(i)), F.lit(False))))

    return let(F.array_remove(F.split(F.lower(numbers), PUNCTUATION, -1), ""), one_number)


def template(raw: Column, kind: int) -> Column:
    """Typed placeholders for the words that have a type."""

    def typed(w: Column) -> Column:
        bare = F.substring(w, 2, 2**30)
        name, maybe = (bare if kind == PLAIN else F.lit(NAME)), (F.lit(NAME) if kind == WIDE else bare)
        return (
            F.when(w >= "a", F.when(w.isin(*NUMBERS, *UNITS), F.when(w.isin(*UNITS), UNIT).otherwise(NUMBER)).otherwise(w))
            .when(_first(w) == MARK, F.when(bare.isin(*NUMBERS), NUMBER).otherwise(name))
            .when(_first(w) == START, F.when(bare.isin(*NUMBERS), NUMBER).when(bare.isin(*UNITS), UNIT).otherwise(maybe))
            .when(_digits(w), NUMBER)
            .otherwise(w)
        )

    return F.transform(raw, typed)


def widened(raw: Column, narrow: Column) -> Column:
    """The wide template from the narrow one: words that may be names, and have no other type, become names."""
    return F.zip_with(raw, narrow, lambda w, n: F.when((w < MARK_END) & (_first(w) == START) & ~n.isin(NUMBER, UNIT), NAME).otherwise(n))


def window_hashes(t: Column, window: int) -> Column:
    """Hashes of all windows of template words, in order; one for the whole of a shorter text; none for no words."""
    n = F.size(t)
    each = F.transform(
        F.slice(t, F.lit(1), F.greatest(n - (window - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(t, i + k) for k in range(1, window)]),
    )
    whole = F.xxhash64(F.lit("short"), F.array_join(t, " "))
    return F.when(n >= window, each).when(n > 0, F.array(whole)).otherwise(F.array().cast("array<bigint>"))


def all_windows(raw: Column, window: int, *, plain: bool = False) -> Column:
    """array<struct<h, key, p, t>>: windows of the narrow template (t = 0) in order, then those of the wide (1) and, if
    ``plain``, of the plain one (2) that differ. ``key`` is the hash by the narrow template of the window at place ``p``.
    """

    def listed(narrow: Column, *others: Column) -> Column:
        one = lambda h, p, t: F.struct(h.alias("h"), F.get(narrow, p).alias("key"), p.alias("p"), F.lit(t).alias("t"))
        differ = lambda other, t: F.filter(F.transform(other, lambda h, p: one(h, p, t)), lambda x: x["h"] != x["key"])
        return F.concat(F.transform(narrow, lambda h, p: one(h, p, 0)), *[differ(x, t) for t, x in enumerate(others, 1)])

    hashed = lambda t: window_hashes(t, window)

    def both(t: Column) -> Column:
        if not plain:
            return let(hashed(t), lambda narrow: let(let(widened(raw, t), hashed), lambda wide: listed(narrow, wide)))
        bare = let(template(raw, PLAIN), hashed)
        return let(hashed(t), lambda narrow: let(let(widened(raw, t), hashed), lambda wide: let(bare, lambda b: listed(narrow, wide, b))))

    return let(template(raw, NARROW), both)


def text_hashes(raw: Column, window: int) -> Column:
    """struct<n, hs>: hashes of the ``n`` windows of the narrow template in order, then those of the wide one that differ."""
    hashed = lambda t: window_hashes(t, window)

    def both(narrow: Column, wide: Column) -> Column:
        return F.struct(F.size(narrow).alias("n"), F.concat(narrow, F.filter(wide, lambda h, i: h != F.get(narrow, i))).alias("hs"))

    return let(template(raw, NARROW), lambda t: let(hashed(t), lambda narrow: let(let(widened(raw, t), hashed), lambda wide: both(narrow, wide))))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 5,
    min_share: float = 0.8,
    min_consistent: float = 0.8,
    broadcast_windows: int = 500_000,
    broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """(id, item id, n_windows, n_matched, n_slots, n_consistent): one row for each contaminated pair."""
    scratch = Scratch(docs.sparkSession)
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("item_text"))
    windows = scratch.put(
        items.select("item", F.explode(let(raw_words(F.col("item_text")), lambda raw: all_windows(raw, window, plain=True))).alias("w"))
        .select("item", "w.h", "w.key", (F.col("w.t") > 0).alias("item_wide"))
        .distinct(),
        "windows",
    )
    few = windows.limit(broadcast_windows + 1).count() <= broadcast_windows
    small = F.broadcast if few else (lambda x: x)
    sizes = windows.groupBy("item").agg(F.countDistinct("key").alias("n_windows"))
    texts = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"))
    hits = (
        texts.select("d", let(raw_words(F.col("t")), lambda raw: text_hashes(raw, window)).alias("w"))
        .select("d", F.col("w.n").alias("n"), F.posexplode("w.hs").alias("p", "h"))
        .select("d", "h", (F.col("p") >= F.col("n")).alias("wide"))
        .join(small(windows), "h")
        .groupBy("d", "item", "key")
        .agg(F.min(F.col("wide") | F.col("item_wide")).alias("wide"))
        .groupBy("d", "item")
        .agg(F.count_if(~F.col("wide")).alias("narrow_matched"), F.count("*").alias("n_matched"))
    )
    least_matched = F.ceil(F.col("n_windows") * min_share - 1e-9)
    pairs = scratch.put(hits.join(small(sizes), "item").where(F.col("n_matched") >= least_matched), "candidates")
    # the slots behind the windows of the candidates
    wanted = pairs.select(F.col("d").alias("pd"), "item").join(items.withColumnRenamed("item", "i2"), F.col("item").eqNullSafe(F.col("i2"))).select("pd", "item", "item_text")
    wanted = scratch.put(wanted, "candidate_items")
    weight = wanted.agg(F.sum(F.octet_length("item_text") + 64)).first()[0] or 0
    both = texts.join(F.broadcast(wanted) if weight <= broadcast_bytes else wanted, F.col("d").eqNullSafe(F.col("pd")))
    met = both.select("d", "item", _matches(F.col("t"), F.col("item_text"), window).alias("s")).select("d", "item", F.explode("s").alias("s"))
    least_of = pairs.select(F.col("d").alias("cd"), F.col("item").alias("ci"), "n_windows", least_matched.alias("least"))
    same_pair = F.col("d").eqNullSafe(F.col("cd")) & F.col("item").eqNullSafe(F.col("ci"))
    met = scratch.put(met.select("d", "item", "s.*").join(least_of, same_pair).drop("cd", "ci"), "met")
    aligned = scratch.put(_alignment(met, window, min_share), "aligned")
    keys = aligned.where("key is not null").groupBy("d", "item", "n_windows", "key").agg(F.min("wide").alias("wide"))
    keys = keys.groupBy("d", "item", "n_windows").agg(F.count_if(~F.col("wide")).alias("narrow_matched"), F.count("*").alias("n_matched"))
    values = aligned.where("key is null").groupBy("d", "item", "theirs", "ours").agg(F.min("wide").alias("wide"))
    values = values.groupBy("d", "item", "theirs").agg(F.count_if(~F.col("wide")).alias("narrow"), F.count("*").alias("n"))
    checked = values.groupBy(F.col("d").alias("cd"), F.col("item").alias("ci")).agg(
        F.count_if(F.col("narrow") > 0).alias("narrow_slots"), F.count_if(F.col("narrow") == 1).alias("narrow_consistent"),
        F.count("*").alias("n_slots"), F.count_if(F.col("n") == 1).alias("n_consistent"),
    )
    judged = keys.join(checked, same_pair, "left")
    out_item = item_col if item_col.lower() != id_col.lower() else fresh([id_col], item_col)

    def verdict(matched: str, slots_: str, consistent: str) -> Column:
        """The three counts, or null if they do not make a leak."""
        n, c = (F.coalesce(x, F.lit(0).cast("long")) for x in (slots_, consistent))
        passed = (F.col(matched) >= least_matched) & (c >= F.ceil(n * min_consistent - 1e-9))
        return F.when(passed, F.struct(F.col(matched).alias("n_matched"), n.alias("n_slots"), c.alias("n_consistent")))

    leak = F.coalesce(verdict("narrow_matched", "narrow_slots", "narrow_consistent"), verdict("n_matched", "n_slots", "n_consistent"))
    found = judged.select(F.col("d").alias(id_col), F.col("item").alias(out_item), "n_windows", leak.alias("_leak"))
    return found.where("_leak is not null").select(id_col, out_item, "n_windows", "_leak.*")


def _alignment(met: DataFrame, window: int, min_share: float) -> DataFrame:
    """The rows of the fullest shifts of each pair, as many as reach the share, and as many as a copy can have."""
    pair, here = Window.partitionBy("d", "item"), Window.partitionBy("d", "item", "shift")
    full = met.withColumn("here", F.size(F.collect_set("key").over(here)))
    shifts = full.groupBy("d", "item", "shift", "here", "n_windows", "least").count()
    order = pair.orderBy(F.desc("here"), "shift")
    before = F.coalesce(F.sum("here").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    most = 1 + F.floor(F.col("n_windows") * (1 - min_share) / (window - 1) + 1e-9)
    taken = shifts.withColumn("before", before).withColumn("place", F.row_number().over(order)).where((F.col("place") <= most) & (F.col("before") < F.col("least")))
    taken = taken.select(F.col("d").alias("td"), F.col("item").alias("ti"), F.col("shift").alias("ts"))
    same = F.col("d").eqNullSafe(F.col("td")) & F.col("item").eqNullSafe(F.col("ti")) & (F.col("shift") == F.col("ts"))
    return met.join(taken, same, "left_semi").drop("least")


def _matches(text: Column, item_text: Column, window: int) -> Column:
    """array<struct<shift, key, wide, theirs, ours>>: for matched windows their key, and, without a key, the item's and the
    document's words at their placeholders.

    A window of the document stands for the first of each of the item's distinct windows that have its hash; this runs
    for candidate pairs only.
    """

    def compare(iraw: Column, iw: Column, ih: Column, raw: Column, narrow: Column, wide: Column) -> Column:
        def at(x: Column) -> Column:
            def row(f: Column, key: Column, theirs: Column, ours: Column) -> Column:
                return F.struct((x["p"] - f["p"]).alias("shift"), key.alias("key"), ((x["t"] > 0) | (f["t"] > 0)).alias("wide"), theirs.alias("theirs"), ours.alias("ours"))

            def slots(f: Column) -> Column:
                def slot(k: Column) -> Column:
                    placed = F.when(x["t"] == 0, F.get(narrow, x["p"] + k)).otherwise(F.get(wide, x["p"] + k))
                    theirs, ours = _bare(F.get(iraw, f["p"] + k)), _bare(F.get(raw, x["p"] + k))
                    typed = placed.isin(NUMBER, UNIT, NAME) & theirs.isNotNull()
                    return F.when(typed, row(f, F.lit(None).cast("long"), theirs, ours))

                each = F.array_compact(F.transform(F.sequence(F.lit(0), F.lit(window - 1)), slot))
                return F.concat(F.array(row(f, f["key"], F.lit(None).cast("string"), F.lit(None).cast("string"))), each)

            return F.flatten(F.transform(F.filter(iw, lambda f: f["h"] == x["h"]), slots))

        hit = F.filter(all_windows(raw, window), lambda x: F.array_contains(ih, x["h"]))
        return F.array_distinct(F.flatten(F.transform(hit, at)))

    def firsts(iw: Column) -> Column:
        """Of windows with one hash and key, the first."""
        another = lambda each, f, i: (i == 0) | (F.get(each, i - 1)["h"] != f["h"]) | (F.get(each, i - 1)["key"] != f["key"])
        return let(F.array_sort(iw), lambda each: F.filter(each, lambda f, i: another(each, f, i)))

    def bind(values: list, body, *done: Column) -> Column:
        return let(values[0](*done), lambda v: bind(values[1:], body, *done, v)) if values else body(*done)

    return bind(
        [
            lambda: raw_words(item_text),
            lambda iraw: firsts(all_windows(iraw, window, plain=True)),
            lambda _, iw: F.transform(iw, lambda x: x["h"]),
            lambda *_: raw_words(text),
            lambda *done: template(done[3], NARROW),
            lambda *done: widened(done[3], done[4]),
        ],
        compare,
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", broadcast_ids: int = 100_000, **options) -> DataFrame:
    """The documents that contain no benchmark item, in the input's columns."""
    leaks = find_leaks(docs, benchmark, id_col=id_col, **options)
    key = fresh(docs.columns, "_leak")
    ids = Scratch(docs.sparkSession).put(leaks.select(F.col(id_col).alias(key)).distinct(), "leaks")
    few = ids.limit(broadcast_ids + 1).count() <= broadcast_ids
    return docs.join(F.broadcast(ids) if few else ids, F.col(id_col).eqNullSafe(F.col(key)), "left_anti")
