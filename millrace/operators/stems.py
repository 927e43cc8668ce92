"""Porter's stemmer (M. F. Porter, An algorithm for suffix stripping, 1980) as columns over distinct terms.

A word is kept with its ``y`` resolved into a vowel (1) or a consonant (Y), so that the measure of a stem and its other conditions
are patterns over a prefix of the word. Each step is a table of suffixes; the longest that fits decides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accents that go, and the algorithm's suffixes with what takes their place.
ACCENTED = ("àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
C, V = "[^aeiou1]", "[aeiou1]"
MEASURED, TWICE, ONCE = rf"^{C}*{V}+{C}", rf"^{C}*{V}+{C}+{V}+{C}", rf"^{C}*{V}+{C}+{V}*\z"
SHORT = rf"{C}{V}[^aeiou1wxY]\z"
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
)
STEP_3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


class Text:
    """How one engine writes the few operations that the steps need: Spark's columns here, DuckDB's SQL in the plans."""

    ends = staticmethod(lambda w, s: w.endswith(s))
    cut = staticmethod(lambda w, n: F.substring(w, F.lit(1), F.length(w) - n))
    fits = staticmethod(lambda w, p: w.rlike(p))
    add = staticmethod(lambda w, s: F.concat(w, F.lit(s)) if s else w)
    both = staticmethod(lambda a, b: a & b)
    no = staticmethod(lambda a: ~a)

    @staticmethod
    def choose(cases: list[tuple], other):
        out = None
        for test, value in cases:
            out = F.when(test, value) if out is None else out.when(test, value)
        return out.otherwise(other)


def by_suffix(t, w, table, test: str):
    """The longest suffix of the table that fits is replaced if what stands before it passes the test."""
    ordered = sorted(table, key=lambda x: (-len(x[0]), x[0]))
    return t.choose([(t.ends(w, s), t.choose([(t.fits(t.cut(w, len(s)), test), t.add(t.cut(w, len(s)), new))], w)) for s, new in ordered], w)


def steps(t) -> list[Callable]:
    """The steps in order, each from a word to a word."""

    def plural(w):
        return t.choose([(t.ends(w, "sses"), t.cut(w, 2)), (t.ends(w, "ies"), t.cut(w, 2)), (t.ends(w, "ss"), w), (t.ends(w, "s"), t.cut(w, 1))], w)

    def mended(w):
        double = t.both(t.fits(w, r"(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx|YY)\z"), t.no(t.fits(w, r"[lsz]\z")))
        return t.choose([(t.fits(w, r"(at|bl|iz)\z"), t.add(w, "e")), (double, t.cut(w, 1)), (t.both(t.fits(w, ONCE), t.fits(w, SHORT)), t.add(w, "e"))], w)

    def past(w):
        ed, ing = t.cut(w, 2), t.cut(w, 3)
        kept = t.choose([(t.fits(ing, MEASURED), t.cut(w, 1))], w)
        return t.choose([(t.ends(w, "eed"), kept), (t.both(t.ends(w, "ed"), t.fits(ed, V)), mended(ed)), (t.both(t.ends(w, "ing"), t.fits(ing, V)), mended(ing))], w)

    def last_y(w):
        return t.choose([(t.both(t.fits(w, r"[1Y]\z"), t.fits(t.cut(w, 1), V)), t.add(t.cut(w, 1), "i"))], w)

    def fourth(w):
        table = sorted(STEP_4, key=lambda s: (-len(s), s))
        test = lambda s: t.fits(t.cut(w, len(s)), TWICE)
        ion = lambda s: t.both(test(s), t.fits(t.cut(w, 3), r"[st]\z")) if s == "ion" else test(s)
        return t.choose([(t.ends(w, s), t.choose([(ion(s), t.cut(w, len(s)))], w)) for s in table], w)

    def last_e(w):
        one = t.cut(w, 1)
        goes = t.choose([(t.fits(one, TWICE), one), (t.both(t.fits(one, MEASURED), t.no(t.both(t.fits(one, ONCE), t.fits(one, SHORT)))), one)], w)
        return t.choose([(t.ends(w, "e"), goes)], w)

    def double_l(w):
        return t.choose([(t.both(t.ends(w, "ll"), t.fits(t.cut(w, 1), TWICE)), t.cut(w, 1))], w)

    return [plural, past, last_y, lambda w: by_suffix(t, w, STEP_2, MEASURED), lambda w: by_suffix(t, w, STEP_3, MEASURED), fourth, last_e, double_l]


def stem_terms(terms: DataFrame) -> DataFrame:
    """Rows (term, stem) of the distinct terms (term): lower case, accents folded, suffixes stripped; two letters or fewer stay."""
    rows = terms.select("term").filter("term IS NOT NULL").distinct().withColumn("w", F.translate(F.lower("term"), *ACCENTED)).withColumn("whole", F.col("w"))
    resolved = F.regexp_replace("w", "^y", "Y")
    for _ in range(4):
        resolved = F.regexp_replace(F.regexp_replace(resolved, "(?<=[aeiou1])y", "Y"), "(?<=[^aeiou1y])y", "1")
    rows = rows.withColumn("w", resolved)
    for step in steps(Text):
        rows = rows.withColumn("w", step(F.col("w")))
    return rows.select("term", F.when(F.length("whole") > 2, F.translate("w", "1Y", "yy")).otherwise(F.col("whole")).alias("stem"))
