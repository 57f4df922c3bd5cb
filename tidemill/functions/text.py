"""Text and licence expressions, all built in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.identity import word

#: Words for numbers, articles, and words too common to compare.
NUMBERS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10"}
ARTICLES = ["a", "an", "the"]
STOP = ["a", "an", "and", "for", "in", "of", "on", "the", "to", "with"]


def normal_answer(c: Column) -> Column:
    """Lower case, punctuation to blanks, articles dropped, number words to digits, single blanks; empty for null."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}\s]", " "), r"\s+", " "))
    table = F.create_map(*(F.lit(x) for kv in NUMBERS.items() for x in kv))
    kept = F.filter(F.split(clean, " "), lambda w: ~w.isin(ARTICLES))
    return F.array_join(F.transform(kept, lambda w: F.coalesce(table[w], w)), " ")


def stems(c: Column) -> Column:
    """Lower-case words without stop words, plural endings cut."""
    words = F.split(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), " ")
    kept = F.filter(words, lambda w: (w != "") & ~w.isin(STOP))

    def cut(w: Column) -> Column:
        plain = w.endswith("s") & ~w.endswith("ss") & ~w.endswith("us") & ~w.endswith("is") & (F.length(w) > 3)
        ies = F.concat(F.substring(w, F.lit(1), F.length(w) - 3), F.lit("y"))
        return F.when(w.endswith("ies") & (F.length(w) > 4), ies).when(plain, F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w)

    return F.transform(kept, cut)


def licence_id(c: Column) -> Column:
    """Upper case with hyphens for blanks; UNKNOWN for null and blank."""
    return F.coalesce(F.upper(F.regexp_replace(word(c), "[ _]+", "-")), F.lit("UNKNOWN"))


def licence_class(c: Column) -> Column:
    """The strictest condition a licence id names."""
    i = licence_id(c)
    return (
        F.when(i.contains("-NC"), "noncommercial").when(i.contains("-ND"), "noderivatives").when(i.contains("-SA"), "sharealike")
        .when(i.startswith("CC-BY"), "attribution").when(i.startswith("CC0") | i.startswith("PUBLIC-DOMAIN"), "open").otherwise("unknown")
    )


def caption(clauses: list[Column]) -> Column:
    """Present clauses joined by commas, with a capital and a full stop; empty without any."""
    s = F.array_join(F.array_compact(F.array(*clauses)), ", ")
    return F.when(s == "", "").otherwise(F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1_000_000), F.lit(".")))


def facts(clauses: list[Column]) -> Column:
    """How many clauses are present."""
    return F.size(F.array_compact(F.array(*clauses)))
