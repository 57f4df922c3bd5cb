"""Column-level operators: typed predicates, zones, names, positions, provenance, stems, violations.

Everything here is a column expression: no shuffle, no Python rows, and filters built from it reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.identity import trimmed, word


def predicate(c: Column, op: str, value: str | list[str]) -> Column:
    """A typed subset predicate on the value as text; never null: ``eq``/``in`` are false and ``ne``/``not_in`` true on null."""
    text = c.cast("string")
    if op in ("eq", "ne"):
        same = text.eqNullSafe(F.lit(value))
        return same if op == "eq" else ~same
    if op in ("in", "not_in"):
        inside = F.coalesce(text.isin(list(value)), F.lit(False))
        return inside if op == "in" else ~inside
    raise ValueError(f"unknown predicate {op}")


#: Half-open depth zones in metres, shallowest first.
DEPTH_ZONES = [("shallow", -2.0, 10.0), ("upper", 10.0, 30.0), ("mesophotic", 30.0, 150.0), ("deep", 150.0, 11000.0)]


def depth_zone(depth: Column) -> Column:
    """Zone of a depth in metres; just above the water line counts as shallow; null, NaN and impossible depths give null."""
    ok = depth.isNotNull() & ~F.isnan(depth)
    out = F.lit(None).cast("string")
    for name, low, high in reversed(DEPTH_ZONES):
        out = F.when(ok & (depth >= low) & (depth < high), name).otherwise(out)
    return out


#: Split spellings after lower-casing and trimming.
SPLIT_NAMES = {"train": "train", "training": "train", "val": "val", "valid": "val", "validation": "val", "dev": "val", "test": "test", "testing": "test", "test_ood": "test"}


def split_name(c: Column) -> Column:
    """train, val or test; null for any other value."""
    return F.create_map(*(F.lit(x) for kv in SPLIT_NAMES.items() for x in kv))[word(c)]


def first_present(origins: dict[str, Column]) -> tuple[Column, Column]:
    """(value, origin): the first non-blank of several text columns, and the name of the one it came from."""
    filled = {k: F.nullif(trimmed(c), F.lit("")) for k, c in origins.items()}
    origin = F.lit(None).cast("string")
    for k, c in reversed(filled.items()):
        origin = F.when(c.isNotNull(), k).otherwise(origin)
    return F.coalesce(*filled.values()), origin


def as_unit(lat: Column, lon: Column) -> Column:
    """A position as struct<lat, lon>: both or neither; null outside the legal range."""
    return F.when(lat.between(-90, 90) & lon.between(-180, 180) & ~F.isnan(lat) & ~F.isnan(lon), F.struct(lat.alias("lat"), lon.alias("lon")))


def generalised(c: Column, vague: Column, digits: int = 1) -> Column:
    """Rounded half-even to ``digits`` where the row is flagged."""
    return F.when(vague, F.bround(c, digits)).otherwise(c)


def violations(rules: dict[str, Column]) -> Column:
    """array<string> of the names of all rules a row breaks; a rule that is null is not broken."""
    return F.array_compact(F.array(*(F.when(c, name) for name, c in rules.items())))


def with_repeats(df: DataFrame, keys: list[str], out: str = "repeats") -> DataFrame:
    """Adds how many rows share the keys, by aggregation and join (a window would gather a hot key in one task)."""
    n = df.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.count("*").alias(out))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(n, same).drop(*(f"_{k}" for k in keys))


def calendar_date(text: Column) -> Column:
    """The first valid date in a text: yyyymmdd or yyyy-mm-dd with any single separator."""
    found = F.regexp_extract(text, r"(\d{4})[-_.]?(\d{2})[-_.]?(\d{2})", 0)
    return F.try_to_date(F.nullif(F.regexp_replace(found, r"[-_.]", ""), F.lit("")), "yyyyMMdd")


def size_band(n: Column) -> Column:
    """n<1K, 1K<n<10K, 10K<n<100K, 100K<n<1M or n>1M."""
    return F.when(n < 1000, "n<1K").when(n < 10_000, "1K<n<10K").when(n < 100_000, "10K<n<100K").when(n < 1_000_000, "100K<n<1M").otherwise("n>1M")


def wilson(k: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Bounds of a proportion; (0, 0) for n = 0."""
    m = F.nullif(n.cast("double"), F.lit(0.0))
    p = k / m
    middle = p + z * z / (2 * m)
    spread = z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))
    scale = 1 + z * z / m
    some = n > 0  # least and greatest skip nulls
    low, high = F.greatest(F.lit(0.0), (middle - spread) / scale), F.least(F.lit(1.0), (middle + spread) / scale)
    return F.when(some, low).otherwise(0.0), F.when(some, high).otherwise(0.0)


# How a caption may name a state, and the state it names.
BLEACHING = {"healthy": "HEALTHY", "bleached": "BLEACHED", "bleaching": "BLEACHED", "pale": "BLEACHED", "unhealthy": "UNHEALTHY", "diseased": "UNHEALTHY"}
# How a caption may name what covers the ground, and its class.
GROUND = {"hard coral": "HC", "soft coral": "SC", "coral rubble": "RB", "sand": "SD", "algae": "ALG", "rock": "RCK", "sponge": "SP"}


def named_states(caption: Column, terms: dict[str, str]) -> Column:
    """The states that a caption names, sorted; none for null."""
    low = F.lower(F.coalesce(caption, F.lit("")))
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(F.contains(low, F.lit(k)), v) for k, v in terms.items())))))


def caption_flag(caption: Column, label: Column, terms: dict[str, str], axis: str) -> Column:
    """"axis:caption=A,B!=label=C" where a caption names states and the label, if there is one, is none of them; else null."""
    named = named_states(caption, terms)
    clash = (F.size(named) > 0) & label.isNotNull() & (label != "") & ~F.array_contains(named, label)
    return F.when(clash, F.concat(F.lit(f"{axis}:caption="), F.array_join(named, ","), F.lit("!=label="), label))


def allowed(licence: Column, licences: list[str]) -> Column:
    """Whether a licence is on a list, as it stands; null is on none. A plain comparison, so that a scan filters by it."""
    return F.coalesce(licence.isin(licences), F.lit(False))


def uuid_in(*texts: Column) -> Column:
    """The first uuid that stands in one of the texts, in lower case; null where none holds one."""
    pattern = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    return F.coalesce(*(F.nullif(F.regexp_extract(F.lower(c), pattern, 0), F.lit("")) for c in texts))


def suffix_of(key: Column) -> Column:
    """The ending of a key or address in lower case, without query and fragment; of archives both endings (tar.gz); null without."""
    name = F.regexp_replace(F.regexp_replace(F.lower(key), "[?#].*$", ""), "^.*/", "")
    return F.nullif(F.regexp_extract(name, r"[^.]\.((?:tar\.)?[a-z0-9]+)$", 1), F.lit(""))


def padded_box(low: Column, length: Column, pad: float, limit: Column) -> tuple[Column, Column]:
    """Low and high end of a box side that is widened by a share of its length at either end: rounded half to even, and clamped to
    the image."""
    more = length * pad
    return F.greatest(F.lit(0), F.bround(low - more, 0).cast("int")), F.least(limit.cast("int"), F.bround(low + length + more, 0).cast("int"))


def class_id(label: Column, classes: list[str], ignore: int = 255) -> Column:
    """The place of a label in a list of classes; ``ignore`` for null and for what is not on it."""
    return F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(c) for c in classes)), label), F.lit(0).cast("bigint")).cast("int") - 1, F.lit(ignore))


def remapped(pixels: Column, table: list[int], ignore: int = 255) -> Column:
    """Pixels looked up in a table; ``ignore`` for values outside it."""
    lut = F.array(*(F.lit(v) for v in table))
    return F.transform(pixels, lambda v: F.coalesce(F.get(lut, v), F.lit(ignore)))
