"""Formats, units, symbols and times as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NONE = "—"


def fixed(value: Column, places: int) -> Column:
    """A number with that many places as C's printf writes it: the binary value rounded exactly, its ties to even. (format_string
    rounds the shortest decimal form half up.)"""
    one = 1 << 52
    size = F.abs(value.cast("double"))
    whole = F.floor(size)
    scaled = (size - whole) * float(one)
    bits = F.floor(scaled)
    # bits of a value below 1 that don't fit in 52 places
    more = (scaled - bits) * float(10**places)
    wide = bits * 10**places + F.floor(more)
    digits, rest = F.shiftright(wide, 52), wide.bitwiseAND(F.lit(one - 1))
    odd = (digits if places else whole).bitwiseAND(F.lit(1)) == 1
    beyond = odd | (more > F.floor(more))
    up = (rest > one // 2) | ((rest == one // 2) & beyond)
    digits = digits + up.cast("long")
    whole = whole + (digits >= 10**places).cast("long")
    text = whole.cast("string")
    if places:
        text = F.concat(text, F.lit("."), F.lpad((digits % 10**places).cast("string"), places, "0"))
    exact = F.concat(F.when(value < 0, "-").otherwise(""), text)
    return F.when(size < 1e15, exact).otherwise(F.format_string(f"%.{places}f", value))


def delta_text(current: Column, reference: Column, unit: str = "BOB", least: float = 0.005) -> Column:
    """+0.12 unit, -0.12 unit, =0.00 unit, or a dash if either value is missing."""
    d = current - reference
    size = fixed(F.abs(d), 2)
    text = F.when(F.abs(d) < least, F.lit(f"=0.00 {unit}")).when(d > 0, F.concat(F.lit("+"), size, F.lit(f" {unit}"))).otherwise(F.concat(F.lit("-"), size, F.lit(f" {unit}")))
    return F.when(d.isNotNull(), text).otherwise(NONE)


def _comma(value: Column, places: int) -> Column:
    return F.replace(fixed(value, places), F.lit("."), F.lit(","))


def short_amount(value: Column, currency: str = "Bs") -> Column:
    """Bs 25,0 M; Bs 30 mil; Bs 12; Bs 12,50: a decimal comma, millions and thousands named."""
    text = F.when(value >= 1e6, F.concat(_comma(value / 1e6, 1), F.lit(" M"))).when(value >= 1e3, F.concat(F.bround(value / 1e3).cast("long").cast("string"), F.lit(" mil")))
    text = text.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(_comma(value, 2))
    return F.when(value.isNotNull(), F.concat(F.lit(f"{currency} "), text))


def visits_text(n: Column) -> Column:
    """3,247, or a dash."""
    return F.coalesce(F.format_number(n, 0), F.lit(NONE))


def percent_text(value: Column) -> Column:
    """+1,25%, -1,25% or 0,00%, or a dash."""
    return F.when(value.isNotNull(), F.concat(F.when(value > 0, "+").otherwise(""), _comma(value, 2), F.lit("%"))).otherwise(NONE)


def volume_text(value: Column) -> Column:
    """US$ 1,2 B, US$ 3 M, US$ 4 K or US$ 5, or a dash for nothing."""
    text = F.when(value >= 1e9, F.concat(_comma(value / 1e9, 1), F.lit(" B"))).when(value >= 1e6, F.concat(F.round(value / 1e6).cast("long").cast("string"), F.lit(" M")))
    text = text.when(value >= 1e3, F.concat(F.round(value / 1e3).cast("long").cast("string"), F.lit(" K"))).otherwise(F.round(value).cast("long").cast("string"))
    return F.coalesce(F.when(value > 0, F.concat(F.lit("US$ "), text)), F.lit(NONE))


def normalised_units(rows: DataFrame, units: DataFrame, unit: str, value: str, factor: str) -> DataFrame:
    """rows with price and price_unit. units (unit, own_unit, lo, hi) is a small table: a unit with own_unit isn't a mass and keeps its
    value; others become prices per kg by the row's factor, which must lie in lo..hi where these are given. A mass without a
    factor, or one out of range, is an error."""
    known = F.broadcast(units.select(F.col("unit").alias("__unit"), "own_unit", "lo", "hi"))  # a list of units
    both = rows.join(known, F.col(unit) == F.col("__unit"), "left")
    f = F.col(factor)
    wrong = f.isNull() | (F.col("lo").isNotNull() & ~f.between(F.col("lo"), F.col("hi")))
    bad = F.raise_error(F.concat(F.lit("no good factor for unit "), F.coalesce(F.col(unit), F.lit("NULL")))).cast("double")
    price = F.when(F.col("own_unit").isNotNull(), F.col(value)).when(wrong, bad).otherwise(F.col(value) * f)
    return both.select(*[rows[c] for c in rows.columns], F.round(price, 2).alias("price"), F.coalesce("own_unit", F.lit("kg")).alias("price_unit"))


def per_tonne(value: Column, unit: Column) -> Column:
    """A price per kg or per tonne as one per tonne; any other unit is an error."""
    bad = F.raise_error(F.concat(F.lit("neither per kg nor per tonne: "), F.coalesce(unit, F.lit("NULL")))).cast("double")
    return F.when(F.contains(unit, F.lit("/kg")), value * 1000).when(F.contains(unit, F.lit("/mt")), value).otherwise(bad)


def symbol_class(symbol: Column, venue: Column, lists: dict[str, list[str]], with_venue: str = "stocks", without: str = "crypto") -> Column:
    """The class of the first list that has the upper-case symbol, else by whether it has a venue."""
    name, out = F.upper(symbol), None
    for kind, members in lists.items():
        hit = name.isin(members)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    rest = F.when(F.coalesce(venue, F.lit("")) == "", without).otherwise(with_venue)
    return rest if out is None else out.otherwise(rest)


def display_name(symbol: Column, names: dict[str, str]) -> Column:
    """The symbol's name; of a thousand-fold symbol (kABC) that of ABC with (x1000); of A-B or A/B that of A; else itself."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    upper = F.upper(symbol)
    thousand = F.when(symbol.rlike("^k[A-Z]"), table[F.substring(upper, 2, 1000)])
    return F.coalesce(table[upper], F.concat(thousand, F.lit(" (x1000)")), table[F.regexp_replace(upper, "[-_/].*$", "")], symbol)


def zoned_time(text: Column, zone: str = "Europe/Berlin") -> Column:
    """dd/MM/yy HH:mm:ss on a named zone's clock as UTC; NULL for anything else."""
    local = F.try_to_timestamp(F.when(text.rlike("^ *[0-9]{2}/[0-9]{2}/[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}"), F.substring(F.trim(text), 1, 17)), F.lit("dd/MM/yy HH:mm:ss"))
    return F.to_utc_timestamp(local, zone)


def ring_lines(shapes: DataFrame) -> DataFrame:
    """name, lon, lat: the rings (arrays of [lon, lat]) of each shape as two flat arrays, with NULL between rings."""
    gap = F.array(F.lit(None).cast("double"))

    def flat(k: int) -> Column:
        joined = F.aggregate("rings", F.array().cast("array<double>"), lambda acc, ring: F.concat(acc, F.transform(ring, lambda p: p[k]), gap))
        return F.slice(joined, F.lit(1), F.greatest(F.size(joined) - 1, F.lit(0)))

    return shapes.select("name", flat(0).alias("lon"), flat(1).alias("lat"))
