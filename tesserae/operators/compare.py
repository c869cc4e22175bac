"""Comparisons under like conditions: units on one scale, banded joins, outcomes between subjects, and their ranks.

Two measurements are comparable if they agree in some columns and differ by at most a band in each numeric condition.
Measurements are first counted by subject, conditions and value, so copies are one row.  The banded join then gives
each row a bin of twice the band's width in each condition; the other side takes the one or two bins that its band
reaches, and the difference itself is checked.  Outcomes are counted by pairs of subjects as they are joined.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import staged
from .skew import HEAVY, salted_join

CROWD = 1_000  # rows that agree in the exact columns and are compared with each other without bins

# Units, what they measure, and the factor and summand that bring them to the base unit.
UNITS = {
    "K": ("temperature", 1.0, 0.0), "°C": ("temperature", 1.0, 273.15), "C": ("temperature", 1.0, 273.15), "°F": ("temperature", 5 / 9, 459.67 * 5 / 9),
    "s": ("time", 1.0, 0.0), "sec": ("time", 1.0, 0.0), "min": ("time", 60.0, 0.0), "h": ("time", 3600.0, 0.0), "hr": ("time", 3600.0, 0.0), "d": ("time", 86400.0, 0.0),
    "Pa": ("pressure", 1.0, 0.0), "kPa": ("pressure", 1e3, 0.0), "MPa": ("pressure", 1e6, 0.0), "bar": ("pressure", 1e5, 0.0), "atm": ("pressure", 101325.0, 0.0), "psi": ("pressure", 6894.757, 0.0),
    "V": ("potential", 1.0, 0.0), "mV": ("potential", 1e-3, 0.0),
    "A/cm2": ("current density", 1e4, 0.0), "mA/cm2": ("current density", 10.0, 0.0), "A/m2": ("current density", 1.0, 0.0),
    "g": ("mass", 1e-3, 0.0), "mg": ("mass", 1e-6, 0.0), "kg": ("mass", 1.0, 0.0),
    "mL/min": ("flow", 1e-6 / 60, 0.0), "L/min": ("flow", 1e-3 / 60, 0.0), "L/h": ("flow", 1e-3 / 3600, 0.0),
    "M": ("concentration", 1e3, 0.0), "mM": ("concentration", 1.0, 0.0), "mol/L": ("concentration", 1e3, 0.0), "mol/m3": ("concentration", 1.0, 0.0),
    "%": ("share", 1e-2, 0.0), "ppm": ("share", 1e-6, 0.0),
}
_NUMBER = r"^\s*([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)\s*(.*?)\s*$"


def measured(text: Column | str) -> Column:
    """struct(kind, number) of a number with its unit, in the base unit of its kind.

    Spellings with ``cm-2``, ``min-1`` and the like count as those with a slash.  A unit that is not known is a kind of its own, a bare
    number has the kind ``""``; text that begins with no number gives null.
    """
    text = F.regexp_replace(F.col(text) if isinstance(text, str) else text, "[−–]", "-")
    unit = F.regexp_replace(F.regexp_extract(text, _NUMBER, 2), "(?i)[ ·]+(cm|m|min|h|L)-([123]?)$", "/$1$2")
    unit = F.regexp_replace(F.regexp_replace(unit, "/(min|h|L)1$", "/$1"), "^℃$", "°C")
    known = F.create_map(*chain.from_iterable((F.lit(u), F.struct(F.lit(k).alias("kind"), F.lit(f).alias("factor"), F.lit(s).alias("summand"))) for u, (k, f, s) in UNITS.items()))
    scale = F.try_element_at(known, unit)
    number = F.nullif(F.regexp_extract(text, _NUMBER, 1), F.lit("")).cast("double")
    made = F.struct(F.coalesce(scale["kind"], unit).alias("kind"), F.when(scale.isNull(), number).otherwise(number * scale["factor"] + scale["summand"]).alias("number"))
    return F.when(number.isNotNull(), made)


def with_conditions(rows: DataFrame, conditions: str, names: list[str]) -> DataFrame:
    """``rows`` with, for each name, the number of that condition on its base scale and ``<name>_kind``; null where it is absent."""
    for name in names:
        value = measured(F.try_element_at(F.col(conditions), F.lit(name)))
        rows = rows.withColumns({name: value["number"], f"{name}_kind": value["kind"]})
    return rows


def metric_points(nodes: dict[str, DataFrame], edge_tables: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """(point, paper_uid, subject, reaction, property, value, value_kind, conditions...) of the metrics of a graph's instance layer.

    A metric's conditions are those of its operating point, and where that has none those of the dataset.
    """
    pick = lambda kind, a, b: edge_tables[kind].select(F.col("source").alias(a), F.col("target").alias(b))
    value = measured(F.concat_ws(" ", "value", "unit"))
    m = nodes["Metric"].select(F.col("uid").alias("point"), "paper_uid", F.lower(F.trim("property_name")).alias("property"), value.alias("v"))
    m = m.select("point", "paper_uid", "property", F.col("v.number").alias("value"), F.col("v.kind").alias("value_kind"))
    m = m.join(pick("FOR_CATALYST", "point", "subject"), "point").join(pick("UNDER_REACTION", "point", "reaction"), "point")
    at = nodes["OperatingPoint"].select(F.col("uid").alias("op"), F.col("point_conditions").alias("__point"))
    under = nodes["PerformanceDataset"].select(F.col("uid").alias("perf"), F.col("common_conditions").alias("__common"))
    at = at.join(pick("HAS_OPERATING_POINT", "perf", "op"), "op").join(under, "perf", "left")
    none = F.expr("map()").cast("map<string,string>")
    at = at.select("op", F.map_concat(F.map_filter(F.coalesce("__common", none), lambda k, _: ~F.array_contains(F.map_keys(F.coalesce(F.col("__point"), none)), k)), F.coalesce("__point", none)).alias("__conditions"))
    out = m.join(pick("HAS_METRIC", "op", "point"), "point").join(at, "op")
    return with_conditions(out, "__conditions", names).drop("__conditions", "op")


def crowded(rows: DataFrame, exact: list[str], crowd: int | None = None) -> DataFrame:
    """The values of ``exact`` that more than ``crowd`` rows share: one for ``crowd`` rows at most."""
    return staged(rows.groupBy(*exact).agg(F.count("*").alias("__n")).where(F.col("__n") > (CROWD if crowd is None else crowd)).select(*exact), "crowded")


def paired(points: DataFrame, names: dict[str, str], exact: list[str], bands: dict[str, float], heavy: int = HEAVY, hot: DataFrame | None = None) -> DataFrame:
    """``banded`` of a table with itself; ``names`` are the right side's columns.

    Where few rows agree in ``exact``, they are shuffled by it once and compared with each other; those of ``hot`` (by
    default ``crowded``) take bins.
    """
    if not exact:
        return banded(points, points.withColumnsRenamed(names), exact, bands, heavy)
    for c in exact:
        points = points.where(F.col(c).isNotNull())
    for c in bands:
        points = points.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    hot = F.broadcast(crowded(points, exact) if hot is None else hot)
    few = points.join(hot, exact, "left_anti").repartition(*exact)
    near = few.join(few.withColumnsRenamed(names), exact)
    for c, band in bands.items():
        near = near.where(F.abs(F.col(c) - F.col(names[c])) <= band)
    many = points.join(hot, exact, "left_semi")
    return near.unionByName(banded(many, many.withColumnsRenamed(names), exact, bands, heavy))


def banded(left: DataFrame, right: DataFrame, exact: list[str], bands: dict[str, float], heavy: int = HEAVY) -> DataFrame:
    """Pairs of rows that agree in ``exact`` and whose numbers in ``bands`` differ by at most the band.

    Apart from ``exact`` the two tables' columns have different names: the right one's numbers are called ``<name>_b``.
    Rows with a null, or a number that is none, in one of these columns have no partner.  Each condition at most
    doubles the right side.
    """
    bins = [f"__bin_{c}" for c in bands]
    for c, band in bands.items():
        width, reach = 2 * band * (1 + 1e-6), band * (1 + 1e-9)  # a bin is wider than what a number reaches, so two of them do
        number = F.col(f"{c}_b").cast("double")
        edge = lambda x: F.floor(x / width)
        left = left.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))).withColumn(f"__bin_{c}", edge(F.col(c).cast("double")))
        right = right.where(F.col(f"{c}_b").isNotNull() & ~F.isnan(number)).withColumn(f"__bin_{c}", F.explode(F.array_distinct(F.array(edge(number - reach), edge(number + reach)))))
    near = salted_join(left, right, [*exact, *bins], heavy)
    for c, band in bands.items():
        near = near.where(F.abs(F.col(c) - F.col(f"{c}_b")) <= band)
    return near.drop(*bins)


def comparable(points: DataFrame, key: str, exact: list[str], bands: dict[str, float], other: str | None = None, heavy: int = HEAVY) -> DataFrame:
    """COMPARABLE_TO edges (source, target) between points under like conditions, the smaller key first.

    With ``other``, such as the paper, only points that differ in it are linked.
    """
    rest = [*bands, *([other] if other else [])]
    a = points.select(F.col(key).alias("source"), *exact, *rest)
    near = paired(a, {"source": "target", **{c: f"{c}_b" for c in rest}}, exact, bands, heavy).where("source < target")
    if other:
        near = near.where(F.col(other) != F.col(f"{other}_b"))
    return near.select("source", "target").distinct().withColumn("edge_type", F.lit("COMPARABLE_TO"))


def outcomes(points: DataFrame, subject: str, value: str, exact: list[str], bands: dict[str, float], by: list[str] | None = None, margin: float = 0.0, higher: bool = True, heavy: int = HEAVY) -> DataFrame:
    """(by..., a, b, wins, losses, ties) of subjects a < b over all their comparable measurements.

    A measurement wins if it is better by more than ``margin`` times the larger of the two sizes; lower ones are better
    without ``higher``.  Measurements without a value, a subject or a condition take no part.
    """
    by = by or []
    of = points.where(F.col(value).isNotNull() & F.col(subject).isNotNull()).select(F.col(subject).alias("a"), F.col(value).alias("__va"), *exact, *bands)
    each = of.groupBy(*of.columns).agg(F.count("*").alias("__na"))
    near = paired(each, {"a": "b", "__va": "__vb", "__na": "__nb", **{c: f"{c}_b" for c in bands}}, exact, bands, heavy, crowded(of, exact) if exact else None).where("a < b")
    gap = (F.col("__va") - F.col("__vb")) * (1 if higher else -1)
    least = F.greatest(F.abs("__va"), F.abs("__vb")) * margin
    n = F.col("__na") * F.col("__nb")
    count = lambda test: F.coalesce(F.sum(F.when(test, n)), F.lit(0))
    return near.groupBy(*by, "a", "b").agg(count(gap > least).alias("wins"), count(-gap > least).alias("losses"), count(F.abs(gap) <= least).alias("ties"))


def outperforms(games: DataFrame, least: int = 1) -> DataFrame:
    """OUTPERFORMS edges (source, target, wins, losses, ties): the subject that wins more of at least ``least`` comparisons, to the other."""
    keys = [c for c in games.columns if c not in ("a", "b", "wins", "losses", "ties")]
    sides = [games.select(*keys, F.col(s).alias("source"), F.col(t).alias("target"), F.col(w).alias("wins"), F.col(lo).alias("losses"), "ties") for s, t, w, lo in (("a", "b", "wins", "losses"), ("b", "a", "losses", "wins"))]
    both = sides[0].unionByName(sides[1])
    return both.where((F.col("wins") > F.col("losses")) & (F.col("wins") + F.col("losses") + F.col("ties") >= least)).withColumn("edge_type", F.lit("OUTPERFORMS"))


def strengths(games: DataFrame, rounds: int = 20, prior: float = 1.0) -> DataFrame:
    """(subject, strength, games): strengths whose ratios are the odds of the subjects' outcomes.

    Each round sets a subject's strength to its wins (a tie is half a win) over the sum of n / (own + other's strength)
    over its opponents, with n games each.  ``prior`` wins and losses against a made-up subject of strength 1 keep
    strengths finite and comparable between parts of the graph that no game links.  The games are staged once, the
    strengths after each round.
    """
    total = F.col("wins") + F.col("losses") + F.col("ties")
    sides = [games.select(F.col(s).alias("subject"), F.col(o).alias("other"), (F.col(w) + F.col("ties") / 2).alias("won"), total.alias("n")) for s, o, w in (("a", "b", "wins"), ("b", "a", "losses"))]
    table = staged(sides[0].unionByName(sides[1]).groupBy("subject", "other").agg(F.sum("won").alias("won"), F.sum("n").alias("n")), "games")
    own = table.groupBy("subject").agg(F.sum("won").alias("won"), F.sum("n").alias("games")).withColumn("strength", F.lit(1.0))
    now = staged(own, "strengths")
    for _ in range(rounds):
        met = table.select("subject", "other", "n").join(now.select(F.col("subject").alias("other"), F.col("strength").alias("__other")), "other")
        met = met.join(now.select("subject", "strength"), "subject")
        load = met.groupBy("subject").agg(F.sum(F.col("n") / (F.col("strength") + F.col("__other"))).alias("load"))
        new = (F.col("won") + prior) / (F.col("load") + 2 * prior / (F.col("strength") + 1))
        now = staged(now.join(load, "subject").withColumn("strength", new).drop("load"), "strengths")
    return now.select("subject", "strength", "games")
