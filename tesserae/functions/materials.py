"""Canonical names of materials: an ordered set of native rules over a catalyst's fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import any_of, clean, first_case, first_text, list_or_empty, literal_map, lookup, or_null, staged, text_or_empty

# Supports and their spellings, label sets, and the patterns of controls, loadings and shapes.
SUPPORTS = {
    "al2o3": "Al2O3", "alumina": "Al2O3", "gamma-al2o3": "Al2O3", "gamma alumina": "Al2O3", "γ-al2o3": "Al2O3", "gamma-alumina": "Al2O3",
    "sio2": "SiO2", "silica": "SiO2", "tio2": "TiO2", "titania": "TiO2", "zro2": "ZrO2", "zirconia": "ZrO2",
    "ceo2": "CeO2", "ceria": "CeO2", "mgo": "MgO", "magnesia": "MgO", "zno": "ZnO", "zeolite": "zeolite",
}
GENERIC_LABELS = ["c", "carbon", "char", "carbon support"]
GENERIC_SUPPORTS = ["c", "carbon", "char"]
BROAD_NAMES = ["coal", "coke", "biochar", "co-pyrolysis-char", "co-pyrolysis char", "ni/char"]
BARE_SUPPORTS = ["al2o3", "sio2", "tio2", "zro2", "ceo2", "mgo", "zno", "activated carbon", "cnt", "graphene", "biochar", "zeolite"]
NO_CATALYST = ["no catalyst", "no-catalyst", "no_catalyst", "blank", "non-catalytic control", "no-catalyst blank"]
OVER_ALUMINA = ["calcium aluminate", "cordierite", "cordierite monolith", "Al2O3-coated cordierite", "Al2O3-coated ceramic honeycomb"]
EXACT_CARBONS = [
    "raw coal", "edta-inhibited coal", "pyrolyzed coal", "biochar", "acid-washed biochar", "activated carbon",
    "coal char", "wheat straw char", "coke in the cracking zones",
]
CONTROL = (
    r"(?iu)^(?:no catalyst|without catalyst|absence of(?: the)? catalyst|uncatalyzed(?: condition)?|non-catalytic(?: condition)?|"
    r"blank test without catalyst|control without catalyst|none)$"
)
LOADING = r"(?iu)^\d+(?:\.\d+)?\s*(?:wt|mol|at|vol)?\.?\s*%?\s*"
SHAPE = r"(?iu)[\-_\s](?:rod|sphere|cube|wire|sheet|tube|flower|star|plate|film|foam|fiber|needle|hollow|porous|mesoporous|core\.shell|yolk\.shell)s?\b"
SUPPORTED_METAL, BULK_OXIDE = "supported_metal_nanoparticles", "metal_oxides_hydroxides_oxyhydroxides"


def active_text(x: Column | str) -> Column:
    """The name without a leading loading and without shape words."""
    return clean(F.regexp_replace(F.regexp_replace(clean(x), LOADING, ""), SHAPE, ""))


def support_name(x: Column | str) -> Column:
    s = clean(x)
    low = F.lower(s)
    alumina = any_of(low, ["al2o3", "alumina"])
    plain = F.regexp_replace(low, "[γαβ]-", "")
    return first_case(
        [
            (s == "", ""),
            (low.contains("activated carbon") | (low == "ac"), "activated carbon"),
            (low.contains("carbon nanotube") | (low == "cnt"), "CNT"),
            (low.contains("graphene"), "graphene"),
            (low.contains("cordierite") & alumina, "Al2O3-coated cordierite"),
            (low.contains("cordierite monolith"), "cordierite monolith"),
            (low.contains("cordierite"), "cordierite"),
            (low.contains("ceramic honeycomb") & alumina, "Al2O3-coated ceramic honeycomb"),
            (low.contains("calcium aluminate"), "calcium aluminate"),
            (low.contains("montmorillonite"), "montmorillonite"),
            (low.contains("sba-15") & low.contains("zr"), "ZrO2-SBA-15"),
        ],
        F.coalesce(F.try_element_at(literal_map(SUPPORTS), plain), s),
    )


def is_control(name: Column | str) -> Column:
    return clean(name).rlike(CONTROL)


def temperature(x: Column | str) -> Column:
    """``450C`` of ``calcined at 450 °C``; empty if there is none."""
    got = F.regexp_extract(text_or_empty(x), r"(?iuU)(\d{3,4})\s*(?:°|º)?\s*C\b", 1)
    return F.when(got != "", F.concat(got, F.lit("C"))).otherwise("")


def carbon_variant() -> Column:
    """The temperature that tells one char from another: from the variant, a numbered name, the name, the aliases."""
    rule = F.lower(clean("variant_rule"))
    by_rule = F.when(any_of(rule, ["pyrolysis", "carbonization"]), temperature(clean("variant_value")))
    number = F.regexp_extract(clean("name_reported"), r"(?iuU)(?:de-)?char[-_ ]?(\d{3,4})\b", 1)
    direct = F.when(number != "", F.concat(number, F.lit("C")))
    return first_text(by_rule, direct, temperature(clean("name_reported")), temperature(F.array_join(list_or_empty("aliases"), " ")))


def _carbon_base() -> Column:
    """The kind of carbon, from the lower-cased fields ``__fields`` and their join ``__joined``; empty if none."""
    j = F.col("__joined")
    field = lambda test: F.exists("__fields", test)
    has = lambda *parts: any_of(j, parts)
    char = has("char")
    return first_case(
        [
            (field(lambda f: (f == "ac") | f.contains("activated carbon")), "activated carbon"),
            (has("acid-washed biochar"), "acid-washed biochar"),
            (has("biochar"), "biochar"),
            (has("peat char activated by koh"), "KOH-activated peat char"),
            (has("peat char activated by co2"), "CO2-activated peat char"),
            (has("peat char"), "peat char"),
            (field(lambda f: (f == "cnt") | f.contains("carbon nanotube")), "CNT"),
            (has("graphene"), "graphene"),
            (has("carbon black"), "carbon black"),
            (has("carbon cloth"), "carbon cloth"),
            (has("unburned carbon", "fly ash", "flyash"), "unburned carbon in fly ash"),
            (has("coal coke"), "coal coke"),
            (field(lambda f: f == "coal"), "coal"),
            (has("petroleum coke", "oil coke"), "petroleum coke"),
            (has("co-pyrolysis") & char, "co-pyrolysis char"),
            (has("demineralized oil shale char", "de-char"), "demineralized oil shale char"),
            (has("oil shale char") | j.rlike(r"(?U)\bchar-\d{3,4}\b"), "oil shale char"),
            *[(has(kind) & char, f"{kind} char") for kind in ("brown coal", "bituminous coal", "anthracite", "biomass", "coal")],
            (j.rlike(r"(?U)\bchar\b"), "char"),
            (j.rlike(r"(?U)\bcoke\b"), "coke"),
        ],
        "",
    )


def _with_variant(base: Column) -> Column:
    return F.when(F.col("__variant") != "", F.concat(base, F.lit("@"), F.col("__variant"))).otherwise(base)


def with_carbon(df: DataFrame) -> DataFrame:
    """Adds ``__carbon``, the specific carbon material that a catalyst's fields name, or empty."""
    texts = F.concat(F.array(clean("name_reported"), clean("substrate_or_support"), clean("series_name")), F.transform(list_or_empty("aliases"), clean))
    name = F.col("__name_low")
    co = F.when(name.contains("acid washed wheat straw"), "co-pyrolysis char from acid-washed wheat straw/coal")
    co = co.when(name.contains("raw wheat straw"), "co-pyrolysis char from raw wheat straw/coal").otherwise(_with_variant(F.lit("co-pyrolysis char")))
    base = F.col("__base")
    return staged(
        df,
        {"__fields": F.filter(F.transform(texts, F.lower), lambda f: f != ""), "__name_low": F.lower(clean("name_reported")), "__variant": carbon_variant()},
        {"__joined": F.array_join("__fields", " | ")},
        {"__base": _carbon_base()},
        {
            "__carbon": first_case(
                [
                    (F.col("__joined") == "", ""),
                    (name.isin(EXACT_CARBONS), name),
                    (name.startswith("co-pyrolysis char"), co),
                    (base.contains("char"), _with_variant(base)),
                ],
                base,
            )
        },
    ).drop("__fields", "__joined", "__base", "__variant", "__name_low")


def _active(name: Column) -> Column:
    return F.when(name.contains("/"), clean(F.substring_index(name, "/", 1))).otherwise(name)


def _support(name: Column) -> Column:
    return F.when(name.contains("/"), clean(F.substring(name, F.instr(name, "/") + 1, F.length(name)))).otherwise("")


def _slash(a: Column, b: Column) -> Column:
    return F.concat(a, F.lit("/"), b)


def replaces(current: Column, raw: Column) -> Column:
    """Whether the reported support takes the place of the one in the name."""
    return first_case(
        [
            (raw == "", F.lit(False)),
            (current == "", F.lit(True)),
            (F.lower(support_name(current)) == F.lower(support_name(raw)), F.lit(False)),
            (F.lower(current).isin(GENERIC_SUPPORTS), F.lit(True)),
        ],
        (current == "Al2O3") & raw.isin(OVER_ALUMINA),
    )


def with_rule_name(df: DataFrame) -> DataFrame:
    """Adds ``__rule``: the canonical name by rules alone, from name, support and carbon material."""
    name, raw, carbon = F.col("__active"), F.col("__raw_support"), F.col("__carbon")
    own = F.col("__own_support")
    slashed = first_text(support_name(own), raw, own)
    return staged(
        with_carbon(df),
        {"__active": active_text("name_reported"), "__raw_support": support_name("substrate_or_support"), "__control": is_control("name_reported")},
        {"__own_support": _support(F.col("__active"))},
        {
            "__rule": first_case(
                [
                    (F.col("__control"), "no_catalyst"),
                    (name.contains("/"), F.when(slashed != "", _slash(_active(name), slashed)).otherwise(_active(name))),
                    (carbon != "", carbon),
                    ((raw != "") & (name != "") & (F.lower(name) != F.lower(raw)) & name.rlike(r"^[A-Za-z0-9\-\+\.\(\)]+\z"), _slash(name, raw)),
                ],
                first_text(name, raw, F.lit("unknown")),
            )
        },
    ).drop("__own_support")


def with_canonical_name(df: DataFrame, given: str | None = None, out: str = "canonical") -> DataFrame:
    """Adds ``out``: the given canonical name, or the rules' one, checked against the catalyst's fields.

    A blank name falls back to the rules.  Then, in order: controls; generic carbon labels without the
    carbon platform; a bare support for a supported metal; a metal/support form for a bulk oxide without
    a support; a specific carbon in the place of a generic one; the reported support in the place of a
    generic one; and inert diluents of co-precipitated catalysts.
    """
    df = with_rule_name(df)
    platforms = list_or_empty("labels_material_platform")
    on = lambda p: F.array_contains(platforms, p)
    given_or_rule, c2, c3 = F.col("__c1"), F.col("__c2"), F.col("__c3")
    carbon, raw = F.col("__carbon"), F.col("__raw_support")
    name = text_or_empty("name_reported")
    generic = GENERIC_LABELS + BROAD_NAMES
    bulk = c2.contains("/") & ~on(SUPPORTED_METAL) & on(BULK_OXIDE)
    unsupported = (clean("substrate_or_support") == "") & ~name.contains("/")
    a, s, low = F.col("__a"), F.col("__s"), F.lower(c3)
    final = first_case(
        [
            (F.col("__control") | F.lower(given_or_rule).isin(NO_CATALYST), "no_catalyst"),
            (F.lower(given_or_rule).isin(GENERIC_LABELS) & ~on("carbon_based"), F.col("__rule")),
            ((carbon != "") & (s != "") & F.lower(s).isin(GENERIC_SUPPORTS + generic), _slash(a, carbon)),
            ((carbon != "") & (s == "") & (low != F.lower(carbon)), carbon),
            ((carbon != "") & low.isin(generic), carbon),
            ((s != "") & (raw != "") & replaces(s, raw), _slash(a, raw)),
            ((s != "") & raw.isin("sand", "quartz", "quartz sand") & F.lower(name).contains("coprecipitated"), F.col("__active")),
        ],
        c3,
    )
    return staged(
        df,
        {"__c1": first_text(clean(given), "__rule") if given else F.col("__rule")},
        {"__c2": F.when(F.lower(given_or_rule).isin(BARE_SUPPORTS) & on(SUPPORTED_METAL), F.col("__rule")).otherwise(given_or_rule)},
        {"__c3": F.when(bulk & unsupported, F.col("__rule")).otherwise(c2)},
        {"__a": _active(c3), "__s": _support(c3)},
        {out: final},
    ).drop("__c1", "__c2", "__c3", "__a", "__s", "__active", "__raw_support", "__control", "__rule", "__carbon")


# --- the alternative normaliser: name, support and platforms only ---------------------------------

# Its support spellings, its names for runs without a catalyst, and its patterns.
SHORT_SUPPORTS = {
    "al2o3": "Al2O3", "alumina": "Al2O3", "γ-al2o3": "Al2O3", "gamma-al2o3": "Al2O3", "δ-al2o3": "Al2O3", "alpha-al2o3": "Al2O3",
    "α-al2o3": "Al2O3", "pseudo-boehmite": "Al2O3", "γ-alumina": "Al2O3", "γ-alumina (pseudo-boehmite)": "Al2O3",
    "sio2": "SiO2", "silica": "SiO2", "silica gel": "SiO2", "tio2": "TiO2", "titania": "TiO2", "zro2": "ZrO2", "zirconia": "ZrO2",
    "ceo2": "CeO2", "ceria": "CeO2", "mgo": "MgO", "magnesia": "MgO", "zno": "ZnO",
    "c": "C", "carbon": "C", "activated carbon": "C", "ac": "C", "carbon black": "C",
    "cnt": "CNT", "carbon nanotube": "CNT", "carbon nanotubes": "CNT", "carbon nanotubes (cnts)": "CNT",
    "graphene": "graphene", "zeolite": "zeolite", "ni foam": "Ni-foam", "carbon cloth": "carbon-cloth", "biochar": "biochar",
}
BLANKS = [
    "no catalyst", "uncatalyzed", "uncatalyzed condition", "non-catalytic", "absence of the catalyst", "blank", "blank test without catalyst",
    "none catalyst", "no catalyst used", "thermal cracking without catalyst", "non-catalytic thermal cracking",
]
OXIDES = ["cao", "mgo", "al2o3", "tio2", "sio2", "zro2", "ceo2", "zno", "fe2o3", "fe3o4", "cr2o3", "mno2", "cuo", "cu2o"]
_STATE = r"(?iu)^(?:pre[\-\s]?sulph?ided|bare|raw|fresh|spent|calcined|reduced|dried|wet|dry|nano|commercial|industrial)\s+"
_LOAD = r"(?iu)^\d+[\.\d]*\s*(?:wt|mol|at|vol)?\.?\s*%?\s*[-–]?\s*"
_FORM = (
    r"(?iu)[\s\-_](?:nano(?:rod|wire|sheet|tube|flower|particle|frame|cube|sphere|crystal)s?|rod|sphere|cube|wire|sheet|tube|flower|star|plate|film|foam"
    r"|fiber|needle|hollow|porous|mesoporous|core[\.\-]shell|yolk[\.\-]shell|multiple[\-\s]pin|external[\-\s]branch"
    r"|pellet|powder|granule|bead|monolith|crushed|extruded|ground)s?\b"
)


def short_support(x: Column | str) -> Column:
    bare = F.trim(F.regexp_replace(F.lower(F.trim(text_or_empty(x))), r"\([^)]*\)", ""))
    return lookup(F.regexp_replace(bare, "^(?:γ|α|β|delta|gamma|alpha|beta)-", ""), SHORT_SUPPORTS)


def _group(x: Column, pattern: str, n: int = 1) -> Column:
    """A regex group, null where the pattern does not match."""
    return F.when(x.rlike(pattern), F.regexp_extract(x, pattern, n))


def with_short_name(df: DataFrame, out: str = "canonical_name") -> DataFrame:
    """Adds ``out`` by the alternative rules over name_reported, substrate_or_support, labels_material_platform."""
    name, support = F.trim(text_or_empty("name_reported")), text_or_empty("substrate_or_support")
    low, low_support = F.lower(name), F.lower(support)
    on = lambda p: F.array_contains(list_or_empty("labels_material_platform"), p)
    either = lambda text: low.contains(text) | low_support.contains(text)
    blank = low.isin([*BLANKS, "ap"]) | low.startswith("no ") | any_of(low, ["without catalyst", "non-catalytic"])
    species = _group(name, r"^([A-Z][a-z]+\s+[a-z]+)")
    bio = F.coalesce(species, _group(name, r"^([A-Z][a-z]+)"), F.when(low.contains("lipase"), "lipase"), F.when(low.contains("sludge"), "anaerobic-sludge"), name)
    char = first_case(
        [
            (either("oil shale"), "oil-shale-char"),
            (either("coal"), "coal-char"),
            (low.contains("biomass"), "biomass-char"),
            (any_of(low, ["anthracite", "bituminous"]), "coal-char"),
            (low.contains("graphite"), "graphite-char"),
        ],
        "char",
    )
    coke = first_case([(either("coal coke"), "coal-coke"), (low_support.contains("oil coke"), "oil-coke")], "coke")
    carbon = F.coalesce(
        F.when(any_of(low, ["co-pyrolysis", "co_pyrolysis"]), "co-pyrolysis-char"),
        F.when(low.contains("char"), char),
        F.when(low.contains("activated carbon"), "activated-carbon"),
        F.when(low.contains("coke"), coke),
        F.when(low.contains("coal"), "coal"),
        F.when(low.contains("carbon"), "carbon"),
    )
    plain_carbon = on("carbon_based") & ~on(SUPPORTED_METAL) & ~on("composites_heterostructures")
    ion = _group(low, r"^amberly[ti]e?\s+(\w+)")
    dowex = _group(low, r"^dowex\s+(\w+)")
    metal = _group(low, r"modified with\s+(\w+)")
    named = F.coalesce(
        F.when(blank, "__no_catalyst__"),
        F.when(on("bio_biocatalyst_immobilized"), bio),
        F.when(plain_carbon, carbon),
        F.concat(F.lit("Amberlyst-"), _group(low, r"^(?:crushed|wet|dry|ground)?\s*amberlyst\s*(\d+)")),
        F.when(any_of(low, ["amberlyte", "amberlite"]), F.coalesce(F.concat(F.lit("Amberlite-"), F.upper(ion)), F.lit("Amberlite"))),
        F.when(low.contains("dowex"), F.coalesce(F.concat(F.lit("Dowex-"), dowex), F.lit("Dowex"))),
        F.when(low.contains("nafion"), "Nafion"),
        F.when(low.contains("montmorillonite"), F.coalesce(F.concat(F.initcap(metal), F.lit("/montmorillonite")), F.lit("montmorillonite"))),
        F.when(low.isin(OXIDES), F.regexp_replace(name, "[γαβ]-", "")),
        F.when(low == "dolomite", "dolomite"),
        F.when(low.isin("calcined olivine", "olivine"), "olivine"),
        F.when(low.contains("hydrated lime") | (low == "ca(oh)2"), "Ca(OH)2"),
        F.when(low.contains("quartz"), "quartz"),
        F.when(low.isin("calcium in flyash", "flyash"), "flyash"),
        F.when(low == "pellets", name),
    )
    cleaned = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(name, _STATE, ""), _LOAD, ""), _FORM, ""), r"(?iu)\s+catalyst$", "")
    c, sup = F.col("__c"), F.col("__sup")
    clow, cup = F.lower(c), F.upper(c)
    unload = lambda x: F.regexp_replace(F.trim(x), _LOAD, "")
    on_form = r"(?iu)^(.+?)\s+(?:supported\s+)?on\s+(.+)$"
    on_support = short_support(F.regexp_extract(c, on_form, 2))
    on_active = unload(F.regexp_extract(c, on_form, 1))
    slash_support = F.trim(_group(c, r"^([^/]+)/(.+)$", 2))
    zeolite = first_case(
        [
            (any_of(cup, ["ZSM-5", "ZSM5"]) & cup.contains("H"), "HZSM-5"),
            (any_of(cup, ["ZSM-5", "ZSM5"]), "ZSM-5"),
            (cup.contains("USY"), "USY"),
            ((cup == "Y") | any_of(cup, ["DEAL-Y", "DEALY"]), "deAl-Y"),
            (cup.contains("ZEOLITE"), "zeolite"),
        ],
        F.lit(None).cast("string"),
    )
    elements = F.array_join(F.regexp_extract_all(c, F.lit(r"([A-Z][a-z]?)\(?"), F.lit(1)), "")
    series = lambda pattern, label: F.when(c.rlike(pattern), F.when(sup != "", F.concat(F.lit(f"{label}/"), sup)))
    built = F.coalesce(
        F.concat(unload(_group(c, r"^([^/]+)/(.+)$")), F.lit("/"), first_text(short_support(slash_support), slash_support)),
        F.when(c.rlike(on_form), F.when(on_support != "", _slash(on_active, on_support)).otherwise(on_active)),
        F.when((sup != "") & ~c.contains("/") & (F.regexp_replace(clow, "[γα]-", "") != F.lower(sup)), _slash(c, sup)),
        _group(c, r"^[\d\.]+[\-–]([A-Za-z][\w\-]+)"),
        _group(c, r"^\d+([A-Z][a-z]*HT)"),
        F.regexp_replace(_group(c, r"^([A-Za-z]+[\-\d\.]*)\([\w\-]+\)$"), r"[\-\.]\d+[\.\d]*$", ""),
        _group(c, r"^([A-Za-z]{2,})[\-\.]\d+[\.\d]*$"),
        F.when(clow.rlike(r"^cat-\d"), c),
        F.when(c.rlike(r"^[A-Z][a-z]?\(\d+[\.\d]*\)[\-–]"), F.concat(elements, F.lit("Ox"))),
        F.when(c.rlike(r"(?iu)^(?:spent|fresh|used)\s+catalyst\s+sample"), F.lit("spent-catalyst")),
        F.when(on("zeolites_molecular_sieves"), zeolite),
        F.when(c.rlike(r"^[\d\.]+%?\s*Fe/ZSM[\-]?5"), "Fe/ZSM-5"),
        F.when(F.regexp_replace(clow, "[ -]", "").contains("nimo") & (clow.contains("al2o3") | low_support.contains("al2o3")), "NiMo/Al2O3"),
    )
    return staged(
        df,
        {"__named": named, "__c": cleaned, "__sup": short_support("substrate_or_support")},
        {out: short_polish(F.coalesce("__named", built, or_null(F.trim(c)), name))},
    ).drop("__named", "__c", "__sup")


def short_polish(x: Column) -> Column:
    """The last touches of the alternative normaliser: Greek prefixes, calcination suffixes, support spelling."""
    oxide = r"^(Fe2O3|Fe3O4|CeO2|TiO2|ZrO2|Al2O3|MgO|ZnO|CuO|NiO|MnO2|Mn2O3|Mn3O4)[\-–]\d{3,4}$"
    cn = F.regexp_replace(F.regexp_replace(F.trim(x), "^[γαβδ]-", ""), oxide, "$1")
    active = F.substring_index(cn, "/", 1)
    sup = F.regexp_replace(F.substring(cn, F.instr(cn, "/") + 1, F.length(cn)), r"(?i)zsm[\-]?5", "ZSM-5")
    for spelling in ("Al2O3", "SiO2", "TiO2", "ZrO2", "CeO2", "CNT", "C"):
        sup = F.regexp_replace(sup, f"(?i)^{spelling}$", spelling)
    for pattern, new in ((r"(?i)ordered mesoporous alumina", "Al2O3"), (r"(?i)ni,mg,al-mixed oxides from hydrotalcite", "HT"), (r"(?i)ni[\-\s]?foam", "Ni-foam")):
        sup = F.regexp_replace(sup, pattern, new)
    itself = (F.lower(sup) == "zeolite") & active.rlike("^(?i)(?:H?ZSM|USY|deal|zeolite|mordenite|beta)")
    joined = F.when(cn.contains("/") & itself, active).when(cn.contains("/"), _slash(active, sup)).otherwise(cn)
    whole = F.when(joined == "ZSM", "ZSM-5").when(joined == "HZSM", "HZSM-5").otherwise(F.regexp_replace(joined, r"(?i)zsm[\-]?5", "ZSM-5"))
    return F.when(cn.contains("/") & itself, joined).otherwise(F.regexp_replace(whole, "^NiHT", "NiMgAl-HT"))
