from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tesserae.functions import materials, text
from tesserae.operators import bridge, canonical

EMPTY = {"aliases": [], "substrate_or_support": "", "series_name": "", "variant_rule": "", "variant_value": "", "labels_material_platform": [], "given": ""}
SCHEMA = "name_reported string, aliases array<string>, substrate_or_support string, series_name string, variant_rule string, variant_value string, labels_material_platform array<string>, given string"


def names(spark, rows):
    data = [{**EMPTY, **r} for r in rows]
    columns = [f.split()[0] for f in SCHEMA.split(", ")]
    df = spark.createDataFrame([(i, *[r[c] for c in columns]) for i, r in enumerate(data)], "i int, " + SCHEMA).persist()
    return [r["canonical"] for r in materials.with_canonical_name(df, "given").orderBy("i").select("canonical").collect()]


def test_canonical_names(spark):
    metal, oxide = "supported_metal_nanoparticles", "metal_oxides_hydroxides_oxyhydroxides"
    cases = [
        ({"name_reported": "5 wt% LaCoO3"}, "LaCoO3"),
        ({"name_reported": "No Catalyst"}, "no_catalyst"),
        ({"name_reported": "x", "given": "no-catalyst blank"}, "no_catalyst"),
        ({"name_reported": "char-450"}, "oil shale char@450C"),
        ({"name_reported": "Pt", "substrate_or_support": "alumina", "labels_material_platform": [metal], "given": "Al2O3"}, "Pt/Al2O3"),
        ({"name_reported": "NiAl-oxide", "labels_material_platform": [oxide], "given": "Ni/Al2O3"}, "NiAl-oxide"),
        ({"name_reported": "Ni / gamma-alumina"}, "Ni/Al2O3"),
        ({"name_reported": "Cu nanowire thing"}, "Cu nanowire thing"),
        ({"name_reported": "Pt-rods", "substrate_or_support": "ac"}, "activated carbon"),
        ({"name_reported": "Pd", "substrate_or_support": "cordierite monolith", "given": "Pd/Al2O3"}, "Pd/cordierite monolith"),
        ({"name_reported": "", "substrate_or_support": ""}, "unknown"),
        ({"name_reported": "brown coal char", "variant_rule": "pyrolysis T", "variant_value": "600 °C"}, "brown coal char@600C"),
    ]
    got = names(spark, [c[0] for c in cases])
    assert got == [c[1] for c in cases]


def test_species_key_and_decimals(spark):
    row = spark.createDataFrame([(["Hydrogen", " h₂ ", "CO", ""], "Thermal ", "", ["B", "a"], ["steam"], [], "", "")], "s array<string>, reaction_domain string, reaction_class string, reaction_family array<string>, reactants array<string>, target_products array<string>, transformation string, reaction_name_reported string")
    got = row.select(text.species("s").alias("s"), canonical.merge_key().alias("k")).first()
    assert got["s"] == ["CO", "H2"] and got["k"] == "thermal||unknown||a|b||R:H2O||P:unknown"
    fractions = [(n, d) for d in range(1, 41) for n in range(1, d + 1)]
    df = spark.createDataFrame(fractions, "n int, d int").withColumn("x", text.two_decimals(F.col("n") / F.col("d")))
    assert all(r["x"] == f"{r['n'] / r['d']:.2f}" for r in df.collect())


@pytest.mark.parametrize("raw, want", [("calcined at 450 °C", "450C"), ("at 45 C", ""), ("1000C", "1000C"), (None, "")])
def test_temperature(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "x string").select(materials.temperature("x")).first()[0] == want


def test_short_names(spark):
    cases = [
        ("no catalyst used", "", [], "__no_catalyst__"),
        ("Amberlyst 15", "", [], "Amberlyst-15"),
        ("5% Pt/γ-Al2O3", "", [], "Pt/Al2O3"),
        ("Ru supported on silica", "", [], "Ru/SiO2"),
        ("0.3-FeNiAl", "", [], "FeNiAl"),
        ("10NiHT", "", [], "NiMgAl-HT"),
        ("CuZnAl-1.5", "", [], "CuZnAl"),
        ("Co", "titania", [], "Co/TiO2"),
        ("coal char", "", ["carbon_based"], "coal-char"),
        ("HZSM5", "", ["zeolites_molecular_sieves"], "HZSM-5"),
        ("Rhodococcus erythropolis X", "", ["bio_biocatalyst_immobilized"], "Rhodococcus erythropolis"),
        ("olivine", "", [], "olivine"),
    ]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, name_reported string, substrate_or_support string, labels_material_platform array<string>")
    got = [r["canonical_name"] for r in materials.with_short_name(df).orderBy("i").collect()]
    assert got == [c[3] for c in cases]


def test_file_names(spark):
    df = spark.createDataFrame([(None, [], "Unknown (10.1021/acsaem.2c01115)"), (2020, ["Doe, Jane", "X"], "The <i>Role</i> of É in the Oxygen evolution and more words")], "y int, a array<string>, t string")
    assert [r[0] for r in df.select(text.pdf_filename("y", "a", "t")).collect()] == ["None_Unknown_Unknown_101021acsaem2c01115.pdf", "2020_Doe_Role_E_Oxygen_evolution_more.pdf"]


def test_template_similarity(spark):
    rows = [("a", [1], "d", "c1", ["A", "B", "C"]), ("b", [2], "d", "c2", ["a", "D"]), ("c", [3], "d", "c1", []), ("e", [4], "", "c1", ["A"])]
    df = spark.createDataFrame(rows, "uid string, ord array<bigint>, reaction_domain string, reaction_class string, reactants array<string>")
    got = {(r["source"], r["target"]): r["similarity_basis"] for r in bridge.template_similarity(df).collect()}
    assert got == {("a", "c"): ["domain", "class"]}


def test_family_similarity(spark):
    rows = [("a", [1], ["other", "p"], ["s"]), ("b", [2], ["p"], ["s"]), ("c", [3], ["other"], ["s"]), ("d", [4], ["p"], [])]
    df = spark.createDataFrame(rows, "uid string, ord array<bigint>, dominant_material_platform array<string>, dominant_active_site_form array<string>")
    got = {(r["source"], r["target"]): r["similarity_basis"][0] for r in bridge.family_similarity(df).collect()}
    assert got == {("a", "b"): "material_platform", ("a", "d"): "specific_material_platform", ("b", "d"): "specific_material_platform"}
