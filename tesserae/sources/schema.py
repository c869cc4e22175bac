"""Schemas of the nested input documents, of normalisation results and of download records."""

from __future__ import annotations

from pyspark.sql import types as T

PAPER_DDL = """
DOI string, title string, time array<int>,
task1 struct<reaction_catalog: array<struct<
  reaction_id: string, reaction_name_reported: string, transformation: string, reaction_domain: string,
  reaction_class: string, reaction_family: array<string>, reactants: array<string>,
  target_products: array<string>, is_primary_reaction: string>>>,
task2 struct<catalyst_catalog: array<struct<
  catalyst_id: string, name_reported: string, aliases: array<string>, substrate_or_support: string,
  tested_reaction_ids: array<string>, labels_material_platform: array<string>,
  labels_active_site_form: array<string>, labels_morphology_device_form: array<string>,
  form_factor: array<string>, role: string, series_name: string, variant_rule: string, variant_value: string>>>,
task3 struct<procedure_catalog: array<struct<
  procedure_id: string, procedure_type: string, name_reported: string, catalyst_ids: array<string>,
  reaction_ids: array<string>, steps: array<struct<
    step_no: int, step_type: string, method_details: string, inputs: array<string>,
    parameters: map<string,string>, output_intermediate: string>>>>>,
task4 struct<characterization_records: array<struct<
  record_id: string, catalyst_id: string, applies_to_catalyst_ids: array<string>, sample_state: string,
  reaction_id: string, method_family: string, method_name_reported: string, results: string>>>,
task5 struct<performance_records: array<struct<
  dataset_id: string, reaction_id: string, dataset_type: string, common_conditions: map<string,string>,
  operating_points: array<struct<
    point_id: string, point_conditions: map<string,string>,
    metrics_by_catalyst: array<struct<
      catalyst_id: string, catalyst_state_during_test: string, state_notes: string,
      metrics: array<struct<property_name: string, target_species: string, basis: string,
                            value: string, unit: string, notes: string>>>>>>>>>,
task6 struct<mechanistic_claims: array<struct<
  claim_id: string, reaction_id: string, catalyst_id: string, applies_to_catalyst_ids: array<string>,
  claim_type: string, design_mechanism_tags: array<string>, claim_summary: string,
  evidence_chain: array<struct<evidence_type: string, evidence_summary: string,
    linked_characterization_record_ids: array<string>,
    linked_performance_dataset_ids: array<string>, linked_procedure_ids: array<string>>>>>>
"""
CORRUPT = "_corrupt_record"


def paper_schema() -> T.StructType:
    return T.StructType.fromDDL(PAPER_DDL)


REACTION_RESULT = "uid string, canonical_reaction_name string, canonical_reaction_aliases array<string>"
CATALYST_RESULT = "uid string, canonical_catalyst_name string, canonical_catalyst_family string, canonical_aliases array<string>, canonical_name string"
DEDUP_MAP = "family string, canonical string"

EDGE_MEASURES = {
    "co_occurrence_count": "bigint",
    "witness_count": "bigint",
    "witness_paper_count": "bigint",
    "witness_papers": "array<string>",
    "first_year": "int",
    "last_year": "int",
    "similarity_basis": "array<string>",
}
DOWNLOAD = """paperId string, doi string, title string, authors array<string>, year int, abstract string,
citation_count int, journal string, is_open_access boolean, oa_pdf_url string,
download_status string, download_source string, filename string"""
