"""Word lists, identifiers and texts that the results must carry unchanged."""

from __future__ import annotations

# --- Fixed values: attribute categories ------------------------------------------------------
# The six categories that steer sample classification are complete here. Of the other
# categories only common names are listed; a full dictionary is passed in as a table with the
# columns (name, category), see seqlake.operators.attributes.attribute_dictionary.
_CORE_DICTIONARY = """
clinical: ad_status age age_at_diagnosis arrayexpress_phenotype arrayexpress_sex cancer_type
  disease disease_stage disease_state diagnosis gender grade health_state histological_type
  immune_phenotype infection inflammation path_ggs is_tumor phenotype sensitivity sex
  study_disease subject_is_affected tnm_stage tumor_stage
host_material: body_site cell_line cell_subtype cell_types cell_type source_fraction
  organism_part tissue tissue_source tissue_site tissue_type
host: add_host_info host host_age host_associated host_behaviour host_body_product
  host_body_site host_common_name host_disease host_habitat host_health_state
  host_age_normalized_years host_genotype host_length host_life_stage host_phenotype
  host_raw_meat_feeding host_scientific_name host_sex host_strain host_subject_id host_taxid
  host_tot_mass lab_host biological_sex specific_host host_disease_outcome mouse_id animal_id
organism_identity: clade
source_material: collection_method source source_type
spatiotemporal: geo_loc_name geographic_location_country_and_or_sea time_hr
environment: animal_env broad_scale_environmental_context env_biome env_broad_scale env_feature
  env_local_scale env_material env_medium empo_1 empo_2 empo_3 empo_4 env_package
  environmental_medium environmental_package environmental_sample climate_environment biome
  environment feature habitat local_environmental_context material
  sediment_environmental_package soil_type wastewater_type
environmental_measurement: depth temperature ph
schema_hint: biosamplemodel
sample_identifier: sample_name
submission_metadata: sequenced_by ena_checklist
controlled_access_metadata: gap_accession
public_health_surveillance: purpose_of_sampling
antimicrobial_resistance: mic_meropenem
molecular_typing: sequence_type
genome_metadata: estimated_size
metagenome_assembly: assembly_method assembly_method_and_version assembly_method_version bin_id
  completeness_estimated contamination_estimated derived_from dreived_from genome_coverage
  mapping_method mapping_method_and_version mapping_method_version metagenome_source metagenomic
  quality_assessment_method quality_assessment_method_and_version
  quality_assessment_method_version subsource_note subsrc_note
microbial_phenotype: rel_to_oxygen
pathogen_metadata: pathogenicity
sequencing_metadata: seq_meth filename
culture_metadata: replicate
facility_metadata: location_in_facility
sample_quality: potential_contaminant
viral_metadata: virus_enrich_appr
serology_metadata: definition_for_seropositive_sample
vaccination_metadata: date_of_sars_cov_2_vaccination
experimental_design: evolution_regime experimental_run osmotic_condition perturbation study_day
  tab target_gene treat group treatment_group chem_administration condition growth_condition
  stimulation stimulus treatment study_design group_description growth_protocol
  isolation_and_growth_condition batch block diet_treatment drug_treatment experimental_group
  experimental_stage experiment evolution_line generation epd evolved_population
  experimental_factor gavage_treatment genetic_modification immunoprecipitate antibody
  antibody_source chip_antibody classification initial_time_point irradiate light_condition
  model_source protocol repeat treatment_type pdx_passage replicate_number study_condition
  treatment_code wells
developmental_stage: dev_stage
plant_metadata: plant_structure
diet_metadata: diet
fungal_metadata: microbial_biomass_meth
animal_husbandry: age_days pig_housing_type
omics_analysis: statistical_analysis_tools
physiology_measurement: fasting_glucose
"""

# Prefix rules, then suffix rules, first match wins; they apply to names that
# are not in the dictionary.
PREFIX_RULES = [
    ("clinical", ["clinical_"]),
    ("environment", ["environment_", "local_scale_environmental_", "mfd_hab"]),
    ("food_metadata", ["food_"]),
    ("human_survey", ["covid_"]),
    ("sample_processing", ["sample_", "samp_", "nucl_acid_", "nucleic_acid_", "quality_control_"]),
    ("wastewater_surveillance", ["ww_"]),
]
SUFFIX_RULES = [("human_survey", ["_cat", "_frequency"])]
OTHER_CATEGORY = "other"


def core_dictionary() -> list[tuple[str, str]]:
    """The built-in dictionary as (name, category) rows."""
    rows, category = [], ""
    for token in _CORE_DICTIONARY.split():
        if token.endswith(":"):
            category = token[:-1]
        else:
            rows.append((token, category))
    return rows


# --- Fixed values: organism groups -----------------------------------------------------------
ANIMAL_TAXA = """7955 8319 9031 9544 9597 9598 9796 9823 9913 9940 10092 10116 494514 7782 8296
 29159 30301 34765 37000 159736 1962980""".split()
INSECT_TAXA = "7070 7091 108931".split()
PLANT_TAXA = "4097 3403 4577 188998 374723".split()
FUNGAL_TAXA = "27291 4932".split()
ALGAL_TAXA = ["44745"]
PROTIST_TAXA = """5801 5802 5804 5806 5807 5810 5811 5821 5823 5825 5833 5843 5850 5855 5861 5866
 5874 5875 5693 29176 35133 36329 383379 42890 471275 483139 508771 1344799 2041159 2605654
 3135041 3135043 3135044 1973199 3391652""".split()
FUNGAL_TERMS = ["candidozyma", "candida ", "fungus"]
PROTIST_TERMS = """babesia cryptosporidium eimeria apicomplexa amplectina anthozoaphila labyrinthula
 belladina cephaloidophora difficilina ganymedes kinetosphaera klossia lankesteria lecudina
 legerella lentusidium loxomoprha lunidium metzidium neospora paralecudina plasmodium polyrhabdina
 sarcocystis selenidium siedleckia theileria thiriotia toxoplasma trypanosoma trollidium
 urospora""".split()
ARCHAEAL_TERMS = ["methano", "archae"]
BACTERIAL_TERMS = """escherichia jejuibacter acinetobacter bacillus burkholderia campylobacter
 citrobacter enterococcus enterobacter elizabethkingia faecalibacterium klebsiella legionella
 listeria mycobacterium proteus raoultella salmonella pseudomonas rickettsia streptococcus
 staphylococcus vibrio""".split()
UNNAMED_SAMPLES = ["blank sample", "synthetic construct", "unidentified"]
PROTIST_CLADES = ["apicomplexa", "alveolata", "stramenopiles", "discoba"]

# The sample domains a lake may contain.
SAMPLE_DOMAINS = "animal fungi human metagenome microorganism plant protist unknown virus".split()

# Separators and markers in stored text.
LIST_SEPARATOR = " | "
MISSING = "missing"
REDACTED = "[REDACTED]"
