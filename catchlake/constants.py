"""Codes, headings and limits that results depend on."""

# Marine layer ids.
EEZ, HIGH_SEAS, LME, RFMO, GLOBAL, IFA, MEOW = 1, 2, 3, 4, 6, 14, 19

# Catch type of discards, the end use given to discards, the end use when none is known.
DISCARD_CATCH_TYPE = 2
DISCARD_END_USE = 4
DEFAULT_END_USE = 1

# Fixed value: unit price used where no price is known.
DEFAULT_UNIT_PRICE = 1466

# The fishing entity merged into another one after the facts are built.
MERGED_ENTITIES = {223: 213}

# Taxa too broad for stock status.
AGGREGATE_TAXA = (100000, 100011, 100025, 100039, 100047, 100058, 100077, 100139, 100239, 100339)

# Stock status categories, numbered from 1; 6 means none of them.
STOCK_HEADINGS = ("Collapsed", "Over-exploited", "Exploited", "Developing", "Rebuilding")
NO_CATEGORY = 6

# Fixed value: RFMO without a CSV cache.
CSV_CACHE_EXCLUDED = (9,)

# Fixed value: rows-per-id map size.
RESULT_PARTITIONS = 150

# Fixed value: file name of a taxon extent; a second number marks an extended extent.
EXTENT_FILE = r"^(\d+)\-?(\d+)?.shp"

# Old gear code -> standard gear code.
GEAR_CODES = {
    0: 800, 1: 301, 2: 301, 3: 301, 4: 301, 5: 301, 6: 301, 7: 800, 8: 302, 9: 302,
    10: 500, 11: 500, 12: 606, 13: 500, 14: 500, 15: 500, 16: 303, 17: 300, 18: 303, 19: 604,
    20: 401, 21: 301, 22: 302, 23: 302, 24: 302, 25: 302, 26: 302, 27: 302, 28: 302, 29: 302,
    30: 302, 31: 302, 32: 302, 33: 302, 34: 302, 35: 302, 36: 302, 37: 302, 38: 302, 39: 302,
    40: 500, 41: 601, 42: 600, 43: 401, 44: 401, 45: 401, 46: 401, 47: 401, 48: 401, 49: 401,
    50: 401, 51: 602, 52: 301, 53: 301, 54: 301, 55: 705, 56: 700, 57: 700, 58: 700, 59: 606,
    60: 300, 61: 710, 62: 601, 63: 100, 64: 200, 65: 200, 66: 302, 67: 714, 68: 302, 69: 302,
    70: 801,
}

# Columns of a published catch row, in order; the raw row's id comes last.
CATCH_COLUMNS = (
    "fishing_entity_id", "original_country_fishing_id", "eez_id", "eez_sub_area", "fao_area_id",
    "subregional_area", "province_state", "ices_area_id", "nafo_division_id", "ccamlr_area", "layer",
    "sector_type_id", "original_sector", "catch_type_id", "reporting_status_id", "year", "taxon_key",
    "original_taxon_name_id", "original_fao_name_id", "amount", "adjustment_factor", "gear_type_id",
    "input_type_id", "forward_carry_rule_id", "disaggregation_rule_id", "layer_rule_id", "reference_id",
    "notes", "raw_catch_id",
)

# Columns of the year-partitioned copy of the allocation data.
YEAR_COPY_COLUMNS = (
    "universal_data_id", "fishing_entity_id", "year", "taxon_key", "sector_type_id", "catch_type_id",
    "reporting_status_id", "gear_type_id",
)

# Columns of the fact, in order.
FACT_COLUMNS = (
    "main_area_id", "sub_area_id", "marine_layer_id", "data_layer_id", "fishing_entity_id", "gear_id", "time_key",
    "year", "taxon_key", "area_key", "catch_type_id", "catch_status", "reporting_status_id", "reporting_status",
    "sector_type_id", "end_use_type_id", "score", "catch_sum", "real_value", "primary_production_required",
    "catch_trophic_level", "catch_max_length",
)
