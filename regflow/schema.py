"""Fixed column lists and the per-grain settings that drive every job."""

from __future__ import annotations

import re
from dataclasses import dataclass

# State labels, in the order the source lists them.
STATES = (
    "Andaman & Nicobar Island",
    "Andhra Pradesh",
    "Arunachal Pradesh",
    "Assam",
    "Bihar",
    "Chhattisgarh",
    "Chandigarh",
    "UT of DNH and DD",
    "Delhi",
    "Goa",
    "Gujarat",
    "Himachal Pradesh",
    "Haryana",
    "Jharkhand",
    "Jammu and Kashmir",
    "Karnataka",
    "Kerala",
    "Ladakh",
    "Lakshadweep",
    "Maharashtra",
    "Meghalaya",
    "Manipur",
    "Madhya Pradesh",
    "Mizoram",
    "Nagaland",
    "Odisha",
    "Punjab",
    "Puducherry",
    "Rajasthan",
    "Sikkim",
    "Tamil Nadu",
    "Telangana",
    "Tripura",
    "Uttarakhand",
    "Uttar Pradesh",
    "West Bengal",
)

# Month labels, January first.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

# Spellings replaced in the state column. Monthly reports carry the
# folder spelling, where "&" became a space; the legacy history carries the label.
STATE_SPELLINGS = {
    "Andaman   Nicobar Island": "Andaman and Nicobar",
    "UT of DNH and DD": "Dadara and Nagar Havelli",
}
LEGACY_STATE_SPELLINGS = {
    "Andaman & Nicobar Island": "Andaman and Nicobar",
    "UT of DNH and DD": "Dadara and Nagar Havelli",
}

# Fuel headers of a report, in output order.
FUEL_HEADERS = (
    "BIO-CNG/BIO-GAS",
    "BIO-DIESEL(B100)",
    "BIO-METHANE",
    "CNG ONLY",
    "DIESEL",
    "DIESEL/HYBRID",
    "DI-METHYL ETHER",
    "DUAL DIESEL/BIO CNG",
    "DUAL DIESEL/CNG",
    "DUAL DIESEL/LNG",
    "ELECTRIC(BOV)",
    "ETHANOL(E100)",
    "FLEX-FUEL(BIO-DIESEL)",
    "FLEX-FUEL(ETHANOL)",
    "FUEL CELL HYDROGEN",
    "HCNG",
    "HYDROGEN(ICE)",
    "LNG",
    "LPG ONLY",
    "METHANOL",
    "NOT APPLICABLE",
    "PETROL",
    "PETROL/CNG",
    "PETROL(E20)",
    "PETROL(E20)/CNG",
    "PETROL(E20)/HYBRID",
    "PETROL(E20)/HYBRID/CNG",
    "PETROL(E20)/LPG",
    "PETROL/HYBRID",
    "PETROL/HYBRID/CNG",
    "PETROL/LPG",
    "PETROL/METHANOL",
    "PLUG-IN HYBRID EV",
    "PURE EV",
    "SOLAR",
    "STRONG HYBRID EV",
)

# Fuel headers of the legacy history reports, in output order.
LEGACY_FUEL_HEADERS = (
    "CNG ONLY",
    "DIESEL",
    "DIESEL/HYBRID",
    "DI-METHYL ETHER",
    "DUAL DIESEL/BIO CNG",
    "DUAL DIESEL/CNG",
    "DUAL DIESEL/LNG",
    "ELECTRIC(BOV)",
    "ETHANOL",
    "FUEL CELL HYDROGEN",
    "LNG",
    "LPG ONLY",
    "METHANOL",
    "NOT APPLICABLE",
    "PETROL",
    "PETROL/CNG",
    "PETROL/ETHANOL",
    "PETROL/HYBRID",
    "PETROL/LPG",
    "PETROL/METHANOL",
    "PLUG-IN HYBRID EV",
    "PURE EV",
    "SOLAR",
    "STRONG HYBRID EV",
)

# Measures a pre-migration table may lack. The other measures and the
# leading columns are required there.
ADDED_MEASURES = (
    "bio_cng_bio_gas",
    "bio_diesel_b100",
    "bio_methane",
    "electric_bov",
    "ethanol_e100",
    "flex_fuel_bio_diesel",
    "flex_fuel_ethanol",
    "fuel_cell_hydrogen",
    "hcng",
    "hydrogen_ice",
    "petrol_e20",
    "petrol_e20_cng",
    "petrol_e20_hybrid",
    "petrol_e20_hybrid_cng",
    "petrol_e20_lpg",
    "petrol_hybrid_cng",
)

# Measure -> the older column whose meaning it replaced.
REPLACED_MEASURES = {"electric_bov": "electric_vehicles", "ethanol_e100": "ethanol"}

REPORT_FILE = "reportTable.xlsx"
HEADER_ROWS_SKIPPED = 3
LABEL_HEADER = "Unnamed: 1"
TOTAL_HEADER = "Unnamed: 38"
LEGACY_TOTAL_HEADER = "Unnamed: 26"
LEGACY_TOTAL_FALLBACK = "Unnamed: 23"
DEFAULT_DIMENSION = "Others"
CLASS_HEADERS = ("Vehicle Type", "Vehicle Category", "Vehicle Use Type")
MAPPING_HEADERS = ("Vehicle Class",) + CLASS_HEADERS


def snake(header: str) -> str:
    """Output name of a report header: lower case, one underscore per run of other characters."""
    return re.sub(r"[^a-z0-9]+", "_", header.lower()).strip("_")


MEASURES = tuple(snake(h) for h in FUEL_HEADERS) + ("total",)
MEASURE_HEADERS = FUEL_HEADERS + (TOTAL_HEADER,)


@dataclass(frozen=True)
class Grain:
    """What differs between the three report families."""

    name: str
    # Source header -> output column for the leading columns, in output order.
    lead: tuple[tuple[str, str], ...]
    # Report folders between the root and <year>/<month>.
    folders: tuple[str, ...]
    # Source header compared with the mapping's vehicle class.
    class_header: str
    normalized_mapping: bool
    csv_prefix: str
    fact_table: str
    curated_table: str
    load_key: tuple[str, ...]
    curated_key: tuple[str, ...]
    backfill_key: tuple[str, ...]
    # Curated dimensions: (source column, output column, width), in output order.
    curated_text: tuple[tuple[str, str, int], ...]

    @property
    def rename_map(self) -> dict[str, str]:
        return dict(self.lead) | dict(zip(MEASURE_HEADERS, MEASURES))

    @property
    def columns(self) -> list[str]:
        return list(self.rename_map.values())

    @property
    def lead_columns(self) -> list[str]:
        return [column for _, column in self.lead]


_DATE_LEAD = (
    ("Year", "year"),
    ("Month", "month"),
    ("Day", "day"),
    ("Date", "date"),
    ("State", "state"),
)
_CLASS_LEAD = tuple((header, snake(header)) for header in CLASS_HEADERS)
_CLASS_TEXT = (
    ("vehicle_type", "vehicle_type", 100),
    ("vehicle_category", "vehicle_category", 100),
    ("vehicle_use_type", "vehicle_use_type", 100),
    ("vehicle_class", "vehicle_class", 100),
)
_CLASS_KEY = ("vehicle_type", "vehicle_category", "vehicle_use_type", "vehicle_class")

STATE = Grain(
    name="state",
    lead=_DATE_LEAD + _CLASS_LEAD + ((LABEL_HEADER, "vehicle_class"),),
    folders=("State",),
    class_header=LABEL_HEADER,
    normalized_mapping=False,
    csv_prefix="state_level_ev_data",
    fact_table="fact_ev_data_by_state",
    curated_table="state_wise_ev_data",
    load_key=("date", "state", "vehicle_class"),
    curated_key=("date", "state") + _CLASS_KEY,
    backfill_key=("date", "state") + _CLASS_KEY,
    curated_text=(("state", "state", 100),) + _CLASS_TEXT,
)

RTO = Grain(
    name="rto",
    lead=_DATE_LEAD
    + (("rto_name", "rto_name"), ("rto_code", "rto_code"))
    + _CLASS_LEAD
    + ((LABEL_HEADER, "vehicle_class"),),
    folders=("State", "Office"),
    class_header=LABEL_HEADER,
    normalized_mapping=False,
    csv_prefix="rto_level_ev_data",
    fact_table="fact_ev_data_by_rto",
    curated_table="rto_wise_ev_data",
    load_key=("date", "state", "rto_code", "rto_name", "vehicle_class"),
    curated_key=("date", "rto_code") + _CLASS_KEY,
    backfill_key=("date", "state", "rto_name", "rto_code") + _CLASS_KEY,
    curated_text=(
        ("state", "state", 100),
        ("district", "district", 100),
        ("rto_name", "rto_name", 100),
        ("rto_code", "rto_code", 50),
    )
    + _CLASS_TEXT,
)

OEM = Grain(
    name="oem",
    lead=_DATE_LEAD
    + (("Vehicle Class", "vehicle_class"),)
    + _CLASS_LEAD
    + ((LABEL_HEADER, "maker"),),
    folders=("State", "Vehicle Class"),
    class_header="Vehicle Class",
    normalized_mapping=True,
    csv_prefix="oem_data_by_state_and_category",
    fact_table="fact_oem_data_by_state_and_category",
    curated_table="oem_wise_ev_data",
    load_key=("date", "state", "vehicle_class"),
    curated_key=("date", "state", "oem_name") + _CLASS_KEY,
    backfill_key=("date", "state", "maker") + _CLASS_KEY,
    curated_text=(("state", "state", 100), ("maker", "oem_name", 100)) + _CLASS_TEXT,
)

GRAINS = {grain.name: grain for grain in (STATE, RTO, OEM)}
