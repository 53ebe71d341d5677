"""Fixed specifications: geography codes, microdata fields, controls and output layouts."""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# Geography model (fixed values)
# --------------------------------------------------------------------------
GEOID_LEN = {"STATE": 2, "COUNTY": 3, "TRACT": 6, "BG": 1, "PUMA": 5}

GEOID_STRUCTURE = {
    "BG": ["STATE", "COUNTY", "TRACT", "BG"],
    "TRACT": ["STATE", "COUNTY", "TRACT"],
    "COUNTY": ["STATE", "COUNTY"],
    "STATE": ["STATE"],
    "PUMA": ["STATE", "PUMA"],
}

GEOGRAPHIES = ["REGION", "STATE", "PUMA", "TRACT", "BG"]
SUB_GEOGRAPHIES = ["BG", "TRACT"]
SEED_GEOGRAPHY = "PUMA"
REGION = 1

# Metres per degree of arc and the distance cap of the nearest-zone rule.
ARC_METERS = 111139.0
NEAREST_CAP_M = 1000.0

# Value that stands for "missing" in microdata after loading.
SENTINEL = 995

CHECK_RTOL = 0.01
MAX_EXPANSION = 30.0
HH_ID_SHIFT = 10**8

# --------------------------------------------------------------------------
# Microdata fields and their declared types (fixed values)
# --------------------------------------------------------------------------
PUMS_HH = {
    "SERIALNO": "string", "PUMA": "bigint", "ST": "bigint", "WGTP": "bigint",
    "NP": "bigint", "HINCP": "bigint", "VEH": "bigint", "HUPAC": "bigint",
    "TEN": "bigint", "MRGP": "bigint", "SMOCP": "bigint", "RNTP": "bigint",
    "GRNTP": "bigint",
}
PUMS_PER = {
    "SERIALNO": "string", "SPORDER": "bigint", "PUMA": "bigint", "ST": "bigint",
    "PWGTP": "bigint", "JWTRNS": "bigint", "ESR": "bigint", "SCH": "bigint",
    "SCHG": "bigint", "AGEP": "bigint", "SEX": "bigint", "RAC1P": "bigint",
    "HISP": "bigint", "WKHP": "bigint",
}

SYNTHETIC_HOUSEHOLD_COLS = ["NP", "HINCP", "VEH", "HUPAC", "TEN", "SMOCP", "RNTP", "GRNTP"]
SYNTHETIC_PERSON_COLS = [
    "per_num", "AGEP", "SEX", "RAC1P", "HISP", "WKHP", "JWTRNS", "SCH", "SCHG", "ESR",
]

# --------------------------------------------------------------------------
# States (fixed values): FIPS code, abbreviation, name
# --------------------------------------------------------------------------
STATES = [
    ("01", "AL", "Alabama"),
    ("02", "AK", "Alaska"),
    ("04", "AZ", "Arizona"),
    ("05", "AR", "Arkansas"),
    ("06", "CA", "California"),
    ("08", "CO", "Colorado"),
    ("09", "CT", "Connecticut"),
    ("10", "DE", "Delaware"),
    ("11", "DC", "District of Columbia"),
    ("12", "FL", "Florida"),
    ("13", "GA", "Georgia"),
    ("15", "HI", "Hawaii"),
    ("16", "ID", "Idaho"),
    ("17", "IL", "Illinois"),
    ("18", "IN", "Indiana"),
    ("19", "IA", "Iowa"),
    ("20", "KS", "Kansas"),
    ("21", "KY", "Kentucky"),
    ("22", "LA", "Louisiana"),
    ("23", "ME", "Maine"),
    ("24", "MD", "Maryland"),
    ("25", "MA", "Massachusetts"),
    ("26", "MI", "Michigan"),
    ("27", "MN", "Minnesota"),
    ("28", "MS", "Mississippi"),
    ("29", "MO", "Missouri"),
    ("30", "MT", "Montana"),
    ("31", "NE", "Nebraska"),
    ("32", "NV", "Nevada"),
    ("33", "NH", "New Hampshire"),
    ("34", "NJ", "New Jersey"),
    ("35", "NM", "New Mexico"),
    ("36", "NY", "New York"),
    ("37", "NC", "North Carolina"),
    ("38", "ND", "North Dakota"),
    ("39", "OH", "Ohio"),
    ("40", "OK", "Oklahoma"),
    ("41", "OR", "Oregon"),
    ("42", "PA", "Pennsylvania"),
    ("44", "RI", "Rhode Island"),
    ("45", "SC", "South Carolina"),
    ("46", "SD", "South Dakota"),
    ("47", "TN", "Tennessee"),
    ("48", "TX", "Texas"),
    ("49", "UT", "Utah"),
    ("50", "VT", "Vermont"),
    ("51", "VA", "Virginia"),
    ("53", "WA", "Washington"),
    ("54", "WV", "West Virginia"),
    ("55", "WI", "Wisconsin"),
    ("56", "WY", "Wyoming"),
]
STATE_ABBR = {fips: abbr for fips, abbr, _ in STATES}

# --------------------------------------------------------------------------
# Controls (fixed values). Each group partitions its seed table.
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class Control:
    """One target: a predicate on a seed table and the published column it must meet."""

    target: str
    geography: str
    seed_table: str
    importance: int
    control_field: str
    control_group: str
    condition: str

    @property
    def weight(self) -> str:
        return "WGTP" if self.seed_table == "households" else "PWGTP"

    @property
    def expression(self) -> str:
        """The condition together with the finite, positive weight every control requires.

        ``condition`` is null-safe: a null test counts as false, and its negation as true.
        """
        weight = f"{self.weight} > 0 AND {self.weight} < CAST('Infinity' AS DOUBLE)"
        return f"coalesce(({self.condition}) AND {weight}, false)"


# target, geography, seed table, importance, control field, control group, condition
CONTROLS = [
    Control("h_total", "BG", "households", 100000, "H_TOTAL", "h_total", "true"),
    Control("p_total", "BG", "persons", 100000, "P_TOTAL", "p_total", "true"),
    Control("p_male", "BG", "persons", 1000, "P_MALE", "p_sex", "SEX = 1"),
    Control("p_female", "BG", "persons", 1000, "P_FEMALE", "p_sex", "SEX = 2"),
    Control("p_age_0_4", "BG", "persons", 1000, "P_AGE_0_4", "p_age", "AGEP <= 4"),
    Control("p_age_5_17", "BG", "persons", 1000, "P_AGE_5_17", "p_age", "AGEP > 4 AND AGEP <= 17"),
    Control("p_age_18_34", "BG", "persons", 1000, "P_AGE_18_34", "p_age",
            "AGEP > 17 AND AGEP <= 34"),
    Control("p_age_35_49", "BG", "persons", 1000, "P_AGE_35_49", "p_age",
            "AGEP > 34 AND AGEP <= 49"),
    Control("p_age_50_64", "BG", "persons", 1000, "P_AGE_50_64", "p_age",
            "AGEP > 49 AND AGEP <= 64"),
    Control("p_age_65plus", "BG", "persons", 1000, "P_AGE_65PLUS", "p_age", "AGEP > 64"),
    Control("p_race_white", "BG", "persons", 1000, "P_RACE_WHITE", "p_race", "RAC1P = 1"),
    Control("p_race_black", "BG", "persons", 1000, "P_RACE_BLACK", "p_race", "RAC1P = 2"),
    Control("p_race_aapi", "BG", "persons", 1000, "P_RACE_AAPI", "p_race", "RAC1P IN (6, 7)"),
    Control("p_race_other", "BG", "persons", 1000, "P_RACE_OTHER", "p_race",
            "NOT coalesce(RAC1P IN (1, 2, 6, 7), false)"),
    Control("p_hispanic", "BG", "persons", 1000, "P_HISPANIC", "p_hispanic",
            "NOT coalesce(HISP = 1, false)"),
    Control("p_non_hispanic", "BG", "persons", 1000, "P_NON_HISPANIC", "p_hispanic", "HISP = 1"),
    Control("h_size_1", "BG", "households", 1000, "H_SIZE_1", "h_size", "NP = 1"),
    Control("h_size_2", "BG", "households", 1000, "H_SIZE_2", "h_size", "NP = 2"),
    Control("h_size_3", "BG", "households", 1000, "H_SIZE_3", "h_size", "NP = 3"),
    Control("h_size_4", "BG", "households", 1000, "H_SIZE_4", "h_size", "NP = 4"),
    Control("h_size_5_plus", "BG", "households", 1000, "H_SIZE_5PLUS", "h_size", "NP >= 5"),
    Control("h_no_veh", "BG", "households", 1000, "H_NO_VEH", "h_veh", "VEH = 0"),
    Control("h_veh_1", "BG", "households", 1000, "H_VEH_1", "h_veh", "VEH = 1"),
    Control("h_veh_2", "BG", "households", 1000, "H_VEH_2", "h_veh", "VEH = 2"),
    Control("h_veh_3", "BG", "households", 1000, "H_VEH_3", "h_veh", "VEH = 3"),
    Control("h_veh_4more", "BG", "households", 1000, "H_VEH_4MORE", "h_veh", "VEH IN (4, 5, 6)"),
    Control("p_mode_auto_other", "TRACT", "persons", 1000, "P_MODE_AUTO_OTHER", "p_mode",
            "JWTRNS IN (1, 7, 8, 12)"),
    Control("p_mode_transit", "TRACT", "persons", 1000, "P_MODE_TRANSIT", "p_mode",
            "JWTRNS IN (2, 3, 4, 5, 6)"),
    Control("p_mode_walk_bike", "TRACT", "persons", 1000, "P_MODE_WALK_BIKE", "p_mode",
            "JWTRNS IN (9, 10)"),
    Control("p_mode_wfh", "TRACT", "persons", 1000, "P_MODE_WFH", "p_mode", "JWTRNS = 11"),
    Control("p_mode_na", "TRACT", "persons", 1000, "P_MODE_NA", "p_mode",
            "JWTRNS IS NULL OR JWTRNS = 995"),
    Control("h_children", "BG", "households", 1000, "H_CHILDREN", "h_children",
            "NOT coalesce(HUPAC = 4, false)"),
    Control("h_no_children", "BG", "households", 1000, "H_NO_CHILDREN", "h_children", "HUPAC = 4"),
    Control("p_university", "BG", "persons", 1000, "P_UNIVERSITY", "p_university",
            "SCHG IN (15, 16)"),
    Control("p_non_university", "BG", "persons", 1000, "P_NON_UNIVERSITY", "p_university",
            "NOT coalesce(SCHG IN (15, 16), false)"),
    Control("h_income_0_25", "BG", "households", 1000, "H_INCOME_0_25", "h_income",
            "HINCP <= 25000"),
    Control("h_income_25_50", "BG", "households", 1000, "H_INCOME_25_50", "h_income",
            "HINCP > 25000 AND HINCP <= 50000"),
    Control("h_income_50_75", "BG", "households", 1000, "H_INCOME_50_75", "h_income",
            "HINCP > 50000 AND HINCP <= 75000"),
    Control("h_income_75_100", "BG", "households", 1000, "H_INCOME_75_100", "h_income",
            "HINCP > 75000 AND HINCP <= 100000"),
    Control("h_income_100_150", "BG", "households", 1000, "H_INCOME_100_150", "h_income",
            "HINCP > 100000 AND HINCP <= 150000"),
    Control("h_income_150plus", "BG", "households", 1000, "H_INCOME_150PLUS", "h_income",
            "HINCP > 150000"),
    Control("p_full_time", "BG", "persons", 1000, "P_FULL_TIME", "p_emp",
            "WKHP >= 35 AND ESR IN (1, 2, 4, 5)"),
    Control("p_part_time", "BG", "persons", 1000, "P_PART_TIME", "p_emp",
            "WKHP < 35 AND ESR IN (1, 2, 4, 5)"),
    Control("p_non_worker", "BG", "persons", 1000, "P_NON_WORKER", "p_emp",
            "NOT coalesce(ESR IN (1, 2, 4, 5), false)"),
    Control("h_mortgage_0_799", "BG", "households", 1000, "H_MORTGAGE_0_799", "h_payment",
            "SMOCP <= 799 AND TEN = 1"),
    Control("h_mortgage_800_1499", "BG", "households", 1000, "H_MORTGAGE_800_1499", "h_payment",
            "SMOCP > 799 AND SMOCP <= 1499 AND TEN = 1"),
    Control("h_mortgage_1500_2499", "BG", "households", 1000, "H_MORTGAGE_1500_2499", "h_payment",
            "SMOCP > 1499 AND SMOCP <= 2499 AND TEN = 1"),
    Control("h_mortgage_2500plus", "BG", "households", 1000, "H_MORTGAGE_2500PLUS", "h_payment",
            "SMOCP > 2499 AND TEN = 1"),
    Control("h_no_mortgage_0_799", "BG", "households", 1000, "H_NO_MORTGAGE_0_799", "h_payment",
            "SMOCP <= 799 AND TEN = 2"),
    Control("h_no_mortgage_800_1499", "BG", "households", 1000, "H_NO_MORTGAGE_800_1499", "h_payment",
            "SMOCP > 799 AND SMOCP <= 1499 AND TEN IN (2, 4)"),
    Control("h_no_mortgage_1500plus", "BG", "households", 1000, "H_NO_MORTGAGE_1500PLUS", "h_payment",
            "SMOCP > 1499 AND TEN = 2"),
    Control("h_rent_0_799", "BG", "households", 1000, "H_RENT_0_799", "h_payment",
            "GRNTP <= 799 AND TEN IN (3, 4)"),
    Control("h_rent_800_1249", "BG", "households", 1000, "H_RENT_800_1249", "h_payment",
            "GRNTP > 799 AND GRNTP <= 1249 AND TEN = 3"),
    Control("h_rent_1250_1999", "BG", "households", 1000, "H_RENT_1250_1999", "h_payment",
            "GRNTP > 1249 AND GRNTP <= 1999 AND TEN = 3"),
    Control("h_rent_2000plus", "BG", "households", 1000, "H_RENT_2000PLUS", "h_payment",
            "GRNTP > 1999 AND TEN = 3"),
    Control("h_owner", "BG", "households", 1000, "H_OWNER", "h_ownership", "TEN IN (1, 2)"),
    Control("h_renter", "BG", "households", 1000, "H_RENTER", "h_ownership", "TEN IN (3, 4)"),
]
HOUSEHOLD_CONTROLS = [c for c in CONTROLS if c.seed_table == "households"]
PERSON_CONTROLS = [c for c in CONTROLS if c.seed_table == "persons"]
TOTAL_TARGETS = {"households": "h_total", "persons": "p_total"}


@dataclass(frozen=True)
class Remainder:
    """A control derived as the difference of published columns."""

    geography: str
    add: tuple[str, ...]
    subtract: tuple[str, ...]


# Remainder controls (fixed values)
REMAINDERS = {
    "P_MODE_NA": Remainder(
        "TRACT", ("P_TOTAL",),
        ("P_MODE_AUTO_OTHER", "P_MODE_TRANSIT", "P_MODE_WALK_BIKE", "P_MODE_WFH")),
    "P_NON_UNIVERSITY": Remainder("BG", ("P_TOTAL",), ("P_UNIVERSITY",)),
    "P_NON_WORKER": Remainder("BG", ("P_TOTAL",), ("P_FULL_TIME", "P_PART_TIME")),
}


# --------------------------------------------------------------------------
# One-year variables behind each control (fixed values)
# --------------------------------------------------------------------------
ESTIMATED_VARIABLES = {
    "H_TOTAL": ["B11005_001E"],
    "H_CHILDREN": ["B11005_002E"],
    "H_NO_CHILDREN": ["B11005_011E"],
    "H_INCOME_0_25": ["B19001_002E", "B19001_003E", "B19001_004E", "B19001_005E"],
    "H_INCOME_25_50": ["B19001_006E", "B19001_007E", "B19001_008E", "B19001_009E", "B19001_010E"],
    "H_INCOME_50_75": ["B19001_011E", "B19001_012E"],
    "H_INCOME_75_100": ["B19001_013E"],
    "H_INCOME_100_150": ["B19001_014E", "B19001_015E"],
    "H_INCOME_150PLUS": ["B19001_016E", "B19001_017E"],
    "H_SIZE_1": ["B25009_003E", "B25009_011E"],
    "H_SIZE_2": ["B25009_004E", "B25009_012E"],
    "H_SIZE_3": ["B25009_005E", "B25009_013E"],
    "H_SIZE_4": ["B25009_006E", "B25009_014E"],
    "H_SIZE_5PLUS": [
        "B25009_007E", "B25009_008E", "B25009_009E", "B25009_015E", "B25009_016E", "B25009_017E",
    ],
    "H_NO_VEH": ["B25044_003E", "B25044_010E"],
    "H_VEH_1": ["B25044_004E", "B25044_011E"],
    "H_VEH_2": ["B25044_005E", "B25044_012E"],
    "H_VEH_3": ["B25044_006E", "B25044_013E"],
    "H_VEH_4MORE": ["B25044_007E", "B25044_008E", "B25044_014E", "B25044_015E"],
    "H_OWNER": ["B25087_001E"],
    "H_RENTER": ["B25063_001E"],
    "H_MORTGAGE_0_799": [
        "B25087_003E", "B25087_004E", "B25087_005E", "B25087_006E", "B25087_007E", "B25087_008E",
        "B25087_009E",
    ],
    "H_MORTGAGE_800_1499": ["B25087_010E", "B25087_011E", "B25087_012E", "B25087_032E"],
    "H_MORTGAGE_1500_2499": ["B25087_014E", "B25087_015E"],
    "H_MORTGAGE_2500PLUS": ["B25087_016E", "B25087_017E", "B25087_018E", "B25087_019E"],
    "H_NO_MORTGAGE_0_799": [
        "B25087_021E", "B25087_022E", "B25087_023E", "B25087_024E", "B25087_025E", "B25087_026E",
        "B25087_027E", "B25087_028E", "B25087_029E", "B25087_030E", "B25087_031E",
    ],
    "H_NO_MORTGAGE_800_1499": [
        "B25087_032E", "B25087_033E", "B25087_034E", "B25087_035E", "B25087_036E", "B25087_037E",
        "B25087_038E",
    ],
    "H_NO_MORTGAGE_1500PLUS": ["B25087_039E"],
    "H_RENT_0_799": [
        "B25063_003E", "B25063_004E", "B25063_005E", "B25063_006E", "B25063_007E", "B25063_008E",
        "B25063_009E", "B25063_010E", "B25063_011E", "B25063_012E", "B25063_013E", "B25063_014E",
        "B25063_015E", "B25063_016E", "B25063_017E", "B25063_027E",
    ],
    "H_RENT_800_1249": ["B25063_018E", "B25063_019E", "B25063_020E"],
    "H_RENT_1250_1999": ["B25063_021E", "B25063_022E"],
    "H_RENT_2000PLUS": ["B25063_023E", "B25063_024E", "B25063_025E", "B25063_026E"],
    "P_TOTAL": ["B01001_001E"],
    "P_MALE": ["B01001_002E"],
    "P_FEMALE": ["B01001_026E"],
    "P_AGE_0_4": ["B01001_003E", "B01001_027E"],
    "P_AGE_5_17": [
        "B01001_004E", "B01001_005E", "B01001_006E", "B01001_028E", "B01001_029E", "B01001_030E",
    ],
    "P_AGE_18_34": [
        "B01001_007E", "B01001_008E", "B01001_009E", "B01001_010E", "B01001_011E", "B01001_012E",
        "B01001_031E", "B01001_032E", "B01001_033E", "B01001_034E", "B01001_035E", "B01001_036E",
    ],
    "P_AGE_35_49": [
        "B01001_013E", "B01001_014E", "B01001_015E", "B01001_037E", "B01001_038E", "B01001_039E",
    ],
    "P_AGE_50_64": [
        "B01001_016E", "B01001_017E", "B01001_018E", "B01001_019E", "B01001_040E", "B01001_041E",
        "B01001_042E", "B01001_043E",
    ],
    "P_AGE_65PLUS": [
        "B01001_020E", "B01001_021E", "B01001_022E", "B01001_023E", "B01001_024E", "B01001_025E",
        "B01001_044E", "B01001_045E", "B01001_046E", "B01001_047E", "B01001_048E", "B01001_049E",
    ],
    "P_RACE_WHITE": ["B02001_002E"],
    "P_RACE_BLACK": ["B02001_003E"],
    "P_RACE_OTHER": ["B02001_004E", "B02001_007E", "B02001_008E"],
    "P_RACE_AAPI": ["B02001_005E", "B02001_006E"],
    "P_NON_HISPANIC": ["B03003_002E"],
    "P_HISPANIC": ["B03003_003E"],
    "P_FULL_TIME": ["B23022_004E", "B23022_028E", "B23026_004E", "B23026_028E"],
    "P_PART_TIME": [
        "B23022_011E", "B23022_018E", "B23022_035E", "B23022_042E", "B23026_011E", "B23026_018E",
        "B23026_035E", "B23026_042E",
    ],
    "P_UNIVERSITY": ["B14002_019E", "B14002_022E", "B14002_043E", "B14002_046E"],
    "P_MODE_AUTO_OTHER": ["B08301_002E", "B08301_016E", "B08301_017E", "B08301_020E"],
    "P_MODE_TRANSIT": ["B08301_010E"],
    "P_MODE_WALK_BIKE": ["B08301_018E", "B08301_019E"],
    "P_MODE_WFH": ["B08301_021E"],
}

# --------------------------------------------------------------------------
# Column families of the re-basing step
# --------------------------------------------------------------------------
REMAINDER_COLS = list(REMAINDERS)
MODE_COLS = [c.control_field for c in CONTROLS if c.control_group == "p_mode"]
HOUSEHOLD_COLS = [c for c in ESTIMATED_VARIABLES if c.startswith("H_")]
PERSON_COLS = [c for c in ESTIMATED_VARIABLES if c.startswith("P_")]
BG_PERSON_COLS = [c for c in PERSON_COLS if c not in MODE_COLS] + [
    "P_NON_WORKER", "P_NON_UNIVERSITY"]
TRACT_PERSON_COLS = MODE_COLS

# Column order of re-based control tables (fixed values)
CONTROL_ORDER = (
    ["COUNTY", "BG", "TRACT", "STATE", "NAME", "REGION"]
    + HOUSEHOLD_COLS + PERSON_COLS + ["P_MODE_NA", "P_NON_WORKER", "P_NON_UNIVERSITY"]
)

FIXED_RENAMES = {"ST": "STATE", "BLOCK GROUP": "BG"}
CROSSWALK_RENAMES = {
    "STATEFP": "STATE", "COUNTYFP": "COUNTY", "TRACTCE": "TRACT", "BLKGRPCE": "BG",
}
INPUT_RENAMES = {"hhnum": "hh_id", "SPORDER": "per_num", "TRACTCE": "TRACT"}
