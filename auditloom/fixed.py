"""Fixed values.

Word lists, lookup tables, thresholds and patterns in this file are fixed
values: results are only right when they are exactly these.  Code elsewhere
takes them as parameters, so other values can be passed.
"""

# --- owner entity classes: (class, kind, values), first match wins ------------
# kind "words": any listed text occurs in the upper-cased name
# kind "regex": the pattern is found in the upper-cased name

_GOVERNMENT = ("COUNTY OF", "CITY OF", "TOWN OF", "STATE OF", "COMMONWEALTH", "UNITED STATES", "U S A",
               "VIRGINIA DEPT", "VA DEPT", "BOARD OF SUPERVISORS", "SCHOOL BOARD", "SANITATION", "WATER AUTH")
_GOVERNMENT_SHORT = ("COUNTY OF", "CITY OF", "TOWN OF", "STATE OF", "COMMONWEALTH", "UNITED STATES",
                     "BOARD OF SUPERVISORS", "SCHOOL BOARD", "SANITATION", "WATER AUTH")
_RELIGIOUS = ("CHURCH", "CHAPEL", "MINISTRY", "MINISTRIES", "BAPTIST", "METHODIST", "LUTHERAN", "CATHOLIC",
              "PRESBYTERIAN", "EPISCOPAL", "ASSEMBLY OF GOD", "CONGREGATION", "DIOCESE", "PARISH", "MOSQUE",
              "SYNAGOGUE", "TEMPLE", "BIBLE", "GOSPEL")
_RELIGIOUS_SHORT = ("CHURCH", "CHAPEL", "MINISTRY", "MINISTRIES", "BAPTIST", "METHODIST", "LUTHERAN", "CATHOLIC",
                    "PRESBYTERIAN", "EPISCOPAL", "ASSEMBLY OF GOD", "CONGREGATION", "DIOCESE", "PARISH")
_NON_PROFIT = ("FOUNDATION", "ASSOC", "ASSOCIATION", "SOCIETY", "CLUB", "LEGION", "VFW", "LIONS", "ROTARY",
               "KIWANIS", "ELKS", "MOOSE", "LODGE", "FRATERNAL", "CHARITABLE", "CHARITY", "NON-PROFIT", "NONPROFIT")
_NON_PROFIT_SHORT = ("FOUNDATION", "ASSOC", "ASSOCIATION", "SOCIETY", "CLUB", "LEGION", "VFW", "LIONS", "ROTARY")
_CORPORATION = (" INC", " CORP", " CO ", " COMPANY", "INCORPORATED", "CORPORATION", "ENTERPRISES")
_TRUST = ("TRUST", "TRUSTEE", "REVOCABLE", "IRREVOCABLE", "LIVING TRUST", "FAMILY TRUST", "TR ")
_TRUST_SHORT = ("TRUST", "TRUSTEE", "REVOCABLE", "IRREVOCABLE")
_ESTATE = ("ESTATE OF", "ESTATE", " EST ", "HEIRS OF", "HEIRS", "DEVISEES")
_ESTATE_SHORT = ("ESTATE OF", "ESTATE", " EST ", "HEIRS OF")
_FINANCIAL = ("BANK", "MORTGAGE", "FINANCIAL", "CREDIT UNION", "SAVINGS", "LENDING")
_FINANCIAL_SHORT = ("BANK", "MORTGAGE", "FINANCIAL", "CREDIT UNION")
_UTILITY = ("ELECTRIC", "POWER", "GAS", "TELEPHONE", "COMMUNICATIONS", "VERIZON", "AT&T", "COMCAST", "DOMINION",
            "SHENANDOAH VALLEY ELEC")
_HOA = ("HOA", "HOMEOWNERS", "HOME OWNERS", "CONDO", "CONDOMINIUM", "PROPERTY OWNERS", "POA")
_LLC_OR_LC = r"\bLLC\b|\bL\.?L\.?C\.?\b|\bLC\b"
_LP = r"\bLP\b|\bL\.?P\.?\b|LIMITED PARTNERSHIP"

ENTITY_RULES = {
    "detailed": (
        ("Government", "words", _GOVERNMENT),
        ("Religious", "words", _RELIGIOUS),
        ("Non-Profit/Organization", "words", _NON_PROFIT + ("INC C/O", "501")),
        ("LLC", "regex", _LLC_OR_LC),
        ("Corporation", "words", _CORPORATION),
        ("Limited Partnership", "regex", _LP),
        ("Trust", "words", _TRUST),
        ("Estate", "words", _ESTATE),
        ("Financial Institution", "words", _FINANCIAL + ("CAPITAL",)),
        ("Utility", "words", _UTILITY),
        ("HOA/Condo Association", "words", _HOA),
    ),
    "yearly": (
        ("Government", "words", _GOVERNMENT),
        ("Religious", "words", _RELIGIOUS),
        ("Non-Profit", "words", _NON_PROFIT),
        ("LLC", "regex", r"\bLLC\b|\bL\.?L\.?C\.?\b"),
        ("LLC", "regex_unless_words", (r"\bLC\b", ("ELEC", "CALC"))),
        ("Corporation", "words", _CORPORATION),
        ("Limited Partnership", "regex", _LP),
        ("Trust", "words", _TRUST),
        ("Estate", "words", _ESTATE),
        ("Financial Institution", "words", _FINANCIAL),
        ("Utility", "words", _UTILITY),
        ("HOA/Condo", "words", _HOA),
    ),
    "district": (
        ("Government", "words", _GOVERNMENT_SHORT),
        ("Religious", "words", _RELIGIOUS_SHORT),
        ("Non-Profit", "words", _NON_PROFIT_SHORT),
        ("LLC", "regex", _LLC_OR_LC),
        ("Corporation", "words", _CORPORATION),
        ("Limited Partnership", "regex", _LP),
        ("Trust", "words", _TRUST_SHORT),
        ("Estate", "words", _ESTATE_SHORT),
        ("Financial", "words", _FINANCIAL_SHORT),
    ),
}
ENTITY_DEFAULT = "Individual"
TREND_TYPES = ("Individual", "LLC", "Trust", "Corporation", "Estate", "Non-Profit")
GROWTH_TYPES = ("Individual", "LLC", "Trust", "Corporation")
PROFILE_TYPES = ("Individual", "LLC", "Trust", "Corporation", "Estate")

# --- names -------------------------------------------------------------------
LAST_NAME_ENTITY_WORDS = ("LLC", "INC", "CORP", "TRUST", "CHURCH", "BANK", "COUNTY", "ESTATE", "FOUNDATION",
                          "ASSOC", " LC")
LAST_NAME_ENTITY_WORDS_WIDE = LAST_NAME_ENTITY_WORDS + (" LP",)
LAST_NAME_ARTICLES = ("THE", "A", "AN")
NAME_SUFFIX = r"(?i)\s+(JR|SR|II|III|IV)\.?$"
SURNAME_PARTICLES = ("DE", "LA", "DEL", "VAN", "VON", "MC", "O", "DI", "DA", "LE", "DU")
BUSINESS_WORDS = (
    "LLC", " LC", "INC", "CORP", "CO ", "LTD", " LP", "LLP", "TRUST", "TRUSTEE", "ESTATE", "CHURCH", "BANK",
    "COUNTY", "CITY", "STATE", "FEDERAL", "PROPERTIES", "PROPERTY", "INVESTMENTS", "HOLDINGS", "DEVELOPMENT",
    "ENTERPRISES", "ASSOCIATES", "PARTNERS", "MANAGEMENT", "SERVICES", "COMPANY", "FOUNDATION", "ASSOCIATION",
    "HOSPITAL", "SCHOOL", "UNIVERSITY", "CEMETERY", "MINISTRY", "BAPTIST", "METHODIST", "LUTHERAN",
    "PRESBYTERIAN", "CATHOLIC", "REALTY", "RENTALS", "STORAGE", "FARM", "FARMS", "RANCH", "BUILDERS",
    "CONSTRUCTION", "ELECTRIC", "UTILITY", "MORTGAGE", "FINANCIAL", "CAPITAL", "ET AL", "ETAL", "ETALS", " GROUP")

# --- property records ----------------------------------------------------------
PROPERTY_CLASSES = {1: "Residential", 2: "Agricultural/Undeveloped", 3: "Multi-Family", 4: "Commercial",
                    5: "Industrial", 6: "Land Use (Deferred)", 7: "Public Service", 8: "Exempt", 9: "Mineral"}
# Search order of the districts, spelled without spaces, and their display names.
DISTRICTS = {"BACKCREEK": "Back Creek", "GAINESBORO": "Gainesboro", "OPEQUON": "Opequon", "REDBUD": "Red Bud",
             "SHAWNEE": "Shawnee", "STONEWALL": "Stonewall", "STEPHENSCITY": "Stephens City",
             "MIDDLETOWN": "Middletown"}
DISTRICT_FEATURE_NAMES = {"Opequon district": "Opequon", "Gainesboro district": "Gainesboro",
                          "Back Creek district": "Back Creek", "Shawnee district": "Shawnee",
                          "Stonewall district": "Stonewall", "Red Bud district": "Red Bud"}
HOME_STATE = "VA"

# Lines of a tax book that belong to no record.  "has": found in the upper-cased
# line; "starts": the line starts with it; "regex": found in the line.
JUNK_LINES = {"has": ("COUNTY OF FREDERICK", "COMMISSIONER OF THE REVENUE", "PAGE TOTALS", "CLASS TOTALS",
                      "FINAL TOTALS"),
              "starts": ("DATE:", "RATE ", "PAGE"),
              "regex": (r"^CLASS\s*\d",)}
JUNK_LINES_STRICT = {"has": JUNK_LINES["has"],
                     "starts": JUNK_LINES["starts"] + ("TX390BK",),
                     "regex": JUNK_LINES["regex"] + ("INVALID",)}
# A run of digits is tried at its head only and gives nothing back (``*+``), as what follows it cannot be in the run: the
# same first match as of ``[\d,]+``, in a time linear in the text. Listed digits are one look-up, ``\d`` is several calls.
_DIGITS = "0123456789"
_NUMBER = rf"[{_DIGITS},](?<![{_DIGITS},]{{2}})[{_DIGITS},]*+"
_NEXT = rf"\s++[{_DIGITS},]++"
RECORD_START = r"^(\d+[A-Z]?\s*-)"
RECORD_PATTERNS = {
    "parcel_code": r"^(\d+[A-Z]?\s*-\s*-?\s*\d*[A-Z]?\s*-?\s*-?\s*\d*\s*-?\s*-?\s*\d*(?:-[A-Z])?)",
    "parcel_code_strict": r"^(\d+[A-Z]?\s*-\s*-?\s*\d*[A-Z]?\s*-?\s*-?\s*\d*\s*-?\s*-?\s*\d*(?:-[A-Z0-9]+)?)",
    "account_number": r"ACCT-?\s*(\d+)",
    "property_class": r"CL\s*(\d)",
    "zone": r"ZN\s*([A-Z0-9]+)",
    "acreage": rf"([{_DIGITS}.](?<![{_DIGITS}.]{{2}})[{_DIGITS}.]*+)\s*+(?i:ACRES?|AC\b)",
    "first_half_tax": r"FH\s*([\d,]+\.?\d*)",
    "second_half_tax": r"SH\s*([\d,]+\.?\d*)",
    "deferred_value": rf"({_NUMBER})\s*+DEFERRED",
}
# Words without which a pattern cannot match: far cheaper to look for.
RECORD_WORDS = {"deferred_value": "DEFERRED", "four": "ACCT-", "three": "ACCT"}
VALUE_BLOCK = rf"{_NUMBER}{_NEXT}{_NEXT}{_NEXT}\.?+[{_DIGITS}]*+\s++ACCT-"
VALUE_BLOCK_LAND_ONLY = rf"{_NUMBER}{_NEXT}{_NEXT}\.?+[{_DIGITS}]*+\s++ACCT-"
# Of all matches, one may begin inside a run, right behind the match before it.
VALUE_BLOCK_ANY = rf"(?:\G[{_DIGITS},]|[{_DIGITS},](?<![{_DIGITS},]{{2}}))[{_DIGITS},]*+{_NEXT}{_NEXT}{_NEXT}\.[{_DIGITS}]{{2}}"
VALUE_BLOCK_LAND_ONLY_STRICT = rf"[{_DIGITS}]{{1,3}}+(?:,\d{{3}})*+\s++\d{{1,3}}+(?:,\d{{3}})*+\s++\d++\.?+\d*+\s++ACCT"
VALUE_CAPS = {"total": 50_000_000, "tax": 500_000}
VALUE_CAPS_STRICT = {"total": 100_000_000, "tax": 1_000_000}
TAX_RATE_RANGE = (0.001, 0.02)
SUM_TOLERANCE = 100
OWNER_LINE_SKIP = (r"^(ACCT|FH|SH|AC\s|CL\s|ZN\s|\d+\.\d+\s*CL)", r"^[\d,]+\s+[\d,]+\s+[\d,]+")
DESCRIPTION_PATTERNS = (
    r"(?i)((?:LOT|L)\s*\d+[A-Z]?\s*(?:P\d+)?\s*(?:S\d+)?)",
    r"(?i)(LAKE\s*HOLIDAY\s*EST[.\s]*L\d+)",
    r"(?i)(SHAWNEE\s*LAND\s*L\d+)",
    r"(?i)(?<![\w\s])([\w\s]+(?:SUBDIVISION|ESTATES?|VILLAGE|ACRES?|TRACT))",
)
STATE_PATTERN = r"\b([A-Z]{2})\s+\d{5}"
CITY_PATTERN = r"^([A-Z\s]+)\s+[A-Z]{2}\s+\d{5}"

# --- anomaly bounds ------------------------------------------------------------
ANOMALY = {"land_ratio_total": 100_000, "land_ratio": 0.9, "tiny_acres": 0.1, "tiny_total": 500_000,
           "large_acres": 50, "large_total": 100_000, "exempt_class": 6, "repeat_over": 3, "repeat_sample": 10,
           "agricultural_class": 2, "agricultural_improvement": 5_000_000, "acreage_cap": 10_000,
           "landowner_acres": 50}

# --- school divisions ------------------------------------------------------------
DIVISIONS = {"069": "Frederick County", "043": "Clarke County", "061": "Fauquier County",
             "171": "Shenandoah County", "187": "Warren County", "107": "Loudoun County"}
TARGET_DIVISION = "069"
TREND_YEARS = ("FY2020", "FY2021", "FY2022", "FY2023", "FY2024")
THRESHOLDS = {"admin_ratio_target": 5.0, "admin_ratio_warning": 10.0, "instruction_ratio_target": 65.0,
              "instruction_ratio_warning": 60.0, "admin_to_student_target": 250, "admin_to_student_warning": 150,
              "per_pupil_admin_warning": 1200}
AUDIT_THRESHOLDS = {"admin_pct_of_total_staff": 10.0, "admin_per_1000_students": 3.5,
                    "admin_to_teacher_ratio": 0.05, "admin_growth_vs_enrollment": 2.0}
# Texts of the flags; {v} is the value, {t} the threshold.
BENCHMARK_MESSAGES = {
    "admin_ratio_warning": "Administrative spending ratio ({v}%) exceeds {t}% threshold",
    "admin_ratio_target": "Administrative spending ratio ({v}%) above {t}% target",
    "instruction_ratio_warning": "Instruction spending ratio ({v}%) below {t}% minimum",
    "instruction_ratio_target": "Instruction spending ratio ({v}%) below {t}% target",
    "admin_to_student_warning": "Admin-to-student ratio (1:{v}) below 1:{t} threshold",
    "admin_to_student_target": "Admin-to-student ratio (1:{v}) below 1:{t} target",
    "per_pupil_admin_warning": "Per-pupil admin spending (${v}) exceeds ${t} threshold",
}
CONSOLIDATED_MESSAGES = {
    "admin_ratio_warning": "Admin spending ({v}%) exceeds {t}% threshold",
    "admin_ratio_target": "Admin spending ({v}%) above {t}% target",
    "instruction_ratio_warning": "Instruction spending ({v}%) below {t}% minimum",
    "per_pupil_admin_warning": "Per-pupil admin (${v}) exceeds ${t}",
}
HISTORY_MESSAGES = {
    "admin_ratio_warning": "Admin spending ({v:.1f}%) exceeds {t}% threshold",
    "admin_ratio_target": "Admin spending ({v:.1f}%) above {t}% target",
    "instruction_ratio_warning": "Instruction ({v:.1f}%) below {t}% minimum",
    "per_pupil_admin_warning": "Per-pupil admin (${v:.0f}) exceeds ${t}",
}
AUDIT_TITLES = {
    "admin_pct_of_total_staff": "High Admin Ratio",
    "admin_per_1000_students": "High Admin Per Student",
    "admin_to_teacher_ratio": "High Admin-to-Teacher Ratio",
    "admin_growth_vs_enrollment": "Admin Growing Faster Than Enrollment",
    "school_pct_of_budget": "Declining School Share of County Budget",
    "ok": "Admin Ratio Within Threshold",
}
AUDIT_MESSAGES = {
    "admin_pct_of_total_staff": "Admin staff ({v}%) exceeds {t}% threshold",
    "admin_per_1000_students": "Admin positions per 1000 students ({v}) exceeds {t} threshold",
    "admin_to_teacher_ratio": "Admin-to-teacher ratio ({v:.4f}) exceeds {t} threshold",
    "admin_growth_vs_enrollment": "Admin growth (%s%%) is %sx enrollment growth (%s%%)",
    "school_pct_of_budget": "School share declined from %s%% (%s) to %s%% (%s)",
    "ok": "Admin staff ratio (%s%%) is within acceptable range",
}
PER_UNIT_CATEGORIES = {"total": "total", "instruction": "instruction", "administration": "administration",
                       "pupil_transportation": "transportation", "operations_maintenance": "operations",
                       "facilities": "facilities", "debt_service": "debt_service", "technology": "technology"}
SHARE_CATEGORIES = ("instruction", "administration", "pupil_transportation", "operations_maintenance",
                    "facilities", "debt_service", "technology")

# --- finance survey file ---------------------------------------------------------
SURVEY_KEY = "LEAID"
SURVEY_MISSING = ("-1", "-2", "-3", "-9", "M", "N", "R", "")
SURVEY_FIELDS = {
    "V33": "enrollment", "TOTALREV": "total_revenue", "TFEDREV": "federal_revenue", "TSTREV": "state_revenue",
    "TLOCREV": "local_revenue", "TOTALEXP": "total_expenditures", "TCURELSC": "current_expenditures",
    "TCURINST": "instruction_expenditures", "TCURSSVC": "support_services", "E17": "pupil_support",
    "E07": "instructional_staff_support", "E08": "general_administration", "E09": "school_administration",
    "TCUROTH": "other_current", "E11": "operations_maintenance", "TNONELSE": "non_elementary_secondary",
    "TCAPOUT": "capital_outlay"}
SURVEY_MIN_CELLS = 10

# --- files -----------------------------------------------------------------------
FILE_BUCKETS = ("enrollment", "expenditure", "staffing", "vdoe", "apa")
RECORD_KEYS = ("data", "records", "features", "annual_data")
DOCUMENT_TYPES = ("proposed", "adopted", "acfr")
NULL_AMOUNT_MARKS = ("-", "", "N/A", "--")
NULL_AMOUNT_MARKS_V1 = ("-", "", "N/A")

# --- budget text -------------------------------------------------------------------
LINE_PATTERNS = {
    "personnel": r"^([A-Za-z][A-Za-z/&\s\.\-]+?)\s+(\d+\.?\d*)\s+(\d+)\s+(\d+\.?\d*)\s+(\d+)\s+(\d+\.?\d*)\s+(\d+)\s*$",
    "expenditure": r"^([A-Za-z][A-Za-z/&\s\.\-\(\)]+?)\s+\$?([\d,]+)\s+\$?([\d,]+)\s+\$?([\d,]+)\s*$",
    "summary": r"^([A-Za-z][A-Za-z/\s\.\-\(\)&,]+?)\s+\$([\d,]+)\s+\$([\d,]+)\s+\$([\d,]+)\s+\$([\d,]+)\s+([\d\.]+)%",
}
LINE_MEASURES = {
    "personnel": ("fy_minus_2_full_time", "fy_minus_2_part_time", "fy_minus_1_full_time", "fy_minus_1_part_time",
                  "fy_current_full_time", "fy_current_part_time"),
    "expenditure": ("personnel", "operating", "capital"),
    "summary": ("prior_budgeted", "prior_actual", "current_budgeted", "adopted", "pct_of_total"),
}
SECTIONS = {
    "expenditures": r"(?is)TOTAL EXPENDITURES ALL FUNDS.*?(?=County of Frederick|GENERAL FUND EXPENDITURES|\z)",
    "personnel": r"(?is)PERSONNEL NEEDS.*?(?=The reasons for the change|County of Frederick|\z)",
    "staffing": r"(?is)(?:Position|Staffing|FTE|Personnel)\s+Summary.*?(?=\n\n|\z)",
}
SECTION_CATEGORIES = {
    "general_govt_admin": r"Administration\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "judicial_admin": r"Judicial\s+Administration\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "public_safety": r"Public\s+Safety\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "public_works": r"Public\s+Works\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "health_welfare": r"Health/Welfare\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "community_college": r"Community\s+College\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "parks_recreation": r"Parks,?\s*Recreation.*?Cultural\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "community_dev": r"Community\s+Development\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "miscellaneous": r"Miscellaneous\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "regional_jail": r"Regional\s+Jail\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "landfill": r"Landfill\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "school_funds": r"School\s+Funds\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+)",
    "total": r"Total\s+Expenditures\s+\$([\d,]+)\s+\$([\d,]+)\s+\$([\d,]+)\s+\$([\d,]+)",
}
SECTION_MEASURES = ("prior_budgeted", "prior_actual", "current_budgeted", "adopted")
STAFF_CATEGORIES = {
    "board_of_supervisors": r"Board of Supervisors\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "county_administrator": r"County Administrator\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "county_attorney": r"County Attorney\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "human_resources": r"Human Resources\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "commissioner_revenue": r"COR/Reassessment\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "treasurer": r"Treasurer\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "finance": r"Finance\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "it_mis": r"IT/MIS\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "sheriff": r"Sheriff\s+([\d.]+)\s+(\d+)\s+([\d.]+)\s+(\d+)\s+([\d.]+)\s+(\d+)",
    "fire_rescue": r"Fire and Rescue\s+([\d.]+)\s+(\d+)\s+([\d.]+)\s+(\d+)\s+([\d.]+)\s+(\d+)",
    "public_safety_comm": r"Public Safety Communications\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "social_services": r"Social Services\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "parks_recreation": r"Parks and Recreation\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "planning_dev": r"Planning and Development\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
}
STAFF_TOTALS = {
    "general_fund_total": r"Total\s+Positions\s+General\s+Fund\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "regional_jail": r"Regional\s+Jail\s+Fund\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)",
    "school_funds": r"School\s+Funds\s+([\d.]+)\s+(\d+)\s+([\d.]+)\s+(\d+)\s+([\d.]+)\s+(\d+)",
    "all_funds_total": r"Total\s+Positions\s+All\s+Funds\s+([\d.]+)\s+(\d+)\s+([\d.]+)\s+(\d+)\s+([\d.]+)\s+(\d+)",
}
STAFF_MEASURES = ("fy_minus_2_full_time", "fy_minus_2_part_time", "fy_minus_1_full_time", "fy_minus_1_part_time",
                  "current_full_time", "current_part_time")
FUND_PATTERNS = {
    "general_fund": r"(?i)General\s+Fund\s+(?:Total)?.*?([0-9,]+(?:\.[0-9]+)?)",
    "school_operating": r"(?i)School\s+Operating.*?([0-9,]+(?:\.[0-9]+)?)",
    "school_debt": r"(?i)School\s+Debt.*?([0-9,]+(?:\.[0-9]+)?)",
    "school_capital": r"(?i)School\s+Capital.*?([0-9,]+(?:\.[0-9]+)?)",
    "capital_projects": r"(?i)Capital\s+(?:Projects?\s+)?Fund.*?([0-9,]+(?:\.[0-9]+)?)",
    "debt_service": r"(?i)Debt\s+Service.*?([0-9,]+(?:\.[0-9]+)?)",
}
FUNCTION_PATTERNS = {
    "general_govt_admin": r"(?i)General\s+Govern(?:ment|mental)\s+Admin(?:istration)?.*?([0-9,]+)",
    "judicial_admin": r"(?i)Judicial\s+Admin(?:istration)?.*?([0-9,]+)",
    "public_safety": r"(?i)Public\s+Safety.*?([0-9,]+)",
    "public_works": r"(?i)Public\s+Works.*?([0-9,]+)",
    "health_welfare": r"(?i)Health.*?(?:and|&)?\s*(?:Social\s+)?(?:Welfare|Services).*?([0-9,]+)",
    "parks_recreation": r"(?i)Parks.*?(?:Recreation|Cultural).*?([0-9,]+)",
    "community_dev": r"(?i)(?:Community\s+Development|Planning.*?Development).*?([0-9,]+)",
}
NAME_COUNT_PATTERN = r"([A-Za-z\s&/]+?)\s+(\d+\.?\d*)\s*(?:FTE|positions?)?"
PAGE_MARKERS = {
    "personnel": ("PERSONNEL NEEDS", "Full-Time", "Part-Time"),
    "expenditure_categories": ("CATEGORY SUMMARY", "Personnel", "Operating"),
    "general_fund": ("GENERAL FUND EXPENDITURES", "Administration", "Public Safety",
                     "Transfer to School Operating Fund"),
}
TABLE_KEYWORDS = ("expenditure", "expense", "spending", "instruction", "administration", "operation",
                  "transportation", "facilities", "debt", "total", "budget", "actual")
ROW_CATEGORIES = {
    "instruction": r"instruction|teaching|classroom",
    "administration": r"admin|executive|board|superintendent|central office",
    "attendance_health": r"attendance|health|nurse|counselor|guidance",
    "pupil_transportation": r"transport|bus",
    "operations_maintenance": r"operation|maintenance|custod|util",
    "facilities": r"facilit|capital|construction|building",
    "debt_service": r"debt|bond|interest|principal",
    "technology": r"technolog|computer|it\s|information",
}
ROW_OTHER_OVER = 1000

# --- district page: field -> (pattern, type) ------------------------------------------
PAGE_FIELDS = {
    "enrollment": (r"Total Students:</th>\s*<td[^>]*>([0-9,]+)", "bigint"),
    "teachers_fte": (r"Classroom Teachers \(FTE\):</th>\s*<td[^>]*>([0-9,.]+)", "double"),
    "student_teacher_ratio": (r"Student/Teacher Ratio:</th>\s*<td[^>]*>([0-9.]+)", "double"),
    "total_staff_fte": (r"has a staff count of\s*<b[^>]*>\s*([0-9,.]+)", "double"),
    "staff_breakdown.instructional_aides": (r"(?i)Instructional Aides:</th>\s*<td>([0-9,.]+)", "double"),
    "staff_breakdown.instructional_coordinators": (
        r"(?i)Instruc\. Coordinators[^<]*</B?></th>\s*<td>([0-9,.]+)",
        "double"),
    "staff_breakdown.guidance_counselors": (r"(?i)Total Guidance Counselors:</th>\s*<td>([0-9,.]+)", "double"),
    "staff_breakdown.school_psychologists": (r"(?i)School Psychologists:</th>\s*<td>([0-9,.]+)", "double"),
    "staff_breakdown.librarians": (r"(?i)Librarians/Media Specialists:</th>\s*<td>([0-9,.]+)", "double"),
    "staff_breakdown.district_administrators": (r"(?i)District Administrators:</th>\s*<td>([0-9,.]+)", "double"),
    "staff_breakdown.district_admin_support": (
        r"(?i)District Administrative Support:</th>\s*<td>([0-9,.]+)",
        "double"),
    "staff_breakdown.school_administrators": (r"(?i)School Administrators:</th>\s*<td>([0-9,.]+)", "double"),
    "staff_breakdown.school_admin_support": (r"(?i)School Administrative Support:</th>\s*<td>([0-9,.]+)", "double"),
    "revenue.total_revenue": (r"Total Revenue:</b></font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)", "bigint"),
    "revenue.federal_revenue": (r"Federal:</font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)", "bigint"),
    "revenue.local_revenue": (r"Local:</font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)", "bigint"),
    "revenue.state_revenue": (r"State:</font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)", "bigint"),
    "expenditures.total_expenditures": (
        r"Total Expenditures:</b></font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)",
        "bigint"),
    "expenditures.total_current_expenditures": (
        r"Total Current Expenditures:</b></font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)",
        "bigint"),
    "expenditures.instructional_expenditures": (
        r"Instructional Expenditures:</font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)",
        "bigint"),
    "expenditures.student_staff_support": (
        r"Student and Staff Support:</font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)",
        "bigint"),
    "expenditures.administration": (r"Administration:</font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)", "bigint"),
    "expenditures.operations_food_other": (
        r"Operations, Food Service, other:</font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)",
        "bigint"),
    "expenditures.capital_outlay": (
        r"Total Capital Outlay:</b></font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)",
        "bigint"),
    "per_pupil.total_revenue_pp": (
        r"Total Revenue:</b></font></td>\s*<td[^>]*><font[^>]*>\$[0-9,]+</font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)",
        "bigint"),
    "per_pupil.total_expenditures_pp": (
        r"Total Expenditures:</b></font></td>\s*<td[^>]*><font[^>]*>\$[0-9,]+</font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)",
        "bigint"),
    "per_pupil.instructional_pp": (
        r"Instructional Expenditures:</font></td>\s*<td[^>]*><font[^>]*>\$[0-9,]+</font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)",
        "bigint"),
    "per_pupil.administration_pp": (
        r"Administration:</font></td>\s*<td[^>]*><font[^>]*>\$[0-9,]+</font></td>\s*<td[^>]*><font[^>]*>\$([0-9,]+)",
        "bigint"),
}

# --- sheet grids: header keywords and ordered header -> field rules ---------------------
# A rule matches when every group has a word that occurs in the lower-cased header.
GRID_HEADERS = {
    "enrollment": ((("division", "adm", "enrollment"),),),
    "staffing": ((("division",), ("teacher", "salary", "staff")),),
    "expenditures": ((("division",), ("expenditure", "per pupil")),),
    "comparative": ((("locality", "county", "city", "expenditure"),),),
}
_ADM = ("adm", "membership", "enrollment")
GRID_FIELDS = {
    "enrollment": (
        ("adm_total", (_ADM, ("total", "all"))),
        ("adm_elementary", (_ADM, ("elementary", "elem"))),
        ("adm_middle", (_ADM, ("middle",))),
        ("adm_high", (_ADM, ("high", "secondary"))),
        ("adm", (_ADM,)),
    ),
    "staffing": (
        ("teachers", (("teacher",), ("number",))),
        ("administrators", (("admin",), ("number",))),
        ("instructional_aides", (("aide", "paraprofessional"),)),
        ("counselors", (("counselor",),)),
        ("librarians", (("librarian",),)),
        ("avg_teacher_salary", (("salary",), ("teacher",))),
        ("avg_admin_salary", (("salary",), ("admin",))),
    ),
    "expenditures": (
        ("per_pupil_total", (("per pupil",), ("total",))),
        ("per_pupil_instruction", (("per pupil",), ("instruction",))),
        ("per_pupil_administration", (("per pupil",), ("admin",))),
        ("per_pupil_operations", (("per pupil",), ("operation",))),
        ("per_pupil_transportation", (("per pupil",), ("transport",))),
        ("per_pupil_other", (("per pupil",),)),
        ("revenue_state", (("state",), ("revenue", "fund"))),
        ("revenue_local", (("local",), ("revenue", "fund"))),
        ("revenue_federal", (("federal",), ("revenue", "fund"))),
        ("expenditures_total", (("total",), ("expenditure",))),
    ),
}
# Comparative report: words of the sheets to read, and of the column that names the place.
COMPARATIVE_SHEETS = ("c-6", "education", "school")
COMPARATIVE_KEYS = ("locality", "county", "city", "jurisdiction")
KEY_HEADERS = ("division", "div", "code", "division code", "div code", "division number", "division name",
               "school division", "locality", "county")
