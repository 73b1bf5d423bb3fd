"""Fixed lookup values used by the dashboard views.

These values must equal the reference's for identical output; they are
stated here verbatim, in their natural order.
"""

# --- fixed values: postal code -> full state name (53 entries) -------------
STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California",
    "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "FL": "Florida", "GA": "Georgia",
    "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa",
    "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri",
    "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey",
    "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio",
    "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont",
    "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
    "DC": "District of Columbia", "PR": "Puerto Rico", "VI": "Virgin Islands",
}

# --- fixed values: office code -> label ----------------------------------
OFFICE_LABELS = {"P": "President", "H": "House", "S": "Senate"}

# --- fixed values: labels of the network edge branches --------------------
SOURCE_INDIVIDUAL = "Individual Donor"
SOURCE_COMMITTEE = "Committee/PAC"
FLOW_DIRECT = "Direct Campaign Contribution"
FLOW_PAC_TO_CANDIDATE = "PAC to Candidate Contribution"
FLOW_TRANSFER = "Inter-PAC Transfer"
FLOW_INDEPENDENT = "Independent Expenditure (IE)"

# --- fixed values: donor-mix slice labels ----------------------------------
MIX_INDIVIDUAL = "Individual Donors"
MIX_COMMITTEE = "Political Committees (PACs)"

# --- fixed values: transaction-type codes of the split itpas2 source -------
CODE_DIRECT = "24K"
CODES_INDEPENDENT = ("24E", "24A")

# --- fixed values: defaults of the gold job --------------------------------
INDIVIDUAL_MIN_WEIGHT = 15000
TRANSFER_MIN_WEIGHT = 30000
TRANSFER_CYCLE = "2026"
EMPLOYER_DEFAULT = "NOT SPECIFIED"
TOP_EDGES = 15
TOP_STATES = 5
