"""Business parameters.

Fixed values: results only match the published rules when these are exactly as written.
Everything here is a default; the plans take them as keyword arguments where a user may want another.
"""

# Currency and tax
USD_TO_GHS = "11.40"
VAT_RATE = "0.15"
NHIL_RATE = "0.025"
GETFUND_RATE = "0.025"
WITHHOLDING_GOODS = "0.03"
WITHHOLDING_SERVICES = "0.075"
WITHHOLDING_WORKS = "0.05"
LABOUR_RATE_GHS = "180"
RENTAL_DAYS_PER_MONTH = 26
WARRANTY_DAYS = 730

# Revenue streams
EQUIPMENT_SALES = "Equipment Sales"
RENTAL = "Rental"
SERVICE = "Service"

# Failure model
MODEL_VERSION = "gbt-v1"
SEVERITY_WEIGHT = {"Critical": "3.0", "Warning": "1.5", "Info": "1.0"}
FAILURE = "Failure"
LABEL_WINDOW_DAYS = 21
HOLDOUT_DAYS = 60
WATCH_THRESHOLD = 0.4
ACTION_THRESHOLD = 0.7
NEVER_MAINTAINED_DAYS = 9999
FEATURES = [
    "weighted_score_7d",
    "weighted_score_14d",
    "weighted_score_30d",
    "critical_count_7d",
    "critical_count_14d",
    "engine_hours",
    "machine_age_days",
    "days_since_last_maintenance",
]
# Days of notice recommended per component id
ACTION_WINDOW_BY_COMPONENT = {
    1: 14, 2: 11, 3: 19, 4: 10, 5: 7, 6: 15, 7: 32, 8: 27, 9: 24, 10: 20, 11: 11, 12: 8,
}

# Signal handling
DUPLICATE_REASON = "Duplicate - open work order already scheduled for this machine"
ESCALATION_TIER = "Platinum"
ESCALATION_WINDOW_DAYS = 10
ADVISOR_DISMISS_RATE = 0.15
ADVISOR_REASONS = [
    "Advisor judgment - likely false reading",
    "Customer declined proactive service at this time",
    "Machine already scheduled for service through another channel",
]
CRITICAL_PROBABILITY = 0.85
SLA_HOURS_BY_TIER = {"Platinum": 6, "Gold": 12, "Silver": 24, "Standard": 48}
DEFAULT_TIER = "Standard"
DEFAULT_SLA_HOURS = 24
PREDICTIVE_DEMAND = "Predictive Signal"
BASELINE_DEMAND = "Historical Baseline"

# Branch network
BRANCHES = ["Accra", "Kumasi", "Takoradi", "Tarkwa"]
DEFAULT_BRANCH = "Accra"
BRANCH_BY_CUSTOMER = {
    1: "Tarkwa", 2: "Kumasi", 3: "Kumasi", 4: "Tarkwa", 5: "Kumasi", 6: "Tarkwa",
    7: "Tarkwa", 8: "Accra", 9: "Tarkwa", 10: "Accra", 11: "Accra", 12: "Accra",
    13: "Accra", 14: "Accra", 15: "Accra", 16: "Takoradi", 17: "Kumasi", 18: "Accra",
}

# Calendar bounds
CALENDAR_FIRST = "2016-01-01"
CALENDAR_LAST = "2027-12-31"

# Inventory
DEAD_STOCK_DAYS = 180
MIN_DAILY_USE = 0.01

# Access control: which regions each role may read
REGIONS_BY_ROLE = {
    "analyst": ["Western", "Ashanti", "Greater Accra", "Eastern", "Ahafo", "Bono"],
    "analyst_western": ["Western"],
    "analyst_accra": ["Greater Accra"],
}
UNRESTRICTED_ROLES = ("admin", "etl")

# Value domains
CUSTOMER_TYPES = [
    "Owner-Operator", "Contract Miner", "Construction Contractor", "Quarry Operator", "Logistics/Energy",
]
TIERS = ["Standard", "Silver", "Gold", "Platinum"]
APPLICATIONS = ["Mining", "Construction", "Both"]
OWNERSHIP_TYPES = ["Owned", "Rented"]
EQUIPMENT_STATUSES = ["Active", "Idle", "Decommissioned", "In Stock"]
SYSTEM_CATEGORIES = ["Hydraulics", "Engine", "Undercarriage", "Powertrain", "Electrical"]
SEVERITIES = ["Info", "Warning", "Critical"]
RATE_TYPES = ["Daily", "Monthly"]
MAINTENANCE_TYPES = ["Preventive", "Predictive", "Corrective", "Inspection"]
PRIORITIES = ["Critical", "High", "Routine"]
WORK_ORDER_STATUSES = ["Scheduled", "In Progress", "Completed", "Overdue"]
SIGNAL_STATUSES = ["New", "Watch", "Action Recommended", "Reviewed", "Converted", "Dismissed", "Expired"]
DEMAND_SOURCES = [PREDICTIVE_DEMAND, BASELINE_DEMAND]
OUTCOMES = ["Confirmed Failure", "False Positive"]
FILING_STATUSES = ["Pending", "Filed", "Overdue"]
