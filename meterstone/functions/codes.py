"""Code tables of the source systems."""

# Source code -> business label.
SEGMENTS = {
    "RES": "Residential",
    "SMB": "Small/Medium Business",
    "CI": "Commercial & Industrial",
    "GOV": "Government",
}
COMMODITIES = {"01": "Electric", "02": "Gas"}
BILL_TYPES = {"01": "Regular", "02": "Rebill", "03": "Final"}
PAYMENT_CHANNELS = {
    "ACH": "Autopay (ACH)",
    "WEB": "Online",
    "APP": "Mobile App",
    "IVR": "Phone (IVR)",
    "CHK": "Mail (Check)",
    "AGT": "Authorized Pay Agent",
    "ASST": "Energy Assistance",
}
PLAN_TYPES = {"WTP": "Winter Termination Program"}
OTHER_PLAN_TYPE = "Deferred Payment Arrangement"
PLAN_STATUSES = {
    "ACTV": "Active",
    "COMP": "Completed",
    "DFLT": "Defaulted",
    "CANC": "Cancelled",
}
SUPPLIERS = {"TPS": "Third-Party Supplier"}
OTHER_SUPPLIER = "Utility Default Supply"
SERVICE_ORDER_TYPES = {
    "MOVE_IN": "Move In",
    "MOVE_OUT": "Move Out",
    "DISC_NP": "Disconnect for Non-Pay",
    "RECONNECT": "Reconnect",
    "METER_EXCH": "Meter Exchange",
    "HIGH_BILL_INV": "High Bill Investigation",
    "NEW_SVC": "New Service Connection",
    "GAS_LEAK_INV": "Gas Leak Investigation",
}
SERVICE_ORDER_STATUSES = {"COMP": "Completed", "OPEN": "Open", "CANC": "Cancelled"}
WORK_ORDER_TYPES = {
    "PM01": "Corrective",
    "PM02": "Preventive",
    "PM03": "Emergency",
    "PM04": "Capital Replacement",
}
WORK_ORDER_STATUSES = {
    "CRTD": "Created",
    "REL": "Released",
    "TECO": "Technically Complete",
    "CLSD": "Closed",
    "DLFL": "Deleted",
}
OPEN_WORK_ORDER_CODES = ("CRTD", "REL")
RATE_CLASSES = {"RES": "Residential", "COM": "Commercial", "IND": "Industrial"}
ASSISTED_CHANNELS = ("Phone - Agent", "Chat", "Email")
AGENT_CHANNEL = "Phone - Agent"
DIGITAL_CHANNELS = ("Autopay (ACH)", "Online", "Mobile App")
ASSISTANCE_CHANNEL = "Energy Assistance"
RESIDENTIAL_CLASS = "Residential & Non-Commercial"
COMMERCIAL_CLASS = "Commercial & Industrial"
RESIDENTIAL_CLASS_CODES = ("RES", "GOV")
