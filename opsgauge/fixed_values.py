"""Codes and thresholds that the measures are defined on.

Fixed values: they must equal the codes in the source tables. Everything that belongs to one
deployment (queue names, organisation names, staff and technician ids, work call types) is not
here; the caller supplies it.
"""

UK, IRELAND = "UK", "IRELAND"
IE_INSTALLATION_PREFIX = "7"

# public holidays of England and Wales
HOLIDAYS = (
    "2024-01-01", "2024-03-29", "2024-04-01", "2024-05-06", "2024-05-27", "2024-08-26",
    "2024-12-25", "2024-12-26", "2025-01-01", "2025-04-18", "2025-04-21", "2025-05-05",
    "2025-05-26", "2025-08-25", "2025-12-25", "2025-12-26",
)
HOLIDAYS_WITH_NEXT_YEAR = (*HOLIDAYS, "2026-01-01")

# contact logs
CONTACT_SOURCES = ("CS", "CUDE", "CUSV", "ATT")
CONTACT_CREATORS_LEFT_OUT = ("Automatic", "BUSSOA", "COMMLOG", "IBS")
CONTACT_MEDIA = ("   ", "CHA", "EMA", "PHO", "TEL", "WAP")
CONTACT_KEY_LEFT_OUT = "GDPR"
CONTACT_DIRECTION = "Incoming"

# alarm incidences
TEST_ALARM = ("TA", "CONFIA", ("INTIME", "TAMRES"))
REPEATED_REPORT = "RETREP"
AUTOMATED_CANCELLATIONS = ("CONFIA", "CONFORT")
PANELS = ("SDVECU", "SDVFAST")

# field services
FINISHED = "FINL"
ERROR_STATUS = "CERR"
NOT_AWARE_REQUESTER = "GTI"
NO_INSTALLATION = "0"
INTERNAL_CALL_TYPE = "100"
BURGLARY_CALL_TYPE = "ROBB"
SLA_ACTIVITIES_LEFT_OUT = (
    "Retention oppertunity", "Installations", "Moonshot Upgrade", "System Dismantle",
)
WARRANTY_DAYS = {
    "UK270": 0, "UK191": 30, "UK192": 30, "UK197": 30, "UK198": 30, "UK320": 30, "UK330": 30,
}
WARRANTY_DAYS_DEFAULT = 90
LINES = (
    "230020", "270009", "270019", "270023", "270030", "270013", "270017", "270020", "270024",
    "270016", "270025",
)
LINES_WITH_ACCESSORIES = (
    "230020", "270009", "270019", "270023", "270030", "265009", "270013", "270017", "270020",
    "270024", "270016", "270025",
)
LINES_FIRST_TIME_FIX = (
    "230020", "270009", "270019", "270023", "270026", "270024", "270025", "270030",
)
RETAINED, NOT_RETAINED, PENDING, TAKEOVER = "RETAINED", "NOT RETAINED", "PENDING", "RETI TAKEOVER"
ADHERENCE_PREFIXES_LEFT_OUT = ("IE", "IN")

# back office
NEVER_CANCELLED = "1980-01-01 00:00:00"
SENT_TO_FIELD = "OPSE"
CLOSING_CUTS = ((24, "24h"), (48, "48h"), (72, "72h"), (168, "3 to 7 days"))
CLOSING_ABOVE = "Over 7 days"
ACTIVE_RULES = (
    (("OP",), ("CUEM", "CUOP", "GRAT")),
    (("STBY",), ("CUEM", "CUOP", "STBY")),
    (("XCAN",), ("CUEM", "CUOP")),
    (("EDOC", "INST", "N/A"), ("CUOP",)),
)
PANEL_ERROR = "ERROR"
DEVICE = "FG"

# tickets and the care line
ESCALATION_PROBLEM = "CVIP"
CANCELLATION, RECONNECTION, CHANGE_OF_NAME = "CANC", "RECO", "CCN"
TICKET_CLOSED, TICKET_ERROR = "CLOSED", "ERROR"
RESOLVED_RETAINED, RESOLVED_CANCELLED = "Retained", "Cancelled"
NO_ASSIGNMENT_DAY = "2030-01-01"
ANSWERED = ("Completed", "Transferred", "Conferenced")
ANSWERED_REASON = "AbandonedFromHold"
ABANDONED = "Abandoned"
ABANDONED_REASONS = ("AbandonedWhileQueued", "AbandonedWhileRinging")
IE_CALLER_PREFIX, IE_CALLER_PREFIX_LEFT_OUT = "08", "080"

# question forms and schedule changes
FAQ_ROLES = ("FSE", "Installer")
SCHEDULE_DONE = "completed"
SCHEDULE_ADDED = ("completed", "started")
SCHEDULE_UNCHANGED = ("completed", "suspended", "notdone", "pending")
SCHEDULE_REMOVED = "Removed"
