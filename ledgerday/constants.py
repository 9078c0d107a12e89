"""Fixed values.

These strings and numbers must equal the codes stored in the movement ledger
and the report names stored in the contact table, otherwise the reports come
out empty.  They are only the *defaults* of the parameter objects in
:mod:`ledgerday.params`; no operator reads them directly.
"""

# --- fixed values: ledger item names ---------------------------------------
COAL_ITEM = "COAL - IMPORT"
MAIZE_ITEM = "YELLOW MAIZE (CORN)"
ETHANOL_ITEM = "DENATURED ANHYDROUS ETHANOL (PRODUCED FROM MAIZE)(4PPM BRUCINE SULPHATE)"
ETHANOL_LABEL = "ETHANOL"
SCRAP_ITEMS = ("SCRAP EMPTY GUNNY BAGS", "COMMERCIAL SCRAP")

# --- fixed values: ledger codes --------------------------------------------
PRODUCTION_CODE = "Q"
SALE_CODE = "S"
RETURN_NATURES = ("SR",)
CANCELLED_PARTY = "CANCEL PARTY"
KG_UNIT = "KGS"
TONNE_UNIT = "MT"
KG_PER_TONNE = 1000

# --- fixed values: report names, "to" flags and subject titles -------------
COAL_REPORT = "Coal Availability (Email) "
MAIZE_REPORT = "Maize Availability (Email)"
MONTHLY_REPORT = "MIS Email Monthly"
COAL_TO_FLAG = "coal_avail_email"
MAIZE_TO_FLAG = "maize_avail_email"
MONTHLY_TO_FLAG = "mis_email_monthly"
COAL_SUBJECT = "Power Plant Data Not Available"
MAIZE_SUBJECT = "Production Details Not Available"
# The monthly subject carries an organisation prefix in practice; the caller
# supplies it through ``Report.subject``.
MONTHLY_SUBJECT = "Daily MIS Report"

# --- fixed values: run defaults ---------------------------------------------
CHANNELS = ("email", "whatsapp")
MAX_DAYS_BACK = 7
LOG_RETENTION = 30
DATE_OFFSET = 1
DATE_TEXT_FORMAT = "dd/MM/yyyy"
