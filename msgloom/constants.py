"""Word lists, bins, patterns and defaults that results depend on."""

# --- Fixed values: labels -------------------------------------------------------------
INTENT_LABELS = [
    "account_management",
    "check_promotions",
    "complaint",
    "contact_support",
    "delivery_information",
    "inquire_business_hours",
    "manage_shipping_address",
    "newsletter_subscription",
    "queries_related_to_order",
    "queries_related_to_payment/fee",
    "queries_related_to_refund",
    "request_bill",
    "request_invoice",
    "review",
]
OTHER_LABEL = "other"
INVALID_LABEL = "INVALID_LABEL"

# --- Fixed values: entity type -> placeholder -----------------------------------------
ENTITY_PLACEHOLDERS = {
    "PERSON": "[PERSON_NAME]",
    "GPE": "[DELIVERY_LOCATION]",
    "LOC": "[DELIVERY_LOCATION]",
    "MONEY": "[REFUND_AMOUNT]",
    "DATE": "[DATE]",
    "DATE_TIME": "[DATE_TIME]",
    "ORG": "[ORGANIZATION]",
    "PRODUCT": "[PRODUCT]",
    "ACCOUNT_TYPE": "[ACCOUNT_TYPE]",
    "PHONE_NUMBER": "[PHONE_NUMBER]",
    "EMAIL_ADDRESS": "[EMAIL_ADDRESS]",
    "CREDIT_CARD": "[CREDIT_CARD]",
    "IBAN_CODE": "[IBAN]",
    "US_BANK_NUMBER": "[BANK_NUMBER]",
    "US_DRIVER_LICENSE": "[US_DRIVER_LICENSE]",
    "ORDER_ID": "[ORDER_ID]",
    "INVOICE_NUMBER": "[INVOICE_NUMBER]",
    "BILL_NUMBER": "[BILL_NUMBER]",
    "STOP_ENTITY": "[STOP_ENTITY]",
}
STOP_PLACEHOLDER = "[STOP_ENTITY]"

# --- Fixed values: which placeholders keep a readable value, and which only presence ---
READABLE_PLACEHOLDERS = ["ACCOUNT_TYPE", "DELIVERY_LOCATION"]
REFERENCE_PLACEHOLDERS = ["ORDER_ID", "INVOICE_NUMBER", "BILL_NUMBER"]
SENSITIVE_PLACEHOLDERS = ["PERSON_NAME", "EMAIL_ADDRESS", "PHONE_NUMBER", "CREDIT_CARD"]

# --- Fixed values: keywords of the reference and account rules ------------------------
ORDER_WORDS = ["order", "purchase", "ord"]
INVOICE_WORDS = ["invoice", "inv"]
BILL_WORDS = ["bill", "billing", "billno", "bno"]
ACCOUNT_WORDS = ["pro", "standard", "freemium", "platinum", "gold", "savings", "checking"]
PLACE_WORDS = ["kent", "streetsboro"]
STOP_WORDS = ["eta", "modify", "cancel", "signup", "lodge", "solve", "delete"]

# --- Fixed values: bins ---------------------------------------------------------------
AMOUNT_BIN_EDGES = [0, 10, 50, 100, 500, 1000, 1000000]
RECENCY_BIN_EDGES_MONTHS = [0, 1, 6, 12, 1200]
RECENCY_BIN_LABELS = ["0_30days", "31_180days", "181_365days", "365_plus"]

# --- Fixed values: calendar and number words ------------------------------------------
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
#: Months that are also common words.
WORD_MONTHS = ["march", "may"]
DATE_PREPOSITIONS = ["in", "since", "until", "during", "by", "of", "last", "next"]
DAY_WORDS = ["yesterday", "today", "tomorrow", "tonight"]
NUMBER_WORDS = [
    "one", "two", "three", "four", "five", "six",
    "seven", "eight", "nine", "ten", "eleven", "twelve",
]

# --- Fixed values: currencies and domains ---------------------------------------------
CURRENCY_CODES = ["usd", "eur", "gbp"]
CURRENCY_WORDS = ["dollars", "dollar", "euros", "euro", "pounds"]
TOP_DOMAINS = ["com", "org", "net", "edu", "gov", "info", "io"]

# --- Fixed values: patterns over placeholder text -------------------------------------
PLACEHOLDER_PATTERN = r"(?i)\[([A-Z0-9_]+)(?:=([^\]]+))?\]"
PLACEHOLDER_KEY_PATTERN = r"(?i)\[([A-Z0-9_=-]+)\]"
ID_LIKE_PATTERN = (
    r"(?i)\[[^\]]*(?:hash|\b[0-9a-f]{8,}\b|[0-9]{6,}"
    r"|\b(?:inv|invoice|invno|ord|order|orderid|bill)[-_]?[0-9]{4,}\b)[^\]]*\]"
)
LEFTOVER_ID_PATTERN = r"(?i)\[[^\]]*(?:[0-9]|[0-9a-f]{6,}|hash)[^\]]*\]"
LABEL_WORD_PATTERN = r"(?i)\b(request_[a-z0-9_/]+|queries_related_[a-z0-9_/]+)\b"
ABLATED_PLACEHOLDERS = [
    "INVOICE_PRESENT", "ID_PRESENT", "PERSON_PRESENT", "BILL_PRESENT",
    "INVOICE", "BILL", "ORDER_ID",
]
SUSPICIOUS_TOKEN_WORDS = ["hash", "order", "invoice", "person", "phone", "email"]

# --- Fixed values: order in which a group key looks for an identifier ------------------
GROUP_KEY_PLACEHOLDERS = [
    "ORDER_ID", "INVOICE_NUMBER", "BILL_NUMBER",
    "EMAIL_ADDRESS", "PHONE_NUMBER", "PERSON_NAME",
]

# --- Fixed values: strings a CSV reader takes for missing ------------------------------
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# --- Fixed values: defaults -----------------------------------------------------------
SEED = 42
TEST_RATIO = 0.15
VALID_RATIO = 0.15
MAX_TOKENS = 64
DEFAULT_THRESHOLD = 0.80
NO_POSITIVES_THRESHOLD = 0.75
FOCAL_GAMMA = 2.0

# Character classes. Unicode white space is spelled out, so that every regex engine
# agrees on what ends a word.
WHITESPACE = (
    r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
ASCII_WHITESPACE = r"\t-\r\x1c-\x20"

# A table joined as a broadcast may hold at most this many rows; see operators.bounded.
MAX_LABELS = 10_000
