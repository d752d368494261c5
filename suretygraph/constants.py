"""Default parameters of the operators.

Fixed values: they decide results, so they are stated as they are. Every operator takes them as
keyword arguments.
"""

VALID_COUNTRIES = ("CL", "PE", "MX", "BR")
FREE_BENEFITS = ("FREE_PROMO_90D", "PARTNER_ZERO_FEE", "WELCOME_OFFER")
APPROVED_STATUS = "APPROVED"

HIGH_RISK_USD = 50_000
VERY_HIGH_RISK_USD = 200_000
HIGH_VOLUME_TRANSACTIONS = 10
WINDOW_DAYS = 7

MAX_ATTEMPTS = 5
RETRY_STATUSES = {429: "RATE_LIMITED", 503: "UNAVAILABLE"}

# Ordered: the first keyword found in the lower-cased company name decides.
DOMAIN_KEYWORDS = (
    ("novatech", "novatech.cl"),
    ("andina", "andinaseguros.pe"),
    ("patagonia", "patagoniaguarantees.com.br"),
    ("mexicredit", "mexicredit.mx"),
    ("apex", "apexfinance.cl"),
    ("pacifico", "pacificoavales.pe"),
    ("boreal", "borealinsurtech.com.br"),
    ("atlantica", "atlanticagarantias.mx"),
    ("sierra", "sierraventure.cl"),
    ("austral", "australleasing.pe"),
)
UNKNOWN_DOMAIN = "unknown-company.com"

# A join side is broadcast only when it was counted and stays under both limits.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 32 * 1024 * 1024
