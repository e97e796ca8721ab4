"""Results are only right if these stay as they are."""

# Decline reasons, in the order the rules are tried.
CARD_NOT_FOUND = "Card not found"
OVER_HALF_LIMIT = "Transaction exceeds 50% of credit limit"
OVER_TOTAL_LIMIT = "Total balance exceeds credit limit"
ADDRESS_NOT_FOUND = "Customer address not found"
TOO_FAR = "Merchant location too far"
NO_LOCATION = "Error extracting zip codes: 'NoneType' object has no attribute 'strip'"

# Why a row is set aside unchecked.
NO_ID = "no transaction id"
NO_TIME = "no time"
NO_AMOUNT = "no amount"
AMOUNT_UNFIT = "amount is not a number that fits"
CARD_WITHOUT_LIMIT = "card without limit or balance"

# Transaction status.
NEVER_STREAMED = ""
PENDING = "pending"
DECLINED = "declined"
APPROVED = "approved"

# Share of the credit limit that a single transaction has to stay under.
SINGLE_AMOUNT_SHARE = 0.5

# Credit score change by utilisation: (highest utilisation in percent, change).
SCORE_BANDS = [(10, 15), (20, 10), (30, 5), (50, -5), (70, -15)]
SCORE_ABOVE_BANDS = -25

# Credit limit factor by score change: (highest score change, factor).
LIMIT_FACTORS = [(-20, 0.85), (-10, 0.90)]
LIMIT_FACTOR_SMALL_DROP = 0.95

ZIP_LENGTH = 5

# Time formats: on the wire and in the stream result.
MESSAGE_TIME = "yyyy-MM-dd HH:mm:ss"
RESULT_TIME = "dd-MM-yyyy HH:mm:ss"

TOPIC = "transactions"

# Characters that count as white space at the ends of an address or a location.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
