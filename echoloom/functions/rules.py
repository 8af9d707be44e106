"""Rule tables, as data. The operators turn them into Catalyst expressions."""

# Contact patterns and their replacement, in the order they are applied.
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
UK_PHONE = r"\b0\d{4}[\s.-]*\d{6}\b"
INTL_PHONE = r"(\+?\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"
# The e-mail pattern as the engine runs it: a match can only start where a run of local-part
# characters starts or where the last match ended, which keeps long tokens linear.
EMAIL_LINEAR = r"(?:\G|(?<![a-zA-Z0-9._%+-]))[a-zA-Z0-9._%+-]++@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
# What every phone number holds: ten digits with nothing between them but what may stand between the digits of a number.
TEN_DIGITS = r"[0-9](?:[-.\s()]*+[0-9]){9}"
EMAIL_TOKEN = "[EMAIL]"
PHONE_TOKEN = "[PHONE]"
CONTACT_COLUMNS = ["message_text", "user_id", "metadata"]

# Issue rules. Ordered; the first matching rule wins; matching is by
# case-insensitive substring, so "late" is found inside "chocolate".
ISSUE_RULES = {
    "BUG_REPORT": [
        ("payment|pay|checkout|card|failed|transaction", "Payment/Checkout Failure"),
        ("crash|freeze|stuck|spinner|loading", "App Crash/Freeze"),
        ("login|sign in|otp|code|sms|text", "Login/Authentication"),
        ("search|find|filter", "Search Functionality"),
        ("button|tap|click|dead|nothing", "Button/UI Not Working"),
        (r"update|version|since|4\.", "Post-Update Issues"),
        ("voucher|promo|code|discount|coupon", "Promo Code Issues"),
        ("duplicate|double|twice|two times", "Duplicate Charges"),
    ],
    "FEATURE_REQUEST": [
        ("dark mode|dark theme|night mode", "Dark Mode"),
        ("group order|split bill|share|collaborative|friends add", "Group/Split Orders"),
        ("schedule|pre-order|later|advance", "Scheduled Orders"),
        ("favorite|favourite|save|bookmark", "Favorites/Saved Items"),
        ("track|real.?time|gps|map|location|driver", "Better Tracking"),
        ("notification|alert|update|remind", "Notifications/Alerts"),
        ("filter|dietary|allerg|vegan|gluten", "Dietary Filters"),
        ("tip|gratuity", "Tipping Options"),
        ("icon|logo|design|ui", "UI/Design Changes"),
        ("paypal|payment method|wallet", "Payment Methods"),
    ],
    "COMPLAINT_DELIVERY": [
        ("late|slow|took|minutes|hour|wait", "Late Delivery"),
        ("cold|warm|temperature", "Food Temperature"),
        ("wrong|incorrect|mistake|not what", "Wrong Order"),
        ("missing|forgot|incomplete|half", "Missing Items"),
        ("cancel|never came|no show", "Order Cancelled/No Show"),
        ("driver|address|location|building", "Driver/Location Issues"),
        ("damage|spill|squash|soggy", "Damaged Food"),
    ],
}
ISSUE_FALLBACK = {"BUG_REPORT": "Other Bug", "FEATURE_REQUEST": "Other Feature Request",
                  "COMPLAINT_DELIVERY": "Other Delivery Issue"}
ISSUE_CONSTANT = {"COMPLAINT_PRICING": "Pricing/Fees Too High",
                  "COMPLAINT_SUPPORT": "Customer Support Issues",
                  "COMPLAINT_APP": "App Performance"}
ISSUE_CATEGORY = {"BUG_REPORT": "BUG"}

# The offline labeller (our own; stands in for a hosted model): ordered
# (pattern, category, confidence, rationale), first match wins.
CATEGORY_RULES = [
    (r"^\s*$", "UNCLEAR", 0.2, "The message is empty."),
    ("please add|would love|i wish|feature request|it would be great|it would be nice|could you add",
     "FEATURE_REQUEST", 0.91, "Asks for a new capability."),
    (r"^(how|where|when|what|can i|do you|is there) .*\?", "QUESTION", 0.88,
     "Asks about existing functionality."),
    ("crash|freez|error|broken|not working|does nothing|fails|failed|stuck|charged twice",
     "BUG_REPORT", 0.86, "Describes a technical malfunction."),
    ("support agent|customer service|refund|no reply|ticket", "COMPLAINT_SUPPORT", 0.82,
     "Is unhappy with support."),
    ("fees|service fee|price|pricing|expensive|overcharged", "COMPLAINT_PRICING", 0.84,
     "Is unhappy with the cost."),
    ("delivery|delivered|courier|driver|food|order was|order is|order never|arrived|missing",
     "COMPLAINT_DELIVERY", 0.8, "Is unhappy with a delivery."),
    ("laggy|clunky|confusing|hard to use|sluggish", "COMPLAINT_APP", 0.74,
     "Is unhappy with the app."),
    ("love|great|excellent|amazing|perfect|thank", "PRAISE", 0.9, "Expresses satisfaction."),
]
CATEGORY_DEFAULT = ("UNCLEAR", 0.45, "No category is clearly supported by the message.")
# Whole words; a trailing * matches any ending.
POSITIVE_WORDS = "love great excellent amazing perfect thank thanks nice good happy".split()
NEGATIVE_WORDS = ("late cold wrong missing crash* freez* error broken fail* stuck bad terrible angry "
                  "expensive laggy clunky confusing never unhappy slow").split()
CLASSIFIER_VERSION = "keyword-labels-v1"

# Whitespace as a browser trims it (Spark's trim strips only the blank).
WEB_BLANKS = ("\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
              "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff")
UUID_V4 = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
DECISION_KEY = "^[a-z0-9-]{2,64}$"
