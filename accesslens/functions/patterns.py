"""Which part of a line each field is.

The patterns are plain text in the syntax Spark shares with most regex engines.
No two neighbouring repetitions in a pattern can share characters, so that a
long token without blanks or a request that is not closed is passed over in
time linear in its length.
"""

# First token of the line, if a dot in it has a character before it and two after.
HOST = r"^(\S[^. \t-\r]*\.\S\S+)\s"

# What is quoted: method, endpoint and, if there is one, protocol. It is looked for once
# per token, not once per quote, so tokens full of quotes take linear time too. Its parts
# are what white space separates.
REQUEST = r'(?<!\S)[^" \t-\r]*"(\S+\s\S+(?:\s+\S*)?)"'
REQUEST_PARTS = r"\s+"

# First token of exactly three digits that has a blank on both sides.
STATUS = r"\s(\d{3})\s"

# Digits that end the line.
CONTENT_SIZE = r"\s(\d+)$"

# Times after an opening bracket. No calendar has a year 0000.
CLF_DATE = r"\[(\d{2}/\w{3}/(?!0000)\d{4})"
CLF_TIME = r"\[(\d{2}/\w{3}/(?!0000)\d{4}:\d{2}:\d{2}:\d{2})"
ISO_TIME = r"\[((?!0000)\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})]"

# Everything between the brackets, offset included.
BRACKETED = r"^[^\[]*\[([^\]]*)\]"

MONTHS = (
    "jan", "feb", "mar", "apr", "may", "jun",
    "jul", "aug", "sep", "oct", "nov", "dec",
)
WEEKDAYS = (
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
)

# What stands for a time or weekday the line does not have.
UNKNOWN = "Unknown"
