"""Per-source NULL tokens applied before typing (L4).

Fixed values: event feed texts equal to one of these become NULL; rig
sheet texts keep the empty string (no tokens).
"""

QUAKE_NULL_TOKENS = ("NULL", "null", "")
RIG_NULL_TOKENS: tuple[str, ...] = ()
COUNTY_NULL_TOKENS = ("", "\\N")
