"""Column helpers that give PostgreSQL semantics with native Spark expressions.

Everything here returns a ``Column`` and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Enum members in declaration order.
SCORING_CLASSES = ("star", "good", "average", "bad")
VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")

# Referrer classification after the site's own domains, first
# match wins ('%t.co%' also matches reddit.com and is tested first).
EXTERNAL_REFERRER_RULES = (
    ("%t.co%", "Twitter"),
    ("%linkedin%", "Linkedin"),
    ("%reddit%", "Reddit"),
)
# The site's own domains are deployment data: the fixture site serves
# *.shop.example. A deployment passes its own patterns.
SITE_DOMAIN_PATTERNS = ("%shop.example%",)


def referrer_rules(site_patterns=SITE_DOMAIN_PATTERNS):
    """The rule list: own-site patterns -> On-site, then the external rules."""
    return tuple((p, "On-site") for p in site_patterns) + EXTERNAL_REFERRER_RULES


REFERRER_RULES = referrer_rules()

# 32-bit activity masks (top bit = newest day).
MASK_32 = 0xFFFFFFFF
WEEK_MASK = 0xFE000000
DAY_MASK = 0x80000000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_elem(arr) -> Column:
    """``a[1]``: 1-based, NULL when out of range."""
    return F.try_element_at(col(arr), F.lit(1))


def last_elem(arr) -> Column:
    """``a[CARDINALITY(a)]``."""
    return F.try_element_at(col(arr), F.lit(-1))


def pg_dow(d) -> Column:
    """``EXTRACT(dow FROM d)``: Sunday = 0."""
    return (F.dayofweek(col(d)) - 1).cast("bigint")


def days_between(later, earlier) -> Column:
    """``date - date`` as an integer."""
    return F.datediff(col(later), col(earlier))


def safe_divisor(d) -> Column:
    """``CASE WHEN d = 0 THEN 1 ELSE d END``."""
    d = col(d)
    return F.when(d == 0, F.lit(1)).otherwise(d)


def score_class(pts, thresholds=(20, 15, 10), labels=SCORING_CLASSES) -> Column:
    """Strictly-greater thresholds, first match wins, ELSE the last label."""
    pts = col(pts)
    out = F.when(pts > thresholds[0], labels[0])
    for t, lab in zip(thresholds[1:], labels[1:-1]):
        out = out.when(pts > t, lab)
    return out.otherwise(labels[-1])


def referrer_class(referrer, rules=REFERRER_RULES, null_label="Direct", other="Other") -> Column:
    """LIKE rules in order; NULL referrer is Direct (LIKE on NULL is NULL, so
    the NULL test may come after the patterns)."""
    r = col(referrer)
    out = None
    for pattern, label in rules:
        cond = r.like(pattern)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.when(r.isNull(), null_label).otherwise(other)


def bit32(x) -> Column:
    """``CAST(bigint AS BIT(32))`` keeps the low 32 bits."""
    return col(x).bitwiseAND(F.lit(MASK_32))


def bit32_text(x) -> Column:
    return F.lpad(F.bin(bit32(x)), 32, "0")


def has_any_bit(x, mask: int = MASK_32) -> Column:
    return F.bit_count(col(x).bitwiseAND(F.lit(mask))) > 0


def render_list(arr, fmt: str | None = None) -> Column:
    """Canonical text of an array of scalars: comma-joined, in array order.

    ``fmt`` is a ``date_format`` pattern for date/timestamp elements."""
    if fmt:
        return F.array_join(F.transform(col(arr), lambda x: F.date_format(x, fmt)), ",")
    return F.array_join(F.transform(col(arr), lambda x: x.cast("string")), ",")



def wall_instant(c) -> Column:
    """TIMESTAMP_NTZ -> the TIMESTAMP whose UTC wall clock equals it, in any
    session time zone: hour windows then start on wall-clock hours and
    durations are wall-clock durations."""
    return F.from_utc_timestamp(col(c).cast("timestamp"), F.current_timezone())


def wall_clock(c) -> Column:
    """Inverse of ``wall_instant``: TIMESTAMP -> TIMESTAMP_NTZ of its UTC wall clock."""
    return F.to_utc_timestamp(col(c), F.current_timezone()).cast("timestamp_ntz")


def wall_micros(c) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ wall clock."""
    return F.unix_micros(wall_instant(c))
