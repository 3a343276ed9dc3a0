"""Label and band expressions.

Everything here is a ``Column`` builder: it stays inside Catalyst (codegen), no UDF.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the values of the original report for the
# results to match.  Kept together, in their natural order.
# ---------------------------------------------------------------------------
# Gateway type -> gateway group; any other non-NULL type -> OTHER_GATEWAY_GROUP.
GATEWAY_GROUP_OF_TYPE = {"wepay": "WePay", "stripe": "Stripe", "adyen": "Adyen"}
OTHER_GATEWAY_GROUP = "Other"
WEPAY_GROUP = "WePay"
# Take-rate fallbacks when no take-rate row matches (WePay, every other group).
DEFAULT_FALLBACK_WEPAY = Decimal("0.0053729985439988")
DEFAULT_FALLBACK_OTHER = Decimal("0.001074863799773")
# Organization label when organization_id has no label.
UNKNOWN_ORGANIZATION = "unknown"
# Size bands: strictly greater than the threshold, checked top down.
SIZE_BANDS = [
    (2500000, "1. Strategic (>$2.5m)"),
    (1000000, "2. Very Large ($1m - $2.5m)"),
    (250000, "3. Large ($250k - $1m)"),
    (100000, "4. Medium ($100k - $250k)"),
    (25000, "5. Small ($25k - $100k)"),
    (10000, "6. Very Small ($10k - $25k)"),
    (0, "7. Micro ($1 - $10k)"),
]
NON_ACTIVE_BAND = "8. Non Active (<= $0)"
# Attribution: lower-cased sources folded into META_SOURCE; defaults.
META_SOURCES = ("facebook", "fb", "instagram")
META_SOURCE = "meta"
DEFAULT_ATTRIBUTION_TYPE = "organic"
DEFAULT_ATTRIBUTION_SOURCE = "unknown"
# Status names in rule order.
STATUS_NEW = "new"
STATUS_LOST = "lost"
STATUS_LAPSED = "lapsed"
STATUS_RECOVERED = "recovered"
STATUS_UPSELL = "upsell"
STATUS_DOWNSELL = "downsell"
STATUS_NEGATIVE = "negative or null"
STATUS_UNKNOWN = "unknown"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gateway_group(gateway_type) -> Column:
    """Group of a gateway type; NULL type stays NULL (it matches no group row)."""
    t = _col(gateway_type)
    expr = F.when(t.isNull(), F.lit(None).cast("string"))
    for raw, group in GATEWAY_GROUP_OF_TYPE.items():
        expr = expr.when(t == raw, F.lit(group))
    return expr.otherwise(F.lit(OTHER_GATEWAY_GROUP))


def organization_label(organization_id, labels: dict[int, str]) -> Column:
    """Label of an organization id; unlabelled or NULL ids -> ``unknown``.

    The label mapping is a parameter: the report's own organization names are
    deployment data, not logic.
    """
    o = _col(organization_id)
    if not labels:
        return F.lit(UNKNOWN_ORGANIZATION)
    expr = None
    for key, name in labels.items():
        expr = F.when(o == key, F.lit(name)) if expr is None else expr.when(o == key, F.lit(name))
    return expr.otherwise(F.lit(UNKNOWN_ORGANIZATION))


def size_band(value, bands=SIZE_BANDS, non_active: str = NON_ACTIVE_BAND) -> Column:
    """First band whose threshold the value strictly exceeds; else non-active.

    NULL falls through to the non-active band, as in a CASE with ELSE.
    """
    v = _col(value)
    expr = None
    for threshold, name in bands:
        cond = v > F.lit(threshold)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(non_active))


def attribution_source(utm_source) -> Column:
    """Fold facebook/fb/instagram (any case) into ``meta``; NULL -> ``unknown``."""
    s = _col(utm_source)
    folded = F.when(F.lower(s).isin(*META_SOURCES), F.lit(META_SOURCE)).otherwise(s)
    return F.coalesce(folded, F.lit(DEFAULT_ATTRIBUTION_SOURCE))


def attribution_type(utm_medium) -> Column:
    return F.coalesce(_col(utm_medium), F.lit(DEFAULT_ATTRIBUTION_TYPE))


def any_null(*cols) -> Column:
    return reduce(lambda a, b: a | b, [_col(c).isNull() for c in cols])
