"""Column expressions that reproduce the scalar semantics the reports rely on.

Everything here is a built-in Spark expression (JVM side, inside whole-stage codegen);
nothing calls back into Python per row.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

EASTERN = "America/New_York"  # DST-aware zone behind "Eastern Standard Time"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- dates and times -------------------------------------------------------------------

def boundary_diff(unit: str, start: ColumnOrName, end: ColumnOrName) -> Column:
    """DATEDIFF(unit, start, end) counting unit *boundaries crossed* (not elapsed units).

    Truncating both sides to the unit first turns Spark's elapsed-units difference into
    the boundary count: 00:00:59 -> 00:01:00 is one minute boundary.
    """
    unit = unit.upper()
    s, e = _c(start), _c(end)
    if unit == "DAY":
        return F.datediff(F.to_date(e), F.to_date(s))
    if unit in ("HOUR", "MINUTE", "SECOND"):
        return F.timestamp_diff(unit, F.date_trunc(unit, s), F.date_trunc(unit, e))
    raise ValueError(f"unsupported unit {unit}")


def utc_to_eastern(ts: ColumnOrName) -> Column:
    """``ts AT TIME ZONE 'UTC' AT TIME ZONE 'Eastern Standard Time'`` as wall-clock time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(EASTERN), _c(ts))


def weekday_mon0(ts: ColumnOrName) -> Column:
    """Language-independent weekday: Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts))


def weekday_name(ts: ColumnOrName) -> Column:
    """DATENAME(weekday, ts) under an English session."""
    return F.date_format(_c(ts), "EEEE")


# --- strings ---------------------------------------------------------------------------

def tsql_len(s: ColumnOrName) -> Column:
    """LEN(): character count ignoring trailing blanks."""
    return F.length(F.rtrim(_c(s)))


def plus_concat(*cols: ColumnOrName) -> Column:
    """``a + b`` on strings: NULL if any operand is NULL."""
    return F.concat(*[_c(c) for c in cols])


def tsql_concat(*cols: ColumnOrName) -> Column:
    """CONCAT(a, b, ...): NULL operands count as empty strings."""
    return F.concat(*[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


def charindex(needle: str, haystack: ColumnOrName) -> Column:
    """CHARINDEX: 1-based position of the first occurrence, 0 when absent."""
    return F.instr(_c(haystack), needle)


def is_digits(s: ColumnOrName) -> Column:
    """Numeric test restricted to plain digit strings (documented narrowing of ISNUMERIC)."""
    return F.coalesce(_c(s).rlike("^[0-9]+$"), F.lit(False))


def valid_npi(s: ColumnOrName) -> Column:
    """Provider number check: ten digits, not starting with 9; trailing blanks do not count."""
    return F.coalesce(F.rtrim(_c(s)).rlike("^[0-8][0-9]{9}$"), F.lit(False))


# --- NULL handling and flags ------------------------------------------------------------

def fallback(col: ColumnOrName, alt: ColumnOrName, sentinels: Iterable[str] = ("", "~")) -> Column:
    """Replace NULL or a sentinel (compared ignoring trailing blanks) by ``alt``."""
    c = _c(col)
    hit = F.rtrim(c).isin(*[s.rstrip(" ") for s in sentinels])
    return F.when(c.isNull() | hit, _c(alt)).otherwise(c)


def flag_off(col: ColumnOrName) -> Column:
    """``col IS NULL OR col = 0``."""
    return F.coalesce(_c(col), F.lit(0)) == 0


def signed_amount(amount: ColumnOrName, adj_type: ColumnOrName, negate_code: str = "1") -> Column:
    """Adjustment lines of type ``negate_code`` carry the payment with a minus sign."""
    a = _c(amount)
    return F.when(_c(adj_type) == negate_code, -a).otherwise(a)


def bit(cond: Column) -> Column:
    """Boolean -> 0/1 integer (NULL -> 0), the way CASE WHEN ... THEN 1 ELSE 0 reads."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


# --- numbers as text ---------------------------------------------------------------------

def float_label(x: ColumnOrName, null_text: str = "N/A") -> Column:
    """CONVERT(VARCHAR, float): at most 6 significant digits, no padding zeros,
    three-digit exponents in scientific form; ``null_text`` when NULL."""
    v = _c(x).cast("double")
    s = F.format_string("%.6g", v)
    s = F.regexp_replace(s, r"(\.[0-9]*?)0+(e|$)", "$1$2")
    s = F.regexp_replace(s, r"\.(e|$)", "$1")
    s = F.regexp_replace(s, r"e([+-])([0-9]{2})$", "e$10$2")
    return F.when(v.isNull(), F.lit(null_text)).otherwise(s)


def hundredths(count: ColumnOrName, total: ColumnOrName) -> Column:
    """round(100 * count / total, 2) * 100 as an exact integer, half rounded up."""
    n, t = _c(count).cast("long"), _c(total).cast("long")
    a, b = F.lit(2) * n * F.lit(10000) + t, F.lit(2) * t
    # exact integer floor division: a - pmod(a, b) is a multiple of b
    return ((a - F.pmod(a, b)) / b).cast("long")
