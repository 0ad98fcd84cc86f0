"""Small SQL fragments shared by the oracle queries (DuckDB dialect)."""

from __future__ import annotations


def half_even_mean(int_sum: str, n: str) -> str:
    """Exact half-to-even rounding of ``int_sum / n`` to 2 decimals, as DOUBLE.

    Integer arithmetic only, so it does not depend on the engine's float or
    decimal rounding rules. ``int_sum`` must be a non-negative integral value.
    """
    t = f"(CAST({int_sum} AS HUGEINT) * 100)"
    q = f"({t} // ({n}))"
    r = f"({t} % ({n}))"
    return (f"(CAST({q} + CASE WHEN 2 * {r} > ({n}) OR (2 * {r} = ({n}) AND {q} % 2 = 1) "
            f"THEN 1 ELSE 0 END AS DOUBLE) / 100)")


LETTER_SQL = ("CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' "
              "WHEN score >= 60 THEN 'D' ELSE 'F' END")

# Unicode whitespace as in Python's str.isspace(); RE2 and Java read the same escapes.
PY_WS_CHARS = (r"\t\n\x{0b}\x{0c}\r\x{1c}\x{1d}\x{1e}\x{1f} \x{85}\x{a0}\x{1680}"
               r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")


def py_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^[{PY_WS_CHARS}]+|[{PY_WS_CHARS}]+$', '', 'g')"


def tax(base: str) -> str:
    """Progressive tax in the same floating-point order as the operator."""
    s1 = base
    s2 = f"least({s1}, 1000000)"
    s3 = f"least({s2}, 250000)"
    s4 = f"least({s3}, 100000)"
    return (f"((CASE WHEN {s1} > 1000000 THEN ({s1} - 1000000) * 0.35 ELSE 0.0 END)"
            f" + (CASE WHEN {s2} > 250000 THEN ({s2} - 250000) * 0.30 ELSE 0.0 END)"
            f" + (CASE WHEN {s3} > 100000 THEN ({s3} - 100000) * 0.25 ELSE 0.0 END)"
            f" + (CASE WHEN {s4} > 30000 THEN ({s4} - 30000) * 0.20 ELSE 0.0 END))")

# The email pattern and the integer syntax, as in functions/text.py.
EMAIL_RE = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+\n?\z"
PY_INT_RE = rf"^[{PY_WS_CHARS}]*[+-]?[0-9]+(_[0-9]+)*[{PY_WS_CHARS}]*$"


def py_int(expr: str) -> str:
    from tessera.functions.text import decimal_digits

    src, dst = decimal_digits()
    d = f"translate({expr}, '{src}', '{dst}')"
    return (f"CASE WHEN regexp_matches({d}, '{PY_INT_RE}') "
            f"THEN TRY_CAST(replace({py_strip(d)}, '_', '') AS BIGINT) END")


def email_ok(expr: str) -> str:
    return f"coalesce(regexp_matches({expr}, '{EMAIL_RE}'), false)"


def py_blank(expr: str) -> str:
    return f"({expr} IS NULL OR {py_strip(expr)} = '')"


def clean_text(expr: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower({expr}), '[^a-z0-9{PY_WS_CHARS}]', '', 'g'), "
            f"'[{PY_WS_CHARS}]+', ' ', 'g'))")
