"""Column expressions shared by the operators.

All helpers return native Catalyst expressions (no Python UDFs), so they stay
inside whole-stage codegen and DuckDB can express the same thing for checks.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the dimensional model.
# Open end of a validity interval, and the money type used for amounts.
OPEN_END = _dt.date(9999, 12, 31)
MONEY_PRECISION = 18
MONEY_SCALE = 2


def money(c: Column | str) -> Column:
    """Exact money type; cast before summing so totals are order-independent."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(f"decimal({MONEY_PRECISION},{MONEY_SCALE})")


def date_key(c: Column | str) -> Column:
    """int yyyyMMdd key of a date (calendar surrogate key)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyyMMdd").cast("int")


def day_in_week(c: Column | str) -> Column:
    """Monday = 1 … Sunday = 7."""
    col = F.col(c) if isinstance(c, str) else c
    return F.weekday(col) + F.lit(1)


def is_weekend(c: Column | str) -> Column:
    """'Y' on Saturday and Sunday, else 'N'."""
    return F.when(day_in_week(c) >= 6, F.lit("Y")).otherwise(F.lit("N"))


def md5_draw(*parts: Column | str, salt: str = "") -> Column:
    """Reproducible pseudo-random non-negative bigint from the given columns.

    First 32 bits of md5(parts ‖ salt). DuckDB: ('0x' || substr(md5(x),1,8))::bigint.
    """
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(salt))
    return F.conv(F.substr(F.md5(text), F.lit(1), F.lit(8)), 16, 10).cast("bigint")


DRAW_BITS = 30


def md5_draws(*parts: Column | str, n: int, salt: str = "g") -> list[Column]:
    """``n`` reproducible non-negative 30-bit draws from the given columns.

    Each md5(parts ‖ salt‖k) gives two 15-hex-digit integers (one base
    conversion each), each split into two 30-bit draws — four draws per md5.
    DuckDB: v = ('0x' || substr(md5(x), 1 + 15*j, 15))::BIGINT; v >> 30, v & (2^30-1).
    """
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    out: list[Column] = []
    for i in range(n):
        g, j, half = i // 4, (i % 4) // 2, i % 2
        text = F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(f"{salt}{g}"))
        v = F.conv(F.substr(F.md5(text), F.lit(1 + 15 * j), F.lit(15)), 16, 10).cast("bigint")
        out.append(F.shiftright(v, DRAW_BITS) if half == 0
                   else v.bitwiseAND(F.lit((1 << DRAW_BITS) - 1)))
    return out


def discount_bucket(draw: Column) -> Column:
    """Discount percent from a draw in 0..188, skewed toward small discounts.

    The model takes 5 - int(cuberoot(28 + draw)) tens of percent; floating point
    puts the perfect cubes 64/125/216 one bucket short, so we use exact
    thresholds every engine agrees on: 28+draw <= 64 -> 20, <= 125 -> 10, else 0.
    """
    v = draw + F.lit(28)
    return (F.when(v <= 64, F.lit(20)).when(v <= 125, F.lit(10)).otherwise(F.lit(0)))


def spare_quantity(is_spare: Column | str, quantity: Column | str) -> Column:
    """Quantity when the spare flag is 't', else 0 (a plain CASE, never a UDF)."""
    flag = F.col(is_spare) if isinstance(is_spare, str) else is_spare
    qty = F.col(quantity) if isinstance(quantity, str) else quantity
    return F.when(flag == F.lit("t"), qty).otherwise(F.lit(0))


def null_safe_changed(cols: list[str], left: str = "t", right: str = "s") -> Column:
    """True when any attribute differs, NULLs compared as values (no hash collisions)."""
    conds = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def register_sql_functions(spark: SparkSession) -> None:
    """SQL surface for the helpers; SQL functions are inlined by Catalyst."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION spare_quantity(is_spare STRING, quantity DOUBLE) "
        "RETURNS DOUBLE RETURN CASE WHEN is_spare = 't' THEN quantity ELSE 0 END")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION date_key(d DATE) "
        "RETURNS INT RETURN CAST(date_format(d, 'yyyyMMdd') AS INT)")
