from dimsmith.functions.scalars import (  # noqa: F401
    OPEN_END,
    date_key,
    day_in_week,
    discount_bucket,
    is_weekend,
    md5_draw,
    money,
    null_safe_changed,
    register_sql_functions,
    spare_quantity,
)
