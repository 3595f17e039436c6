from salesmart.functions.columns import (  # noqa: F401
    INCENTIVE_RATE,
    fold_json,
    fold_values,
    fold_variant,
    full_name,
    incentive,
    money,
    month_of,
    quoted,
    variant_long,
)
