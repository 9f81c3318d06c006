from stargrain.functions.exprs import (  # noqa: F401
    guarded_ratio,
    match_result,
    not_blank,
    person_name,
    points,
    ratio,
    verdict,
    winner,
)
from stargrain.functions.keys import match_key, normalised, raw_key, surrogate_key  # noqa: F401
