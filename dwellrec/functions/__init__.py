from dwellrec.functions.exprs import (  # noqa: F401
    binarise,
    clamp01,
    mix,
    score_cascade,
    surrogate_pred,
)
