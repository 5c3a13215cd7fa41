"""Column expressions shared by the operators.

Everything here is a built-in Spark expression (JVM side, whole-stage codegen);
no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the studied job's for equal results):
#   decision threshold on a prediction ........ 0.0001
#   number of score bins ...................... 5
#   top-N list length ......................... 10
#   holdout test fraction ..................... 0.1
#   metric report lines, in order:
#     "accuracy    = ", "precision   = ", "recall      = ", "fallout     = ",
#     "sensitivity = ", "specificity = ", "f           = "
#   metric number format ...................... "%02.4f" (4 decimals)
#   metric report block ....................... "\n", then each label, value
#                                               and "\n", in the order above
#   one-line metric form ...................... " " + accuracy, precision,
#                                               "  " + recall, fallout,
#                                               sensitivity, specificity, f,
#                                               joined by the delimiter
#   recommendation line ....................... visitor, "\u0001", then
#                                               "(item,score)" joined by ";"
# ---------------------------------------------------------------------------
DECISION_THRESHOLD = 0.0001
SCORE_BINS = 5
TOP_N = 10
TEST_FRACTION = 0.1
REPORT_LABELS = (
    ("accuracy", "accuracy    = "),
    ("precision", "precision   = "),
    ("recall", "recall      = "),
    ("fallout", "fallout     = "),
    ("sensitivity", "sensitivity = "),
    ("specificity", "specificity = "),
    ("f", "f           = "),
)
LINE_SEPARATOR = "\u0001"

# Portable integer mix: identical in Spark and DuckDB. All products stay below
# 2**62. x -> x^3 is one-to-one modulo this prime (3 does not divide P - 1).
MIX_PRIME = 2147483579
_P = MIX_PRIME


def _cube(x: Column) -> Column:
    return (x * x % F.lit(_P)) * x % F.lit(_P)


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once. A Column that an expression names
    several times is computed as often: nested cubes grow until the generated
    code of a filter is too long for the JVM to compile."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def mix_start(a: Column, seed: int) -> Column:
    """Start of the sequence of ``a``."""
    a = F.pmod(a.cast("bigint"), F.lit(_P))
    return _cube((a * F.lit(7919) + F.lit(int(seed))) % F.lit(_P))


def mix_step(start: Column) -> Column:
    """Step of the sequence that starts at ``start``."""
    return _cube((start + F.lit(104729)) % F.lit(_P)) + F.lit(1)


def mix_at(start: Column, step: Column, b: Column) -> Column:
    """Member ``b`` of a sequence."""
    return _cube((start + F.pmod(b.cast("bigint"), F.lit(_P)) * step) % F.lit(_P))


def mix(a: Column, b: Column, seed: int) -> Column:
    """Seeded pseudo-random BIGINT in [0, MIX_PRIME) from two ints.

    ``a`` is mixed first and gives both the start and the step of its sequence
    over ``b``, so the sequences of two ``a`` are not shifted copies. Where one
    ``a`` has many ``b``, compute start and step once and use ``mix_at``."""
    start = mix_start(a, seed)
    b = F.pmod(b.cast("bigint"), F.lit(_P))
    return _once(start, lambda s: _once((s + b * mix_step(s)) % F.lit(_P), _cube))


def mix_sql(a: str, b: str, seed: int) -> str:
    """The same mix as SQL text (for the DuckDB oracle)."""
    def cube(x):
        return f"((({x}) * ({x}) % {_P}) * ({x}) % {_P})"
    a = f"((CAST({a} AS BIGINT) % {_P} + {_P}) % {_P})"
    b = f"((CAST({b} AS BIGINT) % {_P} + {_P}) % {_P})"
    start = cube(f"({a} * 7919 + {int(seed)}) % {_P}")
    step = f"({cube(f'({start} + 104729) % {_P}')} + 1)"
    return cube(f"({start} + {b} * {step}) % {_P}")


def score_cascade(value: Column, cuts: Sequence[float]) -> Column:
    """Bin index by ascending cut points: v<=c1 -> 0, v<=c2 -> 1, ..., else len(cuts).

    Returned as DOUBLE (the score feeds ALS as a rating).
    """
    expr = F.lit(len(cuts))
    for i in reversed(range(len(cuts))):
        expr = F.when(value <= F.lit(float(cuts[i])), F.lit(i)).otherwise(expr)
    return expr.cast("double")


def binarise(c: Column) -> Column:
    """Implicit-mode mapping: r > 0 -> 1.0 else 0.0."""
    return F.when(c > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def clamp01(c: Column) -> Column:
    return F.greatest(F.least(c, F.lit(1.0)), F.lit(0.0))


def surrogate_pred(user: Column, item: Column) -> Column:
    """Deterministic stand-in prediction in [-0.3, 0.7) used to check the
    evaluation operators without model floats."""
    h = (user.cast("bigint") * F.lit(31) + item.cast("bigint") * F.lit(17)) % F.lit(1000)
    return (h - F.lit(300)).cast("double") / F.lit(1000)


def surrogate_pred_sql(user: str, item: str) -> str:
    return (f"CAST((CAST({user} AS BIGINT) * 31 + CAST({item} AS BIGINT) * 17) % 1000 - 300"
            f" AS DOUBLE) / 1000")


def fmt4(c: Column) -> Column:
    """'%02.4f' of a double; NULL (an undefined ratio) prints as NaN."""
    return F.when(c.isNull() | F.isnan(c), F.lit("NaN")).otherwise(
        F.format_string("%02.4f", c))
