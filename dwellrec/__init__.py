"""dwellrec: implicit-feedback recommendation on Spark DataFrames.

Visitor/item interactions with a strength (dwell time, price, ...) are given
dense integer visitor ids, turned into quintile scores by exact rank
selection, fitted with Spark ML's alternating least squares, evaluated with
confusion-matrix metrics, RMSE and per-user AUC, and served as top-N lists.

Layout:
  sources/    table adapters, sinks, model store
  functions/  column expressions (integer mix, score cascade, formatting)
  operators/  distributed building blocks (ranking, index, split, metrics, ...)
  plans/      end-to-end jobs (evaluate, sweep, train, recommend) and the
              registered query catalogue
  streaming/  intentionally empty: the studied workload has no stream
"""

from dwellrec.session import build_session, checkpoint_root  # noqa: F401

__all__ = ["build_session", "checkpoint_root"]
