"""DuckDB oracle SQL for the registered queries (tables are pre-registered
views). Independent definitions: plain joins, window row numbers and the
literal k² bag join, pairwise AUC, sequential negative draws enumerated over
all catalogue positions."""

from __future__ import annotations

from dwellrec.functions.exprs import (
    DECISION_THRESHOLD,
    REPORT_LABELS,
    SCORE_BINS,
    TEST_FRACTION,
    TOP_N,
    mix_sql,
    surrogate_pred_sql,
)
from dwellrec.operators.negatives import NEG_SEED
from dwellrec.operators.split import SPLIT_SEED, split_label_sql
from dwellrec.plans.crossval import FOLD_SEED, FOLDS
from dwellrec.plans.catalog import CV_FOLDS, HOT_VISITOR, NORM_STEPS, PRICE, QUANTITY, SHIFT


def _base(rating_col: str = PRICE, skewed: bool = False) -> str:
    b = SCORE_BINS
    visitor = "CAST(c.c_name AS VARCHAR)"
    if skewed:
        visitor = f"CASE WHEN c.c_custkey % 3 = 0 THEN '{HOT_VISITOR}' ELSE {visitor} END"
    return f"""
raw AS (
  SELECT {visitor} AS visitor_trace, CAST(l.l_partkey AS INTEGER) AS poi,
         CAST(l.{rating_col} AS DOUBLE) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey),
interactions AS (
  SELECT * FROM raw
  WHERE visitor_trace IS NOT NULL AND poi IS NOT NULL AND rating IS NOT NULL AND NOT isnan(rating)),
keys AS (SELECT visitor_trace, COUNT(*) AS n_rows FROM interactions GROUP BY visitor_trace),
user_index AS (
  SELECT visitor_trace, CAST(row_number() OVER (ORDER BY visitor_trace) - 1 AS INTEGER) AS "user", n_rows
  FROM keys),
ratings AS (
  SELECT u."user" AS "user", i.poi AS item, i.rating AS rating
  FROM interactions i JOIN user_index u ON i.visitor_trace = u.visitor_trace),
nrat AS (SELECT COUNT(*) AS n FROM ratings),
ordered AS (SELECT rating, row_number() OVER (ORDER BY rating) AS rn FROM ratings),
cuts AS (
  SELECT CAST(t.k AS INTEGER) AS k, CAST(t.k * (nrat.n // {b}) AS BIGINT) AS rank, o.rating AS cut
  FROM range(1, {b}) t(k) CROSS JOIN nrat JOIN ordered o ON o.rn = t.k * (nrat.n // {b})),
cutrow AS (
  SELECT max(CASE WHEN k = 1 THEN cut END) AS c1, max(CASE WHEN k = 2 THEN cut END) AS c2,
         max(CASE WHEN k = 3 THEN cut END) AS c3, max(CASE WHEN k = 4 THEN cut END) AS c4
  FROM cuts),
scored AS (
  SELECT r."user", r.item,
         CAST(CASE WHEN r.rating <= c.c1 THEN 0 WHEN r.rating <= c.c2 THEN 1
                   WHEN r.rating <= c.c3 THEN 2 WHEN r.rating <= c.c4 THEN 3 ELSE 4 END AS DOUBLE) AS score
  FROM ratings r CROSS JOIN cutrow c)"""


def _labelled(test_fraction: float = TEST_FRACTION) -> str:
    return f""",
labelled AS (
  SELECT s."user", s.item, s.score, {split_label_sql('s."user"', 's.item', test_fraction, SPLIT_SEED)} AS split
  FROM scored s)"""


_PRED = surrogate_pred_sql('"user"', "item")

_BAG = f""",
bag AS (
  SELECT f.split, f."user", f.item, f.score AS fact,
         {surrogate_pred_sql('p."user"', 'p.item')} AS pred
  FROM labelled f JOIN labelled p
    ON f.split = p.split AND f."user" = p."user" AND f.item = p.item)"""

_ROWS = f""",
bag AS (
  SELECT split, "user", item, score AS fact, {_PRED} AS pred FROM labelled)"""

_CONF = f""",
conf AS (
  SELECT split,
    CAST(count_if(NOT isnan(fact) AND NOT isnan(pred) AND fact > 0 AND pred >= CAST({DECISION_THRESHOLD} AS DOUBLE)) AS BIGINT) AS tp,
    CAST(count_if(NOT isnan(fact) AND NOT isnan(pred) AND fact <= 0 AND pred >= CAST({DECISION_THRESHOLD} AS DOUBLE)) AS BIGINT) AS fp,
    CAST(count_if(NOT isnan(fact) AND NOT isnan(pred) AND fact > 0 AND pred < CAST({DECISION_THRESHOLD} AS DOUBLE)) AS BIGINT) AS fn,
    CAST(count_if(NOT isnan(fact) AND NOT isnan(pred) AND fact <= 0 AND pred < CAST({DECISION_THRESHOLD} AS DOUBLE)) AS BIGINT) AS tn
  FROM bag GROUP BY split),
m0 AS (
  SELECT *, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision,
            CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall FROM conf),
metrics AS (
  SELECT split, tp, fp, fn, tn,
    CAST(tp + tn AS DOUBLE) / nullif(tp + fn + fp + tn, 0) AS accuracy,
    precision, recall,
    CAST(fp AS DOUBLE) / nullif(fp + tn, 0) AS fallout,
    CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS sensitivity,
    CAST(tn AS DOUBLE) / nullif(fp + tn, 0) AS specificity,
    2 * ((precision * recall) / nullif(precision + recall, 0)) AS f
  FROM m0)"""

_NEG = f""",
catalogue AS (
  SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS BIGINT) AS item_ix
  FROM (SELECT DISTINCT item FROM scored)),
ncat AS (SELECT COUNT(*) AS n FROM catalogue),
pos AS (SELECT DISTINCT split, "user", item FROM labelled),
kk AS (SELECT split, "user", COUNT(*) AS k FROM pos GROUP BY split, "user"),
draws AS (SELECT kk.split, kk."user", kk.k, unnest(range(1, ncat.n + 1)) AS draw FROM kk CROSS JOIN ncat),
drawn AS (
  SELECT d.split, d."user", d.k, d.draw, ({mix_sql('d."user"', 'd.draw', NEG_SEED)}) % ncat.n AS item_ix
  FROM draws d CROSS JOIN ncat),
acc AS (
  SELECT d.split, d."user", d.k, d.draw, c.item
  FROM drawn d JOIN catalogue c ON c.item_ix = d.item_ix
  WHERE NOT EXISTS (SELECT 1 FROM pos p WHERE p.split = d.split AND p."user" = d."user" AND p.item = c.item)),
negs AS (
  SELECT split, "user", item, CAST(draw AS INTEGER) AS draw
  FROM (SELECT *, row_number() OVER (PARTITION BY split, "user" ORDER BY draw) AS rn FROM acc)
  WHERE rn <= k)"""

_AUC = f""",
pos_s AS (SELECT split, "user", {_PRED} AS pred FROM labelled),
neg_s AS (SELECT split, "user", {_PRED} AS pred FROM negs),
pc AS (SELECT split, "user", COUNT(*) AS npos FROM pos_s GROUP BY split, "user"),
nc AS (SELECT split, "user", COUNT(*) AS nneg FROM neg_s GROUP BY split, "user"),
corr AS (
  SELECT p.split, p."user", count_if(p.pred > n.pred) AS correct
  FROM pos_s p JOIN neg_s n ON p.split = n.split AND p."user" = n."user"
  GROUP BY p.split, p."user"),
user_auc AS (
  SELECT pc.split, pc."user", CAST(corr.correct AS DOUBLE) / CAST(pc.npos * nc.nneg AS DOUBLE) AS auc,
         pc.npos, nc.nneg
  FROM pc JOIN nc ON pc.split = nc.split AND pc."user" = nc."user"
  JOIN corr ON corr.split = pc.split AND corr."user" = pc."user")"""

_TOPN = f""",
factors AS (
  SELECT CAST(vec_id AS INTEGER) AS id,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 100) AS BIGINT)) AS q
  FROM embeddings),
nvec AS (SELECT count(*) AS n FROM embeddings),
pairs AS (SELECT DISTINCT "user", item FROM scored),
pscore AS (
  SELECT p."user", p.item,
         CAST(list_sum(list_transform(range(1, len(u.q) + 1), lambda i: u.q[i] * v.q[i])) AS BIGINT) AS score
  FROM pairs p CROSS JOIN nvec JOIN factors u ON u.id = p."user" % nvec.n
  JOIN factors v ON v.id = p.item % nvec.n),
topn AS (
  SELECT "user", CAST(rank AS INTEGER) AS rank, item, score
  FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item ASC) AS rank FROM pscore)
  WHERE rank <= {TOP_N})"""

# every user x every item; vectors are fewer than ids, so their products are made once
_TOPN_ALL = f""",
nvec AS (SELECT count(*) AS n FROM embeddings),
parts AS (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(list_transform(embedding,
         lambda x: CAST(floor(CAST(x AS DOUBLE) * 100) AS BIGINT))) AS x FROM embeddings),
products AS MATERIALIZED (
  SELECT u.vec_id AS a, v.vec_id AS b, CAST(sum(u.x * v.x) AS BIGINT) AS p
  FROM parts u JOIN parts v ON u.i = v.i GROUP BY u.vec_id, v.vec_id),
everything AS (
  SELECT u."user", i.item, p.p * (1 + i.item % {NORM_STEPS}) AS score
  FROM user_index u CROSS JOIN (SELECT DISTINCT item FROM scored) i CROSS JOIN nvec
  JOIN products p ON p.a = u."user" % nvec.n AND p.b = i.item % nvec.n)
SELECT "user", CAST(rank AS INTEGER) AS rank, item, score
FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM everything)
WHERE rank <= {TOP_N}"""


# pairs whose user and item occur in train, and what an evaluation counts of them
_KNOWN = """,
ku AS (SELECT DISTINCT "user" FROM labelled WHERE split = 'train'),
ki AS (SELECT DISTINCT item FROM labelled WHERE split = 'train'),
known AS (SELECT * FROM labelled WHERE "user" IN (FROM ku) AND item IN (FROM ki)),
held AS (SELECT split, "user", item, count(*) AS k, count_if(score > 0) AS p, count_if(score <= 0) AS z
         FROM known GROUP BY ALL),
weights AS (SELECT split, CAST(sum(k * p) AS BIGINT) AS positive, CAST(sum(k * z) AS BIGINT) AS other
            FROM held GROUP BY split)"""

_EVAL = _KNOWN + """,
kn AS (SELECT * FROM negs WHERE "user" IN (FROM ku) AND item IN (FROM ki)),
both_sides AS (SELECT split, count(DISTINCT "user") AS users FROM held SEMI JOIN kn USING (split, "user")
               GROUP BY split),
sizes AS (SELECT split, count(*) AS rows FROM labelled GROUP BY split),
nsizes AS (SELECT split, count(*) AS negatives FROM negs GROUP BY split)"""


def _evaluation_sql(grid) -> str:
    """grid: (rank, alpha) pairs."""
    points = ", ".join(f"({r}, CAST({a} AS DOUBLE))" for r, a in grid)
    return ("WITH" + _base() + _labelled() + _NEG + _EVAL + f"""
SELECT CAST(g.rank AS INTEGER) AS rank, g.alpha, true AS implicit_prefs, CAST(42 AS INTEGER) AS seed, split,
       rows, negatives, positive, other, users, true AS auc_valid
FROM sizes JOIN nsizes USING (split) JOIN weights USING (split) JOIN both_sides USING (split)
CROSS JOIN (VALUES {points}) g(rank, alpha)""")


def _folds(folds: int) -> str:
    return f""",
ranked AS (
  SELECT "user", item, row_number() OVER (PARTITION BY "user" ORDER BY {mix_sql('"user"', 'item', FOLD_SEED)}, item) - 1
         + {mix_sql('"user"', str(folds), FOLD_SEED)} AS at
  FROM (SELECT DISTINCT "user", item FROM scored)),
folded AS (SELECT s.*, CAST(r.at % {folds} AS INTEGER) AS fold FROM scored s JOIN ranked r USING ("user", item))"""


def _cross_validated_sql() -> str:
    """Sizes of a cross-validation: negatives of a fold exclude all known items."""
    negatives = _NEG.replace("p.split = d.split AND ", "")
    return ("WITH" + _base() + _folds(CV_FOLDS) + """,
labelled AS (SELECT "user", item, score, CAST(fold AS VARCHAR) AS split FROM folded)""" + negatives + f"""
SELECT CAST(g.rank AS INTEGER) AS rank, CAST(5 AS INTEGER) AS max_iter, CAST({CV_FOLDS} AS INTEGER) AS folds,
       (SELECT count(*) FROM scored) AS rows, (SELECT count(*) FROM negs) AS negatives,
       true AS valid, true AS one_chosen
FROM (VALUES (5), (8)) g(rank)""")


def _grid_sql(users: str) -> str:
    return f"""
SELECT "user", CAST(r AS INTEGER) AS rank, true AS in_order, true AS agrees
FROM ({users}) CROSS JOIN (SELECT count(DISTINCT item) AS m FROM scored) CROSS JOIN range(1, {TOP_N} + 1) t(r)
WHERE r <= m"""


def _fmt(c: str) -> str:
    return f"coalesce(printf('%02.4f', {c}), 'NaN')"


def _report_sql() -> str:
    parts = ["chr(10)"]
    for name, label in REPORT_LABELS:
        parts += [f"'{label}'", _fmt(name), "chr(10)"]
    return " || ".join(parts)


def _list_line_sql(delim: str = ",") -> str:
    v = [_fmt(name) for name, _ in REPORT_LABELS]
    d = f"'{delim}'"
    return (f"' ' || {v[0]} || {d} || {v[1]} || {d} || '  ' || {v[2]} || {d} || {v[3]}"
            f" || {d} || {v[4]} || {d} || {v[5]} || {d} || {v[6]}")


def _rmse_sql(mapping: str) -> str:
    one, zero = "CAST(1 AS DOUBLE)", "CAST(0 AS DOUBLE)"
    if mapping == "binary":
        a = f"CASE WHEN fact > 0 THEN {one} ELSE {zero} END"
        b = f"CASE WHEN pred > 0 THEN {one} ELSE {zero} END"
    elif mapping == "clamp":
        a = f"greatest(least(fact, {one}), {zero})"
        b = f"greatest(least(pred, {one}), {zero})"
    else:
        a, b = "fact", "pred"
    return ("WITH" + _base() + _labelled() + _BAG +
            f"\nSELECT split, round(sqrt(avg(({a} - {b}) * ({a} - {b}))), 9) AS rmse,"
            f" COUNT(*) AS n FROM bag GROUP BY split")


def oracle_sql() -> dict[str, str]:
    W = "WITH"
    base, lab, hot = _base(), _labelled(), _base(skewed=True)
    lines_select = """
SELECT t."user", u.visitor_trace,
       u.visitor_trace || chr(1) || string_agg('(' || CAST(t.item AS VARCHAR) || ',' || CAST(t.score AS VARCHAR) || ')', ';' ORDER BY {order}) AS value
FROM topn t JOIN user_index u ON t."user" = u."user"
GROUP BY t."user", u.visitor_trace"""
    return {
        "scan_interactions": W + base + "\nSELECT visitor_trace, poi, rating FROM interactions",
        "ingest_counts": W + base + """
SELECT COUNT(*) AS rows,
       CAST(count_if(visitor_trace IS NULL) AS BIGINT) AS null_visitor,
       CAST(count_if(poi IS NULL) AS BIGINT) AS null_item,
       CAST(count_if(rating IS NULL OR isnan(rating)) AS BIGINT) AS null_rating,
       CAST(count_if(visitor_trace IS NULL OR poi IS NULL OR rating IS NULL OR isnan(rating)) AS BIGINT) AS dropped
FROM raw""",
        "user_index": W + base + '\nSELECT visitor_trace, "user", n_rows FROM user_index',
        "item_catalogue": W + base + _NEG + "\nSELECT item, item_ix FROM catalogue",
        "indexed_ratings": W + base + '\nSELECT "user", item, rating FROM ratings',
        "quintile_cuts": W + base + "\nSELECT k, rank, cut FROM cuts",
        "quintile_scores": W + base + '\nSELECT "user", item, score FROM scored',
        "quintile_scores_ties": W + _base(QUANTITY) + '\nSELECT "user", item, score FROM scored',
        "dataset_stats": W + base + """
SELECT COUNT(*) AS ratings, COUNT(DISTINCT "user") AS users, COUNT(DISTINCT item) AS items FROM scored""",
        "holdout_split": W + base + lab + '\nSELECT "user", item, score, split FROM labelled',
        "holdout_split_80_20": W + base + _labelled(0.2)
        + '\nSELECT "user", item, score, split FROM labelled',
        "shifted_ratings": W + base
        + f'\nSELECT "user", item, rating - CAST({SHIFT} AS DOUBLE) AS rating FROM ratings',
        "binarised_test_labels": W + base + lab + """
SELECT "user", item, CASE WHEN score > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label
FROM labelled WHERE split = 'test'""",
        "pair_predictions": W + base + _TOPN + '\nSELECT "user", item, score FROM pscore',
        "fact_pred_join": W + base + lab + _BAG + """
SELECT split, "user", item, fact, pred, COUNT(*) AS weight FROM bag
GROUP BY split, "user", item, fact, pred""",
        "fact_pred_join_rowmode": W + base + lab + _ROWS + """
SELECT split, "user", item, fact, pred, COUNT(*) AS weight FROM bag
GROUP BY split, "user", item, fact, pred""",
        "confusion_counts": W + base + lab + _BAG + _CONF + "\nSELECT split, tp, fp, fn, tn FROM conf",
        "confusion_metrics": W + base + lab + _BAG + _CONF + "\nSELECT * FROM metrics",
        "metrics_text": W + base + lab + _BAG + _CONF
        + f"\nSELECT split, {_report_sql()} AS report, {_list_line_sql(',')} AS list_line FROM metrics",
        "rmse_binarised": _rmse_sql("binary"),
        "rmse_clamped": _rmse_sql("clamp"),
        "rmse_raw": _rmse_sql("raw"),
        "negative_samples": W + base + lab + _NEG + '\nSELECT split, "user", item, draw FROM negs',
        "user_auc": W + base + lab + _NEG + _AUC
        + '\nSELECT split, "user", auc, npos, nneg FROM user_auc',
        "mean_auc": W + base + lab + _NEG + _AUC + """
SELECT split, round(avg(auc), 9) AS mean_auc, COUNT(*) AS users FROM user_auc GROUP BY split""",
        "skewed_user_index": W + hot + '\nSELECT visitor_trace, "user", n_rows FROM user_index',
        "skewed_indexed_ratings": W + hot + '\nSELECT "user", item, rating FROM ratings',
        "skewed_negative_samples": W + hot + lab + _NEG + '\nSELECT split, "user", item, draw FROM negs',
        "skewed_user_auc": W + hot + lab + _NEG + _AUC
        + '\nSELECT split, "user", auc, npos, nneg FROM user_auc',
        "table_scan": W + base + "\nSELECT visitor_trace, poi, rating FROM raw",
        "tsv_ratings": W + base + '\nSELECT "user", item, rating FROM ratings',
        "text_sink_lines": W + base + _TOPN + "\nSELECT value FROM ("
        + lines_select.format(order="t.rank") + ")",
        "peek": W + base + '\nSELECT visitor_trace, "user" FROM user_index WHERE "user" < 3',
        "holdout_random_split": W + base + """
SELECT "user", item, score, count(*) AS copies, true AS sizes_fit, true AS same_sides
FROM scored GROUP BY ALL""",
        "dataset_stats_approx": W + base + """
SELECT COUNT(*) AS ratings, COUNT(DISTINCT "user") AS users, COUNT(DISTINCT item) AS items,
       true AS users_close, true AS items_close FROM scored""",
        "dataset_stats_incremental": W + base + lab + """,
sides AS (SELECT "user", count(DISTINCT split) AS s FROM labelled GROUP BY "user")
SELECT split, count(*) AS ratings, count(DISTINCT "user") AS users, count(DISTINCT item) AS items,
       true AS users_close, true AS items_close,
       (SELECT count(*) FROM sides WHERE s = 2) AS common_users, true AS common_close
FROM labelled GROUP BY split""",
        "als_recommendation_lines": W + base + f"""
SELECT "user", visitor_trace, visitor_trace AS line_visitor,
       CAST(least({TOP_N}, (SELECT COUNT(DISTINCT item) FROM scored)) AS INTEGER) AS entries
FROM user_index""",
        "als_pair_predictions": W + base + lab + _KNOWN + """
SELECT "user", item, true AS finite, true AS agrees FROM held WHERE split = 'test'""",
        "als_topn": W + base + _grid_sql('SELECT DISTINCT "user" FROM scored'),
        "als_topn_subset": W + base + lab
        + _grid_sql("SELECT DISTINCT \"user\" FROM labelled WHERE split = 'test'"),
        "als_explicit": W + base + lab + _KNOWN + """
SELECT split, positive + other AS n, true AS learned FROM weights WHERE split = 'test'""",
        "als_evaluate": _evaluation_sql([(10, 1.0)]),
        "als_sweep": _evaluation_sql([(5, 1.0), (10, 2.0)]),
        "als_save_reload_topn": W + base + f"""
SELECT visitor_trace, "user", true AS same_user, true AS same_items,
       CAST(least({TOP_N}, (SELECT COUNT(DISTINCT item) FROM scored)) AS INTEGER) AS entries
FROM user_index""",
        "topn_rated_items": W + base + _TOPN + '\nSELECT "user", rank, item, score FROM topn',
        "topn_all_users": W + base + _TOPN_ALL,
        "cv_folds": W + base + _folds(FOLDS) + '\nSELECT "user", item, score, fold FROM folded',
        "als_cross_validated": _cross_validated_sql(),
        "user_index_extended": W + base + """,
parts AS (SELECT *, CAST(regexp_extract(visitor_trace, '([0-9]+)$', 1) AS BIGINT) % 3 <> 0 AND poi % 2 = 0 AS early
          FROM interactions),
ends AS (SELECT visitor_trace, bool_or(early) AS old, count(*) AS n_rows FROM parts GROUP BY visitor_trace)
SELECT visitor_trace, n_rows,
       CAST(row_number() OVER (ORDER BY old DESC, visitor_trace) - 1 AS INTEGER) AS "user" FROM ends""",
        "input_fingerprint": W + base + """,
h AS (SELECT md5(concat_ws('|', visitor_trace, CAST(poi AS VARCHAR),
             CAST(CAST(rating AS DECIMAL(28,9)) AS VARCHAR))) AS d FROM raw)
SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(d, 1, 15) AS BIGINT)) AS VARCHAR) AS sum1,
       CAST(sum(CAST('0x' || substr(d, 17, 15) AS BIGINT)) AS VARCHAR) AS sum2 FROM h""",
        "recommendation_lines": W + base + _TOPN + lines_select.format(order="t.rank"),
        "topn_lists_ascending": W + base + _TOPN + lines_select.format(order="t.score ASC, t.item ASC"),
    }
