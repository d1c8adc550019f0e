"""SQL for the registered queries, written step by step and independent of the Spark plans."""

from __future__ import annotations

from registry.panels import SQL as PANEL

INACTIVITY, MIN_RECORDS = 3, 8
SPLIT = "1999-06-30"


def _with(ctes: dict[str, str], query: str) -> str:
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {parts}\n{query}"


def _calendar(step: str = "1 MONTH", lo: str = "lo", hi: str = "hi") -> str:
    return (
        f"SELECT CAST(unnest(generate_series(CAST({lo} AS TIMESTAMP), CAST({hi} AS TIMESTAMP), "
        f"INTERVAL {step})) AS DATE) AS ds FROM b"
    )


_BOUNDS = "SELECT min(ds) AS lo, max(ds) AS hi FROM p"


def filled(panel: str, calendar: str | None = None, month_end: bool = False) -> dict[str, str]:
    source = PANEL[panel]
    if month_end:
        source = f"SELECT unique_id, last_day(ds) AS ds, y FROM ({source})"
        calendar = (
            "SELECT last_day(CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), "
            "CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)) AS ds FROM b"
        )
    return {
        "p": source,
        "b": _BOUNDS,
        "cal": calendar or _calendar(),
        "ids": "SELECT DISTINCT unique_id FROM p",
        "filled": (
            "SELECT i.unique_id, c.ds, p.y FROM ids i CROSS JOIN cal c "
            "LEFT JOIN p ON p.unique_id = i.unique_id AND p.ds = c.ds"
        ),
    }


def _month_anchors(*dates: str) -> str:
    """Calendar of dates that follow from a month's first day ``m``, inside the bounds."""
    months = (
        "SELECT CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), "
        "CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m FROM b"
    )
    every = " UNION ALL ".join(f"SELECT CAST({d} AS DATE) AS ds FROM ({months})" for d in dates)
    return f"SELECT ds FROM ({every}) WHERE ds BETWEEN (SELECT lo FROM b) AND (SELECT hi FROM b)"


def _trim(source: str, condition: str) -> str:
    return (
        f"SELECT unique_id, ds, y FROM (SELECT *, min(CASE WHEN {condition} THEN ds END) "
        f"OVER (PARTITION BY unique_id) AS start FROM {source}) WHERE start IS NULL OR ds >= start"
    )


def _not_in(source: str, ids: str) -> str:
    return f"SELECT s.* FROM {source} s WHERE s.unique_id NOT IN (SELECT unique_id FROM ({ids}))"


def _zero_only(source: str) -> str:
    return _not_in(source, f"SELECT unique_id FROM {source} GROUP BY 1 HAVING max(y) = 0")


def _inactive(source: str, n: int = INACTIVITY) -> str:
    runs = (
        "SELECT *, sum(CASE WHEN y = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY unique_id ORDER BY ds) "
        f"AS run FROM {source}"
    )
    streaks = (
        "SELECT *, count(*) FILTER (y = 0) OVER (PARTITION BY unique_id, run) AS streak, "
        f"row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS back FROM ({runs})"
    )
    return _not_in(
        source,
        f"SELECT unique_id FROM ({streaks}) WHERE back = 1 AND y = 0 AND streak >= {n}",
    )


def _short(source: str, n: int = MIN_RECORDS) -> str:
    return _not_in(source, f"SELECT unique_id FROM {source} GROUP BY 1 HAVING count(*) < {n}")


def cleaned(panel: str) -> dict[str, str]:
    return {
        **filled(panel),
        "c2": _trim("filled", "y IS NOT NULL"),
        "c3": _trim("c2", "y <> 0"),
        "c4": _zero_only("c3"),
        "c5": _inactive("c4"),
        "cleaned": _short("c5"),
    }


_LABEL = (
    "CASE WHEN adi < 1.32 AND cv2 < 0.49 THEN 'Smooth' "
    "WHEN adi >= 1.32 AND cv2 < 0.49 THEN 'Intermittent' "
    "WHEN adi < 1.32 AND cv2 >= 0.49 THEN 'Erratic' ELSE 'Lumpy' END"
)


def labelled(panel: str) -> dict[str, str]:
    stats = (
        "SELECT unique_id, count(*) AS n, count(*) FILTER (y > 0) AS k, "
        "avg(y) FILTER (y > 0) AS m, stddev_pop(y) FILTER (y > 0) AS s FROM cleaned GROUP BY 1"
    )
    ratios = (
        "SELECT unique_id, CASE WHEN k > 0 THEN n / k ELSE CAST('inf' AS DOUBLE) END AS adi, "
        "CASE WHEN m > 0 THEN pow(s / m, 2) ELSE CAST('inf' AS DOUBLE) END AS cv2 "
        "FROM stats"
    )
    return {
        **cleaned(panel),
        "stats": stats,
        "ratios": ratios,
        "metrics": f"SELECT unique_id, {_LABEL} AS classification, adi, cv2 FROM ratios",
        "labelled": (
            "SELECT c.unique_id, c.ds, c.y, m.classification FROM cleaned c "
            "LEFT JOIN metrics m USING (unique_id)"
        ),
    }


_ORDER = "PARTITION BY unique_id ORDER BY ds"
_LAST = f"last_value(y IGNORE NULLS) OVER ({_ORDER} ROWS UNBOUNDED PRECEDING)"


def _mean(k: int) -> str:
    return f"avg(y) OVER ({_ORDER} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def _median(k: int) -> str:
    return f"quantile_disc(y, 0.5) OVER ({_ORDER} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def _filled_by(rolling: str) -> str:
    return f"coalesce(y, {rolling}, {_LAST}, 0.0)"


def prepared(panel: str) -> dict[str, str]:
    return {
        **labelled(panel),
        "prepared": (
            "SELECT unique_id, ds, CASE classification "
            f"WHEN 'Smooth' THEN {_filled_by(_mean(3))} "
            f"WHEN 'Erratic' THEN {_filled_by(_median(4))} "
            f"WHEN 'Lumpy' THEN {_filled_by(_median(12))} "
            "ELSE coalesce(y, 0.0) END AS y, classification FROM labelled"
        ),
    }


def _r(expression: str, name: str) -> str:
    """Rounded double without negative zero."""
    return f"round({expression}, 6) + 0.0 AS {name}"


_Y = _r("y", "y")


def _lag_matrix(label: str, transforms: list[str], features: dict[str, str]) -> str:
    """Target transforms step by step, then the features; rows with a null are left out."""
    ctes = prepared("nation_segment")
    ctes["t0"] = (
        f"SELECT unique_id, ds, y, y AS z FROM prepared WHERE classification = '{label}'"
    )
    for i, transform in enumerate(transforms):
        ctes[f"t{i + 1}"] = f"SELECT unique_id, ds, y, {transform} AS z FROM t{i}"
    wide = ", ".join(f"{sql} AS {name}" for name, sql in features.items())
    ctes["wide"] = f"SELECT unique_id, ds, y, z, {wide} FROM t{len(transforms)}"
    ctes["matrix"] = (
        f"SELECT * FROM wide WHERE z IS NOT NULL AND {' AND '.join(f'{n} IS NOT NULL' for n in features)}"
    )
    shown = ", ".join(_r(c, c) for c in ["y", "z", *features])
    return _with(ctes, f"SELECT unique_id, ds, {shown} FROM matrix")


_DIFF = f"z - lag(z) OVER ({_ORDER})"
_SCALE = (
    "(z - avg(z) OVER (PARTITION BY unique_id)) / CASE WHEN stddev_pop(z) OVER "
    "(PARTITION BY unique_id) > 0 THEN stddev_pop(z) OVER (PARTITION BY unique_id) ELSE 1.0 END"
)


def _lag(k: int) -> str:
    return f"lag(z, {k}) OVER ({_ORDER})"


def _rolling(lag: int, size: int, needed: int) -> str:
    frame = f"OVER ({_ORDER} ROWS BETWEEN {lag + size - 1} PRECEDING AND {lag} PRECEDING)"
    return f"CASE WHEN count(z) {frame} >= {needed} THEN avg(z) {frame} END"


def _expanding(lag: int) -> str:
    return f"stddev_samp(z) OVER ({_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND {lag} PRECEDING)"


def _ewm(lag: int, alpha: float) -> str:
    frame = f"({_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND {lag} PRECEDING)"
    values = f"(list(z) FILTER (z IS NOT NULL) OVER {frame})"
    return f"list_reduce({values}, lambda m, v: (1 - {alpha}) * m + {alpha} * v)"


def _fold_sql(panel: str, windows: int, periods: int) -> str:
    ctes = {
        "p": PANEL[panel],
        "placed": f"SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS r FROM p",
        "folds": f"SELECT unnest(generate_series(0, {windows - 1})) AS fold",
        "parts": (
            f"SELECT unique_id, ds, y, CAST(fold AS INTEGER) AS fold, CASE "
            f"WHEN r > ({windows} - fold) * {periods} THEN 'train' "
            f"WHEN r > ({windows} - 1 - fold) * {periods} THEN 'test' END AS part "
            "FROM placed CROSS JOIN folds"
        ),
        "cut": (
            "SELECT unique_id, fold, max(ds) AS cutoff FROM parts WHERE part = 'train' GROUP BY 1, 2"
        ),
    }
    return _with(
        ctes,
        f"SELECT unique_id, ds, {_Y}, fold, part, cutoff FROM parts JOIN cut USING (unique_id, fold) "
        "WHERE part IS NOT NULL",
    )


def _linear(
    history: dict[str, str], steps: int, known: str = "0.0", hi: str = "CAST(NULL AS DATE)"
) -> dict[str, str]:
    """Least squares on the last transformed value by fold and label, and its recursion.

    ``history`` ends in a table ``hist`` of ``fold, unique_id, ds, y, classification``.
    The last table, ``predicted``, has ``fold, unique_id, classification, step, y_pred``.
    ``known``, SQL on ``ds``, is a second feature of daily rows that end at ``hi``.
    """
    if known != "0.0":
        both = "covar_pop(before, x)"
        det = f"(var_pop(before) * var_pop(x) - {both} * {both})"
        slopes = (
            f"(covar_pop(before, z) * var_pop(x) - covar_pop(x, z) * {both}) / {det} AS b, "
            f"(covar_pop(x, z) * var_pop(before) - covar_pop(before, z) * {both}) / {det} AS c, "
            "avg(z) AS mz, avg(before) AS mb, avg(x) AS mx"
        )
        fits = (
            "SELECT fold, classification, b, c, mz - b * mb - c * mx AS a FROM "
            f"(SELECT fold, classification, {slopes} FROM (SELECT *, {known} AS x FROM matrix) "
            "WHERE z IS NOT NULL AND before IS NOT NULL GROUP BY 1, 2)"
        )
    else:
        fits = (
            "SELECT fold, classification, regr_slope(z, before) AS b, regr_intercept(z, before) AS a, "
            "0.0 AS c FROM matrix WHERE z IS NOT NULL AND before IS NOT NULL GROUP BY 1, 2"
        )
    ahead = known.replace("ds", "(last_day + step + 1)")
    series = "PARTITION BY fold, unique_id"
    scaled = "classification IN ('Erratic', 'Lumpy')"
    return {
        **history,
        "diffs": f"SELECT *, y - lag(y) OVER ({series} ORDER BY ds) AS d FROM hist",
        "based": "SELECT *, CASE WHEN classification = 'Erratic' THEN y ELSE d END AS base FROM diffs",
        "moments": (
            f"SELECT *, CASE WHEN {scaled} THEN avg(base) OVER ({series}) ELSE 0.0 END AS centre, "
            f"CASE WHEN {scaled} THEN coalesce(nullif(stddev_pop(base) OVER ({series}), 0), 1.0) "
            "ELSE 1.0 END AS scale FROM based"
        ),
        "zs": "SELECT *, (base - centre) / scale AS z FROM moments",
        "matrix": f"SELECT *, lag(z) OVER ({series} ORDER BY ds) AS before FROM zs",
        "fits": fits,
        "ends": f"SELECT *, row_number() OVER ({series} ORDER BY ds DESC) AS back FROM zs",
        "predicted": (
            "SELECT fold, unique_id, classification, 0 AS step, z, y AS y_pred, centre, scale, a, b, c, "
            f"{hi} AS last_day FROM ends JOIN fits USING (fold, classification) WHERE back = 1 UNION ALL "
            f"SELECT fold, unique_id, classification, step + 1, a + b * z + c * {ahead}, "
            f"(a + b * z + c * {ahead}) * scale + centre + "
            "CASE WHEN classification = 'Erratic' THEN 0.0 ELSE y_pred END, centre, scale, a, b, c, "
            f"last_day FROM predicted WHERE step < {steps}"
        ),
    }


def _recursive(ctes: dict[str, str], query: str) -> str:
    return _with(ctes, query).replace("WITH ", "WITH RECURSIVE ", 1)


def _cents(expression: str, name: str) -> str:
    return f"round({expression}, 2) + 0.0 AS {name}"


def _forecast_sql(panel: str, horizon: int, *extra: str) -> str:
    ctes = _linear(
        {**prepared(panel), "hist": "SELECT 0 AS fold, * FROM prepared"}, horizon
    )
    ctes["final"] = "SELECT max(ds) AS hi FROM prepared"
    columns = ", ".join(["unique_id, CAST(hi + to_months(step) AS DATE) AS ds",
                         _cents("y_pred", "y_pred"), *extra])
    return _recursive(ctes, f"SELECT {columns} FROM predicted CROSS JOIN final WHERE step > 0")


def _known_future_sql(panel: str, horizon: int) -> str:
    """Daily forecasts with the sine of the week as a second feature."""
    ctes = {**prepared(panel), "cal": _calendar("1 DAY")}
    ctes["hist"] = "SELECT 0 AS fold, * FROM prepared"
    week = "sin(2 * pi() * CAST((ds - DATE '1970-01-01') % 7 AS DOUBLE) / 7)"
    ctes = _linear(ctes, horizon, week, "(SELECT max(ds) FROM prepared)")
    return _recursive(
        ctes,
        f"SELECT unique_id, last_day + step AS ds, {_cents('y_pred', 'y_pred')} "
        "FROM predicted WHERE step > 0",
    )


def _rerun_sql(panel: str, horizons: dict[str, int]) -> str:
    ctes = _linear(
        {**prepared(panel), "hist": "SELECT 0 AS fold, * FROM prepared"}, max(horizons.values())
    )
    ctes["final"] = "SELECT max(ds) AS hi FROM prepared"
    versions = ", ".join(f"('{v}', {n})" for v, n in horizons.items())
    return _recursive(
        ctes,
        f"SELECT unique_id, CAST(hi + to_months(step) AS DATE) AS ds, {_cents('y_pred', 'y_pred')}, "
        f"version FROM predicted CROSS JOIN final CROSS JOIN (VALUES {versions}) t(version, n) "
        "WHERE step BETWEEN 1 AND n",
    )


def _backtest_sql(panel: str, windows: int, periods: int) -> str:
    ctes = {
        **prepared(panel),
        "placed": (
            "SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS r FROM prepared"
        ),
        "folds": f"SELECT unnest(generate_series(0, {windows - 1})) AS fold",
        "cut": f"SELECT *, r - ({windows} - fold) * {periods} AS left_rows FROM placed CROSS JOIN folds",
        "hist": "SELECT fold, unique_id, ds, y, classification FROM cut WHERE left_rows > 0",
    }
    ctes = _linear(ctes, periods)
    ctes["cutoffs"] = "SELECT fold, unique_id, max(ds) AS cutoff FROM hist GROUP BY 1, 2"
    return _recursive(
        ctes,
        f"SELECT c.unique_id, c.ds, cutoff, {_r('c.y', 'y')}, {_cents('y_pred', 'y_pred')}, "
        "c.classification FROM cut c JOIN cutoffs o ON o.fold = c.fold AND o.unique_id = c.unique_id "
        "JOIN predicted q ON q.fold = c.fold AND q.unique_id = c.unique_id "
        "AND q.step = 1 - c.left_rows WHERE q.step > 0",
    )


def _dispersion() -> str:
    columns = ["classification", "count(*) AS n_series"]
    for m in ("adi", "cv2"):
        columns += [
            _r(f"avg({m})", f"mean_{m}"),
            _r(f"stddev_pop({m})", f"std_intra_{m}"),
            _r(f"var_pop({m})", f"var_intra_{m}"),
            _r(f"quantile_disc({m}, 0.5)", f"{m}_p50"),
            _r(f"quantile_disc({m}, 0.9)", f"{m}_p90"),
        ]
    return f"SELECT {', '.join(columns)} FROM metrics GROUP BY 1"


def _show(source: str, extra: str = "") -> str:
    return f"SELECT unique_id, ds, {_Y}{extra} FROM {source}"


_CLEAN_COUNTS = (
    "SELECT (SELECT count(DISTINCT unique_id) FROM filled) AS series_before, "
    "(SELECT count(DISTINCT unique_id) FROM cleaned) AS series_after, "
    "(SELECT count(*) FROM filled) AS rows_before, (SELECT count(*) FROM cleaned) AS rows_after"
)

ORACLE: dict[str, str] = {
    "read_series_panel": (
        "SELECT CAST(l_partkey AS VARCHAR) AS unique_id, CAST(l_shipdate AS DATE) AS ds, "
        f"{_r('sum(l_quantity)', 'y')} FROM lineitem GROUP BY 1, 2"
    ),
    "read_series_first": (
        "SELECT CAST(o_custkey AS VARCHAR) AS unique_id, CAST(o_orderdate AS DATE) AS ds, "
        f"{_r('min(o_totalprice)', 'y')}, min_by(o_orderpriority, (o_totalprice, o_orderpriority)) "
        "AS o_orderpriority FROM orders GROUP BY 1, 2"
    ),
    "read_series_permissive": (
        "SELECT CAST(o_custkey AS VARCHAR) AS unique_id, CAST(o_orderdate AS DATE) AS ds, "
        "sum(TRY_CAST(left(o_orderpriority, 1) AS DOUBLE)) AS y FROM orders GROUP BY 1, 2"
    ),
    "read_series_unreadable": (
        "SELECT CAST(o_custkey AS VARCHAR) AS unique_id, CAST(o_orderdate AS DATE) AS ds, "
        "sum(CASE WHEN o_orderstatus = 'O' THEN 7.0 END) AS y FROM orders GROUP BY 1, 2"
    ),
    "split_train": _with({"p": PANEL["part_month"]}, _show("p") + f" WHERE ds <= DATE '{SPLIT}'"),
    "split_test": _with({"p": PANEL["part_month"]}, _show("p") + f" WHERE ds > DATE '{SPLIT}'"),
    "dedupe_keys": (
        "SELECT CAST(l_partkey AS VARCHAR) AS unique_id, CAST(l_shipdate AS DATE) AS ds, "
        f"{_r('min(l_quantity)', 'y')} FROM lineitem GROUP BY 1, 2"
    ),
    "panel_bounds": _with(
        {"p": PANEL["part_month"]},
        "SELECT 'all' AS dataset, min(ds) AS min_ds, max(ds) AS max_ds FROM p UNION ALL "
        f"SELECT 'train', min(ds), max(ds) FROM p WHERE ds <= DATE '{SPLIT}' UNION ALL "
        f"SELECT 'test', min(ds), max(ds) FROM p WHERE ds > DATE '{SPLIT}'",
    ),
    "fill_calendar_month_start": _with(filled("nation_segment"), _show("filled")),
    "fill_calendar_month_end": _with(filled("part_month", month_end=True), _show("filled")),
    "fill_calendar_day": _with(filled("user_day", _calendar("1 DAY")), _show("filled")),
    "fill_calendar_week": _with(
        filled(
            "supplier_day",
            _calendar("7 DAY", lo="lo + CAST((7 - isodow(lo)) % 7 AS INTEGER)"),
        ),
        _show("filled"),
    ),
    "fill_calendar_workday": _with(
        filled(
            "supplier_day",
            f"SELECT ds FROM ({_calendar('1 DAY')}) WHERE isodow(ds) <= 5",
        ),
        _show("filled"),
    ),
    "fill_calendar_quarter": _with(
        filled(
            "nation_segment",
            f"SELECT ds FROM ({_calendar()}) WHERE month(ds) IN (1, 4, 7, 10)",
        ),
        _show("filled"),
    ),
    "fill_calendar_two_months": _with(
        filled("nation_segment", _calendar("2 MONTH")), _show("filled")
    ),
    "fill_calendar_business_month": _with(
        filled("supplier_day", _month_anchors("m + CASE isodow(m) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END")),
        _show("filled"),
    ),
    "fill_calendar_business_month_end": _with(
        filled(
            "supplier_day",
            _month_anchors("last_day(m) - CAST(greatest(isodow(last_day(m)) - 5, 0) AS INTEGER)"),
        ),
        _show("filled"),
    ),
    "fill_calendar_half_month": _with(
        filled("supplier_day", _month_anchors("m", "m + 14")), _show("filled")
    ),
    "fill_calendar_static": _with(
        {
            "p": PANEL["part_month_static"],
            "b": _BOUNDS,
            "cal": _calendar(),
            "ids": (
                "SELECT unique_id, max_by(p_brand, ds) AS p_brand, max_by(p_size, ds) AS p_size "
                "FROM p GROUP BY 1"
            ),
            "filled": (
                "SELECT i.unique_id, c.ds, i.p_brand, i.p_size, p.y FROM ids i CROSS JOIN cal c "
                "LEFT JOIN p ON p.unique_id = i.unique_id AND p.ds = c.ds"
            ),
        },
        _show("filled", ", p_brand, p_size"),
    ),
    "off_calendar_rows": _with({"p": PANEL["order_day"]}, _show("p") + " WHERE day(ds) <> 1"),
    "trim_leading_nulls": _with(
        {**filled("part_returns_nullable"), "out": _trim("filled", "y IS NOT NULL")}, _show("out")
    ),
    "trim_leading_zeros": _with(
        {"p": PANEL["part_returns"], "out": _trim("p", "y <> 0")}, _show("out")
    ),
    "drop_zero_only": _with(
        {"p": PANEL["customer_refunds"], "out": _zero_only("p")}, _show("out")
    ),
    "drop_inactive": _with({"p": PANEL["part_returns"], "out": _inactive("p")}, _show("out")),
    "drop_short": _with({"p": PANEL["customer_refunds"], "out": _short("p")}, _show("out")),
    "clean_all": _with(cleaned("customer_refunds"), _show("cleaned")),
    "clean_steps": _with(cleaned("part_returns_nullable"), _show("cleaned")),
    "cleaning_report": _with(
        {**cleaned("part_returns_nullable"), "n": _CLEAN_COUNTS},
        "SELECT *, series_before - series_after AS series_dropped, "
        "rows_before - rows_after AS rows_dropped FROM n",
    ),
    "cleaning_report_observed": _with(
        {**cleaned("part_returns_nullable"), "n": _CLEAN_COUNTS},
        "SELECT *, series_before - series_after AS series_dropped, "
        "rows_before - rows_after AS rows_dropped FROM n",
    ),
    "demand_metrics": _with(
        labelled("nation_segment"),
        f"SELECT unique_id, classification, {_r('adi', 'adi')}, {_r('cv2', 'cv2')} FROM metrics",
    ),
    "classify_demand": _with(labelled("nation_segment"), _show("labelled", ", classification")),
    "class_distribution": _with(
        labelled("part_month"),
        "SELECT classification, count(*) AS n_series FROM metrics GROUP BY 1",
    ),
    "class_dispersion": _with(labelled("nation_segment"), _dispersion()),
    "impute_rolling_mean": _with(
        filled("nation_segment"), f"SELECT unique_id, ds, {_r(_filled_by(_mean(3)), 'y')} FROM filled"
    ),
    "impute_rolling_median": _with(
        filled("nation_segment"),
        f"SELECT unique_id, ds, {_r(_filled_by(_median(4)), 'y')} FROM filled",
    ),
    "impute_zero": _with(
        filled("part_month"), f"SELECT unique_id, ds, {_r('coalesce(y, 0.0)', 'y')} FROM filled"
    ),
    "impute_by_class": _with(prepared("nation_segment"), _show("prepared", ", classification")),
    "prepare_panel": _with(prepared("part_month"), _show("prepared", ", classification")),
    "prepare_panel_day": _with(
        {**prepared("user_day"), "cal": _calendar("1 DAY")}, _show("prepared", ", classification")
    ),
    "future_calendar": _with(
        {
            "p": PANEL["part_month"],
            "b": "SELECT max(ds) + INTERVAL 1 MONTH AS lo, max(ds) + INTERVAL 6 MONTH AS hi FROM p",
            "cal": _calendar(),
        },
        "SELECT i.unique_id, c.ds FROM (SELECT DISTINCT unique_id FROM p) i CROSS JOIN cal c",
    ),
    "misaligned_series": _with(
        {
            "p": PANEL["part_month"],
            "last": "SELECT unique_id, max(ds) AS last_ds FROM p GROUP BY 1",
            "b": "SELECT max(ds) AS global_last_ds FROM p",
        },
        "SELECT unique_id, last_ds, global_last_ds FROM last CROSS JOIN b "
        "WHERE last_ds < global_last_ds",
    ),
    "series_function": _with(
        {"p": PANEL["supplier_month"]},
        f"SELECT unique_id, ds, {_r(f'sum(y) OVER ({_ORDER})', 'total')} FROM p",
    ),
    "target_difference": _with(
        {"p": PANEL["supplier_month"]},
        f"SELECT unique_id, ds, {_Y}, {_r(f'y - lag(y) OVER ({_ORDER})', 'z')} FROM p",
    ),
    "target_local_scale": _with(
        {"p": "SELECT *, y AS z FROM (" + PANEL["supplier_month"] + ")"},
        f"SELECT unique_id, ds, {_Y}, {_r(_SCALE, 'z')} FROM p",
    ),
    "lag_features_smooth": _lag_matrix(
        "Smooth",
        [_DIFF],
        {
            "lag1": _lag(1),
            "lag4": _lag(4),
            "rolling_mean_lag1_w3": _rolling(1, 3, 3),
            "rolling_mean_lag4_w6": _rolling(4, 6, 6),
        },
    ),
    "lag_features_erratic": _lag_matrix(
        "Erratic",
        [_SCALE],
        {
            "lag1": _lag(1),
            "lag2": _lag(2),
            "lag3": _lag(3),
            "expanding_std_lag1": _expanding(1),
            "rolling_mean_lag2_w3": _rolling(2, 3, 1),
            "ewm_lag3_a0_5": _ewm(3, 0.5),
        },
    ),
    "lag_features_lumpy": _lag_matrix(
        "Lumpy",
        [_DIFF, _SCALE],
        {
            "lag1": _lag(1),
            "lag2": _lag(2),
            "lag3": _lag(3),
            "expanding_std_lag1": _expanding(1),
            "rolling_mean_lag2_w6": _rolling(2, 6, 1),
            "rolling_mean_lag2_w12": _rolling(2, 12, 1),
            "ewm_lag3_a0_3": _ewm(3, 0.3),
        },
    ),
    "lag_features_intermittent": _lag_matrix(
        "Intermittent",
        [_DIFF],
        {
            "lag1": _lag(1),
            "lag3": _lag(3),
            "lag6": _lag(6),
            "lag12": _lag(12),
            "expanding_std_lag1": _expanding(1),
            "rolling_mean_lag12_w12": _rolling(12, 12, 1),
        },
    ),
    "harmonic_features": _with(
        {
            "p": PANEL["part_month"],
            "placed": "SELECT *, year(ds) * 12 + month(ds) - 1 AS k FROM p",
        },
        f"SELECT unique_id, ds, {_Y}, "
        + ", ".join(
            _r(f"{wave}(2 * pi() * {order} * k / {length})", f"{wave}_{length}_{order}")
            for length, order, wave in [
                (12, 1, "sin"), (12, 1, "cos"), (12, 2, "sin"), (12, 2, "cos"),
                (4, 1, "sin"), (4, 1, "cos"), (4, 2, "cos"),
            ]
        )
        + " FROM placed",
    ),
    "ensemble_mean": _with(
        {
            "p": filled("part_returns_nullable")["p"],
            "two": f"SELECT unique_id, ds, y AS a, lag(y) OVER ({_ORDER}) AS b FROM p",
        },
        f"SELECT unique_id, ds, {_r('coalesce((a + b) / 2, a, b)', 'y_pred')} FROM two",
    ),
    "cv_folds": _fold_sql("supplier_month", 3, 4),
    "training_roundtrip": _with(
        prepared("nation_segment"),
        "SELECT unique_id, ds, " + _Y + ", classification, "
        + _r("avg(y) OVER (PARTITION BY unique_id)", "level") + " FROM prepared",
    ),
    "forecast_append_roundtrip": _with(
        {"p": PANEL["supplier_month"]},
        f"SELECT unique_id, ds, {_r('y', 'y_pred')}, 'v1' AS version FROM p UNION ALL "
        f"SELECT unique_id, ds, {_r('y * 2', 'y_pred')}, 'v2' AS version FROM p",
    ),
    "train_test_future_bounds": _with(
        {
            "raw": (
                "SELECT CAST(l_suppkey AS VARCHAR) AS unique_id, CAST(l_shipdate AS DATE) AS ds, "
                "sum(l_quantity) AS y FROM lineitem GROUP BY 1, 2"
            ),
            **{
                name: sql
                for name, sql in {
                    **cleaned("supplier_day"),
                    "p": f"SELECT * FROM raw WHERE ds <= DATE '{SPLIT}'",
                    "cal": _calendar("1 DAY"),
                }.items()
            },
        },
        "SELECT 'train' AS dataset, min(ds) AS min_ds, max(ds) AS max_ds, count(*) AS n_rows FROM cleaned "
        f"UNION ALL SELECT 'test', min(ds), max(ds), count(*) FROM raw WHERE ds > DATE '{SPLIT}' "
        "UNION ALL SELECT 'future', min(d), max(d), count(*) FROM "
        "(SELECT DISTINCT unique_id FROM cleaned) CROSS JOIN "
        "(SELECT CAST(unnest(generate_series(CAST(hi + INTERVAL 1 DAY AS TIMESTAMP), "
        "CAST(hi + INTERVAL 14 DAY AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d "
        "FROM (SELECT max(ds) AS hi FROM cleaned))",
    ),
    "layout_by_series": _with({"p": PANEL["part_month"]}, _show("p")),
    "forecast_all": _forecast_sql("nation_segment", 6),
    "forecast_parts": _forecast_sql("part_month", 6),
    "forecast_parts_long": _forecast_sql("part_month", 60),
    "forecast_own_future": _forecast_sql("supplier_month", 6),
    "forecast_known_future": _known_future_sql("supplier_day", 14),
    "forecast_rerun": _rerun_sql("part_month", {"v1": 3, "v2": 2}),
    "forecast_table": _forecast_sql("nation_segment", 3, "'v1' AS version"),
    "model_save_load": _forecast_sql("nation_segment", 2, _cents("y_pred", "y_pred_loaded")),
    "backtest_all": _backtest_sql("nation_segment", 2, 3),
    "model_save_load_parts": _forecast_sql("part_month", 2, _cents("y_pred", "y_pred_loaded")),
    "backtest_parts": _backtest_sql("part_month", 2, 3),
    "backtest_parts_folds": _backtest_sql("part_month", 6, 2),
    "importance_parts": _with(
        prepared("part_month"),
        "SELECT DISTINCT classification, 'linear' AS model, 'lag1' AS feature_name, "
        "CAST(1 AS DOUBLE) AS importance FROM prepared",
    ),
    "importance_all": _with(
        prepared("nation_segment"),
        "SELECT DISTINCT classification, 'linear' AS model, 'lag1' AS feature_name, "
        "CAST(1 AS DOUBLE) AS importance FROM prepared",
    ),
    "load_for_forecast": _with(
        prepared("nation_segment"),
        "SELECT 'training' AS dataset, min(ds) AS min_ds, max(ds) AS max_ds, count(*) AS n_rows "
        "FROM prepared UNION ALL SELECT 'future', min(d), max(d), count(*) FROM "
        "(SELECT DISTINCT unique_id FROM prepared) CROSS JOIN "
        "(SELECT CAST(unnest(generate_series(CAST(hi + INTERVAL 1 MONTH AS TIMESTAMP), "
        "CAST(hi + INTERVAL 6 MONTH AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS d "
        "FROM (SELECT max(ds) AS hi FROM prepared))",
    ),
    "build_training_table": _with(
        {**prepared("supplier_day"), "cal": _calendar("1 DAY")},
        _show("prepared", ", classification, true AS decomposed"),
    ),
}
