"""The same results as plain SQL for DuckDB, written independently.

Each query is a chain of named SELECTs over the driver tables.  The engines
divide differently, so ratios are rounded with whole numbers here: money in
cents, rates in ten-thousandths, ``(2 * n + d) // (2 * d)`` rounding half up.
"""

from __future__ import annotations

import re

from clickstrata.schemas import TABLES
from clickstrata.sources.driver_mapping import duckdb_stamp, mappings

SCOPE = "starts_with(tracking_id, 'trk_py_')"


# --- exact arithmetic -------------------------------------------------------


def _rounded(numerator: str, denominator: str, kind: str, unit: str) -> str:
    """Half-up ``numerator / denominator`` counted in ``unit``; NULL over 0."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    whole = f"((2 * {n} + {d}) // (2 * {d}))"
    return (
        f"CASE WHEN {denominator} = 0 THEN NULL "
        f"ELSE CAST(CAST({whole} AS BIGINT) * CAST({unit} AS {kind}) AS {kind}) END"
    )


def rate(numerator: str, denominator: str) -> str:
    return _rounded(f"10000 * ({numerator})", denominator, "DECIMAL(18,4)", "0.0001")


def rate0(numerator: str, denominator: str) -> str:
    return f"coalesce({rate(numerator, denominator)}, 0)"


def cents(money: str) -> str:
    return f"CAST(({money}) * 100 AS BIGINT)"


def ecpm(revenue: str = "revenue", impressions: str = "impressions") -> str:
    return _rounded(f"1000 * {cents(revenue)}", impressions, "DECIMAL(18,2)", "0.01")


def ecpm0(revenue: str = "revenue", impressions: str = "impressions") -> str:
    return f"coalesce({ecpm(revenue, impressions)}, 0)"


def lift(name: str) -> str:
    """Percent change of a stored rate, half away from zero."""
    a = f"CAST(a.{name} * 10000 AS BIGINT)"
    b = f"CAST(b.{name} * 10000 AS BIGINT)"
    size = _rounded(f"10000 * abs({b} - {a})", a, "DECIMAL(18,2)", "0.01")
    return f"sign({b} - {a}) * ({size})"


def lift_text(name: str) -> str:
    return f"coalesce(CAST(CAST({lift(name)} AS DECIMAL(18,2)) AS VARCHAR), 'NULL')"


def text(expression: str) -> str:
    return f"coalesce(CAST({expression} AS VARCHAR), 'NULL')"


def counts(*kinds: str) -> str:
    names = {
        "impression": "impressions",
        "click": "clicks",
        "install": "installs",
        "conversion": "conversions",
        "reward": "rewards",
    }
    return ", ".join(
        f"count(*) FILTER (WHERE event_type = '{k}') AS {names[k]}"
        for k in (kinds or names)
    )


def summed(*names: str, prefix: str = "", table: str = "") -> str:
    """Long sums of counters, kept in BIGINT."""
    dot = f"{table}." if table else ""
    return ", ".join(f"CAST(sum({dot}{n}) AS BIGINT) AS {prefix}{n}" for n in names)


def money_sum(name: str, alias: str | None = None) -> str:
    return f"CAST(coalesce(sum({name}), 0) AS DECIMAL(18,2)) AS {alias or name}"


_RATES = (
    f"{rate('clicks', 'impressions')} AS ctr, "
    f"{rate('installs', 'clicks')} AS install_rate, "
    f"{rate('conversions', 'installs')} AS conversion_rate"
)
_RATES0 = (
    f"{rate0('clicks', 'impressions')} AS ctr, "
    f"{rate0('installs', 'clicks')} AS install_rate, "
    f"{rate0('conversions', 'installs')} AS conversion_rate"
)
_TWO_RATES = (
    f"{rate('clicks', 'impressions')} AS ctr, "
    f"{rate('installs', 'clicks')} AS install_rate"
)
_TWO_RATES0 = (
    f"{rate0('clicks', 'impressions')} AS ctr, "
    f"{rate0('installs', 'clicks')} AS install_rate"
)
_FUNNEL = "impressions, clicks, installs, conversions"
_TRAITS = "campaign_name, target_country, target_platform, target_category"


# --- named steps ------------------------------------------------------------


def _mismatch(column: str, error_type: str) -> str:
    return f"""
        SELECT e.raw_event_id, e.event_id, e.tracking_id, '{error_type}' AS error_type,
               'Raw event ' || e.event_id || ' {column} ' || {text('e.' + column)}
               || ' does not match ad request {column} ' || {text('q.' + column)} || '.'
                   AS error_message
        FROM events_raw e JOIN ad_requests q USING (tracking_id)
        WHERE e.{column} IS DISTINCT FROM q.{column}"""


_ERRORS = {
    "missing_tracking_id": """
        SELECT raw_event_id, event_id, tracking_id,
               'missing_tracking_id' AS error_type,
               'Raw event ' || event_id || ' has no tracking_id.' AS error_message
        FROM events_raw WHERE tracking_id IS NULL""",
    "unknown_tracking_id": """
        SELECT raw_event_id, event_id, tracking_id,
               'unknown_tracking_id' AS error_type,
               'Raw event ' || event_id || ' references unknown tracking_id: '
               || tracking_id AS error_message
        FROM events_raw e
        WHERE tracking_id IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM ad_requests q WHERE q.tracking_id = e.tracking_id)""",
    "duplicate_event_id": """
        SELECT raw_event_id, event_id, tracking_id,
               'duplicate_event_id' AS error_type,
               'Raw event_id ' || event_id || ' appears multiple times in events_raw.'
                   AS error_message
        FROM (SELECT *, count(*) OVER (PARTITION BY event_id) AS copies
              FROM events_raw)
        WHERE copies > 1""",
    "campaign_mismatch": _mismatch("campaign_id", "campaign_mismatch"),
    "app_mismatch": _mismatch("app_id", "app_mismatch"),
    "user_mismatch": _mismatch("user_id", "user_mismatch"),
    "country_mismatch": _mismatch("country", "country_mismatch"),
    "platform_mismatch": _mismatch("platform", "platform_mismatch"),
}


def _daily_campaign(source: str) -> str:
    return f"""
        SELECT metric_date, campaign_id, impressions, clicks, installs, conversions,
               rewards, {_RATES0}, spend, revenue, revenue - spend - reward_cost AS profit,
               {ecpm0()} AS ecpm
        FROM (
            SELECT CAST(event_time AS DATE) AS metric_date, campaign_id, {counts()},
                   CAST(count(*) FILTER (WHERE event_type = 'install')
                        * any_value(bid_cpi) AS DECIMAL(18,2)) AS spend,
                   {money_sum('revenue')}, {money_sum('reward_cost')}
            FROM {source} JOIN campaigns USING (campaign_id)
            WHERE {SCOPE}
            GROUP BY ALL
        )"""


def _daily_app(source: str) -> str:
    return f"""
        SELECT CAST(event_time AS DATE) AS metric_date, app_id,
               {counts('impression', 'click', 'install', 'conversion')},
               {money_sum('revenue')}, {money_sum('reward_cost')}
        FROM {source}
        WHERE {SCOPE}
        GROUP BY ALL"""


def _campaign_kpi(ecpm_sql: str) -> str:
    return f"""
        SELECT campaign_id, {_TRAITS}, bid_cpi, impressions, clicks, installs,
               conversions, rewards, {_RATES}, spend, revenue, reward_cost,
               revenue - spend - reward_cost AS profit, {ecpm_sql} AS ecpm
        FROM (
            SELECT campaign_id, {_TRAITS}, bid_cpi, {counts()},
                   CAST(count(*) FILTER (WHERE event_type = 'install')
                        * any_value(bid_cpi) AS DECIMAL(18,2)) AS spend,
                   {money_sum('revenue')}, {money_sum('reward_cost')}
            FROM events_raw JOIN campaigns USING (campaign_id)
            WHERE {SCOPE}
            GROUP BY ALL
        )"""


def _arms(keys: str) -> str:
    """Experiment totals straight from the four-way join."""
    return f"""
        SELECT {keys}, count(DISTINCT ad_request_id) AS ad_requests, {counts()},
               CAST(sum(CASE WHEN event_type = 'install' THEN bid_cpi ELSE 0 END)
                    AS DECIMAL(18,2)) AS spend,
               {money_sum('e.revenue', 'revenue')},
               {money_sum('e.reward_cost', 'reward_cost')}
        FROM ad_requests q
        JOIN experiments x ON x.experiment_id = q.experiment_id
        JOIN campaigns c ON c.campaign_id = q.campaign_id
        LEFT JOIN events_raw e ON e.tracking_id = q.tracking_id
        WHERE starts_with(q.tracking_id, 'trk_py_')
        GROUP BY ALL"""


_ARM_KPIS = f"""
    ad_requests, impressions, clicks, installs, conversions, rewards,
    {rate0('impressions', 'ad_requests')} AS impression_rate, {_RATES0},
    spend, revenue, reward_cost, revenue - spend - reward_cost AS profit,
    {ecpm0()} AS ecpm"""


def _alert(
    rule_id: str, group: str, kind: str, severity: str, entity: str, key: str, msg: str
) -> str:
    return (
        f"'{rule_id}' AS rule_id, '{group}' AS rule_group, '{kind}' AS alert_type, "
        f"'{severity}' AS severity, '{entity}' AS entity_type, "
        f"CAST({key} AS VARCHAR) AS entity_id, {msg} AS alert_message"
    )


def _quality(rule_id: str, severity: str, entity: str, key: str, msg: str) -> str:
    return _alert(rule_id, "data_quality", "data_quality", severity, entity, key, msg)


def _performance(rule_id: str, severity: str, msg: str) -> str:
    start = f"'[Generated Monitoring] Campaign ' || campaign_id || ' - ' || campaign_name || {msg}"
    return _alert(
        rule_id,
        "generated_monitoring",
        "performance",
        severity,
        "campaign",
        "campaign_id",
        start,
    )


def _money_text(name: str) -> str:
    return f"CAST(CAST({name} AS DECIMAL(18,2)) AS VARCHAR)"


_QUALITY_ALERTS = {
    "dq_missing_or_unknown_tracking": f"""
        SELECT {_quality(
            'dq_missing_or_unknown_tracking', 'high', 'tracking_id',
            "coalesce(e.tracking_id, 'NULL')",
            "'Event ' || e.event_id || ' has missing or unknown tracking_id: ' || "
            "coalesce(e.tracking_id, 'NULL')")}
        FROM events_raw e LEFT JOIN ad_requests q ON q.tracking_id = e.tracking_id
        WHERE q.ad_request_id IS NULL""",
    "dq_duplicate_event_id": f"""
        SELECT {_quality(
            'dq_duplicate_event_id', 'high', 'system', 'event_id',
            "'Duplicate event_id detected: ' || event_id || ' appears ' || count(*) "
            "|| ' times in events_raw.'")}
        FROM events_raw GROUP BY event_id HAVING count(*) > 1""",
    "dq_duplicate_installs": f"""
        SELECT {_quality(
            'dq_duplicate_installs', 'high', 'tracking_id', 'tracking_id',
            "'Duplicate install problem: tracking_id ' || tracking_id || ' has ' "
            "|| count(*) || ' install events.'")}
        FROM events_raw
        WHERE event_type = 'install' AND tracking_id IS NOT NULL
        GROUP BY tracking_id HAVING count(*) > 1""",
    "dq_click_without_impression": f"""
        SELECT {_quality(
            'dq_click_without_impression', 'medium', 'tracking_id', 'tracking_id',
            "'Funnel issue: tracking_id ' || tracking_id "
            "|| ' has clicks but no impressions.'")}
        FROM events_raw WHERE tracking_id IS NOT NULL
        GROUP BY tracking_id
        HAVING bool_or(event_type = 'click') AND NOT bool_or(event_type = 'impression')""",
    "dq_install_without_click": f"""
        SELECT {_quality(
            'dq_install_without_click', 'medium', 'tracking_id', 'tracking_id',
            "'Attribution issue: tracking_id ' || tracking_id "
            "|| ' has installs but no clicks.'")}
        FROM events_raw WHERE tracking_id IS NOT NULL
        GROUP BY tracking_id
        HAVING bool_or(event_type = 'install') AND NOT bool_or(event_type = 'click')""",
    "dq_targeting_mismatch": f"""
        SELECT {_quality(
            'dq_targeting_mismatch', 'medium', 'campaign', 'e.campaign_id',
            "'Targeting mismatch for event ' || e.event_id || ': campaign targets ' "
            "|| c.target_country || '/' || c.target_platform || ' but event has ' "
            "|| e.country || '/' || e.platform || '.'")}
        FROM events_raw e JOIN campaigns c ON c.campaign_id = e.campaign_id
        WHERE e.country IS NOT NULL AND e.platform IS NOT NULL
          AND (e.country, e.platform) <> (c.target_country, c.target_platform)""",
    "perf_clicks_without_installs": f"""
        SELECT {_alert(
            'perf_clicks_without_installs', 'data_quality', 'performance', 'low',
            'campaign', 'campaign_id',
            "'Campaign ' || campaign_id || ' has ' "
            "|| count(*) FILTER (WHERE event_type = 'click') "
            "|| ' clicks but zero installs.'")}
        FROM events_raw WHERE campaign_id IS NOT NULL
        GROUP BY campaign_id
        HAVING bool_or(event_type = 'click') AND NOT bool_or(event_type = 'install')""",
}

_MONITORING_ALERTS = {
    "mon_negative_profit": f"""
        SELECT {_performance(
            'mon_negative_profit', 'high',
            f"' has very negative total profit: ' || {_money_text('profit')} "
            f"|| '. Revenue: ' || {_money_text('revenue')} "
            f"|| ', Spend: ' || {_money_text('spend')} || '.'")}
        FROM campaign_period WHERE profit < -150""",
    "mon_high_spend_low_revenue": f"""
        SELECT {_performance(
            'mon_high_spend_low_revenue', 'medium',
            f"' has high spend compared to revenue. Spend: ' || {_money_text('spend')} "
            f"|| ', Revenue: ' || {_money_text('revenue')} || ', ROAS: ' || "
            + text(rate(cents('revenue'), cents('spend'))) + " || '.'")}
        FROM campaign_period WHERE spend > 100 AND 2 * revenue < spend""",
    "mon_low_ctr": f"""
        SELECT {_performance(
            'mon_low_ctr', 'medium',
            "' has low CTR: ' || " + text(rate('clicks', 'impressions'))
            + " || '. Impressions: ' || impressions || ', Clicks: ' || clicks || '.'")}
        FROM campaign_period
        WHERE impressions >= 100 AND 100 * clicks < 22 * impressions""",
    "mon_weak_install_rate": f"""
        SELECT {_performance(
            'mon_weak_install_rate', 'medium',
            "' has acceptable CTR but weak install rate. CTR: ' || "
            + text(rate('clicks', 'impressions')) + " || ', Install rate: ' || "
            + text(rate('installs', 'clicks')) + " || '.'")}
        FROM campaign_period
        WHERE impressions >= 100 AND 100 * clicks >= 22 * impressions
          AND clicks > 0 AND 100 * installs < 32 * clicks""",
    "mon_daily_ctr_drop": f"""
        SELECT {_performance(
            'mon_daily_ctr_drop', 'high',
            "' CTR dropped by ' || " + text(_rounded(
                '10000 * (i * pc - c * pi)', '(i * pc)', 'DECIMAL(18,2)', '0.01'))
            + " || '% on ' || metric_date || '. Previous CTR: ' || " + text(rate('pc', 'pi'))
            + " || ', Current CTR: ' || " + text(rate('c', 'i')) + " || '.'")}
        FROM (
            SELECT metric_date, campaign_id, campaign_name, impressions AS i, clicks AS c,
                   lag(impressions) OVER by_day AS pi, lag(clicks) OVER by_day AS pc
            FROM daily_campaign_metrics JOIN campaigns USING (campaign_id)
            WINDOW by_day AS (PARTITION BY campaign_id ORDER BY metric_date)
        )
        WHERE pi > 0 AND pc > 0 AND i >= 20 AND 10 * (i * pc - c * pi) >= 3 * i * pc""",
    "mon_experiment_tradeoff": f"""
        SELECT {_alert(
            'mon_experiment_tradeoff', 'experiment_monitoring', 'experiment', 'medium',
            'experiment', 'b.variant',
            "'[Experiment Monitoring] Variant B improved CTR by ' || " + lift_text('ctr')
            + " || '%, install rate by ' || " + lift_text('install_rate')
            + " || '%, and conversion rate by ' || " + lift_text('conversion_rate')
            + " || '%, but profit delta is only ' || " + _money_text('b.profit - a.profit')
            + " || '. Review whether the higher spend is justified.'")}
        FROM experiment_results a JOIN experiment_results b USING (experiment_name)
        WHERE a.variant = 'A' AND b.variant = 'B' AND b.ctr > a.ctr
          AND b.install_rate > a.install_rate AND b.profit - a.profit < 50""",
}


def _union(parts) -> str:
    return "\n        UNION ALL\n".join(parts)


# Steps in an order in which each only uses earlier ones.
_STEPS: dict[str, str] = {
    **{name: mapping.sql() for name, mapping in mappings(duckdb_stamp).items()},
    "event_validation_errors": _union(_ERRORS.values()),
    "events_clean": """
        SELECT e.event_id, e.tracking_id, e.campaign_id, e.app_id, e.user_id,
               e.event_type, e.event_time, coalesce(e.revenue, 0) AS revenue,
               coalesce(e.reward_cost, 0) AS reward_cost, e.country, e.platform
        FROM events_raw e JOIN ad_requests q ON q.tracking_id = e.tracking_id
        WHERE e.raw_event_id NOT IN (SELECT raw_event_id FROM event_validation_errors)""",
    "daily_campaign_metrics": _daily_campaign("events_clean"),
    "daily_app_metrics": _daily_app("events_clean"),
    "campaign_period": f"""
        SELECT campaign_id, {_TRAITS},
               {summed('impressions', 'clicks', 'installs', 'conversions', table='d')},
               {money_sum('d.spend', 'spend')}, {money_sum('d.revenue', 'revenue')},
               {money_sum('d.profit', 'profit')}
        FROM daily_campaign_metrics d JOIN campaigns USING (campaign_id)
        GROUP BY ALL""",
    "app_period": f"""
        SELECT a.app_id, a.app_name, p.publisher_id, p.publisher_name,
               p.country AS publisher_country, a.category, a.platform,
               {summed('impressions', 'clicks', 'installs', 'conversions', table='d')},
               {money_sum('d.revenue', 'revenue')},
               {money_sum('d.reward_cost', 'reward_cost')}
        FROM daily_app_metrics d
        JOIN apps a ON a.app_id = d.app_id
        JOIN publishers p ON p.publisher_id = a.publisher_id
        GROUP BY ALL""",
    "experiment_results": f"""
        SELECT experiment_name, variant, algorithm_name, {_ARM_KPIS}
        FROM ({_arms('x.experiment_name, x.variant, x.algorithm_name')})""",
    "quality_alerts": _union(_QUALITY_ALERTS.values()),
    "monitoring_alerts": _union(_MONITORING_ALERTS.values()),
    "alerts": """
        SELECT *, false AS is_resolved FROM quality_alerts
        UNION ALL SELECT *, false FROM monitoring_alerts""",
}


def _uplift() -> str:
    rates = ("ctr", "install_rate", "conversion_rate")
    money = ("revenue", "spend", "profit", "ecpm")
    columns = [
        "a.variant AS baseline_variant",
        "b.variant AS test_variant",
        "a.algorithm_name AS baseline_algorithm",
        "b.algorithm_name AS test_algorithm",
        "a.ad_requests AS a_ad_requests",
        "b.ad_requests AS b_ad_requests",
    ]
    for name in rates:
        columns += [
            f"a.{name} AS a_{name}",
            f"b.{name} AS b_{name}",
            f"{lift(name)} AS {name}_lift_percent",
        ]
    for name in money:
        columns += [
            f"a.{name} AS a_{name}",
            f"b.{name} AS b_{name}",
            f"b.{name} - a.{name} AS {name}_delta",
        ]
    return (
        f"SELECT {', '.join(columns)} FROM experiment_results a "
        "JOIN experiment_results b USING (experiment_name) "
        "WHERE a.variant = 'A' AND b.variant = 'B'"
    )


def _constraint_audit() -> str:
    """One UNION ALL branch per declared constraint."""
    audited = (
        "publishers",
        "apps",
        "advertisers",
        "campaigns",
        "users",
        "experiments",
        "ad_requests",
        "events_raw",
        "events_clean",
        "daily_campaign_metrics",
        "daily_app_metrics",
        "alerts",
        "experiment_results",
        "event_validation_errors",
    )
    # Stamped when a table is written, so not part of a query's result.
    stamped = ("created_at", "detected_at", "calculated_at")
    parts: list[str] = []

    def check(table: str, kind: str, column: str, violations: str) -> None:
        parts.append(
            f"SELECT '{table}' AS table_name, '{kind}' AS constraint_kind, "
            f"'{column}' AS column_name, CAST(({violations}) AS BIGINT) AS violations"
        )

    for name in audited:
        table = TABLES[name]
        for column in table.columns:
            if column.name in stamped:
                continue
            rows = f"SELECT count(*) FROM {name} WHERE {column.name}"
            if column.required:
                check(name, "not_null", column.name, f"{rows} IS NULL")
            if column.domain:
                allowed = ", ".join(f"'{value}'" for value in column.domain)
                check(name, "domain", column.name, f"{rows} NOT IN ({allowed})")
            if column.max_length:
                check(
                    name,
                    "max_length",
                    column.name,
                    f"SELECT count(*) FROM {name} "
                    f"WHERE length({column.name}) > {column.max_length}",
                )
        keys = [("primary_key", table.primary_key)] if table.primary_key else []
        for kind, key in keys + [("unique", key) for key in table.unique]:
            names = ", ".join(key)
            check(
                name,
                kind,
                ",".join(key),
                f"SELECT (SELECT count(*) FROM {name}) - "
                f"(SELECT count(*) FROM (SELECT DISTINCT {names} FROM {name}))",
            )
        for link in table.foreign_keys:
            check(
                name,
                "foreign_key",
                link.column,
                f"SELECT count(*) FROM {name} child WHERE child.{link.column} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {link.parent} up "
                f"WHERE up.{link.parent_column} = child.{link.column})",
            )
    return _union(parts)


_DOOMED = "(starts_with(event_id, 'py_dup_') OR starts_with(tracking_id, 'trk_py_1'))"

_LISTING_SELECT = f"""
    SELECT metric_date, d.campaign_id, campaign_name, impressions, clicks, installs,
           conversions, rewards, ctr, install_rate, conversion_rate, spend, revenue,
           profit, ecpm
    FROM daily_campaign_metrics d JOIN campaigns c ON c.campaign_id = d.campaign_id"""

_CAMPAIGN_PERFORMANCE = f"""
    SELECT campaign_id, {_TRAITS}, {_FUNNEL}, {_RATES0}, spend, revenue, profit,
           {ecpm0()} AS ecpm
    FROM campaign_period"""

_APP_PERFORMANCE = f"""
    SELECT app_id, app_name, publisher_name, category, platform, {_FUNNEL},
           {_TWO_RATES0}, revenue, reward_cost
    FROM app_period"""

_OVERVIEW = f"""
    SELECT {_FUNNEL}, {_RATES0}, spend, revenue, profit
    FROM (SELECT {summed('impressions', 'clicks', 'installs', 'conversions')},
                 {money_sum('spend')}, {money_sum('revenue')}, {money_sum('profit')}
          FROM daily_campaign_metrics)"""

_ERROR_SUMMARY = (
    "SELECT error_type, count(*) AS error_count FROM event_validation_errors GROUP BY 1"
)

_ARM_TREND = f"""
    SELECT request_date, variant, algorithm_name, ad_requests, {_FUNNEL}, {_TWO_RATES0},
           revenue, spend, revenue - spend - reward_cost AS profit
    FROM ({_arms('CAST(q.request_time AS DATE) AS request_date, x.variant, x.algorithm_name')})"""


def _period(keys: str, source: str, rates: str, money: tuple[str, ...]) -> str:
    """A further rollup of per-campaign or per-app totals."""
    return f"""
    SELECT {keys}, {_FUNNEL}, {rates}, {', '.join(f'{m} AS total_{m}' for m in money)}
    FROM (SELECT {keys}, {summed('impressions', 'clicks', 'installs', 'conversions')},
                 {', '.join(money_sum(m) for m in money)}
          FROM {source} GROUP BY ALL)"""


_SPEND = ("spend", "revenue", "profit")
_APP_MONEY = ("revenue", "reward_cost")


def _percent(numerator: str, denominator: str) -> str:
    return f"CAST(CAST(100 * {rate0(numerator, denominator)} AS DECIMAL(18,2)) AS VARCHAR) || '%'"


_BODIES: dict[str, str] = {
    "funnel_by_tracking": f"""
    SELECT tracking_id, {counts()}, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue,
           CAST(sum(reward_cost) AS DECIMAL(18,2)) AS reward_cost
    FROM events_raw WHERE {SCOPE} GROUP BY tracking_id""",
    "campaign_kpi": _campaign_kpi(ecpm0()),
    "campaign_kpi_nullable_ecpm": _campaign_kpi(ecpm()),
    "daily_campaign_metrics_raw": _daily_campaign("events_raw"),
    "daily_campaign_metrics": "SELECT * FROM daily_campaign_metrics",
    "daily_app_metrics_raw": _daily_app("events_raw"),
    "daily_app_metrics": "SELECT * FROM daily_app_metrics",
    "daily_app_overview": """
    SELECT d.metric_date, d.app_id, a.app_name, a.category, a.platform,
           p.publisher_name, d.impressions, d.clicks, d.installs, d.conversions,
           d.revenue, d.reward_cost
    FROM daily_app_metrics d JOIN apps a ON a.app_id = d.app_id
    JOIN publishers p ON p.publisher_id = a.publisher_id""",
    "daily_campaign_by_profit": _LISTING_SELECT,
    "daily_campaign_overview": _LISTING_SELECT,
    "campaigns_best": f"""
    SELECT campaign_id, {_TRAITS}, {_FUNNEL}, {_RATES}, spend AS total_spend,
           revenue AS total_revenue, profit AS total_profit, {ecpm()} AS ecpm
    FROM campaign_period""",
    "campaigns_worst": f"""
    SELECT campaign_id, {_TRAITS}, {_FUNNEL}, {_TWO_RATES}, spend AS total_spend,
           revenue AS total_revenue, profit AS total_profit
    FROM campaign_period""",
    "apps_by_revenue": _period(
        "app_id, app_name, publisher_name, category, platform",
        "app_period",
        _TWO_RATES,
        _APP_MONEY,
    ),
    "publisher_performance": _period(
        "publisher_id, publisher_name, publisher_country",
        "app_period",
        _TWO_RATES,
        _APP_MONEY,
    ),
    "country_platform_performance": _period(
        "target_country, target_platform", "campaign_period", _RATES, _SPEND
    ),
    "category_performance": _period("category", "app_period", _TWO_RATES, _APP_MONEY),
    "volume_requests": f"""
    SELECT count(*) AS generated_ad_requests FROM ad_requests WHERE {SCOPE}""",
    "volume_events": f"""
    SELECT count(*) AS generated_events FROM events_raw WHERE {SCOPE}""",
    "event_type_distribution": f"""
    SELECT event_type, count(*) AS event_count FROM events_raw WHERE {SCOPE} GROUP BY 1""",
    **_QUALITY_ALERTS,
    "dq_alerts_all": "SELECT *, false AS is_resolved FROM quality_alerts",
    "dq_alerts_listing": "SELECT *, false AS is_resolved FROM quality_alerts",
    **{f"val_{name}": sql for name, sql in _ERRORS.items()},
    "validation_errors": "SELECT * FROM event_validation_errors",
    "events_clean": "SELECT * FROM events_clean",
    "pipeline_counts": """
    SELECT (SELECT count(*) FROM events_raw) AS raw_events,
           (SELECT count(*) FROM events_clean) AS clean_events,
           (SELECT count(DISTINCT raw_event_id) FROM event_validation_errors)
               AS rejected_raw_events""",
    "validation_error_summary": _ERROR_SUMMARY,
    "clean_event_distribution": """
    SELECT event_type, count(*) AS clean_event_count FROM events_clean GROUP BY 1""",
    "check_clean_duplicates": """
    SELECT event_id, count(*) AS duplicate_count FROM events_clean
    GROUP BY 1 HAVING count(*) > 1""",
    "check_clean_orphans": """
    SELECT event_id, tracking_id FROM events_clean e
    WHERE NOT EXISTS (SELECT 1 FROM ad_requests q WHERE q.tracking_id = e.tracking_id)""",
    "check_daily_campaign_rows": """
    SELECT count(*) AS daily_campaign_metric_rows FROM daily_campaign_metrics""",
    "check_daily_app_rows": """
    SELECT count(*) AS daily_app_metric_rows FROM daily_app_metrics""",
    "check_null_kpis": """
    SELECT count(*) AS rows_with_null_campaign_kpis FROM daily_campaign_metrics
    WHERE ctr + install_rate + conversion_rate + ecpm IS NULL""",
    "experiment_assignment": f"""
    SELECT experiment_id, experiment_name, variant, algorithm_name,
           count(*) AS ad_requests
    FROM ad_requests JOIN experiments USING (experiment_id) WHERE {SCOPE} GROUP BY ALL""",
    "experiment_kpi": f"""
    SELECT variant, algorithm_name, {_ARM_KPIS}
    FROM ({_arms('x.variant, x.algorithm_name')})""",
    "experiment_results": "SELECT * FROM experiment_results",
    "experiment_uplift": _uplift(),
    "experiment_daily_trend": _ARM_TREND,
    **_MONITORING_ALERTS,
    "monitoring_alerts": "SELECT *, false AS is_resolved FROM monitoring_alerts",
    "overview_totals": _OVERVIEW,
    "overview_tiles": f"""
    SELECT CAST(impressions AS VARCHAR) AS impressions, CAST(clicks AS VARCHAR) AS clicks,
           CAST(installs AS VARCHAR) AS installs, CAST(revenue AS VARCHAR) AS revenue,
           CAST(profit AS VARCHAR) AS profit,
           {_percent('clicks', 'impressions')} AS ctr,
           {_percent('installs', 'clicks')} AS install_rate,
           {_percent('conversions', 'installs')} AS conversion_rate
    FROM ({_OVERVIEW})""",
    "campaign_performance": _CAMPAIGN_PERFORMANCE,
    "app_performance": _APP_PERFORMANCE,
    "chart_campaign_money": "SELECT campaign_name, revenue, spend, profit FROM campaign_period",
    "chart_app_money": "SELECT app_name, revenue, reward_cost FROM app_period",
    "experiment_view": """
    SELECT * EXCLUDE (experiment_name, rewards, impression_rate) FROM experiment_results""",
    "experiment_uplift_view": f"""
    SELECT baseline_variant, test_variant, baseline_algorithm, test_algorithm,
           ctr_lift_percent, install_rate_lift_percent, conversion_rate_lift_percent,
           revenue_delta, spend_delta, profit_delta, ecpm_delta,
           'Variant B improved CTR by ' || {text('CAST(ctr_lift_percent AS DECIMAL(18,2))')}
           || '%, install rate by '
           || {text('CAST(install_rate_lift_percent AS DECIMAL(18,2))')}
           || '%, conversion rate by '
           || {text('CAST(conversion_rate_lift_percent AS DECIMAL(18,2))')}
           || '%, with a profit delta of ' || {_money_text('profit_delta')} || '.' AS summary
    FROM ({_uplift()})""",
    "alerts_view": "SELECT * FROM alerts",
    "alert_summary": """
    SELECT alert_type, severity, count(*) AS alert_count FROM alerts GROUP BY ALL""",
    "validation_summary_view": _ERROR_SUMMARY,
    "rejected_events_view": "SELECT * FROM event_validation_errors",
    "constraint_audit": _constraint_audit(),
    "scoped_purge": f"""
    SELECT 'event_validation_errors' AS table_name, count(*) AS survivors
    FROM event_validation_errors
    WHERE raw_event_id NOT IN (SELECT raw_event_id FROM events_raw WHERE {_DOOMED})
    UNION ALL
    SELECT 'events_clean', count(*) FROM events_clean WHERE {_DOOMED} IS NOT TRUE
    UNION ALL
    SELECT 'events_raw', count(*) FROM events_raw WHERE {_DOOMED} IS NOT TRUE
    UNION ALL
    SELECT 'ad_requests', count(*) FROM ad_requests
    WHERE NOT starts_with(tracking_id, 'trk_py_1')""",
    "eligible_inventory": """
    SELECT campaign_id, target_country, target_platform, target_category, bid_cpi,
           (SELECT count(*) FROM apps a WHERE a.category = c.target_category
              AND a.platform = c.target_platform) AS eligible_apps,
           (SELECT count(*) FROM users u WHERE u.country = c.target_country
              AND u.platform = c.target_platform) AS eligible_users
    FROM campaigns c WHERE status = 'active'""",
}

_THREE = ("ctr", "install_rate", "conversion_rate")
_TWO = ("ctr", "install_rate")
_DAILY = (*_THREE, "spend", "revenue", "profit", "ecpm")
_KPI = ("bid_cpi", *_DAILY, "reward_cost")
_ARM = (*_DAILY, "reward_cost", "impression_rate")
_APP_TOTALS = (*_TWO, "total_revenue", "total_reward_cost")
_CAMPAIGN_TOTALS = ("total_spend", "total_revenue", "total_profit")
_LIFTS = tuple(f"{name}_lift_percent" for name in _THREE)
_DELTAS = tuple(f"{name}_delta" for name in ("revenue", "spend", "profit", "ecpm"))
_SIDES = tuple(f"{side}_{name}" for side in "ab" for name in _DAILY)

# Exact decimals shown as DOUBLE once they are rounded, per query.
_DOUBLES: dict[str, tuple[str, ...]] = {
    "funnel_by_tracking": _APP_MONEY,
    "campaign_kpi": _KPI,
    "campaign_kpi_nullable_ecpm": _KPI,
    "daily_campaign_metrics_raw": _DAILY,
    "daily_campaign_metrics": _DAILY,
    "daily_app_metrics_raw": _APP_MONEY,
    "daily_app_metrics": _APP_MONEY,
    "daily_app_overview": _APP_MONEY,
    "daily_campaign_by_profit": _DAILY,
    "daily_campaign_overview": _DAILY,
    "campaigns_best": (*_THREE, *_CAMPAIGN_TOTALS, "ecpm"),
    "campaigns_worst": (*_TWO, *_CAMPAIGN_TOTALS),
    "apps_by_revenue": _APP_TOTALS,
    "publisher_performance": _APP_TOTALS,
    "country_platform_performance": (*_THREE, *_CAMPAIGN_TOTALS),
    "category_performance": _APP_TOTALS,
    "events_clean": _APP_MONEY,
    "experiment_kpi": _ARM,
    "experiment_results": _ARM,
    "experiment_uplift": (*_SIDES, *_LIFTS, *_DELTAS),
    "experiment_daily_trend": (*_TWO, *_SPEND),
    "overview_totals": (*_THREE, *_SPEND),
    "campaign_performance": _DAILY,
    "app_performance": (*_TWO, *_APP_MONEY),
    "chart_campaign_money": _SPEND,
    "chart_app_money": _APP_MONEY,
    "experiment_view": (*_DAILY, "reward_cost"),
    "experiment_uplift_view": (*_LIFTS, *_DELTAS),
    "eligible_inventory": ("bid_cpi",),
}

# Days and times shown as ISO text, per query.
_DAY, _SECOND = "%Y-%m-%d", "%Y-%m-%d %H:%M:%S"
_STAMPS: dict[str, tuple[str, str]] = {
    "daily_campaign_metrics_raw": ("metric_date", _DAY),
    "daily_campaign_metrics": ("metric_date", _DAY),
    "daily_app_metrics_raw": ("metric_date", _DAY),
    "daily_app_metrics": ("metric_date", _DAY),
    "daily_app_overview": ("metric_date", _DAY),
    "daily_campaign_by_profit": ("metric_date", _DAY),
    "daily_campaign_overview": ("metric_date", _DAY),
    "experiment_daily_trend": ("request_date", _DAY),
    "events_clean": ("event_time", _SECOND),
}


def _portable(name: str, body: str) -> str:
    """The body with its decimals, days and times in engine-neutral types."""
    shown = [f"CAST({c} AS DOUBLE) AS {c}" for c in _DOUBLES.get(name, ())]
    if name in _STAMPS:
        column, pattern = _STAMPS[name]
        shown.append(f"strftime({column}, '{pattern}') AS {column}")
    star = f"* REPLACE ({', '.join(shown)})" if shown else "*"
    return f"SELECT {star} FROM ({body})"


def _with_steps(body: str) -> str:
    """The body after the steps it needs, directly or through other steps."""
    needed: list[str] = []
    seen = body
    for name in reversed(_STEPS):
        if re.search(rf"\b{name}\b", seen):
            needed.insert(0, f"{name} AS ({_STEPS[name]})")
            seen += _STEPS[name]
    return f"WITH {',\n'.join(needed)}\n{body}"


def oracle_queries() -> dict[str, str]:
    return {name: _with_steps(_portable(name, body)) for name, body in _BODIES.items()}
