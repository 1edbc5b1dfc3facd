"""Reference SQL (DuckDB) for the registered queries, on the same tables.

Each text states a result directly from the tables, not by the steps the operator takes:
percentiles by ``quantile_cont``, replays by ordered windows over whole series, ingest rows
straight from the events that the payloads were built from.
"""

from __future__ import annotations

from rentscope.operators.series import FEATURES
from rentscope.registry import fixtures as fx
from rentscope.registry import queries as q

_COMMON = f"""
WITH offers AS ({fx.OFFERS_SQL}),
snapshots AS ({fx.SNAPSHOTS_SQL}),
now AS (SELECT max(captured_at) AS as_of FROM offers)
"""


def _r(x: str, digits: int = 4) -> str:
    """Round half up on decimals, as the operators do after dropping float noise."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, 9)), {digits}) AS DOUBLE)"


def _sum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


_PRIOR = "CASE lower(provider) WHEN 'vast' THEN 0.20 WHEN 'runpod' THEN 0.05 WHEN 'akash' THEN 0.10 WHEN 'spheron' THEN 0.02 ELSE 0.15 END"

_STATS = f"""
stats AS (
  SELECT gpu_name, provider, count(*) AS n,
    {_r('quantile_cont(price_per_gpu_hr, 0.1)', 6)} AS p10,
    {_r('quantile_cont(price_per_gpu_hr, 0.5)', 6)} AS p50,
    {_r('quantile_cont(price_per_gpu_hr, 0.9)', 6)} AS p90,
    {_r('avg(price_per_gpu_hr)', 6)} AS mean,
    {_r('stddev_samp(price_per_gpu_hr) / avg(price_per_gpu_hr)')} AS volatility
  FROM offers WHERE price_per_gpu_hr > 0 GROUP BY 1, 2 HAVING count(*) >= 3),
avail AS (
  SELECT gpu_name, provider,
    {_r('count(DISTINCT CASE WHEN price_per_gpu_hr IS NOT NULL THEN snapshot_id END) / (SELECT count(finished_at) FROM snapshots)')} AS availability
  FROM offers GROUP BY 1, 2),
intr AS (
  SELECT provider, CASE WHEN count(price_per_gpu_hr) < 10 THEN CAST({_PRIOR} AS DOUBLE)
    ELSE {_r(f'0.7 * {_PRIOR} + 0.3 * count(CASE WHEN interruptible = 1 THEN price_per_gpu_hr END) / count(price_per_gpu_hr)')} END
    AS interruption_probability
  FROM offers GROUP BY provider)
"""


def _windows(listed: str = "price_per_gpu_hr IS NOT NULL", having: str = "TRUE") -> str:
    return f"""
    {_STATS},
    windows AS (
      SELECT s.provider, s.gpu_name AS gpu_class, v.vram_gb, p10 AS price_per_gpu_hour_p10,
        p50 AS price_per_gpu_hour_p50, p90 AS price_per_gpu_hour_p90, volatility AS price_volatility,
        availability AS availability_probability, interruption_probability, n AS n_price_samples
      FROM stats s
      JOIN (SELECT gpu_name, provider, max(vram_gb) AS vram_gb FROM offers WHERE {listed} GROUP BY 1, 2) v
        ON s.gpu_name = v.gpu_name AND s.provider = v.provider
      JOIN avail a ON s.gpu_name = a.gpu_name AND s.provider = a.provider
      JOIN intr i ON s.provider = i.provider
      WHERE {having})
    """


_ALL_WINDOWS = _windows()

_CURRENT = """
current AS (
  SELECT o.* FROM offers o, now, (SELECT max(captured_at) AS newest FROM offers WHERE price_per_gpu_hr IS NOT NULL) m
  WHERE price_per_gpu_hr IS NOT NULL AND captured_at >= as_of - INTERVAL (
    CASE WHEN newest >= as_of - INTERVAL 4 HOUR THEN 4 WHEN newest >= as_of - INTERVAL 48 HOUR THEN 48 ELSE 9999 END) HOUR)
"""

_COMPARED = f"""
per_provider AS (
  SELECT gpu_name, provider, {_r('min(price_per_gpu_hr)')} AS min_price, {_r('avg(price_per_gpu_hr)')} AS avg_price,
    count(*) AS offer_count
  FROM current GROUP BY 1, 2),
compared AS (
  SELECT gpu_name, count(*) AS provider_count,
    first(provider ORDER BY avg_price, provider) FILTER (WHERE avg_price <> 0) AS cheapest_provider,
    min(avg_price) FILTER (WHERE avg_price <> 0) AS cheapest_price
  FROM per_provider GROUP BY gpu_name
  HAVING min(avg_price) FILTER (WHERE avg_price <> 0) IS NOT NULL
  ORDER BY provider_count DESC, gpu_name LIMIT %d)
"""

_BAND = """CASE WHEN {v} <= 0.05 THEN 'very low' WHEN {v} <= 0.15 THEN 'low' WHEN {v} <= 0.30 THEN 'medium'
  WHEN {v} <= 0.50 THEN 'high' ELSE 'very high' END"""

_EVERYONE = ["vast", "runpod", "akash", "spheron", "other"]
_MATRIX = f"""
SELECT *, coalesce(vast = least(vast, runpod, spheron), FALSE) AS vast_best,
  coalesce(runpod = least(vast, runpod, spheron), FALSE) AS runpod_best,
  coalesce(spheron = least(vast, runpod, spheron), FALSE) AS spheron_best
FROM (
  SELECT c.gpu_name, c.provider_count,
    max(CASE WHEN p.provider = 'vast' THEN avg_price END) AS vast,
    max(CASE WHEN p.provider = 'runpod' THEN avg_price END) AS runpod,
    max(CASE WHEN p.provider = 'spheron' THEN avg_price END) AS spheron
  FROM compared c JOIN per_provider p ON c.gpu_name = p.gpu_name GROUP BY 1, 2)
"""


def _report_oracles() -> dict[str, str]:
    p = "price_per_gpu_hr"
    found = {
        "price_summary": f"""{_COMMON}
            SELECT provider, gpu_name, count(DISTINCT snapshot_id) AS snapshots_seen, count(*) AS total_offers,
              {_r(f'min({p})')} AS all_time_min, {_r(f'avg({p})')} AS all_time_avg, {_r(f'max({p})')} AS all_time_max,
              {_r(f'avg(CASE WHEN interruptible = 1 THEN {p} END)')} AS avg_spot_price,
              {_r(f'avg(CASE WHEN interruptible = 0 THEN {p} END)')} AS avg_ondemand_price,
              min(captured_at) AS first_seen, max(captured_at) AS last_seen
            FROM offers GROUP BY 1, 2""",
        "gpu_history": f"""{_COMMON}
            SELECT max(captured_at) AS captured_at, provider, count(*) AS offers, {_r(f'min({p})')} AS min_price,
              {_r(f'avg({p})')} AS avg_price, {_r(f'max({p})')} AS max_price
            FROM offers WHERE gpu_name ILIKE '%{q.GPU_PATTERN}%'
            GROUP BY CAST(captured_at AS DATE), provider ORDER BY max(captured_at) DESC, provider""",
        "cheapest_offers": f"""{_COMMON}
            SELECT provider, gpu_name, gpu_name_raw, gpu_count, vram_gb, {p}, price_total_hr, interruptible,
              reliability_score, geography, date_trunc('hour', captured_at) AS captured_at
            FROM offers, now
            WHERE date_trunc('hour', captured_at) >= date_trunc('hour', as_of) AND vram_gb >= {q.MIN_VRAM}
            ORDER BY {p} NULLS FIRST, id LIMIT 30""",
        "budget_windows": f"""{_COMMON}
            SELECT provider, gpu_name, count(*) AS qualifying_offers,
              count(DISTINCT CAST(captured_at AS DATE)) AS days_with_offers, {_r(f'min({p})')} AS cheapest_seen,
              {_r(f'avg({p})')} AS avg_when_cheap, min(captured_at) AS first_window, max(captured_at) AS last_window
            FROM offers WHERE {p} <= {q.BUDGET} AND interruptible = 1 GROUP BY 1, 2""",
        "price_volatility": f"""{_COMMON}
            SELECT provider, gpu_name, count(DISTINCT snapshot_id) AS snapshots, {_r(f'avg({p})')} AS mean_price,
              {_r(f'coalesce(sqrt(greatest(avg({p} * {p}) - avg({p}) * avg({p}), 0)), 0)')} AS std_dev,
              {_r(f'min({p})')} AS p0, {_r(f'max({p})')} AS p100
            FROM offers WHERE interruptible = 1 GROUP BY 1, 2 HAVING count(DISTINCT snapshot_id) >= 3""",
        "offer_windows": f"""{_COMMON}
            SELECT snapshot_id || '_' || provider || '_' || gpu_name || '_' || id AS window_id, provider,
              gpu_name AS gpu_class, captured_at AS start_time, {p} AS price_per_gpu_hour_p50,
              {_r(f'coalesce({p}, 0) * 1.25', 6)} AS price_per_gpu_hour_p90,
              CAST(coalesce(nullif(reliability_score, 0), 0.6) AS DOUBLE) AS availability_probability,
              CAST(CASE WHEN interruptible <> 0 THEN 0.15 ELSE 0.02 END AS DOUBLE) AS interruption_probability
            FROM offers""",
        "db_stats": f"""{_COMMON}
            SELECT (SELECT count(*) FROM snapshots) AS total_snapshots, (SELECT count(*) FROM offers) AS total_offers,
              (SELECT min(started_at) FROM snapshots) AS oldest_snapshot,
              (SELECT max(started_at) FROM snapshots) AS latest_snapshot""",
        "price_stats": f"{_COMMON}, {_STATS} SELECT gpu_name, provider, n AS n_samples, p10, p50, p90, mean, volatility FROM stats",
        "availability_score": f"{_COMMON}, {_STATS} SELECT * FROM avail",
        "interruption_probability": f"{_COMMON}, {_STATS} SELECT * FROM intr",
        "provider_windows": f"{_COMMON}, {_ALL_WINDOWS} SELECT * FROM windows",
        "provider_windows_filtered": f"""{_COMMON},
            {_windows(f'{p} IS NOT NULL AND vram_gb >= {q.MIN_VRAM}', f'p50 <= {q.WINDOW_BUDGET}')} SELECT * FROM windows""",
        "provider_windows_file": f"{_COMMON}, {_ALL_WINDOWS} SELECT * FROM windows",
        "snapshot_summary": f"""{_COMMON}
            SELECT provider, gpu_name, count(*) AS offers, {_r(f'min({p})')} AS min_p, {_r(f'avg({p})')} AS avg_p,
              {_r(f'max({p})')} AS max_p, {_sum('interruptible')} AS spot
            FROM offers WHERE snapshot_id = '{q.ONE_RUN}' GROUP BY 1, 2""",
        "latest_snapshot": f"""{_COMMON}
            SELECT * FROM offers WHERE snapshot_id = (
              SELECT snapshot_id FROM snapshots ORDER BY started_at DESC, snapshot_id DESC LIMIT 1)""",
        "run_log": f"""{_COMMON}
            SELECT s.snapshot_id, started_at, finished_at,
              count(*) FILTER (WHERE provider = 'vast') AS vast_offers,
              count(*) FILTER (WHERE provider = 'runpod') AS runpod_offers,
              count(*) FILTER (WHERE provider = 'akash') AS akash_offers,
              count(*) FILTER (WHERE provider = 'spheron') AS spheron_offers, count(o.id) AS all_offers
            FROM snapshots s LEFT JOIN offers o ON s.snapshot_id = o.snapshot_id GROUP BY 1, 2, 3""",
        "run_report": f"""{_COMMON}
            , run AS (SELECT snapshot_id, finished_at FROM snapshots ORDER BY started_at DESC, snapshot_id DESC LIMIT 1)
            SELECT o.snapshot_id, provider, count(*) AS cnt,
              coalesce(strftime(max(run.finished_at), '%Y-%m-%d %H:%M'), '') AS finished_at, '' AS errors,
              (SELECT count(finished_at) FROM snapshots) AS total_snapshots, (SELECT count(*) FROM offers) AS total_rows
            FROM offers o JOIN run ON o.snapshot_id = run.snapshot_id GROUP BY 1, 2""",
        "stats_overview": f"""{_COMMON}
            SELECT count(DISTINCT snapshot_id) AS snapshots, count(*) AS rows, count(DISTINCT provider) AS providers,
              CAST(min(captured_at) AS DATE) AS since, CAST(max(captured_at) AS DATE) AS latest FROM offers""",
        "provider_coverage": f"""{_COMMON}
            SELECT provider, count(DISTINCT gpu_name) AS gpu_types, count(*) AS offers
            FROM offers, now WHERE captured_at >= as_of - INTERVAL 48 HOUR GROUP BY provider""",
        "cheapest_by_provider": f"""{_COMMON}
            SELECT provider, gpu_name, {_r(f'min({p})')} AS min_price FROM offers, now
            WHERE {p} IS NOT NULL AND captured_at >= as_of - INTERVAL 48 HOUR
            GROUP BY 1, 2""",
        "cheapest_per_provider": f"""{_COMMON}
            SELECT * FROM (
              SELECT provider, gpu_name, {_r(f'min({p})')} AS min_price FROM offers, now
              WHERE {p} IS NOT NULL AND captured_at >= as_of - INTERVAL 48 HOUR GROUP BY 1, 2)
            QUALIFY row_number() OVER (PARTITION BY provider ORDER BY min_price, gpu_name) <= 3""",
        "dataset_stats": f"""{_COMMON}
            SELECT count(DISTINCT snapshot_id) AS total_snapshots, count(*) AS total_rows,
              count(DISTINCT provider) AS providers, max(captured_at) AS last_updated,
              greatest(1, datediff('second', min(captured_at), max(captured_at)) // 86400 + 1) AS days_of_data
            FROM offers""",
        "price_comparison": f"""{_COMMON}, {_CURRENT}, {_COMPARED % 20}
            SELECT c.gpu_name, cheapest_provider, cheapest_price, provider_count, provider, min_price, avg_price, offer_count
            FROM compared c JOIN per_provider p ON c.gpu_name = p.gpu_name""",
        "price_matrix": f"{_COMMON}, {_CURRENT}, {_COMPARED % 12} {_MATRIX}",
        "price_matrix_all": f"""{_COMMON}, {_CURRENT}, {_COMPARED % 1000000}
            SELECT gpu_name, provider_count, {', '.join(f"max(CASE WHEN provider = '{x}' THEN avg_price END) AS {x}" for x in _EVERYONE)},
              {', '.join(f"coalesce(max(CASE WHEN provider = '{x}' THEN avg_price END) = min(avg_price), FALSE) AS {x}_best" for x in _EVERYONE)}
            FROM compared JOIN per_provider USING (gpu_name) GROUP BY 1, 2""",
        "price_matrix_late": f"""{_COMMON.replace('max(captured_at) AS as_of', 'max(captured_at) + INTERVAL 24 HOUR AS as_of')},
            {_CURRENT}, {_COMPARED % 12} {_MATRIX}""",
        "volatility_rollup": f"""{_COMMON}, {_ALL_WINDOWS}
            SELECT gpu_class, {_r('avg(price_volatility)')} AS avg_volatility, {_r('max(price_volatility)')} AS max_volatility,
              string_agg(provider, ',' ORDER BY price_per_gpu_hour_p50, provider) AS providers,
              {_BAND.format(v=_r('avg(price_volatility)'))} AS avg_band, {_BAND.format(v=_r('max(price_volatility)'))} AS max_band
            FROM windows GROUP BY 1""",
        "spread_alerts": f"""{_COMMON}, {_CURRENT}, {_ALL_WINDOWS}, {_ALERTS} SELECT * FROM alerts""",
        "budget_options": f"{_COMMON}, {_ALL_WINDOWS} {_OPTIONS}",
        "budget_cost": f"""{_COMMON}, {_ALL_WINDOWS}, options AS ({_OPTIONS})
            SELECT provider, gpu_class, {_r('price_p50')} AS price_p50, {_r('price_p50 * 8', 2)} AS total_cost,
              CAST(round(availability * 100) AS BIGINT) AS availability_pct,
              CASE WHEN round(availability * 100) >= 70 THEN 'green' WHEN round(availability * 100) >= 40 THEN 'yellow'
                ELSE 'red' END AS availability_light,
              {_r('volatility', 3)} AS volatility, {_BAND.format(v='volatility')} AS volatility_band,
              greatest((SELECT count(*) FROM options) - 10, 0) AS more_options
            FROM options ORDER BY options.price_p50, gpu_class, provider LIMIT 10""",
        "volatility_band": f"""{_COMMON}, {_ALL_WINDOWS}
            SELECT provider, gpu_class, price_volatility, {_BAND.format(v='price_volatility')} AS volatility_band FROM windows""",
    }
    # The views with a limit: the first rows of the whole results above.
    found["gpu_history_newest"] = f"SELECT * FROM ({found['gpu_history']}) ORDER BY captured_at DESC, provider LIMIT 100"
    found["offer_windows_newest"] = found["offer_windows"] + " ORDER BY captured_at DESC, id DESC LIMIT 5000"
    found["cheapest_by_provider_first"] = found["cheapest_by_provider"] + " ORDER BY provider, min_price, gpu_name LIMIT 15"
    return found


_ALERTS = f"""
lowest AS (SELECT gpu_name, provider, min(price_per_gpu_hr) AS price FROM current GROUP BY 1, 2),
gaps AS (
  SELECT gpu_name, max(price) - min(price) AS gap, min(price) AS low, max(price) AS high,
    first(provider ORDER BY price, provider) AS cheapest, first(provider ORDER BY price DESC, provider) AS priciest
  FROM lowest GROUP BY 1 HAVING count(*) >= 2 AND max(price) - min(price) >= 0.005),
usual AS (
  SELECT gpu_class, count(*) AS known, max(price_per_gpu_hour_p50) - min(price_per_gpu_hour_p50) AS usual_gap
  FROM windows GROUP BY 1),
alerts AS (
  SELECT g.gpu_name, {_r('gap')} AS spread, cheapest AS cheapest_provider, {_r('low')} AS cheapest_price,
    priciest AS priciest_provider, {_r('high')} AS priciest_price, {_r('gap * 100', 2)} AS savings_per_100h,
    CASE WHEN known >= 2 THEN gap > usual_gap * 1.5 AND gap > 0.05 ELSE gap / high > 0.15 END AS is_alert,
    l.provider, {_r('l.price')} AS price
  FROM gaps g JOIN lowest l ON g.gpu_name = l.gpu_name LEFT JOIN usual u ON g.gpu_name = u.gpu_class)
"""

_OPTIONS = f"""
SELECT provider, gpu_class, price_per_gpu_hour_p50 AS price_p50, price_per_gpu_hour_p10 AS price_p10,
  availability_probability AS availability, price_volatility AS volatility,
  {_r(f'{q.WINDOW_BUDGET} - price_per_gpu_hour_p50')} AS savings_vs_budget, n_price_samples AS n_samples
FROM windows WHERE price_per_gpu_hour_p50 <= {q.WINDOW_BUDGET}
"""

# Fixed values repeated here as the results must equal them: priors, bands, static prices.
# Labels of the raw fixture names; a null name in a listing becomes ''.
_RUN = "strftime(date_trunc('hour', ts), 'snap_%Y%m%d_%H%M%S_%g') AS snapshot_id, date_trunc('hour', ts) AS captured_at"


def _label(name: str) -> str:
    rules = [
        ("NVIDIA H100 SXM5 80GB", "H100_SXM"), ("NVIDIA H100 PCIe", "H100_PCIE"), ("GeForce RTX 4090", "RTX_4090"),
        ("RTX A4000", "A40"), ("RTX A6000", "RTX_A6000"), ("Tesla V100-PCIE-16GB", "V100"),
        ("A100-SXM4-80GB", "A100_80GB"), ("NVIDIA GH200", "H200"),
    ]
    cases = " ".join(f"WHEN '{raw}' THEN '{label}'" for raw, label in rules)
    return f"""CASE {name} {cases} WHEN 'T4' THEN 'T4' ELSE 'UNKNOWN' END"""


def _rows(provider: str, offer_id: str, raw: str, label: str, count: str, vram: str, price: str, total: str,
          spot: str, reliability: str, place: str, down: str, extra: str, absent: str = "NULL") -> str:
    return f"""SELECT {_RUN}, '{provider}' AS provider, {offer_id} AS offer_id, {label} AS gpu_name, {raw} AS gpu_name_raw,
      CAST({count} AS INTEGER) AS gpu_count, CAST({vram} AS DOUBLE) AS vram_gb, CAST({price} AS DOUBLE) AS price_per_gpu_hr,
      CAST({total} AS DOUBLE) AS price_total_hr, CAST({spot} AS INTEGER) AS interruptible,
      CAST({reliability} AS DOUBLE) AS reliability_score, {place} AS geography, CAST({down} AS DOUBLE) AS inet_down_mbps,
      CAST({absent} AS DOUBLE) AS inet_up_mbps, CAST({absent} AS DOUBLE) AS disk_space_gb,
      CAST({absent} AS DOUBLE) AS gpu_utilization_pct, {extra} AS extra_json"""


def _json(**fields: str) -> str:
    """A JSON object as the readers write it; values are SQL that gives JSON text."""
    return "'{' || " + " || ',' || ".join(f"""'"{k}":' || {v}""" for k, v in fields.items()) + " || '}'"


def _json_text(x: str) -> str:
    return f"""'"' || {x} || '"'"""


def _json_number(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'null')"


_MARKET = f"""
{_rows('vast', 'id', "coalesce(gpu_name, '')", _label('gpu_name'), 'coalesce(nullif(num_gpus, 0), 1)',
       'coalesce(gpu_ram, 0) / 1024', _r('coalesce(dph_total, 0) / coalesce(nullif(num_gpus, 0), 1)', 6),
       'coalesce(dph_total, 0)', '1', 'coalesce(reliability2, 0)', 'geolocation', 'coalesce(inet_down, 0)',
       _json(machine_id='machine_id', cuda_vers="'null'", compute_cap="'null'", verified='CAST(verified AS VARCHAR)'), '0')}
FROM ({fx.MARKET_ITEMS_SQL})
"""


def _types(kind: str, price: str, spot: int) -> str:
    name = "coalesce(nullif(display_name, ''), id)"
    label = f"CASE WHEN display_name = '' THEN upper(id) ELSE {_label('display_name')} END"
    return f"""
    {_rows('runpod', f"id || '_{kind}'", name, label, '1', 'memory_gb', price, price, str(spot), 'NULL',
           'CAST(NULL AS VARCHAR)', 'NULL',
           _json(gpu_id=_json_text('id'), secure_cloud='CAST(secure_cloud AS VARCHAR)', community_cloud="'null'"))}
    FROM ({fx.GPU_TYPE_ITEMS_SQL}) WHERE {price} IS NOT NULL"""


_GPU_TYPES = f"{_types('spot', 'bid', 1)} UNION ALL {_types('ondemand', 'on_demand', 0)}"

_MONTHLY_PRICE = _r("coalesce(nullif(mid, 0), low) / 730", 6)
_SIZE = "CASE ram WHEN '80Gi' THEN 80 * 1.073741824 WHEN '24G' THEN 24 WHEN '16384Mi' THEN 16384 * 0.001048576 WHEN '48 GB' THEN 48 ELSE 0 END"
_MONTHLY = f"""
{_rows('akash', "'akash_' || gpu || '_' || ram", "gpu || ' ' || ram || ' ' || interface", _label('gpu'), '1', _SIZE,
       _MONTHLY_PRICE, _MONTHLY_PRICE, '1', 'NULL', 'CAST(NULL AS VARCHAR)', 'NULL',
       _json(price_min_monthly=_json_number('low'), price_avg_monthly=_json_number('mid'), price_max_monthly="'null'",
             interface=_json_text('interface'), source=_json_text("'akash_console_prices'")))}
FROM ({fx.MONTHLY_ITEMS_SQL}) WHERE coalesce(nullif(mid, 0), low) IS NOT NULL
"""

_LEASE_PRICE = _r("nullif(monthly, 0) / 730", 6)
_PROVIDERS = f"""
{_rows('akash', "'akash_prov_' || owner[1:16] || '_' || model[1:20]", 'model', _label('model'), '1', 'NULL', _LEASE_PRICE,
       _LEASE_PRICE, '1', 'uptime / 100', "CASE WHEN place_key = 'Country' THEN place ELSE region END",
       'TRY_CAST(speed AS DOUBLE)',
       _json(owner=_json_text('owner'), host_uri="'null'", active_leases='lease_count', audited="'null'",
             source=_json_text("'akash_provider_list'")))}
FROM (
  SELECT *, attr_model AS model FROM ({fx.PROVIDER_ITEMS_SQL})
  UNION ALL SELECT *, cap_model FROM ({fx.PROVIDER_ITEMS_SQL}) WHERE cap_model <> '' AND cap_model <> attr_model)
"""


def _prices(od: str, sp: str, where: str, source: str, vram: str = "coalesce(nullif(vram, 0), memory_gb)") -> str:
    def part(kind: str, price: str, spot: int) -> str:
        return f"""
        {_rows('spheron', f"'spheron_' || gpu || '_{kind}'", 'gpu', _label('gpu'), '1', vram, price, price, str(spot), '0.99',
               "'multi-region'", 'NULL', _json(source=_json_text(f"'{source}'")))}
        FROM ({fx.PRICE_ITEMS_SQL}) WHERE coalesce({price}, 0) <> 0 AND {where}"""

    return f"{part('od', od, 0)} UNION ALL {part('spot', sp, 1)}"


def _list(where: str) -> str:
    return _prices("coalesce(nullif(on_demand_price, 0), nullif(hourly_price, 0))", "spot_price", where, "spheron_api")


_PAGE = _prices("coalesce(nullif(hourly_price, 0), nullif(on_demand_price, 0))", "spot_price", "kind <= 1", "spheron_html")

_STATIC = "(VALUES " + ", ".join(
    f"('{gpu}', {vram}, {price}, {spot}, '{kind}')"
    for gpu, vram, od, sp in [
        ("RTX_4090", 24, 0.49, 0.20), ("L40S", 48, 0.86, 0.35), ("A100_80GB", 80, 1.07, 0.60), ("H100_PCIE", 80, 2.01, 0.80),
        ("H100_SXM", 80, 2.49, 1.10), ("H200", 141, 3.20, 1.45), ("B200", 192, 6.02, 2.12), ("B300", 288, 6.80, 2.45),
    ]
    for price, spot, kind in [(od, 0, "od"), (sp, 1, "spot")]
) + ") s(gpu, vram, price, spot, kind)"


def _static(where: str) -> str:
    runs = f"(SELECT DISTINCT date_trunc('hour', ts) AS ts FROM ({fx.PRICE_ITEMS_SQL}) WHERE {where})"
    return f"""
    {_rows('spheron', "'spheron_' || gpu || '_' || kind", 'gpu', 'gpu', '1', 'vram', 'price', 'price', 'spot', '0.99',
           "'multi-region'", 'NULL', _json(source=_json_text("'static_fallback_2026-04-15'")))}
    FROM {runs}, {_STATIC}"""


_FIRST_SOURCE = f"""
SELECT * FROM (
  SELECT *, 0 AS prio, 'spheron_api' AS source FROM ({_list('kind = 0')})
  UNION ALL SELECT *, 1, 'spheron_html' FROM ({_PAGE})
  UNION ALL SELECT *, 2, 'static_fallback_2026-04-15' FROM ({_static('TRUE')}))
QUALIFY rank() OVER (PARTITION BY snapshot_id ORDER BY prio) = 1
"""
_SPHERON = f"SELECT * EXCLUDE (prio, source) FROM ({_FIRST_SOURCE})"
_ALL_INGESTED = f"{_MARKET} UNION ALL {_GPU_TYPES} UNION ALL {_MONTHLY} UNION ALL {_PROVIDERS} UNION ALL {_SPHERON}"


_COLLECTED = f"""
WITH offers AS ({_ALL_INGESTED}),
snapshots AS (SELECT DISTINCT snapshot_id, captured_at AS started_at, captured_at AS finished_at FROM (SELECT {_RUN} FROM events))
"""


def _ingest_oracles() -> dict[str, str]:
    page_row = """'page_' || page_id AS snapshot_id, TIMESTAMP '2024-01-01 00:00:00' AS captured_at, 'spheron' AS provider,
      'spheron_GPU ' || page_id % 7 || '_' || kind AS offer_id, 'GPU_' || page_id % 7 AS gpu_name,
      'GPU ' || page_id % 7 AS gpu_name_raw, CAST(1 AS INTEGER) AS gpu_count, CAST(page_id % 9 * 8 AS DOUBLE) AS vram_gb,
      price AS price_per_gpu_hr, price AS price_total_hr, CAST(spot AS INTEGER) AS interruptible,
      CAST(0.99 AS DOUBLE) AS reliability_score, 'multi-region' AS geography, CAST(NULL AS DOUBLE) AS inet_down_mbps,
      CAST(NULL AS DOUBLE) AS inet_up_mbps, CAST(NULL AS DOUBLE) AS disk_space_gb, CAST(NULL AS DOUBLE) AS gpu_utilization_pct,
      '{"source":"spheron_html"}' AS extra_json"""
    strip = "regexp_replace(upper(gpu_name_raw), '[ -]', '_', 'g')"
    return {
        "ingest_marketplace": _MARKET,
        "ingest_gpu_types": _GPU_TYPES,
        "ingest_monthly_prices": _MONTHLY,
        "ingest_provider_list": _PROVIDERS,
        "ingest_price_list": _list("TRUE"),
        "ingest_price_page": f"""
            SELECT {page_row} FROM (
              SELECT page_id, 'od' AS kind, 0 AS spot, (page_id % 50 + 1) / 10.0 AS price FROM pages WHERE page_id % 3 <> 0
              UNION ALL
              SELECT page_id, 'spot', 1, (page_id % 50 + 1) / 20.0 FROM pages WHERE page_id % 3 <> 0 AND page_id % 4 <> 0)""",
        "ingest_static_prices": _static("TRUE"),
        "first_nonempty_source": f"SELECT snapshot_id, source, count(*) AS rows FROM ({_FIRST_SOURCE}) GROUP BY 1, 2",
        "canonical_gpu_name": f"""
            SELECT gpu_name_raw, CASE WHEN known <> 'UNKNOWN' THEN known
              WHEN gpu_name_raw IS NULL OR gpu_name_raw = '' THEN 'UNKNOWN' ELSE {strip}[1:64] END AS gpu_name
            FROM (SELECT gpu_name_raw, {_label('gpu_name_raw')} AS known FROM (
              SELECT {fx.RAW_NAME} AS gpu_name_raw FROM events UNION SELECT p_name FROM part))""",
        "parse_size_gb": f"""
            SELECT event_id, {q.SIZE_TEXT} AS size, {_r('''CASE event_id % 8 WHEN 0 THEN 80 * 1.073741824 WHEN 1 THEN 24
              WHEN 2 THEN 16384 * 0.001048576 WHEN 3 THEN 0.512 WHEN 4 THEN 0 WHEN 5 THEN 48 WHEN 6 THEN 0
              ELSE user_id * 1.073741824 END''', 6)} AS gb FROM events""",
        "attribute_lookup": f"SELECT offer_id, geography, inet_down_mbps, inet_up_mbps FROM ({_PROVIDERS})",
        "deep_find": """
            SELECT event_id, CASE WHEN event_id % 3 = 2 THEN CAST(props ->> '$.k' AS VARCHAR) ELSE CAST(user_id AS VARCHAR) END
              AS found FROM events""",
        "collect_run": _ALL_INGESTED,
        "collect_log": f"""
            WITH runs AS (
              SELECT DISTINCT {_RUN}, CASE event_type WHEN 'view' THEN 'runpod' WHEN 'purchase' THEN 'spheron'
                WHEN 'error' THEN 'akash' ELSE 'vast' END AS provider, extract(hour FROM ts) % 3 = 2 AS down
              FROM events),
            counted AS (SELECT snapshot_id, provider, count(*) AS n FROM ({_ALL_INGESTED}) GROUP BY 1, 2),
            pages AS (
              SELECT snapshot_id, captured_at, r.provider, coalesce(n, 0) AS n, r.provider = 'spheron' AND down AS bad
              FROM runs r LEFT JOIN counted c USING (snapshot_id, provider))
            SELECT snapshot_id, min(captured_at) AS started_at, max(captured_at) AS finished_at, {_sum('n')} AS all_offers,
              {_sum("CASE WHEN provider = 'vast' THEN n ELSE 0 END")} AS vast_offers,
              {_sum("CASE WHEN provider = 'runpod' THEN n ELSE 0 END")} AS runpod_offers,
              {_sum("CASE WHEN provider = 'akash' THEN n ELSE 0 END")} AS akash_offers,
              {_sum("CASE WHEN provider = 'spheron' THEN n ELSE 0 END")} AS spheron_offers,
              coalesce(string_agg(CASE WHEN bad THEN 'spheron: unreadable' WHEN n = 0 THEN provider || ': no rows' END, ','
                ORDER BY provider), '') AS errors
            FROM pages GROUP BY snapshot_id""",
        "pipeline_windows": f"""{_COLLECTED}, {_ALL_WINDOWS} SELECT * FROM windows""",
        "pipeline_offer_windows": f"""{_COLLECTED}
            SELECT provider, gpu_name AS gpu_class, captured_at AS start_time, price_per_gpu_hr AS price_per_gpu_hour_p50,
              {_r('coalesce(price_per_gpu_hr, 0) * 1.25', 6)} AS price_per_gpu_hour_p90,
              CAST(coalesce(nullif(reliability_score, 0), 0.6) AS DOUBLE) AS availability_probability,
              CAST(CASE WHEN interruptible <> 0 THEN 0.15 ELSE 0.02 END AS DOUBLE) AS interruption_probability,
              (SELECT count(*) FROM offers) AS window_ids
            FROM offers""",
        "make_snapshot_id": "SELECT event_id, strftime(ts, 'snap_%Y%m%d_%H%M%S_%g') AS snapshot_id FROM events",
        "append_offers": f"""{_COMMON}
            SELECT *, CAST(captured_at AS DATE) AS capture_date FROM offers""",
        "stream_ingest": _ALL_INGESTED,
    }


_SPOT = f"""
spot AS ({fx.SPOT_SQL}),
points AS (
  SELECT * FROM spot WHERE product IN ('Linux/UNIX', '')
    AND regexp_matches(instance_type, '^(p2|p3|p4|g3|g4|g5|g6)[.]') AND price IS NOT NULL AND ts IS NOT NULL)
"""

# Each job on its own: from its start, the first point that ends a run of enough affordable points
# that all lie after the start; then counts and sums over the points from start to end.
_JOBS = f"""
{_SPOT},
zones AS (
  SELECT instance_type, az, count(*) AS total_windows, min(ts) AS first_ts, min(seq) AS first_seq FROM points GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY instance_type ORDER BY count(*) DESC, min(ts), min(seq)) = 1),
series AS (
  SELECT p.instance_type, max(total_windows) AS total_windows, list(price ORDER BY p.ts, p.seq) AS prices, list(p.ts ORDER BY p.ts, p.seq) AS times
  FROM points p JOIN zones z ON p.instance_type = z.instance_type AND p.az = z.az GROUP BY 1),
starts AS (
  SELECT instance_type, total_windows, times, i AS start_index, prices[i + 1:] AS ahead
  FROM series, range(0, total_windows - 1) r(i) WHERE i % STEP = 0),
found AS (
  SELECT * EXCLUDE (ahead), ahead,
    list_position(list_transform(range(1, len(ahead) + 1), lambda k: k >= {q.JOB_HOURS} AND
      list_max(ahead[k - {q.JOB_HOURS} + 1:k]) <= {q.JOB_BUDGET}), TRUE) AS elapsed
  FROM starts),
lived AS (
  SELECT *, CASE WHEN elapsed IS NULL THEN ahead ELSE ahead[1:elapsed] END AS seen FROM found),
broken AS (
  SELECT *, list_filter(range(2, len(seen) + 1), lambda k: seen[k] > {q.JOB_BUDGET} AND seen[k - 1] <= {q.JOB_BUDGET}) AS breaks FROM lived),
jobs AS (
  SELECT instance_type, total_windows, start_index, times[start_index + 1] AS submitted_at, elapsed IS NOT NULL AS completed,
    CAST(CASE WHEN elapsed IS NULL THEN 0 ELSE len(list_filter(seen, lambda x: x > {q.JOB_BUDGET})) END AS BIGINT) AS wait_hours,
    CAST(len(breaks) AS BIGINT) AS interruptions,
    coalesce(list_sum(list_filter(CASE WHEN elapsed IS NOT NULL THEN seen WHEN len(breaks) = 0 THEN [] ELSE seen[1:breaks[len(breaks)]] END,
      lambda x: x <= {q.JOB_BUDGET})), 0) AS cost,
    CAST(elapsed AS BIGINT) AS elapsed_hours
  FROM broken),
pooled AS (
  SELECT *, CASE WHEN completed THEN wait_hours + CASE WHEN interruptions = 0 THEN {q.JOB_HOURS} ELSE CAST(
    {q.JOB_HOURS} * sum(CASE WHEN completed THEN 1 ELSE 0 END) OVER (PARTITION BY instance_type ORDER BY start_index) AS BIGINT)
    END END AS elapsed_hours_pooled
  FROM jobs)
"""
_EVERY_JOB = _JOBS.replace("STEP", "1")


def _summary(elapsed: str) -> str:
    return f"""WITH {_EVERY_JOB},
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY instance_type ORDER BY {elapsed} NULLS LAST) - 1 AS rank,
        count({elapsed}) OVER (PARTITION BY instance_type) AS done FROM pooled),
    totals AS (
      SELECT instance_type, total_windows, {_sum('CASE WHEN completed THEN 1 ELSE 0 END')} AS completed_jobs,
        {_sum('interruptions')} AS interrupted_jobs, sum(wait_hours) AS wait, sum(cost) AS paid,
        max(CASE WHEN rank = CAST(floor(done * 0.5) AS BIGINT) THEN {elapsed} END) AS p50_completion_hours,
        max(CASE WHEN rank = CAST(floor(done * 0.9) AS BIGINT) THEN {elapsed} END) AS p90_completion_hours
      FROM ranked GROUP BY 1, 2)
    SELECT t.instance_type, z.az, t.total_windows, completed_jobs, interrupted_jobs,
      {_r('coalesce(completed_jobs / nullif(completed_jobs + interrupted_jobs, 0), 0)')} AS completion_rate,
      {_r('coalesce(interrupted_jobs / nullif(completed_jobs + interrupted_jobs, 0), 0)')} AS interruption_rate,
      {_r('coalesce(wait / nullif(completed_jobs + interrupted_jobs, 0), 0)')} AS avg_wait_hours,
      {_r('coalesce(paid / nullif(completed_jobs, 0), 0)')} AS avg_actual_cost, p50_completion_hours, p90_completion_hours
    FROM totals t JOIN zones z ON t.instance_type = z.instance_type"""


def _replay_oracles() -> dict[str, str]:
    jobs = f"""SELECT instance_type, total_windows, start_index, submitted_at, completed, wait_hours,
        interruptions, {_r('cost')} AS cost, elapsed_hours, elapsed_hours_pooled FROM pooled"""
    return {
        "spot_prices": f"""WITH {_SPOT} SELECT az, instance_type, price, ts, seq FROM points
            WHERE seq % 101 <> 0 AND seq % 103 <> 0 AND seq % 109 <> 0 AND seq % 113 <> 0""",
        "spot_archives": f"""WITH {_SPOT} SELECT az, instance_type, price, ts FROM points
            WHERE seq % 101 <> 0 AND seq % 103 <> 0 AND seq % 109 <> 0 AND seq % 113 <> 0""",
        "gpu_instance_filter": f"""WITH spot AS ({fx.SPOT_SQL}) SELECT az, instance_type, price, ts, seq FROM spot
            WHERE regexp_matches(instance_type, '^(p2|p3|p4|g3|g4|g5|g6)[.]')""",
        "densest_zone": f"WITH {_EVERY_JOB} SELECT instance_type, az, total_windows FROM zones",
        "spot_replay": f"WITH {_EVERY_JOB} {jobs}",
        "spot_replay_sampled": f"WITH {_JOBS.replace('STEP', 'greatest(1, total_windows // 200)')} {jobs}",
        "replay_summary": _summary("elapsed_hours_pooled"),
        "replay_all_types": _summary("elapsed_hours"),
        "gpu_types": f"""WITH spot AS ({fx.SPOT_SQL}) SELECT DISTINCT instance_type FROM spot
            WHERE regexp_matches(instance_type, '^(p2|p3|p4|g3|g4|g5|g6)[.]')""",
    }


_HOURLY = """
hourly AS (
  SELECT date_trunc('hour', captured_at) AS captured_at, provider, gpu_name, min(price_per_gpu_hr) AS price,
    count(*) AS offer_count
  FROM offers WHERE price_per_gpu_hr > 0 GROUP BY 1, 2, 3)
"""

_PARTS = """
sized AS (
  SELECT *, row_number() OVER s - 1 AS i, least(6, greatest(2, count(*) OVER (PARTITION BY provider, gpu_name) // 4)) AS w,
    avg(price) OVER (s ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS w2,
    avg(price) OVER (s ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS w3,
    avg(price) OVER (s ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS w4,
    avg(price) OVER (s ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS w5,
    avg(price) OVER (s ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS w6
  FROM hourly WINDOW s AS (PARTITION BY provider, gpu_name ORDER BY captured_at)),
trended AS (SELECT *, CASE w WHEN 2 THEN w2 WHEN 3 THEN w3 WHEN 4 THEN w4 WHEN 5 THEN w5 ELSE w6 END AS trend FROM sized),
parts AS (
  SELECT *, avg(price - trend) OVER (PARTITION BY provider, gpu_name, hour(captured_at)) AS seasonal FROM trended)
"""


def _decomposed(where: str) -> str:
    return f"""{_COMMON}, {_HOURLY}, {_PARTS}
    SELECT provider, gpu_name, {_r('regr_slope(trend, i)', 6)} AS trend_slope,
      {_r('least(1.0, stddev_samp(seasonal) / stddev_samp(price - trend))', 6)} AS seasonal_strength,
      {_r('stddev_samp(price - trend - seasonal)', 6)} AS noise_std
    FROM parts WHERE {where} GROUP BY 1, 2 HAVING count(*) >= 4"""


_OUTLOOK = f"""
ranked_hours AS (
  SELECT *, row_number() OVER (PARTITION BY provider, gpu_name ORDER BY captured_at DESC) AS back FROM hourly WHERE %s),
whole AS (
  SELECT provider, gpu_name, max(captured_at) AS last, avg(offer_count) AS mean,
    avg(CASE WHEN back <= 6 THEN offer_count END) AS recent FROM ranked_hours GROUP BY 1, 2 HAVING count(*) >= 3),
profile AS (SELECT provider, gpu_name, hour(captured_at) AS h, avg(offer_count) AS mean FROM ranked_hours GROUP BY 1, 2, 3),
ahead AS (
  SELECT whole.*, CAST(k AS INTEGER) AS hours_ahead, last + INTERVAL (k) HOUR AS timestamp FROM whole, range(1, 7) r(k)),
outlook AS (
  SELECT a.provider, a.gpu_name, hours_ahead, timestamp,
    {_r('0.7 * coalesce(p.mean, a.mean) + 0.3 * recent', 1)} AS predicted_offers
  FROM ahead a LEFT JOIN profile p ON a.provider = p.provider AND a.gpu_name = p.gpu_name AND p.h = hour(timestamp))
"""


def _outlook(where: str) -> str:
    return f"{_COMMON}, {_HOURLY}, {_OUTLOOK % where} SELECT * FROM outlook"


_SPREAD = f"""
listed AS (SELECT * FROM hourly WHERE provider IN ('vast', 'runpod', 'spheron')),
per_hour AS (SELECT gpu_name, captured_at, max(price) - min(price) AS gap FROM listed GROUP BY 1, 2),
seen AS (SELECT gpu_name, string_agg(DISTINCT provider, ',' ORDER BY provider) AS providers, count(DISTINCT provider) AS n FROM listed GROUP BY 1),
found AS (
  SELECT p.gpu_name, arg_max(gap, captured_at) AS latest, max(captured_at) AS latest_at, avg(gap) AS mean, stddev_samp(gap) AS std
  FROM per_hour p GROUP BY 1 HAVING count(*) >= 4),
spread AS (
  SELECT f.gpu_name, s.providers AS providers_compared, {_r('latest')} AS latest_spread, {_r('mean')} AS hist_avg_spread,
    {_r('std')} AS hist_std_spread, {_r('mean * 1.5')} AS threshold_1_5x, latest > mean * 1.5 AS spread_alert, latest_at
  FROM found f JOIN seen s ON f.gpu_name = s.gpu_name WHERE s.n >= 2)
"""


def _series_oracles() -> dict[str, str]:
    over = "OVER (PARTITION BY provider, gpu_name ORDER BY captured_at"
    day, week = f"{over} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)", f"{over} ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)"
    lags = ", ".join(f"{_r(f'lag(price, {k}) {over})', 6)} AS price_lag_{k}h" for k in (1, 6, 24, 168))
    weekday = "(isodow(captured_at) - 1)"
    return {
        "hourly_series": f"{_COMMON}, {_HOURLY} SELECT * FROM hourly",
        "stream_hourly_series": f"{_COMMON}, {_HOURLY} SELECT * FROM hourly",
        "decompose": _decomposed("TRUE"),
        "gpu_decompose": _decomposed(f"gpu_name = '{q.FOCUS_GPU}'"),
        "decompose_points": f"""{_COMMON}, {_HOURLY}, {_PARTS}
            SELECT captured_at, provider, gpu_name, {_r('price', 6)} AS price, {_r('trend', 6)} AS trend,
              {_r('seasonal', 6)} AS seasonal, {_r('price - trend - seasonal', 6)} AS noise FROM parts""",
        "price_features": f"""{_COMMON}, {_HOURLY}
            SELECT captured_at, provider, gpu_name, {_r('price', 6)} AS price,
              CAST(row_number() {over}) - 1 AS DOUBLE) AS t,
              {_r('sin(2 * pi() * hour(captured_at) / 24)', 6)} AS hour_sin,
              {_r('cos(2 * pi() * hour(captured_at) / 24)', 6)} AS hour_cos,
              {_r(f'sin(2 * pi() * {weekday} / 7)', 6)} AS dow_sin, {_r(f'cos(2 * pi() * {weekday} / 7)', 6)} AS dow_cos,
              {lags},
              {_r(f'CASE WHEN count(*) {day} >= 6 THEN avg(price) {day} END', 6)} AS rolling_mean_24h,
              {_r(f'CASE WHEN count(*) {day} >= 6 THEN stddev_samp(price) {day} ELSE 0 END', 6)} AS rolling_std_24h,
              {_r(f'CASE WHEN count(*) {week} >= 24 THEN avg(price) {week} END', 6)} AS rolling_mean_7d,
              CAST(offer_count AS DOUBLE) AS offer_count, CAST(lag(offer_count) {over}) AS DOUBLE) AS offer_count_lag_1h
            FROM hourly""",
        "supply_alignment": f"""{_COMMON}, {_HOURLY}
            SELECT captured_at, provider, gpu_name, price,
              coalesce(last_value(CASE WHEN hour(captured_at) % 3 = 0 THEN offer_count END IGNORE NULLS) {over}
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS offer_count FROM hourly""",
        "training_rows": f"""{_COMMON}, {_HOURLY}
            SELECT provider, gpu_name, greatest(count(*) - 168, 0) AS training_rows FROM hourly GROUP BY 1, 2""",
        "availability_6h": _outlook("TRUE"),
        "gpu_availability": _outlook(f"gpu_name = '{q.FOCUS_GPU}'"),
        "spread_analysis": f"""{_COMMON}, {_HOURLY}, {_SPREAD}
            SELECT s.gpu_name, providers_compared, latest_spread, hist_avg_spread, hist_std_spread, threshold_1_5x, spread_alert,
              first_value(l.provider) OVER (PARTITION BY s.gpu_name ORDER BY l.price, l.provider) AS cheapest_provider,
              first_value(l.provider) OVER (PARTITION BY s.gpu_name ORDER BY l.price DESC, l.provider) AS most_expensive_provider,
              l.provider, {_r('l.price')} AS price
            FROM spread s JOIN listed l ON s.gpu_name = l.gpu_name AND s.latest_at = l.captured_at""",
        "spread_alert_count": f"""{_COMMON}, {_HOURLY}, {_SPREAD}
            SELECT count(*) AS gpu_classes, count(*) FILTER (WHERE spread_alert) AS alerts FROM spread""",
        "series_overview": f"""{_COMMON}, {_HOURLY}
            SELECT count(*) AS rows, count(DISTINCT gpu_name) AS gpu_classes, count(DISTINCT provider) AS providers,
              CAST(min(captured_at) AS DATE) AS since, CAST(max(captured_at) AS DATE) AS latest FROM hourly""",
        "stream_alerts": f"""{_COMMON}, {_CURRENT}, {_ALL_WINDOWS}, {_ALERTS} SELECT * FROM alerts""",
    }


# The forecast model: standardised rows, normal equations with the penalty on the diagonal, elimination
# column by column, then 24 steps on a growing list of prices.
_WEEKDAY = "2 * pi() * (isodow({at}) - 1) / 7"
_CLOCK = "2 * pi() * hour({at}) / 24"


def _clock(at: str) -> str:
    hour, weekday = _CLOCK.format(at=at), _WEEKDAY.format(at=at)
    return f"sin({hour}), cos({hour}), sin({weekday}), cos({weekday})"


_MODEL = f"""
lagged AS (
  SELECT *, CAST(row_number() OVER s - 1 AS DOUBLE) AS t, lag(price) OVER s AS l1, lag(price, 6) OVER s AS l6, lag(price, 24) OVER s AS l24,
    lag(price, 168) OVER s AS l168, avg(price) OVER d AS day_mean, stddev_samp(price) OVER d AS day_std, avg(price) OVER w AS week_mean,
    lag(offer_count) OVER s AS offers_before
  FROM hourly WINDOW s AS (PARTITION BY provider, gpu_name ORDER BY captured_at),
    d AS (PARTITION BY provider, gpu_name ORDER BY captured_at ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING),
    w AS (PARTITION BY provider, gpu_name ORDER BY captured_at ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)),
train AS (
  SELECT provider, gpu_name, captured_at, price AS y, [t, {_clock('captured_at')}, l1, l6, l24, l168, day_mean, day_std, week_mean,
    CAST(offer_count AS DOUBLE), CAST(offers_before AS DOUBLE)] AS x FROM lagged WHERE t >= 168),
cells AS (SELECT provider, gpu_name, captured_at, y, unnest(range(1, 15)) AS i, unnest(x) AS v FROM train),
scales AS (
  SELECT provider, gpu_name, i, avg(v) AS m, CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END AS s FROM cells GROUP BY ALL),
levels AS (SELECT provider, gpu_name, avg(y) AS level FROM train GROUP BY ALL HAVING count(*) >= 10),
scaled AS (
  SELECT c.provider, c.gpu_name, c.captured_at, c.i, (v - m) / s AS z, y - level AS rest
  FROM cells c JOIN scales k ON c.provider = k.provider AND c.gpu_name = k.gpu_name AND c.i = k.i
  JOIN levels l ON c.provider = l.provider AND c.gpu_name = l.gpu_name),
sums AS (
  SELECT a.provider, a.gpu_name, a.i, b.i AS j, sum(a.z * b.z) + CASE WHEN a.i = b.i THEN 1 ELSE 0 END AS g
  FROM scaled a JOIN scaled b ON a.provider = b.provider AND a.gpu_name = b.gpu_name AND a.captured_at = b.captured_at GROUP BY 1, 2, 3, 4
  UNION ALL SELECT provider, gpu_name, i, 15, sum(z * rest) FROM scaled GROUP BY ALL),
lines AS (SELECT provider, gpu_name, i, list(g ORDER BY j) AS r FROM sums GROUP BY ALL),
steps AS (
  SELECT provider, gpu_name, 1 AS k, list(r ORDER BY i) AS m FROM lines GROUP BY ALL
  UNION ALL
  SELECT provider, gpu_name, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / m[k][k])
    ELSE list_transform(r, lambda x, j: x - r[k] / m[k][k] * m[k][j]) END)
  FROM steps WHERE k <= 14),
weights AS (SELECT provider, gpu_name, list_transform(m, lambda r: r[15]) AS w FROM steps WHERE k = 15),
errors AS (
  SELECT s.provider, s.gpu_name, s.captured_at, any_value(rest) - sum(z * w[i]) AS e
  FROM scaled s JOIN weights w ON s.provider = w.provider AND s.gpu_name = w.gpu_name GROUP BY 1, 2, 3),
bands AS (SELECT provider, gpu_name, 1.96 * stddev_pop(e) AS band FROM errors GROUP BY ALL),
known AS (
  SELECT h.provider, h.gpu_name, list(price ORDER BY captured_at) AS h, max(captured_at) AS last_at, count(*) AS n,
    list(CAST(offer_count AS DOUBLE) ORDER BY captured_at) AS offers FROM hourly h GROUP BY ALL),
fixed AS (SELECT provider, gpu_name, list(m ORDER BY i) AS ms, list(s ORDER BY i) AS ss FROM scales GROUP BY ALL),
walk AS (
  SELECT k.provider, k.gpu_name, 0 AS step, h, last_at, n, offers, level, w, ms, ss, band, CAST(NULL AS DOUBLE) AS f
  FROM known k JOIN levels l ON k.provider = l.provider AND k.gpu_name = l.gpu_name
  JOIN weights w ON k.provider = w.provider AND k.gpu_name = w.gpu_name
  JOIN fixed x ON k.provider = x.provider AND k.gpu_name = x.gpu_name JOIN bands b ON k.provider = b.provider AND k.gpu_name = b.gpu_name
  UNION ALL
  SELECT provider, gpu_name, step + 1, list_append(h, next), last_at, n, offers, level, w, ms, ss, band, next
  FROM (SELECT *, greatest(level + list_sum(list_transform(range(1, 15), lambda i: (x[i] - ms[i]) / ss[i] * w[i])), 0) AS next
    FROM (SELECT *, [CAST(n + step AS DOUBLE), {_clock('moment')}, h[-1], h[-6], h[-24], h[-168], list_avg(h[-24:]),
        list_aggregate(h[-24:], 'stddev_pop'), list_avg(h[-168:]), offers[-1], CASE WHEN step = 0 THEN offers[-2] ELSE offers[-1] END] AS x
      FROM (SELECT *, last_at + to_hours(step + 1) AS moment FROM walk WHERE step < 24)))),
points AS (
  SELECT provider, gpu_name, CAST(step AS INTEGER) AS hours_ahead, last_at + to_hours(step) AS timestamp, f AS forecast,
    greatest(f - band, 0) AS lower_95, f + band AS upper_95
  FROM walk WHERE step > 0),
shares AS (
  SELECT provider, gpu_name, unnest(range(1, 15)) AS i, unnest(list_transform(w, lambda x: abs(x) / (list_sum(list_transform(w, lambda v: abs(v))) + 1e-9))) AS share
  FROM weights),
ranked AS (
  SELECT provider, gpu_name, CAST(row_number() OVER (PARTITION BY provider, gpu_name ORDER BY round(share, 4) DESC, i) AS INTEGER) AS rank,
    ({FEATURES!r})[i] AS feature, round(share, 4) AS importance FROM shares)
"""
_RECURSIVE = _COMMON.replace("WITH", "WITH RECURSIVE", 1)


def _forecast_oracles() -> dict[str, str]:
    model = f"{_RECURSIVE}, {_HOURLY}, {_MODEL}"
    points = f"""SELECT provider, gpu_name, hours_ahead, timestamp, {_r('forecast', 6)} AS forecast, {_r('lower_95', 6)} AS lower_95,
        {_r('upper_95', 6)} AS upper_95 FROM points"""
    windows = f"""{model}, {_PARTS},
    trends AS (
      SELECT provider, gpu_name, regr_slope(trend, i) AS slope, least(1.0, stddev_samp(seasonal) / stddev_samp(price - trend)) AS strength
      FROM parts GROUP BY ALL HAVING count(*) >= 4),
    {_OUTLOOK % 'TRUE'},
    price_levels AS (
      SELECT provider, gpu_name, quantile_cont(price, 0.1) AS p10, quantile_cont(price, 0.5) AS p50, quantile_cont(price, 0.9) AS p90,
        stddev_pop(price) / (avg(price) + 1e-9) AS vol, avg(CASE WHEN offer_count > 0 THEN 1.0 ELSE 0.0 END) AS avail,
        arg_max(price, captured_at) AS last, count(price) AS n FROM hourly GROUP BY ALL),
    tops AS (SELECT provider, gpu_name, string_agg(feature, ',' ORDER BY rank) AS top_features FROM ranked WHERE rank <= 3 GROUP BY ALL),
    windows AS (
      SELECT p.provider, p.gpu_name AS gpu_class, timestamp AS forecast_timestamp, TIMESTAMP '2024-02-01 00:00:00' AS generated_at,
        p.hours_ahead AS forecast_hours_ahead, {_r('forecast')} AS price_forecast, {_r('lower_95')} AS price_forecast_lower,
        {_r('upper_95')} AS price_forecast_upper, {_r('last')} AS last_actual_price, {_r('p10')} AS price_per_gpu_hour_p10,
        {_r('p50')} AS price_per_gpu_hour_p50, {_r('p90')} AS price_per_gpu_hour_p90, {_r('vol')} AS price_volatility,
        {_r('avail')} AS availability_probability, {_r('slope', 6)} AS trend_slope_per_hour, {_r('strength')} AS seasonal_strength,
        o.predicted_offers, l.n AS n_price_samples, top_features
      FROM points p JOIN price_levels l ON p.provider = l.provider AND p.gpu_name = l.gpu_name
      JOIN trends t ON p.provider = t.provider AND p.gpu_name = t.gpu_name JOIN tops x ON p.provider = x.provider AND p.gpu_name = x.gpu_name
      LEFT JOIN (SELECT provider, gpu_name, hours_ahead, predicted_offers FROM outlook) o
        ON p.provider = o.provider AND p.gpu_name = o.gpu_name AND p.hours_ahead = o.hours_ahead)"""
    return {
        "forecast_24h": f"{model} {points}",
        "gpu_forecast": f"{model} {points} WHERE gpu_name = '{q.FOCUS_GPU}'",
        "feature_importance": f"{model} SELECT * FROM ranked",
        "forecast_windows": f"{windows} SELECT * FROM windows",
        "forecast_lookup": f"{windows} SELECT * FROM windows WHERE gpu_class IN ('RTX_4090', 'H100_SXM', 'A100_40GB', 'L40S')",
        "forecast_series": f"""{windows} SELECT provider, forecast_hours_ahead AS hours_ahead, forecast_timestamp, price_forecast,
            price_forecast_lower, price_forecast_upper FROM windows WHERE gpu_class = '{q.FOCUS_GPU}'""",
    }


def oracle_sql() -> dict[str, str]:
    return {**_report_oracles(), **_ingest_oracles(), **_replay_oracles(), **_series_oracles(), **_forecast_oracles()}
