"""Independent SQL for the catalog's queries, written for DuckDB over the same tables."""

from __future__ import annotations

import re

from creascope.plans.binding import FEATURE_NAMES, N_COMPONENTS, N_PIXELS

SLUG = "'adunit-c' || campaign_no || CASE WHEN campaign_no % 2 = 0 THEN '-mob' ELSE '-mpu' END"
REQUEST = "lpad(CAST(idx AS VARCHAR), 20, CASE WHEN idx % 6 = 5 THEN 'x' ELSE '0' END)"
CAMPAIGN = "'camp_' || lpad(CAST(campaign_no AS VARCHAR), 4, '0')"
EVENT_KEYS = "campaign_id, game_key, device_type, platform_os, geo_country"
COUNTS = """count(*) FILTER (WHERE type = 'impression') AS n_impressions,
    count(*) FILTER (WHERE type = 'first_dropped') AS n_engagements,
    count(*) FILTER (WHERE type = 'click-through-event') AS n_clicks"""


def day_first(column: str) -> str:
    return f"coalesce(try_strptime({column}, '%d/%m/%Y'), try_strptime({column}, '%Y-%m-%d'))"


def number(column: str) -> str:
    return f"coalesce(TRY_CAST({column} AS DOUBLE), 0.0)"


def r6(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0"


def r6_as(*names: str) -> str:
    return ", ".join(f"{r6(n)} AS {n}" for n in names)


def raw_rate(part: str) -> str:
    return f"CAST({part} AS DOUBLE) / nullif(n_impressions, 0)"


def clipped_rate(part: str) -> str:
    return f"CASE WHEN n_impressions > 0 THEN least(1.0, greatest(0.0, {raw_rate(part)})) END"


def days(start: str, end: str) -> str:
    return (f"CASE WHEN {start} IS NOT NULL AND {end} IS NOT NULL "
            f"THEN greatest(datesub('day', {start}, {end}), 0) END")


def balanced_folds(sizes: str, k: int = 5) -> str:
    """Groups (grp, n) dealt to and fro over the folds, largest first."""
    return f"""
turns AS (
  SELECT grp, n, (row_number() OVER (
    ORDER BY n DESC, substr(md5(CAST(grp AS VARCHAR)), 1, 3), grp) - 1) % {2 * k} AS turn FROM ({sizes})),
folds AS (
  SELECT grp, n, CAST(CASE WHEN turn < {k} THEN turn ELSE {2 * k - 1} - turn END AS INTEGER) AS fold FROM turns)"""


PIXEL = "CAST(floor(least(1.0, greatest(0.0, (CAST(embedding[3 * p + {i}] AS DOUBLE) + 0.6) / 1.2)) * 255) AS INTEGER)"
VISION_MEASURES = ["aspect_ratio", "brightness_mean", "saturation_mean", "colorfulness",
                   "visual_entropy", "color_diversity_score"]
COMPONENTS = [f"vision_pca_{i}" for i in range(N_COMPONENTS)]

# Named sub-queries; each may use the base tables and the ones above it.
CTES = {
    "raw_inventory": f"""
  SELECT event_id, value, k, ts AS browser_ts,
    CASE WHEN user_id % 50 <> 47 THEN {CAMPAIGN} END AS campaign_id,
    CASE WHEN user_id % 50 = 49 THEN 'noslash' ELSE {SLUG} || '/' || {REQUEST} END AS game_key,
    CASE WHEN event_type = 'view' THEN CASE WHEN k % 10 = 0 THEN ' Impression ' ELSE 'impression' END
         WHEN event_type = 'purchase' AND value < 30 THEN 'first_dropped'
         WHEN event_type = 'click' AND value < 15 THEN 'click-through-event'
         ELSE event_type END AS type,
    CASE WHEN user_id % 25 = 24 THEN NULL WHEN user_id % 2 = 0 THEN 'smartphone' ELSE 'tablet' END AS device_type,
    CASE WHEN user_id % 4 < 2 THEN 'ios' ELSE 'android' END AS platform_os,
    CASE WHEN user_id % 5 = 0 THEN 'USA' ELSE 'SGP' END AS geo_country
  FROM (SELECT *, 3 * campaign_no + k % 3 AS idx FROM (
    SELECT *, user_id // 25 AS campaign_no, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))""",
    "inventory": """
  SELECT * REPLACE (lower(trim(type)) AS type) FROM raw_inventory""",
    "raw_briefing": f"""
  SELECT CASE WHEN o_custkey % 97 <> 0 THEN {CAMPAIGN} END AS campaign_id,
    o_orderkey AS submission_id,
    strftime(o_orderdate, '%d/%m/%Y') AS submission_date,
    'Campaign ' || campaign_no AS campaign_name,
    o_orderpriority AS campaign_objectives, o_orderstatus AS kpis,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'to be set' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS startdate,
    strftime(o_orderdate + to_days(CAST(o_orderkey % 60 - 10 AS INTEGER)), '%d/%m/%Y') AS enddate,
    CASE WHEN o_orderstatus = 'F' THEN 'USD' ELSE 'EUR' END AS currency,
    CASE WHEN o_orderkey % 11 = 0 THEN 'tbc' ELSE CAST(o_totalprice / 1000000 AS VARCHAR) END AS buy_rate_cpe,
    CAST(o_orderkey AS VARCHAR) AS volume_agreed,
    CAST(o_totalprice AS VARCHAR) AS gross_cost_budget
  FROM (SELECT *, o_custkey // 25 + 1 AS campaign_no FROM orders)""",
    "briefing": f"""
  SELECT DISTINCT ON (campaign_id) campaign_id, submission_id,
    {day_first('submission_date')} AS submission_date, campaign_name, campaign_objectives, kpis,
    {day_first('startdate')} AS startdate, {day_first('enddate')} AS enddate, currency,
    {number('buy_rate_cpe')} AS buy_rate_cpe, {number('volume_agreed')} AS volume_agreed,
    {number('gross_cost_budget')} AS gross_cost_budget
  FROM raw_briefing
  ORDER BY campaign_id, {day_first('submission_date')} DESC NULLS LAST, submission_id DESC""",
    "campaigns": """
  SELECT * EXCLUDE (submission_id, submission_date, kpis) FROM briefing WHERE campaign_id IS NOT NULL""",
    "color_lines": """
  SELECT l_suppkey, l_linestatus, l_linenumber, max(l_quantity) AS most, min(l_quantity) AS least,
    max(l_discount) AS discount, max(l_tax) AS tax, count(*) AS n
  FROM lineitem GROUP BY ALL""",
    "design": """
  SELECT md5('design-' || l_linestatus || l_suppkey % 10) AS md5_game_key,
    lpad(CAST(l_suppkey AS VARCHAR), 20, '0') AS request_id,
    CAST(count(*) FILTER (WHERE discount >= 0.1) AS INTEGER) AS n_engagement_labels,
    CAST(count(*) FILTER (WHERE least <= 1) AS INTEGER) AS n_click_through_labels,
    coalesce(string_agg('label' || l_linenumber, ' ' ORDER BY l_linenumber) FILTER (WHERE discount >= 0.1), '')
      AS engagement_labels_text,
    CAST(count(*) FILTER (WHERE n % 2 = 0) AS INTEGER) AS n_engagement_texts,
    CAST(count(*) FILTER (WHERE n % 3 = 0) AS INTEGER) AS n_click_through_texts,
    coalesce(string_agg('text' || l_linenumber, ' ' ORDER BY l_linenumber) FILTER (WHERE n % 2 = 0), '')
      AS engagement_text_content,
    coalesce(max(most) FILTER (WHERE dominant) * 5 / 255, 0.0) AS dominant_color_r,
    coalesce(max(discount) FILTER (WHERE dominant) * 1000 / 255, 0.0) AS dominant_color_g,
    coalesce(max(least) FILTER (WHERE dominant) * 5 / 255, 0.0) AS dominant_color_b,
    coalesce(max(tax) FILTER (WHERE dominant), 0.0) AS dominant_color_proportion,
    avg(CASE WHEN l_linenumber = 3 THEN 0.0 ELSE discount * 10 END) AS color_saturation_mean,
    avg(tax * 10) AS color_luminosity_mean,
    CAST(count(*) AS INTEGER) AS color_diversity,
    (dominant_color_r + dominant_color_g + dominant_color_b) / 3 AS brightness,
    CAST(sum(n) % 2 AS INTEGER) AS has_video,
    CASE WHEN sum(n) % 2 = 1 THEN coalesce(avg(most) FILTER (WHERE n % 2 = 0), 0.0) ELSE 0.0 END
      AS video_length_seconds,
    CASE l_suppkey % 3 WHEN 0 THEN 'up' WHEN 1 THEN 'left' ELSE 'no direction' END AS interaction_direction,
    CAST(sum(n) AS DOUBLE) AS adunit_width,
    CASE WHEN l_suppkey % 5 = 0 THEN 0.0 ELSE max(most) * 10 END AS adunit_height,
    CASE WHEN l_suppkey % 5 = 0 THEN 0.0 ELSE CAST(sum(n) AS DOUBLE) / (max(most) * 10) END AS aspect_ratio
  FROM (SELECT *, l_linenumber = 1 AND l_suppkey % 4 <> 3 AS dominant FROM color_lines)
  GROUP BY l_suppkey, l_linestatus""",
    "assets": """
  SELECT *, CASE WHEN slug LIKE '%-mob%' THEN 'mobile' WHEN slug LIKE '%-mpu%' THEN 'mpu'
      WHEN slug LIKE '%-tap%' THEN 'tap' WHEN slug LIKE '%-bio%' THEN 'bio' ELSE 'unknown' END AS placement_type
  FROM (
    SELECT slug_part || '-' || id_part || '.png' AS filename,
      'assets/' || slug_part || '-' || id_part || '.png' AS filepath,
      CASE WHEN length(id_part) = 20 THEN slug_part ELSE slug_part || '-' || id_part END AS slug,
      CASE WHEN length(id_part) = 20 THEN id_part END AS request_id,
      CASE WHEN p_size % 11 = 0 THEN 0.0
           ELSE round(CAST(trunc(p_retailprice * 100) AS BIGINT) / 1024, 2) END AS file_size_kb
    FROM (SELECT *, 'adunit-' || replace(p_name, ' ', '-') || ['-mob', '-mpu', '-tap', '-bio', ''][p_size % 5 + 1] AS slug_part,
        lpad(CAST(p_partkey AS VARCHAR), CASE WHEN p_size % 7 = 0 THEN 12 ELSE 20 END, '0') AS id_part
      FROM part))""",
    "vision": f"""
  SELECT filename, vec_id, 1 + e[1] AS aspect_ratio,
    CASE WHEN vec_id % 9 <> 0 THEN abs(e[2]) END AS brightness_mean,
    abs(e[3]) AS saturation_mean, abs(e[4]) AS colorfulness, abs(e[5]) * 8 AS visual_entropy,
    abs(e[6]) AS color_diversity_score,
    CASE WHEN e[2] < 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_dark_background,
    CASE WHEN e[3] > 0.1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_light_background,
    vec_id / 10 AS file_size_kb,
    {', '.join(f'e[{i + 1}] AS vision_pca_{i}' for i in range(N_COMPONENTS))}
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, {SLUG} || '-' || {REQUEST} || '.png' AS filename
    FROM (SELECT *, vec_id // 2 AS idx, vec_id // 6 AS campaign_no FROM embeddings))""",
    "vision_files": """
  SELECT DISTINCT ON (filename) * FROM vision ORDER BY filename, vec_id""",
    "pixels": f"""
  SELECT vec_id, p, {PIXEL.format(i=1)} AS r, {PIXEL.format(i=2)} AS g, {PIXEL.format(i=3)} AS b
  FROM embeddings, range({N_PIXELS}) AS t(p)""",
    "pixel_stats": """
  SELECT vec_id, count(*) AS n_pixels,
    avg(light) AS brightness_mean, avg(saturation) AS saturation_mean,
    sqrt(var_pop(rg) + var_pop(yb)) + 0.3 * sqrt(avg(rg) ** 2 + avg(yb) ** 2) AS colorfulness,
    CAST(count(DISTINCT bucket) AS DOUBLE) / 64 AS color_diversity_score,
    CASE WHEN avg(light) < 0.3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_dark_background,
    CASE WHEN avg(light) > 0.7 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_light_background
  FROM (SELECT vec_id, 0.2126 * r / 255 + 0.7152 * g / 255 + 0.0722 * b / 255 AS light,
      CASE WHEN greatest(r, g, b) > 0
           THEN CAST(greatest(r, g, b) - least(r, g, b) AS DOUBLE) / greatest(r, g, b) ELSE 0.0 END AS saturation,
      (r - g) / 255 AS rg, (0.5 * (r + g) - b) / 255 AS yb,
      least(r * 4 // 255, 3) * 16 + least(g * 4 // 255, 3) * 4 + least(b * 4 // 255, 3) AS bucket
    FROM pixels)
  GROUP BY vec_id""",
    "entropy": """
  SELECT vec_id, -sum(share * log2(share + 1e-9)) AS visual_entropy
  FROM (SELECT vec_id, count(*) / (sum(count(*)) OVER (PARTITION BY vec_id) + 1e-9) AS share
    FROM pixels GROUP BY vec_id, (19595 * r + 38470 * g + 7471 * b + 32768) // 65536)
  GROUP BY vec_id""",
    "creatives": """
  SELECT game_key, creative_slug, creative_request_id, image_filename,
    coalesce(aspect_ratio, 0.0) AS aspect_ratio, coalesce(brightness_mean, 0.0) AS brightness_mean,
    coalesce(saturation_mean, 0.0) AS saturation_mean, coalesce(colorfulness, 0.0) AS colorfulness,
    coalesce(visual_entropy, 0.0) AS visual_entropy,
    coalesce(color_diversity_score, 0.0) AS color_diversity_score, FALSE AS has_video,
    coalesce(is_dark_background <> 0, FALSE) AS is_dark_background,
    coalesce(is_light_background <> 0, FALSE) AS is_light_background
  FROM (SELECT DISTINCT game_key, split_part(game_key, '/', 1) AS creative_slug,
      split_part(game_key, '/', 2) AS creative_request_id,
      split_part(game_key, '/', 1) || '-' || split_part(game_key, '/', 2) || '.png' AS image_filename
    FROM inventory WHERE game_key LIKE '%/%') k
  LEFT JOIN vision_files v ON v.filename = k.image_filename""",
    "metrics": f"""
  SELECT *, {raw_rate('n_engagements')} AS engagement_rate, {raw_rate('n_clicks')} AS click_through_rate
  FROM (SELECT {EVENT_KEYS}, {COUNTS} FROM inventory
    WHERE campaign_id IS NOT NULL AND game_key LIKE '%/%' AND game_key IN (SELECT game_key FROM creatives)
    GROUP BY ALL)""",
    "kpis": f"""
  SELECT *, split_part(game_key, '/', 1) AS creative_slug, split_part(game_key, '/', 2) AS creative_request_id,
    {clipped_rate('n_engagements')} AS engagement_rate, {clipped_rate('n_clicks')} AS click_through_rate
  FROM (SELECT {EVENT_KEYS}, {COUNTS} FROM inventory
    WHERE campaign_id IS NOT NULL AND device_type IS NOT NULL AND game_key LIKE '%/%'
    GROUP BY ALL)
  WHERE n_impressions >= 10""",
    "linked": f"""
  SELECT k.*, d.* EXCLUDE (request_id), b.* EXCLUDE (campaign_id, submission_id, submission_date),
    {days('b.startdate', 'b.enddate')} AS campaign_duration_days,
    k.creative_slug || '-' || k.creative_request_id || '.png' AS image_filename
  FROM kpis k
  LEFT JOIN design d ON d.request_id = k.creative_request_id
  LEFT JOIN briefing b ON b.campaign_id = k.campaign_id""",
    "vision_linked": """
  SELECT l.*, v.* EXCLUDE (filename, aspect_ratio)
  FROM linked l LEFT JOIN vision_files v ON v.filename = l.image_filename""",
    "predictions": f"""
  SELECT date_trunc('year', l_shipdate) AS run_timestamp,
    CASE WHEN l_returnflag = 'A' THEN 'baseline' WHEN l_returnflag = 'N' THEN 'tabular'
         WHEN l_linestatus = 'O' THEN 'vision' ELSE 'multimodal' END AS model,
    CAST(l_suppkey % 5 AS INTEGER) AS fold, l_discount * 10 AS y, l_tax * 10 - 0.1 AS prediction,
    l_quantity AS importance, {FEATURE_NAMES!r}[l_partkey % {len(FEATURE_NAMES)} + 1] AS feature
  FROM lineitem""",
    "run_folds": """
  SELECT run_timestamp, model, fold, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
    1 - sum(e * e) / (var_pop(y) * count(*)) AS r2,
    100 * avg(abs(e / y)) FILTER (WHERE y <> 0) AS mape
  FROM (SELECT *, y - greatest(prediction, 0.0) AS e FROM predictions) GROUP BY ALL""",
    "benchmarks": """
  SELECT run_timestamp, 'engagement_rate' AS target_metric, model AS model_name, avg(mae) AS mae,
    avg(rmse) AS rmse, avg(r2) AS r2, avg(mape) AS mape, length(model) AS n_features
  FROM run_folds GROUP BY run_timestamp, model""",
    "importances": """
  SELECT run_timestamp, model AS model_name, feature AS feature_name, sum(importance) / 5 AS importance_score,
    CASE WHEN regexp_matches(feature, '^(vision_|color_|dominant_|brightness|saturation|aspect_|visual_|is_)')
         THEN 'Visual' ELSE 'Contextual' END AS category
  FROM predictions GROUP BY run_timestamp, model, feature""",
    "labelled": """
  SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)""",
    "known": """
  SELECT * FROM labelled WHERE lang = 'en' AND toxic = 0""",
    "latest_bench": """
  SELECT * FROM benchmarks WHERE run_timestamp = (SELECT max(run_timestamp) FROM benchmarks)""",
    "baseline_oof": """
  SELECT 'baseline' AS model, f.fold, CAST(l.quality AS DOUBLE) AS y,
    (SELECT avg(m.quality) FROM labelled m JOIN folds g ON g.grp = m.source WHERE g.fold <> f.fold) AS prediction
  FROM labelled l JOIN folds f ON f.grp = l.source""",
}
SOURCE_FOLDS = balanced_folds("SELECT source AS grp, count(*) AS n FROM labelled GROUP BY source")
USER_FOLDS = balanced_folds("SELECT user_id AS grp, count(*) AS n FROM events GROUP BY user_id")


def sql(final: str, folds: str = "") -> str:
    """Prefix ``final`` with exactly the named sub-queries it needs, in order."""
    needed: set[str] = set()
    frontier = [final, folds]
    while frontier:
        words = set(re.findall(r"[a-z_0-9]+", frontier.pop()))
        for name in (words & CTES.keys()) - needed:
            needed.add(name)
            frontier.append(CTES[name])
    parts = [f"{name} AS ({body}\n)" for name, body in CTES.items() if name in needed and name != "baseline_oof"]
    if folds:
        parts.append(folds.strip())
    if "baseline_oof" in needed:
        parts.append(f"baseline_oof AS ({CTES['baseline_oof']}\n)")
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


def metric_columns(source: str, by: str) -> str:
    return f"""SELECT {by}, count(*) AS n, {r6('avg(abs(e))')} AS mae, {r6('sqrt(avg(e * e))')} AS rmse,
      {r6('1 - sum(e * e) / (var_pop(y) * count(*))')} AS r2,
      {r6("coalesce(100 * avg(abs(e / y)) FILTER (WHERE y <> 0), 'nan'::DOUBLE)")} AS mape
    FROM (SELECT *, y - greatest(prediction, 0.0) AS e FROM {source}) GROUP BY {by}"""


def summary_columns(source: str) -> str:
    names = ("mae", "rmse", "r2", "mape")
    means = ", ".join(f"{r6(f'avg({m})')} AS {m}_mean" for m in names)
    spreads = ", ".join(f"{r6(f'stddev_pop({m})')} AS {m}_std" for m in names)
    return f"""SELECT model, {means}, {spreads}, count(*) AS n_folds FROM (
      SELECT model, fold, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
        1 - sum(e * e) / (var_pop(y) * count(*)) AS r2,
        coalesce(100 * avg(abs(e / y)) FILTER (WHERE y <> 0), 'nan'::DOUBLE) AS mape
      FROM (SELECT *, y - greatest(prediction, 0.0) AS e FROM {source}) GROUP BY model, fold)
    GROUP BY model"""


DESIGN_DOUBLES = [
    "dominant_color_r", "dominant_color_g", "dominant_color_b", "dominant_color_proportion",
    "color_saturation_mean", "color_luminosity_mean", "brightness", "video_length_seconds",
    "adunit_width", "adunit_height", "aspect_ratio",
]
CAMPAIGN_DOUBLES = ["buy_rate_cpe", "volume_agreed", "gross_cost_budget"]
RATES = ["engagement_rate", "click_through_rate"]


def rounded_all(source: str, doubles: list[str], dates: list[str] = ()) -> str:
    changed = [f"{r6(c)} AS {c}" for c in doubles] + [f"CAST({c} AS DATE) AS {c}" for c in dates]
    return f"SELECT * REPLACE ({', '.join(changed)}) FROM {source}"


def title(name: str) -> str:
    words = f"string_split({name}, '_')"
    return f"array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN {words}], ' ')"


def top_features(n: int) -> str:
    return f"""SELECT feature_name, {title('feature_name')} AS name, {r6('importance_score', 4)} AS importance, category
      FROM importances WHERE model_name = 'multimodal'
        AND run_timestamp = (SELECT max(run_timestamp) FROM importances)
      ORDER BY importance_score DESC, feature_name LIMIT {n}"""


def code_of(value: str, among: str) -> str:
    return f"(SELECT count(DISTINCT d.v) FROM ({among}) d WHERE d.v < {value})"


MATRIX_CATEGORIES = ["device_type", "platform_os", "geo_country", "interaction_direction"]
MATRIX_NUMBERS = [
    "has_video", "video_length_seconds", "n_engagement_labels", "n_click_through_labels",
    "n_engagement_texts", "n_click_through_texts", "dominant_color_r", "dominant_color_g",
    "dominant_color_b", "dominant_color_proportion", "color_saturation_mean",
    "color_luminosity_mean", "color_diversity", "brightness", "aspect_ratio",
    "buy_rate_cpe", "volume_agreed", "gross_cost_budget", "campaign_duration_days",
    "brightness_mean", "saturation_mean", "colorfulness", "visual_entropy",
    "color_diversity_score", "is_dark_background", "is_light_background", "file_size_kb", *COMPONENTS,
]


def matrix_sql() -> str:
    codes = ", ".join(
        f"CAST(dense_rank() OVER (ORDER BY coalesce({c}, 'unknown')) - 1 AS INTEGER) AS {c}_enc"
        for c in MATRIX_CATEGORIES)
    filled = ", ".join(
        f"{r6(f'coalesce(CAST({c} AS DOUBLE), median(CAST({c} AS DOUBLE)) OVER (), 0.0)')} AS {c}"
        for c in MATRIX_NUMBERS)
    return f"""SELECT campaign_id, game_key, coalesce(device_type, 'unknown') AS device_type, platform_os,
      geo_country, md5_game_key, {r6_as(*RATES)}, {codes}, {filled} FROM vision_linked"""


def correlations() -> str:
    columns = ["n_impressions", "n_engagements", "n_clicks", "click_through_rate"]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r6(f'corr({c}, engagement_rate)')} AS correlation FROM kpis" for c in columns)


def medians() -> str:
    sources = {
        "raw_inventory": ["value", "k"],
        "vision": ["brightness_mean", "colorfulness", "vision_pca_3"],
        "lineitem": ["l_extendedprice", "l_discount"],
    }
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r6(f'median({c}::DOUBLE)')} AS median FROM {t}"
        for t, columns in sources.items() for c in columns)


HEURISTIC = """SELECT event_id, round(er * 100, 1) + 0.0 AS er_percent, round(er * 0.45 * 100, 1) + 0.0 AS ctr_percent,
    tier, CASE tier WHEN 'low' THEN '🔴 Low' WHEN 'top' THEN '⭐ Top Performer' WHEN 'high' THEN '🟢 High'
          ELSE '🟡 Average' END AS tier_label
  FROM (SELECT *, CASE WHEN er < 0.08 THEN 'low' WHEN er > 0.15 THEN 'top' WHEN er > 0.12 THEN 'high' ELSE 'avg' END AS tier
    FROM (SELECT event_id, CAST(0.12 AS DOUBLE)
        * CASE WHEN device_type = 'smartphone' THEN 1.15::DOUBLE ELSE 1.0::DOUBLE END
        * CASE WHEN platform_os = 'ios' THEN 1.08::DOUBLE ELSE 1.0::DOUBLE END
        * CASE WHEN geo_country = 'USA' THEN 1.10::DOUBLE ELSE 1.0::DOUBLE END
        * (1 - value / 1000 * 0.3::DOUBLE)
        * (0.8::DOUBLE + k * 0.004::DOUBLE)
        * (0.85::DOUBLE + (k * 7 % 100) * 0.003::DOUBLE)
        * (0.9::DOUBLE + (k * 3 % 100) * 0.002::DOUBLE)
        * CASE WHEN k % 2 = 0 THEN 1.12::DOUBLE ELSE 1.0::DOUBLE END AS er
      FROM raw_inventory))"""

# One feature on standardised scale: slope = sum(z * (y - mean)) / (n + alpha), alpha = 1.
RIDGE = f"""SELECT doc_id, {r6('my + (n_chars - mx) / sx * sxy / (n + 1)')} AS prediction
  FROM documents, (SELECT n, mx, my, sx, (SELECT sum((l.n_chars - s.mx) / s.sx * (l.quality - s.my)) FROM labelled l) AS sxy
    FROM (SELECT count(*) AS n, avg(n_chars) AS mx, avg(quality) AS my, stddev_pop(n_chars) AS sx FROM labelled) s)"""

# The same with two features, per fold: the slopes solve a 2x2 system with c = sum(z1 * z2).
RIDGE_FOLDS = """ridge_stats AS (
  SELECT f.fold, count(*) AS n, avg(n_chars) AS m1, stddev_pop(n_chars) AS d1, avg(toxic) AS m2,
    stddev_pop(toxic) AS d2, avg(quality) AS my
  FROM (SELECT DISTINCT fold FROM folds) f JOIN folds g ON g.fold <> f.fold JOIN labelled l ON l.source = g.grp
  GROUP BY f.fold),
ridge_sums AS (
  SELECT s.fold, sum((n_chars - m1) / d1 * (quality - my)) AS s1, sum((toxic - m2) / d2 * (quality - my)) AS s2,
    sum((n_chars - m1) / d1 * (toxic - m2) / d2) AS c
  FROM ridge_stats s JOIN folds g ON g.fold <> s.fold JOIN labelled l ON l.source = g.grp GROUP BY s.fold),
ridge_oof AS (
  SELECT 'ridge' AS model, s.fold, CAST(quality AS DOUBLE) AS y,
    my + (n_chars - m1) / d1 * ((s.n + 1) * s1 - c * s2) / ((s.n + 1) ** 2 - c ** 2)
       + (toxic - m2) / d2 * ((s.n + 1) * s2 - c * s1) / ((s.n + 1) ** 2 - c ** 2) AS prediction
  FROM ridge_stats s JOIN ridge_sums USING (fold) JOIN folds g ON g.fold = s.fold
  JOIN labelled l ON l.source = g.grp)"""

NULL_KEY_KPIS = f"""SELECT *, CASE WHEN game_key LIKE '%/%' THEN split_part(game_key, '/', 1) ELSE game_key END AS creative_slug,
    CASE WHEN game_key LIKE '%/%' THEN split_part(game_key, '/', 2) END AS creative_request_id,
    {r6(raw_rate('n_engagements'))} AS engagement_rate, {r6(raw_rate('n_clicks'))} AS click_through_rate
  FROM (SELECT {EVENT_KEYS}, {COUNTS} FROM inventory GROUP BY ALL)"""

PIVOT = f"""SELECT *, split_part(game_key, '/', 1) AS creative_slug, split_part(game_key, '/', 2) AS creative_request_id,
    {r6(clipped_rate('n_engagements'))} AS engagement_rate, {r6(clipped_rate('n_clicks'))} AS click_through_rate
  FROM (SELECT {EVENT_KEYS}, {COUNTS},
      {', '.join(f"count(*) FILTER (WHERE type = '{t}') AS {t}" for t in ('click', 'error', 'purchase', 'signup'))}
    FROM inventory WHERE campaign_id IS NOT NULL AND device_type IS NOT NULL AND game_key LIKE '%/%' GROUP BY ALL)
  WHERE n_impressions >= 1"""

CAMPAIGN_KPI = f"""SELECT campaign_id, {r6('100 * ' + raw_rate('n_engagements'))} AS "ER", {r6('100 * ' + raw_rate('n_clicks'))} AS "CTR"
  FROM (SELECT campaign_id, {COUNTS} FROM inventory WHERE campaign_id IS NOT NULL GROUP BY campaign_id)"""

LEGACY = """SELECT md5('design-' || l_linestatus || l_suppkey % 10) || '/' || lpad(CAST(l_suppkey AS VARCHAR), 20, '0') AS game_key,
    coalesce(string_agg('label' || l_linenumber, ',' ORDER BY l_linenumber) FILTER (WHERE discount >= 0.1), '') AS labels_engagement,
    coalesce(string_agg('label' || l_linenumber, ',' ORDER BY l_linenumber) FILTER (WHERE least <= 1), '') AS labels_click_through,
    coalesce(string_agg('text' || l_linenumber, ',' ORDER BY l_linenumber) FILTER (WHERE n % 2 = 0), '') AS text_engagement,
    coalesce(string_agg('text' || l_linenumber, ',' ORDER BY l_linenumber) FILTER (WHERE n % 3 = 0), '') AS text_click_through,
    string_agg(CASE WHEN l_suppkey % 4 = 3 THEN 'c' ELSE '' END || l_linenumber, ',' ORDER BY l_linenumber) AS color_engagement,
    '' AS color_click_through, CAST(sum(n) % 2 AS INTEGER) AS video_data,
    CASE l_suppkey % 3 WHEN 0 THEN 'up' WHEN 1 THEN 'left' END AS direction
  FROM color_lines GROUP BY l_suppkey, l_linestatus"""

UNSEEN = f"""SELECT doc_id, CASE WHEN lang IN (SELECT lang FROM known) THEN lang ELSE 'unknown' END AS lang,
    CASE WHEN source IN (SELECT source FROM known) THEN source ELSE 'unknown' END AS source,
    CAST(CASE WHEN d.lang IN (SELECT lang FROM known) THEN {code_of('d.lang', 'SELECT lang AS v FROM known')}
         ELSE (SELECT count(DISTINCT lang) FROM known) END AS INTEGER) AS lang_enc,
    CAST(CASE WHEN d.source IN (SELECT source FROM known) THEN {code_of('d.source', 'SELECT source AS v FROM known')}
         ELSE (SELECT count(DISTINCT source) FROM known) END AS INTEGER) AS source_enc
  FROM documents d"""


def encoding_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT coalesce({c}, 'unknown') AS value FROM linked)" for c in MATRIX_CATEGORIES)


IMAGE_DEFAULTS = {
    "brightness_mean": 0.5, "saturation_mean": 0.0, "colorfulness": 0.0, "visual_entropy": 0.0,
    "is_dark_background": 0.0, "is_light_background": 0.0,
}


def thumbnail_sql() -> tuple[str, str]:
    """Colour buckets of 64x64 thumbnails of the 7x3 images, across and then down."""
    def kernel(name: str, n: int) -> str:
        return f"""{name} AS (
      SELECT out, tap, w * 4194304 / sum(w) OVER (PARTITION BY out) AS steps FROM (
        SELECT out, tap, CASE WHEN d < 1 THEN 1.5 * d ** 3 - 2.5 * d ** 2 + 1
            WHEN d < 2 THEN -0.5 * d ** 3 + 2.5 * d ** 2 - 4 * d + 2 ELSE 0 END AS w
        FROM (SELECT o AS out, t AS tap, abs(t + 0.5 - (o + 0.5) * ({n}::DOUBLE / 64)) AS d
          FROM range(64) AS a(o), range({n}) AS b(t)
          WHERE t >= floor(greatest((o + 0.5) * ({n}::DOUBLE / 64) - 1.5, 0))
            AND t < floor((o + 0.5) * ({n}::DOUBLE / 64) + 2.5)))),
    {name}_steps AS (SELECT out, tap, CAST(trunc(steps + 0.5 * sign(steps)) AS BIGINT) AS w FROM {name})"""

    def added(c: str) -> str:
        return f"CAST(greatest(0, least(255, floor((sum(w * {c}) + 2097152) / 4194304.0))) AS BIGINT) AS {c}"

    channels = ", ".join(added(c) for c in "rgb")
    bucket = "least(r * 4 // 255, 3) * 16 + least(g * 4 // 255, 3) * 4 + least(b * 4 // 255, 3)"
    return f"""SELECT CAST(vec_id AS VARCHAR) AS origin,
        CAST(count(DISTINCT {bucket}) AS DOUBLE) / 64 AS color_diversity_score
      FROM (SELECT vec_id, a.x, k.out, {channels}
        FROM (SELECT vec_id, p // 7 AS y, k.out AS x, {channels}
          FROM pixels JOIN across_steps k ON k.tap = p % 7 WHERE vec_id % 50 <> 7 GROUP BY ALL) a
        JOIN down_steps k ON k.tap = a.y GROUP BY ALL)
      GROUP BY vec_id""", f"{kernel('across', 7)},\n{kernel('down', 3)}"


def image_sql() -> str:
    columns = ", ".join(
        f"CASE WHEN vec_id % 50 = 7 THEN {v}::DOUBLE ELSE {r6(c)} END AS {c}" for c, v in IMAGE_DEFAULTS.items())
    size = ", ".join(
        f"CASE WHEN vec_id % 50 = 7 THEN {bad}::DOUBLE ELSE {good}::DOUBLE END AS {c}" for c, bad, good in (
            ("aspect_ratio", 1.0, 2.333333), ("image_width", 0.0, 7.0), ("image_height", 0.0, 3.0)))
    return f"SELECT vec_id, {size}, {columns} FROM pixel_stats JOIN entropy USING (vec_id)"


CREATIVE_DOUBLES = VISION_MEASURES
PARSED_DAYS = days("startdate", "enddate")

ORACLE: dict[str, str] = {
    "briefing_latest": sql(rounded_all("briefing", CAMPAIGN_DOUBLES, ["submission_date", "startdate", "enddate"])),
    "inventory_clean": sql("SELECT event_id, type, game_key, campaign_id, browser_ts FROM inventory"),
    "vision_rows": sql(rounded_all("vision", [*VISION_MEASURES, "file_size_kb", *COMPONENTS])),
    "asset_registry": sql("SELECT * FROM assets ORDER BY filename"),
    "column_scan": "SELECT p_partkey, p_brand FROM part",
    "event_union": "SELECT event_id, event_type, CASE WHEN event_type <> 'view' THEN round(value, 6) + 0.0 END AS value FROM events",
    "game_key_parts": sql("""SELECT event_id,
        CASE WHEN game_key LIKE '%/%' THEN split_part(game_key, '/', 1) ELSE game_key END AS creative_slug,
        CASE WHEN game_key LIKE '%/%' THEN split_part(game_key, '/', 2) END AS creative_request_id,
        CASE WHEN game_key LIKE '%/%' THEN replace(game_key, '/', '-') ELSE game_key || '-' END || '.png' AS image_filename
      FROM inventory"""),
    "briefing_projection": sql("SELECT campaign_id AS campaign, kpis, currency FROM raw_briefing"),
    "campaign_durations": sql(f"""SELECT submission_id, CAST(startdate AS DATE) AS startdate, CAST(enddate AS DATE) AS enddate,
        CAST({PARSED_DAYS} AS INTEGER) AS days
      FROM (SELECT submission_id, {day_first('startdate')} AS startdate, {day_first('enddate')} AS enddate FROM raw_briefing)"""),
    "feature_categories": sql("SELECT DISTINCT feature_name, category FROM importances"),
    "design_flat": sql(rounded_all("design", DESIGN_DOUBLES)),
    "design_legacy": sql(LEGACY),
    "design_keys": sql("SELECT md5_game_key || '/' || request_id AS game_key FROM design"),
    "images_to_design": sql("""SELECT a.filename, a.request_id, d.md5_game_key, d.color_diversity, d.interaction_direction
      FROM assets a LEFT JOIN design d USING (request_id)"""),
    "image_match_rate": sql("""SELECT count(d.md5_game_key) AS n_matched, count(*) AS n_rows,
        round(count(d.md5_game_key) / count(*), 6) + 0.0 AS match_rate
      FROM assets a LEFT JOIN design d USING (request_id)"""),
    "linked_dataset": sql(
        "SELECT * REPLACE (CAST(campaign_duration_days AS INTEGER) AS campaign_duration_days) FROM ("
        + rounded_all("linked", [*RATES, *DESIGN_DOUBLES, *CAMPAIGN_DOUBLES], ["startdate", "enddate"]) + ")"),
    "vision_join": sql(f"""SELECT {EVENT_KEYS}, md5_game_key, image_filename,
        {r6_as('aspect_ratio', 'brightness_mean', 'file_size_kb', 'vision_pca_0', 'vision_pca_31')} FROM vision_linked"""),
    "linked_from_warehouse": sql(f"""SELECT m.campaign_id, m.game_key, device_type, platform_os, geo_country,
        n_impressions, n_engagements, n_clicks, {r6_as(*RATES)},
        c.creative_slug, c.creative_request_id, c.image_filename, campaign_name, campaign_objectives,
        CAST(startdate AS DATE) AS startdate, CAST(enddate AS DATE) AS enddate, currency, {r6_as(*CAMPAIGN_DOUBLES)},
        CAST({PARSED_DAYS} AS INTEGER) AS campaign_duration_days,
        n_engagement_labels, n_click_through_labels, engagement_labels_text, n_engagement_texts, n_click_through_texts,
        engagement_text_content, {', '.join(f'{r6("d." + c)} AS {c}' for c in DESIGN_DOUBLES)},
        color_diversity, d.has_video, interaction_direction
      FROM metrics m LEFT JOIN creatives c ON c.game_key = m.game_key
      LEFT JOIN campaigns b ON b.campaign_id = m.campaign_id
      LEFT JOIN design d ON d.request_id = c.creative_request_id
      ORDER BY m.campaign_id, m.game_key"""),
    "creative_dimension": sql(rounded_all("creatives", CREATIVE_DOUBLES)),
    "campaign_dimension": sql(rounded_all("campaigns", CAMPAIGN_DOUBLES, ["startdate", "enddate"])),
    "metric_orphans": sql(rounded_all("metrics", RATES) + " WHERE campaign_id NOT IN (SELECT campaign_id FROM campaigns)"),
    "key_overlap": sql("""SELECT
        count(DISTINCT k) FILTER (WHERE s = 'l') AS n_left, count(DISTINCT k) FILTER (WHERE s = 'r') AS n_right,
        count(DISTINCT k) FILTER (WHERE s = 'l' AND k IN (SELECT request_id FROM design)) AS n_both
      FROM (SELECT 'l' AS s, split_part(game_key, '/', 2) AS k FROM inventory WHERE game_key LIKE '%/%'
            UNION ALL SELECT 'r', request_id FROM design)"""),
    "distinct_keys": sql("SELECT DISTINCT game_key FROM inventory"),
    "vision_first": sql(f"SELECT filename, vec_id, {r6_as('brightness_mean', 'file_size_kb')} FROM vision_files"),
    "creative_kpis": sql(rounded_all("kpis", RATES)),
    "creative_kpis_null_keys": sql(NULL_KEY_KPIS),
    # the log is stored in the order of its ids
    "event_preview": sql("""SELECT event_id, game_key, type, device_type, platform_os, geo_country
      FROM raw_inventory WHERE event_id IN (SELECT event_id FROM events ORDER BY event_id LIMIT 1000)"""),
    "creative_kpis_pivot": sql(PIVOT),
    "creative_metrics": sql(rounded_all("metrics", RATES)),
    "campaign_kpis": sql(CAMPAIGN_KPI),
    "kpi_profile": sql(f"""SELECT count(*) AS n_rows, CAST(12 AS BIGINT) AS n_columns, count(DISTINCT campaign_id) AS n_campaigns,
        count(DISTINCT game_key) AS n_game_keys, count(DISTINCT creative_slug) AS n_slugs,
        {r6('avg(engagement_rate)')} AS er_mean, {r6('avg(click_through_rate)')} AS ctr_mean,
        {r6('stddev_samp(engagement_rate)')} AS er_std, {r6('stddev_samp(click_through_rate)')} AS ctr_std FROM kpis"""),
    "top_game_keys": sql("SELECT game_key, count(*) AS n FROM inventory GROUP BY game_key ORDER BY n DESC, game_key LIMIT 5"),
    "table_rows": sql("""SELECT 'campaigns' AS table_name, count(*) AS n_rows FROM campaigns
      UNION ALL SELECT 'creatives', count(*) FROM creatives
      UNION ALL SELECT 'creative_metrics', count(*) FROM metrics
      UNION ALL SELECT 'model_benchmarks', count(*) FROM benchmarks
      UNION ALL SELECT 'feature_importances', count(*) FROM importances"""),
    "run_history": sql(rounded_all("benchmarks", ["mae", "rmse", "r2", "mape"], ["run_timestamp"])),
    "importance_history": sql(rounded_all("importances", ["importance_score"], ["run_timestamp"])),
    "latest_run_time": sql("SELECT CAST(max(run_timestamp) AS DATE) AS run_timestamp FROM benchmarks"),
    "latest_multimodal": sql(rounded_all("benchmarks", ["mae", "rmse", "r2", "mape"], ["run_timestamp"])
                             + " WHERE model_name = 'multimodal' ORDER BY benchmarks.run_timestamp DESC LIMIT 1"),
    "latest_benchmarks": sql(f"""SELECT model_name, {r6('r2', 4)} AS r2, {r6('mae', 4)} AS mae, {r6('mape', 2)} AS mape,
        n_features FROM latest_bench"""),
    "top_features_10": sql(top_features(10)),
    "top_features_15": sql(top_features(15)),
    "dashboard_stats": sql(f"""SELECT CAST((SELECT coalesce(sum(n_impressions), 0) FROM metrics) AS BIGINT) AS total_impressions,
        (SELECT count(*) FROM creatives) AS total_creatives, (SELECT count(*) FROM campaigns) AS total_campaigns,
        (SELECT {r6('r2', 4)} FROM latest_bench WHERE model_name = 'multimodal') AS multimodal_r2"""),
    "model_summary": sql(f"""SELECT model_name, {r6('mae', 4)} AS mae, {r6('rmse', 4)} AS rmse, {r6('r2', 4)} AS r2,
        {r6('mape', 2)} AS mape, n_features FROM latest_bench ORDER BY model_name"""),
    "benchmark_long": sql(" UNION ALL ".join(
        f"SELECT upper(model_name[1]) || model_name[2:] AS model, '{m}' AS metric, {r6(e)} AS value FROM latest_bench"
        for m, e in (("MAE", "mae"), ("RMSE", "rmse"), ("MAPE", "mape / 100"), ("R2", "r2")))),
    "heuristic_scores": sql(HEURISTIC),
    "target_correlations": sql(correlations()),
    "regression_metrics": sql(metric_columns("predictions", "model, fold")),
    "fold_summary": sql(summary_columns("predictions")),
    "mean_importance": sql(f"SELECT model, feature, {r6('sum(importance) / 5')} AS importance FROM predictions GROUP BY model, feature"),
    "group_folds": sql("SELECT l.doc_id, l.source, f.fold FROM labelled l JOIN folds f ON f.grp = l.source", SOURCE_FOLDS),
    "group_fold_sizes": sql("""SELECT fold, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_groups,
        CAST(0 AS BIGINT) AS n_shared FROM folds GROUP BY fold""", USER_FOLDS),
    "baseline_predictions": sql(f"SELECT model, fold, y, {r6('prediction')} AS prediction FROM baseline_oof", SOURCE_FOLDS),
    "baseline_benchmark": sql(summary_columns("baseline_oof"), SOURCE_FOLDS),
    "label_encoding": sql(encoding_sql()),
    "document_encoding": """SELECT doc_id, lang, source,
        CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS lang_enc,
        CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER) AS source_enc FROM documents""",
    "unseen_encoding": sql(UNSEEN),
    "feature_medians": sql(medians()),
    "feature_matrix": sql(matrix_sql()),
    "pixel_measures": sql(f"""SELECT vec_id, n_pixels, {r6_as('brightness_mean', 'saturation_mean', 'colorfulness',
        'visual_entropy', 'color_diversity_score')}, is_dark_background, is_light_background
      FROM pixel_stats JOIN entropy USING (vec_id)"""),
    "image_measures": sql(image_sql()),
    "image_color_diversity": sql(*thumbnail_sql()),
    "standardized_embeddings": f"""SELECT vec_id, dim, {r6('''CASE WHEN stddev_pop(x) OVER (PARTITION BY dim) > 0
        THEN (x - avg(x) OVER (PARTITION BY dim)) / stddev_pop(x) OVER (PARTITION BY dim) ELSE 0.0 END''')} AS value
      FROM (SELECT vec_id, CAST(dim AS INTEGER) AS dim, CAST(embedding[dim + 1] AS DOUBLE) AS x
        FROM embeddings, range(64) AS t(dim))""",
    "ridge_predictions": sql(RIDGE),
    "ridge_cross_validation": sql(summary_columns("ridge_oof"), SOURCE_FOLDS + ",\n" + RIDGE_FOLDS),
    "component_norms": f"""SELECT vec_id, {r6('sum(z * z)')} AS norm FROM (
      SELECT vec_id, (x - avg(x) OVER (PARTITION BY dim)) / stddev_pop(x) OVER (PARTITION BY dim) AS z
      FROM (SELECT vec_id, dim, CAST(embedding[dim + 1] AS DOUBLE) AS x FROM embeddings, range(64) AS t(dim)))
    GROUP BY vec_id""",
    "ctr_fallback": sql(f"""SELECT {EVENT_KEYS}, {r6('''coalesce(
          CASE WHEN n_clicks > 0 AND n_impressions > 0 THEN least(1.0, n_clicks / n_impressions) END,
          CASE WHEN n_impressions > 0 THEN least(1.0, n_engagements / n_impressions) END * 0.1, 0.0)''')} AS ctr
      FROM (SELECT {EVENT_KEYS}, {COUNTS} FROM inventory GROUP BY ALL)"""),
    # one boosting round: best single split by the regularised gain, minimum of 10 rows a side
    "boosted_round": f"""
      WITH rows AS (
        SELECT doc_id, quality - avg(quality) OVER () AS rest, avg(quality) OVER () AS base,
          CAST(n_chars AS DOUBLE) AS n_chars, CAST(toxic AS DOUBLE) AS toxic
        FROM documents JOIN labels USING (doc_id)),
      long AS (
        SELECT doc_id, 'n_chars' AS feature, n_chars AS x, rest FROM rows
        UNION ALL SELECT doc_id, 'toxic', toxic, rest FROM rows),
      cuts AS (
        SELECT 'n_chars' AS feature, 100.0 * 2 ** i AS cut FROM range(8) AS t(i)
        UNION ALL SELECT 'toxic', 0.0),
      sides AS (
        SELECT feature, cut, x <= cut AS low, sum(rest) AS g, count(*) AS n
        FROM long JOIN cuts USING (feature) GROUP BY ALL HAVING count(*) >= 10),
      best AS (
        SELECT feature, cut FROM sides GROUP BY ALL HAVING count(*) = 2
        ORDER BY sum(greatest(abs(g) - 0.1, 0) ** 2 / (n + 0.1)) DESC, feature, cut LIMIT 1),
      leaves AS (
        SELECT feature, cut, low, 0.05 * sign(g) * greatest(abs(g) - 0.1, 0) / (n + 0.1) AS value
        FROM sides JOIN best USING (feature, cut))
      SELECT doc_id, {r6('base + value')} AS prediction
      FROM rows JOIN leaves ON low = (CASE feature WHEN 'toxic' THEN toxic ELSE n_chars END <= cut)""",
}
