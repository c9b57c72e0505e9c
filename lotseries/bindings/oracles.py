"""DuckDB SQL for the queries, written from the rules rather than from the Spark plans.

Views are named blocks that may build on each other; ``_sql`` puts the blocks a
statement needs in front of it.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

# Limits of the cycle rules and reports.
CYCLE_GAP = 548
RENOVATION_AGE = 200
LOW_NDVI = 0.2
CYCLE_ROWS = 7
CYCLE_AGE = 150
REPORT_AGE = 300
GROWTH_CYCLES = 2

# --- inputs ---------------------------------------------------------------------------

VIEWS["bands"] = """
SELECT CAST(o_custkey AS VARCHAR) AS lot_id, CAST(l_shipdate AS DATE) AS obs_date,
       max(l_extendedprice) AS nir, max(l_quantity) * 500 AS red,
       max(l_quantity) * (max(l_discount) * 5000 + 200) AS swir,
       max(l_tax) AS noise, max(l_suppkey) AS part
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""

VIEWS["seasons"] = """
SELECT *, CASE WHEN month(obs_date) IN (11, 12) THEN year(obs_date) || '_' || (year(obs_date) + 1)
               ELSE (year(obs_date) - 1) || '_' || year(obs_date) END AS season
FROM (SELECT lot_id, obs_date, round((nir - red) / (nir + red), 4) AS ndvi_ref, noise,
             'S2A_' || part || '_' || strftime(obs_date, '%Y%m%d') AS image_id FROM bands)"""

VIEWS["obs"] = """
SELECT lot_id, obs_date, image_id, season, lot_id || '_' || season AS lot_season, ndvi_ref,
       CASE WHEN noise < 0.08 THEN ndvi_ref * 0.83 + noise END AS ndvi_corrected
FROM seasons"""

VIEWS["yields"] = """
SELECT lot, 'Zafra ' || y || '-' || (y + 1) AS season, status,
       strftime(min(o_orderdate), '%d/%m/%Y') AS harvest, max(o_totalprice) AS tch,
       lot || '_' || y || '_' || (y + 1) AS lot_season
FROM (SELECT CAST(o_custkey AS VARCHAR) AS lot, o_orderstatus AS status, o_orderdate, o_totalprice,
             year(o_orderdate + INTERVAL 2 MONTH) - 1 AS y
      FROM orders WHERE o_orderstatus IN ('F', 'P'))
GROUP BY lot, y, status"""

VIEWS["master"] = """
SELECT o.*, y.season AS report_season, y.harvest, y.tch,
       CAST(strptime(y.harvest, '%d/%m/%Y') AS DATE) AS harvest_day
FROM obs o LEFT JOIN yields y USING (lot_season)"""

# --- rules by season ------------------------------------------------------------------

VIEWS["known_lag"] = """
SELECT lot_id, season, max(previous) AS previous FROM (
  SELECT lot_id, season,
         lag(harvest_day) OVER (PARTITION BY lot_id ORDER BY season, harvest_day) AS previous
  FROM (SELECT DISTINCT lot_id, season, harvest_day FROM master WHERE harvest IS NOT NULL))
GROUP BY ALL"""

VIEWS["season_lag"] = """
SELECT lot_id, season, max(previous) AS previous FROM (
  SELECT lot_id, season,
         lag(harvest_day) OVER (PARTITION BY lot_id ORDER BY season, harvest_day NULLS LAST) AS previous
  FROM (SELECT DISTINCT lot_id, season, harvest_day FROM master))
GROUP BY ALL"""

VIEWS["ratoon"] = """
SELECT m.lot_id, m.obs_date, m.season, m.harvest,
       CAST(CASE WHEN m.harvest IS NULL THEN NULL
                 WHEN m.obs_date > m.harvest_day THEN m.obs_date - m.harvest_day
                 ELSE m.obs_date - l.previous END AS INTEGER) AS crop_age_days
FROM master m LEFT JOIN season_lag l USING (lot_id, season)"""

VIEWS["gaps"] = """
SELECT a.lot_id, a.season
FROM (SELECT lot_id, season, CAST(season[1:4] AS INTEGER) AS y FROM master
      WHERE harvest IS NOT NULL GROUP BY ALL) a
JOIN (SELECT lot_id, list(DISTINCT CAST(season[1:4] AS INTEGER)) AS years FROM master
      WHERE harvest IS NOT NULL GROUP BY ALL) b USING (lot_id)
WHERE NOT list_contains(b.years, a.y - 1) AND a.y > list_min(b.years)"""

# --- cycles by as-of joins ------------------------------------------------------------

VIEWS["harvest_days"] = "SELECT DISTINCT lot_id, harvest_day FROM master WHERE harvest IS NOT NULL"

VIEWS["ended"] = """
SELECT m.*, h.harvest_day AS cycle_end
FROM master m ASOF LEFT JOIN harvest_days h
  ON m.lot_id = h.lot_id AND m.obs_date <= h.harvest_day"""

VIEWS["end_days"] = "SELECT DISTINCT lot_id, cycle_end AS previous_end FROM ended WHERE cycle_end IS NOT NULL"

VIEWS["started"] = """
SELECT e.*, p.previous_end
FROM ended e ASOF LEFT JOIN end_days p
  ON e.lot_id = p.lot_id AND coalesce(e.cycle_end, DATE '9999-12-31') > p.previous_end"""

VIEWS["aged"] = f"""
SELECT * EXCLUDE (previous_end), coalesce(cycle_end - previous_end > {CYCLE_GAP}, FALSE) AS data_gap,
       CASE WHEN NOT coalesce(cycle_end - previous_end > {CYCLE_GAP}, FALSE)
            THEN CAST(obs_date - previous_end AS INTEGER) END AS crop_age_days
FROM started"""

# renovations by day: a suspect day belongs to the event numbered by the starts up to it
VIEWS["open_days"] = """
SELECT lot_id, obs_date, min(ndvi_ref) AS lowest, max(crop_age_days) AS age,
       CASE WHEN count(*) = count(ndvi_ref) THEN max(ndvi_ref) END AS closing_value
FROM aged WHERE cycle_end IS NULL AND NOT data_gap GROUP BY lot_id, obs_date"""

VIEWS["suspects"] = f"""
SELECT d.lot_id, d.obs_date, p.closing_value AS eve
FROM open_days d ASOF LEFT JOIN open_days p ON d.lot_id = p.lot_id AND d.obs_date > p.obs_date
WHERE d.age > {RENOVATION_AGE} AND d.lowest < {LOW_NDVI}"""

VIEWS["starts"] = f"SELECT lot_id, obs_date FROM suspects WHERE eve IS NULL OR eve >= {LOW_NDVI}"

VIEWS["renovations"] = """
SELECT lot_id, event_id, min(obs_date) AS renovation_date
FROM (SELECT s.lot_id, s.obs_date, CAST(count(t.obs_date) AS INTEGER) AS event_id
      FROM suspects s LEFT JOIN starts t ON t.lot_id = s.lot_id AND t.obs_date <= s.obs_date
      GROUP BY s.lot_id, s.obs_date)
GROUP BY lot_id, event_id"""

VIEWS["closed"] = """
SELECT a.* EXCLUDE (cycle_end, data_gap, crop_age_days),
       coalesce(a.cycle_end, r.renovation_date) AS cycle_end
FROM aged a ASOF LEFT JOIN renovations r
  ON a.lot_id = r.lot_id AND a.obs_date <= r.renovation_date"""

VIEWS["closed_ends"] = "SELECT DISTINCT lot_id, cycle_end AS previous_end FROM closed WHERE cycle_end IS NOT NULL"

VIEWS["reaged"] = f"""
SELECT c.*, coalesce(c.cycle_end - p.previous_end > {CYCLE_GAP}, FALSE) AS data_gap,
       CASE WHEN NOT coalesce(c.cycle_end - p.previous_end > {CYCLE_GAP}, FALSE)
            THEN CAST(c.obs_date - p.previous_end AS INTEGER) END AS crop_age_days
FROM closed c ASOF LEFT JOIN closed_ends p
  ON c.lot_id = p.lot_id AND coalesce(c.cycle_end, DATE '9999-12-31') > p.previous_end"""

VIEWS["good_cycles"] = f"""
SELECT lot_id, cycle_end, TRUE AS good FROM reaged
WHERE cycle_end IS NOT NULL AND crop_age_days IS NOT NULL
GROUP BY ALL HAVING count(*) >= {CYCLE_ROWS} AND max(crop_age_days) >= {CYCLE_AGE}"""

VIEWS["cycles"] = """
SELECT r.*, coalesce(g.good, FALSE) AS valid_cycle
FROM reaged r LEFT JOIN good_cycles g USING (lot_id, cycle_end)"""

VIEWS["dataset"] = "SELECT * FROM cycles WHERE valid_cycle AND harvest IS NOT NULL"

VIEWS["renovated"] = f"""
SELECT lot_id, harvest, min(obs_date) AS renovation_date, min(crop_age_days) AS age_at_renovation,
       min(ndvi_ref) AS min_ndvi_ref
FROM cycles WHERE NOT data_gap AND crop_age_days > {REPORT_AGE} AND ndvi_ref < {LOW_NDVI} GROUP BY ALL"""

VIEWS["asked"] = """
SELECT CAST(c_custkey AS VARCHAR) AS lot_id FROM customer WHERE c_mktsegment = 'BUILDING'"""

VIEWS["history"] = """
SELECT lot_id, obs_date, ndvi_ref, crop_age_days, cycle_end FROM cycles
WHERE ndvi_ref IS NOT NULL AND lot_id IN (SELECT lot_id FROM asked)"""

VIEWS["growing"] = f"""
SELECT lot_id, count(DISTINCT harvest) AS cycles FROM cycles
WHERE crop_age_days IS NOT NULL AND harvest IS NOT NULL AND ndvi_corrected IS NOT NULL
GROUP BY lot_id HAVING count(DISTINCT harvest) >= {GROWTH_CYCLES}"""

VIEWS["drawn"] = """
SELECT lot_id, harvest, renovation_date, age_at_renovation FROM renovated
ORDER BY md5('42|' || lot_id || '|' || coalesce(harvest, '~')) LIMIT 50"""

VIEWS["renovated_history"] = """
SELECT lot_id, harvest, obs_date, crop_age_days, ndvi_ref FROM cycles
WHERE NOT data_gap AND ndvi_ref IS NOT NULL AND lot_id IN (SELECT lot_id FROM renovated)"""

VIEWS["marked"] = f"""
SELECT kind, lot_id, cycle_end, obs_date, ndvi_ref, crop_age_days
FROM (SELECT *, CASE WHEN harvest IS NULL THEN 'detected' ELSE 'before_harvest' END AS kind
      FROM cycles
      WHERE NOT data_gap AND crop_age_days > {RENOVATION_AGE} AND ndvi_ref < {LOW_NDVI} AND cycle_end IS NOT NULL
        AND (harvest IS NULL OR obs_date < cycle_end) AND lot_id IN (SELECT lot_id FROM asked))
QUALIFY row_number() OVER (PARTITION BY kind, lot_id, cycle_end ORDER BY obs_date, ndvi_ref, crop_age_days) = 1"""

VIEWS["event_values"] = """
SELECT r.lot_id, r.harvest, r.renovation_date, round(v.ndvi_ref, 4) AS ndvi, v.crop_age_days AS age
FROM renovated r LEFT JOIN (
  SELECT * FROM renovated_history
  QUALIFY row_number() OVER (PARTITION BY lot_id, obs_date ORDER BY ndvi_ref, crop_age_days) = 1) v
  ON v.lot_id = r.lot_id AND v.obs_date = r.renovation_date
WHERE r.harvest IS NOT NULL"""

VIEWS["growing_rows"] = """
SELECT lot_id, crop_age_days, ndvi_corrected, ndvi_ref, harvest, obs_date, image_id FROM cycles
WHERE crop_age_days IS NOT NULL AND ndvi_corrected IS NOT NULL AND lot_id IN (SELECT lot_id FROM growing)"""

# --- two sources ----------------------------------------------------------------------

VIEWS["ref_source"] = """
SELECT lot_id, obs_date, CAST(year(obs_date) AS INTEGER) AS year, (nir - red) / (nir + red) AS ndvi,
       (nir - swir) / (nir + swir) AS ndwi11, swir / nir AS msi11 FROM bands"""

VIEWS["stac_source"] = """
SELECT lot_id, obs_date, 'S2A_' || part AS image_id,
       (nir - red) / (nir + red) * 1.1 + noise AS ndvi,
       (nir - swir) / (nir + swir) * 1.05 - noise AS ndwi11,
       swir / nir * 1.2 + noise AS msi11 FROM bands"""

VIEWS["clean_ref"] = """
SELECT * REPLACE (if(abs(ndvi) <= 1, ndvi, NULL) AS ndvi, if(abs(ndwi11) <= 1, ndwi11, NULL) AS ndwi11,
                  if(msi11 >= 0 AND msi11 <= 10, msi11, NULL) AS msi11) FROM ref_source"""

VIEWS["clean_stac"] = """
SELECT * REPLACE (if(abs(ndvi) <= 1, ndvi, NULL) AS ndvi, if(abs(ndwi11) <= 1, ndwi11, NULL) AS ndwi11,
                  if(msi11 >= 0 AND msi11 <= 10, msi11, NULL) AS msi11) FROM stac_source"""

VIEWS["matched"] = """
SELECT r.lot_id, r.obs_date, r.year, s.image_id,
       r.ndvi AS ndvi_ref, r.ndwi11 AS ndwi11_ref, r.msi11 AS msi11_ref,
       s.ndvi AS ndvi_stac, s.ndwi11 AS ndwi11_stac, s.msi11 AS msi11_stac
FROM clean_ref r JOIN clean_stac s ON r.lot_id = s.lot_id AND r.obs_date = s.obs_date"""

VIEWS["long_pairs"] = """
SELECT 'ndvi' AS "index", year, ndvi_stac AS x, ndvi_ref AS y FROM matched
UNION ALL SELECT 'ndwi11', year, ndwi11_stac, ndwi11_ref FROM matched
UNION ALL SELECT 'msi11', year, msi11_stac, msi11_ref FROM matched"""

VIEWS["pairs"] = "SELECT * FROM long_pairs WHERE x IS NOT NULL AND y IS NOT NULL"

VIEWS["folds"] = """
SELECT f.index, f.year, regr_slope(p.y, p.x) AS slope, regr_intercept(p.y, p.x) AS intercept
FROM (SELECT DISTINCT index, year FROM pairs) f
JOIN pairs p ON p.index = f.index AND p.year <> f.year GROUP BY ALL"""

VIEWS["fold_scores"] = """
SELECT index, year, count(*) AS n, slope, intercept,
       1 - sum((y - slope * x - intercept) ** 2) / (var_pop(y) * count(*)) AS r2,
       avg(abs(y - slope * x - intercept)) AS mae
FROM pairs JOIN folds USING (index, year) GROUP BY ALL"""

VIEWS["holdout_line"] = """
SELECT index, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept
FROM pairs WHERE year <> 2000 GROUP BY ALL"""

VIEWS["holdout_scores"] = """
SELECT index, slope, intercept, year = 2000 AS test, count(*) AS n,
       1 - sum((y - slope * x - intercept) ** 2) / (var_pop(y) * count(*)) AS r2,
       avg(abs(y - slope * x - intercept)) AS mae
FROM pairs JOIN holdout_line USING (index) GROUP BY ALL"""

# robust line by reweighting; label 0 trains on all years, label y on all years but y
VIEWS["huber_rows"] = """
SELECT CAST(label AS INTEGER) AS label, x, y FROM pairs, (SELECT DISTINCT year AS label FROM pairs UNION ALL SELECT 0)
WHERE index = 'msi11' AND year <> label"""

VIEWS["huber_0"] = """
SELECT label, regr_slope(y, x) AS a, regr_intercept(y, x) AS b,
       sqrt(var_pop(y) * (1 - regr_r2(y, x))) AS s FROM huber_rows GROUP BY label"""

HUBER_STEPS = 40
for _k in range(HUBER_STEPS):
    VIEWS[f"huber_{_k + 1}"] = f"""
SELECT label, a, my - a * mx AS b, new_s AS s FROM (
  SELECT label, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my,
         (sum(w * x * y) - sum(w * x) * sum(w * y) / sum(w))
           / (sum(w * x * x) - sum(w * x) ** 2 / sum(w) + 1e-4 * any_value(s)) AS a,
         sqrt(sum(r * r) FILTER (w = 1) / (count(*) - 1.8225 * count(*) FILTER (w < 1))) AS new_s
  FROM (SELECT label, x, y, s, y - a * x - b AS r, least(1, 1.35 * s / abs(y - a * x - b)) AS w
        FROM huber_rows JOIN huber_{_k} USING (label)) GROUP BY label)"""

VIEWS["huber_scores"] = f"""
SELECT l.label, p.year = l.label AS test, p.year, a AS slope, b AS intercept, y, y - a * x - b AS r
FROM pairs p, huber_{HUBER_STEPS} l WHERE p.index = 'msi11'"""

VIEWS["corrected"] = """
SELECT *, ndvi_corrected - ndvi_ref AS ndvi_diff, ndwi11_corrected - ndwi11_ref AS ndwi11_diff,
       msi11_corrected - msi11_ref AS msi11_diff
FROM (SELECT lot_id, obs_date, year, image_id, ndvi_ref, ndwi11_ref, msi11_ref,
             0.8334753900735666::DOUBLE * ndvi_stac + 0.0069342589939932475::DOUBLE AS ndvi_corrected,
             0.8970826750876867::DOUBLE * ndwi11_stac + 0.10129756238928883::DOUBLE AS ndwi11_corrected,
             0.7499135531008353::DOUBLE * msi11_stac + 0.05783716382847559::DOUBLE AS msi11_corrected
      FROM matched)"""

# --- rasters --------------------------------------------------------------------------

VIEWS["pixels"] = """
SELECT vec_id, label, CAST(vec_id // 25 * 8 + i // 8 AS INTEGER) AS "row",
       CAST(vec_id % 25 * 8 + i % 8 AS INTEGER) AS col,
       CAST(embedding[i + 1] AS DOUBLE) AS value, CAST(embedding[64 - i] AS DOUBLE) AS mirror
FROM embeddings, range(64) AS r(i)"""

VIEWS["lots"] = """
SELECT s_suppkey AS polygon_id, 'lot' || s_nationkey AS lot_id, s_suppkey * 37 % 200 + 0.13::DOUBLE AS x,
       (s_acctbal + 1000) / 11000 * 160 + 0.0137::DOUBLE AS y, s_nationkey / 4 + 3 AS w
FROM supplier"""

VIEWS["edges"] = """
SELECT polygon_id, lot_id, x + w * i1 AS x1, y + w * j1 AS y1, x + w * i2 AS x2, y + w * j2 AS y2
FROM lots, (VALUES (-1.0::DOUBLE, -1.0::DOUBLE, 1.0::DOUBLE, -1.0::DOUBLE), (1, -1, 1, 1),
                   (1, 1, 0, 0.3::DOUBLE), (0, 0.3::DOUBLE, -1, 1), (-1, 1, -1, -1),
                   (-0.25::DOUBLE, -0.7::DOUBLE, 0.25::DOUBLE, -0.7::DOUBLE), (0.25::DOUBLE, -0.7::DOUBLE, 0.25::DOUBLE, -0.2::DOUBLE),
                   (0.25::DOUBLE, -0.2::DOUBLE, -0.25::DOUBLE, -0.2::DOUBLE), (-0.25::DOUBLE, -0.2::DOUBLE, -0.25::DOUBLE, -0.7::DOUBLE),
                   (1.4::DOUBLE, -0.5::DOUBLE, 2.2::DOUBLE, -0.2::DOUBLE), (2.2::DOUBLE, -0.2::DOUBLE, 1.5::DOUBLE, 0.6::DOUBLE),
                   (1.5::DOUBLE, 0.6::DOUBLE, 1.4::DOUBLE, -0.5::DOUBLE)) AS c(i1, j1, i2, j2)"""

VIEWS["covered"] = """
SELECT e.polygon_id, e.lot_id, p.vec_id, p.label, p.row, p.col, p.value, p.mirror
FROM pixels p JOIN edges e
  ON (e.y1 > p.row) <> (e.y2 > p.row)
 AND p.col + 0.75 < e.x1 + (p.row - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
GROUP BY ALL HAVING count(*) % 2 = 1"""

# without a scene that lacks swir16 and one with a transform that can't be inverted
VIEWS["tile_scenes"] = """
SELECT tile, 'S2A_' || tile || '_0' AS scene_id, patches, tile % 100 * 40 + 0.25 AS x, tile // 100 * 40 - 0.5 AS y
FROM (SELECT CAST(vec_id // 125 * 100 + vec_id % 25 // 5 AS INTEGER) AS tile, count(*) AS patches
      FROM embeddings GROUP BY ALL)
WHERE patches < 100 AND tile NOT IN (102, 201)"""

# polygon against box: an edge crosses the box, or the polygon holds the box's corner
VIEWS["edge_in_tile"] = """
SELECT e.polygon_id, t.tile,
       bool_or(least(x1, x2) <= t.x + 40 AND greatest(x1, x2) >= t.x AND least(y1, y2) <= t.y + 40
               AND greatest(y1, y2) >= t.y
               AND least(c1, c2, c3, c4) <= 0 AND greatest(c1, c2, c3, c4) >= 0) AS cut,
       count(*) FILTER ((y1 > t.y) <> (y2 > t.y) AND t.x < x1 + (t.y - y1) * (x2 - x1) / nullif(y2 - y1, 0)) % 2 = 1 AS holds
FROM edges e, tile_scenes t,
     LATERAL (SELECT (x2 - x1) * (t.y - y1) - (y2 - y1) * (t.x - x1) AS c1,
                     (x2 - x1) * (t.y - y1) - (y2 - y1) * (t.x + 40 - x1) AS c2,
                     (x2 - x1) * (t.y + 40 - y1) - (y2 - y1) * (t.x - x1) AS c3,
                     (x2 - x1) * (t.y + 40 - y1) - (y2 - y1) * (t.x + 40 - x1) AS c4)
GROUP BY ALL"""

VIEWS["first_tile"] = "SELECT polygon_id, min(tile) AS tile FROM edge_in_tile WHERE cut OR holds GROUP BY ALL"

VIEWS["scene_cover"] = """
SELECT c.polygon_id, c.lot_id, f.tile, c.row, c.col, c.value + 0.4::DOUBLE AS nir, c.mirror + 0.2::DOUBLE AS red
FROM covered c JOIN first_tile f USING (polygon_id)
WHERE c.row // 40 * 100 + c.col // 40 = f.tile"""

VIEWS["corners"] = """
SELECT s.row, s.col, CASE WHEN i = 0 THEN 1 - (u - floor(u)) ELSE u - floor(u) END
                     * CASE WHEN j = 0 THEN 1 - (v - floor(v)) ELSE v - floor(v) END AS weight,
       floor(u) + i AS ccol, floor(v) + j AS crow, s.tile
FROM (SELECT DISTINCT tile, "row", col, (col % 40 + 0.5) / 2 - 0.5 AS u, ("row" % 40 + 0.5) / 2 - 0.5 AS v
      FROM scene_cover) s, range(2) a(i), range(2) b(j)"""

VIEWS["coarse"] = """
SELECT "row" // 40 * 100 + col // 40 AS tile, "row" % 40 // 2 AS crow, col % 40 // 2 AS ccol,
       value * 0.5 + 0.3::DOUBLE AS swir FROM pixels WHERE "row" % 2 = 0 AND col % 2 = 0"""

VIEWS["swir"] = """
SELECT c.tile, c.row, c.col, sum(weight * swir) / sum(weight) AS swir
FROM corners c JOIN coarse b ON b.tile = c.tile AND b.crow = c.crow AND b.ccol = c.ccol
GROUP BY ALL"""

VIEWS["scene_values"] = """
SELECT polygon_id, lot_id, c.tile, CASE WHEN nir > 0 AND red > 0 THEN (nir - red) / (nir + red) END AS ndvi,
       CASE WHEN nir > 0 AND swir > 0 THEN (nir - swir) / (nir + swir) END AS ndwi11,
       CASE WHEN nir > 0 AND swir > 0 THEN swir / nir END AS msi11
FROM scene_cover c LEFT JOIN swir USING (tile, "row", col)"""

# without the labels whose rasters fail: no pixels, a broken world file, no lot file
VIEWS["raster_rows"] = """
SELECT l.lot_id, l.polygon_id, (l.polygon_id % 10) AS label, c.value AS ndvi, c.mirror AS ndwi11,
       c.value * 2 + 1 AS msi11
FROM lots l LEFT JOIN covered c ON c.polygon_id = l.polygon_id AND c.label = l.polygon_id % 10
WHERE l.polygon_id % 10 NOT IN (3, 5, 9)"""


def _four(name: str, digits: int = 4) -> str:
    parts = {"mean": "avg", "max": "max", "min": "min", "std": "stddev_pop"}
    return ", ".join(f"round({f}({name}), {digits}) AS {name}_{s}" for s, f in parts.items())


VIEWS["raster_output"] = f"""
SELECT lot_id, strftime(DATE '2024-01-01' + CAST(label AS INTEGER), '%Y-%m-%d') AS obs_date,
       'sugar' AS image_id, {_four('ndvi')}, {_four('ndwi11')}, {_four('msi11')}
FROM raster_rows GROUP BY lot_id, label"""

# --- scenes ---------------------------------------------------------------------------

VIEWS["catalogue"] = """
SELECT 'S2A_' || (o_custkey % 50) || '_' || o_orderkey AS scene_id, o_orderkey AS pos,
       o_custkey % 50 AS tile, CAST(o_orderdate AS DATE) AS obs_date,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor(o_totalprice) % 101 AS DOUBLE) END AS cloud_cover,
       o_orderstatus <> 'P' AS has_all,
       o_custkey % 50 % 10 * 20.0::DOUBLE AS xmin, o_custkey % 50 // 10 * 32.0::DOUBLE AS ymin,
       o_custkey % 50 % 10 * 20.0::DOUBLE + 21 AS xmax, o_custkey % 50 // 10 * 32.0::DOUBLE + 33 AS ymax
FROM orders"""

VIEWS["boxes"] = """
SELECT polygon_id, lot_id, x + w * -1.0::DOUBLE AS xmin, y + w * -1.0::DOUBLE AS ymin,
       x + w * 2.2::DOUBLE AS xmax, y + w * 1.0::DOUBLE AS ymax FROM lots"""

VIEWS["lot_dates"] = "SELECT DISTINCT l_suppkey AS polygon_id, CAST(l_shipdate AS DATE) AS obs_date FROM lineitem"

VIEWS["bounds"] = """
SELECT obs_date, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
FROM boxes JOIN lot_dates USING (polygon_id) GROUP BY ALL"""

VIEWS["found"] = """
SELECT c.* FROM catalogue c JOIN bounds b ON b.obs_date = c.obs_date
WHERE c.cloud_cover < 100 AND c.xmin <= b.xmax AND b.xmin <= c.xmax AND c.ymin <= b.ymax AND b.ymin <= c.ymax"""

VIEWS["chosen"] = """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY obs_date, tile ORDER BY cloud_cover, pos) AS place,
         min(pos) OVER (PARTITION BY obs_date, tile) AS tile_order
  FROM found) WHERE place = 1 AND has_all"""

VIEWS["lot_tiles"] = """
SELECT d.obs_date, d.polygon_id, e.lot_id, t.scene_id, t.tile, t.tile_order,
       bool_or(least(x1, x2) <= t.xmax AND greatest(x1, x2) >= t.xmin AND least(y1, y2) <= t.ymax
               AND greatest(y1, y2) >= t.ymin
               AND least(c1, c2, c3, c4) <= 0 AND greatest(c1, c2, c3, c4) >= 0) AS cut,
       count(*) FILTER ((y1 > t.ymin) <> (y2 > t.ymin)
                        AND t.xmin < x1 + (t.ymin - y1) * (x2 - x1) / nullif(y2 - y1, 0)) % 2 = 1 AS holds
FROM lot_dates d JOIN edges e USING (polygon_id) JOIN chosen t USING (obs_date),
     LATERAL (SELECT (x2 - x1) * (ymin - y1) - (y2 - y1) * (xmin - x1) AS c1,
                     (x2 - x1) * (ymin - y1) - (y2 - y1) * (xmax - x1) AS c2,
                     (x2 - x1) * (ymax - y1) - (y2 - y1) * (xmin - x1) AS c3,
                     (x2 - x1) * (ymax - y1) - (y2 - y1) * (xmax - x1) AS c4)
GROUP BY ALL HAVING cut OR holds"""

# --- manifest -------------------------------------------------------------------------

VIEWS["files"] = """
SELECT 'Reference/' || year(day) || '-raster/batch' || (event_id % 7) || '/' || stem || suffix AS path,
       'batch' || (event_id % 7) AS parent, stem, suffix, strftime(day, '%Y%m%d') AS date, kind
FROM (SELECT event_id, day, prefix || strftime(day, '%Y%m%d') AS stem, suffix, kind
      FROM (SELECT event_id, event_type, CAST(ts AS DATE) + CAST(user_id * 30 AS INTEGER) AS day FROM events)
      JOIN (VALUES ('view', '01-NDVI_', '.tif', 'ndvi'), ('click', '02-NDWI-11_', '.tif', 'ndwi11'),
                   ('error', '04-MSI-11_', '.tif', 'msi11'), ('purchase', 'lots_', '.shp', 'lots'),
                   ('signup', 'readme_', '.TIF', NULL)) AS k(event_type, prefix, suffix, kind)
        USING (event_type))"""

VIEWS["by_date"] = """
SELECT date, max(path) FILTER (kind = 'ndvi') AS ndvi, max(path) FILTER (kind = 'ndwi11') AS ndwi11,
       max(path) FILTER (kind = 'msi11') AS msi11, max(path) FILTER (kind = 'lots') AS lots
FROM files WHERE kind IS NOT NULL GROUP BY ALL"""

# --- pages ----------------------------------------------------------------------------

VIEWS["lists"] = r"""
SELECT page_id, list_transform(regexp_extract_all(list_row, '(?is)<li[^>]*>(.*?)</li>', 1),
         lambda c: trim(replace(regexp_replace(c, '<[^>]+>', '', 'g'), chr(160), ' '))) AS cells
FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<ul[^>]*>(.*?)</ul>', 1)) AS list_row FROM pages)"""


VIEWS["report"] = """
SELECT o_orderkey AS pedido_n, o_custkey AS lote, strftime(o_orderdate, '%d/%m/%Y') AS cierre,
       o_totalprice AS produccion, nullif(o_orderstatus, 'O') AS col_4,
       CASE WHEN o_orderpriority = '5-LOW' THEN '7d' ELSE o_orderpriority[1:1] END AS area_ha,
       'L' || (o_custkey % 100) AS lote_1
FROM orders"""


def _sql(body: str) -> str:
    """Put the views a statement uses in front of it, each after those it builds on."""
    order: list[str] = []

    def add(text: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN|,)\s+(\w+)", text):
            if name in VIEWS and name not in order:
                add(VIEWS[name])
                order.append(name)

    add(body)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in order)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()


def _each(template: str) -> str:
    """One statement per index, put together."""
    return " UNION ALL ".join(template.replace("$", i) for i in ("ndvi", "ndwi11", "msi11"))


_ROUNDED_LINE = "round(slope, 6) AS slope, round(intercept, 6) AS intercept"

_TRACE = """
SELECT lot_id, CAST(CYCLE AS VARCHAR) AS cycle, chunk,
       CAST((CASE WHEN CYCLE IS NOT NULL THEN dense_rank() OVER (PARTITION BY lot_id ORDER BY CYCLE NULLS LAST) - 1 END)
            % COLORS AS INTEGER) AS color,
       dates, ndvi, age, copies
FROM (SELECT lot_id, CYCLE, CAST(year(obs_date) AS INTEGER) AS chunk,
             string_agg(CAST(obs_date AS VARCHAR), ',' ORDER BY obs_date, ndvi, age NULLS FIRST) AS dates,
             string_agg(CAST(ndvi AS VARCHAR), ',' ORDER BY obs_date, ndvi, age NULLS FIRST) AS ndvi,
             string_agg(coalesce(CAST(age AS VARCHAR), 'null'), ',' ORDER BY obs_date, ndvi, age NULLS FIRST) AS age,
             string_agg(CAST(copies AS VARCHAR), ',' ORDER BY obs_date, ndvi, age NULLS FIRST) AS copies
      FROM (SELECT lot_id, CYCLE, obs_date, CAST(ndvi_ref AS DECIMAL(10, 4)) AS ndvi, crop_age_days AS age,
                   count(*) AS copies FROM SOURCE GROUP BY ALL)
      GROUP BY ALL)"""


def _trace(source: str, cycle: str, colors: int) -> str:
    return _TRACE.replace("SOURCE", source).replace("CYCLE", cycle).replace("COLORS", str(colors))


_GROWTH_TRACES = """
SELECT lot_id, harvest AS cycle, chunk, CAST((dense_rank() OVER (PARTITION BY lot_id ORDER BY harvest) - 1) % 10 AS INTEGER) AS color,
       age, stac, ref, dates, copies, images
FROM (SELECT lot_id, harvest, CAST(floor(a / 365) AS INTEGER) AS chunk,
             string_agg(CAST(a AS VARCHAR), ',' ORDER BY a, s, r NULLS FIRST, d, i) AS age,
             string_agg(CAST(s AS VARCHAR), ',' ORDER BY a, s, r NULLS FIRST, d, i) AS stac,
             string_agg(coalesce(CAST(r AS VARCHAR), 'null'), ',' ORDER BY a, s, r NULLS FIRST, d, i) AS ref,
             string_agg(d, ',' ORDER BY a, s, r NULLS FIRST, d, i) AS dates,
             string_agg(CAST(n AS VARCHAR), ',' ORDER BY a, s, r NULLS FIRST, d, i) AS copies,
             string_agg(i, ',' ORDER BY a, s, r NULLS FIRST, d, i) AS images
      FROM (SELECT lot_id, harvest, crop_age_days AS a, CAST(CAST(ndvi_corrected AS VARCHAR) AS DECIMAL(10, 4)) AS s,
                   CAST(round(ndvi_ref, 4) AS DECIMAL(10, 4)) AS r, CAST(obs_date AS VARCHAR) AS d, image_id AS i, count(*) AS n
            FROM growing_rows WHERE harvest IS NOT NULL GROUP BY ALL)
      GROUP BY ALL)"""


def _feed(source: str, cycle: str, colors: int, fields: dict[str, str], order: str, open_label: str = "",
          events: str = "", event_order: str = "") -> str:
    """Pieces of a chart feed: brackets of lots, traces and fields, then values; arrays part their values by commas."""
    names = list(fields)
    kept = f"SELECT *, {cycle} AS cyc FROM {source}" + ("" if open_label else f" WHERE {cycle} IS NOT NULL")
    values = " UNION ALL ".join(
        f"SELECT lot_id, 1 AS section, CAST(cyc AS VARCHAR) AS cycle, {i} AS field, if(k = 1, 1, 2) AS place, "
        f"if(k = 1, '', ',') || {fields[n]} AS text FROM points" for i, n in enumerate(names)
    )
    label = f"""if(k = 1, '', ',') || '{{"label":' || coalesce('"' || CAST(cyc AS VARCHAR) || '"', '"{open_label}"')
      || ',"color":' || if(cyc IS NULL, 'null', CAST((k - 1) % {colors} AS VARCHAR)) || ',"{names[0]}":['"""
    brackets = [label, *[f"""'],"{n}":['""" for n in names[1:]], "']}'"]
    heads = " UNION ALL ".join(
        f"SELECT lot_id, 1, CAST(cyc AS VARCHAR), {i}, 0, {b} FROM traces" for i, b in enumerate(brackets)
    )
    ends = [(0, """'{"label":"' || lot_id || '","traces":['"""), (4, "']}' || chr(10)")]
    if events:
        ends.append((3 - 1, """'],"renovations":['"""))
    frames = " UNION ALL ".join(f"SELECT lot_id, {s}, NULL, 0, 0, {x} FROM (SELECT DISTINCT lot_id FROM traces)" for s, x in ends)
    more = f""" UNION ALL SELECT lot_id, 3, NULL, 0, if(k = 1, 1, 2), if(k = 1, '', ',') || text FROM (
      SELECT *, row_number() OVER (PARTITION BY lot_id ORDER BY {event_order}) AS k FROM ({events})
      WHERE lot_id IN (SELECT lot_id FROM traces))""" if events else ""
    return f"""SELECT * FROM (
      WITH points AS (SELECT *, row_number() OVER (PARTITION BY lot_id, cyc ORDER BY {order}) AS k FROM ({kept})),
           traces AS (SELECT lot_id, cyc, row_number() OVER (PARTITION BY lot_id ORDER BY cyc NULLS LAST) AS k
                      FROM points GROUP BY lot_id, cyc)
      {values} UNION ALL {heads} UNION ALL {frames}{more})"""


def _num(name: str) -> str:
    """Four digits, halves away from zero by the digits that are printed."""
    return f"coalesce(CAST(CAST(CAST({name} AS VARCHAR) AS DECIMAL(20, 4)) AS VARCHAR), 'null')"


_AGE = "coalesce(CAST(crop_age_days AS VARCHAR), 'null')"
_DAY = """('"' || CAST(obs_date AS VARCHAR) || '"')"""
_BY_DAY = "obs_date, ndvi_ref, crop_age_days NULLS FIRST"

_STATEMENTS: dict[str, str] = {
    "season_keys": "SELECT lot_id, obs_date, season, lot_season FROM obs",
    "yield_keys": "SELECT lot, season, status, lot_season FROM yields",
    "master_left_join": "SELECT lot_id, obs_date, image_id, ndvi_ref, season, lot_season, report_season, harvest, tch FROM master",
    "age_since_known_harvest": """
        SELECT lot_id, obs_date, season, harvest, CAST(obs_date - previous AS INTEGER) AS crop_age_days
        FROM master LEFT JOIN known_lag USING (lot_id, season)""",
    "age_since_previous_season": """
        SELECT lot_id, obs_date, season, harvest, CAST(obs_date - previous AS INTEGER) AS crop_age_days
        FROM master LEFT JOIN season_lag USING (lot_id, season)""",
    "age_with_ratoon": "SELECT * FROM ratoon",
    "season_gap_flags": """
        SELECT r.lot_id, r.obs_date, r.season, r.harvest,
               CASE WHEN g.lot_id IS NULL THEN r.crop_age_days END AS crop_age_days,
               g.lot_id IS NOT NULL AS data_gap
        FROM ratoon r LEFT JOIN gaps g ON g.lot_id = r.lot_id AND g.season = r.season""",
    "season_gaps": "SELECT * FROM gaps",
    "rollback_age": """
        SELECT count(*) AS rows, count(obs_date - previous) AS rows_with_age
        FROM master LEFT JOIN known_lag USING (lot_id, season)""",
    "next_harvest": "SELECT lot_id, obs_date, harvest, cycle_end FROM ended",
    "cycle_age": "SELECT lot_id, obs_date, harvest, cycle_end, crop_age_days, data_gap FROM aged",
    "renovation_events": "SELECT * FROM renovations",
    "valid_cycles": "SELECT lot_id, obs_date, harvest, cycle_end, crop_age_days, data_gap, valid_cycle FROM cycles",
    "repaired_cycles": "SELECT lot_id, obs_date, harvest, cycle_end, crop_age_days, data_gap, valid_cycle FROM cycles",
    "repaired_table": "SELECT lot_id, obs_date, harvest, cycle_end, crop_age_days, data_gap, valid_cycle FROM cycles",
    "ml_dataset": """
        SELECT lot_id, obs_date, image_id, season, harvest, tch, ndvi_ref, ndvi_corrected,
               cycle_end, crop_age_days, data_gap, valid_cycle FROM dataset""",
    "dataset_size": "SELECT count(*) AS rows, count(DISTINCT lot_season) AS samples FROM dataset",
    "cycle_length_buckets": """
        SELECT bucket, count(*) AS cycles, round(count(*) / sum(count(*)) OVER (), 6) AS share
        FROM (SELECT CASE WHEN max(crop_age_days) BETWEEN 300 AND 349 THEN '300-350'
                          WHEN max(crop_age_days) BETWEEN 350 AND 400 THEN '350-400'
                          ELSE 'other' END AS bucket
              FROM cycles WHERE valid_cycle GROUP BY lot_id, cycle_end) GROUP BY bucket""",
    "renovation_report": """
        SELECT lot_id, harvest, renovation_date, age_at_renovation, round(min_ndvi_ref, 4) AS min_ndvi_ref
        FROM renovated""",
    "lot_history": "SELECT * FROM history",
    "renovation_markers": "SELECT * FROM marked",
    "growth_lots": "SELECT * FROM growing",
    "growth_curves": """
        SELECT lot_id, crop_age_days, ndvi_corrected, ndvi_ref, harvest, obs_date, image_id FROM cycles
        WHERE crop_age_days IS NOT NULL AND ndvi_corrected IS NOT NULL
          AND lot_id IN (SELECT lot_id FROM growing ORDER BY md5('42|' || lot_id) LIMIT 75)""",
    "sampled_renovations": "SELECT * FROM drawn",
    "renovated_history": """
        SELECT lot_id, harvest, obs_date, crop_age_days, ndvi_ref FROM cycles
        WHERE NOT data_gap AND ndvi_ref IS NOT NULL AND lot_id IN (SELECT lot_id FROM drawn)""",
    "values_at_events": "SELECT * FROM event_values",
    "history_traces": _trace("history", "cycle_end", 15),
    "renovated_traces": f"SELECT * FROM ({_trace('renovated_history', 'harvest', 10)}) WHERE cycle IS NOT NULL",
    "growth_traces": _GROWTH_TRACES,
    "lot_feed": _feed(
        "history", "cycle_end", 15, {"fecha": _DAY, "ndvi": _num("ndvi_ref"), "edad": _AGE}, _BY_DAY, "sin cierre",
        f"""SELECT lot_id, obs_date, ndvi_ref, crop_age_days, cycle_end, kind, '{{"fecha":' || {_DAY} || ',"ndvi":' || {_num("ndvi_ref")}
              || ',"edad":' || {_AGE} || ',"cierre_ciclo":"' || CAST(cycle_end AS VARCHAR) || '"}}' AS text FROM marked""",
        _BY_DAY + ", cycle_end, kind",
    ),
    "growth_feed": _feed(
        "growing_rows", "harvest", 10,
        {"edad": _AGE, "stac": _num("ndvi_corrected"), "ref": _num("ndvi_ref"), "fecha": _DAY, "id_img": """('"' || image_id || '"')"""},
        "crop_age_days, obs_date, image_id, ndvi_ref NULLS FIRST, ndvi_corrected",
    ),
    "renovated_feed": _feed(
        "renovated_history", "harvest", 10, {"fecha": _DAY, "edad": _AGE, "ndvi": _num("ndvi_ref")}, _BY_DAY, "",
        f"""SELECT lot_id, harvest, renovation_date, '{{"fecha":"' || CAST(renovation_date AS VARCHAR) || '","ndvi":' || {_num("ndvi")}
              || ',"edad":' || coalesce(CAST(age AS VARCHAR), 'null') || ',"cierre":"' || harvest || '"}}' AS text FROM event_values""",
        "harvest, renovation_date",
    ),
    "clean_index_ranges": """
        SELECT lot_id, obs_date, ndvi AS ndvi_mean, ndwi11 AS ndwi11_mean, msi11 AS msi11_mean FROM clean_stac""",
    "match_sources": "SELECT * FROM matched",
    "residuals": """
        SELECT lot_id, obs_date, round(ndvi_stac - ndvi_ref, 6) AS ndvi_residual,
               round(ndwi11_stac - ndwi11_ref, 6) AS ndwi11_residual,
               round(msi11_stac - msi11_ref, 6) AS msi11_residual FROM matched""",
    "matched_counts": """
        SELECT count(*) AS rows, count(DISTINCT lot_id) AS lots, count(DISTINCT obs_date) AS dates,
               string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years
        FROM matched""",
    "source_summary": """
        SELECT index, round(avg(x), 6) AS stac_mean, round(stddev_samp(x), 6) AS stac_std,
               round(avg(y), 6) AS ref_mean, round(stddev_samp(y), 6) AS ref_std,
               round(avg(x - y), 6) AS bias_mean, round(stddev_samp(x - y), 6) AS bias_std,
               round(corr(x, y), 6) AS pearson_r FROM long_pairs GROUP BY index""",
    "bias_by_year": """
        SELECT year, index, round(avg(x - y), 6) AS bias_mean, round(stddev_samp(x - y), 6) AS bias_std
        FROM long_pairs GROUP BY ALL""",
    "residual_histogram": """
        SELECT index, CAST(least(floor((v - lo) / (hi - lo) * 100), 99) AS INTEGER) AS bin, count(*) AS rows
        FROM (SELECT index, x - y AS v, min(v) OVER (PARTITION BY index) AS lo, max(v) OVER (PARTITION BY index) AS hi
              FROM pairs)
        GROUP BY ALL""",
    "scatter_sample": """
        SELECT lot_id, obs_date, ndvi_stac, ndvi_ref FROM matched
        ORDER BY md5('42|' || lot_id || '|' || CAST(obs_date AS VARCHAR)) LIMIT 2000""",
    "line_fit": """
        SELECT index, count(*) AS pairs, round(regr_slope(y, x), 6) AS slope,
               round(regr_intercept(y, x), 6) AS intercept FROM pairs GROUP BY index""",
    "identity_range": """
        SELECT index, least(min(x), min(y)) AS low, greatest(max(x), max(y)) AS high
        FROM long_pairs GROUP BY index""",
    "ols_final": """
        SELECT index, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept
        FROM pairs GROUP BY index""",
    "ols_cross_validation": f"""
        SELECT index, year, n, {_ROUNDED_LINE}, round(r2, 6) AS r2, round(mae, 6) AS mae FROM fold_scores""",
    "cross_validation_summary": """
        SELECT index, round(avg(r2), 6) AS r2_mean, round(stddev_pop(r2), 6) AS r2_std,
               round(avg(mae), 6) AS mae_mean, round(stddev_pop(mae), 6) AS mae_std
        FROM fold_scores GROUP BY index""",
    "ols_holdout": """
        SELECT a.index, round(a.slope, 6) AS slope, round(a.intercept, 6) AS intercept,
               a.n AS train_n, round(a.r2, 6) AS train_r2, round(a.mae, 6) AS train_mae,
               b.n AS test_n, round(b.r2, 6) AS test_r2, round(b.mae, 6) AS test_mae
        FROM holdout_scores a JOIN holdout_scores b ON a.index = b.index AND NOT a.test AND b.test""",
    "huber_final": f"""
        SELECT 'msi11' AS index, round(a, 6) AS slope, round(b, 6) AS intercept
        FROM huber_{HUBER_STEPS} WHERE label = 0""",
    "huber_cross_validation": """
        SELECT 'msi11' AS index, label AS year, count(*) AS n, round(slope, 6) AS slope,
               round(intercept, 6) AS intercept, round(1 - sum(r * r) / (var_pop(y) * count(*)), 6) AS r2,
               round(avg(abs(r)), 6) AS mae
        FROM huber_scores WHERE test GROUP BY label, slope, intercept""",
    "huber_holdout": """
        SELECT 'msi11' AS index, round(slope, 6) AS slope, round(intercept, 6) AS intercept,
               count(*) FILTER (NOT test) AS train_n,
               round(1 - sum(r * r) FILTER (NOT test) / (var_pop(y) FILTER (NOT test) * count(*) FILTER (NOT test)), 6) AS train_r2,
               round(avg(abs(r)) FILTER (NOT test), 6) AS train_mae,
               count(*) FILTER (test) AS test_n,
               round(1 - sum(r * r) FILTER (test) / (var_pop(y) FILTER (test) * count(*) FILTER (test)), 6) AS test_r2,
               round(avg(abs(r)) FILTER (test), 6) AS test_mae
        FROM huber_scores WHERE label = 2000 GROUP BY slope, intercept""",
    "apply_correction": "SELECT * FROM corrected",
    "corrected_observations": """
        SELECT lot_id, obs_date, image_id, ndvi_corrected, ndvi_ref, ndwi11_corrected, ndwi11_ref,
               msi11_corrected, msi11_ref FROM corrected""",
    "csv_round_trip": """
        SELECT lot_id, obs_date, image_id, ndvi_corrected, ndvi_ref, ndwi11_corrected, ndwi11_ref,
               msi11_corrected, msi11_ref FROM corrected""",
    "index_files_round_trip": """
        SELECT lot_id, obs_date, year, ndvi AS ndvi_mean, ndwi11 AS ndwi11_mean, msi11 AS msi11_mean
        FROM ref_source""",
    "difference_summary": _each(
        """SELECT '$' AS index, round(avg($_diff), 6) AS mean, round(stddev_samp($_diff), 6) AS std,
                  round(avg(abs($_diff)), 6) AS mae FROM corrected"""
    ),
    "index_algebra": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               CASE WHEN n > 0 AND r > 0 THEN (n - r) / (n + r) END AS ndvi,
               CASE WHEN n > 0 AND s > 0 THEN (n - s) / (n + s) END AS ndwi11,
               CASE WHEN n > 0 AND s > 0 THEN s / n END AS msi11
        FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS n,
                     l_quantity * 500 - CASE WHEN l_returnflag = 'R' THEN 2500 ELSE 0 END AS r,
                     l_quantity * (l_discount * 5000 + 200) AS s FROM lineitem)""",
    "affine_pixels": """
        SELECT vec_id, row, col, 9.5::DOUBLE * (col + 0.5) + 0.75::DOUBLE * (row + 0.5) + 500000 AS x,
               0.5::DOUBLE * (col + 0.5) - 10.25::DOUBLE * (row + 0.5) + 1600000 AS y FROM pixels""",
    "zonal_stats": """
        SELECT l.polygon_id, count(c.value) AS value_count, round(avg(c.value), 6) AS value_mean,
               round(max(c.value), 6) AS value_max, round(min(c.value), 6) AS value_min,
               round(stddev_pop(c.value), 6) AS value_std
        FROM lots l LEFT JOIN covered c ON c.polygon_id = l.polygon_id AND c.value >= -0.3 GROUP BY ALL""",
    "pooled_stats": """
        SELECT l_suppkey, round(avg(v), 6) AS v_mean, round(max(v), 6) AS v_max,
               round(min(v), 6) AS v_min, round(stddev_pop(v), 6) AS v_std
        FROM (SELECT l_suppkey, l_quantity / l_extendedprice AS v FROM lineitem) GROUP BY l_suppkey""",
    "clip_window": """
        SELECT lot_id, p.row, p.col FROM pixels p JOIN (
          SELECT lot_id, min(xmin) AS x0, max(xmax) AS x1, min(ymin) AS y0, max(ymax) AS y1
          FROM boxes GROUP BY lot_id) b
          ON p.col + 0.75 BETWEEN x0 AND x1 AND p.row BETWEEN y0 AND y1""",
    "bilinear_resample": """
        SELECT scene_id, "row", col, round((1 - dv) * ((1 - du) * v00 + du * v01) + dv * ((1 - du) * v10 + du * v11), 6) AS value
        FROM (SELECT scene_id, r AS "row", c AS col, greatest(least((c - 0.5) / 2, 7), 0) AS u,
                     greatest(least((r - 0.5) / 2, 7), 0) AS v, u - floor(u) AS du, v - floor(v) AS dv,
                     e[CAST(floor(v) * 8 + floor(u) AS INTEGER) + 1] AS v00,
                     e[CAST(floor(v) * 8 + ceil(u) AS INTEGER) + 1] AS v01,
                     e[CAST(ceil(v) * 8 + floor(u) AS INTEGER) + 1] AS v10,
                     e[CAST(ceil(v) * 8 + ceil(u) AS INTEGER) + 1] AS v11
              FROM (SELECT vec_id AS scene_id, CAST(embedding AS DOUBLE[]) AS e, CAST(r AS INTEGER) AS r, CAST(c AS INTEGER) AS c
                    FROM embeddings, range(16) a(r), range(16) b(c)))""",
    "extract_scenes": f"""
        SELECT lot_id, '2024-01-01' AS obs_date, 'S2A_' || min(tile) || '_0' AS image_id,
               {_four('ndvi')}, {_four('ndwi11')}, {_four('msi11')}
        FROM (SELECT l.lot_id, f.tile, v.ndvi, v.ndwi11, v.msi11
              FROM lots l JOIN first_tile f ON f.polygon_id = l.polygon_id
              LEFT JOIN scene_values v ON v.polygon_id = l.polygon_id) GROUP BY lot_id""",
    "extract_rasters": "SELECT * FROM raster_output",
    "lot_coverage": "SELECT count(ndvi_mean) AS lots_with_ndvi, count(*) AS lots FROM raster_output",
    "total_bounds": "SELECT * FROM bounds",
    "search_scenes": "SELECT scene_id, obs_date, cloud_cover FROM found",
    "best_scene": """
        SELECT month, CAST(tile AS VARCHAR) AS tile, scene_id, cloud_cover, tile_order
        FROM (SELECT *, CAST(date_trunc('month', obs_date) AS DATE) AS month,
                     min(pos) OVER (PARTITION BY month, tile) AS tile_order FROM catalogue)
        QUALIFY row_number() OVER (PARTITION BY month, tile ORDER BY coalesce(cloud_cover, 100), pos) = 1""",
    "required_assets": "SELECT scene_id, pos FROM catalogue WHERE has_all",
    "lots_in_tiles": "SELECT obs_date, polygon_id, scene_id FROM lot_tiles",
    "tile_assignment": """
        SELECT obs_date, polygon_id, lot_id, scene_id, CAST(tile AS VARCHAR) AS tile FROM lot_tiles
        QUALIFY row_number() OVER (PARTITION BY obs_date, polygon_id ORDER BY tile_order) = 1""",
    "ring_box": "SELECT polygon_id, xmin, ymin, xmax, ymax FROM boxes",
    "classified_assets": "SELECT path, parent, date, kind FROM files WHERE kind IS NOT NULL",
    "latest_asset": "SELECT date, kind, max(path) AS path FROM files WHERE kind IS NOT NULL GROUP BY ALL",
    "complete_dates": """
        SELECT * FROM by_date WHERE ndvi IS NOT NULL AND ndwi11 IS NOT NULL AND msi11 IS NOT NULL AND lots IS NOT NULL""",
    "skipped_dates": """
        SELECT date FROM files WHERE kind IN ('ndvi', 'ndwi11', 'msi11') GROUP BY date
        EXCEPT SELECT date FROM files WHERE kind IS NOT NULL GROUP BY date HAVING count(DISTINCT kind) = 4""",
    "discovered_years": "SELECT DISTINCT regexp_extract(path, '/([0-9]+)-raster/', 1) AS year FROM files",
    "first_files": "SELECT DISTINCT path FROM files WHERE suffix = '.shp' ORDER BY path LIMIT 100",
    "companion_files": """
        SELECT regexp_replace(path, '[^/]*$', '') AS folder, stem,
               string_agg(DISTINCT suffix, ',' ORDER BY suffix) AS extensions
        FROM files GROUP BY ALL HAVING bool_or(suffix = '.tif')""",
    "distinct_stems": "SELECT stem, min(path) AS path FROM files GROUP BY stem",
    "html_cells": """
        SELECT page_id, CAST(i AS INTEGER) AS cell_no, cells[i + 1] AS cell
        FROM (SELECT page_id, cells, unnest(range(len(cells))) AS i FROM lists)""",
    "html_table": "SELECT page_id, "
    + ", ".join(f"nullif(cells[{i + 1}], '') AS c{i}" for i in range(8))
    + " FROM lists WHERE len(list_filter(cells, lambda c: c <> '')) > 0",
    "slug_columns": r"""
        SELECT page_id, trim(regexp_replace(lower(regexp_replace(strip_accents(
                 regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9_]+', '_', 'g'), '_') AS slug
        FROM pages""",
    "numeric_inference": " UNION ALL ".join(
        f"""SELECT '{n}' AS name,
                   CASE WHEN count({e}) <> count(TRY_CAST({e} AS DOUBLE)) THEN 'string'
                        WHEN count(*) = count(*) FILTER (regexp_full_match({e}, '[+-]?[0-9]+')) THEN 'bigint'
                        ELSE 'double' END AS type
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
        for n, e in {
            "o_orderkey": "CAST(o_orderkey AS VARCHAR)",
            "o_custkey": "(o_custkey || 'd')",
            "o_orderstatus": "o_orderstatus",
            "o_totalprice": "CAST(o_totalprice AS VARCHAR)",
            "o_orderpriority": "o_orderpriority",
            "c_name": "c_name",
            "c_acctbal": "CAST(c_acctbal AS VARCHAR)",
            "c_nationkey": "CAST(c_nationkey AS VARCHAR)",
        }.items()
    ),
    "report_ingest": "SELECT * FROM report",
    "report_file": "SELECT * FROM report",
    "scene_files": """
        SELECT lot_id, obs_date, image_id, ndvi AS ndvi_mean, ndwi11 AS ndwi11_mean, msi11 AS msi11_mean,
               CAST(year(obs_date) AS INTEGER) AS year FROM stac_source""",
    "united_years": """
        SELECT lot_id, obs_date, year, ndvi AS ndvi_mean, ndwi11 AS ndwi11_mean, msi11 AS msi11_mean
        FROM ref_source WHERE year IN (1995, 1997, 1998)""",
    "listed_files": "SELECT DISTINCT year FROM ref_source",
    "factor_files": f"""
        SELECT 'final' AS part, index, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept
        FROM pairs GROUP BY index UNION ALL
        SELECT 'validation_1', index, {_ROUNDED_LINE} FROM holdout_line""",
    "table_as_select": "SELECT lot_id, obs_date, season, harvest, tch FROM master",
    "history_by_parameters": """
        SELECT lot_id, obs_date, ndvi_ref FROM obs
        WHERE CAST(lot_id AS INTEGER) BETWEEN 1 AND 59 AND CAST(lot_id AS INTEGER) % 2 = 1 AND ndvi_ref >= 0.1""",
    "calibration": f"""
        SELECT 'final' AS part, NULL::INTEGER AS year, index, round(regr_slope(y, x), 6) AS slope,
               round(regr_intercept(y, x), 6) AS intercept FROM pairs WHERE index <> 'msi11' GROUP BY index
        UNION ALL SELECT 'holdout', NULL, index, {_ROUNDED_LINE} FROM holdout_line WHERE index <> 'msi11'
        UNION ALL SELECT 'fold', year, index, {_ROUNDED_LINE} FROM folds WHERE index <> 'msi11'
        UNION ALL SELECT if(label = 0, 'final', 'fold'), nullif(label, 0), 'msi11', round(a, 6), round(b, 6)
                  FROM huber_{HUBER_STEPS}
        UNION ALL SELECT 'holdout', NULL, 'msi11', round(a, 6), round(b, 6) FROM huber_{HUBER_STEPS} WHERE label = 2000""",
    "lot_files": """
        SELECT 'plain' AS kind, polygon_id, CAST(polygon_id AS VARCHAR) AS lot_id, 12 AS corners FROM lots
        UNION ALL SELECT 'named', polygon_id, lot_id, 12 FROM lots""",
    "pixel_files": """
        SELECT 'S2A_' || (row // 40 * 100 + col // 40) || '_0' AS scene_id, band, CAST(row % 40 // size AS INTEGER) AS row,
               CAST(col % 40 // size AS INTEGER) AS col,
               CASE band WHEN 'nir' THEN value + 0.4::DOUBLE WHEN 'red' THEN mirror + 0.2::DOUBLE
                         ELSE value * 0.5 + 0.3::DOUBLE END AS value
        FROM pixels, (VALUES ('nir', 1), ('red', 1), ('swir16', 2)) AS b(band, size)
        WHERE row % size = 0 AND col % size = 0 AND (band <> 'swir16' OR row // 40 * 100 + col // 40 <> 102)""",
}

ORACLES: dict[str, str] = {name: _sql(body) for name, body in _STATEMENTS.items()}
