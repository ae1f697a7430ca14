"""Boosted trees per meter: splits and leaf values worked out in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterframe.operators import boosting, history
from meterframe.operators.boosting import TreeSettings

from . import views
from .forecast_checks import FEATURES, PREDICTED, _features, _predicted, _test, _train
from .history_checks import HOUR_KEY, KEY
from .registry import plain, query
from .views import HOURLY, ORDER


def _soft(g: str, s: TreeSettings) -> str:
    return f"greatest(abs({g}) - {s.l1}::DOUBLE, 0.0::DOUBLE)"


def _score(g: str, n: str, s: TreeSettings) -> str:
    g = f"(({g})::DOUBLE / 1e6::DOUBLE)"
    return f"({_soft(g, s)} * {_soft(g, s)} / ({n} + {s.l2}::DOUBLE))"


def _route(name: str, before: str, splits: str) -> str:
    """Rows of ``before`` one step down the tree."""
    return f"""{name} AS (
      SELECT r.* REPLACE (CASE WHEN s.node IS NULL THEN r.node
          ELSE 2 * r.node + 1 - CAST(CASE WHEN b.x IS NULL THEN s.missing_left ELSE b.x <= s.threshold END AS BIGINT) END AS node)
      FROM {before} r LEFT JOIN {splits} s ON s.object_id = r.object_id AND s.node = r.node
      LEFT JOIN binned b ON b.object_id = r.object_id AND b.row_id = r.row_id AND b.feature = s.feature)"""


def trees_sql(source: str, features: list[str], s: TreeSettings) -> str:
    """``source`` has object_id, row_id, y and the features."""
    long = " UNION ALL ".join(f"SELECT object_id, row_id, {i} AS feature, CAST({f} AS DOUBLE) AS x FROM given" for i, f in enumerate(features))
    fractions = ", ".join(f"{(i + 1) / s.bins!r}::DOUBLE" for i in range(s.bins))
    out = [
        f"given AS MATERIALIZED (SELECT * FROM ({source}) WHERE y IS NOT NULL)",
        f"unbinned AS MATERIALIZED ({long})",
        f"""edges AS MATERIALIZED (SELECT DISTINCT object_id, feature, unnest(quantile_disc(x, [{fractions}])) AS e
            FROM unbinned WHERE x IS NOT NULL GROUP BY object_id, feature)""",
        """binned AS MATERIALIZED (SELECT u.object_id, u.row_id, u.feature, e.e AS x FROM unbinned u ASOF LEFT JOIN edges e
            ON u.object_id = e.object_id AND u.feature = e.feature AND u.x <= e.e)""",
        """state_1 AS MATERIALIZED (SELECT object_id, row_id, y, level AS pred, 1::BIGINT AS node FROM given JOIN
            (SELECT object_id, CAST(sum(CAST(round_even(y * 1e6, 0) AS HUGEINT)) AS DOUBLE) / count(*) / 1e6 AS level FROM given GROUP BY 1) USING (object_id))""",
    ]
    done = []
    for t in range(1, s.trees + 1):
        out.append(f"rows_{t}_0 AS MATERIALIZED (SELECT *, CAST(round_even((y - pred) * 1e6, 0) AS HUGEINT) AS g FROM state_{t})")
        known = "SELECT NULL::VARCHAR AS object_id, NULL::BIGINT AS node, NULL::DOUBLE AS bound WHERE false"
        found = []
        for d in range(s.depth):
            p = f"{t}_{d}"
            bound = f"coalesce((SELECT bound FROM picks_{t}_{d - 1} k WHERE k.object_id = v.object_id AND k.node = v.node // 2), 'Infinity'::DOUBLE)" if d else "'Infinity'::DOUBLE"
            out += [
                f"nodes_{p} AS MATERIALIZED (SELECT object_id, node, sum(g) AS g, count(*) AS n FROM rows_{p} WHERE node >= {2**d} GROUP BY ALL)",
                f"hist_{p} AS MATERIALIZED (SELECT object_id, node, feature, x, sum(g) AS g, count(*) AS n FROM rows_{p} JOIN binned USING (object_id, row_id) WHERE node >= {2**d} GROUP BY ALL)",
                f"""sums_{p} AS (SELECT object_id, node, feature, x AS threshold,
                    sum(g) OVER (PARTITION BY object_id, node, feature ORDER BY x) AS gb, sum(n) OVER (PARTITION BY object_id, node, feature ORDER BY x) AS nb
                    FROM hist_{p} WHERE x IS NOT NULL)""",
                f"""tried_{p} AS (SELECT v.object_id, v.node, v.g, v.n, feature, threshold, missing_left, gb + CASE WHEN missing_left THEN coalesce(m.g, 0) ELSE 0 END AS gl,
                    nb + CASE WHEN missing_left THEN coalesce(m.n, 0) ELSE 0 END AS nl
                    FROM sums_{p} JOIN nodes_{p} v USING (object_id, node)
                    LEFT JOIN (SELECT object_id, node, feature, g, n FROM hist_{p} WHERE x IS NULL) m USING (object_id, node, feature),
                    (VALUES (true), (false)) sides(missing_left) WHERE m.n IS NOT NULL OR missing_left = (nb * 2 >= v.n))""",
                f"""best_{p} AS MATERIALIZED (SELECT v.*, {_score('gl', 'nl', s)} + {_score('g - gl', '(n - nl)', s)} - {_score('g', 'n', s)} AS gain,
                    least({bound}, gain) AS bound FROM tried_{p} v WHERE nl >= {s.min_rows} AND n - nl >= {s.min_rows} AND gain > 0
                    QUALIFY row_number() OVER (PARTITION BY object_id, node ORDER BY gain DESC, feature, threshold, missing_left DESC) = 1)""",
            ]
            found.append(f"SELECT * FROM best_{p}")
            out.append(f"picks_{p} AS MATERIALIZED (SELECT * FROM ({' UNION ALL '.join(found)}) QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY bound DESC, node) < {s.leaves})")
            # From the root again: a split of an earlier level may be given up.
            out += [_route(f"down_{p}_{k}", f"down_{p}_{k - 1}" if k else f"rows_{t}_0", f"picks_{p}") for k in range(d + 1)]
            out.append(f"rows_{t}_{d + 1} AS MATERIALIZED (SELECT * FROM down_{p}_{d})")
        last = f"{t}_{s.depth - 1}"
        out.append(
            f"""ends_{t} AS MATERIALIZED (SELECT object_id, node, count(*) AS n,
                sign(sum(g)::DOUBLE / 1e6::DOUBLE) * {_soft('sum(g)::DOUBLE / 1e6::DOUBLE', s)} / (count(*) + {s.l2}::DOUBLE) * {s.step}::DOUBLE AS value
                FROM rows_{t}_{s.depth} WHERE node > 1 GROUP BY ALL)"""
        )
        out.append(f"state_{t + 1} AS MATERIALIZED (SELECT r.object_id, row_id, y, pred + value AS pred, 1::BIGINT AS node FROM rows_{t}_{s.depth} r JOIN ends_{t} USING (object_id, node))")
        done.append(
            f"""SELECT object_id, {t} AS tree, node, feature, threshold, missing_left, round(gain, 6) AS gain, n AS rows, NULL::DOUBLE AS value FROM picks_{last}
            UNION ALL SELECT object_id, {t}, node, NULL, NULL, NULL, NULL, n, round(value, 6) FROM ends_{t}"""
        )
    return "WITH " + ",\n".join(out) + "\n" + " UNION ALL ".join(done)


def _nodes(df, features, target, settings):
    found = boosting.tree_nodes(boosting.fit_trees(df, features, target, settings=settings))
    return plain(found, 6).withColumn("threshold", F.col("threshold"))


ONE = TreeSettings(trees=1, step=0.05, leaves=2, depth=1, min_rows=3)
ONE_FEATURES = ["energy_export_kwh", "hour", "lagged_1"]


@query(
    "per_customer_tree_one",
    trees_sql(
        f"""SELECT object_id, event_id AS row_id, energy_import_kwh AS y, energy_export_kwh, hour("timestamp") AS hour,
            lag(energy_import_kwh) OVER ({KEY}) AS lagged_1 FROM readings""",
        ONE_FEATURES,
        ONE,
    ),
)
def per_customer_tree_one(spark, sf):
    """One split of each of many small meters; first rows have no lag."""
    rows = views.readings(spark, sf).select("object_id", "timestamp", "event_id", "energy_import_kwh", F.col("energy_export_kwh").alias("export"))
    df = history.add_lags(rows, (1,), order=ORDER).select(
        "object_id", "event_id", "energy_import_kwh", F.col("export").alias("energy_export_kwh"), F.hour("timestamp").alias("hour"), F.col("lagged_1_energy_import_kwh").alias("lagged_1")
    )
    return _nodes(df, ONE_FEATURES, "energy_import_kwh", ONE)


TWO = TreeSettings(trees=2, step=0.5, leaves=3, depth=2, min_rows=20)
TWO_FEATURES = ["lagged_1", "lagged_24", "hour"]
HOURS = f"""SELECT object_id, "timestamp" AS row_id, energy_kwh AS y, lag(energy_kwh, 1) OVER ({HOUR_KEY}) AS lagged_1,
    lag(energy_kwh, 24) OVER ({HOUR_KEY}) AS lagged_24, hour("timestamp") AS hour FROM series_hour"""


@query("per_customer_tree_two", trees_sql(HOURS, TWO_FEATURES, TWO))
def per_customer_tree_two(spark, sf):
    """Two trees of two levels and three leaves, on long series with 255 bins."""
    lagged = history.add_lags(views.series_hour(spark, sf), (1, 24), order=HOURLY)
    df = lagged.withColumnsRenamed({"lagged_1_energy_kwh": "lagged_1", "lagged_24_energy_kwh": "lagged_24"}).withColumn("hour", F.hour("timestamp"))
    return _nodes(df, TWO_FEATURES, "energy_kwh", TWO)


@query("per_customer_trees", PREDICTED)
def per_customer_trees(spark, sf):
    """Forecasts of all test rows; the numbers of the trees are compared above."""
    df = _features(spark, sf)
    settings = TreeSettings(trees=2, leaves=4, depth=3, min_rows=5)
    return _predicted(boosting.forecast_trees(_train(df), _test(df), FEATURES, "energy_kwh", ORDER, settings))
