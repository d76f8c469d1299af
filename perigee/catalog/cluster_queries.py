"""Profiles, and the cluster marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.catalog.bindings import LINEITEM_SQL, Query, lineitem_approaches, table
from perigee.functions.labels import band, flag_label, horizon_label
from perigee.operators.profiles import profile
from perigee.plans.marts import CLUSTER_MARTS, cluster_mart, cluster_mart_from_parts, cluster_parts
from perigee.plans.rollup import approach_rollup, rollup_cluster_parts

AS_OF = date(1998, 6, 30)


def band_sql(column: str, low: float, high: float, names: tuple[str, str, str]) -> str:
    first, second, third = names
    return f"CASE WHEN {column} <= {low} THEN '{first}' WHEN {column} <= {high} THEN '{second}' ELSE '{third}' END"


def flag_sql(flag: str, yes: str, no: str) -> str:
    return f"CASE WHEN {flag} THEN '{yes}' ELSE '{no}' END"


def horizon_sql(day: str, as_of: date, near: str, far: str) -> str:
    return f"CASE WHEN {day} <= DATE '{as_of}' + INTERVAL 1 MONTH THEN '{near}' ELSE '{far}' END"


def mean_sql(column: str) -> str:
    """Mean of a column that does not hang on the order of rows: what is added are whole numbers of 1/2**20 and 1/2**72."""
    scaled = f"(CAST({column} AS DOUBLE) * 1048576e0)"
    rest = f"floor(({scaled} - floor({scaled})) * 4503599627370496e0)"
    whole, rest = (f"CAST(sum(CAST({part} AS HUGEINT)) AS DOUBLE)" for part in (f"floor({scaled})", rest))
    return f"({whole} / 1048576e0 + {rest} / 4722366482869645213696e0) / nullif(count({column}), 0)"


def profile_sql(
    relation: str, keys: dict[str, str], id_col: str, count_name: str, averages=None, minima=None, maxima=None
) -> str:
    columns = [f"{label} AS {name}" for name, label in keys.items()]
    columns.append(f"count({id_col}) AS {count_name}")
    columns += [f"{mean_sql(column)} AS {name}" for name, column in (averages or {}).items()]
    columns += [f"min({column}) AS {name}" for name, column in (minima or {}).items()]
    columns += [f"max({column}) AS {name}" for name, column in (maxima or {}).items()]
    return f"SELECT {', '.join(columns)} FROM ({relation}) AS r GROUP BY 1, 2"


def mart_sql(relation: str, as_of: date) -> dict[str, str]:
    """SQL of the cluster marts on a relation of approach rows."""
    diameter = "estimated_diameter_min_kilometers"
    velocity = "relative_velocity_kilometers_per_second"
    distance = "miss_distance_astronomical"
    magnitude = "absolute_magnitude_h"
    day = "close_approach_date"
    size = band_sql(diameter, 1, 5, ("Small", "Medium", "Large"))
    n = "num_asteroids"
    return {
        "clustering-based-analysis/asteroid_hazardous_close_approach_clusters": profile_sql(
            relation,
            {
                "hazard_cluster": flag_sql("is_potentially_hazardous_asteroid", "Hazardous", "Non-Hazardous"),
                "approach_cluster": horizon_sql(day, as_of, "Near Future", "Far Future"),
            },
            "id",
            n,
            minima={"first_approach": day},
            maxima={"last_approach": day},
        ),
        "clustering-based-analysis/asteroid_size_velocity_cluster": profile_sql(
            relation,
            {"size_cluster": size, "velocity_cluster": band_sql(velocity, 10, 25, ("Slow", "Moderate", "Fast"))},
            "id",
            n,
            {"avg_diameter": diameter, "avg_velocity": velocity},
            {"min_diameter": diameter, "min_velocity": velocity},
            {"max_diameter": diameter, "max_velocity": velocity},
        ),
        "clustering-based-analysis/asteroid_distance_orbit_body_clusters": profile_sql(
            relation,
            {
                "orbiting_body": "orbiting_body",
                "distance_cluster": band_sql(distance, "0.1e0", 1, ("Very Close", "Moderate", "Far")),
            },
            "id",
            n,
            {"avg_miss_distance": distance},
            {"min_miss_distance": distance},
            {"max_miss_distance": distance},
        ),
        "clustering-based-analysis/clustered_asteroids_by_magnitude_and_diameter": profile_sql(
            relation,
            {
                "magnitude_cluster": band_sql(magnitude, 15, 20, ("Bright", "Moderately Bright", "Dim")),
                "diameter_cluster": size,
            },
            "id",
            n,
            {"avg_absolute_magnitude": magnitude, "avg_diameter": diameter},
            {"min_absolute_magnitude": magnitude},
            {"max_absolute_magnitude": magnitude},
        ),
    }


def _mart(mart):
    return lambda spark, sf_dir: cluster_mart(mart, lineitem_approaches(spark, sf_dir), AS_OF)


def _mart_from_parts(mart):
    return lambda spark, sf_dir: cluster_mart_from_parts(mart, cluster_parts(lineitem_approaches(spark, sf_dir), AS_OF))


def _mart_from_rollup(mart):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rollup = approach_rollup(lineitem_approaches(spark, sf_dir))
        return cluster_mart_from_parts(mart, rollup_cluster_parts(rollup, AS_OF))

    return run


def _mart_queries() -> dict[str, Query]:
    sql = mart_sql(LINEITEM_SQL, AS_OF)
    found = {}
    for path, mart in CLUSTER_MARTS.items():
        name = path.split("/")[1].removeprefix("asteroid_")
        found[f"mart_cluster_{name}"] = Query(_mart(mart), sql[path])
        found[f"parts_cluster_{name}"] = Query(_mart_from_parts(mart), sql[path])
        found[f"rollup_cluster_{name}"] = Query(_mart_from_rollup(mart), sql[path])
    return found


# --- the profile operator on other columns and thresholds -----------------------------------


def _profiled(name: str, keys, id_col: str, averages=None, minima=None, maxima=None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return profile(table(spark, sf_dir, name), keys(), id_col, "n", averages, minima, maxima)

    return run


_QUANTITY = ("l_quantity", 10, 30, ("low", "middle", "high"))
_PRICE = ("l_extendedprice", 20000, 60000, ("low", "middle", "high"))
_TAX = ("l_tax", 0.02, 0.06, ("low", "middle", "high"))
_SIZE = ("p_size", 15, 20, ("low", "middle", "high"))
_RETAIL = ("p_retailprice", 930, 970, ("low", "middle", "high"))


def _band(spec) -> Column:
    column, low, high, names = spec
    return band(F.col(column), low, high, names)


def _summaries(**columns: str) -> tuple[dict, dict, dict]:
    return tuple({f"{kind}_{name}": column for name, column in columns.items()} for kind in ("avg", "min", "max"))


_SQ = _summaries(quantity="l_quantity", price="l_extendedprice")
_BD = _summaries(tax="l_tax")
_MD = _summaries(size="p_size", price="p_retailprice")

# Ship dates are moved so that the day AS_OF falls on today, and those that would lie 20 days or more ahead by 20 more, so
# that none lies where the length of a month decides: the answer is the same on every day.
MOVED = "datediff(CAST(l_shipdate AS DATE), DATE '{as_of}')".format(as_of=AS_OF)
MOVED_SQL = f"date_diff('day', DATE '{AS_OF}', CAST(l_shipdate AS DATE))"


def moved_days(days: str) -> str:
    return f"({days} + CASE WHEN {days} >= 20 THEN 20 ELSE 0 END)"


def horizon_today(today: Column | None = None, as_of: date | None = None) -> Column:
    """Whether a line item is near, seen from `today` (the current date if None) or labelled as of a given date."""
    shifted = F.date_add(F.current_date() if today is None else today, F.expr(moved_days(MOVED)).cast("int"))
    return horizon_label(shifted, as_of, 1, "near", "far")


QUERIES: dict[str, Query] = {
    "profile_horizon_today": Query(
        _profiled(
            "lineitem",
            lambda: {"returned": flag_label(F.col("l_returnflag") == "R", "yes", "no"), "horizon": horizon_today()},
            "l_orderkey",
            None,
            {"first": "l_shipdate"},
            {"last": "l_shipdate"},
        ),
        profile_sql(
            "SELECT * FROM lineitem",
            {
                "returned": flag_sql("l_returnflag = 'R'", "yes", "no"),
                "horizon": f"CASE WHEN current_date + CAST({moved_days(MOVED_SQL)} AS INTEGER) <= current_date + INTERVAL 1 MONTH "
                "THEN 'near' ELSE 'far' END",
            },
            "l_orderkey",
            "n",
            None,
            {"first": "l_shipdate"},
            {"last": "l_shipdate"},
        ),
    ),
    "profile_flag_horizon": Query(
        _profiled(
            "lineitem",
            lambda: {
                "returned": flag_label(F.col("l_returnflag") == "R", "yes", "no"),
                "horizon": horizon_label(F.col("l_shipdate").cast("date"), AS_OF, 1, "near", "far"),
            },
            "l_orderkey",
            None,
            {"first": "l_shipdate"},
            {"last": "l_shipdate"},
        ),
        profile_sql(
            "SELECT * FROM lineitem",
            {
                "returned": flag_sql("l_returnflag = 'R'", "yes", "no"),
                "horizon": horizon_sql("CAST(l_shipdate AS DATE)", AS_OF, "near", "far"),
            },
            "l_orderkey",
            "n",
            None,
            {"first": "l_shipdate"},
            {"last": "l_shipdate"},
        ),
    ),
    "profile_size_velocity": Query(
        _profiled("lineitem", lambda: {"size": _band(_QUANTITY), "velocity": _band(_PRICE)}, "l_orderkey", *_SQ),
        profile_sql(
            "SELECT * FROM lineitem",
            {"size": band_sql(*_QUANTITY), "velocity": band_sql(*_PRICE)},
            "l_orderkey",
            "n",
            *_SQ,
        ),
    ),
    "profile_body_distance": Query(
        _profiled("lineitem", lambda: {"body": F.col("l_linestatus"), "distance": _band(_TAX)}, "l_orderkey", *_BD),
        profile_sql(
            "SELECT * FROM lineitem", {"body": "l_linestatus", "distance": band_sql(*_TAX)}, "l_orderkey", "n", *_BD
        ),
    ),
    "profile_magnitude_diameter": Query(
        _profiled("part", lambda: {"magnitude": _band(_SIZE), "diameter": _band(_RETAIL)}, "p_partkey", *_MD),
        profile_sql(
            "SELECT * FROM part",
            {"magnitude": band_sql(*_SIZE), "diameter": band_sql(*_RETAIL)},
            "p_partkey",
            "n",
            *_MD,
        ),
    ),
    **_mart_queries(),
}
