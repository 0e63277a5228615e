"""SQL fragments for the DuckDB oracles (the Spark side never uses these)."""

PW = """
pw_d AS (SELECT l_suppkey AS asset, CAST(l_shipdate AS DATE) AS d,
                sum(l_extendedprice) / sum(l_quantity) AS px, sum(l_quantity) AS vol
         FROM lineitem GROUP BY 1, 2),
pw_w AS (SELECT asset, CAST(date_trunc('week', d) AS DATE) AS date,
                min_by(px, d) AS open, max_by(px, d) AS close, sum(vol) AS volume
         FROM pw_d GROUP BY 1, 2),
bars AS (SELECT w.date, w.asset, w.open, w.close, w.volume,
                CAST(n.n_regionkey AS INTEGER) AS sector_code
         FROM pw_w w JOIN supplier s ON s.s_suppkey = w.asset
                     JOIN nation n ON n.n_nationkey = s.s_nationkey)"""

PE = """
bars AS (SELECT CAST(ts AS DATE) AS date, user_id AS asset,
                min_by(value, event_id) AS open, max_by(value, event_id) AS close,
                sum(value) AS volume, CAST(user_id % 5 AS INTEGER) AS sector_code
         FROM events GROUP BY user_id, CAST(ts AS DATE))"""

CAL = """
cal AS (SELECT date, CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS session_idx
        FROM (SELECT DISTINCT date FROM bars)),
p AS (SELECT b.*, c.session_idx FROM bars b JOIN cal c USING (date))"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(x.strip() for x in parts)


def lag(x: str, k: int, part: str = "asset", order: str = "session_idx") -> str:
    return (f"first_value({x}) OVER (PARTITION BY {part} ORDER BY {order} "
            f"RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING)")


def lead(x: str, k: int, part: str = "asset", order: str = "session_idx") -> str:
    return (f"first_value({x}) OVER (PARTITION BY {part} ORDER BY {order} "
            f"RANGE BETWEEN {k} FOLLOWING AND {k} FOLLOWING)")


def frame(n: int, part: str = "asset", order: str = "session_idx") -> str:
    return (f"OVER (PARTITION BY {part} ORDER BY {order} "
            f"RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)")


def returns(x: str, window: int) -> str:
    return f"({x} / NULLIF({lag(x, window - 1)}, 0) - 1)"


def fwd(x: str, k: int, start: int = 0) -> str:
    base = x if start == 0 else lead(x, start)
    return f"({lead(x, start + k)} / NULLIF({base}, 0) - 1)"


def roll_sum(x: str, n: int) -> str:
    return f"coalesce(sum({x}) {frame(n)}, 0)"


def demean(x: str, by: str = "date") -> str:
    return f"({x} - avg({x}) OVER (PARTITION BY {by}))"


def rank_ord(x: str, by: str = "date", desc: bool = False) -> str:
    d = " DESC" if desc else ""
    return (f"CASE WHEN {x} IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY {by}, "
            f"{x} IS NULL ORDER BY round({x}, 10){d}, asset) AS DOUBLE) END")


def rank_avg(x: str, by: str = "date") -> str:
    return (f"CASE WHEN {x} IS NOT NULL THEN rank() OVER (PARTITION BY {by}, {x} IS NULL "
            f"ORDER BY round({x}, 10)) + (count(*) OVER (PARTITION BY {by}, round({x}, 10)) - 1) / 2.0 END")


def zscore(x: str, by: str = "date", ddof: int = 0) -> str:
    sd = "stddev_pop" if ddof == 0 else "stddev_samp"
    return (f"(({x} - avg({x}) OVER (PARTITION BY {by})) / "
            f"NULLIF({sd}({x}) OVER (PARTITION BY {by}), 0))")


def top_flag(x: str, n: int, by: str = "date") -> str:
    return (f"coalesce({x} IS NOT NULL AND row_number() OVER (PARTITION BY {by}, {x} IS NULL "
            f"ORDER BY round({x}, 10) DESC, asset) <= {n}, false)")


def nan_null(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"
