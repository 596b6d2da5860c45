"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

`oracle` is the DuckDB SQL for the same result over the driver's tables; the
`transactions` stand-in view is available as a CTE via `txn_sql`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixture import TXN_CTE

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
# Queries whose check is a brute-force comparison in tests/ instead of SQL.
ROWS_ONLY: set[str] = set()


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = positive_zero(oracle)
        else:
            ROWS_ONLY.add(name)
        return fn

    return deco


def positive_zero(sql: str) -> str:
    """Wrap every `round(...)` as `(round(...) + 0.0)`.

    DuckDB's round keeps the sign of a tiny negative (-0.0) where Spark yields
    0.0; adding +0.0 maps -0.0 to 0.0 and leaves every other value unchanged.
    """
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 0, j + len(key) - 1
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = positive_zero(sql[j + len(key):k])
        out.append(sql[i:j] + "(round(" + inner + ") + 0.0)")
        i = k + 1


def txn_sql(body: str, ctes: str = "") -> str:
    """DuckDB SQL over the `transactions` view: `WITH <view>[, ctes] body`."""
    extra = f",\n{ctes}" if ctes.strip() else ""
    return f"WITH {TXN_CTE}{extra}\n{body}"


def load_all() -> None:
    """Import every plan module so its queries register."""
    from . import explore, features, quality  # noqa: F401
    from . import evaluate, monitor, prep, score  # noqa: F401
    from . import ml, streams  # noqa: F401
