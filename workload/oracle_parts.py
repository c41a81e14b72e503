"""SQL building blocks of the expected results."""

from __future__ import annotations

from collections.abc import Sequence


def null_safe(left: str, right: str, columns: Sequence[str]) -> str:
    return " AND ".join(f"{left}.{c} IS NOT DISTINCT FROM {right}.{c}" for c in columns)


def classified(
    ctes: str, keys: Sequence[str], values: Sequence[str], *, source: str = "src", target: str = "tgt"
) -> str:
    """CTE ``cls``: one row per key with status, multiplicities, both values and a flag per column.

    A key matches if its rows on both sides are the same multiset.
    """
    key_list = ", ".join(keys)
    order = ", ".join(f"{c} NULLS FIRST" for c in values) or "1"

    def ranked(side: str) -> str:
        return (
            f"SELECT *, count(*) OVER (PARTITION BY {key_list}) AS n_rows, "
            f"row_number() OVER (PARTITION BY {key_list} ORDER BY {order}) AS n FROM {side}"
        )

    bag = ", ".join(values) or "1"

    def bags(side: str) -> str:
        return f"SELECT {key_list}, list(ROW({bag}) ORDER BY {order}) AS bag FROM {side} GROUP BY {key_list}"

    flags = {c: f"(s.n IS NOT NULL AND t.n IS NOT NULL AND s.{c} IS NOT DISTINCT FROM t.{c})" for c in values}
    columns = [f"CASE WHEN s.n IS NOT NULL THEN s.{k} ELSE t.{k} END AS {k}" for k in keys]
    for c in values:
        columns += [f"s.{c} AS {c}_source", f"t.{c} AS {c}_target", f"{flags[c]} AS {c}_match"]
    return f"""WITH {ctes},
s1 AS (SELECT r.*, b.bag FROM ({ranked(source)}) r JOIN ({bags(source)}) b ON {null_safe("r", "b", keys)} WHERE n = 1),
t1 AS (SELECT r.*, b.bag FROM ({ranked(target)}) r JOIN ({bags(target)}) b ON {null_safe("r", "b", keys)} WHERE n = 1),
cls AS (
  SELECT {", ".join(columns)}, coalesce(s.n_rows, 0) AS source_rows, coalesce(t.n_rows, 0) AS target_rows,
         CASE WHEN t.n IS NULL THEN 'only_source' WHEN s.n IS NULL THEN 'only_target'
              WHEN s.bag IS NOT DISTINCT FROM t.bag THEN 'match' ELSE 'mismatch' END AS status
  FROM s1 s FULL JOIN t1 t ON {null_safe("s", "t", keys)})
"""


def trimmed(ctes: str, columns: Sequence[str], text: Sequence[str]) -> str:
    """The given CTEs plus ``srct`` / ``tgtt``: both sides with trimmed text columns."""
    items = ", ".join(f"trim({c}) AS {c}" if c in text else c for c in columns)
    return f"{ctes},\nsrct AS (SELECT {items} FROM src),\ntgtt AS (SELECT {items} FROM tgt)"


def texts(names: Sequence[str]) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in names)


METRICS = """
  SELECT CAST(sum(source_rows) AS BIGINT) AS source_rows, CAST(sum(target_rows) AS BIGINT) AS target_rows,
         count(*) FILTER (status <> 'only_target') AS source_keys,
         count(*) FILTER (status <> 'only_source') AS target_keys,
         CAST(sum(source_rows) - count(*) FILTER (status <> 'only_target') AS BIGINT) AS source_duplicates,
         CAST(sum(target_rows) - count(*) FILTER (status <> 'only_source') AS BIGINT) AS target_duplicates,
         count(*) FILTER (status IN ('match', 'mismatch')) AS common_keys,
         count(*) FILTER (status = 'match') AS matched_keys,
         count(*) FILTER (status = 'mismatch') AS mismatched_keys,
         count(*) FILTER (status = 'only_source') AS only_source_keys,
         count(*) FILTER (status = 'only_target') AS only_target_keys
  FROM cls"""


def match_rates(values: Sequence[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c}_match) AS matched, "
        f"count(*) FILTER (NOT {c}_match) AS mismatched, "
        f"round(count(*) FILTER ({c}_match) / CAST(count(*) AS DOUBLE), 6) AS match_rate "
        "FROM cls WHERE status IN ('match', 'mismatch')"
        for c in values
    )


def cells(keys: Sequence[str], values: Sequence[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {', '.join(keys)}, '{c}' AS column_name, CAST({c}_source AS VARCHAR) AS source_value, "
        f"CAST({c}_target AS VARCHAR) AS target_value FROM cls WHERE status = 'mismatch' AND NOT {c}_match"
        for c in values
    )
