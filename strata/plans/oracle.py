"""SQL building blocks for the DuckDB twins of the registered queries."""

from __future__ import annotations

from strata import fixture, schema

STALE_MARK = "1997-01-01 00:00:00"
FIRST_DAY = "1998-07-01"
SECOND_DAY = "1998-12-01"

_STRINGS = schema.SOURCE_COLUMNS
_EXTRA = ["_frequency", "_file_name", "_ingestion_ts", "_batch_id", "_src_orderkey", "_src_linenumber",
          "_src_partkey", "_src_suppkey"]
KEY = ", ".join(schema.MATCH_KEY)
_LATEST = ", ".join(f"{c} DESC NULLS LAST" for c in fixture.LATEST_ORDER)
TYPED_LIST = ", ".join([*_STRINGS, *_EXTRA])


def _standard(column: str) -> str:
    return f"upper(trim({column}))" if column == "category" else f"trim({column})"


_CASTS = {"forecast_date": "DATE", "forecast_qty": "DECIMAL(18,4)", "revenue_amount": "DECIMAL(18,2)"}
CASTABLE = " AND ".join(f"({c} IS NULL OR TRY_CAST({c} AS {t}) IS NOT NULL)" for c, t in _CASTS.items())
KEYS_PRESENT = " AND ".join(f"{c} IS NOT NULL AND trim({c}) <> ''" for c in schema.BUSINESS_KEY)


def differs(a: str, b: str) -> str:
    return "(" + " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in schema.TRACKED) + ")"


def matches(a: str, b: str, keys=schema.MATCH_KEY) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)


def surrogate(*cols: str) -> str:
    joined = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"CAST('0x' || substr(md5(concat_ws('|', {joined})), 1, 15) AS BIGINT)"


PARTS = {
    "src": ([], fixture.forecast_sql()),
    "audit": ([], fixture.audit_log_sql()),
    "dq": ([], fixture.dq_log_sql()),
    "std": (["src"], "SELECT " + ", ".join(f"{_standard(c)} AS {c}" for c in _STRINGS)
            + ", " + ", ".join(_EXTRA) + " FROM src"),
    "nul": (["std"], "SELECT " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in _STRINGS)
            + ", " + ", ".join(_EXTRA) + " FROM std"),
    "valid": (["nul"], f"SELECT * FROM nul WHERE {KEYS_PRESENT}"),
    "castable": (["valid"], f"SELECT * FROM valid WHERE {CASTABLE}"),
    "uniq": (["castable"],
             "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY _batch_id, "
             f"{KEY} ORDER BY {_LATEST}) AS rn FROM castable) WHERE rn = 1"),
    "clean": (["uniq"], "SELECT * REPLACE (" + ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in _CASTS.items())
              + "), substr(forecast_date, 1, 7) || '-01' AS period FROM uniq"),
    "batch1": (["clean"], "SELECT * FROM clean WHERE _batch_id = 'b1'"),
    "again": (["castable"],
              "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
              f"{KEY} ORDER BY {_LATEST}) AS rn FROM castable WHERE _ingestion_ts > TIMESTAMP '{STALE_MARK}')"
              " WHERE rn = 1"),
    "batch2": (["again"], "SELECT * REPLACE (" + ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in _CASTS.items())
               + "), substr(forecast_date, 1, 7) || '-01' AS period FROM again"),
}


def _history(one: str, two: str) -> tuple[list[str], str]:
    return ([one, two],
            f"SELECT a.*, DATE '{FIRST_DAY}' AS effective_from, CAST(NULL AS DATE) AS effective_to,"
            f" true AS is_active FROM {one} a LEFT JOIN {two} b ON {matches('a', 'b')}"
            f" WHERE b.product_id IS NULL OR NOT {differs('a', 'b')}"
            f" UNION ALL SELECT a.*, DATE '{FIRST_DAY}', DATE '{SECOND_DAY}', false"
            f" FROM {one} a JOIN {two} b ON {matches('a', 'b')} WHERE {differs('a', 'b')}"
            f" UNION ALL SELECT b.*, DATE '{SECOND_DAY}', CAST(NULL AS DATE), true"
            f" FROM {two} b LEFT JOIN {one} a ON {matches('a', 'b')}"
            f" WHERE a.product_id IS NULL OR {differs('a', 'b')}")


PARTS["history"] = _history("batch1", "batch2")

# The layer jobs on landing files that carry ``changed_on``: all columns are text in Bronze, so ties are
# broken as text, newest change first and then column by column.
_TEXT_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in ["changed_on", *schema.SOURCE_COLUMNS])


def _landed(where: str) -> tuple[list[str], str]:
    columns = ", ".join(f"{_standard(c)} AS {c}" for c in _STRINGS)
    return (["src"], f"SELECT {columns}, _frequency, CAST(_ingestion_ts AS VARCHAR) AS changed_on FROM src"
            f" WHERE {where}")


def _bronze(source: str) -> tuple[list[str], str]:
    return ([source], "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{KEY} ORDER BY {_TEXT_ORDER}) AS rn FROM {source} WHERE {KEYS_PRESENT}) WHERE rn = 1")


def _silver(source: str) -> tuple[list[str], str]:
    blank = ", ".join(f"NULLIF({c}, '') AS {c}" for c in _STRINGS)
    casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in _CASTS.items())
    return ([source], f"SELECT * REPLACE ({casts}), substr(forecast_date, 1, 7) || '-01' AS period"
            f" FROM (SELECT * REPLACE ({blank}) FROM {source}) WHERE {CASTABLE}")


PARTS["landed1"] = _landed("_batch_id = 'b1'")
PARTS["landed2"] = _landed(f"_ingestion_ts > TIMESTAMP '{STALE_MARK}'")
PARTS["bronze1"], PARTS["bronze2"] = _bronze("landed1"), _bronze("landed2")
PARTS["silver1"], PARTS["silver2"] = _silver("bronze1"), _silver("bronze2")
PARTS["run_history"] = _history("silver1", "silver2")
PARTS["opened2"] = (
    ["silver1", "silver2"],
    f"SELECT b.*, a.product_id IS NULL AS is_new FROM silver2 b LEFT JOIN silver1 a ON {matches('a', 'b')}"
    f" WHERE a.product_id IS NULL OR {differs('a', 'b')}")
PARTS["fact2"] = (
    ["opened2", "silver1"],
    f"SELECT b.* EXCLUDE (is_new) FROM opened2 b WHERE NOT EXISTS (SELECT 1 FROM silver1 a"
    f" WHERE {matches('a', 'b')} AND a.channel IS NOT DISTINCT FROM b.channel)")
PARTS["run_fact"] = (
    ["silver1", "fact2"],
    "SELECT *, 'run-1' AS _batch_id, '199807010600' AS stamp FROM silver1"
    " UNION ALL SELECT *, 'run-2', '199812010600' FROM fact2")


def _dim(prefix: str, batch: str, key: str, attributes: list[str]) -> tuple[list[str], str]:
    ranking = ", ".join(f"{c} DESC NULLS LAST" for c in ["_ingestion_ts", *attributes])
    cols = ", ".join([key, *attributes])
    return ([batch], f"SELECT {cols} FROM (SELECT {cols}, row_number() OVER (PARTITION BY {key} ORDER BY {ranking})"
            f" AS rn FROM {batch}) WHERE rn = 1")


def _dim_history(one: str, two: str, key: str, attributes: list[str], surrogate_name: str) -> tuple[list[str], str]:
    def cols(t: str) -> str:
        return ", ".join(f"{t}.{c}" for c in [key, *attributes])

    changed = "(" + " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in attributes) + ")"
    body = (
        f"SELECT {cols('a')}, DATE '{FIRST_DAY}' AS effective_from, CAST(NULL AS DATE) AS effective_to,"
        f" true AS is_active FROM {one} a LEFT JOIN {two} b ON a.{key} = b.{key}"
        f" WHERE b.{key} IS NULL OR NOT {changed}"
        f" UNION ALL SELECT {cols('a')}, DATE '{FIRST_DAY}', DATE '{SECOND_DAY}', false"
        f" FROM {one} a JOIN {two} b ON a.{key} = b.{key} WHERE {changed}"
        f" UNION ALL SELECT {cols('b')}, DATE '{SECOND_DAY}', CAST(NULL AS DATE), true"
        f" FROM {two} b LEFT JOIN {one} a ON a.{key} = b.{key} WHERE a.{key} IS NULL OR {changed}"
    )
    return ([one, two], f"SELECT *, {surrogate(key, 'effective_from')} AS {surrogate_name} FROM ({body})")


PARTS["prod1"] = _dim("prod1", "batch1", "product_id", ["category", "sub_category"])
PARTS["prod2"] = _dim("prod2", "batch2", "product_id", ["category", "sub_category"])
PARTS["loc1"] = _dim("loc1", "batch1", "location_id", ["region", "country"])
PARTS["loc2"] = _dim("loc2", "batch2", "location_id", ["region", "country"])
PARTS["dim_product"] = _dim_history("prod1", "prod2", "product_id", ["category", "sub_category"], "product_key")
PARTS["dim_location"] = _dim_history("loc1", "loc2", "location_id", ["region", "country"], "location_key")
PARTS["fact1"] = (
    ["batch1", "prod1", "loc1"],
    f"SELECT {surrogate('f.product_id', f'DATE {chr(39)}{FIRST_DAY}{chr(39)}')} AS product_key,"
    f" {surrogate('f.location_id', f'DATE {chr(39)}{FIRST_DAY}{chr(39)}')} AS location_key,"
    " CAST(strftime(f.forecast_date, '%Y%m%d') AS BIGINT) AS time_key, f.* FROM batch1 f"
    " JOIN prod1 p ON f.product_id = p.product_id JOIN loc1 l ON f.location_id = l.location_id")
# Both batches' facts: the second batch adds the keys that the fact does not hold, with the dimensions of its day.
PARTS["facts"] = (
    ["fact1", "batch2", "dim_product", "dim_location"],
    "SELECT * FROM fact1 UNION ALL BY NAME"
    " SELECT p.product_key, l.location_key, CAST(strftime(b.forecast_date, '%Y%m%d') AS BIGINT) AS time_key, b.* FROM batch2 b"
    " JOIN dim_product p ON b.product_id = p.product_id AND p.is_active"
    " JOIN dim_location l ON b.location_id = l.location_id AND l.is_active"
    f" WHERE NOT EXISTS (SELECT 1 FROM batch1 a WHERE {matches('a', 'b')} AND a.channel IS NOT DISTINCT FROM b.channel)")


def with_parts(body: str, *names: str) -> str:
    """``WITH`` the named parts and all they need, in order, followed by ``body``."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in PARTS[name][0]:
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    ctes = ", ".join(f"{n} AS ({PARTS[n][1]})" for n in ordered)
    return f"WITH {ctes} {body}"


def text(*columns: str) -> str:
    """Dates and timestamps as text."""
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


def real(*columns: str) -> str:
    """Decimals as doubles."""
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def strings(prefix: str = "", skip: tuple[str, ...] = ()) -> str:
    return ", ".join(f"{prefix}{c}" for c in _STRINGS if c not in skip)
