"""DuckDB SQL equal to each registered query (the value-check oracle).

DuckDB sees only the test tables, so every statement carries the derived
deliveries table as a CTE (FIXTURES.md §3).  Two details keep it exact:
prices are turned into DECIMAL(38,18) through their shortest decimal text,
as Spark's double -> decimal cast does (DuckDB's direct cast keeps binary
noise in the last digits), and the unit price uses an integer form of the
half-up division because DuckDB divides decimals in DOUBLE.
"""

from __future__ import annotations

from cargoline import queries as Q

_FIXTURE = """
base AS (
  SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
         l_shipdate, o_orderpriority, c_nationkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN customer ON o_custkey = c_custkey),
one AS (
  SELECT
    CASE c_nationkey % 7 WHEN 0 THEN 'GT' WHEN 1 THEN 'gt' WHEN 2 THEN 'PE'
      WHEN 3 THEN 'EC' WHEN 4 THEN 'SV' WHEN 5 THEN 'HN' ELSE 'JM' END AS pais,
    CASE WHEN l_partkey % 97 = 0 THEN 'bad' WHEN l_partkey % 89 = 0 THEN NULL
      ELSE strftime(l_shipdate, '%Y%m%d') END AS fecha_proceso,
    concat('T', CAST(l_suppkey AS VARCHAR)) AS transporte,
    concat('R', CAST(c_nationkey AS VARCHAR)) AS ruta,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'ZPRE' WHEN '2-HIGH' THEN 'ZVE1'
      WHEN '3-MEDIUM' THEN 'Z04' WHEN '4-NOT SPECIFIED' THEN 'Z05'
      ELSE 'COBR' END AS tipo_entrega,
    CASE WHEN l_partkey % 17 = 0 THEN '' WHEN l_partkey % 19 = 0 THEN NULL
      WHEN l_partkey % 23 = 0 THEN '""' WHEN l_partkey % 29 = 0 THEN '   '
      ELSE concat('MAT', CAST(l_partkey AS VARCHAR)) END AS material,
    CAST(CAST(CASE WHEN l_partkey % 13 = 0 THEN 0 WHEN l_partkey % 11 = 0 THEN 0.0000005
      ELSE l_extendedprice END AS VARCHAR) AS DECIMAL(38,18)) AS precio,
    CAST(CAST(CASE WHEN l_partkey % 31 = 0 THEN 0 WHEN l_partkey % 37 = 0 THEN -l_quantity
      ELSE l_quantity END AS VARCHAR) AS DECIMAL(38,18)) AS cantidad,
    CASE l_linenumber % 4 WHEN 0 THEN 'CS' WHEN 1 THEN 'ST' WHEN 2 THEN 'cs'
      ELSE NULL END AS unidad,
    l_partkey
  FROM base),
deliveries AS (
  SELECT pais, fecha_proceso, transporte, ruta, tipo_entrega, material, precio,
         cantidad, unidad FROM one
  UNION ALL
  SELECT pais, fecha_proceso, transporte, ruta, tipo_entrega, material, precio,
         cantidad, unidad FROM one WHERE l_partkey % 5 = 0)"""

RAW = "pais, fecha_proceso, transporte, ruta, tipo_entrega, material, precio, cantidad, unidad"
NON_BLANK = "(material IS NOT NULL AND trim(material) <> '' AND material <> '\"\"')"
FIXED_PRICE = "CASE WHEN abs(precio) < 0.000001 THEN CAST(0 AS DECIMAL(38,18)) ELSE precio END"
DAY = "CAST(try_strptime(fecha_proceso, '%Y%m%d') AS DATE)"
VALID_TYPES = "('ZPRE', 'ZVE1', 'Z04', 'Z05')"


def _codes(codes) -> str:
    return "(" + ", ".join(f"'{c}'" for c in codes) + ")"


def in_range(start: str, end: str) -> str:
    return f"({DAY} BETWEEN DATE '{start}' AND DATE '{end}')"


def qstd(factor: int = 20) -> str:
    return (
        f"CAST(CASE WHEN upper(unidad) = 'CS' THEN cantidad * {factor} ELSE cantidad END "
        "AS DECIMAL(38,6))"
    )


def total(factor: int = 20) -> str:
    return f"CAST(precio * {qstd(factor)} AS DECIMAL(38,6))"


def _scaled(x: str) -> str:
    """|x| * 10^18 as HUGEINT, exact for DECIMAL(38,18)."""
    return (
        f"(CAST(floor(abs({x})) AS HUGEINT) * CAST(1000000000000000000 AS HUGEINT)"
        f" + CAST((abs({x}) - floor(abs({x}))) * 1000000000000000000 AS HUGEINT))"
    )


UNIT_PRICE = (
    "CASE WHEN cantidad > 0 THEN CAST(CAST(sign(precio) * ("
    f"(2 * {_scaled('precio')} * 1000000 + {_scaled('cantidad')})"
    f" // (2 * {_scaled('cantidad')})) AS DECIMAL(38,0)) * CAST(0.000001 AS DECIMAL(7,6))"
    " AS DECIMAL(38,6)) ELSE CAST(0 AS DECIMAL(38,6)) END"
)
FLAG = (
    "CASE WHEN precio > 0 AND cantidad > 0 AND material IS NOT NULL AND trim(material) <> '' "
    "THEN 'VALID' ELSE 'REVIEW' END"
)


def flags(routine=("ZPRE", "ZVE1"), bonus=("Z04", "Z05")) -> str:
    return (
        f"COALESCE(tipo_entrega IN {_codes(routine)}, false) AS is_routine_delivery, "
        f"COALESCE(tipo_entrega IN {_codes(bonus)}, false) AS is_bonus_delivery"
    )


CLEANED = (
    f"cleaned AS (SELECT DISTINCT pais, fecha_proceso, transporte, ruta, tipo_entrega, material, "
    f"{FIXED_PRICE} AS precio, cantidad, unidad FROM deliveries WHERE {NON_BLANK})"
)

STANDARD = (
    "pais AS country_code, fecha_proceso AS process_date, transporte AS transport_id, "
    "ruta AS route_id, material AS material_code, tipo_entrega AS delivery_type, "
    f"{flags()}, cantidad AS quantity_original, unidad AS unit_original, "
    f"{qstd()} AS quantity_standardized, 'ST' AS unit_standardized, precio AS price, "
    f"{UNIT_PRICE} AS unit_price, {total()} AS total_value, {FLAG} AS data_quality_flag"
)


def with_fixture(*ctes: str) -> str:
    return "WITH " + ",\n".join((_FIXTURE,) + ctes) + "\n"


def output_cte(
    name: str = "output",
    start: str = Q.START,
    end: str = Q.END,
    country: str | None = None,
    keep_all_types: bool = False,
) -> str:
    where = [in_range(start, end)]
    if not keep_all_types:
        where.append(f"tipo_entrega IN {VALID_TYPES}")
    if country:
        where.append(f"upper(pais) = '{country.upper()}'")
    return f"{name} AS (SELECT {STANDARD} FROM cleaned WHERE {' AND '.join(where)})"


def output_sql(**kw) -> str:
    return with_fixture(CLEANED, output_cte(**kw)) + "SELECT * FROM output"


# Text as the CSV scan returns it: spaces kept, empty text read as NULL.
_CSV_MATERIAL = "nullif(material, '') AS material"
_CSV_RAW = (
    f"pais, fecha_proceso, transporte, ruta, tipo_entrega, {_CSV_MATERIAL}, precio, cantidad, unidad"
)

# The second of two runs reports its own dates only.
_PER_DATE = (
    with_fixture(CLEANED, output_cte("first_run", *Q.FIRST_HALF), output_cte("second_run", *Q.SECOND_HALF))
    + "SELECT process_date, count(*) AS rows FROM second_run GROUP BY process_date"
)
_METRICS = (
    with_fixture(CLEANED, output_cte(start=Q.LATER_START, end=Q.LATER_END))
    + "SELECT 'parquet' AS output_format, count(*) AS rows_written, count(DISTINCT process_date) AS partition_values FROM output"
)

ORACLES: dict[str, str] = {
    # sources
    "csv_scan_typed": with_fixture() + f"SELECT {_CSV_RAW} FROM deliveries",
    "deliveries_scan": with_fixture() + f"SELECT {_CSV_RAW} FROM deliveries",
    "csv_scan_delimited": with_fixture() + f"SELECT {_CSV_RAW} FROM deliveries",
    "csv_scan_inferred": with_fixture()
    + "SELECT pais, fecha_proceso, transporte, ruta, tipo_entrega, "
    f"{_CSV_MATERIAL}, CAST(precio AS DOUBLE) AS precio, CAST(cantidad AS DOUBLE) AS cantidad, "
    "unidad FROM deliveries",
    # sinks: the written standard output read back
    "sink_parquet": output_sql(),
    "sink_csv": output_sql(),
    "sink_json": output_sql(),
    "sink_partitioned": output_sql(),
    "sink_partition_override": output_sql(),
    "sink_append": with_fixture(CLEANED, output_cte())
    + "SELECT * FROM output UNION ALL SELECT * FROM output",
    "sink_overwrite": output_sql(start=Q.LATER_START, end=Q.LATER_END),
    "sink_ignore": output_sql(),
    "sink_csv_multiline": with_fixture(CLEANED, output_cte())
    + "SELECT * REPLACE (material_code || chr(10) || 'B' AS material_code) FROM output",
    **{name: _PER_DATE for name in ("sink_by_date", "sink_by_date_append", "sink_by_date_csv", "sink_by_date_json")},
    "sink_by_date_ignore": _PER_DATE.replace(
        "FROM second_run", "FROM second_run WHERE process_date NOT IN (SELECT process_date FROM first_run)"
    ),
    "run_delivery_job_csv": output_sql(),
    "run_metrics": _METRICS,
    "run_metrics_append": _METRICS,
    "run_metrics_ignore": "SELECT 'parquet' AS output_format, CAST(0 AS BIGINT) AS rows_written, CAST(0 AS BIGINT) AS partition_values",
    "run_delivery_job": output_sql(),
    # filters, de-duplication
    "drop_blank_material": with_fixture() + f"SELECT {RAW} FROM deliveries WHERE {NON_BLANK}",
    "filter_date_range": with_fixture()
    + f"SELECT {RAW} FROM deliveries WHERE {in_range(Q.START, Q.END)}",
    "filter_country": with_fixture()
    + f"SELECT {RAW} FROM deliveries WHERE upper(pais) = '{Q.COUNTRY.upper()}'",
    "filter_delivery_types": with_fixture()
    + f"SELECT {RAW} FROM deliveries WHERE tipo_entrega IN {VALID_TYPES}",
    "drop_duplicates": with_fixture() + f"SELECT DISTINCT {RAW} FROM deliveries",
    # expressions
    "fix_tiny_price": with_fixture()
    + "SELECT pais, fecha_proceso, transporte, ruta, tipo_entrega, material, "
    f"{FIXED_PRICE} AS precio, cantidad, unidad FROM deliveries",
    "convert_units": with_fixture()
    + f"SELECT {RAW}, {qstd()} AS quantity_standardized, 'ST' AS unit_standardized FROM deliveries",
    "convert_units_factor": with_fixture()
    + f"SELECT {RAW}, {qstd(10)} AS quantity_standardized, 'ST' AS unit_standardized "
    "FROM deliveries",
    "classify_deliveries": with_fixture() + f"SELECT {RAW}, {flags()} FROM deliveries",
    "classify_custom_types": with_fixture()
    + f"SELECT {RAW}, {flags(Q.CUSTOM_ROUTINE, Q.CUSTOM_BONUS)} FROM deliveries",
    "total_value": with_fixture()
    + f"SELECT {RAW}, {qstd()} AS quantity_standardized, 'ST' AS unit_standardized, "
    f"{total()} AS total_value FROM deliveries",
    "unit_price": with_fixture() + f"SELECT {RAW}, {UNIT_PRICE} AS unit_price FROM deliveries",
    "quality_flag": with_fixture() + f"SELECT {RAW}, {FLAG} AS data_quality_flag FROM deliveries",
    "processing_timestamp": with_fixture(CLEANED, output_cte())
    + "SELECT count(*) AS rows, CAST(1 AS BIGINT) AS timestamps, CAST(0 AS BIGINT) AS nulls, true AS not_before_start FROM output",
    "parse_process_date": with_fixture()
    + f"SELECT fecha_proceso, {DAY} AS process_day FROM deliveries",
    "rename_standard": with_fixture()
    + "SELECT pais AS country_code, fecha_proceso AS process_date, transporte AS transport_id, "
    "ruta AS route_id, tipo_entrega AS delivery_type, material AS material_code, "
    "precio AS price, cantidad AS quantity_original, unidad AS unit_original FROM deliveries",
    "select_final": with_fixture() + f"SELECT {STANDARD} FROM deliveries",
    "enrich_deliveries": with_fixture(CLEANED)
    + f"SELECT {RAW}, {qstd()} AS quantity_standardized, 'ST' AS unit_standardized, "
    f"{total()} AS total_value, {UNIT_PRICE} AS unit_price, {FLAG} AS data_quality_flag "
    "FROM cleaned",
    # composite
    "clean_deliveries": with_fixture(CLEANED) + "SELECT * FROM cleaned",
    "clean_all_off": with_fixture() + f"SELECT {RAW} FROM deliveries",
    "delivery_transform": output_sql(),
    "delivery_transform_country": output_sql(country=Q.COUNTRY),
    "delivery_transform_keep_all_types": output_sql(keep_all_types=True),
    # profiles and audits
    "profile_values": with_fixture(
        "long AS (SELECT 'pais' AS column_name, pais AS value FROM deliveries "
        "UNION ALL SELECT 'fecha_proceso', fecha_proceso FROM deliveries "
        "UNION ALL SELECT 'tipo_entrega', tipo_entrega FROM deliveries)"
    )
    + "SELECT column_name, value, count(*) AS rows FROM long GROUP BY column_name, value",
    "profile_rows": with_fixture(
        "long AS (SELECT 'pais' AS column_name, pais AS value FROM deliveries "
        "UNION ALL SELECT 'fecha_proceso', fecha_proceso FROM deliveries "
        "UNION ALL SELECT 'tipo_entrega', tipo_entrega FROM deliveries)",
        "per_value AS (SELECT column_name, value, count(*) AS rows FROM long "
        "GROUP BY column_name, value)",
    )
    + "SELECT column_name, count(*) AS distinct_values, CAST(sum(rows) AS BIGINT) AS total_records "
    "FROM per_value GROUP BY column_name",
    "rows_per_partition": with_fixture(CLEANED, output_cte())
    + "SELECT process_date, count(*) AS rows FROM output GROUP BY process_date",
    "output_summary": with_fixture(CLEANED, output_cte())
    + "SELECT count(*) AS total_records, count(DISTINCT process_date) AS partition_values "
    "FROM output",
    "cleaning_funnel": with_fixture(
        "fixed AS (SELECT pais, fecha_proceso, transporte, ruta, tipo_entrega, material, "
        f"{FIXED_PRICE} AS precio, cantidad, unidad FROM deliveries)",
        "kept AS (SELECT DISTINCT * FROM fixed WHERE " + NON_BLANK + ")",
        f"typed AS (SELECT * FROM kept WHERE tipo_entrega IN {VALID_TYPES})",
        f"dated AS (SELECT * FROM typed WHERE {in_range(Q.START, Q.END)})",
        f"located AS (SELECT * FROM dated WHERE upper(pais) = '{Q.COUNTRY.upper()}')",
    )
    + "SELECT 0 AS step, 'read' AS stage, count(*) AS rows FROM deliveries "
    f"UNION ALL SELECT 1, 'non_blank_material', count(*) FROM deliveries WHERE {NON_BLANK} "
    "UNION ALL SELECT 2, 'deduplicated', count(*) FROM kept "
    "UNION ALL SELECT 3, 'valid_delivery_type', count(*) FROM typed "
    "UNION ALL SELECT 4, 'in_date_range', count(*) FROM dated "
    "UNION ALL SELECT 5, 'country', count(*) FROM located",
    "audit_bad_dates": with_fixture()
    + f"SELECT fecha_proceso AS value, count(*) AS rows FROM deliveries "
    f"WHERE fecha_proceso IS NOT NULL AND {DAY} IS NULL GROUP BY fecha_proceso",
    "audit_bad_countries": with_fixture()
    + "SELECT pais AS value, count(*) AS rows FROM deliveries WHERE pais IS NOT NULL AND "
    "upper(pais) NOT IN ('GT', 'PE', 'EC', 'SV', 'HN', 'JM') GROUP BY pais",
    "audit_bad_countries_custom": with_fixture()
    + "SELECT pais AS value, count(*) AS rows FROM deliveries WHERE pais IS NOT NULL AND "
    f"upper(pais) NOT IN {_codes(Q.CODES_WITHOUT_JM)} GROUP BY pais",
}

_KEPT_ROWS = "SELECT true AS refused, count(*) AS rows, count(DISTINCT process_date) AS dates FROM output"
ORACLES |= {
    # refused and failed writes leave the first one's rows
    "sink_error": with_fixture(CLEANED, output_cte()) + _KEPT_ROWS,
    "sink_by_date_error": with_fixture(CLEANED, output_cte("output", *Q.FIRST_HALF)) + _KEPT_ROWS,
    "sink_overwrite_failed": with_fixture(CLEANED, output_cte()) + _KEPT_ROWS,
    # what write jobs record, and what their files tell
    "sink_commits": with_fixture(
        CLEANED, output_cte("first_run"), output_cte("later_run", Q.LATER_START, Q.LATER_END), output_cte("dates_run", *Q.FIRST_HALF),
        "jobs AS (SELECT 'append' AS mode, 1 AS job, process_date FROM first_run UNION ALL SELECT 'append', 2, process_date FROM later_run "
        "UNION ALL SELECT 'overwrite dates', 3, process_date FROM dates_run)",
    )
    + "SELECT mode, 'parquet' AS format, 'process_date' AS partition_column, count(*) AS rows, count(DISTINCT process_date) AS partition_values FROM jobs GROUP BY mode, job",
    "sink_rows_per_partition": with_fixture(CLEANED, output_cte("first_run"), output_cte("later_run", Q.LATER_START, Q.LATER_END))
    + "SELECT process_date, count(*) AS rows FROM (SELECT process_date FROM first_run UNION ALL SELECT process_date FROM later_run) GROUP BY process_date",
    "run_rows_per_partition": with_fixture(CLEANED, output_cte(country=Q.COUNTRY))
    + "SELECT process_date, count(*) AS rows FROM output GROUP BY process_date",
    "run_input_profile": ORACLES["profile_values"],
    "run_funnel": ORACLES["cleaning_funnel"],
    "run_over_own_output": output_sql(start=Q.SECOND_HALF[0], end=Q.SECOND_HALF[1]),
    # damaged records: unreadable price, short, long
    "csv_scan_rejects": with_fixture(
        "lines AS (SELECT *, CAST(substr(transporte, 2) AS BIGINT) % 5 AS t FROM deliveries WHERE material IS NULL OR material NOT IN ('', '\"\"'))"
    )
    + "SELECT transporte, t < 3 AS is_rejected, CAST(CASE t WHEN 0 THEN 9 WHEN 1 THEN 5 WHEN 2 THEN 10 END AS BIGINT) AS fields, count(*) AS rows, "
    "count(precio) FILTER (t > 1) AS prices, count(cantidad) FILTER (t <> 1) AS quantities, count(fecha_proceso) AS dates, "
    "CAST(sum(precio) FILTER (t > 1) AS DECIMAL(38,6)) AS price_sum FROM lines GROUP BY transporte, t",
    "audit_countries_table": with_fixture()
    + "SELECT pais AS value, count(*) AS rows FROM deliveries WHERE pais IS NOT NULL AND "
    "upper(pais) NOT IN (SELECT upper(substr(n_name, 1, 2)) FROM nation) GROUP BY pais",
}
